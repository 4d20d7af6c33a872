import json

from pyspark.sql import functions as F

from graphloom.functions.chatrows import parse_chat_rows, truncate_tokens
from graphloom.functions.prompts import build_prompts, render_chat, system_text


def test_parse_statuses(spark):
    ok = json.dumps({"messages": [{"role": "user", "content": "hi", "extra": 1}], "other": True})
    rows = [(1, ok), (2, "{not json"), (3, json.dumps({"turns": []})), (4, json.dumps({"messages": "x"})),
            (5, json.dumps({"messages": [{"role": "user"}]})), (6, "[1, 2]")]
    df = spark.createDataFrame(rows, "id long, raw string")
    got = {r.id: r.status for r in parse_chat_rows(df).collect()}
    assert got == {1: "ok", 2: "invalid_json", 3: "no_messages", 4: "no_messages", 5: "bad_message", 6: "invalid_json"}
    text = parse_chat_rows(df).where("id = 1").select(render_chat("messages")).first()[0]
    assert text == "<|im_start|>user\nhi<|im_end|>\n"


def test_fail_mode_raises(spark):
    df = spark.createDataFrame([(1, "{bad")], "id long, raw string")
    try:
        parse_chat_rows(df, on_error="fail").collect()
    except Exception as e:  # noqa: BLE001
        assert "bad chat row" in str(e)
    else:
        raise AssertionError("expected failure")


def test_render_open_prompt(spark):
    df = spark.createDataFrame([("d", "T")], "doc_id string, text string")
    p = build_prompts(df, "fine_tuned").select(render_chat("messages", True)).first()[0]
    assert p == ("<|im_start|>system\n" + system_text("fine_tuned") + "<|im_end|>\n<|im_start|>user\nT<|im_end|>\n"
                 "<|im_start|>assistant\n")


def test_truncate_tokens(spark):
    df = spark.createDataFrame([("  a b\tc\n d  ",), ("",)], "text string")
    r = truncate_tokens(df, n=2).collect()
    assert (r[0].n_tokens, r[0].truncated, r[0].text_capped) == (4, True, "a b")
    assert (r[1].n_tokens, r[1].truncated, r[1].text_capped) == (0, False, "")


def test_truncate_with_real_tokenizer(spark):
    from tokenizers import Tokenizer
    from tokenizers.models import WordLevel
    from tokenizers.pre_tokenizers import Whitespace

    vocab = {w: i for i, w in enumerate(["[UNK]", "the", "weir", "is", "high", "."])}
    tok = Tokenizer(WordLevel(vocab, unk_token="[UNK]"))
    tok.pre_tokenizer = Whitespace()
    df = spark.createDataFrame([("the weir is high .",), ("the",)], "text string")
    r = truncate_tokens(df, n=3, tokenizer=tok).collect()
    assert (r[0].n_tokens, r[0].truncated, r[0].text_capped) == (5, True, "the weir is")
    assert (r[1].n_tokens, r[1].truncated) == (1, False)
