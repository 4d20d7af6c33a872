"""Sharding (op3), token files (op4), packing (op7), mixing (op8), the pipeline."""

import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import docs, sentence, words_of


def corpus(n=150, seed=1):
    rng = random.Random(seed)
    rows = [(i, sentence(rng, rng.randrange(1, 300)), "en", f"s{rng.randrange(4)}") for i in range(n)]
    rows += [(1000 + i, rows[0][1], "en", "s0") for i in range(60)]  # a large group of copies
    rows += [(2000, None, None, None), (2001, None, "en", "s1"), (2002, "", "en", None), (2003, "é😀 \x1c\xa0x", "en", "s1"),
             (2004, "<|endoftext|> and <|startoftext|>", "en", "s2"), (2005, "long " * 30_000, "en", "s9"), (2006, "   ", "en", "empty")]
    rng.shuffle(rows)
    return rows


def tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


# ---- op3

def test_shards(spark):
    from graphloom.llm.sharding import shard_documents

    rows = corpus() + [(None, "no id", "en", "s0"), (None, "no id", "en", "s0"), (1000, corpus()[0][1], "en", "s0")]
    got = shard_documents(docs(spark, rows, extra=True), 5).collect()
    text = collections.Counter((i, len((t or "").encode()) + 16, None if t is None else zlib.crc32(t.encode())) for i, t, *_ in rows)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == text
    for s in range(5):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    shard_of = collections.defaultdict(set)
    for r in got:
        shard_of[(r["size"], r.text_crc32)].add(r.shard)
    assert all(len(s) == 1 for s in shard_of.values())  # equal texts stay together
    loads = [sum(r["size"] for r in got if r.shard == s) for s in range(5)]
    largest = max(sum(r["size"] for r in got if (r["size"], r.text_crc32) == k) for k in shard_of)
    assert max(loads) - min(loads) <= largest


def test_schedule_is_longest_first():
    from graphloom.llm.sharding import schedule

    rng = random.Random(2)
    jobs = [(rng.randrange(1, 50), f"k{i}") for i in range(80)] + [(7, "tie1"), (7, "tie2")]
    loads, expected = [(0, s) for s in range(6)], {}
    for size, key in sorted(jobs, key=lambda j: (-j[0], j[1])):
        least = min(loads)
        expected[key] = least[1]
        loads[loads.index(least)] = (least[0] + size, least[1])
    assert schedule(jobs, 6) == expected
    heap = [0] * 6
    for size, key in jobs:
        heap[expected[key]] += size
    assert max(heap) <= (4 / 3) * max(sum(heap) / 6, max(j[0] for j in jobs))
    assert schedule([], 3) == {}


# ---- op4

@pytest.mark.parametrize("name,units", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaced")])
@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("  \n\n\t\r\x00\x0b\x1c\x1f\x85\xa0 aábB'sdt.,!<|>3٣İſKßΣ́"), st.characters(codec="utf-8")), max_size=40))
def test_units_give_the_ids_of_whole_texts(name, units, text):
    import public_tokenizers

    from graphloom.llm.tokens import encoder

    enc = encoder(public_tokenizers.path(name), units)
    for t in (text, text + "<|endoftext|>" + text):
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_units_that_fall_out_of_the_table(monkeypatch):
    import public_tokenizers

    from graphloom.llm import tokens

    monkeypatch.setattr(tokens, "UNITS_KEPT", 20)
    enc = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"), "words")
    rng = random.Random(3)
    for _ in range(50):
        t = sentence(rng, 30, 60) + " " + "x" * 100
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == enc.tok.encode(t, add_special_tokens=False).ids
        assert len(enc.kept) <= 20 + 31


def test_token_files(spark, tmp_path):
    import public_tokenizers

    from graphloom.llm.token_files import read_token_files, write_token_files

    rows = corpus()
    folder = f"file://{tmp_path}/tokens"
    manifest = write_token_files(docs(spark, rows, extra=True), folder, public_tokenizers.path("word_bpe_49k.json"), "words", 1)
    got = sorted(read_token_files(manifest, folder).collect(), key=lambda r: r.start)
    tok, start = tokenizer("word_bpe_49k.json"), 0
    assert [r.doc_id for r in got] == sorted(i for i, *_ in rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        ids = tok.encode(text[r.doc_id] or "", add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    # the files themselves, mapped as a training job would
    flat = np.concatenate([np.memmap(f"{tmp_path}/tokens/{m['name']}.bin", "<u2", "r") for m in sorted(manifest.collect(), key=lambda m: m["part"])])
    assert len(flat) == start
    for m in manifest.collect():
        off = np.fromfile(f"{tmp_path}/tokens/{m['name']}.idx", "<u8")
        assert len(off) == m["n_docs"] + 1 and off[0] == 0 and off[-1] == m["n_tokens"]


def test_token_files_with_ties_and_null_ids(spark):
    import public_tokenizers

    from graphloom.llm.token_files import token_dataset

    d = docs(spark, [(None, "b"), (3, "z z"), (3, "a"), (3, "a"), (-5, None), (None, None)])
    got = sorted(token_dataset(d, public_tokenizers.path("word_bpe_49k.json"), "words", 1).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(None, 0, 1), (None, 1, 2), (-5, 3, 1), (3, 4, 2), (3, 6, 2), (3, 8, 3)]
    assert token_dataset(docs(spark, []), public_tokenizers.path("word_bpe_49k.json"), "words", 1).count() == 0


# ---- op7

def check_packing(rows, got, window=1024):
    tok = tokenizer("byte_bpe_50k.json")
    ids = {i: np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t, *_ in rows}
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == len(ids[i])
    assert sorted(by_seq) == list(range(len(by_seq)))
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / sum(map(len, ids.values()))


def test_packing(spark):
    import public_tokenizers

    from graphloom.llm.packing import pack_documents

    rows = corpus(600, 5)
    got = pack_documents(docs(spark, rows, extra=True), public_tokenizers.path("byte_bpe_50k.json"), "spaced").collect()
    assert check_packing(rows, got) < 0.01
    assert pack_documents(docs(spark, []), public_tokenizers.path("byte_bpe_50k.json"), "spaced").count() == 0


def test_packing_of_repeated_rows(spark):
    import public_tokenizers

    from graphloom.llm.packing import pack_documents

    rows = [(1, "a b c"), (1, "a b c"), (None, "d")]
    got = pack_documents(docs(spark, rows), public_tokenizers.path("byte_bpe_50k.json"), "spaced").collect()
    assert sorted((r.length, r.offset) for r in got)[0][0] == 2 and len(got) == 3
    assert len({(r.sequence_id, r.offset) for r in got}) == 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.integers(1, 400)), max_size=30))
def test_every_plan_uses_each_piece_once(lengths):
    from graphloom.llm.packing import plan_windows

    hist = [0] * 65
    for x, n in lengths:
        hist[x] += n
    used = [0] * 65
    for combo, n in plan_windows(hist, 64):
        assert n > 0 and sum(combo) <= 64
        for x in combo:
            used[x] += n
    assert used == hist


def test_least_squares_recovers_a_mixture():
    from graphloom.llm.packing import combinations, plan_windows, solve

    hist = [0] * 101
    for combo, n in (((60, 40), 500), ((50, 30, 20), 300), ((70, 30), 200)):
        for x in combo:
            hist[x] += n
    combos = combinations([x for x in range(101) if hist[x]], 100)
    x = solve(hist, combos, 100)
    fit = [0.0] * 101
    for c, n in zip(combos, x):
        for k in c:
            fit[k] += n
    assert max(abs(a - b) for a, b in zip(fit, hist)) < 10
    assert sum(n for c, n in plan_windows(hist, 100) if sum(c) == 100) >= 980


# ---- op8

def plain_targets(sizes, weights, total, epochs):
    full = set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in full)
        w = sum(weights[s] for s in sizes if s not in full)
        t = {s: epochs * sizes[s] if s in full else rest * weights[s] / w for s in sizes}
        over = {s for s in sizes if s not in full and t[s] > epochs * sizes[s]}
        if not over or not w:
            return t
        full |= over


def test_mix(spark):
    from graphloom.llm.mixing import mix, plan_mix

    rows = corpus(300, 7) + [(None, "no id at all", "en", "s1"), (5, "tie tie", "en", "tie"), (5, "tie tie", "en", "tie"), (5, "tie too", "en", "tie")]
    d = docs(spark, rows, extra=True)
    got = plan_mix(d).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, plan_mix(d).collect()))
    sizes = collections.Counter()
    for _, t, _, s in rows:
        sizes[s] += len(words_of(t))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    targets = plain_targets(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}, 1.5 * sum(sizes.values()), 2.0)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    for s in sizes:
        assert targets[s] - 3 < taken[s] <= targets[s] + 1e-6
    # the mix itself holds just those words, and the columns of the input
    out = mix(d)
    assert out.columns == d.columns and out.schema == d.schema
    texts, words = collections.defaultdict(list), collections.Counter()
    for i, t, _, s in rows:
        texts[(i, s)].append(t)
    for r in out.collect():
        words[r.source] += len(words_of(r.text))
        assert any(r.text == t or t and r.text and t.strip(" ").startswith(r.text) for t in texts[(r.doc_id, r.source)])
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert words == taken


def test_mix_of_nothing(spark):
    from graphloom.llm.mixing import mix, plan_mix

    assert plan_mix(docs(spark, [])).count() == 0 and mix(docs(spark, [])).count() == 0
    assert [r.taken for r in plan_mix(docs(spark, [(1, None), (2, "")])).collect()] == [0, 0]


# ---- pipeline

def test_pipeline_stages(spark, tmp_path):
    """Each stage against what it should have done to its own input."""
    import corpus_pipeline as P
    from test_pairs import expect_docs
    from test_texts import PERSONAL, plain_spans

    rng = random.Random(11)
    rows = [(i, sentence(rng, rng.randrange(60, 200)), "en", f"s{i % 3}") for i in range(120)]
    rows += [(500 + i, rows[i][1], "en", "s1") for i in range(10)]
    rows += [(600 + i, rows[i][1] + " tail", "en", "s1") for i in range(10, 20)]
    rows += [(700, sentence(rng, 90) + " mail me at someone@mail.example.com or +1 (415) 555-0132 now", "en", "s2"), (800, "too short", "en", "s0"),
             (801, None, "en", "s0"), (802, " ".join(["again"] * 90), "en", "s0"), (803, " ".join(f"{w} |" for w in sentence(rng, 70).split()), "en", "s0")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "pii", "mixing", "packing"]
    before = {r.doc_id: r for r in d.collect()}

    seen = {}
    for name, stage in P.STAGES:
        out = stage(spark, d, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        seen[name] = d = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert d.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good = {r.doc_id for r in seen["quality"].collect()}
    assert good == set(before) - {800, 801, 802, 803}
    kept = {i for i, (_, _, k) in expect_docs([(i, before[i].text) for i in good], 5).items() if k}
    assert {r.doc_id for r in seen["near_duplicates"].collect()} == kept and len(kept) == 121
    for r in seen["pii"].collect():
        assert not plain_spans(r.text, PERSONAL)
        assert r.text == before[r.doc_id].text or r.doc_id == 700 and "<EMAIL>" in r.text and "<PHONE>" in r.text
    mixed = seen["mixing"].collect()
    whole = {r.doc_id: r.text for r in seen["pii"].collect()}
    n = sum(len(words_of(t)) for t in whole.values())
    assert 1.5 * n - 3 <= sum(len(words_of(r.text)) for r in mixed) <= 1.5 * n
    assert max(collections.Counter(r.doc_id for r in mixed).values()) <= 3
    pieces = seen["packing"].collect()
    tok = tokenizer("byte_bpe_50k.json")
    assert sum(r.length for r in pieces) == sum(len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    assert P.run(spark, str(tmp_path)).count() == len(pieces)


def test_registered_queries():
    import __spark_entry__ as E

    names = E.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)
