"""SentencePiece agenda, phrase mining and spelling variants against the library
and against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import docs, words_of  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def use(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))

    yield use
    spark.conf.set("spark.sql.shuffle.partitions", before)


# ---- SentencePiece -------------------------------------------------------------

def odd_texts(n=400):
    rng = random.Random(5)
    signs = ["the", "in", "er", " ", "  ", "\n", "▁", "a", "Ü", "é", "漢", "😀", "\x00", "\t", "", "0", "12", "<0x41>", "</s>", ".,", " "]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_pieces_equal_the_library(spark):
    from graphloom.llm.pieces import decode_ids, encode_documents, vocabulary

    texts = odd_texts() + [None, "", " ", "\n", "\n a", "a\n", "x" * 5000 + " thein" * 300, "same text", "same text"]
    lib = vocabulary(PIECES).library
    for check in ("units", "texts"):
        out = encode_documents(docs(spark, list(enumerate(texts)), extra=True), PIECES, check=check)
        rows = {r.doc_id: r for r in out.collect()}
        assert len(rows) == len(texts)
        for i, t in enumerate(texts):
            ids = lib.encode(t or "")
            assert rows[i].ids == ids, t
            assert rows[i].decoded == lib.decode(ids)
            assert rows[i].library_agrees
    again = decode_ids(out, PIECES, "ids", "again")
    assert again.where("not (again <=> decoded)").count() == 0


def test_decoding_of_any_ids_equals_the_library():
    from graphloom.llm.pieces import vocabulary

    v, rng = vocabulary(PIECES), random.Random(1)
    for _ in range(4000):
        ids = [rng.choice([0, 1, 2, 35, 35, 259, 28705, 233, 191, 165, rng.randrange(32000)]) for _ in range(rng.randint(0, 7))]
        assert v.decode(ids) == v.library.decode(ids), ids


def test_a_wrong_unit_is_reported():
    from graphloom.llm.pieces import MergeVocabulary

    v = MergeVocabulary(PIECES)
    real = v._merge_rows
    v._merge_rows = lambda units: [b"\x05\0\0\0" if u == "▁bad" else x for u, x in zip(units, real(units))]
    v.encode(["all fine", "this is bad"], True)
    assert v.agreed(2) == [True, False]


def test_other_vocabularies_are_refused(tmp_path):
    from graphloom.llm.pieces import MergeVocabulary
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(PIECES, "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = m.trainer_spec.UNIGRAM
    (tmp_path / "u.model").write_bytes(m.SerializeToString())
    with pytest.raises(ValueError):
        MergeVocabulary(str(tmp_path / "u.model"))


def test_pieces_of_an_empty_table(spark):
    from graphloom.llm.pieces import encode_documents

    assert encode_documents(docs(spark, []), PIECES).count() == 0


# ---- phrases -------------------------------------------------------------------

def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_phrases(rows, least, percent):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    cand = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    inside = Counter()
    for (lang, g), a in cand.items():
        for m in range(2, len(g)):
            for s in range(len(g) - m + 1):
                inside[lang, g[s:s + m]] = max(inside[lang, g[s:s + m]], a)
    out = set()
    for (lang, g), a in cand.items():
        if inside[lang, g] and 100 * inside[lang, g] >= percent * a:
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        out.add((lang, " ".join(g), a, f[lang, g[:k]], f[lang, g[k:]], n[lang], score))
    return out


def phrase_rows(rng, n):
    vocab = ["a", "b", "B", "aa", "c\x00", "c", "\x01", "é", "É", "漢", "x-y", "~"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "\t ", ", ", "\n"]) for _ in range(rng.randint(0, 40)))
        rows.append((i, text, rng.choice(["en", "en", "fr", None])))
    return rows + [(n, None, "en"), (n + 1, "", None), (n + 2, "only one", "xx"), (0, "a b a b a b a b", "en"), (0, "a b a b a b a b", "en")]


@pytest.mark.parametrize("n_partitions, least, percent", [(4, 3, 100), (23, 2, 60), (1, 5, 100)])
def test_phrases_equal_plain_counting(spark, partitions, n_partitions, least, percent):
    from graphloom.llm.collocations import phrase_scores

    partitions(n_partitions)
    rows = phrase_rows(random.Random(n_partitions), 60)
    got = phrase_scores(docs(spark, [(*r, "s") for r in rows], extra=True), least, percent)
    got = [tuple(r) for r in got.select("lang", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(got) == len(set(got))
    assert set(got) == plain_phrases(rows, least, percent)


def test_top_phrases_and_empty_tables(spark):
    from graphloom.llm.collocations import phrase_scores, top_phrases

    rows = phrase_rows(random.Random(9), 40)
    scored = phrase_scores(docs(spark, [(*r, "s") for r in rows]), 2, 100)
    got = {}
    for r in top_phrases(scored, 7).collect():
        got.setdefault(r.lang, []).append((r["rank"], r.phrase, r.a, r.score))
    for lang, mine in got.items():
        best = sorted((x for x in plain_phrases(rows, 2, 100) if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:7]
        assert sorted(mine) == [(i + 1, x[1], x[2], x[6]) for i, x in enumerate(best)]
    assert top_phrases(phrase_scores(docs(spark, [])), 5).count() == 0
    assert phrase_scores(docs(spark, [(1, None), (2, " . ")]), 1).count() == 0


def test_windows_folded_over_many_batches(spark, partitions):
    """A phrase whose windows fill several Arrow batches and partitions."""
    from graphloom.llm.collocations import phrase_scores

    partitions(3)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        rng = random.Random(2)
        rows = [(i, " ".join(["hub", f"v{rng.randrange(300)}", "end", f"u{rng.randrange(300)}", "hub", "end"]), "en") for i in range(400)]
        got = {tuple(r) for r in phrase_scores(docs(spark, [(*r, "s") for r in rows]), 3, 100)
               .select("lang", "phrase", "a", "l", "r", "n", "score").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == plain_phrases(rows, 3, 100)


def test_windows_follow_the_phrases_not_the_places_where_pairs_meet(spark, partitions):
    """Each of 40 words before a hub and each of 40 behind it: 80 frequent pairs, 1,600 rare triples."""
    from graphloom.llm.collocations import _sieves, _windows, phrase_scores
    from graphloom.session import ship_package
    from pyspark.sql import functions as F

    partitions(4)
    rows = [(40 * i + j, f"u{i} hub v{j}", "en") for i in range(40) for j in range(40)]
    rows += [(5000 + i, "one two three four five six", "en") for i in range(40)]
    table = docs(spark, [(*r, "s") for r in rows]).coalesce(1)
    ship_package(spark)
    texts = table.select("lang", F.encode("text", "utf-8").alias("text"))
    windows = {bytes(r["key"]): r["n"] for r in _windows(texts, _sieves(texts, 40)).collect()}
    assert len(windows) <= 1 + 3 * 40 + 6
    assert sum(windows.values()) == 3 * 1600 + 6 * 40
    assert windows[b"v7\nhub\n"] == 40 and windows[b"hub\nu3\n"] == 40 and windows[b"six\nfive\nfour\nthree\ntwo\n"] == 40
    cores = spark.sparkContext.defaultParallelism
    assert _windows(texts.repartition(4 * cores), [b"", b"", b""]).rdd.getNumPartitions() == cores
    got = {tuple(r) for r in phrase_scores(table, 40, 100).select("lang", "phrase", "a", "l", "r", "n", "score").collect()}
    assert got == plain_phrases(rows, 40, 100) and {x[1] for x in got} >= {"u3 hub", "hub v7", "one two three four five"}


def test_windows_reach_back_as_far_as_pairs_and_triples_pass():
    import numpy as np
    from graphloom.llm.collocations import _back, _triples

    rng = np.random.RandomState(3)
    for n in [0, 1, 2, 3, 4, 5, 40, 400]:
        linked, triple = rng.rand(n) < .8, rng.rand(n) < .8
        if n:
            linked[0] = False
        for i, m in enumerate(_back(linked, triple).tolist()):
            fits = [k for k in range(1, 6) if i - k + 1 >= 0 and linked[i - k + 2:i + 1].all() and triple[i - k + 3:i + 1].all()]
            assert m == max(fits)
    pair = np.array([0, 5, 7, 0, 5, 7, 9], np.uint64)
    three = _triples(pair)
    assert np.flatnonzero(three).tolist() == [2, 5, 6] and three[2] == three[5] != three[6]
    assert len(_triples(pair[:0])) == 0 and not _triples(pair[:1]).any()


# ---- spelling variants ---------------------------------------------------------

def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts, times):
    out = {}
    for w, n in counts.items():
        beside = [v for v in counts if near(w, v)]
        best = min(beside, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= times * n else None
        out[w] = [form, n, len(beside), counts[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].append(root)
    return out


@pytest.mark.parametrize("n_partitions, seed", [(4, 1), (17, 2), (1, 3)])
def test_variants_equal_brute_force(spark, partitions, n_partitions, seed):
    from graphloom.llm.variants import variant_forms

    partitions(n_partitions)
    rng = random.Random(seed)
    words = {"".join(rng.choice("aab") for _ in range(rng.randint(1, 8))) for _ in range(150)}
    words |= {"".join(rng.choice("abcé÷") for _ in range(4)) for _ in range(60)}
    long = "".join(rng.choice("xy") for _ in range(3000))
    words |= {long, long[:1500] + long[1501:], long[:-1] + "z", "q"}
    counts = {w: rng.choice([1, 2, 10, 20, 100, 150, 2000]) for w in sorted(words)}
    got = variant_forms(spark.createDataFrame(list(counts.items()), "word string, n long"), 10).collect()
    assert {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in got} == plain_variants(counts, 10)
    assert len(got) == len(counts)


def test_words_are_drilled_and_counted(spark):
    from graphloom.llm.variants import count_words

    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["Straße", "Wörter", "zeichnen", "ZEICHNEN", "x1y", "ÀÉ÷"]) for _ in range(30))) for i in range(50)]
    rows += [(7, None), (8, ""), (9, "123 --"), (0, rows[0][1]), (0, rows[0][1])]
    expected = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            if h % 5 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            expected[w] += 1
    got = {r.word: r.n for r in count_words(docs(spark, rows, extra=True), 3, 2, 5).collect()}
    assert got == {w: n for w, n in expected.items() if len(w) >= 3 and n >= 2}


def test_variants_of_little(spark):
    from graphloom.llm.variants import count_words, variant_forms

    assert variant_forms(count_words(docs(spark, []))).count() == 0
    one = variant_forms(spark.createDataFrame([("alone", 3)], "word string, n long")).collect()
    assert [tuple(r) for r in one] == [("alone", None, "alone", 3, 0, None)]
