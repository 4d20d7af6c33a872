"""Operator 1 [native]: quality rules with adaptive thresholds.

Fixed cutoffs are replaced by fences read from mergeable quantile sketches, one
per (lang, source) and feature.  A sketch is a log-linear histogram (buckets of
at most 1/32 relative width, so a quantile is off by no more): merging is adding
counts, the result does not depend on order, and a source holding a third of
all rows is summed before the shuffle.  A group with fewer than ``least``
documents uses its language's sketch, merged from the sources', and a small
language the sketch of all.  A feature above q75 + 3 spread or below
q25 - 3 spread fails, spread being the interquartile range, at least the
feature's resolution (so a group of alike documents does not reject its own).
The fences are joined to the documents, which are read once.

Defined results: a null or empty text has no words and fails the base rules;
null languages and sources are groups of their own; repeated rows are judged
alike; an empty table gives no rows; further columns are ignored by ``judge``
and kept by ``filter_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from graphloom.llm.common import WORD, bind, lookup
from graphloom.session import stored

#: feature -> (resolution, has a lower fence), in thousandths unless said.
FEATURES = {"f_symbols": (50, False), "f_upper": (50, False), "f_word_len": (100, True),  # hundredths of a character
            "f_dup_lines": (200, False), "f_repeats": (150, False)}
SPREADS = 3
LEAST = 50


def _split(text: Column) -> Column:
    """Words of a non-null text."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the array."""
    def grams(a: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(a) - 3), lambda i: F.concat_ws(" ", a[i], a[i + 1], a[i + 2]))

    def covered(p: Column) -> Column:  # p: sorted starts; each start covers up to three words
        gaps = F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda x, y: F.coalesce(F.least(F.lit(3), y - x), F.lit(3)))
        return F.aggregate(gaps, F.lit(0), lambda s, x: s + x)

    def starts(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))

        def pick(s: Column) -> Column:
            again = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: (
                F.when(k > 0, s[k]["g"] == s[k - 1]["g"]).otherwise(False)
                | F.when(k < F.size(s) - 1, s[k]["g"] == s[k + 1]["g"]).otherwise(False)))
            return F.sort_array(F.transform(again, lambda k: s[k]["i"]))

        return bind(pairs, pick)

    def count(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(bind(starts(g), covered))

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(bind(grams(w), count))


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Base counts and features of every document, beside ``keep`` columns
    (renamed so that none clashes)."""
    t = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("_row"), F.col("lang").alias("_lang"), F.col("source").alias("_source"),
                    t.alias("_text"), _split(t).alias("_w"))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    d = d.select("_row", "_lang", "_source", F.size("_w").cast("long").alias("n_words"),
                 (F.length("_text") - F.regexp_count("_text", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
                 F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                 bind(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"))).alias("_l"),
                 repeat_words(F.col("_w")).cast("long").alias("n_repeat_words"),
                 F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("_upper"))
    d = d.withColumn("n_dup_lines", F.col("_l.d").cast("long")).withColumn("_lines", F.col("_l.n")).drop("_l")
    d = d.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))

    def share(a: str, b: str, k: int) -> Column:
        return F.coalesce(F.expr(f"{k} * {a} div nullif({b}, 0)"), F.lit(0)).cast("long")

    return d.withColumns({"f_symbols": share("n_symbols", "n_words", 1000), "f_upper": share("_upper", "word_chars", 1000),
                          "f_word_len": share("word_chars", "n_words", 100), "f_dup_lines": share("n_dup_lines", "_lines", 1000),
                          "f_repeats": share("n_repeat_words", "n_words", 1000)}).drop("_upper", "_lines")


def bucket(x: Column) -> Column:
    """Log-linear bucket of a non-negative long."""
    e = F.greatest(F.lit(0), F.length(F.bin(x)) - 6)
    return (e * 32 + F.floor(x / F.pow(F.lit(2.0), e))).cast("long")


def bucket_low(b: Column) -> Column:
    """Smallest value of a bucket."""
    e = F.greatest(F.lit(0), F.floor(b / 32) - 1)
    return ((b - e * 32) * F.pow(F.lit(2.0), e)).cast("long")


def sketches(d: DataFrame) -> DataFrame:
    """Counts by (level, lang, source, feature, bucket): level 2 one group,
    level 1 a language, level 0 everything."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("x")) for f in FEATURES))).alias("f")
    own = d.where(~F.col("base_failed")).select("_lang", "_source", each) \
        .groupBy("_lang", "_source", "f.feature", bucket(F.col("f.x")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    own = stored(own.withColumn("level", F.lit(2)), "quality-sketch")
    lang = own.groupBy("_lang", "feature", "bucket").agg(F.sum("n").alias("n")) \
        .withColumns({"_source": F.lit(None).cast("string"), "level": F.lit(1)})
    every = own.groupBy("feature", "bucket").agg(F.sum("n").alias("n")) \
        .withColumns({"_lang": F.lit(None).cast("string"), "_source": F.lit(None).cast("string"), "level": F.lit(0)})
    return own.unionByName(lang).unionByName(every)


def fences(sketch: DataFrame) -> DataFrame:
    """(level, lang, source) -> docs and, per feature, lo_f and hi_f."""
    group = ["level", "_lang", "_source", "feature"]
    w = Window.partitionBy(*group)
    up = F.sum("n").over(w.orderBy("bucket"))
    s = sketch.withColumn("_up", up).withColumn("_all", F.sum("n").over(w))

    def quantile(q: int) -> Column:
        return F.min(F.when(F.col("_up") * 100 >= F.col("_all") * q, bucket_low(F.col("bucket"))))

    q = s.groupBy(*group).agg(F.max("_all").alias("docs"), quantile(25).alias("q25"), quantile(75).alias("q75"))
    least = F.create_map(*(x for f, (r, _) in FEATURES.items() for x in (F.lit(f), F.lit(r))))
    spread = F.greatest(F.col("q75") - F.col("q25"), least[F.col("feature")]) * SPREADS
    q = q.withColumn("lo", F.col("q25") - spread).withColumn("hi", F.col("q75") + spread)
    return q.groupBy(*group[:3]).agg(
        F.max("docs").alias("docs"),
        *(F.max(F.when(F.col("feature") == f, F.col(x))).alias(f"{x}_{f}") for f in FEATURES for x in ("lo", "hi")))


def judged(d: DataFrame) -> DataFrame:
    """Add ``kept`` to a stored table of features."""
    f = stored(fences(sketches(d)), "quality-fences")
    names = [f"{x}_{c}" for c in FEATURES for x in ("lo", "hi")]
    groups = d.select("_lang", "_source").distinct()
    pick = F.struct("docs", *names)
    own = f.where("level = 2").select(F.col("_lang").alias("l2"), F.col("_source").alias("s2"), pick.alias("own"))
    lang = f.where("level = 1").select(F.col("_lang").alias("l1"), pick.alias("lang"))
    every = f.where("level = 0").select(pick.alias("every"))
    use = groups.join(own, F.col("_lang").eqNullSafe(F.col("l2")) & F.col("_source").eqNullSafe(F.col("s2")), "left") \
        .join(lang, F.col("_lang").eqNullSafe(F.col("l1")), "left")
    everything = every.first()  # one row
    use = use.withColumn("fence", F.when(F.col("own.docs") >= LEAST, F.col("own")).when(F.col("lang.docs") >= LEAST, F.col("lang")))
    use = use.select(F.col("_lang").alias("_lk"), F.col("_source").alias("_sk"), "fence")
    same = F.col("_lang").eqNullSafe(F.col("_lk")) & F.col("_source").eqNullSafe(F.col("_sk"))
    use = stored(use, "quality-use")
    j = lookup(d, use, same, F.col("_row"))
    ok = F.lit(True)
    for c, (_, low) in FEATURES.items():
        for x, on in (("lo", low), ("hi", True)):
            if on:
                limit = F.coalesce(F.col(f"fence.{x}_{c}"), F.lit(everything["every"][f"{x}_{c}"] if everything else None).cast("long"))
                fine = F.col(c) >= limit if x == "lo" else F.col(c) <= limit
                ok = ok & F.coalesce(fine, F.lit(True))
    return j.withColumn("kept", ~F.col("base_failed") & ok).drop("_lk", "_sk", "fence")


def judge(docs: DataFrame) -> DataFrame:
    """-> doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept for every document."""
    d = stored(features(docs, ["doc_id"]), "quality-features")
    return judged(d).select("_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                            "base_failed", "kept")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents kept, with their columns.  Rows are stored with their
    features once, so texts are neither shuffled nor measured twice."""
    d = stored(features(docs, docs.columns), "quality-documents")
    return judged(d).where("kept").select(*(F.col(f"_row.`{c}`").alias(c) for c in docs.columns))
