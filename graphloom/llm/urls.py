"""Operator 6 [native]: URL filter, rules first, then gradient-boosted trees on
lexical features.

A rule fits its host and all subdomains where the URL's path starts with the
rule's; the longest rule that fits decides.  All other URLs are judged by trees
on length, depth, digit ratio, entropy, parameter and host-part counts and
suffix statistics (the blocked share of the labelled URLs under the same last
one and two host parts).

Labelled URLs come from the caller (``labelled``: url, label 1 for block), or
else from the table itself: what a rule decides has the rule's label, a host
with one of the ``SEEDS`` words is blocked, and every other URL counts as
allowed (positive and unlabelled learning).  Statistics cover all labelled
URLs, for a labelled URL those of other hosts only; the trees are fitted on a
bounded sample of distinct URLs of each label (``SAMPLE``, by hash order).

Defined results: a null URL, or one without "://", has an empty host and path,
fits no rule with a path and is judged by its features; repeated URLs get the
same verdict; an empty table gives no rows; labels of one kind only give that
verdict to all that no rule decides; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import lookup
from graphloom.session import stored

#: Distinct URLs of each label that the trees are fitted on.
SAMPLE = 10_000
#: Host words that mark a labelled bad URL.
SEEDS = ("casino", "pills", "adult", "ads", "track", "porn", "viagra")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Weight of the overall share in a suffix's smoothed share.
SMOOTH = 20.0
NUMBERS = ["f_length", "f_host", "f_path", "f_depth", "f_digits", "f_entropy", "f_params", "f_parts", "f_hyphens",
           "f_https", "f_fragment", "f_dots", "f_longest", "f_share1", "f_share2", "f_seen2"]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without "://"."""
    at = F.instr(url, "://")
    tail = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    return (F.translate(F.regexp_extract(tail, r"^([^/?#]*)", 1), UPPER, LOWER),
            F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def entropy(s: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    chars = F.split(s, "")
    n = F.length(s).cast("double")
    shares = F.transform(F.array_distinct(chars), lambda c: (F.length(s) - F.length(F.replace(s, c, F.lit("")))) / n)
    return F.when(n > 0, F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(0.0))).otherwise(0.0)


def lexical(d: DataFrame) -> DataFrame:
    """Add the features that a URL has by itself (columns url, host, path)."""
    u = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    parts = F.split("host", r"\.")
    digits = F.regexp_count(u, F.lit("[0-9]"))
    return d.withColumns({
        "f_length": F.length(u), "f_host": F.length("host"), "f_path": F.length("path"),
        "f_depth": F.regexp_count("path", F.lit("/[^/]")), "f_digits": F.coalesce(digits / F.nullif(F.length(u), F.lit(0)), F.lit(0.0)),
        "f_entropy": entropy(F.col("host")), "f_params": F.when(query == "", 0).otherwise(F.regexp_count(query, F.lit("&")) + 1),
        "f_parts": F.size(parts), "f_hyphens": F.regexp_count("host", F.lit("-")), "f_https": F.startswith(u, F.lit("https:")).cast("int"),
        "f_fragment": F.instr(u, "#").cast("boolean").cast("int"), "f_dots": F.regexp_count("path", F.lit(r"\.")),
        "f_longest": F.coalesce(F.array_max(F.transform(parts, lambda x: F.length(x))), F.lit(0)),
        "_suffix1": F.substring_index("host", ".", -1), "_suffix2": F.substring_index("host", ".", -2)})


def suffix_counts(labelled: DataFrame) -> dict[str, DataFrame]:
    """Blocked and all labelled URLs by last one and two host parts (1, 2), and by host (0)."""
    out = {}
    for k, c in (("0", "host"), ("1", "_suffix1"), ("2", "_suffix2")):
        g = labelled.groupBy(F.col(c).alias(f"_k{k}")).agg(F.sum("label").alias(f"_bad{k}"), F.count(F.lit(1)).alias(f"_n{k}"))
        out[k] = stored(g, "suffix-counts")
    return out


def with_shares(d: DataFrame, counts: dict[str, DataFrame], overall: float, own: bool) -> DataFrame:
    """Add blocked share and count of the labelled URLs under the same suffixes;
    ``own``: without those of the URL's own host, so that a label is never told
    by itself or by its copies."""
    for k, c in (("0", "host"), ("1", "_suffix1"), ("2", "_suffix2")):
        d = lookup(d, counts[k], F.col(c) == F.col(f"_k{k}"), F.col("url")).drop(f"_k{k}")
    d = d.fillna(0, [f"_{x}{k}" for x in ("bad", "n") for k in "012"])
    for k in "12":
        bad, n = (F.col(f"_{x}{k}") - (F.col(f"_{x}0") if own else F.lit(0)) for x in ("bad", "n"))
        d = d.withColumns({f"f_share{k}": (bad + SMOOTH * overall) / (n + SMOOTH), f"f_seen{k}": F.log1p(n)})
    return d.drop(*[f"_{x}{k}" for x in ("bad", "n") for k in "012"])


def sampled(train: DataFrame) -> DataFrame:
    """Up to ``SAMPLE`` distinct URLs of each label, by hash order, with the number of their rows."""
    distinct = train.groupBy(*[c for c in train.columns if c not in ("page_id", "_ruled", "rule")]).agg(F.count(F.lit(1)).cast("double").alias("_weight"))
    parts = [distinct.where(F.col("label") == k).orderBy(F.xxhash64("url"), "url").limit(SAMPLE) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], labelled: DataFrame | None = None,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """-> page_id, host, path, rule, verdict, score (the trees' probability of block)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    def prepared(t: DataFrame, *cols: Column) -> DataFrame:
        host, path = host_path(F.col("url"))
        d = t.select(*cols, "url").withColumns({"host": host, "path": path})
        rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
        return lexical(d.withColumns({"rule": rule, "_ruled": verdict}))

    all_urls = stored(prepared(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), F.col("page_id")), "urls")
    if labelled is None:
        seeded = F.lit(False)
        for w in SEEDS:
            seeded = seeded | F.col("host").contains(w)
        train = all_urls.withColumn("label", F.when(F.col("_ruled").isNotNull(), F.col("_ruled") == "block").otherwise(seeded).cast("int"))
    else:
        train = prepared(labelled.select(F.col("label").cast("int"), "url"), F.col("label")).where("label is not null")
    n, bad = train.agg(F.count(F.lit(1)), F.sum("label")).first()
    overall = (bad or 0) / n if n else 0.0
    result = ["page_id", "host", "path", "rule", F.coalesce("_ruled", F.when(F.col("_score") > 0.5, "block").otherwise("allow")).alias("verdict"),
              F.col("_score").alias("score")]
    if overall in (0.0, 1.0):  # labels of one kind: nothing to fit
        return all_urls.withColumn("_score", F.lit(overall)).select(*result)

    counts = suffix_counts(train)
    vectors = VectorAssembler(inputCols=NUMBERS, outputCol="_x")
    rows = stored(with_shares(sampled(train), counts, overall, True).select("label", "_weight", *NUMBERS), "url-sample")
    model = GBTClassifier(featuresCol="_x", labelCol="label", weightCol="_weight", maxIter=15, maxDepth=4, stepSize=0.2, seed=7) \
        .fit(vectors.transform(rows).select("label", "_weight", "_x"))
    # labels taken from the table itself are not known of the URL that is judged
    scored = model.transform(vectors.transform(with_shares(all_urls, counts, overall, labelled is None)))
    return scored.withColumn("_score", vector_to_array("probability")[1]).select(*result)
