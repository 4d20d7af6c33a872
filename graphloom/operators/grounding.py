"""J12 ontology-label mentions in text, J13 grounding of graph values in
their source text, J14 leakage of the worked example, U4 rule extraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.literals import MONTHS_EN, MONTHS_FR, parse_date, parse_number
from graphloom.operators.conform import fold_name, local_name
from graphloom.operators.ontology import GRAPH, Ontology
from graphloom.operators.skew import split_join

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def tokens(text: str | Column) -> Column:
    """Lower-cased letter/digit runs (array_remove: no lambda, stays in codegen)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(t), TOKEN_SPLIT), "")


def label_table(onto: Ontology) -> DataFrame:
    """Ontology labels with their token form and token count (ontology-sized)."""
    lab = onto.labels.withColumn("_t", tokens("label"))
    return lab.select("term", "label", "lang", "kind", F.array_join("_t", " ").alias("gram"),
                      F.size("_t").alias("n")).where(F.col("n") > 0)


#: First tokens of labels that are looked for inside the row, at most.
MOST_FIRSTS = 20_000


def link_mentions(docs: DataFrame, onto: Ontology) -> DataFrame:
    """Token n-grams of each text equal to an ontology label.

    The text's token array is walked inside its row, and only tokens that begin
    a label leave it, with as many tokens after them as the longest label has;
    those meet the labels of their first token and are compared whole.  No other
    token becomes a row and none is shuffled.  (An ontology of more than
    ``MOST_FIRSTS`` first tokens is met by a join instead of inside the row.)
    Returns (doc_id, pos, n, mention, term, label_lang, label_kind).
    """
    labels = label_table(onto).withColumn("first", F.element_at(F.split("gram", " "), 1))
    longest = labels.agg(F.max("n")).first()[0] or 1
    firsts = [r[0] for r in labels.select("first").distinct().limit(MOST_FIRSTS + 1).collect()]

    def begins(t):
        at = F.transform(t, lambda x, i: F.struct((i + 1).alias("pos"), x.alias("tok")))
        if len(firsts) <= MOST_FIRSTS:
            at = F.filter(at, lambda s: s["tok"].isin(firsts))
        return F.transform(at, lambda s: F.struct(s["pos"].alias("pos"), s["tok"].alias("tok"),
                                                  F.slice(t, s["pos"], F.lit(longest)).alias("after")))

    # the outer transform holds the token array as a variable: it is made once per text
    places = F.element_at(F.transform(F.array(tokens("text")), begins), 1)
    toks = docs.select("doc_id", F.explode(places).alias("_t")).select("doc_id", "_t.*")
    cand = toks.join(labels.select("first", "gram", "n", "term", F.col("lang").alias("label_lang"),
                                   F.col("kind").alias("label_kind")), toks.tok == F.col("first"))
    hit = cand.where((F.size("after") >= F.col("n")) & (F.array_join(F.slice("after", 1, F.col("n")), " ") == F.col("gram")))
    return hit.select("doc_id", "pos", "n", F.col("gram").alias("mention"), "term", "label_lang", "label_kind")


def fold_text(c: str | Column) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(F.lower(x), r"\s+", " "))


def grounding(triples: DataFrame, docs: DataFrame) -> DataFrame:
    """Is each literal of a graph found in its source text (case and
    whitespace folded)?  Whole texts, folded once, meet the literals of their
    graphs by doc_id: literals and texts are moved once, and a literal is folded
    where it is looked for.  A literal without a value has no finding."""
    lit = triples.where((F.col("o_kind") == "literal") & F.col("o").isNotNull())
    return lit.join(docs.select("doc_id", fold_text("text").alias("_ft")), "doc_id") \
        .withColumn("grounded", F.instr("_ft", fold_text("o")) > 0).drop("_ft")


#: Numbers and dates as texts write them; what N18 parses, cut out of running text.
# Each begins with the characters it may begin with: most places of a text are left at once.
TEXT_NUMBER = (r"(?=[-0-9])(?<![0-9.,])-?(?:[0-9]{1,3}(?:[ ,\u00a0\u202f][0-9]{3})+(?:\.[0-9]+)?|[0-9]{1,3}(?:[ \u00a0\u202f][0-9]{3})*,[0-9]+|[0-9]+(?:\.[0-9]+)?)"
               r"(?![0-9]|[.,][0-9])")


def _one_of(words: list[str]) -> str:
    """A pattern for any of the words, equal beginnings written once."""
    if words == [""]:
        return ""
    firsts = sorted({w[:1] for w in words})
    rest = [c + _one_of([w[1:] for w in words if w[:1] == c]) if c else "" for c in reversed(firsts)]
    return rest[0] if len(rest) == 1 else "(?:" + "|".join(rest) + ")"


_MONTHS = sorted({*MONTHS_EN, *MONTHS_FR})
_NAMES = _one_of(_MONTHS)
TEXT_DATE = (rf"(?i)(?=[0-9{''.join(sorted({m[0] for m in _MONTHS}))}])(?:(?<![0-9-])[0-9]{{4}}-[0-9]{{2}}(?:-[0-9]{{2}})?(?![0-9-])"
             rf"|(?<![0-9])(?:[0-9]{{1,2}}(?:er)?\s+)?(?:{_NAMES})\s+(?:[0-9]{{1,2}}(?:st|nd|rd|th)?,?\s+)?[0-9]{{4}}(?![0-9]))")
TEXT_YEAR = r"(?=[0-9])(?<![0-9.,])[0-9]{4}(?![0-9]|[.,][0-9])"


def _date_keys(value: Column, precision: Column) -> Column:
    """A date as (precision, start) and as every coarser one that holds it."""
    day, month, year = (F.date_format(value, f) for f in ("yyyy-MM-dd", "yyyy-MM", "yyyy"))
    return F.when(precision == "year", F.array(year)).when(precision == "month", F.array(month, year)) \
        .when(value.isNotNull(), F.array(day, month, year))


def text_values(docs: DataFrame) -> DataFrame:
    """The typed spans of whole texts, each once: (doc_id, kind, value) with kind
    ``number`` (plain decimal) or ``date`` (yyyy, yyyy-MM or yyyy-MM-dd; a day
    also stands as its month and year, a four-digit number as a year)."""
    spans = lambda p: F.regexp_extract_all(F.col("text"), F.lit(p), 0)
    # (explode would make the optimiser ask first whether the array is empty, by making it)
    kinds = F.explode_outer(F.concat(
        F.transform(spans(TEXT_NUMBER), lambda x: F.struct(F.lit("number").alias("kind"), x.alias("lex"))),
        F.transform(spans(TEXT_DATE), lambda x: F.struct(F.lit("date").alias("kind"), x.alias("lex"))),
        F.transform(spans(TEXT_YEAR), lambda x: F.struct(F.lit("date").alias("kind"), x.alias("lex")))))
    found = docs.select("doc_id", kinds.alias("x")).where("x is not null").select("doc_id", "x.*").distinct()
    # (the array holds the parsed date as a value: it is not parsed again for each key)
    dates = F.element_at(F.transform(F.array(parse_date(F.col("lex"))), lambda d: _date_keys(d["value"], d["precision"])), 1)
    # numbers and dates in one pass: as two branches each would cut the texts again
    keys = F.when(F.col("kind") == "number", F.array(parse_number(F.col("lex"))["value"].cast("string"))).otherwise(dates)
    return found.select("doc_id", "kind", F.explode_outer(keys).alias("value")).where("value is not null").distinct()


def grounding_by_value(typed: DataFrame, docs: DataFrame) -> DataFrame:
    """J13 by value: literals typed by N18 (``type_literals``: value_type,
    v_decimal, v_integer, v_date, date_precision) are grounded if their text holds
    the same number or date, however written; what has no typed value is looked
    for as text (``grounding``).  Values meet the texts' spans by equality on
    (doc_id, kind, value)."""
    typed_as = F.struct(F.coalesce(F.col("v_decimal"), F.col("v_integer").cast("decimal(38,18)")).cast("string").alias("number"),
                        F.col("v_date").alias("day"), F.col("date_precision").alias("precision"))

    def key(t):
        date = F.element_at(_date_keys(t["day"], t["precision"]), 1)
        return F.when(t["number"].isNotNull(), F.struct(F.lit("number").alias("kind"), t["number"].alias("value"))) \
            .when(date.isNotNull(), F.struct(F.lit("date").alias("kind"), date.alias("value")))

    lit = typed.withColumn("_k", F.element_at(F.transform(F.array(typed_as), key), 1)) \
        .withColumns({"kind": F.col("_k.kind"), "value": F.col("_k.value")}).drop("_k")
    by_value = split_join(lit.where("kind is not null"), text_values(docs).withColumn("_in", F.lit(True)), ["doc_id", "kind", "value"], "left")
    by_value = by_value.withColumn("grounded", F.coalesce("_in", F.lit(False))).drop("_in", "kind", "value")
    by_text = grounding(lit.where("kind is null").drop("kind", "value"), docs)
    return by_value.unionByName(by_text.select(*by_value.columns))


def grounding_share(grounded: DataFrame) -> DataFrame:
    return grounded.groupBy(*GRAPH).agg(F.count(F.lit(1)).alias("n_literals"),
                                        F.sum(F.col("grounded").cast("int")).alias("n_grounded"),
                                        F.avg(F.col("grounded").cast("double")).alias("grounded_share"))


def example_keys(example_triples: DataFrame) -> DataFrame:
    """Folded names and labels of the worked example's individuals."""
    names = example_triples.select(fold_name(local_name("s")).alias("k"))
    labels = example_triples.where(F.col("o_kind") == "literal") \
        .where(F.col("p").isin("skos:prefLabel", "rdfs:label")).select(fold_name("o").alias("k"))
    return names.unionByName(labels).where(F.col("k") != "").distinct()


def example_leakage(triples: DataFrame, docs: DataFrame, example_triples: DataFrame) -> DataFrame:
    """Statements whose subject name or label equals (folded) an
    individual of the worked example, unless the value is grounded in the
    document's own text."""
    keys = example_keys(example_triples)
    t = triples.withColumn("_k", F.when((F.col("o_kind") == "literal") &
                                        F.col("p").isin("skos:prefLabel", "rdfs:label"), fold_name("o"))
                           .otherwise(fold_name(local_name("s"))))
    hit = t.join(keys, t._k == keys.k, "left_semi")
    g = hit.join(docs.select("doc_id", fold_text("text").alias("_ft")), "doc_id", "left")
    val = F.when(F.col("o_kind") == "literal", F.col("o")).otherwise(local_name("s"))
    g = g.withColumn("grounded", F.coalesce(F.instr("_ft", fold_text(val)) > 0, F.lit(False)))
    return g.where(~F.col("grounded")).drop("_ft", "_k", "grounded")


COST_RE = r"([0-9][0-9  .,]*[0-9]|[0-9]) ?(?:€|euros?|EUR)"
YEAR_RE = r"(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])"


def extract_rules(docs: DataFrame, onto: Ontology, regime: str = "rules", model: str = "rules") -> DataFrame:
    """U4: a model-free extractor -> triples in the common schema.

    Each document is one restoration measure ``:doc_<id>``; ontology labels
    found in its text (J12) become typed individuals linked to it; costs
    ("231 000 €") become ``hasCost``; the first and last year become
    ``startsAt``/``endsAt``.  Joins and regular expressions only.
    """
    m = link_mentions(docs, onto).where(F.col("label_kind").isNotNull())
    # two terms may share a label, and one term two: the term is part of the name, once each
    m = m.select("doc_id", "pos", "n", "mention", "term").distinct()
    ind = F.concat(F.lit(":m_"), F.col("doc_id"), F.lit("_"), F.col("pos").cast("string"), F.lit("_"),
                   F.col("n").cast("string"), F.lit("_"), F.col("term"))
    at = F.col("pos").cast("bigint") * (1 << 22) + F.pmod(F.xxhash64("n", "term"), F.lit(1 << 20)) * 4
    meas = F.concat(F.lit(":doc_"), F.col("doc_id"))

    def row(s, p, o, kind="iri", dt=None, idx=F.lit(0)):
        return F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"),
                        F.lit(dt).cast("string").alias("o_datatype"), F.lit(None).cast("string").alias("o_lang"),
                        idx.cast("bigint").alias("stmt_idx"))

    ment = m.select("doc_id", F.explode(F.array(
        row(ind, "rdf:type", F.concat(F.lit(":"), F.col("term")), idx=at),
        row(ind, "skos:prefLabel", F.col("mention"), "literal", idx=at + 1),
        row(meas, ":includes", ind, idx=at + 2))).alias("t"))
    costs = F.regexp_extract_all(F.col("text"), F.lit(COST_RE), 1)
    years = F.transform(F.regexp_extract_all(F.col("text"), F.lit(YEAR_RE), 1), lambda y: y.cast("int"))
    d = docs.select("doc_id", costs.alias("costs"), years.alias("years"))
    base = d.select("doc_id", F.explode(F.concat(
        F.array(row(meas, "rdf:type", F.lit(":restorationMeasure"), idx=F.lit(-1))),
        F.transform("costs", lambda c, i: row(meas, ":hasCost", c, "literal", "xsd:decimal", idx=-10 - i)),
        F.filter(F.array(
            row(meas, ":startsAt", F.array_min("years").cast("string"), "literal", "xsd:dateTime", F.lit(-2)),
            row(meas, ":endsAt", F.array_max("years").cast("string"), "literal", "xsd:dateTime", F.lit(-3))),
            lambda r: r["o"].isNotNull()))).alias("t"))
    allt = ment.unionByName(base)
    return allt.select(F.lit("r_rules").alias("run_id"), F.lit(regime).alias("regime"), F.lit(model).alias("model"),
                       "doc_id", "t.stmt_idx", "t.s", "t.p", "t.o", "t.o_kind", "t.o_datatype", "t.o_lang",
                       F.lit("ok").alias("parse_status"))
