"""Views that present the driver's tables in the shapes of the text-to-graph
data model (corpus, chat rows, timings, triples).

Every view reads whole tables; nothing is sampled or capped.  The DuckDB
twins of these views live in ``plans.catalog`` (same columns, same values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRIPLE_COLS = ["run_id", "regime", "model", "doc_id", "stmt_idx", "s", "p", "o",
               "o_kind", "o_datatype", "o_lang", "parse_status"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Rows over as many tasks as a shuffle has: what is made of each row then
    does not run in the few tasks that a compact file is read by."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def dealt_by(df: DataFrame, key: str) -> DataFrame:
    """The same by a key that the rows are joined by next: a shuffled join takes
    them as they lie and moves them no second time."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def corpus(spark: SparkSession, sf_dir: str, dealt_rows: bool = False) -> DataFrame:
    """documents -> corpus(doc_id, file_name, lang, text); CRLF folded to LF.
    ``dealt_rows``: over as many tasks as a shuffle has."""
    d = table(spark, sf_dir, "documents")
    if dealt_rows:
        d = dealt(d.select("doc_id", "lang", "text"))
    return d.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file_name"),
        "lang",
        F.regexp_replace("text", "\r\n", "\n").alias("text"),
    )


def timings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> timings(regime, model, file_name, seconds)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.lit("zero_shot_template").alias("regime"),
        F.col("event_type").alias("model"),
        F.concat(F.lit("doc_"), F.col("user_id").cast("string"), F.lit(".txt")).alias("file_name"),
        F.col("value").alias("seconds"),
    )


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> (id, messages ARRAY<STRUCT<role, content>>) ordered by turn.

    One group per conversation: bounded by the conversation, not the table.
    """
    c = table(spark, sf_dir, "conversations")
    g = c.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("t"))
    return g.select(
        F.col("conv_id").alias("id"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"),
    )


def chat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations -> chat_rows(id, raw) with raw = {"messages": [...]} JSON."""
    m = chat_messages(spark, sf_dir)
    return m.select("id", F.to_json(F.struct("messages")).alias("raw"))


def chat_rows_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chat_rows plus three broken shapes of every row (bad JSON, no messages,
    messages not a list), keyed by (id, variant)."""
    m = chat_messages(spark, sf_dir)
    ok = F.to_json(F.struct("messages"))
    turns = F.to_json(F.struct(F.col("messages").alias("turns")))
    scalar = F.to_json(F.struct(F.lit("none").alias("messages")))
    return m.select(
        "id",
        F.explode(F.array(
            F.struct(F.lit("valid").alias("variant"), ok.alias("raw")),
            F.struct(F.lit("bad_json").alias("variant"), F.concat(F.lit("{"), ok).alias("raw")),
            F.struct(F.lit("no_messages").alias("variant"), turns.alias("raw")),
            F.struct(F.lit("not_list").alias("variant"), scalar.alias("raw")),
        )).alias("r"),
    ).select("id", "r.variant", "r.raw")


def _iri(prefix: str, key) -> F.Column:
    return F.concat(F.lit(":" + prefix + "_"), key.cast("string"))


def _t(idx, p, o, kind="iri", dt=None, lang=None) -> tuple:
    """One statement about a row's subject."""
    text = F.lit(None).cast("string")
    return (idx.cast("bigint"), F.lit(p) if isinstance(p, str) else p, o, F.lit(kind), F.lit(dt) if dt else text, F.lit(lang) if lang else text)


def _statements(df: DataFrame, doc_id, s, *forms: tuple) -> DataFrame:
    """A row for each statement of each row.  Only the number of the statement is
    exploded, so what a query does not read of the statements is not made."""
    rows = df.withColumns({"_doc": doc_id, "_s": s}).withColumn("_k", F.explode(F.array(*(F.lit(i) for i in range(len(forms))))))

    def pick(at):
        out = forms[-1][at]
        for i in range(len(forms) - 2, -1, -1):
            out = F.when(F.col("_k") == i, forms[i][at]).otherwise(out)
        return out

    made = {c: pick(i) for i, c in enumerate(("stmt_idx", "p", "o", "o_kind", "o_datatype", "o_lang"))}
    return rows.select(
        F.lit("r1").alias("run_id"), F.lit("zero_shot_template").alias("regime"), F.lit("tpch").alias("model"),
        F.col("_doc").alias("doc_id"), made["stmt_idx"].alias("stmt_idx"), F.col("_s").alias("s"),
        *[made[c].alias(c) for c in ("p", "o", "o_kind", "o_datatype", "o_lang")], F.lit("ok").alias("parse_status"))


def kg_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TPC-H tables as restoration graphs.

    One graph per customer (``cust_<key>``): the customer as project owner and
    its orders as restoration measures with their lineitem links.  One
    ``catalog`` graph describes parts (dam/weir/gate), suppliers and nations.
    Drift is planted on purpose: ``:ProjectOwner`` (case), ``:projectOwnr``
    (unknown class), ``:endssAt`` (alias), suppliers ``isLocatedOn`` a nation
    (domain fault), weirs with a height (weir is no structure).
    """
    cust = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    li = dealt_by(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_orderkey")
    part = table(spark, sf_dir, "part")
    supp = table(spark, sf_dir, "supplier")
    measures = dealt(orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice"))
    nation = table(spark, sf_dir, "nation")

    cdoc = F.concat(F.lit("cust_"), F.col("c_custkey").cast("string"))
    cs = _iri("customer", F.col("c_custkey"))
    ctype = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", ":ProjectOwner")
             .when(F.col("c_mktsegment") == "FURNITURE", ":projectOwnr").otherwise(":projectOwner"))
    c_rows = _statements(
        cust, cdoc, cs,
        _t(F.lit(0), "rdf:type", ctype),
        _t(F.lit(1), "skos:prefLabel", F.col("c_name"), "literal", None, "en"))

    oc = measures.join(cust.select("c_custkey", "c_nationkey"), measures.o_custkey == cust.c_custkey)
    odoc = F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"))
    os_ = _iri("order", F.col("o_orderkey"))
    base = F.col("o_orderkey") * 100
    start = F.to_date("o_orderdate")
    o_rows = _statements(
        oc, odoc, os_,
        _t(base, "rdf:type", F.lit(":restorationMeasure")),
        _t(base + 1, ":isManagedBy", _iri("customer", F.col("o_custkey"))),
        _t(base + 2, ":startsAt", F.date_format(start, "yyyy-MM-dd"), "literal", "xsd:dateTime"),
        _t(base + 3, F.when(F.col("o_orderstatus") == "F", ":endssAt").otherwise(":endsAt"),
           F.date_format(F.date_add(start, 30), "yyyy-MM-dd"), "literal", "xsd:dateTime"),
        _t(base + 4, ":hasCost", F.col("o_totalprice").cast("decimal(18,2)").cast("string"), "literal", "xsd:decimal"),
        _t(base + 5, ":realizedIn", _iri("nation", F.col("c_nationkey"))))

    lo = li.join(orders.select("o_orderkey", "o_custkey"), li.l_orderkey == orders.o_orderkey)
    ldoc = F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"))
    ls = _iri("order", F.col("l_orderkey"))
    lbase = F.col("l_orderkey") * 100 + 10 + 2 * F.col("l_linenumber")
    l_rows = _statements(
        lo, ldoc, ls,
        _t(lbase, ":associatedTo", _iri("part", F.col("l_partkey"))),
        _t(lbase + 1, ":hasMainContractor", _iri("supplier", F.col("l_suppkey"))))

    cat = F.lit("catalog")
    ps = _iri("part", F.col("p_partkey"))
    pbase = F.col("p_partkey") * 10
    ptype = F.when(F.col("p_size") % 3 == 0, ":dam").when(F.col("p_size") % 3 == 1, ":weir").otherwise(":gate")
    height = (F.col("p_size").cast("decimal(9,1)") / 10).cast("decimal(9,1)").cast("string")
    p_rows = _statements(
        part, cat, ps,
        _t(pbase, "rdf:type", ptype),
        _t(pbase + 1, "skos:prefLabel", F.col("p_name"), "literal", None, "en"),
        _t(pbase + 2, ":hasHeight", height, "literal", "xsd:decimal"),
        _t(pbase + 3, ":isImpassable", F.when(F.col("p_size") > 25, "true").otherwise("false"), "literal", "xsd:boolean"))

    ss = _iri("supplier", F.col("s_suppkey"))
    sbase = F.col("s_suppkey") * 10 + 5
    s_rows = _statements(
        supp, cat, ss,
        _t(sbase, "rdf:type", F.lit(":mainContractor")),
        _t(sbase + 1, "skos:prefLabel", F.col("s_name"), "literal", None, "en"),
        _t(sbase + 2, ":isLocatedOn", _iri("nation", F.col("s_nationkey"))))

    ns = _iri("nation", F.col("n_nationkey"))
    nbase = -(F.col("n_nationkey") * 10) - 10
    n_rows = _statements(
        nation, cat, ns,
        _t(nbase, "rdf:type", F.lit(":geographicZone")),
        _t(nbase - 1, "skos:prefLabel", F.col("n_name"), "literal", None, "en"))

    out = c_rows
    for rows in (o_rows, l_rows, p_rows, s_rows, n_rows):
        out = out.unionByName(rows)
    return out


def model_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as answers of several models: doc = part, model = return flag,
    triple = (part, suppliedBy, supplier).  Repeats are kept (a multigraph)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.lit("r1").alias("run_id"), F.lit("zero_shot").alias("regime"),
        F.col("l_returnflag").alias("model"),
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("doc_id"),
        F.col("l_linenumber").cast("bigint").alias("stmt_idx"),
        _iri("part", F.col("l_partkey")).alias("s"), F.lit(":suppliedBy").alias("p"),
        _iri("supplier", F.col("l_suppkey")).alias("o"),
        F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_datatype"),
        F.lit(None).cast("string").alias("o_lang"), F.lit("ok").alias("parse_status"),
    )
