"""Conformance of generated triples to the ontology.

N3 canonicalise, J3 types, J4 properties, J5 domain/range, J6 restrictions,
J7 dangling references, J8 isolated individuals, N18 typed literals,
N21 height rule, J15 individual resolution.

Joins with the ontology carry no hint: the built-in tables are local relations
of known size, which Spark broadcasts by its own threshold, and a large one
read from a file is not forced on every task.  Joins between graph data are
keyed by (graph, individual), never by graph alone, so one huge graph still
spreads over many tasks; individuals that hold much of the statements themselves
are found by a sketch and their rows dealt over all tasks (``skew.split_join``).
That is for graphs of more than ``skew.WHOLE`` statements.  J5, J6 and J15 move what
they need of a smaller graph once, to one task, and look things up there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.session import local_table, stored

from graphloom.functions.literals import datatype_local, type_literal, value_type
from graphloom.operators.ontology import GRAPH, Ontology, infer_types, subclass_closure
from graphloom.operators.skew import by_size, gathered, hot_keys, split_join

RDF_TYPE = "rdf:type"

# FIXED VALUES: built-in RDF/RDFS/SKOS/OWL terms accepted as predicates, by lower-cased spelling.
BUILTIN_TERMS = ["rdf:type", "rdfs:label", "rdfs:comment", "rdfs:seeAlso", "skos:prefLabel", "skos:altLabel",
                 "skos:definition", "skos:note", "owl:sameAs"]

# FIXED VALUES: literal datatypes accepted for each range type (besides an exact match).
RANGE_COMPAT = [("real", "decimal"), ("real", "integer"), ("real", "float"), ("real", "double"),
                ("decimal", "integer"), ("float", "decimal"), ("float", "double"), ("float", "integer"),
                ("double", "decimal"), ("double", "float"), ("double", "integer"), ("dateTime", "date"),
                ("dateTime", "gYear"), ("dateTime", "gYearMonth")]

# FIXED VALUES: accented letters and their plain forms, used to fold individual names.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿœ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyo"


def local_name(term: str | Column) -> Column:
    """':x', 'pre:x', '<...#x>', '<x>', '<:x>' -> 'x' (plain string
    functions: this runs on every statement)."""
    t = F.trim(F.col(term) if isinstance(term, str) else term)
    inner = F.regexp_replace(F.substr(t, F.lit(2)), ">$", "")  # <...> without brackets
    bracket = (F.when(F.instr(inner, "#") > 0, F.substring_index(inner, "#", -1))
               .when(inner.startswith(":"), F.substr(inner, F.lit(2)))
               .when(inner.rlike("^[A-Za-z][\\w.-]*:"), F.substr(inner, F.instr(inner, ":") + 1))
               .otherwise(inner))
    colon = F.instr(t, ":")
    plain = F.when(t.startswith(":"), F.substr(t, F.lit(2))) \
        .when((colon > 1) & F.substr(t, F.lit(1), colon - 1).rlike("^[A-Za-z][\\w.-]*$"), F.substr(t, colon + 1)) \
        .otherwise(t)
    return F.when(t.startswith("<"), bracket).otherwise(plain)


def _lookup(spark, terms: DataFrame, aliases: DataFrame) -> DataFrame:
    """lower(key) -> (canon, via); one row per key, terms win over aliases."""
    t = terms.select(F.lower("name").alias("lkey"), F.col("name").alias("canon"), F.lit(0).alias("prio"))
    a = aliases.join(terms.select(F.col("name").alias("term")), "term") \
        .select(F.lower("alias").alias("lkey"), F.col("term").alias("canon"), F.lit(1).alias("prio"))
    best = t.unionByName(a).groupBy("lkey").agg(F.min(F.struct("prio", "canon")).alias("b"))
    return best.select("lkey", F.col("b.canon").alias("canon"),
                       F.when(F.col("b.prio") == 0, "term").otherwise("alias").alias("via"))


def _fixed_lookups(spark, fixed: dict):
    """``_lookup`` for the built-in ontology, as literal tables."""
    kinds = dict(fixed["properties"])

    def best(names):
        rows: dict[str, tuple[int, str]] = {}
        for n in names:
            rows[n.lower()] = min(rows.get(n.lower(), (9, "")), (0, n)) if n.lower() in rows else (0, n)
        for a, t in fixed["aliases"]:
            if t in names and a.lower() not in rows:
                rows[a.lower()] = (1, t)
            elif t in names:
                rows[a.lower()] = min(rows[a.lower()], (1, t))
        return [(k, c, "term" if p == 0 else "alias") for k, (p, c) in sorted(rows.items())]

    props = set(kinds)
    plk = local_table(spark, [(k, c, v, kinds[c]) for k, c, v in best(props)],
                      "lkey string, canon string, via string, p_kind0 string")
    clk = local_table(spark, best(set(fixed["classes"])), "lkey string, canon string, via string")
    return plk, clk


def canonicalise(triples: DataFrame, onto: Ontology) -> DataFrame:
    """Canonical predicate and type-object terms with how they matched.

    Adds ``s_key``/``o_key`` (local names of individuals), ``p_canon``,
    ``p_match`` (builtin|exact|case|alias|unknown), ``p_kind``
    (object|data|builtin|null) and, for ``rdf:type`` rows, ``o_canon`` and
    ``o_match`` (exact|case|alias|unknown).
    """
    spark = triples.sparkSession
    if onto.fixed is not None:
        plk, clk = _fixed_lookups(spark, onto.fixed)
    else:
        plk = _lookup(spark, onto.properties.select("name"), onto.aliases).join(
            onto.properties.select(F.col("name").alias("canon"), F.col("kind").alias("p_kind0")), "canon")
        clk = _lookup(spark, onto.classes.select("name"), onto.aliases)
    builtin = local_table(spark, [(b.lower(), b) for b in BUILTIN_TERMS], "blkey string, bcanon string")

    p_raw = F.trim(F.col("p"))
    t = triples.withColumn("_p_low", F.when(p_raw == "a", F.lit("rdf:type")).otherwise(F.lower(p_raw))) \
        .withColumn("p_local", local_name("p")) \
        .withColumn("s_key", local_name("s")) \
        .withColumn("o_key", F.when(F.col("o_kind") != "literal", local_name("o")))
    t = t.join(builtin, t._p_low == builtin.blkey, "left")
    t = t.join(plk.select(F.col("lkey").alias("_plk"), F.col("canon").alias("_pc"), F.col("via").alias("_pv"), "p_kind0"),
               (F.lower("p_local") == F.col("_plk")) & F.col("bcanon").isNull(), "left")
    p_match = (F.when(F.col("bcanon").isNotNull(), "builtin")
               .when(F.col("_pc").isNull(), "unknown")
               .when(F.col("_pv") == "alias", "alias")
               .when(F.col("_pc") == F.col("p_local"), "exact").otherwise("case"))
    t = t.withColumn("p_match", p_match) \
        .withColumn("p_canon", F.coalesce("bcanon", F.concat(F.lit(":"), "_pc"), "p")) \
        .withColumn("p_kind", F.when(F.col("bcanon").isNotNull(), "builtin").otherwise(F.col("p_kind0")))
    is_type = F.col("p_canon") == RDF_TYPE
    t = t.join(clk.select(F.col("lkey").alias("_clk"), F.col("canon").alias("_cc"), F.col("via").alias("_cv")),
               is_type & (F.lower("o_key") == F.col("_clk")), "left")
    o_match = (F.when(~is_type, F.lit(None)).when(F.col("_cc").isNull(), "unknown")
               .when(F.col("_cv") == "alias", "alias").when(F.col("_cc") == F.col("o_key"), "exact")
               .otherwise("case"))
    t = t.withColumn("o_match", o_match).withColumn("o_canon", F.when(is_type, F.col("_cc")))
    return t.drop("_p_low", "blkey", "bcanon", "_plk", "_pc", "_pv", "p_kind0", "_clk", "_cc", "_cv")


def check_types(canon: DataFrame) -> DataFrame:
    """Every rdf:type assertion with its class status (unknown = violation)."""
    return canon.where(F.col("p_canon") == RDF_TYPE).select(
        *GRAPH, "stmt_idx", "s", "o", "o_canon", F.col("o_match").alias("status"))


def check_properties(canon: DataFrame) -> DataFrame:
    """Predicate status per statement: builtin/exact/case/alias/unknown,
    or ``wrong_kind`` when an object property has a literal or a data
    property an IRI."""
    wrong = ((F.col("p_kind") == "object") & (F.col("o_kind") == "literal")) | \
            ((F.col("p_kind") == "data") & (F.col("o_kind") != "literal"))
    status = F.when(F.col("p_match").isin("exact", "case", "alias") & wrong, "wrong_kind").otherwise(F.col("p_match"))
    return canon.select(*GRAPH, "stmt_idx", "s", "p", "p_canon", "p_kind", status.alias("status"))


def property_share(canon: DataFrame) -> DataFrame:
    """Flagship: per graph run, how many statements use a known property."""
    st = check_properties(canon)
    known = F.col("status").isin("builtin", "exact", "case", "alias")
    return st.groupBy("run_id", "regime", "model").agg(
        F.count(F.lit(1)).alias("n_statements"),
        F.sum(known.cast("int")).alias("n_known"),
        F.sum((F.col("status") == "exact").cast("int")).alias("n_exact"),
        F.sum((F.col("status") == "case").cast("int")).alias("n_case"),
        F.sum((F.col("status") == "alias").cast("int")).alias("n_alias"),
        F.sum((F.col("status") == "unknown").cast("int")).alias("n_unknown"),
        F.sum((F.col("status") == "wrong_kind").cast("int")).alias("n_wrong_kind"),
        F.round(F.avg(known.cast("double")), 6).alias("known_share"))


def asserted_types(canon: DataFrame) -> DataFrame:
    """(graph, s_key, cls) from rdf:type rows with a known class."""
    return canon.where((F.col("p_canon") == RDF_TYPE) & (F.col("o_match") != "unknown")) \
        .select(*GRAPH, "s_key", F.col("o_canon").alias("cls")).distinct()


def individual_types(canon: DataFrame, onto: Ontology) -> DataFrame:
    """Asserted types widened by the subclass closure (J10 inference)."""
    return infer_types(asserted_types(canon), subclass_closure(onto, reflexive=True))


def check_domain_range(canon: DataFrame, onto: Ontology, strict: bool = False, columns: tuple = ("stmt_idx", "s", "o")) -> DataFrame:
    """Domain and range status per statement of an ontology property.

    Domain (any listed class suffices; ``strict`` demands all, the OWL
    reading): ok | violation | untyped (subject has no known type in its
    graph) | none (no domain declared).  Range for object properties the same
    on the object; for data properties: ok | violation | untyped_literal
    (no datatype written) | none.  ``columns`` of the statements are carried.

    What a statement tells by itself is decided where it is read; the rest needs
    the types of its subject and of its object, which lie in the same graph.
    """
    small, large = by_size(canon, GRAPH)
    out = _domain_range_gathered(small, onto, strict, columns)
    if large is not None:
        out = out.unionByName(_domain_range_joined(large, onto, strict, columns))
    last = [c for c in columns if c == "o"]
    return out.select(*GRAPH, *[c for c in columns if c not in last], "p_canon", *last, "domain_status", "range_status")


def _with_own_range(props: DataFrame, onto: Ontology) -> DataFrame:
    """Adds ``n_dom`` and ``_range``, the range status where a statement tells it by
    itself; null where the object's types decide."""
    rng = onto.range
    n_dom = onto.domain.groupBy(F.col("property").alias("prop")).agg(F.count(F.lit(1)).alias("n_dom"))
    dat_rng = rng.where(F.col("rng").contains(":")).select(F.col("property").alias("prop"),
                                                         F.regexp_replace("rng", "^[a-z]+:", "").alias("rng_local"))
    has_rng = rng.select(F.col("property").alias("prop")).distinct().withColumn("_has_rng", F.lit(True))
    compat = local_table(props.sparkSession, RANGE_COMPAT, "rng_local string, dt string")
    dt_ok = dat_rng.join(compat, "rng_local", "left") \
        .select("prop", F.explode(F.array_distinct(F.array("rng_local", F.coalesce("dt", "rng_local")))).alias("dt"))
    dt_ok = dt_ok.distinct().withColumn("_dsat", F.lit(True))
    t = props.join(n_dom, "prop", "left").join(has_rng, "prop", "left") \
        .withColumn("dt", datatype_local(F.col("o_datatype"))).join(dt_ok, ["prop", "dt"], "left")
    is_lit = F.col("o_kind") == "literal"
    own = (F.when(F.col("_has_rng").isNull(), "none")
           .when(F.col("p_kind") == "object", F.when(is_lit, "violation"))
           .when(~is_lit, "violation")
           .when(F.col("o_datatype").isNull(), "untyped_literal")
           .when(F.col("_dsat").isNotNull(), "ok").otherwise("violation"))
    return t.withColumn("_range", own).drop("_has_rng", "dt", "_dsat")


def _is_property() -> Column:
    return F.coalesce(F.col("p_match").isin("exact", "case", "alias"), F.lit(False))


def _is_known_type() -> Column:
    return F.coalesce((F.col("p_canon") == RDF_TYPE) & (F.col("o_match") != "unknown"), F.lit(False))


def _domain_range_gathered(canon: DataFrame, onto: Ontology, strict: bool, columns: tuple) -> DataFrame:
    """J5 where each graph fits a task: its statements are moved once."""
    typing = _is_known_type() & _known([*GRAPH, "s_key"])
    rows = canon.where(_is_property() | typing) \
        .withColumn("prop", F.when(_is_property(), F.regexp_replace("p_canon", "^:", ""))).withColumn("_cls", F.when(~_is_property(), F.col("o_canon")))
    rows = _with_own_range(rows, onto)
    # (what is not asked of a row is not moved)
    asks = F.col("prop").isNotNull() & F.col("_range").isNull()
    rows = rows.select(*GRAPH, *[F.when(F.col("prop").isNotNull(), F.col(c)).alias(f"_c{i}") for i, c in enumerate(columns)], "s_key", F.when(asks, F.col("o_key")).alias("o_key"),
                       F.when(F.col("prop").isNotNull(), F.col("p_canon")).alias("p_canon"), F.when(F.col("prop").isNotNull(), F.col("n_dom")).alias("n_dom"),
                       F.when(F.col("prop").isNotNull(), F.col("_range")).alias("_range"), "_cls")
    up = subclass_closure(onto, reflexive=True).select(F.col("child").alias("_cls"), F.col("ancestor").alias("cls"))
    dom = up.join(onto.domain, "cls").groupBy("_cls").agg(F.collect_set(F.struct("property", "cls")).alias("_dom"))
    of = up.join(onto.range.where(~F.col("rng").contains(":")).select("property", F.col("rng").alias("cls")), "cls") \
        .groupBy("_cls").agg(F.collect_set("property").alias("_rng"))
    # (stored: a table of classes whose size is known, or it could be joined by moving the statements)
    facts = stored(up.select("_cls").distinct().join(dom, "_cls", "left").join(of, "_cls", "left").withColumn("_typed", F.lit(True)), "class-facts")
    t = gathered(rows, GRAPH).join(facts, "_cls", "left").withColumn("prop", F.regexp_replace("p_canon", "^:", ""))

    subject = Window.partitionBy("doc_id", "s_key", "model", "regime", "run_id")
    t = t.withColumn("_dom", F.flatten(F.collect_set("_dom").over(subject))).withColumn("_subject", F.max("_typed").over(subject))
    held = F.filter("_dom", lambda x: x["property"] == F.col("prop"))
    enough = F.size(F.array_distinct(held)) >= F.col("n_dom") if strict else F.size(held) > 0
    t = t.withColumn("domain_status", F.when(F.col("n_dom").isNull(), "none").when(enough, "ok").when(F.col("_subject").isNull(), "untyped").otherwise("violation")) \
        .drop("_dom", "_subject").withColumn("_key", F.when(F.col("prop").isNull(), F.col("s_key")).otherwise(F.col("o_key")))
    object_ = Window.partitionBy("doc_id", "_key", "model", "regime", "run_id")
    t = t.withColumn("_rng", F.flatten(F.collect_set("_rng").over(object_))).withColumn("_object", F.max("_typed").over(object_)).where("prop is not null")
    named = F.col("o_key").isNotNull() & _known(GRAPH)
    rstat = F.coalesce("_range", F.when(named & F.array_contains("_rng", F.col("prop")), "ok").when(~named | F.col("_object").isNull(), "untyped").otherwise("violation"))
    return t.select(*GRAPH, *[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], "p_canon", "domain_status", rstat.alias("range_status"))


def _domain_range_joined(canon: DataFrame, onto: Ontology, strict: bool, columns: tuple) -> DataFrame:
    """J5 for graphs of any size.  Each typed individual is summarised once -- the
    properties whose domain (and, separately, range) its types satisfy -- so the
    statements are shuffled twice: once by subject, once by object."""
    types = individual_types(canon, onto)
    props = canon.where(F.col("p_match").isin("exact", "case", "alias")) \
        .withColumn("prop", F.regexp_replace("p_canon", "^:", ""))
    dom = onto.domain
    n_dom = dom.groupBy("property").agg(F.count(F.lit(1)).alias("n_dom"))
    # per typed individual: properties whose domain it satisfies (ontology-bounded set)
    # types holds each (individual, class) once, so a plain count is the number of distinct classes
    sat = types.join(dom, "cls", "left").groupBy(*GRAPH, "s_key", "property") \
        .agg(F.count("cls").alias("n_sat"))
    sat = sat.join(n_dom, "property", "left")
    ok_prop = F.when(F.col("property").isNotNull() & (F.col("n_sat") >= (F.col("n_dom") if strict else F.lit(1))),
                     F.col("property"))
    subj = sat.groupBy(*GRAPH, "s_key").agg(F.collect_set(ok_prop).alias("_dom_ok"))

    obj_rng = onto.range.where(~F.col("rng").contains(":")).select("property", F.col("rng").alias("cls"))
    obj = types.join(obj_rng, "cls", "left").groupBy(*GRAPH, F.col("s_key").alias("o_key")) \
        .agg(F.collect_set("property").alias("_rng_ok"))

    hot_s, hot_o = hot_keys(props, [*GRAPH, "s_key"], [*GRAPH, "o_key"])
    t = _with_own_range(props, onto).select(*GRAPH, *columns, "s_key", F.when(F.col("_range").isNull(), F.col("o_key")).alias("o_key"), "p_canon", "prop", "n_dom", "_range")
    dstat = (F.when(F.col("n_dom").isNull(), "none").when(F.array_contains("_dom_ok", F.col("prop")), "ok")
             .when(F.col("_dom_ok").isNull(), "untyped").otherwise("violation"))
    t = split_join(t, subj, [*GRAPH, "s_key"], "left", hot_s).withColumn("domain_status", dstat) \
        .select(*GRAPH, *columns, "o_key", "p_canon", "prop", "domain_status", "_range")
    # literals and what is decided have no key: they skip that join instead of meeting under null
    named = split_join(t.where("o_key is not null"), obj, [*GRAPH, "o_key"], "left", hot_o)
    decided = t.where("o_key is null").withColumn("_rng_ok", F.lit(None).cast("array<string>"))
    t = named.unionByName(decided)
    rstat = F.coalesce("_range", F.when(F.array_contains("_rng_ok", F.col("prop")), "ok").when(F.col("_rng_ok").isNull(), "untyped").otherwise("violation"))
    return t.select(*GRAPH, *columns, "p_canon", "domain_status", rstat.alias("range_status"))


def check_restrictions(canon: DataFrame, onto: Ontology) -> DataFrame:
    """Expected (property, filler) from the someValuesFrom restrictions on
    each individual's (inferred) classes: ``present`` if the graph states the
    property for it, ``filled`` if with an object of the filler's class, or of
    its datatype.  Coverage, not errors: absence is not falsity (open world)."""
    small, large = by_size(canon, GRAPH)
    out = _restrictions_gathered(small, onto)
    return out if large is None else out.unionByName(_restrictions_joined(large, onto))


def _of_restricted(canon: DataFrame, onto: Ontology) -> DataFrame:
    """Statements of properties that a restriction names, with ``property`` (no others are asked for)."""
    return canon.where(_is_property()).withColumn("property", F.regexp_replace("p_canon", "^:", "")) \
        .join(onto.restriction.select("property"), "property", "left_semi")


def _restrictions_gathered(canon: DataFrame, onto: Ontology) -> DataFrame:
    """J6 where each graph fits a task: what is asked of it is moved once."""
    asked = onto.restriction.select(F.col("property").alias("_asked")).distinct()
    rows = canon.where(_is_property() | _is_known_type()) \
        .withColumn("property", F.when(_is_property() & _known([*GRAPH, "s_key"]), F.regexp_replace("p_canon", "^:", ""))) \
        .withColumn("_cls", F.when(~_is_property(), F.col("o_canon")))
    rows = rows.join(asked, F.col("property") == F.col("_asked"), "left").where("_cls is not null or _asked is not null")
    stated = F.col("_asked").isNotNull()
    rows = rows.select(*GRAPH, "s_key", F.col("_asked").alias("property"), F.when(stated & (F.col("o_kind") != "literal"), F.col("o_key")).alias("o_key"),
                       F.when(stated, datatype_local(F.col("o_datatype"))).alias("_dt"), "_cls")
    up = subclass_closure(onto, reflexive=True).select(F.col("child").alias("_cls"), F.col("ancestor").alias("cls"))
    expected = up.join(onto.restriction, "cls").groupBy("_cls").agg(F.collect_set(F.struct("property", "filler")).alias("_expected"))
    fills = up.join(onto.restriction.select(F.col("filler").alias("cls")).distinct(), "cls").groupBy("_cls").agg(F.collect_set("cls").alias("_fills"))
    # (stored: a table of classes whose size is known, or it could be joined by moving the statements)
    facts = stored(expected.join(fills, "_cls", "full"), "class-facts")
    t = gathered(rows, GRAPH, once=True).join(facts, "_cls", "left")

    subject = Window.partitionBy("doc_id", "s_key", "model", "regime", "run_id")
    wanted = F.filter(F.array_distinct(F.flatten(F.collect_set("_expected").over(subject))), lambda x: x["property"] == F.col("property"))
    t = t.withColumn("_wanted", F.when(F.col("property").isNull(), F.col("_expected")).otherwise(wanted)).drop("_expected") \
        .withColumn("_key", F.when(F.col("property").isNull(), F.col("s_key")).otherwise(F.col("o_key")))
    object_ = Window.partitionBy("doc_id", "_key", "model", "regime", "run_id")
    t = t.withColumn("_fills", F.flatten(F.collect_set("_fills").over(object_)))
    t = t.select(*GRAPH, "s_key", F.col("property").isNotNull().alias("present"), "o_key", "_dt", "_fills", F.inline("_wanted"))
    filled = F.when(F.col("o_key").isNotNull(), F.array_contains("_fills", F.col("filler"))) \
        .otherwise(F.col("_dt").isNotNull() & (F.regexp_replace("filler", "^[a-z]+:", "") == F.col("_dt")))
    return t.groupBy(*GRAPH, "s_key", "property", "filler").agg(
        F.max(F.coalesce(F.col("present") & filled, F.lit(False))).alias("filled"), F.max("present").alias("present"))


def _restrictions_joined(canon: DataFrame, onto: Ontology) -> DataFrame:
    """J6 for graphs of any size."""
    types = individual_types(canon, onto)
    exp = types.join(onto.restriction, "cls").select(*GRAPH, "s_key", "property", "filler").distinct()
    stated = _of_restricted(canon, onto) \
        .select(*GRAPH, "s_key", "property",
                F.when(F.col("o_kind") != "literal", F.col("o_key")).alias("o_key"),
                datatype_local(F.col("o_datatype")).alias("_dt")).distinct()
    hot_p, hot_o = hot_keys(stated, [*GRAPH, "s_key", "property"], [*GRAPH, "o_key"])
    found = split_join(stated, exp, [*GRAPH, "s_key", "property"], "inner", hot_p)
    of = types.select(*GRAPH, F.col("s_key").alias("o_key"), F.col("cls").alias("filler"))
    # literals have no class: only statements with an individual meet the types
    by_class = split_join(found.where("o_key is not null").withColumnRenamed("filler", "wanted"),
                          of.groupBy(*GRAPH, "o_key").agg(F.collect_set("filler").alias("_classes")), [*GRAPH, "o_key"], "left", hot_o) \
        .withColumnRenamed("wanted", "filler").withColumn("_is", F.array_contains("_classes", F.col("filler")))
    by_type = found.where("o_key is null").withColumn(
        "_is", F.col("_dt").isNotNull() & (F.regexp_replace("filler", "^[a-z]+:", "") == F.col("_dt")))
    seen = by_class.select(*GRAPH, "s_key", "property", "filler", "_is") \
        .unionByName(by_type.select(*GRAPH, "s_key", "property", "filler", "_is")) \
        .groupBy(*GRAPH, "s_key", "property", "filler").agg(F.max(F.coalesce("_is", F.lit(False))).alias("filled"))
    return exp.join(seen.withColumn("present", F.lit(True)), [*GRAPH, "s_key", "property", "filler"], "left") \
        .fillna(False, ["present", "filled"])


def _edges(canon: DataFrame) -> DataFrame:
    """Object-property edges between individuals (IRI objects, not rdf:type)."""
    return canon.where((F.col("o_kind") != "literal") & (F.col("p_canon") != RDF_TYPE))


def dangling_refs(canon: DataFrame) -> DataFrame:
    """Object IRIs never described as a subject in the same graph."""
    subjects = canon.select(*GRAPH, F.col("s_key").alias("o_key")).distinct()
    # counted before the join: a popular object is one row there
    refs = _edges(canon).groupBy(*GRAPH, "o_key").agg(F.count(F.lit(1)).alias("n_refs"))
    return refs.join(subjects, [*GRAPH, "o_key"], "left_anti")


def isolated_individuals(canon: DataFrame) -> DataFrame:
    """Described individuals with no object-property edge in or out."""
    e = _edges(canon)
    ends = e.select(*GRAPH, "s_key").unionByName(e.select(*GRAPH, F.col("o_key").alias("s_key"))).distinct()
    subjects = canon.select(*GRAPH, "s_key").distinct()
    return subjects.join(ends, [*GRAPH, "s_key"], "left_anti")


def type_literals(canon: DataFrame, onto: Ontology) -> DataFrame:
    """Typed values of literal objects (by the property's range, else the
    written datatype), lexical form kept in ``o``."""
    rng = onto.range.where(F.col("rng").contains(":")) \
        .select(F.concat(F.lit(":"), "property").alias("p_canon"),
                F.regexp_replace("rng", "^[a-z]+:", "").alias("rng_local"))
    rng = rng.groupBy("p_canon").agg(F.min("rng_local").alias("rng_local"))
    lit = canon.where(F.col("o_kind") == "literal").join(rng, "p_canon", "left")
    vt = value_type(F.col("rng_local"), datatype_local(F.col("o_datatype")))
    lit = lit.withColumn("value_type", vt).withColumn("tv", type_literal(F.col("o"), F.col("value_type")))
    return lit.select("*", "tv.*").drop("tv", "rng_local")


def derive_impassable(canon: DataFrame, onto: Ontology, threshold: float = 1.0) -> DataFrame:
    """A structure is impassable when its height is strictly greater
    than ``threshold`` metres; compare with the asserted ``isImpassable``.

    One aggregation keyed by (graph, individual) instead of a self join.  A
    height without a unit is in metres; ``cm`` and ``mm`` are converted, and an
    individual whose only heights have another unit gets ``unknown_unit``.
    """
    typed = type_literals(canon.where(F.col("p_canon").isin(":hasHeight", ":isImpassable")), onto)
    unit = F.lower(F.trim("unit"))
    scale = (F.when(unit.isNull() | unit.isin("m", "metre", "metres", "meter", "meters", "mètre", "mètres"), F.lit(1))
             .when(unit == "cm", F.lit(100)).when(unit == "mm", F.lit(1000)))
    is_height = F.col("p_canon") == ":hasHeight"
    g = typed.groupBy(*GRAPH, "s_key").agg(
        F.max(F.when(is_height, (F.col("v_decimal") / scale).cast("decimal(38,18)"))).alias("height"),
        F.max((is_height & F.col("v_decimal").isNotNull() & scale.isNull()).cast("int")).alias("_odd_unit"),
        F.max(F.when(F.col("p_canon") == ":isImpassable", F.col("v_bool").cast("int"))).alias("_asserted"))
    derived = F.when(F.col("height").isNotNull(), F.col("height") > F.lit(threshold))
    asserted = F.col("_asserted") == 1
    status = (F.when(derived.isNull() & (F.col("_odd_unit") == 1), "unknown_unit").when(derived.isNull(), "no_height").when(F.col("_asserted").isNull(), "no_assertion")
              .when(derived == asserted, "agree").otherwise("conflict"))
    return g.select(*GRAPH, "s_key", "height", asserted.alias("asserted"), derived.alias("derived"),
                    status.alias("status"))


def fold_name(c: str | Column) -> Column:
    """Case, accents and punctuation folded away; letters and digits of every
    script stay."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.translate(F.lower(x), ACCENTED, PLAIN), r"[^\p{L}\p{N}]", "")


def resolve_individuals(canon: DataFrame) -> DataFrame:
    """Map each individual of a graph to the smallest name sharing its
    folded key; returns (graph, s_key, canonical, n_variants).  A name without
    a letter or digit folds to nothing and stands for itself."""
    edge = (F.col("o_kind") != "literal") & (F.col("p_canon") != RDF_TYPE)
    names = canon.select(*GRAPH, F.explode(F.when(edge, F.array("s_key", "o_key")).otherwise(F.array("s_key"))).alias("s_key")) \
        .where(_known([*GRAPH, "s_key"]))  # (null is no name)
    fold = F.coalesce(F.nullif(fold_name("s_key"), F.lit("")), F.col("s_key"))
    small, large = by_size(names, GRAPH)
    same = gathered(small, GRAPH, once=True).groupBy(*GRAPH, fold.alias("fold")).agg(F.collect_list("s_key").alias("_same"))
    out = same.select(*GRAPH, F.explode("_same").alias("s_key"), F.array_min("_same").alias("canonical"), F.size("_same").cast("long").alias("n_variants"))
    if large is None:
        return out
    inds = stored(large.distinct().withColumn("fold", fold), "individuals")  # the sketch and both sides of the join read it
    best = inds.groupBy(*GRAPH, "fold").agg(F.min("s_key").alias("canonical"),
                                            F.count(F.lit(1)).alias("n_variants"))
    return out.unionByName(split_join(inds, best, [*GRAPH, "fold"], "inner").drop("fold"))


def _known(cols: list) -> Column:
    return reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in cols])


def apply_resolution(canon: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rewrite s_key/o_key with the canonical names of ``resolve_individuals``."""
    m = mapping.select(*GRAPH, "s_key", "canonical")
    hot_s, hot_o = hot_keys(canon, [*GRAPH, "s_key"], [*GRAPH, "o_key"])
    out = split_join(canon, m, [*GRAPH, "s_key"], "left", hot_s).withColumn("s_key", F.coalesce("canonical", "s_key")).drop("canonical")
    mo = m.withColumnRenamed("s_key", "o_key").withColumnRenamed("canonical", "o_canonical")
    # literals have no key: they skip the join instead of meeting under null
    named = split_join(out.where("o_key is not null"), mo, [*GRAPH, "o_key"], "left", hot_o)
    literal = out.where("o_key is null").withColumn("o_canonical", F.lit(None).cast("string"))
    return named.unionByName(literal).withColumn("o_key", F.coalesce("o_canonical", "o_key")).drop("o_canonical")
