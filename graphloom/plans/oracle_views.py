"""DuckDB SQL for the driver views of ``sources.driver_views``.

Each entry is the body of a CTE; ``with_views(sql, names)`` prefixes a query
with the CTEs it needs.  Values and column names equal the Spark views.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["corpus"] = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS file_name, lang,
       replace(text, chr(13) || chr(10), chr(10)) AS text
FROM documents"""

VIEWS["timings"] = """
SELECT 'zero_shot_template' AS regime, event_type AS model, 'doc_' || CAST(user_id AS VARCHAR) || '.txt' AS file_name,
       value AS seconds
FROM events"""

VIEWS["chat_messages"] = """
SELECT conv_id AS id, list({'role': role, 'content': text} ORDER BY turn) AS messages
FROM conversations GROUP BY conv_id"""

_T = "'r1' AS run_id, 'zero_shot_template' AS regime, 'tpch' AS model"

VIEWS["kg_triples"] = f"""
SELECT {_T}, doc_id, CAST(stmt_idx AS BIGINT) AS stmt_idx, s, p, o, o_kind, o_datatype, o_lang, 'ok' AS parse_status FROM (
  SELECT 'cust_' || c_custkey AS doc_id, 0 AS stmt_idx, ':customer_' || c_custkey AS s, 'rdf:type' AS p,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ':ProjectOwner' WHEN c_mktsegment = 'FURNITURE' THEN ':projectOwnr'
              ELSE ':projectOwner' END AS o, 'iri' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype, CAST(NULL AS VARCHAR) AS o_lang
  FROM customer
  UNION ALL SELECT 'cust_' || c_custkey, 1, ':customer_' || c_custkey, 'skos:prefLabel', c_name, 'literal', NULL, 'en' FROM customer
  UNION ALL SELECT 'cust_' || o_custkey, o_orderkey * 100, ':order_' || o_orderkey, 'rdf:type', ':restorationMeasure', 'iri', NULL, NULL FROM orders
  UNION ALL SELECT 'cust_' || o_custkey, o_orderkey * 100 + 1, ':order_' || o_orderkey, ':isManagedBy', ':customer_' || o_custkey, 'iri', NULL, NULL FROM orders
  UNION ALL SELECT 'cust_' || o_custkey, o_orderkey * 100 + 2, ':order_' || o_orderkey, ':startsAt', strftime(o_orderdate, '%Y-%m-%d'), 'literal', 'xsd:dateTime', NULL FROM orders
  UNION ALL SELECT 'cust_' || o_custkey, o_orderkey * 100 + 3, ':order_' || o_orderkey,
         CASE WHEN o_orderstatus = 'F' THEN ':endssAt' ELSE ':endsAt' END,
         strftime(CAST(o_orderdate AS DATE) + INTERVAL 30 DAY, '%Y-%m-%d'), 'literal', 'xsd:dateTime', NULL FROM orders
  UNION ALL SELECT 'cust_' || o_custkey, o_orderkey * 100 + 4, ':order_' || o_orderkey, ':hasCost',
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), 'literal', 'xsd:decimal', NULL FROM orders
  UNION ALL SELECT 'cust_' || o_custkey, o_orderkey * 100 + 5, ':order_' || o_orderkey, ':realizedIn', ':nation_' || c_nationkey, 'iri', NULL, NULL
         FROM orders JOIN customer ON o_custkey = c_custkey
  UNION ALL SELECT 'cust_' || o_custkey, l_orderkey * 100 + 10 + 2 * l_linenumber, ':order_' || l_orderkey, ':associatedTo', ':part_' || l_partkey, 'iri', NULL, NULL
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'cust_' || o_custkey, l_orderkey * 100 + 11 + 2 * l_linenumber, ':order_' || l_orderkey, ':hasMainContractor', ':supplier_' || l_suppkey, 'iri', NULL, NULL
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION ALL SELECT 'catalog', p_partkey * 10, ':part_' || p_partkey, 'rdf:type',
         CASE WHEN p_size % 3 = 0 THEN ':dam' WHEN p_size % 3 = 1 THEN ':weir' ELSE ':gate' END, 'iri', NULL, NULL FROM part
  UNION ALL SELECT 'catalog', p_partkey * 10 + 1, ':part_' || p_partkey, 'skos:prefLabel', p_name, 'literal', NULL, 'en' FROM part
  UNION ALL SELECT 'catalog', p_partkey * 10 + 2, ':part_' || p_partkey, ':hasHeight',
         CAST(CAST(CAST(p_size AS DECIMAL(9,1)) / 10 AS DECIMAL(9,1)) AS VARCHAR), 'literal', 'xsd:decimal', NULL FROM part
  UNION ALL SELECT 'catalog', p_partkey * 10 + 3, ':part_' || p_partkey, ':isImpassable',
         CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END, 'literal', 'xsd:boolean', NULL FROM part
  UNION ALL SELECT 'catalog', s_suppkey * 10 + 5, ':supplier_' || s_suppkey, 'rdf:type', ':mainContractor', 'iri', NULL, NULL FROM supplier
  UNION ALL SELECT 'catalog', s_suppkey * 10 + 6, ':supplier_' || s_suppkey, 'skos:prefLabel', s_name, 'literal', NULL, 'en' FROM supplier
  UNION ALL SELECT 'catalog', s_suppkey * 10 + 7, ':supplier_' || s_suppkey, ':isLocatedOn', ':nation_' || s_nationkey, 'iri', NULL, NULL FROM supplier
  UNION ALL SELECT 'catalog', -(n_nationkey * 10) - 10, ':nation_' || n_nationkey, 'rdf:type', ':geographicZone', 'iri', NULL, NULL FROM nation
  UNION ALL SELECT 'catalog', -(n_nationkey * 10) - 11, ':nation_' || n_nationkey, 'skos:prefLabel', n_name, 'literal', NULL, 'en' FROM nation
) u"""

VIEWS["model_triples"] = """
SELECT 'r1' AS run_id, 'zero_shot' AS regime, l_returnflag AS model, 'part_' || l_partkey AS doc_id,
       CAST(l_linenumber AS BIGINT) AS stmt_idx, ':part_' || l_partkey AS s, ':suppliedBy' AS p,
       ':supplier_' || l_suppkey AS o, 'iri' AS o_kind, CAST(NULL AS VARCHAR) AS o_datatype,
       CAST(NULL AS VARCHAR) AS o_lang, 'ok' AS parse_status
FROM lineitem"""

# Dependencies between views, so that with_views() emits them in order.
DEPENDS = {"chat_rows": ["chat_messages"]}

VIEWS["chat_rows"] = """
SELECT id, CAST(json_object('messages', messages) AS VARCHAR) AS raw FROM chat_messages"""


def with_views(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with CTEs for the named views (and ``extra`` CTEs)."""
    order: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in order]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v}\n)")
    if not parts:
        return sql
    return "WITH " + ",\n".join(parts) + "\n" + sql


# ---------------------------------------------------------------- ontology tables
def _values(rows, cols: str) -> str:
    def lit(v):
        return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({cols})"


def _onto_views():
    from graphloom import vocab
    from graphloom.operators.conform import BUILTIN_TERMS, RANGE_COMPAT
    cls = vocab.classes()
    props = vocab.properties()
    VIEWS["onto_class"] = _values([(n,) for n, *_ in cls], "name")
    VIEWS["onto_subclass"] = _values([(n, p) for n, ps, *_ in cls for p in ps], "child, parent")
    VIEWS["onto_property"] = _values([(n, k) for n, k, _, _ in props], "name, kind")
    VIEWS["onto_domain"] = _values([(n, d) for n, _, ds, _ in props for d in ds], "property, cls")
    VIEWS["onto_range"] = _values([(n, r) for n, _, _, rs in props for r in rs], "property, rng")
    VIEWS["onto_restriction"] = _values(vocab.restrictions(), "cls, property, filler")
    VIEWS["onto_alias"] = _values(vocab.aliases(), "alias, term")
    VIEWS["builtin_terms"] = _values([(b.lower(), b) for b in BUILTIN_TERMS], "blkey, bcanon")
    VIEWS["range_compat"] = _values(RANGE_COMPAT, "rng_local, dt")


_onto_views()

LOCAL_RE_SQL = r"^<?(?:[^#>]*#|[A-Za-z][\w.-]*:|:)?([^>]*)>?$"

VIEWS["closure"] = """
SELECT child, ancestor, depth FROM (
  WITH RECURSIVE c(child, ancestor, depth) USING KEY (child, ancestor) AS (
    SELECT DISTINCT child, parent, 1 FROM onto_subclass
    UNION
    SELECT c.child, s.parent, min(c.depth) + 1 FROM c JOIN onto_subclass s ON c.ancestor = s.child
    LEFT JOIN recurring.c k ON k.child = c.child AND k.ancestor = s.parent
    WHERE k.child IS NULL GROUP BY c.child, s.parent)
  SELECT * FROM c)"""
DEPENDS["closure"] = ["onto_subclass"]

VIEWS["closure_r"] = """
SELECT child, ancestor, depth FROM closure UNION ALL SELECT name, name, 0 FROM onto_class"""
DEPENDS["closure_r"] = ["closure", "onto_class"]

VIEWS["plk"] = """
SELECT lkey, canon, via, kind AS p_kind0 FROM (
  SELECT lkey, canon, CASE WHEN prio = 0 THEN 'term' ELSE 'alias' END AS via,
         row_number() OVER (PARTITION BY lkey ORDER BY prio, canon) AS rn FROM (
    SELECT lower(name) AS lkey, name AS canon, 0 AS prio FROM onto_property
    UNION ALL SELECT lower(a.alias), a.term, 1 FROM onto_alias a JOIN onto_property p ON a.term = p.name)) x
JOIN onto_property p ON x.canon = p.name WHERE rn = 1"""
DEPENDS["plk"] = ["onto_property", "onto_alias"]

VIEWS["clk"] = """
SELECT lkey, canon, via FROM (
  SELECT lkey, canon, CASE WHEN prio = 0 THEN 'term' ELSE 'alias' END AS via,
         row_number() OVER (PARTITION BY lkey ORDER BY prio, canon) AS rn FROM (
    SELECT lower(name) AS lkey, name AS canon, 0 AS prio FROM onto_class
    UNION ALL SELECT lower(a.alias), a.term, 1 FROM onto_alias a JOIN onto_class c ON a.term = c.name)) WHERE rn = 1"""
DEPENDS["clk"] = ["onto_class", "onto_alias"]


def canon_view(src: str, name: str = "canon") -> None:
    """Register a CTE ``name`` = N3 canonicalisation of the triples CTE ``src``."""
    VIEWS[name] = f"""
SELECT t2.*, CASE WHEN t2.is_type THEN CASE WHEN c.canon IS NULL THEN 'unknown' WHEN c.via = 'alias' THEN 'alias'
                 WHEN c.canon = t2.o_key THEN 'exact' ELSE 'case' END END AS o_match,
       CASE WHEN t2.is_type THEN c.canon END AS o_canon
FROM (
  SELECT t1.*, coalesce(b.bcanon, ':' || pl.canon, t1.p) AS p_canon,
         CASE WHEN b.bcanon IS NOT NULL THEN 'builtin' WHEN pl.canon IS NULL THEN 'unknown' WHEN pl.via = 'alias' THEN 'alias'
              WHEN pl.canon = t1.p_local THEN 'exact' ELSE 'case' END AS p_match,
         CASE WHEN b.bcanon IS NOT NULL THEN 'builtin' ELSE pl.p_kind0 END AS p_kind,
         coalesce(b.bcanon, ':' || pl.canon, t1.p) = 'rdf:type' AS is_type
  FROM (
    SELECT t.*, regexp_replace(trim(p), '{LOCAL_RE_SQL}', '\\1') AS p_local,
           regexp_replace(trim(s), '{LOCAL_RE_SQL}', '\\1') AS s_key,
           CASE WHEN o_kind <> 'literal' THEN regexp_replace(trim(o), '{LOCAL_RE_SQL}', '\\1') END AS o_key,
           CASE WHEN trim(p) = 'a' THEN 'rdf:type' ELSE lower(trim(p)) END AS p_low
    FROM {src} t) t1
  LEFT JOIN builtin_terms b ON t1.p_low = b.blkey
  LEFT JOIN plk pl ON lower(t1.p_local) = pl.lkey AND b.bcanon IS NULL) t2
LEFT JOIN clk c ON t2.is_type AND lower(t2.o_key) = c.lkey"""
    DEPENDS[name] = [src, "builtin_terms", "plk", "clk"]


canon_view("kg_triples", "canon")
canon_view("model_triples", "mcanon")

VIEWS["types"] = """
SELECT DISTINCT run_id, regime, model, doc_id, s_key, r.ancestor AS cls
FROM (SELECT DISTINCT run_id, regime, model, doc_id, s_key, o_canon AS cls FROM canon
      WHERE p_canon = 'rdf:type' AND o_match <> 'unknown') a
JOIN closure_r r ON a.cls = r.child"""
DEPENDS["types"] = ["canon", "closure_r"]
