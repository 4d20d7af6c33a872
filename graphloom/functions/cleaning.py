"""N19 clean_response, N20 flag_placeholders: JVM-side text classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FENCE = r"```[A-Za-z]*[ \t]*\n([\s\S]*?)```"
#: The same, read faster: a dot for every character instead of a union of two classes.
FENCE_READ = "(?s)" + FENCE.replace(r"[\s\S]", ".")
TURTLE_HINT = r"(?m)(^\s*@prefix\s|^\s*PREFIX\s|^\s*[:\w-]*:[^\s]*\s+(a|[\w-]*:[\w-]+)\s)"
RDFXML_HINT = r"<rdf:RDF|<\?xml|<owl:Ontology"
WHITE = " \t\n\x0b\f\r"
PLACEHOLDER = r":<[^>\s]*>|<\"[^\"]*\">|<add [^>]*>"


def clean_response(text: str | Column) -> Column:
    """struct(body, format): the fenced bodies joined (prose around them
    dropped), else the whole text, without prefix lines that repeat an earlier
    one; format = turtle | rdfxml | prose | empty."""
    t = F.col(text) if isinstance(text, str) else text
    # (the arrays hold a value: it is not made again wherever it is read)
    joined = F.element_at(F.transform(F.array(F.regexp_extract_all(t, F.lit(FENCE_READ), 1)),
                                      lambda found: F.when(F.size(found) > 0, F.array_join(found, "\n")).otherwise(t)), 1)
    whole = F.transform(F.array(F.btrim(joined, F.lit(WHITE))), drop_repeated_prefixes)

    def read(body: Column) -> Column:
        fmt = (F.when(body.isNull() | (body == ""), "empty")
               .when(body.rlike(RDFXML_HINT), "rdfxml")
               .when(body.rlike(TURTLE_HINT), "turtle")
               .otherwise("prose"))
        return F.struct(body.alias("body"), fmt.alias("format"))

    return F.element_at(F.transform(whole, read), 1)


PREFIX_LINE = r"^\s*(?:@prefix|PREFIX)\s"


def drop_repeated_prefixes(body: Column) -> Column:
    """The body without ``@prefix`` / ``PREFIX`` lines equal to an earlier line."""
    lines = F.split(body, "\n", -1)
    # only prefix lines look back, and a body has a handful of them
    first = F.element_at(F.transform(F.array(lines), lambda a: F.filter(
        a, lambda x, i: F.when(x.rlike(PREFIX_LINE), F.array_position(a, x) == i + 1).otherwise(True))), 1)
    return F.when(body.rlike("(?m)" + PREFIX_LINE), F.array_join(first, "\n")).otherwise(body)


def flag_placeholders(triples: DataFrame) -> DataFrame:
    """Template placeholders left unfilled (``:<StructureInstance>``,
    ``<"StartDateTime">``, ``<add ...>``) in subject, predicate or object."""
    hit = F.col("s").rlike(PLACEHOLDER) | F.col("p").rlike(PLACEHOLDER) | F.col("o").rlike(PLACEHOLDER)
    return triples.withColumn("placeholder", hit)


def placeholder_count(text: str | Column) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.size(F.regexp_extract_all(t, F.lit("(" + PLACEHOLDER + ")"), 1))
