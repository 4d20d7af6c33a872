"""Typed values of literal objects, with the lexical form kept.

Costs come as "36 700 € HT", "€36,700.00", "87,000€", "171,000"; dates as
"2010-09", "2011", "August 2010", "January 1st, 1995", "12 mars 2011",
"2011-08-01T00:00:00Z"; heights as "12.2m".  Nothing is guessed: a partial
date keeps its precision, a currency or unit stays in ``unit``.
All parsing is regular expressions and try-casts on the JVM side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: month names (English, then French) in calendar order.
MONTHS_EN = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
             "november", "december"]
MONTHS_FR = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre",
             "novembre", "décembre"]

# FIXED VALUES: words read as booleans.
TRUE_WORDS = ["true", "1", "yes", "oui", "vrai"]
FALSE_WORDS = ["false", "0", "no", "non", "faux"]

NUM_RUN = r"(-?[0-9](?:[0-9 ,.\u00a0\u202f]*[0-9])?)"
THOUSANDS = r"^-?[0-9]{1,3}(?:[ ,\u00a0\u202f][0-9]{3})+(?:\.[0-9]+)?$"
FR_THOUSANDS_DEC = r"^-?[0-9]{1,3}(?:[ \u00a0\u202f][0-9]{3})*,[0-9]+$"

DECIMAL_TYPES = ["decimal", "real", "float", "double", "integer", "int", "long", "nonNegativeInteger"]
DATE_TYPES = ["dateTime", "date", "gYear", "gYearMonth", "gMonth", "DateTime"]


def parse_number(lex: Column) -> Column:
    """struct(value DECIMAL(38,18), unit STRING) from a number with separators/currency/unit."""
    run = F.regexp_extract(lex, NUM_RUN, 1)
    unit = F.trim(F.regexp_replace(F.regexp_replace(lex, NUM_RUN, ""), r"\s+", " "))
    plain = F.regexp_replace(run, r"[ \u00a0\u202f]", "")
    norm = (F.when(run.rlike(THOUSANDS), F.regexp_replace(plain, ",", ""))
            .when(run.rlike(FR_THOUSANDS_DEC), F.regexp_replace(plain, ",", "."))
            .otherwise(plain))
    value = F.when(run != "", norm.try_cast("decimal(38,18)"))
    return F.struct(value.alias("value"), F.when(unit != "", unit).alias("unit"))


def _month_number(name: Column) -> Column:
    pairs = []
    for i, (en, fr) in enumerate(zip(MONTHS_EN, MONTHS_FR), start=1):
        pairs += [F.lit(en), F.lit(i), F.lit(fr), F.lit(i)]
    return F.element_at(F.create_map(*pairs), name)


def parse_date(lex: Column) -> Column:
    """struct(value DATE, precision STRING in year|month|day|second).

    Two patterns: ISO (``2010``, ``2010-09``, ``2010-09-01``, with a time),
    and worded (``August 2010``, ``January 1st, 1995``, ``12 mars 2011``).
    """
    t = F.lower(F.trim(lex))
    names = "|".join(MONTHS_EN + MONTHS_FR)
    iso = r"^([0-9]{4})(?:-([0-9]{2})(?:-([0-9]{2})([t ][0-9]{2}:[0-9]{2}.*)?)?)?$"
    wrd = rf"^(?:([0-9]{{1,2}})(?:er)?\s+)?({names})\s+(?:([0-9]{{1,2}})(?:st|nd|rd|th)?,?\s+)?([0-9]{{4}})$"
    is_iso = t.rlike(iso)
    is_wrd = t.rlike(wrd)

    def gi(i):
        return F.regexp_extract(t, iso, i)

    def gw(i):
        return F.regexp_extract(t, wrd, i)

    w_day = F.when(gw(1) != "", gw(1)).otherwise(gw(3))
    y = F.when(is_iso, gi(1)).when(is_wrd, gw(4))
    m = F.when(is_iso, F.when(gi(2) != "", gi(2)).otherwise("01")).when(is_wrd, _month_number(gw(2)).cast("string"))
    d = F.when(is_iso, F.when(gi(3) != "", gi(3)).otherwise("01")) \
        .when(is_wrd, F.when(w_day != "", w_day).otherwise("01"))
    precision = (F.when(is_iso, F.when(gi(4) != "", "second").when(gi(3) != "", "day").when(gi(2) != "", "month")
                        .otherwise("year"))
                 .when(is_wrd, F.when(w_day != "", "day").otherwise("month")))
    iso_txt = F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    value = F.try_to_timestamp(iso_txt, F.lit("yyyy-MM-dd")).cast("date")
    return F.struct(value.alias("value"), F.when(value.isNotNull(), precision).alias("precision"))


def parse_bool(lex: Column) -> Column:
    t = F.lower(F.trim(lex))
    return F.when(t.isin(TRUE_WORDS), F.lit(True)).when(t.isin(FALSE_WORDS), F.lit(False))


def datatype_local(dt: Column) -> Column:
    """'xsd:decimal', '<...XMLSchema#decimal>', 'xsd:DateTime' -> 'decimal' / 'DateTime'."""
    return F.regexp_replace(dt, r"^<?(?:[^#>]*#|[A-Za-z][\w.-]*:)?([^>]*)>?$", "$1")


def value_type(range_local: Column, dt_local: Column) -> Column:
    """The type to read a literal as: the property's range when the ontology
    gives one, else the datatype written on the literal, else string."""
    t = F.coalesce(range_local, dt_local)
    return (F.when(t.isin(DECIMAL_TYPES) & ~t.isin("integer", "int", "long", "nonNegativeInteger"), "decimal")
            .when(t.isin("integer", "int", "long", "nonNegativeInteger"), "integer")
            .when(t.isin(DATE_TYPES), "date").when(t == "boolean", "boolean").otherwise("string"))


def type_literal(lex: Column, vtype: Column) -> Column:
    """struct(v_decimal, v_integer, v_date, date_precision, v_bool, unit, parsed)."""
    # fast paths: a clean number casts directly; an ISO day parses directly
    trimmed = F.trim(lex)
    dec_fast = trimmed.try_cast("decimal(38,18)")
    iso_day = (F.length(trimmed) == 10) & (F.substr(trimmed, F.lit(5), F.lit(1)) == "-")
    date_fast = F.when(iso_day, F.try_to_timestamp(trimmed, F.lit("yyyy-MM-dd")).cast("date"))
    slow_num = parse_number(lex)
    slow_dat = parse_date(lex)
    num = F.struct(F.coalesce(dec_fast, slow_num["value"]).alias("value"),
                   F.when(dec_fast.isNull(), slow_num["unit"]).alias("unit"))
    dat = F.struct(F.coalesce(date_fast, slow_dat["value"]).alias("value"),
                   F.when(date_fast.isNotNull(), F.lit("day")).otherwise(slow_dat["precision"]).alias("precision"))
    b = parse_bool(lex)
    is_dec = vtype == "decimal"
    is_int = vtype == "integer"
    is_date = vtype == "date"
    is_bool = vtype == "boolean"
    v_dec = F.when(is_dec, num["value"])
    whole = num["value"].cast("decimal(20,0)")
    v_int = F.when(is_int, F.coalesce(trimmed.try_cast("bigint"), F.when(whole == num["value"], whole.try_cast("bigint"))))
    v_date = F.when(is_date, dat["value"])
    v_bool = F.when(is_bool, b)
    parsed = (F.when(is_dec, v_dec.isNotNull()).when(is_int, v_int.isNotNull()).when(is_date, v_date.isNotNull())
              .when(is_bool, v_bool.isNotNull()).otherwise(F.lit(True)))
    return F.struct(v_dec.alias("v_decimal"), v_int.alias("v_integer"), v_date.alias("v_date"),
                    F.when(is_date, dat["precision"]).alias("date_precision"), v_bool.alias("v_bool"),
                    F.when(is_dec | is_int, num["unit"]).alias("unit"), parsed.alias("parsed"))
