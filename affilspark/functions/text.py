"""Text, key, date and identifier expressions; all are built-in Spark functions.

Trimming removes Unicode space separators, as the SQL oracle's trim does; Spark's own trim only
removes U+0020. Lower case follows Spark (`İ` becomes two characters, final sigma is kept apart).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"^\p{Zs}+|\p{Zs}+$"
_BLANK = r"[\t\n\f\r ]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), _EDGES, "")


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(trim(c), F.lit(""))


def norm_text(c: Column | str, collapse: str = "first", trimmed: bool = True, empty_to_null: bool = True) -> Column:
    """Null to '', trim, one space for the first (or, with collapse='all', each) whitespace run, lower case."""
    x = F.coalesce(_c(c), F.lit(""))
    if trimmed:
        x = trim(x)
    x = F.regexp_replace(x, _BLANK, " ") if collapse == "all" else F.regexp_replace(x, r"(?s)^(.*?)" + _BLANK, "$1 ")
    x = F.lower(x)
    return F.nullif(x, F.lit("")) if empty_to_null else x


def tokens(c: Column | str) -> Column:
    """Space-separated tokens that are not blank, in order, repeats kept."""
    return F.filter(F.split(_c(c), " ", -1), lambda x: F.length(trim(x)) > 0)


def token_set(c: Column | str) -> Column:
    return F.array_distinct(tokens(c))


def first_token(c: Column | str) -> Column:
    return F.coalesce(F.get(tokens(c), F.lit(0)), F.lit(""))


def token_overlap(mine: Column, theirs: Column) -> tuple[Column, Column, Column]:
    """Shared tokens, tokens of the query side, and their ratio (0 for no tokens)."""
    shared, size = F.size(F.array_intersect(mine, theirs)).cast("long"), F.size(mine).cast("long")
    return shared, size, F.when(size > 0, shared / size).otherwise(F.lit(0.0))


def partial_date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """YYYY-MM-DD with zeros for missing parts; null if all are missing."""
    parts = [_c(x) for x in (year, month, day)]
    number = [F.coalesce(p.cast("int"), F.lit(0)) for p in parts]
    return F.when(parts[0].isNotNull() | parts[1].isNotNull() | parts[2].isNotNull(), F.format_string("%04d-%02d-%02d", *number))


def start_year(date: Column | str) -> Column:
    """The first four characters as a number; null for shorter text."""
    return F.when(F.length(_c(date)) >= 4, F.substring(_c(date), 1, 4).cast("int"))


def year_dir(year: Column | str) -> Column:
    """Directory key of a year: four digits, or `null`."""
    return F.coalesce(F.lpad(_c(year).cast("string"), 4, "0"), F.lit("null"))


def lower_key(*cols: Column | str) -> Column:
    """md5 of lower-cased fields joined by |; null counts as ''."""
    return F.md5(F.concat_ws("|", *[F.lower(F.coalesce(_c(c), F.lit(""))) for c in cols]))


def row_key(*cols: Column | str) -> Column:
    """A surrogate id from a natural key: the same in every job, without a shuffle. Null differs from ''."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_c(c), F.lit("~null~")) for c in cols]))


def org_key(source: str, identifier: str, name: str, country: str, city: str) -> Column:
    """`source:id` in lower case if both are there, else a key of name, country and city."""
    both = _c(source).isNotNull() & _c(identifier).isNotNull()
    return F.when(both, F.concat(F.lower(_c(source)), F.lit(":"), F.lower(_c(identifier)))).otherwise(lower_key(name, country, city))


def org_identifier(source: Column | str, identifier: Column | str) -> Column:
    """The identifier in its source's comparable form; null for other sources, '' where nothing is found."""
    source, x = F.lower(_c(source)), F.lower(_c(identifier))
    return (
        F.when(source == "fundref", F.regexp_extract(x, r"10\.13039/([0-9]+)", 1))
        .when(source.isin("grid", "ror"), x)
        .when(source == "ringgold", F.regexp_extract(x, r"([0-9]+)", 1))
    )


def norm_isni(c: Column | str) -> Column:
    return F.upper(F.regexp_replace(_c(c), "[ -]", ""))


def clean_domain(c: Column | str) -> Column:
    """Trimmed, without leading and trailing double quotes, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(trim(c), '^"+', ""), '"+$', ""))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places; null for an empty whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 2)
