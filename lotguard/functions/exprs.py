"""Column-expression helpers. All are built-in Spark functions (JVM side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotguard.functions import constants as K

# Python's str.strip() removes every character for which str.isspace() is
# true; Spark's trim() only removes the space character. btrim with that exact
# character set (derived from Python's own definition) is native and avoids a
# regex per value.
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """str.strip() on a string column; null stays null."""
    return F.btrim(col_(c), F.lit(PY_WHITESPACE))


def blank(c: str | Column) -> Column:
    """True when the value is null or only white space (never null)."""
    return F.coalesce(strip(c) == F.lit(""), F.lit(True))


def filled(c: str | Column) -> Column:
    return ~blank(c)


def or_default(c: str | Column, default: str | Column) -> Column:
    """Python truthiness default ``a or b`` for strings: null and '' fall back."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(col_(c), F.lit("")), d)


def canonical_status(c: str | Column = "status") -> Column:
    """``str(v).strip().upper()`` with null preserved."""
    return F.upper(strip(c))


def normalised_status(c: str | Column = "status") -> Column:
    canon = canonical_status(c)
    expr = canon
    for raw, target in reversed(list(K.STATUS_MAP.items())):
        expr = F.when(canon == F.lit(raw), F.lit(target)).otherwise(expr)
    return expr


def in_domain(c: Column, values) -> Column:
    """Null-safe membership: null is *not* in the domain (never null)."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def parse_day(c: str | Column) -> Column:
    """Row-local day-first parse; unparseable text gives null."""
    return F.try_to_date(col_(c), "d/M/yyyy")


def serialised(c: str | Column) -> Column:
    """Hand-off text form: null -> '', else stripped text."""
    return F.coalesce(strip(F.col(c).cast("string") if isinstance(c, str) else c.cast("string")), F.lit(""))


def safe_name(c: str | Column) -> Column:
    """Replace runs of non-word characters (Unicode aware) by '_' and trim '_'."""
    replaced = F.regexp_replace(col_(c), r"(?U)[^\w.-]+", "_")
    return F.regexp_replace(replaced, r"^_+|_+$", "")


def base_name(c: str | Column) -> Column:
    return F.regexp_extract(col_(c), r"([^/]+)$", 1)


def lot_code(key: str | Column) -> Column:
    """Lot code for an integer key: 'LG-' + zero padded to at least 8 digits.

    format_string never truncates, unlike lpad, so codes stay unique for keys
    of any width.
    """
    return F.concat(F.lit("LG-"), F.format_string("%08d", col_(key)))


def truncate_message(c: Column) -> Column:
    return F.substring(c, 1, K.MESSAGE_LIMIT)


def message_of(text: str, *values: Column | str) -> Column:
    """A fixed text whose {names} stand for the values, in this order."""
    parts: list[Column] = []
    for value in values:
        head, _, rest = text.partition("{")
        text = rest.partition("}")[2]
        parts += [F.lit(head), F.col(value) if isinstance(value, str) else value]
    return F.concat(*[p.cast("string") for p in parts], F.lit(text))
