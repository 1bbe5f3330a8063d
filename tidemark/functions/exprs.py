"""Reusable column expressions. All of them are built-in functions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_vin(vin: str | Column) -> Column:
    """Upper-cased if it is 17 letters and digits, else null. The length test refuses a final line end."""
    up = F.upper(col(vin))
    return F.when((F.length(col(vin)) == 17) & up.rlike("^[A-Z0-9]{17}$"), up)


def regex_matches(text: str | Column, pattern: str) -> Column:
    """rlike whose final `$` means the very end, not a place before a final line end."""
    return col(text).rlike(pattern[:-1] + "\\z" if pattern.endswith("$") and not pattern.endswith("\\$") else pattern)


def hour_diff(start: str | Column, end: str | Column) -> Column:
    """Hour boundaries passed from start to end (01:59 to 02:01 is 1), negative if end is earlier."""
    hour = lambda c: F.unix_timestamp(F.date_trunc("hour", col(c)))
    return ((hour(end) - hour(start)) / HOUR).cast("long")


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Calendar days from start to end."""
    return F.datediff(col(end), col(start)).cast("long")


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Elapsed hours as a double."""
    micros = F.unix_micros(col(end).cast("timestamp")) - F.unix_micros(col(start).cast("timestamp"))
    return micros / F.lit(3600e6)


def latest(value: str | Column, *order: str | Column) -> Column:
    """The non-null value of greatest order; later order columns break ties. An aggregate."""
    v = col(value)
    return F.max(F.when(v.isNotNull(), F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)], v.alias("v"))))["v"]


def earliest(value: str | Column, *order: str | Column) -> Column:
    """The non-null value of smallest order; later order columns break ties. An aggregate."""
    v = col(value)
    return F.min(F.when(v.isNotNull(), F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)], v.alias("v"))))["v"]


def latest_row(carry: Sequence[str], *order: str | Column) -> Column:
    """A struct of the carry columns of the greatest order, nulls included. An aggregate."""
    return F.max(F.struct(*[col(o).alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c).alias(f"c_{c}") for c in carry]))


def to_int_half_even(x: str | Column) -> Column:
    """A double rounded to an integer, halves to the even one."""
    return F.bround(col(x), 0).cast("int")


def to_decimal(x: str | Column, precision: int = 18, scale: int = 3) -> Column:
    """Fixed-point value, halves away from zero."""
    return col(x).cast(f"decimal({precision},{scale})")


def percent(part: str | Column, whole: str | Column, digits: int = 1) -> Column:
    """Share in percent as a double; null where the whole is 0 or null."""
    return F.round(col(part) * F.lit(100.0) / F.nullif(col(whole), F.lit(0)), digits)


def ratio(a: str | Column, b: str | Column) -> Column:
    """a / b as a double; null where b is 0 or null."""
    return col(a).cast("double") / F.nullif(col(b), F.lit(0))


def fingerprint(columns: Sequence[str | Column], bits: int = 0) -> Column:
    """md5 (or SHA-2 of `bits`) of the columns as text, joined by `|`, null as empty. Never of floats."""
    text = F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])
    return F.sha2(text, bits) if bits else F.md5(text)


def bucket(value: str | Column, bounds: Sequence[tuple[float | None, float | None, str]], other: str | None = None) -> Column:
    """The name of the first closed interval that holds the value; `other` for the rest and null."""
    v, out = col(value), F.lit(other)
    for low, high, name in reversed(bounds):
        inside = F.lit(True)
        if low is not None:
            inside = inside & (v >= low)
        if high is not None:
            inside = inside & (v <= high)
        out = F.when(inside, F.lit(name)).otherwise(out) if not (low is None and high is None) else F.lit(name)
    return out


def digits_to_int(text: str | Column) -> Column:
    """The digits of a text as an integer; null if there are none or too many."""
    return F.regexp_replace(col(text), "[^0-9]", "").try_cast("int")


def distinct_from(a: str | Column, b: str | Column) -> Column:
    """Null-safe inequality."""
    return ~col(a).eqNullSafe(col(b))


def json_text(json: str | Column, path: str) -> Column:
    return F.get_json_object(col(json), path)


def rank_by(value: str | Column, order: Sequence[str], rest: int | None = None) -> Column:
    """The place of a value in a list of names, from 1; `rest` (by default one more) for others and null."""
    out = F.lit(len(order) + 1 if rest is None else rest)
    for k, name in reversed(list(enumerate(order, 1))):
        out = F.when(col(value) == name, F.lit(k)).otherwise(out)
    return out


def as_of(instant: str | Column | None = None) -> Column:
    """An as-of instant; the current time only if none is given."""
    return F.current_timestamp() if instant is None else F.lit(instant).cast("timestamp") if isinstance(instant, str) else instant
