"""Column expressions for dates, numbers, conditions and text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def noon_of(year, month, day) -> Column:
    """Timestamp at 12:00 of a calendar day given by its parts."""
    return F.make_timestamp_ntz(year, month, day, F.lit(12), F.lit(0), F.lit(0))


def month_short(t: str | Column) -> Column:
    return F.date_format(_c(t), "MMM")


def clean_hour(hour: str | Column) -> Column:
    """Midnight written as 24 or 2400 becomes 0."""
    h = _c(hour)
    return F.when(h.isin(24, 2400), F.lit(0)).otherwise(h)


def at_least_zero(x: str | Column) -> Column:
    """Negative becomes 0; null stays null."""
    v = _c(x)
    return F.when(v.isNull(), F.lit(None)).when(v >= 0, v).otherwise(F.lit(0))


def ratio(num: str | Column, den: str | Column) -> Column:
    """Quotient, null where the denominator is zero."""
    return F.try_divide(_c(num), _c(den))


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over pairs without null; null when a side does not vary."""
    a, b = _c(x), _c(y)
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def banded(x: str | Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first upper bound that exceeds the value; null takes ``otherwise``."""
    v = _c(x)
    out = F.lit(otherwise)
    for bound, label in reversed(list(bands)):
        out = F.when(v < bound, F.lit(label)).otherwise(out)
    return out


def party_label(size: str | Column) -> Column:
    """Single, Small (2 to 4) or Big (5 and more)."""
    s = _c(size)
    return F.when(s == 1, "Single").when((s >= 2) & (s < 5), "Small").when(s >= 5, "Big")


def title_in(name: str | Column) -> Column:
    """Text between the comma and the next full stop; the whole text without a match."""
    return F.regexp_replace(_c(name), r"^.*, (.*?)\..*$", "$1")


def surname_in(name: str | Column) -> Column:
    """Text before the first comma or full stop."""
    return F.split(_c(name), "[,.]")[0]


def recode(x: str | Column, mapping: dict[str, str]) -> Column:
    """Replace listed values; all others pass through."""
    v = _c(x)
    pairs = [F.lit(s) for kv in mapping.items() for s in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), v), v)


def signed_label(label: str | Column, negative: str = "neg") -> Column:
    return F.when(_c(label) == negative, -1).otherwise(1)


def half_even(x: str | Column, digits: int = 3) -> Column:
    """Round half to even, as numpy does."""
    return F.bround(_c(x), digits)


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda p, q: (p * q).cast("double")), F.lit(0.0), lambda s, p: s + p)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def hash_unit(key: str | Column | Sequence[str | Column], seed: int = 0) -> Column:
    """Number in [0, 1) fixed by key and seed, whatever the partitioning.

    Taken from md5, so that any other engine can repeat the draw.
    """
    keys = list(key) if isinstance(key, (list, tuple)) else [key]
    text = F.concat_ws("|", *[_c(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def hash_unit_sql(key: str, seed: int = 0) -> str:
    """The same draw as SQL text."""
    return (
        f"(CAST('0x' || substr(md5(concat_ws('|', CAST({key} AS VARCHAR), '{seed}')), 1, 12) AS BIGINT)"
        f" / {float(1 << 48)!r})"
    )
