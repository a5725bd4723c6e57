"""Column expressions for cleaning and recoding. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: Column | str) -> Column:
    """Number or null; text that is no plain decimal number, NaN and infinities become null."""
    n = col(c).try_cast("double")
    # a cast alone also takes the suffixes of Java literals, such as 12d
    plain = col(c).cast("string").rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
    return F.when(plain & ~F.isnan(n) & (F.abs(n) != float("inf")), n)


def clean_numeric(c: Column | str) -> Column:
    """Drop everything but digits and points, then convert; nothing left -> null.

    A number written with an exponent, as Spark writes large doubles, is read as
    it is, without its sign.
    """
    text = col(c).cast("string")
    digits = F.nullif(F.regexp_replace(text, r"[^0-9.]", ""), F.lit("")).try_cast("double")
    return F.when(text.rlike(r"^-?[0-9.]+E-?[0-9]+$"), F.abs(text.try_cast("double"))).otherwise(digits)


def safe_ratio(num: Column | str, den: Column | str, scale: int | None = None) -> Column:
    """num / den, null when den is 0; rounded half to even when a scale is given."""
    r = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return r if scale is None else F.bround(r, scale)


def clamp(c: Column | str, lo, hi) -> Column:
    """Value limited to [lo, hi]; null stays null."""
    v = col(c)
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(lo)), F.lit(hi)))


def recode(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Value looked up in a small literal map, else ``default`` (a column or a value)."""
    entries = [F.lit(x) for kv in mapping.items() for x in kv]
    other = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*entries), col(c)), other)


def bucketize(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the half-open band ``[edge[i-1], edge[i])`` that holds the value.

    ``labels`` has one entry more than ``edges``; null stays null.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    v = col(c)
    out = F.when(v.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        out = out.when(v < F.lit(edge), F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def compose_key(cols: Sequence[Column | str], sep: str = " ") -> Column:
    """Null -> '', joined by ``sep``, trimmed."""
    return F.trim(F.concat_ws(sep, *[F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]))


def split_label(c: Column | str, n: int) -> list[Column]:
    """The first ``n`` blank-separated parts; a missing part is ''."""
    parts = F.split(F.trim(col(c)), r"\s+")
    return [F.coalesce(F.try_element_at(parts, F.lit(i + 1)), F.lit("")) for i in range(n)]


def pyramid(group: Column | str, left, value: Column | str) -> Column:
    """Value with its sign turned for the group drawn on the left."""
    return F.when(col(group) == F.lit(left), -col(value)).otherwise(col(value))


def ordinal(c: Column | str, order: Sequence[str]) -> Column:
    """0-based place of the value in a custom order; unknown and null come last."""
    place = F.array_position(F.array(*[F.lit(x) for x in order]), col(c))
    return F.when(place > 0, place - 1).otherwise(F.lit(len(order))).cast("int")


def row_sum(cols: Sequence[Column | str]) -> Column:
    """Sum across columns, null counted as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(c), F.lit(0)) for c in cols])


def join_text(cols: Sequence[Column | str], sep: str = ",", default: str | None = None) -> Column:
    """Non-null values of a row joined in order; ``default`` when there are none."""
    kept = F.array_compact(F.array(*[col(c) for c in cols]))
    joined = F.array_join(kept, sep)
    return joined if default is None else F.when(F.size(kept) > 0, joined).otherwise(F.lit(default))


def join_array(c: Column | str, sep: str = ", ") -> Column:
    """Non-empty strings of an array joined in order."""
    return F.array_join(F.filter(col(c), lambda x: F.coalesce(x, F.lit("")) != ""), sep)


def rescale5(c: Column | str) -> Column:
    """A score out of 100 brought to 0-5; scores up to 5 stay."""
    v = col(c).cast("double")
    return F.when(v > 5, F.bround(v / 20, 1)).otherwise(v)


def lat_lon(c: Column | str) -> tuple[Column, Column]:
    """Latitude and longitude of a 'lat,lon' text; both null unless both are numbers."""
    parts = F.split(col(c), ",")
    lat = F.trim(F.try_element_at(parts, F.lit(1))).try_cast("double")
    lon = F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double")
    ok = (F.size(parts) == 2) & lat.isNotNull() & lon.isNotNull()
    return F.when(ok, lat), F.when(ok, lon)


def labels_or_default(labels: Column | str, default: str) -> Column:
    """The array without nulls, or an array of the default when nothing is left."""
    kept = F.array_compact(col(labels))
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(default)))


def in_values(c: Column | str, values: Sequence) -> Column:
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def not_in_values(c: Column | str, values: Sequence) -> Column:
    """True for null as well: a missing value is not one of the excluded ones."""
    return F.coalesce(~col(c).isin(list(values)), F.lit(True))
