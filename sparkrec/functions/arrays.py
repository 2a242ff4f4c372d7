"""Array, vector and sequence expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: Column | str, b: Column | str) -> Column:
    """Dot product in double precision."""
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalize(vec: Column | str) -> Column:
    """Unit vector; the zero vector stays zero."""
    norm = F.greatest(F.sqrt(dot(vec, vec)), F.lit(1e-12))
    # beside the elements: inside a lambda it would be computed anew for each of them
    return F.zip_with(_col(vec), F.array_repeat(norm, F.size(_col(vec))), lambda x, n: x.cast("double") / n)


def rounded(vec: Column | str, digits: int) -> Column:
    """Every element rounded, halves away from zero; a negative one that rounds to zero stays -0.0, as in SQL."""
    return F.transform(_col(vec), lambda x: F.signum(x.cast("double")) * F.round(F.abs(x.cast("double")), digits))


def rounded_scaled(value: Column | str, digits: int) -> Column:
    """Rounded by way of value * 10^digits, as SQL does it: a value just below a half in binary goes down."""
    return F.round(_col(value) * 10.0**digits) / 10.0**digits


def last_n(values: Column | str, n: int) -> Column:
    """The last `n` elements, in order."""
    arr = _col(values)
    return F.slice(arr, F.greatest(F.size(arr) - n + 1, F.lit(1)), n)


def pad_right(values: Column | str, width: int, fill=0) -> Column:
    """Left-aligned, filled up to `width`."""
    arr = _col(values)
    return F.concat(arr, F.array_repeat(F.lit(fill), F.greatest(F.lit(width) - F.size(arr), F.lit(0))))


def merge_sequence(history: Column | str, recent: Column | str, keep: int = 10) -> Column:
    """History, then session items; the newest `keep` survive."""
    return last_n(F.concat(_col(history), _col(recent)), keep)


def ordered_values(structs: Column | str, field: str) -> Column:
    """Sort collected structs by their leading fields and project one field."""
    return F.transform(F.array_sort(_col(structs)), lambda s: s[field])
