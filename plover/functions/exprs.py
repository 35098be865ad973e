"""Small expression helpers shared by operators."""
from __future__ import annotations

from typing import Any, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL, so aggregates, medians and gates see one kind of missing."""
    x = col(c)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def is_missing(c: str | Column) -> Column:
    x = col(c)
    return x.isNull() | F.isnan(x)


def tuple_lt(columns: Sequence[str | Column], values: Sequence[Any]) -> Column:
    """Lexicographic ``(c1, c2, ...) < (v1, v2, ...)`` as one boolean expression."""
    cols = [col(c) for c in columns]
    expr = cols[-1] < F.lit(values[-1])
    for c, v in zip(reversed(cols[:-1]), reversed(list(values[:-1]))):
        expr = (c < F.lit(v)) | ((c == F.lit(v)) & expr)
    return expr


def tuple_ge(columns: Sequence[str | Column], values: Sequence[Any]) -> Column:
    return ~tuple_lt(columns, values)


def fmt_fixed(c: str | Column, decimals: int) -> Column:
    return F.format_string(f"%.{decimals}f", col(c))


def last_dotted_segment(c: str | Column) -> Column:
    return F.element_at(F.split(col(c), r"\."), -1)


def seeded_hash(seed: int, *key_cols: str | Column) -> Column:
    """Deterministic 64-bit order key for sampling and shuffling: never rand()."""
    return F.xxhash64(F.lit(int(seed)), *[col(c) for c in key_cols])
