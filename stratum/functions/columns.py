"""Scalar column expressions shared by operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

#: Times in records keep their microseconds, so that rows can be restored.
RECORD_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def natural_key(*cols: ColumnOrName, sep: str = "|") -> Column:
    """Serialised natural key, parts cast to string and joined by ``sep``.

    NULL parts are skipped (``concat_ws`` semantics), as in the quarantine
    table contract.
    """
    return F.concat_ws(sep, *[_col(c).cast("string") for c in cols])


def record_json(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """Whole row as JSON text; NULL fields are left out by ``to_json``."""
    skip = set(exclude)
    return F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in skip]), RECORD_TIMES)


def date_sk(ts: ColumnOrName) -> Column:
    """yyyymmdd integer surrogate for the day of a date or timestamp."""
    c = _col(ts)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def exact_sum(c: ColumnOrName, scale: int | None) -> Column:
    """Sum of a double column.

    With ``scale`` the values are summed as DECIMAL(28, scale) and the total
    cast back to double: the result no longer depends on how rows were split
    across partitions or the order partial sums were merged, so reruns of a
    mart are bit-identical. Without ``scale`` it is a plain double sum.
    """
    if scale is None:
        return F.sum(_col(c))
    return F.sum(_col(c).cast(f"decimal(28,{scale})")).cast("double")


def exact_avg(c: ColumnOrName, scale: int | None) -> Column:
    """Mean of a double column, order-independent when ``scale`` is given."""
    if scale is None:
        return F.avg(_col(c))
    return F.try_divide(exact_sum(c, scale), F.count(_col(c)).cast("double"))
