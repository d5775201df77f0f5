"""Joining many rows to one row per key when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cut import cut

BROADCAST_ROWS = 50_000
HOT_SHARE = 1_000


def attach(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    count_col: str,
    how: str = "inner",
    small_rows: int | None = None,
) -> DataFrame:
    """Join ``small`` (unique on ``keys``) to ``big``.

    ``small[count_col]`` holds the number of rows of ``big`` with that key. A
    ``small`` of at most ``BROADCAST_ROWS`` rows (counted, unless the caller
    has a bound) is broadcast. A larger one is split: keys holding more than
    one thousandth of all rows - fewer than a thousand keys, whatever the data
    - are broadcast, the others are shuffled, so no task receives a hot key.
    """
    if small_rows is None:
        small = cut(small)
        small_rows = small.count()
    if small_rows <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), keys, how)
    small = cut(small)
    total = small.agg(F.sum(count_col)).first()[0] or 0
    hot = small.filter(F.col(count_col) > total / HOT_SHARE)
    is_hot = big.join(F.broadcast(hot), keys, "inner")
    rest = big.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    cold = small.filter(F.col(count_col) <= total / HOT_SHARE)
    return is_hot.unionByName(rest.join(cold, keys, how))
