"""Looking up rows by key.

Look-ups are plain joins, and adaptive execution splits a key that fills a partition. Right rows come at
most one per key, so a split copies nothing but one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _all_known(columns: Sequence[str]) -> Column:
    known = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        known = known & F.col(c).isNotNull()
    return known


def _ordered(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[str]:
    return [*on, *(c for c in left.columns if c not in on), *(c for c in right.columns if c not in on)]


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right USING (on)``; column order: keys, left, right. Each row moves once at most."""
    return left.join(right, list(on), "left").select(*_ordered(left, right, on))


# Keys up to which a look-up tells every task of the right side which of its rows are wanted: 8-byte hashes,
# so a broadcast of some 30 MB at the most.
FEW_KEYS = 1 << 19


def wanted_rows(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """The rows of ``right`` that a look-up by ``left`` can need, and by chance a few more, where ``left`` has few keys; else all.

    Hashes of the keys are counted up to the limit and sent to where the right rows are read. The size of a written table says
    little about that: it is a compressed one, and rows that repeat take next to nothing on disk.
    """
    mark = "__mark"
    marks = left.where(_all_known(on)).select(F.xxhash64(*on).alias(mark)).distinct()
    if marks.limit(FEW_KEYS + 1).count() > FEW_KEYS:
        return right
    return right.withColumn(mark, F.xxhash64(*on)).join(F.broadcast(marks), mark, "left_semi").drop(mark)


def lookup_staged(
    left: DataFrame, right: DataFrame, on: Sequence[str], *, first_by: Sequence[Column] | None = None
) -> DataFrame:
    """The same rows, for a ``left`` of short rows that is read from a written table.

    Of the right side, only the rows that a short list of keys names are moved, and of a long list's each
    once. Neither side is ever broadcast whole. Left rows without a key meet nothing. With ``first_by``
    the first right row of each key by that order counts, settled on the way. ``left`` is read three times.
    """
    if left.isStreaming:
        return lookup(left, right, on)
    on, columns = list(on), _ordered(left, right, on)
    near = wanted_rows(left, right, on)
    if first_by is not None:
        near = first_per_key(near, on, first_by)
    found = left.where(_all_known(on)).hint("merge").join(near, on, "left").select(*columns)
    return found.unionByName(left.where(~_all_known(on)), allowMissingColumns=True).select(*columns)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """For each key its first row by ``order``; of rows alike in all of that, one.

    Tasks drop all but their own first row of a key before anything moves, so each key costs a row a task
    and long columns go through one exchange.
    """
    place = "__place"
    by = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(place, F.row_number().over(by)).where(F.col(place) == 1).drop(place)


def tied_first(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """For each key all rows that are first by ``order``; reduced by tasks as in :func:`first_per_key`."""
    place = "__place"
    by = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(place, F.rank().over(by)).where(F.col(place) == 1).drop(place)
