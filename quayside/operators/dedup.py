"""Replay-safe de-duplication (K8).

``keep_first`` keeps one row per key inside a batch; ``drop_existing`` drops
rows whose key a sink already holds.  Both are written for skew: a single
key may carry a large share of a batch (a replay storm), so keep-first is an
aggregation (partial aggregation on the map side collapses a hot key before
the shuffle) instead of a window that would pull the whole group into one
task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_ORDER = ("partition", "offset")


def keep_first(df: DataFrame, key: str = "event_id", order: tuple[str, ...] = DEFAULT_ORDER,
               copies_col: str | None = None) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` tuple.

    ``min(struct(order..., rest...))`` picks the whole first row in one
    aggregation.  Spark plans it as a sort-based aggregate with a partial
    (map-side) phase, so a hot key is reduced to one row per map task before
    the exchange and both sorts can spill.  ``copies_col`` (optional) holds
    how many rows shared the key.
    Column order of the input is kept.
    """
    order = tuple(c for c in order if c in df.columns)   # positions are gone after landing
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest]).alias("_first")
    aggs = [F.min(packed).alias("_first")]
    if copies_col:
        aggs.append(F.count(F.lit(1)).alias(copies_col))
    grouped = df.groupBy(key).agg(*aggs)
    out = [F.col(key) if c == key else F.col(f"_first.{c}").alias(c) for c in df.columns]
    if copies_col:
        out.append(F.col(copies_col))
    return grouped.select(*out)


def drop_existing(batch: DataFrame, target: DataFrame | None, key: str = "event_id",
                  date_col: str | None = "event_date", dates: list | None = None) -> DataFrame:
    """Rows of ``batch`` whose ``key`` is not in ``target`` yet.

    With ``date_col`` (the target's partition column) the match is on
    (date, key): an event's date is derived from its own time, so a replayed
    event lands in the same partition.  ``dates``, the batch's own dates (at
    most one per calendar day), become a literal partition filter of the
    target's scan.  With ``date_col=None`` the key is looked for in the whole
    target.  How the anti-join runs is left to Spark, which knows the sizes.
    """
    if target is None:
        return batch
    on = [date_col, key] if date_col else [key]
    if date_col and dates is not None:
        target = target.filter(F.col(date_col).isin(*dates))
    return batch.join(target.select(*on), on, "left_anti")
