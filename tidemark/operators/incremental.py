"""Incremental maintenance that equals a full rebuild for all that lies inside its lookback.

A lookback finds keys; it never cuts the history that a key is computed from. Only keys present in the
new batch are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources import indexed

EMPTY = "1900-01-01 00:00:00"


def watermark(target: DataFrame | None, ts: str, lookback: str) -> Column:
    """The time from which source rows are read again; 1900 if there is no target or it is empty."""
    if target is None:
        return F.lit(EMPTY).cast("timestamp")
    top = target.agg(F.max(F.col(ts).cast("timestamp"))).first()[0]  # one value
    return F.lit(EMPTY).cast("timestamp") if top is None else F.lit(top).cast("timestamp") - F.expr(f"INTERVAL {lookback}")


def replace(target: DataFrame, batch: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """target without the batch's keys, and the batch."""
    keys = [key] if isinstance(key, str) else list(key)
    k = batch.select(*[F.col(c).alias(f"__{c}") for c in keys]).distinct()
    return target.join(k, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys], "left_anti").unionByName(batch)


def rescan(source: DataFrame, target: DataFrame | None, ts: str, lookback: str, key: Sequence[str] | str, transform: Callable[[DataFrame], DataFrame], target_ts: str | None = None) -> DataFrame:
    """Rows of the lookback transformed (which dedupes them) and put in place of their keys."""
    batch = transform(source.filter(F.col(ts) >= watermark(target, target_ts or ts, lookback)))
    return batch if target is None else replace(target, batch, key)


def affected(source: DataFrame, target: DataFrame | None, ts: str, lookback: str, entity: str, transform: Callable[[DataFrame], DataFrame], target_ts: str) -> DataFrame:
    """Entities with a row in the lookback are recomputed from all their rows; all their target rows go.

    The same for one row an entity and for many (runs): a late row may split or join runs, so rows are
    never merged one by one.
    """
    if target is None:
        return transform(source)
    return replace(target, affected_rows(source, target, ts, lookback, entity, transform, target_ts), entity)


def affected_rows(source: DataFrame, target: DataFrame, ts: str, lookback: str, entity: str, transform: Callable[[DataFrame], DataFrame], target_ts: str) -> DataFrame:
    """What the entities with a row in the lookback become, from all their rows."""
    touched = source.filter(F.col(ts) >= watermark(target, target_ts, lookback)).select(entity).distinct()
    return transform(source.join(touched, entity, "left_semi"))


def rescan_at_rest(source: DataFrame, path: str, ts: str, lookback: str, transform: Callable[[DataFrame], DataFrame], target_ts: str | None = None, **layout: int) -> dict:
    """rescan() of the indexed table at path: only files that hold the batch's keys are written again."""
    target = indexed.read(source.sparkSession, path)
    return indexed.replace(transform(source.filter(F.col(ts) >= watermark(target, target_ts or ts, lookback))), path, **layout)


def affected_at_rest(source: DataFrame, path: str, ts: str, lookback: str, entity: str, transform: Callable[[DataFrame], DataFrame], target_ts: str, **layout: int) -> dict:
    """affected() of the indexed table at path, whose key is the entity."""
    target = indexed.read(source.sparkSession, path)
    return indexed.replace(affected_rows(source, target, ts, lookback, entity, transform, target_ts), path, **layout)


def time_window(source: DataFrame, target: DataFrame | None, ts: str, unit: str, lookback: str, transform: Callable[[DataFrame], DataFrame], target_ts: str, key: Sequence[str]) -> DataFrame:
    """Whole hours (or days) from the newest minus the lookback are computed anew."""
    if target is None:
        return transform(source)
    start = F.date_trunc(unit, watermark(target, target_ts, lookback))
    return replace(target, transform(source.filter(F.col(ts) >= start)), key)
