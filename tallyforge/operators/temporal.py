"""Operators on intervals, layers and hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interval_union(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, start, end): overlapping and touching intervals of a key merged.

    Intervals without a start or an end, or that end before they start, are left out. An interval that begins after all
    before it have ended opens a new one. Equal intervals are merged before they are sorted.
    """
    spans = df.filter(F.col(start) <= F.col(end)).groupBy(*keys, start).agg(F.max(end).alias(end))
    w = Window.partitionBy(*keys).orderBy(start)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.withColumn("_new", F.coalesce(F.col(start) > before, F.lit(True)).cast("int"))
    island = opened.withColumn("_island", F.sum("_new").over(w))
    return island.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def excluded_seconds(spans: DataFrame, keys: list[str], start: str, end: str, since: Column, until: Column) -> DataFrame:
    """(keys, excluded_s): the seconds of merged intervals that lie within [since, until] of each row. spans holds these as columns."""
    seconds = F.greatest(F.lit(0), F.unix_micros(F.least(F.col(end), until).cast("timestamp")) - F.unix_micros(F.greatest(F.col(start), since).cast("timestamp"))) / 1e6
    return spans.groupBy(*keys).agg(F.sum(seconds).alias("excluded_s"))


def changed_samples(df: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """The rows of each key at which any field differs from the row before; the first row counts as a change."""
    w = Window.partitionBy(*keys).orderBy(order)
    now = F.struct(*fields)
    return df.withColumn("_old", F.lag(now).over(w)).filter(F.col("_old").isNull() | ~F.col("_old").eqNullSafe(now)).drop("_old")


def overlay(layers: list[DataFrame], key: str, fields: list[str], stamp: str) -> DataFrame:
    """One row per key of the first layer: each field from the highest layer that has it, and there from the latest row.

    Layers rise in rank; a key that only patches hold gives no row, since a base row must be the source's own. Values
    merge by partial maxima, so a key of many patches stays no single task.
    """
    patches = None
    for rank, layer in enumerate(layers):
        part = layer.select(key, F.lit(rank).alias("_rank"), F.col(stamp).alias("_at"), *fields)
        patches = part if patches is None else patches.unionByName(part)
    best = lambda c: F.max(F.when(F.col(c).isNotNull(), F.struct("_rank", "_at", F.col(c).alias("v")))).getField("v").alias(c)
    merged = patches.groupBy(key).agg(*[best(c) for c in fields], F.min("_rank").alias("_base"))
    return merged.filter("_base = 0").drop("_base")


def keep_closed(tables: dict[str, DataFrame], parents: dict[str, list[tuple[str, str, str]]], rejected: dict[str, DataFrame], order: list[str]) -> dict[str, DataFrame]:
    """Tables without their rejected rows and without rows whose parents are gone.

    parents: per table, (column, parent table, parent key). `order` lists the tables with parents first, so that one pass
    down the hierarchy closes it. A null reference does not need a parent.
    """
    kept: dict[str, DataFrame] = {}
    for name in order:
        df = tables[name]
        if name in rejected:
            df = df.join(rejected[name], rejected[name].columns, "left_anti")
        for column, parent, key in parents.get(name, []):
            there = kept[parent].select(F.col(key).alias(column)).distinct().withColumn("_there", F.lit(True))
            df = df.join(there, column, "left").filter(F.col("_there").isNotNull() | F.col(column).isNull()).drop("_there")
        kept[name] = df
    return kept
