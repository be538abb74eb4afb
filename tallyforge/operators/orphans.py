"""References to records that do not exist, were removed, or came later."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.clean import folded

SALTS = 16  # ways a hot missing key's references are spread over


@dataclass(frozen=True)
class Parent:
    """A table that is referred to: its key and the time it was first seen."""

    name: str
    df: DataFrame
    key: str
    seen: str


@dataclass(frozen=True)
class Reference:
    """A field of a table that names records of a parent; row_key names the referring row."""

    table_name: str
    ref_field: str
    df: DataFrame
    row_key: Column
    parent: str
    seen: str


def _long(references: list[Reference]) -> DataFrame:
    parts = [
        r.df.select(
            F.lit(r.parent).alias("parent"), folded(F.col(r.ref_field)).alias("key"), F.lit(r.table_name).alias("table_name"),
            F.lit(r.ref_field).alias("ref_field"), r.row_key.alias("row_key"), F.col(r.seen).cast("timestamp").alias("seen"),
        ).filter(F.col("key").isNotNull())
        for r in references
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphan_keys(parents: list[Parent], references: list[Reference], removals: DataFrame | None = None) -> DataFrame:
    """Keys that lack a parent, or whose parent came after a reference: parent, key, has_parent, parent_seen, removed, n_refs.

    Tagged parent and child keys are united in long form and grouped by parent table and key; a group keeps one flag, two
    times and a count, so partial sums meet the skew of hot keys before the shuffle.
    """
    none = F.lit(None).cast("timestamp")
    tagged = _long(references).select("parent", "key", F.lit(False).alias("is_parent"), F.lit(False).alias("is_removal"), none.alias("parent_seen"), F.col("seen").alias("child_seen"), F.lit(1).alias("n"))
    for p in parents:
        tagged = tagged.unionByName(p.df.select(F.lit(p.name).alias("parent"), folded(F.col(p.key)).alias("key"), F.lit(True).alias("is_parent"), F.lit(False).alias("is_removal"), F.col(p.seen).cast("timestamp").alias("parent_seen"), none.alias("child_seen"), F.lit(0).alias("n")).filter(F.col("key").isNotNull()))
    if removals is not None:
        tagged = tagged.unionByName(removals.select(folded(F.col("table_name")).alias("parent"), folded(F.col("record_key")).alias("key"), F.lit(False).alias("is_parent"), F.lit(True).alias("is_removal"), none.alias("parent_seen"), none.alias("child_seen"), F.lit(0).alias("n")).filter(F.col("key").isNotNull() & F.col("parent").isNotNull()))
    grouped = tagged.groupBy("parent", "key").agg(
        F.max("is_parent").alias("has_parent"), F.max("is_removal").alias("removed"), F.min("parent_seen").alias("parent_seen"),
        F.min("child_seen").alias("child_seen"), F.sum("n").alias("n_refs"),
    )
    return grouped.filter((F.col("n_refs") > 0) & (~F.col("has_parent") | F.coalesce(F.col("parent_seen") > F.col("child_seen"), F.lit(False))))


def orphan_references(parents: list[Parent], references: list[Reference], removals: DataFrame | None = None) -> DataFrame:
    """One row per orphan reference: table_name, ref_field, row_key, period, reason (missing, deleted or late).

    Keys are compared without outer blanks and case; a null reference is none, a blank one names a record that does not
    exist. A parent without a time is never late, nor is a reference without one. Repeats of a row count once, by its
    earliest time; period is null where no time is known. Empty parents make all references missing.
    """
    keys = orphan_keys(parents, references, removals).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = _long(references).withColumn("salt", F.pmod(F.xxhash64("table_name", "row_key"), F.lit(SALTS)).cast("int"))
    found = rows.join(keys.select("parent", "key", "salt", "has_parent", "removed", "parent_seen"), ["parent", "key", "salt"])
    late = F.col("has_parent") & F.coalesce(F.col("parent_seen") > F.col("seen"), F.lit(False))
    cases = found.filter(~F.col("has_parent") | late)
    reason = F.when(F.col("has_parent"), "late").when(F.col("removed"), "deleted").otherwise("missing")
    return (
        cases.withColumn("reason", reason)
        .groupBy("table_name", "ref_field", "row_key", "reason").agg(F.min("seen").alias("seen"))
        .select("table_name", "ref_field", "row_key", F.date_format("seen", "yyyy-MM").alias("period"), "reason")
    )


def orphan_report(cases: DataFrame) -> DataFrame:
    """Orphan references per table, field, period and reason."""
    return cases.groupBy("table_name", "ref_field", "period", "reason").agg(F.count("*").alias("n_orphans"))
