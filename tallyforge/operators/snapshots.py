"""What changed between full snapshots of one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.clean import folded, set_text


def normal_value(c: Column, kind: str) -> Column:
    """A compared value as text: text folded, whole number, decimal to six places, or set. Null and empty give ''."""
    if kind == "text":
        return F.coalesce(folded(c), F.lit(""))
    if kind == "set":
        return F.lower(set_text(c, True))
    if kind == "decimal6":
        return F.coalesce(F.round(c.cast("double"), 6).try_cast("decimal(30,6)").cast("string"), F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))


def last_deliveries(df: DataFrame, release: str, delivery: str) -> DataFrame:
    """The rows of each release's highest delivery. The list of releases is an aggregate of the table, joined by key."""
    top = df.groupBy(F.col(release).alias("_r")).agg(F.max(delivery).alias("_d"))
    return df.join(top, (F.col(release) == F.col("_r")) & (F.col(delivery) == F.col("_d"))).drop("_r", "_d")


def snapshot_changes(df: DataFrame, release: str, delivery: str, key: str, fields: dict[str, str], tie: str) -> DataFrame:
    """Changes per pair of consecutive releases: release_no, record_key, field_name, change_type, old_value, new_value.

    Each release_no that is present is compared with release_no - 1; one that comes first or after a gap in the numbers
    has no base and gives nothing. Keys lose outer blanks and case; rows with a null key are ignored. Repeated keys in a
    delivery count once, by the greatest `tie` and then the greatest values. The two sides meet in a full outer join on
    the key; a missing side makes `added` or `removed`, unequal row hashes open one `updated` row per field.
    """
    record_key = folded(F.col(key))
    values = F.struct(*[normal_value(F.col(f), kind).alias(f) for f, kind in fields.items()])
    last = last_deliveries(df.select(release, delivery, record_key.alias("record_key"), values.alias("v"), F.col(tie).alias("_tie")), release, delivery)
    rows = (
        last.filter(F.col("record_key").isNotNull())
        .groupBy(F.col(release).cast("int").alias("release_no"), "record_key").agg(F.max(F.struct("_tie", "v")).alias("_m"))
        .select("release_no", "record_key", F.col("_m.v").alias("v"), F.sha2(F.to_json("_m.v"), 256).alias("h"))
    )
    # A release has a base if the one before it was delivered at all: one flag a release, from the table's release numbers.
    known = df.select(F.col(release).cast("int").alias("n")).distinct()
    based = known.alias("a").join(known.alias("b"), F.col("a.n") == F.col("b.n") + 1).select(F.col("a.n").alias("release_no"))
    new = rows.join(based, "release_no", "left_semi").select("release_no", "record_key", F.col("v").alias("new_v"), F.col("h").alias("new_h"))
    old = rows.withColumn("release_no", F.col("release_no") + 1).join(based, "release_no", "left_semi").select("release_no", "record_key", F.col("v").alias("old_v"), F.col("h").alias("old_h"))
    both = old.join(new, ["release_no", "record_key"], "full_outer").filter(~F.col("old_h").eqNullSafe(F.col("new_h")))
    one_sided = F.when(F.col("old_h").isNull(), "added").when(F.col("new_h").isNull(), "removed")
    cell = lambda name, kind, a, b: F.struct(F.lit(name).alias("field_name"), kind.alias("change_type"), a.alias("old_value"), b.alias("new_value"))
    cells = F.when(
        one_sided.isNotNull(),
        F.array(cell("", one_sided, F.to_json("old_v"), F.to_json("new_v"))),
    ).otherwise(
        F.filter(F.array(*[cell(f, F.lit("updated"), F.col(f"old_v.{f}"), F.col(f"new_v.{f}")) for f in fields]), lambda x: x["old_value"] != x["new_value"])
    )
    return both.select("release_no", "record_key", F.explode(cells).alias("c")).select("release_no", "record_key", "c.*")
