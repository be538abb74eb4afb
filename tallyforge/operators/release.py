"""Building a release: checked, sorted tables under one root, with a change log against the release before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.relational import diff_rows, duplicate_keys, missing_parents
from tallyforge.sources.sinks import content_digest, write_sorted


@dataclass(frozen=True)
class Table:
    """One published table: its rows, key, references to other tables of the release, and the fields its log follows."""

    df: DataFrame
    key: Sequence[str]
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    logged: Sequence[str] = ()


def check_tables(tables: Mapping[str, Table]) -> DataFrame:
    """(table_name, check_name, n_failed) of every table's key and references."""
    spark = next(iter(tables.values())).df.sparkSession
    out = spark.createDataFrame([], "table_name string, check_name string, n_failed long")
    for name, t in tables.items():
        extra = duplicate_keys(t.df, list(t.key)).agg(F.coalesce(F.sum("n_extra"), F.lit(0)).alias("n_failed"))
        parts = [("key", extra)] + [(f"reference {c}", missing_parents(t.df, c, tables[p].df, k).agg(F.count("*").alias("n_failed"))) for c, (p, k) in t.references.items()]
        for check, one in parts:
            out = out.unionByName(one.select(F.lit(name).alias("table_name"), F.lit(check).alias("check_name"), "n_failed"))
    return out


def close_references(tables: Mapping[str, Table]) -> dict[str, Table]:
    """References to rows the release lacks set to null, so that any subset of tables stays consistent."""
    out = {}
    for name, t in tables.items():
        df = t.df
        for column, (parent, key) in t.references.items():
            known = tables[parent].df.select(F.col(key).alias("_known")).distinct()
            df = df.join(known, F.col(column) == F.col("_known"), "left").withColumn(column, F.col("_known")).drop("_known")
        out[name] = Table(df, t.key, t.references, t.logged)
    return out


def build_release(tables: Mapping[str, Table], root: str, before: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Write the tables sorted by key, and a change log against `before`: (table_name, n_rows, digest, n_changes).

    Tables must pass their checks; the first failing one is an error, and nothing is written.
    """
    failed = check_tables(tables).filter("n_failed > 0").orderBy("table_name", "check_name").first()
    if failed:
        raise ValueError(f"{failed.table_name}: {failed.check_name} fails for {failed.n_failed} rows")
    spark: SparkSession = next(iter(tables.values())).df.sparkSession
    manifest = []
    for name, t in tables.items():
        write_sorted(t.df, f"{root}/{name}", list(t.key))
        written = spark.read.parquet(f"{root}/{name}")
        n_changes = None
        if before and name in before and t.logged:
            log = diff_rows(written, before[name], list(t.key), list(t.logged)).select(F.lit(name).alias("table_name"), "*")
            log.write.mode("overwrite").parquet(f"{root}/changelog/{name}")
            n_changes = spark.read.parquet(f"{root}/changelog/{name}").count()
        manifest.append((name, written.count(), content_digest(written), n_changes))
    return spark.createDataFrame(manifest, "table_name string, n_rows long, digest string, n_changes long")


def replace_findings(stored: DataFrame, found: DataFrame, key: Sequence[str], now) -> DataFrame:
    """Open and closed findings after a run: stored ones not found again close, new ones open, others stay as they were.

    Both tables have the key; stored also opened_at and closed_at. A finding that was closed and is found again reopens.
    """
    s = stored.select(*key, "opened_at", "closed_at", F.lit(True).alias("_s"))
    f = found.select(*key, F.lit(True).alias("_f")).distinct()
    j = s.join(f, list(key), "full_outer")
    fresh = F.col("_s").isNull() | (F.col("_f").isNotNull() & F.col("closed_at").isNotNull())
    opened = F.when(fresh, now).otherwise(F.col("opened_at"))
    closed = F.when(F.col("_f").isNull(), F.coalesce("closed_at", now))
    return j.select(*key, opened.alias("opened_at"), closed.alias("closed_at"))
