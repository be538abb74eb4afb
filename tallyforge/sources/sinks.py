"""Readers and writers of tables as files."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyforge.operators.relational import row_digest


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], row_group_mb: int = 128) -> None:
    """Parquet in the order of the keys. Range partitions sort in parallel; file names follow the order."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", row_group_mb << 20).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str, keys: Sequence[str]) -> None:
    """Parquet with one folder per value of `by`; null stands under `unknown`. Only written partitions are replaced."""
    part = F.coalesce(F.col(by).cast("string"), F.lit("unknown"))
    df.withColumn(by, part).repartition(by, F.pmod(F.xxhash64(*keys), F.lit(8))).sortWithinPartitions(by, *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(by).parquet(path)


def content_digest(df: DataFrame) -> str:
    """A digest of a table's rows, whatever their order: row digests are summed in parallel."""
    rows = df.select(row_digest([F.to_json(F.col(c)) if df.schema[c].dataType.typeName() in ("array", "struct", "map") else F.col(c) for c in sorted(df.columns)]).alias("h"))
    parts = [F.sum(F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")).alias(f"p{i}") for i in range(4)]
    got = rows.agg(F.count("*").alias("n"), *parts).first()
    return hashlib.sha256(json.dumps([sorted(df.columns), *[str(x) for x in got]]).encode()).hexdigest()


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_by_content(df: DataFrame, root: str) -> str:
    """Write df under its digest, unless it is there already: written aside first, then renamed, so readers see all or nothing."""
    spark = df.sparkSession
    final = f"{root}/{content_digest(df)}"
    fs, target = _fs(spark, final)
    if not fs.exists(target):
        aside = final + ".part"
        df.write.mode("overwrite").option("compression", "zstd").parquet(aside)
        if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(aside), target) and not fs.exists(target):
            raise OSError(f"{aside} could not be renamed")
    return final


def append_log(df: DataFrame, path: str) -> None:
    """Append changes to a log of Parquet files."""
    df.write.mode("append").option("compression", "zstd").parquet(path)


def read_typed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet by a declared schema; a missing column is an error, others are left out."""
    have = spark.read.parquet(path)
    missing = [f.name for f in schema if f.name not in have.columns]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return have.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def read_merged(spark: SparkSession, paths: Sequence[str], schema: StructType) -> DataFrame:
    """Files of differing schemas by column name, with the file each row comes from; an empty typed table without files."""
    if not paths:
        return spark.createDataFrame([], StructType([*schema.fields]).add("file", "string"))
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema], F.col("_metadata.file_name").alias("file"))


def read_overrides(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reviewed CSV rules with a header; rows that do not fit the schema stop the read."""
    return spark.read.option("header", "true").option("mode", "FAILFAST").option("enforceSchema", "false").schema(schema).csv(path)
