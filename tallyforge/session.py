"""Session helpers: reading tables, cutting lineage, bounded driver reads."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[int, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Only where the session names none (tests on one machine) a temporary folder is made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = id(spark.sparkContext)
    if key not in _LOCAL_DIRS:
        _LOCAL_DIRS[key] = tempfile.mkdtemp(prefix="tallyforge-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[key], True)
    return "file://" + _LOCAL_DIRS[key]


def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may have ended already
        pass


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the driver's Python ends, not earlier, since plans may still read it."""
    path = f"{shared_dir(spark)}/tallyforge/{tag}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def cut(df: DataFrame, tag: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there, and a lost executor costs no recomputation."""
    path = scratch(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_rows(df: DataFrame, bound: int, what: str) -> list:
    """Collect a table whose size has a proven bound; more rows than that is an error, never a silent cut."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what}: more than {bound} rows")
    return rows
