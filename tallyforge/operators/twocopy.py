"""Differences between two copies of one dataset, field by field."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.clean import date_text, folded, number_text, plain_text, set_text

BUCKET_ROWS = 100_000  # rows of both sides a bucket holds on average
_SCHEMA = "record_key string, field_name string, diff_kind string, left_value string, right_value string"


def _normal(df: DataFrame, key: list[str], fields: dict[str, str], version: str | None) -> DataFrame:
    """(record_key, one normal text per field), one row a key: of repeated rows the one with the greatest version, then values."""
    types = dict(df.dtypes)
    make = {"text": plain_text, "number": number_text, "date": date_text}
    values = [
        (set_text(F.col(f), types[f].startswith("array")) if kind == "set" else make[kind](F.col(f))).alias(f"v_{i}")
        for i, (f, kind) in enumerate(fields.items())
    ]
    record_key = F.concat_ws("|", *[F.coalesce(folded(F.col(k)), F.lit("")) for k in key])
    rank = [F.col(version).alias("_version")] if version else []
    best = F.max(F.struct(*[c.alias(n) for c, n in [(F.col("_version"), "_version")][: len(rank)]], *[F.col(f"v_{i}") for i in range(len(fields))]))
    return df.select(record_key.alias("record_key"), *rank, *values).groupBy("record_key").agg(best.alias("_b")).select(
        "record_key", *[F.col(f"_b.v_{i}").alias(f"v_{i}") for i in range(len(fields))]
    )


def _cells(fields: dict[str, str]):
    names, kinds = list(fields), list(fields.values())

    def coded(left: pa.Table, right: pa.Table) -> list[np.ndarray]:
        """Both sides' keys as numbers of one dictionary, so that sorting and searching compare no strings."""
        keys = pa.chunked_array([*left["record_key"].chunks, *right["record_key"].chunks], pa.string()).combine_chunks()
        numbers = keys.dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(keys) else np.zeros(0, dtype=np.int32)
        return [numbers[: left.num_rows], numbers[left.num_rows :]]

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        sides = []
        for t, codes in zip((left, right), coded(left, right)):
            order = np.argsort(codes, kind="stable")
            sides.append((t.take(pa.array(order)), codes[order]))
        (left, lk), (right, rk) = sides
        if len(lk) and len(rk):
            at = np.minimum(np.searchsorted(rk, lk), len(rk) - 1)
            both = rk[at] == lk
            back = np.minimum(np.searchsorted(lk, rk), len(lk) - 1)
            extra = lk[back] != rk
        else:
            at, both, extra = np.zeros(len(lk), int), np.zeros(len(lk), bool), np.ones(len(rk), bool)
        l_key, r_key = (t["record_key"].combine_chunks() for t in (left, right))
        parts: list[pa.Table] = []

        def emit(keys, field: str, kind: str, a=None, b=None) -> None:
            n, none = len(keys), pa.nulls(len(keys), pa.string())
            text = lambda s: pa.array([s] * n, pa.string())
            parts.append(pa.table({"record_key": keys, "field_name": text(field), "diff_kind": text(kind), "left_value": none if a is None else a, "right_value": none if b is None else b}))

        emit(l_key.filter(pa.array(~both)), "", "only_left")
        emit(r_key.filter(pa.array(extra)), "", "only_right")
        l_at, r_at = pa.array(np.flatnonzero(both)), pa.array(at[both])
        shared = l_key.take(l_at)
        for i, name in enumerate(names):
            a, b = (pc.fill_null(t[f"v_{i}"].take(x), "").combine_chunks() for t, x in ((left, l_at), (right, r_at)))
            if kinds[i] == "text":
                a, b = pc.utf8_normalize(a, "NFC"), pc.utf8_normalize(b, "NFC")
            off = pc.not_equal(a, b)
            if pc.any(off).as_py():
                emit(shared.filter(off), name, "differs", a.filter(off), b.filter(off))
        return pa.concat_tables([p.cast(parts[0].schema) for p in parts])

    return compare


def compare_copies(left: DataFrame, right: DataFrame, key: list[str], fields: dict[str, str], left_version: str | None = None, right_version: str | None = None) -> DataFrame:
    """Rows missing on either side and fields whose values differ: record_key, field_name, diff_kind, left_value, right_value.

    `fields` maps each compared field to how it is read: text (apart from outer blanks and Unicode form), number, date or
    set. Keys are compared without outer blanks and case, their parts joined by `|`, null as empty; null values equal ''.
    Repeated rows of a key count once, by the greatest version. Both sides are hashed into as many buckets as their rows
    need; a bucket is compared as two Arrow tables. Repeats are merged before, with partial sums, so that no bucket grows
    with them. Empty tables make every row of the other side one-sided; other columns are ignored.
    """
    sides = [_normal(left, key, fields, left_version), _normal(right, key, fields, right_version)]
    rows = left.count() + right.count()
    spark = left.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / BUCKET_ROWS))
    a, b = (s.withColumn("_bucket", F.pmod(F.xxhash64("record_key"), F.lit(buckets))).groupBy("_bucket") for s in sides)
    return a.cogroup(b).applyInArrow(_cells(fields), _SCHEMA)
