"""Suppression of people: learned to a fixpoint, then applied to every table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.relational import reach

# What a replaced identifier is made from, and parts of identifiers that hold a name.
PREFIX, SALT = "suppressed-", "suppressed-subject-v1|"
NAMED_PARTS = ["/judge/", "/L-name-", "/F-name-", "/C-name-"]


def learned_subjects(subjects: DataFrame, seeds: DataFrame) -> DataFrame:
    """(subject, depth): the subjects that a suppression covers. subjects has subject, wsdc_id and name, seeds has subject.

    A subject's id and name cover every other subject with the same id or name, and so on until nothing is new. Ids and
    names are nodes between the subjects, so that a name of very many subjects needs no pairs of them.
    """
    by = lambda c, tag: subjects.filter(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).select("subject", F.concat(F.lit(tag), F.col(c).cast("string")).alias("node"))
    one = by("wsdc_id", "#").unionByName(by("name", "~")).distinct()
    node = F.concat(F.lit("@"), "subject")
    edges = one.select(node.alias("a"), F.col("node").alias("b")).unionByName(one.select(F.col("node").alias("a"), node.alias("b")))
    found = reach(seeds.select(F.concat(F.lit("@"), "subject").alias("node")), edges, "node", "a", "b")
    return found.filter(F.col("node").startswith("@")).select(F.substring("node", 2, 1_000_000).alias("subject"), "depth")


def replaced_id(identifier: Column) -> Column:
    """An identifier without the name it holds; others stay."""
    holds = F.exists(F.array(*[F.lit(p) for p in NAMED_PARTS]), lambda p: F.contains(identifier, p))
    return F.when(holds, F.concat(F.lit(PREFIX), F.substring(F.sha2(F.concat(F.lit(SALT), identifier), 256), 1, 24))).otherwise(identifier)


def scrub_subjects(df: DataFrame, covered: DataFrame, key: str, personal: list[str]) -> DataFrame:
    """df with the personal columns of covered rows nulled and their key replaced where it holds a name."""
    j = df.join(covered.select(F.col("subject").alias(key)).distinct().withColumn("_hit", F.lit(True)), key, "left")
    hit = F.coalesce("_hit", F.lit(False))
    kept = [F.when(~hit, F.col(c)).alias(c) if c in personal else F.when(hit, replaced_id(F.col(c))).otherwise(F.col(c)).alias(c) if c == key else F.col(c) for c in df.columns]
    return j.select(*kept, hit.alias("suppressed"))


def scrub_json(body: Column, words: list[str]) -> Column:
    """JSON text with every string value that holds one of the words as whole words replaced by null; keys stay."""
    for w in words:
        body = F.regexp_replace(body, r'(?i)(:\s*|[\[,]\s*)"(?:[^"\\]|\\.)*\b' + w + r'\b(?:[^"\\]|\\.)*"(?!\s*:)', "$1null")
    return body
