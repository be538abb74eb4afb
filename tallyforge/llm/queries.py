"""Queries pN_ of the llm operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.leaks import leaked_passages, without_leaks
from tallyforge.llm.linkage import link_entries
from tallyforge.llm.subjects import composition, subjects_of
from tallyforge.llm.tokens import encode_corpus
from tallyforge.llm.variants import spelling_groups, spelling_pairs
from tallyforge.session import table


def p3_links(spark: SparkSession, d: str) -> DataFrame:
    return link_entries(*[table(spark, d, t) for t in ("entries", "registry_placements", "dancers", "dance_events", "nicknames")])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_links(spark, d).select("entry_id", "wsdc_id")


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    judges = table(spark, d, "judges").filter("not coalesce(anonymous, false)")
    names = table(spark, d, "entries").select("name_raw").unionByName(judges.select("name_raw"))
    return spelling_groups(names, table(spark, d, "nicknames"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return spelling_pairs(p7_groups(spark, d))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"))


def p9_matches(spark: SparkSession, d: str) -> DataFrame:
    return leaked_passages(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_matches(spark, d).select("doc_id", "item_id").distinct()


def p9_kept(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return without_leaks(docs, leaked_passages(docs, table(spark, d, "eval_items"))).select("doc_id")


def p10_subjects(spark: SparkSession, d: str) -> DataFrame:
    return subjects_of(table(spark, d, "documents"), table(spark, d, "doc_labels"), table(spark, d, "subject_areas"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_subjects(spark, d).select("doc_id", "subject").distinct()


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    return composition(p10_found(spark, d), table(spark, d, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (p3_found, p3_links, p7_found, p7_groups, p8_ids, p9_found, p9_matches, p9_kept, p10_found, p10_subjects, p10_composition)}


def oracle_sql() -> dict:
    return {}
