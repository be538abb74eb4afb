"""Queries pN_ of the general training-data operators, with their SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators.drift import schema_changes, unified_rows, unified_table
from tallyforge.operators.orphans import Parent, Reference, orphan_references, orphan_report
from tallyforge.operators.packed import split_packed
from tallyforge.operators.snapshots import snapshot_changes
from tallyforge.operators.twocopy import compare_copies
from tallyforge.session import cut, table

MEASURES = ["contests", "rounds", "entries", "discovered_units", "acquired_units", "interpreted_units", "mapped_units", "withheld_units", "resolved_identities", "identity_subjects"]
EVENT_FIELDS = {"name": "text", "year": "number", "start_date": "date", "end_date": "date", "city": "text", "country": "text", "website": "text", "wsdc_status": "text", "sources": "set"}
COVERAGE_FIELDS = {"scope_status": "text"} | {m: "number" for m in MEASURES} | {"method": "text"}
LINK_FIELDS = {"wsdc_id": "number", "method": "text", "status": "text", "confidence": "decimal6", "constraints_applied": "set", "acceptance_state": "text"}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return split_packed(table(spark, d, "entries"), ["entry_id"], ["name_raw", "role"], "last_seen_at")


def p2_cells(spark: SparkSession, d: str) -> DataFrame:
    events = compare_copies(table(spark, d, "dance_events"), table(spark, d, "event_mirror"), ["event_id"], EVENT_FIELDS, "last_seen_at")
    coverage = compare_copies(table(spark, d, "coverage"), table(spark, d, "coverage_mirror"), ["scope_kind", "scope_id", "source", "via"], COVERAGE_FIELDS, "last_changed_at")
    return events.select(F.lit("dance_events").alias("table_name"), "*").unionByName(coverage.select(F.lit("coverage").alias("table_name"), "*"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_cells(spark, d).select("table_name", "record_key", "field_name", "diff_kind")


def p4_changes(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "link_snapshots"), "release_no", "delivery_no", "record_key", LINK_FIELDS, "asserted_at")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_changes(spark, d).select("release_no", "record_key", "field_name", "change_type")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    entries, placements, registry = (table(spark, d, t) for t in ("entries", "placements", "registry_placements"))
    parents = [
        Parent("entries", entries, "entry_id", "first_seen_at"),
        Parent("contests", table(spark, d, "contests"), "contest_id", "first_seen_at"),
        Parent("dance_events", table(spark, d, "dance_events"), "event_id", "first_seen_at"),
    ]
    registry_key = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in (F.col("wsdc_id").cast("string"), F.col("role"), F.col("series_id"), F.date_format("event_month", "yyyy-MM"), F.col("division"), F.col("dance_style"))])
    references = [
        Reference("placements", "leader_entry_id", placements, F.col("placement_id"), "entries", "first_seen_at"),
        Reference("placements", "follower_entry_id", placements, F.col("placement_id"), "entries", "first_seen_at"),
        Reference("registry_placements", "event_id", registry, registry_key, "dance_events", "first_seen_at"),
        Reference("entries", "contest_id", entries, F.col("entry_id"), "contests", "first_seen_at"),
    ]
    return orphan_references(parents, references, table(spark, d, "removals"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(p5_found(spark, d))


def p6_changes(spark: SparkSession, d: str) -> DataFrame:
    return schema_changes(table(spark, d, "raw_receipts"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_changes(spark, d).select("file_name", "field_path", "change_kind", "new_path")


def p6_unified(spark: SparkSession, d: str) -> DataFrame:
    receipts = table(spark, d, "raw_receipts")
    return unified_rows(receipts, schema_changes(receipts))


def p6_table(spark: SparkSession, d: str) -> DataFrame:
    """All families' lines as one typed table."""
    return unified_table(cut(p6_unified(spark, d), "unified"))


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p2_found, p2_cells, p4_found, p4_changes, p5_found, p5_report, p6_found, p6_changes, p6_unified, p6_table)}



_TRIM = r"regexp_replace(regexp_replace(CAST({c} AS VARCHAR), '^[\s\x{{a0}}]+', ''), '[\s\x{{a0}}]+$', '')"


def _bare(c: str) -> str:
    return _TRIM.format(c=c)


def _value_sql(c: str, kind: str, is_array: bool) -> str:
    t = _bare(c)
    if kind == "number":
        return f"coalesce(CAST(TRY_CAST(regexp_replace({t}, '(\\d),(\\d{{3}})', '\\1\\2', 'g') AS DOUBLE) AS VARCHAR), {t}, '')"
    if kind == "date":
        return f"coalesce(CAST(coalesce(CASE WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(substr({t}, 1, 10) AS DATE) END, CAST(TRY_STRPTIME({t}, '%d %b %Y') AS DATE)) AS VARCHAR), {t}, '')"
    if kind == "set":
        parts = c if is_array else f"regexp_split_to_array({c}, '[,;|]')"
        return f"coalesce(array_to_string(list_sort(list_distinct([{_bare('x')} FOR x IN {parts} IF {_bare('x')} <> ''])), ','), '')"
    return f"nfc_normalize(coalesce({t}, ''))"


def _copies_sql(name: str, left: str, right: str, key: list[str], fields: dict[str, str]) -> str:
    k = "concat_ws('|', " + ", ".join(f"coalesce(lower({_bare(x)}), '')" for x in key) + ")"
    side = lambda t, arrays: f"(SELECT DISTINCT {k} AS k, " + ", ".join(f"{_value_sql(f, kind, arrays and kind == 'set')} AS {f}" for f, kind in fields.items()) + f" FROM {t})"
    out = [
        f"SELECT '{name}' AS table_name, l.k AS record_key, '' AS field_name, 'only_left' AS diff_kind FROM l_{name} l ANTI JOIN r_{name} r ON l.k = r.k",
        f"SELECT '{name}', r.k, '', 'only_right' FROM r_{name} r ANTI JOIN l_{name} l ON l.k = r.k",
        *[f"SELECT '{name}', l.k, '{f}', 'differs' FROM l_{name} l JOIN r_{name} r ON l.k = r.k WHERE l.{f} <> r.{f}" for f in fields],
    ]
    return f"l_{name} AS {side(left, True)}, r_{name} AS {side(right, False)}", " UNION ALL ".join(out)


def _p2_sql() -> str:
    parts = [_copies_sql("dance_events", "dance_events", "event_mirror", ["event_id"], EVENT_FIELDS), _copies_sql("coverage", "coverage", "coverage_mirror", ["scope_kind", "scope_id", "source", "via"], COVERAGE_FIELDS)]
    return "WITH " + ", ".join(p[0] for p in parts) + " " + " UNION ALL ".join(p[1] for p in parts)


def _p4_sql() -> str:
    value = {
        "text": "coalesce(lower(" + _TRIM + "), '')", "number": "coalesce(CAST({c} AS VARCHAR), '')", "decimal6": "coalesce(CAST(CAST(round({c}, 6) AS DECIMAL(30, 6)) AS VARCHAR), '')",
        "set": "coalesce(lower(array_to_string(list_sort(list_distinct([trim(x) FOR x IN {c} IF trim(x) <> ''])), ',')), '')",
    }
    cells = ", ".join(f"{value[k].format(c=f)} AS {f}" for f, k in LINK_FIELDS.items())
    rows = f"(SELECT release_no, lower({_bare('record_key')}) AS k, asserted_at, {cells} FROM link_snapshots WHERE record_key IS NOT NULL AND (release_no, delivery_no) IN (SELECT (release_no, max(delivery_no)) FROM link_snapshots GROUP BY release_no))"
    once = f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY release_no, k ORDER BY asserted_at DESC NULLS LAST, {', '.join(f'{f} DESC' for f in LINK_FIELDS)}) AS n FROM {rows}) WHERE n = 1)"
    based = "(SELECT DISTINCT a.release_no AS r FROM link_snapshots a JOIN link_snapshots b ON a.release_no = b.release_no + 1)"
    return (
        f"WITH s AS {once}, b AS {based}, n AS (SELECT * FROM s WHERE release_no IN (SELECT r FROM b)), o AS (SELECT * REPLACE (release_no + 1 AS release_no) FROM s WHERE release_no + 1 IN (SELECT r FROM b)) "
        "SELECT CAST(n.release_no AS INTEGER) AS release_no, n.k AS record_key, '' AS field_name, 'added' AS change_type FROM n ANTI JOIN o ON n.release_no = o.release_no AND n.k = o.k "
        "UNION ALL SELECT CAST(o.release_no AS INTEGER), o.k, '', 'removed' FROM o ANTI JOIN n ON n.release_no = o.release_no AND n.k = o.k "
        + " ".join(f"UNION ALL SELECT CAST(n.release_no AS INTEGER), n.k, '{f}', 'updated' FROM n JOIN o ON n.release_no = o.release_no AND n.k = o.k WHERE n.{f} <> o.{f}" for f in LINK_FIELDS)
    )


_REGISTRY_KEY = "concat_ws('|', coalesce(CAST(wsdc_id AS VARCHAR), ''), coalesce(role, ''), coalesce(series_id, ''), coalesce(strftime(event_month, '%Y-%m'), ''), coalesce(division, ''), coalesce(dance_style, ''))"


def _p5_sql() -> str:
    fold = lambda c: f"lower({_bare(c)})"
    refs = [("placements", "leader_entry_id", "placement_id", "entries"), ("placements", "follower_entry_id", "placement_id", "entries"), ("registry_placements", "event_id", _REGISTRY_KEY, "dance_events"), ("entries", "contest_id", "entry_id", "contests")]
    child = " UNION ALL ".join(f"SELECT '{p}' AS parent, {fold(f)} AS k, '{t}' AS table_name, '{f}' AS ref_field, {key} AS row_key, first_seen_at AS seen FROM {t} WHERE {f} IS NOT NULL" for t, f, key, p in refs)
    parent = " UNION ALL ".join(f"SELECT '{t}' AS parent, {fold(k)} AS k, min(first_seen_at) AS seen FROM {t} WHERE {k} IS NOT NULL GROUP BY 2" for t, k in (("entries", "entry_id"), ("contests", "contest_id"), ("dance_events", "event_id")))
    return f"""
WITH c AS ({child}), p AS ({parent}), x AS (SELECT DISTINCT {fold('table_name')} AS parent, {fold('record_key')} AS k FROM removals WHERE record_key IS NOT NULL),
j AS (SELECT c.*, CASE WHEN p.k IS NOT NULL THEN CASE WHEN p.seen > c.seen THEN 'late' END WHEN x.k IS NOT NULL THEN 'deleted' ELSE 'missing' END AS reason FROM c LEFT JOIN p ON p.parent = c.parent AND p.k = c.k LEFT JOIN x ON x.parent = c.parent AND x.k = c.k)
SELECT table_name, ref_field, row_key, strftime(min(seen), '%Y-%m') AS period, reason FROM j WHERE reason IS NOT NULL GROUP BY table_name, ref_field, row_key, reason"""


def oracle_sql() -> dict:
    p5 = _p5_sql()
    return {
        "p2_found": _p2_sql(), "p4_found": _p4_sql(), "p5_found": p5,
        "p5_report": f"SELECT table_name, ref_field, period, reason, count(*) AS n_orphans FROM ({p5}) GROUP BY 1, 2, 3, 4",
    }
