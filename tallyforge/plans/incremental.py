"""Sinks, incremental operators and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyforge.functions import times
from tallyforge.operators import relational as R
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.session import bounded_rows, scratch, table
from tallyforge.sources import sinks
from tallyforge.streaming import streams

query = Queries()
MAX_RELEASES = 10_000  # more parts of a log at once are an error


def _path(spark, name):
    return scratch(spark, f"out-{name}")


@query(f"SELECT entry_id, contest_id, name_raw FROM {ENTRIES}")
def sink_sorted(spark, d):
    """A sorted Parquet table, written and read."""
    path = _path(spark, "sorted")
    sinks.write_sorted(_once(spark, d, "entries", "entry_id").select("entry_id", "contest_id", "name_raw"), path, ["entry_id"])
    return spark.read.parquet(path)


@query(f"""
SELECT p.placement_id, coalesce(CAST(v."year" AS VARCHAR), 'unknown') AS y, p.place FROM {PLACEMENTS} p LEFT JOIN {EVENTS} v USING (event_id)
""")
def sink_partitioned(spark, d):
    """Placements in one folder per event year; unknown years keep a folder of their own."""
    v = _once(spark, d, "dance_events", "event_id").select("event_id", F.col("year").alias("y"))
    path = _path(spark, "years")
    sinks.write_partitioned(_once(spark, d, "placements", "placement_id").select("placement_id", "event_id", "place").join(v, "event_id", "left").select("placement_id", "y", "place"), path, "y", ["placement_id"])
    return spark.read.option("recursiveFileLookup", "false").schema("placement_id string, place tinyint, y string").parquet(path)


@query("SELECT wsdc_id, role, series_id FROM registry_placements")
def sink_by_content(spark, d):
    """A table stored under its digest; the second write finds it there."""
    r = table(spark, d, "registry_placements").select("wsdc_id", "role", "series_id")
    root = _path(spark, "content")
    first = sinks.write_by_content(r, root)
    if sinks.write_by_content(r.orderBy("role"), root) != first:
        raise AssertionError("the digest depends on the order of rows")
    return spark.read.parquet(first)


@query("""
SELECT release_no, record_key, status FROM (SELECT release_no, lower(trim(record_key)) AS record_key, lower(trim(status)) AS status FROM link_snapshots) GROUP BY 1, 2, 3
""")
def sink_change_log_all(spark, d):
    """A log that grows by one appended part for each release present."""
    k = table(spark, d, "link_snapshots").select("release_no", F.lower(F.trim("record_key")).alias("record_key"), F.lower(F.trim("status")).alias("status")).distinct()
    path = _path(spark, "log")
    for r in sorted(bounded_rows(k.select("release_no").distinct(), MAX_RELEASES, "releases"), key=lambda r: (r[0] is None, r[0])):
        sinks.append_log(k.filter(F.col("release_no").eqNullSafe(F.lit(r[0]))), path)
    return spark.read.parquet(path)


@query(f"""
WITH s AS (SELECT entry_id, contest_id, source, first_seen_at FROM {ENTRIES}), t AS (SELECT * FROM s WHERE source <> 'wdr' UNION ALL SELECT entry_id, contest_id, source, first_seen_at FROM s WHERE source = 'wdr' AND entry_id NOT LIKE '%/C-%')
SELECT * FROM t
""")
def replace_scopes(spark, d):
    """A source's rows replaced as a whole; first-seen times stay."""
    s = _once(spark, d, "entries", "entry_id").select("entry_id", "contest_id", "source", "first_seen_at")
    proposed = s.filter("source = 'wdr' and entry_id not like '%/C-%'").withColumn("first_seen_at", F.col("first_seen_at") + F.expr("interval 1 day"))
    return R.replace_scope(s, proposed, ["source"], ["entry_id"], "first_seen_at")


@query(f"""
SELECT event_id, CASE WHEN country = 'US' THEN upper(city) ELSE city END AS city, first_seen_at FROM {EVENTS}
""")
def upsert_events(spark, d):
    """Changed rows put over stored ones; owner columns stay."""
    s = _once(spark, d, "dance_events", "event_id").select("event_id", "city", "first_seen_at", "country")
    change = s.filter("country = 'US'").withColumn("city", F.upper("city")).withColumn("first_seen_at", F.col("first_seen_at") + F.expr("interval 9 days"))
    return R.upsert(s.drop("country"), change.drop("country"), ["event_id"], ["first_seen_at"])


@query(f"""
WITH s AS (SELECT event_id, count(*) AS n, max(last_seen_at) AS seen FROM {ENTRIES} GROUP BY 1)
SELECT event_id, CASE WHEN seen >= TIMESTAMP '2024-10-01' THEN 'rebuild' ELSE 'reuse' END AS plan FROM s
""")
def partition_plan(spark, d):
    """Which partitions to build again: those whose input digest differs from the stored one."""
    e = _once(spark, d, "entries", "entry_id")
    digest = lambda df: df.groupBy("event_id").agg(F.count("*").alias("n"), F.sum(F.xxhash64("entry_id", "last_seen_at", "name_raw").cast("decimal(38,0)")).alias("h"))
    now = digest(e)
    before = digest(e.filter(F.col("last_seen_at") < F.lit("2024-10-01 00:00:00").cast("timestamp_ntz"))).withColumnsRenamed({"n": "n0", "h": "h0"})
    j = now.join(before, "event_id", "left")
    return j.select("event_id", F.when(F.col("n").eqNullSafe(F.col("n0")) & F.col("h").eqNullSafe(F.col("h0")), "reuse").otherwise("rebuild").alias("plan"))


@query("""
SELECT record_key, release_no FROM (SELECT lower(trim(record_key)) AS record_key, release_no, lower(trim(status)) AS s, lag(lower(trim(status))) OVER (PARTITION BY lower(trim(record_key)) ORDER BY release_no) AS b, row_number() OVER (PARTITION BY lower(trim(record_key)) ORDER BY release_no) AS n
 FROM (SELECT record_key, release_no, min(lower(trim(status))) AS status FROM (SELECT lower(trim(record_key)) AS record_key, release_no, status FROM link_snapshots) GROUP BY 1, 2)) WHERE n = 1 OR s IS DISTINCT FROM b
""")
def early_cutoff(spark, d):
    """Releases that changed a record; equal output stops the cascade."""
    from pyspark.sql import Window

    k = table(spark, d, "link_snapshots").select(F.lower(F.trim("record_key")).alias("record_key"), "release_no", F.lower(F.trim("status")).alias("s")).groupBy("record_key", "release_no").agg(F.min("s").alias("s"))
    w = Window.partitionBy("record_key").orderBy("release_no")
    return k.withColumn("n", F.row_number().over(w)).withColumn("b", F.lag("s").over(w)).filter((F.col("n") == 1) | ~F.col("s").eqNullSafe(F.col("b"))).select("record_key", "release_no")


@query("""
SELECT entry_id, max(last_seen_at) AS seen FROM entries WHERE first_seen_at <= TIMESTAMP '2024-06-30' GROUP BY 1
""")
def as_of_cutoff(spark, d):
    """Evidence up to a cutoff only."""
    return table(spark, d, "entries").filter(F.col("first_seen_at") <= F.lit("2024-06-30 00:00:00").cast("timestamp_ntz")).groupBy("entry_id").agg(F.max("last_seen_at").alias("seen"))


@query("""
SELECT family, datediff('day', max(recorded_at), (SELECT max(recorded_at) FROM raw_receipts)) AS lag_days, count(DISTINCT file_name) AS files FROM raw_receipts GROUP BY 1
""")
def pipeline_lag(spark, d):
    """How far behind the newest each family is."""
    r = table(spark, d, "raw_receipts")
    g = r.groupBy("family").agg(F.max("recorded_at").alias("m"), F.countDistinct("file_name").alias("files"))
    return g.join(r.agg(F.max("recorded_at").alias("now"))).select("family", F.date_diff(F.col("now").cast("date"), F.col("m").cast("date")).cast("long").alias("lag_days"), "files")


@query("""
WITH RECURSIVE f AS (SELECT family, file_name, row_number() OVER (PARTITION BY family ORDER BY min(recorded_at), file_name) AS n FROM raw_receipts GROUP BY 1, 2),
c AS (SELECT f.family, f.file_name, f.n, 0 AS depth FROM f JOIN (SELECT family, max(n) AS n FROM f GROUP BY 1) l ON l.family = f.family AND l.n = f.n UNION ALL SELECT f.family, f.file_name, f.n, c.depth + 1 FROM c JOIN f ON f.family = c.family AND f.n = c.n - 1)
SELECT file_name AS node, depth FROM c
""")
def chain_walk(spark, d):
    """Predecessors of each family's newest file, step by step."""
    from tallyforge.operators.drift import file_order

    o = file_order(table(spark, d, "raw_receipts"))
    newest = o.groupBy("family").agg(F.max_by("file_name", "seq").alias("node")).select("node")
    return R.reach(newest, o, "node", "file_name", "prev_file")


@query(f"""
WITH r AS (SELECT DISTINCT leader_entry_id AS k FROM {PLACEMENTS} WHERE leader_entry_id IS NOT NULL UNION SELECT follower_entry_id FROM {PLACEMENTS} WHERE follower_entry_id IS NOT NULL UNION SELECT couple_entry_id FROM {PLACEMENTS} WHERE couple_entry_id IS NOT NULL)
SELECT entry_id FROM {ENTRIES} WHERE entry_id NOT IN (SELECT k FROM r)
""")
def mark_and_sweep(spark, d):
    """Entries that no root refers to."""
    p = _once(spark, d, "placements", "placement_id")
    marked = p.select(F.explode(F.array("leader_entry_id", "follower_entry_id", "couple_entry_id")).alias("k")).filter("k is not null").distinct()
    return _once(spark, d, "entries", "entry_id").join(marked, F.col("entry_id") == F.col("k"), "left_anti").select("entry_id")


@query("""
SELECT file_name, line_no, CASE WHEN attempts >= 5 THEN 'quarantine' WHEN attempts >= 3 THEN 'backoff' ELSE 'transient' END AS class, least(21600, 900 * pow(2, greatest(0, attempts - 1))) AS wait_s
FROM (SELECT file_name, line_no, count(*) AS attempts FROM raw_receipts WHERE body IS NULL OR NOT starts_with(trim(body), '{') OR NOT ends_with(trim(body), '}') GROUP BY 1, 2)
""")
def failure_classes(spark, d):
    """Unreadable lines by how often they failed, with the wait before the next try."""
    bad = table(spark, d, "raw_receipts").filter("body is null or not startswith(trim(body), '{') or not endswith(trim(body), '}')")
    g = bad.groupBy("file_name", "line_no").agg(F.count("*").alias("attempts"))
    return g.select("file_name", "line_no", F.when(F.col("attempts") >= 5, "quarantine").when(F.col("attempts") >= 3, "backoff").otherwise("transient").alias("class"), times.backoff(F.col("attempts")).alias("wait_s"))


@query("""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2
""")
def stream_windows(spark, d):
    """Hourly counts per event type as a stream with a watermark; each trigger updates the windows it touched."""
    s = streams.arriving(spark, f"{d}/events.parquet", d, "events.parquet")
    return streams.run_to_table(streams.windowed_counts(s, "ts", ["event_type"], "value", "1 hour", "1 day"), _path(spark, "windows"), "update", ["window_start", "event_type"])


@query("""
WITH x AS (SELECT DISTINCT user_id, ts, event_id, event_type FROM events), c AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM x WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c),
s AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) - 1 AS streak, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back, count(*) OVER (PARTITION BY user_id) AS n_seen FROM g)
SELECT user_id, event_type AS last_value, streak, n_seen FROM s WHERE back = 1
""")
def stream_streaks(spark, d):
    """Each user's current streak as state of a stream."""
    s = streams.arriving(spark, f"{d}/events.parquet", d, "events.parquet")
    return streams.run_to_table(streams.unchanged_streaks(s, "user_id", "ts", "event_id", "event_type"), _path(spark, "streaks"), "update", ["user_id"])


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark, d):
    """The first row of each user and type; repeats within the watermark are dropped."""
    s = streams.arriving(spark, f"{d}/events.parquet", d, "events.parquet").select("user_id", "event_type", "ts")
    return streams.run_to_table(streams.new_bodies(s, ["user_id", "event_type"], "ts", "3650 days"), _path(spark, "first"), "append").select("user_id", "event_type")


@query(f"SELECT entry_id, CAST(wsdc_id AS BIGINT) AS wsdc_id, bib FROM {ENTRIES}")
def read_declared(spark, d):
    """A written table read by a declared schema: wider types by cast, other columns left out."""
    path = scratch(spark, "declared")
    _once(spark, d, "entries", "entry_id").select("entry_id", "wsdc_id", "bib", "role").write.parquet(path)
    return sinks.read_typed(spark, path, StructType().add("entry_id", "string").add("wsdc_id", "long").add("bib", "string"))


@query(f"SELECT event_id, CASE WHEN \"year\" % 2 = 0 THEN city END AS city, CASE WHEN \"year\" % 2 = 1 THEN country END AS country FROM {EVENTS} WHERE \"year\" IS NOT NULL")
def read_partitions(spark, d):
    """Partitions of differing schemas as one table; columns a partition lacks are null."""
    v, paths = _once(spark, d, "dance_events", "event_id").filter("year is not null"), []
    for rest, columns in ((0, ["event_id", "city"]), (1, ["event_id", "country"])):
        paths.append(scratch(spark, f"part{rest}"))
        v.filter(F.col("year") % 2 == rest).select(*columns).write.parquet(paths[-1])
    out = sinks.read_merged(spark, paths, StructType().add("event_id", "string").add("city", "string").add("country", "string"))
    return out.filter("file is not null").drop("file")


@query("SELECT DISTINCT nickname, canonical FROM nicknames WHERE nickname IS NOT NULL AND canonical IS NOT NULL")
def read_reviewed(spark, d):
    """Reviewed rules from CSV with a header, of which none may break the schema."""
    path = scratch(spark, "rules")
    table(spark, d, "nicknames").select("nickname", "canonical").dropna().distinct().write.option("header", "true").csv(path)
    return sinks.read_overrides(spark, path, "nickname string, canonical string")


queries, oracle_sql = query.queries, query.oracle_sql
