"""Projections, filters, joins and diffs over the event-result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.operators import relational as R
from tallyforge.plans.registry import Queries
from tallyforge.session import table

query = Queries()


def _once(spark: SparkSession, d: str, name: str, key: str) -> DataFrame:
    """A table with one row per key: repeated rows differ in last_seen_at and run_id only, so the latest stands for all."""
    return R.latest(table(spark, d, name), [key], [F.col("last_seen_at"), F.col("run_id")])


# The same in SQL, for the tables' oracle queries.
def _sql_once(name: str, key: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY last_seen_at DESC NULLS LAST, run_id DESC NULLS LAST) AS _n FROM {name}) WHERE _n = 1)"


ENTRIES, CONTESTS, EVENTS, PLACEMENTS, DANCERS = (_sql_once(*x) for x in (("entries", "entry_id"), ("contests", "contest_id"), ("dance_events", "event_id"), ("placements", "placement_id"), ("dancers", "wsdc_id")))


@query("""
SELECT entry_id, CAST(wsdc_id AS INTEGER) AS wsdc_id, CAST(link_confidence AS DOUBLE) AS link_confidence, CAST(first_seen_at AS DATE) AS first_seen
FROM entries WHERE link_status = 'confirmed'
""")
def scan_typed_entries(spark, d):
    """Typed read: declared columns only, conversion by cast, the filter pushed to the scan."""
    e = table(spark, d, "entries").filter(F.col("link_status") == "confirmed")
    return e.select("entry_id", F.col("wsdc_id").cast("int").alias("wsdc_id"), F.col("link_confidence").cast("double").alias("link_confidence"), F.col("first_seen_at").cast("date").alias("first_seen"))


@query(f"""
SELECT e.entry_id, coalesce(c.division, 'none') AS division, coalesce(v.country, '??') AS country, coalesce(CAST(v.start_date AS VARCHAR), v.event_month) AS starts
FROM {ENTRIES} e LEFT JOIN {CONTESTS} c USING (contest_id) LEFT JOIN {EVENTS} v ON e.event_id = v.event_id
""")
def join_evidence(spark, d):
    """Entries with their contest's and event's facts, the best known of each."""
    e, c, v = _once(spark, d, "entries", "entry_id"), _once(spark, d, "contests", "contest_id"), _once(spark, d, "dance_events", "event_id")
    j = e.join(c.select("contest_id", "division"), "contest_id", "left").join(v.select("event_id", "country", "start_date", "event_month"), "event_id", "left")
    return j.select("entry_id", F.coalesce("division", F.lit("none")).alias("division"), F.coalesce("country", F.lit("??")).alias("country"), F.coalesce(F.col("start_date").cast("string"), F.col("event_month")).alias("starts"))


@query("""
SELECT DISTINCT event_id FROM dance_events
WHERE coalesce(coalesce(end_date, start_date) >= DATE '2015-01-01', "year" >= 2015, TRUE)
""")
def filter_history_start(spark, d):
    """Events in the history: by date, else by year; undated ones stay."""
    v = table(spark, d, "dance_events")
    return v.filter(F.coalesce(F.coalesce("end_date", "start_date") >= F.lit("2015-01-01").cast("date"), F.col("year") >= 2015, F.lit(True))).select("event_id").distinct()


@query("""
SELECT DISTINCT entry_id, contest_id FROM entries
WHERE lower(trim(entry_id)) NOT IN (SELECT lower(trim(record_key)) FROM removals WHERE table_name = 'entries' AND record_key IS NOT NULL)
""")
def filter_revoked(spark, d):
    """Rows whose record was not removed."""
    gone = table(spark, d, "removals").filter("table_name = 'entries' and record_key is not null").select(F.lower(F.trim("record_key")).alias("k")).distinct()
    e = table(spark, d, "entries").select("entry_id", "contest_id").distinct()
    return e.join(gone, F.lower(F.trim(F.col("entry_id"))) == F.col("k"), "left_anti")


@query("""
SELECT wsdc_id, role, series_id, division, CASE WHEN lower(trim(event_id)) IN (SELECT lower(event_id) FROM dance_events) THEN lower(trim(event_id)) END AS event_id
FROM registry_placements
""")
def null_dangling_events(spark, d):
    """Registry rows with event ids that name no event set to null."""
    r = table(spark, d, "registry_placements").withColumn("event_id", F.lower(F.trim("event_id")))
    known = table(spark, d, "dance_events").select(F.lower("event_id").alias("k")).distinct()
    return r.join(known, F.col("event_id") == F.col("k"), "left").select("wsdc_id", "role", "series_id", "division", F.col("k").alias("event_id"))


@query(f"""
SELECT v.event_id, CASE WHEN r.k IS NOT NULL THEN 'removed' WHEN c.scope_id IS NOT NULL THEN c.best ELSE 'unknown' END AS scope_status
FROM {EVENTS} v
LEFT JOIN (SELECT DISTINCT lower(trim(record_key)) AS k FROM removals WHERE table_name = 'dance_events') r ON r.k = lower(v.event_id)
LEFT JOIN (SELECT scope_id, min(scope_status) AS best FROM coverage WHERE scope_kind = 'source_event' AND scope_status IS NOT NULL GROUP BY scope_id) c ON c.scope_id = v.event_id
""")
def annotate_scope(spark, d):
    """Events with the state of their scope: removed, the least covered state, or unknown."""
    v = _once(spark, d, "dance_events", "event_id")
    gone = table(spark, d, "removals").filter("table_name = 'dance_events'").select(F.lower(F.trim("record_key")).alias("k")).distinct()
    best = table(spark, d, "coverage").filter("scope_kind = 'source_event' and scope_status is not null").groupBy("scope_id").agg(F.min("scope_status").alias("best"))
    j = v.join(gone, F.lower("event_id") == F.col("k"), "left").join(best, F.col("event_id") == F.col("scope_id"), "left")
    return j.select("event_id", F.when(F.col("k").isNotNull(), "removed").otherwise(F.coalesce("best", F.lit("unknown"))).alias("scope_status"))


@query(f"SELECT wsdc_id, upper(substr(last_name, 1, 1)) AS initial FROM {DANCERS} WHERE merged_into_wsdc_id IS NULL AND last_name <> ''")
def pool_dancers(spark, d):
    """Dancers that may be linked to: not merged, with a surname initial."""
    w = _once(spark, d, "dancers", "wsdc_id")
    return w.filter("merged_into_wsdc_id is null and last_name <> ''").select("wsdc_id", F.upper(F.substring("last_name", 1, 1)).alias("initial"))


@query(f"""
SELECT DISTINCT p.placement_id, r.wsdc_id, r.role, r.points
FROM {PLACEMENTS} p JOIN {CONTESTS} c USING (contest_id)
JOIN registry_placements r ON r.event_id = p.event_id AND r.division = c.division AND r.dance_style = c.dance_style
WHERE r.result IN (CAST(p.place AS VARCHAR), 'F') AND r.wsdc_id IN (p.leader_wsdc_id, p.follower_wsdc_id)
""")
def join_registry_confirmation(spark, d):
    """Placements that a registry row confirms; the two people of a placement are unpivoted, so that the membership is an equi join."""
    p = _once(spark, d, "placements", "placement_id").select("placement_id", "contest_id", "event_id", "place", F.explode(F.array_distinct(F.array("leader_wsdc_id", "follower_wsdc_id"))).alias("wsdc_id"))
    c = _once(spark, d, "contests", "contest_id").select("contest_id", "division", "dance_style")
    r = table(spark, d, "registry_placements").select("event_id", "division", "dance_style", "wsdc_id", "role", "points", "result")
    j = p.filter("wsdc_id is not null").join(c, "contest_id").join(r, ["event_id", "division", "dance_style", "wsdc_id"])
    return j.filter((F.col("result") == F.col("place").cast("string")) | (F.col("result") == "F")).select("placement_id", "wsdc_id", "role", "points").distinct()


@query("""
WITH a AS (SELECT release_no, lower(trim(record_key)) AS record_key, lower(trim(status)) AS status, lower(trim(method)) AS method, wsdc_id FROM (
 SELECT *, row_number() OVER (PARTITION BY release_no, lower(trim(record_key)) ORDER BY asserted_at DESC NULLS LAST, run_id DESC NULLS LAST) AS _n FROM link_snapshots
 WHERE (release_no, delivery_no) IN (SELECT release_no, max(delivery_no) FROM link_snapshots GROUP BY 1)) WHERE _n = 1),
r AS (SELECT before, release_no FROM (SELECT release_no, lag(release_no) OVER (ORDER BY release_no) AS before FROM (SELECT DISTINCT release_no FROM link_snapshots WHERE release_no IS NOT NULL)) WHERE before IS NOT NULL),
n AS (SELECT a.* FROM a JOIN r USING (release_no)), o AS (SELECT r.release_no, a.record_key, a.status, a.method, a.wsdc_id FROM a JOIN r ON a.release_no = r.before),
j AS (SELECT concat_ws('|', coalesce(n.release_no, o.release_no), coalesce(n.record_key, o.record_key)) AS record_key, n.release_no AS nk, o.release_no AS ok, n.status AS ns, o.status AS os, n.method AS nm, o.method AS om, n.wsdc_id AS nw, o.wsdc_id AS ow FROM n FULL OUTER JOIN o ON n.release_no = o.release_no AND n.record_key IS NOT DISTINCT FROM o.record_key)
SELECT record_key, 'added' AS change_type, '' AS field_name, CAST(NULL AS VARCHAR) AS old_value, CAST(NULL AS VARCHAR) AS new_value FROM j WHERE ok IS NULL
UNION ALL SELECT record_key, 'removed', '', NULL, NULL FROM j WHERE nk IS NULL
UNION ALL SELECT record_key, 'changed', 'status', os, ns FROM j WHERE nk IS NOT NULL AND ok IS NOT NULL AND os IS DISTINCT FROM ns
UNION ALL SELECT record_key, 'changed', 'method', om, nm FROM j WHERE nk IS NOT NULL AND ok IS NOT NULL AND om IS DISTINCT FROM nm
UNION ALL SELECT record_key, 'changed', 'wsdc_id', CAST(ow AS VARCHAR), CAST(nw AS VARCHAR) FROM j WHERE nk IS NOT NULL AND ok IS NOT NULL AND ow IS DISTINCT FROM nw
""")
def diff_full_outer_all(spark, d):
    """Field-level changes of every release against the one before; record_key is release and key."""
    f = table(spark, d, "link_snapshots")
    f = f.join(f.groupBy("release_no").agg(F.max("delivery_no").alias("delivery_no")), ["release_no", "delivery_no"], "left_semi")
    a = R.latest(f.withColumn("record_key", F.lower(F.trim("record_key"))), ["release_no", "record_key"], [F.col("asserted_at"), F.col("run_id")]).select("release_no", "record_key", F.lower(F.trim("status")).alias("status"), F.lower(F.trim("method")).alias("method"), "wsdc_id")
    r = table(spark, d, "link_snapshots").select("release_no").distinct()
    steps = r.join(r.select(F.col("release_no").alias("before")), F.col("before") < F.col("release_no")).groupBy("release_no").agg(F.max("before").alias("before"))
    old = a.withColumnRenamed("release_no", "before").join(steps, "before").drop("before")
    return R.diff_rows(a.join(steps, "release_no").drop("before"), old, ["release_no", "record_key"], ["status", "method", "wsdc_id"])


@query("""
SELECT 'entries.contest_id' AS reference, count(*) AS n_missing FROM entries e WHERE contest_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM contests c WHERE c.contest_id = e.contest_id)
UNION ALL SELECT 'placements.leader_entry_id', count(*) FROM placements p WHERE leader_entry_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM entries e WHERE e.entry_id = p.leader_entry_id)
UNION ALL SELECT 'placements.follower_entry_id', count(*) FROM placements p WHERE follower_entry_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM entries e WHERE e.entry_id = p.follower_entry_id)
UNION ALL SELECT 'registry_placements.wsdc_id', count(*) FROM registry_placements r WHERE wsdc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dancers w WHERE w.wsdc_id = r.wsdc_id)
UNION ALL SELECT 'registry_placements.event_id', count(*) FROM registry_placements r WHERE event_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dance_events v WHERE v.event_id = r.event_id)
""")
def dangling_references(spark, d):
    """How many rows refer to no parent, per reference."""
    t = {n: table(spark, d, n) for n in ("entries", "contests", "placements", "registry_placements", "dancers", "dance_events")}
    refs = [("entries", "contest_id", "contests", "contest_id"), ("placements", "leader_entry_id", "entries", "entry_id"), ("placements", "follower_entry_id", "entries", "entry_id"), ("registry_placements", "wsdc_id", "dancers", "wsdc_id"), ("registry_placements", "event_id", "dance_events", "event_id")]
    return R.dangling_counts([(f"{c}.{col}", t[c], col, t[p], k) for c, col, p, k in refs])


@query("""
SELECT DISTINCT r.wsdc_id FROM registry_placements r WHERE r.wsdc_id IS NOT NULL AND r.wsdc_id NOT IN (SELECT wsdc_id FROM dancers WHERE wsdc_id IS NOT NULL)
""")
def anti_missing_dancers(spark, d):
    """Registry ids without a dancer; nulls are left out on both sides."""
    return R.missing_parents(table(spark, d, "registry_placements"), "wsdc_id", table(spark, d, "dancers"), "wsdc_id").select("wsdc_id").distinct()


@query(f"""
SELECT DISTINCT a.event_id AS event_a, b.event_id AS event_b FROM {EVENTS} a JOIN {EVENTS} b ON a.city = b.city AND a.event_id < b.event_id
WHERE coalesce(a.start_date, a.end_date) <= coalesce(b.end_date, b.start_date) + 1 AND coalesce(b.start_date, b.end_date) <= coalesce(a.end_date, a.start_date) + 1
""")
def join_overlapping_events(spark, d):
    """Events of one city whose dates overlap or touch within a day."""
    v = _once(spark, d, "dance_events", "event_id").select("city", "event_id", "start_date", "end_date")
    a, b = v.select("city", F.col("event_id").alias("event_a"), F.col("start_date").alias("a0"), F.col("end_date").alias("a1")), v.select("city", F.col("event_id").alias("event_b"), F.col("start_date").alias("b0"), F.col("end_date").alias("b1"))
    return R.overlap_join(a, b, ["city"], ("a0", "a1", "b0", "b1"), 1).filter("event_a < event_b").select("event_a", "event_b").distinct()


@query(f"""
WITH n AS (SELECT series_id, event_month, count(DISTINCT event_id) AS n, min(event_id) AS e FROM dance_events GROUP BY 1, 2)
SELECT DISTINCT r.series_id, strftime(r.event_month, '%Y-%m') AS event_month, CASE WHEN n.n = 1 THEN n.e END AS event_id, coalesce(n.n, 0) AS n_candidates
FROM registry_placements r LEFT JOIN n ON n.series_id = r.series_id AND n.event_month = strftime(r.event_month, '%Y-%m')
""")
def unique_event_match(spark, d):
    """Registry occurrences with the one event of their series and month."""
    r = table(spark, d, "registry_placements").select("series_id", F.date_format("event_month", "yyyy-MM").alias("event_month")).distinct()
    rows = r.withColumn("k", F.concat_ws("|", F.coalesce("series_id", F.lit("-")), F.coalesce("event_month", F.lit("-"))))
    hit = R.unique_match(rows, table(spark, d, "dance_events").select("series_id", "event_month", "event_id"), ["series_id", "event_month"], "k", "event_id")
    return rows.join(hit, "k").select("series_id", "event_month", "event_id", "n_candidates")


@query(f"""
WITH first AS (SELECT series_id, event_month, min(event_id) AS event_id FROM dance_events GROUP BY 1, 2)
SELECT r.wsdc_id, r.series_id, r.division, r.role, r.result, coalesce(a.event_id, b.event_id) AS event_id
FROM registry_placements r
LEFT JOIN first a ON a.series_id = r.series_id AND a.event_month = strftime(r.event_month, '%Y-%m')
LEFT JOIN first b ON b.series_id = r.series_id AND b.event_month = strftime(r.event_month + INTERVAL 1 MONTH, '%Y-%m')
""")
def match_month_or_next(spark, d):
    """Registry rows with their series' event in the month, or else in the month after it."""
    first = table(spark, d, "dance_events").groupBy("series_id", F.col("event_month").alias("m")).agg(F.min("event_id").alias("event_id"))
    r = table(spark, d, "registry_placements").select("wsdc_id", "series_id", "division", "role", "result", F.date_format("event_month", "yyyy-MM").alias("m"), F.date_format(F.add_months("event_month", 1), "yyyy-MM").alias("m2"))
    j = r.join(first.withColumnRenamed("event_id", "a"), ["series_id", "m"], "left").join(first.select("series_id", F.col("m").alias("m2"), F.col("event_id").alias("b")), ["series_id", "m2"], "left")
    return j.select("wsdc_id", "series_id", "division", "role", "result", F.coalesce("a", "b").alias("event_id"))


@query("""
WITH rules AS (SELECT division AS k, CAST(NULL AS DATE) AS lo, CAST(NULL AS DATE) AS hi, 'open' AS rule FROM (SELECT DISTINCT division FROM registry_placements)
 UNION ALL SELECT 'novice', DATE '2015-01-01', DATE '2019-12-31', 'novice-a' UNION ALL SELECT 'novice', DATE '2018-01-01', NULL, 'novice-b' UNION ALL SELECT 'allstar', NULL, DATE '2014-12-31', 'allstar-old'),
r AS (SELECT DISTINCT division, event_month FROM registry_placements),
h AS (SELECT r.*, rules.rule, row_number() OVER (PARTITION BY r.division, r.event_month ORDER BY (lo IS NOT NULL) DESC, lo DESC NULLS LAST, rule DESC) AS n
 FROM r JOIN rules ON rules.k = r.division AND (lo IS NULL OR r.event_month >= lo) AND (hi IS NULL OR r.event_month <= hi))
SELECT division, event_month, rule FROM h WHERE n = 1
""")
def lookup_dated_rule(spark, d):
    """As-of lookup: of the rules whose range holds a month, the latest-starting one beats the open one."""
    r = table(spark, d, "registry_placements").select("division", "event_month").distinct().withColumn("id", F.concat_ws("|", "division", F.col("event_month").cast("string")))
    dated = spark.createDataFrame([("novice", "2015-01-01", "2019-12-31", "novice-a"), ("novice", "2018-01-01", None, "novice-b"), ("allstar", None, "2014-12-31", "allstar-old")], "division string, lo string, hi string, rule string").select("division", F.col("lo").cast("date").alias("lo"), F.col("hi").cast("date").alias("hi"), "rule")
    rules = r.select("division").distinct().select("division", F.lit(None).cast("date").alias("lo"), F.lit(None).cast("date").alias("hi"), F.lit("open").alias("rule")).unionByName(dated)
    return R.range_lookup(r, rules, "division", "event_month", ("lo", "hi"), "rule", "id").select("division", "event_month", "rule")


@query(f"""
SELECT p.placement_id, v.name AS event_name, l.name_raw AS leader, f.name_raw AS follower, c.name_raw AS couple
FROM {PLACEMENTS} p JOIN {EVENTS} v USING (event_id)
LEFT JOIN {ENTRIES} l ON l.entry_id = p.leader_entry_id LEFT JOIN {ENTRIES} f ON f.entry_id = p.follower_entry_id LEFT JOIN {ENTRIES} c ON c.entry_id = p.couple_entry_id
""")
def star_placements(spark, d):
    """The consumer's star join: a placement with its event and three times its entries."""
    e = _once(spark, d, "entries", "entry_id").select("entry_id", "name_raw")
    p = _once(spark, d, "placements", "placement_id").join(_once(spark, d, "dance_events", "event_id").select("event_id", F.col("name").alias("event_name")), "event_id")
    for role in ("leader", "follower", "couple"):
        p = p.join(e.select(F.col("entry_id").alias(f"{role}_entry_id"), F.col("name_raw").alias(role)), f"{role}_entry_id", "left")
    return p.select("placement_id", "event_name", "leader", "follower", "couple")


@query(f"""
WITH registered AS (SELECT event_id, lower(name) AS n FROM {EVENTS} WHERE wsdc_status = 'registry'), uniq AS (SELECT n, min(event_id) AS e FROM registered GROUP BY n HAVING count(*) = 1)
SELECT v.event_id, coalesce(r.event_id, u.e, 'new-' || v.event_id) AS resolved
FROM {EVENTS} v LEFT JOIN registered r ON r.event_id = v.event_id LEFT JOIN uniq u ON u.n = lower(v.name)
""")
def match_override_first(spark, d):
    """Cascaded match: the reviewed id, else the only event of the name, else a placeholder."""
    v = _once(spark, d, "dance_events", "event_id")
    reg = v.filter("wsdc_status = 'registry'").select(F.col("event_id").alias("r"), F.lower("name").alias("n"))
    one = reg.groupBy("n").agg(F.min("r").alias("u"), F.count("*").alias("c")).filter("c = 1").select("n", "u")
    j = v.join(reg.select("r"), F.col("event_id") == F.col("r"), "left").join(one, F.lower("name") == F.col("n"), "left")
    return j.select("event_id", F.coalesce("r", "u", F.concat(F.lit("new-"), "event_id")).alias("resolved"))


@query(f"""
SELECT event_id, source FROM (SELECT event_id, unnest(sources) AS source FROM {EVENTS}) GROUP BY 1, 2
""")
def explode_listing_keys(spark, d):
    """Each event's listing sources, one row each."""
    return table(spark, d, "dance_events").select("event_id", F.explode("sources").alias("source")).distinct()


@query(f"""
SELECT p.placement_id, CASE WHEN l.wsdc_id IS NULL THEN NULL ELSE p.leader_wsdc_id END AS leader_wsdc_id, CASE WHEN f.wsdc_id IS NULL THEN NULL ELSE p.follower_wsdc_id END AS follower_wsdc_id
FROM {PLACEMENTS} p LEFT JOIN (SELECT DISTINCT wsdc_id FROM dancers) l ON l.wsdc_id = p.leader_wsdc_id LEFT JOIN (SELECT DISTINCT wsdc_id FROM dancers) f ON f.wsdc_id = p.follower_wsdc_id
""")
def close_absent_dancers(spark, d):
    """Identity columns that point at absent dancers set to null."""
    p = _once(spark, d, "placements", "placement_id").select("placement_id", "leader_wsdc_id", "follower_wsdc_id")
    known = table(spark, d, "dancers").select("wsdc_id").distinct()
    for role in ("leader", "follower"):
        p = p.join(known.withColumnRenamed("wsdc_id", f"_{role}"), F.col(f"{role}_wsdc_id") == F.col(f"_{role}"), "left").withColumn(f"{role}_wsdc_id", F.col(f"_{role}")).drop(f"_{role}")
    return p


@query("""
SELECT a.o_orderkey AS order_id, count(*) AS n_lines, sum(l_quantity) AS quantity FROM orders a JOIN lineitem l ON a.o_orderkey = l.l_orderkey
WHERE a.o_orderstatus = 'F' AND l.l_returnflag IN ('R', 'A') GROUP BY 1
""")
def join_orders_lines(spark, d):
    """Equi join with filters pushed to both scans and partial sums before the shuffle."""
    o = table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    li = table(spark, d, "lineitem").filter(F.col("l_returnflag").isin("R", "A")).select("l_orderkey", "l_quantity")
    return o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).groupBy(F.col("o_orderkey").alias("order_id")).agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))


queries, oracle_sql = query.queries, query.oracle_sql
