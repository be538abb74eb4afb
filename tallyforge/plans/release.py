"""Release building, findings, suppression and admission."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.functions import text
from tallyforge.operators.release import Table, build_release, check_tables, close_references, replace_findings
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, DANCERS, ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.plans.textual import _PLAIN
from tallyforge.session import bounded_rows, cut, scratch, table

query = Queries()


def _tables(spark, d):
    t = {n: _once(spark, d, n, k) for n, k in (("entries", "entry_id"), ("contests", "contest_id"), ("dance_events", "event_id"), ("placements", "placement_id"))}
    return {
        "dance_events": Table(t["dance_events"].select("event_id", "name", "city"), ["event_id"], {}, ["name", "city"]),
        "contests": Table(t["contests"].select("contest_id", "event_id", "division"), ["contest_id"], {"event_id": ("dance_events", "event_id")}, ["division"]),
        "entries": Table(t["entries"].select("entry_id", "contest_id", "wsdc_id"), ["entry_id"], {"contest_id": ("contests", "contest_id")}, ["wsdc_id"]),
        "placements": Table(t["placements"].select("placement_id", "leader_entry_id", "follower_entry_id", "place"), ["placement_id"], {"leader_entry_id": ("entries", "entry_id"), "follower_entry_id": ("entries", "entry_id")}, ["place"]),
    }


@query(f"""
SELECT 'entries' AS table_name, 'reference contest_id' AS check_name, count(*) AS n_failed FROM {ENTRIES} e WHERE contest_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM contests c WHERE c.contest_id = e.contest_id)
UNION ALL SELECT 'contests', 'reference event_id', count(*) FROM {CONTESTS} c WHERE event_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dance_events v WHERE v.event_id = c.event_id)
UNION ALL SELECT 'placements', 'reference leader_entry_id', count(*) FROM {PLACEMENTS} p WHERE leader_entry_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM entries e WHERE e.entry_id = p.leader_entry_id)
UNION ALL SELECT 'placements', 'reference follower_entry_id', count(*) FROM {PLACEMENTS} p WHERE follower_entry_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM entries e WHERE e.entry_id = p.follower_entry_id)
UNION ALL SELECT t, 'key', CAST(0 AS BIGINT) FROM (VALUES ('entries'), ('contests'), ('placements'), ('dance_events')) AS x(t)
""")
def release_checks(spark, d):
    """The checks of a release and how many rows fail each."""
    return check_tables(_tables(spark, d))


@query(f"""
WITH e AS (SELECT entry_id, wsdc_id FROM {ENTRIES}), c AS (SELECT contest_id, division FROM {CONTESTS}), v AS (SELECT event_id, name, city FROM {EVENTS}), p AS (SELECT placement_id, place FROM {PLACEMENTS})
SELECT 'entries' AS table_name, (SELECT count(*) FROM e) AS n_rows, (SELECT count(*) FROM e WHERE wsdc_id IS NULL) AS n_changes
UNION ALL SELECT 'contests', (SELECT count(*) FROM c), (SELECT count(*) FROM c WHERE division = 'unknown')
UNION ALL SELECT 'dance_events', (SELECT count(*) FROM v), (SELECT count(*) FROM v WHERE city IS NULL)
UNION ALL SELECT 'placements', (SELECT count(*) FROM p), CAST(0 AS BIGINT)
""")
def release_build(spark, d):
    """A whole release: references closed, checked, written sorted, and logged against a release before."""
    t = close_references(_tables(spark, d))
    before = {
        "entries": t["entries"].df.withColumn("wsdc_id", F.coalesce("wsdc_id", F.lit(-1))), "contests": t["contests"].df.withColumn("division", F.when(F.col("division") != "unknown", F.col("division"))),
        "dance_events": t["dance_events"].df.withColumn("city", F.coalesce("city", F.lit("?"))), "placements": t["placements"].df,
    }
    return build_release(t, scratch(spark, "release"), before).select("table_name", "n_rows", "n_changes")


_SPANS = """
WITH r AS (SELECT release_no, row_number() OVER (ORDER BY release_no) AS i FROM (SELECT DISTINCT release_no FROM link_snapshots WHERE release_no IS NOT NULL)),
k AS (SELECT DISTINCT lower(trim(record_key)) AS record_key, i FROM link_snapshots JOIN r USING (release_no) WHERE lower(trim(status)) = 'ambiguous' AND record_key IS NOT NULL),
g AS (SELECT record_key, i, i - row_number() OVER (PARTITION BY record_key ORDER BY i) AS island FROM k), s AS (SELECT record_key, min(i) AS a, max(i) AS b FROM g GROUP BY record_key, island)
"""


@query(_SPANS + "SELECT record_key, o.release_no AS opened_at, c.release_no AS closed_at FROM s JOIN r o ON o.i = a LEFT JOIN r c ON c.i = b + 1")
def findings_spans(spark, d):
    """When each finding opened and closed, over the runs of all releases; one that comes back opens again.

    Numbering the releases needs all of them in one place, but they are few: one row a release.
    """
    s = table(spark, d, "link_snapshots").filter("release_no is not null")
    runs = s.select("release_no").distinct().withColumn("i", F.row_number().over(Window.orderBy("release_no")))
    k = s.filter((F.lower(F.trim("status")) == "ambiguous") & F.col("record_key").isNotNull()).select("release_no", F.lower(F.trim("record_key")).alias("record_key")).distinct().join(F.broadcast(runs), "release_no")
    island = F.col("i") - F.row_number().over(Window.partitionBy("record_key").orderBy("i"))
    spans = k.withColumn("island", island).groupBy("record_key", "island").agg(F.min("release_no").alias("opened_at"), F.max("i").alias("last"))
    after = runs.select((F.col("i") - 1).alias("last"), F.col("release_no").alias("closed_at"))
    return spans.join(F.broadcast(after), "last", "left").select("record_key", "opened_at", "closed_at")


@query(_SPANS + ", l AS (SELECT record_key, max(a) AS a, max(b) AS b FROM s GROUP BY 1) SELECT record_key, o.release_no AS opened_at, c.release_no AS closed_at FROM l JOIN r o ON o.i = a LEFT JOIN r c ON c.i = b + 1")
def findings_open_close(spark, d):
    """The stored findings after the run of every release: which are open, since when, and when the others closed.

    Releases are few; each run's state is written, so that plans do not grow with them.
    """
    k = table(spark, d, "link_snapshots").filter("record_key is not null and release_no is not null")
    found = k.filter(F.lower(F.trim("status")) == "ambiguous").select("release_no", F.lower(F.trim("record_key")).alias("record_key"))
    stored = spark.createDataFrame([], "record_key string, opened_at int, closed_at int")
    for (n,) in sorted(tuple(r) for r in bounded_rows(k.select("release_no").distinct(), 10_000, "releases")):
        stored = cut(replace_findings(stored, found.filter(F.col("release_no") == n), ["record_key"], F.lit(n)), "findings")
    return stored


_WORDS = "trim(regexp_replace(" + _PLAIN + ", '[^a-z0-9]+', ' ', 'g'))"


@query(f"""
WITH s AS (SELECT DISTINCT {_WORDS.format(c="first_name || ' ' || last_name")} AS full_name, lower(substr({_WORDS.format(c='first_name')}, 1, 1)) || ' ' || {_WORDS.format(c='last_name')} AS short_name FROM {DANCERS} WHERE is_pro AND first_name IS NOT NULL AND last_name IS NOT NULL),
n AS (SELECT DISTINCT name_raw, {_WORDS.format(c='name_raw')} AS w FROM judges WHERE name_raw IS NOT NULL AND NOT anonymous)
SELECT name_raw, w IN (SELECT full_name FROM s) AS by_name, w IN (SELECT short_name FROM s) AS by_initial FROM n
""")
def suppression_matches(spark, d):
    """Printed judges that a list of people covers, by whole name or by initial and surname: two key joins, no pattern scan."""
    words = lambda c: F.trim(F.regexp_replace(text.plain(c), "[^a-z0-9]+", " "))
    w = _once(spark, d, "dancers", "wsdc_id").filter("is_pro and first_name is not null and last_name is not null")
    full = w.select(words(F.concat("first_name", F.lit(" "), "last_name")).alias("k")).distinct().withColumn("f", F.lit(True))
    short = w.select(F.concat_ws(" ", F.substring(words(F.col("first_name")), 1, 1), words(F.col("last_name"))).alias("k")).distinct().withColumn("s", F.lit(True))
    n = table(spark, d, "judges").filter("name_raw is not null and not anonymous").select("name_raw", words(F.col("name_raw")).alias("k")).distinct()
    return n.join(full, "k", "left").join(short, "k", "left").select("name_raw", F.coalesce("f", F.lit(False)).alias("by_name"), F.coalesce("s", F.lit(False)).alias("by_initial"))


@query(f"""
WITH g AS (SELECT lower(name) AS name, "year" AS y, min(start_date) AS a, max(end_date) AS b FROM {EVENTS} WHERE start_date IS NOT NULL AND end_date IS NOT NULL GROUP BY 1, 2)
SELECT g.name, g.y, CASE WHEN EXISTS (SELECT 1 FROM {EVENTS} v WHERE lower(v.name) = g.name AND v."year" IS NOT DISTINCT FROM g.y AND v.start_date = g.a AND v.end_date = g.b) THEN g.a END AS starts FROM g
""")
def widest_spans(spark, d):
    """The span of each name and year that holds all others, if one does."""
    v = _once(spark, d, "dance_events", "event_id").filter("start_date is not null and end_date is not null").select(F.lower("name").alias("name"), F.col("year").alias("y"), "start_date", "end_date")
    # The earliest start with its latest end, and the latest end of all: they agree if one span holds every other.
    first = F.min(F.struct("start_date", (-F.unix_date("end_date")).alias("late"))).alias("m")
    g = v.groupBy("name", "y").agg(first, F.max("end_date").alias("b"))
    return g.select("name", "y", F.when(-F.col("m.late") == F.unix_date("b"), F.col("m.start_date")).alias("starts"))


@query("""
SELECT record_key, release_no, list_filter_guards AS guards FROM (
 SELECT record_key, release_no, [g FOR g IN [CASE WHEN confidence IS NULL THEN 'no_confidence' END, CASE WHEN confidence < 0.5 THEN 'low_confidence' END, CASE WHEN wsdc_id IS NULL THEN 'no_subject' END, CASE WHEN len(constraints_applied) = 0 THEN 'unconstrained' END] IF g IS NOT NULL] AS list_filter_guards
 FROM (SELECT DISTINCT record_key, release_no, confidence, wsdc_id, constraints_applied FROM link_snapshots))
""")
def contract_guards(spark, d):
    """Which guards each link fails, as a list of names."""
    k = table(spark, d, "link_snapshots").select("record_key", "release_no", "confidence", "wsdc_id", "constraints_applied").distinct()
    guards = [(F.col("confidence").isNull(), "no_confidence"), (F.col("confidence") < 0.5, "low_confidence"), (F.col("wsdc_id").isNull(), "no_subject"), (F.size("constraints_applied") == 0, "unconstrained")]
    return k.select("record_key", "release_no", F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in guards])).alias("guards"))


@query("""
WITH g AS (SELECT release_no, delivery_no, count(DISTINCT lower(trim(record_key))) AS n FROM link_snapshots GROUP BY 1, 2), p AS (SELECT *, max(delivery_no) OVER (PARTITION BY release_no) AS last FROM g)
SELECT release_no, delivery_no, CASE WHEN delivery_no < last THEN 'superseded' WHEN n * 10 < 9 * (SELECT max(n) FROM g) THEN 'shadow' ELSE 'accepted' END AS state FROM p
""")
def admit_deliveries(spark, d):
    """Deliveries accepted, held as shadow where they are far smaller than the largest, or superseded."""
    g = table(spark, d, "link_snapshots").groupBy("release_no", "delivery_no").agg(F.countDistinct(F.lower(F.trim("record_key"))).alias("n"))
    last = g.groupBy("release_no").agg(F.max("delivery_no").alias("last"))
    j = g.join(last, "release_no").join(g.agg(F.max("n").alias("most")))
    return j.select("release_no", "delivery_no", F.when(F.col("delivery_no") < F.col("last"), "superseded").when(F.col("n") * 10 < 9 * F.col("most"), "shadow").otherwise("accepted").alias("state"))


@query(f"""
SELECT e.entry_id, r.wsdc_id IS NOT NULL AS supported FROM (SELECT * FROM {ENTRIES} WHERE wsdc_id IS NOT NULL) e LEFT JOIN (SELECT DISTINCT wsdc_id, event_id FROM registry_placements WHERE event_id IS NOT NULL) r ON r.wsdc_id = e.wsdc_id AND r.event_id = e.event_id
""")
def registry_support(spark, d):
    """Whether the registry knows an entry's printed dancer at its event."""
    e = _once(spark, d, "entries", "entry_id").filter("wsdc_id is not null").select("entry_id", "wsdc_id", "event_id")
    r = table(spark, d, "registry_placements").filter("event_id is not null").select("wsdc_id", "event_id").distinct().withColumn("hit", F.lit(True))
    return e.join(r, ["wsdc_id", "event_id"], "left").select("entry_id", F.coalesce("hit", F.lit(False)).alias("supported"))


@query(f"""
SELECT p.placement_id, CASE WHEN p.leader_wsdc_id = e.wsdc_id THEN p.leader_wsdc_id END AS leader_wsdc_id FROM {PLACEMENTS} p LEFT JOIN {ENTRIES} e ON e.entry_id = p.leader_entry_id
""")
def restrict_to_baseline(spark, d):
    """A default id stays only where the baseline has the same."""
    e = _once(spark, d, "entries", "entry_id").select(F.col("entry_id").alias("leader_entry_id"), F.col("wsdc_id").alias("base"))
    p = _once(spark, d, "placements", "placement_id").select("placement_id", "leader_entry_id", "leader_wsdc_id").join(e, "leader_entry_id", "left")
    return p.select("placement_id", F.when(F.col("leader_wsdc_id") == F.col("base"), F.col("leader_wsdc_id")).alias("leader_wsdc_id"))


@query("""
SELECT event_id, sum(points) AS points, count(*) AS n FROM registry_placements WHERE points > 0 AND event_id IS NOT NULL GROUP BY 1
""")
def event_points(spark, d):
    """Registry points per event."""
    return table(spark, d, "registry_placements").filter("points > 0 and event_id is not null").groupBy("event_id").agg(F.sum("points").alias("points"), F.count("*").alias("n"))


@query()
def canonical_bodies(spark, d):
    """A digest of every readable line that ignores the order of keys and blanks: equal content, equal digest."""
    from tallyforge.operators.drift import readable

    def run(batches):
        import hashlib
        import json

        canonical = lambda body: json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False)

        for pdf in batches:
            body = [readable(b) for b in pdf["body"]]
            pdf["digest"] = [None if b is None else hashlib.sha256(canonical(b).encode("utf-8", "surrogatepass")).hexdigest() for b in body]
            yield pdf[["file_name", "line_no", "digest"]]

    return table(spark, d, "raw_receipts").select("file_name", "line_no", "body").mapInPandas(run, "file_name string, line_no int, digest string")


@query("""
WITH s AS (SELECT family, file_name, min(recorded_at) AS t0, count(*) AS n_lines FROM raw_receipts GROUP BY 1, 2), q AS (SELECT file_name, sum(n_lines) OVER (PARTITION BY family ORDER BY t0, file_name ROWS UNBOUNDED PRECEDING) AS total FROM s)
SELECT file_name, total <= 60 AS admitted FROM q
""")
def intake_backpressure(spark, d):
    """Files of each family that fit a budget of lines, oldest first."""
    s = table(spark, d, "raw_receipts").groupBy("family", "file_name").agg(F.min("recorded_at").alias("t0"), F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("family").orderBy("t0", "file_name").rowsBetween(Window.unboundedPreceding, 0))
    return s.select("file_name", (total <= 60).alias("admitted"))


queries, oracle_sql = query.queries, query.oracle_sql
