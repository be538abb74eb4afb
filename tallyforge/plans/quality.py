"""Checks of a release, its closure to a consistent state, and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import relational as R
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, DANCERS, ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.session import table

query = Queries()

# Closed vocabularies of the published columns.
VOCABULARY = {
    ("contests", "division"): ["newcomer", "novice", "intermediate", "advanced", "allstar", "champion", "invitational", "open", "none", "unknown"],
    ("contests", "contest_type"): ["jack_and_jill", "strictly", "classic", "showcase", "pro_am", "rising_star", "other"],
    ("entries", "link_status"): ["confirmed", "probable", "possible", "ambiguous", "unmatched", "suppressed"],
    ("dance_events", "date_precision"): ["day", "month", "year", "unknown"],
}


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN ({_in(v)}) GROUP BY 3" for (t, c), v in VOCABULARY.items()))
def check_vocabulary(spark, d):
    """Values outside the closed vocabularies."""
    out = None
    for (t, c), allowed in VOCABULARY.items():
        bad = table(spark, d, t).filter(F.col(c).isNotNull() & ~F.col(c).isin(*allowed)).groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n"))
        bad = bad.select(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "value", "n")
        out = bad if out is None else out.unionByName(bad)
    return out


@query(f"""
SELECT event_id, CASE WHEN end_date < start_date THEN 'order' WHEN event_month IS NULL OR NOT regexp_matches(event_month, '^\\d{{4}}-\\d{{2}}$') THEN 'month' WHEN date_precision = 'day' AND start_date IS NULL THEN 'precision' WHEN start_date IS NOT NULL AND strftime(start_date, '%Y-%m') <> event_month THEN 'month_differs' ELSE 'ok' END AS reason FROM {EVENTS}
""")
def check_events(spark, d):
    """The first check an event fails."""
    v = _once(spark, d, "dance_events", "event_id")
    reason = (
        F.when(F.col("end_date") < F.col("start_date"), "order").when(F.col("event_month").isNull() | ~F.col("event_month").rlike(r"^\d{4}-\d{2}$"), "month")
        .when((F.col("date_precision") == "day") & F.col("start_date").isNull(), "precision").when(F.col("start_date").isNotNull() & (F.date_format("start_date", "yyyy-MM") != F.col("event_month")), "month_differs").otherwise("ok")
    )
    return v.select("event_id", reason.alias("reason"))


@query(f"""
SELECT round_id, count(*) AS n, max(place) AS last_place, count(DISTINCT place) AS n_places, (max(place) = count(*) AND count(DISTINCT place) = count(*) AND min(place) = 1) AS contiguous FROM {PLACEMENTS} GROUP BY 1
""")
def check_places(spark, d):
    """Whether the places of a round run from 1 without gap or tie."""
    p = _once(spark, d, "placements", "placement_id")
    return p.groupBy("round_id").agg(F.count("*").alias("n"), F.max("place").alias("last_place"), F.countDistinct("place").alias("n_places"), F.min("place").alias("_m")).select("round_id", "n", "last_place", "n_places", ((F.col("last_place") == F.col("n")) & (F.col("n_places") == F.col("n")) & (F.col("_m") == 1)).alias("contiguous"))


@query(f"""
SELECT contest_id, bib, count(DISTINCT wsdc_id) AS n_ids FROM {ENTRIES} WHERE bib IS NOT NULL AND wsdc_id IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT wsdc_id) > 1
""")
def check_bib_identities(spark, d):
    """Bibs of a contest that name several dancers."""
    e = _once(spark, d, "entries", "entry_id").filter("bib is not null and wsdc_id is not null")
    return e.groupBy("contest_id", "bib").agg(F.countDistinct("wsdc_id").alias("n_ids")).filter("n_ids > 1")


@query(f"""
WITH t AS (SELECT placement_id, marks_sorted, [CAST(x AS VARCHAR) FOR x IN list_sort(tally)] AS l FROM {PLACEMENTS})
SELECT placement_id, array_to_string(l, '') = marks_sorted AS agrees FROM t WHERE marks_sorted IS NOT NULL
""")
def check_marks(spark, d):
    """Whether the printed sorted marks are those of the tally."""
    p = _once(spark, d, "placements", "placement_id").filter("marks_sorted is not null")
    return p.select("placement_id", (F.array_join(F.transform(F.array_sort("tally"), lambda x: x.cast("string")), "") == F.col("marks_sorted")).alias("agrees"))


@query("""
SELECT 'entries' AS table_name, count(*) AS n_keys, coalesce(sum(n - 1), 0) AS n_extra FROM (SELECT entry_id, count(*) AS n FROM entries GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'contests', count(*), coalesce(sum(n - 1), 0) FROM (SELECT contest_id, count(*) AS n FROM contests GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'placements', count(*), coalesce(sum(n - 1), 0) FROM (SELECT placement_id, count(*) AS n FROM placements GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'dance_events', count(*), coalesce(sum(n - 1), 0) FROM (SELECT event_id, count(*) AS n FROM dance_events GROUP BY 1 HAVING count(*) > 1)
""")
def audit_duplicate_keys(spark, d):
    """Repeated primary keys per table."""
    out = None
    for t, k in (("entries", "entry_id"), ("contests", "contest_id"), ("placements", "placement_id"), ("dance_events", "event_id")):
        one = R.duplicate_keys(table(spark, d, t), [k]).agg(F.count("*").alias("n_keys"), F.coalesce(F.sum("n_extra"), F.lit(0)).alias("n_extra")).select(F.lit(t).alias("table_name"), "n_keys", "n_extra")
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""
WITH g AS (SELECT lower(trim(record_key)) AS k FROM removals WHERE table_name = 'entries' UNION SELECT lower(trim(entry_id)) FROM {ENTRIES} WHERE link_status = 'suppressed')
SELECT p.placement_id, CASE WHEN lower(p.leader_entry_id) IN (SELECT k FROM g WHERE k IS NOT NULL) THEN NULL ELSE p.leader_wsdc_id END AS leader_wsdc_id, CASE WHEN lower(p.leader_entry_id) IN (SELECT k FROM g WHERE k IS NOT NULL) THEN NULL ELSE p.registry_points_leader END AS registry_points_leader FROM {PLACEMENTS} p
""")
def withdraw_identities(spark, d):
    """Placements with the identity and points of a withdrawn entry set to null."""
    gone = table(spark, d, "removals").filter("table_name = 'entries'").select(F.lower(F.trim("record_key")).alias("k")).union(_once(spark, d, "entries", "entry_id").filter("link_status = 'suppressed'").select(F.lower(F.trim("entry_id")))).filter("k is not null").distinct()
    p = _once(spark, d, "placements", "placement_id").join(gone, F.lower("leader_entry_id") == F.col("k"), "left")
    keep = lambda c: F.when(F.col("k").isNull(), F.col(c)).alias(c)
    return p.select("placement_id", keep("leader_wsdc_id"), keep("registry_points_leader"))


@query(f"""
WITH bad AS (SELECT round_id FROM {PLACEMENTS} GROUP BY 1 HAVING NOT (max(place) = count(*) AND count(DISTINCT place) = count(*))), c AS (SELECT DISTINCT contest_id FROM {PLACEMENTS} WHERE round_id IN (SELECT round_id FROM bad))
SELECT contest_id, contest_id IN (SELECT contest_id FROM c) AS withheld FROM {CONTESTS}
""")
def withhold_invalid(spark, d):
    """Contests with a failing round are withheld as a whole."""
    p = _once(spark, d, "placements", "placement_id").select("contest_id", "round_id", "place")
    bad = p.groupBy("contest_id", "round_id").agg(F.max("place").alias("m"), F.count("*").alias("n"), F.countDistinct("place").alias("k")).filter("not (m = n and k = n)").select("contest_id").distinct().withColumn("withheld", F.lit(True))
    return _once(spark, d, "contests", "contest_id").join(bad, "contest_id", "left").select("contest_id", F.coalesce("withheld", F.lit(False)).alias("withheld"))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT wsdc_id AS w, event_id AS v FROM registry_placements WHERE wsdc_id IS NOT NULL AND event_id IS NOT NULL),
r(w) AS (SELECT min(w) FROM e UNION SELECT b.w FROM r JOIN e a ON a.w = r.w JOIN e b ON b.v = a.v)
SELECT w AS wsdc_id FROM r
""")
def closure_reach(spark, d):
    """Dancers reached from the first one over shared events, to a fixpoint."""
    r = table(spark, d, "registry_placements").filter("wsdc_id is not null and event_id is not null").select("wsdc_id", "event_id").distinct()
    # Both kinds of node are ids of one graph, so that no event's dancers are paired with each other.
    nodes = r.select(F.concat(F.lit("w"), F.col("wsdc_id").cast("string")).alias("a"), F.concat(F.lit("v"), "event_id").alias("b"))
    edges = nodes.union(nodes.select("b", "a"))
    seed = r.agg(F.min("wsdc_id").alias("m")).select(F.concat(F.lit("w"), F.col("m").cast("string")).alias("node")).filter("node is not null")
    return R.reach(seed, edges, "node", "a", "b").filter("node like 'w%'").select(F.substring("node", 2, 20).cast("int").alias("wsdc_id"))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT 'w' || wsdc_id AS a, 'v' || event_id AS b FROM registry_placements WHERE wsdc_id IS NOT NULL AND event_id IS NOT NULL),
l AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(n, c) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.n)
SELECT n AS node, min(c) AS component FROM r GROUP BY 1
""")
def connected_events(spark, d):
    """Connected components of dancers and events."""
    r = table(spark, d, "registry_placements").filter("wsdc_id is not null and event_id is not null")
    return R.components(r.select(F.concat(F.lit("w"), F.col("wsdc_id").cast("string")).alias("a"), F.concat(F.lit("v"), "event_id").alias("b")).distinct(), "a", "b")


@query(f"""
WITH p AS (SELECT lower(trim(reason)) AS r, count(*) AS n FROM removals WHERE reason IS NOT NULL GROUP BY 1), s AS (SELECT DISTINCT w.wsdc_id FROM {DANCERS} w JOIN (SELECT DISTINCT lower(trim(record_key)) AS k FROM removals WHERE reason = 'suppression') x ON x.k IN (SELECT lower(entry_id) FROM {ENTRIES} e WHERE e.wsdc_id = w.wsdc_id))
SELECT e.entry_id, CASE WHEN s.wsdc_id IS NOT NULL THEN 'suppressed' ELSE e.name_raw END AS name_raw FROM {ENTRIES} e LEFT JOIN s ON s.wsdc_id = e.wsdc_id
""".replace("WITH p AS (SELECT lower(trim(reason)) AS r, count(*) AS n FROM removals WHERE reason IS NOT NULL GROUP BY 1), s AS", "WITH s AS").replace(f"SELECT DISTINCT w.wsdc_id FROM {DANCERS} w JOIN (SELECT DISTINCT lower(trim(record_key)) AS k FROM removals WHERE reason = 'suppression') x ON x.k IN (SELECT lower(entry_id) FROM {ENTRIES} e WHERE e.wsdc_id = w.wsdc_id)", f"SELECT DISTINCT e.wsdc_id FROM {ENTRIES} e JOIN removals x ON lower(trim(x.record_key)) = lower(e.entry_id) WHERE x.reason = 'suppression' AND e.wsdc_id IS NOT NULL"))
def suppress_people(spark, d):
    """Names of everyone a suppressed record identifies, scrubbed in all their entries."""
    e = _once(spark, d, "entries", "entry_id")
    x = table(spark, d, "removals").filter("reason = 'suppression'").select(F.lower(F.trim("record_key")).alias("k")).distinct()
    people = e.filter("wsdc_id is not null").join(x, F.lower("entry_id") == F.col("k"), "left_semi").select("wsdc_id").distinct().withColumn("hit", F.lit(True))
    return e.join(people, "wsdc_id", "left").select("entry_id", F.when(F.col("hit"), "suppressed").otherwise(F.col("name_raw")).alias("name_raw"))


@query("""
WITH a AS (SELECT substr(event_id, 1, 4) AS y, count(DISTINCT entry_id) AS base FROM entries WHERE first_seen_at < TIMESTAMP '2024-07-01' GROUP BY 1), b AS (SELECT substr(event_id, 1, 4) AS y, count(DISTINCT entry_id) AS now FROM entries WHERE last_seen_at >= TIMESTAMP '2024-03-01' GROUP BY 1)
SELECT coalesce(a.y, b.y) AS y, coalesce(base, 0) AS baseline, coalesce(now, 0) AS candidate, coalesce(now, 0) < coalesce(base, 0) AS decreased FROM a FULL OUTER JOIN b ON a.y = b.y
""")
def release_gate(spark, d):
    """Measures of a candidate against its baseline; a decrease needs approval."""
    e = table(spark, d, "entries").withColumn("y", F.substring("event_id", 1, 4))
    ts = lambda t: F.lit(t).cast("timestamp_ntz")
    a = e.filter(F.col("first_seen_at") < ts("2024-07-01 00:00:00")).groupBy("y").agg(F.countDistinct("entry_id").alias("base"))
    b = e.filter(F.col("last_seen_at") >= ts("2024-03-01 00:00:00")).groupBy("y").agg(F.countDistinct("entry_id").alias("now"))
    j = a.join(b, "y", "full_outer").select("y", F.coalesce("base", F.lit(0)).alias("baseline"), F.coalesce("now", F.lit(0)).alias("candidate"))
    return j.withColumn("decreased", F.col("candidate") < F.col("baseline"))


@query(f"""
SELECT 'leader_letter' AS relation, count(*) AS n FROM {PLACEMENTS} WHERE leader_entry_id IS NOT NULL AND NOT regexp_matches(leader_entry_id, '/L-[^/]*$')
UNION ALL SELECT 'follower_letter', count(*) FROM {PLACEMENTS} WHERE follower_entry_id IS NOT NULL AND NOT regexp_matches(follower_entry_id, '/F-[^/]*$')
UNION ALL SELECT 'entry_contest', count(*) FROM {ENTRIES} WHERE NOT starts_with(entry_id, contest_id)
UNION ALL SELECT 'contest_event', count(*) FROM {CONTESTS} WHERE event_id IS DISTINCT FROM split_part(contest_id, '/', 1)
UNION ALL SELECT 'same_person_twice', count(*) FROM {PLACEMENTS} WHERE leader_wsdc_id = follower_wsdc_id
""")
def audit_relations(spark, d):
    """Labelled counts of rows whose parts contradict each other."""
    p, e, c = _once(spark, d, "placements", "placement_id"), _once(spark, d, "entries", "entry_id"), _once(spark, d, "contests", "contest_id")
    pc = p.agg(
        F.count_if(F.col("leader_entry_id").isNotNull() & ~F.col("leader_entry_id").rlike("/L-[^/]*$")).alias("leader_letter"),
        F.count_if(F.col("follower_entry_id").isNotNull() & ~F.col("follower_entry_id").rlike("/F-[^/]*$")).alias("follower_letter"),
        F.count_if(F.col("leader_wsdc_id") == F.col("follower_wsdc_id")).alias("same_person_twice"),
    ).unpivot([], ["leader_letter", "follower_letter", "same_person_twice"], "relation", "n")
    ec = e.agg(F.count_if(~F.col("entry_id").startswith(F.col("contest_id"))).alias("entry_contest")).unpivot([], ["entry_contest"], "relation", "n")
    cc = c.agg(F.count_if(~F.col("event_id").eqNullSafe(F.split_part("contest_id", F.lit("/"), F.lit(1)))).alias("contest_event")).unpivot([], ["contest_event"], "relation", "n")
    return pc.unionByName(ec).unionByName(cc)


@query(f"""
SELECT p.placement_id FROM {PLACEMENTS} p LEFT JOIN {ENTRIES} l ON l.entry_id = p.leader_entry_id LEFT JOIN {ENTRIES} f ON f.entry_id = p.follower_entry_id LEFT JOIN {ENTRIES} c ON c.entry_id = p.couple_entry_id
WHERE lower(trim(l.role)) NOT IN ('leader', 'l') OR lower(trim(f.role)) NOT IN ('follower', 'f') OR lower(trim(c.role)) IN ('leader', 'follower')
""")
def audit_roles(spark, d):
    """Placements whose entries have other roles."""
    e = _once(spark, d, "entries", "entry_id").select("entry_id", F.lower(F.trim("role")).alias("role"))
    p = _once(spark, d, "placements", "placement_id").select("placement_id", "leader_entry_id", "follower_entry_id", "couple_entry_id")
    for r in ("leader", "follower", "couple"):
        p = p.join(e.select(F.col("entry_id").alias(f"{r}_entry_id"), F.col("role").alias(r)), f"{r}_entry_id", "left")
    return p.filter(~F.col("leader").isin("leader", "l") | ~F.col("follower").isin("follower", "f") | F.col("couple").isin("leader", "follower")).select("placement_id")


@query("SELECT contest_id, name_raw FROM contests WHERE regexp_matches(name_raw, '(?i)jack|j&j') GROUP BY 1, 2")
def audit_headings(spark, d):
    """Contest headings that a pattern marks."""
    return table(spark, d, "contests").filter(F.col("name_raw").rlike("(?i)jack|j&j")).select("contest_id", "name_raw").distinct()


@query(f"""
SELECT DISTINCT l.record_key FROM link_snapshots l WHERE (l.subject_kind = 'entry' AND NOT EXISTS (SELECT 1 FROM entries e WHERE e.wsdc_id = l.wsdc_id)) OR (l.subject_kind = 'judge' AND NOT EXISTS (SELECT 1 FROM judges j WHERE j.wsdc_id = l.wsdc_id))
""")
def audit_typed_subjects(spark, d):
    """Links whose subject of their kind does not exist."""
    links = table(spark, d, "link_snapshots").select("record_key", "subject_kind", "wsdc_id").distinct()
    out = None
    for kind, t in (("entry", "entries"), ("judge", "judges")):
        one = links.filter(F.col("subject_kind") == kind).join(table(spark, d, t).filter("wsdc_id is not null").select("wsdc_id").distinct(), "wsdc_id", "left_anti").select("record_key")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


queries, oracle_sql = query.queries, query.oracle_sql
