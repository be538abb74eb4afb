"""Evidence: support, precedence, ranks, schedules and identifiers in their full form."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.functions import text
from tallyforge.operators.relational import reach
from tallyforge.plans.publication import _ASSESSED, _assessed
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, DANCERS, ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.session import table

query = Queries()


def _ts(t):
    return F.lit(t).cast("timestamp_ntz")


@query(f"SELECT entry_id, snapshot_id FROM {ENTRIES} WHERE snapshot_id IN (SELECT snapshot_id FROM contests WHERE parse_status = 'parsed') OR contest_id IN (SELECT contest_id FROM placements)")
def wanted_snapshots(spark, d):
    """Entries of wanted snapshots: those a read contest has, or whose contest has placements."""
    e = _once(spark, d, "entries", "entry_id").select("entry_id", "snapshot_id", "contest_id")
    by_snapshot = table(spark, d, "contests").filter("parse_status = 'parsed' and snapshot_id is not null").select("snapshot_id").distinct().withColumn("a", F.lit(True))
    by_contest = table(spark, d, "placements").filter("contest_id is not null").select("contest_id").distinct().withColumn("b", F.lit(True))
    j = e.join(by_snapshot, "snapshot_id", "left").join(by_contest, "contest_id", "left")
    return j.filter("a or b").select("entry_id", "snapshot_id")


@query(f"""
WITH p AS (SELECT event_id, 3 AS r, first_seen_at AS t, snapshot_id, source FROM placements UNION ALL SELECT event_id, 2, first_seen_at, snapshot_id, source FROM contests UNION ALL SELECT event_id, 1, first_seen_at, snapshot_id, source FROM dance_events)
SELECT event_id, max(struct_pack(r := r, t := t, s := snapshot_id, v := source)).v AS source, max(struct_pack(r := r, t := t, s := snapshot_id, v := source)).t AS observed_at FROM p WHERE event_id IS NOT NULL AND t IS NOT NULL GROUP BY 1
""")
def scope_evidence(spark, d):
    """The evidence each event rests on, by page kind, time and snapshot, and when it was observed."""
    parts = [table(spark, d, t).filter("event_id is not null and first_seen_at is not null").select("event_id", F.struct(F.lit(r).alias("r"), F.col("first_seen_at").alias("t"), F.col("snapshot_id").alias("s"), F.col("source").alias("v")).alias("m")) for t, r in (("placements", 3), ("contests", 2), ("dance_events", 1))]
    best = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("event_id").agg(F.max("m").alias("m"))
    return best.select("event_id", F.col("m.v").alias("source"), F.col("m.t").alias("observed_at"))


@query(f"""
WITH {_ASSESSED}, k AS (SELECT wsdc_id, max(CASE WHEN lower(trim(acceptance_state)) = 'refused' THEN 1 ELSE 0 END) AS refused FROM link_snapshots WHERE wsdc_id IS NOT NULL GROUP BY 1)
SELECT entry_id, a.wsdc_id, coalesce(refused, 0) = 0 AS allowed FROM a LEFT JOIN k ON k.wsdc_id = a.wsdc_id
""")
def permitted_candidates(spark, d):
    """Whether the journal's decisions allow each candidate."""
    refused = table(spark, d, "link_snapshots").filter("wsdc_id is not null").groupBy("wsdc_id").agg(F.max(F.when(F.lower(F.trim("acceptance_state")) == "refused", 1).otherwise(0)).alias("refused"))
    return _assessed(spark, d).select("entry_id", "wsdc_id").join(refused, "wsdc_id", "left").select("entry_id", "wsdc_id", (F.coalesce("refused", F.lit(0)) == 0).alias("allowed"))


@query(f"""
SELECT DISTINCT e.entry_id, r.wsdc_id FROM {ENTRIES} e JOIN {CONTESTS} c USING (contest_id) JOIN registry_placements r ON r.event_id = e.event_id AND r.role = CASE WHEN e.entry_id LIKE '%/L-%' THEN 'leader' WHEN e.entry_id LIKE '%/F-%' THEN 'follower' END AND r.division = c.division JOIN (SELECT DISTINCT wsdc_id, name_norm FROM dancers) w ON w.wsdc_id = r.wsdc_id AND w.name_norm = e.name_norm
""")
def registry_evidence(spark, d):
    """Entries with the registry rows of their event, role, division and exact name."""
    role = F.when(F.contains("entry_id", F.lit("/L-")), "leader").when(F.contains("entry_id", F.lit("/F-")), "follower")
    e = _once(spark, d, "entries", "entry_id").select("entry_id", "event_id", "contest_id", role.alias("role"), "name_norm").join(_once(spark, d, "contests", "contest_id").select("contest_id", "division"), "contest_id")
    r = table(spark, d, "registry_placements").select("wsdc_id", "event_id", "role", "division").dropna().distinct().join(table(spark, d, "dancers").select("wsdc_id", "name_norm").distinct(), "wsdc_id")
    return e.join(r, ["event_id", "role", "division", "name_norm"]).select("entry_id", "wsdc_id").distinct()


@query(f"""
WITH bad AS (SELECT DISTINCT snapshot_id, parser_version FROM contests WHERE parse_status <> 'parsed' AND snapshot_id IS NOT NULL AND parser_version IS NOT NULL)
SELECT entry_id FROM {ENTRIES} e WHERE EXISTS (SELECT 1 FROM bad b WHERE b.snapshot_id = e.snapshot_id AND b.parser_version = e.parser_version) UNION SELECT DISTINCT contest_id FROM contests c WHERE EXISTS (SELECT 1 FROM bad b WHERE b.snapshot_id = c.snapshot_id AND b.parser_version = c.parser_version)
""")
def revoked_support(spark, d):
    """Rows that rest on a revoked reading, by snapshot and parser."""
    key = ["snapshot_id", "parser_version"]
    c = table(spark, d, "contests")
    bad = c.filter("parse_status <> 'parsed'").select(*key).dropna().distinct()
    e = _once(spark, d, "entries", "entry_id").join(bad, key, "left_semi").select("entry_id")
    return e.unionByName(c.join(bad, key, "left_semi").select(F.col("contest_id").alias("entry_id"))).distinct()


_N = "trim(regexp_replace(replace(lower(strip_accents({c})), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""
WITH m AS (SELECT DISTINCT event_id AS mirror_id, {_N.format(c='name')} AS n, CASE WHEN regexp_matches(trim(start_date), '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(substr(trim(start_date), 1, 10) AS DATE) END AS s, CASE WHEN regexp_matches(trim(end_date), '^\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(substr(trim(end_date), 1, 10) AS DATE) END AS e FROM event_mirror WHERE name IS NOT NULL)
SELECT v.event_id, m.mirror_id FROM {EVENTS} v JOIN m ON m.n = {_N.format(c='v.name')} WHERE (m.s IS NULL OR v.end_date IS NULL OR m.s <= v.end_date) AND (m.e IS NULL OR v.start_date IS NULL OR v.start_date <= m.e)
""")
def named_overlaps(spark, d):
    """Events of both systems with one name whose dates overlap; a bound that is not known bounds nothing."""
    day = lambda c: F.when(F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(F.trim(c), 1, 10).try_cast("date"))
    m = table(spark, d, "event_mirror").filter("name is not null").select(F.col("event_id").alias("mirror_id"), text.event_name(F.col("name")).alias("n"), day("start_date").alias("s"), day("end_date").alias("e")).distinct()
    v = _once(spark, d, "dance_events", "event_id").select("event_id", text.event_name(F.col("name")).alias("n"), "start_date", "end_date")
    within = lambda a, b: F.coalesce(a <= b, F.lit(True))
    return v.join(m, "n").filter(within(F.col("s"), F.col("end_date")) & within(F.col("start_date"), F.col("e"))).select("event_id", "mirror_id")


@query(f"""
WITH r AS (SELECT DISTINCT series_id, event_month AS m FROM registry_placements WHERE event_id IS NULL AND series_id IS NOT NULL AND event_month IS NOT NULL), j AS (SELECT r.series_id, r.m, v.event_id FROM r JOIN {EVENTS} v ON v.series_id = r.series_id AND v.event_month IN (strftime(r.m, '%Y-%m'), strftime(r.m + INTERVAL 1 MONTH, '%Y-%m')) AND v."year" BETWEEN year(r.m) AND year(r.m) + 1 AND coalesce(v.held, '') <> 'cancelled')
SELECT series_id, m AS event_month, CASE WHEN count(DISTINCT event_id) = 1 THEN min(event_id) END AS event_id, count(DISTINCT event_id) AS candidates FROM j GROUP BY 1, 2
""")
def unique_month_match(spark, d):
    """Registry occurrences with the one event of their series held in the month or the next; several leave it open."""
    r = table(spark, d, "registry_placements").filter("event_id is null and series_id is not null and event_month is not null").select("series_id", F.col("event_month").alias("m")).distinct()
    months = r.select("series_id", "m", F.explode(F.array(F.date_format("m", "yyyy-MM"), F.date_format(F.add_months("m", 1), "yyyy-MM"))).alias("event_month"))
    v = _once(spark, d, "dance_events", "event_id").filter(F.coalesce("held", F.lit("")) != "cancelled").select("series_id", "event_month", "event_id", F.col("year").alias("y"))
    j = months.join(v, ["series_id", "event_month"]).filter(F.col("y").between(F.year("m"), F.year("m") + 1))
    n = F.countDistinct("event_id")
    return j.groupBy("series_id", F.col("m")).agg(F.when(n == 1, F.min("event_id")).alias("event_id"), n.alias("candidates")).select("series_id", F.col("m").alias("event_month"), "event_id", "candidates")


@query(f"""
WITH f AS (SELECT contest_id, CASE WHEN entry_id LIKE '%/L-%' THEN 'leader' WHEN entry_id LIKE '%/F-%' THEN 'follower' END AS side, count(*) AS n FROM {ENTRIES} WHERE list_contains(rounds_danced, 'prelim') GROUP BY 1, 2),
s AS (SELECT placement_id, contest_id, event_id, place, 'leader' AS side, leader_wsdc_id AS wsdc_id FROM {PLACEMENTS} UNION ALL SELECT placement_id, contest_id, event_id, place, 'follower', follower_wsdc_id FROM {PLACEMENTS}),
p AS (SELECT s.*, n, (SELECT max(points) FROM registry_placements r WHERE r.wsdc_id = s.wsdc_id AND r.event_id = s.event_id AND r.role = s.side) AS points FROM s LEFT JOIN f ON f.contest_id = s.contest_id AND f.side = s.side)
SELECT placement_id, max(CASE WHEN side = 'leader' THEN n END) AS leader_field, max(CASE WHEN side = 'follower' THEN n END) AS follower_field, max(CASE WHEN side = 'leader' THEN points END) AS leader_points, max(CASE WHEN side = 'follower' THEN points END) AS follower_points, count(points) = 2 AS both_confirmed FROM p GROUP BY 1
""")
def side_points(spark, d):
    """Each side's prelim field and registry points, and whether both are confirmed."""
    side = F.when(F.contains("entry_id", F.lit("/L-")), "leader").when(F.contains("entry_id", F.lit("/F-")), "follower")
    f = _once(spark, d, "entries", "entry_id").filter(F.array_contains("rounds_danced", "prelim")).groupBy("contest_id", side.alias("side")).agg(F.count("*").alias("n"))
    p = _once(spark, d, "placements", "placement_id")
    one = lambda s: F.struct(F.lit(s).alias("side"), F.col(f"{s}_wsdc_id").alias("wsdc_id"))
    s = p.select("placement_id", "contest_id", "event_id", F.explode(F.array(one("leader"), one("follower"))).alias("s")).select("placement_id", "contest_id", "event_id", "s.side", "s.wsdc_id")
    r = table(spark, d, "registry_placements").groupBy("wsdc_id", "event_id", F.col("role").alias("side")).agg(F.max("points").alias("points"))
    j = s.join(f, ["contest_id", "side"], "left").join(r, ["wsdc_id", "event_id", "side"], "left")
    of = lambda k, c: F.max(F.when(F.col("side") == k, F.col(c)))
    return j.groupBy("placement_id").agg(of("leader", "n").alias("leader_field"), of("follower", "n").alias("follower_field"), of("leader", "points").alias("leader_points"), of("follower", "points").alias("follower_points"), (F.count("points") == 2).alias("both_confirmed"))


@query("""
SELECT family, count(*) AS n_bodies, sum(b) AS total_bytes FROM (SELECT family, sha256(body) AS k, max(strlen(body)) AS b FROM raw_receipts WHERE body IS NOT NULL GROUP BY 1, 2) GROUP BY 1
""")
def backlog_bytes(spark, d):
    """Bytes per family that wait to be read; a body that came several times waits once."""
    b = table(spark, d, "raw_receipts").filter("body is not null").groupBy("family", F.sha2("body", 256).alias("k")).agg(F.max(F.octet_length("body")).alias("b"))
    return b.groupBy("family").agg(F.count("*").alias("n_bodies"), F.sum("b").alias("total_bytes"))


@query("""
SELECT series_id, event_month, min(series_name_raw) AS example, count(*) AS n, count(DISTINCT wsdc_id) AS dancers FROM registry_placements WHERE event_id IS NULL GROUP BY 1, 2
""")
def month_proposals(spark, d):
    """Proposals per series and month, with an example of the printed name."""
    return table(spark, d, "registry_placements").filter("event_id is null").groupBy("series_id", "event_month").agg(F.min("series_name_raw").alias("example"), F.count("*").alias("n"), F.countDistinct("wsdc_id").alias("dancers"))


@query("""
WITH s AS (SELECT wsdc_id, role, series_id, event_month, division, dance_style, snapshot_id, max(first_seen_at) AS t, count(DISTINCT coalesce(result, '-') || '|' || coalesce(CAST(points AS VARCHAR), '-')) AS versions, min(coalesce(result, '-')) AS result FROM registry_placements GROUP BY 1, 2, 3, 4, 5, 6, 7),
l AS (SELECT wsdc_id, role, series_id, event_month, division, dance_style, max(struct_pack(t := t, s := snapshot_id, v := versions, r := result)) AS m FROM s GROUP BY 1, 2, 3, 4, 5, 6)
SELECT wsdc_id, role, series_id, event_month, division, dance_style, CASE WHEN m.v = 1 THEN m.r END AS result, m.v > 1 AS conflict FROM l
""")
def newest_registry_rows(spark, d):
    """The newest snapshot's row per native key; where that snapshot says two things neither stands."""
    key = ["wsdc_id", "role", "series_id", "event_month", "division", "dance_style"]
    both = F.concat_ws("|", F.coalesce("result", F.lit("-")), F.coalesce(F.col("points").cast("string"), F.lit("-")))
    s = table(spark, d, "registry_placements").groupBy(*key, "snapshot_id").agg(F.max("first_seen_at").alias("t"), F.countDistinct(both).alias("v"), F.min(F.coalesce("result", F.lit("-"))).alias("r"))
    l = s.groupBy(*key).agg(F.max(F.struct("t", "snapshot_id", "v", "r")).alias("m"))  # noqa: E741
    return l.select(*key, F.when(F.col("m.v") == 1, F.col("m.r")).alias("result"), (F.col("m.v") > 1).alias("conflict"))


@query(f"""
SELECT event_id, row_number() OVER (PARTITION BY replace({_N.format(c="regexp_replace(name, ' [0-9]{4}$', '')")}, ' ', '-'), event_month ORDER BY start_date NULLS LAST, event_id) AS occurrence FROM {EVENTS} WHERE name IS NOT NULL
""")
def calendar_occurrences(spark, d):
    """The number of each event among those of one name and month, by date."""
    v = _once(spark, d, "dance_events", "event_id").filter("name is not null")
    w = Window.partitionBy(text.slug(F.regexp_replace("name", " [0-9]{4}$", "")), "event_month").orderBy(F.col("start_date").asc_nulls_last(), "event_id")
    return v.select("event_id", F.row_number().over(w).alias("occurrence"))


@query(f"""
WITH {_ASSESSED}, k AS (SELECT entry_id, wsdc_id, round(score, 9) AS score, row_number() OVER (PARTITION BY entry_id ORDER BY round(score, 9) DESC, wsdc_id) AS k FROM a)
SELECT a.entry_id, a.wsdc_id, a.score, coalesce(a.score - b.score < 0.05, FALSE) AS ambiguous FROM k a LEFT JOIN k b ON b.entry_id = a.entry_id AND b.k = 2 WHERE a.k = 1
""")
def best_candidates(spark, d):
    """Each entry's best candidate, ambiguous where the second is less than 0.05 behind."""
    w = Window.partitionBy("entry_id").orderBy(F.desc("score"), "wsdc_id")
    k = _assessed(spark, d).select("entry_id", "wsdc_id", F.round("score", 9).alias("score")).withColumn("next", F.lead("score").over(w)).withColumn("k", F.row_number().over(w))
    return k.filter("k = 1").select("entry_id", "wsdc_id", "score", F.coalesce(F.col("score") - F.col("next") < 0.05, F.lit(False)).alias("ambiguous"))


@query(f"""
WITH h AS (SELECT entry_id, strftime(first_seen_at, '%G-%V') AS week, sha256('weekly|' || strftime(first_seen_at, '%G-%V') || '|' || entry_id) AS h FROM {ENTRIES} WHERE first_seen_at IS NOT NULL)
SELECT entry_id, week FROM h WHERE substr(h, 1, 2) < '03'
""")
def weekly_sample(spark, d):
    """About one in a hundred entries of each week, by a seeded hash: the same ones on every run. The share is the feature."""
    e = _once(spark, d, "entries", "entry_id").filter("first_seen_at is not null")
    # The ISO week belongs to the year of its Thursday.
    thursday = F.date_add(F.date_trunc("week", F.col("first_seen_at")).cast("date"), 3)
    week = F.concat(F.year(thursday).cast("string"), F.lit("-"), F.lpad(F.weekofyear("first_seen_at").cast("string"), 2, "0"))
    h = e.select("entry_id", week.alias("week"))
    return h.filter(F.substring(F.sha2(F.concat_ws("|", F.lit("weekly"), "week", "entry_id"), 256), 1, 2) < "03")


@query("""
WITH o AS (SELECT DISTINCT event_id, split_part(contest_id, '/', 2) AS c, source_contest_ref AS ref FROM contests WHERE first_seen_at < TIMESTAMP '2024-09-01' AND event_id IS NOT NULL), n AS (SELECT DISTINCT event_id, split_part(contest_id, '/', 2) AS c, source_contest_ref AS ref FROM contests WHERE last_seen_at >= TIMESTAMP '2024-06-01' AND event_id IS NOT NULL)
SELECT event_id, CASE WHEN event_id IN (SELECT event_id FROM n) THEN 'kept' WHEN count(*) FILTER (WHERE ref IS NULL OR NOT EXISTS (SELECT 1 FROM n WHERE n.c = o.c AND n.ref = o.ref)) = 0 THEN 'moved' ELSE 'lost' END AS fate FROM o GROUP BY 1
""")
def event_fates(spark, d):
    """Events of the baseline: kept, moved (all contests reappear elsewhere by slug and reference) or lost."""
    c = table(spark, d, "contests").filter("event_id is not null").withColumn("c", F.split_part("contest_id", F.lit("/"), F.lit(2)))
    o = c.filter(F.col("first_seen_at") < _ts("2024-09-01 00:00:00")).select("event_id", "c", F.col("source_contest_ref").alias("ref")).distinct()
    n = c.filter(F.col("last_seen_at") >= _ts("2024-06-01 00:00:00")).select("event_id", "c", F.col("source_contest_ref").alias("ref")).distinct()
    j = o.join(n.select("event_id").distinct().withColumn("here", F.lit(True)), "event_id", "left").join(n.filter("ref is not null").select("c", "ref").distinct().withColumn("there", F.lit(True)), ["c", "ref"], "left")
    g = j.groupBy("event_id").agg(F.max("here").alias("here"), F.count_if(F.col("there").isNull()).alias("gone"))
    return g.select("event_id", F.when(F.col("here"), "kept").when(F.col("gone") == 0, "moved").otherwise("lost").alias("fate"))


@query(f"""
SELECT event_id, 'src_' || substr(sha256(website || '?year=' || "year"), 1, 16) AS source_key, regexp_extract(website || '?year=' || "year" || '&tab=results', '[?&]year=([^&]*)', 1) AS year_param, '[' || array_to_string([to_json(x) FOR x IN list_sort(list_distinct(sources))], ',') || ']' AS sources_json, substr(sha256(concat_ws('|', source, event_id, snapshot_id, parser_version)), 1, 16) AS observation_id
FROM {EVENTS} WHERE website IS NOT NULL AND "year" IS NOT NULL AND sources IS NOT NULL
""")
def source_keys(spark, d):
    """Prefixed keys of addresses, a parameter of an address, lists as sorted JSON, and ids of observations by four fields."""
    v = _once(spark, d, "dance_events", "event_id").filter("website is not null and year is not null and sources is not null")
    url = F.concat("website", F.lit("?year="), F.col("year").cast("string"))
    return v.select(
        "event_id", F.concat(F.lit("src_"), F.substring(F.sha2(url, 256), 1, 16)).alias("source_key"), F.parse_url(F.concat(url, F.lit("&tab=results")), F.lit("QUERY"), F.lit("year")).alias("year_param"),
        F.to_json(F.array_sort(F.array_distinct("sources"))).alias("sources_json"), text.short_hash(F.col("source"), F.col("event_id"), F.col("snapshot_id"), F.col("parser_version")).alias("observation_id"),
    )


@query("""
WITH g AS (SELECT user_id, event_type, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS gap FROM events)
SELECT user_id, CASE WHEN gap IS NULL THEN 'unknown' WHEN event_type = 'error' THEN 'blocked' WHEN gap > 21600000000 THEN 'inactive' ELSE 'eligible' END AS state, count(*) AS n, sum(gap) / 1e6 AS seconds FROM g GROUP BY 1, 2
""")
def state_durations(spark, d):
    """How long each user was eligible, blocked after an error, inactive, or in a stretch that has no end yet."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    g = table(spark, d, "events").select("user_id", "event_type", (micros(F.lead("ts").over(w)) - micros(F.col("ts"))).alias("gap"))
    state = F.when(F.col("gap").isNull(), "unknown").when(F.col("event_type") == "error", "blocked").when(F.col("gap") > 21_600_000_000, "inactive").otherwise("eligible")
    return g.groupBy("user_id", state.alias("state")).agg(F.count("*").alias("n"), (F.sum("gap") / 1e6).alias("seconds"))


@query(f"""
WITH h AS (SELECT wsdc_id FROM {DANCERS} WHERE is_pro), x AS (SELECT DISTINCT wsdc_id, event_id FROM {ENTRIES} WHERE wsdc_id IS NOT NULL AND event_id IS NOT NULL)
SELECT x.event_id, count(DISTINCT x.wsdc_id) AS dancers FROM x JOIN h USING (wsdc_id) GROUP BY 1
""")
def reached_events(spark, d):
    """Events that a change of any professional dancer can affect: many seeds, one step along the links."""
    x = _once(spark, d, "entries", "entry_id").select("wsdc_id", "event_id").dropna().distinct()
    return x.join(_once(spark, d, "dancers", "wsdc_id").filter("is_pro").select("wsdc_id"), "wsdc_id", "left_semi").groupBy("event_id").agg(F.countDistinct("wsdc_id").alias("dancers"))


@query(f"""
WITH c AS (SELECT e.entry_id, e.wsdc_id, e.contest_id, e.role, w.primary_role, count(DISTINCT e.role) OVER (PARTITION BY e.wsdc_id, e.event_id) AS roles FROM {ENTRIES} e JOIN {DANCERS} w ON w.wsdc_id = e.wsdc_id WHERE e.role IN ('leader', 'follower')),
f AS (SELECT contest_id, count(*) AS n, count(*) FILTER (WHERE role <> primary_role) AS off FROM c GROUP BY 1)
SELECT entry_id, CASE WHEN roles > 1 THEN 'role_contradicted' WHEN role <> primary_role AND off * 2 > n THEN 'roles_flipped' ELSE 'ok' END AS hold FROM c JOIN f USING (contest_id)
""")
def role_holds(spark, d):
    """Printed ids held because the dancer stands in both roles of an event, or because a contest's roles are flipped as a whole."""
    w = _once(spark, d, "dancers", "wsdc_id").select("wsdc_id", "primary_role")
    c = _once(spark, d, "entries", "entry_id").filter(F.col("role").isin("leader", "follower")).select("entry_id", "wsdc_id", "event_id", "contest_id", "role").join(w, "wsdc_id")
    roles = c.groupBy("wsdc_id", "event_id").agg(F.countDistinct("role").alias("roles")).withColumnRenamed("event_id", "_e")
    f = c.groupBy("contest_id").agg(F.count("*").alias("n"), F.count_if(F.col("role") != F.col("primary_role")).alias("off"))
    j = c.join(roles.withColumnRenamed("wsdc_id", "_w"), (F.col("wsdc_id") == F.col("_w")) & F.col("event_id").eqNullSafe(F.col("_e"))).join(f, "contest_id")
    return j.select("entry_id", F.when(F.col("roles") > 1, "role_contradicted").when((F.col("role") != F.col("primary_role")) & (F.col("off") * 2 > F.col("n")), "roles_flipped").otherwise("ok").alias("hold"))


@query("""
WITH s AS (SELECT family, file_name, min(recorded_at) AS t0, sum(strlen(coalesce(body, ''))) AS b FROM raw_receipts GROUP BY 1, 2), q AS (SELECT *, sum(b) OVER (PARTITION BY family ORDER BY t0, file_name ROWS UNBOUNDED PRECEDING) AS total FROM s)
SELECT file_name, CAST(b AS BIGINT) AS n_bytes, total <= 20000 AS admitted FROM q
""")
def byte_backpressure(spark, d):
    """Files of each family that fit a budget of bytes, oldest first."""
    s = table(spark, d, "raw_receipts").groupBy("family", "file_name").agg(F.min("recorded_at").alias("t0"), F.sum(F.octet_length(F.coalesce("body", F.lit("")))).alias("b"))
    total = F.sum("b").over(Window.partitionBy("family").orderBy("t0", "file_name").rowsBetween(Window.unboundedPreceding, 0))
    return s.select("file_name", F.col("b").alias("n_bytes"), (total <= 20000).alias("admitted"))


@query(f"""
WITH RECURSIVE e AS (SELECT DISTINCT 'c:' || contest_id AS a, 'v:' || event_id AS b FROM {CONTESTS} WHERE event_id IS NOT NULL UNION SELECT DISTINCT 'e:' || entry_id, 'c:' || contest_id FROM {ENTRIES} WHERE contest_id IS NOT NULL UNION SELECT DISTINCT 'p:' || placement_id, 'e:' || leader_entry_id FROM {PLACEMENTS} WHERE leader_entry_id IS NOT NULL),
r(node, root) AS (SELECT DISTINCT 'p:' || placement_id, 'placement' FROM {PLACEMENTS} WHERE place = 1 UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT split_part(node, ':', 1) AS kind, count(DISTINCT node) AS reached FROM r GROUP BY 1
""")
def typed_reachability(spark, d):
    """What winners' placements keep alive, by kind: entries, contests and events along typed references."""
    p, e, c = _once(spark, d, "placements", "placement_id"), _once(spark, d, "entries", "entry_id"), _once(spark, d, "contests", "contest_id")
    edge = lambda df, a, x, b, y: df.select(F.concat(F.lit(f"{a}:"), x).alias("a"), F.concat(F.lit(f"{b}:"), y).alias("b")).dropna()
    edges = edge(p, "p", "placement_id", "e", "leader_entry_id").unionByName(edge(e, "e", "entry_id", "c", "contest_id")).unionByName(edge(c, "c", "contest_id", "v", "event_id"))
    roots = p.filter("place = 1").select(F.concat(F.lit("p:"), "placement_id").alias("node"))
    return reach(roots, edges, "node", "a", "b").groupBy(F.split_part("node", F.lit(":"), F.lit(1)).alias("kind")).agg(F.countDistinct("node").alias("reached"))


queries, oracle_sql = query.queries, query.oracle_sql
