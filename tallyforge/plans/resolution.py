"""Entity resolution and projection operators over the event-result tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import scoring, text
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import DANCERS, ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.plans.textual import _LEVEL, _PLAIN
from tallyforge.session import table

query = Queries()

_NAME = "trim(regexp_replace(" + _PLAIN + ", '[^a-z0-9]+', ' ', 'g'))"
_W = scoring.WEIGHTS


def _candidates(spark, d):
    """Entry and dancer pairs that agree on the whole plain name, with the signals of their score."""
    words = lambda c: F.trim(F.regexp_replace(text.plain(c), "[^a-z0-9]+", " "))
    e = _once(spark, d, "entries", "entry_id").filter(F.col("role").isin("leader", "follower")).select("entry_id", "contest_id", "bib", "role", F.col("wsdc_id").alias("printed"), words(F.col("name_raw")).alias("n"), F.regexp_extract("contest_id", "/([a-z]+)-", 1).alias("division"), F.substring("event_id", 1, 4).cast("int").alias("y"))
    w = _once(spark, d, "dancers", "wsdc_id").filter("merged_into_wsdc_id is null").select("wsdc_id", words(F.concat("first_name", F.lit(" "), "last_name")).alias("n"), "primary_role", "recent_year", *[f"{r}_{k}_level" for r in ("leader", "follower") for k in ("required", "allowed")])
    j = e.join(w, "n")
    level = lambda k: F.when(F.col("role") == "leader", F.col(f"leader_{k}_level")).otherwise(F.col(f"follower_{k}_level"))
    ok = scoring.division_ok(F.col("division"), level("required"), level("allowed"))
    score = scoring.candidate_score(F.lit(1.0), F.col("role") == F.col("primary_role"), F.coalesce(F.col("recent_year") >= F.col("y") - 3, F.lit(False)), ok)
    return j.select("entry_id", "contest_id", "bib", "role", "printed", "wsdc_id", F.when(F.col("printed") == F.col("wsdc_id"), 1.0).otherwise(score).alias("score"))


_CAND = f"""(SELECT entry_id, contest_id, bib, role, printed, wsdc_id, CASE WHEN printed = wsdc_id THEN 1.0 ELSE
  least(1.0, ({_W['name']} + {_W['role']} * CAST(role = primary_role AS INTEGER) + {_W['recency']} * CAST(coalesce(recent_year >= y - 3, FALSE) AS INTEGER) + CASE WHEN ok THEN {_W['division']} ELSE 0 END) / ({_W['name']} + {_W['role']} + {_W['recency']} + CASE WHEN ok IS NULL THEN 0 ELSE {_W['division']} END)) * CASE WHEN ok = FALSE THEN 0.1 ELSE 1.0 END END AS score
 FROM (SELECT e.*, w.wsdc_id, w.primary_role, w.recent_year, {_LEVEL.format(c='e.division')} BETWEEN {_LEVEL.format(c="CASE WHEN e.role = 'leader' THEN w.leader_required_level ELSE w.follower_required_level END")} AND {_LEVEL.format(c="CASE WHEN e.role = 'leader' THEN w.leader_allowed_level ELSE w.follower_allowed_level END")} AS ok
  FROM (SELECT entry_id, contest_id, bib, role, wsdc_id AS printed, {_NAME.format(c='name_raw')} AS n, regexp_extract(contest_id, '/([a-z]+)-', 1) AS division, CAST(substr(event_id, 1, 4) AS INTEGER) AS y FROM {ENTRIES} WHERE role IN ('leader', 'follower')) e
  JOIN (SELECT *, {_NAME.format(c="first_name || ' ' || last_name")} AS n FROM {DANCERS} WHERE merged_into_wsdc_id IS NULL) w ON w.n = e.n))"""


@query(f"SELECT entry_id, wsdc_id, score FROM {_CAND}")
def candidate_scores(spark, d):
    """Scored candidates of each entry."""
    return _candidates(spark, d).select("entry_id", "wsdc_id", "score")


@query(f"""
WITH c AS {_CAND}, h AS (SELECT contest_id, role, wsdc_id FROM c WHERE score >= 0.9 GROUP BY 1, 2, 3 HAVING count(DISTINCT bib) > 1)
SELECT c.entry_id, c.wsdc_id, h.wsdc_id IS NOT NULL AS held FROM c LEFT JOIN h USING (contest_id, role, wsdc_id)
""")
def competing_claims(spark, d):
    """Candidates held because several bibs of a contest's role claim one dancer strongly."""
    c = _candidates(spark, d)
    held = c.filter("score >= 0.9").groupBy("contest_id", "role", "wsdc_id").agg(F.countDistinct("bib").alias("b")).filter("b > 1").withColumn("held", F.lit(True))
    return c.join(held, ["contest_id", "role", "wsdc_id"], "left").select("entry_id", "wsdc_id", F.coalesce("held", F.lit(False)).alias("held"))


@query()
def assigned_links(spark, d):
    """One-to-one links of greatest total score within a contest's role."""
    return scoring.best_assignment(_candidates(spark, d), ["contest_id", "role"], "entry_id", "wsdc_id", "score")


@query(f"""
WITH c AS {_CAND}, b AS (SELECT entry_id, max(score) AS best, count(*) AS n, bool_or(printed = wsdc_id) AS by_id FROM c GROUP BY 1)
SELECT e.entry_id, CASE WHEN b.by_id THEN 'source_id' WHEN b.n > 1 THEN 'ambiguous' WHEN b.best >= 0.8 THEN 'name_scored' WHEN b.best >= 0.5 THEN 'tentative' ELSE 'unmatched' END AS conclusion FROM {ENTRIES} e LEFT JOIN b USING (entry_id)
""")
def conclusions(spark, d):
    """The conclusion on each entry by an ordered policy."""
    c = _candidates(spark, d).groupBy("entry_id").agg(F.max("score").alias("best"), F.count("*").alias("n"), F.bool_or(F.col("printed") == F.col("wsdc_id")).alias("by_id"))
    e = _once(spark, d, "entries", "entry_id").select("entry_id").join(c, "entry_id", "left")
    return e.select("entry_id", F.when(F.col("by_id"), "source_id").when(F.col("n") > 1, "ambiguous").when(F.col("best") >= 0.8, "name_scored").when(F.col("best") >= 0.5, "tentative").otherwise("unmatched").alias("conclusion"))


@query("""
WITH k AS (SELECT lower(trim(record_key)) AS record_key, lower(trim(acceptance_state)) AS state, wsdc_id, release_no FROM link_snapshots)
SELECT record_key, count(DISTINCT wsdc_id) FILTER (WHERE state = 'accepted') AS n_accepted, count(*) FILTER (WHERE state = 'refused') AS n_refused,
 CASE WHEN count(DISTINCT wsdc_id) FILTER (WHERE state = 'accepted') > 1 THEN 'contradiction' WHEN count(*) FILTER (WHERE state = 'refused') > 0 AND count(*) FILTER (WHERE state = 'accepted') > 0 THEN 'hold' WHEN count(*) FILTER (WHERE state = 'accepted') > 0 THEN 'positive' WHEN count(*) FILTER (WHERE state = 'refused') > 0 THEN 'blocked' ELSE 'open' END AS decision FROM k GROUP BY 1
""")
def decision_policy(spark, d):
    """What a journal of decisions says of each record."""
    k = table(spark, d, "link_snapshots").select(F.lower(F.trim("record_key")).alias("record_key"), F.lower(F.trim("acceptance_state")).alias("state"), "wsdc_id")
    yes, no = F.col("state") == "accepted", F.col("state") == "refused"
    g = k.groupBy("record_key").agg(F.countDistinct(F.when(yes, F.col("wsdc_id"))).alias("n_accepted"), F.count_if(no).alias("n_refused"), F.count_if(yes).alias("y"))
    return g.select("record_key", "n_accepted", "n_refused", F.when(F.col("n_accepted") > 1, "contradiction").when((F.col("n_refused") > 0) & (F.col("y") > 0), "hold").when(F.col("y") > 0, "positive").when(F.col("n_refused") > 0, "blocked").otherwise("open").alias("decision"))


@query(f"""
SELECT e.entry_id, r.entry_id AS into_entry FROM {ENTRIES} e JOIN (SELECT contest_id, role, name_norm, min(entry_id) AS entry_id FROM {ENTRIES} WHERE bib IS NOT NULL AND name_norm IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) = 1) r ON r.contest_id = e.contest_id AND r.role = e.role AND r.name_norm = e.name_norm WHERE e.bib IS NULL
""")
def entry_redirects(spark, d):
    """Entries without bib that one entry with bib of the same contest, role and name stands for."""
    e = _once(spark, d, "entries", "entry_id").select("entry_id", "contest_id", "role", "name_norm", "bib")
    one = e.filter("bib is not null and name_norm is not null").groupBy("contest_id", "role", "name_norm").agg(F.count("*").alias("n"), F.min("entry_id").alias("into_entry")).filter("n = 1")
    return e.filter("bib is null").join(one, ["contest_id", "role", "name_norm"]).select("entry_id", "into_entry")


@query(f"""
SELECT e.entry_id, CASE WHEN w.wsdc_id IS NULL THEN 'not_in_registry' WHEN split_part(w.name_norm, ' ', -1) <> split_part({_NAME.format(c='e.name_raw')}, ' ', -1) AND split_part(w.name_norm, ' ', -1) <> split_part({_NAME.format(c='e.name_raw')}, ' ', 1) THEN 'name_disagrees' ELSE 'ok' END AS hold
FROM {ENTRIES} e LEFT JOIN {DANCERS} w ON w.wsdc_id = e.wsdc_id WHERE e.wsdc_id IS NOT NULL
""")
def printed_id_holds(spark, d):
    """Why a printed id is not taken: unknown, or its dancer's surname is not in the printed name."""
    n = F.trim(F.regexp_replace(text.plain(F.col("name_raw")), "[^a-z0-9]+", " "))
    e = _once(spark, d, "entries", "entry_id").filter("wsdc_id is not null").select("entry_id", "wsdc_id", n.alias("n"))
    w = _once(spark, d, "dancers", "wsdc_id").select(F.col("wsdc_id").alias("w"), F.split_part("name_norm", F.lit(" "), F.lit(-1)).alias("s"))
    j = e.join(w, F.col("wsdc_id") == F.col("w"), "left")
    part = lambda i: F.split_part("n", F.lit(" "), F.lit(i))
    return j.select("entry_id", F.when(F.col("w").isNull(), "not_in_registry").when((F.col("s") != part(-1)) & (F.col("s") != part(1)), "name_disagrees").otherwise("ok").alias("hold"))


@query(f"""
SELECT event_id, coalesce(website, 'none') AS website, start_date, CASE WHEN start_date IS NULL THEN 'month' ELSE 'day' END AS precision, [s FOR s IN list_sort(sources) IF s <> 'generic'] AS sources, len(list_filter_none) AS n FROM (SELECT *, [s FOR s IN sources IF s LIKE 'wsdc%'] AS list_filter_none FROM {EVENTS})
""")
def project_calendar(spark, d):
    """Calendar rows as events: precision, listing sources, registry listings."""
    v = _once(spark, d, "dance_events", "event_id")
    return v.select("event_id", F.coalesce("website", F.lit("none")).alias("website"), "start_date", F.when(F.col("start_date").isNull(), "month").otherwise("day").alias("precision"), F.filter(F.array_sort("sources"), lambda s: s != "generic").alias("sources"), F.size(F.filter("sources", lambda s: s.startswith("wsdc"))).alias("n"))


@query("""
WITH r AS (SELECT series_id, strftime(event_month, '%Y-%m') AS m, count(DISTINCT wsdc_id) AS dancers FROM registry_placements GROUP BY 1, 2), v AS (SELECT series_id, event_month AS m, min(event_id) AS event_id, max(first_seen_at) AS seen FROM dance_events GROUP BY 1, 2)
SELECT coalesce(r.series_id, v.series_id) AS series_id, coalesce(r.m, v.m) AS event_month, v.event_id, coalesce(r.dancers, 0) AS dancers, CASE WHEN v.event_id IS NULL THEN 'registry_only' WHEN r.series_id IS NULL THEN 'listing_only' ELSE 'both' END AS origin FROM r FULL OUTER JOIN v ON r.series_id = v.series_id AND r.m = v.m
""")
def inventory(spark, d):
    """Occurrences of the registry and of listings in one inventory."""
    r = table(spark, d, "registry_placements").groupBy("series_id", F.date_format("event_month", "yyyy-MM").alias("event_month")).agg(F.countDistinct("wsdc_id").alias("dancers")).withColumn("r", F.lit(True))
    v = table(spark, d, "dance_events").groupBy("series_id", "event_month").agg(F.min("event_id").alias("event_id"))
    j = r.join(v, ["series_id", "event_month"], "full_outer")
    return j.select("series_id", "event_month", "event_id", F.coalesce("dancers", F.lit(0)).alias("dancers"), F.when(F.col("event_id").isNull(), "registry_only").when(F.col("r").isNull(), "listing_only").otherwise("both").alias("origin"))


@query("""
SELECT lower(name) AS name, min(event_id) AS edition FROM (SELECT *, rank() OVER (PARTITION BY lower(name) ORDER BY first_seen_at, length(event_id)) AS n FROM dance_events WHERE first_seen_at IS NOT NULL) WHERE n = 1 GROUP BY 1
""")
def edition_ids(spark, d):
    """The id of each name's first edition: oldest, then shortest, then least."""
    v = table(spark, d, "dance_events").filter("first_seen_at is not null")
    return v.groupBy(F.lower("name").alias("name")).agg(F.min(F.struct("first_seen_at", F.length("event_id").alias("l"), "event_id")).alias("m")).select("name", F.col("m.event_id").alias("edition"))


@query("""
SELECT a.event_id, a.city AS ours, trim(b.city) AS theirs FROM (SELECT DISTINCT event_id, city FROM dance_events) a JOIN (SELECT DISTINCT lower(trim(event_id)) AS event_id, city FROM event_mirror) b USING (event_id) WHERE coalesce(a.city, '') <> coalesce(trim(b.city), '')
""")
def mirror_crosscheck(spark, d):
    """Cities that two copies print differently, byte for byte."""
    a = table(spark, d, "dance_events").select("event_id", "city").distinct()
    b = table(spark, d, "event_mirror").select(F.lower(F.trim("event_id")).alias("event_id"), F.col("city").alias("c")).distinct()
    return a.join(b, "event_id").filter(F.coalesce("city", F.lit("")) != F.coalesce(F.trim("c"), F.lit(""))).select("event_id", F.col("city").alias("ours"), F.trim("c").alias("theirs"))


@query(f"""
SELECT p.placement_id, l.partner_name_raw AS leader_says, f.name_raw AS follower_is, l.partner_name_raw = f.name_raw AS agrees FROM {PLACEMENTS} p JOIN {ENTRIES} l ON l.entry_id = p.leader_entry_id JOIN {ENTRIES} f ON f.entry_id = p.follower_entry_id WHERE l.partner_name_raw IS NOT NULL
""")
def partner_links(spark, d):
    """Whether a leader's printed partner is the follower of the placement."""
    e = _once(spark, d, "entries", "entry_id")
    p = _once(spark, d, "placements", "placement_id").select("placement_id", "leader_entry_id", "follower_entry_id")
    j = p.join(e.filter("partner_name_raw is not null").select(F.col("entry_id").alias("leader_entry_id"), F.col("partner_name_raw").alias("leader_says")), "leader_entry_id").join(e.select(F.col("entry_id").alias("follower_entry_id"), F.col("name_raw").alias("follower_is")), "follower_entry_id")
    return j.select("placement_id", "leader_says", "follower_is", (F.col("leader_says") == F.col("follower_is")).alias("agrees"))


@query("""
SELECT event_id, lower(trim(name_raw)) AS judge, max(initials) AS initials, max(wsdc_id) AS wsdc_id, count(*) AS n FROM judges WHERE NOT anonymous AND name_raw IS NOT NULL GROUP BY 1, 2
""")
def collect_judges(spark, d):
    """Distinct judges of an event with their best known facts."""
    j = table(spark, d, "judges").filter("not anonymous and name_raw is not null")
    return j.groupBy("event_id", F.lower(F.trim("name_raw")).alias("judge")).agg(F.max("initials").alias("initials"), F.max("wsdc_id").alias("wsdc_id"), F.count("*").alias("n"))


@query("""
SELECT DISTINCT source, CASE source WHEN 'wsdc_registry' THEN 'registry' WHEN 'wsdc_calendar' THEN 'calendar' ELSE 'platform' END AS history_class FROM entries
""")
def source_classes(spark, d):
    """The history class of each source, platform by default."""
    classes = F.create_map(*[F.lit(x) for kv in {"wsdc_registry": "registry", "wsdc_calendar": "calendar"}.items() for x in kv])
    return table(spark, d, "entries").select("source", F.coalesce(F.try_element_at(classes, F.col("source")), F.lit("platform")).alias("history_class")).distinct()


queries, oracle_sql = query.queries, query.oracle_sql
