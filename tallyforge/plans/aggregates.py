"""Aggregations, windows, top-k, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.functions.scoring import wilson
from tallyforge.operators import relational as R
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.session import table

query = Queries()


@query(f"""
WITH e AS {ENTRIES}, c AS {CONTESTS}, f AS (
 SELECT 'all' AS scope_kind, '' AS scope_id, e.source, e.event_id, e.contest_id, e.entry_id, e.wsdc_id, e.link_status, e.last_seen_at FROM e
 UNION ALL SELECT 'event', e.event_id, e.source, e.event_id, e.contest_id, e.entry_id, e.wsdc_id, e.link_status, e.last_seen_at FROM e
 UNION ALL SELECT 'year', substr(e.event_id, 1, 4), e.source, e.event_id, e.contest_id, e.entry_id, e.wsdc_id, e.link_status, e.last_seen_at FROM e)
SELECT scope_kind, scope_id, source, count(DISTINCT event_id) AS events, count(DISTINCT contest_id) AS contests, count(DISTINCT entry_id) AS entries, count(DISTINCT wsdc_id) AS dancers,
 count(*) FILTER (WHERE link_status = 'confirmed') AS confirmed, max(last_seen_at) AS last_seen FROM f GROUP BY 1, 2, 3
""")
def coverage_facts(spark, d):
    """Distinct things per scope: every entry stands in three scopes, and sets are counted in one pass by grouping."""
    e = _once(spark, d, "entries", "entry_id")
    scope = F.explode(F.array(*[F.struct(F.lit(k).alias("scope_kind"), v.alias("scope_id")) for k, v in (("all", F.lit("")), ("event", F.col("event_id")), ("year", F.substring("event_id", 1, 4)))]))
    return e.select("source", "event_id", "contest_id", "entry_id", "wsdc_id", "link_status", "last_seen_at", scope.alias("s")).groupBy("s.scope_kind", "s.scope_id", "source").agg(
        F.countDistinct("event_id").alias("events"), F.countDistinct("contest_id").alias("contests"), F.countDistinct("entry_id").alias("entries"), F.countDistinct("wsdc_id").alias("dancers"),
        F.count_if(F.col("link_status") == "confirmed").alias("confirmed"), F.max("last_seen_at").alias("last_seen"),
    )


@query("""
SELECT coverage_tier, date_precision, held, count(DISTINCT event_id) AS n_events, count(DISTINCT event_id) FILTER (WHERE start_date IS NULL) AS n_undated FROM dance_events GROUP BY 1, 2, 3
""")
def event_tiers(spark, d):
    """Events by tier, precision and held."""
    return table(spark, d, "dance_events").groupBy("coverage_tier", "date_precision", "held").agg(F.countDistinct("event_id").alias("n_events"), F.countDistinct(F.when(F.col("start_date").isNull(), F.col("event_id"))).alias("n_undated"))


@query("""
SELECT "year", source, via, count(DISTINCT scope_id) AS scopes, sum(entries) AS entries, sum(CASE WHEN scope_status = 'withheld' THEN 1 ELSE 0 END) AS withheld FROM coverage GROUP BY 1, 2, 3
""")
def coverage_rebuild(spark, d):
    """Coverage per year, source and transport."""
    return table(spark, d, "coverage").groupBy("year", "source", "via").agg(F.countDistinct("scope_id").alias("scopes"), F.sum("entries").alias("entries"), F.sum(F.when(F.col("scope_status") == "withheld", 1).otherwise(0)).alias("withheld"))


@query(f"""
SELECT contest_id, count(*) AS n_entries, count(*) FILTER (WHERE list_contains(rounds_danced, 'final')) AS n_finalists, count(*) FILTER (WHERE best_round = 'semifinal') AS n_semi, max(len(rounds_danced)) AS n_rounds FROM {ENTRIES} GROUP BY 1
""")
def round_rollup(spark, d):
    """Entries per contest and how far they came."""
    return _once(spark, d, "entries", "entry_id").groupBy("contest_id").agg(F.count("*").alias("n_entries"), F.count_if(F.array_contains("rounds_danced", "final")).alias("n_finalists"), F.count_if(F.col("best_round") == "semifinal").alias("n_semi"), F.max(F.size("rounds_danced")).alias("n_rounds"))


@query(f"""
SELECT placement_id, list_sum([CAST(x AS BIGINT) FOR x IN tally]) AS tally_sum, len(tally) AS n_judges, list_aggregate(tally, 'min') AS best_mark FROM {PLACEMENTS}
""")
def tally_lists(spark, d):
    """Sums over a placement's list of marks, without exploding it."""
    return _once(spark, d, "placements", "placement_id").select("placement_id", F.aggregate(F.transform("tally", lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x).alias("tally_sum"), F.size("tally").alias("n_judges"), F.array_min("tally").alias("best_mark"))


@query("""
SELECT DISTINCT wsdc_id, 1.0 / count(*) OVER (PARTITION BY last_name) AS rarity FROM (SELECT DISTINCT wsdc_id, last_name FROM dancers)
""")
def surname_rarity(spark, d):
    """How telling a surname is: one over its bearers. Counted with partial sums and joined, so that a common surname stays no single task."""
    w = table(spark, d, "dancers").select("wsdc_id", "last_name").distinct()
    n = w.groupBy("last_name").agg(F.count("*").alias("n"))
    return w.join(n, "last_name").select("wsdc_id", (F.lit(1.0) / F.col("n")).alias("rarity"))


@query(f"""
WITH r AS (SELECT contest_id, entry_id AS ref FROM {ENTRIES} UNION ALL SELECT contest_id, placement_id FROM {PLACEMENTS})
SELECT contest_id, count(*) AS n_results, count(DISTINCT ref) AS n_refs FROM r GROUP BY 1
""")
def contest_results(spark, d):
    """Result rows per contest over two tables."""
    r = _once(spark, d, "entries", "entry_id").select("contest_id", F.col("entry_id").alias("ref")).unionByName(_once(spark, d, "placements", "placement_id").select("contest_id", F.col("placement_id").alias("ref")))
    return r.groupBy("contest_id").agg(F.count("*").alias("n_results"), F.countDistinct("ref").alias("n_refs"))


@query(f"""
SELECT 'entries' AS measure, count(*) AS value FROM {ENTRIES} UNION ALL SELECT 'linked', count(wsdc_id) FROM {ENTRIES} UNION ALL SELECT 'events', count(DISTINCT event_id) FROM {ENTRIES}
UNION ALL SELECT 'confirmed', count(*) FILTER (WHERE link_status = 'confirmed') FROM {ENTRIES} UNION ALL SELECT 'placements', count(*) FROM {PLACEMENTS} UNION ALL SELECT 'registry_confirmed', count(*) FILTER (WHERE registry_confirmed) FROM {PLACEMENTS}
""")
def release_measures(spark, d):
    """The release's scalar measures, one pass a table."""
    e, p = _once(spark, d, "entries", "entry_id"), _once(spark, d, "placements", "placement_id")
    a = e.agg(F.count("*").alias("entries"), F.count("wsdc_id").alias("linked"), F.countDistinct("event_id").alias("events"), F.count_if(F.col("link_status") == "confirmed").alias("confirmed"))
    b = p.agg(F.count("*").alias("placements"), F.count_if("registry_confirmed").alias("registry_confirmed"))
    out = a.unpivot([], ["entries", "linked", "events", "confirmed"], "measure", "value")
    return out.unionByName(b.unpivot([], ["placements", "registry_confirmed"], "measure", "value"))


@query("""
SELECT series_id, series_name_raw, strftime(min(event_month), '%Y-%m') AS first_month, count(*) AS n FROM registry_placements GROUP BY 1, 2
""")
def alias_proposals(spark, d):
    """Printed names per series with the first month and the count."""
    return table(spark, d, "registry_placements").groupBy("series_id", "series_name_raw").agg(F.date_format(F.min("event_month"), "yyyy-MM").alias("first_month"), F.count("*").alias("n"))


@query("""
SELECT series_id, strftime(event_month, '%Y-%m') AS event_month, count(DISTINCT event_id) AS n_events FROM registry_placements GROUP BY 1, 2 HAVING count(DISTINCT event_id) > 1
""")
def review_having(spark, d):
    """Series and months with several event ids."""
    return table(spark, d, "registry_placements").groupBy("series_id", F.date_format("event_month", "yyyy-MM").alias("event_month")).agg(F.countDistinct("event_id").alias("n_events")).filter("n_events > 1")


@query("""
SELECT wsdc_id, max(registry_fetched_at) AS fetched FROM dancers GROUP BY 1 HAVING max(registry_fetched_at) IS NULL OR max(registry_fetched_at) < (SELECT max(registry_fetched_at) FROM dancers) - INTERVAL 180 DAY
""")
def registry_freshness(spark, d):
    """Dancers whose newest lookup is missing or stale."""
    w = table(spark, d, "dancers")
    newest = w.groupBy("wsdc_id").agg(F.max("registry_fetched_at").alias("fetched"))
    return newest.join(w.agg(F.max("registry_fetched_at").alias("now"))).filter("fetched is null or fetched < now - interval 180 days").drop("now")


@query(f"""
WITH g AS (SELECT source, count(*) FILTER (WHERE link_status = 'confirmed') AS hits, count(*) AS n FROM {ENTRIES} GROUP BY 1)
SELECT source, hits, n, ((hits / n + 3.8414588206941254 / (2 * n)) / (1 + 3.8414588206941254 / n)) - 1.959963984540054 * sqrt(hits / n * (1 - hits / n) / n + 3.8414588206941254 / (4 * n * n)) / (1 + 3.8414588206941254 / n) AS low,
 ((hits / n + 3.8414588206941254 / (2 * n)) / (1 + 3.8414588206941254 / n)) + 1.959963984540054 * sqrt(hits / n * (1 - hits / n) / n + 3.8414588206941254 / (4 * n * n)) / (1 + 3.8414588206941254 / n) AS high FROM g
""")
def stratified_precision(spark, d):
    """Share of confirmed links per source with its 95 % interval."""
    g = _once(spark, d, "entries", "entry_id").groupBy("source").agg(F.count_if(F.col("link_status") == "confirmed").alias("hits"), F.count("*").alias("n"))
    low, high = wilson(F.col("hits"), F.col("n"))
    return g.select("source", "hits", "n", low.alias("low"), high.alias("high"))


@query(f"""
SELECT (SELECT max(end_date) FROM dance_events) AS horizon, (SELECT max(end_date) FROM dance_events WHERE event_id IN (SELECT event_id FROM placements)) AS covered
""")
def horizon(spark, d):
    """The last known end of any event, and of one with placements."""
    v = table(spark, d, "dance_events")
    have = v.join(table(spark, d, "placements").select("event_id").distinct(), "event_id", "left_semi")
    return v.agg(F.max("end_date").alias("horizon")).join(have.agg(F.max("end_date").alias("covered")))


@query("""
SELECT file_name, max(length(body)) AS largest, sum(length(body)) AS total FROM (SELECT DISTINCT file_name, line_no, body FROM raw_receipts WHERE body IS NOT NULL) GROUP BY 1
""")
def backlog_size(spark, d):
    """Characters per file, each line once."""
    return table(spark, d, "raw_receipts").filter("body is not null").select("file_name", "line_no", "body").distinct().groupBy("file_name").agg(F.max(F.length("body")).cast("long").alias("largest"), F.sum(F.length("body")).alias("total"))


@query(f"""
SELECT e.source, count(DISTINCT e.event_id) AS n_events, count(DISTINCT p.placement_id) AS n_placements FROM {ENTRIES} e LEFT JOIN {PLACEMENTS} p ON p.leader_entry_id = e.entry_id GROUP BY 1
""")
def source_rollup(spark, d):
    """Events and placements per source."""
    e, p = _once(spark, d, "entries", "entry_id"), _once(spark, d, "placements", "placement_id").select("placement_id", "leader_entry_id")
    return e.join(p, F.col("entry_id") == F.col("leader_entry_id"), "left").groupBy("source").agg(F.countDistinct("event_id").alias("n_events"), F.countDistinct("placement_id").alias("n_placements"))


@query("""
SELECT coalesce(country, 'all') AS country, coalesce(CAST("year" AS VARCHAR), 'all') AS y, count(DISTINCT event_id) AS n_events FROM dance_events WHERE country IS NOT NULL AND "year" IS NOT NULL GROUP BY ROLLUP (country, "year")
""")
def rollup_country_year(spark, d):
    """Events per country and year with subtotals."""
    v = table(spark, d, "dance_events").filter("country is not null and year is not null")
    return v.rollup("country", "year").agg(F.countDistinct("event_id").alias("n_events")).select(F.coalesce("country", F.lit("all")).alias("country"), F.coalesce(F.col("year").cast("string"), F.lit("all")).alias("y"), "n_events")


@query("""
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, sum(l_extendedprice) AS sum_base_price, sum(l_extendedprice * (1 - l_discount)) AS sum_disc_price, avg(l_discount) AS avg_disc, count(*) AS count_order FROM lineitem GROUP BY 1, 2
""")
def pricing_summary(spark, d):
    """Grouped sums and means with partial aggregation."""
    disc = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.sum("l_extendedprice").alias("sum_base_price"), F.sum(disc).alias("sum_disc_price"), F.avg("l_discount").alias("avg_disc"), F.count("*").alias("count_order"))


# Windows and ranking ------------------------------------------------------------------------------------------------


@query("""
SELECT entry_id, snapshot_id, last_seen_at FROM (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY last_seen_at DESC NULLS LAST, snapshot_id DESC NULLS LAST) AS n FROM (SELECT DISTINCT entry_id, snapshot_id, last_seen_at FROM entries)) WHERE n = 1
""")
def latest_snapshot(spark, d):
    """The newest snapshot of each entry, by a grouped maximum instead of a sorted window."""
    e = table(spark, d, "entries").groupBy("entry_id").agg(F.max(F.struct("last_seen_at", "snapshot_id")).alias("m"))
    return e.select("entry_id", "m.snapshot_id", "m.last_seen_at")


@query("""
SELECT event_id, run_id, seen FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY seen DESC, run_id DESC) AS n FROM (SELECT event_id, run_id, max(last_seen_at) AS seen FROM entries GROUP BY 1, 2)) WHERE n <= 3
""")
def retention_windows(spark, d):
    """The last three runs of each event."""
    g = table(spark, d, "entries").groupBy("event_id", "run_id").agg(F.max("last_seen_at").alias("seen"))
    return R.top_k(g, ["event_id"], [F.col("seen").desc(), F.col("run_id").desc()], 3, "n").drop("n")


@query("""
SELECT event_id, arg_max(city, (last_seen_at, run_id)) FILTER (WHERE city IS NOT NULL) AS city, arg_max(website, (last_seen_at, run_id)) FILTER (WHERE website IS NOT NULL) AS website, arg_max(wsdc_status, (last_seen_at, run_id)) FILTER (WHERE wsdc_status IS NOT NULL) AS wsdc_status
FROM dance_events GROUP BY 1
""")
def precedence_per_attribute(spark, d):
    """Each attribute of an event from its best evidence, on its own."""
    return R.precedence_merge(table(spark, d, "dance_events"), ["event_id"], ["city", "website", "wsdc_status"], [F.col("last_seen_at"), F.col("run_id")])


@query("""
WITH m AS (SELECT series_id, event_month, max(points) AS p FROM registry_placements WHERE points IS NOT NULL GROUP BY 1, 2)
SELECT DISTINCT r.series_id, r.event_month, r.wsdc_id, r.points FROM registry_placements r JOIN m ON r.series_id = m.series_id AND r.event_month = m.event_month AND r.points = m.p
""")
def current_ties_kept(spark, d):
    """All rows that share the greatest points of a series and month."""
    r = table(spark, d, "registry_placements").filter("points is not null").select("series_id", "event_month", "wsdc_id", "points").distinct()
    return R.current(r, ["series_id", "event_month"], [F.col("points")])


@query("""
WITH k AS (SELECT record_key, delivery_no, release_no, lower(trim(status)) AS status FROM link_snapshots), d AS (SELECT lower(trim(record_key)) AS record_key, max(release_no) AS r FROM k GROUP BY 1)
SELECT d.record_key, count(DISTINCT k.status) AS n_claims FROM d JOIN k ON lower(trim(k.record_key)) = d.record_key AND k.release_no = d.r GROUP BY 1 HAVING count(DISTINCT k.status) > 1
""")
def latest_conflicts(spark, d):
    """Conflicting claims inside the newest release of a record; older ones do not count."""
    k = table(spark, d, "link_snapshots").select(F.lower(F.trim("record_key")).alias("record_key"), "release_no", F.lower(F.trim("status")).alias("status"))
    return R.current(k, ["record_key"], [F.col("release_no")]).groupBy("record_key").agg(F.countDistinct("status").alias("n_claims")).filter("n_claims > 1")


@query(f"""
SELECT event_id, CASE WHEN n = 1 THEN slug ELSE slug || '-' || n END AS unique_slug FROM (SELECT event_id, replace(lower(name), ' ', '-') AS slug, row_number() OVER (PARTITION BY lower(name) ORDER BY event_id) AS n FROM {EVENTS})
""")
def occurrence_numbers(spark, d):
    """Slugs made unique by their occurrence in source order."""
    v = _once(spark, d, "dance_events", "event_id").withColumn("n", F.row_number().over(Window.partitionBy(F.lower("name")).orderBy("event_id")))
    slug = F.replace(F.lower("name"), F.lit(" "), F.lit("-"))
    return v.select("event_id", F.when(F.col("n") == 1, slug).otherwise(F.concat_ws("-", slug, "n")).alias("unique_slug"))


@query(f"""
SELECT contest_id, round, row_number() OVER (PARTITION BY contest_id ORDER BY CASE round WHEN 'prelim' THEN 1 WHEN 'quarterfinal' THEN 2 WHEN 'semifinal' THEN 3 WHEN 'final' THEN 4 ELSE 9 END, round) AS round_index
FROM (SELECT DISTINCT contest_id, unnest(rounds_danced) AS round FROM {ENTRIES})
""")
def round_order(spark, d):
    """Rounds of a contest in the order of their stage."""
    r = _once(spark, d, "entries", "entry_id").select("contest_id", F.explode("rounds_danced").alias("round")).distinct()
    stage = F.when(F.col("round") == "prelim", 1).when(F.col("round") == "quarterfinal", 2).when(F.col("round") == "semifinal", 3).when(F.col("round") == "final", 4).otherwise(9)
    return r.withColumn("round_index", F.row_number().over(Window.partitionBy("contest_id").orderBy(stage, "round")))


@query(f"""
WITH c AS (SELECT DISTINCT p.contest_id, e.wsdc_id, p.place FROM {PLACEMENTS} p JOIN {ENTRIES} e ON e.entry_id = p.leader_entry_id WHERE e.wsdc_id IS NOT NULL)
SELECT contest_id, wsdc_id, place, rank, lead(place) OVER (PARTITION BY contest_id ORDER BY rank) - place AS gap FROM (SELECT *, row_number() OVER (PARTITION BY contest_id ORDER BY place, wsdc_id) AS rank FROM c)
""")
def candidate_rank_gap(spark, d):
    """Rank within a contest and the gap to the next."""
    e = _once(spark, d, "entries", "entry_id").filter("wsdc_id is not null").select(F.col("entry_id").alias("leader_entry_id"), "wsdc_id")
    c = _once(spark, d, "placements", "placement_id").join(e, "leader_entry_id").select("contest_id", "wsdc_id", "place").distinct()
    w = Window.partitionBy("contest_id").orderBy("place", "wsdc_id")
    return c.select("contest_id", "wsdc_id", "place", F.row_number().over(w).alias("rank"), (F.lead("place").over(w) - F.col("place")).alias("gap"))


@query(f"""
WITH m AS (SELECT placement_id, round_id, list_sum([CAST(x AS BIGINT) FOR x IN tally]) AS score, place FROM {PLACEMENTS})
SELECT placement_id, CASE WHEN score <= min(CASE WHEN place <= 3 THEN score END) OVER (PARTITION BY round_id) THEN 'advanced' ELSE 'cut' END AS outcome FROM m
""")
def promotion_cut(spark, d):
    """Rows on either side of the best score of the advanced ones."""
    m = _once(spark, d, "placements", "placement_id").select("placement_id", "round_id", "place", F.aggregate(F.transform("tally", lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x).alias("score"))
    cut = F.min(F.when(F.col("place") <= 3, F.col("score"))).over(Window.partitionBy("round_id"))
    return m.select("placement_id", F.when(F.col("score") <= cut, "advanced").otherwise("cut").alias("outcome"))


@query("""
WITH x AS (SELECT DISTINCT user_id, ts, event_id, event_type FROM events), c AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM x WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT event_id, row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) - 1 AS streak FROM g
""")
def unchanged_streak(spark, d):
    """How long a user's event type has stayed the same."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type").distinct()
    return R.islands(e, ["user_id"], ["ts", "event_id"], "event_type").select("event_id", "streak")


# Sort, limit, sampling ----------------------------------------------------------------------------------------------


@query(f"""
SELECT source, entry_id, sample_rank FROM (SELECT source, entry_id, row_number() OVER (PARTITION BY source ORDER BY sha256(concat_ws('|', '7', source, entry_id)), entry_id) AS sample_rank FROM {ENTRIES}) WHERE sample_rank <= 20
""")
def sample_strata(spark, d):
    """Twenty entries a source in the order of a seeded hash."""
    e = _once(spark, d, "entries", "entry_id").select("source", "entry_id")
    return R.sample_by_hash(e, ["source"], "entry_id", "7", 20)


@query("SELECT entry_id, first_seen_at FROM (SELECT DISTINCT entry_id, first_seen_at FROM entries) ORDER BY first_seen_at DESC, entry_id DESC LIMIT 50")
def report_newest(spark, d):
    """A bounded report: the fifty newest entries."""
    return table(spark, d, "entries").select("entry_id", "first_seen_at").distinct().orderBy(F.col("first_seen_at").desc(), F.col("entry_id").desc()).limit(50)


@query("SELECT DISTINCT scope_kind, scope_id FROM coverage WHERE (scope_kind, scope_id) > ('dancer', '5') ORDER BY 1, 2 LIMIT 25")
def keyset_page(spark, d):
    """A page of scopes after a key."""
    c = table(spark, d, "coverage").select("scope_kind", "scope_id").distinct()
    return c.filter((F.col("scope_kind") > "dancer") | ((F.col("scope_kind") == "dancer") & (F.col("scope_id") > "5"))).orderBy("scope_kind", "scope_id").limit(25)


@query("""
SELECT source, min(entry_id) AS turn FROM (SELECT source, entry_id, rank() OVER (PARTITION BY source ORDER BY first_seen_at) AS n FROM entries WHERE first_seen_at IS NOT NULL) WHERE n = 1 GROUP BY 1
""")
def fair_turn(spark, d):
    """The next choice of each source: the earliest, then the least id."""
    return table(spark, d, "entries").filter("first_seen_at is not null").groupBy("source").agg(F.min(F.struct("first_seen_at", "entry_id")).alias("m")).select("source", F.col("m.entry_id").alias("turn"))


# Set operations -----------------------------------------------------------------------------------------------------


@query("""
SELECT DISTINCT wsdc_id FROM (SELECT wsdc_id FROM entries UNION ALL SELECT wsdc_id FROM judges UNION ALL SELECT leader_wsdc_id FROM placements UNION ALL SELECT follower_wsdc_id FROM placements UNION ALL SELECT wsdc_id FROM registry_placements UNION ALL SELECT wsdc_id FROM link_snapshots) WHERE wsdc_id IS NOT NULL
""")
def union_ids(spark, d):
    """Every dancer id any of six columns names. Each part is made distinct first, so that little is shuffled."""
    parts = [("entries", "wsdc_id"), ("judges", "wsdc_id"), ("placements", "leader_wsdc_id"), ("placements", "follower_wsdc_id"), ("registry_placements", "wsdc_id"), ("link_snapshots", "wsdc_id")]
    out = None
    for t, c in parts:
        one = table(spark, d, t).filter(F.col(c).isNotNull()).select(F.col(c).alias("wsdc_id"))
        out = one if out is None else out.unionByName(one)
    return out.distinct()


@query("""
SELECT substr(event_id, 1, 4) AS y FROM entries UNION SELECT strftime(event_month, '%Y') FROM registry_placements UNION SELECT substr(event_month, 1, 4) FROM dance_events
""")
def year_universe(spark, d):
    """All years of three tables."""
    a = table(spark, d, "entries").select(F.substring("event_id", 1, 4).alias("y"))
    b = table(spark, d, "registry_placements").select(F.date_format("event_month", "yyyy").alias("y"))
    c = table(spark, d, "dance_events").select(F.substring("event_month", 1, 4).alias("y"))
    return a.union(b).union(c).distinct()


_STEPS = "(SELECT before, release_no FROM (SELECT release_no, lag(release_no) OVER (ORDER BY release_no) AS before FROM (SELECT DISTINCT release_no FROM link_snapshots WHERE release_no IS NOT NULL)) WHERE before IS NOT NULL)"


def _steps(k):
    """(before, release_no): each release and the one before it."""
    r = k.select("release_no").distinct()
    return r.join(r.select(F.col("release_no").alias("before")), F.col("before") < F.col("release_no")).groupBy("release_no").agg(F.max("before").alias("before"))


@query(f"""
WITH k AS (SELECT DISTINCT release_no, lower(trim(record_key)) AS record_key FROM link_snapshots)
SELECT r.release_no, o.record_key FROM {_STEPS} r JOIN k o ON o.release_no = r.before WHERE NOT EXISTS (SELECT 1 FROM k n WHERE n.release_no = r.release_no AND n.record_key IS NOT DISTINCT FROM o.record_key)
""")
def removed_ids_all(spark, d):
    """For every release, the keys of the one before that it lacks."""
    k = table(spark, d, "link_snapshots").select("release_no", F.lower(F.trim("record_key")).alias("record_key"))
    steps = _steps(k)
    old = k.withColumnRenamed("release_no", "before").join(steps, "before").select("release_no", "record_key")
    return old.subtract(k)


@query(f"""
WITH k AS (SELECT release_no, lower(trim(status)) AS status, lower(trim(method)) AS method FROM link_snapshots),
g AS (SELECT r.release_no, k.status, k.method, sum(CASE WHEN k.release_no = r.before THEN 1 ELSE -1 END) AS n_missing FROM {_STEPS} r JOIN k ON k.release_no IN (r.before, r.release_no) GROUP BY 1, 2, 3)
SELECT release_no, status, method, n_missing FROM g WHERE n_missing > 0
""")
def multiset_gaps_all(spark, d):
    """Status and method pairs that any release holds less often than the one before."""
    k = table(spark, d, "link_snapshots").select("release_no", F.lower(F.trim("status")).alias("status"), F.lower(F.trim("method")).alias("method"))
    steps = _steps(k)
    old = k.withColumnRenamed("release_no", "before").join(steps, "before").select("release_no", "status", "method")
    return R.multiset_gap(old, k, ["release_no", "status", "method"])


queries, oracle_sql = query.queries, query.oracle_sql
