"""Audits and coverage reports over the whole set of tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.session import table

query = Queries()

# (child, column, parent, key): the references an audit follows.
REFERENCES = [
    ("contests", "event_id", "dance_events", "event_id"), ("entries", "event_id", "dance_events", "event_id"), ("entries", "contest_id", "contests", "contest_id"),
    ("entries", "partner_entry_id", "entries", "entry_id"), ("judges", "event_id", "dance_events", "event_id"), ("placements", "contest_id", "contests", "contest_id"),
    ("placements", "event_id", "dance_events", "event_id"), ("placements", "leader_entry_id", "entries", "entry_id"), ("placements", "follower_entry_id", "entries", "entry_id"),
    ("placements", "couple_entry_id", "entries", "entry_id"), ("registry_placements", "wsdc_id", "dancers", "wsdc_id"), ("registry_placements", "event_id", "dance_events", "event_id"),
    ("entries", "wsdc_id", "dancers", "wsdc_id"), ("judges", "wsdc_id", "dancers", "wsdc_id"),
]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@query(" UNION ALL ".join(f"SELECT '{c}.{k}->{p}.{pk}' AS reference, count(*) AS missing FROM {c} a WHERE a.{k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} b WHERE b.{pk} = a.{k})" for c, k, p, pk in REFERENCES))
def audit_foreign_keys(spark, d):
    """Rows per reference whose target does not exist.

    All keys meet in one table by parent and key, counted before the shuffle, so that fourteen references cost one shuffle.
    """
    parents = {(p, pk) for _, _, p, pk in REFERENCES}
    zero = F.lit(0).cast("long")
    keys = [table(spark, d, p).select(F.lit(f"{p}.{pk}").alias("parent"), F.col(pk).cast("string").alias("key"), F.lit("").alias("reference"), F.lit(True).alias("there")) for p, pk in sorted(parents)]
    refs = [table(spark, d, c).filter(F.col(k).isNotNull()).select(F.lit(f"{p}.{pk}").alias("parent"), F.col(k).cast("string").alias("key"), F.lit(f"{c}.{k}->{p}.{pk}").alias("reference"), F.lit(False).alias("there")) for c, k, p, pk in REFERENCES]
    counted = _union(keys + refs).groupBy("parent", "key", "reference").agg(F.max("there").alias("there"), F.count("*").alias("n"))
    kept = counted.groupBy("parent", "key").agg(F.max("there").alias("there"), F.map_from_entries(F.collect_list(F.when(F.col("reference") != "", F.struct("reference", "n")))).alias("refs"))
    missing = kept.filter("not there").select(F.explode("refs").alias("reference", "n")).groupBy("reference").agg(F.sum("n").alias("n"))
    every = spark.createDataFrame([(f"{c}.{k}->{p}.{pk}",) for c, k, p, pk in REFERENCES], "reference string")
    return every.join(missing, "reference", "left").select("reference", F.coalesce("n", zero).alias("missing"))


_SNAPPED = ["entries", "placements", "judges", "registry_placements", "dancers"]


@query(f"""WITH s AS (SELECT snapshot_id FROM contests UNION SELECT snapshot_id FROM dance_events) {" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS missing FROM {t} a WHERE a.snapshot_id IS NULL OR (a.snapshot_id <> 'override' AND a.snapshot_id NOT IN (SELECT snapshot_id FROM s WHERE snapshot_id IS NOT NULL))" for t in _SNAPPED)}""")
def audit_snapshot_references(spark, d):
    """Rows without a known snapshot, overrides apart; contests and events say which snapshots are known."""
    known = table(spark, d, "contests").select("snapshot_id").unionByName(table(spark, d, "dance_events").select("snapshot_id")).filter("snapshot_id is not null").distinct()
    rows = _union([table(spark, d, t).groupBy("snapshot_id").agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "snapshot_id", "n") for t in _SNAPPED])
    gone = rows.join(known.withColumn("there", F.lit(True)), "snapshot_id", "left")
    bad = F.col("snapshot_id").isNull() | ((F.col("snapshot_id") != "override") & F.col("there").isNull())
    return gone.groupBy("table_name").agg(F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("missing"))


@query(f"""
SELECT 'entry' AS subject_kind, count(*) AS n FROM {ENTRIES} e WHERE e.wsdc_id IS NOT NULL AND (e.link_status IS DISTINCT FROM 'confirmed' OR NOT EXISTS (SELECT 1 FROM registry_placements r WHERE r.wsdc_id = e.wsdc_id AND r.event_id = e.event_id))
UNION ALL SELECT 'judge', count(*) FROM judges j WHERE j.wsdc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM dancers w WHERE w.wsdc_id = j.wsdc_id)
""")
def audit_unsupported_links(spark, d):
    """Ids that stand by default although nothing supports them: anti joins on the composite key."""
    r = table(spark, d, "registry_placements").select("wsdc_id", "event_id").dropna().distinct().withColumn("there", F.lit(True))
    e = _once(spark, d, "entries", "entry_id").filter("wsdc_id is not null").join(r, ["wsdc_id", "event_id"], "left").filter(~F.col("link_status").eqNullSafe(F.lit("confirmed")) | F.col("there").isNull())
    j = table(spark, d, "judges").filter("wsdc_id is not null").join(table(spark, d, "dancers").select("wsdc_id").distinct(), "wsdc_id", "left_anti")
    count = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("subject_kind"), "n")
    return count(e, "entry").unionByName(count(j, "judge"))


@query(f"""
WITH m AS (SELECT placement_id, source, list_sum([CAST(x AS INTEGER) FOR x IN string_split(marks_sorted, '')]) AS printed, list_sum([CAST(x AS INTEGER) FOR x IN tally]) AS tallied, len(marks_sorted) AS n_printed, len(tally) AS n_tallied FROM {PLACEMENTS} WHERE regexp_matches(marks_sorted, '^[0-9]+$') AND tally IS NOT NULL)
SELECT source, count(*) AS n, count(*) FILTER (WHERE abs(printed - tallied) > 0.001 OR n_printed <> n_tallied) AS mismatches FROM m GROUP BY 1
""")
def audit_mark_sums(spark, d):
    """Placements per source whose printed marks and tally differ in sum or number."""
    p = _once(spark, d, "placements", "placement_id").filter(F.col("marks_sorted").rlike("^[0-9]+$") & F.col("tally").isNotNull())
    total = lambda c: F.aggregate(F.transform(c, lambda x: x.cast("int")), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    digits = F.split("marks_sorted", "")
    m = p.select("source", total(digits).alias("a"), total(F.col("tally")).alias("b"), F.length("marks_sorted").alias("na"), F.size("tally").alias("nb"))
    return m.groupBy("source").agg(F.count("*").alias("n"), F.count_if((F.abs(F.col("a") - F.col("b")) > 0.001) | (F.col("na") != F.col("nb"))).alias("mismatches"))


@query(f"""
WITH p AS (SELECT p.*, c.division, c.dance_style FROM {PLACEMENTS} p JOIN {CONTESTS} c USING (contest_id)),
s AS (SELECT placement_id, event_id, division, dance_style, place, 'leader' AS role, leader_wsdc_id AS wsdc_id, registry_points_leader AS points FROM p UNION ALL SELECT placement_id, event_id, division, dance_style, place, 'follower', follower_wsdc_id, registry_points_follower FROM p)
SELECT role, count(*) AS claimed, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM registry_placements r WHERE r.event_id = s.event_id AND r.wsdc_id = s.wsdc_id AND r.role = s.role AND r.division = s.division AND r.dance_style = s.dance_style AND r.result = CAST(s.place AS VARCHAR) AND r.points = s.points)) AS orphans FROM s WHERE points IS NOT NULL GROUP BY 1
""")
def audit_point_evidence(spark, d):
    """Points that placements claim per role, and how many no registry row supports in all seven fields."""
    c = _once(spark, d, "contests", "contest_id").select("contest_id", "division", "dance_style")
    p = _once(spark, d, "placements", "placement_id").join(c, "contest_id")
    side = lambda r: F.struct(F.lit(r).alias("role"), F.col(f"{r}_wsdc_id").alias("wsdc_id"), F.col(f"registry_points_{r}").alias("points"))
    s = p.select("event_id", "division", "dance_style", F.col("place").cast("string").alias("result"), F.explode(F.array(side("leader"), side("follower"))).alias("s")).select("*", "s.*").drop("s").filter("points is not null")
    keys = ["event_id", "wsdc_id", "role", "division", "dance_style", "result", "points"]
    r = table(spark, d, "registry_placements").select(*keys).dropna().distinct().withColumn("there", F.lit(True))
    return s.join(r, keys, "left").groupBy("role").agg(F.count("*").alias("claimed"), F.count_if(F.col("there").isNull()).alias("orphans"))


@query(f"""
SELECT v.source, count(DISTINCT v.event_id) AS events, count(DISTINCT c.event_id) AS events_with_contests, count(DISTINCT p.event_id) AS events_with_placements, count(DISTINCT p.placement_id) AS placements
FROM {EVENTS} v LEFT JOIN contests c USING (event_id) LEFT JOIN placements p ON p.contest_id = c.contest_id GROUP BY 1
""")
def funnel_by_source(spark, d):
    """How far events of each source come: contests are reduced to one row each and placements counted before they meet the events, so that nothing multiplies."""
    v = _once(spark, d, "dance_events", "event_id").select("source", "event_id")
    c = table(spark, d, "contests").select("contest_id", "event_id").distinct()
    p = table(spark, d, "placements").select("contest_id", F.col("event_id").alias("p_event"), "placement_id").distinct()
    j = v.join(c.withColumnRenamed("event_id", "c_event"), F.col("event_id") == F.col("c_event"), "left").join(p, "contest_id", "left")
    return j.groupBy("source").agg(F.countDistinct("event_id").alias("events"), F.countDistinct("c_event").alias("events_with_contests"), F.countDistinct("p_event").alias("events_with_placements"), F.countDistinct("placement_id").alias("placements"))


@query(f"""SELECT p.source, v."year", count(DISTINCT p.event_id) AS events, count(*) AS placements FROM {PLACEMENTS} p JOIN {EVENTS} v USING (event_id) GROUP BY 1, 2""")
def results_by_source_year(spark, d):
    """Events and placements per source and year."""
    v = _once(spark, d, "dance_events", "event_id").select("event_id", "year")
    return _once(spark, d, "placements", "placement_id").select("source", "event_id").join(v, "event_id").groupBy("source", "year").agg(F.countDistinct("event_id").alias("events"), F.count("*").alias("placements"))


@query(f"""
SELECT source, count(*) AS events, count(*) FILTER (WHERE snapshot_id = 'override') AS placeholders, count(*) FILTER (WHERE city IS NULL OR city = '') AS missing_city, count(*) FILTER (WHERE country IS NULL OR country = '') AS missing_country, count(*) FILTER (WHERE website IS NULL OR website = '') AS missing_website FROM {EVENTS} GROUP BY 1
""")
def event_field_gaps(spark, d):
    """Missing fields of events per source."""
    gap = lambda c: F.count_if(F.col(c).isNull() | (F.col(c) == "")).alias(f"missing_{c}")
    return _once(spark, d, "dance_events", "event_id").groupBy("source").agg(F.count("*").alias("events"), F.count_if(F.col("snapshot_id") == "override").alias("placeholders"), gap("city"), gap("country"), gap("website"))


@query(f"SELECT source, parse_status, contest_type, count(*) AS n FROM {CONTESTS} GROUP BY 1, 2, 3")
def contest_status_matrix(spark, d):
    """Contests by source, status and type."""
    return _once(spark, d, "contests", "contest_id").groupBy("source", "parse_status", "contest_type").agg(F.count("*").alias("n"))


@query(f"SELECT source, link_status, count(*) AS entries, count(wsdc_id) AS with_id, count(*) FILTER (WHERE name_raw IS NULL) AS nameless, count(*) FILTER (WHERE bib IS NULL) AS without_bib FROM {ENTRIES} GROUP BY 1, 2")
def entry_identity_matrix(spark, d):
    """Entries by source and link status, with what they lack."""
    return _once(spark, d, "entries", "entry_id").groupBy("source", "link_status").agg(F.count("*").alias("entries"), F.count("wsdc_id").alias("with_id"), F.count_if(F.col("name_raw").isNull()).alias("nameless"), F.count_if(F.col("bib").isNull()).alias("without_bib"))


@query("""
WITH f AS (SELECT 'removal' AS kind, table_name || ': ' || coalesce(reason, 'no reason') AS summary FROM removals UNION ALL SELECT 'link', 'status ' || link_status FROM entries WHERE link_status <> 'confirmed'
 UNION ALL SELECT 'parse', source || ' ' || parse_status FROM contests WHERE parse_status <> 'parsed' UNION ALL SELECT 'division', event_id FROM contests WHERE division = 'unknown')
SELECT kind, summary, count(*) AS n FROM f GROUP BY 1, 2 ORDER BY n DESC, kind, summary LIMIT 50
""")
def review_summaries(spark, d):
    """The fifty commonest reasons for review; the limit is the report's."""
    row = lambda df, kind, summary: df.select(F.lit(kind).alias("kind"), summary.alias("summary"))
    c = table(spark, d, "contests")
    f = _union([
        row(table(spark, d, "removals"), "removal", F.concat("table_name", F.lit(": "), F.coalesce("reason", F.lit("no reason")))),
        row(table(spark, d, "entries").filter("link_status <> 'confirmed'"), "link", F.concat(F.lit("status "), "link_status")),
        row(c.filter("parse_status <> 'parsed'"), "parse", F.concat_ws(" ", "source", "parse_status")), row(c.filter("division = 'unknown'"), "division", F.col("event_id")),
    ])
    return f.groupBy("kind", "summary").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind", "summary").limit(50)


@query(f"""
SELECT source, count(*) AS placements, count(*) FILTER (WHERE registry_confirmed) AS confirmed, count(*) FILTER (WHERE registry_points_leader IS NOT NULL OR registry_points_follower IS NOT NULL) AS with_points,
 count(*) FILTER (WHERE points_matches_expected) AS as_expected, count(*) FILTER (WHERE NOT points_matches_expected) AS unexpected, count(*) FILTER (WHERE points_matches_expected IS NULL) AS unchecked FROM {PLACEMENTS} GROUP BY 1
""")
def point_summary(spark, d):
    """Registry points of placements per source; a check that was not made counts apart."""
    p, ok = _once(spark, d, "placements", "placement_id"), F.col("points_matches_expected")
    return p.groupBy("source").agg(
        F.count("*").alias("placements"), F.count_if("registry_confirmed").alias("confirmed"), F.count_if(F.col("registry_points_leader").isNotNull() | F.col("registry_points_follower").isNotNull()).alias("with_points"),
        F.count_if(ok).alias("as_expected"), F.count_if(~ok).alias("unexpected"), F.count_if(ok.isNull()).alias("unchecked"),
    )


@query(f"""
SELECT source, count(*) AS groups, sum(n - 1) AS excess FROM (SELECT source, contest_id, role, name_norm, count(*) AS n FROM {ENTRIES} WHERE name_norm <> '' GROUP BY 1, 2, 3, 4 HAVING count(*) > 1) GROUP BY 1
""")
def natural_duplicates(spark, d):
    """Entries that agree in contest, role and name under different bibs: groups and rows too many, per source."""
    g = _once(spark, d, "entries", "entry_id").filter("name_norm <> ''").groupBy("source", "contest_id", "role", "name_norm").agg(F.count("*").alias("n")).filter("n > 1")
    return g.groupBy("source").agg(F.count("*").alias("groups"), F.sum(F.col("n") - 1).alias("excess"))


@query(f"""
WITH n AS (SELECT source, name_raw FROM {ENTRIES} UNION ALL SELECT source, name_raw FROM judges)
SELECT source, count(*) FILTER (WHERE regexp_matches(coalesce(name_raw, ''), '\\*{{3,}}|^(?i:unknown|tbd)$')) AS placeholders, count(*) FILTER (WHERE trim(coalesce(name_raw, '')) = '') AS blank FROM n GROUP BY 1
""")
def placeholder_names(spark, d):
    """Names that are none, per source."""
    n = _once(spark, d, "entries", "entry_id").select("source", "name_raw").unionByName(table(spark, d, "judges").select("source", "name_raw"))
    return n.groupBy("source").agg(F.count_if(F.coalesce("name_raw", F.lit("")).rlike(r"\*{3,}|^(?i:unknown|tbd)$")).alias("placeholders"), F.count_if(F.trim(F.coalesce("name_raw", F.lit(""))) == "").alias("blank"))


@query(f"""
SELECT CASE WHEN start_date > DATE '2024-06-01' THEN 'future' WHEN end_date < DATE '2024-06-01' THEN 'past' ELSE 'current' END AS period, count(*) AS events,
 count(*) FILTER (WHERE event_id IN (SELECT event_id FROM contests)) AS with_contests, count(*) FILTER (WHERE event_id IN (SELECT event_id FROM placements)) AS with_placements FROM {EVENTS} GROUP BY 1
""")
def event_time_coverage(spark, d):
    """Events by time against a given day, and how many have contests and placements: left joins to the distinct keys."""
    day = F.lit("2024-06-01").cast("date")
    v = _once(spark, d, "dance_events", "event_id").select("event_id", F.when(F.col("start_date") > day, "future").when(F.col("end_date") < day, "past").otherwise("current").alias("period"))
    for t in ("contests", "placements"):
        v = v.join(table(spark, d, t).select("event_id").distinct().withColumn(f"with_{t}", F.lit(True)), "event_id", "left")
    return v.groupBy("period").agg(F.count("*").alias("events"), F.count("with_contests").alias("with_contests"), F.count("with_placements").alias("with_placements"))


_KEYS = {"entries": "entry_id", "contests": "contest_id", "placements": "placement_id", "dance_events": "event_id", "dancers": "wsdc_id", "judges": "judge_id"}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT {k}) AS n_keys, count(*) - count(DISTINCT {k}) AS repeats FROM {t}" for t, k in _KEYS.items()))
def row_counts(spark, d):
    """Rows, keys and repeats of every table, to hold against a manifest."""
    return _union([table(spark, d, t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n_rows"), F.countDistinct(k).alias("n_keys"), (F.count("*") - F.countDistinct(k)).alias("repeats")) for t, k in _KEYS.items()])


_LINK_ROW = "concat_ws(chr(31), coalesce(CAST(wsdc_id AS VARCHAR), '-'), coalesce(method, '-'), coalesce(status, '-'), coalesce(acceptance_state, '-'))"


@query(f"""
WITH k AS (SELECT release_no, record_key, list_sort(list({_LINK_ROW})) AS rows_of FROM link_snapshots WHERE record_key IS NOT NULL GROUP BY 1, 2)
SELECT coalesce(a.release_no + 1, b.release_no) AS release_no, count(*) FILTER (WHERE a.record_key IS NULL) AS added, count(*) FILTER (WHERE b.record_key IS NULL) AS removed, count(*) FILTER (WHERE a.rows_of <> b.rows_of) AS changed
FROM (SELECT * FROM k WHERE release_no < (SELECT max(release_no) FROM k)) a FULL JOIN (SELECT * FROM k WHERE release_no > (SELECT min(release_no) FROM k)) b ON a.record_key = b.record_key AND a.release_no + 1 = b.release_no GROUP BY 1
""")
def keyed_digests(spark, d):
    """Keys per release that came, went or hold other rows, by a digest of each key's rows that ignores their order and counts repeats.

    Sums of two row hashes merge before the shuffle; no key's rows are gathered.
    """
    s = table(spark, d, "link_snapshots").filter("record_key is not null")
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("wsdc_id", "method", "status", "acceptance_state")]
    h = F.xxhash64(*fields).cast("decimal(38,0)"), F.xxhash64(F.lit(1), *fields).cast("decimal(38,0)")
    k = s.groupBy("release_no", "record_key").agg(F.struct(F.sum(h[0]).alias("a"), F.sum(h[1]).alias("b"), F.count("*").alias("n")).alias("digest"))
    ends = k.agg(F.min("release_no").alias("lo"), F.max("release_no").alias("hi"))
    old = k.join(F.broadcast(ends)).filter("release_no < hi").select((F.col("release_no") + 1).alias("release_no"), "record_key", F.col("digest").alias("old"))
    new = k.join(F.broadcast(ends)).filter("release_no > lo").select("release_no", "record_key", F.col("digest").alias("new"))
    j = old.join(new, ["release_no", "record_key"], "full_outer")
    return j.groupBy("release_no").agg(F.count_if(F.col("old").isNull()).alias("added"), F.count_if(F.col("new").isNull()).alias("removed"), F.count_if(F.col("old") != F.col("new")).alias("changed"))


_COMPARED = ["name", "city", "country", "website", "wsdc_status"]


@query(f"""
WITH m AS (SELECT trim(lower(event_id)) AS k, {', '.join(f'max({c}) AS {c}' for c in _COMPARED)} FROM event_mirror GROUP BY 1), v AS (SELECT trim(lower(event_id)) AS k, {', '.join(_COMPARED)} FROM {EVENTS}),
j AS (SELECT v.k AS vk, m.k AS mk, {', '.join(f'v.{c} AS v_{c}, m.{c} AS m_{c}' for c in _COMPARED)} FROM v FULL JOIN m ON v.k = m.k)
SELECT '(only here)' AS field, count(*) FILTER (WHERE mk IS NULL) AS n FROM j UNION ALL SELECT '(only there)', count(*) FILTER (WHERE vk IS NULL) FROM j
{' '.join(f"UNION ALL SELECT '{c}', count(*) FILTER (WHERE vk IS NOT NULL AND mk IS NOT NULL AND v_{c} IS DISTINCT FROM m_{c}) FROM j" for c in _COMPARED)}
""")
def keyed_compare(spark, d):
    """Two copies of a table compared by key: rows on one side only, and per column how many differ as printed. One full outer join, one pass of counts."""
    key = F.trim(F.lower("event_id")).alias("k")
    v = _once(spark, d, "dance_events", "event_id").select(key, F.struct(*_COMPARED).alias("v"))
    m = table(spark, d, "event_mirror").groupBy(key).agg(F.struct(*[F.max(c).alias(c) for c in _COMPARED]).alias("m"))
    both = F.col("v").isNotNull() & F.col("m").isNotNull()
    counts = {"(only here)": F.count_if(F.col("m").isNull()), "(only there)": F.count_if(F.col("v").isNull())} | {c: F.count_if(both & ~F.col(f"v.{c}").eqNullSafe(F.col(f"m.{c}"))) for c in _COMPARED}
    return v.join(m, "k", "full_outer").agg(*[n.alias(c) for c, n in counts.items()]).unpivot([], list(counts), "field", "n")


_PROFILED = {
    "entries": ["entry_id", "contest_id", "event_id", "role", "bib", "name_raw", "name_norm", "partner_name_raw", "city_raw", "country_raw", "wsdc_id", "link_status", "link_confidence", "partner_entry_id", "best_round"],
    "contests": ["contest_id", "event_id", "name_raw", "division", "age_division", "contest_type", "partner_mode", "dance_style", "parse_status", "source_contest_ref"],
    "judges": ["judge_id", "event_id", "name_raw", "initials", "wsdc_id"], "dance_events": ["event_id", "series_id", "name", "start_date", "end_date", "city", "region", "country", "website", "wsdc_status"],
    "registry_placements": ["wsdc_id", "role", "dance_style", "division", "series_id", "series_name_raw", "event_month", "event_id", "result", "points"],
}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) = '') AS blanks FROM {t}" for t, cs in _PROFILED.items() for c in cs))
def completeness_profile(spark, d):
    """Nulls and blanks of every listed column; one pass a table, unpivoted after the aggregation."""
    def profile(t: str, cs: list[str]) -> DataFrame:
        cell = lambda c: F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_if(F.trim(F.col(c).cast("string")) == "").alias("blanks"))
        out = table(spark, d, t).agg(F.count("*").alias("n_rows"), F.array(*[cell(c) for c in cs]).alias("cells"))
        return out.select(F.lit(t).alias("table_name"), "n_rows", F.explode("cells").alias("c")).select("table_name", "c.column_name", "n_rows", "c.nulls", "c.blanks")

    return _union([profile(t, cs) for t, cs in _PROFILED.items()])


@query("""
SELECT scope_kind, source, via, count(*) AS n, sum(CASE WHEN scope_status = 'current' THEN 1 ELSE 0 END) AS is_current, sum(CASE WHEN acquired_units < discovered_units THEN 1 ELSE 0 END) AS behind, sum(CASE WHEN withheld_units > 0 THEN 1 ELSE 0 END) AS withheld FROM coverage GROUP BY 1, 2, 3
""")
def watch_coverage(spark, d):
    """Scopes per kind, source and transport by sums of conditions."""
    one = lambda c: F.sum(F.when(F.expr(c), 1).otherwise(0))
    return table(spark, d, "coverage").groupBy("scope_kind", "source", "via").agg(F.count("*").alias("n"), one("scope_status = 'current'").alias("is_current"), one("acquired_units < discovered_units").alias("behind"), one("withheld_units > 0").alias("withheld"))


@query("""
WITH l AS (SELECT scope_kind, scope_id, max(last_changed_at) AS t FROM coverage GROUP BY 1, 2)
SELECT l.scope_kind, c.scope_status, count(*) AS n, min(c.last_changed_at) AS oldest FROM l JOIN (SELECT scope_kind, scope_id, last_changed_at, max(scope_status) AS scope_status FROM coverage GROUP BY 1, 2, 3) c ON c.scope_kind = l.scope_kind AND c.scope_id = l.scope_id AND c.last_changed_at = l.t GROUP BY 1, 2
""")
def latest_health(spark, d):
    """The status of each scope's latest row (ties: the greater status), counted: max_by with partial maxima instead of a ranked window."""
    latest = table(spark, d, "coverage").filter("last_changed_at is not null").groupBy("scope_kind", "scope_id").agg(F.max(F.struct("last_changed_at", "scope_status")).alias("m"))
    return latest.groupBy("scope_kind", "m.scope_status").agg(F.count("*").alias("n"), F.min("m.last_changed_at").alias("oldest"))


@query("""
SELECT CASE WHEN source LIKE 'event%' THEN 'site' WHEN source LIKE '%journal%' OR source LIKE '%note%' THEN 'operations' WHEN coalesce(source, '') = '' THEN 'unknown' ELSE 'press' END AS purpose, count(*) AS n, count(DISTINCT coalesce(event_id, '-')) AS n_events FROM documents GROUP BY 1
""")
def purpose_buckets(spark, d):
    """Documents by purpose, told by how their source begins or what it holds."""
    s = F.col("source")
    purpose = F.when(s.startswith("event"), "site").when(s.contains("journal") | s.contains("note"), "operations").when(F.coalesce(s, F.lit("")) == "", "unknown").otherwise("press")
    return table(spark, d, "documents").groupBy(purpose.alias("purpose")).agg(F.count("*").alias("n"), F.countDistinct(F.coalesce("event_id", F.lit("-"))).alias("n_events"))


@query(f"""
SELECT entry_id, row_number() OVER (PARTITION BY contest_id ORDER BY CAST(nullif(regexp_extract(entry_id, '-([0-9]+)$', 1), '') AS BIGINT) NULLS LAST, entry_id) AS position FROM {ENTRIES}
""")
def numeric_suffix_order(spark, d):
    """Entries of a contest in the order of the number their id ends in: 9 before 10."""
    n = F.nullif(F.regexp_extract("entry_id", "-([0-9]+)$", 1), F.lit("")).cast("long")
    return _once(spark, d, "entries", "entry_id").select("entry_id", F.row_number().over(Window.partitionBy("contest_id").orderBy(n.asc_nulls_last(), "entry_id")).alias("position"))


@query(f"""
SELECT source, count(*) AS n, sum(CASE WHEN NOT EXISTS (SELECT 1 FROM contests c WHERE c.contest_id = e.contest_id) THEN 1 ELSE 0 END) AS unmapped FROM {ENTRIES} e GROUP BY 1
""")
def unmapped_by_source(spark, d):
    """Entries per source whose contest is unknown."""
    c = table(spark, d, "contests").select("contest_id").distinct().withColumn("there", F.lit(True))
    return _once(spark, d, "entries", "entry_id").join(c, "contest_id", "left").groupBy("source").agg(F.count("*").alias("n"), F.sum(F.when(F.col("there").isNull(), 1).otherwise(0)).alias("unmapped"))


@query(f"""
SELECT v.event_id, (SELECT max(last_seen_at) FROM contests c WHERE c.event_id = v.event_id) AS last_parse, (SELECT c.contest_id FROM contests c WHERE c.event_id = v.event_id ORDER BY last_seen_at DESC NULLS LAST, contest_id DESC LIMIT 1) AS latest_contest FROM {EVENTS} v
""")
def latest_parse(spark, d):
    """The latest parsed contest of each event, null where none is: one max before the join instead of a query per row."""
    latest = table(spark, d, "contests").groupBy("event_id").agg(F.max(F.struct("last_seen_at", "contest_id")).alias("m"))
    return _once(spark, d, "dance_events", "event_id").select("event_id").join(latest, "event_id", "left").select("event_id", F.col("m.last_seen_at").alias("last_parse"), F.col("m.contest_id").alias("latest_contest"))


@query("""
WITH r AS (SELECT contest_id, source, parse_status, row_number() OVER (PARTITION BY contest_id ORDER BY last_seen_at DESC NULLS LAST, run_id DESC NULLS LAST) AS k FROM contests)
SELECT contest_id, source, parse_status FROM r WHERE k = 1 AND parse_status <> 'parsed' AND lower(contest_id) NOT IN (SELECT lower(trim(record_key)) FROM removals WHERE table_name = 'contests' AND record_key IS NOT NULL)
""")
def parser_failures(spark, d):
    """Contests whose latest reading failed and that were not removed."""
    gone = table(spark, d, "removals").filter("table_name = 'contests' and record_key is not null").select(F.lower(F.trim("record_key")).alias("k")).distinct()
    c = _once(spark, d, "contests", "contest_id").filter("parse_status <> 'parsed'").withColumn("k", F.lower("contest_id"))
    return c.join(gone, "k", "left_anti").select("contest_id", "source", "parse_status")


@query(f"""
WITH m AS (SELECT trim(lower(event_id)) AS k, max(name) AS name FROM event_mirror GROUP BY 1),
t AS (SELECT v.event_id, list_distinct([x FOR x IN regexp_split_to_array(lower(v.name), '[^a-z0-9]+') IF x <> '' AND NOT regexp_matches(x, '^[0-9]{{4}}$')]) AS a, list_distinct([x FOR x IN regexp_split_to_array(lower(m.name), '[^a-z0-9]+') IF x <> '' AND NOT regexp_matches(x, '^[0-9]{{4}}$')]) AS b FROM {EVENTS} v JOIN m ON m.k = lower(trim(v.event_id)))
SELECT event_id, len(list_intersect(a, b)) AS shared, len(a) AS n_here, len(b) AS n_there FROM t WHERE a IS NOT NULL AND b IS NOT NULL
""")
def name_token_overlap(spark, d):
    """Words that an event's name and its copy's share, years left out."""
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda x: (x != "") & ~x.rlike("^[0-9]{4}$")))
    m = table(spark, d, "event_mirror").groupBy(F.trim(F.lower("event_id")).alias("k")).agg(F.max("name").alias("other"))
    v = _once(spark, d, "dance_events", "event_id").select("event_id", F.lower(F.trim("event_id")).alias("k"), "name")
    t = v.join(m, "k").select("event_id", words(F.col("name")).alias("a"), words(F.col("other")).alias("b")).filter("a is not null and b is not null")
    return t.select("event_id", F.size(F.array_intersect("a", "b")).alias("shared"), F.size("a").alias("n_here"), F.size("b").alias("n_there"))


@query("""
SELECT CAST(date_part('year', event_month) AS INTEGER) AS y, count(*) AS n, sum(CASE WHEN event_id IS NULL THEN 1 ELSE 0 END) AS unmapped, count(DISTINCT CASE WHEN event_id IS NOT NULL THEN series_id END) AS mapped_series, count(DISTINCT CASE WHEN event_id IS NULL THEN series_id END) AS unmapped_series FROM registry_placements WHERE event_month IS NOT NULL GROUP BY 1
""")
def mapping_by_year(spark, d):
    """Registry rows per year with and without an event, and the series they concern."""
    r, none = table(spark, d, "registry_placements").filter("event_month is not null"), F.col("event_id").isNull()
    return r.groupBy(F.year("event_month").alias("y")).agg(F.count("*").alias("n"), F.sum(F.when(none, 1).otherwise(0)).alias("unmapped"), F.countDistinct(F.when(~none, F.col("series_id"))).alias("mapped_series"), F.countDistinct(F.when(none, F.col("series_id"))).alias("unmapped_series"))


@query("""
SELECT series_id, event_month, division, count(*) AS n, min(series_name_raw) AS example FROM registry_placements WHERE event_id IS NULL GROUP BY 1, 2, 3
""")
def unmapped_occurrences(spark, d):
    """Occurrences that no event stands for, with an example of their printed name."""
    return table(spark, d, "registry_placements").filter("event_id is null").groupBy("series_id", "event_month", "division").agg(F.count("*").alias("n"), F.min("series_name_raw").alias("example"))


def count_by(df: DataFrame, *fields: str) -> DataFrame:
    """Rows per combination of any fields."""
    return df.groupBy(*fields).agg(F.count("*").alias("n"))


def safe_ratio(a, b):
    """A share to six decimals, null where there is nothing to share."""
    return F.round(F.try_divide(a.cast("double"), b.cast("double")), 6)


@query("SELECT source, anonymous, initials IS NULL AS no_initials, count(*) AS n FROM judges GROUP BY 1, 2, 3")
def judge_counts(spark, d):
    """Judges by source, anonymity and initials."""
    return count_by(table(spark, d, "judges").withColumn("no_initials", F.col("initials").isNull()), "source", "anonymous", "no_initials")


@query("""
SELECT source, round(CAST(sum(mapped_units) AS DOUBLE) / nullif(CAST(sum(interpreted_units) AS DOUBLE), 0), 6) AS mapped_share, round(CAST(sum(withheld_units) AS DOUBLE) / nullif(CAST(sum(mapped_units) AS DOUBLE), 0), 6) AS withheld_share FROM coverage GROUP BY 1
""")
def coverage_ratios(spark, d):
    """Shares of units per source; no units give null."""
    return table(spark, d, "coverage").groupBy("source").agg(safe_ratio(F.sum("mapped_units"), F.sum("interpreted_units")).alias("mapped_share"), safe_ratio(F.sum("withheld_units"), F.sum("mapped_units")).alias("withheld_share"))


_SHEET = f"""WITH w AS (SELECT wsdc_id, min(name_norm) AS name_norm FROM dancers GROUP BY 1),
r AS (SELECT DISTINCT r.wsdc_id, r.event_id, r.role, r.division, r.result, w.name_norm FROM registry_placements r JOIN w USING (wsdc_id) WHERE r.event_id IS NOT NULL),
e AS (SELECT e.entry_id, e.event_id, e.name_norm, e.best_round, c.division, CASE WHEN e.entry_id LIKE '%/L-%' THEN 'leader' WHEN e.entry_id LIKE '%/F-%' THEN 'follower' END AS role FROM {ENTRIES} e JOIN {CONTESTS} c USING (contest_id)),
p AS (SELECT leader_entry_id AS entry_id, place FROM {PLACEMENTS} UNION ALL SELECT follower_entry_id, place FROM {PLACEMENTS}),
j AS (SELECT r.wsdc_id, r.event_id, r.role, r.division, r.result, e.entry_id, e.best_round FROM r JOIN e ON e.event_id = r.event_id AND e.role = r.role AND e.division = r.division AND e.name_norm = r.name_norm)"""


def _sheet_matches(spark, d):
    """Registry rows with the entries of their event, role, division and exact name."""
    w = table(spark, d, "dancers").groupBy("wsdc_id").agg(F.min("name_norm").alias("name_norm"))
    r = table(spark, d, "registry_placements").filter("event_id is not null").select("wsdc_id", "event_id", "role", "division", "result").distinct().join(w, "wsdc_id")
    c = _once(spark, d, "contests", "contest_id").select("contest_id", "division")
    role = F.when(F.col("entry_id").contains("/L-"), "leader").when(F.col("entry_id").contains("/F-"), "follower")
    e = _once(spark, d, "entries", "entry_id").select("entry_id", "event_id", "contest_id", "name_norm", "best_round", role.alias("role")).join(c, "contest_id").drop("contest_id")
    return r, r.join(e, ["event_id", "role", "division", "name_norm"])


@query(f"""{_SHEET} SELECT r.wsdc_id, r.event_id, r.role, r.division, r.result, count(DISTINCT j.entry_id) AS n_entries, CASE count(DISTINCT j.entry_id) WHEN 0 THEN 'absent' WHEN 1 THEN 'matched' ELSE 'ambiguous' END AS status
FROM r LEFT JOIN j ON j.wsdc_id = r.wsdc_id AND j.event_id = r.event_id AND j.role = r.role AND j.division = r.division AND j.result IS NOT DISTINCT FROM r.result WHERE r.role IS NOT NULL AND r.division IS NOT NULL GROUP BY 1, 2, 3, 4, 5""")
def sheet_correspondence(spark, d):
    """Registry rows on the score sheets: absent, matched by one entry, or ambiguous. Ambiguity stays in sight."""
    r, j = _sheet_matches(spark, d)
    n = j.groupBy("wsdc_id", "event_id", "role", "division", F.coalesce("result", F.lit("")).alias("k")).agg(F.countDistinct("entry_id").alias("n"))
    out = r.filter("role is not null and division is not null").withColumn("k", F.coalesce("result", F.lit(""))).join(n, ["wsdc_id", "event_id", "role", "division", "k"], "left")
    n_entries = F.coalesce("n", F.lit(0))
    return out.select("wsdc_id", "event_id", "role", "division", "result", n_entries.alias("n_entries"), F.when(n_entries == 0, "absent").when(n_entries == 1, "matched").otherwise("ambiguous").alias("status"))


@query(f"""{_SHEET}, a AS (SELECT j.wsdc_id, j.event_id, j.role, j.division, j.result, count(DISTINCT p.place) AS n_places, min(p.place) AS place, bool_or(coalesce(j.best_round = 'final', FALSE)) AS final FROM j LEFT JOIN p ON p.entry_id = j.entry_id GROUP BY 1, 2, 3, 4, 5)
SELECT CASE WHEN n_places > 1 THEN 'conflicting_evidence' WHEN n_places = 0 AND NOT final THEN 'insufficient_evidence' WHEN n_places = 1 AND result = 'F' THEN CASE WHEN place > 5 THEN 'agrees' ELSE 'disagrees' END WHEN n_places = 1 AND CAST(place AS VARCHAR) = result THEN 'agrees' WHEN n_places = 1 THEN 'disagrees' WHEN result = 'F' THEN 'agrees' ELSE 'insufficient_evidence' END AS status, count(*) AS n FROM a WHERE result IS NOT NULL GROUP BY 1""")
def agreement_status(spark, d):
    """Whether the registry's result and the sheet's place agree; what is missing is never filled in."""
    _, j = _sheet_matches(spark, d)
    p = _once(spark, d, "placements", "placement_id")
    places = p.select(F.col("leader_entry_id").alias("entry_id"), "place").unionByName(p.select(F.col("follower_entry_id").alias("entry_id"), "place"))
    a = j.filter("result is not null").join(places, "entry_id", "left").groupBy("wsdc_id", "event_id", "role", "division", "result").agg(F.countDistinct("place").alias("n"), F.min("place").alias("place"), F.max(F.coalesce(F.col("best_round") == "final", F.lit(False))).alias("final"))
    one, f = F.col("n") == 1, F.col("result") == "F"
    status = (
        F.when(F.col("n") > 1, "conflicting_evidence").when((F.col("n") == 0) & ~F.col("final"), "insufficient_evidence").when(one & f, F.when(F.col("place") > 5, "agrees").otherwise("disagrees"))
        .when(one, F.when(F.col("place").cast("string") == F.col("result"), "agrees").otherwise("disagrees")).when(f, "agrees").otherwise("insufficient_evidence")
    )
    return a.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query(f"""
WITH p AS (SELECT DISTINCT leader_entry_id AS entry_id FROM placements UNION SELECT follower_entry_id FROM placements UNION SELECT couple_entry_id FROM placements),
e AS (SELECT e.entry_id, e.contest_id IN (SELECT contest_id FROM contests) AS contest, e.event_id IN (SELECT event_id FROM dance_events) AS event, e.entry_id IN (SELECT entry_id FROM p WHERE entry_id IS NOT NULL) AS place, coalesce(e.wsdc_id IN (SELECT wsdc_id FROM dancers), FALSE) AS dancer, lower(e.entry_id) IN (SELECT lower(trim(record_key)) FROM removals WHERE table_name = 'entries' AND record_key IS NOT NULL) AS removed FROM {ENTRIES} e)
SELECT contest, event, place, dancer, removed, count(*) AS n FROM e GROUP BY ALL
""")
def evidence_depth(spark, d):
    """What other tables know of each entry, as flags, and how many entries share them."""
    e = _once(spark, d, "entries", "entry_id").select("entry_id", "contest_id", "event_id", "wsdc_id", F.lower("entry_id").alias("k"))
    p = table(spark, d, "placements").select(F.explode(F.array("leader_entry_id", "follower_entry_id", "couple_entry_id")).alias("entry_id"))
    gone = table(spark, d, "removals").filter("table_name = 'entries'").select(F.lower(F.trim("record_key")).alias("k"))
    flags = {"contest": ("contest_id", table(spark, d, "contests")), "event": ("event_id", table(spark, d, "dance_events")), "place": ("entry_id", p), "dancer": ("wsdc_id", table(spark, d, "dancers")), "removed": ("k", gone)}
    for flag, (key, other) in flags.items():
        e = e.join(other.select(key).distinct().withColumn(flag, F.lit(True)), key, "left")
    known = {f: F.coalesce(f, F.lit(False)).alias(f) for f in flags}
    return e.groupBy(*known.values()).agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT release_no, lower(trim(record_key)) AS k, max(CASE WHEN status = 'confirmed' THEN 1 ELSE 0 END) AS ok FROM link_snapshots WHERE record_key IS NOT NULL GROUP BY 1, 2), b AS (SELECT min(release_no) AS lo, max(release_no) AS hi FROM s),
o AS (SELECT k, ok FROM s, b WHERE release_no = lo), n AS (SELECT k, ok FROM s, b WHERE release_no = hi)
SELECT CASE WHEN o.ok = 0 AND n.ok = 1 THEN 'gained' WHEN o.ok = 1 AND n.ok = 0 THEN 'lost' WHEN o.ok = 1 THEN 'kept' ELSE 'neither' END AS outcome, count(*) AS n FROM o JOIN n USING (k) GROUP BY 1
""")
def baseline_outcomes(spark, d):
    """Confirmed links gained and lost since the first release, on the keys both have. Two releases are the comparison's ends, found in the data."""
    s = table(spark, d, "link_snapshots").filter("record_key is not null").groupBy("release_no", F.lower(F.trim("record_key")).alias("k")).agg(F.max(F.when(F.col("status") == "confirmed", 1).otherwise(0)).alias("ok"))
    ends = table(spark, d, "link_snapshots").agg(F.min("release_no").alias("lo"), F.max("release_no").alias("hi"))
    both = s.join(F.broadcast(ends)).groupBy("k").agg(F.max(F.when(F.col("release_no") == F.col("lo"), F.col("ok"))).alias("o"), F.max(F.when(F.col("release_no") == F.col("hi"), F.col("ok"))).alias("n")).filter("o is not null and n is not null")
    outcome = F.when(F.expr("o = 0 and n = 1"), "gained").when(F.expr("o = 1 and n = 0"), "lost").when(F.col("o") == 1, "kept").otherwise("neither")
    return both.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


queries, oracle_sql = query.queries, query.oracle_sql
