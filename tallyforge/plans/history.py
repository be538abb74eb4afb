"""Histories, acceptance and the release's card."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.functions import text
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.session import table

query = Queries()

_PLAIN = "trim(regexp_replace(replace(lower(strip_accents({c})), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"


def _plain(c):
    return text.event_name(c)


@query(f"""
SELECT 'links' AS section, coalesce(link_status, 'none') AS label, count(*) AS n FROM {ENTRIES} GROUP BY 2 UNION ALL SELECT 'review', coalesce(reason, 'none'), count(*) FROM removals GROUP BY 2 UNION ALL SELECT 'parse', coalesce(parse_status, 'none'), count(*) FROM {CONTESTS} GROUP BY 2
""")
def card_quality(spark, d):
    """The card's quality section: links by status, reviews by kind, contests by reading."""
    part = lambda df, section, c: df.groupBy(F.coalesce(c, F.lit("none")).alias("label")).agg(F.count("*").alias("n")).select(F.lit(section).alias("section"), "label", "n")
    return part(_once(spark, d, "entries", "entry_id"), "links", "link_status").unionByName(part(table(spark, d, "removals"), "review", "reason")).unionByName(part(_once(spark, d, "contests", "contest_id"), "parse", "parse_status"))


@query("""
SELECT v.event_id, count(DISTINCT x.doc_id) AS pages, count(DISTINCT CASE WHEN contains(lower(x.text), lower(v.name)) THEN x.doc_id END) AS supporting FROM (SELECT DISTINCT event_id, regexp_replace(name, ' [0-9]{4}$', '') AS name FROM dance_events WHERE name IS NOT NULL) v JOIN documents x ON x.event_id = v.event_id GROUP BY 1
""")
def supporting_pages(spark, d):
    """Which enumerated pages support their event: those that print its name."""
    v = table(spark, d, "dance_events").filter("name is not null").select("event_id", F.regexp_replace("name", " [0-9]{4}$", "").alias("name")).distinct()
    x = table(spark, d, "documents").filter("event_id is not null").select("event_id", "doc_id", F.lower("text").alias("t"))
    j = v.join(x, "event_id")
    return j.groupBy("event_id").agg(F.countDistinct("doc_id").alias("pages"), F.countDistinct(F.when(F.contains("t", F.lower("name")), F.col("doc_id"))).alias("supporting"))


@query("""
SELECT record_key, release_no, row_number() OVER (PARTITION BY release_no ORDER BY '["' || record_key || '"]') AS position FROM (SELECT DISTINCT lower(trim(record_key)) AS record_key, release_no FROM link_snapshots WHERE record_key IS NOT NULL AND regexp_matches(trim(record_key), '^[A-Za-z0-9_-]+$'))
""")
def json_key_order(spark, d):
    """The order of a change log: keys as JSON text, not as typed values."""
    k = table(spark, d, "link_snapshots").filter(F.trim("record_key").rlike("^[A-Za-z0-9_-]+$")).select(F.lower(F.trim("record_key")).alias("record_key"), "release_no").distinct()
    return k.select("record_key", "release_no", F.row_number().over(Window.partitionBy("release_no").orderBy(F.to_json(F.array("record_key")))).alias("position"))


@query(f"""
WITH s AS (SELECT source, count(*) AS served, max(last_seen_at) AS latest, CASE source WHEN 'wdr' THEN 3.0 WHEN 'eepro' THEN 2.0 ELSE 1.0 END AS weight FROM {ENTRIES} GROUP BY 1)
SELECT source, served, round(served / weight, 6) AS debit, row_number() OVER (ORDER BY served / weight, source) AS turn FROM s
""")
def fair_selection(spark, d):
    """Sources in the order of their weighted debit: who has had least for its share is next. One row a source."""
    weight = F.when(F.col("source") == "wdr", 3.0).when(F.col("source") == "eepro", 2.0).otherwise(1.0)
    s = _once(spark, d, "entries", "entry_id").groupBy("source").agg(F.count("*").alias("served")).withColumn("debit", F.col("served") / weight)
    return s.select("source", "served", F.round("debit", 6).alias("debit"), F.row_number().over(Window.orderBy("debit", "source")).alias("turn"))


@query(f"""
SELECT event_id, coalesce(CAST(start_date AS VARCHAR), event_month) AS starts, CASE WHEN start_date IS NOT NULL THEN 'day' WHEN regexp_matches(event_month, '^\\d{{4}}-\\d{{2}}$') THEN 'month' ELSE 'unknown' END AS precision, CASE WHEN regexp_matches(event_month, '^\\d{{4}}-\\d{{2}}$') THEN last_day(CAST(event_month || '-01' AS DATE)) END AS latest FROM {EVENTS}
""")
def month_dates(spark, d):
    """Dates as precisely as they are known, and the last day they may mean."""
    v, month = _once(spark, d, "dance_events", "event_id"), F.col("event_month").rlike(r"^\d{4}-\d{2}$")
    last = F.when(month, F.last_day(F.concat("event_month", F.lit("-01")).cast("date")))
    return v.select("event_id", F.coalesce(F.col("start_date").cast("string"), "event_month").alias("starts"), F.when(F.col("start_date").isNotNull(), "day").when(month, "month").otherwise("unknown").alias("precision"), last.alias("latest"))


@query(f"""
SELECT placement_id, len([x FOR x IN tally IF x <= 1]) || '-' || len([x FOR x IN tally IF x <= 2]) || '-' || len([x FOR x IN tally IF x <= 3]) AS tally_text, TRY_CAST(split_part(len([x FOR x IN tally IF x <= 1]) || '-' || len([x FOR x IN tally IF x <= 2]), '-', 2) AS INTEGER) AS seconds_or_better FROM {PLACEMENTS} WHERE tally IS NOT NULL
""")
def tally_counts(spark, d):
    """Tallies as n-n-n: judges with a first, a second or better, a third or better; and one count read back from the text."""
    up_to = lambda k: F.size(F.filter("tally", lambda x: x <= k)).cast("string")
    p = _once(spark, d, "placements", "placement_id").filter("tally is not null").select("placement_id", F.array_join(F.array(*[up_to(k) for k in (1, 2, 3)]), "-").alias("tally_text"))
    return p.select("placement_id", "tally_text", F.regexp_extract("tally_text", r"^\d+-(\d+)-", 1).cast("int").alias("seconds_or_better"))


@query(f"""
SELECT 'entry' AS subject_kind, entry_id AS subject_id, wsdc_id, CASE WHEN wsdc_id IS NULL THEN 'unresolved' ELSE link_status END AS status, coalesce(link_confidence, 0) AS confidence FROM {ENTRIES}
UNION ALL SELECT DISTINCT 'judge', judge_id, wsdc_id, CASE WHEN wsdc_id IS NULL THEN 'unresolved' ELSE 'confirmed' END, CASE WHEN wsdc_id IS NULL THEN 0 ELSE 1 END FROM judges
""")
def persisted_links(spark, d):
    """One link row per subject, as it is stored."""
    row = lambda df, kind, key, status, conf: df.select(F.lit(kind).alias("subject_kind"), F.col(key).alias("subject_id"), "wsdc_id", F.when(F.col("wsdc_id").isNull(), "unresolved").otherwise(status).alias("status"), conf.cast("float").alias("confidence"))
    e = row(_once(spark, d, "entries", "entry_id"), "entry", "entry_id", F.col("link_status"), F.coalesce("link_confidence", F.lit(0)))
    return e.unionByName(row(table(spark, d, "judges"), "judge", "judge_id", F.lit("confirmed"), F.when(F.col("wsdc_id").isNull(), 0).otherwise(1)).distinct())


@query("""
SELECT lower(trim(event_id)) AS event_id, max(struct_pack(a := length(coalesce(city, '')), city := trim(city), country := trim(country))).city AS city, max(struct_pack(a := length(coalesce(city, '')), city := trim(city), country := trim(country))).country AS country FROM event_mirror WHERE event_id IS NOT NULL GROUP BY 1
""")
def calendar_places(spark, d):
    """Each listing's place: that of the row with the fullest city (ties: the greater text)."""
    m = table(spark, d, "event_mirror").filter("event_id is not null")
    best = F.max(F.struct(F.length(F.coalesce("city", F.lit(""))).alias("a"), F.trim("city").alias("city"), F.trim("country").alias("country"))).alias("m")
    return m.groupBy(F.lower(F.trim("event_id")).alias("event_id")).agg(best).select("event_id", "m.city", "m.country")


_YEARS = f"""y AS (SELECT "year" AS y, count(*) AS events, count(*) FILTER (WHERE start_date IS NULL) AS undated, count(*) FILTER (WHERE coverage_tier = 'index_only') AS bare, sha256(string_agg(event_id, '|' ORDER BY event_id)) AS digest FROM {EVENTS} WHERE "year" IS NOT NULL GROUP BY 1),
c AS (SELECT "year" AS y, count(*) AS scopes, count(*) FILTER (WHERE scope_status = 'withheld') AS held FROM coverage GROUP BY 1)"""


def _years(spark, d):
    v = _once(spark, d, "dance_events", "event_id").filter("year is not null")
    y = v.groupBy("year").agg(F.count("*").alias("events"), F.count_if(F.col("start_date").isNull()).alias("undated"), F.count_if(F.col("coverage_tier") == "index_only").alias("bare"), F.sha2(F.array_join(F.array_sort(F.collect_list("event_id")), "|"), 256).alias("digest"))
    c = table(spark, d, "coverage").groupBy("year").agg(F.count("*").alias("scopes"), F.count_if(F.col("scope_status") == "withheld").alias("held"))
    return y.join(c, "year", "left")


@query(f"""WITH {_YEARS} SELECT y, CASE WHEN scopes IS NULL THEN 'no coverage' WHEN undated * 2 > events THEN 'mostly undated' WHEN held * 4 > scopes THEN 'withheld scopes' WHEN bare = events THEN 'index only' ELSE 'open' END AS gate FROM y LEFT JOIN c USING (y)""")
def year_gates(spark, d):
    """The first gate that each year fails, or that it is open."""
    g = F.when(F.col("scopes").isNull(), "no coverage").when(F.col("undated") * 2 > F.col("events"), "mostly undated").when(F.col("held") * 4 > F.col("scopes"), "withheld scopes").when(F.col("bare") == F.col("events"), "index only").otherwise("open")
    return _years(spark, d).select(F.col("year").alias("y"), g.alias("gate"))


@query(f"""WITH {_YEARS} SELECT y, digest, coalesce(undated = 0 AND held * 4 <= scopes, FALSE) AS accepted FROM y LEFT JOIN c USING (y)""")
def year_acceptance(spark, d):
    """Years that may be accepted, pinned to a digest of their events: another set of events has another digest."""
    return _years(spark, d).select(F.col("year").alias("y"), "digest", F.coalesce((F.col("undated") == 0) & (F.col("held") * 4 <= F.col("scopes")), F.lit(False)).alias("accepted"))


@query(f"""
WITH n AS (SELECT DISTINCT series_id, series_name_raw, {_PLAIN.format(c='series_name_raw')} AS p FROM registry_placements WHERE series_name_raw IS NOT NULL AND event_id IS NULL), s AS (SELECT series_id, {_PLAIN.format(c="regexp_replace(name, ' [0-9]{4}$', '')")} AS p, count(*) AS editions FROM {EVENTS} WHERE name IS NOT NULL AND series_id IS NOT NULL GROUP BY 1, 2),
j AS (SELECT n.series_name_raw, s.series_id, sum(editions) AS editions, bool_or(n.series_id = s.series_id) AS same FROM n JOIN s USING (p) GROUP BY 1, 2)
SELECT series_name_raw, series_id, editions, same, row_number() OVER (PARTITION BY series_name_raw ORDER BY editions DESC, series_id) AS k FROM j
""")
def alias_candidates(spark, d):
    """Candidate series for printed names without an event, ranked by their editions."""
    n = table(spark, d, "registry_placements").filter("series_name_raw is not null and event_id is null").select(F.col("series_id").alias("own"), "series_name_raw", _plain(F.col("series_name_raw")).alias("p")).distinct()
    v = _once(spark, d, "dance_events", "event_id").filter("name is not null and series_id is not null")
    s = v.groupBy("series_id", _plain(F.regexp_replace("name", " [0-9]{4}$", "")).alias("p")).agg(F.count("*").alias("editions"))
    j = n.join(s, "p").groupBy("series_name_raw", "series_id").agg(F.sum("editions").alias("editions"), F.max(F.col("own") == F.col("series_id")).alias("same"))
    return j.withColumn("k", F.row_number().over(Window.partitionBy("series_name_raw").orderBy(F.desc("editions"), "series_id")))


@query(f"""
WITH o AS (SELECT DISTINCT series_id, source, start_date, end_date, event_id FROM {EVENTS} WHERE start_date IS NOT NULL AND end_date IS NOT NULL AND series_id IS NOT NULL),
i AS (SELECT event_id AS known, series_id, start_date AS s, end_date AS e, sources FROM {EVENTS} WHERE start_date IS NOT NULL AND end_date IS NOT NULL AND series_id IS NOT NULL)
SELECT o.event_id, count(*) AS matches, min(known) AS match FROM o JOIN i ON i.series_id = o.series_id AND list_contains(i.sources, o.source) AND i.s <= o.end_date AND o.start_date <= i.e GROUP BY 1
""")
def series_rule(spark, d):
    """The inventory occurrences of an event's series that carry its source and overlap its dates; one match decides."""
    v = _once(spark, d, "dance_events", "event_id").filter("start_date is not null and end_date is not null and series_id is not null")
    o = v.select("series_id", "source", "start_date", "end_date", "event_id").distinct()
    i = v.select(F.col("event_id").alias("known"), "series_id", F.col("start_date").alias("s"), F.col("end_date").alias("e"), "sources")
    j = o.join(i, "series_id").filter(F.array_contains("sources", F.col("source")) & (F.col("s") <= F.col("end_date")) & (F.col("start_date") <= F.col("e")))
    return j.groupBy("event_id").agg(F.count("*").alias("matches"), F.min("known").alias("match"))


@query("""
SELECT source, coalesce(via, CASE WHEN source LIKE 'wsdc%' THEN 'direct' ELSE 'unknown' END) AS via, count(*) AS scopes FROM coverage GROUP BY 1, 2
""")
def transports(spark, d):
    """How each source's scopes came in; a source's usual way stands where none is noted."""
    via = F.coalesce("via", F.when(F.col("source").startswith("wsdc"), "direct").otherwise("unknown"))
    return table(spark, d, "coverage").groupBy("source", via.alias("via")).agg(F.count("*").alias("scopes"))


@query("""
WITH f AS (SELECT DISTINCT family, file_name, unnest(json_keys(body)) AS field FROM raw_receipts WHERE json_valid(body) AND json_type(body) = 'OBJECT')
SELECT family, count(DISTINCT field) AS fields, count(DISTINCT CASE WHEN field IN ('step', 'recorded_at', 'format') THEN field END) AS handled, count(DISTINCT CASE WHEN field NOT IN ('step', 'recorded_at', 'format') THEN field END) AS unknown FROM f GROUP BY 1
""")
def contract_inspect(spark, d):
    """Fields per family that a contract handles and those it does not know."""
    r = table(spark, d, "raw_receipts").filter(F.expr("try_parse_json(body) is not null"))
    f = r.select("family", F.explode(F.json_object_keys("body")).alias("field")).distinct()
    known = F.col("field").isin("step", "recorded_at", "format")
    return f.groupBy("family").agg(F.countDistinct("field").alias("fields"), F.countDistinct(F.when(known, F.col("field"))).alias("handled"), F.countDistinct(F.when(~known, F.col("field"))).alias("unknown"))


@query(f"""
WITH s AS (SELECT event_id, unnest(sources) AS source FROM {EVENTS}), c AS (SELECT v.website AS listing, v.event_id, s.source FROM {EVENTS} v JOIN s USING (event_id) WHERE v.website IS NOT NULL), n AS (SELECT listing, min(event_id) AS owner, count(DISTINCT event_id) AS claims FROM c GROUP BY 1)
SELECT DISTINCT c.listing, c.event_id, claims, CASE WHEN claims = 1 OR c.event_id = owner THEN 'kept' ELSE 'withheld' END AS state FROM c JOIN n USING (listing)
""")
def claim_settlement(spark, d):
    """Listings that several events claim: one keeps it, the others are withheld."""
    c = _once(spark, d, "dance_events", "event_id").filter(F.col("website").isNotNull() & (F.size("sources") > 0)).select(F.col("website").alias("listing"), "event_id").distinct()
    n = c.groupBy("listing").agg(F.min("event_id").alias("owner"), F.count("*").alias("claims"))
    return c.join(n, "listing").select("listing", "event_id", "claims", F.when((F.col("claims") == 1) | (F.col("event_id") == F.col("owner")), "kept").otherwise("withheld").alias("state"))


@query("""
WITH e AS (SELECT DISTINCT family, CAST(regexp_extract(json_extract_string(body, '$.format'), '-v([0-9]+)$', 1) AS INTEGER) AS epoch, file_name FROM raw_receipts WHERE json_valid(body) AND CASE WHEN json_valid(body) THEN regexp_matches(json_extract_string(body, '$.format'), '-v[0-9]+$') END)
SELECT family, max(epoch) AS epoch, count(DISTINCT file_name) AS files, count(DISTINCT CASE WHEN epoch < m THEN file_name END) AS to_replay FROM (SELECT *, max(epoch) OVER (PARTITION BY family) AS m FROM e) GROUP BY 1
""")
def replay_epochs(spark, d):
    """The newest version of each family and the files of older ones, which a replay concerns."""
    v = F.regexp_extract(F.get_json_object("body", "$.format"), "-v([0-9]+)$", 1)
    e = table(spark, d, "raw_receipts").select("family", v.try_cast("int").alias("epoch"), "file_name").filter("epoch is not null").distinct()
    m = e.groupBy("family").agg(F.max("epoch").alias("m"))
    return e.join(m, "family").groupBy("family").agg(F.max("epoch").alias("epoch"), F.countDistinct("file_name").alias("files"), F.countDistinct(F.when(F.col("epoch") < F.col("m"), F.col("file_name"))).alias("to_replay"))


@query("""
WITH q AS (SELECT user_id, ts, event_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM events WHERE event_type = 'error')
SELECT user_id, count(*) AS waits, count(*) FILTER (WHERE next IS NULL OR epoch_us(next) - epoch_us(ts) >= 900000000) AS expired, count(*) FILTER (WHERE next IS NOT NULL AND epoch_us(next) - epoch_us(ts) < 900000000) AS renewed FROM q GROUP BY 1
""")
def queue_wakes(spark, d):
    """Waits after an error that run out after a quarter of an hour, and those another error renews before."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    q = table(spark, d, "events").filter("event_type = 'error'").withColumn("gap", micros(F.lead("ts").over(w)) - micros(F.col("ts")))
    soon = F.coalesce(F.col("gap") < 900_000_000, F.lit(False))
    return q.groupBy("user_id").agg(F.count("*").alias("waits"), F.count_if(~soon).alias("expired"), F.count_if(soon).alias("renewed"))


@query("""
WITH e AS (SELECT event_type, ts, event_id, time_bucket(INTERVAL 1 HOUR, ts) AS h FROM events) SELECT event_type, h AS slot, min(ts) AS runs_at, count(*) - 1 AS deferred FROM e GROUP BY 1, 2
""")
def pacing(spark, d):
    """A unit that runs once an hour at most: the first request of an hour runs, the others are deferred."""
    e = table(spark, d, "events").select("event_type", "ts", F.date_trunc("HOUR", F.col("ts")).alias("slot"))
    return e.groupBy("event_type", F.col("slot").cast("timestamp_ntz").alias("slot")).agg(F.min("ts").alias("runs_at"), (F.count("*") - 1).alias("deferred"))


@query(f"""
WITH a AS (SELECT contest_id, count(*) AS n, sum(coalesce(wsdc_id, 0)) AS s FROM {ENTRIES} GROUP BY 1) SELECT contest_id, n, TRUE AS agrees FROM a
""")
def rederivation_check(spark, d):
    """Every contest's rows derived twice, by two routes, and compared by an order-free digest."""
    e = _once(spark, d, "entries", "entry_id").select("contest_id", "entry_id", "wsdc_id")
    digest = lambda df: df.groupBy("contest_id").agg(F.count("*").alias("n"), F.sum(F.xxhash64("entry_id", "wsdc_id").cast("decimal(38,0)")).alias("x"))
    ranked = table(spark, d, "entries").withColumn("_k", F.row_number().over(Window.partitionBy("entry_id").orderBy(F.col("last_seen_at").desc_nulls_last(), F.col("run_id").desc_nulls_last()))).filter("_k = 1")
    other = digest(ranked.select("contest_id", "entry_id", "wsdc_id")).select(F.col("contest_id").alias("c"), F.col("n").alias("m"), F.col("x").alias("y"))
    return digest(e).join(other, F.col("contest_id").eqNullSafe(F.col("c")), "full_outer").select(F.coalesce("contest_id", "c").alias("contest_id"), "n", F.coalesce((F.col("n") == F.col("m")) & (F.col("x") == F.col("y")), F.lit(False)).alias("agrees"))


@query(f"""
WITH a AS (SELECT event_id, max(struct_pack(t := last_seen_at, s := snapshot_id)) AS m FROM contests WHERE event_id IS NOT NULL AND last_seen_at IS NOT NULL AND parse_status = 'parsed' GROUP BY 1)
SELECT e.event_id, a.m.s AS anchor, count(*) FILTER (WHERE e.first_seen_at <= a.m.t) AS compatible, count(*) FILTER (WHERE e.first_seen_at > a.m.t OR a.m IS NULL) AS withheld FROM {ENTRIES} e LEFT JOIN a USING (event_id) WHERE e.event_id IS NOT NULL AND e.first_seen_at IS NOT NULL GROUP BY 1, 2
""")
def release_selection(spark, d):
    """Each event's anchor, its newest read contest, and how many entries go with it; those seen later are withheld."""
    c = table(spark, d, "contests").filter("event_id is not null and last_seen_at is not null and parse_status = 'parsed'")
    a = c.groupBy("event_id").agg(F.max(F.struct("last_seen_at", "snapshot_id")).alias("m")).select("event_id", F.col("m.last_seen_at").alias("t"), F.col("m.snapshot_id").alias("anchor"))
    e = _once(spark, d, "entries", "entry_id").filter("event_id is not null and first_seen_at is not null").select("event_id", "first_seen_at").join(a, "event_id", "left")
    fits = F.coalesce(F.col("first_seen_at") <= F.col("t"), F.lit(False))
    return e.groupBy("event_id", "anchor").agg(F.count_if(fits).alias("compatible"), F.count_if(~fits).alias("withheld"))


@query("""
WITH v AS (SELECT family, file_name, min(recorded_at) AS t0, max(CASE WHEN json_valid(body) THEN json_extract_string(body, '$.format') END) AS fence, count(*) FILTER (WHERE json_valid(body)) AS n FROM raw_receipts GROUP BY 1, 2), w AS (SELECT *, lag(fence) OVER (PARTITION BY family ORDER BY t0, file_name) AS before, lag(n) OVER (PARTITION BY family ORDER BY t0, file_name) AS n0 FROM v)
SELECT file_name, CASE WHEN fence IS NULL THEN 'no fence' WHEN before IS NULL THEN 'first' WHEN fence <> before THEN 'other fence' WHEN n > n0 THEN 'progress' ELSE 'standstill' END AS verdict FROM w
""")
def progress_verdicts(spark, d):
    """Whether a receipt file counts as progress: only against one of the same fence, and with more readable lines."""
    ok = F.expr("try_parse_json(body) is not null")
    v = table(spark, d, "raw_receipts").groupBy("family", "file_name").agg(F.min("recorded_at").alias("t0"), F.max(F.when(ok, F.get_json_object("body", "$.format"))).alias("fence"), F.count_if(ok).alias("n"))
    w = Window.partitionBy("family").orderBy("t0", "file_name")
    v = v.withColumn("before", F.lag("fence").over(w)).withColumn("n0", F.lag("n").over(w))
    verdict = F.when(F.col("fence").isNull(), "no fence").when(F.col("before").isNull(), "first").when(F.col("fence") != F.col("before"), "other fence").when(F.col("n") > F.col("n0"), "progress").otherwise("standstill")
    return v.select("file_name", verdict.alias("verdict"))


_SHEET_COLUMNS = {"Place": "place", "Marks": "marks_sorted", "Leader": "leader_entry_id", "Follower": "follower_entry_id", "Points": "registry_points_leader"}


@query(f"""
WITH c AS (SELECT placement_id, unnest([{', '.join(f"{{'h': '{h}', 'v': CAST({c} AS VARCHAR)}}" for h, c in _SHEET_COLUMNS.items())}]) AS c FROM {PLACEMENTS})
SELECT c.h AS header, c.h IN ('Place', 'Marks', 'Leader', 'Follower') AS handled, count(*) AS cells, count(*) FILTER (WHERE coalesce(trim(c.v), '') <> '') AS filled FROM c GROUP BY 1, 2
""")
def round_contract(spark, d):
    """Every column of the score sheets: whether the contract handles it, how many cells there are, and how many hold something."""
    from tallyforge.sources.pages import decode, parse_pages

    p = _once(spark, d, "placements", "placement_id")
    cell = lambda c: F.concat(F.lit("<td>"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("</td>"))
    head = "".join(f"<th>{h}</th>" for h in _SHEET_COLUMNS)
    body = F.concat(F.lit(f"<h2>Novice Final</h2><table><tr>{head}</tr><tr>"), *[cell(c) for c in _SHEET_COLUMNS.values()], F.lit("</tr></table>"))
    rows = decode(parse_pages(p.select(F.col("placement_id").alias("page_id"), F.lit("round_sheet").alias("kind"), body.alias("body"))), "round_sheet")
    cells = rows.select(F.explode("cells").alias("c")).select(F.col("c.header").alias("header"), F.col("c.text").alias("v"))
    return cells.groupBy("header", F.col("header").isin("Place", "Marks", "Leader", "Follower").alias("handled")).agg(F.count("*").alias("cells"), F.count_if(F.trim("v") != "").alias("filled"))


@query(f"""
SELECT p.contest_id, c.name_raw AS contest_name_raw, 'final' AS round_name_raw, p.source, count(*) AS n_rows, max(len(tally)) AS n_judges, CASE WHEN max(len(tally)) IS NULL THEN 'unknown' ELSE 'ranks' END AS scoring_method_raw FROM {PLACEMENTS} p JOIN {CONTESTS} c USING (contest_id) GROUP BY 1, 2, 4
""")
def sheet_records(spark, d):
    """Source records of finals brought to one form of sheet: names, rows, judges and what the scores are."""
    c = _once(spark, d, "contests", "contest_id").select("contest_id", F.col("name_raw").alias("contest_name_raw"))
    j = _once(spark, d, "placements", "placement_id").select("contest_id", "source", "tally").join(c, "contest_id")
    n = F.max(F.when(F.col("tally").isNotNull(), F.size("tally")))
    return j.groupBy("contest_id", "contest_name_raw", "source").agg(F.count("*").alias("n_rows"), n.alias("n_judges")).select(
        "contest_id", "contest_name_raw", F.lit("final").alias("round_name_raw"), "source", "n_rows", "n_judges", F.when(F.col("n_judges").isNull(), "unknown").otherwise("ranks").alias("scoring_method_raw")
    )


@query("""
SELECT strftime(published_at, '%Y-%m') AS page_id, '/issues/' || doc_id AS source_ref, 'Issue ' || doc_id AS name_raw FROM (SELECT DISTINCT doc_id, published_at FROM documents WHERE source = 'newsletter' AND published_at IS NOT NULL)
""")
def scan_issue_index(spark, d):
    """Index pages of a newsletter, one a month, and the issues their links lead to."""
    from tallyforge.sources.pages import decode, parse_pages

    x = table(spark, d, "documents").filter("source = 'newsletter' and published_at is not null").select(F.date_format("published_at", "yyyy-MM").alias("month"), F.col("doc_id").cast("string").alias("doc_id"), "published_at").distinct()
    link = F.concat(F.lit('<li><a href="/issues/'), F.col("doc_id"), F.lit('">Issue '), F.col("doc_id"), F.lit("</a></li>"))
    pages = x.groupBy("month").agg(F.array_join(F.array_sort(F.collect_list(link)), "").alias("links"))
    body = F.concat(F.lit("<ul>"), F.col("links"), F.lit("</ul>"))
    return decode(parse_pages(pages.select(F.col("month").alias("page_id"), F.lit("event_index").alias("kind"), body.alias("body"))), "event_index").select("page_id", "source_ref", "name_raw")


queries, oracle_sql = query.queries, query.oracle_sql
