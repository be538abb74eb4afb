"""Intervals, layers, histories and the state of operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyforge.operators import temporal as T
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.session import table

query = Queries()

_ISLANDS = f"""WITH s AS (SELECT event_id, first_seen_at AS s, max(last_seen_at) AS e FROM {ENTRIES} WHERE first_seen_at <= last_seen_at GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN s > max(e) OVER (PARTITION BY event_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS opens FROM s),
g AS (SELECT *, sum(opens) OVER (PARTITION BY event_id ORDER BY s) AS island FROM m),
u AS (SELECT event_id, min(s) AS first_seen_at, max(e) AS last_seen_at FROM g GROUP BY event_id, island)"""


def _islands(spark, d):
    return T.interval_union(_once(spark, d, "entries", "entry_id").select("event_id", "first_seen_at", "last_seen_at"), ["event_id"], "first_seen_at", "last_seen_at")


@query(f"{_ISLANDS} SELECT event_id, first_seen_at AS opened, last_seen_at AS closed FROM u")
def seen_intervals(spark, d):
    """The stretches of time in which entries of an event were seen, overlaps merged."""
    return _islands(spark, d).select("event_id", F.col("first_seen_at").alias("opened"), F.col("last_seen_at").alias("closed"))


@query(f"""{_ISLANDS} SELECT v.event_id, round(sum(greatest(0, epoch_us(least(u.last_seen_at, v.last_seen_at)) - epoch_us(greatest(u.first_seen_at, v.first_seen_at))) / 1e6), 3) AS covered_s,
 round(any_value((epoch_us(v.last_seen_at) - epoch_us(v.first_seen_at)) / 1e6) - sum(greatest(0, epoch_us(least(u.last_seen_at, v.last_seen_at)) - epoch_us(greatest(u.first_seen_at, v.first_seen_at))) / 1e6), 3) AS open_s
FROM {EVENTS} v JOIN u USING (event_id) GROUP BY 1""")
def uncovered_time(spark, d):
    """Of the time in which an event was known, how long its entries were seen and how long not."""
    v = _once(spark, d, "dance_events", "event_id").select("event_id", F.col("first_seen_at").alias("since"), F.col("last_seen_at").alias("until"))
    j = _islands(spark, d).join(v, "event_id")
    out = T.excluded_seconds(j, ["event_id", "since", "until"], "first_seen_at", "last_seen_at", F.col("since"), F.col("until"))
    whole = (F.unix_micros(F.col("until").cast("timestamp")) - F.unix_micros(F.col("since").cast("timestamp"))) / 1e6
    return out.select("event_id", F.round("excluded_s", 3).alias("covered_s"), F.round(whole - F.col("excluded_s"), 3).alias("open_s"))


_LINKS = "(SELECT lower(trim(record_key)) AS k, release_no, max(coalesce(lower(trim(status)), '')) AS status, max(coalesce(wsdc_id, -1)) AS wsdc_id FROM link_snapshots WHERE record_key IS NOT NULL GROUP BY 1, 2)"


def _links(spark, d):
    s = table(spark, d, "link_snapshots").filter("record_key is not null")
    return s.groupBy(F.lower(F.trim("record_key")).alias("k"), "release_no").agg(F.max(F.coalesce(F.lower(F.trim("status")), F.lit(""))).alias("status"), F.max(F.coalesce("wsdc_id", F.lit(-1))).alias("wsdc_id"))


@query(f"""
WITH l AS (SELECT *, lag(status) OVER w AS s0, lag(wsdc_id) OVER w AS w0, row_number() OVER w AS n FROM {_LINKS} WINDOW w AS (PARTITION BY k ORDER BY release_no))
SELECT k, release_no, status, wsdc_id FROM l WHERE n = 1 OR s0 <> status OR w0 <> wsdc_id
""")
def link_history(spark, d):
    """The releases at which a link changed; unchanged samples are left out."""
    return T.changed_samples(_links(spark, d), ["k"], "release_no", ["status", "wsdc_id"]).select("k", "release_no", "status", "wsdc_id")


_LAYERED = ["name", "city", "country", "website", "wsdc_status"]


@query(f"""
WITH base AS (SELECT lower(trim(event_id)) AS k, 0 AS r, last_seen_at AS t, {', '.join(_LAYERED)} FROM {EVENTS}),
patch AS (SELECT lower(trim(event_id)) AS k, 1 AS r, TIMESTAMP '2024-01-01' AS t, {', '.join(f"nullif(trim({c}), '') AS {c}" for c in _LAYERED)} FROM event_mirror), a AS (SELECT * FROM base UNION ALL SELECT * FROM patch)
SELECT k, {', '.join(f"(SELECT max(struct_pack(r := r, t := t, v := {c})).v FROM a x WHERE x.k = b.k AND x.{c} IS NOT NULL) AS {c}" for c in _LAYERED)} FROM (SELECT DISTINCT k FROM base) b
""")
def layered_events(spark, d):
    """Events under the patches of a second system: per field the highest layer that has a value."""
    k = F.lower(F.trim("event_id")).alias("k")
    base = _once(spark, d, "dance_events", "event_id").select(k, F.col("last_seen_at").alias("at"), *_LAYERED)
    patch = table(spark, d, "event_mirror").select(k, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("at"), *[F.nullif(F.trim(c), F.lit("")).alias(c) for c in _LAYERED])
    return T.overlay([base, patch], "k", _LAYERED, "at").select("k", *_LAYERED)


@query(f"""
WITH l AS {_LINKS}, b AS (SELECT max(release_no) AS hi FROM l)
SELECT n.k, CASE WHEN n.status IN ('suppressed', 'withheld', '') THEN coalesce(o.status, n.status) ELSE n.status END AS status, n.status IN ('suppressed', 'withheld', '') AND o.status IS NOT NULL AS stands_in FROM (SELECT l.* FROM l, b WHERE release_no = hi) n LEFT JOIN (SELECT l.* FROM l, b WHERE release_no = hi - 1) o USING (k)
""")
def stand_ins(spark, d):
    """The latest release with the one before it standing in for what is withheld."""
    l = _links(spark, d)  # noqa: E741
    hi = l.agg(F.max("release_no").alias("hi"))
    new = l.join(F.broadcast(hi)).filter("release_no = hi").select("k", "status")
    old = l.join(F.broadcast(hi)).filter("release_no = hi - 1").select("k", F.col("status").alias("old"))
    held = F.col("status").isin("suppressed", "withheld", "")
    return new.join(old, "k", "left").select("k", F.when(held, F.coalesce("old", "status")).otherwise(F.col("status")).alias("status"), (held & F.col("old").isNotNull()).alias("stands_in"))


_GONE = "(SELECT lower(trim(record_key)) FROM removals WHERE table_name = '{t}' AND record_key IS NOT NULL)"


@query(f"""
WITH v AS (SELECT event_id FROM {EVENTS} WHERE lower(event_id) NOT IN {_GONE.format(t='dance_events')}),
c AS (SELECT contest_id, event_id FROM {CONTESTS} WHERE lower(contest_id) NOT IN {_GONE.format(t='contests')} AND event_id IN (SELECT event_id FROM v)),
e AS (SELECT entry_id, contest_id FROM {ENTRIES} WHERE lower(entry_id) NOT IN {_GONE.format(t='entries')} AND event_id IN (SELECT event_id FROM v) AND contest_id IN (SELECT contest_id FROM c)),
p AS (SELECT placement_id FROM {PLACEMENTS} WHERE contest_id IN (SELECT contest_id FROM c) AND (leader_entry_id IS NULL OR leader_entry_id IN (SELECT entry_id FROM e)) AND (follower_entry_id IS NULL OR follower_entry_id IN (SELECT entry_id FROM e)))
SELECT 'dance_events' AS table_name, count(*) AS kept FROM v UNION ALL SELECT 'contests', count(*) FROM c UNION ALL SELECT 'entries', count(*) FROM e UNION ALL SELECT 'placements', count(*) FROM p
""")
def close_after_removal(spark, d):
    """Rows of every table that stand after the removed ones and all that hang on them are gone."""
    keys = {"dance_events": "event_id", "contests": "contest_id", "entries": "entry_id", "placements": "placement_id"}
    tables = {t: _once(spark, d, t, k).withColumn("_k", F.lower(k)) for t, k in keys.items()}
    r = table(spark, d, "removals").filter("record_key is not null")
    gone = {t: r.filter(F.col("table_name") == t).select(F.lower(F.trim("record_key")).alias("_k")).distinct() for t in ("dance_events", "contests", "entries")}
    parents = {"contests": [("event_id", "dance_events", "event_id")], "entries": [("event_id", "dance_events", "event_id"), ("contest_id", "contests", "contest_id")], "placements": [("contest_id", "contests", "contest_id"), ("leader_entry_id", "entries", "entry_id"), ("follower_entry_id", "entries", "entry_id")]}
    kept = T.keep_closed(tables, parents, gone, list(keys))
    out = None
    for t in keys:
        part = kept[t].agg(F.count("*").alias("kept")).select(F.lit(t).alias("table_name"), "kept")
        out = part if out is None else out.unionByName(part)
    return out


@query("""
SELECT scope_kind, scope_id, source, via, CASE WHEN discovered_units IS NULL OR acquired_units IS NULL THEN 'unknown' WHEN acquired_units < discovered_units THEN 'incomplete' WHEN coalesce(interpreted_units, 0) < acquired_units THEN 'uninterpreted' WHEN coalesce(withheld_units, 0) > 0 THEN 'withheld' ELSE 'complete' END AS state, last_changed_at FROM coverage
""")
def capture_states(spark, d):
    """Whether what was captured of a scope is fully read; archived and direct captures follow one rule."""
    acquired, found = F.col("acquired_units"), F.col("discovered_units")
    state = (
        F.when(found.isNull() | acquired.isNull(), "unknown").when(acquired < found, "incomplete").when(F.coalesce("interpreted_units", F.lit(0)) < acquired, "uninterpreted")
        .when(F.coalesce("withheld_units", F.lit(0)) > 0, "withheld").otherwise("complete")
    )
    return table(spark, d, "coverage").select("scope_kind", "scope_id", "source", "via", state.alias("state"), "last_changed_at")


@query(f"""
WITH t AS (SELECT DISTINCT v."year" AS y, s.source FROM {EVENTS} v, (SELECT unnest(sources) AS source, event_id FROM {EVENTS}) s WHERE s.event_id = v.event_id), h AS (SELECT DISTINCT CAST("year" AS INTEGER) AS y, source FROM coverage WHERE acquired_units > 0)
SELECT t.y, count(*) AS expected, count(*) FILTER (WHERE h.y IS NULL) AS gaps FROM t LEFT JOIN h ON h.y = t.y AND h.source = t.source WHERE t.y IS NOT NULL GROUP BY 1
""")
def year_gaps(spark, d):
    """Sources expected per year by the events' own lists, less those that anything was captured of."""
    v = _once(spark, d, "dance_events", "event_id").filter("year is not null")
    expected = v.select(F.col("year").cast("int").alias("y"), F.explode("sources").alias("source")).distinct()
    held = table(spark, d, "coverage").filter("acquired_units > 0").select(F.col("year").cast("int").alias("y"), "source").distinct().withColumn("there", F.lit(True))
    return expected.join(held, ["y", "source"], "left").groupBy("y").agg(F.count("*").alias("expected"), F.count_if(F.col("there").isNull()).alias("gaps"))


@query(f"""
SELECT DISTINCT v."year" AS y FROM {EVENTS} v JOIN (SELECT scope_id FROM coverage WHERE last_changed_at > TIMESTAMP '2024-06-01' AND scope_kind = 'source_event') c ON c.scope_id = v.event_id WHERE v."year" IS NOT NULL
""")
def affected_years(spark, d):
    """Years whose captures changed after a given time."""
    c = table(spark, d, "coverage").filter((F.col("last_changed_at") > F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")) & (F.col("scope_kind") == "source_event")).select(F.col("scope_id").alias("event_id"))
    return _once(spark, d, "dance_events", "event_id").join(c, "event_id", "left_semi").filter("year is not null").select(F.col("year").alias("y")).distinct()


@query(f"""
WITH c AS (SELECT scope_id, source, bool_or(coalesce(via, '') = 'archive') AS archived, bool_or(coalesce(via, '') = 'direct') AS direct, max(discovered_units) AS units FROM coverage WHERE scope_kind = 'source_event' GROUP BY 1, 2),
r AS (SELECT c.*, row_number() OVER (PARTITION BY c.source ORDER BY units DESC NULLS LAST, scope_id) AS k FROM c JOIN {EVENTS} v ON v.event_id = c.scope_id WHERE NOT archived)
SELECT source, scope_id, units, k FROM r WHERE k <= 20
""")
def archive_plan(spark, d):
    """The twenty events of each source with most to gain from the archive, among known ones it has nothing of. The limit is the plan's."""
    c = table(spark, d, "coverage").filter("scope_kind = 'source_event'").groupBy("scope_id", "source").agg(F.max(F.coalesce(F.col("via") == "archive", F.lit(False))).alias("archived"), F.max("discovered_units").alias("units"))
    known = _once(spark, d, "dance_events", "event_id").select(F.col("event_id").alias("scope_id"))
    r = c.filter("not archived").join(known, "scope_id", "left_semi")
    return r.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy(F.col("units").desc_nulls_last(), "scope_id"))).filter("k <= 20").select("source", "scope_id", "units", "k")


@query(f"""
SELECT DISTINCT v.event_id, regexp_extract(v.website, '^https?://([^/]+)', 1) AS site FROM {EVENTS} v WHERE v.website IS NOT NULL AND EXISTS (SELECT 1 FROM documents x WHERE x.event_id = v.event_id AND x.source = 'event_site' AND length(trim(x.text)) > 0)
""")
def site_hits(spark, d):
    """Event sites of which a text is held as evidence."""
    held = table(spark, d, "documents").filter((F.col("source") == "event_site") & (F.length(F.trim("text")) > 0)).select("event_id")
    v = _once(spark, d, "dance_events", "event_id").filter("website is not null")
    return v.join(held, "event_id", "left_semi").select("event_id", F.regexp_extract("website", "^https?://([^/]+)", 1).alias("site")).distinct()


@query(f"""
SELECT v.event_id, v.source FROM {EVENTS} v WHERE v.website IS NOT NULL AND coalesce(v.held, '') <> 'cancelled' AND NOT EXISTS (SELECT 1 FROM coverage c WHERE c.scope_id = v.event_id AND c.via = 'archive')
""")
def origin_proposals(spark, d):
    """Events with a known site that no archive search covers."""
    v = _once(spark, d, "dance_events", "event_id").filter(F.col("website").isNotNull() & (F.coalesce("held", F.lit("")) != "cancelled"))
    c = table(spark, d, "coverage").filter("via = 'archive'").select(F.col("scope_id").alias("event_id"))
    return v.join(c, "event_id", "left_anti").select("event_id", "source")


@query(f"""
WITH q AS (SELECT scope_id AS event_id, max(entries) AS required FROM coverage WHERE scope_kind = 'source_event' GROUP BY 1), h AS (SELECT event_id, count(*) AS held FROM {ENTRIES} GROUP BY 1)
SELECT coalesce(q.event_id, h.event_id) AS event_id, required, coalesce(held, 0) AS held, CASE WHEN required IS NULL THEN 'unexpected' WHEN coalesce(held, 0) < required THEN 'short' ELSE 'met' END AS state FROM q FULL JOIN h ON q.event_id = h.event_id WHERE coalesce(q.event_id, h.event_id) IS NOT NULL
""")
def requirement_scan(spark, d):
    """Entries that events should have against those they have."""
    q = table(spark, d, "coverage").filter("scope_kind = 'source_event' and scope_id is not null").groupBy(F.col("scope_id").alias("event_id")).agg(F.max("entries").alias("required"))
    h = _once(spark, d, "entries", "entry_id").filter("event_id is not null").groupBy("event_id").agg(F.count("*").alias("held"))
    held = F.coalesce("held", F.lit(0))
    return q.join(h, "event_id", "full_outer").select("event_id", "required", held.alias("held"), F.when(F.col("required").isNull(), "unexpected").when(held < F.col("required"), "short").otherwise("met").alias("state"))


@query("""
SELECT scope_id, sum(discovered_units) AS discovered, sum(acquired_units) AS acquired, sum(interpreted_units) AS interpreted, sum(mapped_units) AS mapped, count(*) FILTER (WHERE resolved_identities IS NULL) AS unknown_identities, CASE WHEN count(resolved_identities) < count(*) THEN NULL ELSE sum(resolved_identities) END AS resolved FROM coverage WHERE scope_kind = 'source_event' GROUP BY 1
""")
def stage_accounting(spark, d):
    """Units per stage of each event; a total of which a part is unknown is unknown, not smaller."""
    c = table(spark, d, "coverage").filter("scope_kind = 'source_event'")
    resolved = F.when(F.count("resolved_identities") < F.count("*"), F.lit(None)).otherwise(F.sum("resolved_identities"))
    return c.groupBy("scope_id").agg(*[F.sum(f"{s}_units").alias(s) for s in ("discovered", "acquired", "interpreted", "mapped")], F.count_if(F.col("resolved_identities").isNull()).alias("unknown_identities"), resolved.alias("resolved"))


@query(f"""
SELECT v.event_id, CASE WHEN p.event_id IS NOT NULL THEN 'results' WHEN e.event_id IS NOT NULL THEN 'entries' WHEN c.event_id IS NOT NULL THEN 'contests' WHEN x.event_id IS NOT NULL THEN 'texts' ELSE 'nothing' END AS evidence
FROM {EVENTS} v LEFT JOIN (SELECT DISTINCT event_id FROM placements) p USING (event_id) LEFT JOIN (SELECT DISTINCT event_id FROM entries) e USING (event_id) LEFT JOIN (SELECT DISTINCT event_id FROM contests) c USING (event_id) LEFT JOIN (SELECT DISTINCT event_id FROM documents) x USING (event_id)
""")
def event_inventory(spark, d):
    """The best evidence held for each event. One union of tagged keys instead of four joins."""
    ranks = [("documents", 1), ("contests", 2), ("entries", 3), ("placements", 4)]
    parts = [table(spark, d, t).filter("event_id is not null").select("event_id", F.lit(r).alias("r")).distinct() for t, r in ranks]
    best = parts[0]
    for p in parts[1:]:
        best = best.unionByName(p)
    j = _once(spark, d, "dance_events", "event_id").select("event_id").join(best.groupBy("event_id").agg(F.max("r").alias("r")), "event_id", "left")
    label = F.when(F.col("r") == 4, "results").when(F.col("r") == 3, "entries").when(F.col("r") == 2, "contests").when(F.col("r") == 1, "texts").otherwise("nothing")
    return j.select("event_id", label.alias("evidence"))


@query("""
SELECT user_id AS host, CAST(ts AS DATE) AS day, event_id, count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) <= 8 AND coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id)) >= 60000000, TRUE) AS allowed FROM events
""")
def host_budget(spark, d):
    """Requests that keep within eight a host and day and a minute apart."""
    w = Window.partitionBy("host", "day").orderBy("ts", "event_id")
    e = table(spark, d, "events").select(F.col("user_id").alias("host"), F.col("ts").cast("date").alias("day"), "ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.lag(F.unix_micros(F.col("ts").cast("timestamp"))).over(w)
    return e.select("host", "day", "event_id", ((F.row_number().over(w) <= 8) & F.coalesce(gap >= 60_000_000, F.lit(True))).alias("allowed"))


@query(f"""
WITH s AS (SELECT entry_id, link_status, wsdc_id IS NOT NULL AS has_id FROM {ENTRIES}), p AS (SELECT leader_entry_id AS entry_id FROM {PLACEMENTS} UNION ALL SELECT follower_entry_id FROM {PLACEMENTS})
SELECT link_status, has_id, count(*) AS subjects, count(*) FILTER (WHERE entry_id IN (SELECT entry_id FROM p WHERE entry_id IS NOT NULL)) AS with_place, array_to_string(list_sort(list_distinct(list(substr(entry_id, 1, 4)))), ',') AS years FROM s GROUP BY 1, 2
""")
def identity_population(spark, d):
    """Subjects by status and printed id, those a placement stands for, and the years they are from."""
    p = _once(spark, d, "placements", "placement_id")
    held = p.select(F.explode(F.array("leader_entry_id", "follower_entry_id")).alias("entry_id")).filter("entry_id is not null").distinct().withColumn("there", F.lit(True))
    s = _once(spark, d, "entries", "entry_id").select("entry_id", "link_status", F.col("wsdc_id").isNotNull().alias("has_id")).join(held, "entry_id", "left")
    return s.groupBy("link_status", "has_id").agg(F.count("*").alias("subjects"), F.count("there").alias("with_place"), F.array_join(F.sort_array(F.collect_set(F.substring("entry_id", 1, 4))), ",").alias("years"))


@query("""
WITH j AS (SELECT DISTINCT lower(trim(record_key)) AS k, release_no AS decision, CASE WHEN release_no > 1 THEN release_no - 1 END AS supersedes FROM link_snapshots WHERE record_key IS NOT NULL AND status = 'confirmed')
SELECT k, decision FROM j a WHERE NOT EXISTS (SELECT 1 FROM j b WHERE b.k = a.k AND b.supersedes = a.decision)
""")
def active_decisions(spark, d):
    """Decisions of an append-only journal that no later one supersedes."""
    j = table(spark, d, "link_snapshots").filter("record_key is not null and status = 'confirmed'").select(F.lower(F.trim("record_key")).alias("k"), F.col("release_no").alias("decision")).distinct()
    return j.join(j.filter("decision > 1").select("k", (F.col("decision") - 1).alias("decision")), ["k", "decision"], "left_anti")


@query(f"""
SELECT e.entry_id, c.source || ':' || coalesce(c.source_contest_ref, '') AS locator FROM {ENTRIES} e JOIN contests c USING (contest_id) WHERE c.source_contest_ref IS NOT NULL UNION SELECT e.entry_id, c.source || ':' || c.source_contest_ref FROM {ENTRIES} e JOIN contests c USING (contest_id) WHERE c.source_contest_ref IS NOT NULL
""")
def reference_bindings(spark, d):
    """Every source locator under which an entry was observed."""
    c = table(spark, d, "contests").filter("source_contest_ref is not null").select("contest_id", F.concat_ws(":", "source", "source_contest_ref").alias("locator")).distinct()
    return _once(spark, d, "entries", "entry_id").select("entry_id", "contest_id").join(c, "contest_id").select("entry_id", "locator").distinct()


@query("""
SELECT event_id, source, source_contest_ref AS ref, row_number() OVER (PARTITION BY event_id ORDER BY source, source_contest_ref) AS position FROM (SELECT DISTINCT event_id, source, source_contest_ref FROM contests WHERE source_contest_ref IS NOT NULL)
""")
def proposals_by_event(spark, d):
    """Proposals naming an event, in the order of source and reference."""
    c = table(spark, d, "contests").filter("source_contest_ref is not null").select("event_id", "source", F.col("source_contest_ref").alias("ref")).distinct()
    return c.select("event_id", "source", "ref", F.row_number().over(Window.partitionBy("event_id").orderBy("source", "ref")).alias("position"))


@query("""
SELECT file_name, line_no, json_extract_string(m.value, '$') AS warning, json_extract_string(body, '$.step') AS step FROM (SELECT DISTINCT file_name, line_no, body FROM raw_receipts WHERE json_valid(body)) r, json_each(r.body, '$.warnings') m WHERE json_type(r.body, '$.warnings') = 'ARRAY' AND json_type(m.value) = 'VARCHAR'
""")
def json_members(spark, d):
    """One row per member of a JSON array, beside a field of its line."""
    r = table(spark, d, "raw_receipts").select("file_name", "line_no", "body").distinct()
    read = r.select("file_name", "line_no", F.from_json(F.get_json_object("body", "$.warnings"), "array<string>").alias("w"), F.get_json_object("body", "$.step").alias("step"))
    return read.select("file_name", "line_no", F.explode("w").alias("warning"), "step").filter("warning is not null")


@query("""
SELECT file_name, count(*) AS n, count(*) FILTER (WHERE list_contains([split_part(x, '-', 1) FOR x IN CAST(json_extract(body, '$.warnings') AS VARCHAR[])], 'plan')) AS with_plan FROM (SELECT * FROM raw_receipts WHERE json_valid(body) AND json_type(body, '$.warnings') = 'ARRAY') GROUP BY 1
""")
def json_array_membership(spark, d):
    """Lines whose JSON array holds a member of a kind."""
    w = F.from_json(F.get_json_object("body", "$.warnings"), "array<string>")
    r = table(spark, d, "raw_receipts").select("file_name", w.alias("w")).filter("w is not null")
    return r.groupBy("file_name").agg(F.count("*").alias("n"), F.count_if(F.exists("w", lambda x: F.split_part(x, F.lit("-"), F.lit(1)) == "plan")).alias("with_plan"))


@query("""
WITH r AS (SELECT file_name, line_no, coalesce(body, '') AS body, CASE line_no % 12 WHEN 0 THEN 200 WHEN 1 THEN 304 WHEN 2 THEN 302 WHEN 3 THEN 429 WHEN 4 THEN 503 WHEN 5 THEN 403 WHEN 6 THEN 404 WHEN 7 THEN 410 WHEN 8 THEN 500 WHEN 9 THEN 418 WHEN 10 THEN 401 ELSE 200 END AS code FROM raw_receipts)
SELECT code, CASE WHEN contains(lower(body), 'challenge-platform') OR contains(lower(body), 'just a moment') OR contains(lower(body), 'cf-chl') THEN 'blocked' WHEN code = 304 THEN 'not_modified' WHEN code = 200 THEN 'ok' WHEN code IN (301, 302, 303, 307, 308) THEN 'redirect' WHEN code IN (429, 503) THEN 'throttled' WHEN code IN (401, 403) THEN 'blocked' WHEN code IN (404, 410) THEN 'gone' WHEN code >= 500 THEN 'server_error' ELSE 'invalid' END AS outcome, count(*) AS n FROM r GROUP BY 1, 2
""")
def response_outcomes(spark, d):
    """Responses by status and body: what each means for the next request. Lines stand for bodies, statuses go by their number."""
    codes = [200, 304, 302, 429, 503, 403, 404, 410, 500, 418, 401, 200]
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("line_no") % 12) + 1)
    r = table(spark, d, "raw_receipts").select(F.lower(F.coalesce("body", F.lit(""))).alias("body"), code.alias("code"))
    return r.select("code", response_class(F.col("code"), F.col("body")).alias("outcome")).groupBy("code", "outcome").agg(F.count("*").alias("n"))


# Marks of a page that stands for another one until a browser has been checked, and what statuses mean.
CHALLENGES = ["cf-chl", "just a moment", "challenge-platform"]
STATUSES = [([304], "not_modified"), ([200], "ok"), ([301, 302, 303, 307, 308], "redirect"), ([429, 503], "throttled"), ([401, 403], "blocked"), ([404, 410], "gone")]


def response_class(code, body):
    """The outcome class of a response."""
    out = F.when(F.exists(F.array(*[F.lit(c) for c in CHALLENGES]), lambda c: F.contains(body, c)), "blocked")
    for codes, label in STATUSES:
        out = out.when(code.isin(*codes), label)
    return out.when(code >= 500, "server_error").otherwise("invalid")


@query("""
SELECT sha256(body) AS digest, count(*) AS copies, min(loaded_at) AS first_loaded, count(DISTINCT file_name) AS files FROM raw_receipts WHERE body IS NOT NULL GROUP BY 1
""")
def body_store(spark, d):
    """Bodies once each by their digest, with how often and since when they were seen."""
    return table(spark, d, "raw_receipts").filter("body is not null").groupBy(F.sha2("body", 256).alias("digest")).agg(F.count("*").alias("copies"), F.min("loaded_at").alias("first_loaded"), F.countDistinct("file_name").alias("files"))


@query(f"""
WITH e AS (SELECT source, CASE WHEN link_status IN ('confirmed', 'probable') THEN 'done' WHEN link_status = 'unmatched' THEN 'waiting' ELSE 'review' END AS class, last_seen_at FROM {ENTRIES})
SELECT source, class, count(*) AS n, min(last_seen_at) AS oldest FROM e GROUP BY 1, 2
""")
def queue_counts(spark, d):
    """Subjects per source and stage of the queue, with the oldest."""
    s = F.col("link_status")
    stage = F.when(s.isin("confirmed", "probable"), "done").when(s == "unmatched", "waiting").otherwise("review")
    return _once(spark, d, "entries", "entry_id").groupBy("source", stage.alias("class")).agg(F.count("*").alias("n"), F.min("last_seen_at").alias("oldest"))


@query("""
SELECT regexp_extract(website, '^https?://([^/]+)', 1) AS host, source AS class, count(*) AS n, min(last_seen_at) AS oldest, max(last_seen_at) AS newest FROM dance_events WHERE website IS NOT NULL GROUP BY 1, 2
""")
def host_service(spark, d):
    """When each host and class was last served."""
    v = table(spark, d, "dance_events").filter("website is not null")
    return v.groupBy(F.regexp_extract("website", "^https?://([^/]+)", 1).alias("host"), F.col("source").alias("class")).agg(F.count("*").alias("n"), F.min("last_seen_at").alias("oldest"), F.max("last_seen_at").alias("newest"))


@query(f"""
WITH o AS (SELECT DISTINCT event_id FROM contests WHERE last_seen_at <= TIMESTAMP '2024-06-01'), n AS (SELECT DISTINCT event_id FROM contests WHERE last_seen_at > TIMESTAMP '2024-06-01')
SELECT coalesce(o.event_id, n.event_id) AS event_id, o.event_id IS NOT NULL AS was_there, n.event_id IS NOT NULL AS is_there FROM o FULL JOIN n ON o.event_id = n.event_id
""")
def map_replace(spark, d):
    """The ids that replacing a map touches: old and new ones together."""
    c = table(spark, d, "contests").filter("event_id is not null and last_seen_at is not null")
    new = F.col("last_seen_at") > F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")
    return c.groupBy("event_id").agg(F.max(~new).alias("was_there"), F.max(new).alias("is_there"))


@query("SELECT wsdc_id // 512 AS batch, count(DISTINCT wsdc_id) AS dancers, min(wsdc_id) AS low, max(wsdc_id) AS high FROM dancers GROUP BY 1")
def dancer_batches(spark, d):
    """Dancers in batches of 512 ids."""
    return table(spark, d, "dancers").groupBy(F.expr("wsdc_id div 512").alias("batch")).agg(F.countDistinct("wsdc_id").alias("dancers"), F.min("wsdc_id").alias("low"), F.max("wsdc_id").alias("high"))


@query(f"""
SELECT v.event_id, count(DISTINCT x.doc_id) AS pages, count(DISTINCT x.source) AS kinds, count(DISTINCT x.doc_id) FILTER (WHERE length(x.text) > 0) AS readable, CASE WHEN count(x.doc_id) = 0 THEN 'none' WHEN count(DISTINCT x.doc_id) FILTER (WHERE length(x.text) > 0) = count(DISTINCT x.doc_id) THEN 'full' ELSE 'partial' END AS support
FROM {EVENTS} v LEFT JOIN documents x ON x.event_id = v.event_id GROUP BY 1
""")
def page_coverage(spark, d):
    """Pages per event, their kinds, how many are readable, and the support that makes."""
    x = table(spark, d, "documents").filter("event_id is not null").groupBy("event_id").agg(F.countDistinct("doc_id").alias("pages"), F.countDistinct("source").alias("kinds"), F.countDistinct(F.when(F.length("text") > 0, F.col("doc_id"))).alias("readable"))
    n = lambda c: F.coalesce(c, F.lit(0))
    support = F.when(n("pages") == 0, "none").when(n("readable") == n("pages"), "full").otherwise("partial")
    return _once(spark, d, "dance_events", "event_id").select("event_id").join(x, "event_id", "left").select("event_id", n("pages").alias("pages"), n("kinds").alias("kinds"), n("readable").alias("readable"), support.alias("support"))


queries, oracle_sql = query.queries, query.oracle_sql
