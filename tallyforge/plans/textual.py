"""String, date, scoring, array and JSON functions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import scoring, text, times
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, DANCERS, ENTRIES, EVENTS, PLACEMENTS, _once
from tallyforge.session import table

query = Queries()

_PLAIN = "replace(lower(strip_accents({c})), 'ß', 'ss')"
_SLUG = "coalesce(nullif(trim(regexp_replace(" + _PLAIN + ", '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown')"


@query(f"SELECT DISTINCT name, {_SLUG.format(c='name')} AS slug FROM dance_events")
def text_slug(spark, d):
    """Slugs of event names."""
    return table(spark, d, "dance_events").select("name", text.slug(F.col("name")).alias("slug")).distinct()


@query("SELECT DISTINCT series_name_raw, " + _SLUG.format(c=r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(series_name_raw, '\(?\b(?:on\s+)?hiatus\b\)?', ' ', 'gi'), '\b20\d{2}\b', ' ', 'g'), '\b\d{1,2}(?:st|nd|rd|th)\b', ' ', 'gi'), '\b[ivx]+\b', ' ', 'gi')") + " AS series_slug FROM registry_placements")
def text_series_slug(spark, d):
    """Slugs of series: editions of one event agree."""
    return table(spark, d, "registry_placements").select("series_name_raw", text.series_slug(F.col("series_name_raw")).alias("series_slug")).distinct()


@query(f"""
WITH w AS (SELECT DISTINCT first_name || ' ' || last_name AS name FROM dancers WHERE first_name IS NOT NULL AND last_name IS NOT NULL),
s AS (SELECT name, [x FOR x IN string_split(regexp_replace({_PLAIN.format(c='name')}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') IF x <> ''] AS t FROM w)
SELECT name, array_to_string(CASE WHEN len(t) > 0 AND t[-1] IN ('jr', 'sr', 'ii', 'iii') THEN t[1:len(t) - 1] ELSE t END, ' ') AS norm FROM s
""")
def text_name_norm(spark, d):
    """Dancers' names as plain words without a suffix."""
    w = table(spark, d, "dancers").select(F.concat("first_name", F.lit(" "), "last_name").alias("name")).filter("name is not null").distinct()
    return w.select("name", text.name_norm(F.col("name")).alias("norm"))


@query(r"""
WITH p AS (SELECT DISTINCT name_raw, [trim(x) FOR x IN regexp_split_to_array(name_raw, '(?i)\s+and\s+|\s*[&/]\s*')] AS t FROM entries WHERE name_raw IS NOT NULL)
SELECT name_raw, CASE WHEN len(t) > 1 AND len([x FOR x IN t IF x = '']) = 0 THEN len(t) ELSE 0 END AS n_people FROM p
""")
def text_paired(spark, d):
    """How many people a cell joins by and, & or /."""
    return table(spark, d, "entries").filter("name_raw is not null").select("name_raw", F.size(text.paired(F.col("name_raw"))).alias("n_people")).distinct()


@query("SELECT DISTINCT contest_id, substr(sha256(concat_ws('|', source, contest_id, coalesce(source_contest_ref, ''))), 1, 16) AS watch_id FROM contests")
def text_watch_id(spark, d):
    """Stable short ids from several fields."""
    c = table(spark, d, "contests")
    return c.select("contest_id", text.short_hash(F.col("source"), F.col("contest_id"), F.coalesce("source_contest_ref", F.lit(""))).alias("watch_id")).distinct()


_DIV = [("newcomer", "newcomer"), ("novice", "novice"), ("intermediate", "intermediate"), ("advanced", "advanced"), ("all star", "allstar"), ("allstar", "allstar"), ("champion", "champion"), ("invit", "invitational"), ("open", "open")]
_KIND = [("jack and jill", "jack_and_jill"), ("j j", "jack_and_jill"), ("strictly", "strictly"), ("classic", "classic"), ("showcase", "showcase"), ("pro am", "pro_am"), ("rising star", "rising_star")]


def _first_phrase(value, phrases, default):
    out = F.lit(default)
    for phrase, label in reversed(phrases):
        out = F.when(F.contains(value, F.lit(phrase)), label).otherwise(out)
    return out


def _sql_first_phrase(value, phrases, default):
    return "CASE " + " ".join(f"WHEN contains({value}, '{p}') THEN '{label}'" for p, label in phrases) + f" ELSE '{default}' END"


_VALUE = "trim(regexp_replace(lower(name_raw), '[^a-z0-9]+', ' ', 'g'))"


@query(f"SELECT DISTINCT name_raw, {_sql_first_phrase(_VALUE, _DIV, 'none')} AS division, {_sql_first_phrase(_VALUE, _KIND, 'other')} AS contest_type FROM contests WHERE name_raw IS NOT NULL")
def text_classify_contest(spark, d):
    """Division and type of a contest by the first phrase its name holds."""
    v = F.trim(F.regexp_replace(F.lower("name_raw"), "[^a-z0-9]+", " "))
    return table(spark, d, "contests").filter("name_raw is not null").select("name_raw", _first_phrase(v, _DIV, "none").alias("division"), _first_phrase(v, _KIND, "other").alias("contest_type")).distinct()


@query(f"""
SELECT contest_id, CAST(nullif(regexp_extract(contest_id, '-(\\d+)$', 1), '') AS INTEGER) AS occurrence, regexp_extract(contest_id, '/([a-z]+)-', 1) AS slug_division, split_part(contest_id, '/', 1) AS event_part FROM {CONTESTS}
""")
def text_id_parts(spark, d):
    """The parts a contest's id is made of."""
    c = _once(spark, d, "contests", "contest_id")
    return c.select("contest_id", F.nullif(F.regexp_extract("contest_id", r"-(\d+)$", 1), F.lit("")).cast("int").alias("occurrence"), F.regexp_extract("contest_id", "/([a-z]+)-", 1).alias("slug_division"), F.split_part("contest_id", F.lit("/"), F.lit(1)).alias("event_part"))


@query("SELECT DISTINCT website, regexp_extract(website, '^https?://([^/]+)', 1) AS host, regexp_extract(website, '/(\\d{4})$', 1) AS path_year FROM dance_events WHERE website IS NOT NULL")
def text_url_parts(spark, d):
    """Host and year of an address."""
    v = table(spark, d, "dance_events").filter("website is not null")
    return v.select("website", F.regexp_extract("website", "^https?://([^/]+)", 1).alias("host"), F.regexp_extract("website", r"/(\d{4})$", 1).alias("path_year")).distinct()


@query(f"""
SELECT event_id, CAST(start_date AS VARCHAR) AS starts, strftime(start_date, '%Y-%m') AS month, strftime(start_date + INTERVAL 1 MONTH, '%Y-%m') AS next_month, date_diff('day', start_date, end_date) + 1 AS n_days, "year" = date_part('year', end_date) AS year_agrees FROM {EVENTS} WHERE start_date IS NOT NULL AND end_date IS NOT NULL
""")
def date_parts(spark, d):
    """Months, spans and contradicting years of events."""
    v = _once(spark, d, "dance_events", "event_id").filter("start_date is not null and end_date is not null")
    return v.select("event_id", F.col("start_date").cast("string").alias("starts"), F.date_format("start_date", "yyyy-MM").alias("month"), F.date_format(F.add_months("start_date", 1), "yyyy-MM").alias("next_month"), (F.date_diff("end_date", "start_date") + 1).alias("n_days"), (F.col("year") == F.year("end_date")).alias("year_agrees"))


@query("""
SELECT DISTINCT start_date AS printed, coalesce(CASE WHEN regexp_matches(trim(start_date), '^\\d{4}-\\d{2}-\\d{2}') THEN TRY_CAST(substr(trim(start_date), 1, 10) AS DATE) END, CAST(TRY_STRPTIME(trim(start_date), '%d %b %Y') AS DATE)) AS parsed FROM event_mirror
""")
def date_printed(spark, d):
    """Printed dates of several formats."""
    return table(spark, d, "event_mirror").select(F.col("start_date").alias("printed"), times.printed_date(F.col("start_date")).alias("parsed")).distinct()


@query(f"""
SELECT event_id, CAST(start_date AS TIMESTAMP) - INTERVAL 36 HOUR AS opens, CAST(end_date AS TIMESTAMP) + INTERVAL 48 HOUR AS closes,
 CASE WHEN TIMESTAMP '2020-06-01' < CAST(start_date AS TIMESTAMP) - INTERVAL 14 DAY THEN 'dormant' WHEN TIMESTAMP '2020-06-01' < CAST(start_date AS TIMESTAMP) - INTERVAL 36 HOUR THEN 'upcoming' WHEN TIMESTAMP '2020-06-01' <= CAST(end_date AS TIMESTAMP) + INTERVAL 48 HOUR THEN 'live' WHEN TIMESTAMP '2020-06-01' <= CAST(end_date AS TIMESTAMP) + INTERVAL 30 DAY THEN 'cooling' ELSE 'archived' END AS state
FROM {EVENTS} WHERE start_date IS NOT NULL AND end_date IS NOT NULL
""")
def event_states(spark, d):
    """Live windows and the state of each event at a given time."""
    v = _once(spark, d, "dance_events", "event_id").filter("start_date is not null and end_date is not null")
    opens, closes = times.live_window(F.col("start_date"), F.col("end_date"))
    now = F.lit("2020-06-01 00:00:00").cast("timestamp_ntz")
    return v.select("event_id", opens.alias("opens"), closes.alias("closes"), times.event_state(F.col("start_date"), F.col("end_date"), now).alias("state"))


@query("""
SELECT a AS attempts, least(21600, 900 * pow(2, greatest(0, a - 1))) AS delay_s, least(7 * 86400, 3600 * pow(2, least(a, 12))) AS poll_s FROM (SELECT DISTINCT CAST(points AS INTEGER) AS a FROM registry_placements WHERE points IS NOT NULL)
""")
def backoff_delays(spark, d):
    """Doubling delays with a cap."""
    a = table(spark, d, "registry_placements").filter("points is not null").select(F.col("points").cast("int").alias("attempts")).distinct()
    return a.select("attempts", times.backoff(F.col("attempts")).alias("delay_s"), times.poll_interval(F.col("attempts")).alias("poll_s"))


@query("""
SELECT user_id, sum(gap) AS active_s, count(*) AS n FROM (SELECT user_id, least(1800, epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS gap FROM events) GROUP BY 1
""")
def timing_intervals(spark, d):
    """Seconds between a user's events, each at most half an hour."""
    from pyspark.sql import Window

    gap = F.least(F.lit(1800.0), times.seconds(F.col("ts")) - F.lag(times.seconds(F.col("ts"))).over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    return table(spark, d, "events").select("user_id", gap.alias("gap")).groupBy("user_id").agg(F.sum("gap").alias("active_s"), F.count("*").alias("n"))


@query(f"""
WITH t AS (SELECT placement_id, CAST(unnest(tally) AS VARCHAR) AS raw FROM {PLACEMENTS}),
m AS (SELECT placement_id, CASE CAST(raw AS DOUBLE) WHEN 10 THEN 'yes' WHEN 1 THEN 'yes' WHEN 4.5 THEN 'alt1' WHEN 2.1 THEN 'alt1' WHEN 4.3 THEN 'alt2' WHEN 2.2 THEN 'alt2' WHEN 4.2 THEN 'alt3' WHEN 2.3 THEN 'alt3' WHEN 0 THEN 'no' WHEN 3 THEN 'no' END AS kind FROM t)
SELECT placement_id, sum(CASE kind WHEN 'yes' THEN 10.0 WHEN 'alt1' THEN 4.5 WHEN 'alt2' THEN 4.3 WHEN 'alt3' THEN 4.2 ELSE 0.0 END) AS score_sum, count(*) FILTER (WHERE kind = 'yes') AS yes_count, count(*) FILTER (WHERE kind LIKE 'alt%') AS alt_count, count(*) FILTER (WHERE kind IS NULL) AS unknown_count
FROM m GROUP BY 1
""")
def mark_sums(spark, d):
    """Marks by meaning and value, summed per placement."""
    t = _once(spark, d, "placements", "placement_id").select("placement_id", F.explode("tally").alias("m")).withColumn("raw", F.col("m").cast("string"))
    kind = scoring.mark_kind(F.col("raw"))
    return t.groupBy("placement_id").agg(F.sum(scoring.mark_value(F.col("raw"))).alias("score_sum"), F.count_if(kind == "yes").alias("yes_count"), F.count_if(kind.startswith("alt")).alias("alt_count"), F.count_if(~scoring.known_mark(F.col("raw"))).alias("unknown_count"))


_TIERS = "CASE " + " ".join(f"WHEN n BETWEEN {a} AND {b} THEN CASE " + " ".join(f"WHEN place = {i + 1} THEN {p}" for i, p in enumerate(t)) + " WHEN n >= 80 AND place <= 15 THEN 2 WHEN n >= 20 AND place <= (CASE WHEN n >= 40 THEN 12 ELSE 10 END) THEN 1 ELSE 0 END" for a, b, t in scoring.TIERS) + " ELSE 0 END"


@query(f"""
WITH f AS (SELECT contest_id, count(*) AS n FROM {ENTRIES} GROUP BY 1) SELECT p.placement_id, {_TIERS} AS expected FROM {PLACEMENTS} p JOIN f USING (contest_id)
""")
def expected_points(spark, d):
    """Points each placement should bring by field size and place."""
    f = _once(spark, d, "entries", "entry_id").groupBy("contest_id").agg(F.count("*").alias("n"))
    p = _once(spark, d, "placements", "placement_id").select("placement_id", "contest_id", "place").join(f, "contest_id")
    return p.select("placement_id", scoring.expected_points(F.col("n"), F.col("place")).alias("expected"))


_LEVEL = "CASE lower({c}) " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in scoring.LEVELS.items()) + " END"


@query(f"""
SELECT r.wsdc_id, r.division, r.role, {_LEVEL.format(c='r.division')} BETWEEN {_LEVEL.format(c='w.required')} AND {_LEVEL.format(c='w.allowed')} AS division_ok
FROM (SELECT DISTINCT wsdc_id, division, role FROM registry_placements) r JOIN (SELECT wsdc_id, 'leader' AS role, leader_required_level AS required, leader_allowed_level AS allowed FROM {DANCERS} UNION ALL SELECT wsdc_id, 'follower', follower_required_level, follower_allowed_level FROM {DANCERS}) w USING (wsdc_id, role)
""")
def division_fit(spark, d):
    """Whether a division lies between a dancer's required and allowed levels; null where unknown."""
    w = _once(spark, d, "dancers", "wsdc_id")
    levels = w.select("wsdc_id", F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(f"{r}_required_level").alias("required"), F.col(f"{r}_allowed_level").alias("allowed")) for r in ("leader", "follower")])).alias("l")).select("wsdc_id", "l.*")
    r = table(spark, d, "registry_placements").select("wsdc_id", "division", "role").distinct()
    return r.join(levels, ["wsdc_id", "role"]).select("wsdc_id", "division", "role", scoring.division_ok(F.col("division"), F.col("required"), F.col("allowed")).alias("division_ok"))


@query(f"""
SELECT DISTINCT a.wsdc_id AS a, b.wsdc_id AS b, jaro_winkler_similarity({_PLAIN.format(c='a.first_name')}, {_PLAIN.format(c='b.first_name')}) AS similarity FROM {DANCERS} a JOIN {DANCERS} b ON a.last_name = b.last_name AND a.wsdc_id < b.wsdc_id AND substr(a.first_name, 1, 1) = substr(b.first_name, 1, 1)
""")
def similar_namesakes(spark, d):
    """Jaro-Winkler similarity of namesakes within a block of surname and initial."""
    w = _once(spark, d, "dancers", "wsdc_id").select("wsdc_id", text.plain(F.col("first_name")).alias("f"), "last_name", F.substring("first_name", 1, 1).alias("i"))
    j = w.select(F.col("wsdc_id").alias("a"), F.col("f").alias("fa"), "last_name", "i").join(w.select(F.col("wsdc_id").alias("b"), F.col("f").alias("fb"), "last_name", "i"), ["last_name", "i"]).filter("a < b")
    return j.select("a", "b", scoring.name_similarity(F.col("fa"), F.col("fb")).alias("similarity")).distinct()


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_fields(spark, d):
    """A field of a JSON column."""
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query(f"""
SELECT event_id, array_to_string(list_sort(list_distinct(sources)), ',') AS source_set, list_contains(sources, 'wdr') AS has_wdr, len(sources) AS n_sources FROM {EVENTS}
""")
def array_sets(spark, d):
    """Lists as sets, compared by value and not by text."""
    return _once(spark, d, "dance_events", "event_id").select("event_id", F.array_join(F.array_sort(F.array_distinct("sources")), ",").alias("source_set"), F.array_contains("sources", "wdr").alias("has_wdr"), F.size("sources").alias("n_sources"))


@query(f"""
SELECT entry_id, sha256('v' || contest_id || chr(31) || CASE WHEN role IS NULL THEN 'n' ELSE 'v' || role END || chr(31) || CASE WHEN bib IS NULL THEN 'n' ELSE 'v' || bib END) AS digest FROM {ENTRIES}
""")
def row_digests(spark, d):
    """A digest per row in which null and '' differ."""
    from tallyforge.operators.relational import row_digest

    return _once(spark, d, "entries", "entry_id").select("entry_id", row_digest([F.col("contest_id"), F.col("role"), F.col("bib")]).alias("digest"))


queries, oracle_sql = query.queries, query.oracle_sql
