"""Page scans. Each query writes one page per row of a table in a source's format, and parses the pages back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import times
from tallyforge.operators import relational as R
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import DANCERS, EVENTS, PLACEMENTS, _once
from tallyforge.session import cut, table
from tallyforge.sources.pages import account_fields, decode, parse_pages

query = Queries()


def _scan(df, key, kind, body):
    pages = df.select(F.col(key).cast("string").alias("page_id"), F.lit(kind).alias("kind"), body.alias("body"))
    return decode(parse_pages(pages), kind)


def _escape(c):
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _placements(spark, d):
    return _once(spark, d, "placements", "placement_id").filter("tally is not null")


_TALLY = f"(SELECT placement_id, place, unnest(tally) AS mark, generate_subscripts(tally, 1) AS judge FROM {PLACEMENTS})"


@query(f"SELECT placement_id AS page_id, place, judge, mark FROM {_TALLY}")
def scan_round_sheet(spark, d):
    """HTML score sheets: headings, a header cell spanning the judges, cells with attributes."""
    cells = F.array_join(F.transform("tally", lambda x: F.concat(F.lit("<td>"), x.cast("string"), F.lit("</td>"))), "")
    body = F.concat(F.lit("<html><h2>Contest Final</h2><table><tr><th>Place</th><th colspan=\""), F.size("tally").cast("string"), F.lit("\">Judge</th></tr><tr><td data-row=\"1\">"), F.col("place").cast("string"), F.lit("</td>"), cells, F.lit("</tr></table>"))
    rows = _scan(_placements(spark, d), "placement_id", "round_sheet", body)
    place = F.element_at(F.filter("cells", lambda c: c["header"] == "Place"), 1)["text"].cast("tinyint")
    marks = F.posexplode(F.filter("cells", lambda c: c["header"].startswith("Judge"))).alias("i", "c")
    return rows.select("page_id", place.alias("place"), marks).select("page_id", "place", (F.col("i") + 1).cast("long").alias("judge"), F.col("c.text").cast("tinyint").alias("mark"))


@query(f"SELECT event_id AS page_id, name AS name_raw, CAST(start_date AS VARCHAR) AS date_raw, city AS location_raw, country AS country_code_raw FROM {EVENTS} WHERE name IS NOT NULL AND city IS NOT NULL AND start_date IS NOT NULL AND country IS NOT NULL")
def scan_calendar(spark, d):
    """An HTML calendar."""
    v = _once(spark, d, "dance_events", "event_id").filter("name is not null and city is not null and start_date is not null and country is not null")
    body = F.concat(F.lit("<table><tr><th>Event</th><th>Date</th><th>Location</th></tr><tr><td>"), _escape(F.col("name")), F.lit("</td><td>"), F.col("start_date").cast("string"), F.lit('</td><td data-country="'), F.col("country"), F.lit('">'), _escape(F.col("city")), F.lit("</td></tr></table>"))
    return _scan(v, "event_id", "calendar", body).select("page_id", "name_raw", "date_raw", "location_raw", "country_code_raw")


@query(f"SELECT event_id AS page_id, website AS source_ref, name AS name_raw FROM {EVENTS} WHERE website IS NOT NULL AND name IS NOT NULL")
def scan_event_index(spark, d):
    """A listing page's links."""
    v = _once(spark, d, "dance_events", "event_id").filter("website is not null and name is not null")
    body = F.concat(F.lit('<ul><li><a class="x" href="'), F.col("website"), F.lit('"><b>'), F.col("name"), F.lit("</b></a></li></ul>"))
    return _scan(v, "event_id", "event_index", body).select("page_id", "source_ref", "name_raw")


@query("SELECT file_name AS page_id, file_name AS name, strftime(min(recorded_at), '%Y-%m-%d %H:%M') AS modified, count(*) AS size FROM raw_receipts GROUP BY 1")
def scan_directory(spark, d):
    """A directory listing with times and sizes."""
    f = table(spark, d, "raw_receipts").groupBy("file_name").agg(F.date_format(F.min("recorded_at"), "yyyy-MM-dd HH:mm").alias("m"), F.count("*").alias("n"))
    body = F.concat(F.lit('<pre><a href="?C=N">Name</a>\n<a href="'), F.col("file_name"), F.lit('">'), F.col("file_name"), F.lit("</a>   "), F.col("m"), F.lit("  "), F.col("n").cast("string"))
    return _scan(f, "file_name", "directory", body).select("page_id", "name", "modified", "size")


@query(f"SELECT event_id AS page_id, website AS loc, CAST(start_date AS VARCHAR) AS lastmod FROM {EVENTS} WHERE website IS NOT NULL AND start_date IS NOT NULL")
def scan_sitemap(spark, d):
    """An XML sitemap."""
    v = _once(spark, d, "dance_events", "event_id").filter("website is not null and start_date is not null")
    body = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><url><loc>'), _escape(F.col("website")), F.lit("</loc><lastmod>"), F.col("start_date").cast("string"), F.lit("</lastmod></url></urlset>"))
    return _scan(v, "event_id", "sitemap", body).select("page_id", "loc", "lastmod")


@query("SELECT CAST(wsdc_id AS INTEGER) AS wsdc_id, role AS role_raw, division AS division_raw, event_id AS event_id_raw, CAST(points AS INTEGER) AS points FROM registry_placements WHERE wsdc_id IS NOT NULL AND role IS NOT NULL")
def scan_registry_lookup(spark, d):
    """A registry's JSON with nested placements by role."""
    r = table(spark, d, "registry_placements").filter("wsdc_id is not null and role is not null")
    one = F.struct(F.col("division"), F.col("event_id").alias("event"), F.col("result"), F.col("points"))
    body = F.to_json(F.struct(F.struct(F.col("wsdc_id").alias("id")).alias("dancer"), F.create_map(F.col("role"), F.array(one)).alias("placements")))
    rows = _scan(r, "wsdc_id", "registry_lookup", body)
    return rows.select("wsdc_id", F.explode_outer("placements").alias("p")).select("wsdc_id", "p.role_raw", "p.division_raw", "p.event_id_raw", "p.points")


@query(f"SELECT placement_id AS page_id, contest_id AS contest, place AS bib, judge, mark FROM (SELECT placement_id, contest_id, CAST(place AS VARCHAR) AS place, unnest(tally) AS mark, generate_subscripts(tally, 1) AS judge FROM {PLACEMENTS})")
def scan_rounds_json(spark, d):
    """Rounds nested in one JSON tree."""
    sheet = F.struct(F.array(F.struct(F.col("place").cast("string").alias("bib"), F.transform("tally", lambda x: x.cast("int")).alias("marks"))).alias("rows"))
    body = F.to_json(F.struct(F.create_map(F.col("contest_id"), F.create_map(F.lit("final"), sheet)).alias("contests")))
    return _scan(_placements(spark, d), "placement_id", "rounds_json", body).select("page_id", "contest", "bib", "judge", "mark")


@query(f"SELECT placement_id AS page_id, CAST(place AS INTEGER) AS place, leader_entry_id AS leader, follower_entry_id AS follower FROM {PLACEMENTS} WHERE tally IS NOT NULL")
def scan_awards_json(spark, d):
    """Award lists in JSON; missing people stay null."""
    body = F.to_json(F.struct(F.array(F.struct("place", F.col("leader_entry_id").alias("leader"), F.col("follower_entry_id").alias("follower"))).alias("awards")))
    return _scan(_placements(spark, d), "placement_id", "awards_json", body).select("page_id", "place", "leader", "follower")


@query(f"SELECT event_id AS page_id, name AS title, CAST(start_date AS VARCHAR) AS starts FROM {EVENTS} WHERE name IS NOT NULL")
def scan_calendar_script(spark, d):
    """A calendar literal in a script: bare keys, single quotes, trailing commas."""
    v = _once(spark, d, "dance_events", "event_id").filter("name is not null")
    title = F.replace(F.col("name"), F.lit("'"), F.lit("\\'"))
    start = F.when(F.col("start_date").isNull(), "null").otherwise(F.concat(F.lit("'"), F.col("start_date").cast("string"), F.lit("'")))
    body = F.concat(F.lit("<script>$('#cal').fullCalendar({ events: [ { title: '"), title, F.lit("', start: "), start, F.lit(", }, ], });</script>"))
    return _scan(v, "event_id", "calendar_script", body).select("page_id", "title", F.col("start").alias("starts"))


@query(f"SELECT wsdc_id AS page_id, first_name AS name, wsdc_id / 100.0 AS lat, -wsdc_id / 50.0 AS lng FROM (SELECT CAST(wsdc_id AS VARCHAR) AS page, * FROM {DANCERS}) WHERE first_name IS NOT NULL".replace("wsdc_id AS page_id", "page AS page_id"))
def scan_map_markers(spark, d):
    """Markers of a map script."""
    w = _once(spark, d, "dancers", "wsdc_id").filter("first_name is not null")
    body = F.concat(F.lit('addMarker({"name": "'), F.col("first_name"), F.lit('", lat: '), F.format_string("%.2f", F.col("wsdc_id") / 100.0), F.lit(", lng: "), F.format_string("%.2f", -F.col("wsdc_id") / 50.0), F.lit("});"))
    return _scan(w, "wsdc_id", "map_markers", body).select("page_id", "name", "lat", "lng")


@query(f"SELECT event_id AS page_id, event_id, name, city, wsdc_status = 'registry' AS live FROM {EVENTS} WHERE name IS NOT NULL")
def scan_state_page(spark, d):
    """A page state in a function call, read without running it."""
    v = _once(spark, d, "dance_events", "event_id").filter("name is not null")
    quote = lambda c: F.when(F.col(c).isNull(), "null").otherwise(F.to_json(F.array(F.col(c))).substr(F.lit(2), F.length(F.to_json(F.array(F.col(c)))) - 2))
    live = F.when(F.col("wsdc_status").isNull(), "null").when(F.col("wsdc_status") == "registry", "!0").otherwise("!1")
    body = F.concat(F.lit("<script>window.__NUXT__=(function(a,b,c){return {layout:\"default\",data:[{event:{id:a,name:b,city:c,live:"), live, F.lit("}}]}}("), quote("event_id"), F.lit(","), quote("name"), F.lit(","), quote("city"), F.lit("));</script>"))
    return _scan(v, "event_id", "state_page", body).select("page_id", "event_id", "name", "city", "live")


@query(f"SELECT placement_id AS page_id, CAST(place AS VARCHAR) AS place, coalesce(marks_sorted, '') AS marks FROM {PLACEMENTS} WHERE tally IS NOT NULL")
def scan_positioned_text(spark, d):
    """Words at positions: columns by the header's left edges."""
    word = lambda x, y, t: F.struct(F.lit(1).alias("page"), F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"), t.alias("text"))
    body = F.to_json(F.array(word(10, 20, F.lit("Place")), word(80, 20, F.lit("Marks")), word(12, 40, F.col("place").cast("string")), word(81, 40, F.coalesce("marks_sorted", F.lit("")))))
    return _scan(_placements(spark, d), "placement_id", "positioned_text", body).select("page_id", F.col("columns")[0].alias("place"), F.col("columns")[1].alias("marks"))


@query(f"SELECT event_id AS page_id, name, CAST(start_date AS VARCHAR) AS dates FROM {EVENTS} WHERE name IS NOT NULL AND start_date IS NOT NULL")
def scan_text_layout(spark, d):
    """Fixed-position columns of a newsletter's text."""
    v = _once(spark, d, "dance_events", "event_id").filter("name is not null and start_date is not null")
    body = F.concat(F.rpad(F.lit("EVENT"), 60, " "), F.lit("DATES\n"), F.rpad("name", 60, " "), F.col("start_date").cast("string"), F.lit("\n\n"))
    return _scan(v, "event_id", "text_layout", body).select("page_id", "name", "dates")


@query(f"""
WITH c AS (SELECT event_id, CAST(place AS VARCHAR) AS status, strftime(first_seen_at, '%Y%m%d%H%M%S') AS ts, marks_sorted AS digest, placement_id FROM {PLACEMENTS} WHERE marks_sorted IS NOT NULL AND first_seen_at IS NOT NULL),
u AS (SELECT *, row_number() OVER (PARTITION BY event_id, digest ORDER BY ts DESC, placement_id) AS n FROM c WHERE status = '1')
SELECT event_id, ts AS timestamp, digest FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, placement_id) AS k FROM u WHERE n = 1) WHERE k <= 3
""")
def scan_capture_index(spark, d):
    """An archive's capture index, and the selection from it: wanted status, one per digest, the newest three."""
    p = _once(spark, d, "placements", "placement_id").filter("marks_sorted is not null and first_seen_at is not null")
    row = F.array(F.date_format("first_seen_at", "yyyyMMddHHmmss"), F.concat_ws("|", "event_id", "placement_id"), F.col("place").cast("string"), F.col("marks_sorted"))
    body = F.to_json(F.array(F.array(*[F.lit(x) for x in ("timestamp", "original", "statuscode", "digest")]), row))
    c = _scan(p, "placement_id", "capture_index", body).filter("statuscode = '1'").withColumn("event_id", F.split_part("original", F.lit("|"), F.lit(1)))
    once = R.top_k(c, ["event_id", "digest"], [F.col("timestamp").desc(), F.col("page_id")], 1)
    return R.top_k(once, ["event_id"], [F.col("timestamp").desc(), F.col("page_id")], 3).select("event_id", "timestamp", "digest")


@query("""
SELECT kind, field, count(*) AS n FROM (SELECT 'awards_json' AS kind, unnest(['place', 'leader', 'follower']) AS field FROM placements WHERE tally IS NOT NULL) GROUP BY 1, 2
""")
def scan_field_accounting(spark, d):
    """Which fields the observations of a kind bring, and how often."""
    p = table(spark, d, "placements").filter("tally is not null")
    body = F.to_json(F.struct(F.array(F.struct("place", F.col("leader_entry_id").alias("leader"), F.col("follower_entry_id").alias("follower"))).alias("awards")))
    pages = p.select(F.col("placement_id").alias("page_id"), F.lit("awards_json").alias("kind"), body.alias("body"))
    return account_fields(parse_pages(pages))


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN body IS NULL OR body = '' THEN 'empty' ELSE 'page' END AS reason FROM raw_receipts) WHERE reason = 'empty' GROUP BY 1")
def scan_empty_bodies(spark, d):
    """Empty bodies give no observation: pages whose body is empty are parsed with all others and counted where nothing came out."""
    r = table(spark, d, "raw_receipts").select(F.monotonically_increasing_id().cast("string").alias("page_id"), F.lit("awards_json").alias("kind"), "body")
    pages = cut(r, "pages")  # numbers of rows are drawn once
    silent = pages.join(parse_pages(pages).select("page_id").distinct(), "page_id", "left_anti")
    return silent.filter("body is null or body = ''").agg(F.count("*").alias("n")).filter("n > 0").select(F.lit("empty").alias("reason"), "n")


@query(f"""
SELECT event_id, start_date AS starts, end_date AS ends FROM {EVENTS} WHERE start_date IS NOT NULL AND end_date IS NOT NULL AND start_date <= end_date
""")
def scan_printed_ranges(spark, d):
    """Printed date ranges, within a month and across months, read back."""
    v = _once(spark, d, "dance_events", "event_id").filter("start_date is not null and end_date is not null and start_date <= end_date")
    same = F.date_format("start_date", "yyyyMM") == F.date_format("end_date", "yyyyMM")
    day = lambda c, f: F.date_format(c, f)
    printed = (
        F.when(same, F.concat(day("start_date", "MMM d"), F.lit(" - "), day("end_date", "d, yyyy")))
        .when(F.year("start_date") == F.year("end_date"), F.concat(day("start_date", "MMM d"), F.lit(" - "), day("end_date", "MMM d, yyyy")))
        .otherwise(F.concat(day("start_date", "MMM d, yyyy"), F.lit(" - "), day("end_date", "MMM d, yyyy")))
    )
    starts, ends = times.date_range(F.col("printed"))
    return v.select("event_id", printed.alias("printed")).select("event_id", starts.alias("starts"), ends.alias("ends"))


@query(f"""
SELECT contest_id AS page_id, CAST(row_number() OVER (PARTITION BY contest_id ORDER BY place, placement_id) - 1 AS INTEGER) AS line, CAST(place AS VARCHAR) AS place, coalesce(array_to_string(tally, ' '), '') AS marks, coalesce(trim(leader_entry_id), '') AS leader FROM {PLACEMENTS} WHERE contest_id IS NOT NULL AND place IS NOT NULL
""")
def scan_contest_sheets(spark, d):
    """Score sheets of whole contests: one page each with all its rows, blank cells where marks or people are missing."""
    p = _once(spark, d, "placements", "placement_id").filter("contest_id is not null and place is not null")
    cell = lambda c: F.concat(F.lit("<td>"), _escape(F.coalesce(c, F.lit(""))), F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), cell(F.col("place").cast("string")), cell(F.array_join(F.col("tally").cast("array<string>"), " ")), cell(F.col("leader_entry_id")), F.lit("</tr>"))
    # A contest's rows are one page, whose size the domain bounds.
    pages = p.groupBy("contest_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "placement_id", row.alias("html")))), lambda x: x["html"]), "\n").alias("rows"))
    body = F.concat(F.lit("<h2>Novice Final</h2>\n<table><tr><th>Place</th><th>Marks</th><th>Leader</th></tr>\n"), F.col("rows"), F.lit("\n</table>"))
    text_of = lambda h: F.element_at(F.filter("cells", lambda c: c["header"] == h), 1)["text"]
    lines = _scan(pages, "contest_id", "round_sheet", body)
    return lines.select("page_id", (F.col("seq")).alias("line"), text_of("Place").alias("place"), text_of("Marks").alias("marks"), text_of("Leader").alias("leader"))


@query(f"""
SELECT coalesce(event_month, 'none') AS page_id, coalesce(name, '') AS name_raw, coalesce(CAST(start_date AS VARCHAR), '') AS date_raw, coalesce(city, '') AS location_raw FROM {EVENTS}
""")
def scan_calendar_months(spark, d):
    """HTML calendars of whole months: every event of the month, with empty cells where a field is missing."""
    v = _once(spark, d, "dance_events", "event_id")
    cell = lambda c: F.concat(F.lit("<td>"), _escape(F.coalesce(c, F.lit(""))), F.lit("</td>"))
    row = F.concat(F.lit("<tr>"), cell(F.col("name")), cell(F.col("start_date").cast("string")), cell(F.col("city")), F.lit("</tr>"))
    pages = v.groupBy(F.coalesce("event_month", F.lit("none")).alias("month")).agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    body = F.concat(F.lit("<table><tr><th>Event</th><th>Date</th><th>Location</th></tr>"), F.col("rows"), F.lit("</table>"))
    return _scan(pages, "month", "calendar", body).select("page_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("name_raw", "date_raw", "location_raw")])


queries, oracle_sql = query.queries, query.oracle_sql
