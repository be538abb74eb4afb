"""The vocabulary of contests, rounds, roles, cells and names applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.functions import contests as C
from tallyforge.functions import scoring, text
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, DANCERS, ENTRIES, EVENTS, _once
from tallyforge.session import table

query = Queries()

# Names as other sources print them, beside those of the table.
PRINTED = [
    "Pro-Am Novice Followers", "ProAm Open Routine", "Sophisticated Jack and Jill", "Masters Jack & Jill Leaders", "Junior Strictly", "Country Classic",
    "CSDC Newcomer Jack and Jill", "Lindy Hop Open", "All-Star and Champion Jack n Jill", "Hustle Showcase", "Rising Star", "Invitational Strictly Swing", "Novice Jack & Jill Sunday 2",
]
_VALUES = "(VALUES " + ", ".join(f"('{n}')" for n in PRINTED) + ") AS v(name)"
_NAMES = f"(SELECT DISTINCT name_raw AS name FROM contests WHERE name_raw IS NOT NULL UNION SELECT name FROM {_VALUES})"


def _names(spark, d):
    known = table(spark, d, "contests").filter("name_raw is not null").select(F.col("name_raw").alias("name"))
    return known.unionByName(spark.createDataFrame([(n,) for n in PRINTED], "name string")).distinct()


_CLASSIFIED = f"""n AS (SELECT name, trim(regexp_replace(replace(lower(name), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS v FROM {_NAMES}),
c AS (SELECT name, v, string_split(v, ' ') AS w,
 CASE WHEN v LIKE '%newcomer%' THEN 'newcomer' WHEN v LIKE '%novice%' THEN 'novice' WHEN v LIKE '%intermediate%' THEN 'intermediate' WHEN v LIKE '%advanced%' THEN 'advanced'
  WHEN v LIKE '%all star%' OR v LIKE '%allstar%' THEN 'allstar' WHEN v LIKE '%champion%' THEN 'champion' WHEN v LIKE '%invit%' THEN 'invitational' WHEN v LIKE '%open%' THEN 'open' ELSE 'none' END AS division,
 CASE WHEN v LIKE '%junior%' THEN 'juniors' WHEN v LIKE '%soph%' THEN 'sophisticated' WHEN v LIKE '%master%' THEN 'masters' ELSE 'none' END AS age_division,
 CASE WHEN v LIKE '%jack%' AND v LIKE '%jill%' THEN 'jack_and_jill' WHEN v LIKE '%strictly%' THEN 'strictly' WHEN v LIKE '%classic%' THEN 'classic' WHEN v LIKE '%showcase%' THEN 'showcase'
  WHEN v LIKE '%pro am%' OR v LIKE '%proam%' THEN 'pro_am' WHEN v LIKE '%rising star%' THEN 'rising_star' ELSE 'other' END AS contest_type,
 CASE WHEN v LIKE '%lindy%' THEN 'lindy' WHEN v LIKE '%country%' OR list_contains(string_split(v, ' '), 'csdc') THEN 'country' WHEN v LIKE '%hustle%' THEN 'other' ELSE 'wcs' END AS dance_style FROM n)"""


@query(f"""
WITH {_CLASSIFIED}
SELECT name, division, age_division, contest_type, CASE WHEN contest_type = 'jack_and_jill' THEN 'random_partner' WHEN contest_type IN ('strictly', 'other') THEN 'open_couple' ELSE 'perm_couple' END AS partner_mode, dance_style,
 CASE WHEN len(m) > 1 THEN array_to_string(m, ',') ELSE '' END AS combined_from
FROM (SELECT *, [x FOR x IN ['newcomer', 'novice', 'intermediate', 'advanced', 'allstar', 'champion'] IF contains(v, CASE x WHEN 'allstar' THEN 'all star' ELSE x END)] AS m FROM c)
""")
def contest_vocabulary(spark, d):
    """The six fields that a contest's name says."""
    n = _names(spark, d)
    known = C.classify(F.col("name"))
    known["combined_from"] = F.array_join(known["combined_from"], ",")
    return n.select("name", *[c.alias(k) for k, c in known.items()])


_USED = """list_concat(['division', 'wcs', 'wsdc', 'west', 'coast'], CASE WHEN v LIKE '%pro am%' OR list_contains(w, 'proam') THEN [] ELSE ['leader', 'leaders', 'follower', 'followers'] END,
 CASE contest_type WHEN 'jack_and_jill' THEN ['jack', 'jill', 'and', 'n'] WHEN 'strictly' THEN ['strictly', 'swing'] WHEN 'classic' THEN ['classic', 'routine', 'routines'] WHEN 'showcase' THEN ['showcase', 'routine', 'routines']
  WHEN 'pro_am' THEN ['pro', 'am', 'proam', 'routine', 'routines'] WHEN 'rising_star' THEN ['rising', 'star', 'routine', 'routines'] ELSE [] END,
 CASE division WHEN 'allstar' THEN ['all', 'star', 'stars', 'allstar'] WHEN 'champion' THEN ['champion', 'champions'] WHEN 'invitational' THEN ['invitational', 'invit'] ELSE [division] END,
 CASE age_division WHEN 'juniors' THEN ['junior', 'juniors'] WHEN 'sophisticated' THEN ['sophisticated', 'soph'] WHEN 'masters' THEN ['master', 'masters'] ELSE [] END,
 CASE dance_style WHEN 'country' THEN ['country', 'csdc'] WHEN 'lindy' THEN ['lindy'] ELSE ['swing'] END)"""
_QUALIFIED = f"{_CLASSIFIED}, q AS (SELECT *, CASE WHEN contest_type = 'other' THEN '' ELSE coalesce(array_to_string(list_filter(w, lambda x: NOT list_contains({_USED}, x)), '-'), '') END AS qualifier FROM c)"


@query(f"""
WITH {_QUALIFIED}
SELECT name, qualifier, array_to_string([x FOR x IN [CASE WHEN dance_style <> 'wcs' THEN dance_style END, CASE WHEN age_division <> 'none' THEN age_division END, CASE WHEN division <> 'none' THEN division END,
  CASE contest_type WHEN 'jack_and_jill' THEN 'jj' WHEN 'pro_am' THEN 'pro-am' WHEN 'rising_star' THEN 'rising-star' WHEN 'other' THEN coalesce(nullif(trim(regexp_replace(replace(lower(strip_accents(name)), 'ß', 'ss'), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') ELSE contest_type END, nullif(qualifier, '')] IF x IS NOT NULL], '-') AS slug,
 dance_style = 'wcs' AND contest_type = 'jack_and_jill' AND division NOT IN ('none', 'open', 'invitational') AND qualifier = '' AS eligible FROM q
""")
def contest_slugs(spark, d):
    """The slug of a contest's name, the words that nothing accounts for, and whether it may bring points."""
    n = F.col("name")
    return _names(spark, d).select("name", C.qualifier(n).alias("qualifier"), C.contest_slug(n).alias("slug"), C.points_eligible(n).alias("eligible"))


@query(f"""
WITH c AS (SELECT contest_id, event_id, name_raw, source, row_number() OVER (PARTITION BY event_id, name_raw ORDER BY contest_id) AS k FROM {CONTESTS})
SELECT contest_id, CASE WHEN k = 1 THEN event_id || '/' || s ELSE event_id || '/' || s || '-' || k END AS made_id
FROM (SELECT *, coalesce(nullif(trim(regexp_replace(replace(lower(strip_accents(name_raw)), 'ß', 'ss'), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') AS s FROM c WHERE name_raw IS NOT NULL)
""")
def contest_made_ids(spark, d):
    """Ids of contests from their event and name; equal names of an event are numbered from two on."""
    from pyspark.sql import Window

    c = _once(spark, d, "contests", "contest_id").filter("name_raw is not null")
    k = F.row_number().over(Window.partitionBy("event_id", "name_raw").orderBy("contest_id"))
    base = F.concat_ws("/", "event_id", text.slug(F.col("name_raw")))
    return c.withColumn("k", k).select("contest_id", F.when(F.col("k") == 1, base).otherwise(F.concat_ws("-", base, "k")).alias("made_id"))


_ROUNDS = ["Finals", "Semi-Finals", "Quarterfinal 2", "Prelims", "Round 3", "Preliminary round 12", "FINAL 1", "semi", "Heat B"]


@query("""
WITH r AS (SELECT DISTINCT best_round AS label FROM entries WHERE best_round IS NOT NULL UNION SELECT * FROM (VALUES ('Finals'), ('Semi-Finals'), ('Quarterfinal 2'), ('Prelims'), ('Round 3'), ('Preliminary round 12'), ('FINAL 1'), ('semi'), ('Heat B')))
SELECT label, CASE WHEN lower(label) LIKE '%final%' AND lower(label) NOT LIKE '%semi%' AND lower(label) NOT LIKE '%quarter%' THEN 'final' WHEN lower(label) LIKE '%semi%' THEN 'semifinal' WHEN lower(label) LIKE '%quarter%' THEN 'quarterfinal' ELSE 'prelim' END AS round_type,
 coalesce(TRY_CAST(nullif(regexp_extract(label, '(?i)\\b(?:round\\s*)?(\\d+)\\b', 1), '') AS INTEGER), 1) AS round_number FROM r
""")
def round_labels(spark, d):
    """Type and number of a round from its label."""
    shown = table(spark, d, "entries").filter("best_round is not null").select(F.col("best_round").alias("label"))
    r = shown.unionByName(spark.createDataFrame([(x,) for x in _ROUNDS], "label string")).distinct()
    return r.select("label", C.round_type(F.col("label")).alias("round_type"), C.round_number(F.col("label")).alias("round_number"))


_CELLS = f"""(SELECT e.entry_id, e.name_raw AS cell, c.name_raw AS contest, CASE WHEN e.role IN ('leader', 'follower', 'couple') THEN e.role ELSE '' END AS header, CASE WHEN contains(e.name_raw, '&') OR contains(lower(e.name_raw), ' and ') THEN 1 ELSE 2 END AS n_columns FROM {ENTRIES} e JOIN {CONTESTS} c USING (contest_id) WHERE e.name_raw IS NOT NULL AND c.name_raw IS NOT NULL)"""


def _cells(spark, d):
    e, c = _once(spark, d, "entries", "entry_id"), _once(spark, d, "contests", "contest_id")
    j = e.select("entry_id", F.col("name_raw").alias("cell"), "role", "contest_id").join(c.select("contest_id", F.col("name_raw").alias("contest")), "contest_id").filter("cell is not null and contest is not null")
    header = F.when(F.col("role").isin("leader", "follower", "couple"), F.col("role")).otherwise("")
    joined = F.contains(F.col("cell"), F.lit("&")) | F.contains(F.lower("cell"), F.lit(" and "))
    return j.select("entry_id", "cell", "contest", header.alias("header"), F.when(joined, 1).otherwise(2).alias("n_columns"))


@query(f"""
WITH x AS (SELECT *, lower(header || ' ' || contest) AS b, lower(contest) AS k, [trim(p) FOR p IN regexp_split_to_array(cell, '(?i)\\s+and\\s+|\\s*[&/]\\s*')] AS people, regexp_extract(cell, '(?is)^(.*?)\\s+and\\s+(.*)$', ['a', 'b']) AS h FROM {_CELLS}),
y AS (SELECT *, len(people) > 1 AND len([p FOR p IN people IF p = '']) = 0 AS several, header <> 'couple' AND n_columns = 1 AND contains(k, 'jack') AND contains(k, 'jill') AND trim(h.a) <> '' AND trim(h.b) <> '' AS splits,
 CASE WHEN header = 'couple' THEN 'couple' WHEN contains(b, 'follower') THEN 'follower' WHEN contains(b, 'leader') THEN 'leader' WHEN header = '' AND n_columns = 2 THEN 'leader' WHEN n_columns = 1 AND (contains(b, 'strictly') OR contains(b, 'classic') OR contains(b, 'showcase')) THEN 'couple' ELSE 'leader' END AS role FROM x)
SELECT entry_id, 'leader' AS role, trim(h.a) AS name FROM y WHERE splits UNION ALL SELECT entry_id, 'follower', trim(h.b) FROM y WHERE splits
UNION ALL SELECT entry_id, CASE WHEN several THEN 'couple' ELSE role END, cell FROM y WHERE NOT splits
""")
def competitor_cells(spark, d):
    """One row per competitor of a cell, with the role it dances."""
    x = _cells(spark, d)
    people = C.competitors(F.col("cell"), F.col("header"), F.col("contest"), F.col("n_columns"), F.lit(0))
    return x.select("entry_id", F.explode(people).alias("p")).select("entry_id", "p.role", "p.name")


@query(f"""
WITH b AS (SELECT entry_id, CASE WHEN role = 'couple' THEN bib || '/' || (CAST(bib AS INTEGER) + 1) ELSE bib END AS bib FROM {ENTRIES} WHERE TRY_CAST(bib AS INTEGER) IS NOT NULL)
SELECT entry_id, r.role, CASE WHEN contains(bib, '/') THEN split_part(bib, '/', CASE r.role WHEN 'leader' THEN 1 ELSE 2 END) ELSE bib END AS role_bib FROM b, (VALUES ('leader'), ('follower')) AS r(role)
""")
def role_bibs(spark, d):
    """The bib of either role from a cell that may hold both."""
    e = _once(spark, d, "entries", "entry_id").withColumn("n", F.col("bib").try_cast("int")).filter("n is not null")
    shown = F.when(F.col("role") == "couple", F.concat_ws("/", "bib", (F.col("n") + 1).cast("string"))).otherwise(F.col("bib"))
    both = e.select("entry_id", shown.alias("bib"), F.explode(F.array(F.lit("leader"), F.lit("follower"))).alias("role"))
    return both.select("entry_id", "role", C.bib_of(F.col("bib"), F.col("role")).alias("role_bib"))


@query(f"""SELECT DISTINCT name, trim(regexp_replace(regexp_replace(name, '(?i)\\b(?:leaders?|followers?)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS shown FROM (SELECT name FROM {_NAMES} UNION SELECT name || ' Leaders' FROM {_NAMES})""")
def display_names(spark, d):
    """Contest names without the words of a role."""
    n = _names(spark, d)
    both = n.unionByName(n.select(F.concat("name", F.lit(" Leaders")).alias("name"))).distinct()
    return both.select("name", C.display_name(F.col("name")).alias("shown"))


@query(f"SELECT event_id, trim(regexp_replace(replace(lower(strip_accents(name)), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g')) AS plain_name FROM {EVENTS}")
def event_names(spark, d):
    """Event names without differences of presentation."""
    return _once(spark, d, "dance_events", "event_id").select("event_id", text.event_name(F.col("name")).alias("plain_name"))


@query(f"""
WITH k AS (SELECT lower(nickname) AS nick, min(lower(canonical)) AS owner FROM nicknames GROUP BY 1),
w AS (SELECT wsdc_id, lower(strip_accents(first_name)) AS f, lower(strip_accents(last_name)) AS l FROM {DANCERS} WHERE regexp_matches(first_name, '^\\pL+$') AND regexp_matches(last_name, '^\\pL+$') AND lower(last_name) NOT IN ('jr', 'sr', 'ii', 'iii')),
o AS (SELECT wsdc_id, l, coalesce(k.owner, f) AS owner FROM w LEFT JOIN k ON k.nick = f)
SELECT a.wsdc_id AS a, b.wsdc_id AS b FROM o a JOIN o b ON a.l = b.l AND a.owner = b.owner AND a.wsdc_id < b.wsdc_id
""")
def nickname_pairs(spark, d):
    """Dancers of one surname whose first names are one by the nickname table: an equality join on the owner of the name, not a comparison of pairs."""
    k = table(spark, d, "nicknames").groupBy(F.lower("nickname").alias("f")).agg(F.min(F.lower("canonical")).alias("owner"))
    w = _once(spark, d, "dancers", "wsdc_id").filter(F.col("first_name").rlike(r"^\p{L}+$") & F.col("last_name").rlike(r"^\p{L}+$") & ~F.lower("last_name").isin(*text.SUFFIXES))
    o = w.select("wsdc_id", text.plain(F.col("first_name")).alias("f"), text.plain(F.col("last_name")).alias("l")).join(k, "f", "left").select("wsdc_id", "l", F.coalesce("owner", "f").alias("owner"))
    return o.select(F.col("wsdc_id").alias("a"), "l", "owner").join(o.select(F.col("wsdc_id").alias("b"), "l", "owner"), ["l", "owner"]).filter("a < b").select("a", "b")


@query("""
WITH b AS (SELECT family, file_name, line_no, TRY_CAST(json_extract_string(body, '$.duration_seconds') AS DOUBLE) AS n FROM raw_receipts WHERE json_valid(body)),
v AS (SELECT file_name, CASE line_no % 6 WHEN 0 THEN '10.0' WHEN 1 THEN ' Y ' WHEN 2 THEN '4.50' WHEN 3 THEN 'Alt2' WHEN 4 THEN '03' ELSE 'x' END AS raw FROM raw_receipts)
SELECT DISTINCT raw, CASE raw WHEN '10.0' THEN 'yes' WHEN ' Y ' THEN 'yes' WHEN '4.50' THEN 'alt1' WHEN 'Alt2' THEN 'alt2' ELSE 'no' END AS kind, CASE raw WHEN '10.0' THEN 10.0 WHEN ' Y ' THEN 10.0 WHEN '4.50' THEN 4.5 WHEN 'Alt2' THEN 4.3 ELSE 0.0 END AS value, raw <> 'x' AS known FROM v
""")
def mark_readings(spark, d):
    """What printed marks mean; numbers count however they are written."""
    cases = ["10.0", " Y ", "4.50", "Alt2", "03"]
    raw = F.coalesce(*[F.when(F.col("line_no") % 6 == i, F.lit(c)) for i, c in enumerate(cases)], F.lit("x"))
    r = table(spark, d, "raw_receipts").select(raw.alias("raw")).distinct()
    return r.select("raw", scoring.mark_kind(F.col("raw")).alias("kind"), scoring.mark_value(F.col("raw")).cast("double").alias("value"), scoring.known_mark(F.col("raw")).alias("known"))


queries, oracle_sql = query.queries, query.oracle_sql
