"""What may be published: candidates on noisy names, conclusions, suppression, closure and gates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallyforge.functions import scoring, text
from tallyforge.operators import suppression as S
from tallyforge.operators.relational import components
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, DANCERS, ENTRIES, PLACEMENTS, _once
from tallyforge.session import table

query = Queries()

_PLAIN = "trim(regexp_replace(replace(lower(strip_accents({c})), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"


def _plain(c):
    return F.trim(F.regexp_replace(text.plain(c), "[^a-z0-9]+", " "))


# ---- candidates on noisy names -------------------------------------------------------------------------------------

_KEYED = """(SELECT n, unnest([split_part(n, ' ', -1), split_part(n, ' ', 1) || '<' || substr(split_part(n, ' ', -1), 1, 3), split_part(n, ' ', 1) || '>' || right(split_part(n, ' ', -1), 3)]) AS k FROM {t})"""
_NEAR = f"""e AS (SELECT DISTINCT {_PLAIN.format(c='name_raw')} AS n FROM {ENTRIES} WHERE entry_id NOT LIKE '%/C-%' AND NOT regexp_matches(name_raw, '(?i)\\s+and\\s+|[&/]')), w AS (SELECT DISTINCT {_PLAIN.format(c="first_name || ' ' || last_name")} AS n FROM {DANCERS} WHERE first_name IS NOT NULL AND last_name IS NOT NULL),
p AS (SELECT DISTINCT a.n AS printed, b.n AS registered FROM {_KEYED.format(t='e')} a JOIN {_KEYED.format(t='w')} b USING (k) WHERE contains(a.n, ' ') AND contains(b.n, ' ') AND substr(split_part(a.n, ' ', -1), 1, 1) = substr(split_part(b.n, ' ', -1), 1, 1)),
s AS (SELECT *, jaro_winkler_similarity(printed, registered) AS jw, list_sort(list_distinct(string_split(printed, ' '))) = list_sort(list_distinct(string_split(registered, ' '))) AS same_words FROM p)"""


def _keyed(df, name):
    """Names under their surname, and under their first word with either end of the surname: a slip in the surname leaves one end whole."""
    first, last = F.split_part("n", F.lit(" "), F.lit(1)), F.split_part("n", F.lit(" "), F.lit(-1))
    keys = F.array(last, F.concat(first, F.lit("<"), F.substring(last, 1, 3)), F.concat(first, F.lit(">"), F.right(last, F.lit(3))))
    return df.filter(F.contains("n", F.lit(" "))).select(F.col("n").alias(name), last.substr(1, 1).alias("initial"), F.explode(keys).alias("k"))


@F.pandas_udf(DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity of distinct pairs of names."""
    return pd.Series([scoring.jaro_winkler(x, y) for x, y in zip(a, b)], dtype="float64")


def _near_names(spark, d):
    """(printed, registered, jw, same_words): distinct printed names beside the registered ones they may be.

    Names meet on whole keys, never as all pairs of an initial's block, and each pair of distinct names is scored once.
    """
    e = table(spark, d, "entries").filter(~F.contains("entry_id", F.lit("/C-")) & ~F.col("name_raw").rlike(r"(?i)\s+and\s+|[&/]"))
    names = e.select(_plain(F.col("name_raw")).alias("n")).distinct()
    people = _once(spark, d, "dancers", "wsdc_id").select(_plain(F.concat("first_name", F.lit(" "), "last_name")).alias("n")).filter("n is not null").distinct()
    pairs = _keyed(names, "printed").join(_keyed(people, "registered"), ["initial", "k"]).select("printed", "registered").distinct()
    words = lambda c: F.array_sort(F.array_distinct(F.split(c, " ")))
    return pairs.withColumn("jw", _similarity("printed", "registered")).withColumn("same_words", words("printed") == words("registered"))


@query(f"WITH {_NEAR} SELECT printed, registered, jw, same_words FROM s WHERE jw >= 0.92 OR same_words")
def noisy_candidates(spark, d):
    """Registered names that a printed one may be, with their similarity; equal words in another order count as one."""
    return _near_names(spark, d).filter("jw >= 0.92 or same_words")


_ASSESSED = f"""{_NEAR}, c AS (SELECT e.entry_id, e.role, CAST(substr(e.event_id, 1, 4) AS INTEGER) AS y, e.wsdc_id AS printed_id, w.wsdc_id, w.primary_role, w.recent_year, CASE WHEN same_words THEN 1.0 ELSE jw END AS name_score FROM s JOIN (SELECT *, {_PLAIN.format(c='name_raw')} AS n FROM {ENTRIES} WHERE role IN ('leader', 'follower')) e ON e.n = printed JOIN (SELECT *, {_PLAIN.format(c="first_name || ' ' || last_name")} AS n FROM {DANCERS}) w ON w.n = registered WHERE jw >= 0.92 OR same_words),
a AS (SELECT *, CASE WHEN printed_id = wsdc_id THEN 1.0 ELSE (0.65 * name_score + 0.10 * CAST(coalesce(role = primary_role, FALSE) AS INTEGER) + 0.05 * CAST(coalesce(recent_year >= y - 3, FALSE) AS INTEGER)) / 0.80 END AS score FROM c)"""


def _assessed(spark, d):
    """Entries beside their candidates with a score that varies with the name; the division's weight is left out."""
    near = _near_names(spark, d).filter("jw >= 0.92 or same_words").select("printed", "registered", F.when(F.col("same_words"), 1.0).otherwise(F.col("jw")).alias("name_score"))
    e = _once(spark, d, "entries", "entry_id").filter(F.col("role").isin("leader", "follower") & ~F.contains("entry_id", F.lit("/C-")) & ~F.col("name_raw").rlike(r"(?i)\s+and\s+|[&/]"))
    e = e.select("entry_id", "role", F.substring("event_id", 1, 4).cast("int").alias("y"), F.col("wsdc_id").alias("printed_id"), _plain(F.col("name_raw")).alias("printed"))
    w = _once(spark, d, "dancers", "wsdc_id").select("wsdc_id", "primary_role", "recent_year", _plain(F.concat("first_name", F.lit(" "), "last_name")).alias("registered"))
    j = e.join(near, "printed").join(w, "registered")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    score = (0.65 * F.col("name_score") + 0.10 * flag(F.col("role") == F.col("primary_role")) + 0.05 * flag(F.col("recent_year") >= F.col("y") - 3)) / 0.80
    return j.select("entry_id", "wsdc_id", "printed_id", "name_score", F.when(F.col("printed_id") == F.col("wsdc_id"), 1.0).otherwise(score).alias("score"))


@query(f"WITH {_ASSESSED} SELECT entry_id, wsdc_id, name_score, score FROM a WHERE entry_id NOT LIKE '%/C-%'")
def assessed_candidates(spark, d):
    """Scored candidates of each entry on noisy names."""
    return _assessed(spark, d).select("entry_id", "wsdc_id", "name_score", "score")


@query(f"""
WITH {_ASSESSED}, b AS (SELECT entry_id, max(score) AS best, count(*) AS n, max(CASE WHEN printed_id = wsdc_id THEN 1 ELSE 0 END) AS by_id, list_sort(list(score))[-2] AS second FROM a GROUP BY 1),
r AS (SELECT DISTINCT a.entry_id FROM a JOIN {ENTRIES} e USING (entry_id) JOIN registry_placements p ON p.wsdc_id = a.wsdc_id AND p.event_id = e.event_id AND p.role = e.role)
SELECT e.entry_id, CASE WHEN regexp_matches(e.name_raw, '(?i)\\s+and\\s+|[&/]') OR e.entry_id LIKE '%/C-%' THEN 'withheld' WHEN by_id = 1 THEN 'source_id' WHEN r.entry_id IS NOT NULL AND n = 1 THEN 'registry_placement' WHEN best IS NULL THEN 'unmatched' WHEN best >= 0.9 AND (n = 1 OR second < best - 0.05) THEN 'probable' WHEN best >= 0.7 THEN 'possible' ELSE 'ambiguous' END AS conclusion
FROM {ENTRIES} e LEFT JOIN b USING (entry_id) LEFT JOIN r USING (entry_id)
""")
def full_conclusions(spark, d):
    """The conclusion on each entry: withheld, printed id, registry row, probable, possible, ambiguous or unmatched. The two best scores are partial maxima."""
    a = _assessed(spark, d)
    top = a.groupBy("entry_id").agg(F.max("score").alias("best"), F.count("*").alias("n"), F.max(F.coalesce(F.col("printed_id") == F.col("wsdc_id"), F.lit(False))).alias("by_id"))
    tied = a.join(top.select("entry_id", "best"), "entry_id").groupBy("entry_id").agg(F.count_if(F.col("score") == F.col("best")).alias("ties"), F.max(F.when(F.col("score") < F.col("best"), F.col("score"))).alias("below"))
    e = _once(spark, d, "entries", "entry_id").select("entry_id", "event_id", "role", "name_raw")
    r = table(spark, d, "registry_placements").select("wsdc_id", "event_id", "role").distinct()
    registered = a.select("entry_id", "wsdc_id").join(e.select("entry_id", "event_id", "role"), "entry_id").join(r, ["wsdc_id", "event_id", "role"], "left_semi").select("entry_id").distinct().withColumn("in_registry", F.lit(True))
    j = e.join(top, "entry_id", "left").join(tied, "entry_id", "left").join(registered, "entry_id", "left")
    second = F.when(F.col("ties") > 1, F.col("best")).otherwise(F.col("below"))
    several = F.col("name_raw").rlike(r"(?i)\s+and\s+|[&/]") | F.contains("entry_id", F.lit("/C-"))
    conclusion = (
        F.when(several, "withheld").when(F.col("by_id"), "source_id").when(F.col("in_registry") & (F.col("n") == 1), "registry_placement").when(F.col("best").isNull(), "unmatched")
        .when((F.col("best") >= 0.9) & ((F.col("n") == 1) | (second < F.col("best") - 0.05)), "probable").when(F.col("best") >= 0.7, "possible").otherwise("ambiguous")
    )
    return j.select("entry_id", conclusion.alias("conclusion"))


@query(f"""
WITH j AS (SELECT DISTINCT judge_id, {_PLAIN.format(c='name_raw')} AS n, wsdc_id FROM judges WHERE wsdc_id IS NOT NULL AND NOT anonymous), w AS (SELECT wsdc_id, {_PLAIN.format(c="first_name || ' ' || last_name")} AS r FROM {DANCERS})
SELECT judge_id, wsdc_id, n, contains(n, ' ') AND contains(r, ' ') AND split_part(n, ' ', -1) = split_part(r, ' ', -1) AND split_part(n, ' ', 1) = split_part(r, ' ', 1) AS supported FROM j JOIN w USING (wsdc_id)
""")
def judge_support(spark, d):
    """Whether a judge's printed name supports the dancer it is linked to: surname and first word, each as a whole."""
    j = table(spark, d, "judges").filter("wsdc_id is not null and not anonymous").select("judge_id", _plain(F.col("name_raw")).alias("n"), "wsdc_id").distinct()
    w = _once(spark, d, "dancers", "wsdc_id").select("wsdc_id", _plain(F.concat("first_name", F.lit(" "), "last_name")).alias("r"))
    part = lambda c, i: F.split_part(c, F.lit(" "), F.lit(i))
    both = F.contains("n", F.lit(" ")) & F.contains("r", F.lit(" "))
    return j.join(w, "wsdc_id").select("judge_id", "wsdc_id", "n", (both & (part("n", -1) == part("r", -1)) & (part("n", 1) == part("r", 1))).alias("supported"))


# ---- suppression ---------------------------------------------------------------------------------------------------

_COVERED = f"""s AS (SELECT entry_id AS subject, wsdc_id, name_norm AS name FROM {ENTRIES} UNION ALL SELECT judge_id, wsdc_id, NULL FROM judges),
g AS (SELECT subject, '#' || wsdc_id AS node FROM s WHERE wsdc_id IS NOT NULL UNION SELECT subject, '~' || name FROM s WHERE name <> ''),
c(subject) AS (SELECT entry_id FROM {ENTRIES} WHERE lower(entry_id) IN (SELECT lower(trim(record_key)) FROM removals WHERE reason = 'suppression' AND table_name = 'entries')
 UNION SELECT b.subject FROM c JOIN g a ON a.subject = c.subject JOIN g b ON b.node = a.node)"""


def _covered(spark, d):
    e, j = _once(spark, d, "entries", "entry_id"), table(spark, d, "judges")
    subjects = e.select(F.col("entry_id").alias("subject"), "wsdc_id", F.col("name_norm").alias("name")).unionByName(j.select(F.col("judge_id").alias("subject"), "wsdc_id", F.lit(None).cast("string").alias("name")))
    gone = table(spark, d, "removals").filter("reason = 'suppression' and table_name = 'entries'").select(F.lower(F.trim("record_key")).alias("k")).distinct()
    seeds = e.withColumn("k", F.lower("entry_id")).join(gone, "k", "left_semi").select(F.col("entry_id").alias("subject"))
    return S.learned_subjects(subjects, seeds)


@query(f"WITH RECURSIVE {_COVERED} SELECT DISTINCT subject FROM c")
def suppressed_subjects(spark, d):
    """Every subject that a suppression covers, learned over ids and names until nothing is new."""
    return _covered(spark, d).select("subject").distinct()


@query(f"""WITH RECURSIVE {_COVERED} SELECT CASE WHEN hit AND contains(judge_id, '/judge/') THEN 'suppressed-' || substr(sha256('suppressed-subject-v1|' || judge_id), 1, 24) ELSE judge_id END AS judge_id, CASE WHEN NOT hit THEN name_raw END AS name_raw, CASE WHEN NOT hit THEN wsdc_id END AS wsdc_id, hit AS suppressed
FROM (SELECT DISTINCT judge_id, name_raw, wsdc_id, judge_id IN (SELECT subject FROM c) AS hit FROM judges)""")
def suppressed_judges(spark, d):
    """Judges with covered ones nulled and their name-bearing ids replaced."""
    j = table(spark, d, "judges").select("judge_id", "name_raw", "wsdc_id").distinct()
    return S.scrub_subjects(j, _covered(spark, d), "judge_id", ["name_raw", "wsdc_id"])


@query(f"""WITH RECURSIVE {_COVERED}, i AS (SELECT DISTINCT s.wsdc_id FROM s JOIN c USING (subject) WHERE s.wsdc_id IS NOT NULL)
SELECT placement_id, CASE WHEN NOT l THEN leader_wsdc_id END AS leader_wsdc_id, CASE WHEN NOT f THEN follower_wsdc_id END AS follower_wsdc_id, CASE WHEN l OR f THEN FALSE ELSE registry_confirmed END AS registry_confirmed
FROM (SELECT *, coalesce(leader_entry_id IN (SELECT subject FROM c), FALSE) OR coalesce(leader_wsdc_id IN (SELECT wsdc_id FROM i), FALSE) OR coalesce(couple_entry_id IN (SELECT subject FROM c), FALSE) AS l, coalesce(follower_entry_id IN (SELECT subject FROM c), FALSE) OR coalesce(follower_wsdc_id IN (SELECT wsdc_id FROM i), FALSE) OR coalesce(couple_entry_id IN (SELECT subject FROM c), FALSE) AS f FROM {PLACEMENTS})""")
def suppressed_placements(spark, d):
    """Placements without the ids of covered sides; what rests on them is no longer confirmed."""
    covered = _covered(spark, d).select("subject").distinct()
    e, j = _once(spark, d, "entries", "entry_id"), table(spark, d, "judges")
    ids = e.select(F.col("entry_id").alias("subject"), "wsdc_id").unionByName(j.select(F.col("judge_id").alias("subject"), "wsdc_id")).join(covered, "subject", "left_semi").filter("wsdc_id is not null").select("wsdc_id").distinct()
    p = _once(spark, d, "placements", "placement_id")
    for c, other in (("leader_entry_id", covered), ("follower_entry_id", covered), ("couple_entry_id", covered), ("leader_wsdc_id", ids), ("follower_wsdc_id", ids)):
        p = p.join(other.select(F.col(other.columns[0]).alias(c)).withColumn(f"_{c}", F.lit(True)), c, "left")
    hit = lambda *cs: F.coalesce(*[F.col(f"_{c}") for c in cs], F.lit(False))
    left, right = hit("leader_entry_id", "leader_wsdc_id", "couple_entry_id"), hit("follower_entry_id", "follower_wsdc_id", "couple_entry_id")
    return p.select("placement_id", F.when(~left, F.col("leader_wsdc_id")).alias("leader_wsdc_id"), F.when(~right, F.col("follower_wsdc_id")).alias("follower_wsdc_id"), F.when(left | right, False).otherwise(F.col("registry_confirmed")).alias("registry_confirmed"))


@query(f"""WITH RECURSIVE {_COVERED}, i AS (SELECT DISTINCT s.wsdc_id FROM s JOIN c USING (subject) WHERE s.wsdc_id IS NOT NULL) SELECT release_no, count(*) AS n_rows, count(*) FILTER (WHERE wsdc_id IN (SELECT wsdc_id FROM i)) AS dropped FROM link_snapshots GROUP BY 1""")
def suppressed_history(spark, d):
    """Rows of the link history per release, and those dropped because they concern a covered id."""
    covered = _covered(spark, d).select("subject").distinct()
    e, j = _once(spark, d, "entries", "entry_id"), table(spark, d, "judges")
    ids = e.select(F.col("entry_id").alias("subject"), "wsdc_id").unionByName(j.select(F.col("judge_id").alias("subject"), "wsdc_id")).join(covered, "subject", "left_semi").filter("wsdc_id is not null").select("wsdc_id").distinct().withColumn("hit", F.lit(True))
    return table(spark, d, "link_snapshots").join(ids, "wsdc_id", "left").groupBy("release_no").agg(F.count("*").alias("n_rows"), F.count("hit").alias("dropped"))


@query(r"""
SELECT file_name, line_no, body, regexp_replace(body, '(?i)(:\s*|[\[,]\s*)"[^"\\]*\b(?:delta|amber)\b[^"\\]*"(\s*[,}\]])', '\1null\2', 'g') AS scrubbed FROM (SELECT DISTINCT file_name, line_no, body FROM raw_receipts WHERE json_valid(body) AND NOT contains(body, '\'))
""")
def scrubbed_bodies(spark, d):
    """JSON lines without string values that hold a sensitive word, at any depth; keys stay."""
    r = table(spark, d, "raw_receipts").filter(F.expr("try_parse_json(body) is not null") & ~F.contains("body", F.lit("\\"))).select("file_name", "line_no", "body").distinct()
    return r.select("file_name", "line_no", "body", S.scrub_json(F.col("body"), ["(?:delta|amber)"]).alias("scrubbed"))


# ---- closure and gates ---------------------------------------------------------------------------------------------

@query(f"""
WITH RECURSIVE x AS (SELECT DISTINCT wsdc_id, event_id FROM {ENTRIES} WHERE wsdc_id IS NOT NULL AND event_id IS NOT NULL), bad AS (SELECT DISTINCT event_id FROM contests WHERE parse_status <> 'parsed' AND event_id IS NOT NULL),
r(event_id) AS (SELECT event_id FROM bad UNION SELECT b.event_id FROM r JOIN x a ON a.event_id = r.event_id JOIN x b ON b.wsdc_id = a.wsdc_id)
SELECT event_id, event_id IN (SELECT event_id FROM bad) AS itself FROM r
""")
def withheld_connected(spark, d):
    """Events withheld because they, or events that share a linked dancer with them directly or in steps, hold what was not read.

    The components of dancers and events, of which those with a bad event are withheld as a whole.
    """
    x = _once(spark, d, "entries", "entry_id").filter("wsdc_id is not null and event_id is not null").select(F.concat(F.lit("w"), F.col("wsdc_id").cast("string")).alias("a"), F.concat(F.lit("v"), "event_id").alias("b")).distinct()
    bad = table(spark, d, "contests").filter("parse_status <> 'parsed' and event_id is not null").select(F.concat(F.lit("v"), "event_id").alias("node")).distinct()
    comp = components(x, "a", "b")
    hit = comp.join(bad, "node", "left_semi").select("component").distinct()
    reached = comp.join(hit, "component", "left_semi").filter(F.col("node").startswith("v")).select("node").unionByName(bad).distinct()
    return reached.join(bad.withColumn("itself", F.lit(True)), "node", "left").select(F.substring("node", 2, 1_000_000).alias("event_id"), F.coalesce("itself", F.lit(False)).alias("itself"))


_MEASURES = "SELECT event_id, count(*) FILTER (WHERE {w}) AS entries, count(*) FILTER (WHERE {w} AND link_status = 'confirmed') AS confirmed FROM " + ENTRIES + " WHERE event_id IS NOT NULL GROUP BY 1"


@query(f"""
WITH b AS ({_MEASURES.format(w="first_seen_at < TIMESTAMP '2024-09-01'")}), c AS ({_MEASURES.format(w="last_seen_at >= TIMESTAMP '2024-04-01'")}),
f AS (SELECT lower(trim(record_key)) AS event_id FROM removals WHERE table_name = 'dance_events' AND record_key IS NOT NULL)
SELECT event_id, b.entries AS base, c.entries AS now, CASE WHEN c.entries >= b.entries AND c.confirmed >= b.confirmed THEN 'ok' WHEN lower(event_id) IN (SELECT event_id FROM f) THEN 'approved' WHEN c.entries = 0 THEN 'vanished' WHEN c.entries < b.entries THEN 'fewer entries' ELSE 'fewer links' END AS verdict FROM b JOIN c USING (event_id)
""")
def gate_verdicts(spark, d):
    """Each event's measures against the baseline: a decrease needs an approval, here a removal that names the event."""
    ts = lambda t: F.lit(t).cast("timestamp_ntz")
    old, new, ok = F.col("first_seen_at") < ts("2024-09-01 00:00:00"), F.col("last_seen_at") >= ts("2024-04-01 00:00:00"), F.col("link_status") == "confirmed"
    m = _once(spark, d, "entries", "entry_id").filter("event_id is not null").groupBy("event_id").agg(F.count_if(old).alias("base"), F.count_if(new).alias("now"), F.count_if(old & ok).alias("b"), F.count_if(new & ok).alias("c"))
    floors = table(spark, d, "removals").filter("table_name = 'dance_events' and record_key is not null").select(F.lower(F.trim("record_key")).alias("k")).distinct().withColumn("approved", F.lit(True))
    j = m.withColumn("k", F.lower("event_id")).join(floors, "k", "left")
    verdict = F.when((F.col("now") >= F.col("base")) & (F.col("c") >= F.col("b")), "ok").when(F.col("approved"), "approved").when(F.col("now") == 0, "vanished").when(F.col("now") < F.col("base"), "fewer entries").otherwise("fewer links")
    return j.select("event_id", "base", "now", verdict.alias("verdict"))


@query("""
WITH g AS (SELECT family, file_name, count(*) AS n, count(*) FILTER (WHERE json_valid(body)) AS readable, count(*) FILTER (WHERE body IS NULL OR trim(body) = '') AS empty, count(DISTINCT line_no) AS numbers, count(DISTINCT body) AS bodies, max(line_no) AS last, min(loaded_at) < min(recorded_at) AS early, count(*) FILTER (WHERE json_valid(body) AND CASE WHEN json_valid(body) THEN json_extract_string(body, '$.step') END IS NULL) AS stepless, count(*) FILTER (WHERE json_valid(body) AND CASE WHEN json_valid(body) THEN json_extract_string(body, '$.format') END IS NULL) AS formatless FROM raw_receipts GROUP BY 1, 2)
SELECT file_name, guard FROM (SELECT file_name, unnest([CASE WHEN readable = 0 THEN 'nothing readable' END, CASE WHEN empty > 0 THEN 'empty lines' END, CASE WHEN readable < n - empty THEN 'broken lines' END, CASE WHEN numbers < n THEN 'repeated line numbers' END, CASE WHEN bodies < n - empty THEN 'repeated bodies' END, CASE WHEN last <> numbers THEN 'missing lines' END, CASE WHEN early THEN 'loaded before recorded' END, CASE WHEN stepless > 0 THEN 'lines without step' END, CASE WHEN formatless = readable AND readable > 0 THEN 'no format' END, CASE WHEN n < 3 THEN 'too short' END]) AS guard FROM g) WHERE guard IS NOT NULL
""")
def contract_evaluation(spark, d):
    """The guards each receipt file fails, of ten."""
    r = table(spark, d, "raw_receipts").withColumn("ok", F.expr("try_parse_json(body) is not null"))
    field = lambda f: F.get_json_object("body", f"$.{f}").isNull()
    g = r.groupBy("family", "file_name").agg(
        F.count("*").alias("n"), F.count_if("ok").alias("readable"), F.count_if(F.col("body").isNull() | (F.trim("body") == "")).alias("empty"), F.countDistinct("line_no").alias("numbers"), F.countDistinct("body").alias("bodies"),
        F.max("line_no").alias("last"), (F.min("loaded_at") < F.min("recorded_at")).alias("early"), F.count_if(F.col("ok") & field("step")).alias("stepless"), F.count_if(F.col("ok") & field("format")).alias("formatless"),
    )
    guards = {
        "nothing readable": "readable = 0", "empty lines": "empty > 0", "broken lines": "readable < n - empty", "repeated line numbers": "numbers < n", "repeated bodies": "bodies < n - empty",
        "missing lines": "last <> numbers", "loaded before recorded": "early", "lines without step": "stepless > 0", "no format": "formatless = readable and readable > 0", "too short": "n < 3",
    }
    return g.select("file_name", F.explode(F.array(*[F.when(F.expr(c), k) for k, c in guards.items()])).alias("guard")).filter("guard is not null")


@query(f"""
WITH p AS (SELECT e.entry_id, e.wsdc_id, e.link_status, e.role, e.name_raw, w.wsdc_id IS NOT NULL AS known, EXISTS (SELECT 1 FROM registry_placements r WHERE r.wsdc_id = e.wsdc_id AND r.event_id = e.event_id AND r.role = e.role) AS supported, c.contest_id IS NOT NULL AS bound, coalesce(c.parse_status = 'parsed', FALSE) AS usable, lower(e.entry_id) IN (SELECT lower(trim(record_key)) FROM removals WHERE table_name = 'entries' AND record_key IS NOT NULL) AS removed
 FROM {ENTRIES} e LEFT JOIN {DANCERS} w ON w.wsdc_id = e.wsdc_id LEFT JOIN {CONTESTS} c ON c.contest_id = e.contest_id WHERE e.wsdc_id IS NOT NULL)
SELECT entry_id, reason, CASE WHEN reason LIKE 'accepted%' THEN wsdc_id END AS published FROM (SELECT *, CASE WHEN link_status IS DISTINCT FROM 'confirmed' THEN 'assertion_not_confirmed' WHEN role = 'couple' OR regexp_matches(coalesce(name_raw, ''), '(?i)\\s+and\\s+|[&/]') THEN 'individual_ownership_unavailable' WHEN NOT bound THEN 'source_reference_unavailable' WHEN removed THEN 'current_decision_withholds' WHEN NOT known THEN 'printed_source_identity_unavailable' WHEN NOT usable THEN 'source_interpretation_unavailable' WHEN supported THEN 'accepted' ELSE 'registry_identity_support_unavailable' END AS reason FROM p)
""")
def publication_policy(spark, d):
    """Whether each entry's id may be published, by the first reason that applies; ids that may not are nulled."""
    e = _once(spark, d, "entries", "entry_id").filter("wsdc_id is not null").select("entry_id", "wsdc_id", "link_status", "role", "name_raw", "event_id", "contest_id").withColumn("k", F.lower("entry_id"))
    w = table(spark, d, "dancers").select("wsdc_id").distinct().withColumn("known", F.lit(True))
    r = table(spark, d, "registry_placements").select("wsdc_id", "event_id", "role").dropna().distinct().withColumn("supported", F.lit(True))
    c = _once(spark, d, "contests", "contest_id").select("contest_id", F.lit(True).alias("bound"), F.coalesce(F.col("parse_status") == "parsed", F.lit(False)).alias("usable"))
    gone = table(spark, d, "removals").filter("table_name = 'entries' and record_key is not null").select(F.lower(F.trim("record_key")).alias("k")).distinct().withColumn("removed", F.lit(True))
    j = e.join(w, "wsdc_id", "left").join(r, ["wsdc_id", "event_id", "role"], "left").join(c, "contest_id", "left").join(gone, "k", "left")
    reason = (
        F.when(~F.col("link_status").eqNullSafe(F.lit("confirmed")), "assertion_not_confirmed").when((F.col("role") == "couple") | F.coalesce("name_raw", F.lit("")).rlike(r"(?i)\s+and\s+|[&/]"), "individual_ownership_unavailable")
        .when(F.col("bound").isNull(), "source_reference_unavailable").when(F.col("removed"), "current_decision_withholds").when(F.col("known").isNull(), "printed_source_identity_unavailable")
        .when(~F.col("usable"), "source_interpretation_unavailable").when(F.col("supported"), "accepted").otherwise("registry_identity_support_unavailable")
    )
    return j.select("entry_id", reason.alias("reason"), F.when(reason.startswith("accepted"), F.col("wsdc_id")).alias("published"))


@query(f"""
WITH h AS (SELECT entry_id, link_status AS status, CASE link_status WHEN 'ambiguous' THEN 'several candidates' WHEN 'possible' THEN 'weak evidence' WHEN 'unmatched' THEN 'no candidate' END AS summary FROM {ENTRIES} WHERE link_status IN ('ambiguous', 'possible', 'unmatched'))
SELECT 'identity' AS kind, h.entry_id AS subject, summary FROM h UNION ALL SELECT 'repeat', contest_id || '|' || role || '|' || name_norm, 'one name on several bibs' FROM {ENTRIES} WHERE name_norm <> '' AND role IS NOT NULL GROUP BY contest_id, role, name_norm HAVING count(*) > 1
""")
def resolution_findings(spark, d):
    """What resolution leaves to a reviewer, one row a finding."""
    e = _once(spark, d, "entries", "entry_id")
    why = {"ambiguous": "several candidates", "possible": "weak evidence", "unmatched": "no candidate"}
    one = e.filter(F.col("link_status").isin(*why)).select(F.lit("identity").alias("kind"), F.col("entry_id").alias("subject"), F.coalesce(*[F.when(F.col("link_status") == k, v) for k, v in why.items()]).alias("summary"))
    many = e.filter("name_norm <> '' and role is not null").groupBy("contest_id", "role", "name_norm").agg(F.count("*").alias("n")).filter("n > 1")
    return one.unionByName(many.select(F.lit("repeat").alias("kind"), F.concat_ws("|", "contest_id", "role", "name_norm").alias("subject"), F.lit("one name on several bibs").alias("summary")))


queries, oracle_sql = query.queries, query.oracle_sql
