"""Event projection over score-sheet lines: one line per entry and round, with judges' marks, and one per final couple."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyforge.operators import projection as P
from tallyforge.plans.registry import Queries
from tallyforge.plans.relational import CONTESTS, ENTRIES, PLACEMENTS, _once

query = Queries()

# A line's five marks are told by the digits of a hash of its entry and round; the sixth to ninth digit gives a blank or a repeat.
_MARK = "CASE WHEN contains('01234', h) THEN '10' WHEN contains('567', h) THEN '4.50' WHEN contains('89', h) THEN 'a2' WHEN h = 'a' THEN '4.2' WHEN h = 'b' THEN NULL ELSE 'N' END"
_LINES = f"""l AS (SELECT e.entry_id AS src, e.contest_id, c.name_raw AS contest, r.round AS round, e.source, e.last_seen_at AS observed_at, e.snapshot_id, CASE WHEN e.entry_id LIKE '%/C-%' THEN 'couple' WHEN e.entry_id LIKE '%/F-%' THEN 'follower' ELSE 'leader' END AS header, e.bib, e.name_raw AS name, md5(e.entry_id || '|' || r.round) AS h
 FROM {ENTRIES} e JOIN {CONTESTS} c USING (contest_id), (SELECT unnest(rounds_danced) AS round, entry_id FROM {ENTRIES}) r WHERE r.entry_id = e.entry_id AND e.name_raw IS NOT NULL AND c.name_raw IS NOT NULL),
k AS (SELECT *, CASE WHEN header <> 'couple' AND len([x FOR x IN [trim(y) FOR y IN regexp_split_to_array(name, '(?i)\\s+and\\s+|\\s*[&/]\\s*')]]) > 1 AND len([x FOR x IN [trim(y) FOR y IN regexp_split_to_array(name, '(?i)\\s+and\\s+|\\s*[&/]\\s*')] IF x = '']) = 0 THEN 'couple' WHEN header = 'couple' THEN 'couple' WHEN contains(lower(header || ' ' || contest), 'follower') THEN 'follower' ELSE header END AS role FROM l),
q AS (SELECT *, contest_id || '/' || CASE role WHEN 'leader' THEN 'L' WHEN 'follower' THEN 'F' ELSE 'C' END || '-' || CASE WHEN coalesce(bib, '') <> '' THEN bib ELSE 'name-' || coalesce(nullif(trim(regexp_replace(replace(lower(strip_accents(name)), 'ß', 'ss'), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'unknown') END AS entry_id, CASE round WHEN 'prelim' THEN 1 WHEN 'quarterfinal' THEN 2 WHEN 'semifinal' THEN 3 ELSE 4 END AS rank FROM k),
m AS (SELECT q.*, j.judge, {_MARK.replace('h =', 'substr(h, j.judge, 1) =').replace(', h)', ', substr(h, j.judge, 1))')} AS raw FROM q, (SELECT unnest(range(1, 6)) AS judge) j),
v AS (SELECT *, CASE raw WHEN '10' THEN 'yes' WHEN '4.50' THEN 'alt1' WHEN 'a2' THEN 'alt2' WHEN '4.2' THEN 'alt3' ELSE 'no' END AS kind, CASE raw WHEN '10' THEN 10.0 WHEN '4.50' THEN 4.5 WHEN 'a2' THEN 4.3 WHEN '4.2' THEN 4.2 ELSE 0.0 END AS value FROM m WHERE raw IS NOT NULL)"""


def _lines(spark, d):
    e, c = _once(spark, d, "entries", "entry_id"), _once(spark, d, "contests", "contest_id")
    j = e.select("entry_id", "contest_id", "source", F.col("last_seen_at").alias("observed_at"), "snapshot_id", "bib", F.col("name_raw").alias("cell"), F.explode("rounds_danced").alias("round"))
    j = j.join(c.select("contest_id", F.col("name_raw").alias("contest")), "contest_id").filter("cell is not null and contest is not null")
    header = F.when(F.col("entry_id").contains("/C-"), "couple").when(F.col("entry_id").contains("/F-"), "follower").otherwise("leader")
    h = F.md5(F.concat_ws("|", "entry_id", "round"))

    def mark(i):
        x = F.substring(h, i, 1)
        return F.when(x.isin(*"01234"), "10").when(x.isin(*"567"), "4.50").when(x.isin(*"89"), "a2").when(x == "a", "4.2").when(x == "b", F.lit(None)).otherwise("N")

    return j.select("contest_id", "contest", "round", "source", "observed_at", "snapshot_id", header.alias("header"), F.lit(2).alias("n_columns"), "bib", "cell", F.array(*[mark(i) for i in range(1, 6)]).alias("marks"))


@query(f"""
WITH {_LINES} SELECT contest_id, round, round AS round_type, CAST(row_number() OVER (PARTITION BY contest_id ORDER BY rank, round) AS INTEGER) AS round_order, n_lines, 5 AS n_judges, CASE WHEN n10 > 0 THEN 'wsdc_10' ELSE 'unknown' END AS legend
FROM (SELECT contest_id, round, rank, count(DISTINCT src) AS n_lines, count(*) FILTER (WHERE raw IN ('10', '4.2')) AS n10 FROM m GROUP BY 1, 2, 3)
""")
def project_rounds(spark, d):
    """Rounds of contests in order, with lines, judges and the legend their marks follow."""
    return P.rounds_of(_lines(spark, d))


@query(f"""
WITH {_LINES} SELECT entry_id, contest_id, role, max(struct_pack(a := observed_at, b := snapshot_id, c := name)).c AS name, CASE max(rank) WHEN 1 THEN 'prelim' WHEN 2 THEN 'quarterfinal' WHEN 3 THEN 'semifinal' ELSE 'final' END AS best_round, count(DISTINCT round) AS n_rounds, count(DISTINCT name) AS names FROM q GROUP BY 1, 2, 3
""")
def project_entries(spark, d):
    """Entries of contests by the evidence of highest precedence."""
    return P.entries_of(_lines(spark, d))


@query(f"WITH {_LINES} SELECT entry_id, contest_id, round, CAST(judge AS INTEGER) AS judge, raw, kind, value, TRUE AS known FROM v")
def project_marks(spark, d):
    """Every printed mark with its meaning."""
    return P.marks_of(_lines(spark, d)).withColumn("value", F.col("value").cast("double"))


_CALLED = f"""{_LINES},
s AS (SELECT entry_id, contest_id, round, rank, sum(value) AS score, count(*) FILTER (WHERE kind = 'yes') AS yes, count(*) FILTER (WHERE kind LIKE 'alt%') AS alternates, count(*) FILTER (WHERE kind = 'no') AS no FROM v GROUP BY 1, 2, 3, 4),
a AS (SELECT s.*, EXISTS (SELECT 1 FROM s n WHERE n.entry_id = s.entry_id AND n.rank > s.rank) AS advanced FROM s),
b AS (SELECT *, min(CASE WHEN advanced THEN score END) OVER (PARTITION BY contest_id, round) AS cut FROM a WHERE rank < 4),
o AS (SELECT entry_id, round, round(score, 6) AS score, yes, alternates, no, CASE WHEN advanced THEN 'promoted' WHEN cut IS NOT NULL AND score < cut THEN 'eliminated' END AS outcome FROM b)"""


@query(f"WITH {_CALLED} SELECT * FROM o")
def project_callbacks(spark, d):
    """Callback sums and outcomes, derived from who dances the next round."""
    return P.callbacks_of(_lines(spark, d)).withColumn("score", F.round(F.col("score").cast("double"), 6))


@query(f"WITH {_CALLED} SELECT round, outcome, count(*) AS n, max(score) AS best, count(DISTINCT entry_id) AS entries FROM o GROUP BY 1, 2")
def callback_outcomes(spark, d):
    """Callbacks by round and outcome; an open outcome counts apart."""
    o = P.callbacks_of(_lines(spark, d)).withColumn("score", F.round(F.col("score").cast("double"), 6))
    return o.groupBy("round", "outcome").agg(F.count("*").alias("n"), F.max("score").alias("best"), F.countDistinct("entry_id").alias("entries"))


@query(f"""WITH {_CALLED} SELECT entry_id, CASE max(CASE outcome WHEN 'promoted' THEN 2 WHEN 'eliminated' THEN 1 END) WHEN 2 THEN 'promoted' WHEN 1 THEN 'eliminated' END AS outcome FROM o GROUP BY 1""")
def merged_outcomes(spark, d):
    """The strongest outcome of each entry over its rounds."""
    return P.callbacks_of(_lines(spark, d)).groupBy("entry_id").agg(P.merged_outcome(F.col("outcome")).alias("outcome"))


@query(f"WITH {_LINES} SELECT contest_id, role, bib AS role_bib, count(DISTINCT round) AS rounds FROM q WHERE bib IS NOT NULL GROUP BY 1, 2, 3 HAVING bool_or(regexp_matches(trim(name), '^\\*{{3,}}$'))")
def hidden_bibs(spark, d):
    """Bibs whose name is redacted in any round: all their rounds are."""
    return P.hidden_names(_lines(spark, d))


@query(f"WITH {_LINES}, t AS (SELECT placement_id, contest_id, source, unnest(tally) AS m FROM {PLACEMENTS} WHERE tally IS NOT NULL) SELECT contest_id, 'final' AS round, CASE WHEN source = 'eepro' THEN 'raw scores' ELSE 'unknown marks' END AS reason FROM t GROUP BY contest_id, source HAVING bool_or(m NOT IN (0, 1, 3, 10))")
def scoring_gate(spark, d):
    """Finals whose marks are ranks and no callback marks, so that none are projected."""
    p = _once(spark, d, "placements", "placement_id").filter("tally is not null")
    return P.unsupported_scoring(p.select("contest_id", F.lit("final").alias("round"), "source", F.col("tally").cast("array<string>").alias("marks")))


@query(f"""WITH {_LINES}, n AS (SELECT entry_id, name, max(observed_at) AS t FROM q GROUP BY 1, 2), w AS (SELECT entry_id, max(struct_pack(a := observed_at, b := snapshot_id, c := name)).c AS kept FROM q GROUP BY 1)
SELECT n.entry_id, kept, name AS dropped FROM n JOIN w USING (entry_id) WHERE name <> kept""")
def name_conflicts(spark, d):
    """Names of lower precedence that differ from the one an entry keeps."""
    c = P.competitors_of(_lines(spark, d)).withColumn("entry_id", P.entry_key(F.col("contest_id"), F.col("role"), F.col("role_bib"), F.col("name")))
    kept = c.groupBy("entry_id").agg(F.max(F.struct("observed_at", "snapshot_id", "name")).getField("name").alias("kept"))
    return c.select("entry_id", F.col("name").alias("dropped")).distinct().join(kept, "entry_id").filter("dropped <> kept").select("entry_id", "kept", "dropped")


queries, oracle_sql = query.queries, query.oracle_sql
