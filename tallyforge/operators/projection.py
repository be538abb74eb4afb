"""From printed score-sheet lines to rounds, entries, marks, callbacks and findings.

A line is a row of a result table of a round's sheet: contest_id, contest (its printed name), round (its label), source,
observed_at, snapshot_id, header and n_columns of its competitor columns, bib, cell (the competitor cell) and marks
(one text per judge, null where a judge's cell is blank). All steps are column expressions and keyed aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions import contests as C
from tallyforge.functions import scoring
from tallyforge.functions.text import slug

# Rounds in their order, and outcomes from the weakest to the strongest.
ROUND_ORDER = ["prelim", "quarterfinal", "semifinal", "final"]
OUTCOMES = ["eliminated", "alternate", "alternate_3", "alternate_2", "alternate_1", "promoted"]
REDACTED = r"^\*{3,}$"
NEW_LEGEND, OLD_LEGEND = ["10", "4.5", "4.3", "4.2"], ["1", "2.1", "2.2", "2.3", "3"]


def round_rank(kind):
    """The place of a round's type in the order of rounds, from 1."""
    return F.array_position(F.array(*[F.lit(r) for r in ROUND_ORDER]), kind).cast("int")


def competitors_of(lines: DataFrame) -> DataFrame:
    """lines with role, name and role_bib, one row per competitor of each line."""
    people = C.competitors(F.col("cell"), F.col("header"), F.col("contest"), F.col("n_columns"), F.lit(0))
    split = lines.withColumn("p", F.explode(people)).withColumn("role", F.col("p.role")).withColumn("name", F.col("p.name")).drop("p")
    return split.withColumn("role_bib", C.bib_of(F.col("bib"), F.col("role")))


def entry_key(contest, role, bib, name):
    """contest/L-12 by role and bib, or contest/L-name-... where there is no bib."""
    letter = F.when(role == "leader", "L").when(role == "follower", "F").otherwise("C")
    return F.concat(contest, F.lit("/"), letter, F.lit("-"), F.when(F.coalesce(bib, F.lit("")) != "", bib).otherwise(F.concat(F.lit("name-"), slug(name))))


def rounds_of(lines: DataFrame) -> DataFrame:
    """(contest_id, round, round_type, round_order, n_lines, n_judges, legend): the rounds of each contest in their order."""
    kind = C.round_type(F.col("round"))
    marks = F.explode_outer(F.transform("marks", lambda m: F.trim(m)))
    seen = lines.groupBy("contest_id", "round").agg(F.count("*").alias("n_lines"), F.max(F.size("marks")).alias("n_judges"))
    values = lines.select("contest_id", "round", marks.alias("m")).groupBy("contest_id", "round").agg(F.max(F.coalesce(F.col("m").isin(*NEW_LEGEND), F.lit(False))).alias("new"), F.max(F.coalesce(F.col("m").isin(*OLD_LEGEND), F.lit(False))).alias("old"))
    out = seen.join(values, ["contest_id", "round"])
    legend = F.when(F.col("new"), "wsdc_10").when(F.col("old"), "legacy_3").otherwise("unknown")
    w = Window.partitionBy("contest_id").orderBy(round_rank(kind), C.round_number(F.col("round")), "round")
    return out.select("contest_id", "round", kind.alias("round_type"), F.row_number().over(w).alias("round_order"), "n_lines", "n_judges", legend.alias("legend"))


def entries_of(lines: DataFrame) -> DataFrame:
    """(entry_id, contest_id, role, name, best_round, n_rounds, names): entries by the evidence of highest precedence.

    The latest observation counts, and among equals the greater snapshot. Other names printed for the entry are counted.
    """
    c = competitors_of(lines).withColumn("entry_id", entry_key(F.col("contest_id"), F.col("role"), F.col("role_bib"), F.col("name")))
    best = F.max(F.struct("observed_at", "snapshot_id", "name"))
    kind = C.round_type(F.col("round"))
    g = c.groupBy("entry_id", "contest_id", "role").agg(best.alias("m"), F.max(round_rank(kind)).alias("r"), F.countDistinct("round").alias("n_rounds"), F.countDistinct("name").alias("names"))
    label = F.element_at(F.array(*[F.lit(r) for r in ROUND_ORDER]), F.col("r"))
    return g.select("entry_id", "contest_id", "role", F.col("m.name").alias("name"), label.alias("best_round"), "n_rounds", "names")


def marks_of(lines: DataFrame) -> DataFrame:
    """(entry_id, round, judge, raw, kind, value, known): every printed mark of the competitors of the lines."""
    c = competitors_of(lines)
    keyed = c.select(entry_key(F.col("contest_id"), F.col("role"), F.col("role_bib"), F.col("name")).alias("entry_id"), "contest_id", "round", F.posexplode("marks").alias("judge", "raw")).filter("raw is not null")
    raw = F.col("raw")
    return keyed.select("entry_id", "contest_id", "round", (F.col("judge") + 1).alias("judge"), "raw", scoring.mark_kind(raw).alias("kind"), scoring.mark_value(raw).alias("value"), scoring.known_mark(raw).alias("known"))


def callbacks_of(lines: DataFrame) -> DataFrame:
    """(entry_id, round, score, yes, alternates, no, outcome): sums of the marks of each entry and round before a final.

    A row with any unknown mark gives none. An entry that dances a later round of its contest is promoted; others are
    out, unless their score reaches the least score of those promoted, which leaves the outcome open (null).
    """
    m = marks_of(lines).withColumn("rank", round_rank(C.round_type(F.col("round"))))
    sums = m.groupBy("entry_id", "contest_id", "round", "rank").agg(
        F.sum("value").alias("score"), F.count_if(F.col("kind") == "yes").alias("yes"), F.count_if(F.col("kind").startswith("alt")).alias("alternates"), F.count_if(F.col("kind") == "no").alias("no"), F.min("known").alias("known"),
    )
    last = m.groupBy("entry_id").agg(F.max("rank").alias("last"))
    scored = sums.filter(F.col("known") & (F.col("rank") < len(ROUND_ORDER))).join(last, "entry_id").withColumn("advanced", F.col("last") > F.col("rank"))
    cut = scored.groupBy("contest_id", "round").agg(F.min(F.when(F.col("advanced"), F.col("score"))).alias("cut"))
    j = scored.join(cut, ["contest_id", "round"])
    outcome = F.when(F.col("advanced"), "promoted").when(F.col("cut").isNull(), F.lit(None)).when(F.col("score") < F.col("cut"), "eliminated")
    return j.select("entry_id", "round", "score", "yes", "alternates", "no", outcome.alias("outcome"))


def merged_outcome(outcomes):
    """The strongest outcome of a group, by the fixed order."""
    rank = F.coalesce(*[F.when(outcomes == o, i) for i, o in enumerate(OUTCOMES)])
    return F.coalesce(*[F.when(F.max(rank) == i, o) for i, o in enumerate(OUTCOMES)])


def hidden_names(lines: DataFrame) -> DataFrame:
    """(contest_id, role, role_bib, rounds): bibs whose name is redacted in any round of the contest, and the rounds that concerns."""
    c = competitors_of(lines).filter("role_bib is not null")
    g = c.groupBy("contest_id", "role", "role_bib").agg(F.max(F.coalesce(F.trim("name").rlike(REDACTED), F.lit(False))).alias("hidden"), F.countDistinct("round").alias("rounds"))
    return g.filter("hidden").drop("hidden")


def unsupported_scoring(lines: DataFrame) -> DataFrame:
    """(contest_id, round, reason): rounds whose marks are no callback marks, so that none are projected."""
    known = F.min(scoring.known_mark(F.col("m")))
    m = lines.select("contest_id", "round", "source", F.explode("marks").alias("m")).filter("m is not null")
    g = m.groupBy("contest_id", "round", "source").agg(known.alias("known"), F.countDistinct("m").alias("kinds"))
    reason = F.when(~F.col("known") & (F.col("source") == "eepro"), "raw scores").when(~F.col("known"), "unknown marks")
    return g.select("contest_id", "round", reason.alias("reason")).filter("reason is not null").distinct()
