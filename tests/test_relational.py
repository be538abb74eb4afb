from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import scoring, text, times
from tallyforge.operators import relational as R
from tallyforge.operators.drift import assign
from tallyforge.session import bounded_rows, cut


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_precedence_and_conflicts(spark):
    df = spark.createDataFrame([("a", 1, "x", None), ("a", 2, None, "p"), ("a", 2, None, "p"), ("b", 1, None, None)], "k string, t int, u string, v string")
    assert rows(R.latest(df, ["k"], [F.col("t")]).select("k", "t")) == [("a", 2), ("b", 1)]
    assert rows(R.precedence_merge(df, ["k"], ["u", "v"], [F.col("t")])) == [("a", "x", "p"), ("b", None, None)]
    more = df.union(spark.createDataFrame([("a", 0, "y", "q")], df.schema))
    assert rows(R.precedence_conflicts(more, ["k"], "u", [F.col("t")])) == [("a", "x", "y")]


def test_diff_is_null_safe(spark):
    new = spark.createDataFrame([(None, 1), ("a", None), ("c", 3)], "k string, v int")
    old = spark.createDataFrame([(None, 2), ("a", None), ("b", 1)], "k string, v int")
    assert rows(R.diff_rows(new, old, ["k"], ["v"]).select("record_key", "change_type", "old_value", "new_value")) == [("", "changed", "2", "1"), ("b", "removed", None, None), ("c", "added", None, None)]


def test_ranges_matches_and_multisets(spark):
    r = spark.createDataFrame([("a", date(2020, 1, 5), "1"), ("a", date(2022, 1, 5), "2"), ("b", date(2020, 1, 5), "3")], "k string, at date, id string")
    rules = spark.createDataFrame([("a", None, None, "open"), ("a", date(2020, 1, 1), date(2020, 12, 31), "y20")], "k string, lo date, hi date, rule string")
    assert rows(R.range_lookup(r, rules, "k", "at", ("lo", "hi"), "rule", "id").select("id", "rule")) == [("1", "y20"), ("2", "open"), ("3", None)]
    c = spark.createDataFrame([("a", "v1"), ("b", "v2"), ("b", "v3")], "k string, v string")
    assert rows(R.unique_match(r, c, ["k"], "id", "v")) == [("1", "v1", 1), ("2", "v1", 1), ("3", None, 2)]
    a, b = (spark.createDataFrame([(x,) for x in xs], "x string") for xs in (["p", "p", None], ["p"]))
    assert rows(R.multiset_gap(a, b, ["x"])) == [("p", 1), (None, 1)]


def test_graphs(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)], "a int, b int")
    got = dict(tuple(r) for r in R.components(e, "a", "b").collect())
    assert {got[i] for i in range(41)} == {0} and got[101] == 100
    reach = dict(tuple(r) for r in R.reach(spark.createDataFrame([(38,)], "n int"), e, "n", "a", "b").collect())
    assert reach == {38: 0, 39: 1, 40: 2}
    assert R.components(e.limit(0), "a", "b").count() == 0


def test_upsert_and_replace(spark):
    s = spark.createDataFrame([("a", 1, "s"), ("b", 1, "s"), ("c", 1, "t")], "k string, seen int, src string")
    p = spark.createDataFrame([("a", 5, "s"), ("d", 5, "s")], "k string, seen int, src string")
    assert rows(R.replace_scope(s, p, ["src"], ["k"], "seen")) == [("a", 1, "s"), ("c", 1, "t"), ("d", 5, "s")]
    assert rows(R.upsert(s, p.withColumn("src", F.lit("z")), ["k"], ["seen"])) == [("a", 1, "z"), ("b", 1, "s"), ("c", 1, "t"), ("d", 5, "z")]


@pytest.mark.parametrize("n, place, want", [(4, 1, 0), (5, 1, 3), (20, 10, 1), (40, 12, 1), (80, 15, 2), (130, 1, 25)])
def test_points(spark, n, place, want):
    assert spark.range(1).select(scoring.expected_points(F.lit(n), F.lit(place))).first()[0] == want


def test_assignment_and_similarity(spark):
    c = spark.createDataFrame([("g", "a", 1, 0.95), ("g", "b", 1, 0.80), ("g", "b", 2, 0.70), ("g", "c", 9, 0.3)], "g string, a string, b int, s double")
    assert rows(scoring.best_assignment(c, ["g"], "a", "b", "s").select("a", "b")) == [("a", 1), ("b", 2)]
    assert abs(scoring.jaro_winkler("martha", "marhta") - 0.9611) < 1e-4 and scoring.jaro_winkler("", "x") == 0
    import numpy as np

    assert assign(np.array([[4.0, 1, 3], [2, 0, 5]])) in ([(0, 1), (1, 0)], [(1, 0), (0, 1)])


def test_text_and_times(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(text.slug(F.lit("  Grün & Blau! "))) == "grun-blau" and one(text.slug(F.lit("!!"))) == "unknown"
    assert one(text.series_slug(F.lit("7th Amber Open 2019 (on hiatus) IV"))) == "amber-open"
    assert one(text.name_norm(F.lit("Ada O'Brook, Jr."))) == "ada o brook" and one(text.ordinal(F.lit("22nd"))) == 22
    s, e = times.date_range(F.lit("May 30 - Jun 2, 2019"))
    assert (one(s), one(e)) == (date(2019, 5, 30), date(2019, 6, 2))
    s, e = times.date_range(F.lit("Feb 30 - 31, 2019"))
    assert (one(s), one(e)) == (None, None)
    assert one(times.retry_after(F.lit("5"), F.current_timestamp())) == 60.0 and one(times.retry_after(F.lit("soon"), F.current_timestamp())) is None


def test_bounds_are_errors(spark):
    with pytest.raises(ValueError):
        bounded_rows(spark.range(5), 4, "numbers")
    assert cut(spark.range(3)).count() == 3
