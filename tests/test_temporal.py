"""Intervals, layers, closure, suppression and projection on small cases."""

from datetime import datetime

from pyspark.sql import functions as F

from tallyforge.operators import projection as P
from tallyforge.operators import suppression as S
from tallyforge.operators import temporal as T


def t(day):
    return None if day is None else datetime(2024, 1, day)


def test_interval_union(spark):
    rows = [("a", t(1), t(3), "x"), ("a", t(2), t(5), None), ("a", t(5), t(6), "x"), ("a", t(8), t(9), "x"), ("a", t(8), t(9), "x"), ("a", None, t(2), "x"), ("a", t(7), None, "x"), ("a", t(9), t(7), "x"), ("b", t(1), t(1), "x"), (None, t(1), t(2), "x")]
    df = spark.createDataFrame(rows, "k string, s timestamp_ntz, e timestamp_ntz, _island string")
    got = sorted(((r.k or "-", r.s, r.e) for r in T.interval_union(df, ["k"], "s", "e").collect()))
    assert got == [("-", t(1), t(2)), ("a", t(1), t(6)), ("a", t(8), t(9)), ("b", t(1), t(1))]
    assert T.interval_union(df.limit(0), ["k"], "s", "e").count() == 0
    spans = T.interval_union(df, ["k"], "s", "e").withColumn("u", F.lit(t(4))).withColumn("v", F.lit(t(9)))
    lasted = {r.k: r.excluded_s for r in T.excluded_seconds(spans, ["k"], "s", "e", F.col("u"), F.col("v")).collect()}
    assert lasted["a"] == 3 * 86400.0 and lasted["b"] == 0


def test_changed_samples(spark):
    rows = [("a", 1, "x", None), ("a", 2, "x", None), ("a", 3, "y", None), ("a", 4, "y", 1), ("a", 5, "y", 1), ("b", 1, None, None), ("b", 2, None, None)]
    df = spark.createDataFrame(rows, "k string, n int, v string, w int")
    assert sorted((r.k, r.n) for r in T.changed_samples(df, ["k"], "n", ["v", "w"]).collect()) == [("a", 1), ("a", 3), ("a", 4), ("b", 1)]


def test_overlay(spark):
    base = spark.createDataFrame([("a", t(1), "x", None), ("a", t(2), "y", 1), ("b", t(1), None, None)], "k string, at timestamp_ntz, name string, n int")
    patch = spark.createDataFrame([("a", t(1), None, 7), ("b", t(1), "z", None), ("c", t(1), "only a patch", 1)], "k string, at timestamp_ntz, name string, n int")
    got = {r.k: (r.name, r.n) for r in T.overlay([base, patch], "k", ["name", "n"], "at").collect()}
    assert got == {"a": ("y", 7), "b": ("z", None)}
    assert T.overlay([base.limit(0), patch], "k", ["name", "n"], "at").count() == 0


def test_close_after_removal(spark):
    a = spark.createDataFrame([("a1",), ("a2",)], "a string")
    b = spark.createDataFrame([("b1", "a1"), ("b2", "a2"), ("b3", None), ("b4", "gone")], "b string, a string")
    c = spark.createDataFrame([("c1", "b1"), ("c2", "b2"), ("c3", "b3")], "c string, b string")
    kept = T.keep_closed({"a": a, "b": b, "c": c}, {"b": [("a", "a", "a")], "c": [("b", "b", "b")]}, {"a": spark.createDataFrame([("a2",)], "a string")}, ["a", "b", "c"])
    assert [sorted(r[0] for r in kept[x].select(x).collect()) for x in "abc"] == [["a1"], ["b1", "b3"], ["c1", "c3"]]


def test_suppression_to_a_fixpoint(spark):
    subjects = [("e1", 1, "ann lee"), ("e2", 1, "anne lee"), ("e3", None, "anne lee"), ("e4", 2, None), ("x/judge/anne", None, "anne lee"), ("e5", None, ""), ("e6", None, None), ("e5", None, "")]
    df = spark.createDataFrame(subjects, "subject string, wsdc_id int, name string")
    seeds = spark.createDataFrame([("e1",), ("unknown",)], "subject string")
    covered = S.learned_subjects(df, seeds)
    assert {r.subject for r in covered.collect()} == {"e1", "e2", "e3", "x/judge/anne", "unknown"}
    out = {r.wsdc_id: r for r in S.scrub_subjects(df.withColumnRenamed("subject", "key"), covered, "key", ["name"]).collect() if r.wsdc_id}
    assert out[1].name is None and out[1].suppressed and out[2].suppressed is False
    keys = {r.key for r in S.scrub_subjects(df.withColumnRenamed("subject", "key"), covered, "key", ["name"]).collect()}
    assert not any("anne" in k for k in keys) and any(k.startswith("suppressed-") and len(k) == 35 for k in keys)
    body = spark.createDataFrame([('{"ann":"Ann Lee x","l":["ann lee","b"],"d":{"q":"no","n":1}}',), (None,), ("",)], "b string")
    assert [r[0] for r in body.select(S.scrub_json(F.col("b"), ["ann lee"])).collect()] == ['{"ann":null,"l":[null,"b"],"d":{"q":"no","n":1}}', None, ""]


def test_projection(spark):
    line = lambda rnd, bib, cell, marks, at=1, header="", n=2: ("e/c", "Novice Jack and Jill", rnd, "src", t(at), f"s{at}", header, n, bib, cell, marks)
    rows = [
        line("Prelims", "1", "Ann Lee", ["10", "10", "y"]), line("Prelims", "2", "Bo Ray", ["10", "0", "n"]), line("Prelims", "3", "Cy Fox", ["10", "10", "10"]),
        line("Prelims", "4", "Di Gun", ["10", "?", "10"]), line("Prelims", "5", "***", [None, None, None]),
        line("Finals", "1", "Anne Lee", ["1"], at=2), line("Finals", None, "Eve & Fay", ["2"], header="couple"),
    ]
    lines = spark.createDataFrame(rows, "contest_id string, contest string, round string, source string, observed_at timestamp_ntz, snapshot_id string, header string, n_columns int, bib string, cell string, marks array<string>")
    assert {(r.round, r.round_type, r.round_order, r.n_lines, r.legend) for r in P.rounds_of(lines).collect()} == {("Prelims", "prelim", 1, 5, "wsdc_10"), ("Finals", "final", 2, 2, "legacy_3")}
    entries = {r.entry_id: r for r in P.entries_of(lines).collect()}
    assert entries["e/c/L-1"].name == "Anne Lee" and entries["e/c/L-1"].names == 2 and entries["e/c/L-1"].best_round == "final" and "e/c/C-name-eve-fay" in entries
    calls = {r.entry_id: (r.score, r.yes, r.outcome) for r in P.callbacks_of(lines).collect()}
    assert calls == {"e/c/L-1": (30.0, 3, "promoted"), "e/c/L-2": (10.0, 1, "eliminated"), "e/c/L-3": (30.0, 3, None)}
    assert [(r.role, r.role_bib) for r in P.hidden_names(lines).collect()] == [("leader", "5")]
    assert {r.round for r in P.unsupported_scoring(lines).collect()} == {"Prelims", "Finals"}
    o = spark.createDataFrame([("a", "eliminated"), ("a", "alternate_2"), ("b", None), ("c", "odd")], "k string, o string")
    assert {r.k: r.x for r in o.groupBy("k").agg(P.merged_outcome(F.col("o")).alias("x")).collect()} == {"a": "alternate_2", "b": None, "c": None}
    for f in (P.rounds_of, P.entries_of, P.marks_of, P.callbacks_of, P.hidden_names, P.unsupported_scoring):
        assert f(lines.limit(0)).count() == 0
