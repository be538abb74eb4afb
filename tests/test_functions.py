"""Scalar functions against literal values, with nulls, empty texts and other scripts."""

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import contests as C
from tallyforge.functions import scoring, text, times


def each(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_slugs_and_names(spark):
    names = ["Malmø Open", "São  Marcelo", "ﬁrst Straße!", "Łódź", "Привет мир", "", "--", None]
    assert each(spark, names, text.slug) == ["malm-open", "sao-marcelo", "first-strasse", "odz", "unknown", "unknown", "unknown", None]
    assert each(spark, names, text.event_name) == ["malm open", "sao marcelo", "first strasse", "odz", "", "", "", None]
    people = ["Zoë O'Neil-Łask Jr.", "Привет  мир", "ΟΔΥΣΣΕΥΣ", "李 小龍 III", "Jr", "", None]
    assert each(spark, people, text.name_norm) == ["zoe o neil łask", "привет мир", "οδυσσευσ", "李 小龍", "", "", None]
    series = ["5th Swing Fest 2019", "Swing Fest XII (on hiatus)", "Swing Fest 2024", "Hiatus", None]
    assert each(spark, series, text.series_slug) == ["swing-fest", "swing-fest", "swing-fest", "unknown", None]
    assert each(spark, ["A 1 & 11 B", "Ann and Bo", "Ann", "Ann &", None], lambda c: F.array_join(text.paired(c), "|")) == ["A 1|11 B", "Ann|Bo", "", "", ""]


def test_marks(spark):
    raw = ["10", "10.0", "4.50", " Y ", "ALT2", "03", "2.3", "5", "x", "", None]
    assert each(spark, raw, scoring.mark_kind) == ["yes", "yes", "alt1", "yes", "alt2", "no", "alt3", "no", "no", "no", "no"]
    assert each(spark, raw, scoring.mark_value) == [10, 10, 4.5, 10, 4.3, 0, 4.2, 0, 0, 0, 0]
    assert each(spark, raw, scoring.known_mark) == [True] * 7 + [False] * 4


@pytest.mark.parametrize("name, want", [
    ("Novice Jack & Jill", ("novice", "none", "jack_and_jill", "random_partner", "wcs", [], "novice-jj", True)),
    ("Sophisticated Jack and Jill", ("none", "sophisticated", "jack_and_jill", "random_partner", "wcs", [], "sophisticated-jj", False)),
    ("All-Star / Champion Jack n Jill", ("allstar", "none", "jack_and_jill", "random_partner", "wcs", ["allstar", "champion"], "allstar-jj-champion", False)),
    ("Country Classic", ("none", "none", "classic", "perm_couple", "country", [], "country-classic", False)),
    ("Pro-Am Novice Followers", ("novice", "none", "pro_am", "perm_couple", "wcs", [], "novice-pro-am-followers", False)),
    ("Allstar J&J", ("allstar", "none", "other", "open_couple", "wcs", [], "allstar-allstar-j-j", False)),
    ("Novice Jack and Jill Sunday", ("novice", "none", "jack_and_jill", "random_partner", "wcs", [], "novice-jj-sunday", False)),
    ("", ("none", "none", "other", "open_couple", "wcs", [], "unknown", False)),
])
def test_contests(spark, name, want):
    n = F.col("n")
    r = spark.createDataFrame([(name,)], "n string").select(*[c.alias(k) for k, c in C.classify(n).items()], C.contest_slug(n).alias("slug"), C.points_eligible(n).alias("ok")).first()
    assert tuple(r) == want


def test_rounds_places_and_ranges(spark):
    assert each(spark, ["Finals", "Semi-Final 2", "Quarterfinals", "Heat 3", None], C.round_type) == ["final", "semifinal", "quarterfinal", "prelim", "prelim"]
    assert each(spark, ["Round 12", "Final", "Prelim 2", "B2B", None], C.round_number) == [12, 1, 2, 1, 1]
    assert each(spark, ["1st", " 3 ", "22ND", "first", "", None], C.place_of) == [1, 3, 22, None, None, None]
    printed = ["May 3 - 5, 2019", "May 30 - Jun 2, 2019", "Dec 30, 2019 - Jan 2, 2020", "May 3, 2019", "Feb 30 - 31, 2019", "Jun 5 - 3, 2019", "soon", "", None]
    got = each(spark, printed, lambda c: F.concat_ws("/", *[d.cast("string") for d in times.date_range(c)]))
    assert got == ["2019-05-03/2019-05-05", "2019-05-30/2019-06-02", "2019-12-30/2020-01-02", "2019-05-03/2019-05-03", "", "", "", "", ""]


@pytest.mark.parametrize("cell, header, contest, n, want", [
    ("Ann Lee", "", "Novice Jack and Jill", 2, [("leader", "Ann Lee")]), ("Ann Lee and Bo Ray", "", "Novice Jack and Jill", 1, [("leader", "Ann Lee"), ("follower", "Bo Ray")]),
    ("Ann & Bo", "", "Strictly", 1, [("couple", "Ann & Bo")]), ("Ann", "", "Strictly", 1, [("couple", "Ann")]), ("Ann", "Follower", "Jack and Jill", 2, [("follower", "Ann")]),
    ("Ann", "Am", "Pro-Am Followers", 2, [("follower", "Ann")]), ("Bo", "Pro", "Pro-Am Followers", 2, [("leader", "Bo")]), ("Ann", "Am", "Pro-Am", 2, []), ("Ann", "Couple", "Jack and Jill", 1, [("couple", "Ann")]),
])
def test_competitors(spark, cell, header, contest, n, want):
    df = spark.createDataFrame([(cell, header, contest, n)], "cell string, header string, contest string, n int")
    got = df.select(C.competitors(F.col("cell"), F.col("header"), F.col("contest"), F.col("n"), F.lit(0)).alias("p")).first().p
    assert [(x.role, x.name) for x in got] == want


def test_bibs(spark):
    for bib, role, want in (("12/34", "leader", "12"), ("12/34", "follower", "34"), ("111/101", "follower", "101"), ("12", "follower", "12"), ("12/", "leader", "12/"), (None, "leader", None), ("1/2", "couple", "1/2")):
        df = spark.createDataFrame([(bib, role)], "b string, r string")
        assert df.select(C.bib_of(F.col("b"), F.col("r")).alias("x")).first().x == want
