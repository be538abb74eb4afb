import random

import pytest

from tallyforge.operators.packed import ValueCode, dialects, mask, parse, split_packed

NAMES = ["Ada Brook", "Ben Crane", "Cora Dell", "Dan Ember", "Eve Fox", "Finn Gale", "Gus Hart", "Ida Jolly"]


def column(spark, values, extra=()):
    rows = [(f"e{i}", v, "leader", 1) for i, v in enumerate(values)] + list(extra)
    return spark.createDataFrame(rows, "entry_id string, name_raw string, role string, last_seen_at int")


def background(n=300):
    rng = random.Random(3)
    plain = [rng.choice(NAMES) for _ in range(n)] + [", ".join(reversed(rng.choice(NAMES).split())) for _ in range(n // 8)]
    packed = [d.join(rng.sample(NAMES, 2)) for d in (" & ", "/", "; ", " | ", "+", "\t", "\n", " und ", ", ") for _ in range(4)]
    return plain + packed


def values(df, key):
    return [r.value_text for r in sorted(df, key=lambda r: r.value_pos) if r.entry_id == key]


def test_dialects_of_one_column(spark):
    cases = {
        "a": ("Ada Brook / Ben Crane", ["Ada Brook", "Ben Crane"]),
        "b": ('"Brook, Ada"; "Cora ""Ace"" Dell"', ["Brook, Ada", 'Cora "Ace" Dell']),
        "c": ('["Ada Brook", "Ben Crane", "Eve Fox"]', ["Ada Brook", "Ben Crane", "Eve Fox"]),
        "d": ("Brook, Ada & Ben Crane", ["Brook, Ada", "Ben Crane"]),
        "e": ("Ada Brook, Ben Crane and Eve Fox", ["Ada Brook", "Ben Crane", "Eve Fox"]),
        "f": ("Ada Brook (North/NW)", []),
        "g": ("Brook, Ada", []),
        "h": ("Ada Brook, Jr.", []),
        "i": ("Ben Crane;", []),
        "j": ('Ada "Duke" Brook', []),
        "k": ("Ada Brook // Ben Crane /", ["Ada Brook", "Ben Crane"]),
        "l": (None, []), "m": ("", []), "n": ("   ", []),
        "o": ("Crane, B.", []),
    }
    df = column(spark, background(), [(k, v[0], "leader", 1) for k, v in cases.items()])
    got = split_packed(df, ["entry_id"], ["name_raw", "role"], "last_seen_at").collect()
    for k, (_, want) in cases.items():
        assert values([r for r in got if r.field_name == "name_raw"], k) == want, k


def test_roles_split_though_short(spark):
    roles = ["leader"] * 200 + ["follower"] * 200 + ["L / F", "L, F", '["L", "F"]', "leader\tfollower", "L And F"] * 2
    df = spark.createDataFrame([(f"r{i}", None, v, 1) for i, v in enumerate(roles)], "entry_id string, name_raw string, role string, last_seen_at int")
    got = split_packed(df, ["entry_id"], ["name_raw", "role"], "last_seen_at").collect()
    assert len({r.entry_id for r in got}) == 10 and all(r.field_name == "role" for r in got)


def test_repeats_versions_and_clashing_columns(spark):
    rows = [("x", "Ada Brook & Ben Crane", "leader", 1), ("x", "Ada Brook & Eve Fox", "leader", 2), ("x", "Ada Brook & Eve Fox", "leader", 2)]
    df = column(spark, background(), rows)
    for c in ("text", "shape", "field_name", "value_pos", "_m", "n"):
        df = df.withColumn(c, df.name_raw)
    got = split_packed(df, ["entry_id"], ["name_raw"], "last_seen_at").collect()
    assert values(got, "x") == ["Ada Brook", "Eve Fox"]


def test_empty_and_very_long(spark):
    assert split_packed(column(spark, []), ["entry_id"], ["name_raw", "role"], "last_seen_at").count() == 0
    long = " & ".join(random.Random(1).choices(NAMES, k=3000))
    letters = "x" * 100_000
    got = split_packed(column(spark, background(), [("long", long, None, 1), ("letters", letters, None, 1)]), ["entry_id"], ["name_raw"], "last_seen_at").collect()
    assert len(values(got, "long")) == 3000 and values(got, "letters") == []


@pytest.mark.parametrize("text", ["a|b", '"a|b"|c', "[a;b]", "", '"', "|||", '"a"b|c'])
def test_every_dialect_parses_or_declines(text):
    for d in dialects(text):
        got = parse(text, mask(text), d)
        assert got is None or all(v and v == v.strip() for v in got)


def test_code_without_counts_still_chooses():
    assert ValueCode({}).best("● ●") == (frozenset(), False, False)


def test_six_and_more_delimiters_try_every_set(spark):
    """Commas are the most frequent sign but stand inside "Surname, Given"; only the set without them fits."""
    people = ["Brook, Ada", "Crane, Ben", "Dell, Cora", "Ember, Dan", "Fox, Eve", "Gale, Finn", "Hart, Gus"]
    packed = "".join(p + d for p, d in zip(people, [" / ", "; ", " | ", " & ", " + ", "\t", ""]))
    plain = [", ".join(reversed(n.split())) for n in NAMES] * 40
    shown = background() + plain
    df = column(spark, shown, [("x", packed, "leader", 1)])
    assert values(split_packed(df, ["entry_id"], ["name_raw"]).collect(), "x") == people
    assert len(dialects(",;|/&+\t\n")) == 2 ** 8
