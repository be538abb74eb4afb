"""Operators on copies, snapshots, references and schemas."""

import json

import pytest
from datetime import datetime

from tallyforge.operators.drift import canonical, object_hashes, read_deep, readable, schema_changes, unified_rows, unified_table
from tallyforge.operators.orphans import Parent, Reference, orphan_references, orphan_report
from tallyforge.operators.snapshots import snapshot_changes
from tallyforge.operators.twocopy import compare_copies
from tallyforge.plans import training
from pyspark.sql import functions as F

FIELDS = {"name": "text", "n": "number", "day": "date", "tags": "set"}
LEFT = "id string, name string, n bigint, day date, tags array<string>, seen int"
RIGHT = "id string, name string, n string, day string, tags string, left_value string, v_0 string"


def copies(spark, left, right):
    l = spark.createDataFrame(left, LEFT)
    r = spark.createDataFrame(right, RIGHT)
    return sorted((x.record_key, x.field_name, x.diff_kind) for x in compare_copies(l, r, ["id"], FIELDS, "seen").collect())


def test_copies_agree_by_meaning(spark):
    day = datetime(2020, 5, 3).date()
    left = [("a", "Grünau", 1234, day, ["x", "y"], 1), ("b", None, None, None, None, 1), ("c", "C", 1, day, [], 1), ("d", "D", 2, day, ["x"], 1)]
    right = [(" A ", "Grünau ", "1,234", "03 May 2020", "y; x", "q", "q"), ("b", "", "", " ", "", None, None), ("c", "C", "1.0", "2020-05-03T00:00:00Z", "", None, None), ("d", "D", "2", "2020-05-03", "x|x", None, None)]
    assert copies(spark, left, right) == []


def test_copies_differ_cell_by_cell_and_repeats_count_once(spark):
    day = datetime(2020, 5, 3).date()
    left = [("a", "old", 1, day, ["x"], 1), ("a", "new", 1, day, ["x"], 2), ("a", "new", 1, day, ["x"], 2), ("only", "l", 1, day, None, 1)]
    right = [("a", "NEW", "2", "2020-05-04", "z", None, None)] * 3 + [("right", "r", "1", "2020-05-03", "", None, None)]
    assert copies(spark, left, right) == [("a", "day", "differs"), ("a", "n", "differs"), ("a", "name", "differs"), ("a", "tags", "differs"), ("only", "", "only_left"), ("right", "", "only_right")]


def test_copies_empty_sides(spark):
    assert copies(spark, [], []) == []
    assert copies(spark, [("a", "x", 1, None, None, 1)], []) == [("a", "", "only_left")]
    assert copies(spark, [], [("a", "x", "1", None, None, None, None)]) == [("a", "", "only_right")]


SNAP = "release_no int, delivery_no int, record_key string, status string, score double, tags array<string>, at int, v string, h string"


def changes(spark, rows):
    df = spark.createDataFrame(rows, SNAP)
    got = snapshot_changes(df, "release_no", "delivery_no", "record_key", {"status": "text", "score": "decimal6", "tags": "set"}, "at").collect()
    return sorted((r.release_no, r.record_key, r.change_type, r.field_name, r.old_value if r.field_name else None, r.new_value if r.field_name else None) for r in got)


def test_snapshots(spark):
    rows = [
        (1, 1, "k1", "ok", 0.5, ["a", "b"], 1, "x", "x"), (1, 1, "k2", "ok", None, None, 1, None, None),
        (2, 1, "k1", "BAD", 0.9, [], 1, None, None),  # an incomplete delivery that a later one replaces
        (2, 2, " K1", "OK ", 0.5000000001, ["b", "a", "a"], 1, None, None), (2, 2, "k3", None, 0.1, [], 1, None, None), (2, 2, "k3", None, 0.1, [], 1, None, None),
        (3, 1, "k1", "gone", 0.6, ["a"], 1, None, None), (3, 1, "k3", "", 0.1, None, 1, None, None), (3, 1, None, "x", 1.0, None, 1, None, None),
        (5, 1, "k9", "x", 1.0, None, 1, None, None),
    ]
    assert changes(spark, rows) == [
        (2, "k2", "removed", "", None, None), (2, "k3", "added", "", None, None),
        (3, "k1", "updated", "score", "0.500000", "0.600000"), (3, "k1", "updated", "status", "ok", "gone"), (3, "k1", "updated", "tags", "a,b", "a"),
    ]
    assert changes(spark, []) == []


def test_orphans(spark):
    t = lambda n: datetime(2024, n, 1)
    parents = spark.createDataFrame([("p1", t(1)), ("P2", t(6)), ("p2", t(7)), (None, t(1)), ("p4", None)], "id string, seen timestamp_ntz")
    child = spark.createDataFrame([("c1", "p1 ", t(2)), ("c2", "p2", t(3)), ("c3", "gone", t(4)), ("c4", "nil", t(5)), ("c5", None, t(5)), ("c2", "p2", t(3)), ("c6", "p4", t(5)), ("c7", "", t(5)), ("c8", "nil", None)], "id string, ref string, seen timestamp_ntz")
    removed = spark.createDataFrame([("things", "GONE"), ("other", "nil"), (None, None)], "table_name string, record_key string")
    run = lambda p, c: orphan_references([Parent("things", p, "id", "seen")], [Reference("child", "ref", c, F.col("id"), "things", "seen")], removed)
    got = sorted((r.row_key, r.period, r.reason) for r in run(parents, child).collect())
    assert got == [("c2", "2024-03", "late"), ("c3", "2024-04", "deleted"), ("c4", "2024-05", "missing"), ("c7", "2024-05", "missing"), ("c8", None, "missing")]
    assert sum(r.n_orphans for r in orphan_report(run(parents, child)).collect()) == 5
    assert run(parents, child.limit(0)).count() == 0
    assert run(parents.limit(0), child).count() == 7


def receipts(spark, files):
    rows = [("fam", f"f{i}", datetime(2024, 1, 1 + i), n, b if b is None or isinstance(b, str) else json.dumps(b), "t") for i, lines in enumerate(files) for n, b in enumerate(lines, 1)]
    return spark.createDataFrame(rows, "family string, file_name string, recorded_at timestamp_ntz, line_no int, body string, types string")


def test_schema_drift(spark):
    first = [{"step": f"s{i}", "files": i * 7, "note": f"n{i}", "gone": True, "sub": {"a": f"x{i}"}} for i in range(6)]
    second = [{"step": f"s{i}", "n_files": str(i * 7), "note": f"n{i}", "sub": {"a": f"x{i}", "b": 1}, "fresh": None} for i in range(6)] + [None, "", "{broken", "[1]", "7"]
    df = receipts(spark, [first, second, second])
    got = sorted((r.file_name, r.field_path, r.change_kind, r.new_path) for r in schema_changes(df).collect())
    assert got == [("f1", "files", "renamed", "n_files"), ("f1", "fresh", "added", ""), ("f1", "gone", "removed", ""), ("f1", "n_files", "retyped", ""), ("f1", "sub.b", "added", "")]
    table = unified_rows(df, schema_changes(df)).filter("step = 's2'").collect()
    assert {r.fields["n_files"] for r in table} == {"14"} and all("files" not in r.fields for r in table)
    both = receipts(spark, [first, second + [{"step": "s9", "files": 1, "n_files": "2"}], second])
    rows = unified_rows(both, schema_changes(receipts(spark, [first, second, second])))
    kept = [r for r in rows.collect() if r.step == "s9"]
    assert [(r.fields["n_files"], r.others) for r in kept] in ([("2", {"files": "1"})], [("2", {})])
    typed = unified_table(unified_rows(df, schema_changes(df)), "fam")
    kinds = dict(typed.dtypes)
    assert (kinds["n_files"], kinds["note"], kinds["gone"], kinds["fresh"], kinds["sub.b"]) == ("double", "string", "boolean", "string", "double")
    assert {r["n_files"] for r in typed.filter("step = 's2'").collect()} == {14.0} and unified_table(unified_rows(df, schema_changes(df)), "none").count() == 0


def test_typed_table_of_all_families(spark, tmp_path):
    """Every line of every family, also where families differ in a field's type or in its letters' case."""
    a = [{"step": "s1", "ok": True, "n": 1, "host": "h", "empty": None}, {"step": "s2", "ok": None, "n": "2.5", "sub": {"x": 1}}]
    b = [{"step": "s1", "ok": "yes", "Host": "H", "sub": {"x": 2}}, {"step": "s2", "ok": "true"}, {"step": "s3", "family": "f", "others": 3, "ok:string": 4}]
    c = [{"step": "s1", "ok": None, "n": 3, "": 5}]
    day = datetime(2024, 1, 1)
    lines = [(family, f"{family}-1", day, n, json.dumps(x)) for family, rows in (("a", a), ("b", b), ("c", c)) for n, x in enumerate(rows, 1)]
    lines += [("c", "c-1", day, 2, "{broken"), ("b", "b-1", day, 1, json.dumps(b[0])), ("d", "d-1", day, 1, None)]
    spark.createDataFrame(lines, "family string, file_name string, recorded_at timestamp_ntz, line_no int, body string").write.parquet(f"{tmp_path}/in/raw_receipts.parquet")
    training.p6_table(spark, f"{tmp_path}/in").write.parquet(f"{tmp_path}/out")
    df = spark.read.parquet(f"{tmp_path}/out")
    assert dict(df.dtypes) == {
        "family": "string", "file_name": "string", "line_no": "int", "step": "string", "others": "map<string,string>", "fields.": "double", "Host": "string", "empty": "string", "fields.family": "string", "fields.host": "string",
        "n": "double", "ok:boolean": "boolean", "ok:string": "string", "fields.ok:string": "double", "fields.others": "double", "fields.step": "string", "sub.x": "double",
    }
    got = {(r["family"], r["line_no"]): {k: v for k, v in r.asDict().items() if v is not None and k not in ("family", "file_name", "line_no", "step", "others", "fields.step")} for r in df.collect()}
    assert df.count() == len(got) == 6 and got == {
        ("a", 1): {"ok:boolean": True, "n": 1.0, "fields.host": "h"}, ("a", 2): {"n": 2.5, "sub.x": 1.0}, ("b", 1): {"ok:string": "yes", "Host": "H", "sub.x": 2.0},
        ("b", 2): {"ok:string": "true"}, ("b", 3): {"fields.family": "f", "fields.others": 3.0, "fields.ok:string": 4.0}, ("c", 1): {"n": 3.0, "fields.": 5.0},
    }


def test_typed_table_keeps_others(spark):
    """What the paths of one name hold besides its value stays in the table, too."""
    lines = "family string, file_name string, line_no int, step string, fields map<string,string>, others map<string,string>"
    rows = spark.createDataFrame([("a", "f", 1, "s", {"n": "1"}, {"m": "2"}), ("b", "g", 1, "s", {"n": "x"}, {})], lines)
    got = {r["family"]: (r["n:double"], r["n:string"], r["others"]) for r in unified_table(rows).collect()}
    assert got == {"a": (1.0, None, {"m": "2"}), "b": (None, "x", {})}
    assert [r["n"] for r in unified_table(rows, "a").collect()] == [1.0]


def test_unified_rows_keep_every_line(spark):
    """Lines without a field, without a family, and repeated with other values."""
    day = datetime(2024, 1, 1)
    bodies = [("fam", 1, "{}"), ("fam", 2, '{"sub": {}}'), (None, 3, '{"step": "s", "n": "x"}'), ("fam", 4, '{"n": 1, "a": {"b": 1}, "a.b": 2}'), ("fam", 4, '{"n": 3, "m": null}')]
    df = spark.createDataFrame([(family, "f", day, n, body) for family, n, body in bodies], "family string, file_name string, recorded_at timestamp_ntz, line_no int, body string")
    rows = unified_rows(df, schema_changes(df))
    assert {r.line_no: (r.family, r.fields) for r in rows.collect()} == {1: ("fam", {}), 2: ("fam", {}), 3: (None, {"step": "s", "n": "x"}), 4: ("fam", {"a.b": "2", "n": "3", "m": None})}
    assert {r["line_no"]: (r["n:double"], r["n:string"]) for r in unified_table(rows).collect()} == {1: (None, None), 2: (None, None), 3: (None, "x"), 4: (3.0, None)}


def test_schema_drift_empty_and_nested(spark):
    assert schema_changes(receipts(spark, [])).count() == 0
    deep = "{" + '"a":{' * 3_000 + "}" * 3_001
    got = schema_changes(receipts(spark, [[{"step": "1"}], [deep, {"step": "1"}]])).collect()
    assert sorted(r.field_path for r in got) == sorted(".".join("a" * n) for n in range(1, 3_001)) and {r.change_kind for r in got} == {"added"}
    brackets = {"step": "1", "text": "[{" * 300}
    assert [r.field_path for r in schema_changes(receipts(spark, [[{"step": "1"}], [brackets]])).collect()] == ["text"]


def test_lines_of_any_nesting():
    """The reader with its own stack agrees with the library on what both can read."""
    values = [{}, [], {"a": [1, {"b": []}, "x,]}"], "c": {"d": None, "e": -1.5e3, "é\\\"": True}}, [[[]], {"k": {}}], "s", 7, None]
    for v in values:
        for text in (json.dumps(v), json.dumps(v, indent=2), json.dumps(v, ensure_ascii=False)):
            assert read_deep(text) == v
    for bad in ("{", "[1,]", '{"a" 1}', '{"a":1,}', "[1 2]", "{} {}", '{"a":}', "nul", '{a:1}', "]"):
        with pytest.raises(ValueError):
            read_deep(bad)
    deep = readable("{" + '"a":{' * 50_000 + "}" * 50_001)
    assert len(object_hashes(deep)) == 50_001
    nested: list = []
    for _ in range(50_000):
        nested = [nested]
    assert canonical(nested) == "" and canonical(["a", ["b", 7.0], {"k": [1]}]) == 'a,b,7,{"k":1,}'
