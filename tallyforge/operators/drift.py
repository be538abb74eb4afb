"""Schemas that drift between the files of a family."""

from __future__ import annotations

import json
import re
from collections import defaultdict
from json.decoder import scanstring

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.session import bounded_rows, cut

REGISTERS = 1024  # registers of a path's value sketch
MIN_SCORE = 0.5  # least score of a rename
VALUE_BITS = 24  # low bits of a register that tell the value; the rest tell the step
MERGED = 1_024  # input partitions whose sketches of one file and path are merged at once
CELLS = 200_000  # sketch cells a worker holds before it hands them over
# JSON type names by bit.
TYPES = ["string", "number", "boolean", "array", "object"]


def _scalar(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return str(int(v)) if v == v and abs(v) < 1e18 and v == int(v) else repr(float(v))
    return "" if v is None else str(v).strip()


def canonical(v) -> str:
    """A JSON value as text that survives a change of type: 7, 7.0 and "7" agree, as do ["x"] and "x". Nesting has no limit."""
    if not isinstance(v, (list, dict)):
        return _scalar(v)
    out, stack = [], [v]
    while stack:
        x = stack.pop()
        if isinstance(x, _Sign):
            out.append(x)
        elif isinstance(x, list):
            stack += [y for item in reversed(x) for y in (item, _COMMA)][:-1]
        elif isinstance(x, dict):
            stack.append(_CLOSE)
            for k in sorted(x, reverse=True):
                stack += [_COMMA, x[k], _Sign(json.dumps(k, ensure_ascii=False) + ":")]
            stack.append(_OPEN)
        else:
            out.append(_scalar(x))
    return "".join(out)


class _Sign(str):
    """Punctuation of a canonical text."""


_COMMA, _OPEN, _CLOSE = _Sign(","), _Sign("{"), _Sign("}")


def type_bit(v) -> int:
    if v is None:
        return 0
    if isinstance(v, bool):
        return 4
    if isinstance(v, (int, float)):
        return 2
    return 1 if isinstance(v, str) else 8 if isinstance(v, list) else 16


def fields_of(obj: dict, prefix: str = ""):
    """(dotted path, value) of every key at any depth of objects; arrays are not entered."""
    stack = [(prefix, obj)]
    while stack:
        at, o = stack.pop()
        for k, v in o.items():
            path = f"{at}.{k}" if at else str(k)
            yield path, v
            if isinstance(v, dict):
                stack.append((path, v))


_SPACE = re.compile(r"[ \t\n\r]*")
_ATOM = re.compile(r"true|false|null|NaN|-?Infinity|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?")


def read_deep(text: str):
    """A JSON text of any nesting, read with a stack of its own. ValueError where it is none."""
    stack: list = []  # open containers; a dict is followed by the key that waits for its value
    at, done = 0, None
    while True:
        at = _SPACE.match(text, at).end()
        c = text[at : at + 1]
        if c == "{" or c == "[":
            stack.append({} if c == "{" else [])
            at = _SPACE.match(text, at + 1).end()
            if text[at : at + 1] == ("}" if c == "{" else "]"):
                at, done = at + 1, stack.pop()
            else:
                if c == "{":
                    at = _read_key(text, at, stack)
                continue
        elif c == '"':
            done, at = scanstring(text, at + 1)
        else:
            m = _ATOM.match(text, at)
            if not m:
                raise ValueError("no JSON")
            done, at = json.loads(m.group()), m.end()
        while stack:  # the value is whole: it goes into its container, which may be whole, too
            if isinstance(stack[-1], list):
                stack[-1].append(done)
                close = "]"
            else:
                key = stack.pop()
                stack[-1][key] = done
                close = "}"
            at = _SPACE.match(text, at).end()
            c = text[at : at + 1]
            if c == close:
                at, done = at + 1, stack.pop()
            elif c == ",":
                at += 1
                if close == "}":
                    at = _read_key(text, _SPACE.match(text, at).end(), stack)
                break
            else:
                raise ValueError("no JSON")
        else:
            if _SPACE.match(text, at).end() != len(text):
                raise ValueError("more than one JSON value")
            return done


def _read_key(text: str, at: int, stack: list) -> int:
    if text[at : at + 1] != '"':
        raise ValueError("no key")
    key, at = scanstring(text, at + 1)
    at = _SPACE.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError("no value")
    stack.append(_Key(key))
    return at + 1


class _Key(str):
    """An object's key that waits for its value."""


def readable(body: str | None) -> dict | None:
    """The object of a line, or None for null, blank, broken or other lines. Nesting has no limit."""
    if not body or not body.strip():
        return None
    try:
        obj = json.loads(body)
    except RecursionError:
        try:
            obj = read_deep(body)
        except ValueError:
            return None
    except ValueError:
        return None
    return obj if isinstance(obj, dict) else None


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def object_hashes(obj: dict) -> dict[int, int]:
    """The hash of every object at any depth by its id, from its keys' and their values' hashes, so that nesting costs nothing twice."""
    order, stack, out = [], [obj], {}
    while stack:
        o = stack.pop()
        order.append(o)
        stack += [v for v in o.values() if isinstance(v, dict)]
    for o in reversed(order):
        out[id(o)] = _hash("{" + ",".join(sorted(f"{k}:{out[id(v)] if isinstance(v, dict) else canonical(v)}" for k, v in o.items())) + "}")
    return out


def _profile_lines(step_field: str):
    """Sketch cells of lines, reduced per file and path: types, and per register the least of (step hash, value hash) packed in one number."""
    names = ["family", "file_name", "path", "types", "sketch"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int32()]

    def rows(seen: dict) -> pa.RecordBatch:
        out: list[list] = [[] for _ in kinds]
        registers, cells, ends = [], [], [0]
        for (family, file), paths in seen.items():
            for path, (bits, sketch) in paths.items():
                for column, x in zip(out, (family, file, path, bits)):
                    column.append(x)
                order = sorted(sketch)
                registers += order
                cells += map(sketch.__getitem__, order)
                ends.append(len(registers))
        entries = pa.StructArray.from_arrays([pa.array(registers, pa.int32()), pa.array(cells, pa.int64())], ["register", "cell"])
        sketches = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)
        return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(out, kinds)), sketches], names)

    def run(batches):
        seen: dict = defaultdict(dict)
        held = 0
        for batch in batches:
            for family, file, body in zip(*(batch.column(c).to_pylist() for c in ("family", "file_name", "body"))):
                obj = readable(body)
                if obj is None:
                    continue
                paths = seen[family, file]
                step = obj.get(step_field)
                known = step is not None
                sh = _hash(canonical(step)) if known else 0
                register, high = sh % REGISTERS, (sh >> (VALUE_BITS + 1)) << VALUE_BITS
                objects = object_hashes(obj) if known else {}
                for path, v in fields_of(obj):
                    bit = type_bit(v)
                    entry = paths.get(path)
                    if entry is None:
                        entry = paths[path] = [0, {}]
                        held += 1 + len(path) // 64
                    entry[0] |= bit
                    if known and bit:
                        vh = objects[id(v)] if bit == 16 else _hash(canonical(v))
                        cell = high | (vh & ((1 << VALUE_BITS) - 1))
                        old = entry[1].get(register)
                        if old is None:
                            held += 1
                        if old is None or cell < old:
                            entry[1][register] = cell
                    if held > CELLS:
                        yield rows(seen)
                        seen.clear()
                        paths, held = seen[family, file], 0
        yield rows(seen)

    return run


def file_profiles(df: DataFrame, step_field: str = "step") -> DataFrame:
    """Per family, file and path: the JSON types seen and a value sketch, of all readable lines.

    A sketch has at most REGISTERS registers by step hash, each with the least step hash and that step's value hash; two
    sketches tell on how many common steps two paths agree. A worker hands over one sketch per file and path. They are
    merged in two levels, first over MERGED input partitions each, so that no task gathers more than that many sketches.
    """
    lines = df.select("family", "file_name", "body").filter(F.col("file_name").isNotNull())
    parts = lines.mapInArrow(_profile_lines(step_field), "family string, file_name string, path string, types int, sketch array<struct<register int, cell long>>")
    key = ["family", "file_name", "path"]
    return _merged(_merged(parts.withColumn("level", F.expr(f"spark_partition_id() div {MERGED}")), [*key, "level"]), key)


def _merged(sketches: DataFrame, key: list[str]) -> DataFrame:
    """One sketch per key: the least cell of every register, in order."""
    several = sketches.groupBy(*key).agg(F.bit_or("types").alias("types"), F.collect_list("sketch").alias("all"))
    return several.withColumn("all", F.when(F.size("all") == 1, F.col("all")[0]).otherwise(F.array_sort(F.flatten("all")))).select(
        *key, "types", F.expr("filter(all, (x, i) -> i = 0 or x.register <> all[i - 1].register)").alias("sketch")
    )


def file_order(df: DataFrame) -> DataFrame:
    """(family, file_name, prev_file, seq): the files of each family by recorded_at, then name."""
    files = df.filter(F.col("file_name").isNotNull()).groupBy("family", "file_name").agg(F.min("recorded_at").alias("rec"))
    w = Window.partitionBy("family").orderBy("rec", "file_name")
    return files.select("family", "file_name", F.lag("file_name").over(w).alias("prev_file"), F.row_number().over(w).alias("seq"))


def name_similarity(a: str, b: str) -> float:
    """Share of common letter pairs of two names' last parts."""
    def grams(s: str) -> set[str]:
        s = "_" + s.rpartition(".")[2].lower() + "_"
        return {s[i : i + 2] for i in range(len(s) - 1)}

    x, y = grams(a), grams(b)
    return 2 * len(x & y) / (len(x) + len(y))


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Least-cost matching of rows to columns (shortest augmenting paths with potentials)."""
    flip = cost.shape[0] > cost.shape[1]
    c = cost.T if flip else cost
    n, m = c.shape
    u, v, way, row_of = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        row_of[0], j0 = i, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0 = row_of[j0]
            free = np.flatnonzero(~used[1:]) + 1
            reduced = c[i0 - 1, free - 1] - u[i0] - v[free]
            better = reduced < least[free]
            least[free[better]], way[free[better]] = reduced[better], j0
            j1 = free[np.argmin(least[free])]
            delta = least[j1]
            u[row_of[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if row_of[j0] == 0:
                break
        while j0:
            row_of[j0], j0 = row_of[way[j0]], way[j0]
    pairs = [(int(row_of[j]) - 1, j - 1) for j in range(1, m + 1) if row_of[j]]
    return [(b, a) for a, b in pairs] if flip else pairs


def rename_score(old: dict, new: dict) -> float:
    """How well a new path carries on an old one: agreement on common steps, weighed by how telling the values are, and name and type as minor evidence."""
    a, b = old["sketch"], new["sketch"]
    common = [r for r in a.keys() & b.keys() if a[r] >> VALUE_BITS == b[r] >> VALUE_BITS]
    agree = sum(a[r] == b[r] for r in common)
    if not agree:
        return 0.0
    distinct = len({a[r] & ((1 << VALUE_BITS) - 1) for r in common})
    telling = 1.0 if distinct > 2 else 0.75 if distinct == 2 else 0.6
    name = name_similarity(old["path"], new["path"])
    same_type = bool(old["types"] & new["types"])
    return agree / len(common) * telling * (1 if len(common) > 1 else 0.9) + 0.3 * name + 0.05 * same_type - 0.05


def _match_paths(batches):
    """Renames of each file: gone and new paths matched in pairs at the greatest total score."""
    names = ["family", "file_name", "old_path", "new_path", "score", "old_types", "new_types"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.int32(), pa.int32()]
    for batch in batches:
        out: list[list] = [[] for _ in names]
        for family, file, rows in zip(*(batch.column(c).to_pylist() for c in ("family", "file_name", "rows"))):
            rows = sorted((r | {"sketch": {e["register"]: e["cell"] for e in r["sketch"]}} for r in rows), key=lambda r: r["path"])
            old, new = [r for r in rows if r["side"] == "removed"], [r for r in rows if r["side"] == "added"]
            score = np.array([[rename_score(a, b) for b in new] for a in old])
            score[score < MIN_SCORE] = 0
            for i, j in assign(-score):
                if score[i, j] > 0:
                    for column, x in zip(out, (family, file, old[i]["path"], new[j]["path"], float(score[i, j]), old[i]["types"], new[j]["types"])):
                        column.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def schema_changes(df: DataFrame, step_field: str = "step") -> DataFrame:
    """One row per change of field and file against the file before it: family, file_name, field_path, change_kind, new_path, score.

    Kinds: added, removed, retyped and renamed. Null, blank, broken and non-object lines are skipped; a file without any
    readable line has no fields. The first file of a family gives no row. Repeated lines change nothing. Groups of the
    matching step hold the gone and new paths of one file, whose number is a schema's width and not a row count.
    """
    profiles = cut(file_profiles(df, step_field), "profiles")
    order = file_order(df)
    now = profiles.join(order.filter("prev_file is not null").select("family", "file_name"), ["family", "file_name"])
    after = order.filter("prev_file is not null").select("family", F.col("file_name").alias("next_file"), F.col("prev_file").alias("file_name"))
    before = profiles.join(after, ["family", "file_name"]).select("family", F.col("next_file").alias("file_name"), "path", F.col("types").alias("old_types"), F.col("sketch").alias("old_sketch"))
    pairs = before.join(now, ["family", "file_name", "path"], "full_outer").filter(~F.col("types").eqNullSafe(F.col("old_types")))
    side = F.when(F.col("types").isNull(), "removed").when(F.col("old_types").isNull(), "added").otherwise("retyped")
    changed = cut(pairs.select("family", "file_name", "path", side.alias("side"), F.coalesce("types", "old_types").alias("types"), F.coalesce("sketch", "old_sketch").alias("sketch")), "changed")
    moved = changed.filter("side <> 'retyped'")
    # Only files that both lost and gained a path can hold a rename. A number of partitions is named, since AQE would put so few bytes in one task.
    per_file = moved.groupBy("family", "file_name").agg(F.collect_list(F.struct("side", "path", "types", "sketch")).alias("rows"), F.countDistinct("side").alias("sides")).filter("sides = 2").drop("sides")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    renames = cut(per_file.repartition(tasks, "family", "file_name").mapInArrow(_match_paths, "family string, file_name string, old_path string, new_path string, score double, old_types int, new_types int"), "renames")
    row = lambda path, kind, new, score: F.struct(path.alias("field_path"), F.lit(kind).alias("change_kind"), new.alias("new_path"), score.alias("score"))
    none = F.lit(None).cast("double")
    renamed = renames.select("family", "file_name", F.explode(F.filter(F.array(
        row(F.col("old_path"), "renamed", F.col("new_path"), F.col("score")),
        F.when(F.col("old_types") != F.col("new_types"), row(F.col("new_path"), "retyped", F.lit(""), none)),
    ), lambda x: x.isNotNull())).alias("r")).select("family", "file_name", "r.*")
    taken = renames.select("family", "file_name", F.explode(F.array(F.struct(F.lit("removed").alias("side"), F.col("old_path").alias("path")), F.struct(F.lit("added").alias("side"), F.col("new_path").alias("path")))).alias("t")).select("family", "file_name", "t.side", "t.path")
    rest = changed.join(taken, ["family", "file_name", "side", "path"], "left_anti").select("family", "file_name", F.col("path").alias("field_path"), F.col("side").alias("change_kind"), F.lit("").alias("new_path"), none.alias("score"))
    return renamed.unionByName(rest)


def _latest_names(pdf: pd.DataFrame) -> pd.DataFrame:
    """Where each path of a family's renames ends up, by file order: (path, from seq before which the name was used, latest name)."""
    pdf = pdf.sort_values(["seq", "field_path"], ascending=False)
    target: dict[str, str] = {}
    spans: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for seq, old, new in zip(pdf.seq, pdf.field_path, pdf.new_path):
        target[old] = target.get(new, new)
        spans[old].append((int(seq), target[old]))
    return pd.DataFrame([(pdf.family.iloc[0], p, s, t) for p, x in spans.items() for s, t in x], columns=["family", "path", "before_seq", "unified"])


def _cells_of(step_field: str):
    """Per readable line the path and the value as text of every leaf."""
    names = ["family", "file_name", "line_no", "step", "cells"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.string()]

    def rows(lines: list[tuple], paths: list, values: list, ends: list) -> pa.RecordBatch:
        columns = zip(*lines) if lines else [[] for _ in kinds]
        entries = pa.StructArray.from_arrays([pa.array(paths, pa.string()), pa.array(values, pa.string())], ["path", "value"])
        return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)], names)

    def run(batches):
        for batch in batches:
            lines, paths, values, ends = [], [], [], [0]
            for family, file, line, body in zip(*(batch.column(c).to_pylist() for c in ("family", "file_name", "line_no", "body"))):
                obj = readable(body)
                if obj is None:
                    continue
                step = obj.get(step_field)
                for path, v in fields_of(obj):
                    if not isinstance(v, dict):
                        paths.append(path)
                        values.append(None if v is None else canonical(v))
                lines.append((family, file, line, None if step is None else canonical(step)))
                ends.append(len(paths))
                if len(paths) > CELLS:
                    yield rows(lines, paths, values, ends)
                    lines, paths, values, ends = [], [], [], [0]
            yield rows(lines, paths, values, ends)

    return run


def unified_rows(df: DataFrame, changes: DataFrame, step_field: str = "step") -> DataFrame:
    """All readable lines in one table: family, file_name, line_no, step, fields and others.

    fields is a map from each leaf's latest name to its value as text: a path that was renamed later, at once or in several
    steps, stands under its last name. Where two paths of a line end in one name, the one that has this name or was renamed
    last gives the value; what the others hold stays in `others`, by their own paths. `unified_table` gives typed columns.
    Lines stay whole: only the paths of each file, not each line's, meet the renames.
    """
    order = file_order(df)
    renames = changes.filter("change_kind = 'renamed'").join(order, ["family", "file_name"]).select("family", "seq", "field_path", "new_path")
    latest = renames.groupBy("family").applyInPandas(_latest_names, "family string, path string, before_seq int, unified string")

    line, file = ["family", "file_name", "line_no", "step"], ["family", "file_name"]
    read = df.select("family", "file_name", "line_no", "body").filter("file_name is not null").mapInArrow(_cells_of(step_field), "family string, file_name string, line_no int, step string, cells array<struct<path string, value string>>")
    # A line that is repeated with other values keeps the greatest value of each path.
    several = read.groupBy(*line).agg(F.array_sort(F.flatten(F.collect_list("cells"))).alias("cells"))
    lines = cut(several.select(*line, F.expr("filter(cells, (x, i) -> i = size(cells) - 1 or x.path <> cells[i + 1].path)").alias("cells")), "lines")

    paths = lines.select(*file, F.explode("cells.path").alias("path")).distinct()
    hit = paths.join(latest, ["family", "path"]).join(order.select(*file, "seq"), file).filter("before_seq > seq")
    first = hit.groupBy(*file, "path").agg(F.min(F.struct("before_seq", "unified")).alias("name"))
    names = first.groupBy(*file).agg(F.map_from_entries(F.collect_list(F.struct("path", "name"))).alias("names"))
    named = lines.join(names, file, "left").withColumn("named", F.expr("""array_sort(transform(cells, c -> named_struct(
        'field', coalesce(try_element_at(names, c.path).unified, c.path), 'own', c.path = coalesce(try_element_at(names, c.path).unified, c.path),
        'seq', coalesce(try_element_at(names, c.path).before_seq, 0), 'path', c.path, 'value', c.value)))"""))
    last = "i = size(named) - 1 or x.field <> named[i + 1].field"
    return named.select(
        *line, F.expr(f"map_from_entries(transform(filter(named, (x, i) -> {last}), x -> struct(x.field, x.value)))").alias("fields"),
        F.expr(f"map_from_entries(array_sort(transform(filter(named, (x, i) -> not ({last})), x -> struct(x.path, x.value))))").alias("others"),
    )


MAX_FIELDS = 10_000  # fields of a table's schema; more is an error


def unified_table(rows: DataFrame, family: str | None = None) -> DataFrame:
    """The lines of `unified_rows`, of all families or of one, with typed columns: family, file_name, line_no, step, others, then the fields by name.

    In its family a field is boolean or double if all its values are, else string; one without any value has no type there.
    A field of one type in all families is one column, string where it has no value at all. Where families differ there is a
    column per type, `field:type`, and a line's value stands in the one of its family. Names count without case; `fields.` is put
    before a name that is taken. The driver gets one row per field of the schema.
    """
    mine = rows if family is None else rows.filter(F.col("family") == family)
    values = mine.select("family", F.explode("fields").alias("field", "v"))
    number, flag = F.col("v").try_cast("double").isNotNull(), F.col("v").isin("true", "false")
    known = values.groupBy("family", "field").agg(F.count("v").alias("n"), F.count_if(number).alias("numbers"), F.count_if(flag).alias("flags"))
    kind = F.when(F.col("n") == 0, None).when(F.col("flags") == F.col("n"), "boolean").when(F.col("numbers") == F.col("n"), "double").otherwise("string")
    kinds = cut(known.select("family", "field", kind.alias("kind")), "kinds")
    schema = sorted(tuple(r) for r in bounded_rows(kinds.groupBy("field").agg(F.array_sort(F.collect_set("kind"))), MAX_FIELDS, "fields of a table"))
    several = [f for f, types in schema if len(types) > 1]
    if several:
        own = kinds.filter(F.col("field").isin(several) & F.col("kind").isNotNull()).groupBy(F.col("family").alias("_family")).agg(F.map_from_entries(F.collect_list(F.struct("field", "kind"))).alias("_kinds"))
        mine = mine.join(own, F.col("family").eqNullSafe(F.col("_family")), "left")
    first = ["family", "file_name", "line_no", "step", "others"]
    columns, taken = [], set(first)
    for f, types in schema:
        value = F.try_element_at("fields", F.lit(f))
        for t in types or ["string"]:
            name = f if len(types) < 2 else f"{f}:{t}"
            while not name or name.lower() in taken:
                name = f"fields.{name}"
            taken.add(name.lower())
            columns.append((value if len(types) < 2 else F.when(F.try_element_at("_kinds", F.lit(f)) == t, value)).cast(t).alias(name))
    return mine.select(*first, *columns)
