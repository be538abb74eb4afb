"""Several values packed in one field, split by minimum description length.

A dialect says which delimiters split a field, whether double quotes enclose values, and whether outer list brackets
belong to the notation. Every field is parsed under each dialect its characters allow. A parse costs the bits of its
dialect plus the bits of its values; the bits of a value come from a first-order chain over token classes whose counts
are gathered over the whole column by all executors. The cheapest dialect wins.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Delimiters a field may use. A run of slashes is one delimiter.
DELIMITERS = [",", ";", "|", "/", "／", "&", "+", "\t", "\n", "∧"]
# Words that join two values; in a shape they are written as one sign.
CONJUNCTIONS = ["and", "und", "y", "et"]
WORD, SHORT, SUFFIX, REMARK, NUMBER, CONJ = "●", "○", "§", "□", "#", "∧"
MAX_WORDS = 5  # word counts beyond this share one state of the chain
START, END = "^", "$"
#: Bits of a step never or hardly seen.
MAX_STEP_BITS = 12.0
#: Bits of a value without any word: suffixes, remarks and numbers belong to the value beside them.
WORDLESS_BITS = 12.0
#: Bits of a delimiter left standing inside an unquoted value: a comma also parts surname and given name, the others hardly occur.
INSIDE_BITS = {d: 8.0 for d in DELIMITERS} | {",": 1.0}

_CANDIDATE = r"""[,;|/／&+\t\n"\[]|\s(?i:and|und|y|et)\s"""
_ROUND = re.compile(r"\([^()]*\)")
_SQUARE = re.compile(r"(?<=.)\[[^\[\]\",;|/&+]+\]", re.S)
_QUOTED = re.compile(r'"((?:[^"]|"")*)"')


def candidate(text: Column) -> Column:
    """True where a field has any sign that could pack values."""
    return F.coalesce(text.rlike(_CANDIDATE), F.lit(False))


def shape(text: Column) -> Column:
    """Token classes and punctuation of a field. Letters go, delimiters, quotes and brackets stay."""
    steps = [
        (r"\([^()]*\)", REMARK),
        (r'(?<=.)\[[^\[\]",;|/&+]+\]', REMARK),
        (r"(?i)(?<=\s)(?:and|und|y|et)(?=\s)", CONJ),
        (r"(?<![\p{L}\p{M}])(?:Jr|Sr|JR|SR|II|III|IV)(?![\p{L}\p{M}])\.?", SUFFIX),
        (r"(?<![\p{L}\p{M}'’-])[\p{L}\p{M}'’-]++[.…]", SHORT),
        (r"(?<![\p{L}\p{M}'’-])\p{L}\p{M}*(?![\p{L}\p{M}'’-])", SHORT),
        (r"[\p{L}\p{M}][\p{L}\p{M}'’-]*+", WORD),
        (r"\p{N}++", NUMBER),
        (r"[  ]+", " "),
    ]
    for pattern, sign in steps:
        text = F.regexp_replace(text, pattern, sign)
    return text


def _splitter(delims: frozenset[str], in_shape: bool) -> re.Pattern | None:
    parts = []
    for d in sorted(delims):
        if d == CONJ:
            parts.append(CONJ if in_shape else r"(?<=\s)(?i:" + "|".join(CONJUNCTIONS) + r")(?=\s)")
        else:
            parts.append("/+" if d == "/" else re.escape(d))
    return re.compile("|".join(parts)) if parts else None


_SPLITTERS: dict = {}


def parse(text: str, masked: str, dialect: tuple[frozenset[str], bool, bool], in_shape: bool = False) -> list[str] | None:
    """The values of text under a dialect (delimiters, quotes, brackets), or None where it does not apply.

    masked equals text but for remarks in brackets, whose characters are blanked so that nothing inside them splits.
    """
    delims, quotes, brackets = dialect
    key = (delims, in_shape)
    if key not in _SPLITTERS:
        _SPLITTERS[key] = _splitter(delims, in_shape)
    split = _SPLITTERS[key]
    if brackets:
        core = text.strip()
        if len(core) < 2 or core[0] != "[" or core[-1] != "]":
            return None
        at = text.index("[")
        end = text.rindex("]")
        text, masked = text[at + 1 : end], masked[at + 1 : end]
    out, pos, quoted, n = [], 0, 0, len(text)
    while pos <= n:
        if quotes:
            lead = pos
            while lead < n and text[lead].isspace() and text[lead] not in delims:
                lead += 1
            if lead < n and text[lead] == '"' and (m := _QUOTED.match(text, lead)):
                stop = m.end()
                while stop < n and text[stop].isspace() and text[stop] not in delims:
                    stop += 1
                after = split.match(masked, stop) if split and stop < n else None
                if stop == n or after:
                    out.append(m.group(1).replace('""', '"').strip())
                    quoted += 1
                    if stop == n:
                        break
                    pos = after.end()
                    continue
        m = split.search(masked, pos) if split else None
        out.append(text[pos : m.start() if m else n].strip())
        if not m:
            break
        pos = m.end()
    if quotes and not quoted:
        return None
    return [v for v in out if v]


def mask(text: str) -> str:
    """text with the characters of remarks in brackets blanked."""
    if "(" in text:
        text = _ROUND.sub(lambda m: "_" * len(m.group()), text)
    if "[" in text:
        text = _SQUARE.sub(lambda m: "_" * len(m.group()), text)
    return text


def dialects(shape_text: str) -> list[tuple[frozenset[str], bool, bool]]:
    """The dialects a shape allows: every set of its delimiters, at most two to the power of their number, with quotes and brackets."""
    present = [d for d in DELIMITERS if d in shape_text]
    sets = [frozenset(c) for k in range(len(present) + 1) for c in combinations(present, k)]
    core = shape_text.strip()
    quotes = [False, True] if '"' in shape_text else [False]
    brackets = [False, True] if core[:1] == "[" and core[-1:] == "]" else [False]
    return [(s, q, b) for s in sets for q in quotes for b in brackets]


def steps_of(value: str) -> Iterator[tuple[int, str, str]]:
    """(words so far, class, next class) along a value's shape. Short forms count as words, so that rare initials share the words' bits."""
    words, before = 0, START
    for sign in value.replace(SHORT, WORD):
        if sign == " ":
            continue
        yield words, before, sign
        if sign == WORD:
            words = min(words + 1, MAX_WORDS)
        before = sign
    yield words, before, END


def inside_bits(values: list[str], dialect: tuple[frozenset[str], bool, bool]) -> float:
    """Bits of the delimiters that stand inside values which no quotes protect."""
    return 0.0 if dialect[1] else sum(bits * v.count(d) for v in values for d, bits in INSIDE_BITS.items())


class ValueCode:
    """Code lengths of values from counted chain steps; unseen steps get the bits of a small constant."""

    def __init__(self, counts: dict[tuple[int, str, str], float]):
        self.counts = counts
        self.totals: dict[tuple[int, str], float] = defaultdict(float)
        for (words, before, _), n in counts.items():
            self.totals[words, before] += n
        self._known: dict[str, float] = {}
        self.chosen: dict[str, tuple] = {}

    def bits(self, value: str) -> float:
        """The bits of a value's shape. Shapes repeat across values and dialects, so they are remembered."""
        known = self._known.get(value)
        if known is None:
            if len(self._known) > 100_000:
                self._known.clear()
            known = self._known[value] = self._bits(value)
        return known

    def _bits(self, value: str) -> float:
        total = 0.0 if WORD in value or SHORT in value else WORDLESS_BITS
        for words, before, sign in steps_of(value):
            n = self.counts.get((words, before, sign), 0.0)
            total += min(MAX_STEP_BITS, -math.log2((n + 0.02) / (self.totals.get((words, before), 0.0) + 2.0)))
        return total

    def cost(self, shape_text: str, dialect: tuple[frozenset[str], bool, bool]) -> float | None:
        values = parse(shape_text, shape_text, dialect, in_shape=True)
        if values is None:
            return None
        delims, quotes, brackets = dialect
        joints = max(0, len(values) - 1)
        return (
            3.0 * len(delims) + quotes + brackets + joints * math.log2(1 + len(delims))
            + (joints + 1) + sum(self.bits(v) for v in values) + inside_bits(values, dialect)
        )

    def best(self, shape_text: str) -> tuple[frozenset[str], bool, bool]:
        scored = [(c, len(d[0]), sorted(d[0]), d) for d in dialects(shape_text) if (c := self.cost(shape_text, d)) is not None]
        return min(scored, key=lambda x: x[:3])[3]


NO_CODE = ValueCode({})


def _count_steps(pieces: Iterable[tuple[str, str, float]], code: dict[str, ValueCode] | None) -> dict:
    """Chain steps of shapes by field: of the best parse under code; without one, of all parses by the weight of their inner delimiters."""
    out: dict[tuple[str, int, str, str], float] = defaultdict(float)
    for field, text, n in pieces:
        chosen = [code.get(field, NO_CODE).best(text)] if code else dialects(text)
        parsed = [(p, 2.0 ** -inside_bits(p, d)) for d in chosen if (p := parse(text, text, d, in_shape=True))]
        total = sum(w for _, w in parsed)
        for values, weight in parsed:
            for v in values:
                for words, before, sign in steps_of(v):
                    out[field, words, before, sign] += n * weight / total
    return out


def learn_codes(long: DataFrame, rounds: int = 2) -> dict[str, ValueCode]:
    """Value codes per field from a table (field_name, text) or (field_name, shape), over all its rows.

    The first round counts every parse of a field, weighed by the delimiters it leaves inside values; the next ones count
    its cheapest parse so far.
    Shapes are counted first, with partial sums before the shuffle; each round turns shape counts into chain counts in
    parallel. What reaches the driver is the chain: at most classes squared times MAX_WORDS rows a field, whatever the data.
    """
    shapes = (
        (long.filter(F.col("shape").isNotNull()) if "shape" in long.columns else long.filter(F.col("text").isNotNull()).select("field_name", shape(F.col("text")).alias("shape")))
        .groupBy("field_name", "shape").agg(F.count("*").cast("double").alias("n"))
        .filter(F.length(F.trim("shape")) > 0)
        .persist()
    )
    code = None
    try:
        for _ in range(rounds):
            def count(batches, code=code):
                for pdf in batches:
                    found = _count_steps(zip(pdf.field_name, pdf["shape"], pdf.n), code)
                    yield pd.DataFrame([(*k, v) for k, v in found.items()], columns=["field_name", "words", "a", "b", "n"])

            # Signs outside the known classes fold into one, so the chain is bounded.
            known = "".join(DELIMITERS) + WORD + SHORT + SUFFIX + REMARK + NUMBER + '"[].' + START + END
            fold = lambda c: F.when(F.lit(known).contains(F.col(c)), F.col(c)).otherwise(F.lit("?"))
            rows = (
                shapes.mapInPandas(count, "field_name string, words int, a string, b string, n double")
                .groupBy("field_name", "words", fold("a").alias("a"), fold("b").alias("b")).agg(F.sum("n").alias("n"))
                .collect()
            )
            counts: dict[str, dict] = defaultdict(dict)
            for r in rows:
                counts[r.field_name][r.words, r.a, r.b] = r.n
            code = {f: ValueCode(c) for f, c in counts.items()}
    finally:
        shapes.unpersist()
    return code or {}


def _split_batches(codes: dict[str, ValueCode], keep: list[str]):
    def run(batches):
        best: dict[tuple[str, str], tuple] = {}
        for pdf in batches:
            at, pos, val = [], [], []
            for i, (field, text, form) in enumerate(zip(pdf.field_name, pdf.text, pdf["shape"])):
                key = (field, form)
                if key not in best:
                    if len(best) > 200_000:
                        best.clear()
                    best[key] = codes.get(field, NO_CODE).best(form)
                dialect = best[key]
                if not dialect[0]:
                    continue
                values = parse(text, mask(text), dialect)
                if values and len(values) > 1:
                    at += [i] * len(values)
                    pos += range(1, len(values) + 1)
                    val += values
            out = pdf[keep].iloc[at].reset_index(drop=True)
            out["value_pos"] = pd.Series(pos, dtype="int32")
            out["value_text"] = pd.Series(val, dtype="object")
            yield out

    return run


def long_fields(df: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """(key, field_name, text), one row per field."""
    return df.select(
        *key, F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("text")) for f in fields])).alias("_f")
    ).select(*key, "_f.field_name", "_f.text")


def split_packed(df: DataFrame, key: list[str], fields: list[str], version: str | None = None) -> DataFrame:
    """One row per value of every field that packs two or more: key, field_name, value_pos (from 1), value_text.

    Null, empty and blank fields, single values and lone values with a stray delimiter give no row; empty values are not
    counted. Repeated rows of a key give its values once, those of the row with the greatest `version` (ties: the
    greatest text) among its packed rows. Texts of any length are parsed whole; other columns are ignored. An empty
    table gives an empty result.
    """
    long = long_fields(df, [*key, *([version] if version else [])], fields)
    codes = learn_codes(long)
    latest = F.struct(*([F.col(version)] if version else []), F.col("text"))
    once = (
        long.filter(candidate(F.col("text")))
        .groupBy(*key, "field_name").agg(F.max(latest).alias("_m"))
        .select(*key, "field_name", F.col("_m.text").alias("text"))
        .withColumn("shape", shape(F.col("text")))
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in once.select(*key, "field_name").schema)
    return once.mapInPandas(_split_batches(codes, [*key, "field_name"]), f"{schema}, value_pos int, value_text string")


def is_packed(text: str, form: str, code: ValueCode) -> bool:
    """Whether one field holds two or more values under its cheapest dialect. Shapes repeat, so their dialects are remembered."""
    dialect = code.chosen.get(form)
    if dialect is None:
        if len(code.chosen) > 100_000:
            code.chosen.clear()
        dialect = code.chosen[form] = code.best(form)
    return bool(dialect[0]) and len(parse(text, mask(text), dialect) or []) > 1
