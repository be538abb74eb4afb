"""Encoding of a whole corpus with a public byte-level BPE.

Every text of 2 * LEAF_CHARS characters or more is encoded by tree concatenation: halves are encoded on their own, down to
leaves, and joined pair by pair. A text is halved where the split pattern itself ends a run, if there is such a place near
the middle; then both sides agree at once. Else the cut lies inside an unsplit run, and growing windows around the join
are encoded again until both of their ends agree with the tokens outside. Two neighbouring tokens agree if encoding their
joined bytes gives just the two; a sequence all of whose neighbours agree is the encoding of its bytes, so the result is
exact. Very long texts are cut into parts that several tasks encode at the same time; their joins are the same.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The split pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

LEAF_CHARS = 256  # characters of a leaf of a text's tree
SAFE_REACH = 200  # characters behind the middle in which a place is looked for where the pattern ends a run
LONG_RUN = 1_000  # characters of one unsplit run from which it is encoded as a tree
LEAF_BYTES = 256  # bytes encoded at once at a tree's leaves
WINDOW = 4  # tokens on each side of a join's first window
LONG_TEXT = 100_000  # characters from which a text is cut into parts that several tasks encode
SLICE_BYTES = 4_000_000  # bytes of text encoded before their ids are handed over
PART = 50_000  # characters of such a part

_RUNS = regex.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))
_SPLIT = regex.compile(PATTERN)
_ENCODERS: dict[str, "Encoder"] = {}


class Part(NamedTuple):
    """An encoded stretch of text: ids, the tokens of its first and of its last run, and whether it is a single run."""

    ids: list[int]
    first: int
    last: int
    single: bool


class Encoder:
    """One vocabulary in one Python worker."""

    def __init__(self, vocabulary: str):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("corpus", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {v: k for k, v in ranks.items()}

    def leaf(self, raw: bytes) -> list[int]:
        return self.bpe._core_bpe.encode_single_piece(raw)

    def agree(self, a: int, b: int) -> bool:
        return self.leaf(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded halves of one run."""
        if not left or not right:
            return left or right
        k = WINDOW
        while True:
            i, j = max(0, len(left) - k), min(len(right), k)
            window = self.leaf(b"".join(self.bytes_of[t] for t in left[i:] + right[:j]))
            if (i == 0 or self.agree(left[i - 1], window[0])) and (j == len(right) or self.agree(window[-1], right[j])):
                return left[:i] + window + right[j:]
            k *= 2

    def run(self, raw: bytes) -> list[int]:
        """The encoding of one unsplit run: leaves first, then joins level by level."""
        if len(raw) <= LEAF_BYTES:
            return self.leaf(raw)
        parts = [self.leaf(raw[i : i + LEAF_BYTES]) for i in range(0, len(raw), LEAF_BYTES)]
        while len(parts) > 1:
            parts = [self.join(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def text(self, text: str | None) -> list[int]:
        """The ids of a text; none for an empty or null one."""
        return self.tree(text).ids if text else []

    def tree(self, text: str, goes_on: bool = False, open_end: bool = False) -> "Part":
        """A text's encoding by halves. goes_on and open_end: whether its first or last run reaches beyond it."""
        at, inside = cut_at(text, len(text) // 2) if len(text) >= 2 * LEAF_CHARS else (len(text), False)
        if at >= len(text):
            return self.whole(text, goes_on or open_end)
        return self.concat(self.tree(text[:at], goes_on, inside), self.tree(text[at:], inside, open_end), inside)

    def whole(self, text: str, edges: bool) -> "Part":
        """A leaf, with the tokens of its first and last run if `edges` asks for them."""
        if edges or (len(text) >= LONG_RUN and _RUNS.search(text)):
            runs = self.runs(text)
            return Part([t for r in runs for t in r], len(runs[0]), len(runs[-1]), len(runs) == 1)
        return Part(self.bpe.encode_ordinary(text), 0, 0, False)

    def concat(self, a: "Part", b: "Part", inside: bool) -> "Part":
        """Two neighbouring parts as one; if the cut lies inside a run, its two pieces are joined by windows."""
        if not inside:
            return Part(a.ids + b.ids, a.first, b.last, False)
        middle = self.join(a.ids[len(a.ids) - a.last :], b.ids[: b.first])
        ids = a.ids[: len(a.ids) - a.last] + middle + b.ids[b.first :]
        return Part(ids, len(middle) if a.single else a.first, len(middle) if b.single else b.last, a.single and b.single)

    def runs(self, text: str) -> list[list[int]]:
        return [self.run(m.group().encode("utf-8")) for m in _SPLIT.finditer(text)]


def encoder(vocabulary: str) -> Encoder:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


@lru_cache(maxsize=65_536)
def _class(c: str) -> str:
    return "s" if c.isspace() else "l" if regex.match(r"\p{L}", c) else "n" if regex.match(r"\p{N}", c) else "o"


def cut_at(text: str, near: int) -> tuple[int, bool]:
    """The first place from `near` on where a text may be cut, and whether the cut lies inside one run.

    Between a sign and following white space, and between two signs of different classes (but after white space or an
    apostrophe), runs end by the pattern itself. Deep inside a run of one class, the run's two parts are joined later; such
    a place is taken only if no other is within SAFE_REACH.
    """
    inside = None
    for at in range(max(near, 4), len(text) - 4):
        if inside is not None and at > inside + SAFE_REACH:
            break
        before, after = text[at - 1], text[at]
        b, a = _class(before), _class(after)
        if b != "s" and before != "'" and "'" not in text[at - 3 : at] and a != b and after != "'":
            return at, False
        if inside is None and b == a and len({_class(c) for c in text[at - 4 : at + 4]}) == 1 and "'" not in text[at - 4 : at + 4]:
            inside = at
    return (len(text), False) if inside is None else (inside, True)


def parts_of(text: str) -> list[tuple[str, bool]]:
    """(part, whether it goes on with the run that the part before it ended in) of a long text."""
    out, at, inside = [], 0, False
    while at < len(text):
        if len(text) - at <= PART + PART // 2:
            out.append((text[at:], inside))
            break
        end, goes_on = cut_at(text, at + PART)
        out.append((text[at:end], inside))
        at, inside = end, goes_on
    return out


def _encode_batches(vocabulary: str, id_column: str):
    def run(batches):
        enc = encoder(vocabulary)
        for batch in batches:
            lengths = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            first = 0
            while first < batch.num_rows:  # ids as Python numbers take many times a text's room
                done = lengths[first - 1] if first else 0
                n = max(1, int(np.searchsorted(lengths, done + SLICE_BYTES)) - first)
                part = batch.slice(first, n)
                ids = pa.array([enc.text(t) for t in part.column(1).to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], [id_column, "ids"])
                first += n

    return run


def _parts(batches):
    for pdf in batches:
        rows = [(u, i, k, part, inside) for u, i, t in zip(pdf["_row"], pdf["_id"], pdf["text"]) for k, (part, inside) in enumerate(parts_of(t))]
        yield pd.DataFrame(rows, columns=["_row", "_id", "part", "text", "inside"])


def _encode_parts(vocabulary: str):
    def run(batches):
        enc = encoder(vocabulary)
        for pdf in batches:
            parts = [enc.tree(t, True, True) for t in pdf.text]
            yield pd.DataFrame({
                "_row": pdf["_row"], "_id": pdf["_id"], "part": pdf.part, "inside": pdf.inside,
                "ids": [p.ids for p in parts], "first": [p.first for p in parts], "last": [p.last for p in parts],
            })

    return run


def join_parts(enc: Encoder, parts: list[tuple[list[int], bool, int, int]]) -> list[int]:
    """One encoding from (ids, inside, tokens of the first run, tokens of the last run) of consecutive parts."""
    done: list[int] = []
    open_run: list[int] = []  # tokens of the run that the next part may go on with
    for ids, inside, first, last in parts:
        if inside:
            open_run = enc.join(open_run, ids[:first])
            if first == len(ids):
                continue
            ids = ids[first:]
        done += open_run
        open_run = ids[len(ids) - last :]
        done += ids[: len(ids) - last]
    return done + open_run


def _join_texts(vocabulary: str, id_column: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        parts = [(list(i), bool(n), int(f), int(z)) for i, n, f, z in zip(pdf.ids, pdf.inside, pdf["first"], pdf["last"])]
        return pd.DataFrame({id_column: [pdf["_id"].iloc[0]], "ids": [join_parts(encoder(vocabulary), parts)]})

    return run


def encode_corpus(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY, long_text: int = LONG_TEXT) -> DataFrame:
    """(id, ids): one row per row of docs, its whole text as stored by the vocabulary, without special tokens.

    Empty and null texts give an empty list; strings of special tokens are ordinary text. Repeated rows and null ids stay.
    Texts of 2 * LEAF_CHARS characters or more are trees; those of long_text characters or more are cut into parts that any task may encode; the parts of one text, whose ids
    are one value of the result anyway, meet again in one task. Other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(id_column, F.col(text_column).alias("text"))
    is_long = F.coalesce(F.length("text") >= long_text, F.lit(False))
    short = rows.filter(~is_long).mapInArrow(_encode_batches(vocabulary, id_column), f"`{id_column}` {kind}, ids array<int>")
    long = (
        rows.filter(is_long).select(F.monotonically_increasing_id().alias("_row"), F.col(id_column).alias("_id"), "text")
        .mapInPandas(_parts, f"_row long, _id {kind}, part int, text string, inside boolean")
        .repartition("_row", "part")
        .mapInPandas(_encode_parts(vocabulary), f"_row long, _id {kind}, part int, inside boolean, ids array<int>, first int, last int")
        .groupBy("_row").applyInPandas(_join_texts(vocabulary, id_column), f"`{id_column}` {kind}, ids array<int>")
    )
    return short.unionByName(long)
