"""Evaluation passages inside training text.

Every executor builds suffix arrays over shards of the corpus: the order of all suffixes, to their full depth, by the ranks of
their first 1, 2, 4, 8, ... words. Every test suffix is searched in it by bisection; from the range of its first words come
the longest verbatim matches and their places. A match as long as a case decides on its own. Other pairs of document and
item with enough matched words are aligned, since a leaked passage may have words changed, left out or put in, and may come
in two pieces.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import slices

SEED = 4  # words of the shortest verbatim match that counts
BLOCK_WORDS = 1_000_000  # test words searched in one pass over the corpus: their index takes some 50 MB in a worker
MAX_ITEMS = 1_000_000  # held-out items are few beside a corpus; more is an error
SHARD_DOCS = 4_000  # documents of one suffix array
STOCK_ITEMS = 3  # a sentence of as many items is a stock instruction
MIN_COVER = 6  # verbatim matched words of an item from which a pair is aligned: 18 words with three changed hold as many
MIN_SPAN, MIN_MATCHED = 18, 14  # words of the item that the pieces span and that they match
MIN_PIECE = 7  # matched words of the shorter of two pieces
TWO_MATCHED, TWO_EDITS = 18, 1 / 6  # matched words of two pieces together, and their edits: two sentences of like build agree in nearly as many
MIN_RUN = 2  # words in a row that a piece must begin and end with
EDIT = 1  # cost of a changed word in matched words while aligning
MAX_EDITS = 0.21  # edits among a piece's words: about one word in six
SLACK = 8  # words around the place where a piece may lie
AT_ONCE = 32  # pairs scored at once
ONE_SCORE, TWO_SCORE = 11, 15  # least alignment score of a case in one piece and in two: matched words less the edits that MAX_EDITS and TWO_EDITS leave
CHUNK, TILE, OVERLAP = 1_000, 500, 250  # words of a document and of an item aligned at once, and what neighbours share

# Letters of other scripts that look like Latin ones, and Latin letters without a decomposition.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h",
    "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "г": "r", "п": "n", "ո": "n", "ս": "u", "օ": "o",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ε": "e", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "η": "n", "ω": "w",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ħ": "h", "ɡ": "g", "ɑ": "a", "ʟ": "l",
}



class _Letters(dict):
    """What each character stands for: nothing for accents, invisible and control signs, else itself or what it looks like."""

    def __missing__(self, code: int) -> str | None:
        c = chr(code)
        kept = c in "\n\t\r" or unicodedata.category(c) not in ("Mn", "Cf", "Me", "Cc")
        self[code] = LOOKALIKES.get(c, c) if kept else None
        return self[code]


_LETTERS = _Letters()
_TAG = re.compile(r"<[/!a-zA-Z][^<>]*>")
_BROKEN = re.compile(r"(?<=[a-z])-[ \t]*\n\s*(?=[a-z])")
_WORD = re.compile(r"[^\W_]+")
_ASCII_WORD = re.compile(r"[a-z0-9]+")
_SENTENCE = re.compile(r"(?<=[.?!])\s+")


def words_of(text: str | None) -> list[str]:
    """The words of a text apart from case, accents, punctuation, markup, line breaks, look-alike and invisible characters."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if text.isascii():
        text = text.lower()
        if "-" in text:
            text = _BROKEN.sub("", text)
        return _ASCII_WORD.findall(text)
    text = unicodedata.normalize("NFKD", text).casefold().translate(_LETTERS)
    if "-" in text:
        text = _BROKEN.sub("", text)
    return _WORD.findall(text)


def passages(items: list[tuple[int, str | None]]) -> list[tuple[int, list[str]]]:
    """(item, words of its passage): the sentences of each item that are no stock instruction."""
    sentences = [(i, [tuple(words_of(s)) for s in _SENTENCE.split(t)]) for i, t in items if t]
    shared = Counter(s for i, ss in sentences for s in set(ss))
    out: dict[int, list[str]] = {}
    for i, ss in sentences:
        out.setdefault(i, []).extend(w for s in ss if shared[s] < STOCK_ITEMS for w in s)
    return sorted((i, ws) for i, ws in out.items() if ws)


def blocks(items: list[tuple[int, list[str]]]) -> list[list[tuple[int, list[str]]]]:
    """Items in blocks of at most BLOCK_WORDS words; a longer item makes its own block in overlapping parts."""
    out, size = [[]], 0
    for i, ws in items:
        for at in range(0, max(1, len(ws)), BLOCK_WORDS // 2):
            part = ws[at : at + BLOCK_WORDS]
            if at and len(part) <= BLOCK_WORDS // 2:
                break
            if size + len(part) > BLOCK_WORDS and out[-1]:
                out.append([])
                size = 0
            out[-1].append((i, part))
            size += len(part)
    return [b for b in out if b]


class TestIndex:
    """The suffixes of one block of items, as word numbers. A 0 ends each item."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.items = items
        self.vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.words = [np.array([self.vocabulary[w] for w in ws], dtype=np.int64) for _, ws in items]
        self.flat = np.concatenate([np.append(w, 0) for w in self.words])
        self.owner = np.concatenate([np.full(len(w) + 1, k) for k, w in enumerate(self.words)])
        self.starts = np.cumsum([0] + [len(w) + 1 for w in self.words])
        self.ahead = known_ahead(self.flat)


def known_ahead(ids: np.ndarray) -> np.ndarray:
    """How many words from each place on come before an unknown word or the end (0)."""
    ends = np.flatnonzero(np.append(ids, 0) == 0)
    return ends[np.searchsorted(ends, np.arange(len(ids)))] - np.arange(len(ids))


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([x[by:], np.zeros(min(by, len(x)), dtype=x.dtype)])


class SuffixArray:
    """The suffixes of a shard in order, each up to its first unknown word, with the ranks of their first 1, 2, 4, ... words.

    `levels` holds, per power of two h, the rank of each place's first h words in the shard and the rank of the same words
    at each place of the test items, -1 where the shard lacks them. Doubling ends where no test item goes on.
    """

    def __init__(self, ids: np.ndarray, index: TestIndex):
        self.ids, self.ahead = ids, known_ahead(ids)
        mine, theirs, h = ids, index.flat, 1
        self.levels = [(1, mine, theirs)]
        while True:
            base = int(mine.max(initial=0)) + 1
            key = mine * base + np.where(self.ahead >= h, _shifted(mine, h), 0)
            kinds, mine = np.unique(key, return_inverse=True)
            whole = (index.ahead >= 2 * h) & (theirs >= 0) & (_shifted(theirs, h) >= 0)
            wanted = np.where(whole, theirs * base + _shifted(theirs, h), -1)
            at = np.minimum(np.searchsorted(kinds, wanted), len(kinds) - 1)
            theirs = np.where(whole & (kinds[at] == wanted), at, -1)
            h *= 2
            self.levels.append((h, mine, theirs))
            if h >= SEED and not (theirs >= 0).any():
                break
        places = np.flatnonzero(self.ahead >= SEED)
        self.order = places[np.argsort(mine[places], kind="stable")]


def verbatim(index: TestIndex, ids: np.ndarray, doc_of: np.ndarray):
    """(doc, item, corpus place, test place, length) of the longest verbatim matches between a shard and the block."""
    array = SuffixArray(ids, index)
    _, mine, theirs = next(x for x in array.levels if x[0] == SEED)
    at = np.flatnonzero(theirs >= 0)
    ordered = mine[array.order]
    lo, hi = np.searchsorted(ordered, theirs[at], "left"), np.searchsorted(ordered, theirs[at], "right")
    n = hi - lo
    t = np.repeat(at, n)
    c = array.order[np.repeat(lo, n) + np.arange(len(t)) - np.repeat(np.cumsum(n) - n, n)]
    # A match that the word before both could join is part of a longer one.
    first = (c == 0) | (t == 0) | (ids[c - 1] == 0) | (ids[c - 1] != index.flat[t - 1])
    c, t = c[first], t[first]
    length = np.zeros(len(c), dtype=np.int64)
    for h, mine, theirs in reversed(array.levels):
        i, j = np.minimum(c + length, len(ids) - 1), np.minimum(t + length, len(index.flat) - 1)
        length += np.where((mine[i] == theirs[j]) & (array.ahead[i] >= h) & (index.ahead[j] >= h), h, 0)
    doc, item = doc_of[c], index.owner[t]
    by = np.lexsort((c, item, doc))
    return doc[by], item[by], c[by], t[by], length[by]


def align(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """The best local alignment of words a (document) and b (item), as runs of equal words: (place in a, place in b, words).

    A changed word costs EDIT only, so the alignment reaches over neighbouring changes; `piece_of` cuts it to what is dense enough.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return []
    step = np.where(b[:, None] == a[None, :], np.float32(1), np.float32(-EDIT))
    h = np.zeros((m + 1, n + 1), dtype=np.float32)
    ramp = np.float32(EDIT) * np.arange(n + 1, dtype=np.float32)
    for j in range(m):
        row = h[j + 1]
        np.maximum(h[j, :-1] + step[j], h[j, 1:] - np.float32(EDIT), out=row[1:])
        np.maximum(row, 0, out=row)
        np.add(row, ramp, out=row)
        np.maximum.accumulate(row, out=row)
        row -= ramp
    j, i = (int(x) for x in np.unravel_index(np.argmax(h), h.shape))
    runs: list[tuple[int, int, int]] = []
    while i and j and h[j, i] > 1e-6:
        here, s = h[j, i], step[j - 1, i - 1]
        if abs(here - (h[j - 1, i - 1] + s)) < 1e-6:
            i, j = i - 1, j - 1
            if s > 0:
                joined = runs and (runs[-1][0], runs[-1][1]) == (i + 1, j + 1)
                runs.append((i, j, runs.pop()[2] + 1 if joined else 1))
        elif abs(here - (h[j, i - 1] - EDIT)) < 1e-6:
            i -= 1
        else:
            j -= 1
    return runs[::-1]


def best_scores(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Per pair (document part, item): the score of the best local alignment, and of the best two in order. Many pairs go at once."""
    one, two = np.zeros(len(pairs), dtype=np.int16), np.zeros(len(pairs), dtype=np.int16)
    by = np.argsort([len(a) for a, _ in pairs], kind="stable")
    for at in range(0, len(by), AT_ONCE):
        some = by[at : at + AT_ONCE]
        k, n, m = len(some), max(len(pairs[x][0]) for x in some), max(len(pairs[x][1]) for x in some)
        a, b = np.full((k, n), -1, dtype=np.int32), np.full((k, m), -2, dtype=np.int32)
        for x, p in enumerate(some):
            a[x, : len(pairs[p][0])], b[x, : len(pairs[p][1])] = pairs[p]
        ramp = np.int16(EDIT) * np.arange(n + 1, dtype=np.int16)
        # Layers of one row: alignments, those that follow an earlier one, and the best of the first layer up to each place.
        first, second, ahead = (np.zeros((k, n + 1), dtype=np.int16) for _ in range(3))
        row = np.zeros((k, n + 1), dtype=np.int16)
        for j in range(m):
            step = np.where(b[:, j : j + 1] == a, np.int16(1), np.int16(-EDIT))
            before = ahead
            for layer, start in ((second, before), (first, None)):
                row[:, 0] = 0
                diagonal = layer[:, :-1] if start is None else np.maximum(layer[:, :-1], start[:, :-1])
                np.maximum(diagonal + step, layer[:, 1:] - np.int16(EDIT), out=row[:, 1:])
                np.maximum(row, 0, out=row)
                row += ramp
                np.maximum.accumulate(row, axis=1, out=row)
                np.subtract(row, ramp, out=layer)
            one[some] = np.maximum(one[some], first.max(1))
            two[some] = np.maximum(two[some], second.max(1))
            ahead = np.maximum(before, np.maximum.accumulate(first, axis=1))
    return one, np.maximum(one, two)


def piece_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int, int, int, int]:
    """The stretch of an alignment with most matched words whose edits stay within MAX_EDITS: matched, edits, and its bounds in a and b.

    It begins and ends with MIN_RUN words in a row or more; an edit is a word changed, left out or put in.
    """
    best = (0, 0, 0, 0, 0, 0)
    for p, (i0, j0, k) in enumerate(runs):
        if k < MIN_RUN:
            continue
        matched = edits = 0
        for q in range(p, len(runs)):
            i, j, k = runs[q]
            if q > p:
                before = runs[q - 1]
                edits += max(i - before[0] - before[2], j - before[1] - before[2])
            matched += k
            if k >= MIN_RUN and matched > best[0] and edits <= MAX_EDITS * (matched + edits):
                best = (matched, edits, i0, i + k, j0, j + k)
    return best


def stretches(a: np.ndarray, places: np.ndarray, before: np.ndarray, m: int) -> list[tuple[int, np.ndarray]]:
    """(first place, words) of the parts of a document where an item of m words may lie that is matched at `places` after `before` of its words, in overlapping chunks."""
    lows = np.maximum(0, places - (1 + 2 * MAX_EDITS) * before - SLACK).astype(np.int64)
    highs = np.minimum(len(a), places + (1 + 2 * MAX_EDITS) * (m - before) + SLACK).astype(np.int64)
    out: list[list[int]] = []
    for k in np.argsort(lows, kind="stable"):
        if out and lows[k] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], int(highs[k]))
        else:
            out.append([int(lows[k]), int(highs[k])])
    return [(at, a[at : min(at + CHUNK, hi)]) for lo, hi in out for at in range(lo, max(lo + 1, hi - OVERLAP), CHUNK - OVERLAP)]


def pieces_of(a: np.ndarray, b: np.ndarray, places: np.ndarray, test_places: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """The dense pieces of every chunk of the document against every tile of the item that holds a match, with what lies before and after each piece.

    Chunks and tiles overlap by OVERLAP words, so a passage of that length lies whole in one of each, and a longer one holds such a part that is as dense.
    """
    out = []
    for jt in range(0, max(1, len(b) - OVERLAP), TILE - OVERLAP):
        tile = b[jt : jt + TILE]
        inside = (test_places >= jt) & (test_places < jt + TILE)
        if not inside.any():
            continue
        for at, part in stretches(a, places[inside], test_places[inside] - jt, len(tile)):
            found = piece_of(align(part, tile))
            if found[0] < MIN_RUN:
                continue
            m, e, i0, i1, j0, j1 = found
            out.append((m, e, i0 + at, i1 + at, j0 + jt, j1 + jt))
            if m >= MIN_PIECE and j1 - j0 < MIN_SPAN:
                for i, x, j, y in ((i1, part[i1:], j1, tile[j1:]), (0, part[:i0], 0, tile[:j0])):
                    m, e, i0_, i1_, j0_, j1_ = piece_of(align(x, y))
                    if m >= MIN_PIECE:
                        out.append((m, e, i0_ + i + at, i1_ + i + at, j0_ + j + jt, j1_ + j + jt))
    return out


def judge(a: np.ndarray, b: np.ndarray, places: np.ndarray | None = None, test_places: np.ndarray | None = None) -> tuple[int, int, int, int] | None:
    """(span, matched, edits, pieces) of an item's passage b in a document a, or None where too little of it is there.

    places and test_places are where verbatim matches begin; without them the whole document and item are aligned.
    """
    if places is None or test_places is None:
        places, test_places = np.arange(0, max(1, len(a)), max(1, len(b))), np.arange(0, max(1, len(b)), TILE // 4)
        places, test_places = np.repeat(places, len(test_places)), np.tile(test_places, len(places))
    found = sorted(set(pieces_of(a, b, places, test_places)), reverse=True)
    for matched, edits, _, _, j0, j1 in found:
        if j1 - j0 >= MIN_SPAN and matched >= MIN_MATCHED:
            return j1 - j0, matched, edits, 1
    long = [r for r in found if r[0] >= MIN_PIECE]
    best = None
    for p, r in enumerate(long):
        for o in long[p + 1 :]:
            lo, hi = (r, o) if r[4] < o[4] else (o, r)
            if hi[4] >= lo[5] and hi[2] >= lo[3]:
                matched, edits, span = r[0] + o[0], r[1] + o[1], r[5] - r[4] + o[5] - o[4]
                if span >= MIN_SPAN and matched >= TWO_MATCHED and edits <= TWO_EDITS * (matched + edits):
                    best = max(best or (0,), (matched, span, edits))
    return (best[1], best[0], best[2], 2) if best else None


def _promising(pairs: list[tuple], texts: list[np.ndarray], items: list[np.ndarray]) -> list[tuple]:
    """The pairs (document, item, longest, places, test places) that may be a case by their best alignment's score; those with several parts to align stay."""
    several, single, parts = [], [], []
    for p in pairs:
        a, b = texts[p[0]], items[p[1]]
        near = stretches(a, p[3], p[4], len(b)) if len(b) <= TILE else []
        if len(near) == 1:
            single.append(p)
            parts.append((near[0][1], b))
        else:
            several.append(p)
    one, two = best_scores(parts)
    return several + [p for p, a, b in zip(single, one, two) if a >= ONE_SCORE or b >= TWO_SCORE]


def _search(index: TestIndex, id_column: str, min_cover: int = MIN_COVER, verdict=judge):
    def run(batches):
        vocabulary = index.vocabulary
        for pdf in batches:
            for shard in slices(pdf, rows=SHARD_DOCS):
                texts = [np.fromiter((vocabulary.get(w, 0) for w in words_of(t)), dtype=np.int64) for t in shard["text"]]
                ids = np.concatenate([np.append(t, 0) for t in texts])
                doc_of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
                starts = np.cumsum([0] + [len(t) + 1 for t in texts])
                doc, item, c, t, length = verbatim(index, ids, doc_of)
                out, keys, unsure = [], shard[id_column].tolist(), []
                if len(doc):
                    pair = doc * len(index.items) + item
                    heads = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
                    ends = np.append(heads[1:], len(pair))
                    for s, e in zip(heads, ends):
                        longest, k, n = int(length[s:e].max()), int(item[s]), int(doc[s])
                        if longest >= MIN_SPAN:  # the verbatim match is a case by itself
                            out.append((keys[n], index.items[k][0], longest, longest, longest, 0, 1))
                        elif length[s:e].sum() >= min_cover:
                            unsure.append((n, k, longest, c[s:e] - starts[n], t[s:e] - index.starts[k]))
                for n, k, longest, places, test_places in _promising(unsure, texts, index.words):
                    found = verdict(texts[n], index.words[k], places, test_places)
                    if found:
                        out.append((keys[n], index.items[k][0], longest, *found))
                yield pd.DataFrame(out, columns=[id_column, "item_id", "longest", "span", "matched", "edits", "pieces"])

    return run


def leaked_passages(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """Documents that hold a passage of a held-out item: id, item_id, longest, span, matched, edits, pieces.

    longest is the longest verbatim match in words; span and matched count the item's words the pieces cover and match. Where the
    longest verbatim match has MIN_SPAN words or more it decides alone, and span and matched are its length.
    Null and empty texts hold nothing. Repeated documents each give their rows, repeated rows of an item count once, items
    with nothing but stock sentences match nothing, and either table may be empty. The items, at most MAX_ITEMS, go in
    blocks of BLOCK_WORDS words, each searched over the whole corpus without any shuffle. Texts and items of any length are
    searched whole; what is aligned at once is bounded by CHUNK and TILE.
    """
    from tallyforge.session import bounded_rows

    rows = bounded_rows(items.select(item_column, item_text).filter(F.col(item_column).isNotNull()).distinct(), MAX_ITEMS, "held-out items")
    kinds = {f: docs.schema[f].dataType.simpleString() for f in (id_column,)}
    schema = f"`{id_column}` {kinds[id_column]}, item_id {items.schema[item_column].dataType.simpleString()}, longest int, span int, matched int, edits int, pieces int"
    text = docs.select(id_column, F.col(text_column).alias("text")).filter(F.length("text") > 0)
    out = None
    for block in blocks(passages([tuple(r) for r in rows])):
        part = text.mapInPandas(_search(TestIndex(block), id_column), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def without_leaks(docs: DataFrame, leaks: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The documents no passage leaked into."""
    return docs.join(leaks.select(id_column).distinct(), id_column, "left_anti")
