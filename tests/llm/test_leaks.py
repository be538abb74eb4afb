import random

import numpy as np

from tallyforge.llm import leaks as L

WORDS = [a + b for a in ("bar", "cle", "dor", "fen", "gul", "hap", "jit", "kom", "lud", "mor") for b in ("ant", "ber", "cit", "dal", "en", "fos", "gram", "hil")]
STOCK = "Read this and choose the best answer."


def passage(rng, n=60):
    words = [rng.choice(WORDS) for _ in range(n)]
    return ". ".join(" ".join(words[i : i + 12]).capitalize() for i in range(0, n, 12)) + "."


def found(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string, longest int")
    i = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    return sorted({(r.doc_id, r.item_id) for r in L.leaked_passages(d, i).collect()})


def test_passages_changed_cut_and_marked_up(spark):
    rng = random.Random(2)
    items = [(k, passage(rng) + " " + STOCK, "z") for k in range(6)]
    noise = lambda n: passage(rng, n)
    text = dict((i, t[: -len(STOCK) - 1]) for i, t, _ in items)
    w = {i: L.words_of(t) for i, t in text.items()}
    edited = [x if k % 7 else rng.choice(WORDS) for k, x in enumerate(w[1][:40])]
    two = " ".join(w[2][:12]) + ". " + noise(48) + " " + " ".join(w[2][12:26])
    shuffled = list(w[3])
    rng.shuffle(shuffled)
    look = text[4].replace("a", "а").replace("o", "о​").replace("e", "é").replace(" ", " <b></b>\n", 5)
    docs = [
        (1, noise(60) + " " + text[0].upper() + " " + noise(36), "q", 1), (2, " ".join(edited), "q", 1), (3, two, "q", 1), (4, " ".join(shuffled), "q", 1),
        (5, look, "q", 1), (6, noise(60) + STOCK, "q", 1), (7, noise(36) + " ".join(w[5][:9]) + " " + noise(36), "q", 1), (8, None, None, None), (9, "", None, None),
        (10, " \n ", None, None), (1, noise(60) + " " + text[0], "q", 1), (11, noise(30_000) + " " + text[5] + " " + noise(30_000), None, None),
    ]
    assert found(spark, docs, items + items[:1] + [(None, text[0], "z"), (99, None, None), (98, STOCK, None)]) == [(1, 0), (2, 1), (3, 2), (5, 4), (11, 5)]


def test_empty_tables(spark):
    rng = random.Random(1)
    assert found(spark, [], [(1, passage(rng), "x")]) == [] and found(spark, [(1, passage(rng), "x", 1)], []) == []


def test_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(4)
    items = [(k, passage(rng), "z") for k in range(9)]
    docs = [(k, passage(rng) + " " + items[k][1], "q", 1) for k in range(9)]
    want = found(spark, docs, items)
    monkeypatch.setattr(L, "BLOCK_WORDS", 150)
    assert len(L.blocks(L.passages([r[:2] for r in items]))) > 3 and found(spark, docs, items) == want == [(k, k) for k in range(9)]


def test_verbatim_matches_equal_brute_force():
    rng = random.Random(7)
    item = [rng.choice(WORDS[:6]) for _ in range(40)]
    doc = [rng.choice(WORDS[:7]) for _ in range(200)] + item[5:20]
    index = L.TestIndex([(1, item)])
    ids = np.array([index.vocabulary.get(w, 0) for w in doc] + [0], dtype=np.int64)
    _, _, c, t, n = L.verbatim(index, ids, np.zeros(len(ids), dtype=np.int64))
    got = {(int(a), int(b), int(k)) for a, b, k in zip(c, t, n)}
    want = set()
    for a in range(len(doc)):
        for b in range(len(item)):
            if a and b and doc[a - 1] == item[b - 1]:
                continue
            k = 0
            while a + k < len(doc) and b + k < len(item) and doc[a + k] == item[b + k]:
                k += 1
            if k >= L.SEED:
                want.add((a, b, k))
    assert got == want


def test_recall_by_pattern_of_edits():
    """Passages with one word in six changed, left out or put in, at any places, neighbouring ones included."""
    rng = random.Random(5)
    item = np.arange(1, 61)
    for n, changed in ((21, (6, 7, 14)), (21, (5, 6, 14)), (21, (6, 7, 15)), (24, (6, 7, 19, 20)), (18, (3, 9, 15)), (18, (4, 8, 12))):
        a = item[:n].copy()
        a[np.array(changed) - 1] = 0
        assert L.judge(np.concatenate([np.zeros(30, int), a, np.zeros(30, int)]), item), (n, changed)
    held = total = 0
    for n in (21, 24, 30, 40):
        for kind in ("changed", "left out", "put in"):
            for _ in range(60):
                start = rng.randrange(60 - n)
                words = list(item[start : start + n])
                for at in sorted(rng.sample(range(1, n - 1), n // 7), reverse=True):
                    if kind == "changed":
                        words[at] = 0
                    elif kind == "left out":
                        del words[at]
                    else:
                        words.insert(at, 0)
                total += 1
                held += L.judge(np.array([0] * 40 + words + [0] * 40), item) is not None
    assert held / total > 0.97
    assert all(L.judge(np.array([0] * 40 + list(item[k : k + 13]) + [0] * 40), item) is None for k in range(40))


def test_match_of_many_words_and_long_items():
    """Ranks double to the full depth; an item of 30,000 words needs no table of its square."""
    import tracemalloc

    rng = random.Random(6)
    item = rng.choices(range(1, 5_000), k=30_000)
    index = L.TestIndex([(1, [str(w) for w in item])])
    word = {str(w): index.vocabulary[str(w)] for w in set(item)}
    ids = np.array([0] * 5 + [word[str(w)] for w in item[100:9_100]] + [0] * 5)
    doc, _, c, t, n = L.verbatim(index, ids, np.zeros(len(ids), dtype=np.int64))
    assert (5, 100, 9_000) in set(zip(c.tolist(), t.tolist(), n.tolist()))
    part = index.words[0][7_000:7_030].copy()
    part[[5, 6, 14, 22]] = 0
    doc = np.concatenate([np.zeros(2_000, dtype=np.int64), part, np.zeros(2_000, dtype=np.int64)])
    tracemalloc.start()
    assert L.judge(doc, index.words[0], np.array([2_007]), np.array([7_007]))[:3] == (30, 26, 4)
    assert tracemalloc.get_traced_memory()[1] < 50e6
    tracemalloc.stop()


def test_scores_of_many_pairs():
    rng = random.Random(8)
    pairs = [(np.array(rng.choices(range(5), k=rng.randint(1, 16))), np.array(rng.choices(range(5), k=rng.randint(1, 12)))) for _ in range(40)]

    def score(a, b):
        runs = L.align(a, b)
        return sum(r[2] for r in runs) - sum(max(y[0] - x[0] - x[2], y[1] - x[1] - x[2]) for x, y in zip(runs, runs[1:]))

    one, two = L.best_scores(pairs)
    assert one.tolist() == [score(a, b) for a, b in pairs]
    assert two.tolist() == [max(score(a[:i], b[:j]) + score(a[i:], b[j:]) for i in range(len(a) + 1) for j in range(len(b) + 1)) for a, b in pairs]


def test_passage_across_chunks_and_tiles(monkeypatch):
    rng = random.Random(9)
    a, b = np.array(rng.choices(range(1, 50), k=3000)), np.array(rng.choices(range(60, 4000), k=600))
    for at in (490, 740, 990):
        x, part = a.copy(), b[at // 3 : at // 3 + 40].copy()
        part[[5, 13, 20, 28]] = 1
        x[at : at + 40] = part
        assert L.judge(x, b)[:3] == (40, 36, 4)


def test_documents_kept(spark):
    docs = spark.createDataFrame([(1,), (2,), (2,)], "doc_id long")
    assert [r.doc_id for r in L.without_leaks(docs, spark.createDataFrame([(2, 5)], "doc_id long, item_id long")).collect()] == [1]


def test_slices_keep_every_row(monkeypatch):
    import pandas as pd

    from tallyforge.llm import batches as B

    monkeypatch.setattr(B, "SLICE_CHARS", 10)
    pdf = pd.DataFrame({"text": ["a" * 30, None, "", "bb", "c" * 9, "d", None, "e" * 11], "k": range(8)})
    parts = list(B.slices(pdf, rows=3))
    assert [k for p in parts for k in p.k] == list(range(8)) and max(map(len, parts)) <= 3 and list(B.slices(pdf[:0])) == []
