import random

import numpy as np

from tallyforge.llm import subjects as S

VOCAB = {s: [f"{s}{chr(97 + i)}{x}" for i in range(8) for x in ("ar", "en")] for s in ("law", "sport", "music")}
PLAIN = "door table crowd story week room list page crew floor".split()


def sentence(rng, subject=None):
    words = rng.choices(PLAIN, k=3) + (rng.choices(VOCAB[subject], k=3) if subject else rng.choices(PLAIN, k=3))
    rng.shuffle(words)
    return "The " + " ".join(words) + " of the " + rng.choice(PLAIN) + "."


def corpus(n, seed):
    rng = random.Random(seed)
    docs, truth = [], {}
    for i in range(n):
        subjects = rng.sample(sorted(VOCAB), rng.randint(0, 2))
        passing = rng.choice(sorted(VOCAB))
        parts = [sentence(rng, s) for s in subjects for _ in range(rng.randint(3, 6))] + [sentence(rng) for _ in range(4)] + ([sentence(rng, passing)] if passing not in subjects else [])
        rng.shuffle(parts)
        docs.append((i, " ".join(parts)))
        truth[i] = set(subjects)
    return docs, truth


def tables(spark, docs, labels):
    d = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], "doc_id long, text string, subject string, _id string")
    lab = spark.createDataFrame(labels, "doc_id long, subject string, text string")
    return d, lab, spark.createDataFrame([(s, "about") for s in VOCAB], "subject string, description string")


def test_held_out_subjects(spark):
    docs, truth = corpus(600, 1)
    rng = random.Random(2)
    labels = []
    for i in range(200):
        for s in truth[i]:
            if rng.random() > 0.1:
                labels += [(i, s, "t")] * rng.randint(1, 2)
        if rng.random() < 0.1:
            labels.append((i, rng.choice(sorted(VOCAB)), "t"))
    docs += [(1000, None), (1001, ""), (1002, "  \n "), (1003, docs[0][1]), (1004, docs[0][1])]
    d, lab, areas = tables(spark, docs, labels + [(None, "law", "t"), (5, None, "t")])
    got: dict[int, set] = {}
    for r in S.subjects_of(d, lab, areas).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
        assert r.n_sentences >= S.MIN_SENTENCES and 0.5 <= r.posterior <= 1
    pairs = [(s in got.get(i, set()), s in truth[i]) for i in range(200, 600) for s in VOCAB]
    hit = sum(a and b for a, b in pairs)
    assert hit / sum(a for a, _ in pairs) > 0.97 and hit / sum(b for _, b in pairs) > 0.97
    assert not {1000, 1001, 1002} & set(got) and got.get(1003, set()) == got.get(1004, set()) == got.get(0, set())


def test_empty_tables_and_bound(spark):
    docs, truth = corpus(30, 3)
    labels = [(i, s, "t") for i in range(30) for s in truth[i]]
    d, lab, areas = tables(spark, docs, labels)
    for x in (S.subjects_of(d.limit(0), lab, areas), S.subjects_of(d, lab.limit(0), areas), S.subjects_of(d, lab, areas.limit(0))):
        assert x.count() == 0
    assert S.subjects_of(d, lab, areas, max_labelled=12).columns == ["doc_id", "subject", "n_sentences", "posterior"]


def test_composition(spark):
    d = spark.createDataFrame([(1, "abcd"), (2, None), (3, "xy")], "doc_id long, text string")
    f = spark.createDataFrame([(1, "law"), (1, "law"), (1, "sport")], "doc_id long, subject string")
    assert sorted(tuple(r) for r in S.composition(f, d).collect()) == [("law", 1, 4), ("none", 2, 2), ("sport", 1, 4)]


def test_third_best():
    post = np.array([[0.9], [0.8], [0.7], [0.6], [0.9]])
    x = S.third_best(post, np.array([0, 0, 0, 0, 2]), 3)
    assert abs(x[0, 0] - np.log(0.7 / 0.3)) < 1e-9 and x[1, 0] == x[2, 0] == -S.LIMIT


def test_languages_are_learned_from_uneven_codes():
    """Codes of one language meet by their words, whatever they are called; wrong and missing codes do no harm."""
    rng = random.Random(5)
    tongues = {"en": "the of and a that was because by with".split(), "de": "der die das und eine ohne nach am".split(), "fi": "ja on ei se mutta kun niin".split()}
    codes = {"en": ["en", "EN", "en-US", "und", None], "de": ["de", "de-AT", "German", None], "fi": ["fi", "FI", "suomi"]}
    docs, truth = [], []
    for _ in range(300):
        t = rng.choice(sorted(tongues))
        parts = [[rng.choice(tongues[t]) for _ in range(6)] + [rng.choice(PLAIN)] for _ in range(4)]
        docs.append((parts, rng.choice(codes[t]) if rng.random() > 0.03 else "es"))
        truth.append(t)
    learned = S.learn_languages(docs)
    got = [learned.of(p) for p, _ in docs]
    pairs = set(zip(truth, got))
    assert len(learned.log_share) == 3 and len(pairs) == 3 and len({g for _, g in pairs}) == 3
    assert S.learn_languages([]).of([["x"]]) == 0 and S.learn_languages([(p, None) for p, _ in docs]).of(docs[0][0]) == 0


def test_sample_is_bounded_by_characters(spark):
    docs, truth = corpus(200, 6)
    labels = [(i, s, "t") for i in range(200) for s in truth[i]]
    d, lab, areas = tables(spark, docs, labels)
    whole = sum(len(t) for i, t in docs if truth[i])
    seen = []
    train = S.train
    try:
        S.train = lambda sample, subjects: seen.append(sum(len(t) for t, *_ in sample)) or train(sample, subjects)
        S.fit(d, lab, areas, max_chars=whole // 2)
        S.fit(d, lab, areas)
    finally:
        S.train = train
    assert 0 < seen[0] <= 0.7 * whole and seen[1] == whole


def test_weights_are_complement_weights():
    """A word of one subject speaks for it and against the others; a sentence mixing two is about neither."""
    counts = np.array([[30.0, 0, 0], [0, 30, 0], [30, 30, 60]])
    m = S._model(["a", "b"], S.Languages(), {(0, w): i for i, w in enumerate("xyz")}, counts, np.array([15.0, 15, 30]))
    assert m.weight[0, 0] > 1 > -1 > m.weight[0, 1] and abs(m.weight[2, 0]) < 0.7
    post = m.posterior(np.array([0, 2, -1, 0, 1, -1, 2, -1]))
    assert post[0, 0] > 0.7 and post[1].max() <= 0.5 and post[2].max() < 0.5 and (post.sum(1) <= 1 + 1e-9).all()
