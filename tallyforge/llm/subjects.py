"""Subject areas of documents.

A complement naive Bayes model says for each subject how much likelier a word is in it than in everything else. It is
trained on labelled documents and refined by expectation-maximization over the sentences of all documents: a sentence's
summed complement weights give the posterior of each subject on its own, the posteriors give the expected word counts
of every subject and of the rest, and these give new complement weights. A document's labels only start and steer its own
sentences. Words of a sentence that belong to other subjects speak against each, so that a sentence mixing subjects is
about none. The log odds of each subject are calibrated on their own against the labels, so that a document may have any
number of subjects. A document is about a subject if at least MIN_SENTENCES of its sentences are.

Texts are read into word numbers once and written to the shared folder; the passes after that are array operations.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.batches import slices
from tallyforge.session import bounded_rows, cut

MAX_LABELLED = 15_000  # labelled documents the model starts from, chosen by a hash of their id
MAX_LABELLED_CHARS = 200_000_000  # and their characters
MAX_WORDS = 20_000  # words of the model, by the number of labelled documents that hold them
MAX_SUBJECTS = 256
CHANCE = 3.0  # standard deviations above chance from which a word counts for a subject at first
LIMIT = 8.0  # log odds beyond this are alike
MIN_SENTENCES = 3
ROUNDS = 1  # passes of expectation-maximization over all documents
SMOOTHING = 0.5
SHRINK = 20.0  # words a class needs before its own counts outweigh the overall ones
MIN_CODE = 0.01  # share of the labelled documents from which a language code counts
SAME_LANGUAGE = 0.6  # cosine of the commonest words' shares from which two codes are one language
COMMON_WORDS = 300  # words by which languages are told

_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’)*_]*\s+|\n+")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence, in lower case. Rows of tables, log lines and code are pieces like others; they hold no subject's words."""
    if not text:
        return []
    out = []
    for s in _SENTENCE.split(text):
        words = _WORD.findall(s.lower())
        if words:
            out.append(words)
    return out


def _code(lang: str | None) -> str:
    """The first two letters of a language code, however it is written; '' for none."""
    return "".join(c for c in (lang or "").lower() if c.isalpha())[:2]


@dataclass
class Languages:
    """What the commonest words tell about a text's language: a row of log shares per language. Without codes there is one language."""

    words: dict[str, int] = field(default_factory=dict)
    log_share: np.ndarray = field(default_factory=lambda: np.zeros((1, 0)))

    def of(self, parts: list[list[str]]) -> int:
        """The language that a text's words are likeliest in; the first one on a tie."""
        known = self.words
        at = [known[w] for s in parts for w in s if w in known]
        return int(np.argmax(np.bincount(at, minlength=len(known)) @ self.log_share.T)) if at and len(self.log_share) > 1 else 0


def learn_languages(docs: list[tuple[list[list[str]], str | None]]) -> Languages:
    """Languages from (sentences, code) of documents whose codes are null, wrong or unevenly written in part.

    Codes that hold at least MIN_CODE of the documents are compared by the shares of the commonest words; those whose
    words agree are one language.
    """
    counts: dict[str, Counter] = defaultdict(Counter)
    n = Counter(_code(lang) for _, lang in docs if _code(lang))
    codes = [c for c, k in sorted(n.items(), key=lambda x: (-x[1], x[0])) if k >= max(2, MIN_CODE * sum(n.values()))]
    for parts, lang in docs:
        if _code(lang) in codes:
            counts[_code(lang)].update(w for s in parts for w in s)
    common = {w for c in codes for w, _ in sorted(counts[c].items(), key=lambda x: (-x[1], x[0]))[:COMMON_WORDS]}
    words = {w: i for i, w in enumerate(sorted(common))}
    if not words:
        return Languages()
    rows: list[np.ndarray] = []
    for c in codes:
        row = np.array([counts[c][w] for w in words], dtype=float)
        for k, old in enumerate(rows):
            if row @ old >= SAME_LANGUAGE * np.linalg.norm(row) * np.linalg.norm(old):
                rows[k] = old + row
                break
        else:
            rows.append(row)
    shares = np.stack(rows) + 1.0
    return Languages(words, np.log(shares / shares.sum(1, keepdims=True)))


@dataclass
class Model:
    """The complement weight of each word for each subject: the log of its share in the subject against its share in all else. Words of languages are kept apart."""

    subjects: list[str]
    languages: Languages
    words: dict[tuple[int, str], int]
    weight: np.ndarray  # words x subjects
    bias: np.ndarray  # log odds of a sentence's being about each subject
    slope: np.ndarray
    shift: np.ndarray

    def encode(self, text: str | None) -> list[int]:
        """The model's words of each sentence, once each, and a -1 after each sentence that holds any."""
        parts, known, out = sentences(text), self.words, []
        tongue = self.languages.of(parts)
        for words in parts:
            hits = sorted({known[tongue, x] for x in words if (tongue, x) in known})
            if hits:
                out += hits
                out.append(-1)
        return out

    def posterior(self, ids: np.ndarray) -> np.ndarray:
        """The posterior of each subject in each sentence of encoded texts: each on its own, then at most 1 together, since a sentence is about one at most."""
        ends = np.flatnonzero(ids < 0)
        if not len(ends):
            return np.zeros((0, len(self.subjects)))
        padded = np.vstack([self.weight, np.zeros((1, len(self.subjects)))])
        odds = np.add.reduceat(padded[ids], np.append(0, ends[:-1] + 1), axis=0) + self.bias
        post = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        return post / np.maximum(post.sum(1, keepdims=True), 1)


def _shares(post: np.ndarray) -> np.ndarray:
    """The subjects' shares of each sentence and, in the last column, what is left for the rest."""
    return np.hstack([post, np.maximum(0, 1 - post.sum(1, keepdims=True))])


def _model(subjects: list[str], languages: Languages, words: dict, counts: np.ndarray, held: np.ndarray) -> Model:
    """A model from expected word counts and sentences per subject and, in the last column, of the rest."""
    tongue = np.array([t for t, _ in words], dtype=np.int64).reshape(-1)
    k = len(subjects)
    weight = np.zeros((len(words), k))
    for t in range(len(languages.log_share)):
        at = tongue == t
        if at.any():
            own = counts[at]
            every = own.sum(1, keepdims=True)
            overall = every / max(every.sum(), 1e-9)
            log_share = lambda c: np.log((c + SHRINK * overall + 1e-6) / (c.sum(0) + SHRINK + 1e-6 * at.sum()))
            weight[at] = log_share(own[:, :k]) - log_share(every - own[:, :k])
    share = (held[:k] + 1) / (held.sum() + 2)
    return Model(subjects, languages, words, weight, np.log(share / (1 - share)), np.ones(k), np.zeros(k))


def train(docs: list[tuple[str, set[str], str | None]], subjects: list[str]) -> Model:
    """Complement naive Bayes from (text, subjects, language code) of labelled documents.

    A word's first weight for a subject is the log of its count in documents of the subject against the count its language's
    documents would give it, less the same for the complement; weights within chance are zero. The summed weights of a
    sentence's words share the sentence among the subjects and the rest, and these shares give the word counts.
    """
    read = [(sentences(t), labels, lang) for t, labels, lang in docs]
    languages = learn_languages([(p, lang) for p, _, lang in read])
    parsed = [(p, languages.of(p), labels) for p, labels, _ in read]
    held = Counter((t, w) for p, t, _ in parsed for w in {w for s in p for w in s})
    kept = [w for w, _ in sorted(held.items(), key=lambda x: (-x[1], x[0]))][:MAX_WORDS]
    words = {w: i for i, w in enumerate(kept)}
    v, k = len(words), len(subjects)
    on, total, in_docs = np.zeros((v, k)), np.zeros(v), np.zeros((len(languages.log_share), k))
    n_docs = np.zeros(len(languages.log_share))
    for parts, t, labels in parsed:
        at = np.array(sorted({words[t, w] for s in parts for w in s if (t, w) in words}), dtype=np.int64)
        marks = np.array([x in labels for x in subjects], dtype=float)
        total[at] += 1
        on[at] += marks
        in_docs[t] += marks
        n_docs[t] += 1
    tongue = np.array([t for t, _ in kept], dtype=np.int64).reshape(-1)
    share = (in_docs[tongue] + 0.5) / (n_docs[tongue, None] + 1) if v else np.zeros((0, k))
    expected = total[:, None] * share
    weight = np.log((on + SMOOTHING) / (expected + SMOOTHING)) - np.log((total[:, None] - on + SMOOTHING) / (total[:, None] - expected + SMOOTHING))
    spread = np.sqrt(expected * (1 - share)) + 1e-9
    weight[(on - expected) / spread < CHANCE] = 0
    counts, sentences_on = np.zeros((v, k + 1)), np.zeros(k + 1)
    for parts, t, labels in parsed:
        marks = np.array([x in labels for x in subjects])
        for s in parts:
            at = np.array(sorted({words[t, w] for w in s if (t, w) in words}), dtype=np.int64)
            if len(at):
                votes = weight[at].sum(0)
                second = np.sort(votes)[-2] if k > 1 else 0.0
                score = np.append(np.where(marks, votes, votes * 0.5 - 1), [1.5, 2 * second - 1])
                post = np.exp(score - score.max())
                post = np.append(post[:k], post[k:].sum()) / post.sum()
                counts[at] += post
                sentences_on += post
    return _model(subjects, languages, words, counts, sentences_on)


def _encode_batches(model: Model):
    def run(batches):
        for batch in batches:
            for pdf in slices(pd.DataFrame({"_id": batch.column(0).to_pandas(), "text": batch.column(1).to_pandas()}), rows=10_000):
                yield pa.RecordBatch.from_arrays([pa.array(pdf["_id"], batch.schema.field(0).type, from_pandas=True), pa.array([model.encode(t) for t in pdf["text"]], pa.list_(pa.int32()))], ["_id", "ids"])

    return run


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(word numbers, document of each sentence) of a batch of encoded texts."""
    lists = batch.column("ids").combine_chunks() if isinstance(batch.column("ids"), pa.ChunkedArray) else batch.column("ids")
    offsets = lists.offsets.to_numpy()
    ids = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    doc = np.repeat(np.arange(len(lists)), np.diff(offsets))
    return ids, doc[ids < 0]


def _expect(model: Model, labels: dict):
    """Expected word counts per class over the sentences of a partition, one row per word it saw, and one of sentences."""
    subjects = model.subjects

    def run(batches):
        v, k = len(model.words), len(subjects) + 1
        counts, held = np.zeros((v + 1, k)), np.zeros(k)
        for batch in batches:
            ids, d = _flat(batch)
            if not len(d):
                continue
            post = model.posterior(ids)
            for i, key in enumerate(batch.column("_id").to_pylist()):
                if key in labels:
                    at = slice(*np.searchsorted(d, [i, i + 1]))
                    post[at] *= np.where(np.isin(subjects, list(labels[key])), 1.0, 0.3)
            shares = _shares(post)
            sentence = np.cumsum(ids < 0) - (ids < 0)
            for c in range(k):
                counts[:, c] += np.bincount(np.where(ids < 0, v, ids), weights=shares[sentence, c], minlength=v + 1)
            held += shares.sum(0)
        counts = counts[:v]
        seen = np.flatnonzero(counts.sum(1))
        rows = [(int(i), counts[i].tolist()) for i in seen] + ([(-1, held.tolist())] if held.sum() else [])
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.float64()))], ["word", "held"])

    return run


def refine(model: Model, encoded: DataFrame, labels: dict) -> Model:
    """One pass of expectation-maximization over all documents. Counts come back per model word, whatever the corpus."""
    k = len(model.subjects) + 1
    rows = (
        encoded.mapInArrow(_expect(model, labels), "word int, held array<double>")
        .groupBy("word").agg(*[F.sum(F.col("held")[c]).alias(f"h{c}") for c in range(k)])
        .collect()  # at most MAX_WORDS + 1 rows
    )
    counts, held = np.zeros((len(model.words), k)), np.zeros(k)
    for r in rows:
        if r.word < 0:
            held = np.array([r[f"h{c}"] for c in range(k)])
        else:
            counts[r.word] = [r[f"h{c}"] for c in range(k)]
    return _model(model.subjects, model.languages, model.words, counts, held)


def third_best(post: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """The log odds of each of n documents' MIN_SENTENCES-th best sentence for each subject; -LIMIT where it has fewer."""
    out = np.full((n, post.shape[1]), -LIMIT)
    first = np.searchsorted(d, np.arange(n))
    count = np.bincount(d, minlength=n)
    has = count >= MIN_SENTENCES
    for c in range(post.shape[1]):
        order = np.lexsort((-post[:, c], d))
        p = np.clip(post[order[first[has] + MIN_SENTENCES - 1], c], 1e-9, 1 - 1e-9)
        out[has, c] = np.clip(np.log(p) - np.log(1 - p), -LIMIT, LIMIT)
    return out


def calibrate(model: Model, docs: list[tuple[str, set[str], str | None]]) -> Model:
    """Slope and shift of each subject's log odds, by logistic regression of a document's label on its MIN_SENTENCES-th best sentence.

    Every subject is calibrated on its own; one that is labelled nearly never or nearly always keeps slope 1 and shift 0.
    """
    encoded = [model.encode(t) for t, _, _ in docs]
    ids = np.array([i for e in encoded for i in e], dtype=np.int64)
    if not (ids < 0).any():
        return model
    d = np.repeat(np.arange(len(docs)), [sum(i < 0 for i in e) for e in encoded])
    slope, shift = model.slope.copy(), model.shift.copy()
    x = third_best(model.posterior(ids), d, len(docs))
    for c, subject in enumerate(model.subjects):
        y = np.array([subject in labels for _, labels, _ in docs], dtype=float)
        if 5 <= y.sum() <= len(y) - 5:
            slope[c], shift[c] = _platt(x[:, c], y)
    return Model(model.subjects, model.languages, model.words, model.weight, model.bias, slope, shift)


def _platt(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of y on x, for labels of which some are wrong or missing: the shares of labels where x is surely high or low are taken for 1 and 0."""
    high, low = x > LIMIT - 1, x < 1 - LIMIT
    hit = y[high].mean() if high.any() else 1.0
    miss = y[low].mean() if low.any() else 0.0
    if hit - miss < 0.1:
        return 1.0, 0.0
    y = (y - miss) / (hit - miss)
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([((p - y) * x).sum() + 5 * (a - 1), (p - y).sum() + 5 * b])
        r = p * (1 - p) + 1e-6
        hess = np.array([[(r * x * x).sum() + 5, (r * x).sum()], [(r * x).sum(), r.sum() + 5]])
        step = np.clip(np.linalg.solve(hess, g), -0.5, 0.5)
        a, b = float(np.clip(a - step[0], 0.2, 5)), float(np.clip(b - step[1], -3, 3))
        if np.abs(step).max() < 1e-6:
            break
    return a, b


def _label(model: Model, id_column: str):
    subjects = np.array(model.subjects, dtype=object)

    def run(batches):
        for batch in batches:
            ids, d = _flat(batch)
            n = batch.num_rows
            if not len(d) or not len(subjects):
                continue
            post = model.posterior(ids)
            calibrated = 1 / (1 + np.exp(-(model.slope * third_best(post, d, n) + model.shift)))
            about = np.stack([np.bincount(d, weights=post[:, c] >= 0.5, minlength=n) for c in range(len(subjects))], 1)
            i, c = np.nonzero((calibrated >= 0.5) & (about >= MIN_SENTENCES))
            yield pa.RecordBatch.from_arrays([batch.column("_id").take(pa.array(i)), pa.array(subjects[c], pa.string()), pa.array(about[i, c].astype("int32")), pa.array(calibrated[i, c])], [id_column, "subject", "n_sentences", "posterior"])

    return run


def fit(docs: DataFrame, labels: DataFrame, subject_areas: DataFrame, id_column: str = "doc_id", rounds: int = ROUNDS, max_labelled: int = MAX_LABELLED, max_chars: int = MAX_LABELLED_CHARS) -> tuple[Model, DataFrame]:
    """The model from at most max_labelled labelled documents of max_chars characters, chosen by hash, and every document of the corpus; and the encoded corpus (_id, ids)."""
    subjects = sorted(r[0] for r in bounded_rows(subject_areas.select("subject").filter("subject is not null").distinct(), MAX_SUBJECTS, "subjects"))
    marked = labels.filter(F.col(id_column).isNotNull() & F.col("subject").isNotNull()).groupBy(id_column).agg(F.collect_set("subject").alias("marks"))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    once = docs.select(id_column, "text", lang.alias("lang")).filter(F.length("text") > 0)
    n = marked.count()
    upto = lambda share: F.pmod(F.xxhash64(id_column), F.lit(1_000_000)) < int(min(1.0, share) * 1_000_000)
    share = 0.95 * max_labelled / n if n > max_labelled else 1.0
    # At most about max_labelled ids are broadcast, so that no text is shuffled but theirs.
    known = once.join(F.broadcast(marked.filter(upto(share))), id_column).groupBy(id_column).agg(F.max_by(F.struct("text", "lang", "marks"), F.struct("text", "lang")).alias("m")).select(id_column, "m.*")
    chars = known.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first().chars
    rows = bounded_rows(known.filter(upto(share * min(1.0, max_chars / max(1, chars)))), max_labelled, "labelled documents")
    sample = [(r.text, set(r.marks), r.lang) for r in rows]
    model = train(sample, subjects)
    kind = docs.schema[id_column].dataType.simpleString()
    encoded = cut(once.select(F.col(id_column).alias("_id"), "text").mapInArrow(_encode_batches(model), f"_id {kind}, ids array<int>"), "words")
    by_id = {r[id_column]: set(r.marks) for r in rows}
    for _ in range(rounds):
        model = refine(model, encoded, by_id)
    return calibrate(model, sample), encoded


def subjects_of(docs: DataFrame, labels: DataFrame, subject_areas: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """(id, subject, n_sentences, posterior): the subjects at least MIN_SENTENCES sentences of a document are about.

    Null, empty and blank texts have none, nor has any document where there are no labels or no subjects. Wrong, missing
    and repeated labels only start the model. Repeated rows of a document give repeated rows; copies score like their
    originals, since a score depends on the text alone. posterior is that of the MIN_SENTENCES-th best sentence. Languages
    are learned from the column `lang`, if there is one, whose codes may be null or wrong.
    """
    model, encoded = fit(docs, labels, subject_areas, id_column, **options)
    kind = docs.schema[id_column].dataType.simpleString()
    return encoded.mapInArrow(_label(model, id_column), f"`{id_column}` {kind}, subject string, n_sentences int, posterior double")


def composition(found: DataFrame, docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Documents and characters per subject; documents without any subject stand under 'none'."""
    size = docs.select(id_column, F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    one = found.select(id_column, "subject").distinct()
    return size.join(one, id_column, "left").groupBy(F.coalesce("subject", F.lit("none")).alias("subject")).agg(F.count("*").alias("n_docs"), F.sum("chars").alias("n_chars"))
