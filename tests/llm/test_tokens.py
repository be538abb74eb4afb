import os
import random

import pytest

pytest.importorskip("tiktoken")
from tallyforge.llm import tokens as T  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isfile(T.VOCABULARY), reason="no vocabulary here")


def texts(n=120):
    rng = random.Random(5)
    kinds = {
        "letters": "abcdething", "mixed": "ab c1'’. \n\tÄé€s", "marks": "!?-'=*", "wide": "日本語字漢ñ", "blanks": " \n\t x",
    }
    for _ in range(n):
        alphabet = kinds[rng.choice(sorted(kinds))]
        yield "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4000)))
    yield "the" * 3000
    yield "x" + " " * 5000 + "y's"


def test_trees_equal_whole_encodings():
    enc = T.encoder(T.VOCABULARY)
    for text in texts():
        assert enc.text(text) == enc.bpe.encode_ordinary(text)


@pytest.mark.parametrize("leaf, reach", [(8, 0), (8, 6), (40, 200), (256, 0)])
def test_trees_of_any_leaf(monkeypatch, leaf, reach):
    """Cuts inside runs and at their ends, down to very small leaves, for texts of all kinds."""
    monkeypatch.setattr(T, "LEAF_CHARS", leaf)
    monkeypatch.setattr(T, "SAFE_REACH", reach)
    enc, cuts = T.encoder(T.VOCABULARY), []
    concat = T.Encoder.concat
    monkeypatch.setattr(T.Encoder, "concat", lambda self, a, b, inside: cuts.append(inside) or concat(self, a, b, inside))
    for text in list(texts(80)) + ["Donaudampfschifffahrtselektrizitätenhauptbetriebswerk " * 9, "an ordinary sentence, with some words in it. " * 30]:
        assert enc.text(text) == enc.bpe.encode_ordinary(text)
    assert cuts and (True in cuts) and (False in cuts)


@pytest.mark.parametrize("size", [60, 300, 1100])
def test_parts_equal_whole_encodings(monkeypatch, size):
    monkeypatch.setattr(T, "PART", size)
    enc = T.encoder(T.VOCABULARY)
    for text in texts(60):
        parts = T.parts_of(text)
        assert "".join(p for p, _ in parts) == text
        got = []
        for p, inside in parts:
            part = enc.tree(p, True, True)
            assert part.ids == enc.bpe.encode_ordinary(p)
            got.append((part.ids, inside, part.first, part.last))
        assert T.join_parts(enc, got) == enc.bpe.encode_ordinary(text)


def test_corpus(spark):
    long = " ".join(texts(40))
    rows = [(1, "Hello there <|endoftext|>", "x"), (2, "", None), (3, None, None), (4, long, None), (4, long, None), (None, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = T.encode_corpus(df, long_text=5000).collect()
    enc = T.encoder(T.VOCABULARY)
    assert len(got) == 6
    want = {1: rows[0][1], 2: "", 3: "", 4: long, None: "a"}
    assert all(list(r.ids) == enc.bpe.encode_ordinary(want[r.doc_id]) for r in got)
    assert T.encode_corpus(df.limit(0)).count() == 0


def test_parts_of_long_texts_run_in_several_tasks(spark):
    """Texts beyond LONG_TEXT by default parameters: one run, ordinary words, and both together."""
    rng = random.Random(3)
    words = " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(30_000))
    rows = [(1, words), (2, "ab" * 80_000), (3, words + "é" * 70_000 + words), (4, " " * 120_000)]
    assert all(len(t) >= T.LONG_TEXT for _, t in rows)
    enc = T.encoder(T.VOCABULARY)
    got = {r.doc_id: list(r.ids) for r in T.encode_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: enc.bpe.encode_ordinary(t) for i, t in rows if i in (1,)} | {i: enc.text(t) for i, t in rows if i != 1}
    assert enc.bpe.encode_ordinary("ab" * 2_000) == enc.text("ab" * 2_000)


def test_slices_lose_no_row(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(T, "SLICE_BYTES", 50)
    rows = [None, "", "a" * 200, "b c", None, "x" * 49, "y", "z" * 51, ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], ["doc_id", "text"])
    out = list(T._encode_batches(T.VOCABULARY, "doc_id")(iter([batch, batch.slice(0, 0)])))
    enc = T.encoder(T.VOCABULARY)
    assert [x for b in out for x in b.column(1).to_pylist()] == [enc.text(r) for r in rows] and len(out) > 3


def test_same_ids_as_another_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = T.VOCABULARY.replace(".tiktoken", ".json")
    if not os.path.isfile(path):
        pytest.skip("no second vocabulary file here")
    other = tokenizers.Tokenizer.from_file(path)
    other.encode_special_tokens = True
    enc = T.encoder(T.VOCABULARY)
    for text in list(texts(20)):
        assert other.encode(text, add_special_tokens=False).ids == enc.text(text)
