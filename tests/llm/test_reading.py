import random

import numpy as np
import pyarrow as pa

from paperloom.llm.reading import Reader, Sentences, graded, has_words, reading_levels
from paperloom.llm.pieces import Block
from pyspark.sql import functions as F

EASY, HARD = "the cat has a red box and old key".split(), "notwithstanding characterisation necessitates interlaboratory documentation".split()


def text_of(band, rng):
    out = []
    for _ in range(10):
        n = 3 + 3 * band + rng.randint(0, 2)
        out.append(" ".join(rng.choice(HARD if rng.random() < (band - 1) / 4 else EASY) for _ in range(n)).capitalize() + ".")
    return "Code: R1\n" + " ".join(out)


def test_held_out_accuracy():
    rng = random.Random(0)
    bands = [1 + k % 5 for k in range(200)]
    texts = [text_of(b, rng) for b in bands]
    reader = Reader.fit(texts[:120], bands[:120])
    got = reader.bands(pa.array(texts[120:]))
    assert (got == np.array(bands[120:])).mean() > 0.85
    assert (abs(got - np.array(bands[120:])) <= 1).all()
    # The same whatever else is in the batch, and for texts in several blocks.
    assert reader.bands(pa.array([None, "", texts[130]]))[2] == got[10]


def test_sentences():
    s = Sentences(Block.of([0, 1], ["One two. Three 3.5 four; five\nsix", "Seven"]))
    assert s.words.tolist() == [2, 2, 1, 1, 1] and s.row.tolist() == [0, 0, 0, 0, 1]


def test_short_null_and_ungraded(spark):
    rng = random.Random(1)
    rows = [(k, text_of(1 + k % 5, rng)) for k in range(40)] + [(100, None), (101, ""), (102, "few words")]
    documents = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id bigint, text string, band string")
    labels = spark.createDataFrame([(k, 1 + k % 5) for k in range(30)] + [(1, None), (2, 9), (500, 3), (102, 1)], "doc_id bigint, band int")
    got = {r["doc_id"]: r["band"] for r in reading_levels(documents, labels, 30).collect()}
    assert set(got) == set(range(40)) and all(1 <= b <= 5 for b in got.values())
    none = reading_levels(documents, labels.filter("false"), 30).collect()
    assert len(none) == 40 and all(r["band"] is None for r in none)
    assert reading_levels(documents.filter("false"), labels, 30).count() == 0
    texts, bands = graded(documents, labels, 30, most=7)
    assert len(texts) == len(bands) == 7


def test_median_of_grades(spark):
    documents = spark.createDataFrame([(1, "w " * 40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 2), (1, 5), (1, 3)], "doc_id bigint, band int")
    assert graded(documents, labels, 30)[1] == [3]


def test_words_between_white_space(spark):
    texts = [None, "", " \n", "a", " a b\u00a0c\u2003d ", "a " * 4, "a\x1cb\x85c, d", "a-b c d", "x" * 5000 + " b c"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = [len(t.split()) if t is not None else None for t in texts]
    for least in (1, 3, 4, 5):
        got = [r[0] for r in df.select(has_words(F.col("text"), least)).collect()]
        assert got == [None if n is None else n >= least for n in counts]
