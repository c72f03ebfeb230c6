import random

import pyarrow as pa
import pytest
import regex

from paperloom.llm import encode as E
from paperloom.llm.lexicon import Lexicon
from paperloom.llm.pieces import blocks, pretokens

PIECES = ["ab", "s", "t", "re", "é", "ß", "日本", "😀", "\x00", "\x1c", "\x85", "½", "Ⅷ", "̈", "1", "23", " ", "  ", "\n", "\r\n", "\t", " ", "'", "don't", "'s", "''s", " 's", "'mother", "'re", "'r", "<|endoftext|>", "."]


def words_of(texts, limit=1_000_000):
    out = {}
    for b in blocks(pa.array(texts, pa.string()), limit):
        first, length, text = pretokens(b)
        for f, n, t in zip(first, length, text):
            out.setdefault(int(b.rows[t]), []).append(b.data[f : f + n].tobytes().decode())
    return out


def test_pretokens_are_those_of_the_pattern():
    rng, pattern = random.Random(5), regex.compile(E.PATTERN)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(1, 14))) for _ in range(3000)]
    got = words_of(texts)
    for k, t in enumerate(texts):
        assert got.get(k, []) == pattern.findall(t), repr(t)


def test_long_texts_go_into_several_blocks():
    text = "the quick brown fox\n jumps 12 times " * 500
    assert "".join(words_of(["a", text, None, "", "b"], 300)[1]) == text
    assert words_of([text], 300)[0] == regex.compile(E.PATTERN).findall(text)


def test_lexicon_numbers_words():
    rng = random.Random(2)
    words = sorted({bytes(rng.choices(b"abcde ", k=rng.randint(1, 9))) for _ in range(600)})
    lexicon = Lexicon.build(words, [[k] * (k % 3 + 1) for k in range(len(words))])
    asked = words + [bytes(rng.choices(b"abcde ", k=rng.randint(1, 10))) for _ in range(600)]
    column = pa.array([w.decode() for w in asked])
    import numpy as np

    data = np.frombuffer(b"".join(asked) + bytes(64), np.uint8)
    length = np.array([len(w) for w in asked])
    first = np.cumsum(length) - length
    at = {w: k for k, w in enumerate(words)}
    assert lexicon.number(data, first, length).tolist() == [at.get(w, -1) for w in asked]
    assert len(column) == len(asked)
    # Shared suffixes: far fewer states than letters.
    assert len(lexicon.base) < sum(map(len, words)) / 2
    assert Lexicon.build([], []).number(data, first, length).tolist() == [-1] * len(asked)


@pytest.fixture(scope="module")
def public():
    import base64

    import tiktoken

    try:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(E.VOCABULARY, "rb"))}
    except FileNotFoundError:
        pytest.skip("no vocabulary here")
    return tiktoken.Encoding("public", pat_str=E.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_library(spark, public):
    rng = random.Random(9)
    texts = ["".join(rng.choices(PIECES + ["word ", "Word", " common"], k=rng.randint(0, 30))) for _ in range(400)] + [None, "", " ", "x" * 50_000, "hello " * 100_000]
    df = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "doc_id bigint, text string, ids string").repartition(3)
    got = {r["doc_id"]: r["ids"] for r in E.encode(df, ["doc_id"], "text").collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        assert got[k] == public.encode_ordinary(t or ""), repr(t)[:80]
    counts = {r["doc_id"]: r["tokens"] for r in E.token_counts(df, ["doc_id"], "text").collect()}
    assert counts == {k: len(v) for k, v in got.items()}


def test_no_documents(spark, public):
    assert E.encode(spark.createDataFrame([], "doc_id bigint, text string"), ["doc_id"], "text").count() == 0


def test_word_counts_cover_all_texts(spark):
    df = spark.createDataFrame([("a b a",), (None,), ("a averylongwordofthirtytwobytes!!",), ("",)], "text string")
    got = {bytes(r["word"]): r["n"] for r in E.word_counts(df, "text").collect()}
    assert got == {b"a": 2, b" b": 1, b" a": 1, b" averylongwordofthirtytwobytes": 1, b"!!": 1}
