"""Encoding of texts with a public byte-level BPE vocabulary.

A first pass counts the pre-tokens of all documents; the most frequent ones, with the ids the merges give them, are
compiled into a minimal acyclic transducer (``lexicon``) that workers map from the shared folder.  The second pass
divides each text into pre-tokens, walks the transducer with all of them at once, and merges by the vocabulary's rules
the words that it lacks; so the ids are exactly those of the vocabulary, whatever the lexicon holds.

Null and empty texts have no ids (an empty list); blank texts are encoded like any other.  Very long texts are encoded
in blocks, whole.  No special tokens are made; their strings are ordinary text.  Repeated rows each give a row.
Only the key and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm.lexicon import Lexicon
from paperloom.llm.pieces import Block, blocks, pretokens
from paperloom.sources.tables import shared_folder

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Words the lexicon holds at most; longer ones and rarer ones are merged when met.
LEXICON_WORDS = 1 << 15
LONGEST_WORD = 32
#: Distinct words a task counts before it hands them on.
COUNT_AT_ONCE = 1 << 18
# The public pattern that divides text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[int, object] = {}
_lexicons: dict[str, Lexicon] = {}
_merged: dict[bytes, list[int]] = {}


def encoder(ranks: bytes):
    """The merges of a rank file, once per process."""
    key = hash(ranks)
    if key not in _encoders:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encoders[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encoders[key]


def _words_of(b: Block) -> tuple[list[bytes], np.ndarray]:
    """Distinct short words of a block and how often each occurs."""
    first, length, _ = pretokens(b)
    keep = length <= LONGEST_WORD
    first, length = first[keep], length[keep]
    words: list[bytes] = []
    counts: list[np.ndarray] = []
    for width in (8, 16, 32):
        mine = (length <= width) & (length > (width // 2 if width > 8 else 0))
        if not mine.any():
            continue
        f, n = first[mine], length[mine]
        cells = b.data[f[:, None] + np.arange(width)]
        cells[np.arange(width) >= n[:, None]] = 0
        packed = cells.view(np.uint64).reshape(len(f), width // 8) if width > 8 else cells.view(np.uint64).ravel()
        if width > 8:
            mixed = packed[:, 0].copy()
            for k in range(1, packed.shape[1]):
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + packed[:, k]
        else:
            mixed = packed
        _, at, times = np.unique(mixed, return_index=True, return_counts=True)
        words += [b.data[f[k] : f[k] + n[k]].tobytes() for k in at]
        counts.append(times)
    return words, np.concatenate(counts) if counts else np.zeros(0, np.int64)


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word binary, n): how often each pre-token of up to LONGEST_WORD bytes occurs in all texts.

    Words are told apart within a block by a 64-bit mix of their bytes; the counts only choose what is compiled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for b in blocks(batch.column(0)):
                words, times = _words_of(b)
                for w, n in zip(words, times.tolist()):
                    total[w] += n
                if len(total) > COUNT_AT_ONCE:
                    yield out()
                    total.clear()
        if total:
            yield out()

    return df.select(text).filter(F.length(text) > 0).mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def write_shared(spark: SparkSession, raw: bytes, name: str) -> str:
    """A file in the shared folder; its path as workers find it (see ``mapped``)."""
    folder = shared_folder(spark)
    path = f"{folder}/{name}-{uuid.uuid4().hex}.bin"
    local = re.sub("^file:/+", "/", path)
    if local.startswith("/"):
        with open(local, "wb") as f:
            f.write(raw)
        return local
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    stream.write(raw)
    stream.close()
    spark.sparkContext.addFile(path)
    return path


def mapped(path: str) -> Lexicon:
    """The lexicon, mapped once per process: in the shared folder itself, or as Spark brought it from a remote one."""
    if path not in _lexicons:
        _lexicons.clear()
        _merged.clear()
        _lexicons[path] = Lexicon.load(path if path.startswith("/") else SparkFiles.get(path.rsplit("/", 1)[-1]))
    return _lexicons[path]


def compile_lexicon(df: DataFrame, text: str, ranks: bytes) -> str:
    """Counts all texts, compiles the most frequent words, writes the lexicon; its path."""
    top = word_counts(df, text).filter("n > 1").orderBy(F.desc("n"), "word").limit(LEXICON_WORDS).select("word").toArrow()
    merge = encoder(ranks)
    words = sorted(w for w in top.column(0).to_pylist())
    ids = [_merge(merge, w) for w in words]
    return write_shared(df.sparkSession, Lexicon.build(words, ids).save(), "lexicon")


def _merge(merge, word: bytes) -> list[int]:
    """The ids of one pre-token, which the pattern leaves in one piece."""
    return merge.encode_ordinary(word.decode("utf-8", "replace"))


def numbered(b: Block, lexicon: Lexicon, merge) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of each pre-token, its text, starts, flat): unseen words get numbers after the lexicon's."""
    first, length, text = pretokens(b)
    number = lexicon.number(b.data, first, length)
    missing = np.flatnonzero(number < 0)
    if not len(missing):
        return number, text, lexicon.starts, lexicon.flat
    fresh: dict[bytes, int] = {}
    more: list[list[int]] = []
    raw = b.data.tobytes()
    own = np.empty(len(missing), np.int32)
    known = len(lexicon.starts) - 1
    for k, (f, n) in enumerate(zip(first[missing].tolist(), length[missing].tolist())):
        w = raw[f : f + n]
        at = fresh.get(w)
        if at is None:
            at = fresh[w] = len(more)
            ids = _merged.get(w)
            if ids is None:
                ids = _merge(merge, w)
                if n <= LONGEST_WORD:
                    if len(_merged) > 200_000:  # a cache, not a result
                        _merged.clear()
                    _merged[w] = ids
            more.append(ids)
        own[k] = known + at
    number[missing] = own
    ends = lexicon.starts[-1] + np.cumsum([len(x) for x in more])
    return number, text, np.concatenate([lexicon.starts, ends.astype(np.int32)]), np.concatenate([lexicon.flat, np.array([i for x in more for i in x], np.int32)])


def _encode_batch(column: pa.Array, lexicon: Lexicon, merge) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, ids of those rows, number of ids of each); rows in order, each once."""
    rows = len(column)
    done = 0
    held_ids: list[np.ndarray] = []
    sizes = np.zeros(rows, np.int64)
    for b in blocks(column):
        number, text, starts, flat = numbered(b, lexicon, merge)
        begin, size = starts[number], starts[number + 1] - starts[number]
        total = int(size.sum())
        shift = begin - (np.cumsum(size) - size)
        ids = flat[np.repeat(shift, size) + np.arange(total)]
        held_ids.append(ids)
        per_text = np.bincount(text, weights=size, minlength=len(b.rows))[: len(b.rows)].astype(np.int64)
        np.add.at(sizes, b.rows, per_text)
        # The last row of a block may go on in the next one.
        last = int(b.rows[-1])
        whole = int(sizes[done:last].sum())
        every = np.concatenate(held_ids)
        yield done, last, every[:whole], sizes[done:last]
        held_ids, done = [every[whole:]], last
    yield done, rows, np.concatenate(held_ids) if held_ids else np.zeros(0, np.int32), sizes[done:]


def _mapper(path: str, ranks_var, emit: Callable[[np.ndarray, np.ndarray], pa.Array], name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, merge = mapped(path), encoder(ranks_var.value)
        for batch in batches:
            for a, z, ids, sizes in _encode_batch(batch.column(batch.num_columns - 1), lexicon, merge):
                if z > a:
                    keys = [batch.column(k).slice(a, z - a) for k in range(batch.num_columns - 1)]
                    yield pa.RecordBatch.from_arrays([*keys, emit(ids, sizes)], [*batch.schema.names[:-1], name])

    return run


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(ids.astype(np.int32)))


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, keys: list[str], text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """keys and ``ids`` (array of int): the token ids of each text."""
    return _apply(df, keys, text, vocabulary, _lists, "ids", "array<int>")


def token_counts(df: DataFrame, keys: list[str], text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """keys and ``tokens`` (bigint): the number of token ids of each text, 0 for null and empty ones."""
    return _apply(df, keys, text, vocabulary, lambda ids, sizes: pa.array(sizes, pa.int64()), "tokens", "bigint")


def _apply(df: DataFrame, keys: list[str], text: str, vocabulary: str, emit, name: str, kind: str) -> DataFrame:
    spark, ranks = df.sparkSession, _read(vocabulary)
    path = compile_lexicon(df, text, ranks)
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys).schema)
    held = spark.sparkContext.broadcast(ranks)
    return df.select(*keys, text).mapInArrow(_mapper(path, held, emit, name), f"{shape}, {name} {kind}")
