"""Reading level: a regularised word model and a character model grade each sentence, documents are calibrated on those.

Graded documents lend their band to their sentences.  Two softmax models learn it: one from hashed words and the length
of the sentence, one from hashed character trigrams within words; both with an L2 penalty.  A document is described by
the distribution of its sentences' levels under both models (means over sentences and over words, spread) and by its
mean sentence and word length; a third softmax calibrates this description on grades, using for each graded document
sentence models that did not see it.

The models are fitted on at most ``SAMPLE`` graded documents, chosen by a hash of their key, which is a bound and not a
share; everything else runs over all documents and whole texts.  Several grades of one document count by their median
(the upper of the middle two).  Grades that are null or outside 1 to 5, and grades of documents that are not there or
too short, are left out; without any grade every document gets no band (null).

A sentence ends with . ! ? or ; before white space, or with a line end.  Lines of fewer than ``LEAST_WORDS`` words (table
rows, headings) are read only where a document has no others.  Null texts have no words and so no band.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.pieces import END, LETTER, SENTINEL, SPACE, Block, blocks, classes

BANDS = 5
#: Graded documents the models are fitted on at most.
SAMPLE = 1500
CELLS = 1 << 15
LEAST_WORDS = 4
#: Lengths of sentences, as classes: up to so many words.
LENGTHS = np.array([4, 6, 8, 10, 13, 16, 20, 25, 32, 40, 55, 80])
FEATURES = 4 * BANDS + 5


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    out = np.arange(END + 1, dtype=np.uint32)
    for c in np.flatnonzero(classes() == LETTER).tolist():
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    r = 0x5851F42D4C957F2D
    steps = np.full(n, r, np.uint64)
    steps[0] = 1
    back = np.full(n, pow(r, -1, 1 << 64), np.uint64)
    back[0] = 1
    return np.multiply.accumulate(steps), np.multiply.accumulate(back)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(49)).astype(np.int32)


class Sentences:
    """The sentences of a block: their text, words and features; only such as have a word."""

    def __init__(self, b: Block):
        points, kinds = _lower()[b.points], b.kinds
        n = len(points)
        letter = kinds == LETTER
        after = np.empty(n, np.uint8)
        after[:-1], after[-1] = kinds[1:], SENTINEL
        gap = (after == SPACE) | (after == SENTINEL)
        # Line ends, and the marks that end a sentence before white space.
        ends = np.isin(points, [0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0x2028, 0x2029]) | (np.isin(points, [0x2E, 0x21, 0x3F, 0x3B]) & gap) | (points == END)
        sentence = np.zeros(n, np.int32)
        sentence[1:] = np.cumsum(ends)[:-1]
        begins = letter.copy()
        begins[1:] &= ~letter[:-1]
        stops = letter & (after != LETTER)
        first, last = np.flatnonzero(begins), np.flatnonzero(stops)
        up, down = _powers(1 << 21) if n < 1 << 21 else _powers(1 << (n.bit_length()))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(points.astype(np.uint64) * up[:n], out=sums[1:])
        words = (sums[last + 1] - sums[first]) * down[first]
        self.word_cells = _mix(words)
        self.word_sentence = sentence[first]
        self.word_length = last - first + 1
        held = np.where(letter, points, 0).astype(np.uint64)
        at = np.flatnonzero(letter)
        left, right = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
        left[1:], right[:-1] = held[:-1], held[1:]
        self.char_cells = _mix((left * np.uint64(0x100000001B3) + held) * np.uint64(0xD6E8FEB86659FD93) + right)[at]
        self.char_sentence = sentence[at]
        total = int(sentence[-1]) + 1
        self.words = np.bincount(self.word_sentence, minlength=total)
        self.chars = np.bincount(self.char_sentence, minlength=total)
        text = np.cumsum(points == END) - (points == END)
        of = np.zeros(total, np.int64)
        of[sentence] = text
        self.row = b.rows[of]
        self.total = total

    def cells(self, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(feature of each occurrence, its sentence, features of each sentence)."""
        if kind == "char":
            return self.char_cells, self.char_sentence, self.chars
        return self.word_cells, self.word_sentence, self.words


def length_class(words: np.ndarray) -> np.ndarray:
    return np.searchsorted(LENGTHS, words)


def _pooled(table: np.ndarray, cells: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Means of the table's rows over each sentence; occurrences are in the order of their sentences."""
    out = np.zeros((len(size), table.shape[1]), np.float32)
    some = np.flatnonzero(size)
    if len(cells):
        begin = (np.cumsum(size) - size)[some]
        for k in range(table.shape[1]):
            out[some, k] = np.add.reduceat(np.ascontiguousarray(table[:, k])[cells], begin)
    return out / np.maximum(size, 1)[:, None]


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


class Adam:
    def __init__(self, shape: tuple[int, ...], rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0, rate

    def step(self, w: np.ndarray, g: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.01 * (g * g - self.v)
        w -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def fit_sentences(cells, sentence, size, lengths, target, rounds: int = 40, penalty: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """(table of cells x bands, table of length classes x bands) of a softmax over mean-pooled hashed features."""
    table = np.zeros((CELLS, BANDS), np.float32)
    by_length = np.zeros((len(LENGTHS) + 1, BANDS), np.float32)
    one, two = Adam(table.shape, 0.3), Adam(by_length.shape, 0.1)
    want = np.eye(BANDS, dtype=np.float32)[target]
    share = (1 / np.maximum(size, 1)).astype(np.float32)
    # Occurrences by cell, so that a gradient is sums of stretches.
    order = np.argsort(cells, kind="stable")
    seen, begin = np.unique(cells[order], return_index=True)
    of = sentence[order]
    grad = np.zeros_like(table)
    for _ in range(rounds):
        error = (softmax(_pooled(table, cells, size) + by_length[lengths]) - want) / len(target)
        spread = error * share[:, None]
        for k in range(BANDS if len(of) else 0):
            grad[seen, k] = np.add.reduceat(np.ascontiguousarray(spread[:, k])[of], begin)
        one.step(table, grad + penalty * table)
        grad_l = np.stack([np.bincount(lengths, weights=error[:, k], minlength=len(LENGTHS) + 1) for k in range(BANDS)], axis=1)
        two.step(by_length, grad_l.astype(np.float32) + penalty * by_length)
    return table, by_length


def describe(s: Sentences, models, rows: int) -> np.ndarray:
    """Sums for each row from which ``features`` makes its description; sums of parts of a text add up."""
    out = np.zeros((rows, 2, 4 * BANDS + 6))
    levels = {k: softmax(_pooled(t, *s.cells(k)[::2]) + by[length_class(s.words)]) for k, (t, by) in models.items()}
    letters = np.bincount(s.word_sentence, weights=s.word_length, minlength=s.total)
    for short in (0, 1):
        mine = (s.words > 0) & ((s.words < LEAST_WORDS) == bool(short))
        row, w = s.row[mine], s.words[mine]
        column = 0
        for k in ("word", "char"):
            for weight in (np.ones(len(w)), w):
                for band in range(BANDS):
                    out[:, short, column] = np.bincount(row, weights=levels[k][mine, band] * weight, minlength=rows)
                    column += 1
        mean = levels["word"][mine] @ np.arange(BANDS)
        for x in (np.ones(len(w)), w, np.log(w), letters[mine], mean, mean * mean):
            out[:, short, column] = np.bincount(row, weights=x, minlength=rows)
            column += 1
    return out


def features(sums: np.ndarray) -> np.ndarray:
    """Rows x FEATURES: what calibration sees; of the short lines only where there are no others."""
    s = np.where((sums[:, 0, 4 * BANDS] > 0)[:, None], sums[:, 0], sums[:, 1])
    n, w = np.maximum(s[:, 4 * BANDS], 1), np.maximum(s[:, 4 * BANDS + 1], 1)
    parts = [s[:, k * BANDS : (k + 1) * BANDS] / (n if k % 2 == 0 else w)[:, None] for k in range(4)]
    mean = s[:, 4 * BANDS + 4] / n
    more = [s[:, 4 * BANDS + 2] / n, np.log(w / n), s[:, 4 * BANDS + 3] / w, mean, np.sqrt(np.maximum(s[:, 4 * BANDS + 5] / n - mean**2, 0))]
    return np.concatenate([*parts, np.stack(more, axis=1)], axis=1)


def calibrate(x: np.ndarray, target: np.ndarray, rounds: int = 400, penalty: float = 1e-3):
    """(mean, scale, weights with the bias last) of a softmax over standardised descriptions."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1).astype(np.float32)
    w = np.zeros((z.shape[1], BANDS), np.float32)
    opt, want = Adam(w.shape, 0.05), np.eye(BANDS, dtype=np.float32)[target]
    for _ in range(rounds):
        opt.step(w, z.T @ (softmax(z @ w) - want) / len(z) + penalty * w)
    return mean, scale, w


class Reader:
    """Fitted models: of words, of characters, and the calibration."""

    def __init__(self, models, calibration):
        self.models, self.calibration = models, calibration

    @staticmethod
    def fit(texts: list[str], bands: list[int]) -> Reader:
        parts = [(Sentences(b), None) for b in blocks(pa.array(texts, pa.string()))]
        rows, target = len(texts), np.asarray(bands) - 1
        stacked = _stack([s for s, _ in parts])
        fold = np.arange(rows) % 2
        held = np.zeros((rows, FEATURES))

        def models_of(keep: np.ndarray):
            out = {}
            for kind in ("word", "char"):
                cells, sentence, size = stacked.cells(kind)
                used = (stacked.words >= LEAST_WORDS) & keep[stacked.row]
                if not used.any():
                    used = (stacked.words > 0) & keep[stacked.row]
                number = np.cumsum(used) - 1
                mine = used[sentence]
                out[kind] = fit_sentences(cells[mine], number[sentence[mine]], size[used], length_class(stacked.words[used]), target[stacked.row[used]])
            return out

        for k in (0, 1):
            if (fold != k).any() and (fold == k).any():
                held[fold == k] = features(describe(stacked, models_of(fold != k), rows))[fold == k]
        return Reader(models_of(np.ones(rows, bool)), calibrate(held, target))

    def bands(self, column: pa.Array) -> np.ndarray:
        rows = len(column)
        sums = np.zeros((rows, 2, 4 * BANDS + 6))
        for b in blocks(column):
            low = int(b.rows[0])
            part = Block(b.rows - low, b.points, b.kinds, b.data, b.at)
            got = describe(Sentences(part), self.models, int(part.rows[-1]) + 1)
            sums[low : low + len(got)] += got
        mean, scale, w = self.calibration
        x = features(sums)
        return softmax(((x - mean) / scale) @ w[:-1] + w[-1]).argmax(axis=1).astype(np.int32) + 1


class _Stack(Sentences):
    def __init__(self):  # filled by _stack
        pass


def _stack(parts: list[Sentences]) -> Sentences:
    out, shift = _Stack(), np.cumsum([0] + [p.total for p in parts])
    for name in ("word", "char"):
        setattr(out, f"{name}_cells", np.concatenate([getattr(p, f"{name}_cells") for p in parts]))
        setattr(out, f"{name}_sentence", np.concatenate([getattr(p, f"{name}_sentence") + s for p, s in zip(parts, shift)]))
    for name in ("words", "chars", "row", "word_length"):
        setattr(out, name, np.concatenate([getattr(p, name) for p in parts]))
    out.total = int(shift[-1])
    return out


def has_words(text, least: int):
    """Whether a text has so many words between white space of any kind; reads on only until it has."""
    return text.rlike(rf"^(?:[\s\x1c-\x1f\x85\p{{Z}}]*+[^\s\x1c-\x1f\x85\p{{Z}}]++){{{least}}}")


def graded(documents: DataFrame, labels: DataFrame, least: int, most: int = SAMPLE) -> tuple[list[str], list[int]]:
    """Texts and bands of at most ``most`` graded documents, in the order of a hash of their key."""
    bands = labels.filter(F.col("band").between(1, BANDS)).groupBy("doc_id").agg(F.array_sort(F.collect_list("band")).alias("all"))
    median = bands.select("doc_id", F.get("all", F.floor(F.size("all") / 2).cast("int")).alias("band"))
    there = documents.select("doc_id").join(median, "doc_id")
    chosen = there.withColumn("_order", F.xxhash64("doc_id")).orderBy("_order", "doc_id").limit(most).drop("_order")
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "band", has_words(F.col("text"), least).alias("long"), F.xxhash64("doc_id").alias("_order"), "doc_id").toArrow()
    rows = sorted((r for r in rows.to_pylist() if r["long"]), key=lambda r: (r["_order"], r["doc_id"]))
    return [r["text"] for r in rows], [r["band"] for r in rows]


def reading_levels(documents: DataFrame, labels: DataFrame, least: int) -> DataFrame:
    """(doc_id, band int): every document of at least ``least`` words, with its band."""
    spark = documents.sparkSession
    texts, bands = graded(documents, labels, least)
    key = documents.schema["doc_id"].dataType.simpleString()
    kept = documents.select("doc_id", "text").filter(has_words(F.col("text"), least))
    if not texts:
        return kept.select("doc_id", F.lit(None).cast("int").alias("band"))
    held = spark.sparkContext.broadcast(Reader.fit(texts, bands))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(reader.bands(part.column(1)))], ["doc_id", "band"])

    return kept.mapInArrow(run, f"doc_id {key}, band int")
