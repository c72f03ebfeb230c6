"""Signatures as rows of bits, and which rows are alike, told block by block from one matrix product.

Signatures hold only words that a share of all documents have, so their words are few hundred and a row a few dozen
bytes.  Lists of such words select nothing; a product of 0/1 matrices gives the words that two share for whole blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.prefix import row_numbers
from paperloom.sources.tables import cut

#: Numbers of a matrix block, for its memory (4 bytes each), and the most rows of a block.
CELLS, ROWS = 1 << 22, 2048


def height(width: int) -> int:
    """Rows of a block of so many words."""
    return max(16, min(ROWS, CELLS // max(width, 1)))


def with_bits(signed: DataFrame) -> tuple[DataFrame, int]:
    """(key, size, bits) of signatures that are not empty, and the number of different words.

    signed: a key, signature.  Equal signatures have equal bits.
    """
    spark, key = signed.sparkSession, signed.columns[0]
    vocabulary = sorted(r[0] for r in signed.select(F.explode("signature").alias("w")).distinct().collect())
    words, width = spark.sparkContext.broadcast({w: k for k, w in enumerate(vocabulary)}), len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, step = words.value, height(width)
        for whole in batches:
            for begin in range(0, whole.num_rows, step):
                b = whole.slice(begin, step)
                rows = np.zeros((b.num_rows, width), np.uint8)
                lists = b.column(1).to_pylist()
                rows[np.repeat(np.arange(len(lists)), [len(s) for s in lists]), [table[w] for s in lists for w in s]] = 1
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([r.tobytes() for r in np.packbits(rows, axis=1)], pa.binary())], ["key", "size", "bits"])

    some = signed.filter(F.size("signature") > 0).select(F.col(key).alias("key"), "signature", F.size("signature").alias("size"))
    return some.mapInArrow(run, "key string, size int, bits binary").withColumnRenamed("key", key), width


def ranked_nodes(rows: DataFrame) -> DataFrame:
    """(rank, node, size, documents, bits): each different row of bits once, under its smallest sha, largest first, then by sha.

    rows: sha, size, bits.  Written once, spread over all cores by rank, so any stretch of ranks is as well.
    """
    distinct = rows.groupBy("bits").agg(F.min("sha").alias("node"), F.first("size").alias("size"), F.count("*").alias("documents")).withColumn("_size", -F.col("size"))
    ranked = row_numbers(distinct, ["_size", "node"], "rank").select("rank", "node", "size", "documents", "bits")
    return cut(ranked.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism, "rank"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The packed rows of a column of bits."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1 if len(column) else 0)


def unpacked(packed: np.ndarray, width: int) -> np.ndarray:
    return np.unpackbits(packed, axis=1, count=width).astype(np.float32)


def alike(rows: np.ndarray, size: np.ndarray, others: np.ndarray, sizes: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, shared): the pairs of a row and one of the others that may be so similar, and the words both have.

    rows, others: 0/1 matrices; what lies just under the threshold may come too.  In order of i, then j.
    """
    # Similar by the threshold is: of both sizes together, the share t / (1 + t) is shared.
    part = np.float32(threshold / (1 + threshold))
    ones = np.ones((len(size), 1), np.float32)
    over = np.hstack([rows, -part * size[:, None].astype(np.float32), ones]) @ np.hstack([others, np.ones((len(sizes), 1), np.float32), -part * sizes[:, None].astype(np.float32)]).T
    at = np.flatnonzero(over >= -0.01)
    i, j = np.divmod(at, max(len(sizes), 1))
    return i, j, np.rint(over.ravel()[at] + np.float64(part) * (size[i] + sizes[j])).astype(np.int64)


def join_best(rows: tuple[np.ndarray, ...], others: tuple[np.ndarray, ...], threshold: float, at: np.ndarray, fit: np.ndarray) -> None:
    """Set at and fit to the rank of the other that each row is most similar to, the first of equals, and that similarity.

    rows, others: matrix, sizes, ranks.  Only others of a smaller rank count, over the threshold and over the fit so far.
    """
    i, j, shared = alike(rows[0], rows[1], others[0], others[1], threshold)
    ratio = shared / (rows[1][i] + others[1][j] - shared)
    true = np.flatnonzero((ratio >= threshold) & (others[2][j] < rows[2][i]) & (ratio > fit[i]))
    true = true[np.lexsort((j[true], -ratio[true], i[true]))]
    true = true[np.diff(i[true], prepend=-1) != 0]
    at[i[true]], fit[i[true]] = others[2][j[true]], ratio[true]


def first_leaders(matrix: np.ndarray, size: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows no leader before them holds, taken one after another."""
    i, j, shared = alike(matrix, size, matrix, size, threshold)
    true = (j < i) & (shared / (size[i] + size[j] - shared) >= threshold)
    j, ends = j[true], np.searchsorted(i[true], np.arange(len(size) + 1))
    leads = np.zeros(len(size), bool)
    for k in range(len(size)):
        leads[k] = not leads[j[ends[k] : ends[k + 1]]].any()
    return leads
