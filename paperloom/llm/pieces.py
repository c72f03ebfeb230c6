"""Texts of an Arrow batch as flat arrays, and their division into pre-tokens, all vectorised.

A block holds the texts of some rows end to end, one sentinel after each, as bytes and as code points.  Long texts go
into several blocks, divided only where a pre-token certainly ends, so nothing is cut off and memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

SPACE, LETTER, NUMBER, OTHER, SENTINEL = range(5)
#: Stands between texts; no code point is that high.
END = 0x110000
#: Characters a block holds, about.
BLOCK_CHARS = 1_000_000


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point: white space, letter, number or other."""
    out = np.full(END + 1, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, END)]))
    place = np.concatenate([np.arange(0xD800), np.arange(0xE000, END)])
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, every):
            out[place[m.start() : m.end()]] = kind
    # Separators that the Python library counts as white space and the pattern's own dialect does not.
    out[0x1C:0x20] = OTHER
    out[END] = SENTINEL
    return out


@dataclass
class Block:
    """rows: the row of each text; points: code points with a sentinel after each text; kinds: their classes."""

    rows: np.ndarray
    points: np.ndarray
    kinds: np.ndarray
    data: np.ndarray  # UTF-8 of the points, sentinels without bytes
    at: np.ndarray  # where each point's bytes begin; one more at the end

    @staticmethod
    def of(rows: list[int], texts: list[str]) -> Block:
        joined = "".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.empty(len(flat) + len(texts), np.uint32)
        stops = np.cumsum(lengths + 1) - 1
        inside = np.ones(len(points), bool)
        inside[stops] = False
        points[inside] = flat
        points[stops] = END
        wide = (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000) + 1
        wide[stops] = 0
        at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(wide, out=at[1:])
        # Sixteen zero bytes at the end: reads past a word stay inside the array.
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass") + bytes(64), np.uint8)
        return Block(np.asarray(rows, np.int64), points, classes()[points], data, at)

    def stops(self) -> np.ndarray:
        """The place of each text's sentinel."""
        return np.flatnonzero(self.points == END)


def _cuts(text: str, limit: int) -> Iterator[str]:
    """The text in parts of about limit characters, cut only before a space between two letters."""
    begin = 0
    while len(text) - begin > limit:
        m = regex.compile(r"(?<=\p{L}) (?=\p{L})").search(text, begin + limit)
        if m is None:
            break
        yield text[begin : m.start()]
        begin = m.start()
    yield text[begin:]


def blocks(column: pa.Array, limit: int = BLOCK_CHARS) -> Iterator[Block]:
    """The texts that are not null or empty, in order; a text may go on in the next block, under the same row."""
    rows, texts, size = [], [], 0
    for k, text in enumerate(column.to_pylist()):
        if not text:
            continue
        for part in _cuts(text, limit) if len(text) > limit else (text,):
            rows.append(k)
            texts.append(part)
            size += len(part)
            if size >= limit:
                yield Block.of(rows, texts)
                rows, texts, size = [], [], 0
    if rows:
        yield Block.of(rows, texts)


def pretokens(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, byte length, text within the block) of each pre-token of the public pattern, in order.

    Fixed values: contractions 's 't 're 've 'm 'll 'd; then a letter, number or other run with one space before it if
    there is one; of a white space run before anything else the last character stands alone unless it is that space.
    """
    kinds, points = b.kinds, b.points
    n = len(points)
    before = np.empty(n, np.uint8)
    before[0], before[1:] = SENTINEL, kinds[:-1]
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = SENTINEL, kinds[1:]
    blank = np.zeros(n, bool)
    blank[1:] = points[:-1] == 0x20
    space = kinds == SPACE
    run = (kinds != before) & ~space
    starts = run & ~blank
    starts |= space & ((before != SPACE) | ((after != SPACE) & (after != SENTINEL)))
    starts |= kinds == SENTINEL
    mark = np.flatnonzero((points == 0x27) & run & ~blank & (after == LETTER))
    if len(mark):
        pad = np.concatenate([points, np.full(3, END, np.uint32)])
        one, two = pad[mark + 1], pad[mark + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
        hit = short | pair
        end = mark + np.where(short, 2, 3)
        starts[mark[hit] + 1] = False
        end = end[hit]
        more = end[(end < n) & (kinds[np.minimum(end, n - 1)] == LETTER)]
        starts[more] = True
    first = np.flatnonzero(starts)
    length = np.diff(b.at[np.append(first, n)])
    text = np.cumsum(kinds[first] == SENTINEL)
    keep = kinds[first] != SENTINEL
    return b.at[first[keep]], length[keep], text[keep]
