"""Freely typed names mapped to a short canonical list, with the rest reported.

Values are divided into parts, the parts normalised and deduplicated over the whole cluster.  Candidates of each
distinct part come from an inverted index of weighted character trigrams over the list's phrases, and are scored by
weighted cosine (idf weights; trigrams that no phrase has weigh nothing, so what stands around a name does not hide it).
A phrase over the threshold of cosine must also pass a check: every word of it must be met by words of the part, exactly,
misspelt, cut short, run together or torn apart, at a total cost under a limit.  Of the entries that pass, the one of the
highest cosine is accepted if its lead on the next is over the margin; within the margin the cheaper alignment decides,
and if these lie together too, the part stands for nothing.  A bare acronym counts as its phrase, with the cosine 1, if
little else stands beside it.

The list is a few hundred phrases, checked against ``MOST_PHRASES``; its index is broadcast.  Null, blank and symbol-only
values map to nothing; very long ones are read whole; ties between two entries map to nothing.  An empty list maps
nothing.  Repeated rows each get their row.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.operators.skew import lookup
from paperloom.sources.tables import cut

#: Phrases of a list that is broadcast to all workers; a longer list is refused, as it needs another index.
MOST_PHRASES = 100_000
#: Least cosine that is accepted, and least lead in cosine on the next other entry.
COSINE, LEAD = 0.3, 0.15
#: Most that the check of words may cost, an edit of a character costing 1; least lead in cost where cosines lie together.
MOST_COST, MARGIN = 3.3, 0.5
# Characters that scanners take for letters.
SWAPPED = str.maketrans("0158", "oisb")
# Words that may stand beside a bare acronym.
BESIDE = frozenset("the our new a an of for on no form final scan signed copy draft rev p see per old".split())


def part_key(value):
    """A part as it is deduplicated: invisible characters out, camel case spaced, lower case, white space single."""
    c = F.regexp_replace(value, r"[\p{Cf}\p{Cc}&&[^\t\n\r\x0b\x0c]]+", "")
    c = F.regexp_replace(c, r"(?<=\p{Ll}\p{Ll})(?=\p{Lu}\p{Ll})", " ")
    return F.trim(F.regexp_replace(F.lower(c), r"[\s\p{Z}\x1c-\x1f\u0085_]+", " "))


def plain(text: str) -> str:
    """ASCII letters where there are such; the rest as it is."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def tokens(text: str) -> list[tuple[str, bool]]:
    """Runs of letters and digits, and whether a full stop follows."""
    return [(m[1], m[2] == ".") for m in re.finditer(r"([^\W_]+)(\.?)", plain(text.lower()))]


@lru_cache(maxsize=1 << 18)
def edits(a: str, b: str, most: int = 2) -> int:
    """Insertions, deletions, changes and swaps of neighbours between two words; most + 1 if there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    # What both begin and end with costs nothing.
    k, least = 0, min(len(a), len(b))
    while k < least and a[k] == b[k]:
        k += 1
    end = 0
    while end < least - k and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[k : len(a) - end], b[k : len(b) - end]
    # Only cells within the limit of the diagonal can be within the limit.
    far = most + 1
    two, one = [], [min(j, far) for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        low, high = max(1, i - most), min(len(b), i + most)
        row = [far] * (len(b) + 1)
        row[0] = min(i, far)
        for j in range(low, high + 1):
            y = b[j - 1]
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row[j] = d
        if min(row) > most:
            return far
        two, one = one, row
    return min(one[-1], far)


@lru_cache(maxsize=1 << 18)
def cost(seen: str, dotted: bool, word: str) -> float:
    """What it costs to take what is seen for the word; 9 if it cannot be."""
    if seen == word:
        return 0.0
    if seen in (word + "s", word + "es"):
        return 0.1
    best = 9.0
    swapped = seen.translate(SWAPPED) if re.search(r"\d", seen) and re.search(r"[a-z]", seen) else seen
    if len(seen) < len(word) and word.startswith((seen, swapped)) and len(seen) >= (3 if dotted or len(word) > 5 else 4):
        best = (0.2 if dotted else 0.3 if len(seen) > 3 else 0.4) + 0.2 * (seen != swapped)
    if len(word) >= 3:
        limit = 3 if len(word) >= 9 else 2 if len(word) >= 6 else 1
        for form, extra in ((seen, 0.0), (swapped, 0.2)):
            for end in (word, word + "s"):
                n = edits(form, end, limit)
                if n <= limit:
                    best = min(best, n + extra + 0.1 * (end != word))
    if dotted and best > 2 and 3 <= len(seen) < len(word):
        # A misspelt abbreviation: one edit from the word's beginning.
        if any(edits(seen, word[:k], 1) <= 1 for k in range(max(len(seen) - 1, 3), len(seen) + 2)) and len(seen) > 3:
            best = 1.3
    return best


def align(words: tuple[str, ...], seen: list[tuple[str, bool]], most: float) -> tuple[float, frozenset[int]]:
    """Least total cost of meeting all words by disjoint runs of one or two of what is seen, and the places used."""
    spans = [(t, dot, frozenset((i,))) for i, (t, dot) in enumerate(seen)]
    spans += [(seen[i][0] + seen[i + 1][0], seen[i + 1][1], frozenset((i, i + 1))) for i in range(len(seen) - 1)]
    best: tuple[float, frozenset[int]] = (9.0, frozenset())

    def go(k: int, used: frozenset[int], sum_: float) -> None:
        nonlocal best
        if sum_ >= best[0] or sum_ > most:
            return
        if k == len(words):
            best = (sum_, used)
            return
        for n in range(1, len(words) - k + 1):
            word = words[k] if n == 1 else "".join(words[k : k + n])
            for text, dot, places in spans:
                if places & used:
                    continue
                c = cost(text, dot, word) + 0.1 * (len(places) - 1) + 0.1 * (n - 1)
                # Words run together stand in one run of letters, and an edit too many would hide another word.
                if n > 1 and (len(places) > 1 or len(text) < 0.8 * len(word) or c >= 2.5):
                    continue
                if c < 9:
                    go(k + n, used | places, sum_ + c)

    go(0, frozenset(), 0.0)
    return best


def grams(text: str) -> list[str]:
    padded = f"  {' '.join(t for t, _ in tokens(text))} "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


class Index:
    """The list's phrases: trigram weights, words, and which entry each stands for."""

    def __init__(self, phrases: list[tuple[str, str]]):
        """phrases: (phrase, entry)."""
        self.entries = sorted({e for _, e in phrases})
        number = {e: k for k, e in enumerate(self.entries)}
        words: dict[tuple[str, ...], set[int]] = defaultdict(set)
        self.acronyms: dict[str, set[int]] = defaultdict(set)
        for phrase, entry in phrases:
            short = re.findall(r"\(([A-Z]{2,6})\)", phrase)
            for a in [*short, *([phrase.strip()] if re.fullmatch(r"[A-Z]{2,6}", phrase.strip()) else [])]:
                self.acronyms[a.lower()].add(number[entry])
            full = tuple(t for t, _ in tokens(re.sub(r"\([A-Z]{2,6}\)", " ", phrase)))
            if full and not re.fullmatch(r"[A-Z]{2,6}", phrase.strip()):
                words[full].add(number[entry])
        self.words = list(words)
        self.stands = [words[w] for w in self.words]
        found = [grams(" ".join(w)) for w in self.words]
        names = sorted({g for f in found for g in f})
        self.at = {g: k for k, g in enumerate(names)}
        df = np.zeros(len(names))
        for f in found:
            for g in set(f):
                df[self.at[g]] += 1
        self.idf = np.log(1 + len(found) / np.maximum(df, 1)).astype(np.float32)
        self.unseen = float(np.log(1 + len(found))) if found else 0.0
        # Inverted lists, end to end: of each trigram the phrases that have it, and its share of the phrase's length.
        cells = [Counter(self.at[g] for g in f) for f in found]
        length = np.array([np.sqrt(sum((n * self.idf[g]) ** 2 for g, n in c.items())) for c in cells] or [1.0])
        entries = sorted((g, k, n * self.idf[g] / max(length[k], 1e-9)) for k, c in enumerate(cells) for g, n in c.items())
        self.begin = np.searchsorted([e[0] for e in entries], np.arange(len(names) + 1))
        self.phrase = np.array([e[1] for e in entries], np.int32)
        self.weight = np.array([e[2] for e in entries], np.float32)

    def candidates(self, parts: list[str]) -> Iterator[list[tuple[int, float]]]:
        """For each part the phrases of a cosine over the limit and that cosine, best first."""
        for part in parts:
            times = Counter(k for k in map(self.at.get, grams(part)) if k is not None)
            if not times:
                yield []
                continue
            mine = [(g, n * float(self.idf[g])) for g, n in times.items()]
            lists = [slice(self.begin[g], self.begin[g + 1]) for g, _ in mine]
            where = np.concatenate([self.phrase[x] for x in lists])
            what = np.concatenate([self.weight[x] * w for x, (_, w) in zip(lists, mine)])
            score = np.bincount(where, weights=what, minlength=len(self.words)) / np.sqrt(sum(w * w for _, w in mine))
            top = np.flatnonzero(score >= COSINE)
            yield [(int(k), float(score[k])) for k in top[np.argsort(-score[top], kind="stable")]]

    def match(self, part: str, candidates: list[tuple[int, float]]) -> tuple[str | None, float]:
        """(entry, cosine) that the part stands for."""
        seen = tokens(part)
        if not seen:
            return None, 0.0
        #: Entry -> best cosine and least cost of its phrases that pass the check.
        passed: dict[int, tuple[float, float]] = {}

        def take(entry: int, cosine: float, cost_: float) -> None:
            was = passed.get(entry, (0.0, 9.0))
            passed[entry] = (max(was[0], cosine), min(was[1], cost_))

        for k, cosine in candidates:
            c, _ = align(self.words[k], seen, MOST_COST)
            if c <= MOST_COST:
                for e in self.stands[k]:
                    take(e, cosine, c)
        short = {e for t, _ in seen for e in self.acronyms.get(t, ())}
        for e in short:
            mine = {w for k, s in enumerate(self.stands) if e in s for w in self.words[k]}
            rest = [t for t, dot in seen if e not in self.acronyms.get(t, ()) and t.translate(SWAPPED) not in BESIDE and t not in BESIDE and not t.isdigit() and min((cost(t, dot, w) for w in mine), default=9) > 2]
            if not rest:
                take(e, 1.0, 0.0 if len(seen) == 1 else 0.3)
        if not passed:
            return None, 0.0
        first, *others = sorted(passed.items(), key=lambda x: (-x[1][0], x[1][1], x[0]))
        # Those within the margin of the best cosine are told apart by the words.
        near = sorted([first, *(o for o in others if first[1][0] - o[1][0] < LEAD)], key=lambda x: (x[1][1], x[0]))
        if len(near) > 1 and near[1][1][1] - near[0][1][1] < MARGIN:
            return None, 0.0
        return self.entries[near[0][0]], near[0][1][0]


def map_parts(parts: DataFrame, phrases: list[tuple[str, str]]) -> DataFrame:
    """(part, entry, cosine): the distinct parts that stand for an entry."""
    if len(phrases) > MOST_PHRASES:
        raise ValueError(f"a list of {len(phrases)} phrases is too long to broadcast")
    held = parts.sparkSession.sparkContext.broadcast(Index(phrases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            texts = batch.column(0).to_pylist()
            rows = [(t, *index.match(t, c)) for t, c in zip(texts, index.candidates(texts))]
            rows = [r for r in rows if r[1] is not None]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.float64())], ["part", "entry", "cosine"])

    return parts.mapInArrow(run, "part string, entry string, cosine double")


def map_values(values: DataFrame, keys: list[str], phrases: list[tuple[str, str]], rows: int) -> DataFrame:
    """keys and ``entry``: the rows whose value stands for exactly one entry.

    values: keys and ``value``; the keys are unique.  rows: the number of rows, or more.
    """
    exploded = values.filter(F.col("value").isNotNull()).select(*keys, F.explode(F.array_distinct(F.split("value", "[;|/]"))).alias("raw"))
    exploded = exploded.select(*keys, part_key(F.col("raw")).alias("part")).filter(F.col("part").rlike(r"[\p{L}]{2}"))
    # Most parts are the same few sites, annexes and numbers; one row of each is matched.
    parts = exploded.select("part").distinct()
    # A part is a few bytes and costs a millisecond: by size alone they would all go to one or two tasks, and a
    # repartition by the part itself is taken for the one that the distinct has made.  Kept, as both ways of the join
    # below read the result.
    width = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = cut(map_parts(parts.repartition(width, F.xxhash64("part")), phrases))
    joined = lookup(exploded, found.select("part", "entry"), ["part"], rows).filter(F.col("entry").isNotNull())
    return joined.groupBy(*keys).agg(F.min("entry").alias("entry"), F.max("entry").alias("_other")).filter("entry = _other").drop("_other")
