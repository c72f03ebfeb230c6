"""Repair of text read from scanned pages: furniture out, broken words joined, misread words replaced.

Pass 1 counts, over all documents, words inside lines, hyphenated compounds and the looks of lines.  Words over a share
of all words are the lexicon, which is bounded in size whatever the input.  Pass 2 walks each document's lines, decides
furniture and breaks (``pages``), and hands on the words of content lines that the lexicon does not vouch for.  Distinct
suspects meet the lexicon in a join on character q-grams, the rarest of each word first; boosted trees rank the
candidates; suspects whose best candidate is likely are misread.  A suspect with a scanner's digit or sign between its
letters may be a name that no lexicon has, so what it says with letters there is one more candidate for the trees.

The trees learn from the lexicon itself: words damaged by the confusions of the fixed list are right to be replaced by
their original, undamaged words and words with other neighbours are not; invented names with a sign for a letter are
right to be read with letters, codes of letters and digits are not.  Line trees learn from at most ``SAMPLE_LINES`` lines
of ``SAMPLE_LINES`` / 40 documents; only their descriptions leave the workers.  Counts, the lexicon, candidates and decisions cover all documents and whole texts.

Null and blank texts have no lines and give no rows; an empty table gives none.  Repeated keys are separate documents
only if their rows differ; lines are numbered by line feeds, from 1.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.boost import Boosted
from paperloom.llm.canonical import edits
from paperloom.llm.pages import EDGE, EVIDENCE, MARKS, Joins, division, fit_joins, furniture_of, is_furniture, lines_of, prose, with_shapes
from paperloom.operators.skew import lookup, small
from paperloom.sources.tables import cut

#: A word or look is known from this share of all of its kind; so at most 1 / KNOWN are.
KNOWN = 1 / 200_000
LEAST_COUNT = 3
#: Lines that the furniture trees are fitted on at most, and words that the ranking is fitted on at most.
SAMPLE_LINES, SAMPLE_WORDS = 20_000, 1_500
#: A word this many times rarer than a neighbour by a scanner's confusion is not vouched for.
RARER = 20
COUNT_AT_ONCE = 300_000
ACCEPT = 0.5
#: Shared q-grams (bigrams of the padded word, without repeats) must be half of the longer word's but this many, and the
#: numbers of q-grams may differ by this much.
SLACK, LENGTHS = 4, 3

# Characters that scanners take for others, seen and meant.
CONFUSED = [
    ("0", "o"), ("1", "i"), ("1", "l"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"), ("@", "a"), ("+", "t"), ("|", "l"), ("$", "s"), ("rn", "m"), ("m", "rn"), ("ni", "m"),
    ("c", "e"), ("e", "c"), ("cl", "d"), ("d", "cl"), ("ii", "u"), ("u", "ii"), ("li", "h"), ("h", "li"), ("b", "h"), ("h", "b"), ("q", "g"), ("g", "q"), ("vv", "w"), ("w", "vv"),
    ("i", "l"), ("l", "i"), ("f", "t"), ("t", "f"), ("n", "u"), ("u", "n"), ("o", "c"), ("c", "o"), ("a", "o"), ("o", "a"), ("s", "5"), ("nn", "m"), ("tn", "m"), ("ri", "n"), ("fi", "h"),
]
SIGN = re.compile(r"(?<=[^\W\d_])(?:[01568@+|$]{1,2})(?=[^\W\d_])")


def clean(token: str) -> str:
    return token.strip(EDGE).lower()


def usable(text: str) -> Iterator[list[str]]:
    """The tokens of lines, without the parts of words that stand at their ends."""
    cut_before = False
    for line in text.split("\n"):
        tokens = line.split()
        if not tokens:
            continue
        cut_after = tokens[-1][-1] in MARKS and division(line) is not None
        yield tokens[int(cut_before) : len(tokens) - int(cut_after)] if cut_before or cut_after else tokens
        cut_before = cut_after


def _tally(tokens: Counter[str]) -> tuple[Counter[str], Counter[str]]:
    """Words and compounds of raw tokens."""
    words: Counter[str] = Counter()
    compounds: Counter[str] = Counter()
    for token, n in tokens.items():
        w = clean(token)
        if w.isalpha():
            words[w] += n
        elif "-" in w and all(p.isalpha() for p in w.split("-")):
            parts = w.split("-")
            for p in parts:
                words[p] += n
            for a, b in zip(parts, parts[1:]):
                compounds[f"{a}-{b}"] += n
    return words, compounds


def corpus_counts(df: DataFrame) -> DataFrame:
    """(kind, name, n): words and compounds over all texts; df: text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            words, compounds = _tally(tokens)
            names = list(words) + list(compounds)
            kinds = ["word"] * len(words) + ["compound"] * len(compounds)
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(names, pa.string()), pa.array([*words.values(), *compounds.values()], pa.int64())], ["kind", "name", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for line in usable(text):
                    tokens.update(line)
                if len(tokens) > COUNT_AT_ONCE:
                    yield out()
                    tokens.clear()
        if tokens:
            yield out()

    return df.mapInArrow(run, "kind string, name string, n bigint").groupBy("kind", "name").agg(F.sum("n").alias("n"))


def meant(word: str) -> set[str]:
    """What the word may have been before one confusion."""
    out = set()
    for seen, real in CONFUSED:
        at = word.find(seen)
        while at >= 0:
            out.add(word[:at] + real + word[at + len(seen) :])
            at = word.find(seen, at + 1)
    return out


def vouched(words: dict[str, int]) -> frozenset[str]:
    """The known words that are not a confusion away from one that is many times more frequent."""
    return frozenset(w for w, n in words.items() if not any(words.get(v, 0) >= RARER * n for v in meant(w)))


class Known:
    """What the corpus vouches for: words with counts, compounds, looks of lines, and the trees for lines."""

    def __init__(self, words: dict[str, int], compounds: dict[str, int]):
        self.words, self.compounds = words, compounds
        self.trusted = vouched(words)
        self.shapes: dict[str, tuple[int, int]] = {}
        self.lines = Boosted()
        self.joins: Joins = fit_joins(words, compounds, SAMPLE_WORDS, Boosted(rounds=40))


def count_shapes(df: DataFrame, held) -> DataFrame:
    """(shape, yes, no): how many lines of each look recur in their document and how many do not, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        yes: Counter[str] = Counter()
        no: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            names = list(yes | no)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([yes[k] for k in names], pa.int64()), pa.array([no[k] for k in names], pa.int64())], ["shape", "yes", "no"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for x in lines_of(text, known.trusted, rows=False):
                    if x.candidate:
                        (yes if x.vote else no)[x.shape] += 1
                if len(yes) + len(no) > COUNT_AT_ONCE:
                    yield out()
                    yes.clear(), no.clear()
        if yes or no:
            yield out()

    return df.mapInArrow(run, "shape string, yes bigint, no bigint").groupBy("shape").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))


def learn(df: DataFrame) -> Known:
    """Counts all texts and fits the line trees; df: key, text."""
    spark = df.sparkSession
    counts = cut(corpus_counts(df.select("text")))
    totals = {r[0]: int(r[1]) for r in counts.groupBy("kind").agg(F.sum("n")).collect()}
    tables = {}
    for kind in ("word", "compound"):
        least = max(LEAST_COUNT, int(totals.get(kind, 0) * KNOWN) + 1)
        got = counts.filter((F.col("kind") == kind) & (F.col("n") >= least)).select("name", "n").toArrow()
        tables[kind] = dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist()))
    known = Known(tables["word"], tables["compound"])
    held = spark.sparkContext.broadcast(known)
    shapes = cut(count_shapes(df.select("text"), held))
    total = shapes.agg(F.sum(F.col("yes") + F.col("no"))).first()[0] or 0
    got = shapes.filter(F.col("yes") + F.col("no") >= max(2, int(total * KNOWN) + 1)).toArrow()
    known.shapes = {s: (y, n) for s, y, n in zip(*(c.to_pylist() for c in got.columns))}
    x, y = line_cases(df, known)
    known.lines = Boosted(rounds=40).fit(x, y) if len(y) else Boosted()
    return known


def line_cases(df: DataFrame, known: Known) -> tuple[np.ndarray, np.ndarray]:
    """Descriptions and labels of the lines that a rule is sure of, of a bounded sample of documents in a hash's order."""
    held = df.sparkSession.sparkContext.broadcast((known.trusted, known.shapes))
    chosen = df.select("key").orderBy(F.xxhash64("key"), "key").limit(SAMPLE_LINES // 40).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trusted, shapes = held.value
        for batch in batches:
            for order, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = [line for line in lines_of(text, trusted, every=True) if line.sure is not None][:SAMPLE_LINES]
                if lines:
                    rows = with_shapes(lines, shapes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([order] * len(lines), pa.int64()), pa.array([x.number for x in lines], pa.int32()), pa.array(rows.tolist(), pa.list_(pa.float64())), pa.array([x.sure for x in lines], pa.int32())], ["at", "line", "row", "label"]
                    )

    cases = df.join(F.broadcast(chosen), "key", "left_semi").select(F.xxhash64("key").alias("at"), "text").mapInArrow(run, "at bigint, line int, row array<double>, label int")
    got = cases.orderBy("at", "line").limit(SAMPLE_LINES).select("row", "label").toArrow()
    x, y = np.array(got.column(0).to_pylist()), np.array(got.column(1).to_pylist())
    if len(y):
        # Most are shown without what made them certain, so that the trees learn to do without.
        blank = np.random.default_rng(0).random(len(y)) < 0.7
        x[np.ix_(blank, EVIDENCE)] = [0, 0, 1, 0, 0, 0]
    return x, y


#: Suspects of raw tokens seen before, per process; a cache, not a result.
_seen: dict[str, tuple] = {}


def suspects_of(tokens: list[str], known: Known) -> list[tuple[str, bool]]:
    """(word, whether a sign stands for a letter in it) of the words of a line that are not vouched for."""
    out = []
    for token in tokens:
        found = _seen.get(token)
        if found is None:
            found = tuple(_suspects(token, known))
            if len(_seen) > 400_000:
                _seen.clear()
            _seen[token] = found
        if found:
            out += found
    return out


def _suspects(token: str, known: Known) -> Iterator[tuple[str, bool]]:
    w = clean(token)
    if not w or w in known.trusted:
        return
    for p, q in zip(re.split(r"[-‐/]", w), re.split(r"[-‐/]", token.strip(EDGE))):
        p, q = p.strip(EDGE), q.strip(EDGE)
        if len(p) < 2 or p in known.trusted or not any(c.isalpha() for c in p):
            continue
        letters = sum(c.isalpha() for c in p)
        plain = any(c.islower() for c in q) or letters >= 4 and len(p) - letters == 1 and SIGN.search(p)
        if letters < len(p) and (letters < 2 or letters < 0.6 * len(p) or not plain):
            continue  # codes and measures
        if any(not c.isalnum() and c not in "@+|$'’" for c in p):
            continue
        yield p, letters >= 4 and SIGN.search(p) is not None and not re.search(r"\d{3}", p)


def line_faults(df: DataFrame, held) -> DataFrame:
    """(key, lineno, fault, word): furniture and broken lines, and suspects of content lines.

    word: the suspect, whether a sign stands in it for a letter, and of a parted one how long its left part is and the
    line of its right part.
    """
    kind = df.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        _seen.clear()
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                at, number, fault, word = [], [], [], []

                def say(k: int, line: int, what: str, w: str | None = None) -> None:
                    at.append(k), number.append(line), fault.append(what), word.append(w)

                described = [lines_of(text, known.trusted) for text in part.column(1).to_pylist()]
                for k, (lines, furniture) in enumerate(zip(described, furniture_of(described, known.shapes, known.lines))):
                    content = [x for x, f in zip(lines, furniture) if not f]
                    for x, f in zip(lines, furniture):
                        if f:
                            say(k, x.number, "furniture")
                    carried = False
                    for i, x in enumerate(content):
                        tokens = x.text.split()
                        if carried:
                            tokens = tokens[1:]
                        carried = False
                        if x.text[-1] in MARKS and i + 1 < len(content) and (d := division(x.raw)) is not None:
                            right, at_right = content[i + 1].text.split()[0], content[i + 1].number
                            if known.joins.breaks(d[0], d[1], right, known.words, known.compounds):
                                say(k, x.number, "broken")
                                carried = True
                                # What stands before the parted word on the line, and the two parts as one word; a fault
                                # of that is on the line whose part holds it, see blame().
                                tokens = x.text.rstrip(MARKS + " ").split()[int(bool(tokens) and tokens[0] != x.text.split()[0]) : -1]
                                left = d[0].rsplit("-", 1)[-1].strip(EDGE).lower()
                                for w, sign in suspects_of([d[0] + right], known):
                                    say(k, x.number, "suspect", f"{w} {int(sign)} {len(left)} {at_right}")
                        for w, sign in suspects_of(tokens, known):
                            say(k, x.number, "suspect", f"{w} {int(sign)}")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()), pa.array(fault, pa.string()), pa.array(word, pa.string())], ["key", "lineno", "fault", "word"]
                )

    return df.select("key", "text").mapInArrow(run, f"key {kind}, lineno int, fault string, word string")


def grams(word: str) -> set[str]:
    """Character bigrams of the padded word, without repeats."""
    padded = f"^{word}$"
    return {padded[i : i + 2] for i in range(len(padded) - 1)}


def enough(n: int, m: int) -> int:
    """Shared q-grams that words of n and of m must have; a word damaged by one or two confusions keeps as many."""
    return max(1, -(-(max(n, m) - SLACK) // 2))


class Ranks:
    """The q-grams of the lexicon, the rarest first; so each word is listed under few, and these select.

    Two words share the needed number of q-grams only if they share one of the first ones of each, in one order of all
    q-grams; those that the lexicon lacks come first.
    """

    def __init__(self, names: list[str]):
        held = Counter(g for w in names for g in grams(w))
        self.place = {g: k for k, (g, _) in enumerate(sorted(held.items(), key=lambda x: (x[1], x[0])), 1)}
        self.longest = max((len(w) for w in names), default=0)

    def first(self, word: str) -> tuple[int, list[str]]:
        """(number of q-grams, those under which the word is listed)."""
        mine = sorted(grams(word), key=lambda g: (self.place.get(g, 0), g))
        return len(mine), mine[: len(mine) - enough(len(mine), len(mine)) + 1]


def candidates(words: DataFrame, names: list[str]) -> DataFrame:
    """(word, near): all of the names that share enough q-grams with each word, by a join of inverted lists.

    names: the lexicon, bounded by its share of all words.  Words that share too few, or differ too much in length, have
    none and give no row; so words longer than any name by more than that are not looked up.
    """
    spark = words.sparkSession
    ranks = Ranks(names)
    held = spark.sparkContext.broadcast(ranks)
    lexicon = spark.createDataFrame([(w, n, g) for w in names for n, listed in [ranks.first(w)] for g in listed], "name string, m int, gram string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(w, n, g) for w in batch.column(0).to_pylist() for n, listed in [held.value.first(w)] for g in listed]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.string())], ["word", "n", "gram"])

    # Repeated bigrams make a long word of few, so its length is bounded by the number of q-grams only from below.
    seen = words.select("word").mapInArrow(run, "word string, n int, gram string")
    pairs = seen.join(small(lexicon), "gram").filter(F.abs(F.col("n") - F.col("m")) <= LENGTHS).select("word", "name").distinct()
    return pairs.groupBy("word").agg(F.sort_array(F.collect_list("name")).alias("near"))


def path_of(seen: str, real: str) -> tuple[int, int]:
    """(confusions of the fixed list, other edits) that make the seen word of the real one, by fewest in all."""
    n, m = len(seen), len(real)
    far = 99
    best = [[(far, far)] * (m + 1) for _ in range(n + 1)]
    best[0][0] = (0, 0)
    weigh = lambda p: p[0] * 0.6 + p[1]
    for i in range(n + 1):
        for j in range(m + 1):
            here = best[i][j]
            if here[0] >= far or weigh(here) > 3:
                continue
            steps = []
            if i < n and j < m:
                steps.append((i + 1, j + 1, here if seen[i] == real[j] else (here[0], here[1] + 1)))
            if i < n:
                steps.append((i + 1, j, (here[0], here[1] + 1)))
            if j < m:
                steps.append((i, j + 1, (here[0], here[1] + 1)))
            for a, b in CONFUSED_BY.get(seen[i : i + 1], ()):
                if seen.startswith(a, i) and real.startswith(b, j):
                    steps.append((i + len(a), j + len(b), (here[0] + 1, here[1])))
            for x, y, p in steps:
                if weigh(p) < weigh(best[x][y]):
                    best[x][y] = p
    return best[n][m]


CONFUSED_BY: dict[str, list[tuple[str, str]]] = {}
for _pair in CONFUSED:
    CONFUSED_BY.setdefault(_pair[0][0], []).append(_pair)


def describe(word: str, own: int, near: str, count: int) -> list[float]:
    by_list, other = path_of(word, near)
    return [
        by_list, other, len(word), len(near) - len(word), np.log1p(count), np.log1p(own), np.log1p(count) - np.log1p(own),
        float(word[0] == near[0]), float(word[-1] == near[-1]), float(not word.isalpha()), (by_list + other) / max(len(word), 1), sum(not c.isalpha() for c in word) / max(len(word), 1),
    ]


# The letter that each sign is most often taken for.
LETTER_OF = str.maketrans({"0": "o", "1": "l", "5": "s", "6": "b", "8": "b", "@": "a", "+": "t", "|": "l", "$": "s"})


def lettered(word: str) -> str:
    """The word with letters where signs stand between letters."""
    return SIGN.sub(lambda m: m[0].translate(LETTER_OF), word)


def fit_ranking(words: dict[str, int], trusted: frozenset[str]) -> Boosted:
    """Trees that tell a damaged word's original from a word's mere neighbour."""
    rng = np.random.default_rng(0)
    names = sorted((w for w in trusted if len(w) >= 3), key=lambda w: (-words[w], w))[:SAMPLE_WORDS]
    by_length: dict[int, list[str]] = {}
    for w in names:
        by_length.setdefault(len(w), []).append(w)
    rows, labels = [], []
    for w in names:
        damaged = [(a, b, m.start()) for b, a in ((r, s) for s, r in CONFUSED) for m in re.finditer(re.escape(b), w)]
        rng.shuffle(damaged)
        for a, b, at in damaged[:3]:
            seen = w[:at] + a + w[at + len(b) :]
            if seen not in words:
                own = int(rng.integers(1, 4))
                rows.append(describe(seen, own, w, words[w]))
                labels.append(1)
                for v in by_length.get(len(seen), [])[:60]:
                    if v != w and edits(seen, v, 2) <= 2:
                        rows.append(describe(seen, own, v, words[v]))
                        labels.append(0)
        # The word itself, as if it were rare, beside its neighbours: nothing is wrong with it.
        for v in [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, [])[:200]]:
            if v != w and edits(w, v, 2) <= 2:
                rows.append(describe(w, int(rng.integers(1, 4)), v, words[v]))
                labels.append(0)
        # An invented name: the word with strange letters.
        if len(w) >= 5:
            k = int(rng.integers(2))
            spots = rng.choice(len(w), 2, replace=False)
            name = "".join(chr(97 + int(rng.integers(26))) if i in spots[: k + 1] else c for i, c in enumerate(w))
            if name not in words and path_of(name, w)[1] > 0:
                rows.append(describe(name, 1, w, words[w]))
                labels.append(0)
            # The name with a sign for one of its inner letters, and a code: letters, digits, letters.
            at = int(rng.integers(1, len(name) - 1))
            sign = [s for s, r in CONFUSED if r == name[at] and not s[0].isalpha()]
            if sign:
                seen = name[:at] + sign[int(rng.integers(len(sign)))] + name[at + 1 :]
                rows.append(describe(seen, 1, lettered(seen), 0))
                labels.append(1)
            code = "".join("bcdfgxz"[int(rng.integers(7))] for _ in range(3)) + "".join("01568"[int(rng.integers(5))] for _ in range(int(rng.integers(2, 4)))) + "xk"[int(rng.integers(2))]
            rows.append(describe(code, 1, lettered(code), 0))
            labels.append(0)
    return Boosted(rounds=60).fit(np.array(rows), np.array(labels)) if rows else Boosted()


def corrections(suspects: DataFrame, known: Known) -> DataFrame:
    """(word, replacement, score): suspects whose best candidate is likely; suspects: word, n, sign, distinct."""
    spark = suspects.sparkSession
    names = [w for w in sorted(known.trusted) if len(w) >= 2]
    held = spark.sparkContext.broadcast(({w: known.words[w] for w in known.trusted}, fit_ranking(known.words, known.trusted)))
    # A suspect is a few bytes but meets many candidates, so they are spread by number and not by size.
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    reach = suspects.filter(F.length("word") <= max(map(len, names), default=0) + LENGTHS)
    met = suspects.join(candidates(reach.select("word").repartition(width, "word"), names), "word", "left").filter(F.col("near").isNotNull() | F.col("sign"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, model = held.value
        for whole in batches:
            for begin in range(0, whole.num_rows, 200):
                batch = whole.slice(begin, 200)
                rows, which = [], []
                for word, near, n, sign in zip(*(c.to_pylist() for c in batch.columns)):
                    mine = grams(word)
                    # All near ones are described; of equals the fewest edits and then the most frequent comes first.
                    close = []
                    for v in near or ():
                        if abs(len(v) - len(word)) <= 2 and counts[v] >= 2 * n:
                            theirs = grams(v)
                            if len(mine & theirs) >= enough(len(mine), len(theirs)):
                                close.append((edits(word, v, 3), -counts[v], v))
                    for far, _, v in sorted(close):
                        if far <= 3:
                            rows.append(describe(word, n, v, counts[v]))
                            which.append((word, v))
                    if sign:
                        v = lettered(word)
                        if v not in counts:
                            rows.append(describe(word, 1, v, 0))
                            which.append((word, v))
                score = model.probability(np.array(rows)) if rows else np.zeros(0)
                best: dict[str, tuple[float, str]] = {}
                for (word, v), p in zip(which, score.tolist()):
                    if p > best.get(word, (ACCEPT, ""))[0]:
                        best[word] = (p, v)
                yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.string()), pa.array([v for _, v in best.values()], pa.string()), pa.array([p for p, _ in best.values()], pa.float64())], ["word", "replacement", "score"])

    return met.select("word", "near", "n", "sign").mapInArrow(run, "word string, replacement string, score double")


def blame():
    """The line of a misread word: for a joined one the line of the part in which it differs from what was meant."""
    short = F.least(F.length("word"), F.length("replacement"))
    differs = F.coalesce(
        F.array_min(F.filter(F.sequence(F.lit(1), F.greatest(short, F.lit(1))), lambda k: F.substring("word", k, F.lit(1)) != F.substring("replacement", k, F.lit(1)))), short
    )
    return F.when(F.col("nextline").isNotNull() & (differs > F.col("left")), F.col("nextline")).otherwise(F.col("lineno"))


def scan_faults(df: DataFrame, known: Known | None = None) -> tuple[DataFrame, DataFrame]:
    """((key, lineno, fault) of every faulty line, (key, lineno, word, replacement) of misread words); df: key, text."""
    texts = df.filter(F.trim("text") != "").select("key", "text")
    known = known or learn(texts)
    held = texts.sparkSession.sparkContext.broadcast(known)
    seen = cut(line_faults(texts, held))
    open_ = seen.filter(F.col("fault") == "suspect").withColumn("bits", F.split("word", " "))
    bit = lambda k: F.try_element_at("bits", F.lit(k)).cast("int")
    open_ = open_.select("key", "lineno", F.col("bits")[0].alias("word"), (bit(2) == 1).alias("sign"), bit(3).alias("left"), bit(4).alias("nextline"))
    rows = open_.count()
    fixes = cut(corrections(cut(open_.groupBy("word").agg(F.count("*").alias("n"), F.max("sign").alias("sign"))), known))
    wrong = lookup(open_, fixes.select("word", "replacement"), ["word"], rows).filter(F.col("replacement").isNotNull())
    wrong = wrong.select("key", blame().alias("lineno"), "word", "replacement")
    sure = seen.filter(F.col("fault") != "suspect").select("key", "lineno", "fault")
    return sure.unionByName(wrong.select("key", "lineno", F.lit("misread").alias("fault"))).distinct(), wrong


def mended(text: str, known: Known, fixes: dict[str, str]) -> str:
    """Continuous paragraphs: no furniture, broken words whole, misread words replaced; one empty line between them."""
    lines = lines_of(text, known.trusted)
    content = [x for x, f in zip(lines, is_furniture(lines, known.shapes, known.lines)) if not f]
    paragraphs: list[str] = []
    carried = ""
    for i, x in enumerate(content):
        words = x.text.split()
        if carried:
            words[0], carried = carried + words[0], ""
        d = division(x.raw)
        if d is not None and i + 1 < len(content):
            right = content[i + 1].text.split()[0]
            if known.joins.breaks(d[0], d[1], right, known.words, known.compounds):
                carried = words.pop().rstrip(MARKS + " ")
                if carried == "" and words:
                    carried = words.pop()
            elif words[-1][-1:] in MARKS:
                carried = words.pop()
        out = " ".join(_replaced(w, fixes) for w in words)
        before = content[i - 1] if i else None
        ended = before is not None and before.text[-1] in ".:!?;"
        form = before is not None and not prose(x.text) and not prose(before.text) and before.text[-1] not in "-," and not x.text[:1].islower()
        fresh = before is None or x.title or before.title or ended and (before.gap or x.raw[:1].isspace()) or form and (ended or x.text[-1] != ".")
        if fresh or not paragraphs:
            paragraphs.append(out)
        elif out:
            paragraphs[-1] = f"{paragraphs[-1]} {out}".strip()
    return "\n\n".join(p for p in paragraphs if p)


def _replaced(token: str, fixes: dict[str, str]) -> str:
    core = token.strip(EDGE)
    new = fixes.get(core.lower())
    if new is None or not core:
        return token
    new = new.upper() if core.isupper() and len(core) > 1 else new.capitalize() if core[0].isupper() else new
    return token.replace(core, new, 1)


def repaired(df: DataFrame) -> DataFrame:
    """(key, text): each scanned text as paragraphs; a text without content becomes the empty string; df: key, text."""
    texts = df.filter(F.trim("text") != "").select("key", "text")
    known = learn(texts)
    held = texts.sparkSession.sparkContext.broadcast(known)
    _, wrong = scan_faults(df, known)
    fixes = wrong.select("key", "word", "replacement").distinct().groupBy("key").agg(F.collect_list("word").alias("seen"), F.collect_list("replacement").alias("meant"))
    kind = texts.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [mended(t, held.value, dict(zip(a or [], b or []))) for t, a, b in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["key", "text"])

    return texts.join(fixes, "key", "left").select("key", "text", "seen", "meant").mapInArrow(run, f"key {kind}, text string")
