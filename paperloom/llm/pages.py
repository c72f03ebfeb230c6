"""Lines of scanned pages: running headers, footers and page numbers; words broken at line ends.

A document's lines are described by what surrounds them: whether text goes on across them, how they repeat in the
document, how they look with numbers and unknown words masked, and how such a look fares in the whole corpus.  Rules
only label the cases to learn from (a page number in a place for one; a line that recurs, page after page; a title, a
number after a colon, a list); a boosted classifier learns from them, most of them shown without what made them certain,
and decides every line that can be furniture at all.

A word is broken when a content line ends in a division mark after a letter and the next content line goes on with the
rest: the two parts together are a known word, or the mark is one that only divides, or the parts are no words and no
known compound stands with that hyphen elsewhere.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

from paperloom.llm.canonical import edits

# Marks at a line end that may divide a word; those in SURE never belong to a compound.
MARKS, SURE = "-‐¬­", "¬­"
# Words for page and of in the languages of the corpus, and roman numerals.
PAGE_WORD = r"(?:page|seite|blatt|folio|p[áa]gina|p[áa]g\.?|pag\.?|p\.|s\.)"
OF_WORD = r"(?:of|von|de|sur|/)"
DIGITS = r"[\dolis]{1,4}"
PAGE = re.compile(
    rf"{PAGE_WORD}\s*{DIGITS}(?:\s*{OF_WORD}\s*{DIGITS})?|[\[(]\s*{DIGITS}\s*[\])]|[-–—]\s*{DIGITS}\s*[-–—]|{DIGITS}\s*/\s*{DIGITS}", re.I
)
ONLY_PAGE = re.compile(rf"(?:{PAGE.pattern})", re.I)
BARE = re.compile(r"\d{1,4}|[ivxlc]{1,7}", re.I)
END_PAGE = re.compile(rf"^(?:{PAGE.pattern})(?=\s{{2,}}|\s*$)|(?:(?<=\s\s)|^)(?:{PAGE.pattern})$", re.I)
#: A sentence that ends inside the line.
INNER = re.compile(r"[^\W\d_]{3,}[.;:!?] +[^\W\d_]")
#: Whether the line has a mark before a space at all, which is quicker to see.
ENDS = re.compile(r"[.;:!?] ").search
#: What a page number within a line has at least: a digit.
HINT = re.compile(r"\d")
#: Running lines set at both margins.
GAP = re.compile(r"[^\s:.] {3,}\S")
WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"\S+")
EDGE = ".,;:!?()[]{}\"'“”„‘’«»"


@dataclass(slots=True)
class Line:
    """One line that is not blank."""

    number: int
    raw: str
    text: str
    key: str = ""
    page: bool = False
    bare: bool = False
    fragment: bool = False
    repeats: int = 1
    title: bool = False
    gap: bool = False
    shape: str = ""
    #: Recurs like a running line; may be one at all.
    vote: bool = False
    candidate: bool = False
    edge: bool = False
    low: bool = False
    _prose: bool | None = None
    like_title: bool = False
    row: list[float] = field(default_factory=list)
    sure: int | None = None

    @property
    def prose(self) -> bool:
        if self._prose is None:
            self._prose = prose(self.text)
        return self._prose


def prose(text: str) -> bool:
    """Four words or more, at least half of them in lower case."""
    words = text.split()
    return len(words) >= 4 and 2 * sum(map(str.islower, [w[0] for w in words])) >= len(words)


def key_of(text: str) -> str:
    return re.sub(r"\s+", " ", re.sub(r"\d+", "#", END_PAGE.sub(" ", text).lower())).strip(" .-")


def shape_of(key: str, known: set[str] | frozenset[str]) -> str:
    """The key with words that the corpus hardly has masked."""
    return WORD.sub(lambda m: m[0] if m[0] in known else "x", key)


def roman(text: str) -> int | None:
    values, total, last = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}, 0, 0
    for c in reversed(text.lower()):
        n = values.get(c)
        if n is None:
            return None
        total, last = (total - n, last) if n < last else (total + n, n)
    return total


def plain_runs(lines: list[Line]) -> list[int]:
    """For each line how many lines in one run, without a gap, are neither prose nor page numbers; 0 for prose."""
    out = [0] * len(lines)
    begin = 0
    for i, x in enumerate(lines):
        plain = not (x.page or x.low or x.text[-1] == "." or x.prose)
        end = i + plain
        # A run ends before prose, after a gap and with the text.
        if not plain or x.gap or i + 1 == len(lines):
            out[begin:end] = [end - begin] * (end - begin)
            begin = i + 1
    return out


def _alike(a: str, b: str) -> bool:
    """Whether two looks are one, misread here or there."""
    return len(a) >= 8 and abs(len(a) - len(b)) <= 2 and (a[:4] == b[:4] or a[-4:] == b[-4:]) and edits(a, b, 2) <= 2


def caps_of(text: str) -> float:
    words = text.split()
    return sum([w[0].isupper() for w in words]) / len(words)


def edge_of(x: Line, before: Line | None, after: Line | None) -> bool:
    """Whether the line is where a page can end: at a gap, a page number, an end of the text, or beside another line that
    recurs, as a header stands below a footer.
    """
    if x.gap or before is None or after is None or before.gap or before.page or before.bare or after.page or after.bare:
        return True
    return x.candidate and (before.repeats >= 2 and before.candidate and not before.prose or after.repeats >= 2 and after.candidate and not after.prose)


def lines_of(text: str, known, rows: bool = True, every: bool = False) -> list[Line]:
    """The lines that are not blank; those that can be furniture described, and labelled where a rule is sure.  every:
    all others too, as content.  Without rows only looks and votes are told.

    Most lines of a text begin in lower case or end a sentence and can be no running lines; they are not looked at.
    """
    out: list[Line] = []
    gap = True
    for k, line in enumerate(text.split("\n"), 1):
        s = line.strip()
        if not s:
            if out:
                out[-1].gap = True
            gap = True
            continue
        out.append(Line(k, line, s, gap=gap or "\f" in line, low=s[0].islower()))
        gap = False
    if not out:
        return out
    count = k
    out[-1].gap = True
    lengths = sorted(len(x.text) for x in out)
    width = lengths[int(0.8 * (len(lengths) - 1))]
    some: Counter[str] = Counter()
    running: list[Line] = []
    for x in out:
        s = x.text
        if len(s) <= 24:
            x.page = ONLY_PAGE.fullmatch(s) is not None
            x.bare = not x.page and len(s) <= 7 and BARE.fullmatch(s) is not None
        if x.page or x.bare:
            continue
        x.candidate = not x.low and s[-1] not in ".:;" and not (ENDS(s) and INNER.search(s))
        if x.candidate:
            x.fragment = HINT.search(s) is not None and END_PAGE.search(s) is not None
            x.key = key_of(s)
            some[x.key] += 1
            running.append(x)
    keys = [k for k in some if len(k) >= 8]
    near: Counter[str] = Counter(some)
    # Two looks that are one have their first or their last characters in common.
    ends: dict[tuple[int, str], list[str]] = {}
    met: set[tuple[str, str]] = set()
    for b in keys:
        for end in ((0, b[:4]), (1, b[-4:])):
            listed = ends.setdefault(end, [])
            for a in listed:
                if (a, b) not in met and _alike(a, b):
                    met.add((a, b))
                    near[a] += some[b]
                    near[b] += some[a]
            listed.append(b)
    for x in running:
        x.repeats = near[x.key]
        x.shape = shape_of(x.key, known)
    for i, x in enumerate(out):
        if x.candidate:
            before, after = out[i - 1] if i else None, out[i + 1] if i + 1 < len(out) else None
            x.edge = edge_of(x, before, after)
            x.vote = x.repeats >= 2 and (x.edge or caps_of(x.text) >= 0.6)
    if not rows:
        return out
    # The title: the last line before the first prose that is no page number.
    top: list[Line] = []
    for x in out:
        if x.prose and len(x.text) >= 0.5 * width:
            break
        top.append(x)
    names = [x for x in top if not x.page and not x.bare]
    first = next((x for x in out if not x.page and not x.bare), None)
    title = names[-1] if names and len(names) <= 3 else first if first is not None and not first.prose else None
    head = ""
    if title is not None:
        title.title, head = True, title.key or key_of(title.text)
    bare_values = [(i, int(x.text) if x.text.isdigit() else roman(x.text)) for i, x in enumerate(out) if x.bare]
    in_order: set[int] = set()
    for (i, a), (j, b) in zip(bare_values, bare_values[1:]):
        if a is not None and b is not None and b - a == 1 and j - i > 3:
            in_order |= {i, j}
    runs = plain_runs(out)
    for i, x in enumerate(out):
        if not (x.candidate or x.page or x.bare):
            x.sure = 0
            if not every:
                continue
        s = x.text
        before, after = out[i - 1] if i else None, out[i + 1] if i + 1 < len(out) else None
        open_before = before is not None and before.text[-1] not in ".:;!?" and before.prose
        x.like_title = x.candidate and not x.title and bool(head) and (x.key == head or x.key.startswith(head + " ") or _alike(head, x.key))
        caps = caps_of(s)
        after_colon = before is not None and before.text[-1] == ":"
        edge = x.edge if x.candidate else edge_of(x, before, after)
        if x.page and not after_colon:
            x.sure = 1
        elif x.bare:
            x.sure = 0 if after_colon else 1 if i in in_order else None
        elif not x.candidate or x.title:
            x.sure = 0
        elif x.fragment and (edge or open_before):
            x.sure = 1
        elif GAP.search(s) and (edge or open_before) and runs[i] < 4:
            x.sure = 1
        elif x.like_title and (edge or open_before):
            x.sure = 1
        elif x.vote and runs[i] < 4:
            x.sure = 1
        elif runs[i] >= 4 and not x.vote:
            x.sure = 0
        elif x.prose and not edge and x.repeats == 1 and len(s) > 0.7 * width:
            x.sure = 0
        spoken = WORD.findall(s.lower())
        x.row = [
            float(x.page), float(x.bare), float(x.fragment), min(x.repeats, 6), float(x.like_title), float(x.title), float(open_before), float(after is not None and after.low),
            float(x.gap), float(before is not None and before.gap or i == 0), float(i == 0), float(after is None), len(s) / max(width, 1),
            float(s[-1] in ".;"), float(s[-1] == ":"), float(after_colon), caps, float(x.prose),
            sum(w in known for w in spoken) / max(len(spoken), 1), float(i in in_order), float(before is not None and (before.page or before.bare)), float(after is not None and (after.page or after.bare)),
            sum(map(str.isdigit, s)) / len(s), (x.number - 1) / count, 0.0, 0.0,
        ]
    return out


#: What tells a sure case apart, blanked in training so that the classifier learns to do without.
EVIDENCE = [0, 2, 3, 4, 5, 19]


def look(x: Line, shapes: dict[str, tuple[int, int]]) -> tuple[float, float]:
    """How often lines of its look recur elsewhere in the corpus, and the logarithm of how many there are."""
    yes, no = shapes.get(x.shape, (0, 0))
    if x.candidate:  # without its own vote
        yes, no = yes - x.vote, no - (not x.vote)
    yes, no = max(yes, 0), max(no, 0)
    return (yes + 0.2) / (yes + no + 1), float(np.log1p(yes + no))


def with_shapes(lines: list[Line], shapes: dict[str, tuple[int, int]]) -> np.ndarray:
    """The descriptions of the lines, with how their looks fare in the corpus."""
    for x in lines:
        x.row[-2], x.row[-1] = look(x, shapes)
    return np.array([x.row for x in lines])


def furniture_of(documents: list[list[Line]], shapes, model) -> list[list[bool]]:
    """Which lines of each document are furniture; the lines of all documents are classified at once."""
    out = [[False] * len(lines) for lines in documents]
    open_ = [(d, k) for d, lines in enumerate(documents) for k, x in enumerate(lines) if x.row]
    if open_:
        likely = model.probability(with_shapes([documents[d][k] for d, k in open_], shapes)) > 0.5
        for (d, k), yes in zip(open_, likely.tolist()):
            out[d][k] = yes
    return out


def is_furniture(lines: list[Line], shapes, model) -> list[bool]:
    return furniture_of([lines], shapes, model)[0]


def division(text: str) -> tuple[str, str] | None:
    """(letters before the mark, the mark) of a line that ends in a division mark after a letter."""
    s = text.rstrip()
    if len(s) >= 3 and s[-1] in MARKS and (m := re.search(r"([^\W_][^\s]*)$", s[:-1])) and s[-2].isalnum() | (s[-2] in "@+"):
        return m[1].lstrip(EDGE), s[-1]
    return None


def pair_of(left: str, mark: str, right: str, words, compounds) -> tuple[float, ...]:
    """What tells whether the mark between two lines divides a word; left and right are the parts beside it.

    Counts come as whole powers of two, so there are few different descriptions.
    """
    b = right.strip(EDGE).lower()
    tail, first = left.lower().rsplit("-", 1)[-1], re.split(r"[-‐]", b)[0]
    power = lambda n: float(int(n).bit_length())
    return (
        float(mark in SURE), float(mark == "-"), power(words.get(tail + first, 0)), power(compounds.get(f"{tail}-{first}", 0)), power(words.get(tail, 0)), power(words.get(first, 0)),
        float(right[:1].isupper()), float(b[:1].isalpha()), float(b[:1] in ("@", "+")), float(min(len(tail), 4)), float(min(len(first), 4)),
    )


class Joins:
    """A classifier of pairs of lines: does the second go on with the word at the end of the first?"""

    def __init__(self, model):
        self.model, self.known = model, {}

    def breaks(self, left: str, mark: str, right: str, words, compounds) -> bool:
        row = pair_of(left, mark, right, words, compounds)
        found = self.known.get(row)
        if found is None:
            found = self.known[row] = bool(self.model.probability(np.array([row]))[0] > 0.5)
        return found


def fit_joins(words: dict[str, int], compounds: dict[str, int], most: int, boosted) -> Joins:
    """Learns from the corpus's words divided anywhere, its compounds divided at their hyphens, pairs of words that
    are none together, and invented names divided anywhere.  Marks other than the hyphen divide words only.
    """
    rng = np.random.default_rng(0)
    names = sorted((w for w in words if len(w) >= 4), key=lambda w: (-words[w], w))[:most]
    rows, labels = [], []

    def show(left: str, mark: str, right: str, yes: int) -> None:
        rows.append(pair_of(left, mark, right, words, compounds))
        labels.append(yes)

    for w in names:
        for _ in range(3):
            k = int(rng.integers(2, len(w) - 1))
            show(w[:k], MARKS[int(rng.integers(len(MARKS)))], w[k:], 1)
        name = "".join(chr(97 + int(rng.integers(26))) for _ in range(8))
        k = int(rng.integers(2, 7))
        show(name[:k], MARKS[int(rng.integers(len(MARKS)))], name[k:], 1)
        other = names[int(rng.integers(len(names)))]
        if w + other not in words:
            show(w, "-", other, 0)
            show(w, "-", other.capitalize(), 0)
    common = sorted(compounds, key=lambda c: (-compounds[c], c))[:most]
    for c in common * (1 + len(names) // max(len(common), 1) // 4):
        a, b = c.split("-", 1)
        show(a, "-", b, 0)
        if a + b not in words:
            show(a[:-1], "-", a[-1:] + b[:1], 1)
    return Joins(boosted.fit(np.array(rows), np.array(labels)) if rows else boosted)
