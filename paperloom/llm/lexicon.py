"""A minimal acyclic transducer over byte words: shared suffixes, and for each word its number and so its token ids.

The automaton is built from sorted words with states merged as soon as they are complete.  Each transition carries how
many words lie before it, so the sum along a path is the word's number (a minimal perfect hash).  States lie in one
double array; all words of a block walk it in step, a byte at a time.  The arrays are one flat file that workers map.
"""

from __future__ import annotations

import json

import numpy as np


def _minimal(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool], int]:
    """States (their transitions), which of them are final, and the root; equal right languages are one state."""
    edges: list[dict[int, int]] = [{}]
    final = [False]
    register: dict[tuple, int] = {}
    path = [0]  # states of the last word, root first
    last = b""

    def settle(down_to: int) -> None:
        while len(path) - 1 > down_to:
            state = path.pop()
            key = (final[state], *sorted(edges[state].items()))
            same = register.setdefault(key, state)
            if same != state:
                edges[path[-1]][last[len(path) - 1]] = same

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        for byte in word[common:]:
            edges.append({})
            final.append(False)
            edges[path[-1]][byte] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = word
    settle(0)
    return edges, final, 0


class Lexicon:
    """words: distinct, sorted.  ids: for each word its token ids."""

    FIELDS = ("base", "check", "target", "skip", "final", "starts", "flat")

    def __init__(self, **arrays: np.ndarray):
        for k in self.FIELDS:
            setattr(self, k, arrays[k])
        self.longest = int(arrays["longest"][0])

    @staticmethod
    def build(words: list[bytes], ids: list[list[int]]) -> Lexicon:
        edges, final, root = _minimal(words)
        order, seen = [], {}
        todo = [root]
        while todo:  # reachable states, numbered anew, root 0
            s = todo.pop()
            if s in seen:
                continue
            seen[s] = len(order)
            order.append(s)
            todo.extend(edges[s].values())
        below: dict[int, int] = {}

        def count(s: int) -> int:
            stack = [s]
            while stack:
                x = stack[-1]
                missing = [t for t in edges[x].values() if t not in below]
                if missing:
                    stack.extend(missing)
                else:
                    below[x] = int(final[x]) + sum(below[t] for t in edges[x].values())
                    stack.pop()
            return below[s]

        count(root)
        size = 4 * sum(len(edges[s]) for s in order) + 1024
        base = np.zeros(len(order) + 1, np.int32)
        check = np.full(size, -1, np.int32)
        target = np.zeros(size, np.int32)
        skip = np.zeros(size, np.int32)
        free, hint = np.ones(size, bool), {}
        for s in sorted(order, key=lambda s: -len(edges[s])):
            if not edges[s]:
                continue
            labels = sorted(edges[s])
            # States of one width are placed left to right; narrower ones fill the gaps of wider ones.
            at = max(hint.get(len(labels), 0) - labels[0], 0)
            offsets = np.array(labels)
            while not free[at + offsets].all():
                step = np.flatnonzero(free[at + 1 + labels[0] : at + 4097 + labels[0]])
                at += 1 + (int(step[0]) if len(step) else 4096)
            hint[len(labels)] = at + labels[0]
            passed = int(final[s])
            base[seen[s]] = at
            for c in labels:
                t = edges[s][c]
                check[at + c], target[at + c], skip[at + c] = seen[s], seen[t], passed
                free[at + c] = False
                passed += below[t]
        dead = len(order)
        base[dead] = 0
        sizes = np.array([len(x) for x in ids], np.int32)
        return Lexicon(
            base=base, check=check, target=target, skip=skip, final=np.array([final[s] for s in order] + [False]),
            starts=np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), flat=np.array([i for x in ids for i in x], np.int32),
            longest=np.array([max(map(len, words), default=0)], np.int32),
        )

    def number(self, data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The number of each word of the block, -1 for words not in the lexicon."""
        out = np.full(len(first), -1, np.int32)
        order = np.argsort(-np.minimum(length, 255).astype(np.int16), kind="stable")
        order = order[np.searchsorted(-length[order], -self.longest) :] if len(order) else order
        at, left = first[order], length[order]
        m = len(order)
        state = np.zeros(m, np.int32)
        sums = np.zeros(m, np.int32)
        dead = np.int32(len(self.base) - 1)
        counts = np.bincount(left, minlength=self.longest + 2)[: self.longest + 2] if m else np.zeros(self.longest + 2, np.int64)
        longer = m - np.cumsum(counts)  # longer[t]: words of more than t bytes
        for t in range(self.longest):
            k = int(longer[t])
            if not k:
                break
            s = state[:k]
            slot = self.base[s] + data[at[:k] + t]
            fits = self.check[slot] == s
            sums[:k] += self.skip[slot]
            state[:k] = np.where(fits, self.target[slot], dead)
        good = self.final[state]
        out[order[good]] = sums[good]
        return out

    def save(self) -> bytes:
        arrays = {k: np.ascontiguousarray(getattr(self, k)) for k in self.FIELDS} | {"longest": np.array([self.longest], np.int32)}
        head, place, parts = {}, 0, []
        for k, a in arrays.items():
            head[k] = (a.dtype.str, len(a), place)
            raw = a.tobytes() + bytes(-a.nbytes % 64)
            parts.append(raw)
            place += len(raw)
        text = json.dumps(head).encode()
        text += b" " * (-(len(text) + 8) % 64)
        return len(text).to_bytes(8, "little") + text + b"".join(parts)

    @staticmethod
    def load(path: str) -> Lexicon:
        """Maps the file; pages are shared by the workers of a machine."""
        raw = np.memmap(path, np.uint8, mode="r")
        n = int.from_bytes(raw[:8].tobytes(), "little")
        head = json.loads(raw[8 : 8 + n].tobytes())
        body = raw[8 + n :]
        view = lambda kind, count, at: body[at : at + count * np.dtype(kind).itemsize].view(kind)
        return Lexicon(**{k: np.asarray(view(*x)) for k, x in head.items()})
