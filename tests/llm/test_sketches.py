import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from paperloom.llm import sketches as S

T = Fraction(3, 4)


def brute(sets, least):
    keys = sorted(k for k in sets if len(sets[k]) >= least)
    return {(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])}


def frame(spark, sets):
    return spark.createDataFrame([("o", k, sorted(v)) for k, v in sets.items()], "origin string, key bigint, elements array<string>")


def corpus(seed, n=150):
    rng = random.Random(seed)
    base = [frozenset(f"w{int(rng.paretovariate(0.6)) % 300}" for _ in range(rng.randint(8, 60))) for _ in range(n // 4)]
    out = {}
    for k in range(n):
        s = set(rng.choice(base))
        for _ in range(rng.randint(0, 9)):
            if rng.random() < 0.5 and s:
                s.discard(rng.choice(sorted(s)))
            else:
                s.add(f"x{rng.randint(0, 40)}")
        out[k] = frozenset(s)
    return out


# A value counts as common from a share of all elements; lists are refined from a length of their own, below or above
# that, whether the long values are few enough to broadcast or not.
@pytest.mark.parametrize("common, long_list, broadcast", [(1 / 200_000, 3, 300_000), (1 / 200_000, 4000, 300_000), (0.9, 3, 300_000), (0.02, 3, 5), (1 / 200_000, 3, 0)])
def test_every_pair_is_found(spark, monkeypatch, common, long_list, broadcast):
    monkeypatch.setattr(S, "COMMON", common)
    monkeypatch.setattr(S, "LONG_LIST", long_list)
    monkeypatch.setattr(S, "BROADCAST_ROWS", broadcast)
    sets = corpus(long_list)
    members, links = S.near_duplicates(frame(spark, sets), 5, T)
    got = {(r["firstkey"], r["secondkey"]) for r in S.all_pairs(members, links).collect()}
    assert got == brute(sets, 5)


def test_a_large_class_is_paired_in_blocks(spark):
    members = spark.createDataFrame([("o", k, 1) for k in range(1, 60)] + [("o", 100, 100), ("o", 101, 100), ("q", 1, 1)], "origin string, key bigint, class bigint")
    links = spark.createDataFrame([("o", 1, 100, 3, 4)], "origin string, a bigint, b bigint, shared int, united int")
    got = [(r["firstkey"], r["secondkey"]) for r in S.all_pairs(members, links, block=7).collect()]
    keys = [*range(1, 60), 100, 101]
    assert sorted(got) == [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :]]


def test_exactly_at_the_threshold(spark):
    a = [f"e{i}" for i in range(8)]
    sets = {1: frozenset(a), 2: frozenset(a[:6]), 3: frozenset(a[:5]), 4: frozenset(a)}
    members, links = S.near_duplicates(frame(spark, sets), 5, T)
    assert {(r["firstkey"], r["secondkey"]) for r in S.all_pairs(members, links).collect()} == brute(sets, 5) == {(1, 2), (1, 4), (2, 3), (2, 4)}


def test_groups(spark):
    a = [f"e{i:02d}" for i in range(20)]
    sets = {9: frozenset(a), 5: frozenset(a), 7: frozenset(a[1:]), 3: frozenset(["z1", "z2", "z3", "z4", "z5"])}
    members, links = S.near_duplicates(frame(spark, sets), 5, T)
    got = {r["key"]: (r["class"], r["links"], r["group"]) for r in S.groups(members, links).collect()}
    assert got == {9: (5, 1, 5), 5: (5, 1, 5), 7: (7, 1, 5), 3: (3, 0, 3)}


def test_a_chain_is_one_group(spark):
    links = spark.createDataFrame([("o", k, k + 1) for k in range(40)] + [("o", 100, 101)], "origin string, a bigint, b bigint")
    got = {r["key"]: r["group"] for r in S.components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_chains_in_any_order_are_one_group(spark):
    rng = random.Random(6)
    paths = {"down": [1, *range(70, 1, -1)], "random": rng.sample(range(1_000), 40)}
    star = [("star", k, 900) for k in range(30)] + [("star", k, 901) for k in range(25, 50)]
    rows = [(o, min(a, b), max(a, b)) for o, p in paths.items() for a, b in zip(p, p[1:])] + star
    got = {(r["origin"], r["key"]): r["group"] for r in S.components(spark.createDataFrame(rows, "origin string, a bigint, b bigint")).collect()}
    want = {(o, k): min(p) for o, p in paths.items() for k in p} | {("star", k): 0 for k in [*range(50), 900, 901]}
    assert got == want


def test_nothing_and_nulls(spark):
    members, links = S.near_duplicates(frame(spark, {1: frozenset(["a"])}), 5, T)
    assert members.count() == 0 and links.count() == 0
    with pytest.raises(ValueError):
        S.near_duplicates(frame(spark, {}), 1, T)
    texts = spark.createDataFrame([(None,), ("",), ("A a  b1, É_é",)], "t string")
    assert [r[0] and sorted(r[0]) for r in texts.select(S.word_set(F.col("t"))).collect()] == [None, [], ["a", "b1", "é"]]
