import random

from paperloom.llm.mixing import level, mix, shares


def plain(docs, targets, order, budget=None):
    """Fair queueing by a sorted list: docs {id: (source, tokens)}; order: place of each id."""
    have = {s: sum(n for t, n in docs.values() if t == s) for s in targets}
    have = {s: n for s, n in have.items() if n}
    scale = sum(targets[s][0] for s in have)
    weight = {s: targets[s][0] / scale for s in have}
    total = budget if budget is not None else int(min(have[s] * targets[s][1] / weight[s] for s in have))
    rows = []
    for s in have:
        mine = sorted((order[k], k) for k, (t, n) in docs.items() if t == s and n)
        done = 0
        for r in range(1, targets[s][1] + 1):
            for _, k in mine:
                done += docs[k][1]
                rows.append((done / weight[s], s, r, k, docs[k][1]))
    used, out = 0, []
    for f, s, r, k, n in sorted(rows):
        if used + n > total:
            break
        used += n
        out.append((k, r))
    return out


def frames(spark, docs, targets):
    sized = spark.createDataFrame([(k, s, n) for k, (s, n) in docs.items()], "doc_id bigint, source string, tokens bigint")
    return sized, spark.createDataFrame([(s, w, r) for s, (w, r) in targets.items()], "source string, share double, maxrepeats int")


def test_as_by_a_sorted_list(spark):
    rng = random.Random(4)
    docs = {k: (rng.choice(["a", "a", "a", "b", "c", None, "other"]), rng.choice([0, 1, 5, 20, 100])) for k in range(400)}
    targets = {"a": (0.5, 1), "b": (0.3, 3), "c": (0.15, 2), "none": (0.05, 4)}
    sized, wanted = frames(spark, docs, targets)
    order = {r[0]: r[1] for r in sized.selectExpr("doc_id", "xxhash64(doc_id, 0) h").collect()}
    for budget in (None, 500, 50_000):
        got = mix(sized, wanted, budget).orderBy("total").collect()
        want = plain(docs, targets, order, budget)
        assert [(r["doc_id"], r["repeat"]) for r in got] == want[: len(got)] and len(got) == len(want)
        assert all(r["repeat"] <= targets[r["source"]][1] for r in got)
    table = {r["source"]: r for r in shares(mix(sized, wanted), wanted).collect()}
    assert set(table) == set(targets) and table["none"]["tokens"] == 0
    assert abs(table["a"]["reached"] - 0.5 / 0.95) < 0.1


def test_nothing_to_mix(spark):
    sized, wanted = frames(spark, {1: (None, 5), 2: ("x", 0)}, {"x": (1.0, 2)})
    assert mix(sized, wanted).count() == 0
    assert [r["tokens"] for r in shares(mix(sized, wanted), wanted).collect()] == [0]


def test_level():
    assert level(10, {"a": (0.5, 100), "b": (0.5, 100)}) == 10
    assert level(30, {"a": (0.5, 5), "b": (0.5, 100)}) == 50


def test_documents_over_the_level_are_taken_while_they_fit(spark):
    docs = {**{k: ("a", 100) for k in range(4)}, **{100 + k: ("b", 1) for k in range(200)}}
    targets = {"a": (0.5, 1), "b": (0.5, 3)}
    sized, wanted = frames(spark, docs, targets)
    order = {r[0]: r[1] for r in sized.selectExpr("doc_id", "xxhash64(doc_id, 0) h").collect()}
    got = mix(sized, wanted, 150).orderBy("total").collect()
    assert [(r["doc_id"], r["repeat"]) for r in got] == plain(docs, targets, order, 150)
