import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paperloom.operators import forms as O
from paperloom.options import SWEEP_FLOORS, SWEEP_THRESHOLDS, FormOptions
from paperloom.plans.forms import form_sweep


def walk(signed, threshold):
    """The plain sequential walk."""
    seeds, out = [], {}
    for sha in sorted(signed, key=lambda s: (-len(signed[s]), s)):
        mine, best, who = signed[sha], 0.0, None
        for s in seeds:
            union = len(mine | signed[s])
            value = len(mine & signed[s]) / union if union else 0.0
            if value > best:
                best, who = value, s
        if mine and who is not None and best >= threshold:
            out[sha] = (who, best)
        else:
            seeds.append(sha)
            out[sha] = (sha, 1.0)
    return out


def check(spark, signed, threshold, at_once):
    df = spark.createDataFrame([(k, sorted(v)) for k, v in signed.items()], "sha string, signature array<string>")
    got = {r[0]: (r[1], r[2]) for r in O.leader_clusters(df, FormOptions(threshold=threshold), at_once).select("sha", "seed", "fit").collect()}
    want = walk(signed, threshold)
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9, (k, got[k], want[k])


def test_leader_clusters_are_the_walk(spark):
    rng = random.Random(3)
    for at_once, threshold in ((1, 0.5), (3, 0.3), (256, 0.55)):
        signed = {f"s{i:03d}": set(rng.sample("ABCDEFGHIJ", rng.randint(0, 8))) for i in range(60)}
        check(spark, signed, threshold, at_once)


def test_each_document_is_met_once_and_not_rewritten(spark, monkeypatch):
    """A corpus of mostly single documents: as many rounds as documents / at_once, and a few frames kept in all of them."""
    rng = random.Random(6)
    words = [f"W{k:02d}" for k in range(40)]
    signed = {f"s{i:03d}": set(rng.sample(words, rng.randint(10, 25))) for i in range(120)}
    kept = []
    monkeypatch.setattr(O, "cut", lambda df, cut=O.cut: kept.append(1) or cut(df))
    check(spark, signed, 0.55, 16)
    assert len({s for s, _ in walk(signed, 0.55).values()}) > 60 and len(kept) <= 4


def test_the_sweep_keeps_no_row_for_a_word(spark, monkeypatch):
    texts = {f"s{i:02d}": ["ONE", "TWO", "RED"][: i % 4] for i in range(12)}
    sizes, kept = [], O.cut

    def counted(df):
        sizes.append(kept(df).count())
        return kept(df)

    monkeypatch.setattr(O, "cut", counted)
    monkeypatch.setattr(O.B, "cut", counted)
    sets = O.word_sets(spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "sha string, text string"))
    got = [tuple(r) for r in O.sweep(sets, len(texts), (0.5, 1.0), (0.9,)).collect()]
    # Two words are in half of the texts: six have both, three one, three none; no word is in all.
    assert got == [(0.5, 0.9, 5, 6, 3, 2), (1.0, 0.9, 12, 1, 12, 0)] and max(sizes) <= len(texts)


def test_word_sets_give_the_same_signatures(spark):
    texts = spark.createDataFrame([("a", "SafetyDataSheet SAFETYDATASHEET one"), ("b", "safety data sheet"), ("c", ""), ("d", "Safety one two"), (None, "safety one")], "sha string, text string")
    words = O.with_parts(O.words_of(texts))
    sets = O.word_sets(texts)
    for floor in (0.025, 0.5, 0.9):
        options = FormOptions(floor_fraction=floor)
        want = {r[0]: r[1] for r in O.signatures(texts, words, 5, options).collect()}
        assert {r[0]: r[1] for r in O.set_signatures(sets, 5, options).collect()} == want


def test_no_documents(spark):
    df = spark.createDataFrame([], "sha string, signature array<string>")
    assert O.leader_clusters(df).count() == 0


def split(word, known, most=6, least=3):
    """Plain backtracking, longest first."""

    def go(rest, left):
        if not rest:
            return []
        if not left:
            return None
        for n in range(len(rest), least - 1, -1):
            part = rest[:n]
            if part in known and part != word:
                more = go(rest[n:], left - 1)
                if more is not None:
                    return [part, *more]
        return None

    return go(word, most)


def test_joined_words_are_split_as_by_backtracking(spark):
    rng = random.Random(1)
    parts = ["ABC", "ABCD", "DEF", "EFG", "CDE", "GHIJ", "HIJ", "ABCDEF"]
    words = set(parts) | {"".join(rng.choices(parts, k=rng.randint(2, 5))) for _ in range(80)} | {"XXXXXXXXXXXXXX"}
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {}
    for r in O.split_joined(df).collect():
        got.setdefault(r[0], []).append(r[1])
    for w in words:
        want = split(w, words) if len(w) >= 12 else None
        assert sorted(got.get(w, [])) == sorted(want or []), w


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 400))
def test_floor_is_half_even(n):
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    if session is not None:
        assert session.range(1).select(O.floor_of(n)).first()[0] == max(2, round(0.025 * n))


def test_signatures_and_views(spark):
    texts = spark.createDataFrame([("a", "Batch Report\nresult 12.5 mg\nZanzibar"), ("b", "Batch Report\nresult 7 mg"), ("c", "")], "sha string, text string")
    words = O.words_of(texts)
    assert {r[0] for r in words.filter("sha = 'a'").select("word").collect()} == {"BATCH", "REPORT", "RESULT", "ZANZIBAR"}
    signed = {r[0]: r[1] for r in O.signatures(texts, words, 3).collect()}
    assert signed == {"a": ["BATCH", "REPORT", "RESULT"], "b": ["BATCH", "REPORT", "RESULT"], "c": []}
    keep = spark.createDataFrame([("f", "RESULT")], "form string, word string")
    none = spark.createDataFrame([], "word string, part string")
    view = O.structure_view(texts.withColumn("form", F.lit("f")), keep, none, FormOptions(header_lines=1)).filter("sha = 'a'").orderBy("line").collect()
    assert [r["view"] for r in view] == ["BATCH REPORT", "RESULT _ _", "_"]


def test_longest_text_of_copies(spark):
    df = spark.createDataFrame([("x", "b", "short"), ("x", "a", "a longer one"), ("y", "c", " "), ("y", "d", None), ("z", "p2", "same"), ("z", "p1", "SAME")], "sha string, path string, text string")
    assert {tuple(r) for r in O.texts_once(df).collect()} == {("x", "a longer one"), ("z", "SAME")}


def test_wording_and_inside(spark):
    members = spark.createDataFrame([("f", "a"), ("f", "b")], "form string, sha string")
    words = spark.createDataFrame([("a", "ONE"), ("a", "TWO"), ("b", "ONE")], "sha string, word string")
    assert [r["word"] for r in O.common_words(members, words).collect()] == ["ONE"]
    assert {r["word"] for r in O.inside_words(members, words).collect()} == {"ONE", "TWO"}
    texts = spark.createDataFrame([("a", "one and two"), ("b", "one")], "sha string, text string")
    rules = spark.createDataFrame([("f", ["ONE", "TWO"])], "form string, wording array<string>")
    assert {(r["sha"], r["has"]) for r in O.wording_split(members, texts, rules).collect()} == {("a", True), ("b", False)}


def test_stricter_thresholds(spark):
    rows = [("a", ["A", "B", "C", "D"]), ("b", ["A", "B", "C", "D", "E"]), ("c", ["A", "B", "C", "X"]), ("d", ["A", "B", "C", "X", "Y"])]
    signed = spark.createDataFrame(rows, "sha string, signature array<string>")
    members = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", False)], "sha string, marked boolean")
    assert O.leader_clusters(signed, FormOptions(threshold=0.4)).select("seed").distinct().count() == 1
    assert O.threshold_split(members, signed, 0.7).select("seed").distinct().count() == 2
    assert O.separating_threshold(members, signed, (0.4, 0.7, 0.9)) == 0.7
    assert O.separating_threshold(spark.createDataFrame([("a", True), ("a", False)], "sha string, marked boolean"), signed, (0.6,)) is None
    assert O.too_small(3) and O.too_small(40) is None


def test_the_sweep_tries_every_setting(spark, tmp_path):
    rng = random.Random(5)
    words = [a + b + c for a in "ABC" for b in "DEF" for c in "GHI"]
    texts = {f"s{i:02d}": " ".join(rng.sample(words[: rng.choice([6, 12, 27])], rng.randint(2, 6))) for i in range(40)}
    spark.createDataFrame([(k, k) for k in texts], "path string, sha string").write.parquet(f"{tmp_path}/files.parquet")
    spark.createDataFrame(list(texts.items()), "path string, textfile string").write.parquet(f"{tmp_path}/extracted.parquet")
    got = {(r["floor"], r["threshold"]): (r["forms"], r["largest"], r["single"], r["median_words"]) for r in form_sweep(spark, str(tmp_path)).collect()}
    want = {}
    for floor in SWEEP_FLOORS:
        least = max(2, round(floor * len(texts)))
        kept = {w for w in words if sum(w in t.split() for t in texts.values()) >= least}
        signed = {k: set(t.split()) & kept for k, t in texts.items()}
        for threshold in SWEEP_THRESHOLDS:
            seeds = [seed for seed, _ in walk(signed, threshold).values()]
            sizes = [seeds.count(s) for s in set(seeds)]
            want[floor, threshold] = (len(sizes), max(sizes), sizes.count(1), sorted(map(len, signed.values()))[len(texts) // 2])
    assert len(want) == 20 and got == want
