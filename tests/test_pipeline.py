import random

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as X
from paperloom.operators import answers as A
from paperloom.operators import audit as U
from paperloom.operators import readings as R
from paperloom.operators import resolve as J
from paperloom.operators import review as V
from paperloom.operators import sections as S
from paperloom.operators import tree as T
from paperloom.operators import vocabulary as W
from paperloom.operators.prefix import row_numbers, running_sum
from paperloom.options import ReadingOptions


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if not isinstance(v, float) else 'double'}" for k, v in values.items())) if values else spark.range(1)
    return row.select(column.alias("x")).first()[0]


def test_folds(spark):
    c = F.col("v")
    assert one(spark, X.normalise(c), v=" a  b\x1c\tc　") == "a b c"
    assert one(spark, X.casefold(c), v="Straße") == one(spark, X.casefold(c), v="STRASSE")
    assert one(spark, X.folded_hard(c), v=" Safety-Data  SHEET (v2) ") == "safety data sheet v2"
    assert one(spark, X.letters(c), v="a1²b é-Ⅷ") == 5
    assert one(spark, X.section_key(c), v=" Safety & Handling ") == "safety_&_handling"
    for v, want in (("Y", True), (" true ", True), ("1", True), ("no", False), ("", False), ("on", False)):
        assert one(spark, X.is_true(c), v=v) is want
    assert one(spark, X.is_true(F.lit(None).cast("string"))) is False


def plain_batches(rows, size, images):
    """The plain loop."""
    out, batch, n, carried = {}, 1, 0, 0
    for key, pictures in rows:
        if n >= size or (carried > 0 and carried + pictures > images):
            batch, n, carried = batch + 1, 0, 0
        out[key] = batch
        n, carried = n + 1, carried + pictures
    return out


@pytest.mark.parametrize("chunk", [20, 37, 1000])
def test_batches_are_those_of_the_loop(spark, chunk):
    rng = random.Random(chunk)
    rows = [(f"t{rng.randint(0, 2)}", f"f{i:04d}", f"r{i:04d}", rng.choice([0, 0, 0, 1, 2, 5, 13, 40])) for i in range(500)]
    df = spark.createDataFrame([(r[2], r[0], r[1], r[3]) for r in rows], "readingid string, itemtable string, first_file string, images int")
    got = {r["readingid"]: r["batch"] for r in R.batches(df, ReadingOptions(), chunk).collect()}
    assert got == plain_batches([(r[2], r[3]) for r in sorted(rows)], 20, 12)


def test_no_batches(spark):
    assert R.batches(spark.createDataFrame([], "readingid string, itemtable string, first_file string, images int")).count() == 0


def test_running_sums(spark):
    rows = [("a" if i % 3 else "b", i, i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k int, v int").repartition(5)
    sums, want = {"a": 0, "b": 0}, {}
    for g, k, v in rows:
        sums[g] += v
        want[k] = sums[g]
    assert {r["k"]: r["s"] for r in running_sum(df, ["g"], ["k"], "v", "s").collect()} == want
    assert [r["n"] for r in row_numbers(df, ["k"], "n").orderBy("k").collect()] == list(range(300))


def test_branches_and_items(spark):
    branches = [J.Branch("", "raw", level=1), J.Branch("src1", "prod", level=1), J.Branch("src7/", "prod", pattern=r"_(\d+)\."), J.Branch("src1", "never", level=1)]
    paths = ["src1/x.pdf", "src10/y.pdf", "src7/a_77.txt", "src7/none.txt", "other/z.md", "loose.txt"]
    files = T.tree(spark.createDataFrame([(p,) for p in paths], "relativepath string"))
    found = J.identify(files, branches)
    got = {r["path"]: (r["branch"], r["itemtable"], r["identifier"], r["why"]) for r in found.collect()}
    assert got["src10/y.pdf"] == (1, "prod", "src10", None)  # a raw prefix, not a path segment; the first of equals
    assert got["src7/a_77.txt"] == (2, "prod", "77", None)
    assert got["src7/none.txt"][3] == "unidentified" and got["loose.txt"][3] == "unidentified"
    items = W.load_items(
        spark.createDataFrame(
            [("prod", "1", "SRC1", "A", "", "no"), ("prod", "2", "src10", "B", "", "Y"), ("prod", "3", "77", "C", "", None), ("prod", "4", "77", "D", "", ""), ("none", "5", "x", "E", "", "")],
            "itemtable string, id string, identifier string, name string, template string, archived string",
        ),
        ["prod", "raw"],
    )
    why = {r["path"]: (r["why"], r["itemid"]) for r in J.resolve(found, items).collect()}
    assert why["src1/x.pdf"] == (None, "1")  # only case-blind
    assert why["src10/y.pdf"] == ("archived", None)
    assert why["src7/a_77.txt"] == ("ambiguous", None)
    assert why["other/z.md"] == ("unmatched", None)
    rates = {r["prefix"]: r["files"] for r in J.match_rates(J.resolve(found, items), branches[:3]).collect()}
    assert rates == {"": 2, "src1": 2, "src7/": 2}


def test_exclusions(spark):
    files = T.tree(spark.createDataFrame([("A/Old/x.MSG",), ("A/b.msg",), ("A/c.pdf",), (None,)], "relativepath string"))
    got = {r["path"]: r["why"] for r in T.exclusions(files, ["OLD"], [".msg"]).collect()}
    assert got == {"A/Old/x.MSG": "folder Old", "A/b.msg": "extension msg", "A/c.pdf": None}


def test_settling(spark):
    rows = [
        ("a", 1, "t1", None, None), ("a", 2, "t1", None, None),  # agreed
        ("b", 1, "t1", None, None), ("b", 2, "t2", None, None),  # contested
        ("c", 1, "t1", None, "quote not in the text"), ("c", 2, "t2", None, None),  # the first is replaced
        ("d", 1, "t1", None, "no quote"),
        ("e", 1, "", "Safety sheet", None), ("e", 2, None, "SAFETY-SHEET", None),  # one proposal in two spellings
    ]
    got = {r["readingid"]: r for r in A.settle(spark.createDataFrame(rows, "readingid string, round int, template string, proposal string, fault string")).collect()}
    assert got["a"]["agreed"] and not got["a"]["contested"]
    assert got["b"]["contested"] and got["b"]["template"] == "t1"
    assert got["c"]["template"] == "t2" and not got["c"]["contested"] and got["c"]["fault"] is None
    assert got["d"]["fault"] == "no quote" and got["d"]["template"] is None
    assert got["e"]["agreed"]


def test_answers(spark):
    c = F.col("v")
    for v, want in (("0.5", 0.5), ("7", 1.0), ("-1", 0.0), ("NaN", None), ("high", None)):
        assert one(spark, A.confidence_of(c), v=v) == want
    assert one(spark, A.quote_fault(F.lit("The product is safe to ship."), c), v="product IS  safe") is None
    assert one(spark, A.quote_fault(F.lit("The product is safe."), c), v="safe") == "quote too short"
    assert one(spark, A.quote_fault(F.lit("The product is safe."), c), v="something else here") == "quote not in the text"
    assert one(spark, A.quote_fault(F.lit(None).cast("string"), c), v="") is None
    assert one(spark, A.trimmed(c, 12), v="alpha beta  gamma delta") == "alpha beta"
    assert one(spark, A.form_answer_fault(F.lit(True), F.lit("t"), F.lit(""), F.array(F.lit("u")), F.lit("x"), c), v="long enough quote") == "template not offered"
    tasks = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "readingid string, batch int")
    back = spark.createDataFrame([("a",), ("a",), ("x",)], "readingid string")
    assert {tuple(r) for r in A.roll_call(tasks, back, "readingid", "batch").collect()} == {(1, 2, 1, 1), (2, 1, 0, 1)}


def test_audit(spark):
    answers = spark.createDataFrame(
        [("r1", "A", "The same long quote", "tells of an Allergen Declaration here", "f1"), ("r2", "B", "the  SAME long quote", "other evidence text", "f2"), ("r3", "A", "short", "OTHER evidence  text", "f3"), ("r4", None, None, None, None)],
        "readingid string, called string, quote string, evidence string, form string",
    )
    assert [(r["names"], r["answers"]) for r in U.quote_collisions(answers).collect()] == [(2, 2)]
    assert [(r["evidence"], r["forms"]) for r in U.evidence_reuse(answers).collect()] == [("other evidence text", 2)]
    types = spark.createDataFrame([("Allergen Declaration (AD)",), ("short",), (None,)], "phrase string")
    assert {(r["phrase"], r["answers"]) for r in U.named_but_not_picked(answers, types).collect()} == {("allergen declaration", 1)}
    assert U.name_similarity("safety data", "safety data", frozenset()) == 1.0
    assert U.name_similarity("product form", "product norm", frozenset(["product", "form"])) > 0.9
    assert U.name_similarity("product specification", "product information", U.COMMON_WORDS) == 0.4
    tree = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    out = U.conservation(tree, [("data", spark.createDataFrame([("a",), ("b",)], "path string")), ("issue", spark.createDataFrame([("b",), ("x",)], "path string"))])
    assert {tuple(r) for r in out.collect()} == {("b", "data|issue", 2), ("c", "", 0), ("x", "issue", 1)}
    misses = U.near_misses(spark.createDataFrame([("t", "RM-00123")], "itemtable string, identifier string"), spark.createDataFrame([("t", "RM-00124"), ("t", "FG-99999"), ("u", "RM-00123")], "itemtable string, identifier string"))
    assert [(r["near"], r["place"]) for r in misses.collect()] == [("RM-00124", 1)]


def test_sections(spark):
    sections = spark.createDataFrame([("I", "Safety", 2, ["t1", "t2"]), ("I", "Quality", 1, ["t1"])], "itemtemplate string, label string, sortorder int, templates array<string>")
    assert {(r["documenttemplateid"], r["section"]) for r in S.section_of(sections).collect()} == {("t1", "Quality"), ("t2", "Safety")}
    pairs = spark.createDataFrame([("I", "t1", "T1", 3), ("I", "t3", "T3", 1), ("J", "t1", "T1", 1)], "itemtemplate string, documenttemplateid string, documenttemplate string, documents bigint")
    said = spark.createDataFrame([("I", "t1", "Other"), ("I", "t3", " quality "), ("J", "t1", "New one")], "itemtemplate string, documenttemplateid string, section string")
    got = {(r["itemtemplate"], r["documenttemplateid"]): r for r in S.collect_sections(pairs, said, sections).collect()}
    assert got["I", "t1"]["section"] == "Quality" and got["I", "t1"]["kept"] and not got["I", "t1"]["isnew"]
    assert not got["I", "t3"]["isnew"] and got["J", "t1"]["isnew"]
    assert got["I", "t3"]["sectionid"].startswith("ds_") and len(got["I", "t3"]["sectionid"]) == 15


def test_review(spark):
    rows = [("f", f"s{i:02d}", i / 100, (30 - i) / 100) for i in range(30)]
    shown = V.shown_members(spark.createDataFrame(rows, "form string, sha string, fit double, filled double"))
    blocks = {}
    for r in shown.collect():
        blocks.setdefault(r["block"], set()).add(r["sha"])
    assert {k: len(v) for k, v in blocks.items()} == {"random": 8, "suspect": 6, "filled": 4}
    assert len(set.union(*blocks.values())) == 18
    marks = spark.createDataFrame([("f", min(blocks["random"])), ("f", "nobody")], "form string, sha string")
    assert [tuple(r) for r in V.failure_rates(shown, marks).collect()] == [("f", 8, 1, 1)]
    outcome = V.outcome(F.col("v"), F.lit(1), F.lit(8), F.lit(None).cast("string"), F.lit(False), F.lit(None).cast("double"))
    assert one(spark, outcome, v="ok") == "marked read alone" and one(spark, outcome, v="mixed") == "dissolved"


def test_near_misses_are_those_of_a_full_comparison(spark):
    import difflib

    rng = random.Random(8)
    index = sorted({f"RM-{rng.randint(0, 400):06d}" for _ in range(120)} | {f"RM-{rng.randint(0, 400):06d}{x}" for x in ("77", "-A", "xyz", "") for _ in range(10)} | {"L" * 50 + str(k) for k in range(9)} | {"AB", "ABC", "a" * 13})
    wanted = sorted({f"RM-{rng.randint(0, 400):06d}" for _ in range(40)} - set(index)) + ["RM-0001", "XX", "", "RM-000123xyzz", "L" * 47 + "99", "A", "ABCD", "RM-00012377x", "a" * 16, "b" * 60]
    df = lambda rows: spark.createDataFrame([("t", x) for x in rows] + [("u", rows[0]), (None, "RM-000001")], "itemtable string, identifier string")
    got = {}
    for r in U.near_misses(df(wanted), df(index)).filter("itemtable = 't'").orderBy("place").collect():
        got.setdefault(r["identifier"], []).append(r["near"])
    for w in wanted:
        scored = sorted(((difflib.SequenceMatcher(None, x, w).ratio(), x) for x in index), key=lambda p: (-p[0], p[1]))
        want = [x for s, x in scored[:3] if s >= 0.8 and w]
        assert got.get(w, []) == want, (w, got.get(w), want)


def test_near_misses_keep_no_more_than_can_count(spark, monkeypatch, tmp_path):
    import difflib
    import re

    index = [f"pk-{k:08d}" for k in range(0, 400, 2)]
    wanted = [f"rm-{k:08d}" for k in range(30)] + [f"pk-{k:08d}" for k in range(1, 61, 2)] + ["pk-0000124", "pk-0000999"]
    plans, kept, cut = [], [], U.cut
    monkeypatch.setattr(U, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept.append(cut(df)) or kept[-1])
    for name, rows in (("wanted", wanted), ("index", index)):
        spark.createDataFrame([("t", x) for x in rows], "itemtable string, identifier string").write.parquet(f"{tmp_path}/{name}")
    got = {}
    for r in U.near_misses(spark.read.parquet(f"{tmp_path}/wanted"), spark.read.parquet(f"{tmp_path}/index")).orderBy("place").collect():
        got.setdefault(r["identifier"], []).append(r["near"])
    for w in wanted:
        scored = sorted((-difflib.SequenceMatcher(None, x, w).ratio(), x) for x in index)
        assert got.get(w, []) == [x for s, x in scored[:3] if s <= -0.8], w
    # Tables of few bytes: what explode makes of them is not sent to the driver all the same.
    assert not any(re.search(r"BroadcastHashJoin \[[^]]*_left", p) for p in plans)
    assert all(df.groupBy("identifier").count().filter("count > 3").isEmpty() for df in kept if "ratio" in df.columns)
    # Nothing that differs by more characters can count, so nothing is held against the whole table.
    assert kept[-1].columns == ["itemtable", "identifier"] and kept[-1].isEmpty()


def test_near_misses_of_just_the_least_ratio_at_three_more_characters(spark):
    df = lambda rows: spark.createDataFrame([("t", x) for x in rows], "itemtable string, identifier string")
    assert [(r["near"], r["ratio"]) for r in U.near_misses(df(["abaabbabb"]), df(["aaabab"])).collect()] == [("aaabab", 0.8)]


def test_three_near_ones_do_not_hide_a_nearer_one(spark):
    index = ["RM-00000124", "RM-00000125", "RM-00000126", "RM-0000012377"]
    df = lambda rows: spark.createDataFrame([("t", x) for x in rows], "itemtable string, identifier string")
    got = [r["near"] for r in U.near_misses(df(["RM-00000123"]), df(index)).orderBy("place").collect()]
    assert got == ["RM-0000012377", "RM-00000124", "RM-00000125"]


def test_nearest_names_are_those_of_a_full_comparison(spark, monkeypatch):
    rng = random.Random(5)
    words = "safety data sheet allergen declaration product specification raw material certificate of analysis batch".split()
    names = sorted({" ".join(rng.sample(words, rng.randint(1, 4))) for _ in range(60)})
    titles = sorted({" ".join(rng.sample(words + ["new", "zz"], rng.randint(1, 4))) for _ in range(25)})
    df = lambda rows, c: spark.createDataFrame([(x.title(), x) for x in rows], f"{c} string, words string")
    for block in (2_000, 7):
        monkeypatch.setattr(U, "NAME_BLOCK", block)
        got = {}
        for r in U.nearest_names(df(titles, "title"), df(names, "name")).orderBy("place").collect():
            got.setdefault(r["title"], []).append((r["name"], r["score"]))
        for t in titles:
            scored = sorted(((U.name_similarity(t, n, U.COMMON_WORDS), n.title()) for n in names), key=lambda p: (-p[0], p[1]))
            assert got[t.title()] == [(n, s) for s, n in scored[:3]]


def test_phrases_inside_longer_words_are_found(spark):
    rows = [("r1", "X", "see the specifications", None), ("r2", "X", None, "Produktspezifikation liegt bei"), ("r3", "specification", "specifications", ""), ("r4", None, "two-word phraseology", ""), ("r5", "X", "short", None)]
    answers = spark.createDataFrame(rows, "readingid string, called string, quote string, evidence string")
    types = spark.createDataFrame([("specification",), ("spezifikation",), ("word phrase",), ("tiny",)], "phrase string")
    assert {tuple(r) for r in U.named_but_not_picked(answers, types).collect()} == {("specification", 1), ("spezifikation", 1), ("word phrase", 1)}
