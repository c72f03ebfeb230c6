import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from paperloom.operators import answers as A
from paperloom.operators import collect as C
from paperloom.operators import forms as O
from paperloom.operators import resolve as J
from paperloom.operators import review as V
from paperloom.operators import similarity as L
from paperloom.operators import vocabulary as W
from paperloom.options import FormOptions
from paperloom.sources import files as S
from paperloom.sources import manifests as M


def test_one_verdict_for_every_copy(spark):
    settled = spark.createDataFrame(
        [("r1", "t1", None, 0.9, False, False, None), ("r2", "t1", None, 0.5, False, False, None), ("r3", None, None, None, False, False, "no quote"), ("r4", "t9", None, 0.9, False, False, None), ("r5", "", "New kind", 0.9, False, False, None),
         ("r6", "t2", None, 0.9, False, True, None), ("r7", None, " ", 0.9, False, False, None), ("r8", "t3", None, 0.9, False, False, None)],
        "readingid string, template string, proposal string, confidence double, agreed boolean, contested boolean, fault string",
    )
    readings = spark.createDataFrame([("r1", "s1"), ("f1", "s2"), ("f2", "s3"), (None, None)], "readingid string, sha string")
    members = spark.createDataFrame([("a", "s1"), ("b", "s2"), ("a", "s2"), ("c", "s3")], "form string, sha string")
    said = spark.createDataFrame([("a", "t2", None, 0.8, 30, 5), ("b", "t1", None, 0.8, 9, 5)], "form string, template string, proposal string, confidence double, standsfor int, sampled int")
    by_form = C.form_verdicts(readings, members, said)
    assert {(r["readingid"], r["form"], r["template"]) for r in by_form.collect()} == {("r1", "a", "t2"), ("f1", "a", "t2")}
    verdicts = C.reading_verdicts(settled, by_form)
    docs = spark.createDataFrame([(f"p{k}", r, "tab", "I") for k, r in enumerate(["r1", "r1", "r2", "r3", "r4", "r5", "r6", "r7", "r8", "f1", "none", None])], "path string, readingid string, itemtable string, itemtemplate string")
    templates = spark.createDataFrame([("t1", "One", ["tab"]), ("t2", "Two", []), ("t3", "Three", ["other"])], "id string, name string, for_tables array<string>")
    sections = spark.createDataFrame([("I", "Safety", 1, ["t1"]), ("I", "Other", 2, ["t1", "t2"]), ("J", "X", 0, ["t1"])], "itemtemplate string, label string, sortorder int, templates array<string>")
    fanned = C.fan_out(docs, verdicts.join(spark.createDataFrame([("r2", 2), ("r3", 1)], "readingid string, rounds int"), "readingid", "left"))
    out = C.checked(fanned, templates, sections)
    got = {r["path"]: r for r in out.collect()}
    assert [(got[f"p{k}"]["verdict"], got[f"p{k}"]["why"]) for k in range(12)] == [
        ("pick", None), ("pick", None), ("pick", "thin"), ("unverified", "unverified"), ("unknown template", "template not allowed"), ("proposal", "proposal"), ("pick", "contested"), ("nothing", "nothing"),
        ("template not allowed", "template not allowed"), ("pick", None), ("unread", "unread"), ("unread", "unread"),
    ]
    assert got["p0"]["section"] == "Safety" and got["p0"]["usable"] and got["p9"]["form"] == "a" and got["p9"]["standsfor"] == 30 and got["p8"]["documenttemplate"] is None
    assert [r[0] for r in C.reread(out).collect()] == ["r3"]
    at = spark.createDataFrame([("p0", None, "text"), ("p3", None, "text"), ("x1", "unmatched", None), ("x2", None, None)], "path string, why string, read string")
    told = spark.createDataFrame([("x9",), ("p3",)], "path string")
    assert {tuple(r) for r in C.files_with_issues(at, out.filter("path in ('p0', 'p2', 'p3')"), told).collect()} == {("p3", "unverified"), ("x1", "unmatched"), ("x2", "unreadable"), ("x9", "described")}
    assert {(r["block"], r["name"], r["documents"]) for r in C.to_do(out, sections).collect()} == {("create", "New kind", 1), ("permit", "tab", 2)}


def test_outcomes_of_answer_files(spark):
    tasks = spark.createDataFrame([("f1",), ("f2",), ("f3",), ("f4",), ("f1",)], "formId string")
    answers = spark.createDataFrame([("f1.json", "f1", "T", None), ("f2.json", "f9", "U", None), ("f3.json", None, None, "not JSON"), ("f7.json", "f7", "V", None)], "file string, formId string, title string, fault string")
    got = {(r["formId"], r["outcome"], r["title"]) for r in M.answer_outcomes(tasks, answers, "formId").collect()}
    assert got == {("f1", "answered", "T"), ("f2", "wrong id", None), ("f3", "unreadable", None), ("f4", "missing", None)}
    blocks = spark.createDataFrame([("```form-review\n{\"a\":1}\n```",), ("none",), ("```form-review\n{oops\n```",), (None,)], "t string")
    assert [r[0] for r in blocks.select(M.fenced_fault(F.col("t"), "form-review")).collect()] == [None, "no block", "not JSON", "no block"]
    sheets = M.data_sheets(spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "itemtable string, identifier string, v int"), {"a": "code", "b": "number"})
    assert sheets["a"].columns == ["code", "v"] and [tuple(r) for r in sheets["b"].collect()] == [("y", 2)]
    head, more = M.shown(spark.range(10), 4)
    assert head.count() == 4 and more == 6


def test_first_answers_count(spark):
    tasks = spark.createDataFrame([("a",), ("b",)], "readingid string")
    back = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("x", 1, "other")], "readingid string, n int, v string")
    assert {(r["readingid"], r["v"]) for r in A.first_answers(tasks, back, "readingid", ["n"]).collect()} == {("a", "early"), ("b", None)}
    fault = lambda received, quote: spark.range(1).select(A.answer_fault(F.lit(received).cast("boolean"), F.lit("a long enough text"), F.lit(quote))).first()[0]
    assert fault(False, "a long enough") == "not received" and fault(None, "a long enough") is None and fault(True, "x") == "quote too short"
    reader = A.PhraseReader(spark.createDataFrame([("Safety Sheet", "t1"), ("sheet", "t2"), ("allergen", "t3"), (None, "t4")], "phrase string, documenttemplateid string"))
    told = spark.createDataFrame([("a", "the SAFETY  sheet"), ("b", "nothing"), ("c", None), ("d", "Allergens")], "readingid string, text string")
    assert {(r["readingid"], r["documenttemplateid"], r["quote"], r["confidence"]) for r in reader(told).collect()} == {("a", "t1", "safety sheet", 0.5), ("b", None, None, None), ("c", None, None, None), ("d", "t3", "allergen", 1.0)}


def test_patterns_of_branches(spark):
    names = spark.createDataFrame([("12_AB.pdf",), ("Größe-7",), ("x",)], "name string")
    for pattern, want in ((r"^(\d+)_", ["12", "", ""]), (r"\w+-\d\Z", ["", "Größe-7", ""]), (r"\\(x)?", ["", "", ""])):
        import re

        group = 1 if re.compile(pattern).groups else 0
        assert [r[0] for r in names.select(F.regexp_extract("name", J.java_pattern(pattern), group)).collect()] == want
    for bad in ("(?<=a)b", "(?P<n>x)", "(a)?(?(1)b|c)", "("):
        with pytest.raises(ValueError):
            J.java_pattern(bad)


def test_several_items_are_named(spark):
    items = spark.createDataFrame([("t", f"i{k}", "A", f"n{k}", "", False) for k in range(5)] + [("t", "j", "b", "only", "", False)], "itemtable string, id string, identifier string, name string, template string, archived boolean")
    files = spark.createDataFrame([("A/x", ["A"], "x"), ("a/x", ["a"], "x"), ("B/x", ["B"], "x"), ("c/x", ["c"], "x")], "path string, folders array<string>, name string")
    got = {r["path"]: r for r in J.resolve(J.identify(files, [J.Branch("", "t", level=1)]), items).collect()}
    assert got["A/x"]["why"] == "ambiguous" and got["A/x"]["names"] == "i0 (n0), i1 (n1), i2 (n2)" == got["a/x"]["names"]
    assert got["B/x"]["how"] == "case-blind" and got["B/x"]["names"] is None and got["c/x"]["why"] == "unmatched"
    assert [r[0] for r in W.unknown_tables(spark.createDataFrame([("t",), ("u",)], "itemtable string"), items.select("itemtable")).collect()] == ["u"]


def test_files_are_converted(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Grüße")
    (tmp_path / "b.HTML").write_text("<p>x &amp; y</p><style>z</style>")
    (tmp_path / "c.docx").write_bytes(b"%PDF-1.4 body")
    (tmp_path / "d.xyz").write_bytes(b"??")
    (tmp_path / "e #%20.bad").write_bytes(b"x")

    def broken(content):
        raise RuntimeError("cannot")

    paths = S.list_files(spark, str(tmp_path)).select("path").unionByName(spark.createDataFrame([(f"file:{tmp_path}/gone.txt",)], "path string"))
    got = {r["path"].rsplit("/", 1)[-1]: (r["ext"], (r["text"] or "").split() or None, r["error"]) for r in S.convert(paths, {"pdf": lambda c: "pdf text", "bad": broken}).collect()}
    assert got == {
        "a.txt": ("txt", ["Grüße"], None), "b.HTML": ("html", ["x", "&", "y"], None), "c.docx": ("pdf", ["pdf", "text"], None), "d.xyz": ("xyz", None, "unsupported"), "e #%20.bad": ("bad", None, "RuntimeError: cannot"),
        "gone.txt": ("txt", None, "missing"),
    }
    for name, content in (("l1.json", '["/x/a", "/x/b"]'), ("l2.json", '{"documents": [{"path": "/x/a", "sha": "1"}, {"path": "/x/b"}]}'), ("l3.json", '[{"path": "/x/a"}, {"path": "/x/b"}, {"path": null}]')):
        (tmp_path / name).write_text(content)
        assert {r[0] for r in S.listed_inputs(spark, str(tmp_path / name)).collect()} == {"/x/a", "/x/b"}
    assert {tuple(r) for r in S.existing(spark.createDataFrame([("a",), ("b",)], "path string"), spark.createDataFrame([("a",)], "path string")).collect()} == {("a", True), ("b", False)}
    cache = spark.createDataFrame([("s1",)], "sha string")
    assert [r[0] for r in S.to_convert(spark.createDataFrame([("s1",), ("s2",)], "sha string"), cache).collect()] == ["s2"]
    with pytest.raises(ValueError):
        S.pages_to_render("0", F.lit(3), 40)


def test_ends_by_fill_never_overlap(spark):
    for n, want in ((14, 0), (15, 1), (16, 2), (17, 2), (18, 4), (19, 4), (40, 4)):
        rows = [("f", f"s{i:02d}", 0.5, i / 100) for i in range(n)]
        shown = V.shown_members(spark.createDataFrame(rows, "form string, sha string, fit double, filled double")).collect()
        assert len({r["sha"] for r in shown}) == len(shown) and sum(r["block"] == "filled" for r in shown) == want


def test_edges_are_those_of_a_full_comparison(spark):
    rng = random.Random(2)
    signed = {f"s{i:03d}": sorted(set(rng.choices("ABCDEFGHIJKLMNOP", k=rng.randint(0, 9)))) for i in range(90)}
    df = spark.createDataFrame(list(signed.items()), "sha string, signature array<string>")
    members, classes = L.signature_classes(df)
    of = {r["sha"]: r["class"] for r in members.collect()}
    assert of == {s: min(x for x in signed if signed[x] == v) if v else s for s, v in signed.items()}
    for t in (Fraction(11, 20), Fraction(1, 3), Fraction(1)):
        keys = sorted({of[s] for s in signed if signed[s]})
        want = {(a, b) for a in keys for b in keys if a < b and len(set(signed[a]) & set(signed[b])) >= t * len(set(signed[a]) | set(signed[b]))}
        assert {(r["a"], r["b"]) for r in L.similarity_edges(classes, t).collect()} == want
    assert L.as_fraction(0.55) == Fraction(11, 20)


def test_edges_of_few_words_are_held_against_each_other_and_not_listed(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"W{k:02d}" for k in range(40)]
    signed = {f"s{i:03d}": sorted(rng.sample(words, rng.randint(12, 30))) for i in range(150)}
    classes = spark.createDataFrame([(s, v) for s, v in signed.items()], "class string, signature array<string>")
    t = Fraction(11, 20)
    both = lambda a, b: (len(set(signed[a]) & set(signed[b])), len(set(signed[a]) | set(signed[b])))
    want = {(a, b, *both(a, b)) for a in signed for b in signed if a < b and both(a, b)[0] >= t * both(a, b)[1]}
    assert len(want) > 50
    monkeypatch.setattr(L, "BIT_WORDS", 0)
    assert {tuple(r) for r in L.similarity_edges(classes, t).collect()} == want
    # Words that all have select nothing: lists of them may not be joined.
    monkeypatch.setattr(L, "BIT_WORDS", 20_000)
    for sent, rows in ((65_536, 2048), (1, 16)):
        monkeypatch.setattr(L, "SENT", sent)
        monkeypatch.setattr(L.B, "ROWS", rows)
        edges = L.similarity_edges(classes, t)
        assert {tuple(r) for r in edges.collect()} == want
        plan = edges._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
    assert L.similarity_edges(classes.limit(0), t).count() == 0


def test_joined_words_in_forms(spark):
    rows = [("a", "s1", "SAFETYDATASHEET"), ("a", "s2", "SAFETY"), ("a", "s2", "DATA"), ("a", "s2", "SHEET"), ("b", "s3", "SAFETYDATASHEET"), ("b", "s4", "SAFETY")]
    members = spark.createDataFrame([(f, s) for f, s, _ in rows], "form string, sha string").distinct()
    words = spark.createDataFrame([(s, w) for _, s, w in rows], "sha string, word string")
    got = {(r["form"], r["word"], r["documents"]) for r in O.inside_words(members, words, FormOptions(inside_share=0.9)).collect()}
    assert got == {("a", "SAFETY", 2), ("a", "DATA", 2), ("a", "SHEET", 2)}
    texts = spark.createDataFrame([("s1", "a", "\n".join(["MyTitle here"] + [""] * 8 + ["SafetyData 12.5 SAFETYDATASHEET, OTHERDATASHEET"]))], "sha string, form string, text string")
    parts = spark.createDataFrame([("SAFETYDATASHEET", p) for p in ("SAFETY", "DATA", "SHEET")] + [("OTHERDATASHEET", p) for p in ("OTHER", "DATA", "SHEET")], "word string, part string")
    keep = spark.createDataFrame([("a", w) for w in ("SAFETY", "DATA", "SHEET")], "form string, word string")
    assert {(r["line"], r["view"]) for r in O.structure_view(texts, keep, parts).collect()} == {(0, "MY TITLE HERE"), (9, "SAFETY DATA _ SAFETYDATASHEET , _")}


def test_more_than_ninety_nine_forms(spark):
    signed = spark.createDataFrame([(f"s{k:03d}", ["A"]) for k in range(120)], "sha string, signature array<string>")
    clusters = signed.select("sha", F.col("sha").alias("seed"), F.lit(1.0).alias("fit"))
    got = {r["formno"]: r["short"] for r in O.number_forms(clusters, signed).collect()}
    assert got[1] == "f01" and got[99] == "f99" and got[120] == "f120" and len(set(got.values())) == 120


def test_full_case_folding(spark):
    from paperloom.functions.text import casefold

    texts = ["Straße", "STRASSE", "ΛΟΓΟΣ", "λόγος", "ﬁne", "ſun", "ẞ", "ı", "İ", "ABC", "", None, "Ǆ"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(casefold(F.col("t"))).collect()]
    assert got == [t.casefold() if t is not None else None for t in texts]
