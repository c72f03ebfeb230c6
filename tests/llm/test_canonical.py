import pytest

from paperloom.llm.canonical import Index, edits, map_values

LIST = [("Colour Drift Summary (CDS)", "Colour Drift Summary (CDS)"), ("Shade Shift Summary", "Colour Drift Summary (CDS)"), ("CDS", "Colour Drift Summary (CDS)"), ("Colour Drift Record", "Colour Drift Record"), ("Tank Rinsing Approval", "Tank Rinsing Approval"), ("Drum Liner Summary", "Drum Liner Summary"), ("Endotoxin Record", "Endotoxin Record")]


@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("Colour Drift Summary (CDS)", 0), ("colour  drift\xa0summary", 0), ("Summary of Colour Drift", 0), ("ColourDriftSummary", 0), ("COLUOR DRIFT SUMMARY", 0), ("Colour Drift Summ.", 0), ("Col. Drift Summ.", 0),
        ("C0lour Drift Summary", 0), ("Co\xadlour Drift Sum​mary; FRM-1234; Site North", 0), ("EU / shade shift summary", 0), ("the CDS", 0), ("CDS (Colour Drift)", 0), ("2024 colour drift record rev 3", 3),
        ("Colour Drift Sheet (CDS)", None), ("Colour Drift Sheet", None), ("Tank Painting Approval", None), ("Drum Storage Summary", None), ("Colour Naming Summary", None), ("FRM-1234", None), ("", None), (" - ", None), (None, None),
        ("Endotoxin Record / Tank Rinsing Approval", None),
    ],
)
def test_values(spark, value, want):
    df = spark.createDataFrame([(1, value, "clash")], "id bigint, value string, entry string").select("id", "value")
    got = [r["entry"] for r in map_values(df, ["id"], LIST, 1).collect()]
    assert got == ([] if want is None else [LIST[want][1]])


def test_many_rows_ties_and_no_list(spark):
    df = spark.createDataFrame([(k, "colour drift summary" if k % 2 else "x" * 100_000) for k in range(20)], "id bigint, value string")
    assert map_values(df, ["id"], LIST, 20).count() == 10
    assert map_values(df, ["id"], [], 20).count() == 0
    twice = [("Odour Release Notice", "a"), ("Odour Release Notice", "b")]
    assert map_values(spark.createDataFrame([(1, "odour release notice")], "id bigint, value string"), ["id"], twice, 1).count() == 0
    assert map_values(df.filter("false"), ["id"], LIST, 0).count() == 0


def test_index_reaches_what_a_full_comparison_reaches():
    index = Index(LIST)
    for part in ("coluor drift sumary", "shade shfit summary", "tnk rinsing aproval"):
        near = next(index.candidates([part]))
        assert index.match(part, near) == index.match(part, [(k, dict(near).get(k, 0.0)) for k in range(len(index.words))])


def test_edits():
    assert edits("abcd", "acbd") == 1 and edits("abc", "abc") == 0 and edits("abcdef", "xyz", 2) == 3 and edits("", "ab", 2) == 2


def test_every_phrase_over_the_cosine_is_aligned():
    index = Index([(f"Colour Drift Record {w}", w) for w in "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()])
    assert sorted(k for k, _ in next(index.candidates(["colour drift record"]))) == list(range(16))


def test_cosine_is_that_of_whole_vectors():
    import numpy as np

    from paperloom.llm.canonical import grams

    index = Index(LIST)
    part = "colour shade summary of drums"
    for k, got in next(index.candidates([part])):
        names = sorted(index.at)
        vector = lambda g: np.array([g.count(n) * float(index.idf[index.at[n]]) for n in names])
        a, b = vector(grams(part)), vector(grams(" ".join(index.words[k])))
        assert abs(got - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-5 and got >= 0.3
