import random
from types import SimpleNamespace

import numpy as np

from paperloom.llm.boost import Boosted
from paperloom.llm.pages import division, fit_joins, is_furniture, lines_of
from paperloom.llm import scans as S
from paperloom.llm.scans import CONFUSED, candidates, path_of, repaired, scan_faults, vouched

WORDS = "the responsible authority identifies a documented contamination threshold during storage while inspector records packing material for every batch under normal conditions".split()


def page_texts(n, seed=0):
    """Scans with planted faults: texts and {(key, line, fault)}."""
    rng = random.Random(seed)
    rows, truth = [], set()
    for key in range(n):
        lines, faults, firm = [], set(), f"{rng.choice(['Vel', 'Mon', 'Tar'])}{rng.choice(['dex', 'sol', 'phor'])} Works"
        lines += ["COLD CHAIN RECORD", ""]
        for page in range(1, 4):
            k = 0
            while k < 8:
                words = rng.choices(WORDS, k=9)
                line = " ".join(words)
                roll = rng.random()
                if roll < 0.15 and k < 7:
                    w = rng.choice(["contamination", "responsible", "conditions"])
                    at = rng.randint(3, len(w) - 3)
                    lines.append(f"{line} {w[:at]}{rng.choice('-¬')}")
                    faults.add((len(lines), "broken"))
                    lines.append(f"{w[at:]} {line}")
                    k += 2
                    continue
                if roll < 0.18:
                    words[4] = rng.choice(["rcsponsible", "auth0rity", "durinq", "rnaterial", "batcb"])
                    line = " ".join(words)
                    faults.add((len(lines) + 1, "misread"))
                lines.append(line)
                k += 1
            lines.append(f"{firm}, Norvale, printed copy not controlled")
            faults.add((len(lines), "furniture"))
            lines.append(f"Page {page} of 3")
            faults.add((len(lines), "furniture"))
            lines.append("\f")
        rows.append((key, "\n".join(lines)))
        truth |= {(key, a, b) for a, b in faults}
    return rows, truth


def test_planted_faults_are_found(spark):
    rows, truth = page_texts(160)
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "w " * 20_000)]
    df = spark.createDataFrame(rows, "key bigint, text string")
    got = {tuple(r) for r in scan_faults(df)[0].select("key", "lineno", "fault").collect() if r[0] < 1000}
    for fault in ("furniture", "broken", "misread"):
        mine, theirs = {x for x in got if x[2] == fault}, {x for x in truth if x[2] == fault}
        assert len(mine & theirs) >= 0.97 * len(theirs), fault
        assert len(mine & theirs) >= 0.97 * len(mine), fault


def test_repair(spark):
    rows, _ = page_texts(40)
    texts = {r["key"]: r["text"] for r in repaired(spark.createDataFrame(rows, "key bigint, text string")).collect()}
    assert len(texts) == 40
    for t in texts.values():
        assert t.startswith("COLD CHAIN RECORD\n\n") and "Page" not in t and "¬" not in t and "printed copy" not in t and "durinq" not in t


def test_no_texts(spark):
    df = spark.createDataFrame([], "key bigint, text string")
    assert scan_faults(df)[0].count() == 0 and repaired(df).count() == 0


def test_numbers_after_a_colon_are_content():
    known = frozenset(WORDS)
    lines = lines_of("Title\nsome words stand here and go on for a while.\nBags per layer:\n67\n\nmore words stand here and go on for a while.", known)
    assert not any(is_furniture(lines, {}, Boosted()))


def test_pairs_of_lines():
    words = {w: 50 for w in WORDS} | {"functional": 5, "cross": 5, "contamination": 9, "well": 7}
    compounds = {"cross-functional": 4, "well-documented": 3, "re-evaluated": 5}
    joins = fit_joins(words, compounds, 1000, Boosted(rounds=40))
    told = lambda *pair: joins.breaks(*pair, words, compounds)
    assert not told("cross", "-", "functional") and not told("re", "-", "evaluated") and not told("well", "-", "documented")
    assert not told("storage", "-", "Material")
    assert told("contam", "-", "ination.") and told("respons", "‐", "ible") and told("Ruv", "¬", "leduvex") and told("Drasmo", "-", "phor")
    assert division("a line that ends in contam- ") == ("contam", "-") and division("no mark") is None and division("dash -") is None


def test_confusions():
    assert path_of("durinq", "during") == (1, 0) and path_of("rnaterial", "material") == (1, 0) and path_of("abc", "abd")[1] == 1
    assert "during" in vouched({"during": 500, "durinq": 3}) and "durinq" not in vouched({"during": 500, "durinq": 3})


def test_candidates_hold_the_original(spark):
    words = spark.createDataFrame([("durinq",), ("zzzzzz",)], "word string")
    assert {r["word"]: r["near"] for r in candidates(words, ["during", "storage"]).collect()} == {"durinq": ["during"]}


def test_every_near_word_is_a_candidate(spark):
    near = ["tnat", "tnatea"] + [f"tnate{c}" for c in "bcdefghijklmnopqrstuvwxyz"]
    words = spark.createDataFrame([("tnate",)], "word string")
    assert set(candidates(words, [*near, "mate"]).first()["near"]) >= {*near, "mate"}


def test_one_confusion_away_is_a_candidate(spark):
    rng, pairs = random.Random(2), set()
    for seen, real in CONFUSED:
        for n in (0, 1, 2, 5):
            a, b = ("".join(rng.choices("abcdefgh", k=k)) for k in (n, rng.randint(1, 3)))
            pairs.add((a + seen + b, a + real + b))
    words = spark.createDataFrame([(w,) for w in sorted({s for s, _ in pairs})], "word string")
    got = {r["word"]: set(r["near"]) for r in candidates(words, sorted({r for _, r in pairs})).collect()}
    assert [(s, r) for s, r in sorted(pairs) if r not in got.get(s, ())] == []


def test_two_characters_for_one_meet_the_trees_among_nearer_words(spark, monkeypatch):
    rows = [[a, b, *[float(x) for x in np.random.default_rng(k).random(10)]] for k in range(20) for a in range(3) for b in range(4)]
    monkeypatch.setattr(S, "fit_ranking", lambda *_: Boosted().fit(np.array(rows), np.array([int(r[0] == 1 and r[1] == 0) for r in rows])))
    words = {"mate": 100, "tate": 100, "nate": 100, "inate": 100, "tnat": 100, "tnates": 100}
    found = S.corrections(spark.createDataFrame([("tnate", 1, False)], "word string, n bigint, sign boolean"), SimpleNamespace(words=words, trusted=frozenset(words)))
    assert [(r["word"], r["replacement"]) for r in found.collect()] == [("tnate", "mate")]


def test_candidates_are_those_of_a_full_comparison(spark):
    rng = random.Random(11)
    names = sorted({"".join(rng.choices("abcdeinrstu", weights=[5, 1, 2, 2, 9, 6, 6, 5, 5, 5, 2], k=rng.randint(2, 12))) for _ in range(300)})
    seen = sorted({"".join(c if rng.random() > 0.15 else rng.choice("abcde1") for c in rng.choice(names)) for _ in range(80)} | {"x" * 300, "q", "e" * 60})
    got = {r["word"]: set(r["near"]) for r in candidates(spark.createDataFrame([(w,) for w in seen], "word string"), names).collect()}
    for w in seen:
        a = S.grams(w)
        want = {v for v in names for b in [S.grams(v)] if abs(len(a) - len(b)) <= S.LENGTHS and len(a & b) >= S.enough(len(a), len(b))}
        assert want <= got.get(w, set()), (w, want - got.get(w, set()))


def test_invented_names_with_a_sign_are_read_with_letters(spark):
    words = {w: 50 for w in "material storage moisture declaration certificate supplier temperature analysis document reference approval container".split()}
    known = SimpleNamespace(words=words, trusted=frozenset(words))
    rows = [("quilm0vigel", 1, True), ("mater1al", 1, True), ("zorvexil", 1, False), ("suppl1er", 2, True)]
    found = {r["word"]: r["replacement"] for r in S.corrections(spark.createDataFrame(rows, "word string, n bigint, sign boolean"), known).collect()}
    assert found["quilm0vigel"] == "quilmovigel" and found["mater1al"] == "material" and found["suppl1er"] == "supplier" and "zorvexil" not in found


def test_runs_of_plain_lines():
    from paperloom.llm.pages import Line, plain_runs

    line = lambda text, gap=False: Line(1, text, text, gap=gap)
    lines = [line("A"), line("B"), line("this is some prose here"), line("C", gap=True), line("D"), line("E."), line("F")]
    assert plain_runs(lines) == [2, 2, 0, 1, 1, 0, 1] and plain_runs([]) == []


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(int)
    model = Boosted().fit(x[:1500], y[:1500])
    assert ((model.probability(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95
    assert Boosted().probability(np.zeros((1, 4)))[0] <= 0.5
