import pytest

from paperloom.operators import progress as P


def test_when_to_speak():
    due = P.Cadence().due
    assert not due(29, 0) and due(30, 0) and not due(299, 1) and due(300, 1) and not due(899, 5) and due(900, 5)


def test_words():
    assert [P.duration(s) for s in (0, 42, 600, 3723, 90_000)] == ["PT0S", "PT42S", "PT10M", "PT1H2M3S", "PT25H"]
    assert P.remaining(0, 10, 5) is None and P.remaining(5, 10, 60) == 60
    assert P.status("Read", 0, 5000, 1) == "Read: 0% (0/5,000), elapsed PT1S"
    assert P.status("Read", 2500, 5000, 600) == "Read: 50% (2,500/5,000), elapsed PT10M, remaining PT10M"
    assert P.status("Read", 0, 0, 1) == "Read: 100% (0/0), elapsed PT1S"


def test_stops():
    with pytest.raises(SystemExit, match="branches"):
        P.require(items=True, branches=False)
    with pytest.raises(SystemExit, match="ZeroDivisionError"):
        P.guarded(lambda: 1 / 0)
    with pytest.raises(SystemExit, match="own words"):
        P.guarded(lambda: (_ for _ in ()).throw(SystemExit("own words")))


def test_told(spark):
    said = []
    with P.told(spark, "Counting", said.append, P.Cadence(0, 0, 0), every=0.01):
        spark.range(10).count()
    assert said[0] == "Counting: started" and said[-1].startswith("Counting: ended after PT")
