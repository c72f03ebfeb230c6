import hashlib
import json

import pytest
from pyspark.sql import functions as F

from paperloom.sources import files as S
from paperloom.sources import manifests as M
from paperloom.streaming import answers as W


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.pdf").write_bytes(b"%PDF-1.4 hello")
    (tmp_path / "b.docx").write_bytes(b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1rest")
    (tmp_path / "c.html").write_text("<p>Hello <b>there</b></p><script>x()</script>")
    (tmp_path / "out.xlsx").write_bytes(b"mine")
    listed = S.list_files(spark, str(tmp_path), "OUT.xlsx")
    assert {r["path"].rsplit("/", 1)[-1] for r in listed.collect()} == {"x.pdf", "b.docx", "c.html"}
    skip = listed.filter(F.col("path").endswith("c.html"))
    hashed = {r["path"].rsplit("/", 1)[-1]: r for r in S.hash_files(spark, str(tmp_path), skip).collect()}
    assert "c.html" not in hashed and hashed["x.pdf"]["sha"] == hashlib.sha256(b"%PDF-1.4 hello").hexdigest()
    ext = {r[0]: r[1] for r in spark.createDataFrame([("docx", hashed["b.docx"]["head"]), ("txt", hashed["x.pdf"]["head"]), ("md", "AA")], "e string, h string").select("e", S.true_extension(F.col("e"), F.col("h"))).collect()}
    assert ext == {"docx": "doc", "txt": "pdf", "md": "md"}
    texts = {r["path"].rsplit("/", 1)[-1]: r["text"].split() for r in S.plain_texts(spark, str(tmp_path)).collect()}
    assert texts == {"c.html": ["Hello", "there"]}


def test_cap(spark):
    df = spark.createDataFrame([("x" * 1000,), ("short",), (None,)], "t string")
    got = [r[0] for r in df.select(S.capped(F.col("t"), 300)).collect()]
    assert len(got[0]) == 300 and "700 characters left out" in got[0] and got[1:] == ["short", None]
    with pytest.raises(ValueError):
        S.capped(F.col("t"), 100)


def test_manifests(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        M.read_manifest(spark, str(tmp_path / "none.json"), "a int").collect()
    (tmp_path / "m.json").write_text(json.dumps([{"a": 1, "b": ["x"]}], indent=1))
    assert [tuple(r) for r in M.read_manifest(spark, str(tmp_path / "m.json"), "a int, b array<string>").collect()] == [(1, ["x"])]
    (tmp_path / "i.csv").write_text('﻿table,id,identifier,name,template,archived,more\nt,1,"a\nb",,X,no,z\n', encoding="utf-8")
    row = M.read_items(spark, str(tmp_path / "i.csv")).first()
    assert (row["itemtable"], row["identifier"], row["name"]) == ("t", "a\nb", "")
    (tmp_path / "bad.csv").write_text("table,id\nt,1\n")
    with pytest.raises(ValueError):
        M.read_items(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "types.txt").write_text("1: Safety Sheet (SS) | Sheet of Safety\nMore of it\n")
    assert {(r[0], r[2]) for r in M.read_types(spark, str(tmp_path / "types.txt")).collect()} == {(1, "Safety Sheet (SS)"), (1, "Sheet of Safety"), (None, "More of it")}
    answers = tmp_path / "answers"
    answers.mkdir()
    (answers / "a.json").write_text('{"formId": "f1", "title": "T"}')
    (answers / "b.json").write_text("not json")
    assert {(r["file"], r["formId"], r["fault"]) for r in M.read_answers(spark, str(answers), "formId string, title string").collect()} == {("a.json", "f1", None), ("b.json", None, "not JSON")}
    block = spark.createDataFrame([("hello\n```form-review\n{\"formId\": \"f1\"}\n```\n",), ("none",)], "t string").select(M.fenced(F.col("t"), "form-review", "formId string").alias("b"))
    assert [r["b"] and r["b"]["formId"] for r in block.collect()] == ["f1", None]
    assert M.same_export("a/wf_77.json", "b/items_77.csv") and not M.same_export("wf_1.json", "items_2.csv")
    assert M.page("<script>DATA</script>", {"x": "</script>"}, "DATA").count("</script>") == 1
    M.write_tasks(spark.createDataFrame([(1, "x"), (2, "y")], "batch int, v string"), str(tmp_path / "tasks"), "batch")
    assert json.loads(next((tmp_path / "tasks" / "batch=2").glob("*.txt")).read_text()) == {"v": "y"}


def test_answers_arrive(spark, tmp_path):
    inbox, target = tmp_path / "in", tmp_path / "out"
    inbox.mkdir()
    row = lambda r, n, t: json.dumps({"readingId": r, "round": n, "documentTemplateId": t, "quote": t})
    (inbox / "1.json").write_text(row("a", 1, "t1") + "\n" + row("a", 1, "t0") + "\n" + row("b", 1, "t2"))
    for _ in range(2):  # the second run finds nothing new
        W.collect_stream(spark, str(inbox), str(target), str(tmp_path / "cp")).awaitTermination()
    (inbox / "2.json").write_text(row("a", 1, "t9") + "\n" + row("a", 2, "t3"))
    W.collect_stream(spark, str(inbox), str(target), str(tmp_path / "cp")).awaitTermination()
    assert {(r["readingId"], r["round"], r["documentTemplateId"]) for r in W.answers_so_far(spark, str(target)).collect()} == {("a", 1, "t0"), ("a", 2, "t3"), ("b", 1, "t2")}
