"""Folders of files: listing, content hashes, what the bytes say, the kind of a record."""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.text import casefold, letters, strip
from paperloom.options import ReadingOptions

# First bytes of a file, in hexadecimal, and the suffix they stand for.
SIGNATURES = [
    ("25504446", "pdf"), ("504B0304", "zip"), ("D0CF11E0A1B11AE1", "ole"), ("FFD8FF", "jpg"), ("89504E470D0A1A0A", "png"), ("47494638", "gif"), ("49492A00", "tif"), ("4D4D002A", "tif"),
]
# Suffixes of pictures, of text that is read as it is, of old and new office files.
IMAGES = ("jpg", "jpeg", "png", "gif", "tif", "tiff", "bmp", "webp")
PLAIN = ("txt", "md", "csv", "tsv", "json", "xml", "html", "htm")
OLD_OFFICE, NEW_OFFICE = ("doc", "xls", "ppt"), ("docx", "xlsx", "pptx")


def list_files(spark: SparkSession, folder: str, own_output: str = "") -> DataFrame:
    """path and length of each file below the folder; contents are not read.  The engine's own output is left out."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    return found.filter(casefold(name) != own_output.casefold()) if own_output else found


@contextmanager
def opened(path: str):
    """A file to read from, by its address as listings give it (nothing in it is escaped), on whichever file system."""
    scheme = re.match(r"([a-z][a-z0-9+.-]*):", path)
    if scheme is None or scheme.group(1) == "file":
        with open(path if scheme is None else "/" + path[5:].lstrip("/"), "rb") as f:
            yield f
    else:
        from pyarrow.fs import FileSystem

        system, name = FileSystem.from_uri(path)
        with system.open_input_stream(name) as f:
            yield f


def listed_inputs(spark: SparkSession, target: str, own_output: str = "") -> DataFrame:
    """The paths of a folder, or those a ``.json`` list names: paths, or objects with a path, bare or under documents."""
    if not target.lower().endswith(".json"):
        return list_files(spark, target, own_output).select("path")
    raw = spark.read.text(target, wholetext=True)
    # Both shapes of a list, bare or under "documents"; objects that are asked for their text give it whole.
    bare = F.from_json("value", "array<string>")
    held = F.from_json(F.get_json_object("value", "$.documents"), "array<string>")
    entry = F.explode(F.coalesce(held, bare)).alias("entry")
    path = F.when(F.col("entry").startswith("{"), F.get_json_object("entry", "$.path")).otherwise(F.col("entry"))
    return raw.select(entry).select(path.alias("path")).filter(F.col("path").isNotNull())


def existing(wanted: DataFrame, listed: DataFrame) -> DataFrame:
    """Each wanted path once, with whether it is there."""
    return wanted.select("path").distinct().join(listed.select("path").distinct().withColumn("there", F.lit(True)), "path", "left").withColumn("there", F.coalesce("there", F.lit(False)))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for path in b.column(0).to_pylist():
            digest, head = hashlib.sha256(), b""
            with opened(path) as f:
                while part := f.read(1 << 20):
                    head = head or part[:8]
                    digest.update(part)
            out.append((path, digest.hexdigest(), head.hex().upper()))
        yield pa.RecordBatch.from_pylist([dict(zip(("path", "sha", "head"), r)) for r in out], pa.schema([("path", pa.string()), ("sha", pa.string()), ("head", pa.string())]))


def hash_files(spark: SparkSession, folder: str, excluded: DataFrame | None = None, own_output: str = "") -> DataFrame:
    """path, sha and first bytes of each file; excluded paths are dropped before any content is read.

    Contents are read in parts where the file's row is, so a file may be of any size and no path goes through the driver.
    """
    listed = list_files(spark, folder, own_output).select("path")
    kept = listed if excluded is None else listed.join(excluded.select("path").distinct(), "path", "left_anti")
    return kept.mapInArrow(_hashes, "path string, sha string, head string")


def sniff(head: Column) -> Column:
    """The suffix that the first bytes stand for; null if none.  head: hexadecimal."""
    out = None
    for start, ext in SIGNATURES:
        out = F.when(head.startswith(start), ext) if out is None else out.when(head.startswith(start), ext)
    return out


def true_extension(ext: Column, head: Column) -> Column:
    """The suffix to read a file by where name and bytes disagree."""
    said = sniff(head)
    new = {o: n for o, n in zip(OLD_OFFICE, NEW_OFFICE)}
    e = F.when((said == "pdf") & (ext != "pdf"), F.lit("pdf"))
    for old, modern in new.items():
        e = e.when((said == "ole") & (ext == modern), F.lit(old)).when((said == "zip") & (ext == old), F.lit(modern))
    return e.otherwise(ext)


def kind_of(ext: Column, text: Column, error: Column, pages: Column, options: ReadingOptions = ReadingOptions()) -> Column:
    """What a record is: missing, image, unsupported, failed, empty, text, image-only or sparse-text.

    text: what a converter found (null where there is none); error: why it failed; pages: of a PDF.
    """
    some = F.length(strip(F.coalesce(text, F.lit(""))))
    per_page = F.coalesce(letters(text), F.lit(0)) / F.greatest(F.coalesce(pages, F.lit(1)), F.lit(1))
    return (
        F.when(error == "missing", "missing").when(ext.isin(*IMAGES), "image").when(ext.isin(*OLD_OFFICE) | (error == "unsupported"), "unsupported")
        .when(error.isNotNull() & F.coalesce(pages > 0, F.lit(False)), "image-only").when(error.isNotNull(), "failed")
        .when((ext != "pdf") & (some > 0), "text").when(ext != "pdf", "empty")
        .when(per_page >= options.letters_per_page, "text").when(some == 0, "image-only").otherwise("sparse-text")
    )


def capped(text: Column, most: int) -> Column:
    """Beginning and end of a text over the limit, with a note of what is left out between; 0 is no limit."""
    if most == 0:
        return text
    # Least limit 200, share of the end 0.25.
    if most < 200:
        raise ValueError("a text cannot be capped below 200 characters")
    n = F.length(text)
    note = F.concat(F.lit("\n\n[... "), (n - most).cast("string"), F.lit(" characters left out ...]\n\n"))
    budget = F.lit(most) - F.length(note)
    tail = F.floor(budget * 0.25).cast("int")
    return F.when(n <= most, text).otherwise(F.concat(F.substring(text, F.lit(1), budget - tail), note, F.right(text, tail)))


def slug(path: Column) -> Column:
    """A name for a file's text that no other file has: 8 digits of the path's hash and its cleaned stem."""
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.left(F.regexp_replace(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), r"[^A-Za-z0-9._-]+", "_"), F.lit(60))
    return F.concat(F.left(F.sha2(path, 256), F.lit(8)), F.lit("_"), F.when(strip(stem) == "", "document").otherwise(stem))


def to_convert(hashed: DataFrame, cache: DataFrame) -> DataFrame:
    """Files whose content has not been read yet; the cache is keyed by content, so an edited file is read anew."""
    return hashed.join(cache.select("sha").distinct(), "sha", "left_anti")


#: Turns the bytes of a file into its text; raises where it cannot.
Converter = Callable[[bytes], str]


def read_plain(content: bytes) -> str:
    return content.decode("utf-8", errors="replace")


def read_web_page(content: bytes) -> str:
    """The text of a web page: scripts and styles left out, tags as spaces."""
    bare = re.sub(r"(?is)<(script|style).*?</\1>", " ", read_plain(content))
    return html.unescape(re.sub(r"<[^>]+>", " ", bare))


#: What is read without further packages; converters of other kinds are given beside these.
CONVERTERS: dict[str, Converter] = {**{ext: read_plain for ext in PLAIN}, "html": read_web_page, "htm": read_web_page}
#: Characters of a reason why a file could not be read.
MOST_REASON = 200


def convert(paths: DataFrame, converters: dict[str, Converter] | None = None) -> DataFrame:
    """(path, ext, text, error): what a converter makes of each file; exactly one of text and error is null.

    paths: path.  The converter is that of the suffix; where none is there, or it fails, that of the suffix that the
    first bytes stand for.  Without either the error is ``unsupported``, for a file that is gone ``missing``, else what
    the converter said.  converters: by suffix, beside those that are built in, whose places they take.
    """
    known = {**CONVERTERS, **(converters or {})}

    def one(path: str) -> dict:
        name = path.rsplit("/", 1)[-1]
        ext = name.rsplit(".", 1)[-1].lower() if "." in name[1:] else ""
        try:
            with opened(path) as f:
                content = f.read()
        except FileNotFoundError:
            return {"path": path, "ext": ext, "text": None, "error": "missing"}
        head = content[:8].hex().upper()
        said = next((e for start, e in SIGNATURES if head.startswith(start)), None)
        error = "unsupported"
        for suffix in dict.fromkeys((ext, said)):
            if suffix in known:
                try:
                    return {"path": path, "ext": suffix, "text": known[suffix](content), "error": None}
                except Exception as x:  # whatever a plugged-in converter raises is the file's reason
                    error = f"{type(x).__name__}: {x}"[:MOST_REASON]
        return {"path": path, "ext": ext, "text": None, "error": error}

    schema = pa.schema([("path", pa.string()), ("ext", pa.string()), ("text", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([one(path)], schema)

    return paths.select("path").mapInArrow(run, "path string, ext string, text string, error string")


def plain_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of the files of a folder that are text already or web pages."""
    return convert(list_files(spark, folder)).filter(F.col("text").isNotNull()).select("path", "text")


def pages_to_render(value: str, pages: Column, most: int) -> Column:
    """How many pages from the front are rendered: ``none``, ``first``, ``all`` (up to the most) or a number of them."""
    words = {"none": 0, "first": 1, "all": most}
    if value not in words and not (value.isdecimal() and int(value) > 0):
        raise ValueError(f"pages are none, first, all or a number from 1 on, not {value!r}")
    return F.least(F.coalesce(pages, F.lit(0)), F.lit(words[value] if value in words else int(value)))
