"""Readers: document folders, records, change logs, sheets, source links."""

from __future__ import annotations

import subprocess
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_schema

RECORD = T.StructType([
    T.StructField("year", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ("entry_id", "presentation_type", "authors_raw", "title", "abstract", "parser_format", "confidence")],
    T.StructField("qa_flags", T.ArrayType(T.StringType())), T.StructField("source_file", T.StringType()), T.StructField("note_extra", T.StringType()),
])
CHANGE = T.StructType([
    T.StructField("year", T.IntegerType()), T.StructField("entry_id", T.StringType()), T.StructField("field", T.StringType()), T.StructField("value", T.StringType()), T.StructField("patch", T.MapType(T.StringType(), T.StringType())),
    T.StructField("add", T.BooleanType()), T.StructField("delete", T.BooleanType()), *[T.StructField(c, T.StringType()) for c in ("presentation_type", "authors_raw", "title", "abstract", "reviewer", "reviewed_at", "delete_reason", "_sheet_hash")],
    T.StructField("_corrupt", T.StringType()),
])
#: Suffixes with a decoder, the best first.
PREFERENCE = ["pdf", "docx", "doc", "txt", "rtf"]
#: Extracted texts below this many characters are suspicious.
LOW_TEXT = 2000


# ---- decoders: content of a file to text; others can be registered ----
def _external(*command: str) -> Callable[[bytes], str]:
    """A tool that reads the file from its standard input."""

    def run(content: bytes) -> str:
        return subprocess.run(command, input=content, capture_output=True, check=True, timeout=300).stdout.decode("utf-8", "replace")

    return run


def _docx(content: bytes) -> str:
    import io
    import re
    import zipfile

    with zipfile.ZipFile(io.BytesIO(content)) as z:
        xml = z.read("word/document.xml").decode("utf-8", "replace")
    text = re.sub(r"<[^>]+>", "", re.sub(r"</w:p>", "\n", re.sub(r"<w:tab/>", "\t", xml)))
    return text.replace("&lt;", "<").replace("&gt;", ">").replace("&quot;", '"').replace("&apos;", "'").replace("&amp;", "&")


def _rtf(content: bytes) -> str:
    import re

    text = re.sub(r"\\par[d]?\b ?", "\n", content.decode("latin-1"))
    text = re.sub(r"\\'([0-9a-f]{2})", lambda m: bytes([int(m.group(1), 16)]).decode("cp1252", "replace"), text)
    return re.sub(r"[{}]", "", re.sub(r"\\[a-z]+-?\d* ?|\\\*", "", text)).strip()


DECODERS: dict[str, Callable[[bytes], str]] = {
    "txt": lambda content: content.decode("utf-8", "replace"),
    "docx": _docx,
    "rtf": _rtf,
    "pdf": _external("pdftotext", "-layout", "-", "-"),
    "doc": _external("antiword", "-"),
}


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """``path, name, stem, suffix, year, content`` of the folder's files that have a
    decoder and a year in their name. Suffixes are taken as they are written."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.url_decode(F.regexp_extract("path", r"([^/]+)$", 1))
    named = files.select("path", name.alias("name"), "content").withColumn("suffix", F.regexp_extract("name", r"\.([A-Za-z0-9]+)$", 1)).withColumn("stem", F.regexp_replace("name", r"\.[A-Za-z0-9]+$", ""))
    year = F.expr("try_cast(nullif(regexp_extract(name, '([0-9]{4})', 1), '') as int)")
    return named.withColumn("year", year).filter(F.col("suffix").isin(list(DECODERS)) & F.col("year").isNotNull())


def best_source(files: DataFrame, overrides: dict[int, str] | None = None) -> DataFrame:
    """One file a year: the override, else the best suffix, else the first name. A
    minimum over each year, so only names are compared and nothing is sorted."""
    prio = F.array_position(F.array(*map(F.lit, PREFERENCE)), F.col("suffix"))
    forced = F.lit(0)
    for y, n in (overrides or {}).items():  # a handful of exceptions
        forced = F.when((F.col("year") == y) & (F.col("name") == n), 1).otherwise(forced)
    rank = F.struct((1 - forced).alias("o"), F.when(prio > 0, prio).otherwise(99).alias("p"), "name")
    best = files.groupBy("year").agg(F.min(rank)["name"].alias("name"))
    return files.join(best, ["year", "name"])


def decode(files: DataFrame) -> DataFrame:
    """``year, name, text, failed``: text in line feeds, a form feed being two; a decoder's failure gives a null text."""
    out = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("text", T.StringType()), T.StructField("failed", T.StringType())])
    schema = arrow_schema(out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for y, n, s, c in zip(*(b.column(i).to_pylist() for i in range(4))):
                try:
                    text, failed = DECODERS[s](c or b""), None
                except Exception as e:  # one bad file must not stop the run
                    text, failed = None, f"{type(e).__name__}: {e}"[:200]
                rows.append({"year": y, "name": n, "text": text, "failed": failed})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    raw = files.select("year", "name", "suffix", "content").mapInArrow(work, out)
    return raw.withColumn("text", normal_ends("text"))


def normal_ends(c) -> F.Column:
    return F.replace(F.regexp_replace(c, r"\r\n?", "\n"), F.lit("\f"), F.lit("\n\n"))


def low_text(docs: DataFrame, least: int = LOW_TEXT) -> DataFrame:
    """Documents whose text is suspiciously short or missing."""
    return docs.filter(F.coalesce(F.length("text"), F.lit(0)) < least).select("year", "name", F.coalesce(F.length("text"), F.lit(0)).alias("chars"))


def gate(docs: DataFrame, least: int = LOW_TEXT) -> None:
    """Raises if a document has too little text."""
    bad = low_text(docs, least).count()
    if bad:
        raise ValueError(f"{bad} documents have fewer than {least} characters")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records as JSON objects, one a line."""
    return spark.read.schema(RECORD).json(path)


def read_concatenated(spark: SparkSession, path: str) -> DataFrame:
    """Records as JSON objects one after another, over lines or on one line. Each
    file is read whole: use ``read_records`` where lines hold one object each."""
    import json

    whole = spark.read.text(path, wholetext=True)
    out = T.StructType([T.StructField("obj", T.StringType())])
    schema = arrow_schema(out)

    def objects(text: str) -> Iterator[str]:
        decoder, at = json.JSONDecoder(), 0
        while at < len(text):
            if text[at].isspace():
                at += 1
                continue
            _, end = decoder.raw_decode(text, at)
            yield text[at:end]
            at = end

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pylist([{"obj": o} for t in b.column(0).to_pylist() for o in objects(t or "")], schema=schema)

    return whole.mapInArrow(work, out).select(F.from_json("obj", RECORD).alias("r")).select("r.*")


def read_changes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The change log with its line numbers, and the lines that are no JSON.

    Lines are numbered through all files of the log in the order of their
    paths, which is the order of the batches ``append_changes`` writes, so
    ``line_no`` is one total order and unique. Blank lines and lines that begin
    with # are comments; they are counted, as every line is. Files are read in
    splits: a line's number is its place in its split after the lines of the
    splits before it, whose counts are a table of one row a split.
    """
    where = ["_file", "_block"]
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    # A task reads a split from its start, so ids ascend by one within it.
    splits = raw.groupBy(*where).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy(*where).rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    lines = raw.join(splits.drop("_n"), where).select((F.col("_before") + F.col("_id") - F.col("_first") + 1).cast("long").alias("line_no"), F.trim("value").alias("line"))
    said = lines.filter("line <> '' and not startswith(line, '#')")
    parsed = said.withColumn("op", F.from_json("line", CHANGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    good = parsed.filter("op._corrupt is null").select("line_no", "op.*").drop("_corrupt")
    return good, parsed.filter("op._corrupt is not null").select("line_no", "line")


def read_sheet(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Sheet tabs as CSV folders, one a year. A tab whose header isn't exactly the
    columns is skipped; short rows are padded with nulls."""
    raw = spark.read.option("header", "false").option("multiLine", "true").option("escape", '"').schema(T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(columns) + 1)])).csv(path)
    rows = raw.withColumn("_file", F.input_file_name())
    header = F.forall(F.zip_with(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(f"_{i}") for i in range(len(columns))]), lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x) & F.col(f"_{len(columns)}").isNull()
    good = rows.filter(header).select("_file").distinct()
    body = rows.join(good, "_file", "left_semi").filter(~header)
    return body.select(*[F.col(f"_{i}").alias("delete_flag" if c == "delete?" else c) for i, c in enumerate(columns)])


def source_links(files: DataFrame, base: str) -> DataFrame:
    """``source_file, link``: each stem's preferred file as a quoted link."""
    order = F.array_position(F.array(*[F.lit(s) for s in ("pdf", "docx", "doc", "rtf", "txt")]), F.lower("suffix"))
    best = files.groupBy("stem").agg(F.min(F.struct(F.when(order > 0, order).otherwise(99).alias("o"), "name"))["name"].alias("name"))
    quoted = F.replace(F.url_encode("name"), F.lit("+"), F.lit("%20"))
    return best.select(F.col("stem").alias("source_file"), F.concat(F.lit(base), quoted).alias("link"))
