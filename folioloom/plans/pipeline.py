"""Whole runs: from document folders to a bibliography, a review queue and statistics.

Each step stays a lazy frame; only what is used twice is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.abstracts import EVENT, clean_abstract
from ..operators import analytics, bibliography, diagnosis, entries, overlay, sheet
from ..runtime import cut
from ..sources import files, sinks

FIELDS = ["title", "authors_raw", "abstract", "presentation_type", "parser_format", "confidence", "source_file", "note_extra"]
#: Entries a year may have; positions are made of year and place.
PER_YEAR = 1_000_000


def extract(spark: SparkSession, folder: str, overrides: dict[int, str] | None = None, least: int = files.LOW_TEXT) -> DataFrame:
    """``year, name, text`` of the best source of each year; raises on suspiciously short texts."""
    docs = cut(files.decode(files.best_source(files.scan(spark, folder), overrides)))
    if least:
        files.gate(docs, least)
    return docs


def records_of(docs: DataFrame, event: str = EVENT) -> DataFrame:
    """Parsed records with cleaned abstracts. Flags are those found before cleaning."""
    parsed = entries.parse_documents(docs, "name", "year", "text").withColumnRenamed("year", "y").drop("y").join(docs.select("name", "year"), "name")
    stem = F.regexp_replace("name", r"\.[A-Za-z0-9]+$", "")
    return parsed.withColumns({"abstract": clean_abstract(F.col("abstract"), event), "source_file": stem, "note_extra": F.lit(None).cast("string"), "ingest_pos": F.col("year").cast("long") * PER_YEAR + F.col("entry_pos")}).drop("name", "entry_pos")


def corrected(records: DataFrame, log: DataFrame, mode: str = "append") -> DataFrame:
    """Records under the change log, by ``row_id``."""
    return overlay.overlay(records, log, FIELDS, mode)


def export(current: DataFrame, years: DataFrame, out: str, event: str = EVENT) -> None:
    """Bibliography, quality report and review queue under ``out``."""
    keys = cut(bibliography.citekeys(current, "row_id"))
    rows = cut(bibliography.entries(current, years, keys, "row_id", clean=False))
    sinks.write_entries(rows, f"{out}/bibliography", pos="row_id")
    queue = cut(diagnosis.review_queue(current, ["row_id", "year", "entry_id"]))
    sinks.write_entries(bibliography.review_text(rows, queue, "row_id"), f"{out}/review", "Review queue", "row_id")
    issues = current.filter(diagnosis.is_issue()).join(keys.select("row_id", "citekey"), "row_id").select("citekey", "year", F.array_join("qa_flags", ", ").alias("flags")).orderBy("citekey")
    text = sinks.report("Quality", {"Summary": diagnosis.quality_summary(current), "By year": diagnosis.quality_by(current, "year").orderBy("year"), "Flags": diagnosis.tag_histogram(queue).orderBy(F.desc("n"), "tag"), "Entries to review": issues}, 100)
    current.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/report")


def statistics(current: DataFrame, least_edge: int = 2, least_node: int = 6) -> DataFrame:
    """The statistics document of the current records. Their order is that of the base rows, then of the log's adds."""
    place = F.substring("row_id", 2, 30).cast("long") + F.when(F.col("row_id").startswith("a"), F.lit(1 << 61)).otherwise(0)
    rows = cut(current.withColumn("ingest_pos", place))
    m = cut(analytics.mentions(rows))
    edges = cut(analytics.co_authors(m, least=least_edge, least_node=least_node))
    return analytics.stats_document(rows, edges, analytics.components(edges), m, least_edge, least_node)


def rebuild(spark: SparkSession, folder: str, log_path: str | None, years: DataFrame, out: str, least: int = files.LOW_TEXT) -> DataFrame:
    """Sources to exports; returns the current records."""
    records = records_of(extract(spark, folder, least=least))
    log = files.read_changes(spark, log_path)[0] if log_path else spark.createDataFrame([], files.CHANGE).drop("_corrupt").withColumn("line_no", F.lit(0).cast("long"))
    current = cut(corrected(records, log))
    export(current, years, out)
    return current


def pull_into_log(sheet_rows: DataFrame, current: DataFrame, log: DataFrame, log_path: str, batch: str, today: str) -> DataFrame:
    """Applies reviewers' finished rows to the log and returns what became of each row. A second pull adds nothing."""
    pulled = cut(sheet.pull(sheet_rows, current, log))
    sinks.append_changes(sheet.changes_of(pulled, today), log_path, batch, today)
    return pulled
