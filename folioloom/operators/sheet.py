"""Round trip of records through reviewers' sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_true, strip

# A sheet's columns in order.
COLUMNS = ["year", "entry_id", "presentation_type", "parser_format", "qa_flags", "source_pdf", "title", "authors_raw", "abstract", "title_fix", "authors_fix", "abstract_fix", "delete?", "reviewer", "notes", "status", "_snapshot_title", "_snapshot_authors", "_snapshot_abstract"]
DONE = ["fixed"]
FIRST_STATUS = "untouched"
FIXES = {"title": "title_fix", "authors_raw": "authors_fix", "abstract": "abstract_fix"}
SNAPSHOTS = {"title": "_snapshot_title", "authors_raw": "_snapshot_authors", "abstract": "_snapshot_abstract"}


def _json_text(c: Column) -> Column:
    """A JSON string literal with non-ASCII characters kept."""
    return F.concat(F.lit('"'), F.replace(F.replace(F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t")), F.lit('"'))


def row_hash(year: Column, entry: Column, title: Column, authors: Column, abstract: Column, delete: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the edit's JSON with sorted keys."""
    part = lambda name, c: F.concat(F.lit(f'"{name}": '), c)
    body = F.concat_ws(", ", part("a", _json_text(authors)), part("ab", _json_text(abstract)), part("d", F.when(delete, "true").otherwise("false")), part("e", _json_text(entry)), part("t", _json_text(title)), part("y", year.cast("string")))
    return F.substring(F.sha2(F.concat(F.lit("{"), body, F.lit("}")), 256), 1, 16)


def hashed_rows(sheet: DataFrame) -> DataFrame:
    """Sheet rows with trimmed edits and their ``hash``; rows without a whole-number year or an id are left out."""
    clean = lambda c: strip(F.coalesce(F.col(c), F.lit("")))
    rows = sheet.withColumn("year", F.expr("try_cast(year as int)")).withColumn("entry_id", clean("entry_id")).filter("year is not null and entry_id <> ''")
    rows = rows.withColumns({f: clean(f) for f in (*FIXES.values(), "notes", "status")} | {"reviewer": F.coalesce(F.nullif(clean("reviewer"), F.lit("")), F.lit("anonymous")), "deleted": is_true("delete_flag")})
    return rows.withColumn("hash", row_hash(F.col("year"), F.col("entry_id"), F.col("title_fix"), F.col("authors_fix"), F.col("abstract_fix"), F.col("deleted")))


def pull(sheet: DataFrame, current: DataFrame, known: DataFrame, pos: str = "row_no") -> DataFrame:
    """What becomes of each sheet row: ``pos, year, entry_id, reviewer, hash, outcome, drift, patch``.

    ``current`` has one row a key, ``known`` a column ``_sheet_hash`` of edits
    applied before. Outcomes in the order tested: ignored (not done), known,
    missing, drifted, delete, patch, unchanged; an edit repeated in the same
    pull counts once, the later rows are repeated. Null snapshots equal ''.
    """
    rows = hashed_rows(sheet)
    seen = known.select(F.col("_sheet_hash").alias("hash")).filter("hash is not null").distinct().withColumn("_seen", F.lit(True))
    now = current.select("year", "entry_id", *[F.coalesce(F.col(f), F.lit("")).alias(f"_now_{f}") for f in FIXES], F.lit(True).alias("_exists"))
    joined = rows.join(seen, "hash", "left").join(now, ["year", "entry_id"], "left")
    drift = F.array_compact(F.array(*[F.when(F.col(f"_now_{f}") != F.coalesce(F.col(s), F.lit("")), F.lit(f)) for f, s in SNAPSHOTS.items()]))
    edits = F.array_compact(F.array(*[F.when((F.col(x) != "") & (F.col(x) != F.col(f"_now_{f}")), F.struct(F.lit(f).alias("key"), F.col(x).alias("value"))) for f, x in FIXES.items()]))
    outcome = (
        F.when(~F.col("status").isin(DONE) & ~F.col("deleted"), "ignored").when(F.col("_seen"), "known").when(F.col("_exists").isNull(), "missing")
        .when(F.size(drift) > 0, "drifted").when(F.col("deleted"), "delete").when(F.size(edits) > 0, "patch").otherwise("unchanged")
    )
    judged = joined.select(pos, "year", "entry_id", "reviewer", "hash", outcome.alias("outcome"), F.array_join(drift, ", ").alias("_d"), edits.alias("_e"))
    first = judged.filter("outcome in ('patch', 'delete')").groupBy("hash").agg(F.min(pos).alias("_first"))
    told = judged.join(first, "hash", "left").withColumn("outcome", F.when(F.col("outcome").isin("patch", "delete") & (F.col(pos) > F.col("_first")), "repeated").otherwise(F.col("outcome")))
    return told.select(pos, "year", "entry_id", "reviewer", "hash", "outcome", F.when(F.col("outcome") == "drifted", F.col("_d")).otherwise("").alias("drift"), F.when(F.col("outcome") == "patch", F.map_from_entries("_e")).alias("patch"))


def pull_counts(pulled: DataFrame) -> DataFrame:
    return pulled.groupBy("outcome").agg(F.count("*").alias("n"))


def changes_of(pulled: DataFrame, today: str) -> DataFrame:
    """Log lines of a pull's edits; the date is passed in so runs can be repeated."""
    return pulled.filter("outcome in ('patch', 'delete')").select("year", "entry_id", "patch", F.when(F.col("outcome") == "delete", True).alias("delete"), "reviewer", F.lit(today).alias("reviewed_at"), F.col("hash").alias("_sheet_hash"))


def push(current: DataFrame, sheet: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Sheet rows of the current records: reviewers' cells kept, the rest
    overwritten and snapshotted. ``sheet`` has one row a key at most; ``links``
    maps source_file to a link."""
    kept = sheet.select("year", "entry_id", *[F.col(c).alias(f"_k_{c}") for c in (*FIXES.values(), "delete_flag", "reviewer", "notes", "status")])
    rows = current.join(kept, ["year", "entry_id"], "left")
    if links is not None:
        rows = rows.join(links.select("source_file", "link"), "source_file", "left")
    keep = lambda c, default="": F.coalesce(F.col(f"_k_{c}"), F.lit(default)).alias(c)
    now = lambda f: F.coalesce(F.col(f), F.lit(""))
    return rows.select(
        "year", "entry_id", now("presentation_type").alias("presentation_type"), now("parser_format").alias("parser_format"), F.array_join(F.coalesce("qa_flags", F.array().cast("array<string>")), ", ").alias("qa_flags"),
        (F.coalesce("link", F.lit("")) if links is not None else F.lit("")).alias("source_pdf"), *[now(f).alias(f) for f in FIXES], *[keep(x) for x in FIXES.values()],
        is_true("_k_delete_flag").alias("delete_flag"), keep("reviewer"), keep("notes"), F.coalesce("_k_status", F.lit(FIRST_STATUS)).alias("status"), *[now(f).alias(s) for f, s in SNAPSHOTS.items()],
    )
