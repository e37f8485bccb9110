"""Queries of the general training-data problems, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.changes import apply_changes, changed_fields, fold_changes
from ..operators.copies import diff_copies, prepare
from ..operators.fields import explode_packed
from ..runtime import table

RECORD_FIELDS = ("title", "authors_raw", "abstract", "presentation_type", "note_extra")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changed_fields(fold_changes(table(spark, sf_dir, "records"), table(spark, sf_dir, "corrections")))


def p2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_changes(table(spark, sf_dir, "records"), table(spark, sf_dir, "corrections"), RECORD_FIELDS)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_packed(table(spark, sf_dir, "records"), "ingest_pos", "authors_raw", at_least=2)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = prepare(table(spark, sf_dir, "records"), ["year"], "entry_id", "ingest_pos", {f: f for f in ("title", "authors_raw", "abstract")})
    right = prepare(table(spark, sf_dir, "sheet_rows"), ["year"], "entry_id", "row_no", {"title": "_snapshot_title", "authors_raw": "_snapshot_authors", "abstract": "_snapshot_abstract"})
    out = diff_copies(left, right, ["title", "authors_raw", "abstract"], "only_records", "only_sheet")
    return out.select(F.col("_k0").alias("year"), F.col("_k1").alias("entry_id"), "field_name", "diff_kind")


_KEYED = r"""
ops AS (
  SELECT op_seq, year, regexp_replace(entry_id, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g') AS entry_id, field, value, patch, coalesce("add", false) AS is_add,
         coalesce("delete", false) AS is_del, title, authors_raw, abstract, presentation_type
  FROM corrections),
ok AS (SELECT * FROM ops WHERE year IS NOT NULL AND entry_id <> '' AND op_seq IS NOT NULL),
slots AS (
  SELECT year, entry_id, op_seq, unnest(map_keys(patch)) AS field_name, unnest(map_values(patch)) AS value FROM ok WHERE NOT is_add AND NOT is_del AND patch IS NOT NULL
  UNION ALL SELECT year, entry_id, op_seq, field, value FROM ok WHERE NOT is_add AND NOT is_del AND patch IS NULL AND field IS NOT NULL
  UNION ALL SELECT year, entry_id, op_seq, 'title', title FROM ok WHERE is_add AND NOT is_del
  UNION ALL SELECT year, entry_id, op_seq, 'authors_raw', authors_raw FROM ok WHERE is_add AND NOT is_del
  UNION ALL SELECT year, entry_id, op_seq, 'abstract', abstract FROM ok WHERE is_add AND NOT is_del
  UNION ALL SELECT year, entry_id, op_seq, 'presentation_type', presentation_type FROM ok WHERE is_add AND NOT is_del),
born AS (
  SELECT year, entry_id, -1 AS op_seq FROM records GROUP BY ALL
  UNION ALL SELECT year, entry_id, op_seq FROM ok WHERE is_add AND NOT is_del),
births AS (SELECT year, entry_id, max(op_seq) AS birth FROM born GROUP BY ALL),
deaths AS (SELECT o.year, o.entry_id, min(o.op_seq) AS death FROM ok o JOIN births b USING (year, entry_id) WHERE o.is_del AND o.op_seq > b.birth GROUP BY ALL),
tops AS (
  SELECT s.year, s.entry_id, s.field_name, max(s.op_seq) AS op_seq, arg_max(s.value, s.op_seq) AS value
  FROM slots s JOIN births b USING (year, entry_id) WHERE s.op_seq >= b.birth AND NOT EXISTS (SELECT 1 FROM deaths d WHERE d.year = s.year AND d.entry_id = s.entry_id)
  GROUP BY ALL)
"""

P2_FOUND_SQL = f"""WITH {_KEYED}
SELECT year, entry_id, field_name, op_seq FROM tops
UNION ALL SELECT year, entry_id, '(deleted)' AS field_name, death AS op_seq FROM deaths"""

P4_FOUND_SQL = r"""
WITH l AS (
  SELECT year, entry_id, arg_max(title, ingest_pos) AS title, arg_max(authors_raw, ingest_pos) AS authors_raw, arg_max(abstract, ingest_pos) AS abstract
  FROM (SELECT ingest_pos, year, trim(entry_id) AS entry_id, coalesce(title, '') AS title, coalesce(authors_raw, '') AS authors_raw, coalesce(abstract, '') AS abstract FROM records)
  WHERE year IS NOT NULL AND entry_id <> '' GROUP BY ALL),
r AS (
  SELECT year, entry_id, arg_max(title, row_no) AS title, arg_max(authors_raw, row_no) AS authors_raw, arg_max(abstract, row_no) AS abstract
  FROM (SELECT row_no, year, trim(entry_id) AS entry_id, coalesce(_snapshot_title, '') AS title, coalesce(_snapshot_authors, '') AS authors_raw, coalesce(_snapshot_abstract, '') AS abstract FROM sheet_rows)
  WHERE year IS NOT NULL AND entry_id <> '' GROUP BY ALL),
j AS (
  SELECT coalesce(l.year, r.year) AS year, coalesce(l.entry_id, r.entry_id) AS entry_id, l.year IS NULL AS no_l, r.year IS NULL AS no_r,
         l.title AS lt, r.title AS rt, l.authors_raw AS la, r.authors_raw AS ra, l.abstract AS lb, r.abstract AS rb
  FROM l FULL JOIN r ON l.year = r.year AND l.entry_id = r.entry_id),
v AS (
  SELECT year, entry_id, '' AS field_name, CASE WHEN no_l THEN 'only_sheet' WHEN no_r THEN 'only_records' END AS diff_kind, '' AS x, '' AS y FROM j
  UNION ALL SELECT year, entry_id, 'title', 'differs', lt, rt FROM j WHERE NOT no_l AND NOT no_r
  UNION ALL SELECT year, entry_id, 'authors_raw', 'differs', la, ra FROM j WHERE NOT no_l AND NOT no_r
  UNION ALL SELECT year, entry_id, 'abstract', 'differs', lb, rb FROM j WHERE NOT no_l AND NOT no_r)
SELECT year, entry_id, field_name, diff_kind FROM v
WHERE (field_name = '' AND diff_kind IS NOT NULL)
   OR trim(regexp_replace(nfc_normalize(x), '[\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))
   <> trim(regexp_replace(nfc_normalize(y), '[\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+', ' ', 'g'))
"""

_PACK = ", ".join(f"{f} := {f}" for f in RECORD_FIELDS)
_COLS = ", ".join(f"CASE WHEN t_{f}.op_seq IS NOT NULL THEN t_{f}.value WHEN l.birth < 0 THEN base.s.{f} END AS {f}" for f in RECORD_FIELDS)
_JOINS = " ".join(f"LEFT JOIN (SELECT * FROM tops WHERE field_name = '{f}') t_{f} ON t_{f}.year = l.year AND t_{f}.entry_id = l.entry_id" for f in RECORD_FIELDS)
P2_CURRENT_SQL = f"""WITH {_KEYED},
live AS (SELECT b.year, b.entry_id, b.birth FROM births b WHERE NOT EXISTS (SELECT 1 FROM deaths d WHERE d.year = b.year AND d.entry_id = b.entry_id)),
base AS (SELECT year, entry_id, arg_max(s0, ingest_pos) AS s FROM (SELECT year, entry_id, ingest_pos, struct_pack({_PACK}) AS s0 FROM records) GROUP BY year, entry_id)
SELECT l.year, l.entry_id, {_COLS}
FROM live l LEFT JOIN base ON base.year = l.year AND base.entry_id = l.entry_id {_JOINS}"""

QUERIES = {"p2_found": p2_found, "p2_current": p2_current, "p3_found": p3_found, "p4_found": p4_found}
SQL = {"p2_found": P2_FOUND_SQL, "p2_current": P2_CURRENT_SQL, "p4_found": P4_FOUND_SQL}
