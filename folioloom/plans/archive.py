"""Queries of the archive operators on the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import abstracts, authors, text
from ..operators import analytics, bibliography, breakpoints, diagnosis, entries, overlay, segments, sheet
from ..runtime import cut, scratch, spread, table
from ..sources import files, sinks
from ..streaming import log as stream
from . import sqltext as S

QUERIES = {}
SQL: dict[str, str] = {}
FIELDS = ("title", "authors_raw", "abstract", "presentation_type")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def records(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "records")


def texts(spark: SparkSession, d: str) -> DataFrame:
    """Records for work on their texts."""
    return spread(records(spark, d))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"))


def current(spark: SparkSession, d: str) -> DataFrame:
    """The newest row of each key."""
    r = records(spark, d)
    return r.groupBy("year", "entry_id").agg(F.max(F.struct("ingest_pos", *[c for c in r.columns if c not in ("year", "entry_id", "ingest_pos")])).alias("r")).select("year", "entry_id", "r.*")


CURRENT = "(SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY year, entry_id ORDER BY ingest_pos DESC) = 1)"
KEYED_SHEET = f"(SELECT * FROM (SELECT * REPLACE ({S.strip("coalesce(entry_id, '')")} AS entry_id) FROM sheet_rows) WHERE year IS NOT NULL AND entry_id <> '')"


# ---- text ----
@query(f"""SELECT ingest_pos, {S.squeeze('title')} AS title, {S.squeeze('authors_raw')} AS authors, {S.tidy_spaces('abstract')} AS spaces, {S.strip(S.sub('abstract', '[ ' + chr(9) + ']+', ' '))} AS tabs, {S.sub('title', r'[{}\\]')} AS unbraced FROM records""")
def text_spaces(spark, d):
    return texts(spark, d).select("ingest_pos", text.squeeze("title").alias("title"), text.squeeze("authors_raw").alias("authors"), text.tidy_spaces("abstract").alias("spaces"), text.tidy_tabs("abstract").alias("tabs"), text.unbrace("title").alias("unbraced"))


@query(f"SELECT ingest_pos, {S.tidy_block('abstract')} AS block FROM records")
def text_blocks(spark, d):
    return texts(spark, d).select("ingest_pos", text.tidy_block("abstract").alias("block"))


@query(f"SELECT ingest_pos, {S.ascii_only('authors_raw')} AS authors, nfc_normalize(abstract) AS composed FROM records")
def text_ascii(spark, d):
    return texts(spark, d).select("ingest_pos", text.ascii_only("authors_raw").alias("authors"), text.nfc("abstract").alias("composed"))


@query()
def text_plain_typography(spark, d):
    return texts(spark, d).select("ingest_pos", text.plain_typography("abstract").alias("abstract"))


@query(f"""SELECT ingest_pos, ls.i - 1 AS line_no, ls.line AS line, {S.garbage('ls.line')} AS garbage FROM (
  SELECT ingest_pos, unnest(list_zip(range(1, len(l) + 1), l)) AS z FROM (SELECT ingest_pos, regexp_split_to_array(abstract, '\\r\\n|[\\n\\r]') AS l FROM records)) u, LATERAL (SELECT z[1] AS i, z[2] AS line) ls""")
def garbage_lines(spark, d):
    return segments.lines(texts(spark, d), "ingest_pos", "abstract").withColumn("garbage", text.is_garbage_line(F.col("line")))


_LABELLED = "(SELECT ingest_pos, entry_id, translate(translate(entry_id, '01', 'OI'), '58', 'SB') AS seen FROM records)"


@query(f"SELECT ingest_pos, seen, {S.normal_label('seen')} AS label, upper({S.sub('seen', '[^A-Za-z0-9]')}) AS bare, {S.label_kind('seen')} AS kind FROM {_LABELLED}")
def label_normalise(spark, d):
    seen = F.translate(F.translate("entry_id", "01", "OI"), "58", "SB")
    return records(spark, d).select("ingest_pos", seen.alias("seen"), text.normal_label(seen).alias("label"), text.bare_label(seen).alias("bare"), text.label_kind(seen).alias("kind"))


@query(f"SELECT ingest_pos, {S.count_of('title', r'[\p{L}\p{N}_]+')} AS title_words, {S.count_of('abstract', r'[\p{L}\p{N}_]+')} AS abstract_words FROM records")
def word_counts(spark, d):
    return records(spark, d).select("ingest_pos", text.word_count(F.col("title")).alias("title_words"), text.word_count(F.col("abstract")).alias("abstract_words"))


@query()
def clean_abstracts(spark, d):
    return texts(spark, d).select("ingest_pos", abstracts.clean_abstract(F.col("abstract")).alias("abstract"))


# ---- segmentation and parsing ----
_SLOT = r"(?im)^\d{1,2}:\d{2}[ \t]+((?:HP|SS|[TP])\d+)[ \t]+"


@query(f"""SELECT doc_id, i AS block_pos, upper(labels[i]) AS label, {S.tidy_block('pieces[i + 1]')} AS block FROM (
  SELECT doc_id, labels, pieces, unnest(range(1, len(labels) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, {S.q(_SLOT)}, 1) AS labels, regexp_split_to_array(text, {S.q(_SLOT)}) AS pieces FROM documents) WHERE len(labels) > 0)""")
def segment_blocks(spark, d):
    return segments.blocks(documents(spark, d), "doc_id", "text", "slot")


_SECOND = S.strip("coalesce((regexp_split_to_array(block, '\\n\\s*\\n'))[2], '')")


@query(f"""WITH b AS ({SQL['segment_blocks']}), k AS (SELECT *, CASE WHEN length({_SECOND}) >= 80 THEN 1 ELSE 0 END AS p FROM b)
SELECT doc_id, first_pos AS block_pos, label, block FROM (SELECT *, min(block_pos) OVER (PARTITION BY doc_id, label) AS first_pos, row_number() OVER (PARTITION BY doc_id, label ORDER BY p DESC, length(block) DESC, block_pos) AS rn FROM k) WHERE rn = 1""")
def best_blocks(spark, d):
    return segments.best_blocks(segment_blocks(spark, d), "doc_id")


@query(f"SELECT doc_id, source, text FROM documents QUALIFY row_number() OVER (PARTITION BY lower({S.sub('text', r'[^\p{L}\p{N}_]+')}) ORDER BY doc_id) = 1")
def first_copies(spark, d):
    return segments.first_of(documents(spark, d).select("doc_id", "source", "text"), F.lower(F.regexp_replace("text", r"[^\p{L}\p{N}_]+", "")), ["doc_id"])


_HEADING = r"^(?:SESSION .*|Background|Method|Results|Conclusion)$"


@query(f"""SELECT doc_id, line_no, last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS heading FROM (
  SELECT doc_id, z[1] - 1 AS line_no, CASE WHEN regexp_matches(z[2], {S.q(_HEADING)}) THEN z[2] END AS h FROM (
    SELECT doc_id, unnest(list_zip(range(1, len(l) + 1), l)) AS z FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|[\\n\\r]') AS l FROM documents)))""")
def lines_by_heading(spark, d):
    rows = segments.lines(documents(spark, d), "doc_id", "text")
    return segments.fill_down(rows, "doc_id", "line_no", F.when(F.col("line").rlike(_HEADING), F.col("line")), "heading").select("doc_id", "line_no", "heading")


@query()
def parse_abstracts(spark, d):
    return entries.parse_blocks(documents(spark, d), "doc_id", "text")


@query()
def parse_documents(spark, d):
    return entries.parse_documents(documents(spark, d), "doc_id", "year", "text")


@query()
def parse_schedules(spark, d):
    return entries.parse_documents(documents(spark, d), "doc_id", "year", "text", entries.by_time)


# ---- diagnosis ----
def _finding(tag: str, cond: str) -> str:
    return f"SELECT ingest_pos, year, {S.q(tag)} AS tag FROM records WHERE {cond}"


_D = diagnosis
_B, _T, _A = "coalesce(abstract, '')", "coalesce(title, '')", "coalesce(authors_raw, '')"
FINDINGS = " UNION ALL ".join([
    _finding("multi-entry-numerated", S.matches(_B, _D.NUMBERED)), _finding("multi-entry-initials", S.matches(_B, _D.INITIALS)), _finding("multi-entry-allcaps-title", S.matches(_B, _D.CAPITALS)),
    _finding("embedded-schedule", S.matches(_B, _D.SCHEDULE)), _finding("embedded-day-header", f"NOT {S.matches(_B, _D.SCHEDULE)} AND {S.matches(_B, _D.DAY)}"), _finding("triple-newline", S.matches(_B, _D.BLANKS)),
    _finding("page-footer-leak", S.matches(_B, _D.HEAD)), _finding("orphan-pagenum", S.matches(_B, _D.NUMBER_LINE)), _finding("trailing-numeral", S.matches(_B, _D.NUMBER_END)), _finding("abstract-affiliation-head", S.matches(_B, _D.AFFILIATED)),
    _finding("abstract-very-long", f"length({_B}) > 3000"), _finding("abstract-suspicious-long", f"length({_B}) BETWEEN 2201 AND 3000"), _finding("abstract-too-short", f"length({_B}) BETWEEN 1 AND 59"), _finding("title-too-long", f"length({_T}) > 220"),
    _finding("title-is-abstract", S.matches(_T, _D.PROSE)), _finding("title-has-newline", f"contains({_T}, chr(10))"), _finding("author-has-digit", S.matches(_A, "[0-9]")), _finding("author-has-place", S.matches(_A, _D.PLACE)),
    _finding("author-lowercase-initial", S.matches(_A, _D.SMALL_INITIAL)),
])


@query(FINDINGS)
def diagnose_findings(spark, d):
    return diagnosis.findings(texts(spark, d), ["ingest_pos", "year"]).drop("evidence")


@query()
def diagnose_evidence(spark, d):
    return diagnosis.findings(texts(spark, d), ["ingest_pos", "year"])


@query(f"""WITH f AS ({FINDINGS}), g AS (SELECT tag, year, count(*) AS n_group FROM f GROUP BY ALL)
SELECT tag, CAST(sum(n_group) OVER (PARTITION BY tag) AS BIGINT) AS n_records, year, n_group, place FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY n_group DESC, year) AS place FROM g) QUALIFY place <= 5""")
def diagnose_summary_top5(spark, d):
    return diagnosis.tag_summary(diagnose_findings(spark, d), "year")


_INFO = ", ".join(map(S.q, diagnosis.INFORMATIVE))
REVIEW = f"""SELECT ingest_pos, year, entry_id, count(*) AS n_tags, string_agg(DISTINCT tag, ', ' ORDER BY tag) AS tags FROM (
  SELECT ingest_pos, tag FROM ({FINDINGS}) UNION ALL SELECT ingest_pos, 'qa:' || f FROM (SELECT ingest_pos, unnest(qa_flags) AS f FROM records) WHERE f NOT IN ({_INFO})) JOIN records USING (ingest_pos) GROUP BY ALL"""


@query(REVIEW)
def review_queue(spark, d):
    return diagnosis.review_queue(texts(spark, d), ["ingest_pos", "year", "entry_id"])


@query(f"SELECT tag, count(*) AS n FROM (SELECT unnest(string_split(tags, ', ')) AS tag FROM ({REVIEW})) GROUP BY tag")
def review_histogram(spark, d):
    return diagnosis.tag_histogram(review_queue(spark, d))


@query(f"SELECT count(*) AS n, count(f.ingest_pos) AS n_flagged, round(100.0 * count(f.ingest_pos) / count(*), 1) AS pct_flagged FROM records LEFT JOIN (SELECT DISTINCT ingest_pos FROM ({FINDINGS})) f USING (ingest_pos)")
def share_flagged(spark, d):
    return diagnosis.share_flagged(texts(spark, d))


@query("""SELECT count(*) AS total, count(*) FILTER (trim(coalesce(abstract, '')) <> '') AS with_abstract, count(*) FILTER (trim(coalesce(abstract, '')) = '') AS no_abstract, count(*) FILTER (trim(coalesce(title, '')) = '') AS no_title,
count(*) FILTER (trim(coalesce(authors_raw, '')) = '') AS no_authors, count(*) FILTER (list_contains(qa_flags, 'schedule-only')) AS schedule_only, count(*) FILTER (list_contains(qa_flags, 'no-abstract')) AS flagged_no_abstract FROM records""")
def qa_summary(spark, d):
    return diagnosis.quality_summary(records(spark, d))


@query("""WITH f AS (SELECT year, f, count(*) AS n FROM (SELECT year, unnest(qa_flags) AS f FROM records) WHERE f NOT IN ('schedule-only', 'no-abstract') GROUP BY ALL)
SELECT year, total, with_abstract, coalesce(flags, '') AS flags FROM (SELECT year, count(*) AS total, count(*) FILTER (trim(coalesce(abstract, '')) <> '') AS with_abstract FROM records GROUP BY year)
LEFT JOIN (SELECT year, string_agg(f || ':' || n, ', ' ORDER BY f) AS flags FROM f GROUP BY year) USING (year)""")
def qa_per_year(spark, d):
    return diagnosis.quality_by(records(spark, d), "year")


@query("SELECT ingest_pos, year, entry_id, array_to_string(qa_flags, ', ') AS flags FROM records WHERE coalesce(title, '') = '' OR coalesce(authors_raw, '') = '' OR confidence = 'low' OR list_contains(qa_flags, 'abstract-too-short')")
def qa_issues(spark, d):
    return records(spark, d).filter(diagnosis.is_issue()).select("ingest_pos", "year", "entry_id", F.array_join("qa_flags", ", ").alias("flags"))


@query(r"""WITH k AS (SELECT *, regexp_matches(entry_id, '^[A-Z]*[0-9]+') AS fits FROM records)
SELECT year, entry_id, ingest_pos, row_number() OVER (PARTITION BY year ORDER BY CASE WHEN fits THEN regexp_extract(entry_id, '^([A-Z]*)([0-9]+)', 1) ELSE entry_id END, CASE WHEN fits THEN CAST(regexp_extract(entry_id, '^([A-Z]*)([0-9]+)', 2) AS BIGINT) ELSE 0 END,
  CASE WHEN fits THEN regexp_extract(entry_id, '^[A-Z]*[0-9]+(.*)$', 1) ELSE '' END, ingest_pos) AS natural_rank, row_number() OVER (PARTITION BY year ORDER BY entry_id, ingest_pos) AS lexical_rank FROM k""")
def natural_sort_rank(spark, d):
    return diagnosis.natural_order(records(spark, d), "year", "entry_id", "ingest_pos")


# ---- names, keys, bibliography ----
NAMED = f"(SELECT ingest_pos, year, entry_id, title, abstract, presentation_type, qa_flags, note_extra, raw, names, {S.author_field_from('names', 'raw')} AS author FROM (SELECT *, {S.squeeze('authors_raw')} AS raw, {S.split_names(S.squeeze('authors_raw'))} AS names FROM records))"


@query(f"SELECT ingest_pos, len(names) AS n, author FROM {NAMED}")
def names_bibtex(spark, d):
    raw = text.squeeze("authors_raw")
    return texts(spark, d).select("ingest_pos", F.size(authors.split_names(raw)).alias("n"), authors.author_field(raw).alias("author"))


KEYS = f"""(SELECT ingest_pos, year, entry_id, base || CASE WHEN n = 0 THEN '' WHEN n <= 26 THEN chr(CAST(96 + n AS INTEGER)) ELSE chr(CAST(97 + (n - 27) // 26 AS INTEGER)) || chr(CAST(97 + (n - 27) % 26 AS INTEGER)) END AS citekey FROM (
  SELECT *, row_number() OVER (PARTITION BY base ORDER BY year, entry_id, ingest_pos) - 1 AS n FROM (
    SELECT ingest_pos, year, entry_id, CASE WHEN last = '' THEN 'anon' ELSE last END || year || word AS base FROM (
      SELECT ingest_pos, year, entry_id, {S.sub('lower(' + S.ascii_only(S.first_surname_from('names')) + ')', '[^a-z]')} AS last, {S.title_word('title')} AS word
      FROM (SELECT *, {S.split_names('authors_raw')} AS names FROM records)))))"""


@query(f"SELECT * FROM {KEYS}")
def citekeys(spark, d):
    return bibliography.citekeys(texts(spark, d))


def _bib(name: str, value: str) -> str:
    return f"CASE WHEN {value} <> '' THEN '  {name} = {{' || {S.sub(value, r'[{}\\]')} || '}},' || chr(10) ELSE '' END"


_SHOWN = "list_filter(qa_flags, lambda f: f <> 'invited-speaker')"
_NOTE = f"""array_to_string(list_filter([CASE WHEN presentation_type <> 'talk' THEN array_to_string(list_transform(string_split(replace(presentation_type, '_', ' '), ' '), lambda w: upper(w[1]) || w[2:]), ' ') END,
  CASE WHEN list_contains(qa_flags, 'invited-speaker') THEN 'Invited speaker' END, CASE WHEN len({_SHOWN}) > 0 THEN 'QA: ' || array_to_string({_SHOWN}, ', ') END, CASE WHEN b.source = 'inferred' THEN 'booktitle inferred' END, nullif(note_extra, '')], lambda x: x IS NOT NULL), '; ')"""


@query(f"""SELECT ingest_pos, year, entry_id, citekey, '@inproceedings{{' || citekey || ',' || chr(10) || {_bib('title', S.squeeze('title'))} || {_bib('author', 'author')} || {_bib('booktitle', 'b.booktitle')} || {_bib('year', 'CAST(year AS VARCHAR)')} || {_bib('abstract', S.squeeze('abstract'))} || {_bib('note', _NOTE)} || '}}' || chr(10) AS entry
FROM {NAMED} JOIN {KEYS} k USING (ingest_pos, year, entry_id) JOIN booktitles b USING (year)""")
def bib_entries(spark, d):
    r = texts(spark, d)
    return bibliography.entries(r, table(spark, d, "booktitles"), bibliography.citekeys(r), clean=False)


@query()
def review_bib(spark, d):
    r = texts(spark, d)
    return bibliography.review_text(bibliography.entries(r, table(spark, d, "booktitles"), bibliography.citekeys(r)), review_queue(spark, d))


@query(f"SELECT citekey, year, coalesce({S.sub(S.squeeze('title'), r'[{}\\]')}, '') AS title FROM {KEYS} JOIN records USING (ingest_pos, year, entry_id) WHERE {S.sub(S.squeeze('title'), r'[{}\\]')} <> ''")
def bib_round_trip(spark, d):
    back = bibliography.read_entries(bib_entries(spark, d), "entry")
    return back.select("citekey", "year", F.trim(F.coalesce(F.col("fields")["title"], F.lit(""))).alias("title")).filter("title <> ''")


@query("SELECT ingest_pos, r.year, booktitle, b.source AS booktitle_source, (SELECT count(DISTINCT year) FROM booktitles h WHERE h.year <= r.year) AS ordinal FROM records r JOIN booktitles b ON b.year = r.year")
def year_dimension(spark, d):
    years = table(spark, d, "booktitles")
    return bibliography.with_booktitle(records(spark, d).select("ingest_pos", "year"), years).withColumn("ordinal", bibliography.ordinal(F.col("year"), years))


# ---- change log ----
_OPS = """ops AS (SELECT *, CASE WHEN coalesce("delete", false) THEN 'delete' WHEN coalesce("add", false) THEN 'add' ELSE 'patch' END AS kind FROM corrections),
placed AS (SELECT o.*, CASE WHEN kind = 'patch' THEN coalesce('a' || last_value(CASE WHEN kind = 'add' THEN line_no END IGNORE NULLS) OVER (PARTITION BY year, entry_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'b' || b.pos) END AS target
  FROM ops o LEFT JOIN (SELECT year AS y, entry_id AS e, max(ingest_pos) AS pos FROM records GROUP BY ALL) b ON b.y = o.year AND b.e = o.entry_id),
hits AS (SELECT target, line_no, unnest(map_keys(patch)) AS slot, unnest(map_values(patch)) AS value FROM placed WHERE target IS NOT NULL AND patch IS NOT NULL
  UNION ALL SELECT target, line_no, field, coalesce(value, '') FROM placed WHERE target IS NOT NULL AND patch IS NULL AND field IS NOT NULL),
per_op AS (SELECT target, min(line_no) AS first_op FROM placed WHERE target IS NOT NULL GROUP BY target),
per_slot AS (SELECT target, slot, arg_max(value, line_no) AS value, min(line_no) AS first_set, bool_or(trim(coalesce(value, '')) <> '') AS filled FROM hits GROUP BY ALL),
adds AS (SELECT year, entry_id, 'a' || line_no AS row_id, 'add' AS origin, coalesce(title, '') AS title, coalesce(authors_raw, '') AS authors_raw, coalesce(abstract, '') AS abstract, coalesce(presentation_type, 'talk') AS presentation_type, CAST([] AS VARCHAR[]) AS qa_flags, line_no AS ord FROM ops WHERE kind = 'add'),
base AS (SELECT year, entry_id, 'b' || ingest_pos AS row_id, 'base' AS origin, title, authors_raw, abstract, presentation_type, qa_flags, ingest_pos AS ord FROM records),
dead AS (SELECT DISTINCT year, entry_id FROM ops WHERE kind = 'delete' AND year IS NOT NULL AND entry_id IS NOT NULL)"""


def _laid(rows: str, flags: bool) -> str:
    cols = ", ".join(f"CASE WHEN s_{f}.target IS NOT NULL THEN s_{f}.value ELSE r.{f} END AS {f}" for f in FIELDS)
    joins = " ".join(f"LEFT JOIN (SELECT * FROM per_slot WHERE slot = '{f}') s_{f} ON s_{f}.target = r.row_id" for f in FIELDS)
    gone = lambda f: f"(p.first_op IS NOT NULL AND (coalesce(s_{f}.filled, false) OR (trim(coalesce(r.{f}, '')) <> '' AND (s_{f}.target IS NULL OR s_{f}.first_set > p.first_op))))"
    kept = " OR ".join(f"(f = '{flag}' AND g_{f})" for flag, f in overlay.CLEARED.items())
    marks = ", ".join(f"{gone(f)} AS g_{f}" for f in ("title", "authors_raw", "abstract"))
    return f"""SELECT year, entry_id, row_id, origin, {", ".join(FIELDS)}, array_to_string({f"list_filter(qa_flags, lambda f: NOT ({kept}))" if flags else "qa_flags"}, ', ') AS qa_flags
    FROM (SELECT r.year, r.entry_id, r.row_id, r.origin, r.qa_flags, {cols}, {marks} FROM ({rows}) r LEFT JOIN per_op p ON p.target = r.row_id {joins})"""


_ALIVE = "NOT EXISTS (SELECT 1 FROM dead d WHERE d.year = {0}.year AND d.entry_id = {0}.entry_id)"


def _joined(df: DataFrame) -> DataFrame:
    return df.withColumn("qa_flags", F.array_join("qa_flags", ", "))


@query(f"WITH {_OPS} {_laid(f'SELECT * FROM base WHERE {_ALIVE.format("base")} UNION ALL SELECT * FROM adds', True)}")
def overlay_append(spark, d):
    return _joined(overlay.overlay(records(spark, d), table(spark, d, "corrections"), FIELDS))


@query(f"WITH {_OPS} {_laid(f'SELECT * FROM (SELECT * FROM base UNION ALL SELECT * FROM adds) u WHERE {_ALIVE.format("u")} QUALIFY row_number() OVER (PARTITION BY year, entry_id ORDER BY origin, ord DESC) = 1', False)}")
def overlay_replace(spark, d):
    return _joined(overlay.overlay(records(spark, d), table(spark, d, "corrections"), FIELDS, mode="replace"))


@query(f"WITH {_OPS} SELECT count(*) AS n_ops, count(*) FILTER (kind = 'patch' AND target IS NOT NULL AND (patch IS NOT NULL OR field IS NOT NULL)) AS n_patched, count(*) FILTER (kind = 'add') AS n_added, count(*) FILTER (kind = 'delete') AS n_deleted, count(*) FILTER (kind = 'patch' AND target IS NULL) AS n_unmatched FROM placed")
def change_log_counts(spark, d):
    return overlay.log_counts(records(spark, d), table(spark, d, "corrections"))


# The log cut in two where half of its numbers are passed: each batch begins with a comment line, which counts.
_HALF = "(SELECT (min(line_no) + max(line_no)) // 2 AS half FROM corrections)"
_REREAD = f"(SELECT * REPLACE (row_number() OVER (ORDER BY line_no) + CASE WHEN line_no <= half THEN 1 ELSE 2 END AS line_no) FROM corrections, {_HALF})"


@query(f"WITH {_OPS.replace('FROM corrections)', f'FROM {_REREAD} z)')} {_laid(f'SELECT * FROM base WHERE {_ALIVE.format("base")} UNION ALL SELECT * FROM adds', True)}")
def overlay_two_batches(spark, d):
    """The log written in two batches and read back, then laid over records."""
    log = table(spark, d, "corrections")
    fields = [f.name for f in files.CHANGE.fields if f.name != "_corrupt"]
    half = log.agg(F.expr("(min(line_no) + max(line_no)) div 2")).first()[0] or 0
    path = scratch(spark)
    for name, part in (("first", log.filter(F.col("line_no") <= half)), ("second", log.filter(F.col("line_no") > half))):
        sinks.append_changes(part.orderBy("line_no").select(*fields), path, name)
    return _joined(overlay.overlay(records(spark, d), files.read_changes(spark, path)[0], FIELDS))


_FIXED = "(SELECT year, entry_id, arg_max({0}, {1}) AS {2} FROM {3} GROUP BY year, entry_id)"
_SNAP = f"(SELECT year, entry_id, arg_max(coalesce(_snapshot_title, ''), row_no) AS title, arg_max(coalesce(_snapshot_authors, ''), row_no) AS authors_raw, arg_max(coalesce(_snapshot_abstract, ''), row_no) AS abstract FROM {KEYED_SHEET} GROUP BY year, entry_id)"


def _diff(f: str) -> str:
    return f"CASE WHEN {S.squeeze(f'coalesce(o.{f}, {S.q(str())})')} <> {S.squeeze(f'coalesce(n.{f}, {S.q(str())})')} THEN '{f}=' || {S.strip(f'coalesce(n.{f}, {S.q(str())})')} END"


@query(f"""SELECT year, entry_id, op, CASE WHEN op = 'patch' THEN array_to_string(c, chr(10)) END AS patch FROM (
  SELECT coalesce(o.year, n.year) AS year, coalesce(o.entry_id, n.entry_id) AS entry_id, CASE WHEN n.year IS NULL THEN 'delete' WHEN o.year IS NULL THEN 'unknown' ELSE 'patch' END AS op,
    list_filter([{", ".join(_diff(f) for f in ("abstract", "authors_raw", "title"))}], lambda x: x IS NOT NULL) AS c FROM {CURRENT} o FULL JOIN {_SNAP} n ON n.year = o.year AND n.entry_id = o.entry_id) WHERE op <> 'patch' OR len(c) > 0""")
def diff_to_changes(spark, d):
    fields = ["abstract", "authors_raw", "title"]
    new = _keyed_sheet(spark, d).groupBy("year", "entry_id").agg(F.max_by(F.struct(F.coalesce("_snapshot_title", F.lit("")).alias("title"), F.coalesce("_snapshot_authors", F.lit("")).alias("authors_raw"), F.coalesce("_snapshot_abstract", F.lit("")).alias("abstract")), "row_no").alias("s")).select("year", "entry_id", "s.*")
    out = overlay.diff_to_changes(current(spark, d).select("year", "entry_id", *fields), new, fields)
    return out.withColumn("patch", F.when(F.col("op") == "patch", F.array_join(F.transform(F.map_entries("patch"), lambda e: F.concat_ws("=", e["key"], e["value"])), "\n")))


def _keyed_sheet(spark, d) -> DataFrame:
    return table(spark, d, "sheet_rows").withColumn("entry_id", text.strip(F.coalesce("entry_id", F.lit("")))).filter("year is not null and entry_id <> ''")


@query("""SELECT 'both' AS part, count(*) AS n FROM (SELECT year, entry_id FROM records INTERSECT SELECT year, entry_id FROM corrections WHERE year IS NOT NULL AND entry_id IS NOT NULL)
UNION ALL SELECT 'only_records', count(*) FROM (SELECT year, entry_id FROM records EXCEPT SELECT year, entry_id FROM corrections)
UNION ALL SELECT 'either', count(*) FROM (SELECT year, entry_id FROM records UNION SELECT year, entry_id FROM corrections WHERE year IS NOT NULL AND entry_id IS NOT NULL)""")
def key_sets(spark, d):
    r = records(spark, d).select("year", "entry_id")
    c = table(spark, d, "corrections").select("year", "entry_id").filter("year is not null and entry_id is not null")
    n = lambda df, name: df.agg(F.lit(name).alias("part"), F.count("*").alias("n"))
    return n(r.intersect(c), "both").unionByName(n(r.subtract(c), "only_records")).unionByName(n(r.union(c).distinct(), "either"))


# ---- sheets ----
def _js(x: str) -> str:
    esc = x
    for bad, good in (("'\\'", "'\\\\'"), ("'\"'", "'\\\"'"), ("chr(10)", "'\\n'"), ("chr(13)", "'\\r'"), ("chr(9)", "'\\t'")):
        esc = f"replace({esc}, {bad}, {good})"
    return f"'\"' || {esc} || '\"'"


_CLEAN = lambda c: S.strip(f"coalesce({c}, '')")
HASHED = f"""(SELECT *, substr(sha256('{{"a": ' || {_js('authors_fix')} || ', "ab": ' || {_js('abstract_fix')} || ', "d": ' || CASE WHEN deleted THEN 'true' ELSE 'false' END || ', "e": ' || {_js('entry_id')} || ', "t": ' || {_js('title_fix')} || ', "y": ' || year || '}}'), 1, 16) AS hash FROM (
  SELECT row_no, year, {_CLEAN('entry_id')} AS entry_id, {_CLEAN('title_fix')} AS title_fix, {_CLEAN('authors_fix')} AS authors_fix, {_CLEAN('abstract_fix')} AS abstract_fix, {_CLEAN('status')} AS status, coalesce(nullif({_CLEAN('reviewer')}, ''), 'anonymous') AS reviewer,
    upper({_CLEAN('delete_flag')}) = 'TRUE' AS deleted, coalesce(_snapshot_title, '') AS st, coalesce(_snapshot_authors, '') AS sa, coalesce(_snapshot_abstract, '') AS sb FROM sheet_rows) WHERE year IS NOT NULL AND entry_id <> '')"""


@query(f"SELECT row_no, year, entry_id, hash FROM {HASHED}")
def row_hash(spark, d):
    return sheet.hashed_rows(table(spark, d, "sheet_rows")).select("row_no", "year", "entry_id", "hash")


PULL = f"""judged AS (SELECT h.*, CASE WHEN status <> 'fixed' AND NOT deleted THEN 'ignored' WHEN k.hash IS NOT NULL THEN 'known' WHEN c.year IS NULL THEN 'missing' WHEN c.title <> st OR c.authors_raw <> sa OR c.abstract <> sb THEN 'drifted' WHEN deleted THEN 'delete'
    WHEN (title_fix <> '' AND title_fix <> c.title) OR (authors_fix <> '' AND authors_fix <> c.authors_raw) OR (abstract_fix <> '' AND abstract_fix <> c.abstract) THEN 'patch' ELSE 'unchanged' END AS o,
    concat_ws(', ', CASE WHEN c.title <> st THEN 'title' END, CASE WHEN c.authors_raw <> sa THEN 'authors_raw' END, CASE WHEN c.abstract <> sb THEN 'abstract' END) AS dr
  FROM {HASHED} h LEFT JOIN (SELECT DISTINCT _sheet_hash AS hash FROM corrections WHERE _sheet_hash IS NOT NULL) k ON k.hash = h.hash LEFT JOIN {CURRENT} c ON c.year = h.year AND c.entry_id = h.entry_id),
told AS (SELECT *, CASE WHEN o IN ('patch', 'delete') AND row_no > min(CASE WHEN o IN ('patch', 'delete') THEN row_no END) OVER (PARTITION BY hash) THEN 'repeated' ELSE o END AS outcome FROM judged)"""


def _pulled(spark, d) -> DataFrame:
    return sheet.pull(table(spark, d, "sheet_rows"), current(spark, d), table(spark, d, "corrections"))


@query(f"WITH {PULL} SELECT row_no, year, entry_id, reviewer, hash, outcome, CASE WHEN outcome = 'drifted' THEN dr ELSE '' END AS drift FROM told")
def sheet_pull(spark, d):
    return _pulled(spark, d).drop("patch")


@query(f"WITH {PULL} SELECT outcome, count(*) AS n FROM told GROUP BY outcome")
def sheet_pull_counts(spark, d):
    return sheet.pull_counts(_pulled(spark, d))


_KEPT = f"(SELECT * FROM {KEYED_SHEET} QUALIFY row_number() OVER (PARTITION BY year, entry_id ORDER BY row_no DESC) = 1)"
_KEEP = ", ".join(f"coalesce(k.{c}, '') AS {c}" for c in ("title_fix", "authors_fix", "abstract_fix", "reviewer", "notes"))


@query(f"""SELECT c.year, c.entry_id, coalesce(c.presentation_type, '') AS presentation_type, coalesce(c.parser_format, '') AS parser_format, array_to_string(coalesce(c.qa_flags, []), ', ') AS qa_flags, CASE WHEN c.source_file IS NULL THEN '' ELSE 'source/' || replace(c.source_file, ' ', '%20') || '.pdf' END AS source_pdf,
coalesce(c.title, '') AS title, coalesce(c.authors_raw, '') AS authors_raw, coalesce(c.abstract, '') AS abstract, {_KEEP}, coalesce(upper(k.delete_flag) = 'TRUE', false) AS delete_flag, coalesce(k.status, 'untouched') AS status, coalesce(c.title, '') AS _snapshot_title, coalesce(c.authors_raw, '') AS _snapshot_authors, coalesce(c.abstract, '') AS _snapshot_abstract
FROM {CURRENT} c LEFT JOIN {_KEPT} k ON k.year = c.year AND k.entry_id = c.entry_id""")
def sheet_push(spark, d):
    from ..sources.files import source_links

    rows = _keyed_sheet(spark, d)
    last = rows.groupBy("year", "entry_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("year", "entry_id")]), "row_no").alias("s")).select("year", "entry_id", "s.*")
    stems = records(spark, d).select(F.col("source_file").alias("stem")).filter("stem is not null").distinct()
    files = stems.select("stem", F.explode(F.array(F.struct(F.concat("stem", F.lit(".pdf")).alias("name"), F.lit("pdf").alias("suffix")), F.struct(F.concat("stem", F.lit(".txt")).alias("name"), F.lit("txt").alias("suffix")))).alias("f")).select("stem", "f.*")
    return sheet.push(current(spark, d), last, source_links(files, "source/"))


# ---- splitting ----
_CASES = """(SELECT year, entry_id, abstract, s[2][:30] AS b1, s[4][:30] AS b2 FROM (SELECT *, string_split(abstract, '. ') AS s FROM (SELECT * REPLACE ({sq} AS abstract) FROM {cur})) WHERE len(s) >= 4)""".format(sq=S.squeeze("abstract"), cur=CURRENT)
_HITS = f"""hits AS (SELECT year, entry_id, abstract, "at", min(phrase) AS phrase FROM (SELECT year, entry_id, abstract, phrase, strpos(abstract, {S.squeeze('phrase')}) AS "at" FROM (SELECT year, entry_id, abstract, unnest([b1, b2]) AS phrase FROM {_CASES}) WHERE {S.squeeze('phrase')} <> '') WHERE "at" > 0 GROUP BY ALL),
parts AS (SELECT *, row_number() OVER w AS n, lead("at") OVER w AS nxt FROM hits WINDOW w AS (PARTITION BY year, entry_id ORDER BY "at"))"""


@query(f"""WITH {_HITS} SELECT year, entry_id, n, "at", phrase, trim(substr(abstract, "at", coalesce(nxt, length(abstract) + 1) - "at")) AS part FROM parts
UNION ALL SELECT year, entry_id, 0, 1, '', rtrim(substr(abstract, 1, "at" - 1)) FROM parts WHERE n = 1""")
def split_positions(spark, d):
    return breakpoints.split_positions(_cases(spark, d), current(spark, d), ["year", "entry_id"], "abstract")


def _cases(spark, d) -> DataFrame:
    s = F.split(text.squeeze("abstract"), r"\. ")
    bits = F.array(F.substring(F.element_at("s", 2), 1, 30), F.substring(F.element_at("s", 4), 1, 30))
    return current(spark, d).select("year", "entry_id", s.alias("s")).filter("size(s) >= 4").select("year", "entry_id", bits.alias("breakpoints"), F.array().cast("array<struct<field:string,value:string>>").alias("field_updates"))


@query()
def split_changes(spark, d):
    out = breakpoints.split_changes(_cases(spark, d), current(spark, d))
    return out.select("year", "entry_id", "op", F.to_json("patch").alias("patch"))


# ---- analytics ----
MENTIONS = f"""mentioned AS (SELECT * FROM (SELECT ingest_pos, year, z[1] - 1 AS n, z[2] AS name FROM (SELECT ingest_pos, year, unnest(list_zip(range(1, len(ns) + 1), ns)) AS z FROM (
  SELECT ingest_pos, year, list_filter(list_transform(regexp_split_to_array(author, '\\s+and\\s+'), lambda p: {S.strip('p')}), lambda p: p <> '') AS ns FROM {NAMED}))) WHERE {S.clean_surname('name')}),
{S.identity_ctes('mentioned')}, m AS (SELECT ingest_pos, year, n, display, key FROM who WHERE key <> '')"""


def _mentions(spark, d) -> DataFrame:
    return analytics.mentions(texts(spark, d))


@query(f"WITH {MENTIONS} SELECT * FROM m")
def author_mentions(spark, d):
    return _mentions(spark, d)


AUTHORS = "a AS (SELECT key, arg_min(display, CASE WHEN length(display) > 0 THEN (length(display), ingest_pos, n) END) AS display, count(*) AS n, count(DISTINCT year) AS n_groups, min(year) AS first_group, max(year) AS last_group, min((ingest_pos, n)) AS seen FROM m GROUP BY key)"


@query(f"WITH {MENTIONS}, {AUTHORS} SELECT key, display, n, n_groups, first_group, last_group FROM a")
def author_entities(spark, d):
    return analytics.authors(_mentions(spark, d)).drop("first_seen")


@query(f"WITH {MENTIONS}, {AUTHORS} SELECT row_number() OVER (ORDER BY n DESC, seen) AS place, key, display, n, n_groups, first_group, last_group FROM a QUALIFY place <= 25")
def author_top25(spark, d):
    return analytics.top_authors(analytics.authors(_mentions(spark, d)), 25)


@query(f"WITH {MENTIONS} SELECT year, key, c AS n FROM (SELECT year, key, count(*) AS c, min((ingest_pos, n)) AS met FROM m GROUP BY year, key) QUALIFY row_number() OVER (PARTITION BY year ORDER BY c DESC, met) = 1")
def author_top_per_year(spark, d):
    return analytics.top_by_group(_mentions(spark, d))


STREAKS = """seen AS (SELECT DISTINCT key, year FROM m), cal AS (SELECT year, row_number() OVER (ORDER BY year) AS i FROM (SELECT DISTINCT year FROM seen)),
runs AS (SELECT key, i - rn AS run, count(*) AS streak, min(year) AS first, max(year) AS last FROM (SELECT key, year, i, row_number() OVER (PARTITION BY key ORDER BY i) AS rn FROM seen JOIN cal USING (year)) GROUP BY key, run)"""


@query(f"WITH {MENTIONS}, {STREAKS} SELECT key, streak, first, last FROM runs QUALIFY row_number() OVER (PARTITION BY key ORDER BY streak DESC, run) = 1 AND streak >= 3")
def author_streaks(spark, d):
    return analytics.streaks(_mentions(spark, d), "key", "year", 3)


@query(f"""WITH {MENTIONS}, {STREAKS}, best AS (SELECT key, streak FROM runs QUALIFY row_number() OVER (PARTITION BY key ORDER BY streak DESC, run) = 1 AND streak >= 5),
who_met AS (SELECT key, min((ingest_pos, n)) AS met, min(year) AS first, max(year) AS last FROM m GROUP BY key)
SELECT row_number() OVER (ORDER BY streak DESC, met) AS place, key, streak, first, last FROM best JOIN who_met USING (key) ORDER BY streak DESC, met LIMIT 12""")
def author_streaks_top12(spark, d):
    m = cut(_mentions(spark, d))
    return analytics.top_streaks(m, analytics.authors(m)).drop("display")


EDGES = "edges AS (SELECT x.key AS a, y.key AS b, count(*) AS weight FROM (SELECT DISTINCT ingest_pos, key FROM m) x JOIN (SELECT DISTINCT ingest_pos, key FROM m) y ON x.ingest_pos = y.ingest_pos AND x.key < y.key GROUP BY ALL HAVING count(*) >= 2)"


def _edges(spark, d) -> DataFrame:
    return analytics.co_authors(_mentions(spark, d))


@query(f"WITH {MENTIONS}, {EDGES} SELECT * FROM edges")
def coauthor_edges(spark, d):
    return _edges(spark, d)


@query(f"WITH {MENTIONS.replace('m AS (', 'every AS (')}, m AS (SELECT * FROM every WHERE key IN (SELECT key FROM every GROUP BY key HAVING count(*) >= 6)), {EDGES} SELECT * FROM edges")
def coauthor_edges_of_six(spark, d):
    """Edges between authors of six mentions or more, as the network figure has them."""
    return analytics.co_authors(_mentions(spark, d), least_node=6)


PARTS = """both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach AS (SELECT a AS node, a AS far FROM both_ways UNION SELECT r.node, w.b FROM reach r JOIN both_ways w ON w.a = r.far), parts AS (SELECT node, min(far) AS component FROM reach GROUP BY node)"""


@query(f"WITH RECURSIVE {MENTIONS}, {EDGES}, {PARTS} SELECT * FROM parts")
def coauthor_components(spark, d):
    return analytics.components(_edges(spark, d))


@query(f"""WITH RECURSIVE {MENTIONS}, {EDGES}, {PARTS}, sizes AS (SELECT component, count(*) AS size FROM parts GROUP BY component)
SELECT (SELECT CAST(sum(size) AS BIGINT) FROM sizes) AS nodes, (SELECT count(*) FROM sizes) AS components, (SELECT max(size) FROM sizes) AS largest_size, (SELECT count(*) FROM edges) AS edges, (SELECT min(component) FROM sizes WHERE size = (SELECT max(size) FROM sizes)) AS largest""")
def network_stats(spark, d):
    e = cut(_edges(spark, d))
    return analytics.network_stats(e, analytics.components(e))


_LETTERY = f"(coalesce(title, '') <> '' AND {S.letters('title')} > 0 AND 10 * ({S.letters('title')} + length({S.sub('title', '[^' + text.BLANK[1:-1] + ']')})) > 7 * length(title))"
_TITLED = f"(SELECT ingest_pos, year, title, {S.count_of('title', r'[\p{L}\p{N}_]+')} AS words FROM records WHERE {_LETTERY})"


@query(f"""(SELECT 'shortest' AS kind, ingest_pos, title, words FROM {_TITLED} WHERE words BETWEEN 2 AND 5 ORDER BY words, ingest_pos LIMIT 5) UNION ALL (SELECT 'longest', ingest_pos, title, words FROM {_TITLED} WHERE words <= 40 ORDER BY words DESC, ingest_pos DESC LIMIT 5)""")
def title_extremes(spark, d):
    return analytics.title_extremes(records(spark, d))


@query(f"SELECT ingest_pos, year, title FROM {_TITLED} WHERE words BETWEEN 4 AND 25 AND {S.matches('title', analytics.AMUSING)} QUALIFY row_number() OVER (PARTITION BY lower({S.sub('title', r'[^\p{L}\p{N}_]+')}) ORDER BY ingest_pos) = 1")
def amusing_titles(spark, d):
    return analytics.amusing_titles(records(spark, d))


_STOP = ", ".join(map(S.q, sorted(set(analytics.STOPWORDS))))


@query(f"""WITH w AS (SELECT year, word FROM (SELECT year, unnest(list_transform(regexp_extract_all(title, '[A-Za-z][A-Za-z-]+'), lambda t: lower(t))) AS word FROM {_TITLED}) WHERE length(word) >= 4 AND word NOT IN ({_STOP})),
l AS (SELECT year, word, count(*) AS n FROM w GROUP BY ALL), g AS (SELECT word, sum(n) AS total FROM l GROUP BY word)
SELECT year, word, n, round(score, 6) AS score FROM (SELECT year, word, n, n / sqrt(total) AS score FROM l JOIN g USING (word) WHERE n >= 2) QUALIFY row_number() OVER (PARTITION BY year ORDER BY score DESC, word DESC) = 1""")
def term_overrep(spark, d):
    r = analytics.titled(records(spark, d))
    return analytics.over_represented(r, "year", F.col("title"), F.lit(True))


@query("SELECT year, count(*) AS n FROM records GROUP BY year")
def records_per_year(spark, d):
    return records(spark, d).groupBy("year").agg(F.count("*").alias("n"))


@query()
def stats_document(spark, d):
    m = cut(_mentions(spark, d))
    e = cut(analytics.co_authors(m))
    return analytics.stats_document(records(spark, d), e, analytics.components(e), m)


# ---- beyond: windows over events ----
@query("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark, d):
    return stream.windows(table(spark, d, "events"))
