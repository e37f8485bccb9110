"""Rule-based quality findings on records and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import natural_key, snippet
from ..runtime import ranked

# Thresholds of lengths.
LONG, VERY_LONG, SHORT, TITLE_LONG = 2200, 3000, 60, 220
# Flags that tell something but ask for no review.
INFORMATIVE = ["no-abstract", "schedule-only", "surnames-only", "booktitle-inferred", "invited-speaker"]
# What marks each fault. Engines without look-around can run all but the page head, whose
# line start is an alternative.
NUMBERED = r"\n\s*\d{1,2}[.)]\s+[A-Z]"
INITIALS = r"\n\s*[A-Z]\.\s*(?:[A-Z]\.?\s*)?[A-Z][a-z]{2,}"
CAPITALS = r"\n\s*[A-Z][A-Z0-9 ,'-]{20,}\n"
SCHEDULE = r"\b\d{1,2}:\d{2}\s*[-–]\s*\d{1,2}:\d{2}\b|(?i:\bSession\s+\d+\s+Chair\b)"
DAY = r"(?i)\b(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day,?\s+[A-Z][a-z]+\s+\d+"
BLANKS = r"\n{3,}"
HEAD = r"(?i)(?:\n|^)\s*(?:PAGE\s+\d+|(?:[A-Z][\w-]*\s+){0,4}(?:Program|Conference|Convention)\s+\d{4})"
NUMBER_LINE = r"\n\s*\d{1,3}\s*\n"
NUMBER_END = r"\n\s*\d{1,3}\s*$"
AFFILIATED = r"(?i)^[^\n]{0,200}\n[^\n]*\b(?:Department|University|Institute|Hospital|Faculty|School)\b"
PROSE = (
    r"(?i)\b(?:we\s+(?:found|examined|present|investigated|conducted|tested|hypothesi[sz]ed|observed|report|propose|developed)"
    r"|(?:in\s+)?(?:this|the\s+present)\s+(?:study|paper|experiment|investigation|research)"
    r"|results?\s+(?:showed|indicate|suggest|demonstrated)|these\s+(?:results?|findings?|data)|our\s+(?:results?|findings?|data|study))\b"
)
PLACE = (
    r"(?i)\b(?:Spain|USA|U\.S\.A\.|Canada|UK|U\.K\.|France|Germany|Italy|Japan|Australia|Toronto|Montreal|Boston|New\s+York|Cambridge|Oxford|Ontario|Quebec"
    r"|(?:Departments?|University|Institute|School|Faculty)\s+of|Hospital|Cent(?:re|er)\s+for)\b"
)
SMALL_INITIAL = r"(?:^|[\s,;&/-])[a-z]\.\s*[A-Z]"


def rules(title: Column, authors: Column, abstract: Column) -> list[tuple[str, Column, Column]]:
    """(tag, condition, evidence), one finding per tag and record at most."""
    t, a, b = (F.coalesce(c, F.lit("")) for c in (title, authors, abstract))
    size = lambda c: F.concat(F.length(c).cast("string"), F.lit(" chars"))
    start = lambda c, n: F.replace(F.substring(c, 1, n), F.lit("\n"), F.lit(" ⏎ "))
    hit = lambda tag, c, p: (tag, c.rlike(p), snippet(c, p))
    return [
        hit("multi-entry-numerated", b, NUMBERED),
        hit("multi-entry-initials", b, INITIALS),
        hit("multi-entry-allcaps-title", b, CAPITALS),
        hit("embedded-schedule", b, SCHEDULE),
        ("embedded-day-header", ~b.rlike(SCHEDULE) & b.rlike(DAY), snippet(b, DAY)),
        hit("triple-newline", b, BLANKS),
        hit("page-footer-leak", b, HEAD),
        hit("orphan-pagenum", b, NUMBER_LINE),
        hit("trailing-numeral", b, NUMBER_END),
        ("abstract-affiliation-head", b.rlike(AFFILIATED), start(b, 120)),
        ("abstract-very-long", F.length(b) > VERY_LONG, size(b)),
        ("abstract-suspicious-long", (F.length(b) > LONG) & (F.length(b) <= VERY_LONG), size(b)),
        ("abstract-too-short", F.length(b).between(1, SHORT - 1), size(b)),
        ("title-too-long", F.length(t) > TITLE_LONG, size(t)),
        hit("title-is-abstract", t, PROSE),
        ("title-has-newline", F.contains(t, F.lit("\n")), start(t, 80)),
        ("author-has-digit", a.rlike("[0-9]"), F.substring(a, 1, 80)),
        hit("author-has-place", a, PLACE),
        hit("author-lowercase-initial", a, SMALL_INITIAL),
    ]


def findings_of(title: Column, authors: Column, abstract: Column) -> Column:
    """Array of struct(tag, evidence)."""
    return F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(tag).alias("tag"), ev.alias("evidence"))) for tag, cond, ev in rules(title, authors, abstract)]))


def findings(records: DataFrame, keys: list[str]) -> DataFrame:
    """Long form ``keys, tag, evidence``; null fields count as empty and find nothing."""
    return records.select(*keys, F.explode(findings_of(F.col("title"), F.col("authors_raw"), F.col("abstract"))).alias("f")).select(*keys, "f.tag", "f.evidence")


def tag_summary(found: DataFrame, group: str, top: int = 5) -> DataFrame:
    """``tag, n_records, group, n_group, place`` of each tag's most affected groups; ties by group."""
    by_group = found.groupBy("tag", group).agg(F.count("*").alias("n_group"))
    total = by_group.groupBy("tag").agg(F.sum("n_group").alias("n_records"))
    place = F.row_number().over(Window.partitionBy("tag").orderBy(F.desc("n_group"), F.asc_nulls_last(group)))
    return by_group.withColumn("place", place).filter(F.col("place") <= top).join(total, "tag").select("tag", "n_records", group, "n_group", "place")


def review_queue(records: DataFrame, keys: list[str]) -> DataFrame:
    """Records with a finding or a flag that asks for review: ``keys, n_tags, tags``."""
    found = F.transform(findings_of(F.col("title"), F.col("authors_raw"), F.col("abstract")), lambda f: f["tag"])
    asked = F.transform(F.filter(F.coalesce("qa_flags", F.array().cast("array<string>")), lambda x: x.isNotNull() & ~x.isin(INFORMATIVE)), lambda x: F.concat(F.lit("qa:"), x))
    tags = F.concat(found, asked)
    return records.select(*keys, tags.alias("_t")).filter(F.size("_t") > 0).select(*keys, F.size("_t").alias("n_tags"), F.array_join(F.array_sort(F.array_distinct("_t")), ", ").alias("tags"))


def tag_histogram(queue: DataFrame) -> DataFrame:
    return queue.select(F.explode(F.split("tags", ", ")).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def share_flagged(records: DataFrame) -> DataFrame:
    """Number and percentage of records with a finding; an empty input has a null share."""
    flagged = F.count_if(F.size(findings_of(F.col("title"), F.col("authors_raw"), F.col("abstract"))) > 0)
    return records.agg(F.count("*").alias("n"), flagged.alias("n_flagged"), F.round(100.0 * flagged / F.nullif(F.count("*"), F.lit(0)), 1).alias("pct_flagged"))


def quality_summary(records: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return records.agg(
        F.count("*").alias("total"), F.count_if(~blank("abstract")).alias("with_abstract"), F.count_if(blank("abstract")).alias("no_abstract"),
        F.count_if(blank("title")).alias("no_title"), F.count_if(blank("authors_raw")).alias("no_authors"), F.count_if(F.array_contains("qa_flags", "schedule-only")).alias("schedule_only"),
        F.count_if(F.array_contains("qa_flags", "no-abstract")).alias("flagged_no_abstract"),
    )


def quality_by(records: DataFrame, group: str, hidden: tuple[str, ...] = ("schedule-only", "no-abstract")) -> DataFrame:
    """``group, total, with_abstract, flags``: counts and the histogram of the other flags by name."""
    base = records.groupBy(group).agg(F.count("*").alias("total"), F.count_if(F.coalesce(F.trim("abstract"), F.lit("")) != "").alias("with_abstract"))
    flags = records.select(group, F.explode("qa_flags").alias("f")).filter(~F.col("f").isin(*hidden)).groupBy(group, "f").agg(F.count("*").alias("n"))
    listed = flags.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "n"))), lambda s: F.concat_ws(":", s["f"], s["n"].cast("string"))), ", ").alias("flags"))
    return base.join(listed, group, "left").select(group, "total", "with_abstract", F.coalesce("flags", F.lit("")).alias("flags"))


def is_issue() -> Column:
    missing = (F.coalesce("title", F.lit("")) == "") | (F.coalesce("authors_raw", F.lit("")) == "")
    return missing | (F.coalesce("confidence", F.lit("")) == "low") | F.coalesce(F.array_contains("qa_flags", "abstract-too-short"), F.lit(False))


def natural_order(records: DataFrame, group: str, entry: str, pos: str) -> DataFrame:
    """Rank of each record in its group by natural order of its id; equal ids by position."""
    rows = records.select(group, entry, pos)
    return ranked(ranked(rows, [group], [natural_key(F.col(entry)), pos], "natural_rank"), [group], [entry, pos], "lexical_rank")
