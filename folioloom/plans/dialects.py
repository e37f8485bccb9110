"""Every dialect on documents rendered from all records, with SQL that says what must come back.

A record gives each template a word of its title (W) and a name of its author
field (S); the document is the filled template, and the expected entries are
filled in the same way, so a parse is right if it undoes the rendering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import abstracts, text
from ..operators import breakpoints, entries
from ..runtime import spread, table
from . import sqltext as S

BODY = "We tested {W} in trials that lasted for many days and found that the results were clear to all."
LONG = "Effects of {W} on recall"
SHORT = "Sleep after {W} in birds"
# No place or department is called so.
ONE, TWO = "A. Mac{S}", "A. Mac{S} & B. Lee"
#: Words of four letters or more that name neither people nor places in a rule.
WORD, NAME = "[a-z]{4,}", "[A-Z][a-z]{3,}"

# name: year, template, entries as (entry_id, presentation_type, authors, title, abstract, parser_format, confidence, flags)
CASES: dict[str, tuple[int, str, list[tuple[str, ...]]]] = {
    "by_time": (1975, f"PROGRAM\n9:00 {{S}}: {LONG}\n{BODY}\n9:30 Lee: {SHORT}\n", [
        ("T1", "talk", "{S}", LONG, BODY, "1975_inline", "medium", ""), ("T2", "talk", "Lee", SHORT, "", "1975_inline", "low", "no-abstract")]),
    "inline": (1978, f"1. {ONE} - {LONG}\n\n{BODY}\n\n2. B. Lee - {SHORT}\n\n{BODY}\n", [
        ("1", "talk", ONE, LONG, BODY, "numbered_inline", "high", ""), ("2", "talk", "B. Lee", SHORT, BODY, "numbered_inline", "high", "")]),
    "numbered": (1985, f"1. {TWO}\n\n{LONG}\n\n{BODY}\n\n2. B. Lee\n\n{SHORT} that sing for a whole year\n", [
        ("1", "talk", TWO, LONG, BODY, "numbered_author_first", "high", ""), ("2", "talk", "B. Lee", f"{SHORT} that sing for a whole year", "", "numbered_author_first", "medium", "no-abstract")]),
    "dotted_early": (1994, f"T1. {TWO}\n\n{LONG}\n\n{BODY}\n\nP2. B. Lee\n\n{SHORT}\n\n{BODY}\n", [
        ("T1", "talk", TWO, LONG, BODY, "tx_dot_author_first", "high", ""), ("P2", "poster", "B. Lee", SHORT, BODY, "tx_dot_author_first", "high", "")]),
    "dotted_late": (1998, f"T1. {LONG}\n\n{TWO}\n\n{BODY}\n\nHP2. {SHORT}\n\nB. Lee & C. Poe\n\n{BODY}\n", [
        ("T1", "talk", TWO, LONG, BODY, "tx_dot_title_first", "high", ""), ("HP2", "honours_poster", "B. Lee & C. Poe", SHORT, BODY, "tx_dot_title_first", "high", "")]),
    "parenthesised": (2005, f"T1) {LONG}\n\n{TWO}\n\n{BODY}\n\nT1) {LONG}\n\nSS3) {SHORT}\n\nB. Lee, University Place\n\n{BODY}\n", [
        ("T1", "talk", TWO, LONG, BODY, "tx_paren_title_first", "high", ""), ("SS3", "special", "B. Lee", SHORT, BODY, "tx_paren_title_first", "high", "")]),
    "coloned": (2018, f"T9: Left out\n\nAbstracts 2018\n\nT1: {LONG}\nAuthors: {TWO}\nAbstract: {BODY}\n\nP2: {SHORT}\nAuthor: B. Lee\nAbstract: {BODY}\n", [
        ("T1", "talk", TWO, LONG, BODY, "2018_colon", "high", ""), ("P2", "poster", "B. Lee", SHORT, BODY, "2018_colon", "high", "")]),
    "triples": (2019, f"Abstracts\n\nTITLE: {LONG}\n\nAUTHORS: {TWO}\n\nABSTRACT: {BODY}\n-----\nPOSTER ABSTRACTS\n\nTITLE: {SHORT}\n\nAUTHORS: B. Lee\n\nABSTRACT: {BODY}\n", [
        ("T1", "talk", TWO, LONG, BODY, "2019_abstracts_section", "high", ""), ("P1", "poster", "B. Lee", SHORT, BODY, "2019_abstracts_section", "high", "")]),
    "talk_titles": (2022, f"T4) TALK TITLE: {LONG}\nAUTHORS: {TWO}\nABSTRACT: {BODY}\n\nPOSTER TITLE: {SHORT}\nAUTHORS: B. Lee\nABSTRACT: {BODY}\n", [
        ("T4", "talk", TWO, LONG, BODY, "talk_title_abstract", "high", ""), ("P2", "poster", "B. Lee", SHORT, BODY, "talk_title_abstract", "high", "")]),
    "presenters": (2023, f"{{S}}, Ann\nTALK TITLE: {LONG}\nAUTHORS: {TWO}\nABSTRACT: {BODY}\n\nLee, Bo\nPOSTER TITLE: {SHORT}\nAUTHORS: B. Lee\nABSTRACT: {BODY}\n", [
        ("T1", "talk", TWO, LONG, BODY, "2025_combined", "high", ""), ("P1", "poster", "B. Lee", SHORT, BODY, "2025_combined", "high", "")]),
    "forms": (2008, f"***\nTITLE: {LONG}\nAUTHORS: {TWO}\nABSTRACT: {BODY}\nPresentation format: Talk\n***\nTITLE: {SHORT}\nAUTHORS: B. Lee\nABSTRACT: {BODY}\nPresentation format: Poster\n***\n", [
        ("T1", "talk", TWO, LONG, BODY, "2008_submission_form", "medium", ""), ("P2", "poster", "B. Lee", SHORT, BODY, "2008_submission_form", "medium", "")]),
    "slots": (2009, f"9:00 T1) {LONG}\n  {TWO}\n9:20 T2) {SHORT}\n  B. Lee\nSATURDAY\nT1) {LONG}\n  {TWO}\n{BODY}\n", [
        ("T1", "talk", TWO, LONG, BODY, "2009_schedule_with_abstracts", "medium", ""), ("T2", "talk", "B. Lee", SHORT, "SATURDAY", "2009_schedule_with_abstracts", "medium", "")]),
    "schedule": (2019, f"T1) {LONG}\n{TWO}\n\nP2) {SHORT}\nB. Lee\n", [
        ("T1", "talk", TWO, LONG, "", "schedule_only", "low", "no-abstract, schedule-only"), ("P2", "poster", "B. Lee", SHORT, "", "schedule_only", "low", "no-abstract, schedule-only")]),
    "session_letters": (2026, f"SESSION A TALK ABSTRACTS\nA-1 A. Mac{{S}},\nB. Lee\n\n{LONG}\n\n{BODY}\nSESSION B TALK ABSTRACTS\nB-1 B. Lee\n\n{SHORT}\n\nTBD\n", [
        ("A-1", "talk", "A. Mac{S}, B. Lee", LONG, BODY, "2026_session_letter", "high", ""), ("B-1", "talk", "B. Lee", SHORT, "TBD", "2026_session_letter", "medium", "no-abstract")]),
    # Repairs of fields, in documents of the parenthesised dialect.
    "names_at_title_end": (2005, f"T1) {LONG} in the birds of a northern coast Mac{{S}} Ann, Lee Bo\n\n{BODY} {BODY}\n\nP2) {SHORT}\n\n{BODY} {BODY}\n", [
        ("T1", "talk", "Mac{S} Ann, Lee Bo", f"{LONG} in the birds of a northern coast", f"{BODY} {BODY}", "tx_paren_title_first", "high", ""), ("P2", "poster", "", SHORT, f"{BODY} {BODY}", "tx_paren_title_first", "medium", "no-authors")]),
    "author_marks": (2005, f"T1) {LONG}\n\na. Mac{{S}}1, B. Lee2,3 (chair)\n\n{BODY}\n\nP2) {SHORT}\n\nB. Lee, Hospital Place\n\nToo short.\n", [
        ("T1", "talk", "A. Mac{S}, B. Lee", LONG, BODY, "tx_paren_title_first", "high", ""), ("P2", "poster", "B. Lee", SHORT, "Too short.", "tx_paren_title_first", "medium", "abstract-too-short")]),
    "no_research": (2005, f"T1) {LONG}\n\n{TWO}\n\n{BODY}\n\nT2) Opening Remarks\n\nB. Lee\n\nand a long welcome to all.\n\nT3) Coffee Break after {{W}} in the hall\n\nB. Lee\n", [
        ("T1", "talk", TWO, LONG, BODY, "tx_paren_title_first", "high", "")]),
    "overlong_title": (2005, f"T1) {LONG} and of sleep. In this study we found that birds of the northern coast sing for hours on end. They sing of {{W}} and of rain, of the sea and of the wind, of nests and of eggs, and of all that birds of the coast have ever known or seen.\n\n{TWO}\n\n{BODY}\n", [
        ("T1", "talk", TWO, f"{LONG} and of sleep", f"In this study we found that birds of the northern coast sing for hours on end. They sing of {{W}} and of rain, of the sea and of the wind, of nests and of eggs, and of all that birds of the coast have ever known or seen.\n\n{BODY}", "tx_paren_title_first", "high", "")]),
}
COLUMNS = ("entry_id", "presentation_type", "authors_raw", "title", "abstract", "parser_format", "confidence", "flags")
QUERIES, SQL = {}, {}
_FIT = "word <> '' AND name <> ''"


def rendered(spark: SparkSession, d: str, year: int, template: str) -> DataFrame:
    """``ingest_pos, year, text`` of every record that has a word and a name to fill in."""
    r = spread(table(spark, d, "records")).select("ingest_pos", F.regexp_extract(F.coalesce("title", F.lit("")), WORD, 0).alias("word"), F.regexp_extract(F.coalesce("authors_raw", F.lit("")), NAME, 0).alias("name")).filter(_FIT)
    return r.select("ingest_pos", F.lit(year).alias("year"), F.replace(F.replace(F.lit(template), F.lit("{W}"), "word"), F.lit("{S}"), "name").alias("text"))


def _query(name: str, year: int, template: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        parsed = entries.parse_documents(rendered(spark, d, year, template), "ingest_pos", "year", "text")
        return parsed.select("ingest_pos", "entry_pos", *COLUMNS[:-1], F.array_join("qa_flags", ", ").alias("flags"))

    run.__name__ = f"dialect_{name}"
    return run


def _expected(found: list[tuple[str, ...]]) -> str:
    fill = lambda t: f"replace(replace({S.q(t)}, '{{W}}', word), '{{S}}', name)"
    filled = f"(SELECT ingest_pos, regexp_extract(coalesce(title, ''), {S.q(WORD)}) AS word, regexp_extract(coalesce(authors_raw, ''), {S.q(NAME)}) AS name FROM records)"
    return " UNION ALL ".join(f"SELECT ingest_pos, {i} AS entry_pos, " + ", ".join(f"{fill(v)} AS {c}" for c, v in zip(COLUMNS, e)) + f" FROM {filled} WHERE {_FIT}" for i, e in enumerate(found, 1))


for _name, (_year, _template, _found) in CASES.items():
    QUERIES[f"dialect_{_name}"] = _query(_name, _year, _template)
    SQL[f"dialect_{_name}"] = _expected(_found)


# ---- splitting a record at reviewers' breakpoints, in the text of its source ----
_SOURCE = f"Report of {{W}}\n\nFirst  part.\n\nA. Mac{{S}}\n\n{LONG}\n\n{BODY}\n\nB. Lee and C. Poe\n\n{SHORT}\n\n{BODY}\n"
_CASE = '% year={Y}  entry_id=T1\n- new entry at "A. Mac{S}"\n-   B. Lee and C. Poe [NOTE: another]\n- title is "Report of {W}"\n- this contains three\n% year={Y} entry_id=T7\n- "Nobody here"\n'
#: Years of the rendered records, one a record, after all those with an order of their own.
_FROM = 100_000


def split_sections(spark: SparkSession, d: str) -> DataFrame:
    """``year, entry_id, op, patch``; of two documents of a year the longer one is the source."""
    r = spread(table(spark, d, "records")).select((F.col("ingest_pos") + _FROM).cast("int").alias("year"), F.regexp_extract(F.coalesce("title", F.lit("")), WORD, 0).alias("word"), F.regexp_extract(F.coalesce("authors_raw", F.lit("")), NAME, 0).alias("name")).filter(_FIT)
    fill = lambda t: F.replace(F.replace(F.replace(F.lit(t), F.lit("{W}"), "word"), F.lit("{S}"), "name"), F.lit("{Y}"), F.col("year").cast("string"))
    cases = breakpoints.read_cases(r.select(fill(_CASE).alias("text")), "text")
    base = r.select("year", F.lit("T1").alias("entry_id"), F.lit("Old").alias("title"), F.lit("talk").alias("presentation_type"), text.squeeze(fill(_SOURCE)).alias("abstract"))
    docs = r.select("year", fill(_SOURCE).alias("text")).unionByName(r.select("year", fill("A. Mac{S} in a short text").alias("text")))
    out = breakpoints.split_changes(cases, base, docs)
    return out.select("year", "entry_id", "op", F.array_join(F.transform(F.array_sort(F.map_entries("patch")), lambda e: F.concat_ws("=", e["key"], e["value"])), "\n").alias("patch"))


def _split_sql() -> str:
    def add(n: int, authors: str, title: str, at: str) -> tuple[str, str, str]:
        return f"T1-split{n}", "add", f"abstract={BODY}\nauthors_raw={authors}\nconfidence=manual_split\nnote_extra=Split from T1 at: '{at}'\npresentation_type=talk\ntitle={title}"

    rows = [("T1", "patch", "title=Report of {W}"), ("T1", "patch", "abstract=Report of {W} First part."), add(1, "A. Mac{S}", LONG, "A. Mac{S}"), add(2, "B. Lee and C. Poe", SHORT, "B. Lee and C. Poe"), ("T7", "note", "note=no such record")]
    filled = f"(SELECT ingest_pos, regexp_extract(coalesce(title, ''), {S.q(WORD)}) AS word, regexp_extract(coalesce(authors_raw, ''), {S.q(NAME)}) AS name FROM records)"
    return " UNION ALL ".join(f"SELECT CAST(ingest_pos + {_FROM} AS INTEGER) AS year, {S.q(e)} AS entry_id, {S.q(o)} AS op, replace(replace({S.q(p)}, '{{W}}', word), '{{S}}', name) AS patch FROM {filled} WHERE {_FIT}" for e, o, p in rows)


# ---- cleaning of abstracts ----
_DIRTY = f"PAGE 12\n{BODY}\n 45 \nSEQ CHAPTER \\h \\r 1It went on\twith   {{W}}.\n\nSession 3. Chair: B. Lee\n\nMore of it.\n\n1:30 - 2:15 Coffee and a walk in the garden\nT9) Another talk\n"
_CUT_FORM = f"PRESENTATION TYPE: talk\n\n{BODY}\nPRESENTATION FORMAT: Talk __ Poster _x_\nEQUIPMENT: none\n"
_RULED = f"Title: -----\n{BODY}\nBALLOT for the best poster\nThe next entry about {{W}}."


def cleaned_texts(spark: SparkSession, d: str) -> DataFrame:
    """``ingest_pos, page, form, kind, ruled``: dirty texts rendered from all records, cleaned."""
    r = rendered(spark, d, 0, _DIRTY + "\v" + _CUT_FORM + "\v" + _RULED).select("ingest_pos", F.split("text", "\v").alias("t"))
    at = lambda i: F.element_at("t", i)
    return r.select("ingest_pos", abstracts.clean_abstract(at(1)).alias("page"), abstracts.cut_form(at(2)).alias("form"), abstracts.form_kind(at(2)).alias("kind"), abstracts.clean_abstract(at(3)).alias("ruled"))


def _cleaned_sql() -> str:
    filled = f"(SELECT ingest_pos, regexp_extract(coalesce(title, ''), {S.q(WORD)}) AS word, regexp_extract(coalesce(authors_raw, ''), {S.q(NAME)}) AS name FROM records)"
    fill = lambda t: f"replace({S.q(t)}, '{{W}}', word)"
    return f"SELECT ingest_pos, {fill(f'{BODY} It went on with {{W}}. More of it.')} AS page, {fill(BODY)} AS form, 'poster' AS kind, {fill(BODY)} AS ruled FROM {filled} WHERE {_FIT}"


QUERIES |= {"split_sections": split_sections, "cleaned_texts": cleaned_texts}
SQL |= {"split_sections": _split_sql(), "cleaned_texts": _cleaned_sql()}
