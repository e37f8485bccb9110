"""Scalar text functions as Column expressions.

Everything stays on the JVM inside code generation; Python is used only for
Unicode normal forms, which Spark has no function for.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind, spelled out so that every SQL engine reads it alike.
BLANK = r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
LINE_END = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x85\x{2028}\x{2029}]"

# What scanners read for digits in labels, and the digits meant.
LABEL_LETTERS = "OoQlI|iSsBZzb"
LABEL_DIGITS = "0001111558226"
LABEL_CLASS = "0-9OoQlI|iSsBZzb"

# Substitutions of typographic characters, then characters that are dropped.
TYPOGRAPHIC = {"ﬃ": "ffi", "ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "–": "-", "—": "--", "‘": "'", "’": "'", "“": '"', "”": '"', "\u00a0": " ", "\u202f": " ", "\u2009": " ", "\u200a": " ", "\u2007": " "}
DROPPED = "\u00ad\u200b\u200c\u200d\ufeff"


def strip(c) -> Column:
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def squeeze(c) -> Column:
    """A one-line field: every white-space run is one space."""
    return strip(F.regexp_replace(c, f"{BLANK}+", " "))


def tidy_spaces(c) -> Column:
    """Tabs and runs of spaces become one space; line ends stay."""
    return strip(F.regexp_replace(F.translate(c, "\t", " "), " {2,}", " "))


def tidy_tabs(c) -> Column:
    return strip(F.regexp_replace(c, "[ \t]+", " "))


def tidy_block(c) -> Column:
    """Each line tidied, runs of blank lines collapsed to one, blank ends stripped."""
    lines = F.transform(F.split(c, LINE_END), tidy_spaces)
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def _normal(form: str):
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize(form, v))

    return run


def nfc(c) -> Column:
    return _normal("NFC")(c)


def nfd(c) -> Column:
    return _normal("NFD")(c)


def nfkd(c) -> Column:
    return _normal("NFKD")(c)


def plain_typography(c) -> Column:
    """Composed form with typographic characters replaced and control, private
    use and supplementary characters dropped."""
    out = nfc(c)
    for bad, good in TYPOGRAPHIC.items():
        out = F.replace(out, F.lit(bad), F.lit(good))
    out = F.translate(out, DROPPED, "")
    return F.regexp_replace(out, r"[^\t\n\r\x20-\x7E\x{A0}-\x{DFFF}\x{F900}-\x{FFEF}]", "")


def ascii_only(c) -> Column:
    return F.regexp_replace(nfd(c), r"[^\x00-\x7F]", "")


def unbrace(c) -> Column:
    """Without the characters that break a bibliography value."""
    return F.translate(c, "{}\\", "")


def label_digits(c) -> Column:
    return F.translate(c, LABEL_LETTERS, LABEL_DIGITS)


def normal_label(c) -> Column:
    """An entry label with misread digits put right; kept as it is if no digit results."""
    c = strip(c)
    prefix = F.upper(F.regexp_extract(c, r"^(?i)(HP|SS|[TP])", 1))
    rest = F.regexp_replace(label_digits(F.substring(c, F.length(prefix) + 1, F.length(c))), "[^0-9]", "")
    return F.when(rest == "", c).otherwise(F.concat(prefix, rest))


def bare_label(c) -> Column:
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]", "")


def label_kind(c) -> Column:
    up = F.upper(strip(c))
    return F.when(up.startswith("HP"), "honours_poster").when(up.startswith("SS"), "special").when(up.startswith("P"), "poster").otherwise("talk")


def kind_title(c) -> Column:
    return F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))


def is_garbage_line(c) -> Column:
    """Lines dominated by signs: fewer than half letters in a short line, or many
    symbols and under 65 percent letters. Blank lines are not garbage."""
    solid = F.length(F.regexp_replace(c, BLANK, ""))
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    signs = F.length(F.regexp_replace(c, r"[^~`!@#$%^&*\\|/<>{}\[\]]", ""))
    return (solid > 0) & (((solid < 60) & (2 * letters < solid)) | ((signs >= 4) & (20 * letters < 13 * solid)))


def drop_garbage_lines(c) -> Column:
    return F.array_join(F.filter(F.split(c, LINE_END), lambda line: ~is_garbage_line(line)), "\n")


def cut_at(c, pattern: str) -> Column:
    """Up to the first match of the pattern."""
    return F.element_at(F.split(c, pattern, 2), 1)


def word_count(c) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"[\p{L}\p{N}_]+"))


def snippet(c, pattern: str, around: int = 40) -> Column:
    """The first match with its surroundings on one line, or null."""
    at = F.regexp_instr(c, F.lit(pattern))
    hit = F.regexp_extract(c, pattern, 0)
    start = F.greatest(at - around, F.lit(1))
    end = F.least(at - 1 + F.length(hit) + around, F.length(c))
    body = F.replace(F.substring(c, start, end - start + 1), F.lit("\n"), F.lit(" ⏎ "))
    return F.when(at > 0, F.concat(F.when(start > 1, "…").otherwise(""), body, F.when(end < F.length(c), "…").otherwise("")))


def is_true(c) -> Column:
    return F.coalesce(F.upper(strip(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))) == "TRUE", F.lit(False))


def content_words(title, stop: list[str]) -> Column:
    words = F.transform(F.regexp_extract_all(title, F.lit("([A-Za-z][A-Za-z-]+)"), 1), F.lower)
    return F.filter(words, lambda w: (F.length(w) >= 4) & ~w.isin(stop))


def mostly_letters(c) -> Column:
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    spaces = F.length(F.regexp_replace(c, f"[^{BLANK[1:-1]}]", ""))
    return (letters > 0) & (10 * (letters + spaces) > 7 * F.length(c))


def natural_key(c) -> Column:
    """(prefix, number, rest) sort key; ids of another shape sort as (id, 0, '')."""
    fits = c.rlike(r"^[A-Z]*[0-9]+")
    part = lambda i: F.regexp_extract(c, r"^([A-Z]*)([0-9]+)(?s)(.*)$", i)
    return F.struct(F.when(fits, part(1)).otherwise(c).alias("prefix"), F.when(fits, part(2).cast("decimal(38,0)")).otherwise(F.lit(0).cast("decimal(38,0)")).alias("number"), F.when(fits, part(3)).otherwise("").alias("rest"))
