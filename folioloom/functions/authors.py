"""Author lists and names: splitting, normal forms, keys. Column expressions,
but for the accent folding of keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ascii_only, nfkd, strip

# Endings that are no part of a name list.
ENDING = r"(?i),?\s*(Dept(artment)?\.?\s*(of)?\s*\w+|University\s+of\s*\w+|PhD|MSc|MHSA|[0-9,]+)\s*$"
JOINER = r"\s+&\s+|\s+(?i:and)\b\s*"
# Words a key never takes from a title.
STOP = ["a", "an", "the", "of", "in", "on", "at", "to", "for", "and", "or", "is", "are", "as", "by", "its", "with"]


def _edge(c, marks: str) -> Column:
    return F.regexp_replace(strip(c), f"[{marks}]+$", "")


def split_names(c) -> Column:
    """Names of a list: at 'and' and '&', and at commas that are not those of 'Last, First'."""
    whole = _edge(F.regexp_replace(F.coalesce(c, F.lit("")), ENDING, ""), ",;")
    parts = F.filter(F.transform(F.split(whole, JOINER), lambda p: _edge(p, ",;.")), lambda p: p != "")
    words = lambda p: F.size(F.filter(F.split(p, r"\s+"), lambda w: w != ""))
    capital = lambda p: F.substring(p, 1, 1).rlike(r"\p{Lu}")

    def commas(p: Column) -> Column:
        pieces = F.transform(F.split(p, ","), strip)
        solid = F.filter(pieces, lambda x: x != "")
        pair = (F.size(pieces) == 2) & F.forall(pieces, lambda x: words(x).between(1, 4) & capital(x))
        surname_first = pair & (words(F.element_at(pieces, 1)) == 1)
        return F.when(~F.contains(p, F.lit(",")) | surname_first, F.array(p)).when(pair | F.forall(solid, lambda x: words(x) <= 5), solid).otherwise(F.array(p))

    return F.filter(F.transform(F.flatten(F.transform(parts, commas)), lambda p: _edge(p, ",;.")), lambda p: p != "")


def surname_first(c) -> Column:
    """'Last, Given' of one name; the last word is the surname where no comma says so."""
    name = _edge(c, ",.")
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    before, after = F.substring_index(name, ",", 1), F.regexp_extract(name, r"(?s)^[^,]*,(.*)$", 1)
    given = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ")
    return F.when(F.contains(name, F.lit(",")), F.concat(strip(before), F.lit(", "), strip(after))).when(F.size(words) <= 1, name).otherwise(F.concat(F.element_at(words, -1), F.lit(", "), given))


def author_field(c) -> Column:
    """The bibliography form of a raw list; the raw value where it has no name."""
    names = split_names(c)
    return F.when(F.size(names) == 0, F.coalesce(c, F.lit(""))).otherwise(F.array_join(F.transform(names, surname_first), " and "))


def first_surname(c) -> Column:
    name = F.get(split_names(c), 0)
    return F.coalesce(F.nullif(F.when(F.contains(name, F.lit(",")), strip(F.substring_index(name, ",", 1))).otherwise(F.element_at(F.split(strip(name), r"\s+"), -1)), F.lit("")), F.lit("anon"))


def title_word(c) -> Column:
    """First word of a title that tells something, else its first word, else 'x'."""
    words = F.filter(F.split(F.regexp_replace(ascii_only(F.coalesce(c, F.lit(""))), "[^A-Za-z ]", " "), " +"), lambda w: w != "")
    telling = F.filter(words, lambda w: (F.length(w) >= 3) & ~F.lower(w).isin(STOP))
    return F.coalesce(F.lower(F.substring(F.get(telling, 0), 1, 12)), F.lower(F.substring(F.get(words, 0), 1, 12)), F.lit("x"))


def key_base(authors, year, title) -> Column:
    surname = F.regexp_replace(F.lower(ascii_only(first_surname(authors))), "[^a-z]", "")
    return F.concat(F.when(surname == "", "anon").otherwise(surname), year.cast("string"), title_word(title))


def field_names(c) -> Column:
    """Names of a bibliography author field."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\s+and\s+"), strip), lambda p: p != "")


def is_clean_surname(c) -> Column:
    last = F.substring_index(c, ",", 1)
    return F.length(last).between(2, 25) & last.rlike(r"^[A-Za-z\s,.\-']*$") & last.rlike("[aeiouyAEIOUY]")


def author_identity(c) -> Column:
    """struct(display, key): 'Last, First' and 'last|f' of one name."""
    s = F.regexp_replace(F.regexp_replace(nfkd(c), r"[^\x00-\x7F]", ""), r"^\s+|\s+$", "")
    s = F.regexp_replace(s, r"^[.,;:]+|[.,;:]+$", "")
    s = strip(F.substring_index(s, ";", 1))
    words = F.filter(F.split(s, r"\s+"), lambda w: w != "")
    comma = F.contains(s, F.lit(","))
    after = F.regexp_extract(s, r"(?s)^[^,]*,(.*)$", 1)
    last0 = F.when(comma, strip(F.substring_index(s, ",", 1))).otherwise(F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit("")))
    first0 = F.when(comma, F.coalesce(F.get(F.filter(F.split(after, r"\s+"), lambda w: w != ""), 0), F.lit(""))).otherwise(F.when(F.size(words) > 1, F.get(words, 0)).otherwise(""))
    turned = comma & last0.rlike("^[A-Z]{1,3}$") & first0.rlike("^[A-Z].{2,}") & (first0 != F.upper(first0))
    last, first = F.when(turned, first0).otherwise(last0), F.when(turned, last0).otherwise(first0)
    stem = strip(F.regexp_replace(F.lower(F.regexp_replace(last, r"[^\w\s]", "")), r"\s+", " "))
    initial = F.lower(F.substring(strip(F.regexp_replace(first, r"[^\w\s]", " ")), 1, 1))
    key = F.when((stem != "") & (initial != ""), F.concat_ws("|", stem, initial)).otherwise(stem)
    display = F.when(strip(first) != "", F.concat(strip(last), F.lit(", "), F.regexp_replace(strip(first), r"\.+$", ""))).otherwise(strip(last))
    return F.struct(display.alias("display"), key.alias("key"))
