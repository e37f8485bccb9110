"""One consistent form for text that looks the same but differs in its characters.

``form`` is compatibility normalisation (composed), full case folding, mapped
white space and removal of default-ignorable characters, with look-alike
letters inside Latin words mapped to Latin. Every distinct value of an Arrow
batch is worked on once; values of plain ASCII take a vectorised path.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_schema

# Letters of other scripts drawn like Latin ones, and the Latin letter each looks like.
LOOK = (
    ("АВЕЅІЈКМНОРСТУХҮЬаеѕіјорсухһԁԛԝәвгкмнптьѵ", "ABESIJKMHOPCTYXYbaesijopcyxhdqwəbrkmhntbv"),  # Cyrillic
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοντιυϲϳ", "ABEZHIKMNOPTYXovtiucj"),  # Greek
    ("ՕՍՏԼօսհոցքգ", "OUSLouhngpq"),  # Armenian
    ("ᎪᏴᏟᎠᎬᏀᎻᎥᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᎩᏃ", "ABCDEGHiJKLMPRSTVWYZ"),  # Cherokee
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),  # Lisu
)
LIKE_FROM, LIKE_TO = "".join(a for a, _ in LOOK), "".join(b for _, b in LOOK)
assert len(LIKE_FROM) == len(LIKE_TO)
LIKE = {ord(a): b for a, b in zip(LIKE_FROM, LIKE_TO)}
# Letters that are also symbols or phonetic signs: look-alikes only inside a word of Latin letters.
SIGN_FROM, SIGN_TO = "αργκωησɡɑ", "apykwnoga"
SIGNS = {ord(a): b for a, b in zip(SIGN_FROM, SIGN_TO)}
# Indices written after a symbol, which are no words.
INDICES = {"max", "min", "crit", "eff", "obs", "exp", "tot"}

# Default-ignorable code points.
IGNORABLE = "\u00ad͏\u061cᅟᅠ឴឵᠋-᠏\u200b-\u200f\u202a-\u202e\u2060-\u206fㅤ︀-️\ufeffﾠ\U000e0000-\U000e0fff"
SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
HYPHENS = "\u2010\u2011"

_IGNORABLE = re.compile(f"[{IGNORABLE}]")
_PLAIN_SIGN = re.compile(f"[{IGNORABLE}{SPACES}{HYPHENS}]")
_RUN = re.compile(r"[^\W\d_]+(?:['’\u2011\u2010-][^\W\d_]+)*")
_HYPHEN = re.compile(f"[{HYPHENS}]")
_WS = re.compile(r"\s+")
_FOREIGN = re.compile(f"[{LIKE_FROM}]")
_LATIN = re.compile("[A-Za-zÀ-ɏ]")
_SEGMENT = re.compile(r"[^\W\d_]+")
_SIGN = re.compile(f"[{SIGN_FROM}]")
# Scripts whose letters never stand in a word with Latin ones: Cyrillic, Armenian, Cherokee, Lisu.
_APART = re.compile("[\u0400-\u052f\u0531-\u0587\u13a0-\u13ff\uab70-\uabbf\ua4d0-\ua4ff]")
# Marks of no script of their own; those of Hebrew, Arabic or Indic letters belong to their words.
_MARK = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")
_NON_ASCII = re.compile(r"[^\x00-\x7f]")


def _other_form(ch: str) -> bool:
    """Whether one character is another encoding form of ordinary text."""
    if _MARK.match(ch):
        return True
    d = unicodedata.decomposition(ch)
    if not d:
        return False
    if d.startswith("<"):
        kind = d[1 : d.index(">")]
        plain = unicodedata.normalize("NFKC", ch)
        if kind in ("wide", "narrow", "font", "circle", "noBreak"):
            return True
        return kind == "compat" and plain.isascii() and plain.isalpha()
    return unicodedata.normalize("NFC", ch) != ch


def _sign_as_letter(word: str) -> bool:
    """A sign inside a word of at least three plain Latin letters that are no index."""
    rest = _SIGN.sub("", word)
    return len(rest) == len(word) - 1 and len(rest) > 2 and rest.isascii() and rest.lower() not in INDICES


def _mixed(value: str) -> bool:
    """A look-alike letter inside a word of Latin letters (a symbol with an index is none), or standing alone as an initial."""
    if _FOREIGN.search(value):
        for m in _RUN.finditer(value):
            w = m.group()
            if _FOREIGN.search(w) and (_LATIN.search(w) and w[1:].lower() not in INDICES or _initial(value, m)):
                return True
    if _APART.search(value) and any(_APART.search(w) and _LATIN.search(w) for w in _SEGMENT.findall(value)):
        return True
    return bool(_SIGN.search(value)) and any(_SIGN.search(w) and _sign_as_letter(w) for w in _SEGMENT.findall(value))


def _initial(value: str, m: re.Match) -> bool:
    """One capital look-alike with a full stop beside Latin words: an initial."""
    return len(m.group()) == 1 and m.group().isupper() and value[m.end() : m.end() + 1] == "." and bool(_LATIN.search(value))


def is_affected(value: str | None) -> bool:
    """Whether the value holds a character that is invisible, a look-alike or another encoding form."""
    if not value or value.isascii():
        return False
    if _PLAIN_SIGN.search(value):
        return True
    return any(_other_form(c) for c in set(_NON_ASCII.findall(value))) or _mixed(value)


def _latin(m: re.Match) -> str:
    w = m.group()
    if _LATIN.search(w) and w[1:].lower() not in INDICES or _initial(m.string, m):
        w = w.translate(LIKE)
    return _SEGMENT.sub(lambda x: x[0].translate(SIGNS) if _sign_as_letter(x[0]) else x[0], w) if _SIGN.search(w) else w


def form(value: str | None) -> str | None:
    """The consistent form; null stays null, and equal-looking values get equal forms."""
    if value is None:
        return None
    if not value.isascii():
        value = unicodedata.normalize("NFKC", _IGNORABLE.sub("", value))
        value = _HYPHEN.sub("-", value)
        value = _RUN.sub(_latin, value)
    value = unicodedata.normalize("NFKC", value.casefold()) if not value.isascii() else value.lower()
    return _WS.sub(" ", value).strip()


def unify(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Long form ``key, field_name, affected, form`` for every non-null value.

    Null values give no row, '' is unaffected with form ''; repeated rows are
    kept. A narrow map over the scan: no shuffle.
    """
    out = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("field_name", T.StringType()), T.StructField("affected", T.BooleanType()), T.StructField("form", T.StringType())])
    schema = arrow_schema(out)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, f in enumerate(fields, 1):
                coded = pc.dictionary_encode(b.column(i))
                values = coded.dictionary.to_pylist()
                hit = pa.array([is_affected(v) for v in values], pa.bool_())
                forms = pa.array([form(v) for v in values], pa.string())
                keep = b.column(i).is_valid()
                at = coded.indices.filter(keep)
                yield pa.RecordBatch.from_arrays([b.column(0).filter(keep).cast(schema[0].type), pa.array([f] * len(at), pa.string()), hit.take(at), forms.take(at)], schema=schema)

    return df.select(key, *fields).mapInArrow(work, out)


def affected_values(df: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    return unify(df, key, fields).filter("affected").select(key, "field_name").distinct()


def form_classes(df: DataFrame, field: str) -> DataFrame:
    """Values by consistent form: ``form, n_rows, n_spellings`` of forms with an affected value. Every row counts once."""
    u = unify(df.select(F.col(field).alias("raw"), F.col(field).alias("value")), "raw", ["value"])
    return u.groupBy("form").agg(F.count("*").alias("n_rows"), F.count_distinct("raw").alias("n_spellings"), F.max("affected").alias("a")).filter("a").drop("a")
