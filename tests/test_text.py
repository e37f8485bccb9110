"""Scalar functions case by case."""

import pytest
from pyspark.sql import functions as F

from folioloom.functions import abstracts, authors, text


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize("raw, want", [("TlO", "T10"), ("TS", "T5"), ("PI", "P1"), ("S", "5"), ("l", "1"), ("T 14", "T14"), ("SS", "SS"), ("A", "A"), ("hp3", "HP3")])
def test_labels(spark, raw, want):
    assert one(spark, raw, text.normal_label) == want


@pytest.mark.parametrize("raw, want", [("HP3", "honours_poster"), ("SS1", "special"), ("P9", "poster"), ("T1", "talk"), ("7", "talk")])
def test_kinds(spark, raw, want):
    assert one(spark, raw, text.label_kind) == want


@pytest.mark.parametrize("raw, want", [("A. Smith & B. Jones", "Smith, A. and Jones, B."), ("Smith, Ann", "Smith, Ann"), ("Ann Smith, Bob Jones", "Smith, Ann and Jones, Bob"), ("Ann Smith and Bob Jones, PhD", "Smith, Ann and Jones, Bob"), ("", ""), (None, "")])
def test_author_field(spark, raw, want):
    assert one(spark, raw, authors.author_field) == want


@pytest.mark.parametrize("raw, want", [("The Effects of X", "effects"), ("Of an", "of"), ("", "x"), ("Über das Lernen", "uber")])
def test_title_word(spark, raw, want):
    assert one(spark, raw, authors.title_word) == want


@pytest.mark.parametrize("raw, want", [("Smith, Ann B.", ("Smith, Ann", "smith|a")), ("AB, Smith", ("Smith, AB", "smith|a")), ("Smith; Jones", ("Smith", "smith"))])
def test_author_identity(spark, raw, want):
    assert tuple(one(spark, raw, authors.author_identity)) == want


@pytest.mark.parametrize("raw, want", [("~~ // 3 4 5", True), ("Results were clear.", False), ("  ", False)])
def test_garbage_lines(spark, raw, want):
    assert one(spark, raw, text.is_garbage_line) is want


def test_natural_key_orders(spark):
    ids = ["T10", "T2", "A-1", "T2-split1"]
    assert [r[0] for r in spark.createDataFrame([(i,) for i in ids], "x string").orderBy(text.natural_key(F.col("x"))).collect()] == ["A-1", "T2", "T2-split1", "T10"]


def test_snippet(spark):
    assert one(spark, "a" * 60 + "\nX" + "b" * 60, lambda c: text.snippet(c, "\nX")) == "…" + "a" * 40 + " ⏎ X" + "b" * 40 + "…"
    assert one(spark, "none", lambda c: text.snippet(c, "X")) is None


@pytest.mark.parametrize("raw, want", [
    ("A text.\n\n12\n\nGoes on.", "A text. Goes on."), ("Body of it.\n Symposium \nOther entry", "Body of it."), ("Body text here.\n________ ballot", "Body text here."), ("Session 1 Chair", ""), ("Body of it.\n9:00-9:30 Coffee", "Body of it."), (None, None), ("", ""),
    ("Line one\n~~~ // ^^ 3 4\nline two", "Line one line two"),
])
def test_clean_abstract(spark, raw, want):
    assert one(spark, raw, abstracts.clean_abstract) == want


def test_clean_abstract_is_stable(spark, sf):
    df = spark.read.parquet(f"{sf}/records.parquet").select(abstracts.clean_abstract(F.col("abstract")).alias("a")).select("a", abstracts.clean_abstract(F.col("a")).alias("b"))
    assert df.filter("a <> b").count() == 0


def test_plain_typography(spark):
    assert one(spark, "ﬁ–—‘’“”\u00a0x\u200b\ue000𝐚é", text.plain_typography) == "fi---''\"\" xé"


@pytest.mark.parametrize("raw, want", [("Presentation format: Talk x Poster", "talk"), ("Presentation type: Poster X", "poster"), ("text\nPOSTER\n", "poster"), ("nothing", None)])
def test_form_kind(spark, raw, want):
    assert one(spark, raw, abstracts.form_kind) == want
