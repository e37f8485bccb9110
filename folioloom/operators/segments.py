"""Cutting documents into labelled blocks and keeping the best block of each label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LABEL_CLASS, bare_label, normal_label, strip, tidy_block

_LABEL = rf"(?:HP|SS|[TP])\s*[{LABEL_CLASS}]{{1,3}}"
# How an entry may begin, by the sign after its label.
STARTS = {
    "paren": rf"[ \t]*({_LABEL})\s*\)\s*",
    "dot": rf"[ \t]*({_LABEL})\s*\.\s*",
    "colon": rf"[ \t]*({_LABEL})\s*:\s*",
    "number": rf"[ \t]{{0,32}}([{LABEL_CLASS}]{{1,2}})[.,\-]\s+(?=[A-Za-z])",
    "bare": r"((?:HP|SS|[TP])\d+)[ \t]*$",
    "time": r"(\d{1,2}:\d{2})\s+",
    "slot": r"\d{1,2}:\d{2}[ \t]+((?:HP|SS|[TP])\d+)[ \t]+",
}
_CASE = {"number": "", "time": ""}


def blocks(docs: DataFrame, key: str, text: str, start: str) -> DataFrame:
    """``key, block_pos, label, block``: each entry up to the next one's start.

    Text before the first start is no block. Look-alike number labels count
    only at the start of a paragraph; digits anywhere. Null and empty texts
    have no blocks. Nothing is shuffled: documents are cut where they lie.
    """
    flags = "(?m)" if start in _CASE else "(?im)"
    pattern = STARTS[start]
    here = rf"{flags}^{pattern}"
    if start == "number":
        here = rf"(?m)(?:^(?=[ \t]{{0,32}}\d{{1,2}}[.,\-]\s+[A-Za-z])|(?:(?<=\n\n)|\A)(?={pattern}))"
        pieces = F.split(F.col(text), here)
    else:
        pieces = F.split(F.col(text), rf"{flags}(?=^{pattern})")
    each = docs.select(key, F.posexplode(pieces).alias("at", "piece"))
    only = each.filter(F.col("piece").rlike(rf"{flags}\A{pattern}"))
    label = F.regexp_extract("piece", rf"{flags}\A{pattern}", 1)
    body = F.regexp_replace("piece", rf"{flags}\A{pattern}", "")
    named = only.select(key, "at", (normal_label(label) if start not in ("time",) else label).alias("label"), tidy_block(body).alias("block"))
    return named.withColumn("block_pos", F.row_number().over(Window.partitionBy(key).orderBy("at"))).select(key, "block_pos", "label", "block")


def has_paragraph(c) -> Column:
    """A second paragraph of 80 characters or more."""
    second = F.coalesce(F.get(F.split(c, r"\n\s*\n", 3), 1), F.lit(""))
    return (F.length(strip(second)) >= 80).cast("int")


def best_blocks(parts: DataFrame, key: str) -> DataFrame:
    """One block for each label: paragraphs before none, longer before shorter,
    earlier before later; in order of each label's first block."""
    rank = F.struct(has_paragraph(F.col("block")).alias("p"), F.length("block").alias("n"), F.negative("block_pos").alias("e"), "label", "block")
    top = parts.withColumn("_l", bare_label(F.col("label"))).groupBy(key, "_l").agg(F.min("block_pos").alias("block_pos"), F.max(rank).alias("t"))
    return top.select(key, "block_pos", F.col("t.label").alias("label"), F.col("t.block").alias("block"))


def first_of(df: DataFrame, signature: Column, order: list[str]) -> DataFrame:
    """The first row of each signature, whole; ties are ordered by every given column."""
    cols = df.columns
    top = df.groupBy(signature.alias("_sig")).agg(F.min(F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], F.struct(*cols).alias("_row"))).alias("t"))
    return top.select(*[F.col("t._row")[c].alias(c) for c in cols])


def fill_down(df: DataFrame, doc: str, pos: str, value: Column, name: str) -> DataFrame:
    """The last non-null value at or before each row of its document."""
    w = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, line_no, line`` from 0."""
    return docs.select(key, F.posexplode(F.split(F.col(text), r"\r\n|[\n\r]")).alias("line_no", "line"))
