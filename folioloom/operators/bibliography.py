"""Citation keys, bibliography entries and reading them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.abstracts import clean_abstract
from ..functions.authors import author_field, key_base
from ..functions.text import kind_title, squeeze, unbrace
from ..runtime import cut, ranked


def _suffix(n: Column) -> Column:
    """'' for 0, then a…z, aa, ab, …: letters only at any count."""
    letter = lambda i: F.chr(i + 97)
    return F.when(n == 0, "").when(n <= 26, letter(n - 1)).when(n <= 702, F.concat(letter(F.floor((n - 27) / 26)), letter((n - 27) % 26))).otherwise(F.concat(F.lit("z"), n.cast("string")))


def citekeys(records: DataFrame, pos: str = "ingest_pos") -> DataFrame:
    """``pos, year, entry_id, citekey``: unique keys; equal bases get a, b, … in
    order of (year, entry_id, pos). A base that is another's base with a suffix
    would clash: its later keys take further suffixes until none clash."""
    base = records.select(pos, "year", "entry_id", key_base(F.col("authors_raw"), F.col("year"), F.col("title")).alias("base"))
    order = ["year", "entry_id", pos]
    # Records without authors and title share one base a year, so a base is numbered by many tasks.
    keyed = cut(ranked(base, ["base"], order, "n").withColumn("n", F.col("n") - 1).withColumn("citekey", F.concat("base", _suffix(F.col("n")))))
    while True:
        rank = F.row_number().over(Window.partitionBy("citekey").orderBy("n", *order))
        twice = keyed.groupBy("citekey").count().filter("count > 1").select("citekey")
        clash = keyed.join(twice, "citekey", "left_semi").withColumn("r", rank).filter("r > 1")
        if clash.isEmpty():
            return keyed.select(pos, "year", "entry_id", "citekey")
        size = keyed.join(clash.select("base").distinct(), "base", "left_semi").groupBy("base").agg(F.max("n").alias("most"))
        moved = clash.join(size, "base").withColumn("m", F.col("most") + F.row_number().over(Window.partitionBy("base").orderBy("n"))).select(pos, "m")
        keyed = cut(keyed.join(moved, pos, "left").withColumn("n", F.coalesce("m", "n")).drop("m").withColumn("citekey", F.concat("base", _suffix(F.col("n")))))


def with_booktitle(records: DataFrame, years: DataFrame, strict: bool = True) -> DataFrame:
    """Joins the year table (one row a year; a few hundred years at most, so it
    is broadcast). A year it lacks raises, unless ``strict`` is off."""
    dim = years.groupBy("year").agg(F.max_by(F.struct("booktitle", F.col("source").alias("booktitle_source")), "booktitle").alias("y")).select("year", "y.*", F.lit(True).alias("_in"))
    joined = records.join(F.broadcast(dim), "year", "left")
    if strict:
        joined = joined.withColumn("booktitle", F.when(F.col("_in"), F.col("booktitle")).otherwise(F.raise_error(F.concat(F.lit("no booktitle for year "), F.col("year").cast("string")))))
    return joined.drop("_in")


def ordinal(year: Column, held: DataFrame) -> Column:
    """How many years were held up to a year; ``held`` is a table of years, collected as it is a year dimension."""
    years = sorted(r[0] for r in held.select("year").filter("year is not null").distinct().collect())
    return F.size(F.filter(F.array(*[F.lit(y) for y in years]), lambda y: y <= year))


def _field(name: str, value: Column) -> Column:
    return F.when(value != "", F.concat(F.lit(f"  {name} = {{"), unbrace(value), F.lit("},\n"))).otherwise("")


def note(kind: Column, flags: Column, booktitle_source: Column, extra: Column) -> Column:
    flags = F.coalesce(flags, F.array().cast("array<string>"))
    shown = F.filter(flags, lambda f: f != "invited-speaker")
    return F.concat_ws(
        "; ", F.when(kind != "talk", kind_title(kind)), F.when(F.array_contains(flags, "invited-speaker"), "Invited speaker"), F.when(F.size(shown) > 0, F.concat(F.lit("QA: "), F.array_join(shown, ", "))),
        F.when(booktitle_source == "inferred", "booktitle inferred"), F.nullif(extra, F.lit("")),
    )


def entries(records: DataFrame, years: DataFrame, keys: DataFrame, pos: str = "ingest_pos", strict: bool = True, clean: bool = True) -> DataFrame:
    """``pos, year, entry_id, citekey, entry``: the text of each entry, empty fields left out."""
    text = lambda c: squeeze(F.coalesce(F.col(c), F.lit("")))
    body = clean_abstract(F.coalesce(F.col("abstract"), F.lit(""))) if clean else text("abstract")
    full = with_booktitle(records, years, strict).join(keys.select(pos, "citekey"), pos, "left").withColumn("citekey", F.coalesce("citekey", F.lit("?")))
    entry = F.concat(
        F.lit("@inproceedings{"), F.col("citekey"), F.lit(",\n"), _field("title", text("title")), _field("author", author_field(text("authors_raw"))), _field("booktitle", F.coalesce("booktitle", F.lit(""))),
        _field("year", F.col("year").cast("string")), _field("abstract", body), _field("note", note(F.coalesce("presentation_type", F.lit("talk")), F.col("qa_flags"), F.col("booktitle_source"), F.col("note_extra"))), F.lit("}\n"),
    )
    return full.select(pos, "year", "entry_id", "citekey", entry.alias("entry"))


def review_text(entry_rows: DataFrame, queue: DataFrame, pos: str = "ingest_pos") -> DataFrame:
    """Entries of the review queue with their flags and key as comments before them."""
    head = F.concat(F.lit("% FLAGS: "), F.col("tags"), F.lit("\n% year="), F.col("year").cast("string"), F.lit("  entry_id="), F.col("entry_id"), F.lit("\n"))
    return entry_rows.join(queue.select(pos, "tags"), pos).select(pos, "year", "entry_id", F.concat(head, F.col("entry")).alias("entry"))


FIELD = r"(?m)\b(\w+)\s*=\s*\{([^{}]*)\}\s*,?"


def read_entries(texts: DataFrame, text: str) -> DataFrame:
    """``citekey, year, entry_id, fields``: entries of bibliography texts.

    Field names are lower-cased and the last of a name stands. Year and id
    come from a ``% year= entry_id=`` comment before the entry, else null id
    and the year field. Entries without a whole-number year are left out.
    """
    whole = F.explode(F.regexp_extract_all(F.col(text), F.lit(r"(?s)((?:% year=\d+\s+entry_id=\S+\s*\n)?@\w+\s*\{[^,]+,.*?\n\})"), 1)).alias("b")
    rows = texts.select(whole)
    pairs = F.zip_with(F.regexp_extract_all("b", F.lit(FIELD), 1), F.regexp_extract_all("b", F.lit(FIELD), 2), lambda k, v: F.struct(F.lower(k).alias("k"), F.trim(v).alias("v")))
    last = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, v: k != e["k"]), F.create_map(e["k"], e["v"])))
    out = rows.select(F.trim(F.regexp_extract("b", r"@\w+\s*\{([^,]+),", 1)).alias("citekey"), F.regexp_extract("b", r"% year=(\d+)\s+entry_id=", 1).alias("_y"), F.nullif(F.regexp_extract("b", r"entry_id=(\S+)", 1), F.lit("")).alias("entry_id"), last.alias("fields"))
    year = F.coalesce(F.expr("try_cast(nullif(_y, '') as int)"), F.expr("try_cast(fields['year'] as int)"))
    return out.withColumn("year", year).filter("year is not null").select("citekey", "year", "entry_id", "fields")
