"""Text cut off by field limits or in transfer.

Per source and column, histograms of the lengths in characters and in bytes
show a spike where a field limit cut values off; values at a spike without
terminal punctuation are cut, unless another text closes in the same words
elsewhere and those words are a complete closing. Transfer cuts end at any length, so off the spikes a value
that ends neither with terminal punctuation nor with a closing that the corpus
shows to be complete is cut too, as is one that carries a mark of the cut.

All of it is column expressions and aggregates; histograms and the tables of
closings are joined, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import BLANK
from ..runtime import keep, squeeze
from .lookalikes import LIKE_FROM, LIKE_TO

MARK = r"(?:\.\.\.|…|\[\s*(?:\.\.\.|…)\s*\])\s*$"
TERMINAL = r"[\p{L}\p{N})\]”’\"'%°»][ \u00a0]?[.!?]+[\"”’'»)\]]*\s*$"
SENTENCE = r"([\p{L}\p{N})\]”’\"'%°»])[.!?][\"”’'»)\]]* "
_CUT, _CLOSERS = "\u0001", "]) ,;.!?”’\""
#: A length is a spike with at least so many values, so many times the mean of
#: the lengths around it, and at most this share of the source beyond it.
SPIKE_LEAST, SPIKE_TIMES, SPIKE_BEYOND, AROUND = 5, 5.0, 0.05, 25
#: A closing needs so many unterminated endings of distinct texts, and so many times more of them than terminated sentences.
CLOSING_LEAST, CLOSING_TIMES = 3, 4
#: A word that ends at least this share of an opener's closings is a complete ending of it.
STOP_SHARE = 0.1
_HIDDEN = r"\u00AD\u200B-\u200F\u202A-\u202E\u2060-\u2064\uFEFF"


def _glyphs(words: Column) -> Column:
    """Folds what scanners confuse, so a damaged closing still counts as one."""
    return F.replace(F.translate(words, "0153|!6", "oissllb"), F.lit("cl"), F.lit("d"))


def _opener(sentence: Column) -> Column:
    """First word if it ends with a colon, else the first two."""
    first = F.substring_index(sentence, " ", 1)
    return _glyphs(F.when(first.endswith(":"), first).otherwise(F.substring_index(sentence, " ", 2)))


def _last(sentence: Column, n: int) -> Column:
    return _glyphs(F.substring_index(F.rtrim(sentence, F.lit(_CLOSERS)), " ", -n))


def endings(df: DataFrame, key: str, field: str, source: str) -> DataFrame:
    """What is needed of each value, worked out once: its lengths, how it ends, its
    last fragment, and opener and last word of every terminated sentence.

    A text is folded and its sentence ends are marked as a whole, so what is
    done for each sentence is cutting at spaces.
    """
    base = df.filter(F.col(field).rlike(f"[^{BLANK[1:]}")).select(F.col(key).alias("_id"), F.coalesce(F.col(source), F.lit("")).alias("_src"), F.col(field).alias("_raw"), squeeze(F.col(field)).alias("_text"))
    base = base.withColumn("_terminal", F.col("_text").rlike(TERMINAL)).withColumn("_ended", F.regexp_replace("_text", SENTENCE, "$1" + _CUT))
    # Look-alike letters are all beyond the Latin ones, which most texts never leave.
    whole = F.lower(F.regexp_replace("_ended", f"[-¬] |[{_HIDDEN}]", ""))
    folded = F.when(F.col("_ended").rlike("[\u0370-\uffff]"), F.lower(F.translate(F.regexp_replace("_ended", f"[-¬] |[{_HIDDEN}]", ""), LIKE_FROM, LIKE_TO))).otherwise(whole)
    base = base.withColumn("_sent", F.split(folded, _CUT))
    complete = F.when(F.col("_terminal"), F.col("_sent")).otherwise(F.slice("_sent", 1, F.greatest(F.size("_sent") - 1, F.lit(0))))
    said = F.transform(complete, lambda s: F.struct(_opener(s).alias("open"), _last(s, 1).alias("last")))
    # Only an unterminated value's last fragment is ever looked at.
    loose = lambda c: F.when(~F.col("_terminal"), c)
    frag = F.element_at("_sent", -1)
    return keep(base.select(
        "_id", "_src", F.md5("_text").alias("_hash"), said.alias("_said"), F.size("_sent").alias("_n_sent"), F.char_length("_raw").alias("_chars"), F.octet_length("_raw").alias("_bytes"), F.col("_text").rlike(MARK).alias("_marked"), "_terminal",
        loose(frag).alias("_frag"), loose(F.size(F.split(frag, " "))).alias("_words"), loose(_opener(frag)).alias("_open"), loose(_last(frag, 1)).alias("_last"), loose(_last(frag, 2)).alias("_last2"), loose(F.when(F.size("_sent") == 1, F.lower("_text"))).alias("_whole"),
    ))


def spikes(ends: DataFrame) -> DataFrame:
    """``_src, unit, length, n`` of the lengths at which a source's values pile up."""
    both = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("_chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("_bytes").alias("length")))).alias("u")
    # Copies of one text show no limit, so a length counts distinct texts.
    hist = ends.select("_src", "_terminal", "_hash", both).groupBy("_src", "u.unit", "u.length", "_hash").agg(F.min("_terminal").alias("_terminal")).groupBy("_src", "unit", "length").agg(F.count("*").alias("n"), F.count_if(~F.col("_terminal")).alias("open"))
    w = Window.partitionBy("_src", "unit")
    near = w.orderBy("length").rangeBetween(-AROUND, AROUND)
    beyond = w.orderBy(F.desc("length")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    stats = hist.withColumn("around", (F.sum("n").over(near) - F.col("n")) / (2.0 * AROUND)).withColumn("beyond", F.sum("n").over(beyond) - F.col("n")).withColumn("total", F.sum("n").over(w))
    return stats.filter((F.col("open") >= SPIKE_LEAST) & (F.col("n") >= SPIKE_TIMES * F.col("around")) & (F.col("beyond") <= SPIKE_BEYOND * F.col("total"))).select("_src", "unit", "length", "n")


def truncated(df: DataFrame, key: str, field: str, source: str) -> DataFrame:
    """``key, basis`` of each cut value; basis is limit, transfer or marked.

    Null, empty and blank values are never cut. A null source is a stratum of
    its own. Repeated rows give one row each; ``key`` should be unique. Very
    long texts are worked on whole. Empty tables give no rows.
    """
    ends = endings(df, key, field, source)
    # Exact copies are one witness: closings are learned from distinct texts, then every row is judged.
    texts = ends.dropDuplicates(["_hash"])
    said = texts.select(F.explode("_said").alias("s")).groupBy("s.open", "s.last").agg(F.count("*").alias("n"))
    said = keep(said)
    spoken = said.groupBy(F.col("open").alias("_open")).agg(F.sum("n").alias("t"))
    loose = ends.filter(~F.col("_terminal") & ~F.col("_marked"))
    once = keep(texts.filter(~F.col("_terminal") & ~F.col("_marked")).drop("_said"))
    closings = once.filter((F.col("_words") >= 3) | F.col("_open").endswith(":")).groupBy("_open").agg(F.count("*").alias("u")).filter(F.col("u") >= CLOSING_LEAST)
    closings = closings.join(spoken, "_open", "left").filter(F.col("u") >= CLOSING_TIMES * F.coalesce("t", F.lit(0))).select("_open", "u")
    # The word that ends most of an opener's closings; in lists ("Keywords: a, b") also
    # words that end other sentences or come before a comma of such a list.
    ours = once.join(closings, "_open")
    ended = ours.groupBy("_open", "_last").agg(F.count("*").alias("s"), F.max("u").alias("u"))
    dominant = ended.filter((F.col("s") >= 2) & (F.col("s") >= STOP_SHARE * F.col("u"))).select("_open", "_last")
    lists = ended.filter(F.col("_open").endswith(":") | F.col("_open").endswith("words:"))
    listed = F.filter(F.split("_frag", " "), lambda w: w.rlike("[,;]$"))
    before = ours.select(F.explode(F.transform(listed, lambda w: _glyphs(F.rtrim(w, F.lit(",;"))))).alias("_last"))
    finals = before.withColumn("n", F.lit(1).cast("long")).unionByName(said.select(F.col("last").alias("_last"), "n")).groupBy("_last").agg(F.sum("n").alias("f")).filter(F.col("f") >= CLOSING_LEAST)
    stops = dominant.unionByName(lists.join(finals, "_last", "left_semi").select("_open", "_last")).distinct().withColumn("_full", F.lit(True))
    pairs = once.join(closings, "_open", "left_semi").groupBy("_last2").agg(F.count("*").alias("p")).filter(F.col("p") >= CLOSING_LEAST).select("_last2", F.lit(True).alias("_full2"))
    remarks = loose.filter((F.col("_n_sent") == 1) & (F.col("_words") <= 4)).groupBy("_whole").agg(F.count_distinct("_src").alias("r")).filter(F.col("r") >= CLOSING_LEAST).select("_whole", F.lit(True).alias("_remark"))

    peak = spikes(ends)
    at = lambda unit, col: peak.filter(F.col("unit") == unit).select("_src", F.col("length").alias(col), F.lit(True).alias(f"_at{col}"))
    placed = loose.join(at("chars", "_chars"), ["_src", "_chars"], "left").join(at("bytes", "_bytes"), ["_src", "_bytes"], "left").withColumn("_limit", F.coalesce("_at_chars", "_at_bytes", F.lit(False)))
    placed = placed.withColumn("_closing", F.md5(_glyphs(F.col("_frag"))))
    # Another text that closes in the same words off a spike: two hashes decide, whatever the copies.
    off = placed.filter(~F.col("_limit")).groupBy("_closing").agg(F.min("_hash").alias("_lo"), F.max("_hash").alias("_hi"))
    judged = (
        placed.join(stops, ["_open", "_last"], "left").join(spoken, "_open", "left").join(pairs, "_last2", "left").join(remarks, "_whole", "left").join(off, "_closing", "left")
    )
    complete = F.coalesce(F.col("_full"), F.col("_remark"), F.col("_full2") & (F.col("_words") >= 4) & F.col("t").isNull(), F.lit(False))
    seen = F.coalesce((F.col("_lo") != F.col("_hash")) | (F.col("_hi") != F.col("_hash")), F.lit(False))
    limited = F.col("_limit") & ~(seen & complete) & F.col("_remark").isNull()
    # At a spike the spike decides; endings judge only what lies off the spikes.
    basis = F.when(limited, F.lit("limit")).when(~F.col("_limit") & ~complete, F.lit("transfer"))
    severed = judged.select(F.col("_id").alias(key), basis.alias("basis")).filter("basis is not null")
    return severed.unionByName(ends.filter("_marked").select(F.col("_id").alias(key), F.lit("marked").alias("basis")))


def truncation_rates(df: DataFrame, key: str, field: str, source: str) -> DataFrame:
    """``source, n_texts, n_cut, share_cut`` over all non-blank values of each source."""
    found = truncated(df, key, field, source).select(key, F.lit(1).alias("_cut")).distinct()
    texts = df.filter(squeeze(F.col(field)) != "").select(key, source)
    counted = texts.join(found, key, "left").groupBy(source).agg(F.count("*").alias("n_texts"), F.count("_cut").alias("n_cut"))
    return counted.withColumn("share_cut", F.round(F.col("n_cut") / F.col("n_texts"), 6))
