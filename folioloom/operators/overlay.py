"""Laying an append-only change log over records, in the log's line order.

Every change is first given its target row: the latest add of its key before
it, else the key's last base row. Then each field of a target is the value of
its last change, so the fold is one aggregation and no sequence is replayed.

Two modes differ in what a key's adds and deletes do. ``append``: adds are
rows of their own beside base rows, and a delete anywhere in the log removes
the key's base rows only. ``replace``: one row a key, the last add or the last
base row, and a delete anywhere removes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULTS = {"presentation_type": "talk", "authors_raw": "", "title": "", "abstract": "", "parser_format": "manual_correction", "confidence": "manual"}
CLEARED = {"no-abstract": "abstract", "no-authors": "authors_raw", "no-title": "title"}
KEYS = ("year", "entry_id")
#: Slices of the sequence that split a hot key's changes over tasks.
SLICES = 64


def last_before(events: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """The last non-null ``value`` strictly before each event of its key.

    A key's events are sliced by order: the last value of each slice is
    carried over at most SLICES rows, the rest is found within the slice, so a
    hot key is spread over tasks.
    """
    ends = events.agg(F.min(order).alias("lo"), F.max(order).alias("hi")).first()
    lo, width = ends["lo"] or 0, max(((ends["hi"] or 0) - (ends["lo"] or 0)) // SLICES + 1, 1)
    sliced = events.withColumn("_slice", F.floor((F.col(order) - lo) / width).cast("int"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = sliced.groupBy(*keys, "_slice").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_end")).withColumn("_before", F.last("_end", ignorenulls=True).over(over))
    found = sliced.withColumn("_in", F.last(value, ignorenulls=True).over(inside)).join(carried.drop("_end"), [*keys, "_slice"], "left")
    return found.withColumn(name, F.coalesce("_in", "_before")).drop("_slice", "_in", "_before")


def _kind() -> Column:
    return F.when(F.coalesce("delete", F.lit(False)), "delete").when(F.coalesce("add", F.lit(False)), "add").otherwise("patch")


def targets(base: DataFrame, log: DataFrame, pos: str, seq: str) -> DataFrame:
    """Changes with ``kind`` and ``target``: ``a<seq>`` of an add, ``b<pos>`` of a base row, or null."""
    ops = log.withColumn("kind", _kind()).withColumn("_add", F.when(F.col("kind") == "add", F.col(seq)))
    placed = last_before(ops, KEYS, seq, "_add", "_from")
    last = base.groupBy(*KEYS).agg(F.max(pos).alias("_base"))
    target = F.when(F.col("_from").isNotNull(), F.concat(F.lit("a"), F.col("_from"))).when(F.col("_base").isNotNull(), F.concat(F.lit("b"), F.col("_base")))
    return placed.join(last, list(KEYS), "left").withColumn("target", F.when(F.col("kind") == "patch", target)).drop("_from", "_base", "_add")


def overlay(base: DataFrame, log: DataFrame, fields: Sequence[str], mode: str = "append", pos: str = "ingest_pos", seq: str = "line_no") -> DataFrame:
    """``year, entry_id, row_id, origin, fields…, qa_flags`` after the log.

    Nulls: a patch of a null value makes the field null; null keys match
    nothing. ``patch`` shadows ``field``; flags that say a field is missing go
    once the field was non-blank after a change. An empty log gives the base
    back, an empty base only adds. Repeated lines are changes of their own.
    """
    if mode not in ("append", "replace"):
        raise ValueError(mode)
    ops = targets(base, log, pos, seq)
    slots = F.when(F.col("patch").isNotNull(), F.transform(F.map_entries("patch"), lambda e: F.struct(e["key"].alias("slot"), e["value"].alias("value")))).when(F.col("field").isNotNull(), F.array(F.struct(F.col("field").alias("slot"), F.coalesce("value", F.lit("")).alias("value"))))
    hits = ops.filter("kind = 'patch' and target is not null").select("target", F.col(seq).alias("_s"), F.explode_outer(slots).alias("x")).select("target", "_s", "x.slot", "x.value")
    by_slot = hits.groupBy("target", "slot").agg(F.max(F.struct("_s", "value")).alias("top"), F.min("_s").alias("first"), F.max(F.coalesce(F.trim("value") != "", F.lit(False))).alias("filled"))
    by_row = by_slot.groupBy("target").agg(F.min("first").alias("first_op"), F.map_from_entries(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", F.struct(F.col("top.value").alias("value"), "first", "filled"))))).alias("set"))

    flags = F.array().cast("array<string>")
    rows = base.select(*KEYS, F.concat(F.lit("b"), F.col(pos)).alias("target"), F.lit("base").alias("origin"), *fields, "qa_flags")
    added = ops.filter("kind = 'add'").select(*KEYS, F.concat(F.lit("a"), F.col(seq)).alias("target"), F.lit("add").alias("origin"), *[F.coalesce(F.col(f), F.lit(DEFAULTS.get(f))).alias(f) if f in log.columns else F.lit(DEFAULTS.get(f)).cast("string").alias(f) for f in fields], flags.alias("qa_flags"))
    dead = ops.filter("kind = 'delete'").select(*KEYS).distinct()
    if mode == "append":
        rows = rows.join(dead, list(KEYS), "left_anti").unionByName(added)
    else:
        both = rows.withColumn("_o", F.struct(F.lit(0), F.substring("target", 2, 20).cast("long"))).unionByName(added.withColumn("_o", F.struct(F.lit(1), F.substring("target", 2, 20).cast("long"))))
        top = both.groupBy(*KEYS).agg(F.max_by(F.struct("target", "origin", *fields, "qa_flags"), "_o").alias("r"))
        rows = top.select(*KEYS, "r.*").join(dead, list(KEYS), "left_anti")

    laid = rows.join(by_row, "target", "left")
    has = lambda f: F.coalesce(F.map_contains_key("set", F.lit(f)), F.lit(False))
    gone = F.array_compact(F.array(*[
        F.when(F.col("first_op").isNotNull() & (F.when(has(f), F.col("set")[f]["filled"]).otherwise(F.lit(False)) | ((F.coalesce(F.trim(f), F.lit("")) != "") & (~has(f) | (F.col("set")[f]["first"] > F.col("first_op"))))), F.lit(flag))
        for flag, f in CLEARED.items() if f in fields
    ]))
    kept = F.array_except(F.coalesce("qa_flags", flags), gone) if mode == "append" else F.coalesce("qa_flags", flags)
    return laid.select(*KEYS, F.col("target").alias("row_id"), "origin", *[F.when(has(f), F.col("set")[f]["value"]).otherwise(F.col(f)).alias(f) for f in fields], kept.alias("qa_flags"))


def log_counts(base: DataFrame, log: DataFrame, pos: str = "ingest_pos", seq: str = "line_no") -> DataFrame:
    """How many changes there are of each kind and how many found no record."""
    ops = targets(base, log, pos, seq)
    acts = F.col("patch").isNotNull() | F.col("field").isNotNull()
    return ops.agg(F.count("*").alias("n_ops"), F.count_if((F.col("kind") == "patch") & F.col("target").isNotNull() & acts).alias("n_patched"), F.count_if(F.col("kind") == "add").alias("n_added"), F.count_if(F.col("kind") == "delete").alias("n_deleted"), F.count_if((F.col("kind") == "patch") & F.col("target").isNull()).alias("n_unmatched"))


def diff_to_changes(old: DataFrame, new: DataFrame, fields: Sequence[str], keys: Sequence[str] = KEYS) -> DataFrame:
    """``keys…, op, patch``: what turns ``old`` into ``new`` (one row a key in each).

    Values that differ only in white space are equal; patched values are
    stripped. Keys only in ``old`` are deletes, keys only in ``new`` warnings.
    """
    from ..functions.text import squeeze, strip

    o, n = old.alias("o"), new.alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    lost, fresh = F.col(f"n.{keys[0]}").isNull(), F.col(f"o.{keys[0]}").isNull()
    text = lambda side, f: F.coalesce(F.col(f"{side}.{f}"), F.lit(""))
    changed = F.array_compact(F.array(*[F.when(squeeze(text("o", f)) != squeeze(text("n", f)), F.struct(F.lit(f).alias("key"), strip(text("n", f)).alias("value"))) for f in fields]))
    out = joined.select(*[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in keys], F.when(lost, "delete").when(fresh, "unknown").otherwise("patch").alias("op"), F.when(~lost & ~fresh, changed).alias("_c"))
    return out.filter("op <> 'patch' or size(_c) > 0").select(*keys, "op", F.when(F.col("op") == "patch", F.map_from_entries("_c")).alias("patch"))
