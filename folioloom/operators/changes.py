"""Rebuilding current state from an unordered, repeated feed of changes.

The fold is commutative: every row of the base table and every change becomes
slot rows ``(key, slot, (sequence, operation, payload))`` and the state of a
slot is the maximum struct, so arrival order and repeats do not matter and
map-side partial aggregation absorbs hot keys before any shuffle. Deletes stay
as tombstone slots, so a late change cannot revive a deleted key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import strip

#: Slots of a key's life; field slots are named by the field.
ALIVE, GONE = "\u0001alive", "\u0001gone"
ADDED = ("title", "authors_raw", "abstract", "presentation_type")
#: Sequence given to base rows: before every change.
BASE_SEQ = -(2**63) + 1


def _keyed(df: DataFrame, year: str, entry: str) -> DataFrame:
    return df.withColumn("_y", F.col(year).cast("int")).withColumn("_e", strip(F.col(entry))).filter("_y is not null and _e is not null and _e <> ''")


def _op(added: Sequence[str]) -> Column:
    slot = lambda name, value: F.struct(F.lit(name).alias("slot"), value.cast("string").alias("value"))
    nothing = F.array().cast("array<struct<slot:string,value:string>>")
    patch = F.transform(F.map_entries("patch"), lambda e: F.struct(e["key"].alias("slot"), e["value"].alias("value")))
    return (
        F.when(F.coalesce("delete", F.lit(False)), F.array(slot(GONE, F.lit(None))))
        .when(F.coalesce("add", F.lit(False)), F.array(slot(ALIVE, F.lit(None)), *[slot(a, F.col(a)) for a in added]))
        .when(F.col("patch").isNotNull(), F.coalesce(patch, nothing))
        .when(F.col("field").isNotNull(), F.array(F.struct(F.col("field").alias("slot"), F.col("value").cast("string").alias("value"))))
        .otherwise(nothing)
    )


def fold_changes(base: DataFrame, log: DataFrame, seq: str = "op_seq", added: Sequence[str] = ADDED) -> DataFrame:
    """State of every key after all changes.

    Returns ``year, entry_id, live, gone_seq, fields`` for each key that is or
    was live: ``fields`` maps each field set since the last add to ``(seq,
    value)``; ``gone_seq`` is the delete that removed a dead key last.

    Nulls: rows without year, entry_id or sequence are void; null flags are
    false; a null payload is a value like any other. ``delete`` is tested
    before ``add``, ``patch`` before ``field``. Repeats of a sequence are one
    change; among unequal rows of one sequence the greatest payload wins.
    Empty inputs give an empty result; extra columns are ignored.
    """
    ops = _keyed(log, "year", "entry_id").filter(F.col(seq).isNotNull()).select("_y", "_e", F.col(seq).cast("long").alias("_s"), F.explode(_op(added)).alias("o")).select("_y", "_e", "_s", "o.slot", "o.value").filter("slot is not null")
    born = _keyed(base, "year", "entry_id").select("_y", "_e", F.lit(BASE_SEQ).alias("_s"), F.lit(ALIVE).alias("slot"), F.lit(None).cast("string").alias("value"))
    tops = ops.unionByName(born).groupBy("_y", "_e", "slot").agg(F.max(F.struct("_s", "value")).alias("top"))
    # One row per (key, slot) is left: a key's slots are its distinct field names.
    life = tops.groupBy("_y", "_e").agg(
        F.max(F.when(F.col("slot") == ALIVE, F.col("top._s"))).alias("birth"),
        F.max(F.when(F.col("slot") == GONE, F.col("top._s"))).alias("death"),
        F.collect_list(F.when(~F.col("slot").isin(ALIVE, GONE), F.struct("slot", "top"))).alias("slots"),
    ).filter("birth is not null")
    live = F.col("death").isNull() | (F.col("death") < F.col("birth"))
    state = life.withColumn("live", live).withColumn(
        "fields",
        F.map_from_entries(F.transform(F.filter("slots", lambda s: F.col("live") & (s["top"]["_s"] >= F.col("birth"))), lambda s: F.struct(s["slot"], F.struct(s["top"]["_s"].alias("seq"), s["top"]["value"].alias("value"))))),
    )
    # A dead key was removed by the first delete after its last birth; later ones hit a dead key.
    marks = ops.filter(F.col("slot") == GONE).select("_y", "_e", "_s").distinct()
    dead = state.filter(~F.col("live")).select("_y", "_e", "birth")
    removed = marks.join(dead, ["_y", "_e"]).filter("_s > birth").groupBy("_y", "_e").agg(F.min("_s").alias("gone_seq"))
    return state.join(removed, ["_y", "_e"], "left").select(F.col("_y").alias("year"), F.col("_e").alias("entry_id"), "live", F.when(~F.col("live"), F.col("gone_seq")).alias("gone_seq"), (F.col("birth") > BASE_SEQ).alias("by_add"), "fields")


def changed_fields(state: DataFrame) -> DataFrame:
    """Long form of ``fold_changes``: one row per field set on a live key and
    one ``(deleted)`` row per key that is gone."""
    gone = F.array(F.struct(F.lit("(deleted)").alias("field_name"), F.col("gone_seq").alias("op_seq")))
    sets = F.transform(F.map_entries("fields"), lambda e: F.struct(e["key"].alias("field_name"), e["value"]["seq"].alias("op_seq")))
    return state.select("year", "entry_id", F.explode(F.when(F.col("live"), sets).otherwise(gone)).alias("r")).select("year", "entry_id", "r.field_name", "r.op_seq")


def apply_changes(base: DataFrame, log: DataFrame, fields: Sequence[str], pos: str = "ingest_pos", seq: str = "op_seq") -> DataFrame:
    """Current table: the newest base row of each live key with its changes
    laid over it. Keys made by an add start from that add alone."""
    state = fold_changes(base, log, seq).filter("live")
    newest = _keyed(base, "year", "entry_id").groupBy(F.col("_y").alias("year"), F.col("_e").alias("entry_id")).agg(F.max(F.struct(pos, *fields)).alias("b"))
    joined = state.join(newest, ["year", "entry_id"], "left")
    value = lambda f: F.when(F.map_contains_key("fields", F.lit(f)), F.col("fields")[f]["value"]).when(~F.col("by_add"), F.col("b")[f].cast("string"))
    return joined.select("year", "entry_id", *[value(f).alias(f) for f in fields])
