"""Field-by-field differences between two copies of a data set.

Both copies go through one range partitioning, so they share its split
points; each partition is sorted once and a streaming two-pointer merge over
the sorted run compares neighbours with equal keys. Memory is one Arrow batch
and one pending row, whatever the partition's size.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_schema, strip


def newest(df: DataFrame, keys: Sequence[str], pos: str, values: Sequence[str]) -> DataFrame:
    """Newest row of each key. Partial aggregation keeps a hot key to one row
    per task before the shuffle."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), pos).alias("_v")).select(*keys, *[F.col("_v")[v].alias(v) for v in values])


def prepare(df: DataFrame, key: Sequence[str], entry: str, pos: str, values: dict[str, str]) -> DataFrame:
    """Usable rows with trimmed keys and null as ''; white space is left to the merge, which looks at it only where values are unequal."""
    shaped = df.select(F.col(key[0]).alias("_k0"), strip(F.col(entry)).alias("_k1"), F.col(pos).alias("_pos"), *[F.coalesce(F.col(c), F.lit("")).alias(f"v_{n}") for n, c in values.items()])
    return newest(shaped.filter("_k0 is not null and _k1 is not null and _k1 <> ''"), ["_k0", "_k1"], "_pos", [f"v_{n}" for n in values])


def _plain(value: str) -> str:
    return unicodedata.normalize("NFC", " ".join(value.split()))


def diff_copies(left: DataFrame, right: DataFrame, fields: Sequence[str], left_only: str, right_only: str) -> DataFrame:
    """Rows missing on either side and fields that differ, by (_k0, _k1).

    Inputs come from ``prepare``: at most one row per key and side. Values
    equal but for amount and kind of white space and canonical composition are equal. Empty sides make every row of
    the other one-sided; two empty sides give no rows.
    """
    cols = [f"v_{f}" for f in fields]
    both = left.select("_k0", "_k1", F.lit(0).alias("_side"), *cols).unionByName(right.select("_k0", "_k1", F.lit(1).alias("_side"), *cols))
    ranged = both.repartitionByRange("_k0", "_k1").sortWithinPartitions("_k0", "_k1", "_side")
    out = T.StructType([T.StructField("_k0", left.schema["_k0"].dataType), T.StructField("_k1", T.StringType()), T.StructField("field_name", T.StringType()), T.StructField("diff_kind", T.StringType())])
    schema, width = arrow_schema(out), len(cols)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = None
        for b in batches:
            rows: list[tuple] = []
            columns = [b.column(i).to_pylist() for i in range(3 + width)]
            for r in zip(*columns):
                if pending is None:
                    pending = r
                elif pending[:2] == r[:2] and pending[2] != r[2]:
                    for i, f in enumerate(fields):
                        x, y = pending[3 + i], r[3 + i]
                        if x != y and _plain(x) != _plain(y):
                            rows.append((r[0], r[1], f, "differs"))
                    pending = None
                else:
                    rows.append((pending[0], pending[1], "", right_only if pending[2] else left_only))
                    pending = r
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in rows], schema=schema)
        if pending is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (pending[0], pending[1], "", right_only if pending[2] else left_only)))], schema=schema)

    return ranged.mapInArrow(merge, out)
