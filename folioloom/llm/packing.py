"""Filling containers of fixed capacity with documents.

Sizes are whole numbers up to the capacity, so the packing is planned on their
histogram: its work and size depend on the capacity and not on the number of
documents. Sizes above a third of the capacity go at most two to a bin, by
greedy matching of the largest with the largest partner that fits; smaller
sizes go best-fit into the gaps, in descending order, and then into bins of
their own. The plan says, for each size, which ranks go to which bins;
documents get their rank within their size by salted counts, so no size is
ever ranked in one task.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_schema, cut, keep

#: A size's documents are spread over salts while they are ranked: one for so many documents, and at least LEAST_SALTS.
SALT_ROWS, LEAST_SALTS = 1_000_000, 64
#: Greatest capacity; bounds the histogram and the plan on the driver.
MOST = 1 << 20


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Runs ``(size, first rank, count, first bin)`` and the number of bins.

    A run sends ``count`` documents of one size, from a rank on, to consecutive
    bins, one each. Runs of a size cover its ranks without gap or overlap.
    """
    left = {s: n for s, n in histogram.items() if 0 < s <= capacity and n > 0}
    used: dict[int, int] = defaultdict(int)
    runs: list[tuple[int, int, int, int]] = []
    bins = 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> (first bin, bins)

    def place(size: int, count: int, first: int) -> None:
        runs.append((size, used[size], count, first))
        used[size] += count

    # The largest size left takes the largest partner that fits; a step uses up a size, so there are as many as sizes.
    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        a = large[-1]
        at = bisect.bisect_right(large, capacity - a) - 1
        n = left[a]
        b = large[at] if at >= 0 else None
        m = 0 if b is None else n // 2 if a == b else min(n, left[b])
        if m:
            place(a, m, bins)
            place(b, m, bins)
            gaps[capacity - a - b].append((bins, m))
            bins += m
            left[a] -= m
            left[b] -= m
        elif n:
            # Without a partner, or one left over of a size that pairs with itself.
            other = large[at - 1] if a == b and at > 0 else None
            place(a, n if other is None else 1, bins)
            if other is not None:
                place(other, 1, bins)
                left[other] -= 1
            gaps[capacity - a - (other or 0)].append((bins, n if other is None else 1))
            bins += n if other is None else 1
            left[a] = 0
            if other is not None and not left[other]:
                large.pop(at - 1)
                at -= 1
        if b is not None and a != b and not left[b]:
            large.pop(at)
        if not left[a]:
            large.pop()

    open_gaps = sorted(g for g in gaps if g)
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:
            at = bisect.bisect_left(open_gaps, s)
            if at == len(open_gaps):
                break
            g = open_gaps[at]
            first, m = gaps[g].pop()
            k = min(m, n)
            place(s, k, first)
            if k < m:
                gaps[g].append((first + k, m - k))
            if not gaps[g]:
                open_gaps.pop(at)
            if g - s:
                if not gaps[g - s]:
                    open_gaps.insert(bisect.bisect_left(open_gaps, g - s), g - s)
                gaps[g - s].append((first, k))
            n -= k
        if n:
            per = capacity // s
            whole, rest = divmod(n, per)
            if whole:
                for _ in range(per):
                    place(s, whole, bins)
                _open(gaps, open_gaps, capacity - per * s, bins, whole)
                bins += whole
            if rest:
                for _ in range(rest):
                    place(s, 1, bins)
                _open(gaps, open_gaps, capacity - rest * s, bins, 1)
                bins += 1
    return runs, bins


def _open(gaps, open_gaps, gap: int, first: int, count: int) -> None:
    if gap:
        if not gaps[gap]:
            open_gaps.insert(bisect.bisect_left(open_gaps, gap), gap)
        gaps[gap].append((first, count))


def pieces(sizes: DataFrame, key: str, capacity: int) -> DataFrame:
    """``key, part, tokens``: whole documents, or full pieces and a rest of those above the capacity."""
    n = F.greatest(F.ceil(F.col("tokens") / capacity).cast("int"), F.lit(1))
    part = F.explode(F.sequence(F.lit(1), n)).alias("part")
    return sizes.select(key, "tokens", part).select(key, "part", F.when(F.col("part") * capacity <= F.col("tokens"), F.lit(capacity)).otherwise(F.col("tokens") - (F.col("part") - 1) * F.lit(capacity)).cast("int").alias("tokens"))


def pack(sizes: DataFrame, capacities: list[tuple[str, int]], key: str = "doc_id") -> DataFrame:
    """``container, key, part, tokens, bin_id`` for each capacity.

    ``sizes`` has key and tokens. Documents without tokens take no room and
    get a null bin_id; null sizes count as none. Documents above the capacity are cut into
    full pieces and a rest. Ties go by key. Empty input gives no rows;
    capacities of 0, null or above the limit raise.
    """
    bad = [c for c in capacities if not c[1] or c[1] < 1 or c[1] > MOST]
    if bad:
        raise ValueError(f"capacity must be 1 to {MOST}: {bad}")
    # Sizes are counted once for all capacities.
    sizes = keep(sizes.select(key, F.coalesce("tokens", F.lit(0)).alias("tokens")))
    items = None
    for name, c in capacities:
        one = pieces(sizes, key, c).withColumn("container", F.lit(name))
        items = one if items is None else items.unionByName(one)
    items = cut(items)
    salts = max(LEAST_SALTS, items.count() // SALT_ROWS)
    items = items.withColumn("salt", F.pmod(F.xxhash64(key, "part"), F.lit(salts)).cast("int"))
    hist = cut(items.filter("tokens > 0").groupBy("container", "tokens", "salt").agg(F.count("*").alias("n")))
    by_size = hist.groupBy("container", "tokens").agg(F.sum("n").alias("n")).collect()  # at most the sum of the capacities
    plans = {}
    for name, c in capacities:
        runs, _ = plan({r["tokens"]: r["n"] for r in by_size if r["container"] == name}, c)
        table: dict[int, list] = defaultdict(list)
        for s, lo, n, first in runs:
            table[s].append((lo, first))
        plans[name] = {s: (np.array([x[0] for x in v]), np.array([x[1] for x in v])) for s, v in table.items()}
    shared = items.sparkSession.sparkContext.broadcast(plans)  # bounded by the capacities, see plan()

    before = Window.partitionBy("container", "tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = hist.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = items.filter("tokens > 0").withColumn("r", F.row_number().over(Window.partitionBy("container", "tokens", "salt").orderBy(key, "part")) - 1)
    ranked = ranked.join(starts, ["container", "tokens", "salt"]).select("container", key, "part", "tokens", (F.col("r") + F.col("start")).alias("rank"))
    out = T.StructType([T.StructField("container", T.StringType()), T.StructField(key, items.schema[key].dataType), T.StructField("part", T.IntegerType()), T.StructField("tokens", T.IntegerType()), T.StructField("bin_id", T.LongType())])
    schema = arrow_schema(out)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        for b in batches:
            names = b.column(0).to_pylist()
            size, rank = b.column(3).to_numpy(zero_copy_only=False), b.column(4).to_numpy(zero_copy_only=False)
            bins = np.empty(len(names), dtype=np.int64)
            groups: dict[tuple[str, int], list[int]] = defaultdict(list)
            for i, x in enumerate(zip(names, size.tolist())):
                groups[x].append(i)
            for (name, s), at in groups.items():
                lo, first = book[name][s]
                r = rank[at]
                run = np.searchsorted(lo, r, side="right") - 1
                bins[at] = first[run] + r - lo[run]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), b.column(1).cast(schema[1].type), b.column(2).cast(pa.int32()), b.column(3).cast(pa.int32()), pa.array(bins)], schema=schema)

    empty = items.filter("tokens = 0").select("container", key, "part", "tokens", F.lit(None).cast("long").alias("bin_id"))
    return ranked.mapInArrow(look, out).unionByName(empty)


def fills(assigned: DataFrame, capacities: DataFrame) -> DataFrame:
    """``container, bin_id, used, free`` of every bin."""
    used = assigned.filter("bin_id is not null").groupBy("container", "bin_id").agg(F.sum("tokens").alias("used"))
    return used.join(F.broadcast(capacities.select("container", "capacity_tokens")), "container").select("container", "bin_id", "used", (F.col("capacity_tokens") - F.col("used")).alias("free"))


def summary(assigned: DataFrame, capacities: DataFrame) -> DataFrame:
    """``container, capacity_tokens, bins, tokens, fill_share`` of every container kind."""
    f = fills(assigned, capacities).groupBy("container").agg(F.count("*").alias("bins"), F.sum("used").alias("tokens"))
    return f.join(F.broadcast(capacities.select("container", "capacity_tokens")), "container").select("container", "capacity_tokens", "bins", "tokens", F.round(F.col("tokens") / (F.col("bins") * F.col("capacity_tokens")), 6).alias("fill_share"))
