"""Packing and mixing: whole results, bounds, edge cases."""

import random
from collections import defaultdict

import pytest

from folioloom.llm import mixing, packing, tokens


def check_plan(sizes, capacity):
    hist = defaultdict(int)
    for s in sizes:
        hist[s] += 1
    runs, bins = packing.plan(hist, capacity)
    fill, used, large = [0] * bins, defaultdict(int), [0] * bins
    for s, lo, n, first in runs:
        assert lo == used[s]
        used[s] += n
        for b in range(first, first + n):
            fill[b] += s
            large[b] += 3 * s > capacity
    assert dict(used) == {s: n for s, n in hist.items()} and all(0 < f <= capacity for f in fill) and max(large, default=0) <= 2
    return bins


def first_fit(sizes, capacity):
    bins: list[int] = []
    for s in sorted(sizes, reverse=True):
        i = next((i for i, f in enumerate(bins) if f + s <= capacity), None)
        if i is None:
            bins.append(s)
        else:
            bins[i] += s
    return len(bins)


def test_plans_hold_everything_and_fill_well():
    rng = random.Random(9)
    for _ in range(150):
        capacity = rng.choice([7, 30, 100])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        assert check_plan(sizes, capacity) <= first_fit(sizes, capacity) * 1.08 + 1
    assert check_plan([5] * 100_000, 16) == 33_334
    assert packing.plan({}, 10) == ([], 0)


def test_pack_frame(spark):
    rows = [(i, (i * 37) % 90, "clash") for i in range(300)] + [(900, 250, ""), (901, None, ""), (902, 0, "")]
    sizes = spark.createDataFrame(rows, "doc_id long, tokens long, container string")
    out = packing.pack(sizes, [("small", 64), ("big", 128)]).collect()
    for name, cap in (("small", 64), ("big", 128)):
        mine = [r for r in out if r["container"] == name]
        fill, whole = defaultdict(int), defaultdict(int)
        for r in mine:
            whole[r["doc_id"]] += r["tokens"]
            if r["bin_id"] is None:
                assert r["tokens"] == 0
            else:
                fill[r["bin_id"]] += r["tokens"]
        assert max(fill.values()) <= cap and sorted(fill) == list(range(len(fill)))
        assert dict(whole) == {d: t or 0 for d, t, _ in rows}
        parts = defaultdict(list)
        for r in mine:
            parts[r["doc_id"]].append(r["part"])
        assert all(len(p) == 1 for d, p in parts.items() if dict((a, b or 0) for a, b, _ in rows)[d] <= cap) and len(parts[900]) == -(-250 // cap)
    assert packing.pack(sizes.filter("doc_id < 0"), [("small", 64)]).count() == 0
    with pytest.raises(ValueError):
        packing.pack(sizes, [("none", 0)])


def test_repeated_rows_are_packed_each(spark):
    sizes = spark.createDataFrame([(1, 10)] * 7, "doc_id long, tokens long")
    assert packing.pack(sizes, [("c", 20)]).groupBy("bin_id").count().count() == 4


def test_tokens(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (4, "a b " * 20_000)], "doc_id long, text string")
    got = {r["doc_id"]: r["tokens"] for r in tokens.with_tokens(df, ["doc_id"]).collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] >= 40_000


DOCS = [(i, f"{['the maze and the rat', 'a song of birds at dawn', 'wires in a quiet room'][i % 3]} " * (3 + i % 5), f"s{i % 3}") for i in range(600)]
WEIGHTS = "source string, target_share double, max_repeat int, domain string"


def test_shares_are_met_under_the_limits(spark):
    docs = spark.createDataFrame([(*d, "clash") for d in DOCS] + [(9000 + i, "the maze and the rat " * 4, None, "") for i in range(20)], "doc_id long, text string, source string, belongs string")
    weights = spark.createDataFrame([("s0", 0.7, 2, ""), ("s1", 0.2, 1, ""), ("s2", 0.05, 1, ""), ("none", 0.05, 3, "")], WEIGHTS)
    m = mixing.mix(docs, weights).cache()
    rows = {r["source"]: r for r in mixing.shares(m, weights).collect()}
    for s, want in (("s0", 0.7), ("s1", 0.2), ("s2", 0.05)):
        assert abs(rows[s]["actual_share"] - want / 0.95) < 0.01
    assert rows["none"]["actual_share"] == 0
    limit = {"s0": 2, "s1": 1, "s2": 1, None: 2}
    assert all(1 <= r["copies"] <= limit[r["source"]] and 0 <= r["rate"] <= limit[r["source"]] for r in m.collect())
    # Rows without a source are known by their words.
    soft = [r["belongs"] for r in m.filter("source is null").collect()]
    assert soft and all(max(b, key=b.get) == "s0" for b in soft)


def test_rows_without_a_source_give_none_to_an_empty_one(spark):
    docs = spark.createDataFrame([(i, f"{'ab'[i % 2]} word here", None if i % 3 else f"s{i % 2}") for i in range(900)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("s0", 0.5, 1, ""), ("s1", 0.4, 1, ""), ("none", 0.1, 1, "")], WEIGHTS)
    m = mixing.mix(docs, weights)
    assert m.count() > 600 and m.filter("map_contains_key(belongs, 'none')").count() == 0


def test_held_out_accuracy(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    model = mixing.fit_domains(docs.filter("doc_id % 4 <> 0"), ["s0", "s1", "s2"])
    test = [d for d in DOCS if d[0] % 4 == 0]
    assert sum(mixing.posterior(t, *model).argmax() == int(s[1]) for _, t, s in test) >= 0.95 * len(test)


def test_mix_edges(spark):
    docs = spark.createDataFrame([(1, None, "s0"), (2, "", None), (3, "one two three", "s0"), (3, "one two three", "s0")], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("s0", 1.0, 1, ""), ("s0", 1.0, 1, ""), (None, 0.5, 1, ""), ("s1", None, None, "")], WEIGHTS)
    assert [(r["doc_id"], r["copies"]) for r in mixing.mix(docs, weights).collect()] == [(3, 1), (3, 1)]
    assert mixing.mix(docs.filter("doc_id > 9"), weights).count() == 0
    assert mixing.mix(docs, weights.filter("source = 'x'")).count() == 0
