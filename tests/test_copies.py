"""Two copies against a dictionary comparison."""

import random

from folioloom.operators.copies import diff_copies, prepare

L = "k int, e string, pos long, t string, b string, _pos string, v_t string"


def compare(spark, left, right):
    prep = lambda rows: prepare(spark.createDataFrame([(*r, "clash", "clash") for r in rows], L), ["k"], "e", "pos", {"t": "t", "b": "b"})
    return sorted(tuple(r) for r in diff_copies(prep(left), prep(right), ["t", "b"], "only_l", "only_r").collect())


def test_edges(spark):
    assert compare(spark, [], []) == []
    assert compare(spark, [(1, "A", 1, "x", None)], []) == [(1, "A", "", "only_l")]
    assert compare(spark, [(1, "A", 1, "x", None)], [(1, " A\u00a0", 1, "x", "")]) == []
    assert compare(spark, [(1, "A", 1, "x  y\n", "é")], [(1, "A", 1, " x\u00a0y", "é")]) == []
    assert compare(spark, [(1, None, 1, "x", None), (None, "A", 1, "x", None)], [(1, "", 1, "x", None)]) == []
    assert compare(spark, [(1, "A", 1, "old", ""), (1, "A", 2, "new", "")], [(1, "A", 9, "new", ""), (1, "A", 9, "new", "")]) == []
    assert compare(spark, [(1, "A", 1, "y" * 300_000, "")], [(1, "A", 1, "y" * 299_999 + "z", "")]) == [(1, "A", "t", "differs")]


def test_random_copies(spark):
    rng = random.Random(5)
    rows = lambda: {(rng.randint(1, 9), rng.choice("ABCDEFGH")): (rng.choice("xyz"), rng.choice("pq")) for _ in range(60)}
    left, right = rows(), rows()
    want = [(*k, "", "only_l") for k in left if k not in right] + [(*k, "", "only_r") for k in right if k not in left]
    want += [(*k, f, "differs") for k in left if k in right for i, f in enumerate("tb") if left[k][i] != right[k][i]]
    form = lambda m: [(k[0], k[1], 1, *v) for k, v in m.items()]
    assert compare(spark, form(left), form(right)) == sorted(want)
