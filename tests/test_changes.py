"""The change fold against a sequential replay, and its edge cases."""

import random

from folioloom.operators.changes import apply_changes, changed_fields, fold_changes

BASE = "year int, entry_id string, ingest_pos long, title string, authors_raw string, abstract string, presentation_type string"
LOG = "op_seq long, year int, entry_id string, field string, value string, patch map<string,string>, add boolean, delete boolean, title string, authors_raw string, abstract string, presentation_type string, _y string, slot string"


def op(seq, entry, year=2000, field=None, value=None, patch=None, add=None, delete=None, title=None):
    return (seq, year, entry, field, value, patch, add, delete, title, None, None, None, "clash", "clash")


def replay(base, log):
    """Each change once, in order."""
    live = {b: {} for b in base}
    gone = {}
    for _, o in sorted({o[0]: o for o in log}.items()):
        seq, year, entry, field, value, patch, add, delete = o[:8]
        if year is None or not (entry or "").strip():
            continue
        k = (year, entry.strip())
        if delete:
            if k in live:
                del live[k]
                gone[k] = seq
        elif add:
            live[k] = dict.fromkeys(("title", "authors_raw", "abstract", "presentation_type"), seq)
            gone.pop(k, None)
        elif k in live:
            for f in patch if patch is not None else [field] if field else []:
                live[k][f] = seq
    return {(*k, f, s) for k, v in live.items() for f, s in v.items()} | {(*k, "(deleted)", s) for k, s in gone.items()}


def found(spark, base, log):
    b = spark.createDataFrame([(y, e, i, "t", "a", "b", "talk") for i, (y, e) in enumerate(base)], BASE)
    return {tuple(r) for r in changed_fields(fold_changes(b, spark.createDataFrame(log, LOG))).collect()}


def test_random_logs_equal_the_replay(spark):
    rng, base, log, want = random.Random(7), [], [], set()
    for case in range(120):
        keys = [(case, e) for e in "ABC"]
        own = [k for k in keys if rng.random() < 0.5]
        ops = []
        for seq in rng.sample(range(1000), rng.randint(0, 9)):
            y, e = rng.choice(keys)
            kind = rng.choice("fppad")
            seq += case * 1000
            ops.append(op(seq, e + " " * rng.randint(0, 1), y, **{"f": dict(field="title", value=rng.choice(["", "x"])), "p": dict(patch=rng.choice([{}, {"abstract": "z"}, {"title": "q", "note": None}])), "a": dict(add=True, title="n"), "d": dict(delete=True)}[kind]))
        want |= replay(own, ops)
        base += own
        log += ops + rng.sample(ops, len(ops) // 2)
    rng.shuffle(log)
    assert found(spark, base, log) == want


def test_void_rows_nulls_and_empty_tables(spark):
    assert found(spark, [], []) == set()
    assert found(spark, [(2000, "A")], []) == set()
    void = [op(1, None, field="title", value="x"), op(2, "  ", field="title", value="x"), op(3, "A", year=None, delete=True), op(None, "A", delete=True)]
    assert found(spark, [(2000, "A")], void) == set()
    assert found(spark, [(2000, "A")], [op(5, " A ", field="title", value=None)]) == {(2000, "A", "title", 5)}


def test_long_values_hot_key_and_current_rows(spark):
    long = "x" * 200_000
    log = [op(i, "A", field="title", value=str(i)) for i in range(500)] + [op(600, "A", patch={"abstract": long})]
    b = spark.createDataFrame([(2000, "A", 1, "old", "a", "b", "talk"), (2000, "A", 2, "new", "a2", "b2", "talk")], BASE)
    row = apply_changes(b, spark.createDataFrame(log * 2, LOG), ["title", "authors_raw", "abstract"]).collect()
    assert [(r["title"], r["authors_raw"], len(r["abstract"])) for r in row] == [("499", "a2", 200_000)]
