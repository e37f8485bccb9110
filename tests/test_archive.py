"""Overlay, diagnosis, sheets, graph, keys, sources, sinks and streams on small fixtures."""

import json
import random

import pytest
from pyspark.sql import functions as F

from folioloom.operators import analytics, bibliography, diagnosis, overlay, segments, sheet
from folioloom.sources import files, sinks
from folioloom.streaming import log as stream

BASE = "ingest_pos long, year int, entry_id string, title string, abstract string, authors_raw string, presentation_type string, qa_flags array<string>, target string"
LOG = "line_no long, year int, entry_id string, field string, value string, patch map<string,string>, add boolean, delete boolean, title string, abstract string, authors_raw string, presentation_type string, kind string"
FIELDS = ["title", "abstract", "authors_raw", "presentation_type"]


def line(n, entry, field=None, value=None, patch=None, add=None, delete=None, title=None):
    return (n, 1990, entry, field, value, patch, add, delete, title, None, None, None, "clash")


def laid(spark, log, mode="append", base=None):
    b = spark.createDataFrame([(1, 1990, "T1", "A", "", "X", "talk", ["no-abstract"], "clash")] if base is None else base, BASE)
    out = overlay.overlay(b, spark.createDataFrame(log, LOG), FIELDS, mode)
    return sorted((r["entry_id"], r["origin"], r["title"], r["abstract"], r["qa_flags"]) for r in out.collect())


FIRST = ("T1", "base", "A", "", ["no-abstract"])


@pytest.mark.parametrize("log, want", [
    ([], [FIRST]),
    ([line(1, "T1", "title", "B"), line(2, "T1", patch={"title": "C"})], [("T1", "base", "C", "", ["no-abstract"])]),
    ([line(1, "T1", patch={"abstract": "x"})], [("T1", "base", "A", "x", [])]),
    ([line(1, "T1", patch={"abstract": "x"}), line(2, "T1", patch={"abstract": ""})], [("T1", "base", "A", "", [])]),
    ([line(1, "T9", patch={"title": "x"})], [FIRST]),
    ([line(1, "T9", patch={"title": "x"}), line(2, "T9", add=True, title="n")], [FIRST, ("T9", "add", "n", "", [])]),
    ([line(1, "T9", add=True, title="n"), line(2, "T9", patch={"title": "x"})], [FIRST, ("T9", "add", "x", "", [])]),
    ([line(1, "T1", delete=True), line(2, "T1", patch={"title": "x"})], []),
    ([line(1, "T9", add=True, title="n"), line(2, "T9", delete=True)], [FIRST, ("T9", "add", "n", "", [])]),
    ([line(1, "T1", add=True, title="n")], [("T1", "add", "n", "", []), FIRST]),
    ([line(1, None, patch={"title": "x"})], [FIRST]),
])
def test_overlay_append(spark, log, want):
    assert laid(spark, log) == want


def test_overlay_replace(spark):
    assert laid(spark, [line(1, "T9", add=True, title="n"), line(2, "T9", delete=True)], "replace") == [FIRST]
    assert laid(spark, [line(1, "T1", add=True, title="n")], "replace") == [("T1", "add", "n", "", [])]
    assert laid(spark, [], "replace", base=[]) == []
    with pytest.raises(ValueError):
        laid(spark, [], "other")


def test_last_before_equals_a_loop(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), n, n if rng.random() < 0.1 else None) for n in range(400)]
    got = {(r["k"], r["n"]): r["p"] for r in overlay.last_before(spark.createDataFrame(rows, "k string, n long, v long"), ["k"], "n", "v", "p").collect()}
    last = {}
    for k, n, v in rows:
        assert got[(k, n)] == last.get(k)
        last[k] = v if v is not None else last.get(k)


TAGS = [
    ("multi-entry-numerated", "abstract", "Text.\n 12) Another"), ("multi-entry-initials", "abstract", "Text.\nA. B. Smith wrote"), ("multi-entry-allcaps-title", "abstract", "Text.\nEFFECTS OF NOISE ON LEARNING\nMore"),
    ("embedded-schedule", "abstract", "at 9:30 - 10:15 we"), ("embedded-day-header", "abstract", "Tuesday, April 8"), ("triple-newline", "abstract", "a\n\n\nb"), ("page-footer-leak", "abstract", "PAGE 12 more"), ("orphan-pagenum", "abstract", "a\n 12 \nb"),
    ("trailing-numeral", "abstract", "a\n 12"), ("abstract-affiliation-head", "abstract", "A. Smith\nDepartment of Tests"), ("abstract-very-long", "abstract", "x" * 3001), ("abstract-suspicious-long", "abstract", "x" * 2201), ("abstract-too-short", "abstract", "x" * 59),
    ("title-too-long", "title", "x" * 221), ("title-is-abstract", "title", "In birds we found recall"), ("title-has-newline", "title", "A\nB"), ("author-has-digit", "authors_raw", "Smith1"), ("author-has-place", "authors_raw", "Smith, Toronto"),
    ("author-lowercase-initial", "authors_raw", "f. Smith"),
]


def test_each_tag_and_its_negatives(spark):
    rows = [(t, *(v if f == c else None for c in ("title", "authors_raw", "abstract"))) for t, f, v in TAGS] + [("none", "x" * 220, "Ann Smith", "x" * 2200), ("none", None, None, None), ("none", "", "", "")]
    found = diagnosis.findings(spark.createDataFrame(rows, "want string, title string, authors_raw string, abstract string"), ["want"]).collect()
    assert {r["want"] for r in found if r["tag"] == r["want"]} == {t for t, _, _ in TAGS}
    assert not [r for r in found if r["want"] == "none"]


def test_share_of_nothing(spark):
    empty = spark.createDataFrame([], "title string, authors_raw string, abstract string")
    assert tuple(diagnosis.share_flagged(empty).first()) == (0, 0, None)


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 60), rng.randint(61, 120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 260)]
    got = {r["node"]: r["component"] for r in analytics.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    assert got == root
    assert analytics.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_streaks_skip_gaps_of_the_calendar(spark):
    rows = [("x", y) for y in (2018, 2019, 2022, 2022)] + [("y", y) for y in (2018, 2023)] + [("z", None)]
    got = {r["w"]: (r["streak"], r["first"], r["last"]) for r in analytics.streaks(spark.createDataFrame(rows, "w string, t int"), "w", "t").collect()}
    assert got == {"x": (3, 2018, 2022), "y": (1, 2018, 2018)}


def test_citekeys_are_unique_even_when_bases_clash(spark):
    rows = [(i, 1990, str(i), "Ann Smith", t) for i, t in enumerate(["Memory"] * 30 + ["Memorya", "Memoryb"])]
    keys = [r["citekey"] for r in bibliography.citekeys(spark.createDataFrame(rows, "ingest_pos long, year int, entry_id string, authors_raw string, title string")).collect()]
    assert len(set(keys)) == len(rows) and all(k.isalnum() for k in keys)


def test_unknown_year_raises_unless_lenient(spark):
    r, y = spark.createDataFrame([(2021,)], "year int"), spark.createDataFrame([(2019, "B", "verified")], "year int, booktitle string, source string")
    with pytest.raises(Exception, match="no booktitle"):
        bibliography.with_booktitle(r, y).collect()
    assert bibliography.with_booktitle(r, y, strict=False).first()["booktitle"] is None
    assert [x[0] for x in spark.range(1).select(bibliography.ordinal(F.lit(2019), y)).collect()] == [1]


def test_row_hash_is_that_of_the_json(spark):
    import hashlib

    row = (1990, "T1", 'A "q" \\ é\n', "", "", "TRUE")
    df = spark.createDataFrame([(1, *row, None, None, "fixed")], "row_no long, year int, entry_id string, title_fix string, authors_fix string, abstract_fix string, delete_flag string, reviewer string, notes string, status string")
    want = hashlib.sha256(json.dumps({"y": 1990, "e": "T1", "t": 'A "q" \\ é', "a": "", "ab": "", "d": True}, sort_keys=True, ensure_ascii=False).encode()).hexdigest()[:16]
    assert sheet.hashed_rows(df).first()["hash"] == want


def test_pull_outcomes(spark):
    cols = "row_no long, year int, entry_id string, title_fix string, authors_fix string, abstract_fix string, delete_flag string, reviewer string, notes string, status string, _snapshot_title string, _snapshot_authors string, _snapshot_abstract string"
    row = lambda n, e, fix="", d=None, s="fixed", snap="A": (n, 1990, e, fix, None, "", d, None, None, s, snap, "", None)
    rows = [row(1, "T1", s="untouched"), row(2, "T9", "x"), row(3, "T1", "x", snap="old"), row(4, "T1", "A"), row(5, "T1", "B"), row(6, "T1", "B"), row(7, "T1", d="TRUE", s="untouched"), row(8, " ", "x"), (9, None, "T1", "x", "", "", None, None, None, "fixed", "A", "", "")]
    current = spark.createDataFrame([(1990, "T1", "A", "", "")], "year int, entry_id string, title string, authors_raw string, abstract string")
    none = spark.createDataFrame([], "_sheet_hash string")
    out = {r["row_no"]: r for r in sheet.pull(spark.createDataFrame(rows, cols), current, none).collect()}
    assert {k: v["outcome"] for k, v in out.items()} == {1: "ignored", 2: "missing", 3: "drifted", 4: "unchanged", 5: "patch", 6: "repeated", 7: "delete"}
    assert out[5]["patch"] == {"title": "B"} and out[5]["reviewer"] == "anonymous" and out[3]["drift"] == "title"
    known = spark.createDataFrame([(v["hash"],) for v in out.values()], "_sheet_hash string")
    again = sheet.pull(spark.createDataFrame(rows, cols), current, known)
    assert sheet.changes_of(again, "2026-01-01").count() == 0


def test_diff_then_apply_gives_the_new_copy(spark):
    cols = "year int, entry_id string, title string, abstract string"
    old = spark.createDataFrame([(1, "A", "t", "x"), (1, "B", "t", None), (1, "C", "gone", "")], cols)
    new = spark.createDataFrame([(1, "A", " t ", "y"), (1, "B", "t", ""), (1, "D", "fresh", "")], cols)
    got = sorted((r["entry_id"], r["op"], r["patch"]) for r in overlay.diff_to_changes(old, new, ["title", "abstract"]).collect())
    assert got == [("A", "patch", {"abstract": "y"}), ("C", "delete", None), ("D", "unknown", None)]


def test_blocks_partition_the_tail(spark):
    df = spark.createDataFrame([(1, "intro\nT1) One\n\nbody\nTlO) Two\nmore"), (2, None), (3, "nothing")], "id long, t string")
    got = [(r["label"], r["block"]) for r in segments.blocks(df, "id", "t", "paren").orderBy("block_pos").collect()]
    assert got == [("T1", "One\n\nbody"), ("T10", "Two\nmore")]
    nums = spark.createDataFrame([(1, "1. Smith one\n\nS. Jones two\nl. not this")], "id long, t string")
    assert [r["label"] for r in segments.blocks(nums, "id", "t", "number").orderBy("block_pos").collect()] == ["1", "5"]


def test_sources(spark, tmp_path):
    (tmp_path / "Program 1990.txt").write_bytes(b"a\r\nb\x0cc\xff")
    (tmp_path / "Program 1990.rtf").write_bytes(rb"{\rtf1 caf\'e9\par}")
    (tmp_path / "Notes.txt").write_text("no year")
    (tmp_path / "Program 1991.PDF").write_text("suffix in capitals")
    found = files.scan(spark, str(tmp_path))
    assert sorted(r["name"] for r in found.select("name").collect()) == ["Program 1990.rtf", "Program 1990.txt"]
    assert [r["name"] for r in files.best_source(found).select("name").collect()] == ["Program 1990.txt"]
    assert [r["name"] for r in files.best_source(found, {1990: "Program 1990.rtf"}).select("name").collect()] == ["Program 1990.rtf"]
    docs = files.decode(files.best_source(found))
    assert docs.first()["text"] == "a\nb\n\nc�"
    with pytest.raises(ValueError):
        files.gate(docs)
    assert files.source_links(found, "s/").first()["link"] == "s/Program%201990.rtf"


def test_external_decoders_read_standard_input(spark):
    assert files._external("cat")("é".encode()) == "é"
    df = spark.createDataFrame([(1990, "x.pdf", "pdf", bytearray(b"no pdf"))], "year int, name string, suffix string, content binary")
    assert files.decode(df).first()["text"] is None and files.decode(df).first()["failed"]


def test_readers(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"year": 1990, "entry_id": "T1"}\n  {"year":\n1991, "qa_flags": ["x"]}{"year": 1992}')
    assert sorted(r["year"] for r in files.read_concatenated(spark, str(tmp_path / "r.json")).collect()) == [1990, 1991, 1992]
    (tmp_path / "c.jsonl").write_text('# note\n\n{"year": 1990, "entry_id": "T1", "patch": {"title": "é"}}\n{bad\n')
    good, bad = files.read_changes(spark, str(tmp_path / "c.jsonl"))
    assert [(r["line_no"], r["patch"]) for r in good.collect()] == [(3, {"title": "é"})]
    assert [(r["line_no"], r["line"]) for r in bad.collect()] == [(4, "{bad")]
    tabs = tmp_path / "tabs"
    tabs.mkdir()
    (tabs / "1990.csv").write_text(",".join(sheet.COLUMNS) + "\n1990,T1\n")
    (tabs / "1991.csv").write_text("year,wrong\n1991,T1\n")
    assert [(r["year"], r["entry_id"], r["status"]) for r in files.read_sheet(spark, str(tabs), sheet.COLUMNS).collect()] == [("1990", "T1", None)]


def test_a_log_of_two_batches_has_one_order(spark, tmp_path):
    base = spark.createDataFrame([(1, 1990, "B1", "B one", [])], "ingest_pos long, year int, entry_id string, title string, qa_flags array<string>")
    add = lambda title: [(1990, "B1", True, title, None)]
    shape = "year int, entry_id string, add boolean, title string, patch map<string,string>"
    path = str(tmp_path / "log")
    sinks.append_changes(spark.createDataFrame(add("A first"), shape), path, "z", "2026-01-01")
    sinks.append_changes(spark.createDataFrame([*add("A second"), (1990, "B1", None, None, {"title": "changed"})], shape).coalesce(1), path, "a", "2026-01-02")
    log, bad = files.read_changes(spark, path)
    assert bad.count() == 0 and log.count() == log.select("line_no").distinct().count() == 3
    got = {r["row_id"]: r["title"] for r in overlay.overlay(base, log, ["title"]).collect()}
    assert sorted(got.values()) == ["A first", "B one", "changed"] and len(got) == 3
    sinks.append_changes(spark.createDataFrame(add("A again"), shape), path, "z", "2026-01-03")
    again = files.read_changes(spark, path)[0].orderBy("line_no").collect()
    assert [r["title"] for r in again] == ["A again", "A second", None]


def test_lines_are_numbered_through_splits(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(f'{{"year": {i}, "entry_id": "{name}"}}' for i in range(400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = files.read_changes(spark, str(tmp_path))[0].select("line_no", "entry_id", "year").orderBy("line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [tuple(r) for r in got] == [(i + 1, "ab"[i // 400], i % 400) for i in range(800)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1990, "T1", "@a{x,\n}\n")], "ingest_pos long, year int, entry_id string, entry string")
    sinks.write_entries(rows, str(tmp_path / "bib"))
    assert "@a{x," in "".join(r["value"] for r in spark.read.text(str(tmp_path / "bib/1-entries")).collect())
    change = spark.createDataFrame([(1990, "T1", "patch")], "year int, entry_id string, op string")
    for _ in range(2):
        sinks.append_changes(change, str(tmp_path / "log"), "b1")
    assert files.read_changes(spark, str(tmp_path / "log"))[0].count() == 1
    y = lambda n: spark.createDataFrame([(n, "T1")], "year int, entry_id string")
    for n in (1990, 1991, 1990):
        sinks.upsert_sheet(y(n), str(tmp_path / "sheet"))
    assert spark.read.parquet(str(tmp_path / "sheet")).count() == 2
    assert "| 1990 |" in sinks.report("R", {"t": y(1990)})
    calls, waits = [], []

    def write():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("quota")

    sinks.with_retry(write, lambda e: "quota" in str(e), sleep=waits.append)
    assert waits == [45.0, 90.0]
    with pytest.raises(KeyError):
        sinks.with_retry(lambda: {}["x"], lambda e: False)


def test_stream_counts_repeats_once(spark, tmp_path, sf):
    log = spark.read.parquet(f"{sf}/corrections.parquet")
    log.unionByName(log).coalesce(1).write.parquet(str(tmp_path / "in"))
    base = spark.read.parquet(f"{sf}/records.parquet")
    lines = stream.arriving(spark, str(tmp_path / "in"), log.schema)
    stream.keep_current(lines, base, str(tmp_path / "log"), str(tmp_path / "out"), ["title"], str(tmp_path / "cp")).awaitTermination()
    from folioloom.operators.changes import apply_changes

    want = {tuple(r) for r in apply_changes(base, log, ["title"]).collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == want
    assert spark.read.parquet(str(tmp_path / "log")).count() == log.select("op_seq").distinct().count()


def test_late_lines_reach_the_current_table(spark, sf, tmp_path):
    log = spark.read.parquet(f"{sf}/corrections.parquet").limit(0)
    base = spark.read.parquet(f"{sf}/records.parquet").limit(1).cache()
    key = base.first()
    for n, (title, day) in enumerate([("new", "2024-06-01"), ("old", "2024-06-02"), ("late", "2020-01-01")], 1):
        row = {"line_no": n, "op_seq": n, "year": key["year"], "entry_id": key["entry_id"], "field": "title", "value": title}
        part = spark.createDataFrame([row], "line_no long, op_seq long, year int, entry_id string, field string, value string").withColumn("received_at", F.lit(day).cast("timestamp"))
        log.unionByName(part.withColumn("received_at", F.col("received_at").cast(log.schema["received_at"].dataType)), allowMissingColumns=True).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    lines = stream.arriving(spark, str(tmp_path / "in"), log.schema, per_trigger=1)
    stream.keep_current(lines, base, str(tmp_path / "log"), str(tmp_path / "out"), ["title"], str(tmp_path / "cp")).awaitTermination()
    assert [r["title"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["late"]
