"""A whole run on two small programs."""

import json

from folioloom.plans import pipeline
from folioloom.sources import files

BODY = "We tested recall in birds over ten days and found that it lasted for the whole of that time."


def test_rebuild(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "Program 2005.txt").write_text(f"T1) Memory in pigeons\n\nA. Smith & B. Jones\n\n{BODY}\n\nT2) Noise in rats\n\nC. Lee\n\n{BODY}\n 12 \n")
    (src / "Program 2024.txt").write_text(f"T1) TALK TITLE: Sleep and song\nAUTHORS: A. Smith & B. Jones\nABSTRACT: {BODY}\n")
    log = tmp_path / "log.jsonl"
    log.write_text("\n".join(map(json.dumps, [{"year": 2005, "entry_id": "T1", "patch": {"title": "Memory in crows"}}, {"year": 2005, "entry_id": "T2", "delete": True}, {"year": 2024, "entry_id": "T9", "add": True, "title": "Added", "authors_raw": "D. Poe"}])))
    years = spark.createDataFrame([(2005, "B 2005", "verified"), (2024, "B 2024", "inferred")], "year int, booktitle string, source string")
    current = pipeline.rebuild(spark, str(src), str(log), years, str(tmp_path / "out"), least=0)
    got = {(r["year"], r["entry_id"]): r for r in current.collect()}
    assert {k: v["title"] for k, v in got.items()} == {(2005, "T1"): "Memory in crows", (2024, "T1"): "Sleep and song", (2024, "T9"): "Added"}
    assert got[(2005, "T1")]["abstract"] == BODY and got[(2005, "T1")]["source_file"] == "Program 2005"
    bib = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "out/bibliography/1-entries")).collect())
    assert "@inproceedings{smith2005memory," in bib and "author = {Smith, A. and Jones, B.}" in bib and "booktitle inferred" in bib
    assert "| total |" in "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "out/report")).collect())
    stats = json.loads(pipeline.statistics(current, least_edge=2, least_node=1).first()["stats"])
    assert stats["total_records"] == 3 and stats["unique_authors"] == 3 and stats["network"] == {"nodes": 2, "edges": 1, "node_threshold": 1, "edge_threshold": 2}
    assert stats["yearly_top"] and {"top_streaks", "shortest_titles", "longest_titles", "yearly_word"} <= set(stats)


def test_a_second_pull_adds_nothing(spark, tmp_path, sf):
    from folioloom.plans import archive

    current, rows = archive.current(spark, sf), spark.read.parquet(f"{sf}/sheet_rows.parquet")
    log = spark.read.parquet(f"{sf}/corrections.parquet").select("_sheet_hash")
    first = pipeline.pull_into_log(rows, current, log, str(tmp_path / "log"), "b1", "2026-01-01")
    n = first.filter("outcome in ('patch', 'delete')").count()
    assert n > 0 and files.read_changes(spark, str(tmp_path / "log"))[0].count() == n
    again = pipeline.pull_into_log(rows, current, log.unionByName(files.read_changes(spark, str(tmp_path / "log"))[0].select("_sheet_hash")), str(tmp_path / "log"), "b2", "2026-01-02")
    assert again.filter("outcome in ('patch', 'delete')").count() == 0
