"""Every query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point


def _norm(x):
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, dict):
        return sorted((k, _norm(v)) for k, v in x.items())
    return [_norm(y) for y in x] if isinstance(x, (list, tuple)) else x


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr([_norm(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_sql_agrees(spark, sf, duck, name):
    df = entry_point.queries()[name](spark, sf)
    res = duck.execute(entry_point.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, df.collect()) == _rows(cols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry_point.queries()) - set(entry_point.oracle_sql()) - {n for n in entry_point.queries() if n[0] == "p" and n[1].isdigit()} | {"p3_found"}))
def test_others_run(spark, sf, name):
    assert entry_point.queries()[name](spark, sf).count() >= 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_parse_abstracts_reads_every_section(spark, tmp_path):
    rows = [(1, "Noise\n\nA. Smith\n\nWe tested birds.", "business"), (2, "Noise\n\nA. Smith\n\nWe tested birds.", None), (3, None, "abstracts")]
    spark.createDataFrame(rows, "doc_id long, text string, section string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["title"] for r in entry_point.queries()["parse_abstracts"](spark, str(tmp_path)).collect()}
    assert sorted(got) == [1, 2, 3] and got[1] == got[2] == "Noise"
