"""Properties of the plain functions, and results that don't depend on partitioning."""

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from folioloom.functions import text
from folioloom.operators import entries as e
from folioloom.operators.fields import split_lists

ANY = st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \t\n\r\x0c ​́-,.;:\"“”T1)")), max_size=80)


@given(ANY)
@settings(max_examples=300, deadline=None)
def test_normalisers_are_idempotent(s):
    assert e.plain(e.plain(s)) == e.plain(s)
    assert e.block_of(e.block_of(s)) == e.block_of(s)
    assert e.spaces(e.spaces(s)) == e.spaces(s)


@given(ANY)
@settings(max_examples=300, deadline=None)
def test_parsers_take_any_text(s):
    for read in (e.title_first, e.author_first, e.inline):
        read(s)
    e.normal_authors(s)
    e.finish(2005, "T1", e.Parts(s, s, s), "x")


@given(st.lists(st.tuples(st.sampled_from(["T1", "t 1", "P2", "3"]), st.text("ab\n", max_size=8)), max_size=9))
@settings(max_examples=200, deadline=None)
def test_one_block_a_label_in_order_of_appearance(blocks):
    kept = e.best_of_label(blocks)
    bare = lambda x: "".join(c for c in x.upper() if c.isalnum())
    assert [bare(k) for k, _ in kept] == list(dict.fromkeys(bare(k) for k, _ in blocks))
    assert all(b in blocks for b in kept)


@given(st.lists(st.one_of(st.none(), ANY), max_size=6))
@settings(max_examples=200, deadline=None)
def test_packed_values_are_in_the_field_in_order(values):
    for v, parts in zip(values, split_lists(pa.array(values, pa.string())).to_pylist()):
        at = 0
        for p in parts:
            plain = p.replace('"', "")
            at = (v or "").replace('"', "").find(plain, at)
            assert plain.strip() == plain and at >= 0


@pytest.mark.parametrize("years", [[2018, 2019, 2022], [1990], []])
def test_word_counts_agree_with_python(spark, years):
    import re

    rows = [(f"café noir {y} x_y",) for y in years]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(text.word_count(F.col("t"))).collect()]
    assert got == [len(re.findall(r"\b\w+\b", r[0])) for r in rows]


@pytest.mark.parametrize("name", ["best_blocks", "citekeys", "overlay_append", "author_top25", "coauthor_components", "p2_found", "p4_found", "term_overrep"])
def test_results_do_not_depend_on_partitions(spark, sf, name):
    results = set()
    for n in ("1", "7", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.add(str(sorted(map(str, entry_point.queries()[name](spark, sf).collect()))))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(results) == 1
