"""Packed fields: a plain scanner as the brute force, and edge cases."""

import random

import pyarrow as pa
import pytest

from folioloom.operators.fields import explode_packed, split_lists

CASES = {
    None: [],
    "": [],
    "  ": [],
    "Ann Lee": ["Ann Lee"],
    "Lee, Ann": ["Lee, Ann"],
    "Lee, Ann; Bo Kim": ["Lee, Ann", "Bo Kim"],
    "Ann Lee,Bo Kim , ,Cy Ode": ["Ann Lee", "Bo Kim", "Cy Ode"],
    "Lee, A. and Kim, Bo": ["Lee, A.", "Kim, Bo"],
    '"Lee, Ann","Lab of X and Y" , “Kim, Bo”': ["Lee, Ann", "Lab of X and Y", "Kim, Bo"],
    '"Nicholas ""Nick"" Lul", Bo Kim': ['Nicholas "Nick" Lul', "Bo Kim"],
    'Valerie "Val" Bri,Hana T. Pren': ['Valerie "Val" Bri', "Hana T. Pren"],
    "Ann Lee with Bo Kim & Cy Ode, and Di Poe": ["Ann Lee", "Bo Kim", "Cy Ode", "Di Poe"],
    "A Lee\r\nB Kim\tC Ode | D Poe / E Fry;;F Gil": ["A Lee", "B Kim", "C Ode", "D Poe", "E Fry", "F Gil"],
    "STRESS AND VISION LAB; Sandy Andrews": ["STRESS AND VISION LAB", "Sandy Andrews"],
    "\u00a0Ann\u2007Lee\u00a0,\u00a0Zoë Ødé": ["Ann\u2007Lee", "Zoë Ødé"],
    'odd " quote, Bo Kim': ['odd " quote', "Bo Kim"],
    "𝐁𝐨 Kim, Ann Lee": ["𝐁𝐨 Kim", "Ann Lee"],
}


def test_cases():
    assert split_lists(pa.array(list(CASES), pa.string())).to_pylist() == list(CASES.values())


def test_slices_and_empty_batches():
    col = pa.array(list(CASES), pa.string())
    assert split_lists(col.slice(5, 4)).to_pylist() == list(CASES.values())[5:9]
    assert split_lists(pa.array([], pa.string())).to_pylist() == []


def test_random_lists_come_back():
    rng = random.Random(3)
    words = ["Ann", "Bo", "Zoë", "Ødegård", "K.", "van", "O’Neil", "山田"]
    for _ in range(300):
        names = [" ".join(rng.choice(words) for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(1, 6))]
        sep = rng.choice([",", ", ", " ; ", "|", "\n", " and ", " & ", " / ", ",, "])
        assert split_lists(pa.array([sep.join(names)])).to_pylist() == [names]
        quoted = [f'"{n}, x; y and z"' for n in names]
        assert split_lists(pa.array([sep.join(quoted)])).to_pylist() == [[q[1:-1] for q in quoted]]


@pytest.mark.parametrize("n", [0, 3])
def test_rows(spark, n):
    df = spark.createDataFrame([(1, "A Lee; B Kim", "clash"), (1, "A Lee; B Kim", "clash"), (2, None, "c"), (3, "; ".join(["A Lee"] * 20_000), "c")][: n or 4], "id long, names string, name_pos string")
    got = explode_packed(df if n else df.filter("id < 0"), "id", "names", at_least=2).collect()
    assert [tuple(r) for r in got] == ([] if not n else [(1, 1, "A Lee"), (1, 2, "B Kim")] * 2)
    if not n:
        assert explode_packed(df, "id", "names").filter("id = 3").count() == 20_000
