"""Name resolution on made-up authors with known variants, and edge cases."""

import random

import pytest

from folioloom.llm import names

SURNAMES = "Brovelund Tramosk Kildare-Fintal Wexomby Plunaric Drosvell Ostrakel Venimoor Jaskolin Hruntave".split()
GIVEN = "Nicholas Katherine Timothy Eleanor Gregory Patricia Søren Zoë Michael Deborah".split()
NICK = {"Nicholas": "Nick", "Katherine": "Kate", "Timothy": "Tim", "Eleanor": "Nell", "Gregory": "Greg", "Patricia": "Pat", "Michael": "Mike", "Deborah": "Deb"}


def classes(spark, rows):
    df = spark.createDataFrame(rows, "form_id long, form_text string, entity string, sur string")
    return {r["form_id"]: r["entity"] for r in names.resolve(df).collect()}


@pytest.mark.parametrize("text, want", [
    ("Ann M. Lee", ("person", "lee", "ann", "full", "m")), ("Lee, Ann M.", ("person", "lee", "ann", "full", "m")), ("LEE, A.", ("person", "lee", "", "init", "")), ("A. M. Lee", ("person", "lee", "", "init", "m")), ("Lee AM", ("person", "lee", "", "init", "m")),
    ("Ann. Lee", ("person", "lee", "ann", "abbr", "")), ("Liz Lee", ("person", "lee", "liz", "nick", "")), ('Elizabeth "Liz" Lee', ("person", "lee", "elizabeth", "full", "")), ("The Orr Vision & Aging Lab (OVAL-ORR)", ("org", "aging lab orr vision", "", "full", "")),
    ("Laboratory of Aging and Vision, Orr", ("org", "aging lab orr vision", "", "full", "")), (None, ("none", "", "", "", "")), ("", ("none", "", "", "", "")), ("123 --", ("none", "", "", "", "")), ("Skevøgren, Éva", ("person", "skevogren", "eva", "full", "")),
])
def test_parse(text, want):
    p = names.parse(text)
    assert (p["kind"], p["sur"], p["given"], p["gtype"], p["mid"]) == want


def variants(g, s, rng):
    i = rng.randrange(1, len(s) - 1)
    out = [f"{g} {s}", f"{s}, {g}", f"{g.upper()} {s.upper()}", f"{s}, {g[0]}.", f"{s} {g[0]}", f"{g} {s[:i]}{s[i + 1 :]}", f"{s} {g}"]
    return out + ([f"{NICK[g]} {s}", f'{g} "{NICK[g]}" {s}'] if g in NICK else [])


def test_variants_of_one_author_come_together(spark):
    rng = random.Random(1)
    people = [(g, s) for g, s in zip(GIVEN, SURNAMES)] + [(g, s) for g, s in zip(GIVEN[::-1], SURNAMES) if g[0] != GIVEN[SURNAMES.index(s)][0]]
    rows, truth = [], {}
    for n, (g, s) in enumerate(people):
        for v in variants(g, s, rng):
            truth[len(rows)] = n
            rows.append((len(rows), v, "clash", "clash"))
    got = classes(spark, rows)
    pair = lambda m: {(a, b) for a in m for b in m if a < b and m[a] == m[b]}
    found, want = pair(got), pair(truth)
    assert len(found & want) / len(want) > 0.9
    assert len(found & want) / len(found) > 0.97


def test_unclear_initials_link_to_nobody(spark):
    rows = [(1, "Ronald Lastadra", "", ""), (2, "Robert Lastadra", "", ""), (3, "LASTADRA, R.", "", ""), (4, "Lastadra, Ronald", "", "")]
    got = classes(spark, rows)
    assert got[1] == got[4] and len({got[1], got[2], got[3]}) == 3


def test_rematch_after_a_merge_settles_an_unclear_initial(spark):
    rows = [(1, "Charles Krimpel", "", ""), (2, "Krimpel, Charles", "", ""), (3, "Chrales Krimpel", "", ""), (4, "KRIMPEL, C.", "", "")] + [(10 + i, f"Charles {s}", "", "") for i, s in enumerate(SURNAMES)]
    got = classes(spark, rows)
    assert len({got[i] for i in (1, 2, 3, 4)}) == 1


def test_different_middle_initials_stay_apart(spark):
    got = classes(spark, [(1, "Ann B. Orvel", "", ""), (2, "Ann C. Orvel", "", ""), (3, "Ann Orvel", "", "")])
    assert len(set(got.values())) == 3


def test_edges(spark):
    assert classes(spark, []) == {}
    got = classes(spark, [(1, None, "", ""), (2, "", "", ""), (3, "Ann Orvel", "", ""), (4, "Ann Orvel", "", ""), (5, "x" * 5000 + " Orvel", "", "")])
    assert 1 not in got and 2 not in got and got[3] == got[4] != got[5]
    df = spark.createDataFrame([(3, "Ann Orvel"), (4, "Orvel, Ann"), (9, "Bo Kim")], "form_id long, form_text string")
    assert [tuple(r) for r in names.same_name_pairs(df).collect()] == [(3, 4)]


@pytest.mark.parametrize("typo", ["John B. Velstrmo", "Velstrmo, John B."])
def test_a_typo_meets_the_name_with_its_own_middle_initial(spark, typo):
    got = classes(spark, [(1, "John A. Velstrom", "", ""), (2, "Velstrom, John A.", "", ""), (3, "John B. Velstrom", "", ""), (4, typo, "", "")])
    assert got[3] == got[4] != got[1] == got[2]


def test_misspelt_given_names_meet_beside_short_surnames(spark):
    got = classes(spark, [(1, "Jonathan Lee", "", ""), (2, "Jonathn Lee", "", ""), (3, "Ann Lee", "", "")] + [(10 + i, f"Jonathan {s}", "", "") for i, s in enumerate(SURNAMES)])
    assert got[1] == got[2] != got[3]
