"""Look-alikes, truncation, scan noise and encodings: planted cases found, clean ones left, edge cases."""

import random

import pytest

from folioloom.llm import encodings, lookalikes, ocr, truncation


# ---- look-alikes ----
@pytest.mark.parametrize("text, hit", [
    ("plain text", False), ("", False), (None, False), ("café “quoted” – — it’s", False), ("α = .05, β waves, 5 °C ± 2 µm²", False), ("книга and λόγος", False), ("lost � sign", False), ("line\nend\ttab", False), ("¬ sign", False),
    ("wоrd", True), ("οf", True), ("ｆull width", True), ("𝐛old", True), ("ﬁnd", True), ("cafe\u0301", True), ("no\u00a0break", True), ("zero\u200bwidth", True), ("soft\u00adhyphen", True), ("hy\u2011phen", True), ("273 \u212a", True), ("Anna М. Lee", True),
])
def test_lookalikes(text, hit):
    assert lookalikes.is_affected(text) is hit


@pytest.mark.parametrize("a, b", [("cafe\u0301", "café"), ("ｗord", "wоrd"), ("a\u00a0b", "A  b"), ("x\u200by", "xy"), ("ﬁne", "FINE"), ("hy\u2011phen", "hy-phen"), ("Straße", "STRASSE")])
def test_forms_meet(a, b):
    assert lookalikes.form(a) == lookalikes.form(b) == lookalikes.form(lookalikes.form(a))


def test_unify_frame(spark):
    df = spark.createDataFrame([(1, "wоrd", None, "c"), (1, "wоrd", "", "c"), (2, "x" * 500_000 + "\u200b", "a", "c")], "id long, a string, b string, field_name string")
    assert sorted((r["id"], r["field_name"]) for r in lookalikes.affected_values(df, "id", ["a", "b"]).collect()) == [(1, "a"), (2, "a")]
    assert lookalikes.unify(df.filter("id > 9"), "id", ["a", "b"]).count() == 0
    assert [tuple(r)[1:] for r in lookalikes.form_classes(df.filter("id = 2"), "a").collect()] == [(1, 1)]
    twice = df.filter("id = 2")
    assert [tuple(r)[1:] for r in lookalikes.form_classes(twice.unionByName(twice), "a").collect()] == [(2, 1)]


# ---- truncation ----
SENTENCES = ["The rats were tested in a maze", "Results showed that sleep altered recall", "We discuss these results in terms of a model", "Half of the birds received training for ten days", "Lesions of the cortex reduced the effect"]


def corpus(rng, n=400):
    rows, cut = [], set()
    for i in range(n):
        source = f"S{i % 4}"
        text = ". ".join(rng.choice(SENTENCES) for _ in range(rng.randint(4, 9))) + "."
        if rng.random() < 0.1:
            text += rng.choice([" Funded in part by a grant to the author", " Supervised by the lake group"])
        if source == "S0" and len(text) > 300 and not text[:300].rstrip().endswith("."):
            text = text[:300]
            cut.add(i)
        elif rng.random() < 0.05:
            text = text[: text.index(" ", 60) - 2]
            if not text.endswith("."):
                cut.add(i)
        rows.append((i, source, text, "clash", 1))
    return rows, cut


def test_truncation_finds_planted_cuts(spark):
    rows, cut = corpus(random.Random(8))
    df = spark.createDataFrame(rows, "id long, src string, t string, _src string, basis int")
    got = {r["id"]: r["basis"] for r in truncation.truncated(df, "id", "t", "src").collect()}
    assert len(set(got) & cut) >= 0.97 * len(cut) and len(set(got) - cut) <= 0.03 * len(rows)
    assert {"limit", "transfer"} <= set(got.values())
    rates = {r["src"]: r["share_cut"] for r in truncation.truncation_rates(df, "id", "t", "src").collect()}
    assert rates["S0"] > 3 * rates["S1"]


def test_truncation_edges(spark):
    rows = [(1, None, None), (2, None, ""), (3, "S", "  "), (4, None, "Withdrawn."), (5, "S", "Ends with a mark ..."), (6, "S", "So it was cut [...]"), (7, "S", "x" * 400_000)]
    got = {r["id"]: r["basis"] for r in truncation.truncated(spark.createDataFrame(rows, "id long, src string, t string"), "id", "t", "src").collect()}
    assert got == {5: "marked", 6: "marked", 7: "transfer"}
    empty = spark.createDataFrame([], "id long, src string, t string")
    assert truncation.truncated(empty, "id", "t", "src").count() == truncation.truncation_rates(empty, "id", "t", "src").count() == 0


def test_copies_of_a_cut_text_are_no_proof_of_its_ending(spark):
    rows, _ = corpus(random.Random(8))
    copy = SENTENCES[0] + ". Zebras were subsequently placed inside the"
    rows += [(1000 + i, "S1", copy, "", 1) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, src string, t string, _src string, basis int")
    got = {r["id"] for r in truncation.truncated(df, "id", "t", "src").collect()}
    assert set(range(1000, 1200)) <= got


def test_a_spike_decides_values_that_end_with_a_complete_word(spark):
    rng = random.Random(8)
    rows, _ = corpus(rng)
    words = ["memory", "sleep", "birds", "recall"]
    rows += [(1000 + i, "S1", f"{'. '.join(rng.choice(SENTENCES) for _ in range(4))}. Keywords: {rng.choice(words)}, {rng.choice(words)}", "", 1) for i in range(40)]
    head = "Keywords: noise, mazes, lesions, memory"
    at_limit = lambda tail: (". ".join([SENTENCES[0]] * 12) + ". ")[: 298 - len(tail)] + ". " + tail
    rows += [(2000, "S0", at_limit(head), "", 1), (2001, "S0", at_limit("Keywords: memory, sleep"), "", 1)]
    df = spark.createDataFrame(rows, "id long, src string, t string, _src string, basis int")
    got = {r["id"]: r["basis"] for r in truncation.truncated(df, "id", "t", "src").collect()}
    assert got.get(2000) == "limit" and 2001 not in got and not set(range(1000, 1040)) & set(got)


@pytest.mark.parametrize("text, form", [("\u03c1aper", "paper"), ("\u0261oogle", "google"), ("\u13aapple", "apple"), ("pa\u0442h", "path"), ("\ua4d0ird", "bird"), ("\u0570eart", "heart")])
def test_lookalikes_of_other_alphabets(text, form):
    assert lookalikes.is_affected(text) and lookalikes.form(text) == form


@pytest.mark.parametrize("text", ["\u0939\u093f\u0928\u094d\u0926\u0940 \u092e\u0947\u0902", "\u05e9\u05c1\u05b8\u05dc\u05d5\u05b9\u05dd", "\u03b1-level", "\u03c4max", "TNF-\u03b1", "\u03c1 = .4", "\u03b7p", "\u043f\u0440\u0438\u0432\u0435\u0442"])
def test_other_scripts_and_symbols_are_no_lookalikes(text):
    assert not lookalikes.is_affected(text)


# ---- scan noise ----
CLEAN = "Recognition memory in pigeons was examined during a delayed matching task and the older group performed better than the control group in every session of training."


@pytest.fixture(scope="module")
def model(spark):
    heads = [f"Recognition memory in pigeons\nAnnual Research Meeting   {i}\nwas examined during training." for i in range(5)]
    df = spark.createDataFrame([(i, CLEAN, None) for i in range(60)] + [(100 + i, h, "") for i, h in enumerate(heads)], "id long, abstract string, title string")
    return ocr.learn(df, ["abstract", "title"])


@pytest.mark.parametrize("text, kinds, fixed", [
    (CLEAN, [], CLEAN), ("Recog-\nnition memory in pigeons.", ["broken"], "Recognition memory in pigeons."), ("Recog- nition memory.", ["broken"], "Recognition memory."), ("Recog¬\nnition memory.", ["broken"], "Recognition memory."),
    ("Recog -\nnition memory.", ["broken"], "Recognition memory."), ("R e c o g n i t i o n memory.", ["spaced"], "Recognition memory."), ("D u r i n g a training session.", ["spaced"], "During a training session."), ("Rec0gnitlon rnemory in pigeon5.", ["misread"], "Recognition memory in pigeons."), ("RECOGNITION MEIVIORY.", ["misread"], "RECOGNITION MEMORY."),
    ("memory in\n\n- 12 -\n\npigeons.", ["furniture"], "memory in\n\npigeons."), ("memory in Annual Research Meeting 77 pigeons.", ["furniture"], "memory in pigeons."), ("memory in pigeons ____ 16", ["furniture"], "memory in pigeons"),
    ("A Recognition\nMemory Meeting", [], "A Recognition Memory Meeting"), ("memory in\npigeons was examined.", [], "memory in pigeons was examined."), ("memory during training (see page 24 of it).", [], "memory during training (see page 24 of it)."),
])
def test_repairs(model, text, kinds, fixed):
    assert ocr.repair(text, model) == (fixed, kinds)


def test_the_end_of_cut_text_is_not_judged(model):
    assert ocr.repair("memory in pigeons was exarn", model)[1] == []


def test_repair_frame(spark):
    df = spark.createDataFrame([(1, "Recog-\nnition memory.", None, "c"), (1, "Recog-\nnition memory.", "", "c"), (2, CLEAN * 300, "memory", "c")], "id long, abstract string, title string, value string")
    got = [(r["id"], r["field_name"], r["kinds"]) for r in ocr.repair_fields(df, "id", ["abstract", "title"]).collect()]
    assert sorted(got) == [(1, "abstract", ["broken"])] * 2
    assert ocr.repair_fields(df.filter("id > 9"), "id", ["abstract", "title"]).count() == 0


def test_copies_do_not_make_a_misreading_a_word(spark):
    bad = "Recognition rnemory in pigeons and mem ory in birds was examined."
    rows = [(i, f"Trial {i} of recognition memory in pigeons was examined.") for i in range(60)] + [(1000 + i, bad) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, abstract string")
    got = {r["id"]: (r["kinds"], r["repaired"]) for r in ocr.repair_fields(df, "id", ["abstract"]).collect()}
    want = (["misread", "spaced"], "Recognition memory in pigeons and memory in birds was examined.")
    assert all(got[1000 + i] == want for i in range(30)) and not set(got) & set(range(60))


# Words in places of their own, so that each place tells its words apart.
PLACES = ["The hungry pigeon pecked the bright key", "A tired student read the long novel", "Every nurse washed the small kitchen table", "The old sailor mended a torn net"]


def _corpus(times=40):
    return [f"{PLACES[i % len(PLACES)]} in trial {i} of the morning." for i in range(times * len(PLACES))]


def test_vectors_decide_what_a_rare_word_is(spark):
    texts = [*_corpus(), "The hungry pigeon peeked the bright key in the morning.", "The o1d sailor mended a torn net in the morning.", "The hungry pigeon pecked the bright kitclien in the morning."]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, abstract string")
    got = {r["id"]: r["repaired"] for r in ocr.repair_fields(df, "id", ["abstract"]).collect()}
    # 'peeked' has strokes of 'pecked'; 'kitclien' is 'kitchen', which has no place after 'bright'.
    assert got == {160: "The hungry pigeon pecked the bright key in the morning.", 161: "The old sailor mended a torn net in the morning."} | ({162: got[162]} if 162 in got else {})
    m = ocr.learn(df, ["abstract"])
    assert m.fix("o1d", ["the", "sailor", "mended"]) == "old"
    m.vectors, m.contexts = {}, {}
    assert m.fix("o1d", ["the", "sailor", "mended"]) is None


def test_rare_words_are_asked_for_whatever_the_size(spark, monkeypatch):
    """The same text is repaired alike when no word is frequent enough to be broadcast but the contexts."""
    texts = [*_corpus(), "The old sailor men- ded a torn net.", "The o l d e r sailor.", "An older sailor, an older nurse, an older pigeon.", "The older student.", "Every older nurse.", "The mended net wa- shed ashore."]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, abstract string")
    small = sorted((r["id"], r["kinds"], r["repaired"]) for r in ocr.repair_fields(df, "id", ["abstract"]).collect())
    monkeypatch.setattr(ocr, "HOT_SHARE", 3e-2)
    large = sorted((r["id"], r["kinds"], r["repaired"]) for r in ocr.repair_fields(df, "id", ["abstract"]).collect())
    assert small == large and {r[0] for r in small} == {160, 161, 165}


# ---- encodings ----
@pytest.mark.parametrize("chain", sorted(encodings.CHAINS))
def test_chains_invert(chain):
    text = "élève à Ålborg – “señor”"
    for word in text.split():
        seen = word
        try:
            for true, read in encodings.CHAINS[chain]:
                raw = seen.encode(true)
                seen = "".join(encodings._DEC[read][b] for b in raw)
        except UnicodeEncodeError:
            continue
        if seen != word:
            assert encodings.invert(seen, chain) == word


WORDS = "été mémoire après séance élèves présentés über früher Vögel geprüft señalan sueño después sesión naïve café — don’t".split()


def garble(text, chain):
    for true, read in encodings.CHAINS[chain]:
        text = "".join(encodings._DEC[read][b] for b in text.encode(true, "replace"))
    return text


def test_encodings_found_and_restored(spark):
    rng = random.Random(6)
    rows, bad = [], {}
    for i in range(400):
        clean = " ".join(rng.choice([*WORDS, "the", "of", "test"]) for _ in range(30))
        text = clean
        if i % 12 == 0:
            text = garble(clean, rng.choice(["utf8-cp1252", "utf8-mac", "utf8-cp437", "utf8-cp1252-twice", "cp1252-cp1251"]))
            bad[i] = clean
        rows.append((i, text, f"s{i % 3}", "clash"))
    rows += [(1000, None, "s1", ""), (1001, "", None, ""), (1002, "été " * 50_000, None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, word string")
    fixed = {r["doc_id"]: r["restored"] for r in encodings.repair(df).collect()}
    assert set(fixed) == set(bad)
    assert sum(fixed[i] == bad[i] for i in bad) >= 0.9 * len(bad)


def test_lost_characters_are_found(spark):
    df = spark.createDataFrame([(1, "r�sultats"), (2, "résultats"), (3, "“λόγοςâ\x80\x9d")], "doc_id long, text string").selectExpr("*", "'s' as source")
    assert sorted((r["doc_id"], r["lost"]) for r in encodings.garbled(df).collect()) == [(1, 1), (3, 1)]
    assert encodings.garbled(df.filter("doc_id > 9")).count() == 0
