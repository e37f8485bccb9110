"""Finding and repairing text decoded with another encoding than its own.

Each word with characters beyond ASCII has a latent encoding chain: clean, or
one of a fixed list of wrong decodings. Expectation-maximisation estimates, by
source and field, how common each chain is, and from the expected clean words
a model of words and of characters in their surroundings. Weak evidence of one
record is so pooled with that of all others of its source; the posterior marks
records and picks the inverse that restores a word.

All counts are distributed. The only tables sent to the driver are counts by
(character, surroundings, 25 kinds) and by chain, bounded by the alphabet and
not by the data.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_schema, cut, keep

# Fixed values: (true encoding, encoding it was read with), applied in turn.
CHAINS: dict[str, tuple[tuple[str, str], ...]] = {
    "utf8-cp1252": (("utf-8", "cp1252"),),
    "utf8-latin1": (("utf-8", "latin-1"),),
    "utf8-mac": (("utf-8", "mac_roman"),),
    "utf8-cp437": (("utf-8", "cp437"),),
    "utf8-cp850": (("utf-8", "cp850"),),
    "utf8-cp1250": (("utf-8", "cp1250"),),
    "utf8-cp1251": (("utf-8", "cp1251"),),
    "utf8-cp1253": (("utf-8", "cp1253"),),
    "utf8-cp1254": (("utf-8", "cp1254"),),
    "utf8-latin9": (("utf-8", "iso8859-15"),),
    "utf8-cp1252-twice": (("utf-8", "cp1252"), ("utf-8", "cp1252")),
    "utf8-latin1-twice": (("utf-8", "latin-1"), ("utf-8", "latin-1")),
    "utf8-mixed-twice": (("utf-8", "latin-1"), ("utf-8", "cp1252")),
    "cp1252-latin1": (("cp1252", "latin-1"),),
    "cp1252-cp1250": (("cp1252", "cp1250"),),
    "cp1252-cp1251": (("cp1252", "cp1251"),),
    "cp1252-koi8": (("cp1252", "koi8-r"),),
    "cp1252-cp1253": (("cp1252", "cp1253"),),
    "cp1252-greek": (("cp1252", "iso8859-7"),),
    "cp1252-cp437": (("cp1252", "cp437"),),
    "cp1252-cp850": (("cp1252", "cp850"),),
    "cp1252-mac": (("cp1252", "mac_roman"),),
    "mac-cp1252": (("mac_roman", "cp1252"),),
    "cp850-cp1252": (("cp850", "cp1252"),),
    "cp437-cp1252": (("cp437", "cp1252"),),
    "cp1250-cp1252": (("cp1250", "cp1252"),),
    "cp1251-cp1252": (("cp1251", "cp1252"),),
    "cp1253-cp1252": (("cp1253", "cp1252"),),
    "greek-latin1": (("iso8859-7", "latin-1"),),
}
CLEAN, LOST = "clean", "lost"
#: Up to so many sources the shares of (source x chain) are broadcast.
FEW_SOURCES = 10_000
SIGNS = "“”‘’‚„–—…«»‹›°±×÷µ§£€¥¢¼½¾¿¡²³¹·©®™ºª†‡•‰"
TOKEN = r"[^ \t\n\r\x{000B}\f]+"
_WORD = re.compile(r"[^\W\d_]+")
_CONTROL = re.compile("[\x80-\x9f]")


def _tables() -> tuple[dict[str, dict[str, int]], dict[str, list[str]]]:
    enc, dec = {}, {}
    for name in {e for steps in CHAINS.values() for pair in steps for e in pair} - {"utf-8"}:
        chars = []
        for b in range(256):
            try:
                chars.append(bytes([b]).decode(name))
            except UnicodeDecodeError:
                chars.append(chr(b))
        dec[name] = chars
        enc[name] = {c: b for b, c in reversed(list(enumerate(chars)))}
    return enc, dec


_ENC, _DEC = _tables()


def invert(token: str, chain: str) -> str | None:
    """What ``token`` was before the chain of wrong decodings; None if it can't be its result."""
    for true, read in reversed(CHAINS[chain]):
        table = _ENC[read]
        try:
            raw = bytes(table[c] for c in token)
        except KeyError:
            return None
        if true == "utf-8":
            try:
                token = raw.decode("utf-8")
            except UnicodeDecodeError:
                token = raw.decode("utf-8", "replace")
                if len([c for c in token if ord(c) > 127]) <= token.count("�"):
                    return None
        else:
            token = "".join(_DEC[true][b] for b in raw)
    return token


def script(ch: str) -> str:
    if ch.isascii() or "À" <= ch <= "ɏ" or "Ḁ" <= ch <= "ỿ" or ch in "ªº":
        return "latin"
    if ch == "µ":
        return ""
    name = unicodedata.name(ch, "?")
    return name.split(" ", 1)[0].lower()


def odd(token: str) -> bool:
    """Signs of a wrong decoding inside one word: mixed scripts, a symbol or a
    control among letters, a capital after a small letter."""
    for i, c in enumerate(token):
        if c.isascii():
            continue
        kind = unicodedata.category(c)
        left, right = token[i - 1 : i] if i else "", token[i + 1 : i + 2]
        near = (left.isalpha(), right.isalpha())
        if kind in ("Cc", "Co", "Cn") or c == "�":
            return True
        if kind[0] in "SMN" and any(near) and not (c in "°µ²³ªº€£×±" and not all(near)):
            return True
        if kind[0] == "P" and c not in "’‘–—·" and all(near):
            return True
        if kind == "Lu" and left.islower():
            return True
        if kind[0] == "S" and unicodedata.name(c, "").startswith(("BOX", "BLOCK")):
            return True
    return any(len({script(c) for c in w} - {""}) > 1 for w in _WORD.findall(token))


def plausible(token: str) -> bool:
    """Whether a restored word is made of letters and usual signs only."""
    for c in token:
        if c.isascii():
            if not c.isprintable():
                return False
        elif not (c.isalpha() or c in SIGNS or c in "�\u00a0"):
            return False
    return not odd(token.replace("�", "e"))


def candidates(token: str) -> list[tuple[str, str, float, float]]:
    """(chain, restored, first responsibility, log evidence) of one word, clean included.

    The evidence is what the characters alone say: clean words hardly ever are
    valid multi-byte sequences of a plausible word, nor look odd.
    """
    if "�" in token:
        return [(CLEAN, token, 0.0, -30.0), (LOST, "", 1.0, 0.0)]
    strange, seen, found = odd(token), set(), []
    for chain, steps in CHAINS.items():
        back = invert(token, chain)
        if back is None or back == token or back in seen or not plausible(back):
            continue
        seen.add(back)
        utf = steps[0][0] == "utf-8"
        damaged = back.count("�")
        found.append((chain, back, (3.0 if "twice" in chain else 1.0) if utf and not damaged else 0.5 if strange else 0.02, utf, damaged))
    if not found and _CONTROL.search(token):
        # Controls of this range are no text; a word garbled in part has no inverse as a whole.
        return [(CLEAN, token, 0.0, -30.0), (LOST, "", 1.0, 0.0)]
    strict = any(f[3] and not f[4] for f in found)
    clean, log_clean = (0.01, -12.0) if strict else (0.05, -8.0) if strange and found else (1.0, 0.0)
    total = clean + sum(f[2] for f in found)
    return [(CLEAN, token, clean / total, log_clean)] + [(c, r, w / total, -3.0 * bad) for c, r, w, _, bad in found]


def _kind(c: str) -> int:
    return 0 if not c else 1 if c.islower() else 2 if c.isupper() else 3 if c.isalnum() else 4


def surroundings(token: str) -> list[tuple[str, int]]:
    """(character, kind of its neighbours) of every character beyond ASCII."""
    return [(c, 5 * _kind(token[i - 1] if i else "") + _kind(token[i + 1] if i + 1 < len(token) else "")) for i, c in enumerate(token) if ord(c) > 127]


def words(df: DataFrame, key: str, field: str, source: str) -> DataFrame:
    """(key, source, word) for each distinct word with a character beyond ASCII; outer ASCII punctuation is cut off."""
    bare = F.filter(F.array_distinct(F.transform(F.regexp_extract_all(F.col(field), F.lit(f"({TOKEN})"), 1), lambda w: F.regexp_replace(w, r"^\p{Punct}+|\p{Punct}+$", ""))), lambda w: w.rlike(r"[^\x00-\x7F]"))
    return df.select(key, F.coalesce(F.col(source), F.lit("")).alias("source"), F.explode(bare).alias("word"))


_OUT = T.StructType([T.StructField("source", T.StringType()), T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("chain", T.StringType()), T.StructField("back", T.StringType()), T.StructField("resp", T.DoubleType()), T.StructField("ev", T.DoubleType())])


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, known = arrow_schema(_OUT), {}
    for b in batches:
        rows = []
        for s, w, n in zip(*(b.column(i).to_pylist() for i in range(3))):
            got = known.get(w)
            if got is None:
                if len(known) > 100_000:
                    known.clear()
                got = known[w] = candidates(w)
            rows += [{"source": s, "word": w, "n": n, "chain": c, "back": r, "resp": p, "ev": e} for c, r, p, e in got]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _char_model(resp: DataFrame) -> dict[tuple[str, int], float]:
    """Expected counts of (character, surroundings) in clean words: at most the alphabet times 25 rows."""
    out = T.StructType([T.StructField("c", T.StringType()), T.StructField("k", T.IntegerType()), T.StructField("n", T.DoubleType())])
    schema = arrow_schema(out)

    def count(batches):
        for b in batches:
            acc: dict[tuple[str, int], float] = {}
            for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for s in surroundings(w):
                    acc[s] = acc.get(s, 0.0) + n
            yield pa.RecordBatch.from_pylist([{"c": c, "k": k, "n": n} for (c, k), n in acc.items()], schema=schema)

    weighted = resp.filter("back <> '' and n * resp > 0.001").select("back", (F.col("n") * F.col("resp")).alias("m"))
    return {(r["c"], r["k"]): r["n"] for r in weighted.mapInArrow(count, out).groupBy("c", "k").agg(F.sum("n").alias("n")).collect()}


def _char_scores(resp: DataFrame, model: dict[tuple[str, int], float]) -> DataFrame:
    total = sum(model.values()) + 1.0
    table = {k: math.log((v + 0.05) / (total + 0.05 * 20_000)) for k, v in model.items()}
    low = math.log(0.05 / (total + 0.05 * 20_000))

    @F.pandas_udf("double")
    def score(back):
        codes, distinct = back.factorize()
        each = np.array([sum(table.get(s, low) if s[0] != "�" else -14.0 for s in surroundings(w)) for w in distinct])
        return pd.Series(each[codes] if len(each) else [], dtype="float64")

    return resp.withColumn("char_lp", score("back"))


def fit(found_words: DataFrame, settled: float = 1e-5) -> DataFrame:
    """Posterior of every (source, word, chain): ``source, word, n, chain, back, resp``.

    Words are kept by distinct document, sources are strata; a source without
    documents has no rows. Rounds go on until less than the share ``settled``
    of the words moves between chains.
    """
    counts = found_words.groupBy("source", "word").agg(F.count("*").alias("n"))
    resp = cut(counts.repartition("word").mapInArrow(_expand, _OUT))
    # The clean chain of a source holds most of its words: a table of few sources is broadcast, else AQE splits that key.
    few = resp.select("source").distinct().count() <= FEW_SOURCES
    before = _state(resp)
    while True:
        resp = cut(_step(resp, F.broadcast if few else lambda t: t))
        now = _state(resp)
        if sum(abs(now[c] - before.get(c, 0.0)) for c in now) <= settled * max(sum(now.values()), 1.0):
            return resp
        before = now


def _state(resp: DataFrame) -> dict[str, float]:
    """Expected words of each chain."""
    return {r["chain"]: r["m"] or 0.0 for r in resp.groupBy("chain").agg(F.sum(F.col("n") * F.col("resp")).alias("m")).collect()}


def _step(resp: DataFrame, small: Callable[[DataFrame], DataFrame]) -> DataFrame:
    scored = _char_scores(resp, _char_model(resp))
    mass = (F.col("n") * F.col("resp")).alias("m")
    clean = resp.filter("back <> ''").select(F.col("back").alias("b"), mass).groupBy("b").agg(F.sum("m").alias("nc"))
    total = resp.agg(F.sum("n")).first()[0] or 1
    # A source's shares shrink towards those of all sources; both are tables of (source x chain).
    share = resp.groupBy("source", "chain").agg(F.sum(F.col("n") * F.col("resp")).alias("sc"))
    size = resp.select("source", "word", "n").distinct().groupBy("source").agg(F.sum("n").alias("sn"))
    everywhere = {r["chain"]: (r["m"] or 0.0) / total for r in resp.groupBy("chain").agg(F.sum(F.col("n") * F.col("resp")).alias("m")).collect()}
    mean = F.create_map(*[x for c, p in everywhere.items() for x in (F.lit(c), F.lit(float(p)))]) if everywhere else F.create_map(F.lit(CLEAN), F.lit(1.0))
    joined = scored.join(clean, scored["back"] == clean["b"], "left").drop("b").join(small(share), ["source", "chain"], "left").join(small(size), "source", "left")
    prior = (F.coalesce("sc", F.lit(0.0)) + 20.0 * F.coalesce(mean[F.col("chain")], F.lit(0.0)) + 0.01) / (F.col("sn") + 20.0)
    # A clean word is not evidence for itself: its own source's count is left out.
    own = F.when(F.col("chain") == CLEAN, F.col("n") * F.col("resp")).otherwise(F.lit(0.0))
    word = F.log((F.greatest(F.coalesce("nc", F.lit(0.0)) - own, F.lit(0.0)) + 5.0 * F.exp("char_lp")) / F.lit(float(total)))
    lp = F.when(F.col("chain") == LOST, F.lit(0.0)).otherwise(F.log(prior) + word) + F.col("ev")
    norm = joined.withColumn("lp", lp).groupBy("source", "word").agg(F.max("lp").alias("mx"), F.collect_list(F.struct("chain", "back", "n", "ev", "lp")).alias("cs"))  # one word's chains: at most len(CHAINS) + 1
    z = F.aggregate("cs", F.lit(0.0), lambda a, c: a + F.exp(c["lp"] - F.col("mx")))
    return norm.withColumn("z", z).select("source", "word", "mx", "z", F.explode("cs").alias("c")).select("source", "word", "c.n", "c.chain", "c.back", (F.exp(F.col("c.lp") - F.col("mx")) / F.col("z")).alias("resp"), "c.ev")


def verdicts(resp: DataFrame) -> DataFrame:
    """(source, word, chain, back) of words more likely garbled than clean."""
    best = resp.groupBy("source", "word").agg(F.max(F.when(F.col("chain") == CLEAN, F.col("resp"))).alias("clean"), F.max_by(F.struct("chain", "back"), F.when(F.col("chain") != CLEAN, F.col("resp"))).alias("best"))
    return best.filter("clean < 0.5").select("source", "word", "best.chain", "best.back")


def garbled(df: DataFrame, key: str = "doc_id", field: str = "text", source: str = "source") -> DataFrame:
    """``key, chain, words, lost``: each affected record with its most frequent
    chain, the map from garbled to restored word, and how many words are past
    restoring. Null and empty texts are never affected; copies are judged
    alike; a null source is a stratum of its own. An empty table gives no rows."""
    found = keep(words(df, key, field, source))  # texts are scanned once
    bad = verdicts(fit(found))
    hits = found.join(bad, ["source", "word"])
    return hits.groupBy(key).agg(
        F.mode("chain").alias("chain"),
        F.map_from_entries(F.collect_set(F.when((F.col("chain") != LOST) & ~F.col("back").contains("�"), F.struct("word", "back")))).alias("words"),
        F.count_if((F.col("chain") == LOST) | F.col("back").contains("�")).cast("int").alias("lost"),
    )


def repair(df: DataFrame, key: str = "doc_id", field: str = "text", source: str = "source") -> DataFrame:
    """``key, chain, lost, restored``: affected records with every restorable word put right."""
    bad = garbled(df, key, field, source)

    @F.pandas_udf("string")
    def put(text, pairs):
        def one(t, m):
            m = dict(m)
            return re.sub(r"[^ \t\n\r\x0b\f]+", lambda x: _swap(x.group(), m), t)

        return text.combine(pairs, one)

    return bad.join(df.select(key, F.col(field).alias("_text")), key).select(key, "chain", "lost", put("_text", "words").alias("restored"))


_EDGE = re.compile(r"^[!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]+$")


def _swap(token: str, pairs: dict[str, str]) -> str:
    core = _EDGE.sub("", token)
    return token.replace(core, pairs[core], 1) if core in pairs else token
