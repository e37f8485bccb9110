"""Mixing sources to target shares of the total tokens.

A classifier learned from labelled rows gives documents without a source their
domain posteriors; labelled documents belong to their own source. Projected
gradient descent then fits, by least squares, one non-negative rate per
document, at most its source's repeat limit, so that the expected tokens of
each domain match its target. Rates are a function of a document's size,
membership, limit and the short history of domain errors, so an iteration is
one pass that returns one number per domain; rounding to whole copies is
settled by bisection of one threshold per domain in the same way.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import arrow_schema, cut
from . import tokens as tokenizer

#: Labelled rows the classifier is fitted on, at most about so many.
FIT_ROWS = 20_000
BUCKETS = 1 << 12
ROUNDS = 25
BISECTIONS = 18
_WORD = re.compile(r"[^\W_]+|[^\w\s]")


def _features(text: str) -> np.ndarray:
    words = _WORD.findall((text or "").lower())
    return np.bincount([zlib.crc32(w.encode()) % BUCKETS for w in words], minlength=BUCKETS) if words else np.zeros(BUCKETS, dtype=np.int64)


def fit_domains(docs: DataFrame, domains: list[str], text: str = "text", source: str = "source", key: str = "doc_id", rows: int = FIT_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Log word probabilities and log priors by domain, the last being any other source."""
    labelled = docs.filter(F.col(source).isNotNull())
    n = labelled.count()
    share = min(1.0, rows / n) if n else 1.0
    sample = labelled.filter(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    out = T.StructType([T.StructField("d", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType())])
    schema, place = arrow_schema(out), {d: i for i, d in enumerate(domains)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(place) + 1, BUCKETS + 1), dtype=np.int64)
        for b in batches:
            for t, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                d = place.get(s, len(place))
                total[d, :BUCKETS] += np.minimum(_features(t), 5)
                total[d, BUCKETS] += 1
        d, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(d.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[d, k])], schema=schema)

    table = np.zeros((len(domains) + 1, BUCKETS + 1))
    for r in sample.select(text, source).mapInArrow(count, out).groupBy("d", "b").agg(F.sum("n").alias("n")).collect():  # at most (domains + 1) x buckets
        table[r["d"], r["b"]] = r["n"]
    words = table[:, :BUCKETS] + 0.5
    # A domain without a labelled row is nobody's.
    prior = table[:, BUCKETS] if table[:, BUCKETS].any() else np.eye(len(table))[-1]
    with np.errstate(divide="ignore"):
        return np.log(words / words.sum(axis=1, keepdims=True)), np.log(prior / prior.sum())


def posterior(text: str, log_words: np.ndarray, log_prior: np.ndarray) -> np.ndarray:
    """Domain posteriors of one text; evidence grows with the root of its length, as words repeat."""
    x = np.minimum(_features(text), 5)
    n = x.sum()
    lp = log_prior + (log_words @ x) / math.sqrt(n) if n else log_prior
    p = np.exp(lp - lp.max())
    return p / p.sum()


def memberships(docs: DataFrame, domains: list[str], limits: list[float], log_words: np.ndarray, log_prior: np.ndarray, key: str = "doc_id", text: str = "text", source: str = "source", path: str = tokenizer.VOCABULARY) -> DataFrame:
    """``key, source, tokens, soft, limit``: size, domain posteriors (the last entry is any other source) and repeat limit."""
    out = T.StructType([docs.schema[key], T.StructField("source", T.StringType()), T.StructField("tokens", T.LongType()), T.StructField("soft", T.ArrayType(T.DoubleType())), T.StructField("limit", T.DoubleType())])
    schema, place, cap = arrow_schema(out), {d: i for i, d in enumerate(domains)}, [*limits, 0.0]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = None
        for b in batches:
            enc = enc or tokenizer.encoder(path)
            texts, sources = b.column(1).to_pylist(), b.column(2).to_pylist()
            soft = []
            for t, s in zip(texts, sources):
                soft.append(posterior(t, log_words, log_prior) if s is None else np.eye(len(cap))[place.get(s, len(place))])
            # A document of uncertain source keeps the least limit of the domains it may belong to.
            limit = [min((cap[i] for i in range(len(place)) if p[i] > 0.05), default=0.0) for p in soft]
            sizes = [len(enc.encode_ordinary(t)) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(schema[0].type), pa.array(sources, pa.string()), pa.array(sizes, pa.int64()), pa.array([p.tolist() for p in soft], schema[3].type), pa.array(limit, pa.float64())], schema=schema)

    return docs.select(key, text, source).mapInArrow(work, out)


def _rates(t: np.ndarray, m: np.ndarray, limit: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Rates after the given gradient steps, each projected onto [0, limit]."""
    r = np.minimum(1.0, limit)
    for s in steps:
        r = np.clip(r - t * (m @ s), 0.0, limit)
    return r


def _copies(r: np.ndarray, u: np.ndarray, m: np.ndarray, limit: np.ndarray, shift: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(r + u + m @ shift), 0, limit).astype(np.int64)


def _sums(mixed: DataFrame, k: int, of) -> np.ndarray:
    """Rows of one number per domain over all documents; ``of`` maps a batch's arrays to rows of document weights."""
    out = T.StructType([T.StructField("p", T.IntegerType()), T.StructField("k", T.IntegerType()), T.StructField("s", T.DoubleType())])
    schema = arrow_schema(out)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, k))
        for b in batches:
            t, m, limit, u = _arrays(b, k)
            for i, w in enumerate(of(t, m, limit, u)):
                total[i] += w @ m
        p, d = np.indices(total.shape).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(p.ravel()), pa.array(d.ravel()), pa.array(total.ravel())], schema=schema)

    got = np.zeros((2, k))
    for r in mixed.select("tokens", "soft", "limit", "u").mapInArrow(add, out).groupBy("p", "k").agg(F.sum("s").alias("s")).collect():  # 2 x domains
        got[r["p"], r["k"]] = r["s"]
    return got


def _arrays(b: pa.RecordBatch, k: int):
    soft = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k + 1)[:, :k] if b.num_rows else np.zeros((0, k))
    return b.column(0).to_numpy(zero_copy_only=False).astype(float), soft, b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False)


def mix(docs: DataFrame, weights: DataFrame, total_tokens: float | None = None, key: str = "doc_id", text: str = "text", source: str = "source", path: str = tokenizer.VOCABULARY) -> DataFrame:
    """``key, source, belongs, tokens, rate, copies`` of every document used;
    ``belongs`` maps the listed sources it may be of to their probabilities.

    Targets are shares of ``total_tokens``; without it, of the largest total
    at which every source that has documents reaches its share under its
    repeat limit. A source without documents gets nothing and its share is
    spread over the others in proportion. Null, negative or zero shares and
    limits use none of the source; documents of sources not listed are unused.
    Null and empty texts have size 0 and are never used. Repeated documents
    count each on its own. Empty inputs give no rows.
    """
    ws = weights.select("source", "target_share", "max_repeat").filter("source is not null").groupBy("source").agg(F.max("target_share").alias("s"), F.max("max_repeat").alias("c")).orderBy("source").collect()  # the table of targets
    domains, share, cap = [r["source"] for r in ws], np.array([max(r["s"] or 0.0, 0.0) for r in ws]), [float(max(r["c"] or 0, 0)) for r in ws]
    k = len(domains)
    docs = docs.select(key, text, source)
    out = T.StructType([docs.schema[key], T.StructField("source", T.StringType()), T.StructField("belongs", T.MapType(T.StringType(), T.DoubleType())), T.StructField("tokens", T.LongType()), T.StructField("rate", T.DoubleType()), T.StructField("copies", T.LongType())])
    if not k:
        return docs.sparkSession.createDataFrame([], out)
    model = fit_domains(docs, domains, text, source, key)
    u = F.pmod(F.xxhash64(F.lit("mix"), key), F.lit(1 << 30)) / float(1 << 30)
    mixed = cut(memberships(docs, domains, cap, *model, key=key, text=text, source=source, path=path).withColumn("u", u).filter("limit > 0 and tokens > 0"))

    room, own = _sums(mixed, k, lambda t, m, limit, u: (t * limit, t * limit * (m.max(axis=1) == 1.0)))
    # Only a source with documents of its own has a target.
    weight = np.where(own > 0.5, share, 0.0)
    weight = weight / weight.sum() if weight.sum() else weight
    reach = min((room[i] / weight[i] for i in range(k) if weight[i] > 0), default=0.0)
    goal = weight * (reach if total_tokens is None else total_tokens)
    steps: list[np.ndarray] = []
    for _ in range(ROUNDS):
        held = list(steps)

        def state(t, m, limit, u):
            r = _rates(t, m, limit, held)
            # Curvature over the documents a step can still move.
            free = ((r > 0) & (m @ over >= 0)) | ((r < limit) & (m @ over <= 0))
            return t * r, t * t * free

        over = np.zeros(k)
        total, _ = _sums(mixed, k, state)
        over = total - goal
        if np.abs(over).sum() <= 1e-4 * max(goal.sum(), 1.0):
            break
        _, steep = _sums(mixed, k, state)
        steps.append(over / np.maximum(steep, 1.0))
    low, high = np.full(k, -1.0), np.full(k, 1.0)
    counted = lambda shift: _sums(mixed, k, lambda t, m, limit, u: (t * _copies(_rates(t, m, limit, steps), u, m, limit, shift),))[0]
    for _ in range(BISECTIONS):
        mid = (low + high) / 2
        short = counted(mid) < goal
        low, high = np.where(short, mid, low), np.where(short, high, mid)
    # One document more or less: whichever comes closer.
    shift = np.where(np.abs(counted(low) - goal) <= np.abs(counted(high) - goal), low, high)
    schema = arrow_schema(out)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t, m, limit, uu = _arrays(pa.RecordBatch.from_arrays([b.column(i) for i in (2, 3, 4, 5)], names=list("tslu")), k)
            r = _rates(t, m, limit, steps)
            c = _copies(r, uu, m, limit, shift)
            keep = pa.array(c > 0)
            names = pa.array([[(domains[i], float(row[i])) for i in np.flatnonzero(row > 1e-6)] for row in m], schema[2].type)
            cols = [b.column(0).cast(schema[0].type), b.column(1).cast(pa.string()), names, b.column(2), pa.array(r), pa.array(c)]
            yield pa.RecordBatch.from_arrays([x.filter(keep) for x in cols], schema=schema)

    return mixed.select(key, "source", "tokens", "soft", "limit", "u").mapInArrow(settle, out)


def shares(mixture: DataFrame, weights: DataFrame) -> DataFrame:
    """``source, target_share, n_docs, n_copies, tokens, actual_share`` of every
    listed source, in expectation over what documents without a source may be of."""
    each = mixture.select("copies", "tokens", F.explode("belongs").alias("source", "p"))
    got = cut(each.groupBy("source").agg(F.round(F.sum("p"), 3).alias("n_docs"), F.round(F.sum(F.col("copies") * F.col("p")), 3).alias("n_copies"), F.round(F.sum(F.col("copies") * F.col("tokens") * F.col("p")), 3).alias("tokens")))
    total = float(got.agg(F.sum("tokens")).first()[0] or 1)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return weights.select("source", "target_share").join(got, "source", "left").select("source", "target_share", zero("n_docs"), zero("n_copies"), zero("tokens"), F.round(F.coalesce(F.col("tokens") / F.lit(total), F.lit(0.0)), 6).alias("actual_share"))
