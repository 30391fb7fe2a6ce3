"""Toxicity scoring with a factorization machine over hashed terms (operator 9).

Terms are the lower-cased words of a text and the first 4 and 5 characters of
longer words, so inflected forms share a term. The machine scores
``w0 + sum w_i + sum_{i<j} <v_i, v_j>`` over a text's distinct terms: the pair
part learns interactions, such as an insult together with a group, that no
sum of single weights holds. It is fitted by mini-batch AdaGrad in one task on
a bounded sample of labelled rows (``max_rows``); scoring runs on every row
with the weights, whose size is fixed by ``dims`` and ``rank``.

Defined cases: null and empty texts have no term and score by the intercept;
rows with a null label are not learned from; when nothing can be learned every
score is 0.0; a null ``doc_id`` is carried through; repeated rows are scored one
by one; texts of any length are read whole; labelled rows that tie in the
sample's hash are ordered by their terms; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import drawn_by, pieces, ragged, schema_of, texts

DIMS = 1 << 18
RANK = 8
EPOCHS = 8
RATE = 0.3
#: Terms of fewer labelled rows are not learned.
MIN_ROWS = 3
LEAST_STEP = 0.003
#: Terms nearer than this to equal shares under both labels have no weight of
#: their own; they take part in pairs like all others.
LEAST_Z = 0.7
#: The fit without pairs whose residuals are looked through for interactions;
#: buckets of partners, and dealings into them.
LINEAR_EPOCHS = 3
BUCKETS = 64
HASHINGS = 3
#: Expected number of labelled rows that the machine is fitted on.
MAX_TRAINING_ROWS = 20_000

_TERM = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    w0: float
    w: np.ndarray   # dims
    v: np.ndarray   # dims x rank


def terms(text: str, dims: int = DIMS) -> np.ndarray:
    """Sorted distinct hashed terms of a whole text."""
    words = set(_TERM.findall(text.lower()))
    found = {"w" + x for x in words}
    for k in (4, 5):
        found.update(f"{k}{x[:k]}" for x in words if len(x) > k)
    h = xxhash.xxh32_intdigest
    return np.array(sorted({h(x) & (dims - 1) for x in found}), np.int32)


def _sums(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Row sums of ragged groups; empty groups sum to 0."""
    out = np.zeros((len(lengths), *x.shape[1:]), np.float64)
    full = np.flatnonzero(lengths)
    if full.size:
        first = np.r_[0, np.cumsum(lengths[full])[:-1]]
        out[full] = np.add.reduceat(x, first, axis=0)
    return out


def logits(m: Model, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    vx = m.v[flat]
    s = _sums(vx, lengths)
    return m.w0 + _sums(m.w[flat], lengths) + 0.5 * (
        (s * s).sum(1) - _sums((vx * vx).sum(1), lengths))


def confidence(rows: list[np.ndarray], y: np.ndarray, dims: int) -> np.ndarray:
    """How far each term's smoothed log-odds ratio between the labels is from
    0, in standard errors; 0 for terms of fewer than ``MIN_ROWS`` rows."""
    def count(of):
        found = [rows[i] for i in np.flatnonzero(of)]
        return np.bincount(np.concatenate(found), minlength=dims) if found else np.zeros(dims)
    pos, neg = count(y > 0), count(y <= 0)
    n_pos, n_neg = float((y > 0).sum()), float((y <= 0).sum())
    a, b = pos + 0.5, neg + 0.5
    odds = np.log(a / (n_pos - pos + 0.5)) - np.log(b / (n_neg - neg + 0.5))
    z = np.abs(odds) / np.sqrt(1 / a + 1 / b)
    return np.where(pos + neg >= MIN_ROWS, z, 0.0)


def pair_confidence(rows: list[np.ndarray], r: np.ndarray, known: np.ndarray,
                    buckets: int = BUCKETS, hashings: int = HASHINGS, seed: int = 7) -> np.ndarray:
    """How far each known term's strongest interaction is from 0, in standard
    errors beyond chance. An interaction of two terms shows in the sum of the
    residuals ``r`` of the rows that hold both. The partners are not looked at
    one by one: with random signs they are added up in ``buckets``, and a term is
    held against every bucket, so time and memory are linear in the terms of
    the rows. What only one dealing of the partners shows is chance; the least
    over ``hashings`` of them counts."""
    dims, ids = len(known), np.flatnonzero(known)
    local = np.full(dims, -1, np.int64)
    local[ids] = np.arange(len(ids))
    found = [local[x[known[x]]] for x in rows]
    lengths = np.array([len(x) for x in found], np.int64)
    out = np.zeros(dims)
    if not lengths.sum():
        return out
    flat, row = np.concatenate(found), np.repeat(np.arange(len(rows)), lengths)
    k, rng = len(ids), np.random.default_rng(seed)
    order = np.argsort(flat, kind="stable")
    by_term, holders = flat[order], row[order]
    n = np.bincount(flat, minlength=k)
    # below this many rows no sum is as far from 0: |z| <= sqrt(rows)
    chance = math.sqrt(2 * math.log(max(2.0, buckets * max(2.0, k) ** (1 / hashings))))
    start = np.r_[0, np.cumsum(n)]
    terms_ = np.flatnonzero(n > chance ** 2)
    best = np.full(k, np.inf)
    sum_r, sum_r2 = (np.bincount(by_term, x[holders], k) for x in (r, r * r))
    for _ in range(hashings):
        bucket, sign = rng.integers(0, buckets, k), rng.choice([-1.0, 1.0], k)
        c = np.bincount(row * buckets + bucket[flat], sign[flat], len(rows) * buckets)
        c = c.reshape(-1, buckets).astype(np.float32)
        rc = (c * r[:, None]).astype(np.float32)
        done = 0
        while done < len(terms_):
            # whole terms with about a hundred thousand rows between them
            upto = max(done + 1, int(np.searchsorted(np.cumsum(n[terms_[done:]]), 100_000)) + done)
            t = terms_[done:upto]
            at = ragged(start[t], n[t])
            first = np.cumsum(n[t]) - n[t]
            x, h = rc[holders[at]], holders[at]
            num = np.add.reduceat(x, first, axis=0).astype(np.float64)
            x *= x
            den = np.add.reduceat(x, first, axis=0).astype(np.float64)
            own, s = (np.arange(len(t)), bucket[t]), sign[t]
            # the term itself is no partner
            cross = np.add.reduceat((r[h] * r[h]) * c[h, np.repeat(bucket[t], n[t])], first)
            num[own] -= s * sum_r[t]
            den[own] += sum_r2[t] - 2 * s * cross
            z = np.abs(num) / np.sqrt(np.maximum(den, 1e-12))
            best[t] = np.minimum(best[t], z.max(1))
            done = upto
    out[ids] = np.maximum(np.where(np.isfinite(best), best, 0.0) - chance, 0.0)
    return out


def train(rows: list[np.ndarray], y: np.ndarray, dims: int = DIMS, rank: int = RANK,
          epochs: int = EPOCHS, rate: float = RATE, l2: float = 1e-4, batch: int = 64,
          seed: int = 7) -> Model:
    """AdaGrad on the log-loss. The step of a term's own weight is scaled by the
    confidence that the labels differ in it (from ``LEAST_STEP`` up to 1 at four
    standard errors), so the few telling terms of a text are learned before its
    many chance ones. Its pair vector steps by that or by the confidence that
    the residuals of a fit without pairs hold an interaction of it, since equal
    shares say nothing about pairs (exclusive or). Linear in the rows' terms.
    The result depends on the order of the rows, so callers sort them."""
    z = confidence(rows, y, dims)
    known = np.bincount(np.concatenate([*rows, np.zeros(0, np.int32)]), minlength=dims) >= MIN_ROWS
    step = np.where(known & (z > LEAST_Z), np.clip((z / 4) ** 2, LEAST_STEP, 1.0), 0.0)
    # the known terms, numbered
    ids = np.flatnonzero(known)
    local = np.full(dims, -1, np.int64)
    local[ids] = np.arange(len(ids))
    found = [local[r[known[r]]] for r in rows]
    plain = _descend(found, y, step[ids], None, 0, LINEAR_EPOCHS, rate, l2, batch, seed)
    lengths = np.array([len(r) for r in found], np.int64)
    p = 1 / (1 + np.exp(-np.clip(plain.w0 + _sums(plain.w[np.concatenate(
        [*found, np.zeros(0, np.int64)])], lengths), -30, 30)))
    pair = pair_confidence(rows, y - p, known)
    step_v = np.maximum(step, np.clip((pair / 4) ** 2, LEAST_STEP, 1.0))
    m = _descend(found, y, step[ids], step_v[ids], rank, epochs, rate, l2, batch, seed)
    w, v = np.zeros(dims), np.zeros((dims, rank))
    w[ids], v[ids] = m.w, m.v
    return Model(m.w0, w, v)


def _descend(rows: list[np.ndarray], y: np.ndarray, step: np.ndarray, step_v: np.ndarray | None,
             rank: int, epochs: int, rate: float, l2: float, batch: int, seed: int) -> Model:
    """The epochs of :func:`train` over numbered terms; without pairs if ``rank``
    is 0."""
    rng, k = np.random.default_rng(seed), len(step)
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    w0, w = float(np.log(share / (1 - share))), np.zeros(k)
    v = rng.normal(0, 0.01, (k, rank))
    gw, gv, g0 = np.full(k, 1e-6), np.full((k, rank), 1e-6), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for s in range(0, len(order), batch):
            pick = order[s:s + batch]
            lengths = np.array([len(rows[i]) for i in pick])
            flat = np.concatenate([rows[i] for i in pick])
            linear = w0 + _sums(w[flat], lengths)
            if rank:
                vx = v[flat]
                sums = _sums(vx, lengths)
                linear += 0.5 * ((sums * sums).sum(1) - _sums((vx * vx).sum(1), lengths))
            p = 1 / (1 + np.exp(-np.clip(linear, -30, 30)))
            e = (p - y[pick]) / len(pick)
            g = float(e.sum())
            g0 += g * g
            w0 -= rate * g / np.sqrt(g0)
            if not flat.size:
                continue
            each = np.repeat(e, lengths)
            used = np.flatnonzero(np.bincount(flat, minlength=k))
            grad = np.bincount(flat, each, k)[used] + l2 * w[used]
            gw[used] += grad ** 2
            w[used] -= rate * step[used] * grad / np.sqrt(gw[used])
            if not rank:
                continue
            pull = np.repeat(e[:, None] * sums, lengths, axis=0) - each[:, None] * vx
            grads = l2 * v[used]
            for j in range(rank):
                grads[:, j] += np.bincount(flat, pull[:, j], k)[used]
            gv[used] += grads ** 2
            v[used] -= 0.1 * rate * step_v[used, None] * grads / np.sqrt(gv[used])
    return Model(w0, w, v)


def fit(labelled: DataFrame, label_col: str = "toxic", text_col: str = "text",
        id_col: str = "doc_id", dims: int = DIMS, rank: int = RANK, epochs: int = EPOCHS,
        max_rows: int = MAX_TRAINING_ROWS) -> Model | None:
    """Fits on the rows with a label and a text; beyond ``max_rows`` on a
    sample of about so many, drawn by a hash of the id. Terms are found where
    the rows are; one task then holds the sample's hashed terms."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"),
                           F.col(label_col).cast("int").alias("y"),
                           F.col(text_col).alias("text")).filter(
        "y IS NOT NULL AND text IS NOT NULL")
    total = rows.count()
    if total == 0:
        return None
    rows = rows.withColumn("draw", drawn_by(F.col("id")))
    if total > max_rows:
        rows = rows.filter(F.col("draw") < max_rows / total * 2 ** 32)

    def featurise(batches) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [b.column("draw"), b.column("y"),
                 pa.array([terms(t, dims).tobytes() for t in texts(b)], pa.binary())],
                schema=schema_of("draw double,y int,terms binary"))

    def learn(t):
        t = t.sort_by([("draw", "ascending"), ("terms", "ascending")])
        found = [np.frombuffer(x, np.int32) for x in t.column("terms").to_pylist()]
        m = train(found, t.column("y").to_numpy().astype(float), dims, rank, epochs)
        return pa.table({"w0": pa.array([m.w0]),
                         "w": pa.array([m.w.astype(np.float32).tobytes()], pa.binary()),
                         "v": pa.array([m.v.astype(np.float32).tobytes()], pa.binary())})

    fitted = (rows.mapInArrow(featurise, "draw double,y int,terms binary")
              .groupBy(F.lit(0).alias("one")).applyInArrow(learn, "w0 double,w binary,v binary"))
    got = fitted.first()
    if got is None:
        return None
    return Model(got["w0"], np.frombuffer(got["w"], np.float32),
                 np.frombuffer(got["v"], np.float32).reshape(dims, rank))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score``, the probability of the label 1."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return d.select("doc_id", F.lit(0.0).alias("score"))
    # plain values: executors need not have the class
    sent = d.sparkSession.sparkContext.broadcast((model.w0, model.w, model.v))

    def run(batches) -> Iterator[pa.RecordBatch]:
        m = Model(*sent.value)
        for b in pieces(batches, "text", 4 << 20):
            found = [terms(t, len(m.w)) for t in texts(b)]
            lengths = np.array([len(x) for x in found])
            z = logits(m, np.concatenate(found), lengths)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                schema=schema_of("doc_id long,score double"))

    return d.mapInArrow(run, "doc_id long,score double")
