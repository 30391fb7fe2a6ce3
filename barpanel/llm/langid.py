"""Language identification (operator 5).

Multinomial naive Bayes over hashed character n-grams. Training counts are one
distributed aggregation over (label, hashed n-gram); the log-probability
matrix has ``dims x labels`` entries, a bound that ``fit`` keeps by hashing into
fewer cells where there are very many labels, so it may be sent to every task. Scoring adds the matrix's rows of all n-grams of a text,
for whole batches of texts at once.

Defined cases: a text that is null or holds no letter is ``und`` with score
0.0, and so is every text when nothing could be learned; a null ``doc_id`` is
carried through; ties between labels go to the first in alphabetical order;
repeated rows are scored one by one; texts of any length are read whole; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import pieces, schema_of, texts

ORDERS = (1, 2, 3)
DIMS = 1 << 16
#: Most entries of the matrix that is sent to the tasks (32-bit floats).
MAX_ENTRIES = 1 << 24
#: Fewest cells that n-grams are hashed into, whatever the number of labels.
LEAST_DIMS = 1 << 8
#: Expected number of labelled documents that the counts are taken from.
MAX_TRAINING_ROWS = 100_000
SMOOTHING = 0.5


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    prior: np.ndarray      # labels
    logp: np.ndarray       # dims x labels, float32


def _codes(ts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case code points of all texts and the text each belongs to. Signs
    and digits become one space; texts are parted by zeros."""
    joined = "\0\0".join(t.lower().replace("\0", " ") for t in ts)
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = (c >= 128) | ((c >= 97) & (c <= 122)) | (c == 0)
    c = np.where(letter, c, np.uint32(32))
    at = np.cumsum(c == 0, dtype=np.int64) // 2
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    return c[keep], at[keep]


def ngrams(c: np.ndarray, at: np.ndarray, order: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams within the texts, and the text of each."""
    n = len(c) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.full(n, order, np.uint32)
    inside = np.ones(n, bool)
    for k in range(order):
        x = c[k:k + n]
        h = (h ^ x) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        inside &= x != 0
    if order == 1:
        inside &= c[:n] != 32
    return (h[inside] & np.uint32(dims - 1)).astype(np.int64), at[:n][inside]


def fit(labelled: DataFrame, label_col: str = "lang", text_col: str = "text",
        id_col: str = "doc_id", dims: int = DIMS, orders: tuple = ORDERS,
        max_rows: int = MAX_TRAINING_ROWS) -> Model | None:
    """Learns from the labelled rows; null labels and texts are left out.
    Beyond ``max_rows`` rows, a sample of about so many, drawn by a hash of the
    id, is counted. None if there is nothing to learn."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"),
                           F.col(label_col).alias("label"), F.col(text_col).alias("text")).filter(
        "label IS NOT NULL AND text IS NOT NULL")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
             .limit(MAX_ENTRIES // LEAST_DIMS + 1).collect()}
    if not sizes:
        return None
    while len(sizes) * dims > MAX_ENTRIES and dims > LEAST_DIMS:
        dims //= 2
    if len(sizes) * dims > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES // LEAST_DIMS} labels: no column of languages")
    total = sum(sizes.values())
    if total > max_rows:
        draw = F.conv(F.substring(F.md5(F.coalesce("id", F.lit(""))), 1, 8), 16, 10).cast("double")
        rows = rows.filter(draw < max_rows / total * 2 ** 32)
    names = sorted(sizes)

    def count(batches) -> Iterator[pa.RecordBatch]:
        out = schema_of("label int,i int,n long")
        number = {x: k for k, x in enumerate(names)}
        sums = np.zeros((len(names), dims), np.int64)
        for b in pieces(batches, "text"):
            c, at = _codes(texts(b))
            of = np.array([number[x] for x in b.column("label").to_pylist()], np.int64)
            for order in orders:
                h, t = ngrams(c, at, order, dims)
                sums += np.bincount(of[t] * dims + h, minlength=sums.size).reshape(sums.shape)
        k, i = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(i, pa.int32()),
                                          pa.array(sums[k, i], pa.int64())], schema=out)

    counted = (rows.mapInArrow(count, "label int,i int,n bigint")
               .groupBy("label", "i").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros((dims, len(names)))  # at most dims x labels rows came back
    counts[counted["i"].to_numpy(), counted["label"].to_numpy()] = counted["n"].to_numpy()
    logp = np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * dims))
    prior = np.log(np.array([sizes[x] for x in names]) / total)
    return Model(tuple(names), prior, logp.astype(np.float32))


def scores(model: Model, ts: list[str], orders: tuple = ORDERS) -> np.ndarray:
    """Posterior of each label (columns) for each text (rows)."""
    s = np.tile(model.prior, (len(ts), 1))
    c, at = _codes(ts)
    dims, n_labels = model.logp.shape
    for order in orders:
        h, t = ngrams(c, at, order, dims)
        if not h.size:
            continue
        first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        for k in range(n_labels):
            s[t[first], k] += np.add.reduceat(model.logp[:, k][h], first, dtype=np.float64)
    s -= s.max(1, keepdims=True)
    p = np.exp(s)
    return p / p.sum(1, keepdims=True)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (posterior of that label)."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return d.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    # plain values: executors need not have the class
    sent = d.sparkSession.sparkContext.broadcast((model.labels, model.prior, model.logp))

    def run(batches) -> Iterator[pa.RecordBatch]:
        out = schema_of("doc_id long,lang_pred string,score double")
        known = Model(*sent.value)
        for b in pieces(batches, "text", 4 << 20):
            ts = texts(b)
            p = scores(known, ts)
            best = p.argmax(1)
            has = [any(map(str.isalpha, t)) for t in ts]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"),
                pa.array([known.labels[k] if ok else "und" for k, ok in zip(best, has)],
                         pa.string()),
                pa.array([float(p[i, k]) if ok else 0.0 for i, (k, ok)
                          in enumerate(zip(best, has))], pa.float64())], schema=out)

    return d.mapInArrow(run, "doc_id long,lang_pred string,score double")


def fold(id_col: str = "doc_id", of: int = 3) -> Column:
    """crc32 of the id as text, modulo ``of``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % of
