"""Quality scoring with random-indexing word vectors and a small network
(operator 12).

*Tokens.* Words and runs of ASCII signs of a whole text, by a hash into ``dims``
buckets, and for each its *shape* (capitals, digits, signs, length, whether it
repeats the token before), which takes part as a token of its own.

*Random indexing.* Every bucket has a fixed sparse index vector of +1 and -1. A
token's vector is the sum of the index vectors of its neighbours up to two
places away, over all texts that are learned from: whole numbers, added up in
the tasks and merged in blocks of buckets, so the result does not depend on how
rows are dealt. Scaled to length 1 they are the word vectors, ``dims x size``
numbers, a bound that lets them travel to every task.

*Classifier.* The mean of a text's vectors and the logarithm of its length go
through a network of two layers (hidden tanh units, one logit), trained with Adam
in one task on a bounded sample of labelled rows (``max_rows``). A part of the
sample is left out of the training and sets the temperature that divides the
logits, by the least log-loss, so scores are probabilities. The word vectors
are learned from the texts of the same sample. Scoring reads every row.

Defined cases: null and empty texts have the zero vector and length 0 and are
scored; rows with a null label are not learned from; when nothing can be learned
every score is 0.0; texts of any length are read whole, their vectors added in
slices; rows that tie in the sample's hash are ordered by their vectors;
repeated rows are scored one by one; a null ``doc_id`` is carried through; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import drawn_by, pieces, schema_of, stored, texts

DIMS = 1 << 15
SIZE = 64
#: Entries of an index vector that are not 0, and places that a context reaches.
SPARSE = 4
REACH = 2
HIDDEN = 24
EPOCHS = 40
RATE = 0.01
#: Expected number of labelled rows that the classifier is fitted on, and the
#: share of them that sets the temperature.
MAX_TRAINING_ROWS = 20_000
CALIBRATION = 0.2
#: Buckets whose sums travel together.
BLOCK = 256
SEED = 11


@dataclass(frozen=True)
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray       # inputs x hidden
    b1: np.ndarray
    w2: np.ndarray       # hidden
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -35, 35)))


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray  # dims x size
    network: Network


# -- tokens -----------------------------------------------------------------------

def shape(token: str) -> str:
    """Class of a token's looks."""
    if not any(c.isalnum() for c in token):
        return f"sign {token[0]} {min(len(token), 3)}"
    if any(c.isdigit() for c in token):
        return "digits" if token.isdigit() else "mixed"
    kind = ("upper" if token.isupper() and len(token) > 1 else
            "title" if token[:1].isupper() else "lower" if token.islower() else "camel")
    return f"{kind} {min(len(token) // 4, 5)}"


def tokens(ts: list[str], dims: int = DIMS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, bucket of the shape and text of every token, in order."""
    parted = pc.replace_substring_regex(pa.array(ts, pa.large_string()),
                                        r"([!-/:-@\[-`{-~]+)", r" \1 ")
    split = pc.split_pattern_regex(parted, r"[\t-\r ]+")
    coded = pc.list_flatten(split).dictionary_encode()
    ids, of = coded.indices.to_numpy(), pc.list_parent_indices(split).to_numpy()
    words = coded.dictionary.to_pylist()
    h = xxhash.xxh32_intdigest
    bucket = np.array([h("w" + w) & (dims - 1) for w in words], np.int64)
    looks = np.array([h("s" + shape(w)) & (dims - 1) if w else -1 for w in words], np.int64)
    again = h("same") & (dims - 1)
    if not len(ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keep = looks[ids] >= 0
    ids, of = ids[keep], of[keep].astype(np.int64)
    repeats = np.r_[False, (ids[1:] == ids[:-1]) & (of[1:] == of[:-1])]
    return bucket[ids], np.where(repeats, again, looks[ids]), of


# -- random indexing ----------------------------------------------------------------

def index_vectors(dims: int = DIMS, size: int = SIZE, sparse: int = SPARSE) -> np.ndarray:
    """The fixed sparse ternary vectors."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((dims, size), np.int32)
    at = rng.random((dims, size)).argpartition(sparse, axis=1)[:, :sparse]
    out[np.arange(dims)[:, None], at] = rng.choice([-1, 1], (dims, sparse))
    return out


def add_contexts(sums: np.ndarray, index: np.ndarray, bucket: np.ndarray, looks: np.ndarray,
                 of: np.ndarray, reach: int = REACH, step: int = 1 << 16) -> None:
    """Adds to each token's (and shape's) sum the index vectors of its
    neighbours in the same text, in slices of ``step`` places."""
    n = len(bucket)
    for s in range(0, n, step):
        e = min(n, s + step)
        lo, hi = max(0, s - reach), min(n, e + reach)
        own = index[bucket[lo:hi]] + index[looks[lo:hi]]
        text, here = of[lo:hi], slice(s - lo, e - lo)
        near = np.zeros((e - s, index.shape[1]), np.int32)
        for k in range(1, reach + 1):
            for d in (-k, k):
                at = np.arange(s - lo + d, e - lo + d)
                ok = (at >= 0) & (at < hi - lo)
                ok[ok] &= text[at[ok]] == text[here][ok]
                near[ok] += own[at[ok]]
        for key in (bucket[s:e], looks[s:e]):
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
            sums[key[order][first]] += np.add.reduceat(near[order], first, axis=0)


def unit(sums: np.ndarray) -> np.ndarray:
    length = np.sqrt((sums.astype(np.float64) ** 2).sum(1, keepdims=True))
    return (sums / np.where(length > 0, length, 1)).astype(np.float32)


def word_vectors(docs: DataFrame, text_col: str = "text", dims: int = DIMS,
                 size: int = SIZE) -> np.ndarray:
    """Word vectors of all the texts; at most ``dims x size`` numbers come back."""
    def contexts(batches) -> Iterator[pa.RecordBatch]:
        sums, index, any_ = np.zeros((dims, size), np.int64), index_vectors(dims, size), False
        for b in pieces(batches, "text", 1 << 20):
            found = tokens(texts(b), dims)
            any_ |= bool(len(found[0]))
            add_contexts(sums, index, *found)
        if not any_:
            return
        pack = zstandard.ZstdCompressor(level=1).compress
        for k in range(0, dims, BLOCK):
            block = sums[k:k + BLOCK]
            if block.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), pa.array([pack(block.tobytes())], pa.binary())],
                    schema=schema_of("first long,block binary"))

    def merged(batches) -> Iterator[pa.RecordBatch]:
        at, sums = None, None
        out = schema_of("first long,block binary")

        def closed():
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([sums.tobytes()], pa.binary())], schema=out)
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for i in range(b.num_rows):  # a block at a time
                first = b.column(0)[i].as_py()
                block = np.frombuffer(unpack(b.column(1)[i].as_py()), np.int64)
                if first != at:
                    if at is not None:
                        yield closed()
                    at, sums = first, block.copy()
                else:
                    sums += block
        if at is not None:
            yield closed()

    ddl = "first bigint,block binary"
    got = (docs.select(F.col(text_col).alias("text")).mapInArrow(contexts, ddl)
           .repartition("first").sortWithinPartitions("first").mapInArrow(merged, ddl)).toArrow()
    sums = np.zeros((dims, size), np.int64)
    for first, block in zip(got["first"].to_pylist(), got["block"].to_pylist()):
        x = np.frombuffer(block, np.int64).reshape(-1, size)
        sums[first:first + len(x)] = x
    return unit(sums)


def pooled(vectors: np.ndarray, ts: list[str], step: int = 1 << 15) -> np.ndarray:
    """Mean vector of each text (over tokens and shapes) and the logarithm of
    its number of tokens."""
    dims, size = vectors.shape
    bucket, looks, of = tokens(ts, dims)
    out = np.zeros((len(ts), size + 1))
    n = np.bincount(of, minlength=len(ts)).astype(np.float64)
    for s in range(0, len(of), step):
        t = of[s:s + step]
        first = np.flatnonzero(np.r_[True, np.diff(t) != 0])
        both = vectors[bucket[s:s + step]] + vectors[looks[s:s + step]]
        out[t[first], :size] += np.add.reduceat(both, first, axis=0, dtype=np.float64)
    out[:, :size] /= np.maximum(2 * n, 1)[:, None]
    out[:, size] = np.log1p(n)
    return out


# -- the network ----------------------------------------------------------------------

def loss_and_gradients(params: list[np.ndarray], x: np.ndarray, y: np.ndarray, l2: float = 1e-4,
                       ) -> tuple[float, list[np.ndarray]]:
    w1, b1, w2, b2 = params
    h = np.tanh(x @ w1 + b1)
    z = h @ w2 + b2[0]
    loss = float(np.mean(np.logaddexp(0, z) - y * z)) + l2 / 2 * float((w1 ** 2).sum() + (w2 ** 2).sum())
    e = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - y) / len(y)
    back = np.outer(e, w2) * (1 - h ** 2)
    return loss, [x.T @ back + l2 * w1, back.sum(0), h.T @ e + l2 * w2, np.array([e.sum()])]


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log-loss, by golden section
    over its logarithm. Labels count as the rates that so many rows support (one
    more row of each label), so rows that are told apart without a fault do not
    make the scores certain."""
    if len(y) == 0 or y.min() == y.max():
        return 1.0
    n1 = float(y.sum())
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))

    def loss(t):
        z = logits / np.exp(t)
        return float(np.mean(np.logaddexp(0, z) - goal * z))
    lo, hi, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        if loss(a) <= loss(b):
            hi = b
        else:
            lo = a
    return float(np.exp((lo + hi) / 2))


def train(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS,
          rate: float = RATE, batch: int = 128, held: float = CALIBRATION) -> Network:
    """Adam on the log-loss; every 1/``held``-th row is kept for the temperature.
    The result depends on the order of the rows, so callers sort them."""
    rng = np.random.default_rng(SEED)
    every = max(2, round(1 / held))
    out = np.arange(len(y)) % every == every - 1
    mean, scale = x[~out].mean(0), x[~out].std(0) + 1e-6
    z, t = (x[~out] - mean) / scale, y[~out]
    share = min(max(float(t.mean()), 1e-3), 1 - 1e-3)
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, 0.1, hidden), np.array([np.log(share / (1 - share))])]
    m, v, k = [0 * p for p in params], [0 * p for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(t))
        for s in range(0, len(order), batch):
            pick = order[s:s + batch]
            k += 1
            for i, g in enumerate(loss_and_gradients(params, z[pick], t[pick])[1]):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                params[i] = params[i] - rate * (m[i] / (1 - 0.9 ** k)) / (
                    np.sqrt(v[i] / (1 - 0.999 ** k)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
    return Network(mean, scale, net.w1, net.b1, net.w2, net.b2,
                   temperature(net.logits(x[out]), y[out]))


def fit(labelled: DataFrame, label_col: str = "quality", text_col: str = "text",
        id_col: str = "doc_id", dims: int = DIMS, size: int = SIZE, hidden: int = HIDDEN,
        epochs: int = EPOCHS, max_rows: int = MAX_TRAINING_ROWS) -> Model | None:
    """Fits on the rows with a label; beyond ``max_rows`` on a sample of about
    so many, drawn by a hash of the id. One task holds the sample's vectors."""
    rows = labelled.select(F.col(id_col).cast("string").alias("id"),
                           F.col(label_col).cast("int").alias("y"),
                           F.col(text_col).alias("text")).filter("y IS NOT NULL")
    total = rows.count()
    if total == 0:
        return None
    rows = rows.withColumn("draw", drawn_by(F.col("id")))
    if total > max_rows:
        rows = rows.filter(F.col("draw") < max_rows / total * 2 ** 32)
    rows = stored(rows)  # read for the vectors and for the network
    vectors = word_vectors(rows.filter("text IS NOT NULL"), dims=dims, size=size)
    sent = rows.sparkSession.sparkContext.broadcast(vectors)

    def featurise(batches) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text", 1 << 20):
            x = pooled(sent.value, texts(b))
            yield pa.RecordBatch.from_arrays(
                [b.column("draw"), b.column("y"), pa.array([r.tobytes() for r in x], pa.binary())],
                schema=schema_of("draw double,y int,x binary"))

    def learn(t):
        t = t.sort_by([("draw", "ascending"), ("y", "ascending"), ("x", "ascending")])
        x = np.frombuffer(b"".join(t.column("x").to_pylist())).reshape(-1, size + 1)
        n = train(x, t.column("y").to_numpy().astype(float), hidden, epochs)
        return pa.table({"net": pa.array([np.concatenate(
            [n.mean, n.scale, n.w1.ravel(), n.b1, n.w2, [n.b2, n.temperature]]).tobytes()],
            pa.binary())})

    got = (rows.select("draw", "y", "text").mapInArrow(featurise, "draw double,y int,x binary")
           .groupBy(F.lit(0).alias("one")).applyInArrow(learn, "net binary")).first()
    return None if got is None else Model(vectors, network_of(np.frombuffer(got["net"]), size + 1,
                                                               hidden))


def network_of(flat: np.ndarray, inputs: int, hidden: int) -> Network:
    at = np.cumsum([0, inputs, inputs, inputs * hidden, hidden, hidden, 1, 1])
    p = [flat[s:e] for s, e in zip(at[:-1], at[1:])]
    return Network(p[0], p[1], p[2].reshape(inputs, hidden), p[3], p[4], float(p[5][0]),
                   float(p[6][0]))


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score``, the probability of the label 1."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return d.select("doc_id", F.lit(0.0).alias("score"))
    n = model.network
    # plain values: executors need not have the class
    sent = d.sparkSession.sparkContext.broadcast(
        (model.vectors, (n.mean, n.scale, n.w1, n.b1, n.w2, n.b2, n.temperature)))

    def run(batches) -> Iterator[pa.RecordBatch]:
        vectors, net = sent.value
        net = Network(*net)
        for b in pieces(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(net.probability(pooled(vectors, texts(b))))],
                schema=schema_of("doc_id long,score double"))

    return d.mapInArrow(run, "doc_id long,score double")
