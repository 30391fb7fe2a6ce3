"""Embedding near-duplicates by cross-polytope hashing (operator 3).

A vector is rotated by random signs and fast Hadamard transforms (three times
over); its hash is the nearest signed axis. A table joins ``hashes`` of them to
one bucket. Every vector is dealt to its own bucket and to the next likeliest
ones (``probes`` in all), and two vectors meet in a bucket if it is the own one
of either. With 12 tables of 3 hashes and 8 probes, pairs of cosine 0.9 meet
with a probability of about 0.9996, closer ones more surely. Pairs that meet
are verified by their cosine in double precision.

Equal vectors are one class from the start. Buckets in which nobody can meet
are dropped before any vector is shuffled. Large buckets are split into chunks
whose pairs are compared in cells of bounded size, one task group per pair of
chunks. A cell returns, per vector, how many links it saw and one link towards
a spanning forest, never the pairs. A pair that meets several times counts in
its first table only, which both vectors' codes tell.

Defined cases: vectors that are null, empty, all zero or hold null or
non-finite components link with nothing, nor do rows with a null id; vectors of
different lengths are never compared; equal vectors link with each other;
repeated ids are rows of their own that share the smallest id; ties between ids
cannot arise otherwise; a cosine of exactly the limit links; vectors of any
length are compared whole; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import cut, ragged, runs, schema_of, starts_of, stored
from barpanel.llm.components import components

MIN_COSINE = 0.9
TABLES, HASHES, PROBES = 12, 3, 8
#: Axes of a rotation that multiprobe considers.
NEAREST = 5
#: Vectors of a chunk: a cell compares two chunks.
CHUNK = 1024
SEED = 20


def signs(dim: int, tables: int, hashes: int, seed: int) -> np.ndarray:
    """tables x hashes x 3 x dim random signs."""
    return np.random.default_rng([seed, dim]).choice([-1.0, 1.0], (tables, hashes, 3, dim))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of
    two, up to scale."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def codes(unit: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """Buckets of unit vectors: rows x tables x probes, the own bucket first."""
    n, d = unit.shape
    full = 1 << max(1, (d - 1).bit_length())
    x = np.zeros((n, full))
    x[:, :d] = unit
    sg = signs(full, tables, hashes, seed)
    top = min(NEAREST, 2 * full)
    combos = np.stack(np.meshgrid(*[np.arange(top)] * hashes, indexing="ij"), -1).reshape(-1, hashes)
    out = np.zeros((n, tables, probes), np.int64)
    for t in range(tables):
        lag = np.zeros((n, len(combos)))
        axis = []
        for k in range(hashes):
            r = x
            for s in sg[t, k]:
                r = hadamard(r * s) / np.sqrt(full)
            both = np.concatenate([r, -r], axis=1)
            best = np.argpartition(-both, top - 1, axis=1)[:, :top]
            value = np.take_along_axis(both, best, 1)
            order = np.argsort(-value, axis=1, kind="stable")
            best, value = (np.take_along_axis(z, order, 1) for z in (best, value))
            axis.append(best)
            lag += ((value[:, :1] - value) ** 2)[:, combos[:, k]]
        pick = np.argsort(lag, axis=1, kind="stable")[:, :probes]
        code = np.zeros((n, pick.shape[1]), np.int64)
        for k in range(hashes):
            code = code * (2 * full) + np.take_along_axis(axis[k], combos[pick, k], 1)
        out[:, t] = code[:, [min(i, code.shape[1] - 1) for i in range(probes)]]
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision. Scaled first, so that squares of
    large or small components stay finite."""
    x = x.astype(float)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed(code: np.ndarray, dim: int, hashes: int) -> np.ndarray:
    """Codes in 32 bits where the buckets of the dimension fit them."""
    full = 1 << max(1, (dim - 1).bit_length())
    return code.astype("<i4" if (2 * full) ** hashes < 1 << 31 else "<i8")


def _unpacked(blobs: list[bytes], tables: int, probes: int) -> np.ndarray:
    kind = f"<i{len(blobs[0]) // (tables * probes)}"
    return np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), tables, probes)


def _hashed(tables: int, hashes: int, probes: int, seed: int, kind: str):
    """Task function: vectors as they came (``kind``: their components) and
    codes of the classes."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                vectors = [np.array(v, float) for v in b.column("vector").to_pylist()]
                raw, code = [b""] * len(vectors), [b""] * len(vectors)
                dims = np.array([len(v) for v in vectors])
                for d in np.unique(dims).tolist():
                    pick = np.flatnonzero(dims == d)
                    x = np.stack([vectors[i] for i in pick])
                    c = _packed(codes(_unit(x), tables, hashes, probes, seed), d, hashes)
                    for i, v, k in zip(pick, x.astype(kind), c):
                        raw[i], code[i] = v.tobytes(), k.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("n"), pa.array(dims.astype(np.int64)),
                     pa.array(raw, pa.binary()), pa.array(code, pa.binary())],
                    schema=schema_of("id long,n long,dim long,raw binary,codes binary"))
    return run


def _dealt(tables: int, probes: int):
    """Task function: one row per class, table and bucket."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        schema = schema_of("id long,dim long,k long,bucket long,own boolean")
        for whole in batches:
            # one width of codes at a time
            wide = np.array([len(x) for x in whole.column("codes").to_pylist()])
            for b in (whole.take(pa.array(rows[at:at + 2048])) for w in np.unique(wide)
                      for rows in [np.flatnonzero(wide == w)] for at in range(0, len(rows), 2048)):
                c = _unpacked(b.column("codes").to_pylist(), tables, probes).astype(np.int64)
                each = tables * probes
                fresh = np.ones(c.shape, bool)  # short vectors have fewer buckets than probes
                for p in range(1, probes):
                    fresh[:, :, p] = (c[:, :, p, None] != c[:, :, :p]).all(2)
                fresh = fresh.ravel()
                k = np.broadcast_to(np.arange(tables)[None, :, None], c.shape).ravel()
                own = np.broadcast_to(np.arange(probes)[None, None, :] == 0, c.shape).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(b.column("id").to_numpy(), each)[fresh]),
                     pa.array(np.repeat(b.column("dim").to_numpy(), each)[fresh]),
                     pa.array(k[fresh].astype(np.int64)), pa.array(c.ravel()[fresh]),
                     pa.array(own[fresh])], schema=schema)
    return run


def _first_met(code: np.ndarray, i: np.ndarray, j: np.ndarray, k: np.ndarray,
               bucket: np.ndarray) -> np.ndarray:
    """Whether the pairs meet nowhere before this table and bucket. ``code``:
    rows x tables x probes."""
    first = np.ones(len(i), bool)
    for t in range(code.shape[1]):
        a, b = code[i, t], code[j, t]
        in_a = (b == a[:, :1]).any(1)  # j is dealt to i's own bucket
        in_b = (a == b[:, :1]).any(1)
        first &= ~((in_a | in_b) & (t < k))
        here = t == k
        first &= ~(here & in_a & (a[:, 0] < bucket))
        first &= ~(here & in_b & (b[:, 0] < bucket))
    return first


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row that each of n rows is connected to by the pairs."""
    root = np.arange(n)
    while i.size:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _compare(tables: int, probes: int, least: float, kind: str):
    """Task function: cells of a partition sorted by cell. Per class: links
    seen (``links``, weighted by class size) and ``root``, linked to it."""

    def pairs_of(at, own, chunk, unit):
        """Pairs to verify: small cells by offsets all at once, others by
        blocks of rows, whose cosines come as a matrix product."""
        size = np.diff(at)
        small = size <= 16
        for d in range(1, 16):
            fit = np.flatnonzero(small & (size > d))
            if not fit.size:
                break
            i = ragged(at[fit], size[fit] - d)
            j = i + d
            ok = own[i] | own[j]
            i, j = i[ok], j[ok]
            for s in range(0, len(i), 1 << 15):
                p, q = i[s:s + (1 << 15)], j[s:s + (1 << 15)]
                near = (unit[p] * unit[q]).sum(1) >= least
                yield p[near], q[near]
        for g in np.flatnonzero(~small):
            s, e = int(at[g]), int(at[g + 1])
            for r in range(s, e, 256):
                top = min(r + 256, e)
                near = unit[r:top] @ unit[s:e].T >= least
                p, q = np.nonzero(near)
                p, q = p + r, q + s
                ok = (p < q) & (own[p] | own[q])
                yield p[ok], q[ok]

    def run(batches) -> Iterator[pa.RecordBatch]:
        schema = schema_of("id long,links long,root long")
        for t in runs(batches, ["dim", "k", "bucket", "left", "right"]):
            dim, k, bucket, left, right, chunk, id_, n = (
                t.column(c).to_numpy() for c in
                ("dim", "k", "bucket", "left", "right", "chunk", "id", "n"))
            own = t.column("own").to_numpy(zero_copy_only=False).astype(bool)
            # cells of one vector length at a time
            ends = np.r_[starts_of(dim)]
            for s, e in zip(ends[:-1], ends[1:]):
                part = slice(int(s), int(e))
                unit = _unit(np.frombuffer(b"".join(t.column("raw")[part].to_pylist()),
                                           kind).reshape(e - s, -1))
                code = _unpacked(t.column("codes")[part].to_pylist(), tables, probes)
                lk, lb, lc, ll, lr = (x[part] for x in (k, bucket, chunk, left, right))
                li, ln = id_[part], n[part]
                at = starts_of(lk, lb, ll, lr)
                seen = np.zeros(e - s, np.int64)
                a, b = [], []
                for p, q in pairs_of(at, own[part], lc, unit):
                    ok = (ll[p] == lr[p]) | (lc[p] != lc[q])
                    p, q = p[ok], q[ok]
                    ok = _first_met(code, p, q, lk[p], lb[p])
                    p, q = p[ok], q[ok]
                    seen += np.bincount(p, ln[q], e - s).astype(np.int64)
                    seen += np.bincount(q, ln[p], e - s).astype(np.int64)
                    a.append(p)
                    b.append(q)
                if not a or not seen.any():
                    continue
                root = _roots(e - s, np.concatenate(a), np.concatenate(b))
                hit = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(li[hit]), pa.array(seen[hit]), pa.array(li[root[hit]])],
                    schema=schema)
    return run


def near_duplicates(vectors: DataFrame, least: float = MIN_COSINE, tables: int = TABLES,
                    hashes: int = HASHES, probes: int = PROBES, seed: int = SEED,
                    chunk: int = CHUNK, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links`` (others of
    cosine ``least`` or more) and ``component_id``, the smallest id reachable."""
    # single-precision components travel as such; sums are double all along
    single = vectors.schema[vector_col].dataType.elementType.typeName() == "float"
    kind = "<f4" if single else "<f8"
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"))
    sound = F.coalesce(
        F.col("id").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("vector", F.when(sound, F.col("vector")))
    known = rows.filter("vector IS NOT NULL")
    classes = stored(known.groupBy("vector").agg(F.min("id").alias("id"),
                                                 F.count(F.lit(1)).alias("n")))
    hashed = stored(classes.select("id", "n", "vector").mapInArrow(
        _hashed(tables, hashes, probes, seed, kind),
        "id long,n long,dim long,raw binary,codes binary"))
    dealt = stored(hashed.select("id", "dim", "codes").mapInArrow(
        _dealt(tables, probes), "id long,dim long,k long,bucket long,own boolean"))
    place = ["dim", "k", "bucket"]
    live = (dealt.groupBy(*place).agg(F.count(F.lit(1)).alias("size"),
                                      F.max("own").alias("any_own"))
            .filter("size > 1 AND any_own").drop("any_own"))
    parts = F.ceil(F.col("size") / F.lit(chunk)).cast("long")
    cells = (dealt.join(live, place)
             .withColumn("chunk", F.pmod(F.xxhash64("id"), parts))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
             .select(*place, "id", "own", "chunk", F.least("chunk", "other").alias("left"),
                     F.greatest("chunk", "other").alias("right")))
    cell = [*place, "left", "right"]
    found = cut(cells.join(hashed.select("id", "n", "raw", "codes"), "id")
                .repartition(*cell).sortWithinPartitions(*cell, "id")
                .mapInArrow(_compare(tables, probes, least, kind), "id long,links long,root long"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    of = components(found, "id", "root").withColumnRenamed("node", "id")
    classes = (classes.join(counts, "id", "left").join(of, "id", "left")
               .select("vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                       F.coalesce("component", "id").alias("component_id")))
    linked = known.join(classes, "vector").select(
        F.col("id").alias("vec_id"), "n_links", "component_id")
    alone = rows.filter("vector IS NULL").select(
        F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("id").alias("component_id"))
    return linked.unionByName(alone)
