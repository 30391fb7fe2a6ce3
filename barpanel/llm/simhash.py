"""SimHash near-duplicates (operator 2).

A text's fingerprint sums, bit by bit, the XXH64 hashes of its word shingles: a
bit is 1 if it is set in more than half of them. Two fingerprints link if they
differ in at most ``distance`` bits.

Links are found among distinct fingerprints, so exact copies cost one row.
*Pigeonhole blocks*: the 64 bits are split into blocks; fingerprints that
differ in d bits agree on all but d blocks, so each row is dealt once for every
choice of the blocks that may differ, under the bits of the others. Members of
a bucket are compared by Hamming distance where they meet, and only a spanning
forest of the links found leaves the task, not the pairs.

Buckets of more than ``BUCKET`` fingerprints are not compared there: their
members are dealt again by finer blocks of 4 bits. A bucket of those keeps 52
bits and leaves 12, so it cannot hold more than 4096 distinct fingerprints,
however many near copies there are. Any link has a bucket in each dealing, so
none is lost.

Defined cases: null, empty and wordless texts have fingerprint 0 and link as
any other; texts of fewer words than a shingle are one shingle; a null
``doc_id`` keeps its fingerprint and joins its component; a component of null
ids only has a null ``component_id``; repeated rows come back repeated; texts of any
length are read whole, slice by slice; a bit set in exactly half of the shingles
(a tie) is 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import (
    appended, cut, pieces, ragged, restored, runs, schema_of, starts_of, texts)
from barpanel.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Blocks of the first dealing: 20 choices for 3 bits, buckets by 31 bits or more.
BLOCKS = 6
#: Blocks of the second dealing, 4 bits each.
FINE_BLOCKS = 16
#: Most fingerprints of a bucket that are compared in it.
BUCKET = 4096


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text.encode().lower().split()  # ASCII letters and white space only
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(g, seed) for g in grams), np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_ = bits.sum(0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(set_, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed 64-bit number."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            fps = np.array([fingerprint(t, shingle, seed) for t in texts(b)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(fps.view(np.int64))],
                schema=schema_of("doc_id long,fp long"))

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, "doc_id long,fp long")


def masks(blocks: int, distance: int) -> list[int]:
    """Bits that must agree, for every choice of blocks that may differ; as
    signed 64-bit numbers."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    part = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    out = [(1 << 64) - 1 - sum(c) for c in combinations(part, distance)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def deal(fps: DataFrame, blocks: int, distance: int) -> DataFrame:
    """``fp`` once per mask: ``k`` (the mask's number) and ``key`` (its bits)."""
    each = [F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
            for i, m in enumerate(masks(blocks, distance))]
    return fps.select("fp", F.explode(F.array(*each)).alias("b")).select("b.k", "b.key", "fp")


def _forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of one bucket: every fingerprint that is not the first of
    its component, with the one it was reached from."""
    left = np.arange(len(fp))
    a, b = [], []
    while left.size:
        front, left = left[:1], left[1:]
        while front.size and left.size:
            found = np.full(left.size, -1)
            for s in range(0, front.size, 256):
                f = front[s:s + 256]
                near = np.bitwise_count(fp[left, None] ^ fp[f][None, :]) <= distance
                hit = near.any(1) & (found < 0)
                found[hit] = f[near[hit].argmax(1)]
            hit = found >= 0
            a.append(fp[left[hit]])
            b.append(fp[found[hit]])
            front, left = left[hit], left[~hit]
    return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])


def _links(distance: int):
    """Task function: links of all buckets of a partition sorted by bucket."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        schema = schema_of("a long,b long")
        for t in runs(batches, ["k", "key"]):
            k, key = t.column("k").to_numpy(), t.column("key").to_numpy()
            fp = t.column("fp").to_numpy().view(np.uint64)
            at = starts_of(k, key)
            size = np.diff(at)
            out = [(fp[:0], fp[:0])]
            # small buckets together: all their pairs at once, at most 28 each
            small = np.flatnonzero((size > 1) & (size <= 8))
            for d in range(1, 8):
                fit = small[size[small] > d]
                i = ragged(at[fit], size[fit] - d)
                near = np.bitwise_count(fp[i] ^ fp[i + d]) <= distance
                out.append((fp[i[near]], fp[i[near] + d]))
            for g in np.flatnonzero(size > 8):
                out.append(_forest(fp[at[g]:at[g + 1]], distance))
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*out))
            if a.size:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)
    return run


def _compared(dealt: DataFrame, distance: int) -> DataFrame:
    """Links of whole buckets, each in one task. They are dealt by a hash of the
    bucket: Spark drops an exchange by ``k`` and ``key`` after a join by them, and
    if that join becomes a broadcast while it runs, its rows are read file by file,
    which tears the buckets apart."""
    return (dealt.repartition(F.xxhash64("k", "key")).sortWithinPartitions("k", "key", "fp")
            .mapInArrow(_links(distance), "a long,b long").distinct())


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS,
          bucket: int = BUCKET) -> DataFrame:
    """Links (``a``, ``b``) that connect exactly the distinct fingerprints of
    column ``fp`` that any chain of links of at most ``distance`` bits connects."""
    dealt = deal(fps, blocks, distance)
    shared = cut(dealt.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    met = dealt.join(shared, ["k", "key"])
    found = _compared(met.filter(F.col("n") <= bucket).drop("n"), distance)
    if shared.filter(F.col("n") > bucket).isEmpty():
        return found
    dense = cut(met.filter(F.col("n") > bucket).select("fp").distinct())
    fine = deal(dense, FINE_BLOCKS, distance)
    many = fine.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return found.unionByName(_compared(fine.join(many.drop("n"), ["k", "key"]), distance))


def grouped(rows: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp``, ``component`` (the least fingerprint reachable) and
    ``component_id`` (the smallest id) of rows (``doc_id``, ``fp``)."""
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    of = components(links(distinct.select("fp"), distance), "a", "b")
    owned = distinct.join(of.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    least = owned.groupBy("component").agg(F.min("first_id").alias("component_id"))
    return owned.join(least, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fp``, ``fingerprint`` (16 hex
    digits) and ``component_id``, the smallest id reachable by links."""
    rows = cut(fingerprints(docs, shingle, seed, id_col, text_col))
    return rows.join(grouped(rows, distance), "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
               seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, one per component: the row whose id is
    the component's; of repeated rows of that id, one. A component without any
    id keeps one of its rows."""
    rows = cut(fingerprints(docs, shingle, seed, id_col, text_col))
    of = cut(grouped(rows, distance))
    id_ = F.col(f"`{id_col}`").cast("long")
    repeated = cut(rows.filter("doc_id IS NOT NULL").groupBy("doc_id").count()
                   .filter("count > 1").select(F.col("doc_id").alias("twice")))
    stay = (rows.join(of, "fp").filter("doc_id = component_id")
            .select(F.col("doc_id").alias("stay")).distinct())
    once = (stay.join(repeated, stay["stay"] == repeated["twice"], "left_anti"))
    kept = docs.join(once, id_ == once["stay"], "left_semi")
    if rows.filter("doc_id IS NULL").isEmpty() and repeated.isEmpty():
        return kept
    # rows that their id does not tell apart are judged by their fingerprint
    odd = docs.join(repeated, id_ == repeated["twice"], "left_semi").unionByName(
        docs.filter(id_.isNull()))
    marked = appended(odd, "fp long", lambda ts: [np.array(
        [fingerprint(t, shingle, seed) for t in ts], np.uint64).view(np.int64)], text_col)
    own = F.col(f"c{docs.columns.index(id_col)}").cast("long")
    first = (marked.join(of, "fp").filter(own.eqNullSafe(F.col("component_id")))
             .dropDuplicates(["component"]))
    return kept.unionByName(restored(first, docs))
