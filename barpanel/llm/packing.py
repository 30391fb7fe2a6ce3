"""Packing by concatenate and cut (operator 1).

Pass one tokenises: every task numbers its documents' ids from 0 and writes
them with its partition number. The partitions' totals, one row each, give
global offsets by a prefix sum. Pass two adds the offset and cuts at multiples
of the sequence length; a document that crosses a cut leaves one boundary
record (piece) in each sequence it touches. What remains after the last whole
sequence is cut into falling powers of two, lengths that need no padding. No
token is shuffled, and no padding is left.

Ids are those that the ``tokenizers`` library gives for ``byte_bpe_50k.json``
with ``add_special_tokens=False``: nothing is put around a text, but the name
of an added token inside it (``<|endoftext|>``) is that token's id. They are
computed with ``tiktoken`` from the same vocabulary, three times as fast, and
tests hold them against ``tokenizers``; texts with a run of white space that
``tiktoken``'s regex cannot take go through ``tokenizers`` itself.

Defined cases: a null or empty text has only the end id; a null ``doc_id`` is
carried through; every row is a document of its own, repeated rows too, and
rows that tie in everything keep the order of the input; a text of any length is
encoded whole and cut over as many sequences as it fills; an empty table has no
piece; other columns are not read.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barpanel.llm.common import pieces, schema_of, stored, texts

LENGTH = 1024
END_ID = 0
VOCABULARY = "byte_bpe_50k.tiktoken"

#: Texts with a longer run of white space go through ``tokenizers``: the regex
#: of ``tiktoken`` fails on runs of a million characters.
LONG_SPACE = 1 << 17

#: Partition totals are sent to all tasks up to this many rows (16 bytes each).
SENT_ROWS = 1 << 20

_TOKENISED = "doc_id long,part long,at long,n long,ids binary"


def encoder(vocabulary: str = VOCABULARY):
    """A function from a text to its ids (unsigned 32-bit), for the vocabulary file
    of that name in the installed ``public_tokenizers``; the added tokens are
    those of the ``.json`` file beside it."""
    import public_tokenizers
    import tiktoken
    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    slow = public_tokenizers.path(vocabulary.replace(".tiktoken", ".json"))
    with open(slow, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    # tiktoken looks for the plain names only
    if any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens of {vocabulary} are not plain")
    fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={a["content"]: a["id"] for a in added})
    long_space = re.compile(r"\s{%d}" % LONG_SPACE)
    whole = []

    def ids(text: str) -> np.ndarray:
        if len(text) >= LONG_SPACE and long_space.search(text):
            if not whole:
                from tokenizers import Tokenizer
                whole.append(Tokenizer.from_file(slow))
            return np.array(whole[0].encode(text, add_special_tokens=False).ids, "<u4")
        return fast.encode_to_numpy(text, allowed_special="all").astype("<u4")

    return ids


def tokenise(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pass one: ids of each document (little-endian unsigned 32-bit, end id
    included), its partition and the ids before it there."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        enc, part, at = encoder(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for b in pieces(batches, "text"):
            ids = [enc(t).tobytes() + end for t in texts(b)]
            n = np.array([len(x) // 4 for x in ids], np.int64)
            before = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.full(len(ids), part, np.int64)),
                 pa.array(before), pa.array(n), pa.array(ids, pa.binary())],
                schema=schema_of(_TOKENISED))

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(run, _TOKENISED)


def offsets(tokenised: DataFrame) -> DataFrame:
    """Ids before each partition, from the partitions' totals. The window is
    over one row per partition of the input, not over data rows."""
    totals = tokenised.groupBy("part").agg(F.sum("n").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def tail(total: int, length: int) -> list[tuple[int, int, int]]:
    """(sequence, first id, ids) of the short sequences after the whole ones."""
    sequence, first = divmod(total, length)[0], total - total % length
    out = []
    for k in reversed(range((total - first).bit_length())):
        if (total - first) >> k:
            out.append((sequence, first, 1 << k))
            sequence, first = sequence + 1, first + (1 << k)
    return out


def pack(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY,
         end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (its document's ids before it),
    ``length``, ``ids`` (binary, little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id`` and ``offset`` in the sequence."""
    rows = stored(tokenise(docs, vocabulary, end_id, id_col, text_col))
    base = stored(offsets(rows))
    total = rows.agg(F.sum("n")).first()[0] or 0
    if base.count() <= SENT_ROWS:
        base = F.broadcast(base)
    whole, short = total // length, tail(total, length)
    g, end = F.col("base") + F.col("at"), F.col("base") + F.col("at") + F.col("n")

    def window(sequence, first, size) -> Column:
        return F.struct(*[F.lit(x).cast("long").alias(k) if isinstance(x, int) else
                          x.cast("long").alias(k) for k, x in
                          (("id", sequence), ("first", first), ("size", size))])
    lo, hi = F.floor(g / length), F.least(F.floor((end - 1) / length), F.lit(whole - 1))
    windows = F.when(lo <= hi, F.transform(
        F.sequence(lo, F.greatest(lo, hi)), lambda k: window(k, k * length, length)))
    if short:
        touched = F.filter(F.array(*[window(*x) for x in short]),
                           lambda x: (x["first"] < end) & (x["first"] + x["size"] > g))
        windows = F.concat(F.coalesce(windows, F.array().cast(
            "array<struct<id:bigint,first:bigint,size:bigint>>")), touched)
    cut = rows.join(base, "part").select("doc_id", "n", "ids", g.alias("g"),
                                         F.explode(windows).alias("w"))
    begin = F.greatest(F.col("g"), F.col("w.first"))
    size = F.least(F.col("g") + F.col("n"), F.col("w.first") + F.col("w.size")) - begin
    start = begin - F.col("g")
    return cut.select(
        "doc_id", start.alias("start"), size.alias("length"),
        F.substring("ids", (start * 4 + 1).cast("int"), (size * 4).cast("int")).alias("ids"),
        F.col("n").alias("doc_tokens"), F.col("w.id").alias("sequence_id"),
        (begin - F.col("w.first")).alias("offset"))


def sequences(packed: DataFrame, length: int = LENGTH, pad_id: int = END_ID) -> DataFrame:
    """The sequences of packed pieces: ``sequence_id``, ``n_tokens`` and ``ids``
    (binary, 4 bytes an id), padded to ``length`` unless their length is a power
    of two. A sequence gathers at most ``length`` pieces, as each holds an id."""
    got = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"),
                         lambda acc, x: F.concat(acc, x["ids"]))
    pad = int(pad_id).to_bytes(4, "little")
    size = F.when(F.bit_count("n_tokens") == 1, F.col("n_tokens")).otherwise(F.lit(length))
    return got.select("sequence_id", "n_tokens",
                      F.rpad(joined, (4 * size).cast("int"), F.lit(pad)).alias("ids"))
