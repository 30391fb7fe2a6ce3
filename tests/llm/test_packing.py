import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barpanel.llm.packing import pack, sequences
from tests.llm.helpers import docs, prose


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return t


TEXTS = ["", None, "one", "Zwölf Bären, déjà vu — 日本語 😀", "a" * 5000, " \n\t\r\n  x",
         "<|endoftext|> is text", prose(random.Random(1), 4000), "tie", "tie"]


def check(spark, df, rows, tokenizer, length):
    """Pieces hold exactly every document's ids, and sequences have no gap."""
    got = pack(df, length).collect()
    assert set(got[0].asDict()) == {"doc_id", "start", "length", "ids", "doc_tokens",
                                    "sequence_id", "offset"}
    want = {}
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        want.setdefault(i, []).append(ids)
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length and r.length > 0
    assert set(by_doc) == set(want)
    for i, lists in want.items():
        pieces = sorted(by_doc[i], key=lambda r: (r.start, r.sequence_id, r.offset))
        if len(lists) == 1:
            joined = np.concatenate([np.frombuffer(r.ids, "<u4") for r in pieces]).tolist()
            assert joined == lists[0] and {r.doc_tokens for r in pieces} == {len(joined)}
        else:
            assert sum(r.length for r in pieces) == sum(map(len, lists))
    total = sum(len(x) for lists in want.values() for x in lists)
    sizes = [length] * (total // length) + [1 << k for k in range(20, -1, -1)
                                            if total % length >> k & 1]
    assert sorted(by_seq) == list(range(len(sizes)))
    for s, ps in by_seq.items():
        ps.sort(key=lambda r: r.offset)
        at = 0
        for r in ps:
            assert r.offset == at
            at += r.length
        assert at == sizes[s]  # nothing needs padding
    return got


@pytest.mark.parametrize("length", [16, 1024])
def test_pieces_round_trip(spark, tokenizer, length):
    df = docs(spark, TEXTS, clash=True).repartition(3)
    check(spark, df, list(enumerate(TEXTS)), tokenizer, length)


def test_repeated_rows_and_null_ids(spark, tokenizer):
    rows = [(7, "same text here"), (7, "same text here"), (None, "no id"), (1, None)]
    df = docs(spark, [t for _, t in rows], [i for i, _ in rows])
    check(spark, df, rows, tokenizer, 4)


def test_tail():
    from barpanel.llm.packing import tail
    assert tail(2048, 1024) == [] and tail(0, 1024) == []
    assert tail(1024 + 700, 1024) == [(1, 1024, 512), (2, 1536, 128), (3, 1664, 32),
                                      (4, 1696, 16), (5, 1712, 8), (6, 1720, 4)]


def test_short_corpus(spark, tokenizer):
    """Less than one sequence: powers of two only."""
    check(spark, docs(spark, ["a b c", "d"]), [(0, "a b c"), (1, "d")], tokenizer, 1024)


def test_empty_table(spark):
    assert pack(docs(spark, [])).count() == 0


def test_sequences_are_padded(spark, tokenizer):
    got = pack(docs(spark, TEXTS), 64)
    seqs = {r.sequence_id: r for r in sequences(got, 64).collect()}
    stream = []
    for r in sorted(got.collect(), key=lambda r: (r.sequence_id, r.offset)):
        stream += np.frombuffer(r.ids, "<u4").tolist()
    for k, r in seqs.items():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        at = sum(x.n_tokens for j, x in seqs.items() if j < k)
        assert len(ids) == r.n_tokens and ids == stream[at:at + r.n_tokens]
    # pieces that do not fill a power of two are padded
    odd = got.filter("sequence_id = 0 AND offset = 0").withColumn("length", F.lit(3)).withColumn(
        "ids", F.substring("ids", 1, 12))
    r = sequences(odd, 64, 9).first()
    assert np.frombuffer(r.ids, "<u4")[3:].tolist() == [9] * 61


def test_query_digest(spark, tokenizer, tmp_path):
    from barpanel.llm.queries import QUERIES
    docs(spark, TEXTS).write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op1_packing"](spark, str(tmp_path)).collect():
        ids = tokenizer.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids + [0]
        part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32
