"""Phrase collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from barpanel.llm import collocations as C
from tests.llm.helpers import docs, prose

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DOWN = str.maketrans(ALPHABET, ALPHABET.lower())


def brute(rows, least=10, top=2000):
    """(lang, text) rows -> result rows, by counting every phrase."""
    f = defaultdict(Counter)
    for lang, text in rows:
        f["und" if lang is None else lang]  # noqa: B018
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(DOWN)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(
                    w[i:i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        longer = {}
        for p, a in cand.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer.get(q, 0), a)
        found = []
        for p, a in cand.items():
            if 100 * longer.get(p, 0) >= 50 * a:
                continue
            s, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n",
                                              "score").collect())


def corpus(seed, n):
    rng = random.Random(seed)
    words = prose(rng, 60).split()
    out = []
    for _ in range(n):
        t = " ".join(rng.choices(words[:rng.choice([5, 60])], k=rng.randint(0, 60)))
        for sign in (". ", ", ", "\n", "!", "\t", "  "):
            t = t.replace(" ", sign, rng.randint(0, 2))
        out.append(t + rng.choice(["", " of the KIND", " Of The kind. ÉTÉ été"]))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    texts = corpus(seed, 150)
    langs = [rng.choice(["en", "de", None]) for _ in texts]
    df = docs(spark, texts, lang=langs, clash=True)
    assert got(C.collocations(df)) == brute(list(zip(langs, texts)))


def test_small_buckets_chunks_and_hot_pairs_change_nothing(spark):
    """Every pair of a hot stripe dealt by follower, blocks of a few words."""
    texts = corpus(3, 80) + ["x y " * 400 + f"z{i}" for i in range(12)]
    want = brute([("en", t) for t in texts])
    df = docs(spark, texts)
    assert C.hot_pairs(df.select("lang", "text"), one_of=1)[:1]
    for how in (dict(bucket_bytes=200, chunk_bytes=500, sample=1), dict(bucket_bytes=1000)):
        assert got(C.collocations(df, **how)) == want


def test_top_and_ties(spark):
    """Equal scores and counts: bytes decide; a limit keeps the first."""
    texts = [f"{a} {b}. " * 12 for a, b in ("ab", "cd", "éf", "Zg", "zh")]
    want = brute([("en", t) for t in texts], top=3)
    assert len(want) == 3
    assert got(C.collocations(docs(spark, texts), top=3)) == want


def test_odd_texts(spark):
    texts = [None, "", " \t ", "...", "one", "One two", "a\x0bb\x0cc\rd e",
             "rare word " * 9, "wide　space   " * 12, "\x1f\x85 tab\tstop " * 11]
    assert got(C.collocations(docs(spark, texts))) == brute([("en", t) for t in texts])
    assert got(C.collocations(docs(spark, []))) == []


def test_very_long_text_is_cut_at_piece_ends(spark):
    rng = random.Random(5)
    words = prose(rng, 30).split()
    long_ = " ".join(rng.choice(words) + rng.choice(["", "", ".", ","]) for _ in range(60000))
    texts = [long_, "no end " * 5000, *corpus(6, 20)]
    want = brute([("en", t) for t in texts])
    assert got(C.collocations(docs(spark, texts), chunk_bytes=10_000)) == want


def test_merging_in_parts_equals_merging_at_once():
    texts = corpus(7, 40)
    p = C.Places(texts, np.zeros(len(texts), np.int64))
    blocks = [b for t in texts for _, _, b in C.stripes(
        C.Places([t], np.zeros(1, np.int64)), 1, [])]
    whole, parts = C.Stripes(), C.Stripes()
    for _, _, b in C.stripes(p, 1, []):
        whole.add(b)
    for b in blocks:
        parts.add(b, limit=100)
    key = [("first", "ascending"), ("second", "ascending"), ("third", "ascending")]
    a, b = (x.numbers("en", 1, set()).sort_by(key).to_pylist() for x in (whole, parts))
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_exact_beyond_64_bits(spark):
    rows = [(0, "en", "", "", "", 10**13, 0), (1, "en", "u", "", "", 999999999999, 0),
            (1, "en", "v", "", "", 2000000000003, 0), (2, "en", "u", "v", "", 999999999998, 0)]
    df = spark.createDataFrame(rows, C._NUMBERS_DDL)
    r = C.candidates(df).first()
    assert r["score"] == 1000000 * 999999999998**2 // (999999999999 * 2000000000003)


def test_query_equals_brute_force(spark, tmp_path):
    from barpanel.llm.queries import QUERIES
    texts = corpus(8, 60)
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    assert got(QUERIES["op11_collocations"](spark, str(tmp_path))) == brute(
        [("en", t) for t in texts])
