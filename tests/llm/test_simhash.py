import random
import re

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from barpanel.llm import simhash
from tests.llm.helpers import docs, least_reachable, prose


def brute(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    grams = [w[i:i + 3] for i in range(len(w) - 2)] if len(w) >= 3 else [w]
    hs = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aBß \t\n\x0b\x1f  Zé1", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute(text)


def near_copies(n, rng):
    base = prose(rng, 300).split()
    out = []
    for _ in range(n):
        w = list(base)
        w[rng.randrange(len(w))] = "x"
        out.append(" ".join(w))
    return out


def table():
    rng = random.Random(3)
    texts = [prose(rng, 60) for _ in range(30)]
    texts += near_copies(40, rng) + [texts[0], texts[1], texts[1]]
    return texts + [None, "", " \n ", "one", "two words", "two words"]


def components_of(pairs, distance=3):
    fps = {f for _, f in pairs}
    links = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= distance]
    root = least_reachable(fps, links)
    least = {}
    for i, f in pairs:
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    return {f: least.get(root[f]) for f in fps}


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 1])
def test_components(spark, bucket, monkeypatch):
    """With a limit of one fingerprint every shared bucket goes the fine way."""
    texts = table()
    monkeypatch.setattr(simhash.links, "__defaults__", (3, simhash.BLOCKS, bucket))
    got = simhash.near_duplicates(docs(spark, texts, clash=True).repartition(4)).collect()
    want = components_of([(i, brute(t)) for i, t in enumerate(texts)])
    assert len(got) == len(texts)
    for r in got:
        f = brute(texts[r.doc_id])
        assert r.fingerprint == f"{f:016x}" and r.component_id == want[f]
    assert len(set(want.values())) < len(want)  # something linked


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 256])
def test_no_plan_tears_a_bucket_apart(spark, bucket):
    """The join of the buckets becomes a broadcast while it runs, whose other side is read
    in parts. Every member of a group is three bits from its first and mostly far from the
    others, so a link lost is a member lost."""
    rng = random.Random(5)

    def near(fp):
        for b in rng.sample(range(64), 3):
            fp ^= 1 << b
        return fp
    groups = [{f := rng.getrandbits(64), *(near(f) for _ in range(n))}
              for n in [2500, 300] + [0] * 20_000]
    signed = {f: f - (1 << 64) if f >> 63 else f for g in groups for f in g}
    key = "spark.sql.autoBroadcastJoinThreshold"
    was = spark.conf.get(key)
    try:
        spark.conf.set(key, "256k")
        fps = spark.createDataFrame([(f,) for f in signed.values()], "fp long")
        got = simhash.links(fps.repartition(16).checkpoint(), bucket=bucket).collect()
    finally:
        spark.conf.set(key, was)
    found = least_reachable(signed.values(), [(r.a, r.b) for r in got])
    assert [len({found[signed[f]] for f in g}) for g in groups[:3]] == [1, 1, 1]
    assert len(set(found.values())) == len(groups)


def test_null_ids_and_repeated_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "q r s t u"), (9, None)]
    got = simhash.near_duplicates(docs(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [
        (-1, -1), (-1, 5), (5, 5), (5, 5), (9, 9)]


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.keep_first(docs(spark, [])).count() == 0


def test_masks_are_bounded():
    for m in simhash.masks(simhash.FINE_BLOCKS, 3):
        assert (m & (1 << 64) - 1).bit_count() == 52


def test_keep_first(spark):
    texts = table()
    got = simhash.keep_first(docs(spark, texts, clash=True))
    want = components_of([(i, brute(t)) for i, t in enumerate(texts)])
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(want.values()))
    assert got.columns == docs(spark, [], clash=True).columns


def test_keep_first_of_odd_rows(spark):
    rows = [(5, "a b c d"), (5, "a b c d"), (5, "other words are here"), (None, "a b c d"),
            (None, "q r s t u"), (None, "q r s t u"), (9, "a b c d"), (1, "x y z")]
    got = simhash.keep_first(docs(spark, [t for _, t in rows], [i for i, _ in rows]))
    assert sorted((r.doc_id or -1, r.text) for r in got.collect()) == [
        (-1, "q r s t u"), (1, "x y z"), (5, "a b c d"), (5, "other words are here")]


def test_very_long_text(spark):
    """A text of 40,000 words, its copy, and one with a word changed."""
    import random

    from tests.llm.helpers import prose
    t = prose(random.Random(11), 40_000)
    texts = [t, t, t.replace(" ", " changed ", 1), "short one here"]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    for i, x in enumerate(texts):
        assert got[i].fingerprint == f"{brute(x):016x}"
    assert [got[i].component_id for i in range(4)] == [0, 0, 0, 3]
