import zlib

import pytest

from barpanel.llm import langid
from tests.llm.helpers import docs

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    from barpanel.llm.queries import QUERIES
    got = QUERIES["op5_language_id"](spark, SF01)
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet")
            .select("doc_id", "lang").collect()}
    rows = got.collect()
    assert len(rows) == len(true)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.lang_pred in {*true.values(), "und"}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == true[r.doc_id] for r in held) / len(held) > 0.97


TRAIN = [("the cat sat on the mat with that other cat", "en"), ("le chat est sur la table", "fr"),
         ("der hund und die katze", "de"), (None, "de"), ("nothing", None)]


def test_defined_cases(spark):
    model = langid.fit(docs(spark, [t for t, _ in TRAIN], lang=[x for _, x in TRAIN]))
    assert model.labels == ("de", "en", "fr")
    texts = ["the mat", "", None, "123 !?", "la table", "the " * 60000, "日本", "\0\0 la"]
    got = {r.doc_id: r for r in langid.predict(docs(spark, texts, clash=True), model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 3, 4, 5)] == ["en", "und", "und", "und", "fr", "en"]
    assert [got[i].score for i in (1, 2, 3)] == [0.0] * 3
    assert got[6].lang_pred in model.labels
    assert langid.predict(docs(spark, []), model).count() == 0


def test_nothing_to_learn(spark):
    df = docs(spark, ["a", "b"], lang=[None, None])
    assert langid.fit(df) is None
    assert {(r.lang_pred, r.score) for r in langid.predict(df, None).collect()} == {("und", 0.0)}


def test_batched_scores_equal_single_ones(spark):
    model = langid.fit(docs(spark, [t for t, _ in TRAIN], lang=[x for _, x in TRAIN]))
    texts = ["the mat", "x", "la table est", "", "hund katze hund", "a"]
    together = langid.scores(model, texts)
    for t, p in zip(texts, together):
        assert langid.scores(model, [t])[0] == pytest.approx(p)


def test_sampled_training(spark):
    df = docs(spark, ["the cat %d" % i for i in range(200)] + ["le chat"] * 200,
              lang=["en"] * 200 + ["fr"] * 200)
    model = langid.fit(df, max_rows=100)
    got = langid.predict(docs(spark, ["the cat", "le chat"]), model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == ["en", "fr"]


def test_scores_equal_a_plain_naive_bayes(spark):
    """Counts in dictionaries, one n-gram at a time."""
    import math
    import random
    import re
    from collections import Counter

    import numpy as np
    rng = random.Random(2)
    words = {"en": "the of and to in is that it was for", "de": "der die und das ist nicht ein zu",
             "fr": "le la les des est une que dans pour"}
    rows = [(" ".join(rng.choices(words[x].split(), k=rng.randint(3, 30))) + rng.choice(["", " 12!", " É"]), x)
            for x in rng.choices(sorted(words), [6, 3, 1], k=60)]
    dims = 1 << 12
    model = langid.fit(docs(spark, [t for t, _ in rows], lang=[x for _, x in rows]).repartition(4),
                       dims=dims)

    def grams(text):
        kept = re.sub(r"[^a-z\x80-\U0010ffff]+", " ", text.lower())
        for order in langid.ORDERS:
            for k in range(len(kept) - order + 1):
                g = kept[k:k + order]
                if order == 1 and g == " ":
                    continue
                h = order
                for c in g:
                    h = ((h ^ ord(c)) * 0x9E3779B1) & 0xFFFFFFFF
                    h ^= h >> 15
                yield h & (dims - 1)
    counts = {x: Counter() for x in words}
    for t, x in rows:
        counts[x].update(grams(t))
    n = Counter(x for _, x in rows)
    texts = ["the cat is in that", "une maison dans la ville", "ist das nicht zu viel", "x", "é 99 la"]
    got = langid.scores(model, texts)
    for t, p in zip(texts, got):
        s = {}
        for x in sorted(n):
            total = sum(counts[x].values()) + langid.SMOOTHING * dims
            s[x] = math.log(n[x] / len(rows)) + sum(
                math.log((counts[x][g] + langid.SMOOTHING) / total) for g in grams(t))
        top = max(s.values())
        z = sum(math.exp(v - top) for v in s.values())
        assert np.allclose(p, [math.exp(s[x] - top) / z for x in sorted(n)], atol=1e-4)


def test_very_many_labels_are_hashed_into_fewer_cells(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_ENTRIES", 1 << 12)
    names = [f"l{k:02d}" for k in range(9)]
    texts = [" ".join([chr(97 + k) * 3] * 20) for k in range(9)]
    model = langid.fit(docs(spark, texts, lang=names), dims=1 << 10)
    assert model.logp.shape == (256, 9)
    got = langid.predict(docs(spark, texts), model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.doc_id)] == names
    monkeypatch.setattr(langid, "MAX_ENTRIES", 1 << 11)
    with pytest.raises(ValueError):
        langid.fit(docs(spark, texts, lang=names), dims=1 << 10)
