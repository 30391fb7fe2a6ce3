import random

import numpy as np

from barpanel.llm import toxicity
from tests.llm.helpers import docs, prose


def labelled(spark, rows):
    return spark.createDataFrame(
        [(i, t, y) for i, (t, y) in enumerate(rows)], "doc_id long, text string, toxic int")


def interactions(rng, n):
    """Toxic only if an insult and a group stand together: each alone is not."""
    out = []
    for _ in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        w = prose(rng, 12).split() + ["scum"] * insult + ["outsiders"] * group
        rng.shuffle(w)
        out.append((" ".join(w), int(insult and group)))
    return out


def test_learns_pairs():
    rng = random.Random(1)
    train, test = interactions(rng, 1500), interactions(rng, 400)
    rows = [toxicity.terms(t) for t, _ in train]
    m = toxicity.train(rows, np.array([y for _, y in train], float))
    found = [toxicity.terms(t) for t, _ in test]
    z = toxicity.logits(m, np.concatenate(found), np.array([len(x) for x in found]))
    y = np.array([y for _, y in test])
    p = 1 / (1 + np.exp(-z))
    assert ((p >= 0.3) == y).mean() > 0.97


def test_learns_exclusive_or_with_balanced_marginals():
    """Both words are equally frequent under both labels: only the pair tells."""
    def rows(rng, n):
        out = []
        for k in range(n):
            a, b = bool(k & 1), bool(k & 2)
            w = prose(rng, 12).split() + ["scum"] * a + ["outsiders"] * b
            rng.shuffle(w)
            out.append((" ".join(w), int(a != b)))
        return out
    rng = random.Random(1)
    train, test = rows(rng, 4000), rows(rng, 800)
    y = np.array([y for _, y in train], float)
    terms = [toxicity.terms(t) for t, _ in train]
    both = toxicity.terms("scum outsiders")
    assert (toxicity.confidence(terms, y, toxicity.DIMS)[both] < toxicity.LEAST_Z).all()
    m = toxicity.train(terms, y)
    found = [toxicity.terms(t) for t, _ in test]
    z = toxicity.logits(m, np.concatenate(found), np.array([len(x) for x in found]))
    assert ((z >= 0) == np.array([y for _, y in test])).mean() > 0.8


def test_pair_term_by_definition():
    rng = np.random.default_rng(0)
    m = toxicity.Model(0.5, rng.normal(size=16), rng.normal(size=(16, 3)))
    x = np.array([1, 4, 9, 11])
    want = 0.5 + m.w[x].sum() + sum(m.v[a] @ m.v[b] for a in x for b in x if a < b)
    got = toxicity.logits(m, np.r_[x, x], np.array([4, 0, 4]))
    assert np.allclose(got, [want, 0.5, want])


def test_defined_cases(spark):
    rng = random.Random(2)
    rows = [(prose(rng, 20) + (" idiot" if k % 4 == 0 else ""), int(k % 4 == 0))
            for k in range(200)] + [(None, 1), ("x", None)]
    model = toxicity.fit(labelled(spark, rows))
    texts = ["you idiot", "of the", None, "", "IDIOT " * 9000, "idiot"]
    got = {r.doc_id: r.score for r in toxicity.score(docs(spark, texts, clash=True), model).collect()}
    assert got[0] >= 0.3 > got[1] and got[2] == got[3] < 0.5 and got[4] == got[5] >= 0.3
    assert all(0 <= s <= 1 for s in got.values())
    assert toxicity.score(docs(spark, []), model).count() == 0
    assert toxicity.fit(labelled(spark, [("a", None)])) is None
    assert [r.score for r in toxicity.score(docs(spark, ["a"]), None).collect()] == [0.0]


def test_one_label_only(spark):
    model = toxicity.fit(labelled(spark, [("a b", 0), ("c d", 0)] * 5))
    assert [r.score < 0.3 for r in toxicity.score(docs(spark, ["a b"]), model).collect()] == [True]


def test_held_out_rows_of_the_tables(spark):
    from barpanel.llm.queries import QUERIES
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op9_toxicity"](spark, sf)
    y = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    held = got.filter("held_out").join(y, "doc_id").collect()
    toxic = [r for r in held if r.toxic == 1]
    clean = [r for r in held if r.toxic == 0]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert sum(r.predicted for r in clean) / len(clean) < 0.01
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_fit_equals_plain_loops():
    """The same descent, term by term and pair by pair."""
    rng = np.random.default_rng(5)
    k, rank, n = 7, 2, 30
    rows = [np.sort(rng.choice(k, rng.integers(0, 5), replace=False)) for _ in range(n)]
    y = rng.integers(0, 2, n).astype(float)
    step, step_v = rng.uniform(0, 1, k), rng.uniform(0, 1, k)
    got = toxicity._descend(rows, y, step, step_v, rank, 3, 0.3, 1e-4, 8, 7)
    g = np.random.default_rng(7)
    share = y.mean()
    w0, w, v = float(np.log(share / (1 - share))), np.zeros(k), g.normal(0, 0.01, (k, rank))
    gw, gv, g0 = np.full(k, 1e-6), np.full((k, rank), 1e-6), 1e-2
    for _ in range(3):
        order = g.permutation(n)
        for s in range(0, n, 8):
            pick = order[s:s + 8]
            e0, grad, grad_v, used = 0.0, np.zeros(k), np.zeros((k, rank)), set()
            for i in pick:
                z = w0 + sum(w[a] for a in rows[i]) + sum(
                    v[a] @ v[b] for a in rows[i] for b in rows[i] if a < b)
                e = (1 / (1 + np.exp(-z)) - y[i]) / len(pick)
                e0 += e
                for a in rows[i]:
                    used.add(a)
                    grad[a] += e
                    for b in rows[i]:
                        if a != b:
                            grad_v[a] += e * v[b]
            g0 += e0 * e0
            w0 -= 0.3 * e0 / np.sqrt(g0)
            for a in used:
                d, dv = grad[a] + 1e-4 * w[a], grad_v[a] + 1e-4 * v[a]
                gw[a] += d * d
                gv[a] += dv * dv
                w[a] -= 0.3 * step[a] * d / np.sqrt(gw[a])
                v[a] -= 0.03 * step_v[a] * dv / np.sqrt(gv[a])
    assert np.allclose(got.w, w) and np.allclose(got.v, v) and np.isclose(got.w0, w0)


def test_pair_confidence_by_definition():
    """Residuals against signed sums of partners, one term and bucket at a time."""
    rng = np.random.default_rng(6)
    k, n, buckets, hashings = 40, 400, 16, 2
    rows = [np.sort(rng.choice(k, 10, replace=False)) for _ in range(n)]
    r = rng.normal(0, 0.1, n) + np.array([0.8 * ((3 in x) and (5 in x)) for x in rows])
    known = np.ones(k, bool)
    got = toxicity.pair_confidence(rows, r, known, buckets, hashings, seed=1)
    g = np.random.default_rng(1)
    best = np.full(k, np.inf)
    for _ in range(hashings):
        bucket, sign = g.integers(0, buckets, k), g.choice([-1.0, 1.0], k)
        for t in range(k):
            zs = []
            for b in range(buckets):
                c = [(r[i], sum(sign[j] for j in rows[i] if bucket[j] == b and j != t))
                     for i in range(n) if t in rows[i]]
                den = sum((a * x) ** 2 for a, x in c)
                zs.append(abs(sum(a * x for a, x in c)) / np.sqrt(max(den, 1e-12)))
            best[t] = min(best[t], max(zs))
    chance = np.sqrt(2 * np.log(buckets * k ** (1 / hashings)))
    want = np.maximum(best - chance, 0)
    assert np.allclose(got, want, atol=1e-3)
    assert got[3] > 0 and got[5] > 0
