import numpy as np
import pytest

from barpanel.llm import embed_dedup
from tests.llm.helpers import least_reachable

SCHEMA = "vec_id long, embedding array<float>, label int"


def clusters(seed=5, dim=64, n=160, groups=6, size=12, spread=0.03):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for g in range(groups):
        c = rng.standard_normal(dim)
        x[g * size:(g + 1) * size] = c + spread * (g + 1) * rng.standard_normal((size, dim))
    return x.astype(np.float32)


def brute(rows):
    """id -> (links, component) of sound vectors."""
    ids = [i for i, _ in rows]
    cos = {}
    links = []
    for a in range(len(rows)):
        for b in range(a):
            u, v = (np.array(rows[k][1], float) for k in (a, b))
            if len(u) == len(v) and u @ v / np.sqrt((u @ u) * (v @ v)) >= 0.9:
                links.append((ids[a], ids[b]))
    root = least_reachable(ids, links)
    for i in ids:
        cos[i] = (sum(i in e for e in links), root[i])
    return cos


@pytest.mark.parametrize("chunk", [embed_dedup.CHUNK, 5])
def test_links(spark, chunk):
    rows = [(i, [float(y) for y in x]) for i, x in enumerate(clusters())]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, [2 * y for y in rows[3][1]])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id)
           for r in embed_dedup.near_duplicates(df, chunk=chunk).collect()}
    assert got == brute(rows)


def test_defined_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.001]), (3, None), (4, []), (5, [0.0, 0.0]),
            (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 0.0, 0.0]),
            (None, [1.0, 0.0]), (10, [3.0]), (11, [-3.0]), (12, [5e-30]), (2, [1.0, 0.001])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = sorted((r.vec_id or -1, r.n_links, r.component_id or -1)
                 for r in embed_dedup.near_duplicates(df).collect())
    assert got == sorted([(1, 2, 1), (2, 2, 1), (2, 2, 1), (-1, 0, -1), (9, 0, 9), (10, 1, 10),
                          (11, 0, 11), (12, 1, 10)] + [(i, 0, i) for i in (3, 4, 5, 6, 7, 8)])


def test_recall_at_the_threshold():
    """Pairs of cosine 0.9 exactly meet in nearly every case."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal(x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(1 - 0.81) * z / np.linalg.norm(z, axis=1, keepdims=True)
    a, b = (embed_dedup.codes(v, embed_dedup.TABLES, embed_dedup.HASHES, embed_dedup.PROBES,
                              embed_dedup.SEED) for v in (x, y))
    met = (a == b[:, :, :1]).any((1, 2)) | (b == a[:, :, :1]).any((1, 2))
    assert met.mean() > 0.998


def test_rotation_keeps_length():
    x = np.random.default_rng(0).standard_normal((4, 32))
    assert np.allclose(np.linalg.norm(embed_dedup.hadamard(x), axis=1) / np.sqrt(32),
                       np.linalg.norm(x, axis=1))


def test_empty_table(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_double_vectors_and_many_dimensions(spark):
    """Double components, and dimensions whose codes need 64 bits."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(30):
        d = 1500 if i % 2 else 20
        rows.append((i, [float(x) for x in rng.standard_normal(d)]))
    rows += [(100, rows[1][1][:-1] + [0.5]), (101, rows[0][1][:-1] + [rows[0][1][-1] + 1e-9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id)
           for r in embed_dedup.near_duplicates(df).collect()}
    assert got == brute(rows) and got[100][1] == 1 and got[101][1] == 0
