"""Small tables and brute-force versions for the training-data tests."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names that operators use inside.
CLASHING = ("part", "fp", "key", "bucket", "block", "row", "c0", "mix_pass", "spans", "n")


def docs(spark, texts, ids=None, source=None, lang=None, clash=False):
    """A documents table; ids count from 0 unless given."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, (lang or ["en"] * len(texts))[k], (source or ["s0"] * len(texts))[k],
             None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
    df = spark.createDataFrame(rows, DOC_SCHEMA)
    if clash:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])
    return df


def prose(rng: random.Random, n: int) -> str:
    syllables = "the of and er on th re in is an or ti en wh ou st ing ed".split()
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def least_reachable(nodes, links):
    """Union-find: node -> least node reachable."""
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}
