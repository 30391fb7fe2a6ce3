"""Split, scaling and sequences: sizes, leakage, window semantics."""

import pytest
from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS
from barpanel.operators import features as FT
from barpanel.plans.layout import PLAIN, blocked


@pytest.fixture(scope="module")
def stages(daily01):
    return FT.prepare_panel(daily01, PLAIN, window=30)


def test_split_sizes_truncate(stages):
    rep = FT.split_bounds(stages["split"]).collect()
    by = {}
    for r in rep:
        by.setdefault(r["ticker"], {})[r["split"]] = r["n_rows"]
    for t, s in by.items():
        n = sum(s.values())
        assert s["test"] == n * 15 // 100 and s["val"] == n * 15 // 100


def test_fixture_counts(stages):
    got = {(r["ticker"], r["split"]): r["n_seq"] for r in FT.sequence_report(stages["sequences"]).collect()}
    assert got[("1-URGENT", "train")] == 1150 and got[("1-URGENT", "val")] == 222
    assert got[("3-MEDIUM", "test")] == 219


def test_no_leakage(stages):
    FT.assert_no_leakage(stages["split"])


def test_leakage_check_fails_on_tiny_series(spark):
    df = spark.createDataFrame([("T", i, "train") for i in range(5)], "ticker string, date int, split string")
    assert FT.leakage_check(df).first()["ok"] is False


def test_train_scaled_to_unit_range(stages):
    tr = stages["scaled"].filter(F.col("split") == "train")
    row = tr.agg(*[F.min(c).alias(f"lo_{c}") for c in FEATURE_COLS],
                 *[F.max(c).alias(f"hi_{c}") for c in FEATURE_COLS]).first()
    for c in FEATURE_COLS:
        assert row[f"lo_{c}"] == pytest.approx(0.0, abs=1e-12)
        assert row[f"hi_{c}"] == pytest.approx(1.0, abs=1e-12)


def test_constant_feature_scales_by_one(spark):
    from barpanel.operators.features import apply_minmax
    df = spark.createDataFrame([("T", 5.0), ("T", 7.0)], "ticker string, x double")
    p = spark.createDataFrame([("T", 5.0, 5.0)], "ticker string, min_x double, max_x double")
    got = sorted(r["x"] for r in apply_minmax(df, p, cols=["x"]).collect())
    assert got == [0.0, 2.0]


def test_sequences_are_previous_rows_of_same_split(stages):
    sc = stages["scaled"].filter(F.col("ticker") == "2-HIGH").orderBy("date").toPandas()
    sq = stages["sequences"].filter(F.col("ticker") == "2-HIGH").toPandas().set_index("date")
    val = sc[sc.split == "val"].reset_index(drop=True)
    i = 40
    d = val.loc[i, "date"]
    seq = sq.loc[d, "seq"]
    assert len(seq) == 30 and len(seq[0]) == 18
    assert seq[-1][3] == pytest.approx(val.loc[i - 1, "close"], rel=1e-6)
    assert seq[0][3] == pytest.approx(val.loc[i - 30, "close"], rel=1e-6)
    assert sq.loc[d, "y"] == val.loc[i, "target"]
    assert val.loc[29, "date"] not in sq.index   # fewer than 30 rows before it in val


def test_blocked_sequences_equal_plain(daily01):
    a = FT.prepare_panel(daily01, PLAIN)["sequences"]
    b = FT.prepare_panel(daily01, blocked(256))["sequences"]
    key = ["ticker", "split", "date"]
    pa = a.select(*key, F.flatten("seq").alias("f"), "y").toPandas().sort_values(key).reset_index(drop=True)
    pb = b.select(*key, F.flatten("seq").alias("f"), "y").toPandas().sort_values(key).reset_index(drop=True)
    assert len(pa) == len(pb)
    assert (pa["y"] == pb["y"]).all()
    assert all(list(x) == list(y) for x, y in zip(pa["f"], pb["f"]))


def test_auto_layout_scales_its_ranges(daily01):
    """Small series stay plain; large ones get blocks, and as many range
    partitions as the panel has blocks."""
    from barpanel.plans.layout import AutoLayout
    n = daily01.count()
    assert not AutoLayout().resolve(daily01).blocked
    lay = AutoLayout(block_rows=100).resolve(daily01)
    assert lay.blocked and lay.ranges == -(-n // 100)
    d = lay.with_halo(3, 1).prepare(daily01)
    got = lay.finish(d).orderBy("ticker", "date").collect()
    assert len(got) == n
    at = {}
    for r in got:
        assert r["_rn"] == at.get(r.ticker, 0)
        at[r.ticker] = at.get(r.ticker, 0) + 1
