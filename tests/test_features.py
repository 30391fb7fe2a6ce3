"""Feature windows against plain recurrences over lists; blocked layout
against plain."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS
from barpanel.operators import features as FT
from barpanel.operators.ewm import alpha_from, ewm_columns, sub_blocks
from barpanel.plans.layout import PLAIN, SeriesLayout, blocked


def smoothed(xs, alpha):
    """y0 = x0, then y = (1 - alpha) y + alpha x; None is skipped."""
    out, y = [], None
    for x in xs:
        if x is not None:
            y = x if y is None else (1 - alpha) * y + alpha * x
        out.append(y)
    return out


def expected_row(close, volume, t):
    """The features of day ``t`` by their formulas, from the series up to t."""
    past = close[:t + 1]
    row = {"log_return": math.log(close[t] / close[t - 1]) if t else None}
    for n in (10, 20, 50):
        row[f"sma_{n}"] = sum(past[-n:]) / n if t + 1 >= n else None
    up, down = [None], [None]
    for a, b in zip(past, past[1:]):
        up.append(max(b - a, 0.0))
        down.append(max(a - b, 0.0))
    gain, loss = smoothed(up, 1 / 14)[-1], smoothed(down, 1 / 14)[-1]
    row["rsi_14"] = 100 - 100 / (1 + gain / loss) if loss else None
    line = [f - s for f, s in zip(smoothed(past, 2 / 13), smoothed(past, 2 / 27))]
    row["macd"], row["macd_signal"] = line[-1], smoothed(line, 2 / 10)[-1]
    if t >= 20:
        r = [math.log(close[k] / close[k - 1]) for k in range(t - 19, t + 1)]
        m = sum(r) / 20
        row["volatility_20"] = math.sqrt(sum((x - m) ** 2 for x in r) / 19 * 252)
    else:
        row["volatility_20"] = None
    recent = volume[max(0, t - 19):t + 1]
    row["volume_norm"] = volume[t] / (sum(recent) / 20) if t >= 19 else None
    row["target"] = int(t + 1 < len(close) and close[t + 1] > close[t])
    return row


def _close(a, b, rel=1e-8):
    a, b = np.asarray(a, float), np.asarray(b, float)
    assert (np.isnan(a) == np.isnan(b)).all()
    m = ~np.isnan(a)
    assert np.allclose(a[m], b[m], rtol=rel, atol=1e-6)


def test_features_match_the_formulas(daily01):
    rows = FT.compute_features(daily01, PLAIN).collect()
    bars = {}
    for r in daily01.orderBy("ticker", "date").collect():
        bars.setdefault(r.ticker, []).append(r)
    got = {(r.ticker, r.date): r for r in rows}
    assert len(got) == sum(map(len, bars.values()))
    for ticker, series in bars.items():
        close, volume = [r.close for r in series], [r.volume for r in series]
        for t in [0, 1, 13, 18, 19, 20, 48, 49, 50, 333, len(series) - 2, len(series) - 1]:
            row = got[ticker, series[t].date]
            for name, want in expected_row(close, volume, t).items():
                if want is None:
                    assert row[name] is None, (name, t)
                else:
                    assert row[name] == pytest.approx(want, rel=1e-8, abs=1e-7), (name, t)


def test_hand_worked_rows(spark):
    """Closes 100, 110, 99: returns, smoothed gain and loss by hand."""
    df = spark.createDataFrame(
        [("T", d, c, c, c, c, 10) for d, c in enumerate((100.0, 110.0, 99.0))],
        "ticker string, date int, open double, high double, low double, close double, volume long")
    a, b, c = FT.compute_features(df, PLAIN).orderBy("date").collect()
    assert (a.log_return, a.rsi_14, a.target) == (None, None, 1)
    assert b.log_return == pytest.approx(0.0953101798) and b.rsi_14 is None and b.target == 0
    # gain 10 * 13/14 = 9.285714, loss 11/14 = 0.785714
    assert c.rsi_14 == pytest.approx(100 - 100 / (1 + 9.2857142857 / 0.7857142857))
    # 12-day: 100, 101.538462, 101.147929; 26-day: 100, 100.740741, 100.611797
    assert c.macd == pytest.approx(101.1479289941 - 100.6117969822)


def test_warmup_49_rows(daily01):
    rep = FT.warmup_report(daily01, PLAIN).collect()
    assert all(r["n_dropped"] == 49 for r in rep)


def test_blocked_equals_plain(daily01):
    cols = ["ticker", "date"] + FEATURE_COLS + ["target"]
    a = FT.compute_features(daily01, PLAIN).select(cols).toPandas().sort_values(["ticker", "date"])
    b = FT.compute_features(daily01, blocked(300)).select(cols).toPandas().sort_values(["ticker", "date"])
    assert len(a) == len(b)
    for c in FEATURE_COLS + ["target"]:
        _close(a[c].values, b[c].values, rel=1e-12)


def gappy(spark, n=2500):
    """A series with a long run of nulls, a leading gap and scattered ones."""
    xs = [None if i < 7 or 600 < i < 1700 or i % 11 == 3 else math.sin(i) * 10 + 20
          for i in range(n)]
    df = spark.createDataFrame([("G", i, x) for i, x in enumerate(xs)],
                               "ticker string, date int, x double")
    return df, xs


@pytest.mark.parametrize("block_rows", [None, 64, 700])
def test_ewm_over_long_gaps(spark, block_rows):
    """Both layouts give the recurrence's values, also past a run of nulls
    that is longer than blocks."""
    df, xs = gappy(spark)
    specs = {f"e{k}": ("x", a) for k, a in enumerate((0.002, 2 / 27, 0.2, 0.9, 0.99))}
    if block_rows is None:
        got = ewm_columns(df, PLAIN, specs)
    else:
        lay = SeriesLayout(block_rows=block_rows).with_halo(2, 1)
        got = lay.finish(ewm_columns(lay.prepare(df), lay, specs), keep_ordinal=False)
    rows = got.orderBy("date").collect()
    for name, (_, alpha) in specs.items():
        _close([r[name] for r in rows], smoothed(xs, alpha), rel=1e-11)


def test_sub_blocks_forget_what_they_inherit():
    for S, alphas in sub_blocks([0.001, 0.07, 0.2, 0.9, 0.999999]):
        for a in alphas:
            assert 37 <= S * -math.log1p(-a) <= 500


def test_ewm_of_volume(daily01):
    got = ewm_columns(daily01, PLAIN, {"e": ("volume", alpha_from(com=13))})
    rows = got.filter("ticker = '2-HIGH'").orderBy("date").collect()
    _close([r.e for r in rows], smoothed([float(r.volume) for r in rows], 1 / 14), rel=1e-9)


def test_causality(daily):
    """Features at t do not change when rows after t change."""
    cut = daily.agg(F.expr("percentile_disc(0.6) within group (order by unix_date(date))")).first()[0]
    cut = F.date_from_unix_date(F.lit(int(cut)))
    changed = daily.withColumn("close", F.when(F.col("date") > cut, F.col("close") * 3)
                               .otherwise(F.col("close")))
    cols = [c for c in FEATURE_COLS]
    a = FT.compute_features(daily, PLAIN).filter(F.col("date") <= cut).select("ticker", "date", *cols)
    b = FT.compute_features(changed, PLAIN).filter(F.col("date") <= cut).select("ticker", "date", *cols)
    pa = a.toPandas().sort_values(["ticker", "date"])
    pb = b.toPandas().sort_values(["ticker", "date"])
    for c in cols:
        _close(pa[c].values, pb[c].values, rel=1e-12)


def test_never_rising_series_loses_all_rows(spark):
    rows = [("UP", f"2020-01-{d:02d}", 1.0, 1.0, 1.0, float(d), 10) for d in range(1, 31)]
    rows += [("UP", f"2020-02-{d:02d}", 1.0, 1.0, 1.0, float(30 + d), 10) for d in range(1, 29)]
    df = spark.createDataFrame(rows, "ticker string, date string, open double, high double, "
                                     "low double, close double, volume long")
    df = df.withColumn("date", F.to_date("date"))
    f = FT.compute_features(df, PLAIN)
    assert f.filter(F.col("rsi_14").isNotNull()).count() == 0
    assert FT.complete(f).count() == 0


def test_prefix_states_equal_a_fold(spark):
    """Affine maps of blocks with 0, few and very many observations."""
    from barpanel.operators.ewm import prefix_states
    rng = np.random.default_rng(3)
    rows = []
    for part in range(3):
        for i in range(400):
            d = int(rng.choice([0, 0, 1, 3, 64, 5000, 10 ** 7]))
            rows.append((part, i, d, float(rng.normal(50, 30)) if d else 0.0))
    decay = {"slow": 1e-4, "mid": 0.07, "fast": 4.6}
    df = spark.createDataFrame(rows, "p int, i int, d long, l double").select(
        "p", "i", *[F.col("d").alias(f"_obs_{n}") for n in decay],
        *[F.col("l").alias(f"_end_{n}") for n in decay])
    got = {(r.p, r.i): r for r in prefix_states(df, ["p"], "i", decay).collect()}
    for name, la in decay.items():
        for part in range(3):
            state, seen = 0.0, 0
            for p, i, d, x in rows:
                if p == part:
                    r = got[p, i]
                    assert r[f"_state_{name}"] == pytest.approx(state, rel=1e-9, abs=1e-12)
                    assert r[f"_before_{name}"] == seen
                    state, seen = state * math.exp(-la * d) + x, seen + d
                    assert r[f"_y_{name}"] == pytest.approx(state, rel=1e-9, abs=1e-12)


def test_states_over_several_superblocks(spark, monkeypatch):
    """Superblocks of four blocks, runs of nulls longer than superblocks."""
    from barpanel.operators import ewm
    monkeypatch.setattr(ewm, "SUPER_BLOCKS", 4)
    df, xs = gappy(spark)
    lay = SeriesLayout(block_rows=64).with_halo(2, 1)
    specs = {f"e{k}": ("x", a) for k, a in enumerate((0.002, 0.2, 0.99))}
    rows = lay.finish(ewm_columns(lay.prepare(df), lay, specs), keep_ordinal=False).orderBy(
        "date").collect()
    for name, (_, alpha) in specs.items():
        _close([r[name] for r in rows], smoothed(xs, alpha), rel=1e-11)


def test_blocked_ewm_is_linear_in_blocks(spark):
    """Eight times the blocks take nowhere near 64 times as long."""
    import time
    took = []
    for n in (20_000, 20_000, 160_000):  # the first pays for compilation
        df = spark.range(n).select(F.lit("G").alias("ticker"), F.col("id").cast("int").alias("date"),
                                   F.when(F.col("id") % 9000 < 5000, F.sin("id")).alias("x"))
        lay = SeriesLayout(block_rows=64)
        t = time.perf_counter()
        got = lay.finish(ewm_columns(lay.prepare(df), lay, {"e": ("x", 0.07)}), keep_ordinal=False)
        assert got.agg(F.count("e"), F.sum("e")).first()[0] == n
        took.append(time.perf_counter() - t)
    assert took[2] < 20 * took[1]
