"""State of a panel: batches of new bars give what a full recomputation gives."""

import re

import pytest
from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS
from barpanel.operators import features as FT
from barpanel.operators import live as L
from barpanel.plans.layout import PLAIN, SeriesLayout
from barpanel.sources import panel_io as IO


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def close(a, b):
    return (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9))


def batches(panel, *cuts):
    lo = None
    for hi in (*cuts, None):
        f = F.lit(True)
        if lo:
            f = f & (F.col("date") >= lo)
        if hi:
            f = f & (F.col("date") < hi)
        yield panel.filter(f)
        lo = hi


@pytest.fixture(scope="module")
def panel(daily01):
    return daily01.filter("date < '1997-01-01'").persist()


def test_features_of_batches_equal_the_whole(spark, panel):
    """Three batches; the last bar of each is settled by the next."""
    want = by_key(FT.compute_features(panel, PLAIN), "ticker", "date")
    store = L.LiveStore(spark, IO.scratch_path(spark, "test-live"))
    got = {}
    for b in batches(panel, "1996-03-01", "1996-03-02", "1996-11-01"):
        _, f = store.merge(b)
        for r in f.collect():
            k = (r["ticker"], r["date"])
            assert (k in got) == r["revised"]
            got[k] = r
    assert set(got) == set(want) and len(got) > 1000
    for k, r in got.items():
        assert all(close(r[c], want[k][c]) for c in FEATURE_COLS), k
        assert r["target"] == want[k]["target"], k


def test_windows_of_new_bars_equal_the_whole(spark, panel):
    window = 7
    hist, new = batches(panel, "1996-10-01")
    feats = FT.feature_frame(panel, PLAIN)
    scaler = FT.fit_minmax(FT.chrono_split(FT.feature_frame(hist, PLAIN)))
    whole = FT.apply_minmax(feats, scaler).withColumns({"split": F.lit("train")})
    lay = PLAIN
    whole = lay.positions(whole)
    want = by_key(FT.sliding_sequences(whole, lay, window), "ticker", "date")
    _, state = L.advance(L.empty_state(spark), hist, window=window)
    state = state.persist()
    features, _ = L.advance(state, new, window=window)
    got = by_key(L.live_windows(state, features, scaler, window), "ticker", "date")
    first_new = min(d for _, d in got)
    assert {k for k in want if k[1] >= first_new} >= set(got)
    new_keys = {(r["ticker"], r["date"]) for r in new.collect()}
    assert set(got) - {k for k, r in got.items() if r["revised"]} == {k for k in want if k in new_keys}
    for k, r in got.items():
        assert r["y"] == want[k]["y"]
        for a, b in zip(r["seq"], want[k]["seq"]):
            assert a == pytest.approx(b, rel=1e-5, abs=1e-6)


def test_history_is_not_read(spark, panel):
    """The plan of a batch scans the state and the batch, nothing else, and the
    state has one row of bounded size per ticker."""
    hist, new = batches(panel, "1996-10-01")
    path = IO.scratch_path(spark, "test-live-plan")
    store = L.LiveStore(spark, path)
    store.merge(hist)
    s = store.state()
    assert s.count() == panel.select("ticker").distinct().count()
    assert s.agg(F.max(F.size("tail")), F.max(F.size("open_window"))).first() == (50, 31)
    other = IO.scratch_path(spark, "test-batch")
    new.write.parquet(other)
    rows = L._rows(s, spark.read.parquet(other))
    assert {re.sub("^file:/*", "/", f.split("/gen=")[0].split("/part-")[0]) for f in rows.inputFiles()} <= {
        path.removeprefix("file:"), other.removeprefix("file:")}
    assert rows.filter(~F.col("_new")).count() <= 50 * s.count()


def test_old_bars_new_tickers_and_single_bars(spark, panel):
    hist, new = batches(panel, "1996-10-01")
    store = L.LiveStore(spark, IO.scratch_path(spark, "test-live-odd"))
    store.merge(hist.filter("ticker <> '5-LOW'"))
    before = by_key(store.state(), "ticker")
    # bars that have been merged come again; one ticker is new, with one bar
    again = hist.filter("ticker = '2-HIGH'").unionByName(
        hist.filter("ticker = '5-LOW'").orderBy("date").limit(1))
    _, f = store.merge(again)
    assert [r["ticker"] for r in f.collect()] == ["5-LOW"]
    after = by_key(store.state(), "ticker")
    assert after[("2-HIGH",)] == before[("2-HIGH",)] and ("5-LOW",) in after
    assert after[("5-LOW",)]["avg_gain"] is None
    _, f = store.merge(hist.filter("ticker = '5-LOW'"))
    got = by_key(f, "ticker", "date")
    want = by_key(FT.compute_features(hist.filter("ticker = '5-LOW'"), PLAIN), "ticker", "date")
    assert set(got) == set(want)
    assert all(close(got[k][c], want[k][c]) for k in got for c in FEATURE_COLS)
    _, f = store.merge(hist.limit(0))
    assert f.count() == 0


def test_first_state_under_the_blocked_layout(spark, panel):
    a = by_key(L.advance(L.empty_state(spark), panel)[1], "ticker")
    b = by_key(L.advance(L.empty_state(spark), panel, SeriesLayout(block_rows=60))[1], "ticker")
    assert set(a) == set(b)
    for k in a:
        assert a[k]["tail"] == b[k]["tail"] and a[k]["last_date"] == b[k]["last_date"]
        for s in ("avg_gain", "avg_loss", "ema_12", "ema_26", "macd_signal"):
            assert close(a[k][s], b[k][s])
        assert len(a[k]["open_window"]) == len(b[k]["open_window"]) == 31
