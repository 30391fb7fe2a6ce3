"""Cleaning rules on small hand-worked tables, incl. fill-before-sort and the
blocked scan."""

import pytest
from pyspark.sql import functions as F

from barpanel.constants import OHLC
from barpanel.operators import quality as QL
from barpanel.plans.layout import PLAIN, SeriesLayout
from barpanel.sources import panel_io as IO
from barpanel.sources.fixtures import panel_dirty, requested_tickers

SF01 = "/root/testdata/sf0.01"
SCHEMA = ("ticker string, seq long, date int, open double, high double, low double, "
          "close double, volume double")
N = None
NAN = float("nan")

# Rows in ingest order: a leading gap in open, an all-null row, an inner gap, a
# second copy of day 2 and a late row for day 1.
RAW = [("A", 1, 2, N, 5.0, 1.0, 3.0, 10.0),
       ("A", 2, 3, N, 6.0, NAN, 4.0, N),
       ("A", 3, 4, N, NAN, N, N, 7.0),
       ("A", 4, 2, 9.0, 9.0, 9.0, 9.0, 1.0),
       ("A", 5, 1, 2.0, N, 2.0, N, 2.9),
       ("B", 1, 1, N, 1.0, 1.0, 1.0, 1.0),
       ("B", 2, 2, N, 1.0, 1.0, 2.0, 1.0)]
# What the rules leave, by hand.
CLEAN = [("A", 1, 2.0, 9.0, 2.0, 9.0, 2),     # high and close carried from seq 4
         ("A", 2, 9.0, 5.0, 1.0, 3.0, 10),    # open from the next known row
         ("A", 3, 9.0, 6.0, 1.0, 4.0, 0),     # low carried, volume 0
         ("B", 1, N, 1.0, 1.0, 1.0, 1),       # never an open: stays missing
         ("B", 2, N, 1.0, 1.0, 2.0, 1)]


@pytest.fixture(scope="module")
def raw(spark):
    return IO.nan_to_null(spark.createDataFrame(RAW, SCHEMA))


@pytest.fixture(scope="module")
def dirty(spark):
    return panel_dirty(spark, SF01).persist()


@pytest.mark.parametrize("layout", [PLAIN, SeriesLayout(order=("seq",), block_rows=2)])
def test_clean_by_hand(raw, layout):
    got = QL.clean_panel(raw, layout).orderBy("ticker", "date").collect()
    assert [(r.ticker, r.date, r.open, r.high, r.low, r.close, r.volume) for r in got] == CLEAN


@pytest.mark.parametrize("layout", [PLAIN, SeriesLayout(order=("seq",), block_rows=3)])
def test_fills_by_hand(spark, layout):
    xs = [N, N, 1.0, N, N, N, N, 2.0, N, 3.0, N, N]
    df = spark.createDataFrame([("T", i, x) for i, x in enumerate(xs)],
                               "ticker string, seq long, close double")
    f = QL.forward_fill(df, ["close"], layout).orderBy("seq").collect()
    assert [r.close for r in f] == [N, N, 1, 1, 1, 1, 1, 2, 2, 3, 3, 3]
    b = QL.backward_fill(df, ["close"], layout).orderBy("seq").collect()
    assert [r.close for r in b] == [1, 1, 1, 2, 2, 2, 2, 2, 3, 3, N, N]


def test_fills_are_linear(spark):
    """A long series: the growing frames take seconds, not hours."""
    df = spark.range(400_000).select(
        F.lit("T").alias("ticker"), F.col("id").alias("seq"),
        F.when(F.col("id") > 399_000, F.col("id").cast("double")).alias("close"))
    got = QL.backward_fill(QL.forward_fill(df, ["close"]), ["close"])
    assert got.filter("close = 399001").count() == 399_002


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([("T", 1.0, NAN), ("T", NAN, N)], "ticker string, a double, b float")
    r = QL.null_rates(IO.nan_to_null(df), cols=["a", "b"]).first()
    assert (r.null_a, r.null_b) == (0.5, 1.0)


def test_fixture_counts(dirty):
    assert dirty.count() == 8908
    assert QL.clean_panel(dirty).count() == 8356
    # every series begins with a gap that only the backward fill closes
    d = QL.forward_fill(QL.drop_all_null_prices(dirty))
    assert d.filter("low IS NULL").select("ticker").distinct().count() == 5
    assert QL.backward_fill(d).filter("low IS NULL").count() == 0


def test_ingest_order_is_date_then_revision(dirty):
    rows = dirty.filter("ticker = '2-HIGH'").orderBy("date", "rev").collect()
    assert [r.seq for r in rows] == list(range(1, len(rows) + 1))


def test_gate(spark, dirty):
    got = {r.ticker: (r.ok, r.n_rows) for r in QL.validate_gate(
        dirty, requested=requested_tickers(spark, SF01)).collect()}
    assert got["9.ABSENT"] == (False, 0)
    assert not got["5-LOW"][0] and sum(ok for ok, _ in got.values()) == 4


def test_gate_rate_exactly_at_limit_passes(spark):
    rows = [("T", float(i), 1.0, 1.0, 1.0, 1.0) for i in range(19)] + [("T", 19.0, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "ticker string, seq double, open double, high double, low double, close double")
    df = df.withColumn("volume", F.lit(1.0))
    assert QL.validate_gate(df).first()["ok"] is True


def test_blocked_fill_equals_plain(dirty):
    """Also with an ingest order that is not the dates' order."""
    for d in (dirty, dirty.withColumn("seq", F.xxhash64("ticker", "date", "rev"))):
        lay = SeriesLayout(order=("seq",), block_rows=64)
        cols = ["ticker", "date", *OHLC, "volume"]
        a = {tuple(r) for r in QL.clean_panel(d, PLAIN).select(*cols).collect()}
        b = {tuple(r) for r in QL.clean_panel(d, lay).select(*cols).collect()}
        assert a == b and len(a) == 8356
