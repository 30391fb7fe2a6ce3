"""Panel stores: keys are replaced one by one, whole or not at all."""

import hashlib
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from barpanel.sources import panel_io as IO
from barpanel.sources.store import PanelStore


def frame(spark, rows):
    return spark.createDataFrame(rows, "ticker string, split string, x double")


def rows(df):
    return sorted((r["ticker"], r["split"], r["x"]) for r in df.collect())


def local(path):
    return path.removeprefix("file:")


def digests(store, ticker):
    out = {}
    for key, folder in store.live().items():
        if key[0] == ticker:
            for f in sorted(os.listdir(local(folder))):
                with open(f"{local(folder)}/{f}", "rb") as g:
                    out[key, f] = hashlib.sha256(g.read()).hexdigest()
    return out


@pytest.fixture
def store(spark):
    return PanelStore(spark, IO.scratch_path(spark, "test-store"), ("ticker", "split"))


def test_rewriting_one_leaves_the_others_byte_for_byte(spark, store):
    store.write(frame(spark, [("A", "train", 1.0), ("A", "test", 2.0), ("B", "train", 3.0)]))
    before = digests(store, "B")
    store.write(frame(spark, [("A", "train", 10.0)]))
    assert rows(store.read()) == [("A", "test", 2.0), ("A", "train", 10.0), ("B", "train", 3.0)]
    assert digests(store, "B") == before and before
    assert rows(store.read(ticker="B")) == [("B", "train", 3.0)]
    assert rows(store.read(ticker=["A", "B"], split="train")) == [
        ("A", "train", 10.0), ("B", "train", 3.0)]


def test_failed_write_leaves_the_store_as_it_was(spark, store):
    store.write(frame(spark, [("A", "train", 1.0), ("B", "train", 2.0)]))
    before = store.live()
    bad = frame(spark, [("A", "train", float(i)) for i in range(100)]).withColumn(
        "x", F.lit(1.0) / F.when(F.col("x") > 98, 0).otherwise(1))
    with pytest.raises(Exception, match="(?i)zero"):
        store.write(bad)
    assert store.live() == before and rows(store.read()) == [("A", "train", 1.0), ("B", "train", 2.0)]
    assert [x for x in os.listdir(local(store.path)) if x.startswith("gen=")] == [
        before[("A", "train")].split("/")[-3]]


def test_unpublished_generation_is_not_read(spark, store, monkeypatch):
    """A driver that dies between the writing and the publication."""
    store.write(frame(spark, [("A", "train", 1.0)]))
    monkeypatch.setattr(PanelStore, "_publish", lambda *a: (_ for _ in ()).throw(SystemExit))
    monkeypatch.setattr(store._fs.__class__, "delete", lambda *a: None, raising=False)
    with pytest.raises(SystemExit):
        store.write(frame(spark, [("A", "train", 5.0)]))
    assert rows(store.read()) == [("A", "train", 1.0)]


def test_plan_made_before_a_replacement_still_reads(spark, store):
    store.write(frame(spark, [("A", "train", 1.0), ("A", "test", 2.0)]))
    old = store.read()
    store.write(frame(spark, [("A", "train", 9.0), ("A", "test", 8.0)]))
    assert rows(old) == [("A", "test", 2.0), ("A", "train", 1.0)]  # all old
    assert rows(store.read()) == [("A", "test", 8.0), ("A", "train", 9.0)]  # all new


def test_vacuum_takes_only_what_no_longer_counts(spark, store):
    for k in range(3):
        store.write(frame(spark, [("A", "train", float(k)), ("B", "train", 7.0)][:2 - k % 2]))
    os.makedirs(f"{local(store.path)}/gen=wdead/ticker=A/split=train")
    want = rows(store.read())
    assert store.vacuum(hours=24) == 3  # of A twice, of B once; the young stray stays
    assert os.path.exists(f"{local(store.path)}/gen=wdead")
    assert store.vacuum(hours=-1) == 1 and rows(store.read()) == want


def test_writers_of_different_tickers_do_not_disturb_each_other(spark, store):
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda t: store.write(frame(spark, [(t, "train", 1.0)] * 5)), "ABCD"))
    assert [r[0] for r in rows(store.read())] == sorted("ABCD" * 5)


def test_key_values_keep_their_type_and_signs(spark, store):
    odd = ["000123", "1e5", "BRK.B", "A/B", "x=y", "sp ace", "100%", "ü"]
    store.write(frame(spark, [(t, "train", 1.0) for t in odd]))
    assert sorted(r[0] for r in rows(store.read())) == sorted(odd)
    for t in odd:
        assert rows(store.read(ticker=t)) == [(t, "train", 1.0)]


def test_empty_and_absent(spark, store):
    assert store.read() is None and store.live() == {}
    store.write(frame(spark, []))
    assert store.read().count() == 0
    with pytest.raises(ValueError):
        store.write(spark.range(1))
    with pytest.raises(IO.MissingDataError):
        IO.read_panel(spark, IO.scratch_path(spark, "test-none"))


def test_csv_rewrite_keeps_text(spark):
    path = IO.scratch_path(spark, "test-csv")
    df = frame(spark, [("A", "train", 1.0), ("B", "train", 2.5)])
    IO.write_panel_csv(df, path, 6, ["x"])
    IO.write_panel_csv(df.filter("ticker = 'A'").withColumn("x", F.lit(3.0)), path, 6, ["x"])
    assert rows(IO.read_panel_csv(spark, path)) == [("A", "train", "3.000000"),
                                                    ("B", "train", "2.500000")]


# -- the run log -----------------------------------------------------------------

def test_run_written_twice_stands_once(spark):
    from barpanel.operators import models as ML
    path = IO.scratch_path(spark, "test-runs")
    rows = lambda **p: ML.run_log_rows("r", "train", p, spark=spark)
    assert ML.read_runs(spark, path).count() == 0
    ML.append_runs(rows(a=1, b=2), path, "x")
    ML.append_runs(rows(a=3), path, "x")  # the retry of a run that was cut off
    ML.append_runs(rows(a=1), path, "y")
    assert sorted((r.run_id, r.key, r.value) for r in ML.read_runs(spark, path).collect()) == [
        ("x", "param.a", 3.0), ("y", "param.a", 1.0)]
    ids = {ML.append_runs(rows(a=1), path), ML.append_runs(rows(a=1), path)}
    assert len(ids) == 2 and ML.read_runs(spark, path).count() == 4
    assert ML.read_runs(spark, path, "y").count() == 1


def test_runs_of_concurrent_writers_are_all_there(spark):
    from barpanel.operators import models as ML
    path = IO.scratch_path(spark, "test-runs")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: ML.append_runs(
            ML.run_log_rows("r", "train", {"k": k}, spark=spark), path, f"run-{k % 4}"), range(8)))
    assert sorted(r.run_id for r in ML.read_runs(spark, path).collect()) == [
        f"run-{k}" for k in range(4)]


# -- time stamps, missing columns, the manifest ------------------------------------

STAMPS = {
    "2024-03-10 06:30:00Z": "2024-03-10 06:30:00", "2024-03-10T01:30:00-05:00": "2024-03-10 06:30:00",
    "2024-03-10 12:00:00+0530": "2024-03-10 06:30:00", "2024-03-10 07:30:00 +01": "2024-03-10 06:30:00",
    "2024-03-10 06:30": "2024-03-10 06:30:00", "2024-03-10": "2024-03-10 00:00:00",
    # New York: winter, summer, the day the clocks change
    "2024-01-15 09:30:00 America/New_York": "2024-01-15 14:30:00",
    "2024-07-15 09:30:00[America/New_York]": "2024-07-15 13:30:00",
    "2024-03-10 01:59:59 America/New_York": "2024-03-10 06:59:59",
    "2024-03-10 03:00:00 America/New_York": "2024-03-10 07:00:00",
    "2024-12-31 23:30:00.123456-01:00": "2025-01-01 00:30:00.123456",
    "2024-12-31 23:30:00.123456789Z": "2024-12-31 23:30:00.123456",
    "1969-12-31 23:59:59.5Z": "1969-12-31 23:59:59.5",
    "2024-13-01 00:00:00Z": None, "soon": None, "": None, None: None}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_stamps_do_not_depend_on_the_session_zone(spark, zone):
    df = spark.createDataFrame([(k, v) for k, v in STAMPS.items()], "t string, want string")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = df.select("t", "want", IO.utc_naive(df, "t").cast("string").alias("got")).collect()
        assert [(r.t, r.got) for r in got] == [(r.t, r.want) for r in got]
        # instants, also one that falls into an hour that clocks repeat
        micros = [0, 1710052200123456, 1699165800000000, 1699162200000000, -1]
        inst = spark.createDataFrame([(m,) for m in micros], "m long").select(
            "m", F.timestamp_micros("m").alias("ts"))
        out = inst.select("m", IO.utc_naive(inst, "ts").cast("string").alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [r.s for r in out] == ["1970-01-01 00:00:00", "2024-03-10 06:30:00.123456",
                                  "2023-11-05 06:30:00", "2023-11-05 05:30:00",
                                  "1969-12-31 23:59:59.999999"]


def test_source_lacking_a_column_fails_and_the_others_go_on(spark):
    from barpanel.operators import quality as QL
    cols = "date date, open double, High double, low double, close double, volume double"
    a = spark.sql("select date'2024-01-02' date, 1d open, 2d High, 1d low, float('nan') close, 5d volume "
                  "union all select date'2024-01-03', 1d, 2d, 1d, 2d, 5d")
    frames = {"A": a, "B": a.drop("close", "volume"), "C": spark.createDataFrame([], cols)}
    raw, sources = IO.collect_sources(frames)
    assert {r.ticker: r.missing for r in sources.collect()} == {
        "A": [], "B": ["close", "volume"], "C": []}
    assert raw.filter("close is null").count() == 1 and {r.ticker for r in raw.collect()} == {"A"}
    gate = QL.validate_gate(raw, max_rate=0.5, requested=sources)
    m = IO.collection_manifest(gate, raw, "2024-01-31T00:00:00+00:00", {"x": 1}, sources=sources)
    assert {r.ticker: r.status for r in m.collect()} == {"A": "OK", "B": "FAILED", "C": "FAILED"}
    only_bad, s2 = IO.collect_sources({"B": a.drop("close")})
    assert only_bad.count() == 0 and s2.first().missing == ["close"]


def test_manifest_file_is_published_whole(spark):
    import json
    m = spark.createDataFrame(
        [('A"é', "OK", 3, "2024-01-02", "2024-01-04", "t", '{"tickers":["A"]}'),
         ("B", "FAILED", None, None, None, "t", '{"tickers":["A"]}')],
        "ticker string, status string, rows long, start string, end string, collected_at string, "
        "parameters string")
    path = f"{IO.scratch_path(spark, 'test-manifest')}/meta.json"
    for _ in range(2):  # the second replaces the first
        IO.publish_manifest(m, path)
    with open(local(path), encoding="utf-8") as f:
        got = json.load(f)
    assert got == {"collected_at": "t", "parameters": {"tickers": ["A"]}, "tickers": ['A"é', "B"],
                   "results": {'A"é': {"status": "OK", "rows": 3, "start": "2024-01-02",
                                       "end": "2024-01-04"}, "B": {"status": "FAILED"}}}
    assert [x for x in os.listdir(os.path.dirname(local(path))) if not x.startswith(".")] == ["meta.json"]
