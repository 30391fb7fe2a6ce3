"""Panel scans and sinks.

Stored panels are partitioned by ``ticker`` (and ``split`` for the processed data
and the sequence tensors) in a ``PanelStore``: a ticker / split filter opens
only its folders, the date range is pushed into the Parquet scan, and a write
replaces the tickers that it holds and no others.
Scratch output goes under the shared ``spark.checkpoint.dir``, never to a
machine-local folder.
"""

from __future__ import annotations

import atexit
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barpanel.constants import OHLC, OHLCV
from barpanel.session import ensure_checkpoint_dir
from barpanel.sources.store import PanelStore


class MissingColumnsError(ValueError):
    pass


class MissingDataError(FileNotFoundError):
    pass


_scratch: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory; removed when the
    driver ends, since lazy results may read it until then."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if not _scratch:
        atexit.register(_remove_scratch)
    _scratch.append((spark, path))
    return path


def _remove_scratch() -> None:
    for spark, path in _scratch:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may have ended already
            return


def nan_to_null(df: DataFrame) -> DataFrame:
    """Ingest rule: NaN is a missing value. Every float column of a panel that
    enters the library passes here, so that null rates, fills, windows and
    targets see NULL."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in floats}) if floats else df


def scan_panel(df: DataFrame, tickers=None, start=None, end=None,
               key: str = "ticker", date: str = "date") -> DataFrame:
    """Rows of the chosen tickers in [start, end) (end exclusive)."""
    cond: Column = F.lit(True)
    if tickers is not None:
        cond = cond & F.col(key).isin(list(tickers))
    if start is not None:
        cond = cond & (F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (F.col(date) < F.lit(end).cast("date"))
    return df.filter(cond)


def read_panel(spark: SparkSession, path: str, tickers=None, start=None, end=None) -> DataFrame:
    """S1 over a stored panel: only the chosen tickers' folders are opened, the
    date range is pushed down."""
    df = PanelStore(spark, path).read(ticker=tickers)
    if df is None:
        raise MissingDataError(f"no panel stored at {path}")
    return nan_to_null(scan_panel(df, tickers, start, end))


def missing_columns(df: DataFrame, cols=OHLCV) -> list[str]:
    """Which of the price columns a frame lacks, whatever their case."""
    have = {c.lower() for c in df.columns}
    return [c for c in cols if c.lower() not in have]


def require_columns(df: DataFrame, cols=OHLCV) -> DataFrame:
    """Project the price columns; raise listing the missing ones."""
    missing = missing_columns(df, cols)
    if missing:
        raise MissingColumnsError(f"missing columns: {missing}")
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(have[c.lower()]).alias(c) for c in cols])


def collect_sources(frames: dict, cols=OHLCV, keep=("date",), key: str = "ticker",
                    ) -> tuple[DataFrame, DataFrame]:
    """S2/S3 inside a job: the sources' rows, tagged and unioned, and a table of the
    sources (``ticker``, ``missing``: the columns a source lacks). A source that
    lacks one gives no rows and fails the gate; the others go on."""
    spark = next(iter(frames.values())).sparkSession
    lacks = {t: missing_columns(f, cols) for t, f in frames.items()}
    good = {t: nan_to_null(f.select(*keep, *[
        F.col(next(x for x in f.columns if x.lower() == c.lower())).alias(c) for c in cols]))
        for t, f in frames.items() if not lacks[t]}
    sources = spark.createDataFrame(sorted(lacks.items()), f"{key} string, missing array<string>")
    if good:
        return tag_union(good, key), sources
    first = next(iter(frames.values()))
    empty = first.select(*keep, *[F.lit(None).cast("double").alias(c) for c in cols]).limit(0)
    return empty.withColumn(key, F.lit("")), sources


def tag_union(frames: dict, key: str = "ticker") -> DataFrame:
    """S3: add a constant ticker column to each frame and union them."""
    out = None
    for tag, f in frames.items():
        t = f.withColumn(key, F.lit(tag))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


#: Date, time and zone of a time stamp written as text.
_STAMP = (r"^\s*(\d{4}-\d{2}-\d{2})(?:[T ]\s*(\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?))?"
          r"\s*\[?(.*?)\]?\s*$")
_OFFSET = r"^([+-])(\d{2}):?(\d{2})?$"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def utc_of_text(ts) -> Column:
    """S4 for text, row by row and whatever the session's zone: an offset
    (``+05:30``, ``-0500``, ``+01``, ``Z``, ``UTC``) is taken off; a zone's name
    (``America/New_York``, also in square brackets) is looked up for that date, so
    daylight saving is heeded; text without a zone is UTC; a date alone is its
    midnight. Text that is no time stamp is NULL, an unknown zone raises."""
    c = (F.col(ts) if isinstance(ts, str) else ts).cast("string")
    day, clock, zone = (F.regexp_extract(c, _STAMP, k) for k in (1, 2, 3))
    # Spark keeps microseconds; further digits are cut
    clock = F.regexp_replace(clock, r"(\.\d{6})\d+$", "$1")
    wall = F.when(day != "", F.concat_ws(" ", day, F.nullif(clock, F.lit("")))).try_cast(
        "timestamp_ntz")
    sign, hours, minutes = (F.regexp_extract(zone, _OFFSET, k) for k in (1, 2, 3))
    off = F.when(sign == "-", -1).otherwise(1) * (
        F.coalesce(hours.try_cast("int"), F.lit(0)) * 60
        + F.coalesce(minutes.try_cast("int"), F.lit(0)))
    # 'Z' and 'UTC' have no offset; neither does text without a zone
    named = ~F.upper(zone).isin("", "Z", "UTC", "GMT") & (sign == "")
    return F.when(named, F.convert_timezone(F.when(named, zone).otherwise("UTC"), F.lit("UTC"), wall)
                  ).otherwise(wall - F.make_dt_interval(mins=off))


def utc_of_instant(ts) -> Column:
    """S4 for a TIMESTAMP: an instant's UTC wall time, without a zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.expr(_EPOCH) + F.make_dt_interval(
        secs=(F.unix_micros(c).cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)"))
        .cast("decimal(18,6)"))


def utc_naive(df: DataFrame, ts: str) -> Column:
    """The column ``ts`` of ``df`` as zone-less UTC, by its type: text is parsed,
    a TIMESTAMP is an instant, dates and zone-less stamps stay as they are."""
    kind = df.schema[ts].dataType.typeName()
    if kind == "string":
        return utc_of_text(ts)
    return utc_of_instant(ts) if kind == "timestamp" else F.col(ts).cast("timestamp_ntz")


def ticker_slug(ticker) -> Column:
    """File-safe name, '.' -> '_'."""
    c = F.col(ticker) if isinstance(ticker, str) else ticker
    return F.translate(c, ".", "_")


def write_panel_parquet(df: DataFrame, path: str, key: str = "ticker") -> None:
    """Snappy Parquet per ticker; replaces the tickers of ``df`` only."""
    PanelStore(df.sparkSession, path, (key,), compression="snappy").write(df)


def format_prices(df: DataFrame, digits: int = 4, cols=OHLC) -> DataFrame:
    """Fixed decimals as text (4 for raw prices, 6 for processed data)."""
    return df.withColumns({c: F.format_string(f"%.{digits}f", F.col(c)) for c in cols})


def write_panel_csv(df: DataFrame, path: str, digits: int = 4, cols=OHLC,
                    keys=("ticker",)) -> None:
    """CSV with a header and fixed decimals, a folder per ticker (or other
    ``keys``); replaces those of ``df`` only."""
    PanelStore(df.sparkSession, path, keys, "csv", header=True).write(
        format_prices(df, digits, cols))


def read_panel_csv(spark: SparkSession, path: str, keys=("ticker",), **chosen) -> DataFrame:
    """The CSV panel as written, every column as text."""
    df = PanelStore(spark, path, keys, "csv", header=True).read(**chosen)
    if df is None:
        raise MissingDataError(f"no panel stored at {path}")
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def collection_manifest(gate: DataFrame, clean: DataFrame, collected_at: str,
                        parameters: dict, key: str = "ticker", date: str = "date",
                        sources: DataFrame | None = None) -> DataFrame:
    """Per ticker of the gate (which has a row for every requested one):
    status, rows, first / last date; FAILED for rejected and absent tickers, and
    for those of ``sources`` (see ``collect_sources``) that lack a column;
    ``entry`` is the JSON object of the manifest's ``results`` map.
    ``collected_at`` and ``parameters`` (JSON) describe the collection."""
    stats = clean.groupBy(key).agg(F.count(F.lit(1)).alias("rows"),
                                   F.min(date).alias("start"), F.max(date).alias("end"))
    g = gate.select(key, "ok").join(stats, key, "left")
    if sources is not None:
        g = (g.join(sources, key, "full")
             .withColumn("ok", F.coalesce("ok", F.lit(False))
                         & (F.coalesce(F.size("missing"), F.lit(0)) <= 0)).drop("missing"))
    ok = F.col("ok") & F.col("rows").isNotNull()
    out = g.select(
        key,
        F.when(ok, "OK").otherwise("FAILED").alias("status"),
        F.when(ok, F.col("rows")).alias("rows"),
        F.when(ok, F.date_format("start", "yyyy-MM-dd")).alias("start"),
        F.when(ok, F.date_format("end", "yyyy-MM-dd")).alias("end"),
        F.lit(collected_at).alias("collected_at"),
        F.lit(json.dumps(parameters, separators=(",", ":"))).alias("parameters"))
    return out.withColumn("entry", F.to_json(F.struct("status", "rows", "start", "end")))


def manifest_json(manifest: DataFrame, key: str = "ticker") -> DataFrame:
    """The whole collection as one JSON object: when and with what parameters,
    the requested tickers, and ``results``, a map from ticker to its outcome. One
    row; a manifest has one short entry per ticker."""
    entry = F.struct("status", "rows", "start", "end")
    got = manifest.agg(
        F.first("collected_at").alias("collected_at"), F.first("parameters").alias("parameters"),
        F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), entry.alias("v")))).alias("e"))
    tickers = F.transform("e", lambda x: x["k"])
    results = F.map_from_entries("e")
    return got.select(F.concat(
        F.lit('{"collected_at":'), F.to_json(F.array("collected_at")).substr(F.lit(2), F.length(
            F.to_json(F.array("collected_at"))) - 2),
        F.lit(',"parameters":'), "parameters", F.lit(',"tickers":'), F.to_json(tickers),
        F.lit(',"results":'), F.to_json(results), F.lit("}")).alias("manifest"))


def publish_manifest(manifest: DataFrame, path: str, key: str = "ticker") -> str:
    """Writes the manifest as one JSON file, moved to ``path`` when it is whole,
    so a reader finds the old file or the new one."""
    spark = manifest.sparkSession
    text = manifest_json(manifest, key).first()["manifest"]
    P = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = P(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = P(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(json.dumps(json.loads(text), indent=2, ensure_ascii=False).encode()))
    finally:
        out.close()
    if fs.exists(P(path)):
        fs.delete(P(path), False)
    if not fs.rename(aside, P(path)):
        raise OSError(f"could not publish {path}")
    return path


def write_processed(df: DataFrame, path: str, key: str = "ticker") -> None:
    """Scaled splits stored per (ticker, split); replaces those of ``df`` only."""
    PanelStore(df.sparkSession, path, (key, "split")).write(df)


def read_processed(spark: SparkSession, path: str, tickers=None, splits=None,
                   key: str = "ticker") -> DataFrame:
    """The stored splits of all or some tickers."""
    df = PanelStore(spark, path, (key, "split")).read(**{key: tickers, "split": splits})
    if df is None:
        raise MissingDataError(f"nothing stored at {path}")
    return df


def write_sequences(seqs: DataFrame, path: str, key: str = "ticker") -> None:
    """Sequence tensors (ARRAY<ARRAY<FLOAT>>) per (ticker, split);
    replaces those of ``seqs`` only."""
    PanelStore(seqs.sparkSession, path, (key, "split")).write(seqs)


def read_sequences(spark: SparkSession, path: str, key: str = "ticker") -> DataFrame:
    """Every ticker's sequences."""
    return read_processed(spark, path, key=key)


def load_sequences(spark: SparkSession, path: str, ticker: str, split: str | None = None,
                   key: str = "ticker") -> DataFrame:
    """One ticker's sequences (its folders only); error when absent."""
    df = PanelStore(spark, path, (key, "split")).read(**{key: ticker, "split": split})
    if df is None or df.limit(1).count() == 0:
        raise MissingDataError(f"no sequences stored for {ticker!r}; run prepare first")
    return df


def write_window_blocks(blocks: DataFrame, path: str, key: str = "ticker") -> None:
    """S10 in blocks of rows (see ``features.window_blocks``), per (ticker, split)."""
    PanelStore(blocks.sparkSession, path, (key, "split")).write(blocks)


def load_windows(spark: SparkSession, path: str, window: int, tickers=None, splits=None,
                 key: str = "ticker", block: int | None = None) -> DataFrame:
    """Windows cut out of the stored blocks when they are read."""
    from barpanel.operators.features import BLOCK_ROWS, windows_of_blocks
    return windows_of_blocks(read_processed(spark, path, tickers, splits, key), window,
                             block or BLOCK_ROWS, key)
