"""Composite jobs: features, split, scaling, sequences.

The whole chain is one lazy DAG over every ticker at once. Under the plain
layout the panel is exchanged once on ``ticker`` and every window shares the
sort; under the blocked layout each stage works on (ticker, block) partitions
with a halo (see ``plans.layout``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barpanel.constants import DEFAULT_WINDOW, FEATURE_COLS, OHLCV, TEST_PCT, VAL_PCT
from barpanel.functions import scalars as P
from barpanel.operators import windows as Wn
from barpanel.plans.layout import PLAIN, SeriesLayout, materialize
from barpanel.sources.store import PanelStore


# ---------------------------------------------------------------------------
# F1 / F2
# ---------------------------------------------------------------------------
def compute_features(panel: DataFrame, layout: SeriesLayout = PLAIN,
                     extra=None, extra_cols=()) -> DataFrame:
    """All 18 features + target for every row (warm-up rows still present).

    ``extra(df, layout)`` may add more window columns (``extra_cols``) in the
    same pass, sharing its exchange and sorts (e.g. momentum lags)."""
    lay = layout.with_halo(*Wn.feature_halo())
    key = lay.key
    df = lay.prepare(panel.select(key, *lay.order, *OHLCV))
    df = Wn.log_return(df, lay)
    df = Wn.sma(df, lay)
    df = Wn.rsi_macd(df, lay)
    df = Wn.volatility(df, lay)
    df = Wn.volume_norm(df, lay)
    df = Wn.target_next_up(df, lay)
    if extra is not None:
        df = extra(df, lay)
    df = lay.finish(df)
    helpers = ["_rn", "_blk"] if lay.blocked else []
    return df.select(key, *lay.order, *FEATURE_COLS, "target", *extra_cols, *helpers)


def complete(df: DataFrame) -> DataFrame:
    return df.dropna(how="any", subset=FEATURE_COLS + ["target"])


def feature_frame(panel: DataFrame, layout: SeriesLayout = PLAIN,
                  extra=None, extra_cols=()) -> DataFrame:
    """features with every incomplete (warm-up) row dropped."""
    return complete(compute_features(panel, layout, extra, extra_cols))


def warmup_report(panel: DataFrame, layout: SeriesLayout = PLAIN) -> DataFrame:
    """rows before / dropped / kept per ticker (one grouped pass)."""
    f = compute_features(panel, layout)
    ok = F.lit(True)
    for c in FEATURE_COLS + ["target"]:
        ok = ok & F.col(c).isNotNull()
    return (f.groupBy(layout.key)
            .agg(F.count(F.lit(1)).alias("n_before"),
                 F.sum(F.when(ok, 1).otherwise(0)).cast("bigint").alias("n_kept"))
            .withColumn("n_dropped", F.col("n_before") - F.col("n_kept")))


# ---------------------------------------------------------------------------
# F3 / F4 / F5
# ---------------------------------------------------------------------------
def split_sizes(n) -> tuple:
    n = P.col(n)
    n_test = (n * F.lit(TEST_PCT)) / F.lit(100)
    n_test = F.floor(n_test).cast("bigint")
    n_val = F.floor((n * F.lit(VAL_PCT)) / F.lit(100)).cast("bigint")
    return n - n_val - n_test, n_val, n_test


def chrono_split(features: DataFrame, layout: SeriesLayout = PLAIN,
                 keep_pos: bool = False) -> DataFrame:
    """positional split per ticker: train = first n - 2·int(.15n) rows,
    then val, then test. Adds ``split`` (and ``_pos``, ``_n`` if asked)."""
    if layout.blocked:
        features = materialize(features)
    df = layout.positions(features)
    n_train, n_val, _ = split_sizes("_n")
    pos = F.col("_pos")
    df = df.withColumn("split", F.when(pos < n_train, "train")
                       .when(pos < n_train + n_val, "val").otherwise("test"))
    if not keep_pos:
        df = df.drop("_pos", "_n")
    return df


SPLITS = ("train", "val", "test")


def requested_splits(requested: DataFrame, key: str = "ticker") -> DataFrame:
    """Every requested ticker with every split."""
    return requested.select(key).distinct().withColumn(
        "split", F.explode(F.array(*[F.lit(x) for x in SPLITS])))


def split_bounds(split_df: DataFrame, key: str = "ticker", order: str = "date",
                 requested: DataFrame | None = None) -> DataFrame:
    """Per ticker × split: rows, first and last date (F5). With ``requested``
    (a table of tickers) empty splits and absent tickers have 0 rows."""
    r = (split_df.groupBy(key, "split")
         .agg(F.count(F.lit(1)).alias("n_rows"),
              F.min(order).alias("start"), F.max(order).alias("end")))
    if requested is None:
        return r
    return requested_splits(requested, key).join(r, [key, "split"], "left").withColumn(
        "n_rows", F.coalesce("n_rows", F.lit(0)))


def leakage_check(split_df: DataFrame, key: str = "ticker", order: str = "date",
                  requested: DataFrame | None = None) -> DataFrame:
    """per ticker ``ok`` = max(train) < min(val) and max(val) < min(test).
    An empty split gives NULL bounds and hence ``ok`` = false; with
    ``requested`` so does a ticker without any complete row."""
    o = F.col(order)
    s = F.col("split")
    r = split_df.groupBy(key).agg(
        F.max(F.when(s == "train", o)).alias("train_max"),
        F.min(F.when(s == "val", o)).alias("val_min"),
        F.max(F.when(s == "val", o)).alias("val_max"),
        F.min(F.when(s == "test", o)).alias("test_min"))
    if requested is not None:
        r = requested.select(key).distinct().join(r, key, "left")
    ok = (F.col("train_max") < F.col("val_min")) & (F.col("val_max") < F.col("test_min"))
    return r.withColumn("ok", F.coalesce(ok, F.lit(False)))


def assert_no_leakage(split_df: DataFrame, key: str = "ticker", order: str = "date") -> None:
    bad = leakage_check(split_df, key, order).filter(~F.col("ok")).select(key)
    n = bad.count()
    if n:
        some = [r[0] for r in bad.limit(20).collect()]
        raise AssertionError(f"leakage or empty split for {n} tickers, among them {some}")


# ---------------------------------------------------------------------------
# F6 / F7 / F8
# ---------------------------------------------------------------------------
def fit_minmax(split_df: DataFrame, key: str = "ticker", cols=FEATURE_COLS) -> DataFrame:
    """per ticker min / max of every feature over the train split only.

    A grouped aggregate with map-side partial aggregation: a hot ticker is
    reduced inside every task before the exchange. Wide: min_<c>, max_<c>.
    """
    tr = split_df.filter(F.col("split") == "train")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"min_{c}"), F.max(x).alias(f"max_{c}")]
    return tr.groupBy(key).agg(*aggs)


def params_long(params: DataFrame, key: str = "ticker", cols=FEATURE_COLS) -> DataFrame:
    """F6 long form: (ticker, feature, min, max) via ``stack``."""
    parts = ", ".join(f"'{c}', `min_{c}`, `max_{c}`" for c in cols)
    return params.selectExpr(key, f"stack({len(cols)}, {parts}) as (feature, min, max)")


def apply_minmax(df: DataFrame, params: DataFrame, key: str = "ticker",
                 cols=FEATURE_COLS) -> DataFrame:
    """Scale with stored params. The params table has one row per
    ticker; its size in bytes decides between broadcast and shuffle join
    (AQE splits a hot ticker)."""
    j = df.join(params, key)
    scaled = {c: P.minmax_scale(F.col(c).cast("double"), f"min_{c}", f"max_{c}") for c in cols}
    return j.withColumns(scaled).drop(*[f"{m}_{c}" for c in cols for m in ("min", "max")])


def normalize_splits(split_df: DataFrame, key: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """fit on train, apply to all three splits. Returns (scaled, params)."""
    params = fit_minmax(split_df, key)
    return apply_minmax(split_df, params, key), params


def save_scaler(params: DataFrame, path: str, key: str = "ticker") -> None:
    """F8: scaler params for reuse at inference; replaces the tickers of
    ``params`` only."""
    PanelStore(params.sparkSession, path, (key,)).write(params)


def load_scaler(spark, path: str, tickers=None, key: str = "ticker") -> DataFrame:
    """F8: the stored params of all or some tickers."""
    df = PanelStore(spark, path, (key,)).read(**{key: tickers})
    if df is None:
        raise FileNotFoundError(f"no scaler stored at {path}")
    return df


# ---------------------------------------------------------------------------
# W10 / F9
# ---------------------------------------------------------------------------
def sliding_sequences(scaled: DataFrame, layout: SeriesLayout = PLAIN,
                      window: int = DEFAULT_WINDOW, cols=FEATURE_COLS) -> DataFrame:
    """X = the ``window`` rows before row i of the same split, y = target_i.

    ``scaled`` must carry ``_pos`` (position among complete rows) and
    ``split``. A window never crosses a split: it is kept only when the row's
    position inside its split is >= window. Output
    (ticker, split, date, seq ARRAY<ARRAY<FLOAT>>, y BIGINT).
    """
    key = layout.key
    order = layout.order[0]
    n_train, n_val, _ = split_sizes("_n")
    s = F.col("split")
    df = scaled.withColumn("_split_start", F.when(s == "train", F.lit(0))
                           .when(s == "val", n_train).otherwise(n_train + n_val))
    if layout.blocked:
        lay = layout.with_halo(window, 0)
        df = lay.prepare(df.drop("_rn", "_blk"), ordinal="_pos")
    else:
        lay = layout
    vec = F.array(*[F.col(c).cast("float") for c in cols])
    frame = lay.rows(-window, -1)
    df = df.withColumn("seq", F.collect_list(vec).over(frame))
    df = lay.finish(df)
    df = df.filter(F.col("_pos") - F.col("_split_start") >= window)
    return df.select(key, "split", order, P.to_float32_seq("seq").alias("seq"),
                     F.col("target").cast("bigint").alias("y"))


#: Rows of a stored block, besides the ``window`` rows that it shares with the
#: block before.
BLOCK_ROWS = 512


def window_blocks(scaled: DataFrame, window: int = DEFAULT_WINDOW, block: int = BLOCK_ROWS,
                  cols=FEATURE_COLS, key: str = "ticker", order: str = "date") -> DataFrame:
    """W10/S10 without a copy of every row per window: blocks of consecutive scaled
    rows of a split as arrays, each with the ``window`` rows before it, so that
    every window lies in one block. (key, split, blk, first, rows): ``first`` is
    the position in the split of the first of ``rows`` (date, x, y). A group holds
    at most ``block + window`` rows. ``scaled`` as for :func:`sliding_sequences`."""
    n_train, n_val, _ = split_sizes("_n")
    s = F.col("split")
    at = F.col("_pos") - F.when(s == "train", F.lit(0)).when(s == "val", n_train).otherwise(
        n_train + n_val)
    blocks = F.sequence(F.floor(F.col("_q") / F.lit(block)),
                        F.floor((F.col("_q") + F.lit(window)) / F.lit(block)))
    x = F.array(*[F.col(c).cast("float") for c in cols])
    return (scaled.select(key, "split", order, at.cast("bigint").alias("_q"), x.alias("x"),
                          F.col("target").cast("bigint").alias("y"))
            .withColumn("blk", F.explode(blocks))
            .groupBy(key, "split", "blk")
            .agg(F.sort_array(F.collect_list(F.struct("_q", order, "x", "y"))).alias("_r"))
            .select(key, "split", "blk", F.get("_r", F.lit(0))["_q"].alias("first"),
                    F.transform("_r", lambda r: F.struct(r[order].alias(order), r["x"].alias("x"),
                                                         r["y"].alias("y"))).alias("rows"))
            # the last rows of a split open a block that has nothing but the rows before it
            .filter(F.col("first") + F.size("rows") > F.col("blk") * F.lit(block)))


def windows_of_blocks(blocks: DataFrame, window: int = DEFAULT_WINDOW, block: int = BLOCK_ROWS,
                      key: str = "ticker", order: str = "date") -> DataFrame:
    """The windows cut out of stored blocks, as :func:`sliding_sequences`
    gives them: (key, split, order, seq, y)."""
    own = F.greatest(F.col("blk") * F.lit(block), F.lit(window).cast("bigint"))
    past = F.col("first") + F.size("rows")
    q = F.when(own < past, F.sequence(own, past - 1))
    i = F.col("q") - F.col("first")  # of the row whose target the window has
    row = F.get("rows", i.cast("int"))
    seq = F.transform(F.slice("rows", (i - F.lit(window) + 1).cast("int"), F.lit(window)),
                      lambda r: r["x"])
    return (blocks.withColumn("q", F.explode(q))
            .select(key, "split", row[order].alias(order), seq.alias("seq"), row["y"].alias("y")))


def sequence_report(seqs: DataFrame, key: str = "ticker", window: int = DEFAULT_WINDOW,
                    n_features: int = len(FEATURE_COLS),
                    requested: DataFrame | None = None) -> DataFrame:
    """N, window and n_features per ticker × split; with ``requested`` also
    where there is no window."""
    r = (seqs.groupBy(key, "split")
         .agg(F.count(F.lit(1)).alias("n_seq"),
              F.max(F.size("seq")).cast("int").alias("window"),
              F.max(F.size(F.element_at("seq", 1))).cast("int").alias("n_features")))
    if requested is None:
        return r
    return requested_splits(requested, key).join(r, [key, "split"], "left").withColumns({
        "n_seq": F.coalesce("n_seq", F.lit(0)), "window": F.coalesce("window", F.lit(window)),
        "n_features": F.coalesce("n_features", F.lit(n_features))})


# ---------------------------------------------------------------------------
# F10
# ---------------------------------------------------------------------------
def prepare_panel(panel: DataFrame, layout: SeriesLayout = PLAIN,
                  window: int = DEFAULT_WINDOW) -> dict:
    """raw panel -> features -> split -> scaled -> sequences (lazy).

    Returns the frames of every stage; ``sequences`` is the final tensor table.
    """
    feats = feature_frame(panel, layout)
    # read twice (train-only fit and the scaling join): written once; the
    # checkpoint goes with the frame, so nothing stays cached
    split = materialize(chrono_split(feats, layout, keep_pos=True))
    scaled, params = normalize_splits(split, layout.key)
    seqs = sliding_sequences(scaled, layout, window)
    return {"features": feats, "split": split, "params": params,
            "scaled": scaled, "sequences": seqs}


def prepare_report(stages: dict, requested: DataFrame, key: str = "ticker",
                   order: str = "date") -> DataFrame:
    """outcome per requested ticker × split: windows, their shape, ups and
    dates, and ``status``: OK if the ticker's splits are all there and in order,
    FAIL for tickers that are absent, too short or without complete rows."""
    seqs = stages["sequences"]
    # the grouped facts once; a second aggregate over them gives the windows
    facts = seqs.groupBy(key, "split").agg(
        F.count(F.lit(1)).alias("n_seq"), F.max(F.size("seq")).cast("int").alias("window"),
        F.max(F.size(F.element_at("seq", 1))).cast("int").alias("n_features"),
        F.sum("y").cast("bigint").alias("n_up"),
        F.min(order).alias("first_date"), F.max(order).alias("last_date"))
    gate = leakage_check(stages["split"], key, order, requested).select(
        key, F.when(F.col("ok"), "OK").otherwise("FAIL").alias("status"))
    return (requested_splits(requested, key).join(facts, [key, "split"], "left").join(gate, key)
            .withColumns({"n_seq": F.coalesce("n_seq", F.lit(0)),
                          "n_up": F.coalesce("n_up", F.lit(0))}))
