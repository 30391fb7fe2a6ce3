"""Evaluation (A1-A10) and scoring (P11-P13) as grouped aggregates.

Every metric of every (model, ticker, split) group comes out of one
``groupBy().agg()``: partial aggregation inside each task, one small exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barpanel.constants import FEATURE_COLS, TRADING_DAYS
from barpanel.functions import scalars as P

LOG_EPS = 1e-15


def directional_accuracy(pred: str = "pred", y: str = "y") -> Column:
    """A1: share of predictions equal to the label."""
    return F.avg((F.col(pred) == F.col(y)).cast("double"))


def mae(p: str = "p", y: str = "y") -> Column:
    """A2: mean |P(up) - y|."""
    return F.avg(F.abs(F.col(p) - F.col(y)))


def rmse(p: str = "p", y: str = "y") -> Column:
    """A3: sqrt(mean (P(up) - y)^2)."""
    return F.sqrt(F.avg(F.pow(F.col(p) - F.col(y), 2)))


def sharpe(pred: str = "pred", y: str = "y") -> Column:
    """A4: mean / population std × sqrt(252) of the ±1 strategy returns;
    0.0 when the std is 0."""
    r = P.realised_return(pred, y)
    m, sd = F.avg(r), F.stddev_pop(r)
    return F.when(sd > 0, m / sd * F.lit(math.sqrt(TRADING_DAYS))).otherwise(F.lit(0.0))


def log_loss(p: str = "p", y: str = "y", eps: float = LOG_EPS) -> Column:
    """A10: mean binary cross-entropy, P clamped to [eps, 1-eps]."""
    q = F.least(F.greatest(F.col(p), F.lit(eps)), F.lit(1 - eps))
    yy = F.col(y).cast("double")
    return -F.avg(yy * F.ln(q) + (F.lit(1.0) - yy) * F.ln(F.lit(1.0) - q))


METRICS = ("directional_accuracy", "mae", "rmse", "sharpe_ratio")


def evaluate(scores: DataFrame, by=("ticker", "split"), digits: int | None = 4,
             p: str = "p", y: str = "y", pred: str = "pred") -> DataFrame:
    """A5: the four metrics per group, rounded like the reference (4 digits)."""
    cols = {"directional_accuracy": directional_accuracy(pred, y), "mae": mae(p, y),
            "rmse": rmse(p, y), "sharpe_ratio": sharpe(pred, y)}
    aggs = [F.count(F.lit(1)).alias("n")]
    for name, c in cols.items():
        aggs.append((F.round(c, digits) if digits is not None else c).alias(name))
    return scores.groupBy(*by).agg(*aggs)


def metrics_long(metrics: DataFrame, by=("ticker",), split: str = "split") -> DataFrame:
    """One row per metric named ``<split>_<metric>``."""
    parts = ", ".join(f"'{m}', `{m}`" for m in METRICS)
    long = metrics.selectExpr(*by, split, f"stack({len(METRICS)}, {parts}) as (metric, value)")
    return long.select(*by, F.concat(F.col(split), F.lit("_"), F.col("metric")).alias("key"), "value")


def result_table(metrics: DataFrame, key: str = "ticker", split: str = "test") -> DataFrame:
    """One summary row per ticker: accuracy as a percentage with one
    decimal, Sharpe with two, MAE and RMSE with four. Rounded half up in
    decimal arithmetic from the 4-digit metrics, so ties round alike in any
    engine."""
    m = metrics.filter(F.col("split") == split)

    def fixed(c: Column, digits: int) -> Column:
        return F.round(c.cast("decimal(20,6)"), digits).cast(f"decimal(20,{digits})").cast("string")
    acc = F.round(F.col("directional_accuracy"), 4).cast("decimal(20,6)") * F.lit(100)
    return m.select(
        key, "n", F.concat(fixed(acc, 1), F.lit("%")).alias("accuracy"),
        fixed(F.round("sharpe_ratio", 4), 2).alias("sharpe"),
        fixed(F.round("mae", 4), 4).alias("mae"),
        fixed(F.round("rmse", 4), 4).alias("rmse")).orderBy(key)


def class_balance(df: DataFrame, by=("ticker",), y: str = "y") -> DataFrame:
    """n_neg, n_pos and n_neg / n_pos (1.0 when there is no positive)."""
    yy = F.col(y)
    r = df.groupBy(*by).agg(F.sum((yy == 0).cast("long")).alias("n_neg"),
                            F.sum((yy == 1).cast("long")).alias("n_pos"))
    return r.withColumn("scale_pos_weight", F.when(F.col("n_pos") > 0,
                                                   F.col("n_neg") / F.col("n_pos")).otherwise(1.0))


def with_class_weight(df: DataFrame, balance: DataFrame, by=("ticker",), y: str = "y",
                      out: str = "weight") -> DataFrame:
    """A8 as a weight column: positives weigh n_neg / n_pos."""
    return (df.join(balance.select(*by, "scale_pos_weight"), list(by))
            .withColumn(out, F.when(F.col(y) == 1, F.col("scale_pos_weight")).otherwise(1.0))
            .drop("scale_pos_weight"))


def with_softmax(df: DataFrame, scores: str, out: str) -> DataFrame:
    """P9 as projections: max, exponentials and their total are separate
    columns, so each is computed once per row (a single nested expression
    would re-evaluate the total inside the per-element lambda)."""
    return (df.withColumn("_sm_m", F.array_max(scores))
            .withColumn("_sm_e", F.transform(scores, lambda v: F.exp(v - F.col("_sm_m"))))
            .withColumn("_sm_t", F.aggregate("_sm_e", F.lit(0.0), lambda a, v: a + v))
            .withColumn(out, F.transform("_sm_e", lambda v: v / F.col("_sm_t")))
            .drop("_sm_m", "_sm_e", "_sm_t"))


def feature_importance_mean(scaled: DataFrame, window: int, names=FEATURE_COLS) -> DataFrame:
    """Mean over windows and time steps of the per-step softmax across
    features -> one weight per feature (sums to 1).

    Every step of every window is one scaled row, so the mean is taken over
    the rows weighted by how many windows contain them; no window tensor is
    built. A row at position q of a split of L rows lies in the windows
    ending at q+1 .. q+window that exist (>= window rows into the split):
    max(0, min(q+window, L-1) - max(q+1, window) + 1). Values go through
    FLOAT like the tensors. Needs ``_pos``, ``_n`` and ``split``."""
    from barpanel.operators.features import split_sizes
    n_train, n_val, n_test = split_sizes("_n")
    s = F.col("split")
    start = F.when(s == "train", F.lit(0)).when(s == "val", n_train).otherwise(n_train + n_val)
    size = F.when(s == "train", n_train).when(s == "val", n_val).otherwise(n_test)
    q = F.col("_pos") - start
    mult = F.greatest(F.lit(0), F.least(q + window, size - 1) - F.greatest(q + 1, F.lit(window)) + 1)
    xs = {c: F.col(c).cast("float").cast("double") for c in names}
    d = scaled.select(mult.cast("double").alias("_k"), *[x.alias(c) for c, x in xs.items()])
    d = d.withColumn("_m", F.greatest(*[F.col(c) for c in names]))
    d = d.select("_k", *[F.exp(F.col(c) - F.col("_m")).alias(c) for c in names])
    tot = F.col(names[0])
    for c in names[1:]:
        tot = tot + F.col(c)
    d = d.withColumn("_t", tot)
    g = d.agg(F.sum("_k").alias("_kk"),
              *[F.sum(F.col("_k") * F.col(c) / F.col("_t")).alias(c) for c in names])
    parts = ", ".join(f"'{c}', `{c}` / _kk" for c in names)
    return g.selectExpr(f"stack({len(names)}, {parts}) as (feature, importance)")


# ---------------------------------------------------------------------------
# A checkable scorer with a stored weight vector
# ---------------------------------------------------------------------------
def linear_weights(window: int, n_features: int = len(FEATURE_COLS)) -> list[float]:
    """Deterministic weights for the flattened window (oldest step first):
    w(step, f) = cos(0.7·lag + 1.3·f) / (10·lag), lag = window - step."""
    w = []
    for step in range(window):
        lag = window - step
        for f in range(n_features):
            w.append(math.cos(0.7 * lag + 1.3 * f) / (10.0 * lag))
    return w


def linear_score(seqs: DataFrame, weights: list[float], bias: float = 0.0,
                 seq: str = "seq") -> Column:
    """P(up) = sigmoid(Σ w·x + b) over the flattened window. The weight
    vector (window × features, a model parameter) travels as a literal."""
    wv = F.array(*[F.lit(float(x)) for x in weights])
    z = P.weighted_sum(wv, F.transform(F.flatten(F.col(seq)), lambda v: v.cast("double")))
    return P.sigmoid(z + F.lit(bias))


def score_sequences(seqs: DataFrame, window: int, bias: float = 0.0) -> DataFrame:
    """P13 + P11: (ticker, split, date, y, p, pred) for every window."""
    p = linear_score(seqs, linear_weights(window), bias)
    return seqs.select("ticker", "split", "date", F.col("y").cast("int").alias("y"),
                       p.alias("p")).withColumn("pred", P.threshold_label("p"))
