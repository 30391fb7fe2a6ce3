"""Row-level expressions (P1-P13). All return ``Column`` built from built-in
functions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barpanel.constants import PROBA_THRESHOLD


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ln_ratio(num, den) -> Column:
    """P1 core: ln(num/den); NULL when the ratio is null or not positive."""
    r = F.try_divide(col(num), col(den))
    return F.when(r > 0, F.ln(r))


def clip_gain(delta) -> Column:
    """Positive part; NULL stays NULL (``greatest(null, 0)`` would be 0)."""
    d = col(delta)
    return F.when(d.isNotNull(), F.greatest(d, F.lit(0.0)))


def clip_loss(delta) -> Column:
    """Negative part as a positive number; NULL stays NULL."""
    d = col(delta)
    return F.when(d.isNotNull(), F.greatest(-d, F.lit(0.0)))


def ratio(num, den) -> Column:
    """Num / den, NULL for a zero or null denominator."""
    return F.try_divide(col(num), col(den))


def minmax_scale(x, lo, hi) -> Column:
    """(x - min) / (max - min); a zero range divides by 1; no clipping."""
    rng = col(hi) - col(lo)
    return (col(x) - col(lo)) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)


def to_float32_seq(seq) -> Column:
    """P5: window tensor as ARRAY<ARRAY<FLOAT>>."""
    return col(seq).cast("array<array<float>>")


def flatten_window(seq) -> Column:
    """(window, features) -> window*features, oldest day first."""
    return F.flatten(col(seq))


def last_step(seq) -> Column:
    """The feature vector of the last (most recent) step."""
    return F.element_at(col(seq), -1)


def mean_pool(seq, n_features: int) -> Column:
    """Mean over time of every feature; independent of the sequence length."""
    s = col(seq)
    zero = F.array_repeat(F.lit(0.0), n_features)
    total = F.aggregate(s, zero, lambda acc, step: F.zip_with(
        acc, step, lambda a, b: a + b.cast("double")))
    return F.transform(total, lambda v: v / F.size(s))


def weighted_sum(weights, values) -> Column:
    """P10: Σ w_i · v_i."""
    prod = F.zip_with(col(weights), col(values), lambda w, v: w * v)
    return F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)


def threshold_label(p, threshold: float = PROBA_THRESHOLD) -> Column:
    """P(up) -> 0/1 with ``>=``."""
    return (col(p) >= F.lit(threshold)).cast("int")


def direction_signal(label) -> Column:
    """0/1 label -> -1/+1 signal."""
    return F.lit(2.0) * col(label).cast("double") - F.lit(1.0)


def realised_return(pred, y) -> Column:
    """+1 when the direction is right, -1 otherwise."""
    return direction_signal(pred) * direction_signal(y)


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col(z)))
