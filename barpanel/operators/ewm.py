"""Exponentially weighted mean without a built-in recurrence.

``y_0 = x_0``, ``y_t = (1-α) y_{t-1} + α x_t`` (the ``adjust=False`` form),
starting at the first non-null value; null inputs are skipped (the output
carries the last value). With ``y_in = x_0`` as the state before the first
observation every step is the same affine map, which gives a block scan out of
ordinary window functions:

* observations (not rows) are numbered and cut into sub-blocks of ``S`` of them,
  with ``37 <= S·ln(1/a) <= 500`` (a = 1-α): the closed form
  ``a^c · Σ α·x·a^-c`` over a sub-block cannot overflow, and what a sub-block
  inherits from the one before the last is below double precision. So the
  carry of a sub-block is the value at the end of the one before, found by
  ``last(ignorenulls)`` over the growing frame: linear in the rows;
* ``y = loc + a^c · carry``, plus ``a^n · y_in`` for the n-th observation.

Specs whose ratio of ``ln(1/a)`` does not allow a common ``S`` get sub-blocks of
their own. No UDF, and under the plain layout no join.

In the blocked layout a window partition counts only the observations of its
own rows, from an empty state; the state that enters a block comes from a scan
of the blocks' affine maps on two levels (``prefix_states``), linear in the blocks.
A long run of nulls therefore changes nothing, and both layouts give the same
result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barpanel.plans.layout import SeriesLayout, materialize

_MAX_EXP = 500.0    # keeps a^-c below e^500
_LOST = 37.0        # e^-37 is below the precision of a double


def alpha_from(com: float | None = None, span: float | None = None,
               alpha: float | None = None) -> float:
    if alpha is not None:
        a = float(alpha)
    elif com is not None:
        a = 1.0 / (1.0 + com)
    elif span is not None:
        a = 2.0 / (span + 1.0)
    else:
        raise ValueError("give one of com, span, alpha")
    if not 0.0 < a < 1.0:
        raise ValueError(f"alpha must be in (0, 1), got {a}")
    return a


def _decay(alpha: float) -> float:
    return -math.log1p(-alpha)


def sub_blocks(alphas) -> list[tuple[int, list[float]]]:
    """Sub-block lengths and the alphas that share each."""
    out: list[tuple[int, list[float]]] = []
    for a in sorted(set(alphas), key=_decay, reverse=True):
        if out and out[-1][0] * _decay(a) >= _LOST:
            out[-1][1].append(a)
        else:
            out.append((max(1, int(_MAX_EXP / _decay(a))), [a]))
    return out


def ewm_columns(df: DataFrame, layout: SeriesLayout, specs: dict) -> DataFrame:
    """Add EWM columns. ``specs``: ``{out_name: (input, alpha[, counter])}``; a
    ``counter`` names a column that is null exactly where the input is, so that
    inputs with the same gaps share one numbering.

    An EWM of an EWM (MACD signal) needs a second call.
    """
    W = layout.window()
    upto = W.rowsBetween(Window.unboundedPreceding, 0)
    before = W.rowsBetween(Window.unboundedPreceding, -1)
    own = F.col("_own") if layout.blocked else None
    keep = list(df.columns)

    # inputs and observation numbers (1, 2, ...) per counter
    counters: dict[str, str] = {}
    step = {}
    for n, (x, _, *counter) in specs.items():
        x = (F.col(x) if isinstance(x, str) else x).cast("double")
        step[f"_x_{n}"] = x if own is None else F.when(own, x)
        counters[n] = counter[0] if counter else f"_x_{n}"
    df = df.withColumns(step)
    number: dict[str, str] = {}
    step = {}
    for n, c in counters.items():
        if c not in number:
            number[c] = f"_n_{len(number)}"
            step[number[c]] = F.count(f"_x_{n}").over(upto)
    df = df.withColumns(step)

    # local value of every observation, from sub-block sums
    lengths = {a: (i, S) for i, (S, group) in
               enumerate(sub_blocks(a for _, a, *_ in specs.values())) for a in group}
    step = {}
    for n, (_, alpha, *_) in specs.items():
        i, S = lengths[alpha]
        step[f"_b_{i}{number[counters[n]]}"] = F.floor((F.col(number[counters[n]]) - 1) / F.lit(S))
    df = df.withColumns(step)
    step = {}
    for n, (_, alpha, *_) in specs.items():
        i, S = lengths[alpha]
        la, num = -_decay(alpha), F.col(number[counters[n]])
        blk = f"_b_{i}{number[counters[n]]}"
        c = num - F.col(blk) * S   # 1 .. S within the sub-block
        inside = layout.sub_window(blk).rowsBetween(Window.unboundedPreceding, 0)
        term = F.lit(alpha) * F.col(f"_x_{n}") * F.exp(-(c - 1) * F.lit(la))
        step[f"_l_{n}"] = F.when(F.col(f"_x_{n}").isNotNull(),
                                 F.exp((c - 1) * F.lit(la)) * F.sum(term).over(inside))
    df = df.withColumns(step)
    step = {}
    for n, (_, alpha, *_) in specs.items():
        i, S = lengths[alpha]
        la, num = -_decay(alpha), F.col(number[counters[n]])
        c = num - F.col(f"_b_{i}{number[counters[n]]}") * S
        end = F.when(c == S, F.col(f"_l_{n}"))   # null unless an observation
        carry = F.coalesce(F.last(end, ignorenulls=True).over(before), F.lit(0.0))
        step[f"_l_{n}"] = F.col(f"_l_{n}") + F.exp(c * F.lit(la)) * carry
    df = df.withColumns(step)

    if layout.blocked:
        df = _with_states(materialize(df), layout, specs, number, counters)
        state = {n: F.col(f"_s_{n}") for n in specs}
    else:
        state = {n: F.first(f"_x_{n}", ignorenulls=True).over(upto) for n in specs}
    step = {}
    for n, (_, alpha, *_) in specs.items():
        num = F.col(number[counters[n]])
        step[f"_l_{n}"] = F.col(f"_l_{n}") + F.exp(num * F.lit(-_decay(alpha))) * state[n]
    df = df.withColumns(step)
    # rows without an observation carry the last value
    step = {}
    for n in specs:
        y = F.last(f"_l_{n}", ignorenulls=True).over(upto)
        step[n] = F.coalesce(y, F.col(f"_s_{n}")) if layout.blocked else y
    if layout.blocked:  # before the first observation of the series there is no value
        for n in specs:
            step[n] = F.when(F.col(f"_any_{n}") | (F.col(number[counters[n]]) > 0), step[n])
    return df.withColumns(step).select(*[c for c in keep if c not in specs], *specs)


#: Blocks whose states one task scans.
SUPER_BLOCKS = 4096


def _with_states(df: DataFrame, layout: SeriesLayout, specs: dict, number: dict,
                 counters: dict, super_blocks: int | None = None) -> DataFrame:
    """``_s_<out>``: the state that enters each block; ``_any_<out>``: whether
    earlier blocks hold an observation.

    A block maps the state that enters it to ``state * a^d + l`` (``d``
    observations, ``l`` its end value from an empty state). These pairs compose
    associatively, so they are scanned on two levels: over the blocks of a
    superblock, then over superblocks. No window holds more than
    ``super_blocks`` summary rows, or one row per superblock of a series.
    """
    key = layout.key
    own = df.filter("_own")
    aggs = []
    for n in specs:
        seen = F.col(f"_x_{n}").isNotNull()
        aggs += [F.coalesce(F.max_by(f"_l_{n}", F.when(seen, F.col("_rn"))), F.lit(0.0))
                 .alias(f"_end_{n}"),
                 F.count(f"_x_{n}").alias(f"_obs_{n}"),
                 F.min_by(f"_x_{n}", F.when(seen, F.col("_rn"))).alias(f"_first_{n}")]
    blocks = own.groupBy(key, "_blk").agg(*aggs).withColumn(
        "_sup", F.floor(F.col("_blk") / F.lit(super_blocks or SUPER_BLOCKS)))
    decay = {n: _decay(alpha) for n, (_, alpha, *_) in specs.items()}
    blocks = materialize(prefix_states(blocks, [key, "_sup"], "_blk", decay))
    supers = blocks.groupBy(key, "_sup").agg(*[x for n in specs for x in (
        F.sum(f"_obs_{n}").alias(f"_obs_{n}"), F.max_by(f"_y_{n}", "_blk").alias(f"_end_{n}"),
        F.min_by(f"_first_{n}", F.when(F.col(f"_first_{n}").isNotNull(), F.col("_blk")))
        .alias(f"_first_{n}"))])
    upto = Window.partitionBy(key).orderBy("_sup").rowsBetween(Window.unboundedPreceding, 0)
    supers = prefix_states(supers, [key], "_sup", decay).select(
        key, "_sup", *[x for n in specs for x in (
            F.col(f"_before_{n}").alias(f"_sup_before_{n}"),
            F.col(f"_state_{n}").alias(f"_sup_state_{n}"),
            F.first(f"_first_{n}", ignorenulls=True).over(upto).alias(f"_start_{n}"))])
    cols = [key, "_blk"]
    for n, la in decay.items():
        # until the series' first observation nothing decays: its state is that value
        into = F.col(f"_sup_state_{n}") + F.exp(F.col(f"_sup_before_{n}") * F.lit(-la)) * F.col(f"_start_{n}")
        cols += [(F.col(f"_state_{n}") + F.exp(F.col(f"_before_{n}") * F.lit(-la)) * into).alias(f"_s_{n}"),
                 (F.col(f"_before_{n}") + F.col(f"_sup_before_{n}") > 0).alias(f"_any_{n}")]
    return df.join(blocks.join(supers, [key, "_sup"]).select(*cols), [key, "_blk"])


def prefix_states(df: DataFrame, part: list[str], order: str, decay: dict) -> DataFrame:
    """Scan of affine maps, linear in the rows. Row i of a partition holds, per
    name, ``_obs_`` (d) and ``_end_`` (l) of the map ``s -> s * e^(-decay d) + l``. Adds
    ``_y_`` (the maps up to row i applied to 0), ``_state_`` (those before row i) and
    ``_before_`` (the observations before row i).

    As in the rows' scan, observations are cut into stretches of S with
    ``37 <= S * decay <= 500``: a closed form inside a stretch, and as carry the
    last value of the stretch before, because older ones are below double
    precision. A row whose map spans several stretches only hastens that.
    """
    W = Window.partitionBy(*part).orderBy(order)
    upto = W.rowsBetween(Window.unboundedPreceding, 0)
    before = W.rowsBetween(Window.unboundedPreceding, -1)
    keep = list(df.columns)
    df = df.withColumns({f"_d_{n}": F.sum(f"_obs_{n}").over(upto).cast("double") for n in decay})
    step = {}
    for n, la in decay.items():
        S = max(1, int(_MAX_EXP / la))
        step[f"_g_{n}"] = F.floor(F.greatest(F.col(f"_d_{n}") - 1, F.lit(0)) / F.lit(S))
    df = df.withColumns(step)
    for n, la in decay.items():
        S = max(1, int(_MAX_EXP / la))
        c = F.col(f"_d_{n}") - F.col(f"_g_{n}") * F.lit(S)
        inside = (Window.partitionBy(*part, f"_g_{n}").orderBy(order)
                  .rowsBetween(Window.unboundedPreceding, 0))
        df = df.withColumn(f"_y_{n}", F.exp(c * F.lit(-la)) * F.sum(
            F.col(f"_end_{n}") * F.exp(c * F.lit(la))).over(inside))
    step = {}
    for n in decay:
        ends = F.lead(f"_g_{n}").over(W) != F.col(f"_g_{n}")
        step[f"_e_{n}"] = F.when(ends, F.struct(F.col(f"_d_{n}").alias("d"), F.col(f"_y_{n}").alias("y")))
    df = df.withColumns(step)
    step = {n: F.last(f"_e_{n}", ignorenulls=True).over(before) for n in decay}
    df = df.withColumns({f"_p_{n}": c for n, c in step.items()})
    df = df.withColumns({f"_y_{n}": F.col(f"_y_{n}") + F.coalesce(
        F.exp((F.col(f"_d_{n}") - F.col(f"_p_{n}.d")) * F.lit(-la)) * F.col(f"_p_{n}.y"), F.lit(0.0))
        for n, la in decay.items()})
    return df.select(*keep, *[f"_y_{n}" for n in decay], *[x for n in decay for x in (
        F.coalesce(F.lag(f"_y_{n}").over(W), F.lit(0.0)).alias(f"_state_{n}"),
        F.coalesce(F.lag(f"_d_{n}").over(W), F.lit(0.0)).alias(f"_before_{n}"))])
