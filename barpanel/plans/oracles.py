"""DuckDB oracle SQL, one statement per registered query (same column names,
same rounding). Built from ``plans.sqlparts``; see there for the EWM form."""

from __future__ import annotations

from barpanel.constants import FEATURE_COLS
from barpanel.plans.present import RATIO, sql_date, sql_round
from barpanel.plans.sqlparts import (PANEL_DAILY, ewm_sql, features_ctes,
                                     pipeline_sql)

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


FX = features_ctes(PANEL_DAILY)
WU = "window wu as (partition by ticker order by date rows between unbounded preceding and current row)"


def _fx_select(cols, src="fx_all", extra_from="") -> str:
    sel = ", ".join(sql_round(c) for c in cols)
    return f"with {FX}\nselect ticker, {sql_date()}, {sel} from {src} {extra_from}"


# W / P ----------------------------------------------------------------------
oracle("lag_lead", f"""with p as ({PANEL_DAILY})
select ticker, {sql_date()}, round(close, 4) as close,
  round(lag(close) over w, 4) as prev_close, round(lead(close) over w, 4) as next_close
from p window w as (partition by ticker order by date)""")
oracle("log_return", _fx_select(["log_return"]))
oracle("gain_loss", _fx_select(["delta", "gain", "loss"]))
oracle("sma", _fx_select(["sma_10", "sma_20", "sma_50"]))
oracle("sma_ratio", _fx_select(["sma_10_ratio", "sma_20_ratio", "sma_50_ratio"]))
oracle("ewm_mean", f"""with p as ({PANEL_DAILY}),
r as (select *, row_number() over (partition by ticker order by date) - 1 as rn from p)
select ticker, {sql_date()},
  round({ewm_sql('volume', 'rn', 1 / 14)}, {RATIO}) as ewm_com13,
  round({ewm_sql('volume', 'rn', 2 / 6)}, {RATIO}) as ewm_span5,
  round({ewm_sql('volume', 'rn', 0.3)}, {RATIO}) as ewm_a03
from r {WU}""")
oracle("ema_12_26", _fx_select(["ema_12", "ema_26"]))
oracle("macd", _fx_select(["macd", "macd_signal", "macd_hist"]))
oracle("rsi_14", _fx_select(["rsi_14"]))
oracle("volatility_20", _fx_select(["volatility_20"]))
oracle("volume_norm", _fx_select(["volume_norm"]))
oracle("target_next_up", f"with {FX}\nselect ticker, {sql_date()}, target from fx_all")

_T1 = ("0.25 * coalesce(lag(log_return, 2) over w, 0) - 0.5 * coalesce(lag(log_return, 1) over w, 0)"
       " + 1.0 * coalesce(log_return, 0)")
_T2 = ("0.25 * coalesce(lag(tcn_d1, 4) over w, 0) - 0.5 * coalesce(lag(tcn_d1, 2) over w, 0)"
       " + 1.0 * coalesce(tcn_d1, 0)")
oracle("causal_dilated_filter", f"""with {FX},
t1 as (select ticker, date, {_T1} as tcn_d1 from fx_all window w as (partition by ticker order by date)),
t2 as (select ticker, date, tcn_d1, {_T2} as tcn_d2 from t1 window w as (partition by ticker order by date))
select ticker, {sql_date()}, round(tcn_d1, {RATIO}) as tcn_d1, round(tcn_d2, {RATIO}) as tcn_d2 from t2""")

# F ----------------------------------------------------------------------------
oracle("feature_frame", f"with {FX}\nselect ticker, {sql_date()}, "
       + ", ".join(sql_round(c) for c in FEATURE_COLS) + ", target from fx")
oracle("warmup_report", f"""with {FX}
select ticker, count(*)::bigint as n_before,
  sum(case when {' and '.join(f'{c} is not null' for c in FEATURE_COLS + ['target'])} then 1 else 0 end)::bigint as n_kept,
  (count(*) - sum(case when {' and '.join(f'{c} is not null' for c in FEATURE_COLS + ['target'])} then 1 else 0 end))::bigint as n_dropped
from fx_all group by ticker""")
oracle("chrono_split", pipeline_sql(
    f"select ticker, {sql_date()}, split, pos::bigint as pos, n::bigint as n from sp", upto="sp"))
REQUESTED = ("(select distinct o_orderpriority as ticker from orders"
             " union all select '9.ABSENT')")
REQUESTED_SPLITS = f"(select ticker, unnest(['train', 'val', 'test']) as split from {REQUESTED})"
_LEAK = f"""leak as (select q.ticker, max(case when split = 'train' then date end) as train_max,
  min(case when split = 'val' then date end) as val_min,
  max(case when split = 'val' then date end) as val_max,
  min(case when split = 'test' then date end) as test_min
  from {REQUESTED} q left join sp using (ticker) group by q.ticker)"""
oracle("leakage_check", pipeline_sql(f""", {_LEAK}
select ticker, strftime(train_max, '%Y-%m-%d') as train_max, strftime(val_min, '%Y-%m-%d') as val_min,
  strftime(val_max, '%Y-%m-%d') as val_max, strftime(test_min, '%Y-%m-%d') as test_min,
  coalesce(train_max < val_min and val_max < test_min, false) as ok from leak""", upto="sp"))
oracle("split_report", pipeline_sql(f"""select q.ticker, q.split, count(sp.ticker)::bigint as n_rows,
  {sql_date('start', 'min(date)')}, {sql_date('end', 'max(date)')}
from {REQUESTED_SPLITS} q left join sp using (ticker, split) group by all""", upto="sp"))

_unpivot = " union all ".join(
    f"select ticker, '{c}' as feature, round(min_{c}, {RATIO}) as min, round(max_{c}, {RATIO}) as max from sc_par"
    for c in FEATURE_COLS)
oracle("fit_minmax", pipeline_sql(_unpivot, upto="sc"))
oracle("normalize_splits", pipeline_sql(
    f"select ticker, {sql_date()}, split, "
    + ", ".join(f"round({c}, {RATIO}) as {c}" for c in FEATURE_COLS)
    + ", target from sc", upto="sc"))
_below = " + ".join(f"({c} < 0)::int" for c in FEATURE_COLS)
_above = " + ".join(f"({c} > 1)::int" for c in FEATURE_COLS)
oracle("minmax_transform", pipeline_sql(
    "select ticker, split, "
    + ", ".join(f"round(min({c}), {RATIO}) as min_{c}, round(max({c}), {RATIO}) as max_{c}"
                for c in ("close", "rsi_14", "volume"))
    + f", sum({_below})::bigint as n_below_0, sum({_above})::bigint as n_above_1"
    " from sc group by ticker, split", upto="sc"))
oracle("sliding_sequences", pipeline_sql(f"""select ticker, split, {sql_date()},
  len(seq)::int as n_steps, round(seq[1][4]::double, {RATIO}) as first_close,
  round(seq[-1][4]::double, {RATIO}) as last_close,
  round(list_sum(list_transform(flatten(seq), lambda x: x::double)), 3) as seq_sum, y from sq"""))
oracle("sequence_report", pipeline_sql(f"""select q.ticker, q.split, count(seq)::bigint as n_seq,
  coalesce(max(len(seq)), 30)::int as window, coalesce(max(len(seq[1])), 18)::int as n_features
from {REQUESTED_SPLITS} q left join sq using (ticker, split) group by all"""))
oracle("prepare_panel", pipeline_sql(f""", {_LEAK}
select q.ticker, q.split, count(seq)::bigint as n_seq, max(len(seq))::int as window,
  max(len(seq[1]))::int as n_features, coalesce(sum(y), 0)::bigint as n_up,
  {sql_date('first_date', 'min(date)')}, {sql_date('last_date', 'max(date)')},
  max(case when train_max < val_min and val_max < test_min then 'OK' else 'FAIL' end) as status
from {REQUESTED_SPLITS} q left join sq using (ticker, split) left join leak using (ticker)
group by q.ticker, q.split"""))
oracle("scaler_store", ORACLES["normalize_splits"])
