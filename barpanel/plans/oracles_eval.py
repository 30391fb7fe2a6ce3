"""DuckDB oracles for P5-P13, A, K and H."""

from __future__ import annotations

import math

from barpanel.constants import FEATURE_COLS
from barpanel.operators.metrics import linear_weights
from barpanel.plans.oracles import oracle
from barpanel.plans.present import METRIC, RATIO, sql_date
from barpanel.plans.sqlparts import PANEL_DAILY, features_ctes, pipeline_sql, split_ctes

WINDOW = 30
N_TRIALS = 40
MOM_NS = list(range(2, 21))
SQRT252 = repr(math.sqrt(252))
_W = "[" + ", ".join(repr(x) for x in linear_weights(WINDOW)) + "]::double[]"

_SCORES = f""", scz as (select ticker, split, date, y::int as y,
  list_dot_product(list_transform(flatten(seq), lambda x: x::double), {_W}) as z from sq),
scores as (select ticker, split, date, y, 1.0 / (1.0 + exp(-z)) as p,
  (1.0 / (1.0 + exp(-z)) >= 0.5)::int as pred from scz)"""


def _seq_sql(final: str) -> str:
    return pipeline_sql(final)


def _score_sql(final: str) -> str:
    base = pipeline_sql("")
    return base.rstrip() + _SCORES + "\n" + final


# P ---------------------------------------------------------------------------
oracle("to_float32_int64", _seq_sql(f"""select ticker, split, {sql_date()},
  round(seq[1][1]::double, {RATIO}) as x_first, y::bigint as y from sq"""))
oracle("flatten_window", _seq_sql(f"""select ticker, split, {sql_date()},
  len(flatten(seq))::int as n_flat, round(flatten(seq)[271]::double, {RATIO}) as flat_271,
  round(flatten(seq)[-1]::double, {RATIO}) as flat_last from sq"""))
oracle("seq_last_step", _seq_sql(f"""select ticker, split, {sql_date()},
  round(seq[-1][4]::double, {RATIO}) as last_close, round(seq[-1][13]::double, {RATIO}) as last_rsi,
  round(seq[-1][18]::double, {RATIO}) as last_volume_norm from sq"""))
oracle("seq_mean_pool", _seq_sql(f"""select ticker, split, {sql_date()},
  round(list_sum(list_transform(seq, lambda s: s[4]::double)) / len(seq), {RATIO}) as mean_close,
  round(list_sum(list_transform(seq, lambda s: s[13]::double)) / len(seq), {RATIO}) as mean_rsi from sq"""))

_m = "greatest(" + ", ".join(FEATURE_COLS) + ")"
_e = [f"exp({c} - m)" for c in FEATURE_COLS]
_tot = " + ".join(f"e{i}" for i in range(len(FEATURE_COLS)))
_sm = f""", sm0 as (select ticker, date, {', '.join(FEATURE_COLS)}, {_m} as m from sc),
sm1 as (select *, {', '.join(f'{e} as e{i}' for i, e in enumerate(_e))} from sm0),
sm2 as (select *, {_tot} as tot from sm1)"""
_argmax = "case " + " ".join(f"when {c} = m then {i + 1}" for i, c in enumerate(FEATURE_COLS)) + " end"
oracle("softmax_weights", pipeline_sql("", upto="sc").rstrip() + _sm + f"""
select ticker, {sql_date()}, round(1.0 / tot, {RATIO}) as w_max,
  round({' + '.join(f'e{i} / tot' for i in range(len(FEATURE_COLS)))}, {RATIO}) as w_sum,
  ({_argmax})::int as w_argmax from sm2""")
oracle("weighted_combine", pipeline_sql("", upto="sc").rstrip() + _sm + f"""
select ticker, {sql_date()},
  round({' + '.join(f'(e{i} / tot) * {c}' for i, c in enumerate(FEATURE_COLS))}, {RATIO}) as combined from sm2""")
oracle("threshold_label", _score_sql(f"select ticker, split, {sql_date()}, round(p, {RATIO}) as p, pred from scores"))
oracle("direction_signal", _score_sql(f"""select ticker, split, {sql_date()},
  (2.0 * pred - 1.0)::double as signal, ((2.0 * pred - 1.0) * (2.0 * y - 1.0))::double as realised from scores"""))
oracle("linear_score", _score_sql(f"select ticker, split, {sql_date()}, y, round(p, {RATIO}) as p from scores"))

# A ---------------------------------------------------------------------------
_R = "(2.0 * pred - 1.0) * (2.0 * y - 1.0)"
_DA = "avg((pred = y)::double)"
_MAE = "avg(abs(p - y))"
_RMSE = "sqrt(avg(pow(p - y, 2)))"
_SH = f"case when stddev_pop({_R}) > 0 then avg({_R}) / stddev_pop({_R}) * {SQRT252} else 0.0 end"
_LL = ("-avg(y * ln(least(greatest(p, 1e-15), 1 - 1e-15)) + (1 - y) * "
       "ln(1 - least(greatest(p, 1e-15), 1 - 1e-15)))")
for name, expr in (("directional_accuracy", _DA), ("mae", _MAE), ("rmse", _RMSE),
                   ("sharpe_ratio", _SH), ("log_loss", _LL)):
    oracle(name, _score_sql(f"select ticker, split, round({expr}, {METRIC}) as {name} "
                            "from scores group by ticker, split"))
_EVAL = (f"ev as (select ticker, split, count(*)::bigint as n, round({_DA}, 4) as directional_accuracy, "
         f"round({_MAE}, 4) as mae, round({_RMSE}, 4) as rmse, round({_SH}, 4) as sharpe_ratio "
         "from scores group by ticker, split)")
oracle("evaluate_all", _score_sql(f", {_EVAL}\nselect 'linear' as model, * from ev").replace(
    "\n, ev as", ", ev as"))
_long = " union all ".join(
    f"select ticker, split || '_{m}' as key, {m} as value from ev"
    for m in ("directional_accuracy", "mae", "rmse", "sharpe_ratio"))
oracle("metrics_long", _score_sql(f", {_EVAL}\n{_long}"))
oracle("result_table", _score_sql(f""", {_EVAL}
select ticker, n,
  round(round(directional_accuracy, 4)::decimal(20,6) * 100, 1)::decimal(20,1)::varchar || '%' as accuracy,
  round(round(sharpe_ratio, 4)::decimal(20,6), 2)::decimal(20,2)::varchar as sharpe,
  round(mae, 4)::decimal(20,4)::varchar as mae, round(rmse, 4)::decimal(20,4)::varchar as rmse
from ev where split = 'test'"""))
oracle("class_balance", _seq_sql("""select ticker, sum((y = 0)::bigint)::bigint as n_neg,
  sum((y = 1)::bigint)::bigint as n_pos,
  round(case when sum((y = 1)::bigint) > 0 then sum((y = 0)::bigint) / sum((y = 1)::bigint) else 1.0 end, 6)
    as scale_pos_weight from sq where split = 'train' group by ticker"""))
_names = ", ".join(f"({i + 1}, '{c}')" for i, c in enumerate(FEATURE_COLS))
oracle("feature_importance_mean", _seq_sql(f"""
, s1 as (select row_number() over () as rid, seq from sq),
s2 as (select rid, unnest(seq) as step, generate_subscripts(seq, 1) as t from s1),
s3 as (select rid, t, unnest(step)::double as v, generate_subscripts(step, 1) as f from s2),
s4 as (select rid, t, f, exp(v - max(v) over (partition by rid, t)) as e from s3),
s5 as (select f, e / sum(e) over (partition by rid, t) as w from s4),
nm(f, feature) as (values {_names})
select feature, round(avg(w), {RATIO}) as importance from s5 join nm using (f) group by feature""".replace(
    "\n, s1", ", s1")))

# K1 --------------------------------------------------------------------------
oracle("sort_panel", f"""with p as ({PANEL_DAILY})
select ticker, {sql_date()}, (row_number() over (partition by ticker order by date) - 1)::bigint as pos from p""")


# H ---------------------------------------------------------------------------
# Written out from the definition; no constant is shared with the code.
def _u(parameter: str) -> str:
    text = f"study || '|' || trial || '|{parameter}|42'"
    return f"(('0x' || substr(md5({text}), 1, 8))::bigint / 4294967296.0::double)"


def _int(parameter, lo, hi):
    return f"({lo} + floor({_u(parameter)} * {hi - lo + 1}))::int"


def _real(parameter, lo, hi):
    return f"({lo!r}::double + {_u(parameter)} * {hi - lo!r}::double)"


def _log(parameter, lo, hi):
    return f"exp({math.log(lo)!r}::double + {_u(parameter)} * {math.log(hi) - math.log(lo)!r}::double)"


def _cat(parameter, choices):
    items = ", ".join(repr(c) for c in choices)
    return f"([{items}])[floor({_u(parameter)} * {len(choices)})::int + 1]"


_TRIALS = f"""studies as (select o_orderpriority as study,
  count(distinct cast(o_orderdate as date))::bigint as n_bars from orders group by 1),
tr as (select study, n_bars, t::bigint as trial from studies, range(0, {N_TRIALS}) r(t))"""
TRIALS_CTE = f"""{_TRIALS},
tp as (select study, n_bars, trial, {_int('n_mom', 2, 20)} as n_mom, {_real('thr', -0.02, 0.02)} as thr,
  {_log('scale', 0.001, 0.1)} as scale, {_cat('side', ['long', 'contrarian'])} as side from tr)"""

oracle("sample_trials", f"""with {TRIALS_CTE}
select study, trial, n_bars, n_mom, round(thr, 8) as thr, round(scale, 8) as scale, side from tp""")

_INTS = ("n_estimators max_depth min_child_weight hidden_size num_layers num_channels kernel_size "
         "receptive_field n_heads d_model lstm_layers batch_size epochs patience random_state "
         "early_stopping_rounds").split()
_REALS = ("learning_rate subsample colsample_bytree gamma reg_alpha reg_lambda dropout "
          "grad_clip").split()
_NET = {"learning_rate": _log("learning_rate", 1e-4, 1e-2),
        "batch_size": _cat("batch_size", [32, 64, 128]), "grad_clip": _real("grad_clip", 0.5, 5.0)}
_LEVELS = _int("n_dilation_levels", 3, 6)
_KERNEL = _cat("kernel_size", [2, 3, 5])
_HEADS = _cat("n_heads", [2, 4, 8])
_MODELS = {
    "xgboost": {"n_estimators": _int("n_estimators", 100, 500), "max_depth": _int("max_depth", 3, 8),
                "learning_rate": _log("learning_rate", 1e-3, 0.3),
                "subsample": _real("subsample", 0.6, 1.0),
                "colsample_bytree": _real("colsample_bytree", 0.6, 1.0),
                "min_child_weight": _int("min_child_weight", 1, 10),
                "gamma": _real("gamma", 0.0, 1.0), "reg_alpha": _log("reg_alpha", 1e-4, 10.0),
                "reg_lambda": _log("reg_lambda", 1e-4, 10.0), "early_stopping_rounds": "30"},
    "lstm": {**_NET, "hidden_size": _cat("hidden_size", [32, 64, 128, 256]),
             "num_layers": _int("num_layers", 1, 3), "dropout": _real("dropout", 0.0, 0.5)},
    "tcn": {**_NET, "num_channels": _cat("num_channels", [32, 64, 128]), "kernel_size": _KERNEL,
            "dropout": _real("dropout", 0.0, 0.5),
            "dilations": f"array_to_string(list_transform(range({_LEVELS}), "
                         "lambda i: (1 << i)::varchar), ',')",
            "receptive_field": f"(({_KERNEL}) - 1) * ((1 << {_LEVELS}) - 1) + 1"},
    "tft": {**_NET, "n_heads": _HEADS, "d_model": f"{_HEADS} * 8 * {_int('d_model_factor', 1, 4)}",
            "lstm_layers": _int("lstm_layers", 1, 2), "dropout": _real("dropout", 0.0, 0.4)},
}


def _model_sql(model: str, cols: dict) -> str:
    cols = {**cols, "epochs": "50", "patience": "10", "random_state": "42"}
    parts = [f"({cols.get(c, 'null')})::int as {c}" for c in _INTS]
    parts += [f"round(({cols.get(c, 'null')})::double, {RATIO}) as {c}" for c in _REALS]
    return (f"select study, trial, n_bars, '{model}' as model, ({cols.get('dilations', 'null')})::varchar "
            f"as dilations, {', '.join(parts)} from tr")


oracle("derived_params", f"with {_TRIALS}\n"
       + "\nunion all\n".join(_model_sql(k, c) for k, c in _MODELS.items()))

_moms = ", ".join(f"close / lag(close, {n}) over w - 1" for n in MOM_NS)
_mom_list = "[" + ", ".join(f"mom_{n}" for n in MOM_NS) + "]"
SEARCH_CTES = (features_ctes(PANEL_DAILY) + ",\n" + split_ctes() + f""",
mom as (select ticker, date, [{_moms}] as moms from fx_p window w as (partition by ticker order by date)),
rows as (select sp.ticker, sp.date, sp.split, sp.target::double as y, moms from sp join mom using (ticker, date)),
{TRIALS_CTE},
tv as (select t.study, t.trial, t.n_mom, t.thr, t.scale, t.side, r.split, r.y,
  1.0 / (1.0 + exp(-((moms[t.n_mom - 1] - t.thr) / t.scale))) as pl
  from rows r join tp t on t.study = r.ticker),
tq as (select *, case when side = 'contrarian' then 1.0 - pl else pl end as p from tv),
tz as (select *, (p >= 0.5)::double as pred from tq),
res as (select study, trial, split, avg((pred = y)::double) as value, avg(abs(p - y)) as val_mae,
  case when stddev_pop({_R}) > 0 then avg({_R}) / stddev_pop({_R}) * {SQRT252} else 0.0 end as val_sharpe,
  count(*) as n, sqrt(avg(pow(p - y, 2))) as rmse
  from tz group by study, trial, split),
val as (select * from res where split = 'val'),
best as (select * from (select *, row_number() over (partition by study order by value desc, trial) as k,
  count(*) over (partition by study) as n_trials from val) where k = 1),
test as (select r.* from res r join best b on r.study = b.study and r.trial = b.trial where r.split = 'test')""")

_RES = f"""select study, trial, round(value, {METRIC}) as value, round(val_sharpe, {METRIC}) as val_sharpe,
  round(val_mae, {METRIC}) as val_mae from val"""
oracle("evaluate_trials", f"with {SEARCH_CTES}\n{_RES}")
oracle("resume_study", f"with {SEARCH_CTES}\n{_RES}")
oracle("best_trial", f"""with {SEARCH_CTES}
select study, trial, round(value, {METRIC}) as value, n_trials::bigint as n_trials from best""")
oracle("best_on_test", f"""with {SEARCH_CTES}
select study as ticker, split, n::bigint as n, round(value, 4) as directional_accuracy,
  round(val_mae, 4) as mae, round(rmse, 4) as rmse, round(val_sharpe, 4) as sharpe_ratio from test""")
oracle("study_leaderboard", f"""with {SEARCH_CTES}
select 'momentum' as model, b.study, b.trial as best_trial, round(b.value, {METRIC}) as best_value,
  b.n_trials::bigint as n_trials, round(t.value, 4) as test_directional_accuracy,
  round(t.val_mae, 4) as test_mae, round(t.rmse, 4) as test_rmse,
  round(t.val_sharpe, 4) as test_sharpe_ratio from best b join test t using (study)""")
oracle("early_stop_round", f"""with recursive {SEARCH_CTES},
curve as (select study as run, trial as step, 1.0 - value as v from val),
st as (select run, step, v as best, step as best_step, 0 as wait, false as stopped from curve where step = 0
  union all
  select c.run, c.step,
    case when c.v < s.best - 1e-4 then c.v else s.best end,
    case when c.v < s.best - 1e-4 then c.step else s.best_step end,
    case when c.v < s.best - 1e-4 then 0 else s.wait + 1 end,
    (case when c.v < s.best - 1e-4 then 0 else s.wait + 1 end) >= {10}
  from st s join curve c on c.run = s.run and c.step = s.step + 1 where not s.stopped),
last as (select *, row_number() over (partition by run order by step desc) as k from st)
select run, step::bigint as stop_step, best_step::bigint as best_step, round(best, {METRIC}) as best_val,
  stopped as stopped_early from last where k = 1""")

_FEATURE_LIST = '["' + '", "'.join(FEATURE_COLS) + '"]'
oracle("run_log", _score_sql(f""", {_EVAL}
select 'linear-all' as run, 'train' as kind, key, null::int as step, value::double as value, text from (
  select 'param.' || k as key, v as value, t as text from (values ('model', null, 'linear'),
    ('asset', null, 'all'), ('window', 30.0, null), ('n_features', 18.0, null),
    ('features', null, '{_FEATURE_LIST}'), ('shuffle', null, 'false')) x(k, v, t)
  union all select 'count.' || ticker || '.n_' || split, n, null from ev
  union all select 'metric.' || ticker || '.' || key, value, null from ({_long}))"""))
oracle("model_registry", _seq_sql("""select name, name as kind, split, count(*)::bigint as n_windows
from sq, (values ('gbt'), ('mlp')) m(name) group by name, split"""))

oracle("run_log_retries", pipeline_sql("""select r.run_id, k.key, k.value from
  (select unnest(['run-1', 'run-2']) as run_id) r,
  (select 'param.window' as key, 30.0::double as value
   union all select 'count.' || ticker || '.n_' || split, count(*)::double from sq
   group by ticker, split) k"""))
