"""DuckDB oracles for the Q (quality / cleaning) and S (source / sink) queries."""

from __future__ import annotations

from barpanel.constants import FEATURE_COLS
from barpanel.plans.oracles import ORACLES, REQUESTED, oracle
from barpanel.plans.present import RATIO, sql_date, sql_round
from barpanel.plans.sqlparts import (PANEL_DAILY, PANEL_DIRTY, PANEL_HOURLY, features_ctes,
                                     pipeline_sql)

_D = f"with d as ({PANEL_DIRTY})"
_P4 = ", ".join(f"round({c}, 4) as {c}" for c in ("open", "high", "low", "close"))
_NOT_ALL_NULL = "not (open is null and high is null and low is null and close is null)"
_FF = ", ".join(
    f"last_value({c} ignore nulls) over (partition by ticker order by seq rows between unbounded preceding and current row) as {c}"
    for c in ("open", "high", "low", "close"))
_BF = ", ".join(
    f"coalesce({c}, first_value({c} ignore nulls) over (partition by ticker order by seq rows between current row and unbounded following)) as {c}"
    for c in ("open", "high", "low", "close"))
_RATES = ", ".join(f"round(avg(({c} is null)::int), {RATIO}) as null_{c}"
                   for c in ("open", "high", "low", "close", "volume"))
_WORST = "greatest(" + ", ".join(f"avg(({c} is null)::int)" for c in ("open", "high", "low", "close", "volume")) + ")"

oracle("null_rate", f"{_D}\nselect ticker, count(*)::bigint as n_rows, {_RATES} from d group by ticker")
_GATE = f"""g as (select ticker, count(*)::bigint as n_rows, {_WORST} as worst from d group by ticker),
gate as (select ticker, coalesce(n_rows, 0) as n_rows, worst,
  coalesce(n_rows > 0 and worst <= 0.05, false) as ok from {REQUESTED} q left join g using (ticker))"""
oracle("validate_gate", f"""{_D}, {_GATE}
select ticker, n_rows, round(worst, {RATIO}) as max_null_rate, ok from gate""")
oracle("drop_all_null_ohlc", f"""{_D}
select ticker, {sql_date()}, seq, rev, {_P4}, round(volume, 4) as volume from d where {_NOT_ALL_NULL}""")
oracle("ffill", f"""{_D}, q3 as (select * from d where {_NOT_ALL_NULL}),
q4 as (select ticker, seq, date, {_FF} from q3)
select ticker, seq, {sql_date()}, {_P4} from q4""")
oracle("bfill", f"""{_D}, q3 as (select * from d where {_NOT_ALL_NULL}),
q4 as (select ticker, seq, date, {_FF} from q3),
q5 as (select ticker, seq, date, {_BF} from q4)
select ticker, seq, {sql_date()}, {_P4} from q5""")
oracle("volume_fill", f"""{_D}
select ticker, seq, coalesce(volume, 0)::bigint as volume from d where {_NOT_ALL_NULL}""")
oracle("dedup_first", f"""{_D}, k as (select *, row_number() over (partition by ticker, date order by seq) as k from d)
select ticker, {sql_date()}, seq, rev, round(close, 4) as close from k where k = 1""")

CLEAN_SQL = f"""q3 as (select * from d where {_NOT_ALL_NULL}),
q4 as (select ticker, seq, date, {_FF}, volume from q3),
q5 as (select ticker, seq, date, {_BF}, volume from q4),
q6 as (select ticker, seq, date, open, high, low, close, trunc(coalesce(volume, 0))::bigint as volume from q5),
q7 as (select *, row_number() over (partition by ticker, date order by seq) as k from q6),
clean as (select ticker, date, open, high, low, close, volume from q7 where k = 1)"""
oracle("clean_panel", f"""{_D}, {CLEAN_SQL}
select ticker, {sql_date()}, {_P4}, volume from clean""")

# S ---------------------------------------------------------------------------
oracle("scan_panel", f"""with p as ({PANEL_DAILY})
select ticker, {sql_date()}, {_P4}, volume from p
where ticker in ('1-URGENT', '3-MEDIUM') and date >= date '1996-01-01' and date < date '1999-01-01'""")
oracle("tag_union_panel", f"""with o as (select 'ORDERS' as ticker, cast(o_orderdate as date) as date,
  arg_min(o_totalprice, o_orderkey) as open, max(o_totalprice) as high, min(o_totalprice) as low,
  arg_max(o_totalprice, o_orderkey) as close, count(*)::bigint as volume from orders group by 2),
e as (select 'EVENTS' as ticker, cast(ts as date) as date,
  arg_min(value, event_id) as open, max(value) as high, min(value) as low,
  arg_max(value, event_id) as close, count(*)::bigint as volume from events group by 2)
select ticker, {sql_date()}, {_P4}, volume from (select * from o union all select * from e)""")
oracle("utc_naive_date", f"""with h as ({PANEL_HOURLY})
select ticker, strftime(date, '%Y-%m-%d %H:%M:%S') as bar, strftime(cast(date as date), '%Y-%m-%d') as day,
  round(close, 4) as close from h""")
oracle("utc_offset_text", """select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as utc from events""")
oracle("ticker_slug", f"""with d as ({PANEL_DAILY}), h as ({PANEL_HOURLY}),
t as (select q.ticker, count(d.ticker)::bigint as n_bars from {REQUESTED} q left join d using (ticker) group by q.ticker
      union all select ticker, count(*)::bigint from h group by ticker)
select ticker, replace(ticker, '.', '_') as slug, n_bars from t""")
oracle("write_panel_parquet", f"""with p as ({PANEL_DAILY})
select ticker, {sql_date()}, {_P4}, volume from p""")
oracle("write_panel_csv", f"""with p as ({PANEL_DAILY})
select ticker, {sql_date()}, """ + ", ".join(
    f"printf('%.4f', {c}) as {c}" for c in ("open", "high", "low", "close"))
    + ", volume::varchar as volume from p")
_P4_TWICE = ", ".join(f"round({c} * (case when ticker = '2-HIGH' then 2 else 1 end), 4) as {c}"
                      for c in ("open", "high", "low", "close"))
oracle("replace_ticker", f"""with p as ({PANEL_DAILY})
select ticker, {sql_date()}, {_P4_TWICE}, volume from p""")
oracle("replace_ticker_csv", f"""with p as ({PANEL_DAILY})
select ticker, {sql_date()}, """ + ", ".join(
    f"printf('%.4f', {c} * (case when ticker = '2-HIGH' then 2 else 1 end)) as {c}"
    for c in ("open", "high", "low", "close")) + ", volume::varchar as volume from p")
oracle("replace_processed", pipeline_sql(
    f"select ticker, {sql_date()}, split, round(case when ticker = '2-HIGH' and split = 'val' "
    f"then -close else close end, {RATIO}) as close, target from sc", upto="sc"))
oracle("replace_sequences", pipeline_sql("""select ticker, split, count(*)::bigint as n_seq,
  sum(case when ticker = '3-MEDIUM' and split = 'test' then 1 - y else y end)::bigint as n_up
from sq group by ticker, split"""))
oracle("replace_scaler", pipeline_sql("""select ticker, round(min_close, 4) as min_close,
  round(case when ticker = '2-HIGH' then 1.0 else max_close end, 4) as max_close from sc_par""",
    upto="sc"))
oracle("collection_manifest", f"""{_D}, {_GATE},
dv as (select * from d where ticker in (select ticker from gate where ok)),
{CLEAN_SQL.replace('from d where', 'from dv where')},
st as (select ticker, count(*)::bigint as rows, min(date) as s, max(date) as e from clean group by ticker)
select g.ticker, case when ok then 'OK' else 'FAILED' end as status,
  case when ok then st.rows end as rows,
  case when ok then strftime(st.s, '%Y-%m-%d') end as start,
  case when ok then strftime(st.e, '%Y-%m-%d') end as "end",
  '2024-01-31T00:00:00+00:00' as collected_at,
  '{{"start":"1995-01-01","end":"2001-12-31"}}' as parameters,
  case when ok then '{{"status":"OK","rows":' || st.rows || ',"start":"' || strftime(st.s, '%Y-%m-%d')
    || '","end":"' || strftime(st.e, '%Y-%m-%d') || '"}}' else '{{"status":"FAILED"}}' end as entry
from gate g left join st using (ticker)""")
_SOURCES = "(select unnest(['1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW']) as ticker)"
oracle("manifest_json", f"""{_D}, g as (select ticker, count(*)::bigint as n_rows, {_WORST} as worst from d
  where ticker in ('1-URGENT', '3-MEDIUM', '5-LOW') group by ticker),
gate as (select ticker, coalesce(n_rows > 0 and worst <= 0.05, false) as ok
  from {_SOURCES} q left join g using (ticker)),
dv as (select * from d where ticker in (select ticker from gate where ok)),
{CLEAN_SQL.replace('from d where', 'from dv where')},
st as (select ticker, count(*)::bigint as rows, min(date) as s, max(date) as e from clean group by ticker),
en as (select g.ticker, '"' || g.ticker || '":' || case when ok then '{{"status":"OK","rows":' || st.rows
    || ',"start":"' || strftime(st.s, '%Y-%m-%d') || '","end":"' || strftime(st.e, '%Y-%m-%d') || '"}}'
    else '{{"status":"FAILED"}}' end as x from gate g left join st using (ticker))
select '{{"collected_at":"2024-01-31T00:00:00+00:00","parameters":{{"start":"1995-01-01","end":"2001-12-31"}},'
  || '"tickers":["1-URGENT","2-HIGH","3-MEDIUM","5-LOW"],"results":{{'
  || string_agg(x, ',' order by ticker) || '}}}}' as manifest from en""")
oracle("write_processed_csv", pipeline_sql(
    "select ticker, split, strftime(date, '%Y-%m-%d') as date, "
    + ", ".join(f"printf('%.6f', {c}) as {c}" for c in ("open", "high", "low", "close", "volume"))
    + " from sc", upto="sc"))
oracle("require_columns", f"""with p as ({PANEL_DAILY})
select {_P4}, volume from p""")
for _name in ("null_rate", "validate_gate", "ffill", "clean_panel"):
    oracle(f"nan_{_name}", ORACLES[_name])  # NaN counts as missing: the same result
oracle("nan_target_next_up", f"""{_D}, x as (select ticker, date, case when prev <> 0 and close / prev > 0
    then ln(close / prev) end as r from (select *, lag(close) over (partition by ticker order by date) as prev
    from d where rev = 1))
select ticker, {sql_date()}, case when lead(r) over (partition by ticker order by date) > 0
  then 1 else 0 end as target from x""")
oracle("nan_feature_frame", f"""{_D}, {CLEAN_SQL},
{features_ctes('select * from clean')}
select ticker, {sql_date()}, """ + ", ".join(sql_round(c) for c in FEATURE_COLS) + ", target from fx")
oracle("write_processed", pipeline_sql(
    f"select ticker, {sql_date()}, split, "
    + ", ".join(f"round({c}, {RATIO}) as {c}" for c in FEATURE_COLS)
    + ", target from sc", upto="sc"))
oracle("sequence_store", pipeline_sql(f"""select ticker, split, count(*)::bigint as n_seq,
  sum(y)::bigint as n_up, round(sum(seq[-1][4]::double), {RATIO}) as sum_last_close
from sq where ticker = '3-MEDIUM' group by ticker, split"""))

oracle("window_store", pipeline_sql(f"""select ticker, split, {sql_date()}, y, len(seq)::int as n,
  round(seq[1][4]::double, {RATIO}) as first_close, round(seq[-1][4]::double, {RATIO}) as last_close
from sq"""))
oracle("clustered_features", "with " + features_ctes(
    f"select * from ({PANEL_DAILY}) where date >= date '1996-01-01' and date < date '1999-01-01'")
    + f"\nselect ticker, {sql_date()}, " + ", ".join(sql_round(c) for c in FEATURE_COLS)
    + ", target from fx")
oracle("pipeline_windows", ORACLES["window_store"])
oracle("prepare_store", pipeline_sql(f"""select q.ticker, s.split,
  case when r.ticker is null then 'FAIL' else 'OK' end as status, r.n_rows, r.sum_close,
  w.n_windows, w.n_up, round(p.min_close, 4) as min_close, round(p.max_close, 4) as max_close
from {REQUESTED} q cross join (select unnest(['train', 'val', 'test']) as split) s
left join (select ticker, split, count(*)::bigint as n_rows, round(sum(close), 3) as sum_close
  from sc group by ticker, split) r on r.ticker = q.ticker and r.split = s.split
left join (select ticker, split, count(*)::bigint as n_windows, sum(y)::bigint as n_up
  from sq group by ticker, split) w on w.ticker = q.ticker and w.split = s.split
left join sc_par p on p.ticker = q.ticker"""))
