"""DuckDB oracles of the queries over appended bars: the full recomputation."""

from __future__ import annotations

from barpanel.constants import FEATURE_COLS
from barpanel.plans.oracles import oracle
from barpanel.plans.present import RATIO, sql_date, sql_round
from barpanel.plans.sqlparts import PANEL_DAILY, features_ctes, scaled_ctes, split_ctes

oracle("append_features", f"""with {features_ctes(PANEL_DAILY)}
select ticker, {sql_date()}, """ + ", ".join(sql_round(c) for c in FEATURE_COLS)
       + ", target from fx where date >= date '1997-01-01'")
oracle("append_windows", f"""with {features_ctes(PANEL_DAILY)},
hx as (select * from fx where date < date '1997-01-01'),
{split_ctes('hx')}, {scaled_ctes()},
al as (select f.ticker, f.date, f.target, ((f.close::double - min_close)
    / (case when max_close - min_close = 0 then 1.0 else max_close - min_close end))::float as c
  from fx f join sc_par using (ticker)),
w as (select ticker, date, target, list(c) over (partition by ticker order by date
    rows between 30 preceding and 1 preceding) as seq from al)
select ticker, {sql_date()}, target::bigint as y, round(seq[-1]::double, {RATIO}) as last_close,
  round(seq[1]::double, {RATIO}) as first_close, len(seq)::int as n
from w where len(seq) = 30 and date >= date '1997-01-01'""")
