"""DuckDB SQL building blocks for the independent oracle.

Written from the operator definitions, not from the Spark code: the EWM here
is the closed form over the whole series, ``a^rn · Σ w·x·a^-rn`` (valid while
``rn·ln(1/a) < 709``: about 3,000 rows for span 9, more than any fixture
series), where Spark uses the block scan.
"""

from __future__ import annotations

import math

from barpanel.constants import FEATURE_COLS

PANEL_DAILY = """select o_orderpriority as ticker, cast(o_orderdate as date) as date,
  arg_min(o_totalprice, o_orderkey) as open, max(o_totalprice) as high,
  min(o_totalprice) as low, arg_max(o_totalprice, o_orderkey) as close,
  count(*)::bigint as volume
from orders group by 1, 2"""

PANEL_HOURLY = """select event_type as ticker, date_trunc('hour', ts) as date,
  arg_min(value, event_id) as open, max(value) as high,
  min(value) as low, arg_max(value, event_id) as close,
  count(*)::bigint as volume
from events group by 1, 2"""

PANEL_DIRTY = f"""with pd as ({PANEL_DAILY}),
base as (select ticker, date,
  case when day(date) = 29 or (day(date) = 3 and month(date) % 2 = 1) then null else open end as open,
  case when day(date) = 29 then null else high end as high,
  case when day(date) = 29 or date < date '1995-01-15' then null else low end as low,
  case when day(date) = 29 or (day(date) = 17 and month(date) % 2 = 0)
       or (ticker = '5-LOW' and day(date) in (11, 22)) then null else close end as close,
  case when day(date) = 13 then null else volume::double end as volume,
  1 as rev from pd),
dup as (select ticker, date, open + 1 as open, high + 1 as high, low + 1 as low,
  close + 1 as close, volume, 2 as rev from base where day(date) = 7),
u as (select * from base union all select * from dup)
select *, row_number() over (partition by ticker order by date, rev)::bigint as seq from u"""


def ewm_sql(x: str, rn: str, alpha: float, first_rn: int = 0) -> str:
    """Closed-form EWM (adjust=False) of ``x`` whose first value is at ``rn = first_rn``."""
    a = 1.0 - alpha
    k = f"({rn} - {first_rn})"
    return (f"pow({a!r}, {k}) * sum(case when {rn} = {first_rn} then 1.0 else {alpha!r} end"
            f" * {x} * pow({a!r}, -{k})) over wu")


def features_ctes(panel_sql: str, prefix: str = "fx") -> str:
    """CTEs ending in ``{prefix}_all`` (every row, nulls kept) and
    ``{prefix}`` (complete rows only). Needs a complete close series."""
    p = prefix
    a12, a26, a9, ag = 2 / 13, 2 / 27, 2 / 10, 1 / 14
    w_defs = ("window w as (partition by ticker order by date), "
              "wu as (partition by ticker order by date rows between unbounded preceding and current row), "
              "w10 as (partition by ticker order by date rows between 9 preceding and current row), "
              "w20 as (partition by ticker order by date rows between 19 preceding and current row), "
              "w50 as (partition by ticker order by date rows between 49 preceding and current row)")
    sqrt252 = repr(math.sqrt(252))
    complete = " and ".join(f"{c} is not null" for c in FEATURE_COLS + ["target"])
    return f"""{p}_p as ({panel_sql}),
{p}_b as (select *, row_number() over w - 1 as rn, lag(close) over w as prev_close
  from {p}_p {w_defs.split(', wu')[0]}),
{p}_c as (select *, case when prev_close <> 0 and close / prev_close > 0
    then ln(close / prev_close) end as log_return,
  close - prev_close as delta from {p}_b),
{p}_d as (select *, case when delta is not null then greatest(delta, 0) end as gain,
  case when delta is not null then greatest(-delta, 0) end as loss from {p}_c),
{p}_e as (select *,
  {ewm_sql('close', 'rn', a12)} as ema_12,
  {ewm_sql('close', 'rn', a26)} as ema_26,
  {ewm_sql('gain', 'rn', ag, 1)} as avg_gain,
  {ewm_sql('loss', 'rn', ag, 1)} as avg_loss,
  case when count(close) over w10 = 10 then avg(close) over w10 end as sma_10,
  case when count(close) over w20 = 20 then avg(close) over w20 end as sma_20,
  case when count(close) over w50 = 50 then avg(close) over w50 end as sma_50,
  case when count(log_return) over w20 = 20 then stddev_samp(log_return) over w20 * {sqrt252} end as volatility_20,
  volume / nullif(case when count(volume) over w20 = 20 then avg(volume) over w20 end, 0) as volume_norm,
  case when lead(log_return) over w > 0 then 1 else 0 end as target
  from {p}_d {w_defs}),
{p}_f as (select *, ema_12 - ema_26 as macd,
  100 - 100 / (1 + avg_gain / nullif(avg_loss, 0)) as rsi_14,
  close / nullif(sma_10, 0) as sma_10_ratio, close / nullif(sma_20, 0) as sma_20_ratio,
  close / nullif(sma_50, 0) as sma_50_ratio from {p}_e),
{p}_all as (select *, {ewm_sql('macd', 'rn', a9)} as macd_signal,
  macd - ({ewm_sql('macd', 'rn', a9)}) as macd_hist
  from {p}_f window wu as (partition by ticker order by date rows between unbounded preceding and current row)),
{p} as (select ticker, date, {', '.join(FEATURE_COLS)}, target from {p}_all where {complete})"""


def split_ctes(src: str = "fx", prefix: str = "sp") -> str:
    """``{prefix}``: complete rows + pos, n, split."""
    p = prefix
    return f"""{p}_n as (select *, row_number() over (partition by ticker order by date) - 1 as pos,
  count(*) over (partition by ticker) as n from {src}),
{p} as (select *, case when pos < n - (n * 15 // 100) - (n * 15 // 100) then 'train'
  when pos < n - (n * 15 // 100) then 'val' else 'test' end as split,
  case when pos < n - (n * 15 // 100) - (n * 15 // 100) then 0
  when pos < n - (n * 15 // 100) then n - (n * 15 // 100) - (n * 15 // 100)
  else n - (n * 15 // 100) end as split_start from {p}_n)"""


def scaled_ctes(src: str = "sp", prefix: str = "sc") -> str:
    """``{prefix}_par``: per-ticker train min/max; ``{prefix}``: scaled rows."""
    p = prefix
    aggs = ", ".join(f"min({c}::double) as min_{c}, max({c}::double) as max_{c}" for c in FEATURE_COLS)
    scaled = ", ".join(
        f"({c}::double - min_{c}) / (case when max_{c} - min_{c} = 0 then 1.0 else max_{c} - min_{c} end) as {c}"
        for c in FEATURE_COLS)
    return f"""{p}_par as (select ticker, {aggs} from {src} where split = 'train' group by ticker),
{p} as (select s.ticker, s.date, s.split, s.pos, s.n, s.split_start, s.target, {scaled}
  from {src} s join {p}_par using (ticker))"""


def seq_ctes(src: str = "sc", prefix: str = "sq", window: int = 30) -> str:
    """``{prefix}``: (ticker, split, date, seq FLOAT[][], y)."""
    p = prefix
    vec = "[" + ", ".join(f"{c}::float" for c in FEATURE_COLS) + "]"
    return f"""{p}_w as (select ticker, split, date, pos, split_start, target,
  list({vec}) over (partition by ticker order by date rows between {window} preceding and 1 preceding) as seq
  from {src}),
{p} as (select ticker, split, date, seq, target::bigint as y from {p}_w
  where pos - split_start >= {window})"""


def pipeline_sql(final: str, panel_sql: str = PANEL_DAILY, upto: str = "sq", window: int = 30) -> str:
    parts = [features_ctes(panel_sql)]
    if upto in ("sp", "sc", "sq"):
        parts.append(split_ctes())
    if upto in ("sc", "sq"):
        parts.append(scaled_ctes())
    if upto == "sq":
        parts.append(seq_ctes(window=window))
    return "with " + ",\n".join(parts) + "\n" + final
