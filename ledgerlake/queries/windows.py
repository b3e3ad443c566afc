"""Windows W1-W11."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import presets
from ..operators import windows
from ..operators.aggregates import pivot_series
from ..operators.windows import Trailing
from ..sources.scratch import stage
from . import views as v
from .registry import query
from .views import davg, dsum, dtotal, r


@query("zscore_anomalies", "select date, ticker, zscore, anomalia, tipo_anomalia from v_anom")
def zscore_anomalies(spark, sf):
    # bars are a stored table in a pipeline; the two passes of the operator read it
    rows = stage(v.bars(spark, sf).select("date", "ticker", "variacao_diaria_pct"), "bars")
    return windows.zscore(rows, "ticker", "variacao_diaria_pct").drop("variacao_diaria_pct")


def _trailing(spark, sf, *specs):
    wide = pivot_series(v.series(spark, sf), "data", presets.DAILY_SERIES)
    return windows.trailing(wide, "data", specs).select("data", *[s.out for s in specs])


def _frame(days: int) -> str:
    return f"over (order by data range between interval {days} days preceding and current row)"


@query(
    "trailing_mean_7d",
    f"select data, {r(davg('selic', _frame(7)), 4)} as selic_media_7d, {r(davg('cambio_usd_brl', _frame(7)), 4)} as cambio_media_7d from v_wide",
)
def trailing_mean_7d(spark, sf):
    return _trailing(
        spark, sf, Trailing("selic_media_7d", "avg", "selic", 7, 4), Trailing("cambio_media_7d", "avg", "cambio_usd_brl", 7, 4)
    )


@query("trailing_std_30d", f"select data, {r('stddev_samp(selic) ' + _frame(30), 4)} as selic_volatilidade_30d from v_wide")
def trailing_std_30d(spark, sf):
    return _trailing(spark, sf, Trailing("selic_volatilidade_30d", "stddev", "selic", 30, 4))


@query(
    "trailing_sum_365d",
    f"select data, {dtotal('ipca', _frame(365))} as ipca_acumulado_12m from v_wide",
)
def trailing_sum_365d(spark, sf):
    return _trailing(spark, sf, Trailing("ipca_acumulado_12m", "sum", "ipca", 365))


@query(
    "lag_pct_change",
    f"""select ticker, date, close, {r('(close-lag(close) over w)/nullif(lag(close) over w,0)*100', 4)} as variacao
from v_bars window w as (partition by ticker order by date)""",
)
def lag_pct_change(spark, sf):
    return windows.pct_change(v.bars(spark, sf).select("ticker", "date", "close"), ["ticker"], "date", "close", "variacao")


@query(
    "lag_global",
    f"""select ano, pib, {r('(pib-lag(pib) over w)/nullif(lag(pib) over w,0)*100', 2)} as variacao_pct, {r('pib-lag(pib) over w', 2)} as diferenca
from (select ano, max(valor) as pib from v_yearly where indicador='pib_anual' group by ano) t window w as (order by ano)""",
)
def lag_global(spark, sf):
    gdp = v.yearly(spark, sf).where("indicador = 'pib_anual'").select("ano", F.col("valor").alias("pib"))
    moved = windows.pct_change(gdp, [], "ano", "pib", "variacao_pct", 2)
    return windows.pct_change(moved, [], "ano", "pib", "diferenca", 2, diff=True)


@query(
    "rolling_corr_90d",
    f"""select ticker, date, {r('covar_pop(x,y) over w/nullif(stddev_pop(x) over w*stddev_pop(y) over w,0)', 4)} as correlacao
from (select ticker, date, variacao_diaria_pct as x, case when variacao_diaria_pct is not null then amplitude_diaria end as y from v_bars) t
window w as (partition by ticker order by date range between interval 90 days preceding and current row)""",
)
def rolling_corr_90d(spark, sf):
    rows = v.bars(spark, sf).select("ticker", "date", "variacao_diaria_pct", "amplitude_diaria")
    return windows.rolling_corr(rows, "ticker", "date", "variacao_diaria_pct", "amplitude_diaria").select(
        "ticker", "date", "correlacao"
    )


@query(
    "rank_global",
    "select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) as posicao from orders",
)
def rank_global(spark, sf):
    o = v.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return windows.rank_rows(o, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "velocity_rule",
    """select event_id, user_id, count(*) over (partition by user_id order by ts range between interval 600 seconds preceding and current row) as eventos_janela,
  count(*) over (partition by user_id order by ts range between interval 600 seconds preceding and current row)>=2 as alerta_velocidade from events""",
)
def velocity_rule(spark, sf):
    e = v.table(spark, sf, "events").select("event_id", "user_id", "ts")
    return windows.velocity_flag(e, "user_id", "ts", 600, 2).drop("ts")


SESSIONS = f"""
select user_id, min(ts) as inicio, max(ts)+interval 3600 seconds as fim, count(*) as eventos, {dsum('value')} as valor_total
from (select *, sum(nova) over (partition by user_id order by ts, event_id) as s from (
  select *, case when ts-lag(ts) over (partition by user_id order by ts, event_id)<=interval 3600 seconds then 0 else 1 end as nova from events) a) b
group by user_id, s"""


def _plain(df):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("inicio", "fim")})


@query("batch_sessions", SESSIONS)
def batch_sessions(spark, sf):
    return _plain(windows.sessionize(v.table(spark, sf, "events"), "user_id", "ts", 3600, "value"))


def sliding_sql(key: str, size: int, slide: int) -> str:
    """Each event falls into size/slide windows starting at multiples of the slide."""
    return f"""
select {key}, make_timestamp(w*1000000) as inicio, make_timestamp((w+{size})*1000000) as fim, count(*) as eventos, {dsum('value')} as valor_total
from (select {key}, value, unnest(range(cast(floor(epoch_us(ts)/1000000/{slide})*{slide} as bigint)-{size - slide},
   cast(floor(epoch_us(ts)/1000000/{slide})*{slide} as bigint)+1, {slide})) as w from events) t group by {key}, w"""


@query("batch_sliding", sliding_sql("event_type", 3600, 900))
def batch_sliding(spark, sf):
    return _plain(windows.sliding_agg(v.table(spark, sf, "events"), "event_type", "ts", 3600, 900, "value"))
