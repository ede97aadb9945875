"""The named queries in SQL, for checking results with another engine."""

from __future__ import annotations

from tidegauge.operators.forecast import GRID, HORIZON, PERIOD
from tidegauge.plans.adapter import DEVICES, SOURCES


def half_up(x: str, digits: int) -> str:
    """Decimal rounding of a double's shortest text, halves away from zero."""
    return (f"cast(round(cast(cast(({x}) as varchar) as decimal(38,15)), {digits}) as double)")


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


EVENTS = f"""
ev as (
  select cast(e.event_id as varchar) as event_id, e.ts as event_timestamp,
         printf('user_%03d', e.user_id) as user_id, e.event_type,
         'SKU_' || cast(e.k as varchar) as product_id,
         p.p_name as product_name, p.p_type as category,
         e.value as price, cast(e.event_id % 3 + 1 as integer) as quantity,
         case when e.event_type = 'purchase'
              then {half_up("e.value * cast(e.event_id % 3 + 1 as integer)", 2)} end as revenue,
         {_list(DEVICES)}[cast(e.user_id % {len(DEVICES)} as integer) + 1] as user_agent,
         {_list(SOURCES)}[cast(e.event_id % {len(SOURCES)} as integer) + 1] as source,
         case when e.event_type = 'purchase' then 1 else 0 end as is_purchase,
         case when e.event_type = 'click' then 1 else 0 end as is_click
  from (select *, cast(props::json->>'k' as bigint) as k from events) e
  left join part p on e.k = p.p_partkey)"""

_SPREADS = {
    "minutes": ("interval 9 minute", "'minute'", "interval 1 minute", "interval 10 minute"),
    "weekly": ("interval 6 day", "'day'", "interval 1 day", "interval 7 day"),
    "hourly": ("interval 0 hour", "'hour'", "interval 1 hour", "interval 1 hour"),
}


def spread(grain: str, source: str = "ev", name: str = "w") -> str:
    """Each event under all its windows."""
    back, unit, slide, length = _SPREADS[grain]
    return f"""
{name} as (
  select *, window_start + {length} as window_end from (
    select *, unnest(generate_series(date_trunc({unit}, event_timestamp) - {back},
                                     date_trunc({unit}, event_timestamp), {slide})) as window_start
    from {source}))"""


_COUNTS = f"""cast(count(*) as bigint) as total_events, cast(sum(is_click) as bigint) as clicks,
  cast(sum(is_purchase) as bigint) as purchases,
  {half_up("sum(coalesce(revenue, 0.0))", 2)} as revenue"""
_CONVERSION = f"""case when sum(is_click) > 0
  then {half_up("sum(is_purchase) / sum(is_click) * 100", 2)} else 0.0 end as conversion_rate"""


def _trending(source: str) -> str:
    return f"""select window_start, window_end, product_id, product_name, category, {_COUNTS},
  cast(sum(quantity) as bigint) as total_quantity,
  cast(count(distinct user_id) as integer) as unique_users, {_CONVERSION},
  {half_up("round(sum(coalesce(revenue, 0.0)), 6) / count(*)", 2)} as avg_revenue_per_event
from {source} group by window_start, window_end, product_id, product_name, category"""


def _category(source: str) -> str:
    return f"""select window_start, window_end, category, {_COUNTS},
  {half_up("round(sum(price), 6) / count(price)", 2)} as avg_product_price,
  max(price) as max_product_price_in_category,
  cast(sum(quantity) as bigint) as total_quantity_sold, {_CONVERSION}
from {source} group by window_start, window_end, category"""


def _behavior(source: str) -> str:
    return f"""select window_start, window_end, user_agent, source, {_COUNTS},
  cast(count(distinct user_id) as integer) as unique_users_affected, {_CONVERSION}
from {source} group by window_start, window_end, user_agent, source"""


def with_tables(grain: str, body: str, *more: str) -> str:
    """``body`` over the three tables t, c, b at a grain."""
    ctes = [EVENTS, spread(grain), f"t as ({_trending('w')})", f"c as ({_category('w')})",
            f"b as ({_behavior('w')})", *more]
    return "with " + ",\n".join(ctes) + "\n" + body


def with_missing(columns: list[str], table: str, body: str) -> str:
    """``body`` over the weekly table, every fifth event without its values in the columns."""
    gaps = ", ".join(f"case when cast(event_id as bigint) % 5 <> 0 then {c} end as {c}" for c in columns)
    tables = {"c": _category, "b": _behavior}
    return "with " + ",\n".join([EVENTS, f"gaps as (select * replace ({gaps}) from ev)", spread("weekly", "gaps"),
                                 f"{table} as ({tables[table]('w')})"]) + "\n" + body


def latest(body: str, *more: str) -> str:
    """``body`` over tl, cl, bl: the tables at the latest weekly window."""
    newest = "(select max(window_start) from b)"
    return with_tables("weekly", body, *[
        f"{t}l as (select * from {t} where window_start = {newest})" for t in "tcb"], *more)


def _money(x: str) -> str:
    return f"format('{{:,.2f}}', {x})"


def _title(x: str) -> str:
    """Upper-case each word; words end at underscores and blanks."""
    x = f"lower({x})"
    for separator in " _":
        x = (f"array_to_string(list_transform(string_split({x}, '{separator}'), "
             f"lambda part: upper(part[1:1]) || part[2:]), '{separator}')")
    return x


_HOURLY_SERIES = f"""s as (select 'all' as category, window_start,
  {half_up('sum(revenue)', 2)} as revenue from t group by window_start)"""
_HOURLY_RAW = """s as (select 'all' as category, window_start,
  sum(coalesce(revenue, 0.0)) as revenue from w group by window_start)"""
_CATEGORY_RAW = """s as (select category, window_start,
  sum(coalesce(revenue, 0.0)) as revenue from w group by category, window_start)"""

_DENSE = """d as (
  select g.category, g.window_start, coalesce(s.revenue, 0.0) as revenue
  from (select category, unnest(generate_series(min(window_start), max(window_start),
                                                interval 1 hour)) as window_start
        from s group by category) g
  left join s on s.category is not distinct from g.category and s.window_start = g.window_start)"""

_FRAME = ("over (partition by category order by window_start "
          "rows between 9 preceding and current row)")
_BANDS = f"""r as (
  select *, count(*) over (partition by category) as points,
         case when count(revenue) {_FRAME} = 10 then avg(revenue) {_FRAME} end as rolling_mean,
         case when count(revenue) {_FRAME} = 10 then stddev_samp(revenue) {_FRAME} end as rolling_std
  from s),
bands as (
  select *, rolling_mean + rolling_std * 2.0 as upper_band,
         rolling_mean - rolling_std * 2.0 as lower_band,
         coalesce(revenue > rolling_mean + rolling_std * 2.0
                  or revenue < rolling_mean - rolling_std * 2.0, false) as anomaly
  from r where points >= 5)"""
_BAND_COLUMNS = ", ".join(
    ["window_start", f"{half_up('revenue', 2)} as revenue"]
    + [f"{half_up(c, 4)} as {c}" for c in ("rolling_mean", "rolling_std", "upper_band", "lower_band")]
    + ["anomaly"])

# One row per series and grid point is carried from observation to observation.
_FORECAST = f"""y as (
  select category, list(revenue order by window_start) as y, max(window_start) as last,
         count(*) as n from d group by category),
starts as (
  select *, list_sum(y[1:{PERIOD}]) / {PERIOD}.0 as first_mean,
         list_sum(y[{PERIOD + 1}:{2 * PERIOD}]) / {PERIOD}.0 as second_mean
  from y where n >= {2 * PERIOD}),
grid(alpha, beta, gamma) as (values {", ".join(f"({a}::double, {b}::double, {g}::double)"
                                                for a, b, g in GRID)}),
hw as (
  select category, alpha, beta, gamma, 0 as t, first_mean as level,
         (second_mean - first_mean) / {PERIOD}.0 as trend,
         list_transform(y[1:{PERIOD}], lambda v: v - first_mean) as season, 0.0::double as sse
  from starts, grid
  union all
  select hw.category, alpha, beta, gamma, t + 1,
         alpha * (y[t + 1] - season[1]) + (1 - alpha) * (level + trend),
         beta * (alpha * (y[t + 1] - season[1]) + (1 - alpha) * (level + trend) - level)
           + (1 - beta) * trend,
         list_append(season[2:{PERIOD}],
                     gamma * (y[t + 1] - level - trend) + (1 - gamma) * season[1]),
         sse + (y[t + 1] - (level + trend + season[1])) * (y[t + 1] - (level + trend + season[1]))
  from hw join starts on starts.category is not distinct from hw.category
  where t < n),
best as (
  select hw.*, last from hw join starts on starts.category is not distinct from hw.category
  where t = n
  qualify row_number() over (partition by hw.category order by sse, alpha, beta, gamma) = 1),
f as (
  select category, last + h * interval 1 hour as timestamp,
         level + h * trend + season[(h - 1) % {PERIOD} + 1] as predicted_revenue
  from best, (select unnest(range(1, {HORIZON + 1})) as h))"""


def _hourly(body: str, *more: str) -> str:
    return "with recursive " + with_tables("hourly", body, *more).removeprefix("with ")


_TIE = {"tl": "product_id, product_name, category", "bl": "user_agent, source"}


def _top_row(table: str, column: str) -> str:
    return (f"coalesce((select {column} from {table} order by revenue desc, {_TIE[table]} limit 1), "
            "'N/A')")


def _insight(source: str, metric: str, entity: str, best: str, worst: str, sentence: str) -> str:
    return f"""select top.{entity} as top_entity, {half_up(f'top.{metric}', 2)} as top_value,
  worst.{entity} as worst_entity, {half_up(f'worst.{metric}', 2)} as worst_value,
  {sentence} as insight
from (select * from {source} order by {metric} {best}, {entity} limit 1) top,
     (select * from {source} order by {metric} {worst}, {entity} limit 1) worst"""


def _top10(metric: str) -> str:
    return latest(f"select window_start, product_id, product_name, category, {metric} from tl "
                  f"order by {metric} desc, product_id, product_name, category limit 10")


_LATE = f"""
delivered as (
  select *, event_type = 'error' as late,
         max(case when event_type <> 'error' then event_timestamp end) over ()
           - interval 2 day as watermark from ev),
{spread('weekly', 'delivered', 'all_windows')},
w as (select * from all_windows where not late or window_end > watermark)"""

_KEY_TIME = "strftime(window_start, '%Y-%m-%dT%H_%M_%S_000Z')"

_KPIS = f"""select {half_up('coalesce(sum(revenue), 0.0)', 2)} as total_revenue,
  cast(coalesce(sum(purchases), 0) as bigint) as total_purchases,
  cast(coalesce(sum(clicks), 0) as bigint) as total_clicks,
  case when sum(clicks) > 0 then {half_up('sum(purchases) / sum(clicks) * 100', 4)}
       else 0.0 end as overall_conversion_rate from tl"""

ORACLES: dict[str, str] = {
    "decoded_events": f"""with {EVENTS} select event_id, event_timestamp, user_id, event_type,
  product_id, product_name, category, price, quantity, revenue, user_agent, source from ev""",
    "rejected_events": f"""with {EVENTS} select user_id as key, reason, count(*) as messages
  from ev, (values ('malformed'), ('bad_time'), ('empty')) r(reason) group by user_id, reason""",
    "event_flags": f"""with {EVENTS} select event_id, event_type, is_purchase, is_click,
  coalesce(revenue, 0.0) as revenue_filled from ev""",
    "event_revenue": f"""with {EVENTS} select event_id, event_type, price, quantity,
  revenue as event_revenue from ev""",
    "catalog_enrichment": f"""with {EVENTS} select event_id, product_id, product_name, category
  from ev""",
    "catalog_join": f"""with {EVENTS} select event_id, product_id, p_name as product_name,
  p_type as category, p_retailprice as list_price
  from ev left join part on product_id = 'SKU_' || p_partkey""",
    "publish_payload": f"""with {EVENTS} select user_id as key, event_id,
  strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') as timestamp, user_id, event_type, product_id,
  price, revenue as event_revenue, quantity from ev""",
    "trending_products": with_tables("minutes", "select * from t"),
    "category_analytics": with_tables("minutes", "select * from c"),
    "user_behavior": with_tables("minutes", "select * from b"),
    "top_products_kept": with_tables("weekly", """select * from (
  select window_start, product_id, product_name, category, revenue, cast(row_number() over (partition by window_start
    order by revenue desc, product_id, product_name, category) as integer) as place from t) where place <= 5"""),
    "approximate_users": with_tables("weekly", "select window_start, product_id, unique_users, true as within from t"),
    "approximate_users_stream": with_tables(
        "weekly", "select window_start, product_id, unique_users, true as within from t"),
    "all_tables_stream": with_tables("weekly", " union all ".join(
        f"""select '{name}' as name, cast(count(*) as bigint) as windows, cast(sum(total_events) as bigint) as total_events,
  round(sum(revenue), 2) as revenue from {table}"""
        for name, table in (("trending_products", "t"), ("category_analytics", "c"), ("user_behavior", "b")))),
    "serving_keys_read": with_tables("weekly", """select * from c where day(window_start) % 3 = 0 and exists (
  select 1 from ev where date_trunc('day', event_timestamp) = window_start and category is not distinct from c.category)"""),
    "serving_values_read": with_tables("weekly", """select
  'trending_products:' || strftime(window_start, '%Y-%m-%dT%H_%M_%S_000Z') || '_' ||
  coalesce(product_id, 'unknown_product') as serving_key, total_events from t where day(window_start) = 9"""),
    "trending_products_stream": with_tables("minutes", "select * from t"),
    "category_analytics_stream": with_tables("minutes", "select * from c"),
    "user_behavior_stream": with_tables("minutes", "select * from b"),
    "late_events": f"with {EVENTS}, {_LATE} {_behavior('w')}",
    "serving_latest": f"""with {EVENTS}, {spread('weekly')},
  early as (select * from w where event_type <> 'error'),
  writes as (select *, 0::bigint as batch from ({_category('early')})
             union all select *, 1::bigint from ({_category('w')}))
  select * from writes
  qualify row_number() over (partition by window_start, category order by batch desc) = 1""",
    "serving_unexpired": with_tables("minutes", """select * from b
  where window_end > (select max(window_end) from b) - interval 1 hour"""),
    "serving_keys": with_tables("minutes", f"""select
  'trending_products:' || {_KEY_TIME} || '_' || coalesce(product_id, 'unknown_product') as serving_key,
  strftime(window_start, '%Y-%m-%dT%H:%M:%S.000Z') as window_start_text, product_name,
  total_events, conversion_rate from t"""),
    "serving_keys_behavior": with_missing(["user_agent", "source"], "b", f"""select
  'user_behavior:' || {_KEY_TIME} || '_' || coalesce(user_agent, 'unknown_ua') || '_'
    || coalesce(source, 'unknown_source') as serving_key, total_events from b"""),
    "serving_keys_category": with_missing(["category"], "c", f"""select
  'category_analytics:' || {_KEY_TIME} || '_' || coalesce(category, 'unknown_category') as serving_key,
  total_events from c"""),
    "windows_without_bad_times": with_tables("weekly", "select * from c"),
    "serving_clean_read": with_tables("weekly", "select * from b"),
    "latest_window_products": latest("select * from tl"),
    "kpi_snapshot": latest(_KPIS),
    "kpi_snapshot_lagging": "with " + ",\n".join([
        EVENTS, "old as (select * from ev where event_timestamp < (select date_trunc('day', max(event_timestamp)) from ev))",
        spread("weekly"), spread("weekly", "old", "wo"), f"told as ({_trending('wo')})", f"b as ({_behavior('w')})",
        "tl as (select * from told where window_start = (select max(window_start) from b))"]) + "\n" + _KPIS,
    "latest_complete_window": with_tables("weekly", """select * from c where window_start = (
  select max(window_start) from c where window_end <= (select max(window_start) from c))"""),
    "overview_headlines": latest(f"""select *,
  'Live Snapshot (Window starting at ' || strftime(window_start, '%H:%M:%S') || ')' as title,
  '€' || {_money('total_revenue')} as revenue_text,
  format('{{:,}}', total_purchases) as purchases_text,
  format('{{:.2f}}%', overall_conversion_rate) as conversion_text,
  'The **' || {_title('top_channel')} || '** channel is currently driving the most revenue.'
    as channel_text,
  '**' || {_title('top_category')} || '** is the highest-earning product category right now.'
    as category_text
from (select {half_up('sum(revenue)', 2)} as total_revenue,
        cast(sum(purchases) as bigint) as total_purchases,
        cast(sum(clicks) as bigint) as total_clicks,
        {half_up('sum(purchases) / sum(clicks) * 100', 4)} as overall_conversion_rate,
        max(window_start) as window_start,
        {_top_row('bl', 'source')} as top_channel, {_top_row('tl', 'category')} as top_category
      from tl)"""),
    "top_channel": latest(f"select {_top_row('bl', 'source')} as top_channel"),
    "top_category": latest(f"select {_top_row('tl', 'category')} as top_category"),
    "performer_insight": latest(_insight(
        "tops", "revenue", "product_name", "desc", "asc",
        f"'**Top Performer:** `' || top.product_name || '` is leading with **' || "
        f"{_money('top.revenue')} || '** in revenue.'"),
        "tops as (select * from tl order by revenue desc, product_id, product_name, category limit 10)"),
    "performer_insight_low": latest(_insight(
        "cl", "total_events", "category", "asc", "desc",
        f"'**Top Performer:** `' || top.category || '` is performing best with the lowest "
        f"total_events of **' || {_money('top.total_events::double')} || '**.'")),
    "top10_revenue": _top10("revenue"),
    "top10_purchases": _top10("purchases"),
    "top10_total_events": _top10("total_events"),
    "top3_per_category": latest("""select category, place, product_id, revenue from (
  select *, cast(row_number() over (partition by category
    order by revenue desc, product_id, product_name) as integer) as place from tl)
  where place <= 3"""),
    "revenue_rollup": latest(f"""select
  cast(2 - grouping(category) - grouping(product_name) as integer) as level,
  category, product_name, {half_up('sum(revenue)', 2)} as revenue
from tl group by rollup(category, product_name)"""),
    "category_conversion_rank": latest("select window_start, category, conversion_rate from cl"),
    "channel_funnel": latest(f"""select source, cast(sum(clicks) as bigint) as clicks,
  cast(sum(purchases) as bigint) as purchases,
  {half_up("sum(purchases) / case when sum(clicks) = 0 then 1 else sum(clicks) end * 100", 4)}
    as conversion_rate
from bl where source is not null group by source"""),
    "channel_labels": latest(f"""select source, {_title('source')} as title,
  {_title("replace(source, '_', ' ')")} as label
from (select distinct source from bl)"""),
    "category_share": with_tables("weekly", f"""select window_start, category,
  {half_up('r', 2)} as revenue, {half_up('r / whole', 6)} as share
from (select window_start, category, sum(coalesce(revenue, 0.0)) as r,
             sum(sum(coalesce(revenue, 0.0))) over (partition by window_start) as whole
      from w group by window_start, category)"""),
    "product_names": f"with {EVENTS} select distinct product_name from ev",
    "product_compare": with_tables("weekly", """select window_start,
  coalesce(sum(purchases) filter (where product_name = a), 0)::bigint as product_1,
  coalesce(sum(purchases) filter (where product_name = b), 0)::bigint as product_2
from t, (select min(name) as a, max(name) as b from names where nth <= 2)
where product_name = a or product_name = b group by window_start""",
        """names as (select product_name as name, row_number() over (order by product_name) as nth
             from (select distinct product_name from ev where product_name is not null))"""),
    "channel_revenue_pivot": with_tables("hourly", "select window_start, " + ", ".join(
        half_up(f"coalesce(sum(revenue) filter (where source = '{s}'), 0.0)", 2) + f" as {s}"
        for s in SOURCES) + " from b where source is not null group by window_start"),
    "channel_revenue_long": with_tables("hourly", f"""select window_start, source,
  {half_up('sum(revenue)', 2)} as revenue from b group by window_start, source"""),
    "revenue_trend": with_tables("hourly", "select window_start, revenue from s", _HOURLY_SERIES),
    "revenue_densified": _hourly(f"""select category, window_start,
  {half_up('revenue', 2)} as revenue from d""", _CATEGORY_RAW, _DENSE),
    "revenue_bands": _hourly(f"select {_BAND_COLUMNS} from bands", _HOURLY_RAW, _BANDS),
    "category_bands": _hourly(f"select category, {_BAND_COLUMNS} from bands", _CATEGORY_RAW, _BANDS),
    "revenue_anomalies": _hourly(f"""select window_start, {half_up('revenue', 2)} as anomalous_revenue,
  {half_up('rolling_mean', 4)} as expected_revenue from bands where anomaly""", _HOURLY_RAW, _BANDS),
    "latest_anomaly": _hourly(f"""select window_start, {half_up('revenue', 2)} as anomalous_revenue,
  {half_up('rolling_mean', 4)} as expected_revenue,
  '**Latest Anomaly Alert:** Revenue of **€' || {_money('revenue')} || '** was detected at **'
    || strftime(window_start, '%H:%M:%S') || '**, which is outside the expected range.' as alert
from bands where anomaly order by window_start desc limit 1""", _HOURLY_RAW, _BANDS),
    "revenue_forecast": _hourly(f"""select timestamp,
  {half_up('predicted_revenue', 4)} as predicted_revenue from f""", _HOURLY_RAW, _DENSE, _FORECAST),
    "category_forecast": _hourly(f"""select category, timestamp,
  {half_up('predicted_revenue', 4)} as predicted_revenue from f""", _CATEGORY_RAW, _DENSE, _FORECAST),
    "forecast_total": _hourly(f"""select {half_up('sum(predicted_revenue)', 2)} as total_revenue,
  '**Forecast Summary:** The model predicts a total revenue of **€' ||
    {_money('sum(predicted_revenue)')} || '** over the next 30 hours.' as summary
from f""", _HOURLY_RAW, _DENSE, _FORECAST),
    "forecast_history": _hourly("""select category, count(*) as points,
  case when count(*) >= 24 then 'forecast' else 'too_short' end as status, 'hour' as step
from d group by category
union all
select category, count(distinct week), case when count(distinct week) >= 24 then 'forecast' else 'too_short' end, 'week'
from (select category, epoch_us(event_timestamp) // 604800000000 as week from ev) group by category""",
                                _CATEGORY_RAW, _DENSE),
}
