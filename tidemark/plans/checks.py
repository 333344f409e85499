"""DuckDB SQL that restates the queries of the catalog from the raw tables.

Written join by join and subquery by subquery, independently of the plans the
Spark side uses: differences instead of flags, self joins instead of look-back
slots, a union of slices instead of grouping sets.
"""

from __future__ import annotations


def _with(*parts: str) -> str:
    """Steps of a query, each worked out once however the query is wrapped."""
    named = [part.replace(" as (", " as materialized (", 1) for part in parts]
    return "with " + ",\n".join(named) + "\n"


def _user(account: str) -> str:
    return (
        f"case when {account} % 3 = 0"
        f" then {account} + 100000 * cast(floor(day(ts) / 7.0) as int) else {account} end"
    )


WHO = """cast(user_id % 2 as int) as gender,
    cast(15 + (user_id * 7) % 50 as int) as age,
    case when user_id % 5 < 2 then 'iOS' else 'Android' end as os,
    case when user_id % 7 < 3 then 'ads' else 'organic' end as source,
    user_id as account_id"""

FEED = f"""feed as (
  select {_user('user_id')} as user_id, ts as time, cast(ts as date) as d,
    case event_type when 'click' then 'like' else 'view' end as action,
    {WHO}
  from events where event_type in ('view', 'click', 'error'))"""

RECEIVER = "((event_id * 7 + 3) % (select count(distinct user_id) from events))"

MSG = f"""msg as (
  select {_user('user_id')} as user_id, {_user(RECEIVER)} as reciever_id,
    ts as time, cast(ts as date) as d,
    {WHO}
  from events where event_type in ('purchase', 'signup'))"""

COUNTRY = """country as (
  select c_custkey as account_id, n_name as country
  from customer join nation on c_nationkey = n_nationkey)"""

YESTERDAY = "d = date '2024-01-29'"
KPI_DAYS = "d between date '2024-01-23' and date '2024-01-29'"
REPORT_DAYS = "d >= date '2024-01-10'"
ALERT_DAYS = """(d >= date '2024-01-29' or d = date '2024-01-23' or d = date '2024-01-22'
    or d = date '2024-01-16' or d = date '2024-01-15')"""

CHECK_SQL: dict[str, str] = {}

# Sources and date windows

CHECK_SQL["feed_actions"] = (
    _with(FEED, COUNTRY)
    + """select user_id, time, action, gender, age, os, source, country
from feed left join country using (account_id)"""
)
CHECK_SQL["message_actions"] = (
    _with(MSG, COUNTRY)
    + """select user_id, reciever_id, time, gender, age, os, source, country
from msg left join country using (account_id)"""
)
for _name, _days in [
    ("filter_yesterday", YESTERDAY),
    ("filter_last_7_days", KPI_DAYS),
    ("filter_last_30_days", REPORT_DAYS),
]:
    CHECK_SQL[_name] = (
        _with(FEED)
        + f"select user_id, time, action, gender, age, os, source from feed where {_days}"
    )
CHECK_SQL["filter_reference_days"] = (
    _with(MSG)
    + "select user_id, reciever_id, time, gender, age, os, source from msg"
    + f" where {ALERT_DAYS}"
)


# Daily activity and its slices


def _activity(days: str) -> list[str]:
    return [
        FEED,
        MSG,
        f"""fa as (
  select user_id, gender, age, os, d as event_date,
    count(*) filter (action = 'view') as views,
    count(*) filter (action = 'like') as likes
  from feed where {days} group by all)""",
        f"""sent as (
  select user_id, gender, age, os, d as event_date,
    count(reciever_id) as messages_sent, count(distinct reciever_id) as users_sent
  from msg where {days} group by all)""",
        f"""received as (
  select reciever_id, d as event_date,
    count(user_id) as messages_received, count(distinct user_id) as users_received
  from msg where {days} group by all)""",
        """ma as (
  select s.*, r.messages_received, r.users_received
  from sent s join received r
    on s.user_id = r.reciever_id and s.event_date = r.event_date)""",
        """merged as (
  select coalesce(fa.user_id, ma.user_id) as user_id,
    coalesce(fa.gender, ma.gender, 0) as gender, coalesce(fa.age, ma.age, 0) as age,
    coalesce(fa.os, ma.os, '0') as os, coalesce(fa.event_date, ma.event_date) as event_date,
    coalesce(views, 0) as views, coalesce(likes, 0) as likes,
    coalesce(messages_received, 0) as messages_received,
    coalesce(messages_sent, 0) as messages_sent,
    coalesce(users_received, 0) as users_received, coalesce(users_sent, 0) as users_sent
  from fa full join ma
    on fa.user_id is not distinct from ma.user_id
    and fa.gender is not distinct from ma.gender
    and fa.age is not distinct from ma.age and fa.os is not distinct from ma.os
    and fa.event_date is not distinct from ma.event_date)""",
    ]


def _slice(dimension: str, value: str) -> str:
    metrics = [
        "views",
        "likes",
        "messages_received",
        "messages_sent",
        "users_received",
        "users_sent",
    ]
    sums = ", ".join(f"cast(sum({m}) as bigint) as {m}" for m in metrics)
    return (
        f"select event_date, '{dimension}' as dimension, {value} as dimension_value, {sums}"
        f" from merged group by event_date, {dimension}"
    )


SLICES = {
    "gender": _slice(
        "gender",
        "case gender when 0 then 'Female' when 1 then 'Male' else cast(gender as varchar) end",
    ),
    "os": _slice("os", "os"),
    "age": _slice("age", "cast(age as varchar)"),
}

for _name, _table in [
    ("feed_activity_daily", "fa"),
    ("messages_sent_daily", "sent"),
    ("messages_received_daily", "received"),
    ("messages_activity_daily", "ma"),
    ("user_activity_merged", "merged"),
]:
    CHECK_SQL[_name] = _with(*_activity(YESTERDAY)) + f"select * from {_table}"
for _name, _select in SLICES.items():
    CHECK_SQL[f"slice_{_name}"] = _with(*_activity(YESTERDAY)) + _select
_all_slices = "\nunion all ".join(SLICES.values())
CHECK_SQL["slice_metrics_daily"] = _with(*_activity(YESTERDAY)) + _all_slices
CHECK_SQL["slice_sink"] = CHECK_SQL["slice_metrics_daily"]
CHECK_SQL["slice_metrics_backfill"] = _with(*_activity("true")) + _all_slices

# Reports

KPI = f"""kpi as (
  select d as day, count(distinct user_id) as dau,
    count(*) filter (action = 'view') as views, count(*) filter (action = 'like') as likes,
    count(*) filter (action = 'like')
      / nullif(count(*) filter (action = 'view'), 0) * 100 as ctr
  from feed where {KPI_DAYS} group by d)"""

CHECK_SQL["feed_kpi_7d"] = (
    _with(FEED, KPI) + "select day, dau, views, likes, round(ctr, 6) as ctr from kpi"
)
CHECK_SQL["feed_kpi_digest"] = (
    _with(FEED, KPI)
    + """select day, dau, views, likes, round(ctr, 6) as ctr,
  -- Fixed values: the text of the feed digest.
  'Cтатистика за вчера:' || chr(10) || '        DAU = ' || dau || ' users'
    || chr(10) || '        Views = ' || views || chr(10) || '        Likes = ' || likes
    || chr(10) || '        CTR = ' || coalesce(printf('%.2f', ctr), if(likes > 0, 'inf', 'nan'))
    || '%' as message
from kpi where day = (select max(day) from kpi)"""
)
CHECK_SQL["feed_kpi_series"] = (
    _with(FEED, KPI)
    + """select day, 'DAU' as metric, cast(dau as double) as value from kpi
union all select day, 'Views', views from kpi
union all select day, 'Likes', likes from kpi
union all select day, 'CTR', round(ctr, 6) from kpi"""
)

BY_COUNTRY = f"""dau as (
  select d as event_date, country, 'Feed' as service, count(distinct user_id) as users
  from feed left join country using (account_id) where {REPORT_DAYS} group by d, country
  union all
  select d, country, 'Message', count(distinct user_id)
  from msg left join country using (account_id) where {REPORT_DAYS} group by d, country)"""

CHECK_SQL["dau_by_country"] = _with(FEED, MSG, COUNTRY, BY_COUNTRY) + "select * from dau"
CHECK_SQL["dau_by_country_major"] = (
    _with(FEED, MSG, COUNTRY, BY_COUNTRY)
    + "select * from dau where users >= 6 and service = 'Feed'"
)
CHECK_SQL["avg_feed_usage"] = (
    _with(FEED)
    + f"""select event_date, round(avg(views), 6) as avg_views, round(avg(likes), 6) as avg_likes
from (
  select d as event_date, user_id, count(*) filter (action = 'view') as views,
    count(*) filter (action = 'like') as likes
  from feed where {REPORT_DAYS} group by d, user_id)
where views >= 2 group by event_date"""
)
CHECK_SQL["avg_msg_usage"] = (
    _with(MSG)
    + f"""select event_date, round(avg(sent), 6) as avg_sent
from (select d as event_date, user_id, count(*) as sent
  from msg where {REPORT_DAYS} group by d, user_id)
where sent > 1 group by event_date"""
)
for _name, _cte, _table in [
    ("feed_dau_by_source", FEED, "feed"),
    ("msg_dau_by_source", MSG, "msg"),
]:
    CHECK_SQL[_name] = (
        _with(_cte)
        + f"""select d as event_date, source, count(distinct user_id) as users
from {_table} where {REPORT_DAYS} group by d, source"""
    )

# Weekly cohorts


def _dynamics(table: str) -> list[str]:
    week = "d - cast(dayofweek(d) as int)"
    return [
        f"""{table}_w as (select distinct user_id, {week} as wk from {table})""",
        f"""{table}_active as (select wk, count(*) as n from {table}_w group by wk)""",
        f"""{table}_new as (
  select wk, count(*) as n
  from (select user_id, min(wk) as wk from {table}_w group by user_id) group by wk)""",
        f"""{table}_dyn as (
  select a.wk as week, a.n - coalesce(n.n, 0) as retained, coalesce(n.n, 0) as new,
    a.n - coalesce(n.n, 0) - coalesce(p.n, 0) as gone,
    case when coalesce(p.n, 0) > 0 then (a.n - coalesce(n.n, 0)) / p.n * 100 else 0 end
      as stayed
  from {table}_active a
  left join {table}_new n on n.wk = a.wk
  left join {table}_active p on p.wk + 7 = a.wk)""",
    ]


for _name, _cte, _table in [
    ("feed_weekly_dynamics", FEED, "feed"),
    ("msg_weekly_dynamics", MSG, "msg"),
]:
    CHECK_SQL[_name] = (
        _with(_cte, *_dynamics(_table))
        + "select cast(week as date) as week, retained, new, gone,"
        + f" round(cast(stayed as double), 6) as stayed from {_table}_dyn"
    )
CHECK_SQL["first_seen_week"] = (
    _with(FEED, *_dynamics("feed"))
    + "select cast(wk as date) as week, n as new_users from feed_new"
)
_both = _with(FEED, MSG, *_dynamics("feed"), *_dynamics("msg"))
CHECK_SQL["weekly_stayed_compare"] = (
    _both
    + """select 'Feed' as service, cast(week as date) as week,
  round(cast(stayed as double), 6) as stayed from feed_dyn
union all select 'Message', cast(week as date), round(cast(stayed as double), 6) from msg_dyn"""
)
CHECK_SQL["weekly_dynamics_series"] = _both + "\nunion all ".join(
    f"select '{_service}' as service, cast(week as date) as week, '{_metric}' as metric,"
    f" {_metric.lower()} as value from {_table}_dyn"
    for _service, _table in [("Feed", "feed"), ("Message", "msg")]
    for _metric in ["New", "Retained", "Gone"]
)

# Overlap of the services

OVERLAP = [
    FEED,
    MSG,
    "fu as (select distinct user_id, d from feed)",
    "mu as (select distinct user_id, d from msg)",
    """fo as (
  select d, count(*) as n from (select * from fu except select * from mu) group by d)""",
    """mo as (
  select d, count(*) as n from (select * from mu except select * from fu) group by d)""",
    """bo as (
  select d, count(*) as n from (select * from fu intersect select * from mu) group by d)""",
    """usage as (
  select mo.d as event_date, mo.n + fo.n + bo.n as all_users,
    mo.n / (mo.n + fo.n + bo.n) as message_only_share,
    fo.n / (mo.n + fo.n + bo.n) as feed_only_share,
    bo.n / (mo.n + fo.n + bo.n) as both_share
  from mo join fo on fo.d = mo.d join bo on bo.d = mo.d)""",
]
CHECK_SQL["service_usage"] = (
    _with(*OVERLAP)
    + """select event_date, all_users, round(message_only_share, 6) as message_only_share,
  round(feed_only_share, 6) as feed_only_share, round(both_share, 6) as both_share
from usage"""
)
CHECK_SQL["service_usage_stack"] = (
    _with(*OVERLAP)
    + """select event_date, cast(0 as double) as feed_only_bottom,
  round(feed_only_share, 6) as feed_only_top, round(feed_only_share, 6) as both_bottom,
  round(feed_only_share + both_share, 6) as both_top,
  round(feed_only_share + both_share, 6) as message_only_bottom,
  round(feed_only_share + both_share + message_only_share, 6) as message_only_top
from usage"""
)
for _name, _table in [
    ("feed_only_users", "fo"),
    ("message_only_users", "mo"),
    ("both_service_users", "bo"),
]:
    CHECK_SQL[_name] = _with(*OVERLAP) + f"select d as event_date, n as {_name} from {_table}"

# Alerts


def _slots(days: str, closed: str = "true") -> list[str]:
    slot = "time_bucket(interval '15 minutes', time)"
    return [
        FEED,
        MSG,
        f"""ms as (
  select d, {slot} as period, count(distinct user_id) as mes_users, count(*) as sent_messages
  from msg where {days} group by all)""",
        f"""fs as (
  select d, {slot} as period, count(*) filter (action = 'view') as views,
    count(*) filter (action = 'like') as likes, count(distinct user_id) as feed_users
  from feed where {days} group by all)""",
        f"""slots as (
  select ms.d as event_date, ms.period, strftime(ms.period, '%H:%M') as hm,
    mes_users, sent_messages, views, likes, likes / nullif(views, 0) as ctr, feed_users
  from ms join fs on ms.d = fs.d and ms.period = fs.period where {closed})""",
        """series as (
  select period, event_date, cast(hour(period) * 4 + minute(period) // 15 as int) as clock,
    metric, value,
    row_number() over (partition by metric order by period desc) as age
  from (
    select period, event_date, 'Views' as metric, cast(views as double) as value from slots
    union all select period, event_date, 'Likes', likes from slots
    union all select period, event_date, 'CTR', ctr from slots
    union all select period, event_date, 'Feed_users', feed_users from slots
    union all select period, event_date, 'Mes_users', mes_users from slots
    union all select period, event_date, 'Sent_messages', sent_messages from slots))""",
    ]


def _steps(width: int) -> str:
    """Every slot once per clock time that it is near to, and how near."""
    return f"""steps as (
  select *, abs(step) as distance, (clock + step + 96) % 96 as near_clock
  from (select *, unnest(range(-{width}, {width + 1})) as step from series))"""


NEAR = "c.metric = h.metric and c.clock = h.near_clock and h.period < c.period"


def _quantile(value: str, q: float) -> str:
    return (
        f"case when count(*) = count({value}) then quantile_cont({value}, {q}) end"
    )


def _bands(extra: str = "") -> list[str]:
    return [
        _steps(3),
        f"""quart as (
  select c.period, c.metric, {_quantile('h.value', 0.25)} as q25,
    {_quantile('h.value', 0.75)} as q75
  from series c join steps h on {NEAR} {extra} group by c.period, c.metric)""",
        """bands as (
  select s.period, s.metric, s.value, s.age, q25, q75, q75 - q25 as iqr,
    q25 - 2 * (q75 - q25) as low, q75 + 2 * (q75 - q25) as up,
    s.value is null as is_undefined,
    coalesce(s.value > q75 + 2 * (q75 - q25) or s.value < q25 - 2 * (q75 - q25), false)
      as is_anomaly
  from series s left join quart using (period, metric))""",
    ]


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) as {n}" for n in names)


_slot_rows = """select event_date, period, hm, mes_users, sent_messages, views, likes,
  round(ctr, 6) as ctr, feed_users from slots"""
CHECK_SQL["slot_metrics_15m"] = _with(*_slots(ALERT_DAYS)) + _slot_rows
CHECK_SQL["slot_history"] = (
    _with(*_slots(ALERT_DAYS))
    + """select c.period, c.metric, h.period as history_period,
  round(h.value, 6) as history_value
from (select *, unnest(range(-3, 4)) as step from series) h
join series c on c.metric = h.metric and c.clock = (h.clock + h.step + 96) % 96
where c.period > h.period"""
)
CHECK_SQL["iqr_bands"] = (
    _with(*_slots(ALERT_DAYS), *_bands())
    + f"select period, metric, {_r('value', 'q25', 'q75', 'iqr', 'low', 'up')} from bands"
)
_flags = (
    f"select period, metric, {_r('value', 'q25', 'q75', 'iqr', 'low', 'up')},"
    " is_undefined, is_anomaly from bands"
)
CHECK_SQL["anomaly_flags"] = _with(*_slots(ALERT_DAYS), *_bands()) + _flags + " where age = 1"
OWN_DAYS = "and c.event_date - h.event_date in (0, 1, 7, 8, 14, 15)"
CHECK_SQL["anomaly_backtest"] = _with(*_slots("true"), *_bands(OWN_DAYS)) + _flags
# The widths and factors of a grid of back-tests.
GRID_WIDTHS, GRID_FACTORS = (1, 3, 6), (1.5, 2.0, 3.0)
GRID = [
    _steps(max(GRID_WIDTHS)),
    f"""wide as (
  select c.period, c.metric, w.width, {_quantile('h.value', 0.25)} as q25,
    {_quantile('h.value', 0.75)} as q75
  from series c join steps h on {NEAR} {OWN_DAYS}
  join (select unnest({list(GRID_WIDTHS)}) as width) w on h.distance <= w.width
  group by c.period, c.metric, w.width)""",
    f"""judged as (
  select f.a, w.width, s.metric, s.event_date, s.value, q25 - f.a * (q75 - q25) as low,
    q75 + f.a * (q75 - q25) as up
  from series s
  cross join (select unnest({list(GRID_WIDTHS)}) as width) w
  cross join (select cast(unnest({list(GRID_FACTORS)}) as double) as a) f
  left join wide on wide.period = s.period and wide.metric = s.metric and wide.width = w.width)""",
]
CHECK_SQL["anomaly_backtest_grid"] = (
    _with(*_slots("true"), *GRID)
    + """select a as iqr_a, cast(width as int) as neighbour_slots, metric, event_date,
  count(*) as slots, count(low) as with_band,
  count(*) filter (value > up or value < low) as flagged
from judged group by a, width, metric, event_date"""
)

MESSAGES = """told as (
  select now.period, now.metric, now.value, now.age, v2.value as reported_value,
    v3.value as compared_value, abs(1 - v2.value / nullif(v3.value, 0)) as deviation,
    now.metric = 'CTR' and v2.value is null and coalesce(l2.value, 0) > 0 as endless_now,
    now.metric = 'CTR' and v3.value is null and coalesce(l3.value, 0) > 0 as endless_before
  from bands now
  left join bands v2 on v2.metric = now.metric and v2.age = now.age + 1
  left join bands v3 on v3.metric = now.metric and v3.age = now.age + 2
  left join series l2 on l2.metric = 'Likes' and l2.period = v2.period
  left join series l3 on l3.metric = 'Likes' and l3.period = v3.period
  where now.is_anomaly)"""
_tell = """select period, metric, round(value, 6) as value,
  round(reported_value, 6) as reported_value, round(compared_value, 6) as compared_value,
  round(deviation, 6) as deviation,
  -- Fixed values: the text of an alert.
  'Метрика ' || metric || '.' || chr(10) || 'Текущее значение '
    || coalesce(printf('%.2f', reported_value), if(endless_now, 'inf', 'nan'))
    || '. Отклонение более '
    || case when compared_value = 0 and reported_value > 0 then 'inf'
         when endless_now and compared_value is not null then 'inf'
         when endless_before and reported_value is not null then '100.00'
         else coalesce(printf('%.2f', deviation * 100), 'nan') end
    || '%.' || chr(10) as message
from told"""
CHECK_SQL["alert_messages_replay"] = _with(*_slots(ALERT_DAYS), *_bands(), MESSAGES) + _tell
CHECK_SQL["alert_messages"] = CHECK_SQL["alert_messages_replay"] + " where age = 1"
# A run judges the newest slot that had ended by its time.
CHECK_SQL["alert_run"] = (
    CHECK_SQL["alert_messages_replay"]
    + """ where period =
  (select max(period) from slots where period < timestamp '2024-01-30 16:30:00')"""
)
CHECK_SQL["slots_from_store"] = CHECK_SQL["slot_metrics_15m"]
CHECK_SQL["weekly_from_store"] = CHECK_SQL["feed_weekly_dynamics"]
CHECK_SQL["weekly_from_seen"] = CHECK_SQL["feed_weekly_dynamics"]

# The streams emit the slots that ended an hour before the newest event of the
# service that is behind; watermarks keep whole milliseconds.
CLOSED = """ms.period + interval '15 minutes' <= (select date_trunc('milliseconds',
    least((select max(time) from feed), (select max(time) from msg))) - interval '1 hour')"""
CHECK_SQL["stream_slot_metrics"] = _with(*_slots("true", CLOSED)) + _slot_rows
CHECK_SQL["stream_alerts"] = (
    _with(*_slots("true", CLOSED), *_bands(OWN_DAYS), MESSAGES) + _tell
)
# Rows that come late, but none of the newest day, change nothing about that.
CHECK_SQL["stream_alerts_late"] = CHECK_SQL["stream_alerts"]

CHART = [
    _steps(3),
    """given as (
  select c.metric, c.period as centre, h.period, h.value,
    max(h.period) over (partition by c.metric, c.period) as target
  from series c join steps h on """
    + NEAR
    + """ where c.age <= 101)""",
    f"""given_bands as (
  select metric, centre, target as period,
    case when count(*) filter (period < target) > 0
      and count(*) filter (period < target) = count(value) filter (period < target)
      then quantile_cont(value, 0.25) filter (period < target) end as q25,
    case when count(*) filter (period < target) > 0
      and count(*) filter (period < target) = count(value) filter (period < target)
      then quantile_cont(value, 0.75) filter (period < target) end as q75
  from given group by metric, centre, target
  union all
  select c.metric, c.period, c.period, {_quantile('h.value', 0.25)},
    {_quantile('h.value', 0.75)}
  from series c left join steps h on {NEAR} where c.age = 1
  group by c.metric, c.period)""",
    """raw as (
  select metric, period, centre, q25, q75, q75 - q25 as iqr,
    q25 - 2 * (q75 - q25) as low, q75 + 2 * (q75 - q25) as up
  from given_bands
  qualify row_number() over (partition by metric, period order by centre) = 1)""",
    """smooth as (
  select metric, s.period, s.value, s.age,
    avg(low) over near_by as low, avg(up) over near_by as up
  from series s left join raw using (metric, period) where s.age <= 102
  window near_by as (
    partition by metric order by s.period rows between 2 preceding and 2 following))""",
]
CHECK_SQL["band_backfill"] = (
    _with(*_slots(ALERT_DAYS), *CHART)
    + f"""select period, metric,
  cast(date_diff('minute', period, centre) // 15 as bigint) as centre_lead,
  {_r('q25', 'q75', 'iqr', 'low', 'up')} from raw"""
)
CHECK_SQL["band_smoothing"] = (
    _with(*_slots(ALERT_DAYS), *CHART)
    + f"select period, metric, {_r('value', 'low', 'up')} from smooth"
)
CHECK_SQL["alert_chart_series"] = (
    _with(*_slots(ALERT_DAYS), *CHART)
    + f"""select period, strftime(period, '%H:%M') as hm, metric,
  upper(metric[1]) || lower(metric[2:]) as title, {_r('value', 'low', 'up')}
from smooth where age <= 96"""
)
