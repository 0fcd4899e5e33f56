"""The registered queries restated in SQL over the raw tables."""

from __future__ import annotations

# The clean edits of the ``events`` table, and its documents.
_EDIT_COLUMNS = """
edits as (
  select event_id, ts as event_time,
    'Page_' || json_extract_string(props, '$.k') as page_title,
    (event_id % 16)::INT as namespace, event_type as change_type,
    case when user_id % 5 <> 0 then user_id end as user_id,
    case when event_id % 40 <> 9 then user_id % 3 = 0 end as is_bot,
    case when event_id % 30 <> 11 then 1000 end as old_length,
    floor(value * 20)::INT as new_length,
    case when event_id % 10 = 3 then ts + interval 40 minutes
         else ts + interval 5 seconds end as ingestion_time
  from {source}
)"""


def _edits(source: str = "events") -> str:
    return _EDIT_COLUMNS.replace("{source}", source)


_EDITS = _edits()

_DERIVED = """
    case when bytes_diff > 500 then 'LARGE' when bytes_diff < -500 then 'LARGE_REMOVAL'
         else 'SMALL' end as edit_size,
    case when is_bot then 'BOT' when user_id is null then 'ANONYMOUS'
         else 'REGISTERED' end as user_type"""


def _seconds_between(later: str, earlier: str) -> str:
    return f"(floor(epoch({later})) - floor(epoch({earlier})))::BIGINT"


# ``silver`` and what the deliveries add, each without the edits it is made of.
_SILVER_STEP = f"""
silver as (
  select event_id::VARCHAR as event_id, event_time, page_title, namespace, change_type, user_id,
    is_bot, bytes_diff, {_seconds_between('ingestion_time', 'event_time')}
      as processing_delay_seconds, {_DERIVED}, ingestion_time
  from (select *, new_length - old_length as bytes_diff from edits)
)"""
_SILVER = f"{_EDITS},{_SILVER_STEP}"


def _json(new_length: str) -> str:
    return f"""'{{"meta":{{"id":"' || event_id || '","dt":"'
    || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '"}},"title":"' || page_title
    || '","namespace":' || namespace || ',"type":"' || change_type || '","user":{{'
    || concat_ws(',', case when user_id is not null then '"id":' || user_id end,
                      case when is_bot is not null then '"is_bot":' || is_bot end)
    || '}},"length":{{'
    || concat_ws(',', case when old_length is not null then '"old":' || old_length end,
                      '"new":' || ({new_length})) || '}}}}'"""


_RAW_STEP = f"""
deliveries as (
  select *, {_json('new_length')} as raw_json, event_id as "offset",
    ingestion_time as arrival, 0 as added, true as good from edits
  union all
  select *, {_json('new_length')}, event_id + 1000000000,
    ingestion_time + interval 1 second, 0, true from edits where event_id % 20 = 0
  union all
  select *, 'not json', event_id + 2000000000, ingestion_time, 0, false
  from edits where event_id % 50 = 7
)"""
_RAW = f"{_EDITS},{_RAW_STEP}"

_REVISED_STEP = f"""{_RAW_STEP},
all_deliveries as (
  select * from deliveries
  union all
  select *, {_json('new_length + 100')}, event_id + 3000000000,
    ingestion_time + interval 1 hour, 100, true from edits where event_id % 25 = 0
),
latest as (
  select event_id::VARCHAR as event_id, event_time, page_title, namespace, change_type, user_id,
    is_bot, bytes_diff, {_seconds_between('arrival', 'event_time')}
      as processing_delay_seconds, {_DERIVED}, arrival
  from (
    select *, new_length + added - old_length as bytes_diff,
      row_number() over (partition by event_id order by arrival desc, "offset" desc) as rn
    from all_deliveries where good
  ) where rn = 1
)"""
_REVISED = f"{_EDITS},{_REVISED_STEP}"

_SILVER_COLUMNS = """event_id, event_time, page_title, namespace, change_type, user_id, is_bot,
  bytes_diff, processing_delay_seconds, edit_size, user_type"""

_MEASURES = """
    count(*) as total_edits,
    count(distinct user_id) as unique_editors,
    count(distinct page_title) as active_pages,
    count(*) filter (where user_type = 'BOT') as bot_edits,
    count(*) filter (where user_type <> 'BOT') as human_edits,
    sum(bytes_diff)::BIGINT as net_bytes_added,
    avg(bytes_diff) as avg_bytes_per_edit,
    count(*) filter (where abs(bytes_diff) > 500) as large_edits_count,
    count(*) filter (where bytes_diff < -500) as revert_like_edits,
    sum(abs(bytes_diff))::BIGINT as volatility_score"""


def _gold(name: str, source: str, where: str = "true") -> str:
    return f"""
{name} as (
  select *, bot_edits / total_edits * 100 as bot_edit_percentage,
    total_edits / 5.0::DOUBLE as edits_per_minute,
    case when net_bytes_added > 0 then 'GROWING' when net_bytes_added < 0 then 'SHRINKING'
         else 'STABLE' end as knowledge_trend
  from (
    select time_bucket(interval '5 minutes', event_time) as window_start,
      time_bucket(interval '5 minutes', event_time) + interval 5 minutes as window_end, {_MEASURES}
    from {source} where {where} group by 1, 2
  )
)"""


def _late(unit: str) -> str:
    return f"""{_SILVER},
arrived as (
  select *, date_trunc('{unit}', ingestion_time)::TIMESTAMP as batch,
    time_bucket(interval '5 minutes', event_time) + interval 5 minutes as window_end
  from silver
),
marks as (
  select batch, max(max(event_time)) over (
      order by batch rows between unbounded preceding and 1 preceding)
    - interval 10 minutes as watermark
  from arrived group by batch
),
marked as (
  select arrived.*, watermark, coalesce(window_end <= watermark, false) as is_late
  from arrived join marks using (batch)
)"""

_NOW = "(select max(ts) from events)"
_CORRECTED = _gold(
    "corrected",
    "silver",
    f"event_time >= time_bucket(interval '5 minutes', {_NOW} - interval 24 hours)",
)
_HELD = f"""
held as (select * from silver where ingestion_time < {_NOW} - interval 12 hours),
replayed as (select * from latest where arrival >= {_NOW} - interval 24 hours)"""

_SILVER_AND_LATEST = f"{_EDITS},{_SILVER_STEP},{_REVISED_STEP}"

_UPSERT = f"""with {_SILVER_AND_LATEST}, {_HELD}
select {_SILVER_COLUMNS} from replayed
union all
select {_SILVER_COLUMNS} from held where event_id not in (select event_id from replayed)"""

# What live Gold makes of weekly arrivals: its sketched counts are near the exact ones.
_LIVE = f"{_late('week')}, {_gold('live', 'marked', 'not is_late')}"
_NEAR = "true as unique_editors_near, true as active_pages_near"
_LIVE_COLUMNS = "* exclude (unique_editors, active_pages)"

# The edits whose id is a multiple of 25 moved by three days.
_MOVED = """moved as (
  select * replace (case when event_id % 25 = 0 then ts + interval 3 days else ts end as ts)
  from events
)"""


def _reduced(source: str, where: str = "true") -> str:
    return f"""select time_bucket(interval '10 minutes', event_time) as window_start,
          time_bucket(interval '10 minutes', event_time) + interval 10 minutes as window_end,
          count(*) as total_edits, count(distinct user_id) as unique_editors,
          count(*) filter (where is_bot) as bot_edits,
          count(*) filter (where not is_bot) as human_edits,
          sum(bytes_diff)::BIGINT as net_bytes_added
        from {source} where {where} group by 1, 2"""


def _per_period(unit: str, measures: str, source: str = "silver", keys: str = "") -> str:
    time_col = "window_start" if source == "gold" else "event_time"
    return (
        f"select date_trunc('{unit}', {time_col})::TIMESTAMP as period_start{keys}, {measures} "
        f"from {source} group by all"
    )


ORACLES: dict[str, str] = {
    "envelope_build": f"""with {_EDITS}
        select event_id::VARCHAR as key, {_json('new_length')} as value from edits
        union all
        select 'unknown', '{{"title":"' || page_title || '"}}' from edits where event_id % 50 = 9""",
    "feed_frames": f"""with {_EDITS}, texts as (select *, {_json('new_length')} as text from edits),
        lines as (
        select event_id, 'message' as event, text as data from texts
        union all select event_id, 'message', 'not json' from texts where event_id % 50 = 7
        union all select event_id, 'message', '[1]' from texts where event_id % 50 = 8
        union all select event_id, 'message', '{{"title":"' || page_title || '"}}' from texts
          where event_id % 50 = 9
        union all select event_id, 'message', '{{"meta":' || text from texts where event_id % 50 = 10
        union all select event_id, 'heartbeat', text from texts where event_id % 50 = 11)
        select event_id::VARCHAR as id, event, case when event_id % 7 = 0
          then replace(data, ',"title"', ',' || chr(10) || '"title"') else data end as data from lines""",
    "bronze_project": f"""with {_RAW}
        select event_id::VARCHAR as event_key, raw_json, 'edits.raw' as topic,
          (event_id % 4)::INT as partition, "offset", arrival as kafka_timestamp,
          arrival as ingestion_time from deliveries""",
    "bronze_replay_scan": f"""with {_RAW}
        select event_id::VARCHAR as event_key, "offset", raw_json, arrival as ingestion_time
        from deliveries where arrival >= {_NOW} - interval 24 hours""",
    "silver_parse": f"""with {_RAW}
        select event_id::VARCHAR as event_key, "offset",
          case when good then event_id::VARCHAR end as meta_id,
          case when good then event_time end as meta_dt,
          case when good then page_title end as title,
          case when good then namespace end as namespace,
          case when good then change_type end as type,
          case when good then user_id end as user_id,
          case when good then is_bot end as user_is_bot,
          case when good then old_length end as length_old,
          case when good then new_length end as length_new
        from deliveries""",
    "silver_quarantine": f"""with {_RAW}
        select event_id::VARCHAR as event_key, raw_json, 'edits.raw' as topic,
          (event_id % 4)::INT as partition, "offset", arrival as kafka_timestamp,
          arrival as ingestion_time from deliveries where not json_valid(raw_json)""",
    "silver_flatten": f"""with {_RAW}
        select json_extract_string(raw_json, '$.meta.id') as event_id,
          json_extract_string(raw_json, '$.meta.dt')::TIMESTAMP as event_time,
          json_extract_string(raw_json, '$.title') as page_title,
          json_extract_string(raw_json, '$.namespace')::INT as namespace,
          json_extract_string(raw_json, '$.type') as change_type,
          json_extract_string(raw_json, '$.user.id')::BIGINT as user_id,
          json_extract_string(raw_json, '$.user.is_bot')::BOOLEAN as is_bot,
          json_extract_string(raw_json, '$.length.new')::INT
            - json_extract_string(raw_json, '$.length.old')::INT as bytes_diff,
          "offset"
        from deliveries where good""",
    "silver_delay": f"""with {_RAW}
        select event_id::VARCHAR as event_id, "offset",
          {_seconds_between('arrival', 'event_time')} as processing_delay_seconds
        from deliveries where good""",
    "silver_classify": f"""with {_RAW}
        select event_id::VARCHAR as event_id, "offset", bytes_diff, is_bot, user_id, {_DERIVED}
        from (select *, new_length - old_length as bytes_diff from deliveries where good)""",
    "silver_dedup": f"with {_SILVER} select {_SILVER_COLUMNS} from silver",
    "gold_kpis_5m": f"with {_SILVER}, {_gold('gold', 'silver')} select * from gold",
    "bronze_to_gold": f"with {_SILVER}, {_gold('gold', 'silver')} select * from gold",
    "gold_approx_error": f"""with {_SILVER}
        select date_trunc('day', event_time)::TIMESTAMP as window_start,
          count(distinct user_id) as unique_editors, count(distinct page_title) as active_pages,
          true as unique_editors_near, true as active_pages_near
        from silver group by 1""",
    "gold_approx_distinct": f"""with {_SILVER}, {_gold('gold', 'silver')}
        select window_start, window_end, unique_editors, active_pages, {_NEAR} from gold""",
    **{
        name: f"""with {_SILVER}
        select date_trunc('{unit}', {moment})::TIMESTAMP as period_start, count(*) as total_edits,
          count(distinct user_id) as exact_editors, count(distinct page_title) as exact_pages,
          true as unique_editors_near, true as active_pages_near
        from silver group by 1"""
        for name, unit, moment in (
            ("gold_sketches", "minute", "time_bucket(interval '5 minutes', event_time)"),
            ("dash_platform_rollup", "hour", "event_time"),
        )
    },
    "top_pages_rollup": f"""with {_SILVER}
        select page_title, count(*) as edits from silver group by 1""",
    "silver_variant": f"""with {_SILVER}
        select event_id, event_time, page_title, user_id is not null as has_user, is_bot, bytes_diff, edit_size,
          user_type, case when event_id::BIGINT % 7 = 0 then 'wiki' else '' end as unknown_fields,
          case when event_id::BIGINT % 7 = 0 then 'w' end as wiki
        from silver""",
    "quarantine_reasons": f"""with {_EDITS}
        select 'not json' as raw_json, 'not json' as reason from edits where event_id % 50 = 7
        union all select '[1]', 'not an object' from edits where event_id % 50 = 8
        union all select '{{"title":"' || page_title || '"}}', 'no id' from edits where event_id % 50 = 9
        union all select '{{"meta":' || {_json('new_length')}, 'not json' from edits where event_id % 50 = 10""",
    "service_progress": f"""with {_RAW}
        select 'bronze_log' as query, count(*) as input_rows, 0::BIGINT as dropped_rows from deliveries
        union all select 'silver_log', count(*), 0 from deliveries
        union all select 'gold_live', count(*), 0 from events""",
    "dedup_state": "select event_id::VARCHAR as event_id from events",
    "gold_replay_kpis": f"with {_SILVER} "
    + _reduced("silver", f"event_time >= {_NOW} - interval 24 hours"),
    "gold_replay_stored": f"with {_SILVER} " + _reduced("silver"),
    **{
        name: f"with {_MOVED}, {_edits('moved')},{_SILVER_STEP}, {_gold('gold', 'silver')} select * from gold"
        for name in ("replay_after_break", "gold_corrected_windows")
    },
    "silver_feed_shape": f"""with {_SILVER}
        select event_id, event_time, page_title, user_id is not null as has_user, is_bot,
          bytes_diff, edit_size, user_type from silver""",
    "quarantine_stream": f"""with {_RAW}
        select event_id::VARCHAR as event_key, raw_json, 'edits.raw' as topic,
          (event_id % 4)::INT as partition, "offset", arrival as kafka_timestamp
        from deliveries where not good""",
    "ddl_tables": f"""with {_SILVER}, {_gold('gold', 'silver')}
        select 'silver_serving' as table_name, event_time::DATE as day, count(*) as stored
        from silver group by 2
        union all
        select 'gold_corrected', window_start::DATE, count(*) from gold group by 2""",
    "late_rows": f"""with {_late('hour')}
        select event_id, event_time, ingestion_time, batch, window_end, watermark
        from marked where is_late""",
    "late_rows_stream": f"""with {_late('day')}
        select event_id, event_time, window_end, date_trunc('milliseconds', watermark)::TIMESTAMP as watermark
        from marked where is_late""",
    "replay_dedup": f"with {_REVISED} select {_SILVER_COLUMNS} from latest",
    "upsert_matched": f"""with {_SILVER_AND_LATEST}, {_HELD}
        select {_SILVER_COLUMNS} from replayed
        where event_id in (select event_id from held)""",
    "upsert_inserts": f"""with {_SILVER_AND_LATEST}, {_HELD}
        select {_SILVER_COLUMNS} from replayed
        where event_id not in (select event_id from held)""",
    "silver_upsert": _UPSERT,
    "silver_upsert_table": _UPSERT,
    "upsert_indexed": _UPSERT,
    "gold_corrected": f"with {_SILVER}, {_CORRECTED} select * from corrected",
    "gold_served": f"""with {_LIVE}, {_CORRECTED}
        select {_LIVE_COLUMNS} from corrected
        union all
        select {_LIVE_COLUMNS} from live where window_start not in (select window_start from corrected)""",
    "late_correction": f"""with {_REVISED}, {_gold('gold', 'latest')} select * from gold""",
    "dash_live_edits": f"""with {_SILVER}
        select event_time, event_id, page_title, change_type, user_id, user_type, edit_size,
          bytes_diff from silver
        where user_type = 'REGISTERED' and edit_size = 'LARGE' and change_type = 'click'""",
    "dash_velocity": f"""with {_SILVER}
        select time_bucket(interval '1 minute', event_time) as window_start, count(*) as edits
        from silver group by 1""",
    "dash_user_distribution": f"""with {_SILVER}
        select user_type, count(*) as edits,
          count(*) / (select count(*) from silver) * 100 as share_percentage
        from silver group by 1""",
    "dash_top_pages": f"""with {_SILVER}
        select page_title, count(*) as edits from silver group by 1
        order by edits desc, page_title limit 10""",
    "dash_platform_activity": f"with {_SILVER} "
    + _per_period(
        "hour",
        "count(*) as total_edits, count(distinct user_id) as unique_editors, "
        "count(distinct page_title) as active_pages",
    ),
    "dash_bot_vs_human": f"""with {_SILVER}
        select *, bot_edits / total_edits * 100 as bot_percentage,
          human_edits / total_edits * 100 as human_percentage
        from ({_per_period('day', "count(*) as total_edits, "
            "count(*) filter (where user_type = 'BOT') as bot_edits, "
            "count(*) filter (where user_type <> 'BOT') as human_edits")})""",
    "dash_edit_intensity": f"with {_SILVER} "
    + _per_period(
        "day",
        "avg(bytes_diff) as avg_bytes_per_edit, "
        "sum(abs(bytes_diff))::BIGINT as volatility_score, "
        "sum(bytes_diff)::BIGINT as net_bytes_added, "
        "count(*) filter (where abs(bytes_diff) > 500) as large_edits_count",
    ),
    "dash_knowledge_trend": f"with {_SILVER}, {_gold('gold', 'silver')} "
    + _per_period("day", "count(*) as windows", "gold", ", knowledge_trend"),
    "dash_engagement": f"""with {_SILVER}
        select *, case when unique_editors > 0 then edits / unique_editors end as edits_per_editor
        from ({_per_period('day', "count(*) as edits, "
            "count(distinct user_id) as unique_editors", keys=", user_type")})""",
    "day_partition_counts": f"""with {_SILVER}
        select event_time::DATE as event_date, count(*) as edits from silver group by 1""",
    "retention_expired": f"""
        select event_type as "table", event_id as version, ts as committed_at
        from (select *, row_number() over (
                partition by event_type order by ts desc, event_id desc) as age_rank from events)
        where age_rank > 5 and ts < {_NOW} - interval 2 hours""",
    "retention_rules": f"""
        select "table", version, committed_at
        from (
          select *, row_number() over (
              partition by "table" order by committed_at desc, version desc) as age_rank
          from (
            select case event_type when 'view' then 'bronze' when 'click' then 'silver'
                else 'gold' end as "table", event_id as version, ts as committed_at from events
          )
        ) join (values ('bronze', 3, 12), ('silver', 2, 8), ('gold', 2, 5))
          as rules(name, max_hours, keep) on name = "table"
        where age_rank > keep and committed_at < {_NOW} - to_hours(max_hours)""",
    "orphan_files": """
        select ts::DATE::VARCHAR as day, count(distinct event_id % 3) as orphans
        from events group by 1""",
    "compaction_plan": """
        select ts::DATE::VARCHAR as partition, count(distinct event_id % 8) as input_files,
          count(distinct event_id % 8) as small_files, 1::BIGINT as output_files
        from events group by 1 having count(distinct event_id % 8) >= 5""",
    "compaction_rowcheck": f"with {_SILVER} select {_SILVER_COLUMNS} from silver",
    "compaction_by_pages": f"with {_SILVER} select {_SILVER_COLUMNS} from silver",
    "bronze_ingest": f"""with {_RAW}
        select event_id::VARCHAR as event_key, raw_json, 'edits.raw' as topic,
          (event_id % 4)::INT as partition, "offset", arrival as kafka_timestamp
        from deliveries""",
    **{
        name: f"""with {_SILVER}
        select {_SILVER_COLUMNS.replace('processing_delay_seconds, ', '')} from silver"""
        for name in ("silver_stream", "silver_stream_horizon", "silver_stream_long")
    },
    "gold_stream": f"with {_LIVE} select {_LIVE_COLUMNS}, {_NEAR} from live",
    "chain_available_now": f"with {_SILVER}, {_gold('gold', 'silver')} "
    f"select {_LIVE_COLUMNS} from gold",
}
