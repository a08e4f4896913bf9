"""SQL for DuckDB that gives the same rows as the registered queries."""

from __future__ import annotations

_MESSAGES = """
base as (
  select event_id, ts, event_type, props,
         (event_id * 7919) % 1000003 + (event_id // 1000003) * 1000003 as "offset",
         cast((user_id % 16) % 4 as integer) as "partition",
         'cam-' || (user_id % 16) as camera,
         strftime(ts, '%Y-%m-%d %H') || ':00:00.0' as stamp,
         (case when event_id % 107 = 0 then '***' else '' end)
           || to_base64(encode(substr(sha256(cast(event_id as varchar)), 1,
                        case when event_id % 109 = 0 then 40 else 48 end))) as data
  from events),
msg as (
  select *, cast("offset" // 100001 as integer) as batch_id, 'frames-replayed' as topic,
         case when event_id % 89 <> 0 then camera end as key,
         case when event_id % 101 = 0 then event_type
              when event_id % 97 = 0 then props
              when event_id % 206 = 0 then ''
              when event_id % 103 = 0 then null
              else '{"cameraId":"' || camera || '","timestamp":"' || stamp || '","rows":'
                   || (case when event_id % 113 = 0 then '"4"' when event_id % 131 = 0 then '2147483647' else '4' end)
                   || ',"cols":' || (case when event_id % 131 = 0 then '2147483647' else '4' end) || ',"type":'
                   || (case when event_id % 131 = 0 then '2147483640' when event_id % 127 = 0 then '18' else '16' end)
                   || ',"data":"' || data || '"}'
         end as message
  from base)
"""

_FRAMES = (
    _MESSAGES
    + """,
doc as (select *, case when json_valid(message) then message end as js from msg),
field as (
  select topic, "partition", "offset", batch_id, message, js,
         js ->> '$.cameraId' as "cameraId", js ->> '$.timestamp' as "timestamp",
         json_type(js, '$.rows') as rows_kind,
         try_cast(js ->> '$.rows' as integer) as "rows", try_cast(js ->> '$.cols' as integer) as cols,
         try_cast(js ->> '$.type' as integer) as "type", js ->> '$.data' as data
  from doc),
judged as (
  select *, case
    when message is null or trim(message) = '' then 'empty'
    when js is null or json_type(js) <> 'OBJECT' or rows_kind = 'VARCHAR' then 'malformed'
    when "cameraId" is null or "timestamp" is null or "rows" is null or cols is null
         or "type" is null or data is null then 'missing field'
    when "type" & 7 <> 0 then 'bad type'
    when not regexp_full_match(data, '([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}(==)?|[A-Za-z0-9+/]{3}=?)?')
      then 'bad base64'
    when length(rtrim(data, '=')) * 3 // 4 <> cast("rows" as hugeint) * cols * (("type" >> 3) + 1) then 'bad length'
    end as reason
  from field),
good as (
  select topic, "partition", "offset", batch_id, "cameraId", "timestamp", "rows", cols, "type", data
  from judged where reason is null)
"""
)

_EMITTED = (
    _FRAMES
    + """,
ranked as (
  select *,
    row_number() over (partition by "cameraId", batch_id
                       order by "timestamp" desc, "partition" desc, "offset" desc) as place,
    count(*) over (partition by "cameraId", batch_id) as n_frames,
    min(batch_id) over (partition by "cameraId") as first_batch
  from good),
emitted as (
  select "cameraId", batch_id, "timestamp", "rows", cols, "type", data, "partition", "offset",
    n_frames, batch_id > first_batch as had_state,
    lag("timestamp") over (partition by "cameraId" order by batch_id) as prev_timestamp,
    n_frames - (case when batch_id = first_batch then 1 else 0 end) as n_saved
  from ranked where place = 1),
numbered as (
  select *, row_number() over (partition by "cameraId"
              order by batch_id, "timestamp", "partition", "offset") > 1 as saved
  from good)
"""
)

_FIRST = """,
first_rec as (
  select * from (select *, row_number() over (partition by batch_id order by "partition", "offset") as nr
                 from {source})
  where nr = 1)
"""

# Gray value of each number of an embedding.
_GRAY = """
gray as (
  select vec_id as frame_id, 'cam-' || label as "cameraId", place // 8 as y, place % 8 as x, 0 as c, v
  from (select vec_id, label, unnest(range(64)) as place,
               unnest(list_transform(embedding, lambda e:
                 cast(greatest(0, least(255, floor((cast(e as double) + 1) * 128))) as bigint))) as v
        from embeddings))
"""

# Pixels of the event frames.
_EVENT_PIXELS = """,
spot as (
  select "offset" as frame_id, "partition", unnest(range(48)) as p,
         hex(from_base64(data)) as bytes
  from good),
px as (
  select frame_id, "partition", p // 12 as y, (p // 3) % 4 as x, p % 3 as c,
         cast('0x' || substr(bytes, 2 * p + 1, 2) as bigint) as v
  from spot)
"""


def _axis(name: str, source: int, target: int) -> str:
    """Weights of one axis: target position `i`, source position `k`, `w`."""
    return f"""
{name}_t as (
  select i, floor(f) as s, f - floor(f) as t, f - floor(f) + 1 as u, 1 - (f - floor(f)) as r
  from (select i, (i + 0.5::double) * ({source}::double / {target}::double) - 0.5::double as f
        from (select cast(range as double) as i from range({target})))),
{name}_w as (
  select i, s, ((-0.75::double * u + 3.75::double) * u - 6.0::double) * u + 3.0::double as w0,
         (1.25::double * t - 2.25::double) * t * t + 1 as w1,
         (1.25::double * r - 2.25::double) * r * r + 1 as w2
  from {name}_t),
{name} as (
  select cast(i as bigint) as i, cast(greatest(0, least({source - 1}, k)) as bigint) as k,
         sum(cast(round_even(w * 2048, 0) as bigint)) as w
  from (select i, unnest([s - 1, s, s + 1, s + 2]) as k, unnest([w0, w1, w2, 1 - w0 - w1 - w2]) as w
        from {name}_w)
  group by 1, 2)
"""


def _resized(pixels: str, source: tuple[int, int], target: tuple[int, int]) -> str:
    """`big`: resized pixels of the table `pixels`; `whole`: one row per frame."""
    return f""",
{_axis("wy", source[0], target[0])},
{_axis("wx", source[1], target[1])},
wide as (
  select frame_id, y, wx.i as x, c, sum(v * w) as v from {pixels} join wx on wx.k = x group by all),
big as (
  select frame_id, wy.i as y, x, c,
         greatest(0, least(255, cast(sum(v * w) + 2097152 as bigint) // 4194304)) as v
  from wide join wy on wy.k = y group by frame_id, wy.i, x, c),
whole as (
  select frame_id, string_agg(printf('%02X', cast(v as integer)), '' order by y, x, c) as pixels
  from big group by 1)
"""


# Two sums over the 300,000 pixels of each frame. Per frame and column, the eight
# source values lie in a list; each line takes its four from there.
_VGA = f"""with {_GRAY},
{_axis("wy", 8, 480)},
{_axis("wx", 8, 640)},
wide as (
  select frame_id, y, wx.i as x, cast(sum(v * w) as bigint) as v from gray join wx on wx.k = x group by all),
down as (select frame_id, x, list(v order by y) as vs from wide group by all),
line as (select i, list(k + 1 order by k) as ks, list(w order by k) as ws from wy group by i),
big as (
  select frame_id, i * 640 + x as place,
         greatest(0, least(255, (vs[ks[1]] * ws[1] + coalesce(vs[ks[2]] * ws[2], 0) + coalesce(vs[ks[3]] * ws[3], 0)
           + coalesce(vs[ks[4]] * ws[4], 0) + 2097152) // 4194304)) as v
  from down cross join line)
select frame_id, 480 as "rows", 640 as cols, 0 as "type", cast(sum(v) as bigint) as total,
       cast(sum(v * (place % 65521)) as bigint) as placed
from big group by frame_id"""


_STAMP = "regexp_replace(strftime({at}, '%Y-%m-%d %H:%M:%S.%g'), '0{{1,2}}$', '')"

# What the image file of a frame of three channels shows: the channels swapped.
_SHOWN = """
  batch_id, "partition", "offset", cols as width, "rows" as height, 3 as channels,
  (select string_agg(substr(h, 6 * p + 5, 2) || substr(h, 6 * p + 3, 2) || substr(h, 6 * p + 1, 2), '' order by p)
   from (select unnest(range(len(h) // 6)) as p)) as pixels
"""

_EXPORTED = (
    _EMITTED
    + """,
pathed as (
  select *, '/out/' || "cameraId" || '-T-' || regexp_replace("timestamp", '[ .:]', '-', 'g') || '.png' as path,
         hex(from_base64(data)) as h
  from numbered where saved),
latest as (
  select *, row_number() over (partition by path
              order by batch_id desc, "timestamp" desc, "partition" desc, "offset" desc) as nr from pathed)
"""
)
_EXPORT_SQL = f"with {_EXPORTED} select path, {_SHOWN} from latest where nr = 1"

_LINE = "'Key: ' || coalesce(key, 'null') || ';Value: ' || coalesce(message, 'null')"

_EMIT_SQL = f"with {_EMITTED} select * from emitted"
_FIRST_SQL = (
    f"with {_MESSAGES} {_FIRST.format(source='msg')} "
    'select batch_id, "partition", "offset", message from first_rec'
)
_PARSE_SQL = f"with {_FRAMES} select * from good"

_ORDER_SQL = f"""with {_FRAMES}
        select "cameraId", batch_id, "timestamp", "partition", "offset",
               row_number() over (partition by "cameraId", batch_id
                                  order by "timestamp", "partition", "offset") as position,
               lag(batch_id) over h as prev_batch_id, lag("timestamp") over h as prev_timestamp,
               lag("partition") over h as prev_partition, lag("offset") over h as prev_offset,
               lag(batch_id) over h is not null as saved
        from good
        window h as (partition by "cameraId" order by batch_id, "timestamp", "partition", "offset")"""

_FINAL_SQL = f"""with {_EMITTED}
        select "cameraId", batch_id, "timestamp", "rows", cols, "type", data, "partition", "offset"
        from emitted e
        where batch_id = (select max(batch_id) from good g where g."cameraId" = e."cameraId")"""

# The hash of keys, step by step; the constants are those of the public algorithm.
_PARTITIONS = """with keys as (
  select 'camera' as kind, event_id as id, case when event_id % 89 <> 0 then 'cam-' || (user_id % 16) end as key from events
  union all
  select 'user', event_id, user_id || repeat('.', cast(event_id % 5 as integer)) from events
  union all
  select 'part', p_partkey, p_name from part),
hexed as (select *, hex(encode(key)) as d, octet_length(encode(key)) as size from keys),
words as (
  select *,
    list_transform(range(size // 4), lambda i: cast('0x' || d[8*i+7:8*i+8] || d[8*i+5:8*i+6] || d[8*i+3:8*i+4] || d[8*i+1:8*i+2] as bigint)) as ws,
    case when size % 4 = 0 then 0 else cast('0x'
      || case when size % 4 = 3 then d[2*size-1:2*size] else '' end
      || case when size % 4 >= 2 then d[8*(size//4)+3:8*(size//4)+4] else '' end
      || d[8*(size//4)+1:8*(size//4)+2] as bigint) end as tail
  from hexed),
mixed as (
  select kind, id, key, size, tail, list_transform(
    list_transform(ws, lambda w: (w * 1540483477) & 4294967295), lambda w: (xor(w, w >> 24) * 1540483477) & 4294967295) as ws
  from words),
folded as (
  select kind, id, key, size, tail,
    list_reduce(list_prepend(xor(cast(2538058380 as bigint), size), ws), lambda h, w: xor((h * 1540483477) & 4294967295, w)) as h
  from mixed),
tailed as (
  select kind, id, key, case when size % 4 = 0 then h else (xor(h, tail) * 1540483477) & 4294967295 end as h from folded),
last as (select kind, id, key, (xor(h, h >> 13) * 1540483477) & 4294967295 as h from tailed)
select kind, id, key, cast((xor(h, h >> 15) & 2147483647) % 12 as integer) as "partition" from last"""

ORACLE: dict[str, str] = {
    "topic_records": f"""with {_MESSAGES}
        select key, message as value, topic, "partition", "offset", cast(ts as varchar) as "timestamp",
               0 as "timestampType", batch_id from msg""",
    "value_text": f'with {_MESSAGES} select topic, "partition", "offset", batch_id, message from msg',
    "parse_frames": _PARSE_SQL,
    "reject_messages": f"""with {_FRAMES}
        select topic, "partition", "offset", batch_id, message, reason
        from judged where reason is not null""",
    "parse_objects": f"""with {_MESSAGES},
        changed as (
          select "partition", "offset", case
            when "offset" % 7 = 0 then '[' || message || ']'
            when "offset" % 5 = 0 and message like '%"}}' then message[:-2] || ',"site":{{"name":"s","floor":2}},"quality":0.5}}'
            else message end as message
          from msg),
        doc as (select *, case when json_valid(message) then message end as js from changed),
        field as (
          select *, case when json_type(js) = 'OBJECT' then js end as obj from doc),
        typed as (
          select *, obj ->> '$.cameraId' as "cameraId", obj ->> '$.timestamp' as "timestamp", try_cast(obj ->> '$.rows' as integer) as "rows",
                 try_cast(obj ->> '$.cols' as integer) as cols, try_cast(obj ->> '$.type' as integer) as "type", obj ->> '$.data' as data
          from field)
        select "partition", "offset", "cameraId", "timestamp", "rows", cols, "type", data,
               array_to_string(list_sort(list_filter(json_keys(obj), lambda k: k not in ('cameraId', 'timestamp', 'rows', 'cols', 'type', 'data'))), ',') as extra,
               case when message is null or trim(message) = '' then 'empty'
                    when js is null then 'malformed'
                    when obj is null then 'no object'
                    when "cameraId" is null or "timestamp" is null or (obj ->> '$.rows') is null or (obj ->> '$.cols') is null
                         or (obj ->> '$.type') is null or data is null then 'missing field'
                    when "rows" is null or cols is null or "type" is null then 'other type' end as reason
        from typed""",
    "reject_documents": """
        select doc_id, case
            when octet_length(encode(text)) = 0 then 'missing'
            when doc_id % 8 = 2 then 'bad base64'
            when doc_id % 8 = 3 then (case
              when not regexp_full_match(text, '([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}(==)?|[A-Za-z0-9+/]{3}=?)?')
                then 'bad base64' else 'bad length' end)
            when doc_id % 8 = 4 then 'bad base64'
            when doc_id % 8 = 5 then (case when octet_length(encode(text)) % 3 = 0
                                      then 'bad length' else 'bad base64' end)
            end as reason
        from documents""",
    "build_json": f"""with {_FRAMES}
        select "cameraId" as key, message as value from judged where reason is null""",
    "keyed_partitions": _PARTITIONS,
    "unkeyed_messages": "select cast(null as varchar) as key, text as value from conversations",
    "key_value_lines": f'with {_MESSAGES} select "partition", "offset", {_LINE} as line from msg',
    "first_records": _FIRST_SQL,
    "sampled_frames": f"""with {_FRAMES} {_FIRST.format(source='judged')}
        select batch_id, '/out/' || "cameraId" || '-T-' || "timestamp" || '.png' as path,
               "rows", cols, "type", data
        from first_rec where reason is null""",
    "base64_roundtrip": """
        select doc_id, to_base64(encode(text)) as data,
               cast(octet_length(encode(text)) as bigint) as n_bytes, true as same
        from documents""",
    "stamps": f"""
        select 'event' as kind, event_id as id, {_STAMP.format(at='ts')} as stamp from events
        union all
        select 'order', o_orderkey, {_STAMP.format(at='o_orderdate')} from orders""",
    "file_names": f"""
        select event_id, '/out/cam-' || (user_id % 16) || '-T-'
               || regexp_replace({_STAMP.format(at='ts')}, '[ .:]', '-', 'g') || '.png' as path
        from events""",
    "raw_file_names": f"""
        select event_id, '/out/cam-' || (user_id % 16) || '-T-' || {_STAMP.format(at='ts')}
               || '.png' as path
        from events""",
    "geometry": f"""with {_FRAMES}
        select 'event' as frame_set, "offset" as frame_id, "rows", cols, "type", ("type" >> 3) + 1 as channels,
               cast("rows" * cols * (("type" >> 3) + 1) as bigint) as n_expected, cast(octet_length(from_base64(data)) as integer) as n_bytes
        from good
        union all
        select 'document', doc_id, 1, cast(octet_length(encode(text)) as integer), 0, 1,
               octet_length(encode(text)), cast(octet_length(encode(text)) as integer)
        from documents
        union all
        select 'embedding', vec_id, 8, 8, 0, 1, 64, cast(len(embedding) as integer) from embeddings""",
    "cameras": """with lists as (
          select c_custkey // 50 as site,
                 string_agg(' ' || c_name, ',' order by c_custkey) || ',,' as ids,
                 string_agg(case when c_custkey % 25 = 7 then ' '
                                 when c_custkey % 25 = 8 then '99999999999'
                                 when c_custkey % 3 = 0 then cast(c_custkey % 10 as varchar)
                                 when c_custkey % 3 = 1 then 'rtsp://cam/' || c_custkey
                                 else ' /video/' || c_custkey || '.mp4 ' end,
                            ',' order by c_custkey) || ',,' as urls
          from customer group by 1),
        pairs as (
          select site, trim(unnest(string_split(rtrim(ids, ','), ','))) as camera_id,
                 trim(unnest(string_split(rtrim(urls, ','), ','))) as url
          from lists)
        select site, camera_id, url,
               case when not regexp_full_match(url, '[0-9]*') then 'url'
                    when try_cast(url as integer) is null then 'invalid' else 'device' end as kind
        from pairs""",
    "pixels": f"""with {_FRAMES} {_EVENT_PIXELS}
        select "partition", frame_id as "offset", cast(y as integer) as y, cast(x as integer) as x,
               cast(c as integer) as channel, cast(v as integer) as value
        from px""",
    "resize_events": f"""with {_FRAMES} {_EVENT_PIXELS} {_resized('px', (4, 4), (8, 8))}
        select frame_id as "offset", 8 as "rows", 8 as cols, 16 as "type", pixels from whole""",
    "resize_embeddings": f"""with {_GRAY} {_resized('gray', (8, 8), (12, 20))}
        select frame_id, 12 as "rows", 20 as cols, 0 as "type", pixels from whole""",
    "resize_vga": _VGA,
    "resize_tiled": _VGA,
    "collected": f"""with {_GRAY} {_resized('gray', (8, 8), (16, 16))},
        stamped as (
          select vec_id as frame_id, 'cam-' || label as key,
                 timestamp '2024-01-01' + to_microseconds(vec_id * 37250) as taken
          from embeddings)
        select key, '{{"cameraId":"' || key || '","timestamp":"' || {_STAMP.format(at='taken')}
               || '","rows":16,"cols":16,"type":0,"data":"' || to_base64(unhex(pixels)) || '"}}' as value
        from whole join stamped using (frame_id)""",
    "emit_per_batch": _EMIT_SQL,
    "frames_per_batch": f'with {_EMITTED} select "cameraId", batch_id, n_frames from emitted',
    "previous_timestamp": f"""with {_EMITTED}
        select "cameraId", batch_id, had_state, prev_timestamp from emitted""",
    "save_flags": f"""with {_EMITTED}
        select "cameraId", batch_id, "timestamp", "partition", "offset", saved from numbered""",
    "frame_order": _ORDER_SQL,
    "stream_order": _ORDER_SQL,
    "final_state": _FINAL_SQL,
    "state_after_stream": _FINAL_SQL,
    "export_saved": _EXPORT_SQL,
    "export_committed": _EXPORT_SQL,
    "export_sampled": f"""with {_FRAMES} {_FIRST.format(source='judged')},
        pathed as (
          select *, '/out/' || "cameraId" || '-T-' || "timestamp" || '.png' as path, hex(from_base64(data)) as h
          from first_rec where reason is null),
        latest as (
          select *, row_number() over (partition by path
                      order by batch_id desc, "partition" desc, "offset" desc) as nr from pathed)
        select path, {_SHOWN} from latest where nr = 1""",
    "stream_export": _EXPORT_SQL,
    "stream_rejects": f"""with {_FRAMES}
        select topic, "partition", "offset", batch_id, message, reason
        from judged where reason is not null""",
    "stream_state": f"""with {_EMITTED}
        select "cameraId", batch_id, "timestamp", "partition", "offset", n_frames, had_state,
               prev_timestamp, n_saved, true as task_ok,
               cast(coalesce(sum(n_frames) over (partition by "cameraId" order by batch_id
                    rows between unbounded preceding and 1 preceding), 0) as bigint) as n_before,
               (select count(distinct g."partition") from good g where g."cameraId" = emitted."cameraId") as n_partitions
        from emitted""",
    "stream_emit": _EMIT_SQL,
    "stream_save": f"""with {_EMITTED}
        select n."cameraId", n.batch_id, n."timestamp", n."rows", n.cols, n."type", n.data,
               n."partition", n."offset", n.saved, n."offset" = e."offset" as is_last,
               e.had_state, e.prev_timestamp, e.n_frames
        from numbered n join emitted e on n."cameraId" = e."cameraId" and n.batch_id = e.batch_id""",
    "stream_first": _FIRST_SQL,
    "stream_lines": f"with {_MESSAGES} select {_LINE} as line from msg",
    "offset_reads": f"""with {_MESSAGES},
        taken as (
          select "partition", "offset", ("offset" - min("offset") over (partition by "partition"))
                   // (400000 // (select count(distinct "partition") from msg)) as b
          from msg)
        select case when b < 3 then 1 else 2 end as "read", cast(case when b < 3 then b else b - 3 end as integer) as batch,
               "partition", count(*) as n, min("offset") as first_offset, max("offset") as last_offset
        from taken group by b, "partition" """,
    "stream_view": _PARSE_SQL,
}
