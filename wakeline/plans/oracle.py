"""SQL building blocks for checking the queries with an independent engine."""

from __future__ import annotations

TRACKS = """tracks as (
  select user_id as id, ts, event_id as seq,
    cast(mod(event_id*37,100) as double)/cast(8 as double)+cast(25 as double) as lat,
    cast(mod(event_id*91,100) as double)/cast(8 as double)+cast(108 as double) as lon,
    cast(floor(value) as double)/cast(4 as double) as speed,
    cast(json_extract_string(props,'$.k') as int)*7 % 360 as direction,
    case user_id % 4 when 0 then 'trawl' when 1 then 'gill' when 2 then 'seine' end as type
  from events)"""

SPEED_BIN = ("case when speed<=4 then 'low' when speed<=10 then 'median-low' when speed<=18 then 'median' "
             "when speed<=50 then 'high' else 'very-high' end")

MASKED = f"""masked as (
  select *, speed<1 as stopped, speed>0 as moving, speed<>0 as nonzero, direction=0 as north,
    {SPEED_BIN}='high' as fast, sqrt(lat*lat+lon*lon) as dis from tracks)"""

MOVED = """moved as (
  select *, lag(lat) over w as p_lat, lag(lon) over w as p_lon, lag(speed) over w as p_speed,
    lag(direction) over w as p_direction, lag(ts) over w as p_ts,
    lead(lat) over w as n_lat, lead(lon) over w as n_lon
  from tracks window w as (partition by id order by ts, seq))"""

CHANGED = """changed as (
  select *, lat-p_lat as lat_diff, lon-p_lon as lon_diff, speed-p_speed as speed_diff,
    cast(((epoch_us(ts)-epoch_us(p_ts)) // 1000000) % 86400 // 60 as bigint) as gap_minutes,
    (lat-p_lat) is distinct from 0 as position_changed,
    (speed-p_speed) is distinct from 0 as speed_changed
  from moved)"""


def _hours(ts: str) -> str:
    return (f"((month({ts})*31+month({ts})*100+day({ts}))*24+hour({ts})"
            f"+cast(minute({ts}) as double)/cast(60 as double)+cast(second({ts}) as double)/cast(3600 as double))")


STEPS = f"""steps as (
  select *, speed>0 as moving, sqrt((p_lat-lat)*(p_lat-lat)+(p_lon-lon)*(p_lon-lon)) as step_distance,
    abs((p_lon-lon)/((p_lat-lat)+cast(0.001 as double))) as slope,
    abs({_hours('p_ts')}-{_hours('ts')}) as step_hours,
    abs(p_direction-direction) as direction_delta, abs(p_speed-speed) as speed_delta
  from moved where p_ts is not null),
timed as (
  select *, case when step_hours<>0 then step_distance/step_hours
                 when step_distance>0 then cast('inf' as double) end as step_speed from steps)"""

GRADIENT = """graded as (
  select *, case when p_lat is null and n_lat is null then null when p_lat is null then n_lat-lat
      when n_lat is null then lat-p_lat else (n_lat-p_lat)/2 end as g_lat,
    case when p_lon is null and n_lon is null then null when p_lon is null then n_lon-lon
      when n_lon is null then lon-p_lon else (n_lon-p_lon)/2 end as g_lon
  from moved)"""

GRADIENT_TEXT = ("cast(round_even(g_lat*10000,0)/10000 as varchar) || '_' || "
                 "cast(round_even(g_lon*10000,0)/10000 as varchar)")

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
LAT_CELL = "cast(ceil((lat+90)*131072/180)-1 as bigint)"
LON_CELL = "cast(ceil((lon+180)*262144/360)-1 as bigint)"


def geohash7() -> str:
    """Seven characters from the 18 longitude and 17 latitude bits, longitude first."""
    left = {"x": 18, "y": 17}
    chars, bits = [], []
    for place in range(35):
        axis = "xy"[place % 2]
        left[axis] -= 1
        bits.append(f"(({axis} >> {left[axis]}) & 1)")
        if len(bits) == 5:
            code = "+".join(f"{b}*{16 >> i}" for i, b in enumerate(bits))
            chars.append(f"substr('{ALPHABET}', cast({code}+1 as int), 1)")
            bits = []
    return "||".join(chars)


CELLS = f"""celled as (
  select *, {geohash7()} as geohash7 from (
    select *, {LON_CELL} as x, {LAT_CELL} as y from tracks))"""


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) as {name}"


def stat(column: str, kind: str, q=None, mask: str | None = None) -> str:
    """One aggregate with an optional mask, a count under an empty mask being NULL."""
    where = f" filter (where {mask})" if mask else ""
    if kind == "q":
        return f"quantile_cont(cast({column} as double), cast({q} as double)){where}"
    if kind == "nunique":
        text = f"count(distinct {column}){where}"
    elif kind == "rows":
        text = f"count(*){where}"
    else:
        names = {"mean": "avg", "std": "stddev_samp"}
        return f"{names.get(kind, kind)}({column}){where}"
    return f"nullif({text}, 0)" if mask else text


def stat_select(stats, table: str, extra: str = "") -> str:
    """select id, one column per Stat from a CTE, doubles rounded."""
    parts = []
    for s in stats:
        text = stat(s.column, s.kind, s.q, s.mask)
        whole = s.kind in ("nunique", "rows", "count") or (
            s.kind in ("min", "max") and s.column.startswith("direction"))
        parts.append(f"{text} as {s.out}" if whole else r6(text, s.out))
    return f"select id, {', '.join(parts)}{extra} from {table} group by id"


def with_(*ctes: str) -> str:
    return "with " + ",\n".join((TRACKS, *ctes)) + "\n"


def modes(column: str, how: str, table: str, where: str = "true") -> str:
    """(id, m): mean or smallest of the most frequent values."""
    return (f"select id, {how}(v) as m from (select id, {column} as v, count(*) as n, "
            f"rank() over (partition by id order by count(*) desc) as r from {table} where {where} "
            f"and {column} is not null group by id, {column}) where r=1 group by id")


def tfidf(words: str) -> str:
    """From a CTE body (id, token) to rounded TF-IDF weights."""
    return f"""words as ({words}),
counts as (select id, token, count(*) as n from words group by id, token),
docs as (select count(distinct id) as size from source),
spread as (select token, count(*) as df from counts group by token),
raw as (select id, token, n, n*(ln(cast(1+size as double)/cast(1+df as double))+1) as w
        from counts join spread using (token), docs)
select id, token, n, round(w/sqrt(sum(w*w) over (partition by id)), 6) as weight from raw"""


def words(text: str) -> str:
    return ("select id, unnest(regexp_extract_all(lower(" + text + "), '\\b\\w\\w+\\b')) as token from source")


SHARES = f"""shares as (
  select id, max(type) as type, count(*) as n, count(*) filter (where speed<=4) as low,
    count(*) filter (where speed>4 and speed<=10) as mid, count(*) filter (where speed>10) as rest
  from tracks group by id)"""


def scores(a: str, b: str, c: str) -> str:
    """Deterministic probabilities from three speed-bin counts."""
    part = lambda x: f"cast({x}+1 as double)/cast(n+3 as double)"
    return f"{part(a)} as p_trawl, {part(b)} as p_gill, {part(c)} as p_seine"


ARGMAX = "list_position([p_trawl,p_gill,p_seine], list_max([p_trawl,p_gill,p_seine]))"
PREDICTED = f"['trawl','gill','seine'][{ARGMAX}]"


def folds(k: int, seed: int, within: str = "") -> str:
    return (f"cast((row_number() over ({within} order by md5(cast(id as varchar)||'_{seed}'), id) - 1) % {k} "
            "as int)")
