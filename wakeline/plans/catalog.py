"""Every operator as a named query over a data folder, most with a SQL statement
that must give the same rows."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from wakeline.functions import scalars as S
from wakeline.operators import boosting, factor, metrics, model, motion, places, stats, text
from wakeline.operators.skew import MAX_GROUP_ROWS, find_large, settle, shared_folder
from wakeline.operators.stats import Stat
from wakeline.operators.prepared import prepare
from wakeline.plans import members, oracle as O
from wakeline.sources import sinks, tracks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SIGNALS = ["lat", "lon", "speed", "direction"]


def query(name: str, sql: str | None = None):
    """Register a function of the ping table as a query; its doubles are rounded to 6 places."""
    def register(build):
        def run(spark, sf_dir):
            return rounded(build(tracks.from_events(spark, sf_dir)))
        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build
    return register


def rounded(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"round(`{n}`, 6) AS `{n}`" if t == "double" else f"`{n}`" for n, t in df.dtypes])


def moved(p, large="find"):
    return motion.with_motion(p, large=large)


def changed(p, large="find"):
    return motion.with_changes(moved(p, large))


def steps(p, large="find"):
    return stats.with_masks(motion.steps(moved(p, large)))


def masked(p, large=None):
    return stats.with_masks(p)


# -- sources -----------------------------------------------------------------

@query("read_tracks", O.with_() + """select id, seq, epoch_us(ts) as micros, lat, lon, speed, direction, type
from tracks""")
def _(p):
    return p.select("id", "seq", S.epoch_micros("ts").alias("micros"), "lat", "lon", "speed", "direction", "type")


def as_files(p):
    """The pings written as source-format CSV files in the shared folder."""
    path = f"{shared_folder(p.sparkSession)}/wakeline-csv-{uuid.uuid4().hex}"
    native = F.coalesce(*[F.when(F.col("type") == n, t) for t, n in S.CLASS_TEXT.items()])
    (p.select(F.col("id").alias("渔船ID"), "lat", "lon", F.col("speed").alias("速度"),
              F.col("direction").alias("方向"), F.date_format("ts", "MMdd HH:mm:ss").alias("time"),
              native.alias("type"))
     .write.option("header", True).csv(path))
    return path


_CSV_SQL = O.with_() + """select id, strftime(ts, '2019-%m-%d %H:%M:%S') as stamp, lat, lon, speed, direction,
  {label} as type from tracks"""


@query("read_tracks_csv", _CSV_SQL.format(label="type"))
def _(p):
    back = tracks.read_tracks(p.sparkSession, as_files(p))
    return back.select("id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
                       "lat", "lon", "speed", "direction", "type")


@query("read_tracks_text", _CSV_SQL.format(label="coalesce(type,'unknown')"))
def _(p):
    back = tracks.read_track_text(p.sparkSession, as_files(p))
    return back.select("id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
                       "lat", "lon", "speed", "direction", "type")


@query("row_numbers_of_files", O.with_() + """select id, lat, lon, speed,
  row_number() over (partition by id order by ts, seq) - 1 as seq from tracks""")
def _(p):
    """One file per vessel, rows in time order: seq numbers them from 0."""
    path = f"{shared_folder(p.sparkSession)}/wakeline-csv-{uuid.uuid4().hex}"
    native = F.lit(None).cast("string")
    sinks.write_vessels(
        p.repartition("id").sortWithinPartitions("id", "ts", "seq")
        .select(F.col("id").alias("渔船ID"), "lat", "lon", F.col("speed").alias("速度"), F.col("direction").alias("方向"),
                F.date_format("ts", "MMdd HH:mm:ss").alias("time"), native.alias("type")), path)
    return tracks.read_tracks(p.sparkSession, path).select("id", "lat", "lon", "speed", "seq")


@query("label_lines", O.with_() + """select distinct id, case type when 'trawl' then '拖网' when 'gill' then '刺网'
  when 'seine' then '围网' end as label from tracks where type is not null""")
def _(p):
    """The label file, read back."""
    path = f"{shared_folder(p.sparkSession)}/wakeline-labels-{uuid.uuid4().hex}"
    known = tracks.labelled(tracks.distinct_tracks(p))
    sinks.write_labels(known.withColumnRenamed("type", "label"), path)
    return p.sparkSession.read.schema("id bigint, label string").csv(path)


@query("dropped_by_name_part", O.with_() + """select id, min(lat) as lat_min, max(lat) as lat_max from tracks group by id""")
def _(p):
    table = stats.stat_block(p, [Stat(f"{c}_{k}", c, k) for c in ("lat", "speed", "direction") for k in ("min", "max")])
    return model.drop_by_substring(table, ["speed", "direc"])


@query("sequence_numbers", O.with_() + """select id, seq as source_seq,
  row_number() over (partition by id order by ts, seq) - 1 as seq from tracks""")
def _(p):
    return tracks.with_seq(p.withColumn("source_seq", F.col("seq")), ("ts", "source_seq")).select(
        "id", "source_seq", "seq")


@query("first_label", O.with_() + "select id, arg_min(type, seq) filter (where type is not null) as type "
                                  "from tracks group by id")
def _(p):
    return tracks.track_labels(p)


@query("union_tracks", O.with_() + "select id, seq, lat, lon, type from tracks")
def _(p):
    train = tracks.labelled(p).select("id", "seq", "lat", "lon", "type")
    return tracks.union_tracks(train, tracks.unlabelled(p).select("lon", "lat", "seq", "id"))


@query("distinct_tracks", O.with_() + "select distinct id, type from tracks")
def _(p):
    return tracks.distinct_tracks(p)


@query("label_split", O.with_() + """select id, type, case when type is null then 'test' else 'train' end as part
from (select distinct id, type from tracks)""")
def _(p):
    t = tracks.distinct_tracks(p)
    return tracks.labelled(t).withColumn("part", F.lit("train")).union(
        tracks.unlabelled(t).withColumn("part", F.lit("test")))


@query("label_codes", O.with_() + """select id, case type when 'trawl' then 0 when 'gill' then 1 when 'seine' then 2 end
as code, type as name from (select distinct id, type from tracks)""")
def _(p):
    coded = tracks.distinct_tracks(p).withColumn("code", S.code_of("type"))
    return coded.select("id", "code", S.name_at("code").alias("name"))


@query("feature_table", O.with_(O.MASKED) + """select id, round(avg(lat) filter (where fast), 6) as lat_fast,
  avg(speed) is not null as seen from masked group by id""")
def _(p):
    path = f"{shared_folder(p.sparkSession)}/wakeline-features-{uuid.uuid4().hex}"
    base = tracks.distinct_tracks(p).select("id")
    fast = stats.stat_block(stats.with_masks(p), [Stat("lat_fast", "lat", "mean", mask="fast")])
    seen = p.groupBy("id").agg(F.avg("speed").isNotNull().alias("seen"))
    sinks.write_features(base.join(fast, "id", "left").join(seen, "id", "left"), path)
    return sinks.read_features(p.sparkSession, path)


# -- filters and scalar expressions ------------------------------------------

for _name, _mask, _where in (("filter_stopped", S.stopped, "speed<1"), ("filter_moving", S.moving, "speed>0"),
                             ("filter_nonzero", S.nonzero, "speed<>0"),
                             ("filter_north", S.heading_north, "direction=0")):
    query(_name, O.with_() + f"select id, seq, speed, direction from tracks where {_where}")(
        lambda p, mask=_mask: p.filter(mask()).select("id", "seq", "speed", "direction"))


@query("valid_position", O.with_() + """select * from (select id, seq, lat-30 as lat, lon-113 as lon from tracks)
where lat>0 and lon>0""")
def _(p):
    moved_origin = p.select("id", "seq", (F.col("lat") - 30).alias("lat"), (F.col("lon") - 113).alias("lon"))
    return moved_origin.filter(S.valid_position())


@query("speed_bins", O.with_() + f"select id, seq, {O.SPEED_BIN} as bin from tracks")
def _(p):
    return p.select("id", "seq", S.speed_bin().alias("bin"))


_FOLD = "case when direction>180 then 360-direction else direction end"


@query("angle_fold", O.with_() + f"select id, seq, {_FOLD} as folded from tracks")
def _(p):
    return p.select("id", "seq", S.angle_fold().alias("folded"))


@query("turn_bins", O.with_() + f"""select id, seq, case when turn<=45 then 'small' when turn<=90 then 'medium'
  when turn<=135 then 'large' when turn<=180 then 'reverse' else 'other' end as bin
from (select *, {_FOLD} as turn from tracks)""")
def _(p):
    return p.select("id", "seq", S.turn_bin(S.angle_fold()).alias("bin"))


@query("hour_fraction", O.with_() + """, fields as (select id, seq, strftime(ts, '%m%d %H:%M:%S') as time,
    strftime(ts, '2019-%m-%d %H:%M:%S') as stamp,
    month(ts)*100+day(ts) as day, month(ts) as month, hour(ts) as hour, minute(ts) as minute, second(ts) as second,
    cast(hour(ts) as double)+cast(minute(ts) as double)/cast(60 as double)+cast(second(ts) as double)/cast(3600 as double) as h
  from tracks)
select id, seq, time, stamp, cast(day as int) as day, cast(month as int) as month, cast(hour as int) as hour,
  cast(minute as int) as minute, cast(second as int) as second, round(h,6) as day_hours, round(day*24+h,6) as mmdd_hours,
  round((month*31+day)*24+h,6) as calendar_hours from fields""".replace(", fields as", ",\nfields as", 1))
def _(p):
    t = p.select("id", "seq", F.date_format("ts", "MMdd HH:mm:ss").alias("time"))
    return t.select("id", "seq", "time", F.date_format(S.parse_time(), "yyyy-MM-dd HH:mm:ss").alias("stamp"),
                    *[c.alias(n) for n, c in S.time_fields().items()],
                    S.text_day_hours().alias("day_hours"), S.text_mmdd_hours().alias("mmdd_hours"),
                    S.text_calendar_hours().alias("calendar_hours"))


@query("origin_distance", O.with_() + "select id, seq, round(sqrt(lat*lat+lon*lon),6) as dis from tracks")
def _(p):
    return p.select("id", "seq", S.origin_distance().alias("dis"))


@query("place_key", O.with_() + """select id, seq, cast(lat as varchar)||'_'||cast(lon as varchar) as place,
  cast(round_even(lat*1000,0)/1000 as varchar)||'_'||cast(round_even(lon*1000,0)/1000 as varchar) as place3 from tracks""")
def _(p):
    return p.select("id", "seq", S.place_key(digits=None).alias("place"), S.place_key().alias("place3"))


@query("geohash7", O.with_(O.CELLS) + "select id, seq, geohash7 from celled")
def _(p):
    return p.select("id", "seq", S.geohash(precision=7).alias("geohash7"))


@query("cell_centers", O.with_(O.CELLS) + """, centers as (select geohash7 as cell, count(*) as cnt,
    cast(2*max(y)+1 as double)*cast(90 as double)/131072-90 as lat,
    cast(2*max(x)+1 as double)*cast(180 as double)/262144-180 as lon from celled group by geohash7)
select cell, cnt, round(lat,6) as lat, round(cast(90 as double)/131072,6) as lat_err,
  rtrim(printf('%.2f',lat),'0') as lat_text, round(lon,6) as lon,
  round(cast(180 as double)/262144,6) as lon_err, rtrim(printf('%.2f',lon),'0') as lon_text from centers""")
def _(p):
    return places.cell_centers(p)


# -- motion ------------------------------------------------------------------

_STEP = O.with_(O.MOVED, O.STEPS)


@query("lag_step_distance", _STEP + "select id, seq, round(step_distance,6) as step_distance from timed")
def _(p):
    return steps(p).select("id", "seq", "step_distance")


@query("slope", _STEP + "select id, seq, round(slope,6) as slope from timed")
def _(p):
    return steps(p).select("id", "seq", "slope")


@query("step_speed", _STEP + """select id, seq, round(step_hours,6) as step_hours, round(step_speed,6) as step_speed
from timed""")
def _(p):
    return steps(p).select("id", "seq", "step_hours", "step_speed")


@query("abs_deltas", _STEP + "select id, seq, direction_delta, speed_delta from timed")
def _(p):
    return steps(p).select("id", "seq", "direction_delta", "speed_delta")


_CHANGED = O.with_(O.MOVED, O.CHANGED)


@query("gap_minutes", _CHANGED + "select id, seq, gap_minutes from changed")
def _(p):
    return changed(p).select("id", "seq", "gap_minutes")


@query("anchor_flag", _CHANGED + """select id, seq,
  case when lat_diff<0.01 and lon_diff<0.01 and speed<0.1 and gap_minutes<=10 then 1 else 0 end as anchored,
  case when lat_diff<3 and lon_diff<3 and speed<5 and gap_minutes<=600 then 1 else 0 end as slow from changed""")
def _(p):
    return changed(p).select("id", "seq", "anchored", S.anchored(3.0, 5.0, 600).alias("slow"))


@query("position_changed", _CHANGED + "select id, seq, lat_diff, lon_diff from changed where position_changed")
def _(p):
    return changed(p).filter("position_changed").select("id", "seq", "lat_diff", "lon_diff")


@query("speed_changed", _CHANGED + "select id, seq, speed_diff from changed where speed_changed")
def _(p):
    return changed(p).filter("speed_changed").select("id", "seq", "speed_diff")


_GRADED = O.with_(O.MOVED, O.GRADIENT)
_GRADIENT_SQL = _GRADED + f"select id, seq, g_lat, g_lon, {O.GRADIENT_TEXT} as text from graded"


def gradients(m):
    return m.select("id", "seq", motion.gradient("lat").alias("g_lat"), motion.gradient("lon").alias("g_lon"),
                    motion.gradient_text().alias("text"))


@query("gradient", _GRADIENT_SQL)
def _(p):
    return gradients(moved(p))


@query("gradient_split", _GRADIENT_SQL)
def _(p):
    return gradients(motion.with_motion(p, limit=50))


# -- statistics --------------------------------------------------------------

def _block(name, ctes, table, prepare, wanted, limit=MAX_GROUP_ROWS):
    def build(p):
        large = find_large(p, ["id"], limit)  # counted once, for the windows and the block
        return stats.stat_block(prepare(p, large), wanted, large=large)
    query(name, O.with_(*ctes) + O.stat_select(wanted, table))(build)


_MASKS, _MOVES = (O.MASKED,), (O.MOVED, O.CHANGED)
_POS = stats.wide_stats(SIGNALS, "position_changed", "pos_changed_")
_block("stat_block_all", _MASKS, "masked", masked, stats.wide_stats(SIGNALS))
_block("stat_block_pos_changed", _MOVES, "changed", changed, _POS)
_block("stat_block_speed_changed", _MOVES, "changed", changed,
       stats.wide_stats(SIGNALS, "speed_changed", "speed_changed_"))
_block("stat_block_split", _MOVES, "changed", changed, stats.wide_stats(SIGNALS) + _POS, limit=50)
_block("stat_block_deciles", _MASKS, "masked", masked, stats.decile_stats(["lat", "lon"]))
_block("stat_block_stopped", _MASKS, "masked", masked,
       stats.decile_stats(["lat", "lon"], "stopped", "stop_") + stats.stopped_stats())
_block("stat_block_moving", _MASKS, "masked", masked,
       stats.decile_stats(["speed"], "moving") + stats.moving_stats())
_block("stat_block_dir0", _MASKS, "masked", masked,
       stats.decile_stats(["lat", "lon"], "north", "direction0_"))
_block("stat_block_high", _MASKS, "masked", masked,
       stats.decile_stats(["lat", "lon"], "fast", "speed_high_"))
_block("direction_summary", _MASKS, "masked", masked, stats.direction_stats())
_block("step_stats", (O.MOVED, O.STEPS), "timed", steps, stats.step_stats())
_block("delta_stats", (O.MOVED, O.STEPS), "timed", steps, stats.delta_stats())
_block("delta_stats_split", (O.MOVED, O.STEPS), "timed", steps, stats.delta_stats(), limit=50)


@query("stop_proportion", O.with_(O.MASKED) + O.stat_select(
    stats.stop_share_stats(), "masked",
    ", round(cast(nullif(count(*) filter (where stopped),0) as double)/count(*),6) as stopped_share"))
def _(p):
    return stats.stop_share(stats.with_masks(p))


@query("anchor_ratio", _CHANGED + """, flagged as (select id,
  case when lat_diff<0.01 and lon_diff<0.01 and speed<0.1 and gap_minutes<=10 then 1 else 0 end as a from changed)
select id, count(*) as cnt, cast(sum(a) as bigint) as anchor_cnt,
  round(cast(sum(a) as double)/count(*),6) as anchor_ratio from flagged group by id""")
def _(p):
    return stats.anchor_ratio(changed(p))


_BINS = {b: "speed_" + b.replace("-", "_") for b in S.SPEED_BIN_NAMES}


@query("speed_bin_pivot", O.with_() + ",\n" + f"binned as (select id, {O.SPEED_BIN} as bin from tracks)\nselect id, "
       + ", ".join(f"count(*) filter (where bin='{b}') as {n}_cnt, "
                   f"round(cast(count(*) filter (where bin='{b}') as double)/count(*),6) as {n}_ratio"
                   for b, n in _BINS.items()) + " from binned group by id")
def _(p):
    return stats.speed_bin_pivot(p)


# -- modes and places --------------------------------------------------------

@query("mode_mean", O.with_(O.MASKED) + ",\n" + f"""a as ({O.modes('lat', 'avg', 'masked')}),
b as ({O.modes('lon', 'avg', 'masked', 'stopped')}), c as ({O.modes('dis', 'avg', 'masked')})
select a.id, round(a.m,6) as lat_mode, round(b.m,6) as stopped_lon_mode, round(c.m,6) as dis_mode
from a left join b on a.id=b.id left join c on a.id=c.id""")
def _(p):
    return places.mode_block(stats.with_masks(p), [
        ("lat_mode", "lat", None, "mean"), ("stopped_lon_mode", "lon", "stopped", "mean"),
        ("dis_mode", "dis", None, "mean")])


@query("mode_mean_split", ORACLES["mode_mean"])
def _(p):
    return places.mode_block(stats.with_masks(p), [
        ("lat_mode", "lat", None, "mean"), ("stopped_lon_mode", "lon", "stopped", "mean"),
        ("dis_mode", "dis", None, "mean")], limit=50)


@query("mode_smallest", O.with_() + O.modes("speed", "min", "tracks", "speed<>0"))
def _(p):
    return places.mode_block(stats.with_masks(p), [("m", "speed", "nonzero", "min")])


_FREQ = "select id, lon, count(*) as n from tracks group by id, lon"


@query("freq_profile", O.with_() + f"""select id, max(n) as lon_freq_max, round(avg(n),6) as lon_freq_mean,
  round(stddev_pop(n),6) as lon_freq_std from ({_FREQ}) group by id""")
def _(p):
    return places.frequency_profile(p)


def _q(c, q, mask=None):
    return O.stat(c, "q", q, mask)


_SPREADS = {f"{c}_spread": f"{_q(c, 0.6)}-{_q(c, 0.4)}" for c in SIGNALS}
_SPREADS["nonzero_speed_spread"] = f"{_q('speed', 0.8, 'nonzero')}-{_q('speed', 0.2, 'nonzero')}"
_ASPECT = "(max(lon)-min(lon))/(max(lat)-min(lat)+cast(0.0001 as double))"


@query("quantile_spread", O.with_(O.MASKED) + "select id, " + ", ".join(
    O.r6(e, n) for n, e in _SPREADS.items()) + " from masked group by id")
def _(p):
    block = stats.stat_block(stats.with_masks(p), places.whole_track_stats())
    return places.with_spreads(block).select("id", *_SPREADS)


@query("bbox_aspect", O.with_() + f"select id, round({_ASPECT},6) as aspect from tracks group by id")
def _(p):
    box = stats.stat_block(p, [Stat(f"{c}_{k}", c, k) for c in ("lat", "lon") for k in ("min", "max")])
    return box.select("id", places.bbox_aspect().alias("aspect"))


_PROFILE_SQL = O.with_(O.MASKED) + ",\n" + f"""base as ({O.stat_select(
    places.whole_track_stats(), 'masked',
    ', ' + ', '.join(O.r6(e, n) for n, e in _SPREADS.items()) + f', round({_ASPECT},6) as aspect')}),
m1 as ({O.modes('speed', 'min', 'masked', 'nonzero')}), m2 as ({O.modes('lat', 'avg', 'masked')}),
m3 as ({O.modes('lon', 'avg', 'masked')}), m4 as ({O.modes('dis', 'avg', 'masked')}),
f as (select id, max(n) as lon_freq_max, round(avg(n),6) as lon_freq_mean,
  round(stddev_pop(n),6) as lon_freq_std from ({_FREQ}) group by id)
select base.*, round(m1.m,6) as nonzero_speed_mode, round(m2.m,6) as lat_mode_mean, round(m3.m,6) as lon_mode_mean,
  round(m4.m,6) as dis_mode_mean, lon_freq_max, lon_freq_mean, lon_freq_std
from base left join m1 on m1.id=base.id left join m2 on m2.id=base.id left join m3 on m3.id=base.id
left join m4 on m4.id=base.id left join f on f.id=base.id"""


@query("whole_track_profile", _PROFILE_SQL)
def _(p):
    return places.whole_track_profile(p)


@query("whole_track_profile_split", _PROFILE_SQL)
def _(p):
    return places.whole_track_profile(p, limit=50)


@query("place_counts", O.with_() + "select id, lat, lon, count(*) as cnt from tracks group by id, lat, lon")
def _(p):
    return places.place_counts(p)


def _top_sql(k=3):
    cells = ", ".join(f"max(case when r={i} then {c} end) as rank{i}_mode_{c}"
                      for i in range(1, k + 1) for c in ("lat", "lon", "cnt"))
    return (f"select id, {cells} from (select *, row_number() over (partition by id order by cnt desc, lat, lon) as r "
            "from (select id, lat, lon, count(*) as cnt from tracks group by id, lat, lon)) where r<=3 group by id")


@query("top3_places", O.with_() + _top_sql())
def _(p):
    return places.top_places(p)


@query("place_diversity", O.with_() + """,
placed as (select id, speed<1 as stopped,
  cast(round_even(lat*1000,0)/1000 as varchar)||'_'||cast(round_even(lon*1000,0)/1000 as varchar) as place from tracks),
counts as (select id, count(place) as destination_cnt, count(distinct place) as destination_nuniq,
  nullif(count(place) filter (where stopped),0) as stop_destination_cnt,
  nullif(count(distinct place) filter (where stopped),0) as stop_destination_nuniq from placed group by id)
select *, round(cast(destination_nuniq as double)/destination_cnt,6) as destination_ratio,
  round(cast(destination_cnt as double)/destination_nuniq,6) as destination_freq,
  round(cast(stop_destination_nuniq as double)/stop_destination_cnt,6) as stop_destination_ratio,
  round(cast(stop_destination_cnt as double)/stop_destination_nuniq,6) as stop_destination_freq,
  round(cast(stop_destination_cnt as double)/destination_cnt,6) as stop_ratio1,
  round(cast(stop_destination_nuniq as double)/destination_nuniq,6) as stop_ratio2 from counts""")
def _(p):
    return places.place_diversity(p)


# -- text --------------------------------------------------------------------

_TEXTS = {
    "tfidf": ("geohash", (O.CELLS, "source as (select * from celled)"), "geohash7"),
    "place_tfidf": ("place", ("source as (select * from tracks)",), "cast(lat as varchar)||'_'||cast(lon as varchar)"),
    "lat_tfidf": ("lat", ("source as (select * from tracks)",), "cast(lat as varchar)"),
    "lon_tfidf": ("lon", ("source as (select * from tracks)",), "cast(lon as varchar)"),
    "low_speed_tfidf": ("slow_geohash", (O.CELLS, "source as (select * from celled where speed<=4)"), "geohash7"),
    "gradient_tfidf": ("gradient", (O.MOVED, O.GRADIENT, f"source as (select id, {O.GRADIENT_TEXT} as t from graded)"), "t"),
}
for _name, (_corpus, _ctes, _text) in _TEXTS.items():
    query(_name, O.with_(*_ctes) + ",\n" + O.tfidf(O.words(_text)))(
        lambda p, corpus=_corpus: text.corpus_tfidf(p, corpus))

_SAMPLE = """drawn as (select * from (select *, row_number() over (partition by id
    order by md5(cast(id as varchar)||'_'||cast(seq as varchar)||'_1'), seq) as r,
    count(*) over (partition by id) as n from tracks)
  where r <= round_even(cast(n as double)*cast(0.1 as double), 0))"""


query("tfidf_split", ORACLES["tfidf"])(lambda p: text.corpus_tfidf(p, "geohash", limit=50))


@query("sample_tfidf", O.with_(O.CELLS, _SAMPLE.replace("from tracks)", "from celled)"),
                               "source as (select * from drawn)") + ",\n" + O.tfidf(O.words("geohash7")))
def _(p):
    return text.corpus_tfidf(p, "sample")


_SAMPLE_SQL = O.with_(_SAMPLE) + "select id, seq, lat, lon from drawn"


@query("sample_10pct", _SAMPLE_SQL)
def _(p):
    return text.sample_rows(p).select("id", "seq", "lat", "lon")


@query("sample_10pct_split", _SAMPLE_SQL)
def _(p):
    return text.sample_rows(p, limit=50).select("id", "seq", "lat", "lon")


@query("token_counts", O.with_("source as (select *, cast(lat as varchar)||'_'||cast(lon as varchar) as t from tracks)")
       + f",\nwords as ({O.words('t')})\nselect id, token, count(*) as n from words group by id, token")
def _(p):
    return text.token_counts(text.CORPORA["place"].words(p))


@query("gradient_tokens", O.with_(O.MOVED, O.GRADIENT, f"source as (select id, {O.GRADIENT_TEXT} as t from graded)")
       + f",\nwords as ({O.words('t')})\nselect id, token, count(*) as n from words group by id, token")
def _(p):
    return text.token_counts(text.CORPORA["gradient"].words(p))


@query("token_documents", O.with_(O.CELLS) + """,
placed as (select *, row_number() over (partition by id order by ts, seq)-1 as k from celled)
select id, cast(k // 20 as bigint) as part, string_agg(geohash7, ' ' order by k) as text from placed group by id, k // 20""")
def _(p):
    words = p.select("id", "ts", "seq", S.geohash(precision=7).alias("text"))
    docs = text.token_documents(words, chunk=20)
    return docs.select("id", "part", F.array_join("tokens", " ").alias("text"))


# -- folds, scores, blending -------------------------------------------------

def labelled_ids(p):
    return tracks.labelled(tracks.distinct_tracks(p))


_KNOWN = "known as (select distinct id, type from tracks where type is not null)"


@query("kfold_assign", O.with_(_KNOWN) + f"select id, type, {O.folds(5, 1996)} as fold from known")
def _(p):
    return model.assign_folds(labelled_ids(p))


@query("stratified_fold", O.with_(_KNOWN) + f"select id, type, {O.folds(5, 1024, 'partition by type')} as fold from known")
def _(p):
    return model.assign_folds(labelled_ids(p), 5, 1024, "type")


def shares(p):
    speed = F.col("speed")
    return p.groupBy("id").agg(
        F.max("type").alias("type"), F.count(F.lit(1)).alias("n"), F.count_if(speed <= 4).alias("low"),
        F.count_if((speed > 4) & (speed <= 10)).alias("mid"), F.count_if(speed > 10).alias("rest"))


def scores(table, *counts):
    """Probabilities made from speed-bin counts, to give the score operators real input."""
    return table.select("id", "type", *[
        ((F.col(c) + 1).cast("double") / (F.col("n") + 3).cast("double")).alias(p)
        for c, p in zip(counts, metrics.PROBABILITIES)])


def predictions(p):
    table = tracks.labelled(scores(shares(p), "low", "mid", "rest"))
    return metrics.with_prediction(table).withColumn("label", F.col("type"))


_SCORED = O.with_(O.SHARES) + ",\n" + f"""scored as (select id, type, {O.scores('low', 'mid', 'rest')} from shares),
predicted as (select id, type as label, {O.PREDICTED} as predicted, {O.folds(5, 1996)} as fold
  from scored where type is not null),
pairs as (select fold, label, predicted, count(*) as cnt from predicted group by fold, label, predicted),
sides as (select fold, label as class, cnt as actual, 0 as guessed, case when label=predicted then cnt else 0 end as hit
  from pairs union all select fold, predicted, 0, cnt, 0 from pairs)"""
_F1 = "cast(2*sum(hit) as double)/cast(sum(actual)+sum(guessed) as double)"


@query("argmax_label", _SCORED + f"\nselect id, round(p_trawl,6) as p_trawl, round(p_gill,6) as p_gill, "
       f"round(p_seine,6) as p_seine, {O.PREDICTED} as predicted from scored")
def _(p):
    return metrics.with_prediction(scores(shares(p), "low", "mid", "rest")).drop("type")


@query("confusion", _SCORED + "\nselect label, predicted, cast(sum(cnt) as bigint) as cnt from pairs group by label, predicted")
def _(p):
    return metrics.confusion(predictions(p))


@query("class_report", _SCORED + f"""
select class, cast(sum(actual) as bigint) as actual, cast(sum(guessed) as bigint) as guessed, cast(sum(hit) as bigint) as hit,
  round(cast(sum(hit) as double)/cast(nullif(sum(actual),0) as double),6) as recall,
  round(cast(sum(hit) as double)/cast(nullif(sum(guessed),0) as double),6) as precision,
  round({_F1},6) as f1 from sides group by class""")
def _(p):
    return metrics.class_report(predictions(p))


@query("macro_f1", _SCORED + f"\nselect round(avg(f),6) as macro_f1 from (select {_F1} as f from sides group by class)")
def _(p):
    return metrics.macro_f1(predictions(p))


@query("fold_score_summary", _SCORED + f"""
select round(avg(m),6) as mean_f1, round(stddev_pop(m),6) as std_f1 from (
  select fold, avg(f) as m from (select fold, class, {_F1} as f from sides group by fold, class) group by fold)""")
def _(p):
    return metrics.fold_summary(model.assign_folds(predictions(p)))


_BLEND_P = ", ".join(
    f"cast(0.5 as double)*a.{c}+cast(0.3 as double)*c.{c}+cast(0.2 as double)*b.{c} as {c}"
    for c in metrics.PROBABILITIES)


@query("blend_probs", O.with_(O.SHARES) + ",\n" + f"""a as (select id, {O.scores('low', 'mid', 'rest')} from shares),
b as (select id, {O.scores('rest', 'low', 'mid')} from shares where id % 7 <> 0),
c as (select id, {O.scores('mid', 'rest', 'low')} from shares),
mixed as (select s.id, {_BLEND_P} from shares s left join a on s.id=a.id left join c on s.id=c.id
  left join b on s.id=b.id where s.type is null)
select id, round(p_trawl,6) as p_trawl, round(p_gill,6) as p_gill, round(p_seine,6) as p_seine,
  case when p_trawl is null then 'trawl' else {O.PREDICTED} end as label from mixed""")
def _(p):
    table = shares(p)
    a, c = scores(table, "low", "mid", "rest"), scores(table, "mid", "rest", "low")
    b = scores(table, "rest", "low", "mid").filter(F.col("id") % 7 != 0)
    return metrics.blend(tracks.unlabelled(table).select("id"), [a, c, b], [0.5, 0.3, 0.2])


@query("probability_table", O.with_(O.SHARES) + f",\na as (select id, {O.scores('low', 'mid', 'rest')} from shares)\n"
       "select id, round(p_trawl,6) as p_trawl, round(p_gill,6) as p_gill, round(p_seine,6) as p_seine from a")
def _(p):
    path = f"{shared_folder(p.sparkSession)}/wakeline-prob-{uuid.uuid4().hex}"
    sinks.write_probabilities(scores(shares(p), "low", "mid", "rest"), path)
    return sinks.read_probabilities(p.sparkSession, path)


# -- flagship ----------------------------------------------------------------

@query("track_profile", O.with_(O.MASKED) + ",\n" + f"""base as ({O.stat_select(
    stats.wide_stats(['lat', 'lon', 'speed']) + stats.wide_stats(['lat', 'lon'], 'stopped', 'stopped_'), 'masked')}),
m as ({O.modes('lat', 'avg', 'masked')}), t as ({_top_sql()})
select base.*, round(m.m,6) as lat_mode, t.* exclude (id) from base left join m on m.id=base.id left join t on t.id=base.id""")
def track_profile(p):
    """Statistics of all and of the stopped pings, the mode, and the top places of each track."""
    large = find_large(p, ["id"])
    block = stats.stat_block(stats.with_masks(p), stats.wide_stats(["lat", "lon", "speed"])
                             + stats.wide_stats(["lat", "lon"], "stopped", "stopped_"), large=large)
    return (block.join(places.mode_block(p, [("lat_mode", "lat", None, "mean")], large=large), "id", "left")
            .join(places.top_places(p), "id", "left"))


_PART = "cast({c} as double)/cast(n as double)"
_GAINS = O.with_(O.SHARES) + ",\n" + f"""placed as (select *, {O.folds(5, 1996)} as fold from shares where type is not null),
gains as (select 'slow' as feature, {_PART.format(c='low')} as importance, fold from placed
  union all select 'middle', {_PART.format(c='mid')}, fold from placed
  union all select 'fast', {_PART.format(c='rest')}, fold from placed)"""


def gains(p):
    """Importances made from speed-bin shares, several a fold, to give the means real input."""
    placed = model.assign_folds(tracks.labelled(shares(p)))
    return placed.select("fold", F.explode(F.array(*[
        F.struct(F.lit(name).alias("feature"), (F.col(c).cast("double") / F.col("n").cast("double")).alias("importance"))
        for name, c in (("slow", "low"), ("middle", "mid"), ("fast", "rest"))])).alias("g")).select("g.*", "fold")


@query("mean_importance", _GAINS + "\nselect feature, round(avg(importance), 6) as importance from gains group by feature")
def _(p):
    return metrics.mean_importance(gains(p))


@query("top2_features", _GAINS + """
select feature, round(m, 6) as importance from (select feature, avg(importance) as m from gains group by feature)
order by m desc, feature limit 2""")
def _(p):
    return metrics.top_features(gains(p), 2)


_MATRIX = ("lat", "speed", "stop_q", "stop_q_missing")


@query("feature_matrix", O.with_(O.MASKED) + """,
block as (select id, max(lat) as lat, max(speed) as speed, quantile_cont(lat, cast(0.5 as double)) filter (where stopped and lat > 37) as stop_q
  from masked group by id),
filled as (select id, lat, speed, coalesce(stop_q, cast(-1e18 as double)) as stop_q,
  case when stop_q is null then cast(1 as double) else cast(0 as double) end as stop_q_missing from block)
""" + " union all ".join(f"select id, cast({i} as int) as place, round({c}, 6) as value from filled" for i, c in enumerate(_MATRIX)))
def _(p):
    """The vectors that the trees see: stand-ins for missing values, and flags beside them."""
    far = stats.with_masks(p).withColumn("far", F.col("stopped") & (F.col("lat") > 37))
    block = stats.stat_block(far, [Stat("lat", "lat", "max"), Stat("speed", "speed", "max"), Stat("stop_q", "lat", "q", 0.5, "far")])
    ready = model.assemble(model.with_missing_flags(block, ["stop_q"]), _MATRIX, ["id"])
    return ready.select("id", F.posexplode(vector_to_array("x")).alias("place", "value"))


# -- the members' tables ------------------------------------------------------

_LABELS = "labels as (select id, arg_min(type, seq) filter (where type is not null) as type from tracks group by id)"
_TOP = f"top as ({_top_sql()})"
_FLAGGED = """flagged as (select *, case when lat_diff<0.01 and lon_diff<0.01 and speed<0.1 and gap_minutes<=10 then 1 else 0 end
  as anchored from changed)"""
_STATS_A = [Stat("cnt", "id", "rows"), *stats.wide_stats(SIGNALS), *_POS,
            *stats.wide_stats(SIGNALS, "speed_changed", "speed_changed_")]


@query("member_a_numbers", O.with_(O.MOVED, O.CHANGED, _FLAGGED, _LABELS, _TOP, f"""block as ({O.stat_select(
    _STATS_A, 'flagged', ', cast(sum(anchored) as bigint) as anchor_cnt')})""") + """select b.*,
  round(cast(anchor_cnt as double)/cnt,6) as anchor_ratio, t.* exclude (id), l.type
from block b left join top t on t.id=b.id left join labels l on l.id=b.id""")
def _(p):
    return members.numbers_a(prepare(p))


_STATS_B = [*stats.decile_stats(["lat", "lon"]), *stats.decile_stats(["speed"], "moving"),
            *stats.decile_stats(["lat", "lon"], "stopped", "stop_"), *stats.direction_stats(),
            *stats.decile_stats(["lat", "lon"], "north", "direction0_"), *stats.decile_stats(["lat", "lon"], "fast", "speed_high_")]
_DIVERSITY = ORACLES["place_diversity"].split("placed as", 1)[1]


@query("member_b_numbers", O.with_(
    "valid as (select * from tracks where lat>0 and lon>0)",
    O.MASKED.replace("from tracks", "from valid"), _LABELS.replace("from tracks", "from valid"),
    f"block as ({O.stat_select(_STATS_B, 'masked')})",
    "placed as" + _DIVERSITY.replace("from tracks", "from valid").replace("\nselect *,", ",\ndiversity as (select *,") + ")")
    + """select b.*, d.* exclude (id), l.type
from block b left join diversity d on d.id=b.id left join labels l on l.id=b.id""")
def _(p):
    return members.numbers_b(members.prepare_b(p))


_STATS_C = [*places.whole_track_stats(), *stats.stopped_stats(), *stats.moving_stats(),
            *[x for x in stats.stop_share_stats() if x.out != "cnt"]]
_MODES_C = {out: O.modes(c, "avg" if how == "mean" else "min", "masked", mask or "true")
            for out, c, mask, how in places.WHOLE_TRACK_MODES + places.STOPPED_MODES}
_MOVES_C = [x for x in [*stats.step_stats(), *stats.delta_stats()] if x.out != "slope_mean"]
_PIVOT = ORACLES["speed_bin_pivot"].split("binned as", 1)[1].split("\nselect", 1)
_EXTRA_C = (", " + ", ".join(O.r6(e, n) for n, e in _SPREADS.items()) + f", round({_ASPECT},6) as aspect, "
            "round(cast(nullif(count(*) filter (where stopped),0) as double)/count(*),6) as stopped_share")


@query("member_c_numbers", O.with_(
    O.MASKED, O.MOVED.replace("order by ts, seq", "order by seq"), O.STEPS, _LABELS, _TOP,
    f"block as ({O.stat_select(_STATS_C, 'masked', _EXTRA_C)})", f"moves as ({O.stat_select(_MOVES_C, 'timed')})",
    *[f"{out}_m as ({text_})" for out, text_ in _MODES_C.items()],
    f"profile as (select id, max(n) as lon_freq_max, round(avg(n),6) as lon_freq_mean, "
    f"round(stddev_pop(n),6) as lon_freq_std from ({_FREQ}) group by id)",
    f"binned as{_PIVOT[0]}", f"bins as (select{_PIVOT[1]})") + "select b.*, " + ", ".join(
        f"round({out}_m.m,6) as {out}" for out in _MODES_C) + """, profile.* exclude (id), moves.* exclude (id), t.* exclude (id),
  bins.* exclude (id), l.type
from block b left join labels l on l.id=b.id left join top t on t.id=b.id left join moves on moves.id=b.id
left join profile on profile.id=b.id left join bins on bins.id=b.id """ + " ".join(
        f"left join {out}_m on {out}_m.id=b.id" for out in _MODES_C))
def _(p):
    return members.numbers_c(prepare(p, ("seq",)))


# -- without a SQL form ------------------------------------------------------

@query("svd_features")
def _(p):
    return factor.svd_features(p, "geohash", 30, {"geohash_tfidf": "tfidf"})


@query("svd_count_features")
def _(p):
    return factor.svd_features(p, "slow_geohash", 10, {"slow_count": "count"})


@query("svd_row_energy", O.with_("source as (select * from tracks)") + f""",
words as ({O.words('cast(lat as varchar)')}),
counts as (select id, token, count(*) as n from words group by id, token)
select id, cast(sum(n*n) as double) as energy from counts group by id""")
def _(p):
    """With as many directions as tokens the scores keep every row's squared length."""
    scores = factor.svd_features(p, "lat", 24, {"lat": "count"})
    return scores.select("id", F.expr(" + ".join(f"lat_{i} * lat_{i}" for i in range(24))).alias("energy"))


@query("word2vec_mean")
def _(p):
    return factor.word2vec_means(p)


_SMALL_TREES = model.TreeParams(rounds=6, step=0.1, depth=3, features=0.8, sample=0.8, min_rows=2, patience=3)


def _small_model(p):
    table = stats.stat_block(stats.with_masks(p), [*stats.decile_stats(["lat", "lon", "speed"]),
                                                   *stats.direction_stats()])
    return model.cross_validate(settle(table.join(tracks.track_labels(p), "id")), _SMALL_TREES)


@query("word2vec_mean_spread")
def _(p):
    """The same with sentences cut every 20 pings, which must not matter."""
    return factor.word2vec_means(p, chunk=20)


@query("context_weights", O.with_(O.CELLS) + """,
placed as (select id, geohash7, row_number() over (partition by id order by ts, seq)-1 as k from celled),
pairs as (select a.geohash7 as token, b.geohash7 as context, count(*) as n from placed a join placed b
  on a.id=b.id and a.k<>b.k and abs(a.k-b.k)<=5 group by a.geohash7, b.geohash7),
totals as (select token, sum(n) as total from pairs group by token),
weighed as (select p.token, p.context, ln(cast(n as double)*(select cast(sum(n) as double) from pairs)
  /(cast(t.total as double)*cast(c.total as double)))-ln(cast(2 as double)) as w
  from pairs p join totals t on t.token=p.token join totals c on c.token=p.context)
select token, context, round(w,6) as weight from weighed where w>0""")
def _(p):
    words = p.select("id", "ts", "seq", S.geohash(precision=7).alias("text"))
    return factor.context_weights(text.token_documents(words, chunk=20, ahead=5), shift=2.0)


@query("oof_coverage", O.with_(_KNOWN) + f"select id, type, {O.folds(5, 1996)} as fold, "
       "cast(1 as double) as total from known")
def _(p):
    """Every labelled track is scored once, by the models that have not seen it."""
    return _small_model(p).oof.select(
        "id", "type", "fold", (F.col("p_trawl") + F.col("p_gill") + F.col("p_seine")).alias("total"))


@query("importance_sums", "select unnest(range(5)) as fold, cast(3 as double) as total")
def _(p):
    """The importances of each class model sum to 1, so those of a fold to the number of classes."""
    found = _small_model(p).importance
    return found.groupBy(F.col("fold").cast("bigint").alias("fold")).agg(F.sum("importance").alias("total"))


def _member_b(p):
    return settle(members.numbers_b(members.prepare_b(p)))


@query("softmax_oof", ORACLES["oof_coverage"])
def _(p):
    """Three rounds with the second member's settings on its numbers: every labelled track scored once, by other folds."""
    params = model.replace(model.MEMBER_PARAMS["b"], rounds=3, patience=0)
    return model.cross_validate(_member_b(p), params, drop=members.DROPPED_B).oof.select(
        "id", "type", "fold", (F.col("p_trawl") + F.col("p_gill") + F.col("p_seine")).alias("total"))


@query("boosting_resumed", O.with_() + "select distinct id, true as same from tracks where type is not null")
def _(p):
    """Two rounds and two more give the scores of four at once."""
    table = tracks.labelled(stats.stat_block(p, stats.decile_stats(["lat", "speed"])).join(tracks.track_labels(p), "id"))
    rows = settle(model.assemble(table, model.feature_columns(table), ["id", "type"])).withColumn("held", F.lit(False))
    params = model.TreeParams(rounds=4, step=0.1, depth=3, features=0.8, sample=0.8, min_rows=2, objective="softmax")
    whole = boosting.boost(rows, params, 64)
    halves = boosting.boost(rows, params, 64, boosting.boost(rows, model.replace(params, rounds=2), 64))
    a, b = (boosting.score(x, rows.select("id", "x"), [f"{n}{i}" for i in range(3)]) for n, x in (("a", whole), ("b", halves)))
    far = [F.abs(F.col(f"a{i}") - F.col(f"b{i}")) > 1e-9 for i in range(3)]
    return a.join(b, "id").select("id", (~reduce(lambda x, y: x | y, far)).alias("same"))


@query("svd_orthogonal_columns", "select i, j, cast(0 as double) as cosine, true as falling "
       "from range(10) a(i), range(10) b(j) where i < j")
def _(p):
    """Score columns are orthogonal and don't grow from one to the next."""
    scores = factor.svd_features(p, "slow_geohash", 10, {"s": "tfidf"})
    names = [f"s_{i}" for i in range(10)]
    gram = scores.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for a in names for b in names]).select(F.explode(F.array(*[
        F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(j).cast("bigint").alias("j"),
                 S.safe_ratio(F.abs(F.col(f"s_{i}s_{j}")), F.sqrt(F.col(f"s_{i}s_{i}") * F.col(f"s_{j}s_{j}"))).alias("cosine"),
                 (F.col(f"s_{i}s_{i}") >= F.col(f"s_{j}s_{j}")).alias("falling"))
        for i in range(10) for j in range(i + 1, 10)])).alias("g"))
    return gram.select("g.*")


def _orthogonal(corpus, weighting):
    def build(p):
        scores = factor.svd_features(p, corpus, 10, {"s": weighting})
        names = [f"s_{i}" for i in range(10)]
        gram = scores.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}{b}") for a in names for b in names]).select(F.explode(F.array(*[
            F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(j).cast("bigint").alias("j"),
                     S.safe_ratio(F.abs(F.col(f"s_{i}s_{j}")), F.sqrt(F.col(f"s_{i}s_{i}") * F.col(f"s_{j}s_{j}"))).alias("cosine"),
                     (F.col(f"s_{i}s_{i}") >= F.col(f"s_{j}s_{j}")).alias("falling"))
            for i in range(10) for j in range(i + 1, 10)])).alias("g"))
        return gram.select("g.*")
    return build


# The other corpora that the members factorise.
for _corpus, _weighting in (("geohash", "tfidf"), ("geohash", "count"), ("gradient", "tfidf"), ("sample", "tfidf"),
                            ("place", "tfidf"), ("lat", "tfidf"), ("lon", "tfidf")):
    query(f"svd_orthogonal_{_corpus}_{_weighting}", ORACLES["svd_orthogonal_columns"])(_orthogonal(_corpus, _weighting))


@query("token_dictionary", O.with_("source as (select * from tracks)") + f""",
words as ({O.words("cast(lat as varchar)||'_'||cast(lon as varchar)")})
select distinct token, dense_rank() over (order by token) - 1 as code from words""")
def _(p):
    return text.dictionary(text.token_counts(text.CORPORA["place"].words(p)))


@query("token_dictionary_split", ORACLES["token_dictionary"])
def _(p):
    """The same from ranges of the tokens, as for vocabularies too large for one task."""
    return text.dictionary(text.token_counts(text.CORPORA["place"].words(p)), limit=50)


@query("tfidf_train_only", O.with_(O.CELLS, "source as (select * from celled)") + f""",
words as ({O.words("geohash7")}),
counts as (select id, token, count(*) as n from words group by id, token),
train as (select id from tracks group by id having count(type) > 0),
spread as (select token, count(*) as df from counts where id in (select id from train) group by token),
raw as (select id, token, n, n*(ln(cast(1+(select count(*) from train) as double)/cast(1+df as double))+1) as w
  from counts join spread using (token))
select id, token, n, round(w/sqrt(sum(w*w) over (partition by id)), 6) as weight from raw""")
def _(p):
    """Weights of all tracks by the idf of the labelled ones."""
    return text.corpus_tfidf(p, "geohash", fit_on="type IS NOT NULL")


@query("svd_train_projection", O.with_() + "select id, true as same from tracks group by id having count(type) > 0")
def _(p):
    """Scores of the labelled tracks do not depend on whether others are scored with them."""
    train = tracks.labelled(p)
    alone = factor.svd_features(train, "slow_geohash", 5, {"s": "tfidf"})
    beside = factor.svd_features(p, "slow_geohash", 5, {"t": "tfidf"}, fit_on="type IS NOT NULL")
    far = [F.abs(F.col(f"s_{i}") - F.col(f"t_{i}")) > 1e-6 for i in range(5)]
    ids = train.select("id").distinct()
    both = ids.join(alone, "id", "left").join(beside, "id", "left").na.fill(0.0)
    return both.select("id", (~reduce(lambda x, y: x | y, far)).alias("same"))


@query("word2vec_without_cuts", O.with_() + "select distinct id, true as same from tracks")
def _(p):
    """Cutting sentences every 20 pings changes no vector."""
    a, b = (factor.word2vec_means(p, size=5, chunk=c) for c in (1000, 20))
    columns = [c for c in a.columns if c != "id"]
    far = [F.abs(a[c] - b[c]) > 1e-6 for c in columns]
    return a.join(b, "id").select("id", (~reduce(lambda x, y: x | y, far)).alias("same"))


@query("ovr_gbt_oof")
def _(p):
    return _small_model(p).oof


@query("ovr_gbt_scores")
def _(p):
    return _small_model(p).scores


@query("feature_importance")
def _(p):
    return metrics.mean_importance(_small_model(p).importance)


@query("top5_features")
def _(p):
    return metrics.top_features(_small_model(p).importance)
