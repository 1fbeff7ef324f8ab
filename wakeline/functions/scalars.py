"""Scalar expressions over the ping columns (no UDF anywhere)."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Class names, in the order used for ties and blending, and the
# text they have in the source files.
CLASSES = ("trawl", "gill", "seine")
CLASS_TEXT = {"拖网": "trawl", "刺网": "gill", "围网": "seine"}
UNLABELLED = "unknown"

# Speed bins (upper bound, name) and turn bins in degrees.
SPEED_BINS = ((4, "low"), (10, "median-low"), (18, "median"), (50, "high"))
SPEED_BIN_REST = "very-high"
SPEED_BIN_NAMES = tuple(name for _, name in SPEED_BINS) + (SPEED_BIN_REST,)
TURN_BINS = ((45, "small"), (90, "medium"), (135, "large"), (180, "reverse"))
TURN_BIN_REST = "other"

# Fixed value: the published geohash alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

_INF = float("inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    return F.when(~F.isnan(col(c)), col(c))


# -- masks -------------------------------------------------------------------

def stopped(speed="speed") -> Column:
    return col(speed) < 1


def moving(speed="speed") -> Column:
    return col(speed) > 0


def nonzero(speed="speed") -> Column:
    return col(speed) != 0


def heading_north(direction="direction") -> Column:
    return col(direction) == 0


def valid_position(lat="lat", lon="lon") -> Column:
    return (col(lat) > 0) & (col(lon) > 0)


def changed(diff) -> Column:
    """True unless the difference is exactly 0; a track's first ping counts as changed."""
    return ~col(diff).eqNullSafe(F.lit(0.0))


# -- time --------------------------------------------------------------------

def parse_time(text="time", year: int = 2019) -> Column:
    """'MMDD HH:MM:SS' -> timestamp without zone, whatever the session's zone; an impossible date gives NULL."""
    t = col(text)
    stamped = F.concat(F.lit(f"{year}-"), t.substr(1, 2), F.lit("-"), t.substr(3, 11))
    return F.when(t.rlike(r"^\d{4} \d{2}:\d{2}:\d{2}$"), stamped.try_cast("timestamp_ntz"))


def time_fields(text="time") -> dict[str, Column]:
    """Fixed-offset fields of the time text; 'day' is the MMDD number, as in the source data."""
    t = col(text)
    cut = lambda start, width: t.substr(start, width).cast("int")
    return {"month": cut(1, 2), "day": cut(1, 4), "hour": cut(6, 2),
            "minute": cut(9, 2), "second": cut(12, 2)}


def add_hours(whole: Column, minute: Column, second: Column) -> Column:
    """whole + minute/60 + second/3600, added left to right: step speeds divide by tiny
    differences of such clocks, so the order of the additions shows in the result."""
    return (whole.cast("double") + minute.cast("double") / F.lit(60.0)
            + second.cast("double") / F.lit(3600.0))


def text_day_hours(text="time") -> Column:
    f = time_fields(text)
    return add_hours(f["hour"], f["minute"], f["second"])


def text_mmdd_hours(text="time") -> Column:
    f = time_fields(text)
    return add_hours(f["day"] * 24 + f["hour"], f["minute"], f["second"])


def text_calendar_hours(text="time") -> Column:
    """(MM*31 + MMDD)*24 + hours: the pseudo clock behind the step speed."""
    f = time_fields(text)
    return add_hours((f["month"] * 31 + f["day"]) * 24 + f["hour"], f["minute"], f["second"])


def calendar_hours(ts="ts") -> Column:
    """The same pseudo clock from a timestamp."""
    t = col(ts)
    mmdd = F.month(t) * 100 + F.dayofmonth(t)
    return add_hours((F.month(t) * 31 + mmdd) * 24 + F.hour(t), F.minute(t), F.second(t))


def epoch_micros(ts="ts") -> Column:
    """Microseconds since 1970 read off the fields, so the session zone does not matter."""
    t = col(ts)
    seconds = (F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
               + F.hour(t) * 3600 + F.minute(t) * 60)
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), t) * 1000000).cast("bigint")


def whole_minutes(micros: Column) -> Column:
    """Minutes in the seconds component of a gap: whole days are dropped first."""
    seconds = F.floor(micros / F.lit(1000000)).cast("bigint")
    return F.floor(F.pmod(seconds, F.lit(86400)) / F.lit(60)).cast("bigint")


# -- geometry ----------------------------------------------------------------

def origin_distance(lat="lat", lon="lon") -> Column:
    return F.sqrt(col(lat) * col(lat) + col(lon) * col(lon))


def ieee_ratio(num: Column, den: Column) -> Column:
    """Float division: x/0 is a signed infinity, 0/0 is missing."""
    return (F.when(den != 0, num / den)
            .when(num > 0, F.lit(_INF)).when(num < 0, F.lit(-_INF)))


def safe_ratio(num, den) -> Column:
    """num/den as double, NULL where the denominator is 0 or missing."""
    d = col(den).cast("double")
    return F.when(d != 0, col(num).cast("double") / d)


def anchored(step: float = 0.01, top_speed: float = 0.1, gap: int = 10) -> Column:
    """1 where the vessel sits still; the differences are signed, missing gives 0."""
    still = ((F.col("lat_diff") < F.lit(step)) & (F.col("lon_diff") < F.lit(step))
             & (F.col("speed") < F.lit(top_speed)) & (F.col("gap_minutes") <= gap))
    return F.when(still, 1).otherwise(0)


def _binned(value: Column, bins, rest: str) -> Column:
    out = None
    for upper, name in bins:
        hit = value <= upper
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(rest)


def speed_bin(speed="speed") -> Column:
    return _binned(nan_to_null(col(speed).cast("double")), SPEED_BINS, SPEED_BIN_REST)


def angle_fold(angle="direction") -> Column:
    a = col(angle)
    return F.when(a > 180, 360 - a).otherwise(a)


def turn_bin(angle) -> Column:
    return _binned(F.abs(nan_to_null(col(angle).cast("double"))), TURN_BINS, TURN_BIN_REST)


# -- number text -------------------------------------------------------------

def round_half_exact(value, digits: int) -> Column:
    """Round on the exact binary value, half to even, as Python's round does.

    The product with 10**digits is split into an exact high and low part, so a
    decimal tie such as 2.675 falls on the side its binary value is on.
    """
    x, scale = col(value), float(10 ** digits)
    spread = x * F.lit(134217729.0)
    high = spread - (spread - x)
    low = x - high
    near = F.floor(x * F.lit(scale)).cast("double")
    # Sign of the exact distance to the halfway point above `near`.
    side = (high * F.lit(scale) - (near + F.lit(0.5))) + low * F.lit(scale)
    even = near % 2 == 0
    whole = (F.when(side > 0, near + 1.0).when(side < 0, near)
             .when(even, near).otherwise(near + 1.0))
    return whole / F.lit(scale)


def round_product(value, digits: int) -> Column:
    """Round half to even after scaling (numpy's rule); keeps the sign of a zero."""
    scale = float(10 ** digits)
    return F.rint(col(value) * F.lit(scale)) / F.lit(scale)


def float_text(value) -> Column:
    """Shortest decimal text, fixed notation from 1e-4 up to 1e16, '1e-05' style below."""
    x = col(value).cast("double")
    plain = x.cast("string")
    size = F.abs(x)
    fixed = F.regexp_replace(x.cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1")
    tiny = F.regexp_replace(F.regexp_replace(plain, r"\.0E", "E"), r"E-(\d)$", "E-0$1")
    return (F.when((size == 0) | ((size >= 1e-3) & (size < 1e7)), plain)
            .when((size >= 1e-4) & (size < 1e16), fixed)
            .otherwise(F.lower(tiny)))


def place_key(lat="lat", lon="lon", digits: int | None = 3) -> Column:
    """'{lat}_{lon}' text, rounded to `digits` places unless digits is None."""
    parts = [col(lat), col(lon)]
    if digits is not None:
        parts = [round_half_exact(p, digits) for p in parts]
    return F.concat(float_text(parts[0]), F.lit("_"), float_text(parts[1]))


# -- geohash -----------------------------------------------------------------

def geohash_bits(precision: int) -> tuple[int, int]:
    """(latitude bits, longitude bits) of a cell of that precision."""
    return 5 * precision // 2, (5 * precision + 1) // 2


def axis_cell(value: Column, half: float, bits: int) -> Column:
    """Index of the half-open (lower, upper] cell; outside values go to the end cells.

    The first guess comes from arithmetic that can be one cell off next to an
    edge; the edges themselves are exact doubles, so two compares settle it.
    """
    width = 2.0 * half / (1 << bits)
    x = (F.when(F.isnan(value) | (value < -half), F.lit(-half))
         .when(value > half, F.lit(half)).otherwise(value))
    guess = F.ceil((x + F.lit(half)) / F.lit(width)) - F.lit(1.0)
    cell = (guess + (x > (guess + 1.0) * F.lit(width) - F.lit(half)).cast("double")
            - (x <= guess * F.lit(width) - F.lit(half)).cast("double"))
    return F.when(value.isNotNull(), F.greatest(cell, F.lit(0.0)).cast("bigint"))


def geohash(lat="lat", lon="lon", precision: int = 12) -> Column:
    """Geohash text by interleaving the two cell indexes, longitude bit first.

    Two characters at a time: five bits of each axis are spread by a table, and
    the ten bits together give two places in the alphabet.
    """
    pairs = (precision + 1) // 2
    n_lat, n_lon = geohash_bits(precision)
    x = F.shiftleft(axis_cell(col(lon).cast("double"), 180.0, n_lon), 5 * pairs - n_lon)
    y = F.shiftleft(axis_cell(col(lat).cast("double"), 90.0, n_lat), 5 * pairs - n_lat)
    # Written as one text each, which Spark folds to a constant array.
    spread = F.split(F.lit(",".join(str(sum((v >> i & 1) << 2 * i for i in range(5)))
                                    for v in range(32))), ",").cast("array<int>")
    letters = F.split(F.lit(",".join(GEOHASH_ALPHABET)), ",")
    parts = []
    for i in range(pairs):
        shift = 5 * (pairs - 1 - i)
        five = lambda axis: F.get(spread, F.shiftright(axis, shift).bitwiseAND(F.lit(31)).cast("int"))
        ten = five(x) * 2 + five(y)
        parts += [F.get(letters, F.shiftright(ten, 5)), F.get(letters, ten.bitwiseAND(F.lit(31)))]
    return F.concat(*parts[:precision])


def geohash_center(cell, precision: int) -> dict[str, Column]:
    """Decoded centre, the +/- errors and the short decimal text of a cell.

    Each character holds three bits of one axis and two of the other; small
    tables by character give both shares, and the shares add up to the indexes.
    """
    letters = F.lit(GEOHASH_ALPHABET)
    # Characters at even places start with a longitude bit, the others with latitude.
    outer = [sum((v >> 2 * i & 1) << i for i in range(3)) for v in range(32)]
    inner = [sum((v >> 2 * i + 1 & 1) << i for i in range(2)) for v in range(32)]
    table = lambda values: F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    left = dict(zip(("lat", "lon"), geohash_bits(precision)))
    index = {"lat": F.lit(0).cast("bigint"), "lon": F.lit(0).cast("bigint")}
    for i in range(precision):
        code = F.instr(letters, F.substring(col(cell), i + 1, 1)) - 1
        first, second = ("lon", "lat") if i % 2 == 0 else ("lat", "lon")
        for axis, values, bits in ((first, outer, 3), (second, inner, 2)):
            left[axis] -= bits
            index[axis] = index[axis] + F.shiftleft(F.get(table(values), code), left[axis])
    out = {}
    for axis, half, bits in zip(("lat", "lon"), (90.0, 180.0), geohash_bits(precision)):
        error = half / (1 << bits)
        center = (index[axis] * 2 + 1).cast("double") * F.lit(error) - F.lit(half)
        digits = max(1, round(-math.log10(error))) - 1
        text = F.format_string(f"%.{digits}f", center)
        out[axis], out[f"{axis}_err"] = center, F.lit(error)
        out[f"{axis}_text"] = F.rtrim(text, F.lit("0")) if digits else text
    return out


# -- probabilities -----------------------------------------------------------

def argmax_index(columns) -> Column:
    """Position of the first largest value; 0 when any value is missing."""
    values = F.array(*[col(c) for c in columns])
    missing = F.exists(values, lambda v: v.isNull())
    return (F.when(missing, F.lit(0))
            .otherwise((F.array_position(values, F.array_max(values)) - 1).cast("int")))


def name_at(index, names=CLASSES) -> Column:
    # get, not element_at: the latter claims to be never NULL under ANSI mode.
    return F.get(F.array(*[F.lit(n) for n in names]), col(index))


def code_of(name, names=CLASSES) -> Column:
    """Class name -> its position; anything else -> NULL."""
    out = None
    for i, n in enumerate(names):
        out = F.when(col(name) == n, i) if out is None else out.when(col(name) == n, i)
    return out
