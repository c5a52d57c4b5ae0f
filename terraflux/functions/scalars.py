"""Column functions: names, lengths, times, humidity, coordinates. All stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from terraflux import model
from terraflux.functions import calendars


def lookup(col: Column, table: dict[str, str]) -> Column:
    """The table's value, null where it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), col)


def normalise_site(name: Column) -> Column:
    """a site code, else the words run together in pascal case if known, a synonym, an AU- code; else unchanged."""
    words = F.filter(F.split(name, r"\s+"), lambda w: w != "")
    joined = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2)))), "")
    known = sorted({*model.SITE_CODES.values(), *model.SITES_WITHOUT_CODES})
    return F.coalesce(
        lookup(name, model.SITE_CODES), F.when(joined.isin(known), joined), lookup(joined, model.SITE_SYNONYMS),
        lookup(F.concat(F.lit("AU-"), joined), model.SITE_CODES), name,
    )


def to_metres(value: Column, unit: Column) -> Column:
    return reduce(lambda rest, u: F.when(unit == u[0], value * u[1]).otherwise(rest), model.LENGTHS.items(), F.lit(None).cast("double"))


def parse_lengths(text: Column, legacy: bool = False) -> Column:
    """all lengths of a text in metres, as an array. A number without unit takes the next one's; signs are ignored.

    legacy tries "m" before "mm", so that "5 mm" reads as 5 m.
    """
    units = "m|km|au|cm|mm" if legacy else "mm|km|au|cm|m"
    pattern = rf"[ \t]*-?([0-9]*\.?[0-9]+)[ \t]*({units})?[ \t]*"
    numbers = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    names = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    own = lambda i: F.get(F.filter(F.slice(names, i + 1, F.size(names) - i), lambda u: u != ""), F.lit(0))
    return F.transform(numbers, lambda x, i: to_metres(x.cast("double"), own(i)))


def parse_area(text: Column) -> Column:
    """square metres of "20 m x 10 m"; null if the text is none."""
    pattern = r"^\s*([0-9.]+)\s*(mm|cm|km|m)\s*x\s*([0-9.]+)\s*(mm|cm|km|m)\s*$"
    part = lambda n: F.nullif(F.regexp_extract(text, pattern, n), F.lit(""))
    return to_metres(part(1).cast("double"), part(2)) * to_metres(part(3).cast("double"), part(4))


def location_key(lon: Column, lat: Column) -> Column:
    """"150500E_033600S.nc", six digits of thousandths of a degree; rounded to hundredths first, half to even."""
    part = lambda x, plus, minus: F.concat(F.lpad(F.abs((F.bround(x, 2) * 1000).cast("int")).cast("string"), 6, "0"), F.when(x < 0, minus).otherwise(plus))
    return F.concat(part(lon, "E", "W"), F.lit("_"), part(lat, "N", "S"), F.lit(".nc"))


def from_year_day(year: Column, day: Column, base: int = 1) -> Column:
    """a date from a year and its day, counted from base."""
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (day - base).cast("int"))


def make_time(*, text: Column | None = None, pattern: str | None = None, year: Column | None = None, doy: Column | None = None, month: Column | None = None, day: Column | None = None,
              hour: Column | None = None, minute: Column | None = None, second: Column | None = None, base: int = 1) -> Column:
    """a timestamp without zone of text in a pattern, of a year and its day (counted from base), or of a year, month and day.

    Hours, minutes and seconds are 0 if not given; with a day of the year they count too. What does not parse is null.
    """
    if text is not None:
        if pattern is None or year is not None:
            raise ValueError("text goes with a pattern and nothing else")
        return F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    if year is None or (doy is None) == (month is None or day is None):
        raise ValueError("a time needs a year and either its day or month and day")
    date = F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (doy - base).cast("int")) if doy is not None else F.try_make_timestamp_ntz(year, month, day, F.lit(0), F.lit(0), F.lit(0))
    part = lambda c: F.lit(0) if c is None else c.cast("int")
    return date.cast("timestamp_ntz") + F.make_dt_interval(hours=part(hour), mins=part(minute), secs=part(second).cast("decimal(18,6)"))


def cf_decode(value: Column, unit: str, epoch: str, calendar: str | None = None) -> Column:
    """"unit since epoch" to a timestamp without zone; of a named calendar to the parts of calendars.decode()."""
    if calendar is not None:
        return calendars.decode(value, f"{unit} since {epoch}", calendar)
    return F.expr(f"timestamp_ntz'{epoch}'") + F.make_dt_interval(secs=(value * _SECONDS[unit]).cast("decimal(18,6)"))


def cf_encode(time: Column, unit: str, epoch: str, calendar: str | None = None) -> Column:
    """a timestamp, or with a calendar the parts of a date of it, to "unit since epoch"."""
    if calendar is not None:
        return calendars.encode(time, f"{unit} since {epoch}", calendar)
    return F.timestamp_diff("SECOND", F.expr(f"timestamp_ntz'{epoch}'"), time) / _SECONDS[unit]


_SECONDS = {"seconds": 1.0, "minutes": 60.0, "hours": 3600.0, "days": 86400.0}


def align_time(time: Column, minutes: int) -> Column:
    """F8: the nearest multiple of some minutes within the day, halves to the even one."""
    day = F.date_trunc("day", time)
    seconds = F.timestamp_diff("SECOND", day, time)
    return day + F.make_dt_interval(mins=(F.bround(seconds / (minutes * 60)) * minutes).cast("int"))


def calendar_parts(time: Column) -> dict[str, Column]:
    """year, day of year from 0 and from 1, hour, start of the year, whether the time is that, start of the next year."""
    start = F.make_date(F.year(time), F.lit(1), F.lit(1))
    return {
        "year": F.year(time), "doy0": F.dayofyear(time) - 1, "doy1": F.dayofyear(time), "hour": F.hour(time),
        "is_year_start": F.date_trunc("year", time) == time, "next_year": F.make_date(F.year(start) + 1, F.lit(1), F.lit(1)),
    }


def steps_between(start: Column, end: Column, minutes: int) -> Column:
    """the number of whole steps of some minutes from start to end; negative if end is earlier."""
    seconds = F.timestamp_diff("SECOND", start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
    return (seconds / (minutes * 60)).cast("bigint")


def saturation(t: Column, constants: str = "sonntag") -> Column:
    """kPa over water at t degrees Celsius."""
    a, b, c = model.MAGNUS[constants]
    return F.lit(a) * F.exp(F.lit(b) * t / (F.lit(c) + t)) / 1000


def vpd(t: Column, q: Column, p: Column, constants: str = "sonntag") -> Column:
    """vapour pressure deficit in kPa of temperature (degrees Celsius), specific humidity (kg/kg) and pressure (kPa)."""
    return saturation(t, constants) - q * p / (q * (1 - 0.622) + 0.622)


def vpd_from_rh(t: Column, rh: Column, constants: str = "mixed") -> Column:
    """the same of relative humidity in percent."""
    return saturation(t, constants) - rh / 100 * saturation(t, constants)


def derotate(rlon: Column, rlat: Column, pole_lon: float, pole_lat: float) -> tuple[Column, Column]:
    """longitude and latitude of rotated-pole coordinates, in degrees, longitude within -180..180."""
    x, y, p = F.radians(rlon), F.radians(rlat), F.radians(F.lit(pole_lat))
    lat = F.asin(F.sin(p) * F.sin(y) + F.cos(p) * F.cos(y) * F.cos(x))
    turn = F.atan2(F.cos(y) * F.sin(x), F.sin(p) * F.cos(y) * F.cos(x) - F.cos(p) * F.sin(y))
    lon = F.lit(pole_lon) - 180 + F.degrees(turn)
    return F.pmod(lon + 180, F.lit(360.0)) - 180, F.degrees(lat)


def wrap_lon(lon: Column) -> Column:
    """0..360 to -180..180."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


def basal_area(diameter_cm: Column) -> Column:
    """F16: square metres of a stem."""
    return F.pi() * F.pow(diameter_cm / 200, F.lit(2.0))


def midpoint(start: Column, end: Column) -> Column:
    """F16: the date halfway through a visit; half a day counts down."""
    return F.date_add(start, F.floor(F.datediff(end, start) / 2).cast("int"))


def standard_name(kind: Column, units: Column) -> Column:
    """the standard name of a variable kind; that of precipitation depends on its units."""
    rain = F.when(units.isin(*model.PRECIP_AMOUNT_UNITS), model.PRECIP_AMOUNT).when(units.isin(*model.PRECIP_RATE_UNITS), model.PRECIP_RATE)
    return F.when(kind == "pr", rain).otherwise(lookup(kind, model.STANDARD_NAMES))


def parse_height(text: Column) -> Column:
    """metres of a canopy height such as "85cm" or "15m"; blank or unreadable is null."""
    pattern = r"^\s*([0-9]*\.?[0-9]+)\s*(mm|cm|km|m)\s*$"
    return to_metres(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).cast("double"), F.regexp_extract(text, pattern, 2))


def grid_index(lon: Column, lat: Column, lon0: float, lat0: float, res: float) -> tuple[Column, Column]:
    """Column and row of the nearest cell of a regular grid, halves to the even one."""
    return F.rint((lon - lon0) / res).cast("int"), F.rint((lat - lat0) / res).cast("int")


def units_match(a: Column, b: Column) -> Column:
    """Whether two unit names mean the same."""
    group = lambda u: reduce(lambda rest, g: F.when(u.isin(*g[1]), g[0]).otherwise(rest), enumerate(model.UNIT_SYNONYMS), F.lit(-1))
    return (a == b) | ((group(a) >= 0) & (group(a) == group(b)))


def _conversion(source: str, target: str) -> tuple[float, int, float]:
    groups = {u: g for g in model.UNIT_SYNONYMS for u in g}
    if source == target or (source in groups and groups[source] == groups.get(target)):
        return 1.0, 0, 0.0
    for name in (source, *groups.get(source, ())):
        if (name, target) in model.UNIT_CONVERSIONS:
            return model.UNIT_CONVERSIONS[name, target]
    raise ValueError(f"no conversion from {source!r} to {target!r}")


def register_conversion(source: str, target: str, factor: float, step_power: int = 0, offset: float = 0.0) -> None:
    """D3: another unit conversion: value * factor * step ** step_power + offset, with a step_power of -1, 0 or 1."""
    model.UNIT_CONVERSIONS[source, target] = (factor, step_power, offset)


def convert(value: Column, source: str, target: str, step_seconds: Column | float = 1.0) -> Column:
    """Value in other units; conversions between amounts and rates depend on the step."""
    factor, power, offset = _conversion(source, target)
    step = F.lit(float(step_seconds)) if isinstance(step_seconds, (int, float)) else step_seconds
    out = value if factor == 1.0 else value * factor
    out = out * step if power == 1 else out / step if power == -1 else out
    return out + offset if offset else out


def clamp(value: Column, low: float | None, high: float | None) -> Column:
    """Value within bounds given in either order; NaN stays NaN, null stays null."""
    if low is not None and high is not None and low > high:
        low, high = high, low
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(value.isNull() | F.isnan(value), value).otherwise(out)


def leaf_area(cover: Column, k: float = 0.5, floor: float = 0.01, top: float = 12.0) -> Column:
    """Leaf area index of a woody cover fraction, -ln(1 - f) / k within floor and top; full cover has the top, null stays null."""
    return F.when(cover.isNotNull(), F.greatest(-F.log(F.greatest(1 - cover, F.exp(F.lit(-k * top)))) / k, F.lit(floor)))


def grass_leaf_area(cover: Column, k: float = 0.5, least: float = 0.01, floor: float = 0.01) -> Column:
    """Leaf area index of a grass cover fraction, -ln(1 - f / (1 - f)) / k and the floor at least.

    The logarithm is of `least` at least, which half cover and more have.
    """
    open_ = F.when(cover < 1, 1 - cover / F.greatest(1 - cover, F.lit(1e-300))).otherwise(0.0)
    return F.when(cover.isNotNull(), F.greatest(-F.log(F.greatest(open_, F.lit(least))) / k, F.lit(floor)))
