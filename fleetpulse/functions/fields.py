"""Column expressions for single message fields. All of them run inside whole-stage codegen and return NULL, never an
error, for text that does not parse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
STATE_SENSOR = "drone-state-sensor;v1"
EVENT_SENSOR = "drone-event-sensor;v1"
EVENT_SENSOR_PREFIX = "drone-event-sensor"
FLIGHT_STATUS_CODES = ("DPS", "INF", "PUP", "DOP", "ARS")
NUMBER_PATTERN = r"([-+]?[0-9]*\.?[0-9]+)"
POSITION_PATTERN = NUMBER_PATTERN + r"\|" + NUMBER_PATTERN + r"\|" + NUMBER_PATTERN
HOT_TEMPERATURE = 75.0

INVALID_POSITION = "invalid_position"
INVALID_RANGE = "invalid_range"

MICROS = 1_000_000


def body_text(body: Column) -> Column:
    """Message bytes as text; invalid UTF-8 is replaced."""
    return body.cast("string")


def to_time(text: Column) -> Column:
    """ISO-8601 text to timestamp, NULL if malformed."""
    return F.try_to_timestamp(text)


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def to_whole(text: Column) -> Column:
    """Number text to int, its fraction cut off ('3.0' and '3.9' are 3); NULL if malformed or out of range."""
    return text.try_cast("double").try_cast("int")


def time_text(time: Column) -> Column:
    """Timestamp to text with a fixed six-digit fraction, so that text order is time order."""
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def whole(value: Column, unit: int) -> Column:
    """How many whole units a bigint holds, rounded down; exact where a double quotient would not be."""
    return F.call_function("div", value - F.pmod(value, F.lit(unit)), F.lit(unit))


def minute_of(time: Column) -> Column:
    """Minutes since the epoch; the difference of two of them counts minute boundaries crossed."""
    return whole(F.unix_micros(time), 60 * MICROS)


def bin_of(time: Column, seconds: int) -> Column:
    """Number of the aligned time bin of the given width."""
    return whole(F.unix_micros(time), seconds * MICROS)


def position_part(position: Column, index: int) -> Column:
    """Part of a 'lat|lon|alt' text, unchecked; NULL when missing."""
    return F.get(F.split(position, r"\|"), F.lit(index))


def position_match(position: Column) -> Column:
    """Texts of latitude, longitude and altitude: the first place where three numbers stand between bars, whatever
    surrounds it. Without one, an array of a single empty text."""
    return F.split(F.regexp_extract(position, POSITION_PATTERN, 0), r"\|")


def position_problem(latitude: Column, longitude: Column) -> Column:
    """Why a matched position is unusable, NULL if it is not."""
    in_range = (latitude >= -90) & (latitude <= 90) & (longitude >= -180) & (longitude <= 180)
    return F.when(latitude.isNull() | longitude.isNull(), INVALID_POSITION).when(~in_range, INVALID_RANGE)


def flight_status(code: Column) -> Column:
    """Status name of a zero-based code; NULL outside the list."""
    return F.get(F.array(*[F.lit(name) for name in FLIGHT_STATUS_CODES]), to_whole(code.cast("string")))


def wkt_point(longitude: Column, latitude: Column) -> Column:
    return F.concat(F.lit("POINT ("), longitude.cast("string"), F.lit(" "), latitude.cast("string"), F.lit(")"))


def geojson_point(longitude: Column, latitude: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(longitude, latitude).alias("coordinates"))


def temperature_alert(temperature: Column, threshold: float = HOT_TEMPERATURE) -> Column:
    """'true' above the threshold, 'false' otherwise."""
    return F.when(temperature > threshold, F.lit("true")).otherwise(F.lit("false"))
