"""Date parsing.  Offsets are dropped, never converted."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ISO form of results and the ISO forms that rules look for.
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_MILLIS_PREFIX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z"
ISO_FRACTION = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d+Z$"
STRICT_FRACTION = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}Z$"
STAMP_IN_TEXT = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"

# Non-ISO dates accepted on input, tried in this order (month before day when ambiguous).
DATE_FORMATS = [
    "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "yyyy/M/d", "d MMM yyyy", "d MMMM yyyy", "MMM d yyyy", "MMMM d yyyy",
    "yyyyMMdd",
]
# The shape a text has to have for a format to fit: a format is tried on such texts only, since a failing parse is slow.
SHAPES = {
    r"^\d{1,2}/\d{1,2}/": ["M/d/yyyy", "d/M/yyyy"], r"^\d{1,2}-\d{1,2}-": ["M-d-yyyy", "d-M-yyyy"], r"^\d{4,}/": ["yyyy/M/d"],
    r"^\d{1,2} \p{L}": ["d MMM yyyy", "d MMMM yyyy"], r"^\p{L}": ["MMM d yyyy", "MMMM d yyyy"], r"^\d{8}$": ["yyyyMMdd"],
}
# A time of day at the end of a text, with its offset; and the weekday that may stand at its front.
TIME_AT_END = r"(?i)(?:[T ]+(\d{1,2}):(\d{1,2})(?::(\d{1,2})(\.\d{1,6})?\d*)?|T(\d{2})(\d{2})(\d{2})?)\s*([AP]M)?\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})?$"
WEEKDAY = r"(?i)^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+"


def strict_date(txt: Column) -> Column:
    """Date of an ISO text with fraction and Z; NULL when it does not follow that form."""
    return F.when(txt.rlike(STRICT_FRACTION), txt.substr(F.lit(1), F.length(txt) - 1).try_cast("timestamp_ntz")).cast("date")


def _spelled_moment(spelled: Column) -> Column:
    part = lambda k: F.nullif(F.regexp_extract(spelled, TIME_AT_END, k), F.lit(""))
    number = lambda *ks: F.coalesce(*(part(k).try_cast("int") for k in ks), F.lit(0))
    hour, half = number(1, 5), F.upper(part(8))
    clock = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "PM", 12).otherwise(0))
    second = number(3, 7) + F.coalesce(part(4).try_cast("decimal(7,6)"), F.lit(0).cast("decimal(7,6)"))
    date_text = F.trim(F.regexp_replace(spelled, TIME_AT_END, ""))
    read = lambda formats: F.coalesce(*(F.try_to_timestamp(date_text, F.lit(fmt)) for fmt in formats))
    day = reduce(lambda rest, shape: F.when(date_text.rlike(shape), read(SHAPES[shape])).otherwise(rest), reversed(SHAPES), F.lit(None).cast("timestamp"))
    times = F.array(F.struct(day.alias("day"), clock.alias("h"), number(2, 6).alias("m"), second.alias("s")))
    whole = lambda t: F.when((t["h"] < 24) & (t["m"] < 60) & (t["s"] < 60), t["day"] + F.make_dt_interval(F.lit(0), t["h"], t["m"], t["s"]))
    return F.element_at(F.transform(times, whole), 1)


def lenient_timestamp(txt: Column) -> Column:
    """Timestamp of a text in any accepted spelling, its offset dropped; NULL if none fits.

    An offset is one only after a time of day, so that the year of ``01-15-2024`` stays.
    """
    bare = F.trim(txt)
    iso = F.regexp_replace(bare, r"([T ]\d{1,2}(?::?\d{1,2}){0,2}(?:\.\d+)?)\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})$", "$1")
    looks_iso = iso.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([T ]|$)")
    spelled = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, WEEKDAY, ""), ",", " "), r"\s+", " ")
    # A lambda names the text once; written out, it would be repeated for every part and format.
    moment = F.element_at(F.transform(F.array(spelled), _spelled_moment), 1)
    return F.coalesce(F.when(looks_iso, iso.try_cast("timestamp_ntz").cast("timestamp")), moment)


def normalized(txt: Column) -> Column:
    """Text in ISO-millis form; already conforming or unparsable text is returned as it is."""
    parsed = F.date_format(lenient_timestamp(txt), ISO_MILLIS)
    return F.when(txt.rlike(ISO_MILLIS_PREFIX), txt).otherwise(F.coalesce(parsed, txt))
