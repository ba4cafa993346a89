"""Keys, filters and multi-output routing of payloads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.frames import once, split
from passerine.functions import dates
from passerine.functions.values import (
    ext_first, ext_id, has_key, has_root, is_blank, is_text, kind, put, root, root_text, text, variant,
)
from passerine.operators.skew import adaptive_join

OPT_EVENT = "Changed Opt Status"
MPN = "marketingProgramNumber"
NOT_FOUND = "KEY_NOT_FOUND"

# Event names of the registration route, and the two page-view events added to
# the clickstream route.
REGISTRATION_EVENTS = ["changed opt status", "identify"]
PAGE_EVENTS = ["screen", "page"]
EMAIL_CATEGORY = "Email CLT"
NULL_TEXT = "NULL"


def with_user_key(payloads: DataFrame) -> DataFrame:
    """Add ``user_key``: userId when that key is present (even if null), else anonymousId.

    A record with neither key gets NULL; ``split_keyless`` sends it to the corrupt output.
    """
    key = F.when(has_root("userId"), root_text("userId")).otherwise(root_text("anonymousId"))
    return once(payloads, user_key=key)


def has_user_key() -> Column:
    return has_root("userId") | has_root("anonymousId")


def split_keyless(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(has userId or anonymousId, has neither)."""
    return split(payloads, has_user_key())


def filter_backdated(payloads: DataFrame, as_of: dt.date, anonymous_mode: str = "recent") -> DataFrame:
    """Records newer than 3 x 365 days before ``as_of``.

    Records carrying ``anonymousId`` must be newer than 6 x 30 days in ``recent`` mode and are
    dropped in ``drop`` mode.  A missing or badly formed originalTimestamp drops the record.
    """
    if anonymous_mode not in ("recent", "drop"):
        raise ValueError(f"unknown anonymous_mode {anonymous_mode!r}")
    day = dates.strict_date(F.when(is_text(root("originalTimestamp")), root_text("originalTimestamp")))
    three_years = F.lit(as_of - dt.timedelta(days=3 * 365))
    half_year = F.lit(as_of - dt.timedelta(days=6 * 30))
    anonymous = has_root("anonymousId")
    dated = once(payloads, _day=day, _anonymous=anonymous)
    day = F.col("_day")
    keep_anonymous = day > half_year if anonymous_mode == "recent" else F.lit(False)
    fresh = F.when(F.col("_anonymous"), keep_anonymous).otherwise(day > three_years)
    return dated.filter(fresh).drop("_day", "_anonymous")


def _mpn_candidates() -> dict[str, Column]:
    """Where a program number may sit; only text can equal a listed number."""
    context_traits = F.try_variant_get(F.col("context")["traits"], "$", "map<string,variant>")
    spots = {
        "_m1": F.col("properties")[MPN],
        "_m2": F.col("traits")[MPN],
        "_m3": context_traits[MPN],
        "_m4": ext_id(MPN),
    }
    return {name: F.when(is_text(v), text(v)) for name, v in spots.items()}


def flag_invalid_mpn(payloads: DataFrame, invalid: DataFrame) -> DataFrame:
    """Add boolean ``invalid_mpn``: one of the four places of a program number is in ``invalid.mpn``.

    The distinct sets of numbers that payloads carry meet the list; payloads are joined once, with the sets that hit it.
    """
    numbers = F.array_sort(F.array_distinct(F.array_compact(F.array(*_mpn_candidates().values()))))
    out = once(payloads, _mpns=numbers)
    listed = invalid.select("mpn").dropna().distinct()
    seen = out.select("_mpns").distinct().withColumn("mpn", F.explode("_mpns"))
    hits = adaptive_join(seen, listed, ["mpn"], "left_semi").select("_mpns").distinct().withColumn("_hit", F.lit(True))
    return adaptive_join(out, hits, ["_mpns"]).withColumn("invalid_mpn", F.col("_hit").isNotNull()).drop("_mpns", "_hit")


def split_invalid_mpn(payloads: DataFrame, invalid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid)."""
    flagged = flag_invalid_mpn(payloads, invalid)
    return (
        flagged.filter(~F.col("invalid_mpn")).drop("invalid_mpn"),
        flagged.filter("invalid_mpn").drop("invalid_mpn"),
    )


def event_catalogue(events_ref: DataFrame) -> DataFrame:
    """(route, event_name) from the event reference: names plus '|'-separated aliases, lower-cased.

    clickstream has an analytics name; clt is the e-mail category; other is the rest except the
    opt-status event.  Registration and the page-view events are fixed.
    """
    cols = ["eventName", "eventCategory", "gacaEventName"]
    alias_ok = (F.length("eventNameAlias") > 1) & (F.col("eventNameAlias") != NULL_TEXT)
    aliases = events_ref.filter(alias_ok).select(
        F.explode(F.split("eventNameAlias", r"\|")).alias("eventName"), "eventCategory", "gacaEventName"
    )
    names = events_ref.select(*cols).unionByName(aliases)
    tracked = (F.col("gacaEventName") != NULL_TEXT) & (F.col("gacaEventName") != "")
    email = F.col("eventCategory") == EMAIL_CATEGORY
    rest = (
        (F.col("eventName") != OPT_EVENT)
        & (F.col("eventCategory") != EMAIL_CATEGORY)
        & F.col("gacaEventName").isin("", NULL_TEXT)
    )
    routes = F.filter(
        F.array(
            F.when(tracked, F.lit("clickstream")), F.when(email, F.lit("clt")), F.when(rest, F.lit("other")),
        ),
        lambda r: r.isNotNull(),
    )
    derived = names.select(F.explode(routes).alias("route"), F.lower("eventName").alias("event_name"))
    fixed = [("registration", e) for e in REGISTRATION_EVENTS] + [("clickstream", e) for e in PAGE_EVENTS]
    listed = events_ref.sparkSession.createDataFrame(fixed, "route string, event_name string")
    return derived.unionByName(listed).distinct()


def routing_name() -> Column:
    """Lower-cased event when the key is present, else the type as it is."""
    event = F.coalesce(root_text("event"), F.lit("none"))
    return F.when(has_root("event"), F.lower(event)).otherwise(root_text("type"))


def route_events(payloads: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Add ``route``; a record appears once per route listing its event, else once as ``unmatched``."""
    return route_by_name(payloads, routes_per_name(catalogue))


def routes_per_name(catalogue: DataFrame) -> DataFrame:
    """(event_name, _routes): the routes that list each event name, a row per name."""
    return catalogue.groupBy("event_name").agg(F.sort_array(F.collect_set("route")).alias("_routes"))


def route_by_name(payloads: DataFrame, per_name: DataFrame) -> DataFrame:
    """:func:`route_events` by ``routes_per_name``. Where that is read from a written table, its size is known before the payloads
    are dealt, so that Spark need not shuffle them for a small one."""
    named = once(payloads, event_name=routing_name())
    joined = adaptive_join(named, per_name, ["event_name"])
    routes = F.coalesce(F.col("_routes"), F.array(F.lit("unmatched")))
    return joined.withColumn("route", F.explode(routes)).drop("_routes", "event_name")


def is_opt_change() -> Column:
    return F.coalesce(root_text("event") == OPT_EVENT, F.lit(False))


def split_changed_opt(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(opt changes, everything else): event compared lower-cased."""
    opt = F.coalesce(F.lower(root_text("event")) == OPT_EVENT.lower(), F.lit(False))
    return split(payloads, opt)


def postal_only() -> Column:
    """Opt-change track record without e-mail and phone that has a postal property.

    Decision: any property key containing ``postal`` counts, not just the first key.
    """
    def absent(key: str) -> Column:
        value = F.col("properties")[key]
        return F.coalesce(text(value) == "null", F.lit(True))

    has_postal = F.exists(F.map_keys("properties"), lambda k: k.contains("postal"))
    return F.coalesce(
        (root_text("type") == "track") & is_opt_change() & absent("email") & absent("phoneNumber") & has_postal,
        F.lit(False),
    )


def split_postal_only(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(excluded, proper); excluded records are tagged ``postal = 'exclude'`` at the top level."""
    tagged, proper = split(tag_postal_only(payloads, "_postal"), F.col("_postal"))
    return tagged.drop("_postal"), proper.drop("_postal")


def tag_postal_only(payloads: DataFrame, name: str) -> DataFrame:
    """Add boolean ``name``; records to exclude are tagged ``postal = 'exclude'`` at the top level."""
    flagged = once(payloads, **{name: postal_only()})
    tagged = put(F.col("root"), "postal", variant(F.lit("exclude")))
    return once(flagged, root=F.when(F.col(name), tagged).otherwise(F.col("root")))


def landing_text(value: Column) -> Column:
    """Whole numbers and booleans as text, blank text as NULL, the rest as it is."""
    return F.when(kind(value) == "STRING", F.when(~is_blank(text(value)), text(value))).otherwise(text(value))


def to_landing(payloads: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """Landing rows: payload, type, program, source, message id, timestamp; absent = KEY_NOT_FOUND."""
    def top(key: str) -> Column:
        return F.when(has_root(key), landing_text(root(key))).otherwise(NOT_FOUND)

    def ext(kind_name: str) -> Column:
        entry = ext_first(kind_name)
        return F.when(has_key(entry, "id"), landing_text(entry["id"])).otherwise(NOT_FOUND)

    return payloads.select(
        "raw_payload",
        top("type").alias("event_type"),
        ext(MPN).alias("marketing_program_number"),
        ext("sourceId").alias("source_id"),
        top("messageId").alias("message_id"),
        top("timestamp").alias("payload_timestamp"),
        F.lit(loaded_at).cast("timestamp").alias("loaded_date"),
    )


def dlq_extract(dlq: DataFrame, start: str, end: str, field: str = "servicePayload") -> DataFrame:
    """Rows with start < publish_time <= end and their inner document as ``inner_payload``."""
    window = (F.col("publish_time") > F.lit(start).cast("timestamp_ntz")) & (
        F.col("publish_time") <= F.lit(end).cast("timestamp_ntz")
    )
    return dlq.filter(window).withColumn("inner_payload", F.get_json_object("data", f"$.{field}"))


def pending_replay(replay: DataFrame) -> DataFrame:
    return replay.filter(F.col("replay_status") == "ToBeReplayed")


def select_column(table: DataFrame, column: str) -> DataFrame:
    """One column of a landing table, e.g. ``raw_payload`` or ``data``."""
    return table.select(column)


CHANNELS = ["email", "phone", "postal", "social"]
CHANNEL_LABELS = {"email": ("Email", "E"), "phone": ("Phone", "P"), "postal": ("Postal", "A"), "social": ("Social", "S")}


def with_opt_signature(opts: DataFrame, default: str = "KEY NOT FOUND") -> DataFrame:
    """First non-null opt number and service over four channels, with channel name and letter."""
    label = letter = None
    for channel in CHANNELS:
        present = F.col(f"{channel}_subscription_opt_number").isNotNull() | F.col(
            f"{channel}_subscription_service_name"
        ).isNotNull()
        name, code = CHANNEL_LABELS[channel]
        label = F.when(present, name) if label is None else label.when(present, name)
        letter = F.when(present, code) if letter is None else letter.when(present, code)
    numbers = [F.col(f"{c}_subscription_opt_number").cast("string") for c in CHANNELS]
    services = [F.col(f"{c}_subscription_service_name") for c in CHANNELS]
    return opts.select(
        "*",
        F.coalesce(*numbers).alias("subscription_opt_number"),
        F.coalesce(*services, F.lit("")).alias("service_name"),
        label.otherwise(default).alias("opt_type"),
        letter.otherwise(default).alias("contact_point_type_code"),
    )


def partial_retention(identifies: DataFrame) -> DataFrame:
    """Users with an erased e-mail or phone whose address line 1 is null or not erased."""
    erased = (F.col("email") == " ") | (F.col("phone_number") == " ")
    address = F.col("address_line1").isNull() | (F.col("address_line1") != " ")
    return identifies.filter(erased & address).select("user_id").distinct()


def passes() -> Column:
    """No failure, or only the non-blocking VLD8."""
    lone = (F.size("failures") == 1) & (F.col("failures")[0]["dq_validation_id"] == "VLD8")
    return (F.size("failures") == 0) | lone


def failure_rows(failed: DataFrame) -> DataFrame:
    """One row per failed rule, carrying the payload text."""
    rows = failed.select("raw_payload", F.explode("failures").alias("f"))
    return rows.select(
        F.col("f.message_id"), "raw_payload", F.col("f.mpn"), F.col("f.dq_validation_id"),
        F.col("f.dq_validation_description"), F.col("f.error_details"), F.col("f.reported_at"),
    )


def split_validated(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(passed, failed rows) of a frame with a ``failures`` array; a lone VLD8 failure does not block."""
    good, bad = split(payloads, passes())
    return good.drop("failures"), failure_rows(bad)
