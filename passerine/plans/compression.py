"""History compression: the payloads that carry the newest traits and consents of a person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.frames import keep, once
from passerine.functions.values import ext_type, root_text, text
from passerine.operators.enrich import person_key
from passerine.operators.joins import channel_type_join, trait_resolution, winner_join
from passerine.operators.reshape import leaves_to_rows
from passerine.operators.route import MPN
from passerine.operators.windows import latest_consent_rank, latest_trait_rank

PERSON_FIELDS = [MPN, "consumerId", "sourceId", "offlineConsumerId", "email", "phoneNumber"]

# Channels in the order their fields are looked at, and their letters.
OPT_CHANNELS = {"email": "E", "phone": "P", "postal": "A", "regulatory": "R", "social": "S"}
REASON_CHANNELS = ["email", "phone", "postal", "social"]
PLAIN_OPT_FIELDS = [
    "consumerId", "offlineConsumerId", "countryCode", "email", "initialOptStatus", "languageCode", "legalEntityNumber", MPN,
    "nationalId", "optId", "optReason", "optText", "optVersion", "phoneNumber", "sourceId", "uuid",
    "regulatoryContactCategory", "regulatoryContactType",
]


def scalar(value: Column) -> Column:
    """Text of a scalar variant; objects and arrays are NULL."""
    shape = F.schema_of_variant(value)
    return F.when(~(shape.startswith("OBJECT") | shape.startswith("ARRAY")), text(value))


def greatest_ext(name: str) -> Column:
    """Greatest id text among the external ids of a type."""
    return F.array_max(F.transform(F.filter("ext_ids", lambda x: ext_type(x) == name), lambda x: scalar(x["id"])))


def identity_rows(payloads: DataFrame, mpns: list[str], default_mpn: str) -> DataFrame:
    """identify payloads of the listed programs with their person fields, person key and traits."""
    rows = keep(payloads, root_text("type") == "identify")
    fields = {n: F.coalesce(scalar(F.col("traits")[n]), greatest_ext(n)) for n in PERSON_FIELDS}
    flat = rows.select(
        root_text("userId").alias("userId"), root_text("messageId").alias("traceId"),
        root_text("originalTimestamp").alias("lastActivityDate"), F.col("traits").alias("_traits"),
        scalar(F.col("traits")["registrationDate"]).alias("registrationDate"), *[c.alias(n) for n, c in fields.items()],
    )
    flat = once(flat, **{n: F.col(n) for n in PERSON_FIELDS})
    return person_key(flat.filter(F.col(MPN).isin(*mpns)), default_mpn)


def compress_ids(identities: DataFrame) -> DataFrame:
    """Distinct identities that are complete: program and source with an id, or with contact and registration date."""
    base = F.col(MPN).isNotNull() & F.col("sourceId").isNotNull()
    by_id = F.coalesce("consumerId", "offlineConsumerId").isNotNull()
    by_contact = F.coalesce("email", "phoneNumber").isNotNull() & F.col("registrationDate").isNotNull()
    return identities.filter(base & (by_id | by_contact)).select(
        "userId", F.col(MPN).try_cast("bigint").alias(MPN), "consumerId", F.col("sourceId").try_cast("bigint").alias("sourceId"),
        "offlineConsumerId", "email", "phoneNumber", "registrationDate", "consumerid_sourceid_mpn",
    ).distinct()


def trait_leaves(identities: DataFrame) -> DataFrame:
    """Scalar leaves (key, val) of the traits beside their record's identity."""
    columns = ["userId", "traceId", "lastActivityDate", MPN, "sourceId", "consumerid_sourceid_mpn"]
    nested = identities.select(*columns, F.to_variant_object("_traits").alias("_t")).filter(F.col("_t").isNotNull())
    return leaves_to_rows(nested, F.col("_t")).drop("_t")


def compress_traits(identities: DataFrame, ids: DataFrame, eco, aliases, traits, source_map, default_mpn: str) -> DataFrame:
    """Newest trait rows per (person, trait, value); ties kept."""
    return latest_trait_rank(trait_resolution(trait_leaves(identities), ids, eco, aliases, traits, source_map, default_mpn))


def compress_consents(payloads: DataFrame, types: DataFrame, country: str, legal_entity: int) -> DataFrame:
    """One row per distinct opt change; rows whose channels name no service drop out."""
    rows = keep(payloads, root_text("type") == "track")
    prop = lambda n: scalar(F.col("properties")[n])
    names = list(PLAIN_OPT_FIELDS)
    for channel in OPT_CHANNELS:
        names += [f"{channel}ConsumerChoiceDate", f"{channel}SubscriptionOptIndicator", f"{channel}SubscriptionOptNumber", f"{channel}SubscriptionServiceName"]
    names += [f"{c}OptStatusReason" for c in REASON_CHANNELS]
    values = {n: prop(n) for n in names}
    indicator = values["emailSubscriptionOptIndicator"]
    values["emailSubscriptionOptIndicator"] = F.when(F.length(indicator) <= 5, indicator)
    ext = {f"{n}1": greatest_ext(n) for n in PERSON_FIELDS}
    flat = rows.select(
        root_text("messageId").alias("traceId"), root_text("userId").alias("userId"), root_text("originalTimestamp").alias("lastActivityDate"),
        root_text("anonymousId").alias("anonymousId"), *[c.alias(n) for n, c in values.items()], *[c.alias(n) for n, c in ext.items()],
    )
    keys = ["userId", "lastActivityDate", "anonymousId", *values]
    grouped = flat.groupBy(*keys).agg(F.max("traceId").alias("traceId"), *[F.max(n).alias(n) for n in ext])
    first = lambda suffix, channels=OPT_CHANNELS: F.coalesce(*[F.col(f"{c}{suffix}") for c in channels])
    letter = F.lit(None).cast("string")
    for channel, code in reversed(list(OPT_CHANNELS.items())):
        letter = F.when(F.col(f"{channel}SubscriptionServiceName").isNotNull(), code).otherwise(letter)
    moment = lambda c: c.try_cast("timestamp").cast("timestamp_ntz")
    shaped = grouped.select(
        "userId", moment(F.col("lastActivityDate")).alias("created_date"), F.col("traceId").alias("trace_id"), "anonymousId",
        F.coalesce("countryCode", F.lit(country)).alias("country_code"),
        moment(F.coalesce(first("ConsumerChoiceDate"), F.col("lastActivityDate"))).alias("opt_date"),
        first("OptStatusReason", REASON_CHANNELS).alias("OptStatusReason"), first("SubscriptionOptIndicator").alias("opt_status"),
        first("SubscriptionOptNumber").try_cast("bigint").alias("opt_number"), first("SubscriptionServiceName").alias("service_name"),
        F.coalesce("initialOptStatus", F.lit("false")).alias("initial_opt_status"), "languageCode",
        F.coalesce(F.col("legalEntityNumber").try_cast("bigint"), F.lit(legal_entity).cast("bigint")).alias("legal_entity_id"),
        "nationalId", F.col("optId").alias("opt_id"), "optReason", F.col("optText").alias("opt_text"), "optVersion",
        F.col("regulatoryContactCategory").alias("ContactCategory"), "regulatoryContactType", "uuid",
        F.coalesce(MPN, f"{MPN}1").try_cast("bigint").alias("marketing_program_number"), F.coalesce("consumerId", "consumerId1").alias("consumer_id"),
        F.coalesce(F.coalesce("sourceId", "sourceId1").try_cast("bigint"), F.lit(0).cast("bigint")).alias("source_id"),
        F.coalesce("offlineConsumerId", "offlineConsumerId1").alias("offlineConsumerId"), F.coalesce("email", "email1").alias("email"),
        F.coalesce("phoneNumber", "phoneNumber1").alias("phone_number"), letter.alias("channel"),
    )
    joined = channel_type_join(shaped.filter(F.col("channel").isNotNull()), types)
    return joined.withColumn("ContactType", F.coalesce("regulatoryContactType", "channel")).drop("regulatoryContactType").distinct()


def compress_final(raw: DataFrame, traits: DataFrame, consents: DataFrame) -> DataFrame:
    """Distinct raw rows (raw_payload, message_id) that carry a newest trait or consent."""
    return winner_join(raw, traits.select("trace_id"), latest_consent_rank(consents).select("trace_id"))
