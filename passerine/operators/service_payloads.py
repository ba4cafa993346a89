"""Documents for the id and consent services."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.functions.dates import ISO_MILLIS
from passerine.functions.values import VARIANT_MAP, has_key, put_all, text, variant
from passerine.operators.skew import adaptive_join, numbered_runs

# Traits moved to the top level, blocks sent empty, and the document's constants.
NAMED_TRAITS = ["firstName", "lastName", "fullName", "birthDate"]
BLANKED_BLOCKS = ["dependents", "opts", "traits"]
CONSENT_ORIGIN = "api-registrations"
REQUEST_ID = "data-migration"
ADDRESS_FIELDS = {
    "territoryName": "territory_name", "streetComplement": "street_complement", "poBoxNumber": "po_box_number",
    "streetNumber": "street_number", "subBuilding": "sub_building", "houseNumber": "house_number", "box": "po_box",
    "building": "building", "streetName": "street_name", "cityName": "city_name", "cityComplement": "city_complement",
    "addressLine1": "address_line1", "postalAreaCode": "postal_area_code", "addressLine2": "address_line2",
    "addressLine3": "address_line3", "apartmentNumber": "apartment_number",
}


def millis_stamp(txt: Column) -> Column:
    """Request timestamp cut or padded to milliseconds."""
    whole = txt.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z")
    padded = F.concat(txt.substr(F.lit(1), F.length(txt) - 1), F.lit(".000Z"))
    return F.when(whole, padded).otherwise(F.concat(F.substring(txt, 1, 23), F.lit("Z")))


def id_service_payload(traces: DataFrame, legal_entity: str) -> DataFrame:
    """Trace rows as id-service documents, with the moved scalars beside the ``document``.

    Rows whose raw payload has no ``data`` object are dropped.
    """
    body = F.from_json("raw_payload", VARIANT_MAP)
    data = F.try_variant_get(F.col("_body")["data"], "$", VARIANT_MAP)
    out = traces.withColumn("_body", body).withColumn("_data", data).filter(F.col("_data").isNotNull())
    items = F.try_variant_get(F.col("_data")["traits"], "$", "array<struct<traitName string, `values` variant>>")
    moved = {
        name: F.element_at(F.filter(items, lambda t: t["traitName"] == name), -1)["values"] for name in NAMED_TRAITS
    }
    found = {name: F.when(F.exists(items, lambda t: t["traitName"] == name), value) for name, value in moved.items()}
    none = F.parse_json(F.lit("[]"))
    blanks = F.create_map(*[x for k in BLANKED_BLOCKS for x in (F.lit(k), none)])
    stamp = text(F.col("_body")["requestTimestamp"])
    request = F.when(has_key(F.col("_body"), "requestTimestamp"), millis_stamp(stamp))
    raw = put_all(F.col("_body"), F.create_map(F.lit("data"), F.to_variant_object(put_all(F.col("_data"), blanks))))
    raw = F.when(request.isNotNull(), put_all(raw, F.create_map(F.lit("requestTimestamp"), variant(request)))).otherwise(raw)
    shaped = out.select(
        F.col("trace_id").alias("traceId"), F.col("pipeline_origin").alias("pipeline"),
        F.date_format("received_date", ISO_MILLIS).alias("receivedTimestamp"), F.col("account_id").alias("accountId"),
        F.lit(str(legal_entity)).alias("legalEntity"), F.to_variant_object(raw).alias("rawPayload"),
        *[v.alias(k) for k, v in found.items()], request.alias("requestTimestamp"),
    )
    doc = F.to_json(F.struct(
        "traceId", "pipeline", "receivedTimestamp", "accountId", "legalEntity", "rawPayload", *NAMED_TRAITS))
    return shaped.select(
        "traceId", "pipeline", "receivedTimestamp", "accountId", "legalEntity", "requestTimestamp",
        *[text(F.col(n)).alias(n) for n in NAMED_TRAITS], doc.alias("document"),
    )


def consent_service_payload(consents: DataFrame, now: dt.datetime, order: list[str] | None = None, max_opts: int = 10_000) -> DataFrame:
    """Consent rows (already matched to reference data) as one document per trace id.

    Identity and address come from the first row by ``order``; the opts are the rows in that order;
    the request time is the latest opt date.  A document is a part: a run of ``max_opts`` opts in
    that order, numbered from 0, whatever the trace's size; its parts together hold all of them.
    """
    order = order or ["opt_id"]
    rank_key = F.struct(*order)
    stamp = lambda c: F.date_format(c, ISO_MILLIS)
    scalars = [
        "source_id", "consumer_id", "marketing_program_number", "phone_number", "email", "country_code",
        "legal_entity_id", *ADDRESS_FIELDS.values(),
    ]
    have = set(consents.columns)
    first = [(F.min_by(c, rank_key) if c in have else F.lit(None).cast("string")).alias(c) for c in scalars]
    heads = consents.groupBy("trace_id").agg(*first, F.max("opt_date").alias("max_opt_date"), F.count(F.lit(1)).alias("n_opts"))
    text_of = lambda c: F.col(c).cast("string") if c in have else F.lit(None).cast("string")
    opt = F.struct(
        text_of("contact_category").alias("contactCategory"), text_of("source_system").alias("sourceSystem"),
        F.lit("").alias("optIpAddress"), text_of("contact_type").alias("contactType"),
        text_of("unsubscribe_url").alias("unsubscribeURL"), text_of("contact_point_type_name").alias("contactPointTypeName"),
        text_of("opt_status").alias("optStatus"), text_of("opt_reason").alias("optReason"),
        text_of("initial_opt_status").alias("initialOptStatus"), text_of("trait_id_opt_indicator").alias("traitIdOptIndicator"),
        text_of("opt_number").alias("optNumber"), text_of("opt_text").alias("optText"),
        stamp("opt_date").alias("optChoiceDate"), text_of("opt_id").alias("optId"), text_of("service_name").alias("optServiceName"),
    )
    parts = numbered_runs(consents, ["trace_id"], order, max_opts)
    lists = parts.groupBy("trace_id", "part").agg(F.array_sort(F.collect_list(F.struct(rank_key.alias("k"), opt.alias("o")))).alias("_l"))
    joined = adaptive_join(lists, heads, ["trace_id"], "inner").withColumn("opts", F.transform("_l", lambda x: x["o"])).withColumn("max_stamp", stamp("max_opt_date"))
    s = lambda c: F.col(c).cast("string")
    trait = F.struct(F.lit("lastActivityDate").alias("traitName"), F.col("max_stamp").alias("values"),
                     F.col("max_stamp").alias("collectedDate"), F.lit("").alias("collectedBy"))
    ids = F.struct(
        s("source_id").alias("sourceId"), F.col("consumer_id").alias("consumerId"), s("marketing_program_number").alias("marketingProgramNumber"),
        F.col("phone_number").alias("phoneNumber"), F.struct(*[F.col(c).alias(n) for n, c in ADDRESS_FIELDS.items()]).alias("originalAddress"),
        F.col("country_code").alias("countryCode"), F.col("email").alias("email"),
    )
    data = F.struct(F.array(trait).alias("traits"), ids.alias("ids"), F.array().cast("array<string>").alias("dependents"), F.col("opts").alias("opts"))
    raw = F.struct(
        s("source_id").alias("sourceId"), s("source_id").alias("transmitterSourceId"), F.lit("1").alias("specVersion"), data.alias("data"),
        F.col("max_stamp").alias("requestTimestamp"), F.lit(REQUEST_ID).alias("requestId"),
        s("marketing_program_number").alias("marketingProgramNumber"), F.lit("").alias("eventName"),
    )
    received = now.strftime("%Y-%m-%dT%H:%M:%S.") + f"{now.microsecond // 1000:03d}Z"
    doc = F.to_json(
        F.struct(
            F.col("trace_id").alias("traceId"), F.lit(CONSENT_ORIGIN).alias("pipeline"), F.lit("").alias("accountId"),
            F.lit(received).alias("receivedTimestamp"), raw.alias("rawPayload"), s("legal_entity_id").alias("legalEntity"),
        ),
        {"ignoreNullFields": "false"},
    )
    return joined.select(
        "trace_id", "part", "n_opts", s("source_id").alias("source_id"), "consumer_id", s("marketing_program_number").alias("marketing_program_number"),
        "email", "country_code", s("legal_entity_id").alias("legal_entity_id"), F.col("max_stamp").alias("request_timestamp"),
        F.size("opts").alias("opts_in_part"), doc.alias("document"),
    )
