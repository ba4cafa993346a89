"""Validation rules.  A rule is a column of failure structs; ``emit`` turns it into failure rows."""

from __future__ import annotations

import datetime as dt
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.frames import keep, once
from passerine.functions import dates
from passerine.functions.values import (
    ext_id, ext_type, from_traits_or_properties, has_root, is_falsy, is_text, kind, root, root_text,
    text,
)
from passerine.operators.route import MPN, is_opt_change, split_validated
from passerine.operators.skew import adaptive_join, kept

FAILURE = (
    "message_id string, mpn string, dq_validation_id string, dq_validation_description string, "
    "error_details string, reported_at timestamp"
)
FAILURE_COLUMNS = [
    "message_id", "raw_payload", "mpn", "dq_validation_id", "dq_validation_description", "error_details", "reported_at",
]

# Formats, contact type / category codes, and the texts of the rules.
WORDS = r"^[a-zA-Z\s\d]+$"
DIGITS = r"^\d+$"
EXTERNAL_ID_FORMATS = {
    MPN: DIGITS,
    "countryCode": WORDS,
    "sourceId": DIGITS,
    "consumerId": r"^[a-zA-Z0-9.:-]+$",
    "loyaltyAccountNumber": r"^[A-Za-z0-9-]*$",
}
TRUE_FALSE = r"^(?i)(true|false)$"
PROPERTY_FORMATS = {
    "OptNumber": DIGITS,
    "optId": r"^(\d+)_(\d+)$",
    "optChoiceDate": dates.ISO_FRACTION,
    "collectedDate": dates.ISO_FRACTION,
    "optStatus": TRUE_FALSE,
    "initialOptStatus": TRUE_FALSE,
}
TRACK_ONLY = {"optId", "initialOptStatus"}
CONTACT_PAIRS = {
    "email": ("E", "EP"), "phone": ("P", "PM"), "postal": ("A", "AR"), "social": ("S", "OT"), "regulatory": ("R", "PS"),
}
OPT_MAP_FIELDS = [
    "ciam_opt_id", "service_name", "subscription_opt_number", "contact_point_category_code", "contact_point_type_code",
]
OPT_CHANNELS = ["email", "phone", "postal", "social"]
DESCRIPTIONS = {
    "VLD2": "Validate if mpn and country combination exists in CRS",
    "VLD3": "Validate if mpn is Active from CRS (active means available)",
    "VLD4": "Loyalty account number can be alpha numeric and opt Ip address is optional field",
    "VLD5": "Either of optId , opt number or opt service name is required field",
    "VLD6": "The Universal request with mpn 9999 should have legalEntity trait",
    "VLD7": "Validate if MPN Opts combination exists In CRS",
    "VLD8": "Validate if Consumer ID exists in Payload or not(Payloads wont be blocked)",
    "VLD9": "Validate if Source Id MPN Combination exists in CRS",
    "VLD10": "Validate if originalTimestamp or timestamp exists in Payload",
}
UNIVERSAL_MPN = "9999"


def failure(rule: str, description: Column | str, details: Column, mpn: Column, reported_at: Column) -> Column:
    label = F.lit(description) if isinstance(description, str) else description
    return F.struct(
        root_text("messageId").alias("message_id"),
        mpn.cast("string").alias("mpn"),
        F.lit(rule).alias("dq_validation_id"),
        label.alias("dq_validation_description"),
        details.alias("error_details"),
        reported_at.cast("timestamp").alias("reported_at"),
    )


def no_failures() -> Column:
    return F.array().cast(f"array<struct<{_ddl()}>>")


def _ddl() -> str:
    return ",".join(f"{p.split()[0]}:{p.split()[1]}" for p in FAILURE.split(", "))


def listed(*candidates: Column) -> Column:
    """Array of the given failures without its NULL members."""
    return F.filter(F.array(*candidates), lambda f: f.isNotNull()).cast(f"array<struct<{_ddl()}>>")


def emit(payloads: DataFrame, failures: Column) -> DataFrame:
    """One row per failure, in the failure-table layout."""
    rows = once(payloads, _failures=failures).select("raw_payload", F.explode("_failures").alias("f"))
    return rows.select(*[F.col("raw_payload") if c == "raw_payload" else F.col(f"f.{c}") for c in FAILURE_COLUMNS])


#: Columns of ``with_plain_ids``.
PLAIN = ["_plain_ids", "_schema_mpn", "_schema_applies"]


def with_plain_ids(payloads: DataFrame) -> DataFrame:
    """Add what many rules look at, read from the payload once: type and id of the external ids as texts, the first program
    external id that is text, and whether the schema rules apply."""
    plain = F.transform("ext_ids", lambda x: F.struct(ext_type(x).alias("type"), text(x["id"]).alias("id"), is_text(x["id"]).alias("textual")))
    read = once(payloads, _plain_ids=plain)
    mpn = F.get(F.filter("_plain_ids", lambda x: (x["type"] == MPN) & x["textual"]), F.lit(0))["id"]
    read = once(read, _schema_mpn=mpn)
    applies = has_root("messageId") & F.col("_plain_ids").isNotNull() & ~F.coalesce(F.col("_schema_mpn") == UNIVERSAL_MPN, F.lit(False))
    return once(read, _schema_applies=applies)


def _plain(name: str) -> Column:
    """Type and id of the external ids of a type."""
    return F.filter("_plain_ids", lambda x: x["type"] == name)


# ---- schema rules: they read the columns of ``with_plain_ids`` -------------------


def _schema_mpn() -> Column:
    return F.col("_schema_mpn")


def _schema_applies() -> Column:
    return F.col("_schema_applies")


def schema_string_failures(reported_at: Column) -> Column:
    found = []
    for key, pattern in (("event", WORDS), ("timestamp", dates.ISO_FRACTION)):
        value = root(key)
        txt = text(value)
        make = partial(failure, "MCPC", mpn=_schema_mpn(), reported_at=reported_at)
        bad_format = make(
            f"Validate If {key} is in valid format in Payload",
            F.lit(f"INVALID_FORMAT: {key} name is not present in proper string format"),
        )
        empty = make(
            f"Validate If {key} is null in Payload",
            F.lit(f"FIELD_NULL {key} name is null or not with string datatype"),
        )
        wrong_type = make(
            f"Validate If {key} is having valid datatype in Payload",
            F.lit(f"INVALID_DATATYPE: {key} is having invalid datatype"),
        )
        found.append(
            F.when(~has_root(key), F.lit(None))
            .when(~is_text(value), wrong_type)
            .when(txt == "", empty)
            .when(~txt.rlike(pattern), bad_format)
        )
    return F.when(_schema_applies(), listed(*found)).otherwise(no_failures())


def _external_id_state(name: str, pattern: str) -> Column:
    """One pass over the external ids of a type up to its first good entry: what was wrong before it."""
    start = F.struct(
        F.lit(False).alias("seen"), F.lit(False).alias("done"), F.lit(None).cast("string").alias("bad"),
        F.lit(False).alias("empty"), F.lit(False).alias("mistyped"),
    )

    def step(acc, item):
        txt, textual = item["id"], item["textual"]
        good = textual & (txt != "") & txt.rlike(pattern)
        looked_at = F.struct(
            F.lit(True).alias("seen"), good.alias("done"),
            F.when(textual & (txt != "") & ~good, txt).otherwise(acc["bad"]).alias("bad"),
            (acc["empty"] | (textual & (txt == ""))).alias("empty"), (acc["mistyped"] | ~textual).alias("mistyped"),
        )
        return F.when(acc["done"], acc).otherwise(looked_at)

    return F.aggregate(_plain(name), start, step)


def with_external_id_states(payloads: DataFrame) -> DataFrame:
    """Reads the columns of ``with_plain_ids``."""
    return once(payloads, **{f"_x_{name}": _external_id_state(name, fmt) for name, fmt in EXTERNAL_ID_FORMATS.items()})


def schema_external_id_failures(reported_at: Column) -> Column:
    """Per type: wrong format, empty, wrong JSON type (entries before the first good one), missing.

    Reads the columns of ``with_external_id_states``.
    """
    found = []
    for name in EXTERNAL_ID_FORMATS:
        state = F.col(f"_x_{name}")
        make = partial(failure, "MCPC", mpn=_schema_mpn(), reported_at=reported_at)
        found.append(F.when(state["bad"].isNotNull(), make(
            f"Validate If {name} is in valid format in Payload",
            F.concat(F.lit(f"INVALID_FORMAT: {name} with value "), state["bad"], F.lit(" is not expected value for this field")),
        )))
        found.append(F.when(state["empty"], make(f"Validate If {name} is null in Payload", F.lit(f"FIELD_NULL: {name} is null"))))
        found.append(F.when(state["mistyped"], make(
            f"Validate If {name} is having valid datatype in Payload",
            F.lit(f"INVALID DATATYPE: {name} is having invalid datatype"),
        )))
        if name in (MPN, "sourceId", "consumerId"):
            missing = ~state["seen"]
            if name == "consumerId":
                missing = missing & from_traits_or_properties("offlineConsumerId").isNull()
            found.append(F.when(missing, make(
                f"Validate if {name} exists in Payload",
                F.lit(f"FIELD_NOT_FOUND: {name} Missing in External Id Block"),
            )))
    return F.when(_schema_applies(), listed(*found)).otherwise(no_failures())


def schema_property_failures(reported_at: Column) -> Column:
    """Format of every property key of each family.

    Decision: all keys of a family are checked, collectedDate must be ISO with fraction and Z.
    """
    per_family = []
    for family, pattern in PROPERTY_FORMATS.items():
        applies = root_text("type") == "track" if family in TRACK_ONLY else F.lit(True)
        members = F.filter(
            F.map_entries("properties"),
            lambda e: e["key"].contains(family) & ~(is_text(e["value"]) & F.coalesce(text(e["value"]).rlike(pattern), F.lit(False))),
        )
        made = F.transform(members, lambda e: failure(
            "OCPC",
            F.concat(F.lit("Validate If "), e["key"], F.lit(" is in valid format in Payload")),
            F.concat(
                F.lit("INVALID_FORMAT: "), e["key"], F.lit(" with value "), F.coalesce(text(e["value"]), F.lit("None")),
                F.lit(" is not expected value for this field"),
            ),
            _schema_mpn(),
            reported_at,
        ))
        per_family.append(F.when(applies & F.col("properties").isNotNull(), made).otherwise(F.array().cast(
            f"array<struct<{_ddl()}>>")))
    joined = F.concat(*[f.cast(f"array<struct<{_ddl()}>>") for f in per_family])
    return F.when(_schema_applies(), joined).otherwise(no_failures())


def vld_schema_strings(payloads: DataFrame, now: dt.datetime) -> DataFrame:
    return emit(with_plain_ids(payloads), schema_string_failures(F.lit(now)))


def vld_schema_external_ids(payloads: DataFrame, now: dt.datetime) -> DataFrame:
    return emit(with_external_id_states(with_plain_ids(payloads)), schema_external_id_failures(F.lit(now)))


def vld_schema_properties(payloads: DataFrame, now: dt.datetime) -> DataFrame:
    return emit(with_plain_ids(payloads), schema_property_failures(F.lit(now)))


# ---- reference-data rules over a registration table -----------------------------


def _ids(name: str) -> Column:
    return F.filter(
        F.transform(F.filter("ext_ids", lambda x: ext_type(x) == name), lambda x: text(x["id"])), lambda t: t.isNotNull()
    )


_FOUND = "array<struct<rule:string,_mpn:string,_country:string,details:string>>"


def _found(rule: str, details: Column, mpn: Column | None = None, country: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(rule).alias("rule"), (none if mpn is None else mpn).alias("_mpn"), (none if country is None else country).alias("_country"),
        details.alias("details"),
    )


def _batch(payloads: DataFrame, rules: dict[str, Column], program: DataFrame | None, mpn: str, now: dt.datetime) -> DataFrame:
    """Failures of batch rules in one pass over the payloads. A rule is an array of what it found in a payload; the programs
    and pairs that VLD2 and VLD3 found are then looked up in ``program``."""
    described = once(payloads, _found=F.concat(*[F.coalesce(r.cast(_FOUND), F.array().cast(_FOUND)) for r in rules.values()]))
    found = described.select(root_text("messageId").alias("message_id"), "raw_payload", F.inline("_found"))
    failed = ~F.col("rule").isin("VLD2", "VLD3")
    if "VLD2" in rules:
        pairs = program.select(F.col("mpn").cast("string").alias("_mpn"), F.col("country_code").cast("string").alias("_country"))
        found = adaptive_join(found, pairs.distinct().withColumn("_pair", F.lit(True)), ["_mpn", "_country"])
        failed = failed | ((F.col("rule") == "VLD2") & F.col("_pair").isNull())
    if "VLD3" in rules:
        known = program.select(F.col("mpn").cast("string").alias("_mpn")).distinct()
        found = adaptive_join(found, known.withColumn("_known", F.lit(True)), ["_mpn"])
        failed = failed | ((F.col("rule") == "VLD3") & F.col("_known").isNull())
    texts = F.create_map(*[F.lit(t) for rule in rules for t in (rule, DESCRIPTIONS[rule])])
    return found.filter(failed).select(
        "message_id", "raw_payload", F.lit(mpn).alias("mpn"), F.col("rule").alias("dq_validation_id"),
        texts[F.col("rule")].alias("dq_validation_description"), F.col("details").alias("error_details"),
        F.lit(now).cast("timestamp").alias("reported_at"),
    )


def _mpn_country() -> Column:
    return F.flatten(F.transform(_ids(MPN), lambda m: F.transform(_ids("countryCode"), lambda c: _found(
        "VLD2", F.concat(F.lit(f"{MPN}-"), m, F.lit(" And countryCode-"), c), m, c))))


def vld2_mpn_country(payloads: DataFrame, program: DataFrame, mpn: str, now: dt.datetime) -> DataFrame:
    """Program and country external ids of one message must be a row of ``program``.

    Decision: reports the pairs that do not match.
    """
    return _batch(payloads, {"VLD2": _mpn_country()}, program, mpn, now)


def _mpn_active() -> Column:
    return F.transform(_ids(MPN), lambda m: _found("VLD3", F.concat(F.lit(f"{MPN}-"), m), m))


def vld3_mpn_active(payloads: DataFrame, program: DataFrame, mpn: str, now: dt.datetime) -> DataFrame:
    """Program external ids must exist in ``program``.  Decision: reports those that do not."""
    return _batch(payloads, {"VLD3": _mpn_active()}, program, mpn, now)


def _loyalty_alnum() -> Column:
    ids = F.transform(F.filter("ext_ids", lambda x: ext_type(x) == "loyaltyAccountNumber"), lambda x: text(x["id"]))
    bad = F.filter(ids, lambda t: ~F.coalesce(t.rlike(EXTERNAL_ID_FORMATS["loyaltyAccountNumber"]), F.lit(False)))
    return F.transform(bad, lambda t: _found("VLD4", F.concat(F.lit("loyaltyAccountNumber "), t)))


def vld4_loyalty_alnum(payloads: DataFrame, mpn: str, now: dt.datetime) -> DataFrame:
    """Loyalty account numbers hold letters, digits and dashes only."""
    return _batch(payloads, {"VLD4": _loyalty_alnum()}, None, mpn, now)


def _prop(name: str) -> Column:
    return text(F.col("properties")[name])


def _contact(name: str) -> Column:
    """contactType / contactCategory in either spelling."""
    return F.coalesce(_prop(name), _prop(name[0].upper() + name[1:]))


def _opt_track() -> Column:
    return is_opt_change() & (root_text("type") == "track")


def _opt_identity() -> Column:
    ok = _prop("optId").isNotNull()
    for channel, (letter, group) in CONTACT_PAIRS.items():
        named = _prop(f"{channel}SubscriptionOptNumber").isNotNull() | _prop(f"{channel}SubscriptionServiceName").isNotNull()
        ok = ok | F.coalesce((_contact("contactType") == letter) & (_contact("contactCategory") == group) & named, F.lit(False))
    details = F.lit("optId/SubscriptionOptNumber/SubscriptionServiceName is either missing /wrong ")
    return F.when(_opt_track() & ~F.coalesce(ok, F.lit(False)), F.array(_found("VLD5", details)))


def vld5_opt_identity(payloads: DataFrame, mpn: str, now: dt.datetime) -> DataFrame:
    """An opt change needs an opt id, or its channel's opt number or service name."""
    return _batch(payloads, {"VLD5": _opt_identity()}, None, mpn, now)


def _universal_legal_entity() -> Column:
    service = F.lit("")
    for channel, (letter, group) in CONTACT_PAIRS.items():
        hit = (_contact("contactType") == letter) & (_contact("contactCategory") == group)
        service = F.when(hit, _prop(f"{channel}SubscriptionServiceName")).otherwise(service)
    universal = F.coalesce(service == "Universal", F.lit(False))
    nine = lambda e: F.coalesce((ext_type(e) == MPN) & (text(e["id"]) == UNIVERSAL_MPN), F.lit(False))
    entries = F.when(universal, F.col("ext_ids")).otherwise(F.filter("ext_ids", nine))
    bad = F.transform(entries, lambda _: _found("VLD6", F.lit("legalEntity trait is missing")))
    return F.when(_opt_track() & _prop("legalEntityNumber").isNull(), bad)


def vld6_universal_legal_entity(payloads: DataFrame, mpn: str, now: dt.datetime) -> DataFrame:
    """Universal opt changes need a legal entity: one failure per external id that makes them universal."""
    return _batch(payloads, {"VLD6": _universal_legal_entity()}, None, mpn, now)


# ---- row rules over enriched payloads: their columns read those of ``with_plain_ids`` ----


def _last_ext_mpn() -> Column:
    return F.coalesce(F.try_element_at(_plain(MPN), F.lit(-1))["id"], F.lit(""))


def _first_plain(name: str) -> Column:
    return F.get(_plain(name), F.lit(0))


def _opt_values() -> dict[str, Column]:
    """The record's own value for each opt-map field, as a variant."""
    props = F.col("properties")

    def first_present(suffix: str) -> Column:
        value = F.lit(None).cast("variant")
        for channel in reversed(OPT_CHANNELS):
            key = f"{channel}Subscription{suffix}"
            value = F.when(F.map_contains_key(props, key), props[key]).otherwise(value)
        return value

    return {
        "ciam_opt_id": props["optId"],
        "service_name": first_present("ServiceName"),
        "subscription_opt_number": first_present("OptNumber"),
        "contact_point_category_code": first_present("ContactCategory"),
        "contact_point_type_code": first_present("ContactPointType"),
    }


def _supplied(values: dict[str, Column]) -> Column:
    return F.filter(F.array(*[F.when(F.coalesce(kind(v) != "VOID", F.lit(False)), F.lit(k)) for k, v in values.items()]), lambda k: k.isNotNull())


def best_opt_matches(signatures: DataFrame, opt_map: DataFrame) -> DataFrame:
    """(_opt_sig, _opt_matched): for each (_opt_sig, program, five fields) of a known program, the fields in which the best
    opt row agrees; the best has the most, and of these comes first by its fields.

    Opt rows are indexed under every subset of their fields, 31 at most, and each subset of values keeps its first row
    only. A signature asks for the subsets of its own values, so the work is linear in opt rows and signatures whatever a
    program's size and however common a value is.
    """
    mpn = F.col("cdp_marketing_program_number").cast("string").alias("program")
    rows = opt_map.select(mpn, *[F.col(c).cast("string").alias(c) for c in OPT_MAP_FIELDS]).where("program is not null").distinct()
    some = F.explode(F.sequence(F.lit(1), F.lit(2 ** len(OPT_MAP_FIELDS) - 1))).alias("mask")
    in_mask = lambda n: F.col("mask").bitwiseAND(2**n) != 0
    complete = ~reduce(Column.__or__, (in_mask(n) & F.col(c).isNull() for n, c in enumerate(OPT_MAP_FIELDS)))
    asked = F.to_json(F.array("program", F.col("mask").cast("string"), *[F.when(in_mask(n), F.col(c)) for n, c in enumerate(OPT_MAP_FIELDS)])).alias("_asked")
    index = rows.select("*", some).where(complete).groupBy(asked).agg(F.min(F.struct(*OPT_MAP_FIELDS)).alias("row"))
    probes = signatures.select("*", some).where(complete).select("_opt_sig", "mask", asked)
    hits = adaptive_join(probes, index, ["_asked"], "inner")
    best = hits.groupBy("_opt_sig").agg(F.min(F.struct((-F.bit_count("mask")).alias("n"), "row", "mask")).alias("best"))
    known = adaptive_join(signatures, rows.select("program").distinct(), ["program"], "left_semi")
    fields = [F.when(F.col("best.mask").bitwiseAND(2**n) != 0, F.lit(c)) for n, c in enumerate(OPT_MAP_FIELDS)]
    return adaptive_join(known.select("_opt_sig"), best, ["_opt_sig"]).select("_opt_sig", F.filter(F.array(*fields), lambda k: k.isNotNull()).alias("_opt_matched"))


def with_opt_match(payloads: DataFrame, opt_map: DataFrame, how: str = "left") -> DataFrame:
    """Attach ``_opt_matched``: the fields in which the record agrees with the best opt row of its program; null where the
    rule doesn't apply or the program has no opt rows (``how`` inner leaves these rows out). Only distinct signatures meet
    the opt map; they are read in a pass of their own, and what they match is kept in the shared folder when this is built,
    so that its size is known and payloads are shuffled only where it is large."""
    values, mpn = _opt_values(), F.col("properties")[MPN]
    texts = [F.when(is_text(v), text(v)) for v in values.values()]
    signature = F.when(is_opt_change() & is_text(mpn) & (F.size(_supplied(values)) > 0), F.to_json(F.array(text(mpn), *texts)))
    keyed = once(payloads, _opt_sig=signature)
    names = ["program", *OPT_MAP_FIELDS]
    parts = F.from_json("_opt_sig", "array<string>")
    signatures = keyed.select("_opt_sig").where("_opt_sig is not null").distinct().select("_opt_sig", *[parts[n].alias(c) for n, c in enumerate(names)])
    return adaptive_join(keyed, kept(best_opt_matches(kept(signatures), opt_map)), ["_opt_sig"], how).drop("_opt_sig")


def vld7_failures(reported_at: Column) -> Column:
    """Supplied opt fields must all match one opt-map row; reports the best match, first one on ties."""
    props, values = F.col("properties"), _opt_values()
    supplied, matched = _supplied(values), F.col("_opt_matched")
    number = values["subscription_opt_number"]
    exempt = F.coalesce(text(props[MPN]) == UNIVERSAL_MPN, F.lit(False)) | F.coalesce(
        is_text(number) & (text(number) == UNIVERSAL_MPN), F.lit(False)
    )
    checked = is_opt_change() & (F.size(supplied) > 0) & ~exempt & matched.isNotNull()
    details = F.to_json(F.struct(matched.alias("matched_values"), F.array_except(supplied, matched).alias("unmatched_values")))
    row = failure("VLD7", DESCRIPTIONS["VLD7"], details, _last_ext_mpn(), reported_at)
    return listed(F.when(checked & (F.size(matched) < F.size(supplied)), row))


def vld7_opts_combination(payloads: DataFrame, opt_map: DataFrame, now: dt.datetime) -> DataFrame:
    return emit(with_plain_ids(with_opt_match(payloads, opt_map, "inner")), vld7_failures(F.lit(now)))


def vld8_failures(as_of: dt.date, reported_at: Column) -> Column:
    """Recent records (30 days) without a consumerId, or with one that embeds a timestamp."""
    day = dates.strict_date(F.when(is_text(root("timestamp")), root_text("timestamp")))
    recent = F.coalesce(day >= F.lit(as_of - dt.timedelta(days=30)), F.lit(False))
    entry, source = _first_plain("consumerId"), _first_plain("sourceId")
    synthetic = F.coalesce(entry["id"].rlike(dates.STAMP_IN_TEXT), F.lit(False))
    applies = recent & F.coalesce(F.size("_plain_ids") > 0, F.lit(False)) & (entry.isNull() | synthetic)
    details = F.when(source.isNotNull(), F.coalesce(source["id"], F.lit("None"))).otherwise(
        "Source Id Not Found In Payload")
    return listed(F.when(applies, failure("VLD8", DESCRIPTIONS["VLD8"], details, _last_ext_mpn(), reported_at)))


def vld8_consumer_id(payloads: DataFrame, as_of: dt.date, now: dt.datetime) -> DataFrame:
    return emit(with_plain_ids(payloads), vld8_failures(as_of, F.lit(now)))


def with_source_flag(payloads: DataFrame, source_map: DataFrame) -> DataFrame:
    """Attach ``_registered``: the record's (source, program) external ids are a row of ``source_map``. Reads ``with_plain_ids``."""
    known = source_map.select(
        F.col("source_id").cast("string").alias("_source"), F.col("mpn").cast("string").alias("_program")
    ).distinct().withColumn("_registered", F.lit(True))
    as_text = lambda entry: F.when(entry["textual"], entry["id"])
    keyed = once(payloads, _source=as_text(_first_plain("sourceId")), _program=as_text(_first_plain(MPN)))
    return adaptive_join(keyed, known, ["_source", "_program"]).drop("_source", "_program")


def vld9_failures(reported_at: Column) -> Column:
    source, program = _first_plain("sourceId")["id"], _first_plain(MPN)["id"]
    exempt = F.coalesce(_first_plain(MPN)["textual"] & (program == UNIVERSAL_MPN), F.lit(False))
    falsy = lambda name: F.element_at(F.transform(F.array(ext_id(name)), is_falsy), 1)  # noqa: E731  (names the id once)
    some = ~falsy("sourceId") | ~falsy(MPN)
    details = F.to_json(F.struct(source.alias("sourceId"), program.alias(MPN)), {"ignoreNullFields": "false"})
    row = failure("VLD9", DESCRIPTIONS["VLD9"], details, program, reported_at)
    return listed(F.when(F.col("_registered").isNull() & ~exempt & some, row))


def vld9_source_mpn(payloads: DataFrame, source_map: DataFrame, now: dt.datetime) -> DataFrame:
    return emit(with_source_flag(with_plain_ids(payloads), source_map), vld9_failures(F.lit(now)))


def vld10_failures(reported_at: Column) -> Column:
    no_original, no_timestamp = is_falsy(root("originalTimestamp")), is_falsy(root("timestamp"))
    details = F.when(no_original, "originalTimestamp Not Found").when(no_timestamp, "timestamp Not Found")
    row = failure("VLD10", DESCRIPTIONS["VLD10"], details, _last_ext_mpn(), reported_at)
    return listed(F.when(details.isNotNull(), row))


def vld10_timestamps(payloads: DataFrame, now: dt.datetime) -> DataFrame:
    return emit(with_plain_ids(payloads), vld10_failures(F.lit(now)))


# ---- chains --------------------------------------------------------------------------


def with_failures(payloads: DataFrame, opt_map: DataFrame, source_map: DataFrame, as_of: dt.date, now: dt.datetime) -> DataFrame:
    """Add ``failures``: the schema failures if there are any, else those of VLD7 to VLD10, in order."""
    at = F.lit(now)
    schema = F.concat(schema_string_failures(at), schema_external_id_failures(at), schema_property_failures(at))
    # Opt signatures are read first: that pass needs the parsed payload only.
    matched = with_plain_ids(with_opt_match(payloads, opt_map))
    staged = once(with_external_id_states(matched), _schema=schema).select(*matched.columns, "_schema")
    staged = with_source_flag(staged, source_map)
    rules = F.concat(vld7_failures(at), vld8_failures(as_of, at), vld9_failures(at), vld10_failures(at))
    first = F.when(F.size("_schema") > 0, F.col("_schema")).otherwise(rules)
    return once(staged, failures=first).drop("_schema", "_opt_matched", "_registered", *PLAIN)


def validation_chain(payloads, opt_map, source_map, as_of, now, stage=None) -> tuple[DataFrame, DataFrame]:
    """(passed payloads, failure rows) of all front-load rules; with a ``stage`` (see ``plans.staging``) payloads are parsed
    once, and the rules run once for both outputs; otherwise once for each."""
    stage = stage or (lambda df, name: df)
    return split_validated(stage(with_failures(stage(payloads, "payloads"), opt_map, source_map, as_of, now), "checked"))


def clean_insert(payloads: DataFrame, failures: DataFrame, key: str = "message_id") -> DataFrame:
    """Rows whose message id is not among the failures; NULL ids match nothing and stay."""
    bad = failures.select(F.col("message_id").alias(key)).dropna().distinct()
    return adaptive_join(payloads, bad, [key], "left_anti")


BATCH_RULES = {
    "vld2": _mpn_country, "vld3": _mpn_active, "vld4": _loyalty_alnum, "vld5": _opt_identity, "vld6": _universal_legal_entity,
}


def run_rule(rule_id: str, payloads: DataFrame, refs: dict[str, DataFrame], mpn: str, now: dt.datetime) -> DataFrame:
    """One batch rule by id: vld2 to vld6."""
    return batch_rules(payloads, refs, mpn, now, (rule_id,))


def batch_rules(payloads: DataFrame, refs: dict[str, DataFrame], mpn: str, now: dt.datetime,
                rules: tuple[str, ...] = ("vld2", "vld3", "vld5", "vld6")) -> DataFrame:
    """Failures of the batch rules, a payload's in order, in one pass; VLD4 is off by default."""
    for rule_id in rules:
        if rule_id not in BATCH_RULES:
            raise ValueError(f"unknown rule {rule_id!r}")
    return _batch(payloads, {rule_id.upper(): BATCH_RULES[rule_id]() for rule_id in rules}, refs.get("program"), mpn, now)
