"""Payload enrichment: one lazy ``payloads -> payloads`` function per rule.

All rules are JVM column expressions over the parsed payload frame; only the lookups of
``fill_external_ids``, ``universal_source_id`` and ``drop_duplicate_aliases`` join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.frames import once
from passerine.functions import dates
from passerine.functions.values import (
    VARIANT_MAP, empty_map, ext_append, ext_drop_first, ext_entry, ext_first, ext_id, ext_text, ext_type,
    from_traits_or_properties, has_key, has_root, is_blank, is_falsy, is_null_or_blank, is_text, kind, put, put_all,
    root, root_text, text, variant,
)
from passerine.operators.route import MPN, is_opt_change
from passerine.operators.skew import adaptive_join
from passerine.payload import canonical_json, to_document

# Date-like keys, sign-up events, channel prefixes and their codes, service names.
DATE_FIELDS = [
    "originalTimestamp", "timestamp", "postalConsumerChoiceDate", "socialConsumerChoiceDate",
    "emailConsumerChoiceDate", "phoneConsumerChoiceDate", "regulatoryConsumerChoiceDate",
]
SIGNUP_EVENTS = ["CRM Profile Email Signup", "Signed Up for Promotion", "Signed Up for Waitlist - CLT"]
FILLED_TYPES = ["email", "sourceId", MPN, "countryCode"]
CHANNELS = ["email", "postal", "phone", "social", "regulatory"]
CHANNEL_CODES = {
    "email": ("E", "EP"), "phone": ("P", "PM"), "postal": ("A", "AR"), "social": ("S", "OT"), "regulatory": ("R", "PS"),
}
SERVICE_NAMES = [f"{c}SubscriptionServiceName" for c in ("email", "phone", "postal", "social", "regulatory")]
UNIVERSAL_MPN = "9999"
UNIVERSAL_SERVICE = "Universal"


def _non_empty(mapping: str) -> Column:
    return F.coalesce(F.size(mapping) > 0, F.lit(False))


def _in_traits_else_properties(payloads: DataFrame, change, also=None) -> DataFrame:
    """Apply ``change`` to traits when they are not empty, otherwise to properties."""
    allowed = F.lit(True) if also is None else also
    return once(
        payloads,
        traits=F.when(_non_empty("traits"), change(F.col("traits"))).otherwise(F.col("traits")),
        properties=F.when(
            ~_non_empty("traits") & F.col("properties").isNotNull() & allowed, change(F.col("properties"))
        ).otherwise(F.col("properties")),
    )


def normalize_timestamps(payloads: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Date fields of traits (else properties) and both root timestamps in ISO-millis form.

    Decision: every field is handled on its own; text that cannot be parsed stays as it is.
    """
    names = fields or DATE_FIELDS
    fix = lambda v: F.when(is_text(v), variant(dates.normalized(text(v)))).otherwise(v)
    rewrite = lambda m: F.transform_values(m, lambda k, v: F.when(k.isin(*names), fix(v)).otherwise(v))
    touched = _non_empty("traits") | (F.col("properties").isNotNull() & has_root("timestamp"))
    roots = F.transform_values(
        "root", lambda k, v: F.when(k.isin("originalTimestamp", "timestamp"), fix(v)).otherwise(v)
    )
    with_roots = once(payloads, root=F.when(touched, roots).otherwise(F.col("root")))
    return _in_traits_else_properties(with_roots, rewrite, also=has_root("timestamp"))


def lowercase_opt_flags(payloads: DataFrame) -> DataFrame:
    """OptIndicator / OptNumber keys as lower-case text; JSON null becomes 'none'."""
    lowered = lambda v: variant(F.coalesce(F.lower(text(v)), F.lit("none")))
    wanted = lambda k: k.contains("OptIndicator") | k.contains("OptNumber")
    rewrite = lambda m: F.transform_values(m, lambda k, v: F.when(wanted(k), lowered(v)).otherwise(v))
    return _in_traits_else_properties(payloads, rewrite)


def drop_empty_ext_ids(payloads: DataFrame) -> DataFrame:
    """Remove empty objects from the external ids."""
    return once(payloads, ext_ids=F.filter("ext_ids", lambda x: F.size(x) > 0))


def fill_external_ids(payloads: DataFrame, lookups: DataFrame, country: str) -> DataFrame:
    """Complete email, sourceId, program and country external ids, in that order.

    A type that is missing, or whose id is null or blank (that entry is removed), is taken from
    traits, else properties (text only), else the user's lookup; country falls back to ``country``.
    ``payloads`` needs ``user_key``; ``lookups`` has one row per ``user_key``.
    """
    named = lookups.select(
        "user_key",
        F.col("email").alias("_l_email"), F.col("sourceId").alias("_l_sourceId"), F.col(MPN).alias(f"_l_{MPN}"),
    )
    out = drop_empty_ext_ids(adaptive_join(payloads, named, ["user_key"]))
    for name in FILLED_TYPES:
        entry = ext_first(name)
        blank = has_key(entry, "id") & is_null_or_blank(entry["id"])
        candidate = from_traits_or_properties(name)
        fallback = F.lit(country) if name == "countryCode" else F.col(f"_l_{name}").cast("string")
        value = F.when(is_text(candidate), text(candidate)).otherwise(fallback)
        wanted = (entry.isNull() | blank) & F.coalesce(value != "", F.lit(False))
        out = once(out, **{"_blank": blank, "_wanted": wanted, "_value": value})
        kept = ext_drop_first(F.col("ext_ids"), name, F.col("_blank"))
        out = once(out, ext_ids=ext_append(kept, ext_entry(name, variant(F.col("_value"))), F.col("_wanted")))
    return out.drop("_blank", "_wanted", "_value", "_l_email", "_l_sourceId", f"_l_{MPN}")


def _ext_filled(name: str) -> Column:
    """Text of the first external id of a type when it is not blank."""
    value = ext_text(name)
    return F.when(~is_blank(value), value)


def consumer_id(payloads: DataFrame, signup_events: list[str] | None = None) -> DataFrame:
    """Add a consumerId external id where none is usable.

    Copied from traits or properties; otherwise made from sha256(e-mail), else sha256(phone),
    followed by the source id or, without one, the original timestamp.  Nothing is made when an
    offlineConsumerId exists, when there are no external ids, or for a sign-up event that had no
    consumerId entry at all.
    """
    events = signup_events or SIGNUP_EVENTS
    entry = ext_first("consumerId")
    has_ids = F.coalesce(F.size("ext_ids") > 0, F.lit(False))
    blank = has_key(entry, "id") & is_null_or_blank(entry["id"])
    signup = F.coalesce(root_text("event").isin(*events), F.lit(False))
    copied = text(from_traits_or_properties("consumerId"))
    may_make = has_ids & (blank | (entry.isNull() & ~signup)) & from_traits_or_properties("offlineConsumerId").isNull()
    phone = F.coalesce(_ext_filled("phoneNumber"), text(from_traits_or_properties("phoneNumber")))
    digest = F.sha2(F.coalesce(_ext_filled("email"), phone), 256)
    suffix = F.coalesce(_ext_filled("sourceId"), root_text("originalTimestamp"))
    out = once(payloads, **{
        "_blank": has_ids & blank, "_open": entry.isNull() | blank, "_copied": copied, "_may": may_make,
        "_digest": digest, "_suffix": suffix,
    })
    stuck = F.col("_copied").isNull() & F.col("_may") & F.col("_digest").isNotNull() & F.col("_suffix").isNull()
    made = F.when(F.col("_may"), F.concat("_digest", "_suffix"))
    out = once(out, **{"_value": F.coalesce(F.col("_copied"), made), "_stuck": stuck})
    kept = ext_drop_first(F.col("ext_ids"), "consumerId", F.col("_blank") & ~F.col("_stuck"))
    grown = ext_append(
        kept, ext_entry("consumerId", variant(F.col("_value"))), F.col("_open") & F.col("_value").isNotNull()
    )
    return out.withColumn("ext_ids", grown).drop(
        "_blank", "_open", "_copied", "_may", "_digest", "_suffix", "_value", "_stuck"
    )


def fix_consumer_id(payloads: DataFrame, signup_events: list[str] | None = None) -> DataFrame:
    """Drop a consumerId that embeds a timestamp; rebuild it as sha256(e-mail) + original timestamp.

    Not rebuilt for sign-up events that carried one, nor when an offlineConsumerId exists.
    """
    events = signup_events or SIGNUP_EVENTS
    entry = ext_first("consumerId")
    synthetic = F.coalesce(text(entry["id"]).rlike(dates.STAMP_IN_TEXT), F.lit(False))
    signup = F.coalesce(root_text("event").isin(*events), F.lit(False))
    offline = ~is_falsy(F.col("traits")["offlineConsumerId"]) | ~is_falsy(F.col("properties")["offlineConsumerId"])
    rebuild = (entry.isNull() | (synthetic & ~signup)) & ~offline & F.coalesce(F.size("ext_ids") > 0, F.lit(False))
    value = F.concat(F.sha2(ext_text("email"), 256), root_text("originalTimestamp"))
    out = once(payloads, **{"_drop": synthetic, "_make": rebuild & value.isNotNull(), "_value": value})
    kept = ext_drop_first(F.col("ext_ids"), "consumerId", F.col("_drop"))
    grown = ext_append(kept, ext_entry("consumerId", variant(F.col("_value"))), F.col("_make"))
    return out.withColumn("ext_ids", grown).drop("_drop", "_make", "_value")


def email_external_id(payloads: DataFrame, kind_name: str, domain: str) -> DataFrame:
    """Append an e-mail external id: traits (``registration`` only), properties, else md5(payload)@domain.

    Decision: the digest is over the canonical (key-sorted, compact) JSON of the payload.
    """
    given = lambda block: F.when(~is_falsy(F.col(block)["email"]), F.col(block)["email"])
    sources = [given("traits"), given("properties")] if kind_name == "registration" else [given("properties")]
    made = variant(F.concat(F.md5(canonical_json(to_document())), F.lit(domain)))
    out = once(payloads, _value=F.coalesce(*sources, made))
    entry = ext_entry("email", F.col("_value"))
    return out.withColumn("ext_ids", ext_append(F.col("ext_ids"), entry, F.col("ext_ids").isNotNull())).drop("_value")


def mpn_external_id(payloads: DataFrame) -> DataFrame:
    """Program external id from traits, else properties; an existing entry is replaced."""
    given = lambda block: F.when(~is_falsy(F.col(block)[MPN]), F.col(block)[MPN])
    out = once(payloads, _value=F.coalesce(given("traits"), given("properties")))
    found = F.col("_value").isNotNull()
    kept = ext_drop_first(F.col("ext_ids"), MPN, found & ext_first(MPN).isNotNull())
    return out.withColumn("ext_ids", ext_append(kept, ext_entry(MPN, F.col("_value")), found)).drop("_value")


def last_activity_date(payloads: DataFrame) -> DataFrame:
    """identify records without lastActivityDate get originalTimestamp and lose their score traits.

    JSON-null traits become ``{lastActivityDate}``.  Decision: a record without
    originalTimestamp is left unchanged.
    """
    stamp = root("originalTimestamp")
    known = has_root("originalTimestamp")
    missing = (root_text("type") == "identify") & F.col("traits").isNotNull() & ~has_key(F.col("traits"), "lastActivityDate")
    unscored = F.map_filter("traits", lambda k, _: ~k.contains("score"))
    null_traits = F.coalesce(F.is_variant_null(root("traits")), F.lit(False))
    single = F.create_map(F.lit("lastActivityDate"), stamp)
    return payloads.withColumn(
        "traits",
        F.when(known & missing, put(unscored, "lastActivityDate", stamp))
        .when(known & null_traits & F.col("traits").isNull(), single)
        .otherwise(F.col("traits")),
    )


def nesting_depth(json: Column) -> Column:
    """Deepest bracket level of a JSON text, string contents ignored."""
    bare = F.regexp_replace(json, r'"(\\.|[^"\\])*"', "")
    marks = F.split(F.regexp_replace(bare, r"[^\[\]{}]", ""), "")
    start = F.struct(F.lit(0).alias("d"), F.lit(0).alias("m"))

    def step(acc, mark):
        depth = acc["d"] + F.when(mark.isin("[", "{"), 1).when(mark.isin("]", "}"), -1).otherwise(0)
        return F.struct(depth.alias("d"), F.greatest(acc["m"], depth).alias("m"))

    return F.aggregate(marks, start, step)["m"]


def leaf_entries(value: Column, base: Column, object_name, array_name, skip_null_members: bool) -> Column:
    """Scalars of a nested variant as array<struct<path,value>>, any depth, without a join or UDF.

    Each round opens one level; the number of rounds is the nesting depth of the row's own value.
    """
    def children(entry):
        v = entry["value"]
        members = F.map_entries(F.try_variant_get(v, "$", VARIANT_MAP))
        if skip_null_members:
            members = F.filter(members, lambda m: ~F.is_variant_null(m["value"]))
        named = F.transform(members, lambda m: _leaf(object_name(entry["path"], m["key"]), m["value"]))
        items = F.transform(
            F.try_variant_get(v, "$", "array<variant>"), lambda x, i: _leaf(array_name(entry["path"], i), x)
        )
        return (
            F.when(kind(v).startswith("OBJECT"), named).when(kind(v).startswith("ARRAY"), items).otherwise(F.array(entry))
        )

    rounds = F.sequence(F.lit(1), F.greatest(nesting_depth(F.to_json(value)), F.lit(1)))
    start = F.array(_leaf(base, value))
    return F.aggregate(rounds, start, lambda acc, _: F.flatten(F.transform(acc, children)))


def _leaf(path: Column, value: Column) -> Column:
    return F.struct(path.cast("string").alias("path"), value.alias("value"))


def flatten_dependents(payloads: DataFrame) -> DataFrame:
    """Nested ``traits.dependents`` as flat traits: ``dependent`` + CapitalisedKey / 1-based index.

    Null members of objects are skipped; the nested original stays.
    """
    nested = F.col("traits")["dependents"]
    leaves = leaf_entries(
        nested,
        F.lit("dependent"),
        lambda path, key: F.concat(path, F.upper(F.substring(key, 1, 1)), F.substring(key, 2, 2**30)),
        lambda path, i: F.concat(path, (i + 1).cast("string")),
        skip_null_members=True,
    )
    wanted = (root_text("type") == "identify") & has_key(F.col("traits"), "dependents")
    flat = F.map_from_entries(F.transform("_leaves", lambda e: F.struct(e["path"], e["value"])))
    out = once(once(payloads, _leaves=F.when(wanted, leaves)), _flat=flat)
    grown = F.when(F.col("_flat").isNotNull(), put_all(F.col("traits"), F.col("_flat"))).otherwise(F.col("traits"))
    return once(out, traits=grown).drop("_leaves", "_flat")


def _valid_channel(channel: str, props: Column, email: Column) -> Column:
    """Validity of one opt channel; ``email`` is the shared e-mail truth value."""
    given = lambda name: ~is_falsy(props[name])
    date = given(f"{channel}ConsumerChoiceDate")
    number = given(f"{channel}SubscriptionOptNumber")
    choice = given(f"{channel}SubscriptionOptIndicator") | given(f"{channel}SubscriptionServiceName")
    typed = given(f"{channel}ContactType") & given(f"{channel}ContactCategory")
    by_choice = date & ~number & choice
    if channel == "phone":
        return given("phoneNumber") & (date & typed | by_choice)
    if channel == "postal":
        return (number & date & typed) | by_choice
    return email & (date & typed | by_choice)


def split_channels(payloads: DataFrame) -> DataFrame:
    """One opt-change record per valid channel: its own keys plus the common keys.

    With several valid channels the message ids get ``-split1..n`` in channel order; without any
    the record stays as it is.
    """
    props = F.col("properties")
    email_value = F.col("properties")["email"]
    has_email = ~is_falsy(email_value)
    in_channel = lambda k: k.rlike("^(" + "|".join(CHANNELS) + ")")
    common = F.map_filter(props, lambda k, _: ~in_channel(k))
    options = []
    for channel in CHANNELS:
        own = F.map_filter(props, lambda k, _: k.startswith(channel))
        if channel in ("postal", "social", "regulatory"):
            own = F.when(has_email, put(own, "email", email_value)).otherwise(own)
        valid = _valid_channel(channel, props, has_email)
        options.append(F.when(valid, own))
    applies = is_opt_change() & props.isNotNull() & has_root("messageId")
    parts = F.when(applies, F.filter(F.array(*options), lambda m: m.isNotNull()))
    out = once(payloads, **{"_parts": parts, "_common": F.when(applies, common)}).withColumn(
        "_n", F.coalesce(F.size("_parts"), F.lit(0))
    )
    keep = [c for c in payloads.columns if c not in ("root", "properties")]
    out = out.select(*keep, "root", "properties", "_common", "_n", F.posexplode_outer(
        F.when(F.col("_n") > 0, F.col("_parts"))
    ).alias("_i", "_own"))
    new_id = F.concat(root_text("messageId"), F.lit("-split"), (F.col("_i") + 1).cast("string"))
    out = once(out, **{
        "root": F.when(F.col("_n") > 1, put(F.col("root"), "messageId", variant(new_id))).otherwise(F.col("root")),
        "properties": F.when(F.col("_own").isNotNull(), put_all(F.col("_own"), F.col("_common"))).otherwise(F.col("properties")),
    })
    return out.select(*payloads.columns)


def contact_indicator(payloads: DataFrame) -> DataFrame:
    """With exactly one SubscriptionOptIndicator property: its channel's contactType and contactCategory."""
    keys = F.filter(F.map_keys("properties"), lambda k: k.contains("SubscriptionOptIndicator"))
    only = F.when(F.size(keys) == 1, F.get(keys, F.lit(0)))
    code = category = F.lit(None).cast("string")
    for channel, (letter, group) in CHANNEL_CODES.items():
        hit = only.startswith(f"{channel}SubscriptionOptIndicator")
        code = F.when(hit, letter).otherwise(code)
        category = F.when(hit, group).otherwise(category)
    out = once(payloads, **{"_code": code, "_category": category})
    grown = put(
        put(F.col("properties"), "contactType", variant(F.col("_code"))), "contactCategory", variant(F.col("_category"))
    )
    return once(out, properties=F.when(F.col("_code").isNotNull(), grown).otherwise(F.col("properties"))).drop("_code", "_category")


def ids_into_traits(payloads: DataFrame) -> DataFrame:
    """Copy anonymousId and userId into traits, or into properties when there are no traits."""
    out = payloads
    null_traits = F.coalesce(F.is_variant_null(root("traits")), F.lit(False)) & F.col("traits").isNull()
    for key in ("anonymousId", "userId"):
        value = root(key)
        to_traits = _non_empty("traits") | null_traits
        base = F.coalesce(F.col("traits"), empty_map())
        out = once(out, **{
            "traits": F.when(has_root(key) & to_traits, put(base, key, value)).otherwise(F.col("traits")),
            "properties": F.when(
                has_root(key) & ~to_traits & F.col("properties").isNotNull(), put(F.col("properties"), key, value)
            ).otherwise(F.col("properties")),
        })
    return out


def mpn_to_string(payloads: DataFrame) -> DataFrame:
    """Program number of traits, else of properties, as text."""
    in_traits = ~is_falsy(F.col("traits")[MPN])
    in_props = ~in_traits & ~is_falsy(F.col("properties")[MPN])
    as_text = lambda block: put(F.col(block), MPN, variant(text(F.col(block)[MPN])))
    return once(payloads, **{
        "traits": F.when(in_traits, as_text("traits")).otherwise(F.col("traits")),
        "properties": F.when(in_props, as_text("properties")).otherwise(F.col("properties")),
    })


def external_mpn_to_string(payloads: DataFrame) -> DataFrame:
    """Program external ids as text; a JSON null stays null."""
    def fix(item):
        value = item["id"]
        change = (ext_type(item) == MPN) & ~is_text(value) & text(value).isNotNull()
        return F.when(change, put(item, "id", variant(text(value)))).otherwise(item)

    return once(payloads, ext_ids=F.transform("ext_ids", fix))


def drop_empty_traits(payloads: DataFrame) -> DataFrame:
    """Drop null and empty-text traits; whitespace is kept except for ``stdAddress``.

    Decision: fractional numbers are values, not empties, and are kept.
    """
    def keep(key, value):
        txt = text(value)
        as_text = F.when(key == "stdAddress", ~is_blank(txt)).otherwise(txt != "")
        return F.when(kind(value) == "STRING", as_text).otherwise(~F.is_variant_null(value))

    return once(payloads, traits=F.map_filter("traits", keep))


#: Alias pairs of which both names occur in the payloads, at most; more is an error.
MAX_ALIAS_PAIRS = 2000


def drop_duplicate_aliases(payloads: DataFrame, aliases: DataFrame, most: int = MAX_ALIAS_PAIRS) -> DataFrame:
    """Delete an alias trait whose value equals its canonical trait's value.

    ``aliases`` is reference data (traitName, alias) of any size. The distinct trait names of the payloads pick the pairs
    that can occur; these few, ``most`` at most, become a lookup in each row, so payloads are neither joined nor shuffled.
    The names are read in a pass of their own, when the operator is built.
    """
    pairs = aliases.filter(F.col("traitName") != F.col("alias")).select("traitName", "alias").distinct()
    names = payloads.select(F.explode(F.map_keys("traits")).alias("alias")).distinct()
    known = adaptive_join(adaptive_join(pairs, names, ["alias"], "left_semi"), names.withColumnRenamed("alias", "traitName"), ["traitName"], "left_semi")
    found = known.take(most + 1)
    if len(found) > most:
        raise ValueError(f"more than {most} alias pairs occur in the payloads")
    if not found:
        return payloads
    canonical: dict[str, list[str]] = {}
    for row in found:
        canonical.setdefault(row.alias, []).append(row.traitName)
    lookup = F.create_map(*[x for alias, of in canonical.items() for x in (F.lit(alias), F.array(*map(F.lit, of)))])
    traits = F.col("traits")
    same = lambda k, v: F.exists(lookup[k], lambda name: F.to_json(traits[name]) == F.to_json(v))
    kept = F.map_filter("traits", lambda k, v: ~F.coalesce(F.map_contains_key(lookup, k) & same(k, v), F.lit(False)))
    return once(payloads, traits=kept)


def legal_entity(payloads: DataFrame, code: str) -> DataFrame:
    """legalEntityNumber on opt-change tracks of the universal program or with a Universal service."""
    universal = F.coalesce(is_text(ext_id(MPN)) & (ext_text(MPN) == UNIVERSAL_MPN), F.lit(False))
    service = F.lit(False)
    for name in SERVICE_NAMES:
        service = service | F.coalesce(text(F.col("properties")[name]) == UNIVERSAL_SERVICE, F.lit(False))
    applies = (
        F.coalesce(root_text("type") == "track", F.lit(False)) & is_opt_change()
        & F.coalesce(F.size("ext_ids") > 0, F.lit(False)) & _non_empty("properties") & (universal | service)
    )
    grown = put(F.col("properties"), "legalEntityNumber", variant(F.lit(code)))
    return once(payloads, properties=F.when(applies, grown).otherwise(F.col("properties")))


def universal_source_id(payloads: DataFrame, segment_sources: DataFrame, opt_out_id: str = "1174") -> DataFrame:
    """Source id of universal-program records with an OptIndicator property.

    Any opt-out (track with 'false') sets every sourceId entry, or adds one, to ``opt_out_id``.
    Otherwise an opt-in or identify without a sourceId takes the protocol source's mapped id.
    Decision: a protocol source without a mapping changes nothing.
    """
    last_mpn = F.element_at(F.filter("ext_ids", lambda x: ext_type(x) == MPN), -1)["id"]
    universal = F.when(F.size(F.filter("ext_ids", lambda x: ext_type(x) == MPN)) > 0, is_text(last_mpn) & (text(last_mpn) == UNIVERSAL_MPN))
    flags = F.map_filter("properties", lambda k, _: k.contains("OptIndicator"))
    said = lambda word: F.exists(F.map_values(flags), lambda v: is_text(v) & (text(v) == word))
    track = root_text("type") == "track"
    opt_out = F.coalesce(universal & track & said("false"), F.lit(False))
    opt_in = F.coalesce(
        universal & (F.size(flags) > 0) & ((track & said("true")) | (root_text("type") == "identify")), F.lit(False)
    ) & ~opt_out & ext_first("sourceId").isNull()
    protocol = F.try_variant_get(F.col("context")["protocols"], "$.sourceId", "string")
    mapping = segment_sources.groupBy("segment_source_id").agg(F.max("pg_data_source_id").alias("_mapped"))
    out = once(payloads, **{"_out": opt_out, "segment_source_id": F.when(opt_in, protocol)})
    out = adaptive_join(out, mapping, ["segment_source_id"])
    fixed = F.transform(
        "ext_ids",
        lambda x: F.when(ext_type(x) == "sourceId", put(x, "id", variant(F.lit(opt_out_id)))).otherwise(x),
    )
    swapped = F.when(F.col("_out"), fixed).otherwise(F.col("ext_ids"))
    add_out = F.col("_out") & ext_first("sourceId").isNull()
    new_id = F.when(F.col("_out"), F.lit(opt_out_id)).otherwise(F.col("_mapped").cast("string"))
    out = out.withColumn(
        "ext_ids", ext_append(swapped, ext_entry("sourceId", variant(new_id)), add_out | F.col("_mapped").isNotNull())
    )
    return out.select(*payloads.columns)


def choice_date(payloads: DataFrame) -> DataFrame:
    """Every ChoiceDate property := the record's timestamp."""
    out = once(payloads, _stamp=root("timestamp"))
    rewrite = F.transform_values("properties", lambda k, v: F.when(k.contains("ChoiceDate"), F.col("_stamp")).otherwise(v))
    return once(out, properties=F.when(has_root("timestamp"), rewrite).otherwise(F.col("properties"))).drop("_stamp")


def external_ids_to_traits(payloads: DataFrame) -> DataFrame:
    """Fill falsy program, country and source traits from the external ids."""
    out = payloads
    for key in (MPN, "countryCode", "sourceId"):
        entry = ext_first(key)
        fill = _non_empty("traits") & is_falsy(F.col("traits")[key]) & F.coalesce(F.size(entry) > 0, F.lit(False))
        value = F.coalesce(entry["id"], F.parse_json(F.lit("null")))
        out = once(out, traits=F.when(fill, put(F.col("traits"), key, value)).otherwise(F.col("traits")))
    return out


def person_key(df: DataFrame, default_mpn: str) -> DataFrame:
    """Add ``consumerid_sourceid_mpn``: consumer id, else offline id, else sha256(e-mail or phone); source; program.

    Decision: blank ids count as missing, and one form of the hash is used everywhere.
    """
    filled = lambda c: F.when(F.trim(c) != "", F.trim(c))
    person = F.coalesce(
        filled("consumerId"), filled("offlineConsumerId"), F.sha2(F.coalesce("email", "phoneNumber"), 256)
    )
    key = F.concat(person, F.lit("_"), F.col("sourceId").cast("string"), F.lit("_"), F.coalesce(MPN, F.lit(default_mpn)))
    return df.withColumn("consumerid_sourceid_mpn", key)
