"""Reconciliation and readiness reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passerine.operators.aggregates import having_filters, match_rate, min_max_count, non_blank_counts, string_agg_distinct
from passerine.operators.joins import (
    anti_by_null_check, not_in_antijoin, normalized_name_join, opts_null_tolerant_join, opts_strict_join, seg_vs_cdp_join,
    trait_suggest_like,
)
from passerine.operators.reshape import pivot_ecosystems, unpivot_traits
from passerine.operators.route import with_opt_signature
from passerine.operators.windows import report_order
from passerine.sources.readers import column_names

# Columns that are never traits or event properties, mandatory fields, ecosystems.
SKIPPED_LIKE = ["context_%", "score_%", "%_trait_number", "%_last_update%", "%hypercare%"]
SKIPPED_COLUMNS = [
    "id", "anonymous_id", "loaded_at", "migration_flag", "original_timestamp", "received_at", "sent_at", "timestamp", "user_id",
    "migration_file_type", "migration_source_id", "janrain_clients", "transmitter_source_id", "uuid_ts",
]
SKIPPED_EVENT_LIKE = ["context_%", "score_%", "%trait_number", "%last_update%", "%hypercare_%"]
SKIPPED_EVENT_COLUMNS = [
    "id", "anonymous_id", "loaded_at", "migration_flag", "original_timestamp", "received_at", "sent_at", "timestamp", "user_id",
    "migration_file_type", "migration_source_id", "uuid_ts",
]
MANDATORY_FIELDS = [
    "consumer_id", "consumerId", "marketing_program_number", "marketingProgramNumber", "countrycode", "countryCode", "country_code",
    "source_id", "sourceId", "last_activity_date", "lastActivityDate", "marketingProgram", "consumerID", "primaryAddress.country",
    "lastUpdated", "marketingProgramNbr", "sourceID", "traitcountryCodeIdValue", "traitsourceIdIdValue", "traitSourceIdIdValue",
    "traitSourceId.traitValue", "traitconsumerIdIdValue", "traitConsumerIdIdValue", "traitConsumerId.traitValue",
    "traitCountryCodeIdValue", "traitlastActivityDateIdValue", "traitLastActivityDateIdValue", "traitLastActivityDate.traitValue",
    "traitmarketingProgramIdValue", "traitMarketingProgramIdValue", "traitMarketingProgram.traitValue",
]


def trait_comparison(source: DataFrame, id_graph: DataFrame, target: DataFrame, key: str = "user_id", exclude: list[str] | None = None) -> dict[str, DataFrame]:
    """Source traits beside target traits: ``rows`` and the mismatch ``rates`` per trait name.

    Persons with exactly one source user are compared.
    """
    long = unpivot_traits(source, key, exclude).withColumnRenamed(key, "user_id")
    users = id_graph.filter(F.col("id_type") == "userId").select(F.col("id_value").alias("user_id"), "pg_id").distinct()
    single = having_filters(users, ["pg_id"], {"user_id": F.max("user_id"), "_n": F.count("user_id")}, F.col("_n") < 2).drop("_n")
    rows = seg_vs_cdp_join(long, single, target)
    rates = report_order(match_rate(rows, "trait_name"), [F.col("un_match_percent").desc(), F.col("match_count").desc(), F.col("trait_name")])
    return {"rows": rows, "rates": rates}


def ecosystem_names(eco: DataFrame, trait_map: DataFrame, mpns: list, systems: dict[int, str]) -> DataFrame:
    """Trait names per ecosystem for the given programs; the greatest name is chosen."""
    mapped = trait_map.filter(F.col("marketingProgramId").isin(*mpns)).select("traitId").distinct()
    rows = eco.filter(F.col("ecoSystemId").isin(*systems)).join(mapped, "traitId", "left_semi")
    return rows.groupBy("traitId").agg(*[F.max(F.when(F.col("ecoSystemId") == n, F.col("ecoTraitName"))).alias(name) for n, name in systems.items()])


def report_traits(identifies: DataFrame, trait_map: DataFrame, aliases: DataFrame, ts: str, mpn: str = "marketing_program_number",
                  skip: list[str] | None = None) -> DataFrame:
    """Columns of the identify table that are no valid traits of a program, with suggestions and counts.

    Columns named by an alias and opt columns are left out; only columns with values are reported.
    """
    names = column_names(identifies, SKIPPED_LIKE, SKIPPED_COLUMNS + (skip or []))
    mpns = identifies.select(F.col(mpn).cast("string").alias("mpn")).filter(F.trim("mpn") != "").distinct()
    grid = trait_suggest_like(names, mpns, trait_map).filter(~F.col("validation_result"))
    keys = ["mpn", "column_name", "validation_result", "trait_match", "ecoTraitName", "traitName", "traitId"]
    suggested = ["suggested_traitName", "suggested_traitId", "suggested_ecoTraitName"]
    joined = string_agg_distinct(grid, keys, suggested, " | ", ~F.col("trait_match"))
    named = anti_by_null_check(joined, aliases.select(F.col("alias").alias("column_name")), ["column_name"])
    opt_column = (F.col("column_name").like("%_opt_indicator") | F.col("column_name").like("%_opt_choice_date")) & ~F.col(
        "column_name").like("%subscription%") & ~F.col("column_name").like("trait%")
    flagged = named.filter(~opt_column).withColumn("mandatory_field", F.col("column_name").isin(*MANDATORY_FIELDS))
    counts = non_blank_counts(identifies.withColumn(mpn, F.col(mpn).cast("string")), names, ts, [mpn]).withColumnRenamed(mpn, "mpn")
    out = flagged.join(counts, ["mpn", "column_name"]).filter(F.col("overall_counts") > 0)
    return out.select("mpn", "column_name", "trait_match", "mandatory_field", "ecoTraitName", "traitName", "traitId", *suggested,
                      "overall_counts", "non_blank_counts", "latest")


def report_event_properties(tables: dict[str, DataFrame], catalogue: DataFrame, ts: str) -> DataFrame:
    """Columns of event tables the property catalogue does not know, with value counts above zero.

    Known names are all property names plus the event's own aliases.  Each table is scanned once.
    """
    out = None
    for event, table in tables.items():
        names = column_names(table, SKIPPED_EVENT_LIKE, SKIPPED_EVENT_COLUMNS)
        counts = non_blank_counts(table, names, ts).select("column_name", F.col("overall_counts").alias("count"))
        latest = table.agg(F.max(ts).alias("latest_event"))
        known = catalogue.select(F.col("propertyName").alias("name")).unionByName(
            catalogue.filter(F.col("eventName") == event).select(F.col("propertyNameAlias").alias("name"))).dropna().distinct()
        checked = normalized_name_join(counts, "column_name", known, "name").filter(~F.col("validation_result"))
        part = checked.filter(F.col("count") > 0).select(
            F.lit(event).alias("event"), "column_name", "count", latest.scalar().alias("latest_event"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def report_events(tracks: DataFrame, events_ref: DataFrame, event: str, ts: str) -> DataFrame:
    """Events that occur but are neither a catalogue name nor an alias, with their counts."""
    seen = min_max_count(tracks, [event], ts)
    alias = F.explode(F.split("eventNameAlias", r"\|"))
    aliases = events_ref.select(alias.alias("name")).filter((F.length("name") > 1) & (F.col("name") != "NULL"))
    names = events_ref.select(F.col("eventName").alias("name")).unionByName(aliases).distinct()
    return normalized_name_join(seen, event, names, "name", keep_spaces=True).filter(~F.col("validation_result")).drop("name", "validation_result")


def report_mpn(identifies: DataFrame, known: DataFrame, column: str = "marketing_program_number") -> DataFrame:
    """Program numbers in use that are not known."""
    return not_in_antijoin(identifies, column, known).withColumn("validation_result", F.lit("false"))


def report_sources(identifies: DataFrame, programs: DataFrame, sources: DataFrame, source_map: DataFrame) -> DataFrame:
    """(program, source) pairs in use, both known, that are not registered together."""
    pairs = identifies.groupBy("marketing_program_number", "source_id").agg(
        F.max("registration_date").alias("registration_date"), F.max("received_at").alias("latest_event"), F.count(F.lit(1)).alias("counts"))
    text = lambda df, c, n: df.select(F.col(c).cast("string").alias(n)).distinct()
    used = pairs.withColumn("marketing_program_number", F.col("marketing_program_number").cast("string")).withColumn("source_id", F.col("source_id").cast("string"))
    used = used.join(text(programs, "mpn", "marketing_program_number"), "marketing_program_number", "left_semi")
    used = used.join(text(sources, "source_id", "source_id"), "source_id", "left_semi")
    registered = source_map.select(F.col("mpn").cast("string").alias("marketing_program_number"), F.col("source_id").cast("string").alias("source_id"))
    return anti_by_null_check(used, registered, ["marketing_program_number", "source_id"])


SIGNATURE = ["subscription_opt_number", "service_name", "opt_type", "contact_point_type_code"]


def report_opts(opts: DataFrame, opt_map: DataFrame, ts: str, persona: str, mpns: list[str]) -> DataFrame:
    """Opt signatures with validity (a null opt id matches any), first and last use and count."""
    sigs = min_max_count(with_opt_signature(opts), ["opt_id", *SIGNATURE], ts)
    wanted = sigs.filter((F.col("subscription_opt_number") != "9999") & (F.col("service_name") != "Universal"))
    valid = opt_map.filter(F.col("cdp_marketing_program_number").cast("string").isin(*mpns))
    out = opts_null_tolerant_join(wanted, valid).withColumn("persona_name", F.lit(persona))
    return report_order(out, [F.col("counts").desc()])


def report_opts_strict(opts: DataFrame, opt_map: DataFrame, ts: str, persona: str, mpn: str) -> DataFrame:
    """Opt signatures with validity by plain equality, latest use, and the count of number and service."""
    signed = with_opt_signature(opts, default="NONE")
    sigs = signed.groupBy(*SIGNATURE).agg(F.max(ts).alias("latest_date"))
    counts = signed.groupBy("subscription_opt_number", "service_name").agg(F.count(F.lit(1)).alias("counts"))
    valid = opt_map.filter(F.col("cdp_marketing_program_number").cast("string") == mpn)
    return opts_strict_join(sigs.filter(F.col("subscription_opt_number") != "9999"), valid, counts).withColumn("persona_name", F.lit(persona))


def report_ecosystem_traits(trait_map: DataFrame, programs: DataFrame, ecosystems: DataFrame, eco: DataFrame, mpns: list, columns: list[str],
                            rename: dict[str, str] | None = None) -> DataFrame:
    """Traits of the programs with one column per ecosystem; ``rename`` maps ecosystem names to column names."""
    rows = trait_map.filter(F.col("marketingProgramId").isin(*mpns))
    rows = rows.join(programs, "marketingProgramId", "left").join(ecosystems, "ecoSystemId", "left")
    rows = rows.join(eco.select("traitId", "ecoSystemId", "traitName", "ecoTraitName"), ["traitId", "ecoSystemId"], "left")
    name = F.col("ecoSystemName")
    for old, new in (rename or {}).items():
        name = F.when(F.col("ecoSystemName") == old, new).otherwise(name)
    keys = ["marketingProgramId", "marketingProgramName", "traitId", "traitName"]
    wide = pivot_ecosystems(rows.withColumn("ecoSystemName", name), keys, columns)
    return report_order(wide, [F.col("marketingProgramName"), F.col("traitName")])
