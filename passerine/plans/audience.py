"""Retention, audience bases and audience counts of both sides of a migration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.functions.values import ERASED
from passerine.operators.aggregates import any_non_null_pivot, count_distinct_union, last_non_null, nested_best_value
from passerine.operators.joins import anti_by_null_check, canonical_user, latest_alias
from passerine.operators.skew import adaptive_join
from passerine.operators.windows import latest_opt_per_service

CONTACT_FIELDS = ["email", "phone_number", "address_line1", "address_line2", "address_line3"]


def retention_out_users(identifies: DataFrame, order: list[str], fields: list[str] | None = None) -> DataFrame:
    """Users whose latest non-null e-mail, phone and address lines are all the erased marker.

    ``order`` ranks rows by time and ends in a tie-break.  Computed-audience rows are ignored.
    """
    names = fields or CONTACT_FIELDS
    rows = identifies.filter(F.col("context_personas_computation_class").isNull())
    latest = last_non_null(rows, ["user_id"], names, order)
    erased = F.lit(True)
    for name in names:
        erased = erased & (F.col(name).cast("string") == ERASED)
    return latest.filter(erased).select("user_id")


BASE_ATTRIBUTES = ["registration_date", "email_valid_contact_point_indicator", "email", "gender", "source_id"]


def _loaded(rows: DataFrame, to: dt.date | None) -> DataFrame:
    return rows if to is None else rows.filter(F.col("loaded_at").cast("date") <= F.lit(to))


def segment_dump(
    users: DataFrame,
    merges: dict[str, DataFrame],
    retention: DataFrame,
    mpn: str,
    country: str,
    flags: list[str],
    extra: list[str] | None = None,
    opts: DataFrame | None = None,
    service_flags: dict[str, str] | None = None,
    exclude_sources: list[str] | None = None,
    order: list[str] | None = None,
    opt_order: list[str] | None = None,
    programs: list[str] | None = None,
    loaded_to: dt.date | None = None,
) -> DataFrame:
    """Source-side audience base: one row per (country, resolved user).

    Program variants: ``extra`` adds attribute columns; ``exclude_sources`` drops source ids;
    ``opts`` with ``service_flags`` (flag -> service name) takes the flags from the newest opt per
    service instead, where a universal opt row opts out of all services.  A user row counts for
    the program when it has a contact-point indicator or carries the program number.  ``programs``
    limits the merge lists to these programs, ``loaded_to`` the user rows to those loaded by that day.
    """
    order = order or ["loaded_at", "id"]
    users = _loaded(users, loaded_to)
    rows = users.filter(
        F.col("email_valid_contact_point_indicator").isNotNull() | (F.col("marketing_program_number") == mpn)
    )
    if exclude_sources:
        rows = rows.filter(~F.col("source_id").isin(*exclude_sources))
    rows = canonical_user(rows, merges["email"], merges["user"], merges["unmerge"], merges["canonical"], programs)
    rows = rows.withColumn("country", F.coalesce("country_code", F.lit(country)))
    keys = ["country", "user_id"]
    from_users = [f for f in flags if not (service_flags and f in service_flags)]
    attributes = [*BASE_ATTRIBUTES, *from_users, *(extra or [])]
    base = last_non_null(rows, keys, attributes, order)
    if opts is not None and service_flags:
        base = adaptive_join(base, _service_flags(rows, opts, service_flags, opt_order or ["ts", "loaded_at"]), keys)
    out = anti_by_null_check(base, retention, ["user_id"])
    return out.withColumn("email", F.lower("email"))


def _service_flags(rows: DataFrame, opts: DataFrame, service_flags: dict[str, str], order: list[str]) -> DataFrame:
    newest = latest_opt_per_service(
        opts.select("user_id", "service_name", "opt_indicator", *order), [F.col(c).desc() for c in order]
    )
    wide = newest.withColumnRenamed("user_id", "id")
    joined = adaptive_join(rows.select("country", "user_id", "id"), wide, ["id"], "inner")
    universal = F.lower("service_name") == "universal"
    rank_key = F.struct(*order)
    picks = []
    for flag, service in service_flags.items():
        said = F.when(F.col("service_name") == service, F.col("opt_indicator")).when(universal, F.lit("false"))
        picks.append(F.max_by(said, F.when(said.isNotNull(), rank_key)).alias(flag))
    return joined.groupBy("country", "user_id").agg(*picks)


def _true(flag: str) -> Column:
    return F.coalesce(F.lower(F.col(flag).cast("string")) == "true", F.lit(False))


def _any_true(flags: list[str]) -> Column:
    out = F.lit(False)
    for flag in flags:
        out = out | _true(flag)
    return out


def opted_in(flags: list[str], family: str | None = None, corporate: str | None = None) -> Column:
    """Any flag true; or, under the corporate rule, family true, or corporate true and family null."""
    if family and corporate:
        return _true(family) | (_true(corporate) & F.col(family).isNull())
    return _any_true(flags)


def _has_email() -> Column:
    return F.col("email").isNotNull() & (F.col("email") != ERASED)


def segment_audiences(
    countries: list[str], as_of: dt.date, since: dt.date, optin: Column, profiling: str | None = None,
    exists: dict[str, str] | None = None, contains: dict[str, tuple[str, list[str]]] | None = None,
    equals: dict[str, tuple[str, list[str]]] | None = None, sources: dict[str, list[str]] | None = None,
) -> dict[str, Column]:
    """Audience name -> membership predicate over ``segment_dump`` rows.

    ``exists`` maps a name to an attribute that must be set, ``contains`` to an attribute and the
    lower-case words of which it must contain one, ``equals`` to an attribute and its values,
    ``sources`` to the source ids of registered consumers.
    """
    here = F.col("country").isin(*countries)
    registered = F.col("registration_date").cast("date") < F.lit(as_of)
    indicator = F.col("email_valid_contact_point_indicator")
    specs = {
        "Email Contactable": here & _has_email() & (indicator.isNull() | (indicator != "N")) & optin,
        "Email Optins": here & _has_email() & optin,
        "Total Registered Consumers": here & registered,
        "Consumers Registered After Date": here & registered & (F.col("registration_date").cast("date") >= F.lit(since)),
        "Gender Counts F": here & (F.col("gender") == "F") & F.col("registration_date").isNotNull(),
    }
    if profiling:
        specs["Profiling Email Optins"] = here & _has_email() & _true(profiling)
    specs.update(attribute_audiences(exists, contains, equals))
    for name, ids in (sources or {}).items():
        specs[name] = F.coalesce(F.col("source_id").isin(*ids), F.lit(False)) & F.col("registration_date").isNotNull()
    return specs


def attribute_audiences(exists: dict[str, str] | None, contains: dict[str, tuple[str, list[str]]] | None,
                        equals: dict[str, tuple[str, list[str]]] | None = None) -> dict[str, Column]:
    specs: dict[str, Column] = {}
    for name, attribute in (exists or {}).items():
        specs[name] = F.col(attribute).isNotNull()
    for name, (attribute, words) in (contains or {}).items():
        hit = F.lit(False)
        for word in words:
            hit = hit | F.coalesce(F.lower(attribute).contains(word), F.lit(False))
        specs[name] = hit
    for name, (attribute, values) in (equals or {}).items():
        specs[name] = F.coalesce(F.col(attribute).cast("string").isin(*values), F.lit(False))
    return specs


_OPEN = "*"  # the bin of periods without a first or last moment


def with_source_audiences(rows: DataFrame, audiences: DataFrame, source: str, registered: str, name: str = "_listed") -> DataFrame:
    """Rows beside the audiences of their source in whose period they registered: a row for each, and others with null.

    ``audiences`` is (audience_name, source_id, first_at, last_at): both ends count, a null end is open, and an audience may
    have many rows.  Only rows with a readable ``registered`` belong to any.  Periods lie in bins of a year, and a row looks
    into the bin of its own year and that of the open periods, so a hot source meets few periods that it must compare.
    """
    at = F.col("_at")
    span = F.sequence(F.year("first_at"), F.year("last_at"))
    closed = F.when(F.col("first_at") <= F.col("last_at"), F.transform(span, lambda y: y.cast("string"))).otherwise(F.array().cast("array<string>"))
    open_ = F.col("first_at").isNull() | F.col("last_at").isNull()
    periods = audiences.dropna(subset=["audience_name", "source_id"]).distinct().select(
        F.col("source_id").cast("string").alias("_source"), F.col("audience_name").alias("_name"), F.col("first_at").alias("_first"), F.col("last_at").alias("_last"),
        F.explode(F.when(open_, F.array(F.lit(_OPEN))).otherwise(closed)).alias("_bin"),
    )
    dated = rows.withColumns({"_source": F.col(source).cast("string"), "_at": F.col(registered).try_cast("timestamp")})
    bins = F.when(at.isNotNull(), F.array(F.year(at).cast("string"), F.lit(_OPEN))).otherwise(F.array(F.lit(None).cast("string")))
    met = adaptive_join(dated.withColumn("_bin", F.explode(bins)), periods, ["_source", "_bin"])
    inside = (F.col("_first").isNull() | (at >= F.col("_first"))) & (F.col("_last").isNull() | (at <= F.col("_last")))
    return met.withColumn(name, F.when(inside, F.col("_name"))).drop("_source", "_at", "_bin", "_name", "_first", "_last")


def count_with_sources(dump: DataFrame, entity: str, specs: dict[str, Column], audiences: DataFrame, source: str, registered: str) -> DataFrame:
    """(audience_name, count) of the predicates and of the listed audiences of sources, in one pass over ``dump``.

    An entity's rows, narrowed to flags and audience names, become one row, and only its audiences' names are counted.  A
    name that is both listed and a predicate's is one audience: members by either.  Audiences without members count 0.
    """
    flags = {f"f{k}": F.coalesce(spec, F.lit(False)) for k, spec in enumerate(specs.values())}
    narrow = dump.filter(F.col(entity).isNotNull()).select(
        F.col(entity).alias("_entity"), F.col(source).alias("_src"), F.col(registered).alias("_reg"), *[v.alias(k) for k, v in flags.items()])
    met = with_source_audiences(narrow, audiences, "_src", "_reg")
    per_entity = met.groupBy("_entity").agg(F.collect_set("_listed").alias("_names"), *[F.max(k).alias(k) for k in flags])
    told = F.array_compact(F.array(*[F.when(F.col(k), F.lit(n)) for k, n in zip(flags, specs)])) if specs else F.array().cast("array<string>")
    members = per_entity.select(F.explode(F.array_union(told, "_names")).alias("audience_name"), F.lit(1).alias("_n"))
    listed = audiences.select("audience_name").dropna().distinct()
    if specs:
        literal = F.array(*[F.lit(n) for n in specs])
        listed = listed.unionByName(dump.sparkSession.range(1).select(F.explode(literal).alias("audience_name")))
    every = members.unionByName(listed.withColumn("_n", F.lit(0)))
    return every.groupBy("audience_name").agg(F.sum("_n").cast("bigint").alias("count"))


def segment_audience_counts(dump: DataFrame, specs: dict[str, Column], opened: DataFrame | None = None, canon: DataFrame | None = None,
                            as_of: dt.date | None = None, opened_name: str = "Email Opened in Past 6 Months", countries: list[str] | None = None,
                            loaded_to: dt.date | None = None, events: dict[str, tuple[DataFrame, dt.datetime, dt.datetime]] | None = None,
                            registrations: DataFrame | None = None) -> DataFrame:
    """(audience_name, count) of the source side; ``opened`` (user_id, ts) adds recent openers by canonical user.

    ``countries`` and ``loaded_to`` limit the openers (country_code, loaded_at); ``events`` maps a name to
    rows (user_id, ts) and the period, both ends included, in which a user must have one; ``registrations``
    lists audiences of sources and registration periods, see :func:`with_source_audiences`.
    """
    counts = _counts(dump, "user_id", specs, registrations, "source_id", "registration_date")
    people = {}
    if opened is not None:
        day = F.col("ts").cast("date")
        recent = _loaded(opened, loaded_to).filter((day > F.add_months(F.lit(as_of), -6)) & (day <= F.lit(as_of)))
        people[opened_name] = recent if countries is None else recent.filter(F.col("country_code").isin(*countries))
    for name, (rows, first, last) in (events or {}).items():
        people[name] = rows.filter(F.col("ts").between(F.lit(first), F.lit(last)))
    for name, rows in people.items():
        canonical = canon.groupBy(F.col("previous_user_id").alias("user_id")).agg(F.max("canonical_user_id").alias("_c"))
        known = adaptive_join(rows.select("user_id").distinct(), canonical, ["user_id"])
        total = known.select(F.coalesce("_c", "user_id").alias("u")).distinct().agg(F.count("u").alias("count"))
        counts = counts.unionByName(total.select(F.lit(name).alias("audience_name"), "count"))
    return counts


def _counts(dump: DataFrame, entity: str, specs: dict[str, Column], registrations: DataFrame | None, source: str, registered: str) -> DataFrame:
    if registrations is None:
        return count_distinct_union(dump, entity, specs)
    return count_with_sources(dump, entity, specs, registrations, source, registered)


TARGET_TRAITS = ["userId", "email", "gender", "sourceId", "registrationDate", "countryCode", "emailValidContactPointIndicator"]


def retained_out_people(id_graph: DataFrame, retention: DataFrame) -> DataFrame:
    """Persons all of whose users are retention-out."""
    out = retention.select(F.col("user_id").alias("id_value")).distinct().withColumn("_out", F.lit(1))
    flagged = adaptive_join(id_graph.select("id_value", "pg_id"), out, ["id_value"])
    per_person = flagged.groupBy("pg_id").agg(F.min(F.coalesce("_out", F.lit(0))).alias("_all"))
    return per_person.filter("_all = 1").select("pg_id")


def cdp_dump(traits: DataFrame, aliases: DataFrame, id_graph: DataFrame, retention: DataFrame, mpns: list, flags: list[str], names: list[str] | None = None) -> DataFrame:
    """Target-side audience base: one wide row per canonical person, without retained-out persons.

    Trait values of one source row key are joined in sorted order; the best value per (program,
    canonical person, trait) is the newest by consumer date, expiration, update, then value.
    Decision: among several programs of a person the greatest value is taken.
    """
    rows = traits.filter(F.col("marketing_program_number").isin(*mpns))
    per_key = rows.groupBy("consumerid_sourceid_mpn", "pg_id", "trait_id", "marketing_program_number", "trait_name").agg(
        F.max("trait_consumer_last_updated_date").alias("trait_consumer_last_updated_date"),
        F.max("trait_expiration_date").alias("trait_expiration_date"),
        F.max("last_updated_date").alias("last_updated_date"),
        F.array_join(F.array_sort(F.collect_list("trait_value")), ",").alias("trait_value"),
    )
    people = latest_alias(aliases).select("pg_id", "canonical_pg_id").distinct()
    named = adaptive_join(per_key, people, ["pg_id"], "inner").drop("pg_id").withColumnRenamed("canonical_pg_id", "pg_id")
    best = nested_best_value(
        named, ["marketing_program_number", "pg_id", "trait_id", "trait_name"],
        ["trait_consumer_last_updated_date", "trait_expiration_date", "last_updated_date"], "trait_value",
    )
    kept = anti_by_null_check(best, retained_out_people(id_graph, retention), ["pg_id"])
    return any_non_null_pivot(kept, "pg_id", "trait_name", "trait_value", [*(names or TARGET_TRAITS), *flags])


def cdp_audiences(since: str, optin: Column, profiling: str | None = None, exists=None, contains=None, equals=None,
                  sources: dict[str, list[str]] | None = None) -> dict[str, Column]:
    """Audience name -> membership predicate over ``cdp_dump`` rows; kinds as in :func:`segment_audiences`."""
    indicator = F.col("emailValidContactPointIndicator")
    registered = F.col("registrationDate").isNotNull()
    specs = {
        "Email Contactable": optin & (indicator.isNull() | (indicator == "Y")) & _has_email(),
        "Email Optins": optin & _has_email(),
        "Consumers Registered After Date": registered & (F.col("registrationDate") >= since),
        "Total Registered Consumers": registered,
        "Gender Counts F": (F.col("gender") == "F") & registered,
    }
    if profiling:
        specs["Profiling Email Optins"] = _has_email() & _true(profiling)
    specs.update(attribute_audiences(exists, contains, equals))
    for name, ids in (sources or {}).items():
        specs[name] = F.coalesce(F.col("sourceId").isin(*ids), F.lit(False)) & registered
    return specs


def event_audience(events: DataFrame, properties: DataFrame, aliases: DataFrame, mpns: list, event_name: str, after: dt.date | None = None,
                   between: tuple[str, str] | None = None) -> DataFrame:
    """Count of canonical persons with an event of a name in a period and with a matching event property."""
    day = F.col("event_date").cast("date")
    rows = events.filter((F.col("event_name") == event_name) & F.col("marketing_program_number").isin(*mpns))
    if after is not None:
        rows = rows.filter(day > F.lit(after))
    if between is not None:
        rows = rows.filter((day >= F.lit(between[0]).cast("date")) & (day <= F.lit(between[1]).cast("date")))
    rows = adaptive_join(rows.select("trace_id", "pg_id"), properties.select("trace_id").distinct(), ["trace_id"], "left_semi")
    people = latest_alias(aliases).select("pg_id", "canonical_pg_id").distinct()
    named = adaptive_join(rows.select("pg_id").distinct(), people, ["pg_id"], "inner")
    return named.select("canonical_pg_id").distinct().agg(F.count("canonical_pg_id").alias("count"))


def cdp_audience_counts(dump: DataFrame, specs: dict[str, Column], event_counts: dict[str, DataFrame] | None = None, registrations: DataFrame | None = None) -> DataFrame:
    """(audience_name, count) of the target side, with the given event audiences and audiences of sources and periods."""
    out = _counts(dump, "pg_id", specs, registrations, "sourceId", "registrationDate")
    for name, count in (event_counts or {}).items():
        out = out.unionByName(count.select(F.lit(name).alias("audience_name"), "count"))
    return out


def audience_dashboard(source: DataFrame, target: DataFrame, program: str, at: dt.datetime, names: list[str] | None = None,
                       labels: tuple[str, str] = ("Segment", "CDP")) -> DataFrame:
    """Long dashboard rows of both sides; audiences of ``names`` that one side lacks count 0."""
    out = None
    for counts, label in ((source, labels[0]), (target, labels[1])):
        rows = counts
        if names:
            listed = counts.sparkSession.createDataFrame([(n,) for n in names], "audience_name string")
            rows = listed.join(counts, "audience_name", "left")
        part = rows.select(
            F.lit(at).cast("timestamp").alias("timestamp"), F.lit(program).alias("MP_Name"), "audience_name",
            F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), F.lit(label).alias("application_name"),
        )
        out = part if out is None else out.unionByName(part)
    return out
