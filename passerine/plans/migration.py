"""The three payload jobs of a migration, and the date-filter job.

Each job takes parsed payloads and returns its named outputs.  ``stage`` writes what several outputs share, parsed as it
is, so that a payload's text is parsed once in the whole job and each output is a pruned read; on a cluster pass
``staging.shared_stage``, partitioned by ``route`` or ``branch``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.frames import once
from passerine.operators import enrich, joins, route, validate
from passerine.operators.aggregates import latest_per_user_event
from passerine.plans.staging import Stage, inline
from passerine.payload import to_document


def retention_flagged(payloads: DataFrame, invalid_mpns: DataFrame, retained_out: DataFrame) -> DataFrame:
    """Payloads with ``branch``: kept, blocked (retention-out user), invalid (listed program), corrupt (no user key).

    One pass; write it partitioned by ``branch``, or take the outputs from ``retention_job``.
    """
    flagged = route.flag_invalid_mpn(route.with_user_key(payloads), invalid_mpns)
    flagged = joins.retention_flag(flagged, retained_out, "_blocked")
    branch = (
        F.when(F.col("invalid_mpn"), "invalid").when(~route.has_user_key(), "corrupt").when(F.col("_blocked"), "blocked").otherwise("kept")
    )
    return once(flagged, branch=branch).drop("invalid_mpn", "_blocked")


def _outputs(flagged: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    return {name: flagged.filter(F.col("branch") == name).drop("branch") for name in names}


def retention_job(payloads: DataFrame, invalid_mpns: DataFrame, retained_out: DataFrame) -> dict[str, DataFrame]:
    """kept, blocked, invalid and corrupt payloads."""
    return _outputs(retention_flagged(payloads, invalid_mpns, retained_out), ["kept", "blocked", "invalid", "corrupt"])


def splitter_job(payloads: DataFrame, catalogue: DataFrame, partial: DataFrame, lookups: DataFrame, as_of: dt.date, country: str,
                 stage: Stage = inline) -> dict[str, DataFrame]:
    """registration, blocked (partial retention), clickstream, clt, other, unmatched."""
    per_name = stage(route.routes_per_name(catalogue), "routes")
    routed = stage(route.route_by_name(payloads, per_name), "routed")
    branch = lambda name: routed.filter(F.col("route") == name)
    fill = lambda df: enrich.consumer_id(enrich.fill_external_ids(df, lookups, country))
    keyed = lambda df: route.with_user_key(df)
    kept, blocked = joins.partial_retention_split(keyed(branch("registration")), partial)
    dated = lambda name, mode: enrich.normalize_timestamps(route.filter_backdated(branch(name), as_of, mode))
    return {
        "registration": enrich.lowercase_opt_flags(enrich.normalize_timestamps(fill(kept))),
        "blocked": blocked,
        "clickstream": fill(keyed(dated("clickstream", "recent"))),
        "clt": fill(keyed(dated("clt", "drop"))),
        "other": enrich.normalize_timestamps(fill(keyed(branch("other")))),
        "unmatched": branch("unmatched"),
    }


def enrich_registration(payloads: DataFrame, aliases: DataFrame, segment_sources: DataFrame, legal_entity: str, opt_out_id: str = "1174") -> DataFrame:
    """All enrichment steps of registration records, in order."""
    out = enrich.split_channels(enrich.flatten_dependents(enrich.last_activity_date(payloads)))
    out = enrich.external_mpn_to_string(enrich.mpn_to_string(enrich.ids_into_traits(enrich.contact_indicator(out))))
    out = enrich.drop_duplicate_aliases(enrich.drop_empty_traits(out), aliases)
    out = enrich.universal_source_id(enrich.legal_entity(out, legal_entity), segment_sources, opt_out_id)
    return enrich.external_ids_to_traits(enrich.choice_date(out))


def enrich_event(payloads: DataFrame) -> DataFrame:
    """Enrichment of clickstream, e-mail and other events."""
    out = enrich.external_mpn_to_string(enrich.mpn_to_string(enrich.ids_into_traits(payloads)))
    return enrich.external_ids_to_traits(out)


def checked_registration(registration: DataFrame, refs: dict[str, DataFrame], legal_entity: str, as_of: dt.date, now: dt.datetime,
                         stage: Stage = inline) -> DataFrame:
    """Enriched registration records with ``branch`` (passed, failures, postal_excluded) and their ``failures``.

    ``raw_payload`` is the enriched document.  One pass; write it partitioned by ``branch``, or take
    the outputs from ``external_id_job``.
    """
    done = enrich_registration(registration, refs["aliases"], refs["segment_sources"], legal_entity)
    tagged = route.tag_postal_only(done, "_excluded")
    documented = stage(once(tagged, raw_payload=to_document()), "enriched")  # its distinct opt signatures are a second use
    checked = validate.with_failures(documented, refs["opt_map"], refs["source_map"], as_of, now)
    branch = F.when(F.col("_excluded"), "postal_excluded").when(route.passes(), "passed").otherwise("failures")
    return once(checked, branch=branch).drop("_excluded")


def external_id_job(routes: dict[str, DataFrame], refs: dict[str, DataFrame], legal_entity: str, as_of: dt.date, now: dt.datetime,
                    delta: bool = False, stage: Stage = inline) -> dict[str, DataFrame]:
    """passed, failures, postal_excluded for registration; the enriched other routes.

    ``refs``: aliases, segment_sources, opt_map, source_map.  In delta mode the other routes keep
    the latest record per user and event.
    """
    checked = stage(checked_registration(routes["registration"], refs, legal_entity, as_of, now, stage), "checked")
    out = _outputs(checked, ["passed", "failures", "postal_excluded"])
    out["failures"] = route.failure_rows(out["failures"])
    out["passed"], out["postal_excluded"] = out["passed"].drop("failures"), out["postal_excluded"].drop("failures")
    for name in ("clickstream", "clt", "other"):
        if name in routes:
            rows = enrich_event(routes[name])
            out[name] = latest_per_user_event(once(rows, raw_payload=to_document())) if delta else rows
    return out


def by_branch(payloads: DataFrame, branch: Column, names: list[str], stage: Stage) -> dict[str, DataFrame]:
    """Parsed payloads by the value of ``branch``, written once; each is a pruned read."""
    return _outputs(stage(once(payloads, branch=branch), "branches"), names)


def filter_date_job(routes: dict[str, DataFrame], as_of: dt.date, domain: str) -> dict[str, DataFrame]:
    """Date-filtered, normalised events ready to publish, with program ids and, for clt, e-mail ids."""
    dated = lambda name, mode: enrich.normalize_timestamps(route.filter_backdated(routes[name], as_of, mode))
    return {
        "clickstream": enrich.mpn_external_id(dated("clickstream", "recent")),
        "clt": enrich.mpn_external_id(enrich.email_external_id(dated("clt", "drop"), "clt", domain)),
        "other": enrich.normalize_timestamps(routes["other"]),
    }
