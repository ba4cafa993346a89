"""Identity rewrite, clean-up and table copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passerine.operators.skew import adaptive_join
from passerine.operators.windows import earliest_identity_rank

ALIAS_TABLES = {"profile_aliases", "id_aliases"}

# Columns the store generates itself, and consent columns that may hold text 'NULL'.
GENERATED_COLUMNS = {
    "profiles": [
        "email_sha256_hash", "email_sha1_hash", "normalized_email_sha256_hash", "normalized_email_sha1_hash",
        "phone_number_sha256_hash", "phone_number_sha1_hash", "normalized_phone_number_sha256_hash",
        "normalized_phone_number_sha1_hash", "phone_number2_sha256_hash", "phone_number2_sha1_hash",
        "normalized_phone_number2_sha256_hash", "normalized_phone_number2_sha1_hash",
    ],
    "profile_events": ["trace_id_pg_id"],
}
STATUS_OPEN, STATUS_DONE, STATUS_REVIEW = "ToBeTriggered", "Success", "ToBeAnalysed"


def id_rewrite_join(df: DataFrame, mapping: DataFrame, columns: dict[str, str], key: str = "pg_id") -> DataFrame:
    """Rewrite columns through a mapping (old -> new) of ``key``; unmapped rows stay.

    ``columns`` names the target columns and the value each takes: ``new`` or ``keep``.
    """
    renamed = mapping.select(F.col("old").alias(key), F.col("new").alias("_new"))
    joined = adaptive_join(df, renamed, [key])
    changed = {c: F.coalesce(F.col("_new"), F.col(c)) for c, how in columns.items() if how == "new"}
    return joined.withColumns(changed).select(*df.columns)


def pg_id_mapping(lookup1: DataFrame, lookup2: DataFrame) -> DataFrame:
    """One (old, new) row per old id from two lookups; rows without a new id are ignored."""
    pick = lambda d: d.select(F.col("pre_prod_pg_id").alias("old"), F.col("new_pg_id").alias("new"))
    both = pick(lookup1).unionByName(pick(lookup2)).dropna()
    return both.groupBy("old").agg(F.max("new").alias("new"))


def rewrite_pg_id(tables: dict[str, DataFrame], lookup1: DataFrame, lookup2: DataFrame) -> dict[str, DataFrame]:
    """Replace pg_id in every table; alias tables also take the new id as canonical_pg_id.

    Columns the store generates are left out of the rewritten tables.
    """
    mapping = pg_id_mapping(lookup1, lookup2)
    out = {}
    for name, table in tables.items():
        kept = table.drop(*GENERATED_COLUMNS.get(name, []) if name == "profiles" else [])
        targets = {"pg_id": "new"}
        if name in ALIAS_TABLES:
            targets["canonical_pg_id"] = "new"
        out[name] = id_rewrite_join(kept, mapping, targets)
    return out


def rewrite_trace_id(tables: dict[str, DataFrame], trace_ids: DataFrame, suffix: str = "-pp") -> dict[str, DataFrame]:
    """Append a suffix to the listed trace ids in every table.

    Ids that already end in the suffix are left alone, so a second run changes nothing.
    """
    listed = trace_ids.select("trace_id").dropna().distinct().withColumn("_listed", F.lit(True))
    out = {}
    for name, table in tables.items():
        kept = table.drop(*GENERATED_COLUMNS.get(name, []))
        joined = adaptive_join(kept, listed, ["trace_id"])
        change = F.col("_listed") & ~F.col("trace_id").endswith(suffix)
        renamed = F.when(change, F.concat("trace_id", F.lit(suffix))).otherwise(F.col("trace_id"))
        out[name] = joined.withColumn("trace_id", renamed).select(*kept.columns)
    return out


CONSENT_KEYS = ["id_value", "service_name", "marketing_program_number", "contact_point_type_name"]


def update_consents(consents: DataFrame, changes: DataFrame) -> DataFrame:
    """Set opt_date and opt_status of the consents named by key in ``changes``."""
    newest = F.struct("opt_date", "opt_status")
    latest = changes.groupBy(*CONSENT_KEYS).agg(F.max(newest).alias("_u"))
    joined = adaptive_join(consents, latest, CONSENT_KEYS)
    found = F.col("_u").isNotNull()
    return joined.withColumns({
        "opt_date": F.when(found, F.col("_u.opt_date")).otherwise(F.col("opt_date")),
        "opt_status": F.when(found, F.col("_u.opt_status")).otherwise(F.col("opt_status")),
    }).select(*consents.columns)


def null_literal_cleanup(df: DataFrame, mpn, columns: list[str], literal: str = "NULL", mpn_column: str = "marketing_program_number") -> DataFrame:
    """For one program: NULL instead of a literal text (``NULL``, ``{}``, a sentinel date) in the given columns."""
    ours = F.col(mpn_column) == mpn
    cleaned = {c: F.when(ours & (F.col(c).cast("string") == literal), None).otherwise(F.col(c)) for c in columns}
    return df.withColumns(cleaned)


def copy_by_program(main: DataFrame, mpn, semi: list[tuple[DataFrame, list[str]]] | None = None, target: tuple[DataFrame, list[str]] | None = None,
                    mpn_column: str = "marketing_program_number") -> DataFrame:
    """Rows of one program to copy: restricted to the keys of ``semi`` tables, minus what ``target`` has."""
    out = main.filter(F.col(mpn_column) == mpn) if mpn_column in main.columns else main
    for table, keys in semi or []:
        out = adaptive_join(out, table.select(*keys).distinct(), keys, "left_semi")
    if target is not None:
        table, keys = target
        out = adaptive_join(out, table.select(*keys).distinct(), keys, "left_anti")
    return out.select(*main.columns)


def id_mapping(id_graph: DataFrame, id_aliases: DataFrame, mpns: list) -> DataFrame:
    """(pg_ids, user_ids): the earliest created person of each source user id; ties kept."""
    users = id_graph.filter((F.col("id_type") == "userId") & F.col("marketing_program_number").isin(*mpns)).select("id_value", "pg_id")
    created = id_aliases.groupBy("pg_id").agg(F.min("created_date").alias("created_date"))
    ranked = earliest_identity_rank(adaptive_join(users, created, ["pg_id"], "inner"))
    return ranked.select(F.col("pg_id").alias("pg_ids"), F.col("id_value").alias("user_ids"))


def first_created(id_aliases: DataFrame) -> DataFrame:
    """(pg_id, created_date): when each person was first seen."""
    return id_aliases.groupBy("pg_id").agg(F.min("created_date").alias("created_date"))


def updated_id_mapping(mapping: DataFrame, created: DataFrame, id_graph: DataFrame, new_aliases: DataFrame, mpns: list) -> tuple[DataFrame, DataFrame]:
    """(mapping, created) brought up to date with alias rows that came since: what a full rebuild would give.

    Only persons that are new, or now seen earlier, count as changed, and only the users that they belong to are ranked
    again; the rest of the mapping stays. A mapping that would be empty is an error.
    """
    news = first_created(new_aliases).withColumnRenamed("created_date", "_new").withColumn("_seen", F.lit(True))
    known = created.withColumn("_known", F.lit(True))
    earlier = F.col("_known").isNull() | (F.col("_new").isNotNull() & (F.col("created_date").isNull() | (F.col("_new") < F.col("created_date"))))
    changed = adaptive_join(news, known, ["pg_id"]).where(earlier).select("pg_id", "_new")
    older = adaptive_join(created, changed, ["pg_id"], "left_anti")
    now = older.select("pg_id", "created_date").unionByName(changed.select("pg_id", F.col("_new").alias("created_date")))
    users = id_graph.filter((F.col("id_type") == "userId") & F.col("marketing_program_number").isin(*mpns)).select("id_value", "pg_id")
    touched = adaptive_join(users, changed.select("pg_id"), ["pg_id"], "left_semi").select("id_value").distinct()
    again = adaptive_join(adaptive_join(users, touched, ["id_value"], "left_semi"), now, ["pg_id"], "inner")
    fresh = earliest_identity_rank(again).select(F.col("pg_id").alias("pg_ids"), F.col("id_value").alias("user_ids"))
    kept = adaptive_join(mapping, touched.withColumnRenamed("id_value", "user_ids"), ["user_ids"], "left_anti").select("pg_ids", "user_ids")
    return require_rows(kept.unionByName(fresh), "id mapping"), now


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself; fails when it is empty (one row is looked at)."""
    if df.isEmpty():
        raise ValueError(f"{what}: the query gave no rows")
    return df


def alias_request_rows(mapping: DataFrame) -> DataFrame:
    """Mapping rows as open alias requests."""
    return mapping.select(
        F.col("user_ids").alias("previousId"), F.col("pg_ids").alias("userId"), F.lit("alias").alias("type"),
        F.lit(STATUS_OPEN).alias("status"), F.lit("").alias("response"), F.lit(0).alias("retry_count"),
        F.lit(None).cast("timestamp").alias("triggered_date"),
    )


def apply_api_outcomes(requests: DataFrame, outcomes: DataFrame, at) -> DataFrame:
    """Write call outcomes back by previousId.

    ``outcomes`` has (previousId, error): NULL error means success.  Errors reopen the request with
    the message; both add one to retry_count.  Decision: success adds one as well.
    """
    told = outcomes.groupBy("previousId").agg(F.max("error").alias("_error")).withColumn("_told", F.lit(True))
    joined = adaptive_join(requests, told, ["previousId"])
    hit = F.coalesce(F.col("_told"), F.lit(False))
    return joined.withColumns({
        "status": F.when(hit, F.when(F.col("_error").isNull(), STATUS_DONE).otherwise(STATUS_OPEN)).otherwise(F.col("status")),
        "response": F.when(hit & F.col("_error").isNotNull(), F.col("_error")).otherwise(F.col("response")),
        "retry_count": F.when(hit, F.col("retry_count") + 1).otherwise(F.col("retry_count")),
        "triggered_date": F.when(hit, F.lit(at).cast("timestamp")).otherwise(F.col("triggered_date")),
    }).select(*requests.columns)


def batch_outcomes(batched: DataFrame, errors: DataFrame) -> DataFrame:
    """(previousId, error) of batched calls; ``errors`` locates failures by (bucket, batch, position).

    ``batched`` comes from ``batch_rows``; a call without an error row succeeded.
    """
    keys = ["bucket", "batch", "position"]
    return adaptive_join(batched, errors.select(*keys, "error"), keys).select("previousId", "error")


def retry_exhausted(requests: DataFrame, limit: int = 3) -> DataFrame:
    """Open requests tried ``limit`` times go to review."""
    spent = F.col("retry_count") >= limit
    return requests.withColumn("status", F.when(spent, STATUS_REVIEW).otherwise(F.col("status")))


def merge_status(target: DataFrame, updates: DataFrame, keys: tuple[str, ...] = ("message_id", "trace_id")) -> DataFrame:
    """Status and time of matched rows that are still ToBeReplayed; applying it twice changes nothing."""
    new = updates.groupBy(*keys).agg(F.max(F.struct("replay_status", "replay_time")).alias("_u"))
    joined = adaptive_join(target, new, list(keys))
    hit = F.col("_u").isNotNull() & (F.col("replay_status") == "ToBeReplayed")
    return joined.withColumns({
        "replay_time": F.when(hit, F.col("_u.replay_time")).otherwise(F.col("replay_time")),
        "replay_status": F.when(hit, F.col("_u.replay_status")).otherwise(F.col("replay_status")),
    }).select(*target.columns)


def export_shapes(mapping: DataFrame, mpn: str, domain: str) -> dict[str, DataFrame]:
    """File shapes of an id mapping: id file, e-mail file, alias rows, and user e-mail rows."""
    address = lambda c: F.concat(F.col(c).cast("string"), F.lit(f"_{mpn}@{domain}"))
    pairs = mapping.select("user_ids", "pg_ids").distinct()
    return {
        "ids": pairs.select(address("user_ids").alias("User.email"), address("pg_ids").alias("User.identifier")),
        "emails": pairs.select(address("pg_ids").alias("User.email"), address("pg_ids").alias("User.identifier")),
        "aliases": pairs.select(F.col("user_ids").alias("previousId"), F.col("pg_ids").alias("userId"), F.lit("alias").alias("type")),
        "user_emails": pairs.select(F.col("pg_ids").alias("userId"), address("pg_ids").alias("traits.email")),
    }
