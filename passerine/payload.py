"""The parsed payload frame.

``parse_payloads`` turns one JSON document per row into these columns and keeps the rest:

* ``raw_payload``  original text
* ``root``         map<string,variant>: every top-level key except object-valued blocks
* ``traits``, ``properties``  map<string,variant>, NULL unless the key holds an object
* ``context``      map<string,variant> without ``externalIds``
* ``ext_ids``      array<map<string,variant>>: the external ids, unknown keys included
* ``top_keys``     names of the top-level keys

Operators change these columns; ``to_document`` writes them back as one JSON text.
Nothing the engine does not know about is lost on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passerine.frames import once, split
from passerine.functions.values import VARIANT_MAP, VARIANT_MAP_ARRAY, empty_map

PAYLOAD_COLUMNS = ["root", "traits", "properties", "context", "ext_ids", "top_keys"]


def parse_payloads(df: DataFrame, raw: str = "raw_payload") -> DataFrame:
    """Add the payload columns; rows whose text is not a JSON object get NULL ``root``."""
    doc = F.col("_doc")
    parsed = once(df, _doc=F.from_json(F.col(raw), VARIANT_MAP))
    parsed = once(
        parsed,
        traits=F.try_variant_get(doc["traits"], "$", VARIANT_MAP),
        properties=F.try_variant_get(doc["properties"], "$", VARIANT_MAP),
        _context=F.try_variant_get(doc["context"], "$", VARIANT_MAP),
        ext_ids=F.try_variant_get(doc["context"], "$.externalIds", VARIANT_MAP_ARRAY),
    )
    blocks = F.array(*[
        F.when(F.col(c).isNotNull(), F.lit(k)).otherwise("") for k, c in
        (("traits", "traits"), ("properties", "properties"), ("context", "_context"))
    ])
    moved = F.when(F.col("ext_ids").isNotNull(), F.lit("externalIds")).otherwise("")
    parsed = once(parsed, _blocks=blocks, _moved=moved)
    parsed = once(
        parsed,
        root=F.map_filter(doc, lambda k, _: ~F.array_contains(F.col("_blocks"), k)),
        context=F.map_filter("_context", lambda k, _: k != F.col("_moved")),
        top_keys=F.map_keys(doc),
    )
    return parsed.select(*df.columns, *PAYLOAD_COLUMNS)


def split_corrupt(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(well-formed, corrupt): corrupt rows keep their text only."""
    good, bad = split(payloads, F.col("root").isNotNull())
    return good, bad.drop(*PAYLOAD_COLUMNS)


def to_document() -> Column:
    """The payload columns as one JSON text."""
    has_ids = F.col("ext_ids").isNotNull()
    base = F.coalesce(F.col("context"), empty_map())
    without_ids = F.map_filter(base, lambda k, _: k != "externalIds")
    with_ids = F.map_concat(without_ids, F.create_map(F.lit("externalIds"), F.to_variant_object("ext_ids")))
    context = F.when(has_ids, with_ids).otherwise(F.col("context"))
    present = {
        "traits": F.col("traits").isNotNull(),
        "properties": F.col("properties").isNotNull(),
        "context": F.col("context").isNotNull() | has_ids,
    }
    stale = lambda k: F.coalesce(
        (present["traits"] & (k == "traits")) | (present["properties"] & (k == "properties"))
        | (present["context"] & (k == "context")), F.lit(False))
    parts = [F.map_filter("root", lambda k, _: ~stale(k))]
    for key, value in (("traits", F.col("traits")), ("properties", F.col("properties")), ("context", context)):
        block = F.create_map(F.lit(key), F.to_variant_object(value))
        parts.append(F.when(present[key], block).otherwise(empty_map()))
    return F.to_json(F.map_concat(*parts))


def with_document(payloads: DataFrame, name: str = "document") -> DataFrame:
    return payloads.withColumn(name, to_document())


def canonical_json(raw: Column) -> Column:
    """Key-sorted JSON text, stable for hashing."""
    return F.to_json(F.try_parse_json(raw))
