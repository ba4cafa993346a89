"""Small payload frames written by hand."""

import json

from passerine.payload import parse_payloads, to_document


def payloads(spark, *docs):
    rows = [(d if isinstance(d, str) else json.dumps(d),) for d in docs]
    return parse_payloads(spark.createDataFrame(rows, "raw_payload string"))


def documents(df):
    return [json.loads(r[0]) for r in df.select(to_document()).collect()]


def ext(*pairs):
    return {"externalIds": [{"type": t, "id": v, "collection": "users", "encoding": "none"} for t, v in pairs]}


def ids_of(doc, kind):
    return [x.get("id") for x in doc.get("context", {}).get("externalIds", []) if x.get("type") == kind]
