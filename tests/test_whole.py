"""Check queries read their whole tables."""

import checks.catalogue  # noqa: F401  (registers every query)
from checks.fixtures import view
from checks.registry import QUERIES


def test_canonical_all_keeps_every_customer(spark, sf_dir):
    rows = view(spark, sf_dir, "canonical_all")
    assert rows.count() == view(spark, sf_dir, "customer").count() > view(spark, sf_dir, "canonical_ctas").count()
    assert rows.filter("user_id LIKE 'none%'").count() > 0


def test_filter_date_job_all_has_identify_records(spark, sf_dir):
    found = QUERIES["filter_date_job_all"](spark, sf_dir).select("message_id")
    known = view(spark, sf_dir, "pl_scalars").filter("is_identify").select("message_id")
    assert found.join(known, "message_id").count() > 0
