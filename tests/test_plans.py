"""The physical plans the engine is designed to produce (static plans, AQE off).

These pin the scale properties described in the README: one hash exchange per
snapshot side for the paragraph and document jobs, no broadcast of data that
grows with the corpus, Python evaluated once, a per-task limit before the
top-k shuffle.
"""

import re

import pytest

from conftest import SF_SMALL
from palimpsest.plans.catalog import REGISTRY


@pytest.fixture()
def static_plan(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda name: REGISTRY[name][0](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def shuffles(plan):
    return len(re.findall(r"(?<!Reused)Exchange hashpartitioning", plan))


@pytest.mark.parametrize("name,expected", [
    ("document_metrics", 2),          # prev and latest, once each
    ("paragraph_pairs", 2),
    ("look_ahead_status", 2),
    ("deletion_runs", 2),             # the text index and the window reuse doc_id hashing
    ("threshold_flags", 2),
    ("aligned_paragraphs", 2),       # pairs built inside the joined document row
    ("paragraph_redline", 2),        # ... and the per-document redline reuses the join's hashing
    ("report_sections", 2),          # one full outer join gives all three sections
    ("addition_info", 2),            # the anti-join's rows, not joined again
    ("crawl_report_rows", 2),        # digests meet once; reports are parsed and exploded in place
    ("shifted_paragraphs", 3),       # two sides + the text index; the inner pairing keeps doc_id hashing
    ("word_redline", 2),
    ("paragraph_log", 0),            # a projection
    ("new_paragraphs", 2), ("deleted_paragraph_keys", 2), ("paragraph_merge", 2),
    ("chapter_changes", 3),          # two logs and the text index; the windows per chapter reuse them
    ("changes_from_logs", 3),
    ("chapter_changes_with_refs", 7),  # and two for the references' own join, one for their lists, one to attach them
    ("term_hits", 5),                # grams, term grams, candidates, their texts (2)
    ("repaired_redlines", 2),
    ("xml_elements", 0), ("xml_document_fields", 0), ("debracketed_bodies", 0),
])
def test_exchange_counts(static_plan, name, expected):
    plan = static_plan(name)
    assert shuffles(plan) == expected, plan


@pytest.mark.parametrize("name", ["document_metrics", "paragraph_pairs", "deletion_runs", "shifted_paragraphs",
                                  "inserted_paragraphs", "chapter_changes", "report_sections"])
def test_no_broadcast_of_growing_data(static_plan, name):
    assert "BroadcastExchange" not in static_plan(name)


def test_distance_udf_evaluated_once(static_plan):
    plan = static_plan("report_sections")
    assert plan.count("_levenshtein_udf(") == 1


def test_crawl_reports_are_parsed_once(static_plan):
    assert static_plan("crawl_report_rows").count("Generate inline") == 1


def test_topk_limit_before_shuffle(static_plan):
    plan = static_plan("newest_events")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_feed_job_reads_the_distance_once(static_plan):
    assert static_plan("feed_updates").count("_exceeds_udf(") == 1


def test_team_list_broadcast_is_size_checked(static_plan):
    plan = static_plan("team_documents")
    assert "BroadcastExchange" in plan and shuffles(plan) == 0
