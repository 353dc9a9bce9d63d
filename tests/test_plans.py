"""Physical plans: what reaches the scan, what is cut before a shuffle, what never appears."""

import os
import re

import pytest

import __spark_entry__ as contract
from cohortflow.operators import cohort, serving
from cohortflow.plans import given

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
STREAMED = {"micro_batch_silver", "domain_router"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - STREAMED))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|BatchEval", text)


@pytest.mark.parametrize(
    "name", ["latest_per_key", "latest_by_natural_key", "event_dedup", "dedup_by_key", "balanced_top_n"]
)
def test_latest_rows_are_cut_before_the_shuffle(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    final, exchange, partial = (
        text.index("Final"), text.index("Exchange hashpartitioning"), text.index("Partial")
    )
    assert "WindowGroupLimit" in text and final < exchange < partial


def test_scans_read_only_what_they_need(spark):
    text = plan(contract.queries()["observation_features"](spark, SF_DIR))
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
    }


def test_filters_reach_the_scan(spark):
    text = plan(contract.queries()["incremental_slice"](spark, SF_DIR))
    assert "GreaterThan(event_id,2000)" in text and "TakeOrderedAndProject" in text


def test_top_k_is_never_a_full_sort(spark):
    for name in ("top_patients", "top_conditions", "worklist_search", "vitals_worklist"):
        text = plan(contract.queries()[name](spark, SF_DIR))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_interval_join_has_no_range_residual(spark):
    text = plan(contract.queries()["interval_join"](spark, SF_DIR))
    for line in re.findall(r".*(?:SortMergeJoin|BroadcastHashJoin).*", text):
        assert ">=" not in line and "<=" not in line


def test_return_sequence_shuffles_its_rows_once(spark):
    """The rows meet the tables of cuts and of handed rows by broadcast and are dealt once, by subject and range."""
    rows = given.encounters(spark, SF_DIR)
    assert rows.count() > 0
    text = plan(contract.queries()["return_sequence"](spark, SF_DIR))
    wide = [x for x in re.findall(r"Exchange hashpartitioning\((.*?)\)", text) if "_piece" in x and x.startswith("patient_id")]
    assert len(wide) == 1 and "SortMergeJoin" not in text


def test_measures_are_not_repeated_for_every_label(spark):
    text = plan(cohort.patient_360(given.scored(spark, SF_DIR)))
    generated = [line for line in text.splitlines() if "Generate explode" in line]
    assert generated and all("abnormal_vital_count" not in line for line in generated)
    assert text.count("Exchange hashpartitioning") == 1


def test_return_gaps_come_in_the_order_of_their_buckets(spark):
    names = ["0-7 days", "8-30 days", "31-90 days", "90+ days"]
    mixed = spark.createDataFrame([(n, i) for i, n in enumerate(names[::-1])], "return_gap_bucket string, encounter_count int").repartition(3)
    assert [r.return_gap_bucket for r in serving.ordered_return_gaps(mixed).collect()] == names
