"""What the queries on scored encounters carry through shuffles, and how words are looked up."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortflow.functions.text import matches
from cohortflow.operators.features import medication_features
from cohortflow.plans import given as g


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pattern", ["influenza|td|hep b", "latex", "a.c|x", "b(e|u)d", "|x", "x|", "", "INSULIN", r"\d", "td|td"])
def test_words_are_found_as_by_the_regular_expression(spark, pattern):
    texts = ["Influenza, seasonal", "Td adult", "HEP B", "hep  b", "", " ", None, "LATEX allergy", "abc", "a.c", "x", "bed", "insulin 5", "été td"]
    told = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", matches(F.col("t"), pattern).alias("found"), F.lower("t").rlike(pattern).alias("expected"))
    assert all(r.found == r.expected for r in told.collect())


def test_plain_words_need_no_regular_expression(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("t"))
    assert "RLIKE" not in plan(df.select(matches(F.col("t"), "insulin|heparin")))
    assert "RLIKE" in plan(df.select(matches(F.col("t"), "td", whole_words=True)))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders, lines and customers that repeat, null keys, and orders without lines or customer."""
    root = str(tmp_path_factory.mktemp("scored"))
    orders = spark.range(60).selectExpr(
        "id as o_orderkey", "if(id % 11 = 0, null, id % 7) as o_custkey",
        "timestamp_ntz'1996-01-01 00:00:00' + make_dt_interval(int(id % 20 * 9)) as o_orderdate",
        "element_at(array('O', 'F', null), int(id % 3 + 1)) as o_orderstatus",
        "element_at(array('1-URGENT', '2-HIGH', '5-LOW', null), int(id % 4 + 1)) as o_orderpriority")
    orders.unionByName(orders.where("o_orderkey < 9")).write.parquet(f"{root}/orders.parquet")
    customers = spark.range(6).selectExpr("id as c_custkey", "concat('c', id) as c_name", "double(id - 2) as c_acctbal", "'BUILDING' as c_mktsegment", "id % 3 as c_nationkey")
    customers.unionByName(customers.where("c_custkey = 2")).write.parquet(f"{root}/customer.parquet")
    spark.range(150).selectExpr(
        "id % 50 as l_orderkey", "id % 13 as l_partkey", "id % 4 as l_suppkey", "int(id % 7 + 1) as l_linenumber", "double(id % 31) as l_quantity",
        "element_at(array('R', 'A', 'N'), int(id % 3 + 1)) as l_returnflag",
        "timestamp_ntz'1996-01-01 00:00:00' + make_dt_interval(int(id)) as l_shipdate").write.parquet(f"{root}/lineitem.parquet")
    spark.range(13).selectExpr("id as p_partkey", "concat('part ', id) as p_name", "concat('Brand#', id % 5) as p_brand",
        "element_at(array('MEDIUM', 'ECONOMY', 'PROMO', 'SMALL', 'LARGE'), int(id % 5 + 1)) as p_type").write.parquet(f"{root}/part.parquet")
    return root


def test_a_query_carries_only_what_it_reads_through_the_sequence(spark, tables):
    scored = g.scored_rows(spark, tables)
    assert scored.count() == g.silver(spark, tables).count() > 60
    risk = plan(scored.select("encounter_id", "readmission_risk_score"))
    assert "Window" in risk and "sha2" not in risk and "ssn" not in risk and "diagnosis_code" not in risk
    assert "Window" not in plan(scored.select("encounter_id", "care_gap_severity"))


def test_pruned_scores_are_the_scores_of_whole_rows(spark, tables):
    scored = g.scored_rows(spark, tables)
    names = ["encounter_id", "patient_id", "readmission_risk_score", "risk_reasons"]
    whole = spark.createDataFrame(scored.collect(), scored.schema)
    assert rows(scored.select(*names)) == rows(whole.select(*names))


def test_courses_of_codes_that_come_once_are_not_grouped_by_code(spark):
    """Codes that come once, twice and without a name: as many as by the tree of intervals, and fewer groups."""
    raw = spark.range(300).selectExpr(
        "if(id % 37 = 0, null, concat('p', id % 9)) as PATIENT", "if(id % 23 = 0, null, concat('c', id % if(id % 2 = 0, 5, 120))) as CODE",
        "element_at(array('insulin', 'Amoxicillin 5', 'water', null), int(id % 4 + 1)) as DESCRIPTION",
        "cast(date_add(date'2001-01-01', int(id % 50)) as string) as START",
        "if(id % 5 = 0, null, cast(date_add(date'2001-01-01', int(id % 50 + id % 13 - 1)) as string)) as STOP")
    encounters = spark.range(80).selectExpr("concat('e', id) as encounter_id", "concat('p', id % 10) as patient_id", "date_add(date'2001-01-01', int(id * 7 % 60)) as admission_date")
    paired, swept = (medication_features(encounters, raw, paired_dates=n) for n in (256, 0))
    assert rows(paired) == rows(swept) and paired.columns == swept.columns and paired.count() == 80
    mixed = medication_features(encounters.unionByName(encounters.where("patient_id = 'p1'").withColumn("encounter_id", F.concat("encounter_id", F.lit("x")))), raw, paired_dates=8)
    assert rows(mixed.where("encounter_id not like '%x'")) == rows(paired)
    assert "_again" in plan(paired) and any(r.unique_medications < r.medication_events for r in paired.collect())
