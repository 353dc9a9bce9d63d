"""Lines joined once and read by every domain: the same rows as joins of their own, and fewer shuffles."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortflow.operators.features import condition_features, procedure_features
from cohortflow.operators.joins import enrich
from cohortflow.plans import given as g


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Repeated orders, lines and parts, null keys, lines without an order or a part."""
    root = str(tmp_path_factory.mktemp("tables"))
    lines = spark.range(400).selectExpr(
        "if(id % 41 = 0, null, id % 50) as l_orderkey",
        "if(id % 43 = 0, null, id % 23) as l_partkey",
        "int(id % 7) as l_linenumber",
        "if(id % 29 = 0, null, double(id % 31)) as l_quantity",
        "element_at(array('R', 'A', 'N', null), int(id % 4 + 1)) as l_returnflag",
        "if(id % 37 = 0, null, timestamp_ntz'1996-01-01 00:00:00' + make_dt_interval(int(id))) as l_shipdate",
    )
    lines.unionByName(lines.where("l_linenumber = 2")).write.parquet(f"{root}/lineitem.parquet")
    orders = spark.range(45).selectExpr("if(id = 44, null, id) as o_orderkey", "if(id % 11 = 0, null, id % 9) as o_custkey")
    orders.unionByName(orders.where("o_orderkey < 5").withColumn("o_custkey", F.col("o_orderkey") + 20)).write.parquet(f"{root}/orders.parquet")
    kinds = "element_at(array('MEDIUM', 'ECONOMY', 'PROMO', 'SMALL', 'LARGE', null), int(id % 6 + 1)) as p_type"
    part = spark.range(20).selectExpr("id as p_partkey", "if(id = 7, null, concat('part ', id)) as p_name", "concat('Brand#', id % 5) as p_brand", kinds)
    part.unionByName(part.where("p_partkey = 3")).write.parquet(f"{root}/part.parquet")
    return root


@pytest.mark.parametrize("patient", [True, False])
@pytest.mark.parametrize("kind", [None, *g.KINDS])
def test_shared_lines_are_the_lines_of_each_domain(spark, tables, patient, kind):
    shared, own = g.domain_lines(spark, tables, patient, kind), g.lines(spark, tables, patient, kind)
    assert shared.columns == own.columns
    assert own.count() > 100 and rows(shared) == rows(own)


def test_features_of_encounters_need_no_shuffle_of_shared_lines(spark, tables):
    plain = g.domain_lines(spark, tables, patient=False)
    for found, expected in (
        (condition_features(plain), condition_features(g.lines(spark, tables, patient=False))),
        (procedure_features(g.domain_lines(spark, tables, False, "procedures")), procedure_features(g.lines(spark, tables, False, "procedures"))),
    ):
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(expected)


def test_subjects_meet_the_rows_before_these_grow(spark):
    """Columns come in the order of joins by row first, but no feature of a row travels to its subject."""
    base = spark.createDataFrame([("e1", "p1", 1), ("e2", "p2", 2), ("e3", None, 3)], "encounter_id string, patient_id string, n int")
    own = spark.createDataFrame([("e1", 10), ("e3", 30)], "encounter_id string, per_row int")
    subjects = spark.createDataFrame([("p1", "x")], "patient_id string, per_subject string")
    out = enrich(base, [own], [subjects])
    assert out.columns == ["patient_id", "encounter_id", "n", "per_row", "per_subject"]
    assert rows(out) == rows(spark.createDataFrame([("p1", "e1", 1, 10, "x"), ("p2", "e2", 2, None, None), (None, "e3", 3, 30, None)], out.schema))
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = {c: next(len(line) - len(line.lstrip(" :+-")) for line in plan if "LogicalRDD" in line and f"{c}#" in line) for c in ("per_row", "per_subject")}
    assert depth["per_subject"] > depth["per_row"]
