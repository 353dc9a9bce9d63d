"""Interval operators against brute force on random spans."""

import random
from datetime import date, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortflow.operators.features import medication_features
from cohortflow.operators.intervals import (
    Measure,
    active_aggregates,
    active_interval_join,
    closed,
    merge_spans,
)
from cohortflow.operators.sweep import active_sweep

START = date(2019, 12, 1)


def pick(rng, days):
    return START + timedelta(days=rng.randrange(days))


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    events, spans = [], []
    for i in range(250):
        key = "hot" if i % 3 == 0 else f"p{rng.randrange(12)}"
        at = None if i % 41 == 0 else pick(rng, 900)
        events.append((f"e{i}", None if i % 67 == 0 else key, at))
    for i in range(600):
        key = "hot" if i % 3 == 0 else f"p{rng.randrange(14)}"
        start = None if i % 37 == 0 else pick(rng, 1000) - timedelta(days=rng.choice([0, 0, 3000]))
        length = rng.choice([0, 1, 5, 30, 30, 200, 4000, -3])
        stop = None if i % 4 == 0 or start is None else start + timedelta(days=length)
        code = None if i % 29 == 0 else f"c{rng.randrange(6)}"
        name = rng.choice(["Insulin 5mg", "amoxicillin", "paracetamol", "WARFARIN"])
        spans.append((i, None if i % 71 == 0 else key, code, name, start, stop))
    ev = spark.createDataFrame(events, "encounter_id string, patient_id string, at date")
    sp = spark.createDataFrame(
        spans, "span int, patient_id string, code string, name string, start date, stop date"
    )
    return ev, sp


def brute(ev, sp, how="left"):
    s = sp.withColumnRenamed("patient_id", "sp_patient")
    on = (
        (F.col("patient_id") == F.col("sp_patient"))
        & (F.col("start") <= F.col("at"))
        & (F.col("stop").isNull() | (F.col("stop") >= F.col("at")))
    )
    return ev.join(s, on, how)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_matches_each_pair_once(data, how):
    ev, sp = data
    out = active_interval_join(ev, sp, "patient_id", "encounter_id", "at", "start", "stop", how)
    expected = brute(ev, sp, how)
    assert expected.count() > 1000
    columns = ["encounter_id", "patient_id", "at", "span", "start", "stop"]
    assert rows(out.select(*columns)) == rows(expected.select(*columns))


def test_interval_join_without_events_or_spans(data):
    ev, sp = data
    none = active_interval_join(ev.where("1=0"), sp, "patient_id", "encounter_id", "at", "start", "stop")
    alone = active_interval_join(ev, sp.where("1=0"), "patient_id", "encounter_id", "at", "start", "stop")
    assert none.count() == 0
    assert alone.count() == ev.count()


def test_interval_join_reaches_distant_dates(spark):
    ev = spark.createDataFrame(
        [("a", "p", date(1, 1, 1)), ("b", "p", date(9999, 12, 31)), ("c", "p", date(1970, 1, 1))],
        "encounter_id string, patient_id string, at date",
    )
    sp = spark.createDataFrame(
        [(1, "p", date(1, 1, 1), None), (2, "p", date(1969, 12, 31), date(9999, 12, 31))],
        "span int, patient_id string, start date, stop date",
    )
    out = active_interval_join(ev, sp, "patient_id", "encounter_id", "at", "start", "stop")
    found = {(r.encounter_id, r.span) for r in out.collect()}
    assert found == {("a", 1), ("b", 1), ("c", 1), ("b", 2), ("c", 2)}


def test_aggregates_over_active_spans(data):
    ev, sp = data
    usable = closed(sp.withColumn("end", F.col("stop")), "start", "end")
    measures = {
        "n": Measure(F.lit(1), "sum"),
        "low": Measure(F.col("start"), "min"),
        "high": Measure(F.col("stop"), "max"),
    }
    out = active_aggregates(
        ev, usable, "patient_id", "at", "start", "end", measures, share=0.05, min_rows=10
    )
    expected = brute(ev, sp).groupBy("encounter_id").agg(
        F.count("span").alias("n"), F.min("start").alias("low"), F.max("stop").alias("high")
    )
    got = out.select("encounter_id", F.coalesce("n", F.lit(0)).alias("n"), "low", "high")
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("classes", [13, 16])
def test_sweep_over_active_spans(data, classes):
    ev, sp = data
    usable = closed(sp.withColumn("end", F.col("stop")), "start", "end")
    days = F.datediff("stop", "start")
    out = active_sweep(
        ev, usable, "patient_id", "at", "start", "end", {"n": F.lit(1), "ids": F.col("span")}, "low", ("high", F.col("stop")), ("long", days), classes=classes
    )
    expected = brute(ev, sp).groupBy("encounter_id").agg(
        F.count("span").alias("n"), F.coalesce(F.sum("span"), F.lit(0)).alias("ids"), F.min("start").alias("low"), F.max("stop").alias("high"), F.max(days).alias("long")
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "ids")]
    assert rows(out.select("encounter_id", *counts, "low", "high", "long")) == rows(expected)
    assert active_sweep(ev, usable.where("1=0"), "patient_id", "at", "start", "end", {"n": F.lit(1)}).count() == ev.count()
    assert active_sweep(ev.where("1=0"), usable, "patient_id", "at", "start", "end", {"n": F.lit(1)}).count() == 0


def test_sweep_needs_few_exchanges(data):
    ev, sp = data
    usable = closed(sp.withColumn("end", F.col("stop")), "start", "end")
    out = active_sweep(ev, usable, "patient_id", "at", "start", "end", {"n": F.lit(1)}, "low", ("high", F.col("stop")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4 and "SinglePartition" not in plan


def test_medication_features_count_overlapping_courses_once(data):
    ev, sp = data
    raw = sp.select(
        F.col("patient_id").alias("PATIENT"),
        F.col("code").alias("CODE"),
        F.col("name").alias("DESCRIPTION"),
        F.col("start").cast("string").alias("START"),
        F.col("stop").cast("string").alias("STOP"),
    )
    encounters = ev.withColumnRenamed("at", "admission_date")
    high = F.lower("name").rlike("insulin|warfarin")
    anti = F.lower("name").rlike("amoxicillin")
    expected = brute(ev, sp).groupBy("encounter_id").agg(
        F.count("code").alias("medication_events"),
        F.count_distinct("code").alias("unique_medications"),
        F.count_distinct(F.when(high, F.col("code"))).alias("high_risk_med_count"),
        F.count_distinct(F.when(anti, F.col("code"))).alias("antimicrobial_count"),
        F.max(F.datediff("stop", "start")).alias("max_medication_days"),
    )
    out = medication_features(encounters, raw, share=0.05, min_rows=10)
    assert rows(out.select(*expected.columns)) == rows(expected)


@pytest.mark.parametrize("dates,courses", [(1 << 30, 1 << 30), (0, 0), (15, 1 << 30), (1 << 30, 40)])
def test_medication_features_by_pairs_and_by_the_tree(data, dates, courses):
    """All patients by pairs, all by the tree, and the one or the other by their dates or courses."""
    ev, sp = data
    raw = sp.selectExpr("patient_id PATIENT", "code CODE", "name DESCRIPTION", "string(start) START", "string(stop) STOP")
    encounters = ev.withColumnRenamed("at", "admission_date")
    out = medication_features(encounters, raw, paired_dates=dates, paired_courses=courses)
    expected = brute(ev, sp).groupBy("encounter_id").agg(
        F.count("code").alias("medication_events"),
        F.count_distinct("code").alias("unique_medications"),
        F.count_distinct(F.when(F.lower("name").rlike("insulin|warfarin"), F.col("code"))).alias("high_risk_med_count"),
        F.count_distinct(F.when(F.lower("name").rlike("amoxicillin"), F.col("code"))).alias("antimicrobial_count"),
        F.max(F.datediff("stop", "start")).alias("max_medication_days"),
    )
    assert rows(out) == rows(expected)


def test_medication_features_build_no_tree_without_large_patients(data):
    ev, sp = data
    raw = sp.selectExpr("patient_id PATIENT", "code CODE", "name DESCRIPTION", "string(start) START", "string(stop) STOP")
    out = medication_features(ev.withColumnRenamed("at", "admission_date"), raw)
    assert "_node" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_merged_spans_are_disjoint_and_cover_the_same_days(data):
    _, sp = data
    usable = closed(sp, "start", "stop").where("stop < '2100-01-01'")
    merged = merge_spans(usable, ["patient_id", "code"])

    def days(df):
        return df.select("patient_id", "code", F.explode(F.sequence("start", "stop")).alias("d"))

    assert days(merged).count() == days(merged).distinct().count()
    assert rows(days(merged)) == rows(days(usable).distinct())
