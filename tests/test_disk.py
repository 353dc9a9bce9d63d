"""What joins and sequences put on disk or send to the driver, and that their results stay those of the other way."""

import os
import time
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from cohortflow.operators import intervals
from cohortflow.operators.intervals import active_interval_join
from cohortflow.operators.sequence import previous_event
from cohortflow.sources.files import SHUFFLES_END
from cohortflow.streaming.medallion import Features, Tables, process_batch, silver_now
from cohortflow.streaming.state import KeyedState
from cohortflow.streaming.writers import Load


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


@pytest.fixture(scope="module")
def visits(spark):
    """Events without id, key or date, and some under one id; spans without key, start or stop, or that end before they begin."""
    events = spark.range(400).selectExpr(
        "if(id % 37 = 0, null, concat('e', id)) as event", "if(id % 29 = 0, null, concat('p', id % 23 * (id % 3))) as patient",
        "if(id % 31 = 0, null, date_add(date'2001-01-01', int(id * 7 % 300))) as at", "id % 5 as kind")
    other = events.where("event < 'e12'").withColumn("at", F.date_add("at", 9))
    twice = events.where("event between 'e2' and 'e23' or event is null")
    spans = spark.range(600).selectExpr(
        "if(id % 41 = 0, null, concat('p', id % 25 * (id % 3))) as patient", "id as span",
        "if(id % 43 = 0, null, date_add(date'2000-12-01', int(id * 11 % 320))) as start",
        "if(id % 4 = 0, null, date_add(date'2000-12-01', int(id * 11 % 320 + id % 90 - 5))) as stop")
    return events, events.unionByName(other).unionByName(twice), spans


ARGUMENTS = ("patient", "event", "at", "start", "stop")


def test_spans_are_shuffled_once_as_they_are(visits, spark):
    """Not once per node of the tree, and neither are the pairs."""
    events, _, spans = visits
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = active_interval_join(events.where("event is not null"), spans, *ARGUMENTS, "inner")
        assert plan(found).count("Exchange hashpartitioning") == 2 and "Generate" not in plan(found)
        assert found.where("span is not null").count() > 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("how, limits", [("left", {"paired_spans": 20}), ("inner", {"paired_events": 20})])
def test_pairs_by_key_are_those_of_the_tree(visits, how, limits):
    _, events, spans = visits
    found = active_interval_join(events, spans, *ARGUMENTS, how, **limits)
    tree = intervals._tree_join(events, spans, *ARGUMENTS, how)
    assert found.dtypes == tree.dtypes and rows(found) == rows(tree)


def test_only_large_keys_go_through_the_tree(visits):
    events, _, spans = visits
    assert "Generate" in plan(active_interval_join(events, spans, *ARGUMENTS, paired_events=20))
    assert "Generate" not in plan(active_interval_join(events, spans, *ARGUMENTS))


def test_hot_keys_by_a_small_share_are_not_broadcast(spark, monkeypatch):
    """As many keys are hot as there are; rows without a key and one large key are cut both ways."""
    df = spark.range(6600).selectExpr(
        "if(id % 11 = 0, null, if(id % 13 = 0, -1, id % 1500)) as key", "date_add(date'2001-01-01', int(id * 7 % 40)) as at", "id as tie", "id * 2 as v")
    sent, send = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda told: sent.append(told) or send(told))
    found = previous_event(df, "key", "at", "tie", ["v"], share=1e-9, min_rows=2)
    monkeypatch.undo()
    assert len(sent) == 3 and 0 < max(told.count() for told in sent) < 300
    expected = df.withColumn("prev_v", F.lag("v").over(Window.partitionBy("key").orderBy("at", "tie")))
    assert rows(found) == rows(expected)


def _shuffle_bytes(path):
    """Bytes of shuffle files under a session's local folder."""
    return sum(os.path.getsize(f"{at}/{f}") for at, _, files in os.walk(path) for f in files if f.startswith("shuffle_") and f.endswith(".data"))


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    """Also while the driver has no reason to collect its garbage; the table that was read stays, and so do the settings."""
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    before = sum(map(_shuffle_bytes, local))
    load = Load("run", 0)
    told = spark.range(200_000).selectExpr("id", "uuid() as text", "id % 2 as half")
    counted = load.write(told.repartition(8, "text"), f"{tmp_path}/a", ["half"], n=F.count(F.lit(1)))
    assert counted == {"n": 200_000} and load.own(spark, f"{tmp_path}/a").count() == 200_000
    state = spark.range(50_000).selectExpr("uuid() as patient_id", "'e' as last_encounter_id", "date'2001-01-01' as last_admission_date",
        "date'2001-01-02' as last_discharge_date", "1 as last_los_days")
    KeyedState(f"{tmp_path}/s").update(spark, load, state, F.lit("2024-01-01").cast("timestamp"))
    until = time.time() + 20  # block managers remove the files of an ended write by themselves
    while sum(map(_shuffle_bytes, local)) - before >= 1_000_000 and time.time() < until:
        time.sleep(0.2)
    assert sum(map(_shuffle_bytes, local)) - before < 1_000_000
    assert all(spark.conf.get(name) == "false" for name in SHUFFLES_END)


def test_state_and_updates_are_told_while_rows_are_narrow(spark, tmp_path):
    """A second load: the enriched rows are shuffled to their folders and no more."""
    tables = Tables(str(tmp_path))
    patients = spark.range(40).selectExpr("concat('p', id) as patient_id", "'F' as gender", "'x' as race", "date'1950-01-01' as birthdate", "'1-2' as ssn")
    wide = spark.range(200).selectExpr("concat('e', id) as encounter_id", "repeat('label ', 9) as primary_condition_name")
    plans = []
    write = Load.write

    def noted(self, df, table, *args, **kwargs):
        if table == tables.silver:
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(self, df, table, *args, **kwargs)

    visits = spark.range(160).selectExpr(
        "concat('e', id) as encounter_id", "concat('p', id % 45) as patient_id", "timestamp_ntz'2001-01-01 00:00:00' + make_dt_interval(int(id)) as admission_date",
        "'O' as diagnosis_code", "'Inpatient stay' as description", "cast(null as string) as reason_code", "cast(null as string) as reason_description")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Load, "write", noted)
        for batch_id, part in enumerate((visits.where("encounter_id < 'e5'"), visits.where("encounter_id >= 'e3'"))):
            process_batch(part, batch_id, tables, Features(patients, [wide], []), run_id="r", now=datetime(2024, 2, 1 + batch_id))
    audit = {r.batch_id: r for r in spark.read.parquet(tables.audit).collect()}
    known = {r.encounter_id for r in visits.where("encounter_id < 'e5'").collect() if r.patient_id in {f"p{i}" for i in range(40)}}
    again = {e for e in known if e >= "e3"}
    assert (audit[1].records_updated, audit[0].records_updated) == (len(again), 0) and again
    # Leaves come in the order of joins: the wide table is joined after the state and after Silver's ids.
    wide_at = plans[1].index("Range (0, 200")
    assert plans[1].rindex("last_discharge_date#") < wide_at and plans[1].rindex("verdict#") < wide_at
    seen = silver_now(spark, tables).select("encounter_id", "previous_discharge_date", "is_readmitted_online", "primary_condition_name")
    assert seen.where("previous_discharge_date is not null").count() > 0 and "last_los_days" not in silver_now(spark, tables).columns
