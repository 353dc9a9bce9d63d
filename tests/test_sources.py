import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortflow.functions.dates import gap_order, rank_of
from cohortflow.functions.text import matches, short_labels, word_pattern
from cohortflow.operators.serving import snapshot_sections
from cohortflow.sources.files import (
    PATIENT_FIELDS,
    append_table,
    read_csv_upper,
    read_csv_with_quarantine,
    read_optional,
    read_version,
    register_views,
    replace_table,
    text_schema,
    work_dir,
    write_partitioned,
    write_version,
)
from cohortflow.sources.logs import LIVE_ADMISSION, LIVE_START, LOG_SCHEMA, Admission, log_stream, parse_encounter_log, write_log
from cohortflow.sources.snapshot import write_snapshot
from cohortflow.streaming.writers import stream_to_table


def test_csv_names_are_upper_case_and_values_text(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Id,date,Value\n1,2026-01-01,007\n2,,\n")
    df = read_csv_upper(spark, str(path))
    assert df.columns == ["ID", "DATE", "VALUE"]
    assert rows(df) == [("1", "2026-01-01", "007"), ("2", None, None)]
    assert read_csv_upper(spark, str(tmp_path / "none.csv")) is None


def test_csv_schema_binds_by_name(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("DATE,ID\n2026-01-01,1\n")
    df = read_csv_upper(spark, str(path), text_schema(["ID", "DATE", "CODE"]))
    assert rows(df) == [("1", "2026-01-01", None)]


def test_malformed_rows_go_to_quarantine(spark, tmp_path):
    path = tmp_path / "patients.csv"
    path.write_text("BIRTHDATE,ID,SSN\n1980-01-01,p1,s1\n1990-01-01,p2,s2,extra,cells\n")
    good, bad = read_csv_with_quarantine(spark, str(path), PATIENT_FIELDS, F.current_timestamp())
    assert good.columns == PATIENT_FIELDS
    assert [(r.ID, r.BIRTHDATE, r.GENDER) for r in good.collect()] == [("p1", "1980-01-01", None)]
    caught = bad.collect()
    assert [r.ID for r in caught] == ["p2"] and "extra" in caught[0]._corrupt_record
    assert read_csv_with_quarantine(spark, str(tmp_path / "x"), ["ID"], F.lit(None)) is None


def test_optional_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_optional(spark, path) is None
    (tmp_path / "empty").mkdir()
    assert read_optional(spark, str(tmp_path / "empty")) is None
    append_table(spark.range(2), path)
    append_table(spark.range(2, 3).withColumn("extra", F.lit("x")), path)
    evolved = read_optional(spark, path, merge_schema=True)
    assert rows(evolved) == [(0, None), (1, None), (2, "x")]
    replace_table(spark.range(1).select(F.lit("only").alias("v")), path)
    assert rows(read_optional(spark, path)) == [("only",)]
    assert register_views(spark, {"kept": path, "gone": str(tmp_path / "none")}) == ["kept"]
    assert spark.table("kept").count() == 1


def test_partitioned_write_replaces_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "p")
    write_partitioned(spark.createDataFrame([(1, 2020), (2, 2021)], "v int, year int"), path, ["year"])
    write_partitioned(spark.createDataFrame([(9, 2021)], "v int, year int"), path, ["year"])
    assert rows(spark.read.parquet(path).select("v", "year")) == [(1, 2020), (9, 2021)]


class Session:
    """Stands in for a session with or without a named checkpoint folder."""

    def __init__(self, named, master="local[2]"):
        self.conf, self.sparkContext, self.made = {"spark.checkpoint.dir": named}, self, None
        self.master = master

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, path):
        self.made = path


def test_work_dir_is_the_named_folder_or_one_made_once():
    named = Session("hdfs://cluster/shared/")
    assert work_dir(named) == "hdfs://cluster/shared" and named.made is None
    unnamed = Session(None)
    assert work_dir(unnamed) == unnamed.made == work_dir(unnamed)


def test_no_local_folder_is_made_on_a_cluster():
    cluster = Session(None, "spark://host:7077")
    with pytest.raises(ValueError):
        work_dir(cluster)
    assert cluster.made is None


def test_a_version_is_read_with_its_own_schema_and_from_below_another(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(spark.createDataFrame([(1,)], "a int"), path, 0)
    write_version(spark.createDataFrame([(1, 2)], "a int, b int"), path, 1)
    assert rows(read_version(spark, path)) == [(1, 2)]
    assert rows(read_version(spark, path, below=1)) == [(1,)]
    assert read_version(spark, path, below=0) is None


def record(value, offset):
    return ("t", 0, offset, datetime(2026, 1, 1), "k", value if isinstance(value, str) else json.dumps(value))


def test_encounter_log_with_and_without_envelope(spark):
    body = {"ID": "e1", "PATIENT": "p1", "DATE": "2026-01-02 03:04:05", "CODE": "c"}
    log = spark.createDataFrame(
        [
            record({"payload": body, "producer_run_id": "r", "producer_row_number": 3}, 1),
            record({**body, "ID": "e2", "DATE": "never"}, 2),
            record("no json", 3),
            record({**body, "DATE": "2026-01-02T03:04:05+02:00"}, 4),
        ],
        LOG_SCHEMA,
    )
    out = {r.kafka_offset: r for r in parse_encounter_log(log).collect()}
    assert (out[1].encounter_id, out[1].producer_run_id, out[1].producer_row_number) == ("e1", "r", 3)
    assert out[1].admission_date == datetime(2026, 1, 2, 3, 4, 5)
    assert (out[2].encounter_id, out[2].admission_date) == ("e2", None)
    assert out[3].encounter_id is None
    assert out[4].admission_date == datetime(2026, 1, 2, 1, 4, 5)


def test_log_round_trip_and_rate_limit(spark, tmp_path):
    source = str(tmp_path / "log")
    for i in range(3):
        batch = spark.createDataFrame([record({"n": i}, i)], LOG_SCHEMA)
        batch.coalesce(1).write.mode("append").json(source)
    stream = log_stream(spark, "json", path=source, admission=Admission(files=1))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "ck")
    query = stream_to_table(stream, out, checkpoint)
    query.awaitTermination()
    assert spark.read.parquet(out).count() == 3
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    again = stream_to_table(stream, out, checkpoint)
    again.awaitTermination()
    assert spark.read.parquet(out).count() == 3

    letters = spark.createDataFrame([("k", "v", "dropped")], "key string, value string, other string")
    write_log(letters, "json", {}, str(tmp_path / "dlq"))
    assert rows(spark.read.json(str(tmp_path / "dlq"))) == [("k", "v")]


def test_admission_by_bytes_and_its_options(spark, tmp_path):
    source = str(tmp_path / "log")
    for i in range(3):
        spark.createDataFrame([record({"n": i, "x": "y" * 5000}, i)], LOG_SCHEMA).coalesce(1).write.mode("append").json(source)
    query = stream_to_table(log_stream(spark, "json", path=source, admission=Admission(bytes=6000)), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    assert Admission(rows=7, longest_wait="5m").options("kafka") == {"maxOffsetsPerTrigger": "7", "maxTriggerDelay": "5m"}
    assert LIVE_ADMISSION.options("kafka") == {"maxOffsetsPerTrigger": "5000"} and "failOnDataLoss" not in LIVE_START
    with pytest.raises(ValueError, match="maxOffsetsPerTrigger"):
        log_stream(spark, "json", path=source, admission=Admission(rows=5))
    with pytest.raises(ValueError, match="maxBytesPerTrigger"):
        Admission(bytes=1).options("kafka")


def test_snapshot_sections_and_manifest(spark, tmp_path):
    tables = {
        "metrics": spark.createDataFrame([("Diabetes", 10)], "condition_name string, total_encounters long"),
        "patient_360": spark.createDataFrame(
            [(f"p{i}", i % 100, "LOW" if i % 2 else None) for i in range(600)],
            "patient_id string, risk_score int, risk_band string",
        ),
        "audit": spark.createDataFrame(
            [(1, datetime(2026, 1, 1))], "batch_id long, execution_timestamp timestamp"
        ),
    }
    sections = snapshot_sections(tables, patients_per_band=250)
    assert set(sections) == {"clinicalMetrics", "patient360", "audit"}
    path = str(tmp_path / "snap")
    write_snapshot(sections, path, F.lit("2026-01-01 10:00:00").cast("timestamp"))
    assert spark.read.json(f"{path}/patient360").groupBy("risk_band").count().collect() != []
    per_band = {r["risk_band"]: r["count"] for r in spark.read.json(f"{path}/patient360").groupBy("risk_band").count().collect()}
    assert per_band == {"LOW": 250, None: 250}
    manifest = {r.section: r for r in spark.read.json(f"{path}/manifest").collect()}
    assert {n: (r.total, r.written) for n, r in manifest.items()} == {"audit": (1, 1), "clinicalMetrics": (1, 1), "patient360": (600, 500)}
    assert manifest["audit"].generatedAt == "2026-01-01T10:00:00Z"
    whole = write_snapshot(snapshot_sections(tables), f"{path}-whole", F.lit("2026-01-01 10:00:00").cast("timestamp"))
    assert ("patient360", 600, 600) in rows(whole) and spark.read.json(f"{path}-whole/patient360").count() == 600


def test_label_summaries(spark):
    values = ["a | b|a | c|d", "General Clinical Encounter", None, "x", " | y | "]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = [r[0] for r in df.select(short_labels(F.col("v"))).collect()]
    assert out == ["a | b | c and 1 more", "No condition linked", "No condition linked", "x", "y"]


def test_whole_word_patterns(spark):
    df = spark.createDataFrame([("outdated",), ("Td adult",)], "v string")
    loose = [r[0] for r in df.select(matches(F.col("v"), "td")).collect()]
    strict = [r[0] for r in df.select(matches(F.col("v"), "td", whole_words=True)).collect()]
    assert (loose, strict) == ([True, True], [False, True])
    assert word_pattern("td|hep b") == r"\b(?:td|hep b)\b"


def test_orders_put_unknown_values_last(spark):
    df = spark.createDataFrame([("90+ days",), ("?",), ("0-7 days",)], "v string")
    assert [r.v for r in df.orderBy(gap_order(F.col("v"))).collect()] == ["0-7 days", "90+ days", "?"]
    assert [r.v for r in df.orderBy(rank_of(F.col("v"), ["?"]), "v").collect()][0] == "?"


def test_files_of_one_folder_may_order_their_headers_differently(spark, tmp_path):
    folder = tmp_path / "odd [name] {1}"
    folder.mkdir()
    (folder / "a.csv").write_text("id,gender,race\n1,F,white\n")
    (folder / "b.csv").write_text("race,id,gender\nblack,2,M\nasian,3,F,more\n")
    df = read_csv_upper(spark, str(tmp_path / "odd*"))
    assert rows(df.select("ID", "GENDER", "RACE")) == [
        ("1", "F", "white"), ("2", "M", "black"), ("3", "F", "asian"),
    ]
    good, bad = read_csv_with_quarantine(spark, str(tmp_path / "odd*"), ["ID", "RACE"], F.lit(None))
    assert (good.count(), bad.count()) == (2, 1)
    assert rows(good) == [("1", "white"), ("2", "black")] and bad.first().ID == "3"
