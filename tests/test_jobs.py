"""The jobs from end to end on small tables, and the plans they rest on."""

import json
from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortflow.operators.envelopes import VITALS_SCHEMA, event_bronze
from cohortflow.plans import jobs
from cohortflow.sources.files import read_buckets, read_version
from cohortflow.sources.logs import LOG_SCHEMA, encounter_file_stream, log_stream
from cohortflow.streaming.medallion import Features, Tables, process_batch, silver_now
from cohortflow.streaming.router import route_domains
from cohortflow.streaming.writers import stream_to_table

AT = datetime(2026, 6, 1, tzinfo=timezone.utc)


def now():
    return F.lit(AT)


def envelope(i, domain, **payload):
    text = json.dumps({"domain": domain, "producer_run_id": "r", "payload": payload})
    return ("t", 0, i, datetime(2026, 1, 1, 0, i), f"k{i}", text)


def medical(gender="F", medication="Insulin", first=0):
    records = [
        envelope(first, "patients", ID="p1", BIRTHDATE="1950-01-01", GENDER=gender, RACE="white", SSN="1",
                 DEATHDATE="2026-05-01"),
        envelope(first + 1, "encounters", ID="e1", PATIENT="p1", DATE="2026-01-05"),
        envelope(first + 2, "encounters", ID="e2", PATIENT="p1", DATE="2026-01-20"),
        envelope(first + 3, "conditions", PATIENT="p1", ENCOUNTER="e1", CODE="c", DESCRIPTION="Asthma", START="2026-01-05"),
        envelope(first + 4, "conditions", PATIENT="p1", ENCOUNTER="e1", CODE="d", DESCRIPTION="Diabetes", START="2026-01-05"),
        envelope(first + 5, "medications", PATIENT="p1", ENCOUNTER="e1", CODE="m", DESCRIPTION=medication, START="2026-01-01"),
        envelope(first + 6, "observations", PATIENT="p1", ENCOUNTER="e1", CODE="39156-5", DESCRIPTION="BMI",
                 DATE="2026-01-05", VALUE="31"),
        envelope(first + 7, "allergies", PATIENT="p1", CODE="a", DESCRIPTION="Latex", START="2020-01-01"),
    ]
    return records


def route(spark, records, root, batch_id):
    batch = spark.createDataFrame(records, LOG_SCHEMA)
    route_domains(batch, batch_id, root, run_id="r", now=now())


def test_log_to_population_tables(spark, tmp_path):
    root = str(tmp_path)
    route(spark, medical(), root, 0)
    found = jobs.refresh_domain_silver(spark, f"{root}/bronze", f"{root}/silver")
    assert set(found) == {"patients", "encounters", "conditions", "medications", "observations", "allergies"}
    names = jobs.refresh_features(spark, f"{root}/silver", f"{root}/features")
    assert "medications_by_encounter" in names and "procedures_by_encounter" not in names

    route(spark, medical("M", "Water", 20)[:1] + [envelope(40, "patients", ID="p2", BIRTHDATE="bad")], root, 1)
    jobs.refresh_domain_silver(spark, f"{root}/bronze", f"{root}/silver")
    jobs.refresh_features(spark, f"{root}/silver", f"{root}/features")
    patients = read_buckets(spark, f"{root}/features/patients")
    assert rows(patients.select("patient_id", "gender", F.col("birthdate").cast("string"))) == [
        ("p1", "M", "1950-01-01"),
        ("p2", None, "1980-01-01"),
    ]

    def feature(name):
        return read_buckets(spark, f"{root}/features/{name}")

    known = Features(
        patients,
        [feature(n) for n in ("conditions_by_encounter", "observations_by_encounter", "medications_by_encounter")],
        [feature("allergies_by_patient")],
    )
    encounters = spark.createDataFrame(
        [("e1", "p1", datetime(2026, 1, 5), "c", "Inpatient stay", None, None),
         ("e2", "p1", datetime(2026, 1, 20), "c", "Wellness visit", None, None)],
        "encounter_id string, patient_id string, admission_date timestamp_ntz, diagnosis_code string, "
        "description string, reason_code string, reason_description string",
    )
    tables = Tables(f"{root}/lake")
    process_batch(encounters, 0, tables, known, run_id="r", now=AT)
    gold = f"{root}/gold"
    made = jobs.rebuild_gold(
        silver_now(spark, tables), gold, patients, feature("conditions_by_patient")
    )
    assert len(made) == 7
    (p360,) = spark.read.parquet(f"{gold}/patient_360").collect()
    # return after a stay 35, high-risk medication 20, allergy 5, age 10
    assert p360.risk_score == 70 and p360.risk_band == "HIGH"
    assert p360.condition_names == "Asthma | Diabetes"
    assert p360.suggested_focus == "Review recent return and follow-up"
    assert rows(spark.read.parquet(f"{gold}/comorbidity_pairs")) == [("Asthma", "Diabetes", 1)]
    assert rows(spark.read.parquet(f"{gold}/return_gaps")) == [("8-30 days", 1, 1)]
    ranking = spark.read.parquet(f"{gold}/disease_rankings").where("condition_name = 'Asthma'").first()
    assert (ranking.affected_patients, ranking.deceased_patients) == (1, 1)

    raw = {"patients": spark.createDataFrame([("p1", "1950-01-01")], "ID string, BIRTHDATE string")}
    jobs.completeness_table(raw, f"{root}/scores")
    sections = jobs.publish_snapshot(
        spark, gold, tables.audit, f"{root}/scores", f"{root}/snapshot", now()
    )
    assert "kpis" in sections and "patient360" in sections
    limited = f"{root}/limited"
    jobs.publish_snapshot(spark, gold, tables.audit, f"{root}/scores", limited, now(), {"demographics": 1, "careGaps": 0}, 1)
    told = {r.section: (r.total, r.written) for r in spark.read.json(f"{limited}/manifest").collect()}
    assert told["demographics"] == (1, 1) and told["patient360"] == (1, 1) and told["clinicalMetrics"][0] == told["clinicalMetrics"][1]
    kpis = spark.read.json(f"{root}/snapshot/kpis").first()
    assert (kpis.patients_monitored, kpis.pipeline_trust_score_pct) == (1, 100.0)
    views = jobs.register_outputs(spark, gold, {"batch_audit": tables.audit, "nothing": f"{root}/none"})
    assert set(views) == {*jobs.GOLD_SECTIONS.values(), "batch_audit"}
    with pytest.raises(FileNotFoundError):
        jobs.publish_snapshot(spark, f"{root}/none", tables.audit, f"{root}/scores", f"{root}/s2", now())


def vital(i, **body):
    event = {"event_id": f"v{i}", "patient_id": "p1", "event_timestamp": "2026-01-01 10:00:00", **body}
    return ("vitals", 0, i, datetime(2026, 1, 1), "p1", json.dumps(event))


def test_a_repeated_feature_refresh_loses_nothing(spark, tmp_path):
    silver, root = str(tmp_path / "silver"), str(tmp_path / "features")

    def land(rows_):
        payload = F.map_from_arrays(F.array(F.lit("ID"), F.lit("BIRTHDATE")), F.array("id", F.lit("1970-01-01")))
        frame = spark.createDataFrame(rows_, "id string").select(payload.alias("payload"))
        frame.write.mode("overwrite").parquet(f"{silver}/patients")

    land([("p1",), ("p2",)])
    jobs.refresh_features(spark, silver, root)
    land([("p2",), ("p3",)])
    for _ in range(2):
        jobs.refresh_features(spark, silver, root)
        kept = read_buckets(spark, f"{root}/patients")
        assert sorted(r.patient_id for r in kept.select("patient_id").collect()) == ["p1", "p2", "p3"]


def test_live_feed_from_stream_to_summaries(spark, tmp_path):
    source, bronze, root = (str(tmp_path / n) for n in ("log", "bronze", "feed"))

    def deliver(records, version):
        spark.createDataFrame(records, LOG_SCHEMA).coalesce(1).write.mode("append").json(source)
        stream = event_bronze(log_stream(spark, "json", {}, source), VITALS_SCHEMA)
        stream_to_table(stream, bronze, str(tmp_path / "ck")).awaitTermination()
        jobs.refresh_feed(spark.read.parquet(bronze), "vitals", root, now(), version)

    deliver([
        vital(1, heart_rate=70.0, systolic_bp=120.0, diastolic_bp=80.0, temperature=36.6),
        vital(2, heart_rate=999.0),
        vital(3, event_timestamp="never"),
    ], 0)
    assert spark.read.json(f"{root}/dlq/version=0").count() == 2
    deliver([vital(4, heart_rate=130.0), vital(5, patient_id=" ", heart_rate=999.0)], 1)
    letters = spark.read.json(f"{root}/dlq/version=1").collect()
    assert [json.loads(r.value)["error_reason"] for r in letters] == ["MISSING_PATIENT_ID"]
    (summary,) = spark.read.parquet(f"{root}/summary").collect()
    assert (summary.total_vitals_events, summary.abnormal_vitals_count) == (2, 1)
    assert summary.abnormal_rate_pct == 50.0
    (by_patient,) = spark.read.parquet(f"{root}/by_patient").collect()
    assert by_patient.has_abnormal_vitals


def test_feed_checks_fail_the_run_after_it_is_written(spark, tmp_path):
    """Nothing valid came: the summaries are empty, which the checks tell; the run fails and can be repeated."""
    root = str(tmp_path / "feed")
    bronze = event_bronze(spark.createDataFrame([vital(1, heart_rate=999.0)], LOG_SCHEMA), VITALS_SCHEMA)
    for _ in range(2):
        with pytest.raises(RuntimeError, match="gold_patient_not_empty"):
            jobs.refresh_feed(bronze, "vitals", root, now(), 0)
        verdicts = spark.read.parquet(f"{root}/checks/version=0")
        assert verdicts.count() == 7 and {r.check_name for r in verdicts.where("not passed").collect()} == {"gold_patient_not_empty"}
        assert verdicts.where("checked_at is null").count() == 0
        assert spark.read.json(f"{root}/dlq/version=0").count() == 1
    jobs.refresh_feed(bronze, "vitals", root, now(), 0, require=False)
    more = [vital(1, heart_rate=999.0), vital(2, heart_rate=70.0, systolic_bp=120.0, diastolic_bp=80.0, temperature=36.6)]
    twice = spark.createDataFrame([*more, more[1][:2] + (9,) + more[1][3:]], LOG_SCHEMA)
    jobs.refresh_feed(event_bronze(twice, VITALS_SCHEMA), "vitals", root, now(), 1)
    audit = {r.version: r for r in spark.read.parquet(f"{root}/audit").collect()}
    assert [(audit[v].batch_id, audit[v].source_records_read, audit[v].duplicate_records_skipped) for v in (0, 1)] == [(1, 1, 0), (2, 3, 1)]
    assert all(r.reconciliation_status == "PASS" for r in audit.values())


def test_encounters_are_gated_after_they_are_written(spark, tmp_path):
    source, tables = tmp_path / "in", Tables(str(tmp_path / "lake"))
    source.mkdir()
    header = "ID,DATE,PATIENT,CODE,DESCRIPTION,REASONCODE,REASONDESCRIPTION"

    def run(name, lines):
        (source / name).write_text("\n".join([header, *lines]) + "\n")
        stream = encounter_file_stream(spark, str(source))
        jobs.load_encounters(stream, tables, Features(), str(tmp_path / "ck"), now(), threshold=80.0)

    good = [f"e{i},2026-01-0{i + 1},p{i},A,Visit,," for i in range(5)]
    run("a_encounters.csv", good)
    with pytest.raises(RuntimeError, match="pass_rate_of_batch_1"):
        run("b_encounters.csv", ["x1,never,p,A,Visit,,", "x2,2026-01-01,p,A,Visit,,"])
    assert silver_now(spark, tables).count() == 6
    (verdict,) = spark.read.parquet(f"{tables.root}/gate").collect()
    assert (verdict.batch_id, verdict.pass_rate_pct, verdict.gate_passed) == (1, 50.0, False) and verdict.checked_at is not None
    run("c_encounters.csv", [line.replace("e", "g", 1) for line in good])
    with pytest.raises(FileNotFoundError):
        jobs.gate_batches(spark, str(tmp_path / "none"), str(tmp_path / "gate"), now())


def test_files_to_features(spark, tmp_path):
    """Malformed rows and differing headers, twice under one version, then a version more; domains without files are left out."""
    root, folder = str(tmp_path / "out"), tmp_path / "in"
    for name, text in {
        "patients/a.csv": "ID,BIRTHDATE,GENDER\np1,1950-01-01,F\np2,bad,M\np3,1960-01-01,M,too,many\n",
        "patients/b.csv": "gender,id\nM,p4\n",
        "encounters/e.csv": "ID,PATIENT,DATE\ne1,p1,2026-01-05\n",
        "medications/m.csv": "CODE,PATIENT,START,STOP,DESCRIPTION\nm,p1,2026-01-01,,Insulin\n",
    }.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    for version in (0, 0, 1):
        made = jobs.files_to_features(spark, str(folder), root, version, now())
        assert set(made) == {"patients", "medications_by_encounter"}
        counts = spark.read.parquet(f"{root}/scores/rows/version={version}").select("domain", "read", "malformed")
        assert rows(counts) == [("encounters", 1, 0), ("medications", 1, 0), ("patients", 4, 1)]
        bad = spark.read.parquet(f"{root}/landed/patients/version={version}").where("line = 'malformed'")
        assert [(r._corrupt_record, r.quarantine_timestamp is not None) for r in bad.collect()] == [("p3,1960-01-01,M,too,many", True)]
    patients = read_version(spark, f"{root}/features/patients")
    assert rows(patients.select("patient_id", "gender")) == [("p1", "F"), ("p2", "M"), ("p4", "M")]
    (found,) = read_version(spark, f"{root}/features/medications_by_encounter").collect()
    assert (found.encounter_id, found.high_risk_med_count) == ("e1", 1)
    card = spark.read.parquet(f"{root}/scores/completeness/version=1")
    assert card.count() == 3
    with pytest.raises(FileNotFoundError):
        jobs.files_to_features(spark, str(tmp_path / "none"), root, 0, now())


def test_encounter_feed_summaries(spark, tmp_path):
    event = {"encounter_id": "e", "patient_id": "p", "encounter_type": "Emergency",
             "event_timestamp": "2026-01-01 10:00:00", "length_of_stay_hours": 30.0}
    bad = {**event, "encounter_id": "", "length_of_stay_hours": -5.0}
    records = [("t", 0, i, datetime(2026, 1, 1), "p", json.dumps({**e, "event_id": f"x{i}"}))
               for i, e in enumerate([event, bad])]
    from cohortflow.operators.envelopes import ENCOUNTER_EVENT_SCHEMA

    bronze = event_bronze(spark.createDataFrame(records, LOG_SCHEMA), ENCOUNTER_EVENT_SCHEMA)
    jobs.refresh_feed(bronze, "encounters", str(tmp_path), now(), 0)
    (by_type,) = spark.read.parquet(f"{tmp_path}/by_type").collect()
    assert (by_type.encounters, by_type.emergency_encounters, by_type.risk_flag_rate_pct) == (1, 1, 100.0)
    letter = json.loads(spark.read.json(f"{tmp_path}/dlq/version=0").first().value)
    assert (letter["error_reason"], letter["source_topic"]) == ("MISSING_ENCOUNTER_ID", "clinical-encounters")
