import json
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortflow.operators.envelopes import build_events, parse_envelope, to_envelope, validate_envelopes
from cohortflow.operators.quality import (
    TableSpec,
    batch_audit,
    clinical_gate,
    quality_gate,
    require_checks,
    require_quality,
    scorecard,
    split_tagged,
    tag_reference,
    tag_source_rows,
    warning_status,
)
from cohortflow.operators.sequence import dedup_events, latest_by_natural_key
from cohortflow.plans.domains import DOMAINS, Domain, topics

GATE = (
    "encounter_id string, patient_id string, admission_date timestamp, discharge_date timestamp, "
    "diagnosis_code string, bmi double, systolic_bp double, diastolic_bp double, gender string, "
    "race string, unique_medications int, condition_count int, observation_count int"
)


def gated(spark, *rows):
    return warning_status(clinical_gate(spark.createDataFrame(list(rows), GATE)))


def test_clean_row_has_no_codes(spark):
    day = datetime(2026, 1, 1)
    row = ("enc-1", "pat-1", day, day + timedelta(days=1), "A123", 28.0, 120.0, 80.0, "M", "white", 2, 1, 1)
    out = gated(spark, row).first()
    assert (out.failure_reasons, out.quality_warning_codes, out.quality_status) == ("", "", "VALID")


def test_bad_row_collects_all_codes(spark):
    day = datetime(2026, 1, 3)
    row = ("", " ", day, day - timedelta(days=1), "", None, None, None, "UNKNOWN", "UNKNOWN", 0, 0, 0)
    out = gated(spark, row).first()
    assert out.failure_reasons.split(", ") == [
        "ERR_MISSING_ENCOUNTER_ID",
        "ERR_MISSING_PATIENT_ID",
        "ERR_MISSING_ICD10",
        "ERR_CHRONO_FLOW",
    ]
    assert out.quality_warning_count == 6
    assert out.quality_status == "VALID_WITH_WARNINGS"


def test_seeded_corruption_is_counted_by_code(spark):
    start = datetime(2026, 1, 1)
    clean = [
        [f"enc-{i}", f"pat-{i}", start + timedelta(days=i), start + timedelta(days=i + 1), f"A{i}",
         24.0, 118.0, 78.0, "F", "white", 1, 1, 1]
        for i in range(15)
    ]
    damage = {
        "ERR_MISSING_ENCOUNTER_ID": lambda r: r.__setitem__(0, ""),
        "ERR_MISSING_PATIENT_ID": lambda r: r.__setitem__(1, ""),
        "ERR_MISSING_ADMISSION_DATE": lambda r: r.__setitem__(2, None),
        "ERR_MISSING_ICD10": lambda r: r.__setitem__(4, ""),
        "ERR_CHRONO_FLOW": lambda r: r.__setitem__(3, r[2] - timedelta(days=1)),
    }
    picked = iter(random.Random(42).sample(range(15), 10))
    for spoil in damage.values():
        for _ in range(2):
            spoil(clean[next(picked)])
    good, bad = split_tagged(
        gated(spark, *map(tuple, clean)), "failure_reasons", "GATE", F.current_timestamp()
    )
    codes = Counter(c for r in bad.collect() for c in r.quarantine_reason.split(", "))
    assert codes == dict.fromkeys(damage, 2)
    assert (good.count(), bad.count()) == (5, 10)


def test_unknown_reference_is_added_after_other_codes(spark):
    rows = [("1", "p1", ""), ("2", "px", ""), ("3", "px", "ERR_MISSING_CODE"), ("4", " ", "E"), ("5", None, "")]
    df = spark.createDataFrame(rows, "encounter_id string, patient_id string, failure_reasons string")
    ref = spark.createDataFrame([("p1",), ("p1",)], "patient_id string")
    out = {r.encounter_id: r.failure_reasons for r in tag_reference(df, ref, "patient_id").collect()}
    code = "ERR_UNRESOLVED_PATIENT_REFERENCE"
    assert out == {"1": "", "2": code, "3": f"ERR_MISSING_CODE, {code}", "4": "E", "5": ""}


def test_envelope_with_missing_field_is_rejected(spark):
    values = [
        {"domain": "encounters", "payload": {"ID": "1", "DATE": "2026-01-01"}},
        {"domain": "encounters", "payload": {"ID": "2", "PATIENT": "p", "DATE": "2026-01-01"}},
        {"domain": "billing", "payload": {"ID": "2"}},
        {"domain": "encounters"},
    ]
    texts = [json.dumps(v) for v in values] + ["no json", "", None]
    log = spark.createDataFrame(list(enumerate(texts)), "kafka_key int, raw_value string")
    one = {"encounters": Domain(("ID", "PATIENT", "DATE"), ("ID",), "DATE")}
    out = validate_envelopes(parse_envelope(log), one).orderBy("kafka_key").collect()
    bad = "invalid_kafka_envelope"
    assert [r.validation_error for r in out] == [
        "missing_required_payload_fields", "", bad, bad, bad, bad, bad,
    ]


def test_payload_text_keeps_nested_values(spark):
    log = spark.createDataFrame([('{"domain":"x","payload":{"a":7,"b":{"c":1}}}',)], "raw_value string")
    assert parse_envelope(log).first().payload == {"a": "7", "b": '{"c":1}'}


def test_correction_wins_per_natural_key(spark):
    def event(key, text, day, offset):
        return ({"ID": key, "DESCRIPTION": text}, datetime(2026, 1, day), 0, offset)

    rows = [event("e1", "old", 1, 1), event("e1", "new", 2, 2), event("e2", "other", 1, 3)]
    schema = "payload map<string,string>, kafka_timestamp timestamp, kafka_partition int, kafka_offset long"
    latest = latest_by_natural_key(spark.createDataFrame(rows, schema), ["ID"]).collect()
    assert {r.payload["ID"]: r.payload["DESCRIPTION"] for r in latest} == {"e1": "new", "e2": "other"}


def test_record_hash_ignores_entry_order(spark):
    a = spark.sql("select map('x','1','y','2') as payload, 1 as kafka_timestamp, 0 as kafka_partition, 1 as kafka_offset")
    b = spark.sql("select map('y','2','x','1') as payload, 1 as kafka_timestamp, 0 as kafka_partition, 1 as kafka_offset")
    hashes = {latest_by_natural_key(d, ["x"]).first().record_hash for d in (a, b)}
    assert len(hashes) == 1


def test_events_without_id_are_all_kept(spark):
    rows = [("e", "t", 0, 1, 1), ("e", "t", 0, 2, 2), (None, "t", 0, 3, 3), (None, "t", 0, 4, 4), (" ", "t", 0, 5, 5)]
    schema = "event_id string, kafka_topic string, kafka_partition int, kafka_offset long, kafka_timestamp long"
    kept = dedup_events(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.kafka_offset for r in kept) == [2, 3, 4, 5]


def test_source_rows(spark):
    df = spark.createDataFrame([("ID", "x"), ("e1", ""), ("e1", "p1")], "ID string, PATIENT string")
    out = [r.source_error for r in tag_source_rows(df, ["ID", "PATIENT"]).collect()]
    assert out == ["embedded_csv_header", "missing_required_fields:PATIENT", ""]


def test_envelope_keeps_lineage_and_key(spark):
    df = spark.createDataFrame([(42, "", "enc-9", "p")], "n long, ID string, ENCOUNTER string, PATIENT string")
    out = to_envelope(df, "conditions", "demo", "n", F.lit("now")).first()
    body = json.loads(out.value)
    assert out.key == "enc-9"
    assert (body["domain"], body["producer_run_id"], body["producer_row_number"]) == ("conditions", "demo", 42)
    assert body["payload"] == {"ID": "", "ENCOUNTER": "enc-9", "PATIENT": "p"}


def test_events_from_raw_rows(spark):
    raw = spark.createDataFrame(
        [
            (7, " e1 ", "2026-01-01T10:00:00Z", "p", "c", "Emergency hospital", " "),
            (8, None, "2026-01-01 10:00:00.25", "p", None, "Urgent care", "Asthma"),
            (9, "e3", "soon", None, "c", None, None),
        ],
        "n long, ID string, DATE string, PATIENT string, CODE string, DESCRIPTION string, "
        "REASONDESCRIPTION string",
    )
    a, b, c = build_events(raw, "n").orderBy("source_row").collect()
    assert (a.event_id, a.encounter_id) == ("s3-encounter-e1-7", "e1")
    assert a.event_timestamp == "2026-01-01T10:00:00+00:00"
    # The class looks for an emergency first, the hours for a hospital first.
    assert (a.encounter_type, a.length_of_stay_hours) == ("emergency", 72.0)
    assert a.diagnosis_description == "Emergency hospital"
    assert (b.event_timestamp, b.diagnosis_description) == ("2026-01-01T10:00:00.250000+00:00", "Asthma")
    assert (c.event_timestamp, c.encounter_type, c.diagnosis_description) == ("", "ambulatory", "")


def test_latest_audit_is_chosen_by_time_before_batch(spark):
    rows = [(99, datetime(2026, 1, 1), 10.0), (1, datetime(2026, 1, 2), 100.0)]
    audit = spark.createDataFrame(rows, "batch_id long, execution_timestamp timestamp, pass_rate_pct double")
    assert quality_gate(audit).first().batch_id == 1
    require_quality(audit)
    with pytest.raises(RuntimeError, match="batch 99"):
        require_quality(audit.where("batch_id = 99"))


def test_audit_reconciles(spark):
    schema = (
        "source_records_read long, silver_records_written long, quarantine_records_written long, "
        "warning_records long, duplicate_records_skipped long, duration_seconds double"
    )
    rows = [(100, 80, 15, 8, 5, 4.0), (100, 80, 15, 8, 4, 0.0), (0, 0, 0, 0, 0, 0.0)]
    out = batch_audit(spark.createDataFrame(rows, schema)).collect()
    assert [r.reconciliation_status for r in out] == ["PASS", "FAIL", "PASS"]
    assert [r.pass_rate_pct for r in out] == [85.0, 85.0, 0.0]
    assert [r.throughput_rows_per_second for r in out] == [25.0, 0.0, 0.0]
    assert [r.status for r in out] == ["ANOMALIES_ISOLATED", "ANOMALIES_ISOLATED", "SUCCESS"]


def test_scorecard_of_an_empty_table_and_marginals(spark):
    rows = [("1", "2020-01-01"), ("", "2020-01-01"), ("3", "bad"), ("4", None)]
    df = spark.createDataFrame(rows, "ID string, DATE string")
    specs = [TableSpec("t", df, ["ID"], "DATE"), TableSpec("none", df.where("1=0"), ["ID"], "DATE")]
    out = {r.table_name: r for r in scorecard(specs).collect()}
    assert (out["t"].trust_score_pct, out["t"].row_trust_pct) == (50.0, 25.0)
    assert out["none"].total_records == 0 and out["none"].trust_score_pct == 0.0


def test_failed_checks_are_named(spark):
    results = spark.createDataFrame([("a", True, ""), ("b", False, "")], "check_name string, passed boolean, details string")
    with pytest.raises(RuntimeError, match="1 checks failed: b"):
        require_checks(results)


def test_nine_domains_and_dead_letters():
    names = topics("records")
    assert len(DOMAINS) == 9 and len(names) == 10
    assert names["records.encounters"] == 4 and names["records.dlq"] == 1
    with pytest.raises(ValueError):
        Domain(("ID",), (), "DATE")
