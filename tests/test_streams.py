import json
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortflow.operators.features import allergy_features, patients
from cohortflow.operators.joins import mark_seen_offsets
from cohortflow.operators.tables import OFFSET_BLOCK, merge_runs, offset_runs
from cohortflow.plans.domains import DOMAINS
from cohortflow.sources.logs import LOG_SCHEMA, encounter_file_stream, log_stream, parse_encounter_log
from cohortflow.streaming.cursor import (
    cursor_of,
    drain,
    incremental_slice,
    load_cursors,
    next_cursor,
    save_cursors,
)
from cohortflow.streaming.medallion import (
    Features,
    Tables,
    process_batch,
    quarantine_now,
    run_medallion,
    silver_now,
)
from cohortflow.streaming.state import KeyedState
from cohortflow.streaming.writers import Load
from cohortflow.streaming.router import route_domains, run_router

NOW = datetime(2026, 6, 1, tzinfo=timezone.utc)
HEADER = "ID,DATE,PATIENT,CODE,DESCRIPTION,REASONCODE,REASONDESCRIPTION"


def known(spark, names):
    raw = spark.createDataFrame(
        [(n, "1950-05-05", None, "white", "F", f"ssn-{n}") for n in names],
        "ID string, BIRTHDATE string, DEATHDATE string, RACE string, GENDER string, SSN string",
    )
    allergies = spark.createDataFrame(
        [(n, "c1", "Peanut") for n in names], "PATIENT string, CODE string, DESCRIPTION string"
    )
    return Features(patients(raw), (), (allergy_features(allergies),))


def write_csv(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def line(i, day="2026-01-01", patient=None, code="A1", text="Inpatient stay"):
    return f"e{i:04d},{day},{patient or f'p{i % 40}'},{code},{text},,"


def run(spark, tmp_path, feats, **options):
    stream = encounter_file_stream(spark, str(tmp_path / "in"))
    tables = Tables(str(tmp_path / "lake"))
    query = run_medallion(stream, tables, feats, str(tmp_path / "ck"), now=NOW, **options)
    query.awaitTermination()
    return tables


def audits(spark, tables):
    return spark.read.parquet(tables.audit).orderBy("batch_id").collect()


def test_quality_demo_batch_end_to_end(spark, tmp_path):
    lines = []
    for i in range(5000):
        day, patient, code, ident = "2026-01-02", None, "A1", i
        if i < 20:
            day = ""
        elif i < 40:
            code = ""
        elif i < 50:
            day = "not-a-date"
        elif i < 60:
            patient = " "
        elif i < 70:
            patient = "nobody"
        elif 81 <= i <= 90:
            ident = 80
        lines.append(line(ident, day, patient, code))
    write_csv(tmp_path / "in", "demo_encounters_1.csv", lines)
    write_csv(tmp_path / "in", "ignored.csv", lines)
    feats = known(spark, [f"p{i}" for i in range(40)])
    tables = run(spark, tmp_path, feats)

    (audit,) = audits(spark, tables)
    assert audit.source_records_read == 5000
    assert audit.quarantine_records_written == 70
    assert audit.duplicate_records_skipped == 10
    assert audit.silver_records_written == 4920
    assert audit.reconciliation_status == "PASS"
    assert audit.status == "ANOMALIES_ISOLATED"
    assert (audit.records_inserted, audit.records_updated) == (4920, 0)
    assert audit.input_file_count == 1

    silver = silver_now(spark, tables)
    assert silver.count() == 4920
    one = silver.where("encounter_id = 'e0100'").first()
    assert (one.los_days, one.allergy_count, one.gender) == (3, 1, "F")
    assert len(one.ssn) == 64 and "birthdate" not in silver.columns
    assert quarantine_now(spark, tables).count() == 70
    reasons = {r.quarantine_reason for r in quarantine_now(spark, tables).collect()}
    assert reasons == {
        "ERR_MISSING_OR_INVALID_DATE",
        "ERR_MISSING_CODE",
        "ERR_MISSING_PATIENT_ID",
        "ERR_UNRESOLVED_PATIENT_REFERENCE",
    }
    bronze = spark.read.parquet(tables.bronze).first()
    assert json.loads(bronze.raw_payload)["source_system"] == "file"


@pytest.fixture
def two_batches(spark, tmp_path):
    feats = known(spark, ["p1", "p2"])
    write_csv(tmp_path / "in", "a_encounters.csv", [
        line(1, "2026-01-01", "p1"), line(2, "2026-03-01", "p2"),
    ])
    tables = run(spark, tmp_path, feats)
    write_csv(tmp_path / "in", "b_encounters.csv", [
        line(1, "2026-01-01", "p1", text="Wellness visit"),
        line(3, "2026-01-20", "p1"),
        line(4, "2026-02-01", "p2"),
    ])
    run(spark, tmp_path, feats)
    return feats, tables


def test_restart_updates_state_and_upserts(spark, tmp_path, two_batches):
    feats, tables = two_batches
    first, second = audits(spark, tables)
    assert (first.source_records_read, second.source_records_read) == (2, 3)
    assert (second.records_inserted, second.records_updated) == (2, 1)

    silver = {r.encounter_id: r for r in silver_now(spark, tables).collect()}
    assert set(silver) == {"e0001", "e0002", "e0003", "e0004"}
    assert silver["e0001"].description == "Wellness visit"  # the later load wins
    assert silver["e0003"].days_since_previous_discharge == 16  # 2026-01-01 + 3 days
    assert silver["e0003"].is_readmitted_online == 1
    assert silver["e0004"].is_readmitted_online == 0  # arrived after a later stay

    state = {r.patient_id: r.last_encounter_id for r in KeyedState(tables.state).now(spark).collect()}
    assert state == {"p1": "e0003", "p2": "e0002"}  # an older date does not replace a newer one

    run(spark, tmp_path, feats)  # nothing new: no batch, no rows
    assert len(audits(spark, tables)) == 2


def test_repeated_batch_leaves_the_same_tables(spark, tmp_path, two_batches):
    feats, tables = two_batches
    names = ("bronze", "checked", "silver", "state", "ledger")
    before = {n: rows(spark.read.parquet(getattr(tables, n)).drop("raw_payload")) for n in names}
    last = spark.read.parquet(tables.bronze).where("batch_id = 1")
    run_id = last.first().run_id
    batch = last.drop("run_id", "batch_id", "ingestion_timestamp", "raw_payload")
    # A retry reads the source again; here the landed copy stands in for it.
    copy = str(tmp_path / "copy")
    batch.write.parquet(copy)
    process_batch(spark.read.parquet(copy), 1, tables, feats, run_id=run_id, now=NOW)
    after = {n: rows(spark.read.parquet(getattr(tables, n)).drop("raw_payload")) for n in names}
    assert after == before


def test_known_files_are_skipped_under_a_new_checkpoint(spark, tmp_path, two_batches):
    feats, tables = two_batches
    stream = encounter_file_stream(spark, str(tmp_path / "in"))
    run_medallion(stream, tables, feats, str(tmp_path / "ck2"), now=NOW).awaitTermination()
    skipped = spark.read.parquet(tables.audit).where("status = 'SKIPPED_ALREADY_PROCESSED'").collect()
    assert [(r.source_records_read, r.duplicate_records_skipped) for r in skipped] == [(5, 5)]
    assert skipped[0].reconciliation_status == "PASS"
    assert silver_now(spark, tables).count() == 4


def test_batch_with_only_bad_rows(spark, tmp_path):
    write_csv(tmp_path / "in", "x_encounters.csv", [line(1, "never"), line(2, "2026-01-01", "who")])
    tables = run(spark, tmp_path, known(spark, ["p1"]))
    (audit,) = audits(spark, tables)
    assert (audit.silver_records_written, audit.quarantine_records_written) == (0, 2)
    assert audit.pass_rate_pct == 0.0 and audit.reconciliation_status == "PASS"


def test_log_batches_keep_an_offset_ledger_and_need_no_features(spark, tmp_path):
    body = {"ID": "e1", "PATIENT": "p1", "DATE": "2026-01-02", "CODE": "c", "DESCRIPTION": "x"}
    source = str(tmp_path / "log")
    records = [("t", 0, i, datetime(2026, 1, 1), "k", json.dumps({**body, "ID": f"e{i}"})) for i in range(4)]
    spark.createDataFrame(records, LOG_SCHEMA).coalesce(1).write.json(source)
    stream = parse_encounter_log(log_stream(spark, "json", {}, source))
    tables = Tables(str(tmp_path / "lake"))
    run_medallion(stream, tables, Features(), str(tmp_path / "ck"), now=NOW).awaitTermination()
    ledger = spark.read.parquet(tables.offsets).first()
    assert (ledger.record_count, ledger.first_offset, ledger.last_offset) == (4, 0, 3)
    silver = silver_now(spark, tables)
    assert silver.count() == 4
    assert silver.first().quality_status == "VALID_WITH_WARNINGS"


def log_batch(spark, offsets):
    body = {"PATIENT": "p1", "DATE": "2026-01-02", "CODE": "c", "DESCRIPTION": "x"}
    records = [("t", i % 2, i // 2, datetime(2026, 1, 1), "k", json.dumps({**body, "ID": f"e{i}"})) for i in offsets]
    return parse_encounter_log(spark.createDataFrame(records, LOG_SCHEMA))


def test_log_offsets_land_once(spark, tmp_path):
    """The second delivery overlaps the first by half, the third fills a gap, the fourth is a retry of it, the fifth is all known."""
    tables = Tables(str(tmp_path / "lake"))
    deliveries = [(0, range(40)), (1, [*range(20, 60), *range(70, 80)]), (2, range(50, 75)), (2, range(50, 75)), (3, range(80))]
    for batch_id, offsets in deliveries:
        process_batch(log_batch(spark, offsets), batch_id, tables, Features(), run_id="r", now=NOW + timedelta(hours=batch_id))
    bronze = spark.read.parquet(tables.bronze)
    assert bronze.count() == 80 == bronze.select("encounter_id").distinct().count()
    whole = spark.read.parquet(tables.offsets).where("batch_id = 2").select("kafka_partition", "first_offset", "last_offset", "record_count")
    assert rows(whole) == [(0, 0, 39, 40), (1, 0, 39, 40)]
    audit = {r.batch_id: r for r in audits(spark, tables)}
    assert [audit[i].duplicate_records_skipped for i in range(4)] == [0, 20, 15, 80]
    assert audit[3].status == "SKIPPED_ALREADY_PROCESSED"
    assert all(r.reconciliation_status == "PASS" for r in audit.values())


def test_offset_runs_within_and_across_blocks(spark):
    offsets = [("t", 0, i) for i in [*range(10), *range(12, 30), 12, 31]] + [("t", 1, 5), ("u", 0, 7), ("u", 0, 8)]
    df = spark.createDataFrame(offsets, "kafka_topic string, kafka_partition int, kafka_offset bigint")
    for block in (3, 1 << 16):
        found = offset_runs(df, block).select("kafka_topic", "kafka_partition", "first_offset", "last_offset", "record_count")
        assert rows(found) == [("t", 0, 0, 9, 10), ("t", 0, 12, 29, 19), ("t", 0, 31, 31, 1), ("t", 1, 5, 5, 1), ("u", 0, 7, 8, 2)]
    assert offset_runs(df.limit(0)).count() == 0


def test_a_batch_is_six_writes(spark, tmp_path):
    """Counts come from the writes: no action besides them."""
    feats, tables = known(spark, ["p1", "p2"]), Tables(str(tmp_path / "lake"))
    store = spark._jsparkSession.sharedState().statusStore()
    rows_of = lambda ids: spark.createDataFrame(
        [(f"e{i}", f"p{i % 2 + 1}", datetime(2026, 1, 2), "A", "Inpatient stay", None, None, f"f{i % 3}-{len(ids)}") for i in ids],
        "encounter_id string, patient_id string, admission_date timestamp_ntz, diagnosis_code string, description string, "
        "reason_code string, reason_description string, source_file string",
    )
    for batch_id, ids in ((0, range(9)), (1, range(5, 25))):
        before = store.executionsCount()
        process_batch(rows_of(ids), batch_id, tables, feats, run_id="r", now=NOW)
        ran = store.executionsList(before, 1000)
        assert sum(ran.apply(i).jobs().size() > 0 for i in range(ran.size())) <= 6
    assert [(a.records_inserted, a.records_updated, a.input_file_count) for a in audits(spark, tables)] == [(9, 0, 3), (16, 4, 3)]


def test_state_reads_and_rewrites_touched_buckets(spark, tmp_path):
    state = KeyedState(str(tmp_path / "state"), buckets=8)
    schema = f"patient_id string, {state.types}"

    def put(batch_id, *updates, touched=None):
        df = spark.createDataFrame([(p, f"e{batch_id}", day, day, 1) for p, day in updates], "patient_id string, e string, a string, d string, n int")
        df = df.selectExpr("patient_id", "e as last_encounter_id", "cast(a as date) last_admission_date", "cast(d as date) last_discharge_date", "n as last_los_days")
        touched = df.agg(state.touched()).first()[0] if touched is None else touched
        state.update(spark, Load("r", batch_id), df, F.lit(NOW + timedelta(hours=batch_id)).cast("timestamp"), touched)
        return touched

    assert state.now(spark).count() == 0 and schema
    put(0, *[(f"p{i}", "2026-01-01") for i in range(100)], ("none", None))
    for batch_id in range(1, 11):
        touched = put(batch_id, ("p1", f"2026-02-{batch_id:02d}"), ("p2", "2025-12-31"), ("none", "2026-01-01"), ("p3", None))
        files = state._rows(spark, touched).select("_metadata.file_path").distinct().count()
        assert files <= len(touched) <= 4  # whatever the number of batches
    now = {r.patient_id: (r.last_encounter_id, str(r.last_admission_date)) for r in state.now(spark).collect()}
    assert len(now) == 101
    assert (now["p1"], now["p2"], now["p3"], now["none"]) == (("e10", "2026-02-10"), ("e0", "2026-01-01"), ("e0", "2026-01-01"), ("e10", "2026-01-01"))
    before = rows(spark.read.parquet(state.path))
    assert {r.patient_id: r.last_encounter_id for r in state.earlier(spark, Load("r", 10)).collect()}["p1"] == "e9"
    put(10, ("p1", "2026-02-10"), ("p2", "2025-12-31"), ("none", "2026-01-01"), ("p3", None))
    assert rows(spark.read.parquet(state.path)) == before  # a retry leaves what its first try left


def envelopes(spark, path):
    def text(domain, **payload):
        return json.dumps({"domain": domain, "producer_run_id": "r", "payload": payload})

    values = [
        text("encounters", ID="1", PATIENT="p", DATE="2026-01-01"),
        text("patients", ID="p", BIRTHDATE="1980-01-01"),
        text("patients", ID="q"),
        text("weather", ID="w"),
        "no json",
    ]
    records = [("t", 0, i, datetime(2026, 1, 1), f"k{i}", v) for i, v in enumerate(values)]
    spark.createDataFrame(records, LOG_SCHEMA).coalesce(1).write.mode("append").json(path)


def test_router_splits_domains_and_dead_letters(spark, tmp_path):
    source, root = str(tmp_path / "log"), str(tmp_path / "lake")
    envelopes(spark, source)
    stream = log_stream(spark, "json", {}, source)
    run_router(stream, root, str(tmp_path / "ck")).awaitTermination()
    bronze = spark.read.parquet(f"{root}/bronze")
    found = {r["route"]: r["count"] for r in bronze.groupBy("route").count().collect()}
    assert found == {"encounters": 1, "patients": 1, "_invalid": 3}
    letters = spark.read.json(f"{root}/dlq").collect()
    assert sorted(r.key for r in letters) == ["k2", "k3", "k4"]
    assert {json.loads(r.value)["error_reason"] for r in letters} == {
        "invalid_kafka_envelope",
        "missing_required_payload_fields",
    }
    run_router(stream, root, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(f"{root}/bronze").count() == 5


def test_router_retry_does_not_duplicate(spark, tmp_path):
    source, root = str(tmp_path / "log"), str(tmp_path / "lake")
    envelopes(spark, source)
    batch = spark.read.schema(LOG_SCHEMA).json(source)
    for _ in range(2):
        route_domains(batch, 0, root, DOMAINS, run_id="r1", now=F.lit(NOW))
    assert spark.read.parquet(f"{root}/bronze").count() == 5
    assert spark.read.json(f"{root}/dlq").count() == 3


def test_sources_drain_to_their_end(spark, tmp_path):
    path, out = str(tmp_path / "cursors"), {"a": [], "b": []}
    sources = {"a": (spark.range(0, 25), "id"), "b": (spark.range(-3, 4), "id")}
    now = F.lit(NOW).cast("timestamp")
    deliver = lambda name, part: out[name].extend(r.id for r in part.collect())
    assert drain(spark, sources, path, {"a": 10, "b": 10}, now, deliver) == 3
    assert drain(spark, sources, path, {"a": 10, "b": 10}, now, deliver) == 0
    assert sorted(out["a"]) == list(range(25)) and sorted(out["b"]) == list(range(-3, 4))  # keys of 0 and below too
    sources["a"] = (spark.range(0, 30), "id")
    assert drain(spark, sources, path, {"a": 3, "b": 10}, now, deliver) == 2
    assert sorted(out["a"]) == list(range(30)) and len(out["b"]) == 7


def test_cursor_slices_walk_the_table_once(spark, tmp_path):
    path = str(tmp_path / "cursors")
    df = spark.range(1, 26)
    seen = []
    for version in range(4):
        cursors = load_cursors(spark, path)
        part = incremental_slice(df, "id", cursor_of(cursors, "s"), 10)
        seen += [r.id for r in part.collect()]
        other = spark.createDataFrame(
            [("other", 7, datetime(2026, 1, 1))], "source_name string, last_key bigint, updated_at timestamp"
        )
        changed = next_cursor(part, "id", "s", F.current_timestamp())
        save_cursors(cursors, changed.unionByName(other), path, version)
    assert seen == list(range(1, 26))
    final = load_cursors(spark, path)
    assert {r.source_name: r.last_key for r in final.collect()} == {"s": 25, "other": 7}


def test_offsets_with_gaps_are_marked_without_copies_of_the_ranges(spark):
    """Every range is one offset, as in a log of every fourth one; none is copied, none is broadcast by a hint."""
    ranges = spark.range(0, 4000, 4).selectExpr("'t' kafka_topic", "0 kafka_partition", "1L record_count", "id first_offset", "id last_offset")
    ranges = ranges.unionByName(spark.sql("select 't' kafka_topic, 0 kafka_partition, 7L record_count, 5001L first_offset, 5900L last_offset"))
    rows = spark.range(0, 6000).selectExpr("'t' kafka_topic", "cast(0 as int) kafka_partition", "id kafka_offset", "map('k', id) payload")
    rows = rows.unionByName(rows.limit(3).selectExpr("kafka_topic", "kafka_partition", "cast(null as bigint) kafka_offset", "payload"))
    for block in (64, OFFSET_BLOCK):
        found = mark_seen_offsets(rows, ranges, block)
        seen = sorted(r.kafka_offset for r in found.where("_seen").collect())
        assert seen == [*range(0, 4000, 4), *range(5001, 5901)]
        assert found.count() == rows.count() and found.columns == [*rows.columns, "_seen"]
    assert "sequence(0" not in mark_seen_offsets(rows, ranges)._jdf.queryExecution().toString()


def test_merged_ranges_span_blocks(spark):
    """Ranges that overlap, touch within and across blocks, or cover whole blocks."""
    data = [("t", 0, 3, 0, 2), ("t", 0, 10, 3, 40), ("t", 0, 1, 20, 22), ("t", 0, 1, 42, 42), ("t", 1, 2, 41, 42), ("t", 0, 6, 47, 52)]
    runs = spark.createDataFrame(data, "kafka_topic string, kafka_partition int, record_count bigint, first_offset bigint, last_offset bigint")
    expected = [("t", 0, 1, 42, 42), ("t", 0, 14, 0, 40), ("t", 0, 6, 47, 52), ("t", 1, 2, 41, 42)]
    for block in (1, 4, 16, OFFSET_BLOCK):
        merged = merge_runs(runs, block)
        assert sorted(map(tuple, merged.select(runs.columns).collect())) == sorted(expected)
