"""Encounter micro-batches: Bronze, validation, enrichment, gate, Silver, state, audit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.cohort import derive_silver, drop_private
from ..operators.joins import SEEN, STATE_COLUMNS, enrich, mark_seen, mark_seen_offsets, state_told
from ..operators.quality import (
    batch_audit,
    clinical_gate,
    counts_frame,
    raw_rules,
    tag_reference,
    tag_rules,
    warning_status,
)
from ..operators.sequence import dedup_by_key
from ..operators.skew import hot_keys
from ..operators.tables import current_rows, file_ledger, merge_runs, offset_runs, state_updates
from ..sources.files import read_optional
from .state import KeyedState
from .writers import Load, run_id_of, with_checkpoint, with_trigger

SKIPPED = "SKIPPED_ALREADY_PROCESSED"
CLEAN, REJECTED = "clean", "rejected"
#: Whether no earlier load has landed a row's file or offset.
FRESH = "_fresh"
LINEAGE = (
    "source_system",
    "source_file",
    "kafka_topic",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
    "producer_run_id",
    "producer_row_number",
)
CORE = (
    "encounter_id",
    "patient_id",
    "admission_date",
    "diagnosis_code",
    "description",
    "reason_code",
    "reason_description",
)
METRICS_SCHEMA = (
    "source_records_read bigint, silver_records_written bigint, "
    "quarantine_records_written bigint, warning_records bigint, "
    "duplicate_records_skipped bigint, records_inserted bigint, records_updated bigint, "
    "input_file_count bigint, duration_seconds double, batch_type string, "
    "pipeline_name string, execution_timestamp timestamp"
)


@dataclass
class Tables:
    """Folders of the tables a run keeps under one root."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in ("bronze", "checked", "silver", "state", "ledger", "offsets", "audit"):
            raise AttributeError(name)
        return f"{self.root}/{name}"


@dataclass
class Features:
    """Feature tables an encounter is enriched with; any may be absent."""

    patients: DataFrame | None = None
    by_encounter: Sequence[DataFrame] = field(default_factory=tuple)
    by_patient: Sequence[DataFrame] = field(default_factory=tuple)


def with_lineage(df: DataFrame, now: Column) -> DataFrame:
    """Raw row as JSON and its ingestion time, next to the lineage columns it came with."""
    kept = [c for c in (*CORE, *LINEAGE) if c in df.columns]
    return df.select(
        *kept,
        *[c for c in (FRESH,) if c in df.columns],
        now.alias("ingestion_timestamp"),
        F.to_json(F.struct(*kept)).alias("raw_payload"),
    )


def silver_now(spark: SparkSession, tables: Tables) -> DataFrame | None:
    """Silver as of all loads so far: the last load of each encounter."""
    log = read_optional(spark, tables.silver, merge_schema=True)
    if log is None:
        return None
    return current_rows(log.where(F.col("verdict") == CLEAN).drop("verdict"), ["encounter_id"])


def quarantine_now(spark: SparkSession, tables: Tables) -> DataFrame | None:
    """All rejected rows: raw failures, and rows the clinical gate turned away."""
    parts = []
    raw = read_optional(spark, tables.checked, merge_schema=True)
    gated = read_optional(spark, tables.silver, merge_schema=True)
    common = ["encounter_id", "patient_id", "admission_date", "quarantine_reason", "quality_stage"]
    if raw is not None:
        parts.append(_rejected(raw, "RAW_VALIDATION").select(*common))
    if gated is not None:
        parts.append(_rejected(gated, "ENRICHED_VALIDATION").select(*common))
    return reduce(DataFrame.unionByName, parts) if parts else None


def _rejected(rows: DataFrame, stage: str) -> DataFrame:
    reason = F.col("failure_reasons").alias("quarantine_reason")
    return rows.where(F.col("verdict") == REJECTED).select("*", reason, F.lit(stage).alias("quality_stage"))


def tag_raw(bronze: DataFrame, patients: DataFrame | None, now: Column) -> DataFrame:
    tagged = tag_rules(bronze, raw_rules(now))
    return tagged if patients is None else tag_reference(tagged, patients, "patient_id")


OFFSETS = "kafka_topic string, kafka_partition int, record_count bigint, first_offset bigint, last_offset bigint"


def seen_offsets(spark: SparkSession, load: Load, tables: Tables) -> DataFrame | None:
    """Offset ranges that loads before this one have landed.

    Each load leaves the whole set, merged, so the last one's is enough; loads of one instant are merged again.
    """
    left = load.earlier(spark, tables.offsets, f"{OFFSETS}, loaded_at timestamp")
    if left is None:
        return None
    last = left.agg(F.max("loaded_at")).scalar()
    return merge_runs(left.where(F.col("loaded_at") == last).select(*[f.split()[0] for f in OFFSETS.split(", ")]))


def _unseen(spark: SparkSession, batch: DataFrame, load: Load, tables: Tables) -> DataFrame:
    """The batch with a flag for rows whose file, or whose place in the log, no earlier load has landed."""
    seen = None
    if "source_file" in batch.columns:
        seen = load.earlier(spark, tables.ledger, "file_name string")
        if seen is not None:
            seen = mark_seen(batch, seen.select(F.col("file_name").alias("source_file")).distinct(), ["source_file"])
    elif "kafka_offset" in batch.columns:
        ranges = seen_offsets(spark, load, tables)
        if ranges is not None:
            seen = mark_seen_offsets(batch, ranges)
    if seen is None:
        return batch.withColumn(FRESH, F.lit(True))
    return seen.withColumn(FRESH, ~F.col(SEEN)).drop(SEEN)


def process_batch(
    batch: DataFrame,
    batch_id: int,
    tables: Tables,
    features: Features,
    run_id: str | None = None,
    now: datetime | None = None,
    pipeline: str = "encounters",
    batch_type: str = "INCREMENTAL",
) -> None:
    """Run one micro-batch in six writes at most; safe to repeat.

    Files and log offsets that an earlier load landed are skipped before anything is written, so Bronze holds
    none twice. What is left is written to Bronze and read back, so nothing later depends on cached
    blocks or re-reads the source. All counts of the audit are gathered by the writes themselves. The
    ledger and the audit come last: a batch that died half-way is not in the ledger, and its
    retry overwrites what it left.
    """
    spark = batch.sparkSession
    load = Load(run_id or run_id_of(spark), int(batch_id))
    started = datetime.now(timezone.utc)
    at = F.lit(now or started).cast("timestamp_ntz")
    stamp = F.lit(now or started)

    by_file = "source_file" in batch.columns
    landing = with_lineage(_unseen(spark, batch, load, tables), stamp)
    one = F.lit(1)
    came = load.write(
        landing,
        tables.bronze,
        keep=FRESH,
        total=F.count(one),
        fresh=F.count(F.when(F.col(FRESH), one)),
        # Names of the batch's files, which Spark's source has listed on the driver before.
        files=F.size(F.collect_set("source_file")) if by_file else F.max(F.lit(0)),
    )
    total, fresh_count = came["total"], came["fresh"]
    if total == 0:
        return
    metrics = {
        "source_records_read": total,
        "silver_records_written": 0,
        "quarantine_records_written": 0,
        "warning_records": 0,
        "duplicate_records_skipped": total - fresh_count,
        "records_inserted": 0,
        "records_updated": 0,
        "input_file_count": came["files"] or 0,
        "batch_type": batch_type,
        "pipeline_name": pipeline,
    }
    status = None if fresh_count else SKIPPED
    if fresh_count:
        fresh = load.own(spark, tables.bronze, landing.drop(FRESH).schema)
        metrics |= _refine(spark, fresh, load, tables, features, at, stamp)
        metrics["duplicate_records_skipped"] += total - fresh_count
        verdict = "ANOMALIES_ISOLATED" if metrics["quarantine_records_written"] else "SUCCESS"
        if by_file:
            load.write(file_ledger(fresh, verdict).withColumn("loaded_at", stamp), tables.ledger)
        elif "kafka_offset" in fresh.columns:
            runs, before = offset_runs(fresh), seen_offsets(spark, load, tables)
            whole = runs if before is None else merge_runs(runs.unionByName(before))
            load.write(whole.withColumn("loaded_at", stamp), tables.offsets)

    finished = datetime.now(timezone.utc)
    metrics["execution_timestamp"] = now or finished
    metrics["duration_seconds"] = round((finished - started).total_seconds(), 2)
    audit = batch_audit(counts_frame(spark, metrics, METRICS_SCHEMA))
    if status:
        audit = audit.withColumn("status", F.lit(status))
    load.write(audit, tables.audit)


def _needed(features: Features, landed: DataFrame) -> Features:
    """Feature rows of the batch's encounters and patients only.

    The key lists come from the written Bronze rows, so their size is known: those of a
    small batch are broadcast and the feature tables are scanned without a shuffle.
    """

    def cut(tables, key: str) -> tuple[DataFrame, ...]:
        keys = landed.select(key).distinct()
        return tuple(t.join(keys, key, "left_semi") for t in tables)

    patients = None if features.patients is None else cut([features.patients], "patient_id")[0]
    return Features(
        patients, cut(features.by_encounter, "encounter_id"), cut(features.by_patient, "patient_id")
    )


def _refine(spark, fresh, load, tables, features, at, stamp) -> dict[str, int]:
    """Checked rows by verdict, Silver, state: three writes that count what they write."""
    features = _needed(features, fresh)
    state = KeyedState(tables.state)
    one = F.lit(1)

    tagged = tag_raw(fresh, features.patients, at)
    ok = F.col("verdict") == CLEAN
    checked = tagged.withColumns({"verdict": F.when(F.col("failure_reasons") == "", F.lit(CLEAN)).otherwise(F.lit(REJECTED)), "checked_at": stamp})
    raw = load.write(
        checked, tables.checked, ["verdict"], clean=F.count(F.when(ok, one)), bad=F.count(F.when(~ok, one)), buckets=F.collect_set(F.when(ok, state.bucket()))
    )
    if not raw["clean"]:
        return {"quarantine_records_written": raw["bad"]}
    clean = load.own(spark, tables.checked, checked.schema).where(ok).drop("verdict", "failure_reasons", "checked_at")

    # One row per encounter: the first by all its columns, so a retry picks the same.
    order = [c for c in (*CORE[1:], *LINEAGE) if c in clean.columns]
    unique = dedup_by_key(clean, ["encounter_id"], order)
    by_patient = [t for t in (features.patients, *features.by_patient) if t is not None]
    # Rows meet Silver's ids, by encounter, and the state, with the other tables by patient, while they are narrow.
    known = load.earlier(spark, tables.silver, "encounter_id string, verdict string")
    flagged = unique.withColumn("_updates", F.lit(False))
    if known is not None:
        ids = clean.select("encounter_id").distinct()
        there = known.where(ok).select("encounter_id").join(ids, "encounter_id", "left_semi").distinct()
        flagged = unique.join(there.withColumn("_updates", F.lit(True)), "encounter_id", "left")
    by_patient.append(state.earlier(spark, load, raw["buckets"]).select("patient_id", *STATE_COLUMNS))
    hot = hot_keys(clean, ["patient_id"])
    derived = derive_silver(enrich(flagged, features.by_encounter, by_patient, hot=hot), at)
    gated = warning_status(clinical_gate(state_told(derived))).drop("raw_payload")
    verdict = F.when(F.col("failure_reasons") == "", F.lit(CLEAN)).otherwise(F.lit(REJECTED))
    marked = drop_private(gated).withColumns({"verdict": verdict, "loaded_at": stamp})
    rows = marked.drop("_updates")
    done = load.write(
        marked,
        tables.silver,
        ["verdict", "encounter_year"],
        unwritten=["_updates"],
        n=F.count(F.when(ok, one)),
        warned=F.count(F.when(ok & (F.col("quality_warning_count") > 0), one)),
        bad=F.count(F.when(~ok, one)),
        updated=F.count(F.when(ok & F.col("_updates"), one)),
    )
    if done["n"]:
        written = load.own(spark, tables.silver, rows.schema).where(ok)
        state.update(spark, load, state_updates(written), stamp.cast("timestamp"), raw["buckets"])
    return {
        "silver_records_written": done["n"],
        "warning_records": done["warned"],
        "quarantine_records_written": raw["bad"] + done["bad"],
        "duplicate_records_skipped": raw["clean"] - done["n"] - done["bad"],
        "records_inserted": done["n"] - done["updated"],
        "records_updated": done["updated"],
    }


def run_medallion(
    stream: DataFrame,
    tables: Tables,
    features: Features,
    checkpoint: str,
    mode: str = "availablenow",
    **options,
):
    """Start the micro-batch pipeline on a stream of canonical encounter rows."""
    writer = stream.writeStream.foreachBatch(
        lambda df, batch_id: process_batch(df, batch_id, tables, features, **options)
    )
    return with_checkpoint(with_trigger(writer, mode), checkpoint).start()
