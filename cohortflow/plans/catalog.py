"""Registered queries: every operator run over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import age_band, try_date, try_double, try_timestamp, whole_years
from ..functions.scores import RISK_BANDS, band
from ..functions.text import (
    classify_encounter,
    mask,
    normalise_label,
    shard_id,
    short_labels,
    stay_days,
    stay_hours,
)
from ..operators import cohort, envelopes, feeds, features, joins, quality, sequence, serving, tables
from ..operators.intervals import closed
from ..operators.sweep import active_sweep
from ..sources.files import work_dir
from ..sources.logs import canonicalise
from ..streaming.cursor import incremental_slice
from ..streaming.medallion import Features, Tables, run_medallion, silver_now
from ..streaming.router import run_router
from . import given as g

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so every client reads them alike."""
    dates = {c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"}
    return df.withColumns(dates) if dates else df


def query(build: Query) -> Query:
    """Register a query under its function's name (a trailing underscore avoids a clash)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        g.prepare(spark)
        return plain(build(spark, sf_dir))

    QUERIES[build.__name__.rstrip("_")] = run
    return run


# ---- projections and derivations ----------------------------------------------------------------


@query
def canonical_encounters(spark, sf):
    raw = g.raw_encounters(spark, sf)
    return raw.select(*canonicalise(raw)).drop("reason_code")


@query
def tolerant_cast(spark, sf):
    date = F.col("DATE")
    return g.raw_encounters(spark, sf).select(
        "ROW_NUMBER",
        try_timestamp(date).alias("as_timestamp"),
        try_date(date).alias("as_date"),
        try_double(F.col("ID")).alias("as_number"),
    )


@query
def payload_projection(spark, sf):
    parsed = envelopes.parse_envelope(g.domain_log(spark, sf))
    return envelopes.project_payload(parsed, ["ID", "PATIENT", "DATE"], keep=["kafka_offset"])


@query
def envelope_parse(spark, sf):
    parsed = envelopes.parse_envelope(g.domain_log(spark, sf))
    fields = [f for f in envelopes.ENVELOPE_FIELDS if f != "payload"]
    size = F.size(F.map_keys("payload")).alias("n_fields")
    return parsed.select("kafka_offset", *fields, F.when(F.col("payload").isNotNull(), size).alias("n_fields"))


@query
def fill_defaults(spark, sf):
    filled = cohort.fill_defaults(cohort.complete_columns(g.enriched(spark, sf)))
    return filled.select(
        "encounter_id", "gender", "race", "condition_names", *cohort.COUNT_COLUMNS
    )


@query
def label_normalise(spark, sf):
    label = normalise_label([F.col("reason_description"), F.col("primary_condition_name")])
    return g.enriched(spark, sf).select("encounter_id", label.alias("condition_name"))


@query
def stay_length(spark, sf):
    days = stay_days(F.col("description"))
    out = F.date_add(F.col("admission_date").cast("date"), days)
    return g.encounters(spark, sf).select(
        "encounter_id", days.alias("los_days"), out.alias("discharge_date")
    )


@query
def age_band_(spark, sf):
    age = whole_years(F.col("birthdate"), g.as_of())
    return g.patient_rows(spark, sf).select(
        "patient_id", age.alias("age"), age_band(age).alias("age_group")
    )


@query
def shard_id_(spark, sf):
    return g.patient_rows(spark, sf).select(
        "patient_id", shard_id(F.col("patient_id")).alias("hospital_id")
    )


@query
def mask_identifier(spark, sf):
    return g.patient_rows(spark, sf).select("patient_id", mask(F.col("ssn")).alias("ssn"))


@query
def encounter_classify(spark, sf):
    text = F.col("description")
    return g.encounters(spark, sf).select(
        "encounter_id",
        classify_encounter(text).alias("encounter_type"),
        stay_hours(text).alias("length_of_stay_hours"),
    )


@query
def build_events(spark, sf):
    return envelopes.build_events(g.raw_encounters(spark, sf), "ROW_NUMBER")


@query
def envelope_build(spark, sf):
    raw = g.raw_encounters(spark, sf)
    return envelopes.to_envelope(raw, "encounters", "run-1", "ROW_NUMBER", g.feed_now())


@query
def explode_labels(spark, sf):
    return cohort.explode_labels(g.scored_rows(spark, sf))


@query
def risk_score(spark, sf):
    return g.scored_rows(spark, sf).select("encounter_id", "readmission_risk_score")


@query
def burden_score(spark, sf):
    return g.scored_rows(spark, sf).select("encounter_id", "clinical_burden_score")


@query
def risk_band(spark, sf):
    score = F.col("readmission_risk_score")
    return g.scored_rows(spark, sf).select("encounter_id", band(score, RISK_BANDS).alias("risk_band"))


@query
def reason_codes(spark, sf):
    flags = [f"reason_{r}" for r in cohort.REASONS]
    return g.scored_rows(spark, sf).select("encounter_id", *flags, "risk_reasons")


@query
def care_gap_severity(spark, sf):
    return g.scored_rows(spark, sf).select("encounter_id", "care_gap_severity", "recommended_action")


@query
def suggested_focus(spark, sf):
    return patient_360_table(spark, sf).select("patient_id", "suggested_focus")


@query
def vital_flags(spark, sf):
    flagged = feeds.vital_flags(g.vitals_bronze(spark, sf))
    names = ["abnormal_heart_rate", "abnormal_blood_pressure", "abnormal_temperature"]
    return flagged.select("kafka_offset", *names, "has_abnormal_vitals")


@query
def encounter_flags(spark, sf):
    return g.encounter_checked(spark, sf).select(
        "event_id", "is_long_stay", "is_emergency", "has_diagnosis", "encounter_risk_flag"
    )


@query
def short_labels_(spark, sf):
    return patient_360_table(spark, sf).select(
        "patient_id", short_labels(F.col("condition_names")).alias("top_conditions")
    )


@query
def unpivot_signals(spark, sf):
    return serving.unpivot_signals(
        feeds.encounter_summary(g.encounter_feed_silver(spark, sf), "encounter_type")
    )


# ---- data quality -------------------------------------------------------------------------------


def raw_canonical(spark, sf) -> DataFrame:
    raw = g.raw_encounters(spark, sf)
    return raw.select("ROW_NUMBER", *canonicalise(raw))


def raw_tagged(spark, sf) -> DataFrame:
    return quality.tag_rules(raw_canonical(spark, sf), quality.raw_rules(g.feed_now()))


@query
def raw_validation(spark, sf):
    return raw_tagged(spark, sf).select("ROW_NUMBER", "failure_reasons")


@query
def reference_check(spark, sf):
    tagged = quality.tag_reference(
        raw_tagged(spark, sf), g.patient_rows(spark, sf), "patient_id", spread=["ROW_NUMBER"]
    )
    return tagged.select("ROW_NUMBER", "patient_id", "failure_reasons")


@query
def quarantine_split(spark, sf):
    clean, bad = quality.split_tagged(
        raw_tagged(spark, sf), "failure_reasons", "RAW_VALIDATION", g.feed_now()
    )
    columns = ["ROW_NUMBER", "quality_stage", "quarantine_reason", "quarantined_at"]
    kept = clean.withColumns(
        {
            "quality_stage": F.lit("CLEAN"),
            "quarantine_reason": F.lit(""),
            "quarantined_at": F.lit(None).cast("timestamp_ntz"),
        }
    )
    return bad.select(*columns).unionByName(kept.select(*columns))


def gate_rows(spark, sf) -> DataFrame:
    """Silver rows with hard errors worked in; ``row_id`` keeps them apart."""
    n = F.col("encounter_id").cast("bigint")

    def broken(every: int, bad, name: str) -> Column:
        bad = bad if isinstance(bad, Column) else F.lit(bad)
        return F.when(n % every == 0, bad).otherwise(F.col(name))

    return g.silver(spark, sf).withColumns(
        {
            "row_id": n,
            "encounter_id": broken(101, " ", "encounter_id"),
            "patient_id": broken(53, None, "patient_id"),
            "admission_date": broken(61, None, "admission_date"),
            "diagnosis_code": broken(73, "", "diagnosis_code"),
            "discharge_date": broken(
                79, F.date_sub(F.col("admission_date").cast("date"), 1), "discharge_date"
            ),
            "gender": broken(67, "UNKNOWN", "gender"),
        }
    )


@query
def clinical_gate(spark, sf):
    return quality.clinical_gate(gate_rows(spark, sf)).select(
        "row_id", "failure_reasons", "quality_warning_codes"
    )


@query
def warning_status(spark, sf):
    return quality.warning_status(quality.clinical_gate(gate_rows(spark, sf))).select(
        "row_id", "quality_status", "quality_warning_count"
    )


@query
def vitals_validation(spark, sf):
    checked = quality.first_error(g.vitals_bronze(spark, sf), quality.vitals_rules(g.feed_now()))
    return checked.select("kafka_offset", "validation_error")


@query
def encounter_event_validation(spark, sf):
    return g.encounter_checked(spark, sf).select("event_id", "patient_id", "validation_error")


def validated_log(spark, sf) -> DataFrame:
    return envelopes.validate_envelopes(envelopes.parse_envelope(g.domain_log(spark, sf)))


@query
def envelope_validation(spark, sf):
    return validated_log(spark, sf).select("kafka_offset", "domain", "validation_error")


@query
def source_row_validation(spark, sf):
    echoed = F.when(F.col("ROW_NUMBER") % 107 == 0, F.lit("CODE")).otherwise(F.col("CODE"))
    raw = g.raw_encounters(spark, sf).withColumn("CODE", echoed)
    tagged = quality.tag_source_rows(raw, ["ID", "PATIENT", "DATE"])
    return tagged.select("ROW_NUMBER", "source_error")


@query
def event_validation(spark, sf):
    events = envelopes.build_events(g.raw_encounters(spark, sf), "ROW_NUMBER")
    checked = quality.first_error(events, quality.outgoing_event_rules())
    return checked.select("source_row", "validation_error")


@query
def dlq_records(spark, sf):
    return envelopes.to_dlq(
        g.vitals_quarantine(spark, sf), "clinical-vitals", "vitals", g.feed_now()
    )


def scorecard(spark, sf) -> DataFrame:
    def build() -> DataFrame:
        line_specs = {
            "conditions": (None, ["PATIENT", "ENCOUNTER", "DESCRIPTION", "START"]),
            "medications": ("medications", ["PATIENT", "DESCRIPTION", "START"]),
            "observations": (None, ["PATIENT", "ENCOUNTER", "DESCRIPTION", "START"]),
            "procedures": ("procedures", ["PATIENT", "ENCOUNTER", "DESCRIPTION", "START"]),
            "careplans": ("careplans", ["PATIENT", "ENCOUNTER", "DESCRIPTION", "START"]),
            "allergies": ("allergies", ["PATIENT", "DESCRIPTION", "START"]),
            "immunizations": ("immunizations", ["PATIENT", "DESCRIPTION", "START"]),
        }
        specs = [
            quality.TableSpec("patients", g.raw_patients(spark, sf), ["ID", "BIRTHDATE"], "BIRTHDATE"),
            quality.TableSpec(
                "encounters", g.raw_encounters(spark, sf), ["ID", "PATIENT", "DATE"], "DATE"
            ),
        ]
        specs += [
            quality.TableSpec(name, g.domain_lines(spark, sf, kind=kind), required, "START")
            for name, (kind, required) in line_specs.items()
        ]
        return quality.scorecard(specs)

    return g.staged(spark, sf, "scorecard", build)


@query
def completeness_scorecard(spark, sf):
    return scorecard(spark, sf)


def audit(spark, sf) -> DataFrame:
    return quality.batch_audit(g.audit_rows(spark, sf))


@query
def batch_audit(spark, sf):
    return audit(spark, sf)


@query
def check_suite(spark, sf):
    silver = g.vitals_silver(spark, sf)
    checks = quality.feed_checks(
        g.vitals_bronze(spark, sf),
        silver,
        g.vitals_quarantine(spark, sf),
        feeds.vitals_summary(silver),
        feeds.vitals_summary(silver, "patient_id"),
    )
    return quality.run_checks(checks)


@query
def quality_gate(spark, sf):
    return quality.quality_gate(audit(spark, sf))


@query
def stream_audit(spark, sf):
    place = ["kafka_topic", "kafka_partition", "kafka_offset"]
    checked = g.vitals_checked(spark, sf)
    repeats = g.vitals_bronze(spark, sf).join(checked.select(*place), place, "left_anti")
    return quality.stream_audit(
        g.vitals_silver(spark, sf), g.vitals_quarantine(spark, sf), repeats, audit(spark, sf)
    )


# ---- joins ------------------------------------------------------------------------------------------


@query
def enrich_encounters(spark, sf):
    return g.enriched(spark, sf).drop("admission_date", "description", "reason_code", "ssn")


@query
def interval_join(spark, sf):
    """Per encounter: spans active on its date, the earliest start and the latest stop."""
    spans = g.lines(spark, sf, named=False).select(
        F.col("PATIENT").alias("patient_id"),
        try_date(F.col("START")).alias("start"),
        try_date(F.col("STOP")).alias("stop"),
    )
    usable = closed(spans.withColumn("closed_stop", F.col("stop")), "start", "closed_stop")
    events = g.encounters(spark, sf).select(
        "encounter_id", "patient_id", F.col("admission_date").cast("date").alias("on_date")
    )
    found = active_sweep(
        events,
        usable,
        "patient_id",
        "on_date",
        "start",
        "closed_stop",
        sums={"active_spans": F.lit(1)},
        earliest="first_start",
        latest=("last_stop", F.col("stop")),
    )
    return found.select(
        "encounter_id",
        F.coalesce("active_spans", F.lit(0)).alias("active_spans"),
        "first_start",
        "last_stop",
    )


def filed_events(spark, sf) -> DataFrame:
    file = F.concat(F.lit("events-"), F.col("ts").cast("date").cast("string"), F.lit(".csv"))
    return g.read(spark, sf, "events").withColumn("source_file", file)


@query
def skip_processed(spark, sf):
    rows = filed_events(spark, sf)
    done = tables.file_ledger(rows.where(F.col("ts") < "2024-01-16"), "SUCCESS")
    return joins.skip_seen(rows, done, "source_file", "file_name").select("event_id", "source_file")


def old_and_new(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Encounters up to 1998 as a target, those since 1998 as a source that overlaps it."""
    rows = g.encounters(spark, sf).select(
        "encounter_id", "patient_id", "admission_date", "diagnosis_code"
    )
    target = rows.where(F.col("admission_date") < "1999-01-01").withColumn("origin", F.lit("target"))
    source = rows.where(F.col("admission_date") >= "1998-01-01").withColumns(
        {"origin": F.lit("source"), "batch": F.lit(2)}
    )
    return target, source


@query
def upsert_counts(spark, sf):
    target, source = old_and_new(spark, sf)
    return joins.upsert_counts(source, target, ["encounter_id"])


@query
def comorbidity_pairs(spark, sf):
    return pairs(spark, sf)


def pairs(spark, sf) -> DataFrame:
    def build() -> DataFrame:
        labels = g.staged(spark, sf, "labels", lambda: cohort.explode_labels(g.scored_rows(spark, sf)))
        return cohort.comorbidity_pairs(labels)

    return g.staged(spark, sf, "pairs", build)


def history(spark, sf) -> DataFrame:
    return g.staged(spark, sf, "history", lambda: features.first_onset(g.lines(spark, sf)))


def rankings(spark, sf) -> DataFrame:
    return g.staged(
        spark,
        sf,
        "rankings",
        lambda: cohort.disease_rankings(
            history(spark, sf), g.encounters(spark, sf), g.patient_rows(spark, sf)
        ),
    )


@query
def disease_rankings(spark, sf):
    return rankings(spark, sf)


@query
def top_diseases(spark, sf):
    return serving.top_diseases(rankings(spark, sf), "deceased_patients", 10)


@query
def deceased_associations(spark, sf):
    deaths = g.patient_rows(spark, sf).where("deathdate is not null").select("patient_id", "deathdate")
    return cohort.deceased_associations(history(spark, sf), deaths)


def stays(spark, sf) -> DataFrame:
    days = stay_days(F.col("description"))
    return g.encounters(spark, sf).withColumns(
        {
            "los_days": days,
            "discharge_date": F.date_add(F.col("admission_date").cast("date"), days),
        }
    )


@query
def return_state(spark, sf):
    rows = stays(spark, sf)
    state = tables.state_updates(rows.where(F.col("admission_date") < "1999-01-01"))
    fresh = rows.where(F.col("admission_date") >= "1999-01-01")
    return joins.attach_state(fresh, state, spread=["encounter_id"]).select(
        "encounter_id",
        "previous_discharge_date",
        "days_since_previous_discharge",
        "is_readmitted_online",
    )


# ---- features ----------------------------------------------------------------------------------------


@query
def observation_features(spark, sf):
    return features.observation_features(g.observations(spark, sf))


@query
def condition_features(spark, sf):
    return features.condition_features(g.lines(spark, sf, patient=False))


@query
def first_onset(spark, sf):
    return features.first_onset(g.lines(spark, sf))


@query
def medication_features(spark, sf):
    return features.medication_features(
        g.encounters(spark, sf), g.lines(spark, sf, kind="medications")
    )


@query
def procedure_features(spark, sf):
    return features.procedure_features(g.lines(spark, sf, patient=False, kind="procedures"))


@query
def careplan_features(spark, sf):
    return features.careplan_features(g.lines(spark, sf, patient=False, kind="careplans"))


@query
def allergy_features(spark, sf):
    return features.allergy_features(g.lines(spark, sf, kind="allergies"))


@query
def immunization_features(spark, sf):
    return features.immunization_features(g.lines(spark, sf, kind="immunizations"))


# ---- population tables -----------------------------------------------------------------------------


def metrics(spark, sf) -> DataFrame:
    return g.staged(spark, sf, "metrics", lambda: cohort.condition_metrics(g.scored_rows(spark, sf)))


def groups(spark, sf) -> DataFrame:
    return g.staged(spark, sf, "groups", lambda: cohort.demographics(g.scored_rows(spark, sf)))


def patient_360_table(spark, sf) -> DataFrame:
    return g.staged(spark, sf, "patient_360", lambda: cohort.patient_360(g.scored_rows(spark, sf)))


def gaps(spark, sf) -> DataFrame:
    return g.staged(spark, sf, "care_gaps", lambda: cohort.care_gap_worklist(g.scored_rows(spark, sf)))


@query
def condition_metrics(spark, sf):
    return metrics(spark, sf)


@query
def demographics(spark, sf):
    return groups(spark, sf)


@query
def patient_360(spark, sf):
    return patient_360_table(spark, sf)


@query
def care_gap_worklist(spark, sf):
    return gaps(spark, sf)


@query
def return_gaps(spark, sf):
    return serving.ordered_return_gaps(cohort.return_gaps(sequence.return_sequence(stays(spark, sf))))


@query
def return_sequence(spark, sf):
    return sequence.return_sequence(stays(spark, sf)).select(
        "encounter_id",
        "prev_admission",
        "prev_discharge",
        "prev_los",
        "return_gap_days",
        "days_since_discharge",
        "is_readmitted_30d",
    )


@query
def vitals_summary(spark, sf):
    return feeds.vitals_summary(g.vitals_silver(spark, sf))


@query
def vitals_by_patient(spark, sf):
    return feeds.vitals_summary(g.vitals_silver(spark, sf), "patient_id")


@query
def encounter_summary(spark, sf):
    return feeds.encounter_summary(g.encounter_feed_silver(spark, sf))


@query
def encounters_by_type(spark, sf):
    return feeds.encounter_summary(g.encounter_feed_silver(spark, sf), "encounter_type")


@query
def encounters_by_patient(spark, sf):
    return feeds.encounter_summary(g.encounter_feed_silver(spark, sf), "patient_id")


@query
def file_ledger(spark, sf):
    return tables.file_ledger(filed_events(spark, sf), "SUCCESS")


@query
def serving_kpis(spark, sf):
    return serving.serving_kpis(patient_360_table(spark, sf), gaps(spark, sf), scorecard(spark, sf))


@query
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(g.read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---- sequences and tables -----------------------------------------------------------------------------


@query
def latest_per_key(spark, sf):
    return tables.state_updates(stays(spark, sf))


@query
def latest_by_natural_key(spark, sf):
    latest = sequence.latest_by_natural_key(g.measure_log(spark, sf), ["ENCOUNTER", "CODE"])
    fields = [F.col("payload").getItem(f).alias(f) for f in ("ENCOUNTER", "CODE", "VALUE", "DATE")]
    return latest.select("record_key", "record_hash", "kafka_offset", *fields)


@query
def event_dedup(spark, sf):
    unique = sequence.dedup_events(g.vitals_bronze(spark, sf))
    return unique.select("event_id", "kafka_offset", "heart_rate")


@query
def balanced_top_n(spark, sf):
    top = sequence.balanced_top_n(patient_360_table(spark, sf))
    rank = serving.band_order(F.col("risk_band")).alias("band_order")
    return top.select("patient_id", "risk_band", "risk_score", rank)


@query
def dedup_by_key(spark, sf):
    rows = g.read(spark, sf, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return sequence.dedup_by_key(rows, keys, [c for c in rows.columns if c not in keys])


@query
def upsert_merge(spark, sf):
    target, source = old_and_new(spark, sf)
    return tables.merge_upsert(target, source, ["encounter_id"])


@query
def upsert_nullsafe(spark, sf):
    n = F.col("c_custkey")
    rows = g.read(spark, sf, "customer").select(
        F.when(n % 10 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(n % 7 != 0, F.col("c_nationkey")).alias("nation"),
        "c_acctbal",
    )

    def summed(part: DataFrame, origin: str) -> DataFrame:
        return part.groupBy("segment", "nation").agg(
            F.count(F.lit(1)).alias("customers"), F.lit(origin).alias("origin")
        )

    target = summed(rows.where(F.col("c_acctbal") < 9000), "target")
    source = summed(rows.where(F.col("c_acctbal") > 8000), "source")
    return tables.merge_upsert(target, source, ["segment", "nation"], null_safe=True)


@query
def upsert_conditional(spark, sf):
    rows = stays(spark, sf)
    target = tables.state_updates(rows.where(F.col("diagnosis_code") != "O"))
    source = tables.state_updates(rows.where(F.col("diagnosis_code") == "O"))
    return tables.upsert_if_newer(target, source, ["patient_id"], "last_admission_date")


# ---- streaming ------------------------------------------------------------------------------------------


def fresh_run(spark: SparkSession, name: str) -> str:
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    return f"{work_dir(spark)}/cohortflow/{spark.sparkContext.applicationId}/{name}-{stamp}"


@query
def event_bronze(spark, sf):
    return g.vitals_bronze(spark, sf).drop("raw_payload")


@query
def incremental_slice_(spark, sf):
    part = incremental_slice(g.read(spark, sf, "events"), "event_id", 2000, 5000)
    return part.select("event_id", "user_id", "event_type")


def _table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    schema = g.read(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@query
def micro_batch_silver(spark, sf):
    """The encounter stream run to its end in two batches, the second after a restart, then Silver read back."""
    root = fresh_run(spark, "medallion")
    orders = g.read(spark, sf, "orders")
    patients, *by_patient = g.patient_features(spark, sf)
    known = Features(patients, g.encounter_features(spark, sf), by_patient)
    for part in (0, 1):
        orders.where(F.col("o_orderkey") % 2 == part).write.mode("append").parquet(f"{root}/landed")
        raw = g.damaged(spark.readStream.schema(orders.schema).parquet(f"{root}/landed"))
        half = (F.col("ROW_NUMBER") % 2).cast("string")
        stream = raw.select(
            *canonicalise(raw),
            F.lit("file").alias("source_system"),
            F.concat(F.lit("orders-"), F.substring("DATE", 1, 4), F.lit("-"), half, F.lit(".csv")).alias("source_file"),
        )
        now = datetime(2024, 2, 1 + part, tzinfo=timezone.utc)
        run_medallion(stream, Tables(root), known, f"{root}/checkpoint", now=now).awaitTermination()
    columns = (
        "encounter_id",
        "patient_id",
        "condition_name",
        "los_days",
        "discharge_date",
        "unique_medications",
        "observation_count",
        "allergy_count",
        "hospital_id",
        "quality_status",
        "quality_warning_count",
    )
    return silver_now(spark, Tables(root)).select(*columns)


@query
def domain_router(spark, sf):
    """The log stream routed to its end, then the routes counted."""
    root = fresh_run(spark, "router")
    events = _table_stream(spark, sf, "events")
    query = run_router(g.as_domain_log(events), root, f"{root}/checkpoint")
    query.awaitTermination()
    bronze = spark.read.parquet(f"{root}/bronze")
    return bronze.groupBy("route", "validation_error").agg(F.count(F.lit(1)).alias("records"))


# ---- serving ---------------------------------------------------------------------------------------------


@query
def kpi_summary(spark, sf):
    return serving.kpi_summary(patient_360_table(spark, sf))


@query
def risk_distribution(spark, sf):
    return serving.risk_distribution(patient_360_table(spark, sf))


@query
def top_patients(spark, sf):
    return serving.top_patients(patient_360_table(spark, sf), 100)


@query
def top_conditions(spark, sf):
    return serving.top_conditions(metrics(spark, sf), "total_encounters", 100)


@query
def riskiest_conditions(spark, sf):
    return serving.top_conditions(metrics(spark, sf), "avg_readmission_risk_score", 8)


@query
def care_gap_counts(spark, sf):
    return serving.care_gap_counts(gaps(spark, sf))


@query
def care_gap_actions(spark, sf):
    return serving.care_gap_counts(gaps(spark, sf), "recommended_action", 8)


@query
def top_care_gaps(spark, sf):
    return serving.top_care_gaps(gaps(spark, sf), 500)


@query
def recent_audit(spark, sf):
    return serving.recent_audit(audit(spark, sf), 10)


@query
def top_demographics(spark, sf):
    return serving.top_demographics(groups(spark, sf), 30)


@query
def pair_labels(spark, sf):
    return serving.pair_labels(pairs(spark, sf))


@query
def vitals_worklist(spark, sf):
    return serving.vitals_worklist(feeds.vitals_summary(g.vitals_silver(spark, sf), "patient_id"))


@query
def encounter_worklist(spark, sf):
    return serving.encounter_worklist(
        feeds.encounter_summary(g.encounter_feed_silver(spark, sf), "patient_id")
    )


@query
def worklist_search(spark, sf):
    return serving.worklist_search(patient_360_table(spark, sf), ["HIGH", "MEDIUM"], "Medication", 50)


@query
def abnormal_split(spark, sf):
    return serving.abnormal_split(feeds.vitals_summary(g.vitals_silver(spark, sf)))


@query
def dashboard_totals(spark, sf):
    return serving.dashboard_totals(
        metrics(spark, sf), groups(spark, sf), patient_360_table(spark, sf), audit(spark, sf)
    )
