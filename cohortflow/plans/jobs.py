"""The pipeline's jobs: each reads tables, runs operators and writes tables.

Every job writes what several outputs share once and reads it back, so no output re-runs
the plan before it, and a lost executor costs a task, not a job.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.dates import try_timestamp
from ..operators import cohort, features, feeds
from ..operators.envelopes import project_payload, to_dlq
from ..operators.quality import (
    QUALITY_TARGET_PCT,
    TableSpec,
    encounter_event_rules,
    feed_checks,
    first_error,
    quality_gate,
    require_checks,
    run_checks,
    scorecard,
    stream_audit,
    vitals_rules,
)
from ..operators.sequence import dedup_by_key, dedup_events, latest_by_natural_key
from ..operators.serving import Section, serving_kpis, snapshot_sections
from ..sources.files import (
    CORRUPT,
    publish_upsert,
    read_csv_tagged,
    read_optional,
    read_version,
    replace_table,
    register_views,
    write_version,
)
from ..sources.logs import write_log
from ..sources.snapshot import write_snapshot
from ..streaming.medallion import Features, Tables, run_medallion
from .domains import DOMAINS, Domain

# Columns the features read from each raw domain.
DOMAIN_FIELDS = {
    "encounters": ("ID", "PATIENT", "DATE"),
    "patients": ("ID", "GENDER", "RACE", "BIRTHDATE", "DEATHDATE", "SSN"),
    "observations": ("ENCOUNTER", "CODE", "VALUE"),
    "conditions": ("PATIENT", "ENCOUNTER", "DESCRIPTION", "START", "STOP"),
    "medications": ("PATIENT", "CODE", "DESCRIPTION", "START", "STOP"),
    "procedures": ("ENCOUNTER", "CODE", "DESCRIPTION"),
    "careplans": ("ENCOUNTER", "CODE", "DESCRIPTION"),
    "allergies": ("PATIENT", "CODE", "DESCRIPTION"),
    "immunizations": ("PATIENT", "CODE", "DESCRIPTION"),
}
FEATURE_KEYS = {
    "patients": ["patient_id"],
    "observations_by_encounter": ["encounter_id"],
    "conditions_by_encounter": ["encounter_id"],
    "conditions_by_patient": ["patient_id", "condition_name"],
    "medications_by_encounter": ["encounter_id"],
    "procedures_by_encounter": ["encounter_id"],
    "careplans_by_encounter": ["encounter_id"],
    "allergies_by_patient": ["patient_id"],
    "immunizations_by_patient": ["patient_id"],
}


def feature_frames(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Feature tables for the raw domains that exist."""
    out: dict[str, DataFrame] = {}
    if "patients" in raw:
        known = features.patients(raw["patients"]).where(F.col("patient_id").isNotNull())
        tie = [c for c in known.columns if c != "patient_id"]
        out["patients"] = dedup_by_key(known, ["patient_id"], tie)
    if "conditions" in raw:
        out["conditions_by_encounter"] = features.condition_features(raw["conditions"])
        out["conditions_by_patient"] = features.first_onset(raw["conditions"])
    if "medications" in raw and "encounters" in raw:
        dated = raw["encounters"].select(
            F.col("ID").alias("encounter_id"),
            F.col("PATIENT").alias("patient_id"),
            try_timestamp(F.col("DATE")).alias("admission_date"),
        )
        unique = dedup_by_key(dated, ["encounter_id"], ["patient_id", "admission_date"])
        out["medications_by_encounter"] = features.medication_features(unique, raw["medications"])
    per_key = {
        "observations": ("observations_by_encounter", features.observation_features),
        "procedures": ("procedures_by_encounter", features.procedure_features),
        "careplans": ("careplans_by_encounter", features.careplan_features),
        "allergies": ("allergies_by_patient", features.allergy_features),
        "immunizations": ("immunizations_by_patient", features.immunization_features),
    }
    for domain, (name, build) in per_key.items():
        if domain in raw:
            out[name] = build(raw[domain])
    return out


def prepare_features(raw: Mapping[str, DataFrame], root: str, version: int = 0) -> list[str]:
    """Write all feature tables from raw domains; returns their names."""
    frames = feature_frames(raw)
    for name, frame in frames.items():
        write_version(frame, f"{root}/{name}", version)
    return list(frames)


def completeness_table(raw: Mapping[str, DataFrame], path: str) -> None:
    """Scorecard over the raw domains that exist."""
    specs = [
        TableSpec(name, raw[name], domain.required, domain.date_column)
        for name, domain in DOMAINS.items()
        if name in raw
    ]
    replace_table(scorecard(specs), path)


def refresh_domain_silver(
    spark: SparkSession, bronze: str, root: str, domains: Mapping[str, Domain] = DOMAINS
) -> list[str]:
    """Latest record per natural key of each routed domain; returns the domains found."""
    routed = read_optional(spark, bronze)
    if routed is None:
        return []
    present = {r["route"] for r in routed.select("route").distinct().collect()}
    done = [d for d in domains if d in present]
    for name in done:
        rows = routed.where(F.col("route") == name).drop("raw_value", "validation_error")
        replace_table(latest_by_natural_key(rows, domains[name].natural_key), f"{root}/{name}")
    return done


def refresh_features(spark: SparkSession, silver: str, root: str) -> list[str]:
    """Upsert feature tables from domain Silver, kept in buckets of their keys (see ``read_buckets``).

    Rows that vanish upstream stay; only buckets with keys that the source holds are rewritten, and a repeated
    call leaves the same tables.
    """
    raw = {}
    for domain, fields in DOMAIN_FIELDS.items():
        table = read_optional(spark, f"{silver}/{domain}")
        if table is not None:
            raw[domain] = project_payload(table, fields)
    frames = feature_frames(raw)
    for name, frame in frames.items():
        publish_upsert(frame, f"{root}/{name}", FEATURE_KEYS[name])
    return list(frames)


def rebuild_gold(
    silver: DataFrame,
    root: str,
    patients: DataFrame | None = None,
    history: DataFrame | None = None,
) -> list[str]:
    """All population tables from Silver; the scored encounters are written once."""
    spark = silver.sparkSession
    replace_table(cohort.score_encounters(silver), f"{root}/scored")
    scored = spark.read.parquet(f"{root}/scored")
    replace_table(cohort.explode_labels(scored), f"{root}/labels")
    labels = spark.read.parquet(f"{root}/labels")
    outputs = {
        "clinical_metrics": cohort.condition_metrics(scored),
        "demographics": cohort.demographics(scored),
        "patient_360": cohort.patient_360(scored),
        "care_gaps": cohort.care_gap_worklist(scored),
        "comorbidity_pairs": cohort.comorbidity_pairs(labels),
        "return_gaps": cohort.return_gaps(scored),
    }
    if patients is not None and history is not None:
        outputs["disease_rankings"] = cohort.disease_rankings(
            history, scored.select("patient_id"), patients
        )
    for name, frame in outputs.items():
        replace_table(frame, f"{root}/{name}")
    return list(outputs)


GOLD_SECTIONS = {
    "metrics": "clinical_metrics",
    "demographics": "demographics",
    "patient_360": "patient_360",
    "care_gaps": "care_gaps",
    "pairs": "comorbidity_pairs",
    "return_gaps": "return_gaps",
    "rankings": "disease_rankings",
}


def publish_snapshot(
    spark: SparkSession,
    gold: str,
    audit: str,
    scores: str,
    path: str,
    now: Column,
    limits: Mapping[str, int] | None = None,
    patients_per_band: int | None = None,
) -> list[str]:
    """JSON sections and headline numbers for a dashboard, whole where no limit is given.

    The manifest tells of each section how many rows there are and how many were written.
    """
    found = {k: read_optional(spark, f"{gold}/{t}") for k, t in GOLD_SECTIONS.items()}
    if found["metrics"] is None:
        raise FileNotFoundError(f"no population tables under {gold}")
    found["audit"] = read_optional(spark, audit)
    sections = snapshot_sections(found, limits or {}, patients_per_band)
    card = read_optional(spark, scores)
    if found["patient_360"] is not None and found["care_gaps"] is not None and card is not None:
        kpis = serving_kpis(found["patient_360"], found["care_gaps"], card)
        sections["kpis"] = Section(kpis, kpis)
    write_snapshot(sections, path, now)
    return sorted(sections)


def register_outputs(spark: SparkSession, gold: str, ops: Mapping[str, str]) -> list[str]:
    """Views over the population tables and the operational tables that exist."""
    tables = {t: f"{gold}/{t}" for t in GOLD_SECTIONS.values()}
    return register_views(spark, {**tables, **ops})


# Feed name -> its flags, its rules, its topic (fixed values) and its summaries.
FEEDS = {
    "vitals": (
        feeds.vital_flags,
        vitals_rules,
        "clinical-vitals",
        {"summary": (feeds.vitals_summary, None), "by_patient": (feeds.vitals_summary, "patient_id")},
    ),
    "encounters": (
        feeds.encounter_flags,
        encounter_event_rules,
        "clinical-encounters",
        {
            "summary": (feeds.encounter_summary, None),
            "by_type": (feeds.encounter_summary, "encounter_type"),
            "by_patient": (feeds.encounter_summary, "patient_id"),
        },
    ),
}


def refresh_feed(
    bronze: DataFrame,
    feed: str,
    root: str,
    now: Column,
    version: int,
    dlq_format: str = "json",
    dlq_options: Mapping[str, str] | None = None,
    require: bool = True,
) -> None:
    """Silver, quarantine, summaries, new dead letters, audit and checks of a live feed.

    The run fails if a check does, after everything is written, verdicts and their time too; a run that is repeated under
    its version writes the same again. Without ``require`` the verdicts are written only.

    Only rejections whose log position was not in the version before are sent out, so a
    refresh does not publish the whole quarantine again.
    """
    spark = bronze.sparkSession
    flags, rules, topic, summaries = FEEDS[feed]
    checked = f"{root}/checked"
    before = read_version(spark, checked, below=version)
    known = before.where("validation_error is not null") if before is not None else None
    place = ["kafka_topic", "kafka_partition", "kafka_offset"]

    write_version(first_error(flags(dedup_events(bronze)), rules(now)), checked, version)
    latest = spark.read.parquet(f"{checked}/version={int(version)}")
    silver = latest.where("validation_error is null").drop("validation_error")
    rejected = latest.where("validation_error is not null")
    new = rejected if known is None else rejected.join(known.select(*place), place, "left_anti")
    letters = to_dlq(new, topic, feed, now, reason="validation_error")
    write_log(letters, dlq_format, dlq_options or {}, f"{root}/dlq/version={int(version)}")
    for name, (build, by) in summaries.items():
        replace_table(build(silver, by).withColumn("gold_processed_at", now), f"{root}/{name}")

    rows = F.count(F.lit(1))
    on_record = read_optional(spark, f"{root}/audit")
    on_record = spark.createDataFrame([], "batch_id bigint") if on_record is None else on_record.where(F.col("version") < version)
    repeats = bronze.agg(rows).scalar() - latest.agg(rows).scalar()
    told = stream_audit(silver, rejected, repeats, on_record).withColumn("execution_timestamp", now)
    replace_table(told, f"{root}/audit/version={int(version)}")
    summary, by_patient = (spark.read.parquet(f"{root}/{name}") for name in ("summary", "by_patient"))
    checks = run_checks(feed_checks(bronze, silver, rejected, summary, by_patient))
    write_verdicts(checks, f"{root}/checks/version={int(version)}", now, require)


def write_verdicts(results: DataFrame, path: str, now: Column, require: bool = True) -> None:
    """Check results with the time they were made, written; then the run fails if one of them did."""
    replace_table(results.withColumn("checked_at", now), path)
    if require:
        require_checks(results.sparkSession.read.parquet(path))


def gate_batches(spark: SparkSession, audit: str, path: str, now: Column, threshold: float = QUALITY_TARGET_PCT) -> None:
    """The latest batch's verdict against the quality target, written; then the run fails if the batch did."""
    batches = read_optional(spark, audit)
    if batches is None:
        raise FileNotFoundError(f"no batch on record under {audit}")
    replace_table(quality_gate(batches, threshold).withColumn("checked_at", now), path)
    verdict = spark.read.parquet(path).withColumnRenamed("gate_passed", "passed")
    details = F.concat(F.lit("pass_rate_of_batch_"), F.col("batch_id").cast("string"))
    require_checks(verdict.select(details.alias("check_name"), "passed"))


def load_encounters(
    stream: DataFrame, tables: Tables, known: Features, checkpoint: str, now: Column, threshold: float = QUALITY_TARGET_PCT, **options
) -> None:
    """Run the encounter stream to the end of what is there, then hold its latest batch against the target.

    What the batches wrote stays when the run fails, and so does the verdict under ``gate``; running it again
    reads new files only and judges the latest batch anew.
    """
    run_medallion(stream, tables, known, checkpoint, **options).awaitTermination()
    gate_batches(stream.sparkSession, tables.audit, f"{tables.root}/gate", now, threshold)


# ---- files to features ----------------------------------------------------------------------------


def land_files(spark: SparkSession, folder: str, root: str, version: int, now: Column, domains: Mapping[str, Domain] = DOMAINS) -> DataFrame:
    """CSV files of each domain's folder written as tables, readable and malformed rows apart, in one scan of each.

    Returns (domain, read, malformed), gathered by the writes. A domain without files is left out; so is
    what an earlier try of the version wrote.
    """
    counts = []
    for name in domains:
        fields = list(dict.fromkeys([*DOMAIN_FIELDS[name], *domains[name].required]))
        found = read_csv_tagged(spark, f"{folder}/{name}", fields)
        if found is None:
            continue
        seen = Observation()
        bad = F.col(CORRUPT).isNotNull()
        line = F.when(bad, F.lit("malformed")).otherwise(F.lit("readable"))
        tagged = found.select("*", line.alias("line"), F.when(bad, now).alias("quarantine_timestamp"))
        told = tagged.observe(seen, F.count(F.lit(1)).alias("read"), F.count(F.when(bad, 1)).alias("malformed"))
        told.write.mode("overwrite").partitionBy("line").parquet(f"{root}/{name}/version={int(version)}")
        counts.append((name, seen.get["read"], seen.get["malformed"]))
    return spark.createDataFrame(counts, "domain string, read bigint, malformed bigint")


def files_to_features(spark: SparkSession, folder: str, root: str, version: int, now: Column) -> list[str]:
    """From folders of CSV files, ``<folder>/<domain>``, to feature tables of a new version.

    Landed rows, malformed ones among them, lie under ``landed``, their counts and the scorecard of the
    readable rows under ``scores``, features under ``features``. Everything carries the version, so a
    repeated call writes the same again.
    """
    counts = land_files(spark, folder, f"{root}/landed", version, now)
    raw = {}
    for name in (r["domain"] for r in counts.collect()):  # one row per domain
        landed = spark.read.parquet(f"{root}/landed/{name}/version={int(version)}")
        raw[name] = landed.where("line = 'readable'").drop("line", CORRUPT, "quarantine_timestamp")
    if not raw:
        raise FileNotFoundError(f"no files of any domain under {folder}")
    replace_table(counts.withColumn("counted_at", now), f"{root}/scores/rows/version={int(version)}")
    completeness_table(raw, f"{root}/scores/completeness/version={int(version)}")
    return prepare_features(raw, f"{root}/features", version)
