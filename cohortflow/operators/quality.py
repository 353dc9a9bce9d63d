"""Validation rules as data, quarantine, audits, scorecards and check suites."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scores import first_match, flag, joined, percentage
from ..functions.text import blank, present
from .skew import salted_join


@dataclass(frozen=True)
class Rule:
    """A failure code and the predicate that raises it (NULL counts as "not raised")."""

    code: str
    predicate: Column


def is_blank(column: str, code: str) -> Rule:
    return Rule(code, blank(F.col(column)))


def out_of_range(column: str, low: float, high: float, code: str) -> Rule:
    return Rule(code, ~F.col(column).between(low, high))


# ---- rule sets; codes and limits are fixed values ---------------------------------------

UNRESOLVED_REFERENCE = "ERR_UNRESOLVED_PATIENT_REFERENCE"

CLINICAL_RANGES = (
    ("heart_rate", 20, 250, "INVALID_HEART_RATE"),
    ("systolic_bp", 50, 260, "INVALID_SYSTOLIC_BP"),
    ("diastolic_bp", 30, 180, "INVALID_DIASTOLIC_BP"),
    ("temperature", 30, 45, "INVALID_TEMPERATURE"),
)


def raw_rules(now: Column) -> list[Rule]:
    admitted = F.col("admission_date")
    return [
        is_blank("encounter_id", "ERR_MISSING_ENCOUNTER_ID"),
        is_blank("patient_id", "ERR_MISSING_PATIENT_ID"),
        Rule("ERR_MISSING_OR_INVALID_DATE", admitted.isNull()),
        Rule("ERR_FUTURE_DATE", admitted > now),
        is_blank("diagnosis_code", "ERR_MISSING_CODE"),
    ]


def clinical_error_rules() -> list[Rule]:
    return [
        is_blank("encounter_id", "ERR_MISSING_ENCOUNTER_ID"),
        is_blank("patient_id", "ERR_MISSING_PATIENT_ID"),
        Rule("ERR_MISSING_ADMISSION_DATE", F.col("admission_date").isNull()),
        is_blank("diagnosis_code", "ERR_MISSING_ICD10"),
        Rule("ERR_CHRONO_FLOW", F.col("discharge_date") <= F.col("admission_date")),
    ]


def clinical_warning_rules() -> list[Rule]:
    def unknown(column: str) -> Column:
        return F.col(column).isNull() | (F.col(column) == "UNKNOWN")

    def none_counted(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(0)) <= 0

    return [
        Rule("WARN_MISSING_BMI", F.col("bmi").isNull()),
        Rule("WARN_MISSING_BP", F.col("systolic_bp").isNull() | F.col("diastolic_bp").isNull()),
        Rule("WARN_MISSING_DEMOGRAPHICS", unknown("gender") | unknown("race")),
        Rule("WARN_MISSING_MEDICATION_CONTEXT", none_counted("unique_medications")),
        Rule("WARN_MISSING_CONDITION_CONTEXT", none_counted("condition_count")),
        Rule("WARN_MISSING_OBSERVATION_CONTEXT", none_counted("observation_count")),
    ]


def _event_time_rules(now: Column) -> list[Rule]:
    return [
        Rule("INVALID_EVENT_TIMESTAMP", F.col("event_timestamp").isNull()),
        Rule("FUTURE_EVENT_TIMESTAMP", F.col("event_timestamp") > now),
    ]


def vitals_rules(now: Column) -> list[Rule]:
    return [
        is_blank("event_id", "MISSING_EVENT_ID"),
        is_blank("patient_id", "MISSING_PATIENT_ID"),
        *_event_time_rules(now),
        *[out_of_range(*limits) for limits in CLINICAL_RANGES],
    ]


def encounter_event_rules(now: Column) -> list[Rule]:
    return [
        is_blank("event_id", "MISSING_EVENT_ID"),
        is_blank("encounter_id", "MISSING_ENCOUNTER_ID"),
        is_blank("patient_id", "MISSING_PATIENT_ID"),
        is_blank("encounter_type", "MISSING_ENCOUNTER_TYPE"),
        *_event_time_rules(now),
        Rule("NEGATIVE_LENGTH_OF_STAY", F.col("length_of_stay_hours") < 0),
    ]


def outgoing_event_rules() -> list[Rule]:
    return [
        is_blank("encounter_id", "MISSING_ENCOUNTER_ID"),
        is_blank("patient_id", "MISSING_PATIENT_ID"),
        is_blank("event_timestamp", "INVALID_EVENT_TIMESTAMP"),
        is_blank("diagnosis_code", "MISSING_DIAGNOSIS_CODE"),
    ]


# ---- tagging and splitting ---------------------------------------------------------------


def tag_rules(df: DataFrame, rules: Iterable[Rule], out: str = "failure_reasons") -> DataFrame:
    """Every failing code, joined; empty text marks a clean row."""
    return df.withColumn(out, joined([(r.predicate, r.code) for r in rules]))


def first_error(df: DataFrame, rules: Iterable[Rule], out: str = "validation_error") -> DataFrame:
    """Only the first failing code; NULL marks a valid row."""
    return df.withColumn(out, first_match([(r.predicate, r.code) for r in rules]))


def clinical_gate(df: DataFrame) -> DataFrame:
    """Hard errors and warnings side by side, with the warning count, in one projection."""
    errors, warnings = clinical_error_rules(), clinical_warning_rules()
    return df.withColumns(
        {
            "failure_reasons": joined([(r.predicate, r.code) for r in errors]),
            "quality_warning_codes": joined([(r.predicate, r.code) for r in warnings]),
            "quality_warning_count": reduce(
                lambda a, b: a + b, [flag(r.predicate) for r in warnings]
            ),
        }
    )


def warning_status(df: DataFrame, count: str = "quality_warning_count") -> DataFrame:
    return df.withColumn(
        "quality_status",
        F.when(F.col(count) > 0, F.lit("VALID_WITH_WARNINGS")).otherwise(F.lit("VALID")),
    )


def tag_reference(
    df: DataFrame,
    reference: DataFrame,
    key: str,
    code: str = UNRESOLVED_REFERENCE,
    out: str = "failure_reasons",
    **skew,
) -> DataFrame:
    """Add ``code`` to rows whose non-blank key is absent from the reference keys."""
    known = reference.select(key).distinct().withColumn("_known", F.lit(True))
    lost = present(F.col(key)) & F.col("_known").isNull()
    earlier = F.nullif(F.col(out), F.lit(""))
    return (
        salted_join(df, known, [key], "left", **skew)
        .withColumn(out, F.concat_ws(", ", earlier, F.when(lost, F.lit(code))))
        .drop("_known")
    )


def split_tagged(
    df: DataFrame, reason: str, stage: str, now: Column
) -> tuple[DataFrame, DataFrame]:
    """Clean rows and quarantine rows of one tagged frame."""
    clean = df.where(blank(F.col(reason))).drop(reason)
    bad = (
        df.where(present(F.col(reason)))
        .withColumnRenamed(reason, "quarantine_reason")
        .withColumns({"quality_stage": F.lit(stage), "quarantined_at": now})
    )
    return clean, bad


def tag_source_rows(
    df: DataFrame, required: Sequence[str], out: str = "source_error"
) -> DataFrame:
    """Reject rows that repeat the header or lack a required field."""
    echoes = reduce(
        lambda a, b: a | b,
        [F.coalesce(F.col(c) == c, F.lit(False)) for c, t in df.dtypes if t == "string"],
    )
    lacking = F.concat_ws(",", *[F.when(blank(F.col(c)), F.lit(c)) for c in required])
    return df.withColumn(
        out,
        F.when(echoes, F.lit("embedded_csv_header"))
        .when(lacking != "", F.concat(F.lit("missing_required_fields:"), lacking))
        .otherwise(F.lit("")),
    )


# ---- scorecards, audits, checks ------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """A table with its key columns and its date column, for the completeness scorecard."""

    name: str
    df: DataFrame
    required: Sequence[str]
    date_column: str
    corrupt_column: str | None = None


def completeness(spec: TableSpec) -> DataFrame:
    complete = reduce(lambda a, b: a & b, [present(F.col(c).cast("string")) for c in spec.required])
    if spec.corrupt_column:
        complete = complete & F.col(spec.corrupt_column).isNull()
    dated = F.col(spec.date_column).try_cast("date").isNotNull()

    def counted(condition: Column) -> Column:
        return F.count(F.when(condition, F.lit(1)))

    return spec.df.agg(
        F.count(F.lit(1)).alias("total_records"),
        counted(complete).alias("complete_key_records"),
        counted(dated).alias("valid_date_records"),
        counted(complete & dated).alias("trusted_records"),
    ).select(F.lit(spec.name).alias("table_name"), "*")


def scorecard(specs: Iterable[TableSpec]) -> DataFrame:
    """One row per table: key completeness, date validity and trust.

    ``trust_score_pct`` is the lower of the two marginal shares; ``row_trust_pct``
    counts the rows that pass both.
    """
    total = F.col("total_records")
    lower = F.least("complete_key_records", "valid_date_records")
    return reduce(DataFrame.unionByName, [completeness(s) for s in specs]).select(
        "table_name",
        "total_records",
        "complete_key_records",
        "valid_date_records",
        percentage(F.col("complete_key_records"), total).alias("completeness_pct"),
        percentage(F.col("valid_date_records"), total).alias("date_validity_pct"),
        percentage(lower, total).alias("trust_score_pct"),
        percentage(F.col("trusted_records"), total).alias("row_trust_pct"),
    )


def batch_audit(metrics: DataFrame) -> DataFrame:
    """Rates, status and reconciliation for rows of batch counts.

    Expects ``source_records_read``, ``silver_records_written``,
    ``quarantine_records_written``, ``warning_records``, ``duplicate_records_skipped``
    and ``duration_seconds``; other columns pass through.
    """
    total, silver = F.col("source_records_read"), F.col("silver_records_written")
    bad, seconds = F.col("quarantine_records_written"), F.col("duration_seconds")
    accounted = silver + bad + F.col("duplicate_records_skipped")
    return metrics.withColumns(
        {
            "hard_failure_records": bad,
            "pass_rate_pct": percentage(total - bad, total),
            "validation_pass_rate_pct": percentage(total - bad, total),
            "warning_rate_pct": percentage(F.col("warning_records"), silver),
            "status": F.when(bad == 0, F.lit("SUCCESS")).otherwise(F.lit("ANOMALIES_ISOLATED")),
            "throughput_rows_per_second": F.round(
                F.when(seconds > 0, total / seconds).otherwise(F.lit(0.0)), 2
            ),
            "reconciliation_status": F.when(total == accounted, F.lit("PASS")).otherwise(
                F.lit("FAIL")
            ),
        }
    )


def stream_audit(
    silver: DataFrame, quarantine: DataFrame, duplicates: DataFrame | Column, audit: DataFrame
) -> DataFrame:
    """Audit row of a live feed, numbered after the latest batch on record.

    ``duplicates`` holds the re-delivered rows that were dropped, or is their number, so the row
    reconciles against what was read.
    """

    def one(df: DataFrame, expr: Column) -> Column:
        return df.agg(expr).scalar()

    n_silver = one(silver, F.count(F.lit(1)))
    n_bad = one(quarantine, F.count(F.lit(1)))
    n_dup = duplicates if isinstance(duplicates, Column) else one(duplicates, F.count(F.lit(1)))
    latest = audit.agg(F.coalesce(F.max("batch_id"), F.lit(0)).alias("latest"))
    counted = latest.select(
        (F.col("latest") + 1).cast("bigint").alias("batch_id"),
        n_silver.alias("silver_records_written"),
        n_bad.alias("quarantine_records_written"),
        n_dup.alias("duplicate_records_skipped"),
    )
    return batch_audit(
        counted.withColumns(
            {
                "source_records_read": F.col("silver_records_written")
                + F.col("quarantine_records_written")
                + F.col("duplicate_records_skipped"),
                "warning_records": F.lit(0).cast("bigint"),
                "duration_seconds": F.lit(0.0),
            }
        )
    )


@dataclass(frozen=True)
class Check:
    """A named check: one aggregate over a table, and the test its value has to pass."""

    name: str
    df: DataFrame
    measure: Column
    label: str
    test: object  # Column -> Column


def run_checks(checks: Iterable[Check]) -> DataFrame:
    """``check_name, passed, details`` per check; checks of one table share one scan."""
    tables: dict[int, list[Check]] = {}
    for c in checks:
        tables.setdefault(id(c.df), []).append(c)
    results = []
    for group in tables.values():
        measured = group[0].df.agg(
            *[c.measure.cast("bigint").alias(f"v{i}") for i, c in enumerate(group)]
        )
        verdicts = [
            F.struct(
                F.lit(c.name).alias("check_name"),
                c.test(F.col(f"v{i}")).alias("passed"),
                F.concat(F.lit(f"{c.label}="), F.col(f"v{i}").cast("string")).alias("details"),
            )
            for i, c in enumerate(group)
        ]
        results.append(measured.select(F.inline(F.array(*verdicts))))
    return reduce(DataFrame.unionByName, results)


def feed_checks(
    bronze: DataFrame,
    silver: DataFrame,
    quarantine: DataFrame,
    summary: DataFrame,
    by_patient: DataFrame,
) -> list[Check]:
    """The seven post-load checks of a live feed; the range checked is that of its own measure."""
    rows = F.count(F.lit(1))
    loaded = silver.select(F.lit(-1).alias("w")).unionAll(quarantine.select(F.lit(-1).alias("w")))
    margin = bronze.select(F.lit(1).alias("w")).unionAll(loaded)
    rate_low, rate_high = CLINICAL_RANGES[0][1], CLINICAL_RANGES[0][2]

    def counted(p: Column) -> Column:
        return F.count(F.when(p, F.lit(1)))

    repeated = silver.groupBy("event_id").agg(rows.alias("n")).where("n > 1")
    if "heart_rate" in silver.columns:
        ranged = Check(
            "silver_heart_rate_valid",
            silver,
            counted(~F.col("heart_rate").between(rate_low, rate_high)),
            "invalid_heart_rates",
            lambda v: v == 0,
        )
    else:
        ranged = Check(
            "silver_stay_not_negative",
            silver,
            counted(F.col("length_of_stay_hours") < 0),
            "negative_stays",
            lambda v: v == 0,
        )
    return [
        Check("bronze_not_empty", bronze, rows, "bronze_count", lambda v: v > 0),
        Check(
            "silver_plus_quarantine_not_greater_than_bronze",
            margin,
            F.coalesce(F.sum("w"), F.lit(0)),
            "surplus_bronze_rows",
            lambda v: v >= 0,
        ),
        Check("silver_event_id_unique", repeated, rows, "duplicate_event_ids", lambda v: v == 0),
        Check(
            "silver_patient_id_complete",
            silver,
            counted(blank(F.col("patient_id"))),
            "missing_patient_ids",
            lambda v: v == 0,
        ),
        ranged,
        Check("gold_summary_single_row", summary, rows, "gold_summary_rows", lambda v: v == 1),
        Check("gold_patient_not_empty", by_patient, rows, "gold_patient_rows", lambda v: v > 0),
    ]


def require_checks(results: DataFrame) -> None:
    """Action: raise when any check failed (the result holds one row per check)."""
    failed = [r["check_name"] for r in results.where(~F.col("passed")).collect()]
    if failed:
        raise RuntimeError(f"{len(failed)} checks failed: {', '.join(sorted(failed))}")


QUALITY_TARGET_PCT = 95.0


def quality_gate(audit: DataFrame, threshold: float = QUALITY_TARGET_PCT) -> DataFrame:
    """Latest audit row (by time, then batch) with its verdict against the target."""
    return (
        audit.orderBy(F.col("execution_timestamp").desc(), F.col("batch_id").desc())
        .limit(1)
        .select(
            "batch_id",
            "execution_timestamp",
            "pass_rate_pct",
            F.lit(threshold).alias("threshold_pct"),
            (F.col("pass_rate_pct") >= threshold).alias("gate_passed"),
        )
    )


def require_quality(audit: DataFrame, threshold: float = QUALITY_TARGET_PCT) -> None:
    """Action: raise when the latest batch is below the target."""
    row = quality_gate(audit, threshold).first()
    if row is not None and not row["gate_passed"]:
        raise RuntimeError(
            f"batch {row['batch_id']}: pass rate {row['pass_rate_pct']:.2f}% "
            f"is below {threshold:.2f}%"
        )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def counts_frame(spark: SparkSession, values: Mapping[str, object], schema: str) -> DataFrame:
    """One-row frame from driver-side batch metrics."""
    return spark.createDataFrame([dict(values)], schema)
