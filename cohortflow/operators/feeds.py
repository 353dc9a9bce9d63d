"""Live event feeds: flags and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scores import percentage
from ..functions.text import present

# Normal ranges and the long-stay limit.
NORMAL_HEART_RATE = (60, 100)
NORMAL_SYSTOLIC = (90, 140)
NORMAL_DIASTOLIC = (60, 90)
NORMAL_TEMPERATURE = (36.0, 37.5)
LONG_STAY_HOURS = 24
VITAL_MEASURES = ("heart_rate", "systolic_bp", "diastolic_bp", "temperature")


def _outside(column: str, limits: tuple[float, float]) -> Column:
    """True outside the closed range; a NULL value is not abnormal."""
    return F.coalesce(~F.col(column).between(*limits), F.lit(False))


def vital_flags(df: DataFrame) -> DataFrame:
    both = F.col("systolic_bp").isNotNull() & F.col("diastolic_bp").isNotNull()
    pressure = _outside("systolic_bp", NORMAL_SYSTOLIC) | _outside("diastolic_bp", NORMAL_DIASTOLIC)
    flags = {
        "abnormal_heart_rate": _outside("heart_rate", NORMAL_HEART_RATE),
        "abnormal_blood_pressure": both & pressure,
        "abnormal_temperature": _outside("temperature", NORMAL_TEMPERATURE),
    }
    any_flag = F.greatest(*flags.values())
    return df.withColumns({**flags, "has_abnormal_vitals": any_flag})


def encounter_flags(df: DataFrame) -> DataFrame:
    long_stay = F.coalesce(F.col("length_of_stay_hours") >= LONG_STAY_HOURS, F.lit(False))
    emergency = F.lower("encounter_type") == "emergency"
    return df.withColumns(
        {
            "is_long_stay": long_stay,
            "is_emergency": emergency,
            "has_diagnosis": present(F.col("diagnosis_code")),
            "encounter_risk_flag": emergency | long_stay,
        }
    )


def event_summary(
    df: DataFrame,
    total: str,
    flags: Mapping[str, str],
    averages: Mapping[str, str],
    rate: tuple[str, str],
    by: str | None = None,
    distinct: str | None = None,
    latest: bool = True,
) -> DataFrame:
    """Event count, flagged counts, rounded averages, latest time and a guarded rate.

    ``flags`` and ``averages`` map output names to input columns; ``rate`` names the
    percentage and the flagged count it divides by the total.
    """
    measures = [F.count(F.lit(1)).alias(total)]
    measures += [F.count(F.when(F.col(c), F.lit(1))).alias(n) for n, c in flags.items()]
    measures += [F.round(F.avg(c), 2).alias(n) for n, c in averages.items()]
    if distinct:
        measures.append(F.count_distinct("patient_id").alias(distinct))
    if latest:
        measures.append(F.max("event_timestamp").alias("latest_event_time"))
    grouped = df.groupBy(by) if by else df.groupBy()
    name, part = rate
    return grouped.agg(*measures).withColumn(name, percentage(F.col(part), F.col(total)))


def vitals_summary(silver: DataFrame, by: str | None = None) -> DataFrame:
    """Vitals feed overall, or per patient with ``by``."""
    averages = {f"avg_{m}": m for m in VITAL_MEASURES}
    flagged = "abnormal_vitals_events" if by else "abnormal_vitals_count"
    out = event_summary(
        silver,
        "vitals_events" if by else "total_vitals_events",
        {flagged: "has_abnormal_vitals"},
        averages,
        ("abnormal_rate_pct", flagged),
        by=by,
        distinct=None if by else "patients_monitored",
    )
    return out.withColumn("has_abnormal_vitals", F.col(flagged) > 0) if by else out


def encounter_summary(silver: DataFrame, by: str | None = None) -> DataFrame:
    """Encounter feed overall, by ``encounter_type`` or by ``patient_id``."""
    out = event_summary(
        silver,
        "encounters" if by else "total_encounters",
        {
            "emergency_encounters": "is_emergency",
            "long_stay_encounters": "is_long_stay",
            "risk_flagged_encounters": "encounter_risk_flag",
        },
        {"avg_length_of_stay_hours": "length_of_stay_hours"},
        ("risk_flag_rate_pct", "risk_flagged_encounters"),
        by=by,
        distinct=None if by == "patient_id" else "unique_patients",
        latest=by != "encounter_type",
    )
    if by != "patient_id":
        return out
    booleans: Sequence[tuple[str, str]] = (
        ("has_emergency_encounter", "emergency_encounters"),
        ("has_long_stay", "long_stay_encounters"),
        ("has_encounter_risk_flag", "risk_flagged_encounters"),
    )
    return out.withColumns({name: F.col(c) > 0 for name, c in booleans})
