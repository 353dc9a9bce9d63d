"""Serving queries: bounded reads over the population tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import gap_order, rank_of
from ..functions.scores import BAND_ORDER
from ..functions.text import short_labels
from .sequence import balanced_top_n


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Sorted head; each task keeps k rows, nothing is sorted as a whole."""
    return df.orderBy(*order).limit(k)


def band_order(col: Column) -> Column:
    return rank_of(col, BAND_ORDER)


def kpi_summary(p360: DataFrame) -> DataFrame:
    high = F.upper("risk_band") == "HIGH"
    return p360.agg(
        F.count_distinct("patient_id").alias("patients_monitored"),
        F.count(F.when(high, F.lit(1))).alias("high_risk_patients"),
        F.round(F.avg("risk_score"), 2).alias("avg_risk_score"),
    )


def risk_distribution(p360: DataFrame) -> DataFrame:
    band = F.coalesce(F.col("risk_band"), F.lit("UNKNOWN"))
    return p360.groupBy(band.alias("risk_band")).agg(F.count(F.lit(1)).alias("patient_count"))


TOP_PATIENT_COLUMNS = (
    "patient_id",
    "risk_score",
    "risk_band",
    "risk_reasons",
    "condition_names",
    "suggested_focus",
)


def top_patients(p360: DataFrame, k: int = 100) -> DataFrame:
    head = p360.select(*TOP_PATIENT_COLUMNS)
    return top_k(head, [F.col("risk_score").desc(), F.col("patient_id")], k)


def top_conditions(metrics: DataFrame, by: str = "total_encounters", k: int = 100) -> DataFrame:
    columns = (
        "condition_name",
        "total_encounters",
        "readmission_rate",
        "avg_readmission_risk_score",
        "high_risk_patients",
    )
    return top_k(metrics.select(*columns), [F.col(by).desc(), F.col("condition_name")], k)


def care_gap_counts(gaps: DataFrame, by: str = "care_gap_severity", k: int = 8) -> DataFrame:
    value = F.coalesce(F.col(by), F.lit("UNKNOWN"))
    counted = gaps.groupBy(value.alias(by)).agg(F.count(F.lit(1)).alias("gap_count"))
    return top_k(counted, [F.col("gap_count").desc(), F.col(by)], k)


def top_care_gaps(gaps: DataFrame, k: int = 500) -> DataFrame:
    order = [
        F.col("readmission_risk_score").desc(),
        F.col("care_gap_severity"),
        F.col("patient_id"),
    ]
    return top_k(gaps, order, k)


def recent_audit(audit: DataFrame, k: int = 100) -> DataFrame:
    order = [F.col("execution_timestamp").desc(), F.col("batch_id").desc()]
    return top_k(audit, order, k)


def top_diseases(rankings: DataFrame, by: str = "affected_patients", k: int = 15) -> DataFrame:
    return top_k(rankings, [F.col(by).desc(), F.col("condition_name")], k)


def top_demographics(groups: DataFrame, k: int = 30) -> DataFrame:
    order = [F.col("unique_patients").desc(), "race", "gender", "age_group"]
    return top_k(groups, order, k)


def pair_labels(pairs: DataFrame, width: int = 38, k: int = 12) -> DataFrame:
    """Top pairs as one "a + b" label, each side cut to ``width`` characters."""
    cut = [F.substring(c, 1, width) for c in ("condition_a", "condition_b")]
    order = [F.col("patient_count").desc(), F.col("condition_a"), F.col("condition_b")]
    head = top_k(pairs, order, k)
    return head.select(F.concat(cut[0], F.lit(" + "), cut[1]).alias("pair"), "patient_count")


def ordered_return_gaps(gaps: DataFrame) -> DataFrame:
    """A handful of buckets in their natural order."""
    return gaps.orderBy(gap_order(F.col("return_gap_bucket")))


def vitals_worklist(by_patient: DataFrame, k: int = 500) -> DataFrame:
    order = [
        F.col("abnormal_vitals_events").desc(),
        F.col("latest_event_time").desc(),
        F.col("patient_id"),
    ]
    return top_k(by_patient, order, k)


def encounter_worklist(by_patient: DataFrame, k: int = 500) -> DataFrame:
    order = [
        F.col("risk_flagged_encounters").desc(),
        F.col("latest_event_time").desc(),
        F.col("patient_id"),
    ]
    return top_k(by_patient, order, k)


SEARCHED = ("patient_id", "condition_names", "risk_reasons", "suggested_focus")


def worklist_search(
    p360: DataFrame, bands: Sequence[str] = (), text: str = "", k: int = 50
) -> DataFrame:
    """Top patients of the chosen bands whose text columns contain the search."""
    rows = p360
    if bands:
        rows = rows.where(F.col("risk_band").isin(*bands))
    if text:
        hit = F.lit(False)
        for column in SEARCHED:
            hit = hit | F.coalesce(F.lower(column).contains(text.lower()), F.lit(False))
        rows = rows.where(hit)
    head = rows.select(
        "patient_id",
        "risk_band",
        "risk_score",
        short_labels(F.col("condition_names")).alias("top_conditions"),
        "unique_medications",
        "risk_reasons",
        "suggested_focus",
    )
    return top_k(head, [F.col("risk_score").desc(), F.col("patient_id")], k)


def abnormal_split(summary: DataFrame) -> DataFrame:
    """Normal and abnormal events of a feed summary as two rows."""
    normal = F.greatest(F.col("total_vitals_events") - F.col("abnormal_vitals_count"), F.lit(0))
    wide = summary.select(normal.alias("Normal"), F.col("abnormal_vitals_count").alias("Abnormal"))
    return wide.unpivot([], ["Normal", "Abnormal"], "metric", "events")


SIGNALS = ("long_stay_encounters", "emergency_encounters")


def unpivot_signals(by_type: DataFrame, signals: Sequence[str] = SIGNALS) -> DataFrame:
    """Signal counts of each encounter type, one row per signal."""
    return by_type.unpivot(["encounter_type"], list(signals), "risk_signal", "encounters")


def serving_kpis(p360: DataFrame, gaps: DataFrame, scores: DataFrame) -> DataFrame:
    """Headline numbers over three tables; each side is a single row."""

    def counted(p: Column) -> Column:
        return F.count(F.when(p, F.lit(1)))

    gap_patients = gaps.agg(F.count_distinct("patient_id")).scalar()
    critical = gaps.where(F.col("care_gap_severity") == "CRITICAL")
    # Two-decimal percentages add up exactly as decimals, whatever the order of the rows.
    exact_sum = F.sum(F.col("trust_score_pct").cast("decimal(10,2)")).cast("double")
    mean_trust = exact_sum / F.count("trust_score_pct")
    return p360.agg(
        F.count_distinct("patient_id").alias("patients_monitored"),
        counted(F.col("risk_band") == "HIGH").alias("high_risk_patients"),
        counted(F.col("reason_recent_readmission") == 1).alias("recent_return_signal_patients"),
        counted(F.col("reason_polypharmacy") == 1).alias("polypharmacy_patients"),
    ).select(
        "*",
        gap_patients.alias("care_gap_patients"),
        critical.agg(F.count_distinct("patient_id")).scalar().alias("critical_care_gaps"),
        scores.agg(mean_trust).scalar().alias("pipeline_trust_score_pct"),
    )


def dashboard_totals(
    metrics: DataFrame, groups: DataFrame, p360: DataFrame, audit: DataFrame
) -> DataFrame:
    """Totals across sections; without a patient list the condition table gives the count."""
    high = F.count(F.when(F.upper("risk_band") == "HIGH", F.lit(1)))
    listed = p360.agg(high).scalar()
    latest = audit.agg(
        F.max_by("batch_id", F.struct("execution_timestamp", "batch_id"))
    ).scalar()
    return metrics.agg(
        F.sum("total_encounters").alias("total_encounters"),
        F.sum("high_risk_patients").alias("_by_condition"),
    ).select(
        "total_encounters",
        groups.agg(F.sum("unique_patients")).scalar().alias("mastered_patients"),
        F.when(listed > 0, listed).otherwise(F.col("_by_condition")).alias("high_risk_patients"),
        latest.alias("latest_batch_id"),
    )


# How many rows of the growing sections a dashboard shows.
DASHBOARD_LIMITS = {"careGaps": 250, "comorbidityPairs": 50, "audit": 50}
DASHBOARD_PATIENTS_PER_BAND = 250


@dataclass(frozen=True)
class Section:
    """Rows of a serving section, the table they were taken from, and whether rows of it were left out."""

    rows: DataFrame
    source: DataFrame
    cut: bool = False


def snapshot_sections(
    tables: Mapping[str, DataFrame | None],
    limits: Mapping[str, int] | None = None,
    patients_per_band: int | None = None,
) -> dict[str, Section]:
    """Serving sections from the population tables that exist.

    Expects any of ``metrics, demographics, patient_360, care_gaps, pairs, return_gaps,
    rankings, audit``. ``limits`` holds the top rows of a section; a section without a limit
    is whole, and so is the patients' without ``patients_per_band``.
    """
    limits = limits or {}
    heads = {
        "clinicalMetrics": ("metrics", [F.col("total_encounters").desc(), F.col("condition_name")]),
        "demographics": ("demographics", ["race", "gender", "age_group"]),
        "careGaps": ("care_gaps", [F.col("readmission_risk_score").desc(), "patient_id"]),
        "comorbidityPairs": (
            "pairs",
            [F.col("patient_count").desc(), "condition_a", "condition_b"],
        ),
        "returnGaps": ("return_gaps", [gap_order(F.col("return_gap_bucket"))]),
        "diseaseRankings": ("rankings", [F.col("affected_patients").desc(), "condition_name"]),
        "audit": ("audit", [F.col("execution_timestamp").desc(), F.col("batch_id").desc()]),
    }
    sections = {
        name: Section(top_k(tables[table], order, limits[name]), tables[table], True)
        if name in limits
        else Section(tables[table].orderBy(*order), tables[table])
        for name, (table, order) in heads.items()
        if tables.get(table) is not None
    }
    people = tables.get("patient_360")
    if people is not None:
        whole = patients_per_band is None
        sections["patient360"] = Section(people, people) if whole else Section(balanced_top_n(people, n=patients_per_band), people, True)
    return sections
