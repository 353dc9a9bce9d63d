"""Encounter derivations, scoring and the population tables built on them."""

from __future__ import annotations

from collections.abc import Mapping
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import age_band, gap_bucket, rank_of, whole_years
from ..functions.scores import additive_score, band, capped_sum, first_match, flag, joined, percentage
from ..functions.text import (
    LIST_SEPARATOR,
    NO_LABEL,
    mask,
    matches,
    normalise_label,
    present,
    shard_id,
    split_labels,
    stay_days,
)
from .joins import before_event, restrict_to, with_rate
from .sequence import latest_per_key, return_sequence, top_n_per_group
from .skew import hot_counts, salted_join

# ---- Silver derivations; fills are fixed values ----------------------------------------------

TEXT_FILLS = {
    "gender": "UNKNOWN",
    "race": "UNKNOWN",
    "ssn": "000-00-0000",
    "condition_names": "General Outpatient Checkup",
}
COUNT_COLUMNS = (
    "condition_count",
    "chronic_condition_count",
    "observation_count",
    "abnormal_vital_count",
    "medication_events",
    "unique_medications",
    "high_risk_med_count",
    "antimicrobial_count",
    "max_medication_days",
    "procedure_count",
    "unique_procedures",
    "major_procedure_count",
    "careplan_count",
    "unique_careplans",
    "chronic_careplan_count",
    "allergy_count",
    "severe_allergy_count",
    "immunization_count",
    "preventive_immunization_count",
)
# Columns the gate and the derivations need even when their source table is absent.
EXPECTED = {
    "primary_condition_name": "string",
    "condition_names": "string",
    "gender": "string",
    "race": "string",
    "ssn": "string",
    "birthdate": "date",
    "bmi": "double",
    "systolic_bp": "double",
    "diastolic_bp": "double",
    **{c: "bigint" for c in COUNT_COLUMNS},
}


def complete_columns(df: DataFrame, expected: Mapping[str, str] = EXPECTED) -> DataFrame:
    """Add expected columns that are absent as typed NULLs."""
    missing = {c: F.lit(None).cast(t) for c, t in expected.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def fill_defaults(df: DataFrame, fills: Mapping[str, object] | None = None) -> DataFrame:
    """Replace NULLs column by column."""
    if fills is None:
        fills = {**TEXT_FILLS, **{c: 0 for c in COUNT_COLUMNS}}
    return df.fillna({c: v for c, v in fills.items() if c in df.columns})


def derive_silver(df: DataFrame, as_of: Column) -> DataFrame:
    """Condition label, stay, discharge, age, shard, defaults and masking of enriched rows."""
    df = complete_columns(df)
    days = stay_days(F.col("description"))
    age = whole_years(F.col("birthdate"), as_of)
    derived = df.withColumns(
        {
            "condition_name": normalise_label(
                [F.col("reason_description"), F.col("primary_condition_name")]
            ),
            "los_days": days,
            "discharge_date": F.date_add(F.col("admission_date").cast("date"), days),
            "age": age,
            "age_group": age_band(age),
            "hospital_id": shard_id(F.col("patient_id")),
            "encounter_year": F.year("admission_date"),
        }
    )
    return fill_defaults(derived).withColumn("ssn", mask(F.col("ssn")))


PRIVATE_COLUMNS = ("birthdate",)


def drop_private(df: DataFrame, columns=PRIVATE_COLUMNS) -> DataFrame:
    return df.drop(*columns)


# ---- scoring; weights, reasons and texts are fixed values -----------------------------------


def risk_rules() -> list[tuple[Column, int]]:
    return [
        (F.col("is_readmitted_30d") == 1, 35),
        (F.col("high_risk_med_count") > 0, 20),
        (F.col("unique_medications") >= 4, 15),
        (F.col("abnormal_vital_count") >= 2, 15),
        (F.col("condition_count") >= 3, 10),
        (F.col("chronic_condition_count") >= 2, 10),
        (F.col("major_procedure_count") > 0, 10),
        (F.col("chronic_careplan_count") > 0, 5),
        (F.col("severe_allergy_count") > 0, 5),
        (F.col("age") >= 65, 10),
        (F.col("los_days") >= 7, 5),
    ]


BURDEN_CAPS = {
    "condition_count": 5,
    "unique_medications": 5,
    "procedure_count": 5,
    "abnormal_vital_count": 3,
    "careplan_count": 2,
}


def reason_rules() -> list[tuple[Column, str]]:
    return [
        (F.col("is_readmitted_30d") == 1, "recent_readmission"),
        (F.col("age") >= 65, "age_65_plus"),
        (F.col("high_risk_med_count") > 0, "high_risk_medication"),
        (F.col("unique_medications") >= 5, "polypharmacy"),
        (F.col("chronic_condition_count") >= 2, "chronic_condition_burden"),
        (F.col("abnormal_vital_count") >= 2, "abnormal_vitals"),
        (F.col("major_procedure_count") > 0, "major_procedure"),
        (F.col("severe_allergy_count") > 0, "severe_allergy"),
        (F.col("clinical_burden_score") >= 12, "high_utilization"),
    ]


REASONS = (
    "recent_readmission",
    "age_65_plus",
    "high_risk_medication",
    "polypharmacy",
    "chronic_condition_burden",
    "abnormal_vitals",
    "major_procedure",
    "severe_allergy",
    "high_utilization",
)
FOCUS = (
    ("recent_readmission", "Review recent return and follow-up"),
    ("abnormal_vitals", "Review abnormal vitals"),
    ("high_risk_medication", "Medication safety review"),
    ("chronic_condition_burden", "Chronic care plan review"),
)
DEFAULT_FOCUS = "Routine monitoring"
ACTIONS = (
    ("CRITICAL", "Schedule urgent chronic care follow-up"),
    ("WARNING", "Review care plan coverage"),
    ("INFO", "Refresh preventive care or vitals data"),
)
DEFAULT_ACTION = "Monitor"
SEVERITY_ORDER = ("CRITICAL", "WARNING")


def care_gap_severity() -> Column:
    uncovered = (F.col("chronic_condition_count") > 0) & (F.col("chronic_careplan_count") <= 0)
    unseen = (F.col("observation_count") <= 0) | (F.col("preventive_immunization_count") <= 0)
    return first_match(
        [
            (uncovered & (F.col("abnormal_vital_count") >= 2), "CRITICAL"),
            (uncovered, "WARNING"),
            (unseen, "INFO"),
        ],
        "NONE",
    )


def recommended_action(severity: Column) -> Column:
    return first_match([(severity == s, text) for s, text in ACTIONS], DEFAULT_ACTION)


def flagged_reasons() -> Column:
    """Joined names of the reason flags that are set."""
    return joined([(F.col(f"reason_{r}") == 1, r) for r in REASONS])


def suggested_focus() -> Column:
    return first_match([(F.col(f"reason_{r}") == 1, text) for r, text in FOCUS], DEFAULT_FOCUS)


def add_scores(df: DataFrame) -> DataFrame:
    """Risk score and band, burden score, reason flags, care gap and action."""
    meds = F.least("high_risk_med_count", "unique_medications")
    scored = df.withColumns(
        {
            "high_risk_med_count": meds,
            "clinical_burden_score": capped_sum(BURDEN_CAPS),
            "care_gap_severity": care_gap_severity(),
        }
    ).withColumns(
        {
            "readmission_risk_score": additive_score(risk_rules()),
            "recommended_action": recommended_action(F.col("care_gap_severity")),
            **{f"reason_{name}": flag(p) for p, name in reason_rules()},
        }
    )
    return scored.withColumns(
        {
            "readmission_risk_band": band(F.col("readmission_risk_score")),
            "risk_reasons": flagged_reasons(),
        }
    )


def score_encounters(silver: DataFrame, **skew) -> DataFrame:
    """Silver encounters with their return sequence and all scores."""
    return add_scores(return_sequence(silver, **skew))


# ---- population tables --------------------------------------------------------------------------

AVERAGED = {
    "avg_los_days": "los_days",
    "readmission_rate": "is_readmitted_30d",
    "avg_readmission_risk_score": "readmission_risk_score",
    "avg_unique_medications": "unique_medications",
    "avg_abnormal_vitals": "abnormal_vital_count",
    "avg_condition_count": "condition_count",
    "avg_procedure_count": "procedure_count",
    "avg_careplan_count": "careplan_count",
    "avg_allergy_count": "allergy_count",
    "avg_immunization_count": "immunization_count",
}


def condition_metrics(scored: DataFrame) -> DataFrame:
    """Averages, encounters and high-risk rows per condition.

    ``scored`` holds each encounter once, so a plain count replaces a distinct count.
    """
    high = F.col("readmission_risk_band") == "HIGH"
    return scored.groupBy("condition_name").agg(
        *[F.avg(c).alias(name) for name, c in AVERAGED.items()],
        F.count("encounter_id").alias("total_encounters"),
        F.count(F.when(high, F.lit(1))).alias("high_risk_patients"),
    )


def demographics(scored: DataFrame) -> DataFrame:
    """Patients by race, gender and age group of their latest encounter."""
    latest = latest_per_key(
        scored.select(
            "patient_id", "encounter_id", "admission_date", "race", "gender", "age_group"
        ),
        ["patient_id"],
        ["admission_date", "encounter_id"],
    )
    return latest.groupBy("race", "gender", "age_group").agg(
        F.count("patient_id").alias("unique_patients")
    )


MAXIMA = (
    "clinical_burden_score",
    *[f"reason_{r}" for r in REASONS],
    "condition_count",
    "chronic_condition_count",
    "unique_medications",
    "high_risk_med_count",
    "abnormal_vital_count",
    "procedure_count",
    "major_procedure_count",
    "careplan_count",
    "preventive_immunization_count",
    "severe_allergy_count",
    "gender",
    "race",
    "age_group",
)


def patient_360(scored: DataFrame) -> DataFrame:
    """One row per patient: highest scores, counts and flags, and all their conditions.

    Encounters give their measures, and apart from them their labels, in rows of the one aggregation, so the
    measures are not repeated for every label.
    """
    names, name = F.col("condition_names"), F.col("condition_name")
    listed = (
        F.when(names.isNotNull() & (names != "General Outpatient Checkup"), names)
        .when(name != "General Clinical Encounter", name)
    )
    measures = scored.select("patient_id", F.col("readmission_risk_score").alias("risk_score"), *MAXIMA)
    label = F.explode(F.array_distinct(split_labels(listed))).alias("_label")
    labels = scored.select("patient_id", label).where(present(F.col("_label")))
    rows = measures.unionByName(labels, allowMissingColumns=True)
    found = F.array_join(F.array_sort(F.collect_set(F.trim("_label"))), LIST_SEPARATOR)
    grouped = rows.groupBy("patient_id").agg(
        F.max("risk_score").alias("risk_score"),
        *[F.max(c).alias(c) for c in MAXIMA],
        found.alias("_labels"),
    )
    return grouped.select(
        "patient_id",
        "risk_score",
        *MAXIMA,
        F.coalesce(F.nullif(F.col("_labels"), F.lit("")), F.lit(NO_LABEL)).alias("condition_names"),
        band(F.col("risk_score")).alias("risk_band"),
        flagged_reasons().alias("risk_reasons"),
        suggested_focus().alias("suggested_focus"),
    )


CARE_GAP_COLUMNS = (
    "patient_id",
    "encounter_id",
    "condition_name",
    "care_gap_severity",
    "recommended_action",
    "chronic_condition_count",
    "chronic_careplan_count",
    "observation_count",
    "abnormal_vital_count",
    "preventive_immunization_count",
    "readmission_risk_score",
)


def care_gap_worklist(scored: DataFrame) -> DataFrame:
    """The most pressing care gap of each patient."""
    order = [
        rank_of(F.col("care_gap_severity"), SEVERITY_ORDER),
        F.col("readmission_risk_score").desc(),
        F.col("admission_date").desc(),
        F.col("encounter_id").desc(),
    ]
    gaps = scored.where(F.col("care_gap_severity") != "NONE").select(
        *CARE_GAP_COLUMNS, "admission_date"
    )
    return top_n_per_group(gaps, ["patient_id"], order, 1).select(*CARE_GAP_COLUMNS)


GENERIC_PATTERN = "general clinical encounter|general outpatient checkup"


def explode_labels(
    df: DataFrame,
    key: str = "patient_id",
    lists: tuple[str, ...] = ("condition_names", "condition_name"),
    stop_pattern: str = GENERIC_PATTERN,
    out: str = "condition",
) -> DataFrame:
    """Distinct (key, label) from the first non-NULL label list, without generic labels."""
    listed = F.coalesce(*[F.col(c) for c in lists])
    labels = df.select(key, F.explode(split_labels(listed)).alias(out))
    return (
        labels.where(present(F.col(out)) & ~matches(F.col(out), stop_pattern))
        .select(key, F.trim(out).alias(out))
        .distinct()
    )


#: Labels of a key that meet in one tile. A tile is what a task holds of a key at once.
PAIR_TILE = 256


def pair_tiles(labels: DataFrame, key: str, label: str, tile: int, widest: int | None = None) -> DataFrame:
    """``left`` and ``right`` label sets whose pairs, together, are each pair of a key's labels once.

    A key's labels are dealt to blocks of about ``tile`` by their hash, and every pair of blocks is a tile of
    its own, dealt by key and pair of blocks. ``right`` is empty where a block meets itself: then the
    pairs are those within ``left``. ``widest`` is a number of labels that no key exceeds, where one is known.
    """
    rows = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    if widest is not None and widest <= tile:
        dealt = rows.withColumns({"_block": F.lit(0), "_i": F.lit(0), "_j": F.lit(0)})
    else:
        counts = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
        wide, hot = counts.where(F.col("_n") > tile), hot_counts(counts, ["_key"])
        blocks = F.coalesce(F.ceil(F.col("_n") / tile), F.lit(1))
        dealt = (
            salted_join(rows, wide, ["_key"], "left", spread=["_label"], hot=hot)
            .withColumns({"_block": F.pmod(F.xxhash64("_label"), blocks), "_other": F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))})
            .withColumns({"_i": F.least("_block", "_other"), "_j": F.greatest("_block", "_other")})
        )
    in_left = F.col("_block") == F.col("_i")
    met = dealt.groupBy("_key", "_i", "_j").agg(
        F.array_sort(F.collect_set(F.when(in_left, F.col("_label")))).alias("left"),
        F.array_sort(F.collect_set(F.when(~in_left, F.col("_label")))).alias("right"),
    )
    return met.select("left", "right", (F.col("_i") == F.col("_j")).alias("own"))


def label_pairs(
    labels: DataFrame, key: str = "patient_id", label: str = "condition", tile: int = PAIR_TILE, widest: int | None = None
) -> DataFrame:
    """How many keys hold each pair of labels; rows without a key or a label make no pair.

    Pairs come from tiles of two blocks of a key's labels, so no task holds a whole key. Equal tiles
    are counted first: most keys are one tile, and keys with the same labels list their pairs once.
    """
    tiles = (
        pair_tiles(labels, key, label, tile, widest)
        .where(F.when(F.col("own"), F.size("left") > 1).otherwise((F.size("left") > 0) & (F.size("right") > 0)))
        .groupBy("own", "left", "right")
        .agg(F.count(F.lit(1)).alias("_keys"))
    )
    first = tiles.select("_keys", "own", "left", "right", F.posexplode("left").alias("_at", "_one"))
    rest = F.when(F.col("own"), F.slice("left", F.col("_at") + 2, F.size("left"))).otherwise(F.col("right"))
    pairs = first.select("_keys", "_one", F.explode(rest).alias("_two"))
    return pairs.groupBy(F.least("_one", "_two").alias("condition_a"), F.greatest("_one", "_two").alias("condition_b")).agg(
        F.sum("_keys").alias("patient_count")
    )


PAIR_ORDER = ("condition_a", "condition_b")


def comorbidity_pairs(
    labels: DataFrame, k: int = 50, key: str = "patient_id", label: str = "condition", tile: int = PAIR_TILE
) -> DataFrame:
    """The ``k`` most frequent pairs, exactly.

    A pair is never more frequent than its rarer label. Pairs among a handful of the
    most frequent labels give a count the k-th best pair reaches at least; labels
    below it cannot be part of the answer and leave before the pairs are listed.
    (Repeated rows would only overstate a label's frequency and keep more of them.)
    """
    support = labels.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    few = ceil(1 + sqrt(4 * k))
    seeds = support.orderBy(F.col("_n").desc(), label).limit(few).select(label)
    seeded = label_pairs(labels.join(F.broadcast(seeds), label, "left_semi"), key, label, widest=few)
    best = seeded.orderBy(F.col("patient_count").desc()).limit(k)
    reached = best.agg(
        F.when(F.count(F.lit(1)) == k, F.min("patient_count")).otherwise(F.lit(1))
    ).scalar()
    frequent = support.where(F.col("_n") >= reached).select(label)
    kept = salted_join(labels, frequent, [label], "left_semi", spread=[key], hot=hot_counts(support, [label]))
    return (
        label_pairs(kept, key, label, tile)
        .orderBy(F.col("patient_count").desc(), *PAIR_ORDER)
        .limit(k)
    )


def return_gaps(sequence: DataFrame) -> DataFrame:
    """Encounters and patients per bucket of days since the previous admission."""
    counted = sequence.where(F.col("return_gap_days") >= 0)
    return counted.groupBy(gap_bucket(F.col("return_gap_days")).alias("return_gap_bucket")).agg(
        F.count_distinct("encounter_id").alias("encounter_count"),
        F.count_distinct("patient_id").alias("patient_count"),
    )


def disease_burden(history: DataFrame) -> DataFrame:
    """Affected patients per condition; ``history`` is unique per (patient, condition)."""
    return history.groupBy("condition_name").agg(F.count("patient_id").alias("affected_patients"))


def deceased_associations(history: DataFrame, deaths: DataFrame) -> DataFrame:
    """Patients per condition that began by their death."""
    return (
        before_event(history, deaths, "patient_id", "condition_start", "deathdate")
        .groupBy("condition_name")
        .agg(F.count("patient_id").alias("deceased_patients"))
    )


def disease_rankings(history: DataFrame, population: DataFrame, patients: DataFrame) -> DataFrame:
    """Affected and deceased patients per condition among the monitored population."""
    monitored = restrict_to(history, population, "patient_id")
    deaths = (
        patients.where(F.col("deathdate").isNotNull())
        .groupBy("patient_id")
        .agg(F.min("deathdate").alias("deathdate"))
    )
    return with_rate(
        disease_burden(monitored),
        deceased_associations(monitored, deaths),
        "condition_name",
        "affected_patients",
        "deceased_patients",
        "deceased_association_pct",
    )
