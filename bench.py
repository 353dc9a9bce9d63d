"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Derived tables (features, Silver, scores, population tables) are written once, as a pipeline
does; the time to build each is reported under ``build_*`` and is part of the total.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "return_gaps",
    "return_sequence",
    "raw_validation",
    "reference_check",
    "clinical_gate",
    "completeness_scorecard",
    "observation_features",
    "condition_features",
    "medication_features",
    "procedure_features",
    "interval_join",
    "enrich_encounters",
    "condition_metrics",
    "demographics",
    "patient_360",
    "care_gap_worklist",
    "comorbidity_pairs",
    "disease_rankings",
    "latest_by_natural_key",
    "event_dedup",
    "vitals_summary",
    "vitals_by_patient",
    "encounters_by_type",
    "upsert_merge",
    "upsert_conditional",
    "balanced_top_n",
    "serving_kpis",
    "micro_batch_silver",
    "domain_router",
)


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("cohortflow-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    from cohortflow.plans import given
    from cohortflow.plans.catalog import QUERIES

    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    timed("warm_up", lambda: given.read(spark, SF_DIR, "orders").agg({"o_orderkey": "max"}).collect())
    times.pop("warm_up")
    timed("build_encounter_features", lambda: given.encounter_features(spark, SF_DIR))
    timed("build_patient_features", lambda: given.patient_features(spark, SF_DIR))
    timed("build_enriched", lambda: given.enriched(spark, SF_DIR))
    timed("build_scored", lambda: given.scored(spark, SF_DIR))
    timed("build_vitals", lambda: given.vitals_checked(spark, SF_DIR))
    for name in names:
        result = QUERIES[name]
        timed(name, lambda: result(spark, SF_DIR).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
