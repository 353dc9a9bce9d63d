"""Serving snapshot: sections written as JSON by the executors."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..operators.serving import Section

COUNTS = "section string, total bigint, written bigint"


def write_snapshot(sections: Mapping[str, Section], path: str, generated_at: Column) -> DataFrame:
    """One JSON-lines folder per section, and ``manifest`` with the time and each section's counts, which are returned.

    Rows written are counted by the write itself; only where a section was cut is its table counted besides.
    """
    spark = next(iter(sections.values())).rows.sparkSession
    counts = []
    for name in sorted(sections):
        section, seen = sections[name], Observation()
        told = section.rows.observe(seen, F.count(F.lit(1)).alias("n"))
        told.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}")
        written = seen.get["n"]
        counts.append((name, section.source.count() if section.cut else written, written))
    counted = spark.createDataFrame(counts, COUNTS)
    stamp = F.date_format(generated_at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    counted.withColumn("generatedAt", stamp).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return counted
