"""Log records: six columns, whatever carries them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import try_timestamp

# Names and types of a log record's columns.
LOG_SCHEMA = (
    "kafka_topic string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, "
    "kafka_key string, raw_value string"
)

@dataclass(frozen=True)
class Admission:
    """How much of a log one micro-batch takes at most; None leaves it to the source.

    ``rows`` bounds Kafka's offsets, ``files`` and ``bytes`` the files that stand for a log. ``least_rows`` lets Kafka
    wait for so many offsets, ``longest_wait`` at most.
    """

    rows: int | None = None
    least_rows: int | None = None
    longest_wait: str | None = None
    files: int | None = None
    bytes: int | None = None

    def options(self, fmt: str) -> dict[str, str]:
        kafka = {"maxOffsetsPerTrigger": self.rows, "minOffsetsPerTrigger": self.least_rows, "maxTriggerDelay": self.longest_wait}
        files = {"maxFilesPerTrigger": self.files, "maxBytesPerTrigger": self.bytes}
        own, other = (kafka, files) if fmt == "kafka" else (files, kafka)
        if given := sorted(name for name, value in other.items() if value is not None):
            raise ValueError(f"a {fmt} source has no {', '.join(given)}")
        return {name: str(value) for name, value in own.items() if value is not None}


# Start and rate limit of the live feeds.
LIVE_START = {"startingOffsets": "earliest"}
LIVE_ADMISSION = Admission(rows=5000)


def as_log(raw: DataFrame) -> DataFrame:
    """Kafka source columns as log-record columns."""
    return raw.select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_value"),
    )


def log_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    admission: Admission | None = None,
) -> DataFrame:
    """Streaming log records from Kafka, or from files of log records.

    Kafka takes ``subscribe``, ``kafka.bootstrap.servers`` and security options, and begins at the earliest offset at
    5,000 a batch unless told otherwise. Records that the log no longer holds are an error unless the
    caller sets ``failOnDataLoss``.
    """
    if fmt == "kafka":
        given = LIVE_START | (admission or LIVE_ADMISSION).options(fmt) | dict(options or {})
        return as_log(spark.readStream.format(fmt).options(**given).load())
    given = (admission or Admission()).options(fmt) | dict(options or {})
    return spark.readStream.format(fmt).options(**given).schema(LOG_SCHEMA).load(path)


# Columns of the raw encounter file.
ENCOUNTER_SCHEMA = (
    "ID string, DATE string, PATIENT string, CODE string, DESCRIPTION string, "
    "REASONCODE string, REASONDESCRIPTION string"
)

# Canonical names of the raw encounter columns.
ENCOUNTER_NAMES = {
    "ID": "encounter_id",
    "PATIENT": "patient_id",
    "DATE": "admission_date",
    "CODE": "diagnosis_code",
    "DESCRIPTION": "description",
    "REASONCODE": "reason_code",
    "REASONDESCRIPTION": "reason_description",
}


def canonicalise(df: DataFrame, names: Mapping[str, str] = ENCOUNTER_NAMES, prefix: str = "") -> list:
    """Renamed columns for one ``select``; the date becomes a timestamp, NULL if unreadable."""
    cols = []
    for raw, name in names.items():
        c = F.col(f"{prefix}{raw}")
        cols.append((try_timestamp(c) if name == "admission_date" else c).alias(name))
    return cols


def encounter_file_stream(
    spark: SparkSession, path: str, glob: str = "*encounters*.csv", **options: str
) -> DataFrame:
    """Encounter CSV files as they land, with the file each row came from."""
    rows = (
        spark.readStream.schema(ENCOUNTER_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("pathGlobFilter", glob)
        .options(**options)
        .csv(path)
    )
    return rows.select(
        *canonicalise(rows),
        F.lit("file").alias("source_system"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def parse_encounter_log(records: DataFrame) -> DataFrame:
    """Canonical encounter rows from log records, enveloped or bare."""
    raw = F.col("raw_value")
    body = F.coalesce(F.get_json_object(raw, "$.payload"), raw)
    parsed = records.withColumn("event", F.from_json(body, ENCOUNTER_SCHEMA))
    return parsed.select(
        *canonicalise(parsed, prefix="event."),
        F.lit("kafka").alias("source_system"),
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
        F.get_json_object(raw, "$.producer_run_id").alias("producer_run_id"),
        F.get_json_object(raw, "$.producer_row_number").cast("bigint").alias("producer_row_number"),
    )


def write_log(df: DataFrame, fmt: str, options: Mapping[str, str], path: str | None = None) -> None:
    """Write ``key, value`` records to a topic, or to files that stand in for one."""
    writer = df.select("key", "value").write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("overwrite").save(path)
