"""Log envelopes: parse, validate, project, build, and dead letters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import try_timestamp, utc_iso
from ..functions.text import classify_encounter, first_present, present, stay_hours
from ..plans.domains import DOMAINS, Domain

# Fields of an envelope, a vitals event and an encounter event.
ENVELOPE_SCHEMA = (
    "domain string, producer_run_id string, producer_row_number bigint, "
    "producer_timestamp string, payload map<string,string>"
)
ENVELOPE_FIELDS = tuple(part.split()[0] for part in ENVELOPE_SCHEMA.split(", "))

# Rejection codes.
BAD_ENVELOPE = "invalid_kafka_envelope"
BAD_PAYLOAD = "missing_required_payload_fields"

VITALS_SCHEMA = (
    "event_id string, patient_id string, encounter_id string, event_type string, "
    "event_timestamp string, heart_rate double, systolic_bp double, diastolic_bp double, "
    "temperature double, source string"
)
ENCOUNTER_EVENT_SCHEMA = (
    "event_id string, encounter_id string, patient_id string, event_type string, "
    "event_timestamp string, encounter_type string, diagnosis_code string, "
    "diagnosis_description string, facility string, provider_id string, "
    "length_of_stay_hours double, source string"
)


def parse_envelope(records: DataFrame, raw: str = "raw_value") -> DataFrame:
    """Add the envelope's fields; all NULL for text that is no envelope."""
    parsed = records.withColumn("_event", F.from_json(raw, ENVELOPE_SCHEMA))
    fields = [F.col("_event").getField(f).alias(f) for f in ENVELOPE_FIELDS]
    return parsed.select(*records.columns, *fields)


def validate_envelopes(
    parsed: DataFrame, domains: Mapping[str, Domain] = DOMAINS, out: str = "validation_error"
) -> DataFrame:
    """Empty text for a known domain whose required payload fields are all present."""

    def complete(domain: Domain) -> Column:
        values = [F.col("payload").getItem(f) for f in domain.required]
        return reduce(lambda a, b: a & b, [present(v) for v in values], F.lit(True))

    named = F.coalesce(F.col("domain").isin(*domains), F.lit(False)) & F.col("payload").isNotNull()
    served = [F.when(F.col("domain") == n, complete(d)) for n, d in domains.items()]
    return parsed.withColumn(
        out,
        F.when(~named, F.lit(BAD_ENVELOPE))
        .when(~F.coalesce(*served, F.lit(False)), F.lit(BAD_PAYLOAD))
        .otherwise(F.lit("")),
    )


def project_payload(
    df: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), payload: str = "payload"
) -> DataFrame:
    """Named columns from the payload map."""
    return df.select(*keep, *[F.col(payload).getItem(f).alias(f) for f in fields])


def to_envelope(
    rows: DataFrame, domain: str, run_id: str, row_number: str, at: Column,
    error: str | None = None,
) -> DataFrame:
    """``key, value`` records: the row as payload, keyed by the first identifier it has."""
    skipped = {row_number, error}
    fields = [c for c in rows.columns if c not in skipped]
    ids = [F.col(c) for c in ("ID", "ENCOUNTER", "PATIENT") if c in fields]
    key = F.coalesce(
        *[F.nullif(c, F.lit("")) for c in ids], F.col(row_number).cast("string")
    )
    values = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields}
    entries = [part for c, v in values.items() for part in (F.lit(c), v)]
    envelope = [
        F.lit(domain).alias("domain"),
        F.lit(run_id).alias("producer_run_id"),
        F.col(row_number).cast("bigint").alias("producer_row_number"),
        at.cast("string").alias("producer_timestamp"),
        F.create_map(*entries).alias("payload"),
    ]
    if error:
        envelope.append(F.col(error).alias("error_reason"))
    return rows.select(key.alias("key"), F.to_json(F.struct(*envelope)).alias("value"))


# Constants of replayed encounter events.
REPLAY = {
    "event_type": "encounter_replay",
    "facility": "S3 Historical Replay",
    "provider_id": "s3-replay",
    "source": "s3_clinical_encounters",
}
REPLAY_ID_PREFIX = "s3-encounter"


def build_events(rows: DataFrame, row_number: str) -> DataFrame:
    """Encounter events from raw rows: trimmed ids, UTC ISO time, class and hours of stay."""

    def trimmed(c: str) -> Column:
        return F.trim(F.coalesce(F.col(c), F.lit("")))

    at = try_timestamp(trimmed("DATE"))
    number = F.col(row_number).cast("bigint")
    return rows.select(
        F.concat_ws("-", F.lit(REPLAY_ID_PREFIX), trimmed("ID"), number.cast("string")).alias(
            "event_id"
        ),
        trimmed("ID").alias("encounter_id"),
        trimmed("PATIENT").alias("patient_id"),
        F.lit(REPLAY["event_type"]).alias("event_type"),
        F.coalesce(utc_iso(at), F.lit("")).alias("event_timestamp"),
        classify_encounter(F.col("DESCRIPTION")).alias("encounter_type"),
        trimmed("CODE").alias("diagnosis_code"),
        F.coalesce(first_present(F.col("REASONDESCRIPTION"), F.col("DESCRIPTION")), F.lit("")).alias(
            "diagnosis_description"
        ),
        F.lit(REPLAY["facility"]).alias("facility"),
        F.lit(REPLAY["provider_id"]).alias("provider_id"),
        stay_hours(F.col("DESCRIPTION")).alias("length_of_stay_hours"),
        F.lit(REPLAY["source"]).alias("source"),
        number.alias("source_row"),
    )


def event_bronze(records: DataFrame, schema: str, raw: str = "raw_value") -> DataFrame:
    """Typed event columns next to the raw text and its log coordinates."""
    parsed = records.withColumn("_event", F.from_json(raw, schema))
    flat = parsed.select(*records.columns, "_event.*").withColumnRenamed(raw, "raw_payload")
    return flat.withColumn("event_timestamp", try_timestamp(F.col("event_timestamp")))


def to_dlq(
    rejected: DataFrame,
    source_topic: str,
    domain: str,
    at: Column,
    reason: str = "quarantine_reason",
    key: str = "patient_id",
) -> DataFrame:
    """``key, value`` dead letters with the reason, the raw text and the log coordinates."""
    body = F.struct(
        F.lit(source_topic).alias("source_topic"),
        F.lit(domain).alias("domain"),
        F.col(reason).alias("error_reason"),
        F.col("raw_payload"),
        F.col("kafka_topic"),
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        F.col("kafka_timestamp").cast("string").alias("kafka_timestamp"),
        at.cast("string").alias("dlq_published_at"),
    )
    return rejected.select(
        F.col(key).cast("string").alias("key"), F.to_json(body).alias("value")
    )


def envelope_dlq(invalid: DataFrame, reason: str = "validation_error") -> DataFrame:
    """Dead letters of rejected envelopes, under their own log key."""
    body = F.struct(F.col(reason).alias("error_reason"), F.col("raw_value"))
    return invalid.select(
        F.col("kafka_key").cast("string").alias("key"), F.to_json(body).alias("value")
    )
