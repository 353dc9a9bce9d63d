"""Domain router: one log stream to Bronze tables per domain, an invalid table, dead letters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.envelopes import envelope_dlq, parse_envelope, validate_envelopes
from ..plans.domains import DOMAINS, Domain
from ..sources.logs import write_log
from .writers import Load, run_id_of, with_checkpoint, with_trigger

INVALID = "_invalid"


def routed(batch: DataFrame, domains: Mapping[str, Domain], now: Column) -> DataFrame:
    """Every record with its envelope fields, verdict and route."""
    checked = validate_envelopes(parse_envelope(batch), domains)
    valid = F.col("validation_error") == ""
    return checked.withColumns(
        {
            "route": F.when(valid, F.col("domain")).otherwise(F.lit(INVALID)),
            "ingestion_timestamp": now,
        }
    )


def route_domains(
    batch: DataFrame,
    batch_id: int,
    root: str,
    domains: Mapping[str, Domain] = DOMAINS,
    run_id: str | None = None,
    now: Column | None = None,
    dlq_format: str = "json",
    dlq_options: Mapping[str, str] | None = None,
) -> None:
    """One pass and one write for all domains, split by folder; safe to repeat.

    Dead letters go out from the rejected rows just written, not from a second parse.
    """
    spark = batch.sparkSession
    load = Load(run_id or run_id_of(spark), int(batch_id))
    stamped = routed(batch, domains, now if now is not None else F.current_timestamp())
    load.write(stamped, f"{root}/bronze", ["route"])
    written = load.own(spark, f"{root}/bronze")
    if written is not None:
        rejected = written.where(F.col("route") == INVALID)
        write_log(
            envelope_dlq(rejected), dlq_format, dlq_options or {}, load.folder(f"{root}/dlq")
        )


def run_router(
    stream: DataFrame, root: str, checkpoint: str, mode: str = "availablenow", **options
):
    writer = stream.writeStream.foreachBatch(
        lambda df, batch_id: route_domains(df, batch_id, root, **options)
    )
    return with_checkpoint(with_trigger(writer, mode), checkpoint).start()
