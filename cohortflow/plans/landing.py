"""Registered queries for sources, sinks and streams: the given tables written through one operator
and read back through another, every row of them."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import try_date
from ..operators import cohort, envelopes, sequence, serving
from ..operators.intervals import active_interval_join
from ..operators.skew import salted_join
from ..operators.tables import merge_upsert, state_updates
from ..sources.files import (
    append_table,
    publish_upsert,
    read_buckets,
    read_csv_upper,
    read_csv_with_quarantine,
    read_optional,
    read_version,
    register_views,
    replace_table,
    write_partitioned,
    write_version,
)
from ..sources.logs import (
    ENCOUNTER_SCHEMA,
    Admission,
    canonicalise,
    encounter_file_stream,
    log_stream,
    parse_encounter_log,
    write_log,
)
from ..sources.snapshot import write_snapshot
from ..streaming.cursor import drain, load_cursors
from ..streaming.medallion import Features, Tables, process_batch, with_lineage
from ..streaming.state import KeyedState
from ..streaming.writers import Load, stream_to_table
from . import given as g
from . import jobs
from .catalog import QUERIES, audit, fresh_run, gaps, groups, metrics, pairs, query, stays

__all__ = ["QUERIES"]

RAW = [field.split()[0] for field in ENCOUNTER_SCHEMA.split(", ")]
CANONICAL = ["encounter_id", "patient_id", "admission_date", "diagnosis_code", "description", "reason_description"]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", **options) -> None:
    writer = df.write.mode(mode).option("header", True).options(**options)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def halves(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(key) % 2 == 0), df.where(F.col(key) % 2 == 1)


# ---- files --------------------------------------------------------------------------------------


@query
def csv_scan(spark, sf):
    """Files of one folder whose headers differ in order and case."""
    path = fresh_run(spark, "csv_scan")
    even, odd = halves(g.raw_encounters(spark, sf), "ROW_NUMBER")
    write_csv(even, path)
    write_csv(odd.select(*[F.col(c).alias(c.lower()) for c in reversed(odd.columns)]), path, "append")
    return read_csv_upper(spark, path)


@query
def csv_quarantine(spark, sf):
    """Every 13th patient line has cells too many; two orders of the header."""
    path = fresh_run(spark, "csv_quarantine")
    names = ["ID", "BIRTHDATE", "RACE"]
    rows = g.raw_patients(spark, sf).withColumn("n", F.col("ID").cast("bigint"))
    extra = F.when(F.col("n") % 13 == 0, F.lit(",one,two")).otherwise(F.lit(""))
    for part, order, mode in zip(halves(rows, "n"), (names, names[::-1]), ("overwrite", "append")):
        line = F.concat(F.concat_ws(",", *order), extra).alias(",".join(order))
        write_csv(part.select(line), path, mode, sep="\t")
    good, bad = read_csv_with_quarantine(spark, path, [*names, "GENDER"], F.lit(g.FEED_NOW))
    told = good.withColumn("quarantined", F.lit(False))
    return told.unionByName(bad.select(*good.columns, F.lit(True).alias("quarantined")))


@query
def optional_table(spark, sf):
    """A table that has been written, next to one that has not."""
    path = fresh_run(spark, "optional")
    replace_table(g.read(spark, sf, "customer"), f"{path}/there")
    absent = read_optional(spark, f"{path}/not_there") is None
    there = read_optional(spark, f"{path}/there")
    return there.select("c_custkey", "c_name", F.lit(absent).alias("other_is_absent"))


@query
def append_evolve(spark, sf):
    """A column that only the later append has."""
    path = fresh_run(spark, "append")
    early, late = halves(g.read(spark, sf, "orders"), "o_orderkey")
    append_table(early.select("o_orderkey", "o_totalprice"), path)
    append_table(late.select("o_orderkey", "o_totalprice", "o_orderstatus"), path)
    return read_optional(spark, path, merge_schema=True)


@query
def replace_table_(spark, sf):
    """Rows and schema replaced as a whole."""
    path = fresh_run(spark, "replace")
    replace_table(g.read(spark, sf, "customer"), path)
    replace_table(g.read(spark, sf, "part").select("p_partkey", "p_brand"), path)
    return read_optional(spark, path)


@query
def partitioned_write(spark, sf):
    """One partition written again; the others stay."""
    path = fresh_run(spark, "partitioned")
    rows = g.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_partitioned(rows.withColumn("written", F.lit(1)), path, ["o_orderstatus"])
    again = rows.where("o_orderstatus = 'F' and o_orderkey % 3 = 0").withColumn("written", F.lit(2))
    write_partitioned(again, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query
def upsert_retry(spark, sf):
    """A version written twice, as by a retry: it sees what its first try saw."""
    path = fresh_run(spark, "versions")
    even, odd = halves(g.read(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_custkey")
    write_version(even, path, 0)
    source = odd.unionByName(even.where("c_custkey % 10 = 0")).withColumn("batch", F.lit(1))
    for _ in range(2):
        write_version(merge_upsert(read_version(spark, path, below=1), source, ["c_custkey"]), path, 1)
    return read_version(spark, path)


@query
def upsert_buckets(spark, sf):
    """Two upserts into buckets of keys, the second repeated: rows before 1999, then some customers' rows since 1998."""
    path = fresh_run(spark, "buckets")
    rows = g.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    publish_upsert(rows.where("o_orderdate < '1999-01-01'").withColumn("origin", F.lit("first")), path, ["o_orderkey"])
    later = rows.where("o_orderdate >= '1998-01-01' and o_custkey % 100 = 0").withColumns({"origin": F.lit("second"), "batch": F.lit(2)})
    for _ in range(2):
        publish_upsert(later, path, ["o_orderkey"])
    return read_buckets(spark, path).select("o_orderkey", "o_custkey", "origin", "batch")


@query
def views(spark, sf):
    """Views over the tables that exist."""
    path = fresh_run(spark, "views")
    for name in ("nation", "customer"):
        replace_table(g.read(spark, sf, name), f"{path}/{name}")
    paths = {f"landed_{n}": f"{path}/{n}" for n in ("nation", "customer", "none")}
    made = len(register_views(spark, paths))
    return spark.sql(
        "select n_name, count(*) as customers from landed_customer join landed_nation "
        "on c_nationkey = n_nationkey group by n_name"
    ).withColumn("views", F.lit(made))


@query
def snapshot_sections(spark, sf):
    """The serving sections written and counted."""
    path = fresh_run(spark, "snapshot")
    tables = {
        "metrics": metrics(spark, sf),
        "demographics": groups(spark, sf),
        "care_gaps": gaps(spark, sf),
        "pairs": pairs(spark, sf),
        "audit": audit(spark, sf),
    }
    sections = serving.snapshot_sections(tables, serving.DASHBOARD_LIMITS)
    write_snapshot(sections, path, F.lit(g.FEED_NOW).cast("timestamp"))
    listed = spark.read.json(f"{path}/manifest").select("section", "total", "written")
    lines = spark.read.text([f"{path}/{name}" for name in sections])
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    counted = lines.groupBy(folder.alias("section")).agg(F.count(F.lit(1)).alias("n_rows"))
    return listed.join(counted, "section", "left")


# ---- log records ----------------------------------------------------------------------------------


def encounter_records(spark: SparkSession, sf: str) -> DataFrame:
    """Raw encounters as log records, enveloped and bare in turn."""
    n = F.col("ROW_NUMBER")
    bare = F.struct(*RAW)
    enveloped = F.struct(F.lit("run-1").alias("producer_run_id"), n.alias("producer_row_number"), bare.alias("payload"))
    return g.raw_encounters(spark, sf).select(
        F.lit("encounters").alias("kafka_topic"),
        (n % 4).cast("int").alias("kafka_partition"),
        n.alias("kafka_offset"),
        F.lit(g.FEED_NOW).cast("timestamp").alias("kafka_timestamp"),
        F.col("ID").alias("kafka_key"),
        F.when(n % 2 == 0, F.to_json(enveloped)).otherwise(F.to_json(bare)).alias("raw_value"),
    )


FROM_LOG = ["kafka_offset", "producer_run_id", "producer_row_number", *CANONICAL]


@query
def encounter_log(spark, sf):
    return parse_encounter_log(encounter_records(spark, sf)).select(*FROM_LOG)


@query
def log_stream_(spark, sf):
    """Files of log records read at a bounded rate, parsed and appended to a table."""
    path = fresh_run(spark, "log_stream")
    encounter_records(spark, sf).write.option("maxRecordsPerFile", 50_000).json(f"{path}/log")
    records = log_stream(spark, "json", path=f"{path}/log", admission=Admission(bytes=8 << 20))
    stream_to_table(parse_encounter_log(records), f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/table").select(*FROM_LOG)


@query
def dlq_sink(spark, sf):
    """Dead letters written to files that stand in for a topic."""
    path = fresh_run(spark, "dlq")
    letters = envelopes.to_dlq(g.vitals_quarantine(spark, sf), "clinical-vitals", "vitals", g.feed_now())
    write_log(letters, "json", {}, path)
    return spark.read.schema("key string, value string").json(path)


@query
def lineage(spark, sf):
    raw = g.raw_encounters(spark, sf)
    rows = raw.select(*canonicalise(raw), F.lit("file").alias("source_system"), F.col("ROW_NUMBER").alias("kafka_offset"))
    kept = with_lineage(rows, F.lit(g.FEED_NOW).cast("timestamp_ntz"))
    told = [F.get_json_object("raw_payload", f"$.{c}").alias(f"raw_{c}") for c in ("patient_id", "source_system")]
    return kept.select("kafka_offset", "encounter_id", "ingestion_timestamp", *told)


@query
def drop_private(spark, sf):
    return cohort.drop_private(g.patient_rows(spark, sf))


# ---- streams ----------------------------------------------------------------------------------------


@query
def file_stream(spark, sf):
    """Encounter files streamed into a table."""
    path = fresh_run(spark, "file_stream")
    write_csv(g.raw_encounters(spark, sf).select(*RAW), f"{path}/files")
    rows = encounter_file_stream(spark, f"{path}/files", glob="*.csv")
    stream_to_table(rows, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/table").select(*CANONICAL, "source_system")


@query
def stream_restart(spark, sf):
    """A stream stopped and started again from its checkpoint after new files came."""
    path = fresh_run(spark, "restart")
    events = g.read(spark, sf, "events").select("event_id", "user_id", "event_type")
    for part in halves(events, "event_id"):
        part.write.mode("append").parquet(f"{path}/in")
        rows = spark.readStream.schema(events.schema).parquet(f"{path}/in")
        stream_to_table(
            rows, f"{path}/out", f"{path}/checkpoint", partition_by=["event_type"]
        ).awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query
def file_idempotence(spark, sf):
    """Files delivered again with new ones: what the ledger knows is skipped before Bronze."""
    tables = Tables(fresh_run(spark, "idempotence"))
    raw = g.raw_encounters(spark, sf)
    year = F.coalesce(F.substring("DATE", 1, 4), F.lit("none"))
    rows = raw.select(
        *canonicalise(raw),
        F.lit("file").alias("source_system"),
        F.concat(F.lit("orders-"), year, F.lit(".csv")).alias("source_file"),
    )
    known = Features(g.patient_rows(spark, sf), [], [])
    for batch_id, batch in enumerate((rows.where("source_file < 'orders-1996'"), rows)):
        process_batch(batch, batch_id, tables, known, run_id="files", now=datetime(2024, 2, 1))
    bronze = spark.read.parquet(tables.bronze)
    return bronze.groupBy("source_file", "batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def keyed_state(spark, sf):
    """The latest stay of each patient over the state updates of two loads, the second written twice as by a retry."""
    state = KeyedState(fresh_run(spark, "state"))
    rows = stays(spark, sf).withColumn("late", F.col("diagnosis_code") == "O")
    for batch_id, late in ((0, False), (1, True), (1, True)):
        updates = state_updates(rows.where(F.col("late") == late))
        state.update(spark, Load("run", batch_id), updates, F.lit(f"2024-02-0{batch_id + 1}").cast("timestamp"))
    return state.now(spark).select("patient_id", *state.fields)


@query
def offset_idempotence(spark, sf):
    """Log records delivered again with later ones: offsets that have landed are skipped before Bronze."""
    tables = Tables(fresh_run(spark, "offsets"))
    rows = parse_encounter_log(encounter_records(spark, sf))
    at = F.col("kafka_offset")
    middle = rows.agg(F.expr("percentile_approx(kafka_offset, array(0.3, 0.6))").alias("cut")).first()["cut"]
    batches = (rows.where(at <= middle[1]), rows.where(at > middle[0]), rows.where(at <= middle[0]))
    for batch_id, batch in enumerate(batches):
        process_batch(batch, batch_id, tables, Features(), run_id="log", now=datetime(2024, 2, batch_id + 1))
    bronze = spark.read.parquet(tables.bronze)
    return bronze.groupBy("kafka_partition").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("kafka_offset").alias("offsets"), F.min("kafka_offset").alias("first_offset"), F.max("kafka_offset").alias("last_offset")
    )


@query
def cursor_upsert(spark, sf):
    """Three sources drained in slices of a third by saved cursors, then once more with nothing left."""
    path = fresh_run(spark, "cursors")
    keys = {"events": "event_id", "orders": "o_orderkey", "customer": "c_custkey"}
    sources = {name: (g.read(spark, sf, name), key) for name, key in keys.items()}
    third = {name: -(-table.count() // 3) for name, (table, _) in sources.items()}
    for _ in range(2):
        now = g.feed_now().cast("timestamp")
        drain(spark, sources, path, third, now, lambda name, part: append_table(part, f"{path}-out/{name}"))
    out = [read_optional(spark, f"{path}-out/{name}").agg(F.lit(name).alias("source_name"), F.count(F.lit(1)).alias("delivered")) for name in keys]
    delivered = reduce(DataFrame.unionByName, out)
    return load_cursors(spark, path).join(delivered, "source_name").select("source_name", "last_key", "delivered")


@query
def files_to_features(spark, sf):
    """CSV files of three domains, malformed lines among them and headers in two orders, to feature tables: rows of each step."""
    root = fresh_run(spark, "files")
    patients = g.raw_patients(spark, sf).withColumn("n", F.col("ID").cast("bigint"))
    encounters = g.raw_encounters(spark, sf).select("ID", "PATIENT", "DATE", F.col("ROW_NUMBER").alias("n"))
    seen = g.observations(spark, sf).withColumn("n", F.col("ENCOUNTER").cast("bigint"))
    for name, rows in (("patients", patients), ("encounters", encounters), ("observations", seen)):
        fields = [c for c in rows.columns if c != "n"]
        for part, order, mode in zip(halves(rows, "n"), (fields, fields[::-1]), ("overwrite", "append")):
            extra = F.when(F.col("n") % 13 == 0, F.lit(",one,two")).otherwise(F.lit(""))
            cells = [F.coalesce(F.col(c), F.lit("")) for c in order]
            line = F.concat(F.concat_ws(",", *cells), extra).alias(",".join(order))
            write_csv(part.select(line), f"{root}/in/{name}", mode, sep="\t")
    jobs.files_to_features(spark, f"{root}/in", root, 0, F.lit(g.FEED_NOW).cast("timestamp"))
    counts = spark.read.parquet(f"{root}/scores/rows/version=0").select("domain", "read", "malformed")
    made = {"patients": "patients", "observations": "observations_by_encounter"}
    sizes = [spark.read.parquet(f"{root}/features/{t}/version=0").agg(F.lit(d).alias("domain"), F.count(F.lit(1)).alias("features")) for d, t in made.items()]
    return counts.join(reduce(DataFrame.unionByName, sizes), "domain", "left")


# ---- joins and sequences on forced paths --------------------------------------------------------------


@query
def interval_pairs(spark, sf):
    """Every encounter with every medication span that is active on its date."""
    spans = g.lines(spark, sf, kind="medications").select(
        F.col("PATIENT").alias("patient_id"),
        F.col("CODE").alias("code"),
        try_date(F.col("START")).alias("start"),
        try_date(F.col("STOP")).alias("stop"),
    )
    events = g.encounters(spark, sf).select(
        "encounter_id", "patient_id", F.col("admission_date").cast("date").alias("on_date")
    )
    found = active_interval_join(events, spans, "patient_id", "encounter_id", "on_date", "start", "stop")
    return found.select("encounter_id", "code", "start", "stop")


@query
def enrich_hot(spark, sf):
    """The split of hot keys, with a threshold that every customer's orders pass."""
    orders = g.read(spark, sf, "orders").select("o_orderkey", F.expr("nullif(o_custkey, 1)").alias("c_custkey"))
    known = g.read(spark, sf, "customer").select("c_custkey", "c_mktsegment").where("c_custkey % 4 <> 0")
    return salted_join(orders, known, ["c_custkey"], "left", ["o_orderkey"], share=1e-9, min_rows=3)


@query
def sequence_hot(spark, sf):
    """Return sequences with every patient of three encounters or more taken as hot."""
    found = sequence.return_sequence(stays(spark, sf), share=1e-9, min_rows=2)
    return found.select(
        "encounter_id", "prev_admission", "prev_discharge", "prev_los", "return_gap_days",
        "days_since_discharge", "is_readmitted_30d",
    )


@query
def sequence_one_day(spark, sf):
    """Priorities as five patients, all their visits of a year on one day: ranges are cut within the day."""
    rows = g.read(spark, sf, "orders").select(
        F.nullif(F.substring("o_orderpriority", 1, 1), F.lit("5")).alias("patient_id"),
        F.date_trunc("year", "o_orderdate").cast("date").alias("on_date"),
        "o_orderkey",
        "o_totalprice",
    )
    found = sequence.previous_event(rows, "patient_id", "on_date", "o_orderkey", ["o_orderkey", "o_totalprice"], share=1 / 64, min_rows=64)
    return found.select("o_orderkey", "prev_o_orderkey", "prev_o_totalprice")


@query
def pairs_wide(spark, sf):
    """All pairs of parts' brands that a customer has bought, from tiles of four brands."""
    bought = g.lines(spark, sf).select(F.col("PATIENT").alias("patient_id"), F.col("DESCRIPTION").alias("condition"))
    return cohort.label_pairs(bought, tile=4)
