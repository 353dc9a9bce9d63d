from conftest import rows
from pyspark.sql import functions as F

from cohortflow.operators.joins import upsert_counts
from cohortflow.operators.tables import align, current_rows, merge_upsert, upsert_if_newer
from cohortflow.sources.files import publish_upsert, read_buckets


def test_upsert_evolves_the_schema_and_matches_null_keys(spark):
    target = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, j string, v int")
    source = spark.createDataFrame([("a", None, 9, "new")], "k string, j string, v int, w string")
    assert align(target, source).columns == ["k", "j", "v", "w"]
    safe = merge_upsert(target, source, ["k", "j"], null_safe=True)
    assert rows(safe) == [("a", None, 9, "new"), ("b", "x", 2, None)]
    assert merge_upsert(target, source, ["k", "j"]).count() == 3
    counts = upsert_counts(source, target, ["k"]).first()
    assert (counts.records_updated, counts.records_inserted) == (1, 0)


def test_newer_or_equal_source_wins(spark):
    target = spark.createDataFrame([("a", 5, "t"), ("b", 5, "t"), ("c", 5, "t")], "k string, at int, v string")
    source = spark.createDataFrame([("a", 4, "s"), ("b", 5, "s"), ("d", 1, "s")], "k string, at int, v string")
    out = upsert_if_newer(target, source, ["k"], "at")
    assert rows(out.select("k", "v")) == [("a", "t"), ("b", "s"), ("c", "t"), ("d", "s")]


def test_last_load_of_a_key_is_current(spark):
    log = spark.createDataFrame([("a", 1, 0, "old"), ("a", 2, 0, "new"), ("b", 1, 1, "only")],
                                "k string, loaded_at int, batch_id int, v string")
    assert rows(current_rows(log, ["k"]).select("k", "v")) == [("a", "new"), ("b", "only")]


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows_of = lambda df: sorted(map(tuple, df.collect()), key=repr)
    first = spark.range(10_000).select(F.col("id").cast("string").alias("k"), F.lit("a").alias("part"), F.lit(1).alias("v"))
    publish_upsert(first.unionByName(spark.createDataFrame([(None, "a", 1)], "k string, part string, v int")), path, ["k", "part"], 256)
    written = {(p, p.stat().st_mtime_ns) for p in (tmp_path / "t").rglob("*.parquet")}
    few = spark.createDataFrame([("5", "a", 2, "x"), (None, "a", 2, "y"), ("new", "b", 2, "z")], "k string, part string, v int, extra string")
    touched = publish_upsert(few, path, ["k", "part"], 256)
    kept = {(p, p.stat().st_mtime_ns) for p in (tmp_path / "t").rglob("*.parquet")} & written
    assert len(touched) <= 3 and {p.parent.name for p, _ in written - kept} == {f"_bucket={b}" for b in touched if (tmp_path / "t" / f"_bucket={b}").exists()} & {p.parent.name for p, _ in written}
    now = read_buckets(spark, path)
    assert now.count() == 10_002
    assert rows_of(now.where("v = 2").select("k", "part", "extra")) == rows_of(few.select("k", "part", "extra"))
    before = rows_of(now)
    publish_upsert(few, path, ["k", "part"], 256)
    assert rows_of(read_buckets(spark, path)) == before
    assert publish_upsert(few.limit(0), path, ["k", "part"], 256) == [] and read_buckets(spark, path).count() == 10_002
