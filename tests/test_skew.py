"""Hot-key paths against plain results: a key with a third of all rows."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from cohortflow.operators.cohort import comorbidity_pairs, label_pairs, pair_tiles
from cohortflow.operators.joins import attach_state, enrich
from cohortflow.operators.sequence import previous_event, return_sequence, top_n_per_group
from cohortflow.operators.skew import hot_keys, salted_join

FORCED = {"share": 0.05, "min_rows": 10}


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(120)}")
        data.append((i, key, f"20{rng.randrange(10, 13)}-0{rng.randrange(1, 10)}-{rng.randrange(10, 29)}"))
    df = spark.createDataFrame(data, "id int, key string, day string")
    return df.withColumn("day", F.col("day").cast("timestamp_ntz"))


def test_hot_keys_are_few_and_pieces_follow_their_share(spark, skewed):
    hot = hot_keys(skewed, ["key"], **FORCED).collect()
    assert [(r["key"], r["_pieces"]) for r in hot] == [("hot", 7)]
    assert hot_keys(skewed, ["key"]).count() == 0  # small data needs no split


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("kx", 5), (None, 6)], "key string, v int"
    )
    salted = salted_join(skewed, right, ["key"], how, **FORCED)
    assert rows(salted.select(*sorted(salted.columns))) == rows(
        skewed.join(right, "key", how).select(*sorted(salted.columns))
    )


def test_rows_without_a_key_are_dealt_over_the_tasks(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") % 100 == 0, F.col("id")).alias("key"))
    right = spark.range(50).withColumnRenamed("id", "key").withColumn("v", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        joined = salted_join(df, right, ["key"], "left", spread=["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 4000 and max(sizes) < 2 * 4000 / 4


def test_enrich_joins_each_table_once(spark):
    df = spark.createDataFrame([("e", "p")], "encounter_id string, patient_id string")
    a = spark.createDataFrame([("e", 1)], "encounter_id string, a int")
    b = spark.createDataFrame([("p", 1)], "patient_id string, b int")
    plan = enrich(df, [a, a.withColumnRenamed("a", "c")], [b])._jdf.queryExecution().optimizedPlan().toString()
    # Two row tables, one subject table, and the hot subjects at either side of its join.
    assert plan.count("Join ") == 5


def test_salted_join_rejects_other_kinds(skewed):
    with pytest.raises(ValueError):
        salted_join(skewed, skewed, ["key"], "full")


def encounters(skewed):
    stay = (F.col("id") % 4).alias("los_days")
    return skewed.where("key is not null").select(
        F.col("key").alias("patient_id"),
        F.format_string("e%04d", "id").alias("encounter_id"),
        F.col("day").alias("admission_date"),
        stay,
        F.date_add(F.col("day").cast("date"), stay.cast("int")).alias("discharge_date"),
    )


def test_return_sequence_of_a_hot_patient(skewed):
    df = encounters(skewed)
    w = Window.partitionBy("patient_id").orderBy("admission_date", "encounter_id")
    expected = df.select(
        "encounter_id",
        F.lag("admission_date").over(w).alias("prev_admission"),
        F.lag("discharge_date").over(w).alias("prev_discharge"),
        F.lag("los_days").over(w).alias("prev_los"),
    )
    split = return_sequence(df, **FORCED)
    whole = return_sequence(df)
    columns = expected.columns
    assert rows(split.select(*columns)) == rows(expected)
    assert rows(split) == rows(whole)
    assert split.where("is_readmitted_30d = 1").count() > 0


@pytest.fixture
def crowded(spark):
    """A key with a third of all rows on one day, and as many rows without a key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
    day = F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("2020-05-05")).cast("timestamp_ntz")
    at = F.when(F.col("id") % 3 == 0, F.lit("2020-05-05").cast("timestamp_ntz")).otherwise(day)
    return spark.range(3000).select(F.format_string("e%05d", F.xxhash64("id") % 1_000_003 + 2_000_000).alias("tie"), key.alias("key"), at.alias("at"), F.col("id").alias("v"))


@pytest.mark.parametrize("min_rows", [3, 40, 300, 100_000])
def test_previous_event_within_one_day(crowded, min_rows):
    w = Window.partitionBy("key").orderBy("at", "tie")
    expected = crowded.select("*", F.lag("v").over(w).alias("prev_v"))
    found = previous_event(crowded, "key", "at", "tie", ["v"], share=1e-9, min_rows=min_rows)
    assert rows(found) == rows(expected)


def test_one_day_of_a_hot_key_is_many_tasks(spark, crowded):
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        found = previous_event(crowded, "key", "at", "tie", ["v"], share=1 / 64, min_rows=10)
        for name in ("hot", None):
            part = found.where(F.col("key").eqNullSafe(F.lit(name))).groupBy(F.spark_partition_id().alias("task")).count().collect()
            assert len(part) >= 4 and max(r["count"] for r in part) < 0.5 * 1000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_enrich_keeps_every_row_once(spark, skewed):
    df = encounters(skewed)
    a = spark.createDataFrame([("hot", 1), ("k1", 2)], "patient_id string, a int")
    b = spark.createDataFrame([("hot", 5), ("k3", 6)], "patient_id string, b int")
    c = df.select("encounter_id", F.lit(9).alias("c")).limit(50)
    out = enrich(df, [c], [a, b], **FORCED)
    plain = df.join(c, "encounter_id", "left").join(a, "patient_id", "left").join(b, "patient_id", "left")
    assert rows(out.select(*plain.columns)) == rows(plain)


def test_state_join_of_a_hot_patient(spark, skewed):
    df = encounters(skewed)
    state = spark.createDataFrame(
        [("hot", "e", "2010-01-01", "2012-08-20", 2)],
        "patient_id string, last_encounter_id string, last_admission_date string, "
        "last_discharge_date string, last_los_days int",
    ).withColumn("last_discharge_date", F.col("last_discharge_date").cast("date"))
    out = attach_state(df, state, **FORCED)
    assert out.count() == df.count()
    gap = F.datediff("admission_date", F.lit("2012-08-20").cast("date"))
    expected = df.where((F.col("patient_id") == "hot") & gap.between(1, 30)).count()
    assert expected > 0
    assert out.where("is_readmitted_online = 1").count() == expected


@pytest.mark.parametrize("n", [3, 1200])
def test_top_n_with_and_without_map_side_cut(spark, n):
    df = spark.range(4000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("v"), "id")
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), "id")
    expected = df.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n).drop("r")
    out = top_n_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], n, spread=["id"])
    assert rows(out) == rows(expected)


def labels(spark, rng, hot_labels):
    data = [(p, f"L{l:02d}") for p in range(80) for l in {min(int(rng.expovariate(0.2)), 39) for _ in range(6)}]
    data += [(999, f"Z{l:03d}") for l in range(hot_labels)]  # one key with very many labels
    return spark.createDataFrame(data, "patient_id int, condition string")


def brute_pairs(df):
    df = df.distinct()
    a, b = df.alias("a"), df.alias("b")
    on = (F.col("a.patient_id") == F.col("b.patient_id")) & (F.col("a.condition") < F.col("b.condition"))
    return (
        a.join(b, on)
        .groupBy(F.col("a.condition").alias("condition_a"), F.col("b.condition").alias("condition_b"))
        .agg(F.count(F.lit(1)).alias("patient_count"))
    )


def test_label_pairs_equal_the_self_join(spark):
    df = labels(spark, random.Random(3), 30)
    assert rows(label_pairs(df)) == rows(brute_pairs(df))


@pytest.mark.parametrize("tile", [1, 4, 7, 256])
def test_label_pairs_in_tiles(spark, tile):
    """Repeated rows, keys and labels that are NULL, a key without a pair."""
    df = labels(spark, random.Random(5), 90)
    odd = spark.createDataFrame([(None, "a"), (None, "b"), (5, None), (6, "lone")], df.schema)
    df = df.unionByName(df.limit(50)).unionByName(odd)
    assert rows(label_pairs(df, tile=tile)) == rows(brute_pairs(df))
    assert label_pairs(df.limit(0), tile=tile).count() == 0


def test_a_wide_key_is_no_tasks_whole(spark):
    """One key with 20,000 labels, a third of all rows and more: tiles of bounded size, exact pairs."""
    wide = spark.range(20_000).select(F.lit(1).alias("patient_id"), F.format_string("L%05d", "id").alias("condition"))
    few = spark.range(3000).select((F.col("id") % 600 + 2).cast("int").alias("patient_id"), F.format_string("L%05d", F.pmod(F.xxhash64("id"), F.lit(37))).alias("condition"))
    df = wide.unionByName(few)
    tiles = pair_tiles(df, "patient_id", "condition", 256)
    sizes = [r.n for r in tiles.select((F.size("left") + F.size("right")).alias("n")).collect()]
    assert max(sizes) < 3 * 256 and len(sizes) > 79 * 80 / 2
    top = comorbidity_pairs(df)
    narrow = df.where("condition < 'L00037'")  # other labels are one key's alone
    best = [r for r in brute_pairs(narrow).orderBy(F.col("patient_count").desc(), "condition_a", "condition_b").limit(50).collect()]
    assert top.collect() == best and best[-1].patient_count > 1


@pytest.mark.parametrize("k", [5, 50, 5000])
def test_top_pairs_are_exact_after_pruning(spark, k):
    df = labels(spark, random.Random(4), 40)
    order = [F.col("patient_count").desc(), "condition_a", "condition_b"]
    expected = brute_pairs(df).orderBy(*order).limit(k)
    assert rows(comorbidity_pairs(df, k)) == rows(expected)
