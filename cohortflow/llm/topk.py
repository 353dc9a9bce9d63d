"""Exact top-k inner products by a three-phase uniform threshold.

Vectors are cut into ``lists`` of neighbouring components, and a pair's score is the sum of its local scores.

1. Each list sends the ``k`` best local scores of every query, per block of vectors. Whole scores of the
   vectors named so give a safe cutoff: the query's k-th best score is at least the k-th best of these.
2. The cutoff goes back to the blocks. Scores that reach it have a local score of at least cutoff / lists
   somewhere, so each list sends all entries from there on; whatever is named nowhere cannot be among the best.
3. A named vector's score is at most what was sent of it plus, for each silent list, just under cutoff / lists.
   Those that can still reach the cutoff are scored exactly, and the k best are taken.

Equal vectors are searched once, by their ``k + 1`` smallest ids: ties go to smaller ids and a query leaves out
only itself, so no other can be in a result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortflow.llm.common import stage

SCALE = 256
EVERY = 50
K = 5
LISTS = 2
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 2048
STEP_QUERIES = 256
EXACT_FLOAT = 1 << 53
#: Squared norm of whole components below which all inner products are sure to fit 64 bits.
NORM_LIMIT = float(1 << 62)

ENTRIES = "query bigint, vector bigint, list int, local bigint"


def quantised(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``id`` and ``x``: whole components floor(scale * x). Rows with a null key are left out, as are vectors
    that are null, empty, hold null or non-finite components, or are so long (2**31 and more, scaled) that scores could exceed 64 bits."""
    whole = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = embeddings.select(F.col(key).alias("id"), whole.alias("v"), bad.alias("bad")).where("id is not null and v is not null and size(v) > 0 and not bad")
    longest = F.aggregate("v", F.lit(0.0), lambda total, x: total + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1))
    rows = rows.where(longest < NORM_LIMIT)
    return rows.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("bigint")).alias("x"))


def block_of(key: Column, size: int, n: int) -> Column:
    """Number of the block a row falls in, by a hash of its key."""
    return F.pmod(F.xxhash64(key), F.lit(max(1, -(-n // size)))).cast("int")


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of rows; by doubles where they are sure to be exact."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < EXACT_FLOAT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def edges_of(width: int, lists: int) -> list[tuple[int, int]]:
    """Where each list's components begin and end."""
    return [(width * j // lists, width * (j + 1) // lists) for j in range(lists)]


def in_blocks(queries: DataFrame, vectors: DataFrame, query_blocks: int, blocks: int, pick, schema: str) -> DataFrame:
    """``pick(queries, x, cutoffs, ids, y)`` for each block of queries with each block of vectors.

    Either side is sent once per block of the other, so a task holds one block of each whatever their number.
    """
    upto = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    ask = queries.select("query_block", upto(blocks, "block"), F.col("id").alias("query"), "x", "cutoff")
    rows = vectors.select(upto(query_blocks, "query_block"), "block", "id", "x")
    names = [field.split(" ")[0] for field in schema.split(", ")]

    def met(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({name: pd.Series(dtype="int64") for name in names})]
        if len(asked) and len(held):
            y, ids = np.stack(held["x"].to_numpy()), held["id"].to_numpy()
            for start in range(0, len(asked), STEP_QUERIES):
                some = asked.iloc[start : start + STEP_QUERIES]
                found += pick(some["query"].to_numpy(), np.stack(some["x"].to_numpy()), some["cutoff"].to_numpy(), ids, y)
        return pd.concat(found[1:] or found, ignore_index=True)

    return ask.groupBy("query_block", "block").cogroup(rows.groupBy("query_block", "block")).applyInPandas(met, schema)


def best_locals(k: int, lists: int):
    """Phase 1 in a block: every list's k best local scores of each query."""

    def pick(queries: np.ndarray, x: np.ndarray, cutoff: np.ndarray, ids: np.ndarray, y: np.ndarray) -> list[pd.DataFrame]:
        found = []
        for j, (a, b) in enumerate(edges_of(x.shape[1], lists)):
            scores = exact_products(x[:, a:b], y[:, a:b])
            few = min(k + 1, scores.shape[1])
            top = np.argpartition(-scores, few - 1, axis=1)[:, :few]
            rows = np.repeat(np.arange(len(x)), few)
            found.append(pd.DataFrame({"query": queries[rows], "vector": ids[top.ravel()], "list": j, "local": scores[rows, top.ravel()]}))
        return found

    return pick


def sufficient(lists: int):
    """Phase 2 in a block: every list's local scores from the cutoff's share on."""

    def pick(queries: np.ndarray, x: np.ndarray, cutoff: np.ndarray, ids: np.ndarray, y: np.ndarray) -> list[pd.DataFrame]:
        found = []
        share = -(-cutoff // lists)
        for j, (a, b) in enumerate(edges_of(x.shape[1], lists)):
            scores = exact_products(x[:, a:b], y[:, a:b])
            rows, columns = np.nonzero(scores >= share[:, None])
            found.append(pd.DataFrame({"query": queries[rows], "vector": ids[columns], "list": j, "local": scores[rows, columns]}))
        return found

    return pick


def dot(a: str, b: str) -> Column:
    """Inner product of two arrays of longs."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("bigint"), lambda s, x: s + x)


def scores_of(pairs: DataFrame, classes: DataFrame, queries: DataFrame) -> DataFrame:
    """Pairs (query, vector) with their whole score."""
    own = queries.select(F.col("id").alias("query"), F.col("x").alias("qx"))
    theirs = classes.select(F.col("id").alias("vector"), "x")
    return pairs.join(own, "query").join(theirs, "vector").select("query", "vector", dot("qx", "x").alias("score"))


def best(rows: DataFrame, k: int, query: str, order: list[Column], out: str) -> DataFrame:
    """The first k rows of each query; a task that makes rows keeps k of each query before they are sent."""
    return rows.withColumn(out, F.row_number().over(Window.partitionBy(query).orderBy(*order))).where(F.col(out) <= k)


def top_k(embeddings: DataFrame, k: int = K, every: int = EVERY, lists: int = LISTS) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each vector whose id is divisible by ``every``.

    All other vectors are candidates; ties go to smaller ids; fewer rows where there are fewer candidates. Vectors
    of different lengths never meet. Rows that repeat an id are vectors of their own: each is a candidate for the others, and
    each asks for itself. An empty table gives an empty result.
    """
    rows = quantised(embeddings).withColumns({"width": F.size("x"), "row": F.monotonically_increasing_id()})
    rows = stage(rows, "vectors")  # rows keep their numbers from here on
    result = None
    widths = [row.width for row in rows.select("width").distinct().collect()] or [0]
    for width in sorted(widths):
        part = of_one_width(rows.where(F.col("width") == width).drop("width"), k, every, min(lists, max(1, width)))
        result = part if result is None else result.unionByName(part)
    return result


def of_one_width(rows: DataFrame, k: int, every: int, lists: int) -> DataFrame:
    """``top_k`` of quantised vectors that all have one length."""
    place = Window.partitionBy("x").orderBy("id")
    copies = rows.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1)
    names = F.collect_list("id")  # k + 1 at most
    classes = copies.groupBy("x").agg(F.sort_array(names).alias("ids")).withColumn("id", F.monotonically_increasing_id())
    classes = stage(classes, "classes")
    n = classes.count()
    asked = rows.where(F.col("id") % every == 0)
    queries = asked.select("x").distinct().join(classes.select("x", "id"), "x").select("id", "x")
    n_queries = max(1, queries.count())
    blocks, query_blocks = max(1, -(-n // BLOCK_VECTORS)), max(1, -(-n_queries // BLOCK_QUERIES))
    vectors = classes.select("id", "x", block_of(F.col("id"), BLOCK_VECTORS, n).alias("block"))
    queries = queries.withColumn("query_block", block_of(F.col("id"), BLOCK_QUERIES, n_queries))

    first = in_blocks(queries.withColumn("cutoff", F.lit(0).cast("bigint")), vectors, query_blocks, blocks, best_locals(k, lists), ENTRIES)
    named = stage(first.select("query", "vector").distinct(), "named")
    whole = scores_of(named, classes, queries).join(classes.select(F.col("id").alias("vector"), F.size("ids").alias("copies")), "vector")
    whole = whole.withColumn("copies", F.col("copies") - F.when(F.col("query") == F.col("vector"), 1).otherwise(0))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vector").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = whole.withColumn("held", F.sum("copies").over(order)).where(F.col("held") >= k)
    cutoffs = reached.groupBy("query").agg(F.max("score").alias("cutoff"))
    lowest = F.lit(-(1 << 60)).cast("bigint")
    with_cutoff = queries.join(cutoffs.select(F.col("query").alias("id"), "cutoff"), "id", "left").withColumn("cutoff", F.coalesce("cutoff", lowest))
    with_cutoff = stage(with_cutoff, "cutoffs")

    sent = in_blocks(with_cutoff, vectors, query_blocks, blocks, sufficient(lists), ENTRIES)
    most = sent.groupBy("query", "vector").agg(F.sum("local").alias("seen"), F.count(F.lit(1)).alias("lists"))
    limit = F.ceil(F.col("cutoff") / lists).cast("bigint") - 1
    able = most.join(with_cutoff.select(F.col("id").alias("query"), "cutoff"), "query").where(F.col("seen") + (lists - F.col("lists")) * limit >= F.col("cutoff"))
    final = scores_of(able.select("query", "vector"), classes, queries)
    same = asked.join(classes.select("x", F.col("id").alias("query")), "x").select("query", "row", F.col("id").alias("query_id"))
    members = final.join(classes.select(F.col("id").alias("vector"), "ids"), "vector").select("query", "vector", "score", "ids", F.posexplode("ids").alias("at", "vec_id"))
    own = (F.col("query") == F.col("vector")) & (F.array_position("ids", F.col("vec_id")) == F.col("at") + 1)  # one row of a query's vector and id is itself
    members = members.select("query", "score", "vec_id", own.alias("own"))
    members = best(members, k + 1, "query", [F.desc("score"), F.col("vec_id")], "place")
    pairs = same.join(members, "query").where("not (own and query_id = vec_id)")
    ranked = best(pairs, k, "row", [F.desc("score"), F.col("vec_id")], "rank")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
