"""SimHash fingerprints and Hamming search with permuted block tables, on DataFrame functions alone.

Each word of a text votes with its weight on every bit of the fingerprint: for the bit if its hash has it,
against it if not. Votes of two bits are summed in one long (32 bits each), so a fingerprint of
128 bits takes 64 sums over exploded words, which combine within the map tasks.

A search cuts fingerprints into blocks. Two that differ in at most ``radius`` bits agree in all but ``radius``
blocks at most, so each choice of ``blocks - radius`` blocks, moved to the front as a key, is a table, and
equality on one of the tables finds every pair. Equal fingerprints are searched for once.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

BITS = 128
RADIUS = 3
BLOCKS = 5
#: Words of up to so many characters do not vote unless a text has no longer one; longer ones weigh more.
SHORT = 3
HEAVIEST = 8
LANES = 0x0000000100000001
COPIES_AT_ONCE = 65_536


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; one empty word for a text without any."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.split(F.regexp_replace(lowered, r"^[ \t-\r]+|[ \t-\r]+$", ""), r"[ \t-\r]+", -1)


def weight(word: Column) -> Column:
    """Whole votes of one occurrence: many for long words, which are rarer and say more of a text."""
    return F.least(F.greatest(F.length(word) - SHORT, F.lit(0)), F.lit(HEAVIEST)) * 64 + 1


def fingerprints(df: DataFrame, keys: list[str], text: str, bits: int = BITS, out: str = "fingerprint") -> DataFrame:
    """``keys`` and the fingerprint of ``text`` in hexadecimal, a row per distinct ``keys``.

    Null texts are empty; all texts without words have one fingerprint. Rows that repeat the keys and the
    text give one row with the text's fingerprint: doubled votes have the same signs.
    """
    if bits % 64:
        raise ValueError("bits must be a multiple of 64")
    text_of = F.coalesce(F.col(text), F.lit(""))
    terms = df.select(*keys, F.explode(words(text_of)).alias("_word")).select(*keys, "_word", weight(F.col("_word")).cast("bigint").alias("_weight"))
    seeds = range(bits // 64)
    hashed = terms.select(*keys, "_weight", *(F.xxhash64(F.lit(seed), "_word").alias(f"_hash{seed}") for seed in seeds))
    votes = [
        F.sum(F.shiftrightunsigned(f"_hash{seed}", bit).bitwiseAND(F.lit(LANES)) * F.col("_weight")).alias(f"_votes{seed}_{bit}")
        for seed in seeds
        for bit in range(32)
    ]
    summed = hashed.groupBy(*keys).agg(F.sum("_weight").alias("_all"), *votes)

    def half(seed: int) -> Column:
        low = lambda bit: F.col(f"_votes{seed}_{bit}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = lambda bit: F.shiftrightunsigned(f"_votes{seed}_{bit}", 32)
        won = lambda count, bit: F.when(count * 2 > F.col("_all"), F.lit(1 << bit if bit < 63 else -(1 << 63))).otherwise(F.lit(0).cast("bigint"))
        parts = [won(low(bit), bit) for bit in range(32)] + [won(high(bit), bit + 32) for bit in range(32)]
        return reduce(lambda a, b: a.bitwiseOR(b), parts)

    hexed = F.concat(*(F.lower(F.lpad(F.hex(half(seed)), 16, "0")) for seed in seeds))
    return summed.select(*keys, hexed.alias(out))


def as_long(hexed: Column) -> Column:
    """Sixteen hexadecimal digits as a long."""
    part = lambda at: F.conv(F.substring(hexed, at, 8), 16, 10).cast("bigint")
    return F.shiftleft(part(1), 32).bitwiseOR(part(9))


def distance(a: Column, b: Column, bits: int = BITS) -> Column:
    """Bits in which two hexadecimal fingerprints differ."""
    parts = [F.bit_count(as_long(F.substring(a, at, 16)).bitwiseXOR(as_long(F.substring(b, at, 16)))) for at in range(1, bits // 4, 16)]
    return reduce(lambda x, y: x + y, parts)


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """Share of bits that two fingerprints have in common, 0 to 1."""
    return 1.0 - distance(a, b, bits) / F.lit(float(bits))


def block_keys(fingerprint: Column, radius: int = RADIUS, blocks: int = BLOCKS, bits: int = BITS) -> Column:
    """One key per table: the blocks of each choice in front, with the table's number."""
    if blocks <= radius:
        raise ValueError("blocks must be more than radius")
    digits = bits // 4
    edges = [digits * k // blocks for k in range(blocks + 1)]
    cut = [F.substring(fingerprint, a + 1, b - a) for a, b in zip(edges, edges[1:])]
    chosen = combinations(range(blocks), blocks - radius)
    return F.array(*(F.concat(F.lit(f"{k}:"), *(cut[i] for i in some)) for k, some in enumerate(chosen)))


def neighbours(queries: DataFrame, rows: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bits: int = BITS) -> DataFrame:
    """Distinct fingerprints of ``queries`` with those of ``rows`` within ``radius`` bits: query, found, distance.

    Both sides have a column ``fingerprint``; null ones take no part. Join back for the documents of each.
    """
    each = lambda df: df.select("fingerprint").where("fingerprint is not null").distinct()
    keyed = lambda df, name: each(df).select(F.col("fingerprint").alias(name), F.explode(block_keys(F.col("fingerprint"), radius, blocks, bits)).alias("key"))
    apart = distance(F.col("query"), F.col("found"), bits)
    met = keyed(queries, "query").join(keyed(rows, "found"), "key")
    return met.where(apart <= radius).select("query", "found", apart.alias("distance")).distinct()


def text_mark(text: Column) -> Column:
    """128 bits that tell the different texts of one doc_id apart."""
    return F.md5(text)


def next_documents(documents: DataFrame) -> DataFrame:
    """doc_id, mark, next_id, next_mark, half of the different documents: each one's next, and half its length.

    Documents are ordered by doc_id and mark; the next is the one before, for the first one the last. They are dealt
    by ranges of both, so many texts of one doc_id are split too, written, and looked at range by range; only each
    range's last document meets the others, one row per range.
    """
    from cohortflow.llm.common import stage
    from pyspark.sql import Window

    each = documents.select("doc_id", text_mark(F.col("text")).alias("mark"), F.floor(F.length("text") / 2).cast("int").alias("half")).distinct()
    each = each.withColumn("key", F.struct("doc_id", "mark"))
    dealt = stage(each.repartitionByRange("key").withColumn("_range", F.spark_partition_id()), "ranges")
    tops = dealt.groupBy("_range").agg(F.max("key").alias("_top"))
    whole = Window.orderBy("_range")
    below = tops.select("_range", F.coalesce(F.lag("_top").over(whole), F.max("_top").over(Window.partitionBy())).alias("_below"))
    own = Window.partitionBy("_range").orderBy("key")
    following = F.coalesce("_own", "_below")
    found = dealt.withColumn("_own", F.lag("key").over(own)).join(F.broadcast(below), "_range")  # a row per range
    return found.select("doc_id", "mark", following["doc_id"].alias("next_id"), following["mark"].alias("next_mark"), "half")


def edited_texts(documents: DataFrame) -> DataFrame:
    """doc_id, mark, copies, next_id, next_mark, text, edited, and own_edited where there are copies.

    A row stands for all ``copies`` of one doc_id and text. ``edited`` is the text with its last half replaced by
    the head of the next document's. Among copies the next of all but one is a copy: ``own_edited`` is their edited
    text. Null texts are empty. Only the head that is needed is sent to the document that needs it.
    """
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where("doc_id is not null")
    nexts = next_documents(texts)
    texts = texts.withColumn("mark", text_mark(F.col("text"))).groupBy("doc_id", "mark").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    wants = nexts.select(F.col("doc_id").alias("wanted_by"), F.col("mark").alias("wanted_mark"), F.col("next_id").alias("doc_id"), F.col("next_mark").alias("mark"), "half")
    heads = texts.where("copies > 0").join(wants, ["doc_id", "mark"]).select(  # with all columns, so both reads share one shuffle
        F.col("wanted_by").alias("doc_id"), F.col("wanted_mark").alias("mark"), F.col("doc_id").alias("next_id"), F.col("mark").alias("next_mark"), F.substring("text", F.lit(1), F.col("half")).alias("head")
    )
    half = F.floor(F.length("text") / 2).cast("int")
    first = F.substring("text", F.lit(1), F.length("text") - half)
    own = F.when(F.col("copies") > 1, F.concat(first, F.substring("text", F.lit(1), half)))
    return texts.join(heads, ["doc_id", "mark"]).select("doc_id", "mark", "copies", "next_id", "next_mark", "text", F.concat(first, "head").alias("edited"), own.alias("own_edited"))


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times, without that column; no array is longer than ``COPIES_AT_ONCE``."""
    last = F.floor((F.col(times) - 1) / COPIES_AT_ONCE)
    blocks = df.where(F.col(times) > 0).withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    size = F.least(F.col(times) - F.col("_block") * COPIES_AT_ONCE, F.lit(COPIES_AT_ONCE)).cast("int")
    return blocks.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), size))).drop("_block", "_copy", times)


def edit_likeness(documents: DataFrame, bits: int = BITS) -> DataFrame:
    """Fingerprints of each text, its edited text and the next document's, and how alike they are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; a row per
    row. Rows without doc_id are left out. Different texts of one doc_id are documents of their own, in the order of
    a hash; of equal rows all but one have a copy as their next. An empty table gives an empty result.
    """
    from cohortflow.llm.common import stage

    pairs = edited_texts(documents)
    kind = lambda edit, text: F.struct(F.lit(edit).alias("edit"), F.col(text).alias("text"))
    kinds = F.filter(F.array(kind(0, "text"), kind(1, "edited"), kind(2, "own_edited")), lambda k: k["text"].isNotNull())
    facts = ["doc_id", "mark", "next_id", "next_mark", "copies", "n_chars", "edited_sha256", "own_sha256"]
    rows = pairs.withColumns({"n_chars": F.length("text").cast("bigint"), "edited_sha256": F.sha2("edited", 256), "own_sha256": F.sha2("own_edited", 256)})
    rows = rows.select(*facts, F.explode(kinds).alias("kind")).select(*facts, "kind.edit", "kind.text")
    marked = fingerprints(rows, [*facts, "edit"], "text", bits)
    by_edit = lambda edit: F.max(F.when(F.col("edit") == edit, F.col("fingerprint")))
    each = marked.groupBy(*facts).agg(by_edit(0).alias("fingerprint"), by_edit(1).alias("edited_fingerprint"), by_edit(2).alias("own_fingerprint"))
    each = stage(each, "fingerprints")
    following = each.select(F.col("doc_id").alias("next_id"), F.col("mark").alias("next_mark"), F.col("fingerprint").alias("next_fingerprint"))
    both = each.join(following, ["next_id", "next_mark"])
    one = lambda times, sha, edited, near: F.struct(
        times.alias("times"), F.col(sha).alias("edited_sha256"), F.col(edited).alias("edited_fingerprint"), F.col(near).alias("next_fingerprint")
    )
    others = one(F.col("copies") - 1, "own_sha256", "own_fingerprint", "fingerprint")
    kinds = F.array(one(F.lit(1).cast("bigint"), "edited_sha256", "edited_fingerprint", "next_fingerprint"), others)
    rows = both.select("doc_id", "n_chars", "fingerprint", F.explode(kinds).alias("row")).select("doc_id", "n_chars", "fingerprint", "row.*")
    return repeated(rows, "times").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), bits).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), bits).alias("near_next"),
    )
