"""Divergence of the sources of each language, from exact term counts.

``CountVectorizer`` with a minimum document frequency and the largest integer as the size of its vocabulary is
fitted on all languages at once: terms carry their language, so the one model holds a vocabulary of
its own for each language, however many there are. Documents become sparse vectors over the model's items, whole
slices of them together, and are summed by source in the tasks before anything is shuffled. Pairs of
sources are evaluated on the sums' occurring terms alone: what terms without occurrences add depends
only on the two sources, what a term of one source adds only on its count there, and just terms of both are met
as pairs, in slices of numpy arrays that leave one sum per pair.

* The model is fitted on reduced bags: a slice gives a term to ``min_docs`` of its documents at most, which decides
  as well whether that many hold it and keeps the fit's integer counters small.
* The vocabulary goes through the driver and to all workers, so it is measured first. Beyond ``VOCABULARY_TERMS`` or
  ``VOCABULARY_BYTES`` the same sums come from tokens grouped in Spark and joined with the kept terms.
* ``CountVectorizerModel.transform`` gives the same vectors; it took 640 of 1,089 CPU seconds a GB, so the items of a
  slice's different terms are looked up together instead.
* All numbers are integers; shares are in billionths, rounded as the definition says.

A null text, language or source reads as ''. Sources without a term are groups too. Equal rows each count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortflow.llm.common import BROADCAST_KEYS, drop_stage, scratch_path, slices, stage

MIN_DOCS = 3
LARGEST_INT = 2**31 - 1
TOP_TERMS = 200
SHARES = 1_000_000_000
#: So many kept terms, some hundred MB as the driver holds them, and bytes of them may make up a model.
VOCABULARY_TERMS = 1 << 20
VOCABULARY_BYTES = 64 << 20
#: Bytes of text that are cut into terms together.
TEXT_SLICE = 16 << 20
#: Term pairs of sources evaluated together.
PAIR_SLICE = 1 << 20
#: Sums of pairs are taken in a table of this size, over sorted codes beyond.
PAIR_TABLE = 1 << 22
#: Parts a term from its language; no term holds it.
MARK = "\x00"

#: ASCII letters in lower case and all bytes beyond ASCII stay, others (0) part the terms.
TERM_BYTES = np.array([b if b > 0x7F else ord(chr(b).lower()) if chr(b).isalpha() else 0 for b in range(256)], np.uint8)


@dataclass(frozen=True)
class Settings:
    """Documents that must hold a kept term, ranks of terms reported, and what a model may hold."""

    min_docs: int = MIN_DOCS
    top_terms: int = TOP_TERMS
    vocabulary_terms: int = VOCABULARY_TERMS
    vocabulary_bytes: int = VOCABULARY_BYTES


def plain(documents: DataFrame) -> DataFrame:
    """lang, source and text without nulls."""
    return documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def cut_terms(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Terms ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of all texts, A-Z lower-cased, and the text of each."""
    edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    low = TERM_BYTES[data]
    inside = low != 0
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    at_edge = edges[:-1][edges[:-1] < len(data)]
    opens[at_edge] = inside[at_edge]
    starts = np.flatnonzero(opens[inside])
    offsets = np.append(starts, np.count_nonzero(inside)).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(low[inside]))
    return terms, np.searchsorted(edges, np.flatnonzero(opens), "right") - 1


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.DictionaryArray, pa.RecordBatch, pa.DictionaryArray, np.ndarray]]:
    """Slices of rows with their languages and their terms, each as codes of a dictionary, and the row of each term."""
    for batch in batches:
        for part in slices(batch, "text", TEXT_SLICE):
            terms, rows = cut_terms(part.column("text").cast(pa.string()))
            yield part.column("lang").dictionary_encode(), part, terms.dictionary_encode(), rows


def codes_of(encoded: pa.DictionaryArray) -> np.ndarray:
    return np.asarray(encoded.indices).astype(np.int64)


def tokens(langs: pa.Array, terms: pa.Array) -> pa.Array:
    """Terms with their languages before them."""
    return pc.binary_join_element_wise(langs, terms, MARK)


def reduced_bags(docs: DataFrame, min_docs: int) -> DataFrame:
    """``bag``: of each document its different terms, but a term only of the first ``min_docs`` documents of a slice."""

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, part, terms, rows in parts_of(batches):
            wide, high = len(terms.dictionary), max(part.num_rows, 1)
            held = np.sort((codes_of(langs)[rows] * wide + codes_of(terms)) * high + rows)
            held = held[np.r_[True, held[1:] != held[:-1]]] if len(held) else held
            token, row = np.divmod(held, high)
            first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, np.int64)
            rank = np.arange(len(token)) - np.repeat(first, np.diff(np.r_[first, len(token)]))
            token, row = token[rank < min_docs], row[rank < min_docs]
            order = np.argsort(row, kind="stable")
            token, row = token[order], row[order]
            names = tokens(langs.dictionary.take(pa.array(token // max(wide, 1))), terms.dictionary.take(pa.array(token % max(wide, 1))))
            offsets = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), names)], ["bag"])

    return docs.mapInArrow(reduced, "bag array<string>").where(F.size("bag") > 0)


def unmarked(token: Column) -> tuple[Column, Column]:
    """Language and term of a token; a language may hold the mark, a term never."""
    term = F.substring_index(token, MARK, -1)
    return F.left(token, F.length(token) - F.length(term) - 1).alias("lang"), term.alias("term")


def source_counts(
    langs: pa.DictionaryArray, part: pa.RecordBatch, terms: pa.DictionaryArray, rows: np.ndarray
) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Sums of a slice's term vectors by source: language code, source, term code and count of each entry."""
    sources = part.column("source").dictionary_encode()
    wide, many = max(len(terms.dictionary), 1), max(len(sources.dictionary), 1)
    group = codes_of(langs)[rows] * many + codes_of(sources)[rows]
    entries, n = np.unique(group * wide + codes_of(terms), return_counts=True)
    group, term = np.divmod(entries, wide)
    return group // many, sources.dictionary.take(pa.array(group % many)), term, n


def vector_sums(docs: DataFrame, bags: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """Sums of the documents' vectors by source as (source, item, n), and the model's (item, lang, term)."""
    spark = docs.sparkSession
    model = CountVectorizer(inputCol="bag", outputCol="counts", minDF=min_docs, vocabSize=LARGEST_INT).fit(bags)
    path = scratch_path(spark, "vocabulary")
    model.write().overwrite().save(path)
    named = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("item", "token")).select("item", *unmarked(F.col("token")))
    sink = pa.BufferOutputStream()
    vocabulary = named.toArrow().combine_chunks()  # within the bounds checked before
    with pa.ipc.new_stream(sink, vocabulary.schema) as writer:
        writer.write_table(vocabulary)
    shipped = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pa.ipc.open_stream(shipped.value).read_all()
        by_lang: dict[str, tuple[pa.Array, np.ndarray]] = {}

        def items(lang: str) -> tuple[pa.Array, np.ndarray]:
            if lang not in by_lang:
                own = model.filter(pc.equal(model["lang"], lang)).combine_chunks()
                by_lang[lang] = own["term"].combine_chunks(), np.asarray(own["item"]).astype(np.int64)
            return by_lang[lang]

        for langs, part, terms, rows in parts_of(batches):
            lang, source, term, n = source_counts(langs, part, terms, rows)
            for code, name in enumerate(langs.dictionary.to_pylist()):
                known, numbers = items(name)
                here = np.flatnonzero(lang == code)
                if not len(known) or not len(here):
                    continue
                found = pc.index_in(terms.dictionary, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False)[term[here]]
                here, found = here[found >= 0], found[found >= 0]
                yield pa.RecordBatch.from_arrays([source.take(pa.array(here)), pa.array(numbers[found]), pa.array(n[here])], ["source", "item", "n"])

    return docs.mapInArrow(summed, "source string, item bigint, n bigint").groupBy("source", "item").agg(F.sum("n").alias("n")), named


def token_sums(docs: DataFrame) -> DataFrame:
    """The same with the token itself as the item, of all terms."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, part, terms, rows in parts_of(batches):
            lang, source, term, n = source_counts(langs, part, terms, rows)
            names = tokens(langs.dictionary.take(pa.array(lang)), terms.dictionary.take(pa.array(term)))
            yield pa.RecordBatch.from_arrays([source, names, pa.array(n)], ["source", "item", "n"])

    return docs.mapInArrow(summed, "source string, item string, n bigint").groupBy("source", "item").agg(F.sum("n").alias("n"))


def group_sums(docs: DataFrame, settings: Settings) -> DataFrame:
    """Occurrences ``n`` of each kept ``term`` in each group (lang, source) that has any."""
    bags = stage(reduced_bags(docs, settings.min_docs), "bags")
    kept = stage(bags.select(F.explode("bag").alias("item")).groupBy("item").count().where(F.col("count") >= settings.min_docs).select("item"), "kept")
    terms, size = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("item")), F.lit(0))).first()
    if 0 < terms <= settings.vocabulary_terms and size <= settings.vocabulary_bytes:
        sums, named = vector_sums(docs, bags, settings.min_docs)
        sums = sums.join(named, "item")
    else:
        sums = token_sums(docs).join(kept, "item", "left_semi").select("*", *unmarked(F.col("item")))
    sums = stage(sums.select("lang", "term", "source", "n"), "sums")
    drop_stage(bags)
    drop_stage(kept)
    return sums


def share(n: Column, total: Column) -> Column:
    """1 + floor(10^9 (n + 1) / total), wide enough for any count."""
    return F.call_function("div", (n + 1).cast("decimal(38,0)") * F.lit(SHARES), total.cast("decimal(38,0)")) + 1


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def group_table(docs: DataFrame, sums: DataFrame) -> DataFrame:
    """Every group with its number ``s`` in the language, its total and the language's (N + V), and the share of a term it lacks.

    In a language without kept terms totals are 0 and shares null.
    """
    kept = sums.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_n"))
    totals = sums.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kept, "lang", "left")
    v = F.coalesce("v", F.lit(0))
    total = F.coalesce("n", F.lit(0)) + v
    return groups.select(
        "lang",
        "source",
        F.row_number().over(Window.partitionBy("lang").orderBy("source")).alias("s"),
        v.alias("v"),
        total.alias("total"),
        (F.coalesce("lang_n", F.lit(0)) + v).alias("lang_total"),
        F.when(v > 0, share(F.lit(0).cast("bigint"), F.when(total > 0, total))).alias("z"),
    )


def pair_codes(counts: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (left, right) of pairs ``start`` to ``end`` when each run of ``counts`` entries is paired with itself."""
    first = np.cumsum(counts) - counts
    before = np.cumsum(counts * counts)
    number = np.arange(start, end)
    run = np.searchsorted(before, number, "right")
    inside = number - (before[run] - counts[run] ** 2)
    left, right = np.divmod(inside, counts[run])
    return first[run] + left, first[run] + right


def exact_sums(codes: np.ndarray, values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Different codes and the sums of their values, exact: halves of values add up below 2^53."""
    if size > PAIR_TABLE:
        names, codes = np.unique(codes, return_inverse=True)
        size = len(names)
    else:
        names = np.arange(size)
    low = np.bincount(codes, values & 0xFFFFFFFF, size).astype(np.int64)
    high = np.bincount(codes, values >> 32, size).astype(np.int64)
    there = np.flatnonzero(np.bincount(codes, minlength=size))
    return names[there], (high[there] << 32) + low[there]


def common_terms(terms: DataFrame) -> DataFrame:
    """What terms that both sources of a pair have add to what each adds alone: (lang, a, b, value) partial sums."""

    def evaluated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = lambda p, q: (p - q) ** 2 // q
        for batch in batches:
            lists = batch.column("entries")
            offsets, fields = np.asarray(lists.offsets), lists.values
            s, p, z = (np.asarray(fields.field(name))[offsets[0] : offsets[-1]].astype(np.int64) for name in ("s", "p", "z"))
            langs = batch.column("lang").dictionary_encode()
            counts = np.diff(offsets).astype(np.int64)
            lang = np.repeat(np.asarray(langs.indices).astype(np.int64), counts)
            wide = int(s.max(initial=0)) + 1
            size = len(langs.dictionary) * wide * wide
            pairs = int((counts**2).sum())
            for start in range(0, pairs, PAIR_SLICE):
                i, j = pair_codes(counts, start, min(start + PAIR_SLICE, pairs))
                i, j = i[i != j], j[i != j]
                value = f(p[i], p[j]) - f(p[i], z[j]) - f(z[i], p[j]) + f(z[i], z[j])
                codes, sums = exact_sums((lang[i] * wide + s[i]) * wide + s[j], value, size)
                names = langs.dictionary.take(pa.array(codes // (wide * wide)))
                yield pa.RecordBatch.from_arrays([names, pa.array(codes // wide % wide), pa.array(codes % wide), pa.array(sums)], ["lang", "a", "b", "value"])

    return terms.select("lang", "entries").mapInArrow(evaluated, "lang string, a bigint, b bigint, value bigint")


def pair_values(groups: DataFrame, terms: DataFrame, few: bool) -> DataFrame:
    """(lang, a, b, value) of every ordered pair of a language's sources."""
    other = groups.select("lang", F.col("s").alias("o"), F.col("z").alias("oz"))
    other = F.broadcast(other) if few else other
    lone = groups.join(other, "lang").where("s <> o")
    base = lone.select("lang", F.col("s").alias("a"), F.col("o").alias("b"), F.coalesce(F.col("v") * excess(F.col("z"), F.col("oz")), F.lit(0).cast("bigint")).alias("value"))
    entry = F.explode("entries").alias("e")
    levels = terms.select("lang", entry).groupBy("lang", F.col("e.s").alias("s"), F.col("e.p").alias("p"), F.col("e.z").alias("z")).agg(F.count(F.lit(1)).alias("m"))
    met = levels.join(other, "lang").where("s <> o")
    as_left = F.col("m") * (excess(F.col("p"), F.col("oz")) - excess(F.col("z"), F.col("oz")))
    as_right = F.col("m") * (excess(F.col("oz"), F.col("p")) - excess(F.col("oz"), F.col("z")))
    sides = F.array(F.struct(F.col("s").alias("a"), F.col("o").alias("b"), as_left.alias("value")), F.struct(F.col("o").alias("a"), F.col("s").alias("b"), as_right.alias("value")))
    alone = met.select("lang", F.explode(sides).alias("x")).select("lang", "x.*")
    return base.unionByName(alone).unionByName(common_terms(terms)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each group's divergence from the other sources of its language (part ``pair``) and its terms most above the language's share (part ``term``).

    Columns lang, source, part, item, value, rank. An empty table gives no rows.
    """
    docs = plain(documents)
    sums = group_sums(docs, settings)
    groups = stage(group_table(docs, sums), "groups")
    few = groups.count() <= BROADCAST_KEYS
    beside = groups.where("v > 0").select("lang", "source", "s", "total", "lang_total", "z")
    known = sums.join(F.broadcast(beside) if few else beside, ["lang", "source"])
    entry = F.struct("s", "n", share(F.col("n"), F.col("total")).alias("p"), "z")
    terms = stage(known.groupBy("lang", "term").agg(F.collect_list(entry).alias("entries"), F.first("lang_total").alias("lang_total")), "terms")

    numbers = groups.select("lang", "source", "s")
    name = lambda number, column: (F.broadcast(renamed) if few else renamed) if (renamed := numbers.withColumnsRenamed({"s": number, "source": column})) else None
    pairs = pair_values(groups, terms, few).join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    whole = F.aggregate("entries", F.lit(0).cast("bigint"), lambda total, e: total + e["n"])
    over = terms.select("lang", F.col("term").alias("item"), share(whole, F.col("lang_total")).alias("q"), F.explode("entries").alias("e"))
    over = over.where("e.p > q").select("lang", F.col("e.s").alias("a"), "item", excess(F.col("e.p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "a").orderBy(F.desc("value"), "item"))
    best = over.withColumn("rank", rank).where(F.col("rank") <= settings.top_terms)
    best = best.join(name("a", "source"), ["lang", "a"]).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    return ranked.unionByName(best)
