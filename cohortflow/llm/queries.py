"""Registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortflow.llm import bpe, divergence, fim, langid, linedup, lm, minhash, packing, sharding, simhash, topk, urlfilter, warc
from cohortflow.llm.common import stage, table, texts_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded; digests of ids and text."""
    documents = texts_of(table(spark, sf_dir, "documents"))
    lexicon = bpe.ship_lexicon(documents, VOCABULARY)
    return bpe.roundtrip(documents, VOCABULARY, lexicon)


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness."""
    return simhash.edit_likeness(table(spark, sf_dir, "documents"))


def simhash_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every fiftieth document, how many different fingerprints lie within the radius, its own included."""
    documents = texts_of(table(spark, sf_dir, "documents")).where("doc_id is not null")
    documents = documents.withColumn("mark", simhash.text_mark(F.col("text")))
    marks = stage(simhash.fingerprints(documents, ["doc_id", "mark"], "text"), "marks")
    asked = marks.where(F.col("doc_id") % 50 == 0)
    found = simhash.neighbours(asked, marks).groupBy("query").agg(F.count(F.lit(1)).alias("n_near"), F.max("distance").alias("farthest"))
    return asked.join(found, asked["fingerprint"] == found["query"]).select("doc_id", "fingerprint", "n_near", "farthest")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, and whether it is accepted."""
    documents = table(spark, sf_dir, "documents")
    return langid.identify(langid.document_evidence(documents), langid.train(documents), ["doc_id"])


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page, by text, markup, address and host; the text model comes from documents."""
    model = langid.train(table(spark, sf_dir, "documents"))
    return langid.identify(langid.page_evidence(table(spark, sf_dir, "pages")), model, ["page_id"])


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's address."""
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op7_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.archive_roundtrip(spark, table(spark, sf_dir, "pages"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model score of every document."""
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of recurring templates."""
    return linedup.drop_recurring_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), VOCABULARY)


def op11_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards, by its key alone."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its middle moved to the end, and rebuilt."""
    return fim.audit(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every source from the others of its language, and the terms behind it."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_bpe_roundtrip": op2_bpe_roundtrip,
    "op3_exact_topk": op3_exact_topk,
    "op4_simhash": op4_simhash,
    "simhash_search": simhash_search,
    "op5_language_id": op5_language_id,
    "page_languages": page_languages,
    "op6_url_filter": op6_url_filter,
    "op7_warc_roundtrip": op7_warc_roundtrip,
    "op8_lm_scores": op8_lm_scores,
    "op9_line_dedup": op9_line_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_jump_shards": op11_jump_shards,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_source_divergence": op13_source_divergence,
}

FIM_SQL = """
with hashed as (
    select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), drawn as (
    select *, ('0x' || substr(h, 1, 8))::bigint % (n + 1) as c1, ('0x' || substr(h, 9, 8))::bigint % (n + 1) as c2,
        ('0x' || substr(h, 17, 8))::bigint % 100 as r3, ('0x' || substr(h, 25, 8))::bigint % 100 as r4
    from hashed
), formed as (
    select *, least(c1, c2) as a, greatest(c1, c2) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r3 >= 90 then 'plain' when r4 < 20 then 'spm' else 'psm' end as form
    from drawn
), parts as (
    select *, substring(t, 1, a) as p, substring(t, a + 1, b - a) as m, substring(t, b + 1, n - b) as s from formed
), outputs as (
    select *, case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end as output from parts
), marked as (
    select *, instr(output, '<P>') as at_p, instr(output, '<S>') as at_s, instr(output, '<M>') as at_m from outputs
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
    sha256(output) as output_sha256,
    sha256(case form when 'plain' then output
        when 'psm' then substring(output, 4, at_s - 4) || substring(output, at_m + 3) || substring(output, at_s + 3, at_m - at_s - 3)
        else substring(output, at_p + 3, at_m - at_p - 3) || substring(output, at_m + 3) || substring(output, 4, at_p - 4) end) as restored_sha256
from marked
"""

DIVERGENCE_SQL = r"""
with docs as (
    select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
    from documents
), tokens as (
    select d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs
), kept as (
    select lang, term from tokens group by all having count(distinct d) >= 3
), sizes as (
    select lang, count(*) as v from kept group by lang
), sources as (
    select distinct lang, source from docs
), counts as (
    select lang, source, term, count(*) as c from tokens semi join kept using (lang, term) group by all
), totals as (
    select lang, source, sum(c) as n from counts group by all
), full_counts as (
    select lang, source, term, coalesce(c, 0) as c, coalesce(n, 0) as n, v
    from sources join kept using (lang) join sizes using (lang) left join counts using (lang, source, term) left join totals using (lang, source)
), shares as (
    select lang, source, term, c, (1 + 1000000000::hugeint * (c + 1) // (n + v))::bigint as p from full_counts
), pair_sums as (
    select x.lang, x.source, y.source as item, sum((x.p - y.p) * (x.p - y.p) // y.p)::bigint as value
    from shares x join shares y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all
), pairs as (
    select x.lang, x.source, y.source as item, coalesce(value, 0) as value
    from sources x join sources y on x.lang = y.lang and x.source <> y.source
    left join pair_sums z on z.lang = x.lang and z.source = x.source and z.item = y.source
), lang_counts as (
    select lang, term, sum(c) as c from counts group by all
), lang_shares as (
    select lang, term, (1 + 1000000000::hugeint * (c + 1) // (sum(c) over (partition by lang) + v))::bigint as q from lang_counts join sizes using (lang)
), terms as (
    select lang, source, term as item, ((p - q) * (p - q) // q)::bigint as value from shares join lang_shares using (lang, term) where c > 0 and p > q
), together as (
    select lang, source, 'pair' as part, item, value from pairs union all select lang, source, 'term', item, value from terms
)
select lang, source, part, item, value, row_number() over (partition by lang, source, part order by value desc, encode(item))::int as rank
from together qualify part = 'pair' or rank <= 200
"""

ORACLES: dict[str, str] = {"op12_fill_in_middle": FIM_SQL, "op13_source_divergence": DIVERGENCE_SQL}
