"""Sharding, fill-in-the-middle and source divergence against brute force, SQL and odd rows."""

import hashlib
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import divergence, fim, sharding
from cohortflow.llm.common import stage
from cohortflow.llm.queries import ORACLES, QUERIES
from test_llm import DOCS, prose

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def one_jump(key, shards):
    """The published loop, one key at a time."""
    key, last, target = key % 2**64, -1, 0
    while target < shards:
        last = target
        key = (key * 2862933555777941757 + 1) % 2**64
        target = int((last + 1) * (2**31 / ((key >> 33) + 1)))
    return last


@pytest.fixture(scope="module")
def odd_documents(spark):
    texts = [prose(1, 300), prose(1, 300), None, "", "x", "Ünï 漢字 😀", "a <P> b", "<S>", "y" * 100_000, " <", "tail <S", prose(2, 50)]
    rows = [(i, t, "en", f"src{i % 3}", 0) for i, t in enumerate(texts)]
    rows += [rows[0]] * 40 + [(None, "no id", None, None, None)] * 3 + [(5, "another text of id 5", "de", "src1", 1)]
    return rows, stage(spark.createDataFrame(rows, DOCS).withColumns({"shard": F.lit("x"), "row": F.lit(1), "n": F.lit(2.5), "task": F.lit(0)}), "odd")


def test_jump_is_the_published_loop():
    keys = np.r_[np.arange(-50, 50), np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 500)]
    for shards in (1, 2, 8, 9, 1000):
        assert sharding.jump(keys, shards).tolist() == [one_jump(int(k), shards) for k in keys]
    assert not len(sharding.jump(keys[:0], 8))
    with pytest.raises(ValueError):
        sharding.jump(keys, 0)


def test_shards_are_even_and_grow_into_the_new_one_alone(spark):
    rows = sharding.assign(spark.range(40_000), "id", 8).toPandas()
    assert (abs(rows["shard"].value_counts() - 5000) < 350).all()
    moved = rows[rows["shard"] != rows["grown_shard"]]
    assert set(moved["grown_shard"]) == {8} and abs(len(moved) - 40_000 / 9) < 350
    again = sharding.moves(spark.range(40_000), "id", 8).toPandas()
    assert set(again["id"]) == set(moved["id"])
    assert sharding.moves(spark.range(1000), "id", 8, 8).where("grown_shard < 8").count() == 0


def test_document_shards_by_brute_force(spark, odd_documents):
    rows, docs = odd_documents
    found = sharding.shard_documents(docs).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    slots, shards = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        shards[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def test_slots_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TASK_BLOCK", 3)
    for keys in (100, 0):
        monkeypatch.setattr(sharding, "BROADCAST_KEYS", keys)
        placed = sharding.assign(spark.range(0, 5000, 1, 13).withColumn("slot", F.lit("mine")), "id", 5).toPandas()
        for _, group in placed.groupby("shard"):
            assert sorted(group["slot"]) == list(range(len(group)))
        assert sorted(placed["id"]) == list(range(5000))


def test_written_shards_hold_whole_rows(spark, odd_documents, tmp_path):
    _, docs = odd_documents
    assigned = sharding.assign(docs.drop("shard"), "doc_id", 4)
    written = sharding.write_shards(assigned, f"{tmp_path}/shards", file_rows=10)
    assert sorted(map(repr, written.select(assigned.columns).collect())) == sorted(map(repr, assigned.collect()))
    assert all(n <= 10 for n in (r["count"] for r in written.groupBy(F.input_file_name()).count().collect()))


def brute_fim(doc_id, text, settings=fim.Settings()):
    text = text or ""
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    return form, a, b - a, f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@pytest.mark.parametrize("units", [7, 16_384])
def test_fill_in_middle_by_brute_force(spark, odd_documents, units):
    rows, docs = odd_documents
    want, outputs = Counter(), Counter()
    for doc_id, text, *_ in rows:
        form, prefix, middle, output = brute_fim(doc_id, text)
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[doc_id, len(text or ""), form, prefix, middle, sha(output), sha(text or "")] += 1
        outputs[doc_id, output] += 1
    assert Counter(map(tuple, fim.audit(docs, units=units).collect())) == want
    made = fim.transformed(docs, units=units).collect()
    assert Counter((r.doc_id, r.output) for r in made) == outputs
    texts = Counter((r.doc_id, fim.restored_text(r.output, r.form)) for r in made)
    assert texts == Counter((r[0], r[1] or "") for r in rows)
    assert fim.audit(docs.limit(0)).count() == 0


def test_all_forms_and_cuts_restore(spark):
    rows = [(i, prose(i, i % 40), "en", "s", 0) for i in range(400)]
    docs = stage(spark.createDataFrame(rows, DOCS), "forms")
    found = fim.audit(docs, units=16).collect()
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert {(r.doc_id, r.restored_sha256) for r in found} == {(r[0], hashlib.sha256(r[1].encode()).hexdigest()) for r in rows}


def test_marks_across_pieces():
    for form, output in (("psm", "<P>a<<S>b<M<M>c"), ("spm", "<S>b<M<P>a<<M>c")):
        for step in range(1, 6):
            reader, parts = fim.MarkReader(fim.Settings(), form), {0: "", 1: "", 2: ""}
            for at in range(0, len(output), step):
                for part, text in reader.read(output[at : at + step]):
                    parts[part] += text
            assert parts == {0: "a<", 1: "c", 2: "b<M"}


def test_a_hot_id_is_dealt_to_many_partitions(spark):
    rows = [(7, "the same text", "en", "s", 0)] * 4000
    docs = stage(spark.createDataFrame(rows, DOCS), "hot")
    pieces = fim.in_output_order(fim.output_pieces(docs))
    sizes = pieces.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert len(sizes) == 1 or max(sizes) < 0.6 * sum(sizes)
    assert fim.audit(docs).count() == 4000


def brute_divergence(rows, min_docs=3, top=200):
    """Dense, in Python integers."""
    import re

    find = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+").findall
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = [(lang or "", source or "", find((text or "").translate(lower))) for _, text, lang, source, _ in rows]
    held = Counter((lang, t) for lang, _, terms in docs for t in set(terms))
    kept = defaultdict(set)
    for (lang, t), n in held.items():
        if n >= min_docs:
            kept[lang].add(t)
    counts = defaultdict(Counter)
    for lang, source, terms in docs:
        for key in ((lang, source), (lang,)):
            counts[key].update(t for t in terms if t in kept[lang])
    out = []

    def shares(key):
        lang, total = key[0], sum(counts[key].values()) + len(kept[key[0]])
        return {t: 1 + 10**9 * (counts[key][t] + 1) // total for t in kept[lang]}

    of = {key: shares(key) for key in counts}
    f = lambda p, q: (p - q) ** 2 // q
    for key in [k for k in counts if len(k) == 2]:
        pairs = [(sum(f(of[key][t], of[other][t]) for t in kept[key[0]]), other[1]) for other in counts if len(other) == 2 and other[0] == key[0] and other != key]
        terms = [(f(of[key][t], of[key[:1]][t]), t) for t in kept[key[0]] if counts[key][t] and of[key][t] > of[key[:1]][t]]
        for part, values in (("pair", pairs), ("term", terms)):
            ordered = sorted(values, key=lambda v: (-v[0], v[1].encode()))
            out += [(*key, part, item, value, k + 1) for k, (value, item) in enumerate(ordered) if part == "pair" or k < top]
    return out


@pytest.fixture(scope="module")
def divergent_rows():
    rows = []
    for i in range(240):
        lang = ["en", "en", "de", None, "x\x00y"][i % 5]
        text = prose(i % 60, 20 + i % 50) + (f" Straße É漢字 only{'abcdefgh'[i % 8]} {'hot ' * (i % 90)}" if i % 3 else " TIES ties9TIES")
        rows.append((i, text, lang, None if i % 17 == 0 else f"src{i % 7}", 0))
    rows += [(900, None, "en", "silent", 0), (901, "", "fr", "a", 0), (902, "once", "fr", "b", 0), (903, "12 34", "it", "alone", 0)] + [rows[1]] * 30
    return rows


@pytest.mark.parametrize("model_terms", [1 << 20, 5])
def test_divergence_by_brute_force(spark, divergent_rows, model_terms):
    docs = spark.createDataFrame(divergent_rows, DOCS).withColumns({"term": F.lit(1), "item": F.lit("i"), "s": F.lit(None), "bag": F.lit(0)})
    found = divergence.source_divergence(docs, divergence.Settings(vocabulary_terms=model_terms, top_terms=9))
    assert sorted(map(tuple, found.collect())) == sorted(brute_divergence(divergent_rows, top=9))


def test_divergence_in_small_slices(spark, divergent_rows, monkeypatch):
    """Memos that fill, pair slices that cut a term's pairs, sums over sorted codes, joins without broadcasts."""
    for name, value in (("TEXT_SLICE", 300), ("PAIR_SLICE", 13), ("PAIR_TABLE", 10), ("BROADCAST_KEYS", 0)):
        monkeypatch.setattr(divergence, name, value)
    docs = spark.createDataFrame(divergent_rows, DOCS).repartition(5)
    rows = divergence.common_terms(spark.createDataFrame([("a", [(1, 5, 2), (2, 7, 3), (4, 9, 1)])], "lang string, entries array<struct<s:int,p:bigint,z:bigint>>"))
    assert {(r.a, r.b) for r in rows.collect()} == {(a, b) for a in (1, 2, 4) for b in (1, 2, 4) if a != b}
    for model_terms in (1 << 20, 0):
        found = divergence.source_divergence(docs, divergence.Settings(vocabulary_terms=model_terms))
        assert sorted(map(tuple, found.collect())) == sorted(brute_divergence(divergent_rows))


def test_divergence_of_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    assert divergence.source_divergence(docs).count() == 0
    silent = spark.createDataFrame([(1, None, None, None, None), (2, "9", "en", "a", 1), (3, "few words", "en", "b", 1)], DOCS)
    assert sorted(map(tuple, divergence.source_divergence(silent).collect())) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_terms_are_those_of_the_pattern():
    import re

    import pyarrow as pa

    texts = ["", "Ab-cd É漢 x", "x", "", "  ", "\x00a\x7fB", "Straße_[z]{Z}", "😀9k", "", "end"]
    want = [(i, t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) for i, text in enumerate(texts) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
    for start in range(len(texts)):
        terms, rows = divergence.cut_terms(pa.array(texts, pa.string()).slice(start))
        assert [(r + start, t) for r, t in zip(rows.tolist(), terms.to_pylist())] == [w for w in want if w[0] >= start]
    assert divergence.cut_terms(pa.array([], pa.string()))[0].to_pylist() == []


def test_sums_stay_exact_beyond_doubles():
    values = np.array([2**60 + 1, 2**60 + 3, -(2**61) - 7, 5], np.int64)
    for size in (3, divergence.PAIR_TABLE + 1):
        names, sums = divergence.exact_sums(np.array([1, 1, 1, 2]), values, size)
        assert dict(zip(names.tolist(), sums.tolist())) == {1: -3, 2: 5}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    with duckdb.connect() as con:
        con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
        want = con.execute(ORACLES[name])
        columns = [c[0] for c in want.description]
        assert Counter(map(tuple, QUERIES[name](spark, SF_DIR).select(columns).collect())) == Counter(want.fetchall())
