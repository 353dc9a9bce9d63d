"""Repeated rows, rare labels and stray declarations, against brute force."""

import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortflow.llm import langid, linedup, simhash, urlfilter
from cohortflow.llm.common import stage
from test_llm import DOCS, LANGUAGE, language_rows, prose


def brute_fingerprint(text):
    words = re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    words = re.split(r"[ \t-\r]+", words)
    out = ""
    for seed in range(2):
        start = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
        votes = [0] * 64
        for word in words:
            weight = min(max(len(word) - 3, 0), 8) * 64 + 1
            value = xxhash.xxh64_intdigest(word.encode(), start)
            for bit in range(64):
                votes[bit] += weight if value >> bit & 1 else -weight
        out += f"{sum(1 << bit for bit in range(64) if votes[bit] > 0):016x}"
    return out


def brute_mark(text):
    return hashlib.md5(text.encode()).hexdigest()


def brute_edits(rows):
    rows = sorted((key, brute_mark(text or ""), text or "") for key, text in rows if key is not None)
    out = []
    for i, (key, _, text) in enumerate(rows):
        near = rows[i - 1][2]
        half = len(text) // 2
        edited = text[: len(text) - half] + near[:half]
        marks = [brute_fingerprint(t) for t in (text, edited, near)]
        alike = [1 - (int(marks[0], 16) ^ int(m, 16)).bit_count() / 128 for m in marks[1:]]
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), *marks[:2], *alike))
    return Counter(out)


def test_fingerprints_of_repeated_rows_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "COPIES_AT_ONCE", 7)
    rows = [(i, prose(i, 5 + i)) for i in range(12)] + [(1, "one"), (1, "One two"), (1, "one"), (3, None), (3, ""), (None, "no id"), (4, "Ünï 漢字 😀 Word\x0bword")]
    rows += [(2, prose(2, 7))] * 20
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], DOCS).withColumns({"mark": F.lit(1), "copies": F.lit("x"), "half": F.lit(None)})
    got = Counter(tuple(r) for r in simhash.edit_likeness(df.repartition(5)).collect())
    assert got == brute_edits(rows)
    one = spark.createDataFrame([(9, "alone in here", None, None, None)] * 3, DOCS)
    assert Counter(tuple(r) for r in simhash.edit_likeness(one).collect()) == brute_edits([(9, "alone in here")] * 3)


def page_rows(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")


def test_a_rare_label_and_a_hot_url_train_the_trees(spark):
    rng = random.Random(3)
    bad = lambda: "/de/" + "/".join(str(rng.randrange(10**8)) for _ in range(6)) + "?a=1&b=2&c=3"
    urls = [f"http://h{i % 50}.com/fr/{'abcdefgh'[i % 8]}{i}" for i in range(3000)] + ["http://hot.com/fr/start"] * 3000
    urls += [f"http://h{i}.com{bad()}" for i in range(2)] + [f"http://n{i}.net{bad()}" for i in range(5)] + ["http://n.net/fr/start"] * 2
    rows = {r.page_id: r for r in urlfilter.judge(page_rows(spark, urls)).collect()}
    assert len(rows) == len(urls) and all(r.score is not None for r in rows.values())
    assert [rows[6002 + i].verdict for i in range(7)] == ["block"] * 5 + ["allow"] * 2


def test_a_label_takes_no_part_in_its_own_suffix_statistics(spark):
    urls = ["http://a.one.com/de/x", "http://a.one.com/de/x", "http://b.one.com/fr/x", "http://c.two.com/de/y", "http://c.two.net/z", None]
    rows = urlfilter.with_parts(page_rows(spark, urls)).withColumn("given", F.when(F.col("path").startswith("/de/"), "block").when(F.col("path").startswith("/fr/"), "allow"))
    got = {r.page_id: r for r in urlfilter.with_suffix_statistics(rows, urlfilter.addresses(rows)).collect()}
    base, prior = 2 / 3, urlfilter.PRIOR
    one = lambda blocked, known: pytest.approx((blocked + prior * base) / (known + prior))
    assert [got[i].suffix_blocked for i in range(6)] == [one(0, 1), one(0, 1), one(1, 1), one(0, 0), one(0, 0), one(0, 0)]
    sample = urlfilter.drawn(urlfilter.addresses(rows).where("given is not null"), 10).collect()
    assert Counter((r.label, r.weight) for r in sample) == {(1.0, 1.0): 2, (0.0, 1.0): 1}


def softmax(scores):
    raised = np.exp(scores - scores.max(-1, keepdims=True))
    return raised / raised.sum(-1, keepdims=True)


def brute_languages(rows, model):
    """Posteriors of (text, declared, host) by the formulas, row by row."""
    names, width = model.languages, len(model.languages)
    texts = model.scores([r[0] for r in rows])
    start = np.log([(1 - langid.BACKGROUND) / (width - 1)] * (width - 1) + [langid.BACKGROUND])
    own = softmax(texts + start)
    corpus = (own.sum(0) + 1) / (own.sum(0) + 1).sum()
    out = []
    for i, (text, declared, host) in enumerate(rows):
        prior = corpus
        for same in (lambda h: h.rsplit(".", 1)[-1] if h and "." in h else None, lambda h: h):
            key = same(host.lower() if host else None)
            if key is not None:
                mass = sum(own[k] for k, r in enumerate(rows) if same(r[2].lower() if r[2] else None) == key) - own[i]
                prior = (np.maximum(mass, 0) + langid.STRENGTH * prior) / (np.maximum(mass, 0) + langid.STRENGTH * prior).sum()
        named = declared.strip(" ").lower() if declared is not None else None
        stray = named not in (None, "", *names)
        suffix = host.lower().rsplit(".", 1)[-1] if host and "." in host else None
        evidence = np.zeros(width)
        for name, sure in ((named, langid.DECLARED), (suffix, langid.SUFFIX)):
            if name in names[:-1]:
                evidence += [np.log(sure if name == n else (1 - sure) / (width - 2)) for n in names[:-1]] + [np.log(1 / (width - 1))]
        if stray:
            evidence += np.log([(1 - langid.DECLARED) / (width - 1)] * (width - 1) + [langid.DECLARED])
        final = softmax(texts[i] + np.log(prior) + evidence)
        top, best = final.max(), names[int(final.argmax())]
        others = sum(own[k][-1] for k, r in enumerate(rows) if k != i and r[0] and r[0].strip() and r[1] and r[1].strip(" ").lower() == named)
        support = others / (others + langid.STRENGTH)
        if not text or text.isspace():
            out.append(("und", top, False))
        elif stray and best == "und" and top * support >= langid.ACCEPT:
            out.append((named, top * support, True))
        else:
            out.append((best, top, best != "und" and top >= langid.ACCEPT))
    return out


def test_languages_by_brute_force(spark):
    model = langid.train(spark.createDataFrame(language_rows(1, 60), DOCS))
    rng = random.Random(2)
    rows = [(rng.choice([prose(i, 6), LANGUAGE[rng.choice(["en", "fr", "de"])]]), rng.choice(["en", "FR ", None, "", "xx", "und"]), rng.choice(["a.fr", "b.FR", "c.com", "local", None])) for i in range(60)]
    rows += [(None, "en", "a.fr"), (" \t", "xx", None)] + [("\u10d0\u10d1 \u10d2\u10d3" * 12, "ka", None)] * 150 + [rows[0]] * 3
    table = spark.createDataFrame([(i, t, d, h, 0) for i, (t, d, h) in enumerate(rows)], DOCS)
    got = {r.doc_id: r for r in langid.identify(langid.document_evidence(table), model, ["doc_id"]).collect()}
    for i, (language, confidence, accepted) in enumerate(brute_languages(rows, model)):
        assert (got[i].language, got[i].accepted) == (language, accepted) and abs(got[i].confidence - confidence) < 1e-9, i
    assert got[70].language == "ka"


def test_more_labels_than_cells_are_learned_with_fewer_cells(spark, monkeypatch):
    monkeypatch.setattr(langid, "ENTRIES", 1 << 17)
    names = [f"x{i:02d}" for i in range(70)]
    rows = [(i, f"{chr(0x4e00 + 50 * i)}{chr(0x4e01 + 50 * i)} " * 20, name, "s", 0) for i, name in enumerate(names)]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.train(docs)
    assert model.languages == [*names, "und"] and model.table.shape == (1024, 71)
    got = {r.doc_id: r.language for r in langid.identify(langid.document_evidence(docs), model, ["doc_id"]).collect()}
    assert sum(got[i] == name for i, name in enumerate(names)) >= 68
    monkeypatch.setattr(langid, "ENTRIES", 1 << 16)
    with pytest.raises(ValueError):
        langid.train(docs)


def test_rows_of_one_doc_id_are_judged_each(spark):
    rows = [(i, t, name, s, n) for i, t, name, s, n in language_rows(3, 120)]
    rows += [(5, "  ", "en", "s", 0), (5, None, "en", "s", 0), (None, " ", "en", "s", 0), (200, "", "en", "s", 0)]
    kept = Counter((r.doc_id, r.text) for r in langid.keep_accepted(spark.createDataFrame(rows, DOCS)).collect())
    assert kept == Counter((r[0], r[1]) for r in rows[:120]) + Counter({(None, " "): 1})


def test_templates_of_a_large_node_are_merged_in_rounds(spark):
    """12,000 different lines of one node, every eighth a variant of a template that five texts hold."""
    rng = np.random.default_rng(4)
    lead = [7, 8, 9]
    own = rng.integers(1, 60_000, (10_500, 9))
    planted = rng.integers(1, 60_000, (300, 9))
    variants = np.repeat(planted, 5, axis=0)
    variants[np.arange(1500), np.repeat(rng.integers(0, 9, 300), 5)] = rng.integers(1, 60_000, 1500)
    lines = np.concatenate([own, variants])
    codes = [np.array([*lead, *row], np.uint16).tobytes() for row in lines]
    df = stage(spark.createDataFrame([(1, bytearray(c), 1) for c in codes], "node bigint, tokens binary, weight bigint"), "different")
    heads = df.withColumns({"template": F.monotonically_increasing_id(), "least": F.lit(12).cast("bigint")})
    for turn in range(linedup.ROUNDS):
        leaves = linedup.divided(linedup.round_groups(heads, turn), 512, "group").groupBy("leaf").count().agg(F.max("count")).first()[0]
        assert leaves <= 700
    for node_lines in (512, 1 << 20):  # in rounds, and all in one task
        found = linedup.templates(linedup.divided(df, node_lines), node_lines=node_lines).collect()
        names = {bytes(r.tokens): r.template for r in found}
        assert len(found) == len(set(codes)) == len(names)
        groups = [frozenset(names[c] for c in codes[10_500 + 5 * k : 10_505 + 5 * k]) for k in range(300)]
        assert all(len(g) == 1 for g in groups) and len(set(groups)) == 300
        sizes = Counter(names.values())
        assert all(sizes[names[c]] == 1 for c in codes[:10_500])


def test_templates_that_no_round_brings_together_are_merged(spark):
    """Chains of templates that differ at the place of every round, among others that are similar to none."""
    rng = np.random.default_rng(7)
    places = [linedup.DEPTH + (23 - linedup.DEPTH) * turn // linedup.ROUNDS for turn in range(linedup.ROUNDS)]
    own = rng.integers(1, 60_000, (120, 23))
    planted = np.repeat(own[:12], 3, axis=0)
    planted[:, places] = rng.integers(1, 60_000, (36, len(places)))
    codes = np.concatenate([own[12:], planted])
    codes[:, : linedup.DEPTH] = [7, 8, 9]
    rows = [(1, bytearray(c.astype(np.uint16).tobytes()), i, 1 + i % 3, 23) for i, c in enumerate(codes)]
    heads = stage(spark.createDataFrame(rows, "node bigint, tokens binary, template bigint, weight bigint, least bigint"), "heads")
    names = {r.template: r.merged for r in linedup.merged_names(heads, node_lines=16).collect()}
    assert len(names) == len(rows) and len(set(names.values())) == 108 + 12
    assert all(len({names[108 + 3 * k + i] for i in range(3)}) == 1 for k in range(12))


def test_short_lines_need_more_than_their_leading_tokens(spark):
    texts = [f"{prose(i, 20)}\nwe went to {word}\nitem number {i} of the list" for i, word in enumerate("london paris rome madrid vienna oslo".split())]
    rows = linedup.drop_recurring_lines(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)).collect()
    assert {r.doc_id: r.n_dropped for r in rows} == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1}
    assert all("we went to" in r.text for r in rows)
