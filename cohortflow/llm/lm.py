"""N-gram language-model scores by deleted interpolation.

Each word's probability mixes maximum-likelihood estimates: bigram, unigram and a uniform one. The
mixture depends on how often the context was seen (a bucket per power of two) and its weights are
learned by expectation-maximisation on held-out counts: every training token is held out of its own
counts in turn (its bigram, context and word lose one), so all training data serve both sides.

Texts are packed into chunks of about ``CHUNK_TOKENS`` tokens, numbered word by word within the chunk. A chunk
asks once for each different word and bigram; its own training counts travel with the question. A task
that owns a range of hashes adds up the counts and answers each chunk, so one shuffle there and one
back replace a join of every token, and a word of any frequency is one entry per chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cohortflow.llm.common import mixed, slices, stage, texts_of, words_of

FOLDS = 7
HELD_OUT_FOLD = 2
CHUNK_TOKENS = 1 << 19
PART_KEYS = 1 << 20
BUCKETS = 16
EM_ROUNDS = 50
EXACT = 8
STEPS = 8
FLOOR = 1e-6
END, START = np.uint64(1), np.uint64(2)
LEVEL = 1

CHUNK = "chunk bigint, n_tokens bigint, doc_ids binary, ends binary, held binary, words binary, tokens binary"
ASK = "part int, chunk bigint, kind int, keys binary, counts binary"
REPLY = "chunk bigint, part int, kind int, counts binary"


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, byte planes apart."""
    return zlib.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes(), LEVEL)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    """The numbers of ``packed``."""
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def is_held(doc_id: int) -> bool:
    """Whether a document is kept from training."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT_FOLD


def chunks(documents: DataFrame) -> DataFrame:
    """Documents packed into chunks: whole texts as numbers of words, each text closed by the end token.

    A chunk is named by its task and its place there, so no two have one name, also if they hold the same rows; a
    task that is run again replaces its chunks when they are written.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = count(TaskContext.get().partitionId() << 32)
        doc_ids: list[int] = []
        rows: list[np.ndarray] = []
        number: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            words = np.empty(len(number) + 1, np.uint64)
            words[0] = END
            words[1:] = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
            ids = np.array(doc_ids, np.int64)
            tokens = np.concatenate(rows)
            values = {
                "chunk": next(names),
                "n_tokens": len(tokens),
                "doc_ids": packed(ids),
                "ends": packed(np.cumsum([len(row) for row in rows]).astype(np.uint32)),
                "held": bytes(map(is_held, doc_ids)),
                "words": words.tobytes(),
                "tokens": packed(tokens),
            }
            doc_ids.clear(), rows.clear(), number.clear()
            return pa.RecordBatch.from_pylist([values])

        size = 0
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    row = [number.setdefault(word, len(number) + 1) for word in words_of(text)]
                    row.append(0)
                    doc_ids.append(doc_id)
                    rows.append(np.array(row, np.uint32))
                    size += len(row)
                    if size >= CHUNK_TOKENS:
                        yield out()
                        size = 0
        if rows:
            yield out()

    return texts_of(documents).where("doc_id is not null").mapInArrow(made, CHUNK)


class Chunk:
    """A chunk's tokens, training mask, and different words and bigrams."""

    def __init__(self, row: dict):
        self.doc_ids = unpacked(row["doc_ids"], np.int64)
        self.ends = unpacked(row["ends"], np.uint32).astype(np.int64)
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.tokens = unpacked(row["tokens"], np.uint32)
        starts = np.r_[0, self.ends[:-1]]
        self.doc_of = np.repeat(np.arange(len(self.ends)), self.ends - starts)
        self.trained = ~self.held[self.doc_of]
        before = np.r_[0, self.tokens[:-1]].astype(np.int64)
        before[starts] = -1
        self.before = before

    def bigrams(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the different bigrams in order, and each token's place among them."""
        left = np.where(self.before < 0, START, self.words[self.before])
        return np.unique(mixed(mixed(left) + self.words[self.tokens]), return_inverse=True)


def counted(chunk: Chunk) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(kind, sorted keys, training counts) of a chunk's words (0) and bigrams (1)."""
    order = np.argsort(chunk.words)
    n = np.bincount(chunk.tokens[chunk.trained], minlength=len(chunk.words))
    yield 0, chunk.words[order], n[order]
    keys, place = chunk.bigrams()
    yield 1, keys, np.bincount(place[chunk.trained], minlength=len(keys))


def ask(packs: DataFrame, parts: int) -> DataFrame:
    """Each chunk's different keys by the part that owns their hash range, with the chunk's training counts."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for kind, keys, counts in counted(Chunk(row)):
                    owner = part_of(keys, parts)
                    edges = np.searchsorted(owner, np.arange(parts + 1))
                    rows = [
                        {
                            "part": p,
                            "chunk": row["chunk"],
                            "kind": kind,
                            "keys": packed(np.diff(keys[a:b], prepend=np.uint64(0))),
                            "counts": packed(counts[a:b].astype(np.uint32)),
                        }
                        for p, (a, b) in enumerate(zip(edges, edges[1:]))
                        if b > a
                    ]
                    yield pa.RecordBatch.from_pylist(rows, ask_schema())

    return packs.mapInArrow(asked, ASK)


def ask_schema() -> pa.Schema:
    """Arrow types of a question."""
    return pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Owner of each key: equal ranges of the high 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def answer(questions: DataFrame, parts: int) -> tuple[DataFrame, DataFrame]:
    """Answers to the chunks (chunk, part, kind, counts), written; and totals (tokens, types) of the words."""

    def added(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        asked = [(np.cumsum(unpacked(k, np.uint64)), unpacked(c, np.uint32)) for k, c in zip(rows["keys"], rows["counts"])]
        flat, counts = np.concatenate([k for k, _ in asked]), np.concatenate([c for _, c in asked])
        keys, place = np.unique(flat, return_inverse=True)
        totals = np.bincount(place, counts, len(keys)).astype(np.int64)
        edges = np.cumsum([0, *(len(k) for k, _ in asked)])
        replies = [packed(totals[place[a:b]].astype(np.uint32)) for a, b in zip(edges, edges[1:])]
        first = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        if key[1] == 0:
            first[0][0], first[1][0] = totals.sum(), (totals > 0).sum()
        return pd.DataFrame({"chunk": rows["chunk"], "part": key[0], "kind": key[1], "counts": replies, "n_tokens": first[0], "n_types": first[1]})

    replies = questions.groupBy("part", "kind").applyInPandas(added, REPLY + ", n_tokens bigint, n_types bigint")
    replies = stage(replies, "replies")
    return replies.drop("n_tokens", "n_types"), replies.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"), F.coalesce(F.sum("n_types"), F.lit(0)).alias("n_types"))


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Bucket of a context count: 0 for none, then one per power of two."""
    return np.minimum(np.where(context > 0, np.log2(np.maximum(context, 1)).astype(np.int64) + 1, 0), BUCKETS - 1)


def rounded(counts: np.ndarray) -> np.ndarray:
    """Counts, the larger ones as steps of their logarithm, so that few different values stay."""
    large = np.maximum(counts, EXACT)
    steps = np.rint(np.log2(large / EXACT) * STEPS).astype(np.int64)
    return np.where(counts < EXACT, counts, EXACT + steps).astype(np.int64)


def value_of(code: np.ndarray) -> np.ndarray:
    """The count that ``rounded`` stands for."""
    return np.where(code < EXACT, code, EXACT * 2.0 ** ((code - EXACT) / STEPS))


def token_counts(chunk: Chunk, replies: dict[tuple[int, int], np.ndarray], parts: int, n_starts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token the training counts of its bigram, its context and its word."""
    joined = lambda kind: np.concatenate([replies[p, kind] for p in range(parts) if (p, kind) in replies])
    word = np.empty(len(chunk.words), np.int64)
    word[np.argsort(chunk.words)] = joined(0)
    _, place = chunk.bigrams()
    pair = joined(1).astype(np.int64)[place]
    context = np.where(chunk.before < 0, n_starts, word[chunk.before])
    return pair, context, word[chunk.tokens]


def with_replies(packs: DataFrame, replies: DataFrame, parts: int, n_starts: int, use, schema: str) -> DataFrame:
    """``use(chunk, pair, context, word)`` for each chunk, which meets its answers in one task."""
    fields = "counts binary, doc_ids binary, ends binary, held binary, words binary, tokens binary".split(", ")
    names = [f.split(" ")[0] for f in fields]
    own = packs.select("chunk", F.lit(-1).alias("part"), F.lit(-1).alias("kind"), F.lit(None).cast("binary").alias("counts"), *names[1:])
    theirs = replies.select("chunk", "part", "kind", "counts", *(F.lit(None).cast("binary").alias(n) for n in names[1:]))

    def used(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        row = rows[rows["kind"] < 0].iloc[0]
        got = {(r.part, r.kind): unpacked(r.counts, np.uint32) for r in rows[rows["kind"] >= 0].itertuples()}
        chunk = Chunk(row)
        return use(chunk, *token_counts(chunk, got, parts, n_starts))

    return own.unionByName(theirs).groupBy("chunk").applyInPandas(used, schema)


def held_out_counts(chunk: Chunk, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> pd.DataFrame:
    """Training tokens by rounded counts of bigram, context and word, each without the token itself."""
    use = chunk.trained
    codes = [rounded(np.maximum(x[use] - 1, 0)) for x in (pair, context, word)]
    key = (codes[0] << 40) | (codes[1] << 20) | codes[2]
    values, n = np.unique(key, return_counts=True)
    return pd.DataFrame({"pair": values >> 40, "context": (values >> 20) & 0xFFFFF, "word": values & 0xFFFFF, "n": n})


def learn_weights(table: pd.DataFrame, tokens: int, types: int, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Weights (bucket x bigram, unigram, uniform) by expectation-maximisation on held-out counts.

    The table has a row per different rounded triple of counts, a number that grows with their logarithms only.
    """
    pair, context, word = (value_of(table[c].to_numpy()) for c in ("pair", "context", "word"))
    n = table["n"].to_numpy().astype(float)
    estimates = np.stack([np.where(context > 0, pair / np.maximum(context, 1), 0), word / max(1, tokens - 1), np.full(len(n), 1 / (types + 1))], 1)
    bucket = bucket_of(context)
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = (0, 0.5, 0.5)
    for _ in range(rounds):
        shares = weights[bucket] * estimates
        shares *= (n / np.maximum(shares.sum(1), 1e-300))[:, None]
        mass = np.stack([np.bincount(bucket, shares[:, k], BUCKETS) for k in range(3)], 1)
        total = mass.sum(1, keepdims=True)
        weights = np.where(total > 0, mass / np.maximum(total, 1e-300), weights)
    weights = np.maximum(weights, FLOOR)
    weights[0, 0] = 0
    return weights / weights.sum(1, keepdims=True)


def score_documents(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text.

    ``base_score`` is the add-one unigram score, ``score`` the interpolated model's; both are sums of log10.
    Training uses documents whose crc32(doc_id as text) mod 7 is not 2. Null and empty texts are one end token. Rows
    without doc_id are left out; rows that repeat one are scored each. An empty table gives an empty result.
    """
    packs = stage(chunks(documents), "chunks")
    size = packs.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first().n
    parts = max(1, -(-size // PART_KEYS))
    replies, totals = answer(ask(packs, parts), parts)
    tokens, types = totals.first()

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [row.count(0) for row in batch.column("held").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], ["n"])

    n_starts = packs.select("held").mapInArrow(starts, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    triples = with_replies(packs, replies, parts, n_starts, held_out_counts, "pair bigint, context bigint, word bigint, n bigint")
    table = triples.groupBy("pair", "context", "word").agg(F.sum("n").alias("n")).toPandas()
    weights = learn_weights(table, tokens, types)

    def scored(chunk: Chunk, pair: np.ndarray, context: np.ndarray, word: np.ndarray) -> pd.DataFrame:
        mix = weights[bucket_of(context)]
        p = mix[:, 0] * np.where(context > 0, pair / np.maximum(context, 1), 0) + mix[:, 1] * word / max(1, tokens) + mix[:, 2] / (types + 1)
        by_doc = lambda x: np.bincount(chunk.doc_of, x, len(chunk.ends))
        base = np.log10(word + 1.0) - np.log10(float(tokens + types + 1))
        return pd.DataFrame(
            {
                "doc_id": chunk.doc_ids,
                "held_out": chunk.held,
                "n_tokens": np.diff(chunk.ends, prepend=0),
                "n_known": by_doc(word > 0).astype(np.int64),
                "train_tokens": tokens,
                "base_score": by_doc(base),
                "score": by_doc(np.log10(p)),
            }
        )

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return with_replies(packs, replies, parts, n_starts, scored, schema)
