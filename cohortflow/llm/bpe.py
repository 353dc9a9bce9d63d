"""Byte-level BPE: a minimal acyclic transducer for frequent words, exact merges for the others.

Frequent words are counted over all documents, encoded once by exact merges and compiled into an
automaton whose words share prefixes and suffixes. Numbers on its arcs add up to a word's row in
a table of ids. The file is shipped with ``SparkContext.addFile`` and memory-mapped by each
Python worker, so workers of one machine share its pages. A word that it lacks is merged exactly;
the lexicon changes the speed and never the ids.

Null texts encode as empty ones and give no ids; texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import os
import re
import struct
import tempfile
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from cohortflow.llm.common import drop_stage, list_column, slices, stage, tidied

# The pattern of words that the public vocabulary was made with.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Above this code point Unicode versions of the libraries differ in some classes.
LAST_AGREED = "՗"
# A letter-only chunk is one word; with one of these at its end it is two.
MARKS = frozenset(".,;:!?")
LEXICON_WORDS = 65_536
#: Bytes of chunks and their ids that a worker remembers, once fresh and once of the time before.
MEMO_BYTES = 36 << 20
#: The same where all that a worker does is to encode.
LEXICON_MEMO_BYTES = 72 << 20
#: Bytes of text encoded together; their chunks are a part of what is remembered, or each slice would drop the one before.
ENCODE_SLICE = 2 << 20
ENTRY_BYTES = 190
COUNT_WORDS = 200_000
HEAP_LENGTH = 64
WIDTH = 1 << 24
NONE = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 byte values in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merge ranks and special tokens of a ``tokenizers`` file of the byte-level kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        self.path = path
        self.ids = {as_bytes(token): i for token, i in spec["model"]["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        #: Id that a merge makes, by rank; rank of a pair of ids, as left * WIDTH + right.
        self.made = [self.ids[as_bytes(a + b)] for a, b in pairs]
        self.ranks = {self.ids[as_bytes(a)] * WIDTH + self.ids[as_bytes(b)]: rank for rank, (a, b) in enumerate(pairs)}
        self.bytes = [self.ids[bytes([b])] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.pieces: list[bytes] = [b""] * size
        for token, i in self.ids.items():
            self.pieces[i] = token
        for content, i in self.special.items():
            self.pieces[i] = content.encode()
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    @cached_property
    def ranked(self) -> bool:
        """Whether merging any two neighbours that make up a token, smallest id first, is the same as the listed merges.

        It is if ids grow with ranks, no merge uses a part made after it, and every token's own bytes merge into it:
        then merges come in the order of their ranks, and the bytes of a token stand as its listed pair before they join.
        """
        if self.made != sorted(set(self.made)) or any(max(divmod(pair, WIDTH)) >= self.made[rank] for pair, rank in self.ranks.items()):
            return False
        return set(self.made) | set(self.bytes) == set(self.ids.values()) and all(self.merge(token) == [i] for token, i in self.ids.items())

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank is merged, leftmost first, until none is left."""
        return self._merged_short(word) if len(word) <= HEAP_LENGTH else self._merged_long(word)

    def _merged_short(self, word: bytes) -> list[int]:
        parts = list(map(self.bytes.__getitem__, word))
        rank = self.ranks.get
        found = [rank(a * WIDTH + b, NONE) for a, b in zip(parts, parts[1:])]
        while found and (best := min(found)) != NONE:
            at = found.index(best)
            parts[at : at + 2] = [self.made[best]]
            del found[at]
            if at:
                found[at - 1] = rank(parts[at - 1] * WIDTH + parts[at], NONE)
            if at < len(found):
                found[at] = rank(parts[at] * WIDTH + parts[at + 1], NONE)
        return parts

    def _merged_long(self, word: bytes) -> list[int]:
        """The same with a heap of pairs over a linked list: a word of n bytes takes n log n."""
        parts = list(map(self.bytes.__getitem__, word))
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap: list[tuple[int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (r := self.ranks.get(parts[i] * WIDTH + parts[j])) is not None:
                heapq.heappush(heap, (r, i, parts[i] * WIDTH + parts[j]))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            r, i, pair = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else -1
            if j < 0 or parts[i] * WIDTH + parts[j] != pair:
                continue
            parts[i], parts[j] = self.made[r], -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [part for part in parts if part >= 0]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per process."""
    return Vocabulary(path)


@lru_cache(maxsize=4)
def library_tokenizer(path: str):
    """The file as ``tokenizers`` reads it, without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordSplitter:
    """Cuts a text into the words that BPE merges apart from each other."""

    def __init__(self, path: str):
        self.find = regex.compile(WORDS).findall
        self.beyond = re.compile(f"[^\\x00-{LAST_AGREED}]").search
        self.path = path

    def __call__(self, text: str) -> list[str]:
        body = text[1:] if text[:1] == " " else text
        if body.isalpha():
            if not self.beyond(body):
                return [text]
        elif body[-1:] in MARKS and body[:-1].isalpha() and not self.beyond(body):
            return [text[:-1], body[-1]]
        if self.beyond(text):
            cut = library_tokenizer(self.path).pre_tokenizer.pre_tokenize_str(text)
            return [text[start:end] for _, (start, end) in cut]
        return self.find(text)


class Unsplittable(Exception):
    """White space next to a single space: only the whole text can be cut into words."""


class Memo(dict):
    """Values made when first asked for. When it holds ``limit`` bytes, what is not asked for until it has filled again goes."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.held, self.old = make, limit, 0, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put([key], [value])
        return value

    def put(self, keys: list[str], values: list[bytes]) -> None:
        """Hold these values too."""
        size = sum(map(len, keys)) + sum(map(len, values)) + ENTRY_BYTES * len(keys)
        if self.held and self.held + size > self.limit:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self.held += size
        self.update(zip(keys, values))


class Encoder:
    """Whole texts to ids (little-endian 32-bit), given how to encode a piece without special tokens.

    A word never reaches across a single space that stands between two other characters, so a
    text is cut there and each chunk is encoded once per worker.
    """

    def __init__(self, words: Vocabulary, piece: Callable[[str], bytes], memo: int = MEMO_BYTES):
        self.special, self.cut = words.special, words.cut
        self.piece = piece
        self.chunks = Memo(self.chunk, memo)
        self.heads = Memo(self.head, memo // 8 + 1)

    def chunk(self, text: str) -> bytes:
        if not text or text[0].isspace() or text[-1].isspace():
            raise Unsplittable
        return self.piece(" " + text)

    def head(self, text: str) -> bytes:
        if text and (text[0].isspace() or text[-1].isspace()):
            raise Unsplittable
        return self.piece(text)

    def prepare(self, texts: list[str], all: Callable[[list[str]], list[bytes]]) -> None:
        """Encode what is new in ``texts`` at once; what is still asked for later is encoded then."""
        asked = set().union(*(text.split(" ") for text in texts)).difference(self.chunks)
        again = [text for text in asked if text in self.chunks.old]
        new = [text for text in asked.difference(again) if text and not text[0].isspace() and not text[-1].isspace()]
        values = [*map(self.chunks.old.__getitem__, again), *all([" " + text for text in new])]
        self.chunks.put(again + new, values)

    def __call__(self, text: str) -> bytes:
        special = self.special
        if self.cut and any(content in text for content in special):
            parts = self.cut.split(text)
            return b"".join(struct.pack("<I", special[p]) if p in special else self.plain(p) for p in parts if p)
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        try:
            return self.heads[first] + b"".join(map(self.chunks.__getitem__, rest))
        except Unsplittable:
            return self.piece(text)


@lru_cache(maxsize=2)
def library_encoder(path: str) -> Encoder:
    """Ids by the installed libraries: for operators that need ids and are not about making them.

    The vocabulary's own tables are not kept, and ``tokenizers`` is loaded when a text first needs it.
    """
    import tiktoken

    words = Vocabulary(path)
    beyond = re.compile(f"[^\\x00-{LAST_AGREED}]").search
    by_library = lambda text: library_tokenizer(path).encode(text, add_special_tokens=False).ids
    if words.made != sorted(words.made):
        return Encoder(words, lambda text: array("I", by_library(text)).tobytes())
    fast = tiktoken.Encoding("byte-level", pat_str=WORDS, mergeable_ranks=words.ids, special_tokens={}).encode_ordinary
    return Encoder(words, lambda text: array("I", by_library(text) if beyond(text) else fast(text)).tobytes())


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """A minimal acyclic automaton of the words, with numbers on arcs that add up to a word's row of ids.

    Words are added in sorted order; a state is final in form once its last word is passed and
    is then replaced by an equal one where there is one, so suffixes are shared.
    """
    entries = sorted(entries)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple]] = []
    words_below: list[int] = []

    def close(final: bool, arcs: list[tuple[int, int]]) -> int:
        form = (final, tuple(arcs))
        if form not in register:
            register[form] = len(states)
            states.append(form)
            words_below.append(final + sum(words_below[target] for _, target in arcs))
        return register[form]

    path: list[list] = [[False, []]]
    last = b""
    for word, _ in entries:
        shared = len(os.path.commonprefix([last, word]))
        while len(path) - 1 > shared:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], close(final, arcs)))
        path.extend([False, []] for _ in range(len(word) - shared))
        path[-1][0] = True
        last = word
    while len(path) > 1:
        final, arcs = path.pop()
        path[-1][1].append((last[len(path) - 1], close(final, arcs)))
    root = close(*path[0])

    first, keys, targets, skipped = [0], [], [], []
    for state, (final, arcs) in enumerate(states):
        seen = int(final)
        for label, target in arcs:
            keys.append(state << 8 | label)
            targets.append(target)
            skipped.append(seen)
            seen += words_below[target]
        first.append(len(keys))
    ids = [i for _, row in entries for i in row]
    starts = np.cumsum([0, *(len(row) for _, row in entries)])
    header = struct.pack("<5I", root, len(states), len(keys), len(entries), len(ids))
    numbers = [np.array(x, "<u4").tobytes() for x in (first, keys, targets, skipped, starts, ids)]
    return header + b"".join(numbers) + bytes(final for final, _ in states)


class Lexicon:
    """A compiled lexicon, memory-mapped. Arcs are sorted by state and label, which make up their keys."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, states, arcs, self.words, ids = struct.unpack_from("<5I", self.map)
        at = 20

        def take(n: int, kind: str = "<u4") -> np.ndarray:
            nonlocal at
            found = np.frombuffer(self.map, kind, n, at)
            at += found.nbytes
            return found

        self.first, self.keys, self.targets, self.skipped = take(states + 1), take(arcs), take(arcs), take(arcs)
        self.starts, self.ids, self.final = take(self.words + 1), take(ids), take(states, "?")

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Row of each word, -1 if the lexicon lacks it: all words walk the automaton together, a byte a step."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.keys) or not words:
            return out
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        alive, state, row = np.arange(len(words)), np.full(len(words), self.root, np.uint32), np.zeros(len(words), np.int64)
        step = 0
        while len(alive):
            ends = lengths[alive] == step
            done = ends & self.final[state]
            out[alive[done]] = row[done]
            alive, state, row = alive[~ends], state[~ends], row[~ends]
            key = state << np.uint32(8) | flat[starts[alive] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[arc] == key
            alive, arc = alive[there], arc[there]
            state, row = self.targets[arc], row[there] + self.skipped[arc]
            step += 1
        return out

    def get_all(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of each word (little-endian 32-bit), None if the lexicon lacks it."""
        rows = self.rows(words)
        spans = zip(rows.tolist(), self.starts[rows].tolist(), self.starts[rows + 1].tolist())
        return [self.ids[start:end].tobytes() if row >= 0 else None for row, start, end in spans]

    def get(self, word: bytes) -> bytes | None:
        """Ids of one word."""
        return self.get_all([word])[0]


class WordCoder:
    """Ids of a text: each word from the lexicon if it is there, by exact merges if not.

    With a vocabulary that is ``ranked``, short unseen words are merged by tiktoken's core, which takes
    pairs by the id of what they make; long ones, and all of any other vocabulary, by ``Vocabulary.merge``.
    """

    def __init__(self, path: str, lexicon: Lexicon | None, ranked: bool = False):
        self.split, self.merge, self.lexicon = WordSplitter(path), vocabulary(path).merge, lexicon
        self.short = HEAP_LENGTH if ranked else 0
        if ranked:
            import tiktoken

            words = tiktoken.Encoding("words", pat_str="(?s:.+)", mergeable_ranks=vocabulary(path).ids, special_tokens={})
            self.merge_short = words.encode_ordinary

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word."""
        raw = [word.encode("utf-8") for word in words]
        found = self.lexicon.get_all(raw) if self.lexicon else [None] * len(raw)
        for i, ids in enumerate(found):
            if ids is None:
                merged = self.merge_short(words[i]) if len(raw[i]) <= self.short else self.merge(raw[i])
                found[i] = array("I", merged).tobytes()
        return found

    def all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; words that they share are looked up once."""
        cut = list(map(self.split, texts))
        words = list(set().union(*cut))
        ids = dict(zip(words, self.words(words)))
        return [ids[words[0]] if len(words) == 1 else b"".join(map(ids.__getitem__, words)) for words in cut]

    def __call__(self, text: str) -> bytes:
        return self.all([text])[0]


@lru_cache(maxsize=2)
def lexicon_encoder(path: str, lexicon: str | None, ranked: bool = False) -> Encoder:
    """One encoder per worker; ``lexicon`` is the name of a file shipped by ``ship_lexicon``."""
    return Encoder(vocabulary(path), WordCoder(path, Lexicon(SparkFiles.get(lexicon)) if lexicon else None, ranked), LEXICON_MEMO_BYTES)


def count_words(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``word``, ``n`` over all texts, added up per batch before anything is shuffled."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = WordSplitter(path)
        words: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())], ["word", "n"])
            words.clear()
            return made

        for batch in batches:
            for part in slices(batch, text):
                chunks: Counter[str] = Counter()
                for value in part.column(text).to_pylist():
                    first, *rest = (value or "").split(" ")
                    if "" in rest:
                        words.update(split(value))
                    else:
                        chunks.update(" " + chunk for chunk in rest)
                        chunks[first] += 1
                for chunk, n in chunks.items():
                    for word in split(chunk):
                        words[word] += n
                if len(words) >= COUNT_WORDS:
                    yield out()
        if words:
            yield out()

    schema = StructType([StructField("word", StringType()), StructField("n", LongType())])
    return df.select(text).mapInArrow(counted, schema).groupBy("word").agg(F.sum("n").alias("n"))


def ship_lexicon(df: DataFrame, path: str, text: str = "text", words: int = LEXICON_WORDS) -> str:
    """Count all words of ``df``, compile the most frequent, ``words`` at most, and ship the file; gives its name.

    Words are graded by the eighth of a doubling that their count falls into. The highest grades that hold no
    more than ``words`` together are taken, so the driver gets some hundred grades and ``words`` rows, whatever
    the size of the corpus and however many tasks count it. A word that occurs once is not frequent.
    """
    spark = df.sparkSession
    graded = count_words(df, path, text).where("n > 1").select("word", F.floor(8 * F.log2("n")).cast("int").alias("grade"))
    graded = stage(graded, "words")
    least, held = None, 0
    for grade, n in graded.groupBy("grade").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("grade")).collect():
        held += n
        if held > words:
            break
        least = grade
    top = [] if least is None else graded.where(F.col("grade") >= least).select("word").collect()
    drop_stage(graded)
    merge = vocabulary(path).merge
    compiled = compile_lexicon((w, merge(w)) for w in (row.word.encode("utf-8") for row in top))
    name = f"lexicon-{hashlib.sha256(compiled).hexdigest()[:24]}.bin"
    local = os.path.join(tempfile.gettempdir(), name)  # one path for one content, as addFile wants it
    with open(local, "wb") as f:
        f.write(compiled)
    spark.sparkContext.addFile(local)
    return name


def encoded_rows(encoder: Encoder, texts: list[str | None]) -> list[bytes]:
    """Ids of each text of a slice; what is new in them is looked up together."""
    values = [text or "" for text in texts]
    encoder.prepare(values, encoder.piece.all)
    return list(map(encoder, values))


class Pieces:
    """Bytes that stand for each id, joined for many ids at once."""

    def __init__(self, pieces: list[bytes]):
        self.lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(pieces), np.uint8)

    def joined(self, ids: np.ndarray, edges: np.ndarray) -> tuple[memoryview, list[int]]:
        """The bytes of all ``ids``, and where the rows that end at ``edges`` of them begin and end."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return memoryview(self.flat[at].tobytes()), np.r_[0, ends][edges].tolist()


@lru_cache(maxsize=2)
def token_pieces(path: str) -> Pieces:
    """The bytes of every token."""
    return Pieces(vocabulary(path).pieces)


@lru_cache(maxsize=2)
def decimal_pieces(path: str) -> Pieces:
    """Every id in decimal with a comma after it."""
    return Pieces([b"%d," % i for i in range(len(vocabulary(path).pieces))])


def encode(df: DataFrame, path: str, lexicon: str | None, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` as a list; a column of that name is replaced."""
    df = df.drop(ids)
    schema = StructType([*df.schema.fields, StructField(ids, ArrayType(IntegerType(), False))])
    ranked = vocabulary(path).ranked

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = lexicon_encoder(path, lexicon, ranked)
        for batch in batches:
            for part in slices(batch, text, ENCODE_SLICE):
                rows = encoded_rows(encoder, part.column(text).to_pylist())
                offsets = np.cumsum([0, *(len(row) // 4 for row in rows)])
                column = list_column(np.frombuffer(b"".join(rows), "<i4"), offsets)
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, ids])

    return df.mapInArrow(tidied(encoded), schema)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of its id lists; bytes that are no UTF-8 read as U+FFFD, null as empty."""
    df = df.drop(out)
    schema = StructType([*df.schema.fields, StructField(out, StringType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(ids)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            edges = np.cumsum([0, *pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)])
            data, at = token_pieces(path).joined(flat.astype(np.int64), edges)
            texts = [str(data[start:end], "utf-8", "replace") for start, end in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    return df.mapInArrow(tidied(decoded), schema)


ROUNDTRIP = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def roundtrip(df: DataFrame, path: str, lexicon: str | None) -> DataFrame:
    """Every text encoded and decoded in one pass, of which digests leave the task: of its ids in decimal and of the decoded text."""
    ranked = vocabulary(path).ranked

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = lexicon_encoder(path, lexicon, ranked)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            for part in slices(batch, "text", ENCODE_SLICE):
                rows = encoded_rows(encoder, part.column("text").to_pylist())
                counts = [len(row) // 4 for row in rows]
                flat, edges = np.frombuffer(b"".join(rows), "<u4").astype(np.int64), np.cumsum([0, *counts])
                decimals, at = decimal_pieces(path).joined(flat, edges)
                by_ids = [sha(decimals[start : max(start, end - 1)]) for start, end in zip(at, at[1:])]
                data, at = token_pieces(path).joined(flat, edges)
                texts = (str(data[start:end], "utf-8", "replace") for start, end in zip(at, at[1:]))
                by_text = [sha(text.encode("utf-8")) for text in texts]
                columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(by_ids), pa.array(by_text)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidied(digested), ROUNDTRIP)
