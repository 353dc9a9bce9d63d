"""Line dedup with a log-template tree: lines of recurring templates go from all documents but the first.

A line is a row of tokens; a token with a digit is a variable field. The tree has a fixed depth: token
count, then the leading tokens. Lines of one node that agree in most positions share a template, whose
other positions are generalised to variables; they must agree beyond the leading tokens too. A node with very many different
lines is dealt to blocks, and the templates of its blocks are merged by the same rule, in rounds if they are many
themselves: each round deals them by the token at another place and to blocks of bounded size, so templates that agree in
most places meet in most rounds and no task gets all templates of a large node. What is left of a node after that, if it
is many still, is joined by its rarest tokens, which no similar pair escapes.

Tokens travel as 16-bit hashes, two bytes each, so the lines themselves are never shuffled.
Long lines also recur word for word, from two different texts on, by a hash of the whole line. Lines with too few tokens
for a template, or with digits in all of them, recur word for word too. Documents with the same text count once, and all of them keep what the first of them keeps.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortflow.llm.common import BROADCAST_KEYS, drop_stage, slices, stage, tidied

DEPTH = 3
NODE_LINES = 1024
#: Rounds in which the templates of a node are merged if they are more than ``NODE_LINES``.
ROUNDS = 4
SCANNED = 256
SIMILARITY = 0.7
MIN_TOKENS = 3
MIN_DOCS = 5
#: Lines of at least so many tokens without digits, or different tokens, recur from ``LONG_DOCS`` different texts on, word
#: for word. In scripts without spaces ``UNSPACED`` characters count as a token.
LONG_TOKENS = 10
UNSPACED = 2
LONG_DOCS = 2
#: Bytes of tokens and their codes that a task remembers.
MEMO_BYTES = 24 << 20
ENTRY_BYTES = 150

LINES = "doc_id bigint, text_key bigint, line int, exact bigint, is_long boolean, node bigint, tokens binary"
PLACED = "node bigint, tokens binary, template bigint, kind int, weight bigint, least bigint"
#: Kinds of placed rows: a line of an undivided node, a line of a block, a template of a block.
WHOLE, PART, HEAD = range(3)
VARIABLE = 0


#: Thai, Lao, Myanmar, Khmer, kana and Chinese characters.
unspaced = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def is_long_line(line: str, words: list[str], codes: array) -> bool:
    """Whether a line is too long for two texts to hold its very words by chance."""
    if len(codes) - codes.count(VARIABLE) >= LONG_TOKENS or len(words) >= LONG_TOKENS and len(set(words)) >= LONG_TOKENS:
        return True
    return not line.isascii() and len(unspaced.findall(line)) >= UNSPACED * LONG_TOKENS


class TokenCodes(dict):
    """16-bit codes of tokens; 0 for variable fields."""

    has_digit = re.compile(r"\d").search
    held = 0

    def __missing__(self, token: str) -> int:
        self.held += len(token) + ENTRY_BYTES
        if self.held > MEMO_BYTES:
            self.clear()
            self.held = len(token) + ENTRY_BYTES
        code = VARIABLE if self.has_digit(token) else 1 + zlib.crc32(token.encode("utf-8", "surrogatepass")) % 65_535
        self[token] = code
        return code


def text_key(text: str) -> int:
    """What ``xxhash64`` of Spark gives for the text."""
    key = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 42)
    return key - (1 << 64) if key >> 63 else key


def parse_lines(documents: DataFrame, min_tokens: int = MIN_TOKENS, depth: int = DEPTH) -> DataFrame:
    """A row per line that is not blank: a hash of its very words, its tree node and token codes.

    Lines of less than ``min_tokens`` tokens and lines whose tokens are all variable fields have no template, so
    no node and no codes.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = TokenCodes().__getitem__
        for batch in batches:
            for part in slices(batch, "text"):
                doc_ids, keys, numbers, exact, is_long, nodes, tokens = [], [], [], [], [], [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    key = text_key(text)
                    for number, line in enumerate(text.split("\n")):
                        words = line.split()
                        codes = array("H", map(code, words))
                        if not words:
                            continue
                        has_template = len(codes) >= min_tokens and any(codes)
                        lead = array("H", (min(len(codes), 65_535), *codes[:depth])).tobytes()
                        doc_ids.append(doc_id)
                        keys.append(key)
                        numbers.append(number)
                        exact.append(xxhash.xxh64_intdigest(" ".join(words).encode("utf-8", "surrogatepass")) - (1 << 63))
                        is_long.append(is_long_line(line, words, codes))
                        nodes.append(xxhash.xxh64_intdigest(lead) - (1 << 63) if has_template else None)
                        tokens.append(codes.tobytes() if has_template else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(keys, pa.int64()),
                        pa.array(numbers, pa.int32()),
                        pa.array(exact, pa.int64()),
                        pa.array(is_long, pa.bool_()),
                        pa.array(nodes, pa.int64()),
                        pa.array(tokens, pa.binary()),
                    ],
                    ["doc_id", "text_key", "line", "exact", "is_long", "node", "tokens"],
                )

    return documents.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(tidied(parsed), LINES)


def divided(lines: DataFrame, node_lines: int = NODE_LINES, key: str = "node") -> DataFrame:
    """Different lines with ``leaf``: their ``key``, or the block a line is dealt to if the key has very many."""
    wide = lines.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node_lines)
    wide = stage(wide.select(key, F.ceil(F.col("n") / node_lines).alias("blocks")), "wide")
    few = wide.count() <= BROADCAST_KEYS
    leaf = F.when(F.col("blocks").isNull(), F.col(key)).otherwise(F.xxhash64(key, F.pmod(F.xxhash64("tokens"), "blocks")))
    return lines.join(F.broadcast(wide) if few else wide, key, "left").withColumn("leaf", leaf).drop("blocks")


class Templates:
    """Templates of one leaf; all its lines have the same number of tokens.

    Up to ``SCANNED`` templates are looked at one and all. With more, a line is compared with those only that share one
    of its rarest tokens at their places: so many that a similar template must have one of them.
    """

    def __init__(self, similarity: float, depth: int = DEPTH):
        self.similarity, self.depth, self.n, self.room = similarity, depth, 0, np.empty((0, 0), np.uint16)
        self.weights: list[int] = []
        self.least: list[int] = []
        self.holders: dict[int, array] = {}

    @property
    def rows(self) -> np.ndarray:
        return self.room[: self.n]

    def candidates(self, codes: np.ndarray, need: int) -> np.ndarray | None:
        """Numbers of the templates that may agree with ``need`` tokens or more; None for all."""
        if self.n <= SCANNED:
            return None
        places = np.flatnonzero(codes)
        held = sorted((self.holders.get(key, ()) for key in ((places << 16) | codes[places]).tolist()), key=len)
        found = [np.frombuffer(h, np.uint32) for h in held[: len(places) - need + 1] if h]
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint32)

    def note(self, row: int) -> None:
        """Enter a template's tokens by place."""
        places = np.flatnonzero(self.room[row])
        for key in ((places << 16) | self.room[row][places]).tolist():
            self.holders.setdefault(key, array("I")).append(row)

    def add(self, codes: np.ndarray) -> int:
        """A template of its own."""
        if self.n == len(self.room):
            room = np.empty((max(1, 2 * self.n), len(codes)), np.uint16)
            if self.n:
                room[: self.n] = self.rows
            self.room = room
        self.room[self.n] = codes
        self.n += 1
        self.weights.append(0)
        self.least.append(len(codes))
        if self.n > SCANNED:
            for row in range(0 if self.n == SCANNED + 1 else self.n - 1, self.n):
                self.note(row)
        return self.n - 1

    def place(self, codes: np.ndarray, weight: int = 1, constants: int | None = None) -> int:
        """Row of the template that takes the line, a new one if none is similar enough.

        The line may be a template itself: ``constants`` is the least number of constant tokens of its lines.
        """
        constants = max(1, int((codes != VARIABLE).sum())) if constants is None else constants
        need = needed(codes, constants, self.similarity, self.depth)
        some = self.candidates(codes, need)
        rows = self.rows if some is None else self.room[some]
        row = -1
        if len(rows):
            same = ((rows == codes) & (codes != VARIABLE)).sum(1)
            best = int(same.argmax())
            if same[best] >= need:
                row = best if some is None else int(some[best])
                self.room[row][self.room[row] != codes] = VARIABLE
        if row < 0:
            row = self.add(codes)
        self.weights[row] += weight
        self.least[row] = min(self.least[row], constants)
        return row


def name_of(*parts: int) -> int:
    """A template's name."""
    return xxhash.xxh64_intdigest(" ".join(map(str, parts)).encode()) - (1 << 63)


def merge_leaves(heads: DataFrame, similarity: float) -> DataFrame:
    """Templates (leaf, node, tokens, template, weight, least) placed among those of their leaf, frequent ones first.

    Rows with ``template`` tell which template took it (``merged``); rows without are the templates there are then.
    """
    schema = pa.schema([(name, pa.binary() if name == "tokens" else pa.int64()) for name in ("template", "merged", "node", "tokens", "weight", "least")])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, node, tree = None, None, {}

        def left() -> Iterator[pa.RecordBatch]:
            for size, own in tree.items():
                columns = [[None] * own.n, [name_of(leaf, size, row) for row in range(own.n)], [node] * own.n, [row.tobytes() for row in own.rows], own.weights, own.least]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

        for batch in batches:
            taken, names = [], []
            for at, node_at, tokens, template, weight, least in zip(*(batch.column(c).to_pylist() for c in ("leaf", "node", "tokens", "template", "weight", "least"))):
                if at != leaf:
                    yield from left()
                    leaf, node, tree = at, node_at, {}
                codes = np.frombuffer(tokens, np.uint16)
                taken.append(template)
                names.append(name_of(leaf, len(codes), tree.setdefault(len(codes), Templates(similarity)).place(codes, weight, least)))
            none = [pa.nulls(len(names), t) for t in schema.types[2:]]
            yield pa.RecordBatch.from_arrays([pa.array(taken, pa.int64()), pa.array(names, pa.int64()), *none], schema=schema)
        yield from left()

    rows = heads.select("leaf", "node", "tokens", "template", "weight", "least").repartition("leaf")
    rows = rows.sortWithinPartitions("leaf", F.desc("weight"), "tokens", "template")
    return rows.mapInArrow(tidied(placed), "template bigint, merged bigint, node bigint, tokens binary, weight bigint, least bigint")


def wide_nodes(heads: DataFrame, node_lines: int) -> DataFrame | None:
    """Nodes of more than ``node_lines`` templates; None if there are none."""
    wide = stage(heads.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node_lines).select("node"), "wide")
    n = wide.count()
    return (F.broadcast(wide) if n <= BROADCAST_KEYS else wide) if n else None


def round_groups(heads: DataFrame, turn: int) -> DataFrame:
    """``heads`` with ``group``: their node and the token at the place of this round."""
    size = (F.length("tokens") / 2).cast("int")
    place = F.lit(DEPTH) + F.floor((size - DEPTH) * turn / ROUNDS).cast("int")
    return heads.withColumn("group", F.xxhash64(F.lit(turn), "node", size, F.substring("tokens", place * 2 + 1, F.lit(2))))


def needed(codes: np.ndarray, constants: int, similarity: float, depth: int = DEPTH) -> int:
    """In how many tokens a line or template of so many constants has to agree with a template that takes it."""
    beyond = int((codes[:depth] != VARIABLE).sum()) + 1
    return min(constants, max(math.ceil(similarity * constants - 1e-9), beyond))


def postings(heads: DataFrame, similarity: float) -> DataFrame:
    """A row per constant token of a template, at its place (``key``).

    ``asked`` is how many of them, whichever, are enough to ask for: a template that takes this one has one of them.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "tokens", 1 << 18):
                columns: list[list[np.ndarray]] = [[], [], [], [], []]
                for node, tokens, template, least in zip(*(part.column(c).to_pylist() for c in ("node", "tokens", "template", "least"))):
                    codes = np.frombuffer(tokens, np.uint16)
                    places = np.flatnonzero(codes)
                    asked = len(places) - needed(codes, least, similarity) + 1
                    found = (node, len(codes), (places.astype(np.int64) << 16) | codes[places], template, asked)
                    for column, values in zip(columns, found):
                        column.append(np.broadcast_to(np.asarray(values, np.int64), places.shape))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in columns], ["node", "size", "key", "template", "asked"])

    rows = heads.select("node", "tokens", "template", "least")
    return rows.mapInArrow(tidied(listed), "node bigint, size bigint, key bigint, template bigint, asked bigint")


def similar_pairs(heads: DataFrame, similarity: float, node_lines: int) -> DataFrame:
    """Every template with all those before it (frequent ones first) that may take it: ``template``, ``other`` and in how many tokens they agree.

    A template asks for its rarest tokens only, at their places; holders of a token are dealt to blocks of about
    ``node_lines``, so no task gets all holders of a frequent one.
    """
    posts = stage(postings(heads, similarity), "postings")
    at = ["node", "size", "key"]
    shared = posts.groupBy(*at).agg(F.count(F.lit(1)).alias("n"))
    held = posts.join(shared, at).withColumn("blocks", F.ceil(F.col("n") / node_lines))
    rarest = F.row_number().over(Window.partitionBy("template").orderBy("n", "key"))
    asking = held.withColumn("_r", rarest).where("_r <= asked and n > 1").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    holding = held.where("n > 1").select(*at, F.pmod(F.xxhash64("template"), "blocks").alias("block"), F.col("template").alias("other"))
    met = asking.select(*at, "block", "template").join(holding, [*at, "block"]).where("template <> other").select("template", "other").distinct()
    own = heads.select("template", "tokens", "weight", "least")
    both = met.join(own, "template").join(own.selectExpr("template other", "tokens other_tokens", "weight other_weight"), "other")
    before = F.struct(-F.col("other_weight"), "other_tokens", "other") < F.struct(-F.col("weight"), "tokens", "template")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for template, other, tokens, other_tokens, least in zip(*(batch.column(c).to_pylist() for c in ("template", "other", "tokens", "other_tokens", "least"))):
                codes = np.frombuffer(tokens, np.uint16)
                same = int(((codes == np.frombuffer(other_tokens, np.uint16)) & (codes != VARIABLE)).sum())
                if same >= needed(codes, least, similarity):
                    kept.append((template, other, same))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*kept)] if kept else [pa.array([], pa.int64())] * 3, ["template", "other", "same"])

    columns = ["template", "other", "tokens", "other_tokens", "least"]
    return both.where(before).select(*columns).mapInArrow(tidied(compared), "template bigint, other bigint, same bigint")


def merge_similar(heads: DataFrame, similarity: float, node_lines: int) -> tuple[DataFrame, DataFrame] | None:
    """One round of exact merging: templates left, and ``merged`` with the ``_next`` that took it; None if no two are similar.

    Templates with no similar one before them take those that prefer them, frequent ones first and only while they are
    still similar. The others wait for the next round.
    """
    pairs = stage(similar_pairs(heads, similarity, node_lines), "pairs")
    if pairs.isEmpty():
        return None
    taking = pairs.join(pairs.select(F.col("template").alias("other")).distinct(), "other", "left_anti")
    choice = taking.groupBy("template").agg(F.max_by("other", F.struct("same", "other")).alias("taker"))
    fields = ["node", "tokens", "template", "weight", "least"]
    grouped = heads.select(*fields).join(choice, "template", "left")
    grouped = grouped.withColumns({"first": F.col("taker").isNull(), "taker": F.coalesce("taker", "template")})
    rows = grouped.repartition("taker").sortWithinPartitions("taker", F.desc("first"), F.desc("weight"), "tokens", "template")
    schema = pa.schema([(name, pa.binary() if name == "tokens" else pa.int64()) for name in (*fields, "merged", "_next")])

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taker, node, row, weight, least = None, None, None, 0, 0
        for batch in batches:
            out = []
            for at, node_at, tokens, template, n, constants in zip(*(batch.column(c).to_pylist() for c in ("taker", "node", "tokens", "template", "weight", "least"))):
                codes = np.frombuffer(tokens, np.uint16)
                if at != taker:
                    if row is not None:
                        out.append((node, row.tobytes(), taker, weight, least, None, None))
                    taker, node, row, weight, least = at, node_at, codes.copy(), n, constants
                elif int(((row == codes) & (codes != VARIABLE)).sum()) >= needed(codes, constants, similarity):
                    row[row != codes] = VARIABLE
                    weight, least = weight + n, min(least, constants)
                    out.append((None, None, None, None, None, template, taker))
                else:
                    out.append((node_at, tokens, template, n, constants, None, None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
        if row is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((node, row.tobytes(), taker, weight, least, None, None), schema.types)], schema=schema)

    types = "node bigint, tokens binary, template bigint, weight bigint, least bigint, merged bigint, _next bigint"
    done = stage(rows.select("taker", *fields).mapInArrow(tidied(folded), types), "folded")
    return done.where("template is not null").select(*fields), done.where("merged is not null").select("merged", "_next")


def merged_names(heads: DataFrame, similarity: float = SIMILARITY, node_lines: int = NODE_LINES) -> DataFrame:
    """``template`` and ``merged``: the template that takes each of ``heads`` in the end.

    A node of few templates has them merged at once. Those of others are merged in rounds until they are few or
    ``ROUNDS`` are over. Nodes of more templates even then have all their similar pairs looked up, in a
    join by the templates' rarest tokens, until no two are similar.
    """
    names = heads.select("template", F.col("template").alias("merged"))

    def renamed(taken: DataFrame) -> DataFrame:
        return names.join(taken, "merged", "left").select("template", F.coalesce("_next", "merged").alias("merged"))

    for turn in range(ROUNDS):
        wide = wide_nodes(heads, node_lines)
        if wide is None:
            break
        grouped = round_groups(heads.join(wide, "node", "left_semi"), turn)
        met = stage(merge_leaves(divided(grouped, node_lines, "group"), similarity), "met")
        names = stage(renamed(met.where("template is not null").select(F.col("template").alias("merged"), F.col("merged").alias("_next"))), "names")
        left = met.where("template is null").select("node", "tokens", F.col("merged").alias("template"), "weight", "least")
        heads = stage(heads.join(wide, "node", "left_anti").select(*left.columns).unionByName(left), "heads")
    else:
        wide = wide_nodes(heads, node_lines)
    few = heads if wide is None else heads.join(wide, "node", "left_anti")
    last = merge_leaves(few.withColumn("leaf", F.col("node")), similarity).where("template is not null")
    names = renamed(last.select(F.col("template").alias("merged"), F.col("merged").alias("_next")))
    if wide is None:
        return names
    many = stage(heads.join(wide, "node", "left_semi"), "many")
    while (merged := merge_similar(many, similarity, node_lines)) is not None:
        many, taken = merged
        names = stage(renamed(taken), "names")
    return names


def templates(lines: DataFrame, similarity: float = SIMILARITY, node_lines: int = NODE_LINES) -> DataFrame:
    """``template`` of each different line (node, tokens, weight, leaf): frequent lines are placed first.

    The templates of a node's blocks are then placed themselves, by the same rule, so that lines of one template
    meet however many other lines their node has.
    """
    rows = lines.repartition("leaf").sortWithinPartitions("leaf", F.desc("weight"), "node", "tokens")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf, node, tree = None, None, {}

        def heads() -> Iterator[pa.RecordBatch]:
            for size, own in tree.items() if leaf != node else ():
                names = [name_of(leaf, size, row) for row in range(own.n)]
                columns = [[node] * own.n, [row.tobytes() for row in own.rows], names, [HEAD] * own.n, own.weights, own.least]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, placed_schema().types)], schema=placed_schema())

        for batch in batches:
            out, kinds = [], []
            for at, node_at, tokens, weight in zip(*(batch.column(c).to_pylist() for c in ("leaf", "node", "tokens", "weight"))):
                if at != leaf:
                    yield from heads()
                    leaf, node, tree = at, node_at, {}
                codes = np.frombuffer(tokens, np.uint16)
                row = tree.setdefault(len(codes), Templates(similarity)).place(codes, weight)
                out.append(name_of(leaf, len(codes), row))
                kinds.append(WHOLE if leaf == node else PART)
            none = pa.nulls(len(out), pa.int64())
            columns = [batch.column("node"), batch.column("tokens"), pa.array(out, pa.int64()), pa.array(kinds, pa.int32()), none, none]
            yield pa.RecordBatch.from_arrays(columns, schema=placed_schema())
        yield from heads()

    found = stage(rows.mapInArrow(tidied(placed), PLACED), "placed")
    heads = found.where(F.col("kind") == HEAD).select("node", "tokens", "template", "weight", "least")
    parts = found.where(F.col("kind") == PART).select("node", "tokens", "template")
    parts = parts.join(merged_names(heads, similarity, node_lines), "template").select("node", "tokens", F.col("merged").alias("template"))
    return found.where(F.col("kind") == WHOLE).select("node", "tokens", "template").unionByName(parts)


def placed_schema() -> pa.Schema:
    """Arrow types of ``PLACED``."""
    types = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.schema(list(zip(["node", "tokens", "template", "kind", "weight", "least"], types)))


def later_texts(lines: DataFrame, key: str, enough: Column) -> DataFrame:
    """``doc_id``, ``text_key``, ``line`` of the lines whose ``key`` recurs, without those of the text of its smallest doc_id.

    ``enough`` tells by ``n``, the number of different texts, and ``is_long`` whether a key recurs.
    """
    per_text = lines.groupBy(key, "text_key").agg(F.min("doc_id").alias("doc_id"), F.max("is_long").alias("is_long"))
    each = per_text.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.max("is_long").alias("is_long"), F.min_by("text_key", "doc_id").alias("first"))
    return lines.join(each.where(enough).select(key, "first"), key).where("text_key <> first").select("doc_id", "text_key", "line")


def recurring_lines(documents: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``text_key``, ``line``: the lines to drop; a line may come twice.

    A template recurs if at least ``min_docs`` different texts hold it, a line without template if as many hold its very
    words, a long line if ``LONG_DOCS`` do. The text of its smallest doc_id keeps it.
    """
    lines = stage(parse_lines(documents, min_tokens), "lines")
    least = F.when(F.col("is_long"), LONG_DOCS).otherwise(min_docs)
    exact = stage(later_texts(lines.where("is_long or node is null").drop("tokens"), "exact", F.col("n") >= least), "exact")
    enough = F.count(F.lit(1)) >= min_docs
    nodes = lines.where("node is not null").select("node", "text_key").distinct().groupBy("node").agg(enough.alias("enough")).where("enough").select("node")
    left = stage(lines.drop("exact").join(nodes, "node", "left_semi"), "recurring")
    drop_stage(lines)
    different = left.groupBy("node", "tokens").agg(F.count(F.lit(1)).alias("weight"))
    known = left.join(templates(divided(stage(different, "different")), similarity), ["node", "tokens"])
    known = stage(known.select("doc_id", "text_key", "line", "is_long", "template"), "known")
    drop_stage(left)
    return exact.unionByName(later_texts(known, "template", F.col("n") >= min_docs))


def drop_recurring_lines(documents: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, similarity: float = SIMILARITY) -> DataFrame:
    """``documents`` without the lines of recurring templates and recurring long lines, and with ``n_lines`` and ``n_dropped``.

    Null texts stay null with no lines, empty texts have one empty line; blank lines stay. Rows with the same doc_id and different texts are different documents. An empty table gives an empty result.
    Columns called n_lines and n_dropped are replaced.
    """
    gone = recurring_lines(documents, min_docs, min_tokens, similarity)
    gone = gone.distinct().groupBy(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text")).agg(F.collect_list("line").alias("_gone"))  # a text's own lines
    own = (F.col("doc_id") == F.col("_doc")) & (F.xxhash64("text") == F.col("_text"))
    joined = documents.drop("n_lines", "n_dropped").join(gone, own, "left").drop("_doc", "_text")
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains("_gone", i))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    counted = joined.withColumns({"n_lines": F.coalesce(F.size(lines), F.lit(0)), "n_dropped": F.coalesce(F.size("_gone"), F.lit(0))})
    counted = counted.withColumn("n_lines", F.greatest("n_lines", F.lit(0))).withColumn("n_dropped", F.greatest("n_dropped", F.lit(0)))
    return counted.withColumn("text", text).drop("_gone")
