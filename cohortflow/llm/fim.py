"""Fill-in-the-middle transformation by secondary sort.

A text of n code points is cut into prefix, middle and suffix, and each part into pieces of bounded length.
Pieces are keyed by their row and their position in the output; dealing them by row and sorting them by both
within partitions (``repartition`` with ``sortWithinPartitions``, the DataFrame form of
``repartitionAndSortWithinPartitions``) brings each output together as a stream, which feeds a digest
piece by piece. The stream is then read for its marks, its parts get their positions in the
original, and a second sort within the same partitions streams the restored text into another digest.

No task holds more than some pieces of a text. A row's key is its task and place there, so rows that repeat a
doc_id, or are wholly alike, are each transformed, and a hot doc_id is dealt to many partitions. Input
must give its rows in the same order when a task is run again: a scan or a written table. A null text
is empty; a null doc_id reads as no digits. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cohortflow.llm.common import slices

UNITS = 16_384
OUT_BYTES = 4 << 20
OUT_ROWS = 8_192

PIECES = "row bigint, place bigint, doc_id bigint, form string, n bigint, prefix_chars bigint, middle_chars bigint, piece string"
PARTS = "row bigint, part int, place bigint, doc_id bigint, form string, n bigint, prefix_chars bigint, middle_chars bigint, digest string, piece string"
OUTPUTS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
DIGESTS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


@dataclass(frozen=True)
class Settings:
    """Marks of prefix, suffix and middle, and the percentages of texts transformed and of those with the suffix first."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    transformed: int = 90
    suffix_first: int = 20
    salt: str = "1"

    def marks(self, form: str) -> list[tuple[int, str]]:
        """(part, mark) in output order; parts are numbered as they stand in the text."""
        by_part = [(0, self.prefix), (1, self.middle), (2, self.suffix)]
        return {"plain": [], "psm": [by_part[0], by_part[2], by_part[1]], "spm": [by_part[2], by_part[0], by_part[1]]}[form]

    def cut(self, doc_id: int | None, text: str) -> tuple[str, int, int]:
        """Form of a text, and where its prefix and its middle end."""
        digest = hashlib.sha256(f"{self.salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
        if not text or self.prefix in text or self.suffix in text or self.middle in text or h3 % 100 >= self.transformed:
            return "plain", 0, 0
        a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
        return ("spm" if h4 % 100 < self.suffix_first else "psm"), a, b


class Rows:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, schema: str):
        fields = [field.split() for field in schema.split(", ")]
        self.schema = pa.schema([(name, ARROW[kind]) for name, kind in fields])
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, *row: object) -> None:
        self.rows.append(row)
        self.bytes += len(row[-1] or "")

    def full(self) -> bool:
        return len(self.rows) >= OUT_ROWS or self.bytes >= OUT_BYTES

    def take(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[] for _ in self.schema]
        made = pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(columns, self.schema)], schema=self.schema)
        self.rows, self.bytes = [], 0
        return made


def rows_of(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[tuple]:
    """Rows of a batch, some MB of ``piece`` as Python objects at once."""
    for part in slices(batch, "piece"):
        yield from zip(*(part.column(name).to_pylist() for name in names))


def output_pieces(documents: DataFrame, settings: Settings = Settings(), units: int = UNITS) -> DataFrame:
    """Pieces of at most ``units`` code points and a mark, in text order; ``place`` is their place in the output.

    The piece at place 0 alone carries what is known of the row. A plain text is one part without a mark.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, out = TaskContext.get().partitionId() << 40, Rows(PIECES)
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    text = text or ""
                    form, a, b = settings.cut(doc_id, text)
                    parts = {0: (0, len(text))} if form == "plain" else {0: (0, a), 1: (a, b), 2: (b, len(text))}
                    marks = settings.marks(form) or [(0, "")]
                    first, place = {}, 0
                    for number, _ in marks:
                        first[number] = place
                        place += max(1, -(-(parts[number][1] - parts[number][0]) // units))
                    mark_of = dict(marks)
                    known = (doc_id, form, len(text), None, None) if form == "plain" else (doc_id, form, len(text), a, b - a)
                    for number, (start, end) in parts.items():
                        for k, at in enumerate(range(start, max(end, start + 1), units)):
                            place = first[number] + k
                            mark = "" if k else mark_of[number]
                            out.add(row, place, *(known if place == 0 else (None,) * 5), mark + text[at : min(at + units, end)])
                        if out.full():
                            yield out.take()
                    row += 1
        yield out.take()

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, PIECES)


def in_output_order(pieces: DataFrame) -> DataFrame:
    """Pieces of a row in one partition, in the order of the output."""
    return pieces.repartition("row").sortWithinPartitions("row", "place")


class MarkReader:
    """Tells the parts of an output from its marks, read piece by piece; a mark may lie across pieces."""

    def __init__(self, settings: Settings, form: str):
        self.ahead = settings.marks(form)
        self.part, self.held = (None, "") if self.ahead else (0, "")

    def read(self, piece: str) -> list[tuple[int, str]]:
        """(part, text) of what is certain so far."""
        text, found = self.held + piece, []
        while self.ahead:
            number, mark = self.ahead[0]
            at = text.find(mark)
            if at < 0:
                safe = max(0, len(text) - len(mark) + 1)
                found.append((self.part, text[:safe]))
                self.held = text[safe:]
                return self.of_parts(found)
            found.append((self.part, text[:at]))
            text, self.part = text[at + len(mark) :], number
            self.ahead.pop(0)
        self.held = ""
        return self.of_parts([*found, (self.part, text)])

    @staticmethod
    def of_parts(found: list) -> list[tuple[int, str]]:
        return [(part, text) for part, text in found if part is not None and text]


def assembled_parts(ordered: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Outputs streamed into digests, and their parts' pieces with their places in the original.

    Part -1 of a row has its digest and what is known of it.
    """

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, row, known, digest, reader, place = Rows(PARTS), None, None, None, None, 0

        def finish() -> None:
            out.add(row, -1, 0, *known, digest.hexdigest(), None)

        for batch in batches:
            for here, piece, *about in rows_of(batch, ("row", "piece", "doc_id", "form", "n", "prefix_chars", "middle_chars")):
                if here != row:
                    if row is not None:
                        finish()
                    row, known, digest, place = here, about, hashlib.sha256(), 0
                    reader = MarkReader(settings, about[1])
                digest.update(piece.encode("utf-8", "surrogatepass"))
                for part, text in reader.read(piece):
                    out.add(row, part, place, None, None, None, None, None, None, text)
                    place += 1
                if out.full():
                    yield out.take()
        if row is not None:
            finish()
        yield out.take()

    return ordered.mapInArrow(assemble, PARTS)


def restored_digests(parts: DataFrame) -> DataFrame:
    """A row per text with the digests of its output and of the text rebuilt from it.

    ``parts`` are partitioned by row already, so only the order within partitions changes.
    """

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, row, known, digest = Rows(DIGESTS), None, None, None
        for batch in batches:
            for here, piece, *about in rows_of(batch, ("row", "piece", "doc_id", "n", "form", "prefix_chars", "middle_chars", "digest")):
                if here != row:
                    if row is not None:
                        out.add(*known, digest.hexdigest())
                    row, known, digest = here, about, hashlib.sha256()
                else:
                    digest.update(piece.encode("utf-8", "surrogatepass"))
                if out.full():
                    yield out.take()
        if row is not None:
            out.add(*known, digest.hexdigest())
        yield out.take()

    return parts.sortWithinPartitions("row", "part", "place").mapInArrow(restore, DIGESTS)


def transformed(documents: DataFrame, settings: Settings = Settings(), units: int = UNITS) -> DataFrame:
    """A row per text: doc_id, n, form, prefix_chars, middle_chars and ``output``, the transformed text."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, row, known, pieces = Rows(OUTPUTS), None, None, []
        for batch in batches:
            for here, piece, *about in rows_of(batch, ("row", "piece", "doc_id", "n", "form", "prefix_chars", "middle_chars")):
                if here != row:
                    if row is not None:
                        out.add(*known, "".join(pieces))
                    row, known, pieces = here, about, []
                pieces.append(piece)
                if out.full():
                    yield out.take()
        if row is not None:
            out.add(*known, "".join(pieces))
        yield out.take()

    return in_output_order(output_pieces(documents, settings, units)).mapInArrow(join, OUTPUTS)


def restored_text(output: str, form: str, settings: Settings = Settings()) -> str:
    """The text that an output of this form was made from."""
    reader, parts = MarkReader(settings, form), {0: [], 1: [], 2: []}
    for part, text in reader.read(output):
        parts[part].append(text)
    return "".join(text for number in sorted(parts) for text in parts[number])


def audit(documents: DataFrame, settings: Settings = Settings(), units: int = UNITS) -> DataFrame:
    """Every text transformed and restored: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    return restored_digests(assembled_parts(in_output_order(output_pieces(documents, settings, units)), settings))
