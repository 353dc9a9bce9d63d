"""Language identification: text likelihoods fused with declared language, address suffix and host priors.

Text: byte trigrams hashed to a table of log-probabilities per language, trained on a bounded sample of
each label's texts, with a uniform background (``und``) for text of no known language. The other evidence:
a declared language of known reliability, an address suffix that names a language, and priors by
host, smoothed towards the suffix's and the whole corpus's, which come from grouped sums of
text-only posteriors. A row's own share is taken out of its priors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from cohortflow.llm.common import list_column, slices, stage, without, tidied

#: At most about so many different texts of each language train the text model.
LABEL_ROWS = 2_000
#: Every label is learned. The table of cells times labels has at most ``ENTRIES``: with more labels its cells are fewer.
ENTRIES = 1 << 23
CELLS = 1 << 16
LEAST_CELLS = 1 << 10
DRAWS = 1 << 40
#: Trigrams of a text overlap; together they count as so many independent ones at most.
EVIDENCE = 64
SMOOTHING = 0.5
STRENGTH = 20.0
DECLARED = 0.9
SUFFIX = 0.7
BACKGROUND = 0.01
ACCEPT = 0.5
BROADCAST_HOSTS = 10_000
UNKNOWN = "und"


def cells_for(labels: int) -> int:
    """Cells of a table for so many labels, a power of two."""
    cells = CELLS
    while cells > LEAST_CELLS and cells * (labels + 1) > ENTRIES:
        cells //= 2
    if cells * (labels + 1) > ENTRIES:
        raise ValueError(f"{labels} labels are more than the {ENTRIES // LEAST_CELLS - 1} that fit the table; are they languages?")
    return cells


def trigram_cells(text: str, cells: int = CELLS) -> np.ndarray:
    """Cells of all byte trigrams of a lower-cased text between single spaces at its ends; ``cells`` is a power of two."""
    data = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    code = data[:-2] | (data[1:-1] << np.uint32(8)) | (data[2:] << np.uint32(16))
    return (code * np.uint32(2654435761)) >> np.uint32(33 - cells.bit_length())


class Model:
    """Languages and their log-probabilities per cell (the last column is the background)."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = [*languages, UNKNOWN], table

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Tempered log-likelihood of each text under each language; zeros for texts without any."""
        cells = [trigram_cells(text, len(self.table)) if text and not text.isspace() else None for text in texts]
        out = np.zeros((len(texts), len(self.languages)))
        full = [i for i, c in enumerate(cells) if c is not None]
        if full:
            sizes = np.array([len(cells[i]) for i in full])
            flat = np.concatenate([cells[i] for i in full])
            sums = np.add.reduceat(self.table[flat], np.cumsum([0, *sizes[:-1]]), axis=0, dtype=np.float64)
            out[full] = sums * (np.minimum(sizes, EVIDENCE) / sizes)[:, None]
        return out


def train(labelled: DataFrame, text: str = "text", label: str = "lang", rows: int = LABEL_ROWS) -> Model:
    """The text model from about ``rows`` different texts of each label at most, picked by a hash of the text.

    A label of fewer texts gives all of them, however large the corpus is, and copies of a text count once. The
    driver gets at most ``ENTRIES`` counts, whatever the size of the corpus. Rows with
    null or blank text or label are left out; without any the model knows the background alone. More labels than
    ``ENTRIES`` over ``LEAST_CELLS`` are refused.
    """
    labelled = labelled.select(F.col(text).alias("text"), F.lower(F.trim(label)).alias("label"))
    labelled = labelled.where(F.col("text").rlike(r"\S") & ~F.col("label").isin("", UNKNOWN))
    sizes = stage(labelled.groupBy("label").agg(F.approx_count_distinct("text").alias("n")), "labels")
    languages = sorted(row.label for row in sizes.select("label").limit(ENTRIES // LEAST_CELLS).collect())
    width = cells_for(len(languages))
    shares = sizes.select("label", F.least(F.lit(1.0), F.lit(float(rows)) / F.greatest("n", F.lit(1))).alias("share"))
    drawn = labelled.join(F.broadcast(shares), "label")  # a row per label, refused above if too many
    sample = drawn.where(F.pmod(F.xxhash64("text"), F.lit(DRAWS)) < F.col("share") * DRAWS).select("text", "label").distinct()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for value, language in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                if not value.isspace() and value:
                    cells = counts.setdefault(language, np.zeros(width, np.int64))
                    cells += np.bincount(trigram_cells(value, width), minlength=width)
        for language, cells in counts.items():
            used = np.flatnonzero(cells)
            columns = [pa.array([language] * len(used)), pa.array(used.astype(np.int32)), pa.array(cells[used])]
            yield pa.RecordBatch.from_arrays(columns, ["label", "cell", "n"])

    counts = sample.mapInArrow(tidied(counted), "label string, cell int, n bigint").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    counts = stage(counts, "trigrams")
    numbers = labelled.sparkSession.createDataFrame(list(enumerate(languages)), "number int, label string")
    found = counts.join(F.broadcast(numbers), "label").select("number", "cell", "n").toArrow()  # ENTRIES at most
    table = np.full((width, len(languages) + 1), SMOOTHING)
    table[found.column("cell").to_numpy(), found.column("number").to_numpy()] += found.column("n").to_numpy()
    return Model(languages, np.log(table / table.sum(0)).astype(np.float32))


def scored(df: DataFrame, model: Model, text: str = "text", out: str = "text_score") -> DataFrame:
    """``df`` with the text's log-likelihoods in the order of ``model.languages``."""
    df = df.drop(out)
    shipped = df.sparkSession.sparkContext.broadcast((model.languages[:-1], model.table))  # CELLS rows
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(DoubleType(), False))])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shipped.value)
        width = len(own.languages)
        for batch in batches:
            for part in slices(batch, text, 1 << 20):
                scores = own.scores(part.column(text).to_pylist())
                column = list_column(scores.ravel(), np.arange(0, width * (part.num_rows + 1), width))
                yield pa.RecordBatch.from_arrays([*part.columns, column], [*part.schema.names, out])

    return df.mapInArrow(tidied(added), schema)


def softmax(scores: Column) -> Column:
    """Probabilities from log-scores in an array."""
    top = F.array_max(scores)
    raised = F.transform(scores, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, b: a + b))


def host_of(url: Column) -> Column:
    """Lower-cased host of an address, without user and port; null without ``://``."""
    host = F.regexp_extract(F.lower(url), r"^[^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.when(host != "", host)


def suffix_of(host: Column) -> Column:
    """Last label of a host with a dot; null for others."""
    return F.when(host.contains("."), F.substring_index(host, ".", -1))


def markup_language(html: Column) -> Column:
    """Primary language that ``<html lang=...>`` declares, null if none."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return F.when(found != "", found)


def visible_text(html: Column) -> Column:
    """Markup without scripts, styles and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def evidence(languages: list[str], named: Column, reliability: float) -> Column:
    """Log-likelihood of a named language under each language; flat if none or an unknown one is named."""
    others = float(np.log((1 - reliability) / max(1, len(languages) - 2)))
    flat = float(np.log(1 / max(1, len(languages) - 1)))
    known = named.isin(languages[:-1]) if len(languages) > 1 else F.lit(False)
    each = F.transform(F.array(*map(F.lit, languages)), lambda name: F.when(name == languages[-1], flat).when(name == named, float(np.log(reliability))).otherwise(others))
    return F.when(known, each).otherwise(F.array_repeat(F.lit(0.0), len(languages)))


def stray_evidence(languages: list[str], stray: Column, reliability: float = DECLARED) -> Column:
    """Log-likelihood of the declaration of a language that the model lacks: text of that language is background to it."""
    others = float(np.log((1 - reliability) / max(1, len(languages) - 1)))
    each = F.array(*[F.lit(others)] * (len(languages) - 1), F.lit(float(np.log(reliability))))
    return F.when(stray, each).otherwise(F.array_repeat(F.lit(0.0), len(languages)))


def with_support(df: DataFrame, strength: float = STRENGTH) -> DataFrame:
    """Add ``support`` of rows whose declared language (``named``) is ``stray``: 0 to 1 as more other rows declare it for text of no known language."""
    own = F.element_at("text_posterior", -1)
    counts = df.where(F.col("stray") & ~F.col("blank")).groupBy("named").agg(F.sum(own).alias("mass"))
    few = counts.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    joined = df.join(F.broadcast(counts) if few else counts, "named", "left")
    others = F.greatest(F.col("mass") - own, F.lit(0.0))
    return joined.withColumn("support", F.when(F.col("stray"), F.coalesce(others / (others + strength), F.lit(0.0)))).drop("mass")


def add(*arrays: Column) -> Column:
    """Sum of arrays of one length, position by position."""
    return reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), arrays)


def sums(df: DataFrame, width: int, *keys: str) -> DataFrame:
    """Per key the sum of ``text_posterior`` by position."""
    return df.groupBy(*keys).agg(F.array(*(F.sum(F.col("text_posterior")[i]) for i in range(width))).alias("mass"))


def with_priors(df: DataFrame, width: int, strength: float = STRENGTH) -> DataFrame:
    """Add ``host_prior``: host counts smoothed by suffix counts smoothed by the corpus's, without the row itself."""
    whole = sums(df, width).first()
    mass = np.array(whole.mass if whole and whole.mass[0] is not None else [0.0] * width) + 1.0
    base = [float(x) for x in mass / mass.sum()]
    smooth = lambda counts, own, prior: F.zip_with(
        F.zip_with(counts, own, lambda n, x: F.greatest(n - x, F.lit(0.0))), prior, lambda n, p: n + strength * p
    )
    share = lambda a: F.transform(a, lambda x: x / F.aggregate(a, F.lit(0.0), lambda s, y: s + y))
    corpus = F.array(*map(F.lit, base))
    for key, prior in (("suffix", corpus), ("host", F.col("suffix_prior"))):
        counts = sums(df.where(F.col(key).isNotNull()), width, key)
        few = counts.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
        df = df.join(F.broadcast(counts) if few else counts, key, "left")
        own = share(smooth(F.col("mass"), F.col("text_posterior"), prior))
        df = df.withColumn(f"{key}_prior", F.when(F.col("mass").isNull(), prior).otherwise(own)).drop("mass")
    return df


def identify(df: DataFrame, model: Model, keep: list[str], accept: float = ACCEPT) -> DataFrame:
    """``language``, ``confidence`` and ``accepted`` of rows with text, declared, host and suffix.

    ``keep`` names the columns to carry along. A row is accepted if a language, not the background, has a
    posterior of at least ``accept``; null and blank texts are never accepted. A declared language that the model
    lacks competes as the background does: text of a known language outweighs it, and it is accepted only as far as
    other rows declare it for text of no known language, so that a stray label accepts nothing.
    """
    languages = model.languages
    width = len(languages)
    rows = scored(df.select(*keep, "text", "declared", "host", "suffix"), model)
    blank = F.coalesce(F.trim(F.regexp_replace("text", r"\s", "")) == "", F.lit(True))
    rows = stage(rows.withColumn("blank", blank).drop("text"), "scores")
    start = F.array(*[F.lit(float(np.log((1 - BACKGROUND) / max(1, width - 1))))] * (width - 1), F.lit(float(np.log(BACKGROUND))))
    rows = rows.withColumn("text_posterior", softmax(add(F.col("text_score"), start)))
    named = F.lower(F.trim("declared"))
    stray = F.coalesce(~named.isin("", *languages), F.lit(False))
    rows = with_priors(rows, width).withColumns({"named": named, "stray": stray})
    rows = with_support(rows)
    fused = add(
        F.col("text_score"),
        F.transform("host_prior", lambda x: F.log(x)),
        evidence(languages, F.col("named"), DECLARED),
        stray_evidence(languages, F.col("stray")),
        evidence(languages, F.col("suffix"), SUFFIX),
    )
    rows = rows.withColumn("posterior", softmax(fused)).withColumn("top", F.array_max("posterior"))
    place = F.array_position("posterior", F.col("top")).cast("int")
    rows = rows.withColumn("found", F.element_at(F.array(*map(F.lit, languages)), place))
    declared = F.col("stray") & (F.col("found") == UNKNOWN) & (F.col("top") * F.col("support") >= accept)
    language = F.when(F.col("blank"), F.lit(UNKNOWN)).when(declared, F.col("named")).otherwise(F.col("found"))
    confidence = F.when(declared, F.col("top") * F.col("support")).otherwise(F.col("top"))
    accepted = declared | ~F.col("blank") & (F.col("found") != UNKNOWN) & (F.col("top") >= accept)
    return rows.select(*keep, language.alias("language"), confidence.alias("confidence"), accepted.alias("accepted"))


def document_evidence(documents: DataFrame) -> DataFrame:
    """Documents with their source as host and their label as the declared language."""
    host = F.lower("source")
    rest = F.xxhash64("text", "lang", "source")  # tells rows of one doc_id apart
    return documents.select("doc_id", rest.alias("rest"), "text", F.col("lang").alias("declared"), host.alias("host"), suffix_of(host).alias("suffix"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Pages with visible text, the language their markup declares, and host and suffix of the address."""
    host = host_of(F.col("url"))
    return pages.select(
        "page_id", visible_text(F.col("html")).alias("text"), markup_language(F.col("html")).alias("declared"), host.alias("host"), suffix_of(host).alias("suffix")
    )


def keep_accepted(documents: DataFrame) -> DataFrame:
    """``documents`` whose language is accepted, by a model trained on their own labels; rows without doc_id stay.

    Rows that share a doc_id and differ otherwise are judged each.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text", "lang", "source").alias("rest")))
    judged = identify(document_evidence(documents).withColumn("_key", F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rest"))), train(documents), ["_key"])
    return without(documents.withColumn("_key", key), judged.where("not accepted"), "_key").drop("_key")
