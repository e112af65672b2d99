"""Quality classifier: how much better a text compresses with good examples than with bad."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import one_name, ready, texts

FOLDS = 4  # rows fall by crc32 of their id: 0 and 1 train, 3 calibrates, 2 is held out
HELD_OUT = 2
KEEP_FROM = 0.7
SAMPLE_DOCS = 6000  # labelled documents of each class the dictionaries may see
SAMPLE_BYTES = 8 << 20  # and bytes of them
DOC_BYTES = 1 << 15  # and bytes of one of them, in pieces from all over it
DICTIONARY = 110 << 10  # bytes of a dictionary at most, and
SAMPLE_SHARE = 16  # at most this part of the smaller sample
SEGMENT = 200  # bytes that training copies at once; chosen, it gives steadier results
MATCH = 8  # than letting training search for it
LEVEL = 3
PIECE = 2048  # texts are compressed in pieces, so that a dictionary matters everywhere
LENGTHS = (64, 256)  # bytes at which calibration classes begin
STEPS = 500  # calibration bins per byte of difference


@dataclass
class Model:
    """Two dictionaries and, for each class of lengths, a rising curve of scores."""

    good: bytes
    bad: bytes
    trained: bool
    curves: list[tuple[list[float], list[float]]] = field(default_factory=list)
    _tools: tuple | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_tools": None}

    def difference(self, text: str) -> tuple[float, int]:
        """Bytes that the good dictionary saves per byte of text, and the text's bytes."""
        raw = text.encode("utf-8", "replace")
        if self._tools is None:
            self._tools = self._compressor(self.good), self._compressor(self.bad)
        good, bad = self._tools
        saved = 0
        for at in range(0, len(raw), PIECE):
            piece = raw[at:at + PIECE]
            saved += len(bad.compress(piece)) - len(good.compress(piece))
        return saved / max(len(raw), 1), len(raw)

    def _compressor(self, content: bytes) -> zstandard.ZstdCompressor:
        plain = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        if not content:
            return zstandard.ZstdCompressor(compression_params=plain)
        kind = zstandard.DICT_TYPE_AUTO if self.trained else zstandard.DICT_TYPE_RAWCONTENT
        return zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(content, dict_type=kind),
            compression_params=plain)

    def score(self, text: str | None) -> float:
        """The chance that the text's label is 1."""
        difference, size = self.difference(text or "")
        marks, scores = self.curves[bisect_right(LENGTHS, size)]
        return scores[bisect_right(marks, difference)]


def fold(ident: Column) -> Column:
    """crc32 of the id as text, mod 4; -1 for a null id, which is in no fold."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % FOLDS, F.lit(-1))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, ident: str = "doc_id",
        text: str = "text", label: str = "quality") -> Model:
    """Learn from the labelled rows outside the held-out fold.

    Dictionaries are trained on a sample of at most ``SAMPLE_DOCS`` documents and
    ``SAMPLE_BYTES`` bytes of each label from folds 0 and 1, the first by a hash
    of the id; of a text of more than ``DOC_BYTES`` bytes pieces from its start to its end.
    All labelled rows of fold 3 calibrate: their differences are counted in bins, and for each class of lengths the share of label 1 is made
    to rise with the difference (isotonic regression, with a row of the overall
    share added to each level). Null ids, null labels and labels other than
    0 and 1 are passed over; a repeated label row counts again. Without rows of
    either label every score is the overall share (0.5 if there is none).
    """
    ready(spark)
    labels = labels.where(F.col(label).isin(0, 1)).select(
        F.col(ident).alias("ident"), F.col(label).alias("label"), fold(F.col(ident)).alias("fold"))
    docs = docs.select(F.col(ident).alias("ident"), F.col(text).alias("text"))
    samples = [_sample(docs, labels.where(F.col("label") == wanted)) for wanted in (1, 0)]
    good, bad, trained = _dictionaries(*samples)
    model = Model(good, bad, trained)
    lengths = F.lit(0)
    for length in LENGTHS:
        lengths = lengths + (F.col("size") >= length).cast("int")
    tested = _differences(docs.where(fold(F.col("ident")) == 3), model)
    counted = tested.join(labels.where("fold = 3").select("ident", "label"), "ident") \
        .groupBy(lengths.alias("length"), F.round(F.col("difference") * STEPS).cast("int")
                 .alias("step")) \
        .agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).collect()
    total, ones = sum(r["n"] for r in counted), sum(r["ones"] for r in counted)
    share = ones / total if total else 0.5
    for length in range(len(LENGTHS) + 1):
        bins = sorted((r["step"], r["n"], r["ones"]) for r in counted if r["length"] == length)
        model.curves.append(rising(bins, share) if good and bad else ([], [share]))
    return model


def _sample(docs: DataFrame, labels: DataFrame) -> list[bytes]:
    """Pieces of the first labelled documents by a hash of their id, within the bounds."""
    chosen = labels.where(F.col("fold").isin(0, 1)).select("ident").distinct() \
        .orderBy(F.xxhash64("ident"), "ident").limit(SAMPLE_DOCS)
    found = docs.join(F.broadcast(chosen), "ident") \
        .select("ident", F.encode("text", "UTF-8").alias("raw")) \
        .select("ident", _all_over("raw").alias("head"))
    first = found.withColumn("size", F.length("head")).where("size > 0") \
        .withColumn("order", F.xxhash64("ident"))
    # The bound: at most SAMPLE_DOCS rows of at most DOC_BYTES bytes, cut to SAMPLE_BYTES.
    sizes = first.groupBy("order", "ident").agg(F.sum("size").alias("size"),
                                                F.count(F.lit(1)).alias("n")) \
        .orderBy("order", "ident").limit(SAMPLE_DOCS).collect()
    room, taken = SAMPLE_BYTES, []
    for row in sizes:
        if row["size"] <= room:
            room -= row["size"]
            taken.append(row["ident"])
    if not taken:
        return []
    wanted = docs.sparkSession.createDataFrame([(i,) for i in taken], found.select("ident").schema)
    heads = found.join(F.broadcast(wanted), "ident").orderBy("ident", "head").select("head")
    return [bytes(r["head"][at:at + PIECE]) for r in heads.collect()
            for at in range(0, len(r["head"]), PIECE)]


def _all_over(raw: str) -> Column:
    """All of a binary column up to ``DOC_BYTES``; of more, pieces at even distances, the
    first from its start and the last from its end."""
    pieces = DOC_BYTES // PIECE
    cut = [F.expr(f"substring({raw}, CAST(1 + {i} * (CAST(length({raw}) AS bigint) - {PIECE})"
                  f" DIV {pieces - 1} AS int), {PIECE})") for i in range(pieces)]
    return F.when(F.length(raw) <= DOC_BYTES, F.col(raw)).otherwise(F.concat(*cut))


def _dictionaries(good: list[bytes], bad: list[bytes]) -> tuple[bytes, bytes, bool]:
    """Trained dictionaries, or from too few examples the examples themselves."""
    if not good or not bad:
        return b"", b"", False
    size = min(DICTIONARY, *(sum(map(len, sample)) // SAMPLE_SHARE for sample in (good, bad)))
    try:
        return *(zstandard.train_dictionary(size, sample, k=SEGMENT, d=MATCH).as_bytes()
                 for sample in (good, bad)), True
    except zstandard.ZstdError:
        return *(b"\n".join(sample)[:max(size, PIECE)] for sample in (good, bad)), False


def rising(bins: list[tuple[int, int, int]], share: float) -> tuple[list[float], list[float]]:
    """The isotonic curve of binned counts (step, rows, ones): borders, and a score for each gap."""
    blocks: list[list[int]] = []  # rows, ones, first step
    for step, n, ones in bins:
        blocks.append([n, ones, step])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, ones2, _ = blocks.pop()
            blocks[-1][0] += n2
            blocks[-1][1] += ones2
    scores = list(accumulate(((ones + share) / (n + 1) for n, ones, _ in blocks), max))
    return [(b[2] - 0.5) / STEPS for b in blocks[1:]], scores or [share]


def _differences(docs: DataFrame, model: Model) -> DataFrame:
    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.difference(t or "") for t in texts(batch, "text")]
            yield batch.drop_columns(["text"]) \
                .append_column("difference", pa.array([d for d, _ in found], pa.float64())) \
                .append_column("size", pa.array([n for _, n in found], pa.int64()))

    schema = docs.drop("text").withColumns({"difference": F.lit(0.0),
                                            "size": F.lit(0).cast("bigint")}).schema
    return docs.mapInArrow(measure, schema)


def scored(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text",
           into: str = "score", keep_text: bool = True) -> DataFrame:
    """``docs`` with the score (0 to 1) of each whole text.

    A null text counts as empty; an empty one gets the share of label 1 among
    the shortest. A text of any length is compressed whole, in pieces. Repeated rows score
    alike. A column named like the score is
    replaced; an empty table gives no rows.
    """
    ready(spark)
    reads = one_name(docs, "read")
    kept = [c for c in docs.columns if c.lower() != into.lower() and (keep_text or c != text)]
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score
            yield batch.drop_columns([reads]).append_column(
                into, pa.array([score(t) for t in texts(batch, reads)], pa.float64()))

    schema = docs.select(*kept).withColumn(into, F.lit(0.0)).schema
    return docs.select(*kept, F.col(text).alias(reads)).mapInArrow(run, schema)


def good_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, ident: str = "doc_id",
                   text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that score ``keep_from`` or more, with their own columns."""
    score = one_name(docs, "score")
    model = fit(spark, docs, labels, ident, text)
    return scored(spark, docs, model, text, score).where(F.col(score) >= keep_from).drop(score)
