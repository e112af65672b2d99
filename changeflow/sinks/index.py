"""Document indexes that later writes update."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changeflow.operators.changelog import INSERT
from changeflow.streaming.ledger import UpsertTable

INDEX = "index_name"


class Index:
    """Documents by id, each in the index that its last write names.

    A write has a number: writing the same one again replaces it, and of two
    writes of an id the one with the higher number counts, inside one write the
    last in ``order``. An id whose index changes leaves the old one.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, doc_id: str,
                 order: Sequence[str], index: Column, fold_every: int = 50):
        self.index = index
        stored = StructType([*schema.fields]).add(INDEX, "string")
        changes = StructType([*stored.fields]).add("op", "string")
        self.table = UpsertTable(spark, path, stored, [doc_id], changes, order, "insert",
                                 fold_every=fold_every)

    def write(self, docs: DataFrame, number: int) -> None:
        """Upsert documents; fits as the sink of a stream."""
        self.table.process(docs.withColumns({INDEX: self.index, "op": F.lit(INSERT)}), number)

    def read(self) -> DataFrame:
        """Each document once, with the index it is in."""
        return self.table.current()
