"""State kept as files. It belongs to one stream checkpoint, whose batch numbers it
uses, and has one writer.

Sums are runs of files, merged by level. An upsert table is a folded base and the
micro-batches after it: ``batches/batch=<id>`` holds what one micro-batch added. A
replayed batch replaces its folder, so every batch counts once. Old batches are
folded into ``base/upto=<id>`` from time to time; a one-row record makes a finished
base known, so a torn one is never read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from changeflow.operators.changelog import BEFORE, apply_changelog
from changeflow.session import child_names, path_exists, remove_dir, remove_file

BASES = "upto long"
NOW = 1 << 62
BUCKETS = 32  # that an upsert table's base begins with
BUCKET_ROWS = 1 << 21  # of a bucket, beyond which buckets are split


class BatchFiles:
    """The files of a base and of the batches after it."""

    def __init__(self, spark: SparkSession, path: str, batch_schema: StructType,
                 base_schema: StructType):
        self.spark, self.path = spark, path
        self.batch_schema, self.base_schema = batch_schema, base_schema

    def _read(self, folder: str, schema: StructType, number: str) -> DataFrame:
        numbered = StructType(schema.fields + [StructField(number, LongType())])
        if not path_exists(self.spark, f"{self.path}/{folder}"):  # nothing written yet
            return self.spark.createDataFrame([], numbered)
        return self.spark.read.schema(numbered).parquet(f"{self.path}/{folder}")

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Store one batch."""
        self._write(rows.select(*self.batch_schema.fieldNames()), f"batches/batch={batch_id}")

    def _bases(self, batch_id: int) -> list[int]:
        """The finished bases that hold only batches before ``batch_id``, in order."""
        if not path_exists(self.spark, f"{self.path}/bases"):  # never folded
            return []
        known = self.spark.read.schema(BASES).json(f"{self.path}/bases").collect()
        return sorted({r["upto"] for r in known if r["upto"] < batch_id})

    def folded(self, batch_id: int) -> bool:
        """Whether a base up to ``batch_id`` is there; a repeated batch must not
        rewrite the base it reads."""
        return batch_id - 1 in self._bases(batch_id)


class BucketFiles(BatchFiles):
    """The same with a base cut into hash buckets of a key, as many as its size asks for.

    A base lies in ``base-<n>/upto=<id>`` for ``n`` buckets, in Spark's own bucketed
    layout. It holds only the buckets it changed; its record names them with their
    rows, and the files of the others stay in use. When a bucket has more than
    ``bucket_rows`` rows, the next base is written whole in twice as many.
    """

    RECORD = "upto long, n int, buckets array<int>, rows array<long>"

    def __init__(self, spark: SparkSession, path: str, batch_schema: StructType,
                 base_schema: StructType, keys: Sequence[str], buckets: int, bucket_rows: int):
        super().__init__(spark, path, batch_schema, base_schema)
        self.keys, self.buckets, self.bucket_rows = list(keys), buckets, bucket_rows
        self._tables: dict[int, str] = {}

    def bucket(self, n: int) -> Column:
        """The bucket of a row among ``n``, as Spark's bucketed writer has it."""
        return F.pmod(F.hash(*self.keys), F.lit(n))

    def _records(self, batch_id: int) -> list:
        """The finished bases before ``batch_id`` in order, those of the newest number of buckets."""
        if not path_exists(self.spark, f"{self.path}/bases"):
            return []
        known = self.spark.read.schema(self.RECORD).json(f"{self.path}/bases").collect()
        found = sorted({r["upto"]: r for r in known if r["upto"] < batch_id}.values(),
                       key=lambda r: r["upto"])
        return [r for r in found if r["n"] == found[-1]["n"]]

    def _bases(self, batch_id: int) -> list[int]:
        return [r["upto"] for r in self._records(batch_id)]

    def count(self, batch_id: int = NOW) -> int:
        """The number of buckets of the newest base before ``batch_id``."""
        records = self._records(batch_id)
        return records[-1]["n"] if records else self.buckets

    @staticmethod
    def _places(records: list) -> dict[int, int]:
        """The base that holds each bucket's rows."""
        return {bucket: r["upto"] for r in records for bucket in r["buckets"]}

    def _table(self, n: int) -> str:
        """A name under which the session knows the bucketed files of ``n`` buckets."""
        if n not in self._tables:
            name = f"changeflow_{uuid.uuid4().hex}"
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                                for f in self.base_schema.fields)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(f"CREATE TABLE {name} ({columns}, _upto BIGINT) USING parquet "
                           f"PARTITIONED BY (_upto) CLUSTERED BY ({keys}) INTO {n} BUCKETS "
                           f"LOCATION '{self.path}/base-{n}'")
            self._tables[n] = name
        return self._tables[n]

    def base(self, batch_id: int) -> DataFrame:
        """The newest base before ``batch_id``, bucketed by the keys for whatever joins it."""
        records = self._records(batch_id)
        if not records:
            return self.spark.createDataFrame([], self.base_schema)
        n, places = records[-1]["n"], self._places(records)
        name = self._table(n)
        self.spark.catalog.recoverPartitions(name)
        held = F.array(*[F.lit(places[b]).cast("bigint") for b in range(n)])
        return self.spark.table(name).where(
            F.col("_upto").isin(sorted(set(places.values())))
            & (held[self.bucket(n)] == F.col("_upto"))).drop("_upto")

    def files(self, batch_id: int, buckets: Sequence[int]) -> DataFrame:
        """The rows of some buckets, read from their files alone."""
        records = self._records(batch_id)
        places, wanted = self._places(records), set(buckets)
        found = []
        for upto in {places[b] for b in wanted if b in places}:
            folder = f"{self.path}/base-{records[-1]['n']}/_upto={upto}"
            found += [f"{folder}/{name}" for name in child_names(self.spark, folder)
                      if (b := bucket_of_file(name)) in wanted and places[b] == upto]
        return self.spark.read.schema(self.base_schema).parquet(*found) if found else \
            self.spark.createDataFrame([], self.base_schema)

    def changes(self, batch_id: int) -> DataFrame:
        """The batches after the newest base before ``batch_id``, numbered ``batch``."""
        bases = self._bases(batch_id)
        newest = bases[-1] if bases else -1
        return self._read("batches", self.batch_schema, "batch").where(
            (F.col("batch") < batch_id) & (F.col("batch") > newest))

    def touched(self, changes: DataFrame, n: int | None = None) -> list[int]:
        """The buckets of the changes' keys."""
        bucket = self.bucket(n or self.count())
        return sorted(r[0] for r in changes.select(bucket.alias("bucket")).distinct().collect())

    def grown(self, batch_id: int) -> bool:
        """Whether a bucket is too large, so that all of them are to be split."""
        sizes = {b: n for r in self._records(batch_id) for b, n in zip(r["buckets"], r["rows"])}
        return any(n > self.bucket_rows for n in sizes.values())

    def store(self, rows: DataFrame, batch_id: int, n: int, buckets: Sequence[int]) -> None:
        """Make ``rows`` the state of ``buckets`` among ``n`` after all batches before ``batch_id``.

        Files are removed once the last two bases can do without them.
        """
        known, upto = self._records(batch_id - 1), batch_id - 1
        name, place = self._table(n), f"{self.path}/base-{n}/_upto={upto}"
        remove_dir(self.spark, place)  # of a fold that was lost
        rows.select(*self.base_schema.fieldNames(), F.lit(upto).cast("bigint").alias("_upto")) \
            .repartition(n, *self.keys).write.insertInto(name)
        sizes = {b: 0 for b in buckets}
        if path_exists(self.spark, place):
            sizes |= {r["bucket"]: r["count"] for r in self.spark.read.schema(self.base_schema)
                      .parquet(place).groupBy(self.bucket(n).alias("bucket")).count().collect()}
        record = [(upto, n, list(sizes), list(sizes.values()))]
        self.spark.createDataFrame(record, self.RECORD).coalesce(1) \
            .write.mode("append").json(f"{self.path}/bases")  # a single row
        if known:
            self._clean(known, n)

    def _clean(self, known: list, n: int) -> None:
        before = known[-2]["upto"] if len(known) > 1 else -1
        for batch in range(max(before + 1, 0), known[-1]["upto"] + 1):
            remove_dir(self.spark, f"{self.path}/batches/batch={batch}")
        for name in child_names(self.spark, self.path):  # bases of fewer buckets, one split ago
            if name.startswith("base-") and int(name.removeprefix("base-")) * 2 < n:
                remove_dir(self.spark, f"{self.path}/{name}")
        now, last = self._places(known), self._places(known[:-1])
        gone: dict[int, set[int]] = {}
        for bucket, upto in last.items():
            if now[bucket] != upto:
                gone.setdefault(upto, set()).add(bucket)
        for upto, buckets in gone.items():
            folder = f"{self.path}/base-{known[-1]['n']}/_upto={upto}"
            for name in child_names(self.spark, folder):
                if bucket_of_file(name) in buckets:
                    remove_file(self.spark, f"{folder}/{name}")


def bucket_of_file(name: str) -> int | None:
    """The bucket that Spark's writer puts into a file's name."""
    found = re.match(r"part-.*_(\d+)(?:\..*)?$", name)
    return int(found[1]) if found else None


class Segments:
    """Rows kept as runs of files, merged upwards by level, each file with its range of ``part``.

    A micro-batch is a run of level 0. When a level has ``fan`` runs they become one
    run of the next: files whose ranges overlap are read, put through ``merge`` and
    written anew, neighbours of fewer than ``small`` rows too; a file that overlaps no
    other one moves up as it is. So a row is rewritten once a level at most, files of
    ranges that no later batch touches keep their names, and the number of runs
    grows with the logarithm of the number of batches.

    A list of the files that make up the state is written for each batch, after its
    files; what is not in a list is never read. A batch that is run again starts
    from the list before it. Lists, and files that only they name, are removed when
    they are ``keep`` batches old, for the sake of readers under way.
    """

    LIST = "level int, run bigint, file string, rows bigint, low {0}, high {0}, note string"

    def __init__(self, spark: SparkSession, path: str, schema: StructType, part: str,
                 merge: Callable[[DataFrame], DataFrame], fan: int = 8, small: int = 1 << 16,
                 keep: int | None = None):
        self.spark, self.path, self.schema, self.part = spark, path, schema, part
        self.merge, self.fan, self.small = merge, max(fan, 2), small
        self.keep = 2 * self.fan if keep is None else keep
        self.listed = self.LIST.format(schema[part].dataType.simpleString())

    def list(self, batch_id: int) -> list:
        """The files after a batch, with a first row that has only the batch's note."""
        place = f"{self.path}/lists/batch={batch_id}"
        if batch_id < 0 or not path_exists(self.spark, f"{place}/_SUCCESS"):
            return []
        return self.spark.read.schema(self.listed).json(place).collect()

    def last(self, before: int = NOW) -> int:
        """The last batch before ``before`` that has a list, or -1."""
        done = [int(n.removeprefix("batch=")) for n in child_names(self.spark, f"{self.path}/lists")
                if n.startswith("batch=")]
        return max((n for n in done if n < before and path_exists(
            self.spark, f"{self.path}/lists/batch={n}/_SUCCESS")), default=-1)

    def note(self, before: int = NOW) -> str | None:
        """What the last batch before ``before`` noted."""
        return next((r["note"] for r in self.list(self.last(before)) if r["file"] is None), None)

    def read(self, before: int = NOW, values: Sequence | None = None) -> DataFrame:
        """The rows of all batches before ``before``; of the files that can hold some of the
        ``values`` of ``part`` (None is one), if these are given."""
        found = [r for r in self.list(self.last(before)) if r["file"] is not None]
        if values is not None:
            found = [r for r in found if any(
                r["low"] is None if v is None else r["high"] is not None
                and (r["low"] is None or r["low"] <= v) and v <= r["high"] for v in values)]
        return self._rows([r["file"] for r in found])

    def _rows(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*files) if files else \
            self.spark.createDataFrame([], self.schema)

    def add(self, rows: DataFrame, batch_id: int, note: str | None = None) -> DataFrame:
        """Store one batch and return it as stored; the same batch again replaces it."""
        known = [r.asDict() for r in self.list(self.last(batch_id)) if r["file"] is not None]
        own = self._write(rows, f"run={batch_id}", 0, batch_id)
        known += own
        level = 0
        while len({r["run"] for r in known if r["level"] == level}) >= self.fan:
            known = [r for r in known if r["level"] != level] + self._merged(
                [r for r in known if r["level"] == level], batch_id, level + 1)
            level += 1
        head = {"level": None, "run": None, "file": None, "rows": None, "low": None, "high": None,
                "note": note}
        self.spark.createDataFrame([head, *known], self.listed).coalesce(1).write \
            .mode("overwrite").json(f"{self.path}/lists/batch={batch_id}")  # a row per file
        self._forget(batch_id)
        return self._rows([r["file"] for r in own])

    def _write(self, rows: DataFrame, name: str, level: int, run: int) -> list[dict]:
        """Write rows in ranges of ``part``; the files with their ranges."""
        place = f"{self.path}/files/{name}"
        rows.select(*self.schema.fieldNames()).repartitionByRange(self.part) \
            .sortWithinPartitions(self.part).write.mode("overwrite").parquet(place)
        value = F.col(self.part)
        found = self.spark.read.schema(self.schema).parquet(place).groupBy(
            F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"),
            F.count(F.when(value.isNull(), 1)).alias("nulls")).collect()
        return [{"level": level, "run": run, "file": r["file"], "rows": r["rows"], "note": None,
                 "low": None if r["nulls"] else r["low"], "high": r["high"]} for r in found]

    def _merged(self, files: list[dict], batch_id: int, level: int) -> list[dict]:
        """The files of one level as one run of the next."""
        run = min(r["run"] for r in files)
        # Without a low end a file holds nulls, which come first; it may hold nothing else.
        files.sort(key=lambda r: (r["low"] is not None, r["low"] if r["low"] is not None else 0))
        groups: list[list[dict]] = []
        for r in files:
            last = groups[-1] if groups else None
            ends = [g["high"] for g in last if g["high"] is not None] if last else []
            overlaps = last is not None and (
                r["low"] is None or bool(ends) and r["low"] <= max(ends))
            tiny = last is not None and sum(g["rows"] for g in last) + r["rows"] < self.small
            if overlaps or tiny:
                last.append(r)
            else:
                groups.append([r])
        out = []
        for number, group in enumerate(groups):
            if len(group) == 1:
                out.append({**group[0], "level": level, "run": run})
                continue
            rows = self.merge(self._rows([r["file"] for r in group]))
            out += self._write(rows, f"merged={batch_id}-{level}-{number}", level, run)
        return out

    def _forget(self, batch_id: int) -> None:
        """Remove lists older than ``keep`` batches, and the files that no later one names."""
        old = sorted(int(n.removeprefix("batch=")) for n in child_names(
            self.spark, f"{self.path}/lists") if n.startswith("batch="))
        old = [n for n in old if n <= batch_id - self.keep]
        for n in old:
            later = {r["file"] for r in self.list(self._next(n))}
            for row in self.list(n):
                if row["file"] is not None and row["file"] not in later:
                    remove_file(self.spark, row["file"])
            remove_dir(self.spark, f"{self.path}/lists/batch={n}")

    def _next(self, batch_id: int) -> int:
        return min(int(n.removeprefix("batch=")) for n in child_names(
            self.spark, f"{self.path}/lists") if n.startswith("batch=")
            and int(n.removeprefix("batch=")) > batch_id)


class Ledger:
    """Sums of ``measures`` per key, kept as increments in :class:`Segments`.

    Files are ranges of the key column ``part``, so a batch reads, and a merge rewrites,
    only what overlaps its values. ``fan`` batches are merged at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[StructField],
                 measures: Sequence[str], part: str, fan: int = 8, small: int = 1 << 16):
        self.part, self.path = part, path
        self.keys = [f.name for f in keys]
        self.measures = list(measures)
        schema = StructType([*[StructField(f.name, f.dataType) for f in keys],
                             *[StructField(m, LongType()) for m in measures]])
        self.files = Segments(spark, path, schema, part, self._summed, fan, small)

    def _summed(self, rows: DataFrame) -> DataFrame:
        """One row a key; those whose sums are all zero drop out."""
        some = F.lit(False)
        for measure in self.measures:
            some = some | (F.col(measure) != 0)
        return rows.groupBy(*self.keys).agg(
            *[F.sum(m).alias(m) for m in self.measures]).where(some)

    def append(self, increments: DataFrame, batch_id: int) -> DataFrame:
        """Store one batch's increments and return them as stored."""
        return self.files.add(increments, batch_id)

    def before(self, batch_id: int, values: Sequence | None = None) -> DataFrame:
        """All increments of earlier batches; keys may repeat. With ``values`` at least
        those that have one of them in ``part``."""
        return self.files.read(batch_id, values)

    def totals(self, batch_id: int = NOW) -> DataFrame:
        """The sums over all batches before ``batch_id``."""
        sums = [F.sum(m).alias(m) for m in self.measures]
        return self.before(batch_id).groupBy(*self.keys).agg(*sums)


class UpsertTable:
    """A keyed table that follows a streamed changelog.

    A micro-batch only appends its changes. Reading applies the changes since
    the last fold to the base, bucket to bucket: the base is not moved. Once in
    ``fold_every`` batches a fold reads and writes those of the base's hash buckets
    whose keys changed; the files of the others stay as they are. Buckets are split
    in two when one has more than ``bucket_rows`` rows. Changes run in the order of
    their batches and by ``order`` inside one.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str],
                 changes: StructType, order: Sequence[str], update_strategy: str = "update",
                 ignore_delete: bool = True, fixed: Sequence[str] = (), few: bool = False,
                 fold_every: int = 50, op: str = "op", buckets: int = BUCKETS,
                 bucket_rows: int = BUCKET_ROWS):
        absent = [c for c in (*schema.fieldNames(), *order, op) if c not in changes.fieldNames()]
        if not keys or absent:
            raise ValueError(f"an upsert table needs a key; the changes lack {absent}")
        self.keys, self.order, self.op = list(keys), list(order), op
        self.options = {"update_strategy": update_strategy, "ignore_delete": ignore_delete,
                        "fixed": list(fixed), "few": few, "op": op}
        self.fold_every = fold_every
        self.files = BucketFiles(spark, path, changes, schema, keys, buckets, bucket_rows)

    def create(self, rows: DataFrame) -> None:
        """Start from ``rows``, before the first batch."""
        if not self.files.folded(0):
            self.files.store(rows, 0, self.files.buckets, range(self.files.buckets))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch; running the same one again changes nothing."""
        self.files.add(batch.where(F.col(self.op) != BEFORE), batch_id)
        if batch_id and batch_id % self.fold_every == 0 and not self.files.folded(batch_id):
            self._fold(batch_id)

    def _fold(self, batch_id: int) -> None:
        files, n = self.files, self.files.count(batch_id)
        changes = files.changes(batch_id)
        if files.grown(batch_id) or not files._bases(batch_id):
            n *= 2 if files.grown(batch_id) else 1
            files.store(self._applied(files.base(batch_id), changes), batch_id, n, range(n))
            return
        touched = files.touched(changes, n)
        files.store(self._applied(files.files(batch_id, touched), changes), batch_id, n, touched)

    def _applied(self, base: DataFrame, changes: DataFrame) -> DataFrame:
        return apply_changelog(base, changes, self.keys, ["batch", *self.order], **self.options)

    def current(self, batch_id: int = NOW) -> DataFrame:
        """The table after all batches before ``batch_id``."""
        return self._applied(self.files.base(batch_id), self.files.changes(batch_id))
