"""URL filters: a sort-merge range join of urls with nested host and path rules."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import one_name, ready, texts
from changeflow.session import written


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def key(self) -> str:
        return ".".join(reversed(self.host.split("."))) + "."


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    host = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``com.example.www.`` for ``www.example.com``: subdomains share their parent's prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def judge(spark: SparkSession, urls: DataFrame, rules: tuple[Rule, ...] | DataFrame = RULES,
          url: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``urls`` with ``host``, ``path``, ``rule`` and ``verdict``.

    Hosts are reversed, so that a rule covers the interval of keys that start with
    its own, and intervals are nested or apart. Urls and rules are sorted together
    by key; a sweep over each range of keys keeps a stack of the rules that are
    active and takes, of those whose path fits, the longest (host and path
    together; of two as long, the one with the longer host; of two with the same
    host and path the verdict that sorts first). Range cuts are spread over the
    row number too, so that one host, or one url, with most rows fills many
    ranges. A rule goes to each range its interval meets.

    ``rules`` may be a table (host, path, verdict) of any size; rows with a null
    are no rules. A url that no rule fits gets rule null and verdict ``default``. A
    null url, or one without ``://``, has an empty host and path; repeated rows
    are judged alike. Columns of ``urls`` are kept; of those named like a result
    column only the url survives. An empty table gives no rows.
    """
    ready(spark)
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules],
                                      "host string, path string, verdict string")
    keep = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")
            or c == url]
    key = one_name(urls, "key")
    part = one_name(urls, "part")
    rule = one_name(urls, "rule_row")
    keyed = urls.select(*keep).withColumns({"host": host_of(F.col(url)),
                                            "path": path_of(F.col(url))}) \
        .withColumn(key, F.concat(reversed_host(F.col("host")), F.col("path")))
    spreader = F.xxhash64(*keep)
    sorted_urls = written(keyed.repartitionByRange(F.col(key), spreader)
                          .withColumn(part, F.spark_partition_id()), "urls")
    ends = sorted_urls.groupBy(part).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    reached = _reach(rules, ends, part)
    # Rule rows sort before the urls of the same key.
    both = sorted_urls.withColumn(rule, F.lit(None).cast(
        "struct<key:string,host:string,path:string,verdict:string>")).unionByName(
        reached.select(part, F.col("rule.key").alias(key), F.col("rule").alias(rule)),
        allowMissingColumns=True)
    order = [F.col(part), F.col(key), F.col(rule).isNull()]
    swept = both.repartition(part).sortWithinPartitions(*order)
    schema = sorted_urls.drop(part, key).withColumns({
        "rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")}).schema
    return swept.mapInArrow(_sweeper(part, key, rule, default), schema)


def _reach(rules: DataFrame, ends: DataFrame, part: str) -> DataFrame:
    """Each rule once for every range of keys that its interval meets.

    ``ends`` has one row per range, as many as the sort has partitions.
    """
    made = rules.dropna(subset=["host", "path", "verdict"]).groupBy("host", "path") \
        .agg(F.min("verdict").alias("verdict")) \
        .select(F.struct(reversed_host(F.col("host")).alias("key"), "host", "path", "verdict")
                .alias("rule"))
    first = F.col("rule.key")
    # The first string after all that start with the key: its last "." becomes "/".
    after = F.concat(F.expr("substring(rule.key, 1, length(rule.key) - 1)"), F.lit("/"))
    return made.join(F.broadcast(ends), (first <= F.col("high")) & (F.col("low") < after)) \
        .select(part, "rule")


def _sweeper(part: str, key: str, rule_row: str, default: str):
    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, Paths]] = []
        here = None
        for batch in batches:
            rules = batch.column(batch.schema.get_field_index(rule_row))
            parts, keys = texts(batch, part), texts(batch, key)
            hosts, paths = texts(batch, "host"), texts(batch, "path")
            is_rule = rules.is_valid().to_numpy(zero_copy_only=False)
            named, verdicts = [], []
            for row, prefix in enumerate(keys):
                if parts[row] != here:
                    here, stack = parts[row], []
                while stack and not prefix.startswith(stack[-1][0]):
                    stack.pop()
                if is_rule[row]:
                    rule = rules[row].as_py()
                    if not stack or stack[-1][0] != rule["key"]:
                        stack.append((rule["key"], Paths()))
                    stack[-1][1].add(rule)
                    continue
                name, verdict = _longest(stack, hosts[row], paths[row])
                named.append(name)
                verdicts.append(verdict if name is not None else default)
            out = batch.filter(pa.array(np.logical_not(is_rule)))
            out = out.drop_columns([part, key, rule_row])
            yield out.append_column("rule", pa.array(named, pa.string())) \
                .append_column("verdict", pa.array(verdicts, pa.string()))
    return sweep


class Paths:
    """The rules of one host, found by the lengths their paths have."""

    def __init__(self) -> None:
        self.by_path: dict[str, dict] = {}
        self.lengths: list[int] = []

    def add(self, rule: dict) -> None:
        self.by_path[rule["path"]] = rule
        self.lengths = sorted({len(p) for p in self.by_path}, reverse=True) \
            if len(rule["path"]) not in self.lengths else self.lengths

    def fit(self, path: str) -> dict | None:
        for n in self.lengths:
            if n <= len(path) and (rule := self.by_path.get(path[:n])):
                return rule
        return None


def _longest(stack: list, host: str, path: str) -> tuple[str | None, str | None]:
    best, size = (None, None), -1
    for _, paths in reversed(stack):  # longer hosts first
        rule = paths.fit(path)
        if rule and len(rule["host"]) + len(rule["path"]) > size:
            best, size = (rule["host"] + rule["path"], rule["verdict"]), \
                len(rule["host"]) + len(rule["path"])
    return best
