"""URL rules as a sort-merge range join.

The canonical key of a host is its labels from the right, each closed by a dot:
``www.example.net`` becomes ``net.example.www.``.  A rule's host is then a prefix
of the keys of the host and all its subdomains, and a prefix is an interval of
sorted keys.  URLs are range-sorted by key and stored with their range; a rule
goes to every range that its interval meets.  In a range, a sweep over rules and
URLs in key order keeps the stack of nested rules that are open at each URL and
picks the longest whose path the URL's path starts with.

Inputs and results that need saying: a null url or one without ``://`` has an
empty host and path and fits no rule; an empty path does not start with ``/``;
of two fitting rules the one with more characters (host and path) wins, then a
blocking one, then the smaller string; equal rules count once; without any rule
every URL gets the default; equal rows each get a verdict; an empty table gives
no rows; further columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialise

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_END = "\U0010ffff"  # above every key with the same beginning


def host_and_path(url):
    """(host, path) columns of a url column; both empty where there is no host part."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host):
    """The labels of a host from the right, each closed by a dot."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def _sweep(default: str, key: str):
    def verdict(stack, path):
        fitting = [r for _, own in stack for r in own if path.startswith(r[1])]
        if not fitting:
            return None, default
        _, _, rule, action = min(fitting, key=lambda r: (-len(r[2]), r[3] != "block", r[2]))
        return rule, action

    def work(batches):
        stack: list[tuple[str, list]] = []  # open keys, each a prefix of the next, with their rules
        span = None
        for batch in batches:
            keep, rules, verdicts = [], [], []
            columns = [batch.column(c).to_pylist() for c in ("_range", "_key", "_kind", "host", "path", "action")]
            for i, (where, k, kind, host, path, action) in enumerate(zip(*columns)):
                if where != span:
                    stack, span = [], where
                while stack and not k.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != k:
                        stack.append((k, []))
                    stack[-1][1].append((host, path, host + path, action))
                else:
                    rule, action = verdict(stack, path) if k else (None, default)
                    keep.append(i)
                    rules.append(rule)
                    verdicts.append(action)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key).take(rows), batch.column("host").take(rows), batch.column("path").take(rows),
                 pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=[key, "host", "path", "rule", "verdict"],
            )

    return work


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict) of each row; ``rules`` has host, path and action (allow or block)."""
    kind = pages.schema[key].dataType.simpleString()
    host, path = host_and_path(F.col(url))
    urls = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("_key", host_key(F.col("host")))
    urls = urls.repartitionByRange("_key", "path", key).withColumn("_range", F.spark_partition_id())
    urls = materialise(urls, "url-ranges")

    # One row for each range, so as many as there are partitions.
    spans = urls.groupBy("_range").agg(F.min("_key").alias("low"), F.max("_key").alias("high")).orderBy("_range").collect()
    number = np.array([s["_range"] for s in spans], dtype=np.int32)
    low = np.array([s["low"] for s in spans], dtype=object)
    high = np.array([s["high"] for s in spans], dtype=object)

    def to_ranges(batches):
        for batch in batches:
            first = [int(np.searchsorted(high, k)) for k in batch.column("_key").to_pylist()]
            last = [int(np.searchsorted(low, k + _END)) for k in batch.column("_key").to_pylist()]
            at = [i for i, (a, b) in enumerate(zip(first, last)) for _ in range(a, b)]
            ranges = [number[r] for a, b in zip(first, last) for r in range(a, b)]
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int32()), *[batch.column(c).take(rows) for c in ("_key", "host", "path", "action")]],
                names=["_range", "_key", "host", "path", "action"],
            )

    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "action").dropna().distinct()
    rules = rules.withColumn("_key", host_key(F.col("host"))).where("_key <> ''")
    rules = rules.select("_key", "host", "path", "action").mapInArrow(
        to_ranges, "_range int, _key string, host string, path string, action string"
    )
    both = urls.withColumn("_kind", F.lit(1)).withColumn("action", F.lit(None).cast("string")).unionByName(
        rules.withColumn("_kind", F.lit(0)).withColumn(key, F.lit(None).cast(kind))
    )
    both = both.repartition("_range").sortWithinPartitions("_range", "_key", "_kind")
    return both.mapInArrow(_sweep(default, key), f"`{key}` {kind}, host string, path string, rule string, verdict string")
