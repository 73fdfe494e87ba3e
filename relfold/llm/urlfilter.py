"""URL filter by a Bloom filter cascade.

Level 0 holds the listed keys; level 1 holds the keys of the corpus that level 0 takes for listed though they are not; level 2 the listed keys that level 1
takes wrongly; and so on until none is left. Over the keys it was built for (the listed ones and every key of the corpus) the cascade answers exactly, in
about two bytes for each listed key, and judging a page needs no join.

Keys are dealt to shards by hash, and each shard has a cascade of its own, built in one task from its distinct keys. Cascades are sent to tasks in groups
of bounded size, one pass over the pages for each group, so memory stays bounded however long the list is.

A NULL url, or one without ``://``, has an empty host and path. The empty host is a key like any other. Repeated pages get equal verdicts; an empty table
gives an empty one; an empty list lists nothing.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relfold.llm.common import ascii_lower, stored, values

SHARD_KEYS = 100_000
GROUP_BYTES = 16 << 20


# ------------------------------------------------------------------ filters (in tasks)

def probes(keys: Sequence[str], level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each key, different on each level."""
    a = np.fromiter((xxhash.xxh3_64_intdigest(k, 2 * level) for k in keys), np.uint64, len(keys))
    b = np.fromiter((xxhash.xxh3_64_intdigest(k, 2 * level + 1) for k in keys), np.uint64, len(keys))
    return a, b | np.uint64(1)


def bit_places(hashes: tuple[np.ndarray, np.ndarray], n_hashes: int, n_bits: int) -> np.ndarray:
    steps = np.arange(n_hashes, dtype=np.uint64)[:, None]
    return (hashes[0] + steps * hashes[1]) % np.uint64(n_bits)


def bloom(keys: Sequence[str], rate: float, level: int) -> tuple[int, int, bytes]:
    n_bits = max(64, math.ceil(-len(keys) * math.log(rate) / math.log(2) ** 2))
    n_hashes = max(1, round(-math.log2(rate)))
    bits = np.zeros(n_bits, np.uint8)
    bits[bit_places(probes(keys, level), n_hashes, n_bits).ravel()] = 1
    return n_hashes, n_bits, np.packbits(bits).tobytes()


def holds(filter_: tuple[int, int, bytes], keys: Sequence[str], level: int) -> np.ndarray:
    n_hashes, n_bits, packed = filter_
    bits = np.frombuffer(packed, np.uint8)
    at = bit_places(probes(keys, level), n_hashes, n_bits)
    return ((bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=0)


def build_cascade(listed: Sequence[str], others: Sequence[str]) -> bytes:
    """Levels as bytes; the first level is as strict as the two counts make worthwhile, the others pass half."""
    levels, inside, outside = [], list(listed), list(others)
    rate = min(0.5, len(inside) / (math.sqrt(2) * len(outside))) if outside else 0.5
    while inside:
        made = bloom(inside, rate, len(levels))
        levels.append(made)
        wrong = holds(made, outside, len(levels) - 1)
        inside, outside, rate = [k for k, w in zip(outside, wrong, strict=True) if w], inside, 0.5
    return b"".join(struct.pack("<HQQ", h, n, len(b)) + b for h, n, b in levels)


def read_cascade(data: bytes) -> list[tuple[int, int, bytes]]:
    levels, at = [], 0
    while at < len(data):
        h, n, size = struct.unpack_from("<HQQ", data, at)
        at += struct.calcsize("<HQQ")
        levels.append((h, n, data[at : at + size]))
        at += size
    return levels


def listed_in(levels: list[tuple[int, int, bytes]], keys: Sequence[str]) -> np.ndarray:
    """Whether each key is listed: the first level that lacks it decides."""
    answer, open_ = np.zeros(len(keys), bool), np.arange(len(keys))
    for level, made in enumerate(levels):
        has = holds(made, [keys[i] for i in open_], level)
        answer[open_[~has]] = level % 2 == 1
        open_ = open_[has]
    answer[open_] = len(levels) % 2 == 1
    return answer


# ------------------------------------------------------------------ on tables

def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark, hash or the end, A-Z lower-cased; empty if there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def cascades(listed: DataFrame, universe: DataFrame, key: str, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(shard, n_shards, cascade) over the distinct keys of both tables; NULL keys are left out. A shard holds about ``shard_keys`` keys."""
    one = lambda df, flag: df.select(F.col(key).cast("string").alias("k"), F.lit(flag).alias("listed")).where("k IS NOT NULL")
    keys = stored(one(listed, True).unionByName(one(universe, False)).groupBy("k").agg(F.max("listed").alias("listed")))
    n_shards = max(1, math.ceil(keys.count() / shard_keys))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, tuple[list[str], list[str]]] = {}
        for batch in batches:
            for shard, k, is_listed in zip(*(values(c) for c in batch.columns), strict=True):
                parts.setdefault(shard, ([], []))[not is_listed].append(k)
        for shard, (inside, outside) in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([build_cascade(inside, outside)], pa.binary())], ["shard", "cascade"])

    dealt = keys.select(shard_of(F.col("k"), n_shards).alias("shard"), "k", "listed").repartition(n_shards, "shard")
    return stored(dealt.mapInArrow(built, "shard long, cascade binary").withColumn("n_shards", F.lit(n_shards)))


def shard_of(key: Column, n_shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_shards)).cast("long")


def mark_listed(rows: DataFrame, key: str, built: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The rows with ``is_listed``, exact for every key of the universe (NULL keys are not listed). One pass over the rows for each group of cascades."""
    found = built.select("shard", "n_shards", F.length("cascade").alias("bytes")).orderBy("shard").collect()  # a few numbers for each 100,000 keys
    n_shards = found[0]["n_shards"] if found else 1
    groups: list[list[int]] = [[]]
    held = 0
    for r in found:
        if groups[-1] and held + r["bytes"] > group_bytes:
            groups.append([])
            held = 0
        groups[-1].append(r["shard"])
        held += r["bytes"]
    schema = rows.select("*", F.lit(True).alias("is_listed")).schema
    place = len(rows.columns)
    shard = F.coalesce(shard_of(F.col(key), n_shards), F.lit(0))

    def one_pass(group: list[int]) -> DataFrame:
        sent = rows.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["cascade"]) for r in built.where(F.col("shard").isin(group)).collect()})

        def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            levels = {s: read_cascade(c) for s, c in sent.value.items()}
            for batch in batches:
                keys, shards = batch.column(place).to_pylist(), np.asarray(batch.column(place + 1))
                answer = np.zeros(len(keys), bool)
                for s in np.unique(shards):
                    at = np.flatnonzero((shards == s) & np.array([k is not None for k in keys], bool))
                    answer[at] = listed_in(levels.get(int(s), []), [keys[i] for i in at])
                yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(answer)], names=schema.names)

        mine = rows.select("*", F.col(key).cast("string").alias("__key"), shard.alias("__shard"))
        if len(groups) > 1:
            # shards that hold no key at all are judged with the first group
            mine = mine.where(F.col("__shard").isin(group) if group is not groups[0] else ~F.col("__shard").isin([s for g in groups[1:] for s in g]))
        return mine.mapInArrow(judged, schema)

    return reduce(DataFrame.unionAll, [one_pass(g) for g in groups])


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The verdict of the longest fitting rule as (rule, verdict), NULL if none fits. A rule ``host/path`` fits its host and all subdomains where the path starts with its own."""
    found = F
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r)):
        own, _, start = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{start}")
        found = found.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    return found.otherwise(F.lit(None).cast("struct<rule:string,verdict:string>"))
