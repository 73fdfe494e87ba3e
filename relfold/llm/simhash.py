"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has one bit for each bit of its shingles' hashes, set where over half of the hashes have it set. Texts whose fingerprints differ in
few bits are linked; linked texts form components.

Candidates come from structured bit masks. Each bit place has a non-zero label of radius + 1 bits; for each non-zero v there is a mask that keeps the
places whose label has an odd product with v. Any ``radius`` places have labels that some v is orthogonal to, so that mask drops all of them: two
fingerprints within the radius agree under at least one of the 2^(radius+1) - 1 masks. For a wider radius the places are cut into parts: with p parts some part
holds at most radius // p differences, and each part has masks of its own.

A fingerprint may have several words of 64 bits, each from the same hashes mixed anew; more bits tell similar texts apart more sharply. Links may then reach
further than the radius (``reach``): all pairs within the radius meet under a mask, and most of those beyond it that are within reach, since they agree under one
of the many masks by chance. A digest of the words stands for the fingerprint.

Work is on distinct fingerprints, so copies cost nothing. Fingerprints that agree under a mask meet in one task, sorted, and are linked there by growing
sets: each fingerprint is compared with those not yet reached only. The result is a spanning forest of the links, never all pairs. A group beyond
``block`` fingerprints is cut into blocks, and each pair of blocks meets in a task of its own.

NULL and empty texts have fingerprint zero and are linked like any other. Equal rows have equal fingerprints, so one component. The component's id is its
smallest id; NULL ids count only if there is no other. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relfold.llm.common import id_schema, out_batch, raw_texts, stored

BITS, SEED, BLOCK = 64, 42, 1 << 16


# ------------------------------------------------------------------ fingerprints

def shingle_hashes(text: bytes, size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each shingle of words, A-Z lower-cased, joined by one space; fewer words than ``size`` make one shingle, no words none."""
    found = text.lower().split()  # on bytes: ASCII letters and ASCII blanks only
    if not found:
        return np.empty(0, np.uint64)
    size = min(size, len(found))
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = (ends - [len(w) + 1 for w in found])[: len(found) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=True)), np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8")
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """The hashes for a further word: a multiple of an odd number is added, then bits are spread by shifts and products (SplitMix64)."""
    x = hashes + np.uint64(word * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def wide_fingerprint(hashes: np.ndarray, words: int) -> list[int]:
    """The fingerprint, then ``words`` - 1 more of the same hashes mixed anew."""
    return [fingerprint(mixed(hashes, j) if j else hashes) for j in range(words)]


def word_names(words: int) -> list[str]:
    """Columns of a fingerprint of several words; one word is the column ``fp`` itself."""
    return [f"w{j}" for j in range(words)] if words > 1 else []


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, words: int = 1) -> DataFrame:
    """(id, fp) of each row; fp is the fingerprint as a signed long. With several words fp is their digest, and columns w0, w1, ... follow."""
    names = word_names(words)

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([wide_fingerprint(shingle_hashes(t, shingle), words) for t in raw_texts(batch.column(1))], np.uint64).reshape(-1, words)
            key = np.fromiter((xxhash.xxh64_intdigest(row.tobytes()) for row in found), np.uint64, len(found)) if names else found[:, 0].copy()
            columns = {"fp": key, **{name: found[:, j].copy() for j, name in enumerate(names)}}
            yield out_batch(batch.column(0), {k: pa.array(v.view(np.int64)) for k, v in columns.items()})

    schema = ", ".join(f"{c} long" for c in ("fp", *names))
    return docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).mapInArrow(printed, id_schema(docs, doc_id, schema))


# ------------------------------------------------------------------ candidates and links

def covering_masks(radius: int, parts: int = 1, bits: int = BITS) -> list[int]:
    """Masks such that any two words that differ in at most ``radius`` bits agree under one of them."""
    if not 1 <= parts <= radius + 1 <= bits:
        raise ValueError("1 <= parts <= radius + 1 <= bits")
    near = radius // parts
    labels = (1 << near + 1) - 1
    masks = []
    for part in range(parts):
        places = range(bits * part // parts, bits * (part + 1) // parts)
        for v in range(1, labels + 1):
            masks.append(sum(1 << p for i, p in enumerate(places) if ((i % labels + 1) & v).bit_count() % 2))
    return masks


def signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def forest(prints: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links (places) that join the fingerprints within ``radius`` of each other, one less than the members of each set; a row holds the words of one."""
    prints = prints.reshape(len(prints), -1)
    waiting = np.arange(len(prints))
    while len(waiting):
        reached, waiting = [int(waiting[0])], waiting[1:]
        while reached and len(waiting):
            at = reached.pop()
            near = np.bitwise_count(prints[waiting] ^ prints[at]).sum(axis=1) <= radius
            for other in waiting[near].tolist():
                yield (at, other)
                reached.append(other)
            waiting = waiting[~near]


def masked(mask: int, names: list[str]) -> Column:
    """What a mask keeps of a fingerprint's words, as one long: the bits themselves if they lie in one word, else their hash."""
    kept = [F.col(name).bitwiseAND(F.lit(signed(m))) for j, name in enumerate(names) if (m := mask >> BITS * j & (1 << BITS) - 1)]
    return kept[0] if len(kept) == 1 else F.xxhash64(*kept)


def links(prints: DataFrame, radius: int, parts: int = 1, block: int = BLOCK, words: int = 1, reach: int | None = None) -> DataFrame:
    """(a, b) with a < b: links between distinct fingerprints (``fp`` and the columns of their words).

    They span the same components as all pairs within ``reach`` that agree under a mask, so at least those of all pairs within ``radius`` (the reach if none is given).
    """
    reach = radius if reach is None else reach
    if reach < radius:
        raise ValueError("reach below the radius")
    masks = covering_masks(radius, parts, BITS * words)
    held_names = ["fp", *word_names(words)]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("m"), masked(m, held_names[-words:]).alias("k")) for i, m in enumerate(masks)])).alias("x")
    pair_schema = "a long, b long, m int, k long, " + ", ".join(f"{c} long" for c in held_names)
    pair_names = ["a", "b", "m", "k", *held_names]

    def spans(batches: Iterator[pa.RecordBatch], width: int, limit: int) -> Iterator[pa.RecordBatch]:
        """Groups of equal leading columns, as they come sorted; a group beyond ``limit`` is handed on row by row."""
        empty = lambda n: pa.nulls(n, pa.int64())
        held: list[np.ndarray] = []
        group, size = None, 0

        def closed() -> Iterator[pa.RecordBatch]:
            if size > limit:
                yield from handed()
            elif size > 1:
                found = np.concatenate(held)
                pairs = np.array(list(forest(found[:, -words:].view(np.uint64), reach)), np.int64).reshape(-1, 2)
                if len(pairs):
                    a, b = found[pairs[:, 0], 0], found[pairs[:, 1], 0]
                    rest = [empty(len(a)) for _ in ("k", *held_names)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), empty(len(a)).cast(pa.int32()), *rest], pair_names)

        def handed() -> Iterator[pa.RecordBatch]:
            for part in held:
                n = len(part)
                own = [pa.array(np.full(n, group[0]), pa.int32()), pa.array(np.full(n, group[1]), pa.int64()), *[pa.array(c) for c in part.T.copy()]]
                yield pa.RecordBatch.from_arrays([empty(n), empty(n), *own], pair_names)
            held.clear()

        for batch in batches:
            columns = [np.asarray(batch.column(i)) for i in range(width)]
            values = np.stack([np.asarray(c) for c in batch.columns[width:]], axis=1)
            if not batch.num_rows:
                continue
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for start, end in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                own = tuple(int(c[start]) for c in columns)
                if own != group:
                    if group is not None:
                        yield from closed()
                    held, group, size = [], own, 0
                held.append(values[start:end].copy())
                size += end - start
                if size > limit:
                    yield from handed()
        if group is not None:
            yield from closed()

    met = prints.select(*held_names, keys).select("x.m", "x.k", *held_names).repartition("m", "k").sortWithinPartitions("m", "k", "fp")
    first = stored(met.mapInArrow(lambda b: spans(b, 2, block), pair_schema))
    found = first.where("a IS NOT NULL").select("a", "b")
    # groups beyond a block: each pair of blocks is a group of at most two blocks
    large = first.where("a IS NULL").select("m", "k", *held_names)
    if large.isEmpty():
        return found.distinct()
    cut = F.ceil(F.col("n") * 2 / F.lit(block)).cast("int")
    sized = large.join(large.groupBy("m", "k").agg(F.count(F.lit(1)).alias("n")), ["m", "k"]).withColumn("blocks", cut).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    pairs = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("m", "k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *held_names)
    again = pairs.repartition("m", "k", "i", "j").sortWithinPartitions("m", "k", "i", "j", "fp").mapInArrow(lambda b: spans(b, 4, 1 << 62), pair_schema)
    return found.unionByName(again.select("a", "b")).distinct()


# ------------------------------------------------------------------ components

def components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) of every node of the links (a, b): root is the smallest node of its component.

    Stars are grown in rounds: every node points its larger neighbours at its smallest one, then its smaller ones. The rounds needed grow with the
    logarithm of the longest path. Each round is written to the shared folder; only a count and a checksum reach the driver.
    """

    def larger(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").distinct()

    def smaller(e: DataFrame) -> DataFrame:
        least = e.groupBy("b").agg(F.min("a").alias("m"))
        joined = e.join(least, "b")
        return joined.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(joined.select(F.col("m").alias("a"), "b")).distinct()

    now, mark = stored(edges.where("a < b").distinct()), None
    for _ in range(most_rounds):
        now = stored(smaller(larger(now)))
        new = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError("components did not settle")
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3, parts: int = 1, block: int = BLOCK, words: int = 1, reach: int | None = None) -> DataFrame:
    """(id, fp, component_id) of each row of ``docs``."""
    names = word_names(words)
    printed = stored(fingerprints(docs, doc_id, text, shingle, words))
    distinct = stored(printed.groupBy("fp").agg(F.min("id").alias("least"), *[F.min(c).alias(c) for c in names]))
    roots = components(links(distinct.select("fp", *names), radius, parts, block, words, reach))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = joined.join(named, "root").select("fp", "component_id")
    return printed.join(by_print, "fp").select("id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
