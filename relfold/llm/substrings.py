"""Substring dedup by fixed-block anchors: passages that an earlier document has too.

Every passage of ``window`` words that also starts in a document with a smaller id is a repeat; overlapping repeats make one maximal span.

Blocks of ``BLOCK`` words are indexed at fixed places of each text, and probed at fixed places. The places are those whose number modulo ``PERIOD`` is in
a perfect difference set, so two equal passages of 50 words share a block that is indexed in both, wherever they start (this thins an index of
non-overlapping blocks probed by every rolling window: a fifth of the words instead of all travel). A block seen in two documents is an anchor. The passages
around anchors are extended: each window near an anchor is compared, by a 96-bit hash of its words, with all others of its kind.

Blocks and windows are aggregated in each batch before they are sent, so a passage that very many documents share sends a row for each batch, not for
each document. Documents whose whole word sequence an earlier one has are settled by one hash and take no part.

Words are runs of other than ASCII blanks, compared unchanged. A NULL text has no words. A NULL id is neither smaller nor larger than others: such rows keep
all words and give no source. Rows that share an id do not remove each other's words. Ids are whole numbers. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfold.llm.common import raw_texts, stored

WINDOW = 50
# {0, 1, 3, 8, 12, 18} is a perfect difference set modulo 31: each difference occurs once.
PERIOD, PLACES = 31, (0, 1, 3, 8, 12, 18)
CHUNK = 1 << 15
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


class Roller:
    """Hashes of runs of words by prefix sums of a polynomial over their bytes, modulo 2^64."""

    def __init__(self, multiplier: int):
        self.multiplier, self.inverse = multiplier, pow(multiplier, -1, 1 << 64)
        self.grow(1 << 16)

    def grow(self, n: int) -> None:
        def series(m: int) -> np.ndarray:
            factors = np.full(n, m, np.uint64)
            factors[0] = 1
            return np.multiply.accumulate(factors)

        self.powers, self.inverses = series(self.multiplier), series(self.inverse)

    def hashes(self, found: list[bytes], lengths: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each place in ``at`` (ascending)."""
        out = np.empty(len(at), np.uint64)
        cuts = np.searchsorted(at, np.arange(0, len(found) + CHUNK, CHUNK))
        for k in range(len(cuts) - 1):
            mine = at[cuts[k] : cuts[k + 1]] - k * CHUNK
            if len(mine):
                part = slice(k * CHUNK, (k + 1) * CHUNK + size)
                data = np.frombuffer(b" ".join(found[part]) + b" ", np.uint8)
                if len(data) > len(self.powers):
                    self.grow(2 * len(data))
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], dtype=np.uint64)))
                ends = np.cumsum(lengths[part] + 1)
                starts = ends - lengths[part] - 1
                first, last = starts[mine], ends[mine + size - 1] - 1
                out[cuts[k] : cuts[k + 1]] = (sums[last] - sums[first]) * self.inverses[first]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xFF51AFD7ED558CCD)
        return out ^ (out >> np.uint64(29))


def split(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """Words for hashing and their lengths; very long words stand by their digest."""
    found = text.split()
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    if len(found) and lengths.max() > 64:
        found = [w if len(w) <= 64 else b"\0" + xxhash.xxh128_digest(w) for w in found]
        lengths = np.minimum(lengths, 17) * (lengths > 64) + lengths * (lengths <= 64)
    return found, lengths


def fixed_places(n: int, block: int) -> np.ndarray:
    """Places of the indexed blocks in a text of n words."""
    places = (np.arange(0, max(n, 0), PERIOD)[:, None] + np.array(PLACES)).ravel()
    return places[places <= n - block]


def twin(text: bytes) -> int:
    """Tells rows apart that share an id."""
    return xxhash.xxh32_intdigest(text) - (1 << 31)


def summaries(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, tw, n_words, sha) of each row: sha is the SHA-256 of the words, joined by one space."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tws, counts, shas = [], [], []
            for t in raw_texts(batch.column(1)):
                found = t.split()
                tws.append(twin(t))
                counts.append(len(found))
                shas.append(hashlib.sha256(b" ".join(found)).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tws, pa.int32()), pa.array(counts, pa.int64()), pa.array(shas, pa.binary())], ["id", "tw", "n_words", "sha"])

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).mapInArrow(summed, "id long, tw int, n_words long, sha binary")


def groups_of(columns: list[np.ndarray]) -> np.ndarray:
    """Start of each run of equal rows."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1))


def anchors(docs: DataFrame, doc_id: str, text: str, window: int) -> DataFrame:
    """(id, tw, place) of every indexed block that a document with another id has too."""
    block = window - PERIOD + 1

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(MULTIPLIERS[0])
        for batch in batches:
            ids, tws, places, hashes = [], [], [], []
            for i, t in zip(np.asarray(batch.column(0)), raw_texts(batch.column(1)), strict=True):
                found, lengths = split(t)
                if len(found) >= window:
                    at = fixed_places(len(found), block)
                    hashes.append(roller.hashes(found, lengths, at, block).view(np.int64))
                    places.append(at)
                    ids.append(np.full(len(at), i))
                    tws.append(np.full(len(at), twin(t), np.int32))
            if not ids:
                continue
            h, i, tw, p = (np.concatenate(x) for x in (hashes, ids, tws, places))
            order = np.lexsort((i, h))
            h, i, tw, p = h[order], i[order], tw[order], p[order]
            starts = groups_of([h])
            ends = np.append(starts[1:], len(h))
            shared = np.repeat(i[starts] != i[ends - 1], ends - starts)
            first = np.zeros(len(h), bool)
            first[starts] = True
            # known here to be shared: one of them speaks for the batch, and all are anchors whatever the others say
            known = shared & ~first
            flag = np.where(known, 2, np.where(shared, 1, 0)).astype(np.int8)
            h = np.where(known, i * np.int64(-7046029254386353131) ^ p, h)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(flag), pa.array(i), pa.array(tw), pa.array(p.astype(np.int32))], ["h", "flag", "id", "tw", "place"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by hash and id. Those of a group's first id wait until a second id is seen; all others pass."""
        waiting: list[tuple[np.ndarray, ...]] = []
        group = owner = None
        shared = False

        def sent(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "tw", "place"])

        for batch in batches:
            h, flag, i, tw, p = (np.asarray(c) for c in batch.columns)
            done = flag == 2
            if done.any():
                yield sent((i[done], tw[done], p[done]))
                h, flag, i, tw, p = (c[~done] for c in (h, flag, i, tw, p))
            starts = groups_of([h]) if len(h) else np.empty(0, np.int64)
            if not len(starts):
                continue
            ends = np.append(starts[1:], len(h))
            multi = (i[starts] != i[ends - 1]) | (np.maximum.reduceat(flag, starts) == 1)
            keep = np.repeat(multi, ends - starts)
            # the first group may go on from the last batch, and the last group may go on in the next
            if h[0] == group:
                part = slice(0, int(ends[0]))
                now = shared or bool(multi[0]) or bool(i[0] != owner)
                if now:
                    for w in waiting:
                        yield sent(w)
                    waiting = []
                    keep[part] = True
                else:
                    waiting.append((i[part].copy(), tw[part].copy(), p[part].copy()))
                shared = now
            if h[-1] != group:
                group, owner, shared, waiting = h[-1], i[starts[-1]], bool(multi[-1]), []
                if not shared:
                    part = slice(int(starts[-1]), len(h))
                    waiting.append((i[part].copy(), tw[part].copy(), p[part].copy()))
            if keep.any():
                yield sent((i[keep], tw[keep], p[keep]))

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).where("id IS NOT NULL AND t IS NOT NULL")
    sent = rows.mapInArrow(indexed, "h long, flag byte, id long, tw int, place int")
    return sent.repartition("h").sortWithinPartitions("h", "id").mapInArrow(met, "id long, tw int, place int")


def repeated_windows(texts: DataFrame, window: int) -> DataFrame:
    """(id, tw, place) of every window near an anchor that a document with a smaller id has too; ``texts`` has id, tw, t and the anchors' places."""

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = [Roller(m) for m in MULTIPLIERS]
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, tw, t, places in zip(np.asarray(batch.column(0)), np.asarray(batch.column(1)), raw_texts(batch.column(2)), batch.column(3), strict=True):
                found, lengths = split(t)
                at = (np.asarray(places.values)[:, None] - np.arange(PERIOD)).ravel()
                at = np.unique(at[(at >= 0) & (at <= len(found) - window)])
                h, g = (r.hashes(found, lengths, at, window) for r in rollers)
                for column, v in zip(out, (h.view(np.int64), (g >> np.uint64(32)).astype(np.uint32).view(np.int32), np.full(len(at), i), np.full(len(at), tw, np.int32), at.astype(np.int32)), strict=True):
                    column.append(v)
            if not out[0]:
                continue
            h, g, i, tw, p = (np.concatenate(c) for c in out)
            order = np.lexsort((i, g, h))
            h, g, i, tw, p = (c[order] for c in (h, g, i, tw, p))
            starts = groups_of([h, g])
            known = i > np.repeat(i[starts], np.diff(np.append(starts, len(h)))) if len(h) else np.empty(0, bool)
            h = np.where(known, i * np.int64(-7046029254386353131) ^ p, h)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), pa.array(known), pa.array(i), pa.array(tw), pa.array(p)], ["h", "g", "known", "id", "tw", "place"])

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by hash and id: in each group those beyond its first id are repeats."""
        group, least = None, 0
        for batch in batches:
            h, g, known, i, tw, p = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            own = np.flatnonzero(~known)
            repeat = known.copy()
            if len(own):
                starts = groups_of([h[own], g[own]])
                first = i[own][starts].copy()
                if (h[own[0]], g[own[0]]) == group:
                    first[0] = least
                repeat[own] = i[own] > np.repeat(first, np.diff(np.append(starts, len(own))))
                group, least = (h[own[-1]], g[own[-1]]), first[-1]
            if repeat.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[repeat]) for c in (i, tw, p)], ["id", "tw", "place"])

    sent = texts.select("id", "tw", "t", "places").mapInArrow(near, "h long, g int, known boolean, id long, tw int, place int")
    return sent.repartition("h", "g").sortWithinPartitions("h", "g", "id").mapInArrow(later, "id long, tw int, place int")


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, spans) of each row; spans are the maximal repeats as (first word, end word), the end not included."""
    whole = stored(summaries(docs, doc_id, text))
    own = whole.where("id IS NOT NULL").withColumn("long", F.col("n_words") >= window)
    least = own.where("long").groupBy("sha").agg(F.min("id").alias("least"))
    copies = stored(own.where("long").join(least, "sha").where("id > least").select("id", "tw").distinct())
    hits = stored(anchors(docs, doc_id, text, window).join(copies, ["id", "tw"], "left_anti").groupBy("id", "tw").agg(F.collect_set("place").alias("places")))

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tws = pa.array((twin(t) for t in raw_texts(batch.column(1))), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), tws, batch.column(1)], ["id", "tw", "t"])

    named = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t")).where("id IS NOT NULL AND t IS NOT NULL").mapInArrow(tagged, "id long, tw int, t string")
    near = stored(named.join(hits, ["id", "tw"]).dropDuplicates(["id", "tw"]))
    starts = repeated_windows(near, window).groupBy("id", "tw").agg(F.sort_array(F.collect_set("place")).alias("starts"))

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shas, spans = [], [], []
            for t, at in zip(raw_texts(batch.column(2)), batch.column(3), strict=True):
                found = t.split()
                begin = np.asarray(at.values)
                cuts = np.flatnonzero(np.diff(begin) > window)
                first, last = begin[np.concatenate(([0], cuts + 1))], begin[np.concatenate((cuts, [len(begin) - 1]))] + window
                kept, end = [], 0
                for a, b in zip(first.tolist(), last.tolist(), strict=True):
                    kept += found[end:a]
                    end = b
                kept += found[end:]
                counts.append(len(found) - len(kept))
                shas.append(hashlib.sha256(b" ".join(kept)).digest())
                spans.append([{"first": a, "end": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)])
            kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(shas, pa.binary()), pa.array(spans, kind)], ["id", "tw", "gone", "rest", "spans"])

    cut = near.select("id", "tw", "t").join(starts, ["id", "tw"]).mapInArrow(removed, "id long, tw int, gone long, rest binary, spans array<struct<first:int,end:int>>")
    out = whole.join(cut, ["id", "tw"], "left").join(copies.withColumn("copy", F.lit(True)), ["id", "tw"], "left")
    every = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("end")))
    return out.select(
        "id", "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).alias("n_removed"),
        F.when(F.col("copy"), F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.lower(F.hex(F.coalesce("rest", "sha")))).alias("kept_sha256"),
        F.when(F.col("copy"), every).otherwise(F.coalesce("spans", F.array().cast("array<struct<first:int,end:int>>"))).alias("spans"),
    )
