"""Alignment of two tokenizers: which tokens of the one stand where which tokens of the other stand, and how usual each such pair is in the corpus.

Tokenizer A is a byte-level BPE (JSON file), B a piece model with byte fallback. Both encode a blank and the text; B adds that blank itself. The bytes of a
text at which a token of A and one of B both end cut both token rows into groups; every token of A in a group is linked to every token of B in it. The count
of a pair of token ids is the number of documents that hold it linked.

Exact-text deduplication: documents are grouped by their full text in one shuffle (copies combine on the map side), each distinct text is tokenised and
aligned once, and its pairs count as often as the text occurs. What was found is written to the shared folder as Parquet, so that it survives lost executors
and is not tokenised again. Pairs in more than 1 of every 2^18 (text, pair) rows are at most 2^18, so their counts are sent to the tasks; the others are
joined, and none of them has more rows than that share. Measures go back to the documents by the text's SHA-256: those of the at most 4,096 texts that more
than 1 document in 4,096 has are sent, the others are joined, so neither join has a hot key.

NULL and empty texts, and texts whose tokens of A or of B do not give the bytes of blank and text, have no tokens: all numbers 0, the hash empty. Special
tokens are plain text. A NULL id is kept. Repeated rows count as documents of their own and get equal results; an empty table gives an empty one; other
columns are never looked at.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relfold.llm.bpe import gather
from relfold.llm.common import checkpoint_dir, values

BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
# How files of kind A cut a text before merging (a fixed value of that kind, whose files name it by a flag only).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Shares above which a pair or a text is sent rather than joined; the inverse bounds how many are.
PAIR_SHARE, TEXT_SHARE = 1 << 18, 1 << 12
# Above this many links in a group its ids are counted before they are paired.
WIDE_GROUP = 256
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
NO_TOKENS = dict.fromkeys(MEASURES[:4], 0) | {"groups_sha256": ""} | dict.fromkeys(("pairs", "links"), np.empty(0, np.int64))


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in files of kind A: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def table_of(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens in a row, and the offset of each."""
    return np.frombuffer(b"".join(tokens), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in tokens], dtype=np.int64))).astype(np.int64)


def read_ranks(path: str = BYTE_LEVEL) -> dict[bytes, int]:
    """Token bytes and ids of a file of kind A, in which ids follow the order of merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cut = spec["pre_tokenizer"] or {}
    vocab, letters = spec["model"]["vocab"], byte_letters()
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    if spec["normalizer"] or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or merged != sorted(merged):
        raise ValueError(f"{path}: not a byte-level vocabulary of the kind this reads")
    special = {t["content"] for t in spec["added_tokens"]}
    return {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}


class Aligner:
    """Both tokenizers with the tables that aligning needs."""

    def __init__(self, ranks: dict[bytes, int], model: bytes):
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            tokens[i] = t
        ids = range(self.b.get_piece_size())
        pieces = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode() for i in ids]
        self.table_a, self.table_b = table_of(tokens), table_of(pieces)
        # ids as text with what follows them: A inside a group and at its end, B inside and at its end
        marks = ((len(tokens), ","), (len(tokens), "|"), (len(pieces), ","), (len(pieces), ";"))
        self.written = [f"{i}{mark}" for size, mark in marks for i in range(size)]
        self.start = np.cumsum([0, *[size for size, _ in marks]])

    def align(self, text: str) -> dict | None:
        """Counts, the written groups' hash, and the distinct pairs (A id << 32 | B id) with their links; None for a text without tokens."""
        raw = b" " + text.encode()
        ids = [np.array(x, np.int64) for x in (self.a.encode_ordinary(" " + text), self.b.encode(text))]
        sizes = [offsets[i + 1] - offsets[i] for i, (_, offsets) in zip(ids, (self.table_a, self.table_b), strict=True)]
        if not text or any(x.sum() != len(raw) or gather(*table, i) != raw for x, i, table in zip(sizes, ids, (self.table_a, self.table_b), strict=True)):
            return None
        ends = [np.cumsum(x) for x in sizes]
        common = np.intersect1d(*ends, assume_unique=True)
        group = [np.searchsorted(common, x) for x in ends]
        pairs, links = self.pairs(ids, group, len(common))
        return {"n_a": len(ids[0]), "n_b": len(ids[1]), "n_groups": len(common), "n_links": int(links.sum()), "groups_sha256": self.groups_hash(ids, ends, common), "pairs": pairs, "links": links}

    def pairs(self, ids: list[np.ndarray], group: list[np.ndarray], groups: int) -> tuple[np.ndarray, np.ndarray]:
        first, (n_a, n_b) = np.searchsorted(group[1], np.arange(groups)), (np.bincount(g, minlength=groups) for g in group)
        wide = n_a * n_b > WIDE_GROUP
        narrow = ~wide[group[0]]
        times = n_b[group[0][narrow]]
        left = np.repeat(ids[0][narrow], times)
        within = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        right = ids[1][np.repeat(first[group[0][narrow]], times) + within]
        found, counts = np.unique(left << 32 | right, return_counts=True)
        if not wide.any():
            return found, counts
        every, numbers = [found], [counts]
        for g in np.flatnonzero(wide):
            (a, x), (b, y) = (np.unique(i[np.searchsorted(of, g) : np.searchsorted(of, g + 1)], return_counts=True) for i, of in zip(ids, group, strict=True))
            every.append((a[:, None] << 32 | b).ravel())
            numbers.append((x[:, None] * y).ravel())
        found, place = np.unique(np.concatenate(every), return_inverse=True)
        counts = np.zeros(len(found), np.int64)
        np.add.at(counts, place, np.concatenate(numbers))
        return found, counts

    def groups_hash(self, ids: list[np.ndarray], ends: list[np.ndarray], common: np.ndarray) -> str:
        """SHA-256 of the groups written as ``a1,a2|b1;a3|b2,b3``."""
        closes = [np.isin(e, common, assume_unique=True) for e in ends]
        codes = np.concatenate([i + self.start[2 * k + c] for k, (i, c) in enumerate(zip(ids, (x.astype(np.int64) for x in closes), strict=True))])
        group = np.concatenate([np.searchsorted(common, e) for e in ends])
        order = np.argsort(group, kind="stable")  # A comes before B, so each group's tokens of A before those of B
        text = "".join(map(self.written.__getitem__, codes[order].tolist()))
        return hashlib.sha256(text[:-1].encode()).hexdigest()


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder as Parquet and read again; stretches of numbers pack far better there than in a checkpoint."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/crosstoken-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def aligned_texts(texts: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """(key, copies, counts, groups_sha256, pairs, links) of every distinct text, from rows of (t, copies, key)."""
    spark: SparkSession = texts.sparkSession
    with open(model, "rb") as file:
        sent = spark.sparkContext.broadcast((read_ranks(vocabulary), file.read()))  # both of the vocabularies' size

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*sent.value)
        for batch in batches:
            rows = [(key, copies, aligner.align(t) or NO_TOKENS) for t, copies, key in zip(*map(values, batch.columns), strict=True)]
            if not rows:
                continue
            numbers = [pa.array([r[2][m] for r in rows], pa.int64()) for m in MEASURES[:4]]
            ends = pa.array(np.cumsum([0, *[len(r[2]["pairs"]) for r in rows]]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([r[2][m] for r in rows]))) for m in ("pairs", "links")]
            keys, copies = pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64())
            hashes = pa.array([r[2]["groups_sha256"] for r in rows], pa.string())
            yield pa.RecordBatch.from_arrays([keys, copies, *numbers, hashes, *lists], ["key", "copies", *MEASURES[:4], "groups_sha256", "pairs", "links"])

    kinds = ", ".join(f"{m} long" for m in MEASURES[:4])
    return texts.mapInArrow(aligned, f"key binary, copies long, {kinds}, groups_sha256 string, pairs array<long>, links array<long>")


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, rows, count, is_best): texts and documents that hold the pair linked, and whether no pair of its A id has a higher count."""
    pairs = found.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("count"))
    of_a = W.partitionBy(F.shiftright("pair", 32))
    return pairs.withColumn("is_best", F.col("count") == F.max("count").over(of_a))


def align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = BYTE_LEVEL, model: str = PIECES) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    key = F.unhex(F.sha2(F.col("t").cast("binary"), 256))
    texts = rows.where("t <> ''").groupBy("t").agg(F.count(F.lit(1)).alias("copies")).withColumn("key", key)
    found = kept(aligned_texts(texts.select("t", "copies", "key"), vocabulary, model), "texts")
    counts = kept(pair_counts(found), "pairs")

    # measures of each text: pairs that are sent, and pairs that are joined
    bound = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first()["n"] / PAIR_SHARE
    exploded = found.select("key", F.explode(F.arrays_zip("pairs", "links")).alias("p")).select("key", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links"))
    usual = F.broadcast(counts.where(F.col("rows") > bound).select("pair", "count", "is_best"))
    rare = counts.where(F.col("rows") <= bound).select("pair", "count", "is_best")
    sums = [F.sum(F.when(F.col("is_best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("count")).alias("count_sum")]
    parts = [exploded.join(usual, "pair"), exploded.join(usual.select("pair"), "pair", "left_anti").join(rare, "pair")]
    summed = parts[0].groupBy("key").agg(*sums).unionByName(parts[1].groupBy("key").agg(*sums)).groupBy("key").agg(*[F.sum(m).alias(m) for m in MEASURES[4:]])
    whole = kept(found.drop("pairs", "links").join(summed, "key", "left").select("key", "copies", *MEASURES, "groups_sha256"), "measures")

    # back to the documents
    total = F.col("copies") > whole.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"] / TEXT_SHARE
    usual_texts, rare_texts = (whole.where(c).drop("copies") for c in (total, ~total))
    keyed = rows.select("id", F.when(F.col("t") != "", key).alias("key"))
    with_text = keyed.where("key IS NOT NULL")
    sent_keys = F.broadcast(usual_texts)
    done = with_text.join(sent_keys, "key").unionByName(with_text.join(sent_keys.select("key"), "key", "left_anti").join(rare_texts, "key"))
    empty = keyed.where("key IS NULL").select("key", "id", *[F.lit(None).cast("long").alias(m) for m in MEASURES], F.lit(None).cast("string").alias("groups_sha256"))
    zero = [F.coalesce(m, F.lit(0)).cast("long").alias(m) for m in MEASURES]
    return done.unionByName(empty).select("id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
