"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ in k edits. It is cut into k + 1 pieces; k edits leave one piece whole, so every occurrence within k edits holds an
exact piece. Pieces of all items are searched at once (Aho-Corasick), and each hit is verified around its place with Myers' bit-parallel distance.

Items and texts are compared in lower case with runs of white space as one blank. NULL texts and items match nothing, nor do items of fewer than
``MIN_CHARS`` characters: they are no evidence. Repeated items and rows are each reported; an item matches a row once, by its best place (fewest edits,
then first). Spans count characters of the normalised text. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfold.llm.common import stored, values

# Edits allowed for each character of an item, and the shortest item worth searching.
EDIT_RATE, MIN_CHARS = 0.05, 8
# Items are searched in blocks of about this many characters, so that what a task holds stays bounded for any benchmark.
BLOCK_CHARS = 4_000_000


def normalised(text: str) -> str:
    return " ".join(text.lower().split())


def budget(length: int, rate: float = EDIT_RATE) -> int:
    return int(length * rate)


def cut(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of nearly equal length, with their places."""
    ends = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def character_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_end(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Fewest edits between the pattern and any stretch of the text, and where the first such stretch ends (Myers, one word of m bits)."""
    full, top = (1 << m) - 1, 1 << m - 1
    up, down, score = full, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        diag = ((eq & up) + up ^ up) | eq | down
        plus = down | ~(diag | up) & full
        minus = up & diag
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = plus << 1 & full, minus << 1 & full
        up = minus | ~(diag | plus) & full
        down = plus & diag
        if score < best:
            best, end = score, at
    return best, end


class Searcher:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(number, text, budget(len(text), rate)) for number, text in items]
        self.forward = [character_masks(t) for _, t, _ in self.items]
        self.automaton = ahocorasick.Automaton()
        for i, (_, text, k) in enumerate(self.items):
            for place, piece in cut(text, k):
                if piece not in self.automaton:
                    self.automaton.add_word(piece, (len(piece), []))
                self.automaton.get(piece)[1].append((i, place))
        if self.items:
            self.automaton.make_automaton()

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, start, end) of each item found in a normalised text, once, at its best place."""
        if not self.items or not text:
            return
        looked: set[tuple[int, int]] = set()
        best: dict[int, tuple[int, int, int]] = {}
        for last, (size, owners) in self.automaton.iter(text):
            for i, place in owners:
                _, item, k = self.items[i]
                origin = last + 1 - size - place
                width = k + 1
                if (i, origin // width) in looked:
                    continue
                looked.add((i, origin // width))
                # the window holds every occurrence whose origin is in the same stretch of ``width`` places
                low = max(0, origin // width * width - k)
                high = origin // width * width + width + len(item) + k
                found, end = best_end(self.forward[i], len(item), text[low:high])
                if found <= k:
                    backward, back = best_end(character_masks(item[::-1]), len(item), text[low : low + end][::-1])
                    one = (found, low + end - back, low + end)
                    best[i] = min(best.get(i, one), one)
        for i, (found, start, end) in sorted(best.items()):
            yield i, found, start, end


def item_blocks(items: DataFrame, item_id: str, text: str, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The normalised items in blocks of bounded size; a block's rows reach the driver and no more."""
    own = stored(items.select(F.col(item_id).alias("item"), F.col(text).alias("t")).where(F.col("t").isNotNull()))
    total = own.agg(F.sum(F.length("t"))).first()[0] or 0
    n = total // block_chars + 1
    for block in range(n):
        rows = own.where(F.pmod(F.xxhash64("item", "t"), F.lit(n)) == block).collect()
        kept = [(r["item"], s) for r in rows if len(s := normalised(r["t"])) >= MIN_CHARS]
        if kept:
            yield sorted(kept, key=lambda x: (x[0] is None, x[0] if x[0] is not None else 0, x[1]))


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item, distance, start, end) for each row of ``docs`` and each item that it holds within the error budget."""
    id_type, item_type = docs.schema[doc_id].dataType, items.schema[item_id].dataType
    schema = f"id {id_type.simpleString()}, item {item_type.simpleString()}, distance int, start int, end int"
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).where(F.col("t").isNotNull())

    def searched(block: list[tuple]) -> DataFrame:
        sent = docs.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_CHARS characters and one item more

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = None
            for batch in batches:
                searcher = searcher or Searcher(sent.value, rate)
                at, out = [], []
                for n, t in enumerate(values(batch.column(1))):
                    for match in searcher.matches(normalised(t)):
                        at.append(n)
                        out.append(match)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at, pa.int64())), pa.array([searcher.items[m[0]][0] for m in out], kind), *[pa.array([m[j] for m in out], pa.int32()) for j in (1, 2, 3)]],
                    ["id", "item", "distance", "start", "end"],
                )

        kind = pa.string() if item_type.simpleString() == "string" else pa.int32() if item_type.simpleString() == "int" else pa.int64()
        return rows.mapInArrow(found, schema)

    parts = [searched(block) for block in item_blocks(items, item_id, item_text, block_chars)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their own columns; NULL texts hold none. Decided row by row, without a join."""
    kept = docs
    names = docs.columns
    place = names.index(text)
    for block in item_blocks(items, item_id, item_text, block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            searcher = None
            for batch in batches:
                searcher = searcher or Searcher(sent.value, rate)
                good = [t is None or next(searcher.matches(normalised(t)), None) is None for t in values(batch.column(place))]
                yield batch.filter(pa.array(good, pa.bool_()))

        kept = kept.mapInArrow(clean, docs.schema)
    return kept
