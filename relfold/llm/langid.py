"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram is the product of its letters' vectors, each shifted once per place; a text is the sum of its
n-grams' vectors; a language is the sum of its texts. A text gets the language whose prototype is nearest by cosine.

Letters are lower-cased; everything that is no letter counts as one blank, which also bounds the words. NULL texts and texts without a letter get
``und`` and score 0, as does every text when nothing could be learned. Equal cosines go to the smaller language name. Rows are judged one by one, so
repeated rows get equal results; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfold.llm.common import id_schema, out_batch, values

DIM, SIZE, SEED = 512, 3, 20240607
# A language column has at most this many values; prototypes (4 KB each) are carried to all tasks, so their size is bounded by it.
MAX_LANGUAGES = 4096
# n-gram vectors that a task keeps at once (2 KB each).
KEPT_GRAMS = 16384


def letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str, letters: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (code points packed in 21 bits each) and their counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = letters[codes]
    if not is_letter.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.where(is_letter, codes, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # one blank after each word
    codes = np.concatenate(([32], codes[keep], [32] if is_letter[-1] else [])).astype(np.uint64)
    grams = np.zeros(max(len(codes) - size + 1, 0), np.uint64)
    for k in range(size):
        grams = grams << np.uint64(21) | codes[k : len(codes) - size + 1 + k]
    return np.unique(grams, return_counts=True)


class GramVectors:
    """Vectors of n-grams, made when first asked for; at most KEPT_GRAMS are kept."""

    def __init__(self, dim: int = DIM, size: int = SIZE, seed: int = SEED):
        self.dim, self.size, self.seed = dim, size, seed
        self.letters: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        self.place: dict[int, int] = {}
        self.rows = np.empty((256, self.dim), np.float32)

    def letter(self, code: int) -> np.ndarray:
        found = self.letters.get(code)
        if found is None:
            bits = np.random.default_rng([self.seed, code]).integers(0, 2, self.dim, dtype=np.int8)
            found = self.letters[code] = (2 * bits - 1).astype(np.float32)
        return found

    def gram(self, gram: int) -> np.ndarray:
        out = np.ones(self.dim, np.float32)
        for shift in range(self.size):
            out *= np.roll(self.letter(gram >> 21 * shift & 0x1FFFFF), shift)
        return out

    def bundle(self, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the n-grams' vectors, each as often as it occurs."""
        total = np.zeros(self.dim, np.float64)
        for at in range(0, len(grams), 4096):
            part = grams[at : at + 4096].tolist()
            if len(self.place) + len(part) > KEPT_GRAMS:
                self.clear()
            for g in part:
                if g not in self.place:
                    if len(self.place) == len(self.rows):
                        self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
                    self.rows[len(self.place)] = self.gram(g)
                    self.place[g] = len(self.place)
            index = np.fromiter((self.place[g] for g in part), np.int64, len(part))
            share = counts[at : at + 4096]
            # sums below 2^24 are exact in single precision
            kind = np.float32 if share.sum() < 1 << 24 else np.float64
            total += share.astype(kind) @ self.rows[index].astype(kind, copy=False)
        return total


def learn_prototypes(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototype of each language in ``docs``; rows with a NULL text or language teach nothing.

    Tasks send one vector per language; sums are of whole numbers, so their order does not show. What reaches the driver is bounded by MAX_LANGUAGES.
    """

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, vectors = letter_table(), GramVectors()
        waiting: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(name: str) -> tuple[np.ndarray, np.ndarray]:
            grams = np.concatenate([g for g, _ in waiting[name]])
            counts = np.concatenate([c for _, c in waiting[name]])
            known, place = np.unique(grams, return_inverse=True)
            return known, np.bincount(place, weights=counts, minlength=len(known)).astype(np.int64)

        def sent(names: list[str]) -> Iterator[pa.RecordBatch]:
            for name in names:
                vector = vectors.bundle(*merged(name)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * DIM, pa.string()), pa.array(np.arange(DIM), pa.int32()), pa.array(vector)], ["lang", "place", "value"])
            waiting.clear()

        for batch in batches:
            for t, name in zip(values(batch.column(0)), values(batch.column(1)), strict=True):
                found = gram_counts(t, letters)
                if len(found[0]):
                    waiting.setdefault(name, []).append(found)
                    if len(waiting[name]) == 256:
                        waiting[name] = [merged(name)]
            if len(waiting) > 256:
                yield from sent(list(waiting))
        yield from sent(list(waiting))

    known = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).where("t IS NOT NULL AND l IS NOT NULL")
    sums = known.mapInArrow(bundles, "lang string, place int, value long").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array([x["value"] for x in r["v"]], np.float64) for r in sorted(rows, key=lambda r: r["lang"])}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score) of each row of ``docs``; the score is the cosine to the prototype, negative ones as 0."""
    names = sorted(prototypes)
    known = docs.sparkSession.sparkContext.broadcast(np.array([prototypes[n] / (np.linalg.norm(prototypes[n]) or 1.0) for n in names]).reshape(len(names), DIM))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, vectors, targets = letter_table(), GramVectors(), known.value
        for batch in batches:
            best, score = [], []
            for t in values(batch.column(1)):
                grams, counts = gram_counts(t or "", letters)
                vector = vectors.bundle(grams, counts)
                norm = np.linalg.norm(vector)
                if not len(grams) or not names or not norm:
                    best.append("und")
                    score.append(0.0)
                    continue
                near = targets @ (vector / norm)
                best.append(names[int(near.argmax())])
                score.append(float(min(1.0, max(0.0, near.max()))))
            yield out_batch(batch.column(0), {"lang_pred": pa.array(best, pa.string()), "score": pa.array(score, pa.float64())})

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    return rows.mapInArrow(judged, id_schema(docs, doc_id, "lang_pred string, score double"))
