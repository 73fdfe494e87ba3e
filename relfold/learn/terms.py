"""Term counts per entity and low-dimensional embeddings of them.

Everything starts from (id, idx, n) rows counted on the map side and stored once; a document is never put together as text. The three factorings are
iterations over those rows: each step is joins and sums of k columns, its result is stored, and only k or k x k numbers reach the driver. (The topic model is
Spark's own, which keeps its k x vocabulary table on the driver.) Terms that a large part of all ids have are sent to the tasks, where their number is
bounded; the others are joined, so no task gets the rows of a hot term.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relfold.operators.encode import sparse_vector
from relfold.operators.hotkeys import join_counted, spread
from relfold.operators.ordered import with_position
from relfold.sources.store import stored

# fixed pattern: runs of letters, digits and underscores in any script
TERM = r"([\p{L}\p{N}_]+)"
# fixed weights of the penalties on sums and on squares of non-negative factors
L1, L2 = 0.05, 0.05
# smallest value that an estimate is divided by
TINY = 1e-12


def raw_term_counts(df: DataFrame, key: str, token: str) -> DataFrame:
    """(id, term, n) over the lower-cased terms of a text or category column."""
    words = F.explode(F.regexp_extract_all(F.lower(F.col(token).cast("string")), F.lit(TERM), F.lit(1)))
    rows = spread(df.select(key, token).where(F.col(key).isNotNull()))
    return rows.select(key, words.alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def document_frequency(counts: DataFrame, min_df: int = 2) -> DataFrame:
    """(term, documents) of the terms found in at least min_df documents."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") >= min_df)


def term_counts(df: DataFrame, key: str, token: str, min_df: int = 2) -> DataFrame:
    """(id, term, n) for the terms that at least ``min_df`` ids have. The counts are stored once and serve both the frequency and the result."""
    counts = stored(raw_term_counts(df, key, token), "terms")
    return join_counted(counts, stored(document_frequency(counts, min_df), "frequency"), "term", "documents").select(key, "term", "n")


def number_terms(frequency: DataFrame) -> DataFrame:
    """(term, idx, documents): the terms numbered from 0 in alphabetical order."""
    numbered = with_position(frequency.withColumn("_all", F.lit(0)), "_all", "term", "idx")
    return stored(numbered.select("term", (F.col("idx") - 1).cast("int").alias("idx"), "documents"), "vocabulary")


def vocabulary(df: DataFrame, key: str, token: str, min_df: int = 2) -> DataFrame:
    """(term, idx, documents): the terms of the fitting corpus that at least ``min_df`` ids have."""
    return number_terms(document_frequency(raw_term_counts(df, key, token), min_df))


@dataclass(frozen=True)
class Corpus:
    """Stored counts (id, idx, n), the number of ids of each term (idx, documents), and the size of the vocabulary they are numbered by."""

    counts: DataFrame
    terms: DataFrame
    key: str
    size: int


def corpus(df: DataFrame, key: str, token: str, vocab: DataFrame | None = None, min_df: int = 2) -> tuple[Corpus, DataFrame]:
    """The counts of a corpus and its vocabulary: a fitted one (other terms are left out), or its own. One scan of the text."""
    raw = stored(raw_term_counts(df, key, token), "terms")
    own = document_frequency(raw, 1 if vocab is not None else min_df)
    vocab = number_terms(own) if vocab is None else vocab
    here = own.join(vocab.select("term", "idx"), "term").select("term", "idx", "documents")
    counts = stored(join_counted(raw, stored(here, "here"), "term", "documents").select(key, "idx", "n"), "counts")
    terms = stored(counts.groupBy("idx").agg(F.count(F.lit(1)).alias("documents")), "frequency")
    return Corpus(counts, terms, key, vocab.count()), vocab


def indexed_counts(df: DataFrame, key: str, token: str, vocab: DataFrame) -> DataFrame:
    """(id, idx, n) with the numbers of an already fitted vocabulary; other terms are left out."""
    return corpus(df, key, token, vocab)[0].counts


def to_vectors(counts: DataFrame, key: str, size: int) -> DataFrame:
    """(id, features): one sparse vector per id, stored; it has at most ``size`` entries."""
    pairs = counts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("idx", "n"))).alias("_pairs"))
    return stored(pairs.select(key, sparse_vector(size, F.col("_pairs.idx"), F.col("_pairs.n")).alias("features")), "vectors")


def topics(fit: DataFrame, data: DataFrame, key: str, k: int = 5, seed: int = 520, max_iter: int = 20) -> DataFrame:
    """Topic mixture of each id from online variational LDA fitted on ``fit``; both hold stored vectors of one vocabulary."""
    model = LDA(k=k, seed=seed, maxIter=max_iter, optimizer="online", featuresCol="features").fit(fit)
    mix = vector_to_array("topicDistribution")
    return model.transform(data).select(key, *[mix[i].alias(f"topic_{i}") for i in range(k)])


# ---------------------------------------------------------------- factors


def hashed(seed: int, *parts: str | int) -> Column:
    """A number in [0, 1) from a seed and columns or constants, the same in every run and engine that has MD5."""
    texts = [F.col(p).cast("string") if isinstance(p, str) else F.lit(str(p)) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *texts).cast("binary")), 1, 13), 16, 10).cast("double") / float(16**13)


def dotted(left: Sequence[str], right: Sequence[str]) -> Column:
    out = F.col(left[0]) * F.col(right[0])
    for a, b in zip(left[1:], right[1:], strict=True):
        out = out + F.col(a) * F.col(b)
    return out


@dataclass(frozen=True)
class Factors:
    """Stored tables (id, w0, w1, ...) and (idx, documents, h0, h1, ...); their product row by row estimates the counts."""

    ids: DataFrame
    terms: DataFrame


def first_factors(c: Corpus, k: int, seed: int) -> Factors:
    """Hashed positive numbers at the scale of the counts."""
    ids = c.counts.select(c.key).distinct()
    total, rows, columns = c.counts.select(F.sum("n")).first()[0] or 0, ids.count(), c.terms.count()
    scale = float(np.sqrt(total / max(rows * columns, 1) / k))
    number = lambda name, side, j: (F.lit(scale) * (F.lit(0.5) + hashed(seed, side, j, name)))
    w = ids.select(c.key, *[number(c.key, 0, j).alias(f"w{j}") for j in range(k)])
    h = c.terms.select("idx", "documents", *[number("idx", 1, j).alias(f"h{j}") for j in range(k)])
    return Factors(stored(w, "w"), stored(h, "h"))


def column_sums(df: DataFrame, names: Sequence[str]) -> list[float]:
    return [float(x or 0.0) for x in df.agg(*[F.sum(n) for n in names]).first()]


def estimated(c: Corpus, f: Factors, k: int) -> DataFrame:
    """The count rows with both factors and the estimate of each."""
    rows = join_counted(c.counts, f.terms, "idx", "documents").join(f.ids, c.key)
    return rows.withColumn("_e", F.greatest(dotted([f"w{j}" for j in range(k)], [f"h{j}" for j in range(k)]), F.lit(TINY)))


def factor_step(c: Corpus, f: Factors, k: int, l1: float = L1, l2: float = L2) -> Factors:
    """One multiplicative update of the id factors, then one of the term factors."""
    w, h = [f"w{j}" for j in range(k)], [f"h{j}" for j in range(k)]

    def updated(f: Factors, key: str, table: DataFrame, own: list[str], other: list[str], other_sums: list[float]) -> DataFrame:
        pull = estimated(c, f, k).groupBy(key).agg(*[F.sum(F.col("n") / F.col("_e") * F.col(o)).alias(f"_{x}") for x, o in zip(own, other, strict=True)])
        grown = {x: F.col(x) * F.col(f"_{x}") / F.greatest(F.lit(s + l1) + F.lit(l2) * F.col(x), F.lit(TINY)) for x, s in zip(own, other_sums, strict=True)}
        return stored(table.join(pull, key).withColumns(grown).select(*table.columns), own[0][0])

    f = Factors(updated(f, c.key, f.ids, w, h, column_sums(f.terms, h)), f.terms)
    return Factors(f.ids, updated(f, "idx", f.terms, h, w, column_sums(f.ids, w)))


def factor_loss(c: Corpus, f: Factors, k: int, l1: float = L1, l2: float = L2) -> float:
    """Kullback-Leibler loss over all cells plus the penalties. The cells without counts enter by the product of the column sums."""
    w, h = [f"w{j}" for j in range(k)], [f"h{j}" for j in range(k)]
    seen = estimated(c, f, k).agg(F.sum(F.col("n") * F.log(F.col("n") / F.col("_e")) - F.col("n"))).first()[0] or 0.0
    sums = [column_sums(f.ids, w), column_sums(f.terms, h)]
    squares = [sum(t.agg(*[F.sum(F.col(x) * F.col(x)) for x in names]).first()) for t, names in ((f.ids, w), (f.terms, h))]
    return float(seen + sum(a * b for a, b in zip(*sums, strict=True)) + l1 * (sum(sums[0]) + sum(sums[1])) + l2 / 2 * sum(squares))


def nonneg_factors(c: Corpus, k: int = 5, seed: int = 520, max_iter: int = 10, l1: float = L1, l2: float = L2) -> DataFrame:
    """(id, factor_0, ...): non-negative factors of each id that lower the Kullback-Leibler loss over all cells, by multiplicative updates."""
    f = first_factors(c, k, seed)
    for _ in range(max_iter):
        f = factor_step(c, f, k, l1, l2)
    return f.ids.select(c.key, *[F.col(f"w{j}").alias(f"factor_{j}") for j in range(k)])


# ---------------------------------------------------------------- singular vectors


def gram(df: DataFrame, names: Sequence[str]) -> np.ndarray:
    """The k x k sums of products of columns."""
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = df.agg(*[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs]).first()
    out = np.zeros((len(names), len(names)))
    for (i, j), x in zip(pairs, sums, strict=True):
        out[i, j] = out[j, i] = x or 0.0
    return out


def turned(df: DataFrame, kept: Sequence[str], names: Sequence[str], matrix: np.ndarray, new: str) -> DataFrame:
    """The columns times a small matrix."""
    mixed = [sum((F.col(n) * F.lit(float(x)) for n, x in zip(names[1:], column[1:], strict=True)), F.col(names[0]) * F.lit(float(column[0]))).alias(f"{new}{j}") for j, column in enumerate(matrix.T)]
    return df.select(*kept, *mixed)


def orthonormal(df: DataFrame, kept: Sequence[str], names: Sequence[str]) -> tuple[DataFrame, int]:
    """Columns v0, v1, ... of length 1 at right angles that span what the stored ones span, and their number (fewer if those depend on each other).

    The small matrix is made in two passes, since one leaves errors where columns nearly depend; the columns are then one projection of the stored ones.
    """
    whole, out, now = np.eye(len(names)), df, list(names)
    for _ in range(2):
        values, vectors = np.linalg.eigh(gram(out, now))
        good = values > 1e-13 * max(values.max(initial=0.0), 1e-300)
        whole = whole @ (vectors[:, good] / np.sqrt(values[good]))
        out, now = turned(df, kept, names, whole, "v"), [f"v{j}" for j in range(whole.shape[1])]
    return out, len(now)


@dataclass(frozen=True)
class Singular:
    """Right singular vectors (idx, documents, v0, ...), coordinates (id, svd_0, ...) and singular values, largest first."""

    terms: DataFrame
    ids: DataFrame
    values: list[float]


def singular_vectors(c: Corpus, k: int = 5, seed: int = 520, more: int = 10, max_iter: int = 12, tolerance: float = 1e-7) -> Singular:
    """The k leading right singular vectors of the counts, not centred, by subspace iteration over k + ``more`` columns.

    A step multiplies by the counts and by their transpose (two joins) and makes the columns orthonormal by a small matrix; it ends when the energy of the
    k leading ones grows by less than ``tolerance`` of itself. Each vector's entries add up to no less than 0.
    """
    wide = min(k + more, c.size)
    start = c.terms.select("idx", "documents", *[(hashed(seed, 2, j, "idx") - 0.5 + (1.0 if j == 0 else 0.0)).alias(f"r{j}") for j in range(wide)])
    terms, width = orthonormal(stored(start, "r"), ["idx", "documents"], [f"r{j}" for j in range(wide)])
    energy = -1.0
    for _ in range(max_iter):
        v = [f"v{j}" for j in range(width)]
        ids = stored(join_counted(c.counts, terms, "idx", "documents").groupBy(c.key).agg(*[F.sum(F.col("n") * F.col(x)).alias(f"y{j}") for j, x in enumerate(v)]), "y")
        values, vectors = np.linalg.eigh(gram(ids, [f"y{j}" for j in range(width)]))
        top = vectors[:, ::-1][:, :k]
        now = float(values[::-1][:k].sum())
        if now - energy <= tolerance * now:
            break
        energy = now
        rows = c.counts.join(ids, c.key).groupBy("idx").agg(*[F.sum(F.col("n") * F.col(f"y{j}")).alias(f"z{j}") for j in range(width)])
        terms, width = orthonormal(stored(rows.join(c.terms, "idx"), "z"), ["idx", "documents"], [f"z{j}" for j in range(width)])
    signs = np.where(np.array(column_sums(terms, v)) @ top < 0, -1.0, 1.0)
    ids = turned(ids, [c.key], [f"y{j}" for j in range(width)], top * signs, "svd_")
    return Singular(stored(turned(terms, ["idx", "documents"], v, top * signs, "v"), "v"), ids, np.sqrt(np.maximum(values[::-1][:k], 0)).tolist())


def svd_factors(c: Corpus, k: int = 5, seed: int = 520) -> DataFrame:
    """(id, svd_0, ...): truncated SVD without centring, each id's counts times the k leading right singular vectors."""
    return singular_vectors(c, k, seed).ids


def embed(fit: DataFrame, data: DataFrame, key: str, token: str, k: int = 5, seed: int = 520, max_iter: int = 20) -> DataFrame:
    """Topics, non-negative factors and SVD coordinates of each id side by side, all on the fitting vocabulary."""
    fitted, vocab = corpus(fit, key, token)
    here = fitted if data is fit else corpus(data, key, token, vocab)[0]
    vectors = to_vectors(here.counts, key, here.size)
    fit_vectors = vectors if data is fit else to_vectors(fitted.counts, key, fitted.size)
    out = topics(fit_vectors, vectors, key, k, seed, max_iter)
    return out.join(nonneg_factors(here, k, seed, max_iter), key, "left").join(svd_factors(here, k, seed), key, "left")
