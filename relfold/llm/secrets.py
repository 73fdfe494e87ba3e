"""Secret scan: fixed patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary packs words into few tokens, random strings into many. Runs of key characters whose characters per token fall below a bound are
taken for secrets, unless they are known digests or identifiers. Spans are code points, end exclusive.

NULL texts count as empty and have no spans. Texts are scanned whole; long runs are encoded in pieces of bounded length, since the cost of encoding
grows with the square of a piece. Repeated rows get equal results; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relfold.llm.common import id_schema, out_batch, values

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How this public vocabulary cuts a text before merging.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KINDS = ("assign", "access", "hex", "random")
MIN_RUN, MAX_CHARS_PER_TOKEN, PIECE = 20, 1.9, 256
# Hex digits of the usual digests (MD5, SHA-1, SHA-224, SHA-256, SHA-384, SHA-512).
DIGEST_LENGTHS = frozenset({32, 40, 56, 64, 96, 128})

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
# Names: whole words or numbers joined by marks (snake_case, kebab-case, paths), or by capitals (camelCase). Possessive, so linear in the run.
IDENTIFIER = re.compile(r"[-_/=+]*+(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[0-9]{1,8}+)(?:[-_/=+]++(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[0-9]{1,8}+))++[-_/=+]*+|[A-Z]?[a-z]{2,}+(?:[A-Z][a-z]{2,}+)++")
DIGITS = re.compile(r"[0-9+/_=-]+")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and without overlap for each kind."""
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def is_known(run: str, digests: frozenset[str]) -> bool:
    """Digests (listed, or hex of a digest's length), ids, numbers and names: long, but no secrets."""
    low = run.lower()
    if low in digests or len(run) in DIGEST_LENGTHS and re.fullmatch("[0-9a-f]+", low):
        return True
    if UUID.fullmatch(run) or DIGITS.fullmatch(run) or len(set(low)) < 6:
        return True
    return bool(IDENTIFIER.fullmatch(run))


def random_spans(text: str, encode, taken: list[Span], digests: frozenset[str], limit: float) -> list[Span]:
    """Runs of key characters that the vocabulary packs badly, outside the spans already taken."""
    found: list[Span] = []
    for m in RUN.finditer(text):
        if any(a < m.end() and m.start() < b for _, a, b in taken) or is_known(m.group(), digests):
            continue
        run = m.group()
        tokens = sum(len(encode(run[i : i + PIECE])) for i in range(0, len(run), PIECE))
        if len(run) < limit * tokens:
            found.append(("random", *m.span()))
    return found


def written(spans: list[Span]) -> str:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, digests: frozenset[str] = frozenset(), limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_random, base_sha256, spans, redacted) of each row; ``redacted`` is the text with each span replaced by ``[secret]``.

    The vocabulary file is read by the driver (its 50,000 entries are under 1 MB) and sent along; ``digests`` are hex digests known to be harmless.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tiktoken.Encoding("runs", pat_str=SPLIT, mergeable_ranks=ranks.value, special_tokens={}).encode_ordinary
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans", "redacted")}
            for t in values(batch.column(1)):
                base = base_spans(t or "")
                more = random_spans(t or "", encode, base, digests, limit)
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(k == kind for k, _, _ in base + more))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(base + more))
                out["redacted"].append(redact(t, base + more))
            kinds = [pa.int64()] * 4 + [pa.string()] * 3
            yield out_batch(batch.column(0), {k: pa.array(v, kind) for (k, v), kind in zip(out.items(), kinds, strict=True)})

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    return rows.mapInArrow(scanned, id_schema(docs, doc_id, "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string, redacted string"))


def redact(text: str | None, spans: list[Span], mark: str = "[secret]") -> str | None:
    """The text with overlapping spans merged and each replaced by the mark; without spans the text as it is."""
    if not spans:
        return text
    out, end = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1:]):
        if a >= end:
            out += [text[end:a], mark]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redacted(docs: DataFrame, text: str = "text", length: str | None = None, vocabulary: str = VOCABULARY, digests: frozenset[str] = frozenset(), limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """The rows of ``docs`` with each secret in the text replaced by ``[secret]``; ``length``, if given, gets the new length of changed texts."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    place = docs.columns.index(text)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tiktoken.Encoding("runs", pat_str=SPLIT, mergeable_ranks=ranks.value, special_tokens={}).encode_ordinary
        for batch in batches:
            out, changed = [], []
            for t in values(batch.column(place)):
                base = base_spans(t or "")
                spans = base + random_spans(t or "", encode, base, digests, limit)
                out.append(redact(t, spans))
                changed.append(bool(spans))
            columns = [pa.array(out, batch.schema.field(place).type) if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(changed, pa.bool_())], [*batch.schema.names, "__changed"])

    schema = docs.withColumn("__changed", F.lit(True)).schema
    rows = docs.mapInArrow(cleaned, schema)
    if length:
        rows = rows.withColumn(length, F.when(F.col("__changed"), F.length(text).cast(docs.schema[length].dataType)).otherwise(F.col(length)))
    return rows.select(*docs.columns)
