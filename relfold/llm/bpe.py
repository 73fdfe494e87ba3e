"""Byte-pair encoding by longest matches with backtracking, and decoding by an offset table.

Merging by rank gives the only row of tokens in which every two neighbours *fit*: merging their joint text by rank gives just these two. So a piece of text
is encoded from left to right. An Aho-Corasick automaton gives the longest token at each place; it is taken if it fits its left neighbour, else the next
shorter one is tried; where none fits, the place is marked and the last token is given up. A marked place is never entered again, so the work is linear in
the piece, however long it is. Answers of the pair test are kept in a table.

Two tokens fit if no merge across their border comes before the merges that build their edges. Along the right edge of the left token and the left edge of
the right one, each edge part lasts from its own merge to the one that takes it up; a merge of two edge parts that exist together and rank before both
take-ups breaks the pair. Of equal ranks the leftmost goes first. This needs a list in which every merge comes after those of its parts and makes a text
of its own (as training gives it); others are refused.

Special tokens are found in the raw text first. How the rest is cleaned (composed, white space made one blank, lower-cased) and cut into pieces is in the
tokenizer's file and is done by the public library that reads such files. Neither composition nor a piece spans an ASCII blank, so it is enough to treat
each distinct word between such blanks; many words go through the library, the automaton and the pair test side by side, as arrays.

Decoding looks the bytes of each id up in one string by a table of offsets and joins tokens by one blank, as the library does for files
without a decoder. Other kinds of file (other cleaning or cutting, a decoder, tokens that strip blanks, unknown tokens, no word-end mark) are refused.

NULL texts count as empty and have no tokens; NULL token lists decode to the empty text. Texts are encoded whole, row by row: repeated rows get equal
results, an empty table gives an empty one.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from relfold.llm.common import BLANKS, id_schema, values

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
# Stands for the mark at a word's end; no byte is written as this character.
END = "\0"
NEVER = 1 << 40
# Words and pairs whose results a worker keeps; longer words are encoded anew each time.
KEPT_WORDS, KEPT_CHARS, KEPT_PAIRS = 500_000, 48, 1_000_000
# Words of texts that are looked up at once, a text always whole; pieces above this length are encoded one by one.
GROUP_WORDS, SIDE_BY_SIDE = 150_000, 64
# Fixed values of the files that this reads: how texts are cleaned, and the pattern of the pieces.
CLEANING = ["NFC", "Replace", "Lowercase"]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Vocabulary:
    """Tables made from a tokenizer's file: token texts, merge parts and ranks, next shorter tokens, offsets for decoding."""

    def __init__(self, path: str = VOCABULARY):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, added = spec["model"], spec["added_tokens"]
        mark = model.get("end_of_word_suffix")
        flags = ("single_word", "lstrip", "rstrip", "normalized")
        cleaning = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        pattern = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        if cleaning != CLEANING or pattern != PIECES or model["type"] != "BPE" or not mark or model.get("unk_token") or model.get("continuing_subword_prefix") or spec["decoder"] or any(t[f] for t in added for f in flags):
            raise ValueError(f"{path}: not a byte-pair vocabulary of the kind this reads")
        vocab = model["vocab"]
        inner = lambda t: t.removesuffix(mark) + END if t.endswith(mark) else t
        self.ids = {inner(t): i for t, i in vocab.items()}
        size = 1 + max([*vocab.values(), *[t["id"] for t in added]])
        self.length, self.rank, self.parts = [0] * size, [-1] * size, [(-1, -1)] * size
        self.merge: dict[tuple[int, int], int] = {}
        for t, i in self.ids.items():
            self.length[i] = len(t)
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made, parts = vocab[left + right], (vocab[left], vocab[right])
            if self.rank[made] >= 0 or max(self.rank[p] for p in parts) >= rank:
                raise ValueError(f"{path}: merge {rank} is not in training order")
            self.rank[made], self.parts[made], self.merge[parts] = rank, parts, rank
        self.shorter = [-1] * size
        for t, i in self.ids.items():
            self.shorter[i] = next((self.ids[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ids), -1)
        self.special = {t["content"]: t["id"] for t in added}
        texts = [b""] * size
        for t, i in [*vocab.items(), *self.special.items()]:
            texts[i] = t.encode()
        self.blob = b"".join(texts)
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        # what the library needs to clean and cut texts, without the tokens
        self.cutter = json.dumps(spec | {"model": model | {"vocab": {}, "merges": []}, "added_tokens": []})
        self.made: Encoder | None = None

    def encoder(self) -> Encoder:
        """An encoder that tasks of one worker share, so that what it keeps serves them all; it never travels."""
        self.made = self.made or Encoder(self)
        return self.made


class Encoder:
    """Encodes texts by the tables of a vocabulary; keeps a bounded number of results."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        library = Tokenizer.from_str(vocabulary.cutter)
        self.clean, self.cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        # on lower-cased printable ASCII the two kinds of engine agree about letters, digits and marks
        self.ascii_pieces = regex.compile(PIECES + "| ").findall
        self.blanks = re.compile(BLANKS)
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None
        # tokens read backwards: the matches that end at a place are the tokens that begin there, the longest first
        self.automaton = ahocorasick.Automaton()
        self.letters = np.full(1 + max(ord(t[0]) for t in vocabulary.ids), -1)
        for t, i in vocabulary.ids.items():
            if len(t) == 1:
                self.letters[ord(t)] = i  # every place has a match of one letter, known without a search
            else:
                self.automaton.add_word(t[::-1], i)
        self.automaton.make_automaton()
        self.length, self.shorter, self.rank = (np.array(x, np.int64) for x in (vocabulary.length, vocabulary.shorter, vocabulary.rank))
        self.first, self.second = np.array(vocabulary.parts, np.int64).T
        merges = sorted((left << 32 | right, rank) for (left, right), rank in vocabulary.merge.items())
        self.merged, self.merge_rank = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        self.known_words: dict[str, bytes] = {}
        self.forget_pairs()

    def forget_pairs(self) -> None:
        self.pairs, self.answers = np.empty(0, np.int64), np.empty(0, bool)

    def crossing(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each two tokens, NEVER where there is none."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.merged, key), len(self.merged) - 1)
        return np.where(self.merged[at] == key, self.merge_rank[at], NEVER)

    def fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the joint text of two tokens by rank gives these two, for many pairs."""
        answer, open_ = np.ones(len(left), bool), np.arange(len(left))
        left_until = right_until = np.full(len(left), NEVER)
        while len(open_):
            rank = self.crossing(left, right)
            broken = (rank < left_until) & (rank <= right_until) & (rank < NEVER)
            answer[open_[broken]] = False
            left_rank, right_rank = self.rank[left], self.rank[right]
            on = ~broken & ((left_rank >= 0) | (right_rank >= 0))
            open_, left, right, left_rank, right_rank, left_until, right_until = (x[on] for x in (open_, left, right, left_rank, right_rank, left_until, right_until))
            later = left_rank > right_rank
            left_until, left = np.where(later, left_rank, left_until), np.where(later, self.second[left], left)
            right_until, right = np.where(later, right_until, right_rank), np.where(later, right, self.first[right])
        return answer

    def fitting(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The same from the table of pairs seen before, which new pairs are added to; a piece's first token (left -1) fits."""
        key = np.where(left < 0, -1, left << 32 | right)
        at = np.searchsorted(self.pairs, key)
        known = (key < 0) | (self.pairs[np.minimum(at, len(self.pairs) - 1)] == key if len(self.pairs) else False)
        if not known.all():
            new = np.unique(key[~known])
            if len(self.pairs) + len(new) > KEPT_PAIRS:
                self.forget_pairs()
            pairs, answers = np.concatenate([self.pairs, new]), np.concatenate([self.answers, self.fits(new >> 32, new & 0xFFFFFFFF)])
            order = np.argsort(pairs, kind="stable")
            self.pairs, self.answers = pairs[order], answers[order]
            if not len(new) or len(self.pairs) == len(new):  # the table was emptied: all keys anew
                return self.fitting(left, right)
            at = np.searchsorted(self.pairs, key)
        out = key < 0
        out[~out] = self.answers[at[~out]]
        return out

    def longest(self, text: str) -> np.ndarray:
        """The longest token that begins at each place, -1 where there is none."""
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text[::-1])), np.int64).reshape(-1, 2)[::-1]
        out = np.append(self.letters[np.frombuffer(text.encode("utf-32-le"), np.uint32)], -1)
        out[len(text) - 1 - found[:, 0]] = found[:, 1]  # of several at a place the last one here stays, which the automaton gave first
        return out

    def pieces(self, texts: list[str]) -> list[bytes]:
        """Tokens of each piece, written in the vocabulary's letters for bytes. All advance together, by one trial a round."""
        joined = "".join(t + END for t in texts)
        longest, closed = self.longest(joined), np.zeros(len(joined) + 1, bool)
        stop = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        at = np.concatenate((stop[:0], [0], stop[:-1])).astype(np.int64)
        token, depth, active = longest[at], np.zeros(len(texts), np.int64), np.arange(len(texts))
        rows = np.full((len(texts), int(max(map(len, texts), default=0)) + 1), -1)
        while len(active):
            stuck = token[active] < 0
            back, go = active[stuck], active[~stuck]
            if len(back):
                if not depth[back].all():
                    raise ValueError("a letter is missing in the vocabulary")
                closed[at[back]] = True
                depth[back] -= 1
                given_up = rows[back, depth[back]]
                at[back] -= self.length[given_up]
                token[back] = self.shorter[given_up]
            tried = token[go]
            end = at[go] + self.length[tried]
            left = np.where(depth[go] > 0, rows[go, depth[go] - 1], -1)
            fits = ~closed[end]
            fits[fits] = self.fitting(left[fits], tried[fits])
            taken = go[fits]
            rows[taken, depth[taken]] = tried[fits]
            depth[taken] += 1
            at[taken] = end[fits]
            token[taken] = longest[end[fits]]
            token[go[~fits]] = self.shorter[tried[~fits]]
            active = active[at[active] < stop[active]]
        return split(rows[np.arange(rows.shape[1]) < depth[:, None]], np.cumsum(depth))

    def long_piece(self, text: str) -> bytes:
        """The same for one long piece."""
        text += END
        longest, length, shorter = self.longest(text).tolist(), self.v.length, self.v.shorter
        out: list[int] = []
        closed = bytearray(len(text) + 1)
        pairs: dict[tuple[int, int], bool] = {}
        at, token = 0, longest[0]
        while at < len(text):
            if token < 0:
                if not out:
                    raise ValueError("a letter is missing in the vocabulary")
                closed[at] = 1
                token = out.pop()
                at -= length[token]
                token = shorter[token]
                continue
            end = at + length[token]
            fits = not closed[end]
            if fits and out:
                pair = (out[-1], token)
                if pair not in pairs:
                    pairs[pair] = bool(self.fits(*(np.array([x]) for x in pair))[0])
                fits = pairs[pair]
            if fits:
                out.append(token)
                at, token = end, longest[end]
            else:
                token = shorter[token]
        return np.array(out, np.int32).tobytes()

    def cut_ascii(self, words: list[str]) -> tuple[list[str], list[int]]:
        """The pieces of all words, and how many of them each word and those before it have, for words of printable ASCII."""
        found = self.ascii_pieces(" ".join(words).lower())
        gaps = np.flatnonzero(np.fromiter((p == " " for p in found), bool, len(found)))
        return [p for p in found if p != " "], [*(gaps - np.arange(len(gaps))).tolist(), len(found) - len(gaps)]

    def cut_words(self, words: list[str]) -> tuple[list[str], list[int]]:
        """The same for other words, by the library."""
        cleaned = self.clean(" ".join(words))
        gaps = np.flatnonzero(np.frombuffer(cleaned.encode("utf-32-le"), np.uint32) == 32)
        if len(gaps) != len(words) - 1:  # white space within words
            each = [[p for p, _ in self.cut(self.clean(w))] for w in words]
            return list(chain.from_iterable(each)), np.cumsum([len(x) for x in each]).tolist()
        found = self.cut(cleaned)
        word = np.searchsorted(gaps, np.fromiter((span[0] for _, span in found), np.int64, len(found)))
        return [p for p, _ in found], np.searchsorted(word, np.arange(len(words)), side="right").tolist()

    def words(self, words: list[str]) -> dict[str, bytes]:
        """Tokens (as int32 bytes) of stretches of raw text without ASCII blanks."""
        kinds: dict[str, list[str]] = {"ascii": [], "other": [], "blank": []}
        for w in words:
            kinds["ascii" if w.isascii() and w.isprintable() else "other" if len(w.split()) == 1 else "blank"].append(w)
        out: dict[str, bytes] = {}
        for kind, some in kinds.items():
            if some:
                out |= self.tokens_of(some, *(self.cut_ascii(some) if kind == "ascii" else self.cut_words(some)))
        return out

    def tokens_of(self, words: list[str], pieces: list[str], ends: list[int]) -> dict[str, bytes]:
        every = dict.fromkeys(pieces)
        short = [p for p in every if len(p) <= SIDE_BY_SIDE]
        tokens = dict(zip(short, self.pieces(short), strict=True))
        tokens |= {p: self.long_piece(p) for p in every if len(p) > SIDE_BY_SIDE}
        found = list(map(tokens.__getitem__, pieces))
        return {w: found[a] if b == a + 1 else b"".join(found[a:b]) for w, a, b in zip(words, [0, *ends], ends, strict=False)}

    def group(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Tokens of texts cut into words."""
        every = set(chain.from_iterable(texts)) - {""}
        new = self.words(list(every - self.known_words.keys()))
        if len(self.known_words) + len(new) > KEPT_WORDS:
            self.known_words.clear()
            new |= self.words(list(every - new.keys()))
        self.known_words |= {w: x for w, x in new.items() if len(w) <= KEPT_CHARS}
        table = self.known_words | {w: x for w, x in new.items() if len(w) > KEPT_CHARS} if any(len(w) > KEPT_CHARS for w in new) else self.known_words
        table[""] = b""
        return [np.frombuffer(b"".join(map(table.__getitem__, t)), np.int32) for t in texts]

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Tokens of each text, in order."""
        waiting: list[list[str]] = []
        marks: list[list[tuple[int, int]]] = []
        size = 0
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            words: list[str] = []
            places = []
            for k, part in enumerate(parts):
                if k % 2:
                    places.append((len(words), self.v.special[part]))
                else:
                    words += self.blanks.split(part)
            waiting.append(words)
            marks.append(places)
            size += len(words)
            if size >= GROUP_WORDS:
                yield from self.with_marks(waiting, marks)
                waiting, marks, size = [], [], 0
        yield from self.with_marks(waiting, marks)

    def with_marks(self, texts: list[list[str]], marks: list[list[tuple[int, int]]]) -> Iterator[np.ndarray]:
        """Tokens of each text with its special tokens, each before the word that it stood before."""
        cut = [[words[a:b] for a, b in zip([0, *[p for p, _ in places]], [*[p for p, _ in places], len(words)], strict=True)] for words, places in zip(texts, marks, strict=True)]
        found = iter(self.group(list(chain.from_iterable(cut))))
        for parts, places in zip(cut, marks, strict=True):
            out = [next(found)]
            for (_, token), _ in zip(places, parts[1:], strict=True):
                out += [np.array([token], np.int32), next(found)]
            yield np.concatenate(out) if places else out[0]


def split(flat: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """An array of tokens cut at the given places, each part as int32 bytes (which cost far less to keep than lists)."""
    every, places = flat.astype(np.int32).tobytes(), (4 * ends).tolist()
    return [every[a:b] for a, b in zip([0, *places], places, strict=False)]


def gather(blob: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> bytes:
    """The stretches of the ids one after another: every byte's place follows from the offsets."""
    starts, sizes = offsets[ids], offsets[ids + 1] - offsets[ids]
    ends = np.cumsum(sizes)
    places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
    return blob[places].tobytes()


class Decoder:
    """Decodes token lists by one string of all tokens, each followed by the blank that joins it to the next one, and the offsets in it."""

    def __init__(self, vocabulary: Vocabulary):
        self.blob = np.insert(np.frombuffer(vocabulary.blob, np.uint8), vocabulary.offsets[1:], ord(" "))
        self.offsets = vocabulary.offsets + np.arange(len(vocabulary.offsets))

    def decode(self, lists: Iterable[np.ndarray]) -> pa.Array:
        return pa.array((gather(self.blob, self.offsets, x)[:-1] for x in lists), pa.binary()).cast(pa.string())


def as_lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.empty(0, np.int32)))


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, decoded: bool = False) -> DataFrame:
    """(id, ids) of each row, with ``decoded`` also what the ids decode to, in the same pass.

    The tables (49,000 entries, a few MB; their size is that of the vocabulary) are made by the driver and sent along.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = sent.value.encoder(), Decoder(sent.value)
        for batch in batches:
            found = list(encoder.encode(t or "" for t in values(batch.column(1))))
            columns = {"id": batch.column(0), "ids": as_lists(found)} | ({"decoded": decoder.decode(found)} if decoded else {})
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t"))
    return rows.mapInArrow(encoded, id_schema(docs, doc_id, "ids array<int>" + (", decoded string" if decoded else "")))


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, ids, decoded) of rows of (id, ids)."""
    sent = encoded.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(sent.value)
        for batch in batches:
            ids = batch.column(1)
            lists = (x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.empty(0, np.int32) for x in ids)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, decoder.decode(lists)], ["id", "ids", "decoded"])

    return encoded.select("id", "ids").mapInArrow(decoded, id_schema(encoded, "id", "ids array<int>, decoded string"))
