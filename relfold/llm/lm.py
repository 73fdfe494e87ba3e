"""Language-model scores: a gated recurrent network with a class-factored output, beside a unigram base.

Tokens are the words of a text (A-Z lower-cased, between ASCII blanks), then one end. The most frequent words are symbols of the network, in classes of
equal size; every other word belongs to a class by its spelling. The network predicts the class of the next token, and for a frequent word the word within
its class; other words share their class's mass by their counts, each plus one, with one more share for all unseen words. So the model is a distribution
over the same vocabulary as the base.

Training is truncated backpropagation in numpy inside tasks: the state runs through all of every training text, and gradients are taken through every window
of it. Each round takes a part of the texts, every trainer learns its share from the same start, and the weights are averaged by
tokens. Texts are dealt to trainers by hash, in a number that follows from the corpus: the model is the same however the table is partitioned. Scoring carries the state over window borders, so a text's likelihood is that of the whole text.

Counts are of all training tokens. Words up to a bound are sent to tasks with their counts; the counts of all others are joined by word.

A NULL text counts as empty: its only token is the end. Ids tell rows apart, and rows that share an id and text get equal scores. With no training text
every count is zero. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relfold.llm.common import raw_texts, stored, values

END = " "  # no word holds a blank
# Words known to every task, with their counts: at most this many, of at most so many bytes each.
DICTIONARY, LONGEST = 200_000, 64
# Bytes of text whose words are held at a time; a text is never cut.
READ_BYTES = 16 << 20
HEAD, PER_CLASS, HIDDEN, SEED = 1024, 64, 16, 7
HEAD_CLASSES = HEAD // PER_CLASS
LETTERS, FOREIGN = 12, 4
SHAPES = 2 * (1 + FOREIGN + LETTERS)
SYMBOLS, CLASSES = HEAD + SHAPES, HEAD_CLASSES + SHAPES
WINDOW, GROUP, TRAIN_GROUP = 32, 512, 256
# Where fewer texts than this are still running, windows are longer, up to so many times.
FEW, LONGER = 128, 8
# Outputs that the weights keep below this, whatever the state, need no maximum taken out; rows whose outputs are held at a time.
SMALL_OUTPUT, CHUNK = 60, 1024
# Parts of 8 of the training texts that the rounds take.
ROUNDS, RATE = (1, 3, 4), 0.1
# Training tokens for each trainer, and tokens that a trainer sorts by length at a time.
TRAINER_TOKENS, POOL = 2_000_000, 500_000
# Weights are summed in units of 1 / UNIT, so many of them in one row.
UNIT, BLOCK = 1 << 24, 1024


def tokens(text: bytes) -> list[bytes]:
    """The words of one text."""
    return text.lower().split()


def word_runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, pa.Array]]:
    """(first row, number of words of each text, all their words) of one run of rows after the other; the words are those of ``tokens``."""
    held = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // READ_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(column)]
    for first, end in zip(cuts, cuts[1:], strict=False):
        if first < end:
            lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column.slice(first, end - first), "")))
            found, sizes = lists.flatten(), lists.value_lengths().to_numpy()
            filled = pc.binary_length(found).to_numpy() > 0  # blanks at the ends of a text leave empty pieces
            rows = np.repeat(np.arange(end - first), sizes)[filled]
            yield first, np.bincount(rows, minlength=end - first), found.filter(pa.array(filled)).cast(pa.string())


def shape(word: bytes) -> int:
    """Spelling class of a word that is no symbol: closing mark or none, and foreign letters, last letter, or other signs."""
    core = word.rstrip(b".,!?;:") or word
    if not word.isascii():
        kind = 1 + ord(next(c for c in word.decode("utf-8", "replace") if ord(c) > 127)) % FOREIGN
    elif core.isalpha():
        kind = 1 + FOREIGN + (core[-1] - 97) * LETTERS // 26
    else:
        kind = 0
    return kind + (SHAPES // 2 if len(core) < len(word) else 0)


def shapes(words: pa.Array) -> np.ndarray:
    """``shape`` of each of many words; only those with foreign letters are looked at one by one."""
    if not len(words):
        return np.empty(0, np.int16)
    core = pc.ascii_rtrim(words, characters=".,!?;:")
    closed = (pc.binary_length(core).to_numpy() < pc.binary_length(words).to_numpy()) & (pc.binary_length(core).to_numpy() > 0)
    ends = np.frombuffer(core.buffers()[1], np.int32)[core.offset :][1 : len(core) + 1] - 1
    last = np.frombuffer(core.buffers()[2] or b" ", np.uint8)[np.maximum(ends, 0)].astype(np.int64)
    kind = np.where(pc.ascii_is_alpha(core).to_numpy(zero_copy_only=False), 1 + FOREIGN + (last - 97) * LETTERS // 26, 0) + closed * (SHAPES // 2)
    foreign = np.flatnonzero(~pc.string_is_ascii(words).to_numpy(zero_copy_only=False))
    kind[foreign] = [shape(w) for w in raw_texts(words.take(pa.array(foreign)))]
    return kind.astype(np.int16)


# ------------------------------------------------------------------ network

def first_weights(seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *size: (rng.standard_normal(size) * 0.1).astype(np.float32)
    return {
        "in": normal(SYMBOLS, 3 * HIDDEN), "back": normal(HIDDEN, 3 * HIDDEN), "class": normal(HIDDEN, CLASSES), "class_bias": np.zeros(CLASSES, np.float32),
        "word": normal(HEAD, HIDDEN), "word_bias": np.zeros(HEAD, np.float32),
    }


def packed(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w.ravel() for w in weights.values()])


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, w in first_weights().items():
        out[name] = flat[at : at + w.size].reshape(w.shape).astype(np.float32)
        at += w.size
    return out


class Network:
    """The recurrent network over groups of texts, longest first, so that the texts still running are always the first ones.

    Inside a window a row stands for a step of a text, step by step, so what one step needs lies together.
    """

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights
        self.squares = {k: np.full_like(v, 1e-6) for k, v in weights.items()}
        self.held: dict[str, np.ndarray] = {}

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array of any content; the memory of each name is used again by the next call."""
        size = int(np.prod(shape))
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, self.w["back"].dtype)
        return self.held[name][:size].reshape(shape)

    def run(self, h: np.ndarray, x: np.ndarray, active: list[int]) -> tuple[np.ndarray, ...]:
        """Runs the state ``h`` (texts x units, changed in place) through a window (steps x texts); rows of all results are the steps' texts, step by step.

        Symbols, states before each step, gates (update, reset), new states, and what the state adds to them before the reset.
        """
        symbols = np.concatenate([x[t, :n] for t, n in enumerate(active)])
        size, most = len(symbols), active[0]
        states, news, inner = (self.room(k, size, HIDDEN) for k in ("states", "news", "inner"))
        gates, added, moved = self.room("gates", size, 2 * HIDDEN), self.room("added", most, 2 * HIDDEN), self.room("moved", most, HIDDEN)
        # a gate is (1 + tanh(x / 2)) / 2, and twice that in the steps
        np.take(self.w["in"][:, : 2 * HIDDEN] / 2, symbols, axis=0, out=gates, mode="clip")
        np.take(self.w["in"][:, 2 * HIDDEN :], symbols, axis=0, out=news, mode="clip")
        by_state, by_reset = (np.ascontiguousarray(w) for w in np.split(self.w["back"] / 2, [2 * HIDDEN], axis=1))
        at, now = 0, states[:most]
        now[:] = h[:most]
        for t, n in enumerate(active):
            end = at + n
            z, new, back = gates[at:end], news[at:end], inner[at:end]
            z += np.dot(now, by_state, out=added[:n])
            np.tanh(z, out=z)
            z += 1
            np.dot(now, by_reset, out=back)
            change = np.multiply(z[:, HIDDEN:], back, out=moved[:n])
            new += change
            np.tanh(new, out=new)
            np.subtract(now, new, out=change)
            change *= z[:, :HIDDEN]
            change *= 0.5
            if t + 1 < len(active):
                more = active[t + 1]
                now = np.add(change[:more], new[:more], out=states[end : end + more])
            else:
                np.add(change, new, out=h[:n])
            at = end
        gates *= 0.5
        inner *= 2
        return symbols, states, gates, news, inner

    def windows(self, texts: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first step, symbols of the running texts by step, how many run at each step)."""
        lengths = np.array([len(t) for t in texts])
        flat = np.concatenate(texts)
        starts = np.cumsum(lengths) - lengths
        t0 = 0
        while t0 < lengths[0]:
            running = int((lengths > t0).sum())
            span = WINDOW * min(max(FEW // running, 1), LONGER)
            steps = np.arange(t0, min(t0 + span, int(lengths[0])))
            at = starts[:running] + np.minimum(steps[:, None], lengths[:running] - 1)
            yield t0, flat[at], running - np.searchsorted(lengths[running - 1 :: -1], steps, side="right")
            t0 += span

    def shares(self, weights: np.ndarray, bias: np.ndarray, small: bool, states: np.ndarray, grads: tuple[np.ndarray, np.ndarray] | None = None, back: np.ndarray | None = None) -> np.ndarray:
        """Log of the sum over ``weights`` (outputs x units) of exp(output), for each row of the states; the highest bias is 0.

        With ``grads`` (of the weights, of the bias) adds the sum's gradients, and sets ``back`` to that of the states. States lie between -1 and 1, so ``small``
        weights can't overflow: then the bias goes in as a factor, and no maximum is taken out.
        """
        out = np.empty(len(states), states.dtype)
        factor = np.exp(bias) if small else np.ones_like(bias)
        to_states, by_unit = weights * factor[:, None], np.ascontiguousarray(weights.T)
        for at in range(0, len(states), CHUNK):
            own = states[at : at + CHUNK]
            outputs = np.dot(own, by_unit, out=self.room("outputs", len(own), len(weights)))
            if small:
                np.exp(outputs, out=outputs)
                total = outputs @ factor
                np.log(total, out=out[at : at + CHUNK])
            else:
                outputs += bias
                highest = outputs.max(axis=1, keepdims=True)
                outputs -= highest
                np.exp(outputs, out=outputs)
                total = outputs.sum(axis=1)
                np.add(np.log(total), highest[:, 0], out=out[at : at + CHUNK])
            if grads is not None:
                outputs *= np.reciprocal(total, out=total)[:, None]
                np.dot(outputs, to_states, out=back[at : at + CHUNK])
                grads[0][:] += (outputs.T @ own) * factor[:, None]
                grads[1][:] += (np.ones_like(total) @ outputs) * factor
        return out

    def outputs(self, states: np.ndarray, target: np.ndarray, grads: dict[str, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each target's class, and of the word within it for symbols of the head; with ``grads`` also the states' gradient.

        ``target`` is in order. ``grads`` has the class weights as classes x units.
        """
        words, by_class = self.w["word"], np.ascontiguousarray(self.w["class"].T)
        class_bias, word_bias = self.w["class_bias"] - self.w["class_bias"].max(), self.w["word_bias"].reshape(HEAD_CLASSES, PER_CLASS)
        word_bias = (word_bias - word_bias.max(axis=1, keepdims=True)).ravel()
        small = max(float(np.abs(w).sum(axis=1).max()) for w in (by_class, words)) < SMALL_OUTPUT
        # what a symbol's class and, in the head, its word put out
        class_of = np.append(np.repeat(np.arange(HEAD_CLASSES), PER_CLASS), np.arange(HEAD_CLASSES, CLASSES))
        weights, bias = by_class[class_of], class_bias[class_of]
        weights[:HEAD] += words
        bias[:HEAD] += word_bias
        own = np.take(weights, target, axis=0, out=self.room("own", len(target), HIDDEN), mode="clip")
        logp = np.einsum("ij,ij->i", own, states)
        logp += bias[target]
        cuts = np.searchsorted(target, np.arange(0, HEAD + 1, PER_CLASS).astype(target.dtype)).tolist()
        back = inner = of_class = of_words = mine_back = None
        if grads is not None:
            back, inner, of_class = self.room("back", len(target), HIDDEN), self.room("inner_back", cuts[-1], HIDDEN), (grads["class"], grads["class_bias"])
        logp -= self.shares(by_class, class_bias, small, states, of_class, back)
        for c in range(HEAD_CLASSES):
            mine, part = slice(cuts[c], cuts[c + 1]), slice(c * PER_CLASS, (c + 1) * PER_CLASS)
            if cuts[c] < cuts[c + 1]:
                if grads is not None:
                    of_words, mine_back = (grads["word"][part], grads["word_bias"][part]), inner[mine]
                logp[mine] -= self.shares(words[part], word_bias[part], small, states[mine], of_words, mine_back)
        if grads is not None:
            back[: cuts[-1]] += inner
            back -= own
        return logp, back

    def start(self, texts: list[np.ndarray]) -> np.ndarray:
        return np.zeros((len(texts), HIDDEN), self.w["back"].dtype)

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of each text (longest first)."""
        out = np.zeros(len(texts))
        h = self.start(texts)
        for _, x, active in self.windows(texts):
            active = active.tolist()
            symbols, states, *_ = self.run(h, x, active)
            order, ordered = in_order(symbols)
            logp, _ = self.outputs(np.take(states, order, axis=0, out=self.room("ordered", *states.shape), mode="clip"), ordered)
            out += np.bincount(np.concatenate([np.arange(n) for n in active])[order], weights=logp, minlength=len(out))
        return out

    def train(self, texts: list[np.ndarray], turn: int = 0, rate: float = RATE) -> None:
        """One pass: every window of every text is learned from, whichever ``turn`` the group has."""
        h = self.start(texts)
        for _, x, active in self.windows(texts):
            self.learn(h, x, active.tolist(), rate)

    def learn(self, h: np.ndarray, x: np.ndarray, active: list[int], rate: float) -> None:
        """Moves the state ``h`` through a window, then the weights against the gradient of its likelihood."""
        w, grads = self.w, {k: np.zeros_like(self.w[k]) for k in ("class_bias", "word", "word_bias")}
        grads["class"] = np.zeros_like(w["class"].T, order="C")
        symbols, states, gates, news, inner = self.run(h, x, active)
        order, ordered = in_order(symbols)
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        found, times = ordered[starts], np.diff(starts, append=len(ordered))
        ordered_states = np.take(states, order, axis=0, out=self.room("ordered", *states.shape), mode="clip")
        _, ordered_back = self.outputs(ordered_states, ordered, grads)
        back = self.room("unordered", *states.shape)
        back[order] = ordered_back
        # the targets' own part of the gradient of the outputs
        sums = summed(ordered_states, starts)
        words = int(np.searchsorted(found, HEAD))
        grads["word"][found[:words]] -= sums[:words]
        grads["word_bias"][found[:words]] -= times[:words]
        classes = np.where(found < HEAD, found // PER_CLASS, found - HEAD + HEAD_CLASSES)
        np.subtract.at(grads["class"], classes, sums)
        np.subtract.at(grads["class_bias"], classes, times.astype(sums.dtype))
        grads["class"] = grads["class"].T
        update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
        # what a state's gradient is multiplied by, for all steps at once: on the way to the state before, to the new state, to the update gate; from the
        # new state to the reset gate, and to what the state adds
        by, by_inner = self.room("by", 3, *states.shape), self.room("by_inner", 2, *states.shape)
        left = np.subtract(1, update, out=self.room("left", *states.shape))
        by[0] = update
        np.multiply(news, news, out=by[1])
        np.subtract(1, by[1], out=by[1])
        by[1] *= left
        np.subtract(states, news, out=by[2])
        by[2] *= left
        by[2] *= by[0]
        by_inner[1] = reset
        np.subtract(1, by_inner[1], out=by_inner[0])
        by_inner[0] *= by_inner[1]
        by_inner[0] *= inner
        # gradients: kept by the state, of the new state, then of update, reset and what the state adds
        d = self.room("d", 5, *states.shape)
        returned = np.ascontiguousarray(w["back"].T).reshape(3, HIDDEN, HIDDEN)
        dh, parts = np.zeros((active[0], HIDDEN), states.dtype), self.room("parts", 3, active[0], HIDDEN)
        at = len(symbols)
        for n in reversed(active):
            end, at = at, at - n
            own, now, part = dh[:n], d[:, at:end], parts[:, :n]
            np.multiply(own, by[:, at:end], out=now[:3])
            np.multiply(now[1], by_inner[:, at:end], out=now[3:])
            np.matmul(now[2:], returned, out=part)
            np.add(now[0], back[at:end], out=own)
            own += part[0]
            own += part[1]
            own += part[2]
        grads["back"] = np.concatenate([states.T @ x for x in d[2:]], axis=1)
        given = self.room("given", *states.shape)
        grads["in"] = np.concatenate([summed(np.take(d[k], order, axis=0, out=given, mode="clip"), starts) for k in (2, 3, 1)], axis=1)
        scale = 1 / float(WINDOW * TRAIN_GROUP)  # windows of few texts weigh less
        for k, g in grads.items():
            g = g * scale
            rows = found if k == "in" else slice(None)  # symbols that do not occur have no gradient
            squares = self.squares[k][rows] + g * g
            self.squares[k][rows] = squares
            w[k][rows] -= rate * g / np.sqrt(squares)


def in_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the symbols from the lowest to the highest, and the symbols in that order."""
    order = np.argsort(symbols.astype(np.int16), kind="stable")
    return order, symbols[order]


def summed(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows from each start up to the next."""
    return np.add.reduceat(rows, starts, axis=0)


# ------------------------------------------------------------------ counts

def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(word, c) over all texts, the end of each text as END; counted in tasks before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sizes, found in word_runs(batch.column(0)):
                words, times = found.value_counts().flatten()
                ends = pa.array([END]), pa.array([len(sizes)], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip((words, times), ends, strict=True)], ["word", "c"])

    return docs.select(F.col(text).alias("t")).mapInArrow(counted, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """What tasks know of the corpus: totals, totals of the spelling classes, and the most frequent words. Its size is bounded by DICTIONARY words."""

    def __init__(self, counts: DataFrame, dictionary: int = DICTIONARY):
        total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        self.n, self.v = int(total[0]), int(total[1])
        # counts by eighths of a power of two: the lowest step at which the words still fit
        step = F.floor(F.log2("c") * 8).cast("int")
        steps = counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()
        room, self.least = dictionary, 1 << 62
        for s, n in sorted(((r["s"], r["n"]) for r in steps), reverse=True):
            room -= n
            if room < 0:
                break
            self.least = s
        frequent = counts.where(self.known()).orderBy(F.desc("c"), "word").toArrow()
        self.words: list[bytes] = [w.encode() for w in frequent["word"].to_pylist()]
        self.c = np.asarray(frequent["c"].to_pylist(), np.int64)

    def known(self) -> Column:
        """Whether a row of the counts is sent along; the end always is."""
        return (F.floor(F.log2("c") * 8).cast("int") >= self.least) & (F.octet_length("word") <= LONGEST) | (F.col("word") == END)

    def class_totals(self, counts: DataFrame) -> None:
        """Tokens and words of each spelling class, outside the head."""
        head = self.words[:HEAD]

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            symbols, tokens_, words_ = pa.array([w.decode() for w in head], pa.string()), np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
            for batch in batches:
                words, c = batch.column(0).cast(pa.string()), batch.column(1)
                rest = pc.invert(pc.is_in(words, value_set=symbols))
                kinds, times = shapes(words.filter(rest)), np.asarray(c.filter(rest))
                np.add.at(tokens_, kinds, times)
                np.add.at(words_, kinds, 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SHAPES), pa.int32()), pa.array(tokens_), pa.array(words_)], ["k", "n", "v"])

        sums = counts.mapInArrow(summed, "k int, n long, v long").groupBy("k").agg(F.sum("n"), F.sum("v")).collect()
        self.class_room = np.ones(SHAPES)
        for k, n, v in sums:
            self.class_room[k] = n + v + 1

    def start(self) -> np.ndarray:
        """First weights: small random ones, and biases that make the network a unigram model."""
        weights = first_weights()
        head = np.zeros(HEAD)
        head[: min(HEAD, len(self.c))] = self.c[:HEAD]
        weights["word_bias"][:] = np.log(head + 1)
        weights["class_bias"][:] = np.log(np.concatenate((head.reshape(HEAD_CLASSES, PER_CLASS).sum(axis=1) + 1, self.class_room)))
        return packed(weights)

    def sent(self) -> dict:
        """What tasks get: the words, log10(count + 1) and symbol of each, and the size of each spelling class."""
        words = pa.array([w.decode() for w in self.words], pa.string())
        symbols = np.concatenate((np.arange(min(HEAD, len(words)), dtype=np.int16), HEAD + shapes(words[HEAD:])))
        return {"words": words, "log_count": np.log10(self.c + 1.0), "symbols": symbols, "class_room": self.class_room}


class Reader:
    """Turns texts into symbols, inside a task."""

    def __init__(self, known: dict):
        # one more place, -1, for words that are not known
        self.words, self.symbol, self.log_count = known["words"], np.append(known["symbols"], np.int16(0)), np.append(known["log_count"], 0.0)
        self.end = pc.index_in(pa.scalar(END), value_set=self.words).as_py()

    def read(self, sizes: np.ndarray, found: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Of texts with so many words each, the words and the end of each in one line: (places in the dictionary or -1, symbols), and for each text its
        unknown words with their counts."""
        ends = np.cumsum(sizes + 1) - 1
        inside = np.ones(len(found) + len(sizes), bool)
        inside[ends] = False
        places = np.empty(len(inside), np.int64)
        places[inside] = pc.fill_null(pc.index_in(found, value_set=self.words), -1).to_numpy()
        places[ends] = -1 if self.end is None else self.end
        symbols = self.symbol[places]
        if self.end is None:
            symbols[ends] = HEAD
        missing = np.flatnonzero((places < 0) & inside)
        rows = np.searchsorted(ends, missing)
        coded = found.take(pa.array(missing - rows)).dictionary_encode()
        codes, kinds = coded.indices.to_numpy(), coded.dictionary
        symbols[missing] = HEAD + shapes(kinds)[codes]
        own, times = np.unique(rows * max(len(kinds), 1) + codes, return_counts=True)
        rows, codes = np.divmod(own, max(len(kinds), 1))
        starts = np.searchsorted(rows, np.arange(len(sizes) + 1))
        return places, symbols, pa.MapArray.from_arrays(pa.array(starts, pa.int32()), kinds.take(pa.array(codes)), pa.array(times, pa.int64()))


def grouped(rows: Iterator[tuple[int, np.ndarray]], size: int = GROUP) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Texts of about equal length together, longest first."""
    ordered = sorted(rows, key=lambda r: -len(r[1]))
    for at in range(0, len(ordered), size):
        yield ordered[at : at + size]


# ------------------------------------------------------------------ training and scoring

def encoded(docs: DataFrame, training: Column, vocabulary: Vocabulary, doc_id: str, text: str) -> DataFrame:
    """Each text read once: (id, tw, training, n_tokens, dictionary_known, dictionary_log, tail_log, symbols as 16-bit numbers, words outside the dictionary).

    ``tw`` tells texts of one id apart. ``dictionary_log`` and ``tail_log`` lack the counts of rare words; ``tail_log`` is what the words outside the head get
    within their classes.
    """
    known = docs.sparkSession.sparkContext.broadcast(vocabulary.sent())
    names = ["id", "tw", "training", "n_tokens", "dictionary_known", "dictionary_log", "tail_log", "symbols", "rare"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, room = Reader(known.value), np.log10(known.value["class_room"])
        for batch in batches:
            for first, sizes, words in word_runs(batch.column(3)):
                places, symbols, rare = reader.read(sizes, words)
                bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
                log_counts, tail = reader.log_count[places], symbols >= HEAD
                sums = [np.add.reduceat(x, bounds[:-1]) for x in ((places >= 0).astype(np.int64), log_counts, np.where(tail, log_counts - room[np.maximum(symbols - HEAD, 0)], 0.0))]
                as_bytes = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((bounds * 2).astype(np.int32)), pa.py_buffer(symbols)])
                yield pa.RecordBatch.from_arrays([*(c.slice(first, len(sizes)) for c in batch.columns[:3]), pa.array(sizes + 1), *map(pa.array, sums), as_bytes, rare], names)

    kind = docs.schema[doc_id].dataType.simpleString()
    tw = (F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")) - (1 << 31)).cast("int")
    rows = docs.select(F.col(doc_id).alias("id"), tw.alias("tw"), F.coalesce(training, F.lit(False)).alias("training"), F.col(text).alias("t"))
    return rows.mapInArrow(read, f"id {kind}, tw int, training boolean, n_tokens long, dictionary_known long, dictionary_log double, tail_log double, symbols binary, rare map<string,long>")


def pools(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[list[np.ndarray]]:
    """Texts of symbols in the order given, so many together that they reach POOL tokens, however the rows come in batches."""
    pool: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for b in values(batch.column(column)):
            pool.append(np.frombuffer(b, np.int16))
            held += len(pool[-1])
            if held >= POOL:
                yield pool
                pool, held = [], 0
    if pool:
        yield pool


def fit(texts: DataFrame, vocabulary: Vocabulary, rounds: tuple[int, ...] = ROUNDS) -> np.ndarray:
    """Weights as one flat array, after a round for each part of the training texts; ``texts`` is the stored table of ``encoded``.

    Texts are dealt by a hash of their id and symbols, to a number of trainers that follows from the number of training tokens, and each trainer takes
    them in the order of another hash. Weights are summed as whole numbers. So the model depends on the texts alone, not on how the table is stored,
    partitioned or batched.
    """
    ctx = texts.sparkSession.sparkContext
    flat, done = vocabulary.start(), 0
    trainers = -(-max(vocabulary.n, 1) // TRAINER_TOKENS)
    own = [F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("symbols")]
    place = lambda salt, n: F.pmod(F.xxhash64(*own, F.lit(salt)), F.lit(n)).cast("int")
    part = place("round", sum(rounds))
    for share in rounds:
        start = ctx.broadcast(flat)

        def trained(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            network, weight = Network(unpacked(start.value.copy())), 0
            with np.errstate(over="ignore"):
                for pool in pools(batches, 0):
                    for group in grouped(enumerate(pool), TRAIN_GROUP):
                        network.train([s for _, s in group])
                        weight += sum(len(s) for _, s in group)
            if weight:
                now = np.rint(packed(network.w).astype(np.float64) * (weight * float(UNIT))).astype(np.int64)
                blocks = [now[at : at + BLOCK].tobytes() for at in range(0, len(now), BLOCK)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(blocks)), pa.int32()), pa.array(blocks, pa.binary()), pa.array(np.full(len(blocks), weight))], ["block", "sums", "weight"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # in two halves, since the sum over many trainers may exceed 64 bits
            totals: dict[int, list] = {}
            for batch in batches:
                for block, sums, weight in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    values_ = np.frombuffer(sums, np.int64)
                    total = totals.setdefault(block, [0, 0, 0])
                    for k, x in enumerate((values_ >> 32, values_ & 0xFFFFFFFF, weight)):
                        total[k] = total[k] + x
            means = [np.array([((h << 32) + l) / (weight * UNIT) for h, l in zip(high.tolist(), low.tolist(), strict=True)]).tobytes() for high, low, weight in totals.values()]
            yield pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.int32()), pa.array(means, pa.binary())], ["block", "means"])

        mine = texts.where(F.col("training") & (part >= done) & (part < done + share)).select("symbols", F.xxhash64(*own, F.lit("order")).alias("o"), place("trainer", trainers).alias("trainer"))
        dealt = mine.repartitionById(trainers, F.col("trainer")).sortWithinPartitions("o", "symbols").select("symbols")
        sums = dealt.mapInArrow(trained, "block int, sums binary, weight long").repartition("block")
        found = sums.mapInArrow(added, "block int, means binary").toArrow()  # one number for each weight
        flat = flat.copy()
        for block, means in zip(found["block"].to_pylist(), found["means"].to_pylist(), strict=True):
            flat[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(means)
        done += share
    return flat


def rare_sums(texts: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(id, tw, rare_log, rare_known): for words that tasks don't know, the sum of log10(count + 1) and the number of those in the training texts."""
    joined = texts.select("id", "tw", F.explode("rare").alias("word", "tf")).join(counts.where(~vocabulary.known()).hint("shuffle_hash"), "word")
    return joined.groupBy("id", "tw").agg(F.sum(F.col("tf") * F.log10(F.col("c") + 1.0)).alias("rare_log"), F.sum("tf").alias("rare_known"))


def network_scores(texts: DataFrame, flat: np.ndarray) -> DataFrame:
    """The rows of ``encoded`` with net_log in place of tail_log and symbols; net_log and dictionary_log lack the counts of rare words."""
    weights = texts.sparkSession.sparkContext.broadcast(flat)
    kept = ["id", "tw", "n_tokens", "dictionary_known", "dictionary_log"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network(unpacked(weights.value))
        for batch in batches:
            net = np.array(batch.column(len(kept)))
            rows = ((i, np.frombuffer(b, np.int16)) for i, b in enumerate(values(batch.column(len(kept) + 1))))
            with np.errstate(over="ignore"):
                for group in grouped(rows):
                    net[[i for i, _ in group]] += network.score([s for _, s in group]) / np.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(net)], [*kept, "net_log"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.select(*kept, "tail_log", "symbols").mapInArrow(scored, f"id {kind}, tw int, n_tokens long, dictionary_known long, dictionary_log double, net_log double")


def score(docs: DataFrame, training: Column, doc_id: str = "doc_id", text: str = "text", dictionary: int = DICTIONARY) -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs``, learned from the rows where ``training`` holds."""
    learned = docs.where(training)
    counts = stored(count_words(learned, text))
    vocabulary = Vocabulary(counts, dictionary)
    vocabulary.class_totals(counts)
    texts = stored(encoded(docs, training, vocabulary, doc_id, text))
    flat = fit(texts, vocabulary)
    rare = rare_sums(texts, counts, vocabulary)
    scored = stored(network_scores(texts, flat))
    # rows that share id and text have sent their rare words once each
    times = scored.groupBy("id", "tw").agg(F.count(F.lit(1)).alias("times"))
    same = F.col("r.id").eqNullSafe(F.col("n.id")) & (F.col("r.tw") == F.col("n.tw"))
    sums = rare.alias("r").join(times.alias("n"), same).select(F.col("r.id").alias("r_id"), F.col("r.tw").alias("r_tw"), (F.col("rare_log") / F.col("times")).alias("rare_log"), (F.col("rare_known") / F.col("times")).cast("long").alias("rare_known"))
    out = scored.join(sums, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("tw") == F.col("r_tw")), "left").na.fill(0, ["rare_log", "rare_known"])
    room = float(np.log10(vocabulary.n + vocabulary.v + 1))
    return out.select(
        "id", "n_tokens", (F.col("dictionary_known") + F.col("rare_known")).alias("n_known"), F.lit(vocabulary.n).cast("long").alias("train_tokens"),
        (F.col("dictionary_log") + F.col("rare_log") - F.col("n_tokens") * F.lit(room)).alias("base_score"), (F.col("net_log") + F.col("rare_log")).alias("score"),
    )
