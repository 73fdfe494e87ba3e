"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule rejects a text by one count. Cost and selectivity of each rule are estimated on a sample; then the rules run in order of rejections per cost,
and a text that one rule rejects is not looked at by the later, dearer ones. The order changes only the work, never the verdict.

A NULL text counts as empty: no words, so rejected. Texts are judged whole and one by one: repeated rows get equal verdicts; an empty table gives an
empty one. Equal rejection rates per cost keep the listed order.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relfold.llm.common import pieces, stored

SYMBOLS = "#*$%&|<>"
# The estimate reads this many documents at most, those with the smallest hashes of id and text.
SAMPLE_ROWS = 2000


def named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_chars(text: Column, cut: Column) -> Column:
    """Code points in words: all but the blanks, of which there is one less than pieces."""
    return (F.length(text) - F.size(cut) + 1).cast("long")


def symbol_count(text: Column) -> Column:
    """Symbols; a text without any is found by one search and not copied."""
    return F.when(text.rlike(r"[#*$%&|<>]"), F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).otherwise(0).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return named(_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def line_count(text: Column) -> Column:
    """Lines with a word."""
    return F.size(_lines(text)).cast("long")


def repeated_words(found: Column) -> Column:
    """Words in windows of three words that the text has twice or more.

    Equal hashes pick the windows that may repeat (none in most texts); those are sorted as text with their places, and equal neighbours are repeats.
    """

    def window(w: Column, i: Column) -> Column:
        return F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def exact(w: Column, at: Column) -> Column:
        def places(s: Column) -> Column:
            same = lambda x, i: F.coalesce(F.get(s, i - 1)["w"] == x["w"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["w"] == x["w"], F.lit(False))
            return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

        # a window covers three words, fewer where the next repeat starts before its end
        step = lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3))
        covered = lambda p: F.aggregate(F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), step), F.lit(0), lambda n, x: n + x)
        ordered = F.sort_array(F.transform(at, lambda i: F.struct(window(w, i).alias("w"), i.alias("i"))))
        return named(named(ordered, places), covered)

    def suspects(h: Column) -> Column:
        again = named(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1) == x, F.lit(False)))))
        every = F.sequence(F.lit(0), F.size(h) - 1)
        return named(again, lambda d: F.when(F.size(d) > 32, every).otherwise(F.filter(every, lambda i: F.array_contains(d, F.get(h, i)))))

    def counted(w: Column) -> Column:
        hashes = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return named(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(named(suspects(h), lambda at: exact(w, at))))

    return named(found, counted).cast("long")


@dataclass(frozen=True)
class Rule:
    """Rejects a text if ``test`` holds; ``test`` gets a function from a count's name to its column."""

    name: str
    test: Callable[[Callable[[str], Column]], Column]


# A rule of the corpus contract comes under its own name; the other bounds are the usual ones of web-text filters.
RULES = (
    Rule("few_words", lambda n: n("n_words") < 50),
    Rule("word_length", lambda n: (n("word_chars") < 2 * n("n_words")) | (n("word_chars") > 15 * n("n_words"))),
    Rule("symbols", lambda n: 10 * n("n_symbols") > n("n_words")),
    Rule("repeated_lines", lambda n: 10 * n("n_dup_lines") > 7 * n("n_lines")),
    Rule("repeated_words", lambda n: 100 * n("n_repeat_words") > 50 * n("n_words")),
)


def counts_of(text: Column, cut: Column, found: Column) -> dict[str, Column]:
    """Every count, from the text, its pieces and its words."""
    return {
        "n_words": F.size(found).cast("long"), "word_chars": word_chars(text, cut), "n_symbols": symbol_count(text), "n_dup_lines": duplicate_lines(text),
        "n_lines": line_count(text), "n_repeat_words": repeated_words(found),
    }


def on_text(text: str, body: Callable[[dict[str, Column]], Column]) -> Column:
    """``body`` of the counts of a text column; the text is cut into words once, and only counts that the body reaches are computed."""
    plain = F.coalesce(F.col(text), F.lit(""))
    return named(pieces(F.col(text)), lambda cut: named(F.array_remove(cut, ""), lambda found: body(counts_of(plain, cut, found))))


def rule_order(docs: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample of at most ``sample_rows`` documents; only the order hangs on it."""
    total = docs.count()
    if not total:
        return list(rules)
    share = max(total // max(sample_rows, 1), 1)
    picked = docs.select(doc_id, text).where(F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit("sample")), F.lit(share)) == 0).limit(sample_rows)
    sample = stored(picked)
    rated = []
    for place, rule in enumerate(rules):
        began = time.perf_counter()
        rejected = sample.agg(F.sum(on_text(text, lambda c, rule=rule: F.when(rule.test(c.__getitem__), 1).otherwise(0)))).first()[0] or 0
        rated.append((-rejected / max(time.perf_counter() - began, 1e-6), place, rule))
    return [rule for _, _, rule in sorted(rated, key=lambda x: x[:2])]


def rejected_by(order: Sequence[Rule], count: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects, NULL if none does; later rules are not evaluated for a rejected row."""
    found = F
    for rule in order:
        found = found.when(rule.test(count), F.lit(rule.name))
    return found.otherwise(F.lit(None).cast("string"))


def keep_good(docs: DataFrame, order: Sequence[Rule], text: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns."""
    return docs.where(on_text(text, lambda c: rejected_by(order, c.__getitem__)).isNull())


def judge(docs: DataFrame, order: Sequence[Rule], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, all counts, rejected_by, kept) of each row; here every count is wanted, so each is computed once and the cascade reads the results."""
    counts = on_text(text, lambda c: F.struct(*[v.alias(n) for n, v in c.items()]))
    counted = docs.select(F.col(doc_id).alias("doc_id"), counts.alias("c")).select("doc_id", "c.*")
    return counted.withColumn("rejected_by", rejected_by(order, F.col)).withColumn("kept", F.col("rejected_by").isNull())
