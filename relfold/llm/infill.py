"""Fill-in-the-middle: texts cut into prefix, middle and suffix at places that follow from the id, and written in the order a model is trained on.

A text is a row of units (runs of letters, or one other code point). ``regexp_count`` gives their number n; the two cuts a <= b are unit counts. A pattern
made for each row, with possessive groups ``unit{a}`` and ``unit{b-a}``, then captures all three parts in one match, and the match is replaced by its parts
in the new order, each behind its mark. Everything is built-in SQL functions.

Texts that already hold a mark stay as they are (``plain``), as do empty ones and the share that the id leaves plain. No mark can arise where a part meets a
mark (none begins as another ends), so the written text falls apart at the marks into the very parts. NULL texts count as empty, a NULL id as the empty id.
Rows are treated one by one: repeated rows get equal results, an empty table gives an empty one, and other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
ANY_MARK = "<[PSM]>"
# Parts in the order written: prefix-suffix-middle, and suffix-prefix-middle.
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
GROUPS = {"prefix": 1, "middle": 2, "suffix": 3}


def id_numbers(doc_id: Column) -> list[Column]:
    """Four numbers below 2^32 from the hash of an id."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def cut_pattern(a: Column, b: Column) -> Column:
    """The pattern of one row: a units, b - a units, and the rest."""
    return F.concat(F.lit(rf"\A({UNIT}{{"), a.cast("string"), F.lit(rf"}}+)({UNIT}{{"), (b - a).cast("string"), F.lit(r"}+)((?s:.*+))\z"))


def written_as(form: str) -> Column:
    """The replacement text that writes the captured parts in the order of a form."""
    return F.lit("".join(f"{MARKS[part]}${GROUPS[part]}" for part in ORDERS[form]))


def parts_of(form: Column, output: Column) -> dict[str, Column]:
    """The parts of a written text, by name; NULL for plain ones."""
    found = F.split(output, ANY_MARK, -1)
    place = lambda part: F.when(form == "psm", found[ORDERS["psm"].index(part) + 1]).when(form == "spm", found[ORDERS["spm"].index(part) + 1])
    return {part: place(part) for part in GROUPS}


def restored(form: Column, output: Column) -> Column:
    """The text from which a written text was made, from nothing but that and its form."""
    parts = parts_of(form, output)
    return F.when(form == "plain", output).otherwise(F.concat(*parts.values()))


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of each row; the lengths are code points, NULL in plain rows."""
    h = id_numbers(F.col("id"))
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    counted = rows.select("id", "t", F.regexp_count("t", F.lit(UNIT)).cast("long").alias("n"), *[x.alias(f"h{k}") for k, x in enumerate(h, 1)])
    stays = (F.col("t") == "") | F.col("t").rlike(ANY_MARK) | (F.col("h3") % 100 >= 100 - plain_percent)
    form = F.when(stays, "plain").when(F.col("h4") % 100 < spm_percent, "spm").otherwise("psm")
    cuts = [F.col(f"h{k}") % (F.col("n") + 1) for k in (1, 2)]
    cut = counted.select("id", "t", "n", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    order = F.when(F.col("form") == "spm", written_as("spm")).otherwise(written_as("psm"))
    done = F.when(F.col("form") == "plain", F.col("t")).otherwise(F.regexp_replace("t", cut_pattern(F.col("a"), F.col("b")), order))
    out = cut.select("id", "n", "form", done.alias("output"))
    parts = parts_of(F.col("form"), F.col("output"))
    return out.select("id", "n", "form", *[F.length(parts[p]).cast("long").alias(f"{p}_chars") for p in ("prefix", "middle")], "output")
