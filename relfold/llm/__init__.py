"""Operators for large text corpora: language, decontamination, mixing, secrets, near copies, URL lists, language-model scores, quality, HTML text, repeats,
fill-in-the-middle, tokenizer alignment, byte-pair encoding.

Each operator takes tables with at least the columns it names, keeps its own general interface and never looks at other columns, so extra columns and
clashing names do no harm. ``queries`` holds the thin queries.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
