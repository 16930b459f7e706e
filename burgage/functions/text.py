"""Text expressions: capitalisation, padding, labels, header names."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: characters after which a new word starts, besides the blank ----
WORD_BREAKS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>\t\n\r"

# Put after each break so that Spark's blank-based rule sees a new word, then taken out again.
# The control character counts as a break itself: one that is in the data gets a marker of its
# own, so taking the markers out restores the text exactly.
_CONTROL = "\x01"
_MARK = _CONTROL + " "
_BREAK_PATTERN = "([" + "".join(
    "\\" + ch if ch in "\\^-[]&~" else ch for ch in WORD_BREAKS + _CONTROL) + "])"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def initcap_words(c: Column | str, mode: str = "punctuation") -> Column:
    """Capitalise each word.

    mode="space" is Spark's own rule (words are split at blanks only). mode="punctuation" also
    starts a word after punctuation: `FOOD/BEVERAGE hndlng` -> `Food/Beverage Hndlng`. It puts a
    marker with a blank after each break, uses `initcap`, and removes the markers, which keeps
    the whole expression in generated code (no arrays, no lambda).
    """
    c = _column(c)
    if mode == "space":
        return F.initcap(c)
    if mode != "punctuation":
        raise ValueError(f"unknown mode {mode!r}")
    marked = F.regexp_replace(c, _BREAK_PATTERN, "$1" + _MARK)
    return F.replace(F.initcap(marked), F.lit(_MARK), F.lit(""))


def zero_fill(c: Column | str, width: int = 3) -> Column:
    """Left-pad with zeros; text that is already long enough stays whole."""
    s = _column(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def label_for(c: Column | str, labels: Mapping[str, str]) -> Column:
    """Look a code up in a small constant map; unknown codes are their own label."""
    c = _column(c)
    entries = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), c), c)


def clean_header(name: str) -> str:
    """`" Issued Date"` -> `issued_date`; `"Neighborhoods - Analysis Boundaries"` ->
    `neighborhoods_analysis_boundaries`."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")
