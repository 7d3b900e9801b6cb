"""Stylometric features of one text column; no shuffle, no Python."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkprint.constants import BAG_TOKEN_PATTERN, EMOJI_PATTERN, SPACE_CLASS
from inkprint.functions.rounding import round_binary

MAX_INLINE_WORDS = 5_000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uppercase_count(m) -> Column:
    return F.length(F.regexp_replace(col(m), r"[^\p{IsUppercase}]", "")).cast("long")


def char_count(m) -> Column:
    return F.length(col(m)).cast("long")


def word_length(m) -> Column:
    """Mean length of the words between white space, to two places; 0 without words."""
    letters = F.length(F.regexp_replace(col(m), f"[{SPACE_CLASS}]+", ""))
    words = F.regexp_count(col(m), F.lit(f"[^{SPACE_CLASS}]+"))
    return F.coalesce(round_binary(letters / F.nullif(words, F.lit(0))), F.lit(0.0))


def emoji_pattern(sequences: Iterable[str] | None = None) -> str:
    """What counts as one emoji: by the rules of how sequences are built, or the longest entry of a table of sequences.

    In a table, an entry with a presentation mark also stands for the sequence without it.
    """
    if sequences is None:
        return EMOJI_PATTERN
    entries = sorted({form for s in sequences if s for form in (s, s.replace("\ufe0f", ""))})
    return alternation(entries) if entries else "(?!)"


def emoji_list(m, sequences: Iterable[str] | None = None) -> Column:
    return F.regexp_extract_all(col(m), F.lit(emoji_pattern(sequences)), F.lit(0))


def emoji_count(m, sequences: Iterable[str] | None = None) -> Column:
    return F.regexp_count(col(m), F.lit(emoji_pattern(sequences))).cast("long")


def unique_emoji_count(m, sequences: Iterable[str] | None = None) -> Column:
    return F.size(F.array_distinct(emoji_list(m, sequences))).cast("long")


def with_clipped(words: Iterable[str]) -> list[str]:
    """The entries and each entry without its last character (dialect forms)."""
    words = [w for w in words if w]
    return sorted({*words, *[w[:-1] for w in words if len(w) > 1]})


def alternation(words: Iterable[str]) -> str:
    """A regex that matches the longest literal entry, of a list of any size.

    Entries share their beginnings, so a text position is compared with one path through the
    list and not with every entry.
    """
    root: dict = {}
    for word in words:
        node = root
        for c in word:
            node = node.setdefault(c, {})
        if word:
            node[""] = {}
    return _branches(root)


def _branches(node: dict) -> str:
    chain = ""
    while len(node) == 1 and "" not in node:  # no choice here
        (c, node), = node.items()
        chain += re.sub(r"([^\w\s])", r"\\\1", c)
    inner = "|".join(re.sub(r"([^\w\s])", r"\\\1", c) + _branches(child) for c, child in sorted(node.items()) if c)
    if not inner:
        return chain
    return f"{chain}(?:{inner})?" if "" in node else f"{chain}(?:{inner})"


def swear_count(m, words: Iterable[str]) -> Column:
    """Whole-entry, case-insensitive, non-overlapping occurrences."""
    entries = sorted({w.lower() for w in with_clipped(words)})
    if not entries:
        return F.lit(0).cast("long")
    return F.regexp_count(col(m), F.lit(rf"(?iU)\b(?:{alternation(entries)})\b")).cast("long")


def bag_tokens(m) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(col(m)), F.lit(BAG_TOKEN_PATTERN), F.lit(0))


def clip(x, low, high) -> Column:
    return F.greatest(F.least(col(x), F.lit(high)), F.lit(low))


def log_odds(p, low: float = 0.001, high: float = 0.999) -> Column:
    p = clip(p, low, high)
    return F.ln(p / (1 - p))
