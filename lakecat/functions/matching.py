"""Which of many keywords a string holds, as places in the keyword list.

`contains` per keyword reads a string once per keyword: right for names. In long texts one regular expression finds the
longest keyword at every place, and each keyword found brings those that it begins with.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from lakecat.functions.rules import Rules


def all_words(rules: Rules) -> list[str]:
    """Every keyword of a rule set once, in rule order."""
    return list(dict.fromkeys(word for words in rules.values() for word in words))


def name_hits(name: Column, words: list[str]) -> Column:
    """array<int>: places in `words` of those that are substrings of `name`."""
    listed = F.lit(words)
    return F.filter(F.sequence(F.lit(0), F.lit(len(words) - 1)), lambda place: F.contains(name, F.get(listed, place)))


def _choice(words: list[str], width: int = 4) -> str:
    """A pattern of the longest of some words, tried by their first letters: a few letters are told apart at a time."""
    ends = "" in words
    by_letter: dict[str, list[str]] = {}
    for word in sorted(set(words) - {""}):
        by_letter.setdefault(word[0], []).append(word[1:])
    parts = [re.escape(letter) + _choice(rest) for letter, rest in by_letter.items()]
    letters = list(by_letter)
    while len(parts) > width:  # tell groups of letters apart before single ones
        groups = [range(i, min(i + width, len(parts))) for i in range(0, len(parts), width)]
        spans = ["".join(letters[i] for i in group) for group in groups]
        parts = [f"(?=[{re.escape(span)}])(?:{'|'.join(parts[i] for i in group)})" for span, group in zip(spans, groups)]
        letters = spans
    if not parts:
        return ""
    body = parts[0] if len(parts) == 1 and not ends else f"(?:{'|'.join(parts)})"
    return f"{body}?" if ends else body


def text_hits(text: Column, words: list[str]) -> Column:
    """As `name_hits`, for long texts; in no order."""
    begins = F.create_map(*[
        part for word in words
        for part in (F.lit(word), F.lit([place for place, other in enumerate(words) if word.startswith(other)]))])
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=({_choice(words)}))"), F.lit(1)))
    return F.array_distinct(F.flatten(F.transform(found, lambda word: F.element_at(begins, word))))


def hit_count(hits: Column, words: list[str], of: list[str]) -> Column:
    """How many of the words `of` one domain are among the hits."""
    return F.size(F.array_intersect(hits, F.lit([words.index(word) for word in of])))
