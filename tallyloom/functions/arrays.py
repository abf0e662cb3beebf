"""List and label expressions that work on one row at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]+"  # a run of letters, digits and underscores
LONG_WORD = r"[\p{L}\p{N}_]{2,}"  # the same, two characters at least


def split_list(text: Column, mark: str = "#") -> Column:
    return F.split(text, "\\Q" + mark + "\\E")


def join_list(values: Column, mark: str = " ") -> Column:
    return F.concat_ws(mark, values)


# An entry of a list text, in single or double quotes, with backslash escapes.
_ENTRY = r"""(?:'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+")"""
_LIST = rf"(?s)^\s*\[\s*(?:{_ENTRY}\s*(?:,\s*{_ENTRY}\s*)*+,?\s*)?+\]\s*$"


def parse_list_text(text: Column) -> Column:
    """Array from list text such as ['a', "O'Reilly"]; text of any other form is an error, null stays null."""

    def entry(quoted: Column) -> Column:
        inner = F.substr(quoted, F.lit(2), F.char_length(quoted) - 2)
        for written, meant in (("n", "\n"), ("t", "\t"), ("r", "\r")):  # behind an even number of backslashes
            inner = F.regexp_replace(inner, rf"(?<!\\)((?:\\\\)*+)\\{written}", "$1" + meant)
        return F.regexp_replace(inner, r"(?s)\\(.)", "$1")

    entries = F.transform(F.regexp_extract_all(text, F.lit(rf"(?s){_ENTRY}"), F.lit(0)), entry)
    wrong = F.raise_error(F.concat(F.lit("not a list: "), F.substring(text, 1, 100))).cast("array<string>")
    return F.when(text.isNull() | F.rlike(text, F.lit(_LIST)), entries).otherwise(wrong)


def words(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def computed_once(value: Column, build: Callable[[Column], Column]) -> Column:
    """build(value) with the value bound to a lambda variable, for values that are costly to repeat."""
    return F.transform(F.array(value), build).getItem(0)


def with_bigrams(tokens: Column) -> Column:
    """The tokens followed by every pair of neighbours, joined by a space."""

    def build(t: Column) -> Column:
        pairs = F.greatest(F.size(t) - 1, F.lit(0))
        left, right = F.slice(t, F.lit(1), pairs), F.slice(t, F.lit(2), pairs)
        return F.concat(t, F.zip_with(left, right, lambda a, b: F.concat_ws(" ", a, b)))

    return computed_once(tokens, build)


def pad_left(ids: Column, length: int) -> Column:
    """The last `length` ids, with zeros in front of shorter lists."""
    ids = F.coalesce(ids, F.array().cast("array<bigint>"))
    n = F.size(ids)
    kept = F.slice(ids, F.greatest(n - F.lit(length) + 1, F.lit(1)), F.lit(length))
    zeros = F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(length) - n, F.lit(0)))
    return F.concat(zeros, kept)


def best_class(scores: Column) -> Column:
    """1-based position of the largest score, the first one on ties."""
    return F.array_position(scores, F.array_max(scores)).cast("long")
