"""Text helpers that give Python's answers with Spark expressions.

The source data was cleaned with Python string methods, so trimming, title
case and ``\\d``/``\\s``/``\\b`` are Unicode-aware here: every pattern that needs
it carries Java's ``(?U)`` flag.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Python counts the four ASCII separator controls as white space, Java does not.
SPACE = r"[\s\x1C-\x1F]"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"


def trimmed(col: Column) -> Column:
    """``str.strip()``."""
    return F.regexp_replace(col, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def titled(col: Column) -> Column:
    """``str.title()``: a capital after anything that is not a letter ("O'Brien")."""
    runs = F.regexp_extract_all(col, F.lit(f"[{_CASED}]+|[^{_CASED}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def single_spaced(col: Column) -> Column:
    return F.regexp_replace(col, rf"(?U){SPACE}+", " ")


def digits(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)\D", "")


def alphanumerics(col: Column) -> Column:
    """Upper case with everything but A-Z and 0-9 removed."""
    return F.regexp_replace(F.upper(col), "[^A-Z0-9]", "")


def first_match(col: Column, pattern: str, keep_original: bool = False) -> Column:
    """The first match of ``pattern``; without one the original text, or null.

    The pattern must not match the empty text.
    """
    found = F.nullif(F.regexp_extract(col, pattern, 0), F.lit(""))
    return F.coalesce(found, col) if keep_original else found


def keyword_name(
    col: Column, keywords: Sequence[tuple[str, str]], keep_original: bool = False
) -> Column:
    """Name of the first entry whose phrase occurs as a whole word, in any case.

    One pattern finds every listed phrase in the text, also overlapping ones;
    the smallest list position among them wins.
    """
    phrases = [phrase.lower() for _, phrase in keywords]
    for phrase in phrases:
        if any(other.startswith(phrase + " ") for other in phrases):
            raise ValueError(f"keyword {phrase!r} begins another keyword")
    listed = "|".join(re.escape(phrase) for phrase in phrases)
    found = F.regexp_extract_all(F.lower(col), F.lit(rf"(?U)\b(?=({listed})\b)"), F.lit(1))
    names, known = F.expr(_array(name for name, _ in keywords)), F.expr(_array(phrases))
    place = F.array_min(F.transform(found, lambda phrase: F.array_position(known, phrase)))
    name = F.when(place > 0, F.element_at(names, place.cast("int")))
    return F.coalesce(name, col) if keep_original else name


def keyword_set_name(
    col: Column,
    keywords: Sequence[tuple[str, Sequence[Sequence[str]]]],
    keep_original: bool = False,
) -> Column:
    """Name of the first entry of which any set has all of its words in the text.

    One pattern collects the listed words that occur; only texts with at least
    one of them are compared with the sets.
    """
    sets = [
        (name, [word.lower() for word in words]) for name, options in keywords for words in options
    ]
    listed = "|".join(re.escape(word) for word in dict.fromkeys(w for _, ws in sets for w in ws))
    present = F.regexp_extract_all(F.lower(col), F.lit(rf"(?U)\b(?:{listed})\b"), F.lit(0))
    options = F.expr(
        "array("
        + ", ".join(f"struct({_text(name)} AS name, {_array(words)} AS words)" for name, words in sets)
        + ")"
    )

    def first_complete(words: Column) -> Column:
        complete = F.filter(
            options, lambda option: F.forall(option["words"], lambda w: F.array_contains(words, w))
        )
        return F.when(F.size(words) > 0, F.try_element_at(complete, F.lit(1))["name"])

    # The one-element array binds the found words, so that they are found once.
    name = F.element_at(F.transform(F.array(present), first_complete), 1)
    return F.coalesce(name, col) if keep_original else name


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(values: Iterable[str]) -> str:
    return "array(" + ", ".join(_text(value) for value in values) + ")"


def recode(col: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Replace exact values; everything else stays."""
    chain = None
    for old, new in pairs:
        chain = F.when(col == old, new) if chain is None else chain.when(col == old, new)
    return col if chain is None else chain.otherwise(col)


def null_where(df: DataFrame, pattern: str) -> DataFrame:
    """Turn string cells that match ``pattern`` into nulls, in every string column."""
    strings = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(
        *(
            F.when(~F.col(f"`{name}`").rlike(pattern), F.col(f"`{name}`")).alias(name)
            if name in strings
            else F.col(f"`{name}`")
            for name in df.columns
        )
    )
