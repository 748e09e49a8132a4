"""Keys and display names as native Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark import constants as C

_REST = 2**31 - 1  # length that reaches the end of any string
_MARK = "\ue000"  # a private character, never part of an ASCII text


def entity_key(
    title_id: str = "title_id", season: str = "season_number", content_category: str = "content_category"
) -> Column:
    """Key of one season of a series, or of a title that has no seasons.

    Both branches are strings, so a numeric id cannot turn the key into a number. A series without a season
    number has no key: NULL propagates through ``concat``.
    """
    plain = F.col(title_id).cast("string")
    seasonal = F.concat(plain, F.lit(C.KEY_SEPARATOR), F.col(season).cast("string"))
    return F.when(F.col(content_category) == C.CATEGORY_SERIES, seasonal).otherwise(plain)


def title_season_name(title: str = "title_name", season: str = "season_number") -> Column:
    """Title with its season suffix; titles without a positive season number keep their name."""
    suffixed = F.concat(F.col(title), F.lit(C.SEASON_PREFIX), F.col(season).cast("string"))
    return F.when(F.col(season) > 0, suffixed).otherwise(F.col(title))


def initcap(column: str | Column, delimiters: str | None = C.WORD_ENDS) -> Column:
    """Title-case. ``delimiters`` names every character that ends a word; None splits at blanks only.

    In ASCII texts a marked blank after each other delimiter lets the native function, which knows blanks only, begin a
    word there; the mark is no ASCII character, so no such text holds it. Other texts are cased word by word, because
    a letter that grows when it is raised, or whose small form depends on its neighbours, needs its word's borders.
    """
    text = F.col(column) if isinstance(column, str) else column
    if delimiters is None:
        return F.initcap(text)
    by_word = _each_word(text, delimiters)
    if " " not in delimiters:  # the native function would end a word at a blank
        return by_word
    return F.when(_is_ascii(text), _marked_words(text, delimiters)).otherwise(by_word)


def _is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def _marked_words(text: Column, delimiters: str) -> Column:
    others = "".join(re.escape(c) for c in delimiters if c != " ")
    if not others:
        return F.initcap(text)
    marked = F.regexp_replace(text, f"([{others}])(?=[A-Za-z])", f"$1{_MARK} ")
    return F.replace(F.initcap(marked), F.lit(f"{_MARK} "), F.lit(""))


def _each_word(text: Column, delimiters: str) -> Column:
    ends = "".join(re.escape(c) for c in delimiters)
    pieces = F.regexp_extract_all(text, F.lit(f"[{ends}]|[^{ends}]+"), F.lit(0))
    words = F.transform(
        pieces, lambda word: F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, _REST)))
    )
    return F.array_join(words, "")


def lowercase_columns(df: DataFrame) -> DataFrame:
    """The same rows under lower-case column names."""
    return df.toDF(*[name.lower() for name in df.columns])
