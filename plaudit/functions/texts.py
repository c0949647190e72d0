"""Splitting, cleaning and measuring strings and string lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EMPTY_LIST = "array<string>"


def empty_list() -> Column:
    return F.array().cast(EMPTY_LIST)


def split_list(value: Column, separator: str) -> Column:
    """Split on a literal separator; null stays null."""
    return F.split(value, "\\Q" + separator + "\\E")


def split_or_empty(value: Column, separator: str, blanks: tuple[str, ...] = ("",)) -> Column:
    """Split, with null and the given blank markers becoming an empty list."""
    return F.when(value.isNull() | value.isin(*blanks), empty_list()).otherwise(
        split_list(value, separator)
    )


def trimmed_items(items: Column) -> Column:
    """Trim every item and drop the ones left empty."""
    return F.filter(F.transform(items, lambda item: F.trim(item)), lambda item: item != "")


def code_points(value: Column) -> Column:
    """Length in code points of the whole text."""
    return F.char_length(value)


def review_length(reviews: DataFrame) -> Column:
    """Length of a review's text.

    The cleaning step stores `text_length`, which keeps the text itself out of
    scans and shuffles; tables without it are measured on the fly.
    """
    if "text_length" in reviews.columns:
        return F.col("text_length")
    return code_points(F.col("text"))


def digest(*columns: str, seed: int = 0) -> Column:
    """A reproducible hexadecimal hash of key columns, equal in any SQL engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))
