"""Helpers shared by the operators: tables, scratch tables, column names, word rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.session import discard, materialise, shuffles_dropped

__all__ = ["ascii_lower", "discard", "fresh", "let", "materialise", "shuffles_dropped", "table", "word_count", "words"]

# ASCII white space, the only separators of words: space and \t \n \v \f \r.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that `df` does not have (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text, in order; no words for an empty, blank or NULL text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def word_count(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, BLANK_RUN))).cast("long")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]
