"""Script-mining jobs over a table of texts ``(id, text)``.

Extraction is row-local: texts are neither shuffled nor taken apart into rows
of lines or characters, so the size of one text bounds the work of one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmill.functions import text as T


def extract(
    df: DataFrame, id_col: str, text_col: str, how: Callable[[Column], Column] = T.fragments
) -> DataFrame:
    """``(id, pos, statement)`` for what ``how`` finds in each text, in text order."""
    return df.select(id_col, F.posexplode(how(F.col(text_col))).alias("pos", "statement"))


def extract_arrays(
    df: DataFrame, id_col: str, text_col: str, how: Callable[[Column], Column] = T.fragments
) -> DataFrame:
    """``(id, statements)``, one row per text."""
    return df.select(id_col, how(F.col(text_col)).alias("statements"))


def frequency(
    df: DataFrame, text_col: str, how: Callable[[Column], Column] = T.method_calls,
    out: str = "name",
) -> DataFrame:
    """``(name, n)``: how often each extracted name occurs in the corpus."""
    names = df.select(F.explode(how(F.col(text_col))).alias(out))
    return names.groupBy(out).agg(F.count(F.lit(1)).alias("n"))


def vocabulary(df: DataFrame, text_col: str) -> DataFrame:
    """``(ch, idx)``: the corpus' characters, numbered from 0 by code point.

    Texts are taken apart by line, so that a long one never stands in memory as
    an array of characters, and each line is reduced to its own alphabet before
    the shuffle.  The ranking sees one row per character of the alphabet, of
    which Unicode has 1.1 million.
    """
    lines = df.select(F.explode(T.lines_with_ends(F.col(text_col))).alias("line"))
    alphabet = lines.select(F.explode(F.array_distinct(T.chars(F.col("line")))).alias("ch"))
    rank = F.row_number().over(Window.orderBy("ch")) - 1
    return alphabet.distinct().select("ch", rank.alias("idx"))


def ids_by_code_point(vocab: DataFrame) -> Column:
    """The vocabulary as a constant array indexed by code point.

    Indexing costs the same for every alphabet, unlike a map lookup.  The array
    ends at the highest code point, so it has at most 1.1 million entries; it is
    computed when called and is part of the plan, not of the rows.
    """
    entry = F.struct(F.ascii("ch").alias("code"), "idx")
    entries = vocab.agg(F.array_sort(F.collect_list(entry)).alias("entries"))

    def with_gap(e: Column, i: Column) -> Column:
        following = F.coalesce(F.get(F.col("entries"), i + 1)["code"], e["code"] + 1)
        return F.concat(
            F.array(e["idx"]), F.array_repeat(F.lit(0), following - e["code"] - 1)
        )

    leading = F.array_repeat(F.lit(0), F.get(F.col("entries"), F.lit(0))["code"])
    dense = F.concat(leading, F.flatten(F.transform("entries", with_gap)))
    return _constant(entries.select(dense.alias("ids")), "array<int>")


def chars_by_id(vocab: DataFrame) -> Column:
    """The vocabulary's characters in id order, as a constant array."""
    entries = F.array_sort(F.collect_list(F.struct("idx", "ch")))
    return _constant(vocab.agg(F.transform(entries, lambda e: e["ch"]).alias("chars")), "array<string>")


def _constant(array: DataFrame, kind: str) -> Column:
    """The only value of a frame as a literal; an empty array for NULL."""
    text = array.select(F.to_json(array.columns[0])).first()[0]
    return F.from_json(F.lit(text or "[]"), kind)


def longest(df: DataFrame, text_col: str) -> Column:
    """Length of the longest text (a scalar subquery)."""
    return df.agg(F.max(F.char_length(text_col)).alias("longest")).scalar()


def encode(
    df: DataFrame, text_col: str, vocab: DataFrame, out: str = "ids", pad_to: Column | None = None
) -> DataFrame:
    """Add the texts' character ids, padded if ``pad_to`` is given (see ``longest``).

    The vocabulary is computed when called.
    """
    ids = T.encode_chars(F.col(text_col), ids_by_code_point(vocab))
    if pad_to is not None:
        ids = T.pad_ids(ids, F.char_length(text_col), pad_to)
    return df.withColumn(out, ids)


def decode(df: DataFrame, ids_col: str, vocab: DataFrame, out: str = "text") -> DataFrame:
    """Add the text an id sequence stands for.  The vocabulary is computed when called."""
    return df.withColumn(out, T.decode_ids(F.col(ids_col), chars_by_id(vocab)))
