"""Corpora of scripts: read texts, write statements."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from segmill.functions import text as T
from segmill.operators.joins import bounded_broadcast
from segmill.sources.config import JobConfig
from segmill.sources.staging import stage

# A file read as one value; larger ones would not fit a task.
MAX_SCRIPT_BYTES = 1 << 28
# A packed file holds so many bytes of texts (one text may have more).
PACK_BYTES = 1 << 26
# On a local disk Hadoop starts a process to set the mode of each file, and another for that of the
# file with its checksums; written so, there is none of the latter.  Other file systems ignore it.
ONE_FILE_EACH = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true",
}
# Into how many tasks Spark deals the listing of many folders.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_scripts(
    spark: SparkSession, path: str, by: str = "file", max_bytes: int = MAX_SCRIPT_BYTES,
    cfg: JobConfig | None = None,
) -> DataFrame:
    """``(script_id, text)`` per file, or ``(script_id, line_no, text)`` per line.

    ``script_id`` is the file's path.  Line ends become a single line feed.  By
    file, a file is one value: one of more than ``max_bytes`` is an error, found
    before any is read.  By line, files may have any size (see ``read_numbered_lines``).
    """
    if by == "line":
        return read_numbered_lines(spark, path, cfg or JobConfig())
    with _listing(spark):
        sizes = spark.read.format("binaryFile").load(path).select("path", "length")
        texts = spark.read.text(path, wholetext=True)
    large = sizes.where(F.col("length") > max_bytes).first()
    if large is not None:
        raise ValueError(f"{large['path']} has {large['length']} bytes; the limit is {max_bytes}")
    return texts.select(
        F.col("_metadata.file_path").alias("script_id"),
        T.unix_newlines(F.col("value")).alias("text"),
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(script_id, text)`` per line, in no order: large files are split over tasks."""
    with _listing(spark):
        lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_path").alias("script_id"), F.col("value").alias("text"))


def read_numbered_lines(spark: SparkSession, path: str, cfg: JobConfig) -> DataFrame:
    """``(script_id, line_no, text)``: lines numbered from 0, of files of any size.

    A large file is read in many splits, none of which knows its first line's
    number.  The lines are staged with their split and place; a narrow pass counts
    each split's lines, sums over the splits before it give its first number, and
    the lines add it to their place.  No file is one value, only a line is.
    """
    with _listing(spark):
        lines = spark.read.text(path)
    lines = lines.select(
        F.col("_metadata.file_path").alias("script_id"), F.col("_metadata.file_block_start").alias("split"),
        # Grows along a split, as a task reads its splits from start to end.
        F.monotonically_increasing_id().alias("place"), F.col("value").alias("text"),
    )
    # Without a fingerprint of its own: places differ from one reading to the next.
    lines = stage(lines, cfg, f"lines-{uuid.uuid4().hex}")
    splits = lines.groupBy("script_id", "split").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first_place")
    )
    before = Window.partitionBy("script_id").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    first = splits.select(
        "script_id", "split", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_place")).alias("shift")
    )
    first = stage(first, cfg, f"splits-{uuid.uuid4().hex}")
    return lines.join(bounded_broadcast(first), ["script_id", "split"]).select(
        "script_id", (F.col("place") + F.col("shift")).alias("line_no"), "text"
    )


def split_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, line_no, text)``; the empty rest after a last line end is no line."""
    parts = T.lines(F.col(text_col))
    whole = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(
        parts
    )
    return df.select(id_col, F.posexplode(whole).alias("line_no", "text"))


def render_statements(
    df: DataFrame, id_col: str, statements_col: str, separator: str = "\n\n",
    terminal: bool = False,
) -> DataFrame:
    """``(id, text)``: each script's statement array as one text, without a shuffle."""
    rendered = T.join_statements(F.col(statements_col), separator, terminal)
    return df.select(id_col, rendered.alias("text"))


def write_statements(
    df: DataFrame, path: str, id_col: str, statements_col: str, separator: str = "\n\n",
    terminal: bool = False, mode: str = "errorifexists",
) -> None:
    """Write the rendered texts, one folder ``<id_col>=<id>`` with one file per script.

    Ids must be distinct, or their texts end up in one folder.
    """
    texts = render_statements(df, id_col, statements_col, separator, terminal)
    # Only files with an id of their own tell the scripts apart.
    write_files(texts, path, id_col, mode)


def write_files(df: DataFrame, path: str, id_col: str, mode: str = "errorifexists") -> None:
    """Write the one other column's texts, one folder ``<id_col>=<id>`` with one file per id.

    A file costs about as much whatever it holds.  The rows are therefore dealt by
    id to a fixed number of tasks (the session's shuffle partitions, or its cores
    if they are more); by bytes, many short texts would be one task's work.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = df.repartition(tasks, id_col).write.mode(mode).options(**ONE_FILE_EACH)
    dealt.partitionBy(id_col).text(path, lineSep="\n")


def write_packed(
    df: DataFrame, path: str, id_col: str, text_col: str, cfg: JobConfig, mode: str = "errorifexists",
    pack_bytes: int = PACK_BYTES,
) -> None:
    """Write many texts per file: ``path/texts`` holds the files, ``path/index`` says where each text is.

    The index has ``(id, pack, offset, length)``, in bytes.  A text is followed by
    a line feed.  There are as many files as the texts need at ``pack_bytes`` each.
    Ids may repeat (each row has its entry) and be null; null texts are empty.
    """
    texts = df.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = stage(texts.withColumn("place", F.monotonically_increasing_id()), cfg, f"unpacked-{uuid.uuid4().hex}")
    length = F.octet_length("text").cast("long")
    total = texts.agg(F.sum(length + 1)).first()[0] or 0
    packs = max(1, -(-total // pack_bytes))
    pack = F.pmod(F.xxhash64("place"), F.lit(packs)).cast("int")
    packed = texts.withColumn("pack", pack)
    before = Window.partitionBy("pack").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    index = packed.select(id_col, "pack", "place", length.alias("length")).select(
        id_col, "pack", F.coalesce(F.sum(F.col("length") + 1).over(before), F.lit(0)).alias("offset"), "length"
    )
    # A pack is one task's, in the order its offsets are counted in.
    ordered = packed.repartition(packs, "pack").sortWithinPartitions("pack", "place").select("pack", "text")
    ordered.write.mode(mode).partitionBy("pack").text(f"{path}/texts", lineSep="\n")
    index.write.mode(mode).parquet(f"{path}/index")


def read_packed(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """``(id, text)`` of all packed texts, or of those whose id is in the one column of ``ids``.

    Only files with wanted texts are read, each once; a text is cut out by its
    bytes, so it may hold anything.
    """
    index = spark.read.parquet(f"{path}/index")
    id_col = index.columns[0]
    if ids is not None:
        index = index.join(ids.toDF(id_col).distinct(), id_col, "left_semi")
    entries = index.groupBy("pack").agg(F.collect_list(F.struct(id_col, "offset", "length")).alias("entries"))
    files = spark.read.format("binaryFile").load(f"{path}/texts").select("pack", "content")
    at = F.substring(F.col("content"), F.col("entry.offset").cast("int") + 1, F.col("entry.length").cast("int"))
    return files.join(entries, "pack").select(
        "content", F.explode("entries").alias("entry")
    ).select(F.col(f"entry.{id_col}").alias(id_col), at.cast("string").alias("text"))


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core: by default each of up to 10,000 has a task of its own."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)
