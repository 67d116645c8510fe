"""Scans of texts that are cut into pieces, so that one text spans many tasks.

A text is ``(id, piece, text)`` rows, in the order of ``piece``.  What a scan knows
at a piece's start is a small state, and what a piece does to a state is a small
function: it turns the quote parity or not; it opens or closes a comment, or
neither; it leaves a block open, or none, or as it was.  Such functions compose
associatively, so running sums and last values over one narrow row a piece give
every piece its state; then the pieces are scanned by themselves.  What crosses a
cut is put together from the piece it starts in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmill.functions import text as T
from segmill.sources.config import JobConfig
from segmill.sources.staging import stage, staged_name


def cut_texts(df: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``(id, piece, text)``: texts cut after every ``length`` characters."""
    text = F.col(text_col)
    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{length}}}"), F.lit(0))
    return df.select(id_col, F.posexplode(parts).alias("piece", "text"))


def cut_at_lines(df: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """``(id, piece, text)``: texts cut at the first line end after every ``length`` characters."""
    parts = F.regexp_extract_all(F.col(text_col), F.lit(f"(?s).{{1,{length}}}[^\\n]*(?:\\n|\\z)"), F.lit(0))
    return df.select(id_col, F.posexplode(parts).alias("piece", "text"))


def lines_to_pieces(lines: DataFrame, id_col: str, per_piece: int = 10_000) -> DataFrame:
    """``(id, piece, text)`` of numbered lines ``(id, line_no, text)``, whole lines in a piece."""
    piece = F.floor(F.col("line_no") / per_piece).cast("long")
    entries = F.array_sort(F.collect_list(F.struct("line_no", "text")))
    return lines.groupBy(id_col, piece.alias("piece")).agg(
        F.concat(F.array_join(F.transform(entries, lambda e: e["text"]), "\n"), F.lit("\n")).alias("text")
    )


def scan_statements(pieces: DataFrame, id_col: str, cfg: JobConfig) -> DataFrame:
    """``(id, pos, statement)``: ``text.scan_statements`` of the whole texts.

    Pieces may end anywhere, but none is empty.  Only what no cut crosses is held
    back by no other piece; a statement is one value, a text is not.
    """
    pieces = _staged(pieces, id_col, cfg)
    earlier = Window.partitionBy(id_col).orderBy("piece")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    # The last character matters to the next piece: a quote may be escaped by it, or a
    # comment opened or closed with it.
    ends = pieces.select(id_col, "piece", F.right("text", F.lit(1)).alias("last")).select(
        "*", F.coalesce(F.lag("last").over(earlier), F.lit("")).alias("previous")
    )
    ahead = F.when(F.col("previous").isin("\\", "/"), F.col("previous")).otherwise("")
    text = F.concat("ahead", "text")
    quotes = F.regexp_count(text, F.lit(r"""(?<!\\)["']"""))
    # What the last of the marks does; a mark may begin with the character ahead.
    event = F.regexp_extract(text, r"(?s)\A.*(//|/\*|\n)", 1)
    functions = _join(pieces, ends, id_col, ahead.alias("ahead")).select(
        id_col, "piece", "ahead", F.pmod(quotes, F.lit(2)).alias("turns"), _last_event(text, event).alias("opens"),
    )
    states = functions.select(
        id_col, "piece", "ahead",
        F.pmod(F.coalesce(F.sum("turns").over(before), F.lit(0)), F.lit(2)).alias("quoted"),
        F.coalesce(F.last("opens", ignorenulls=True).over(before), F.lit(0)).alias("comment"),
    )
    # A comment mark and a quote bring the row-local scan into the state; the digit
    # parts them from what comes.
    entered = F.concat(
        F.when(F.col("comment") == 1, "//").otherwise(""), F.when(F.col("quoted") == 1, '"').otherwise(""),
        F.lit("0"), "ahead", "text",
    )
    kept = _join(pieces, states, id_col, "ahead", "quoted", "comment").select(
        id_col, "piece", F.split(T.scanned(entered), ";", -1).alias("parts")
    )
    kept = stage(kept, cfg, staged_name(kept, cfg, "scanned"))
    # The first part goes on with what the pieces before left open.
    open_ = F.when(F.size("parts") > 1, F.struct("piece", (F.size("parts") - 1).alias("nth")))
    at_start = F.coalesce(
        F.last("open", ignorenulls=True).over(before),
        F.struct(F.first("piece").over(earlier).alias("piece"), F.lit(0).alias("nth")),
    )
    homes = kept.select(id_col, "piece", open_.alias("open")).select(id_col, "piece", at_start.alias("home"))
    linked = _join(kept, homes, id_col, "home").select(id_col, "piece", "home", F.posexplode("parts").alias("nth", "part"))
    home = F.when(F.col("nth") == 0, F.col("home")).otherwise(F.struct("piece", "nth"))
    whole = _put_together(linked.select(id_col, home.alias("home"), "piece", "part"), id_col)
    statements = whole.where("statement <> ''").withColumn("statement", F.trim("statement"))
    return _numbered(statements, id_col, cfg)


def line_blocks(
    pieces: DataFrame, id_col: str, cfg: JobConfig, keywords: Sequence[str] = T.BLOCK_KEYWORDS,
    endings: Sequence[str] = T.BLOCK_ENDINGS,
) -> DataFrame:
    """``(id, pos, statement)``: ``text.line_blocks`` of the whole texts.  Pieces are whole lines."""
    pieces = _staged(pieces, id_col, cfg)
    before = Window.partitionBy(id_col).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    text = F.col("text")
    # A piece without an ending leaves an open block open; any other decides by what follows its last one.
    tail, lead = T.trailing_open(text, keywords, endings), T.leading_end(text, endings)
    leaves = F.when(tail != "", True).when(lead != "", False)
    functions = pieces.select(id_col, "piece", leaves.alias("leaves"), (lead != "").alias("ends"))
    # A run is what follows a piece with an ending, up to the next such piece.
    runs = functions.withColumn("run", F.coalesce(F.sum(F.col("ends").cast("int")).over(before), F.lit(0)))
    # A block may be open from the piece before the run; else the first piece of the run
    # that leaves one open starts it.
    in_run = Window.partitionBy(id_col, "run").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.when(F.col("leaves") & ~F.col("ends"), F.col("piece"))
    carried = F.when(F.col("ends") & F.col("leaves"), F.col("piece"))
    from_last = F.last(F.when(F.col("ends"), F.struct(carried.alias("piece"))), ignorenulls=True).over(before)
    states = runs.select(
        id_col, "piece", F.coalesce(from_last["piece"], F.first(opened, ignorenulls=True).over(in_run)).alias("open")
    )
    entered = _join(pieces, states, id_col, "open")
    is_open = F.col("open").isNotNull()
    # Of an entered piece the lines up to the first ending belong to the open block.
    first = F.when(is_open, F.when(lead != "", lead).otherwise(text)).otherwise("")
    rest = F.when(is_open, F.substring(text, F.char_length(first) + 1, F.char_length(text))).otherwise(text)
    parts = entered.select(id_col, "piece", "open", first.alias("first"), (lead != "").alias("ends"), rest.alias("rest"))
    whole = T.line_blocks(F.col("rest"), keywords, endings)
    part = lambda home, nth, text, closed: F.struct(
        F.struct(home.cast("long").alias("piece"), nth.cast("int").alias("nth")).alias("home"), text.alias("part"),
        closed.alias("closed"),
    )
    last = F.lit((1 << 31) - 1)
    found = F.concat(
        F.array(part(F.col("open"), last, F.col("first"), F.col("ends"))),
        F.transform(whole, lambda b, i: part(F.col("piece"), i, b, F.lit(True))),
        F.array(part(F.col("piece"), last, T.trailing_open(F.col("rest"), keywords, endings), F.lit(False))),
    )
    found = parts.select(id_col, "piece", F.explode(F.filter(found, lambda p: p["part"] != "")).alias("p"))
    blocks = _put_together(found.select(id_col, "p.home", "piece", "p.part", "p.closed"), id_col, F.max("closed").alias("closed"))
    return _numbered(blocks.where("closed").drop("closed"), id_col, cfg)


def normalised_blocks(
    pieces: DataFrame, id_col: str, cfg: JobConfig, keywords: Sequence[str] = T.BLOCK_KEYWORDS,
    endings: Sequence[str] = T.BLOCK_ENDINGS,
) -> DataFrame:
    """``(id, pos, statement)``: ``text.normalised_blocks`` of the whole texts.  Pieces are whole lines."""
    blocks = line_blocks(pieces, id_col, cfg, keywords, endings)
    return blocks.withColumn("statement", F.get(T.normalised(F.array("statement")), F.lit(0)))


def _staged(pieces: DataFrame, id_col: str, cfg: JobConfig) -> DataFrame:
    """The pieces are read several times; only the first time may be costly."""
    rows = pieces.select(id_col, F.col("piece").cast("long").alias("piece"), "text").where("text IS NOT NULL")
    return stage(rows, cfg, staged_name(rows, cfg, "pieces"))


def _join(pieces: DataFrame, narrow: DataFrame, id_col: str, *columns: Column | str) -> DataFrame:
    """The pieces with columns of their narrow rows.

    Dealt by id and piece: the narrow rows come by id, and joined like that all
    pieces of a text would meet in one task.
    """
    return pieces.join(narrow.select(id_col, "piece", *columns).repartition(F.col(id_col), F.col("piece")), [id_col, "piece"])


def _last_event(text: Column, event: Column) -> Column:
    r"""1 if the last mark opens a comment, 0 if it closes one, NULL without a mark.

    Marks overlap: in ``//*`` the second slash opens and the star closes, and
    ``///`` only opens.  The last mark ends last, so the longest match finds it.
    """
    return F.when(event == "//", F.lit(1)).when(event != "", F.lit(0))


def _put_together(parts: DataFrame, id_col: str, *extra: Column) -> DataFrame:
    """Parts of a home as one statement, in the order of their pieces."""
    entries = F.array_sort(F.collect_list(F.struct("piece", "part")))
    text = F.array_join(F.transform(entries, lambda e: e["part"]), "")
    return parts.groupBy(id_col, "home").agg(text.alias("statement"), *extra)


def _numbered(statements: DataFrame, id_col: str, cfg: JobConfig) -> DataFrame:
    """``(id, pos, statement)``: numbered in the order of their homes.

    Numbers within a home piece, and sums over the pieces before: no task gets
    all statements of a text.
    """
    statements = statements.select(id_col, "home.piece", "home.nth", "statement")
    statements = stage(statements, cfg, staged_name(statements, cfg, "statements"))
    counts = statements.groupBy(id_col, "piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(id_col).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(id_col, "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    shifts = shifts.repartition(F.col(id_col), F.col("piece"))
    nth = F.row_number().over(Window.partitionBy(id_col, "piece").orderBy("nth")) - 1
    return statements.withColumn("_nth", nth).join(shifts, [id_col, "piece"]).select(
        id_col, (F.col("_nth") + F.col("shift")).cast("int").alias("pos"), "statement"
    )
