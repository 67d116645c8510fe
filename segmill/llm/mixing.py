"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of (source, language, topic).  Cells are few, whatever
the number of documents: all the fitting works on them.  Starting from the tokens
of each cell, weights are raked to the target share of every source, language
and topic in turn, with no cell above its tokens.  Documents are then sampled with
their cell's probability, calibrated so that the expected tokens meet a budget.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmill.llm.base import Scratch, unused

SWEEPS = 12

# Under the bound, rounds of sweeps go on until no margin misses its target by
# more than this share of the budget, or the rounds are over: targets that each
# can be met need not be so together.  ``margins`` tells what was achieved.
RESIDUAL = 1e-6
ROUNDS = 4

# A cell that reaches this share of its tokens is at its bound, so that rounding does
# not decide.
FULL = 1 - 1e-9

# Up to this many cells are fitted in one partition, where windows need no
# shuffle, and are broadcast to the documents.  The rows do not depend on it.
FEW_CELLS = 100_000

NONE = "\u0000"  # the name of the missing source, language or topic

WORDS = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    """A coarse topic by form; texts without one are prose."""
    return (
        F.when(text.contains("|"), "table")
        .when(text.rlike("[%$#*&]{2}"), "markup")
        .when(text.rlike("[0-9]"), "records")
        .otherwise("prose")
    )


def _name(c: str) -> Column:
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NONE))


def _own(exponents: Mapping) -> dict[str, str]:
    """Names for the dimensions inside cells, which have columns of other names as well."""
    return {d: f"dim_{k}" for k, d in enumerate(exponents)}


def _total(x: Column, *by: str) -> Column:
    return F.sum(x).over(Window.partitionBy(*(by or (F.lit(1),))))


def with_targets(cells: DataFrame, exponents: Mapping[str, float | Mapping[str | None, float]]) -> DataFrame:
    """Add ``t_<dimension>``: each value's target share, proportional to its tokens to a power.

    An exponent of 1 keeps the shares, 0 makes them equal; between them rare
    values gain and none vanishes.  Instead of an exponent, a dimension can have
    a weight for each value; others weigh nothing.
    """
    for d, power in exponents.items():
        if isinstance(power, Mapping):
            given = cells.sparkSession.createDataFrame(
                [(NONE if v is None else str(v), float(w)) for v, w in power.items()], f"`{d}` string, __weight double"
            )
            cells = cells.join(F.broadcast(given), d, "left").withColumn("__weight", F.coalesce("__weight", F.lit(0.0)))
            each = F.col("__weight") * F.col("tokens") / _total(F.col("tokens"), d)
            cells = cells.withColumn("__each", each)
            cells = cells.withColumn(f"t_{d}", F.col("__weight") / _total(F.col("__each"))).drop("__weight", "__each")
            continue
        cells = cells.withColumn(f"m_{d}", _total(F.col("tokens"), d))
        # A value's cells share its power by their tokens, so that the sum has each value once.
        each = F.pow(F.col(f"m_{d}"), F.lit(float(power)))
        cells = cells.withColumn(f"t_{d}", each / _total(each * F.col("tokens") / F.col(f"m_{d}"))).drop(f"m_{d}")
    return cells


def calibrate(cells: DataFrame, dimensions: Sequence[str], budget: float) -> DataFrame:
    """Add ``probability``: proportional to weight per token, at most 1, spending ``budget`` of all tokens.

    Cells in order of weight per token: some first ones are taken whole, and the
    others share what is left.  The right number of first ones is the smallest
    for which no other cell would get more than 1.
    """
    cells = cells.withColumn("ratio", F.col("weight") / F.col("tokens"))
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("ratio"), *dimensions)
    before = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    spend = F.lit(float(budget)) * _total(F.col("tokens"))
    scale = (spend - before) / F.nullif(rest, F.lit(0.0))
    cells = cells.withColumns({"scale": scale, "place": F.row_number().over(order)})
    fits = F.when(F.col("scale") * F.col("ratio") <= 1, F.col("place"))
    cells = cells.withColumn("taken", F.min(fits).over(Window.partitionBy(F.lit(1))))
    scale = F.max(F.when(F.col("place") == F.col("taken"), F.col("scale"))).over(Window.partitionBy(F.lit(1)))
    # Where no number fits, the budget covers all cells that weigh anything.
    chance = F.least(F.lit(1.0), F.coalesce(scale * F.col("ratio"), F.lit(1.0)))
    return cells.withColumn("probability", F.when(F.col("weight") > 0, chance).otherwise(0.0))


def reachable(cells: DataFrame, dimensions: Sequence[str], budget: float) -> DataFrame:
    """Add ``r_<dimension>``: the tokens to take of each value.

    These are the target shares of the budget, but no more than there is: what a
    value lacks goes to the dimension's others by their shares.
    """
    for d in dimensions:
        margin = cells.groupBy(d).agg(F.sum("tokens").alias("tokens"), F.max(f"t_{d}").alias("weight"))
        margin = calibrate(margin, [d], budget)
        cells = cells.join(margin.select(d, (F.col("probability") * F.col("tokens")).alias(f"r_{d}")), d)
    return cells


def rake_within(cells: DataFrame, dimensions: Sequence[str], sweeps: int = SWEEPS) -> DataFrame:
    """``weight`` raked to ``r_<dimension>``, where a cell counts by its tokens at most.

    Cells at their bound stay there while the open ones are scaled to what is
    left; a value whose bounded cells alone have too much is scaled as a whole.
    """
    full = F.col("weight") >= F.lit(FULL) * F.col("tokens")
    for d in dimensions * sweeps:
        bound = _total(F.when(full, F.col("tokens")).otherwise(0).cast("double"), d)
        free = _total(F.when(full, 0.0).otherwise(F.col("weight")), d)
        cells = cells.withColumns({"__bound": bound, "__free": free})
        left = F.col(f"r_{d}") - F.col("__bound")
        factor = F.when((F.col("__free") > 0) & (left > 0), left / F.nullif("__free", F.lit(0.0))).otherwise(
            F.col(f"r_{d}") / F.nullif(F.col("__bound") + F.col("__free"), F.lit(0.0))
        )
        cells = cells.withColumn("weight", F.col("weight") * F.coalesce(factor, F.lit(1.0))).drop("__bound", "__free")
    return cells


def fit_within(
    cells: DataFrame, dimensions: Sequence[str], budget: float, scratch: Scratch, few: bool, sweeps: int = SWEEPS
) -> DataFrame:
    """Add ``probability``, so that margins meet their targets as far as there are tokens."""
    dimensions = list(dimensions)
    cells = reachable(cells, dimensions, budget).withColumn("weight", F.lit(float(budget)) * F.col("tokens"))
    taken = F.least(F.col("weight"), F.col("tokens").cast("double"))
    for k in range(ROUNDS):
        cells = rake_within(cells.coalesce(1) if few else cells, dimensions, sweeps)
        misses = [F.abs(_total(taken, d) - F.col(f"r_{d}")) for d in dimensions]
        cells = cells.withColumn("miss", F.greatest(F.lit(0.0), *misses))
        cells = scratch.put(cells, f"round-{k}")
        miss, tokens = cells.agg(F.max("miss"), F.sum("tokens")).first()
        if miss is None or miss <= RESIDUAL * budget * tokens:
            break
    cells = cells.withColumn("weight", taken)
    return calibrate(cells.coalesce(1) if few else cells, dimensions, budget)


def margins(mixed: DataFrame, exponents: Mapping[str, float | Mapping[str | None, float]]) -> DataFrame:
    """Each value's shares of the tokens in what ``mix`` returned.

    ``(dimension, value, tokens, target, expected, drawn)``: all its tokens, its
    target share, and its shares of the expected and of the drawn tokens.
    """
    own = _own(exponents)
    cells = mixed.groupBy(*[_name(d).alias(own[d]) for d in exponents]).agg(
        F.sum("n_tokens").alias("tokens"), F.sum(F.col("n_tokens") * F.col("probability")).alias("expected"),
        F.sum(F.when(F.col("kept"), F.col("n_tokens")).otherwise(0)).alias("drawn"),
    ).where("tokens > 0")
    cells = with_targets(cells, {own[d]: x for d, x in exponents.items()})
    for x in ("expected", "drawn"):
        cells = cells.withColumn(x, F.col(x) / F.nullif(_total(F.col(x)).cast("double"), F.lit(0.0)))
    value = F.explode(F.array(*[
        F.struct(F.lit(d).alias("dimension"), F.col(c).alias("value"), F.col(f"t_{c}").alias("target")) for d, c in own.items()
    ]))
    return cells.select(value.alias("v"), "tokens", "expected", "drawn").groupBy("v.dimension", "v.value").agg(
        F.sum("tokens").alias("tokens"), F.max("v.target").alias("target"),
        F.sum("expected").alias("expected"), F.sum("drawn").alias("drawn"),
    ).withColumn("value", F.nullif("value", F.lit(NONE)))


def draw(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone: 52 bits of its MD5."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix(
    df: DataFrame, exponents: Mapping[str, float | Mapping[str | None, float]], budget: float,
    id_col: str = "doc_id", text_col: str = "text", sweeps: int = SWEEPS,
) -> DataFrame:
    """``df`` with ``n_tokens``, ``probability`` and ``kept``.

    ``exponents`` maps dimensions (columns of ``df``) to the power that makes
    their target shares, or to weights by value (see ``with_targets``); ``budget``
    is the share of all tokens to keep in expectation.  Values with too few tokens
    for their target are kept whole (see ``reachable``).  Whether a document is kept
    depends on its id, and on its text where the id is null; a copy of a row shares its
    fate.

    A missing source, language or topic is a value of its own.  A cell without
    any token has nothing to weigh and is not kept; other empty texts follow
    their cell.  Columns called like the new ones, in any case, are replaced, others
    stay; dimensions may have any name.
    The cells are fitted when called; the documents are then looked up lazily.
    """
    own = _own(exponents)
    names = list(own.values())
    text = F.col(f"`{text_col}`")
    tokens = F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")
    scratch = Scratch(df.sparkSession, "mixing")
    counted = df.groupBy(*[_name(d).alias(c) for d, c in own.items()]).agg(F.sum(tokens).alias("tokens"))
    cells = scratch.put(counted.where("tokens > 0"), "cells")
    few = cells.limit(FEW_CELLS + 1).count() <= FEW_CELLS
    fitted = with_targets(cells.coalesce(1) if few else cells, {own[d]: x for d, x in exponents.items()})
    fitted = fit_within(fitted, names, budget, scratch, few, sweeps)
    looked = {c: unused(df, f"__mix_{c}") for c in (*names, "chance", "draw", "tokens")}
    chances = fitted.select(*[F.col(c).alias(looked[c]) for c in names], F.col("probability").alias(looked["chance"]))
    chances = scratch.put(chances, "chances")
    if few:
        chances = F.broadcast(chances.coalesce(1))
    same = None
    for d, c in own.items():
        equal = _name(d) == F.col(looked[c])
        same = equal if same is None else same & equal
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.concat(F.lit(NONE), F.coalesce(text, F.lit(""))))
    # Everything is read from the columns given before any of them is replaced.
    rows = df.withColumns({looked["tokens"]: tokens, looked["draw"]: draw(key)}).join(chances, same, "left")
    new = {"n_tokens", "probability", "kept"}
    chance = F.coalesce(looked["chance"], F.lit(0.0))
    return rows.select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in new], F.col(looked["tokens"]).alias("n_tokens"),
        chance.alias("probability"), (F.col(looked["draw"]) < chance).alias("kept"),
    )


def _calibrate_sql(cells: str, names: str, budget: float) -> list[str]:
    """CTEs that end in ``<cells>_q``, with ``probability``."""
    return [f"""{cells}_p AS (
  SELECT *, ({budget} * sum(tokens) OVER () - coalesce(sum(tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / nullif(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS scale, row_number() OVER o AS place
  FROM (SELECT *, weight / tokens AS ratio FROM {cells}) WINDOW o AS (ORDER BY ratio DESC, {names})
)""", f"{cells}_s AS (SELECT scale FROM {cells}_p WHERE scale * ratio <= 1 ORDER BY place LIMIT 1)",
        f"""{cells}_q AS MATERIALIZED (
  SELECT *, CASE WHEN weight > 0 THEN least(1.0, coalesce((SELECT scale FROM {cells}_s) * ratio, 1.0)) ELSE 0 END
    AS probability FROM {cells}_p
)"""]


def mix_sql(exponents: Mapping[str, float], budget: float, sweeps: int = SWEEPS) -> str:
    """The same in DuckDB's SQL over ``documents``."""
    names = ", ".join(exponents)
    steps = [f"""d AS (
  SELECT *, CASE WHEN text LIKE '%|%' THEN 'table' WHEN regexp_matches(text, '[%$#*&]{{2}}') THEN 'markup'
      WHEN regexp_matches(text, '[0-9]') THEN 'records' ELSE 'prose' END AS topic,
    coalesce(len(regexp_extract_all(text, '{WORDS}')), 0) AS n_tokens FROM documents
), c0 AS (
  SELECT {', '.join(f"coalesce({d}, chr(1)) AS {d}" for d in exponents)}, sum(n_tokens)::DOUBLE AS tokens
  FROM d GROUP BY ALL HAVING sum(n_tokens) > 0
)"""]
    k = 0
    for d, power in exponents.items():
        steps.append(f"c{k + 1} AS (SELECT *, sum(tokens) OVER (PARTITION BY {d}) AS m_{d} FROM c{k})")
        steps.append(
            f"c{k + 2} AS (SELECT *, pow(m_{d}, {power}) / sum(pow(m_{d}, {power}) * tokens / m_{d}) OVER () AS t_{d} FROM c{k + 1})"
        )
        k += 2
    joined = f"c{k} c"
    for d in exponents:
        # The tokens to take of each value.
        steps.append(f"g_{d} AS (SELECT {d}, sum(tokens) AS tokens, max(t_{d}) AS weight FROM c{k} GROUP BY {d})")
        steps += _calibrate_sql(f"g_{d}", d, budget)
        joined += f" JOIN (SELECT {d}, probability * tokens AS r_{d} FROM g_{d}_q) USING ({d})"
    steps.append(f"w0 AS MATERIALIZED (SELECT *, {budget} * tokens AS weight, false AS done FROM {joined})")
    k = 0
    for _ in range(ROUNDS):
        for d in list(exponents) * sweeps:
            bound = f"sum(CASE WHEN weight >= {FULL} * tokens THEN tokens ELSE 0 END) OVER (PARTITION BY {d})"
            free = f"sum(CASE WHEN weight >= {FULL} * tokens THEN 0 ELSE weight END) OVER (PARTITION BY {d})"
            factor = (
                f"CASE WHEN free > 0 AND r_{d} - bound > 0 THEN (r_{d} - bound) / nullif(free, 0) "
                f"ELSE r_{d} / nullif(bound + free, 0) END"
            )
            steps.append(
                f"w{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (bound, free) REPLACE "
                f"(CASE WHEN done THEN weight ELSE weight * coalesce({factor}, 1) END AS weight) "
                f"FROM (SELECT *, {bound} AS bound, {free} AS free FROM w{k}))"
            )
            k += 1
        misses = ", ".join(f"abs(sum(least(weight, tokens)) OVER (PARTITION BY {d}) - r_{d})" for d in exponents)
        steps.append(
            f"w{k + 1} AS MATERIALIZED (SELECT * EXCLUDE miss REPLACE (done OR max(miss) OVER () "
            f"<= {RESIDUAL} * {budget} * sum(tokens) OVER () AS done) FROM (SELECT *, greatest(0, {misses}) AS miss FROM w{k}))"
        )
        k += 1
    steps.append(f"cells AS (SELECT * REPLACE (least(weight, tokens) AS weight) FROM w{k})")
    steps += _calibrate_sql("cells", names, budget)
    on = " AND ".join(f"coalesce(d.{x}, chr(1)) = cells_q.{x}" for x in exponents)
    return f"""WITH {', '.join(steps)}
SELECT doc_id, d.source, d.lang, d.topic, n_tokens, round(coalesce(probability, 0), 6) AS probability,
  ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT / {float(16**13)} < coalesce(probability, 0) AS kept
FROM d LEFT JOIN cells_q ON {on}"""
