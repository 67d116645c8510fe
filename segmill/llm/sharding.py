"""Placing rows on shards by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.llm.base import unused

# Slots of the table.  A prime, so that every stride visits every slot; over a
# hundred slots per shard keep the shards' shares within about one per cent.
SLOTS = 65_537
MAX_SLOTS = 1 << 20


def _draw(name: str, salt: str, below: int) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16) % below


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """The index of the shard that owns each slot.

    Each shard prefers the slots ``(offset + k * stride) % slots``, with offset
    and stride drawn from its name.  The shards take turns; in its turn a shard
    claims the first slot of its order that is still free.  The shares differ by
    one slot at most, and adding or removing a shard moves few other slots.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not len(shards) <= slots <= MAX_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"slots must be a prime of at most {MAX_SLOTS}, and not below the shards")
    at = [_draw(s, "offset", slots) for s in shards]
    stride = [1 + _draw(s, "stride", slots - 1) if slots > 2 else 1 for s in shards]
    owner = np.full(slots, -1, dtype=np.int32)
    claimed = 0
    while claimed < slots:
        for k in range(len(shards)):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + stride[k]) % slots
            owner[at[k]] = k
            claimed += 1
            if claimed == slots:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: 60 bits of its text's MD5.  NULL counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def assign_shards(
    df: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS,
    slot: str = "slot", shard: str = "shard", spill_key: str | None = None,
) -> DataFrame:
    """Add each row's slot and shard; no row is shuffled.

    The table has at most ``MAX_SLOTS`` rows whatever the input, so it is
    broadcast.  Rows with the same key share a shard.  NULL keys share one too,
    unless ``spill_key`` names a column that places them instead.  Existing
    columns called ``slot`` or ``shard`` are replaced; other columns stay.
    """
    spark = df.sparkSession
    place = F.col(key) if spill_key is None else F.coalesce(
        F.col(key).cast("string"), F.concat(F.lit("\u0000"), F.coalesce(F.col(spill_key).cast("string"), F.lit("")))
    )
    rows = df.drop(slot, shard).withColumn(slot, slot_of(place, slots))
    own = unused(rows, "__slot")
    owners = _owners(spark, shards, slots).toDF(own, shard)
    return rows.join(F.broadcast(owners), F.col(slot) == F.col(own), "left").drop(own)


def _owners(spark: SparkSession, shards: Sequence[str], slots: int) -> DataFrame:
    owner = lookup_table(shards, slots)
    frame = pd.DataFrame({"slot": np.arange(slots, dtype=np.int32), "shard": np.asarray(shards, dtype=object)[owner]})
    return spark.createDataFrame(frame, "slot int, shard string")


def write_shards(df: DataFrame, path: str, shard: str = "shard", files_per_shard: int = 1) -> None:
    """Write assigned rows into one folder per shard.

    Rows of a shard are dealt to ``files_per_shard`` tasks at random positions of
    their slots, so one task never gets a whole large shard.
    """
    part = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_shard))
    (
        df.withColumn("_part", part).repartition(F.col(shard), F.col("_part")).drop("_part")
        .write.partitionBy(shard).parquet(path)
    )
