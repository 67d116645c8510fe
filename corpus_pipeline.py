"""The training-data pipeline: documents in, encoded documents out.

``STAGES`` lists the stages in order.  Each gets all rows its predecessor kept and
returns the columns of ``documents``; the last adds the encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.llm import minhash, mixing, pieces, quality, templates
from segmill.llm.base import Scratch, table
from segmill.llm.queries import EXPONENTS, PIECES, QUALITY, TOKEN_BUDGET
from segmill.llm.training import held_out

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id", 4, 2))
    scored = quality.with_score(docs.select(*COLUMNS), model, out="_score")
    return scored.where(F.col("_score") >= QUALITY).select(*COLUMNS)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; the length is counted anew."""
    rest = templates.drop_templates(docs.select(*COLUMNS))
    length = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return rest.withColumn("n_chars", length).select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return minhash.deduplicate(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample in which sources, languages and topics meet their target shares, as far as they have the tokens."""
    rows = docs.select(*COLUMNS).withColumn("_topic", mixing.topic_of(F.col("text")))
    powers = {"source": EXPONENTS["source"], "lang": EXPONENTS["lang"], "_topic": EXPONENTS["topic"]}
    return mixing.mix(rows, powers, TOKEN_BUDGET).where("kept").select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their piece ids, and whether these decode to the text."""
    vocab = pieces.load(PIECES)
    rows = pieces.encode(docs.select(*COLUMNS), vocab, check="round_trip")
    return rows.select(*COLUMNS, "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_boilerplate),
    ("near dedup", one_of_each),
    ("source mixing", mixed),
    ("encoding", encoded),
]

# The classifier, the classes and the encoding are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.put(docs, f"stage-{k}")
            if k:
                scratch.drop(f"stage-{k - 1}")
    return docs
