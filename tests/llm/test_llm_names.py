"""Extra columns that have the names operators use, and names in other cases."""

from pyspark.sql import functions as F

from segmill.llm import mixing, rules, sharding


def test_shards_beside_columns_of_their_names(odd):
    for extra in ("__slot", "__SLOT", "Slot", "Shard"):
        out = sharding.assign_shards(odd.withColumn(extra, F.lit("x")), "doc_id", ["a", "b"], 7)
        assert out.where("shard is null").isEmpty() and out.count() == odd.count()
        assert extra.startswith("__") == (extra in out.columns)


def test_ledger_beside_columns_of_its_names(odd):
    plain = rules.ledger(odd.select("doc_id", "text"), "text")
    clashing = odd.select("doc_id", F.col("text").alias("Text"), F.lit("x").alias("N_WORDS"), F.lit(1).alias("Failed_Rules"))
    out = rules.ledger(clashing, "TEXT")
    assert out.columns == plain.columns
    assert out.exceptAll(plain).isEmpty() and plain.exceptAll(out).isEmpty()


def test_mixing_by_columns_of_its_names(odd):
    goals = {"source": 0.5, "lang": 0.5}
    plain = mixing.mix(odd, goals, 0.5)
    chances = {(r.doc_id, r.text): (r.n_tokens, round(r.probability, 9), r.kept) for r in plain.collect()}
    for names in (("tokens", "weight"), ("ratio", "place"), ("Scale", "TAKEN"), ("m_dim_1", "__mix_dim_0"), ("miss", "r_dim_0")):
        clashing = odd.withColumnsRenamed(dict(zip(("source", "lang"), names, strict=True))).withColumns(
            {"KEPT": F.lit("x"), "__mix_chance": F.lit("x")}
        )
        out = mixing.mix(clashing, dict(zip(names, (0.5, 0.5), strict=True)), 0.5)
        got = {(r.doc_id, r.text): (r.n_tokens, round(r.probability, 9), r.kept) for r in out.collect()}
        assert got == chances and "__mix_chance" in out.columns and out.columns[-1] == "kept"
        shares = {(r.dimension, r.value): round(r.expected, 9) for r in mixing.margins(out, dict.fromkeys(names, 0.5)).collect()}
        assert {d for d, _ in shares} == set(names)
