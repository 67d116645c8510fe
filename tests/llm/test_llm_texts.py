"""Text operators against brute force on odd rows."""

import hashlib
import random
import string
import time
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from segmill.llm import minhash, mixing, quality, rules, sharding, substrings, templates, toxicity
from segmill.llm import words as W
from segmill.llm.components import components
from segmill.llm.base import Scratch
from segmill.llm.training import held_out


def flat(texts):
    return W.flat(pa.array(texts, pa.large_string()))


def test_words_lines_and_hashes():
    texts = ["a b c", "", " \n\x0b", "d", "é  é\nb", "x" * (W.BLOCK_BYTES + 5) + " y"]
    w = W.split(*flat(texts))
    found = [w.data[s:e].tobytes().decode() for s, e in zip(w.starts, w.ends, strict=True)]
    assert found == [x for t in texts for x in brute.words(t)]
    assert w.counts.tolist() == [len(brute.words(t)) for t in texts]
    h = W.span_hashes(w.data, w.starts, w.ends)
    assert len(set(h.tolist())) == len(set(found))
    assert h[found.index("é")] == h[found.index("é") + 1]
    starts, ends, first = W.lines(*flat(texts))
    got = [[w.data[s:e].tobytes().decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)]
           for a, b in zip(first, first[1:], strict=False)]
    assert got == [t.split("\n") for t in texts]


def test_sharding_fills_turn_by_turn(spark, odd, nothing):
    shards = [f"s{i}" for i in range(7)]
    owner = sharding.lookup_table(shards, 101)
    counts = Counter(owner.tolist())
    assert max(counts.values()) - min(counts.values()) <= 1
    # By the definition: preference lists, shards in turn, first free slot.
    prefer = []
    for s in shards:
        off = int(hashlib.md5(f"offset:{s}".encode()).hexdigest()[:15], 16) % 101
        skip = 1 + int(hashlib.md5(f"stride:{s}".encode()).hexdigest()[:15], 16) % 100
        prefer.append([(off + k * skip) % 101 for k in range(101)])
    brute_owner = [None] * 101
    while None in brute_owner:
        for k, order in enumerate(prefer):
            if None in brute_owner:
                brute_owner[next(x for x in order if brute_owner[x] is None)] = k
    assert owner.tolist() == brute_owner
    fewer = sharding.lookup_table(shards[:-1], 101)
    moved = sum(a != b for a, b in zip(owner.tolist(), fewer.tolist(), strict=True) if a != 6)
    assert moved < 30
    placed = sharding.assign_shards(odd.withColumn("shard", F.lit("old")), "doc_id", shards, 101)
    assert placed.count() == odd.count() and set(placed.columns) == {*odd.columns, "slot", "shard"}
    for r in placed.collect():
        slot = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard) == (slot, shards[owner[slot]])
    assert sharding.assign_shards(nothing, "doc_id", shards, 101).count() == 0


def test_sharded_write(spark, odd, tmp_path):
    placed = sharding.assign_shards(odd, "doc_id", ["a", "b"], 7)
    sharding.write_shards(placed, str(tmp_path / "out"), files_per_shard=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd.count()
    assert back.select("doc_id", "shard").exceptAll(placed.select("doc_id", "shard")).isEmpty()


def test_substrings_equal_brute_force(odd, nothing):
    ids = odd.where("doc_id <> 9").distinct()
    rows = [(r.doc_id, r.text) for r in ids.collect()]
    for window in (2, 6, 20):
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text)
               for r in substrings.remove_repeats(ids, window=window).collect()}
        assert got == brute.remove_repeats(rows, window)
    everything = substrings.remove_repeats(odd)
    assert everything.count() == odd.count()
    assert substrings.remove_repeats(nothing).count() == 0
    lengths = {r.length: r.n_windows for r in substrings.repeat_lengths(odd, window=20).collect()}
    assert lengths[20] > 0 and sorted(lengths) == [20 * 2**k for k in range(len(lengths))]


def test_near_duplicates_equal_brute_force(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    want = Counter((rows[i][0], c) for i, c in brute.classes(rows).items())
    got = Counter((r.doc_id, r.class_id) for r in minhash.near_duplicates(odd).collect())
    assert got == want
    kept = minhash.deduplicate(odd)
    assert kept.columns == odd.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    words = [(i, t) for i, (_, t) in enumerate(left) if brute.words(t)]
    assert len(set(brute.classes(words).values())) == len(words)
    assert {d for d, t in left} >= {1, 2, 3, 4, 6, 9, 50} and not {7, 8, 10, 21} & {d for d, _ in left}
    assert minhash.near_duplicates(nothing).count() == minhash.deduplicate(nothing).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    m = 4096
    shingle = np.sort(rng.integers(0, 2**63, 40).astype(np.uint64))
    a, b = rng.integers(0, 9, 40), rng.integers(0, 9, 40)
    names = []
    for count in (a, b):
        on = count > 0
        names.append(minhash.signatures(np.zeros(int(on.sum()), np.int64), shingle[on], count[on], 1, m)[0])
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((names[0] == names[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / m)


def test_a_written_step_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}
    before = files()
    rows = Scratch(spark, "files").put(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "rows")
    for _ in range(50):
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and rows.count() == 7


def test_components(spark):
    edges = [(i, i + 1) for i in range(40) if i % 10 != 9] + [(100, 3), (100, 100 + 1)]
    df = spark.createDataFrame(edges, "x long, y long")
    got = {r.node: r.component for r in components(df, Scratch(spark, "test"), "c").collect()}
    assert got == {i: i // 10 * 10 for i in range(40)} | {100: 0, 101: 0}
    assert components(df.limit(0), Scratch(spark, "test"), "c").count() == 0


def test_rules_ledger(odd, nothing):
    ledger = rules.ledger(odd.withColumn("n_words", F.lit("clash")), "text")
    assert ledger.count() == odd.count() and "row" in ledger.columns
    got = Counter((r.doc_id, r.n_words, r.n_dup_lines, r.n_repeat_words, r.n_symbols, r.word_chars) for r in ledger.collect())
    want = Counter()
    for r in odd.collect():
        ws, text = brute.words(r.text), r.text or ""
        lines = [x for x in text.split("\n") if brute.words(x)]
        seen = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
        covered = {i + k for i in range(len(ws) - 4) if seen[tuple(ws[i:i + 5])] > 1 for k in range(5)}
        want[(r.doc_id, len(ws), len(lines) - len(set(lines)), len(covered), sum(c in "#*$%&|<>" for c in text),
              sum(map(len, ws)))] += 1
    assert got == want
    policy = rules.POLICIES["v2"]
    masks = [r.failed_rules & policy.mask for r in ledger.collect()]
    counts = {r.rule: (r.n_failed, r.n_failed_alone) for r in rules.ablations(ledger, policy).collect()}
    for rule in rules.RULES:
        bit = 1 << rule.bit
        assert counts[rule.name] == (sum(m & bit != 0 for m in masks), sum(m == bit for m in masks))
    assert ledger.where(rules.passes(policy)).count() == masks.count(0)
    assert rules.ledger(nothing, "text").count() == 0 and rules.ablations(rules.ledger(nothing, "text"), policy).count() == 0


def test_templates_drop_recurring_lines(odd, nothing):
    out = templates.drop_templates(odd)
    assert out.columns == [*odd.columns, "n_lines", "n_dropped"] and out.count() == odd.count()
    rows = {r.doc_id: r for r in out.where("doc_id >= 30").collect()}
    licence = "This work may be copied under the terms of the licence named below."
    assert licence in rows[30].text and rows[30].n_dropped == 0
    assert all(licence not in rows[i].text and rows[i].n_dropped == 2 for i in range(31, 38))
    # The number and the depot vary; the template is one.
    assert "shipped" in rows[40].text and all("shipped" not in rows[i].text for i in range(41, 48))
    assert rows[52].n_dropped == 0 and rows[52].text == "same line here\n" * 40
    # Copies of one text do not make its lines templates.
    assert out.where("doc_id in (6, 7, 8) and n_dropped > 0").isEmpty()
    assert templates.drop_templates(nothing).count() == 0


def two_field_lines(spark, n):
    """Documents with one line of a template of two fields, of 676 words each."""
    rng = random.Random(5)
    two = lambda: rng.choice(string.ascii_lowercase) + rng.choice(string.ascii_lowercase)
    rows = [(i, f"own text w{i}\nPosted by user {two()} from town {two()} this morning") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_templates_with_fields_are_found_at_every_size(spark):
    for n in (100, 10_000):
        out = templates.drop_templates(two_field_lines(spark, n))
        gone = out.where(~F.contains("text", F.lit("Posted by"))).count()
        assert gone == n - 1, (n, gone)


def test_templates_keep_frequent_lines_of_a_crowded_leaf(spark):
    # Each line is in 6 of 240 texts: under the share, yet a template of its own.
    words = [c * 3 for c in string.ascii_lowercase] + [c * 4 for c in string.ascii_lowercase[:14]]
    rows = [(i, f"a b c {' '.join(w + k for k in 'uvwxyz')}\nown{i}") for i, w in enumerate(words * 6)]
    out = templates.drop_templates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.where("n_dropped = 1").count() == 200 and out.where("doc_id < 40 and n_dropped > 0").isEmpty()


def test_templates_count_a_text_once(spark):
    # Six lines of one template, but in two texts only; the leaf itself is in six.
    one, two = ("red", "blue", "green"), ("pink", "teal", "gray")
    rows = [(i, "\n".join(f"a b c {w} d e f" for w in ws)) for i, ws in enumerate((one, two))]
    rows += [(i, f"a b c p{chr(97 + i)} q r s") for i in range(2, 6)]
    out = templates.drop_templates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert out.where("doc_id < 2 and n_dropped > 0").isEmpty()


def test_templates_equal_their_sql(spark, odd, duck):
    """On rows where shares, distinct texts, copies and lines without blanks decide."""
    from oracle import difference

    rng = random.Random(6)
    rows = [(r.doc_id, r.text) for r in odd.where("doc_id is not null").dropDuplicates(["doc_id"]).collect()]
    two = lambda: rng.choice(string.ascii_lowercase) + rng.choice(string.ascii_lowercase)
    rows += [(1_000 + i, f"own text w{i}\nPosted by user {two()} from town {two()} this morning") for i in range(400)]
    words = [c * 3 for c in string.ascii_lowercase] + [c * 4 for c in string.ascii_lowercase[:14]]
    rows += [(2_000 + i, f"a b c {' '.join(w + k for k in 'uvwxyz')}\nown{i}") for i, w in enumerate(words * 6)]
    rows += [(3_000 + i, f"本サイトの内容は許可なく転載することを禁じます\nshort\nk{i}") for i in range(9)]
    rows += [(3_100 + i, "\n".join(f"x y z {w} d e f" for w in ("red", "blue", "pink"))) for i in range(2)]
    rows += [(3_200 + i, f"x y z p{chr(97 + i)} q r s") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    duck.execute("CREATE TEMP TABLE odd_docs (doc_id BIGINT, text VARCHAR)")
    duck.executemany("INSERT INTO odd_docs VALUES (?, ?)", rows)
    out = templates.drop_templates(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))
    sql = templates.ORACLE_SQL.replace("documents", "odd_docs")
    # A null text is an empty one in SQL's hash.
    assert difference(out.where("n_lines > 0"), duck, f"SELECT * FROM ({sql}) WHERE n_lines > 0") is None
    dropped = {r.doc_id: r.n_dropped for r in out.collect()}
    # Both lines of each: "own text" with its number, and the two fields.
    assert sum(dropped[1_000 + i] for i in range(400)) == 2 * 399
    assert sum(dropped[3_000 + i] for i in range(9)) == 8
    assert dropped[3_100] == dropped[3_101] == 0


def test_mixing_meets_targets(spark, odd, nothing):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 60), rng.choice("abc"), rng.choice(["x", "x", "x", "y"])) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    out = mixing.mix(docs, {"source": 0.0, "lang": 0.5}, 0.2).cache()
    total = out.agg(F.sum("n_tokens")).first()[0]
    mean = out.agg(F.sum(F.col("n_tokens") * F.col("probability"))).first()[0]
    assert abs(mean - 0.2 * total) < 1e-6 * total
    by = {r.source: r.t for r in out.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("probability")).alias("t")).collect()}
    assert all(abs(t / mean - 1 / 3) < 1e-3 for t in by.values())
    kept = out.where("kept").agg(F.sum("n_tokens")).first()[0]
    assert abs(kept - mean) < 0.15 * mean
    whole = mixing.mix(docs, {"source": 1.0}, 1.0)
    assert whole.where("not kept").isEmpty()
    few, mixing.FEW_CELLS = mixing.FEW_CELLS, 0
    try:
        other = mixing.mix(docs, {"source": 0.0, "lang": 0.5}, 0.2)
        assert abs(other.agg(F.sum("probability")).first()[0] - out.agg(F.sum("probability")).first()[0]) < 1e-6
    finally:
        mixing.FEW_CELLS = few
    assert mixing.mix(odd, {"source": 0.5, "lang": 0.5}, 0.5).count() == odd.count()
    assert mixing.mix(nothing, {"source": 0.5}, 0.5).count() == 0


def test_mixing_meets_targets_where_cells_are_bounded(spark):
    # Source c has fewer tokens than its target; the others' cells differ by language.
    sizes = {("a", "x"): 900, ("a", "y"): 60, ("b", "x"): 300, ("b", "y"): 300, ("c", "x"): 40, ("c", "y"): 60}
    rows = [("w " * 10, s, g) for (s, g), n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, source string, lang string")
    goals = {"source": 0.0, "lang": 0.0}
    got = {(r.dimension, r.value): r for r in mixing.margins(mixing.mix(docs, goals, 0.4), goals).collect()}
    c = 100 / (0.4 * 1660)
    expect = {("source", "a"): (1 - c) / 2, ("source", "b"): (1 - c) / 2, ("source", "c"): c, ("lang", "x"): 0.5, ("lang", "y"): 0.5}
    assert {k: round(r.expected, 4) for k, r in got.items()} == {k: round(v, 4) for k, v in expect.items()}
    assert abs(got["source", "c"].target - 1 / 3) < 1e-9 and got["source", "c"].tokens == 1000
    weights = {"source": {"a": 3.0, "b": 1.0}, "lang": 1.0}
    out = mixing.mix(docs, weights, 0.2)
    got = {(r.dimension, r.value): r for r in mixing.margins(out, weights).collect()}
    assert abs(got["source", "a"].expected - 0.75) < 1e-4 and got["source", "c"].expected == 0


def test_toxicity_folding_and_exceptions(spark, odd, nothing):
    for hidden in ("1d1ot", "ІDIOT", "idi​ot", "!d!0t", "ｉｄｉｏｔ"):
        assert toxicity.fold(hidden) == toxicity.fold("idiot"), hidden
    assert toxicity.fold("word$$$ idiot$$$").split() == ["word$$$", "idiot$$$"]
    lexicon = toxicity.Lexicon({toxicity.fold("idiot"): 4.0, "scun*": 3.0}, [toxicity.fold("the idiot by")], (1.0, 1.0, 1.0, -3.0))
    docs = spark.createDataFrame(
        [(1, "an 1d1ot"), (2, "the idiot by him"), (3, "idiotic"), (4, None), (5, "scunner"), (6, "")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, lexicon).collect()}
    assert got[1] > 0.5 and got[5] > 0.5 and got[2] == got[3] == got[4] == got[6] < 0.1
    labels = odd.select("doc_id", (F.col("doc_id") == 54).cast("int").alias("toxic"))
    learned = toxicity.learn(odd, labels.limit(0), F.lit(True))
    assert toxicity.score(odd, learned).count() == odd.count()
    assert toxicity.score(nothing, learned).count() == 0


def test_held_out_is_crc32(spark):
    got = spark.range(50).select("id", held_out("id", 5, 0).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def _accuracy(scored, labels, label, threshold, fold):
    both = scored.join(labels, "doc_id").where(fold)
    hit = ((F.col("score") >= threshold).cast("int") == F.col(label)).cast("double")
    return both.agg(F.avg(hit), F.count(F.lit(1))).first()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    fold = held_out("doc_id", 4, 2)
    scored = quality.with_score(docs.select("doc_id", "text"), quality.learn(docs, labels, ~fold))
    good, n = _accuracy(scored, labels, "quality", 0.7, fold)
    assert n > 500 and good > 0.98
    fold = held_out("doc_id", 5, 0)
    scored = toxicity.score(docs, toxicity.learn(docs, labels, ~fold))
    good, n = _accuracy(scored, labels, "toxic", 0.5, fold)
    assert n > 500 and good > 0.97


def test_quality_on_odd_rows(odd, nothing, spark):
    labels = odd.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = quality.learn(odd, labels, F.lit(True))
    out = quality.with_score(odd, model)
    assert out.count() == odd.count() and out.where("score is null or score < 0 or score > 1").isEmpty()
    assert quality.learn(nothing, labels, F.lit(True)) is None
    assert quality.with_score(nothing, None).count() == 0
