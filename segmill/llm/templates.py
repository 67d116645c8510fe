"""Line deduplication by a tree of log templates.

A line falls into a leaf of a fixed-depth tree by its number of tokens and its
leading tokens.  Inside a leaf, variable fields are generalised: a token with a
digit is a field, and so is a token that stands at its place in a small share of
the leaf's texts, however many texts there are.  Where that would leave too few
fixed tokens, only tokens in too few texts are fields, so that a line found often
enough as it is stays a template of its own beside many others in its leaf.
Lines that are alike but for their fields share a template.  A template found in
enough different texts is boilerplate: its lines stay in the first document that
has it and are dropped elsewhere.

DataFrame functions only.  Leaves that do not recur are left out after the
first, narrow count; of the others each distinct line is generalised once.  The
texts of lines are shuffled with their leaf and for that; everything else knows a
line, and a template, by 128 bits of hash.  All joins that grow with the corpus
are merged, so the plan is the same at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.llm.base import Scratch

MIN_TEXTS = 5      # different texts that make a template boilerplate
LEADING = 3        # depth of the tree below the token count
MIN_TOKENS = 3     # a line of fewer tokens
MIN_CHARS = 30     # and of fewer bytes is never dropped
FIXED_TOKENS = 0.5  # share of tokens that must not be fields
FIELD_ONE_IN = 20  # a token in fewer than one in so many of a leaf's texts is a field at its place

FIELD = "<*>"
NO_ID = -(1 << 63)


def masked(text: Column) -> Column:
    """The text with blanks for other white space in lines, and a field for each token with a digit.

    Whole texts are masked at once, and only those that have something to mask.
    """
    plain = F.when(text.rlike(r"[\t\x0b\x0c\r]"), F.translate(text, "\t\x0b\x0c\r", "    ")).otherwise(text)
    # Starts at token starts only and never goes back: linear in the text.
    field = F.regexp_replace(plain, r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", FIELD)
    return F.when(text.rlike("[0-9]"), field).otherwise(plain)


def _count(text: Column, sign: str) -> Column:
    """How often a one-byte sign stands in a text."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))


def _lines(docs: DataFrame) -> DataFrame:
    """``(id, row, t, line_no, line, n_tokens, leaf)`` of lines long enough to be boilerplate."""
    lines = docs.select(
        "id", "row", "t", F.posexplode(F.split(masked(F.col("text")), "\n")).alias("line_no", "line")
    )
    lines = lines.withColumn("n_tokens", _count(F.col("line"), " ") + 1).where(
        (F.col("n_tokens") >= MIN_TOKENS) | (F.octet_length("line") >= MIN_CHARS)
    )
    return lines.withColumn("leaf", F.xxhash64("n_tokens", F.substring_index("line", " ", LEADING)))


LINE, TEMPLATE = ("line_0", "line_1"), ("template_0", "template_1")


def _hashes(name: str) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(name).alias(f"{name}_0"), F.xxhash64(F.lit(1), F.col(name)).alias(f"{name}_1")]


def _in_texts(rows: DataFrame, key: list[str], min_texts: int) -> DataFrame:
    """Keys that occur in enough different texts, with their number ``n``."""
    return (
        rows.groupBy(*key, "t").agg(F.min("id").alias("id"))
        .groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
        .where(F.col("n") >= min_texts)
    )


def drop_templates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_texts: int = MIN_TEXTS
) -> DataFrame:
    """``df`` with boilerplate lines taken out of the text, and ``n_lines`` and ``n_dropped``.

    Texts that are equal count once, so copies of a document do not turn its
    lines into templates.  The first document is the one of smallest id; a null
    id counts as the smallest.  A text without dropped lines stays as it is, byte
    by byte; so does a null text, which has no lines (an empty one has one).
    Rows alike in id and text are treated alike.  Columns called ``n_lines`` or
    ``n_dropped`` are replaced; all others stay.
    """
    scratch = Scratch(df.sparkSession, "templates")
    ids = F.col(id_col).cast("long")
    row = F.xxhash64(ids, F.col(text_col))
    docs = df.select(
        F.coalesce(ids, F.lit(NO_ID)).alias("id"), row.alias("row"),
        F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"),
    )
    lines = _lines(docs)
    leaves = scratch.put(
        _in_texts(lines.select("id", "t", "leaf"), ["leaf"], min_texts).select("leaf", F.col("n").alias("leaf_texts")),
        "leaves",
    )
    # Both sides of the joins that are hinted grow with the corpus.
    found = scratch.put(
        lines.select("id", "row", "t", "line_no", "leaf", "line", *_hashes("line"))
        .join(leaves.select("leaf").hint("merge"), "leaf"),
        "found",
    )
    here = ["leaf", *LINE]
    # A text's lines in a leaf.  Where there is one, numbers of texts add up over
    # lines; texts with several are counted for themselves.
    texts = scratch.put(
        found.groupBy("leaf", "t").agg(F.min("id").alias("id"), F.collect_set(F.struct(*LINE)).alias("lines")), "texts"
    )
    one_of = texts.select("leaf", "t", "id", F.size("lines").alias("size"), F.explode("lines").alias("of"))
    one_of = one_of.select("leaf", "t", "id", "size", "of.*")
    several = one_of.where("size > 1")
    # Each distinct line once, with the number of texts that have no other one in
    # its leaf, and the first document that has it.
    distinct = scratch.put(
        one_of.groupBy(*here).agg(F.sum((F.col("size") == 1).cast("long")).alias("n"), F.min("id").alias("first_id")),
        "distinct",
    )
    # The only other place where lines' texts go: one for each distinct line.
    words = scratch.put(
        found.groupBy(*here).agg(F.any_value("line").alias("line"))
        .select(*here, F.split("line", " ").alias("tokens")),
        "words",
    )
    at = F.posexplode("tokens").alias("pos", "token")
    by_line = words.join(distinct.select(*here, "n").hint("merge"), here).select(*here, "n", at)
    by_text = words.join(several.select(*here, "t").hint("merge"), here).select("leaf", "t", at).distinct()
    fixed = scratch.put(
        by_line.select("leaf", "pos", "token", "n")
        .unionByName(by_text.select("leaf", "pos", "token", F.lit(1).cast("long").alias("n")))
        .where(F.col("token") != FIELD).groupBy("leaf", "pos", "token").agg(F.sum("n").alias("in_texts"))
        .where(F.col("in_texts") >= min_texts).join(leaves.hint("merge"), "leaf")
        .select(
            "leaf", "pos", "token", F.lit(True).alias("fixed"),
            F.when(F.col("in_texts") * FIELD_ONE_IN >= F.col("leaf_texts"), True).alias("common"),
        ),
        "fixed",
    )
    place = F.struct(
        "pos", F.when(F.col("fixed"), F.col("token")).otherwise(FIELD).alias("fixed"),
        F.when(F.col("common"), F.col("token")).otherwise(FIELD).alias("common"),
    )
    enough = FIXED_TOKENS * F.col("n_tokens")
    # Lines alike by their fixed tokens are alike by their common ones: none is split.
    template = F.when(F.col("n_common") >= enough, F.col("places.common")).otherwise(F.col("places.fixed"))
    general = (
        words.select(*here, at).join(fixed.hint("merge"), ["leaf", "pos", "token"], "left")
        .groupBy(*here).agg(
            F.array_sort(F.collect_list(place)).alias("places"), F.count("fixed").alias("n_fixed"),
            F.count("common").alias("n_common"), F.count(F.lit(1)).alias("n_tokens"),
        )
        .where(F.col("n_fixed") >= enough)
        .withColumn("template", F.array_join(template, " ")).select(*here, *_hashes("template"))
    )
    templates = scratch.put(general.join(distinct.hint("merge"), here), "templates")
    same = ["leaf", *TEMPLATE]
    templates_of_several = (
        several.select(*here, "t").join(templates.select(*here, *TEMPLATE).hint("merge"), here)
        .select(*same, "t").distinct()
        .select(*same, F.lit(1).cast("long").alias("n"), F.lit(None).cast("long").alias("first_id"))
    )
    counted = templates.select(*same, "n", "first_id").unionByName(templates_of_several)
    recurring = counted.groupBy(*same).agg(
        F.sum("n").alias("n_texts"), F.min("first_id").alias("kept_in")
    ).where(F.col("n_texts") >= min_texts)
    gone = scratch.put(
        templates.select(*here, *TEMPLATE).join(recurring.hint("merge"), same).select(*here, "kept_in"), "gone"
    )
    gone_lines = F.collect_set("line_no").alias("__gone_lines")
    dropped = scratch.put(
        found.select("id", "row", "line_no", *here).join(gone.hint("merge"), here).where("id <> kept_in")
        .groupBy(F.col("row").alias("__gone_row")).agg(gone_lines),
        "dropped",
    )
    scratch.keep_only("dropped")
    rows = df.drop("n_lines", "n_dropped")
    joined = rows.withColumn("__row", row).join(
        dropped.hint("merge"), F.col("__row") == F.col("__gone_row"), "left"
    )
    parts, lost = F.split(text_col, "\n"), F.col("__gone_lines")
    left = F.filter(
        F.transform(parts, lambda x, i: F.when(~F.array_contains(lost, i), x)), lambda x: x.isNotNull()
    )
    text = F.when(lost.isNull(), F.col(text_col)).otherwise(F.array_join(left, "\n"))
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in rows.columns],
        F.coalesce(_count(F.col(text_col), "\n") + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.when(lost.isNull(), 0).otherwise(F.size(lost)).cast("long").alias("n_dropped"),
    )


ORACLE_SQL = rf"""
WITH ln AS (
  SELECT doc_id, md5(text) AS t, generate_subscripts(parts, 1) AS line_no,
    regexp_replace(translate(unnest(parts), chr(9) || chr(11) || chr(12) || chr(13), '    '), '[^ ]*[0-9][^ ]*', '{FIELD}', 'g') AS line
  FROM (SELECT *, string_split(text, chr(10)) AS parts FROM documents)
), lf AS (
  SELECT *, array_to_string(string_split(line, ' ')[1:{LEADING}], ' ') AS lead, len(string_split(line, ' ')) AS n_tokens
  FROM ln WHERE len(string_split(line, ' ')) >= {MIN_TOKENS} OR strlen(line) >= {MIN_CHARS}
), leaves AS (
  SELECT n_tokens, lead, count(DISTINCT t) AS leaf_texts FROM lf GROUP BY ALL HAVING leaf_texts >= {MIN_TEXTS}
), found AS (SELECT * FROM lf JOIN leaves USING (n_tokens, lead)
), tok AS (
  SELECT *, unnest(string_split(line, ' ')) AS token, generate_subscripts(string_split(line, ' '), 1) AS pos
  FROM (SELECT DISTINCT n_tokens, lead, leaf_texts, line, t FROM found)
), fixed AS (
  SELECT n_tokens, lead, pos, token, {FIELD_ONE_IN} * count(DISTINCT t) >= leaf_texts AS common
  FROM tok WHERE token <> '{FIELD}' GROUP BY n_tokens, lead, leaf_texts, pos, token HAVING count(DISTINCT t) >= {MIN_TEXTS}
), general AS (
  SELECT w.n_tokens, w.lead, line, count(fixed.pos) AS n_fixed, count(*) FILTER (WHERE common) AS n_common,
    string_agg(CASE WHEN fixed.pos IS NULL THEN '{FIELD}' ELSE w.token END, ' ' ORDER BY w.pos) AS by_fixed,
    string_agg(CASE WHEN common THEN w.token ELSE '{FIELD}' END, ' ' ORDER BY w.pos) AS by_common
  FROM (SELECT DISTINCT n_tokens, lead, line, pos, token FROM tok) w
  LEFT JOIN fixed ON w.n_tokens = fixed.n_tokens AND w.lead = fixed.lead
    AND w.pos = fixed.pos AND w.token = fixed.token
  GROUP BY w.n_tokens, w.lead, line
), templ AS (
  SELECT n_tokens, lead, line, CASE WHEN n_common >= {FIXED_TOKENS} * n_tokens THEN by_common ELSE by_fixed END AS template
  FROM general WHERE n_fixed >= {FIXED_TOKENS} * n_tokens
), recurring AS (
  SELECT n_tokens, lead, template, min(doc_id) AS kept_in FROM found JOIN templ USING (n_tokens, lead, line)
  GROUP BY ALL HAVING count(DISTINCT t) >= {MIN_TEXTS}
), gone AS (
  SELECT doc_id, line_no FROM found JOIN templ USING (n_tokens, lead, line) JOIN recurring USING (n_tokens, lead, template)
  WHERE doc_id <> kept_in
), rest AS (
  SELECT doc_id, count(*) AS n_lines, count(g.line_no) AS n_dropped,
    coalesce(string_agg(raw, chr(10) ORDER BY a.line_no) FILTER (WHERE g.line_no IS NULL), '') AS left_text
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
      generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents) a
  LEFT JOIN gone g USING (doc_id, line_no) GROUP BY doc_id
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(left_text) AS text_sha256
FROM documents LEFT JOIN rest USING (doc_id)
"""
