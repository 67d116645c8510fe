"""Script mining.

The SQL side finds blocks and statements with windows over lines and
characters, the Spark side without leaving the row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from segmill.catalog.base import Derived, check, text_table
from segmill.functions import text as T
from segmill.plans import mining, split_texts
from segmill.sources.config import JobConfig

# Script-like texts: the prose gets method calls, quotes, comments and ends of
# statements by fixed replacements.
SCRIPTS = Derived("""
    SELECT doc_id, replace(replace(replace(replace(replace(replace(text,
             '. ', ');' || chr(10)), ' the ', '.select($"from '), ' que ', '.table("'),
             ' der ', ' val x === where '), ', ', '") // '), '; ', ' /* ') AS script
    FROM {documents}
""")


@check(
    "SELECT page_id, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos, unnest(a) AS statement "
    """FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS a FROM pages)"""
)
def t1_quoted_links(spark, sf):
    return mining.extract(
        text_table(spark, sf, "pages"), "page_id", "html",
        lambda x: T.pattern_matches(x, 'href="([^"]*)"'),
    )


_FRAGMENT = T.FRAGMENT_PATTERN.replace("(?>", "(?:").replace("'", "''")
_QUOTED = T.QUOTED_PATTERN.replace("'", "''")


@check(
    f"""
    WITH found AS (
      SELECT doc_id, regexp_extract_all(script, '(?is){_FRAGMENT}', 1) AS a FROM {SCRIPTS.sql}
    ), cut AS (
      SELECT doc_id, list_filter(list_transform(a, lambda f:
        CASE WHEN contains(f, '.table') OR contains(f, '.sql')
             THEN regexp_extract(f, '{_QUOTED}', 1) ELSE f END), lambda s: s <> '') AS a
      FROM found
    )
    SELECT doc_id, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos, unnest(a) AS statement
    FROM cut
    """
)
def t1_fragments(spark, sf):
    return mining.extract(SCRIPTS.df(spark, sf, text_table), "doc_id", "script", T.fragments)


def _blocks_sql(source: str, id_col: str, keywords, block: str) -> str:
    """Blocks by window: number the lines' segments, keep each from its first keyword line."""
    keyword = " OR ".join(f"contains(lower(line), '{k}')" for k in keywords)
    return f"""
    WITH parts AS (SELECT {id_col}, string_split(script, chr(10)) AS p FROM {source}),
    numbered AS (
      SELECT {id_col}, unnest(p) AS line, generate_subscripts(p, 1) AS n, len(p) AS total FROM parts
    ), marked AS (
      SELECT *, CASE WHEN {keyword} THEN 1 ELSE 0 END AS starts,
             CASE WHEN regexp_matches(line, '[);]\\s*$') THEN 1 ELSE 0 END AS ends
      FROM numbered
    ), segmented AS (
      SELECT *, coalesce(sum(ends) OVER (PARTITION BY {id_col} ORDER BY n
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
      FROM marked
    ), opened AS (
      SELECT *, max(starts) OVER (PARTITION BY {id_col}, seg ORDER BY n) AS is_open,
             max(ends) OVER (PARTITION BY {id_col}, seg) AS closed
      FROM segmented
    ), blocks AS (
      SELECT {id_col}, seg,
             {block} AS statement
      FROM opened WHERE is_open = 1 AND closed = 1 GROUP BY {id_col}, seg
    )
    SELECT {id_col}, CAST(row_number() OVER (PARTITION BY {id_col} ORDER BY seg) - 1 AS INTEGER) AS pos,
           statement FROM blocks
    """


# A block keeps its lines' ends; the last line of a text has none.
RAW_BLOCK = "string_agg(line || CASE WHEN n < total THEN chr(10) ELSE '' END, '' ORDER BY n)"
STRIPPED_BLOCK = (
    "string_agg(regexp_replace(line, '^\\s+|\\s+$', '', 'g'), ' ' ORDER BY n)"
)


@check(_blocks_sql(SCRIPTS.sql, "doc_id", T.BLOCK_KEYWORDS, RAW_BLOCK))
def t2_line_blocks(spark, sf):
    return mining.extract(SCRIPTS.df(spark, sf, text_table), "doc_id", "script", T.line_blocks)


PAGES = Derived("SELECT page_id, replace(html, '><', '>)' || chr(10) || '<') AS script FROM {pages}")


@check(_blocks_sql(PAGES.sql, "page_id", ("href", "class"), RAW_BLOCK))
def t2_page_blocks(spark, sf):
    return mining.extract(
        PAGES.df(spark, sf, text_table), "page_id", "script", lambda x: T.line_blocks(x, ("href", "class"))
    )


_NORMAL = "statement"
for _deleted in T.NORMALISE_DELETED:
    _NORMAL = f"replace({_NORMAL}, '{_deleted}', '')"
_NORMAL = f"replace({_NORMAL}, '==', '=')"
_NORMAL = f"regexp_replace({_NORMAL}, '\\.\\s*', '', 'g')"
_NORMAL = f"trim(regexp_replace({_NORMAL}, '\\s+', ' ', 'g'))"


@check(
    f"SELECT doc_id, pos, CASE WHEN contains(q, 'val ') THEN trim(string_split(q, '=')[-1]) "
    f"ELSE q END AS statement FROM (SELECT doc_id, pos, {_NORMAL} AS q FROM "
    f"({_blocks_sql(SCRIPTS.sql, 'doc_id', T.BLOCK_KEYWORDS, STRIPPED_BLOCK)}))"
)
def t3_normalised_blocks(spark, sf):
    return mining.extract(SCRIPTS.df(spark, sf, text_table), "doc_id", "script", T.normalised_blocks)


def _scan_sql(source: str, id_col: str, text_col: str) -> str:
    """The scan by window: quote parity, last comment event and semicolons, per character."""
    return rf"""
    WITH chars AS (
      SELECT {id_col}, unnest(c) AS ch, generate_subscripts(c, 1) AS n
      FROM (SELECT {id_col}, regexp_extract_all({text_col}, '(?s).') AS c FROM {source})
    ), prev AS (
      SELECT *, lag(ch, 1, '') OVER (PARTITION BY {id_col} ORDER BY n) AS p FROM chars
    ), events AS (
      SELECT *, CASE WHEN ch IN ('"', '''') AND p <> '\' THEN 1 ELSE 0 END AS quote,
             CASE WHEN ch = '/' AND p = '/' THEN 1 WHEN ch = chr(10) THEN 0
                  WHEN ch = '*' AND p = '/' THEN 0 END AS comment
      FROM prev
    ), states AS (
      SELECT *, sum(quote) OVER w % 2 AS in_string,
             coalesce(last_value(comment IGNORE NULLS) OVER w, 0) AS in_comment
      FROM events WINDOW w AS (PARTITION BY {id_col} ORDER BY n)
    ), outside AS (
      SELECT *, sum(CASE WHEN ch = ';' THEN 1 ELSE 0 END) OVER
             (PARTITION BY {id_col} ORDER BY n) AS seg
      FROM states WHERE in_string = 0 AND in_comment = 0
    ), statements AS (
      SELECT {id_col}, seg, trim(string_agg(ch, '' ORDER BY n)) AS statement
      FROM outside WHERE regexp_matches(ch, '[\p{{L}} (),.=]') GROUP BY {id_col}, seg
    )
    SELECT {id_col}, CAST(row_number() OVER (PARTITION BY {id_col} ORDER BY seg) - 1 AS INTEGER) AS pos,
           statement FROM statements
    """


@check(_scan_sql("benchmark", "item_id", "text"))
def t4_scanned_benchmark(spark, sf):
    return mining.extract(text_table(spark, sf, "benchmark"), "item_id", "text", T.scan_statements)


@check(_scan_sql(SCRIPTS.sql, "doc_id", "script"))
def t4_scanned_scripts(spark, sf):
    return mining.extract(SCRIPTS.df(spark, sf, text_table), "doc_id", "script", T.scan_statements)


@check(_scan_sql("pages", "page_id", "html"))
def t4_scanned_pages(spark, sf):
    return mining.extract(text_table(spark, sf, "pages"), "page_id", "html", T.scan_statements)


@check(_scan_sql("pages", "page_id", "html"))
def t4_scanned_pieces(spark, sf):
    """Every page cut anywhere into pieces, which are scanned by themselves."""
    pieces = split_texts.cut_texts(text_table(spark, sf, "pages"), "page_id", "html", 700)
    return split_texts.scan_statements(pieces, "page_id", JobConfig())


@check(_blocks_sql(SCRIPTS.sql, "doc_id", T.BLOCK_KEYWORDS, RAW_BLOCK))
def t2_blocks_of_pieces(spark, sf):
    """Line blocks that may cross the cuts between pieces of whole lines."""
    pieces = split_texts.cut_at_lines(SCRIPTS.df(spark, sf, text_table), "doc_id", "script", 500)
    return split_texts.line_blocks(pieces, "doc_id", JobConfig())


@check(
    f"SELECT doc_id, pos, CASE WHEN contains(q, 'val ') THEN trim(string_split(q, '=')[-1]) "
    f"ELSE q END AS statement FROM (SELECT doc_id, pos, {_NORMAL} AS q FROM "
    f"({_blocks_sql(SCRIPTS.sql, 'doc_id', T.BLOCK_KEYWORDS, STRIPPED_BLOCK)}))"
)
def t3_blocks_of_pieces(spark, sf):
    pieces = split_texts.cut_at_lines(SCRIPTS.df(spark, sf, text_table), "doc_id", "script", 500)
    return split_texts.normalised_blocks(pieces, "doc_id", JobConfig())


_METHODS = "|".join(T.METHOD_NAMES)


@check(
    "SELECT doc_id, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos, unnest(a) AS statement "
    rf"FROM (SELECT doc_id, regexp_extract_all(script, '(?s)\.({_METHODS})\(.*?\)', 1) AS a "
    f"FROM {SCRIPTS.sql})"
)
def t5_method_calls(spark, sf):
    return mining.extract(SCRIPTS.df(spark, sf, text_table), "doc_id", "script", T.method_calls)


@check(
    "SELECT name, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, "
    "'<([a-z0-9]+)[ >]', 1)) AS name FROM pages) GROUP BY name"
)
def a3_tag_frequency(spark, sf):
    return mining.frequency(
        text_table(spark, sf, "pages"), "html", lambda x: T.pattern_matches(x, "<([a-z0-9]+)[ >]")
    )


def _vocabulary_sql(name: str, text_col: str) -> str:
    return (
        "SELECT ch, CAST(row_number() OVER (ORDER BY unicode(ch)) - 1 AS INTEGER) AS idx FROM "
        f"(SELECT DISTINCT unnest(regexp_extract_all({text_col}, '(?s).')) AS ch FROM {name})"
    )


@check(_vocabulary_sql("benchmark", "text"))
def t6_benchmark_vocabulary(spark, sf):
    return mining.vocabulary(text_table(spark, sf, "benchmark"), "text")


@check(_vocabulary_sql("documents", "text"))
def t6_document_vocabulary(spark, sf):
    return mining.vocabulary(text_table(spark, sf, "documents"), "text")


@check(
    f"""
    WITH vocab AS ({_vocabulary_sql("benchmark", "text")}),
    ids AS (
      SELECT conv_id, turn, generate_subscripts(c, 1) AS n, unnest(c) AS ch
      FROM (SELECT conv_id, turn, regexp_extract_all(text, '(?s).') AS c FROM conversations)
    )
    SELECT conv_id, turn, CAST((SELECT max(length(text)) FROM conversations) AS INTEGER) AS length,
           CAST(sum(n * coalesce(idx, 0)) AS BIGINT) AS checksum
    FROM ids LEFT JOIN vocab USING (ch) GROUP BY conv_id, turn
    """
)
def t7_encoded_conversations(spark, sf):
    """Encoded with another table's vocabulary, so unknown characters occur."""
    texts = text_table(spark, sf, "conversations").select("conv_id", "turn", "text")
    vocab = mining.vocabulary(text_table(spark, sf, "benchmark"), "text")
    encoded = mining.encode(texts, "text", vocab, pad_to=mining.longest(texts, "text"))
    weighted = F.transform("ids", lambda x, i: x.cast("bigint") * (i + 1))
    checksum = F.aggregate(weighted, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return encoded.select(
        "conv_id", "turn", F.size("ids").alias("length"), checksum.alias("checksum")
    )


@check(
    f"""
    WITH vocab AS ({_vocabulary_sql("benchmark", "text")})
    SELECT item_id, rpad(text, CAST((SELECT max(length(text)) FROM benchmark) AS INTEGER),
                         (SELECT ch FROM vocab WHERE idx = 0)) AS decoded
    FROM benchmark
    """
)
def t8_decoded_benchmark(spark, sf):
    texts = text_table(spark, sf, "benchmark")
    vocab = mining.vocabulary(texts, "text")
    encoded = mining.encode(texts, "text", vocab, pad_to=mining.longest(texts, "text"))
    return mining.decode(encoded, "ids", vocab, out="decoded").select("item_id", "decoded")
