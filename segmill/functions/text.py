r"""Row-local text functions: each turns one text into an array, without a shuffle.

Texts are expected with ``\n`` line ends (``sources.scripts`` sees to that).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, keywords and method names of the extraction jobs.
# The atomic group keeps to the first "from": where no ")" follows it, none
# follows a later one, and trying them all would take cubic time.
FRAGMENT_PATTERN = (
    r'(\.table\s*\(\s*".*?"\s*\)|\.sql\s*\(\s*".*?"\s*\)|select\s*\((?>.+?from)\s*.+?\))'
)
FRAGMENT_MARKS = (".table", ".sql")
QUOTED_PATTERN = r"""["']([^\n]+?)["']"""
BLOCK_KEYWORDS = ("select", "from", "where", "join", "group by", "order by")
BLOCK_ENDINGS = (")", ";")
NORMALISE_DELETED = ("$", ".table", ".withColumn", ".select", '"')
METHOD_NAMES = (
    "select", "withColumn", "join", "filter", "where", "groupBy", "orderBy", "agg",
)
SCAN_KEPT = " (),.="

# White space as str.strip() understands it, without and with the line end.
BLANK = (
    r"\t\x0b\f\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
SPACE = r"\n" + BLANK


def _one_of(words: Sequence[str]) -> str:
    return "|".join(re.escape(w) for w in words)


def _char_class(chars: Sequence[str]) -> str:
    return "[" + "".join(re.escape(c) for c in chars) + "]"


def strip(x: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(x, f"^[{SPACE}]+|[{SPACE}]+\\z", "")


def unix_newlines(x: Column) -> Column:
    return F.regexp_replace(x, r"\r\n?", "\n")


def lines(x: Column) -> Column:
    return F.split(x, "\n", -1)


def lines_with_ends(x: Column) -> Column:
    return F.split(x, r"(?<=\n)", -1)


def fragments(x: Column, pattern: str = FRAGMENT_PATTERN) -> Column:
    """Matches of ``pattern``; one that names a table or query is cut to its first quoted part.

    A marked fragment without a quoted part is dropped.  ``pattern`` is case
    insensitive, its dot matches line ends and its group 1 is the fragment.
    """

    def cut(fragment: Column) -> Column:
        marked = F.lit(False)
        for mark in FRAGMENT_MARKS:
            marked = marked | F.contains(fragment, F.lit(mark))
        # The quoted part is never empty, so "" says that there is none.
        quoted = F.regexp_extract(fragment, QUOTED_PATTERN, 1)
        return F.when(marked, quoted).otherwise(fragment)

    found = F.regexp_extract_all(x, F.lit(f"(?isU){pattern}"), F.lit(1))
    return F.filter(F.transform(found, lambda f: cut(f)), lambda s: s != "")


def line_blocks(
    x: Column,
    keywords: Sequence[str] = BLOCK_KEYWORDS,
    endings: Sequence[str] = BLOCK_ENDINGS,
) -> Column:
    """Runs of whole lines from one with a keyword to the next that ends in an ending.

    Keywords match as lower-cased substrings, endings after stripping.  A run
    that the text leaves open is matched to the end, so that the search stays
    linear, and then dropped.
    """
    closed = f"{_char_class(endings)}[{BLANK}]*"
    run = f"(?imds)^[^\\n]*?(?:{_one_of(keywords)}).*?(?:{closed}(?:\\n|\\z)|\\z)"
    found = F.regexp_extract_all(x, F.lit(run), F.lit(0))
    return F.filter(found, lambda b: F.rlike(b, F.lit(f"{closed}\\n?\\z")))


def leading_end(x: Column, endings: Sequence[str] = BLOCK_ENDINGS) -> Column:
    """The whole lines up to the first that ends in an ending; empty if none does."""
    closed = f"{_char_class(endings)}[{BLANK}]*(?:\\n|\\z)"
    return F.regexp_extract(x, f"(?s)\\A(?:.*?{closed})", 0)


def trailing_open(
    x: Column, keywords: Sequence[str] = BLOCK_KEYWORDS, endings: Sequence[str] = BLOCK_ENDINGS
) -> Column:
    """The run that a text leaves open: whole lines from a keyword after the last ending; empty if none."""
    rest = F.regexp_replace(x, f"(?s)\\A.*{_char_class(endings)}[{BLANK}]*(?:\\n|\\z)", "")
    return F.regexp_extract(rest, f"(?ims)^[^\\n]*?(?:{_one_of(keywords)}).*\\z", 0)


def _squeeze(block: Column) -> Column:
    """A block without query-builder syntax, on one line."""
    q = block
    for text in NORMALISE_DELETED:
        q = F.replace(q, F.lit(text), F.lit(""))
    q = F.replace(q, F.lit("=="), F.lit("="))
    q = F.regexp_replace(q, f"\\.[{SPACE}]*", "")
    return strip(F.regexp_replace(q, f"[{SPACE}]+", " "))


def _assigned(q: Column) -> Column:
    """The right side of a value definition, other text as it is."""
    right = strip(F.substring_index(q, "=", -1))
    return F.when(F.contains(q, F.lit("val ")), right).otherwise(q)


def normalised_blocks(
    x: Column,
    keywords: Sequence[str] = BLOCK_KEYWORDS,
    endings: Sequence[str] = BLOCK_ENDINGS,
) -> Column:
    """Line blocks as single lines of query-like text."""
    return normalised(line_blocks(x, keywords, endings))


def normalised(blocks: Column) -> Column:
    """An array of line blocks as single lines of query-like text."""
    # Two passes, as a lambda would evaluate the squeezed text at each mention.
    squeezed = F.transform(blocks, lambda b: _squeeze(b))
    return F.transform(squeezed, lambda q: _assigned(q))


def scanned(x: Column) -> Column:
    r"""A text without literals, comments, digits or line ends.

    A quote toggles "inside a literal" unless a backslash stands right before
    it.  ``//`` opens a comment, a line end or ``/*`` closes it.  The two
    states do not know of each other: a quote in a comment counts, and so does
    ``//`` in a literal.  Outside both, letters, semicolons and `` (),.=`` are kept.

    Splitting does the state keeping.  Comments are cut down to their quotes;
    then every second part between quotes is outside a literal.
    """
    # A digit is never kept and opens or closes nothing, so it can stand in
    # for an escaped quote without making new neighbours.
    counted = F.regexp_replace(x, r"""(?<=\\)["']""", "0")
    one_quote = F.replace(counted, F.lit("'"), F.lit('"'))
    # A comment, plain text, or a lone slash.  "//*" opens and closes at once.
    tokens = F.regexp_extract_all(
        one_quote, F.lit(r"/(?=/)[^\n]*?(?:\n|/\*|\z)|[^/]+|/"), F.lit(0)
    )
    uncommented = F.array_join(
        F.transform(
            tokens,
            lambda t: F.when(
                F.startswith(t, F.lit("//")), F.regexp_replace(t, '[^"]+', "")
            ).otherwise(t),
        ),
        "",
    )
    outside = F.array_join(
        F.filter(F.split(uncommented, '"', -1), lambda _, i: i % 2 == 0), ""
    )
    return F.regexp_replace(outside, f"[^\\p{{L}};{re.escape(SCAN_KEPT)}]+", "")


def scan_statements(x: Column) -> Column:
    """Statements between semicolons of the ``scanned`` text."""
    parts = F.filter(F.split(scanned(x), ";", -1), lambda s: s != "")
    return F.transform(parts, lambda s: F.trim(s))


def method_calls(x: Column, names: Sequence[str] = METHOD_NAMES) -> Column:
    """Names of the calls ``.name(…)``, in text order.

    A call reaches to the next ")" and hides the calls before it.  An open one
    is matched to the end of the text, as in ``line_blocks``, and dropped.
    """
    call = rf"(?s)\.(?:{_one_of(names)})\(.*?(?:\)|\z)"
    found = F.regexp_extract_all(x, F.lit(call), F.lit(0))
    closed = F.filter(found, lambda c: F.endswith(c, F.lit(")")))
    return F.transform(closed, lambda c: F.ltrim(F.substring_index(c, "(", 1), F.lit(".")))


def pattern_matches(x: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(x, F.lit(pattern), F.lit(group))


def chars(x: Column) -> Column:
    """The characters (code points) of a text; none for an empty one."""
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, "", -1))


def join_statements(statements: Column, separator: str = "\n\n", terminal: bool = False) -> Column:
    """One text from an array; ``terminal`` puts the separator after each, not between."""
    if terminal:
        statements = F.transform(statements, lambda s: F.concat(s, F.lit(separator)))
        separator = ""
    return F.array_join(statements, separator)


def encode_chars(x: Column, ids_by_code_point: Column) -> Column:
    """Vocabulary ids of a text's characters, 0 for unknown ones."""
    return F.transform(
        chars(x), lambda c: F.coalesce(F.get(ids_by_code_point, F.ascii(c)), F.lit(0))
    )


def pad_ids(ids: Column, size: Column, length: Column) -> Column:
    """Right-pad with 0 from ``size`` up to ``length``; longer sequences stay whole."""
    return F.concat(ids, F.array_repeat(F.lit(0), F.greatest(length - size, F.lit(0))))


def decode_ids(ids: Column, chars_by_id: Column) -> Column:
    return F.array_join(F.transform(ids, lambda i: F.get(chars_by_id, i)), "")
