"""Column functions for names, blanks, sentences, tokens and stable ids.

Every function takes and returns ``pyspark.sql.Column`` built from Spark's
own SQL functions, so they stay inside the JVM, work inside higher-order
lambdas (``transform``/``aggregate``) and can be pushed into any plan.

The patterns below are written so that Java regex (Spark) and RE2 (the
DuckDB oracle) read them the same way: character classes are spelled out,
code points use the ``\\x{...}`` form both engines accept, and there is no
look-around.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (they define the text semantics; keep them in this order).
#
# SPACE_CODE_POINTS: the characters Python's str.strip()/str.isspace() treat
#   as white space: TAB LF VT FF CR, U+001C..U+001F, SPACE, U+0085, U+00A0,
#   U+1680, U+2000..U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
# TITLE_PATTERN: the last extension of a file name, where leading dots are
#   not an extension (the rule of os.path.splitext): keep group 1.
# SENTENCE_END: a sentence ends at . ! or ? followed by white space.
# TOKEN_PATTERN: a token is a run of letters/digits or any other single
#   non-space character.
# SENTENCE_MARK: U+0001, the cut mark placed between sentences.
# ---------------------------------------------------------------------------
SPACE_CODE_POINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# the same set as a string (for trimming) and as a regex class body, the
# code points written \x{..} so Java regex and RE2 read them alike
SPACE_STRING = "".join(chr(c) for c in SPACE_CODE_POINTS)
SPACE_CHARS = "".join("\\x{%X}" % c for c in SPACE_CODE_POINTS)
SPACE_CLASS = "[" + SPACE_CHARS + "]"
NON_SPACE_CLASS = "[^" + SPACE_CHARS + "]"
TITLE_PATTERN = "(?s)^(\\.*[^.].*)\\.[^.]*$"
SENTENCE_END = "([.!?])" + SPACE_CLASS + "+"
TOKEN_PATTERN = "[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}" + SPACE_CHARS + "]"
SENTENCE_MARK = "\u0001"
DOCX_SUFFIX = ".docx"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_of(name: Column | str) -> Column:
    """File name -> title: drop the last extension (``a.b.docx`` -> ``a.b``).

    Leading dots are not an extension (``.docx`` stays), and an extension-less
    name still loses everything after its last dot (``v1.2 notes`` -> ``v1``).
    """
    return F.regexp_replace(_c(name), TITLE_PATTERN, "$1")


def docx_name(name: Column | str) -> Column:
    """The landed file name of a source file: title + ``.docx``."""
    return F.concat(title_of(name), F.lit(DOCX_SUFFIX))


def is_blank(text: Column | str) -> Column:
    """True when the text is null or has nothing but white space."""
    return F.coalesce(~_c(text).rlike(NON_SPACE_CLASS), F.lit(True))


def strip_space(text: Column | str) -> Column:
    """Python-style ``str.strip()``: white space removed at both ends.

    ``btrim`` only looks at the ends of the string; an anchored regex would
    be tried (and backtrack) at every white-space run of the text."""
    return F.btrim(_c(text), F.lit(SPACE_STRING))


def sentences(text: Column | str) -> Column:
    """Text -> ``array<string>`` of sentences (rule based, no model).

    A sentence ends at ``.``, ``!`` or ``?`` followed by white space; that
    white space is dropped, white space inside a sentence (newlines too) is
    kept.  Blank text gives an empty array.
    """
    body = strip_space(F.translate(_c(text), SENTENCE_MARK, ""))
    marked = F.regexp_replace(body, SENTENCE_END, "$1" + SENTENCE_MARK)
    return F.filter(F.split(marked, SENTENCE_MARK), lambda s: s != F.lit(""))


def token_count(text: Column | str) -> Column:
    """Number of tokens: runs of letters/digits plus single other symbols."""
    return F.regexp_count(_c(text), F.lit(TOKEN_PATTERN))


def paragraphs(text: Column | str) -> Column:
    """Text -> non-blank lines (the paragraphs of an extracted document)."""
    return F.filter(F.split(_c(text), "\n"), lambda p: p.rlike(NON_SPACE_CLASS))


def join_paragraphs(paras: Column | str) -> Column:
    return F.array_join(_c(paras), "\n")


def stable_id(*cols: Column | str) -> Column:
    """Deterministic uuid-shaped id (8-4-4-4-12 hex) from key columns.

    md5 over the ``|``-joined string forms, in which ``|`` and ``\\`` are escaped, so that
    different parts never join to the same text; a null part counts as ``''``.
    Unlike ``uuid()`` it gives the same id when a task or stage is re-run,
    so chunk rows and their vectors always agree.
    """
    parts = [F.replace(F.replace(F.coalesce(_c(c).cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\")),
                       F.lit("|"), F.lit("\\|")) for c in cols]
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.substring(h, 13, 4),
        F.substring(h, 17, 4),
        F.substring(h, 21, 12),
    )
