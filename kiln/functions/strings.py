"""String scalar functions (X1-X9) as ``Column -> Column`` expressions.

All run inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's for identical results) ------
# Markdown image marker and HTML/XML tag patterns stripped from text; '.' does
# not cross a newline, matching Python's re default.
MARKDOWN_IMAGE_PATTERN = r"\n\n!\[\]\(.*?\)"
TAG_PATTERN = r"<.*?>"
# Characters deleted from a raw answer before parsing it as a number.
ANSWER_DELETE_CHARS = "[]'$\\{}"
# Scientific-notation suffix removed before parsing ("12times 10^3" -> "12").
TIMES_POWER_PATTERN = r"times 10\^\d+"
# Characters stripped, one after the other, from both ends of a solution.
SOLUTION_STRIP_SEQUENCE = ("[", "]", "'", '"')
# Default for a missing or empty solution.
MISSING_TEXT_DEFAULT = "NONE"
# ---------------------------------------------------------------------------

# Plain decimal / exponent number, optional sign and surrounding blanks. Both
# Spark and DuckDB casts accept more than Python's float() in some places and
# less in others; this guard makes the accepted set identical everywhere.
NUMBER_GUARD = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_fields(line: Column | str, sep: str, names: Sequence[str],
                 dtype: str = "double") -> list[Column]:
    """Split a delimited line and type every field; a missing field
    or a bad value becomes null (``get`` and ``try_cast`` never raise)."""
    parts = F.split(_c(line), sep)
    return [F.get(parts, i).try_cast(dtype).alias(n) for i, n in enumerate(names)]


def strip_pattern(col: Column | str, pattern: str) -> Column:
    """Delete every match of a regular expression."""
    return F.regexp_replace(_c(col), pattern, "")


def strip_markup(col: Column | str) -> Column:
    """Remove Markdown images, then tags."""
    return strip_pattern(strip_pattern(col, MARKDOWN_IMAGE_PATTERN), TAG_PATTERN)


def delete_chars(col: Column | str, chars: str = ANSWER_DELETE_CHARS) -> Column:
    """Delete every character of ``chars``."""
    return F.translate(_c(col), chars, "")


def strip_chars_in_sequence(col: Column | str,
                            chars: Sequence[str] = SOLUTION_STRIP_SEQUENCE) -> Column:
    """Strip each character from both ends, one character after another
    (like chained ``str.strip(ch)`` calls)."""
    out = _c(col)
    for ch in chars:
        out = F.btrim(out, F.lit(ch))
    return out


def trim_lower(col: Column | str) -> Column:
    """White space of any kind goes from both ends."""
    return F.lower(F.regexp_replace(_c(col), r"^\s+|\s+$", ""))


def fill_template(template: str, *cols: Column | str) -> Column:
    """``format_string`` template fill (``%s`` placeholders)."""
    return F.format_string(template, *[_c(c) for c in cols])


def is_present(col: Column | str) -> Column:
    """not null and not the empty string."""
    c = _c(col)
    return c.isNotNull() & (c != F.lit(""))


def join_if_present(base: Column | str, extra: Column | str, sep: str) -> Column:
    """``base + sep + extra`` when ``extra`` is present, else ``base``."""
    return F.when(is_present(extra), F.concat(_c(base), F.lit(sep), _c(extra))) \
        .otherwise(_c(base))


def default_if_blank(col: Column | str, default: str = MISSING_TEXT_DEFAULT) -> Column:
    """Null or empty -> default."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(default))


def parse_nonneg_int(col: Column | str) -> Column:
    """Remove ``times 10^d``, delete bracket/dollar characters, parse as a
    number; keep it only if it is integral and >= 0, else null. Values beyond
    bigint become null."""
    cleaned = delete_chars(F.regexp_replace(_c(col), TIMES_POWER_PATTERN, ""))
    num = F.when(cleaned.rlike(NUMBER_GUARD), F.trim(cleaned).try_cast("double"))
    ok = (F.floor(num) == num) & (num >= 0) & (num < F.lit(9.2e18))
    return F.when(ok, num.cast("bigint"))


def clean_solution(col: Column | str) -> Column:
    """X4 + X2 + X9: strip wrapper characters and markup, default when blank."""
    c = _c(col)
    return F.when(is_present(c), strip_markup(strip_chars_in_sequence(c))) \
        .otherwise(F.lit(MISSING_TEXT_DEFAULT))


WORD_GAP = r"[^\p{L}\p{N}]+"      # words are runs of letters and digits of any script


def words(text: Column | str, pattern: str = WORD_GAP) -> Column:
    """Lower-case word array, empty tokens removed (A1, M7, M8)."""
    return F.filter(F.split(F.lower(_c(text)), pattern), lambda w: w != F.lit(""))
