"""String expressions that mirror Python string rules with Spark built-ins.

All helpers return ``Column`` expressions: they stay inside whole-stage
codegen and never call Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters that Python's str.split() / str.strip() take as whitespace, as the inside of a character class.
WHITESPACE = "\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_PATTERN = f"[^{WHITESPACE}]+"
_STRIP_PATTERN = f"^[{WHITESPACE}]+|[{WHITESPACE}]+\\z"


def col_or_lit(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def py_strip(c) -> Column:
    """``str.strip()`` (``trim`` removes spaces only)."""
    return F.regexp_replace(col_or_lit(c), _STRIP_PATTERN, "")


def words(c) -> Column:
    """``str.split()`` with no argument: ARRAY<STRING> of non-blank pieces."""
    return F.regexp_extract_all(col_or_lit(c), F.lit(WORD_PATTERN), 0)


def word_count(c) -> Column:
    return F.size(words(c)).cast("bigint")


def text_lines(c) -> Column:
    """Lines of a text the way a line reader yields them.

    ``\\r\\n``, ``\\n`` and a lone ``\\r`` end a line, as in Spark's text reader; a final
    line terminator does not add an empty line; blank lines stay as empty strings.
    """
    body = F.regexp_replace(F.regexp_replace(col_or_lit(c), r"\r\n?", "\n"), r"\n\z", "")
    return F.split(body, "\n", -1)


def regex_quote(s: str) -> str:
    """Literal pattern for Java regex / RE2 (both accept backslash escapes)."""
    return re.sub(r"([\\^$.|?*+()\[\]{}])", r"\\\1", s)


def substring_after_last(c, marker: str) -> Column:
    """``s.split(marker)[-1]`` (whole string when the marker is absent)."""
    return F.substring_index(col_or_lit(c), marker, -1)


def rfind_slice(c, marker: str) -> Column:
    """``s[s.rfind(marker) + len(marker):]`` including the absent case (rfind = -1)."""
    c = col_or_lit(c)
    n = len(marker)
    # absent: rfind is -1, so the slice starts at 0-based n-1, i.e. 1-based n
    return F.when(F.instr(c, marker) > 0, F.substring_index(c, marker, -1)).otherwise(
        F.substring(c, n, 1 << 30)
    )
