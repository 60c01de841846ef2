"""Text columns: blank tests, trimming and accent folding, all on the JVM side."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. TRIMMED: every code point up to U+0020, what a JVM string trim removes.
# BLANKS: the code points a JVM blank test treats as white space (no-break spaces excluded).
TRIMMED = "".join(chr(c) for c in range(0x21))
BLANKS = (
    "".join(chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x1680])
    + "".join(chr(c) for c in [*range(0x2000, 0x2007), *range(0x2008, 0x200B)])
    + "".join(chr(c) for c in [0x2028, 0x2029, 0x205F, 0x3000])
)
COMBINING = "[\u0300-\u036F]+"


def _accent_table() -> tuple[str, str]:
    """Lower-case letters whose canonical decomposition is an ASCII letter plus combining marks."""
    pairs = []
    for code in range(0x80, 0x2000):
        base, *marks = unicodedata.normalize("NFD", chr(code))
        if base.isascii() and base.islower() and marks and all(0x300 <= ord(m) <= 0x36F for m in marks):
            pairs.append((chr(code), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _accent_table()


def clean(text: Column) -> Column:
    """The trimmed text, '' for null."""
    return F.coalesce(F.btrim(text, F.lit(TRIMMED)), F.lit(""))


def is_blank(text: Column) -> Column:
    """True for null, empty or all-white-space text."""
    return F.coalesce(F.btrim(text, F.lit(BLANKS)), F.lit("")) == ""


def fold_accents(text: Column) -> Column:
    """Strip diacritics from lower-case text, composed or decomposed."""
    return F.regexp_replace(F.translate(text, ACCENTED, PLAIN), COMBINING, "")
