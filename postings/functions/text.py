"""Text expressions: whitespace, title case, ASCII slugs. Column in, column out."""

from __future__ import annotations

import functools
import re
import unicodedata

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and the four separator controls; \s alone is ASCII-only on the JVM.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it as often as ``body`` likes."""
    return F.element_at(F.transform(F.array(value), body), 1)


def squash(col: Column) -> Column:
    """Collapse every run of white space to one space and trim."""
    # Most values are ASCII with single blanks; they skip the search for Unicode white space.
    ascii_only = F.length(col) == F.octet_length(col)
    tidy = ascii_only & ~F.contains(col, F.lit("  ")) & ~col.rlike(r"[\t-\r\x1c-\x1f]")
    return F.trim(F.when(tidy, col).otherwise(F.regexp_replace(col, WS + "+", " ")))


def strip(col: Column) -> Column:
    """Drop leading and trailing white space of any kind."""
    return F.btrim(col, F.lit(WS_CHARS))


def strip_long(col: Column) -> Column:
    """:func:`strip` for long texts. It notes the place of every character to find the last one, so here it only sees the last
    bytes, and the whole text where these are (nearly) all white space. A character that is cut in two there is not reached."""
    text = F.ltrim(col, F.lit(WS_CHARS))
    tail = F.substring(text.cast("binary"), -64, 64).cast("string")
    rest = F.octet_length(F.rtrim(tail, F.lit(WS_CHARS)))
    ended = F.substring(text.cast("binary"), F.lit(1), F.octet_length(text) - F.octet_length(tail) + rest).cast("string")
    return F.when(rest > 8, ended).otherwise(strip(text))


def has_ink(col: Column) -> Column:
    """Is there anything but white space? NULL for NULL."""
    return col.rlike("[^" + WS[1:])


def blank_to_null(col: Column) -> Column:
    """NULL for a string that is empty once stripped, else the stripped string."""
    return F.nullif(strip(col), F.lit(""))


def title_case(col: Column) -> Column:
    """Upper-case the first letter of every run of letters ("3m co" -> "3M Co")."""
    runs = F.regexp_extract_all(col, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


@functools.lru_cache(maxsize=1)
def _decompositions() -> tuple[str, str, str, dict[str, str]]:
    """Characters whose compatibility decomposition holds ASCII letters or digits.

    Worked out from the Unicode database: in a slug every other character turns into "-", so only
    three shapes matter - one letter with marks ("é" -> "e-"), one bare letter or digit
    (full-width, superscript), and longer expansions (ligatures, roman numerals).
    """
    marked, bare, longer = {}, {}, {}
    for code in range(0x80, 0x110000):
        char = chr(code)
        if not unicodedata.decomposition(char) and char.lower() == char:
            continue  # nothing ASCII can come of it
        plain = re.sub("[^a-z0-9-]+", "-", unicodedata.normalize("NFKD", char).lower())
        if len(plain) == 1 and plain != "-":
            bare[char] = plain
        elif len(plain) == 2 and plain[1] == "-" and plain[0] != "-":
            marked[char] = plain[0]
        elif plain.strip("-"):
            longer[char] = plain
    return "".join(marked), "".join(marked.values()), "".join(bare), {**bare, **longer}


def _char_class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


def ascii_fold(col: Column) -> Column:
    """Lower-case ASCII skeleton: accents leave a "-" behind, other characters are kept."""
    marked, marked_to, bare, table = _decompositions()
    bare_to = "".join(table[c] for c in bare)
    longer = "".join(c for c in table if c not in set(bare))
    chars = F.regexp_extract_all(col, F.lit("(?s)(.)"), F.lit(1))
    lookup = F.create_map(*[F.lit(x) for c in longer for x in (c, table[c])])
    expanded = F.array_join(F.transform(chars, lambda c: F.coalesce(lookup[c], c)), "")
    source = F.when(col.rlike(_char_class(longer)), expanded).otherwise(col)
    spaced = F.regexp_replace(source, f"({_char_class(marked)})", "$1-")
    folded = F.translate(spaced, marked + bare, marked_to + bare_to)
    # Plain ASCII, by far the common case, skips all of the above.
    return F.lower(F.when(col.rlike(r"[^\x00-\x7f]"), folded).otherwise(col))


def slug(col: Column) -> Column:
    """Fold to ASCII, turn everything but a-z, 0-9 and "-" into single hyphens, trim hyphens."""
    hyphened = F.regexp_replace(ascii_fold(col), "[^a-z0-9-]+", "-")
    return F.regexp_replace(F.regexp_replace(hyphened, "-{2,}", "-"), r"^-|-\z", "")
