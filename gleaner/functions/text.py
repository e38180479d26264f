"""Text functions as Spark columns; all of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Unicode white space that a plain strip or split removes, as a character list ...
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# ... and as a regex class.
WHITESPACE = r"[\s\x0b\p{Z}\x{1c}-\x{1f}\x{85}]"
# Fixed value: letters, digits and underscore of every script; the plain ones are named first, as they are found faster.
WORD = r"[a-z0-9_\p{L}\p{N}]+"

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times inside a higher-order function."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def _replace_where(markers: tuple[str, ...], pattern: str, by: str) -> Callable[[Column], Column]:
    """Regex replacement that runs only on texts containing a marker; a byte search is far cheaper."""

    def replace(text: Column) -> Column:
        found = F.contains(text, F.lit(markers[0]))
        for marker in markers[1:]:
            found = found | F.contains(text, F.lit(marker))
        return F.when(found, F.regexp_replace(text, pattern, by)).otherwise(text)

    return replace


# In this order: spaces and tabs to one space, line ends to LF, at most one blank line.
_CLEANING = (
    (("  ", "\t"), r"[ \t]+", " "),
    (("\r",), r"\r\n?", "\n"),
    (("\n\n\n",), r"\n{3,}", "\n\n"),
)


def clean_text(text: Column) -> Column:
    for markers, pattern, by in _CLEANING:
        text = let(text, _replace_where(markers, pattern, by))
    return strip(text)


def hard_split(text: Column, size: int) -> Column:
    """Pieces of `size` characters; one regex pass, linear however long the text is."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{size}}}"), F.lit(0))


def split_segments(text: Column, size: int, separators: tuple[str, ...]) -> Column:
    """Segments of a text, cut after the first listed separator that occurs in it."""

    def cut(sep: str) -> Column:
        def keep_separator(parts: Column) -> Column:
            last = F.size(parts) - 1
            return let(
                last,
                lambda n: F.transform(
                    parts, lambda p, i: F.when(i < n, F.concat(p, F.lit(sep))).otherwise(p)
                ),
            )

        def bounded(segments: Column) -> Column:
            pieces = F.transform(
                segments,
                lambda s: F.when(F.length(s) > size, hard_split(s, size)).otherwise(F.array(s)),
            )
            return F.filter(F.flatten(pieces), lambda s: s != "")

        return bounded(let(F.split(text, "\\Q" + sep + "\\E", -1), keep_separator))

    choice = None
    for sep in separators:
        found = F.contains(text, F.lit(sep))
        choice = F.when(found, cut(sep)) if choice is None else choice.when(found, cut(sep))
    whole = hard_split(text, size)
    return whole if choice is None else choice.otherwise(whole)


def overlap_tail(text: Column, overlap: int) -> Column:
    """Last `overlap` characters, from the first word start in them; none when overlap is 0."""
    if overlap <= 0:
        return F.lit("")
    tail = let(
        F.substring(text, -overlap, overlap),
        lambda t: F.when(F.instr(t, " ") > 0, F.substring(t, F.instr(t, " ") + 1, F.lit(overlap))).otherwise(t),
    )
    return F.when(F.length(text) <= overlap, text).otherwise(tail)


def tokenize(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    """Number of tokens. Lower case changes it only where a letter becomes a letter and a mark, which none but U+0130 does."""
    as_written = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.size(F.when(F.contains(text, F.lit("\u0130")), tokenize(text)).otherwise(as_written))


def word_set(text: Column) -> Column:
    words = F.split(F.lower(text), WHITESPACE + "+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common words; null when either set is empty, which matches nothing."""
    common = F.size(F.array_intersect(a, b))
    return F.when(
        (F.size(a) > 0) & (F.size(b) > 0), common / (F.size(a) + F.size(b) - common)
    )


def term_counts(tokens: Column) -> Column:
    """Distinct tokens of one row with their counts: array<struct<term, tf>>, no shuffle."""

    def runs(ordered: Column) -> Column:
        n = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda s, j: F.struct(
                    F.get(ordered, s).alias("term"),
                    (F.coalesce(F.get(at, j + 1), n) - s).alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:int>>")
    return let(
        F.sort_array(tokens), lambda t: F.when(F.size(t) == 0, empty).otherwise(runs(t))
    )


def text_key(text: Column) -> Column:
    return F.sha2(text, 256)


def snippet(text: Column, width: int, ellipsis: bool = False) -> Column:
    """First `width` characters on one line; `ellipsis` marks texts that were longer."""
    line = F.replace(F.substring(text, 1, width), F.lit("\n"), F.lit(" "))
    if not ellipsis:
        return line
    return F.concat(line, F.when(F.length(text) > width, F.lit("…")).otherwise(F.lit("")))
