"""Text cleaning, prose test, sentence packing and label formatting as Spark expressions.

Patterns follow Unicode whitespace and digits (``(?U)``). ``_WS`` adds the four information
separators that count as blanks for string splitting but are missing from Java's ``\\s``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WS = r"[\s\x1c-\x1f]"
_NON_WS = r"[^\s\x1c-\x1f]"
_WORD = r"[\p{L}\p{N}_]"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
_LINE_BREAK = r"(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ])"

# The prose test and the token estimate.
PROSE_MARKERS = (
    "the", "and", "to", "of", "in", "a", "is", "that", "for", "our", "we", "by", "as", "with",
)
PROSE_MIN_WORDS = 15
PROSE_MIN_ALPHA_SHARE = 0.65
PROSE_MIN_MARKERS = 3
WORDS_PER_TOKEN = 0.75
# Page-number lines, list markers and sentence boundaries.
PAGE_LINE = (
    rf"(?iuU)^{_WS}*(?:-{_WS}*\d+{_WS}*-|Page{_WS}+\d+(?:{_WS}+of{_WS}+\d+)?|\d+){_WS}*$"
)
LIST_MARKER_AHEAD = rf"(?mdU)(?=^(?:[•\-*]|\d+[.):]){_WS})"
SENTENCE_BREAK = rf"(?U)(?<=[.!?]){_WS}+(?=[A-Z])"
BLANK_LINE = rf"(?U)\n{_WS}*\n"
CONTROL_CHARACTERS = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]"
# Label length and default wording.
LABEL_LENGTH = 50
UNKNOWN_LABEL = "Unknown Theme"


def strip(text: Column) -> Column:
    """Remove blanks of any kind from both ends."""
    # Tried only where a run of blanks begins, so long runs inside the text stay linear.
    return F.regexp_replace(text, rf"(?U)\A{_WS}++|(?<!{_WS}){_WS}++\z", "")


def word_count(text: Column) -> Column:
    """Number of blank-separated words."""
    return F.size(F.filter(F.split(text, rf"(?U){_WS}+"), lambda w: w != ""))


def token_estimate(text: Column) -> Column:
    """Rough model-token count, at least one."""
    return F.greatest(F.lit(1), F.floor(word_count(text) / F.lit(WORDS_PER_TOKEN)).cast("int"))


def normalize_whitespace(text: Column) -> Column:
    """One blank between words, one empty line between paragraphs."""
    squeezed = F.regexp_replace(text, r"[ \t]+", " ")
    return strip(F.regexp_replace(squeezed, BLANK_LINE, "\n\n"))


def dehyphenate(text: Column) -> Column:
    """Join words that a line break split after a hyphen."""
    # Tried only at word starts, so very long words stay linear.
    return F.regexp_replace(text, rf"(?<!{_WORD})({_WORD}++)-\n({_WORD}+)", "$1$2")


@F.pandas_udf(T.StringType())
def _compatibility_decompose(text: pd.Series) -> pd.Series:
    return text.map(lambda value: unicodedata.normalize("NFKD", value), na_action="ignore")


def remove_control_characters(text: Column) -> Column:
    """Drop control characters except tab, line feed and carriage return."""
    return F.regexp_replace(text, CONTROL_CHARACTERS, "")


def remove_nonascii_artifacts(text: Column) -> Column:
    """Compatibility decomposition (the one step Spark has no built-in for), then controls."""
    return remove_control_characters(_compatibility_decompose(text))


def remove_page_lines(text: Column) -> Column:
    """Drop lines that hold nothing but a page number."""
    lines = F.split(F.regexp_replace(text, rf"{_LINE_BREAK}\z", ""), _LINE_BREAK, -1)
    kept = F.filter(lines, lambda line: ~F.rlike(line, F.lit(PAGE_LINE)))
    return F.array_join(kept, "\n")


def clean_text(text: Column) -> Column:
    """Decompose, rejoin hyphenated words, drop page lines, normalise blanks."""
    return normalize_whitespace(remove_page_lines(dehyphenate(remove_nonascii_artifacts(text))))


def marker_overlap(text: Column) -> Column:
    """How many distinct marker words occur in the text."""
    words = F.split(F.lower(text), rf"(?U){_WS}+")
    return F.size(F.array_intersect(words, F.array(*[F.lit(m) for m in PROSE_MARKERS])))


def is_prose(text: Column, min_words: int = PROSE_MIN_WORDS) -> Column:
    """True for running English text, false for tables, numbers and noise."""
    words = word_count(text)
    # From its first letter to its end, every word with a letter matches exactly once.
    alphabetic = F.regexp_count(text, F.lit(rf"(?U)[a-zA-Z]{_NON_WS}*"))
    return (
        (words >= min_words)
        & (F.try_divide(alphabetic, words) >= PROSE_MIN_ALPHA_SHARE)
        & (marker_overlap(text) >= PROSE_MIN_MARKERS)
    )


def sentences(text: Column) -> Column:
    """Array of stripped, non-empty sentences."""
    parts = F.transform(F.split(text, SENTENCE_BREAK, -1), strip)
    return F.filter(parts, lambda s: s != "")


def paragraphs(text: Column) -> Column:
    """Array of paragraphs: split at blank lines, then before list markers at line starts."""
    blocks = F.transform(F.split(text, BLANK_LINE, -1), strip)
    pieces = F.flatten(F.transform(blocks, lambda b: F.split(b, LIST_MARKER_AHEAD, -1)))
    return F.filter(F.transform(pieces, strip), lambda p: p != "")


def _group_starts(sized: Column, max_words: int) -> Column:
    """Positions of the sentences that open a group, by a running sum that starts over.

    The state holds numbers only: Spark copies it at every step, so texts stay out of it.
    """
    start = F.struct(
        F.array().cast("array<int>").alias("starts"), F.lit(0).alias("n"), F.lit(0).alias("i")
    )

    def step(state: Column, item: Column) -> Column:
        opens = (state["n"] == 0) | (state["n"] + item["n"] > max_words)
        return F.struct(
            F.when(opens, F.array_append(state["starts"], state["i"] + 1))
            .otherwise(state["starts"])
            .alias("starts"),
            F.when(opens, item["n"]).otherwise(state["n"] + item["n"]).alias("n"),
            (state["i"] + 1).alias("i"),
        )

    return F.aggregate(sized, start, step, lambda state: state["starts"])


def pack_sentences(text: Column, max_words: int) -> Column:
    """Greedy packing: consecutive sentences joined up to ``max_words`` words.

    A sentence longer than the limit forms a group of its own.
    """
    sized = F.transform(
        sentences(text), lambda s: F.struct(s.alias("s"), word_count(s).alias("n"))
    )

    def group(items: Column, starts: Column, first: Column, position: Column) -> Column:
        following = F.coalesce(F.get(starts, position + 1), F.size(items) + 1)
        return F.array_join(F.slice(items, first, following - first)["s"], " ")

    # One-element arrays bind the sentences and the starts, so each is computed once.
    nested = F.transform(
        F.array(sized),
        lambda items: F.transform(
            F.array(_group_starts(items, max_words)),
            lambda starts: F.transform(starts, lambda s, i: group(items, starts, s, i)),
        ),
    )
    return F.flatten(F.flatten(nested))


def tokens(text: Column, stop_words: Iterable[str] = ()) -> Column:
    """Lower-case runs of two or more word characters, without the stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(rf"({_WORD}{{2,}})"), F.lit(1))
    blocked = list(stop_words)
    return F.filter(found, lambda t: ~t.isin(blocked)) if blocked else found


def terms(token_array: Column) -> Column:
    """Unigrams plus bigrams of neighbouring tokens."""
    count = F.size(token_array)
    first = F.slice(token_array, F.lit(1), F.greatest(count - 1, F.lit(0)))
    second = F.slice(token_array, F.lit(2), F.greatest(count - 1, F.lit(0)))
    pairs = F.zip_with(first, second, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(token_array, pairs)


def neighbours(token_array: Column) -> Column:
    """Pairs ``a, b`` of neighbouring tokens."""
    count = F.greatest(F.size(token_array) - 1, F.lit(0))
    first, second = F.slice(token_array, F.lit(1), count), F.slice(token_array, F.lit(2), count)
    return F.zip_with(first, second, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters (``initcap`` only looks at blanks)."""
    runs = F.regexp_extract_all(text, F.lit(rf"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def clean_label(raw: Column) -> Column:
    """Strip quotes and the final stop, collapse blanks, title-case, cut to label length."""
    bare = F.rtrim(strip(F.btrim(strip(raw), F.lit("\"'"))), F.lit("."))
    return F.left(title_case(F.regexp_replace(bare, rf"(?U){_WS}+", " ")), F.lit(LABEL_LENGTH))


def _scaled_integer(value: Column, factor: float) -> Column:
    """``value * factor`` rounded to an integer, deciding ties on the exact binary value.

    The rounded product hides on which side of a tie the exact one lies, so its rounding error
    is recovered by splitting both factors (Dekker's product); a true tie goes to even.
    """
    split = 134217729.0  # 2**27 + 1
    factor_high = split * factor - (split * factor - factor)
    factor_low = factor - factor_high
    scaled_up = value * split
    high = scaled_up - (scaled_up - value)
    low = value - high
    product = value * factor
    error = (
        high * factor_high - product + high * factor_low + low * factor_high
    ) + low * factor_low
    floor = F.floor(product)
    part = product - floor
    up = (
        (part > 0.5)
        | ((part == 0.5) & (error > 0.0))
        | ((part == 0.5) & (error == 0.0) & (floor % 2 == 1))
    )
    return floor + F.when(up, F.lit(1)).otherwise(F.lit(0))


def fixed_point(value: Column, digits: int) -> Column:
    """Fixed number of decimals, correctly rounded from the exact binary value."""
    number = value.cast("double")
    unit = 10**digits
    scaled = _scaled_integer(F.abs(number), float(unit))
    sign = F.when(number < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.floor(scaled / unit).cast("string")
    rest = F.lpad((scaled % unit).cast("string"), digits, "0")
    return F.concat(sign, whole, F.lit("."), rest)


def signed_fixed_point(value: Column, digits: int) -> Column:
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, fixed_point(F.abs(value), digits))


def percent(value: Column, digits: int = 1) -> Column:
    return F.concat(fixed_point(value * 100.0, digits), F.lit("%"))


def signed_percent(value: Column, digits: int = 1) -> Column:
    return F.concat(signed_fixed_point(value * 100.0, digits), F.lit("%"))


def contains_ignore_case(text: Column, needle: str) -> Column:
    return F.contains(F.lower(text), F.lit(needle.lower()))
