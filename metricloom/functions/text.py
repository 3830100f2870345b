"""Word and keyword counts over whole texts.

None of them splits the text into an array of words: a word count only needs the number
of spaces, and a keyword count only needs the number of times the padded keyword occurs.
Both stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 32 ASCII punctuation characters, and the networks counted in
# video descriptions.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
NETWORKS = ("facebook", "instagram", "twitter", "youtube", "tiktok", "reddit", "discord")

_SPACE = " "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_punct(c: Column | str) -> Column:
    """Text without ASCII punctuation; Unicode dashes and quotes stay."""
    return F.regexp_replace(_col(c), r"\p{Punct}+", "")


def _occurrences(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of ``needle``, measured by what its removal saves."""
    removed = F.replace(text, F.lit(needle), F.lit(""))
    saved = F.octet_length(text) - F.octet_length(removed)
    return F.call_function("div", saved, F.lit(len(needle.encode("utf-8")))).cast("int")


def word_count(c: Column | str) -> Column:
    """Number of words once punctuation is gone, splitting on the single space.

    Leading and inner empty words count, trailing ones do not; a text with nothing left
    and no space counts 1, one with only spaces left counts 0. NULL in, NULL out.

    Removing punctuation never adds or removes a space, so the count is one more than the
    spaces that precede the last character which is neither space nor punctuation. Written
    without CASE branches, so that codegen trims the text only once.
    """
    text = _col(c)
    body = F.rtrim(text, F.lit(_SPACE + PUNCTUATION))
    only_spaces_left = (body == "") & F.contains(text, F.lit(_SPACE))
    return _occurrences(body, _SPACE) + 1 - only_spaces_left.cast("int")


def _padded_words(c: Column | str) -> Column:
    """Lower-case text without punctuation where every word has a space of its own on
    each side, so that neighbouring equal words are both found."""
    words = F.lower(strip_punct(c))
    return F.concat(F.lit(_SPACE), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(_SPACE))


def keyword_count(c: Column | str, word: str) -> Column:
    """How many words of the cleaned, lower-case text equal ``word``. NULL in, NULL out."""
    if not word:
        raise ValueError("keyword must not be empty")
    return _occurrences(_padded_words(c), f" {word} ")


def _candidates(text: Column, words: Sequence[str]) -> Column:
    """The words of the text, in order and parted by spaces, that may equal one of ``words``.

    One regex pass: with a space put in front of the text, a match starts at a space, ends
    before a space or the end, and spells one of the words in any case with punctuation
    anywhere.
    """
    punct = r"\p{Punct}*+"
    spelled = "|".join(punct.join(word) for word in words)
    initials = "".join(sorted({word[0] for word in words}))
    pattern = rf"(?iu) {punct}(?=[{initials}])(?:{spelled}){punct}(?= |\z)"
    found = F.regexp_extract_all(F.concat(F.lit(_SPACE), text), F.lit(pattern), F.lit(0))
    return F.array_join(found, _SPACE)


def keyword_counts(
    df: DataFrame, c: str, words: Sequence[str] = NETWORKS, suffix: str = "_count"
) -> DataFrame:
    """``df`` plus one ``<word>_count`` column per keyword.

    The text is first narrowed to the words that may count, and each keyword is then
    counted exactly in those few. Letters beyond ASCII can change their number when
    lower-cased, so keywords with such letters are counted in the whole text.
    """
    text = F.col(c)
    if words and all(word.isascii() and word.isalnum() for word in words):
        text = _candidates(text, words)
    return df.select("*", *[keyword_count(text, w).alias(f"{w}{suffix}") for w in words])
