"""Text columns: normalising, splitting into words and tokens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Own list of common English words; the members why, a, the, being, at and over are required.
STOPWORDS = """
a about above after again against all am an and any are as at be because been before being below
between both but by can cannot could did do does doing down during each few for from further had
has have having he her here hers herself him himself his how i if in into is it its itself me more
most my myself no nor not of off on once only or other ought our ours ourselves out over own same
she should so some such than that the their theirs them themselves then there these they this those
through to too under until up very was we were what when where which while who whom why with would
you your yours yourself yourselves
""".split()


def normalize_text(text: Column) -> Column:
    """Keep ASCII letters, digits and spaces, lower-cased and trimmed."""
    return F.trim(F.lower(F.regexp_replace(text, r"[^\p{Alnum} ]", "")))


def split_words(text: Column) -> Column:
    """Split on single spaces; doubled spaces give empty words."""
    return F.split(text, " ")


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of word characters, in text order, repeats kept.

    Everything else is taken out before lower-casing, which may turn a non-ASCII
    letter into an ASCII one and so change where words end.
    """
    words = F.lower(F.trim(F.regexp_replace(text, r"\W+", " ")))
    return F.array_remove(F.split(words, " "), "")


def content_tokens(text: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """``word_tokens`` without the given (small, fixed) list of words."""
    if not stopwords:
        return word_tokens(text)
    # As one SQL text: a column object per word takes the driver most of a second.
    words = ", ".join("'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'" for word in stopwords)
    return F.call_function("filter", word_tokens(text), F.expr(f"word -> word NOT IN ({words})"))
