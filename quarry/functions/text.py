"""Tokenising expressions shared by the text operators.

The character classes are written out so that Java regexes (Spark) and RE2 (the SQL oracle)
agree: whitespace is the ASCII set, and a word character is a Unicode letter, number or '_'
(the definition of a word character in Python 3 regexes).
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and token classes.
WHITESPACE_RUN = "[ \\t\\n\\x0B\\f\\r]+"
NON_WORD_RUN = "[^\\p{L}\\p{N}_]+"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_whitespace(text) -> Column:
    """Tokens split on whitespace runs, empty strings removed."""
    return F.filter(F.split(_c(text), WHITESPACE_RUN), lambda t: t != "")


def split_nonword(text) -> Column:
    """Tokens split on runs of non-word characters, empty strings removed, case kept."""
    return F.filter(F.split(_c(text), NON_WORD_RUN), lambda t: t != "")


def long_lower_tokens(text, min_len: int = 3) -> Column:
    """Whitespace tokens of at least ``min_len`` characters (tested before lowering), lower-cased."""
    return F.transform(F.filter(split_whitespace(text), lambda t: F.length(t) >= min_len), lambda t: F.lower(t))


# The English stop-word list used for feature selection (179 words, natural order).
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his "
    "himself she she's her hers herself it it's its itself they them their theirs themselves what which who whom this "
    "that that'll these those am is are was were be been being have has had having do does did doing a an the and but "
    "if or because as until while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very s t can will just don don't should "
    "should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't "
    "haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't "
    "weren weren't won won't wouldn wouldn't").split()
