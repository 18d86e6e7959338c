"""Text functions: blank split (F1), regex tokens (T1), stop words."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spark ML's default English stop-word list (StopWordsRemover,
# language "english"), in its own order.  Kept as text so SQL twins and the
# DuckDB oracle use the very same list.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few
more most other some such no nor not only own same so than too very s t can
will just don should now i'll you'll he'll she'll we'll they'll i'd you'd
he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot
could here's how's let's ought that's there's what's when's where's who's
why's would
""".split())

TOKEN_PATTERN = r"\W+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_blank(text: Column | str) -> Column:
    """split on one blank, keeping empty strings (``"a "`` -> a, "")."""
    return F.split(_c(text), " ")


def regex_tokens(text: Column | str, pattern: str = TOKEN_PATTERN,
                 min_length: int = 1, lower: bool = True) -> Column:
    """RegexTokenizer semantics - lower-case, split on ``pattern`` as
    gaps, drop tokens shorter than ``min_length``."""
    t = F.lower(_c(text)) if lower else _c(text)
    return F.filter(F.split(t, pattern), lambda x: F.length(x) >= min_length)


def is_stop_word(token: Column, words=ENGLISH_STOP_WORDS, case_sensitive: bool = False) -> Column:
    """True for a stop word.  ``isin`` over more than ten literals is
    planned as ``InSet``, a hash-set probe, not a scan of the list."""
    if case_sensitive:
        return token.isin(*words)
    return F.lower(token).isin(*sorted({w.lower() for w in words}))


def remove_stop_words(tokens: Column | str, words=ENGLISH_STOP_WORDS,
                      case_sensitive: bool = False) -> Column:
    """Drop every occurrence of a stop word (case-insensitive by
    default, like the ML stage); repeats of other words are kept, unlike
    ``array_except``."""
    return F.filter(_c(tokens), lambda x: ~is_stop_word(x, words, case_sensitive))
