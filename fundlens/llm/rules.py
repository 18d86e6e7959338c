"""Quality rules: counts within a text and a hashed n-gram likelihood ratio.

Native: DataFrame functions only.  The rule counts read one text at a time.
The verdict compares two multinomials over hashed n-grams (words, adjacent
word pairs and runs of symbols, hashed into ``BUCKETS``): the trusted target
(documents labelled as good) and the raw corpus (all documents), both counted
over every row with add-one smoothing.  A document's score is the mean over
its n-grams of log(p_target / p_raw), so its length does not matter, and it is
kept when no base rule fails and the score reaches ``THRESHOLD``.

A null text has no words; it fails the base rule (fewer than 50 words) and
scores 0.  Without trusted documents the target is uniform.  Rows repeated
whole count and return as often as they occur.  An empty table gives an empty
result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.llm.batches import SPACES
from fundlens.llm.frames import SPACE_PATTERN

#: Buckets of the hashed n-grams; a power of two.
BUCKETS = 4096
#: Least mean log-likelihood ratio of a kept document.
THRESHOLD = -0.1
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words between ASCII white space, in order."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN)
    return _let(parts, lambda p: F.slice(
        p, F.when(F.get(p, F.lit(0)) == "", 2).otherwise(1),
        F.greatest(F.lit(0), F.size(p) - F.when(F.get(p, F.lit(0)) == "", 1).otherwise(0)
                   - F.when((F.size(p) > 1) & (F.get(p, F.size(p) - 1) == ""), 1).otherwise(0))))


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def repeated_window_words(hashes: Column) -> Column:
    """Words inside a 3-word window found at least twice in the text, from
    the words' hashes.

    A window becomes one integer, a prefix of its 64-bit hash above its
    place, so sorting brings equal windows together; neighbours with equal
    prefixes are then compared by their whole hashes."""
    n = F.size(hashes)

    def repeats(h: Column, b: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1
        keys = F.sort_array(F.transform(
            h, lambda x, i: F.call_function("shiftleft", x, b).bitwiseOR(i.cast("long"))))

        def same(x: Column, y: Column) -> Column:
            near = F.call_function("shiftright", x.bitwiseXOR(y), b) == 0
            whole = lambda k: F.get(h, k.bitwiseAND(low).cast("int"))
            return near & (whole(x) == whole(y))

        def places(s: Column) -> Column:
            ahead = F.filter(s, lambda x, i: same(x, F.get(s, i + 1)))
            return _let(ahead, lambda a: F.when(F.size(a) == 0, a).otherwise(
                F.array_union(a, F.filter(s, lambda x, i: same(x, F.get(s, i - 1))))))

        at = F.sort_array(F.transform(_let(keys, places), lambda x: x.bitwiseAND(low)))
        # a window covers three words, or as many as come before the next one
        three = F.lit(3).cast("long")
        steps = lambda p: F.transform(p, lambda x, i: F.least(three, F.coalesce(F.get(p, i + 1) - x, three)))
        return _let(at, lambda p: F.aggregate(steps(p), F.lit(0).cast("long"), lambda x, y: x + y))

    windows = F.transform(F.slice(hashes, 1, F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(
        x, F.get(hashes, i + 1), F.get(hashes, i + 2)))
    bits = F.ceil(F.log2(n + F.lit(1))).cast("int")
    return F.when(n < 3, F.lit(0).cast("long")).otherwise(
        _let(windows, lambda h: _let(bits, lambda b: repeats(h, b))))


def repeated_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda x: F.btrim(x, F.lit(SPACES)) != "")
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def symbol_runs(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[{SYMBOLS}]+"), F.lit(0))


def _letters(strings: Column) -> Column:
    """Code points of all strings of an array."""
    return F.aggregate(strings, F.lit(0).cast("long"), lambda a, x: a + F.length(x))


def _buckets(hashes: Column, runs: Column) -> Column:
    """The hash buckets of a text's n-grams: words, pairs, runs of symbols."""
    slot = lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    pairs = F.transform(F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))),
                        lambda x, i: slot(F.xxhash64(x, F.get(hashes, i + 1))))
    return F.concat(F.transform(hashes, slot), pairs, F.transform(_hashes(runs), slot))


def bucket_ratios(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> list[float]:
    """log(p_target / p_raw) of every bucket.  Raw counts cover every row of
    ``df``; ``trusted`` (one id column, of any size) names the target
    documents."""
    ids = trusted.select(trusted.columns[0]).dropna().distinct().toDF("_trusted")
    text = F.col("_text")
    grams = _let(_hashes(words(text)), lambda h: _buckets(h, symbol_runs(text)))
    counts = (df.select(df[id_col].alias("_id"), df[text_col].alias("_text"))
              .join(ids.hint("merge"), F.col("_id") == F.col("_trusted"), "left")
              # the n-grams after the join: texts are smaller
              .select("_trusted", grams.alias("_grams"))
              # explode_outer: a plain explode adds a filter that computes the array twice
              .select(F.col("_trusted").isNotNull().alias("good"), F.explode_outer("_grams").alias("bucket"))
              .where("bucket is not null")
              .groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("good").alias("target")).collect())
    raw, target = [1] * BUCKETS, [1] * BUCKETS
    for r in counts:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(r) + shift for t, r in zip(target, raw, strict=True)]


def quality_rules(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: id, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``llr`` and ``kept``."""
    ratios = F.lit(bucket_ratios(df, trusted, id_col, text_col))
    text = df[text_col]

    def hashed(h: Column, runs: Column) -> Column:
        mean = _let(_buckets(h, runs), lambda g: F.aggregate(
            g, F.lit(0.0), lambda a, x: a + F.get(ratios, x)) / F.greatest(F.size(g), F.lit(1)))
        return F.struct(repeated_window_words(h).alias("n_repeat_words"), mean.alias("llr"))

    def counts(w: Column, runs: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _letters(w).alias("word_chars"),
                        _letters(runs).alias("n_symbols"),
                        _let(_hashes(w), lambda h: hashed(h, runs)).alias("of"))

    rows = df.select(
        df[id_col], repeated_lines(text).alias("n_dup_lines"),
        _let(words(text), lambda w: _let(symbol_runs(text), lambda r: counts(w, r))).alias("_w"))
    failed = (F.col("_w.n_words") < 50) | (100 * F.col("_w.of.n_repeat_words") > 50 * F.col("_w.n_words"))
    return rows.select(
        id_col, "_w.n_words", "_w.word_chars", "_w.n_symbols", "n_dup_lines", "_w.of.n_repeat_words",
        failed.alias("base_failed"), "_w.of.llr",
        (~failed & (F.col("_w.of.llr") >= threshold)).alias("kept"))
