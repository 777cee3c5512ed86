"""Name matching: longest-common-block similarity and best match above a cutoff.

Score: twice the matched characters over both lengths, matched by repeatedly taking the longest common block (the standard
library's ``SequenceMatcher``). Names meet on characters of which they must share one to reach the cutoff; of those that meet,
the characters they have in common bound the score. A word's most promising name is scored first, and then only those names
whose bound reaches that score. Scores are computed for whole Arrow batches at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimspark.session import stored

#: From this length on the library sets frequent characters apart; such names are left to it.
LONG_NAME = 200
#: Pairs whose blocks are searched together.
_STEP = 1 << 12


def _longest_blocks(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row the first longest common block of ``a[:na]`` and ``b[:nb]``: its size and where it starts in both."""
    rows, width = b.shape
    inside = np.arange(width) < nb[:, None]
    size, start_a, start_b = (np.zeros(rows, np.int64) for _ in range(3))
    runs = np.zeros((rows, width + 1), np.int32)
    for i in range(a.shape[1]):
        same = (a[:, i, None] == b) & inside & (i < na)[:, None]
        runs[:, 1:] = np.where(same, runs[:, :-1] + 1, 0)
        end = runs.argmax(axis=1)
        found = runs[np.arange(rows), end]
        better = found > size
        size[better], start_a[better], start_b[better] = found[better], i + 1 - found[better], end[better] - found[better]
    return size, start_a, start_b


def _cut(texts: np.ndarray, row: np.ndarray, low: np.ndarray, n: np.ndarray) -> np.ndarray:
    at = np.minimum(low[:, None] + np.arange(n.max(initial=0)), texts.shape[1] - 1)
    return texts[row[:, None], at]


def matched_characters(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Characters in the blocks of each pair: the longest common block, then those before it and those behind it."""
    if not len(a):
        return np.zeros(0, np.int64)
    na, nb = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    wide = [np.array(side, f"U{max(1, n.max(initial=1))}").view(np.uint32).reshape(len(side), -1) for side, n in ((a, na), (b, nb))]
    total = np.zeros(len(na), np.int64)
    row = np.flatnonzero((na > 0) & (nb > 0))
    zero = np.zeros(len(row), np.int64)
    todo = [np.stack([row, zero, na[row], zero, nb[row]])]
    while todo:
        left = todo.pop()
        if left.shape[1] > _STEP:
            todo.append(left[:, _STEP:])
            left = left[:, :_STEP]
        row, a_low, a_high, b_low, b_high = left
        if not len(row):
            continue
        size, at_a, at_b = _longest_blocks(_cut(wide[0], row, a_low, a_high - a_low), _cut(wide[1], row, b_low, b_high - b_low), a_high - a_low, b_high - b_low)
        np.add.at(total, row, size)
        at_a, at_b = at_a + a_low, at_b + b_low
        sides = np.concatenate([np.stack([row, a_low, at_a, b_low, at_b]), np.stack([row, at_a + size, a_high, at_b + size, b_high])], axis=1)
        todo.append(sides[:, np.tile(size > 0, 2) & (sides[1] < sides[2]) & (sides[3] < sides[4])])
    return total


@F.pandas_udf(T.DoubleType())
def gestalt_ratio(candidate: pd.Series, word: pd.Series) -> pd.Series:
    """Similarity of two texts in [0, 1], lower-cased; NULL if either is NULL."""
    known = (candidate.notna() & word.notna()).to_numpy()
    a, b = (x[known].str.lower().to_numpy() for x in (candidate, word))
    lengths = np.array([len(x) + len(y) for x, y in zip(a, b)], np.int64)
    long = np.array([len(y) >= LONG_NAME for y in b], bool)
    scores = np.ones(len(a))
    some = np.flatnonzero(~long & (lengths > 0))
    scores[some] = 2.0 * matched_characters(a[some], b[some]) / lengths[some]
    for i in np.flatnonzero(long):
        scores[i] = SequenceMatcher(None, a[i], b[i]).ratio()
    out = np.full(len(candidate), np.nan)
    out[known] = scores
    return pd.Series(out)


# Marked non-deterministic so that a filter on a score or match is not pushed below the
# distinct, where it would run the scorer once per input row.
gestalt_ratio = gestalt_ratio.asNondeterministic()


def _spread(df: DataFrame) -> DataFrame:
    """Scoring costs far more than its few bytes suggest, so it is not left to size-based coalescing."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _characters(name: Column) -> Column:
    """A name's characters, each with its occurrence number: a multiset as a set of texts."""
    at = F.sequence(F.lit(1), F.length(name))
    upto = lambda i: F.substring(name, F.lit(1), i)
    char = lambda i: F.substring(name, i, F.lit(1))
    nth = lambda i: F.length(upto(i)) - F.length(F.replace(upto(i), char(i), F.lit("")))
    made = F.transform(at, lambda i: F.concat(char(i), nth(i).cast("string")))
    return F.when(F.length(name) > 0, made).otherwise(F.array().cast("array<string>"))


def _ordered(df: DataFrame, by: Sequence[str], text: str, seen: DataFrame) -> DataFrame:
    """``df`` with ``_all``: the characters of ``text``, the rarest of the whole dictionary first, as sortable texts."""
    each = df.select(*by, text, F.explode(_characters(F.col(text))).alias("_ch"))
    ranked = each.join(seen, "_ch", "left")
    place = F.concat(F.lpad(F.coalesce("_seen", F.lit(0)).cast("string"), 12, "0"), F.lit(":"), "_ch")
    return ranked.groupBy(*by, text).agg(F.array_sort(F.collect_list(place)).alias("_all"))


def _prefix(df: DataFrame, text: str, cutoff: float) -> DataFrame:
    """One row for each leading character of which one must be shared by any partner that reaches the cutoff.

    A partner needs at least ``ceil(n * c / (2 - c))`` shared characters with a name of length n.
    """
    n = F.length(text)
    need = F.greatest(F.ceil(n * F.lit(cutoff / (2 - cutoff)) - F.lit(1e-9)), F.lit(1))
    return df.withColumn("_token", F.explode(F.slice("_all", F.lit(1), (n - need + 1).cast("int"))))


def candidate_pairs(words: DataFrame, names: DataFrame, cutoff: float, by: Sequence[str] = ()) -> DataFrame:
    """Every (word, name) pair, within equal ``by``, that can reach the cutoff, once, with ``most``, a bound on its score.

    Names meet on a shared leading character, the rarest first; only at the first one they share are the exact bounds
    tested: the lengths, and the number of characters in common.
    """
    either = names.select(F.explode(_characters(F.col("name"))).alias("_ch"))
    seen = stored(either.groupBy("_ch").agg(F.count(F.lit(1)).alias("_seen")), "characters")
    left = _prefix(_ordered(words, by, "word", seen), "word", cutoff)
    right = _prefix(_ordered(names, by, "name", seen), "name", cutoff)
    right = right.select(*(F.col(k).alias(f"_r_{k}") for k in by), "name", F.col("_all").alias("_rall"), F.col("_token").alias("_rtoken"))
    lw, ln = F.length("word"), F.length("name")
    fits = 2.0 * F.least(lw, ln) / (lw + ln) >= F.lit(cutoff - 1e-9)
    same = F.col("_token") == F.col("_rtoken")
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    met = left.join(right, same & fits)
    # the row number keeps the filter behind this step, so that the common characters are worked out once for each row
    met = met.select(*by, "word", "name", "_token", F.array_intersect("_all", "_rall").alias("_shared"), F.monotonically_increasing_id().alias("_row"))
    most = 2.0 * F.size("_shared") / (lw + ln)
    reach = (most >= F.lit(cutoff - 1e-9)) & (F.get("_shared", F.lit(0)) == F.col("_token"))
    return met.where(reach).select(*by, "word", "name", most.alias("most"))


def scored_pairs(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``score`` of those pairs among which each word's best match is: the most promising one, and all whose bound reaches its score."""
    key = [*by, "word"]
    tops = pairs.groupBy(*key).agg(F.max_by("name", F.struct("most", "name")).alias("name"))
    tops = stored(_spread(tops).withColumn("score", gestalt_ratio("name", "word")), "first-scores")
    floor = tops.select(*(F.col(k).alias(f"_f_{k}") for k in key), F.col("name").alias("_top"), F.col("score").alias("_floor"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_f_{k}"))
    rest = pairs.join(floor, same & (F.col("name") != F.col("_top")) & (F.col("most") >= F.col("_floor") - F.lit(1e-9))).select(*key, "name")
    return tops.unionByName(_spread(rest).withColumn("score", gestalt_ratio("name", "word")))


def fuzzy_match(left: DataFrame, word: str, dictionary: DataFrame, name: str, cutoff: float, by: Sequence[str] = ()) -> DataFrame:
    """``left`` plus ``match``: the best dictionary name at or above the cutoff, greatest name on a tie.

    Names are compared lower-cased; each distinct word is scored once. With ``by``, columns of both sides, a word only
    meets the names with the same values there.
    """
    words = left.select(*by, F.lower(F.col(word)).alias("word")).where(F.col("word").isNotNull()).distinct()
    names = dictionary.select(*by, F.lower(F.col(name)).alias("name")).where(F.col("name").isNotNull()).distinct()
    scored = scored_pairs(stored(candidate_pairs(words, names, cutoff, by), "pairs"), by)
    best = scored.where(F.col("score") >= cutoff).groupBy(*by, "word").agg(F.max_by("name", F.struct("score", "name")).alias("match"))
    best = best.select(*(F.col(k).alias(f"_b_{k}") for k in by), F.col("word").alias("_word"), "match")
    cond = F.lower(F.col(word)) == F.col("_word")
    for k in by:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_b_{k}"))
    return left.join(best, cond, "left").drop("_word", *(f"_b_{k}" for k in by))
