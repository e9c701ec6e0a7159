"""Similarity of names: longest common subsequence of the sorted words, as a ratio between 0 and 100.

The subsequence runs over whole Arrow batches at once: one 64-bit number per
pair holds the state, its bits stand for the letters of the shorter text, and
each letter of the longer one updates the numbers of all pairs of the batch.
Candidates are found and filtered in the JVM before.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters whose bits a number holds; texts beyond go by Python's long integers.
BITS = 62


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence of two texts of any length."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = state = (1 << len(a)) - 1
    for c in b:
        hit = state & where.get(c, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(a) - state.bit_count()


def _codes(texts: list[str], alphabet: dict[str, int], width: int) -> np.ndarray:
    """Letters as numbers from 1, a row per text, 0 beyond its end."""
    codes = np.zeros((len(texts), width), dtype=np.int64)
    for i, text in enumerate(texts):
        codes[i, : len(text)] = [alphabet.setdefault(c, len(alphabet) + 1) for c in text]
    return codes


def common_subsequences(pairs: list[tuple[str, str]]) -> np.ndarray:
    """``common_subsequence`` of many pairs."""
    out = np.zeros(len(pairs), dtype=np.int64)
    ordered = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    fits = np.array([len(a) <= BITS for a, _ in ordered], dtype=bool)
    for i in np.flatnonzero(~fits):
        out[i] = common_subsequence(*ordered[i])
    chosen = np.flatnonzero(fits)
    # texts of about equal length go together, so that one long text doesn't widen all
    chosen = chosen[np.argsort([len(ordered[i][1]) for i in chosen], kind="stable")]
    for at in range(0, len(chosen), 4096):
        part = chosen[at : at + 4096]
        shorts, longs = [ordered[i][0] for i in part], [ordered[i][1] for i in part]
        alphabet: dict[str, int] = {}
        x = _codes(shorts, alphabet, max(map(len, shorts)))
        y = _codes(longs, alphabet, max(map(len, longs)))
        row, lengths = np.arange(len(part)), np.array([len(s) for s in shorts], dtype=np.uint64)
        masks = np.zeros((len(part), len(alphabet) + 1), dtype=np.uint64)
        for i in range(x.shape[1]):
            masks[row, x[:, i]] |= np.uint64(1 << i)
        masks[:, 0] = 0  # beyond the end
        full = (np.uint64(1) << lengths) - np.uint64(1)
        state = full.copy()
        for j in range(y.shape[1]):
            hit = state & masks[row, y[:, j]]
            state = ((state + hit) | (state - hit)) & full
        out[part] = lengths.astype(np.int64) - np.bitwise_count(state)
    return out


def sorted_words(text: Column) -> Column:
    """The words of a text in order, single-spaced."""
    return F.array_join(F.array_sort(F.filter(F.split(text, r"\s+"), lambda w: w != "")), " ")


def sorted_ratio(x: Column, y: Column) -> Column:
    """200 times the common subsequence of two texts over both lengths; null if one is null, 0 if one is empty."""

    def common(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(common_subsequences(list(zip(x.fillna(""), y.fillna(""), strict=True))))

    both = F.length(x) + F.length(y)
    return F.when((F.length(x) == 0) | (F.length(y) == 0), 0.0).otherwise(200.0 * F.pandas_udf(common, "long")(x, y) / both)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """The ratio of the sorted words of both."""
    return sorted_ratio(sorted_words(a), sorted_words(b))


def ratio_bound(a: Column, b: Column) -> Column:
    """The greatest ratio that the lengths allow."""
    m, n = F.length(a), F.length(b)
    return F.when(m + n == 0, 0.0).otherwise(200.0 * F.least(m, n) / (m + n))


def numbered_grams(text: Column) -> Column:
    """Neighbouring letters of a text, each with its how-manieth occurrence; of texts up to three letters the letters too."""
    pairs = F.when(F.length(text) > 1, F.transform(F.sequence(F.lit(1), F.length(text) - 1), lambda i: F.substr(text, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    number = lambda xs: F.transform(xs, lambda x, i: F.concat(x, F.size(F.filter(F.slice(xs, F.lit(1), i + 1), lambda y: y == x)).cast("string")))
    return F.concat(number(pairs), F.when(F.length(text) <= 3, F.array_distinct(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.concat(F.lit("~"), c)))).otherwise(F.array().cast("array<string>")))


def grams_in_common(length: Column, ratio: float) -> Column:
    """Numbered grams that a text of this length shares at least with any text of a ratio of ``ratio`` or more, at least 1.

    With a ratio r, texts of m and n letters have q (m + n) letters in common in
    order, q = r / 200. Each letter left out of one breaks two of its grams, each
    put in breaks one, which leaves (3q - 1)(m + n) - 1; and n is r / (200 - r) m at least.
    """
    q = ratio / 200
    return F.greatest(F.ceil((3 * q - 1) * (length + length * (ratio / (200 - ratio))) - 1 - 1e-9), F.lit(1))


def signature(text: str) -> tuple[int, int, int, int]:
    """Two 128-bit sets as pairs of signed numbers: the numbered letters of a text and its numbered grams, each in a bucket.

    Letters beyond the fourth of a bucket and grams that share a bucket are not
    in the sets; ``may_reach`` allows for them.
    """
    letters = grams = 0
    seen: dict[object, int] = {}
    for i, c in enumerate(text):
        bucket = ord(c) % 32
        n = seen[bucket] = seen.get(bucket, -1) + 1
        if n < 4:
            letters |= 1 << 4 * bucket + n
        if i:
            gram = text[i - 1] + c
            n = seen[gram] = seen.get(gram, -1) + 1
            grams |= 1 << (ord(gram[0]) * 31 + ord(c) * 5 + n * 53) % 127
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    low = (1 << 64) - 1
    return signed(letters & low), signed(letters >> 64), signed(grams & low), signed(grams >> 64)


def signed_text(text: Column) -> Column:
    """``signature`` as a struct (l0, l1, g0, g1)."""

    def signatures(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([signature(t) for t in x], columns=["l0", "l1", "g0", "g1"], dtype="int64")

    return F.pandas_udf(signatures, "l0 long, l1 long, g0 long, g1 long")(text)


def may_reach(x: str, y: str, ratio: float) -> Column:
    """Whether the lengths and signatures (columns n_, l0_, l1_, g0_, g1_ followed by ``x`` and ``y``) leave a ratio of ``ratio`` possible.

    The common subsequence has at most the letters in common, and the grams in
    common are at least those of ``grams_in_common`` for the two lengths. What a
    set leaves out of a text is at most what it has fewer than the text.
    """
    both = F.col(f"n_{x}") + F.col(f"n_{y}")
    bits = lambda k, a: F.bit_count(F.col(f"{k}0_{a}")) + F.bit_count(F.col(f"{k}1_{a}"))
    shared = lambda k: F.bit_count(F.col(f"{k}0_{x}").bitwiseAND(F.col(f"{k}0_{y}"))) + F.bit_count(F.col(f"{k}1_{x}").bitwiseAND(F.col(f"{k}1_{y}")))
    left_out = lambda k, fewer: F.least(*[F.col(f"n_{a}") - fewer - bits(k, a) for a in (x, y)])
    least_letters, least_grams = both * (ratio / 200) - 1e-6, both * (3 * ratio / 200 - 1) - 1 - 1e-6
    shortest = F.least(F.col(f"n_{x}"), F.col(f"n_{y}")) >= least_letters
    return shortest & (shared("l") + left_out("l", 0) >= least_letters) & (shared("g") + left_out("g", 1) >= least_grams)
