"""Operator 5: document quality by Bradley-Terry pairwise ranking.

Features are counts over the bytes and words of the whole text.  The weights are learned on the
driver from a bounded sample of labelled rows: pairs of a good and a bad document, logistic
loss on the difference of their features.  The scores of all labelled rows outside the
held-out fold are cut at the quantile that is the share of bad rows among them.  Documents are scored where they are scanned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import residue
from tierflow.llm.kernels import mix, settle, shingle_hashes, slices, word_hashes
from tierflow.sources.scratch import staged

#: Most labelled rows that a model is fitted on, those with the smallest hashed ids.
SAMPLE_ROWS = 20_000
PAIRS_PER_ROW = 8
ROUNDS = 400
RATE = 0.5
RIDGE = 1e-3
#: Quantiles are exact to one part in so many rows.
QUANTILE_ACCURACY = 100_000
HELD_OUT = (3, 1)
SLICE_CHARS = 1 << 20

FEATURES = (
    "symbols", "bars", "bangs", "capitals", "digits", "marks", "repeats", "word_length", "words",
)
SPACE, SYMBOL, BAR, BANG, CAPITAL, DIGIT, MARK, LETTER = range(8)


def _kinds() -> np.ndarray:
    """The kind of each byte; only the first byte of a UTF-8 character counts as a letter."""
    kind = np.full(256, LETTER, np.uint8)
    kind[[32, *range(9, 14), *range(0x80, 0xC0)]] = SPACE
    kind[list(b"#*$%&<>")] = SYMBOL
    kind[ord("|")], kind[ord("!")] = BAR, BANG
    kind[ord("A") : ord("Z") + 1] = CAPITAL
    kind[ord("0") : ord("9") + 1] = DIGIT
    kind[list(b".,;:?")] = MARK
    return kind


_KINDS = _kinds()


@dataclass(frozen=True)
class Ranking:
    """Weights on standardized features, the cut of their sum, and the scale of the score."""

    centre: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float
    scale: float


def features(texts: Sequence[str | None]) -> np.ndarray:
    """One row of numbers between 0 and 1 for each text; an empty text has zeros.

    Shares of symbols, separators, exclamation marks, capitals (ASCII and Latin-1), digits
    and other marks, of words in 3-word windows that occur again, and the word length.
    """
    found = [
        _features([(t or "").encode("utf-8", "surrogatepass") for t in texts[i:j]])
        for i, j in slices([len(t or "") for t in texts], SLICE_CHARS)
    ]
    settle()
    return np.concatenate(found) if found else np.empty((0, len(FEATURES)))


def _features(texts: list[bytes]) -> np.ndarray:
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    hashes, n_words = word_hashes(texts)
    kind = _KINDS[buf]
    accented = (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[:-1] == 0xC3)
    kind[1:][accented] = CAPITAL
    kind[:-1][accented] = SPACE  # counted once

    def count(what: int) -> np.ndarray:
        return np.add.reduceat((kind == what).astype(np.int64), starts)

    chars = np.maximum(count(LETTER) + sum(count(k) for k in range(SYMBOL, LETTER)), 1)
    per_word = np.maximum(n_words, 1)
    windows, n_windows = shingle_hashes(hashes, n_words, 3)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), n_windows)
    _, first = np.unique(mix(windows + owner * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    again = n_windows - np.bincount(owner[first].astype(np.int64), minlength=len(texts))
    columns = (
        (count(SYMBOL) + count(BAR)) * 5 / chars,
        count(BAR) * 5 / per_word,
        count(BANG) * 2 / per_word,
        count(CAPITAL) * 3 / chars,
        count(DIGIT) * 2 / chars,
        count(MARK) * 3 / per_word,
        again * 3 / per_word,
        chars / (per_word * 16),
        (n_words > 0).astype(float),
    )
    return np.minimum(np.stack(columns, axis=1), 1.0) * (n_words > 0)[:, None]


def feature_rows(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def rows(texts: pd.Series) -> pd.Series:
        return pd.Series(list(features(texts.tolist())), index=texts.index)

    return rows(text)


def pairs_of(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Feature differences of a bounded number of (good, bad) pairs; every row takes part."""
    n = max(len(good), len(bad))
    row = np.arange(n)
    found = [good[row % len(good)] - bad[(row + row // len(bad) + k * 7919) % len(bad)]
             for k in range(PAIRS_PER_ROW)]
    return np.concatenate(found)


def fit(x: np.ndarray, label: np.ndarray) -> Ranking | None:
    """Weights from feature rows and their 0/1 labels; None without both labels.  The cut is
    still to be set."""
    good, bad = x[label == 1], x[label == 0]
    if not len(good) or not len(bad):
        return None
    centre, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 0.02)
    z = (x - centre) / spread
    d = pairs_of(z[label == 1], z[label == 0])
    weights = np.zeros(x.shape[1])
    for _ in range(ROUNDS):
        wrong = 1 / (1 + np.exp(np.clip(d @ weights, -30, 30)))
        weights += RATE * (d.T @ wrong / len(d) - RIDGE * weights)
    return Ranking(*(tuple(map(float, v)) for v in (centre, spread, weights)), 0.0, 1.0)


def learn(
    documents: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS,
    doc_id: str = "doc_id", text: str = "text", quality: str = "quality",
) -> Ranking | None:
    """Weights from at most ``sample_rows`` labelled rows outside the held-out fold; the cut
    and the scale from the sums of all of those rows."""
    modulus, held = HELD_OUT
    known = labels.select(F.col(doc_id).alias("id"), F.col(quality).alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isin(0, 1)
        & (residue(F.col("id"), modulus) != held)
    )
    # One scan of the texts; only numbers are joined and go on from here.
    learning = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where(
        F.col("id").isNotNull() & (residue(F.col("id"), modulus) != held)
    )
    numbers = learning.select("id", feature_rows(F.col("text")).alias("x"))
    rows = staged(numbers.join(known, "id"), "features")
    # Thinned by a hash before it is ordered, so that no task sends a whole sample of its own.
    share = int((1 << 30) * min(1.0, sample_rows / max(rows.count(), 1)))
    thinned = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)
    chosen = thinned.orderBy(F.xxhash64("id"), "id", "label", F.xxhash64("x")).limit(sample_rows)
    sample = sorted(chosen.collect(), key=lambda r: (r["id"], r["label"], r["x"]))
    if not sample:
        return None
    model = fit(np.array([r["x"] for r in sample]), np.array([r["label"] for r in sample]))
    return model and threshold(model, rows)


def threshold(model: Ranking, rows: DataFrame) -> Ranking:
    """The model with its cut: as large a share of all labelled rows lies below as is bad."""
    centre, spread, weights = map(np.array, (model.centre, model.spread, model.weights))
    total = F.lit(float(-(centre / spread) @ weights))
    for i, w in enumerate(weights / spread):
        total = total + F.get("x", F.lit(i)) * float(w)
    sums = rows.select(total.alias("s"), F.col("label").alias("label"))
    share = sums.agg(F.avg((F.col("label") == 0).cast("double")).alias("bad")).first()["bad"]
    cut = sums.agg(F.percentile_approx("s", share, QUANTILE_ACCURACY).alias("q")).first()["q"]
    wide = sums.agg(F.percentile_approx(F.abs(F.col("s") - cut), 0.5, QUANTILE_ACCURACY).alias("q")).first()["q"]
    return replace(model, cut=float(cut), scale=max(float(wide) / 3, 1e-6))


def score(text: Column, model: Ranking | None) -> Column:
    """Score between 0 and 1; 0.5 for every text if there was nothing to learn from."""
    if model is None:
        return F.lit(0.5)
    centre, spread, weights = map(np.array, (model.centre, model.spread, model.weights))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        total = ((features(texts.tolist()) - centre) / spread) @ weights
        bounded = np.clip((total - model.cut) / model.scale, -700, 700)
        return pd.Series(1 / (1 + np.exp(-bounded)), index=texts.index)

    return scored(text)


def ranked(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Score of every document.

    NULL and empty texts are scored as empty; NULL ids are kept (their fold is that of
    residue 0); repeated rows get the same score; other columns are not looked at; an
    empty table gives an empty result.
    """
    model = learn(documents, labels, doc_id=doc_id, text=text, **options)
    modulus, held = HELD_OUT
    return documents.select(
        F.col(doc_id).alias("doc_id"),
        (residue(F.col(doc_id), modulus) == held).alias("held_out"),
        score(F.col(text), model).alias("score"),
    ).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
