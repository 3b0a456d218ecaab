"""Quality rules: exact rule statistics of each text, and an isolation forest over them.

Two plain rules reject short texts and texts that mostly repeat themselves.  All statistics, as shares that do not depend on
a text's length, go through an isolation forest: trees of random splits, grown on texts labelled good, in which an unusual text
needs few splits until it stands alone.  The path length over all trees gives a score from 0 to 1; the score from which a
text is rejected is the one that separates labelled good and bad rows best among those that reject at most FALSE_ALARMS of the
good ones.

Fitting uses a bounded sample: the FIT_ROWS labelled rows with the smallest hash of their id, and SUBSAMPLE of these for each
tree.  Scoring reads whole texts in a narrow map; the trees travel with the tasks.

Defined results: a null or empty text has no words, fails the base rules and is not kept; without labelled rows of both
kinds only the base rules decide; of several labels of one id the lowest counts; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import with_text_columns

#: Labelled rows that are fitted, at most.
FIT_ROWS = 6_000
TREES, SUBSAMPLE = 128, 256
#: Share of good labelled rows that the threshold may reject.
FALSE_ALARMS = 0.01
#: Standard deviations of all fitted rows by which the ranges of splits are widened.
MARGIN = 2.0
SEED = 20_240_607

_BLANK = " \t\n\r\x0b\x0c"
_SYMBOLS = "#*$%&|<>"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
N_SHARES = 10


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base statistics, and the shares that the forest sees."""
    text = text or ""
    words = text.encode().split()  # bytes part at ASCII white space only
    n = len(words)
    blanks = sum(map(text.count, _BLANK))
    chars = len(text) - blanks
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    dup_lines = len(lines) - len(set(lines))
    ids: dict[bytes, int] = {}
    numbers = np.fromiter([ids.setdefault(w, len(ids)) for w in words], np.int64, n)
    repeated = _words_in_repeats(numbers, len(ids))
    raw = np.frombuffer(text.encode(), np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    digits = int(((raw >= 48) & (raw <= 57)).sum())
    marks = sum(map(text.count, ".,;:!?()\"'"))
    n1, c1 = max(1, n), max(1, chars)
    shares = [
        chars / n1, symbols / c1, dup_lines / max(1, len(lines)), repeated / n1, upper / c1, digits / c1, marks / n1,
        len(lines) / n1, text.count("!") / c1, text.count("|") / n1,
    ]
    return [n, chars, symbols, dup_lines, repeated], shares


def _words_in_repeats(numbers: np.ndarray, distinct: int) -> int:
    """Words that stand in a window of three words which the text holds more than once."""
    if len(numbers) < 4:
        return 0
    pairs = numbers[:-1] * distinct + numbers[1:]
    if distinct > 2_000_000:  # keep the product within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * distinct + numbers[2:]
    _, which, counts = np.unique(windows, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(numbers), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n values in a random binary tree."""
    n = np.asarray(n, float)
    many = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Trees as flat arrays: a node's feature (-1 in a leaf), split, children, and the path length that a leaf stands for."""

    feature: np.ndarray
    split: np.ndarray
    child: np.ndarray
    path: np.ndarray
    sample: int
    threshold: float = 2.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """0.5 for usual rows, towards 1 for rows that few splits isolate."""
        if not len(self.feature):
            return np.zeros(len(x))
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        rows = np.arange(len(x))[:, None]
        while True:
            f = self.feature[trees, at]
            if (f < 0).all():
                break
            right = x[rows, np.maximum(f, 0)] >= self.split[trees, at]
            at = np.where(f < 0, at, self.child[trees, at] + right)
        return 2.0 ** (-self.path[trees, at].mean(1) / float(_expected_path(self.sample)))


def grow(x: np.ndarray, margin: np.ndarray, seed: int = SEED) -> Forest:
    """An isolation forest over the rows of ``x``.

    Splits are drawn from a node's range widened by ``margin``, so that values beyond all grown rows are soon cut off into
    empty leaves.  Features without a margin are not used.
    """
    rng = np.random.default_rng(seed)
    sample = min(SUBSAMPLE, len(x))
    limit = int(np.ceil(np.log2(max(2, sample))))
    size = 2 ** (limit + 1)
    used_features = np.flatnonzero(margin > 0)
    feature = np.full((TREES, size), -1)
    split, path, child = np.zeros((TREES, size)), np.zeros((TREES, size)), np.zeros((TREES, size), np.int64)
    for t in range(TREES):
        waiting, used = [(0, x[rng.choice(len(x), sample, replace=False)], 0)], 1
        while waiting:
            node, rows, depth = waiting.pop()
            if depth == limit or len(rows) < 2 or not len(used_features):
                path[t, node] = depth + _expected_path(len(rows))
                continue
            f = rng.choice(used_features)
            s = rng.uniform(rows[:, f].min() - margin[f], rows[:, f].max() + margin[f])
            feature[t, node], split[t, node], child[t, node] = f, s, used
            above = rows[:, f] >= s
            waiting += [(used, rows[~above], depth + 1), (used + 1, rows[above], depth + 1)]
            used += 2
    return Forest(feature, split, child, path, sample)


def fit(x: np.ndarray, good: np.ndarray) -> Forest:
    """Grow the forest on the good rows of ``x`` and calibrate its threshold on all."""
    if good.sum() < 2 or good.all():
        none = np.zeros((0, 1))
        return Forest(none.astype(int), none, none.astype(int), none, 1)
    forest = grow(x[good], MARGIN * x.std(0))
    scores = forest.score(x)
    candidates = np.unique(scores)
    cuts = np.append((candidates[1:] + candidates[:-1]) / 2, candidates[-1] + 1e-9)
    alarms = (scores[good][None, :] >= cuts[:, None]).mean(1)
    caught = (scores[~good][None, :] >= cuts[:, None]).mean(1)
    gain = np.where(alarms <= FALSE_ALARMS, caught - alarms, -1)
    return Forest(forest.feature, forest.split, forest.child, forest.path, forest.sample, float(cuts[gain.argmax()]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> Forest:
    """Fit on a bounded sample of the labelled rows.  Rows without a label or id are no part of it."""
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("id_"))
        .agg(F.min(label).alias("label_"))
        .orderBy(F.xxhash64("id_"), "id_")
        .limit(FIT_ROWS)
    )
    rows = (
        docs.select(F.col(key).alias("id_"), F.col(text).alias("text_"))
        .join(F.broadcast(chosen), "id_")  # FIT_ROWS rows at most
    )
    measured = _measure(rows, "text_", ["id_", "label_"])  # the driver gets numbers, not texts
    sample = measured.orderBy(F.xxhash64("id_"), "id_", "shares").limit(FIT_ROWS).collect()
    x = np.array([r.shares for r in sample]).reshape(-1, N_SHARES)
    return fit(x, np.array([r.label_ > 0 for r in sample], bool))


_SHARES = ("shares", T.ArrayType(T.DoubleType()))


def _measure(df: DataFrame, text: str, keep: list[str], forest: Forest | None = None) -> DataFrame:
    """Base statistics and shares; with a forest, the verdicts instead of the shares."""

    def start():
        def run(texts):
            found = [statistics(t) for t in texts]
            base = [list(c) for c in zip(*(b for b, _ in found), strict=True)] or [[] for _ in BASE]
            if forest is None:
                return [*base, [s for _, s in found]]
            failed = [base_failed(b[0], b[4]) for b, _ in found]
            scores = forest.score(np.array([s for _, s in found]).reshape(-1, N_SHARES))
            kept = [not f and s < forest.threshold for f, s in zip(failed, scores.tolist(), strict=True)]
            return [*base, failed, kept, scores.tolist()]

        return run

    verdicts = [("base_failed", T.BooleanType()), ("kept", T.BooleanType()), ("anomaly", T.DoubleType())]
    added = [(n, T.LongType()) for n in BASE] + ([_SHARES] if forest is None else verdicts)
    return with_text_columns(df, text, added, start, keep)


def judge(df: DataFrame, forest: Forest, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep``'s columns (all) with the base statistics, ``base_failed``, ``kept`` and the forest's score ``anomaly``."""
    return _measure(df, text, df.columns if keep is None else keep, forest)
