"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled rows, one on toxic and one on ordinary text.  Both begin with the
same background (zstandard's trainer over windows of ordinary rows) and end with their own class's segments: words
and beginnings of words that stand, once or several times, in far more texts of this class than of the other.  (Most of a toxic
text is ordinary, so dictionaries of whole windows would differ by chance more than by class.)  A text is cut into windows; a
window that the toxic dictionary makes shorter than the ordinary one does holds toxic segments.  A logistic curve over the
windows' differences, calibrated on labelled rows that the dictionaries never saw, turns them into a score.

Each byte is compressed as a two-byte code of itself and the up to three bytes of its word before it.  So chance likenesses
of a few letters are no matches, and a matching word saves more than the match costs.

Fitting uses a bounded sample: the whole texts of the FIT_ROWS labelled rows with the smallest hash of their id; of their ordinary
windows the background is made of about BACKGROUND_WINDOWS, chosen by hash among all.  Scoring reads whole texts and is a
narrow map; the model (a few kilobytes) travels with the tasks.

Defined results: a null text counts as empty; a text without letters has one empty window, whose difference is 0; without
labelled rows of both classes every score is the share of toxic rows (0 without any); of several labels of one id the highest
counts; other columns are kept.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name, with_text_columns

#: Labelled rows that are fitted, at most.
FIT_ROWS = 6_000
#: Bytes of text in a window.
WINDOW = 60
#: Bytes of the background, and of text in each class's segments, at most.
BACKGROUND, SEGMENTS = 16_384, 8_192
#: Windows that the background is trained on, about, and bits that tell which word triples were seen.
BACKGROUND_WINDOWS, SEEN_BITS = 30_000, 27
#: Characters of the beginnings of words that make segments beside whole words, blank included; and how many times the
#: other class's share of texts a segment must reach.
HEADS = (5, 6, 7, 8, 9)
LIFT = 30
#: How many times a text may have to hold a segment for it to tell something.
TIMES = (1, 2, 3)
#: Score from which a text is called toxic.
TOXIC = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_CUT = re.compile(rb"(?s).{1,%d}(?= )|.{1,%d}" % (WINDOW, WINDOW))


def _plain(text: str | None) -> str:
    """Lower-case words between single blanks; everything else is dropped."""
    return f" {' '.join(_WORD.findall((text or '').lower()))} "


def _codes(raw: bytes) -> bytes:
    """Two bytes for each byte of plain text: a hash of it and the bytes of its word (with the blank) before it, up to three."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    context, same_word = b.copy(), np.ones(len(b), bool)
    for back in range(1, min(4, len(b))):
        if back > 1:
            same_word[back:] &= b[1 : len(b) - back + 1] != 32
        context[back:] |= np.where(same_word[back:], b[:-back] << np.uint32(8 * back), np.uint32(0))
    return ((context * np.uint32(2654435761)) >> np.uint32(16)).astype("<u2").tobytes()


def _windows(plain: str) -> list[bytes]:
    raw = plain.encode()
    codes = _codes(raw)
    return [codes[2 * m.start() : 2 * m.end()] for m in _CUT.finditer(raw)]


def _heads(word: str) -> list[str]:
    """A word with the blanks around it, and its beginnings."""
    whole = f" {word} "
    return [whole, *(whole[:n] for n in HEADS if n < len(whole))]


def _surprise(a: int, b: int, na: int, nb: int) -> float:
    """Likelihood ratio (G) of a of na and b of nb against one common share."""
    share = (a + b) / (na + nb)
    return 2 * sum(x * math.log(x / (n * share)) for x, n in ((a, na), (b, nb)) if x)


def _held(plain: str) -> list[tuple[str, int]]:
    """The heads of a text's words, each with every number of times of TIMES that it reaches."""
    counts = Counter(h for w in plain.split() for h in _heads(w))
    return [(h, m) for h, n in counts.items() for m in TIMES if n >= m]


def _telling(own: Counter, other: Counter, n_own: int, n_other: int) -> set[str]:
    """Heads that far more of the class's texts hold so many times than of the other's, by more than chance over all allows."""
    least = 2 * math.log(max(2, len(own)))
    return {
        g[0]
        for g, a in own.items()
        if a > 2 and a / n_own >= LIFT * (b := other[g] + 0.5) / n_other and _surprise(a, other[g], n_own, n_other) >= least
    }


def _own_texts(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Rows without the copies of earlier ones, whose every word would look telling: a third of the word triples is known.

    Triples are known by a bit of their hash in an array of fixed size.
    """
    seen = np.zeros(1 << (SEEN_BITS - 3), np.uint8)
    out = []
    for plain, y in rows:
        words = np.array([zlib.crc32(w.encode()) for w in plain.split()] or [0], np.uint64)
        words = np.append(words, np.zeros(max(0, 3 - len(words)), np.uint64))
        mixed = (words[:-2] * np.uint64(31) + words[1:-1]) * np.uint64(1_000_003) + words[2:]
        at = np.unique((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SEEN_BITS)).astype(np.int64)
        bit = (1 << (at & 7)).astype(np.uint8)
        if 3 * np.count_nonzero(seen[at >> 3] & bit) <= len(at):
            out.append((plain, y))
        np.bitwise_or.at(seen, at >> 3, bit)
    return out


def _segments(plain: str, telling: set[str]) -> set[str]:
    """The longest telling head of each word."""
    return {max(found, key=len) for word in set(plain.split()) if (found := telling.intersection(_heads(word)))}


def _settings() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(
        min_match=6, strategy=zstandard.STRATEGY_BTLAZY2, window_log=17, hash_log=15, chain_log=15, search_log=4,
        target_length=64, write_content_size=False, write_dict_id=False,
    )


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    prior: float

    def scorer(self):
        """A function from texts to scores; compressors are made once."""
        if not self.weights:
            return lambda texts: [self.prior] * len(texts)
        features = _measure(self.toxic, self.ordinary)
        slopes = np.array(self.weights[1:])

        def run(texts: list[str | None]) -> list[float]:
            z = np.array([features(t) for t in texts]).reshape(len(texts), -1) @ slopes + self.weights[0]
            return (1 / (1 + np.exp(-np.clip(z, -30, 30)))).tolist()

        return run


def _measure(toxic: bytes, ordinary: bytes):
    """A function from a text to its features under two dictionaries."""
    by = []
    for content in (toxic, ordinary):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=_settings())
        by.append(zstandard.ZstdCompressor(dict_data=d, compression_params=_settings()).compress)
    by_toxic, by_ordinary = by

    def features(text: str | None) -> list[float]:
        return _features([len(by_ordinary(w)) - len(by_toxic(w)) for w in _windows(_plain(text))])

    return features


#: Bytes by which a window is shorter with the toxic dictionary: where it counts as found, and what a window counts for at most.
FOUND, MOST = (3, 6), 12


def _features(differences: list[int]) -> list[float]:
    """The five largest differences, their sum, the windows found as a share and as numbers, and the mean."""
    d = np.array(differences, float)
    largest = np.append(np.sort(d)[::-1], np.zeros(5))[:5]
    found = [np.count_nonzero(d >= least) for least in FOUND]
    return [
        *np.minimum(largest, MOST), math.log1p(np.maximum(d, 0).sum()), found[0] / len(d), *map(math.log1p, found), d.mean(),
    ]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the intercept is free."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(rows: list[tuple[int, str | None, int]]) -> Model:
    """Train on (id, text, label) rows: two thirds make the dictionaries, one third the calibration."""
    prior = sum(y for *_, y in rows) / len(rows) if rows else 0.0
    fitting = _own_texts([(_plain(t), y) for i, t, y in rows if zlib.crc32(f"fit {i}".encode()) % 3])
    held = [(t, y) for i, t, y in rows if zlib.crc32(f"fit {i}".encode()) % 3 == 0]
    if len({y for _, y in fitting}) < 2:
        return Model(b"", b"", (), prior)
    if len({y for _, y in held}) < 2:
        held = [(t, y) for _, t, y in rows]

    counts, sizes = (Counter(), Counter()), Counter(y for _, y in fitting)
    for plain, y in fitting:
        counts[y].update(_held(plain))
    own = []
    for y in (0, 1):
        telling = _telling(counts[y], counts[1 - y], sizes[y], sizes[1 - y])
        found = Counter(s for plain, label in fitting if label == y for s in _segments(plain, telling))
        ranked = sorted(found, key=lambda s: (found[s], s))
        own.append("".join(ranked).encode()[-SEGMENTS:])  # the most frequent stand last, where matches are cheapest
    del counts
    share = BACKGROUND_WINDOWS / max(1, sum(len(plain) for plain, y in fitting if y == 0) / WINDOW)
    windows = [
        w for plain, y in fitting if y == 0 for w in _windows(plain) if zlib.crc32(w) < share * (1 << 32)
    ]
    try:
        background = zstandard.train_dictionary(BACKGROUND, windows, d=8, k=96).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        background = b"".join(windows)[-BACKGROUND:]
    coded = [_codes(segments) for segments in own]
    width = max(map(len, coded))  # so that the background is equally far in both
    ordinary, toxic = (background + c.rjust(width, b"\0") for c in coded)
    features = _measure(toxic, ordinary)
    x = np.array([features(t) for t, _ in held])
    y = np.array([label for _, label in held], float)
    return Model(toxic, ordinary, tuple(_logistic(x, y)), prior)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    """Fit on a bounded sample of the labelled rows.  Rows without a label or id are no part of it."""
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("id_"))
        .agg(F.max(label).alias("label_"))
        .orderBy(F.xxhash64("id_"), "id_")
        .limit(FIT_ROWS)
    )
    texts = docs.select(F.col(key).alias("id_"), F.col(text).cast("string").alias("text_"))
    rows = (
        texts.join(F.broadcast(chosen), "id_")  # FIT_ROWS rows at most
        .orderBy(F.xxhash64("id_"), "id_", F.xxhash64("text_"))
        .limit(FIT_ROWS)
        .collect()
    )
    return fit([(r.id_, r.text_, int(r.label_ > 0)) for r in rows])


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep``'s columns (all) with ``score``, 0 to 1."""
    keep = df.columns if keep is None else keep

    def start():
        run = model.scorer()
        return lambda texts: [run(texts)]

    return with_text_columns(df, text, [("score", T.DoubleType())], start, keep)


def reject(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text is not toxic."""

    def start():
        run = model.scorer()
        return lambda texts: [[x >= TOXIC for x in run(texts)]]

    toxic = free_name("toxic", df.columns)
    judged = with_text_columns(df, text, [(toxic, T.BooleanType())], start, df.columns)
    return judged.where(~F.col(toxic)).drop(toxic)
