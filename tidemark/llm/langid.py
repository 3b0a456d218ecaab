"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes, blanks around it, in both directions and labels every position with a language; it is trained in
numpy by backpropagation through time.  A document's probabilities pool the positions of all its words: the normalised
geometric mean.  States start anew at every word, so the positions' labels are worked out once for each distinct word that a worker
meets (its memory of words is bounded and only saves time).

Fitting uses a bounded sample: for each language the DOCS rows with the smallest hash of their id, and at most CHARS characters
of each; ranks are cut off before the shuffle, so a language with most rows is no bottleneck.  Prediction reads whole texts in a narrow
map; the weights (a few ten kilobytes) travel with the tasks.

Defined results: a text that is null or holds no letter is ``und`` with score 0; without a labelled row every text is; words
are lower-cased, those of more than WORD_BYTES bytes are read in pieces; other columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import with_text_columns

#: Rows of each language that are fitted, at most, and characters of each.
DOCS, CHARS = 150, 3_000
#: Units of each direction, bytes of a piece of a word.
UNITS, WORD_BYTES = 8, 30
STEPS, BATCH, RATE = 450, 384, 0.01
SEED = 7
#: Words that a worker remembers.
KNOWN_WORDS = 400_000

_LETTERS = re.compile(r"[^\W\d_]+")


def _pieces(word: str) -> list[bytes]:
    raw = word.encode()
    return [raw[i : i + WORD_BYTES] for i in range(0, len(raw), WORD_BYTES)]


def _by_length(pieces: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(indices, bytes with blanks around) of the pieces of each length."""
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    out = []
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        raw = np.frombuffer(b"".join(b" " + pieces[i] + b" " for i in at.tolist()), np.uint8).reshape(len(at), n + 2)
        out.append((at, raw))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(x: np.ndarray, w: dict[str, np.ndarray], side: str, keep: bool = False):
    """States of one direction at every position; with ``keep`` also what the way back needs."""
    rows, steps = x.shape
    units = w[f"U{side}"].shape[0]
    order = range(steps) if side == "f" else range(steps - 1, -1, -1)
    h = np.zeros((rows, units), np.float32)
    states, kept = np.empty((steps, rows, units), np.float32), []
    for t in order:
        a = w[f"E{side}"][x[:, t]]
        u = h @ w[f"U{side}"]
        gates = _sigmoid(a[:, : 2 * units] + u[:, : 2 * units])
        z, r = gates[:, :units], gates[:, units:]
        c = np.tanh(a[:, 2 * units :] + r * u[:, 2 * units :])
        before, h = h, c + z * (h - c)
        states[t] = h
        if keep:
            kept.append((t, before, z, r, c, u[:, 2 * units :]))
    return states, kept


def _back(d_states: np.ndarray, kept: list, x: np.ndarray, w: dict, side: str, grad: dict) -> None:
    """Backpropagation through time of one direction."""
    units = w[f"U{side}"].shape[0]
    dh = np.zeros_like(d_states[0])
    for t, before, z, r, c, uc in reversed(kept):
        dh = dh + d_states[t]
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (before - c) * z * (1 - z)
        dr = dc * uc * r * (1 - r)
        np.add.at(grad[f"E{side}"], x[:, t], np.concatenate([dz, dr, dc], 1))
        du = np.concatenate([dz, dr, dc * r], 1)
        grad[f"U{side}"] += before.T @ du
        dh = dh * z + du @ w[f"U{side}"].T


def _log_probabilities(fore: np.ndarray, aft: np.ndarray, w: dict) -> np.ndarray:
    """Of every inner position: (steps, rows, languages)."""
    logits = np.concatenate([fore, aft], 2)[1:-1] @ w["V"] + w["b"]
    logits -= logits.max(2, keepdims=True)
    return logits - np.log(np.exp(logits).sum(2, keepdims=True))


@dataclass
class Network:
    languages: list[str]
    weights: dict[str, np.ndarray]

    def position_sums(self, pieces: list[bytes]) -> np.ndarray:
        """For each piece, its positions' log-probabilities summed, and the number of positions."""
        out = np.zeros((len(pieces), len(self.languages) + 1), np.float64)
        for at, x in _by_length(pieces):
            for first in range(0, len(at), 4096):
                part = x[first : first + 4096]
                logs = _log_probabilities(_run(part, self.weights, "f")[0], _run(part, self.weights, "b")[0], self.weights)
                out[at[first : first + 4096], :-1] = logs.sum(0)
            out[at, -1] = x.shape[1] - 2
        return out

    def predictor(self):
        """A function from texts to languages and scores."""
        known: dict[str, int] = {}
        sums = np.zeros((1024, len(self.languages) + 1))

        def learn(words: list[str]) -> None:
            nonlocal sums
            pieces = [_pieces(w) for w in words]
            found = self.position_sums([p for ps in pieces for p in ps])
            total = np.add.reduceat(found, np.cumsum([0, *map(len, pieces[:-1])]), axis=0)
            first = len(known)
            if first + len(words) > len(sums):
                sums = np.vstack([sums, np.zeros((first + len(words), sums.shape[1]))])
            sums[first : first + len(words)] = total
            known.update(zip(words, range(first, first + len(words))))

        def run(texts: list[str | None]):
            words = [_LETTERS.findall((t or "").lower()) for t in texts]
            if len(known) > KNOWN_WORDS:
                known.clear()
            new = {w for ws in words for w in ws} - known.keys()
            if new and self.languages:
                learn(list(new))
            best, score = [], []
            for ws in words:
                if not ws or not self.languages:
                    best.append("und")
                    score.append(0.0)
                    continue
                total = sums[[known[w] for w in ws]].sum(0)
                p = np.exp(total[:-1] / total[-1])
                p /= p.sum()
                k = int(p.argmax())
                best.append(self.languages[k])
                score.append(float(min(1.0, p[k])))
            return [best, score]

        return run


def fit(rows: list[tuple[str | None, str]]) -> Network:
    """Train on (text, language) rows: batches of words, every language equally often."""
    by_language: dict[str, list[bytes]] = {}
    for text, language in sorted(rows, key=lambda r: (r[1], r[0] or "")):
        pieces = [p for w in _LETTERS.findall((text or "").lower()) for p in _pieces(w)]
        by_language.setdefault(language, []).extend(pieces)
    languages = sorted(k for k, v in by_language.items() if v)
    rng = np.random.default_rng(SEED)
    n, h = len(languages), UNITS
    w: dict[str, np.ndarray] = {"V": rng.normal(0, 0.2, (2 * h, n)), "b": np.zeros(n)}
    for side in "fb":
        w[f"E{side}"] = rng.normal(0, 0.3, (256, 3 * h))
        w[f"U{side}"] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h))
    w = {k: v.astype(np.float32) for k, v in w.items()}
    if n < 2:
        return Network(languages, w)
    words = [by_language[x] for x in languages]
    moment, spread = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for step in range(1, STEPS + 1):
        label = rng.integers(0, n, BATCH)
        pieces = [words[k][int(rng.integers(len(words[k])))] for k in label]
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        positions = sum(map(len, pieces))
        for at, x in _by_length(pieces):
            fore, kept_f = _run(x, w, "f", keep=True)
            aft, kept_b = _run(x, w, "b", keep=True)
            d = np.exp(_log_probabilities(fore, aft, w))
            d[:, np.arange(len(at)), label[at]] -= 1
            d /= positions
            both = np.concatenate([fore, aft], 2)[1:-1]
            grad["V"] += np.tensordot(both, d, ([0, 1], [0, 1]))
            grad["b"] += d.sum((0, 1))
            d_states = np.zeros((x.shape[1], len(at), 2 * h), np.float32)
            d_states[1:-1] = d @ w["V"].T
            _back(d_states[:, :, :h], kept_f, x, w, "f", grad)
            _back(d_states[:, :, h:], kept_b, x, w, "b", grad)
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k in w:
            moment[k] = 0.9 * moment[k] + 0.1 * grad[k]
            spread[k] = 0.99 * spread[k] + 0.01 * grad[k] ** 2
            w[k] -= rate * (moment[k] / (1 - 0.9**step)) / (np.sqrt(spread[k] / (1 - 0.99**step)) + 1e-7)
    return Network(languages, w)


def train(docs: DataFrame, language: str = "lang", key: str = "doc_id", text: str = "text") -> Network:
    """Fit on a bounded sample of each language's rows.  Rows without a language or letters are no part of it."""
    order = Window.partitionBy("language_").orderBy("hash_", "text_")
    rows = (
        docs.where(F.col(language).isNotNull() & has_letter(F.col(text)))
        .select(
            F.col(language).cast("string").alias("language_"),
            F.xxhash64(F.col(key)).alias("hash_"),
            F.substring(F.col(text), 1, CHARS).alias("text_"),
        )
        .withColumn("rank_", F.row_number().over(order))
        .where(F.col("rank_") <= DOCS)
        .collect()
    )
    return fit([(r.text_, r.language_) for r in rows])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


_predictors: dict[int, object] = {}


def _predictor(network: Network):
    """One predictor for each network in a worker process, so that its words serve all tasks."""
    key = hash(tuple(v.tobytes() for _, v in sorted(network.weights.items())))
    if key not in _predictors:
        _predictors.clear()
        _predictors[key] = network.predictor()
    return _predictors[key]


def identify(df: DataFrame, network: Network, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep``'s columns (all) with ``lang_pred`` and ``score``, the share of the pooled probability."""
    added = [("lang_pred", T.StringType()), ("score", T.DoubleType())]
    return with_text_columns(df, text, added, lambda: _predictor(network), df.columns if keep is None else keep)
