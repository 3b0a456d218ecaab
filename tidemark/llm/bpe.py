"""Byte-level BPE by speculation and verification.

A greedy longest match proposes tokens for each distinct word of a batch.  A sequence of tokens is what the merges
would give exactly when every adjacent pair is: a pair fails if some merge across its border would have come before the
merges that made its two tokens.  That test runs for all adjacent pairs of the batch at once in numpy, level by level
down the merge trees.  Only words with a failing pair are merged exactly.  The matches walk a trie and the merges their
pairs for all short words at once as well; long words are matched and merged one at a time.

Rows never depend on each other: one narrow map, no shuffle.  A worker holds the vocabulary (a file of bounded size that
the driver reads and broadcasts) and a cache of words of bounded size.

Defined results: null text counts as empty, an empty text has no tokens; special tokens written in a text become their
id, as the tokenizer file says; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name, with_text_columns

# Fixed value: how byte-level tokenizers cut a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words kept in a worker's cache, at most: when half of them are new, the others that were not met since go.  Only speed
#: depends on it.
CACHED_WORDS = 160_000

#: Texts of about this many characters are cut into words at once, as their words take ten times the memory of the texts.
CUT_CHARS = 500_000

#: Words longer than this many bytes are not cached, and are matched and merged one at a time.
CACHED_BYTES = 64

#: Words that are merged at once; they are about equally long.
MERGED_WORDS = 4_096

_NEVER = np.int64(1 << 40)


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in shown}
    letters |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    return letters


class Codec:
    """Encoder and decoder for one byte-level BPE tokenizer file (the ``tokenizers`` library's JSON)."""

    def __init__(self, content: str):
        spec = json.loads(content)
        if spec["model"]["type"] != "BPE" or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE tokenizer file is needed")
        if spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("prefix spaces and normalizers are not supported")
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.by_id: dict[int, bytes] = {
            i: bytes(letters[c] for c in token) for token, i in vocab.items() if token not in self.special
        }
        self.by_id |= {i: token.encode() for token, i in self.special.items()}
        size = max(self.by_id) + 1
        self.pieces = [self.by_id.get(i, b"") for i in range(size)]

        # Order of a token: bytes first, then by the rank of its merge.
        self.order = np.zeros(size, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            self.merges[x, y] = rank, made
            if self.left[made] < 0:
                self.left[made], self.right[made], self.order[made] = x, y, rank + 1
        keys = np.array([x * size + y for x, y in self.merges], np.int64)
        ranks = np.array([rank + 1 for rank, _ in self.merges.values()], np.int64)
        at = np.argsort(keys)
        self.pair_keys, self.pair_orders, self.size = keys[at], ranks[at], size
        self.made = np.zeros(len(spec["model"]["merges"]), np.int64)
        for rank, made in self.merges.values():
            self.made[rank] = made

        self.of_byte = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.cut = regex.compile(PATTERN)
        self.at_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        # The match may only propose tokens that the merges do reach from their own bytes.
        plain = {i: piece for i, piece in self.by_id.items() if i not in self.special.values()}
        made = dict(zip(plain, self.merge(list(plain.values())), strict=True))
        self.proposed = {piece: i for i, piece in plain.items() if len(piece) == 1 or made[i] == np.array([i], "<u4").tobytes()}
        self.longest = max(map(len, self.proposed))
        self.children, self.child, self.token = self._trie()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # -- one word --

    def merged(self, word: bytes) -> list[int]:
        """Exact merging, lowest rank first and leftmost among equals; a heap over a linked list, so long words stay cheap."""
        ids = [self.of_byte[b] for b in word]
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or merges.get((ids[i], ids[j])) != (rank, made):
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if m := merges.get((made, ids[after[i]])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            if before[i] >= 0 and (m := merges.get((ids[before[i]], made))):
                heapq.heappush(heap, (m[0], before[i], m[1]))
        return [i for i in ids if i >= 0]

    def longest_match(self, word: bytes) -> list[int]:
        proposed, longest, out, i, n = self.proposed, self.longest, [], 0, len(word)
        while i < n:
            for end in range(min(n, i + longest), i, -1):
                token = proposed.get(word[i:end])
                if token is not None:
                    break
            out.append(token)
            i = end
        return out

    # -- many words --

    def _trie(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The proposed tokens' prefixes as nodes, the empty one first: sorted node * 256 + byte, the child, and each node's token."""
        nodes: dict[bytes, int] = {b"": 0}
        edges: list[int] = []
        for piece in self.proposed:
            for end in range(1, len(piece) + 1):
                if piece[:end] not in nodes:
                    nodes[piece[:end]] = len(nodes)
                    edges.append(nodes[piece[: end - 1]] << 8 | piece[end - 1])
        token = np.fromiter((self.proposed.get(prefix, -1) for prefix in nodes), np.int64, len(nodes))
        keys = np.array(edges, np.int64)
        at = np.argsort(keys)
        return keys[at], at + 1, token

    def match(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``longest_match`` of short words: all tokens, word by word, and the number of each word's."""
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        at = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        live = np.flatnonzero(at < ends)
        owners, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while len(live):
            token = np.full(len(live), -1)
            after = at[live]
            walking, node, position, end = np.arange(len(live)), np.zeros(len(live), np.int64), at[live], ends[live]
            while len(walking):
                key = node << 8 | text[position]
                found = np.minimum(np.searchsorted(self.children, key), len(self.children) - 1)
                on = self.children[found] == key
                walking, node, position, end = walking[on], self.child[found[on]], position[on] + 1, end[on]
                reached = self.token[node]
                whole = reached >= 0
                token[walking[whole]], after[walking[whole]] = reached[whole], position[whole]
                inside = position < end
                walking, node, position, end = walking[inside], node[inside], position[inside], end[inside]
            owners.append(live)
            tokens.append(token)
            at[live] = after
            live = live[after < ends[live]]
        owner = np.concatenate(owners)
        return np.concatenate(tokens)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))

    def merge(self, words: list[bytes]) -> list[bytes]:
        """``merged`` of each word, as little-endian unsigned 32-bit integers."""
        out = [b""] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= CACHED_BYTES]
        short.sort(key=lambda i: len(words[i]))
        for first in range(0, len(short), MERGED_WORDS):
            some = short[first : first + MERGED_WORDS]
            for i, ids in zip(some, self._merge_short([words[i] for i in some]), strict=True):
                out[i] = ids
        for i, w in enumerate(words):
            if len(w) > CACHED_BYTES:
                out[i] = np.array(self.merged(w), "<u4").tobytes()
        return out

    def _merge_short(self, words: list[bytes]) -> list[bytes]:
        """The same for short words: in each round, every word that has a pair left merges its first, the leftmost of equals."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        width = max(1, int(lengths.max()))
        place = np.arange(width)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        ids = np.where(place < lengths[:, None], np.array(self.of_byte, np.int64)[raw], -1)
        order = np.full(ids.shape, _NEVER)
        pair = place + 1 < lengths[:, None]
        order[pair] = self.merge_order(ids[pair], ids[:, 1:][pair[:, :-1]])
        after, before = np.tile(place + 1, (len(words), 1)), np.tile(place - 1, (len(words), 1))
        live = np.arange(len(words))
        while len(live):
            left = order[live].argmin(1)
            rank = order[live, left]
            live, left, rank = live[rank < _NEVER], left[rank < _NEVER], rank[rank < _NEVER]
            made, right = self.made[rank - 1], after[live, left]
            then, behind = after[live, right], before[live, left]
            ids[live, left], ids[live, right] = made, -1
            order[live, left] = order[live, right] = _NEVER
            after[live, left] = then
            more = then < lengths[live]
            row, i, j = live[more], left[more], then[more]
            before[row, j] = i
            order[row, i] = self.merge_order(made[more], ids[row, j])
            more = behind >= 0
            row, i = live[more], behind[more]
            order[row, i] = self.merge_order(ids[row, i], made[more])
        kept = ids >= 0
        flat, ends = ids[kept].astype("<u4").tobytes(), np.cumsum(kept.sum(1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def merge_order(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """When the pair (x, y) is merged, or never."""
        keys = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_orders[at], _NEVER)

    def compatible(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether their bytes together are encoded as just these two.

        Undo the merges of both tokens, latest first.  Between two undone merges, the symbols that touch at the border
        are fixed; a merge of these that comes before the next undone one would have happened first.  Of merges with
        the same order, the left one happens first.
        """
        x, y = x.astype(np.int64), y.astype(np.int64)
        good = np.ones(len(x), bool)
        live = np.arange(len(x))
        until = np.full(len(x), _NEVER)  # a merge across the border before this would have come in between
        while len(live):
            a, b = x[live], y[live]
            crossing = self.merge_order(a, b) < until[live]
            good[live[crossing]] = False
            oa, ob = self.order[a], self.order[b]
            undo_left = oa > ob  # of equal merges the right one came last
            done = crossing | ((oa == 0) & (ob == 0))
            x[live] = np.where(undo_left & (oa > 0), self.right[a], a)
            y[live] = np.where(~undo_left & (ob > 0), self.left[b], b)
            # A merge across the border, equal to the one undone at its left, comes after it; at its right, before it.
            until[live] = np.where(undo_left, oa, ob + 1)
            live = live[~done]
        return good

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words, as little-endian unsigned 32-bit integers."""
        encoded = [w.encode() for w in words]
        at = [i for i, w in enumerate(encoded) if len(w) <= CACHED_BYTES]
        flat, lengths = self.match([encoded[i] for i in at])
        if len(at) < len(words):
            long = [i for i, w in enumerate(encoded) if len(w) > CACHED_BYTES]
            proposals = [self.longest_match(encoded[i]) for i in long]
            words, encoded = [words[i] for i in at + long], [encoded[i] for i in at + long]
            flat = np.concatenate([flat, *(np.array(p, np.int64) for p in proposals)])
            lengths = np.concatenate([lengths, np.array([len(p) for p in proposals], np.int64)])
        owner = np.repeat(np.arange(len(words)), lengths)
        inside = owner[1:] == owner[:-1]
        pairs, back = np.unique((flat[:-1] * self.size + flat[1:])[inside], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[back]
        failing = np.zeros(len(words), bool)
        failing[owner[1:][inside][~good]] = True
        raw, ends = flat.astype("<u4").tobytes(), np.cumsum(lengths) * 4
        starts = ends - lengths * 4
        found = {w: raw[s:e] for w, s, e in zip(words, starts.tolist(), ends.tolist(), strict=True)}
        exact = np.flatnonzero(failing).tolist()
        for i, ids in zip(exact, self.merge([encoded[i] for i in exact]), strict=True):
            found[words[i]] = ids
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers one after the other."""
        out: list[bytes] = []
        first, size = 0, 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= CUT_CHARS:
                out += self._encode(texts[first : i + 1])
                first, size = i + 1, 0
        return out + self._encode(texts[first:])

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        cut = [self._cut(t or "") for t in texts]
        new = {w for w in set().union(*cut).difference(self.cache) if type(w) is str}
        known = new.intersection(self.older)
        if known:
            self.cache.update((w, self.older[w]) for w in known)
            new -= known
        if new:
            self.cache |= self.learn(list(new))
        get = self.cache.get
        out = [b"".join(map(get, words, words)) for words in cut]  # a special token is its id already
        for w in new:
            if len(w) > CACHED_BYTES:
                del self.cache[w]
        if len(self.cache) > CACHED_WORDS // 2:
            self.older, self.cache = self.cache, {}
        return out

    def _cut(self, text: str) -> list[str | bytes]:
        if not any(s in text for s in self.special):
            return self.cut.findall(text)
        words: list[str | bytes] = []
        start = 0
        for m in self.at_special.finditer(text):
            words += self.cut.findall(text[start : m.start()])
            words.append(np.array([self.special[m[0]]], "<u4").tobytes())
            start = m.end()
        return words + self.cut.findall(text[start:])

    def decode(self, ids: bytes | np.ndarray) -> str:
        """The text of ids; special tokens are written out, bytes that are no UTF-8 become U+FFFD."""
        listed = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else np.asarray(ids)
        return b"".join(map(self.pieces.__getitem__, listed.tolist())).decode(errors="replace")


_codecs: dict[str, Codec] = {}


def codec(content: str) -> Codec:
    """One codec for each tokenizer file in a worker process."""
    key = hashlib.sha256(content.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    return _codecs[key]


def _shared(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text``.  ``path``: the tokenizer file, read by the driver."""
    content = _shared(df, path)

    def start():
        c = codec(content.value)
        return lambda texts: [[np.frombuffer(b, "<u4").astype(np.int32) for b in c.encode(texts)]]

    ids = free_name(ids, df.columns)
    return with_text_columns(df, text, [(ids, T.ArrayType(T.IntegerType()))], start, df.columns)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its token ids; null ids give an empty text."""
    content = _shared(df, path)

    @F.pandas_udf(T.StringType())
    def decoded(column):
        c = codec(content.value)
        return column.map(lambda x: "" if x is None else c.decode(x))

    return df.withColumn(free_name(text, df.columns), decoded(F.col(f"`{ids}`")))


def round_trip(df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Encode and decode each text in one pass, and return the size and the digests of both directions.

    Adds n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers) and decoded_sha256 (UTF-8) to ``keep``.
    """
    content = _shared(df, path)

    def start():
        c = codec(content.value)

        def run(texts):
            ids = c.encode(texts)
            return [
                [len(b) // 4 for b in ids],
                [hashlib.sha256(b).hexdigest() for b in ids],
                [hashlib.sha256(c.decode(b).encode()).hexdigest() for b in ids],
            ]

        return run

    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return with_text_columns(df, text, added, start, df.columns if keep is None else keep)
