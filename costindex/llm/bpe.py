"""Byte-level BPE encoding and decoding: speculate, verify, and merge only where needed.

A text is split into words as the tokenizer splits it (special tokens first).  For
words not seen before:

1. greedy longest-match over the vocabulary proposes tokens;
2. every adjacent pair of proposed tokens is checked, all pairs of a batch at once
   in numpy: a pair is compatible when no merge could ever have crossed the
   boundary between the two.  Undoing the merges of the two tokens one by one, the
   latest first, gives the neighbours that met at the boundary; a merge of such
   neighbours that comes before either of them was merged further breaks it;
3. a word whose pairs are all compatible is encoded; the others are merged exactly.

Step 2 is exact for vocabularies whose merges come after their parts' merges.
Vocabulary entries that merging their own bytes does not give are never proposed
(found by the same check), and a vocabulary without that order gets exact merges
throughout.

Decoding joins the tokens' bytes and reads them as UTF-8; broken sequences become
U+FFFD.

Defined results: a null or empty text has no tokens and decodes to the empty text;
repeated rows get a row each; very long words are merged with a heap, in time
n log n; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from costindex.llm.common import append_columns

#: Words kept by a worker in each of two generations.
CACHE = 200_000
#: Proposals are made for words up to this many bytes; longer ones are merged exactly.
LONGEST = 512
#: Failing words up to this many bytes are merged side by side, longer ones each with a heap.
SHORT = 64
#: White space of the tokenizers' patterns (Unicode White_Space), fixed.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
#: How a byte-level tokenizer splits a text into words (fixed pattern).
PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|"
           rf"[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_NEVER = np.int64(1) << 40


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    return out | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Bpe:
    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"] if a["special"]}
        self.split_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = regex.compile(PATTERN)
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        for text, i in vocab.items():
            self.token_bytes[i] = text.encode("utf-8") if text in self.special else bytes(alphabet[c] for c in text)
        for text, i in self.special.items():
            self.token_bytes[i] = text.encode("utf-8")
        self.id_text = [str(i) for i in range(size)]
        self.byte_id = [vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]

        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.rank = np.full(size, -1, np.int64)       # of the merge that makes a token; -1: a byte
        self.rank[made] = np.arange(len(merges))
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        self.left[made], self.right[made] = left, right
        self.size = size
        keys = left * size + right
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order
        self.merge_of = {(int(a), int(b)): (k, int(t)) for k, (a, b, t) in enumerate(zip(left, right, made))}
        self.made_by = made
        ranks = np.arange(len(merges))
        self.ordered = bool((self.rank[left] < ranks).all() and (self.rank[right] < ranks).all()
                            and len(np.unique(made)) == len(made))
        # a token is proposed when its own bytes merge to it: its two parts' boundary holds until its merge, and so do its parts'
        whole = np.zeros(size, bool)
        whole[self.byte_id] = True
        if self.ordered:
            holds = self.compatible(left, right, ranks)
            for a, b, t, ok in zip(left, right, made, holds):
                whole[t] = ok and whole[a] and whole[b]
        self.proposed = {self.token_bytes[i]: i for i in np.flatnonzero(whole)}
        self._make_trie()
        # word -> its ids as 32-bit integers (bytes take a fifth of a tuple's memory)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _make_trie(self) -> None:
        """Sorted keys (node * 256 + byte) with the next node, and each node's token (-1: none)."""
        nodes, steps, token = {b"": 0}, {}, [-1]
        for t, i in self.proposed.items():
            node = 0
            for k in range(len(t)):
                prefix = t[:k + 1]
                below = nodes.get(prefix)
                if below is None:
                    below = nodes[prefix] = len(token)
                    token.append(-1)
                    steps[node * 256 + t[k]] = below
                node = below
            token[node] = int(i)
        self.trie_keys = np.array(sorted(steps), np.int64)
        self.trie_next = np.array([steps[k] for k in self.trie_keys.tolist()], np.int64)
        self.trie_token = np.array(token, np.int64)

    # ---- verification ---------------------------------------------------------------
    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NEVER)

    def compatible(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether each boundary (a, b) survives all merges before rank ``until`` (default: all)."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(x), _NEVER - 1) if until is None else until.astype(np.int64)
        x_until, y_until = limit.copy(), limit.copy()
        # at equal rank the left merge goes first, so a crossing one beats y's own merge but not x's
        y_first = np.zeros(len(x), np.int64)
        ok = np.ones(len(x), bool)
        live = np.arange(len(x))
        while len(live):
            cross = self._pair_rank(x[live], y[live])
            broken = (cross < x_until[live]) & (cross < y_until[live] + y_first[live])
            ok[live[broken]] = False
            rx, ry = self.rank[x[live]], self.rank[y[live]]
            go = ~broken & ((rx >= 0) | (ry >= 0))
            live, rx, ry = live[go], rx[go], ry[go]
            down = rx > ry
            l, r = live[down], live[~down]
            x_until[l] = rx[down]
            x[l] = self.right[x[l]]
            y_until[r] = ry[~down]
            y_first[r] = 1
            y[r] = self.left[y[r]]
        return ok

    # ---- encoding -----------------------------------------------------------------
    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of many words at once: (word of each token, token), in order.

        All words walk the trie of the vocabulary byte by byte; a word whose walk
        ends emits the longest token it passed and starts again behind it.
        """
        buffer = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size)
        word = np.flatnonzero(size)
        at = (end - size)[word]
        stop, start, best, token = end[word], at.copy(), at.copy(), np.zeros(len(word), np.int64)
        node = np.zeros(len(word), np.int64)
        found = []
        while len(word):
            key = node * 256 + buffer[at]
            k = np.minimum(np.searchsorted(self.trie_keys, key), len(self.trie_keys) - 1)
            on = (self.trie_keys[k] == key) & (at < stop)
            node = np.where(on, self.trie_next[k], node)
            at = at + on
            seen = np.where(on, self.trie_token[node], -1)
            token, best = np.where(seen >= 0, seen, token), np.where(seen >= 0, at, best)
            done = np.flatnonzero(~on)
            if len(done):
                found.append((word[done], start[done], token[done]))
                at[done] = start[done] = best[done]
                node[done] = 0
                live = at < stop
                live |= on
                if not live.all():
                    word, at, stop, start, best, token, node = (v[live] for v in (word, at, stop, start, best, token, node))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, start, token = (np.concatenate(v) for v in zip(*found))
        order = np.argsort(start, kind="stable")
        return owner[order], token[order]

    def merge(self, words: list[bytes]) -> list[list[int]]:
        """Exact: apply the lowest-ranked merge, leftmost first, until none applies."""
        out: list = [None] * len(words)
        by_size = sorted(range(len(words)), key=lambda k: len(words[k]))
        short = [k for k in by_size if len(words[k]) <= SHORT]
        for lo in range(0, len(short), 2048):  # neighbours have similar lengths
            some = short[lo:lo + 2048]
            for k, ids in zip(some, self._merge_short([words[k] for k in some])):
                out[k] = ids
        for k in by_size[len(short):]:
            out[k] = self._merge_long(words[k])
        return out

    def _merge_short(self, words: list[bytes]) -> list[list[int]]:
        """Many short words side by side, one merge of each word a round."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        width = max(1, int(size.max()))
        cols = np.arange(width)
        ids = np.full((len(words), width + 1), -1, np.int64)
        ids[:, :width][cols < size[:, None]] = np.array(self.byte_id)[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((len(words), width), _NEVER)
        ranks[:] = self._rank_or_never(ids[:, :-1], ids[:, 1:])
        live = np.arange(len(words))
        while len(live):
            own = ranks[live]
            k = own.argmin(1)
            least = own[np.arange(len(live)), k]
            go = least < _NEVER
            live, k, least, own = live[go], k[go], least[go], own[go]
            if not len(live):
                break
            row, at = np.arange(len(live)), k[:, None]
            new = np.take_along_axis(ids[live], np.minimum(np.arange(width + 1) + (np.arange(width + 1) > at), width), 1)
            new[:, -1] = -1
            new[row, k] = self.made_by[least]
            own = np.take_along_axis(own, np.minimum(cols + (cols >= at), width - 1), 1)
            own[:, -1] = _NEVER
            own[row, k] = self._rank_or_never(new[row, k], new[row, k + 1])
            back = np.flatnonzero(k)
            own[back, k[back] - 1] = self._rank_or_never(new[back, k[back] - 1], new[back, k[back]])
            ids[live], ranks[live] = new, own
        return [r[:r.index(-1)] for r in ids.tolist()]

    def _rank_or_never(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where((a >= 0) & (b >= 0), self._pair_rank(np.maximum(a, 0), np.maximum(b, 0)), _NEVER)

    def _merge_long(self, word: bytes) -> list[int]:
        """With a heap of pairs."""
        ids: list[int] = [self.byte_id[b] for b in word]
        n = len(ids)
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        heap = [(m[0], k, ids[k], ids[k + 1], m[1]) for k in range(n - 1) if (m := self.merge_of.get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, a, b, made = heapq.heappop(heap)
            j = after[k] if ids[k] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[k], ids[j] = made, -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
            for p, q in ((before[k], k), (k, after[k])):
                if p >= 0 and q < n and (m := self.merge_of.get((ids[p], ids[q]))):
                    heapq.heappush(heap, (m[0], p, ids[p], ids[q], m[1]))
        return [i for i in ids if i >= 0]

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of distinct words: proposals, one vectorised check of all pairs, exact merges for the failures."""
        raw = [w.encode("utf-8") for w in words]
        out: list[bytes | None] = [None] * len(raw)
        if self.ordered:
            short = [k for k, w in enumerate(raw) if len(w) <= LONGEST]
            owner, flat = self.propose([raw[k] for k in short])
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, of_pair = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
            fine = self.compatible(pairs // self.size, pairs % self.size)[of_pair]
            failed = np.zeros(len(short), bool)
            failed[owner[inside[~fine]]] = True
            ends = (4 * np.cumsum(np.bincount(owner, minlength=len(short)))).tolist()
            tokens, begin = flat.astype(np.int32).tobytes(), 0
            for k, end, bad in zip(short, ends, failed.tolist()):
                if not bad:
                    out[k] = tokens[begin:end]
                begin = end
        rest = [k for k, t in enumerate(out) if t is None]
        for k, ids in zip(rest, self.merge([raw[k] for k in rest])):
            out[k] = np.array(ids, np.int32).tobytes()
        return dict(zip(words, out))

    def pieces(self, text: str) -> list[str]:
        """Words of a text; special tokens are pieces of their own."""
        if self.split_special is None or not self.split_special.search(text):
            return self.words.findall(text)
        out, at = [], 0
        for m in self.split_special.finditer(text):
            out += self.words.findall(text, at, m.start())
            out.append(m.group())
            at = m.end()
        return out + self.words.findall(text, at)

    def encode_batch(self, texts: list[str], chunk: int = 1_000_000):
        """Ids of each text, some texts at a time (about ``chunk`` characters) so that only their words are held."""
        lo = 0
        while lo < len(texts):
            hi, held = lo, 0
            while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= chunk):
                held += len(texts[hi])
                hi += 1
            split = [self.pieces(t) for t in texts[lo:hi]]
            lo = hi
            need = set(chain.from_iterable(split))
            if len(self.cache) + len(need) > CACHE:  # frequent words come back from the older generation
                self.older, self.cache = self.cache, {}
            new = need - self.cache.keys()
            again = new & self.older.keys()
            self.cache.update((w, self.older.pop(w)) for w in again)
            new -= again
            for s in new & self.special.keys():
                self.cache[s] = np.int32(self.special[s]).tobytes()
                new.discard(s)
            self.cache.update(self.learn(list(new)))
            get = self.cache.__getitem__
            for words in split:
                yield np.frombuffer(b"".join(map(get, words)), np.int32).tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_MODELS: dict[str, Bpe] = {}


def model(path: str) -> Bpe:
    if path not in _MODELS:
        _MODELS[path] = Bpe(path)
    return _MODELS[path]


def with_ids(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """Add the token ids (array<int>)."""
    def kernel(texts):
        return [list(model(path).encode_batch(texts))]

    return append_columns(docs, text_col, [(out, pa.list_(pa.int32()), "array<int>")], kernel)


def with_decoded(ids: DataFrame, path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """Add the text that the ids decode to (null ids: empty)."""
    schema = ids.select("*", F.lit(None).cast("string").alias(out)).schema
    at = ids.columns.index(ids_col)

    def run(batches):
        for b in batches:
            texts = [model(path).decode(i or []) for i in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out])

    return ids.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    def kernel(texts):
        m = model(path)
        n, ids_sha, text_sha = [], [], []
        for ids in m.encode_batch(texts):
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(m.id_text.__getitem__, ids)).encode()).hexdigest())
            text_sha.append(hashlib.sha256(m.decode(ids).encode("utf-8")).hexdigest())
        return [n, ids_sha, text_sha]

    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"), ("decoded_sha256", pa.string(), "string")]
    return append_columns(src, "text", fields, kernel).drop("text")
