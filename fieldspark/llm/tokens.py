"""Encoding of many texts with one of the public tokenizers, remembering the ids of words.

White space always separates tokens in the word-end vocabulary, so a text's ids are its words' ids in a row, and each batch
encodes its distinct words only.  A word that is Latin letters and then plain punctuation is two pre-tokens, whose pieces are merged here by
the vocabulary's own list, many words at once; every other word goes through the library's whole pipeline.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from fieldspark.llm.common import ranges

ENCODE_BYTES = 12 << 20  # of text whose distinct words are encoded together
LETTERS = "[a-zß-öø-ÿ]"
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"  # ASCII punctuation but for ' and <, which begin contractions and special tokens


def _byte_names() -> dict[int, str]:
    """Byte-level BPE's printable stand-ins for bytes: printable Latin-1 stands for itself, the rest follow from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    names, k = {}, 0
    for b in range(256):
        names[b] = chr(b if b in plain else 256 + k)
        k += b not in plain
    return names


@functools.cache
def _tokenizer(path: str):
    """This worker's tokenizer of a vocabulary file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _strings(column: pa.Array) -> list[str]:
    """The strings of an Arrow column without nulls, by way of NumPy, which makes them several times faster than to_pylist()."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Pool:
    """Ids of strings, one after the other; a string is known by its number."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.starts, self.lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.used = 0

    def numbers(self, strings: list[str], encode) -> np.ndarray:
        """The strings' numbers; encode gives the ids of those that are new."""
        new = [s for s in strings if s not in self.index]
        if new:
            flat, lengths = (np.array(x, t) for x, t in zip(encode(new), (np.uint32, np.int64)))
            base, n = len(self.index), len(new)
            self.ids = self._room(self.ids, self.used + len(flat))
            self.starts, self.lengths = self._room(self.starts, base + n), self._room(self.lengths, base + n)
            self.ids[self.used : self.used + len(flat)] = flat
            self.starts[base : base + n] = self.used + np.cumsum(lengths) - lengths
            self.lengths[base : base + n] = lengths
            self.used += len(flat)
            self.index.update(zip(new, range(base, base + n)))
        return np.fromiter(map(self.index.__getitem__, strings), np.int64, len(strings))

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if n <= len(a) else np.concatenate([a, np.empty(max(n, 2 * len(a)) - len(a), a.dtype)])


class Merges:
    """Byte-pair merges of many pre-tokens at once, each step the leftmost of a row's earliest merges as in the library."""

    NONE = np.iinfo(np.int32).max  # the rank of a pair that isn't merged
    LONGEST = 32  # bytes of a row; longer pre-tokens are left to the library

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str):
        names = _byte_names()
        self.inner = np.array([vocabulary[names[b]] for b in range(256)], np.int32)
        self.last = np.array([vocabulary[names[b] + suffix] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([vocabulary[p[k]] for p in pairs], np.int64) for k in (0, 1))
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, self.NONE, np.int32)
        key = left << 32 | right
        _, first = np.unique(key[::-1], return_index=True)  # of a pair listed twice the later rank counts, as in the library
        todo, rank = key[len(key) - 1 - first], len(key) - 1 - first
        at = self._slot(todo)
        while len(todo):  # each key goes to the first free slot from its own on
            free = np.flatnonzero(self.keys[at] < 0)
            self.keys[at[free]], self.ranks[at[free]] = todo[free], rank[free]
            out = self.keys[at] != todo
            todo, rank, at = todo[out], rank[out], (at[out] + 1) & ((1 << self.bits) - 1)

    @classmethod
    @functools.cache
    def of(cls, path: str) -> Merges | None:
        """The merges of a vocabulary file, or None if its model has more rules than these."""
        model = json.loads(_tokenizer(path).to_str())["model"]
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "ignore_merges"))
        try:
            return cls(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "") if plain else None
        except KeyError:  # not all bytes are in the vocabulary
            return None

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        found = self.keys.take(at)
        out = np.where(found == key, self.ranks.take(at), self.NONE)
        more = np.flatnonzero((found != key) & (found >= 0))
        while len(more):
            at[more] = (at[more] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[more]]
            same = found == key[more]
            out[more[same]] = self.ranks[at[more[same]]]
            more = more[~same & (found >= 0)]
        return out

    def ids(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, all in a row, and their numbers, of pre-tokens of `sizes` bytes each, up to LONGEST."""
        starts, counts = np.cumsum(sizes) - sizes, np.zeros(len(sizes), np.int64)
        parts = []
        for lo, hi in ((0, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, self.LONGEST)):
            rows = np.flatnonzero((sizes > lo) & (sizes <= hi))
            for k in range(0, len(rows), 1 << 13):  # so many rows stay in the processor's cache
                parts += self._merged(raw, starts, sizes, rows[k : k + (1 << 13)], hi)
        for rows, _, n in parts:
            counts[rows] = n
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.uint32)
        for rows, symbols, n in parts:
            at = starts[rows]
            for k in range(int(n.max())):
                on = np.flatnonzero(n > k)
                out[at[on] + k] = symbols[k, on]
        return out, counts

    def _merged(self, raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows, their symbols one below the other, and numbers of these, as they are done."""
        cols, n = np.arange(width, dtype=np.int32)[:, None], sizes[rows].astype(np.int32)
        own = raw.take(starts[rows] + cols, mode="clip")
        symbols = np.where(cols == n - 1, self.last.take(own), self.inner.take(own))
        order = np.full((width, len(rows)), self.NONE, np.int32)  # of each symbol with the next one: the pair's rank, then its place
        for k in range(width - 1):
            has = np.flatnonzero(n > k + 1)
            order[k, has] = self._order(symbols[k, has], symbols[k + 1, has], k)
        parts = []
        while len(rows):
            least = order.min(axis=0)
            on = np.flatnonzero(least < self.NONE)
            if 4 * len(on) < 3 * len(rows):
                done = np.flatnonzero(least == self.NONE)
                parts.append((rows[done], symbols[:, done], n[done]))
                rows, symbols, n, order, least = rows[on], symbols[:, on], n[on], order[:, on], least[on]
                on = np.arange(len(rows))
            at = np.where(least < self.NONE, least & 31, width)
            after = cols[:-1] > at
            np.copyto(symbols[:-1], symbols[1:], where=after)
            np.copyto(order[:-1], order[1:] - (order[1:] < self.NONE), where=after)
            n[on] -= 1
            at = at[on]
            symbols[at, on] = new = self.made.take(least[on] >> 5)
            order[at, on] = self.NONE
            has = np.flatnonzero(at < n[on] - 1)
            x, y = at[has], on[has]
            order[x, y] = self._order(new[has], symbols[x + 1, y], x)
            has = np.flatnonzero(at)
            x, y = at[has] - 1, on[has]
            order[x, y] = self._order(symbols[x, y], new[has], x)
        return parts

    def _order(self, left: np.ndarray, right: np.ndarray, at: np.ndarray | int) -> np.ndarray:
        rank = self._rank(left, right)
        return np.where(rank < self.NONE, rank << 5 | at, self.NONE)


class Encoder:
    """Ids of texts; remembers up to about `limit` words, then starts anew.  Neighbouring texts may bring as many new words as they have before it does."""

    def __init__(self, path: str, limit: int = 300_000):
        self.tokenizer, self.merges = _tokenizer(path), Merges.of(path)
        self.limit, self.names = limit, _byte_names()
        self.pool = Pool()

    @classmethod
    @functools.cache
    def shared(cls, path: str) -> Encoder:
        """This worker's encoder, whose words outlive a task; ease() at the task's end keeps them within the limit."""
        return cls(path)

    def ease(self) -> None:
        """Forget all words, if there are more than the limit."""
        if len(self.pool.index) > self.limit:
            self.pool = Pool()

    def _parts(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray] | tuple[list[int], list[int]]:
        """Ids, all in a row, and their numbers, of single pre-tokens: lower-case Latin letters, or marks."""
        column = pa.array(strings, pa.string())
        sizes = np.asarray(pc.binary_length(column), dtype=np.int64)
        if self.merges is None or not len(sizes) or sizes.max() > Merges.LONGEST:
            if self.merges is None or len(strings) < 2:
                return self._tokenized(strings)
            long = sizes > Merges.LONGEST  # these alone one by one
            (flat, n), (apart, own) = self._parts([s for s, x in zip(strings, long.tolist()) if not x]), self._tokenized([s for s, x in zip(strings, long.tolist()) if x])
            lengths = np.empty(len(strings), np.int64)
            lengths[~long], lengths[long] = n, own
            out, of = np.empty(int(lengths.sum()), np.uint32), np.repeat(long, lengths)
            out[~of], out[of] = flat, apart
            return out, lengths
        return self.merges.ids(np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(1, np.uint8), sizes)

    def _tokenized(self, strings: list[str]) -> tuple[list[int], list[int]]:
        """The same by the library's model, one by one."""
        tokenize, flat, lengths = self.tokenizer.model.tokenize, [], []
        for s in strings:
            got = tokenize(s if s.isascii() else s.encode().decode("latin-1").translate(self.names)) if s else ()
            flat += [t.id for t in got]
            lengths.append(len(got))
        return flat, lengths

    def _whole(self, strings: list[str]) -> tuple[list[int], list[int]]:
        """The same of any words; a space before them keeps their numbers apart from those of parts."""
        got = [e.ids for e in self.tokenizer.encode_batch([s[1:] for s in strings], add_special_tokens=False)]
        return [x for ids in got for x in ids], [len(ids) for ids in got]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of each distinct word's two parts (of the whole word and of nothing, if it isn't plain)."""
        lower = pc.utf8_lower(words)
        stem = pc.utf8_rtrim(lower, characters=MARKS)
        # letters whose lower case has another length (such as a dotted capital I) aren't plain
        same = pc.equal(pc.binary_length(lower), pc.binary_length(words))
        plain = np.asarray(pc.and_(pc.match_substring_regex(stem, f"^{LETTERS}*$"), same))
        first = np.zeros(len(words), np.int64)
        stems = stem.filter(pa.array(plain)).dictionary_encode()
        first[plain] = self.pool.numbers(_strings(stems.dictionary), self._parts)[np.asarray(stems.indices)]
        ended = np.flatnonzero(plain & np.asarray(pc.less(pc.binary_length(stem), pc.binary_length(lower))))
        # what comes after the stem; there are few of them
        tails = pc.replace_substring_regex(lower.take(pa.array(ended)), f"^{LETTERS}*", "").dictionary_encode()
        nothing = self.pool.numbers([""], self._parts)[0]
        second = np.full(len(words), nothing, np.int64)
        second[ended] = self.pool.numbers(_strings(tails.dictionary), self._parts)[np.asarray(tails.indices)]
        rest = np.flatnonzero(~plain)
        if len(rest):
            first[rest] = self.pool.numbers([" " + w for w in _strings(words.take(pa.array(rest)))], self._whole)
        return first, second

    def encode(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text's followed by `end`, and the number of ids of each text."""
        self.ease()
        try:
            column = pa.array(texts, pa.binary()).cast(pa.string())
        except pa.ArrowInvalid:  # bytes that aren't UTF-8
            column = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
        words = pc.ascii_split_whitespace(column)
        counts = np.asarray(pc.list_value_length(words), dtype=np.int64)
        flat = words.flatten().dictionary_encode()
        first, second = self._words(flat.dictionary) if len(flat) else (np.zeros(0, np.int64),) * 2
        edges = np.concatenate([[0], np.cumsum(counts)])
        at, parts, sizes = np.asarray(flat.indices), [], []
        step = 1 << 18  # words turned into ids at once, unless one text has more
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + step, side="right")) - 1)
            ids, n = self._ids(first, second, at[edges[lo] : edges[hi]], counts[lo:hi], end)
            parts.append(ids)
            sizes.append(n)
            lo = hi
        return (np.concatenate(parts), np.concatenate(sizes)) if parts else (np.empty(0, np.uint32), np.empty(0, np.int64))

    def _ids(self, first: np.ndarray, second: np.ndarray, at: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as distinct words' places, and the number of ids of each text."""
        number = np.stack([first[at], second[at]], 1).ravel()  # two parts of each word in turn
        lengths = self.pool.lengths[number]
        total = np.concatenate([[0], np.cumsum(lengths)])
        edges = 2 * np.concatenate([[0], np.cumsum(counts)])
        sizes = total[edges[1:]] - total[edges[:-1]] + 1
        out = np.empty(int(sizes.sum()), np.uint32)
        ends = np.cumsum(sizes) - 1
        inside = np.ones(len(out), bool)
        inside[ends] = False
        out[ends] = end
        out[inside] = self.pool.ids[ranges(self.pool.starts[number], lengths)]
        return out, sizes
