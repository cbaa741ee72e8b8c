"""Language-model scoring by deleted interpolation of a bigram, a unigram and a uniform model.

The estimates are maximum-likelihood counts of the training texts.  How they are mixed depends on how often the context (the word
before) was seen: contexts fall in buckets of doubling frequency, and each bucket has mixture weights, learned by
expectation-maximisation on counts of training texts that were held back from the counts used there.

Texts are first turned into batches (a staged table): the distinct words' hashes, and the texts as local word numbers.  Each batch
sends its distinct words and word pairs, not its tokens, to the shard that counts them, and gets their counts back; so what moves
is pre-aggregated, a frequent word is one entry of each batch, and no count table is broadcast or collected.  Words and pairs
are counted by 48 bits of a 64-bit hash within a shard, the shard taking the others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import eased, id_crc, ids_of, mix, odd_numbers, relax, shards_for, slices, stage, texts_of

END = np.uint64(0x454E44)
FACTORS = odd_numbers(2, 77)
LOW = np.uint64((1 << 48) - 1)
COUNTED, TUNED, OTHER = 0, 1, 2  # what a batch's texts are for: counts; weights, then counts too; scores only
STEP = 4  # parts of an octave that ratios of estimates are rounded to for learning weights
BUCKETS = 25
BATCHES = "batch bigint, role int, ids array<bigint>, lengths binary, words binary, tokens binary"


def _squeeze(a: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as byte planes of their differences: planes of high bytes are zeros, which compress away."""
    d = np.diff(a, prepend=np.uint64(0))
    return np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes()


def _spread(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


class Buffer:
    """Texts of one role on their way to a batch."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.texts: list[bytes] = []
        self.size = 0

    def add(self, ids: list[int | None], texts: list[bytes]) -> None:
        self.ids += ids
        self.texts += [t.lower() for t in texts]
        self.size += sum(map(len, texts)) + 16 * len(texts)

    def flush(self, batch: int, role: int) -> pa.RecordBatch:
        split = pc.ascii_split_whitespace(pa.array(self.texts, pa.binary()).cast(pa.large_binary()).view(pa.large_string()))
        words = split.flatten()
        real = np.asarray(pc.greater(pc.binary_length(words), 0))
        edges = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(split), dtype=np.int64))])
        kept = np.concatenate([[0], np.cumsum(real)])
        lengths = kept[edges[1:]] - kept[edges[:-1]] + 1
        coded = words.filter(pa.array(real)).dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()] + [int(END)], np.uint64)
        own, number = np.unique(mix(hashes), return_inverse=True)
        tokens = np.full(int(lengths.sum()), number[-1], np.uint32)
        inside = np.ones(len(tokens), bool)
        inside[np.cumsum(lengths) - 1] = False
        tokens[inside] = number[np.asarray(coded.indices, dtype=np.int64)]
        row = [pa.array([batch], pa.int64()), pa.array([role], pa.int32()), pa.array([self.ids], pa.list_(pa.int64())), pa.array([lengths.astype("<u4").tobytes()], pa.binary()), pa.array([_squeeze(own)], pa.binary()), pa.array([tokens.astype("<u4").tobytes()], pa.binary())]
        self.__init__()
        return pa.RecordBatch.from_arrays(row, ["batch", "role", "ids", "lengths", "words", "tokens"])


def _make_batches(trains, tunes, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers, made = [Buffer(), Buffer(), Buffer()], TaskContext.get().partitionId() << 32
        for b in slices(batches):
            ids, texts = ids_of(b).to_pylist(), texts_of(b)
            crc = id_crc(ids)
            role = [OTHER if not trains(c) else TUNED if tunes(c) else COUNTED for c in crc]
            for k, buffer in enumerate(buffers):
                at = [i for i, r in enumerate(role) if r == k]
                buffer.add([ids[i] for i in at], [texts[i] for i in at])
                if buffer.size >= limit:
                    yield buffer.flush(made, k)
                    made += 1
        for k, buffer in enumerate(buffers):
            if buffer.ids:
                yield buffer.flush(made, k)
                made += 1

    return run


class Grams:
    """A batch's distinct words and word pairs by shard and key, and each token's place among them."""

    def __init__(self, words: bytes, tokens: bytes, lengths: bytes, shards: int):
        self.words = _spread(words)
        self.tokens = np.frombuffer(tokens, "<u4").astype(np.int64)
        self.lengths = np.frombuffer(lengths, "<u4").astype(np.int64)
        end = int(np.searchsorted(self.words, mix(np.array([END]))[0]))
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[:1] = end  # the end of one text is the context of the next one's first word
        self.before = before
        pairs, pair_of = np.unique((before << 32) | self.tokens, return_inverse=True)
        keys = mix(self.words[pairs >> 32] * FACTORS[0] + self.words[pairs & 0xFFFFFFFF] * FACTORS[1])
        self.word = self._place(mix(self.words + FACTORS[0]), self.tokens, shards)
        self.pair = self._place(keys, pair_of, shards)

    @staticmethod
    def _place(keys: np.ndarray, of: np.ndarray, shards: int):
        shard, low = (keys >> np.uint64(48)) % np.uint64(shards), keys & LOW
        order = np.lexsort((low, shard))
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        edges = np.searchsorted(shard[order], np.arange(shards + 1, dtype=np.uint64))
        return low[order], edges, place[of], np.bincount(place[of], minlength=len(keys)), place


def _send(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in eased(batches):
            for batch, role, _, lengths, words, tokens in zip(*[b.column(k).to_pylist() if k != 2 else [None] * b.num_rows for k in range(6)]):
                g = Grams(words, tokens, lengths, shards)
                cols = [[] for _ in range(4)]
                for k, (low, edges, _, counts, _) in enumerate((g.word, g.pair)):
                    for s in range(shards):
                        part = slice(edges[s], edges[s + 1])
                        cols[2 * k].append(_squeeze(low[part]))
                        cols[2 * k + 1].append(counts[part].astype("<u4").tobytes() if role != OTHER else b"")
                yield pa.RecordBatch.from_arrays([pa.array(range(shards), pa.int32()), pa.array([batch] * shards, pa.int64()), pa.array([role] * shards, pa.int32()), *[pa.array(c, pa.binary()) for c in cols]], ["shard", "batch", "role", "w", "nw", "p", "np"])

    return run


def _count(table: pa.Table) -> pa.Table:
    """Counts of one shard: for each batch those of its words and pairs over all training texts, and (tuned batches) over the counted ones alone.  One row of batch -1 has the numbers of distinct words of both kinds."""
    batches, roles = table.column("batch").to_pylist(), table.column("role").to_pylist()
    replies: list[dict] = [{"batch": b} for b in batches]
    known = [0, 0]
    for keys, counts in (("w", "nw"), ("p", "np")):
        parts = [_spread(x) for x in table.column(keys).to_pylist()]
        n = [np.frombuffer(x, "<u4") for x in table.column(counts).to_pylist()]
        own, at = np.unique(np.concatenate(parts), return_inverse=True) if parts else (np.zeros(0), np.zeros(0, np.int64))
        ends = np.cumsum([len(p) for p in parts])
        total = [np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)]
        for e, p, c, r in zip(ends.tolist(), parts, n, roles):
            if r != OTHER:
                total[r][at[e - len(p) : e]] += c
        both = total[0] + total[1]
        if keys == "w":
            known = [int((both > 0).sum()), int((total[0] > 0).sum())]
        for e, p, r, reply in zip(ends.tolist(), parts, roles, replies):
            mine = at[e - len(p) : e]
            reply[keys] = both[mine].astype("<u4").tobytes()
            reply[f"a{keys}"] = total[0][mine].astype("<u4").tobytes() if r == TUNED else None
    shard = table.column("shard")[0].as_py()
    replies.append({"batch": -1, "w": np.array(known, "<u8").tobytes(), "p": b"", "aw": None, "ap": None})
    relax()
    schema = pa.schema([("batch", pa.int64()), ("shard", pa.int32()), ("w", pa.binary()), ("p", pa.binary()), ("aw", pa.binary()), ("ap", pa.binary())])
    return pa.Table.from_pylist([{**r, "shard": shard} for r in replies], schema=schema)


def _bucket(c: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, then one bucket for each doubling."""
    return np.minimum(np.where(c > 0, np.floor(np.log2(np.maximum(c, 1))).astype(np.int64) + 1, 0), BUCKETS - 1)


def _estimates(g: Grams, words: np.ndarray, pairs: np.ndarray, total: int, distinct: int):
    """Each token's context count, and its bigram, unigram and uniform estimates, from counts by place."""
    of_word, place = g.word[2], g.word[4]
    context = words[place[g.before]]
    return context, np.where(context > 0, pairs[g.pair[2]] / np.maximum(context, 1), 0.0), words[of_word] / max(total, 1), 1.0 / (distinct + 1)


def _gathered(parts: list[dict], key: str) -> np.ndarray:
    return np.concatenate([np.frombuffer(x[key] or b"", "<u4") for x in sorted(parts, key=lambda x: x["shard"])]).astype(np.int64)


def _histogram(shards: int, total: int, distinct: int):
    """Of tuned batches: how many tokens have each bucket and rounded pair of ratios to the uniform estimate."""

    def ratio(p: np.ndarray, uniform: float) -> np.ndarray:
        return np.where(p > 0, np.clip(np.rint(STEP * np.log2(np.maximum(p, 1e-300) / uniform)), -200, 300).astype(np.int64) + 201, 0)

    def run(batches):
        for b in eased(batches):
            for lengths, words, tokens, parts in zip(*[ids_of(b, k).to_pylist() for k in ("lengths", "words", "tokens", "parts")]):
                g = Grams(words, tokens, lengths, shards)
                context, two, one, uniform = _estimates(g, _gathered(parts, "aw"), _gathered(parts, "ap"), total, distinct)
                cell, n = np.unique((_bucket(context) << 20) | (ratio(two, uniform) << 10) | ratio(one, uniform), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n)], ["cell", "n"])

    return run


def learn_weights(cells: np.ndarray, n: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Weights of bigram, unigram and uniform for each bucket, by expectation-maximisation; a bucket without held-back tokens takes its lower neighbour's."""
    value = lambda x: np.where(x > 0, np.exp2((x - 201) / STEP), 0.0)
    bucket, p = cells >> 20, np.stack([value((cells >> 10) & 1023), value(cells & 1023), np.ones(len(cells))], 1)
    out = np.zeros((BUCKETS, 3))
    last = np.array([0.0, 0.9, 0.1])
    for k in range(BUCKETS):
        on = bucket == k
        if on.any():
            w = np.array([1 / 3, 1 / 3, 1 / 3]) if k else np.array([0.0, 0.5, 0.5])
            for _ in range(rounds):
                share = p[on] * w
                share = share / share.sum(1, keepdims=True) * n[on][:, None]
                w = share.sum(0) / n[on].sum()
            last = np.maximum(w, 1e-6)
            if not k:
                last[0] = 0.0
            last = last / last.sum()
        out[k] = last
        if not k and not on.any():
            last = np.array([0.4, 0.5, 0.1])
    return out


def score(docs: DataFrame, trains=lambda crc: crc % 7 != 2, tunes=lambda crc: crc // 7 % 10 == 0, batch_bytes: int = 6 << 20) -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words between white space, A-Z in lower case, and an end for each text.  `trains` and `tunes` decide by
    the crc32 of doc_id as text: training texts give all counts; those that tune are held back while the weights are learned.
    n_known: tokens seen in training.  base_score: log10 of the add-one unigram estimate, summed.  score: log10 of the interpolated estimate, summed.

    Null text is empty and has the end alone.  Null doc_id counts as the text '' for `trains`.  Repeated rows count and are scored
    each; texts of any length are scored as a whole, by the batch that they fill.  An empty table gives an empty table.  Without training texts all estimates are uniform.  Other columns are not read.
    """
    spark = docs.sparkSession
    shards = shards_for(spark)
    made = stage(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_make_batches(trains, tunes, batch_bytes), BATCHES), "batches")
    counted = made.select("batch", "role", "ids", "lengths", "words", "tokens").mapInArrow(_send(shards), "shard int, batch bigint, role int, w binary, nw binary, p binary, np binary")
    replies = stage(counted.groupBy("shard").applyInArrow(_count, "batch bigint, shard int, w binary, p binary, aw binary, ap binary"), "counts")
    sizes = made.where(F.col("role") != OTHER).groupBy("role").agg(F.sum(F.octet_length("tokens") / 4).cast("bigint").alias("n")).collect()
    tokens = {r["role"]: r["n"] for r in sizes}
    known = [np.frombuffer(r["w"], "<u8") for r in replies.where(F.col("batch") == -1).select("w").collect()]  # one row a shard
    distinct, distinct_counted = (int(sum(k[i] for k in known)) for i in (0, 1))
    total, total_counted = sum(tokens.values()), tokens.get(COUNTED, 0)

    def joined(role, keys: list[str]) -> DataFrame:
        own = replies.where(F.col("batch") >= 0)
        if role is not None:
            own = own.where(F.col("aw").isNotNull())
        own = own.groupBy("batch").agg(F.collect_list(F.struct("shard", *keys)).alias("parts"))  # one part a shard
        return (made if role is None else made.where(F.col("role") == role)).join(own, "batch")

    cells = joined(TUNED, ["aw", "ap"]).select("lengths", "words", "tokens", "parts").mapInArrow(_histogram(shards, total_counted, distinct_counted), "cell bigint, n bigint")
    table = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # bounded by buckets and rounded ratios
    weights = learn_weights(np.asarray(table.column("cell"), dtype=np.int64), np.asarray(table.column("n"), dtype=np.float64))

    def run(batches):
        for b in eased(batches):
            for role, ids, lengths, words, toks, parts in zip(*[ids_of(b, k).to_pylist() for k in ("role", "ids", "lengths", "words", "tokens", "parts")]):
                g = Grams(words, toks, lengths, shards)
                seen = _gathered(parts, "w")
                context, two, one, uniform = _estimates(g, seen, _gathered(parts, "p"), total, distinct)
                w = weights[_bucket(context)]
                p = w[:, 0] * two + w[:, 1] * one + w[:, 2] * uniform
                c = seen[g.word[2]]
                starts = np.cumsum(g.lengths) - g.lengths
                add = lambda x: np.add.reduceat(x, starts)
                base = add(np.log10((c + 1) / (total + distinct + 1)))
                n = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([role == OTHER] * n), pa.array(g.lengths, pa.int64()), pa.array(add((c > 0).astype(np.int64)), pa.int64()), pa.array([total] * n, pa.int64()), pa.array(base, pa.float64()), pa.array(add(np.log10(p)), pa.float64())], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return joined(None, ["w", "p"]).select("role", "ids", "lengths", "words", "tokens", "parts").mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")

