"""Code length of documents by prediction by partial matching, and by word counts."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import chunks as C
from barloom.session import cut

ORDER = 5
BITS = 9
END, START = 256, 257
SYMBOLS = 257  # bytes and the end
WORD_END = -1
FOLDS, HELD_OUT = 7, 2
CHUNK_BYTES = 4 * 1024 * 1024
BUCKET_BYTES = 4 * 1024 * 1024
HELD_KEYS = 3_000_000  # that a task sums up before it sends them on
RANGES = 65_536  # that grams are cut into at most; more buckets than that split each range by hash
SAMPLED = 16  # grams per range, to cut the ranges
STEPS = 4096  # a gram's log10 probability is kept in steps of 1 / STEPS
LONG_STEPS = np.iinfo(np.uint16).max  # as many steps or more are kept in 32 bits
SLOTS = 8  # of a hashed table, per key at least
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

COUNTS = "key long, n long"
VALUES = "bucket int, key long, value double"
ASKED = "chunk long, bucket int, keys binary"
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def held_out(doc_id: int | None) -> bool:
    """Whether a document is left out of training; one without an id is not."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def word_key(word: bytes) -> int:
    """A number below WORD_END; words are told apart by 63 bits of a hash, grams are above."""
    return -2 - (xxhash.xxh3_64_intdigest(word) >> 1)


@dataclass(frozen=True)
class Buckets:
    """Grams go to buckets by range, so that a chunk's sorted grams pack well, and by hash within a
    range that is more than one bucket; words go by hash."""

    cuts: np.ndarray
    parts: int
    words: int

    def of(self, keys: np.ndarray) -> np.ndarray:
        mixed, word = keys ^ (keys >> 20), keys < 0
        out = np.searchsorted(self.cuts, keys, side="right") * self.parts
        if self.parts > 1:
            out += np.mod(mixed, self.parts)
        out[word] = (len(self.cuts) + 1) * self.parts + np.mod(mixed[word], self.words)
        return out

    def of_word(self, key: Column) -> Column:
        place = F.pmod(key.bitwiseXOR(F.shiftright(key, 20)), F.lit(self.words))
        return (place + F.lit((len(self.cuts) + 1) * self.parts)).cast("int")


class Sequences:
    """The grams and words of a chunk's lower-cased texts.

    A gram is a byte, or the end of the text, after the ORDER symbols before it; contexts that
    begin before the text are filled with a start symbol.
    """

    def __init__(self, chunk: C.Chunk):
        self.chunk = chunk
        sizes = chunk.ends - chunk.starts
        lower = chunk.text.lower()
        data = np.frombuffer(lower, np.uint8)
        spans = list(zip(chunk.starts.tolist(), chunk.ends.tolist()))
        symbols = np.full(len(lower) + (ORDER + 1) * len(sizes), START, np.int64)
        at = ORDER
        for a, b in spans:
            symbols[at:at + b - a] = data[a:b]
            symbols[at + b - a] = END
            at += b - a + 1 + ORDER
        gram = symbols[: len(symbols) - ORDER].copy()
        for ahead in range(1, ORDER + 1):
            gram <<= BITS
            gram |= symbols[ahead:len(symbols) - ORDER + ahead]
        # A start symbol predicted is no gram; each text gives its bytes and its end.
        self.grams = gram[symbols[ORDER:] != START]
        self.gram_ends = np.cumsum(sizes + 1)
        self.words = [lower[a:b].split() for a, b in spans]
        self.held = [held_out(i) for i in chunk.doc_ids]

    def trained(self) -> np.ndarray:
        """Per gram whether its text is learned from."""
        return np.repeat(~np.array(self.held, bool), np.diff(self.gram_ends, prepend=0))

    def distinct_words(self) -> list[bytes]:
        return list({w for ws in self.words for w in ws})


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order; a sort is faster here than the hashing of `np.unique`."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of grams, with those that are only asked for at 0, and of words; summed in
    the task as far as its memory is bounded."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def flush():
        keys, counts = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 2
        parts.clear()
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        counts = np.add.reduceat(counts, starts) if len(keys) else counts
        return pa.RecordBatch.from_arrays([pa.array(keys[starts]), pa.array(counts)], ["key", "n"])

    for chunk in C.each(batches):
        found = Sequences(chunk)
        train = found.trained()
        grams, n = np.unique(found.grams[train], return_counts=True)
        other = _distinct(found.grams[~train])
        other = other[~_find(grams, other)[1]]
        words: Counter = Counter()
        for ws, held in zip(found.words, found.held):
            if not held:
                words.update(ws)
        texts = len(found.held) - sum(found.held)
        keys = np.fromiter(map(word_key, words), np.int64, len(words))
        counts = np.fromiter(words.values(), np.int64, len(words))
        keys = np.concatenate([grams, other, keys, [WORD_END]])
        parts.append((keys, np.concatenate([n, np.zeros(len(other), np.int64), counts, [texts]])))
        if sum(len(k) for k, _ in parts) > HELD_KEYS:
            yield flush()
    yield flush()


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, counts, len(found)).astype(np.int64)


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in sorted keys, and whether they are there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return place, sorted_keys[place] == keys


def _places(distinct: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key is in the sorted distinct keys, which have it.

    A hashed table of slots finds most; keys that lost their slot to another are searched for.
    """
    shift = np.uint64(64 - int(SLOTS * max(len(distinct), 1)).bit_length())
    slots = np.zeros(1 << (64 - int(shift)), np.int32)
    slots[(distinct.astype(np.uint64) * MULTIPLIER) >> shift] = np.arange(len(distinct), dtype=np.int32)
    places = slots[(keys.astype(np.uint64) * MULTIPLIER) >> shift]
    lost = np.flatnonzero(distinct[places] != keys)
    places[lost] = np.searchsorted(distinct, keys[lost])
    return places


def _low(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & ((1 << BITS * (order + 1)) - 1)


def code_lengths(grams: np.ndarray, counts: np.ndarray, low: np.ndarray, low_counts: np.ndarray) -> np.ndarray:
    """log10 of the probability of each gram's last symbol after its others.

    `grams` share their last two context symbols and are all there are with these; `low`,
    `low_counts` are the counts of order 1 of all grams. The longest context seen in training
    predicts first. A context that has D symbols in T places predicts one seen c times with
    (2 c - 1) / 2 T and escapes with D / 2 T to the next shorter one; symbols the longer context
    has are excluded there, from both T and D. Beyond order 0 all symbols not yet excluded are
    equally likely.
    """
    seen = counts > 0
    tables = {ORDER: (grams[seen], counts[seen])}
    order = np.argsort(tables[ORDER][0])
    tables[ORDER] = tuple(x[order] for x in tables[ORDER])
    for k in range(ORDER - 1, 1, -1):
        tables[k] = _summed(_low(tables[k + 1][0], k), tables[k + 1][1])
    tables[1] = (low, low_counts)
    tables[0] = _summed(_low(low, 0), low_counts)
    contexts = {}
    for k, (keys, n) in tables.items():
        ctx, place, kinds = np.unique(keys >> BITS, return_inverse=True, return_counts=True)
        contexts[k] = (ctx, np.bincount(place, n, len(ctx)), kinds, place)

    out = np.zeros(len(grams))
    open_ = np.arange(len(grams))
    above = np.full(len(grams), -1)  # the context one longer, where training has it
    for k in range(ORDER, -1, -1):
        keys = _low(grams[open_], k)
        ctx, total, kinds, place = contexts[k]
        at, known = _find(ctx, keys >> BITS)
        t, d = total[at] if len(ctx) else np.zeros(len(keys)), kinds[at] if len(ctx) else np.zeros(len(keys))
        if k < ORDER:
            longer, _, longer_kinds, longer_place = contexts[k + 1]
            own = tables[k][1][_find(tables[k][0], _low(tables[k + 1][0], k))[0]] if len(longer) else np.zeros(0)
            excluded = np.append(np.bincount(longer_place, own, len(longer)), 0)
            t = t - excluded[above[open_]]
            d = d - np.append(longer_kinds, 0)[above[open_]]
        live = known & (d > 0)
        cell, hit = _find(tables[k][0], keys)
        hit &= live
        n = tables[k][1][cell] if len(tables[k][0]) else np.zeros(len(keys))
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.log10(np.where(hit, 2 * n - 1, d) / (2 * t))
        out[open_] += np.where(live, step, 0)
        above[open_] = np.where(known, at, -1)
        open_ = open_[~hit]
    out[open_] -= math.log10(max(1, SYMBOLS - len(tables[0][0])))
    return out


def _price(group: pa.Table, low: np.ndarray, low_counts: np.ndarray, buckets: Buckets) -> pa.Table:
    keys, counts = (group.column(c).to_numpy() for c in ("key", "n"))
    return pa.table({"bucket": pa.array(buckets.of(keys), pa.int32()), "key": keys,
                     "value": code_lengths(keys, counts, low, low_counts)})


def _buckets(grams: DataFrame, number: int) -> Buckets:
    """Ranges of about equally many grams, from a bounded sample, which does not touch results."""
    n, ranges = grams.count(), min(number, RANGES)
    some = grams.select("key").sample(min(1.0, SAMPLED * ranges / n), seed=3) if n else grams
    keys = np.sort(some.toArrow().column("key").to_numpy())
    cuts = np.unique(keys[np.arange(1, ranges) * len(keys) // ranges]) if len(keys) else keys
    return Buckets(cuts, -(-number // ranges), number)


def model(chunks: DataFrame, number: int) -> tuple[DataFrame, Buckets, int, int]:
    """(bucket, key, value) for grams and words, the buckets, and the number of training tokens
    and of distinct ones.

    A gram's value is its log10 probability, a word's its training count. Counts are summed by key;
    grams are priced in groups that share their two nearest context symbols. Four of a gram's six
    symbols are free in a group: its size is bounded by 257 ** 4 distinct grams, whatever the size
    of the corpus, and was 2 % of all distinct grams where measured. The counts of order 1, at most
    258 * 257 rows, go to every task.
    """
    counts = cut(chunks.mapInArrow(_count, COUNTS).groupBy("key").agg(F.sum("n").alias("n")), "counts")
    words, grams = counts.where("key < 0 AND n > 0"), counts.where("key >= 0")
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    pair = F.col("key").bitwiseAND(F.lit((1 << 2 * BITS) - 1))
    low = grams.where("n > 0").groupBy(pair.alias("key")).agg(F.sum("n").alias("n")).orderBy("key").toArrow()
    low_keys, low_counts = (low.column(c).to_numpy() for c in ("key", "n"))
    last = F.shiftright("key", BITS).bitwiseAND(F.lit((1 << 2 * BITS) - 1))
    buckets = _buckets(grams, number)
    priced = grams.groupBy(last.alias("last")).applyInArrow(
        lambda group: _price(group, low_keys, low_counts, buckets), VALUES)
    words = words.select(buckets.of_word(F.col("key")).alias("bucket"), "key", F.col("n").cast("double"))
    return priced.unionAll(words), buckets, tokens, distinct


def _ask(batches: Iterable[pa.RecordBatch], buckets: Buckets) -> Iterator[pa.RecordBatch]:
    for chunk in C.each(batches):
        found = Sequences(chunk)
        words = found.distinct_words()
        keys = np.concatenate([np.fromiter(map(word_key, words), np.int64, len(words)), [WORD_END],
                               _distinct(found.grams)])
        rows = [(b, C.squeeze(np.diff(np.sort(keys[at]), prepend=0).tobytes()))
                for b, at in C.grouped(buckets.of(keys))]
        numbers, packed = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk.number] * len(rows), pa.int64()), pa.array(numbers, pa.int32()),
             pa.array(packed, pa.binary())], ["chunk", "bucket", "keys"])


def _keys(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(C.expand(packed), np.int64))


def _steps(prices: np.ndarray) -> bytes:
    """Prices in steps: 16 bits each, then those of LONG_STEPS and more in 32 bits each."""
    steps = np.rint(prices * -STEPS).astype(np.uint32)
    short = np.minimum(steps, LONG_STEPS).astype(np.uint16)
    return short.tobytes() + steps[short == LONG_STEPS].tobytes()


def _prices(data: bytes, n: int, at: int) -> np.ndarray:
    """The n prices packed from place `at` on."""
    steps = np.frombuffer(data, np.uint16, n, at).astype(np.int64)
    steps[steps == LONG_STEPS] = np.frombuffer(data, np.uint32, -1, at + 2 * n) if at + 2 * n < len(data) else 0
    return steps / -STEPS


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """The keys of each chunk again with their values: counts of words as integers, then prices."""
    keys, values = known.column("key").to_numpy(), known.column("value").to_numpy()
    order = np.argsort(keys)
    keys, values = keys[order], values[order]
    out = []
    for packed in asked.column("keys").to_pylist():
        own = _keys(packed)
        place, there = _find(keys, own)
        value = np.where(there, values[place] if len(keys) else 0.0, 0.0)
        words = int(np.searchsorted(own, 0))
        out.append(C.squeeze(value[:words].astype(np.int64).tobytes() + _steps(value[words:])))
    return asked.select(["chunk", "bucket"]).append_column("keys", pa.array(out, pa.binary()))


def _score(left: pa.Table, right: pa.Table, buckets: Buckets, tokens: int, distinct: int) -> pa.Table:
    rows = []
    if left.num_rows:
        found = Sequences(C.Chunk(left))
        words = found.distinct_words()
        word_keys = np.fromiter(map(word_key, words), np.int64, len(words))
        grams = _distinct(found.grams)
        place = _places(grams, found.grams)
        every = np.concatenate([word_keys, [WORD_END], grams])
        values = np.zeros(len(every))
        answers = dict(zip(right.column("bucket").to_pylist(), right.column("keys").to_pylist()))
        for bucket, at in C.grouped(buckets.of(every)):
            at = at[np.argsort(every[at])]
            n, data = int(np.searchsorted(every[at], 0)), C.expand(answers[bucket])
            values[at[:n]] = np.frombuffer(data, np.int64, n)
            values[at[n:]] = _prices(data, len(at) - n, 8 * n)
        ends = found.gram_ends
        total = np.add.reduceat(values[len(words) + 1:][place], np.concatenate([[0], ends[:-1]]))
        # The end of a text is one more token of it.
        place = dict(zip([*words, None], range(len(words) + 1)))
        sizes = np.array([len(ws) + 1 for ws in found.words], np.int64)
        flat = chain.from_iterable((*ws, None) for ws in found.words)
        ids = np.fromiter(map(place.__getitem__, flat), np.int64, sizes.sum())
        starts, counts = np.cumsum(sizes) - sizes, values[:len(words) + 1]
        known = np.add.reduceat((counts > 0).astype(np.int64)[ids], starts).tolist()
        base = np.add.reduceat(np.log10(counts + 1)[ids], starts) - sizes * math.log10(tokens + distinct + 1)
        rows = list(zip(found.chunk.doc_ids, found.held, sizes.tolist(), known, [tokens] * len(sizes),
                        base.tolist(), total.tolist()))
    columns = zip(*rows) if rows else [()] * 7
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Learned from the rows whose crc32 of the id modulo 7 is not 2, all of them. `base_score` adds
    up log10((c + 1) / (N + V + 1)) over words and one end per text; `score` is the log10
    probability of the lower-cased text's bytes and its end under the byte model, of ORDER context
    bytes. A null text is empty; a row without an id is learned from; repeated rows are learned
    from as often as they occur. Chunks ask buckets for the values of their distinct grams and
    words, so nothing that grows with the corpus is broadcast, and chunk and bucket sizes do not
    touch the result.
    """
    chunks = C.pack(docs, chunk_bytes)
    size = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    values, buckets, tokens, distinct = model(chunks, max(1, math.ceil(size / bucket_bytes)))
    asked = chunks.mapInArrow(partial(_ask, buckets=buckets), ASKED)
    answered = asked.groupBy("bucket").cogroup(values.groupBy("bucket")).applyInArrow(_answer, ASKED)
    return chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(
        lambda left, right: _score(left, right, buckets, tokens, distinct), RESULT)
