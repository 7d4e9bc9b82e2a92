"""Benchmark decontamination: CGK embeddings, bit-sampling LSH, exact edit verification."""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial, reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import text as T

EDIT_SHARE = 0.2
TARGET_RECALL = 0.98
SAMPLED = 3
STRETCH = 3
# A walk through n words takes 2 n steps on average; places after its end would tell nothing.
WALKED = 2
SEED_WORDS = 3
# Benchmark words that tasks hold at a time; more items take more passes over the documents.
BLOCK_WORDS = 200_000
WINDOWS_AT_ONCE = 2048
TRIALS = 256  # edited windows per item length
TRIED_FIRST = 32
MAX_REPETITIONS = 512

# A-Z become a-z and ASCII punctuation becomes a space; other bytes stay.
PLAIN = bytes.maketrans(
    (string.ascii_uppercase + string.punctuation).encode(),
    (string.ascii_lowercase + " " * len(string.punctuation)).encode(),
)
SCHEMA = "doc_id long, item_id long, start_word long, end_word long, edits int, similarity double"


def words(text: bytes) -> list[bytes]:
    return text.translate(PLAIN).split()


def allowed(n: int, share: float) -> int:
    return int(n * share + 1e-9)


def edit_distance(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """(edits, end): the least edits that turn `pattern` into a part of `text`, and the end of the
    first such part. Bit-parallel: one integer holds a column of the table."""
    masks: dict[int, int] = {}
    for i, token in enumerate(pattern):
        masks[token] = masks.get(token, 0) | 1 << i
    ones, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    plus, minus, now = ones, 0, len(pattern)
    best = (now, 0)
    for at, token in enumerate(text, 1):
        same = masks.get(token, 0)
        across = (((same & plus) + plus) ^ plus) | same | minus
        grow, shrink = minus | ~(across | plus) & ones, plus & across
        now += bool(grow & top) - bool(shrink & top)
        grow, shrink = grow << 1 & ones, shrink << 1 & ones
        down = same | minus
        plus, minus = shrink | ~(down | grow) & ones, grow & down
        if now < best[0]:
            best = (now, at)
    return best


@dataclass(frozen=True)
class Index:
    """What a task needs of a block of items.

    `vocab` numbers the items' words from 1. `grams` are the items' distinct seeds, word runs of
    `width`; seed g occurs at item and offset `places[starts[g]:starts[g + 1]]`. Repetition r of
    the embedding steps on by the top bit of `mul[r] * word + add[r]`. `tables[r]` maps the
    sampled words of an embedded item (its length and a sum) to items; items of length n are in
    the first `counts[n]` of them. Where no number of repetitions reaches the target recall, all
    windows of that length are verified with the items in `unsampled`.
    """

    ids: list[int | None]
    items: list[np.ndarray]
    vocab: dict[bytes, int]
    share: float
    seeds: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]
    mul: np.ndarray
    add: np.ndarray
    weight: np.ndarray
    sampled: dict[int, np.ndarray]
    counts: dict[int, int]
    tables: list[dict[tuple[int, int], list[int]]]
    unsampled: dict[int, list[int]]


def _seed_words(n: int, share: float) -> int:
    """A run so short that the allowed edits must leave one of an item's runs whole."""
    return max(1, min(SEED_WORDS, n, -(-(n + 1) // (allowed(n, share) + 1)) - 1))


def _keys(ids: np.ndarray, width: int, size: int) -> np.ndarray:
    """A number for each run of `width` ids; size ** 3 stays below 2 ** 63."""
    n = max(len(ids) - width + 1, 0)
    key = ids[:n].astype(np.int64)
    for k in range(1, width):
        key = key * size + ids[k:n + k]
    return key


def _walk(ids: np.ndarray, lengths: np.ndarray, index: Index, repetitions: slice) -> np.ndarray:
    """Sums over the sampled places of the embeddings of some windows, one per repetition.

    A pointer runs through the window and writes the word under it at each step; a random function
    of step and word says whether it moves on. After an edit two pointers fall into step again, so
    few edits change few places. `ids` holds a window per row, padded to the longest.
    """
    mul, add = index.mul[repetitions], index.add[repetitions]
    rows = np.arange(len(ids))[:, None]
    at = np.zeros((len(ids), len(mul)), np.int64)
    sums = np.zeros((len(ids), len(mul)), np.uint64)
    sampled = np.stack([index.sampled[n] for n in lengths.tolist()])[:, repetitions]
    padded = np.concatenate([ids, np.zeros((len(ids), 1), ids.dtype)], axis=1)
    for step in range(STRETCH * int(lengths.max())):
        inside = at < lengths[:, None]
        word = np.where(inside, padded[rows, np.minimum(at, ids.shape[1])] + 1, 0).astype(np.uint64)
        sums += np.where(sampled[:, :, step], word * index.weight[step], 0).astype(np.uint64)
        at += ((word * mul[:, step] + add[:, step]) >> np.uint64(63)).astype(np.int64)
    return sums


def _matrix(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows], np.int64)
    out = np.zeros((len(rows), int(lengths.max())), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.concatenate(rows)
    return out, lengths


def _edited(item: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    out = item.tolist()
    for kind in rng.integers(3, size=edits):
        at = int(rng.integers(len(out)))
        if kind == 0:
            out[at] = 0
        elif kind == 1:
            out.insert(at, 0)
        elif len(out) > 1:
            del out[at]
    return np.array((out + [0] * edits)[: len(item)], np.int64)


def _repetitions(index: Index, target: float) -> dict[int, int]:
    """Per item length the repetitions that find `target` of windows at the edit limit, by trial on
    its items; 0 if MAX_REPETITIONS find fewer."""
    rng = np.random.default_rng(11)
    by_length: dict[int, list[np.ndarray]] = {}
    for item in index.items:
        by_length.setdefault(len(item), []).append(item)
    counts = {}
    for n, items in sorted(by_length.items()):
        tried = [items[i % len(items)] for i in range(TRIALS)]
        edited = [_edited(x, allowed(n, index.share), rng) for x in tried]
        found, low, counts[n] = np.zeros(TRIALS, bool), 0, 0
        while low < MAX_REPETITIONS and not counts[n]:
            some = slice(low, min(2 * low + TRIED_FIRST, MAX_REPETITIONS))
            hits = _walk(*_matrix(tried), index, some) == _walk(*_matrix(edited), index, some)
            hits[:, 0] |= found
            hits = np.logical_or.accumulate(hits, axis=1)
            enough = np.flatnonzero(hits.mean(axis=0) >= target)
            if len(enough):
                counts[n] = low + int(enough[0]) + 1
            found, low = hits[:, -1], some.stop
    return counts


def build(items: list[tuple[int | None, bytes]], share: float = EDIT_SHARE, target: float = TARGET_RECALL) -> Index | None:
    """The index of a block of items; None if none of them has a word."""
    split = [(i, words(t)) for i, t in items]
    split = [(i, w) for i, w in split if w]
    if not split:
        return None
    vocab: dict[bytes, int] = {}
    rows = [np.array([vocab.setdefault(w, len(vocab) + 1) for w in ws], np.int64) for _, ws in split]
    size = len(vocab) + 1
    seeds = []
    for width in range(1, SEED_WORDS + 1):
        own = [i for i, x in enumerate(rows) if _seed_words(len(x), share) == width]
        if own:
            keys = np.concatenate([_keys(rows[i], width, size) for i in own])
            places = np.concatenate(
                [np.stack([np.full(len(rows[i]) - width + 1, i), np.arange(len(rows[i]) - width + 1)], 1)
                 for i in own])
            order = np.argsort(keys, kind="stable")
            grams, starts = np.unique(keys[order], return_index=True)
            seeds.append((width, grams, np.append(starts, len(keys)), places[order]))
    rng = np.random.default_rng(7)
    steps = STRETCH * max(map(len, rows))

    def random(*shape):
        return rng.integers(0, 2**64, shape, np.uint64)

    lengths = sorted({len(x) for x in rows})
    sampled = {n: np.zeros((MAX_REPETITIONS, steps), bool) for n in lengths}
    for n in lengths:
        at = rng.integers(WALKED * n, size=(MAX_REPETITIONS, SAMPLED))
        np.put_along_axis(sampled[n], at, True, axis=1)
    index = Index([i for i, _ in split], rows, vocab, share, seeds, random(MAX_REPETITIONS, steps),
                  random(MAX_REPETITIONS, steps), random(steps) | np.uint64(1), sampled, {}, [], {})
    index.counts.update(_repetitions(index, target))
    index.tables.extend({} for _ in range(max(index.counts.values())))
    for low in range(0, len(rows), WINDOWS_AT_ONCE):
        part = rows[low:low + WINDOWS_AT_ONCE]
        for i, sums in enumerate(_walk(*_matrix(part), index, slice(0, len(index.tables))).tolist(), low):
            n = len(rows[i])
            if not index.counts[n]:
                index.unsampled.setdefault(n, []).append(i)
            for found, value in zip(index.tables[:index.counts[n]], sums):
                found.setdefault((n, value), []).append(i)
    return index


def _windows(ids: np.ndarray, owner: np.ndarray, first: np.ndarray, index: Index) -> np.ndarray:
    """(start, length), each once: item-sized windows on the diagonals of shared seeds.

    Within the edit limit one of an item's seeds is whole, so no match is without a window.
    """
    out = [np.zeros((0, 2), np.int64)]
    lengths = np.array([len(x) for x in index.items])
    for width, grams, starts, places in index.seeds:
        keys = _keys(ids, width, len(index.vocab) + 1)
        found = np.minimum(np.searchsorted(grams, keys), len(grams) - 1)
        hit = np.flatnonzero((grams[found] == keys) & (owner[: len(keys)] == owner[width - 1:][: len(keys)]))
        gram = found[hit]
        n = starts[gram + 1] - starts[gram]
        at = np.repeat(hit, n)
        where = places[np.repeat(starts[gram], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        begin = np.maximum(at - where[:, 1], first[owner[at]])
        out.append(np.stack([begin, lengths[where[:, 0]]], axis=1))
    return np.unique(np.concatenate(out), axis=0)


def find(texts: list[bytes], index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text number, item number, start word, end word, edits) of the best match of each pair."""
    split = [words(t) for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    ids = np.fromiter(map(index.vocab.get, chain.from_iterable(split), repeat(0)), np.int64, sizes.sum())
    if not len(ids):
        return []
    first, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(texts)), sizes)
    windows = _windows(ids, owner, first, index)
    windows = windows[np.argsort(windows[:, 1], kind="stable")]
    candidates = set()
    for low in range(0, len(windows), WINDOWS_AT_ONCE):
        part = windows[low:low + WINDOWS_AT_ONCE]
        doc = owner[part[:, 0]]
        at = part[:, :1] + np.arange(part[:, 1].max())
        inside = at < (first + sizes)[doc][:, None]
        rows = np.where(inside, ids[np.minimum(at, len(ids) - 1)], 0)
        used = max(index.counts[n] for n in np.unique(part[:, 1]).tolist())
        sums = _walk(rows, part[:, 1], index, slice(0, used)).tolist()
        for (begin, n), values in zip(part.tolist(), sums):
            candidates.update((begin, item) for item in index.unsampled.get(n, ()))
            for table, value in zip(index.tables, values):
                for item in table.get((n, value), ()):
                    candidates.add((begin, item))
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for begin, item in sorted(candidates):
        doc, pattern = int(owner[begin]), index.items[item].tolist()
        limit = allowed(len(pattern), index.share)
        low = max(begin - limit, int(first[doc]))
        high = min(begin + len(pattern) + 2 * limit, int(first[doc] + sizes[doc]))
        edits, end = edit_distance(pattern, ids[low:high].tolist())
        if edits <= limit and (edits, low) < best.get((doc, item), (limit + 1,))[:2]:
            size = edit_distance(pattern[::-1], ids[low:low + end][::-1].tolist())[1]
            best[doc, item] = (edits, low + end - size, low + end)
    return [(doc, item, a - int(first[doc]), b - int(first[doc]), edits)
            for (doc, item), (edits, a, b) in best.items()]


def _search(batches: Iterable[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in T.portions(batches):
        found = find(T.raw(batch), index)
        docs = batch.column("doc_id").to_pylist()
        rows = [(docs[d], index.ids[i], a, b, e, 1 - e / len(index.items[i])) for d, i, a, b, e in found]
        columns = zip(*rows) if rows else [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)],
            ["doc_id", "item_id", "start_word", "end_word", "edits", "similarity"])


def _indexes(benchmark: DataFrame, share: float, target: float, block_words: int) -> Iterator[Index]:
    block: list[tuple[int | None, bytes]] = []
    size = 0
    items = benchmark.where("text IS NOT NULL").select(
        F.col("item_id").cast("long"), F.encode("text", "UTF-8")).orderBy("item_id", "text")
    for item, text in items.toLocalIterator():
        block.append((item, bytes(text)))
        size += len(words(block[-1][1]))
        if size >= block_words:
            yield build(block, share, target)
            block, size = [], 0
    if block:
        yield build(block, share, target)


def matches(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE,
            target: float = TARGET_RECALL, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, start_word, end_word, edits, similarity): items found in documents.

    Words are lower-cased runs without ASCII punctuation. An item is in a text when edits of at
    most `share` of its words turn it into a run of the text's words; the run with the fewest
    edits, then the first, is given. Windows of an item's size whose CGK embedding agrees with an
    item's in the sampled places of some repetition are verified; repetitions are as many as find
    `target` of edited items of each length. Where that takes too many, all windows are verified. Windows are looked at where a short word run is shared with an
    item, which loses none. Null and empty texts and items match nothing; items and
    documents without an id are reported under null; repeated rows each give rows.

    The items are the query set: blocks of `block_words` words go to every task, one pass over the
    documents each, so memory does not grow with the benchmark.
    """
    rows = T.texts(docs)
    found = [rows.mapInArrow(partial(_search, index=index), SCHEMA)
             for index in _indexes(benchmark, share, target, block_words) if index]
    if not found:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionAll, found)


def _clean(batches: Iterable[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in T.portions(batches):
        keep = np.ones(batch.num_rows, bool)
        keep[[d for d, *_ in find(T.raw(batch), index)]] = False
        yield batch.filter(pa.array(keep))


def keep_clean(docs: DataFrame, benchmark: DataFrame, share: float = EDIT_SHARE,
               target: float = TARGET_RECALL, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs` in which no benchmark item is found, with all their columns."""
    for index in _indexes(benchmark, share, target, block_words):
        if index:
            docs = docs.mapInArrow(partial(_clean, index=index), docs.schema)
    return docs
