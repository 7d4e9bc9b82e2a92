"""Removal of byte strings that an earlier document has too, by sorting sampled suffixes."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import chunks as C

LENGTH = 50
ANCHOR = 24  # bytes, a multiple of 8
SPAN = LENGTH - ANCHOR + 1
BUCKET_BYTES = 2 * 1024 * 1024
SAMPLED_CHUNKS = 64
SAMPLED_PLACES = 2048
RANGES = 8192  # of leading bytes at most; more buckets than that split each range by anchor
# An anchor in more strings than this is compared by windows, about as many of them to a bucket.
HOT_STRINGS = 16_384
# Strings of an anchor in one chunk from which on they are counted; fewer count as one.
COUNTED = 8
SPREAD = 1 << 30
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)

ASKED = "chunk long, bucket int, keys binary"
SENT = "chunk long, bucket int, packed binary"
SPANS = "chunk long, spans binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
KEPT = "doc_id long, text string, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Buckets:
    """Suffixes go to buckets by range of their leading bytes, and within a range that is more than
    one bucket by a hash of their anchor: equal anchors meet, however many buckets there are."""

    cuts: np.ndarray
    parts: int

    @property
    def number(self) -> int:
        return (len(self.cuts) + 1) * self.parts

    def of(self, lead: np.ndarray, key: np.ndarray) -> np.ndarray:
        part = (key >> np.uint64(8)) % np.uint64(self.parts)
        return np.searchsorted(self.cuts, lead, side="right") * self.parts + part.astype(np.int64)


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at each place as a number."""
    return np.lib.stride_tricks.as_strided(data.view(), (max(len(data) - 7, 0), 8), (1, 1)).copy().view("<u8")[:, 0]


class Suffixes:
    """The suffixes of a chunk that are sorted, and the windows that each stands for.

    A window is a string of LENGTH bytes inside a document. Its anchor is the place in it where a
    run of ANCHOR bytes has the least hash, the first of equals; equal windows have their anchors
    at equal offsets, so windows need only be compared under equal anchors. Consecutive windows
    mostly share one, and a run of `count` windows from `first` on is kept as one entry.
    """

    def __init__(self, chunk: C.Chunk):
        self.chunk = chunk
        self.data = np.frombuffer(chunk.text, np.uint8)
        n = len(self.data) - LENGTH + 1
        if n <= 0:
            self.first = self.count = self.anchor = self.owner = np.zeros(0, np.int64)
            self.key = self.lead = np.zeros(0, np.uint64)
            return
        word = _words(self.data)
        size = n + SPAN - 1
        key = np.zeros(size, np.uint64)
        for i, odd in enumerate(MULTIPLIERS):
            key = (key ^ word[8 * i:8 * i + size]) * odd
            key ^= key >> np.uint64(31)
        bits = np.uint64(int(size).bit_length())
        least = (key >> bits << bits) | np.arange(size, dtype=np.uint64)
        reach = 1
        while reach < SPAN:
            step = min(reach, SPAN - reach)
            least = np.minimum(least[:-step], least[step:])
            reach += step
        at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        inside = np.ones(n + 1, bool)
        for end in chunk.ends[:-1].tolist():
            inside[max(0, end - LENGTH + 1):end] = False
        inside[n:] = False
        change = np.flatnonzero(
            np.concatenate([[True], (at[1:] != at[:-1]) | (inside[1:n] != inside[:n - 1])]))
        stop = np.append(change[1:], n)
        real = inside[change]
        self.first, self.count = change[real], (stop - change)[real]
        self.anchor = at[self.first]
        self.owner = np.searchsorted(chunk.ends, self.first, side="right")
        self.key = key[self.anchor]
        self.lead = word[self.anchor].byteswap()

    def string(self, entry: int) -> bytes:
        """The bytes that an entry's windows cover."""
        first = int(self.first[entry])
        return self.chunk.text[first:first + int(self.count[entry]) + LENGTH - 1]

    def shadowed(self) -> np.ndarray:
        """Entries whose whole string a smaller document of the chunk has at an entry too.

        All their windows go. Only the others are sent, so a passage that very many documents
        share reaches its bucket once per chunk.
        """
        out = np.zeros(len(self.first), bool)
        order = np.argsort(self.key, kind="stable")
        same = self.key[order][1:] == self.key[order][:-1]
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        ids = self.chunk.ids[self.owner]
        least: dict[bytes, int] = {}
        found = [(e, self.string(e), int(ids[e])) for e in np.sort(order[twice]).tolist()]
        for _, string, doc in found:
            if doc < least.get(string, C.NO_ID + 1):
                least[string] = doc
        for entry, string, doc in found:
            out[entry] = least[string] < doc
        return out

    def buckets(self, buckets: Buckets) -> np.ndarray:
        return buckets.of(self.lead, self.key)

    def counted(self, short: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, pairs): the distinct short keys of some entries, and (place of a key, its number
        of different strings) for keys of at least COUNTED."""
        known, place, n = np.unique(short[at], return_inverse=True, return_counts=True)
        many = np.flatnonzero(n[place] >= COUNTED)
        strings: dict[int, set[bytes]] = {}
        for key, entry in zip(place[many].tolist(), at[many].tolist()):
            strings.setdefault(key, set()).add(self.string(entry))
        pairs = [(key, len(found)) for key, found in sorted(strings.items()) if len(found) >= COUNTED]
        return known, np.array(pairs, np.uint32).reshape(-1, 2)

    def windows(self, entry: int) -> Iterator[tuple[int, bytes]]:
        """The place and the bytes of each of an entry's windows."""
        first = int(self.first[entry])
        for start in range(first, first + int(self.count[entry])):
            yield start, self.chunk.text[start:start + LENGTH]


def _sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leading bytes of some suffixes."""
    for chunk in C.each(batches):
        suffixes = Suffixes(chunk)
        chosen = np.argsort(suffixes.key * MULTIPLIERS[0])[:SAMPLED_PLACES]
        lead = suffixes.lead[chosen].view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(lead)], ["lead"])


def splitters(chunks: DataFrame, bucket_bytes: int) -> Buckets:
    """Leading bytes at which ranges begin, from a bounded sample, and the buckets of each range;
    they do not touch results. The number of buckets grows with the text."""
    n, size = chunks.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    buckets = max(1, math.ceil(size / bucket_bytes))
    ranges = min(buckets, RANGES)
    parts = -(-buckets // ranges)
    if ranges < 2:
        return Buckets(np.zeros(0, np.uint64), parts)
    some = chunks.sample(min(1.0, SAMPLED_CHUNKS / n), seed=5) if n > SAMPLED_CHUNKS else chunks
    leads = some.mapInArrow(_sample, "lead long").toArrow().column("lead").to_numpy()
    leads = np.sort(leads.astype(np.int64).view(np.uint64))
    if not len(leads):
        return Buckets(np.zeros(0, np.uint64), parts)
    return Buckets(np.unique(leads[np.arange(1, ranges) * len(leads) // ranges]), parts)


def _short(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(32)).astype(np.uint32)


def _ask(batches: Iterable[pa.RecordBatch], buckets: Buckets) -> Iterator[pa.RecordBatch]:
    """Per bucket the hashed anchors that the chunk has, each once, and the counts of frequent ones."""
    for chunk in C.each(batches):
        suffixes = Suffixes(chunk)
        short = _short(suffixes.key)
        rows = []
        for bucket, at in C.grouped(suffixes.buckets(buckets)):
            known, pairs = suffixes.counted(short, at)
            rows.append((bucket, np.concatenate([[len(known)], known, pairs.ravel()]).astype(np.uint32).tobytes()))
        numbers, keys = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk.number] * len(rows), pa.int64()), pa.array(numbers, pa.int32()),
             pa.array(keys, pa.binary())], ["chunk", "bucket", "keys"])


def _answer(asked: pa.Table, hot_strings: int) -> pa.Table:
    """Per chunk one bit for each of its anchors, whether another chunk has it, and (place, number
    of strings) of those that are hot: every chunk that has a hot anchor is told the same number."""
    raw = [np.frombuffer(k, np.uint32) for k in asked.column("keys").to_pylist()]
    keys = [r[1:1 + r[0]] for r in raw]
    every = np.concatenate(keys)
    found, place, counts = np.unique(every, return_inverse=True, return_counts=True)
    shared = counts[place] > 1
    strings = counts.astype(np.int64)
    for own, r in zip(keys, raw):
        pairs = r[1 + r[0]:].reshape(-1, 2).astype(np.int64)
        np.add.at(strings, np.searchsorted(found, own[pairs[:, 0]]), pairs[:, 1] - 1)
    strings = np.minimum(strings, np.iinfo(np.uint32).max)[place]
    ends = np.cumsum([len(k) for k in keys])[:-1]
    answers = []
    for bits, n in zip(np.split(shared, ends), np.split(strings, ends)):
        hot = np.flatnonzero(n > hot_strings)
        answers.append(np.packbits(bits).tobytes() + np.stack([hot, n[hot]], 1).astype(np.uint32).tobytes())
    return asked.set_column(2, "keys", pa.array(answers, pa.binary()))


def _packed(ids, first, count, offset, strings: bytes) -> bytes:
    parts = (np.array([len(ids)]), ids, first, count, offset)
    return C.squeeze(np.concatenate(parts).astype(np.int64).tobytes() + strings, C.TEXT_LEVEL)


def _send(left: pa.Table, right: pa.Table, buckets: Buckets, hot_strings: int) -> pa.Table:
    """Per bucket the strings around anchors that occur elsewhere, with place and document.

    The strings of a hot anchor go as their single windows, to buckets by a hash of the window:
    equal windows still meet, and no bucket has all strings of the anchor.
    """
    rows: list[tuple[int, bytes]] = []
    spread: dict[int, list[tuple[int, int, int, bytes]]] = {}
    if left.num_rows:
        suffixes = Suffixes(C.Chunk(left))
        short, ids = _short(suffixes.key), suffixes.chunk.ids[suffixes.owner]
        bits = dict(zip(right.column("bucket").to_pylist(), right.column("keys").to_pylist()))
        local = _locally_shared(suffixes)
        keep = ~suffixes.shadowed()
        for bucket, at in C.grouped(suffixes.buckets(buckets)):
            known, place = np.unique(short[at], return_inverse=True)
            size = -(-len(known) // 8)
            elsewhere = np.unpackbits(np.frombuffer(bits[bucket][:size], np.uint8), count=len(known))[place] > 0
            total = np.zeros(len(known), np.int64)
            hot = np.frombuffer(bits[bucket][size:], np.uint32).reshape(-1, 2)
            total[hot[:, 0]] = hot[:, 1]
            total = total[place]
            chosen = keep[at] & (elsewhere | local[at])
            for e, n in zip(at[chosen & (total > 0)].tolist(), total[chosen & (total > 0)].tolist()):
                parts = -(-n * SPAN // hot_strings)
                for start, window in suffixes.windows(e):
                    to = buckets.number + (int(short[e]) + zlib.crc32(window) % parts) % SPREAD
                    spread.setdefault(to, []).append((ids[e], start, suffixes.anchor[e] - start, window))
            at = at[chosen & (total == 0)]
            if len(at):
                strings = b"".join(suffixes.string(e) for e in at.tolist())
                rows.append((bucket, _packed(ids[at], suffixes.first[at], suffixes.count[at],
                                             suffixes.anchor[at] - suffixes.first[at], strings)))
    for bucket, found in spread.items():
        docs, first, offset, windows = zip(*found)
        rows.append((bucket, _packed(docs, first, np.ones(len(found)), offset, b"".join(windows))))
    numbers, packed = zip(*rows) if rows else ((), ())
    number = left.column("chunk")[0].as_py() if left.num_rows else None
    return pa.table({"chunk": pa.array([number] * len(rows), pa.int64()),
                     "bucket": pa.array(numbers, pa.int32()), "packed": pa.array(packed, pa.binary())})


def _locally_shared(suffixes: Suffixes) -> np.ndarray:
    """Entries whose anchor more than one entry of the chunk has."""
    _, place, counts = np.unique(suffixes.key, return_inverse=True, return_counts=True)
    return counts[place] > 1


def equal_windows(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, groups): the windows, by place in `starts`, that equal another, and their group.

    Multikey sort, eight bytes at a time: windows equal so far are sorted by their next bytes, and
    those left alone drop out.
    """
    alive, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    word = _words(data)
    for offset in [*range(0, LENGTH - 7, 8), *([LENGTH - 8] if LENGTH % 8 else [])]:
        own = word[starts[alive] + offset]
        order = np.lexsort((own, group))
        alive, group, own = alive[order], group[order], own[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (own[1:] != own[:-1])])[:len(alive)]
        group = np.cumsum(new) - 1
        kept = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        alive, group = alive[kept], group[kept]
    return alive, group


def _compare(sent: pa.Table) -> pa.Table:
    """Per chunk the byte ranges of its documents that smaller documents have too.

    Entries of one string are one string with the smallest document that has it. Windows are only
    compared where an anchor lies in several strings. Splitters never part equal leading bytes, so
    neighbours across a bucket's ends differ in them and no window's equals lie elsewhere; those of
    a hot anchor's windows all have the bucket of their hash.
    """
    chunk, doc, first, count, strings, offset = [], [], [], [], [], []
    for number, packed in zip(sent.column("chunk").to_pylist(), sent.column("packed").to_pylist()):
        raw = C.expand(packed)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        own = np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n)
        ends = np.cumsum(own[2] + LENGTH - 1) + 8 + 32 * n
        chunk.append(np.full(n, number))
        doc.append(own[0])
        first.append(own[1])
        count.append(own[2])
        offset.append(own[3])
        begin = np.concatenate([[8 + 32 * n], ends[:-1]])
        strings += [raw[a:b] for a, b in zip(begin.tolist(), ends.tolist())]
    chunk, doc, first, count, offset = map(np.concatenate, (chunk, doc, first, count, offset))
    number: dict[bytes, int] = {}
    which = np.fromiter((number.setdefault(s, len(number)) for s in strings), np.int64, len(strings))
    smallest = np.full(len(number), C.NO_ID)
    np.minimum.at(smallest, which, doc)

    # Strings by the bytes at their anchor; those alone with theirs need no comparison.
    at = np.zeros(len(number), np.int64)
    at[which] = offset
    anchors: dict[bytes, int] = {}
    distinct = list(number)
    anchor = np.array([anchors.setdefault(s[o:o + ANCHOR], len(anchors)) for s, o in zip(distinct, at.tolist())])
    crowded = np.flatnonzero(np.bincount(anchor)[anchor] > 1)
    data = np.frombuffer(b"".join(distinct), np.uint8)
    sizes = np.array([len(s) for s in distinct])
    begin, windows = np.cumsum(sizes) - sizes, sizes - LENGTH + 1
    base = np.cumsum(windows) - windows
    least = np.repeat(smallest, windows)
    n = windows[crowded]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    slots = np.repeat(base[crowded], n) + inner
    same, group = equal_windows(data, np.repeat(begin[crowded], n) + inner)
    if len(group):
        low = np.full(int(group.max()) + 1, C.NO_ID)
        np.minimum.at(low, group, least[slots[same]])
        least[slots[same]] = low[group]

    gone_chunk, gone_first, gone_last = [chunk[:0]], [first[:0]], [first[:0]]
    whole = smallest[which] < doc
    gone_chunk.append(chunk[whole])
    gone_first.append(first[whole])
    gone_last.append((first + count)[whole])
    rest = np.flatnonzero(~whole & np.isin(which, crowded))
    n = count[rest]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    gone = least[np.repeat(base[which[rest]], n) + inner] < np.repeat(doc[rest], n)
    owner, inner = np.repeat(rest, n)[gone], inner[gone]
    if len(owner):
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (inner[1:] != inner[:-1] + 1)])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(owner)) - 1
        gone_chunk.append(chunk[owner[head]])
        gone_first.append(first[owner[head]] + inner[head])
        gone_last.append(first[owner[tail]] + inner[tail] + 1)
    chunk, first, last = map(np.concatenate, (gone_chunk, gone_first, gone_last))
    rows = [(c, np.stack([first[p], last[p] + LENGTH - 1]).astype(np.int64).tobytes()) for c, p in C.grouped(chunk)]
    numbers, spans = zip(*rows) if rows else ((), ())
    return pa.table({"chunk": pa.array(numbers, pa.int64()), "spans": pa.array(spans, pa.binary())})


def _covered(left: pa.Table, right: pa.Table) -> tuple[C.Chunk, np.ndarray]:
    chunk = C.Chunk(left)
    suffixes = Suffixes(chunk)
    local = suffixes.shadowed()
    first, last = [suffixes.first[local]], [(suffixes.first + suffixes.count)[local] + LENGTH - 1]
    for spans in right.column("spans").to_pylist():
        a, b = np.frombuffer(spans, np.int64).reshape(2, -1)
        first.append(a)
        last.append(b)
    n = len(chunk.text) + 1
    edge = np.bincount(np.concatenate(first), minlength=n) - np.bincount(np.concatenate(last), minlength=n)
    return chunk, np.cumsum(edge[:-1]) > 0


def _runs(mask: np.ndarray) -> tuple[list[int], list[int]]:
    change = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return change[::2].tolist(), change[1::2].tolist()


def _digest(left: pa.Table, right: pa.Table) -> pa.Table:
    rows = []
    if left.num_rows:
        chunk, gone = _covered(left, right)
        for doc, a, b in zip(chunk.doc_ids, chunk.starts.tolist(), chunk.ends.tolist()):
            starts, ends = _runs(gone[a:b])
            text, kept = chunk.text[a:b], hashlib.sha256()
            for i, j in zip([0, *ends], [*starts, b - a]):
                kept.update(text[i:j])
            rows.append((doc, b - a, sum(ends) - sum(starts), len(starts), kept.hexdigest()))
    columns = zip(*rows) if rows else [()] * 5
    kinds = (*repeat(pa.int64(), 4), pa.string())
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, columns, kinds)})


def _trimmed(left: pa.Table, right: pa.Table) -> pa.Table:
    texts, spans, ids = [], [], []
    if left.num_rows:
        chunk, gone = _covered(left, right)
        ids = chunk.doc_ids
        for a, b in zip(chunk.starts.tolist(), chunk.ends.tolist()):
            starts, ends = _runs(gone[a:b])
            texts.append(b"".join(chunk.text[a + i:a + j] for i, j in zip([0, *ends], [*starts, b - a]))
                         .decode("utf-8", "ignore"))
            spans.append([{"start": i, "end": j} for i, j in zip(starts, ends)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()),
                     "spans": pa.array(spans, kind)})


def sent(chunks: DataFrame, bucket_bytes: int, hot_strings: int = HOT_STRINGS) -> DataFrame:
    """(chunk, bucket, packed): what each bucket has to compare."""
    buckets = splitters(chunks, bucket_bytes)
    asked = chunks.mapInArrow(partial(_ask, buckets=buckets), ASKED)
    answered = asked.groupBy("bucket").applyInArrow(lambda asked: _answer(asked, hot_strings), ASKED)
    return chunks.groupBy("chunk").cogroup(answered.groupBy("chunk")).applyInArrow(
        lambda left, right: _send(left, right, buckets, hot_strings), SENT)


def _removed(docs: DataFrame, chunk_bytes: int, bucket_bytes: int, hot_strings: int):
    """The packed documents and, per chunk, the byte ranges that go, both grouped by chunk."""
    chunks = C.pack(docs, chunk_bytes)
    spans = sent(chunks, bucket_bytes, hot_strings).groupBy("bucket").applyInArrow(_compare, SPANS)
    return chunks.groupBy("chunk"), spans.groupBy("chunk")


def digest(docs: DataFrame, chunk_bytes: int = C.CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
           hot_strings: int = HOT_STRINGS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of `docs`.

    A byte goes if a string of 50 bytes over it also starts in a document of smaller id, judged on
    the input. Texts are UTF-8 bytes, a null text is empty; strings never cross documents. A row
    without an id counts as larger than all ids, and rows of equal or no id take nothing from each
    other. Chunks and buckets bound what a task holds, and an anchor in more than `hot_strings`
    strings is spread over buckets by windows; none of the sizes touches the result. One string
    still comes once per chunk that has it.
    """
    chunks, spans = _removed(docs, chunk_bytes, bucket_bytes, hot_strings)
    return chunks.cogroup(spans).applyInArrow(_digest, RESULT)


def trim(docs: DataFrame, chunk_bytes: int = C.CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES,
         hot_strings: int = HOT_STRINGS) -> DataFrame:
    """(doc_id, text, spans): what is left of each text, and the byte ranges that went. A code
    point that lost some of its bytes goes with them."""
    chunks, spans = _removed(docs, chunk_bytes, bucket_bytes, hot_strings)
    return chunks.cogroup(spans).applyInArrow(_trimmed, KEPT)
