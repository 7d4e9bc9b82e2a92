"""Byte-level BPE encoding and decoding: frequent words from an automaton, the others by merging.

The words that are frequent in the corpus are compiled into a minimal acyclic automaton, which
shares prefixes and suffixes of words. Its arcs carry outputs whose sum along a word is the word's
number, and that number's ids lie beside it. Tasks map the automaton's file into memory, so the
workers of a machine share it, and walk all distinct words of a portion of text at once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from barloom.llm import text as T
from barloom.session import Files, cut, scratch_path

MODEL = "/opt/tokenizers/byte_bpe_50k.json"
# Words of the automaton: the most frequent ones up to a length in bytes. Others are merged.
LEXICON_WORDS = 100_000
LEXICON_LENGTH = 32
# Words up to this length in bytes are merged together, one merge of each at a time.
SHORT = 64
NEVER = np.iinfo(np.int32).max  # the rank of a pair that is not merged
PORTION = 2 * 1024 * 1024
LETTER, NUMBER, SPACE, OTHER = range(4)
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")  # fixed: what may follow an apostrophe


# --- the vocabulary ----------------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file, which holds printable text only:
    printable Latin-1 bytes are themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """The merges by pair of ids (rank, merged id), single bytes' ids, bytes by id, and special
    strings with their ids."""

    merges: dict[tuple[int, int], tuple[int, int]]
    byte_ids: list[int]
    texts: list[bytes]
    special: dict[bytes, int]


def load(model: str = MODEL) -> Vocabulary:
    """Read a byte-level BPE file. Other kinds of file are refused."""
    with open(model, encoding="utf-8") as file:
        data = json.load(file)
    kind, before = data["model"], data["pre_tokenizer"]
    plain = kind["type"] == "BPE" and before["type"] == "ByteLevel" and not before["add_prefix_space"]
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
    if not plain or data["normalizer"] or any(kind.get(o) for o in options) or not before.get("use_regex", True):
        raise ValueError(f"{model} is not a plain byte-level BPE file")
    letters, ids = _byte_letters(), kind["vocab"]
    texts = [b""] * (max([*ids.values(), *(t["id"] for t in data["added_tokens"])]) + 1)
    for token, i in ids.items():
        texts[i] = bytes(letters[c] for c in token)
    special = {}
    for token in data["added_tokens"]:
        if token["lstrip"] or token["rstrip"] or token["single_word"] or token["normalized"]:
            raise ValueError(f"added token {token['content']!r} is not a plain string")
        special[token["content"].encode()] = token["id"]
        texts[token["id"]] = token["content"].encode()
    merges = {}
    for rank, pair in enumerate(kind["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        merges[ids[a], ids[b]] = (rank, ids[a + b])
    byte_ids = [0] * 256
    for letter, byte in letters.items():
        byte_ids[byte] = ids[letter]
    return Vocabulary(merges, byte_ids, texts, special)


def merge(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """The ids of a word: the pair of least rank is merged, the leftmost of equals first, until no
    neighbours can be merged. A heap of pairs keeps long words at n log n."""
    ids: list[int] = [vocabulary.byte_ids[b] for b in word]
    find, n = vocabulary.merges.get, len(ids)
    heap = [(found[0], i, found[1], ids[i], ids[i + 1]) for i in range(n - 1) if (found := find((ids[i], ids[i + 1])))]
    if not heap:
        return ids
    heapq.heapify(heap)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    while heap:
        _, i, merged, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j < 0 or ids[j] != right:
            continue
        ids[i], ids[j] = merged, -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            if found := find((merged, ids[k])):
                heapq.heappush(heap, (found[0], i, found[1], merged, ids[k]))
        h = before[i]
        if h >= 0 and (found := find((ids[h], merged))):
            heapq.heappush(heap, (found[0], h, found[1], ids[h], merged))
    return [i for i in ids if i >= 0]


class Merges:
    """Merges many short words at a time."""

    def __init__(self, vocabulary: Vocabulary):
        self.byte_ids = np.array(vocabulary.byte_ids, np.int64)
        self.size = len(vocabulary.texts)
        # The last entry is never found, so every search ends at a place.
        pairs = np.array([a * self.size + b for a, b in vocabulary.merges] + [self.size**2], np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.ranks = np.array([r for r, _ in vocabulary.merges.values()] + [NEVER], np.int64)[order]
        self.merged = np.array([m for _, m in vocabulary.merges.values()] + [0], np.int64)[order]

    def _found(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs."""
        key = left * self.size + right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.ranks[at], NEVER), self.merged[at]

    def __call__(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in order, and how many each has.

        In each round every word that can be merged has its leftmost pair of least rank merged;
        only the two pairs beside the merged id are looked up anew.
        """
        sizes = np.array([len(w) for w in found], np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(found), np.uint8)]
        word = np.repeat(np.arange(len(found)), sizes)
        rank, merged = np.full(len(ids), NEVER, np.int64), np.zeros(len(ids), np.int64)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside], merged[inside] = self._found(ids[inside], ids[inside + 1])
        done_ids, done_words = [], []
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            lengths = np.diff(np.append(starts, len(ids)))
            least = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            over = least == NEVER
            if over.any():
                done_ids.append(ids[over])
                done_words.append(word[over])
                ids, word, rank, merged, least = (x[~over] for x in (ids, word, rank, merged, least))
                if not len(ids):
                    break
            at = np.flatnonzero(rank == least)
            at = at[np.concatenate([[True], word[at][1:] != word[at][:-1]])]
            ids[at] = merged[at]
            stays = np.ones(len(ids), bool)
            stays[at + 1] = False
            at = at - np.arange(len(at))  # places after the removal
            ids, word, rank, merged = (x[stays] for x in (ids, word, rank, merged))
            rank[at] = NEVER
            for left in (at[at + 1 < len(ids)], at[at > 0] - 1):
                left = left[word[left] == word[left + 1]]
                rank[left], merged[left] = self._found(ids[left], ids[left + 1])
        all_ids, all_words = np.concatenate([[], *done_ids]), np.concatenate([[], *done_words])
        order = np.argsort(all_words, kind="stable")
        counts = np.bincount(all_words.astype(np.int64), minlength=len(found))
        return all_ids[order].astype(np.uint32), counts


@lru_cache(1)
def code_point_classes() -> np.ndarray:
    """Letter, number, white space or other, for each code point, as the library sees it.

    The library's Unicode tables decide; candidates come from newer ones, which hold all of its
    letters and numbers.
    """
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    some = regex.findall(r"[\p{L}\p{N}\s]", everything)
    points = np.array([ord(c) for c in some])
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    out = np.full(0x110000, OTHER, np.uint8)
    alone = np.ones(len(some), bool)
    for kind, side in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
        starts = np.array([s for _, (s, _) in split("".join(f"{side}{c}{side}\n" for c in some))])
        joined = ~np.isin(4 * np.arange(len(some)) + 1, starts)
        out[points[joined]] = kind
        alone &= ~joined
    out[points[alone]] = SPACE
    return out


# --- words of a text ---------------------------------------------------------------------------


def boundaries(text: bytes, classes: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """The starts (in bytes) of the words of `text`, which ends at each of `breaks` and anew there.

    Runs of letters, of numbers and of other characters are words, with the space before them. Of
    white space before such a run all but the last character is a word, and so is the last unless
    it is that space. An apostrophe that begins a word takes the letters of a contraction.
    """
    points = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
    if not len(points):
        return np.zeros(0, np.int64)
    widths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.concatenate([[0], np.cumsum(widths)])
    kind = classes[points]
    edge = np.zeros(len(points) + 1, bool)
    edge[np.searchsorted(at, breaks)] = True
    edge[0] = edge[-1] = True
    start = edge[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    last = np.concatenate([start[1:] | edge[1:-1], [True]])
    # White space that something follows in the same text: its last character stands apart.
    tail = np.flatnonzero((kind == SPACE) & last & ~edge[1:])
    start[tail] = True
    joins = tail[points[tail] == 32]
    start[joins + 1] = False
    lone = np.flatnonzero((points == 0x27) & start & last & ~edge[1:])
    lone = lone[kind[lone + 1] == LETTER]
    if len(lone):
        following = np.searchsorted(np.flatnonzero(start), lone, "right")
        firsts = np.concatenate([np.flatnonzero(start), [len(points)]])
        ends = np.concatenate([firsts, [len(points)]])[following + 1]
        for i, end in zip(lone.tolist(), ends.tolist()):
            letters = points[i + 1:min(i + 3, end)].astype(np.uint32)
            for size in (1, 2):
                if len(letters) >= size and bytes(letters[:size].clip(0, 255).astype(np.uint8)) in CONTRACTIONS \
                        and (letters[:size] < 128).all():
                    start[i + 1] = False
                    if i + 1 + size < end:
                        start[i + 1 + size] = True
                    break
    return at[:-1][start]


def words(texts: list[bytes], classes: np.ndarray, special: Iterable[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The number of words of each text, the distinct words, and which of them stand in order."""
    joined = b"".join(texts)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    cuts = [np.concatenate([[0], ends]).astype(np.int64)]
    whole = []
    for token in special:
        if token in joined:
            found = [m.start() for m in regex.finditer(regex.escape(token), joined)]
            place = np.array(found, np.int64)
            text = np.searchsorted(ends, place, "right")
            place = place[place + len(token) <= ends[np.minimum(text, len(ends) - 1)]]
            whole += [(p, p + len(token)) for p in place.tolist()]
    if whole:
        cuts.append(np.array(whole, np.int64).ravel())
    breaks = np.unique(np.concatenate(cuts))
    starts = boundaries(joined, classes, breaks)
    for low, high in whole:
        starts = starts[(starts <= low) | (starts >= high)]
    offsets = np.append(starts, len(joined)).astype(np.int64)
    found = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]).dictionary_encode()
    first = np.searchsorted(starts, np.concatenate([[0], ends[:-1]]))
    counts = np.diff(np.append(first, len(starts)))
    return counts, found.dictionary, found.indices.to_numpy()


# --- the automaton -----------------------------------------------------------------------------


def compile_words(sorted_words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The minimal acyclic automaton of sorted distinct words, as arcs ordered by (state, byte).

    Returns the arcs' keys (state * 256 + byte), targets and outputs, and which states are final.
    Words are added in order; when a word leaves the path of the one before it, the states it
    leaves are complete and each is replaced by an equal one if there is such. An arc's output is
    the number of words that come before the first one through it, from its state.
    """
    known: dict[tuple, int] = {}
    sizes: list[int] = []  # words from a state on
    arcs: list[tuple] = []  # (byte, target) of a state
    finals: list[bool] = []

    def settle(final: bool, out: list[tuple[int, int]]) -> int:
        shape = (final, *out)
        state = known.get(shape)
        if state is None:
            state = known[shape] = len(arcs)
            arcs.append(tuple(out))
            finals.append(final)
            sizes.append(final + sum(sizes[t] for _, t in out))
        return state

    path: list[list] = [[False, []]]  # open states: final, complete arcs
    before = b""
    for word in sorted_words:
        shared = 0
        for a, b in zip(word, before):
            if a != b:
                break
            shared += 1
        for depth in range(len(before), shared, -1):
            state = settle(*path.pop())
            path[-1][1].append((before[depth - 1], state))
        path.extend([False, []] for _ in range(len(word) - shared))
        path[-1][0] = True
        before = word
    for depth in range(len(before), 0, -1):
        state = settle(*path.pop())
        path[-1][1].append((before[depth - 1], state))
    root = settle(*path.pop())
    # The root gets the number 0, as walks begin there.
    number = np.arange(len(arcs))
    number[root], number[0] = 0, root
    keys, targets, outputs = [], [], []
    final_states = np.zeros(len(arcs), bool)
    for state, out in enumerate(arcs):
        passed = int(finals[state])
        final_states[number[state]] = finals[state]
        for byte, target in out:
            keys.append(int(number[state]) * 256 + byte)
            targets.append(int(number[target]))
            outputs.append(passed)
            passed += sizes[target]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return (np.array(keys, np.int64)[order], np.array(targets, np.int32)[order],
            np.array(outputs, np.int32)[order], final_states)


@dataclass(frozen=True)
class Lexicon:
    """The automaton, the ids of its words by number, and the classes of code points."""

    keys: np.ndarray
    targets: np.ndarray
    outputs: np.ndarray
    finals: np.ndarray
    id_starts: np.ndarray
    ids: np.ndarray
    classes: np.ndarray

    def find(self, found: pa.Array) -> np.ndarray:
        """The number of each word, or -1, by one step of all words at a time."""
        offsets = np.frombuffer(found.buffers()[1], np.int64)[found.offset:found.offset + len(found) + 1]
        data = np.frombuffer(found.buffers()[2] or b"", np.uint8)
        sizes = np.diff(offsets)
        out = np.full(len(found), -1, np.int64)
        rows = np.flatnonzero((sizes > 0) & (sizes <= LEXICON_LENGTH))
        state, number = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        depth = 0
        while len(rows) and len(self.keys):
            key = state * 256 + data[offsets[rows] + depth]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes = self.keys[arc] == key
            rows, arc = rows[goes], arc[goes]
            state, number = self.targets[arc].astype(np.int64), number[goes] + self.outputs[arc]
            depth += 1
            done = sizes[rows] == depth
            final = done & self.finals[state]
            out[rows[final]] = number[final]
            rows, state, number = rows[~done], state[~done], number[~done]
        return out


PARTS = {"keys": np.int64, "targets": np.int32, "outputs": np.int32, "finals": np.bool_,
         "id_starts": np.int64, "ids": np.uint32, "classes": np.uint8}


def pack(lexicon: Lexicon) -> bytes:
    """A lexicon as one file: the sizes of its arrays, then the arrays, each at a multiple of 64."""
    out = np.array([len(getattr(lexicon, n)) for n in PARTS], np.int64).tobytes()
    for name, kind in PARTS.items():
        out += b"\0" * (-len(out) % 64) + np.asarray(getattr(lexicon, name), kind).tobytes()
    return out


def mapped(path: str) -> Lexicon:
    """A packed lexicon, mapped into memory."""
    data = np.memmap(path, np.uint8, "r")
    sizes = data[:8 * len(PARTS)].view(np.int64)
    at, parts = 8 * len(PARTS), {}
    for (name, kind), size in zip(PARTS.items(), sizes.tolist()):
        at += -at % 64
        n_bytes = size * np.dtype(kind).itemsize
        parts[name] = data[at:at + n_bytes].view(kind)
        at += n_bytes
    return Lexicon(**parts)


# --- the lexicon of a corpus -------------------------------------------------------------------


def share(spark: SparkSession, data: bytes, name: str) -> str:
    """Put a file into the shared folder and have Spark bring it to every executor, those that join
    later too. Returns the name that `SparkFiles` knows it by."""
    path = scratch_path(spark, name)
    files = Files(spark, path)
    files.write(path, data)
    spark.sparkContext.addFile(files.full(path))
    return path.rsplit("/", 1)[1]


def _count_words(batches: Iterable[pa.RecordBatch], classes, special: list[bytes]) -> Iterator[pa.RecordBatch]:
    table = classes.value
    for batch in T.portions(batches, limit=2 * PORTION):
        _, distinct, codes = words(T.raw(batch), table, special)
        n = np.bincount(codes, minlength=len(distinct))
        short = pc.less_equal(pc.binary_length(distinct), LEXICON_LENGTH)
        out = pa.RecordBatch.from_arrays([distinct.cast(pa.binary()), pa.array(n.astype(np.int64))], ["word", "n"])
        yield out.filter(short)


def frequent_words(docs: DataFrame, size: int = LEXICON_WORDS, model: str = MODEL) -> list[bytes]:
    """The most frequent words of all texts of `docs`, sorted: as many steps of the count as hold at
    most `size` words together.

    The step is found from a histogram of the counts in 64 steps per doubling, so beyond it only the
    chosen words come to the driver. Words longer than LEXICON_LENGTH bytes and words that occur
    once do not count.
    """
    spark = docs.sparkSession
    classes = spark.sparkContext.broadcast(code_point_classes())
    counts = docs.select("text").mapInArrow(
        partial(_count_words, classes=classes, special=list(load(model).special)), "word binary, n long")
    counts = counts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    counts = cut(counts.select("word", F.floor(F.log2("n") * 64).cast("int").alias("step")), "words")
    least, chosen = None, 0
    for row in sorted(counts.groupBy("step").count().collect(), reverse=True):
        chosen += row["count"]
        if chosen > size:
            break
        least = row.step
    if least is None:
        return []
    return sorted(bytes(r.word) for r in counts.where(F.col("step") >= least).collect())


def lexicon(sorted_words: list[bytes], model: str = MODEL) -> Lexicon:
    vocabulary = load(model)
    listed = [w for w in sorted_words if w not in vocabulary.special]
    keys, targets, outputs, finals = compile_words(listed)
    ids, counts = Merges(vocabulary)(listed)
    starts = np.concatenate([[0], np.cumsum(counts)])
    return Lexicon(keys, targets, outputs, finals, starts, ids, code_point_classes())


# --- encoding and decoding ---------------------------------------------------------------------


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of consecutive runs that begin at `starts`."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class Encoder:
    """Encodes portions of text in one task."""

    def __init__(self, vocabulary: Vocabulary, found: Lexicon):
        self.vocabulary, self.lexicon, self.merges = vocabulary, found, Merges(vocabulary)

    def _merged(self, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that the automaton does not hold, in order, and how many each has."""
        special = self.vocabulary.special
        long = [i for i, w in enumerate(found) if len(w) > SHORT or w in special]
        ids, counts = self.merges([b"" if len(w) > SHORT or w in special else w for w in found])
        if not long:
            return ids, counts
        parts, at = [], 0
        ends = np.cumsum(counts)
        for i in long:
            parts.append(ids[at:ends[i]])
            at = ends[i]
            own = [special[found[i]]] if found[i] in special else merge(found[i], self.vocabulary)
            parts.append(np.array(own, np.uint32))
            counts[i] = len(own)
        return np.concatenate([*parts, ids[at:]]), counts

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order, and how many each text has."""
        counts, distinct, codes = words(texts, self.lexicon.classes, self.vocabulary.special)
        number = self.lexicon.find(distinct)
        new, new_sizes = self._merged(distinct.filter(pa.array(number < 0)).to_pylist())
        flat = np.concatenate([self.lexicon.ids, new])
        starts, sizes = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        known = number >= 0
        starts[known] = self.lexicon.id_starts[number[known]]
        sizes[known] = self.lexicon.id_starts[number[known] + 1] - starts[known]
        starts[~known] = len(self.lexicon.ids) + np.cumsum(new_sizes) - new_sizes
        sizes[~known] = new_sizes
        ids = flat[_ragged(starts[codes], sizes[codes])]
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        edges = np.concatenate([[0], np.cumsum(counts)])
        return ids, ends[edges[1:]] - ends[edges[:-1]]


class Decoder:
    """Decodes ids: the bytes of all ids behind each other, by place."""

    def __init__(self, vocabulary: Vocabulary):
        self.sizes = np.array([len(t) for t in vocabulary.texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(vocabulary.texts), np.uint8)

    def __call__(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of consecutive runs of ids; an id the vocabulary does not have gives none."""
        known = (ids >= 0) & (ids < len(self.sizes))
        safe = np.where(known, ids, 0).astype(np.int64)
        sizes = np.where(known, self.sizes[safe], 0)
        joined = self.bytes[_ragged(self.starts[safe], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [joined[a:b] for a, b in zip(ends, ends[1:])]


def _encode(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary, name: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary, mapped(SparkFiles.get(name)))
    for batch in T.portions(batches, limit=PORTION):
        ids, counts = encoder(T.raw(batch))
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), lists, pa.array(counts.astype(np.int64))],
            ["doc_id", "text", "ids", "n_tokens"])


def _decode(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary, ids: str, name: str) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(vocabulary)
    for batch in batches:
        column = batch.column(ids)
        counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        found = decoder(pc.fill_null(column.flatten(), -1).to_numpy(), counts)
        texts = pa.array([t.decode("utf-8", "replace") for t in found], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, name])


def _digest(batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary, name: str) -> Iterator[pa.RecordBatch]:
    encoder, decoder = Encoder(vocabulary, mapped(SparkFiles.get(name))), Decoder(vocabulary)
    for batch in T.portions(batches, limit=PORTION):
        ids, counts = encoder(T.raw(batch))
        packed, ends = ids.astype("<u4").tobytes(), np.concatenate([[0], 4 * np.cumsum(counts)]).tolist()
        of_ids = [hashlib.sha256(packed[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]
        texts = (t.decode("utf-8", "replace").encode() for t in decoder(ids, counts))
        of_texts = [hashlib.sha256(t).hexdigest() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(of_ids), pa.array(of_texts)],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def fit(docs: DataFrame, size: int = LEXICON_WORDS, model: str = MODEL) -> str:
    """Compile the frequent words of `docs` and hand the file to all executors; returns its name.

    Which words are compiled changes the time that encoding takes, and no id.
    """
    return share(docs.sparkSession, pack(lexicon(frequent_words(docs, size, model), model)), "lexicon")


def encode(docs: DataFrame, fitted: str | None = None, model: str = MODEL) -> DataFrame:
    """(doc_id, text, ids, n_tokens) of every row of `docs`, as the tokenizer library gives them
    without adding special tokens; a special token's string in a text is that token.

    A null or empty text has no ids. Texts are encoded whole, whatever their length, a portion of
    about 2 MB or one longer text at a time. Repeated rows each give a row; other columns are not
    looked at; an empty table gives no rows.
    """
    fitted = fitted or fit(docs, model=model)
    return T.texts(docs).mapInArrow(
        partial(_encode, vocabulary=load(model), name=fitted), "doc_id long, text string, ids array<int>, n_tokens long")


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`encoded` with the text of its `ids` in the column `name`, which replaces one of that name.

    Special tokens give their strings. Null ids give an empty text, ids the vocabulary does not
    have give nothing, and bytes that do not form UTF-8 give replacement characters.
    """
    rows = encoded.drop(name)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInArrow(
        partial(_decode, vocabulary=load(model), ids=ids, name=name), ", ".join([*fields, f"`{name}` string"]))


def digest(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): `encode` and `decode` of every row in one
    pass, with the digests of the ids, as little-endian 32-bit integers, and of the decoded text."""
    return T.texts(docs).mapInArrow(
        partial(_digest, vocabulary=load(model), name=fit(docs, model=model)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
