"""SentencePiece encoding and decoding with a Viterbi search that words share by their prefixes."""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from barloom.llm import text as T

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Segmented words a task remembers; beyond it, and for longer words, they are segmented again.
CACHE_WORDS = 300_000
CACHED_LENGTH = 64
# Spaces lead a word. Some other white space, which no longer piece may hold, stands alone.
WORD = re.compile(r" *[^ \n\t\v\f]+| +|[\n\t\v\f]")
SPANS_WORDS = re.compile(r"[^ ] |.[\n\t\v\f]|[\n\t\v\f].", re.DOTALL)


@dataclass(frozen=True)
class Pieces:
    """A model's pieces with plain spaces for its mark: score and id of each, and byte ids.

    `beginnings` has the scores, and every beginning of a piece that is no piece, with None.
    """

    scores: dict[str, float]
    beginnings: dict[str, float | None]
    ids: dict[str, bytes]
    bytes_ids: list[bytes]
    texts: list[bytes]
    unknown: float


def _id(number: int) -> bytes:
    return np.int32(number).tobytes()


def load(model: str = MODEL) -> Pieces:
    """Read a model with byte fallback whose pieces lie inside words.

    Scores of a unigram model are its log-probabilities. Those of a merge model only rank its
    pieces, so rank r gets -ln(r + 2), as if piece counts followed Zipf's law.
    """
    found = sentencepiece.SentencePieceProcessor(model_file=os.fspath(model))
    size = found.get_piece_size()
    byte_ids: list[bytes] = [b""] * 256
    texts = [b""] * size
    plain: list[tuple[int, str, float]] = []
    for i in range(size):
        piece = found.id_to_piece(i)
        if found.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = _id(i)
            texts[i] = bytes([int(piece[3:5], 16)])
        elif not (found.is_unknown(i) or found.is_control(i) or found.is_unused(i)):
            piece = piece.replace(MARK, " ")
            if SPANS_WORDS.search(piece):
                raise ValueError(f"piece {i} spans words, which this encoder does not support")
            texts[i] = piece.encode()
            plain.append((i, piece, found.get_score(i)))
    if not all(byte_ids):
        raise ValueError("the model has no byte fallback")
    scores = {piece: score for _, piece, score in plain}
    if any(score < -1000 for score in scores.values()):
        ranked = sorted(plain, key=lambda p: (-p[2], p[0]))
        scores = {piece: -math.log(rank + 2) for rank, (_, piece, _) in enumerate(ranked)}
    ids = {piece: _id(i) for i, piece, _ in plain}
    unknown = min(scores.values()) - UNKNOWN_PENALTY
    beginnings = {piece[:n]: None for piece in scores for n in range(1, len(piece))}
    return Pieces(scores, beginnings | scores, ids, byte_ids, texts, unknown)


def segment(words: Iterable[str], pieces: Pieces) -> Iterator[tuple[str, bytes]]:
    """Each distinct word with the ids, as packed 32-bit integers, of its best pieces.

    Sorted words are the leaves of a trie in depth-first order: the forward scores of the prefix
    that a word shares with the one before it are kept, the rest is computed. With the score of a
    prefix the starts are kept from which a piece may still go on, so a start is followed only as
    far as some piece begins with what was read. Of paths of equal score the one whose last piece
    is longest wins, and so on backwards.
    """
    find, unknown, gone = pieces.beginnings.get, pieces.unknown, object()
    best, back, open_, before = [0.0], [0], [()], ""
    for word in sorted(words):
        shared = len(os.path.commonprefix((word, before)))
        del best[shared + 1:], back[shared + 1:], open_[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            alone = find(word[end - 1:end], gone)
            top, at = best[end - 1] + (unknown if alone is None or alone is gone else alone), end - 1
            starts = []
            for start in open_[end - 1]:
                score = find(word[start:end], gone)
                if score is not gone:
                    starts.append(start)
                    if score is not None:
                        score += best[start]
                        if score > top or at == end - 1 and score == top:
                            top, at = score, start
            if alone is not gone:
                starts.append(end - 1)
            best.append(top)
            back.append(at)
            open_.append(starts)
        before = word
        out, end = [], len(word)
        while end:
            piece = word[back[end]:end]
            end = back[end]
            found = pieces.ids.get(piece)
            out.append(found if found else b"".join(pieces.bytes_ids[b] for b in piece.encode()))
        yield word, b"".join(reversed(out))


def encode_texts(texts: list[str], pieces: Pieces, known: dict[str, bytes]) -> list[bytes]:
    """The packed ids of some texts; `known` carries segmented words from call to call."""
    split = [WORD.findall(" " + t) if t else [] for t in texts]
    new = {w for ws in split for w in ws}.difference(known)
    if len(known) + len(new) > CACHE_WORDS:
        # Frequent words come early: what was met first stays.
        for word in list(known)[CACHE_WORDS // 3:]:
            del known[word]
        new = {w for ws in split for w in ws}.difference(known)
    known.update(segment(new, pieces))
    out = [b"".join(map(known.__getitem__, ws)) for ws in split]
    for word in [w for w in new if len(w) > CACHED_LENGTH]:
        del known[word]
    return out


def _encode(batches: Iterable[pa.RecordBatch], pieces: Pieces) -> Iterator[pa.RecordBatch]:
    known: dict[str, bytes] = {}
    for batch in T.portions(batches):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        packed = encode_texts(texts, pieces, known)
        sizes = np.array([len(p) // 4 for p in packed], np.int32)
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(packed), np.int32)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), ids, pa.array(sizes.astype(np.int64))],
            ["doc_id", "text", "ids", "n_ids"])


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text, ids, n_ids) of every row of `docs`; ids are the model's.

    A space is put before each text, as the model expects; no other character is changed, and one
    without a piece becomes its UTF-8 bytes' ids, so that `decode` gives every text back. A null
    or empty text has no ids. Words are segmented once per task, whatever their length; nothing is
    shuffled. Other columns are not looked at, repeated rows each give a row.
    """
    return T.texts(docs).mapInArrow(
        partial(_encode, pieces=load(model)), "doc_id long, text string, ids array<int>, n_ids long")


def decode_ids(ids: np.ndarray, pieces: Pieces) -> bytes:
    """The text of some ids, without the space that encoding put before it."""
    known = ids[(ids >= 0) & (ids < len(pieces.texts))]
    joined = b"".join(map(pieces.texts.__getitem__, known.tolist()))
    return joined[1:] if joined.startswith(b" ") else joined


def _decode(batches, pieces: Pieces, ids: str, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(ids)
        lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
        rows = np.split(pc.fill_null(column.flatten(), -1).to_numpy(), np.cumsum(lengths)[:-1])
        out = [decode_ids(row, pieces).decode("utf-8", "replace") for row in rows[:batch.num_rows]]
        yield batch.append_column(name, pa.array(out, pa.string()))


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """`encoded` with the text of its `ids` in the column `name`.

    Null ids give an empty text, control ids and ids the model does not have give nothing, and
    bytes that do not form UTF-8 give replacement characters.
    """
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema]
    schema = ", ".join([*fields, f"`{name}` string"])
    return encoded.mapInArrow(partial(_decode, pieces=load(model), ids=ids, name=name), schema)
