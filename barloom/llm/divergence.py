"""Source divergence audit: which sources of a language use its terms differently, and which terms.

Two passes over the texts. The first counts exactly in how many documents a term stands. The terms
that are frequent enough get slots by minimal perfect hashes, and the second counts into dense
vectors of slots, one per group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import text as T
from barloom.llm.chunks import expand, squeeze
from barloom.session import cut

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SCALE_DIGITS = 3  # shares are counted in steps of 1000 ** -SCALE_DIGITS
# Slots per shard, about; and how many bytes of shards go to the tasks of one pass over the texts.
SHARD_TERMS = 4096
ROUND_BYTES = 96 * 1024 * 1024
# Cells of dense vectors that a task holds before it sends them on.
TASK_CELLS = 8_000_000
# Sources of a language that meet in one group of the pairwise comparison.
TILE = 32
LEVELS = 24
ROOM = 1.7  # positions per key in a level of a hash
PORTION = 4 * 1024 * 1024


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case of A-Z, and which bytes lie in terms: letters and all beyond ASCII."""
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    inside = np.zeros(256, bool)
    inside[97:123] = inside[128:] = True
    return fold, inside


FOLD, INSIDE = _byte_tables()


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The terms of some texts: the text and the number of each, and the distinct terms."""
    data = FOLD[np.frombuffer(b"\n".join(texts), np.uint8)]
    inside = INSIDE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    found = pa.Array.from_buffers(
        pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    coded = found.dictionary_encode()
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)[:-1]])
    owner = np.searchsorted(begins, starts, "right") - 1
    return owner, coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _numbered(values: list[str]) -> tuple[np.ndarray, list[str]]:
    number: dict[str, int] = {}
    return np.array([number.setdefault(v, len(number)) for v in values], np.int64), list(number)


# --- first pass --------------------------------------------------------------------------------


def _document_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.portions(batches, limit=PORTION):
        owner, code, distinct = terms(T.raw(batch))
        lang, langs = _numbered(batch.column("lang").to_pylist())
        width = max(len(distinct), 1)
        seen = np.unique(owner * width + code)
        pair, n = np.unique(lang[seen // width] * width + seen % width, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()).take(pa.array(pair // width)),
             distinct.take(pa.array(pair % width)), pa.array(n.astype(np.int64))],
            ["lang", "term", "n_docs"])


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term) of the terms that stand in `least` or more rows of their language."""
    found = docs.mapInArrow(_document_counts, "lang string, term string, n_docs long")
    return found.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs")).where(F.col("n_docs") >= least)


# --- minimal perfect hashes --------------------------------------------------------------------


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _places(hashes: np.ndarray, level: int, sizes: np.ndarray | int) -> np.ndarray:
    """The position of each hash in its array of a level: a mix of the hash and the level."""
    x = hashes + np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) % np.asarray(sizes, np.uint64)).astype(np.int64)


def build(keys: list[bytes]) -> tuple[list[int], np.ndarray, list[bytes]]:
    """Level sizes, the bits of all levels, and the keys in the order of their slots.

    A key belongs to the first level where no other key is at its position; its slot is the number
    of set bits before it. Keys that share positions on all levels, such as those of equal hash,
    take the last slots, under bits of their own, and are looked up by name.
    """
    hashes, left = _hashes(keys), np.arange(len(keys))
    sizes, bits, order = [], [], []
    for level in range(LEVELS):
        if not len(left):
            break
        size = int(ROOM * len(left)) + 1
        at = _places(hashes[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        single = alone[at]
        order.extend(left[single][np.argsort(at[single])].tolist())
        sizes.append(size)
        bits.append(alone)
        left = left[~single]
    order.extend(left.tolist())
    bits.append(np.ones(len(left), bool))
    return sizes, np.concatenate(bits), [keys[i] for i in order]


SHARD = "lang string, shard long, n_shards long, size long, sizes array<long>, bits binary, n_bits long, keys array<string>"


def _shard(key: tuple, table: pa.Table) -> pa.Table:
    lang, shard = (k.as_py() for k in key)
    sizes, bits, keys = build(table.column("term").cast(pa.binary()).to_pylist())
    row = {
        "lang": lang, "shard": shard, "n_shards": table.column("n_shards")[0].as_py(), "size": len(keys),
        "sizes": sizes, "bits": np.packbits(bits, bitorder="little").tobytes(), "n_bits": len(bits),
        "keys": [k.decode() for k in keys],
    }
    return pa.Table.from_pylist([row], _SHARD_ARROW)


_SHARD_ARROW = pa.schema([
    ("lang", pa.string()), ("shard", pa.int64()), ("n_shards", pa.int64()), ("size", pa.int64()),
    ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("n_bits", pa.int64()), ("keys", pa.list_(pa.string()))])


def _shard_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shard of each term, by the hash that tasks of the second pass look it up with."""
    for batch in batches:
        found = _hashes(batch.column("term").cast(pa.binary()).to_pylist())
        shards = (found >> np.uint64(16)) % batch.column("n_shards").to_numpy().astype(np.uint64)
        yield batch.append_column("shard", pa.array(shards.astype(np.int64)))


def perfect_hashes(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """One row per shard of a language's terms: a minimal perfect hash, and its keys by slot."""
    per_lang = kept.groupBy("lang").agg(F.ceil(F.count("*") / shard_terms).alias("n_shards"))
    rows = kept.join(per_lang, "lang").select("lang", "term", "n_shards")
    placed = rows.mapInArrow(_shard_of, "lang string, term string, n_shards long, shard long")
    return placed.groupBy("lang", "shard").applyInArrow(_shard, SHARD)


class Slots:
    """Slots of the terms of some shards. Those of a language are consecutive."""

    def __init__(self, shards: pa.Table):
        rows = shards.sort_by([("lang", "ascending"), ("shard", "ascending")])
        self.shard = rows.column("shard").to_numpy()
        self.size = rows.column("size").to_numpy()
        self.first = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        n_bits = rows.column("n_bits").to_numpy()
        bit_first = np.concatenate([[0], np.cumsum(n_bits)]).astype(np.int64)
        bits = np.zeros((int(bit_first[-1]) // 64 + 1) * 64, bool)
        self.sizes = np.ones((rows.num_rows, LEVELS), np.int64)
        self.starts = np.full((rows.num_rows, LEVELS), -1, np.int64)
        self.by_lang: dict[str, tuple[int, int, np.ndarray]] = {}
        self.rest: dict[tuple[str, bytes], int] = {}
        langs = rows.column("lang").to_pylist()
        counts = rows.column("n_shards").to_pylist()
        for i, (lang, sizes) in enumerate(zip(langs, rows.column("sizes").to_pylist())):
            packed = np.frombuffer(rows.column("bits")[i].as_buffer(), np.uint8)
            bits[bit_first[i]:bit_first[i + 1]] = np.unpackbits(packed, bitorder="little")[:n_bits[i]]
            self.sizes[i, :len(sizes)] = sizes
            self.starts[i, :len(sizes)] = bit_first[i] + np.concatenate([[0], np.cumsum(sizes)[:-1]])
            low, _, index = self.by_lang.setdefault(lang, (i, i, np.full(counts[i], -1, np.int64)))
            index[self.shard[i]] = i
            self.by_lang[lang] = (low, i + 1, index)
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype(np.int64)
        self.keys = pa.chunked_array([c.flatten() for c in rows.column("keys").chunks], pa.string()).combine_chunks()
        for i, lang in enumerate(langs):
            level_bits = int(self.sizes[i][self.starts[i] >= 0].sum())
            for k in range(int(n_bits[i]) - level_bits):
                slot = int(self.first[i + 1]) - 1 - k
                self.rest[lang, self.keys[slot].as_py().encode()] = slot

    def span(self, lang: str) -> tuple[int, int]:
        """The first slot of a language and the one after its last."""
        low, high, _ = self.by_lang[lang]
        return int(self.first[low]), int(self.first[high])

    def find(self, lang: str, found: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The slot of each term, or -1. A slot counts only if the key stored there is the term."""
        out = np.full(len(found), -1, np.int64)
        if lang not in self.by_lang:
            return out
        index = self.by_lang[lang][2]
        shard = index[((hashes >> np.uint64(16)) % np.uint64(len(index))).astype(np.int64)]
        open_ = np.flatnonzero(shard >= 0)
        for level in range(LEVELS):
            s = shard[open_]
            open_, s = open_[self.starts[s, level] >= 0], s[self.starts[s, level] >= 0]
            if not len(open_):
                break
            at = self.starts[s, level] + _places(hashes[open_], level, self.sizes[s, level])
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(below)
            open_ = open_[~hit]
        some = np.flatnonzero(out >= 0)
        same = pc.equal(self.keys.take(pa.array(out[some])), found.take(pa.array(some)))
        out[some[~same.to_numpy(zero_copy_only=False)]] = -1
        if self.rest:
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = self.rest.get((lang, found[i].as_py().encode()), -1)
        return out


# --- second pass -------------------------------------------------------------------------------


def _rows(rows: list[tuple], names: tuple[str, ...], kinds: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], list(names))


VECTOR = "lang string, source string, shard long, packed binary"


def _recount(batches: Iterable[pa.RecordBatch], shards) -> Iterator[pa.RecordBatch]:
    """Occurrences per group and slot, in dense vectors, sent on by shard."""
    slots = Slots(shards.value)
    dense: dict[tuple[str, str], np.ndarray] = {}

    def flush():
        rows = []
        for (lang, source), counts in dense.items():
            low, high, _ = slots.by_lang[lang]
            for i in range(low, high):
                part = counts[slots.first[i] - slots.first[low]:slots.first[i + 1] - slots.first[low]]
                if part.any():
                    rows.append((lang, source, int(slots.shard[i]), squeeze(part.tobytes())))
        dense.clear()
        return _rows(rows, ("lang", "source", "shard", "packed"), (pa.string(), pa.string(), pa.int64(), pa.binary()))

    for batch in T.portions(batches, limit=PORTION):
        owner, code, distinct = terms(T.raw(batch))
        names = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
        group, groups = _numbered(names)
        hashes, width = _hashes(distinct.cast(pa.binary()).to_pylist()), max(len(distinct), 1)
        pair, n = np.unique(group[owner] * width + code, return_counts=True)
        of_group, of_term = pair // width, pair % width
        edges = np.searchsorted(of_group, np.arange(len(groups) + 1))
        by_lang: dict[str, list[int]] = {}
        for i, (lang, _) in enumerate(groups):
            if lang in slots.by_lang:
                by_lang.setdefault(lang, []).append(i)
        for lang, members in by_lang.items():
            low, high = slots.span(lang)
            used = np.unique(np.concatenate([of_term[edges[i]:edges[i + 1]] for i in members]))
            at = np.full(width, -1, np.int64)
            at[used] = slots.find(lang, distinct.take(pa.array(used)), hashes[used])
            for i in members:
                slot, times = at[of_term[edges[i]:edges[i + 1]]], n[edges[i]:edges[i + 1]]
                if groups[i] not in dense:
                    dense[groups[i]] = np.zeros(high - low, np.int64)
                dense[groups[i]][slot[slot >= 0] - low] += times[slot >= 0]
                if sum(map(len, dense.values())) > TASK_CELLS:
                    yield flush()
    yield flush()


def _unpacked(data: bytes | None, size: int) -> np.ndarray:
    return np.zeros(size, np.int64) if data is None else np.frombuffer(expand(data), np.int64)


def _summed(batches: Iterable[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each key, with their total. The rows come sorted by key."""
    last, total = None, None

    def row():
        return _rows([(*last, int(total.sum()), squeeze(total.tobytes()))], (*names, "total", "packed"),
                     (*[pa.string()] * (len(names) - 1), pa.int64(), pa.int64(), pa.binary()))

    for batch in batches:
        for *key, packed in zip(*(batch.column(c).to_pylist() for c in (*names, "packed"))):
            counts = _unpacked(packed, 0)
            if key == last:
                total = total + counts
            else:
                if last is not None:
                    yield row()
                last, total = key, counts
    if last is not None:
        yield row()


def _sum(vectors: DataFrame, *names: str) -> DataFrame:
    """One vector per key. Tasks hold one vector at a time, however many there are of a key."""
    dealt = vectors.select(*names, "packed").repartition(*names).sortWithinPartitions(*names)
    kinds = [f"{n} {'long' if n == 'shard' else 'string'}" for n in names]
    return dealt.mapInArrow(partial(_summed, names=names), ", ".join([*kinds, "total long", "packed binary"]))


def recount(docs: DataFrame, shards: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(lang, source, shard, total, packed): occurrences of the shard's terms by slot.

    Shards are broadcast in rounds of about `round_bytes`, each a pass over the texts, so what a
    task holds does not grow with the vocabulary. A group's slots that are all zero have no row.
    """
    spark = docs.sparkSession
    n_bytes = shards.agg(F.sum(F.length("bits") + F.length(F.to_json("keys")))).first()[0] or 0
    rounds = max(1, -(-n_bytes // round_bytes))
    parts = []
    for k in range(rounds):
        chosen = shards.where(F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds)) == k)
        sent = spark.sparkContext.broadcast(chosen.toArrow())
        parts.append(cut(docs.mapInArrow(partial(_recount, shards=sent), VECTOR), "counts"))
        sent.unpersist()
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return cut(_sum(found, "lang", "source", "shard"), "vectors")


# --- comparison --------------------------------------------------------------------------------


def share(counts: np.ndarray, total: int, n_terms: int) -> np.ndarray:
    """1 + floor(10**9 * (count + 2) / (total + 2 * n_terms)), by long division in base 1000."""
    whole = total + 2 * n_terms
    out, rest = np.zeros(len(counts), np.int64), counts + 2
    for _ in range(SCALE_DIGITS):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


PAIR = "lang string, source string, item string, value long"
_PAIR_NAMES, _PAIR_KINDS = ("lang", "source", "item", "value"), (pa.string(), pa.string(), pa.string(), pa.int64())


def _pairs(key: tuple, table: pa.Table) -> pa.Table:
    """The gap between each two sources of two tiles, summed over the terms of a shard."""
    rows = sorted(table.to_pylist(), key=lambda r: r["number"])
    shares = [share(_unpacked(r["packed"], r["size"]), r["total"], r["n_terms"]) for r in rows]
    one_tile = key[2].as_py() == key[3].as_py()
    out = []
    for i, a in enumerate(rows):
        for j in range(i + 1, len(rows)):
            if one_tile or a["tile"] != rows[j]["tile"]:
                out.append((a["lang"], a["source"], rows[j]["source"], int(gap(shares[i], shares[j]).sum())))
    return pa.Table.from_batches([_rows(out, _PAIR_NAMES, _PAIR_KINDS)])


def _term_gaps(batches: Iterable[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """Per group and shard the terms that it uses most beyond their share in the language."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            r = {n: batch.column(n)[i].as_py() for n in batch.schema.names if n != "keys"}
            counts = _unpacked(r["packed"], 0)
            p = share(counts, r["total"], r["n_terms"])
            q = share(_unpacked(r["lang_packed"], 0), r["lang_total"], r["n_terms"])
            value = np.where((counts > 0) & (p > q), gap(p, q), -1)
            some = np.flatnonzero(value >= 0)
            if len(some) > top:  # with all that equal the last of the top
                some = some[value[some] >= np.partition(value[some], len(some) - top)[len(some) - top]]
            keys = batch.column("keys")[i].values.take(pa.array(some)).to_pylist()
            best = sorted(zip((-value[some]).tolist(), (k.encode() for k in keys)))[:top]
            out += [(r["lang"], r["source"], k.decode(), -v) for v, k in best]
        yield _rows(out, _PAIR_NAMES, _PAIR_KINDS)


def compare(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): gaps between sources, and terms that stand out.

    `docs` has text, lang and source; a null in any of them is read as empty. Terms are runs of
    letters and of anything beyond ASCII, A-Z in lower case, over whole texts however long. A
    language keeps the terms that stand in `least` or more of its rows (repeated rows count). A
    group is a source within a language, with or without terms. Part `pair` ranks the other
    sources of the language by the summed gap of shares over all kept terms (0 if there are none),
    part `term` the `top` kept terms that the group uses beyond their share in the language. Ties
    are ranked by item. Other columns are not looked at; an empty table gives no rows. Shares are
    exact as long as a group has fewer than 9e15 occurrences.
    """
    rows = docs.select("text", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")))
    shards = cut(perfect_hashes(cut(kept_terms(rows, least), "kept")), "shards")
    vectors = recount(rows, shards)
    of_lang = cut(_sum(vectors, "lang", "shard"), "languages")
    sizes = shards.groupBy("lang").agg(F.sum("size").alias("n_terms"))
    totals = vectors.groupBy("lang", "source").agg(F.sum("total").alias("total"))
    groups = (
        rows.select("lang", "source").distinct().join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
        .withColumn("total", F.coalesce("total", F.lit(0)))
        .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
        .withColumn("n_sources", F.count("*").over(Window.partitionBy("lang")))
    )
    groups = cut(groups, "groups")

    tile = F.floor(F.col("number") / TILE)
    tiles = F.floor((F.col("n_sources") - 1) / TILE)
    dense = (
        groups.join(shards.select("lang", "shard", "size"), "lang")
        .join(vectors.select("lang", "source", "shard", "packed"), ["lang", "source", "shard"], "left")
        .withColumn("tile", tile)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles)))
        .withColumn("low", F.least("tile", "other")).withColumn("high", F.greatest("tile", "other"))
        .drop("other", "n_sources")
    )
    gaps = dense.groupBy("lang", "shard", "low", "high").applyInArrow(_pairs, PAIR)
    gaps = cut(gaps.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "gaps")
    bare = groups.where("n_terms IS NULL").select("lang", "source")
    none = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item")
    pairs = gaps.unionAll(gaps.select("lang", F.col("item"), F.col("source"), "value")).unionAll(
        none.select("lang", "source", "item", F.lit(0).cast("long")))

    beside = (
        vectors.join(of_lang.select("lang", "shard", F.col("total").alias("lang_total"),
                                    F.col("packed").alias("lang_packed")), ["lang", "shard"])
        .join(shards.select("lang", "shard", "keys"), ["lang", "shard"])
        .drop("total")
        .join(groups.select("lang", "source", "total", "n_terms"), ["lang", "source"])
    )
    whole = of_lang.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    beside = beside.drop("lang_total").join(whole, "lang")
    standing_out = beside.mapInArrow(partial(_term_gaps, top=top), PAIR)

    found = pairs.withColumn("part", F.lit("pair")).unionAll(standing_out.withColumn("part", F.lit("term")))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where((F.col("part") == "pair") | (F.col("rank") <= top))
        .select("lang", "source", "part", "item", "value", "rank")
    )
