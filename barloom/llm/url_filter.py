"""URL rules, and exact list membership by a cascade of Bloom filters."""

from __future__ import annotations

import math
import string
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.session import cut

# Keys of one cascade: at about 1.5 bits a key and level this bounds what a task is sent.
BLOCK_KEYS = 4_000_000
RULES = (
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first "://", up to the path, and the path; both empty without "://"."""
    def part(group):
        return F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", group), F.lit(""))

    return F.translate(part(1), string.ascii_uppercase, string.ascii_lowercase), part(2)


def first_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits a host and path, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


@dataclass(frozen=True)
class Level:
    """One Bloom filter of a cascade."""

    number: int
    size: int
    hashes: int
    bits: np.ndarray

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The bit places of keys given by two hashes, a row per hash function."""
        start = _mixed(a ^ np.uint64((self.number * 0x9E3779B97F4A7C15) % 2**64))
        step = _mixed(b + np.uint64(self.number)) | np.uint64(1)
        return np.stack([start + np.uint64(i) * step for i in range(self.hashes)]) % np.uint64(self.size)

    def passes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self.places(a, b)
        return ((self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def listed(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Membership of keys of the universe: a key that first fails at level i is listed if i is
    odd; one that passes all is listed if there is an odd number of levels."""
    out = np.zeros(len(a), bool)
    alive = np.arange(len(a))
    for level in levels:
        out[alive] = level.number % 2 == 1
        alive = alive[level.passes(a[alive], b[alive])]
    out[alive] = len(levels) % 2 == 1
    return out


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                 for c in ("hash_a", "hash_b"))


def _set_bits(batches: Iterable[pa.RecordBatch], level: Level) -> Iterator[pa.RecordBatch]:
    """The words of the filter that these keys touch, with their bits."""
    for batch in batches:
        at = np.unique(level.places(*_hashes(batch)))
        words, starts = np.unique(at >> np.uint64(6), return_index=True)
        ones = np.uint64(1) << (at & np.uint64(63))
        bits = np.bitwise_or.reduceat(ones, starts) if len(at) else ones
        yield pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(bits.view(np.int64))], ["word", "bits"])


def _passing(batches: Iterable[pa.RecordBatch], level: Level) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(level.passes(*_hashes(batch))))


def hashed(df: DataFrame, key: str) -> DataFrame:
    """`df` with the two 64-bit hashes of its key; together they tell keys apart."""
    return df.withColumns({"hash_a": F.xxhash64(key), "hash_b": F.xxhash64(F.lit(1), key)})


def cascade(universe: DataFrame) -> list[Level]:
    """The levels for one block of keys (hash_a, hash_b, is_listed).

    Level 0 encodes the listed keys. Each further level encodes the keys of the other kind that
    wrongly pass the one before, until none does; then every key of the universe is decided.
    """
    keys = universe.select("hash_a", "hash_b")
    inside, outside = keys.where(universe["is_listed"]), keys.where(~universe["is_listed"])
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    while n_in:
        rate = min(0.5, math.sqrt(0.5) * n_in / n_out) if n_out and not levels else 0.5
        size = 64 * math.ceil((-n_in * math.log(rate) / math.log(2) ** 2 + 64) / 64)
        empty = Level(len(levels), size, max(1, round(-math.log2(rate))), np.zeros(0, np.uint64))
        words = inside.mapInArrow(partial(_set_bits, level=empty), "word long, bits long")
        bits = np.zeros(size // 64, np.uint64)
        for row in words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toLocalIterator():
            bits[row.word] = row.bits % 2**64
        level = Level(empty.number, size, empty.hashes, bits)
        levels.append(level)
        wrong = cut(outside.mapInArrow(partial(_passing, level=level), "hash_a long, hash_b long"), "level")
        inside, outside, n_in, n_out = wrong, inside, wrong.count(), n_in
    return levels


def _decide(batches, levels: list[Level], name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.append_column(name, pa.array(listed(levels, *_hashes(batch))))


def membership(rows: DataFrame, universe: DataFrame, key: str, name: str = "is_listed",
               block_keys: int = BLOCK_KEYS) -> DataFrame:
    """`rows` with the boolean column `name`: whether their key is listed, without a join.

    `universe` has each key of `rows` once, with `is_listed`. Keys are dealt by hash into blocks
    of about `block_keys`, each with a cascade of its own, so what a task is sent stays bounded
    while the universe grows; every block passes over the rows once.
    """
    universe = cut(hashed(universe, key).select("hash_a", "hash_b", "is_listed"), "universe")
    blocks = max(1, math.ceil(universe.count() / block_keys))

    def block(df, i):
        return df if blocks == 1 else df.where(F.pmod("hash_b", F.lit(blocks)) == i)

    rows = hashed(rows, key)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{name}` boolean"])
    parts = [
        block(rows, i).mapInArrow(partial(_decide, levels=cascade(block(universe, i)), name=name), schema)
        for i in range(blocks)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out.drop("hash_a", "hash_b")


def judge(pages: DataFrame, rules=RULES, block_keys: int = BLOCK_KEYS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages` (page_id, url).

    The longest rule that fits decides. Where none fits, the host decides: hosts with a page that
    a rule blocks are listed, and a listed host is blocked. A url that is null or has no "://" has
    an empty host and path; no rule fits it, its host is not listed, and it is allowed. Repeated
    rows and ids each give a row; other columns are not looked at.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict})
    blocked = F.coalesce(F.col("ruled") == "block", F.lit(False))
    universe = rows.groupBy("host").agg(F.max(blocked).alias("is_listed"))
    found = membership(rows, universe, "host", block_keys=block_keys)
    own = F.when(F.col("is_listed"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"))
