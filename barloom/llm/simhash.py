"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import text as T
from barloom.llm.components import components
from barloom.session import cut

SEED = 42
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, width: int) -> int:
    """The signed 64-bit SimHash of a text's word shingles; zero for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends[min(width, len(words)) - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(ends), SHINGLES_AT_ONCE):
        spans = zip(starts[at:at + SHINGLES_AT_ONCE], ends[at:at + SHINGLES_AT_ONCE])
        hashes = [xxhash.xxh64_intdigest(joined[i:j], SEED) for i, j in spans]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    packed = np.packbits(counts * 2 > len(ends))
    return int.from_bytes(packed.tobytes(), "big", signed=True)


def _fingerprints(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in T.portions(batches):
        prints = pa.array([fingerprint(t, width) for t in T.raw(batch)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], ["doc_id", "print"])


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, print) of every row of `docs`."""
    return T.texts(docs).mapInArrow(partial(_fingerprints, width=width), "doc_id long, print long")


def lookups(max_bits: int) -> list[tuple[int, int, int, int]]:
    """(table, mask, flip, lowest flipped bit) of every look-up a fingerprint makes.

    A segment is all of a fingerprint but one of four blocks. Two fingerprints at `max_bits` or
    fewer differ most in some block; leaving that block out, at most `max_bits` less a quarter of
    it (rounded up) differ in the rest, the radius of the ball that is enumerated there. Among
    equal blocks the first is left out, so a ball needs only the flips that agree with that.
    """
    radius = max_bits - -(-max_bits // BLOCKS)
    out = []
    for block in range(BLOCKS):
        inside = [b for b in range(64) if b // BLOCK_BITS != block]
        mask = sum(1 << b for b in inside)
        for size in range(radius + 1):
            left = max_bits - size
            for bits in combinations(inside, size):
                hits = [sum(b // BLOCK_BITS == i for b in bits) for i in range(BLOCKS)]
                if all(h <= left - (i < block and h > 0) for i, h in enumerate(hits)):
                    flip = sum(1 << b for b in bits)
                    out.append((block, mask, flip, flip & -flip))
    return [tuple(_signed(x) for x in row) for row in out]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """(print, other): pairs of distinct fingerprints that differ in `max_bits` bits or fewer.

    Each pair is found at least once. A look-up key holds 48 of the 64 bits, so a table entry
    holds only fingerprints that agree in those.
    """
    names = ("table", "mask", "flip", "lowest")
    rows = [F.struct(*(F.lit(v).cast("long").alias(n) for n, v in zip(names, row)))
            for row in lookups(max_bits)]
    fp = F.col("print")
    # Of two fingerprints that differ in a flipped bit, the one that has it set looks the other up.
    own = F.filter(F.array(*rows), lambda r: (r.flip == 0) | (fp.bitwiseAND(r.lowest) != 0))
    probe = F.transform(own, lambda r: F.struct(
        r["table"].alias("table"), fp.bitwiseXOR(r.flip).bitwiseAND(r.mask).alias("key")))
    masks = {row[0]: row[1] for row in lookups(0)}
    entry = F.array(*(
        F.struct(F.lit(t).cast("long").alias("table"), fp.bitwiseAND(F.lit(m)).alias("key"))
        for t, m in masks.items()))
    probes = prints.select("print", F.inline(probe))
    entries = prints.select(fp.alias("other"), F.inline(entry))
    near = F.bit_count(fp.bitwiseXOR(F.col("other"))) <= max_bits
    same = (probes["table"] == entries["table"]) & (probes["key"] == entries["key"])
    return probes.join(entries, same & near & (fp != F.col("other"))).select("print", "other")


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs`.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; shingles of `width`
    words keep their repeats; a text of fewer words is one shingle; a null text or one without
    words has fingerprint zero, which links like any other. Documents link at `max_bits` or fewer
    differing bits. `component_id` is the smallest `doc_id` of all that can be reached, ignoring
    null ids (null where a component has none else). Repeated rows and ids each give a row.

    Rows are grouped by fingerprint first, so a group of copies of any size is one node. Only
    fingerprints that look each other up meet in a join, and no group emits all its pairs.
    """
    prints = cut(fingerprints(docs, width), "prints")
    nodes = cut(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("print"), max_bits)).withColumnRenamed("node", "print")
    rooted = nodes.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    rooted = cut(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("print", "component_id")
    named = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return prints.join(labels, "print").select("doc_id", named, "component_id")


def keep_first(docs: DataFrame, width: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of `docs` whose id is the smallest of their group, all columns as they were.

    Rows are told apart by id: rows that repeat a kept id stay with it, and rows without an id,
    which no other can stand for, all stay.
    """
    grouped = near_duplicates(docs, width, max_bits)
    keep = grouped.where("doc_id = component_id").select("doc_id").distinct()
    mark = T.fresh(docs, "kept_id")
    kept = docs.join(keep.withColumnRenamed("doc_id", mark),
                     F.col("doc_id").cast("long") == F.col(mark), "left_semi")
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
