"""Merkle manifest: a digest per document, a tree per language, one root over all, and proofs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import text as T
from barloom.session import cut

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 2
PATH = "array<struct<slot:int,others:array<binary>>>"


def field(value: Column) -> Column:
    """A value as its UTF-8 length, a colon and its text; `-` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest of a record."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _run(own: Column, slot: Column, others: Column) -> Column:
    """The digest of a run of nodes: `own` (as text) with the `others` before and after its slot."""
    texts = F.transform(others, _hex)
    return F.sha2(F.array_join(F.concat(
        F.slice(texts, 1, slot), F.array(own), F.slice(texts, slot + 1, F.size(others))), ""), 256)


def fold(own: Column, path: Column) -> Column:
    """The root that a leaf (as text) and the siblings on its path give."""
    return F.aggregate(path, own, lambda digest, step: _run(digest, step["slot"], step["others"]))


def proof(path: Column) -> Column:
    """The digest of all siblings on a path, level by level, left to right."""
    siblings = F.flatten(F.transform(path, lambda step: step["others"]))
    return F.sha2(F.array_join(F.transform(siblings, _hex), ""), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with `idx`, the place in their `tree` by `order`, and `n`, the tree's size.

    Rows are range-partitioned and sorted once, so a tree may span any number of tasks; the
    written place in the partition and one row per (tree, partition) give the place in the tree.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    dealt = cut(dealt.withColumn("place", F.monotonically_increasing_id()), "dealt")
    dealt = dealt.withColumn("part", F.shiftright("place", 33))
    runs = dealt.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("size"))
    whole = Window.partitionBy("tree")
    before = F.sum("size").over(whole.orderBy("part")) - F.col("size")
    runs = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("size").over(whole).alias("n"))
    return (
        dealt.join(runs, ["tree", "part"])
        .withColumn("idx", F.col("place") + F.col("shift"))
        .drop("place", "part", "shift")
    )


def _siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Each node with its `slot` in its run and the `others` of the run, by self-joins on the
    computed index of each sibling."""
    rows = nodes.withColumn("slot", (F.col("idx") % arity).cast("int"))
    found = []
    for offset in range(1, arity):
        slot = (F.col("slot") + offset) % arity
        at = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - F.col("slot") + slot
        shifted = nodes.select("tree", F.col("idx").alias("at"), F.col("digest").alias(f"other{offset}"))
        rows = rows.withColumn("at", at).join(shifted, ["tree", "at"], "left").drop("at")
        found.append(F.struct(slot.alias("slot"), F.col(f"other{offset}").alias("digest")))
    run = F.filter(F.array_sort(F.array(*found)), lambda o: o["digest"].isNotNull())
    return rows.withColumn("others", F.transform(run, lambda o: o["digest"])).drop(
        *(f"other{offset}" for offset in range(1, arity)))


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """The nodes above a level, emitted by the rows of slot zero."""
    return level.where((F.col("slot") == 0) & (F.col("n") > 1)).select(
        "tree",
        F.floor(F.col("idx") / arity).alias("idx"),
        F.ceil(F.col("n") / arity).alias("n"),
        F.unhex(_run(_hex(F.col("digest")), F.col("slot"), F.col("others"))).alias("digest"),
    )


def grow(leaves: DataFrame, arity: int = ARITY) -> tuple[DataFrame, DataFrame]:
    """The trees over numbered `leaves` (tree, idx, n, digest, other columns).

    Returns the leaves with their `path`, the siblings from the leaf up, and (tree, digest) of the
    roots. Every level is one self-join, written once: a level is a fixed fraction of the one
    below, so all of them together are about as large as the leaves. The paths are then handed
    down, each level joining the one above it.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels = [cut(_siblings(leaves, arity), "level")]
    tops = [leaves]
    while most > 1:
        nodes = _parents(levels[-1], arity)
        tops.append(nodes)
        most = -(-most // arity)
        if most > 1:
            levels.append(cut(_siblings(nodes.where("n > 1"), arity), "level"))
    roots = None
    for nodes in tops:
        done = nodes.where("n = 1").select("tree", "digest")
        roots = done if roots is None else roots.unionAll(done)
    none = F.array().cast(PATH)
    above = None
    for level in reversed(levels):
        step = F.array(F.struct("slot", "others")).cast(PATH)
        if above is None:
            paths = level.withColumn("path", F.when(F.col("n") > 1, step).otherwise(none))
        else:
            paths = level.withColumn("up", F.floor(F.col("idx") / arity)).join(above, ["tree", "up"], "left")
            rest = F.coalesce("upper", none)
            paths = paths.withColumn("path", F.when(F.col("n") > 1, F.concat(step, rest)).otherwise(none))
        above = paths.select("tree", F.col("idx").alias("up"), F.col("path").alias("upper"))
    return paths.drop("slot", "others", "up", "upper", "idx", "n"), cut(roots, "roots")


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = COLUMNS, tree: str = "lang", key: str = "doc_id",
    carry: tuple[str, ...] = (), arity: int = ARITY,
) -> DataFrame:
    """(key, leaf, subroot, root, path, carried columns), one row per row of `docs`.

    A leaf is the digest of `columns`, whatever their length; a null counts as a value of its own.
    Leaves of one `tree` value ascend by the key and every `arity` consecutive nodes give the
    digest above them, up to the subroot. Subroots in the order of the tree values, null first,
    give the root the same way. Rows without a key come first; rows of the same key are ordered by
    their digest, and equal records stand side by side in any order. Columns not named are not
    looked at, and an empty table gives no rows.
    """
    values = [F.col(c) for c in columns]
    named = F.col(tree).cast("string")
    rows = docs.select(
        F.when(named.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), named)).alias("tree"),
        F.col(key).alias("key"),
        F.unhex(leaf(*values)).alias("digest"),
        F.struct(F.col(key), *map(F.col, carry)).alias("carried"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = numbered(cut(rows, "leaves"), ["key", "digest", "row"]).drop("key", "row")
    leaves, subroots = grow(rows, arity)
    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("below"), "digest")
    tops, roots = grow(numbered(tops, ["below"]), arity)
    tops = tops.join(roots.withColumnRenamed("digest", "root"), "tree").select(
        F.col("below").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("path").alias("upper"))
    return leaves.join(tops, "tree").select(
        F.col(f"carried.`{key}`").alias(key),
        _hex(F.col("digest")).alias("leaf"),
        _hex(F.col("subroot")).alias("subroot"),
        _hex(F.col("root")).alias("root"),
        F.concat("path", "upper").alias("path"),
        *[F.col(f"carried.`{c}`").alias(c) for c in carry],
    )


def verify(rows: DataFrame, claimed: str = "leaf", path: str = "path") -> DataFrame:
    """A manifest's rows with `folded_root`, what the `claimed` leaf and the path give, and
    whether it is the root."""
    folded = rows.withColumn("folded_root", fold(F.col(claimed), F.col(path)))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def audit(docs: DataFrame) -> DataFrame:
    """The manifest's digests per document, with one in seven records claimed with a changed count.

    A record is changed where 7 divides the CRC-32 of its decimal id: its `n_chars`, unless null,
    is claimed to be one more. A row without an id is not changed.
    """
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    values = [F.when(hit, more).otherwise(F.col(c).cast("string")) if c == "n_chars" else F.col(c) for c in COLUMNS]
    name = T.fresh(docs, "claimed")
    rows = docs.withColumn(name, F.unhex(leaf(*values)))
    checked = verify(manifest(rows, carry=(name,)).withColumn("claim", _hex(F.col(name))), "claim")
    return checked.select(
        F.col("doc_id").cast("long").alias("doc_id"), "leaf", "subroot", "root",
        proof(F.col("path")).alias("proof_sha256"), "folded_root", "verified")
