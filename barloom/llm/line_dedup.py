"""Removal of lines that nearly equal an earlier line, by an exact set-similarity join."""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import text as T
from barloom.session import cut

SIMILARITY = Fraction(4, 5)
SPACES = r"[ \t\x0B\f\r]+"
# White space besides the plain one.
ODD_SPACES = "\t\x0B\f\r"
# Words are ordered by the frequency class of their hash bucket, then by hash.
BUCKETS = 1 << 16
CLASSES = 32
HASH_BITS = 58
# Words from which a line has 128 parity bits instead of 64.
LONG = 64
# 64-bit words of the filter that picks the lines to be verified; a bound on what is broadcast.
FILTER_WORDS = 1 << 16
# A set in more than one of HOT_SHARE lines has its lines dealt out by SALTS numbers; there are
# fewer than HOT_SHARE such sets.
HOT_SHARE = 1 << 12
SALTS = 64


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, odd, line, content): the lines of each text, numbered from 0; `odd` tells whether
    the text holds white space besides plain spaces and line feeds."""
    rows = T.texts(docs).where("doc_id IS NOT NULL AND text IS NOT NULL")
    odd = F.col("text").contains(ODD_SPACES[0])
    for space in ODD_SPACES[1:]:
        odd = odd | F.col("text").contains(space)
    # Beside the generator it would be computed once per line.
    return rows.withColumn("odd", odd).select("doc_id", "odd", F.posexplode(F.split("text", "\n")).alias("line", "content"))


def _words() -> Column:
    """The words of `content`; splitting at plain spaces, where that is enough, costs less."""
    split = F.when(F.col("odd"), F.split("content", SPACES)).otherwise(F.split("content", " "))
    return F.array_remove(split, "")


def _frequency_classes(docs: DataFrame) -> Column:
    """The class of each hash bucket, 0 for the rarest words, from the counts of all words.

    Any order of words serves; words are split at spaces alone here, which costs least.
    """
    words = T.texts(docs).select(F.explode(F.split("text", " ")).alias("word"))
    bucket = F.pmod(F.xxhash64("word"), F.lit(BUCKETS))
    counts = dict(tuple(r) for r in words.groupBy(bucket).agg(F.count("*")).collect())
    classes = [min(CLASSES - 1, int(2 * math.log2(1 + counts.get(b, 0)))) for b in range(BUCKETS)]
    place = {c: i for i, c in enumerate(sorted(set(classes)))}
    # A foldable expression: the planner turns it into one array constant.
    return F.split(F.lit(",".join(str(place[c]) for c in classes)), ",").cast("array<long>")


def _tokens(words: Column, classes: Column) -> Column:
    """The distinct words as numbers in ascending order, rare ones first.

    Words are hashed once, and equal ones dropped before they get their class. Numbers that cannot
    be null are sorted as plain longs.
    """

    def token(h):
        kind = F.coalesce(F.get(classes, h.bitwiseAND(F.lit(BUCKETS - 1))), F.lit(0).cast("long"))
        return F.shiftleft(kind, HASH_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - HASH_BITS))

    hashes = F.array_distinct(F.transform(words, lambda word: F.xxhash64(word)))
    return F.sort_array(F.transform(hashes, token))


def _parity(tokens: Column) -> Column:
    """A bit for each of 64 classes of tokens that holds an odd number of them."""
    one = F.lit(1).cast("long")
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda done, t: done.bitwiseXOR(
        F.call_function("shiftleft", one, t.bitwiseAND(F.lit(63)).cast("int"))))


def _ceil(numerator: int, n: Column, denominator: int) -> Column:
    """ceil(n * numerator / denominator) for the small numbers of words in a line."""
    return F.floor((n * numerator + (denominator - 1)) / denominator).cast("int")


def _profile(share: Fraction) -> list[Column]:
    """n, bits, more and prefix of `tokens`.

    `bits` has the parities of 64 word classes; those of long lines are told apart into 128, the
    odd half of them in `more`. Two sets of enough overlap share a word of their prefixes.
    """
    n, tokens = F.size("tokens"), F.col("tokens")
    prefix = n - _ceil(share.numerator, n, share.denominator) + 1
    more = F.when(n >= LONG, _parity(F.filter(tokens, lambda t: t.bitwiseAND(F.lit(64)) != 0)))
    return [n.alias("n"), _parity(tokens).alias("bits"), more.alias("more"),
            F.slice("tokens", 1, prefix).alias("prefix")]


def _signed(docs: DataFrame, classes: Column, share: Fraction) -> DataFrame:
    """(doc_id, line, mark, sig, n, bits, more, prefix) of every line with a word.

    `mark` is a hash of the line as it is, `sig` stands for its set of words.
    """
    # A filter on the tokens would be moved below them and compute them twice.
    rows = _rows(docs).where(F.ltrim("content", F.lit(" " + ODD_SPACES)) != "").select(
        "doc_id", "line", F.xxhash64("content").alias("mark"), _tokens(_words(), classes).alias("tokens"))
    return rows.select("doc_id", "line", "mark", F.xxhash64("tokens").alias("sig"), *_profile(share))


def _index(sets: DataFrame, share: Fraction, *more: str) -> DataFrame:
    """A row per prefix word; sets so small that only their equals are alike are left out."""
    lost = share.denominator - share.numerator
    return sets.where(F.col("n") * lost >= share.numerator).select("sig", "n", "bits", "more", *more, F.posexplode("prefix").alias("at", "token"))


def _near(share: Fraction) -> Column:
    """Whether index rows x and y pass the length, position and bit filters.

    An overlap of `share` means at least a = share / (1 + share) * (n + m) common words. At the
    first word that two prefixes share, the smaller rest must reach a, which is out of reach for
    lengths that differ by too much; words in only one of the sets, at most n + m - 2 a, each flip
    one bit.
    """
    p, q = share.numerator, share.denominator
    both = F.col("x.n") + F.col("y.n")
    rest = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    flipped = F.col("x.bits").bitwiseXOR(F.col("y.bits"))
    odd = F.col("x.more").bitwiseXOR(F.col("y.more"))
    differ = F.coalesce(F.bit_count(odd) + F.bit_count(flipped.bitwiseXOR(odd)), F.bit_count(flipped))
    return (rest * (p + q) >= both * p) & (differ * (p + q) <= both * (q - p))


def _involved(sets: DataFrame, share: Fraction) -> DataFrame:
    """The sets that pass all filters with some other set; a set comes out once, however many."""
    x, y = _index(sets, share).alias("x"), _index(sets, share).alias("y")
    fits = (F.col("x.token") == F.col("y.token")) & (F.col("x.sig") != F.col("y.sig")) & _near(share)
    return x.join(y, fits, "left_semi").select("sig").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, share: Fraction) -> DataFrame:
    """(sig, match): for each later set the earliest of its candidates (sig, other) that is alike."""
    own = sets.select("sig", F.col("tokens").alias("a"))
    others = sets.select(F.col("sig").alias("other"), F.col("tokens").alias("b"), F.col("first").alias("match"))
    both = F.size(F.array_intersect("a", "b"))
    alike = both * share.denominator >= (F.size("a") + F.size("b") - both) * share.numerator
    found = pairs.distinct().join(own, "sig").join(others, "other").where(alike)
    return found.groupBy("sig").agg(F.min("match").alias("match"))


def _matched(sets: DataFrame, share: Fraction) -> DataFrame:
    """(sig, match) of the sets (sig, first, tokens, ..) that are alike an earlier one.

    Most of a group of variants are alike its earliest member, so each set is first compared with
    the earliest set of each of its prefix words, one per index row. Only those left open are then
    compared with all earlier sets, so a group of variants does not give all its pairs.
    """
    index = cut(_index(sets, share, "first"), "index")
    lead = index.groupBy("token").agg(F.min(F.struct("first", "sig", "n", "bits", "more", "at")).alias("lead"))
    x, y = index.alias("x"), lead.select("token", "lead.*").alias("y")
    fits = (F.col("x.token") == F.col("y.token")) & (F.col("y.first") < F.col("x.first")) & _near(share)
    pairs = x.join(y, fits).select(F.col("x.sig").alias("sig"), F.col("y.sig").alias("other"))
    early = cut(_verified(pairs, sets, share), "matched")
    x, y = index.join(early, "sig", "left_anti").alias("x"), index.alias("y")
    pairs = x.join(y, fits).select(F.col("x.sig").alias("sig"), F.col("y.sig").alias("other"))
    return early.unionByName(_verified(pairs, sets, share))


def _chosen(docs: DataFrame, wanted: DataFrame, classes: Column) -> DataFrame:
    """(sig, first, tokens) of the wanted lines (doc_id, line, sig).

    A filter of fixed size, one bit per hash, keeps most other lines out of the exchange, and from
    being split into words.
    """
    def place(df):
        h = F.xxhash64("doc_id", "line")
        return df.withColumns({"word": F.pmod(h, F.lit(FILTER_WORDS)), "bit": F.shiftrightunsigned(h, 58).cast("int")})

    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    words = place(wanted).groupBy("word").agg(F.bit_or(one).alias("filter"))
    held = F.call_function("shiftright", F.col("filter"), F.col("bit")).bitwiseAND(F.lit(1)) != 0
    lines = place(_rows(docs)).join(F.broadcast(words), "word").where(held)
    lines = lines.select("doc_id", "odd", "line", "content").join(wanted, ["doc_id", "line"])
    found = lines.select("sig", "doc_id", "line", _tokens(_words(), classes).alias("tokens"))
    # Rows that repeat an id may have other words at this place.
    own = F.when(F.xxhash64("tokens") == F.col("sig"), F.col("tokens"))
    return found.groupBy("sig").agg(
        F.first(F.struct("doc_id", "line")).alias("first"), F.first(own, ignorenulls=True).alias("tokens"))


def _gone(docs: DataFrame, share: Fraction) -> DataFrame:
    """(doc_id, line, mark, match): the lines that go, and an earlier line that each matches."""
    classes = _frequency_classes(docs)
    lines = cut(_signed(docs, classes, share), "lines")
    sets = lines.groupBy("sig").agg(*[F.first(c).alias(c) for c in ("n", "bits", "more", "prefix")])
    involved = cut(_involved(sets, share), "involved")
    firsts = lines.groupBy("sig").agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("copies"))
    firsts = cut(firsts, "firsts")
    wanted = cut(firsts.join(involved, "sig").select("sig", "first.doc_id", "first.line"), "wanted")
    chosen = _chosen(docs, wanted, classes)
    chosen = cut(chosen.select("sig", "first", "tokens", *_profile(share)), "chosen")
    # Lines go only by a set with a match or with several lines.
    known = firsts.where("copies > 1").join(_matched(chosen, share), "sig", "full")
    known = known.withColumn("copies", F.coalesce("copies", F.lit(1)))
    match = F.coalesce("match", F.when((F.col("doc_id") != F.col("first.doc_id"))
                                       | (F.col("line") != F.col("first.line")), F.col("first")))
    gone = _met(lines.select("doc_id", "line", "mark", "sig"), known, firsts, lines.count()).withColumn("match", match)
    return gone.where("match IS NOT NULL").select("doc_id", "line", "mark", "match")


def _met(lines: DataFrame, known: DataFrame, firsts: DataFrame, total: int) -> DataFrame:
    """`lines` joined with `known` by `sig`; the lines of a very common set meet a copy of its row
    for each of SALTS numbers."""
    common = F.col("copies") * HOT_SHARE > total
    hot = firsts.where(common).select("sig", F.lit(True).alias("hot"))
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id", "line"), F.lit(SALTS))).otherwise(0).cast("int")
    lines = lines.join(F.broadcast(hot), "sig", "left").withColumn("salt", salt).drop("hot")
    salts = F.when(common, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return lines.join(known.withColumn("salt", F.explode(salts)), ["sig", "salt"])


def matches(docs: DataFrame, share: Fraction = SIMILARITY) -> DataFrame:
    """(doc_id, line, like_doc_id, like_line): the lines that go, each with an earlier line that it
    matches.

    A line is the set of its words, runs of anything but ASCII white space. It goes if a line
    before it, in order of document id and line, has a Jaccard similarity of `share` or more with
    it; lines are judged on the input, so what goes itself still counts as earlier. Lines are
    numbered from 0 and end at line feeds. Lines without a word, null texts and documents without
    an id are left alone. Where rows repeat an id, lines of one number are equally early.

    Lines of one word set are joined once, as their earliest. Words are ordered by the frequency
    of their hash bucket, counted over all words, so frequent words hardly get into prefixes.
    Words are told apart by 58 bits of a hash, sets by 64 of another.
    """
    return _gone(docs, share).select(
        "doc_id", "line", F.col("match.doc_id").alias("like_doc_id"), F.col("match.line").alias("like_line")).distinct()


def report(docs: DataFrame, share: Fraction = SIMILARITY) -> DataFrame:
    """(doc_id, n_lines, n_removed, removed) of every document id: its lines and the numbers of
    those that go, in order, comma-joined; a null or empty text has one line."""
    gone = _gone(docs, share).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("line")).alias("removed"))
    feeds = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    lines = T.texts(docs).groupBy("doc_id").agg(
        F.max(F.coalesce(feeds, F.lit(0)) + 1).cast("long").alias("n_lines"))
    n = F.coalesce(F.size("removed"), F.lit(0)).cast("long")
    joined = F.coalesce(F.array_join(F.col("removed").cast("array<string>"), ","), F.lit(""))
    return lines.join(gone, "doc_id", "left").select(
        "doc_id", "n_lines", F.when(F.col("removed").isNull(), 0).otherwise(n).cast("long").alias("n_removed"),
        joined.alias("removed"))


def trim(docs: DataFrame, share: Fraction = SIMILARITY) -> DataFrame:
    """`docs` without the lines that go, all other columns as they were."""
    place = F.struct(F.col("line"), F.col("mark"))
    gone = _gone(docs, share).groupBy("doc_id").agg(F.collect_set(place).alias("lines"))
    key, lines = T.fresh(docs, "gone_id"), T.fresh(docs, "gone_lines")
    gone = gone.toDF(key, lines)
    kept = F.filter(F.split("text", "\n"), lambda line, at: ~F.array_contains(
        lines, F.struct(at.alias("line"), F.xxhash64(line).alias("mark"))))
    text = F.when(F.col(lines).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    joined = docs.join(gone, F.col("doc_id").cast("long") == F.col(key), "left")
    return joined.withColumn("text", text).select(*(F.col(f"`{c}`") for c in docs.columns))
