"""Secrets in texts: rules, and character Markov models of random and of ordinary strings."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules' patterns, in the order of their kinds, and the least length of a secret.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # whole runs, so shorter ones need not be found first
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

# Alphabets that random strings are written in; each has a model of its own.
WRITTEN_IN = {
    "hex": "0123456789abcdef",
    "upper hex": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "abcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-",
}
RULERS = "-=_/+"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
SPAN = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Scan:
    """Runs of `shortest` or more characters are judged. They are secrets if the log-likelihood
    ratio of random to ordinary is `per_char` for each of their characters at least, and `total` in
    all. Without `per_char` the limit is set by trial on labelled samples that were held out.

    Ordinary strings are learned from about `documents` documents chosen by hash: from their runs
    of `ordinary` or more characters, and from identifiers made of up to `identifiers` groups of
    words spread over each of these texts. Random strings of each alphabet are learned from
    `strings` drawn ones, and from the values that the rules accept in all documents."""

    shortest: int = 20
    ordinary: int = 5
    per_char: float | None = None
    total: float = 6.0
    documents: int = 2000
    identifiers: int = 10
    strings: int = 1000


def _located(text: Column, pattern: str, matches: Column, kind: str, keep) -> Column:
    """The spans, in code points, of those matches that `keep` wants by their place.

    What lies between matches, split by the same pattern, gives the places.
    """
    between = F.split(text, pattern, -1)
    nothing = F.array().cast(SPAN)

    def step(done, i):
        start = done["at"] + F.length(F.get(between, i))
        end = start + F.length(F.get(matches, i))
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))
        spans = F.when(keep(i), F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    every = F.sequence(F.lit(0), F.size(matches) - 1)
    found = F.aggregate(every, begin, step, lambda done: done["spans"])
    return F.when(F.size(matches) == 0, nothing).otherwise(found)


def _matched(rows: DataFrame) -> DataFrame:
    """`rows` with the rules' matches, and the values of assignments."""
    text = F.col("text")
    rows = rows.withColumns({
        "m_assign": F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(0)),
        "m_access": F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
        "m_hex": F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
    })
    value = F.when(F.size("m_assign") == 0, F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)))
    return rows.withColumn("v_assign", value)


def _with_base(rows: DataFrame) -> DataFrame:
    """`rows` with the arrays of spans of the rules."""
    text = F.col("text")

    def long_enough(column, least):
        return lambda i: F.length(F.get(F.col(column), i)) >= least

    return _matched(rows).withColumns({
        "assign": _located(text, ASSIGN, F.col("m_assign"), "assign", long_enough("v_assign", LEAST_ASSIGN)),
        "access": _located(text, ACCESS, F.col("m_access"), "access", long_enough("m_access", LEAST_ACCESS)),
        "hex": _located(text, HEX, F.col("m_hex"), "hex", lambda i: F.lit(True)),
    })


def _pairs(strings: DataFrame) -> dict[tuple[str, str, str], int]:
    """Counts of neighbouring characters of `s` by `kind`, at most 67 * 67 rows a kind."""
    at = F.sequence(F.lit(1), F.length("s") - 1)
    pairs = strings.where(F.length("s") > 1).select(
        "kind", F.explode(F.transform(at, lambda i: F.col("s").substr(i, F.lit(2)))).alias("pair"))
    rows = pairs.groupBy("kind", "pair").agg(F.count("*").alias("n")).collect()
    return {(r.kind, r.pair[0], r.pair[1]): r.n for r in rows}


def log_ratios(counts: dict) -> list[float]:
    """ln P(b | a, random) - ln P(b | a, ordinary) by kind of random string and places in the
    alphabet, add-one smoothed."""

    def given(kind, a):
        total = sum(counts.get((kind, a, b), 0) for b in ALPHABET) + len(ALPHABET)
        return [math.log((counts.get((kind, a, b), 0) + 1) / total) for b in ALPHABET]

    usual = {a: given("ordinary", a) for a in ALPHABET}
    return [x - y for kind in WRITTEN_IN for a in ALPHABET for x, y in zip(given(kind, a), usual[a])]


def _drawn(spark, start: int, strings: int) -> DataFrame:
    """(kind, s): random strings of 20 to 64 characters of each alphabet, drawn by a hash."""
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(v).alias("written")) for k, v in WRITTEN_IN.items()))
    rows = spark.range(start, start + strings).select("id", F.explode(kinds).alias("k")).select("id", "k.*")
    places = F.sequence(F.lit(1), F.pmod(F.xxhash64("id", "kind"), F.lit(45)).cast("int") + 20)
    letters = F.transform(places, lambda i: F.col("written").substr(
        F.pmod(F.xxhash64("id", "kind", i), F.length("written")).cast("int") + 1, F.lit(1)))
    return rows.select("kind", F.array_join(letters, "").alias("s"))


def _identifiers(texts: DataFrame, groups: int) -> DataFrame:
    """s: identifiers in usual styles, made of words that follow each other in the texts, and rulers."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z]{2,}"), F.lit(0))
    rows = texts.select("doc_id", words.alias("words")).where(F.size("words") >= 5)
    step = F.greatest(F.lit(5), F.ceil(F.size("words") / groups).cast("int"))
    rows = rows.select("doc_id", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 4, step)).alias("at"))
    w = F.slice("words", F.col("at"), 5)
    number = F.pmod(F.xxhash64("doc_id", "at"), F.lit(10_000)).cast("string")
    rows = rows.select(w.alias("w"), number.alias("number"))
    titled = F.transform("w", lambda x: F.initcap(x))
    upper = F.transform("w", lambda x: F.upper(x))
    day = F.concat(F.lit("20"), F.lpad(F.substring("number", 1, 2), 2, "1"), F.lit("-0"),
                   F.substring("number", 1, 1), F.lit("-1"), F.substring("number", -1, 1))
    rest = F.array_join(F.slice(titled, 2, 4), "")
    styles = [
        F.concat(F.get("w", F.lit(0)), rest), F.array_join(titled, ""),
        F.concat(F.upper(F.substring(F.get("w", F.lit(0)), 1, 4)), rest),
        F.concat(F.get("w", F.lit(0)), rest, "number"), F.array_join(F.col("w"), ""),
        *(F.array_join(F.col("w"), sign) for sign in "_-/="), *(F.array_join(upper, sign) for sign in "_-"),
        F.array_join(upper, ""), F.array_join(titled, "-"),
        F.concat_ws("_", F.array_join(F.slice("w", 1, 4), "_"), "number"),
        F.concat_ws("-", F.array_join(F.slice("w", 1, 3), "-"), day),
        F.concat_ws("/", day, F.array_join(F.slice("w", 1, 3), "/")),
        F.repeat(F.element_at(F.array(*map(F.lit, RULERS)), F.pmod(F.col("number").cast("int"), F.lit(len(RULERS))) + 1), F.lit(30)),
    ]
    return rows.select(F.explode(F.array(*styles)).alias("s"))


def _usual(rows: DataFrame, scan: Scan, part: int, parts: int = 8) -> DataFrame:
    """The sampled texts, of the held-out part (0) or of the others (1), without what the rules match."""
    share = min(1.0, scan.documents / max(rows.count(), 1))
    h = F.xxhash64("doc_id", F.octet_length("text"))
    chosen = F.pmod(h, F.lit(1 << 20)) < share * (1 << 20)
    held_out = F.pmod(F.shiftrightunsigned(h, 20), F.lit(parts)) == 0
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, "."), ACCESS, "."), HEX, ".")
    return rows.where(chosen & (held_out if part == 0 else ~held_out)).select("doc_id", bare.alias("text"))


def train(docs: DataFrame, scan: Scan = Scan()) -> list[float]:
    """The table of log ratios, by kind of random string.

    Random samples are drawn strings, and those values that the rules accept, in all documents,
    that have a digit; each counts for the first alphabet that holds it. Ordinary samples are the
    sampled documents' other runs, and identifiers made of their words.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = _matched(rows)
    values = F.concat(
        F.filter("v_assign", lambda v: F.length(v) >= LEAST_ASSIGN),
        F.filter("m_access", lambda v: F.length(v) >= LEAST_ACCESS), "m_hex")
    kind = F.coalesce(*(F.when(F.col("s").rlike(f"^[{v.replace('-', '')}{'-' if '-' in v else ''}]+$"), k)
                        for k, v in WRITTEN_IN.items()))
    accepted = found.select(F.explode(values).alias("s")).where(F.col("s").rlike("[0-9]"))
    usual = _usual(rows, scan, 1)
    runs = usual.select(F.explode(F.regexp_extract_all("text", F.lit(RUN % scan.ordinary), F.lit(0))).alias("s"))
    plain = runs.unionByName(_identifiers(usual, scan.identifiers)).select(F.lit("ordinary").alias("kind"), "s")
    random = accepted.select(kind.alias("kind"), "s").where("kind IS NOT NULL")
    return log_ratios(_pairs(plain.unionByName(random).unionByName(_drawn(docs.sparkSession, 0, scan.strings))))


def fitted(docs: DataFrame, ratios: list[float], scan: Scan = Scan()) -> Scan:
    """`scan` with its limit: halfway between what 999 of 1,000 held-out ordinary strings stay
    below and what 99 of 100 held-out random ones reach, or the former where the two overlap.

    Without ordinary samples that are long enough nothing can be told apart, and 1 a character is
    the limit.
    """
    if scan.per_char is not None:
        return scan
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    usual = _usual(rows, scan, 0)
    runs = usual.select(F.explode(F.regexp_extract_all("text", F.lit(RUN % scan.shortest), F.lit(0))).alias("s"))
    plain = runs.unionByName(_identifiers(usual, max(1, scan.identifiers // 2))).where(F.length("s") >= scan.shortest)
    random = _drawn(docs.sparkSession, scan.strings, max(1, scan.strings // 4))
    samples = plain.select(F.lit("ordinary").alias("kind"), "s").unionByName(random)
    runs = _ratios(samples.select((F.col("kind") == "ordinary").alias("ordinary"), F.array("s").alias("runs")), "runs", ratios)
    each = runs.select("ordinary", (F.get("ratios", F.lit(0)) / F.length(F.get("runs", F.lit(0)))).alias("x"))
    shares = dict(tuple(r) for r in each.groupBy("ordinary").agg(F.percentile_approx("x", [0.01, 0.999], 10_000)).collect())
    low, high = shares.get(True, (None, None))[1], shares.get(False, (None, None))[0]
    limit = 1.0 if low is None or high is None else low if high < low else (low + high) / 2
    return replace(scan, per_char=limit)


def _table(ratios: list[float]) -> Column:
    """A foldable expression: the planner turns it into one array constant."""
    return F.split(F.lit(",".join(f"{r:.4f}" for r in ratios)), ",").cast("array<double>")


def _places(run: Column) -> Column:
    """The places of neighbouring characters of a run of the alphabet in a table of ratios."""
    places = F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    codes = F.filter(places, lambda p: p >= 0)
    return F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes)),
                      lambda a, b: a * len(ALPHABET) + b)


def _ratios(rows: DataFrame, runs: str, ratios: list[float]) -> DataFrame:
    """`rows` with `ratios`: for each of the `runs` the summed log ratio by the kind of random
    string that fits best."""
    table = _table(ratios)

    def summed(places, first):
        return F.aggregate(places, F.lit(0.0), lambda done, p: done + F.coalesce(F.get(table, p + first), F.lit(0.0)))

    # A column of its own, or each kind would compute the places anew.
    rows = rows.withColumn("places", F.transform(runs, _places))
    return rows.withColumn("ratios", F.transform("places", lambda p: F.greatest(
        *(summed(p, first) for first in range(0, len(ratios), len(ALPHABET) ** 2)), F.lit(float("-inf")))))


def _shown(spans: Column) -> Column:
    """kind:start:end of spans by start and kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find(docs: DataFrame, ratios: list[float], scan: Scan = Scan()) -> DataFrame:
    """(doc_id, assign, access, hex, markov) of every row: arrays of spans in code points."""
    rows = _with_base(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                  F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    least = 0.0 if scan.per_char is None else scan.per_char
    pattern = RUN % scan.shortest
    rows = rows.withColumn("m_run", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    rows = _ratios(rows, "m_run", ratios)

    def random(i):
        ratio, size = F.get(F.col("ratios"), i), F.length(F.get(F.col("m_run"), i))
        return (ratio >= scan.total) & (ratio >= least * size)

    rows = rows.withColumn("runs", _located(F.col("text"), pattern, F.col("m_run"), "markov", random))
    base = F.concat("assign", "access", "hex")
    alone = F.filter("runs", lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return rows.select("doc_id", "assign", "access", "hex", alone.alias("markov"))


def report(docs: DataFrame, scan: Scan = Scan()) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans) of every row of `docs`.

    Matches of a rule are leftmost and do not overlap; too short ones are dropped after matching.
    The models add runs that overlap no span of the rules. A null text is empty; a very long one is
    scanned whole, its ordinary runs count in training like others; repeated rows and ids each give
    a row; an empty table gives none; other columns are not looked at. Random strings are drawn for
    each alphabet, so the models need no match of the rules.
    """
    ratios = train(docs, scan)
    found = find(docs, ratios, fitted(docs, ratios, scan))
    base = F.concat("assign", "access", "hex")
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.encode(_shown(base), "UTF-8"), 256).alias("base_sha256"),
        _shown(F.concat(base, "markov")).alias("spans"),
    )
