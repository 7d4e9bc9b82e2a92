"""Quality rules: counts per document, and its distance from how its language is written."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial, reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm import text as T
from barloom.session import cut

WINDOW = 5
LOWER, UPPER, DIGIT, SPACE, MARK, SYMBOL, LETTER, CONTROL, INNER = range(9)
CLASSES = 8  # INNER, the later bytes of a code point, counts nowhere
LETTERS = (LOWER, UPPER, LETTER, MARK)


def _classes() -> np.ndarray:
    """The class of each byte of UTF-8; a code point beyond ASCII counts at its first byte."""
    of = np.full(256, MARK)
    of[:32] = of[127] = CONTROL
    of[97:123], of[65:91], of[48:58], of[128:192], of[192:] = LOWER, UPPER, DIGIT, INNER, LETTER
    of[list(b" \t\n\v\f\r")] = SPACE
    of[list(b"#*$%&|<>")] = SYMBOL
    return of


CLASS = _classes()


@dataclass(frozen=True)
class Rules:
    """Limits of the rules. A distance may exceed its base by what chance adds to a short text:
    the limit for n characters or words is base + noise / sqrt(n). Texts under a minimum are not
    judged by that histogram. A word is common from `share` of a language's words on. A language
    has a reference if at least `reference_documents` different texts with `reference_words` words
    in all are in it, and `letter_percent` of what they show are letters or punctuation. References
    of `languages` languages at a time go to the tasks; more take more passes over the texts."""

    min_words: int = 10
    repeat_percent: int = 20
    min_chars: int = 200
    min_common: int = 50
    chars_base: float = 0.12
    chars_noise: float = 3.2
    words_base: float = 0.12
    words_noise: float = 1.6
    share: float = 0.005
    reference_documents: int = 30
    reference_words: int = 1000
    letter_percent: int = 75
    languages: int = 1000
    buckets: int = 4096
    flush: int = 100_000


def _char_counts(text: bytes) -> np.ndarray:
    return np.bincount(CLASS[np.frombuffer(text, np.uint8)], minlength=CLASSES + 1)[:CLASSES]


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    groups: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), T.raw(batch)):
        groups.setdefault(lang or "", []).append(text)
    yield from groups.items()


def _profile(batches: Iterable[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """Per language: characters by class (slots below CLASSES), words by hash bucket, and in the
    last slot the texts that have words."""
    totals: dict[str, np.ndarray] = {}

    def flush():
        rows = [(lang, s, n) for lang, t in totals.items() for s, n in enumerate(t.tolist()) if n]
        totals.clear()
        langs, slots, counts = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(slots, pa.int64()), pa.array(counts, pa.int64())],
            ["lang", "slot", "n"])

    for batch in T.portions(batches):
        for lang, texts in _by_language(batch):
            total = totals.setdefault(lang, np.zeros(CLASSES + rules.buckets + 1, np.int64))
            total[:CLASSES] += _char_counts(b" ".join(texts))
            total[SPACE] -= len(texts) - 1
            total[-1] += sum(1 for t in texts if t.split(None, 1))
            for word, n in Counter(chain.from_iterable(t.split() for t in texts)).items():
                total[CLASSES + zlib.crc32(word) % rules.buckets] += n
        if len(totals) > 64:
            yield flush()
    yield flush()


def _candidates(
    batches: Iterable[pa.RecordBatch], heavy: dict[str, set[int]], rules: Rules
) -> Iterator[pa.RecordBatch]:
    """Counts of the words in heavy buckets, summed in the task as far as memory is bounded."""
    counts: Counter = Counter()

    def flush():
        langs, words = zip(*counts) if counts else ((), ())
        out = pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.binary()),
             pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"])
        counts.clear()
        return out

    for batch in T.portions(batches):
        for lang, texts in _by_language(batch):
            keep = heavy.get(lang, ())
            if keep:
                for word, n in Counter(chain.from_iterable(t.split() for t in texts)).items():
                    if zlib.crc32(word) % rules.buckets in keep:
                        counts[lang, word] += n
        if len(counts) > rules.flush:
            yield flush()
    yield flush()


@dataclass(frozen=True)
class Reference:
    """How a language is written: shares of character classes, and of its common words with all
    the others as the last entry."""

    lang: str
    chars: np.ndarray
    words: list[bytes]
    shares: np.ndarray


def _language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(""))


def once(docs: DataFrame) -> DataFrame:
    """(text, lang): each text of `docs` once per language, so copies do not bend a reference.

    Texts are told apart by a 64-bit hash. Only copied texts are exchanged as long as the table of
    their hashes is small enough for the planner to broadcast.
    """
    rows = docs.select("text", _language().alias("lang")).withColumn("hash", F.xxhash64("text"))
    key = ["lang", "hash"]
    copied = cut(rows.groupBy(key).count().where("count > 1").select(key), "copied")
    firsts = cut(rows.join(copied, key, "left_semi").dropDuplicates(key).select("text", "lang"), "firsts")
    return rows.join(copied, key, "left_anti").select("text", "lang").unionAll(firsts)


def languages(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """(lang, slots, words) of the languages in `rows` (text, lang) that have a reference.

    Nothing but a language's own texts decides whether it has one. Texts without a language have
    none: a mix of languages is like no text.
    """
    profile = rows.where("lang <> ''").mapInArrow(partial(_profile, rules=rules), "lang string, slot long, n long")
    slots = profile.groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    slots = slots.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("slot", "n"))).alias("slots"))

    def total(wanted):
        return F.aggregate(F.map_entries("slots"), F.lit(0).cast("long"),
                           lambda a, e: a + F.when(wanted(e["key"]), e["value"]).otherwise(0))

    texts = F.coalesce(F.element_at("slots", F.lit(CLASSES + rules.buckets).cast("long")), F.lit(0))
    visible = total(lambda s: (s < CLASSES) & (s != SPACE))
    slots = slots.withColumn("words", total(lambda s: (s >= CLASSES) & (s < CLASSES + rules.buckets)))
    written = (texts >= rules.reference_documents) & (F.col("words") >= rules.reference_words)
    written &= 100 * total(lambda s: s.isin(*LETTERS)) >= rules.letter_percent * visible
    return cut(slots.where(written), "profiles")


def references(rows: DataFrame, rules: Rules = Rules(), profiles: DataFrame | None = None) -> list[Reference]:
    """References of the languages of `profiles`, or of all that have one, in `rows` (text, lang),
    counted over all rows.

    Words are first counted in hash buckets. A common word makes its bucket heavy, so a second
    pass needs exact counts only for the words of the few heavy buckets. What reaches the driver
    is 4096 buckets and at most 1 / share words of each language.
    """
    profiles = (languages(rows, rules) if profiles is None else profiles).collect()
    heavy = {p.lang: {s - CLASSES for s, n in p.slots.items()
                      if CLASSES <= s < CLASSES + rules.buckets and n >= rules.share * p.words} for p in profiles}
    counted = rows.mapInArrow(partial(_candidates, heavy=heavy, rules=rules),
                              "lang string, word binary, n long")
    sizes = F.create_map(*chain.from_iterable((F.lit(p.lang), F.lit(p.words)) for p in profiles)) \
        if profiles else F.create_map().cast("map<string,bigint>")
    common = (
        counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= rules.share * F.element_at(sizes, F.col("lang")))
        .collect()
    )
    out = []
    for p in sorted(profiles, key=lambda p: p.lang):
        chars = np.array([p.slots.get(c, 0) for c in range(CLASSES)], float)
        own = sorted((bytes(r.word), r.n) for r in common if r.lang == p.lang)
        shares = np.array([n for _, n in own] + [p.words - sum(n for _, n in own)], float)
        out.append(Reference(p.lang, chars / chars.sum(), [w for w, _ in own], shares / p.words))
    return out


def divergence(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """The Jensen-Shannon distance (base 2, 0 to 1) of each row of counts from a distribution;
    a row without counts is at 1."""
    totals = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(totals, 1)
    middle = (p + reference) / 2

    def part(a):
        a = np.broadcast_to(a, middle.shape)
        ratio = np.divide(a, middle, out=np.ones_like(middle), where=a > 0)
        return np.sum(a * np.log2(ratio), axis=1)

    distance = np.sqrt(np.maximum((part(p) + part(reference)) / 2, 0))
    return np.where(totals[:, 0] > 0, distance, 1.0)


def _repeated(ids: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """Per text the words inside windows of WINDOW words that its own text holds more than once.

    Windows are numbered exactly: pairs, then pairs of pairs, then the fifth word and the text.
    """
    out = np.zeros(rows, np.int64)
    n = len(ids) - WINDOW + 1
    if n <= 0:
        return out
    size = np.int64(ids.max() + 1)
    pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
    fours = np.unique(pairs[:-2] * np.int64(len(ids)) + pairs[2:], return_inverse=True)[1]
    inside = np.flatnonzero(owner[:n] == owner[WINDOW - 1:])
    fives = np.unique(fours[inside] * size + ids[inside + WINDOW - 1], return_inverse=True)[1]
    key = fives * np.int64(rows) + owner[inside]
    _, where, counts = np.unique(key, return_inverse=True, return_counts=True)
    edge = np.zeros(len(ids) + 1, np.int64)
    starts = inside[counts[where] > 1]
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(owner[covered], minlength=rows)


def _dup_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines))


COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long",
    "n_repeat_words": "long", "char_distance": "double", "word_distance": "double",
    "base_failed": "boolean", "kept": "boolean",
}


def measures(
    texts: list[bytes], refs: list[Reference], rules: Rules, langs: list[str]
) -> dict[str, np.ndarray]:
    """The columns of COLUMNS for some texts in `langs`; distances are NaN without a reference."""
    rows = len(texts)
    split = [t.split() for t in texts]
    n_words = np.array([len(w) for w in split], np.int64)
    owner = np.repeat(np.arange(rows), n_words)
    number: dict[bytes, int] = {}
    flat = list(chain.from_iterable(split))
    for word in flat:
        number.setdefault(word, len(number))
    ids = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    chars = np.array([_char_counts(t) for t in texts]).reshape(rows, CLASSES)
    repeats = _repeated(ids, owner, rows)
    far_chars, far_words = np.full(rows, np.nan), np.full(rows, np.nan)
    own: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        own.setdefault(lang, []).append(i)
    for ref in refs:
        if ref.lang in own:
            at = np.array(own[ref.lang])
            width = len(ref.words) + 1
            column = np.full(len(number), width - 1)
            for c, word in enumerate(ref.words):
                if word in number:
                    column[number[word]] = c
            row = np.full(rows, -1)
            row[at] = np.arange(len(at))
            inside = row[owner] >= 0
            counts = np.bincount(row[owner[inside]] * width + column[ids[inside]], minlength=len(at) * width)
            far_words[at] = divergence(counts.reshape(len(at), width), ref.shares)
            far_chars[at] = divergence(chars[at], ref.chars)
    n_chars = chars.sum(axis=1)
    limit_chars = rules.chars_base + rules.chars_noise / np.sqrt(np.maximum(n_chars, 1))
    limit_words = rules.words_base + rules.words_noise / np.sqrt(np.maximum(n_words, 1))
    failed = (n_words < rules.min_words) | (100 * repeats > rules.repeat_percent * n_words)
    strange = (n_chars >= rules.min_chars) & (far_chars > limit_chars)
    strange |= (n_words >= rules.min_common) & (far_words > limit_words)
    visible, letters = n_chars - chars[:, SPACE], chars[:, LETTERS].sum(axis=1)
    strange |= np.isnan(far_chars) & (n_chars >= rules.min_chars) & (100 * letters < rules.letter_percent * visible)
    return {
        "n_words": n_words,
        "word_chars": visible,
        "n_symbols": chars[:, SYMBOL],
        "n_dup_lines": np.array([_dup_lines(t) for t in texts], np.int64),
        "n_repeat_words": repeats,
        "char_distance": far_chars,
        "word_distance": far_words,
        "base_failed": failed,
        "kept": ~failed & ~strange,
    }


def _judge(batches: Iterable[pa.RecordBatch], refs, rules) -> Iterator[pa.RecordBatch]:
    for batch in T.portions(batches):
        found = measures(T.raw(batch), refs, rules, batch.column("lang").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, from_pandas=True) for c in found.values())], ["doc_id", *found])


def _passes(docs: DataFrame, rules: Rules) -> Iterator[tuple[Column, list[Reference]]]:
    """Which rows of a table with the column `lang` a pass takes, and the references it needs."""
    rows = once(docs)
    found = languages(rows, rules)
    passes = -(-found.count() // rules.languages)
    for i in range(max(passes, 1)):
        here = F.pmod(F.xxhash64(_language()), F.lit(passes)) == i if passes > 1 else F.lit(True)
        yield here, references(rows.where(here), rules, found.where(here))


def judge(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of `docs` (doc_id, text, lang): the counts, distances and verdict.

    Words are runs of anything but ASCII white space. A text fails when it has too few words or
    too many of them lie in repeated windows of five. One that does not fail is kept unless its
    character classes or its common words are further than chance allows from the reference of its
    language, which comes from all its texts, copies counted once. No text has a say in the
    verdicts of another language, so what a made-up language holds changes nothing outside it. A
    text whose language has no reference (null is such a language) is held against what all
    scripts share: one of `min_chars` characters goes if too few are letters or punctuation. Its
    distances are null. A null text is empty: it has no words, and fails. Texts are judged whole,
    however long. Other columns are not looked at. An empty table gives an empty table.
    """
    schema = ", ".join(["doc_id long", *(f"{c} {t}" for c, t in COLUMNS.items())])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _language().alias("lang"))
    return reduce(DataFrame.unionAll, [
        rows.where(here).mapInArrow(partial(_judge, refs=refs, rules=rules), schema)
        for here, refs in _passes(docs, rules)])


def _filter(batches: Iterable[pa.RecordBatch], refs, rules, lang: str) -> Iterator[pa.RecordBatch]:
    for batch in T.portions(batches):
        found = measures(T.raw(batch), refs, rules, batch.column(lang).to_pylist())
        yield batch.filter(pa.array(found["kept"])).drop_columns([lang])


def keep(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of `docs` that `judge` keeps, with all their columns."""
    lang = T.fresh(docs, "judged_as")
    return reduce(DataFrame.unionAll, [
        docs.where(here).withColumn(lang, _language()).mapInArrow(
            partial(_filter, refs=refs, rules=rules, lang=lang), docs.schema)
        for here, refs in _passes(docs, rules)])
