"""Operators against plain versions of what they promise, on small data."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from barloom import session
from barloom.llm import (chunks, decontam, line_dedup, pieces, ppm, quality, secret_scan, shards, simhash,
                         suffix_dedup, url_filter)
from barloom.llm.components import components
from barloom.llm.text import table
from tests.llm.conftest import prose, sorted_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def corpus(spark, testdata):
    return table(spark, testdata, "documents").where("doc_id < 120")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# Sharding

def test_shards_differ_by_one_row_and_slots_have_no_gaps(corpus):
    rows = shards.assign_documents(corpus, 7).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = dict(pairs(corpus))
    assert all(r.size == len(texts[r.doc_id].encode()) + 8 for r in rows)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.hilbert for r in order] == sorted(r.hilbert for r in rows)


def test_an_outlying_id_and_a_hot_id_make_no_large_task(spark, monkeypatch):
    largest = []

    def watched(df, name="cut"):
        out = session.cut(df, name)
        if name == "shard-order":
            largest.append(out.groupBy(F.shiftright("_place", 33)).count().agg(F.max("count")).first()[0])
        return out

    monkeypatch.setattr(shards, "cut", watched)
    ids = [*range(2000), 2**62, *[7] * 1000]
    rows = spark.createDataFrame([(i, "same text", "en", "s") for i in ids], "doc_id long, text string, lang string, source string")
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")  # small partitions would be read together
    try:
        got = shards.assign_documents(rows.repartition(3), 7).collect()
    finally:
        spark.conf.unset(merged)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert parts > 1 and max(largest) <= 1.6 * len(ids) / parts
    sizes = Counter(r.shard for r in got)
    assert len(got) == len(ids) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in sizes.items())


def test_curve_visits_neighbours(spark):
    axes = [F.shiftright("id", 4 * i).bitwiseAND(F.lit(15)).cast("long").alias(f"a{i}") for i in range(3)]
    cells = spark.range(1 << 12).select(*axes)
    cells = cells.withColumn("h", shards._curve([F.col(f"a{i}") for i in range(3)]))
    rows = [tuple(r) for r in cells.orderBy("h").collect()]
    assert [r[-1] for r in rows] == list(range(1 << 12))
    assert all(sum(abs(a - b) for a, b in zip(x[:-1], y[:-1])) == 1 for x, y in zip(rows, rows[1:]))


def test_more_files_prune_by_every_dimension(spark, corpus, tmp_path):
    slim = corpus.select("doc_id", F.length("text").alias("size"), "lang", "source")
    shards.write(shards.assign(slim, 4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == corpus.count()


# Secrets

RULES = (
    re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    re.compile(r"(AKIA[A-Z0-9]+)"), re.compile(r"([0-9a-f]+)"))
LEAST = (12, 18, 16)


def secret_spans(text):
    found = [(m.start(), k, m.end()) for k, rule in enumerate(RULES) for m in rule.finditer(text) if len(m[1]) >= LEAST[k]]
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secret_rules(corpus, docs):
    rng = random.Random(4)
    parts = ["Password", "token", "api_key", "apikey", "=", ":", " ", '"', "é", "AKIA", "ABCDEFGH12345678",
             "0123456789abcdef", "ff", "😀", "\n", "secret=", "x-y.z", "a1b2c3d4e5f6"]
    made = docs([(1000 + i, "".join(rng.choice(parts) for _ in range(rng.randrange(30)))) for i in range(200)])
    rows = corpus.select(made.columns).union(made)
    texts = dict(pairs(rows))
    for r in secret_scan.find(rows, [0.0] * len(secret_scan.ALPHABET) ** 2).collect():
        spans = sorted((s.start, s.kind, s.end) for s in r["assign"] + r["access"] + r["hex"])
        assert ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans) == secret_spans(texts[r.doc_id])
        assert r["markov"] == []


def test_models_find_random_runs_and_leave_words(docs):
    rng = random.Random(8)
    random_run = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f"{prose(i, 80)} token={random_run(40)}") for i in range(60)]
    key = "".join(rng.choice("0123456789abcde") + rng.choice("0123456789") for _ in range(16)) + "_" + random_run(12)
    rows += [(100, f"{prose(100)} {key.replace('_', 'Z')[:14]}-{random_run(14)} {prose(101)}"),
             (101, prose(102) + " walkedundersevenbridgeswhilenobody " + prose(103))]
    got = {r.doc_id: r for r in secret_scan.report(docs(rows)).collect()}
    assert got[100].n_markov == 1 and got[101].n_markov == 0
    assert all(got[i].spans == secret_spans(t) and got[i].n_assign == 1 for i, t in rows[:60])


# Styles of names that are no secrets.
ORDINARY = (
    "thisIsAnOrdinaryCamelCaseIdentifierName", "AbstractSingletonProxyFactoryBean", "max_retries_per_connection_pool",
    "MAXIMUM_NUMBER_OF_CONNECTIONS", "some-kebab-case-component-name", "src/main/java/org/example/service",
    "internationalizationandlocalization", "HTTPRequestHandlerFactory", "release-notes-2023-04-17-final",
    "--------------------------------", "================================", "getUserAccountBalanceById2",
    "data/processed/training/batch_0012", "Content-Security-Policy-Report-Only")


def test_models_tell_random_runs_from_names(corpus, docs):
    """Recall on random runs of each alphabet, and no name taken, as one brute-force log ratio tells."""
    rng = random.Random(12)
    ratios = secret_scan.train(corpus)
    scan = secret_scan.fitted(corpus, ratios)
    made = [(kind, "".join(rng.choice(letters) for _ in range(rng.randrange(20, 65))))
            for kind, letters in secret_scan.WRITTEN_IN.items() for _ in range(100)]
    made += [("name", name) for name in ORDINARY]
    rows = docs([(i, f"é {s} {prose(i, 5)}") for i, (_, s) in enumerate(made)])
    got = {r.doc_id: r for r in secret_scan.find(rows, ratios, scan).collect()}
    place, square = {c: i for i, c in enumerate(secret_scan.ALPHABET)}, len(secret_scan.ALPHABET) ** 2
    caught = Counter()
    for i, (kind, s) in enumerate(made):
        best = max(sum(round(ratios[first + place[a] * 67 + place[b]], 4) for a, b in zip(s, s[1:]))
                   for first in range(0, len(ratios), square))
        margin = min(best - scan.total, best - scan.per_char * len(s))
        by_rule = bool(secret_spans(s))
        if abs(margin) > 1e-6 and not by_rule:
            assert [(m.start, m.end) for m in got[i].markov] == ([(2, 2 + len(s))] if margin > 0 else []), s
        caught[kind] += bool(got[i].markov) or by_rule
    assert caught["name"] == 0, [s for i, (k, s) in enumerate(made) if k == "name" and got[i].markov]
    assert all(caught[kind] >= 90 for kind in secret_scan.WRITTEN_IN), caught


# Lines

def matched_lines(rows):
    """(doc_id, line) of the lines that go, and all pairs with an earlier line they match."""
    lines = sorted({(i, k, frozenset(WORD.findall(line))) for i, t in rows if i is not None and t is not None
                    for k, line in enumerate(t.split("\n")) if WORD.search(line)}, key=lambda x: x[:2])
    pairs = {(i, k, j, m) for n, (i, k, words) in enumerate(lines) for j, m, other in lines[:n]
             if (j, m) < (i, k) and 5 * len(words & other) >= 4 * len(words | other)}
    return {p[:2] for p in pairs}, pairs


def test_lines(corpus, docs):
    rng = random.Random(6)
    bases = [prose(s, n).split() for s, n in ((1, 4), (2, 5), (3, 10), (4, 20), (5, 40), (6, 90))]
    made = []
    for i in range(150):
        lines = []
        for _ in range(rng.randrange(4)):
            words = list(rng.choice(bases))
            for _ in range(rng.randrange(1 + len(words) // 6)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(9)}"
            rng.shuffle(words)
            lines.append(" ".join(words[rng.randrange(2):]))
        made.append((1000 + i // 2 * 2, "\n".join(lines)))
    rows = corpus.where("doc_id < 60").select("doc_id", "text", "lang", "source", "n_chars").union(docs(made))
    got = {tuple(r) for r in line_dedup.matches(rows).collect()}
    gone, alike = matched_lines(pairs(rows))
    assert {r[:2] for r in got} == gone and got <= alike and len(gone) > 50


def test_a_group_of_variants_gives_no_square_of_pairs(spark, docs):
    rng, base = random.Random(3), [f"word{i}" for i in range(40)]
    rows = [(i, " ".join(w if rng.random() > 0.03 else f"v{rng.randrange(10**6)}" for w in base)) for i in range(300)]
    gone, alike = matched_lines(rows)
    got = {tuple(r) for r in line_dedup.matches(docs(rows)).collect()}
    assert {r[:2] for r in got} == gone and got <= alike


def test_a_common_line_is_dealt_out(docs, monkeypatch):
    met = []
    inner = line_dedup._met

    def watched(lines, known, firsts, total):
        met.append(inner(lines, known, firsts, total).groupBy("sig", "salt").count())
        return inner(lines, known, firsts, total)

    monkeypatch.setattr(line_dedup, "_met", watched)
    monkeypatch.setattr(line_dedup, "HOT_SHARE", 8)
    rows = [(i, f"the same line everywhere\nonly here w{i} x{i} y{i}") for i in range(1500)]
    got = {tuple(r) for r in line_dedup.matches(docs(rows)).collect()}
    assert got == {(i, 0, 0, 0) for i in range(1, 1500)}
    sizes = [r["count"] for r in met[0].collect()]
    assert len(sizes) == line_dedup.SALTS and sum(sizes) == 1500 and max(sizes) < 60


def test_chosen_lines_bring_their_place_with_one_join(docs):
    rows = docs([(1, "a b c d e\nb\tc  d\x0be"), (1, "f g h i j\n  \n"), (2, "b c d e")])
    classes = line_dedup._frequency_classes(rows)
    signed = line_dedup._signed(rows, classes, line_dedup.SIMILARITY)
    assert "RLIKE" not in signed._jdf.queryExecution().optimizedPlan().toString()
    wanted = signed.where("doc_id = 1").select("sig", "doc_id", "line")
    chosen = line_dedup._chosen(rows, wanted.localCheckpoint(), classes)
    assert chosen._jdf.queryExecution().optimizedPlan().toString().count("Join") == 2  # the filter's, and one
    got = sorted((tuple(r["first"]), len(r["tokens"])) for r in chosen.collect())
    assert got == [((1, 0), 5), ((1, 0), 5), ((1, 1), 4)]


def test_trim_takes_lines_out(docs):
    rows = docs([(2, "a b c\nkeep this one\na b c"), (1, "x\na b c"), (3, None), (4, "a b c")])
    assert dict(pairs(line_dedup.trim(rows))) == {1: "x\na b c", 2: "keep this one", 3: None, 4: ""}


# Membership

def test_cascade_is_exact_in_blocks(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), (F.pmod(F.xxhash64("id"), F.lit(5)) == 0).alias("is_listed"))
    for block_keys in (10_000, 700):
        got = url_filter.membership(keys.withColumnRenamed("is_listed", "want"), keys, "key", block_keys=block_keys)
        assert got.count() == 3000 and got.where("want <> is_listed").count() == 0
    none = url_filter.membership(keys.select("key"), keys.withColumn("is_listed", F.lit(False)), "key")
    assert none.where("is_listed").count() == 0


# Benchmark items

def infix_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_bit_parallel_distance():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, n))] for n in (9, 14))
        assert decontam.edit_distance(a, b)[0] == infix_distance(a, b)


def test_edited_items_are_found(spark, docs):
    rng = random.Random(3)
    items = [prose(200 + i, rng.randrange(8, 45)) for i in range(25)]
    vocabulary = sorted({w for t in items for w in t.split()}) + [f"n{i}" for i in range(40)]
    rows, limit = [], lambda words: decontam.allowed(len(words), decontam.EDIT_SHARE)
    for i in range(150):
        words = items[i % 25].split()
        for _ in range(rng.randrange(limit(words) + 2)):
            at = rng.randrange(len(words))
            words[at:at + rng.randrange(2)] = [rng.choice(vocabulary)] * rng.randrange(2)
        around = [f"n{rng.randrange(40)}" for _ in range(30)]
        rows.append((i, " ".join(around[:15] + words + around[15:])))
    want = {(i, k) for i, t in rows for k, item in enumerate(items)
            if infix_distance(decontam.words(item.encode()), decontam.words(t.encode())) <= limit(item.split())}
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    for block_words in (decontam.BLOCK_WORDS, 100):
        found = decontam.matches(docs(rows), benchmark, block_words=block_words).collect()
        got = {(r.doc_id, r.item_id) for r in found}
        assert got <= want and len(got) >= 0.9 * len(want) and len(want) > 100
        for r in found[:50]:
            part = decontam.words(dict(rows)[r.doc_id].encode())[r.start_word:r.end_word]
            assert infix_distance(decontam.words(items[r.item_id].encode()), part) == r.edits


def test_sampling_selects_and_reaches_its_recall(monkeypatch):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    items = [(n, " ".join(rng.choice(vocabulary, n)).encode()) for n in (15, 22, 37, 45, 59) for _ in range(4)]
    index = decontam.build(items)
    assert min(index.counts.values()) > 0 and not index.unsampled
    for n, count in index.counts.items():
        own = [x for x in index.items if len(x) == n]
        tried = [own[i % 4] for i in range(300)]
        edited = [decontam._edited(x, decontam.allowed(n, index.share), rng) for x in tried]
        other = [rng.integers(1, len(index.vocab), n) for _ in tried]
        mine, near, far = (decontam._walk(*decontam._matrix(x), index, slice(0, count)) for x in (tried, edited, other))
        assert (mine == near).any(axis=1).mean() >= 0.95
        assert (mine == far).any(axis=1).mean() <= 0.1
    monkeypatch.setattr(decontam, "MAX_REPETITIONS", 2)
    strict = decontam.build(items)
    assert set(strict.counts.values()) == {0} and sum(map(len, strict.unsampled.values())) == len(items)
    text = b"one two " + b" ".join(items[7][1].split()[1:]) + b" three"
    assert [(0, i) for _, i, *_ in decontam.find([text], strict)] == [(0, i) for _, i, *_ in decontam.find([text], index)] != []


def test_verbatim_items_in_the_corpus(spark, testdata, corpus):
    benchmark = table(spark, testdata, "benchmark")
    found = {(r.doc_id, r.item_id) for r in decontam.matches(corpus, benchmark).collect()}
    plain = [(r.item_id, b" ".join(decontam.words(r.text.encode()))) for r in benchmark.collect()]
    verbatim = {(i, k) for i, t in pairs(corpus) for k, item in plain if item in b" ".join(decontam.words(t.encode()))}
    assert verbatim and verbatim <= found
    kept = {r.doc_id for r in decontam.keep_clean(corpus, benchmark).collect()}
    assert kept == {i for i, _ in pairs(corpus)} - {i for i, _ in found}


# Pieces

def test_round_trip(corpus, nasty):
    for rows in (corpus, nasty):
        decoded = pieces.decode(pieces.encode(rows)).select("text", "decoded").collect()
        assert all((r.text or "") == r.decoded for r in decoded)


def best_score(word, model):
    """Scores of all paths, without a trie."""
    best = [0.0] + [-math.inf] * len(word)
    for end in range(1, len(word) + 1):
        best[end] = best[end - 1] + model.scores.get(word[end - 1], model.unknown)
        for start in range(end - 1):
            best[end] = max(best[end], best[start] + model.scores.get(word[start:end], -math.inf))
    return best[-1]


def test_best_paths(corpus):
    model = pieces.load()
    words = {w for _, t in pairs(corpus.where("doc_id < 30")) for w in pieces.WORD.findall(" " + t)} | {" ▁x", "日本", " \r;"}
    names = {np.frombuffer(i, np.int32)[0]: p for p, i in model.ids.items()}
    for word, packed in pieces.segment(words, model):
        ids = np.frombuffer(packed, np.int32)
        if all(i in names for i in ids):
            assert "".join(names[i] for i in ids) == word
            assert sum(model.scores[names[i]] for i in ids) == pytest.approx(best_score(word, model))


def test_same_scores_as_the_library(corpus):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = pieces.load()
    proto = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        if piece.type == 1:
            piece.score = model.scores[piece.piece.replace(pieces.MARK, " ")]
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    names = {int(np.frombuffer(i, np.int32)[0]): p for p, i in model.ids.items()}
    total = lambda ids: sum(model.scores[names[i]] if i in names else 0 for i in ids)
    texts = [t for _, t in pairs(corpus.where("doc_id < 20"))]
    for text, packed in zip(texts, pieces.encode_texts(texts, model, {})):
        assert total(np.frombuffer(packed, np.int32).tolist()) == pytest.approx(total(library.encode(text)), abs=1e-2)


# Suffixes

def removed_bytes(rows, length=50):
    rank = [2**63 - 1 if i is None else i for i, _ in rows]
    texts, least = [(t or "").encode() for _, t in rows], {}
    for doc, text in zip(rank, texts):
        for p in range(len(text) - length + 1):
            least[text[p:p + length]] = min(doc, least.get(text[p:p + length], doc))
    out = []
    for (doc_id, _), doc, text in zip(rows, rank, texts):
        gone = bytearray(len(text))
        for p in range(len(text) - length + 1):
            if least[text[p:p + length]] < doc:
                gone[p:p + length] = b"\1" * length
        spans = sum(gone[p] and not (p and gone[p - 1]) for p in range(len(text)))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffixes(corpus, docs):
    rng = random.Random(1)
    bases = [prose(s) for s in range(6)]
    made = []
    for i in range(80):
        text = rng.choice([rng.choice(bases), rng.choice(bases)[rng.randrange(50):] + rng.choice(bases)[:rng.randrange(120)],
                           "a" * rng.randrange(200), "".join(rng.choice("ab") for _ in range(90)), None, "", "short"])
        made.append((rng.choice([i, i, i, None, 3]), text))
    small = docs(made).repartition(3)
    for chunk_bytes, bucket_bytes in ((1 << 21, 1 << 21), (500, 300), (3000, 1)):
        assert sorted_rows(suffix_dedup.digest(small, chunk_bytes, bucket_bytes)) == removed_bytes(made)
    assert sorted_rows(suffix_dedup.digest(corpus, 50_000, 20_000)) == removed_bytes(pairs(corpus))


def test_few_ranges_still_give_many_buckets(corpus, monkeypatch):
    packed = chunks.pack(corpus, 20_000)
    whole = packed.agg(F.sum("n_bytes")).first()[0]

    def sizes():
        found = Counter()
        for r in suffix_dedup.sent(packed, 2000).collect():
            found[r.bucket] += int(np.frombuffer(chunks.expand(r.packed), np.int64, 1)[0])
        return found

    want, most = sorted_rows(suffix_dedup.digest(corpus, 20_000, 2000)), max(sizes().values())
    monkeypatch.setattr(suffix_dedup, "RANGES", 2)
    assert suffix_dedup.splitters(packed, 2000).number >= whole / 2000
    assert sorted_rows(suffix_dedup.digest(corpus, 20_000, 2000)) == want
    assert max(sizes().values()) <= 3 * most


def test_a_phrase_in_many_documents_is_spread_over_buckets(docs):
    rng = random.Random(4)
    phrase = "Published daily by the River House, all"

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))

    made = [(i, noise(60) + phrase + noise(60)) for i in range(400)]
    made += [(1000 + i, text[20:-30]) for i, text in made[::7]] + [(2000 + i, made[0][1]) for i in range(20)]
    rows = docs(made).repartition(3)

    def largest(hot_strings):
        sizes = Counter()
        for r in suffix_dedup.sent(chunks.pack(rows, 4000), 500, hot_strings).collect():
            sizes[r.bucket] += int(np.frombuffer(chunks.expand(r.packed), np.int64, 1)[0])
        return max(sizes.values())

    assert largest(1 << 30) > 400 and largest(50) < 200
    want = removed_bytes(made)
    for hot_strings in (1, 50, 1 << 30):
        assert sorted_rows(suffix_dedup.digest(rows, 4000, 500, hot_strings)) == want


def test_trimmed_text_and_spans(docs):
    passage = "x" + prose(9, 12)
    rows = docs([(1, passage), (2, "before " + passage + " after"), (3, None)])
    got = {r.doc_id: r for r in suffix_dedup.trim(rows).collect()}
    assert got[1].text == passage and got[2].text == "before  after" and got[3].text == ""
    assert [tuple(s) for s in got[2].spans] == [(7, 7 + len(passage.encode()))]


# Quality

def test_counts(corpus, docs):
    rng = random.Random(5)
    made = docs([(1000 + i, "".join(rng.choice(["a", "b", " ", "\n", "#", "é", "|", "\t", "a b c d e "]) for _ in range(rng.randrange(80))))
                 for i in range(100)])
    rows = corpus.select(made.columns).union(made)
    texts = dict(pairs(rows))
    for r in quality.judge(rows).collect():
        text = texts[r.doc_id]
        words = WORD.findall(text)
        windows = defaultdict(list)
        for i in range(len(words) - 4):
            windows[tuple(words[i:i + 5])].append(i)
        repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))
        assert r.base_failed == (len(words) < 10 or 100 * len(repeated) > 20 * len(words))
        assert not (r.base_failed and r.kept)


def test_distance_of_known_distributions():
    p, q = np.array([[1.0, 1.0], [2.0, 0.0], [0.0, 0.0]]), np.array([0.5, 0.5])
    near, far, none = quality.divergence(p, q)
    middle = (0.75, 0.25)
    want = math.sqrt((math.log2(1 / middle[0]) + 0.5 * math.log2(0.5 / middle[0]) + 0.5 * math.log2(0.5 / middle[1])) / 2)
    assert near == 0 and far == pytest.approx(want) and none == 1


def test_common_words_are_exact(corpus):
    rules = quality.Rules(share=0.01)
    counts = defaultdict(Counter)
    for r in corpus.collect():
        counts[r.lang].update(w.encode() for w in WORD.findall(r.text))
    for ref in quality.references(corpus.repartition(5), rules):
        total = counts[ref.lang].total()
        want = {w: n / total for w, n in counts[ref.lang].items() if n >= 0.01 * total}
        assert dict(zip(ref.words, ref.shares)) == pytest.approx(want)


def test_a_language_without_a_reference_is_left_to_the_base_rules(spark):
    rng = random.Random(8)
    thai = "".join(map(chr, range(0x0E01, 0x0E2F)))
    clean = " ".join("".join(rng.choice(thai) for _ in range(8)) for _ in range(40))
    looping = "ก ข ค ง จ " * 4
    rows = [(i, prose(i, 500), "en") for i in range(300)]
    rows += [(400, clean, "th"), (401, clean, None), (402, clean, "en"), (403, looping, "th"), (404, prose(1), "th")]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = {400, 401, 404, *range(300)}
    assert {r.doc_id for r in quality.judge(made).where("kept").collect()} == want
    kept = quality.keep(made)
    assert kept.columns == made.columns and {r.doc_id for r in kept.collect()} == want


def test_a_third_of_all_rows_in_copies_moves_no_verdict(spark):
    rng = random.Random(9)
    common = ["el", "la", "de", "que", "y", "en", "un", "por", "con", "para"]
    rare = ["".join(rng.choice("abcdeilmnorst") for _ in range(6)) for _ in range(400)]

    def spanish(words):
        return " ".join(rng.choice(common if rng.random() < 0.4 else rare) for _ in range(words))

    rows = [(i, prose(i, 100), "en") for i in range(200)] + [(200 + i, spanish(100), "es") for i in range(40)]
    hot = "uno dos tres cuatro cinco seis siete ocho nueve diez once doce " + spanish(48)
    copies = [(1000 + i, hot, "es") for i in range(len(rows) // 2)]
    schema = "doc_id long, text string, lang string"
    want = {r.doc_id for r in quality.judge(spark.createDataFrame(rows, schema)).where("kept").collect()}
    made = spark.createDataFrame(rows + copies, schema).repartition(3)
    assert want == {i for i, *_ in rows}
    assert {r.doc_id for r in quality.judge(made).where("kept AND doc_id < 1000").collect()} == want
    assert {r.doc_id for r in quality.keep(made).where("doc_id < 1000").collect()} == want
    assert sorted_rows(quality.once(made)) == sorted(((t, x) for t, x in {(t, x) for _, t, x in rows + copies}), key=repr)


def test_junk_of_a_made_up_language_moves_no_verdict_and_stays_out(spark, testdata):
    rng = random.Random(10)
    rows = table(spark, testdata, "documents").select("doc_id", "text", "lang")

    def junk(i, lang):
        return 10_000 + i, " ".join("".join(rng.choice("0123456789abcdef") for _ in range(8)) for _ in range(300)), lang

    made = spark.createDataFrame([junk(0, "en"), *(junk(1 + i, "zz") for i in range(60))], rows.schema)
    want = {(r.doc_id, r.kept) for r in quality.judge(rows).collect()}
    for wanted in (60, 20):
        judged = quality.judge(rows.union(made.where(F.col("doc_id") <= 10_000 + wanted))).collect()
        assert {(r.doc_id, r.kept) for r in judged if r.doc_id < 10_000} == want
        assert not any(r.kept for r in judged if r.doc_id >= 10_000)


def test_references_in_passes_change_nothing(spark, testdata):
    rows = table(spark, testdata, "documents")
    want = sorted_rows(quality.judge(rows))
    assert sorted_rows(quality.judge(rows, quality.Rules(languages=1))) == want
    kept = {r.doc_id for r in quality.keep(rows, quality.Rules(languages=1)).collect()}
    assert kept == {r[0] for r in want if r[-1]}


def test_labels_agree(spark, testdata):
    rows = table(spark, testdata, "documents")
    judged = quality.judge(rows).join(table(spark, testdata, "labels"), "doc_id").where("n_words >= 50").collect()
    assert sum(r.kept == (r.quality == 1) for r in judged) > 0.95 * len(judged)


# Language model

def ppm_scores(rows):
    tables = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    words = Counter()
    for i, t in rows:
        if not ppm.held_out(i):
            text = (t or "").encode().lower()
            words.update([*text.split(), None])
            symbols = [ppm.START] * ppm.ORDER + [*text, ppm.END]
            for p in range(ppm.ORDER, len(symbols)):
                for k in range(ppm.ORDER + 1):
                    tables[k][tuple(symbols[p - k:p])][symbols[p]] += 1
    out = []
    for i, t in rows:
        text = (t or "").encode().lower()
        symbols, score = [ppm.START] * ppm.ORDER + [*text, ppm.END], 0.0
        for p in range(ppm.ORDER, len(symbols)):
            excluded = set()
            for k in range(ppm.ORDER, -1, -1):
                left = {s: n for s, n in tables[k].get(tuple(symbols[p - k:p]), {}).items() if s not in excluded}
                if left:
                    total = 2 * sum(left.values())
                    if symbols[p] in left:
                        score += math.log10((2 * left[symbols[p]] - 1) / total)
                        break
                    score += math.log10(len(left) / total)
                    excluded |= set(left)
            else:
                score -= math.log10(max(1, ppm.SYMBOLS - len(excluded)))
        tokens = [*text.split(), None]
        size = words.total() + len(words) + 1
        base = sum(math.log10((words[w] + 1) / size) for w in tokens)
        out.append((i, ppm.held_out(i), len(tokens), sum(w in words for w in tokens), words.total(), base, score))
    return sorted(out, key=lambda r: repr(r[:5]) + f"{r[5]:.4f}")


@pytest.mark.parametrize("sizes", [(1 << 22, 1 << 22), (3000, 2000)])
def test_language_model(sizes, corpus, docs):
    made = docs([(None, "abc"), (1000, None), (1001, ""), (1002, "zq\x00 ÉZ"), (1003, "the the")])
    rows = corpus.where("doc_id < 40").select(made.columns).union(made)
    got = sorted((tuple(r) for r in ppm.score(rows.repartition(3), *sizes).collect()), key=lambda r: repr(r[:5]) + f"{r[5]:.4f}")
    for a, b in zip(got, ppm_scores(pairs(rows)), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6], rel=1e-3, abs=1e-2)


def test_model_prefers_text_to_noise(corpus, docs):
    held = [i for i in range(5000, 5200) if ppm.held_out(i)][:6]
    text = pairs(corpus)[3][1][:400]
    noise = "".join(random.Random(1).sample(text, len(text)))
    made = docs([(i, text if n % 2 else noise) for n, i in enumerate(held)])
    scores = {r.doc_id: r.score for r in ppm.score(corpus.select(made.columns).union(made)).collect()}
    assert min(scores[i] for i in held[1::2]) > max(scores[i] for i in held[::2])


def test_ranges_split_by_hash_change_no_score(corpus, monkeypatch):
    rows = corpus.select("doc_id", "text")
    want = sorted_rows(ppm.score(rows, chunk_bytes=40_000, bucket_bytes=20_000))
    monkeypatch.setattr(ppm, "RANGES", 3)
    assert sorted_rows(ppm.score(rows, chunk_bytes=40_000, bucket_bytes=20_000)) == want


def test_small_probabilities_are_kept(spark):
    prices = -np.array([0, 0.5, 15.9999, 16, 16.5, 3, 28.2, 400.25])
    packed = b"12345678" + ppm._steps(prices)
    assert ppm._prices(packed, len(prices), 8) == pytest.approx(prices, abs=0.5 / ppm.STEPS)
    assert len(ppm._prices(b"", 0, 0)) == 0
    grams = np.array([(1 << 45) | 7, (1 << 45) | 8])
    price = ppm.code_lengths(grams, np.array([10**17, 1]), np.array([7, 8]), np.array([10**17, 1]))
    known = {"key": grams, "value": price, "bucket": np.zeros(2, np.int32)}
    asked = pa.table({"chunk": [0], "bucket": [0], "keys": [chunks.squeeze(np.diff(grams, prepend=0).tobytes())]})
    answer = chunks.expand(ppm._answer(asked, pa.table(known)).column("keys")[0].as_py())
    assert price[1] < -17 and ppm._prices(answer, 2, 0) == pytest.approx(price, abs=1e-3)


def test_hashed_places():
    rng = np.random.default_rng(6)
    for n in (0, 1, 5000):
        distinct = np.unique(rng.integers(0, 1 << 54, n))
        keys = rng.choice(distinct, 3 * n) if n else distinct
        assert (ppm._places(distinct, keys) == np.searchsorted(distinct, keys)).all()


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    context = (rng.integers(0, 3, 400)[:, None] << (ppm.BITS * np.arange(5, 2, -1))).sum(axis=1)
    base = (5 << 2 * ppm.BITS) | (6 << ppm.BITS)
    seen, counts = np.unique(context | base | rng.integers(0, 5, 400), return_counts=True)
    low = ppm._summed(ppm._low(seen, 1), counts)
    for ctx in np.unique(np.append(seen >> ppm.BITS, (7 << 5 * ppm.BITS >> ppm.BITS) | (base >> ppm.BITS))):
        every = (ctx << ppm.BITS) | np.arange(ppm.SYMBOLS)
        grams = np.union1d(every, seen)
        n = np.zeros(len(grams), np.int64)
        n[np.searchsorted(grams, seen)] = counts
        prices = ppm.code_lengths(grams, n, *low)
        assert (10 ** prices[np.isin(grams, every)]).sum() == pytest.approx(1)


# SimHash

def plain_print(text, width=3):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups(corpus, docs):
    rng = random.Random(9)
    base = prose(7, 400).split()
    made = [(1000 + i, " ".join(w for j, w in enumerate(base) if j != 3 * rng.randrange(130))) for i in range(40)]
    rows = corpus.select("doc_id", "text", "lang", "source", "n_chars").union(docs([*made, (2000, None), (2001, " "), (None, "a")]))
    texts = pairs(rows)
    prints = {i: plain_print(t or "") for i, t in texts}
    ids, root = sorted(i for i in prints if i is not None), {}
    for i in ids:
        near = {root[j] for j in root if (prints[i] ^ prints[j]).bit_count() <= 2}
        root[i] = min([i, *near])
        root.update((j, root[i]) for j in root if root[j] in near)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(rows).collect()}
    assert {i: got[i] for i in ids} == {i: (f"{prints[i]:016x}", root[i]) for i in ids}
    kept = sorted(r.doc_id for r in simhash.keep_first(rows).where("doc_id IS NOT NULL").collect())
    assert kept == sorted(set(root.values())) and len(kept) < len(ids) - 20


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_lookups_miss_no_pair(max_bits):
    rng = random.Random(max_bits)
    rows = [tuple(v % 2**64 for v in row) for row in simhash.lookups(max_bits)]
    finds = lambda x, y: any((not f or x & low) and (x ^ f) & m == y & m for _, m, f, low in rows)
    for _ in range(500):
        x = y = rng.getrandbits(64)
        for bit in rng.sample(range(64), rng.randint(0, max_bits)):
            y ^= 1 << bit
        assert finds(x, y) or finds(y, x)


def test_components(spark):
    rng = random.Random(12)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    loose = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(90)] + [(5000, 5000), (None, 1)]
    edges = chain + star + loose
    root = {}
    for a, b in edges:
        if a is not None and a != b:
            group = [n for n, r in root.items() if r in (root.get(a, a), root.get(b, b))] + [a, b]
            root.update(dict.fromkeys(group, min(min(group), root.get(a, a), root.get(b, b))))
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == root
