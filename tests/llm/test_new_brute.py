"""Source divergence, Merkle manifests and BPE against brute force and the tokenizer library."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm import bpe, divergence, merkle
from barloom.llm.chunks import squeeze
from tests.llm.conftest import prose, sorted_rows

# --- source divergence -------------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_divergence(rows, least, top):
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    in_docs, uses = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        found = [w.translate(LOWER) for w in word.findall(text or "")]
        in_docs[lang or ""].update(set(found))
        uses[lang or "", source or ""].update(found)
    out = set()
    for lang, seen in in_docs.items():
        kept = [t for t, n in seen.items() if n >= least]
        sources = [s for g, s in uses if g == lang]

        def shares(counts, kept=kept):
            whole = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // whole for t in kept}

        of = {s: shares(uses[lang, s]) for s in sources}
        q = shares(sum((uses[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum((of[s][t] - of[o][t]) ** 2 // (of[s][t] + of[o][t]) for t in kept), o.encode())
                     for o in sources if o != s]
            terms = [(-((of[s][t] - q[t]) ** 2 // (of[s][t] + q[t])), t.encode())
                     for t in kept if uses[lang, s][t] and of[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(items, 1)}
    return out


@pytest.fixture
def mixed(spark):
    rng = random.Random(4)
    rows = [(n, prose(n % 150, 30) + rng.choice(["", " Étoile", " the THE the"]), rng.choice(["en", "fr", None]),
             rng.choice(["a", "b", None, "é", "z"]), 0) for n in range(300)]
    rows += [(n, "rare words only", "xx", s, 0) for n, s in ((300, "a"), (301, "b"))]
    rows += [(302, None, "en", "silent", 0), (303, "123 ... [x]", "en", "silent", 0)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("tile,levels,shard,round_bytes", [(32, 24, 4096, 10**8), (2, 24, 3, 150), (32, 1, 5, 10**8)])
def test_divergence(mixed, monkeypatch, tile, levels, shard, round_bytes):
    rows, df = mixed
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "LEVELS", levels)
    monkeypatch.setattr(divergence.perfect_hashes, "__defaults__", (shard,))
    monkeypatch.setattr(divergence.recount, "__defaults__", (round_bytes,))
    monkeypatch.setattr(divergence, "TASK_CELLS", 40)
    monkeypatch.setattr(divergence, "PORTION", 2000)
    got = [tuple(r) for r in divergence.compare(df.repartition(4)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_divergence(rows, 10, 10)


def test_perfect_hash_is_minimal_and_refuses_others():
    keys = [f"word{i}".encode() for i in range(5000)] + ["é".encode() * k for k in range(1, 50)]
    sizes, bits, ordered = divergence.build(keys)
    assert sorted(ordered) == sorted(keys) and int(bits.sum()) == len(keys) and sum(sizes) <= 4 * len(keys)
    row = {"lang": "en", "shard": 0, "n_shards": 1, "size": len(keys), "sizes": sizes, "n_bits": len(bits),
           "bits": np.packbits(bits, bitorder="little").tobytes(), "keys": [k.decode() for k in ordered]}
    slots = divergence.Slots(pa.Table.from_pylist([row], divergence._SHARD_ARROW))
    asked = pa.array([k.decode() for k in keys] + [f"other{i}" for i in range(3000)])
    found = slots.find("en", asked, divergence._hashes(asked.cast(pa.binary()).to_pylist()))
    assert sorted(found[:len(keys)].tolist()) == list(range(len(keys)))
    assert [ordered[i] for i in found[:len(keys)]] == keys and (found[len(keys):] == -1).all()
    assert (slots.find("de", asked, divergence._hashes(asked.cast(pa.binary()).to_pylist())) == -1).all()


def test_shares_are_exact_at_any_count():
    rng = random.Random(1)
    for whole in (7, 10**6, 3 * 10**13):
        counts = [rng.randrange(whole) for _ in range(50)] + [0, whole]
        got = divergence.share(np.array(counts), whole, 11).tolist()
        assert got == [1 + 10**9 * (c + 2) // (whole + 22) for c in counts]


def test_sum_streams_over_many_rows_of_a_key(spark):
    one = squeeze(np.arange(3, dtype=np.int64).tobytes())
    rows = spark.createDataFrame([("en", "a", 0, one)] * 5000 + [("en", "a", 1, one)],
                                 "lang string, source string, shard long, packed binary")
    got = {r.shard: r.total for r in divergence._sum(rows, "lang", "source", "shard").collect()}
    assert got == {0: 15000, 1: 3}


# --- Merkle manifests --------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(level, arity):
    paths, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for i, a in enumerate(at):
            run = level[a - a % arity:a - a % arity + arity]
            paths[i].append((a % arity, run[:a % arity] + run[a % arity + 1:]))
            at[i] = a // arity
        level = [digest(*level[i:i + arity]) for i in range(0, len(level), arity)]
    return level[0], paths


def brute_manifest(rows, arity):
    def leaf(row):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    trees = defaultdict(list)
    for row in rows:
        i, text, lang, source, n = row
        trees[lang].append((i is not None, i or 0, leaf((i, source, lang, n, text))))
    grown = {k: brute_tree([x[2] for x in sorted(v)], arity) for k, v in trees.items()}
    order = sorted(grown, key=lambda k: (k is not None, (k or "").encode()))
    root, upper = brute_tree([grown[k][0] for k in order], arity)
    out = []
    for k, up in zip(order, upper):
        for (some, i, own), path in zip(sorted(trees[k]), grown[k][1]):
            out.append((i if some else None, own, grown[k][0], root, [(s, o) for s, o in path + up]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("arity", [2, 3, 5])
@pytest.mark.parametrize("sizes", [{"en": 23, None: 8, "de": 1, "é": 3}, {"en": 9}, {"en": 1}])
def test_manifest(spark, arity, sizes):
    rows = [(None if n == 4 else n * 7 - 30, f"text {n} é", lang, None if n % 3 else "s", n or None)
            for lang, size in sizes.items() for n in range(size)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = merkle.manifest(df.repartition(5), arity=arity)
    got = [(r.doc_id, r.leaf, r.subroot, r.root, [(s.slot, [bytes(o).hex() for o in s.others]) for s in r.path])
           for r in found.collect()]
    assert sorted(got, key=repr) == brute_manifest(rows, arity)
    assert merkle.verify(found).where("NOT verified").count() == 0
    changed = found.withColumn("claim", F.sha2(F.col("leaf"), 256))
    assert merkle.verify(changed, "claim").where("verified").count() == 0


def test_manifest_spreads_a_hot_language(spark, monkeypatch):
    written = []
    monkeypatch.setattr(merkle, "cut", lambda df, name: written.append(df) or df)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text", "'en' AS lang", "'s' AS source", "id AS n_chars")
    dealt = merkle.numbered(rows.selectExpr("'=en' AS tree", "doc_id AS key"), ["key"])
    assert dealt.where("idx <> key OR n <> 20000").count() == 0
    sizes = [r["count"] for r in written[0].groupBy(F.shiftright("place", 33)).count().collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 15_000


def test_repeated_rows_of_a_manifest(spark):
    rows = [(1, "same", "en", "s", 4)] * 6 + [(1, "other", "en", "s", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    first, second = sorted_rows(merkle.audit(df)), sorted_rows(merkle.audit(df.repartition(3)))
    assert first == second and len(first) == 7


# --- BPE ---------------------------------------------------------------------------------------

PIECES = ["'", "'s", "'re", "'ll", " ", "  ", "\n", "\t", " ", "　", "a", "s", "t", "re", "ll", "d", "1", "٣", "é",
          "日本", "😀", "!", "-", "<|endoftext|>", "<|endof", "\x00", "\x1c", "\u0085", "ſ", "’s", "'S", "the", "ing", "Ᲊ"]


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(bpe.MODEL)
    found.no_padding()
    found.no_truncation()
    return found


@pytest.fixture(scope="module")
def strings():
    rng = random.Random(9)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 16))) for _ in range(4000)]
    return made + ["x" * 30_000, " " * 9000 + "a", "", "ab" * 5000 + "'s", "\n" * 70, "é" * 200] + [prose(n) for n in range(40)]


@pytest.mark.parametrize("listed", [0, 300, 4000])
def test_encoder_equals_the_library(library, strings, listed, tmp_path):
    classes = bpe.code_point_classes()
    counts = Counter()
    for text in strings:
        _, distinct, codes = bpe.words([text.encode()], classes, [b"<|endoftext|>"])
        counts.update(dict(zip(distinct.to_pylist(), np.bincount(codes, minlength=len(distinct)).tolist())))
    chosen = sorted(w for w, _ in counts.most_common(listed) if len(w) <= bpe.LEXICON_LENGTH)
    (tmp_path / "lexicon").write_bytes(bpe.pack(bpe.lexicon(chosen)))
    vocabulary = bpe.load()
    encoder, decoder = bpe.Encoder(vocabulary, bpe.mapped(tmp_path / "lexicon")), bpe.Decoder(vocabulary)
    ids, sizes = encoder([t.encode() for t in strings])
    ends = np.cumsum(sizes).tolist()
    wanted = [e.ids for e in library.encode_batch(strings, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == wanted
    decoded = [t.decode("utf-8", "replace") for t in decoder(ids, sizes)]
    assert decoded == [library.decode(i, skip_special_tokens=False) for i in wanted] == strings


def test_automaton_is_minimal_and_numbers_words():
    words = sorted({f"{a}{b}{c}".encode() for a in ("un", "re", "") for b in ("do", "wind", "tie") for c in ("ing", "s", "")})
    keys, targets, outputs, finals = bpe.compile_words(words)
    found = bpe.Lexicon(keys, targets, outputs, finals, *[np.zeros(1, np.int64)] * 3)
    asked = words + [b"und", b"", b"undoingx", b"x", b"re" * 40]
    got = found.find(pa.array(asked, pa.large_binary()))
    assert got.tolist() == [*range(len(words)), -1, -1, -1, -1, -1]
    # No two states accept the same rest: brute force over what each state accepts.
    arcs = defaultdict(list)
    for key, target in zip(keys.tolist(), targets.tolist()):
        arcs[key // 256].append((key % 256, target))

    def rest(state):
        own = {b""} if finals[state] else set()
        return frozenset(own | {bytes([b]) + r for b, t in arcs[state] for r in rest(t)})

    accepted = [rest(s) for s in range(len(finals))]
    assert len(set(accepted)) == len(accepted) and accepted[0] == frozenset(words)
    assert len(finals) < len({w[:k] for w in words for k in range(len(w) + 1)})


def test_merging_together_equals_merging_alone():
    rng, vocabulary = random.Random(2), bpe.load()
    words = [bytes(rng.choice(b"aabcdeinrst th") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    ids, sizes = bpe.Merges(vocabulary)(words)
    ends = np.cumsum(sizes).tolist()
    assert [ids[a:b].tolist() for a, b in zip([0, *ends], ends)] == [bpe.merge(w, vocabulary) for w in words]


def test_digest_and_round_trip(spark, library, docs, strings):
    rows = [(n, t) for n, t in enumerate(strings)] + [(-1, None)]
    df = docs(rows).repartition(4)
    want = {}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in bpe.digest(df).collect()} == want
    decoded = bpe.decode(bpe.decode(bpe.encode(df)))
    assert decoded.columns == ["doc_id", "text", "ids", "n_tokens", "decoded"]
    assert decoded.where("decoded <> coalesce(text, '')").count() == 0


def test_decode_awkward_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [50256, -5, 10**9]), (4, [171])], "n long, ids array<int>")
    got = {r.n: r.decoded for r in bpe.decode(rows).collect()}
    assert got == {1: "", 2: "", 3: "<|endoftext|>", 4: bpe.load().texts[171].decode("utf-8", "replace")}


def test_words_are_frequent_by_all_rows(docs):
    df = docs([(n, "common words here") for n in range(30)] + [(99, "seldom " + "y" * 40)]).repartition(5)
    assert set(bpe.frequent_words(df, 3)) == {b"common", b" words", b" here"}
    assert b"y" * 40 not in bpe.frequent_words(df, 99)
