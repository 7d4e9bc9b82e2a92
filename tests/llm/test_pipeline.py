"""The pipeline against plain versions of its stages, each on what the one before kept."""

import corpus_pipeline
from barloom.llm import decontam, pieces, quality
from barloom.llm.text import table
from tests.llm.test_brute import infix_distance, matched_lines, plain_print


def test_run_equals_plain_stages(spark, testdata):
    rows = [r.asDict() for r in table(spark, testdata, "documents").collect()]
    refs = quality.references(table(spark, testdata, "documents"))
    kept = quality.measures([r["text"].encode() for r in rows], refs, quality.Rules(), [r["lang"] for r in rows])["kept"]
    rows = [r for r, k in zip(rows, kept) if k]

    gone, _ = matched_lines([(r["doc_id"], r["text"]) for r in rows])
    for r in rows:
        lines = r["text"].split("\n")
        r["text"] = "\n".join(x for k, x in enumerate(lines) if (r["doc_id"], k) not in gone)

    root, prints = {}, {r["doc_id"]: plain_print(r["text"]) for r in rows}
    for i in sorted(prints):
        near = {root[j] for j in root if (prints[i] ^ prints[j]).bit_count() <= 2}
        root[i] = min([i, *near])
        root.update((j, root[i]) for j in root if root[j] in near)
    rows = [r for r in rows if root[r["doc_id"]] == r["doc_id"]]

    items = [decontam.words(r.text.encode()) for r in table(spark, testdata, "benchmark").collect()]

    def holds(text, item):
        shared = {tuple(item[i:i + 3]) for i in range(len(item) - 2)} & {tuple(text[i:i + 3]) for i in range(len(text) - 2)}
        return bool(shared) and infix_distance(item, text) <= decontam.allowed(len(item), decontam.EDIT_SHARE)

    rows = [r for r in rows if not any(holds(decontam.words(r["text"].encode()), item) for item in items)]

    got = {r.doc_id: r for r in pieces.decode(corpus_pipeline.run(spark, testdata)).collect()}
    assert set(got) == {r["doc_id"] for r in rows}
    for r in rows:
        assert got[r["doc_id"]].text == r["text"] == got[r["doc_id"]].decoded
        assert got[r["doc_id"]].n_ids == len(got[r["doc_id"]].ids)
