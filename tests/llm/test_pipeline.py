"""The whole pipeline against plain steps, row by row, on the smallest table."""

import zlib
from collections import Counter

import corpus_pipeline
from tessarea.llm import queries as Q
from tessarea.llm import weak_quality
from tessarea.llm.quality_rules import BOILERPLATE
from tessarea.llm.secret_scan import fit_on_documents, spans_of
from tests.llm.test_brute_force import library_ids, linked, plain_line_fails, plain_measures, shingle_set, word_list

SF = "/root/testdata/sf0.001"


def cleaned(text):
    """The text without its failing lines, None if the document is rejected."""
    n, chars, _, _, repeats = plain_measures(text)
    left = [x for x in text.split("\n") if word_list(x) and not plain_line_fails(x) and not any(p in x.lower() for p in BOILERPLATE)]
    stays = sum(map(len, word_list("\n".join(left))))
    return None if n < 50 or 100 * repeats > 50 * n or chars - stays > 0.5 * chars else "\n".join(left)


def masked(text, model):
    out, at = [], 0
    for _, start, end in spans_of(text, model):
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_pipeline_equals_plain_steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scorer = weak_quality.fit(docs)
    kept = {r.doc_id: r.text for r in docs.collect() if r.text and scorer.score(r.text)[1] >= 0.5}
    kept = {i: t for i, t in ((i, cleaned(t)) for i, t in kept.items()) if t is not None}
    roots = linked({i: shingle_set(t, 5) for i, t in kept.items()}, 4, 5)
    kept = {i: t for i, t in kept.items() if roots[i] == i}
    model = fit_on_documents(spark.createDataFrame(list(kept.items()), "doc_id long, text string"))
    want = Counter()
    for i, t in kept.items():
        ids = [*library_ids("word_bpe_49k.json", masked(t, model)), 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want[i, piece, at, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))] += 1
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want and len(want) > 50
    assert Q.vocabulary("word_bpe_49k.json") and corpus_pipeline.ORACLE_SQL is None
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        assert [a for a, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))]
