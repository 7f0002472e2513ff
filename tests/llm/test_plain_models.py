"""The classifier and the language network against plain loops over the same weights."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tessarea.llm import language_id as li
from tessarea.llm import weak_quality as wq


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(z)))))


def plain_chances(net, raw):
    """Every byte's chances by a state for each direction that is carried byte by byte through a segment, in double precision."""
    h_size = net.u[0].shape[1]
    total = np.zeros(len(net.langs))
    for at in range(0, len(raw), li.SEGMENT):
        part = raw[at : at + li.SEGMENT]
        states = []
        for d, order in ((0, range(len(part))), (1, range(len(part) - 1, -1, -1))):
            w, u, c = net.w[d].astype(float), net.u[d].astype(float), net.c[d].astype(float).ravel()
            h, seen = np.zeros(h_size), {}
            for i in order:
                a, r = w[:, part[i]], u @ h
                z = np.array([sigmoid(v) for v in a[:h_size] + r[:h_size]])
                gate = np.array([sigmoid(v) for v in a[h_size : 2 * h_size] + r[h_size : 2 * h_size]])
                new = np.tanh(a[2 * h_size :] + gate * (r[2 * h_size :] + c))
                h = (1 - z) * new + z * h
                seen[i] = h
            states.append(seen)
        for i in range(len(part)):
            z = net.v[0].astype(float) @ states[0][i] + net.v[1].astype(float) @ states[1][i] + net.b.astype(float).ravel()
            e = np.exp(z - z.max())
            total += e / e.sum()
    return total / max(1, len(raw))


def test_languages_equal_a_plain_network(docs, rows):
    small = docs.filter("text is null or length(text) < 900")
    net = li.fit(docs, 60)
    got = li.identify(small, net).collect()
    assert len(got) == sum(r[1] is None or len(r[1]) < 900 for r in rows)
    by_id = {r[0]: r[1] for r in rows}
    assert len(net.langs) == 2
    for r in got:
        if r.doc_id is None:
            assert r.held_out
            continue
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        text = by_id[r.doc_id]
        if not text or not any(c.isalpha() for c in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        chance = plain_chances(net, text.encode())
        assert r.score == pytest.approx(chance.max(), abs=1e-4)
        assert r.lang_pred == net.langs[int(chance.argmax())] or abs(chance[0] - chance[1]) < 1e-4


def plain_score(model, text):
    """Runs of three bytes and bins, one by one."""
    raw, n = text.encode(), Counter()
    for i in range(len(raw) - 2):
        n[((raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]) * 2654435769 & 0xFFFFFFFF) >> 16] += 1
    z = float(model.weights[-1]) + sum(float(model.weights[k]) * 3 * math.sqrt(c / sum(n.values())) for k, c in n.items())
    for j, v in enumerate(wq.statistics(text)):
        z += float(model.weights[wq.BUCKETS + (j * 521 + sum(v >= e for e in wq.EDGES[j])) % wq.BINS])
    return sigmoid(z)


def test_scores_equal_a_plain_scorer(docs, rows):
    model = wq.fit(docs)
    by_id = {r[0]: r[1] or "" for r in rows}
    for r in wq.score(docs, model).collect():
        if r.doc_id is not None:
            assert r.score == pytest.approx(plain_score(model, by_id[r.doc_id]), abs=1e-5)
            assert r.kept == (bool(by_id[r.doc_id]) and r.score >= 0.5)
            votes = wq.vote(wq.statistics(by_id[r.doc_id]))
            logit = model.ratios[-1, 0] + sum(model.ratios[j, v] for j, v in enumerate(votes) if v)
            assert r.p_good == pytest.approx(sigmoid(logit), abs=1e-9)


def test_expectation_maximisation_equals_loops_over_documents():
    """The same rounds document by document, not by pattern."""
    rng = np.random.default_rng(3)
    size = len(wq.LABELLERS)
    good = rng.random(300) < 0.7
    votes = np.array([[0 if rng.random() < 0.4 else (2 if g == (rng.random() < 0.85) else 1) for _ in range(size)] for g in good])
    codes = (votes * 3 ** np.arange(size)).sum(1)
    patterns, counts = np.unique(codes, return_counts=True)
    ratios, _ = wq.expectation_maximisation(patterns, counts.astype(float), rounds=7)
    p = [0.2 ** sum(v == 1 for v in row) if 1 in row else 0.95 for row in votes.tolist()]
    for _ in range(7):
        table = np.zeros((size, 3))
        for j in range(size):
            tally = {(k, v): 1.0 if v else 1e-9 for k in (0, 1) for v in range(3)}
            for row, q in zip(votes.tolist(), p, strict=True):
                if row[j]:
                    tally[1, row[j]] += q
                    tally[0, row[j]] += 1 - q
            for v in (1, 2):
                table[j, v] = math.log(tally[1, v] / sum(tally[1, x] for x in range(3))) - math.log(tally[0, v] / sum(tally[0, x] for x in range(3)))
        prior = math.log((sum(p) + 1) / (sum(1 - q for q in p) + 1))
        p = [sigmoid(prior + sum(table[j, v] for j, v in enumerate(row) if v)) for row in votes.tolist()]
    assert ratios[:-1, 1:] == pytest.approx(table[:, 1:], abs=1e-9) and ratios[-1, 0] == pytest.approx(prior, abs=1e-9)
