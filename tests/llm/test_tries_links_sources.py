"""The prefix trie, the fingerprint join and the source audit against plain versions of their definitions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tessarea.llm import prefix_trie as pt
from tessarea.llm import simhash_join as sj
from tessarea.llm import source_divergence as sd

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_trie(rows):
    """Every node by its whole prefix."""
    told = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            told[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    turns = {c: [x[2] for x in sorted(v)] for c, v in told.items()}
    made = {}
    for c in turns:
        h, base = zlib.crc32(str(c).encode()) % 4, int(c / 20) * 20
        made[c] = turns.get(base, [])[:h] + turns[c][h:]
    nodes = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            nodes[tuple(seq[:d])].append(c)
    out = []
    for p, convs in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        children = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below)]
        saved = sum((len(nodes[q]) - 1) * len(WORD.findall(q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(p))
        out.append((min(convs), len(p), min(nodes[p[:-1]]) if p else None, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


TURNS = "conv_id long, turn long, role string, text string"


def found_trie(spark, rows):
    table = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("key", "parent", "part", "depth", "n", "base", "digest", "words")})
    return Counter(tuple(r) for r in pt.prefix_trie(table).collect())


def branching(rng, convs):
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, 7)):
            rows.append((c, t, rng.choice(["user", "user", None]), rng.choice(["a b", "", "c", None])))
    return rows


@pytest.mark.parametrize("held", [3, 100_000])
def test_trie_equals_plain_prefixes(spark, monkeypatch, held):
    rng = random.Random(held)
    rows = branching(rng, 90) + [(200, None, "user", "late"), (200, 3, "user", "a b"), (200, 3, "user", "z"), (200, 3, None, None), (200, 3, None, None)]
    rows += [(-7, 1, "user", "x"), (-7, 2, "user", "a b"), (None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(c, 0, "user", "alone") for c in (1001, 1002, 1003, 1005, 1007)]  # no head to take over: some have no turns left
    monkeypatch.setattr(pt, "HELD", held)
    monkeypatch.setattr(pt, "BLOCK", 2)
    assert found_trie(spark, rows) == plain_trie(rows)


def test_trie_of_paths_hung_on_paths(spark):
    """Conversation c leaves that of c + 20 at a later turn, so paths hang on paths; and many copies of one."""
    rows = [(20 * c, t, "user", f"w{t} v") for c in range(12) for t in range(12 - c)]
    rows += [(20 * c, 50, "user", f"own {c}") for c in range(12)]
    rows += [(20 * c, t, "user", "copy of all") for c in range(30, 90) for t in range(40)]
    assert found_trie(spark, rows) == plain_trie(rows)


def test_merges_go_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(pt, "FAN", 2)
    monkeypatch.setattr(pt, "HELD", 5)
    rows = branching(random.Random(1), 60)
    assert found_trie(spark, rows) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert found_trie(spark, []) == Counter()
    assert found_trie(spark, [(None, 1, "user", "a")]) == Counter()


def plain_fingerprint(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), seed=42) for i in range(len(words) - n + 1)] if n else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes):
    """Smallest id reachable over fingerprints that differ in 3 bits or fewer, by all pairs. nodes: (id, fingerprint)."""
    fps = sorted({f for _, f in nodes})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(b)] = find(a)
    least = {}
    for i, f in nodes:
        r = find(f)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return {(i, f): least[find(f)] for i, f in nodes}


def test_fingerprints_and_components(docs, rows):
    nodes = [(r[0], plain_fingerprint(r[1])) for r in rows]
    want = components(nodes)
    got = sj.near_fingerprints(docs).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter((i, f"{f:016x}", want[i, f]) for i, f in nodes)


def test_a_text_in_pieces(monkeypatch):
    rng = random.Random(2)
    text = " ".join(rng.choice(["Ab", "cd", "é f", "x" * 30]) for _ in range(400))
    whole = sj.fingerprint(text.encode())
    monkeypatch.setattr(sj, "PIECE", 7)
    monkeypatch.setattr(sj, "SHINGLES", 5)
    assert sj.fingerprint(text.encode()) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("most", [4, 64, 4096])
def test_links_of_fingerprints(spark, most):
    """Random fingerprints, families of near ones and pairs at distances of 1 to 6 bits, with short and long lists."""
    rng = random.Random(most)
    fps = [rng.getrandbits(64) for _ in range(60)]
    flipped = lambda f, n: f ^ sum(1 << b for b in rng.sample(range(64), n))
    fps += [flipped(rng.choice(fps[:60]), rng.randrange(1, 7)) for _ in range(120)]
    fps += [0] + [flipped(0, rng.randrange(1, 3)) for _ in range(200)] + [flipped(fps[0], 5) for _ in range(150)]
    low = [rng.getrandbits(12) << 20 for _ in range(150)]  # alike in six bytes
    nodes = list(enumerate(sorted({*fps, *low}, key=lambda f: hashlib.md5(str(f).encode()).digest())))
    want = components(nodes)
    table = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for _, f in nodes], "fp long")
    from tessarea.llm.graph import components as join
    from tessarea.session import Scratch

    scratch = Scratch(spark, "test")
    lists = sj.postings(table, sj.BLOCKS)
    links = sj.joined(lists, 3, 10_000) if most == 4096 else sj.joined(sj.postings(table, sj.FIVES), 3, most)
    roots = {r.node & (1 << 64) - 1: r.root for r in join(scratch.keep(links), scratch).collect()}
    got = defaultdict(set)
    for i, f in nodes:
        got[roots.get(f, ("alone", f))].add(i)
    same = defaultdict(set)
    for (i, f), c in want.items():
        same[c].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, same.values()))


@pytest.mark.parametrize("most", [3, 4096])
def test_long_lists_change_nothing(spark, most):
    """Texts of one template, so that fingerprints crowd."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(120)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    want = components([(i, plain_fingerprint(t)) for i, t in rows])
    got = sj.near_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), most=most).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for (i, _), c in want.items()}
    assert len(set(want.values())) < 150


def test_every_three_positions_lie_in_one_block():
    assert len(sj.BLOCKS) == 14
    for gone in sj.combinations(range(8), 3):
        assert sum(set(gone).isdisjoint(b) for b in sj.BLOCKS) == 1


def plain_divergence(rows, least, top):
    langs, groups, seen = defaultdict(Counter), {}, defaultdict(Counter)
    for text, lang, source in rows:
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        lang, source = lang or "", source or ""
        groups.setdefault((lang, source), Counter()).update(terms)
        langs[lang].update(terms)
        seen[lang].update(set(terms))
    out = set()

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    for lang in langs:
        kept = [t for t in langs[lang] if seen[lang][t] >= least]

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        whole, own = shares(langs[lang]), {s: shares(c) for (k, s), c in groups.items() if k == lang}
        for s, p in own.items():
            parts = {"pair": [(sum(f(p[t], q[t]) for t in kept), o) for o, q in own.items() if o != s]}
            parts["term"] = [(f(p[t], whole[t]), t) for t in kept if groups[lang, s][t] and p[t] > whole[t]]
            for part, items in parts.items():
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(ranked) if part == "pair" or i < top}
    return out


@pytest.mark.parametrize(("held", "piece"), [(10, 7), (400_000, 1 << 20)])
def test_divergence_equals_dense_sums(spark, rows, monkeypatch, held, piece):
    monkeypatch.setattr(sd, "HELD", held)
    monkeypatch.setattr(sd, "PIECE", piece)
    rng = random.Random(6)
    made = [(r[1], r[2], r[3]) for r in rows if len(r[1] or "") < 5000]
    made += [(" ".join(rng.choice("Alpha beta;gamma Été öl 中文 d e f".split()) for _ in range(rng.randrange(30))), rng.choice(["en", "de"]), f"s{rng.randrange(6)}") for _ in range(120)]
    made += [("1 2 3", "en", "digits"), (None, "xx", None), ("", "xx", "b"), ("few", "yy", "only")]
    table = spark.createDataFrame(made, "text string, lang string, source string").withColumns({c: F.lit("x") for c in ("term", "n", "docs", "value", "rank", "item", "salt")})
    got = sd.divergence(table, 4, 3).collect()
    want = plain_divergence(made, 4, 3)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_shares_stay_exact_for_large_counts(spark):
    big = 9 * 10**15
    row = spark.createDataFrame([(big, big + 10**12, 10**6)], "n long, t long, v long").select(sd.share(F.col("n"), F.col("t"), F.col("v")).alias("p")).first()
    assert row.p == 1 + 10**9 * (big + 2) // (big + 10**12 + 2 * 10**6)


def test_divergence_of_nothing(spark):
    assert sd.divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_long_runs_without_space(monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 64)
    text = ("x" * 5000 + " Y-z").encode()
    assert [w for piece in sd.pieces(text) for w in piece] == [b"x" * 5000, b"y", b"z"]
