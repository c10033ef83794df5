"""SuperMinHash near-dedup, whitening and hard negatives against brute force, and on awkward rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from aqlake.llm import hard_negatives, minhash, whitening
from aqlake.llm.superminhash import Words, band_keys, shingle_set, signatures

WORDS = "river hill stone water mill field boat carry slow green north wind over under bridge road".split()
DOCS = "doc_id bigint, text string, n string, k1 int, rid string, root double, bands string"
VECTORS = "vec_id bigint, embedding array<float>, label int, x string, row double, v int"
BIG = 2**53 + 1


def prose(seed: int, n: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, "y", 2.0, "z") for i, t in texts], DOCS).repartition(3)


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, label, "x", 1.0, 2) for i, e, label in rows], VECTORS).repartition(3)


def slow_set(text, size=2):
    words = (text or "").lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def slow_groups(rows, size=2, percent=80):
    """(doc_id, n, component, kept) by comparing all pairs; null ids come last."""
    sets = [slow_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=str)


def copies(seed, n, words, edits):
    """Copies of one text, each with some words replaced."""
    random = np.random.default_rng(seed)
    base = [f"w{k}" for k in random.integers(0, 5000, words)]
    out = []
    for i in range(n):
        text = list(base)
        for at in random.choice(words, int(random.integers(0, edits + 1)), replace=False):
            text[at] = f"e{seed}x{i}"
        out.append(" ".join(text))
    return out


def test_registers_meet_as_often_as_the_sets_do():
    random = np.random.default_rng(4)
    for share, size in ((0.2, 400), (0.8, 400), (0.8, 12), (0.5, 3000)):
        common = round(size * 2 * share / (1 + share))
        seen, both = [], []
        for _ in range(60):
            values = random.integers(0, 2**63, 2 * size - common, np.uint64)
            a, b = values[:size], values[size - common :]
            keys = band_keys(signatures([a, b], 128)).view("<u2").reshape(2, 128)
            seen.append((keys[0] == keys[1]).mean())
            both.append(common / len(values))
        assert abs(np.mean(seen) - np.mean(both)) < 0.03


def test_a_signature_depends_on_the_set_alone(monkeypatch):
    words = Words()
    sets = [shingle_set(prose(i, 1 + 40 * i), words) for i in range(8)] + [shingle_set(None, words)]
    together = signatures(sets, 128)
    alone = np.concatenate([signatures([s], 128) for s in sets])
    assert (together == alone).all()
    monkeypatch.setattr("aqlake.llm.superminhash.CHUNK", 7)
    assert (signatures(sets, 128) == together).all()
    assert (together[-1] == np.uint64(2**64 - 1)).all()
    # early stopping loses nothing: by hand, all steps of each element
    from aqlake.llm.superminhash import RANK, _draws

    own = sets[2][:5]
    least = np.full(128, 2**64 - 1, object)
    for element in own:
        places = list(range(128))
        for step in range(128):
            rank, choice = _draws(np.array([element]), step)
            k = step + int(choice[0]) % (128 - step)
            places[step], places[k] = places[k], places[step]
            least[places[step]] = min(least[places[step]], (step << RANK) + int(rank[0]))
    assert signatures([own], 128)[0].tolist() == least.tolist()


ODD = [(1, None), (2, ""), (3, "\n \t"), (4, "one"), (5, "ONE"), (6, prose(1, 60)), (6, prose(1, 60)), (6, prose(2, 60)), (None, prose(1, 60).upper()), (None, "lost"), (8, prose(3, 30_000)), (BIG, "Ä ß 日本 \U0001f600 " * 40), (9, "two words"), (10, "words two")]


@pytest.mark.parametrize("elements", [1 << 18, 300])
def test_near_duplicate_texts_match_all_pairs(spark, monkeypatch, elements):
    monkeypatch.setattr(minhash, "ELEMENTS", elements)
    rows = list(ODD)
    for seed in range(4):
        rows += [(100 * (seed + 1) + i, t) for i, t in enumerate(copies(seed, 30, 60, 4 + 2 * seed))]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.minhash_digest(documents(spark, rows)).collect()), key=str)
    wanted = slow_groups(rows)
    # a null id alone in its group keeps its row
    wanted = sorted(((d, n, c, d == c) for d, n, c, _ in wanted), key=str)
    assert got == wanted and len({c for _, _, c, _ in got}) < len(rows) - 50


def test_longer_shingles(spark):
    rows = [(i, t) for i, t in enumerate(copies(9, 20, 80, 2))] + [(99, "a b c"), (98, "a b c d e"), (97, "a b c")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicate_texts(documents(spark, rows)).collect()), key=str)
    assert got == slow_groups(rows, 5)


def _white(rows):
    x = np.floor(64 * np.array([e for _, e in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1], directions[:, ::-1]


@pytest.mark.parametrize("dims,n,rank", [(24, 300, 24), (6, 50, 6), (10, 200, 3), (8, 5, 4)])
def test_whitening_matches_the_covariance(spark, dims, n, rank):
    random = np.random.default_rng(dims)
    data = random.standard_normal((n, rank)) @ np.diag(np.linspace(2, 1, rank)) @ random.standard_normal((rank, dims))
    if rank < min(dims, n - 1):  # whole multiples, so that the rank stays after rounding
        data = random.integers(-5, 6, (n, rank)) @ random.integers(-3, 4, (rank, dims))
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    rows += [(BIG, rows[0][1]), (None, rows[1][1]), (7, rows[2][1])]
    x, count, sums, values, directions = _white(rows)
    odd = [(901, None), (902, []), (903, [1.0] * dims + [2.0]), (904, [None] + [1.0] * (dims - 1)), (905, [float("nan")] * dims), (906, [float("inf")] * dims)]
    got = whitening.whitening_digest(vectors(spark, [(i, e, 0) for i, e in rows + odd])).collect()
    k = min(16, rank)
    assert len(got) == k * len(rows) and {r.component for r in got} == set(range(1, k + 1))
    assert {r.n for r in got} == {count} and {r.identity_error for r in got} != {0.0} and max(r.identity_error for r in got) < 1e-9
    deviations = ((count * x.astype(object) - sums) ** 2).sum(axis=1)
    expected = (x - sums / count) @ directions[:, :k] / np.sqrt(values[:k])
    for j in range(k):
        mine = sorted((str(r.vec_id), r.deviation, abs(r.whitened)) for r in got if r.component == j + 1)
        theirs = sorted((str(i), int(d), abs(float(w))) for (i, _), d, w in zip(rows, deviations, expected[:, j]))
        assert [m[:2] for m in mine] == [t[:2] for t in theirs]
        if dims != 8:
            assert np.allclose([m[2] for m in mine], [t[2] for t in theirs], atol=1e-6)
        share = values[j] / values.sum()
        assert all(abs(r.explained - share) <= 1e-9 * share for r in got if r.component == j + 1)


def test_equal_eigenvalues_and_large_numbers(spark):
    axes = [(i, [float(8 * s if d == a else 0) for d in range(4)]) for i, (a, s) in enumerate((a, s) for a in range(4) for s in (-1, 1))]
    got = whitening.whitening_digest(vectors(spark, [(i, e, 0) for i, e in axes])).collect()
    assert len(got) == 32 and max(r.identity_error for r in got) < 1e-9 and {round(r.explained, 12) for r in got} == {0.25}
    far = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.5, 3e38])]
    got = whitening.whitening_digest(vectors(spark, [(i, e, 0) for i, e in far])).collect()
    assert len(got) == 6 and {r.deviation for r in got} == {None}
    for few in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, None, 0)]):
        assert whitening.whitening_digest(vectors(spark, few)).collect() == []


def _slow_negatives(rows):
    usable = [(i, np.floor(256 * np.array(e, np.float32).astype(float)).astype(np.int64), label) for i, e, label in rows]
    out = []
    for a, (i, x, label) in enumerate(usable):
        if i % 50:
            continue
        scored = sorted(((-int(x @ y), j, b) for b, (j, y, other) in enumerate(usable) if b != a and other == label))[:5]
        apart = sorted((-int(x @ y), j) for j, y, other in usable if other != label)
        for p, j, _ in scored:
            fits = [(s, o) for s, o in apart if 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(i, j, rank + 1, o, -p, -s) for rank, (s, o) in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("rows_a_block", [4096, 16])
def test_hard_negatives_match_all_pairs(spark, monkeypatch, rows_a_block):
    monkeypatch.setattr(hard_negatives, "ROWS", rows_a_block)
    random = np.random.default_rng(6)
    centres = random.standard_normal((4, 12))
    rows = [(25 * i, [float(np.float32(c)) for c in 0.5 * random.standard_normal(12) + centres[i % 4]], int(random.integers(0, 3))) for i in range(240)]
    rows += [(50 * (1000 + i), rows[0][1], rows[0][2]) for i in range(12)]  # equal vectors and scores
    rows += [(50 * (2000 + i), rows[0][1], 5) for i in range(6)]
    rows += [(100, rows[4][1], rows[4][2]), (BIG, rows[3][1], 1), (50 * 3000, [0.0] * 12, 1)]
    odd = [(None, rows[0][1], 1), (50, rows[0][1], None), (100, None, 1), (150, [], 1), (200, [1.0], 1), (250, [float("nan")] * 12, 1), (300, [None] * 12, 1), (350, [1e30] * 12, 1)]
    moved = hard_negatives.hard_negatives(vectors(spark, rows + odd), F.col("vec_id") % 50 == 0)
    got = sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in moved.collect())
    assert got == _slow_negatives(rows) and len(got) > 200


def test_threshold_search_stops_early_and_loses_nothing():
    random = np.random.default_rng(1)
    x = random.integers(-300, 300, (4000, 3))
    block = hard_negatives.Block(np.arange(4000), np.arange(4000), np.zeros(4000), x.astype(float), hard_negatives.Block.falling(x))
    anchor = np.array([5.0, -3.0, 0.0])
    scores = (x @ anchor).astype(int)
    low, high = np.array([-10**9, 200, 900]), np.array([10**9, 1500, 1000])
    found = hard_negatives.threshold_search(block, anchor, np.ones(4000, bool), low, high, 4)
    for (got, places), a, b in zip(found, low, high):
        wanted = sorted((-s, i) for i, s in enumerate(scores) if a <= s <= b)[:4]
        assert [(-s, i) for s, i in zip(got, places)] == wanted


def test_anchors_search_a_block_together_in_few_products(monkeypatch):
    random = np.random.default_rng(2)
    x = random.integers(-300, 300, (1500, 16))
    block = hard_negatives.Block(np.arange(1500) // 2, np.arange(1500), np.zeros(1500), x.astype(float), hard_negatives.Block.falling(x))
    anchors = random.integers(-5, 6, (60, 16)).astype(float)
    anchors[7] = 0
    eligible = random.random((60, 1500)) < 0.3
    low, high = np.tile([-(10**9), 800, 10**8], (60, 1)), np.tile([10**9, 2500, 10**9], (60, 1))
    products, product = [], hard_negatives._product
    monkeypatch.setattr(hard_negatives, "_product", lambda *sides: products.append(1) or product(*sides))
    found = hard_negatives.group_search(block, anchors, eligible, low, high, 4)
    assert len(products) <= 8  # one a round, not one a round and anchor
    for i, (slots, floors) in enumerate(found):
        scores = (x @ anchors[i]).astype(int)
        for (got, places), a, b, floor in zip(slots, low[i], high[i], floors):
            wanted = sorted((-scores[j], j) for j in range(1500) if eligible[i, j] and a <= scores[j] <= b)
            assert [(-s, j) for s, j in zip(got, places)] == wanted[:4]
            assert floor == (-wanted[3][0] if len(wanted) > 3 else a)


def test_empty_tables(spark):
    assert minhash.minhash_digest(documents(spark, ODD).limit(0)).collect() == []
    assert whitening.whitening_digest(vectors(spark, [])).collect() == []
    assert hard_negatives.hard_negatives_digest(vectors(spark, [])).collect() == []
