"""Substring and near-duplicate operators against brute force."""

import hashlib
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

from chunkspark.llm import jaccard_join, lattice_dedup, pairing
from chunkspark.llm.jaccard_join import jaccard_classes
from chunkspark.llm.lattice_dedup import lattice_links
from chunkspark.llm.substring_dedup import substring_dedup
from chunkspark.llm import suffix_dedup as suffix_dedup_module
from chunkspark.llm.suffix_dedup import deduplicated, suffix_dedup
from chunkspark.session import read_table


def removed(docs, words, length):
    """(tokens, kept) per document by definition; rows with equal ids don't take from one another."""
    first = {}
    cut = [(i, (t or "").encode()) for i, t in docs]
    cut = [(i, t.split() if words else t) for i, t in cut]
    join = (lambda w: tuple(w)) if words else bytes
    for i, t in cut:
        for k in range(len(t) - length + 1 if i is not None else 0):
            w = join(t[k: k + length])
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in cut:
        gone, seen = [False] * len(t), set()
        for k in range(len(t) - length + 1 if i is not None else 0):
            w = join(t[k: k + length])
            if first[w] < i or (not words and w in seen):
                gone[k: k + length] = [True] * length
            seen.add(w)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        kept = b" ".join(x for x, g in zip(t, gone) if not g) if words else bytes(x for x, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), *(() if words else (spans,)), kept))
    return sorted(out, key=repr)


def corpus(seed=3):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    passages = [[rng.choice(words) for _ in range(rng.randint(8, 40))] for _ in range(6)]
    docs = [(None, "w1 " * 60), (500, None), (501, ""), (502, "short"), (7, "aa" * 400), (8, "ab" * 300 + "aa" * 100), (9, " ".join(["x"] * 300))]
    for i in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(text))
            text[at:at] = rng.choice(passages)
        docs.append((100 + i, "  ".join(text) + "\u00e9"))
    docs += [(300 + i, docs[20][1]) for i in range(5)] + [(120, docs[30][1])]
    docs.append((400, " ".join(rng.choice(words) for _ in range(20_000)) + docs[25][1]))
    return docs


def frame(spark, docs):
    rows = [(i, t, 1, "x") for i, t in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, doc int, h1 string").repartition(5)


@pytest.mark.parametrize("length, group", [(12, 4), (50, 8), (3, 3)])
def test_substring_dedup_is_exact(spark, length, group):
    docs = corpus()
    found = substring_dedup(frame(spark, docs), length, group).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in found), key=repr) == removed(docs, True, length)


@pytest.mark.parametrize("length, group", [(20, 8), (100, 64), (5, 5)])
def test_suffix_dedup_is_exact(spark, length, group):
    docs = corpus(4)
    found = suffix_dedup(frame(spark, docs), length, group).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=repr) == removed(docs, False, length)


@pytest.mark.parametrize("piece, ordered", [(64, 8 << 20), (1 << 20, 300), (150, 0)])
def test_suffix_dedup_in_pieces_and_of_large_anchors(spark, monkeypatch, piece, ordered):
    """Texts scanned in pieces; runs ordered a few at a time; anchors with more runs than a task orders."""
    monkeypatch.setattr(suffix_dedup_module, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup_module, "SORTED", ordered)
    docs = corpus(6) + [(600 + i, "common head " * 4 + f"tail {i * i}") for i in range(40)]
    docs += [(20, "same id " * 20), (20, "another text " * 9 + "same id " * 20), (20, "same id " * 20), (None, None)]
    found = suffix_dedup(frame(spark, docs), 20, 8).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found), key=repr) == removed(docs, False, 20)


def test_digit_passes_leave_the_repeated_strings():
    draw = np.random.default_rng(3)
    for length in (1, 7, 8, 9, 20, 100):
        data = draw.integers(97, 99, size=600).astype(np.uint8)
        data[300:450] = data[10:160]
        at, group = np.arange(len(data) - length + 1), draw.integers(0, 2, size=len(data) - length + 1)
        found, groups = suffix_dedup_module.ordered(data, at, group, length)
        members = {}
        for i in at.tolist():
            members.setdefault((int(group[i]), data[i: i + length].tobytes()), []).append(i)
        want = sorted(m for m in members.values() if len(m) > 1)
        got = {}
        for i, g in zip(found.tolist(), groups.tolist()):
            got.setdefault(g, []).append(i)
        assert sorted(map(sorted, got.values())) == want


def test_a_long_text_is_scanned_in_bounded_memory():
    import pyarrow as pa

    text = np.random.default_rng(1).integers(97, 123, size=20_000_000).astype(np.uint8).tobytes()
    batch = pa.record_batch({"text": pa.array([text], pa.binary())})
    tracemalloc.start()
    found, = suffix_dedup_module.found_runs(batch, suffix_dedup_module.Depth())
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()
    # Each suffix is in one run.
    assert found.windows.sum() == len(text) - 99 and (found.first[1:] == found.first[:-1] + found.windows[:-1]).all()


def test_suffix_dedup_of_nothing(spark):
    docs = frame(spark, corpus(1))
    assert suffix_dedup(docs.filter("false")).collect() == [] and deduplicated(docs.filter("false")).collect() == []
    assert substring_dedup(docs.filter("false")).collect() == []
    few = suffix_dedup(docs.filter("text IS NULL OR text = ''")).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in few) == [(500, 0, 0, 0), (501, 0, 0, 0)]


def test_suffix_dedup_keeps_columns(spark):
    docs = corpus(5)
    left = deduplicated(frame(spark, docs), 20, 8)
    assert left.columns == ["doc_id", "text", "doc", "h1"]
    want = sorted(((r[0], r[4].decode("utf-8", "replace")) for r in removed(docs, False, 20)), key=repr)
    assert sorted(((r.doc_id, r.text or "") for r in left.collect()), key=repr) == want
    assert left.filter("text is null").count() == 1


def test_substring_queries_on_documents(spark, sf_dir):
    from chunkspark.plans.registry import QUERIES

    docs = [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()]
    for name, words, length in (("op1_substring_dedup", True, 50), ("op5_suffix_array_dedup", False, 100)):
        found = sorted((tuple(r) for r in QUERIES[name](spark, sf_dir).collect()), key=repr)
        assert found == sorted(((*w[:-1], hashlib.sha256(w[-1]).hexdigest()) for w in removed(docs, words, length)), key=repr)


def joined(names, edges):
    parent = {n: n for n in names}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in names}


def near(docs):
    sets = {}
    for i, t in docs:
        w = (t or "").split()
        sets[i] = {tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))} if w and i is not None else set()
    ids, edges = sorted(sets), []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and both >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
                edges.append((a, b))
    degree = defaultdict(int)
    for a, b in edges:
        degree[a] += 1
        degree[b] += 1
    group = joined(ids, edges)
    return {i: (group[i], degree[i]) for i in ids}


@pytest.mark.parametrize("small, block", [(128, 192), (4, 6)])
def test_jaccard_join_matches_brute_force(spark, monkeypatch, small, block):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rng = random.Random(9)
    words = [f"v{k}" for k in range(3000)]
    docs, base = [(900, None), (901, ""), (902, "one"), (903, "one"), (904, "one two"), (905, "b " * 30_000)], []
    for i in range(25):
        text = [rng.choice(words) for _ in range(rng.choice([3, 8, 40, 150, 400]))]
        base.append(text)
        docs.append((i, " ".join(text)))
    for i in range(25, 160):
        text = list(base[0] if i % 2 else rng.choice(base))
        for _ in range(rng.randint(0, max(1, len(text) // 60))):
            text[rng.randrange(len(text))] = rng.choice(words)
        docs.append((i, "  ".join(text)))
    docs += [(200 + i, docs[10][1]) for i in range(40)]
    rows = [(i, t, 1) for i, t in docs] + [(None, docs[10][1], 1)]
    found = jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string, node int").repartition(4)).collect()
    got = {r.doc_id: (r.class_id, r.n_links) for r in found}
    assert got.pop(None) == (None, 0) and len(found) == len(rows)
    assert got == near(docs)


def test_jaccard_join_of_nothing_and_repeated_rows(spark):
    assert jaccard_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    found = jaccard_classes(spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "z")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in found) == [(1, 1, 1), (1, 1, 1), (2, 2, 0)]


def test_jaccard_query_on_documents(spark, sf_dir):
    from chunkspark.plans.registry import QUERIES

    docs = [(r.doc_id, r.text) for r in read_table(spark, sf_dir, "documents").collect()]
    assert {r.doc_id: (r.class_id, r.n_links) for r in QUERIES["op7_ngram_jaccard_join"](spark, sf_dir).collect()} == near(docs)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 30)] + [(2005, 2001), (2006, 2002), (2006, 2005)]
    found = {r.vertex: r.component for r in pairing.components(spark.createDataFrame(edges, "vertex long, root long")).collect()}
    names = {x for e in edges for x in e}
    assert found == {n: c for n, c in joined(names, edges).items() if n != c}


def test_nearest_lattice_points():
    rng = np.random.default_rng(1)
    y = rng.normal(size=(200, 8)) * 2
    point = lattice_dedup.nearest(y)
    assert (np.rint(point.sum(axis=1)) % 2 == 0).all()
    near_ = lattice_dedup.neighbours(y, point)
    for other in near_:
        assert np.allclose(((other - point) ** 2).sum(axis=1), 2) and (((other - y) ** 2).sum(axis=1) >= ((point - y) ** 2).sum(axis=1) - 1e-9).all()


@pytest.mark.parametrize("block", [512, 8])
def test_lattice_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lattice_dedup, "BLOCK", block)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 32))
    rows = [(i, v.tolist(), 1) for i, v in enumerate(base)]
    for i in range(40, 240):
        source = base[0] if i % 3 == 0 else base[rng.integers(40)]
        rows.append((i, (source / np.linalg.norm(source) + rng.normal(size=32) * rng.choice([0.0, 0.02, 0.05]) ).tolist(), 1))
    odd = [(500, None), (501, []), (502, [0.0] * 32), (503, [float("nan")] * 32), (504, [None] * 32), (505, [1.0, 2.0]), (506, [2.0, 4.0]), (None, rows[0][1])]
    rows += [(i, v, 1) for i, v in odd]
    x = np.array([v for i, v, _ in rows[:240]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cosine = x @ x.T
    edges = [(int(a), int(b)) for a, b in np.argwhere(np.triu(cosine >= 0.9, 1))] + [(505, 506)]
    found = lattice_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int").repartition(3)).collect()
    degree = defaultdict(int)
    for a, b in edges:
        degree[a] += 1
        degree[b] += 1
    missing = sum(degree.values()) - sum(r.n_links for r in found)
    assert 0 <= missing <= 0.02 * sum(degree.values())
    group = joined([r.vec_id for r in found if r.vec_id is not None], edges)
    got = {r.vec_id: r for r in found}
    assert len(found) == len(rows) and got[None].component_id is None and got[None].kept
    assert sum(group[i] != r.component_id for i, r in got.items() if i is not None) <= 2
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert [got[i].n_links for i in (500, 501, 502, 503, 504, 505)] == [0, 0, 0, 0, 0, 1]


def test_lattice_recall_near_the_threshold():
    """Share of pairs with a cosine of just over 0.9 that meet in a cell."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * side
    x, y = lattice_dedup.cells(a), lattice_dedup.cells(b)
    assert (x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).mean() >= 0.95


def test_lattice_of_nothing(spark):
    assert lattice_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_signs_of_pairs_at_the_threshold():
    """Signs keep every pair at the threshold and turn away nearly all others."""
    rng = np.random.default_rng(6)
    a = rng.normal(size=(20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    differ = [np.bitwise_count((lattice_dedup.signs(a) ^ lattice_dedup.signs(b)).view(np.uint64)).sum(axis=1) for b in (0.9 * a + np.sqrt(1 - 0.81) * side, side)]
    most = lattice_dedup.most_differing(0.9)
    assert (differ[0] <= most).all() and (differ[1] <= most).mean() < 0.002


def test_lattice_links_of_turned_vectors(spark, sf_dir):
    """The given vectors and copies turned by small angles: recall against brute force."""
    given = [r.embedding for r in read_table(spark, sf_dir, "embeddings").orderBy("vec_id").select("embedding").collect() if r.embedding]
    rng = np.random.default_rng(8)
    x = np.array(given[:400], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned = np.concatenate([x] + [x + rng.normal(size=x.shape) * s / np.sqrt(x.shape[1]) for s in (0.1, 0.3, 0.45)])
    unit = turned / np.linalg.norm(turned, axis=1, keepdims=True)
    exact = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(turned)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in lattice_links(rows).collect()}
    assert len(found) == len(turned) and exact.sum() > 1_000
    assert all(found[i] <= n for i, n in enumerate(exact))
    assert sum(found.values()) >= 0.98 * exact.sum()


def test_lattice_links_of_one_id_on_many_vectors(spark):
    """Different vectors under one vec_id are vectors of their own among the links, also where they meet in many cells."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=16)
    near_ = [(base + rng.normal(size=16) * 0.01).tolist() for _ in range(5)]
    rows = [(1, near_[0]), (1, near_[1]), (2, near_[2]), (2, near_[2]), (3, near_[3]), (4, rng.normal(size=16).tolist())]
    found = lattice_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    links = {(r.vec_id, r.n_links, r.component_id) for r in found}
    assert len(found) == 6 and {(2, 4, 1), (3, 4, 1), (4, 0, 4)} <= links
