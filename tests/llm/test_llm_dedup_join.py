"""Exact dedup, n-gram join, components against brute force; adverse rows."""

import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import ADVERSE, frame  # noqa: F401
from tarmac.llm import components, exact_dedup, ngram_join

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hot_documents():
    """A third of all rows is one text; groups of other sizes; unique texts."""
    rng = random.Random(3)
    texts = ["Hot TEXT" if i % 3 == 0 else f"copy {rng.randrange(30)}" if i % 3 == 1 else f"only {i}" for i in range(900)]
    return [(i, t if i % 2 else t.upper()) for i, t in enumerate(texts)]


def expected_dedup(pairs):
    groups = collections.defaultdict(list)
    for d, t in pairs:
        groups[(t or "").translate(LOWER)].append(d)
    return {
        (d, max(groups[k], key=lambda x: (x is not None, x or 0)), len(groups[k]), hashlib.sha256(k.encode()).hexdigest())
        for d, t in pairs
        for k in [(t or "").translate(LOWER)]
    }


@pytest.mark.parametrize("counters", [2, 1024])
def test_dedup_report_matches_brute_force(frame, counters):
    pairs = hot_documents()
    rows = exact_dedup.dedup_report(frame(pairs, partitions=7), counters=counters).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows} == expected_dedup(pairs)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)


def test_dedup_adverse_rows(frame):
    rows = exact_dedup.dedup_report(frame(ADVERSE, clashing=True)).collect()
    assert len(rows) == len(ADVERSE)
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows} == expected_dedup(ADVERSE)
    kept = collections.Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({r.text_sha256 for r in rows})


@pytest.mark.parametrize("counters", [1, 1024])
def test_dedup_keep_returns_whole_rows_of_the_winners(frame, counters):
    df = frame(ADVERSE + hot_documents(), clashing=True)
    kept = exact_dedup.dedup_keep(df, counters=counters)
    assert kept.columns == df.columns
    best = {}
    for d, t in ADVERSE + hot_documents():
        k = (t or "").translate(LOWER)
        best[k] = d if k not in best or best[k] is None else max(best[k], d if d is not None else best[k])
    assert collections.Counter((r.doc_id, (r.text or "").translate(LOWER)) for r in kept.collect()) == collections.Counter(
        (d, k) for k, d in best.items()
    )


def test_dedup_empty_table(frame):
    assert exact_dedup.dedup_report(frame([])).collect() == []
    assert exact_dedup.dedup_keep(frame([])).collect() == []


def test_misra_gries_bounds(spark):
    rng = random.Random(1)
    values = [rng.choice("aaaaabbbcd") + (str(rng.randrange(50)) if rng.random() < 0.5 else "") for _ in range(3000)]
    counters, n = 8, len(values)
    found = exact_dedup.misra_gries(spark.createDataFrame([(v,) for v in values], "v string").repartition(5), "v", counters)
    estimates = {r.v: r.estimate for r in found.collect()}
    for value, f in collections.Counter(values).items():
        assert f - n / (counters + 1) <= estimates.get(value, 0) <= f


# -------------------------------------------------------------------- join


def near_copies(seed=5, groups=12, unique=40):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    pairs = []
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(4, 160))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            pairs.append(" ".join(copy))
    pairs += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 80))) for _ in range(unique)]
    pairs += pairs[:3]
    rng.shuffle(pairs)
    return list(enumerate(pairs))


def expected_join(pairs, threshold=0.8, n=5):
    sets = []
    for _, t in pairs:
        w = (t or "").lower().split()
        k = min(n, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = collections.Counter()
    for i in range(len(pairs)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    members = collections.defaultdict(list)
    for i in range(len(pairs)):
        members[root(i)].append(i)
    out = []
    for i, (d, _) in enumerate(pairs):
        ids = [pairs[m][0] for m in members[root(i)]]
        out.append((d, min((x for x in ids if x is not None), default=None), len(ids), links[i]))
    return collections.Counter(out)


@pytest.mark.parametrize("block", [256, 3])
def test_join_matches_brute_force(frame, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_NODES", block)
    pairs = near_copies(seed=block)
    rows = ngram_join.near_duplicates(frame(pairs, partitions=4)).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.class_size, r.n_links) for r in rows) == expected_join(pairs)
    assert all(r.keep == (r.doc_id == r.class_id) for r in rows)


def test_join_adverse_rows_and_representatives(frame):
    df = frame(ADVERSE, clashing=True)
    rows = ngram_join.near_duplicates(df).collect()
    assert collections.Counter((r.doc_id, r.class_id, r.class_size, r.n_links) for r in rows) == expected_join(ADVERSE)
    kept = ngram_join.keep_representatives(df)
    assert kept.columns == df.columns
    # the blank ones and the row without an id stay; equal ones leave one
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter([1, 2, 3, None, None, 4, 6, 8, 9, 10])


def test_join_empty_table(frame):
    assert ngram_join.near_duplicates(frame([])).collect() == []


def test_depth_shortens_until_recall():
    assert ngram_join.depth_for_recall(0.8, 32, 8, 0.999) == 7
    assert ngram_join.depth_for_recall(0.8, 32, 8, 0.9999) == 6
    assert ngram_join.depth_for_recall(0.95, 32, 8, 0.999) == 8
    with pytest.raises(ValueError):
        ngram_join.depth_for_recall(0.1, 2, 8, 0.999)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=12), min_size=2, max_size=9))
def test_shared_counts(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    expected = [[len(a & b) for b in sets] for a in sets]
    got = ngram_join.shared_counts(arrays)
    for i in range(len(sets)):
        for j in range(len(sets)):
            if i != j:
                assert got[i, j] == expected[i][j]


def test_minhash_estimates_similarity():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 400, dtype=np.uint64)
    a, b = np.unique(base[:360]), np.unique(base[40:])
    agree = (ngram_join.minhash(a, 2000) == ngram_join.minhash(b, 2000)).mean()
    assert abs(agree - 320 / 400) < 0.04


def test_components_of_random_graphs(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(50)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[root(a)] = root(b)
    rows = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r.node: r.component for r in rows}
    assert set(got) == {x for e in edges if e[0] != e[1] for x in e}
    assert len({(root(n), c) for n, c in got.items()}) == len({root(n) for n in got}) == len(set(got.values()))
