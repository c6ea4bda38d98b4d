"""Repeated windows, near-duplicates and components against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from math import comb

import numpy as np
import pytest

from mediapanel.llm import components, near_dedup, substring_dedup
from tests.llm import cases

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def brute_windows(rows, size):
    count, split = Counter(), []
    for i, t in rows:
        w = (t or "").encode().split()
        split.append((i, w))
        count.update(b" ".join(w[k:k + size]) for k in range(len(w) - size + 1))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - size + 1):
            if count[b" ".join(w[k:k + size])] > 1:
                gone.update(range(k, k + size))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got_windows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("window,anchor,width", [(35, 18, 20), (5, 1, 18), (7, 7, 17), (6, 4, 4)])
def test_windows_match_brute_force(spark, window, anchor, width):
    """The last case is a sketch of sixteen cells: all windows pass it."""
    rows = cases.texts()
    df = cases.frame(spark, rows, **cases.CLASHES)
    got = substring_dedup.remove_repeats(df, window, anchor, width)
    assert got_windows(got) == brute_windows(rows, window)
    sample = {r.doc_id: r for r in got.collect()}
    assert hashlib.sha256(sample[46].text.encode()).hexdigest() == sample[46].kept_sha256
    assert {"kind", "score", "lang_pred"} <= set(got.columns)


def test_windows_of_random_repetitive_text(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 60)))) for i in range(80)]
    df = cases.frame(spark, rows)
    assert got_windows(substring_dedup.remove_repeats(df, 6, 3, 18, with_text=False)) == brute_windows(rows, 6)


def test_windows_in_blocks_and_pieces(spark, monkeypatch):
    """Small blocks, pieces and flushes change nothing."""
    rows = cases.texts() + [(600, cases.prose(random.Random(1), "en", 900))] * 2
    for name, value in (("BLOCK_WORDS", 300), ("PIECE_WORDS", 100), ("BATCH_ANCHORS", 50), ("BATCH_WINDOWS", 60), ("HASH_TABLE", 20)):
        monkeypatch.setattr(substring_dedup, name, value)
    assert got_windows(substring_dedup.remove_repeats(cases.frame(spark, rows), 35, 18, 20)) == brute_windows(rows, 35)


def test_windows_of_empty_table(spark):
    assert substring_dedup.remove_repeats(cases.frame(spark).limit(0)).count() == 0


def test_anchor_counts_never_fall_below_window_counts():
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["a", "b", "cc"], k=70)).encode() for _ in range(6)]
    hasher = substring_dedup.WindowHasher(9, 4)
    seen, places = Counter(), []
    for _, _, starts, at, runs, a in hasher.blocks(enumerate(texts)):
        anchors, index = substring_dedup._distinct_anchors(at)
        seen.update(runs[anchors].tolist())
        h1, h2 = hasher.window_hashes(a, starts)
        places += list(zip(zip(h1.tolist(), h2.tolist()), runs[anchors][index].tolist()))
    windows = Counter(k for k, _ in places)
    assert all(seen[a] >= windows[k] for k, a in places)


# --- near-duplicates -------------------------------------------------------

def shingles(text, k):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    name = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            name[root(i)] = min(doc, name.get(root(i), doc))
    return sorted((str(doc), len(sets[i]), str(name.get(root(i)) if sets[i] else doc)) for i, (doc, _) in enumerate(rows))


def got_components(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows)


def chains(seed=3):
    """Chains of edits: neighbours are linked, ends are not; and many versions of one text."""
    rng = random.Random(seed)
    rows, i = [], 1000
    for length in (12, 40, 200, 700):
        words = cases.prose(rng, "en", length).split()
        for _ in range(15):
            rows.append((i, " ".join(words)))
            i += 1
            words = list(words)
            words[rng.randrange(len(words))] = f"w{i}"
    base = cases.prose(rng, "de", 150).split()
    for _ in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 9)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
        i += 1
    passage = cases.prose(rng, "en", 60)
    rows += [(i + k, cases.prose(rng, "en", 40) + " " + passage) for k in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words", [4, 5])
def test_components_match_brute_force(spark, words):
    rows = cases.texts() + chains()
    assert got_components(near_dedup.near_duplicates(cases.frame(spark, rows, **cases.CLASHES), words)) == brute_components(rows, words)


def test_components_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rows = chains(5)
    assert got_components(near_dedup.near_duplicates(cases.frame(spark, rows), 4)) == brute_components(rows, 4)


def test_components_of_empty_tables(spark):
    assert near_dedup.near_duplicates(cases.frame(spark).limit(0)).count() == 0
    got = near_dedup.near_duplicates(cases.frame(spark, [(3, None), (4, ""), (None, " ")]))
    assert got_components(got) == [("3", 0, "3"), ("4", 0, "4"), ("None", 0, "None")]


def test_one_row_of_each_group_stays(spark):
    rows = cases.texts() + chains()
    df = cases.frame(spark, rows, **cases.CLASHES)
    left = near_dedup.deduplicated(df, 5)
    assert left.columns == df.columns
    brute = brute_components(rows, 5)
    groups = {c for _, n, c in brute if n}
    kept = left.collect()
    texts = [(r.doc_id, r.text) for r in kept if shingles(r.text, 5)]
    # Two groups can share a name only where one doc_id has two texts.
    assert {str(i) for i, _ in texts} == groups
    assert len(set(texts)) == len(texts)
    assert sum(not shingles(r.text, 5) for r in kept) == sum(not shingles(t, 5) for _, t in rows)


def test_union_estimate_is_exact_on_whole_sets():
    a, b = np.arange(0, 80, dtype=np.uint64), np.arange(10, 90, dtype=np.uint64)
    assert near_dedup.union_estimate(a, b) == pytest.approx(70 / 90)


def test_connected_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(150)]
    links += [(500, i) for i in range(400, 480)] + [(7, 7), (3, 2)]
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = components.connected_components(spark.createDataFrame(links, "u long, v long"))
    want = {x: root(x) for e in links if e[0] != e[1] for x in e}
    assert {r.u: r.root for r in got.collect()} == want
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_both_ways_to_miss_a_link_are_below_their_stated_chance():
    def fewer(n, k):
        return sum(comb(n, i) * 0.8 ** i * 0.2 ** (n - i) for i in range(k))
    assert fewer(near_dedup.INDEX_K, near_dedup.NEED) < 1e-8
    assert fewer(near_dedup.UNION_K, near_dedup.UNION_NEED) < 1e-8
    assert near_dedup.UNION_LEAST * near_dedup.UNION_K <= near_dedup.UNION_NEED
