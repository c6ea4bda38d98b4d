"""Top-k search and decontamination."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from mediapanel.llm import decontaminate as dec
from mediapanel.llm import topk
from tests.llm import cases


def brute_top(rows, k, every=50):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash")).repartition(3)


def got_top(df):
    rows = [tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("block,group", [(8192, 512), (70, 3)])
def test_top_k_matches_brute_force(spark, block, group):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.2, 12).astype(np.float32).tolist()) for i in range(1, 400)]
    rows += [(400 + i, rows[0][1]) for i in range(20)]                     # ties
    rows += [(600, None), (650, [0.1, None] + [0.0] * 10), (700, [float("nan")] * 12), (750, [float("inf")] + [0.0] * 11),
             (800, [0.0] * 12), (850, [-1.0] * 12), (900, [3.5] * 12), (None, [0.1] * 12)]
    df = vectors(spark, rows)
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), 5, block, group)
    assert got_top(got) == brute_top(rows, 5)


def test_top_k_awkward_tables(spark):
    few = [(0, [0.5, 0.5]), (50, [0.25, -0.5]), (7, [0.1])]
    assert got_top(topk.top_k_of_embeddings(vectors(spark, few))) == brute_top(few, 5)
    alone = [(0, [0.5])]
    assert got_top(topk.top_k_of_embeddings(vectors(spark, alone))) == set()
    assert got_top(topk.top_k_of_embeddings(vectors(spark, few).limit(0))) == set()
    repeated = [(1, [0.5]), (1, [0.5]), (2, [0.5]), (100, [1.0]), (100, [1.0])]
    rows = topk.top_k_of_embeddings(vectors(spark, repeated)).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in rows] == [
        (100, 1, 1, 128 * 256), (100, 2, 1, 128 * 256), (100, 3, 2, 128 * 256)]


def test_bit_slices_hold_the_values():
    values = np.array([[-3, 5], [0, 511], [7, -256]])
    slices, low = topk.slice_block(values)
    back = sum(np.unpackbits(slices[:, b].view(np.uint8), axis=1, bitorder="little")[:, :3].astype(int) << b for b in range(slices.shape[1]))
    assert (back.T + low == values).all()


# --- decontamination -------------------------------------------------------

def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = row[:]
        for j, y in enumerate(b):
            row[j + 1] = prev[j] + 1 if x == y else max(prev[j + 1], row[j])
    return row[-1]


def test_matcher_is_the_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(200):
        item = np.array([rng.randint(1, 9) for _ in range(rng.randint(1, 70))])
        words = [rng.randint(0, 9) for _ in range(rng.randint(0, 150))]
        n, start, stop = dec.Matcher(item).match(words)
        assert n == lcs(item.tolist(), words) == lcs(item.tolist(), words[start:stop])


def judged(item, words):
    """The most common words of any stretch that is a leak, by trying all."""
    return max((k for a in range(len(words)) for b in range(a + 1, min(len(words), a + 2 * len(item)) + 1)
                if dec.is_leak(len(item), k := lcs(item, words[a:b]), b - a,
                               lcs(item[-dec.ANSWER_WORDS:], words[a:b]) / len(item[-dec.ANSWER_WORDS:]))), default=0)


def test_any_stretch_may_be_the_leak():
    rng = random.Random(8)
    seen = set()
    for _ in range(60):
        item = [rng.randint(1, 12) for _ in range(rng.randint(1, 14))]
        copy = [w if rng.random() < 0.8 else 0 for w in item]
        words = [rng.randint(0, 12) for _ in range(8)] + copy + [rng.randint(0, 12) for _ in range(8)]
        whole, answer = dec.Matcher(np.array(item)), dec.Matcher(np.array(item[-dec.ANSWER_WORDS:]))
        got, want = whole.best(words, answer), judged(item, words)
        assert (got[0] if got else 0) == want
        if got:
            assert lcs(item, words[got[2]:got[3]]) == got[0]
        seen.add(want > 0)
    assert seen == {True, False}


def test_words_far_away_do_not_hide_a_leak():
    item = list(range(1, 41))
    whole, answer = dec.Matcher(np.array(item)), dec.Matcher(np.array(item[-dec.ANSWER_WORDS:]))
    words = [1, 2, 3] + [0] * 50 + item[6:] + [0] * 50
    common, start, stop = whole.match(words)
    assert not dec.is_leak(40, common, stop - start, 1.0)
    assert whole.best(words, answer) == (34, 1.0, 53, 87)


def leak_rows(n=250):
    """Documents, some with an item whole, reworded, cut in half or shuffled."""
    rng = random.Random(11)
    items = [(i, cases.prose(rng, "en", rng.randint(15, 59)).capitalize() + ".") for i in range(40)]
    docs, leaks = [], set()
    for i in range(n):
        words = cases.prose(rng, "en", rng.randint(0, 400)).split()
        at = rng.randint(0, len(words))
        item_id, text = items[i % 40]
        item = text.split()
        if i % 5 == 0:
            words[at:at] = item
        elif i % 5 == 1:  # a paraphrase: some words changed, none of the answer
            changed = set(rng.sample(range(len(item) - 8), max(1, len(item) // 7)))
            words[at:at] = ["zzz" if k in changed else w for k, w in enumerate(item)]
        elif i % 5 == 2:
            words[at:at] = item[:len(item) // 3]
        elif i % 5 == 3:
            words[at:at] = rng.sample(item, len(item))
        if i % 5 < 2:
            leaks.add((i, item_id))
        docs.append((i, " ".join(words).upper() if i % 2 else " ".join(words)))
    return docs, items, leaks


def test_leaks_are_found_and_nothing_else(spark):
    docs, items, leaks = leak_rows()
    rows = docs + [(1000 + (i or 0), t) for i, t in cases.texts()]
    df = cases.frame(spark, rows, **cases.CLASHES)
    bench = spark.createDataFrame(items + [(900, None), (901, ""), (902, "123 !"), (None, "zq zw ze")], "item_id long, text string")
    got = dec.contaminated(df, bench.withColumn("cosine", F.lit(1)))
    pairs = [(r.doc_id, r.item_id) for r in got.collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == leaks


EDITS = ("reworded", "rarest reworded")


def edited(rng, item, how, df):
    """An item after an edit that keeps the last ``ANSWER_WORDS`` words, or a copy."""
    body = list(range(len(item) - dec.ANSWER_WORDS))
    if how == "reworded":
        gone = rng.sample(body, min(len(body), int(0.35 * len(item))))
    elif how == "rarest reworded":
        gone = sorted(body, key=lambda i: df[item[i]])[:int(0.35 * len(item))]
    else:
        gone = []
    return ["changed" if i in gone else w for i, w in enumerate(item)]


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """Leaks planted and leaks found, by kind of edit, in 130,000 passages of
    words as unequal as those of prose, many of them in over 1 % of the passages."""
    rng, draw = random.Random(17), np.random.default_rng(17)
    words = sorted(set(cases.prose(rng, "en", 60_000).split()))
    draw.shuffle(words)
    share = 1 / np.arange(10, len(words) + 10)
    some = lambda n: [words[i] for i in draw.choice(len(words), n, p=share / share.sum())]
    texts = [some(416) for _ in range(10_000)]
    df = Counter(w for t in texts for i in range(0, 416, 32) for w in set(t[i:i + 32]))
    assert sum(n > 0.01 * 130_000 for n in df.values()) > 50
    items = [some(rng.randint(20, 59)) for _ in range(120)] + [some(rng.randint(120, 300)) for _ in range(30)]
    items.append([words[i] for i in draw.permutation(40)])  # all of them in over 1 % of the passages
    assert min(df[w] for w in items[150]) > 0.01 * 130_000
    planted = {"common": {(d, 150) for d in range(1200, 1300)}}
    for d in range(1200, 1300):
        texts[d][96:96] = items[150]
    for d in range(1200):
        i = rng.randrange(150)
        how = rng.choice(EDITS) if i < 120 else "long"
        at = rng.randint(0, 416)
        texts[d][at:at] = edited(rng, items[i], how, df)
        planted.setdefault(how, set()).add((d, i))
    path = str(tmp_path_factory.mktemp("large") / "docs.parquet")
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": [" ".join(t) for t in texts]}), path)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    got = dec.contaminated(spark.read.parquet(path), bench).collect()
    return planted, {(r.doc_id, r.item_id): r for r in got}


@pytest.mark.parametrize("how", EDITS)
def test_every_paraphrase_in_a_large_table_is_found(large, how):
    planted, got = large
    assert len(planted[how]) > 300 and planted[how] <= set(got)


def test_terms_of_many_passages_weigh_in_a_large_table(large):
    planted, got = large
    assert planted["common"] <= set(got) and all(got[p].cosine > 0.3 for p in planted["common"])


def test_long_items_are_found(large):
    planted, got = large
    assert len(planted["long"]) > 150 and planted["long"] <= set(got)
    assert all(got[p].lcs == 1.0 for p in planted["long"])


def test_copies_are_retrieved_by_the_cosine(spark, monkeypatch):
    """Without the space only the items that no least cosine serves are found."""
    docs, items, leaks = leak_rows()
    df, bench = cases.frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: {(r.doc_id, r.item_id) for r in dec.contaminated(df, bench).collect()}
    served, floors = [], dec.floors
    monkeypatch.setattr(dec, "floors", lambda *a: served.append(floors(*a)) or served[-1])
    assert found() == leaks
    monkeypatch.setattr(dec, "latent_space", lambda t, w: (np.zeros((len(w), dec.RANK)), np.zeros(dec.RANK)))
    monkeypatch.setattr(dec, "floors", lambda *a: served[0])
    by_lists = found()
    assert np.isfinite(served[0]).sum() >= 10
    assert by_lists == {(d, i) for d, i in leaks if not np.isfinite(served[0][i])} != leaks


def test_numbers_are_words(spark):
    docs = cases.frame(spark, [(1, "they asked: 12 + 7 = 19, and so on"), (2, "12 + 8 = 20"),
                               (3, "a train leaves at 9 for 40 miles"), (4, "a train leaves at 7 for 30 miles")])
    bench = spark.createDataFrame([(1, "12 + 7 = 19"), (2, "Train leaves at 9 for 40 miles."), (3, "2019")],
                                  "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dec.contaminated(docs, bench).collect()} == {(1, 1), (3, 2)}


def test_leaks_across_blocks_of_items(spark, monkeypatch):
    docs, items, leaks = leak_rows(60)
    monkeypatch.setattr(dec, "ITEM_BLOCK", 15)
    monkeypatch.setattr(dec, "CHUNK", 500)
    got = dec.contaminated(cases.frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == leaks


def test_leaks_of_empty_tables(spark):
    docs = cases.frame(spark)
    bench = spark.createDataFrame([(1, "some words of a benchmark item that is long enough")], "item_id long, text string")
    assert dec.contaminated(docs.limit(0), bench).count() == 0
    assert dec.contaminated(docs, bench.limit(0)).count() == 0
    short = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert sorted(r.doc_id for r in dec.contaminated(docs, short).collect()) == [4, 5]


def test_latent_basis_spans_the_leading_directions(spark):
    """Against a dense SVD of the same weighted matrix."""
    rng = np.random.default_rng(3)
    weight = np.concatenate([[0.0], rng.uniform(0.5, 3, 60)])
    docs = [(i, rng.choice(np.arange(61), 32, p=np.r_[0.3, np.full(60, 0.7 / 60)]).astype("<u4").tobytes()) for i in range(400)]
    terms = spark.createDataFrame(docs, "doc_id long, terms binary")
    basis = dec.latent_basis(terms, weight, 8, 16)
    dense = np.zeros((400, 61))
    for i, t in docs:
        ids = np.frombuffer(t, "<u4")
        np.add.at(dense[i], ids[ids > 0], weight[ids[ids > 0]])
        dense[i] /= max(dense[i].sum(), 1e-12)
    values = np.linalg.svd(dense, compute_uv=False)
    assert np.allclose(basis.T @ basis, np.eye(8), atol=1e-5)
    assert np.linalg.norm(dense @ basis) ** 2 > 0.9 * (values[:8] ** 2).sum()
