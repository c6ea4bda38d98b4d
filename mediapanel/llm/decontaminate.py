"""Benchmark decontamination by latent semantic retrieval.

1. Documents become sequences of benchmark term numbers (0: no benchmark
   term), written once as a compact table; words are lower-cased and cut at
   ASCII characters that are not letters or digits. Passages are ``PASSAGE`` words.
2. TF-IDF of all passages that hold a benchmark term, with idf squared, which
   is idf once for the passage and once for the query; terms in more than
   ``MOST_SHARE`` of the passages weigh nothing, at any size. A
   randomised SVD is spread over the tasks: each multiplies its part of
   ``A' A`` with a random matrix, the parts are summed, and the driver gets the
   latent basis from that sum, a matrix of benchmark terms by
   ``RANK + OVERSAMPLE``. Its directions are scaled to equal spread (as queries
   are folded in), so that no topic of the corpus hides an item.
3. Candidates come from the cosine, in that space, of two neighbouring passages
   and a piece of an item (at most ``PASSAGE`` words). The least cosine is set
   per item (``floors``): the lowest that ``EDITS`` edited copies of it reach in
   text drawn from the document frequencies, less ``MARGIN``; a copy is found if
   one of its pieces is. Items whose least cosine more than ``MOST_NOISE`` of
   such texts reach without a copy cannot be told by a cosine (a few common words). They
   alone are looked up by an exact bound: a leak has a least number of its item's words
   within a stretch of bounded length, so some of the rarest are there
   (``Lists``). Nothing is capped.
4. Every candidate is judged on words: some stretch of it must have a longest
   common subsequence with the item that is ``LEAST_COMPACT`` of the stretch
   and ``COPY`` of the item; a paraphrase needs ``PARAPHRASE`` of it and
   ``LEAST_ANSWER`` of the item's last ``ANSWER_WORDS`` words, its answer.
   Items of fewer than ``SHORT`` words must be there whole. All stretches are
   judged, not the one of the longest subsequence alone.

Items are taken in blocks of ``ITEM_BLOCK``, so what is sent to tasks (terms,
vectors and lists of one block) has a fixed bound. Null or empty texts and items
match nothing, and neither does an item that is one number. Repeated items each
report; equal pairs are reported once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediapanel.llm.common import shared, text_or_empty, written

PASSAGE = 32
RANK, OVERSAMPLE = 128, 8
MOST_SHARE = 0.2
EDITS, REPLACED, MARGIN = 48, 0.35, 0.12
MOST_NOISE = 0.01
POOL = 2048           # texts drawn from the document frequencies
COPY, PARAPHRASE, LEAST_ANSWER = 0.8, 0.6, 0.75
LEAST_COMPACT = 0.5
ANSWER_WORDS = 8
SHORT = 8
ITEM_BLOCK = 10_000
LIST_ITEMS = 256      # items looked up at once
CHUNK = 100_000       # tokens of documents taken at once
CACHED = 4096         # tokens projected at once

CUT = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(CUT).split()


def term_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, terms): 32-bit term numbers of each document, 0 for words that
    no benchmark item has. Documents without any such term are left out."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = known.value.get
        for whole in batches:
            for batch in (whole.slice(i, 1024) for i in range(0, whole.num_rows, 1024)):
                keep, terms = [], []
                for i, t in enumerate(batch.column("text")):
                    words = words_of(t.as_py())
                    ids = np.fromiter(map(find, words, repeat(0)), "<u4", len(words))
                    if ids.any():
                        keep.append(i)
                        terms.append(ids.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(terms, pa.binary())],
                    names=["doc_id", "terms"])

    return (docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, terms binary"))


def _passages(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]]:
    """Groups of documents: terms that count and the passage each is in, the
    documents' terms, and the first passage of each document (and the end)."""
    held, size = [], 0
    column = batch.column("terms")
    for i in range(batch.num_rows):
        held.append(np.frombuffer(column[i].as_py(), "<u4"))
        size += len(held[-1])
        if size >= CHUNK or i == batch.num_rows - 1:
            n = np.array([-(-len(x) // PASSAGE) for x in held])
            first = np.concatenate([[0], np.cumsum(n)])
            ids = np.concatenate(held).astype(np.int64)
            where = np.concatenate([f + np.arange(len(x)) // PASSAGE for f, x in zip(first, held)])
            on = ids > 0
            yield ids[on], where[on], held, first
            held, size = [], 0


def passage_frequencies(terms: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """Passages that hold each term, and the number of passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms + 1, np.int64)
        for batch in batches:
            for ids, where, _, first in _passages(batch):
                df += np.bincount(np.unique(where * (n_terms + 1) + ids) % (n_terms + 1), minlength=n_terms + 1)
                df[0] += first[-1]
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], names=["id", "n"])

    rows = terms.select("terms").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(n_terms + 1, np.int64)
    df[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return df, int(df[0])


def _project(ids: np.ndarray, where: np.ndarray, n: int, weight: np.ndarray, basis: np.ndarray,
             unit: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the L1-normalised (``unit``) TF-IDF matrix times ``basis`` (whose
    rows are weighted already), and the norm of each row."""
    out = np.zeros((n, basis.shape[1]), np.float32)
    norm = np.bincount(where, weights=weight[ids], minlength=n)
    for i in range(0, len(ids), CACHED):
        w = where[i:i + CACHED]
        at = np.flatnonzero(np.diff(w, prepend=-1))
        out[w[at]] += np.add.reduceat(basis[ids[i:i + CACHED]], at, axis=0)
    return (out / np.maximum(norm, 1e-12)[:, None].astype(np.float32) if unit else out), norm


def _summed(terms: DataFrame, part, width: int) -> dict[int, np.ndarray]:
    """Rows of ``width`` numbers that tasks yield as (id, row), added up by id."""
    names = [f"c{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part(batches)
        at = np.flatnonzero(np.abs(total).sum(axis=1) > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64())] + [pa.array(total[at, j], pa.float64()) for j in range(width)], names=["id"] + names)

    rows = (terms.select("terms").mapInArrow(run, "id long, " + ", ".join(f"{c} double" for c in names))
            .groupBy("id").agg(*[F.sum(c).alias(c) for c in names]).toArrow())
    out = np.zeros((0, width)) if not rows.num_rows else np.stack([c.to_numpy() for c in rows.columns[1:]], axis=1)
    return dict(zip(rows.column(0).to_pylist(), out))


def latent_space(terms: DataFrame, weight: np.ndarray, rank: int = RANK, oversample: int = OVERSAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors (terms x rank) and values of the passages' TF-IDF matrix A
    by a randomised method of one pass: tasks add up ``Z = A' A R`` for a random
    matrix R, and ``A' A`` is taken as ``Z (R' Z)^-1 Z'`` (Nystroem), whose
    eigenvectors the driver gets from matrices of the size of Z."""
    n_terms, width = len(weight), rank + oversample
    random = np.random.default_rng(20).standard_normal((n_terms, width)).astype(np.float32)
    start = (random * weight[:, None]).astype(np.float32)

    def gram(batches):
        total = np.zeros((n_terms, width))
        for batch in batches:
            for ids, where, _, first in _passages(batch):
                on = weight[ids] > 0
                ids, where = ids[on], where[on]
                p, norm = _project(ids, where, int(first[-1]), weight, start)
                p /= np.maximum(norm, 1e-12)[:, None].astype(np.float32)
                order = np.argsort(ids, kind="stable")
                for i in range(0, len(order), CACHED):
                    o = order[i:i + CACHED]
                    at = np.flatnonzero(np.diff(ids[o], prepend=-1))
                    total[ids[o[at]]] += np.add.reduceat(p[where[o]] * weight[ids[o]][:, None].astype(np.float32), at, axis=0)
        return total

    z = np.zeros((n_terms, width))
    for i, row in _summed(terms, gram, width).items():
        z[i] = row
    core = random.astype(np.float64).T @ z
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    ok = values > max(1e-9 * values[-1], 1e-300)
    if not ok.any():
        return np.zeros((n_terms, rank)), np.zeros(rank)
    left, size, _ = np.linalg.svd(z @ (vectors[:, ok] / np.sqrt(values[ok])), full_matrices=False)
    return left[:, :rank], size[:rank]


def latent_basis(terms: DataFrame, weight: np.ndarray, rank: int = RANK, oversample: int = OVERSAMPLE) -> np.ndarray:
    return latent_space(terms, weight, rank, oversample)[0]


def pieces_of(item: np.ndarray) -> list[np.ndarray]:
    """The item cut evenly into pieces of at most ``PASSAGE`` words."""
    return np.array_split(item, -(-len(item) // PASSAGE))


def floors(item_terms: list[np.ndarray], df: np.ndarray, n: int, weight: np.ndarray, weighted: np.ndarray) -> np.ndarray:
    """The least cosine of each item's copies with it, or infinity where text
    without a copy reaches it too often.

    Half of the edited copies have ``REPLACED`` of their words replaced at
    random, half the words that weigh most; the answer stays (items of fewer
    than ``SHORT`` words stay whole). The text around and the new words are
    drawn from the document frequencies of all passages."""
    rng = np.random.default_rng(10)
    share = np.minimum(1.0, df / max(1, n))
    share[0] = 0
    drawn = np.array([((rng.random(len(df)) < share).astype(np.float32) + (rng.random(len(df)) < share)) @ weighted
                      for _ in range(POOL)], np.float32)
    sizes = np.maximum(np.linalg.norm(drawn, axis=1, keepdims=True), 1e-9)
    out = np.full(len(item_terms), np.inf)
    for i, item in enumerate(item_terms):
        parts = np.array_split(np.arange(len(item)), -(-len(item) // PASSAGE))
        vectors = np.array([weighted[item[p]].sum(axis=0) for p in parts])
        length = np.linalg.norm(vectors, axis=1)
        if length.max() <= 1e-6:
            continue
        vectors /= np.maximum(length, 1e-6)[:, None]
        kept = np.ones((EDITS, len(item)), np.float32)
        body = len(item) - ANSWER_WORDS
        gone = min(body, int(REPLACED * len(item)))
        if len(item) >= SHORT and gone > 0:
            order = rng.random((EDITS, body))
            order[::2] = -weight[item[:body]] + 1e-9 * order[::2]
            np.put_along_axis(kept, np.argsort(order, axis=1)[:, :gone], 0, axis=1)
        best = np.full(EDITS, -1.0)
        for p, v in zip(parts, vectors):
            left = kept[:, p]
            around = drawn[rng.integers(0, POOL, EDITS)] * (1 - left.sum(axis=1, keepdims=True) / (2 * PASSAGE))
            text = left @ weighted[item[p]] + around
            best = np.maximum(best, text @ v / np.maximum(np.linalg.norm(text, axis=1), 1e-9))
        least = best.min() - MARGIN
        if ((drawn @ vectors.T / sizes).max(axis=1) >= least).mean() <= MOST_NOISE:
            out[i] = least
    return out


class Matcher:
    """Longest common subsequences with one item, by bit-parallel steps."""

    def __init__(self, item: np.ndarray):
        self.n = len(item)
        self.masks: dict[int, int] = {}
        for i, t in enumerate(item.tolist()):
            self.masks[t] = self.masks.get(t, 0) | 1 << i
        self.back: dict[int, int] = {}
        for i, t in enumerate(item.tolist()[::-1]):
            self.back[t] = self.back.get(t, 0) | 1 << i

    def _run(self, words: list[int], masks: dict[int, int]) -> tuple[int, int]:
        """Length, and how many words it takes to reach it."""
        full = (1 << self.n) - 1
        v, best, at = full, 0, 0
        for i, w in enumerate(words):
            m = masks.get(w)
            if m:
                u = v & m
                v = ((v + u) | (v - u)) & full
                if (k := self.n - v.bit_count()) > best:
                    best, at = k, i + 1
        return best, at

    def match(self, words: list[int]) -> tuple[int, int, int]:
        """Length of the subsequence and the stretch of words it lies in."""
        best, end = self._run(words, self.masks)
        if not best:
            return 0, 0, 0
        _, back = self._run(words[:end][::-1], self.back)
        return best, end - back, end

    def best(self, words: list[int], answer: Matcher) -> tuple[int, float, int, int] | None:
        """Common words, share of the answer, start and stop of the stretch of
        ``words`` that is a leak and has the most of the item (then of the
        answer, then the shortest, then the first); every stretch is judged."""
        masks, full, least = self.masks, (1 << self.n) - 1, least_common(self.n)
        answer_masks, answer_full = answer.masks, (1 << answer.n) - 1
        if self._run(words, masks)[0] < least:
            return None
        hits = [i for i, w in enumerate(words) if w in masks]
        reach = int(self.n / LEAST_COMPACT)  # no leak is longer
        found, end = None, 0
        for h, start in enumerate(hits):
            while end < len(hits) and hits[end] < start + reach:
                end += 1
            if end - h < least:
                continue
            v, va = full, answer_full
            for i in hits[h:end]:
                w = words[i]
                u = v & masks[w]
                v = ((v + u) | (v - u)) & full
                if m := answer_masks.get(w):
                    u = va & m
                    va = ((va + u) | (va - u)) & answer_full
                if (k := self.n - v.bit_count()) >= least:
                    share = (answer.n - va.bit_count()) / answer.n
                    if is_leak(self.n, k, i + 1 - start, share):
                        found = max(found or (0,), (k, share, start - i - 1, -start))
        return found and (found[0], found[1], -found[3], -found[3] - found[2])


def least_common(n: int) -> int:
    """Words of an item of ``n`` that every leak has."""
    return n if n < SHORT else math.ceil(min(COPY, PARAPHRASE) * n - 1e-9)


def is_leak(n: int, common: int, span: int, answer: float) -> bool:
    if n < SHORT:
        return common == n and common >= LEAST_COMPACT * span
    return common >= LEAST_COMPACT * span and (
        common >= COPY * n or (common >= PARAPHRASE * n and answer >= LEAST_ANSWER))


class Lists:
    """Inverted lists of some items: per term the items that have it among
    their rarest positions, and in how many of them.

    A leak holds ``least_common`` of its item's positions, so it misses at most
    the others, and of any that many positions and ``few`` more it holds
    ``few``. The lists have these positions, the rarest of the item."""

    def __init__(self, item_terms: list[np.ndarray], df: np.ndarray):
        self.reach = np.array([int(len(t) / LEAST_COMPACT) for t in item_terms], np.int64)
        least = np.array([least_common(len(t)) for t in item_terms], np.int64)
        self.few = -(-least // 4)
        term, item = [], []
        for i, t in enumerate(item_terms):
            rare = t[np.lexsort((t, df[t]))][:len(t) - least[i] + self.few[i]]
            term.append(rare)
            item.append(np.full(len(rare), i))
        pairs, self.n = np.unique(np.concatenate(term) * len(item_terms) + np.concatenate(item), return_counts=True)
        self.item = pairs % len(item_terms)
        self.first = np.searchsorted(pairs // len(item_terms), np.arange(len(df) + 1))

    def regions(self, held: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, start, stop) that together hold every stretch that
        may be a leak. A document is cut into cells of the longest stretch that
        an item allows, so a stretch lies in two neighbouring cells; those that
        hold ``few`` listed positions of the item count, and runs of them join."""
        sizes = np.array([len(x) for x in held])
        ids = np.concatenate(held).astype(np.int64)
        count = self.first[ids + 1] - self.first[ids]
        at = np.flatnonzero(count)
        if not len(at):
            return
        count = count[at]
        entry = np.repeat(self.first[ids[at]] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        at = np.repeat(at, count)
        item, doc = self.item[entry], np.repeat(np.arange(len(held)), sizes)[at]
        cell = (at - (np.cumsum(sizes) - sizes)[doc]) // self.reach[item]
        # Window w holds the cells w - 1 and w; numbers of two items or documents are never neighbours.
        room = int(cell.max()) + 3
        key = (doc * len(self.reach) + item) * room + cell
        key, entry = np.concatenate([key, key + 1]), np.concatenate([entry, entry])
        windows, where = np.unique(key, return_inverse=True)
        few = self.few[windows // room % len(self.reach)]
        often = np.bincount(where, weights=self.n[entry]) >= few
        on = often[where]
        once = np.unique(where[on] * len(self.n) + entry[on])
        there = np.bincount(once // len(self.n), weights=self.n[once % len(self.n)], minlength=len(windows))
        windows = windows[there >= few]
        if not len(windows):
            return
        ends = np.flatnonzero(np.diff(windows) != 1)
        for lo, hi in zip(windows[np.concatenate([[0], ends + 1])].tolist(),
                          windows[np.concatenate([ends, [len(windows) - 1]])].tolist()):
            d, i = divmod(lo // room, len(self.reach))
            reach = int(self.reach[i])
            yield d, i, max(0, (lo % room - 1) * reach), (hi % room + 1) * reach


class Space:
    """Candidates by the cosine of two neighbouring passages and item pieces."""

    def __init__(self, item_terms: list[np.ndarray], least: np.ndarray, weighted: np.ndarray):
        self.weighted, self.heavy = weighted, np.abs(weighted).sum(axis=1) > 0
        self.reach = np.array([int(len(t) / LEAST_COMPACT) for t in item_terms], np.int64)
        parts = [(i, p) for i, t in enumerate(item_terms) if np.isfinite(least[i]) for p in pieces_of(t)]
        self.item = np.array([i for i, _ in parts], np.int64)
        vectors = np.array([weighted[p].sum(axis=0) for _, p in parts], np.float32).reshape(len(parts), weighted.shape[1])
        self.vectors = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-6)).T.copy()
        self.least = least[self.item].astype(np.float32)

    def regions(self, ids: np.ndarray, where: np.ndarray, held: list[np.ndarray], first: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, start, stop) around the passages that are near."""
        on = self.heavy[ids]
        if not len(self.item) or not on.any():
            return
        n = int(first[-1])
        p, _ = _project(ids[on], where[on], n, np.zeros(len(self.heavy)), self.weighted, unit=False)
        owner = np.repeat(np.arange(len(held)), np.diff(first))
        follows = np.flatnonzero(owner[:-1] == owner[1:])
        pair = p.copy()
        pair[follows] += p[follows + 1]
        length = np.linalg.norm(pair, axis=1)
        some = np.flatnonzero(length > 1e-6)
        rows, cols = [], []
        for i in range(0, len(some), CACHED):
            r, c = np.nonzero(pair[some[i:i + CACHED]] @ self.vectors >= self.least * length[some[i:i + CACHED], None])
            rows.append(some[i + r])
            cols.append(self.item[c])
        row, item = np.concatenate(rows), np.concatenate(cols)
        # Neighbouring hits of one item in one document join.
        order = np.lexsort((row, item, owner[row]))
        open_: tuple[int, int, int, int] | None = None
        for d, i, r in zip(owner[row[order]].tolist(), item[order].tolist(), row[order].tolist()):
            at, reach = (r - int(first[d])) * PASSAGE, int(self.reach[i])
            lo, hi = max(0, at - reach), at + 2 * PASSAGE + reach
            if open_ and open_[:2] == (d, i) and lo <= open_[3]:
                open_ = d, i, open_[2], max(hi, open_[3])
                continue
            if open_:
                yield open_
            open_ = d, i, lo, hi
        if open_:
            yield open_


def search(terms: DataFrame, items: list[tuple], item_terms: list[np.ndarray], df: np.ndarray, least: np.ndarray,
           weighted: np.ndarray, spread: np.ndarray) -> DataFrame:
    """(doc_id, item, cosine, lcs, answer, start, stop) of all leaks; item
    is the position in ``items``, start and stop are words of the document, and
    cosine is that of the item and the passages of the stretch, before scaling.
    Items with a finite ``least`` cosine are retrieved by it, the others by lists."""
    exact = np.flatnonzero(~np.isfinite(least))
    lists = [(part, Lists([item_terms[i] for i in part], df))
             for part in (exact[lo:lo + LIST_ITEMS].tolist() for lo in range(0, len(exact), LIST_ITEMS))]
    model = shared(terms.sparkSession, (Space(item_terms, least, weighted), item_terms, lists, spread))
    kind = terms.schema["doc_id"].dataType.simpleString()
    out_names = ["doc_id", "item", "cosine", "lcs", "answer", "start", "stop"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, item_terms, lists, spread = model()
        weighted = space.weighted
        here = np.zeros(len(weighted), bool)
        matchers: dict[int, tuple[Matcher, Matcher]] = {}

        def cosine(a: np.ndarray, b: np.ndarray) -> float:
            a, b = weighted[a].sum(axis=0) * spread, weighted[b].sum(axis=0) * spread
            return float(a @ b / max(float(np.linalg.norm(a) * np.linalg.norm(b)), 1e-12))

        for batch in batches:
            found: list[tuple] = []
            base = 0
            for ids, where, held, first in _passages(batch):
                near = space.regions(ids, where, held, first)
                listed = ((d, part[c], at, end) for part, of in lists for d, c, at, end in of.regions(held))
                for d, i, at, end in chain(near, listed):
                    words, item = held[d][at:end], item_terms[i]
                    here[words] = True
                    common = np.count_nonzero(here[item])
                    here[words] = False
                    if common < least_common(len(item)):
                        continue
                    if i not in matchers:
                        matchers[i] = Matcher(item), Matcher(item[-ANSWER_WORDS:])
                    whole, answer = matchers[i]
                    if leak := whole.best(words.tolist(), answer):
                        common, share, start, stop = leak[0], leak[1], at + leak[2], at + leak[3]
                        around = held[d][start // PASSAGE * PASSAGE:-(-stop // PASSAGE) * PASSAGE]
                        found.append((base + d, i, cosine(around, item), common / len(item), share, start, stop))
                base += len(held)
            cols_ = list(zip(*found)) if found else [[] for _ in range(7)]
            kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(cols_[0], pa.int64()))]
                + [pa.array(c, k) for c, k in zip(cols_[1:], kinds)], names=out_names)

    return terms.mapInArrow(run, f"doc_id {kind}, item long, cosine double, lcs double, answer double, start long, stop long")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, answer, start, stop): the best stretch of
    every document that holds a benchmark item; clean documents have no row.
    ``docs`` has (doc_id, text), ``benchmark`` (item_id, text)."""
    rows = benchmark.select("item_id", text_or_empty(F.col("text")).alias("text"))
    n_items = rows.count()
    blocks = max(1, -(-n_items // ITEM_BLOCK))
    found = []
    for b in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        items = [(r[0], words_of(r[1])) for r in part.orderBy("item_id", "text").collect()]
        items = [(i, w) for i, w in items if len(w) > 1 or w and not w[0].isdigit()]
        if not items:
            continue
        vocabulary = {w: k + 1 for k, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        item_terms = [np.array([vocabulary[w] for w in ws], np.int64) for _, ws in items]
        terms = written(term_rows(docs, vocabulary), "terms")
        df, n = passage_frequencies(terms, len(vocabulary))
        weight = np.log((n + 1) / (df + 1)) ** 2
        weight[df > MOST_SHARE * n] = 0
        weight[0] = 0
        basis, spread = latent_space(terms, weight)
        spread = np.maximum(spread / max(spread.max(initial=0.0), 1e-30), 1e-6)
        weighted = (basis / spread * weight[:, None]).astype(np.float32)
        weighted /= max(float(np.abs(weighted).max(initial=0.0)), 1e-30)
        least = floors(item_terms, df, n, weight, weighted)
        names = docs.sparkSession.createDataFrame(
            [(k, i) for k, (i, _) in enumerate(items)], f"item long, item_id {benchmark.schema['item_id'].dataType.simpleString()}")
        best = F.max_by(F.struct("cosine", "lcs", "answer", "start", "stop"),
                        F.struct("lcs", "answer", F.col("start") - F.col("stop"), -F.col("start"))).alias("best")
        # Names of one block of items: of fixed size.
        found.append(search(terms, items, item_terms, df, least, weighted, spread).join(F.broadcast(names), "item")
                     .groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*"))
    if not found:
        kinds = [f"{c} {d.schema[c].dataType.simpleString()}" for c, d in (("doc_id", docs), ("item_id", benchmark))]
        return docs.sparkSession.createDataFrame(
            [], ", ".join(kinds) + ", cosine double, lcs double, answer double, start long, stop long")
    return reduce(DataFrame.unionByName, found)
