"""Removal of word sequences that occur more than once in a corpus.

A window is ``WINDOW`` consecutive words of one document. Every word covered
by a window whose word sequence also starts anywhere else (same document
included) is removed; windows are judged on the input.

1. Count-min prefilter. A window is counted under its anchor, the run of
   ``ANCHOR`` words inside it with the smallest hash (the leftmost of equal
   ones); neighbouring windows mostly share one. Equal windows have equal
   anchors at different places, so an anchor's count is never below the count
   of any of its windows. Every batch of a task builds a small sketch of its
   anchors; sketches are merged by segments of cells, and the cells counted
   twice or more become a bitmap of fixed size (``ROWS * 2 ** WIDTH_BITS``
   bits), which is what is broadcast.
2. Exact grouping. Only windows whose anchor is estimated repeated are sent:
   once per window content and task batch, so a passage found in a third of
   all documents costs one row per batch, not one per copy. Windows are
   grouped by 96 bits of hash; those with two or more places flag their start.

A sketch that a larger corpus fills sends more windows to the second step and
loses none. Null texts have no words. Rows are told apart by a hash of id and
text; equal rows are each other's copies and get the same result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mediapanel.llm.common import text_or_empty

WINDOW = 35
ANCHOR = 18
ROWS = 2
WIDTH_BITS = 27
SEGMENT_BITS = 17
BLOCK_WORDS = 1_000_000       # words hashed at once
PIECE_WORDS = 4_000_000       # a longer document is cut into overlapping pieces
HASH_TABLE = 150_000          # words whose hash a task keeps
BATCH_ANCHORS = 4_000_000     # anchors per partial sketch
BATCH_WINDOWS = 2_000_000     # windows grouped before they are sent

M1, M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
CELL_MULTIPLIERS = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class _Powers:
    """Powers of an odd multiplier and of its inverse, modulo 2 ** 64."""

    def __init__(self, multiplier: int):
        self.m, self.inv, self.n = multiplier, pow(multiplier, -1, 2 ** 64), 0
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            steps = np.full(n, self.m, np.uint64), np.full(n, self.inv, np.uint64)
            for s in steps:
                s[0] = 1
            self.up, self.down = np.multiply.accumulate(steps[0]), np.multiply.accumulate(steps[1])
        return self.up[:n], self.down[:n]


def _run_hashes(values: np.ndarray, length: int, powers: _Powers) -> np.ndarray:
    """Polynomial hash of each run of ``length`` values."""
    up, down = powers.upto(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * down, out=sums[1:])
    n = len(values) - length + 1
    return (sums[length:] - sums[:-length]) * up[:n]


class WindowHasher:
    """Windows of documents, hashed in blocks of whole pieces."""

    def __init__(self, window: int, anchor: int):
        self.window, self.anchor = window, anchor
        self.hashes = _WordHashes()
        self.powers = _Powers(M1), _Powers(M2)

    def blocks(self, texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, ...]]:
        """Per block: row and start of every window, position (in the block)
        of its anchor, and the block's word hashes."""
        held: list[np.ndarray] = []
        rows: list[int] = []
        firsts: list[int] = []
        size = 0
        for row, text in texts:
            words = text.split()  # bytes: splits at \x20 and \x09-\x0D
            if len(words) < self.window:
                continue
            if len(self.hashes) > HASH_TABLE:
                self.hashes.clear()
            a = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
            for at in range(0, len(a) - self.window + 1, PIECE_WORDS):
                piece = a[at:at + PIECE_WORDS + self.window - 1]
                held.append(piece)
                rows.append(row)
                firsts.append(at)
                size += len(piece)
                if size >= BLOCK_WORDS:
                    yield self._block(held, rows, firsts)
                    held, rows, firsts, size = [], [], [], 0
        if held:
            yield self._block(held, rows, firsts)

    def _block(self, held, rows, firsts):
        sizes = np.array([len(x) for x in held])
        ends = np.cumsum(sizes)
        a = np.concatenate(held)
        piece = np.repeat(np.arange(len(held)), sizes)
        starts = np.flatnonzero(np.arange(len(a)) + self.window <= ends[piece])
        runs = _run_hashes(a, self.anchor, self.powers[0])
        where = np.uint64((1 << 24) - 1)
        low = (runs & ~where) | np.arange(len(runs), dtype=np.uint64)
        span, need = 1, self.window - self.anchor + 1
        while span * 2 <= need:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < need:
            low = np.minimum(low[:span - need], low[need - span:])
        anchor = (low[starts] & where).astype(np.int64)
        first = np.array(firsts) - (ends - sizes)
        own = piece[starts]
        return np.array(rows)[own], starts + first[own], starts, anchor, runs, a

    def window_hashes(self, a: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of hash of the windows at ``starts``."""
        h1 = _run_hashes(a, self.window, self.powers[0])[starts]
        mixed = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h2 = _run_hashes(mixed ^ (mixed >> np.uint64(32)), self.window, self.powers[1])[starts]
        return h1.view(np.int64), (h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _distinct_anchors(anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions never fall from one window to the next: distinct ones,
    and the index of each window's among them."""
    new = np.ones(len(anchor), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    return anchor[new], np.cumsum(new) - 1


def _cells(keys: np.ndarray, row: int, width_bits: int) -> np.ndarray:
    return ((keys * np.uint64(CELL_MULTIPLIERS[row])) >> np.uint64(64 - width_bits)).astype(np.int64)


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, bytes]]:
    for i, t in enumerate(batch.column(column).cast(pa.binary())):
        yield i, t.as_py()


def repeated_cells(docs: DataFrame, window: int, anchor: int, width_bits: int) -> np.ndarray:
    """Bitmaps (ROWS x bytes) of the sketch cells with a count of two or more."""
    segment_bits = min(SEGMENT_BITS, width_bits)
    cells = 1 << segment_bits

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WindowHasher(window, anchor)
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held)
            held.clear()
            for row in range(ROWS):
                found, n = np.unique(_cells(keys, row, width_bits), return_counts=True)
                for kind, part in ((1, found[n == 1]), (2, found[n > 1])):
                    segment = part >> segment_bits
                    at = np.flatnonzero(np.diff(segment, prepend=-1))
                    blobs = [x.astype(np.uint32).tobytes() for x in np.split(part & (cells - 1), at[1:])] if len(at) else []
                    yield pa.RecordBatch.from_arrays(
                        [pa.array((row << (width_bits - segment_bits)) + segment[at], pa.int32()),
                         pa.array([kind] * len(at), pa.int32()), pa.array(blobs, pa.binary())],
                        names=["segment", "n", "cells"])

        size = 0
        for batch in batches:
            for _, _, _, at, runs, _ in hasher.blocks(_texts(batch, "__text")):
                keys = runs[_distinct_anchors(at)[0]]
                held.append(keys)
                size += len(keys)
                if size >= BATCH_ANCHORS:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come ordered by segment: one dense counter array at a time."""
        current, counts = None, None

        def done() -> pa.RecordBatch:
            bits = np.packbits(counts >= 2, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([bits], pa.binary())],
                                              names=["segment", "bits"])

        for batch in batches:
            for segment, n, blob in zip(*[batch.column(i) for i in range(3)]):
                if segment.as_py() != current:
                    if current is not None:
                        yield done()
                    current, counts = segment.as_py(), np.zeros(cells, np.uint8)
                at = np.frombuffer(blob.as_py(), np.uint32)
                counts[at] = np.minimum(counts[at] + np.uint8(n.as_py()), 2)  # only "two or more" is asked
        if current is not None:
            yield done()

    parts = (docs.select(text_or_empty(F.col("text")).alias("__text"))
             .mapInArrow(sketch, "segment int, n int, cells binary"))
    merged = (parts.repartition("segment").sortWithinPartitions("segment")
              .mapInArrow(merge, "segment int, bits binary").toArrow())
    out = np.zeros((ROWS << (width_bits - segment_bits), cells // 8), np.uint8)
    for segment, bits in zip(merged.column(0).to_pylist(), merged.column(1)):
        out[segment] = np.frombuffer(bits.as_py(), np.uint8)
    return out.reshape(ROWS, -1)


def repeated_starts(docs: DataFrame, bitmaps: np.ndarray, window: int, anchor: int, width_bits: int) -> DataFrame:
    """(row_key, row_crc, starts, more): start words of the windows of a row
    that occur more than once, as a list and as a list of int32 arrays."""
    sketch = docs.sparkSession.sparkContext.broadcast(bitmaps)
    names = ["h1", "h2", "n", "row_key", "row_crc", "start", "starts"]
    schema = "h1 long, h2 int, n int, row_key long, row_crc int, start int, starts binary"

    def grouped(keys, crcs, rows, starts, h1, h2) -> pa.RecordBatch:
        """Contents found once here go with their place. Of contents found
        more often, one row without a place tells others; their places are
        settled, and go as one row per document under a key of their own."""
        order = np.lexsort((h2, h1))
        same = np.zeros(len(order), bool)
        a, b = order[:-1], order[1:]
        same[1:] = (h1[a] == h1[b]) & (h2[a] == h2[b])
        many = same.copy()
        many[:-1] |= same[1:]
        single, heads, settled = order[~many], order[many & ~same], np.sort(order[many])
        row_of = rows[settled]
        at = np.flatnonzero(np.diff(row_of, prepend=-1))
        blobs = [x.astype(np.int32).tobytes() for x in np.split(starts[settled], at[1:])] if len(at) else []
        docs_ = row_of[at] if len(at) else np.zeros(0, np.int64)
        k, m = len(heads), len(blobs)
        cols = [np.concatenate([h1[single], h1[heads], keys[docs_]]),
                np.concatenate([h2[single], h2[heads], crcs[docs_]]),
                np.concatenate([np.ones(len(single), np.int32), np.full(k + m, 2, np.int32)])]
        place = np.concatenate([rows[single], np.zeros(k, np.int64), docs_])
        no_row, no_start = np.zeros(len(place), bool), np.ones(len(place), bool)
        no_row[len(single):len(single) + k] = True
        no_start[:len(single)] = False
        begin = np.concatenate([starts[single], np.zeros(k + m, np.int64)])
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
             pa.array(keys[place], pa.int64(), mask=no_row), pa.array(crcs[place], pa.int32(), mask=no_row),
             pa.array(begin.astype(np.int32), pa.int32(), mask=no_start),
             pa.array([None] * (len(single) + k) + blobs, pa.binary())], names=names)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = sketch.value
        hasher = WindowHasher(window, anchor)
        held: list[tuple[np.ndarray, ...]] = []
        keys: list[np.ndarray] = []
        crcs: list[np.ndarray] = []
        size = base = 0

        def flush() -> pa.RecordBatch:
            out = grouped(np.concatenate(keys), np.concatenate(crcs), *[np.concatenate(x) for x in zip(*held)])
            held.clear()
            return out

        for batch in batches:
            keys.append(batch.column("row_key").to_numpy())
            crcs.append(batch.column("row_crc").to_numpy())
            for rows, first, starts, at, runs, a in hasher.blocks(_texts(batch, "__text")):
                anchors, index = _distinct_anchors(at)
                maybe = np.ones(len(anchors), bool)
                for r in range(ROWS):
                    c = _cells(runs[anchors], r, width_bits)
                    maybe &= (bitmaps[r][c >> 3] >> (c & 7).astype(np.uint8)) & 1 == 1
                on = np.flatnonzero(maybe[index])
                if len(on):
                    held.append((rows[on] + base, first[on], *hasher.window_hashes(a, starts[on])))
                    size += len(on)
            base += batch.num_rows
            if size >= BATCH_WINDOWS:
                yield from _cut(flush())
                keys, crcs, size, base = [], [], 0, 0
        if held:
            yield from _cut(flush())

    def _cut(out: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(0, out.num_rows, 50_000):
            yield out.slice(i, 50_000)

    src = docs.select("row_key", "row_crc", text_or_empty(F.col("text")).alias("__text"))
    found = src.mapInArrow(candidates, schema)
    places = F.sum("n").over(W.partitionBy("h1", "h2"))
    return (found.withColumn("places", places).where((F.col("places") >= 2) & F.col("row_key").isNotNull())
            .groupBy("row_key", "row_crc")
            .agg(F.collect_list("start").alias("starts"), F.collect_list("starts").alias("more")))


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, width_bits: int = WIDTH_BITS,
                   with_text: bool = True) -> DataFrame:
    """``docs`` (with ``text``; its columns stay but for ``text``) plus
    n_words, n_removed, kept_sha256 and, ``with_text``, the kept text."""
    if not 1 <= anchor <= window:
        raise ValueError("1 <= anchor <= window")
    cols = [c for c in docs.columns if c not in ("text", "row_key", "row_crc", "n_words", "n_removed", "kept_sha256")]
    text = text_or_empty(F.col("text"))
    key = "doc_id" if "doc_id" in docs.columns else "text"
    rows = docs.select(*cols, text.alias("text"), F.xxhash64(F.col(key).cast("string"), text).alias("row_key"),
                       (F.crc32(text.cast("binary")) - 2 ** 31).cast("int").alias("row_crc"))
    bitmaps = repeated_cells(rows, window, anchor, width_bits)
    flags = repeated_starts(rows, bitmaps, window, anchor, width_bits)
    joined = rows.join(flags, ["row_key", "row_crc"], "left").select(*cols, "text", "starts", "more")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:len(cols)]]
                       + ["n_words long", "n_removed long", "kept_sha256 string"] + ["text string"] * with_text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
                n_words, n_removed, sha, kept_texts = [], [], [], []
                for t, starts, more in zip(batch.column("text").cast(pa.binary()), batch.column("starts"),
                                           batch.column("more")):
                    words = t.as_py().split()
                    n = len(words)
                    if starts.is_valid:
                        on = np.zeros(n + 1, np.int32)
                        at = [np.asarray(starts.as_py(), np.int64)]
                        at += [np.frombuffer(x, np.int32).astype(np.int64) for x in more.as_py()]
                        at = np.unique(np.concatenate(at))
                        np.add.at(on, at, 1)
                        np.add.at(on, at + window, -1)
                        keep = np.cumsum(on[:n]) == 0
                        words = [w for w, k in zip(words, keep.tolist()) if k]
                    kept = b" ".join(words)
                    n_words.append(n)
                    n_removed.append(n - len(words))
                    sha.append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        kept_texts.append(kept.decode("utf-8"))
                out = [batch.column(i) for i in range(len(cols))]
                out += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())]
                if with_text:
                    out.append(pa.array(kept_texts, pa.string()))
                yield pa.RecordBatch.from_arrays(
                    out, names=cols + ["n_words", "n_removed", "kept_sha256"] + ["text"] * with_text)

    return joined.mapInArrow(cut, schema)
