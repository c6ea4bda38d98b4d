"""Language identification by prediction by partial matching.

Every language has a variable-order context tree over the bytes of its
training text: for each context of up to ``ORDER`` bytes, how often each byte
followed. A byte seen c times in a context with total T and D distinct bytes
costs ``-log2(c / (T + D))`` bits; an unseen byte costs the escape
``-log2(D / (T + D))`` plus its cost in the context one byte shorter, down to
1/256 for a byte never seen at all. An unknown context is passed over free of
charge. The statistics are frozen after training, so a text has one exact code
length per language; the shortest one wins, and the score is its share of
``2 ** -length`` over the languages.

Text is lower-cased and every run of other characters than letters becomes one
space, so junk and casing carry no weight. Training takes at most about
``TRAIN_CHARS`` characters per language, whole documents chosen by a hash of
their id; that bounds the trees that are sent to the tasks, at any input size.

Null texts and texts without a letter are ``und`` with score 0; so is every
text if there is nothing to learn from. Ties go to the first language in
alphabetical order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediapanel.llm.common import fold, shared

ORDER = 3
TRAIN_CHARS = 1_500_000
# Positions scored at once, times the number of languages.
CELLS = 3_000_000
# A longer text is scored in pieces of this many bytes that overlap by ORDER.
PIECE = 500_000

NOT_LETTERS = re.compile(r"[\W\d_]+")
MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in MAYBE_LETTER.finditer(text))


def normalised(text: str) -> bytes:
    """Letters in lower case, words apart by one space, behind ORDER spaces."""
    return b" " * ORDER + NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def _gram_codes(data: np.ndarray, length: int) -> np.ndarray:
    """Code of the ``length`` bytes that end at each position from ORDER on."""
    n = len(data) - ORDER
    code = np.zeros(n, np.int64)
    for i in range(length):
        code = (code << 8) | data[ORDER + 1 - length + i:ORDER + 1 - length + i + n]
    return code


def gram_counts(train: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, length, code, n): how often each gram of 1 to ORDER + 1 bytes
    occurs. Summed per batch before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[bytes]] = {}
            for t, name in zip(batch.column(0), batch.column(1)):
                by_lang.setdefault(name.as_py(), []).append(normalised(t.as_py()))
            for name, texts in by_lang.items():
                for m in range(1, ORDER + 2):
                    codes, n = np.unique(np.concatenate(
                        [_gram_codes(np.frombuffer(t, np.uint8).astype(np.int64), m) for t in texts]),
                        return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(codes), pa.string()), pa.array([m] * len(codes), pa.int32()),
                         pa.array(codes, pa.int64()), pa.array(n, pa.int64())],
                        names=["lang", "length", "code", "n"])

    return (train.select(F.col(text), F.col(lang))
            .mapInArrow(run, "lang string, length int, code long, n long")
            .groupBy("lang", "length", "code").agg(F.sum("n").alias("n")))


class ContextTrees:
    """The trees of all languages as one tree with a row of costs per node.

    Node m of a position is the gram of m bytes that ends there; ``child[m]``
    leads from the node of the m bytes before to the node with one byte more
    (0: not in any language)."""

    def __init__(self, grams: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]]):
        self.langs = sorted(grams)
        n_langs = len(self.langs)
        alphabet = sorted({32} | {int(b) for g in grams.values() for b in g[1][0]})
        self.letter = np.zeros(256, np.int64)
        self.letter[alphabet] = np.arange(1, len(alphabet) + 1)
        self.width = len(alphabet) + 1
        self.child: list[np.ndarray] = [np.zeros(0, np.int32)]
        self.cost: list[np.ndarray] = [np.full((1, n_langs), 8.0)]  # a byte never seen
        self.escape: list[np.ndarray] = []  # by node of the context, 0: unknown context
        codes = [np.zeros(1, np.int64)]  # of the nodes of each length, without node 0
        nodes = {ORDER + 1: np.unique(np.concatenate([grams[x][ORDER + 1][0] for x in self.langs]))}
        for m in range(ORDER, 0, -1):  # the spaces before a text are contexts, though no grams
            nodes[m] = np.unique(np.concatenate([grams[x][m][0] for x in self.langs] + [nodes[m + 1] >> 8]))
        for m in range(1, ORDER + 2):
            here = nodes[m]
            parents = (np.searchsorted(codes[m - 1], here >> 8) + 1) if m > 1 else np.ones(len(here), np.int64)
            parent_rows = len(codes[m - 1]) + 1
            child = np.zeros(parent_rows * self.width, np.int32)
            child[parents * self.width + self.letter[here & 255]] = np.arange(1, len(here) + 1)
            self.child.append(child)
            counts = np.zeros((len(here), n_langs))
            for j, x in enumerate(self.langs):
                counts[np.searchsorted(here, grams[x][m][0]), j] = grams[x][m][1]
            total, kinds = np.zeros((parent_rows, n_langs)), np.zeros((parent_rows, n_langs))
            np.add.at(total, parents, counts)
            np.add.at(kinds, parents, counts > 0)
            known = kinds > 0
            escape = np.where(known, -np.log2(np.where(known, kinds / np.maximum(total + kinds, 1), 1)), 0.0)
            self.escape.append(escape)
            if m == 1:
                shorter = np.full((len(here), n_langs), 8.0)
            else:  # the same last byte behind a context one byte shorter
                shorter = self.cost[m - 1][np.searchsorted(codes[m - 1], here & ((1 << 8 * (m - 1)) - 1)) + 1]
            seen = counts > 0
            hit = -np.log2(np.where(seen, counts, 1) / np.maximum(total + kinds, 1)[parents])
            cost = np.where(seen, hit, escape[parents] + shorter)
            self.cost.append(np.vstack([np.zeros((1, n_langs)), cost]))
            codes.append(here)
        self.top = self.cost[ORDER + 1].astype(np.float32)

    def code_lengths(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Bits of each piece of ``data`` (pieces begin at ``starts``; their
        first ORDER bytes are context only), by language."""
        letters = self.letter[data]
        nodes = [np.ones(len(data), np.int64)]
        for m in range(1, ORDER + 2):
            before = nodes[m - 1]
            if m > 1:
                before = np.concatenate([np.zeros(1, before.dtype), before[:-1]])
            nodes.append(self.child[m][before * self.width + letters])
        counted = np.ones(len(data), bool)
        for i in range(ORDER):
            counted[starts + i] = False
        top = nodes[ORDER + 1]
        bits = self.top[np.where(counted, top, 0)].astype(np.float64)
        missed = np.flatnonzero(counted & (top == 0))
        rest = missed
        for m in range(ORDER + 1, 0, -1):  # escape from contexts of m - 1 bytes
            context = nodes[m - 1][rest - 1] if m > 1 else np.ones(len(rest), np.int64)
            bits[rest] += self.escape[m - 1][context]
            if m == 1:
                bits[rest] += 8.0
                break
            found = nodes[m - 1][rest] > 0
            bits[rest[found]] += self.cost[m - 1][nodes[m - 1][rest[found]]]
            rest = rest[~found]
        return np.add.reduceat(bits, starts, axis=0)


def train_trees(docs: DataFrame, text: str, lang: str, key: str, train_chars: int = TRAIN_CHARS) -> ContextTrees | None:
    """Trees of the languages of ``docs`` (rows with a null are left out), from
    a sample of whole documents of about ``train_chars`` per language, one with
    a letter at least. What comes to the driver is two numbers per language and the grams of that sample."""
    rows = docs.select(F.col(text), F.col(lang).cast("string").alias(lang), F.col(key)).where(
        F.col(text).isNotNull() & F.col(lang).isNotNull())
    draw = F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), 11) / float(2 ** 53)
    found = [r for r in rows.groupBy(lang).agg(
        F.sum(F.length(text)), F.min(F.when(F.regexp_like(text, F.lit(r"\p{L}")), draw))).collect() if r[1]]
    totals = {r[0]: r[1] for r in found}
    if not totals:
        return None
    share = F.create_map(*[x for name, n in totals.items()
                           for x in (F.lit(name), F.lit(min(1.0, train_chars / n)))])
    # The smallest draw is in whatever its length, so that no language is without a document.
    first = F.create_map(*[x for r in found for x in (F.lit(r[0]), F.lit(r[2]).cast("double"))])
    sample = rows.where((F.coalesce(share[F.col(lang)], F.lit(0.0)) > draw)
                        | F.coalesce(first[F.col(lang)] == draw, F.lit(False)))
    counts = gram_counts(sample, text, lang).toArrow().to_pandas()
    grams: dict[str, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
    for (name, m), part in counts.sort_values("code").groupby(["lang", "length"]):
        grams.setdefault(name, {})[m] = (part["code"].to_numpy(), part["n"].to_numpy())
    return ContextTrees(grams) if grams else None


def _pieces(text: str) -> Iterator[bytes]:
    data = normalised(text)
    for i in range(0, max(1, len(data) - ORDER), PIECE):
        yield data[i:i + PIECE + ORDER]


def identify(docs: DataFrame, trees: ContextTrees | None, text: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``score``; only ``text`` is looked at."""
    if trees is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    model = shared(docs.sparkSession, trees)
    kept = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    src = docs.select(*kept, F.col(text).cast("string").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + ["lang_pred string", "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = model()
        n_langs = len(trees.langs)
        room = max(20_000, CELLS // n_langs)
        for batch in batches:
            bits = np.zeros((batch.num_rows, n_langs))
            judged = np.zeros(batch.num_rows, bool)
            held: list[tuple[int, bytes]] = []
            size = 0

            def flush() -> None:
                if held:
                    starts = np.cumsum([0] + [len(x) for _, x in held[:-1]])
                    data = np.frombuffer(b"".join([x for _, x in held]), np.uint8)
                    np.add.at(bits, [i for i, _ in held], trees.code_lengths(data, starts))
                    held.clear()

            for i, t in enumerate(batch.column(batch.num_columns - 1)):
                t = t.as_py()
                if t is None or not has_letter(t):
                    continue
                judged[i] = True
                for piece in _pieces(t):
                    held.append((i, piece))
                    size += len(piece)
                    if size >= room:
                        flush()
                        size = 0
            flush()
            best = bits.argmin(axis=1)
            share = np.exp2(bits.min(axis=1, keepdims=True) - bits)
            score = np.where(judged, 1.0 / share.sum(axis=1), 0.0)
            names = [trees.langs[b] if on else "und" for b, on in zip(best, judged)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 1)]
                + [pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=kept + ["lang_pred", "score"])

    return src.mapInArrow(run, schema)


def identify_documents(docs: DataFrame, folds: int = 3, held: int = 1, train_chars: int = TRAIN_CHARS) -> DataFrame:
    """Learn from the documents outside the held-out fold, predict all."""
    out = fold(F.col("doc_id"), folds) == held
    trees = train_trees(docs.where(~out), "text", "lang", "doc_id", train_chars)
    return (identify(docs.select("doc_id", out.alias("held_out"), "text"), trees)
            .select("doc_id", "held_out", "lang_pred", "score"))
