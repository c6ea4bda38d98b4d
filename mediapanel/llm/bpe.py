"""BPE encoding and decoding with a public word-end vocabulary file.

The encoder follows the file: special tokens are cut out of the raw text, the
rest is normalised (NFC, white space, lower case), split by the file's word
pattern, mapped to byte symbols, and each word is merged by a priority queue
of merge ranks over a doubly linked symbol list; queue entries whose pair is
no longer there are skipped. Decoding concatenates vocabulary strings, joined
as the file's (absent) decoder joins them: by one space.

A text is normalised and split whole; no rule looks across white space. Each
word of the pattern is merged once and kept in a table of two generations of
bounded size: a full one becomes the old one, from which words in use return.
Texts with control characters that Python counts as white space and the file
does not are cut at spaces first.

Null text counts as empty and gives no tokens. Very long texts need memory in
proportion to their own length; rows go out in slices of ``SLICE``. Rows are
independent, so ties and repeated rows change nothing; an empty table gives no
rows. Kept columns that have the name of an output are replaced by it; other
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediapanel.llm.common import text_or_empty

WORD_TABLE = 200_000  # words of a generation that a task keeps the encoding of
SLICE = 128
PLACE = 1 << 32       # queue entries are rank * PLACE + position, which sort as the pair does


def load_vocabulary(path: str) -> dict:
    """The parts of a tokenizers file that the encoder needs; other kinds of
    file are refused rather than encoded wrongly."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
    pre = spec["pre_tokenizer"]["pretokenizers"]
    if (model["type"] != "BPE" or spec["decoder"] is not None or model.get("continuing_subword_prefix")
            or steps != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"]):
        raise ValueError(f"unsupported tokenizer file: {path}")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": merges, "suffix": model["end_of_word_suffix"] or "",
            "pattern": pre[0]["pattern"]["Regex"],
            "special": {t["content"]: t["id"] for t in spec["added_tokens"]}}


def byte_symbols() -> list[str]:
    """Printable symbol of each byte: itself where Latin-1 prints it, else the
    next free code point from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(prints)]
    table = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


class Encoder:
    def __init__(self, spec: dict):
        import regex
        self.vocab, self.suffix, self.special = spec["vocab"], spec["suffix"], spec["special"]
        self.names = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.set_merges([(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in spec["merges"]])
        self.pattern = regex.compile(spec["pattern"])
        marks = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.symbols = byte_symbols()
        self.odd_space = regex.compile("[\x1c-\x1f]")
        self.words: dict[str, tuple[bytes, str]] = {}
        self.old: dict[str, tuple[bytes, str]] = {}

    def set_merges(self, merges: list[tuple[int, int, int]]) -> None:
        """By rank: the pair's symbols and what it becomes. By pair: its queue
        entry at position 0."""
        self.parts = merges
        self.ranks = {(a, b): rank * PLACE for rank, (a, b, _) in enumerate(merges)}

    def merge(self, word: str) -> list[int]:
        """Ids of one pre-token: the cheapest pair is merged until none is left."""
        symbols = [self.symbols[b] for b in word.encode("utf-8")]
        symbols[-1] += self.suffix
        ids = [self.vocab[s] for s in symbols if s in self.vocab]
        n = len(ids)
        if n < 2:
            return ids
        find, parts = self.ranks.get, self.parts
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [r + i for i, pair in enumerate(zip(ids, ids[1:])) if (r := find(pair)) is not None]
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), PLACE)
            a, b, merged = parts[rank]
            if ids[i] != a or (j := right[i]) >= n or ids[j] != b:
                continue  # stale: one side has been merged meanwhile
            ids[i], ids[j] = merged, -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (r := find((merged, ids[k]))) is not None:
                    heapq.heappush(queue, r + i)
            if (h := left[i]) >= 0 and (r := find((ids[h], merged))) is not None:
                heapq.heappush(queue, r + h)
        return [x for x in ids if x >= 0]

    def _word(self, word: str) -> tuple[bytes, str]:
        """Ids and decoded text of a word that is not in the new generation."""
        if (hit := self.old.get(word)) is None:
            ids = self.merge(word)
            hit = struct.pack(f"<{len(ids)}I", *ids), self.decode(ids)
        if len(word) <= 64:
            if len(self.words) >= WORD_TABLE:
                self.old, self.words = self.words, {}
            self.words[word] = hit
        return hit

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        """Words of a text without special tokens."""
        import unicodedata
        # Lower case letter by letter: no final-sigma rule.
        low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        known = self.words.get
        return [known(w) or self._word(w) for w in self.pattern.findall(low)]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.names[i] for i in ids if i in self.names)

    def encode(self, text: str) -> tuple[bytes, int, str]:
        """Ids as little-endian 32-bit integers, their number, decoded text."""
        parts = self.cut.split(text) if self.cut is not None and "<|" in text else [text]
        found: list[tuple[bytes, str]] = []
        for part in parts:
            if part in self.special:
                i = self.special[part]
                found.append((struct.pack("<I", i), self.names[i]))
            elif self.odd_space.search(part):
                for chunk in part.replace("\x85", " ").split(" "):
                    found += self._plain(chunk)
            else:
                found += self._plain(part)
        ids = b"".join([x[0] for x in found])
        return ids, len(ids) // 4, " ".join([x[1] for x in found if x[0]])


def encode_texts(docs: DataFrame, vocabulary: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
                 outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``keep`` columns plus n_tokens, SHA-256 of ids and of the decoded text,
    and those of ``outputs``: the ids and the decoded text themselves.
    ``vocabulary`` is the path of a tokenizers file, read by the driver; its
    content (a few MB, whatever the input) goes to the tasks by broadcast."""
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(load_vocabulary(vocabulary))
    made = ("n_tokens", "ids_sha256", "decoded_sha256", *outputs)
    src = docs.select(*[F.col(c) for c in keep if c not in made], text_or_empty(F.col(text)).alias("__text"))
    fields = [(f.name, f) for f in src.schema.fields[:-1]]
    schema = ", ".join([f"`{n}` {f.dataType.simpleString()}" for n, f in fields]
                       + ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
                       + [f"{o} {'binary' if o == 'ids' else 'string'}" for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(spec.value)
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                n, ids_hash, text_hash, ids, texts = [], [], [], [], []
                for t in part.column("__text"):
                    b, k, d = enc.encode(t.as_py())
                    n.append(k)
                    ids_hash.append(hashlib.sha256(b).hexdigest())
                    text_hash.append(hashlib.sha256(d.encode("utf-8")).hexdigest())
                    if "ids" in outputs:
                        ids.append(b)
                    if "decoded" in outputs:
                        texts.append(d)
                cols = [part.column(i) for i in range(part.num_columns - 1)]
                cols += [pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
                names = [x for x, _ in fields] + ["n_tokens", "ids_sha256", "decoded_sha256"]
                for o in outputs:
                    cols.append(pa.array(ids, pa.binary()) if o == "ids" else pa.array(texts, pa.string()))
                    names.append(o)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, schema)
