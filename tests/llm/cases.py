"""Small documents with the awkward rows that every operator has to survive."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SYLLABLES = {
    "en": "the ing and tion ent ly wh sh ea ou er st".split(),
    "de": "der sch ung keit ein ver lich zu ch au tz".split(),
}


def prose(rng: random.Random, lang: str, words: int) -> str:
    parts = SYLLABLES[lang]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words))


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    out: list[tuple[int | None, str | None]] = [
        (0, None), (1, ""), (2, " \t\n\x0b\x0c\r "), (3, "one"), (4, "one two three"), (5, "ONE two\tthree"),
        (6, "... !!! 123 456"), (7, "é ñ ß 日本語 🎉  x"), (8, "a " * 120), (9, "A a " * 60), (None, "a null id"),
        (None, None), (10, "x" * 20_000), (11, "nul \x00 and \x1c controls \x85 here")]
    base = prose(rng, "en", 120)
    for i in range(20, 30):
        out.append((i, prose(rng, "en" if i % 2 else "de", rng.randint(1, 300))))
    words = base.split()
    out += [(40, base), (41, base), (42, base.upper()), (43, " ".join(words[:60] + ["changed"] + words[61:])),
            (44, " ".join(words[:100])), (45, " ".join(words[20:])), (46, prose(rng, "de", 40) + " " + " ".join(words[30:80]))]
    out += [(47, prose(rng, "en", 30_000)), (48, " ".join(["line of text that repeats"] * 50))]
    out += [(40, base), (40, "another text under the same id"), (0, None)]  # repeated ids and rows
    return out


def frame(spark, rows=None, **extra):
    df = spark.createDataFrame(texts() if rows is None else rows, "doc_id long, text string").repartition(3)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


# Names that operators use themselves.
CLASHES = {"row_key": "k", "score": 7, "predicted": 9, "n": 1, "cid": 2, "start": 3, "kind": "x", "n_tokens": 4,
           "shard": 5, "ids": "i", "lang_pred": "q", "label": 0, "value": 1, "word": "w", "linked": True}
