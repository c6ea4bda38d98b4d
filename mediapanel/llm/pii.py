"""Personal data by bootstrapped contextual extraction, in SQL functions only.

Base spans come from four fixed patterns (email, ip, card, phone), each
leftmost and not overlapping within its kind, and then checked (parts of an
address at most 255, Luhn, digit counts); what fails is dropped, not retried.

The base spans are seeds. A lexical pattern is the word to the left of an
instance; other tokens that look like identifiers are unlabelled instances.
Patterns and instances form a bipartite graph that is scored in rounds: a
pattern's confidence in a kind is the mean score of its distinct instances in
that kind, and an unlabelled instance is scored by the patterns it stands in,
as far as those have a confidence of ``LEAST_CONFIDENCE`` and ``LEAST_SUPPORT``
seeds at least. After ``ROUNDS`` rounds the instances that such patterns reach
become further spans. Base spans always stay.

Offsets are code points, ends exclusive. Null text counts as empty. Rows are
told apart by a hash of id and text; equal rows have equal results. The
patterns are written so that Java matches them in linear time and without
recursion; they find what the plain ones find:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``: a match that
  begins inside a run of local-part characters would begin at the run's start,
  or where the match before ended;
* ip and card: shorter runs of digits fail the checks anyway.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mediapanel.llm.common import text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for its pattern to be tried.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# A token with a digit or an at sign.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
CONTEXT = 40             # characters to the left that may hold the pattern's word
LEAST_LENGTH, MOST_LENGTH = 6, 64   # of an unlabelled instance
LEAST_DIGITS = 5
LEAST_CONFIDENCE = 0.8
LEAST_SUPPORT = 5
ROUNDS = 3


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def valid(kind: Column, value: Column) -> Column:
    n = F.length(_digits(value))
    part = F.lit(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$")
    parts = F.forall(F.split(value, r"\."), lambda p: F.regexp_like(p, part))
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", parts)
            .when(kind == "card", (n >= 13) & (n <= 19) & F.call_function("luhn_check", _digits(value)))
            .otherwise((n >= 9) & (n <= 15)))


def _left_word(before: Column) -> Column:
    return F.regexp_extract(F.lower(F.right(before, F.lit(CONTEXT))), r"(\p{L}+)[^\p{L}]*$", 1)


def _found(text: Column, pattern: str, hint: str | None) -> Column:
    """Matches of a text in order: value, length of the text before it since
    the match before, and the word to its left; null if there is none."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.zip_with(hits, F.transform(F.slice(gaps, 1, F.size(gaps) - 1),
                                          lambda g: F.struct(F.length(g).alias("gap"), _left_word(g).alias("word"))),
                        lambda v, g: F.struct(v.alias("value"), g["gap"].alias("gap"), g["word"].alias("word")))
    guard = F.regexp_like(text, F.lit("[0-9]")) if hint is None else F.contains(text, F.lit(hint))
    return F.when(guard, zipped)


def row_key(id_col: str = "doc_id", text: str = "text") -> Column:
    t = text_or_empty(F.col(text))
    return F.concat_ws("/", F.hex(F.xxhash64(F.col(id_col).cast("string"), t)), F.hex(F.crc32(t.cast("binary"))))


def matches(rows: DataFrame) -> DataFrame:
    """(row_key, kind, value, start, end, word) of all raw matches of ``rows``
    (row_key, text); kind ``token`` are the identifier-like tokens."""
    cols = {k: _found(F.col("text"), PATTERNS[k], HINTS[k]) for k in KINDS}
    cols["token"] = _found(F.col("text"), TOKEN, None)
    table = rows.select("row_key", *[c.alias(k) for k, c in cols.items()])
    table = table.where(reduce(lambda a, b: a | b, [F.size(F.coalesce(F.col(k), F.array())) > 0 for k in cols]))
    table = written(table, "matches").dropDuplicates(["row_key"])
    parts = [table.where(F.col(k).isNotNull()).select("row_key", F.lit(k).alias("kind"), F.posexplode(k).alias("i", "m"))
             for k in cols]
    before = W.partitionBy("row_key", "kind").orderBy("i")
    n = F.length("m.value")
    return (reduce(DataFrame.unionByName, parts)
            .withColumn("end", F.sum(F.col("m.gap") + n).over(before))
            .select("row_key", "kind", F.col("m.value").alias("value"),
                    (F.col("end") - n).cast("long").alias("start"), F.col("end").cast("long").alias("end"),
                    F.col("m.word").alias("word")))


def instances(found: DataFrame) -> DataFrame:
    """Checked base spans, and identifier-like tokens that touch none of them
    (kind null), without the punctuation around them."""
    base = found.where((F.col("kind") != "token") & valid(F.col("kind"), F.col("value")))
    lead = F.length(F.regexp_extract("value", r"^[^\p{L}\p{N}+@]*+", 0))
    core = F.regexp_replace(F.regexp_replace("value", r"^[^\p{L}\p{N}+@]++", ""), r"(?<=[\p{L}\p{N}])[^\p{L}\p{N}]++$", "")
    token = (found.where((F.col("kind") == "token") & (F.length("value") <= 2 * MOST_LENGTH))
             .withColumn("start", F.col("start") + lead).withColumn("value", core)
             .withColumn("end", F.col("start") + F.length("value"))
             .where(F.length("value").between(LEAST_LENGTH, MOST_LENGTH) & (F.col("word") != "")
                    & ((F.length(_digits(F.col("value"))) >= LEAST_DIGITS) | F.contains("value", F.lit("@"))))
             .withColumn("kind", F.lit(None).cast("string")))
    both = base.unionByName(token)
    here = W.partitionBy("row_key").orderBy("start", "end")
    is_base = F.col("kind").isNotNull()
    reach = F.max(F.when(is_base, F.col("end"))).over(here.rowsBetween(W.unboundedPreceding, -1))
    ahead = F.min(F.when(is_base, F.col("start"))).over(here.rowsBetween(1, W.unboundedFollowing))
    return (both.withColumn("reach", reach).withColumn("ahead", ahead)
            .where(is_base | ((F.coalesce("reach", F.lit(-1)) <= F.col("start"))
                              & (F.coalesce("ahead", F.col("end")) >= F.col("end"))))
            .drop("reach", "ahead"))


def bootstrap(inst: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(word, value, kind) of unlabelled instances that trusted patterns reach."""
    edges = written(inst.where(F.col("word") != "").groupBy("word", "value").agg(F.max("kind").alias("kind")), "edges")
    seeds = edges.where(F.col("kind").isNotNull()).select("value", "kind").distinct().withColumn("score", F.lit(1.0))
    open_ = edges.where(F.col("kind").isNull()).select("word", "value").join(seeds.select("value"), "value", "left_anti")
    open_ = written(open_, "open-edges")
    sizes = written(edges.groupBy("word").agg(F.countDistinct("value").alias("n")), "sizes")
    seeded = written(edges.where(F.col("kind").isNotNull()).groupBy("word", "kind")
                     .agg(F.countDistinct("value").cast("double").alias("support")), "patterns")
    reached = None
    for _ in range(rounds):
        # What was reached counts by score for every word it stands behind, also for words without a seed.
        support = seeded if reached is None else seeded.unionByName(
            open_.join(reached, "value").groupBy("word", "kind").agg(F.sum("score").alias("support")))
        trusted = (support.groupBy("word", "kind").agg(F.sum("support").alias("sum"))
                   .where(F.col("sum") >= LEAST_SUPPORT).join(sizes, "word")
                   .withColumn("confidence", F.least(F.lit(1.0), F.col("sum") / F.col("n")))
                   .where(F.col("confidence") >= LEAST_CONFIDENCE).select("word", "kind", "confidence"))
        scored = (open_.join(trusted, "word").groupBy("value", "kind")
                  .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score")))
        best = W.partitionBy("value").orderBy(F.desc("score"), "kind")
        reached = written(scored.withColumn("r", F.row_number().over(best)).where("r = 1").drop("r"), "reached")
    return (open_.join(trusted.select("word", "kind"), "word").join(reached.select("value", "kind"), ["value", "kind"])
            .select("word", "value", "kind").distinct())


def spans(rows: DataFrame) -> DataFrame:
    """(row_key, kind, start, end, base) of all spans of ``rows`` (row_key, text)."""
    inst = written(instances(matches(rows)), "instances")
    more = inst.where(F.col("kind").isNull()).drop("kind").join(bootstrap(inst), ["word", "value"])
    cols = ["row_key", "kind", "start", "end"]
    return (inst.where(F.col("kind").isNotNull()).select(*cols, F.lit(True).alias("base"))
            .unionByName(more.select(*cols, F.lit(False).alias("base"))))


def find(docs: DataFrame) -> DataFrame:
    """Counts of base spans per kind, the hash of the base spans and the list
    of all spans, per row of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", row_key().alias("row_key"), text_or_empty(F.col("text")).alias("text"))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    per_row = (spans(rows.select("row_key", "text"))
               .groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct(
                   order.alias("o"), "start", "end", "kind", "base"))).alias("all")))

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    every = F.coalesce("all", F.expr("array()").cast("array<struct<o:bigint,start:bigint,end:bigint,kind:string,base:boolean>>"))
    out = rows.select("doc_id", "row_key").join(per_row, "row_key", "left").withColumn("all", every)
    base = F.filter("all", lambda s: s["base"])

    def number(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select(
        "doc_id",
        *[number(k) for k in KINDS],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its ``text`` replaced by its kind in
    brackets; spans that touch or overlap become one. Other columns stay."""
    keyed = docs.withColumn("__key", row_key())
    rows = keyed.select(F.col("__key").alias("row_key"), text_or_empty(F.col("text")).alias("text"))
    here = W.partitionBy("row_key").orderBy("start", "end")
    found = spans(rows).select("row_key", "kind", "start", "end").distinct()
    fresh = F.col("start") >= F.coalesce(F.max("end").over(here.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    merged = (found.withColumn("g", fresh.cast("int")).withColumn("g", F.sum("g").over(here))
              .groupBy("row_key", "g").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                           F.min_by("kind", F.struct("start", "end")).alias("kind"))
              .groupBy(F.col("row_key").alias("__key"))
              .agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("__cut")))
    text, cut = F.col("text"), F.col("__cut")
    pieces = F.transform(cut, lambda s, i: F.concat(
        F.substring(text, F.when(i == 0, F.lit(0)).otherwise(F.get(cut, i - 1)["end"]).cast("int") + 1,
                    (s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get(cut, i - 1)["end"])).cast("int")),
        F.lit("["), F.upper(s["kind"]), F.lit("]")))
    tail = F.substring(text, F.element_at(cut, -1)["end"].cast("int") + 1, F.length(text))
    new = F.when(cut.isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), tail))
    joined = keyed.join(merged, "__key", "left")
    return joined.select(*[new.alias("text") if c == "text" else F.col(c) for c in docs.columns])
