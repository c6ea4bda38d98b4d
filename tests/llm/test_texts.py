"""Language, toxicity, tokens, personal data, pages and shards."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from mediapanel.llm import bpe, html_extract, langid, pii, sharding, toxicity
from tests.llm import cases

VOCABULARY = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


# --- language --------------------------------------------------------------

def lang_rows(n=60):
    rng = random.Random(5)
    return [(i, cases.prose(rng, "en" if i % 2 else "de", 60), "en" if i % 2 else "de") for i in range(n)]


def brute_bits(train: dict[str, list[str]], text: str) -> dict[str, float]:
    """Code lengths from plain dictionaries, byte by byte."""
    out = {}
    data = langid.normalised(text)
    for lang, texts in train.items():
        counts: dict[bytes, dict[int, int]] = {}
        for t in texts:
            d = langid.normalised(t)
            for p in range(langid.ORDER, len(d)):
                for k in range(langid.ORDER + 1):
                    c = counts.setdefault(d[p - k:p], {})
                    c[d[p]] = c.get(d[p], 0) + 1
        bits = 0.0
        for p in range(langid.ORDER, len(data)):
            for k in range(langid.ORDER, -1, -1):
                c = counts.get(data[p - k:p])
                if c is None:
                    continue
                total, kinds = sum(c.values()), len(c)
                if data[p] in c:
                    bits -= np.log2(c[data[p]] / (total + kinds))
                    break
                bits -= np.log2(kinds / (total + kinds))
            else:
                bits += 8.0
        out[lang] = bits
    return out


def test_langid_code_lengths_match_plain_counting(spark):
    rows = lang_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = langid.train_trees(df, "text", "lang", "doc_id")
    train = {x: [t for _, t, name in rows if name == x] for x in ("en", "de")}
    for text in ("the schkeit and", "qqq", rows[0][1], "tion " * 40):
        data = np.frombuffer(langid.normalised(text), np.uint8)
        got = trees.code_lengths(data, np.array([0]))[0]
        want = brute_bits(train, text)
        assert got == pytest.approx([want[x] for x in trees.langs], rel=1e-5)


def test_langid_pieces_add_up(spark, monkeypatch):
    df = spark.createDataFrame(lang_rows(), "doc_id long, text string, lang string")
    trees = langid.train_trees(df, "text", "lang", "doc_id")
    long = spark.createDataFrame([(1, cases.prose(random.Random(2), "de", 5000))], "doc_id long, text string")
    whole = langid.identify(long, trees).first()
    monkeypatch.setattr(langid, "PIECE", 1000)
    assert langid.identify(long, trees).first() == whole


def test_langid_knows_languages_of_few_long_documents(spark):
    df = spark.createDataFrame(lang_rows(6), "doc_id long, text string, lang string")
    trees = langid.train_trees(df, "text", "lang", "doc_id", train_chars=1)
    assert trees is not None and sorted(trees.langs) == ["de", "en"]


def test_langid_awkward_rows(spark):
    rows = [(i, t, "en" if (i or 0) % 2 else None) for i, t in cases.texts()] + [(100 + i, t, x) for i, t, x in lang_rows()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    got = langid.identify_documents(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if r.doc_id in (0, 1, 2, 6):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    held = {r.doc_id: r.lang_pred for r in got if r.held_out and r.doc_id and r.doc_id >= 100}
    assert held and all(p == ("en" if i % 2 else "de") for i, p in held.items())
    # Without labels there is nothing to learn.
    blank = langid.identify_documents(df.withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in blank.collect()} == {("und", 0.0)}
    assert langid.identify_documents(df.limit(0)).count() == 0


# --- toxicity --------------------------------------------------------------

def toxic_rows(n=400):
    rng = random.Random(9)
    bad = ["worthless", "disgusting", "pathetic"]
    out = []
    for i in range(n):
        words = cases.prose(rng, "en", 60).split()
        y = int(i % 4 == 0)
        for _ in range(3 * y):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        out.append((i, " ".join(words), y))
    return out


def test_toxicity_held_out(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    held = [i for i, _, _ in rows if got[i].held_out]
    assert held and all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    right = [got[i].predicted == y for i, _, y in rows if got[i].held_out]
    assert np.mean(right) > 0.9
    assert all(r.predicted == int(r.score >= 0.5) for r in got.values())


def test_toxicity_awkward_rows(spark):
    rows = toxic_rows(200)
    docs = spark.createDataFrame(cases.texts() + [(100 + i, t) for i, t, _ in rows], "doc_id long, text string")
    docs = docs.withColumn("toxic", F.lit(1)).withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(100 + i, y) for i, _, y in rows] + [(None, 1), (40, None), (41, 7), (9999, 1)],
                                   "doc_id long, toxic int")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if r.doc_id in (0, 1, 2)}
    assert len(empty) == 1 and empty.pop() < 0.5
    none = toxicity.score_documents(docs, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


# --- tokens ----------------------------------------------------------------

def test_bpe_matches_the_library(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(VOCABULARY)
    rows = cases.texts() + [(200, "I'm you're DON'T x's"), (201, "a<|endoftext|>b<|startoftext|> <|ENDOFTEXT|> <|endof"),
                            (202, "ΑΣ Σ İ ǅ ﬁ ẛ̣ é ½ ² ４ ٣"), (203, "👨‍👩‍👧 ​﻿ ퟿   z"), (204, "aaaa" * 700)]
    df = cases.frame(spark, rows).withColumn("n_tokens", F.lit("clash"))
    want = {}
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.setdefault(i, set()).add((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                                       hashlib.sha256(text.encode()).hexdigest(), text))
    got = bpe.encode_texts(df, VOCABULARY).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.decoded) in want[r.doc_id]
        assert len(r.ids) == 4 * r.n_tokens
    assert bpe.encode_texts(df.limit(0), VOCABULARY).count() == 0


def test_bpe_merges_by_rank_not_by_place():
    enc = bpe.Encoder.__new__(bpe.Encoder)
    enc.symbols, enc.suffix = bpe.byte_symbols(), ""
    enc.vocab = {"a": 0, "b": 1, "c": 2, "ab": 3, "bc": 4, "abc": 5}
    enc.set_merges([(1, 2, 4), (0, 1, 3), (0, 4, 5)])
    assert enc.merge("abc") == [5]
    assert enc.merge("abab") == [3, 3]
    enc.set_merges([(0, 0, 3)])
    assert enc.merge("aaa") == [3, 0]  # equal ranks: leftmost first


# --- personal data ---------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str | None) -> list[str]:
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                  "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_pii_base_spans_match_plain_patterns(spark):
    rng = random.Random(3)
    rows = cases.texts() + [(300 + i, t) for i, t in enumerate([
        "a@b.com_x@y.org z@@q.c a.b@c..d", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4", "4111 1111 1111 1111 4111-1111-1111-1111-",
        "+1 (487) 555-7209 +12 +1--- +49 123 4567890123 +1+22 3334444 5", "é🎉 a@b.co 🎉 +1 (487) 555-7209 9.9.9.9",
        "9" * 20_000 + " " + "a" * 20_000 + "@" + "b." * 9000 + "c", "1 " * 9000, "1.2." * 5000])]
    rows += [(400 + i, "".join(rng.choices("0149.@+- ()aé", k=rng.randint(1, 200)))) for i in range(300)]
    df = cases.frame(spark, rows, **cases.CLASHES)
    by_id = {}
    for i, t in rows:
        spans = base_spans(t)
        by_id.setdefault(i, set()).add((tuple(sum(s.startswith(k) for s in spans) for k in PLAIN),
                                        hashlib.sha256(",".join(spans).encode()).hexdigest()))
    got = pii.find(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert ((r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256) in by_id[r.doc_id]
    assert pii.find(df.limit(0)).count() == 0


def test_pii_trusted_contexts_find_more(spark):
    cards = ["4012888888881881", "5555555555554444", "5105105105105100", "378282246310005", "371449635398431",
             "6011111111111117", "4111111111111111"]
    rows = [(i, f"visa {c} end") for i, c in enumerate(cards)] + [(50, "é my VISA: 9999-8888-7777-0001, end"),
                                                                 (51, "the 12345678 and the 87654321"), (52, "visa")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find(df).collect()}
    assert got[50] == "card:11:30" and got[51] == "" and got[52] == ""
    assert got[0] == "card:5:21"
    # Few seeds, or mixed neighbours, do not make a pattern.
    few = spark.createDataFrame(rows[:3] + rows[7:], "doc_id long, text string")
    assert {r.doc_id: r.spans for r in pii.find(few).collect()}[50] == ""


def test_pii_patterns_grow_from_found_instances(spark):
    seeds = [d for d in (f"40128888{i:08d}" for i in range(1000)) if luhn(d)][:40]
    shared = [f"ref-{i:06d}" for i in range(8)]
    texts = [f"visa {x} end" for x in seeds + shared] + [f"account {x} end" for x in shared + ["new-123456"]]
    texts += ["other new-654321 end"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {texts[r.doc_id]: r.spans for r in pii.find(df).collect()}
    assert all(got[f"visa {x} end"] == "card:5:15" and got[f"account {x} end"] == "card:8:18" for x in shared)
    assert got["account new-123456 end"] == "card:8:18" and got["other new-654321 end"] == ""


def test_pii_is_native(spark):
    plan = pii.find(cases.frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pii_redaction(spark):
    rows = [(1, "é mail a@b.co, call +1 (487) 555-7209!"), (2, None), (3, ""), (4, "none"), (5, "+1.2.3.4.5.6.7.8.9 end"), (1, "é x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit("k"))
    got = sorted((r.doc_id, r.text) for r in pii.redact(df).collect() if r.text is not None)
    assert (1, "é mail [EMAIL], call [PHONE]!") in got and (1, "é x") in got and (3, "") in got and (4, "none") in got
    assert [t for i, t in got if i == 5] in (["+[IP] end"], ["[PHONE] end"])
    assert pii.redact(df).columns == df.columns and pii.redact(df).count() == len(rows)


# --- pages -----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p><article>no";</script></head>
<body class="home"><header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></li></ul></nav>
<div class="cookie-notice">We use cookies on the site and you can read about it in the policy of the site.</div>
<article><h1>Title &amp; more</h1><p><b>First the&nbsp;paragraph of the text,<br>and it is long enough to be known as prose
because it has a lot of words of the language in it &lt;ok&gt; a < b.<p>Short.
<div class='ad'>Buy this, it is the best of all that you can get in the shop!</div><ul><li><a href=x>Link only</a></ul>
<p>Last part of the text, that is also long, with all the words which are in a text of this kind of language.</article>
<section id="comments"><article><p>I think that the text is not good and that you should not have it on the site.</p></article></section>
<form><label>Name</label><input></form><footer>&copy; the owner of the site</footer>"""


def test_page_main_text():
    assert html_extract.main_text(PAGE).split("\n\n") == [
        "Title & more", "First the paragraph of the text, and it is long enough to be known as prose because it has a lot of "
        "words of the language in it <ok> a < b.", "Short.",
        "Last part of the text, that is also long, with all the words which are in a text of this kind of language."]


def test_page_without_regions_uses_neighbours():
    long = "This is the text of the page and it has the words that a text in this language would have in all of its parts."
    page = f"<body><ul><li><a href=x>One</a><li><a href=y>Two</a></ul><p>{long}<p>Then.<p>{long}<div><a href=z>Back to top</a></div>"
    assert html_extract.main_text(page) == f"{long}\n\nThen.\n\n{long}"


PROSE = "This is the text of the page and it has the words that a text in this language would have in all of its parts."
REMARK = "I think that the text is not good and that you should not have it on the site, and it is what we all know."


def test_page_wrappers_are_opened_for_the_article():
    rest = f"<input><footer>{PROSE}</footer>"
    form = f"<form id='aspnetForm'><div class='nav'><a href=x>Home</a></div><article><h1>T</h1><p>{PROSE}</article>"
    assert html_extract.main_text(f"{form}<div class='comments'><p>{REMARK}</div></form>{rest}") == f"T\n\n{PROSE}"
    menu = f"<div class='main-menu-open page'><nav><a href=x>x</a></nav><p>{PROSE}<p>{PROSE}<div class='sidebar'><p>{REMARK}</div></div>"
    assert html_extract.main_text(menu + rest) == f"{PROSE}\n\n{PROSE}"
    wide = f"<div class='has-sidebar'><main><p>{PROSE}</main><div class='widget'><article><p>{REMARK}</article></div></div>"
    assert html_extract.main_text(wide + rest) == PROSE
    # What is out for its own sake, and forms beside an article, stay out.
    assert html_extract.main_text(f"<div class='cookie-notice'><p>{PROSE}</div><form><p>Name<input></form>") == ""
    assert html_extract.main_text(f"<p>{PROSE}<form><p>{REMARK}</form>") == PROSE


def test_page_links_reach_over_blocks():
    page = f"<article><p>{PROSE}</p><a href=q><div>{REMARK}</div><p>{REMARK}</p></a><p>{PROSE}<p><a href=z>{REMARK}</p><p>{PROSE}</article>"
    assert html_extract.main_text(page) == "\n\n".join([PROSE] * 3)


def test_page_awkward_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "plain words"), (3, "u", "<p"), (4, "u", "<!-- open <p>x"), (5, "u", PAGE),
            (5, "u", PAGE), (6, "u", "<script>x"), (7, "u", "<article>" + "<p>a the of " * 20_000), (8, "u", "</p></div></article>"),
            (9, "u", "<article><p title='x>y'>the text</p></article>"), (10, "u", "<" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_extract.extract(df).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == "" and by_id[2].text == "" and by_id[2].url is None and by_id[9].text == "the text"
    assert by_id[7].n_chars == 20_000 * len("a the of") + 2 * 19_999
    assert html_extract.extract(df.limit(0)).count() == 0


# --- shards ----------------------------------------------------------------

def python_shard(key: str, leaves) -> int:
    tree = sharding._children(leaves)

    def pick(prefix, kids):
        def draw(c):
            h = xxhash.xxh64(f"{prefix}/{c}/{key}".encode(), seed=42).intdigest() >> 11
            return np.log((h + 0.5) / 2 ** 53) / kids[c]
        return max(kids, key=draw)

    region = pick("region", tree[()])
    rack = pick(f"rack/{region}", tree[(region,)])
    return pick(f"shard/{region}/{rack}", tree[(region, rack)])


def test_sharding_rows_slots_and_growth(spark):
    rows = cases.texts() + [(i, "t") for i in range(1000, 3000)]
    df = cases.frame(spark, rows, **cases.CLASHES)
    got = sharding.shard_documents(df).collect()
    assert len(got) == len(rows)
    slots: dict[int, list[int]] = {}
    now, grown = sharding.topology(40), sharding.topology(41)
    for r in got:
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert r.law == "key" and r.shard == python_shard(key, now) and r.grown_shard == python_shard(key, grown)
        assert r.grown_shard in (r.shard, 40)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == want
    assert any(r.grown_shard == 40 for r in got)
    assert sharding.shard_documents(df.limit(0)).count() == 0


def test_sharding_follows_weights_and_confines_movement(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    old = [sharding.Leaf(0, 0, 0), sharding.Leaf(0, 0, 1), sharding.Leaf(0, 1, 2), sharding.Leaf(1, 0, 3, 2.0)]
    new = [sharding.Leaf(0, 0, 0, 3.0), *old[1:]]
    both = sharding.with_shard(sharding.with_shard(df, F.col("doc_id"), old, "a"), F.col("doc_id"), new, "b")
    n = {(r.a, r.b): r["count"] for r in both.groupBy("a", "b").count().collect()}
    share = {s: sum(v for (a, _), v in n.items() if a == s) / 20_000 for s in range(4)}
    assert share[3] == pytest.approx(0.4, abs=0.02) and share[0] == pytest.approx(0.2, abs=0.02)
    # Only the grown region, and in it the grown rack, take rows from elsewhere.
    assert not [k for k in n if k[0] != 3 and k[1] == 3] and not [k for k in n if k[0] != 2 and k[1] == 2 and k[0] != 3]
    three = sharding.topology(42)
    assert all(x.shard == y.shard for x, y in zip(three, sharding.topology(41)))
