"""Packing, language, PII, quality, HTML, chat and secrets against plain Python."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rarescan.llm import chat, html, language, packing, pii, quality, queries, secrets

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# clashing names, all null columns, nulls, empty, repeated rows, very long texts
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "  \n\t ", "en", None, 5),
    (4, "word", None, "a", 4),
    (4, "word", None, "a", 4),
    (None, "no id here at all", "en", "a", 17),
    (5, "x" * 30_000, "de", "b", 30_000),
    (6, "to be or not " * 4_000, "en", "b", 52_000),
    (7, "naïve Straße İ ΑΣ 日本 😀 <|endoftext|> “quoted”\x85end", "de", "c", 40),
]
CLASHES = ("start", "size", "node", "facts", "row", "group", "kept", "both", "personal", "base", "digest")


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, DOCUMENT)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# ---- packing ------------------------------------------------------------------


def check_packing(rows, texts, capacity):
    whole = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for doc_id, text in texts:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        expected[doc_id, struct.pack(f"<{len(ids)}I", *ids)] += 1
    windows, pieces = {}, {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        windows.setdefault(r.sequence_id, []).append(r)
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for window in windows.values():
        window.sort(key=lambda r: r.offset)
        assert [r.offset for r in window] == [sum(x.length for x in window[:i]) for i in range(len(window))]
        assert sum(r.length for r in window) <= capacity
    found = Counter()
    for (doc_id, total), parts in pieces.items():
        parts.sort(key=lambda r: r.start)
        copies = sum(r.start == 0 for r in parts)
        joined = b"".join(bytes(r.ids) for r in parts[::copies])
        assert sum(r.length for r in parts) == copies * total and len(joined) == 4 * total
        found[doc_id, joined] += copies
    assert found == expected
    return len(windows)


def test_packing_keeps_every_id_once(odd, documents):
    for docs, capacity in ((odd, 2048), (documents, 2048), (documents, 100)):
        rows = packing.pack(docs, VOCABULARY, capacity=capacity).collect()
        texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        windows = check_packing(rows, texts, capacity)
        if docs is documents:
            used = sum(r.length for r in rows)
            assert windows * capacity <= 1.08 * used


def test_ids_of_all_latin_letters():
    """Texts of any letters up to U+024F, capitals with far small letters among them."""
    pick, points = random.Random(2), [chr(i) for i in range(0x250)]
    texts = ["".join(pick.choices(points, k=pick.choice((1, 3, 9, 40)))) for _ in range(3000)]
    texts += [f"a{c}b {c}{c} x" for c in points]
    whole = Tokenizer.from_file(VOCABULARY)
    expected = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    encode = packing.Encoder(VOCABULARY)
    found = [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in encode(pa.array(texts))]
    assert [t for t, a, b in zip(texts, found, expected) if a != b] == []


def test_packing_of_nothing(none):
    assert packing.pack(none, VOCABULARY).collect() == []


def test_differencing_balances():
    sizes = [8, 7, 6, 5, 4]
    windows = packing.differencing(sizes, 2)
    assert sorted(i for w in windows for i in w) == list(range(5))
    assert sorted(sum(sizes[i] for i in w) for w in windows) == [14, 16]
    # the window count rises when a window would overflow
    cut, found = packing.windows_of([(0, 6), (0, 6), (0, 6)], 10)
    assert max(sum(cut[i][2] for i in w) for w in found) <= 10


# ---- language -----------------------------------------------------------------


def test_language_held_out_accuracy(spark, sf_dir, documents):
    rows = queries.op4_language(spark, sf_dir).collect()
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_odd_rows(spark, odd, none, documents):
    more = documents.withColumns({c: F.lit("clash") for c in CLASHES})
    rows = language.identify(odd.unionByName(more.withColumn("doc_id", F.col("doc_id") + 1000))).collect()
    by_id = {r.doc_id: r for r in rows}
    for doc_id in (1, 2, 3):
        assert (by_id[doc_id].lang_pred, by_id[doc_id].score) == ("und", 0.0)
    assert by_id[6].lang_pred != "und" and by_id[None].held_out is False
    assert language.identify(none).collect() == []
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}


def test_grams_by_brute_force(monkeypatch):
    text = "Ab  cd,ÉÉ e" * 50
    found, counts = language.grams(text)
    monkeypatch.setattr(language, "CHUNK", 7)  # chunk borders change nothing
    again = language.grams(text)
    assert np.array_equal(found, again[0]) and np.array_equal(counts, again[1])
    plain = re.sub(r"[^\w]+", " ", text.lower())
    plain = plain if plain.startswith(" ") else " " + plain
    grams = sum(max(0, len(plain) - n + 1) for n in (2, 3)) + len(plain) - 1
    assert counts.sum() == grams


def test_temperature():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 3, 4000)
    logits = rng.normal(size=(4000, 3))
    logits[np.arange(4000), labels] += 1.0
    found = language.best_temperature(logits * 5, labels)
    assert found == pytest.approx(5 * language.best_temperature(logits, labels), rel=0.02)


# ---- PII ----------------------------------------------------------------------


def luhn(digits):
    twice = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in twice) % 10 == 0


def test_pii_formats(spark):
    text = (
        "a 4111 1111 1111 1111 b 4111111111111112 c 4111111111111111, +1 (743) 555-3824 "
        "d 10.0.0.255 e 2024-02-29 f 29.02.2024 g 2023-02-30 h Jo.Do92@mail.example.com i 123-45-6789"
    )
    df = spark.createDataFrame([(1, text), (2, text), (3, None), (4, "")], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in pii.replace_personal(df, "k").collect()}
    other = {r.doc_id: r for r in pii.replace_personal(df, "other").collect()}
    assert rows[1].text == rows[2].text != other[1].text
    assert rows[3].text is None and rows[4].text == "" and rows[3].personal == []
    kinds = [p.kind for p in rows[1].personal]
    assert kinds == ["email", "card", "card", "phone", "address", "date", "date", "social"]
    found = {p.value: p.pseudonym for p in rows[1].personal}
    card = found["4111111111111111"]
    assert luhn(card) and card[0] == "4" and card == found["4111 1111 1111 1111"].replace(" ", "")
    assert "4111111111111112" in rows[1].text and "2023-02-30" in rows[1].text
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", found["+1 (743) 555-3824"])
    assert all(0 <= int(o) < 256 for o in found["10.0.0.255"].split("."))
    year, month, day = found["2024-02-29"].split("-")
    assert found["29.02.2024"] == f"{day}.{month}.{year}"
    assert re.fullmatch(r"[A-Z][a-z]\.[A-Z][a-z]\d\d@mail\.example\.com", found["Jo.Do92@mail.example.com"])
    assert not any(value in rows[1].text for value in found)


def test_pii_beside_punctuation(spark):
    values = ("(555)123-4567", "12/03/1980", "1980-03-12")
    text = "call (555)123-4567, born.12/03/1980 or -1980-03-12; not 1.12/03/1980"
    row = pii.replace_personal(spark.createDataFrame([(text,)], "text string"), "k").first()
    assert {(p.kind, p.value) for p in row.personal} == set(zip(("phone", "date", "date"), values))
    assert re.search(r"call \(\d{3}\)\d{3}-\d{4}, born\.\d\d/\d\d/\d{4} or -\d{4}-\d\d-\d\d;", row.text)
    assert row.text.endswith("not 1.12/03/1980")


def test_pii_is_a_permutation(spark):
    digits = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    assert digits.select(pii.permuted_digits(F.col("d"), "k", "x").alias("p")).distinct().count() == 1000
    days = spark.range(0, 3000).select(
        F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text")
    )
    new = pii.replace_personal(days, "k").select("text")
    assert new.distinct().count() == 3000
    assert new.where(F.try_to_date("text", "yyyy-MM-dd").isNull()).count() == 0


def test_pii_odd_rows(odd, none, documents):
    rows = pii.replace_personal(odd, "k", found="what")
    assert rows.columns == [*odd.columns, "what"] and rows.count() == len(ODD)
    assert pii.replace_personal(none, "k", found="what").collect() == []
    clean = re.compile(r"[0-9@]")
    for r in pii.replace_personal(documents.withColumn("old", F.col("text")), "k").collect():
        if not clean.search(r.old):
            assert r.text == r.old


# ---- quality ------------------------------------------------------------------


def plain_counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            repeated.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_quality_counts(spark, odd, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    for docs in (odd, documents):
        texts = Counter((r.doc_id, *plain_counts(r.text)) for r in docs.select("doc_id", "text").collect())
        found = Counter()
        for r in quality.judge(docs, labels).collect():
            f = r.facts
            counts = (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words)
            found[(r.doc_id, *counts)] += 1
            assert r.base_failed == (f.n_words < 10 or 100 * f.n_repeat_words > 20 * f.n_words)
            assert not (r.kept and r.base_failed)
        assert found == texts


def test_quality_without_evidence(spark, odd, none, documents):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    judged = quality.judge(documents, labels)
    assert judged.where("kept = base_failed").count() == 0  # the base rule alone
    assert quality.judge(none, labels).collect() == []
    kept = quality.filter_documents(odd, labels)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == set()


def test_binomial_tail(spark):
    rows = [(float(k), float(n)) for n in (1, 10, 60, 500, 4000) for k in (0, 1, 3, 8, 30, 70) if k <= n]
    df = spark.createDataFrame(rows, "k double, n double")
    for p in (0.02, 0.05):
        for r in df.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect():
            exact = sum(
                math.comb(int(r.n), i) * p**i * (1 - p) ** (int(r.n) - i) for i in range(int(r.k) + 1)
            )
            if r.k < r.n * p:
                assert r.t == pytest.approx(exact, rel=1e-6)
            else:
                assert r.t == 1.0


def test_thresholds_hold_the_risk(spark):
    """A stratum of good documents that break a level keeps the level before it."""
    text = "some plain words that nobody would ever want to reject at all %s"
    rows = [(i, text % i, "a") for i in range(600)]
    rows += [(i, text % i + " #" * (5 if i % 10 else 0), "b") for i in range(600, 1200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    facts = quality.measures(docs).drop("text")
    passed = {r.stratum: r.passed for r in quality.thresholds(facts, labels, "lang").collect()}
    assert passed["a"] == quality.LEVELS and passed["b"] < quality.LEVELS
    kept = quality.filter_documents(docs, labels)
    assert kept.where("lang = 'b'").count() >= 600 * (1 - quality.RISK)


# ---- HTML ---------------------------------------------------------------------


def test_html_articles(spark, sf_dir):
    rows = {r.page_id: r for r in queries.op8_html(spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(rows) == len(pages)
    import html as entities

    for page in pages:
        inner = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        blocks = [re.sub(r"<[^>]+>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", inner)]
        texts = [" ".join(entities.unescape(b).split()) for b in blocks]
        assert rows[page.page_id].text == "\n\n".join(t for t in texts if t)
        assert rows[page.page_id].n_chars == len(rows[page.page_id].text)


def test_html_boilerplate():
    long = "A sentence of the story, long enough to count as text. " * 4
    page = (
        "<body><header><h1>Site</h1></header><nav><a href=1>Home</a></nav><div class='cookie-notice'>We use"
        f"</div><main><article><h1>Title &amp; more</h1><p>{long}<p>Short.<aside>Side</aside><div class=comments>"
        f"<p>{long}</div><form><input><button>Go</button></form></article></main><footer>Foot</footer>"
    )
    assert html.main_text(page) == f"Title & more\n\n{' '.join(long.split())}\n\nShort."
    bare = f"<div><a href=1>x</a> <a href=2>y</a></div><h2>Head</h2><p>{long}</p><p>{long}</p><p><a href=3>z</a></p>"
    assert html.main_text(bare) == "\n\n".join(["Head", *[" ".join(long.split())] * 2])
    assert html.main_text(None) == html.main_text("") == html.main_text("<script>x</script>") == ""
    assert html.main_text("just text") == "just text"


NOISY = ("no-sidebar", "has-comments", "article review", "with-menu")


def test_html_articles_in_doubtful_elements():
    long = " ".join(["A sentence of the story, long enough to count as text."] * 8)
    for head in (f"<html><head><title>T</title><body><p>{long}", f"<head><meta charset=x><link rel=y><p>{long}"):
        assert html.main_text(head) == long
    article = f"<article><p>{long}</p><div class=comments><p>{long}</div></article>"
    comments = "<section class=comments><article><p>A comment.</p></article></section>"
    for name in NOISY:
        for page in (f"<div class='{name}'>{article}</div>", f"<div class='{name}'><main>{article}</main></div>",
                     f"<main><div id='{name}'>{article}</div></main>", article.replace("<article", f"<article class='{name}'")):
            assert html.main_text(f"<body><nav>Home</nav>{page}{comments}") == long
    assert html.main_text(f"<form><input><select><option>x</select>{article}</form>") == long
    assert html.main_text(f"<form><input><p>{long}</p></form>") == long
    assert html.main_text(f"<p>{long}</p><form><label>Mail</label><p>{long}</p></form>") == long


def test_html_doubtful_words():
    long = " ".join(["A sentence of the story, long enough to count as text."] * 8)
    for name in ("page with-sidebar", "sidebar-right", "widget", "share-price"):  # wrappers of bare pages
        page = f"<nav><a href=1>Home</a></nav><div class='{name}'><p>{long}<p>{long}</div><div class=comments><p>{long}</div>"
        assert html.main_text(page) == f"{long}\n\n{long}"
    head = "<div class='article-header'><h1>Title</h1></div>"
    price = "<p class='share-price'>The share price rose.</p><section id='search-results'><p>Nothing was found.</p></section>"
    links = "<div class='related-stories'><a href=1>One</a> <a href=2>Two</a></div><div class='ad-box'>Buy</div>"
    page = f"<article>{head}<p>{long}</p>{price}<p>{long}</p>{links}</article>"
    assert html.main_text(page) == "\n\n".join(["Title", long, "The share price rose.", "Nothing was found.", long])
    assert html.main_text(f"<div class=comments><p>{long}</div><div class='cookie-notice'>{long}</div>") == ""


def test_html_short_lines_links_and_teasers():
    long = " ".join(["A sentence of the story, long enough to count as text."] * 8)
    said = "<p>Yes.</p><p>He said no.</p><ul><li>One</li><li>Two</li></ul>"
    short = ["Yes.", "He said no.", "One", "Two"]
    for page in (f"<div><p>{long}</p>{said}<p>{long}</p></div>", f"<main><p>{long}</p>{said}<p>{long}</p></main>"):
        assert html.main_text(page) == "\n\n".join([long, *short, long])
    deep = "<div><a href=1><b><i><span><em><u>Home and all that is new here</u></em></span></i></b></a></div>" * 6
    title = "<h1><a href=1><b><i><u><em>Title</em></u></i></b></a></h1>"
    assert html.main_text(f"{deep}<div>{title}<p>{long}</p></div>{deep}") == f"Title\n\n{long}"
    card = "<article><h3><a href=1>Another story</a></h3><p>A summary of it.</p></article>"
    more = "<article><h3>Another story</h3><p>A summary of it, in a line.</p><p><a href=1>Read more</a></p></article>"
    article = f"<article>{title}<p>{long}</p><p>The end.</p></article>"
    assert html.main_text(article + card + more) == f"Title\n\n{long}\n\nThe end."


def test_html_time_is_linear():
    import time

    long = "A sentence of the story, long enough to count as text. " * 8
    pages = ["<p>" + "<i>" * 20_000 + "</b>" * 20_000, "<b><div>" + "<i>" * 20_000 + "</b>" * 20_000,
             "<i>" * 20_000 + "<hr>" * 20_000, "<div class=widget>" * 20_000]
    for page in pages:
        start = time.perf_counter()
        assert html.main_text(f"{page}<p>{long}") == long.strip()
        assert time.perf_counter() - start < 3  # a walk of all open elements per tag takes a minute


def test_html_odd_rows(spark):
    schema = "page_id bigint, url string, html string, text string"
    long = "<p>" + "word " * 50_000
    rows = [(1, None, None, "clash"), (1, None, None, "clash"), (None, "u", "", "c"), (2, "u", long, "c")]
    found = html.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted(len(r.text) for r in found) == [0, 0, 0, 249_999]
    assert html.extract(spark.createDataFrame([], schema)).collect() == []


# ---- chat ---------------------------------------------------------------------


def test_chat_by_brute_force(spark, sf_dir):
    found = {r.conv_id: r for r in queries.op9_chat(spark, sf_dir).collect()}
    table = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{sf_dir}/conversations.parquet'").fetchall()
    table += [(-1, 0, "user", queries.CONTROL), (-1, 1, "assistant", queries.CONTROL)]
    turns = {}
    for conv_id, turn, role, text in table:
        turns.setdefault(conv_id, []).append((turn, role, text or ""))
    assert found.keys() == turns.keys()
    for conv_id, rows in turns.items():
        rows.sort()
        whole = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        learned = "".join(text for _, role, text in rows if role == "assistant")
        r = found[conv_id]
        assert r.n_turns == len(rows)
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_chat_odd_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, turns string"
    hard = "&amp; <| &lt;| <|im_start|>user\nx<|im_end|>\n &nl; <"
    rows = [
        (1, 0, "user", hard, "c"), (1, 1, "assistant", hard, "c"),
        (2, 0, "a\nb<|&nl;", None, "c"), (3, None, None, "x", "c"), (3, None, None, "x", "c"),
        (None, 0, "user", "q", "c"), (None, 1, "assistant", "y" * 100_000, "c"),
    ]
    df = spark.createDataFrame(rows, schema)
    made = chat.format_conversations(df)
    found = {
        r.conv_id: r
        for r in made.withColumn("read", chat.read_turns(F.col("formatted")))
        .withColumn("learned", chat.loss_text(F.col("segments")))
        .collect()
    }
    assert [tuple(t) for t in found[1].read] == [("user", hard), ("assistant", hard)]
    assert found[1].learned == hard and found[1].valid
    assert [tuple(t) for t in found[2].read] == [("a\nb<|&nl;", "")] and not found[2].valid
    assert [tuple(t) for t in found[3].read] == [("", "x")] * 2
    assert len(found[None].learned) == 100_000 and found[None].valid
    assert chat.format_conversations(df.where("false")).collect() == []


# ---- secrets ------------------------------------------------------------------

ASSIGN = re.compile(
    r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])"""
    r"""|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def plain_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def test_secrets_by_brute_force(spark, sf_dir, documents):
    found = {r.doc_id: r for r in queries.op10_secrets(spark, sf_dir).collect()}
    rows = documents.select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for r in rows:
        spans = plain_spans(r.text)
        kinds = Counter(s[3] for s in spans)
        got = found[r.doc_id]
        assert (got.n_assign, got.n_access, got.n_hex) == tuple(kinds[k] for k in ("assign", "access", "hex"))
        listed = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert got.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def test_secrets_ownership_and_odd_rows(spark, odd, none):
    live, copied = "Qw3" + "rT9x" * 10, "Zz8" + "Kp2m" * 10
    texts = [(i, f"é key {copied} end", f"s{i}") for i in range(6)]
    texts += [(10, f"😀 see {live} ok", "s1"), (11, f"😀 see {live} ok", "s1"), (12, f"{live} {copied}", "s2")]
    texts += [(13, f"secret=token: abcdefgh API_KEY = '{live}' AKIA{'A' * 16}", "s3")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, source string")
    rows = {r.doc_id: r for r in secrets.scan(df).collect()}
    assert not rows[0].more and [s.start for s in rows[10].more] == [6]
    assert [s.kind for s in rows[12].more] == ["opaque"]
    assert [(s.kind, s.start) for s in rows[13].base] == [(k, s) for s, _, _, k in plain_spans(texts[-1][1])]
    assert rows[13].more == [] and all(s.n_owners == 3 for s in rows[13].base if s.kind == "assign" and s.start > 5)
    assert secrets.scan(odd).count() == len(ODD)
    assert secrets.scan(none).collect() == []


def test_an_encoder_forgets_when_it_holds_much():
    encode = packing.Encoder(VOCABULARY)
    before = encode(pa.array(["some words", None]))
    encode.parts |= {str(i): b"" for i in range(packing.CACHED_PARTS)}
    encode.trim()
    assert len(encode.parts) == 1 and encode(pa.array(["some words", None])) == before
