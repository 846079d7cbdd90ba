"""Jaccard join, decontamination, repeated strings and the pipeline against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rarescan.llm import bitmaps, decontaminate, jaccard, packing, quality, queries, suffix

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ("node", "size", "prefix", "class", "ord", "kept", "spans", "group", "key", "item_id")
WORDS = [f"w{i}" for i in range(4000)]


def story(start, count):
    return " ".join(WORDS[start : start + count])


def odd_rows():
    base = story(0, 200)
    near = base.replace("w100 ", "other ")
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n ", "en", "a", 3),
        (30, base, "en", "a", 1), (7, base.upper(), "en", "b", 1), (7, base.upper(), "en", "b", 1),
        (None, near, "de", "b", 1), (31, near + " tail", "de", "b", 1), (40, "one two", "en", "c", 1),
        (9, "ONE\ttwo", "en", "c", 1), (None, "alone", "en", "c", 1), (50, story(500, 3000), "fr", "d", 1),
        (51, story(500, 2990), "fr", "d", 1), (None, "alone too", None, None, None),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), DOCUMENT)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


# ---- Jaccard join ---------------------------------------------------------------


def shingles(text):
    data = (text or "").encode().lower()
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", data) if w]
    if len(words) < 4:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 4]) for i in range(len(words) - 3))


def brute_components(rows):
    """Set size and component id per row, all pairs compared."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)].append(doc_id)
    return Counter(
        (doc_id, len(sets[i]), min(least[root(i)]) if least[root(i)] else None)
        for i, (doc_id, _) in enumerate(rows)
    )


def found_components(df):
    return Counter((r.doc_id, r["size"], r.component_id) for r in df.collect())


def test_jaccard_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = brute_components(rows)
    assert found_components(jaccard.join(docs)) == expected
    got = queries.op2_jaccard(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected


def test_jaccard_chains_and_hot_groups(spark):
    """Links that chain past the threshold, a large group, and a line that all share."""
    rows, shared = [], "the very same opening line of every text here"
    for i in range(60):  # neighbours are near, the ends are not
        rows.append((i, shared + " " + story(i * 3, 120)))
    for i in range(60, 120):
        rows.append((i, shared + " " + story(1000, 150).replace(f"w{1000 + i} ", f"z{i} ")))
    for i in range(120, 160):
        rows.append((i, shared + " " + story(2000 + 20 * i, 25)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for often in (2, 10, 10**9):  # the order of the n-grams changes no result
        assert found_components(jaccard.join(docs, frequent_from=often)) == brute_components(rows)


def test_jaccard_near_copies_around_the_threshold(spark, monkeypatch):
    """Few pairs of a group of near copies are links, and yet few pairs are left after contraction."""
    rows, rng = [], np.random.default_rng(5)
    for i in range(240):
        words = story(0, 200).split()
        for at in rng.choice(200, 2, replace=False):
            words[at] = f"z{i}"
        rows.append((i, " ".join(words)))
    left, other_pairs = [], jaccard._other_pairs

    def counted(*args):
        pairs = other_pairs(*args)
        left.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard, "_other_pairs", counted)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = brute_components(rows)
    assert found_components(jaccard.join(docs)) == expected
    assert len({component for _, _, component in expected}) == 1
    assert sum(left) <= len(rows)


def test_jaccard_of_unlike_sizes(spark, monkeypatch):
    """A small set meets one whose fragments are rows of their own, at any percentage."""
    monkeypatch.setattr(jaccard, "LARGE_SET", 64)
    docs = spark.createDataFrame([(1, story(0, 33)), (2, story(0, 83))], "doc_id bigint, text string")
    assert {r.component_id for r in jaccard.join(docs, percent=30).collect()} == {1}
    assert {r.component_id for r in jaccard.join(docs, percent=40).collect()} == {1, 2}


def test_jaccard_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found_components(jaccard.join(odd)) == brute_components(rows)
    assert jaccard.join(odd.where("false")).collect() == []
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter([1, 2, 3, 7, 9, 50, None, None])


def test_word_hashes_in_pieces(monkeypatch):
    text = "Ab cd\téé " * 500 + "x" * 900
    whole = jaccard.word_hashes(text)
    monkeypatch.setattr(jaccard, "CHUNK", 64)
    assert np.array_equal(whole, jaccard.word_hashes(text))
    assert len(whole) == len(text.split()) and len(np.unique(whole)) == len(set(text.split()))


# ---- decontamination -------------------------------------------------------------


def benchmark(spark):
    items = [(1, story(3000, 30)), (2, "Short item"), (3, None), (4, story(3100, 60)), (4, story(3100, 60))]
    return spark.createDataFrame(items, "item_id bigint, text string")


def leaks():
    exact = story(3000, 30)
    edited = " ".join("new" if i % 7 == 3 else w for i, w in enumerate(story(3100, 60).split()))
    return [
        (1, f"{story(0, 50)} {exact} {story(60, 50)}"), (2, f"{story(0, 300)} {edited.upper()}, end"),
        (3, story(0, 400)), (4, None), (5, ""), (6, f"x {story(3000, 8)} y"), (None, exact), (7, exact), (7, exact),
        (8, "Short item"), (9, story(3100, 40)),
    ]


def test_decontamination(spark):
    docs = spark.createDataFrame(leaks(), "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    found = Counter((r.doc_id, r.item_id) for r in decontaminate.find(docs, benchmark(spark)).collect())
    assert found == Counter({(1, 1): 1, (2, 4): 2, (None, 1): 1, (7, 1): 2, (9, 4): 2})
    kept = decontaminate.remove(docs, benchmark(spark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 8]
    nothing = benchmark(spark).where("false")
    assert decontaminate.find(docs, nothing).collect() == []
    assert decontaminate.remove(docs, nothing).count() == len(leaks())
    assert decontaminate.find(docs.where("false"), benchmark(spark)).collect() == []


@pytest.mark.parametrize("copies", (1, 11, 1000))
def test_decontamination_of_repeated_edits(spark, copies):
    """An edited or cut item is found however many documents hold it."""
    edited = " ".join("new" if i % 7 == 3 else w for i, w in enumerate(story(3100, 60).split()))
    cut = " ".join(story(3000, 30).split()[:16])
    rows = [(i, f"{story(0, 20)} {edited} {story(i % 900, 5)} {cut}") for i in range(copies)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = Counter(r.item_id for r in decontaminate.find(docs, benchmark(spark)).collect())
    assert found == Counter({1: copies, 4: 2 * copies})
    assert decontaminate.remove(docs, benchmark(spark)).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame(leaks(), "doc_id bigint, text string")
    whole = Counter(decontaminate.find(docs, benchmark(spark)).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 20)
    assert Counter(decontaminate.find(docs, benchmark(spark)).collect()) == whole


def test_decontamination_of_the_table(spark, sf_dir):
    """Every passage that stands in a document, found by plain search."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    words = {r.item_id: " ".join(re.findall(r"\w+", r.text.lower())) for r in items}
    whole = {r.doc_id: " ".join(re.findall(r"\w+", (r.text or "").lower())) for r in docs}
    expected = {(d, i) for d, t in whole.items() for i, w in words.items() if w in t}
    found = {(r.doc_id, r.item_id) for r in queries.op3_decontamination(spark, sf_dir).collect()}
    assert expected and found >= expected
    assert len(found - expected) <= 0.1 * len(expected)


def test_decontamination_without_spaces_and_of_short_items(spark, monkeypatch):
    chinese = "水在标准大气压下沸腾时的温度是一百摄氏度"
    thai = "ประเทศไทยมีเมืองหลวงชื่อกรุงเทพมหานคร"
    items = [(1, chinese), (2, thai), (3, "Four!"), (4, "a b c"), (5, "河山"), (5, "河山"), (6, " - "), (None, "Four")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    edited = chinese[:6] + "新" + chinese[7:]
    rows = [
        (1, f"他说{chinese}。"), (2, f"เขาพูดว่า{thai}ครับ"), (3, f"{story(0, 50)} {edited}"), (4, "one\n four \nx"),
        (5, "four a b c"), (6, "A, B, C"), (7, "x\n「河山」"), (8, "河山大"), (9, chinese[:5]), (10, None), (11, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for size in (decontaminate.BLOCK_WORDS, 1):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", size)
        found = Counter((r.doc_id, r.item_id) for r in decontaminate.find(docs, benchmark, short=True).collect())
        assert found == Counter([(1, 1), (2, 2), (3, 1), (4, 3), (4, None), (6, 4), (7, 5), (7, 5)])
        left = sorted(r.doc_id for r in decontaminate.remove(docs, benchmark, short=True).collect())
        assert left == [5, 8, 9, 10, 11]
    places = {(r.doc_id, r.item_id): (r.first_word, r.last_word) for r in decontaminate.find(docs, benchmark, short=True).collect()}
    assert places[1, 1] == (2, 2 + len(chinese)) and places[4, 3] == (1, 2) and places[7, 5] == (1, 3)


def test_seeds_by_brute_force():
    """Whatever the score accepts is found, also without four unchanged words in a row."""
    rng = np.random.default_rng(11)
    for least in (0.5, 0.7):
        for _ in range(300):
            size, letters = int(rng.integers(4, 40)), int(rng.integers(3, 60))
            words = [[f"v{k}" for k in rng.integers(0, letters, size)] for _ in range(3)]
            block = decontaminate.Block(list(enumerate(words)))
            block.keep_rare(rng.integers(0, 50, len(block.keys)), least)
            text = [f"v{k}" for k in rng.integers(0, 80, rng.integers(0, 30))]
            for w in words[0]:
                edit = rng.integers(0, rng.integers(3, 9))
                text += [[], ["x"], ["x", w], [w]][edit] if edit < 3 else [w]
            text += [f"v{k}" for k in rng.integers(0, 80, rng.integers(0, 30))]
            ids = block.ids(" ".join(text))
            whole = [decontaminate.alignment(item, ids)[0] / (2 * len(item)) for _, item in block.items]
            expected = {n: score for n, score in enumerate(whole) if score >= least}
            assert {n: s for n, s, _, _ in block.matches(" ".join(text), least)} == expected


def test_decontamination_of_edited_items(spark):
    """Every fourth word replaced, and a word put in after every second one."""
    words = story(3100, 60).split()
    replaced = " ".join("new" if i % 4 == 3 else w for i, w in enumerate(words))
    longer = " ".join(w + " new" if i % 2 else w for i, w in enumerate(words))
    rows = [(i, f"{story(0, 20)} {text} {story(40, 20)}") for i, text in enumerate((replaced, longer))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = decontaminate.find(docs, benchmark(spark).where("item_id = 4").distinct()).collect()
    assert {(r.doc_id, r.score, r.first_word) for r in found} == {(0, (90 - 14) / 120, 20), (1, (120 - 29) / 120, 20)}


def test_alignment_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 15))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                step = table[i, j] + (2 if a[i] == b[j] else -1)
                table[i + 1, j + 1] = max(0, step, table[i, j + 1] - 1, table[i + 1, j] - 1)
        assert decontaminate.alignment(a, b)[0] == table.max()


# ---- repeated strings -------------------------------------------------------------


def brute_repeats(rows, length):
    """(doc_id, bytes, removed, spans, digest) per row."""
    last = 1 << 62
    owner = {}
    raws = [(last if d is None else d, d, (t or "").encode()) for d, t in rows]
    for order, _, raw in raws:
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            owner[s] = min(order, owner.get(s, last))
    out = Counter()
    for order, doc_id, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if owner[raw[i : i + length]] < order:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def found_repeats(df):
    out = Counter()
    for r in df.collect():
        digest = r.sha256 if r.kept is None else hashlib.sha256(bytes(r.kept)).hexdigest()
        removed = sum(s.stop - s.start for s in r.spans or [])
        out[r.doc_id, r.n_bytes, removed, len(r.spans or []), digest] += 1
    return out


def test_repeats_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = brute_repeats(rows, 50)
    assert found_repeats(suffix.remove_repeats(docs)) == expected
    got = queries.op6_suffix_dedup(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == expected


def repeat_rows():
    passage = story(0, 14)
    rows = [(r[0], r[1]) for r in odd_rows()]
    rows += [(100 + i, f"{'é' * i} {passage} é{i} {passage[5:]} {story(50 * i, 9)}") for i in range(12)]
    rows += [(200, "a" * 300), (201, "a" * 170 + "b" + "a" * 60), (202, "ab" * 200), (203, "a" * 49)]
    rows += [(None, passage), (None, passage + "!"), (1, passage)]
    return rows


def test_repeats_odd_rows(spark, monkeypatch):
    rows = repeat_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("class", F.lit("clash"))
    expected = brute_repeats(rows, 50)
    assert found_repeats(suffix.remove_repeats(docs)) == expected
    assert suffix.remove_repeats(docs.where("false")).collect() == []
    # names of very many texts are dealt string by string, with the same result
    monkeypatch.setattr(suffix, "LARGE_GROUP", 2)
    assert found_repeats(suffix.remove_repeats(docs)) == expected


def test_repeats_with_a_full_bitmap(spark, monkeypatch):
    """Later copies that pass the bitmap of first rows cut nothing out of the first."""
    monkeypatch.setattr(bitmaps, "LEAST_BITS", 512)
    monkeypatch.setattr(bitmaps, "MOST_BITS", 512)
    rows = [(k * 100 + i, story(40 * i, 30)) for i in range(60) for k in range(6)]
    rows += [(1000 + i, f"{story(40 * i, 12)} tail {i}") for i in range(20)] + repeat_rows()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_repeats(suffix.remove_repeats(docs)) == brute_repeats(rows, 50)


def test_equal_runs_by_brute_force():
    rng = np.random.default_rng(5)
    for length in (3, 7, 20):
        data = rng.integers(97, 99, 400).astype(np.uint8)
        data[rng.integers(0, 400, 12)] = 255
        order = suffix.sorted_suffixes(data, length)
        raw = data.tobytes()
        prefixes = [raw[i : i + length] for i in order]
        assert prefixes == sorted(prefixes)
        split = suffix.equal_runs(data, order, length)
        whole = [len(p) == length for p in prefixes]
        for i in range(1, 400):
            if whole[i] and whole[i - 1]:
                assert split[i] == (prefixes[i] != prefixes[i - 1])


# ---- pipeline ---------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir):
    """Each stage against brute force on what the stage before it left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "packing",
    ]
    stages = [f for _, f in corpus_pipeline.STAGES]

    good = stages[0](spark, docs, sf_dir).cache()
    kept = {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
    assert good.columns == columns and {r.doc_id for r in good.collect()} == kept

    one = stages[1](spark, good, sf_dir).cache()
    rows = [(r.doc_id, r.text) for r in good.select("doc_id", "text").collect()]
    expected = {component for _, _, component in brute_components(rows)}
    assert one.columns == columns and {r.doc_id for r in one.collect()} == expected

    clean = stages[2](spark, one, sf_dir).cache()
    leaked = decontaminate.find(one, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaked = {r.doc_id for r in leaked.collect()}
    assert leaked and {r.doc_id for r in clean.collect()} == expected - leaked

    hidden = stages[3](spark, clean, sf_dir).cache()
    assert hidden.columns == columns
    old = {r.doc_id: r.text for r in clean.collect()}
    for r in hidden.collect():
        assert r.n_chars == len(r.text)
        for found in re.findall(r"[\w.]+@[\w.]+\w|\b\d{1,3}(?:\.\d{1,3}){3}\b", old[r.doc_id]):
            assert found not in r.text

    packed = stages[4](spark, hidden, sf_dir).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in hidden.collect()}
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    digest = lambda rows: Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0)
    assert digest(whole) == digest(packed)


def test_pipeline_near_copies(spark, sf_dir):
    """Two separate words of 100 changed: 0.811 of the runs of five words, 0.848 of those of four."""
    base = story(0, 100)
    rows = [(1, base), (2, base.replace("w30 ", "x ").replace("w60 ", "y ")), (3, base.replace("w30 ", "x ").replace("w50 ", "y ").replace("w70 ", "z "))]
    docs = spark.createDataFrame(rows[:2], "doc_id bigint, text string")
    assert [r.doc_id for r in corpus_pipeline.keep_distinct(spark, docs, sf_dir).collect()] == [1]
    docs = spark.createDataFrame(rows[::2], "doc_id bigint, text string")
    assert corpus_pipeline.keep_distinct(spark, docs, sf_dir).count() == 2


def test_pipeline_of_nothing(spark, tmp_path, sf_dir):
    for name in ("documents", "labels", "benchmark"):
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet").where("false")
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []




def test_a_packing_worker_gives_memory_back():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    before = resident()
    blocks = [bytearray(100_000) for _ in range(2_000)]  # small enough to lie on the heap
    kept = [bytearray(100_000)]  # above them, so that the heap does not shrink by itself
    del blocks
    packing.free_unused()
    assert resident() - before < 50_000_000 and kept
