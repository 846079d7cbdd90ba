"""Merkle manifest, Katz scores and spelling variants against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rarescan.llm import katz, manifest, queries, variants

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHES = ("tree", "node", "n", "hash", "key", "path", "batch", "held_out", "word", "length", "page", "place")


def odd_rows():
    long = " ".join(f"w{i % 700} the" for i in range(9000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n \t", "en", "a", 3),
        (4, "The cat sat\non the mat\n", "en", "a", 1), (4, "The cat sat\non the mat\n", "en", "a", 1),
        (None, "the cat", "de", "b", 1), (None, None, None, "b", None), (50, long, "fr", "é", 1),
        (6, "ÉCOLE école Große×÷ straße", "fr", "", 2),
    ]
    return rows + [(100 + i, f"the cat number{i % 7} sat on\nmat{i}", "en", "hot", i) for i in range(40)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENT).withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture
def written(odd, tmp_path):
    odd.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


# ---- manifest ---------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def brute_path(levels, at):
    for level in levels[:-1]:
        first = at // 3 * 3
        yield level[first:at], level[at + 1 : first + 3]
        at //= 3


def brute_manifest(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[3]].append((row, brute_leaf(row, row[1])))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, members in by_source.items():
        members.sort(key=lambda m: (m[0][0] is not None, m[0][0] or 0, m[1]))
        trees[source] = brute_tree([leaf for _, leaf in members])
    top = brute_tree([trees[s][-1][0] for s in order])
    for place, source in enumerate(order):
        for at, (row, leaf) in enumerate(by_source[source]):
            path = [*brute_path(trees[source], at), *brute_path(top, place)]
            folded = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None:
                folded = brute_leaf(row, row[1].replace("\n", ""))
            for left, right in path:
                folded = sha(*left, folded, *right)
            proof = sha(*(h for left, right in path for h in left + right))
            root = top[-1][0]
            yield (row[0], leaf, trees[source][-1][0], root, proof, folded, folded == root)


def test_manifest_equals_brute_force(spark, written):
    found = Counter(tuple(r) for r in queries.op11_manifest(spark, written).collect())
    assert found == Counter(brute_manifest(odd_rows()))
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("count", [0, 1, 28])
def test_manifest_of_one_source(spark, tmp_path, count):
    rows = [(i, f"line\n{i}", "en", "s", i) for i in range(count)]
    spark.createDataFrame(rows, DOCUMENT).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op11_manifest(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, found)) == Counter(brute_manifest(rows))


# ---- Katz -----------------------------------------------------------------------------


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w] + ["</s>"]


class Brute:
    """The model from plain dictionaries, by recursion."""

    def __init__(self, texts, order):
        self.order, self.known = order, {}
        self.count = [Counter() for _ in range(order)]
        self.context = [Counter() for _ in range(order)]
        for text in texts:
            padded = ["<s>"] * (order - 1) + tokens_of(text)
            for end in range(order - 1, len(padded)):
                for n in range(order):
                    gram = tuple(padded[end - n : end + 1])
                    self.count[n][gram] += 1
                    self.context[n][gram[:-1]] += 1
        self.levels = []
        for count in self.count:
            times = Counter(count.values())
            times = tuple(times[r] for r in range(1, katz.K + 2))
            self.levels.append(katz.Level(sum(count.values()), len(count), times))
        self.followers = defaultdict(list)
        for count in self.count[1:]:
            for gram in count:
                self.followers[gram[:-1]].append(gram[-1])
        size = max(self.levels[0].tokens, 1)
        lost = sum(c - self.kept(0, c) for c in self.count[0].values())
        self.unknown = lost / size if self.count[0] else 1.0
        self.weights = {}

    def kept(self, n, count):
        if (n, count) not in self.known:
            self.known[n, count] = float(self.levels[n].reduced(np.array([count]))[0])
        return self.known[n, count]

    def p(self, word, context):
        n, gram = len(context), (*context, word)
        if gram in self.count[n]:
            return self.kept(n, self.count[n][gram]) / self.context[n][context]
        if not n:
            return self.unknown
        below = self.p(word, context[1:])
        return below * self.weight(context) if context in self.context[n] else below

    def weight(self, context):
        if context not in self.weights:
            n, words = len(context), self.followers[context]
            counts = [self.count[n][*context, w] for w in words]
            lost = sum(c - self.kept(n, c) for c in counts) / self.context[n][context]
            self.weights[context] = lost / (1 - sum(self.p(w, context[1:]) for w in words))
        return self.weights[context]

    def score(self, text):
        padded = ["<s>"] * (self.order - 1) + tokens_of(text)
        ends = range(self.order - 1, len(padded))
        return sum(math.log10(self.p(padded[e], tuple(padded[e - self.order + 1 : e]))) for e in ends)


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def same_scores(found, rows, order):
    brute = Brute([r[1] for r in rows if not held_out(r[0])], order)
    words = brute.levels[0]
    expected = []
    for doc_id, text, *_ in rows:
        tokens = tokens_of(text)
        counts = [brute.count[0][(t,)] for t in tokens]
        base = sum(math.log10((c + 1) / (words.tokens + words.distinct + 1)) for c in counts)
        known = sum(c > 0 for c in counts)
        expected.append((doc_id, held_out(doc_id), len(tokens), known, words.tokens, base, brute.score(text)))
    order_of = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 3))
    for ours, theirs in zip(sorted(found, key=order_of), sorted(expected, key=order_of), strict=True):
        assert tuple(ours)[:5] == theirs[:5]
        assert tuple(ours)[5:] == pytest.approx(theirs[5:], rel=1e-9, abs=2e-6)
    return brute


def scores(docs, order=katz.ORDER):
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return katz.score(docs, rest == 2, order)


def test_katz_query_equals_brute_force(spark, written):
    same_scores(queries.op12_katz(spark, written).collect(), odd_rows(), 2)


@pytest.mark.parametrize("order", [1, 3])
def test_katz_in_many_batches_and_ranges(spark, sf_dir, order, monkeypatch):
    monkeypatch.setattr(katz, "BATCH_BYTES", 30_000)
    monkeypatch.setattr(katz, "RANGE_KEYS", 5_000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    brute = same_scores(scores(docs.repartition(3), order).collect(), rows, order)
    contexts = random.Random(order).sample(sorted(brute.context[order - 1]), min(20, len(brute.context[order - 1])))
    for context in contexts:  # probabilities of all words and the unknown one sum to 1
        words = [w for (w,) in brute.count[0]]
        assert sum(brute.p(w, context) for w in [*words, "\0"]) == pytest.approx(1, abs=1e-12)
    held = [r for r in rows if held_out(r[0])]
    model = sum(brute.score(r[1]) for r in held)
    word = Brute([r[1] for r in rows if not held_out(r[0])], 1)
    assert order == 1 or model > sum(word.score(r[1]) for r in held)


def test_katz_hot_contexts_are_joined_alike(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    rows = docs.select("doc_id", "text").collect()
    for hot in (1, 10**9):
        monkeypatch.setattr(katz, "HOT", hot)
        same_scores(scores(docs).collect(), rows, 2)


def test_katz_without_training_or_rows(spark, odd):
    held = next(i for i in range(100) if held_out(i))
    rows = [(held, "some words", "en", "a", 1)]
    (row,) = scores(spark.createDataFrame(rows, DOCUMENT)).collect()
    assert (row.train_tokens, row.n_known, row.score, row.base_score) == (0, 0, 0, 0)
    assert scores(odd.limit(0)).collect() == []


def test_packed_numbers_come_back():
    for numbers in ([], [0], [255, 256], [1 << 40, 3], [(1 << 64) - 1]):
        packed = katz._pack(np.array(numbers, np.uint64))
        assert katz._unpack(packed, len(numbers)).tolist() == numbers


def test_turing_estimates_fall_back():
    assert katz.Level(10, 5, (5, 0, 0, 0, 0, 0)).keeps(np.array([1, 9])).max() < 1
    keeps = katz.Level(400, 171, (100, 40, 20, 8, 3, 0)).keeps(np.arange(8))
    assert keeps[0] == 0 and (keeps[1:] < 1).all() and (np.diff(keeps[1:]) > 0).all()
    exact = katz.Level(400, 173, (100, 40, 20, 10, 6, 3)).keeps(np.array([1, 2]))
    assert exact.tolist() == [2 * 40 / 100, 3 * 20 / (2 * 40)]


# ---- variants -------------------------------------------------------------------------


def brute_counts(rows, every):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in word)
            number = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if number % every == 0:
                word = word[: number % len(word)] + word[number % len(word) + 1 :]
            counts[word] += 1
    return counts


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(counts, least_n=5, least_length=6):
    words = {w: n for w, n in counts.items() if n >= least_n and len(w) >= least_length}
    by_size = defaultdict(list)
    for word in words:
        by_size[len(word)].append(word)
    near = {
        w: [x for size in (-1, 0, 1) for x in by_size[len(w) + size] if x != w and one_edit(w, x)]
        for w in words
    }
    best = {w: min(((-words[x], x) for x in near[w]), default=(0, None)) for w in words}
    form = {w: x for w, (n, x) in best.items() if -n >= 5 * words[w]}

    def root(word):
        return root(form[word]) if word in form else word

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def letters_rows():
    """Words of few letters, so that many are near and many share their counts."""
    pick = random.Random(5)
    words = {"".join(pick.choices("abé", k=pick.choice((5, 6, 6, 7, 7, 8)))) for _ in range(420)}
    words |= {"a" * n for n in (6, 7, 90, 91)} | {"÷" * 6, "×" * 6}
    rows = []
    for number, word in enumerate(sorted(words)):
        times = pick.choice((4, 5, 6, 26, 30, 140, 800))
        rows.append((number, f"{word.upper() if number % 9 == 0 and word.isascii() else word} " * times, None, None, 0))
    return [*rows, (7, None, None, None, None), (8, "", "en", "a", 0), (None, "1234 -- " + rows[3][1], None, None, 1)]


@pytest.mark.parametrize("size,sample", [(4096, 50_000), (4, 40)])
def test_variants_equal_brute_force(spark, monkeypatch, size, sample):
    monkeypatch.setattr(variants.neighbours, "__defaults__", (sample, size))
    monkeypatch.setattr(variants, "MOST_CELLS", 64)
    docs = spark.createDataFrame(letters_rows(), DOCUMENT)
    docs = docs.withColumns({c: F.lit("clash") for c in CLASHES})
    found = variants.group(docs, edit_every=19).collect()
    expected = brute_forms(brute_counts(letters_rows(), 19))
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected
    chained = [r for r in found if r.form and r.root != r.form]
    assert chained and any(r.n_near > 5 for r in found)


def test_variants_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op13_variants(spark, sf_dir).collect()
    assert {tuple(r) for r in found} == brute_forms(brute_counts(rows, 199))


def test_variants_of_no_words(spark, odd):
    assert variants.group(odd.limit(0)).collect() == []
    assert variants.group(odd.where("text IS NULL OR doc_id < 4")).collect() == []


def test_crc_of_long_runs():
    words = ["a" * n for n in (1, 63, 64, 65, 300)] + ["é" * 40]
    numbers = variants.Numbers([12, None], [w.encode() for w in words])
    for doc, start in ((0, "12:"), (1, ":")):
        got = numbers.of(np.full(len(words), doc), np.arange(len(words)))
        assert got.tolist() == [zlib.crc32((start + w).encode()) for w in words]


def test_equal_letter_counts_take_time_in_line_with_words():
    """Permutations of the same letters: no pairs are compared, only what matches."""
    pick = random.Random(1)
    letters = list("aaaabbbbcccc")
    words = {"".join(pick.sample(letters, len(letters))) for _ in range(6000)}
    changed = {w.replace("a", "d", 1) for w in words}
    q, p = variants.near_words(pa.array(sorted(changed)), pa.array(sorted(words)))
    points, asked = sorted(changed), sorted(words)
    some = list(zip(q.tolist(), p.tolist()))
    assert all(one_edit(asked[i], points[j]) for i, j in some)
    assert {(asked[i], points[j]) for i, j in some} >= {(w, w.replace("a", "d", 1)) for w in words}


def test_katz_asks_for_one_level_at_a_time(monkeypatch):
    """The arrays of a batch and of its levels do not lie beside those of the next."""
    import tracemalloc

    rng = np.random.default_rng(3)
    words = rng.integers(0, 50_000, 300_000).astype(np.uint32)
    row = {
        "batch": 1, "docs": [1], "held": [False], "lengths": [len(words)],
        "tokens": katz._squeeze(words.tobytes()), "words": np.arange(50_000, dtype=np.uint64).tobytes(),
    }
    one = pa.RecordBatch.from_pylist([row])

    def peak(batches):
        tracemalloc.start()
        levels = sum(1 for _ in katz._ask(iter(batches), 2, 1))
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return levels, most / len(words)

    assert peak([one])[0] == 2
    levels, most = peak([one] * 3)
    assert levels == 6 and most < 100  # bytes a token
