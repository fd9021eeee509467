"""N-gram model against the definition by plain counts, held-out texts, and odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from callweave.llm import catalog, ngrams, tokens
from pyspark.sql import functions as F
from tables import FOLDER, odd  # noqa: F401


def split(text):
    return [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())] + [None]


class Brute:
    """Interpolated modified Kneser-Ney by its recursion; the end is None, the start is 0."""

    def __init__(self, texts, order):
        self.order, raw = order, Counter()
        for text in texts:
            seq = [0, *split(text)]
            for k in range(1, order + 1):
                raw.update((tuple(seq[i - k + 1 : i + 1])) for i in range(max(k - 1, 1), len(seq)))
        self.words = Counter({g[0]: n for g, n in raw.items() if len(g) == 1})
        self.n, self.v = sum(self.words.values()), len(self.words)
        before = defaultdict(set)
        for g in raw:
            if len(g) > 1:
                before[g[1:]].add(g[0])
        self.count, self.follow, self.d = {}, {}, {}
        for k in range(1, order + 1):
            c = {g: n if k == order or (k > 1 and g[0] == 0) else len(before[g]) for g, n in raw.items() if len(g) == k}
            t = [sum(n == i for n in c.values()) for i in (1, 2, 3, 4)]
            self.d[k] = ngrams.discounts(*t)
            follow = defaultdict(list)
            for g, n in c.items():
                follow[g[:-1]].append(n)
            off = lambda n: float(self.d[k][min(n, 3)])  # noqa: B023, E731
            self.count[k], self.follow[k] = c, {g: (sum(n), sum(map(off, n))) for g, n in follow.items()}

    def p(self, context, word):
        k = len(context) + 1
        if k == 1:
            below = 1 / (self.v + 1)
        else:
            below = self.p(context[1:], word)
        seen = self.follow[k].get(tuple(context))
        if not seen:
            return below
        n = self.count[k].get((*context, word), 0)
        return (n - float(self.d[k][min(n, 3)])) / seen[0] + seen[1] / seen[0] * below

    def score(self, text):
        seq = [0, *split(text)]
        own = seq[1:]
        base = sum(math.log10((self.words[w] + 1) / (self.n + self.v + 1)) for w in own)
        model = sum(math.log10(self.p(seq[max(i - self.order + 1, 0) : i], seq[i])) for i in range(1, len(seq)))
        return len(own), sum(self.words[w] > 0 for w in own), base, model


def made(seed, n=80):
    rng = random.Random(seed)
    stock = [f"w{i}" for i in range(40)]
    return [None, "", " \n", *[" ".join(stock[min(int(rng.expovariate(0.15)), 39)].upper() if rng.random() < 0.1 else stock[min(int(rng.expovariate(0.15)), 39)] for _ in range(rng.randrange(30))) for _ in range(n)]]


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("small", [False, True])
def test_against_the_definition(spark, monkeypatch, order, small):
    if small:
        monkeypatch.setattr(tokens, "PIECE", 50)
        monkeypatch.setattr(ngrams, "PART_BYTES", 700)
        monkeypatch.setattr(ngrams, "STRETCH", 90)
        monkeypatch.setattr(ngrams, "OPEN_FILES", 2)
    texts = made(order)
    plain = Brute(texts[:60], order)
    frame = lambda t: spark.createDataFrame(list(enumerate(t)), "doc_id long, text string").repartition(3)
    model = ngrams.train(frame(texts[:60]), order=order)
    assert (model.n, model.v) == (plain.n, plain.v)
    for k in range(order):
        assert np.allclose(model.levels[k].discounts, plain.d[k + 1])
    texts += ["never seen words w1 w2 never w1", "w0 " * 500]
    for r in ngrams.score(frame(texts), model).collect():
        tokens_, known, base, score = plain.score(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"]) == (tokens_, known)
        assert r["base_score"] == pytest.approx(base, rel=1e-12)
        assert r["score"] == pytest.approx(score, rel=1e-10)
        assert r["perplexity"] == pytest.approx(10 ** (-score / tokens_), rel=1e-10)


def test_probabilities_sum_to_one(spark):
    texts = made(9)
    plain = Brute(texts, 2)
    for context in ((0,), ("w0",), ("w3",), ("nowhere",)):
        assert sum(plain.p(context, w) for w in plain.words) + plain.p(context, "unknown") == pytest.approx(1)


def test_frequent_pairs_and_wide_counts(spark, tmp_path):
    docs = spark.createDataFrame([(i, "often seen " * 200) for i in range(3)], "doc_id long, text string")
    model = ngrams.train(docs)
    plain = Brute(["often seen " * 200] * 3, 2)
    for r in ngrams.score(docs, model).collect():
        assert r["score"] == pytest.approx(plain.score("often seen " * 200)[3], rel=1e-10)
    values = np.array([[1 << 33, 2, 3, 4, 5, 6]])
    assert ngrams._write(f"{tmp_path}/wide", np.array([7], np.uint64), values, False) == (0, 8)
    tables = ngrams._Tables(ngrams.Model(2, [ngrams.Level(1, {0: (f"{tmp_path}/wide", 1, 0, 8)}, np.zeros(4))], 0, 0, 0, 0.0))
    assert tables.find(0, np.array([7, 8], np.uint64)).tolist() == [values[0].tolist(), [0] * 6]


def test_hash_is_that_of_spark(spark):
    rng = np.random.default_rng(1)
    x, y = rng.integers(-(1 << 62), 1 << 62, (2, 50))
    rows = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x long, y long").select(F.xxhash64("x", "y"))
    assert ngrams.pair_hash(x.view(np.uint64), y.view(np.uint64)).view(np.int64).tolist() == [r[0] for r in rows.collect()]


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_sequences(monkeypatch, piece):
    monkeypatch.setattr(tokens, "PIECE", piece)
    hashes = tokens.Hashes(13)
    texts = [None, "A b", "", "averylongwordindeed x\ty", None, " ", "z", ""]
    want = []
    for i, t in enumerate(texts):
        want += [(i, "S"), *[(i, w or "E") for w in split(t)]]
    name = {int(ngrams.START): "S", int(ngrams.END): "E"}
    for w in {w for t in texts for w in split(t) if w}:
        found = next(iter(tokens.tokens(pa.array([w]), ngrams.WORD_BYTES)))
        name[int(hashes.of(found)[0])] = w
    got = []
    for seq, row, lead in ngrams.sequences(pa.array(texts), hashes, 3):
        assert [name[int(h)] for h in seq[:lead]] == [w for _, w in got[len(got) - lead :]]
        got += [(int(r), name[int(h)]) for h, r in zip(seq[lead:], row[lead:])]
    assert got == want


def test_query_rows(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    plain = Brute([t for i, t in rows if not held(i)], 2)
    texts = dict(map(tuple, rows))
    got = catalog.QUERIES["op13_lm_scoring"](spark, FOLDER).collect()
    assert len(got) == len(rows)
    better = 0
    for r in got:
        n, known, base, score = plain.score(texts[r["doc_id"]])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(r["doc_id"]), n, known, plain.n)
        assert r["base_score"] == pytest.approx(base, rel=1e-11)
        assert r["score"] == pytest.approx(score, rel=1e-9)
        better += r["held_out"] and r["score"] > r["base_score"]
    out = [r for r in got if r["held_out"]]
    assert better > 0.9 * len(out)
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_odd_and_empty(odd):
    model = ngrams.train(odd)
    out = ngrams.score(odd, model)
    assert out.count() == odd.count() and out.filter("score IS NULL OR n_tokens < 1").count() == 0
    assert set(odd.columns) - {"score"} <= set(out.columns) and dict(out.dtypes)["score"] == "double"
    empty = ngrams.train(odd.limit(0))
    assert (empty.n, empty.v) == (0, 0)
    assert {(r["n_known"], r["base_score"], r["score"]) for r in ngrams.score(odd, empty).collect()} == {(0, 0.0, 0.0)}
    assert ngrams.score(odd.limit(0), model).collect() == []
    with pytest.raises(ValueError, match="mount"):
        ngrams.local_folder("hdfs://host/folder")
