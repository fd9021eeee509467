"""Operators against plain versions, SQL, a library or held-out rows."""

import random
from collections import Counter, defaultdict

import brute
import duckdb
import numpy as np
import pytest
from callweave.llm import catalog, components, embed, jaccard, langid, licenses, mixing, pieces, quality, secrets, suffix
from pyspark.sql import functions as F
from tables import FOLDER, docs  # noqa: F401


def texts(seed, n=120):
    """Documents over few words, with copies, near copies and shared passages."""
    rng = random.Random(seed)
    made = []
    for _ in range(n):
        words = [rng.choice("alpha beta gamma delta epsilon zeta eta theta Iota kappa".split()) + str(rng.randrange(60)) for _ in range(rng.choice((0, 1, 2, 3, 4, 8, 30, 90)))]
        if made and rng.random() < 0.5:
            words = rng.choice(made).split(" ")
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"new{rng.randrange(99)}"
        made.append(" ".join(words))
    return list(enumerate(made))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    rel = con.sql(catalog.ORACLES[name])
    df = catalog.QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    assert Counter(tuple(map(plain, r)) for r in df.collect()) == Counter(tuple(plain(r[i]) for i in order) for r in rel.fetchall())


def test_repeated_words(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(n))) for i, n in enumerate([0, 1, 4, 5, 6, 7, 9, 12, 20, 40, 60] * 4)]
    got = {r[0]: r[1] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_repeat_words").collect()}
    for i, text in rows:
        w = text.split()
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        n = Counter(grams)
        assert got[i] == len({k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(5)}), text


def test_quality_labels(spark):
    judged = quality.judge(spark.read.parquet(f"{FOLDER}/documents.parquet")).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    n = {(r[0], r[1]): r[2] for r in judged.filter("NOT base_failed").groupBy("quality", "kept").count().collect()}
    assert (1, False) not in n
    assert n.get((0, True), 0) <= 0.1 * n[0, False]


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80), (1, 50)])
def test_jaccard(spark, words, percent):
    rows = texts(words)
    got = jaccard.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), words=words, percent=percent).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute.jaccard(rows, words, percent)


def test_jaccard_blocks(spark, monkeypatch):
    """Cells that are cut into many blocks give the same components."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 7)
    rows = texts(8, 200)
    got = jaccard.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=70).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute.jaccard(rows, 3, 70)


def test_jaccard_real(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r[0]: (r[1], r[2]) for r in catalog.QUERIES["op2_ngram_join"](spark, FOLDER).collect()}
    assert got == brute.jaccard(rows, 3, 90)


def test_signatures_share_a_value():
    rng = np.random.default_rng(1)
    for percent in (80, 90):
        rule = jaccard.Threshold(percent)
        for n in [*range(1, 40), 100, 400, 900]:
            s = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            for _ in range(5):
                new = rng.integers(0, 1 << 63, rng.integers(0, n // 2 + 1), dtype=np.uint64)
                t = np.unique(np.concatenate([rng.permutation(s)[: rng.integers(n // 2, n + 1)], new]))
                both = len(np.intersect1d(s, t))
                if len(t) and 100 * both >= percent * (len(s) + len(t) - both):
                    assert np.intersect1d(rule.signature(s), rule.signature(t)).size, (percent, len(s), len(t))


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(1, 1), (None, 3)]
    got = {r[0]: r[1] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    found = brute.smallest(400, [x for x in links if None not in x])
    assert got == {i: found[i] for x in links if None not in x and x[0] != x[1] for i in x}


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embed, "BLOCK", 64)
    monkeypatch.setattr(embed, "WINDOW", 16)
    monkeypatch.setattr(embed, "CELL", 20)
    rng = np.random.default_rng(2)
    rows = []
    for c in range(12):
        centre = rng.standard_normal(16)
        for _ in range(c * 4 + 1):
            rows.append((len(rows), [float(x) for x in centre + rng.standard_normal(16) * 0.08]))
    rows += [(len(rows) + i, v) for i, v in enumerate([None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [1e300, 1e300], [1e-300, 1e-300], rows[5][1], [2 * x for x in rows[5][1]]])]
    got = embed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), recall=0.9999).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == brute.cosine([(i, [x / 1e290 for x in v] if v and v[0] == 1e300 else [x * 1e290 for x in v] if v and v[0] == 1e-300 else v) for i, v in rows], 0.95)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_embeddings_odd_rows(spark):
    rows = [(None, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (3, [0.0, 1.0], "x")]
    got = {(r[0], r[1], r[2], r[3]) for r in embed.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, digest string")).collect()}
    assert got == {(None, 0, None, False), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)}


def test_mixture_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), ("d", 5), (None, 7), ("f", 0)], "source string, size long")
    got = {r[0]: (r[1], r[2]) for r in mixing.source_targets(sizes).collect()}
    weights = dict(zip(["a", "b", "c", "d", "f", None], [1, 2, 3, 1, 2, 3]))
    left, stopped = 1122.0, {}
    while True:
        rest = {s: w for s, w in weights.items() if s not in stopped}
        share = {s: (left - sum(stopped.values())) * w / sum(rest.values()) for s, w in rest.items()}
        over = {s: 3.0 * got[s][0] for s, x in share.items() if x > 3 * got[s][0]}
        if not over:
            break
        stopped |= over
    assert {s: x[1] for s, x in got.items()} == pytest.approx(stopped | share)


def test_mixture_budgets(docs):
    taken = mixing.mixture(docs).collect()
    by = defaultdict(list)
    for r in taken:
        assert r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0
        by[r["source"]].append(r)
    for rows in by.values():
        assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= max(r["size"] for r in rows) / 2 + 1
    mixed = {r[0]: r[1] for r in mixing.mix(docs).groupBy("doc_id").count().collect()}
    assert mixed == {r["doc_id"]: r["epochs"] for r in taken if r["epochs"]}
    assert sorted(map(tuple, mixing.mixture(docs.repartition(5)).collect()), key=str) == sorted(map(tuple, taken), key=str)


def test_secrets_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    told = secrets.scan(held, secrets.model_of(docs), path_col="source").select("doc_id", "at", "part", "is_secret")
    labelled = secrets.labelled_findings(held).withColumnRenamed("id", "doc_id").select("doc_id", "at", "part", "secret")
    n = Counter((r["secret"], r["is_secret"]) for r in labelled.join(told, ["doc_id", "at", "part"]).collect())
    assert n[1, True] >= 0.95 * (n[1, True] + n[1, False]) > 0
    assert n[0, False] >= 0.95 * (n[0, True] + n[0, False]) > 0


def test_secret_without_two_classes(spark, docs):
    assert secrets.train(secrets.features(secrets.candidates(docs)).withColumn("secret", F.lit(0))) is None


def test_license_inheritance(spark):
    notice = licenses.TEMPLATES["MIT"]
    rows = [
        (1, f"code\n  {notice}", "a/b/c.py"),
        (2, licenses.TEMPLATES["GPL-3.0"], "a/LICENSE"),
        (3, "plain", "a/b/d.py"),
        (4, "plain", "z.py"),
        (5, licenses.TEMPLATES["Apache-2.0"], "a/b/x/COPYING.txt"),
        (6, "plain", "a/b/x/y/z/e.py"),
        (7, "an unrelated line about a licence fee that nobody has to pay at all", "a/f.py"),
        (8, None, None),
        (9, licenses.TEMPLATES["CC-BY-NC-4.0"], "LICENSE"),
    ]
    got = {r["doc_id"]: (r["own_license"], r["license"], r["inherited_from"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, path string")).collect()}
    assert got == {
        1: ("MIT", "MIT", None), 2: ("GPL-3.0", "GPL-3.0", None), 3: (None, "GPL-3.0", "a"), 4: (None, "CC-BY-NC-4.0", ""),
        5: ("Apache-2.0", "Apache-2.0", None), 6: (None, "Apache-2.0", "a/b/x"), 7: (None, "GPL-3.0", "a"), 8: (None, None, None),
        9: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
    }


def test_pieces_like_the_library():
    import sentencepiece

    table = pieces.read_table(pieces.MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    rng = random.Random(1)
    letters = " \n\tabcdefghijklmnopqrstuvwxyzéñß漢🙂.,;:!?'\"()[]{}<>=+-_/\\0123456789ABCTHE\xa0"
    encoder = pieces.Encoder(table)
    cases = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2000)]
    cases += ["", " ", "    ", "a" * 5000, "the " * 500, "x" * 70 + "tion" * 40, " " * 200 + "end"]
    for text in cases:
        ids = encoder.text(text)
        assert ids.tolist() == library.encode(text), text
        assert pieces.decode_ids(ids, table) == text


def test_viterbi_takes_the_best_path():
    rng = random.Random(4)
    for _ in range(200):
        chunk = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
        edges = {(i, j): -rng.random() for i in range(len(chunk)) for j in range(i + 1, len(chunk) + 1) if j == i + 1 or rng.random() < 0.5}

        def best(i):
            return max(([edges[i, j] + best(j)[0], j] for j in range(i + 1, len(chunk) + 1) if (i, j) in edges), default=[0.0, i]) if i < len(chunk) else [0.0, i]

        parts, at, total = pieces.viterbi_fold(chunk, edges), 0, 0.0
        for p in parts:
            total += edges[at, at + len(p)]
            at += len(p)
        assert "".join(parts) == chunk and total == pytest.approx(best(0)[0])


def test_relational_lattice(spark, docs):
    table = pieces.read_table(pieces.MODEL)
    rng = random.Random(9)
    known = rng.sample(sorted(table.ids), 3000)
    # a unigram model out of the vocabulary's pieces
    scores = {p: -1.0 - rng.random() * 8 for p in known}
    small = pieces.PieceTable({p: i for i, p in enumerate(known)}, scores, [-1] * 256, [], 0, False, True)
    words = [r[0] for r in docs.select(F.explode(F.split("text", " ")).alias("w")).distinct().limit(400).collect()] + [None, ""]
    got = {r["word"]: r["ids"] for r in pieces.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), small).collect()}
    encoder = pieces.Encoder(small)
    assert got == {w: np.frombuffer(encoder.chunk(w), "<i4").tolist() if w else [] for w in words if w is not None}


def test_pieces_of_documents(spark):
    out = catalog.QUERIES["op8_sentencepiece"](spark, FOLDER)
    assert out.filter("NOT same").count() == 0


def test_decode_odd_ids(spark):
    table = pieces.read_table(pieces.MODEL)
    rows = [(None,), ([],), ([1, 2],), ([-1],), ([10**6],), ([264, None],)]
    got = [r["decoded"] for r in pieces.decode(spark.createDataFrame(rows, "ids array<int>").coalesce(1), table).collect()]
    assert got == [None, "", "", None, None, None]


@pytest.mark.parametrize("length", [18, 50])
def test_suffixes(spark, length, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 300)
    rng = random.Random(length)
    rows = texts(length, 60) + [(100, "ab" * 400), (101, "ab" * 300), (102, "é" * 60), (103, "x" + "é" * 50), (104, None), (105, "")]
    passage = " ".join(rng.choice("one two three four".split()) for _ in range(40))
    rows += [(200 + i, f"{rng.random()} {passage[rng.randrange(20):]} {rng.random()}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix.without_repeats(df, length=length).withColumn("kept", F.sha2("kept", 256)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute.repeats(rows, length)


def test_suffixes_real(spark, docs):
    got = catalog.QUERIES["op9_suffix_dedup"](spark, FOLDER).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute.repeats([tuple(r) for r in docs.select("doc_id", "text").collect()], 50)


def test_language_held_out(spark, docs):
    told = catalog.QUERIES["op10_language_id"](spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in told) >= 0.99 * len(told)
    assert all(0 <= r["score"] <= 1 for r in told)


def test_a_model_has_a_bound(monkeypatch):
    grams = {x: (np.arange(40) * 7919 % (1 << 32), np.ones(40, np.int64)) for x in "ab"}
    full = langid.Model(["a", "b"], grams)
    monkeypatch.setattr(langid, "MAX_CELLS", (full.size**2 + 5) * full.size * 2)
    small = langid.Model(["a", "b"], grams)
    assert len(small.contexts) == 5 and small.bits.size <= langid.MAX_CELLS
    monkeypatch.setattr(langid, "MAX_CELLS", 10)
    with pytest.raises(ValueError):
        langid.Model(["a", "b"], grams)


def test_code_lengths():
    rng = random.Random(6)
    rows, grams = {}, {}
    for lang, letters in (("a", "aab c"), ("b", "abbd ")):
        text = b"\n" * langid.ORDER + "".join(rng.choice(letters) for _ in range(300)).encode()
        grams[lang] = Counter(text[i : i + langid.ORDER + 1] for i in range(len(text) - langid.ORDER))
        code = lambda g: sum(b << (8 * k) for k, b in enumerate(reversed(g)))
        rows[lang] = (np.array([code(g) for g in grams[lang]]), np.array(list(grams[lang].values())))
    model = langid.Model(["a", "b"], rows)
    for text in ("", "abc", "a b c d", "dddd", "zebra", "abé"):
        bits = langid.code_lengths(text.encode(), model, model.index(), chunk=4)
        known = [b for b in text.encode() if b in b"abcd \n"]
        if len(known) == len(text.encode()):
            assert bits == pytest.approx([brute.code_bits(text, grams[x], langid.ORDER) for x in "ab"], rel=1e-5)
        assert np.isfinite(bits).all()
