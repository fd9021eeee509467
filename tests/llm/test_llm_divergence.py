"""Source divergence against a plain version, with long terms, small stretches and odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from callweave.llm import divergence
from callweave.llm.tokens import Tokens, tokens
from tables import odd  # noqa: F401


def brute(rows, least, top):
    """Rows of the audit out of (id, text, lang, source) rows whose ids are distinct."""
    docs, counts, groups = defaultdict(set), Counter(), set()
    for i, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for raw in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or ""):
            term = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
            docs[lang, term].add(i)
            counts[lang, source, term] += 1
    kept = defaultdict(list)
    for (lang, term), d in docs.items():
        if len(d) >= least:
            kept[lang].append(term)
    out = []
    for lang, source in groups:
        others = [s for x, s in groups if x == lang]
        terms = kept[lang]
        of = lambda s, t: counts[lang, s, t] if s is not None else sum(counts[lang, x, t] for x in others)  # noqa: B023, E731
        share = lambda s: {t: 1 + 10**9 * (of(s, t) + 1) // (sum(of(s, u) for u in terms) + len(terms)) for t in terms}  # noqa: B023, E731
        p, q = share(source), share(None)
        pairs = []
        for other in others:
            if other != source:
                r = share(other)
                pairs.append((other, sum((p[t] - r[t]) ** 2 // r[t] for t in terms)))
        own = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in terms if of(source, t) and p[t] > q[t]]
        for part, found, limit in (("pair", pairs, None), ("term", own, top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found[:limit])]
    return sorted(out)


def made(seed):
    rng = np.random.default_rng(seed)
    stock = ["a", "Straße", "ÉCOLE", "école", "sevenXX", "eightAbc", "ninechars", "sixteencharsxxyy", "x" * 17, "漢字" * 3, "y" * 40, "Z" * 300, "z" * 299]
    rows = []
    for i in range(120):
        words = [stock[k] for k in rng.integers(0, len(stock), rng.integers(0, 30))] + [f"own{chr(97 + i % 26)}"]
        text = "".join(w + rng.choice([" ", "1", "\n", "@[", "\x7f"]) for w in words)
        rows.append((i, text if i % 17 else None, [None, "en", "de", "xx"][min(int(rng.integers(0, 9)), 3)], [None, "a", "b", "c"][rng.integers(0, 4)]))
    rows.append((500, "lonely words only", "solo", "p"))
    rows.append((501, None, "solo", "q"))
    return rows


@pytest.mark.parametrize("seed,stretch", [(1, 1 << 21), (2, 40)])
def test_against_brute_force(spark, monkeypatch, seed, stretch):
    monkeypatch.setattr(divergence, "STRETCH", stretch)
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    assert sorted(map(tuple, divergence.audit(df, top=5).collect())) == brute(rows, 3, 5)


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "twice", "en", "a")] * 3 + [(2, "twice", "en", "b"), (None, "none", "en", "b"), (None, "none", "en", "b"), (3, "none", "en", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert {r["item"] for r in divergence.audit(df, min_docs=2).collect() if r["part"] == "term"} <= {"twice", "none"}
    assert [r for r in divergence.audit(df, min_docs=3).collect() if r["part"] == "term"] == []


def test_odd_and_empty(odd):
    out = divergence.audit(odd).collect()
    pairs = {(r["lang"], r["source"], r["item"]) for r in out if r["part"] == "pair"}
    assert ("en", "", "a") in pairs and ("en", "c", "b") in pairs
    assert {r["value"] for r in out if r["lang"] == "" and r["part"] == "pair"} == {0}
    assert divergence.audit(odd.limit(0)).collect() == []


def test_packing_and_radix():
    import pyarrow as pa

    found = next(iter(tokens(pa.array(["abcdefgh ABCDEFGHI", None, "", "é"]), divergence.TERM)))
    assert found.row.tolist() == [0, 0, 3]
    short = Tokens(found.data, found.start[[0, 2]], found.end[[0, 2]], found.row[[0, 2]])
    assert [int(w).to_bytes(8, "big").rstrip(b"\0").decode() for w in divergence._packed(short, 1)[0]] == ["abcdefgh", "é"]
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 1 << 63, 999, dtype=np.uint64), rng.integers(0, 9, 999, dtype=np.uint64)
    assert (divergence.radix_order([a, b]) == np.lexsort((a, b))).all()
