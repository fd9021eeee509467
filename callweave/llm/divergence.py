"""Source divergence audit: how far the words of each source lie from those of the other sources of its language.

Terms are counted in numpy by length-bucketed packing. A term of up to 8 bytes is one big-endian 64-bit word, one of up to 16
bytes two of them; these are radix-sorted by digits of 16 bits, and equal neighbours are counted as runs. Longer terms
are byte-sorted in buckets of their own, one for each power of two of their length. A task hands on one row for
each (language, term) of a stretch of its texts: its counts by source, and as many of the smallest document keys as a kept term
needs, which is enough to tell exactly whether that many documents have it. One shuffle by (language, term) brings these rows
together, where they are added up in sorted order. The rest is relational and meets kept terms only.

The sum over all kept terms for a pair of sources is split: terms that neither source has all give one value; terms of one
source alone depend on their count only, so a histogram of counts gives their sum; only terms that both have are met one by
one, in an equi-join on the term whose rows are added up where they arise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.llm.common import documents, identity
from callweave.llm.registry import query
from callweave.llm.tokens import Tokens, tokens
from callweave.session import cut_lineage

#: Terms counted at a time.
STRETCH = 1 << 21

#: Bytes of terms: ASCII letters and all bytes of other characters.
TERM = np.zeros(256, bool)
TERM[65:91] = TERM[97:123] = TERM[128:] = True

_RUNS = "lang string, term string, sources array<long>, ns array<long>, docs array<long>"
_NAMES = ["lang", "term", "sources", "ns", "docs"]
_TYPES = [pa.string(), pa.string(), *[pa.list_(pa.int64())] * 3]


def _packed(found: Tokens, words: int) -> np.ndarray:
    """Terms as rows of big-endian words, zeros behind; no term holds a zero byte, so equal rows are equal terms."""
    length = found.end - found.start
    out = np.zeros((words, len(length)), np.uint64)
    for j in range(8 * words):
        at = np.minimum(found.start + j, len(found.data) - 1)
        byte = np.where(j < length, found.data[at], 0).astype(np.uint64)
        out[j // 8] |= byte << np.uint64(56 - 8 * (j % 8))
    return out


def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """Stable order by unsigned columns, the first one least significant: one counting pass for each digit of 16 bits."""
    order = np.arange(len(columns[0]))
    for column in columns:
        top = int(column.max()) if len(column) else 0
        for shift in range(0, top.bit_length(), 16):
            digit = ((column >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if digit.min() != digit.max():
                # numpy sorts 16-bit integers by radix when the sort has to be stable
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _firsts(run: np.ndarray, new: np.ndarray, least: int):
    """Places of the first ``least`` marked rows of each run, and how many each run has."""
    places = np.flatnonzero(new)
    of = run[places]
    head = np.searchsorted(of, np.arange(run[-1] + 1 if len(run) else 0))
    kept = np.arange(len(places)) - head[of] < least
    return places[kept], np.bincount(of[kept], minlength=len(head))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes)).astype(np.int32), pa.array(values))


def _table(lang, term, cells, docs) -> pa.RecordBatch:
    """A row for each (language, term); ``cells`` are (run, source, n) in order of run, ``docs`` are (values, sizes)."""
    of, source, n = cells
    sizes = np.bincount(of, minlength=len(lang))
    columns = [pa.array(lang, pa.string()), term, _lists(source, sizes), _lists(n, sizes), _lists(*docs)]
    return pa.RecordBatch.from_arrays([x.cast(t) for x, t in zip(columns, _TYPES)], names=_NAMES)


def _cells(run: np.ndarray, source: np.ndarray, n: np.ndarray | None = None):
    """Occurrences by (run, source)."""
    names, code = np.unique(source, return_inverse=True)
    order = radix_order([code.astype(np.uint64), run.astype(np.uint64)])
    run, code = run[order], code[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(run))) if n is None else np.add.reduceat(n[order], at) if len(at) else n
    return run[at], names[code[at]], n


class _Stretch:
    """Terms of some texts, in buckets by length."""

    def __init__(self, least: int):
        self.least, self.size = least, 0
        self.parts: dict[int, list] = {}

    def add(self, found: Tokens, *owners: np.ndarray) -> None:
        """``owners``: language code, source and document of each row."""
        length = found.end - found.start
        # bucket: number of words, or the power of two that bounds a longer term
        bucket = np.where(length <= 16, (length + 7) // 8, 1 << np.ceil(np.log2(np.maximum(length, 17))).astype(np.int64))
        for b in np.unique(bucket):
            at = np.flatnonzero(bucket == b)
            part = Tokens(found.data, found.start[at], found.end[at], found.row[at])
            if b <= 2:
                packed = _packed(part, int(b))
            else:
                wide = np.zeros((len(at), int(b)), np.uint8)
                wide[np.arange(int(b)) < length[at][:, None]] = np.concatenate([found.data[s:e] for s, e in zip(part.start, part.end)])
                packed = wide.view(f"S{b}").ravel()
                self.size += int(b) // 8 * len(at)
            self.parts.setdefault(int(b), []).append((packed, *[x[part.row] for x in owners]))
        self.size += len(length)

    def counted(self, langs: list[str]) -> Iterator[pa.RecordBatch]:
        for b, parts in sorted(self.parts.items()):
            lang, source, doc = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
            keys, doc = np.unique(doc, return_inverse=True)
            terms = np.concatenate([p[0] for p in parts], axis=-1)
            if b <= 2:
                order = radix_order([doc.astype(np.uint64), *terms[::-1], lang.astype(np.uint64)])
                terms = terms[:, order]
                differs = (terms[:, 1:] != terms[:, :-1]).any(0)
            else:
                order = np.lexsort((doc, terms, lang))
                terms = terms[order]
                differs = terms[1:] != terms[:-1]
            lang, source, doc = lang[order], source[order], doc[order]
            new = np.ones(len(order), bool)
            new[1:] = differs | (lang[1:] != lang[:-1])
            run, start = np.cumsum(new) - 1, np.flatnonzero(new)
            new[1:] |= doc[1:] != doc[:-1]
            places, sizes = _firsts(run, new, self.least)
            heads = np.ascontiguousarray(terms[:, start].T).astype(">u8").view(f"S{8 * b}").ravel() if b <= 2 else terms[start]
            term = pa.array(heads.tolist(), pa.binary()).cast(pa.string())
            yield _table([langs[x] for x in lang[start]], term, _cells(run, source), (keys[doc[places]], sizes))
        self.__init__(self.least)


def _count(least: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, langs = _Stretch(least), {}
        for batch in batches:
            lang = np.array([langs.setdefault(x, len(langs)) for x in batch.column(0).to_pylist()], np.int64)
            source, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for found in tokens(batch.column(3), TERM):
                stretch.add(found, lang, source, doc)
                if stretch.size >= STRETCH:
                    yield from stretch.counted(list(langs))
        yield from stretch.counted(list(langs))

    return count


def _merge(least: int):
    """Cells of the terms with ``least`` documents, out of rows sorted by language and term; one open term is carried on."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays([x.cast(t) for x, t in zip(batch.columns, _TYPES)], names=_NAMES)
            batch = batch if open_ is None else pa.Table.from_batches([open_, batch]).combine_chunks().to_batches()[0]
            new = np.ones(batch.num_rows, bool)
            for c in (0, 1):
                column = batch.column(c)
                same = pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
                new[1:] = ~same if c == 0 else new[1:] | ~same
            run, start = np.cumsum(new) - 1, np.flatnonzero(new)
            lists = [batch.column(c) for c in (2, 3, 4)]
            values = [x.flatten().to_numpy(zero_copy_only=False) for x in lists]
            of = [np.repeat(run, pc.list_value_length(x).to_numpy(zero_copy_only=False)) for x in lists]
            cells = _cells(of[0], values[0], values[1])
            order = np.lexsort((values[2], of[2]))
            doc, owner = values[2][order], of[2][order]
            seen = np.ones(len(doc), bool)
            seen[1:] = (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1])
            places, sizes = _firsts(owner, seen, least)
            heads = batch.take(pa.array(start))
            whole = _table(heads.column(0), heads.column(1), cells, (doc[places], sizes))
            last = len(start) - 1
            open_ = whole.slice(last)
            yield _kept(whole.slice(0, last), least)
        if open_ is not None:
            yield _kept(open_, least)

    return merge


def _kept(rows: pa.RecordBatch, least: int) -> pa.RecordBatch:
    rows = rows.filter(pc.greater_equal(pc.list_value_length(rows.column("docs")), least))
    of = pc.list_parent_indices(rows.column("sources"))
    columns = [rows.column("lang").take(of), rows.column("term").take(of), rows.column("sources").flatten(), rows.column("ns").flatten()]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "source_key", "n"])


def _share(count: str, total: str) -> Column:
    """1 + floor(10**9 * (count + 1) / (total + V)), three digits at a time so that nothing overflows."""
    a, d = f"({count} + 1) * 1000", f"({total} + V)"
    b, c = f"(({a}) % {d}) * 1000", f"((({a}) % {d}) * 1000 % {d}) * 1000"
    return F.expr(f"1 + (({a}) div {d}) * 1000000 + (({b}) div {d}) * 1000 + ({c}) div {d}")


def _gap(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def audit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_docs: int = 3,
    top: int = 200,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how each source differs from the others of its language.

    Terms are runs of letters and non-ASCII characters with A-Z lower-cased; a language keeps those that are in ``min_docs`` of
    its documents. A term's share in a group is p = 1 + floor(10**9 (count + 1) / (N + V)), with N the group's
    occurrences of kept terms and V their number. Part ``pair`` adds floor((p - q)^2 / q) over all kept terms, q being the other
    source's share; part ``term`` has the ``top`` kept terms of the group with p above the language's share q. Ranks go
    by value downwards, then by item in byte order.

    Null languages, sources and texts are empty ones. Groups without terms take part with counts of 0; a language
    without kept terms has pairs of value 0 and no terms. Rows of one id are one document of each language they name, rows
    without an id are told apart by their text; occurrences of repeated rows all count. Other columns are not looked
    at, whatever their names. An empty table gives an empty table. Documents and groups are
    told apart by 64-bit keys.
    """
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(name(lang_col).alias("lang"), name(source_col).alias("source"), *identity(id_col, text_col), F.col(f"`{text_col}`").alias("text"))
    # ids that are whole numbers are their own keys; they take less room than hashes
    key = F.xxhash64("_doc")
    if dict(docs.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint"):
        key = F.when(F.col("_doc").startswith("null "), key).otherwise(F.expr("try_cast(_doc AS BIGINT)"))
    groups = rows.select("lang", "source", F.xxhash64("lang", "source").alias("source_key")).distinct()
    texts = rows.filter("text IS NOT NULL").select("lang", F.xxhash64("lang", "source").alias("source_key"), key.alias("doc"), "text")
    runs = texts.mapInArrow(_count(min_docs), _RUNS).repartition("lang", "term").sortWithinPartitions("lang", "term")
    counts = runs.mapInArrow(_merge(min_docs), "lang string, term string, source_key long, n long")
    counts = cut_lineage(counts)
    # one row a group, from its files' size on known to Spark, which broadcasts it only while it is small
    sums = counts.groupBy("source_key").agg(F.sum("n").alias("total"))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("V"), F.sum("of_lang").alias("L"))
    sizes = groups.join(sums, "source_key", "left").join(langs, "lang", "left").fillna(0, ["total", "V", "L"])
    sizes = cut_lineage(sizes)
    known = sizes.filter("V > 0").withColumn("zero", _share("0", "total"))
    shares = counts.join(known.select("source_key", "source", "total", "V", "L", "zero"), "source_key").withColumn("p", _share("n", "total"))
    pairs = _pairs(shares, known, sizes)
    found = shares.join(terms, ["lang", "term"]).withColumn("q", _share("of_lang", "L")).filter("p > q")
    found = found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_gap("p", "q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(found.withColumn("rank", rank).filter(F.col("rank") <= top))


def _pairs(shares: DataFrame, known: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sum over all kept terms for each ordered pair of sources of a language."""
    left = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("zero").alias("za"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("zero").alias("zb"))
    both = left.join(right, ["lang", "term"]).filter("a < b")
    # what a term of both sources adds beyond what the two histograms count for it
    beyond = lambda p, z, q, y: F.sum(F.expr(f"{_gap(p, q)} - {_gap(p, y)} - {_gap(z, q)} + {_gap(z, y)}"))
    both = both.groupBy("lang", "a", "b").agg(beyond("pa", "za", "pb", "zb").alias("ab"), beyond("pb", "zb", "pa", "za").alias("ba"))
    both = both.selectExpr("lang", "a AS source", "b AS item", "ab AS value").unionByName(both.selectExpr("lang", "b AS source", "a AS item", "ba AS value"))
    levels = cut_lineage(shares.groupBy("lang", "source", "p", "zero").agg(F.count("*").alias("terms")))
    others = known.select("lang", F.col("source").alias("other"), F.col("zero").alias("y"))
    met = levels.join(others, "lang").filter("source <> other")
    own = met.groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum(F.expr(f"terms * ({_gap('p', 'y')} - {_gap('zero', 'y')})")).alias("value"))
    theirs = met.groupBy("lang", F.col("other").alias("source"), F.col("source").alias("item"))
    theirs = theirs.agg(F.sum(F.expr(f"terms * ({_gap('y', 'p')} - {_gap('y', 'zero')})")).alias("value"))
    zeros = known.select("lang", "source", "V", F.col("zero").alias("z")).join(others, "lang").filter("source <> other")
    zeros = zeros.select("lang", "source", F.col("other").alias("item"), F.expr(f"V * {_gap('z', 'y')}").alias("value"))
    void = sizes.filter("V = 0")
    void = void.select("lang", "source").join(void.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    parts = zeros.unionByName(own).unionByName(theirs).unionByName(both).unionByName(void.withColumn("value", F.lit(0).cast("long")))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")


_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
_P = "(1 + (1000000000 * ({c} + 1)::HUGEINT) // ({n} + V))::HUGEINT"
_F = "(((p - q) * (p - q)) // q)"
SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') AS ts
  FROM documents
), t AS (SELECT doc_id, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS m FROM t GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3),
langs AS (SELECT lang, count(*) AS V, sum(m) AS L FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM d),
sizes AS (
  SELECT lang, source, coalesce(sum(c), 0) AS n FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL
),
cells AS (
  SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c, {_P.format(c="coalesce(c.c, 0)", n="s.n")} AS p, {_P.format(c="k.m", n="L")} AS q
  FROM sizes s JOIN langs USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
pairs AS (
  SELECT lang, source, item, sum({_F}) AS value FROM (
    SELECT a.lang, a.source, b.source AS item, a.p, b.p AS q FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  ) GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, b.source, 0 FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM langs)
), all_parts AS (
  SELECT lang, source, 'pair' AS part, item, value::BIGINT AS value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ({_F})::BIGINT FROM cells WHERE c > 0 AND p > q
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM all_parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query("op12_source_divergence", SQL)
def op12_source_divergence(spark, folder):
    """Every source against the other sources of its language, and its most characteristic terms."""
    return audit(documents(spark, folder))
