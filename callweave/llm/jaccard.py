"""N-gram Jaccard join with signature trees.

1. Documents become sets of word shingles; equal sets are one class from then on.
2. The top of the tree is laid out over the cluster: a set's signature holds one value for each range of shingle
   hashes, with more ranges than shingles in which two linked sets can differ, so linked sets share a value.
   Of sets with more ranges than ``MOST_PARTS`` the first ones are used: a linked set shares each with a probability of a
   third or more, so all of them differ with one below 1e-11. Sets that share values, directly or through others,
   form a cell; no link leaves a cell.
3. A cell is cut into blocks by size range and, where it holds many sets, by hash. Inside a block, and between two
   blocks whose sizes allow a link, trees are built whose nodes hold OR-combined token bitmaps and size ranges. A dual traversal prunes pairs of
   nodes by the largest overlap they allow, and pairs that are connected already. What is left is compared exactly.

Only connectivity is asked for, so blocks are first searched inside, then one set of each component found, and pairs of
blocks only where they hold more than one component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import documents
from callweave.llm.components import components
from callweave.llm.registry import query
from callweave.operators import marks
from callweave.session import cut_lineage

#: Sets and shingles of one block.
BLOCK_SETS = 1000
BLOCK_TOKENS = 2_000_000
#: Sets of a leaf, children of a node, bits of a bitmap.
LEAF = 8
FANOUT = 8
MAX_BITS = 1 << 15
#: Ranges of shingle hashes that make up a signature.
MOST_PARTS = 64
#: Words whose hashes a task keeps at hand.
CACHED_WORDS = 500_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _scatter(x: np.ndarray) -> np.ndarray:
    """Invertible 64-bit mix."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str | None, n: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``n``-word shingles; of all words together when there are fewer."""
    words = text.encode().lower().split() if text else []
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(n, len(h))
    if not width:
        return h
    s = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        s = _scatter(s * _MULTIPLIER + h[k : len(h) - width + 1 + k])
    return np.unique(s)


class Threshold:
    """Jaccard similarity of ``percent`` / 100 or more, in whole numbers."""

    def __init__(self, percent: int):
        if not 0 < percent < 100:
            raise ValueError("percent must lie between 0 and 100")
        self.percent = percent
        # sizes from which a new size range starts: a linked set is in the same range or the next one
        self.starts = [1]
        while self.starts[-1] < 1 << 40:
            self.starts.append(self.most_size(self.starts[-1]) + 1)
        self.starts = np.array(self.starts)
        self.known: dict[int, tuple[int, int]] = {}

    def most_size(self, size: int) -> int:
        return size * 100 // self.percent

    def most_difference(self, size: int) -> int:
        """Shingles in which a set of ``size`` and a linked set not smaller than it differ at most."""
        return size * (100 - self.percent) // self.percent

    def least_overlap(self, a, b):
        return -(-self.percent * (a + b) // (100 + self.percent))

    def range_of(self, size: int) -> int:
        return int(np.searchsorted(self.starts, size, side="right")) - 1

    def parts(self, r: int) -> tuple[int, int]:
        """Number of hash ranges for size range ``r``, and how many of them may be empty.

        Linked sets differ in at most ``differ`` ranges. With ``spare`` ranges more than ``differ + 1``, one that both have in
        common holds a shingle, unless more than ``spare`` are empty; so many are added that this is rare.
        """
        least, most = int(self.starts[r]), int(self.starts[r + 1]) - 1
        differ = self.most_difference(most)
        spare = 0
        while differ and spare < 4 * differ + 32:
            n = differ + 1 + spare
            empty = n * (1 - 1 / n) ** least
            if empty + 5 * math.sqrt(empty) <= spare:
                break
            spare += 1 + spare // 8
        return differ + 1 + spare, spare

    def signature(self, s: np.ndarray) -> np.ndarray:
        """Values of the hash ranges, for the set's own size range and the one before it."""
        out = []
        own = self.range_of(len(s))
        for r in (own, own - 1):
            if r < 0:
                continue
            if r not in self.known:
                self.known[r] = self.parts(r)
            parts, spare = self.known[r]
            part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            used = min(parts, MOST_PARTS)
            at = np.searchsorted(part, np.arange(used + 1, dtype=np.uint64))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_scatter(s + _MULTIPLIER), dtype=np.uint64)])
            value = sums[at[1:]] - sums[at[:-1]]
            value = _scatter(value + np.arange(used, dtype=np.uint64) * _MULTIPLIER + np.uint64(r + 1))
            full = at[1:] > at[:-1]
            out.append(value if parts <= MOST_PARTS and used - full.sum() > spare else value[full])
        return np.concatenate(out).view(np.int64)


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(s.tobytes())


def _signatures(n: int, rule: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            sets = [shingle_set(t.as_py(), n, hashes) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([rule.signature(s) if len(s) else None for s in sets], pa.list_(pa.int64())),
                ],
                ["id", "n", "set", "values"],
            )

    return run


def _sets(n: int):
    """(number, shingles) of the rows whose text has the set they were chosen for; a row's id may have other texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            numbers, shingles = [], []
            for text, number, digest in zip(*map(batch.column, ("text", "number", "set")), strict=True):
                s = shingle_set(text.as_py(), n, hashes)
                if len(s) and _digest(s) == digest.as_py():
                    numbers.append(number.as_py())
                    shingles.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(shingles, pa.binary())], ["number", "shingles"])

    return run


class _Node:
    """Sets ``low`` to ``high`` in order of size, their OR-combined bitmap and ranges of size and bits set."""

    def __init__(self, sets: Sets, low: int, high: int, children: list[_Node]):
        self.low, self.high, self.children = low, high, children
        self.bitmap = np.bitwise_or.reduce(sets.bitmaps[low:high])
        self.least, self.most = int(sets.sizes[low]), int(sets.sizes[high - 1])
        self.least_bits = int(sets.bits[low:high].min())


class Sets:
    """Signature tree over the sets of one side of a task."""

    def __init__(self, shingles: list[np.ndarray], labels: list[int], width: int):
        order = sorted(range(len(shingles)), key=lambda i: len(shingles[i]))
        self.shingles = [shingles[i] for i in order]
        self.labels = [labels[i] for i in order]
        self.sizes = np.array([len(s) for s in self.shingles])
        self.bitmaps = np.zeros((len(order), width // 64), np.uint64)
        for i, s in enumerate(self.shingles):
            bit = s & np.uint64(width - 1)
            np.bitwise_or.at(self.bitmaps[i], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        self.bits = np.bitwise_count(self.bitmaps).sum(1, dtype=np.int64)
        level = [_Node(self, i, min(i + LEAF, len(order)), []) for i in range(0, len(order), LEAF)]
        while len(level) > 1:
            level = [_Node(self, level[i].low, level[min(i + FANOUT, len(level)) - 1].high, level[i : i + FANOUT]) for i in range(0, len(level), FANOUT)]
        self.root = level[0]


def _overlap_bound(most: int, least_bits: int, common: int) -> int:
    """A set of ``most`` shingles at most and ``least_bits`` bits at least, of which ``common`` are in the other side's
    bitmap at most, has a shingle of its own for each bit outside it."""
    return most - max(0, least_bits - common)


def traverse(a: Sets, b: Sets, rule: Threshold, roots: list[int]) -> None:
    """Unite in ``roots`` the labels of all sets of ``a`` and ``b`` that link; pairs in one component are skipped."""
    stack = [(a.root, b.root)]
    while stack:
        x, y = stack.pop()
        if a is b and x.low > y.low:
            continue
        if 100 * min(x.most, y.most) < rule.percent * max(x.least, y.least):
            continue
        common = int(np.bitwise_count(x.bitmap & y.bitmap).sum())
        if min(_overlap_bound(x.most, x.least_bits, common), _overlap_bound(y.most, y.least_bits, common)) < rule.least_overlap(x.least, y.least):
            continue
        if x.children or y.children:
            if _one_component(a, x, b, y, roots):
                continue
            stack += [(p, q) for p in x.children or [x] for q in y.children or [y]]
            continue
        common = np.bitwise_count(a.bitmaps[x.low : x.high, None] & b.bitmaps[None, y.low : y.high]).sum(2, dtype=np.int64)
        na, nb = a.sizes[x.low : x.high, None], b.sizes[None, y.low : y.high]
        bound = np.minimum(na - a.bits[x.low : x.high, None] + common, nb - b.bits[None, y.low : y.high] + common)
        for i, j in zip(*np.nonzero(bound >= rule.least_overlap(na, nb)), strict=True):
            i, j = i + x.low, j + y.low
            p, q = find(roots, a.labels[i]), find(roots, b.labels[j])
            if p == q or a is b and i >= j:
                continue
            s, t = a.shingles[i], b.shingles[j]
            if len(s) > len(t):
                s, t = t, s
            at = np.searchsorted(t, s)
            same = int((t[np.minimum(at, len(t) - 1)] == s).sum())
            if 100 * same >= rule.percent * (len(s) + len(t) - same):
                roots[max(p, q)] = min(p, q)


def _one_component(a: Sets, x: _Node, b: Sets, y: _Node, roots: list[int]) -> bool:
    first = find(roots, a.labels[x.low])
    return all(find(roots, a.labels[i]) == first for i in range(x.low, x.high)) and all(find(roots, b.labels[j]) == first for j in range(y.low, y.high))


def find(roots: list[int], i: int) -> int:
    while roots[i] != i:
        roots[i] = roots[roots[i]]
        i = roots[i]
    return i


def _searched(rule: Threshold):
    """Links found in each task: (label, smaller label) of labels that turn out to be connected.

    Rows of a task come one after the other; ``side`` 0 and 1 are compared with each other, ``side`` -1 with itself.
    """

    def links(rows: list[dict]) -> list[tuple]:
        labels = sorted({r["label"] for r in rows})
        if len(labels) < 2:
            return []
        number = {x: i for i, x in enumerate(labels)}
        roots = list(range(len(labels)))
        shingles = {side: [np.frombuffer(r["shingles"], np.uint64) for r in rows if r["side"] == side] for side in (-1, 0, 1)}
        most = max(len(s) for x in shingles.values() for s in x)
        width = min(MAX_BITS, max(64, 1 << math.ceil(math.log2(4 * most))))
        tree = {side: Sets(x, [number[r["label"]] for r in rows if r["side"] == side], width) for side, x in shingles.items() if x}
        if -1 in tree:
            traverse(tree[-1], tree[-1], rule, roots)
        elif len(tree) == 2:
            traverse(tree[0], tree[1], rule, roots)
        return [(x, labels[find(roots, i)]) for i, x in enumerate(labels) if find(roots, i) != i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and held[0]["task"] != row["task"]:
                    out += links(held)
                    held = []
                held.append(row)
            yield _pairs(out)
        yield _pairs(links(held) if held else [])

    return run


def _pairs(links: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])


def _search(tasks: DataFrame, rule: Threshold) -> DataFrame:
    """``tasks``: task, side, label, shingles."""
    rows = tasks.select("task", "side", "label", "shingles").repartition("task").sortWithinPartitions("task")
    return cut_lineage(rows.mapInArrow(_searched(rule), "a long, b long"))


def _blocked(sets: DataFrame, cell: str, rule: Threshold) -> DataFrame:
    """``sets`` with ``range`` and ``sub``: a cell that fits a block has one, others have ranges of sizes cut by hash."""
    total = sets.groupBy(cell).agg(F.count("*").alias("c"), F.sum("n").alias("t"))
    total = total.withColumn("whole", (F.col("c") <= BLOCK_SETS) & (F.col("t") <= BLOCK_TOKENS)).select(cell, "whole")
    sets = sets.join(total, cell)
    # ranges are a little wider than the sizes of linked sets may differ: these are at most one range apart
    step = math.log(100 / rule.percent) * (1 + 1e-9)
    sets = sets.withColumn("range", F.when(F.col("whole"), 0).otherwise(F.floor(F.log("n") / step).cast("int")))
    cut = sets.groupBy(cell, "range").agg(F.count("*").alias("c"), F.sum("n").alias("t"))
    cut = cut.withColumn("subs", F.ceil(F.greatest(F.col("c") / BLOCK_SETS, F.col("t") / BLOCK_TOKENS)).cast("int")).select(cell, "range", "subs")
    return sets.join(cut, [cell, "range"]).withColumn("sub", F.pmod(F.xxhash64("number"), F.when(F.col("whole"), 1).otherwise(F.col("subs"))).cast("int")).drop("whole")


def _task(cell: str, *parts):
    return F.xxhash64(cell, *parts)


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` (the smallest id reachable by links), one row per row of ``docs``.

    Words are runs of other than ASCII white space with A-Z lower-cased; a set holds the distinct shingles of ``words``
    words, or all words as one where there are fewer. Two sets link when 100 times their intersection is ``percent``
    times their union or more; equal texts are linked. Null texts and texts without words have an empty set and link with nothing:
    their component is their own id. Rows with a null id link with nothing and have a null component. Rows of one id
    with several texts are told apart by text; repeated rows all come back. Other columns are left out. Shingles are
    64-bit hashes, sets are told apart by 128 bits. An empty table gives an empty table.
    """
    rule = Threshold(percent)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    signed = cut_lineage(rows.mapInArrow(_signatures(words, rule), f"id {id_type}, n long, set binary, values array<long>"))
    named = signed.filter("id IS NOT NULL AND n > 0")
    classes = named.groupBy("set").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("values").alias("values"))
    classes = cut_lineage(classes.withColumn("number", F.monotonically_increasing_id()))
    # cells: sets that share values of their signatures
    values = classes.select("number", F.explode("values").alias("value"))
    shared = values.groupBy("value").agg(F.count("*").alias("c"), F.min("number").alias("first")).filter("c > 1").select("value", "first")
    # marked and joined: two reads; most values are those of one set
    shared = cut_lineage(shared)
    links = marks.possible(values, shared, "value").join(shared, "value").select(F.col("number").alias("a"), F.col("first").alias("b"))
    cells = components(links).withColumnRenamed("id", "number").withColumnRenamed("component", "cell")
    chosen = cut_lineage(classes.select("number", "set", "id", "n").join(cells, "number"))
    # the shingles of the sets in cells, from the texts again; the chosen ids grow with the corpus, so that they are never
    # broadcast, and the plan is the same at every size; texts of other sets are told by marks and not shuffled
    wanted = marks.possible(rows, chosen, "id").join(chosen.select("id", "number", "set").hint("merge"), "id")
    sets = wanted.select("text", "number", "set").mapInArrow(_sets(words), "number long, shingles binary").dropDuplicates(["number"])
    sets = cut_lineage(_blocked(chosen.drop("set", "id"), "cell", rule).join(sets, "number"))
    # 1. inside blocks
    inside = sets.select(_task("cell", "range", "sub").alias("task"), F.lit(-1).alias("side"), F.col("number").alias("label"), "shingles")
    found = _search(inside, rule)
    # 2. one set of each component of a block, for cells of several blocks
    several = sets.groupBy("cell").agg(F.countDistinct("range", "sub").alias("blocks")).filter("blocks > 1").select("cell")
    split = cut_lineage(_labelled(marks.possible(sets, several, "cell").join(several, "cell", "left_semi"), found))
    if not split.isEmpty():
        first = split.groupBy("cell", "range", "sub", "label").agg(F.min("number").alias("number"))
        heads = split.drop("range", "sub", "subs").join(first.select("number"), "number", "left_semi")
        heads = _blocked(heads, "cell", rule)
        tasks = heads.select(_task("cell", "range", "sub").alias("task"), F.lit(-1).alias("side"), "label", "shingles")
        found = cut_lineage(found.unionByName(_search(tasks, rule)))
        # 3. pairs of blocks that still hold more than one component
        split = cut_lineage(_labelled(split.drop("label"), found))
        blocks = split.groupBy("cell", "range", "sub").agg(F.min("label").alias("least"), F.max("label").alias("most"))
        other = blocks.select("cell", *[F.col(c).alias(f"o_{c}") for c in ("range", "sub", "least", "most")])
        near = (F.col("o_range") == F.col("range")) & (F.col("o_sub") > F.col("sub")) | (F.col("o_range") == F.col("range") + 1)
        pairs = blocks.join(other, "cell").filter(near & ((F.col("least") != F.col("o_least")) | (F.col("most") != F.col("o_most")) | (F.col("least") != F.col("most"))))
        pairs = pairs.withColumn("task", _task("cell", "range", "sub", "o_range", "o_sub"))
        sides = pairs.select("cell", "range", "sub", "task", F.lit(0).alias("side")).unionByName(
            pairs.select("cell", F.col("o_range").alias("range"), F.col("o_sub").alias("sub"), "task", F.lit(1).alias("side"))
        )
        found = found.unionByName(_search(split.join(sides, ["cell", "range", "sub"]), rule))
    linked = components(found).select(F.col("id").alias("number"), "component")
    classes = classes.select("set", "id", "number").join(linked, "number", "left")
    classes = classes.withColumn("component", F.coalesce("component", "number"))
    least = classes.groupBy("component").agg(F.min("id").alias("component_id"))
    named_classes = classes.join(least, "component").select("set", "component_id")
    out = signed.select("id", "n", "set").join(named_classes, "set", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _labelled(sets: DataFrame, found: DataFrame) -> DataFrame:
    """``sets`` with ``label``, the component of what has been found so far."""
    linked = components(found).select(F.col("id").alias("number"), F.col("component").alias("label"))
    return sets.join(linked, "number", "left").withColumn("label", F.coalesce("label", "number"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents whose component holds a smaller id. Rows of one id stay or go together; rows with a null id stay."""
    found = similar_sets(docs, id_col, text_col, words, percent)
    gone = found.groupBy(id_col).agg(F.min("component_id").alias("_c")).filter(F.col("_c") < F.col(id_col)).select(id_col)
    # marked and joined: two reads of a few ids; documents that cannot go are not shuffled
    gone = cut_lineage(gone)
    key = marks.hash_of(F.col(f"`{id_col}`"))
    may_go = marks.marked(gone.select(key.alias("_hash")), gone)(key)
    kept = docs.filter(~may_go).unionByName(docs.filter(may_go).join(gone, id_col, "left_anti"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w
), e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
l AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), both_ways AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT y, root FROM r JOIN both_ways ON x = doc_id)
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id FROM s JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1) USING (doc_id)
"""


@query("op2_ngram_join", SQL)
def op2_ngram_join(spark, folder):
    """Shingle counts and components of all documents."""
    return similar_sets(documents(spark, folder), words=3, percent=90)
