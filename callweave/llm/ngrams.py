"""Language model of words: interpolated modified Kneser-Ney, counted in Spark, kept as sorted hash arrays, and mapped into
memory by the workers that score texts.

Training. Tasks hash the words of their texts and count n-grams stretch by stretch. An n-gram is known by the pair of its first and
its last n - 1 words, so rows are (prefix, suffix, count) of 64-bit hashes. They are dealt by the leading bits of
their hash into parts of bounded size; no n-gram is hot, as each stretch has added up its own. A part is added up, sorted and written
as one file below the shared folder. From the same rows come what the next shorter order needs: of each prefix how many
words follow it and how often (once, twice, more), of each suffix how many words come before it.

Scoring. A worker maps the files it needs and finds the distinct n-grams of a stretch of text by binary search; the pages
are shared by the workers of a machine and belong to its file cache. A task writes a file under a name of its own and
returns the name, so a task that runs twice does no harm, and files outlive the executors that wrote them.
"""

from __future__ import annotations

import os
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import documents, release, slices
from callweave.llm.registry import query
from callweave.llm.tokens import Hashes, mix, tokens
from callweave.session import cut_lineage, scratch_path

#: Order of the query's model.
ORDER = 2
#: Words counted at a time.
STRETCH = 1 << 22
#: Bytes of training text for each part of an order's table.
PART_BYTES = 1 << 25
#: Files a worker keeps mapped; the one not used for longest goes first.
OPEN_FILES = 200

#: Bytes of words: all but ASCII white space.
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[32, 9, 10, 11, 12, 13]] = False
#: Hashes of the mark before the first word, which is never predicted, and of the end, which is.
START, END = mix(np.array([0x5354415254, 0x454E44], np.uint64))

_ROW = "key long, x long, y long, raw long, start long, cont long, total long, o1 long, o2 long, o3 long"
_SUMS = ["raw", "start", "cont", "total", "o1", "o2", "o3"]

# fixed values of the public hash function xxHash64
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def pair_hash(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``xxhash64(x, y)`` of two columns of longs, as Spark has it."""
    out = np.full(len(x), 42, np.uint64)
    for value in (x, y):
        out = (out + _P5 + np.uint64(8)) ^ (_turned(value * _P2, 31) * _P1)
        out = _turned(out, 27) * _P1 + _P4
        out = (out ^ (out >> np.uint64(33))) * _P2
        out = (out ^ (out >> np.uint64(29))) * _P3
        out = out ^ (out >> np.uint64(32))
    return out


def sequences(column: pa.Array, hashes: Hashes, order: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(hashes, rows, lead) of the texts in a column, piece by piece: for each text the start mark, its words and the end.

    The first ``lead`` entries repeat the end of the piece before, as context.
    """
    rows, begun = len(column), -1
    tail, tail_row = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def pieces():
        for found in tokens(column, WORD_BYTES):
            if len(found.start):
                yield hashes.of(found), found.row, False
        if rows:
            yield np.zeros(0, np.uint64), np.zeros(0, np.int64), True

    for words, row, last in pieces():
        low, high = max(begun, 0), rows - 1 if last else int(row[-1])
        count = np.bincount(row - low, minlength=high - low + 1)
        # the first row may have begun in an earlier piece, the last one goes on unless there are no more pieces
        starts, ends = np.ones(len(count), np.int64), np.ones(len(count), np.int64)
        starts[0], ends[-1] = begun < 0, last
        length = starts + count + ends
        offset = np.cumsum(length) - length
        own = np.repeat(np.arange(low, high + 1), length)
        seq = np.full(len(own), END)
        seq[offset[starts > 0]] = START
        seq[(offset + starts - (np.cumsum(count) - count))[row - low] + np.arange(len(row))] = words
        begun, lead = high, len(tail)
        seq, own = np.concatenate([tail, seq]), np.concatenate([tail_row, own])
        tail, tail_row = seq[max(len(seq) - order + 1, 0) :], own[max(len(own) - order + 1, 0) :]
        yield seq, own, lead


def grams(seq: np.ndarray, row: np.ndarray, order: int):
    """For each order up to ``order``: hash of the n-gram that ends at each place, and whether its text holds it."""
    keys, inside = [seq], [np.ones(len(seq), bool)]
    for k in range(2, order + 1):
        key, ok = np.zeros(len(seq), np.uint64), np.zeros(len(seq), bool)
        key[1:] = pair_hash(keys[-1][:-1], keys[-1][1:])
        ok[k - 1 :] = row[k - 1 :] == row[: len(row) - k + 1]
        keys.append(key)
        inside.append(ok)
    return keys, inside


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _counted(level: int, order: int):
    """Rows (x, y, n, start) of the n-grams of one order, added up over stretches."""

    def flushed(parts) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        key, x, y, first = (np.concatenate(p) for p in zip(*parts))
        parts.clear()
        _, at, n = np.unique(key, return_index=True, return_counts=True)
        del key
        # rows of one prefix side by side take less room in the shuffle
        by = np.argsort(x[at])
        at, n = at[by], n[by]
        for s in range(0, len(at), 1 << 16):
            cut = at[s : s + (1 << 16)]
            columns = [_signed(x[cut]), _signed(y[cut]), pa.array(n[s : s + (1 << 16)].astype(np.int64)), pa.array(first[cut].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "y", "n", "start"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, parts, size = Hashes(13), [], 0
        for batch in batches:
            for seq, row, lead in sequences(batch.column(0), hashes, order):
                keys, inside = grams(seq, row, level)
                ok = inside[-1] & (seq != START)
                ok[:lead] = False
                at = np.flatnonzero(ok)
                first = seq[at - level + 1] == START
                parts.append((keys[-1][at], keys[-2][at - 1], keys[-2][at], first))
                size += len(at)
                if size >= STRETCH:
                    yield from flushed(parts)
                    size = 0
        yield from flushed(parts)

    return count


def local_folder(path: str) -> str:
    """The path that this machine's file system knows; files to be mapped have to be there."""
    told = urlparse(path)
    if told.scheme not in ("", "file"):
        raise ValueError(f"the model is mapped into memory: mount the shared folder {path} and name it by its file path")
    return told.path


def _reduced(level: int, order: int, folder: str):
    """Adds up the rows of one part, writes its arrays, and returns what the next shorter order needs, and a row about the file."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: dict[str, list] = {}
        for batch in batches:
            for name, column in zip(batch.schema.names, batch.columns):
                columns.setdefault(name, []).append(pc.fill_null(column, 0).to_numpy(zero_copy_only=False))
        if not columns:
            return
        part = int(columns.pop("part")[0][0])
        all_ = {name: np.concatenate(c) for name, c in columns.items()}
        columns.clear()
        x, y = (all_[c].view(np.uint64) if c in all_ else None for c in ("x", "y"))
        key = all_["key"].view(np.uint64) if "key" in all_ else pair_hash(x, y)
        by = np.argsort(key)
        key = key[by]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sums = {c: np.add.reduceat(all_[c][by], at) if c in all_ else np.zeros(len(at), np.int64) for c in _SUMS}
        key = key[at]
        adjusted = sums["raw"] if level == order else np.where(sums["start"] > 0, sums["raw"], sums["cont"])
        raw, values = sums["raw"], np.stack([sums["raw"], adjusted, *[sums[c] for c in ("total", "o1", "o2", "o3")]], axis=1)
        path = f"{folder}/{level}-{part}-{uuid.uuid4().hex}"
        facts = [len(key), *_write(path, key, adjusted if level == order else values, level == order)]
        facts += [int((adjusted == k).sum()) for k in (1, 2, 3, 4)] + [int(adjusted.sum()), int(raw.sum()), int((raw > 0).sum())]
        if level > 1:
            # zeros stand for missing prefixes and suffixes; the greater one is the one that is there
            x, y = (np.maximum.reduceat(v[by], at) for v in (x, y))
            yield from _shorter(x, y, adjusted, raw if level == 2 else raw * 0)
        names = [*[f.split()[0] for f in _ROW.split(", ")], "part", "path", "facts"]
        empty = [pa.nulls(1, pa.int64())] * (len(names) - 3)
        yield pa.RecordBatch.from_arrays([*empty, pa.array([part], pa.int32()), pa.array([path]), pa.array([facts], pa.list_(pa.int64()))], names=names)

    return reduce


def _shorter(x, y, adjusted, raw) -> Iterator[pa.RecordBatch]:
    """Rows of the next shorter order: prefixes with what follows them, suffixes with what is before them."""
    key, of = np.unique(np.concatenate([x, y]), return_inverse=True)
    add = lambda left, right: np.bincount(of, np.concatenate([left, right]), len(key)).astype(np.int64)
    no, one = np.zeros(len(x)), np.ones(len(x))
    found = {
        "raw": add(no, raw), "cont": add(no, one), "total": add(adjusted, no),
        "o1": add(adjusted == 1, no), "o2": add(adjusted == 2, no), "o3": add(adjusted > 2, no),
    }
    names = [f.split()[0] for f in _ROW.split(", ")]
    for s in range(0, len(key), 1 << 16):
        n = len(key[s : s + (1 << 16)])
        columns = [_signed(key[s : s + n]) if c == "key" else pa.array(found[c][s : s + n]) if c in found else pa.nulls(n, pa.int64()) for c in names]
        extra = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.string()), pa.nulls(n, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*columns, *extra], names=[*names, "part", "path", "facts"])


def _write(path: str, key: np.ndarray, values: np.ndarray, counts: bool) -> tuple[int, int]:
    """One file: sorted keys, then values. Counts of the longest n-grams take a byte, those of 255 or more are listed
    before them; other values take four or eight bytes. Returns the length of that list, and the bytes of a value."""
    with open(path, "wb") as out:
        out.write(key.tobytes())
        if counts:
            big = np.flatnonzero(values >= 255)
            out.write(key[big].tobytes() + values[big].astype(np.uint64).tobytes())
            out.write(np.minimum(values, 255).astype(np.uint8).tobytes())
            return len(big), 1
        width = 4 if values.max() < 1 << 32 else 8
        out.write(values.astype(f"u{width}").tobytes())
        out.flush()
        os.fsync(out.fileno())
        return 0, width


@dataclass
class Level:
    """Table of one order: leading bits of a hash that name its part, and (path, rows, listed, bytes of a value) by part."""

    bits: int
    parts: dict[int, tuple[str, int, int, int]]
    discounts: np.ndarray


@dataclass
class Model:
    """Tables from words up to the longest n-grams; tokens, distinct tokens, distinct pairs of a token and the one before it, and
    what the discounts take off these pairs."""

    order: int
    levels: list[Level]
    n: int
    v: int
    pairs: int
    taken: float


def discounts(t1: int, t2: int, t3: int, t4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2, and 3 or more, out of how many n-grams have count 1 to 4.

    Where these counts are too few to tell (a zero, or a discount outside 0 to the count), 0.5, 1 and 1.5 are taken.
    """
    plain = np.array([0.0, 0.5, 1.0, 1.5])
    if min(t1, t2, t3, t4) <= 0:
        return plain
    y = t1 / (t1 + 2 * t2)
    out = np.array([0.0, 1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2, 3 - 4 * y * t4 / t3])
    return out if ((out >= 0) & (out <= [0, 1, 2, 3])).all() else plain


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER) -> Model:
    """Model of order 2 or more of all texts of ``docs``; null and empty texts are one end each.

    Words are runs of other than ASCII white space with A-Z lower-cased. All words and n-grams are kept. Repeated rows count
    as often as they come. Without rows every table is empty, and each token has probability 1.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    folder = scratch_path(spark, "ngrams")
    place = local_folder(folder)
    os.makedirs(place, exist_ok=True)
    size = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    bits = max(1, (((size[0] or 0) + size[1]) // PART_BYTES).bit_length())
    part = lambda key: F.shiftrightunsigned(key, 64 - bits).cast("int")
    levels, shorter = [], None
    for k in range(order, 0, -1):
        if k > 1:
            rows = texts.mapInArrow(_counted(k, order), "x long, y long, n long, start long")
        if k == order:
            rows = rows.select("x", "y", F.col("n").alias("raw")).repartitionById(1 << bits, part(F.xxhash64("x", "y")))
            rows = rows.withColumn("part", part(F.xxhash64("x", "y")))
        else:
            if k > 1:
                rows = rows.select(F.xxhash64("x", "y").alias("key"), "x", "y", F.col("n").alias("raw"), "start")
                rows = rows.unionByName(shorter, allowMissingColumns=True)
            else:
                rows = shorter
            rows = rows.repartitionById(1 << bits, part(F.col("key"))).withColumn("part", part(F.col("key")))
        out = cut_lineage(rows.mapInArrow(_reduced(k, order, place), f"{_ROW}, part int, path string, facts array<long>"))
        # the longest n-grams' rows are the largest shuffle, and nothing reads them any more
        del rows
        release(spark)
        # a row for each file
        files = out.filter("path IS NOT NULL").select("part", "path", "facts").collect()
        shorter = out.filter("path IS NULL").drop("part", "path", "facts")
        total = np.sum([f["facts"][3:] for f in files], axis=0, dtype=object) if files else [0] * 7
        known = discounts(*total[:4])
        levels.insert(0, Level(bits, {f["part"]: (f["path"], *f["facts"][:3]) for f in files}, known))
    n, v, pairs = (int(total[i]) for i in (5, 6, 4))
    taken = levels[0].discounts[1:] @ [int(total[0]), int(total[1]), v - int(total[0]) - int(total[1])]
    return Model(order, levels, n, v, pairs, float(taken))


class _Tables:
    """The model's files as this worker sees them."""

    def __init__(self, model: Model):
        self.model, self.open = model, OrderedDict()

    def _mapped(self, level: int, part: int):
        if (level, part) in self.open:
            self.open.move_to_end((level, part))
            return self.open[level, part]
        path, rows, listed, width = self.model.levels[level].parts[part]
        data = np.memmap(path, np.uint8, "r")
        key, at = data[: 8 * rows].view(np.uint64), 8 * rows
        if width == 1:
            made = key, data[at : at + 8 * listed].view(np.uint64), data[at + 8 * listed : at + 16 * listed].view(np.uint64), data[at + 16 * listed :]
        else:
            made = key, data[at:].view(f"u{width}").reshape(rows, 6)
        self.open[level, part] = made
        if len(self.open) > OPEN_FILES:
            self.open.popitem(last=False)
        return made

    def find(self, level: int, keys: np.ndarray) -> np.ndarray:
        """Values of the n-grams of order ``level + 1``: counts of the longest, six columns of the others; 0 where unknown."""
        distinct, of = np.unique(keys, return_inverse=True)
        longest = level + 1 == self.model.order
        out = np.zeros(len(distinct) if longest else (len(distinct), 6), np.int64)
        table = self.model.levels[level]
        if len(distinct):
            parts = distinct >> np.uint64(64 - table.bits)
            for s, e in zip(heads := np.flatnonzero(np.append(True, parts[1:] != parts[:-1])), np.append(heads[1:], len(distinct))):
                if int(parts[s]) in table.parts:
                    self._look(level, int(parts[s]), distinct[s:e], out[s:e])
        return out[of]

    def _look(self, level: int, part: int, wanted: np.ndarray, out: np.ndarray) -> None:
        key, *values = self._mapped(level, part)
        at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        ok = key[at] == wanted
        if len(values) == 1:
            out[ok] = values[0][at[ok]]
            return
        listed, counts, small = values
        out[ok] = small[at[ok]]
        big = np.flatnonzero(out == 255)
        out[big] = counts[np.searchsorted(listed, wanted[big])]

    def probabilities(self, keys: list[np.ndarray], inside: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Of each place how often its token was seen in training, and its probability after the tokens before it."""
        model = self.model
        words = context = self.find(0, keys[0])
        # what is taken off all counts goes to every token alike, one unknown token among them
        p = np.full(len(words), 1 / (model.v + 1))
        if model.pairs:
            p = (words[:, 1] - model.levels[0].discounts[np.minimum(words[:, 1], 3)] + model.taken * p) / model.pairs
        for k in range(2, model.order + 1):
            d = model.levels[k - 1].discounts
            found = self.find(k - 1, keys[k - 1])
            n = (found if k == model.order else found[:, 1])[1:]
            # the context of a place is the shorter n-gram that ends one place before
            total, left = context[:-1, 2], context[:-1, 3:] @ d[1:]
            longer = (n - d[np.minimum(n, 3)] + left * p[1:]) / np.maximum(total, 1)
            p[1:] = np.where(inside[k - 1][1:] & (total > 0), longer, p[1:])
            context = found
        return words[:, 0], p


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` (words and the end), ``n_known`` (those seen in training), ``base_score`` (log10 probability by
    single tokens, add one), ``score`` (log10 probability by the model) and ``perplexity`` (10 to the minus mean score).

    Whole texts count. A null or empty text is one end. Unknown words share one probability. Repeated rows all come back,
    other columns pass, and input columns of the new names are replaced. An empty table gives an empty table.
    """
    added = [("n_tokens", T.LongType()), ("n_known", T.LongType()), *[(c, T.DoubleType()) for c in ("base_score", "score", "perplexity")]]
    names = [c for c, _ in added]
    kept = [c for c in docs.columns if c not in names]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, t) for c, t in added]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, tables = Hashes(13), _Tables(shared.value)
        known = shared.value
        for batch in slices(batches, 4096):
            size = batch.num_rows
            sums = np.zeros((4, size))
            for seq, row, lead in sequences(batch.column(kept.index(text_col)), hashes, known.order):
                seen, p = tables.probabilities(*grams(seq, row, known.order))
                ok = seq != START
                ok[:lead] = False
                row, seen = row[ok], seen[ok]
                base = np.log10((seen + 1) / (known.n + known.v + 1))
                for i, weight in enumerate((None, seen > 0, base, np.log10(p[ok]))):
                    sums[i] += np.bincount(row, weight, size)
            counts = [pa.array(sums[i].astype(np.int64)) for i in (0, 1)]
            perplexity = 10 ** (-sums[3] / np.maximum(sums[0], 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts, pa.array(sums[2]), pa.array(sums[3]), pa.array(perplexity)], names=[*kept, *names])

    return rows.mapInArrow(run, schema)


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % 7


@query("op13_lm_scoring")
def op13_lm_scoring(spark, folder):
    """Every document's log probability, learnt from six of seven folds."""
    docs = documents(spark, folder).select("doc_id", "text")
    model = train(docs.filter(F.coalesce(fold() != 2, F.lit(True))))
    return score(docs, model).select(
        "doc_id",
        F.coalesce(fold() == 2, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
