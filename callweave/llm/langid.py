"""Language ID by prediction by partial matching.

One byte context tree per language: counts of the byte after every context of 0 to ``ORDER`` bytes. A byte's
probability in a context is its share there, or the escape probability of the context times its probability in the
next shorter one; below the empty context all bytes are alike. The statistics are frozen after training, so the
recursion is worked out once per context, and a text's exact code length in a language is a sum of table look-ups. The
language with the shortest code wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.llm.common import documents, slices
from callweave.llm.registry import query

#: Longest context in bytes.
ORDER = 3
#: Bound of the training sample: labelled rows of each language, those with the smallest hashed ids.
ROWS_PER_LANGUAGE = 1000
#: Bounds of a table of all code lengths: contexts of the greatest length, and cells (4 bytes each, in every task). What does
#: not fit is kept in sparse tables, see :class:`Sparse`.
MAX_CONTEXTS = 40_000
MAX_CELLS = 1 << 27
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the ``ORDER + 1`` byte strings of each batch, by language; a text starts after newlines."""
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            own = [t.encode() for t, x in zip(texts, langs, strict=True) if x == lang]
            grams, counts = [], []
            for text in own:
                data = np.frombuffer(b"\n" * ORDER + text, np.uint8).astype(np.int64)
                g = data[ORDER:].copy()
                for k in range(1, ORDER + 1):
                    g += data[ORDER - k : len(data) - k] << (8 * k)
                g, n = np.unique(g, return_counts=True)
                grams.append(g)
                counts.append(n)
            if grams:
                g, at = np.unique(np.concatenate(grams), return_inverse=True)
                n = np.bincount(at, np.concatenate(counts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], ["lang", "gram", "n"])


class Model:
    """Frozen code lengths: ``bits[row of context, byte, language]``."""

    def __init__(self, langs: list[str], rows: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        used = [(g >> (8 * k)) & 255 for g, _ in rows.values() for k in range(ORDER + 1)]
        alphabet = np.unique(np.concatenate([[10], *used])).astype(np.int64)
        self.size = len(alphabet) + 1  # the last symbol stands for all bytes never seen
        self.symbol = np.full(256, len(alphabet), np.int64)
        self.symbol[alphabet] = np.arange(len(alphabet))
        unseen = 256 - len(alphabet)
        counts = {}  # (language, context length) -> dense or sparse count rows
        for lang, (gram, n) in rows.items():
            codes = [self.symbol[(gram >> (8 * k)) & 255] for k in range(ORDER + 1)]
            context = np.zeros(len(gram), np.int64)
            counts[lang, 0] = (context, codes[0], n)
            for k in range(1, ORDER + 1):
                context = context + codes[k] * self.size ** (k - 1)
                counts[lang, k] = (context, codes[0], n)
        # contexts of the greatest length that any language has, the most frequent when there are too many
        longest = np.concatenate([counts[x, ORDER][0] for x in langs]) if langs else np.zeros(0, np.int64)
        weight = np.concatenate([counts[x, ORDER][2] for x in langs]) if langs else np.zeros(0, np.int64)
        found, at = np.unique(longest, return_inverse=True)
        total = np.bincount(at, weight, len(found)) if len(found) else np.zeros(0)
        shorter = self.size ** (ORDER - 1)  # contexts one byte shorter have a row each
        room = MAX_CELLS // (self.size * max(len(langs), 1)) - shorter
        if room < 0:
            raise ValueError(f"{len(langs)} languages over {self.size} bytes need more than {MAX_CELLS} cells")
        self.contexts = np.sort(found[np.argsort(-total, kind="stable")[: min(MAX_CONTEXTS, room)]])
        self.bits = np.empty((len(self.contexts) + shorter, self.size, len(langs)), np.float32)
        for j, lang in enumerate(langs):
            p = np.full((1, self.size), 1 / 256)
            p[0, -1] = max(unseen, 1) / 256
            for k in range(ORDER):
                p = _mixed(np.tile(p, (self.size if k else 1, 1)), *counts[lang, k])
            # a context's number is that of its shorter one plus a multiple, so the shorter one is a remainder
            last = _mixed(p[self.contexts % shorter], *self._known(*counts[lang, ORDER]))
            self.bits[: len(last), :, j] = -np.log2(last)
            self.bits[len(last) :, :, j] = -np.log2(p)

    def _known(self, context, symbol, n):
        at = np.minimum(np.searchsorted(self.contexts, context), len(self.contexts) - 1)
        ok = self.contexts[at] == context
        return at[ok], symbol[ok], n[ok]

    def index(self) -> np.ndarray:
        """Row of ``bits`` for every context; those without a row of their own use the shorter context's."""
        shorter = self.size ** (ORDER - 1)
        rows = np.tile(np.arange(shorter, dtype=np.int32) + len(self.contexts), self.size)
        rows[self.contexts] = np.arange(len(self.contexts), dtype=np.int32)
        return rows


def _mixed(shorter: np.ndarray, context, symbol, n) -> np.ndarray:
    """Probabilities in contexts out of those in the next shorter contexts: a context seen n times with d bytes
    escapes with d / (n + d)."""
    seen = np.zeros(shorter.shape)
    np.add.at(seen, (context, symbol), n)
    total, distinct = seen.sum(1, keepdims=True), (seen > 0).sum(1, keepdims=True)
    mass = np.maximum(total + distinct, 1)
    return np.where(total > 0, seen / mass + distinct / mass * shorter, shorter)


class Sparse:
    """Frozen code lengths of the byte strings that each language has seen, and of the escapes from its contexts.

    A string unseen in a context costs the escape from it, if the language has seen the context, and its code length in the
    next shorter one. All strings and contexts are kept, so the size follows the sample.
    """

    def __init__(self, langs: list[str], rows: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = langs
        used = np.unique(np.concatenate([[10], *[(g >> (8 * k)) & 255 for g, _ in rows.values() for k in range(ORDER + 1)]]))
        self.unseen = np.ones(256, bool)
        self.unseen[used.astype(np.int64)] = False
        # all bytes never seen are one symbol, as in a table of all code lengths
        self.lowest = np.where(self.unseen, np.log2(256 / max(self.unseen.sum(), 1)), 8.0)
        self.levels = [self._levels(*rows[x]) for x in langs]

    def _levels(self, gram, n):
        """Of every context length: seen strings and their bits, seen contexts and the bits of their escapes."""
        made = []
        for k in range(ORDER + 1):
            own, at = np.unique(gram & ((1 << 8 * (k + 1)) - 1), return_inverse=True)
            count = np.bincount(at, n, len(own))
            contexts, of = np.unique(own >> 8, return_inverse=True)
            total, distinct = np.bincount(of, count, len(contexts)), np.bincount(of, minlength=len(contexts))
            escape = distinct / (total + distinct)
            shorter = np.exp2(-self._bits(own & ((1 << 8 * k) - 1) if k else own, made))
            seen = count / (total + distinct)[of] + escape[of] * shorter
            # strings are (context, byte) with the byte lowest
            made.append((own, -np.log2(seen), contexts, -np.log2(escape)))
        return made

    def _bits(self, gram, levels):
        """Bits of the last byte of each string after the ones before it."""
        bits = self.lowest[gram & 255]
        for k, (own, seen, contexts, escape) in enumerate(levels):
            at_own, known = _found(own, gram & ((1 << 8 * (k + 1)) - 1))
            at_context, met = _found(contexts, (gram >> 8) & ((1 << 8 * k) - 1))
            bits = np.where(known, seen[at_own], np.where(met, escape[at_context], 0.0) + bits)
        return bits

    def index(self) -> None:
        """There is no table of all contexts."""

    def lengths(self, data: bytes, chunk: int) -> np.ndarray:
        """Bits of ``data`` under each language."""
        total = np.zeros(len(self.langs))
        codes = np.frombuffer(b"\n" * ORDER + data, np.uint8).astype(np.int64)
        for start in range(0, len(codes) - ORDER, chunk):
            part = codes[start : start + chunk + ORDER]
            gram = sum(part[ORDER - k : len(part) - k] << (8 * k) for k in range(ORDER + 1))
            gram, n = np.unique(gram, return_counts=True)
            for j, levels in enumerate(self.levels):
                total[j] += self._bits(gram, levels) @ n
        return total


def _found(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted values in a sorted table that is not empty, and whether they are there."""
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def frozen(langs: list[str], rows: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model | Sparse:
    """A table of all code lengths where every context fits in, otherwise sparse tables; both give the same code lengths."""
    used = [(g >> (8 * k)) & 255 for g, _ in rows.values() for k in range(ORDER + 1)]
    size = len(np.unique(np.concatenate([[10], *used]))) + 1
    contexts = len(np.unique(np.concatenate([np.unique(g >> 8) for g, _ in rows.values()]))) if rows else 0
    fits = contexts <= MAX_CONTEXTS and (contexts + size ** (ORDER - 1)) * size * max(len(langs), 1) <= MAX_CELLS
    return Model(langs, rows) if fits else Sparse(langs, rows)


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | Sparse:
    """Model from labelled ``rows``: of each language the ``rows_per_language`` rows with the smallest ``key``.

    Rows with a null text or language are left out. Counting runs on the executors; the driver gets the counts
    of distinct byte strings, whose number the sample bounds. No context and no language is left out.
    """
    key = F.xxhash64(F.col(f"`{text_col}`")) if key is None else key
    known = rows.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"), key.alias("key"))
    known = known.filter("text IS NOT NULL AND lang IS NOT NULL")
    # keys alone tell which rows are the first ones; of equal keys at the limit, the second window takes as many as fit
    first = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    limits = known.select("lang", "key").withColumn("at", first).filter(F.col("at") <= rows_per_language)
    limits = limits.groupBy("lang").agg(F.max("key").alias("limit"))
    # one row a language
    limits = F.broadcast(limits)
    sample = known.join(limits, "lang").filter("key <= limit").withColumn("at", first).filter(F.col("at") <= rows_per_language)
    # spread again: a language's sample came together in one task
    counts = sample.select("text", "lang").repartition(8 * ORDER).mapInArrow(_count_batches, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    return frozen(langs, {x: (g["gram"].to_numpy(), g["n"].to_numpy()) for x, g in counts.groupby("lang")})


def code_lengths(data: bytes, model: Model | Sparse, index: np.ndarray | None, chunk: int = 1 << 18) -> np.ndarray:
    """Bits of ``data`` under each language; long texts go through in pieces that share their context."""
    if isinstance(model, Sparse):
        return model.lengths(data, chunk)
    total = np.zeros(len(model.langs))
    codes = model.symbol[np.frombuffer(b"\n" * ORDER + data, np.uint8)]
    for start in range(0, len(codes) - ORDER, chunk):
        part = codes[start : start + chunk + ORDER]
        n = len(part) - ORDER
        context = np.zeros(n, np.int64)
        for k in range(1, ORDER + 1):
            context += part[ORDER - k : ORDER - k + n] * model.size ** (k - 1)
        cells = index[context].astype(np.int64) * model.size + part[ORDER:]
        total += model.bits.reshape(-1, len(model.langs)).take(cells, axis=0).sum(0, dtype=np.float64)
    return total


def predict(docs: DataFrame, model: Model | Sparse, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the best language when code lengths are probabilities.

    Null texts and texts without a letter, and all texts under a model without languages, are ``und`` with score 0.
    Equal code lengths go to the first language by name. Whole texts count, whatever their length. Other columns pass;
    input columns named ``lang_pred`` or ``score`` are replaced. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add("lang_pred", "string").add("score", "double")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        index = known.index()
        for batch in slices(batches):
            best, share = [], []
            for text in batch.column(kept.index(text_col)):
                text = text.as_py()
                if not known.langs or text is None or not _LETTER.search(text):
                    best.append(UNKNOWN)
                    share.append(0.0)
                    continue
                bits = code_lengths(text.encode(), known, index)
                at = int(bits.argmin())
                best.append(known.langs[at])
                share.append(float(1 / np.exp2(np.minimum(bits.min() - bits, 0)).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(share, pa.float64())], names=[*kept, "lang_pred", "score"])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(score, schema)


def fold(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(f"`{id_col}`").cast("string")) % 4


def model_of(docs: DataFrame) -> Model | Sparse:
    """Model of the documents outside the held-out fold."""
    known = docs.filter(F.coalesce(fold() != 2, F.lit(True))).select("doc_id", "text", "lang")
    return train(known, key=F.xxhash64("doc_id"))


def keep_known(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """Documents whose language is told with a score of ``min_score`` or more; ``und`` goes."""
    plain = docs.columns
    told = predict(docs, model_of(docs))
    return told.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(*[F.col(f"`{c}`") for c in plain])


@query("op10_language_id")
def op10_language_id(spark, folder):
    """Language of every document, learnt from the other folds."""
    docs = documents(spark, folder)
    told = predict(docs.select("doc_id", "text"), model_of(docs))
    return told.select("doc_id", (fold() == 2).alias("held_out"), "lang_pred", "score")
