"""SentencePiece encoding and decoding.

A text is cut into words where the white-space mark starts, and words into chunks where two characters meet that no piece
holds side by side, so that no piece can cross. Each distinct chunk is looked up in the piece table by its bounded-length
substrings. For unigram models these are the edges of a lattice, and a Viterbi fold takes the path with the best sum of
scores. The scores of byte-pair models are ranks of merges, for which that sum means nothing; there the fold merges
neighbours in the order of the scores, which gives the ids the model was made for.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm.common import documents, slices
from callweave.llm.registry import query

#: Vocabulary file of the registered query; a parameter everywhere else.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Words of one generation whose ids a task keeps at hand.
CACHED_WORDS = 150_000

_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class PieceTable:
    """Pieces of a model: ids and scores by text, byte pieces, and what ids stand for."""

    ids: dict[str, int]
    scores: dict[str, float]
    byte_ids: list[int]
    texts: list[bytes]
    unknown: int
    merges: bool
    prefix: bool
    longest: int = 1  # of a piece, in characters
    beside: frozenset = field(default_factory=frozenset)
    packed: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self):
        self.longest = max(map(len, self.ids), default=1)
        self.beside = frozenset(pair for p in self.ids for pair in zip(p, p[1:]))
        self.packed = {p: np.array([i], "<i4").tobytes() for p, i in self.ids.items()}


def read_table(path: str) -> PieceTable:
    """Piece table of a model file with an identity normaliser. Read once, on the driver; its size is that of the vocabulary."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("models with a normaliser other than identity are not supported")
    ids, scores, texts, byte_ids = {}, {}, [], [-1] * 256
    for i, p in enumerate(model.pieces):
        if spec.is_byte(i):
            value = int(p.piece[3:5], 16)
            byte_ids[value] = i
            texts.append(bytes([value]))
        elif spec.is_control(i):
            texts.append(b"")
        elif spec.is_unknown(i):
            texts.append(" ⁇ ".encode())
        else:
            ids[p.piece], scores[p.piece] = i, p.score
            texts.append(p.piece.replace(MARK, " ").encode())
    return PieceTable(ids, scores, byte_ids, texts, spec.unk_id(), model.trainer_spec.model_type == 2, model.normalizer_spec.add_dummy_prefix)


def lattice(chunk: str, table: PieceTable) -> dict[tuple[int, int], float]:
    """Edges of the chunk: (start, end) of the substrings that are pieces, with their scores."""
    n, most, scores = len(chunk), table.longest, table.scores
    return {(i, j): scores[chunk[i:j]] for i in range(n) for j in range(i + 1, min(i + most, n) + 1) if chunk[i:j] in scores}


#: Characters of the windows in which a long chunk's merges are looked for.
_SHORT = 64


def merge_fold(chunk: str, scores: dict[str, float]) -> list[str]:
    """Parts of the chunk left when neighbours that make up a piece are merged, best score first, then the leftmost."""
    if len(chunk) > _SHORT:
        return _merge_long(chunk, scores)
    parts, look = list(chunk), scores.get
    pairs = [look(a + b, _NONE) for a, b in zip(parts, parts[1:])]
    while pairs:
        best = max(pairs)
        if best == _NONE:
            break
        i = pairs.index(best)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = look(parts[i] + parts[i + 1], _NONE)
        if i:
            pairs[i - 1] = look(parts[i - 1] + parts[i], _NONE)
    return parts


_NONE = float("-inf")


def _merge_long(chunk: str, scores: dict[str, float]) -> list[str]:
    """The same with a heap, for chunks of any length."""
    n = len(chunk)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(-scores[chunk[i : i + 2]], i, i + 1, i + 2) for i in range(n - 1) if chunk[i : i + 2] in scores]
    heapq.heapify(heap)
    while heap:
        _, i, middle, stop = heapq.heappop(heap)
        if not alive[i] or end[i] != middle or end[middle] != stop:
            continue
        end[i], alive[middle] = stop, False
        if stop < n:
            before[stop] = i
            if chunk[i : end[stop]] in scores:
                heapq.heappush(heap, (-scores[chunk[i : end[stop]]], i, stop, end[stop]))
        left = before[i]
        if left >= 0 and chunk[left:stop] in scores:
            heapq.heappush(heap, (-scores[chunk[left:stop]], left, i, stop))
    parts, i = [], 0
    while i < n:
        parts.append(chunk[i : end[i]])
        i = end[i]
    return parts


def viterbi_fold(chunk: str, edges: dict[tuple[int, int], float]) -> list[str]:
    """Parts of the path with the best sum of scores; characters without an edge cost more than any piece. Of equal
    sums the longest last piece wins."""
    n = len(chunk)
    worst = min(edges.values(), default=0.0) - 10.0
    into: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for (i, j), score in sorted(edges.items()):
        into[j].append((i, score))
    best, back = [0.0] + [float("-inf")] * n, [0] * (n + 1)
    for j in range(1, n + 1):
        for i, score in into[j] if any(i == j - 1 for i, _ in into[j]) else [*into[j], (j - 1, worst)]:
            if best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, i
    parts, j = [], n
    while j:
        parts.append(chunk[back[j] : j])
        j = back[j]
    return parts[::-1]


class _Memory(dict):
    """Ids by string as bytes of int32; worked out when missing. Two generations: when the younger is full it becomes the
    older one, so that frequent strings stay and no more than twice ``CACHED_WORDS`` are held."""

    def __init__(self, work):
        super().__init__()
        self.work = work
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(key)
        if ids is None:
            ids = self.work(key)
        self[key] = ids
        return ids


class Encoder:
    """Ids of texts as bytes of int32."""

    def __init__(self, table: PieceTable):
        self.table = table
        self.spaced = _Memory(lambda word: self.word(MARK + word))
        self.plain = _Memory(self.word)
        self.newline = self.chunk("\n") if not any("\n" in p for p in table.ids) else None

    def word(self, word: str) -> bytes:
        beside, start, out = self.table.beside, 0, []
        for i, pair in enumerate(zip(word, word[1:]), 1):
            if pair not in beside:
                out.append(self.chunk(word[start:i]))
                start = i
        return b"".join(out) + self.chunk(word[start:]) if out else self.chunk(word)

    def chunk(self, chunk: str) -> bytes:
        t = self.table
        parts = merge_fold(chunk, t.scores) if t.merges else viterbi_fold(chunk, lattice(chunk, t))
        known, out = t.packed, []
        for part in parts:
            x = known.get(part)
            if x is None:
                raw = [t.byte_ids[b] for b in part.encode()]
                x = np.array(raw if min(raw) >= 0 else [t.unknown], "<i4").tobytes()
            out.append(x)
        return b"".join(out)

    def text(self, text: str) -> np.ndarray:
        """Ids of a text. Words follow single spaces almost always; lines where they do not, or that hold the mark itself,
        are cut where the mark starts."""
        if not text:
            return np.zeros(0, "<i4")
        spaced, plain = self.spaced.__getitem__, self.plain.__getitem__
        out = []
        for n, line in enumerate([text] if self.newline is None else text.split("\n")):
            if n:
                out.append(self.newline)
            words = line.split(" ")
            first = not n and self.table.prefix
            if "" in words or MARK in line:
                out += map(plain, _WORD.findall((MARK if first else "") + line.replace(" ", MARK)))
            elif first:
                out += map(spaced, words)
            else:
                out.append(plain(words[0]))
                out += map(spaced, words[1:])
        return np.frombuffer(b"".join(out), "<i4")


_latest: list[Encoder] = []


def _encoder(table: PieceTable) -> Encoder:
    """The encoder of this Python worker, which goes on to the next task with what it remembers."""
    if not _latest or _latest[0].table != table:
        _latest[:] = [Encoder(table)]
    return _latest[0]


def decode_ids(ids: np.ndarray, table: PieceTable) -> str | None:
    """Text of ``ids``; None if one is not in the table."""
    if len(ids) and (ids.min() < 0 or ids.max() >= len(table.texts)):
        return None
    raw = b"".join(map(table.texts.__getitem__, ids.tolist()))
    text = raw.decode("utf-8", "replace")
    return text[1:] if table.prefix and text.startswith(" ") else text


def encode_words(words: DataFrame, table: PieceTable, word_col: str = "word") -> DataFrame:
    """``word_col`` and ``ids`` of the distinct words of a table: the lattice as relations, for unigram scores.

    Bounded-length substrings are exploded and joined with the piece table, whose size is the vocabulary's; edges are
    grouped by word, and a higher-order aggregate folds them by their ends into the best path. Characters of no piece take
    the unknown piece at a cost above any other. Of equal sums the longest last piece wins. Null words are left out, an empty one has no ids. This is
    the form for a word list; a corpus goes through :func:`encode`, whose words need not meet in a shuffle.
    """
    spark = words.sparkSession
    worst = min(table.scores.values(), default=0.0) - 10.0
    pieces = spark.createDataFrame([(p, i, table.scores[p]) for p, i in table.ids.items()], "piece string, id int, score double")
    word = F.col("word")
    rows = words.select(F.col(f"`{word_col}`").cast("string").alias("word")).filter("word IS NOT NULL").distinct()
    starts = rows.withColumn("start", F.explode(F.when(F.length(word) > 0, F.sequence(F.lit(0), F.length(word) - 1))))
    parts = starts.withColumn("n", F.explode(F.sequence(F.lit(1), F.least(F.lit(table.longest), F.length(word) - F.col("start")))))
    parts = parts.withColumn("piece", F.substring(word, F.col("start") + 1, F.col("n")))
    edges = parts.join(F.broadcast(pieces), "piece", "left").filter("id IS NOT NULL OR n = 1")
    edge = F.struct(
        (F.col("start") + F.col("n")).alias("end"), "start", F.coalesce("id", F.lit(table.unknown)).alias("id"), F.coalesce("score", F.lit(worst)).alias("score"),
    )
    grouped = edges.groupBy("word").agg(F.collect_list(edge).alias("edges"))
    none = F.array().cast("array<int>")
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("n"), none.alias("ids")))

    def step(best, end):
        into = F.filter("edges", lambda e: e["end"] == end)
        reached = lambda e: F.get(best, e["start"])
        paths = F.transform(
            into,
            lambda e: F.struct((reached(e)["score"] + e["score"]).alias("score"), (end - e["start"]).alias("n"), F.concat(reached(e)["ids"], F.array(e["id"])).alias("ids")),
        )
        return F.concat(best, F.array(F.array_max(paths)))

    folded = F.aggregate(F.sequence(F.lit(1), F.length(word)), first, step, lambda best: F.element_at(best, -1)["ids"])
    done = grouped.select("word", folded.alias("ids"))
    return done.unionByName(rows.filter("word = ''").select("word", none.alias("ids"))).withColumnRenamed("word", word_col)


def encode(docs: DataFrame, table: PieceTable, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of the whole text in ``ids_col``.

    A null text has null ids, an empty one none. Characters of no piece become byte pieces, or the unknown piece where
    the model has no bytes. A white-space mark in the text (U+2581) is read as a space, as the model does. Other columns
    and repeated rows pass; an input column named ``ids_col`` is replaced. An empty table gives an empty table. Memory
    is bounded by a batch, its ids and ``CACHED_WORDS`` words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)
    kept = [c for c in docs.columns if c != ids_col]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in slices(batches):
            parts, ends, total, missing = [], [0], 0, []
            for text in batch.column(kept.index(text_col)):
                text = text.as_py()
                missing.append(text is None)
                ids = encoder.text(text or "")
                parts.append(ids)
                total += len(ids)
                ends.append(total)
            ids = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids), mask=pa.array(missing, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*kept, ids_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, table: PieceTable, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids_col`` in ``text_col``.

    Null ids, lists with a null and lists with an id the table does not have give a null text, no ids an empty one. Control
    pieces are empty, bytes that are not UTF-8 become U+FFFD. Other columns and repeated rows pass; an input column named
    ``text_col`` is replaced. An empty table gives an empty table.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table)
    kept = [c for c in docs.columns if c != text_col]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in slices(batches):
            out = []
            for ids in batch.column(kept.index(ids_col)):
                whole = ids.is_valid and not ids.values.null_count
                out.append(decode_ids(ids.values.to_numpy(), pieces) if whole else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*kept, text_col])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(text_col, T.StringType())]))


@query("op8_sentencepiece")
def op8_sentencepiece(spark, folder, model: str = MODEL):
    """Piece ids of every document, and whether decoding them gives the text back."""
    table = read_table(model)
    docs = documents(spark, folder).select("doc_id", "text")
    out = decode(encode(docs, table), table)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("same"))
