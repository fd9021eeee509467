"""Document-style operators over nested columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def since(df: DataFrame, start: str, *columns: str) -> DataFrame:
    """Documents whose first or any later time column is not before ``start``."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.col(c) >= F.to_timestamp(F.lit(start)), F.lit(False))
    return df.filter(hit)


def project(df: DataFrame, fields: Mapping[str, str | Column]) -> DataFrame:
    """New column -> nested path or expression."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()])


def unwind(df: DataFrame, path: str, name: str, keep_empty: bool = False) -> DataFrame:
    return df.withColumn(name, (F.explode_outer if keep_empty else F.explode)(F.col(path)))


def lookup(left: DataFrame, right: DataFrame, on: Mapping[str, str], fields: Mapping[str, str], keep_unmatched: bool = True) -> DataFrame:
    """Lookup with the unwind that follows it, as one join: a row per match, no array per document."""
    r = right.select(*[F.col(rk).alias(f"_k{i}") for i, rk in enumerate(on.values())], *[F.col(v).alias(k) for k, v in fields.items()])
    cond = None
    for i, lk in enumerate(on):
        c = left[lk] == r[f"_k{i}"] if "." not in lk else F.col(lk) == F.col(f"_k{i}")
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left" if keep_unmatched else "inner").drop(*[f"_k{i}" for i in range(len(on))])


def lookup_size(left: DataFrame, right: DataFrame, on: Mapping[str, str], name: str) -> DataFrame:
    """Number of matches of a lookup, 0 without any."""
    counts = right.groupBy(*[F.col(rk).alias(lk) for lk, rk in on.items()]).agg(F.count(F.lit(1)).alias(name))
    return left.join(counts, list(on), "left").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))


def zone_text(ts: Column, zone: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """UTC time as text of a zone."""
    return F.date_format(F.from_utc_timestamp(ts, zone), fmt)


def text_time(text: Column, fmt: str = "yyyy-MM-dd'T'HH:mm:ss.SSSX") -> Column:
    return F.try_to_timestamp(text, F.lit(fmt))


def millis_time(ms: Column, offset_ms: int = 0) -> Column:
    """Epoch milliseconds, moved by a fixed offset."""
    return F.timestamp_millis(ms + F.lit(offset_ms))


def facet(branches: Sequence[DataFrame]) -> DataFrame:
    """Results of several branches over the same documents, one after the other."""
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def entries(df: DataFrame, keep: Sequence[str], path: str) -> DataFrame:
    """Object to (key, value) rows."""
    return df.select(*keep, F.explode(F.map_entries(path)).alias("_e")).select(*keep, F.col("_e.key").alias("k"), F.col("_e.value").alias("v"))


def parsed(text: Column) -> Column:
    """A JSON document of any shape as a variant; null for text that is no JSON."""
    return F.try_parse_json(text)


def at(doc: Column, path: str, kind: str = "string") -> Column:
    """Value at a path of a variant as ``kind``; null where the document lacks it or has something else there."""
    return F.try_variant_get(doc, f"$.{path}", kind)


def id_at(doc: Column, path: str) -> Column:
    """An id, given plainly or as an object with ``oid``."""
    return F.coalesce(at(doc, f"{path}.oid"), at(doc, path))


def time_at(doc: Column, path: str) -> Column:
    """A time, given as text, as epoch milliseconds or as an object with ``$date`` in milliseconds."""
    wrapped = F.timestamp_millis(at(doc, f"{path}['$date']", "long"))
    return F.coalesce(wrapped, text_time(at(doc, path)), F.timestamp_millis(at(doc, path, "long")))


def entries_at(doc: Column, path: str) -> Column:
    """Elements of an array at a path as variants; anything else there is one element, nothing is one null."""
    return F.coalesce(at(doc, path, "array<variant>"), F.array(at(doc, path, "variant")))
