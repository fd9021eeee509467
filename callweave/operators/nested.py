"""Nested payloads to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten(df: DataFrame, keep: Sequence[str | Column], *levels: tuple[str, str], outer: bool = False) -> DataFrame:
    """Chained explode: each level is (array path, name of the element); ``keep`` are parent columns.

    Unused struct fields are not read, because the explodes sit directly on the scan.
    """
    out = df
    blow = F.explode_outer if outer else F.explode
    for path, name in levels:
        out = out.withColumn(name, blow(F.col(path)))
    return out.select(*keep)


def first_of(array: str, field: str) -> Column:
    return F.get(F.col(array), F.lit(0))[field]


def last_of(array: str, field: str) -> Column:
    return F.try_element_at(F.col(array), F.lit(-1))[field]


def map_rows(df: DataFrame, keep: Sequence[str], column: str, key: str = "key", value: str = "value") -> DataFrame:
    return df.select(*keep, F.explode(column).alias(key, value))


def map_value(column: str, *keys: str) -> Column:
    """Value of the first key present."""
    return F.coalesce(*[F.try_element_at(F.col(column), F.lit(k)) for k in keys])


def split_rows(df: DataFrame, keep: Sequence[str], column: str, pattern: str, pos: str = "pos", item: str = "item") -> DataFrame:
    return df.select(*keep, F.posexplode(F.split(column, pattern)).alias(pos, item))


def series_rows(
    df: DataFrame, keep: Sequence[str], start: str, step_seconds: int, arrays: Sequence[str], at: str = "intervalStart"
) -> DataFrame:
    """Parallel arrays to rows on a linear time axis that begins at ``start``."""
    rows = df.select(*keep, start, F.posexplode(F.arrays_zip(*arrays)).alias("_pos", "_z"))
    when = F.timestamp_add("SECOND", F.col("_pos") * step_seconds, F.col(start))
    return rows.select(*keep, when.alias(at), *[F.col(f"_z.`{a.split('.')[-1]}`").alias(a.split(".")[-1]) for a in arrays])


def json_lookup(json_map: Column, key: Column) -> Column:
    """Value of a computed key in a JSON object text."""
    return F.try_element_at(F.from_json(json_map, "map<string,string>"), key)


def member_rows(df: DataFrame, keep: Sequence[str], array: str, name: str) -> DataFrame:
    """Array membership as an equi-join key: one row per distinct element."""
    return df.select(*keep, F.explode(F.array_distinct(array)).alias(name))


def joined_text(array: str) -> Column:
    return F.concat_ws(",", array)


def only_fields(array: Column, wanted: Mapping[str, Mapping | None]) -> Column:
    """An array of structs with the fields ``wanted`` only; a mapping stands for those of an inner array of structs."""

    def one(x: Column) -> Column:
        fields = [(x[n] if inner is None else only_fields(x[n], inner)).alias(n) for n, inner in wanted.items()]
        return F.when(x.isNotNull(), F.struct(*fields))

    return F.transform(array, one)


_PAYLOAD = ["conversationId", "conversationStart", "conversationEnd", "originatingDirection"]
_PARTICIPANT = ["participantId", "participantName", "purpose", "userId", "attributes"]
_SESSION = ["sessionId", "mediaType", "messageType", "direction", "ani", "dnis", "remote", "segments", "metrics", "flow"]


def conversation_sessions(details: DataFrame) -> DataFrame:
    """Participants and sessions of conversation payloads, one row per session; payloads may have been cut to the fields in use."""
    participant = details.schema["participants"].dataType.elementType
    session = participant["sessions"].dataType.elementType
    keep = [
        *[c for c in _PAYLOAD if c in details.columns],
        *[F.col(f"p.{c}") for c in _PARTICIPANT if c in participant.names],
        *[F.col(f"s.{c}") for c in _SESSION if c in session.names],
        *[c for c in ("extractDate",) if c in details.columns],
    ]
    return flatten(details, keep, ("participants", "p"), ("p.sessions", "s"))


def first_item(array: str) -> Column:
    """First element of a plain array."""
    return F.get(F.col(array), F.lit(0))
