"""Joins that need more than a plain equality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import text as tx
from callweave.operators import marks
from callweave.operators.ordered import newest

def distinct_by(df: DataFrame, key: str) -> DataFrame:
    """Distinct rows, shuffled by ``key`` alone: a join on it needs no second shuffle, and map tasks hold no rows to compare."""
    return df.repartition(key).distinct()


def spread_finely(df: DataFrame, key: str) -> DataFrame:
    """``df`` spread by ``key`` into four times as many parts as a shuffle has otherwise, for work that holds a part several times
    over, hashed and sorted, and would spill it. Frames spread so lie beside each other."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(4 * parts, key)


def outer_chain(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of metric sets with coalesced keys.

    Written as a union followed by one grouped ``max``, so the sets shuffle once and not once per join.
    Each set holds a key at most once and its own measure columns.
    """
    names = [c for f in frames for c in f.columns if c not in keys]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return together.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names])


def day_spine(entities: DataFrame, start: Column, end: Column, name: str = "day") -> DataFrame:
    """Every entity on every day of [start, end]: row by row, without a cross join. An end before the start has no days."""
    return entities.withColumn(name, F.explode(F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day")))))


# a slot of a level is this many slots of the level below; the last level spans all dates
_SLOTS, _LEVELS = 16, 7


def interval_join(
    points: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, start: str, end: str, slot_seconds: int = 3600,
    closed: bool = True,
) -> DataFrame:
    """Points within [start, end] of a span of the same key.

    Both sides meet on (key, level, time slot). A span takes the level whose slots it fits in best and is repeated for the
    slots it touches there, 17 at most even if it never ends; a point comes once per level. A hot key is spread over its
    slots, and a point is compared only with spans of its slot. Spans that end before they start match nothing.
    """
    def slot(ts, level):
        return F.floor(F.unix_timestamp(ts) / (F.lit(slot_seconds) * F.pow(F.lit(float(_SLOTS)), level)))

    left = points.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(_LEVELS - 1)))).withColumn("_slot", slot(F.col(at), F.col("_level")))
    length = (F.unix_timestamp(F.col(end)) - F.unix_timestamp(F.col(start))) / slot_seconds
    fits = F.ceil(F.log(float(_SLOTS), F.greatest(length, F.lit(1.0)))) - 1
    right = spans.filter(F.col(start) <= F.col(end)).withColumn("_level", F.greatest(F.lit(0), F.least(F.lit(_LEVELS - 1), fits)).cast("int"))
    right = right.withColumn("_slot", F.explode(F.sequence(slot(F.col(start), F.col("_level")), slot(F.col(end), F.col("_level")))))
    right = right.select("_level", "_slot", *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns if c not in ("_level", "_slot")])
    upper = F.col(at) <= F.col(end) if closed else F.col(at) < F.col(end)
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_r_{k}") for k in keys])
    meet = (left["_level"] == right["_level"]) & (left["_slot"] == right["_slot"])
    joined = left.join(right, meet & on & (F.col(at) >= F.col(start)) & upper)
    return joined.drop("_level", "_slot", *[f"_r_{k}" for k in keys])


def span_days(df: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    """A span to the days it touches."""
    days = F.sequence(F.to_date(start), F.to_date(end), F.expr("interval 1 day"))
    return df.filter(F.col(start) <= F.col(end)).withColumn(name, F.explode(days))


def name_variants(first: Column, middle: Column, last: Column) -> Column:
    """Ways a person's name may be written, best first; blanks are squeezed."""
    forms = [
        (first, last),
        (last, first),
        (first, middle, last),
        (last, first, middle),
        (middle, last),
        (first, middle),
        (last, middle, first),
        (first, last, middle),
    ]
    texts = [F.trim(F.regexp_replace(F.concat_ws(" ", *[F.lower(x) for x in f]), "\\s+", " ")) for f in forms]
    return F.array_distinct(F.array(*texts))


def match_names(
    people: DataFrame, users: DataFrame, person_id: str, login: str, variants: str, user_login: str, user_name: str,
    active: str, user_id: str,
) -> DataFrame:
    """User of a person: by login first, else by name variant; an active user wins, then the smallest id.

    Variants are exploded into an equi join, so no pair of all people and users is ever built.
    """
    p = people.select(person_id, login, variants)
    u = users.select(
        F.col(user_id).alias("_uid"), F.lower(F.col(user_login)).alias("_login"), F.lower(F.col(user_name)).alias("_name"),
        F.col(active).alias("_active"),
    )
    by_login = p.join(u, F.lower(F.col(login)) == F.col("_login")).select(
        person_id, "_uid", "_active", F.lit(-1).alias("_pos")
    )
    by_name = (
        p.select(person_id, F.posexplode(variants).alias("_pos", "_variant"))
        .join(u, F.col("_variant") == F.col("_name"))
        .select(person_id, "_uid", "_active", "_pos")
    )
    # login matches outrank name matches; among name matches the active state comes first
    best = newest(
        by_login.union(by_name),
        [person_id],
        (F.col("_pos") >= 0).asc(),
        F.col("_active").desc(),
        F.col("_pos").asc(),
        F.col("_uid").asc(),
    )
    return best.select(
        person_id, F.col("_uid").alias("userId"), F.when(F.col("_pos") < 0, "login").otherwise("name").alias("matchedBy")
    )


def anchor_lines(steps: DataFrame, lines: DataFrame, keys: Sequence[str], start: str, end: str, line: str) -> DataFrame:
    """Rows of ``lines`` whose number is the start or the end line of a step."""
    ends = F.array_compact(F.array_distinct(F.array(F.col(start), F.col(end))))
    return steps.withColumn(line, F.explode(ends)).join(lines, [*keys, line])


def lookup_local_time(df: DataFrame, zones: DataFrame, keys: Sequence[str], columns: Mapping[str, str], missing: str | None = None) -> DataFrame:
    """Join the zone of the key and convert UTC columns to local time.

    ``columns`` goes from new to UTC column. Rows without a zone use ``missing``, or are dropped when
    it is None.
    """
    out = df.join(zones, list(keys), "inner" if missing is None else "left")
    zone = F.trim("timeZone") if missing is None else F.coalesce(F.trim("timeZone"), F.lit(missing))
    return out.withColumns({new: F.from_utc_timestamp(F.col(old), zone) for new, old in columns.items()})


def email_key(address: Column) -> Column:
    return tx.email_local(address)


def within_parts(table: DataFrame, wanted: DataFrame, part: str) -> DataFrame:
    """Rows of ``table`` in the folders ``part`` that ``wanted`` has rows for.

    The values of ``part`` in ``wanted``, at most one row for each folder of the table, are broadcast, which lets a stored table
    skip its other folders when it is scanned (dynamic partition pruning). Null parts are in no folder that is wanted.
    """
    return table.join(F.broadcast(wanted.select(part).distinct()), part, "left_semi")


def of_wanted(table: DataFrame, wanted: DataFrame, part: str, keys: Sequence[str]) -> DataFrame:
    """Rows of ``table`` whose (part, keys) are in ``wanted``, out of the folders that ``wanted`` has rows for.

    Most rows that are not wanted are told by the marks of the keys and are not shuffled; the others are by ``keys`` alone, so that
    what follows by these and more needs no further shuffle.
    """
    near = marks.possible(within_parts(table, wanted, part), wanted, *keys)
    other = wanted.select(*[F.col(c).alias(f"_{c}") for c in (part, *keys)])
    # equality of the parts as two comparisons: no key of the join, so that rows are spread by the others
    same = (F.col(part) <= F.col(f"_{part}")) & (F.col(part) >= F.col(f"_{part}"))
    return near.join(other, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys], same), "left_semi")
