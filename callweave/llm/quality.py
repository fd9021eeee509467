"""Quality rules: one table of thresholds, compiled into one projection over built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import documents, let, words
from callweave.llm.registry import query

SYMBOLS = "#*$%&|<>"
#: Words in a row that count as a repeat when found twice.
WINDOW = 5

# Frequent function words.
STOP_WORDS = {
    "en": "the of and to in a is that it for on was with as be by this are from or an at not have".split(),
    "de": "der die das und in zu den mit von ist des im auf für nicht ein eine dem sich als auch es an".split(),
    "fr": "le la les de des du et en un une que qui dans pour pas au par sur est il ne se ce plus".split(),
    "es": "el la los las de del que y en un una por con para no se su al lo como más es ser o".split(),
}


@dataclass(frozen=True)
class Rule:
    """A text fails when ``measure`` lies below ``least`` or above ``most``; texts under ``from_words`` words pass."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: Measures are SQL over the columns of :func:`measures`.
RULES = (
    Rule("no_words", "n_words", least=1),
    Rule("word_length", "word_chars / n_words", least=2, most=14),
    Rule("symbols", "n_symbols / n_words", most=0.25),
    Rule("shouting", "n_shouted / n_words", most=0.3),
    Rule("capitals", "n_capitals / word_chars", most=0.5),
    Rule("stop_words", "n_stop_words / n_words", least=0.02, from_words=50),
    Rule("same_lines", "n_dup_lines / n_lines", most=0.5),
    Rule("doubled", "n_doubled / n_words", most=0.3),
    Rule("repeats", "n_repeat_words / n_words", most=0.2),
)


def repeated_words(tokens: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that are found twice or more in ``tokens``, first ones included."""
    none = F.array().cast("array<bigint>")

    def covered(grams):
        by_gram = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(by_gram, lambda s: let(F.array_sort(F.transform(twice(s), lambda x: x["i"])), spread))

    def twice(s):
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        return F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))

    def spread(starts):
        first = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at"))
        step = lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x - a["at"])).alias("n"), x.alias("at"))
        return F.aggregate(starts, first, step, lambda a: a["n"])

    grams = F.when(
        F.size(tokens) >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size(tokens) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(tokens, i, WINDOW))),
    ).otherwise(none)
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(covered(g)))


def measures(text: Column) -> Column:
    """Struct of counts of one text, all longs; null and empty texts have none of anything but one line."""
    text = F.coalesce(text, F.lit(""))
    lines = F.split(text, "\n", -1)
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws})
    count = lambda c: c.cast("long")

    def of(w):
        return F.struct(
            count(F.size(w)).alias("n_words"),
            count(F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))).alias("word_chars"),
            count(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
            count(F.size(lines)).alias("n_lines"),
            let(
                F.filter(lines, lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\x0c\r"))) > 0),
                lambda x: count(F.size(x) - F.size(F.array_distinct(x))),
            ).alias("n_dup_lines"),
            count(repeated_words(w)).alias("n_repeat_words"),
            count(F.size(F.filter(w, lambda x: F.lower(x).isin(stop)))).alias("n_stop_words"),
            count(F.size(F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False))))).alias("n_doubled"),
            count(F.length(text) - F.length(F.translate(text, "!", ""))).alias("n_shouted"),
            count(F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).alias("n_capitals"),
        )

    return let(words(text), of)


def verdict(rules: tuple[Rule, ...]) -> Column:
    """True where no rule of the table fails; a ratio over nothing fails no rule."""
    passed = F.lit(True)
    for r in rules:
        value = F.expr(r.measure.replace(" / ", " / nullif(") + ", 0)" if " / " in r.measure else r.measure)
        inside = F.lit(True)
        if r.least is not None:
            inside = inside & F.coalesce(value >= r.least, F.lit(True))
        if r.most is not None:
            inside = inside & F.coalesce(value <= r.most, F.lit(True))
        passed = passed & (inside | (F.col("n_words") < r.from_words))
    return passed


def judge(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """``docs`` with the counts of :func:`measures`, ``base_failed`` and ``kept``.

    The base fails with fewer than ``min_words`` words or when more than ``max_repeat_percent`` of 100 words lie in
    repeated windows; what passes is kept unless a rule of ``rules`` fails. Null and empty texts have no words and
    fail. Every row comes back, repeated ones too; input columns with the names of the counts are replaced, all
    others pass. An empty table gives an empty table. Windows are compared by 64-bit hashes within one text.
    """
    names = "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_stop_words n_doubled n_shouted n_capitals".split()
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (*names, "base_failed", "kept")])
    counted = docs.select(kept.alias("_columns"), measures(F.col(f"`{text_col}`")).alias("_m")).select("_columns.*", "_m.*")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


_W = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UP = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"
_STOP = ", ".join(f"'{w}'" for w in sorted({w for ws in STOP_WORDS.values() for w in ws}))


def _sql_rule(r: Rule) -> str:
    value = r.measure.replace(" / ", "::DOUBLE / nullif(") + ", 0)" if " / " in r.measure else r.measure
    parts = [f"coalesce({value} >= {r.least}, TRUE)"] * (r.least is not None)
    parts += [f"coalesce({value} <= {r.most}, TRUE)"] * (r.most is not None)
    return f"({' AND '.join(parts)} OR n_words < {r.from_words})"


SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_W} AS w,
  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, w[i:i + 4] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
twice AS (SELECT doc_id, gram FROM g GROUP BY ALL HAVING count(*) > 1),
c AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM g JOIN twice USING (doc_id, gram)) GROUP BY 1),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(string_split(t, chr(10)))::BIGINT AS n_lines,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(w, lambda x: lower(x) IN ({_STOP})))::BIGINT AS n_stop_words,
  len(list_filter(w, lambda x, i: x = w[i - 1]))::BIGINT AS n_doubled,
  (length(t) - length(replace(t, '!', '')))::BIGINT AS n_shouted, (length(t) - length(translate(t, {_UP}, '')))::BIGINT AS n_capitals
  FROM d LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {" AND ".join(map(_sql_rule, RULES))} AS kept FROM b
"""


@query("op1_quality_rules", SQL)
def op1_quality_rules(spark, folder):
    """Counts and verdict of every document."""
    return judge(documents(spark, folder).select("doc_id", "text")).drop("text")
