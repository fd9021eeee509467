"""Line dedup: lines found in many documents are dropped from all of them.

Normalised lines are exploded and hashed, distinct documents are counted per hash, and what stays is put
together again by position. Only hashes and positions are shuffled to find the lines; the texts move once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callweave.llm.common import SPACE, ascii_lower, documents, identity
from callweave.llm.registry import query

#: Copies of each common hash, so that the rows of one very common line meet it in several tasks.
SALTS = 16


def lines_of(text):
    """Lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_common_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1
) -> DataFrame:
    """``docs`` with the remaining text in ``text_col`` and the columns ``n_lines`` and ``n_dropped``.

    A line's key is the line stripped of ASCII white space with A-Z lower-cased; keys of ``min_chars`` code points
    or more that are found in ``min_docs`` documents or more lose all their lines. Lines that stay keep their bytes
    and order, joined by a newline. Null and empty texts are one empty line and come back as an empty text. Rows
    with one id count as one document, rows with a null id by their text; repeated rows all come back. Other columns pass
    through; input columns named ``n_lines`` or ``n_dropped`` are replaced. An empty table gives an empty table.
    """
    text = F.col(f"`{text_col}`")
    key = lambda line: ascii_lower(F.btrim(line, F.lit(SPACE)))
    found = (
        docs.select(*identity(id_col, text_col), F.posexplode(F.transform(lines_of(text), key)).alias("_pos", "_key"))
        .filter(F.length("_key") >= min_chars)
        .select("_doc", "_row", "_pos", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"))
    )
    common = (
        found.groupBy("_h1", "_h2")
        .agg(F.countDistinct("_doc").alias("_docs"))
        .filter(F.col("_docs") >= min_docs)
        .select("_h1", "_h2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    dropped = (
        found.distinct()
        .withColumn("_salt", F.pmod(F.xxhash64("_doc", "_row"), F.lit(SALTS)).cast("int"))
        .join(common, ["_h1", "_h2", "_salt"], "left_semi")
        .groupBy("_doc", "_row")
        .agg(F.array_sort(F.collect_list("_pos")).alias("_gone"))
    )
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept_columns]).alias("_columns"), *identity(id_col, text_col))
    joined = rows.join(dropped, ["_doc", "_row"], "left")
    column = lambda c: F.col(f"_columns.`{c}`")
    text = column(text_col)
    lines = lines_of(text)
    cuts = F.concat(F.array(F.lit(-1)), F.col("_gone"), F.array(F.size(lines)))
    stays = F.when(F.col("_gone").isNull(), F.coalesce(text, F.lit(""))).otherwise(_without(lines, cuts))
    return joined.select(
        *[(stays if c == text_col else column(c)).alias(c) for c in kept_columns],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def _without(lines, cuts):
    """Joined lines between the cut positions; one pass, however many lines go."""
    both = F.element_at(
        F.transform(
            F.array(F.struct(lines.alias("l"), cuts.alias("c"))),
            lambda x: F.transform(
                F.sequence(F.lit(1), F.size(x["c"]) - 1),
                lambda k: F.slice(
                    x["l"],
                    F.element_at(x["c"], k) + 2,
                    F.element_at(x["c"], k + 1) - F.element_at(x["c"], k) - 1,
                ),
            ),
        ),
        1,
    )
    return F.array_join(F.flatten(both), "\n")


_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = f"""
WITH split AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM split
), common AS (
  SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(c.k)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(CASE WHEN c.k IS NULL THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM keyed LEFT JOIN common c USING (k) GROUP BY doc_id
"""


@query("op7_line_dedup", SQL)
def op7_line_dedup(spark, folder):
    """Every document without the lines that ten or more documents share."""
    kept = drop_common_lines(documents(spark, folder).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
