"""License scans: headers and licence files against templates, then inheritance from the nearest directory.

Lines that speak of a licence are compared with one-line notices, header blocks and whole licence files with full
headers and licence texts, by the cosine of sparse TF-IDF vectors, kept as rows of (line, term, weight). Files without a header of their own take the licence of the nearest directory above them that holds
a licence file, found by joins on paths.
"""

from __future__ import annotations

from functools import cache
from importlib.resources import files as package_files

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.llm.common import documents, let
from callweave.llm.registry import query

# Notices of common licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0, Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
# Standard headers of source files.
_GNU = """This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published
by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.
This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.
You should have received a copy of the GNU {name} along with this {work}{end}"""
_ENDS = {
    "url": ". If not, see <https://www.gnu.org/licenses/>.",
    "letter": "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.",
}
_GNU_NAMES = {
    "GPL-2.0": ("General Public License", "2"),
    "GPL-3.0": ("General Public License", "3"),
    "LGPL-2.1": ("Lesser General Public License", "2.1"),
    "LGPL-3.0": ("Lesser General Public License", "3"),
    "AGPL-3.0": ("Affero General Public License", "3"),
}
_CC = """This work is licensed under the Creative Commons {name} 4.0 International License. To view a copy of this license, visit
http://creativecommons.org/licenses/{path}/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."""
HEADERS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.""",
    "CC-BY-4.0": _CC.format(name="Attribution", path="by"),
    "CC-BY-NC-4.0": _CC.format(name="Attribution-NonCommercial", path="by-nc"),
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    **{
        f"{k}|{work} {e}": _GNU.format(work=work, name=n, version=v, end=end)
        for k, (n, v) in _GNU_NAMES.items()
        for e, end in _ENDS.items()
        for work in ("program", "library")
    },
}
#: Licences whose whole text lies in ``license_texts``.
WHOLE = "Apache-2.0 BSD-2-Clause BSD-3-Clause GPL-2.0 GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MPL-2.0 Unlicense".split()
#: Paragraphs that may follow a paragraph with a header line in one block.
FOLLOWING = 6
#: A line that is a comment, its content as group 1; and what parts paragraphs: blank lines, or where comments begin or end.
COMMENT = r"(?m)^[ \t]*(?:/\*+|//+|\*+/?|#+|;+|--+|%+|<!--|\"{3}|'{3}|(?i:dnl|rem)\b)(.*?)[ \t]*(?:\*+/|-->)?[ \t]*$"
BREAK = "\n[ \t\r]*(?:\n[ \t\r]*)+|(?<!\x01)\n(?=\x01)|(?<=\x01)\n(?!\x01)"
#: Lines that can be headers.
HEADER = "licen[cs]|copyright|copying|public domain|redistribution"
LICENSE_FILE = r"(^|/)(licen[cs]e|copying|notice)[^/]*$"
SALTS = 16


def _terms(text: Column) -> Column:
    """Lower-case terms; a final dot is no part of a term."""
    return F.filter(
        F.transform(F.split(F.lower(text), r"[^a-z0-9.\-]+"), lambda t: F.regexp_replace(t, r"^[.\-]+|[.\-]+$", "")),
        lambda t: t != "",
    )


@cache
def full_texts() -> dict[str, str]:
    """Full headers and licence texts; what follows ``|`` in a name is no part of the licence's."""
    folder = package_files("callweave.llm") / "license_texts"
    whole = {k: (folder / f"{k}.txt").read_text() for k in WHOLE}
    # close enough to tell the Affero licence from the one it was made of
    whole["AGPL-3.0"] = whole["GPL-3.0"].replace("GNU General Public", "GNU Affero General Public").replace("GNU GENERAL PUBLIC", "GNU AFFERO GENERAL PUBLIC")
    return HEADERS | {f"{k}|text": v for k, v in whole.items()}


def header_blocks(text: Column) -> Column:
    """Adjoining paragraphs around each one with a header line: it alone or with up to ``FOLLOWING`` after it, and the same
    from the paragraph before. A paragraph is a run of comment lines or of other lines that are not blank."""
    paragraphs = F.split(F.regexp_replace(text, COMMENT, "\x01$1\x01"), BREAK, -1)
    speaks = lambda p: F.lower(p).rlike(HEADER)

    def around(ps):
        block = lambda start, n: F.array_join(F.slice(ps, start, n), "\n")

        def at(p, i):
            own = F.array(*[block(i + 1, F.lit(n + 1)) for n in range(FOLLOWING + 1)])
            wider = F.array(*[block(i, F.lit(n + 2)) for n in range(FOLLOWING + 1)])
            # a paragraph before that speaks itself starts its own blocks
            wider = F.when((i > 0) & ~speaks(F.get(ps, i - 1)), wider).otherwise(F.array().cast("array<string>"))
            return F.when(speaks(p), F.concat(own, wider)).otherwise(F.array().cast("array<string>"))

        return F.array_distinct(F.flatten(F.transform(ps, at)))

    return let(paragraphs, around)


def template_vectors(spark, templates: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(license, term, weight) with unit vectors, and (term, idf); a term of no template has the idf of frequency 0."""
    rows = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    terms = rows.select("license", F.explode(_terms(F.col("text"))).alias("term")).groupBy("license", "term").agg(F.count("*").alias("tf"))
    idf = terms.groupBy("term").agg((F.log((1 + len(templates)) / (1 + F.count("*"))) + 1).alias("idf"))
    weighted = terms.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("license")))
    return weighted.select("license", "term", (F.col("w") / norm).alias("weight")), idf


def best_license(lines: DataFrame, templates: dict[str, str], text_col: str = "line") -> DataFrame:
    """``line``, ``license`` and ``score`` of the nearest template for distinct ``lines``, whose text is ``text_col``; equal
    scores go to the first name."""
    vectors, idf = template_vectors(lines.sparkSession, templates)
    unknown = F.log(F.lit(1.0 + len(templates))) + 1
    terms = lines.select("line", F.explode(_terms(F.col(text_col))).alias("term")).groupBy("line", "term").agg(F.count("*").alias("tf"))
    # the table of template terms is as small as the templates
    weighted = terms.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", unknown))
    norms = weighted.groupBy("line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighted.join(F.broadcast(vectors), "term").groupBy("line", "license").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, "line").withColumn("score", F.round(F.col("dot") / F.col("norm"), 6))
    best = F.min(F.struct((-F.col("score")).alias("s"), "license"))
    return scored.groupBy("line").agg(best.alias("b")).select("line", F.col("b.license").alias("license"), (-F.col("b.s")).alias("score"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None, license_file: Column | None = None, templates: dict[str, str] | None = None, threshold: float = 0.6, texts: dict[str, str] | None = None) -> DataFrame:
    """``id_col``, ``path``, ``own_license``, ``score``, ``license`` and ``inherited_from``, one row per row of ``docs``.

    ``path`` is a column of file paths with slashes (by default ``path``). A file's own licence is the best template of
    its header lines, or the best of ``texts`` (full headers and licence texts, by default :func:`full_texts` unless templates are
    given) for its header blocks and, in a licence file, for the whole text, whichever cosine is greatest if it reaches
    ``threshold`` (equal scores: the first name). Licence files, by default those named so,
    give theirs to their directory; of several in one directory the first path counts. Other files take the licence of the nearest
    directory at or above theirs that has one, and ``inherited_from`` names it (empty for the top). Null and empty texts
    have no header; a null path inherits nothing. Repeated rows all come back. Other columns are left out. An empty
    table gives an empty table.
    """
    if texts is None:
        texts = full_texts() if templates is None else {}
    templates = TEMPLATES if templates is None else templates
    path = F.col("path") if path is None else path
    license_file = F.lower(path).rlike(LICENSE_FILE) if license_file is None else license_file
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), path.cast("string").alias("path"), F.coalesce(license_file, F.lit(False)).alias("gives"))
    rows = rows.withColumn("mark", F.xxhash64("id", "path", "text", F.col("text").isNull()))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.lower(x).rlike(HEADER))
    headers = rows.select("mark", F.explode(F.array_distinct(F.transform(lines, lambda x: F.trim(x)))).alias("line")).distinct()
    # a common notice is scored once and meets its files in several tasks
    scored = best_license(headers.select("line").distinct(), templates)
    if texts:
        whole = F.when(F.col("gives"), F.array("text")).otherwise(F.array().cast("array<string>"))
        blocks = rows.filter(F.lower("text").rlike(HEADER) | (F.col("gives") & F.col("text").isNotNull()))
        blocks = blocks.select("mark", F.explode(F.array_union(header_blocks(F.col("text")), whole)).alias("block"))
        blocks = blocks.select("mark", F.md5("block").alias("line"), "block")
        nearest = best_license(blocks.select("line", "block").distinct(), texts, "block")
        scored = scored.unionByName(nearest.withColumn("license", F.substring_index("license", "|", 1)))
        headers = headers.unionByName(blocks.select("mark", "line").distinct())
    scored = scored.filter(F.col("score") >= threshold)
    scored = scored.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    headers = headers.withColumn("salt", F.pmod("mark", F.lit(SALTS)).cast("int"))
    best = F.min(F.struct((-F.col("score")).alias("s"), "license"))
    own = headers.join(scored, ["line", "salt"]).groupBy("mark").agg(best.alias("b"))
    own = own.select("mark", F.col("b.license").alias("own_license"), (-F.col("b.s")).alias("score"))
    files = rows.select("mark", "id", "path", "gives").join(own, "mark", "left")
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    givers = files.filter("gives AND own_license IS NOT NULL AND path IS NOT NULL").groupBy(directory.alias("directory"))
    givers = givers.agg(F.min_by("own_license", F.struct("path", "own_license")).alias("given"))
    parts = F.split(directory, "/")
    above = F.when(
        directory == "", F.array(F.lit(""))
    ).otherwise(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))))
    heirs = files.filter("own_license IS NULL AND path IS NOT NULL").select(directory.alias("home"), above.alias("above")).distinct()
    heirs = heirs.select("home", F.explode("above").alias("directory")).join(givers, "directory")
    nearest = heirs.groupBy("home").agg(F.max_by(F.struct("given", "directory"), F.length("directory")).alias("n"))
    nearest = nearest.select("home", F.col("n.given").alias("given"), F.col("n.directory").alias("inherited_from"))
    out = files.withColumn("home", F.when(F.col("own_license").isNull(), directory)).join(nearest, "home", "left")
    return out.select(F.col("id").alias(id_col), "path", "own_license", "score", F.coalesce("own_license", "given").alias("license"), "inherited_from")


def document_path() -> Column:
    """Documents have no path: source, thousands and hundreds of the id stand for directories."""
    number = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    parts = ["source", number(1000), number(100), F.col("doc_id").cast("string")]
    return F.concat(parts[0], *[x for p in parts[1:] for x in (F.lit("/"), p)])


def is_license_file() -> Column:
    """A document whose last line is a notice and that has two lines at most stands for a licence file."""
    lines = F.split("text", "\n", -1)
    return (F.size(lines) <= 2) & F.lower(F.element_at(lines, -1)).rlike(HEADER)


_TERMS = r"list_filter(list_transform(regexp_split_to_array(lower({}), '[^a-z0-9.\-]+'), lambda t: regexp_replace(t, '^[.\-]+|[.\-]+$', '', 'g')), lambda t: t <> '')"
_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in TEMPLATES.items())
SQL = rf"""
WITH tpl(license, text) AS (VALUES {_VALUES}),
tt AS (SELECT license, term, count(*) AS tf FROM (SELECT license, unnest({_TERMS.format("text")}) AS term FROM tpl) GROUP BY ALL),
idf AS (SELECT term, ln({1 + len(TEMPLATES)}::DOUBLE / (1 + count(*))) + 1 AS idf FROM tt GROUP BY term),
tw AS (SELECT license, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY license)) AS weight FROM tt JOIN idf USING (term)),
f AS (SELECT doc_id, text, source || '/' || (doc_id // 1000) || '/' || (doc_id // 100) || '/' || doc_id AS path,
  source || '/' || (doc_id // 1000) || '/' || (doc_id // 100) AS dir, string_split(text, chr(10)) AS l FROM documents),
h AS (SELECT DISTINCT doc_id, trim(line) AS line FROM (SELECT doc_id, unnest(l) AS line FROM f) WHERE regexp_matches(lower(line), '{HEADER}')),
ht AS (SELECT line, term, count(*) AS tf FROM (SELECT line, unnest({_TERMS.format("line")}) AS term FROM (SELECT DISTINCT line FROM h)) GROUP BY ALL),
hw AS (SELECT line, term, tf * coalesce(idf, ln({1 + len(TEMPLATES)}::DOUBLE) + 1) AS w FROM ht LEFT JOIN idf USING (term)),
n AS (SELECT line, sqrt(sum(w * w)) AS norm FROM hw GROUP BY line),
s AS (SELECT line, license, round(sum(w * weight) / any_value(norm), 6) AS score FROM hw JOIN tw USING (term) JOIN n USING (line) GROUP BY line, license),
own AS (SELECT doc_id, arg_min(license, (-score, license)) AS own_license, max(score) AS score FROM h JOIN s USING (line) WHERE score >= 0.6 GROUP BY doc_id),
g AS (SELECT dir, arg_min(own_license, path) AS given FROM f JOIN own USING (doc_id)
  WHERE len(l) <= 2 AND regexp_matches(lower(l[-1]), '{HEADER}') GROUP BY dir),
up AS (SELECT DISTINCT dir AS home, unnest([dir, regexp_replace(dir, '/[^/]*$', ''), regexp_replace(dir, '/[^/]*/[^/]*$', ''), '']) AS dir FROM f),
nearest AS (SELECT home, arg_max(given, length(dir)) AS given, arg_max(dir, length(dir)) AS inherited_from FROM up JOIN g USING (dir) GROUP BY home)
SELECT doc_id, path, own_license, score, coalesce(own_license, given) AS license,
  CASE WHEN own_license IS NULL THEN inherited_from END AS inherited_from
FROM f LEFT JOIN own USING (doc_id) LEFT JOIN nearest ON home = dir
"""


@query("op6_license_scan", SQL)
def op6_license_scan(spark, folder):
    """Licence of every document, its own or that of the nearest directory."""
    return scan(documents(spark, folder), path=document_path(), license_file=is_license_file())
