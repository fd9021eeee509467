"""Secret scans: candidates found by shape, false positives removed by a random forest.

Candidates are long runs of key characters inside words, and values of any length and sign that are given to a credential
name. Their features are columns over built-in functions: length,
transitions between kinds of characters, coverage by dictionary words, the path of the file and the words beside them.
A random forest trained from labelled findings tells secrets from the rest.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.llm.common import documents, let, words
from callweave.llm.quality import STOP_WORDS
from callweave.llm.registry import query
from callweave.session import cut_lineage

#: Shortest candidate without a credential name.
LEAST = 16
KEY = r"[A-Za-z0-9+/=_.\-]{%d,}" % LEAST
#: Bound of the training sample: labelled findings of each class, those with the smallest hashed places.
FINDINGS_PER_CLASS = 1000
TREES, DEPTH = 20, 6

# Words that speak for a secret beside a candidate, and parts of paths that speak against one.
NAMES = "api apikey auth authorization bearer credential key passphrase passwd password private pwd secret token".split()
SAMPLES = "doc docs example examples fixture fixtures mock sample samples test tests".split()
# Parts of addresses and file names, beside the function words of quality.STOP_WORDS.
DICTIONARY = "www http https com org net example mail html php index static image images user users file files page".split()

# Names whose value is a candidate of any length, as ends of words, and what stands between both.
CREDENTIAL = r"(?i:passw(?:or)?d|passphrase|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|secret[_-]?key|auth[_-]?key|credentials?|authorization)"
SIGN = "(?::=|=>|[:=])"
QUOTE = "[\"'`]"
#: A word with name and value, a word that ends in a name, one that ends in a name and a sign, and names that need no sign.
INLINE = rf"{CREDENTIAL}{QUOTE}?{SIGN}(?!=)(.+)$"
NAME_END = rf"{CREDENTIAL}{QUOTE}?$"
SIGNED = rf"{CREDENTIAL}{QUOTE}?{SIGN}$"
OPTION = rf"^--?[A-Za-z_-]*{CREDENTIAL}$|^(?i:bearer)$"
#: A text that can have a value beside a name.
SPOKEN = rf"{CREDENTIAL}{QUOTE}?[ \t\n\x0b\r\f]*{SIGN}|-[A-Za-z_]*{CREDENTIAL}|(?i:bearer)"

# Keys that their own prefix gives away, at the end of a candidate.
KEY_FORMS = {
    "AWS": "(?:AKIA|ASIA)[A-Z0-9]{16}",
    "GitHub": "gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}",
    "GitLab": r"glpat-[A-Za-z0-9_\-]{20,}",
    "Google": r"AIza[A-Za-z0-9_\-]{35}",
    "JWT": r"eyJ[A-Za-z0-9_\-]{8,}\.eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}",
    "Slack": r"xox[abprs]-[A-Za-z0-9\-]{10,}",
    "Stripe": "[sr]k_live_[A-Za-z0-9]{16,}",
}
# What the value of a credential name looks like when it is a secret.
VALUE_FORMS = {
    "hexadecimal": "(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})",
    "base64": r"(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])[A-Za-z0-9+/_\-]{20,}={0,2}",
    "password": r"(?=.*[A-Za-z])(?=.*[0-9!@#%^&*?~+])[^\s(){}<>\[\]$]{6,64}",
}
# What is certainly no secret where no credential name stands before it.
NONE_FORMS = {
    "word": "[A-Z]?[a-z]+[.]?|[A-Z]+[.]?|[A-Za-z]+(?:[-_=/.]+[A-Za-z]+)+[.]?",
    "number": r"[0-9.\-/=_+]+",
    "rule": r"[+/=_.\-]+",
    "host": r"(?:[a-z0-9\-]{1,30}\.)+[a-z]{2,6}[.]?",
    "path": r"[./]*(?:[A-Za-z][A-Za-z_\-]*[0-9]{0,4}[./]+)+[A-Za-z_\-]*[0-9]{0,4}",
}
PLACEHOLDER = "(?i)example|x{4}|changeme|placeholder|your[_-]"


def _value(word: Column) -> Column:
    """A value without its quotes and the signs that end a statement."""
    quoted = F.regexp_extract(word, rf"^({QUOTE})(.+)\1", 2)
    return F.when(quoted != "", quoted).otherwise(F.regexp_replace(word, rf"^{QUOTE}+|{QUOTE}*[,;]*$", ""))


def _named_value(before2: Column, before: Column, word: Column) -> Column:
    """The value that ``word`` gives to a credential name in it or before it; null without one."""
    inline = F.regexp_extract(word, INLINE, 1)
    named = before.rlike(SIGNED) | (before.rlike(f"^{SIGN}$") & before2.rlike(NAME_END)) | before.rlike(OPTION)
    # a sign alone is no value: the next word is
    value = F.when(inline != "", _value(inline)).when(named & ~word.rlike(f"^{SIGN}$"), _value(word))
    return F.when(value != "", value)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """``id``, ``at`` (place of the word, from 1), ``part`` (place in the word, from 0), ``candidate``, ``before2``, ``before``, ``word``, ``after``, ``path``.

    Runs of ``LEAST`` or more key characters, and after those of a word the value it gives to a credential name, unless one of
    them holds it. Null and empty texts have no candidates.
    """
    path = F.col(f"`{path_col}`") if path_col else F.lit(None)
    beside = lambda w, i: F.coalesce(F.get(w, i), F.lit(""))

    text = F.col(f"`{text_col}`")

    def found(w, spoken):
        near = lambda i: F.lit(spoken) & _named_value(beside(w, i - 2), beside(w, i - 1), beside(w, i)).isNotNull()
        long = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (F.length(F.get(w, i)) >= LEAST) | near(i))
        rows = F.transform(
            long,
            lambda i: F.struct(
                (i + 1).cast("long").alias("at"),
                beside(w, i - 2).alias("before2"),
                beside(w, i - 1).alias("before"),
                beside(w, i).alias("word"),
                beside(w, i + 1).alias("after"),
            ),
        )
        return F.when(F.size(w) > 0, rows)

    # only texts that name a credential are searched for values word by word
    rows = F.when(text.rlike(SPOKEN), let(words(text), lambda w: found(w, True))).otherwise(let(words(text), lambda w: found(w, False)))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), path.cast("string").alias("path"), F.explode(rows).alias("f"))
    rows = rows.select("id", "path", "f.*")
    runs = F.regexp_extract_all("word", F.lit(KEY), 0)
    value = _named_value(F.col("before2"), F.col("before"), F.col("word"))
    held = lambda r: F.exists(r, lambda c: c.contains(value))
    both = let(runs, lambda r: F.when(value.isNull() | held(r), r).otherwise(F.concat(r, F.array(value))))
    return rows.select("*", F.posexplode(both).alias("part", "candidate"))


def features(found: DataFrame) -> DataFrame:
    """``found`` with one double column per feature, named ``f_*``."""
    c = F.col("candidate")
    size = F.length(c)
    count = lambda pattern: F.regexp_count(c, F.lit(pattern))
    dictionary = sorted({w for ws in STOP_WORDS.values() for w in ws if len(w) > 2 and w.isascii()} | set(DICTIONARY), key=lambda w: (-len(w), w))
    uncovered = F.regexp_replace(F.lower(c), "|".join(dictionary), "")
    near = F.lower(F.concat_ws(" ", "before2", "before", F.substring_index("word", "=", 1)))
    has = lambda text, parts: F.coalesce(text.rlike(rf"(?<![a-z])({'|'.join(parts)})(?![a-z])"), F.lit(False))
    made = {
        "length": size,
        "digits": count("[0-9]") / size,
        "upper": count("[A-Z]") / size,
        "marks": count("[^A-Za-z0-9]") / size,
        "hex": count("[0-9a-fA-F]") / size,
        "kinds": count("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Za-z])|(?<=[0-9])(?=[^0-9])") / size,
        "vowels": count("(?i)(?<=[aeiou])(?=[b-df-hj-np-tv-z])|(?<=[b-df-hj-np-tv-z])(?=[aeiou])") / size,
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / size,
        "covered": 1 - F.length(uncovered) / size,
        "sample_path": has(F.lower(F.coalesce("path", F.lit(""))), SAMPLES),
        "named": has(near, NAMES),
        "assigned": (F.col("before").rlike("[:=]$") | F.col("word").rlike("^[A-Za-z_]+[:=]")),
        "quoted": F.col("word").rlike("[\"'`]"),
        "sentence": F.col("after").rlike("^[a-z]+[.,]?$") & F.col("before").rlike("^[a-z]+[,]?$"),
    }
    return found.select("*", *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(f"f_{k}") for k, v in made.items()])


def train(labelled: DataFrame, seed: int = 1) -> PipelineModel | None:
    """Forest from rows of :func:`features` with a column ``secret`` (0 or 1); of each class the ``FINDINGS_PER_CLASS``
    rows with the smallest hash of (id, at, part). Null labels are left out; without two classes there is no model."""
    names = [c for c in labelled.columns if c.startswith("f_")]
    order = Window.partitionBy("label").orderBy("key", "id", "at", "part")
    rows = labelled.filter("secret IS NOT NULL").select("id", "at", "part", F.col("secret").cast("double").alias("label"), F.xxhash64("id", "at", "part").alias("key"), *names)
    rows = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= FINDINGS_PER_CLASS)
    # the forest draws rows by partition and place: one order makes reruns agree
    rows = cut_lineage(rows.drop("n").repartitionByRange(1, "key"))
    rows = rows.orderBy("key", "id", "at", "part")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, featuresCol="features", labelCol="label")
    return Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), forest]).fit(rows)


def scan(docs: DataFrame, model: PipelineModel | None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None, threshold: float = 0.5) -> DataFrame:
    """``id_col``, ``at``, ``part``, ``candidate``, ``score`` and ``is_secret``, one row per candidate of whole texts.

    ``at`` is the place of the word in its text, ``part`` the place of the candidate in the word. The score is 1 for keys that
    their prefix gives away; without a model also for values of credential names by ``VALUE_FORMS``, and 0 for the rest.
    Null and empty texts give no rows, null ids and paths are allowed, repeated rows give repeated findings. Other columns
    are left out. An empty table gives an empty table.
    """
    found = features(candidates(docs, id_col, text_col, path_col))
    if model is None:
        scored = found.withColumn("score", F.when(value_form(), 1.0).otherwise(0.0))
    else:
        scored = model.transform(found).withColumn("score", vector_to_array("probability")[1])
    scored = scored.withColumn("score", F.when(key_form(), 1.0).otherwise(F.col("score")))
    return scored.select(F.col("id").alias(id_col), "at", "part", "candidate", "score", (F.col("score") >= threshold).alias("is_secret"))


def _any(forms: dict[str, str]) -> str:
    return "|".join(f"(?:{f})" for f in forms.values())


def key_form() -> Column:
    """Candidates that are a key by their own prefix, alone or after a sign."""
    return F.col("candidate").rlike(rf"(?:^|[=/])(?:{_any(KEY_FORMS)})[.]?$") & ~F.col("candidate").rlike(PLACEHOLDER)


def value_form() -> Column:
    """Candidates that are the value of a credential name and look like a secret."""
    value = _named_value(F.col("before2"), F.col("before"), F.col("word"))
    looks = value.rlike(f"^(?:{_any(VALUE_FORMS)})$") & ~value.rlike(PLACEHOLDER)
    return F.coalesce(looks & F.col("candidate").contains(value), F.lit(False))


def no_secret() -> Column:
    """Candidates that are words, numbers, rules, hosts, paths or parts of addresses, without a credential name before them."""
    named = _named_value(F.col("before2"), F.col("before"), F.col("word")).isNotNull()
    address = F.col("word").rlike(r"^[^A-Za-z]*(?:[a-z]+://|www\.)") & ~F.col("word").rlike(r"[?@=]")
    return ~named & (address | F.col("candidate").rlike(f"^(?:{_any(NONE_FORMS)})$"))


def labelled_findings(docs: DataFrame) -> DataFrame:
    """Findings labelled by exact forms that the features do not hold: 1 for keys with a known prefix and for what looks like a
    secret after a credential name, 0 for what is certainly none, null for all others."""
    found = features(candidates(docs, path_col="source"))
    return found.withColumn("secret", F.when(key_form() | value_form(), 1).when(no_secret(), 0))


def model_of(docs: DataFrame) -> PipelineModel | None:
    """Forest from the findings outside the fold that is held out (crc32 of the id, modulo 4, is 2)."""
    return train(labelled_findings(docs.filter(F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 != 2, F.lit(True)))))


@query("op5_secret_scan")
def op5_secret_scan(spark, folder):
    """Every candidate of every document with its score."""
    docs = documents(spark, folder).select("doc_id", "text", "source")
    return scan(docs, model_of(docs), path_col="source").withColumn("candidate", F.sha2("candidate", 256))
