"""Secret scan: candidates from native expressions, false positives removed by a random forest.

A candidate is a value of six or more letters, whatever they are, that is assigned to a telling name, or else a run
of sixteen or more key letters with a digit in it, perhaps the value of another assignment.
Its features are its length, character transitions, dictionary coverage, whether it looks like a path, and the
words around it. A random forest over them tells secrets from hashes in passing, identifiers, numbers and paths.

Findings are labelled by two kinds of plain evidence. Secret: the value has a provider's prefix, or it is
assigned to a name like ``password`` or ``token`` and more than a word. No secret: it is all digits, a path or address, a placeholder, or
stands after a word like ``commit`` or ``sha256``. Only labelled findings train the forest; the rest are scored by
it. Each trains it twice, once as it stands and once with what stands before it hidden, so that the forest learns to judge
by the value alone where no name tells.

The dictionary is the corpus' own: words that stand by themselves, without digits, ``LEAST_USES`` times and once in every
``DOCS_PER_USE`` documents, counted over all texts. Coverage is the share of a value's letters in such words; a value is cut into
words where the case changes and at whatever is no letter.

All of it is DataFrame expressions and the JVM's forest; no Python runs in tasks.

Defined results: a null or empty text has no candidates. Without labelled findings of both sorts the score of a
finding is 1 or 0 by its label, and 0.5 if it has none. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.llm.common import text_or_empty
from metricloom.session import materialize

LEAST_LETTERS = 16
LEAST_ASSIGNED = 6
TREES = 20
DEPTH = 6
SEED = 42
AROUND = 40
# The forest learns from at most this many findings of each sort, those with the smallest hash.
MAX_ROWS = 50_000

KEY_LETTERS = r"[A-Za-z0-9+/=_.\-]"
# Names that tell of a secret, without words that only begin like them.
TELLING = r"(?i:pass(?!age|eng|ion|ive|port)|pwd|secret(?!ar)|token|api[_-]?key|access[_-]?key|auth(?!or)|credential)"
TOLD = rf"{TELLING}[A-Za-z_\"']{{0,32}}\s{{0,8}}(?:=>|:=|=|:)\s{{0,8}}[\"'`]?"
# A value goes on to a blank, a quote, or the next name of a query string; the signs that end a clause are not its last.
VALUE = rf"(?:(?!&[A-Za-z_.\-]+=)[^\s\"'`]){{{LEAST_ASSIGNED - 1},}}[^\s\"'`.,;:)\]}}>&]"
# A bare run ends where a telling name with a value begins. It is tried at its first letter only, as no later start fits better.
BARE = rf"(?<!{KEY_LETTERS})(?=(?:(?!{TOLD}{VALUE})[A-Za-z+/=_.\-])*+(?!{TOLD}{VALUE})[0-9])(?:(?!{TOLD}{VALUE}){KEY_LETTERS}){{{LEAST_LETTERS},}}+"
RUN = rf"{TOLD}{VALUE}|{BARE}"
# Prefixes of providers' keys.
PROVIDER = r"^(AKIA[A-Z0-9]{16}|ASIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})$"
ASSIGNED = r"(?i)(pass(word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)[a-z_\"']*\s*(=|:|=>|:=)\s*[\"']?$"
HARMLESS_BEFORE = r"(?i)(commit|revision|sha-?1|sha-?256|md5|checksum|digest|hash|uuid|version)[\s:=\"']*$"
PLACEHOLDER = r"(?i)(example|sample|changeme|placeholder|your[_-]|xxxx|0000|1234567|abcdef)"
# A word of a value: lower case, perhaps after one capital, or capitals alone.
PIECE = r"\p{Lu}?\p{Ll}{2,}|\p{Lu}{3,}"
WORD = r"^\p{L}{3,20}$"
LEAST_USES = 5
DOCS_PER_USE = 1000
# Findings of one value are dealt into so many parts where coverage is joined to them.
SALTS = 16

NAME = rf"^({TOLD}|[A-Za-z_.\-]*=(?!=))"

FEATURES = [
    "length", "digit_share", "upper_share", "lower_share", "hex_share", "case_changes", "kind_changes", "distinct_share",
    "longest_same", "dictionary_share", "vowel_share", "slashes", "dots", "separators", "assigned_near", "quoted", "key_word_near",
    "hash_word_near", "path_near", "words_before",
]
# What tells of the text before a value.
NEAR = ["assigned_near", "quoted", "key_word_near", "hash_word_near", "path_near", "words_before"]


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, start, before, value, after``: one row per candidate; ``start`` counts code points from 0.

    The text is cut at every run, so a run begins where the lengths of all that stands before it add up to.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text")).where(F.col("text").rlike(RUN))
    cut = texts.select("doc_id", F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1)).alias("runs"), F.split("text", RUN, -1).alias("between"))
    parts = F.transform(
        F.col("runs"),
        lambda run, n: F.struct(
            run.alias("value"),
            F.length(F.get("between", n)).alias("gap"),
            F.right(F.concat(F.coalesce(F.get("runs", n - 1), F.lit("")), F.get("between", n)), F.lit(AROUND)).alias("before"),
            F.left(F.get("between", n + 1), F.lit(AROUND)).alias("after"),
        ),
    )
    # The row's number is taken in a step of its own: beside the generator, it would count the exploded rows.
    numbered = cut.select("doc_id", parts.alias("parts")).withColumn("row", F.monotonically_increasing_id())
    each = numbered.select("doc_id", "row", F.posexplode("parts").alias("n", "part")).select("doc_id", "row", "n", "part.*")
    upto = Window.partitionBy("row").orderBy("n")
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    return each.select("doc_id", (end - F.length("value")).alias("start"), "before", "value", "after")


def split_assignment(found: DataFrame) -> DataFrame:
    """A run such as ``password=...`` is a name and a value; the name joins what stands before."""
    name = F.regexp_extract("value", NAME, 1)
    told = F.col("value").rlike(rf"^{TOLD}{VALUE}$")
    split = found.withColumns(
        {
            "before": F.concat("before", name),
            "start": F.col("start") + F.length(name),
            "value": F.regexp_replace("value", NAME, ""),
            "told": told,
        }
    )
    return split.where(F.col("told") | (F.length("value") >= LEAST_LETTERS)).drop("told")


def with_coverage(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Candidates with ``dictionary_share``. Texts are counted in tasks before the shuffle; of all words only those of candidates go on."""
    values = materialize(found.select("value").distinct(), "secret-values")
    pieces = values.select("value", F.explode(F.regexp_extract_all("value", F.lit(PIECE), F.lit(0))).alias("piece")).select("value", F.lower("piece").alias("word"))
    uses = docs.select(F.explode(F.split(F.lower(text_or_empty()), r"[^\p{L}\p{N}]+")).alias("word")).where(F.col("word").rlike(WORD)).groupBy("word").count()
    common = uses.where((F.col("count") >= LEAST_USES) & (F.col("count") * DOCS_PER_USE >= docs.count())).select("word")
    dictionary = materialize(common.join(pieces.select("word").distinct(), "word", "left_semi"), "secret-dictionary")
    covered = pieces.join(dictionary, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    dealt = covered.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SALTS)).cast("int"))
    share = F.coalesce(F.col("covered") / F.length("value"), F.lit(0.0))
    return salted.join(dealt, ["value", "salt"], "left").withColumn("dictionary_share", share).drop("salt", "covered")


def share(pattern: str) -> Column:
    return (F.length("value") - F.length(F.regexp_replace("value", pattern, ""))) / F.length("value")


def described(found: DataFrame) -> DataFrame:
    """Candidates with their features."""
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "l"), "[A-Z]", "u"), "[0-9]", "d")
    changes = F.regexp_count(kinds, F.lit("(?=lu|ul)"))
    all_changes = F.regexp_count(kinds, F.lit("(?=lu|ul|ld|dl|ud|du)"))
    letters = F.filter(F.split("value", ""), lambda c: c != "")
    same = F.regexp_extract_all("value", F.lit(r"((.)\2*)"), F.lit(1))
    value, before = F.col("value"), F.col("before")
    has = lambda column, pattern: column.rlike(pattern).cast("double")
    columns: dict[str, Column] = {
        "length": F.log1p(F.length("value")),
        "digit_share": share("[0-9]"),
        "upper_share": share("[A-Z]"),
        "lower_share": share("[a-z]"),
        "hex_share": share("[0-9a-f]"),
        "case_changes": changes / F.length("value"),
        "kind_changes": all_changes / F.length("value"),
        "distinct_share": F.size(F.array_distinct(letters)) / F.least(F.length("value"), F.lit(36)),
        "longest_same": F.array_max(F.transform(same, F.length)).cast("double"),
        "vowel_share": share("[aeiouAEIOU]"),
        "slashes": share("/"),
        "dots": share(r"\."),
        "separators": share(r"[_\-]"),
        "assigned_near": has(before, r"[=:]\s*[\"']?$"),
        "quoted": has(before, r"[\"'`]$"),
        "key_word_near": has(before, r"(?i)(key|secret|token|pass|pwd|auth|cred)"),
        "hash_word_near": has(before, r"(?i)(commit|sha|md5|hash|digest|uuid|version)"),
        "path_near": has(before, r"(/|\\|://)\S*$"),
        "words_before": F.regexp_count("before", F.lit(r"[A-Za-z]{2,}")).cast("double"),
    }
    # A mere word after such a name may be prose: the forest judges it.
    is_secret = value.rlike(PROVIDER) | (before.rlike(ASSIGNED) & value.rlike("[^A-Za-z.\\-]"))
    harmless = value.rlike(r"^[0-9.\-]+$") | value.rlike(r"^(/|\.{1,2}/|www\.|[a-z]+://)|\.(com|org|net|html?|py|js|png|jpg)\b") | value.rlike(PLACEHOLDER) | before.rlike(HARMLESS_BEFORE)
    label = F.when(harmless, 0.0).when(is_secret, 1.0)
    return found.withColumns({**{k: v.cast("double") for k, v in columns.items()}, "label": label})


def hidden(sample: DataFrame) -> DataFrame:
    """Labelled findings as if nothing stood before their values."""
    return sample.withColumns({name: F.lit(0.0) for name in NEAR})


def scan(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, start, end, value_sha256, known, score, is_secret`` for every candidate.

    ``known`` is the label by plain evidence, null without any. The values themselves are not passed on.
    """
    values = materialize(split_assignment(candidates(docs)), "secret-values-found")
    found = materialize(described(with_coverage(values, docs)), "secret-candidates")
    order = (F.xxhash64("value", "before"), "doc_id", "start")
    sample = found.where("label = 0").orderBy(*order).limit(MAX_ROWS).unionByName(found.where("label = 1").orderBy(*order).limit(MAX_ROWS))
    sample = materialize(sample.select("label", *FEATURES), "secret-sample")
    place = ("doc_id", "start", (F.col("start") + F.length("value")).alias("end"), F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), F.col("label").cast("int").alias("known"))
    if sample.select("label").distinct().count() < 2:
        scored = found.select(*place, F.coalesce("label", F.lit(0.5)).alias("score"))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
        model = forest.fit(vectors.transform(sample.unionByName(hidden(sample))))
        scored = model.transform(vectors.transform(found)).select(*place, vector_to_array("probability")[1].alias("score"))
    return scored.withColumn("is_secret", F.col("score") >= threshold)
