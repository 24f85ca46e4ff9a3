"""Secret scan: candidates by pattern, false positives removed by a random forest. DataFrame
functions and Spark's own forest only; no Python runs on executors.

Candidates are long runs of token characters with a digit, quoted values of eight characters and
more behind ``=`` or ``:``, and whatever stands behind a secret word (``ASSIGNED``) with ``=`` or
``:``, quoted or not, of any length, up to a blank or quote and without closing signs. Their places follow from the texts between them. Each candidate is described by its length,
classes of characters and the transitions between them, how much of it dictionary words cover,
whether it looks like a path, and the words before and after it. A random forest trained from
labelled findings tells secrets from other candidates.

``labelled_findings`` makes the findings that the forest learns from when the caller has none:
``EXAMPLES`` of each kind below, with hashes in place of secrets; a fixed bound.

Defined results: null and empty texts have no candidates; texts of any length are scanned whole;
repeated rows give repeated findings; an empty table gives an empty one. Only ``doc_id`` and
``text`` are read, so further columns can't clash.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.common import KEY, text_key, texts

TOKEN = r"A-Za-z0-9+/_=.\-"
#: Names whose values are candidates whatever they look like.
ASSIGNED = r"pass(?:word|wd|phrase)?|pwd|secret|token|(?:api|access|private|secret|auth)[_-]?key|credentials?"
#: Java looks back a bounded way only: up to three blanks on either side of the sign.
BEHIND = rf"""(?<=[:=]\s{{0,3}}["']?)(?<=(?i:{ASSIGNED})["']?\s{{0,3}}[:=]\s{{0,3}}["']?)"""
CANDIDATE = (
    rf"""{BEHIND}(?<=[:=\s"'])[^\s"']*[^\s"'()\[\]{{}}<>.,;:=]"""
    rf"|(?<![{TOKEN}])(?=[A-Za-z+/_=.\-]*+[0-9])[{TOKEN}]{{16,}}+"
    r"""|(?<=[:=]["'])[^\s"']{8,}+(?=["'])|(?<=[:=] ["'])[^\s"']{8,}+(?=["'])"""
)
NEAR = 40
TREES, DEPTH, SEED, EXAMPLES = 24, 6, 11, 60
LEAST = 0.5
#: Words that make names, paths and sentences rather than secrets.
DICTIONARY = (
    "about after also and api app archive bin build cache class code com commit config content core data date "
    "default description docs document download error example export file files first folder for from function "
    "global home html http https image images import include index info input java key lang lib library license "
    "like line link list local log main make master message model module more name net news node not null number "
    "object online open option order org other output package page path plugin post project public python query "
    "release report request resource resources result return script search section server service session site "
    "source src start static status string style system table template temp test text that the thing this time "
    "title token tree true type update upload user users usr utils value var version view web with word www"
).split()
#: Words that tell what stands next to a candidate.
SECRET_WORDS = ("token", "secret", "passw", "api_key|api-key|apikey", "access", "private", "auth|bearer", "key")
OTHER_WORDS = ("commit|revision|sha|digest|checksum", "version|build|release", "https?:|www|href|src", "uuid|id|ref", "path|file|folder")
WORDS = ", ".join(f"'{w}'" for w in DICTIONARY)
KINDS = (
    # label, text before, candidate by SQL over ``h`` (hex digits of a hash) and ``n``, text after
    (1, 'token = "', "substr(h, 1, 40)", '"'),
    (1, 'TOKEN = "', "upper(substr(h, 1, 40))", '"'),
    (1, "api_key: '", "substr(h, 1, 32)", "'"),
    (1, 'secret="', "substr(b, 1, 40)", '"'),
    (1, "password: \"", "substr(b, 1, 14)", '"'),
    (1, "aws_access_key_id = ", "'AKIA' || upper(substr(h, 1, 16))", " "),
    (1, "Authorization: Bearer ", "'eyJ' || b || '.' || substr(b, 3, 40)", " "),
    (1, "my key is ", "'ghp_' || substr(b, 1, 36)", " "),
    (0, "commit ", "substr(h, 1, 40)", " by"),
    (0, "sha256 digest ", "h", " of the file"),
    (0, "see https://www.example.org/", "'files/archive/' || n || '/index-' || substr(h, 1, 4) || '.html'", " for"),
    (0, "in /usr/lib/", "'python3.' || n % 9 || '/site-packages/module' || n || '/core.py'", " we"),
    (0, "and ", "lpad(conv(substr(h, 1, 12), 16, 10), 16, '4')", " with"),
    (0, "release version ", "n || '.' || n % 7 || '.0-build' || n || '.20240101'", ","),
    (0, "id ", "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 12)", " in"),
    (0, 'title: "', "'report-' || n || '-final-version'", '"'),
    (0, "mail ", "'some.user' || n || '-name.example.com'", " the"),
    (0, 'name = "', "'default_user_value'", '"'),
    (1, "password: ", "substr(b, 1, 8 + n % 7) || '&' || n % 10", " "),
    (1, "password=", "translate(substr(b, 1, 10), '0123456789', '@$!%#^&*~?')", " "),
    (1, "api-key: ", "substr(b, 5, 8)", " "),
    (1, "token=", "translate(substr(b, 1, 34), '0123456789', 'qwertZUIOP')", " "),
    (1, 'secret_key = "', "b || b || b || b || b || b", '"'),
    (0, "password: ", f"element_at(array({WORDS}), int(n % {len(DICTIONARY)}) + 1)", " "),
    (0, "the token: ", f"initcap(element_at(array({WORDS}), int(n * 7 % {len(DICTIONARY)}) + 1))", " and"),
    (0, "secret = ", f"element_at(array({WORDS}), int(n * 5 % {len(DICTIONARY)}) + 1) || '_' || element_at(array({WORDS}), int(n * 3 % {len(DICTIONARY)}) + 1)", " "),
    (0, "token: ", "lower(translate(substr(b, 1, 3 + n % 5), '0123456789', 'aeioulnrst'))", " "),
    (0, "token = ", "element_at(array('None', 'null', 'str', '$TOKEN', '1', '0', 'xxxxxxxx', '********', 'true'), int(n % 9) + 1)", " "),
)


def features(found: DataFrame) -> DataFrame:
    """The findings with their ``features``, from ``candidate``, ``before`` and ``after``."""
    word, size = F.col("candidate"), F.char_length("candidate").cast("double")

    def share(pattern: str) -> Column:
        return 1 - F.char_length(F.regexp_replace(word, pattern, "")) / size

    def near(text: str, pattern: str) -> Column:
        return F.lower(text).rlike(pattern).cast("double")

    columns = {
        "f_size": F.least(size, F.lit(200.0)), "f_digits": share("[0-9]"), "f_upper": share("[A-Z]"),
        "f_lower": share("[a-z]"), "f_hex": share("[0-9A-Fa-f]"), "f_signs": share("[^0-9A-Za-z]"),
        # transitions between classes of characters, of all neighbouring characters
        "f_changes": (F.size(F.regexp_extract_all(
            word, F.lit("(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])|(?<=[a-z])(?=[A-Z])|(?<=[^0-9A-Za-z])(?=[A-Za-z])"),
            F.lit(0))) / size).cast("double"),
        "f_vowels": share("[AEIOUYaeiouy]"),
        "f_kinds": F.size(F.array_distinct(F.split(word, ""))) / F.least(size, F.lit(40.0)),
        "f_words": share(f"(?i)({'|'.join(sorted(DICTIONARY, key=len, reverse=True))})"),
        "f_path": word.rlike(r"^[/.]|/.*/|\.[a-z]{2,4}$").cast("double"),
        "f_dashes": F.size(F.regexp_extract_all(word, F.lit("[-.]"), F.lit(0))).cast("double"),
        "f_given": F.col("before").rlike("[:=]\\s*[\"']?$").cast("double"),
        "f_quoted": F.col("before").rlike("[\"']$").cast("double"),
    }
    columns |= {f"f_secret{i}": near("before", p) for i, p in enumerate(SECRET_WORDS)}
    columns |= {f"f_other{i}": near("before", rf"\b({p})\b") for i, p in enumerate(OTHER_WORDS)}
    columns |= {"f_after": near("after", "^[\"']")}
    ready = found.select("*", *[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in columns.items()])
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(ready).drop(*columns)


def labelled_findings(spark: SparkSession) -> DataFrame:
    """``EXAMPLES`` findings of each kind: ``candidate, before, after, label``."""
    rows = spark.range(EXAMPLES * len(KINDS)).selectExpr(
        f"id div {EXAMPLES} AS kind", "sha2(string(id), 256) AS h", "id AS n",
        "translate(base64(unhex(sha2(string(id), 256))), '+/=', 'xYz') AS b")
    case = lambda values: "CASE kind " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"
    quoted = lambda text: "'" + text.replace("'", "\\'") + "'"
    return rows.selectExpr(
        f"{case([k[2] for k in KINDS])} AS candidate",
        f"concat(CASE n % 3 WHEN 0 THEN 'some text, ' WHEN 1 THEN '' ELSE 'of the ' END, {case([quoted(k[1]) for k in KINDS])}) AS before",
        f"{case([quoted(k[3]) for k in KINDS])} AS after",
        f"{case([f'{k[0]}.0D' for k in KINDS])} AS label")


def train(findings: DataFrame) -> RandomForestClassificationModel:
    """A forest from labelled findings (``candidate, before, after, label``). The caller bounds
    their number; they must hold both labels."""
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird")
    return forest.fit(features(findings).select("features", "label"))


def candidates(documents: DataFrame) -> DataFrame:
    """``doc_id, text_key, begin, next, candidate, before, after`` of all candidates."""
    rows = (
        texts(documents).where(F.col("text").rlike(CANDIDATE))
        .select(
            "doc_id", text_key().alias(KEY), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("hits"),
            F.split("text", CANDIDATE, -1).alias("parts"))
    )
    sizes = F.zip_with(
        F.transform("parts", F.char_length), F.transform("hits", F.char_length),
        lambda part, hit: part + F.coalesce(hit, F.lit(0)))
    return (
        rows.withColumn("sizes", sizes)
        .select("doc_id", KEY, "hits", "parts", "sizes", F.posexplode("hits").alias("i", "candidate"))
        .select(
            "doc_id", KEY, "candidate",
            (F.aggregate(F.slice("sizes", 1, F.col("i")), F.lit(0), lambda a, b: a + b)
             + F.char_length(F.get("parts", F.col("i")))).alias("begin"),
            F.right(F.get("parts", F.col("i")), F.lit(NEAR)).alias("before"),
            F.left(F.get("parts", F.col("i") + 1), F.lit(NEAR)).alias("after"))
        .withColumn("next", F.col("begin") + F.char_length("candidate"))
    )


def scan(documents: DataFrame, forest: RandomForestClassificationModel | None = None) -> DataFrame:
    """All candidates with the forest's ``score`` and whether it takes them for a ``secret``:
    ``doc_id, text_key, begin, next, candidate, score, secret``."""
    forest = forest or train(labelled_findings(documents.sparkSession))
    scored = forest.transform(features(candidates(documents)))
    return scored.select(
        "doc_id", KEY, "begin", "next", "candidate",
        vector_to_array("probability")[1].alias("score"),
    ).withColumn("secret", F.col("score") >= LEAST)
