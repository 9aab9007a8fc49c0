"""Secret scans: candidates by pattern, false positives removed by a random forest. DataFrame functions only.

A candidate is a word (between white space) that is, but for quotes and a ``name=`` before it, a run of at least
LEAST characters of keys and tokens with a digit, or of 16 or more capitals. A word that is more than this is searched
for such runs between other signs, for passwords in urls, and for values after a name and = or :, which may hold signs
up to their closing quote or separator; the name may also be the word before. A value whose name speaks of secrets
(SECRET_NAMES) in the same word needs no digit. The forest sees its length, the
transitions between lower case, upper case, digits and signs, the share of each, of distinct characters and of
hexadecimal ones, how much of it dictionary words cover, marks of test data in its path, and the neighbouring words. The
dictionary is what stands as a word in at least DICTIONARY_DOCS documents of the corpus. The forest is trained by Spark
from labelled findings, which go through the same steps.

Defined results: null and empty texts have no candidates; texts and words of any length are searched whole; a missing or
null path has no marks; each occurrence is a finding, so rows that repeat find the same again, and equal findings get equal
scores; a forest that is as sure of either class says secret; an empty table has no findings; further columns are not
read.
"""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_or_null, narrow, saved, table

LEAST = 8
DICTIONARY_DOCS, DICTIONARY_LETTERS = 5, 4
LABELLED_ROWS = 100_000
TREES, TREE_DEPTH = 40, 6
SPACE = r"[\x20\x09-\x0D]+"

_NAME = r"[A-Za-z0-9_\-.]"
_SIGNED = r"""[^\s"'`\\<>(){}\[\],;&=]|&(?!%s+=)""" % _NAME
#: Within a word: the password of a url (1), a name (2) with a value in quotes (3) or without (4), or a run by itself (5), which is no part of a mail address.
INSIDE = "|".join([
    r"""(?<![A-Za-z0-9+.\-])[A-Za-z][A-Za-z0-9+.\-]*+://[^/:@\s]*+:([^/\s"'<>,;]{%d,})@""" % LEAST,
    r"""(?<!%s)(?=[0-9.\-]*+[A-Za-z_])(%s++)\\?["'`]?[=:]++(?!//)(?:\\?["'`]([^"'`\\=]{%d,}+={0,2})(?=\\?["'`]|$)|((?:%s){%d,}+={0,2}))""" % (_NAME, _NAME, LEAST, _SIGNED, LEAST),
    r"""(?<![A-Za-z0-9+/_\-.~@])([A-Za-z0-9+/_\-.~]{%d,}+={0,2})(?!@)""" % LEAST,
])

# Words beside a secret, words beside other identifiers, and words that mark placeholders and test data.
SECRET_WORDS = "password passwd pwd secret token key apikey api_key access_key secret_key auth authorization bearer credential credentials private client_secret".split()
OTHER_WORDS = "commit sha sha1 sha256 md5 checksum hash digest uuid guid id version phone tel fax card invoice order isbn build revision etag".split()
FAKE_WORDS = ("example", "sample", "dummy", "test", "changeme", "placeholder", "your", "xxxx", "fixture", "mock", "redacted", "1234567")
#: Names whose values are candidates without a digit too, before = or :.
SECRET_NAMES = "(?:passw|passphrase|pwd|secret(?!ar|ly|ion)|token(?!iz)|api_?key|access_?key|auth(?!or(?!iz))|credential)"
_NAMED = r"""(?i)%s[A-Za-z0-9_.\-]{0,32}\\?["'`]?[=:]""" % SECRET_NAMES
PLAUSIBLE = "[0-9]|[A-Z]{16}|" + _NAMED
#: Beginnings that issuers give their keys.
ISSUED = r"^(?:AKIA|ASIA|ghp_|gho_|xox[abp]-|sk_live_|AIza|glpat-|eyJ)"

FEATURES = ["length", "transitions", "digits", "upper", "lower", "hexadecimal", "distinct", "issued", "coverage", "fake_path", "secret_near", "other_near", "fake_near", "named", "dots"]


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, path, word (its place among the text's words), name, value, before and after (two neighbours each side)."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(F.when(F.rlike(text, F.lit(r"[0-9]|[A-Z]{16}|(?i)%s[^\s=:]{0,40}\s?[=:]" % SECRET_NAMES)), text).otherwise(F.lit("")), SPACE), lambda w: w != "")
    placed = docs.select(F.col("doc_id").cast("long"), column_or_null(docs, "path", "string").alias("path"), words.alias("w"))
    # Cheap test first: most words are short, or have no digit and no name of a secret.
    plausible = F.filter(
        F.transform("w", lambda w, i: F.when((F.length(w) >= LEAST) & F.rlike(w, F.lit(PLAUSIBLE)), F.struct(i.alias("i"), w.alias("w")))), lambda s: s.isNotNull()
    )
    found = placed.where(F.size(plausible) > 0).select("doc_id", "path", "w", F.explode(plausible).alias("s"))
    shape = r"""^[\"'(\[{<`]*(?:([A-Za-z_][A-Za-z0-9_\-.]*)[=:]+[\"'`]?)?([A-Za-z0-9+/_\-.~]{%d,}=*)[\"')\]}>`,;:.!?]*$""" % LEAST
    i = F.col("s.i")

    def at(k: int) -> Column:
        return F.coalesce(F.lower(F.get("w", i + k)), F.lit(""))

    # A name and its = or : may be words of their own.
    ahead = F.when(at(-1).rlike("^[=:]+$"), F.concat(at(-2), at(-1))).otherwise(at(-1))
    text = F.concat(F.regexp_extract(ahead, r"""%s{1,64}["'`]?[=:]+$""" % _NAME, 0), F.col("s.w"))
    title = F.regexp_extract(ahead, r"""(%s{1,64})["'`]?[=:]+$""" % _NAME, 1)
    parts = F.arrays_zip(*[F.regexp_extract_all(text, F.lit(INSIDE), F.lit(k)).alias(f"g{k}") for k in range(1, 6)])

    def part(g: Column) -> Column:
        name = F.when(g["g1"] != "", F.lit("password")).otherwise(F.regexp_replace(g["g2"], r"^[0-9.\-]+", ""))
        return F.struct(name.alias("name"), F.regexp_replace(F.concat(*[g[f"g{k}"] for k in (1, 3, 4, 5)]), r"[.:?]+$", "").alias("value"))

    own = F.regexp_extract("s.w", shape, 1)
    whole = F.array(F.struct(F.when(own != "", own).otherwise(title).alias("name"), F.regexp_replace(F.regexp_extract("s.w", shape, 2), r"\.+$", "").alias("value")))
    cut = found.select(
        "doc_id", "path", i.cast("long").alias("word"), F.explode(F.when(F.rlike("s.w", F.lit(shape)), whole).otherwise(F.transform(parts, part))).alias("c"),
        F.array(at(-2), at(-1)).alias("before"), F.array(at(1), at(2)).alias("after"),
    ).select("doc_id", "path", "word", F.lower("c.name").alias("name"), "c.value", "before", "after")
    likely = F.rlike("value", F.lit("[0-9]")) | F.rlike("value", F.lit("^[A-Z]{16,}$")) | F.rlike("name", F.lit(SECRET_NAMES))
    return cut.where((F.length("value") >= LEAST) & likely)


def letter_runs(value: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(value), F.lit(f"([a-z]{{{DICTIONARY_LETTERS},}})"), 1))


def dictionary(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Of the runs in ``wanted`` (run), those that are words of at least DICTIONARY_DOCS documents; counts all documents."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+"), lambda w: F.length(w) >= DICTIONARY_LETTERS))
    each = docs.select(F.explode(words).alias("run")).join(narrow(wanted), "run", "left_semi")
    return each.groupBy("run").count().where(F.col("count") >= DICTIONARY_DOCS).select("run")


def _share(value: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{kind}]", "")) / F.length(value)


def _any(words: Column, listed: list[str]) -> Column:
    bare = F.transform(words, lambda w: F.regexp_replace(w, r"^[^a-z0-9]+|[^a-z0-9]+$", ""))
    return F.exists(bare, lambda w: w.isin(listed)).cast("double")


def _fake(c: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in FAKE_WORDS]).cast("double")


def with_features(found: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates with a column for each of FEATURES; ``known`` (run) holds dictionary words."""
    values = found.select("value").distinct()
    runs = values.select("value", F.explode(letter_runs(F.col("value"))).alias("run")).join(narrow(known), "run")
    covered = saved(runs.groupBy("value").agg(F.sum(F.length("run")).alias("covered")), "secret-coverage")
    joined = found.join(narrow(covered), "value", "left")
    v = F.col("value")
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    near = F.concat(F.array(F.col("name")), F.split("name", "[_.-]"), F.col("before"))
    both = F.concat(near, F.col("after"))
    n = F.length(v)
    return joined.withColumns({
        "length": F.least(n, F.lit(128)).cast("double"),
        "transitions": (F.length(F.regexp_replace(shape, r"(.)\1+", "$1")) - 1) / n,
        "digits": _share(v, "0-9"), "upper": _share(v, "A-Z"), "lower": _share(v, "a-z"),
        "hexadecimal": F.rlike(v, F.lit("^(?:[0-9a-f]+|[0-9A-F]+)$")).cast("double"),
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "issued": F.rlike(v, F.lit(ISSUED)).cast("double"),
        "coverage": F.least(F.coalesce(F.col("covered"), F.lit(0)) / n, F.lit(1.0)),
        "fake_path": _fake(F.lower(F.coalesce("path", F.lit("")))),
        "secret_near": _any(near, SECRET_WORDS), "other_near": _any(both, OTHER_WORDS),
        "fake_near": _fake(F.concat_ws(" ", both, F.lower(v))),
        "named": (F.col("name") != "").cast("double"), "dots": F.rlike(v, F.lit("[./]")).cast("double"),
    }).drop("covered")


def labelled_findings(spark: SparkSession, each: int = 25, seed: int = 7) -> DataFrame:
    """text, path, label: ``each`` findings of every kind below, one candidate in a text; made by rule from a seed."""
    rng = random.Random(seed)

    def of(alphabet: str, n: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(n))

    hexa, digit, cap = "0123456789abcdef", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    base32, word = cap + "234567", cap + cap.lower() + digit

    def typed() -> str:
        """As people make them up: a word, a sign, digits."""
        return of(cap, 1) + of(cap.lower() + "@0", rng.randint(4, 7)) + of("!@#$_&", 1) * rng.randint(0, 1) + of(digit, rng.randint(2, 5))

    def plain() -> str:
        return of(cap.lower() + digit * 2, rng.randint(7, 13)) + of(digit, 1)

    kinds = [
        (1, "src", lambda: f"the AKIA{of(base32, 16)} of"), (1, "src", lambda: f"{of(cap.lower(), 5)} AKIA{of(cap + digit, 16)} {of(cap.lower(), 3)}"),
        (1, "conf", lambda: f"and password={of(hexa, 18)} was"), (1, "src", lambda: f"db password: {of(word, rng.randint(12, 20))} end"),
        (1, "src", lambda: f'on token = "{of(hexa, 40)}" the'), (1, "src", lambda: f"api_key={of(word, 32)}"),
        (1, "src", lambda: f"secret_key = '{of(word + '+/', 40)}' in"), (1, "conf", lambda: f"auth ghp_{of(word, 36)} here"),
        (1, "src", lambda: f"stripe sk_live_{of(word, 24)}"), (1, "src", lambda: f"bearer eyJ{of(word, 60)} sent"),
        (0, "src", lambda: f"call 555-{of(digit, 4)} now"), (0, "src", lambda: f"the {of('45', 1)}{of(digit, 15)} are"),
        (0, "src", lambda: f"from {rng.randint(11, 255)}.{rng.randint(10, 255)}.{rng.randint(10, 255)}.{rng.randint(10, 255)} to"), (0, "src", lambda: f"commit {of(hexa, 40)} fixes"),
        (0, "src", lambda: f"md5 checksum {of(hexa, 32)} ok"), (0, "src", lambda: f"id {of(hexa, 8)}-{of(hexa, 4)}-4{of(hexa, 3)}-a{of(hexa, 3)}-{of(hexa, 12)}"),
        (0, "src", lambda: f"on 20{of('12', 1)}{of(digit, 1)}-0{of(digit[1:], 1)}-1{of(digit, 1)}T10:00 in"), (0, "docs", lambda: f"password=your_password_{of(digit, 2)} here"),
        (0, "tests", lambda: f"token = \"{of(hexa, 40)}\" in"), (0, "docs", lambda: f"api_key=example{of(digit, 6)}"),
        (0, "src", lambda: f"release version {rng.randint(1, 9)}.{rng.randint(1, 30)}.{rng.randint(10, 300)}-rc{of(digit, 1)} out"), (0, "src", lambda: f"see report_20{of(digit, 2)}_final.pdf for"),
        (0, "src", lambda: f"{of(cap.lower(), 4)} {of(digit, 12)} and"), (0, "src", lambda: f"part {of(cap, 2)}-{of(digit, 5)}-{of(cap, 2)} sold"),
        (1, "src", lambda: f'{{"password":"{of(word, rng.randint(10, 18))}"}}'), (1, "conf", lambda: f"https://{of(cap.lower(), 4)}:{of(word, rng.randint(10, 18))}@db.org"),
        (1, "src", lambda: f'connect(password="{of(word + "!#%", rng.randint(10, 18))}")'), (1, "src", lambda: f"GET /q?x=1&token={of(hexa, 20)} of"),
        (1, "conf", lambda: f"password={of(cap.lower(), rng.randint(12, 20))} was"), (1, "src", lambda: f'"secret": "{of(word + "$!#", 14)}"'),
        (1, "conf", lambda: f"password={typed()} was"), (1, "src", lambda: f"pwd = {typed()};"), (1, "src", lambda: f'login(password="{plain()}")'),
        (1, "src", lambda: f"https://{of(cap.lower(), 3)}:{plain()}@{of(cap.lower(), 4)}.org/x"), (1, "src", lambda: f'"token":"{plain()}"'),
        (0, "src", lambda: f'{{"commit":"{of(hexa, 40)}"}}'), (0, "src", lambda: f'{{"version":"{rng.randint(1, 9)}.{rng.randint(10, 30)}.{rng.randint(10, 300)}-beta"}}'),
        (0, "src", lambda: f"GET /q?x=1&page={of(digit, 8)} of"), (0, "docs", lambda: f'{{"password":"your_password_{of(digit, 1)}"}}'),
        (0, "tests", lambda: f"https://test:{of(word, 12)}@example.org"), (0, "src", lambda: f"order(invoice=\"{of(digit, 10)}\")"),
        (0, "src", lambda: f"the {of(cap.lower(), rng.randint(7, 14))}{of(digit, 1)} of"), (0, "src", lambda: f"www.{of(cap.lower(), 6)}{of(digit, 2)}.org/page{of(digit, 2)} is"),
    ]
    rows = [(make(), f"{where}/file", label) for label, where, make in kinds for _ in range(each)]
    return spark.createDataFrame(rows, "text string, path string, label int")


def _assembled(rows: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)


def train(labelled: DataFrame, known: DataFrame, rows: int = LABELLED_ROWS):
    """A forest from labelled findings (text, path, label), ``rows`` of them at most, chosen by hash; a text has one candidate."""
    from pyspark.ml.classification import RandomForestClassifier

    chosen = labelled.where("text is not null and label is not null").orderBy(F.xxhash64("text"), "text", "path").limit(rows)
    texts = saved(chosen.select(F.monotonically_increasing_id().alias("doc_id"), "text", "path", F.col("label").cast("double").alias("label")), "labelled-findings")
    found = with_features(candidates(texts), known).join(texts.select("doc_id", "label"), "doc_id")
    made = saved(found.select("label", *FEATURES), "labelled-features")
    forest = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=TREE_DEPTH, seed=11, cacheNodeIds=False)
    return forest.fit(_assembled(made))


def scan(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """Every candidate of the documents with its features, score and is_secret."""
    from pyspark.ml.functions import vector_to_array

    found = saved(candidates(docs), "secret-candidates")
    examples = labelled.select(F.lit(0).alias("doc_id"), "text", "path")
    runs = found.select("value").unionByName(candidates(examples).select("value")).select(F.explode(letter_runs(F.col("value"))).alias("run")).distinct()
    known = saved(dictionary(docs, saved(runs, "secret-runs")), "secret-dictionary")
    model = train(labelled, known)
    out = model.transform(_assembled(with_features(found, known)))
    chance = F.element_at(vector_to_array("probability"), 2)
    return out.withColumn("score", chance).withColumn("is_secret", (chance >= 0.5).cast("int")).drop("_features", "rawPrediction", "probability", "prediction")


def op6(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("source").alias("path"))
    found = scan(docs, labelled_findings(spark))
    return found.select("doc_id", "word", "name", F.length("value").cast("long").alias("n_chars"), F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score", "is_secret")
