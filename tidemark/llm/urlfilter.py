"""URL filters: host and path rules first, and for the rest logistic regression on hashed character n-grams.

All in DataFrame functions. Weights are learned from a small labelled URL table (LABELLED_ROWS at most) by Spark's own
logistic regression and enter the query as one literal array, so judging a page is one projection without a shuffle.
The labelled urls are made by rule from words that stand in hosts and paths of sites to block and of others, and from
made-up names without meaning, which are allowed: what the model has no evidence on is not blocked.

Defined results: a null url or one without ``://`` has empty host and path and fits no rule; without n-grams the score
is the model's intercept; of rules that fit, the longest (host and path together) wins, of equally long ones that with
the longer host, and of two for one host and path the one that blocks, in whatever order and number rules are given; urls
of any length are read whole; rows that repeat are judged one by one; an empty table gives no rows; further columns are
kept but for those named like the operator's own.
"""

from __future__ import annotations

import json
import random

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, narrow, saved, table

# Fixed values: (host, path, verdict). A rule fits its host and all subdomains where the url's path starts with its own.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: With more rules than this they are joined on the host and not tried one by one.
INLINE_RULES = 1000

# Words of sites to block, of their paths, and of other sites and their paths.
BLOCK_HOSTS = (
    "adserver adult affiliate ads bets betting bingo bitcoin-doubler bonus cams casino cheap cialis clickbait counterfeit crack "
    "crypto-doubler debt diet-pills doubler escort free-money gamble giveaway hookup jackpot keygen loans lottery malware meds "
    "nude payday pharmacy phishing pills poker popunder porn prize replica roulette seo-links slots spam spam-farm spyware "
    "steroids sweepstakes torrent tracker tracking viagra warez webcam win winner xxx"
).split()
BLOCK_PATHS = "bonus buy-now cheap claim click download-crack earn free invest live-cams offer order play prize redirect signup-bonus spin track verify-account win".split()
ALLOW_HOSTS = (
    "airport archive art astronomy bakery bank bbc biology books botany bridge cathedral chemistry chess cinema city clinic "
    "coffee college community council court cricket cycling database dictionary docs economics encyclopedia engineering football "
    "forest forum gallery garden gazette geology government guardian harbour health history hospital hotel insurance journal "
    "kitchen language law library linux magazine maps math mountain museum music nature news observatory ocean orchestra "
    "parliament philosophy photo physics poetry post press python radio railway recipes research river school science society "
    "software space sport station stories tennis theatre times travel university village weather wiki zoo"
).split()
ALLOW_PATHS = "about articles blog contact courses de/art en/guide events fr/histoire help history index.html library news papers posts products questions reviews sport topics wiki".split()
ENDINGS = "com org net info co.uk de fr io eu biz".split()


def made_urls(seed: int = 5, block: list[str] | None = None, allow: list[str] | None = None, each: int = 6) -> list[tuple[str, int]]:
    """Labelled urls (1: block): ``each`` of every host word, and as many of made-up names as of words to allow; made by rule from a seed."""
    rng = random.Random(seed)

    def url(host: str, paths: list[str]) -> str:
        path = rng.choice(["", "/", f"/{rng.choice(paths)}", f"/{rng.choice(paths)}/{rng.randint(1, 9999)}", f"/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randint(1, 9999)}"])
        tail = rng.choice(["", "", "", "?page=2", "#top", f"?id={rng.randint(1, 99)}"])
        return f"{rng.choice(['http', 'https'])}://{rng.choice(['', '', 'www.', 'm.', 'blog.'])}{host}.{rng.choice(ENDINGS)}{path}{tail}"

    def host(word: str, others: list[str]) -> str:
        return rng.choice([word, f"{word}{rng.randint(1, 99)}", f"{word}-{rng.choice(others)}", f"{rng.choice(others)}-{word}", f"{word}{rng.choice(others)}", f"{word}.example"])

    def name() -> str:
        return "".join(rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiou") + rng.choice(["", "", "n", "r", "s", "t", "th", "l"]) for _ in range(rng.randint(2, 4)))

    block, allow = block or BLOCK_HOSTS, allow or ALLOW_HOSTS
    urls = [(url(host(w, block), BLOCK_PATHS + ALLOW_PATHS), 1) for w in block for _ in range(each)]
    urls += [(url(host(w, allow), ALLOW_PATHS), 0) for w in allow for _ in range(each)]
    urls += [(url(rng.choice([name(), f"{name()}.example", f"{name()}-{rng.choice(allow)}"]), ALLOW_PATHS), 0) for _ in allow for _ in range(each)]
    return urls


SIZES = (3, 4, 5)
WIDTH = 1 << 12
LABELLED_ROWS = 10_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; then up to ``?``, ``#`` or the end."""
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise(F.lit(""))
    return lower_ascii(F.regexp_extract(after, r"^[^/?#]*", 0)), F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def grams(field: str, text: Column) -> Column:
    """Hashed n-grams of a text between ^ and $, apart for each field."""
    # The characters are an array of their own: a substring would count from the text's beginning each time.
    marked = F.regexp_extract_all(F.concat(F.lit("^"), text, F.lit("$")), F.lit("(?s)."), F.lit(0))

    def of(n: int, chars: Column) -> Column:
        starts = F.when(F.size(chars) >= n, F.sequence(F.lit(0), F.size(chars) - n)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(field), F.concat(*[F.get(chars, i + k) for k in range(n)])), F.lit(WIDTH)).cast("int"))

    # An array of one, so that its item is made once and not for each n-gram.
    return F.flatten(F.transform(F.array(marked), lambda chars: F.concat(*[of(n, chars) for n in SIZES])))


def features(url: Column) -> Column:
    """Distinct buckets of a url's n-grams. Digits count as one sign: numbers of pages say nothing."""
    host, path = host_and_path(url)
    return F.array_distinct(F.concat(grams("host", host), grams("path", F.regexp_replace(path, "[0-9]+", "0"))))


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(made_urls(), "url string, label int")


def train(labelled: DataFrame, rows: int = LABELLED_ROWS) -> tuple[list[float], float]:
    """Weights and intercept from url and label (1: block), learned from ``rows`` of them at most, chosen by hash."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    chosen = labelled.where("label is not null").orderBy(F.xxhash64("url"), "url", "label").limit(rows)
    # Saved, so that the n-grams are made once and not for each of the WIDTH places of a vector.
    found = saved(chosen.select(F.col("label").cast("double").alias("label"), features(F.col("url")).alias("found")), "labelled-urls")
    held = F.transform(F.sequence(F.lit(0), F.lit(WIDTH - 1)), lambda i: F.array_contains("found", i).cast("double"))
    made = found.select("label", array_to_vector(held).alias("features"))
    model = LogisticRegression(maxIter=50, regParam=0.002, standardization=False).fit(made)
    return [float(w) for w in model.coefficients.toArray()], float(model.intercept)


def score(url: Column, weights: list[float], intercept: float) -> Column:
    """Probability that a url is to be blocked."""
    known = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    total = F.aggregate(features(url), F.lit(float(intercept)), lambda s, i: s + F.element_at(known, i + 1))
    return 1 / (1 + F.exp(-total))


def _fits(host: Column, path: Column, rule_host: Column, rule_path: Column) -> Column:
    return ((host == rule_host) | F.endswith(host, F.concat(F.lit("."), rule_host))) & F.startswith(path, rule_path)


def ruled(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """``pages`` (with host and path) and _rule, a struct of the winning rule and its verdict, or null."""
    if isinstance(rules, DataFrame):
        listed = [tuple(r) for r in rules.select("host", "path", "verdict").limit(INLINE_RULES + 1).collect()]
        if len(listed) > INLINE_RULES:
            return _ruled_by_join(pages, rules)
        rules = listed
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for host, path, verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2] == "block")):
        made = F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(_fits(F.col("host"), F.col("path"), F.lit(host), F.lit(path)), made).otherwise(found)
    return pages.withColumn("_rule", found)


def _ruled_by_join(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """For long lists: distinct (host, path) pairs meet the rules of their host's suffixes, of which there are as many as labels."""
    places = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    asked = places.select("host", "path", F.explode(suffixes).alias("_suffix"))
    # Saved, so that both sides come straight from a shuffle where the rules are too many to broadcast: Spark can split what a hot suffix has.
    listed = narrow(saved(rules.select(F.col("host").alias("_suffix"), F.col("path").alias("_path"), F.col("verdict").alias("_verdict")), "url-rules"))
    made = F.struct(F.concat("_suffix", "_path").alias("rule"), F.col("_verdict").alias("verdict"))
    hits = asked.join(listed, "_suffix").where(F.startswith("path", F.col("_path")))
    best = hits.groupBy("host", "path").agg(F.max_by(made, F.struct(F.length("_suffix") + F.length("_path"), F.length("_suffix"), F.col("_verdict") == "block")).alias("_rule"))
    return pages.join(best, ["host", "path"], "left")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, weights: list[float], intercept: float) -> DataFrame:
    """The pages with host, path, rule (null if none fits), score (of the method) and verdict (the rule's, else the method's)."""
    pages = pages.drop("host", "path", "rule", "score", "verdict", "_rule")
    host, path = host_and_path(F.col("url"))
    placed = ruled(pages.withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))}), rules)
    scored = placed.withColumn("score", score(F.coalesce("url", F.lit("")), weights, intercept))
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.withColumns({"rule": F.col("_rule.rule"), "verdict": verdict}).drop("_rule")


def op4(spark, sf_dir: str) -> DataFrame:
    weights, intercept = train(labelled_urls(spark))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, RULES, weights, intercept).select("page_id", "host", "path", "rule", "verdict", "score")
