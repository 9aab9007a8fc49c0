import random

import pytest

SYLLABLES = "an the er in on re ti es or th ing ed ou ea ha to st nt en of".split()
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words string, key string, rule int, path string, _part int"


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def row(doc_id, text, source="s1", lang="en"):
    return (doc_id, text, lang, source, None if text is None else len(text), 0.25, "x", "same", 1, "src/a", 3)


def corpus(seed=5, n=60):
    """Documents with nulls, empty and long texts, equal ids, repeated rows, copies, near copies, passages and licences."""
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.choice([3, 9, 10, 14, 30]))) for i in range(8)]
    items += [(8, ""), (9, None), (None, "an er in"), (10, items[3][1]), (11, "Er, IN!"), (0, prose(rng, 12))]
    rows = [row(i, prose(rng, rng.randint(1, 120)).capitalize() + rng.choice(["", ".", "!\n"]), rng.choice(["s1", "s1", "s2", "b", None])) for i in range(n)]
    line = "Subscribe to our newsletter and never miss a thing again, dear reader."
    rows += [row(100 + i, prose(rng, 20) + "\n" + rng.choice([line, "  " + line.upper() + "\t", line + " x"]) + "\n" + prose(rng, 5)) for i in range(14)]
    base = prose(rng, 80).split()
    for i in range(12):
        w = list(base)
        w.insert(rng.randrange(len(w)), "word%d" % (i % 9))
        rows.append(row(200 + i, " ".join(w), "s3"))
    rows += [row(220 + i, " ".join(base).upper(), "s3") for i in range(3)]
    for i, (_, text) in enumerate(items[:8]):
        rows.append(row(300 + i, f"{prose(rng, 15)} {text.upper()}, {prose(rng, 7)}", "b"))
    rows += [row(320, prose(rng, 9) + " Released under the MIT License."), row(321, "Licensed under CC BY-NC 4.0.\n" + prose(rng, 9)), row(322, "mit license MIT, License. apache license " * 3)]
    rows += [row(400, None), row(401, ""), row(402, " \n \n"), row(403, None, None, None), row(None, prose(rng, 30)), row(None, None, None), row(7, "another text of id seven")]
    rows += [row(404, prose(rng, 6000) + " É ñ ü 中文 İ"), rows[3], rows[3], row(405, "x"), row(406, "!?"), row(407, items[2][1])]
    return rows, items


@pytest.fixture(scope="session")
def fixture(spark, tmp_path_factory):
    """A folder of tables like the driver's, and their rows."""
    rows, items = corpus()
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("x", "y").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(r[0], 1, i % 5 == 0 and 1 or 0) for i, r in enumerate(rows[:40])], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows, items


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    """The same tables without rows."""
    path = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return str(path)
