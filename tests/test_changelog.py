import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changelog as C
from tidemark.operators import splits as G

SCHEMA = "photo_id long, _row_kind string, _bucket int, _snapshot_id long, _seq long"


def rows_of(spark, said):
    made = [(int(x[2:]), x[:2], 0, 1, i) for i, x in enumerate(said.split())]
    return spark.createDataFrame(made, SCHEMA)


@pytest.mark.parametrize(
    ("said", "sent"),
    [
        ("+I100 +I101 +I102", [("ADD", [100, 101, 102])]),
        ("-D100 -D101 -D102", [("DELETE", [100, 101, 102])]),
        ("-U100 +U100", [("ADD", [100])]),
        ("-D100 +I100", [("DELETE", [100]), ("ADD", [100])]),
        ("+I100 -D100", [("ADD", [100]), ("DELETE", [100])]),
        ("-D100 +I100 -U100 +U100 -D100", [("DELETE", [100]), ("ADD", [100, 100]), ("DELETE", [100])]),
        ("+I100 +I101 +I102 -D200 -D201 +I300", [("ADD", [100, 101, 102]), ("DELETE", [200, 201]), ("ADD", [300])]),
        ("+U100", [("ADD", [100])]),
        ("-U100 +U100 -U101 +U101", [("ADD", [100, 101])]),
        ("-U100", []),
        ("", []),
        ("+I1 -D2 +I3 -D4 +I5", [("ADD", [1]), ("DELETE", [2]), ("ADD", [3]), ("DELETE", [4]), ("ADD", [5])]),
    ],
)
def test_batches(spark, said, sent):
    got = C.sent(C.operations(rows_of(spark, said)), "photo_id").orderBy("run", "batch").collect()
    assert [(r["op"], r["values"]) for r in got] == sent


def test_size_flush(spark):
    rows = spark.range(1010).selectExpr("id as photo_id", "'+I' as _row_kind", "0 as _bucket", "1L as _snapshot_id", "id as _seq")
    assert [r["n"] for r in C.sent(C.operations(rows), "photo_id").orderBy("batch").collect()] == [1000, 10]
    with pytest.raises(ValueError):
        C.batches(C.operations(rows), size=0)


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_pieces_give_what_one_writer_sends(spark, parts):
    """Buckets in any number of pieces, runs over several of them."""
    rng = random.Random(parts)
    kinds, log = "+I", []
    for i in range(300):
        kinds = rng.choice(["+I", "-D"]) if rng.random() < 0.15 else kinds
        log.append((i, kinds, rng.choice([0, 0, 0, 1]), i // 9, i))
    want = []
    for bucket in (0, 1):
        runs = []
        for photo, kind, b, _, _ in log:
            if b == bucket:
                op = "ADD" if kind == "+I" else "DELETE"
                if not runs or runs[-1][0] != op:
                    runs.append((op, []))
                runs[-1][1].append(photo)
        want += [(bucket, n + 1, at // 4, op, ids[at : at + 4]) for n, (op, ids) in enumerate(runs) for at in range(0, len(ids), 4)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = C.sent(C.operations(spark.createDataFrame(log, SCHEMA)), "photo_id", size=4).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r["_bucket"], r["run"], r["batch"], r["op"], r["values"]) for r in got) == sorted(want)


def test_unknown_kinds_are_passed_over(spark):
    assert C.operations(rows_of(spark, "+X1 +I2")).count() == 1
    assert C.operations(rows_of(spark, "-U1 +U2"), update_before="delete").where("op = 'DELETE'").count() == 1
    with pytest.raises(ValueError):
        C.operation(F.lit("x"), "maybe")


@pytest.mark.parametrize("seed", range(3))
def test_fold_is_replay(spark, seed):
    """The last operation of each key is what replaying the log row by row comes to, with poison rows removed first."""
    rng = random.Random(seed)
    log = [(rng.randrange(40), rng.choice(["+I", "-U", "+U", "-D", "?"]), 0, rng.randrange(5), 0, rng.random() < 0.1) for _ in range(600)]
    log = [(*r[:4], i, r[5]) for i, r in enumerate(sorted(log, key=lambda r: r[3]))]
    state = {}
    for key, kind, _, snapshot, seq, poison in log:
        if poison:
            continue
        if kind in ("+I", "+U"):
            state[key] = (snapshot, seq)
        elif kind == "-D":
            state.pop(key, None)
    rng.shuffle(log)
    df = spark.createDataFrame(log, SCHEMA + ", poison boolean")
    good, bad = C.quarantine(df, F.when(F.col("poison"), "poison"))
    got = C.live(C.operations(good), "photo_id")
    assert {r["photo_id"]: (r["_snapshot_id"], r["_seq"]) for r in got.collect()} == state
    assert bad.count() == sum(r[5] for r in log)


def test_upsert_and_delete(spark):
    now = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "_id string, v int")
    ops = spark.createDataFrame([("a", 10, "ADD"), ("b", None, "DELETE"), ("d", 4, "ADD")], "_id string, v int, op string")
    assert sorted(map(tuple, C.upsert(now, ops).collect())) == [("a", 10), ("c", 3), ("d", 4)]
    assert sorted(r[0] for r in C.without_ids(now, C.delete_ids(ops)).collect()) == ["a", "c"]


def test_append(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2,)], "a int")
    assert sorted(C.appended(a, b).collect()) == sorted([(1, "x"), (2, None)], key=str)


def test_key_is_required():
    assert C.require_key(["a", "b"], "a") == "a"
    with pytest.raises(ValueError, match="no _ID"):
        C.require_key(["a"], None)
    with pytest.raises(ValueError, match="isn't among"):
        C.require_key(["a"], "c")


def test_split_order(spark):
    splits = spark.createDataFrame([("s1", 0, 2, 5, 10, 1), ("s2", 0, 1, 9, 10, 1), ("s3", 0, 1, None, 10, 1), ("s4", None, 3, 1, 10, 1), ("s5", 1, 1, 1, 10, 2)], "split_id string, _bucket int, _snapshot_id long, _min_seq long, file_size long, row_count long")
    got = [r["split_id"] for r in G.ordered_splits(splits).where("_bucket = 0").orderBy("place").collect()]
    assert got == ["s3", "s2", "s1", "s4"]
    assert {r["_bucket"]: (r["bytes"], r["rows"], r["splits"]) for r in G.bucket_stats(splits).collect()} == {0: (40, 4, 4), 1: (10, 2, 1)}
    assert {r["_bucket"]: r["bytes"] for r in G.bucket_sizes(splits).collect()} == {0: 40, 1: 10, None: 50}


def test_in_bucket_order(spark):
    rows = spark.range(1000).selectExpr("cast(id % 7 as int) _bucket", "id % 3 _snapshot_id", "999 - id _seq")
    for part in G.in_bucket_order(rows).rdd.glom().collect():
        seen = [tuple(r) for r in part]
        assert seen == sorted(seen)


def test_throughput(spark):
    r = G.throughput(spark.createDataFrame([(100, 50), (100, 150)], "docs long, ms long")).first()
    assert (r["docs_per_sec"], r["docs_per_batch"], r["ms_per_batch"]) == (1000.0, 100.0, 100.0)
    assert G.throughput(spark.createDataFrame([(5, 0)], "docs long, ms long")).first()["docs_per_sec"] == 0.0


def test_progress():
    p = G.Progress()
    p.begin([1, 2, 3])
    assert p.complete(2) and not p.complete(2) and not p.complete(9) and p.remaining == 2
    p.begin([])
    assert p.remaining == 0 and p.summary() is None
    assert p.add(100, 0) == 0.0 and p.add(100, 50) == 2000.0
    assert p.summary() == {"docs_per_sec": 4000.0, "docs_per_batch": 100.0, "ms_per_batch": 25.0}
    p.begin(range(10_000))
    assert all(p.complete(b) for b in range(10_000)) and p.remaining == 0
