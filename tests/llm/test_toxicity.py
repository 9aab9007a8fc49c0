import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as T

BAD = ["idiot", "worthless", "pathetic"]


def test_lattice_and_decoding():
    counts = {}
    for w, n in (("idiot", 50), ("pathetic", 50), ("the", 200), ("lamp", 30), ("good", 40), ("stupid", 30)):
        s = f"^^{w}$"
        for i in range(len(s) - 2):
            counts[s[i : i + 3]] = counts.get(s[i : i + 3], 0) + n
    m = T.CharModel(counts)
    assert m.decode(T.lattice("1d10t")) == "idiot" and m.decode(T.lattice("p@thet1c")) == "pathetic"
    assert m.decode(T.lattice("iiidiooot")) == "idiot" and m.decode(T.lattice("goood")) == "good"
    assert m.decode(T.lattice("idiot", apart=True)) == "idiot"
    assert m.decode(T.lattice("")) == ""
    assert "idiot" in T.words_in("i-d-i-o-t", m) and "stupid" in T.words_in("$tupid!!", m) and T.words_in("the", m) == {"the"}
    assert list(T.drawn_apart("the i d i o t x1 a b".split())) == ["idiot"]
    assert m.cost("^", "^", "t") < m.cost("^", "^", "q")


def corpus(rng, n, disguise=False):
    words = ["".join(rng.choices(["an", "the", "er", "in", "on", "re", "ti"], k=rng.randint(1, 4))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        ws = rng.choices(words, k=rng.randint(3, 300))
        toxic = rng.random() < 0.15
        if toxic:
            bad = rng.choice([*BAD, "lowei" + rng.choice(["er", "in", "heit", "schaft", "ung", "lich", "bar", "chen"])])
            if disguise and rng.random() < 0.5 and bad in BAD:
                bad = rng.choice([" ".join(bad), bad.replace("i", "1").replace("o", "0"), bad.replace("t", "tttt"), "-".join(bad)])
            ws.insert(rng.randrange(len(ws) + 1), bad)
        docs.append((i, " ".join(ws)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(random.Random(1), 1500, disguise=True)
    frame, said = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.train(frame, said)
    assert {"idiot$", "worthless$", "pathetic$", "lowei"} <= set(model.known)
    got = T.scored(frame, model).withColumn("held", T.fold_of(F.col("doc_id")) == 0).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r["held"]]
    wrong = [r["doc_id"] for r in held if (r["score"] >= 0.5) != bool(truth[r["doc_id"]])]
    assert len(held) > 200 and len(wrong) <= 0.02 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_held_out_labels_are_not_used(spark):
    docs, labels = corpus(random.Random(2), 300)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    flipped = said.withColumn("toxic", F.when(T.fold_of(F.col("doc_id")) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = T.train(frame, said), T.train(frame, flipped)
    assert a.known == b.known and a.base == b.base


def test_covering():
    pairs = [(d, f) for d in range(100) for f in ("idiot$", "odd$")] + [(200 + d, "idiot$") for d in range(30)] + [(1, "rare$"), (300, "rare$")]
    chosen = T.cover(pairs, {"idiot$": (130, 130), "odd$": (100, 100), "rare$": (2, 2)}, 0.1)
    assert set(chosen) == {"idiot$", "rare$"} and T.evidence(1000, 0.1) == 5
    assert T.cover([(1, "a$"), (2, "a$")], {"a$": (5, 2)}, 0.1) == {}
    # A beginning that adds other documents and no toxic ones gives way to the word; one that adds toxic words doesn't.
    assert T.general(["lose", "loser$", "lowe", "lowei$", "lowea$"], {"lose": (700, 600), "loser$": (600, 600), "lowe": (200, 200), "lowei$": (90, 90), "lowea$": (90, 90)}) == ["loser$", "lowe"]


def test_copies_teach_nothing_of_their_own(spark):
    """Hundreds of copies of one toxic document: of its words only the one that other documents have too is learned."""
    rng = random.Random(3)
    docs, labels = corpus(rng, 600)
    copy = " ".join("".join(rng.choices(["ka", "lo", "mu", "pi"], k=4)) for _ in range(40)) + " idiot end"
    docs += [(1000 + i, copy) for i in range(300)]
    labels += [(1000 + i, 1, 1) for i in range(300)]
    frame, said = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.train(frame, said)
    assert "idiot$" in model.known and not any(f.rstrip("$") in copy for f in model.known if f != "idiot$")


def test_reject(spark, fixture):
    docs = spark.read.parquet(f"{fixture[0]}/documents.parquet")
    kept = T.reject_toxic(docs, spark.read.parquet(f"{fixture[0]}/labels.parquet").limit(0))
    assert kept.columns == docs.columns and kept.count() == docs.count()


@pytest.mark.parametrize("text", ["", " \n", "!!!", "a", "1 1 1 1 1 1 1", "x" * 5000, "é è ê " * 200])
def test_odd_texts(text):
    model = T.ToxicModel(T.CharModel({"^^a": 3, "^a$": 3}), {"idiot$": 0.9}, 0.1)
    assert T.Scorer(model).score(text) == 0.1
    assert T.Scorer(model).score(text + " idiot ") == pytest.approx(0.9)


def small_model():
    counts = {}
    for w in ("idiot", "stupid", "filthy", "fuck", "shit", "kill", "дурак"):
        s = f"^^{w}$"
        for i in range(len(s) - 2):
            counts[s[i : i + 3]] = counts.get(s[i : i + 3], 0) + 30
    return T.CharModel(counts)


@pytest.mark.parametrize("text", ["- i d i o t", "? i d i o t", "i d i o t .", "i d i o t.", "a b , i d i o t", "* i d i o t", "( i d i o t )"])
def test_letters_drawn_apart_beside_punctuation(text):
    assert T.Scorer(T.ToxicModel(small_model(), {"idiot$": 0.9}, 0.1)).score(text) == pytest.approx(0.9)


@pytest.mark.parametrize("word", ["idi" + "o" * 50 + "t", "1d1075", "!d!0+", ".".join("idiotidiot" * 7), "4a" * 30 + "idiot"])
def test_long_disguises(word):
    assert any("idiot" in w for w in T.words_in(word, small_model()))
    assert T.words_in("1234567", small_model()) == T.words_in("*" * 500, small_model()) == set()


@pytest.mark.parametrize(("word", "meant"), [("sh!+", "shit"), ("ki||", "kill"), ("f**k", "fuck"), ("f***", "fuck"), ("f11thy", "filthy"), ("$tupid!!", "stupid")])
def test_signs_at_the_end_and_repeated(word, meant):
    assert meant in T.words_in(word, small_model())


@pytest.mark.parametrize("text", ["он дурак, да", "д у р а к", "дураааак", "ДУРАК"])
def test_other_scripts(text):
    assert T.Scorer(T.ToxicModel(small_model(), {"дурак$": 0.9}, 0.1)).score(text) == pytest.approx(0.9)
    assert T.words_in("हिन्दी", small_model()) == {"हिन्दी"} and "你好" in T.words_in("你好。", small_model())


def test_trigrams_and_exact_decoding():
    """Trigrams against a plain count, and Viterbi's readings against all ways through small lattices."""
    rng = random.Random(4)
    words = Counter({"".join(rng.choices("abcdeéж", k=rng.randint(1, 9))): rng.randint(1, 9) for _ in range(300)})
    want = Counter()
    for w, n in words.items():
        for i in range(len(w) + 1):
            want[f"^^{w}$"[i : i + 3]] += n
    assert T.trigrams_of(words) == want
    model = T.CharModel(dict(want))
    for run in ("a*b", "**", "b**", "***", "a4!!", "é*ж", "aa*"):
        for spread in (False, True):
            places = T.lattice(run, spread=spread)
            ends = {}
            for way in itertools.product(*places):
                said = "".join(x for x, _ in way)
                s = f"^^{said}$"
                cost = sum(c for _, c in way) + sum(model.cost(*s[i : i + 3]) for i in range(len(s) - 2))
                ends.setdefault(s[-3:-1], []).append((cost, said))
            best = sorted(min(e)[0] for e in ends.values())[: T.READINGS]
            got = model.readings(places)
            costs = []
            for said in got:
                options = [cost for e in ends.values() for cost, x in e if x == said]
                costs.append(min(options))
            assert costs == pytest.approx(best)


def test_lattices_without_stems_are_passed_over_only_where_nothing_is_lost():
    model, stems = small_model(), T.Stems(["idiot$", "stup", "fuck$"])
    rng = random.Random(2)
    for _ in range(3000):
        run = "".join(rng.choices("idotsupfck1!*0$@4", k=rng.randint(3, 8)))
        assert stems.hits(T.decoded(run, model)) == stems.hits(T.decoded(run, model, stems))
    for chunk in ("the,", "idiot.", "(idiot)", "i.d.i.o.t", "stupid!", "on", "a", "idiooot", "x-ray", "?the"):
        if stems.lack(chunk):
            assert not stems.hits(T.words_in(chunk, model))
    assert stems.lack("the,") and not stems.lack("idiot.")


def test_levels_count_different_words(spark):
    """A beginning that clean texts have once and toxic ones in several words is evidence from the second word on."""
    rng = random.Random(6)
    ends = ["ka", "lo", "mu", "pi", "ra", "so", "te", "vu"]
    docs, labels = [], []
    for i in range(1200):
        ws = ["".join(rng.choices(["an", "the", "er", "in", "on"], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.15
        for e in rng.sample(ends, 3) if toxic else rng.sample(ends, 1) * rng.randint(0, 3):
            ws.insert(rng.randrange(len(ws)), "bomen" + e)
        docs.append((i, " ".join(ws)))
        labels.append((i, 1, int(toxic)))
    frame, said = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.train(frame, said)
    got = {r["doc_id"]: r["score"] for r in T.scored(frame, model).collect()}
    assert all((got[i] >= 0.5) == bool(t) for i, _, t in labels) and any(f.endswith("+") for f in model.known)


def test_very_long_text():
    model = T.ToxicModel(small_model(), {"idiot$": 0.9}, 0.1)
    assert T.Scorer(model).score("the lamp is good. " * 200_000 + "1d10t") == pytest.approx(0.9)
    assert T.Scorer(model).score("*" * 2_000_000) == T.Scorer(model).score("a" * 2_000_000) == 0.1
