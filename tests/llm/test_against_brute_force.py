"""Each query on a small corpus against a plain program for the same contract."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import fingerprint, mixing, records
from tidemark.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def got(spark, fixture, name, *columns):
    return collections.Counter(tuple(r[c] for c in columns) for r in QUERIES[name](spark, fixture[0]).collect())


def test_empty_tables(spark, empty):
    for name, q in QUERIES.items():
        assert q(spark, empty).count() == 0, name


@pytest.mark.parametrize("name", ["op1_benchmark_decontamination", "op2_toxicity", "op10_ngram_jaccard_join"])
def test_sessions_are_left_as_they_were(spark, fixture, name):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.set(keys[0], 7777)
    before = [spark.conf.get(k) for k in keys]
    assert QUERIES[name](spark, fixture[0]).count() > 0 and [spark.conf.get(k) for k in keys] == before


def test_op1(spark, fixture):
    _, rows, items = fixture
    windows = collections.defaultdict(set)
    for i, text in items:
        ws = words(text)
        if i is not None and ws:
            k = min(10, len(ws))
            for a in range(len(ws) - k + 1):
                windows[tuple(ws[a : a + k])].add(str(i))
    lengths = {len(w) for w in windows}
    want = collections.Counter()
    for r in rows:
        ws, hit, found = words(r[1]), set(), set()
        for k in lengths:
            for a in range(len(ws) - k + 1):
                if ids := windows.get(tuple(ws[a : a + k])):
                    hit |= set(range(a, a + k))
                    found |= ids
        want[(r[0], len(ws), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))] += 1
    assert sum(k[-1] for k in want) >= 8
    assert got(spark, fixture, "op1_benchmark_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == want


def test_op3(spark, fixture):
    _, rows, _ = fixture
    strip = " \t\n\x0b\x0c\r"
    keys = [[line.strip(strip).translate(LOWER) for line in (r[1] or "").split("\n")] for r in rows]
    holders = collections.defaultdict(list)
    for r, ks in zip(rows, keys, strict=True):
        for k in {k for k in ks if len(k) >= 40}:
            holders[k].append(r[0])
    owner = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= 5}
    want = collections.Counter()
    for r, ks in zip(rows, keys, strict=True):
        lines = (r[1] or "").split("\n")
        kept = [line for line, k in zip(lines, ks, strict=True) if k not in owner or owner[k] == r[0]]
        want[(r[0], len(lines), len(lines) - len(kept), sha("\n".join(kept)))] += 1
    assert sum(k[2] for k in want) >= 5
    assert got(spark, fixture, "op3_line_dedup", "doc_id", "n_lines", "n_dropped", "kept_sha256") == want


def test_op5(spark, fixture):
    _, rows, _ = fixture
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, (r[1] or "").encode()))
    known = fingerprint.WordHashes()
    sketch = {r[1]: fingerprint.Sketch.of((r[1] or "").encode(), known) for r in rows}
    want = collections.Counter()
    for r, after in zip(order, order[1:] + order[:1], strict=True):
        text, following = r[1] or "", after[1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        other = fingerprint.Sketch.of(changed.encode(), known)
        want[(r[0], len(text), sha(changed), str(sketch[r[1]]), str(other), sketch[r[1]].resemblance(other), sketch[r[1]].resemblance(sketch[after[1]]))] += 1
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert got(spark, fixture, "op5_document_fingerprints", *names) == want


def test_op7(spark, fixture):
    _, rows, _ = fixture
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    want, added = collections.Counter(), {}
    for r in rows:
        ws, places, labels = words(r[1]), [], set()
        for p, label in phrases.items():
            k = p.split()
            at = [i for i in range(len(ws)) if ws[i : i + len(k)] == k]
            places += at
            labels |= {label} if at else set()
        want[(r[0], len(ws), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))] += 1
    assert sum(k[2] for k in want) == 10
    assert got(spark, fixture, "op7_license_scans", "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == want
    for r in QUERIES["op7_license_scans"](spark, fixture[0]).collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
        added[r["doc_id"]] = r["labels"]
    assert added[321] == "cc-by-nc" and added[320] == "mit"


def test_op8(spark, fixture):
    from tokenizers import Tokenizer

    _, rows, _ = fixture
    t = Tokenizer.from_file(records.default_tokenizer())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for r in order:
        ids = [*t.encode(r[1] or "", add_special_tokens=False).ids, 2]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got(spark, fixture, "op8_token_id_binary_output", "doc_id", "start", "n_tokens", "ids_crc32") == collections.Counter(want)


def test_op9(spark, fixture):
    _, rows, _ = fixture
    size = {}
    total = collections.Counter()
    for r in rows:
        total[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weights = dict(zip(names, [3, 1, 2] * len(names), strict=False))
    full, all_words = set(), 1.5 * sum(total.values())
    while True:
        level = (all_words - sum(2 * total[s] for s in full)) / sum(weights[s] for s in names if s not in full)
        over = {s for s in names if s not in full and level * weights[s] > 2 * total[s]}
        if not over:
            break
        full |= over
    target = {s: 2.0 * total[s] if s in full else level * weights[s] for s in names}
    out = QUERIES["op9_mixing_sources"](spark, fixture[0]).collect()
    again = QUERIES["op9_mixing_sources"](spark, fixture[0]).collect()
    assert sorted(out, key=str) == sorted(again, key=str)
    sizes = collections.Counter((r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")), total[r[3]]) for r in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["source_size"]) for r in out) == sizes
    by = collections.defaultdict(int)
    for r in out:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        by[(r["source_size"], r["target"])] += r["taken"]
    for (s, t), taken in by.items():
        assert any(total[n] == s and target[n] == pytest.approx(t) for n in names)
        assert abs(taken - t) <= max(0.02 * t, 25), (s, t, taken)


def test_op10(spark, fixture):
    _, rows, _ = fixture
    sets = []
    for r in rows:
        ws = words(r[1])
        n = min(5, len(ws))
        sets.append(frozenset(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)) if ws else frozenset())

    def alike(a, b):
        return a == b or bool(a and b) and len(a & b) >= 0.8 * len(a | b) - 1e-9

    n = len(rows)
    near = [[j for j in range(n) if j != i and alike(sets[i], sets[j])] for i in range(n)]
    name = list(range(n))
    for _ in range(n):
        name = [min([name[i], *(name[j] for j in near[i])]) for i in range(n)]
    least = {c: min((rows[i][0] for i in range(n) if name[i] == c and rows[i][0] is not None), default=None) for c in set(name)}
    want = collections.Counter((rows[i][0], least[name[i]], len(near[i])) for i in range(n))
    assert max(k[2] for k in want) >= 8
    assert got(spark, fixture, "op10_ngram_jaccard_join", "doc_id", "class_id", "n_links") == want


def test_reshare():
    assert mixing.reshared([10, 10, 1000], [3, 1, 2]) == [20.0, 20.0, 1490.0]
    assert mixing.reshared([], []) == [] and mixing.reshared([0, 0], [3, 1]) == [0.0, 0.0]
