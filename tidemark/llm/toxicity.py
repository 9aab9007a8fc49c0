"""Toxicity of texts behind a noisy channel.

A character language model, trigrams of all words of the corpus, restores disguised words: what a writer did to a word
(letters replaced by digits and signs, letters drawn apart, letters repeated) spans a lattice of possible letters, and
Viterbi's algorithm finds the likeliest word in it, exactly. Toxic words and word beginnings are learned from labelled
documents, after the same restoration; a beginning may also count from the second or third different word on that has it
in a text, for what ordinary words share now and then. What counts as evidence is not documents but different contexts, the words that a
feature was first seen after: words that merely stand in copies of a toxic document have few of them. Features of strong
evidence are all taken, and then, by sequential covering, of those that are toxic beyond chance the ones that explain
most of the toxic documents still unexplained.
A text's score is the noisy-or of the features in it, or the rate of toxic documents among those without any.

Labels are learned only from documents whose crc32(doc_id) mod 5 is not 0, and from TRAIN_ROWS of those at most, drawn
by hash. lang, source and doc_id are no inputs of the score; every text is scored whole, whatever its length. Runs that
can't lead to a learned feature, whatever they are restored to, aren't decoded when texts are scored.

Defined results: null counts as empty; texts without features get the base score; repeated rows get equal scores; of
readings that cost the same the first in alphabetical order counts; a document with several labels is toxic if one of them
says so; without any label all scores are 0; a null doc_id is not held out; an empty table gives no rows; further columns
are kept by ``reject_toxic`` and not read otherwise.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import narrow, saved, small_batches, table, tidy

#: Labelled documents that training uses at most.
TRAIN_ROWS = 20_000
#: Clean documents, at least, whose features are made whole.
FIRST_CLEAN = 1_000
FOLDS = 5
#: Lengths of word beginnings that are features beside whole words, and up to how many different words of a text with one count.
BEGINNINGS, LEVELS = (4, 5, 6, 7), 3
LEAST_PRECISION = 0.9
#: Strong evidence: so many times the contexts that chance would not give, and this share of a feature's toxic documents.
STRONG, STRONG_SHARE = 3, 0.1
ROWS = 500
#: Chunks, and costs of letters, that a worker keeps.
KNOWN_CHUNKS, KEPT = 200_000, 1_000_000
#: Characters of a chunk that is kept at most.
LONG_CHUNK = 64

# The letters that a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz",
}
LATIN = LEET["*"]
AMBIGUOUS = "".join(c for c, letters in LEET.items() if len(letters) > 1)
#: Costs, as natural logarithms: of one replaced letter, of two equal letters read as one, of more read as two, and of a word
#: break among letters drawn apart.
REPLACED, SINGLED, DOUBLED, BROKEN = 1.0, 1.0, 0.5, 2.0
SINGLE = {c: tuple((x, REPLACED) for x in letters) for c, letters in LEET.items()}
ANY = SINGLE["*"]
#: Signs that end a word as often as they stand for its last letter.
ENDING = "!*+|("
#: Signs around a word that stand for no letter.
PUNCTUATION = ".,;:?'\"[]{}-_/\\<>&%#~^=`)"
#: Readings of a disguised run that count: the likeliest, and others that end differently.
READINGS = 6
#: Places of a lattice that are decoded at once.
PLACES = 40
#: Trigrams that the language model keeps at most, the commonest; words are features whether it knows them or not.
TRIGRAMS = 200_000
SIGNS = re.escape("".join(LEET))
# Letters of any script; marks that follow them and that \w leaves out belong to the word.
_MARKS = "\u0300-\u036f\u0483-\u0487\u0591-\u05c7\u0610-\u061a\u064b-\u065f\u0900-\u0903\u093a-\u094f\u0980-\u0983\u09bc-\u09cd\u0b82\u0bbe-\u0bcd\u0e31\u0e34-\u0e4e"
_WORD = re.compile(rf"[^\W\d_]+(?:[{_MARKS}]+[^\W\d_]*)*")
_RUN = re.compile(rf"(?:[^\W\d_]+|[{SIGNS}]+)+")
_SINGLE = re.compile(rf"[^\w{SIGNS}]*([^\W\d_]|[{SIGNS}])(?:[^\w{SIGNS}]|[!*+|(])*")
_APART = re.compile(r"[.\-_~,/*]+")
_THRICE = re.compile(r"(.)\1\1")
_REPEATED = re.compile(r"(.)\1(?:\1|(.)\2(.)\3)")
_THREE = re.compile(rb"\x01{3,}")
_TWICE = re.compile(rf"([{re.escape(AMBIGUOUS)}])\1")
_PAIRS = re.compile(r"(?:(.)\1){3}")


class CharModel:
    """Interpolated trigram model of words; ^ stands before a word and $ after it."""

    def __init__(self, counts: dict[str, int], weight: float = 4.0):
        self.tri = counts
        self.pair, self.context, self.uni = Counter(), Counter(), Counter()
        for t, n in counts.items():
            self.context[t[:2]] += n
            self.pair[t[1:]] += n
            self.uni[t[2]] += n
        self.before = Counter()
        for t, n in self.pair.items():
            self.before[t[0]] += n
        self.total, self.weight = sum(self.uni.values()), weight
        self.kept: dict[str, float] = {}
        self.costs: np.ndarray | None = None
        self.ends: dict[tuple, list[str]] = {}

    def cost(self, a: str, b: str, c: str) -> float:
        """-log P(c | a b)"""
        t = a + b + c
        if t not in self.kept:
            if len(self.kept) >= KEPT:
                self.kept.clear()
            w = self.weight
            p = (self.uni[c] + 1) / (self.total + 256)
            p = (self.pair[b + c] + w * p) / (self.before[b] + w)
            p = (self.tri.get(t, 0) + w * p) / (self.context[a + b] + w)
            self.kept[t] = -math.log(p)
        return self.kept[t]

    def latin(self) -> np.ndarray:
        """Costs of a to z after any two of them."""
        if self.costs is None:
            self.costs = np.array([[[self.cost(a, b, c) for c in LATIN] for b in LATIN] for a in LATIN])
        return self.costs

    def decode(self, lattice: list[tuple]) -> str:
        """The cheapest way through a lattice."""
        return next(iter(self.readings(lattice)), "")

    def readings(self, lattice: list[tuple]) -> list[str]:
        """Viterbi over a lattice: each place offers strings at a cost; a blank ends a word and begins another. The cheapest
        ways, one for each pair of last letters, the cheapest first; READINGS of them. What follows a sure beginning depends on
        its last two letters alone and is kept."""
        sure = 0
        while sure < len(lattice) and len(lattice[sure]) == 1:
            sure += 1
        said = "".join(place[0][0] for place in lattice[:sure])
        key = (("^^" + said)[-2:], *lattice[sure:])
        if key not in self.ends:
            if len(self.ends) >= KEPT // 100:
                self.ends.clear()
            best = {key[0]: (0.0, "")}
            for place in key[1:]:
                best = self._wild(best) if place is ANY and len(best) > len(LATIN) else self._step(best, place)
            self.ends[key] = [s for _, s in sorted((cost + self.cost(*state, "$"), s) for state, (cost, s) in best.items())[:READINGS]]
        return [said + end for end in self.ends[key]]

    def _step(self, best: dict[str, tuple[float, str]], place: tuple) -> dict[str, tuple[float, str]]:
        ahead: dict[str, tuple[float, str]] = {}
        for state, (cost, said) in best.items():
            for letters, extra in place:
                total, now = cost + extra, state
                for c in letters:
                    if c == " ":
                        total, now = total + self.cost(*now, "$"), "^^"
                    else:
                        total, now = total + self.cost(*now, c), now[1] + c
                if now not in ahead or total < ahead[now][0]:
                    ahead[now] = (total, said + letters)
        return ahead

    def _wild(self, best: dict[str, tuple[float, str]]) -> dict[str, tuple[float, str]]:
        """A step where any of a to z may stand, from all states of two of these letters at once."""
        at = {c: i for i, c in enumerate(LATIN)}
        grid = np.full((len(LATIN), len(LATIN)), np.inf)
        ahead = self._step({s: x for s, x in best.items() if s[0] not in at or s[1] not in at}, ANY)
        for s, (cost, _) in best.items():
            if s[0] in at and s[1] in at:
                grid[at[s[0]], at[s[1]]] = cost
        totals = grid[:, :, None] + self.latin()
        for b, first, low in zip(LATIN, totals.argmin(axis=0).tolist(), (totals.min(axis=0) + REPLACED).tolist(), strict=True):
            for c, a, total in zip(LATIN, first, low, strict=True):
                if total < ahead.get(b + c, (math.inf,))[0]:
                    ahead[b + c] = (total, best[LATIN[a] + b][1] + c)
        return ahead


def lattice(run: str, apart: bool = False, spread: bool = False) -> list[tuple]:
    """Places of a run of letters and signs. Repeats become one place, which may keep two; letters drawn apart may hold word breaks.
    With ``spread``, repeats of a sign that may be several letters are places of their own."""
    places = []
    for n, (c, same) in enumerate(groupby(run)):
        options = SINGLE[c] if c in SINGLE else ((c, 0.0),)
        times = len(list(same))
        if spread and c in AMBIGUOUS:
            places += [options] * times
            continue
        if times == 2:
            options = (*((x * 2, cost) for x, cost in options), *((x, cost + SINGLED) for x, cost in options))
        elif times > 2:
            options += tuple((x * 2, cost + DOUBLED) for x, cost in options)
        if apart and n:
            options += tuple((" " + x, cost + BROKEN) for x, cost in options)
        places.append(options)
    return places


def disguised(run: str) -> bool:
    """Whether a run may stand for another word: signs among letters or for all of them, or repeats. Numbers and lines of one sign may not."""
    if len(run) < 3:
        return False
    letters, signs = sum(c not in LEET for c in run), sum(c in LEET and not c.isdigit() for c in run)
    if not letters and (not signs or len(set(run)) < 2):
        return False
    return letters < len(run) or bool(_THRICE.search(run)) or bool(_PAIRS.search(run))


def decoded(run: str, model: CharModel, stems: Stems | None = None) -> set[str]:
    """Readings of a run; of one with over PLACES places those of windows that overlap by half. With ``stems``, lattices that no
    way with one of them leads through aren't decoded."""
    out: set[str] = set()
    for places in [lattice(run), lattice(run, spread=True)][: 2 if _TWICE.search(run) else 1]:
        for at in range(0, max(1, len(places) - PLACES // 2), PLACES // 2) if len(places) > PLACES else [0]:
            window = places[at : at + PLACES]
            if stems is None or stems.within(window):
                out.update(model.readings(window))
    return out


def spelled(chunk: str, model: CharModel, stems: Stems | None = None) -> list[tuple[str, set[str]]]:
    """What stands in a chunk without blanks, as it stands, and its words, with those restored."""
    if chunk.isalpha() and not _REPEATED.search(chunk):
        return [(chunk, {chunk})]
    found = [(w, {w}) for w in _WORD.findall(chunk)]
    for run in _RUN.findall(chunk):
        bare = run.rstrip(ENDING)
        words = set()
        for form in {run, bare}:
            if disguised(form):
                words |= decoded(form, model, stems)
        if words:
            found.append((bare or run, words))
    if len(chunk) > 4:
        singles = [p for p in _APART.split(chunk) if p]
        if len(singles) >= 3 and all(len(p) == 1 for p in singles):
            found += [(run, joined(run, model)) for run in drawn_apart(singles)]
    return found


def words_in(chunk: str, model: CharModel) -> set[str]:
    """Words of a chunk, as they stand and as they are restored."""
    return set().union(*(words for _, words in spelled(chunk, model)))


def joined(run: str, model: CharModel) -> set[str]:
    """Words of letters drawn apart: as one word, and with breaks where they are likely."""
    return {*model.readings(lattice(run)), *model.decode(lattice(run, apart=True)).split()}


def beginnings(word: str) -> list[str]:
    return [word[:n] for n in BEGINNINGS if len(word) > n]


def bare_letter(chunk: str) -> str | None:
    """The letter of a chunk that is one letter, but for other signs around it."""
    if len(chunk) == 1:
        return chunk
    if len(chunk) <= 8 and not chunk.isalpha() and (found := _SINGLE.fullmatch(chunk)):
        return found[1]
    return None


def drawn_apart(chunks: list[str], letters: dict[str, str] | None = None) -> Iterator[str]:
    """Runs of three or more chunks of one letter or sign each, joined, but for punctuation around and between them."""
    if letters is None:
        letters = {c: x for c in set(chunks) if (x := bare_letter(c))}
    if not letters:
        return
    marks = bytes(map(letters.__contains__, chunks))
    for group in _THREE.finditer(marks):
        for run in _RUN.findall("".join(letters[c] for c in chunks[slice(*group.span())])):
            for form in dict.fromkeys((run, run.strip(ENDING))):
                if len(form) >= 3:
                    yield from (form[max(0, start - 20) : start + 60] for start in range(0, len(form), 60))


class Stems:
    """What is looked for: whole words, beginnings, and how a lattice may lead to them."""

    def __init__(self, known: Iterable[str]):
        self.whole = {f[:-1] for f in known if f.endswith("$")}
        self.begin = {f.rstrip("+") for f in known if not f.endswith("$")}
        self.ahead = {s[:n] for s in self.whole | self.begin for n in range(len(s) + 1)}
        self.first = {s[: BEGINNINGS[0]] for s in self.whole | self.begin}

    def lack(self, chunk: str) -> bool:
        """Whether a chunk is, but for punctuation around it, one undisguised word that is none of these; False if unsure."""
        word = chunk.strip(PUNCTUATION)
        return len(word) > 1 and word.isalpha() and word[: BEGINNINGS[0]] not in self.first and not _REPEATED.search(word)

    def hits(self, words: Iterable[str]) -> set[str]:
        """Stems, whole words with a $, that the words have."""
        return {w + "$" for w in words if w in self.whole} | {s for w in words for s in beginnings(w) if s in self.begin}

    def within(self, places: list[tuple]) -> bool:
        """Whether some way through a lattice without word breaks is one of the words or begins like one."""
        ways = {""}
        for place in places:
            longer = {way + letters for way in ways for letters, _ in place}
            if any(way[:n] in self.begin for way in longer for n in BEGINNINGS):
                return True
            ways = longer & self.ahead
            if not ways:
                return False
        return not ways.isdisjoint(self.whole)


def _expanded(chunk: str, model: CharModel) -> list[tuple[str, bool, list[str], list[str]]]:
    """What stands in a chunk, whether it is a plain word, and the whole words and beginnings in it."""
    return [
        (standing, words == {standing}, [w + "$" for w in words], beginnings(standing) if words == {standing} else sorted({f for w in words for f in beginnings(w)}))
        for standing, words in spelled(chunk, model)
    ]


def seen_features(text: str, model: CharModel, known: dict[str, list]) -> dict[str, str]:
    """Features of a text, each with the chunk that its first occurrence follows. ``known`` keeps what chunks spell."""
    out: dict[str, str] = {}
    counts: dict[str, int] = {}
    plain, counted = set(), set()  # words that stand there, and what disguises counted for
    before, met = "", set()
    chunks = text.lower().split()

    def take(standing: str, is_plain: bool, whole: list[str], begin: list[str]) -> None:
        if is_plain:
            if standing in plain:
                return
            plain.add(standing)
        for f in whole:
            out.setdefault(f, before)
        for f in begin:
            k = counts.get(f, 0)
            if k < LEVELS and not (counted and (f, standing) in counted) and (is_plain or standing not in plain or not standing.startswith(f)):
                if not is_plain:
                    counted.add((f, standing))
                counts[f] = k + 1
                out[f + "+" * k] = before

    for chunk in chunks:
        if chunk not in met:
            met.add(chunk)
            found = known.get(chunk)
            if found is None:
                found = _expanded(chunk, model)
                if len(known) >= KNOWN_CHUNKS:
                    known.clear()
                if len(chunk) <= LONG_CHUNK:
                    known[chunk] = found
            for each in found:
                take(*each)
        before = chunk
    for run in drawn_apart(chunks):
        before, words = run, joined(run, model)
        take(run, False, [w + "$" for w in words], sorted({f for w in words for f in beginnings(w)}))
    return out


def trigrams_of(words: Counter) -> dict[str, int]:
    """Trigrams of words with their marks of beginning and end, each as often as the words occur."""
    spelled = "".join([f"^^{w}$" for w in words])
    c = np.frombuffer(spelled.encode("utf-32-le"), np.uint32).astype(np.int64)
    times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 3)
    inside = (c[:-2] != ord("$")) & (c[1:-1] != ord("$"))  # what does not reach into the next word
    keys, which = np.unique((c[:-2] << 42 | c[1:-1] << 21 | c[2:])[inside], return_inverse=True)
    counts = np.bincount(which, times[:-2][inside], len(keys)).astype(np.int64)
    return {chr(k >> 42) + chr(k >> 21 & 0x1FFFFF) + chr(k & 0x1FFFFF): n for k, n in zip(keys.tolist(), counts.tolist(), strict=True)}


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chunks, trigrams = Counter(), Counter()

    def spread() -> None:
        words: Counter = Counter()
        for chunk, n in chunks.items():
            for w in (chunk,) if chunk.isalpha() else _WORD.findall(chunk):
                words[w] += n
        chunks.clear()
        if words:
            trigrams.update(trigrams_of(words))

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            for text in batch.column("text").slice(at, ROWS).to_pylist():
                chunks.update((text or "").lower().split())
                if len(chunks) > KNOWN_CHUNKS:
                    spread()
    spread()
    yield pa.RecordBatch.from_arrays([pa.array(list(trigrams), pa.string()), pa.array(list(trigrams.values()), pa.int64())], names=["t", "n"])


def char_model(docs: DataFrame) -> CharModel:
    """Counts over all documents. Alphabets have some ten thousand trigrams each; TRIGRAMS bounds those of scripts with more signs."""
    sums = docs.select("text").mapInArrow(tidy(_count_trigrams), "t string, n long").groupBy("t").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "t").limit(TRIGRAMS)
    return CharModel({t: n for t, n in sums.collect()})


class ToxicModel:
    """Learned features with the share of toxic documents among those that have them."""

    def __init__(self, chars: CharModel, known: dict[str, float], base: float):
        self.chars, self.known, self.base = chars, known, base
        self.name = uuid.uuid4().hex

    def score(self, found: Iterable[str]) -> float:
        clean = 1.0
        for f in sorted(found):
            clean *= 1 - self.known[f]
        return self.base if clean == 1.0 else 1 - clean


class Scorer:
    """Scores texts, keeping what it found in chunks it has met."""

    def __init__(self, model: ToxicModel):
        self.model, self.stems = model, Stems(model.known)
        self.clean, self.bad, self.letters = set(), {}, {}

    def _of(self, chunk: str) -> list[tuple[str, set[str]]]:
        """What of a chunk has stems, and which."""
        if chunk in self.bad:
            return self.bad[chunk]
        hits = [(standing, stems) for standing, words in spelled(chunk, self.model.chars, self.stems) if (stems := self.stems.hits(words))]
        if letter := bare_letter(chunk):
            self.letters[chunk] = letter
        if len(chunk) <= LONG_CHUNK:
            if hits:
                self.bad[chunk] = hits
            else:
                self.clean.add(chunk)
        return hits

    def found(self, text: str) -> set[str]:
        if len(self.clean) + len(self.bad) > KNOWN_CHUNKS:
            self.clean, self.bad, self.letters = set(), {}, {}
        chunks = text.lower().split()
        met = set(chunks)
        new = met - self.clean
        plain = {chunk for chunk in new if len(chunk) <= LONG_CHUNK and self.stems.lack(chunk)}
        self.clean |= plain
        hits = [h for chunk in new - plain for h in self._of(chunk)]
        if not met.isdisjoint(self.letters):
            hits += [(run, self.stems.hits(joined(run, self.model.chars))) for run in drawn_apart(chunks, self.letters)]
        having = defaultdict(set)
        for standing, stems in hits:
            for s in stems:
                having[s].add(standing)
        return {s + "+" * k for s, standing in having.items() for k in range(min(len(standing), LEVELS))} & self.model.known.keys()

    def score(self, text: str) -> float:
        return self.model.score(self.found(text))


def fold_of(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def _spelled(docs: DataFrame, chars: CharModel) -> DataFrame:
    """doc_id, toxic, found of docs(doc_id, toxic, text): all features of a text, with what they follow."""
    sent = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(chars))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, chunks = cloudpickle.loads(sent.value), {}
        kind = pa.list_(pa.struct([("f", pa.string()), ("after", pa.string())]))
        for batch in batches:
            found = [seen_features(t or "", model, chunks) for t in batch.column("text").to_pylist()]
            made = pa.array([[{"f": f, "after": c} for f, c in fs.items()] for fs in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), made], names=["doc_id", "toxic", "found"])

    return docs.mapInArrow(tidy(spell), "doc_id long, toxic int, found array<struct<f:string,after:string>>")


def _having(docs: DataFrame, chars: CharModel, wanted: list[str]) -> DataFrame:
    """doc_id, toxic, f of docs(doc_id, toxic, text): the features in ``wanted`` that a text has."""
    model = ToxicModel(chars, dict.fromkeys(wanted, 0.5), 0.0)
    sent, name = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model)), model.name

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(name, sent.value)
        for batch in batches:
            found = pa.array([sorted(scorer.found(t or "")) for t in batch.column("text").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), found], names=["doc_id", "toxic", "f"])

    return docs.mapInArrow(tidy(look), "doc_id long, toxic int, f array<string>")


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ToxicModel:
    """A model from the labelled documents, ``rows`` at most.

    All features are made of the toxic documents and of as many others. Only features that those others don't refute are
    then looked up in the rest: what has too few contexts, or stands in too many clean documents, has it whatever the rest is.
    """
    chars = char_model(docs)
    known = labels.where("doc_id is not null and toxic is not null").where(fold_of(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect()  # two numbers for each of ``rows`` at most
    clean = [r["doc_id"] for r in picked if not r["toxic"]]
    first = set(clean[: max(FIRST_CLEAN, len(picked) - len(clean))])
    sample = [(r["doc_id"], r["toxic"], bool(r["toxic"]) or r["doc_id"] in first) for r in picked]
    sample = docs.sparkSession.createDataFrame(sample, "doc_id long, toxic int, first boolean")
    chosen = saved(docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "first", "text"), "toxic-sample")
    n, bad = chosen.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not bad:
        return ToxicModel(chars, {}, 0.0)
    found = saved(_spelled(chosen.where("first").select("doc_id", "toxic", "text"), chars), "toxic-features")
    each = found.select("doc_id", "toxic", F.explode("found").alias("s")).select("doc_id", "toxic", "s.f", "s.after")
    contexts = F.approx_count_distinct(F.when(F.col("toxic") == 1, F.col("after")))
    sums = saved(each.groupBy("f").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad"), contexts.alias("contexts")).where("bad >= 2"), "toxic-sums")
    need = evidence(sums.count(), bad / n)
    sums = saved(sums.where((F.col("contexts") >= need) & (F.col("bad") >= LEAST_PRECISION * F.col("n"))), "toxic-evidence")
    held = each.join(narrow(sums.select("f")), "f").groupBy("doc_id", "toxic").agg(F.collect_list("f").alias("f"))
    rest = _having(chosen.where("not first").select("doc_id", "toxic", "text"), chars, [r["f"] for r in sums.select("f").collect()])
    having = saved(rest.unionByName(held), "toxic-having")
    totals = having.select("toxic", F.explode("f").alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    sums = saved(sums.drop("n").join(totals, "f").where(F.col("bad") >= LEAST_PRECISION * F.col("n")), "toxic-candidates")
    # Every toxic document names its best feature of each kind: what reaches the driver is bounded by the sample's documents.
    kind = F.when(F.col("f").endswith("$"), F.lit(0)).otherwise(F.length("f") * (LEVELS + 1) + F.length(F.regexp_replace("f", "[^+]", "")))
    best = F.max_by(F.struct("f", "n", "bad", "contexts"), F.struct("contexts", "bad", "f"))
    named = having.where("toxic = 1").select("doc_id", F.explode("f").alias("f")).join(narrow(sums), "f").groupBy("doc_id", kind.alias("kind")).agg(best.alias("best"))
    named = named.select("doc_id", "best.*").collect()
    stats = {r["f"]: (r["n"], r["bad"]) for r in named}
    strong = {r["f"] for r in named if r["contexts"] >= max(STRONG * need, STRONG_SHARE * r["bad"])}
    pairs = [(r["doc_id"], r["f"]) for r in named]
    chosen = cover(pairs, stats, bad / n, general(sorted(strong), stats))
    hit = F.arrays_overlap("f", F.array(*map(F.lit, chosen))) if chosen else F.lit(False)
    met, met_bad = having.where(hit).agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    return ToxicModel(chars, chosen, (bad - met_bad + 0.5 * bad / n) / (n - met + 1))


def evidence(candidates: int, rate: float) -> int:
    """Contexts, all of them toxic, that chance would not give any of so many candidates, at the rate of toxic documents."""
    return max(2, math.ceil(math.log(max(candidates, 2) * 20) / math.log(1 / min(max(rate, 1e-6), 0.5))))


def general(strong: list[str], stats: dict[str, tuple[int, int]]) -> list[str]:
    """Of features that stand for one another the best: the longest of those with about the same toxic documents, else the shortest
    and those of fewest words."""
    taken: list[tuple[str, int]] = []
    parts = {f: (f.rstrip("+"), f.count("+")) for f in strong}
    for f in sorted(strong, key=lambda x: (-stats[x][1], -len(x), x)):
        stem, level = parts[f]
        same = any(s != stem and s.startswith(stem) and k == level and stats[g][1] >= 0.9 * stats[f][1] for g, (s, k) in parts.items())
        if not same and not any(stem.startswith(s) and k <= level for s, k in taken):
            taken.append((stem, level))
    return [stem + "+" * level for stem, level in taken]


def cover(pairs: list, stats: dict[str, tuple[int, int]], rate: float, first: tuple[str, ...] | list[str] = ()) -> dict[str, float]:
    """The features in ``first``, then by sequential covering features that each explain toxic documents that those before don't."""
    left: dict[str, set] = defaultdict(set)
    having: dict[int, list[str]] = defaultdict(list)
    for doc, f in pairs:
        left[f].add(doc)
        having[doc].append(f)
    chosen: dict[str, float] = {}
    ahead = list(first)[::-1]
    while ahead or left:
        # Other documents count against a feature; of equal ones the longest is taken, which says least about other words.
        f = ahead.pop() if ahead else max(left, key=lambda x: (len(left[x]) - (stats[x][0] - stats[x][1]), len(x), x))
        n, bad = stats[f]
        if f not in first and len(left[f]) <= n - bad:
            break
        chosen[f] = (bad + rate) / (n + 1)
        for doc in list(left.get(f, ())):
            for other in having[doc]:
                left[other].discard(doc)
        left = defaultdict(set, {k: v for k, v in left.items() if v})
    return chosen


#: The scorer of the model that this worker process met last; its tasks share what it knows of chunks.
_LATEST: dict[str, Scorer] = {}


def _scorer(name: str, packed: bytes) -> Scorer:
    if name not in _LATEST:
        _LATEST.clear()
        _LATEST[name] = Scorer(cloudpickle.loads(packed))
    return _LATEST[name]


def scored(docs: DataFrame, model: ToxicModel, column: str = "score") -> DataFrame:
    """The documents with a score from 0 to 1."""
    docs = docs.drop(column)
    sent, model_name = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model)), model.name
    names = [*docs.columns, column]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model_name, sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                scores = [scorer.score(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=names)

    return docs.mapInArrow(tidy(score), T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def reject_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents that score less than ``limit``, in their own columns."""
    return scored(docs, train(docs, labels), "_tm_score").where(F.col("_tm_score") < limit).drop("_tm_score")


def op2(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    with small_batches(spark):
        out = scored(docs, train(docs, table(spark, sf_dir, "labels")))
        held = F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False))
        return saved(out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")), "toxicity")
