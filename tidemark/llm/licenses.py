"""License scans by a positional index of rare words, in DataFrame functions only.

Templates are short notices. The RARE words of each with the highest inverse document frequency, counted over all
documents, are indexed with their places; a word in every document still weighs FLOOR. Of each file the licence words
that are indexed are looked up; a posting of word w at place p of a template, found at place q of the file, votes for
that template starting at q - p. A template is accepted where the votes at one start (and SLACK places around it) reach
SHARE of the weight of the template's own rarest words, and the file has one of its mandatory key phrases.

Only files that hold some phrase can be accepted, and only by templates whose phrase they hold, so only these are looked
up. Lookups meet a broadcast index of fixed size. Votes are shuffled once, by file, before their neighbours are added; a
start's words are bits of one number, so nothing is kept for each word.

Defined results: null counts as empty; a file without licence words has empty labels and score 0; a phrase that occurs
in overlapping places counts at each; texts of any length are scanned whole; words of equal rarity
are ranked by the alphabet, and a file keeps the best of its shares; rows that repeat are scanned one by one; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, saved, table

# Phrases whose places are counted, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Notices of licences in wide use, as (label, notice, mandatory key phrases).
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction", ["hereby granted free of charge"]),
    ("apache", "licensed under the apache license version 2 0", ["apache license"]),
    ("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license", ["apache license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["general public license"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["general public license"]),
    ("lgpl", "licensed under the gnu lesser general public license version 2 1", ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license version 3", ["affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms"]),
    ("bsd", "licensed under the bsd license", ["bsd license", "clause bsd"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("epl", "this program is made available under the terms of the eclipse public license 2 0", ["eclipse public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software"]),
    ("cc-by", "licensed under cc by 4 0", ["cc by 4"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ["commons attribution 4"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ["attribution sharealike"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ["attribution noncommercial"]),
    ("cc0", "released under cc0 1 0 universal public domain dedication", ["cc0 1 0", "public domain dedication"]),
    ("wtfpl", "do what the fuck you want to public license", ["want to public license"]),
]

#: Rarest words of a template that are indexed, share of their weight that must agree in place, and places that may slip.
RARE, SHARE, SLACK = 12, 0.6, 2
#: Weight of a word that all documents have.
FLOOR = 0.01
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def vocabulary() -> list[str]:
    phrases = [p for _, _, ps in TEMPLATES for p in ps] + list(BASE)
    return sorted({w for _, notice, _ in TEMPLATES for w in notice.split()} | {w for p in phrases for w in p.split()})


def all_phrases() -> list[str]:
    return sorted({p for _, _, ps in TEMPLATES for p in ps} | set(BASE))


def words(text: Column) -> Column:
    """Words of a text in order, in the letters it has; capitals are part of a word here and folded where words are compared."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def licence_words(docs: DataFrame) -> DataFrame:
    """row, doc_id, n_words, found (distinct licence words) and hits (place and word of each, in files that hold a word of some phrase)."""
    known = vocabulary()
    # One word of each phrase: a file without all of these has no phrase.
    anchors = sorted({max(p.split(), key=lambda w: (w in ("license", "attribution"), len(w))) for p in all_phrases()})
    anchored = F.rlike(F.coalesce("text", F.lit("")), F.lit(f"(?i)(?:{'|'.join(map(re.escape, anchors))})"))
    split = docs.select(F.col("doc_id").cast("long"), "text", words(F.col("text")).alias("w"), anchored.alias("anchored"))
    placed = F.transform(words(lower_ascii(F.col("text"))), lambda w, i: F.struct(i.alias("at"), w.alias("w")))
    hits = F.when(F.col("anchored"), F.filter(placed, lambda h: h["w"].isin(known)))
    # lower() is cheap and folds more letters than A-Z: what it lets through is looked at again.
    longest = max(map(len, known))
    held = F.filter("w", lambda w: (F.length(w) <= longest) & F.lower(w).isin(known) & lower_ascii(w).isin(known))
    found = F.array_distinct(F.transform(held, lower_ascii))
    return split.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.size("w").cast("long").alias("n_words"), found.alias("found"), hits.alias("hits"))


def phrase_places(hits: Column, phrase: str) -> Column:
    """Places in ``hits`` where a phrase begins: its words stand at consecutive places, so they are neighbours in hits."""
    ws = phrase.split()

    def begins(h: Column, i: Column) -> Column:
        ok = h["w"] == ws[0]
        for k, w in enumerate(ws[1:], 1):
            nxt = F.get(hits, i + k)
            ok = ok & F.coalesce((nxt["w"] == w) & (nxt["at"] == h["at"] + k), F.lit(False))
        return ok

    return F.transform(F.filter(hits, begins), lambda h: h["at"])


def scan(docs: DataFrame, rare: int = RARE, share: float = SHARE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    rows = saved(licence_words(docs), "licence-words")
    n = rows.count()
    seen = dict(rows.select(F.explode("found").alias("w")).groupBy("w").count().collect())  # one row for each word of the vocabulary
    idf = {w: math.log((n + 1) / (seen.get(w, 0) + 1)) + FLOOR for w in vocabulary()}

    # A template's own rarest words, however common, weigh what a full match can reach; further words are not indexed.
    postings, needed = [], []
    for number, (label, notice, _) in enumerate(TEMPLATES):
        rarest = sorted(set(notice.split()), key=lambda w: (-idf[w], w))[:rare]
        needed.append((number, label, [idf[w] for w in rarest], float(sum(idf[w] for w in rarest))))
        postings += [(w, number, at, 1 << rarest.index(w)) for at, w in enumerate(notice.split()) if w in rarest]
    index = F.broadcast(spark.createDataFrame(postings, "w string, template int, place int, bit long"))
    full = F.broadcast(spark.createDataFrame(needed, "template int, label string, weights array<double>, needed double"))

    phrases = all_phrases()
    held = {p: f"_p{k}" for k, p in enumerate(phrases)}
    licensed = rows.where("size(hits) > 0").select("row", "hits", *[phrase_places(F.col("hits"), p).alias(c) for p, c in held.items()])
    licensed = saved(licensed.where(" or ".join(f"size({c}) > 0" for c in held.values())), "licence-phrases")

    # Templates that a file may be accepted for; one whose phrases it lacks needs no votes.
    possible = F.array_compact(F.array(*[F.when(reduce(or_, [F.size(held[p]) > 0 for p in ps]), F.lit(k)) for k, (_, _, ps) in enumerate(TEMPLATES)]))
    looked = licensed.select("row", possible.alias("possible"), F.explode("hits").alias("h")).select("row", "possible", "h.w", "h.at")
    votes = looked.join(index, "w").where(F.array_contains("possible", F.col("template"))).select("row", "template", (F.col("at") - F.col("place")).alias("start"), "bit")
    # A start's votes count for its neighbours too, so a word more or less does not part them; each word counts once, as a bit.
    starts = votes.repartition("row").groupBy("row", "template", "start").agg(F.bit_or("bit").alias("bits"))
    near = starts.select("row", "template", "bits", F.explode(F.array(*[F.col("start") + d for d in range(-SLACK, SLACK + 1)])).alias("start"))
    summed = near.groupBy("row", "template", "start").agg(F.bit_or("bits").alias("bits")).select("row", "template", "bits").distinct()
    weight = F.aggregate(F.transform("weights", lambda v, i: F.when(F.getbit("bits", i) == 1, v).otherwise(0.0)), F.lit(0.0), lambda x, y: x + y)
    shares = summed.join(full, "template").select("row", "label", F.least(F.lit(1.0), F.round(weight / F.col("needed"), 9)).alias("share")).where(F.col("share") >= share)
    accepted = shares.groupBy("row").agg(F.collect_set("label").alias("added"), F.max("share").alias("share"))  # as many labels as templates at most

    base_places = F.concat(*[F.col(held[p]) for p in BASE])
    base_labels = F.array_sort(F.array_compact(F.array(*[F.when(F.size(held[p]) > 0, F.lit(label)) for p, label in BASE.items()])))
    based = licensed.select("row", F.size(base_places).cast("long").alias("n_base"), F.array_min(base_places).cast("long").alias("first_word"), F.array_max(base_places).cast("long").alias("last_word"), base_labels.alias("base"))
    out = rows.select("row", "doc_id", "n_words").join(based.join(accepted, "row", "left"), "row", "left")
    none = F.array().cast("array<string>")
    base, added = F.coalesce("base", none), F.coalesce("added", none)
    return out.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.array_join(base, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, added)), ",").alias("labels"),
        F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.size(base) > 0, share).otherwise(0.0)).alias("score"),
    )


def op7(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
