"""License scan by a positional rare-token index.

Licence notices are templates of words, each with a key phrase that it must contain. How
many documents hold each licence word is counted over the whole corpus; a template is
posted under the two highest-IDF words of its key phrase, with their positions. A file's
words are looked up in this index: a word at place ``i`` that is posted at position ``j`` of
a key phrase proposes that it starts at ``i - j``, and the proposals of a template's two words
are intersected. A proposal counts if the key phrase stands there word by word, and scores
the share of the template's words found at the same relative positions; the other words of
the file are never looked at. Every place of a key phrase holds both of its posted words at
their positions, so no place is missed whichever words the index chose, and every place is
reported, with its share as ``cover``.

The corpus pass sends at most one row per licence word and task to a shuffle; the scan is a
projection of each document. What the driver reads is one count per licence word.

Defined cases: a null text is empty and has no words; texts of any length are scanned whole;
equal rows get equal results; other columns are ignored; without documents the index falls
back to alphabetical order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealcast.llm.arrays import let, trimmed_split
from dealcast.llm.common import ascii_lower

#: Characters between words, once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
EDGES = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

#: Phrases whose every place is reported, with their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
#: Label, words of a notice, key phrase in it.
NOTICES = [
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify and or distribute"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
]
#: Identifiers of the one-line notice ``SPDX-License-Identifier: ...``.
SPDX = ["AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1",
        "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib"]


def templates() -> list[dict]:
    """Base phrases and notices in one form: label, words, key phrase and its position."""
    spdx = [(x.lower(), "spdx license identifier " + x.lower().replace("-", " ").replace(".", " ")) for x in SPDX]
    out = []
    for text, label, key, base in [*((p, lab, p, True) for p, lab in BASE), *((t, lab, k, False) for lab, t, k in NOTICES),
                                   *((t, lab, t, False) for lab, t in spdx)]:
        words, phrase = text.split(), key.split()
        at = next(i for i in range(len(words)) if words[i:i + len(phrase)] == phrase)
        out.append({"label": label, "words": words, "key": phrase, "key_at": at, "base": base})
    return out


def words_of(text: Column) -> Column:
    return trimmed_split(ascii_lower(text), F.lit(EDGES), SEPARATORS)


def licence_word_counts(docs: DataFrame) -> dict[str, int]:
    """Number of documents that hold each word of the key phrases."""
    vocabulary = sorted({w for t in templates() for w in t["key"]})
    held = F.array_distinct(F.filter(words_of(F.col("text")), lambda w: w.isin(vocabulary)))
    return {r["w"]: r["n"] for r in docs.select(F.explode(held).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}


def index(counts: dict[str, int]) -> list[dict]:
    """Templates with the two words under which each is posted, the rarest of its key phrase, and
    a position of either."""
    out = []
    for t in templates():
        rare = sorted(set(t["key"]), key=lambda w: (counts.get(w, 0), w))[:2]
        out.append(t | {"rare": rare, "at": [t["key"].index(w) for w in rare]})
    return out


def _matches(w: Column, posted: list[dict]) -> Column:
    """Verified places of key phrases in a file's words: label, base, start (of the key phrase) and cover."""
    strings = lambda xs: F.array(*(F.lit(x) for x in xs))
    table = F.array(*(F.struct(
        strings(t["rare"]).alias("rare"), F.array(*map(F.lit, t["at"])).alias("at"), F.lit(t["label"]).alias("label"), F.lit(t["base"]).alias("base"),
        strings(t["key"]).alias("key"), F.lit(t["key_at"]).alias("key_at"), strings(t["words"]).alias("words")) for t in posted))
    rare = sorted({x for t in posted for x in t["rare"]})
    places = F.array_compact(F.transform(w, lambda x, i: F.when(x.isin(rare), F.struct(x.alias("w"), i.alias("i")))))

    def proposed(hits, e, k):
        return F.transform(F.filter(hits, lambda h: h["w"] == e["rare"][k]), lambda h: h["i"] - e["at"][k])

    def verified(e, start):
        same = F.aggregate(F.sequence(F.lit(0), F.size(e["words"]) - 1), F.lit(0),
                           lambda a, k: a + F.coalesce((F.get(w, start - e["key_at"] + k) == e["words"][k]).cast("int"), F.lit(0)))
        stands = (start >= 0) & (F.slice(w, F.greatest(start, F.lit(0)) + 1, F.size(e["key"])) == e["key"])
        return F.when(stands, F.struct(e["label"].alias("label"), e["base"].alias("base"), start.cast("long").alias("start"),
                                       (same / F.size(e["words"])).alias("cover")))

    def of(hits):
        met = F.filter(table, lambda e: F.exists(hits, lambda h: h["w"] == e["rare"][0]))
        starts = lambda e: F.array_intersect(proposed(hits, e, 0), proposed(hits, e, 1))
        return F.array_compact(F.flatten(F.transform(met, lambda e: F.transform(starts(e), lambda start: verified(e, start)))))

    return let(places, of)


def scan(docs: DataFrame, counts: dict[str, int] | None = None) -> DataFrame:
    """doc_id, text -> doc_id, n_words, matches (label, base, start, cover)."""
    posted = index(licence_word_counts(docs) if counts is None else counts)
    found = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _matches(w, posted).alias("matches")))
    return docs.select("doc_id", found.alias("f")).select("doc_id", "f.n_words", "f.matches")
