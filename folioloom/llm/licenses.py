"""Licence scans by a positional index of rare words (native).

The index holds, for every notice template, its words with the highest inverse frequency over
all templates, and their places.  A document looks up its own licence words, the highest IDF
first, turns each posting into the place where the template would begin, and keeps beginnings
on which enough rare words agree.  A template counts when one of its mandatory key phrases
stands where it must from such a beginning.  Everything stays in the row: no shuffle, no generated rows.

Defined cases: null and empty texts have no words, no labels and score 0; repeated rows and
further columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm.names import put_back, set_apart

# Phrases of the base labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]


# Words of common licence notices and the phrases that each must show.
TEMPLATES = (
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2",)),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("general public license version 3",)),
    Template("gpl-2.0", "under the terms of the gnu general public license version 2", ("general public license version 2",)),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    Template("agpl-3.0", "under the terms of the gnu affero general public license", ("affero general public license",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0", "by nc 4 0")),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("cc0", "dedicated to the public domain under the cc0 1 0 universal", ("cc0 1 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("any purpose with or without fee",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template(
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind "
        "express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
        ("this permission notice shall be included in all copies or substantial portions of the software",),
    ),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in "
        "writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
        ("you may not use this file except in compliance with the license",),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version",
        ("you can redistribute it and or modify it under the terms of the gnu general public license",),
    ),
    Template(
        "gpl",
        "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose "
        "see the gnu general public license for more details",
        ("in the hope that it will be useful but without any warranty",),
    ),
    Template(
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice "
        "this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
        ("redistributions in binary form must reproduce the above copyright notice", "redistributions of source code must retain the above copyright notice"),
    ),
    Template(
        "bsd",
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        ("may be used to endorse or promote products derived from this software",),
    ),
    Template("proprietary", "all rights reserved unauthorized copying of this file via any medium is strictly prohibited", ("unauthorized copying",)),
)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; the fast form where every character is ASCII."""
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def _places(joined: Column, phrase: str) -> Column:
    """Starts, in words from 0, of a phrase in `` word word ... ``."""
    parts = F.split(joined, f"(?= {re.escape(phrase)} )")
    spaces = F.transform(parts, lambda p: F.length(p) - F.length(F.replace(p, F.lit(" "))))
    # words before part k: the spaces of the parts before it
    sums = F.aggregate(
        F.slice(spaces, 1, F.greatest(F.size(spaces) - 1, F.lit(0))),
        F.array(F.lit(0)),
        lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)),
    )
    at = F.when(F.startswith(joined, F.lit(f" {phrase} ")), sums).otherwise(F.slice(sums, 2, F.size(sums)))
    return F.when(F.contains(joined, F.lit(f" {phrase} ")), at).otherwise(F.array().cast("array<int>"))


class RareWordIndex:
    """Postings of the rarest words of each template: word -> [(template, place)]."""

    def __init__(self, templates=TEMPLATES, rare: int = 4):
        self.templates = list(templates)
        lists = [t.text.split() for t in self.templates]
        df = Counter(w for ws in lists for w in set(ws))
        self.idf = {w: math.log((1 + len(lists)) / n) for w, n in df.items()}
        self.postings: dict[str, list[tuple[int, int]]] = {}
        self.rare_count = []
        for t, ws in enumerate(lists):
            best = sorted(set(ws), key=lambda w: (-self.idf[w], w))[:rare]
            self.rare_count.append(len(best))
            for place, w in enumerate(ws):
                if w in best and ws.index(w) == place:
                    self.postings.setdefault(w, []).append((t, place))

    def words(self) -> list[str]:
        return sorted(self.postings)

    def map_column(self) -> Column:
        """word -> (idf, postings) as a literal map."""
        entries = []
        for w in self.words():
            posts = ", ".join(f"named_struct('t', {t}, 'p', {p})" for t, p in self.postings[w])
            entries.append(f"'{w}', named_struct('idf', {self.idf[w]:.6f}D, 'posts', array({posts}))")
        return F.expr(f"map({', '.join(entries)})")


def license_scan(documents: DataFrame, text: str = "text", index: RareWordIndex | None = None, agree: float = 0.75) -> DataFrame:
    """documents plus n_words, n_base, first_word, last_word, base_labels, labels, score.

    All rare words of a document are looked up at all their places.  ``agree`` is the share of
    a template's rare words that must point to one beginning.
    """
    index = index or RareWordIndex()
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    df, names = set_apart(documents.drop(*added))
    cols = [F.col(f"`{c}`") for c in df.columns]
    words = F.array_remove(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), NOT_WORD), "")
    df = df.select(*cols, words.alias("__w"))
    rare = F.filter("__w", lambda w: w.isin(index.words()))
    phrase_word = F.array_contains("__w", "cc") | F.array_contains("__w", "general") | F.array_contains("__w", "rights")
    df = df.select("*", F.array_distinct(rare).alias("__rare"), phrase_word.alias("__any"))
    look = (F.size("__rare") >= 2) | F.col("__any")
    df = df.select("*", F.when(look, F.concat(F.lit(" "), F.array_join("__w", " "), F.lit(" "))).alias("__j"))
    places = [F.when(F.col("__any"), _places(F.col("__j"), p)).otherwise(F.array().cast("array<int>")).alias(f"__p{k}") for k, p in enumerate(BASE_PHRASES)]
    df = df.select("*", index.map_column().alias("__index"), *places)
    # the document's rarest licence words, by IDF
    best = F.sort_array(F.transform("__rare", lambda w: F.struct((-F.element_at(F.col("__index"), w)["idf"]).alias("i"), w.alias("w"))))
    best = F.transform(best, lambda s: s["w"])
    df = df.select("*", F.when(F.size("__rare") >= 2, best).alias("__best"))
    hits = F.filter(F.transform("__w", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda s: F.array_contains("__best", s["w"]))
    begins = F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(F.col("__index"), h["w"])["posts"], lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("at")))))
    df = df.select("*", F.when(F.col("__best").isNotNull(), F.sort_array(begins)).alias("__begins"))
    found = []
    for t, (template, n) in enumerate(zip(index.templates, index.rare_count, strict=True)):
        need = math.ceil(agree * n)
        # sorted beginnings: those of the runs of equal ones that are long enough, and the longest run
        runs = F.aggregate(_of_template("__begins", t), F.expr("named_struct('at', -1000000, 'n', 0, 'm', 0, 'ats', cast(array() AS array<int>))"), _run(need))
        found.append(F.struct(F.lit(template.label).alias("label"), F.lit(float(n)).alias("of"), F.array(*_offsets(template)).alias("keys"), runs["m"].alias("m"), runs["ats"].alias("ats")))
    words = F.col("__w")
    shown = lambda x: F.exists(x["ats"], lambda at: F.exists(x["keys"], lambda k: (at + k["at"] >= 0) & (F.array_join(F.slice(words, F.greatest(at + k["at"], F.lit(0)) + 1, k["n"]), " ") == k["words"])))
    share = lambda x: F.struct(x["label"].alias("label"), F.least(x["m"] / x["of"], F.lit(1.0)).alias("share"))
    close = F.filter(F.array(*found), lambda x: F.size(x["ats"]) > 0)
    df = df.select("*", F.when(F.size("__begins") > 0, close).alias("__close"))
    df = df.select("*", F.transform(F.filter("__close", shown), share).alias("__found"))
    base = F.array_compact(F.array(*[F.when(F.size(f"__p{k}") > 0, F.lit(label)) for k, label in enumerate(BASE_PHRASES.values())]))
    method = F.coalesce(F.transform("__found", lambda x: x["label"]), F.array().cast("array<string>"))
    spots = F.concat(*[F.col(f"__p{k}") for k in range(len(BASE_PHRASES))])
    shares = F.coalesce(F.array_max(F.transform("__found", lambda x: x["share"])), F.lit(0.0))
    out = df.select(
        *cols,
        F.size("__w").cast("long").alias("n_words"),
        F.size(spots).cast("long").alias("n_base"),
        F.array_min(spots).cast("long").alias("first_word"),
        F.array_max(spots).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(base, method))), ",").alias("labels"),
        F.greatest(shares, F.when(F.size(spots) > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"),
    )
    return put_back(out, names)


def _offsets(template: Template) -> list[Column]:
    """Where each key phrase stands in its template: (at, n, words)."""
    text, out = template.text.split(), []
    for key in template.keys:
        own = key.split()
        at = next(k for k in range(len(text)) if text[k : k + len(own)] == own)
        out.append(F.struct(F.lit(at).alias("at"), F.lit(len(own)).alias("n"), F.lit(key).alias("words")))
    return out


def _of_template(begins: str, t: int) -> Column:
    return F.filter(begins, lambda b: b["t"] == t)


def _run(need: int):
    def step(a: Column, b: Column) -> Column:
        n = F.when(a["at"] == b["at"], a["n"] + 1).otherwise(F.lit(1))
        ats = F.when(n == need, F.concat(a["ats"], F.array(b["at"]))).otherwise(a["ats"])
        return F.struct(b["at"].alias("at"), n.alias("n"), F.greatest(a["m"], n).alias("m"), ats.alias("ats"))

    return step


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return license_scan(docs).drop("text")
