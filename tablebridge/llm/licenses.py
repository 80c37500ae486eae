"""License scans (10): a positional index of rare notice words, in DataFrame functions only.

A template is a notice as it stands in files, with the key phrases that it must have. The scan counts in how many
documents each template word occurs; of these the rare ones are indexed, and a document looks up every one of them that it
has, wherever it stands, so that no length or mixture of notices hides one. A look-up gives the templates that hold the word and where; template positions intersect where they put the template's start at the same
word of the document. Starts with enough hits are candidates, and a candidate counts when every key phrase stands at its
place. Besides, short base phrases are searched word by word.

All of it works on one row at a time, so there is no shuffle of texts and no group that could grow; only the document
counts of the template words (a few hundred numbers) reach the driver.

Defined cases: a null text is an empty one, with no words and no labels; a document may have several labels, and a label
several places; repeated rows are scanned once each; extra columns pass through. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.common import apart, ascii_lower, bound, fresh

# The contract's words, before and after A-Z are lower-cased: the first also takes A-Z, so it finds the same runs.
RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# What lies between words: texts are split there, which is many times faster than extracting every word.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]

    @property
    def words(self) -> list[str]:
        return re.findall(RAW_WORD, self.text.lower())

    def key_places(self) -> list[tuple[int, list[str]]]:
        """Each key phrase with its place among the template's words."""
        words = self.words
        found = []
        for key in self.keys:
            parts = re.findall(RAW_WORD, key.lower())
            found.append((next(i for i in range(len(words)) if words[i : i + len(parts)] == parts), parts))
        return found


# The opening or the notice of well-known public licenses, as their authors publish them.
TEMPLATES = (
    Template(
        "apache-2.0",
        "licensed under the apache license version 2.0",
        ("apache license version 2.0",),
    ),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
        ("apache license version 2.0", "except in compliance with the license"),
    ),
    Template(
        "gpl-3.0",
        "licensed under the gnu general public license version 3",
        ("gnu general public license version 3",),
    ),
    Template(
        "gpl-2.0",
        "licensed under the gnu general public license version 2",
        ("gnu general public license version 2",),
    ),
    Template(
        "gpl-or-later",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version",
        ("free software you can redistribute", "published by the free software foundation"),
    ),
    Template(
        "lgpl",
        "under the terms of the gnu lesser general public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    Template("cc-by-nc", "licensed under cc by nc 4.0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4.0", ("cc by sa",)),
    Template("cc-by-nd", "licensed under cc by nd 4.0", ("cc by nd",)),
    Template(
        "cc-by-4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
        ("creative commons attribution 4.0 international license",),
    ),
    Template("mit-released", "released under the mit license", ("released under the mit license",)),
    Template(
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "to deal in the software without restriction"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        ("redistribution and use in source and binary forms", "are permitted provided that the following conditions"),
    ),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2.0",
        ("mozilla public license v 2.0",),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
)


def words_of(text: Column) -> Column:
    """Words in lower case (A-Z only), in order."""
    found = F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN), "")
    return F.transform(found, ascii_lower)


def strings(values: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in values]) if values else F.array().cast("array<string>")


RESULTS = ("n_words", "base", "found", "labels")


def document_counts(docs: DataFrame, vocabulary: list[str], text_column: str) -> tuple[int, dict[str, int]]:
    """The number of documents, and for each word of the vocabulary the number that have it."""
    text = F.col(text_column).cast("string")
    rough = F.split(F.coalesce(text, F.lit("")), BETWEEN)
    # Only a word's usual spellings are counted: lower case, with a capital, and all capitals.
    spelt = {form: word for word in vocabulary for form in (word, word.capitalize(), word.upper())}
    found = F.array_intersect(rough, strings(list(spelt)))
    counted = docs.select(F.explode(found).alias("word")).groupBy("word").count().collect()
    counts = dict.fromkeys(vocabulary, 0)
    for row in counted:
        counts[spelt[row.word]] += row["count"]
    return docs.count(), counts


def base_places(words: Column, phrases: dict[str, str]) -> Column:
    """Every place where a phrase stands, as (place, label)."""
    split = [(phrase.split(), label) for phrase, label in phrases.items()]
    firsts = strings([parts[0] for parts, _ in split])

    def here(word: Column, place: Column) -> Column:
        kinds = []
        for parts, label in split:
            stands = word == parts[0]
            for k, part in enumerate(parts[1:], 1):
                stands = stands & F.coalesce(F.get(words, place + k) == part, F.lit(False))
            kinds.append(F.when(stands, F.struct(place.cast("long").alias("place"), F.lit(label).alias("label"))))
        return F.when(F.array_contains(firsts, word), F.filter(F.array(*kinds), lambda x: x.isNotNull()))

    return F.flatten(F.filter(F.transform(words, here), lambda x: x.isNotNull()))


def scan(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    phrases: dict[str, str] | None = None,
    hits: int = 3,
    common: float = 0.05,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``base`` (place, label), ``found`` (label, place, share of the template's words) and ``labels``.

    Indexed are template words that at most the share ``common`` of all documents has, and the rarest few of every
    template. A document looks up all of them that it has; a template needs ``hits`` of them in line (fewer if it
    has fewer), and all its key phrases.
    """
    docs = apart(docs, *RESULTS, keep=(id_column, text_column))
    phrases = BASE_PHRASES if phrases is None else phrases
    words = [t.words for t in templates]
    vocabulary = sorted({w for of in words for w in of})
    n, counts = document_counts(docs, vocabulary, text_column)
    idf = {w: math.log((n + 1) / (counts[w] + 1)) for w in vocabulary}
    # Rarest first, then by the alphabet: the same order in every document.
    by_idf = lambda w: (-idf[w], w)
    rare = {w for w in vocabulary if counts[w] <= common * n} | {w for of in words for w in sorted(set(of), key=by_idf)[: 2 * hits]}
    ranked = sorted(rare, key=by_idf)
    postings = {w: [(t, p) for t, of in enumerate(words) for p, x in enumerate(of) if x == w] for w in ranked}
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    # Every key phrase and every base phrase has one of these words, so a text without them needs no look-up.
    telling = sorted({min(parts, key=lambda w: (-idf[w], -len(w))) for t in templates for _, parts in t.key_places()[:1]})
    telling += [max(phrase.split(), key=len) for phrase in phrases]
    lower = F.lower(text)
    may_have = reduce(or_, [lower.contains(w) for w in sorted(set(telling))])

    posting = "array<struct<t:int,p:int>>"
    index = F.create_map(
        *[
            x
            for w in ranked
            for x in (
                F.lit(w),
                F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in postings[w]]).cast(posting),
            )
        ]
    )
    need = F.array(*[F.lit(min(hits, len(rare.intersection(of)))) for of in words])

    def candidates(of: Column) -> Column:
        """(t, d): templates with enough look-ups that put their start at word d."""
        places = F.filter(F.transform(of, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(ranked))
        starts = F.flatten(
            F.transform(
                places,
                lambda x: F.transform(
                    F.element_at(index, x["w"]), lambda p: F.struct(p["t"].alias("t"), (x["i"] - p["p"]).alias("d"))
                ),
            )
        )
        empty = F.struct(
            F.lit(-1).alias("t"),
            F.lit(0).alias("d"),
            F.lit(0).alias("n"),
            F.array().cast("array<struct<t:int,d:int>>").alias("enough"),
        )

        def step(acc: Column, x: Column) -> Column:
            same = (acc["t"] == x["t"]) & (acc["d"] == x["d"])
            count = F.when(same, acc["n"] + 1).otherwise(F.lit(1))
            reached = (count == F.get(need, x["t"])) & (x["d"] >= 0)
            return F.struct(
                x["t"].alias("t"),
                x["d"].alias("d"),
                count.alias("n"),
                F.when(reached, F.concat(acc["enough"], F.array(x))).otherwise(acc["enough"]).alias("enough"),
            )

        return F.aggregate(F.sort_array(starts), empty, step, lambda acc: acc["enough"])

    keys = F.array(
        *[
            F.array(*[F.struct(F.lit(at).alias("at"), strings(parts).alias("words")) for at, parts in t.key_places()])
            for t in templates
        ]
    )
    whole = F.array(*[strings(of) for of in words])
    labels = strings([t.label for t in templates])

    def verified(of: Column) -> Column:
        """Candidates that have every key phrase in its place, with the share of template words that agree."""
        sure = F.filter(
            candidates(of),
            lambda c: F.forall(
                F.get(keys, c["t"]), lambda k: F.slice(of, c["d"] + k["at"] + 1, F.size(k["words"])) == k["words"]
            ),
        )

        def described(c: Column) -> Column:
            template = F.get(whole, c["t"])
            agree = F.size(F.filter(F.transform(template, lambda w, j: F.get(of, c["d"] + j) == w), lambda x: x))
            return F.struct(
                F.get(labels, c["t"]).alias("label"),
                c["d"].cast("long").alias("place"),
                (agree / F.size(template)).alias("share"),
            )

        return F.transform(sure, described)

    none_base = F.array().cast("array<struct<place:bigint,label:string>>")
    none_found = F.array().cast("array<struct<label:string,place:bigint,share:double>>")
    (split,) = fresh(docs, "_words")
    read = docs.withColumn(split, F.when(may_have, words_of(text)))
    scanned = read.withColumns(
        {
            "n_words": F.regexp_count(text, F.lit(RAW_WORD)).cast("long"),
            "base": F.coalesce(F.when(F.col(split).isNotNull(), bound(F.col(split), lambda of: base_places(of, phrases))), none_base),
            "found": F.coalesce(F.when(F.col(split).isNotNull(), bound(F.col(split), verified)), none_found),
        }
    ).drop(split)
    every = F.concat(F.transform("base", lambda x: x["label"]), F.transform("found", lambda x: x["label"]))
    return scanned.withColumn("labels", F.array_sort(F.array_distinct(every)))
