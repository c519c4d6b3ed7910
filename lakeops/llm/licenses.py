"""Licence notices by a positional index of rare template words, all as DataFrame expressions."""

from __future__ import annotations

import re
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import ID, TEXT, id_and_text

#: Phrases every text is searched for, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Licence notices: label, words of the notice, phrases that must stand in it word by word.
TEMPLATES = [
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        ["free software", "gnu general public license"],
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
        ["free software", "gnu lesser general public license"],
    ),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("mit", "released under the mit license", ["mit license"]),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        ["permission is hereby granted free of charge", "without restriction"],
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ["redistribution and use in source and binary forms"],
    ),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice",
        ["permission to use copy modify and or distribute this software"],
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4 0 international license"]),
]
#: The share of a notice's weight that must stand in its places, and the words by which a key phrase may be off its place.
SHARE, SLACK = 0.6, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
VOCABULARY = sorted({w for _, words, _ in TEMPLATES for w in words.split()})


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _GAP), "")


def _rlike_words(words: list[str]) -> str:
    """A pattern, blind to the case of A-Z, for any of some words standing alone between gaps."""
    inner = r"(?:^|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])"
    return rf"(?i){inner}(?:{'|'.join(map(re.escape, words))})(?![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])"


#: A text can only hold a phrase or a notice when it holds one of these words (each has one).
ANCHORS = ["license", "cc", "licensed", "permission", "redistribution", "redistribute"]


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase, words counted from 0. ``words`` must be a plain column."""
    parts = phrase.split()

    def here(i: Column) -> Column:
        hit = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            hit = hit & (F.get(words, i + k) == part)
        return hit

    starts = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here)
    return F.when(F.size(words) >= len(parts), starts).otherwise(F.expr("cast(array() as array<int>)"))


def word_weights(docs: DataFrame) -> dict[str, float]:
    """IDF of the template words over all rows of ``docs``. The number of words is fixed."""
    words = F.array_intersect(_words(TEXT), F.array(*[F.lit(w) for w in VOCABULARY]))
    rows = id_and_text(docs)
    held = rows.select(F.explode(words).alias("w")).groupBy("w").count()
    counts = {r["w"]: r["count"] for r in held.collect()}
    n = rows.count()
    return {w: log(1 + (n - counts.get(w, 0) + 0.5) / (counts.get(w, 0) + 0.5)) for w in VOCABULARY}


def looked_up(words: str, weights: dict[str, float]) -> list[str]:
    """The highest-IDF words of a template, as many as it takes that the others together weigh less than SHARE.

    A beginning that gathers SHARE has one of them in its place, so looking up all places of these alone misses none.
    """
    parts = words.split()
    rest = sum(weights[w] for w in parts)
    least, picked = SHARE * rest * (1 - 1e-9), []
    for w in sorted(set(parts), key=lambda w: (-weights[w], w)):
        if rest < least:
            break
        picked.append(w)
        rest -= weights[w] * parts.count(w)
    return picked


def rare_places(words: Column, weights: dict[str, float]) -> Column:
    """Places of all words that some template looks up. ``words`` must be a plain column."""
    rare = sorted({w for _, template, _ in TEMPLATES for w in looked_up(template, weights)})
    return F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(rare))


def _stands(words: Column, at: Column, phrase: list[str]) -> Column:
    hit = F.get(words, at) == phrase[0]
    for k, part in enumerate(phrase[1:], 1):
        hit = hit & (F.get(words, at + k) == part)
    return F.coalesce(hit, F.lit(False))


def _begins(places: Column, words: Column, word: str, offset: int) -> Column:
    return F.transform(F.filter(places, lambda i: F.get(words, i) == word), lambda i: i - offset)


def _notice(words: Column, places: Column, weights: dict[str, float], label: str, template: str, must: list[str]) -> Column:
    parts = template.split()
    whole = sum(weights[w] for w in parts)
    begins = F.concat(*[_begins(places, words, w, o) for w in looked_up(template, weights) for o in range(len(parts)) if parts[o] == w])
    needs = [(next(o for o in range(len(parts)) if parts[o : o + len(p)] == p), p) for p in (phrase.split() for phrase in must)]

    def scored(start: Column) -> Column:
        got = F.lit(0.0)
        for o, w in enumerate(parts):
            got = got + F.when(F.get(words, start + o) == w, F.lit(weights[w])).otherwise(F.lit(0.0))
        return F.struct(F.lit(label).alias("label"), F.least(got / F.lit(whole), F.lit(1.0)).alias("score"), start.alias("start"))

    def counts(n: Column) -> Column:
        ok = n["score"] >= SHARE
        for o, phrase in needs:
            near = F.sequence(n["start"] + (o - SLACK), n["start"] + (o + SLACK))
            ok = ok & F.exists(near, lambda i: _stands(words, i, phrase))  # noqa: B023
        return ok

    return F.filter(F.transform(F.array_distinct(begins), scored), counts)


def notices(words: Column, places: Column, weights: dict[str, float]) -> Column:
    """Array of (label, score, start) of all notices in a text. ``words`` and ``places`` must be plain columns.

    Each place of a looked-up word, less the places it has in a template, is where the template would begin. The weight
    of all the template's words that stand in their places from there, over its whole weight, is its score; at SHARE and
    with each key phrase within SLACK words of its place the notice counts.
    """
    return F.concat(*[_notice(words, places, weights, *template) for template in TEMPLATES])


def license_labels(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of digits, letters and non-ASCII characters after A-Z are lower-cased. Base columns count every place where the
    words of a phrase stand one after another. Labels of notices are added to those of the phrases; score is the best
    notice's, 1 for a phrase alone, 0 without any. Null and empty texts have no words and no labels; repeated rows and
    null ids stay. Every row is decided by itself, so no text is shuffled; the word weights take two scans before.
    """
    rows = id_and_text(docs)
    gapped = F.regexp_replace(TEXT, _GAP, " ")
    trimmed = F.trim(gapped)
    n_words = F.when(F.length("_t") == 0, F.lit(0)).otherwise(F.length("_t") - F.length(F.replace(F.col("_t"), F.lit(" "), F.lit(""))) + 1)
    might = F.col(TEXT).rlike(_rlike_words(ANCHORS))
    rows = rows.withColumn("_t", trimmed).withColumn("n_words", n_words.cast("long")).withColumn("_might", might)
    rows = rows.withColumn("_words", F.when(F.col("_might"), F.split(F.translate("_t", _UPPER, _LOWER), " ")))
    words = F.col("_words")
    rows = rows.withColumns({f"_p{k}": F.when(F.col("_might") & words.isNotNull(), _places(words, p)) for k, p in enumerate(PHRASES)})
    every = F.concat(*[F.coalesce(f"_p{k}", F.expr("cast(array() as array<int>)")) for k in range(len(PHRASES))])
    labels = F.array_compact(F.array(*[F.when(F.size(f"_p{k}") > 0, F.lit(label)) for k, label in enumerate(PHRASES.values())]))
    rows = rows.withColumn("_all", every).withColumn("_base", F.array_sort(F.array_distinct(labels)))
    weights = word_weights(docs)
    rows = rows.withColumn("_places", F.when(F.col("_might"), rare_places(words, weights)))
    rows = rows.withColumn("_found", F.when(F.col("_might"), notices(words, F.col("_places"), weights)))
    more = F.array_distinct(F.transform("_found", lambda n: n["label"]))
    both = F.array_sort(F.array_union("_base", F.coalesce(more, F.expr("cast(array() as array<string>)"))))
    best = F.array_max(F.transform("_found", lambda n: n["score"]))
    score = F.coalesce(best, F.when(F.size("_base") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return rows.select(
        ID,
        "n_words",
        F.size("_all").cast("long").alias("n_base"),
        F.array_min("_all").cast("long").alias("first_word"),
        F.array_max("_all").cast("long").alias("last_word"),
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        score.alias("score"),
    )
