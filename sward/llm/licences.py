"""Licence scan: an index of each template's rarest words by position proposes alignments, key phrases confirm them.

A file's words are looked up in the index; a hit says where a template would begin. Beginnings on which several rare
words agree are kept if the template's mandatory phrase stands there word for word and most other words fit as well.
DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sward.llm.content import ascii_lower

#: Runs of ASCII letters and digits and of characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Words of a licence text in lower case, one space apart; ``key`` is a part that has to stand as it is.

    ``base`` phrases are their own key, so every place of theirs counts.
    """

    label: str
    text: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split(" ")

    @property
    def key_from(self) -> int:
        """The word at which the key begins."""
        words, key = self.words, self.key.split(" ")
        return next(i for i in range(len(words)) if words[i : i + len(key)] == key)


# Phrases of the contract and opening sentences of public licences.
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", True),
    Template("gpl", "general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "for any purpose with or without fee"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    Template("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights", "waived all copyright and related or neighboring rights"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "released into the public domain"),
)
#: Rare words of a template in the index, at most; short templates have fewer.
ANCHORS = 3
#: Rare words that must agree on where a template begins, where it has as many.
AGREE = 2


def rare_words(templates: Sequence[Template]) -> list[tuple[str, int, int]]:
    """``(word, template, position)`` of the index: the words of highest idf over the templates, then the longest."""
    holders: dict[str, int] = {}
    for t in templates:
        for word in set(t.words):
            holders[word] = holders.get(word, 0) + 1
    found = []
    for number, t in enumerate(templates):
        idf = {w: math.log(len(templates) / holders[w]) for w in t.words}
        best = sorted(range(len(t.words)), key=lambda i: (-idf[t.words[i]], -len(t.words[i]), i))
        found += [(t.words[i], number, i) for i in best[: max(1, min(ANCHORS, len(t.words) // 2))]]
    return found


def postings(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """One row per rare word with its template, of as many rows as the templates' parameters say."""
    index = rare_words(templates)
    rows = []
    for word, number, at in index:
        t = templates[number]
        needed = min(AGREE, sum(1 for _, n, _ in index if n == number))
        rows.append((word, number, at, t.label, t.base, t.words, t.key.split(" "), t.key_from, needed))
    kind = "rare string, template int, anchor int, label string, base boolean, wanted array<string>, phrase array<string>, phrase_from int, needed int"
    return spark.createDataFrame(rows, kind)


def scan_licences(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_words, n_base, first_word, last_word, base_labels, labels, score)`` for every row.

    ``n_base`` counts the places of base phrases, ``first_word`` and ``last_word`` are the smallest and largest of their
    starts (words from 0; null without any). Labels are sorted arrays without repeats; ``labels`` holds the base ones too.
    ``score`` is the largest share of a found template's words that stand in place, 0 where none is found.

    Null texts are empty. Repeated rows and null keys are kept, each with its own result; other columns are not read; no
    rows give no rows. A template counts where its key phrase stands whole, ``AGREE`` of its rare words agree on the place
    and half of its words are in place; where the file begins or ends inside it, the words outside are not in place.

    Nothing is joined but hits of rare words with the words around them, and only confirmed hits are shuffled, by row:
    one file's hits are counted in one task as a stream. Texts stay where they are read.
    """
    spark = docs.sparkSession
    index = postings(spark, templates)
    rare = sorted({word for word, _, _ in rare_words(templates)})
    reach = max(len(t.words) for t in templates)
    words = F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(WORD), F.lit(0))
    rows = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), words.alias("words"))
    places = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(rare), i)))

    def around(i: Column) -> Column:
        low = F.greatest(i - reach, F.lit(0))
        return F.struct(i.alias("at"), low.alias("low"), F.get("words", i).alias("word"), F.slice("words", low + 1, F.lit(2 * reach + 1)).alias("near"))

    hits = rows.select("key", "row", F.size("words").cast("long").alias("n_words"), F.posexplode_outer(F.transform(places, around)).alias("_i", "_hit"))
    aligned = (
        hits.select("key", "row", "n_words", "_i", "_hit.*")
        .join(F.broadcast(index), F.col("word") == F.col("rare"), "left")
        .withColumn("start", F.col("at") - F.col("anchor"))
    )
    begin = F.col("start") + F.col("phrase_from")
    stands = (begin >= 0) & (F.slice("near", F.greatest(begin - F.col("low"), F.lit(0)) + 1, F.size("phrase")) == F.col("phrase"))
    in_place = F.size(F.filter(F.transform("wanted", lambda w, t: F.get("near", F.col("start") + t - F.col("low")).eqNullSafe(w)), lambda x: x))
    share = F.when(stands, in_place / F.size("wanted"))
    confirmed = aligned.withColumn("share", share).where(F.col("share").isNotNull() | (F.coalesce("_i", F.lit(0)) == 0))
    found = F.col("share").isNotNull()
    narrow = confirmed.select(
        "key", "row", "n_words", "share", *[F.when(found, F.col(c)).alias(c) for c in ("template", "start", "label", "base", "needed")]
    )
    per_place = (
        narrow.repartition("row")
        .groupBy("row", "key", "n_words", "template", "start", "label", "base", "needed")
        .agg(F.count("share").alias("agreeing"), F.max("share").alias("share"))
    )
    ok = (F.col("agreeing") >= F.col("needed")) & (F.col("share") >= 0.5)
    is_base = ok & F.col("base")
    return (
        per_place.groupBy("row", "key", "n_words")
        .agg(
            F.count(F.when(is_base, 1)).alias("n_base"),
            F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
            F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
            F.array_sort(F.collect_set(F.when(is_base, F.col("label")))).alias("base_labels"),
            F.array_sort(F.collect_set(F.when(ok, F.col("label")))).alias("labels"),
            F.coalesce(F.max(F.when(ok, F.col("share"))), F.lit(0.0)).alias("score"),
        )
        .select(F.col("key").alias(key), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )
