"""Licence scan against plain Python on small tables with every odd case."""

import re

from sward.llm import licences

LICENCE = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
TEXTS = [
    None,
    "",
    "no licence here",
    "CC-BY",
    "cc by cc BY cc by",
    "Licensed under CC BY-NC 4.0. All rights reserved. All rights\nreserved",
    "by cc by",
    "cc",
    "all rights all rights reserved",
    "This work is licensed under the GNU General Public License, version 3.",
    "the MIT License",
    "Released under the MIT License.",
    "MIT License",
    LICENCE,
    LICENCE.replace("hereby", "now"),
    "charge to any person obtaining a copy " + LICENCE,
    "é" * 20_000 + " general public license " + "x " * 30_000 + "all rights reserved",
    "cc by " * 5_000,
    "Licensed under CC BY-NC 4.0. All rights reserved. All rights\nreserved",
    "a cc by",
    "ALL RIGHTS RESERVED \U0001f600cc by",
]


def plain_scan(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    rare = licences.rare_words(licences.TEMPLATES)
    places, labels, base, score = [], set(), set(), 0.0
    for number, t in enumerate(licences.TEMPLATES):
        wanted, key = t.text.split(" "), t.key.split(" ")
        spots = [(w, at) for w, n, at in rare if n == number]
        for start in range(1 - len(wanted), len(words)):
            inside = {k: words[start + k] for k in range(len(wanted)) if 0 <= start + k < len(words)}
            agreeing = sum(inside.get(at) == w for w, at in spots)
            share = sum(inside.get(k) == w for k, w in enumerate(wanted)) / len(wanted)
            stands = all(inside.get(t.key_from + k) == w for k, w in enumerate(key))
            if stands and agreeing >= min(licences.AGREE, len(spots)) and share >= 0.5:
                labels.add(t.label)
                score = max(score, share)
                if t.base:
                    places.append(start)
                    base.add(t.label)
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(labels), score


def table(spark, texts):
    return spark.createDataFrame([(i if i else None, t, 1, "clash") for i, t in enumerate(texts)], "doc_id long, text string, row int, words string")


def test_scans_equal_plain_python(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in licences.scan_licences(table(spark, TEXTS).repartition(3)).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        assert got[i if i else None] == plain_scan(text), i


def test_base_phrases_are_found_at_every_place(spark):
    got = {r["doc_id"]: r for r in licences.scan_licences(table(spark, TEXTS)).collect()}
    for i, text in enumerate(TEXTS):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        places = [k for p in ("cc by", "general public license", "all rights reserved") for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        assert got[i if i else None]["n_base"] == len(places)
        assert got[i if i else None]["first_word"] == min(places, default=None)


def test_repeated_rows_and_no_rows(spark):
    docs = table(spark, ["x", "cc by"])
    assert licences.scan_licences(docs.union(docs).union(docs.limit(0))).count() == 4
    assert licences.scan_licences(docs.limit(0)).count() == 0


def test_other_templates(spark):
    own = (licences.Template("own", "alpha beta gamma delta", "beta gamma"),)
    [row] = licences.scan_licences(table(spark, ["alpha beta gamma"]), own).collect()
    assert (row["labels"], row["score"], row["n_base"]) == (["own"], 0.75, 0)


def test_every_key_stands_in_its_template():
    for t in licences.TEMPLATES:
        assert t.words[t.key_from : t.key_from + len(t.key.split())] == t.key.split()
