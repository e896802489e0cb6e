"""Token counts, chat formatting, quality, joins, mixing and decontamination against brute force on small tables."""

import collections
import hashlib
import itertools
import random
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sward.llm import chat, credentials, decontaminate, importance, mixing, ngram_join, quality_net, tokens
from sward.session import work_path

MODEL = str(public_tokenizers.path("piece_bpe_32k.model"))
VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
SPACE = r"[^\x20\x09-\x0D]+"


def documents(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, 7, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n int, key string")


# Token counts


def test_counts_are_the_library_s_and_only_misses_are_encoded(spark):
    texts = [None, "", " ", "a b", "a b", "</s><s>[INST]", "é😀▁ x", "word " * 5000, "x" * 20000, "a\n\n\tb"]
    docs, cache = documents(spark, texts, [None, *range(1, 9), 1]), work_path(spark, "cache")
    model = tokens.piece_model(MODEL)
    want = sorted((str(i), len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t in zip([None, *range(1, 9), 1], texts))
    for _ in range(2):
        got = tokens.count_tokens(docs, MODEL, cache).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want
        assert spark.read.parquet(cache).count() == len({t or "" for t in texts})
    assert tokens.count_tokens(documents(spark, ["new"]), MODEL, cache).first()["n_tokens"] == len(model.encode("new"))
    assert tokens.count_tokens(docs.limit(0), MODEL, work_path(spark, "cache")).count() == 0


# Chat formatting

TEMPLATE = chat.Template()


def test_escaping_is_reversible():
    pieces = ["<|", "turn|>", "<|turn|>", "\\", "<\\|end|>", "</s>", "<\\\\/s>", "[INST]", "[\\/INST]", "[", "<", "x", "é", "\n"]
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choices(pieces, k=rng.randrange(8)))
        escaped = TEMPLATE.escape(text)
        assert TEMPLATE.unescape(escaped) == text
        assert not any(c in escaped for c in TEMPLATE.controls)
    with pytest.raises(ValueError):
        chat.Template(others=("x<",))


def test_conversations_read_back_as_they_were(spark):
    rows = [
        (1, 0, "system", "be <|end|> nice"),
        (1, 1, "user", None),
        (1, 2, "assistant", "é\n<|turn|>assistant<|text|>\\"),
        (1, 2, "assistant", "again"),
        (1, None, None, "first"),
        (None, 0, "assistant", ""),
        (2, 5, "user", " " * 150_000),
        (2, 6, "assistant", "ab" * 120_000),
        (2, 6, "assistant", "ab" * 120_000),
        (-7, 0, "user", "</s>[INST] ok [/INST]"),
        (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
    ]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, position int").repartition(5)
    formatted = chat.format_chats(table, *VOCABULARY)
    got = {r["conv_id"]: r for r in chat.read_back(formatted, *VOCABULARY).collect()}
    for conv, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), key=lambda r: r[0]):
        turns = sorted([(r[1], r[2] or "", r[3] or "") for r in group], key=lambda t: (t[0] is not None, t))
        loss = "".join(t for _, role, t in turns if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{role}\n{t}\n" for _, role, t in turns).encode()).hexdigest()
        assert r["formatted_chars"] == sum(len("<|turn|><|text|><|end|>") + len(TEMPLATE.escape(role)) + len(TEMPLATE.escape(t)) for _, role, t in turns)
    reserved = formatted.select(F.explode("ids").alias("i")).where("i >= 50257").count()
    assert reserved == 3 * len(rows)
    assert chat.read_back(chat.format_chats(table.limit(0), *VOCABULARY), *VOCABULARY).count() == 0


# Quality rules


def plain_rules(text):
    words = re.findall(SPACE, text or "")
    lines = [x for x in (text or "").split("\n") if re.search(SPACE, x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def test_rules_equal_plain_python_and_junk_goes(spark):
    rng = random.Random(4)
    clean = [" ".join(rng.choice("alpha beta gamma delta the of and to in on over under red blue".split()) + str(rng.randrange(90)) for _ in range(150)) for _ in range(60)]
    junk = [" ".join(w + "$$$" for w in t.upper().split()) for t in clean[:8]]
    odd = [None, "", " \n\n ", "a a a a a", "x y z a\nb\nb\nb", "dup line here\n" * 40, "a b c " * 30]
    texts = odd + clean + junk + clean[:1]
    docs = documents(spark, texts, [None, *range(1, len(texts))])
    got = {r["doc_id"]: r for r in importance.rate_documents(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i or None]
        assert tuple(r[f] for f in importance.FEATURES) == plain_rules(text), i
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (len(odd) <= i < len(odd) + len(clean) or i == len(texts) - 1), (i, r["score"])
    kept = importance.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == len(clean) + 1
    assert importance.rate_documents(docs.limit(0)).count() == 0
    assert importance.keep_good(docs.where("doc_id < 3")).count() == 0


def test_short_clean_texts_of_a_small_corpus_stay(spark):
    rng = random.Random(7)
    long = [" ".join(f"common{rng.randrange(90)}" for _ in range(150)) for _ in range(60)]
    short = [" ".join(f"rare{k}x{rng.randrange(400)}" for _ in range(60)) for k in range(3)]
    docs = documents(spark, long + short + short[:1])
    assert all(r["kept"] and not r["base_failed"] for r in importance.rate_documents(docs).collect())
    assert importance.keep_good(docs).count() == len(long) + 4


def test_no_labelled_good_document_is_lost_and_no_bad_one_stays(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    rated = importance.rate_documents(docs).join(labels, "doc_id").where("NOT base_failed")
    found = {(r["quality"], r["kept"]): r["count"] for r in rated.groupBy("quality", "kept").count().collect()}
    assert found == {(1, True): 71, (0, False): 6}


# Quality classifier


def test_classifier_on_the_held_out_fold(spark, small):
    docs, labels = (spark.read.parquet(f"{small.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_net.score_quality(docs, labels)
    rows = scored.join(labels, "doc_id").where("held_out").select("score", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    wins = np.mean([g > b for g in good for b in bad])
    assert wins > 0.95 and len(bad) > 5
    assert scored.where("score NOT BETWEEN 0 AND 1 OR predicted <> int(score >= 0.3)").count() == 0
    assert scored.count() == docs.count()


def test_contexts_and_scores_do_not_depend_on_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    found = [{r["doc_id"]: r["score"] for r in quality_net.score_quality(docs.repartition(n), labels).collect()} for n in (1, 7)]
    assert found[0] == pytest.approx(found[1], abs=1e-9)
    texts = ["a b c a", "c", "", "b a b b c c a d", "x y"]
    places, signs = quality_net.index_vectors()
    want = np.zeros((quality_net.ROWS, quality_net.DIMENSIONS))
    hashes = quality_net.WordHash(8)
    for text in texts:
        rows = quality_net.token_rows(text, hashes)
        for i, word in enumerate(rows):
            for j in range(max(0, i - quality_net.REACH), min(len(rows), i + quality_net.REACH + 1)):
                if j != i:
                    for place, sign in zip(places[rows[j]], signs[rows[j]]):
                        want[word, place] += sign
    want = np.sign(want) * np.log1p(np.abs(want))
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    for n in (1, 3):
        assert np.allclose(quality_net.word_vectors(documents(spark, texts).repartition(n)), want, atol=1e-6)


def test_classifier_of_odd_tables(spark):
    docs = documents(spark, [None, "", "a b c", "a b c", "w " * 30000], [None, 1, 2, 2, 3])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality_net.score_quality(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(2, 1, 0), (2, 1, 0), (3, None, 0), (None, 0, 0)], none.schema)
    scored = quality_net.score_quality(docs, one).collect()
    assert len(scored) == 5 and len({r["score"] for r in scored}) == 1
    both = spark.createDataFrame([(2, 1, 0), (3, 0, 0), (1, 1, 0)], none.schema)
    assert quality_net.score_quality(docs, both).count() == 5
    assert quality_net.score_quality(docs.limit(0), both).count() == 0


def test_temperature_is_fitted_on_rows_that_were_not_trained_on():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, quality_net.WIDTH))
    y = (x[:, 0] + rng.normal(size=800) > 0).astype(float)
    network = quality_net.fit(x[:400], y[:400])
    before = network.scores(x[400:])
    after = quality_net.calibrated(network, x[400:], y[400:]).scores(x[400:])

    def loss(p):
        return -np.mean(y[400:] * np.log(np.clip(p, 1e-9, 1)) + (1 - y[400:]) * np.log(np.clip(1 - p, 1e-9, 1)))

    assert network.temperature > 1 and loss(after) < loss(before)


# N-gram Jaccard join


def plain_classes(docs):
    sets = {}
    for k, t in docs:
        w = re.findall(SPACE, "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets[k] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    parent = {k: k for k in sets}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def varied(seed, bases, longest):
    rng, texts = random.Random(seed), []
    for _ in range(bases):
        base = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, longest))]
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5)}"
            if rng.random() < 0.5:
                copy = copy[rng.randrange(2) :] + [f"y{rng.randrange(3)}"] * rng.randrange(2)
            texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("light", [1, 9, 64])
def test_join_equals_brute_force_on_both_sides_of_the_boundary(spark, light, monkeypatch):
    monkeypatch.setattr(ngram_join, "boundary", lambda *_: light)
    texts = [None, "", "  ", "One TWO", "one two", "é É", *varied(light, 40, 30), *varied(light + 100, 6, 200)]
    docs = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_classes(documents(spark, texts)).collect()}
    assert got == plain_classes(docs)


def test_large_group_of_near_copies_and_a_common_passage(spark):
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    base = [f"b{i}" for i in range(100)]
    texts = []
    for i in range(120):
        copy = list(base)
        copy[rng.randrange(100)] = f"z{i}"
        texts.append(" ".join(copy))
        texts.append(" ".join(passage + [f"u{i}x{j}" for j in range(rng.randrange(5, 80))]))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_classes(documents(spark, texts)).collect()}
    assert got == plain_classes(list(enumerate(texts)))


def test_join_of_odd_rows(spark):
    docs = documents(spark, ["a b c d e f", "a b c d e f", "a b c d e f", None, "lone text"], [None, 5, 5, 1, None])
    got = sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in ngram_join.join_classes(docs).collect())
    assert got == sorted(map(str, [(None, 2, 5), (5, 2, 5), (5, 2, 5), (1, 0, 1), (None, 1, None)]))
    assert ngram_join.join_classes(docs.limit(0)).count() == 0
    kept = ngram_join.one_per_class(documents(spark, ["a b c d e f", "A B C D E F", None, "a b c d e f"]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2] and kept.columns == docs.columns


def test_heavily_edited_copies_link_as_brute_force_says(spark, monkeypatch):
    """Similarities on either side of the threshold, in long lists of many classes."""
    monkeypatch.setattr(ngram_join, "ROUNDS", 0)
    rng, texts = random.Random(12), []
    for base in ([f"b{i}" for i in range(150)], [f"c{i}" for i in range(60)]):
        for i in range(60):
            copy = list(base)[rng.randrange(3) :]
            for _ in range(rng.randrange(1, 8)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(30)}"
            texts.append(" ".join(copy))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join_classes(documents(spark, texts)).collect()}
    assert got == plain_classes(list(enumerate(texts)))


def test_rows_without_id_link_like_others(spark):
    """The first and third text are similar to the one without id, but not to each other."""
    base = [f"w{i}" for i in range(60)]
    first, third = [*base[:50], *[f"x{i}" for i in range(5)]], [f"y{i}" for i in range(4)] + base[4:57]
    rows = [(1, first), (None, base[:57]), (3, third), (None, ["alone"] * 2), (4, ["other"])]
    docs = documents(spark, [" ".join(t) for _, t in rows], [k for k, _ in rows])
    sets = [set(zip(*[t[i:] for i in range(5)])) for t in (first, base[:57], third)]
    share = [len(a & b) / len(a | b) for a, b in ((sets[0], sets[1]), (sets[1], sets[2]), (sets[0], sets[2]))]
    assert share[0] >= 0.75 and share[1] >= 0.75 and share[2] < 0.75
    got = sorted(str((r["doc_id"], r["component_id"])) for r in ngram_join.join_classes(docs).collect())
    assert got == sorted(["(1, 1)", "(None, 1)", "(3, 1)", "(None, None)", "(4, 4)"])


def test_columns_of_any_name_stay(spark):
    rows = [(1, "a b c d e f", 7, 8, 9, 10), (2, "a b c d e f", 7, 8, 9, 10), (2, "g h i token=abcdefgh", 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _k int, _m int, _number int, _going int")
    kept = ngram_join.one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted([rows[0], rows[2]])
    named = docs.withColumnsRenamed({"_k": "_blob", "_m": "_spans"})
    clean = credentials.redact_documents(named, work_path(spark, "ledger"))
    assert clean.columns == named.columns
    assert sorted(r["_spans"] for r in clean.collect()) == [2, 8, 8]
    assert credentials.redact_documents(named.limit(0), work_path(spark, "ledger")).count() == 0


@pytest.mark.parametrize("light", [1, 64])
def test_texts_of_one_id_all_link_and_none_is_lost(spark, light, monkeypatch):
    monkeypatch.setattr(ngram_join, "boundary", lambda *_: light)
    rng = random.Random(light)
    first, second, lone = (" ".join(f"{c}{rng.randrange(999)}" for _ in range(60)) for c in "abc")
    near = [" ".join(t.split()[:-1] + ["end"]) for t in (first, second)]
    rows = [(5, first), (5, second), (7, near[0]), (9, near[1]), (8, lone), (3, None)]
    docs = documents(spark, [t for _, t in rows], [k for k, _ in rows])
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join_classes(docs).collect())
    assert got == sorted([(5, 56, 5), (5, 56, 5), (7, 56, 5), (9, 56, 5), (8, 56, 8), (3, 0, 3)])
    # One row of id 5 is a copy of id 2's text, the other has a text of its own.
    rows = [(2, first), (5, first), (5, second), (9, near[1]), (8, lone)]
    docs = documents(spark, [t for _, t in rows], [k for k, _ in rows])
    got = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.join_classes(docs).collect())
    assert got == [(2, 2), (5, 2), (5, 2), (8, 8), (9, 2)]
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.one_per_class(docs).collect()]
    assert sorted(kept) == sorted([(2, first), (5, second), (8, lone)])


def test_very_long_words_and_texts_are_whole():
    long_word = "w" * (3 << 20)
    texts = [long_word + " a b c d e", "a " * (1 << 20), " ".join(map(str, range(300_000)))]
    assert [len(ngram_join.shingles(t)) for t in texts] == [2, 1, 299_996]
    assert len(ngram_join.word_hashes(texts[2].encode())) == 300_000
    tail = ngram_join.word_hashes(texts[2].encode())[-5:]
    assert (tail == ngram_join.word_hashes(" ".join(map(str, range(299_995, 300_000))).encode())).all()


def test_verification_knows_all_texts_of_an_id(spark):
    rng = random.Random(3)
    texts = [" ".join(f"{c}{rng.randrange(999)}" for _ in range(60)) for c in "ab"]
    rows = [(5, texts[0]), (5, texts[1]), (7, texts[0] + " end"), (9, texts[1] + " end")]
    pairs = spark.createDataFrame([(5, 7), (5, 9)], "a long, b long")
    links = ngram_join.verified(spark.createDataFrame(rows, "key long, text string"), pairs)
    assert sorted(map(tuple, links.collect())) == [(5, 7), (5, 9)]
    # An id whose texts are all copies of others' unites their classes.
    docs = documents(spark, [texts[0], texts[1], *texts], [1, 2, 5, 5])
    assert {r["component_id"] for r in ngram_join.join_classes(docs).collect()} == {1}
    assert sorted(r["doc_id"] for r in ngram_join.one_per_class(docs).collect()) == [1, 2]


# Mixing


def test_mix_balances_and_repeats_itself(spark):
    rng = random.Random(3)
    texts = [" ".join(["w"] * rng.randrange(0, 200)) for _ in range(3000)]
    rows = [(i, t, f"s{i % 6}" if i % 7 else None) for i, t in enumerate(texts)] + [(3000, None, "s1"), (3001, "a b", "empty"), (3001, "a b", "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first = mixing.mix(docs).collect()
    assert sorted(map(str, first)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert len(first) == len(rows)
    by = collections.defaultdict(list)
    for r in first:
        by[r["source"]].append(r)
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
    total = sum(r["size"] for r in first)
    names = sorted(k for k in by if k is not None) + [None]
    weights, caps = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}, {k: 2.0 * sum(r["size"] for r in by[k]) for k in names}
    want, left, open_ = {}, 1.5 * total, list(names)
    while open_:
        level = left / sum(weights[k] for k in open_)
        over = [k for k in open_ if level * weights[k] > caps[k]]
        for k in over or open_:
            want[k] = caps[k] if over else level * weights[k]
        left -= sum(caps[k] for k in over)
        open_ = [k for k in open_ if k not in want]
    for k in names:
        assert by[k][0]["target"] == pytest.approx(want[k])
        if len(by[k]) > 10:
            assert sum(r["taken"] for r in by[k]) == pytest.approx(want[k], abs=200)


def test_large_source_flies_in_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 64)
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.repeat(F.lit("w "), (F.col("id") % 37).cast("int")).alias("text"))
    docs = docs.union(docs.limit(500).withColumn("source", F.lit("t")))
    for s in mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert s["taken"] == pytest.approx(s["target"], abs=40)


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(2)
    p, x, u = rng.uniform(0.05, 0.95, 500), rng.integers(0, 50, 500), rng.uniform(size=500)
    flown = mixing.fly(p, x, u)
    assert flown.sum() == pytest.approx(p.sum()) and (flown * x).sum() == pytest.approx((p * x).sum())
    assert ((flown > 0) & (flown < 1)).sum() <= 2 and (flown >= 0).all() and (flown <= 1).all()
    equal = mixing.fly(np.full(9, 0.5), np.ones(9), u)
    assert ((equal > 0) & (equal < 1)).sum() <= 1
    assert set(mixing.land(flown, x)) <= {0.0, 1.0}


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], docs.schema)
    assert [r["taken"] for r in mixing.mix(empty).collect()] == [0, 0]


# Decontamination


def plain_leaks(text, items, window):
    words = decontaminate.words_of(text)
    hit, names = set(), set()
    for name, item in items:
        own = decontaminate.words_of(item)
        size = min(window, len(own))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if own and tuple(words[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                names.add("" if name is None else str(name))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block", [1, 40, 10**6])
def test_leaks_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "AUTOMATON_WORDS", block)
    rng = random.Random(6)
    vocabulary = list("abcd")
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 14)))) for i in range(25)] + [(None, "a b! c"), (10, "É x"), (99, None), (3, "a, a")]
    texts = [None, "", "!!", "É X", *[" ".join(rng.choices([*vocabulary, "A", "z"], k=rng.randrange(60))) for _ in range(80)]]
    item_table = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, key int")
    docs = documents(spark, texts)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontaminate.find_leaks(docs, item_table, window=6).collect()}
    assert got == {i: plain_leaks(t, items, 6) for i, t in enumerate(texts)}


def test_many_items_in_several_passes(spark, monkeypatch):
    """20,000 items, each of them once in some text: every one is found, whatever block it is in."""
    monkeypatch.setattr(decontaminate, "AUTOMATON_WORDS", 150_000)
    items = [(i, " ".join(f"w{(i * 7 + k * k) % 5003}" for k in range(12)) + f" i{i}") for i in range(20_000)]
    item_table = spark.createDataFrame([*items, *items[:50]], "item_id long, text string")
    assert len(decontaminate.store_automata(item_table, 13)[1]) > 3
    texts = [" stop ".join(t.upper() for _, t in items[at : at + 100]) for at in range(0, 20_000, 100)]
    docs = documents(spark, [*texts, None]).withColumns({"_spans": F.lit(1), "_items": F.col("text"), "key": F.lit(2)})
    got = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.find_leaks(docs, item_table, window=13).collect()}
    assert got == {**{k: (1300, sorted(str(i) for i in range(k * 100, k * 100 + 100))) for k in range(200)}, 200: (0, [])}
    kept = decontaminate.remove_leaks(docs, item_table, window=13, most_share=1.0)
    assert kept.columns == docs.columns
    left = {r["doc_id"]: r for r in kept.collect()}
    assert left[0]["text"].split() == ["stop"] * 99 and left[0]["_items"] == texts[0] and left[200]["text"] is None


def test_cut_texts_are_clean_and_others_unchanged(spark):
    item = "The quick brown fox jumps over the lazy dog today again"
    long = " ".join(f"w{i}" for i in range(3000))
    texts = [None, "", "clean text", f"x {item}. y", f"{long} «{item.upper()}!» {long}"]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents(spark, texts)
    out = {r["doc_id"]: r["text"] for r in decontaminate.remove_leaks(docs, items).collect()}
    assert set(out) == {0, 1, 2, 4} and [out[i] for i in (0, 1, 2)] == texts[:3]
    assert plain_leaks(out[4], [(1, item)], 10)[1] == 0 and out[4].count("w2999") == 2
    assert decontaminate.remove_leaks(docs, items.limit(0)).count() == 5
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0


def test_flights_keep_inclusion_probabilities():
    """Documents of every size are taken as often as they should be, within three standard errors."""
    rng, times = np.random.default_rng(10), 1500
    sizes = np.tile([10, 25, 70], 8)
    taken = np.zeros(len(sizes))
    for _ in range(times):
        order = rng.permutation(len(sizes))
        p = np.full(len(sizes), 0.3)
        flown = mixing.fly(p[order], sizes[order].astype(float), rng.random(len(sizes)))
        taken[order] += flown
    for size in (10, 25, 70):
        mean = taken[sizes == size].sum() / (times * 8)
        assert abs(mean - 0.3) < 3 * (0.21 / (times * 8)) ** 0.5


def test_good_documents_of_every_table_stay(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    rated = importance.rate_documents(docs).join(labels.select("doc_id", "quality"), "doc_id")
    assert rated.where("quality = 1 AND NOT base_failed AND NOT kept").count() == 0


def test_batches_are_worked_on_in_slices(spark):
    """Rows of a whole Arrow batch, as Python objects, took an executor beyond its memory."""
    docs = documents(spark, [f"word {i} of a text" for i in range(1200)]).select("doc_id", "text").coalesce(1)
    items = spark.createDataFrame([("a", "7 of a"), ("b", "11 of a text")], "item_id string, text string")

    def finish(batch, found):
        return pa.RecordBatch.from_arrays([pa.array([len(found)], pa.int64()), pa.array([sum(bool(f[1]) for f in found)], pa.int64())], names=["n", "hit"])

    rows = decontaminate.met_items(docs, items, 10, "text", finish, "n long, hit long").collect()
    assert [r["n"] for r in rows] == [500, 500, 200] and sum(r["hit"] for r in rows) == 2
    batch = pa.RecordBatch.from_arrays([pa.array(["lorem ipsum dolor " * 400] * 4000)], names=["text"])
    tracemalloc.start()
    found = next(importance._count(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(found.column("raw").to_pylist()) == 4000 * 2399
    assert peak < 15_000_000 < 4000 * 18 * 400
