"""Every stage of the pipeline against a brute-force version on its own input, and the whole of it."""

import re

import pytest

import corpus_pipeline
from sward.llm import importance
from sward.session import materialise
from sward.llm.textual import WordHash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark, small):
    """Input and output of every stage as lists of rows."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialise(stage(spark, tables[-1], small), name))
    return [t.collect() for t in tables]


def test_columns_stay_until_the_mix(results):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "source_mix"
    ]
    for rows in results[:-1]:
        assert rows and list(rows[0].asDict()) == COLUMNS
        assert len({r["doc_id"] for r in rows}) == len(rows)


def test_rejected_documents_go(spark, results):
    ratios = importance.log_ratios(spark.createDataFrame([(r["text"],) for r in results[0]], "text string"))
    kept = [r for r in results[0] if importance.judge(r["text"], WordHash(8), ratios)[3]]
    assert sorted(map(str, kept)) == sorted(map(str, results[1])) and 0 < len(kept) < len(results[0])


def test_one_document_of_each_class_stays(results):
    sets = {}
    for r in results[1]:
        words = "".join(c.lower() if c.isascii() else c for c in r["text"]).encode().split()
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    ids, parent = sorted(sets), {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    assert {r["doc_id"] for r in results[2]} == {i for i in ids if find(i) == i}


def test_no_passage_of_an_item_is_left(spark, small, results):
    def words_of(text):
        return re.findall("[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))

    def windows(words):
        size = min(10, len(words))
        return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} - {()}

    listed = set().union(*[windows(words_of(r["text"])) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()])
    before = {r["doc_id"]: r["text"] for r in results[2]}
    leaks = {}
    for i, t in before.items():
        words = words_of(t)
        leaks[i] = {k for n in {len(w) for w in listed} for at in range(len(words) - n + 1) if tuple(words[at : at + n]) in listed for k in range(at, at + n)}
    after = {r["doc_id"]: r for r in results[3]}
    assert any(leaks.values())
    for i, spans in leaks.items():
        share = len(spans) / max(1, len(words_of(before[i])))
        assert (i in after) == (share <= 0.01)
        if i in after and not spans:
            assert after[i]["text"] == before[i]
        if i in after:
            assert after[i]["n_chars"] == len(after[i]["text"])


def test_no_secret_is_left_and_nothing_else_changes(results):
    names = r"(?:password|passwd|secret|token|api_?key)"
    pattern = re.compile(names + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}""", re.I)
    before = {r["doc_id"]: r["text"] for r in results[3]}
    assert set(before) == {r["doc_id"] for r in results[4]}
    for r in results[4]:
        if not pattern.search(before[r["doc_id"]]):
            assert "[assign]" in r["text"] or "[pem]" in r["text"] or "[jwt]" in r["text"] or r["text"] == before[r["doc_id"]]
        assert not re.search(r"AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}", r["text"])


def test_the_mix_is_of_all_that_is_left(results):
    sizes = {r["doc_id"]: len(r["text"].encode().split()) for r in results[4]}
    assert {r["doc_id"]: r["size"] for r in results[5]} == sizes
    assert sum({r["source"]: r["target"] for r in results[5]}.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in results[5])
