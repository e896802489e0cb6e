"""Tokenizer alignment against plain Python over all token pairs, and the packed runs against plain counting."""

import collections
import hashlib
import json
import random
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sward.llm import alignment

BYTES, PIECES = (str(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    None,
    "",
    " ",
    "The cat sat on the mat.",
    "The cat sat on the mat.",
    "  two  spaces\n\n\ttabs ",
    "Größe, çà et là 😀 \U0001f9d1‍\U0001f4bb 漢字",
    "a▁b",
    "<|endoftext|> </s><s> <0x41> <unk>",
    "word " * 3000,
    "x" * 9000,
    "don't can't 12345 67.89",
    "\x00\x01\x7f é",
    "the the the",
    "١٢٣ שלום नमस्ते",
]


def plain_tokens(text):
    tokenizer, model = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tokenizer.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    first = [(i, bytes(letters[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]
    second = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        second.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    return first, second


def plain_document(text):
    """Counts of linked id pairs, numbers and the groups' digest of one text."""
    if not text:
        return collections.Counter(), (0, 0, 0, 0), ""
    first, second = plain_tokens(text)
    want = (" " + text).encode()
    if b"".join(b for _, b in first) != want or b"".join(b for _, b in second) != want:
        return collections.Counter(), (0, 0, 0, 0), ""

    def spans(tokens):
        at, found = 0, []
        for i, data in tokens:
            found.append((i, at, at + len(data)))
            at += len(data)
        return found

    first, second = spans(first), spans(second)
    links, low = collections.Counter(), 0
    for i, s, e in first:
        while second[low][2] <= s:
            low += 1
        for j, s2, e2 in second[low:]:
            if s2 >= e:
                break
            links[j, i] += 1
    cuts = sorted({e for _, _, e in first} & {e for _, _, e in second})
    groups, start = [], 0
    for cut in cuts:
        groups.append("|".join(",".join(str(i) for i, s, e in side if s >= start and e <= cut) for side in (first, second)))
        start = cut
    return links, (len(first), len(second), len(cuts), sum(links.values())), hashlib.sha256(";".join(groups).encode()).hexdigest()


def plain_alignment(texts):
    found = [plain_document(t) for t in texts]
    counts = sum((links for links, *_ in found), collections.Counter())
    best = {}
    for (b, _), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (*numbers, sum(n for p, n in links.items() if counts[p] == best[p[0]]), sum(n * counts[p] for p, n in links.items()), digest)
        for links, numbers, digest in found
    ]


def table(spark, texts):
    return spark.createDataFrame([(i if i else None, t, 5, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, key string")


FINE = alignment.Sizes(radix=5, chunk_docs=3, chunk_links=100, block_pairs=8, fan_in=2, sharing=2)


def test_ranks_give_the_file_s_ids():
    slow, quick = alignment.byte_side(BYTES), alignment.byte_side(BYTES, public_tokenizers.PATTERN)
    rules = [json.loads(Path(str(public_tokenizers.path(n))).read_text(encoding="utf-8")) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")]
    assert alignment._by_ranks(rules[0], slow.pieces, public_tokenizers.PATTERN) is not None
    assert alignment._by_ranks(rules[1], [], public_tokenizers.PATTERN) is None
    rng = random.Random(9)
    letters = "aé \n\t'sxyz漢😀01,.<|>ß\u00a0\u2003"
    for text in [t for t in TEXTS if t] + ["".join(rng.choices(letters, k=200)) for _ in range(300)] + [" " * 300_000 + "x"]:
        assert slow.encode(" " + text) == quick.encode(" " + text)


@pytest.mark.parametrize("sizes, pattern", [(alignment.Sizes(), None), (FINE, public_tokenizers.PATTERN)])
def test_alignment_equals_plain_python(spark, sizes, pattern):
    """The second setting makes many chunks, several rounds of merges, small blocks and many copies of the counts."""
    rng = random.Random(7)
    words = "the cat sät on a mat don't 12 éé antidisestablishment\n ,.".split(" ")
    texts = TEXTS + [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(30)]
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align_tokenizers(table(spark, texts).repartition(5), BYTES, PIECES, pattern, sizes=sizes).collect()}
    assert len(got) == len(texts)
    for i, want in enumerate(plain_alignment(texts)):
        assert got[i if i else None] == want, i


def test_no_rows(spark):
    assert alignment.align_tokenizers(table(spark, ["x"]).limit(0), BYTES, PIECES).count() == 0
    assert alignment.align_tokenizers(table(spark, [None, ""]), BYTES, PIECES).count() == 2


def test_packed_numbers_come_back():
    for values in ([0], [255, 0, 3], [1 << 20, 5], [1 << 40]):
        assert alignment.unpack(alignment.pack(np.array(values))).tolist() == values
    assert alignment.unpack_sorted(alignment.pack_sorted(np.array([3, 9, 1 << 45]))).tolist() == [3, 9, 1 << 45]


def test_merged_blocks_are_the_plain_counts():
    rng = random.Random(8)
    runs = [sorted(rng.sample(range(500), rng.randrange(1, 90))) for _ in range(20)]
    blocks = sorted((run[i], run[i : i + 7]) for run in runs for i in range(0, len(run), 7))
    merge, got = alignment.Merge(25, 10), []
    for low, pairs in blocks:
        merge.drain(low)
        got += merge.blocks(False)
        merge.add(np.array(pairs), np.array(pairs) + 1)
    merge.drain(None)
    got += merge.blocks(True)
    want = collections.Counter()
    for run in runs:
        for p in run:
            want[p] += p + 1
    pairs, counts, best = (np.concatenate(x).tolist() for x in zip(*got))
    assert dict(zip(pairs, counts)) == want and pairs == sorted(want)
    highest = {side: max(n for p, n in want.items() if p // 25 == side) for side in range(20)}
    assert best == [int(want[p] == highest[p // 25]) for p in pairs]
    assert all(a[0][-1] // 25 < b[0][0] // 25 for a, b in zip(got, got[1:]))
