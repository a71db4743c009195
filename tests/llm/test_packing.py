import bisect
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarryline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def one_by_one(counts, capacity):
    """Best-fit decreasing, a piece at a time: the lengths in each bin."""
    open_bins, bins = [], []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect.bisect_left(open_bins, (length, -1))
            if at == len(open_bins):
                remaining, into = capacity, len(bins)
                bins.append([])
            else:
                remaining, into = open_bins.pop(at)
            bins[into].append(length)
            if remaining > length:
                bisect.insort(open_bins, (remaining - length, into))
    return sorted(tuple(sorted(b)) for b in bins)


@pytest.mark.parametrize("seed", range(40))
def test_plan_equals_one_by_one(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 30, 100])
    counts = {draw.randint(1, capacity): draw.randint(1, 30) for _ in range(draw.randint(1, 20))}
    steps, n_bins = packing.plan(counts, capacity)
    bins = defaultdict(list)
    for length, n in counts.items():
        table = steps[length]
        for k in range(n):
            first, per_bin, into, offset = table[np.searchsorted(table[:, 0], k, side="right") - 1]
            nth = k - first
            bins[into + nth // per_bin].append((offset + nth % per_bin * length, length))
    assert len(bins) == n_bins
    assert sorted(tuple(sorted(n for _, n in b)) for b in bins.values()) == one_by_one(counts, capacity)
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity


def test_plan_refuses_wrong_lengths():
    for length in (0, 11):
        with pytest.raises(ValueError):
            packing.plan({length: 1}, 10)


def test_words_have_the_ids_of_the_tokenizer(prose):
    own, tokenizer = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    texts = [prose(200, i) for i in range(5)] + [
        "It's we'll I'M can't, o'clock. 's 't",
        "x\u00a0y\u2003z\u3000 a\u0301 \u0301 İstanbul ΣΑΣ. ﬁ ½ ﷺ",
        "mail@example.com 3.14 1,000; ... !!! word... word!? (a) [b]. 'q'",
        "\U0001f600\U0001f600 \u200b <|endoftext|> a<|startoftext|>b \ufffd",
        "",
    ]
    for text in texts * 2:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.of(text), "<u4").tolist() == want


def check(docs, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    got = packing.pack(docs, PATH, carry=["doc_id", "text"], capacity=capacity).collect()
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[(r["row"]["doc_id"], r["row"]["text"])].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    rows = docs.select("doc_id", "text").collect()
    assert set(by_doc) == {(r["doc_id"], r["text"]) for r in rows}
    for (_, text), found in by_doc.items():
        copies = sum(r["text"] == text and (r["doc_id"], text) in by_doc for r in rows if (r["doc_id"], r["text"]) == (_, text))
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        want = [
            (k, at, len(ids[at : at + capacity]), zlib.crc32(np.array(ids[at : at + capacity], "<u4").tobytes()))
            for k, at in enumerate(range(0, len(ids), capacity))
        ]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(want * copies)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    counts = defaultdict(int)
    for r in got:
        counts[r["length"]] += 1
    assert len(sequences) == packing.plan(counts, capacity)[1]


def test_pieces_and_places(spark, prose):
    rows = [(i, prose(1 + i % 70, i % 50)) for i in range(300)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 128)


def test_odd_rows(spark, tricky, none_at_all):
    check(tricky, 4096)
    assert packing.pack(none_at_all, PATH).count() == 0
