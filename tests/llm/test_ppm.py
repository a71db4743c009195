import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import ppm
from quarryline.llm.common import words_of
from quarryline.llm.queries import QUERIES


def brute_force(texts, learns, order):
    """log10 probabilities by a dictionary of contexts, one symbol at a time."""

    def symbols(text):
        return [257] * order + list(b" ".join(words_of(text))) + [256]

    trie = defaultdict(Counter)
    for text, learn in zip(texts, learns):
        found = symbols(text) if learn else []
        for at in range(order, len(found)):
            for length in range(order + 1):
                trie[tuple(found[at - length : at])][found[at]] += 1

    def score(text):
        found, total = symbols(text), 0.0
        for at in range(order, len(found)):
            gone, coded = set(), False
            for length in range(order, -1, -1):
                context = tuple(found[at - length : at])
                if context not in trie:
                    continue
                left = {s: n for s, n in trie[context].items() if s not in gone}
                if found[at] in left:
                    total += math.log10((left[found[at]] - ppm.DISCOUNT) / sum(left.values()))
                    coded = True
                    break
                if left:
                    total += math.log10(ppm.DISCOUNT * len(left) / sum(left.values()))
                gone = set(trie[context])
            if not coded:
                total -= math.log10(257 - len(gone))
        return total

    return [score(t) for t in texts]


@pytest.mark.parametrize("order", [3, 5, 6])
def test_scores_equal_brute_force(spark, prose, order):
    texts = [prose(n, n) for n in range(1, 40)] + [None, "", "ÄÖ new words"]
    rows = [(i, t, i % 3 > 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    got = ppm.score(docs, F.col("learn"), order=order, block_bytes=500).collect()
    want = brute_force(texts, [r[2] for r in rows], order)
    assert len(got) == len(rows)
    for r in got:
        assert r["score"] == pytest.approx(want[r["row"]["doc_id"]], rel=1e-5)


def test_probabilities_sum_to_one(prose):
    streams = [prose(50, i).encode() for i in range(5)]
    codes = ppm.gram_codes(streams, 3)
    grams, counts = np.unique(codes, return_counts=True)
    levels = ppm.levels_of(grams, counts, range(4), None)
    for context in [*levels[3].contexts[:20], 1 << 20]:
        every = (np.int64(context) << ppm.BITS) + np.arange(257)
        assert (10 ** ppm.log10_probabilities(every, levels)).sum() == pytest.approx(1)


def test_baseline_counts(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op1_byte_contexts"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    tokens = {d["doc_id"]: [*words_of(d["text"]), None] for d in docs}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total = sum(counts.values())
    assert len(got) == len(tokens)
    for i, ws in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in ws)
        known = sum(counts[w] > 0 for w in ws)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), known, total)
        assert r["held_out"] == held[i] and r["base_score"] == pytest.approx(base)


def test_odd_rows(spark, tricky, none_at_all):
    got = ppm.score(tricky, F.col("doc_id") < 9, carry=["doc_id", "text", "size"]).collect()
    assert len(got) == tricky.count() and all(math.isfinite(r["score"]) for r in got)
    assert {r["n_tokens"] for r in got if not (r["row"]["text"] or "").split()} == {1}
    assert ppm.score(none_at_all, F.lit(True)).count() == 0
    untaught = ppm.score(tricky, F.lit(False)).collect()
    assert {r["train_tokens"] for r in untaught} == {0}
    assert {r["base_score"] for r in untaught} == {0.0}
