"""Each stage against a plain version of what it promises, and all of them in a row."""

import re
from collections import Counter

import public_tokenizers
from test_similarity_join import brute_force
from tokenizers import Tokenizer

import corpus_pipeline as cp
from quarryline.llm import langid

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_stages_follow_each_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["language", "exact copies", "near copies", "source mix", "packing"]

    named = cp.known_language(spark, docs, sf_dir)
    assert named.columns == COLUMNS
    lettered = docs.filter(langid.has_letter(langid.F.col("text")))
    assert set(rows_of(named)) <= set(rows_of(lettered))
    assert named.count() >= 0.98 * lettered.count()

    exact = cp.without_copies(spark, named, sf_dir)
    assert exact.columns == COLUMNS
    first = {}
    for r in sorted(rows_of(named)):
        first.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r[1]), r)
    assert sorted(rows_of(exact)) == sorted(first.values())

    near = cp.without_near_copies(spark, exact, sf_dir)
    assert near.columns == COLUMNS
    rows = rows_of(exact)
    leads = {c for _, c in brute_force([r[:2] for r in rows])}
    assert sorted(rows_of(near)) == sorted(r for r in rows if r[0] in leads)

    mixed = cp.mixed_sources(spark, near, sf_dir)
    assert mixed.columns == COLUMNS
    times = Counter(rows_of(mixed))
    assert set(times) <= set(rows_of(near)) and max(times.values()) <= 3
    words = sum(len(r[1].encode().split()) for r in rows_of(near))
    taken = sum(n * len(r[1].encode().split()) for r, n in times.items())
    assert abs(taken - words) <= 0.05 * words

    packed = cp.packed_sequences(spark, mixed, sf_dir).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = sum(n * (1 + len(tokenizer.encode(r[1], add_special_tokens=False).ids)) for r, n in times.items())
    assert sum(r["length"] for r in packed) == lengths
    filled = Counter()
    for r in packed:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 4096 and len(filled) <= -(-lengths // 4096) + 2


def test_run_is_stable(spark, sf_dir):
    first, second = (
        sorted(tuple(r)[:5] for r in cp.run(spark, sf_dir).collect()) for _ in range(2)
    )
    assert first == second and first


def test_stages_survive_odd_rows(spark, sf_dir, tricky, none_at_all):
    for docs in (tricky, none_at_all):
        for name, stage in cp.STAGES:
            out = cp.written(stage(spark, docs, sf_dir), f"odd-{name.replace(' ', '-')}")
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
            out.count()
