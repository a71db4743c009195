import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarryline.llm import token_counts as tc

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"]


def whole(name):
    """Counts of whole texts by the library alone."""
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text or ""))
    known = Tokenizer.from_file(path)
    return lambda text: len(known.encode(text or "", add_special_tokens=False).ids)


def odd_texts():
    draw = random.Random(5)
    parts = [
        "the quick", " ", "  ", "\n", "\t\r\n", "'s", "'ll", "don't", "12345", "...", "!!'s", "<|endoftext|>",
        "<|startoftext|>", "<|end", "é", "́", "éè", "日本語", "한국",
        "한", "İstanbul", "ΣΣ", "\U0001f600", " ", " ", "‍", "x" * 30,
        "qzxj" * 9, "ACGT" * 12, "=" * 25, "عرب", "▁", "\u0000",
    ]
    for i in range(80):
        some = draw.sample(parts, draw.randint(1, 12))
        yield "".join(draw.choices(some, k=draw.randint(1, 120)))


@pytest.mark.parametrize("name", FILES)
@pytest.mark.parametrize("chunk,overlap", [(40, 7), (25, 1)])
def test_spliced_counts_equal_those_of_whole_texts(spark, name, chunk, overlap):
    texts = list(odd_texts())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    count = whole(name)
    got = tc.count_tokens(docs, public_tokenizers.path(name), chunk=chunk, overlap=overlap).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["row"]["doc_id"]]
        assert (r["n_tokens"], r["n_bytes"]) == (count(text), len(text.encode())), text


@pytest.mark.parametrize("name", FILES)
def test_the_proof_holds_wherever_the_text_began(name):
    """From a proven place on, the tokens are those of the whole text, from whatever start."""
    known, places = tc.encoder(public_tokenizers.path(name)), 0
    for text in odd_texts():
        starts, ends = known.bounds(text)
        for place in tc.stable_places(known, text, 1, len(text)):
            after = sum(s >= place for s in starts)
            assert not any(s < place < e for s, e in zip(starts, ends))
            for back in range(1, min(place, 12)):
                some, _ = known.bounds(text[place - back :])
                assert sum(s >= back for s in some) == after, (text, place, back)
            places += 1
    assert places > 100


def test_a_text_without_stable_place_is_encoded_as_a_whole(spark):
    name = FILES[0]
    text = "=" * 5000
    known = tc.encoder(public_tokenizers.path(name))
    assert tc.stable_places(known, text, 1, len(text)) == []
    docs = spark.createDataFrame([(1, "word " * 500 + text + " word" * 500)], "doc_id long, text string")
    got = tc.count_tokens(docs, public_tokenizers.path(name), chunk=100, overlap=5).first()
    assert got["n_tokens"] == whole(name)("word " * 500 + text + " word" * 500)


def test_letters_without_blanks_are_spliced_by_the_vocabulary():
    known = tc.encoder(public_tokenizers.path(FILES[0]))
    assert tc.stable_places(known, "qzxjvqwkz" * 100, 1, 900)


def test_tricky_rows(spark, tricky, none_at_all):
    path, count = public_tokenizers.path(FILES[0]), whole(FILES[0])
    for chunk, overlap in ((tc.CHUNK, tc.OVERLAP), (900, 9)):
        got = tc.count_tokens(tricky, path, carry=["doc_id", "row"], chunk=chunk, overlap=overlap)
        mine = sorted((r["row"]["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got.collect())
        texts = [(r["doc_id"] or 0, r["text"] or "") for r in tricky.collect()]
        assert mine == sorted((i, len(t.encode()), count(t)) for i, t in texts)
    empty = tc.count_tokens(none_at_all, path)
    assert empty.columns == ["row", "n_bytes", "n_tokens"] and empty.count() == 0


def test_query(spark, sf_dir):
    from quarryline.llm.queries import QUERIES, TOKENIZER

    count = whole(TOKENIZER)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op12_overlap_counts"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for r in docs:
        n = count(r["text"])
        mine = got[r["doc_id"]]
        assert (mine["n_bytes"], mine["n_tokens"], mine["over_limit"]) == (len((r["text"] or "").encode()), n, n > 2048)
