import hashlib
import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import spotsigs


def brute_force(text, chain=spotsigs.CHAIN):
    """Signatures as tuples: the anchor with the next content words."""
    words = [w.strip(spotsigs.MARKS) or w for w in spotsigs.words_of(text)]
    spots = [(None, words)] + [(w, words[i + 1 :]) for i, w in enumerate(words) if w in spotsigs.ANCHORS]
    found = set()
    for anchor, rest in spots:
        content = [w for w in rest if w not in spotsigs.ANCHORS][:chain]
        if content or (anchor is None and words):
            found.add((anchor, *(content or words)))
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("the a of cat, dog. bird Fish der und Haus été".split()), max_size=30))
def test_as_many_signatures_as_brute_force(words):
    text = " ".join(words)
    assert len(spotsigs.signatures(text)) == len(brute_force(text))


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.sampled_from("the a of cat dog bird fish".split()), max_size=40),
    st.lists(st.sampled_from("the a of cat dog bird fish".split()), max_size=40),
)
def test_likeness_is_jaccard_and_pruning_is_safe(left, right):
    a, b = " ".join(left), " ".join(right)
    one, two = brute_force(a), brute_force(b)
    want = len(one & two) / len(one | two) if one | two else 1.0
    x, y = spotsigs.signatures(a), spotsigs.signatures(b)
    assert abs(spotsigs.likeness(x, y) - want) < 1e-12
    for floor in (0.3, 0.8):
        assert spotsigs.likeness(x, y, floor) == (spotsigs.likeness(x, y) if want >= floor else 0.0)


def test_similar_lengths_lie_in_neighbouring_partitions():
    for a in range(1, 3000, 7):
        for b in range(a, int(a / 0.8) + 1):
            assert spotsigs.partition_of(b, 0.8) - spotsigs.partition_of(a, 0.8) <= 1


def test_fingerprint_text_keeps_the_set():
    found = spotsigs.signatures("The cat of the house and the dog of a bird.")
    assert np.array_equal(spotsigs.signatures_of(spotsigs.fingerprint(found)), found)


def test_edits_follow_the_order_of_ids(spark, prose):
    texts = {i: prose(5 + i % 60, i) for i in range(300)} | {300: None, 301: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r["row"]["doc_id"]: r for r in spotsigs.with_edits(docs).collect()}
    ids = sorted(texts, reverse=True)
    for here, there in zip(ids, ids[1:] + ids[:1]):
        text, following = texts[here] or "", texts[there] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        row = got[here]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert row["edited_fingerprint"] == spotsigs.fingerprint(spotsigs.signatures(new))
        assert row["near_next"] == spotsigs.likeness(
            spotsigs.signatures(text), spotsigs.signatures(following)
        )


def test_odd_rows(spark, tricky, none_at_all):
    got = spotsigs.with_edits(tricky, carry=["doc_id", "text", "row"]).collect()
    assert len(got) == tricky.count()
    by_text = {}
    for r in got:
        by_text.setdefault(r["row"]["text"] or "", set()).add(r["fingerprint"])
    assert all(len(prints) == 1 for prints in by_text.values())
    assert spotsigs.with_edits(none_at_all).count() == 0
    alone = spotsigs.with_edits(tricky.filter("doc_id = 9")).first()
    assert alone["near_next"] == 1.0


def made_up(seed, n, like):
    """n words that are no common words, put together as in one kind of text."""
    draw = random.Random(seed)
    words = ["".join(draw.choices("bdgklmnprstvz", k=2)) + draw.choice("äôuiy") * 2 + str(draw.randint(0, 99)) for _ in range(n)]
    return like(words)


KINDS = {
    "list": " | ".join,
    "words": " ".join,
    "lines": "\n".join,
    "code": lambda words: "\n".join(f"{w}_x = f({w!r})" for w in words),
    "marked": lambda words: " ".join(f"{w} {a}" for w, a in zip(words, itertools.cycle(["von&&&", "la,&&&"]))),
}


@pytest.mark.parametrize("kind", KINDS)
def test_half_replaced_texts_are_not_near(kind):
    for seed in range(40):
        text, other = (made_up(s, 60, KINDS[kind]) for s in (seed, seed + 1000))
        found = spotsigs.signatures(text)
        assert len(found) > 3
        assert spotsigs.likeness(found, spotsigs.signatures(spotsigs.edited(text, other))) < 0.8


def test_common_words_are_known_by_their_letters():
    for word in ("von&&&", "LA,&&&", "FÜR", "--the--", "of,"):
        assert spotsigs.SPOT_HASHES[word.encode()] & spotsigs.ANCHOR_BIT
    for word in ("&&&", "|", "vonder"):
        assert not spotsigs.SPOT_HASHES[word.encode()] & spotsigs.ANCHOR_BIT
