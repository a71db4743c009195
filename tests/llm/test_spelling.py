import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarryline.llm import spelling as sp


def brute_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(
        (w, form[w] or "", root(w), n, len(near[w]), words[form[w]] if form[w] else 0) for w, n in words.items()
    )


def mine(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def edited(draw, word):
    at, kind = draw.randrange(len(word)), draw.randrange(3)
    if kind == 0:
        return word[:at] + word[at + 1 :]
    return word[:at] + draw.choice("abcéÿ") + word[at + (kind == 1) :]


@pytest.mark.parametrize("letters,length", [("ab", 9), ("abcdeéÉÿ", 7), ("aaaaab", 12)])
def test_variants_equal_brute_force(spark, letters, length):
    draw = random.Random(length)
    base = ["".join(draw.choices(letters, k=draw.randint(6, length))) for _ in range(60)]
    rows = []
    for word in base:
        some = [word] * 40 + [edited(draw, word) for _ in range(6) for _ in range(2)]
        once = edited(draw, word)
        some += [word] * 200 + [once] * 25 + [edited(draw, once)] * 2 + [word.upper()] * draw.randint(0, 90)
        rows += [(i, " ".join(draw.sample(some, len(some)))) for i in range(len(rows), len(rows) + 3)]
    rows += [(None, "Straße, straßen-bahnen " * 4), (5, None), (5, ""), (1, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_variants(brute_words(rows))
    assert mine(sp.variants(docs)) == want
    assert any(w[1] for w in want)
    assert len(letters) < 8 or any(w[1] and w[2] != w[1] for w in want)  # forms of forms


def test_every_pair_one_edit_apart_is_found(spark):
    """All words of six to eight letters over two letters: the most ties a vocabulary can have."""
    words = [format(i, f"0{k}b").replace("0", "a").replace("1", "b") for k in (6, 7, 8) for i in range(1 << k)]
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = {tuple(sorted(r)) for r in sp.near_pairs(table).collect()}
    want = {(a, b) for i, a in enumerate(words) for b in words[i:] if one_edit(a, b)}
    assert got == {tuple(sorted(p)) for p in want}
    assert sp.near_pairs(table).count() == len(want)


def test_pivots_are_the_cheapest_disjoint_pair():
    draw = random.Random(2)
    for _ in range(300):
        places = draw.sample(range(8), 3)
        grams = [(draw.randint(1, 5), i, p) for i, p in enumerate(places)]
        got = sp.pivots(grams)
        pairs = [(a, b) for a in grams for b in grams if b[2] - a[2] >= 2]
        assert abs(got[0][2] - got[1][2]) >= 2
        assert sum(g[0] for g in got) == min(a[0] + b[0] for a, b in pairs)


def test_tricky_rows(spark, tricky, none_at_all):
    rows = [(r["doc_id"], r["text"]) for r in tricky.collect()]
    assert mine(sp.variants(tricky)) == brute_variants(brute_words(rows))
    empty = sp.variants(none_at_all)
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.count() == 0


def test_words_as_they_are_without_damage(spark):
    rows = [(i, "Beispiel beispiel") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [tuple(r) for r in sp.count_words(docs, damage=False).collect()] == [("beispiel", 1000)]
    damaged = sp.count_words(docs).agg(F.sum("n"), F.count("*")).first()
    assert damaged[0] == 1000 and damaged[1] > 1


def test_query(spark, sf_dir):
    from quarryline.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute_variants(brute_words([tuple(r) for r in docs]))
    assert mine(QUERIES["op11_pivotal_grams"](spark, sf_dir)) == want and want
