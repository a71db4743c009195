import math

import pytest

from quarryline.llm import langid
from quarryline.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = QUERIES["op5_nearest_centroid"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held = got.join(docs, "doc_id").filter("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)


def test_odd_rows(spark, tricky, none_at_all):
    model = langid.fit(tricky)
    named, name = langid.identify(tricky, model)
    assert name == "language_1" and named.columns == [*tricky.columns, name]
    for r in named.collect():
        answer = r[name]
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (answer["lang"], answer["score"], answer["rejected"]) == ("und", 0.0, True)
        else:
            assert answer["lang"] in {"en", "de", "fr"} and 0 <= answer["score"] <= 1
    assert langid.identify(none_at_all, model)[0].count() == 0


def test_nothing_learned(spark, tricky, none_at_all):
    model = langid.fit(none_at_all)
    assert model.languages == []
    named, name = langid.identify(tricky, model)
    assert {r[name]["lang"] for r in named.collect()} == {"und"}


def test_far_texts_are_rejected(spark, prose):
    rows = [(i, prose(100, i), "xx") for i in range(60)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    probe = [(1, prose(100, 999)), (2, "qwrtz kjhgf wvxpz ztrwq fghjk " * 20)]
    named, name = langid.identify(spark.createDataFrame(probe, "doc_id long, text string"), model)
    assert [r[name]["rejected"] for r in named.orderBy("doc_id").collect()] == [False, True]


def test_vectors_have_length_one(prose):
    weights = langid.np.ones(langid.DIMENSIONS)
    assert math.isclose(langid.np.linalg.norm(langid.vector_of(prose(20, 3), weights)), 1)
    assert not langid.vector_of("", weights)[1:].all()


@pytest.mark.parametrize("clusters", [1, langid.CLUSTERS])
def test_floors_do_not_follow_mislabelled_texts(spark, prose, clusters):
    """Foreign texts and code stay rejected where a few of them have the label of the language."""
    other = "kaikki ihmiset syntyvat vapaina ja tasavertaisina arvoltaan oikeuksiltaan"
    code = "for i in range(len(rows)): out.append(rows[i].strip().split(',')[0])"
    wrong = [" ".join([t] * n) for t in (other, code) for n in (1, 5)]
    rows = [(i, prose(100, i), "xx") for i in range(400)] + [(400 + i, t, "xx") for i, t in enumerate(wrong)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), clusters=clusters)
    texts = [prose(100, 999), prose(300, 998), prose(40, 997), other * 8, code * 8, other, code]
    probe = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    named, name = langid.identify(probe, model)
    got = [r[name]["rejected"] for r in named.orderBy("doc_id").collect()]
    assert got == [False] * 3 + [True] * 4


def test_short_texts_have_floors_of_their_own():
    cosine = langid.np.array([0.2] * 40 + [0.6] * 40)
    bands = langid.np.array([2] * 40 + [6] * 40)
    floors = langid._floors(cosine, bands)
    assert floors[2] == 0.2 and floors[6] == 0.6


def _plain_counts(text):
    """n-grams of bytes, one by one: letters of ASCII in lower case, others of ASCII as one space."""
    kept = []
    for byte in text.encode():
        letter = chr(byte).lower() if byte < 128 and chr(byte).isalpha() else byte if byte >= 128 else " "
        kept.append(ord(letter) if isinstance(letter, str) else letter)
    data = b" " + b" ".join(bytes(kept).split(b" ")) + b" "
    while b"  " in data:
        data = data.replace(b"  ", b" ")
    counts = [0] * langid.DIMENSIONS
    for size in (1, 2, 3):
        for at in range(len(data) - size + 1):
            code = (size % 3) << 24 | int.from_bytes(data[at : at + size], "big")  # told apart by size
            counts[(code * 2654435761 % 2**32) >> 20] += 1
    return counts


def _plain_vector(text, idf):
    vector = [math.log1p(n) * w for n, w in zip(_plain_counts(text), idf)]
    length = math.sqrt(sum(x * x for x in vector))
    return [x / length for x in vector]


def test_equals_brute_force(spark, prose):
    """Document frequencies, the one centroid of a language and cosines, computed one by one."""
    texts = [(i, prose(30 + i, i), "a") for i in range(8)]
    texts += [(8 + i, "Zażółć gęślą jaźń, " * (i + 1) + prose(3, i), "b") for i in range(8)]
    texts += [(16, "12 34", "a"), (17, prose(5, 1), None)]  # no letter, no label: teach nothing
    model = langid.fit(spark.createDataFrame(texts, "doc_id long, text string, lang string"), clusters=1)
    taught = [(t, lang) for _, t, lang in texts[:16]]
    seen = [sum(c > 0 for c in column) for column in zip(*(_plain_counts(t) for t, _ in taught))]
    idf = [math.log(17 / (1 + n)) + 1 for n in seen]
    assert model.weights == pytest.approx(idf)
    assert model.languages == ["a", "b"]
    for k, lang in enumerate("ab"):
        total = [sum(column) for column in zip(*(_plain_vector(t, idf) for t, name in taught if name == lang))]
        length = math.sqrt(sum(x * x for x in total))
        assert model.centroids[k] == pytest.approx([x / length for x in total], abs=1e-5)
    docs = spark.createDataFrame([(i, t) for i, t, _ in texts if i != 16], "doc_id long, text string")
    named, name = langid.identify(docs, model)
    for row in named.collect():
        vector = _plain_vector(row["text"], idf)
        cosine = [sum(x * y for x, y in zip(vector, c)) for c in model.centroids]
        best = max(range(2), key=cosine.__getitem__)
        assert row[name]["lang"] == model.languages[best]
        assert row[name]["score"] == pytest.approx(min(1.0, cosine[best]))


def test_sample_is_bounded_by_rows(spark, prose, monkeypatch):
    """Copies are drawn apart, and equal texts that were drawn count once."""
    rows = [(i, prose(20, i % 3), "a") for i in range(3000)] + [(i, prose(20, i), "a") for i in range(10, 510)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    plain = langid._clusters

    def seen(rows, weights, clusters):
        return plain(rows, weights, clusters)[:1] * len(rows)  # as many centroids as texts

    monkeypatch.setattr(langid, "_clusters", seen)
    sizes = [len(langid.fit(table, per_language=n, key="doc_id", clusters=1).languages) for n in (100, 350)]
    assert 3 <= sizes[0] < 60 and sizes[0] < sizes[1] < 150  # of 503 different texts in 3,500 rows
    monkeypatch.undo()
    whole = langid.fit(table, per_language=10**6, key="doc_id", clusters=1)
    distinct = {t for _, t, _ in rows}
    idf = list(whole.weights)
    total = [sum(column) for column in zip(*(_plain_vector(t, idf) for t in distinct))]
    length = math.sqrt(sum(x * x for x in total))
    assert whole.centroids[0] == pytest.approx([x / length for x in total], abs=1e-4)
