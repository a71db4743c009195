import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarryline.llm import exact_dedup


def check(docs, **options):
    rows = docs.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", r["text"] or "")].append(r["doc_id"])
    got = exact_dedup.deduplicate(docs, carry=["doc_id", "text"], **options).collect()
    assert len(got) == len(rows)
    kept = defaultdict(int)
    for r in got:
        text = re.sub("[\x20\x09-\x0d]+", " ", r["row"]["text"] or "")
        ids = [i for i in groups[text] if i is not None]
        assert r["group_size"] == len(groups[text])
        assert r["keep_id"] == (min(ids) if ids else None)
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        if r["kept"]:
            kept[text] += 1
            assert r["row"]["doc_id"] == r["keep_id"]
    assert dict(kept) == dict.fromkeys(groups, 1)


@pytest.mark.parametrize("room", [1, 3_000, 64 << 20])
def test_small_tables_spill_and_agree(spark, prose, room):
    rows = [(i, prose(1 + i % 37, i % 90)) for i in range(400)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), room=room)


def test_one_text_holds_most_rows(spark, prose):
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 > 0, prose(200, 5)).otherwise(F.col("id").cast("string")).alias("text"),
    )
    check(docs.repartition(16), room=2_000)


def test_odd_rows(spark, tricky, none_at_all):
    check(tricky)
    assert exact_dedup.deduplicate(none_at_all).count() == 0


def test_table_tells_equal_hashes_apart():
    table, digest = exact_dedup.Table(1000), b"0" * 32
    for i in range(50):
        content = str(i).encode()
        entry, slot = table.find(digest, content)
        assert entry == -1
        assert table.add(digest, content, slot) == i
    assert table.find(digest, b"7")[0] == 7
