import hashlib

import pytest
from pyspark.sql import functions as F

from chunkspark.llm import exact_dedup
from chunkspark.llm.exact_dedup import exact_groups, exact_keep


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    return {(i, t or ""): (max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""])) for i, t in rows}


ROWS = [(1, "a"), (2, "b"), (3, "a"), (4, None), (5, ""), (6, "aa"), (7, "A"), (8, "b" * 200_000), (9, "b" * 200_000), (None, "a"), (None, "alone")]


@pytest.mark.parametrize("weak", [False, True])
@pytest.mark.parametrize("hot", [1_000, 1])
def test_groups_match_whole_texts_even_under_a_weak_digest(spark, monkeypatch, weak, hot):
    monkeypatch.setattr(exact_dedup, "HOT", hot)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    digest = (lambda t: F.length(t).cast("string").cast("binary")) if weak else exact_dedup.sha256
    want = brute(ROWS)
    found = exact_groups(docs, digest=digest).collect()
    assert len(found) == len(ROWS)
    assert sorted((r.keep_id, r.group_size) for r in found if r.doc_id) == sorted(v for (i, _), v in want.items() if i)
    assert {r.doc_id for r in found if r.kept and r.doc_id} == {3, 2, 5, 6, 7, 9}
    assert sum(r.kept for r in found) == 7
    kept = exact_keep(docs, digest=digest).collect()
    assert sorted(((r.doc_id or -1), r.text or "") for r in kept) == sorted(
        (i, t) for i, t in [(2, "b"), (3, "a"), (5, ""), (6, "aa"), (7, "A"), (9, "b" * 200_000), (-1, "alone")])


def test_repeated_rows_keep_one_and_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "x", "q", 1), (1, "x", "q", 1), (1, "x", "r", 2)], "doc_id long, text string, _text string, _digest int")
    found = exact_groups(docs).collect()
    assert [r.group_size for r in found] == [3, 3, 3] and sum(r.kept for r in found) == 1
    kept = exact_keep(docs)
    assert kept.columns == docs.columns and kept.count() == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_groups(docs).count() == 0 and exact_keep(docs).count() == 0


def test_digest_is_sha256(spark):
    row = exact_groups(spark.createDataFrame([(1, "é")], "doc_id long, text string")).first()
    assert bytes(row.digest) == hashlib.sha256("é".encode()).digest()
