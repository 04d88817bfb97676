import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks.compare import DATA, duck, multiset, spark_rows
from tests.llm.cases import PROSE, documents, empty, rows_of
from trackmart.llm import queries
from trackmart.llm.lines import drop_frequent_lines, frequent_lines

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, least, min_chars=1):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in text.split("\n"):
            holders[key(line)].add(doc_id)
    often = {k for k, ids in holders.items() if len(k) >= min_chars and k and len(ids) >= least}
    out = []
    for doc_id, text in rows:
        parts = text.split("\n")
        kept = [p for p in parts if key(p) not in often]
        out.append((doc_id, "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=str)


def found(docs, **options):
    return sorted(map(tuple, drop_frequent_lines(docs, **options).collect()), key=str)


LINES = ["  Menu ", "menu", "MENU\r", "ÄB", "äb", "\x85menu", "Read more\x1c", "read more", "", " \t", "x", "漢字"]


def some(spark):
    texts = ["\n".join(LINES[(i * j) % len(LINES)] for j in range(1, 9)) for i in range(30)]
    return documents(spark, [None, "", "\n", *texts, *[PROSE + "\nmenu"] * 5, "\n".join(["menu", "own line"] * 20_000)])


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
@pytest.mark.parametrize("least, min_chars", [(2, 1), (10, 1), (10, 3)])
def test_equals_brute_force(spark, least, min_chars, broadcast_bytes):
    docs = some(spark)
    result = found(docs, min_documents=least, min_chars=min_chars, broadcast_bytes=broadcast_bytes)
    assert result == brute(rows_of(docs), least, min_chars)
    assert any(r[3] for r in result)


def test_awkward_documents(spark):
    docs = documents(spark)
    assert found(docs, min_documents=2) == brute(rows_of(docs), 2)
    assert drop_frequent_lines(empty(spark)).collect() == []


def test_repeated_rows_and_repeats_within_a_document_count_once(spark):
    rows = [(1, "a\na\na"), (1, "a\na\na"), (2, "b"), (3, "b"), (None, "c"), (None, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = frequent_lines(docs, min_documents=2)
    assert [r.documents for r in held.collect()] == [2]
    assert found(docs, min_documents=2) == brute(rows, 2)


def test_registered_query_equals_sql(spark):
    sf_dir = f"{DATA}/sf0.001"
    result = duck(sf_dir).execute(queries.ORACLES["op12_line_dedup"])
    columns, rows = spark_rows(queries.QUERIES["op12_line_dedup"](spark, sf_dir))
    assert multiset(columns, rows) == multiset([c[0] for c in result.description], result.fetchall())


def test_digest_is_of_the_text_left(spark):
    docs = some(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    left = drop_frequent_lines(docs).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    expected = {d: hashlib.sha256(t.encode()).hexdigest() for d, t, _, _ in brute(rows_of(docs), 10)}
    assert {r.doc_id: r.digest for r in left.collect()} == expected
