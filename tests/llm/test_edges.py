"""Short, lone and broken texts, and ids of every kind."""

import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, decontaminate, queries, substring_dedup
from tests.llm.data import docs_frame, ordered, prose

BROKEN = "cast(unhex('{}') as string)"


def test_substring_dedup_of_short_texts_alone_in_their_partitions(spark):
    rows = [(1, ""), (2, "one"), (3, "three short words"), (4, None), (5, prose(1, 49)), (6, prose(2, 80)), (7, prose(2, 80))]
    got = substring_dedup.remove_repeats(docs_frame(spark, rows).repartition(len(rows), "doc_id")).select("doc_id", "n_words", "n_removed")
    assert ordered(got.collect()) == ordered((i, len((t or "").split()), 80 if i == 7 else 0) for i, t in rows)
    only = substring_dedup.remove_repeats(docs_frame(spark, [(1, "short")]).coalesce(1))
    assert [tuple(r)[:3] for r in only.collect()] == [(1, 1, 0)]


def test_substring_dedup_needs_ordered_ids(spark):
    with pytest.raises(TypeError, match="integer"):
        substring_dedup.remove_repeats(spark.sql("SELECT 'a' AS doc_id, 'x' AS text"))
    assert substring_dedup.remove_repeats(spark.sql("SELECT 1S AS doc_id, 'x' AS text")).first().doc_id == 1


def test_bytes_that_are_not_utf8(spark):
    words = " ".join(f"w{i}" for i in range(60)).encode()
    broken = (b"\xff\xfe x " + words).hex()
    docs = spark.range(1, 3).select(F.col("id").alias("doc_id"), F.expr(BROKEN.format(broken)).alias("text"))
    first, second = substring_dedup.remove_repeats(docs).orderBy("doc_id").collect()
    assert (first.n_removed, second.n_removed) == (0, 62) and first.kept.startswith("�� x w0")
    coded = byte_bpe.encode(docs, queries.tokenizer(), decoded=True).collect()
    assert all(r.decoded.decode() == bytes.fromhex(broken).decode("utf-8", "replace") for r in coded)
    items = spark.range(2).select(F.col("id").alias("item_id"), F.expr(
        f"if(id = 0, {BROKEN.format((b'a' + bytes([0xfe])).hex())}, {BROKEN.format((b'a' + bytes([0xff])).hex())})").alias("text"))
    found = decontaminate.find_passages(spark.sql(f"SELECT 1 AS doc_id, {BROKEN.format((b'b a' + bytes([0xff])).hex())} AS text"), items).first()
    assert (found.n_words, found.n_hit, list(found["items"])) == (2, 1, [1])


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "string", "double", "decimal(9,0)", "date"])
def test_item_ids_of_every_type(spark, kind):
    ident = "date '2020-01-07'" if kind == "date" else "7"
    items = spark.sql(f"SELECT cast({ident} AS {kind}) AS item_id, 'some benchmark words' AS text")
    found = decontaminate.find_passages(docs_frame(spark, [(1, "with some benchmark words")]), items)
    assert found.schema["items"].dataType.elementType == items.schema["item_id"].dataType
    assert list(found.first()["items"]) == [items.first().item_id]


def test_token_digests_of_a_lone_empty_text(spark):
    got = queries.token_digests(docs_frame(spark, [(1, "")]).coalesce(1), queries.tokenizer()).first()
    nothing = hashlib.sha256(b"").hexdigest()
    assert (got.n_tokens, got.ids_sha256, got.decoded_sha256) == (0, nothing, nothing)
