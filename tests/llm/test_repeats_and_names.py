"""Maps that are edited, ids that repeat, and columns named like the operators' own."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from marketbars.llm import exact_dedup, mixing, sharding, simhash_dedup, toxicity
from marketbars.llm.common import unused


def loads(rows):
    total = Counter()
    for r in rows:
        total[r.shard] += r.size
    return total


def test_a_frequent_id_does_not_meet_in_one_slot(spark):
    docs = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id")).alias("text"),
    )
    got = loads(sharding.shard(docs).collect())
    mean = sum(got.values()) / 16
    assert len(got) == 16 and max(abs(v - mean) for v in got.values()) <= 0.01 * mean


def test_a_stored_map_is_edited(spark, tmp_path):
    path = str(tmp_path / "map")
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text")
    )
    first = {r.doc_id: (r.virtual_slot, r.shard) for r in sharding.shard(docs, 16, path).collect()}
    again = {r.doc_id: (r.virtual_slot, r.shard) for r in sharding.shard(docs, 16, path).collect()}
    assert again == first
    assert [p.name for p in (tmp_path / "map").glob("version=*")] == ["version=1"]
    grown = docs.union(docs.where("doc_id < 900").selectExpr("doc_id + 10000", "repeat(text, 3)"))
    second = {r.doc_id: (r.virtual_slot, r.shard) for r in sharding.shard(grown, 16, path).collect()}
    assert sorted(p.name for p in (tmp_path / "map").glob("version=*")) == ["version=1", "version=2"]
    moved = {second[i][0] for i in first if second[i][1] != first[i][1]}
    assert len(moved) < sharding.SLOTS / 20
    rows = sharding.shard(grown, 16, path).collect()
    even = loads(rows)
    assert max(even.values()) - min(even.values()) <= 0.01 * sum(even.values()) / 16


NAMES = ("_key", "_stay", "_tox", "_doc", "_copies", "_copy", "_gone", "_KEY2")


def test_stages_keep_columns_of_any_name(spark, make_labels):
    words = "one two three four five six seven eight nine ten"
    rows = [(k, f"{words} {k} {words[::-1]} {k * k}", "s", *NAMES) for k in range(12)]
    rows += [(20, rows[3][1], "s", *NAMES), (None, None, None, *NAMES)]
    kind = "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in NAMES)
    docs = spark.createDataFrame(rows, kind)
    assert unused(docs, "_key") == "__key" and unused(docs, "other") == "other"
    labels = make_labels(*((k, 1, 0) for k in range(12)))
    stages = [
        lambda d: toxicity.drop_toxic(d, toxicity.fit(d, labels)),
        exact_dedup.drop_copies,
        simhash_dedup.drop_near_copies,
        mixing.mixed_documents,
    ]
    for stage in stages:
        left = stage(docs)
        assert left.columns == docs.columns
        found = left.collect()
        assert found and all(tuple(r)[3:] == NAMES for r in found)
