"""The corpus pipeline, each stage against a plain version of it on its own input."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from test_queries import roots, simhash

corpus_pipeline = pytest.importorskip("corpus_pipeline")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Input and output rows of each stage."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(folder / str(k)))
        after = spark.read.parquet(str(folder / str(k)))
        seen.append((docs.collect(), after.collect(), after.columns))
        docs = after
    return seen


def test_stages_keep_the_columns_of_documents(stages):
    assert all(columns == COLUMNS for _, _, columns in stages[:-1])


def test_toxic_documents_go_and_clean_ones_stay(stages, tables):
    before, after, _ = stages[0]
    left = {r.doc_id for r in after}
    labels = dict(tables.execute("select doc_id, toxic from labels").fetchall())
    clean = [r.doc_id for r in before if labels.get(r.doc_id) == 0]
    assert sum(i in left for i in clean) / len(clean) > 0.95
    assert set(after) <= set(before)


def test_one_of_equal_texts_stays(stages):
    before, after, _ = stages[1]
    lowest = {}
    for r in before:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")
        if text not in lowest or r.doc_id < lowest[text].doc_id:
            lowest[text] = r
    assert sorted(after) == sorted(lowest.values())


def test_one_of_each_near_group_stays(stages):
    before, after, _ = stages[2]
    root = roots({r.doc_id: simhash(r.text or "") for r in before}, 4)
    assert sorted(after) == sorted(r for r in before if root[r.doc_id] == r.doc_id)


def test_documents_are_taken_up_to_twice(stages):
    before, after, _ = stages[3]
    copies = Counter(after)
    assert set(copies) <= set(before) and max(copies.values()) <= 2

    def size(r):
        return len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))

    total = sum(map(size, before))
    assert sum(map(size, after)) == pytest.approx(1.5 * total, rel=0.1)


def test_every_copy_is_packed_once(stages):
    before, after, _ = stages[4]
    assert Counter(r.doc_id for r in after if r.piece == 0) == Counter(r.doc_id for r in before)
    ends = {}
    for r in sorted(after, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048


def test_run_is_the_stages_in_order(stages, spark, sf_dir):
    assert sorted(corpus_pipeline.run(spark, sf_dir).collect()) == sorted(stages[4][1])
