"""Sharding: exact sizes, gapless slots, whole rows, the same rows every time, and even odds."""

from __future__ import annotations

import collections

import numpy as np
import pytest

from holdfast.llm import sharding


@pytest.mark.parametrize(("part_rows", "most_blocks"), [(250_000, 4_096), (3, 4_096), (3, 1), (250_000, 2)])
def test_sizes_and_slots(odd_docs, part_rows, most_blocks):
    out = sharding.shuffle_into_shards(odd_docs, 4, block_rows=3, part_rows=part_rows, most_blocks=most_blocks)
    rows = out.collect()
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "shard", "slot"]
    assert collections.Counter((r.doc_id, r.text) for r in rows) == collections.Counter((r.doc_id, r.text) for r in odd_docs.collect())
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(v) for v in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    again = sharding.shuffle_into_shards(odd_docs.repartition(5), 4, block_rows=3, part_rows=part_rows, most_blocks=most_blocks).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_more_shards_than_rows_and_no_rows(spark, no_docs):
    assert {r.slot for r in sharding.shuffle_into_shards(spark.range(3), 9).collect()} == {0}
    assert sharding.shuffle_into_shards(no_docs, 4).count() == 0


def test_matrix_has_its_margins_and_law():
    seen = np.array([sharding.communication_matrix([6, 4], [5, 5], s) for s in range(2_000)])
    assert (seen.sum(axis=2) == [6, 4]).all() and (seen.sum(axis=1) == [5, 5]).all()
    assert abs(seen[:, 0, 0].mean() - 3) < 0.08 and abs(seen[:, 0, 0].var() - 5 * 0.6 * 0.4 * 5 / 9) < 0.08


def test_plan_stays_in_the_jvm(spark, sf_dir):
    out = sharding.op6_shard_shuffle(spark, sf_dir)
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
    assert {r.shard for r in out.collect()} == set(range(40))


def test_digests_by_brute_force(spark, sf_dir):
    import zlib

    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in sharding.op6_shard_shuffle(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    assert all((got[d].size, got[d].text_crc32, got[d].law, got[d].grown_shard) == (len(t) + 16, zlib.crc32(t), "rows", None) for d, t in texts.items())


def test_even_odds_also_in_cuts(spark):
    """A row goes to each shard equally often over seeds, however blocks are cut."""
    seen = collections.Counter()
    for seed in range(60):
        rows = sharding.shuffle_into_shards(spark.range(12).coalesce(1), 3, seed=seed, block_rows=2, part_rows=2, most_blocks=2).collect()
        seen.update((r.id, r.shard) for r in rows)
    assert all(5 <= seen[i, s] <= 36 for i in range(12) for s in range(3))
