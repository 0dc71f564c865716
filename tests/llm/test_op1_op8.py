"""Sharding and mixing against plain computations."""

from __future__ import annotations

import zlib

from oracle_compare import compare, connect

from parcelflow.llm import mixing, sharding
from parcelflow.llm.common import table


def _check_shards(rows, docs, shards):
    want = sorted((r.doc_id if r.doc_id is not None else -1, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs)
    assert want == sorted((r.doc_id if r.doc_id is not None else -1, r.size, r.text_crc32) for r in rows)
    for shard in range(shards):
        mine = [r for r in rows if r.shard == shard]
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
    assert all(0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None for r in rows)


def test_shards_hold_near_equal_bytes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = sharding.shard_rows(docs, 8).collect()
    _check_shards(rows, docs.select("doc_id", "text").collect(), 8)
    loads = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
    largest = max(r.size for r in rows)
    assert max(loads) - min(loads) <= 2 * largest
    again = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(docs, 8).collect()}
    assert again == {r.doc_id: (r.shard, r.slot) for r in rows}


def test_copies_do_not_unbalance_shards(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'same text' AS text", "'en' AS lang", "'s' AS source", "9L AS n_chars")
    counts = [r["count"] for r in sharding.shard_rows(docs, 8).groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 8


def test_odd_rows_are_sharded(odd_docs, no_docs):
    _check_shards(sharding.shard_rows(odd_docs, 3).collect(), odd_docs.select("doc_id", "text").collect(), 3)
    assert sharding.shard_rows(no_docs, 8).count() == 0
    placed = sharding.sharded(odd_docs, sharding.build_tree(odd_docs, target_bytes=100_000))
    assert placed.count() == odd_docs.count()
    # A column of the documents' own stays as it is.
    assert {r.shard for r in placed.collect()} == {"t"} and placed.columns[-2:] == ["law", "shard_"]


def test_mixture_equals_sql(spark, sf_dir):
    con = connect(sf_dir)
    run = lambda s, d: mixing.mixture_plan(table(s, d, "documents"))
    assert compare(spark, con, "mix", run, mixing.ORACLE_SQL, sf_dir) == []


def _filled(sizes, weights=(5, 2, 1)):
    """Targets by the rule itself: share, stop, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in stopped]
        level = (total - sum(stopped.values())) / max(1, sum(w[s] for s in rest))
        over = [s for s in rest if level * w[s] > 3 * sizes[s]]
        if not over:
            return {s: stopped.get(s, level * w[s]) for s in names}
        stopped |= {s: 3 * sizes[s] for s in over}


def test_targets_stop_and_share_again(spark):
    sizes = {"a": 1, "b": 1000, "c": 40, "d": 3, "e": 0, None: 500}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    want = _filled(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_odd_rows_are_mixed(odd_docs, no_docs):
    rows = mixing.mixture_plan(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    assert mixing.mixture_plan(no_docs).count() == 0
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    words = sum(len((r.text or "").split()) for r in out.collect())
    assert words == sum(r.taken for r in rows)
