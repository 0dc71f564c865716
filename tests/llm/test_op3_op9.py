"""Top-k search and SimHash groups against brute force."""

from __future__ import annotations

import numpy as np
import xxhash
from oracle_compare import compare, connect

from parcelflow.llm import simhash, topk
from parcelflow.llm.bktree import BKTree
from parcelflow.llm.common import table


def test_top_k_equals_sql(spark, sf_dir):
    run = lambda s, d: topk.top_k(table(s, d, "embeddings"))
    assert compare(spark, connect(sf_dir), "topk", run, topk.ORACLE_SQL, sf_dir) == []


def _brute(rows, k, every):
    ok = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out, seen = [], set()
    for i, q in ok:
        if i % every or i in seen:
            continue
        seen.add(i)
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k_with_many_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(300)]
    rows += [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(500)]
    rows += [(None, [1.0] * 4), (2000, None), (2020, [1.0, None, 1.0, 1.0]), (2040, [float("nan")] * 4), (2060, [float("inf")] * 4), (2080, [1.0, 2.0]), (2100, []), (2120, [5.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, id string, score int").repartition(7)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df).collect())
    assert got == _brute(rows, 20, 20)
    assert topk.top_k(df.where("false")).count() == 0


def _fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(ids, prints):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = [find(i) for i in range(len(ids))]
    smallest = {g: min((i for i, h in zip(ids, groups) if h == g and i is not None), default=None) for g in groups}
    return [smallest[g] for g in groups]


def test_components_equal_brute_force(spark, sf_dir, odd_docs, no_docs):
    for docs in (table(spark, sf_dir, "documents"), odd_docs):
        rows = docs.select("doc_id", "text").collect()
        prints = [_fingerprint(r.text) for r in rows]
        want = sorted((str(r.doc_id), f"{p:016x}", str(c)) for r, p, c in zip(rows, prints, _components([r.doc_id for r in rows], prints)))
        got = simhash.near_duplicates(docs).collect()
        assert sorted((str(r.id), bytes(r.fp).hex(), str(r.component)) for r in got) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_chains_and_dense_groups_lose_no_link(spark, monkeypatch):
    """Fingerprints a few bits apart, in shards larger than a chunk."""
    monkeypatch.setattr(simhash, "CHUNK", 40)
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 2**63, 6)]
    prints = list({b ^ sum(1 << int(i) for i in rng.choice(64, rng.integers(0, 9), replace=False)) for b in base for _ in range(60)})
    df = spark.createDataFrame([(i, p.to_bytes(8, "big")) for i, p in enumerate(prints)], "id long, fp binary")
    got = {bytes(r.fp): r.component for r in simhash.near_groups(df, simhash.EXACT_64).collect()}
    assert [got[p.to_bytes(8, "big")] for p in prints] == _components(list(range(len(prints))), prints)


def test_pigeonhole_sets_share_one_for_every_close_pair():
    rng = np.random.default_rng(6)
    for rows in (1000, 1 << 24, 1 << 40):
        masks = simhash.key_masks(simhash.EXACT_64, rows)
        for _ in range(200):
            a = np.uint64(rng.integers(0, 2**63))
            b = a ^ np.uint64(sum(1 << int(i) for i in rng.choice(64, 3, replace=False)))
            assert any((a & m[0]) == (b & m[0]) for m in masks)


def test_tree_finds_what_a_scan_finds():
    words = np.random.default_rng(7).integers(0, 2**63, (500, 1)).astype(np.uint64) & np.uint64(0xFFFFF)
    found = {(q, e) for part in BKTree(words).within(words[:50], 4) for q, e in zip(*map(list, part))}
    want = {(q, e) for q in range(50) for e in range(500) if int(words[q, 0] ^ words[e, 0]).bit_count() <= 4}
    assert {(int(a), int(b)) for a, b in found} == want


def test_one_row_of_each_near_group_stays(spark, sf_dir, odd_docs, no_docs):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "text").collect()
    want = sorted(set(_components([r.doc_id for r in rows], [_fingerprint(r.text) for r in rows])))
    assert sorted(r.doc_id for r in simhash.one_per_group(docs).collect()) == want and len(want) < len(rows)
    odd = simhash.one_per_group(odd_docs)
    assert odd.columns == odd_docs.columns and 0 < odd.count() < odd_docs.count()
    assert simhash.one_per_group(no_docs).count() == 0


def test_groups_that_share_their_smallest_id_keep_a_row_each(spark):
    rng = np.random.default_rng(9)
    a, b, c = (" ".join(f"w{x}" for x in rng.integers(0, 5000, 100)) for _ in range(3))
    rows = [(5, a), (9, a), (5, b), (None, c), (None, c)]
    kept = simhash.one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("5", a), ("5", b), ("None", c)])


def test_batches_of_even_and_odd_size(spark):
    """Every fingerprint keeps its shard keys, whatever the number of rows in an Arrow batch."""
    for rows in (7, 8):
        df = spark.createDataFrame([(i, f"text number {i}") for i in range(rows)], "doc_id long, text string").coalesce(1)
        assert simhash.near_duplicates(df).count() == rows


def test_a_hot_group_is_joined_by_broadcast(spark, monkeypatch):
    from pyspark.sql import functions as F

    from parcelflow.llm.common import join_spread

    many = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    one = many.select("k").distinct().withColumn("w", F.col("k") * 2)
    got = join_spread(many, one, "k")
    assert got.count() == 60_000 and got.where("w != 2 * k").count() == 0


def test_of_equal_ids_and_texts_reruns_keep_the_same_row(spark):
    rows = [(1, "some text of five words", f"src{i}") for i in range(40)]
    kept = {simhash.one_per_group(spark.createDataFrame(r, "doc_id long, text string, source string").repartition(n)).first().source for r in (rows, rows[::-1]) for n in (1, 5)}
    assert len(kept) == 1


def test_top_k_asks_the_smallest_valid_vector_of_a_repeated_id(spark):
    rng = np.random.default_rng(13)
    rows = [(i, rng.integers(-9, 10, 3).astype(float).tolist()) for i in range(100)]
    odd = [(20 * i, v) for i in range(5) for v in (None, [float("nan")] * 3, [1.0, None, 1.0], [50.0, 0.0, 0.0])]
    schema = "vec_id long, embedding array<double>"
    valid = sorted((i, v) for i, v in [*rows, *odd] if v is not None and all(x is not None and np.isfinite(x) for x in v))
    for every in (odd + rows, rows + odd):
        got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(every, schema).coalesce(1)).collect())
        assert got == _brute(valid, 20, 20)
