"""Merkle manifest against a plain recursion, its layout against its definition."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from oracle_compare import compare, connect

from parcelflow.llm import merkle
from parcelflow.llm.common import table


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _up(nodes):
    """Root, and per leaf its siblings as (side, digest)."""
    ways = [[] for _ in nodes]
    spans = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        after, merged = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i : i + 2]
            for own, side, other in ((0, "R", 1), (1, "L", 0)):
                if own < len(run):
                    for leaf in spans[i + own]:
                        ways[leaf].append((side, run[other]) if other < len(run) else ("-", ""))
            after.append(_h(*run))
            merged.append([x for s in spans[i : i + 2] for x in s])
        nodes, spans = after, merged
    return nodes[0], ways


def _brute(rows):
    if not rows:
        return []
    leaf = lambda r, more=0: _h(*map(_field, (r.doc_id, r.source, r.lang, r.n_chars if r.n_chars is None else r.n_chars + more, r.text)))
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r), r))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {k: _up([x[2] for x in sorted(groups[k], key=lambda x: x[:3])]) for k in keys}
    root, tops = _up([trees[k][0] for k in keys])
    out = []
    for k, top in zip(keys, tops, strict=True):
        for (_, _, own, r), way in zip(sorted(groups[k], key=lambda x: x[:3]), trees[k][1], strict=True):
            held = leaf(r, 1) if zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 7 == 0 else own
            for side, other in way + top:
                held = _h(other, held) if side == "L" else _h(held, other)
            out.append((str(r.doc_id), own, trees[k][0], root, _h(*[o for _, o in way + top]), held, held == root))
    return sorted(out)


def _got(df):
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((str(r.doc_id), *[r[c] for c in names]) for r in df.collect())


@pytest.mark.parametrize("band", [12, 2, 3])
def test_proofs_equal_a_plain_recursion(spark, sf_dir, odd_docs, no_docs, band):
    docs = table(spark, sf_dir, "documents")
    assert _got(merkle.proofs(docs, band)) == _brute(docs.collect())
    assert _got(merkle.proofs(odd_docs, band)) == _brute(odd_docs.collect())
    assert merkle.proofs(no_docs).count() == 0


def test_one_group_one_row_and_many_repeats(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    for rows in ([(7, "a", None, None, "x")], [(3, None, "en", 1, "same")] * 37, [(i, "a", "en", i, "t") for i in range(33)]):
        docs = spark.createDataFrame(rows, schema)
        assert _got(merkle.proofs(docs)) == _brute(docs.collect())


def test_tampering_is_found_and_only_there(spark, sf_dir):
    rows = merkle.proofs(table(spark, sf_dir, "documents")).collect()
    assert {r.doc_id for r in rows if not r.verified} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 7 == 0}


def test_equals_sql(spark, sf_dir):
    run = lambda s, d: merkle.proofs(table(s, d, "documents"))
    assert compare(spark, connect(sf_dir), "merkle", run, merkle.ORACLE_SQL, sf_dir) == []


def _veb(levels, root=(0, 0)):
    """Nodes (depth, index) of a full subtree in van Emde Boas order, by its recursive definition."""
    if levels == 1:
        return [root]
    upper = levels // 2
    out = _veb(upper, root)
    depth, index = root
    for i in range(1 << upper):
        out += _veb(levels - upper, (depth + upper, (index << upper) + i))
    return out


@pytest.mark.parametrize("levels", range(1, 10))
def test_addresses_are_the_van_emde_boas_order(levels):
    order = {node: place for place, node in enumerate(_veb(levels))}
    for depth in range(levels):
        index = np.arange(1 << depth)
        assert merkle.addresses(levels, depth, index).tolist() == [order[depth, i] for i in index.tolist()]
