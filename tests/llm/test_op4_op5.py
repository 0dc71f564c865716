"""Repeated passages and benchmark leaks against brute force and planted cases."""

from __future__ import annotations

from collections import defaultdict

import numpy as np

from parcelflow.llm import decontaminate, suffixes
from parcelflow.llm.common import table


def _covered(rows, n=50):
    """Word positions inside windows of n words that another document holds."""
    holders = defaultdict(set)
    split = [(r.doc_id, (r.text or "").encode().split()) for r in rows if r.doc_id is not None]
    for i, words in split:
        for at in range(len(words) - n + 1):
            holders[tuple(words[at : at + n])].add(i)
    return {(i, at + k) for i, words in split for at in range(len(words) - n + 1) if len(holders[tuple(words[at : at + n])]) > 1 for k in range(n)}


def _spans(df):
    return {(r.doc_id, r.start_word + k) for r in df.collect() for k in range(r.n_words)}


def test_passages_equal_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    assert _spans(suffixes.repeated_passages(docs)) == _covered(docs.collect())


def test_overlapping_versions_of_a_passage(spark):
    """Partial copies with few distinct words, where a neighbour is not the best partner."""
    rng = np.random.default_rng(2)
    base = [f"b{x}" for x in rng.integers(0, 400, 400)]
    rows = []
    for i in range(60):
        a = int(rng.integers(0, 330))
        n = int(rng.integers(20, 110))
        rows.append((i, " ".join([f"u{i}_{k}" for k in range(20)] + base[a : a + n] + [f"v{i}_{k}" for k in range(20)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _spans(suffixes.repeated_passages(docs)) == _covered(docs.collect())


def test_more_suffixes_alike_than_a_task_holds(spark):
    """Pieces of one passage in more documents than GROUP, in contexts of their own."""
    rng = np.random.default_rng(5)
    base = [f"b{x}" for x in range(90)]
    rows = []
    for i in range(suffixes.GROUP + 1500):
        a, b = (int(rng.integers(0, 12)), int(rng.integers(70, 90))) if i % 3 else (0, 90)
        rows.append((i, " ".join([f"u{i}", *base[a:b], f"v{i}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _spans(suffixes.repeated_passages(docs)) == _covered(docs.collect())


def test_passages_of_odd_rows(odd_docs, no_docs):
    assert suffixes.repeated_passages(odd_docs).count() == 0
    assert suffixes.repeated_passages(no_docs).count() == 0


def test_verbatim_passages_are_all_found(spark, sf_dir):
    docs, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()}
    items = [(b.item_id, " ".join(b.text.split())) for b in bench.collect()]
    want = {(d.doc_id, i) for d in docs.collect() for i, t in items if t in " ".join(d.text.split())}
    assert want and want <= found
    clean = decontaminate.decontaminated(docs, bench)
    assert clean.columns == docs.columns
    assert not {r.doc_id for r in clean.collect()} & {d for d, _ in found}


def test_reworded_questions_need_consistent_slots(spark):
    item = "Yesterday morning Anna bought 12 apples and gave Tom 5 kg of flour before Anna walked 3 km back home"
    docs = [
        (1, "so they say that " + item + " in the end"),
        (2, item.replace("Anna", "Maria").replace("12", "40").replace("Tom", "Ben").replace("3 km", "7 miles")),
        (3, item.replace("Anna", "Maria", 1).replace("Tom", "Maria")),
        (4, "Yesterday morning somebody else bought bread and nothing at all happened on the way back to the house"),
        (None, item), (5, None), (6, ""),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(7, item, "x"), (8, item, "y"), (9, None, None), (None, "", "z")], "item_id long, text string, hash string")
    rows = {r.doc_id: (r.item_id, r.kind) for r in decontaminate.contaminated(frame, bench).collect()}
    assert rows == {1: (7, "exact"), 2: (7, "template"), None: (7, "exact")} or rows.keys() == {1, 2, 3, None} and rows[3][1] == "exact"
    assert {r.doc_id for r in decontaminate.decontaminated(frame, bench).collect()} >= {4, 5, 6}
    assert decontaminate.contaminated(frame.where("false"), bench).count() == 0
    assert decontaminate.contaminated(frame, bench.where("false")).count() == 0


def test_leaks_of_odd_rows(spark, odd_docs, sf_dir):
    bench = table(spark, sf_dir, "benchmark")
    assert decontaminate.contaminated(odd_docs, bench).count() == 0
    assert decontaminate.decontaminated(odd_docs, bench).count() == odd_docs.count()


def test_items_of_few_literals_and_other_case(spark):
    items = [
        (1, "What is 345 + 982 ?"), (2, "Hello world"),
        (3, "The History Of King Arthur And Queen Guinevere From The Early Middle Ages"),
        (4, "Every Monday morning Anna gives Tom exactly 4 of her own Apples"),
    ]
    docs = [
        (1, "so What is 345 + 982 ? they asked"), (2, "what is 346 + 982"), (3, "The world is large and the world is old"),
        (4, "we say hello world twice"), (5, items[2][1].lower()), (6, items[3][1].lower()), (7, "The Life Of Prince Albert And Queen Victoria From The Late Modern Times"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = sorted((r.doc_id, r.item_id, r.kind) for r in decontaminate.contaminated(frame, bench).collect())
    assert rows == [(1, 1, "exact"), (4, 2, "exact"), (5, 3, "exact"), (6, 4, "exact")]


def test_each_reparameterised_item_has_its_own_kind(spark):
    text = "a farmer sells {} apples to {} and then walks all the way back home with {} empty baskets"
    items = [(1, text.format(3, "Anna", 4)), (2, text.format(8, "Tom", 9)), (3, text.format(8, "Tom", 9)), (4, text.format(8, "Tom", 8))]
    docs = spark.createDataFrame([(1, "well " + items[1][1]), (2, text.format(5, "Ben", 6))], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = {(r.doc_id, r.item_id): r.kind for r in decontaminate.contaminated(docs, bench).collect()}
    assert {k: v for k, v in rows.items() if k[1] != 4} == {
        (1, 1): "template", (1, 2): "exact", (1, 3): "exact", (2, 1): "template", (2, 2): "template", (2, 3): "template",
    }


def test_clean_rows_that_share_an_id_with_a_leak_stay(spark):
    item = "the seven small ships sailed far across the cold northern sea before winter came"
    rows = [(None, item), (None, "a clean text"), (None, None), (5, "well " + item), (5, "another clean text"), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = decontaminate.decontaminated(docs, bench).collect()
    assert sorted(map(str, left)) == sorted(f"Row(doc_id={i}, text={t!r})" for i, t in rows if item not in (t or ""))
    assert {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()} == {None, 5}


def test_passage_repeated_many_times_in_two_documents(spark):
    """Runs of one document's equal suffixes longer than a batch and than GROUP."""
    rng = np.random.default_rng(12)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 10**6, 60))
    rows = [(i, " ".join([f"u{i}_{k}" for k in range(30)] + [passage] * (5100 + 300 * i) + [f"v{i}_{k}" for k in range(30)])) for i in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id, r.start_word, r.n_words) for r in suffixes.repeated_passages(docs).collect())
    assert found == [(0, 30, 5100 * 60), (1, 30, 5400 * 60)]
    rows = [(i, " ".join([f"u{i}"] + [passage] * n)) for i, n in ((0, 1900), (1, 1500), (2, 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _spans(suffixes.repeated_passages(docs)) == _covered(docs.collect())
