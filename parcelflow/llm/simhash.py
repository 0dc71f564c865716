"""SimHash fingerprints and near-duplicate groups by BK-trees over shards of fingerprints.

A shard holds the fingerprints that agree on a set of bits. The sets
come from the pigeonhole principle (some of `blocks` blocks stay unchanged), so that no link is
lost; more and longer sets are taken as the number of fingerprints grows, to keep shards small.
Each shard gets a BK-tree in the task that holds it, and the shard's fingerprints search it.
Trees are not sent through the driver: together they grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.bktree import BKTree, distances, merge_labels
from parcelflow.llm.common import join_spread, log2_ceiling, staged, text_batches
from parcelflow.llm.graph import components

SEED = 42
#: Shards beyond this many fingerprints are cut into chunks; each pair of chunks is one search.
CHUNK = 2048
#: Shards up to this size are compared entry by entry.
LEAF = 16
#: Shingles whose bits are counted at once.
BLOCK = 4096


@dataclass(frozen=True)
class Settings:
    """shingle: words, repeats included. radius: most bits in which linked fingerprints of 64 bits differ."""

    shingle: int = 3
    radius: int = 3


#: The contract of the fingerprint query, and of the pipeline's stage.
EXACT_64 = Settings()
BITS = 64


def shingle_hashes(text: bytes | None, s: Settings) -> np.ndarray:
    """XXH64 of each shingle; of a text with fewer words than a shingle, of all its words.

    bytes.lower changes A-Z only and bytes.split cuts at 0x20 and 0x09-0x0D only.
    """
    words = (text or b"").lower().split()
    if len(words) <= s.shingle:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(s.shingle)), strict=False))
    return np.frombuffer(b"".join([xxhash.xxh64_digest(x, SEED) for x in shingles]), dtype=">u8")


def fingerprint(text: bytes | None, s: Settings = EXACT_64) -> bytes:
    """Majority bits of the shingles' XXH64; all zero for a text without words."""
    h = shingle_hashes(text, s)
    if not len(h):
        return bytes(BITS // 8)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), BLOCK):
        part = h[at : at + BLOCK]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(h)).tobytes()


def fingerprints(docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, row_hash, fp) per row. text_hash tells rows that share an id apart, row_hash those that differ elsewhere."""
    hashable = [f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString()]
    slim = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("text_hash"),
        F.xxhash64(*hashable).alias("row_hash"), F.col(f"`{text_col}`").alias("text"),
    )
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            fps = pa.array([fingerprint(t, s) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], fps], ["id", "text_hash", "row_hash", "fp"])

    return slim.mapInArrow(run, f"id {id_type}, text_hash long, row_hash long, fp binary")


def key_masks(s: Settings, rows: int) -> list[np.ndarray]:
    """Sets of bits, as 64-bit words; fingerprints that agree on one set share a shard."""
    bits = np.arange(BITS)
    for blocks in range(s.radius + 1, s.radius + 4):
        if BITS * (blocks - s.radius) // blocks >= log2_ceiling(rows) - 2:
            break
    block = bits * blocks // BITS
    kept = [np.isin(block, c) for c in combinations(range(blocks), blocks - s.radius)]
    return [np.packbits(k).view(">u8").astype(np.uint64) for k in kept]


def _as_words(values: list[bytes]) -> np.ndarray:
    """Rows of 64-bit words."""
    joined = np.frombuffer(b"".join(values), dtype=">u8").astype(np.uint64)
    return joined.reshape(len(values), -1) if values else joined.reshape(0, 1)


def _keyed(fps: DataFrame, masks: list[np.ndarray]) -> DataFrame:
    """A row (shard, fp) per fingerprint and set of bits; shards hash the set's number and bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp")
            if not len(values):
                continue
            words = _as_words(values.to_pylist())
            for number, mask in enumerate(masks):
                h = np.full(len(words), number + 1, dtype=np.uint64)
                for column in (words & mask).T:
                    h = (h ^ column) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), values], ["shard", "fp"])

    return fps.mapInArrow(run, "shard long, fp binary")


def _chunked(keyed: DataFrame) -> DataFrame:
    """(shard, one, two, side, fp): large shards as pairs of chunks, others as one chunk.

    A search of chunk `one` (side 0) by chunk `two` (side 1), or by itself where they are equal.
    """
    large = (
        keyed.groupBy("shard").count().where(F.col("count") > CHUNK)
        .select("shard", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    )
    cut = keyed.join(large, "shard", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    cut = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return cut.select(
        "shard", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp",
    )


def _links(keyed: DataFrame, radius: int) -> DataFrame:
    """(a, b): every fingerprint of a search joined to one of its group there; no pairs of a group."""

    def joined(group: np.ndarray, side: np.ndarray, fps: list[bytes]) -> pa.RecordBatch | None:
        words, n = _as_words(fps), len(fps)
        label = np.arange(n)
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        sizes = np.diff(np.r_[starts, n])
        leaf = np.repeat((sizes > 1) & (sizes <= LEAF), sizes)
        for step in range(1, LEAF):
            i = np.flatnonzero(leaf[: n - step] & (group[: n - step] == group[step:]))
            if not len(i):
                break
            i = i[distances(words[i], words[i + step]) <= radius]
            merge_labels(label, i, i + step)
        for at, size in zip(starts[sizes > LEAF], sizes[sizes > LEAF], strict=True):
            inside = slice(at, at + size)
            second = at + np.flatnonzero(side[inside])
            first = at + np.flatnonzero(side[inside] == 0)
            tree = BKTree(words[first])
            asked = second if len(second) else first
            for q, e in tree.within(words[asked], radius):
                merge_labels(label, asked[q], first[e])
        moved = np.flatnonzero(label != np.arange(n))
        if not len(moved):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array([fps[i] for i in moved], pa.binary()), pa.array([fps[i] for i in label[moved]], pa.binary())],
            ["a", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("shard", "one", "two")])
            new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if last is not None and (keys[0] != last).any():
                new = np.r_[0, new]
            last = keys[-1]
            if len(new):
                held.append(batch.slice(0, new[-1]))
                if out := close(held):
                    yield out
                held = [batch.slice(new[-1])]
            else:
                held.append(batch)
        if held and (out := close(held)):
            yield out

    def close(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        whole = pa.Table.from_batches(held)
        if whole.num_rows < 2:
            return None
        keys = np.column_stack([whole.column(c).to_numpy() for c in ("shard", "one", "two")])
        group = np.cumsum(np.r_[0, (keys[1:] != keys[:-1]).any(axis=1)])
        return joined(group, whole.column("side").to_numpy(), whole.column("fp").to_pylist())

    order = ["shard", "one", "two"]
    spread = _chunked(keyed).repartition(*order).sortWithinPartitions(*order, "side")
    return spread.mapInArrow(run, "a binary, b binary")


def near_groups(prints: DataFrame, s: Settings = EXACT_64) -> DataFrame:
    """(fp, root, component): per distinct fingerprint its group's root, and the smallest id that its links reach."""
    distinct = staged(prints.groupBy("fp").agg(F.min("id").alias("first")), "near-distinct")
    masks = key_masks(s, distinct.count())
    roots = components(_links(_keyed(distinct.select("fp"), masks), s.radius))
    rooted = staged(
        distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root")
        ),
        "near-roots",
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return join_spread(rooted.select("fp", "root"), smallest, "root").select("fp", "root", "component")


def near_duplicates(
    docs: DataFrame, s: Settings = EXACT_64, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text_hash, fp, component) per row: its fingerprint and the smallest id reachable by links.

    Null and blank texts have the zero fingerprint, which links like any other. Rows that repeat
    stay, each with the same component. A null id is never the smallest; a component of such rows
    only has a null component. An empty table gives none. Other columns are not read.
    """
    prints = staged(fingerprints(docs, s, id_col, text_col), "fingerprints")
    return join_spread(prints, near_groups(prints, s), "fp").select("id", "text_hash", "fp", "component")


def one_per_group(
    docs: DataFrame, s: Settings = EXACT_64, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The row of docs with the smallest id of each group, all columns.

    Of rows that share that id the one with the smallest hash of the text, then of the row, stays, so
    reruns agree; rows without an id stay only where no row of their group has one, then one of them.
    Null and blank texts are one group. An empty table gives none.
    """
    prints = staged(fingerprints(docs, s, id_col, text_col), "fingerprints")
    found = join_spread(prints, near_groups(prints, s).select("fp", "root"), "fp")
    first = F.min(F.struct(F.col("id").isNull().alias("odd"), "id", "text_hash", "row_hash")).alias("kept")
    kept = found.groupBy("root").agg(first).select(
        F.col("kept.id").alias("_kept_id"), F.col("kept.text_hash").alias("_kept_text"), F.col("kept.row_hash").alias("_kept_row")
    )
    hashable = [f"`{f.name}`" for f in docs.schema if "map<" not in f.dataType.simpleString()]
    hashed = docs.withColumn("_near_text", F.xxhash64(f"`{text_col}`")).withColumn("_near_row", F.xxhash64(*hashable))
    same = (
        hashed[f"`{id_col}`"].eqNullSafe(kept["_kept_id"]) & (hashed["_near_text"] == kept["_kept_text"])
        & (hashed["_near_row"] == kept["_kept_row"])
    )
    # What is left of one key are repeats of one row.
    once = hashed.join(kept, same, "left_semi").dropDuplicates([id_col, "_near_text", "_near_row"])
    return once.drop("_near_text", "_near_row")
