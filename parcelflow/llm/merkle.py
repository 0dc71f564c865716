"""Merkle manifest of a dataset: a hash tree per group of rows and one over the groups, in van Emde Boas layout.

A tree is cut into bands of BAND levels; a block is an aligned subtree of up to 2 ** BAND nodes
of a band's lowest level, built by one task and stored as one row. Inside a block, digests stand
in van Emde Boas order: the subtree is split at half its height, the upper half comes first, then
the lower halves one by one, each split the same way. Address arithmetic says where a node of a
level stands, both when a block is built and when siblings are looked up, with no parameter for
the size of a cache line or page. The roots of a band's blocks are the nodes of the next band;
there is one band per BAND doublings of the rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import positions, staged, utf8_crc32

#: Levels of a block: 4,096 leaves, 8,191 digests.
BAND = 12
DIGEST = 32
#: The columns that make up a document's leaf, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of groups stands beside those of the groups; their keys are "" or begin with "=".
TOP = "#"

NODES = "tree string, at long, hash string, nodes long"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places, in van Emde Boas order, of the nodes `index` at `depth` of a full tree of `levels` levels."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    upper = levels // 2
    if depth < upper:
        return addresses(upper, depth, index)
    lower, below = levels - upper, depth - upper
    which = index >> below
    inside = index & ((1 << below) - 1)
    return (1 << upper) - 1 + which * ((1 << lower) - 1) + addresses(lower, below, inside)


def height_of(nodes: int, band: int = BAND) -> int:
    """Levels of a block above its lowest one: up to one node, or a whole band if the tree goes on."""
    return band if nodes > 1 << band else int(nodes - 1).bit_length()


def build_block(leaves: np.ndarray, height: int) -> np.ndarray:
    """Digests of a block in van Emde Boas order; places without a node stay zero. A lone node is hashed alone."""
    store = np.zeros(((2 << height) - 1, DIGEST), np.uint8)
    level = leaves
    store[addresses(height + 1, height, np.arange(len(level)))] = level
    for depth in range(height - 1, -1, -1):
        hexed = [bytes(x).hex() for x in level]
        pairs = ["".join(hexed[i : i + 2]) for i in range(0, len(hexed), 2)]
        level = np.frombuffer(b"".join(hashlib.sha256(p.encode()).digest() for p in pairs), np.uint8).reshape(-1, DIGEST)
        store[addresses(height + 1, depth, np.arange(len(level)))] = level
    return store


def siblings(store: np.ndarray, height: int, filled: int, index: np.ndarray) -> list[list[str]]:
    """Steps from each leaf of a block to its root: L or R, where the sibling stands, and its digest; `-` without one."""
    steps = []
    for level in range(height):
        own = index >> level
        other = own ^ 1
        there = other < -(-filled >> level)
        found = store[addresses(height + 1, height - level, np.where(there, other, own))]
        hexed = found.tobytes().hex()
        width = 2 * DIGEST
        steps.append([
            ("R" if o > w else "L") + hexed[k * width : (k + 1) * width] if t else "-"
            for k, (w, o, t) in enumerate(zip(own.tolist(), other.tolist(), there.tolist(), strict=True))
        ])
    return [list(x) for x in zip(*steps, strict=True)] if steps else [[] for _ in index]


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value; numbers in decimal."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: list[Column]) -> Column:
    return F.sha2(F.encode(F.concat(*[field(v) for v in values]), "UTF-8"), 256)


def build(nodes: DataFrame, band: int = BAND) -> tuple[list[DataFrame], DataFrame]:
    """(bands, roots) of nodes (tree, at, hash, nodes): at counts from 0, nodes is the tree's number of them.

    A band has a row (tree, block, nodes, height, filled, store, root) per block; bands are written
    tables, lowest first. roots: (tree, root). The driver takes one number per band.
    """

    def block(group: pa.Table) -> pa.Table:
        group = group.sort_by("at")
        total, at = group.column("nodes")[0].as_py(), group.column("at").to_numpy()
        leaves = np.frombuffer(bytes.fromhex("".join(group.column("hash").to_pylist())), np.uint8).reshape(-1, DIGEST)
        height = height_of(total, band)
        store = build_block(leaves, height)
        return pa.table({
            "tree": group.column("tree").slice(0, 1), "block": pa.array([at[0] >> band], pa.int64()),
            "nodes": pa.array([total], pa.int64()), "height": pa.array([height], pa.int32()),
            "filled": pa.array([len(leaves)], pa.int32()), "store": pa.array([store.tobytes()], pa.binary()),
            "root": pa.array([bytes(store[0]).hex()]),
        })

    schema = "tree string, block long, nodes long, height int, filled int, store binary, root string"
    bands: list[DataFrame] = []
    while True:
        keyed = nodes.withColumn("block", F.shiftright("at", band))
        bands.append(staged(keyed.groupBy("tree", "block").applyInArrow(block, schema), "merkle-band"))
        above = bands[-1].where(F.col("nodes") > 1 << band)
        if above.isEmpty():
            break
        # Roots of blocks are the nodes of the next band.
        nodes = above.select("tree", F.col("block").alias("at"), F.col("root").alias("hash"), F.ceil(F.col("nodes") / (1 << band)).alias("nodes"))
    roots = [b.where(F.col("nodes") <= 1 << band).select("tree", "root") for b in bands]
    whole = roots[0]
    for more in roots[1:]:
        whole = whole.unionByName(more)
    return bands, whole


def prove(nodes: DataFrame, bands: list[DataFrame], above: DataFrame, band: int = BAND) -> DataFrame:
    """nodes with `steps`, the siblings from each up to its tree's root and then the steps `above` (tree, steps).

    Goes from the highest band down: the steps of a block's root come behind those inside the block.
    """

    def inside(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = left.slice(0, 0).append_column("steps", pa.array([], pa.list_(pa.string())))
        if not left.num_rows or not right.num_rows:
            return empty.drop_columns(["block"])
        row = right.slice(0, 1).to_pylist()[0]
        store = np.frombuffer(row["store"], np.uint8).reshape(-1, DIGEST)
        index = left.column("at").to_numpy() - (row["block"] << band)
        steps = [own + row["steps"] for own in siblings(store, row["height"], row["filled"], index)]
        return left.append_column("steps", pa.array(steps, pa.list_(pa.string()))).drop_columns(["block"])

    found = None
    for number in range(len(bands) - 1, -1, -1):
        stored = bands[number]
        # A tree ends in this band, or goes on in the one above, where this block's root is a node.
        ends = stored.where(F.col("nodes") <= 1 << band).join(above, "tree")
        blocks = ends
        if found is not None:
            goes_on = found.select("tree", F.col("at").alias("block"), "steps")
            blocks = ends.unionByName(stored.where(F.col("nodes") > 1 << band).join(goes_on, ["tree", "block"]))
        if number:
            members = bands[number - 1].where(F.col("nodes") > 1 << band).select("tree", F.col("block").alias("at"))
        else:
            members = nodes
        keyed = members.withColumn("block", F.shiftright("at", band))
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in members.schema) + ", steps array<string>"
        found = keyed.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(inside, schema)
        found = staged(found, "merkle-steps") if number else found
    return found


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""

    def step(held: Column, s: Column) -> Column:
        other = F.substring(s, 2, 2 * DIGEST)
        both = F.when(s.startswith("L"), F.concat(other, held)).when(s.startswith("R"), F.concat(held, other)).otherwise(held)
        return F.sha2(both, 256)

    return F.aggregate(steps, leaf, step)


def manifest(docs: DataFrame, group_col: str = "lang", order_col: str = "doc_id", columns=LEAF_COLUMNS, band: int = BAND) -> tuple:
    """(leaves, bands of the groups' trees, subroots, bands of the top tree, root) of a table.

    leaves: (order_col, tree, at, hash, tampered, nodes) per row; tampered is the leaf with 1 more
    n_chars where 7 divides the crc32 of the decimal id, else the leaf. tree: "" for a null group,
    else "=" and its value, so trees sort like groups, null first, by UTF-8 bytes. Leaves ascend by
    id, null ids first; repeated ids by leaf. Repeated rows are leaves each. Empty tables have no root.
    """
    def values(changed: Column | None = None) -> list[Column]:
        return [changed if c == "n_chars" and changed is not None else F.col(f"`{c}`") for c in columns]

    more = F.when(utf8_crc32(F.col(f"`{order_col}`").cast("string")) % 7 == 0, F.lit(1)).otherwise(F.lit(0))
    group = F.col(f"`{group_col}`").cast("string")
    slim = docs.select(
        F.col(f"`{order_col}`").alias("id"), F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("tree"),
        leaf_hash(values()).alias("hash"),
        F.when(more == 1, leaf_hash(values(F.col("n_chars").cast("long") + 1))).alias("changed"),
        # Repeated rows may be many; this tells them apart for the sort, any order of them is the same.
        F.monotonically_increasing_id().alias("copy"),
    )
    slim = staged(slim, "merkle-leaves")
    ranked = positions(slim, ["tree"], ["id", "hash", "copy"], label="merkle-positions").drop("copy")
    sizes = slim.groupBy("tree").agg(F.count(F.lit(1)).alias("nodes"))
    leaves = ranked.withColumnRenamed("position", "at").join(sizes, "tree")
    leaves = staged(leaves.select("id", "tree", "at", "hash", F.coalesce("changed", "hash").alias("tampered"), "nodes"), "merkle-nodes")
    bands, subroots = build(leaves.select("tree", "at", "hash", "nodes"), band)
    subroots = staged(subroots, "merkle-subroots")
    groups = subroots.count()
    top = positions(subroots.withColumnRenamed("tree", "key"), [], ["key"], label="merkle-groups").select(
        F.lit(TOP).alias("tree"), F.col("position").alias("at"), F.col("root").alias("hash"), F.lit(groups).cast("long").alias("nodes"), "key"
    )
    top = staged(top, "merkle-top")
    top_bands, root = build(top.drop("key"), band)
    return leaves, bands, top, top_bands, root


def proofs(docs: DataFrame, band: int = BAND, **options) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row of docs.

    proof_sha256 is the hash of the siblings' digests from the leaf up to the root; folded_root is
    what the (every seventh id: tampered) leaf and these siblings give. Nulls in any column have a
    mark of their own, empty texts have the length 0; a null n_chars stays null when tampered with.
    Rows that repeat have a row each. An empty table gives none. Other columns are not read.
    """
    leaves, bands, top, top_bands, root = manifest(docs, band=band, **options)
    none = root.select("tree").distinct().withColumn("steps", F.array().cast("array<string>"))
    ways = prove(top, top_bands, none, band).select(F.col("key").alias("tree"), F.col("hash").alias("subroot"), "steps")
    ways = staged(ways, "merkle-ways")
    proved = prove(leaves, bands, ways.select("tree", "steps"), band)
    whole = proved.join(ways.select("tree", "subroot"), "tree").crossJoin(F.broadcast(root.select("root")))
    others = F.filter("steps", lambda s: s != "-")
    joined = F.concat_ws("", F.transform(others, lambda s: F.substring(s, 2, 2 * DIGEST)))
    return whole.select(
        F.col("id").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root",
        F.sha2(joined, 256).alias("proof_sha256"), fold(F.col("tampered"), F.col("steps")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


#: Levels are lists of digests, halved until one is left; crc32 is worked out bit by bit.
ORACLE_SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS size,
    coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1)::VARCHAR, '-') AS more,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    xor(list_reduce(list_prepend(4294967295::BIGINT, [ord(c)::BIGINT for c in string_split(coalesce(doc_id::VARCHAR, ''), '') if c <> '']),
      lambda held, c: list_reduce([xor(held, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS crc
  FROM documents
), leaves AS (
  SELECT doc_id, lang, sha256(head || size || tail) AS leaf,
    sha256(head || CASE WHEN crc % 7 = 0 THEN more ELSE size END || tail) AS tampered
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
), levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, [sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')) for i in range(0, len(nodes), 2)]
  FROM levels WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
  FROM levels WHERE len(nodes) = 1
), tops AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, [sha256(nodes[i + 1] || coalesce(nodes[i + 2], '')) for i in range(0, len(nodes), 2)]
  FROM tops WHERE len(nodes) > 1
), whole AS (
  SELECT p.*, s.subroot, s.place, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root
  FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang
), steps AS (
  SELECT doc_id, leaf, pos, w.lang, level, (pos >> level) & 1 AS odd, nodes[xor(pos >> level, 1) + 1] AS other
  FROM whole w JOIN levels l ON w.lang IS NOT DISTINCT FROM l.lang AND len(l.nodes) > 1
  UNION ALL
  SELECT doc_id, leaf, pos, w.lang, 1000 + level, (place >> level) & 1, nodes[xor(place >> level, 1) + 1]
  FROM whole w JOIN tops t ON len(t.nodes) > 1
), ways AS (
  SELECT lang, pos, list({'odd': odd, 'other': other} ORDER BY level) AS way,
    coalesce(string_agg(other, '' ORDER BY level), '') AS joined
  FROM steps GROUP BY lang, pos
), folds AS (
  SELECT w.lang, w.pos, w.tampered AS held, 0 AS done, coalesce(y.way, []) AS way
  FROM whole w LEFT JOIN ways y ON w.lang IS NOT DISTINCT FROM y.lang AND w.pos = y.pos
  UNION ALL
  SELECT lang, pos,
    sha256(CASE WHEN way[done + 1].other IS NULL THEN held WHEN way[done + 1].odd = 1 THEN way[done + 1].other || held
           ELSE held || way[done + 1].other END), done + 1, way
  FROM folds WHERE done < len(way)
)
SELECT w.doc_id, w.leaf, w.subroot, w.root, sha256(coalesce(y.joined, '')) AS proof_sha256, f.held AS folded_root, f.held = w.root AS verified
FROM whole w
LEFT JOIN ways y ON w.lang IS NOT DISTINCT FROM y.lang AND w.pos = y.pos
JOIN folds f ON w.lang IS NOT DISTINCT FROM f.lang AND w.pos = f.pos AND f.done = len(f.way)
"""
