"""Shards of near equal bytes: a k-d tree over metadata, split at weighted medians.

All open cells of a level are split in the same jobs. The median of a cell is found by
histograms over the widest dimension, each narrowed to the bucket in which the median lies, then
over a hash of the row where rows share the value. Rows stay where they are: what reaches the
driver is one line per cell, and a cell is an expression over a row's metadata.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from parcelflow.llm.common import positions, staged, utf8_crc32

LAW = "bytes"
BUCKETS = 1024
#: A cut may miss the median by this share of a shard's bytes.
TOLERANCE = 0.001
#: Cells are held as literals in expressions; this bounds them.
MAX_SHARDS = 4096
DIMENSIONS = ("n_chars", "source", "lang")


@dataclass
class Cell:
    """A node of shards first to first + leaves - 1; rows with (value of dim, tie) up to its cut go left."""

    leaves: int
    first: int
    dim: int = 0
    value: float = 0.0
    tie: float = 0.0
    halves: tuple[Cell, Cell] | None = None

    def split(self) -> tuple[Cell, Cell]:
        few = self.leaves // 2
        self.halves = (Cell(few, self.first), Cell(self.leaves - few, self.first + few))
        return self.halves


@dataclass
class KdTree:
    """dims and whether they are numbers; ranges: smallest value and width of each dimension."""

    dims: list[str]
    numeric: list[bool]
    ranges: list[tuple[float, float]]
    root: Cell

    def axes(self) -> list[Column]:
        """Each dimension scaled to 0 to 1; nulls lie at 0."""
        return [
            _scaled(_axis(d, n), r) for d, n, r in zip(self.dims, self.numeric, self.ranges, strict=True)
        ] or [F.lit(0.0)]

    def shard(self, id_col: str, text_col: str) -> Column:
        """A row's shard, from its metadata alone; the hash is looked at on a cut only."""
        axes, tie = self.axes(), _tie(id_col, text_col)

        def below(cell: Cell) -> Column:
            if cell.halves is None:
                return F.lit(cell.first)
            value, (left, right) = axes[cell.dim], cell.halves
            goes_left = (value < cell.value) | ((value == cell.value) & (tie <= cell.tie))
            return F.when(goes_left, below(left)).otherwise(below(right))

        return below(self.root).cast("int")


def _scaled(axis: Column, span: tuple[float, float]) -> Column:
    return F.coalesce((axis - F.lit(span[0])) / F.lit(span[1] or 1.0), F.lit(0.0))


def _of(values: list) -> Column:
    """The value of a row's cell."""
    return F.get(F.lit(values), F.col("cell"))


def _axis(name: str, numeric: bool) -> Column:
    """A number as it is; anything else by its first six bytes, in code point order."""
    if numeric:
        value = F.col(f"`{name}`").cast("double")
        return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)
    start = F.rpad(F.hex(F.substring(F.encode(F.col(f"`{name}`").cast("string"), "UTF-8"), 1, 6)), 12, "0")
    return F.conv(start, 16, 10).cast("double")


def _tie(id_col: str, text_col: str) -> Column:
    """0 to 1, random but fixed for a row."""
    h = F.xxhash64(F.col(f"`{id_col}`").cast("string"), utf8_crc32(F.col(f"`{text_col}`")))
    return (h.cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)


def bytes_of(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def build_tree(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
    dims: tuple[str, ...] = DIMENSIONS, id_col: str = "doc_id", text_col: str = "text",
) -> KdTree:
    """A tree whose leaves hold near equal bytes: so many shards, or as many as the target asks for.

    Dimensions that docs lacks are left out. With none left, or where all rows of a cell are
    alike, the row's hash decides. Null metadata lie at the low end. An empty table gives a tree
    whose cuts are arbitrary.
    """
    types = {f.name: f.dataType for f in docs.schema}
    used = [d for d in dims if d in types]
    numeric = [isinstance(types[d], NumericType) for d in used]
    size = bytes_of(F.col(f"`{text_col}`"))
    slim = staged(
        docs.select(
            size.alias("size"), _tie(id_col, text_col).alias("tie"),
            *[_axis(d, n).alias(f"d{i}") for i, (d, n) in enumerate(zip(used, numeric, strict=True))],
        ),
        "kd-slim",
    )
    whole = slim.agg(
        F.sum("size").alias("size"),
        *[f(f"d{i}").alias(f"{f.__name__}{i}") for i in range(len(used)) for f in (F.min, F.max)],
    ).first()
    if shards is None:
        shards = max(1, -(-(whole["size"] or 0) // max(1, target_bytes or 1)))
    if not 1 <= shards <= MAX_SHARDS:
        raise ValueError(f"{shards} shards; 1 to {MAX_SHARDS} can be made")
    ranges = []
    for i in range(len(used)):
        low, high = whole[f"min{i}"], whole[f"max{i}"]
        ranges.append((0.0, 0.0) if low is None else (low, high - low))
    tree = KdTree(used, numeric, ranges, Cell(shards, 0))
    axes = [_scaled(F.col(f"d{i}"), r) for i, r in enumerate(ranges)] or [F.lit(0.0)]
    rows = slim.select("size", "tie", F.array(*axes).alias("axes"), F.lit(0).alias("cell"))
    tolerated = TOLERANCE * (whole["size"] or 0) / shards
    cells = [tree.root] if shards > 1 else []
    while cells:
        _cut(rows, cells, len(axes), tolerated)
        halves = [half for cell in cells for half in cell.split()]
        open_halves = [half for half in halves if half.leaves > 1]
        number = {id(half): i for i, half in enumerate(open_halves)}
        sides = [[number.get(id(half), -1) for half in halves[side::2]] for side in (0, 1)]
        value = F.get(F.col("axes"), _of([c.dim for c in cells]))
        cut = _of([c.value for c in cells])
        left = (value < cut) | ((value == cut) & (F.col("tie") <= _of([c.tie for c in cells])))
        if open_halves:
            moved = rows.withColumn("cell", F.when(left, _of(sides[0])).otherwise(_of(sides[1])))
            rows = staged(moved.where("cell >= 0"), "kd-level")
        cells = open_halves
    return tree


def _cut(rows: DataFrame, cells: list[Cell], dims: int, tolerated: float) -> None:
    """Find the cut of every cell of a level along its widest dimension."""
    spans = rows.groupBy("cell").agg(
        F.sum("size").alias("size"),
        *[f(F.col("axes")[i]).alias(f"{f.__name__}{i}") for i in range(dims) for f in (F.min, F.max)],
    ).collect()
    brackets: dict[int, dict] = {}
    for r in spans:
        cell = cells[r["cell"]]
        widths = [r[f"max{i}"] - r[f"min{i}"] for i in range(dims)]
        cell.dim = widths.index(max(widths))
        low, high = r[f"min{cell.dim}"], r[f"max{cell.dim}"]
        goal = r["size"] * (cell.leaves // 2) / cell.leaves
        bracket = {"low": low, "high": high, "below": 0, "goal": goal, "tied": None}
        brackets[r["cell"]] = bracket | ({"tied": low, "low": 0.0, "high": 1.0} if low == high else {})
    while brackets:
        for number, found in _narrowed(rows, cells, brackets).items():
            bracket, cell = brackets[number], cells[number]
            # The nearer end of the bucket that holds the median.
            short, over = bracket["goal"] - found["before"], found["before"] + found["size"] - bracket["goal"]
            keep = over <= short
            end = found["high"] if keep else found["low"]
            if bracket["tied"] is None:
                cell.value, cell.tie = end, 1.0 if keep else -1.0
            else:
                cell.value, cell.tie = bracket["tied"], end if keep else end - 2.0**-53
            single = found["low"] == found["high"]
            if min(over, short) <= tolerated or (single and bracket["tied"] is not None):
                del brackets[number]
            elif single:
                bracket |= {"tied": found["low"], "low": 0.0, "high": 1.0, "below": found["before"]}
            else:
                bracket |= {"low": found["low"], "high": found["high"], "below": found["before"]}


def _narrowed(rows: DataFrame, cells: list[Cell], brackets: dict[int, dict]) -> dict[int, dict]:
    """Per cell the bucket of its bracket in which the bytes reach the goal; one line each."""
    asked = [brackets.get(i, {"low": 0.0, "high": 0.0, "below": 0, "goal": 0.0, "tied": None}) for i in range(len(cells))]
    of = lambda k: _of([a[k] for a in asked])
    value = F.get(F.col("axes"), _of([c.dim for c in cells]))
    by_tie = _of([a["tied"] is not None for a in asked])
    tied = _of([float(a["tied"] or 0.0) for a in asked])
    x = F.when(~by_tie, value).when(value == tied, F.col("tie"))
    share = (F.col("x") - F.col("low")) / (F.col("high") - F.col("low"))
    slot = F.least(F.lit(BUCKETS - 1), F.floor(share * BUCKETS))
    histogram = (
        rows.where(_of([i in brackets for i in range(len(cells))]))
        .select("cell", "size", x.alias("x"), of("low").alias("low"), of("high").alias("high"))
        .where("x >= low AND x <= high")
        .select("cell", "size", "x", F.when(F.col("high") > F.col("low"), slot).otherwise(0).alias("slot"))
        .groupBy("cell", "slot")
        .agg(F.sum("size").alias("size"), F.min("x").alias("low"), F.max("x").alias("high"))
    )
    run = Window.partitionBy("cell").orderBy("slot")
    reached = (
        histogram.withColumn("upto", F.sum("size").over(run) + of("below"))
        .where(F.col("upto") >= of("goal") - 1e-6)
        .groupBy("cell")
        .agg(F.min_by(F.struct("size", "low", "high", (F.col("upto") - F.col("size")).alias("before")), "slot").alias("b"))
    )
    return {r["cell"]: r["b"].asDict() for r in reached.collect()}


def sharded(docs: DataFrame, tree: KdTree, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the columns law and shard; no row moves.

    Where docs has such a column already (in any case of letters), the new one gets a `_` behind its name, and the old
    one stays as it is. Nulls in any column, empty texts and repeated rows have a shard like all others. An empty table gives none.
    """
    taken = {c.lower() for c in docs.columns}

    def free(name: str) -> str:
        return name if name not in taken else free(name + "_")

    return docs.withColumns({free("law"): F.lit(LAW), free("shard"): tree.shard(id_col, text_col)})


def shard_rows(docs: DataFrame, shards: int, **options) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    slot numbers a shard's rows by id, crc and size from 0, nulls first; grown_shard is null, as
    this law does not place by key. Null texts have size 1 and the crc of the empty text.
    Repeated rows stay, each with a slot of its own. An empty table gives none.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    tree = build_tree(docs, shards, **options)
    text = F.col(f"`{text_col}`")
    slim = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), bytes_of(text).alias("size"), utf8_crc32(text).alias("text_crc32"),
        tree.shard(id_col, text_col).alias("shard"),
    )
    return positions(slim, ["shard"], ["doc_id", "text_crc32", "size"], label="kd-slots").select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        F.col("position").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
