"""Repeated passages by a sparse suffix array.

Of all suffixes of a text's words those are kept that start at a minimiser: the leftmost smallest
hash of ANCHOR words among each window of them that a passage of `min_words` holds. Equal passages
keep equal suffixes, so every repeat of min_words or more has a kept suffix on both sides. Kept
suffixes whose first words occur in other documents are sorted by range partitions; each is
compared with its neighbours from other documents and the match is extended right and left.
Where a farther one may match better than both, hashes of whole windows decide, inside the task
that holds all suffixes with these first words, and across tasks where none does. Overlapping matches of a document are joined to whole passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import staged, text_batches
from parcelflow.llm.hashfilter import build_filter, may_hold

MIN_WORDS = 50
#: Words hashed at a minimiser; shared runs of fewer words are never looked at.
ANCHOR = 16
#: Distinct words a task remembers.
LEXICON = 300_000
#: Words looked at together; short texts are joined to such blocks, long ones are cut into them.
BLOCK = 1 << 17
#: Suffixes that begin alike and are held together in a task; of more, windows are compared across tasks.
GROUP = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """32-bit hashes of words, never 0."""

    def __missing__(self, word: bytes) -> int:
        self[word] = out = xxhash.xxh32_intdigest(word, 9) or 1
        return out

    def hashes(self, text: bytes | None) -> np.ndarray:
        if len(self) > LEXICON:
            self.clear()
        words = (text or b"").split()
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))


def _anchors(words: np.ndarray) -> np.ndarray:
    """Hashes of ANCHOR words from each position, from those of half as many."""
    h, held = words.astype(np.uint64), 1
    while held < ANCHOR:
        first = h[:-held] * _MIX
        h = ((first ^ (first >> np.uint64(32))) + h[held:]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        held *= 2
    return h


def _leftmost(h: np.ndarray, window: int) -> np.ndarray:
    """Position of the leftmost smallest value in each window."""
    at, held = np.arange(len(h)), 1
    while held < window:
        step = min(held, window - held)
        first = h[:-step] <= h[step:]
        at = np.where(first, at[:-step], at[step:])
        h = np.where(first, h[:-step], h[step:])
        held += step
    return at


def minimisers(words: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the kept suffixes: one at least in every min_words words. A 0 is no word."""
    at, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for first in range(0, len(words) - min_words + 1, BLOCK):
        part = words[first : first + BLOCK + min_words - 1]
        gaps = np.r_[0, np.cumsum(part == 0)]
        h = _anchors(part)
        found = np.unique(_leftmost(h, min_words - ANCHOR + 1)[gaps[min_words:] == gaps[:-min_words]])
        at.append(found + first)
        hashes.append(h[found])
    at, one = np.unique(np.concatenate(at), return_index=True)
    return at, np.concatenate(hashes)[one]


def _blocks(texts: list, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, starts, rows): the words of several texts, each with `reach` zeros on both sides."""
    lexicon, gap = Words(), np.zeros(reach, np.uint32)
    parts, starts, rows, n = [gap], [], [], reach
    for row, text in enumerate(texts):
        words = lexicon.hashes(text)
        if len(words) <= reach:
            continue
        starts.append(n)
        rows.append(row)
        parts += [words, gap]
        n += len(words) + reach
        if n > BLOCK:
            yield np.concatenate(parts), np.array(starts), np.array(rows)
            parts, starts, rows, n = [gap], [], [], reach
    if rows:
        yield np.concatenate(parts), np.array(starts), np.array(rows)


def _kept(docs: DataFrame, min_words: int) -> DataFrame:
    """(id, hash): every kept suffix's first words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            for words, starts, rows in _blocks(texts, min_words - ANCHOR):
                at, h = minimisers(words, min_words)
                of = rows[np.searchsorted(starts, at, "right") - 1]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(of, pa.int64())), pa.array(h.view(np.int64))], ["id", "hash"])

    return docs.mapInArrow(run, "id long, hash long")


def _with_context(docs: DataFrame, min_words: int, bits) -> DataFrame:
    """(hash, right, left, id, at): kept suffixes that may be repeated, with the hashes of the words around.

    right goes on behind the first words, left goes back from them; both reach as far as a passage
    of min_words that holds the suffix can. Beyond a text's ends they hold 0.
    """
    reach = min_words - ANCHOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = np.arange(reach)
        pack = lambda m: pa.Array.from_buffers(pa.binary(4 * reach), len(m), [None, pa.py_buffer(m.astype(">u4").tobytes())]).cast(pa.binary())
        for batch, texts in text_batches(batches, "text"):
            for words, starts, rows in _blocks(texts, reach):
                every, h = minimisers(words, min_words)
                hit = may_hold(bits.value, h)
                every, h = every[hit], h[hit]
                for first in range(0, len(every), GROUP):
                    at = every[first : first + GROUP]
                    text = np.searchsorted(starts, at, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(h[first : first + GROUP].view(np.int64)), pack(words[at[:, None] + ANCHOR + steps]), pack(words[at[:, None] - 1 - steps]),
                            batch.column("id").take(pa.array(rows[text])), pa.array(at - starts[text]),
                        ],
                        ["hash", "right", "left", "id", "at"],
                    )

    return docs.mapInArrow(run, "hash long, right binary, left binary, id long, at long")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading words that two contexts share; a 0 is no word."""
    same = (a == b) & (a != 0)
    return np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))


class _Rows:
    """Sorted suffixes as arrays."""

    def __init__(self, batch: pa.RecordBatch | pa.Table):
        wide = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u4").reshape(batch.num_rows, -1)
        self.hash, self.id, self.at = (batch.column(c).to_numpy() for c in ("hash", "id", "at"))
        self.right, self.left = wide("right"), wide("left")

    def take(self, rows: np.ndarray) -> _Rows:
        out = object.__new__(_Rows)
        for name, values in vars(self).items():
            setattr(out, name, values[rows])
        return out

    def matches(self, rows: np.ndarray, others: np.ndarray, min_words: int) -> pa.RecordBatch:
        """Spans of rows that they share with others, where long enough."""
        same = (self.hash[rows] == self.hash[others]) & (self.id[rows] != self.id[others])
        rows, others = rows[same], others[same]
        right = ANCHOR + _common(self.right[rows], self.right[others])
        left = _common(self.left[rows], self.left[others])
        long = right + left >= min_words
        at = self.at[rows[long]]
        return pa.RecordBatch.from_arrays(
            [pa.array(self.id[rows[long]]), pa.array(at - left[long]), pa.array(at + right[long]), pa.array(self.id[others[long]])],
            ["id", "start", "end", "other"],
        )

    def windows(self, min_words: int) -> np.ndarray:
        """Hashes of the min_words words around each suffix's first ones, by how many stand before; 0 where there is none."""
        sides, reach = [], min_words - ANCHOR
        for words in (self.left, self.right):
            h = self.hash.view(np.uint64).copy()
            sides.append([h])
            for i in range(reach):
                h = (h + words[:, i]) * _MIX
                h = h ^ (h >> np.uint64(29))
                sides[-1].append(h)
        held = [(words != 0).sum(axis=1) for words in (self.left, self.right)]
        out = np.zeros((len(self.hash), reach + 1), np.uint64)
        for back in range(reach + 1):
            h = (sides[0][back] + np.uint64(back)) * np.uint64(0xD6E8FEB86659FD93) ^ sides[1][reach - back]
            out[:, back] = np.where((held[0] >= back) & (held[1] >= reach - back), h | np.uint64(1), 0)
        return out


def _solved(batch: pa.RecordBatch, min_words: int, whole: bool, cut: bool) -> Iterator[tuple[str, pa.RecordBatch]]:
    """Spans whose windows another document of the batch holds; the batch is sorted by hash.

    whole: all suffixes that begin like those of the batch are in it. If not, two holders of each
    window, or all places of its only one, are given as windows too, to be compared with other tasks'.
    cut: the batch is joined from several, so neighbours have not settled equal contexts.
    """
    if whole:
        hashes, ids = batch.column("hash").to_numpy(), batch.column("id").to_numpy()
        starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        sizes = np.diff(np.r_[starts, len(hashes)])
        # Of two suffixes each is the other's neighbour.
        more = (sizes > 2) & (np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts))
        batch = batch.filter(pa.array(np.repeat(more, sizes)))
    for first in range(0, batch.num_rows, GROUP if not whole else max(1, batch.num_rows)):
        rows = _Rows(batch.slice(first, GROUP if not whole else None))
        if whole and not cut:
            same = (rows.hash[1:] == rows.hash[:-1]) & (rows.right[1:] == rows.right[:-1]).all(axis=1) & (rows.left[1:] == rows.left[:-1]).all(axis=1)
            starts = np.flatnonzero(np.r_[True, rows.hash[1:] != rows.hash[:-1]])
            differ = np.add.reduceat(np.r_[True, ~same].astype(int), starts) > 1
            rows = rows.take(np.flatnonzero(np.repeat(differ, np.diff(np.r_[starts, len(rows.hash)]))))
            if not len(rows.hash):
                continue
        keys = rows.windows(min_words)
        row, back = np.nonzero(keys)
        if not len(row):
            continue
        keys = keys[row, back]
        order = np.lexsort((rows.id[row], keys))
        row, back, keys = row[order], back[order], keys[order]
        ids = rows.id[row]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        ends = np.r_[starts[1:], len(keys)]
        of = np.repeat(np.arange(len(starts)), ends - starts)
        low, high = ids[starts][of], ids[ends - 1][of]
        shared = low < high
        if not whole:
            # Of a window that several documents hold here two tell the others; of one document's, each may be repeated elsewhere.
            ends_only = np.zeros(len(keys), bool)
            ends_only[starts] = ends_only[ends - 1] = True
            two = np.flatnonzero(~shared | ends_only)
            yield "windows", pa.RecordBatch.from_arrays(
                [pa.array(ids[two]), pa.array(rows.at[row[two]] - back[two]), pa.array(keys[two].view(np.int64))], ["id", "start", "hash"]
            )
        if not shared.any():
            continue
        # All windows of a suffix hold its first words, so those shared make one span.
        row, back, other = row[shared], back[shared], np.where(ids == low, high, low)[shared]
        order = np.argsort(row, kind="stable")
        row, back, other = row[order], back[order], other[order]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        at = rows.at[row[starts]]
        yield "spans", pa.RecordBatch.from_arrays(
            [
                pa.array(rows.id[row[starts]]), pa.array(at - np.maximum.reduceat(back, starts)),
                pa.array(at - np.minimum.reduceat(back, starts) + min_words), pa.array(np.minimum.reduceat(other, starts)),
            ],
            ["id", "start", "end", "other"],
        )


def _compare(suffixes: DataFrame, min_words: int) -> DataFrame:
    """(id, start, end, other, edge, part, hash, right, left, at) from sorted suffixes.

    Rows without an edge are matches. The first (edge 0) and last (1) suffix of each partition come
    along whole, to be compared across its borders. The neighbour with the longest match to the
    right may match less to the left than one further off: of suffixes that begin alike, all windows
    of min_words are compared as well. Those in the middle of a partition are all there; of groups
    that may go on in another one, or of more than GROUP, windows come along (edge 2, in hash).
    """
    order = ["hash", "right", "left", "id", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, carried, last = TaskContext.get().partitionId(), None, None

        def edge(row: pa.RecordBatch, kind: int) -> pa.RecordBatch:
            nothing = pa.array([None], pa.int64())
            return pa.RecordBatch.from_arrays(
                [row.column("id"), nothing, nothing, nothing, pa.array([kind], pa.int32()), pa.array([part], pa.int32()), *[row.column(c) for c in ("hash", "right", "left", "at")]],
                ["id", "start", "end", "other", "edge", "part", "hash", "right", "left", "at"],
            )

        def spans(found: pa.RecordBatch) -> pa.RecordBatch:
            none = [pa.nulls(found.num_rows, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64())]
            return pa.RecordBatch.from_arrays([*found.columns, *none], ["id", "start", "end", "other", "edge", "part", "hash", "right", "left", "at"])

        def solved(parts: list[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
            for kind, found in _solved(joined(parts), min_words, whole, len(parts) > 1):
                if kind == "spans":
                    yield spans(found)
                    continue
                n = found.num_rows
                none = lambda t: pa.nulls(n, t)
                yield pa.RecordBatch.from_arrays(
                    [
                        found.column("id"), found.column("start"), none(pa.int64()), none(pa.int64()), pa.array(np.full(n, 2, np.int32)),
                        none(pa.int32()), found.column("hash"), none(pa.binary()), none(pa.binary()), none(pa.int64()),
                    ],
                    ["id", "start", "end", "other", "edge", "part", "hash", "right", "left", "at"],
                )

        def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

        # The suffixes that begin like the newest one, and whether they are all of them so far.
        held, complete = [], False
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                yield edge(batch.slice(0, 1), 0)
            hashes = batch.column("hash").to_numpy()
            cuts = np.flatnonzero(hashes[1:] != hashes[:-1]) + 1
            begin = 0
            if held and hashes[0] != held[0].column("hash")[0].as_py():
                yield from solved(held, complete)
                held, complete = [], True
            elif len(cuts):
                yield from solved([*held, batch.slice(0, cuts[0])], complete)
                held, complete, begin = [], True, cuts[0]
            if len(cuts):
                if begin < cuts[-1]:
                    yield from solved([batch.slice(begin, cuts[-1] - begin)], True)
                begin = cuts[-1]
            held.append(batch.slice(begin))
            if sum(h.num_rows for h in held) > GROUP:
                # Its other suffixes are compared across tasks; one stays to tell the group.
                yield from solved(held, False)
                held, complete = [held[-1].slice(held[-1].num_rows - 1)], False
            old = carried.num_rows if carried is not None else 0
            block = pa.Table.from_batches(([carried] if old else []) + [batch]).combine_chunks()
            rows, n = _Rows(block), block.num_rows
            new = np.r_[True, (rows.id[1:] != rows.id[:-1]) | (rows.hash[1:] != rows.hash[:-1])]
            run_of, starts = np.cumsum(new) - 1, np.flatnonzero(new)
            before, after = starts[run_of] - 1, np.r_[starts[1:], n][run_of]
            everything = np.arange(n)
            back = everything[(before >= 0) & (everything >= old)]
            on = everything[after < n]
            yield spans(rows.matches(np.r_[back, on], np.r_[before[back], after[on]], min_words))
            whole = block.to_batches()[0]
            # A document's equal suffixes in a row; of a long run its ends are enough to go on with.
            carried, last = whole.slice(max(starts[-1], n - 64)), whole.slice(n - 1)
        if last is not None:
            yield from solved(held, False)
            yield edge(last, 1)

    # By all columns: equal suffixes of a large group of copies are spread as well.
    spread = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    return spread.mapInArrow(run, "id long, start long, end long, other long, edge int, part int, hash long, right binary, left binary, at long")


def _across(compared: DataFrame, min_words: int) -> DataFrame | None:
    """Matches between the last suffix of a partition and the first of the next; two rows a partition."""
    edges = compared.where("edge < 2").orderBy("part", "edge").toArrow().combine_chunks()
    if edges.num_rows < 3:
        return None
    rows, edge = _Rows(edges), edges.column("edge").to_numpy()
    last = np.flatnonzero((edge[:-1] == 1) & (edge[1:] == 0))
    found = rows.matches(np.r_[last, last + 1], np.r_[last + 1, last], min_words)
    if not found.num_rows:
        return None
    return compared.sparkSession.createDataFrame(pa.Table.from_batches([found])).selectExpr("id", "start", "end", "other")


def _leftover(compared: DataFrame, min_words: int) -> DataFrame:
    """(id, start, end, other): windows that documents of different tasks hold."""
    windows = compared.where("edge = 2").select(F.col("hash").alias("window"), "id", "start")
    shared = windows.groupBy("window").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low <> high")
    return windows.join(shared, "window").select("id", "start", (F.col("start") + min_words).alias("end"), _not_self().alias("other"))


def _not_self() -> Column:
    return F.when(F.col("id") == F.col("low"), F.col("high")).otherwise(F.col("low"))


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, start_word, n_words, other_doc_id): the passages of min_words words or more that other documents hold too.

    Words are what ASCII white space parts; start_word counts from 0. other_doc_id is the smallest
    id among the neighbours that the passage was found with. Passages that touch or overlap are
    one. Null, empty and shorter texts have none, nor have rows without an id. Rows with the same
    id are one document: a passage that only they share is not repeated. An empty table gives none.
    """
    if min_words < 2 * ANCHOR:
        raise ValueError(f"passages need {2 * ANCHOR} words or more")
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).where("id IS NOT NULL")
    twice = (
        _kept(slim, min_words).groupBy("hash").agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .where("low <> high").select("hash")
    )
    bits = docs.sparkSession.sparkContext.broadcast(build_filter(twice))
    compared = staged(_compare(_with_context(slim, min_words, bits), min_words), "suffix-matches")
    spans = compared.where("edge IS NULL").select("id", "start", "end", "other")
    border = _across(compared, min_words)
    if border is not None:
        spans = spans.unionByName(border)
    spans = spans.unionByName(_leftover(compared, min_words))
    spans = spans.groupBy("id", "start").agg(F.max("end").alias("end"), F.min("other").alias("other"))
    order = Window.partitionBy("id").orderBy("start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("_new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    islands = islands.withColumn("_island", F.sum("_new").over(order))
    return islands.groupBy("id", "_island").agg(
        F.min("start").alias("start_word"), F.max("end").alias("_end"), F.min("other").alias("other_doc_id")
    ).select(F.col("id").alias("doc_id"), "start_word", (F.col("_end") - F.col("start_word")).alias("n_words"), "other_doc_id")
