"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Windows of template words are hashed and joined. A shared window counts if its slots are filled
consistently: the values of one side map one to one to those of the other, which is so exactly if
both have the same pattern of equal slots. So a question asked anew with other names and numbers
is found as well as a verbatim one. Beside them stand the windows' words themselves in small letters:
they find what has too few literal words for a template, and copies in other case.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import as_texts, listed, staged, text_blocks
from parcelflow.llm.hashfilter import build_filter, may_hold

#: Template words in a window. Items with fewer words are one window of their own length.
WINDOW = 10
#: Words of a window that must not be placeholders; with fewer its words must be the same.
LITERALS = 5

NUMBER, NAME, UNIT, QUANTITY = "<number>", "<name>", "<unit>", "<quantity>"
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg gram grams kilogram kilograms oz ounce "
    "ounces lb lbs pound pounds ton tons ml cl l liter liters litre litres gallon gallons cup cups s sec second seconds "
    "min minute minutes h hr hour hours day days week weeks month months year years dollar dollars cent cents euro euros "
    "usd eur gbp percent degree degrees mph kph watt watts volt volts joule joules kb mb gb tb byte bytes".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?\d+(?:[.,:/]\d+)*%?")
_QUANTITY = re.compile(r"([+-]?[$€£]?\d+(?:[.,:/]\d+)*)([a-z]{1,8})")
_END = re.compile(r"[.!?:]\W*$")
_EDGES = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")


class Words(NamedTuple):
    """The template words of several texts, one behind the other.

    hashes of the template's words; their kinds (0: literal) and numbers in the lexicon; whether a name
    stands first in a sentence, and so perhaps is none; hashes of the small letters; the text of each word.
    """

    hashes: np.ndarray
    kinds: np.ndarray
    numbers: np.ndarray
    first: np.ndarray
    folded: np.ndarray
    owner: np.ndarray


class Lexicon(dict):
    """Word numbers by raw word; per number its hash, kind and lower-case value. Holds a bounded number."""

    LIMIT = 400_000
    KINDS = (NUMBER, QUANTITY, NAME, UNIT)
    #: Hashes of what stands for a word; a unit is one only behind a number, so it has its own word's until then.
    SLOTS = {kind: xxhash.xxh64_intdigest(kind.encode(), 5) for kind in (NUMBER, QUANTITY, NAME)}

    def __init__(self):
        self.hashes, self.folded = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.kinds, self.ends, self.values = np.zeros(0, np.int8), np.zeros(0, bool), []

    def _kind(self, word: str, low: str) -> int:
        """Number of its kind in KINDS from 1, 0 for a literal, -1 where there is no letter or digit."""
        if not word:
            return -1
        # What is all letters needs no pattern.
        if not word.isalpha():
            if _NUMBER.fullmatch(low):
                return 1
            if (m := _QUANTITY.fullmatch(low)) and m[2] in UNITS:
                return 2
        if low in UNITS:
            return 4
        return 3 if word[0].isupper() and word[1:] == word[1:].lower() else 0

    def learn(self, words: list[str]) -> None:
        known = len(self.values)
        hashes, folded, kinds, ends = [], [], [], []
        for number, raw in enumerate(words, known):
            # Most words are letters, perhaps with a mark behind.
            word = raw if raw.isalnum() else raw[:-1] if raw[:-1].isalnum() and raw[-1] in ".,;:!?" else _EDGES.sub("", raw)
            low = word.lower()
            kind, own = self._kind(word, low), _hash(low)
            hashes.append(self.SLOTS[self.KINDS[kind - 1]] if 0 < kind < 4 else own)
            folded.append(own)
            kinds.append(kind)
            ends.append(raw != word and bool(_END.search(raw)))
            self.values.append(low)
            self[raw] = number
        self.hashes = np.concatenate([self.hashes, np.array(hashes, np.uint64)])
        self.folded = np.concatenate([self.folded, np.array(folded, np.uint64)])
        self.kinds = np.concatenate([self.kinds, np.array(kinds, np.int8)])
        self.ends = np.concatenate([self.ends, np.array(ends, bool)])

    def read(self, texts: pa.Array) -> Words:
        """A word with a capital first letter and small others is a name; a unit after a number is a unit, elsewhere
        a literal; what holds no letter or digit is left out."""
        if len(self.values) > self.LIMIT:
            self.clear()
            self.__init__()
        words, offsets = listed(pc.utf8_split_whitespace(texts))
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self.learn([w for w in distinct if w not in self])
        numbers = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
        begins = np.r_[True, self.ends[numbers[:-1]]][: len(numbers)]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        held = self.kinds[numbers] >= 0
        # A sentence may begin with marks.
        begins[1:] |= begins[:-1] & ~held[:-1]
        numbers, begins, owner = numbers[held], begins[held], owner[held]
        hashes, kinds = self.hashes[numbers], self.kinds[numbers]
        unit = np.flatnonzero(kinds == 4)
        if len(unit):
            before = np.maximum(unit - 1, 0)
            after = (unit > 0) & (kinds[before] == 1) & (owner[before] == owner[unit])
            hashes[unit[after]] = _hash(UNIT)
            kinds[unit[~after]] = 0
        return Words(hashes, kinds, numbers, begins & (kinds == 3), self.folded[numbers], owner)

    def template(self, text: str) -> list[str]:
        """The template itself, for reading."""
        words = self.read(pa.array([text]))
        return [self.KINDS[k - 1] if k else self.values[n] for k, n in zip(words.kinds, words.numbers, strict=True)]


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 5)


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash per window of `size` words, put together from windows of 1, 2, 4, … words."""

    def mixed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        both = (one * np.uint64(0xD6E8FEB86659FD93) + two) * np.uint64(0x9E3779B97F4A7C15)
        both ^= both >> np.uint64(32)
        return both

    n = len(hashes) - size + 1
    rolled, covered, part, width = np.full(n, size, dtype=np.uint64), 0, hashes, 1
    while True:
        if size & width:
            rolled = mixed(rolled, part[covered : covered + n])
            covered += width
        if covered == size:
            return rolled
        part, width = mixed(part[:-width], part[width:]), 2 * width


def _inside(flags: np.ndarray, size: int) -> np.ndarray:
    """How many of the flags each window holds."""
    upto = np.cumsum(np.r_[0, flags])
    return upto[size:] - upto[:-size]


def _windows(words: Words, size: int, texts: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(starts, hashes, kinds, template) of three readings of the windows, each inside one text, of the marked texts only.

    Templates with enough literal words; the same with the first words of sentences as literals;
    and the words themselves. A reading that is the same as an earlier one is left out.
    """
    hashes, kinds, first, folded, owner = words.hashes, words.kinds, words.first, words.folded, words.owner
    if len(hashes) < size or not size:
        return
    inside = owner[: len(owner) - size + 1] == owner[size - 1 :]
    if texts is not None:
        inside &= texts[owner[: len(inside)]]
    at = np.flatnonzero(inside & (_inside(kinds == 0, size) >= LITERALS))
    yield at, _rolled(hashes, size)[at], kinds, True
    literal = np.where(first, 0, kinds)
    slots = _inside(literal != 0, size)
    if first.any():
        at = np.flatnonzero(inside & (size - slots >= LITERALS) & (_inside(first, size) > 0))
        yield at, _rolled(np.where(first, folded, hashes), size)[at], literal, True
    at = np.flatnonzero(inside & ((slots > 0) | (size - slots < LITERALS)))
    yield at, _rolled(folded, size)[at], np.zeros_like(kinds), False


def _pattern(values: list[str]) -> str:
    """Slots numbered by first appearance of their value: equal slots, equal numbers."""
    seen: dict[str, int] = {}
    return ".".join(str(seen.setdefault(v, len(seen))) for v in values)


_ROW = "id {id}, size int, at int, hash long, pattern string, filled long, template boolean"


def _benchmark_windows(items: DataFrame) -> DataFrame:
    """Windows of the items: (id, size, at, hash, pattern, filled, template); filled hashes the slots' values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            yield from _rows(lexicon, batch.column("id"), as_texts(batch.column("text")), None)

    return items.mapInArrow(run, _ROW.format(id=items.schema["id"].dataType.simpleString()))


def _rows(
    lexicon: Lexicon, ids: pa.Array, texts: pa.Array, wanted: tuple[list[int], np.ndarray] | None
) -> Iterator[pa.RecordBatch]:
    """Rows for the windows of texts: an item's own size, or for documents those the filter lets through."""
    done = 0
    for block in text_blocks(texts):
        words = lexicon.read(block)
        counts = np.bincount(words.owner, minlength=len(block))
        begins = np.cumsum(counts) - counts
        own = np.minimum(counts, WINDOW)
        source, columns = [], ([], [], [], [], [], [])
        for size in sorted(set(own.tolist())) if wanted is None else wanted[0]:
            for starts, found, read, template in _windows(words, size, own == size if wanted is None else None):
                if wanted is not None:
                    hit = may_hold(wanted[1], found)
                    starts, found = starts[hit], found[hit]
                owners = words.owner[starts]
                for start, h, number, at in zip(starts.tolist(), found.view(np.int64).tolist(), owners.tolist(), (starts - begins[owners]).tolist(), strict=True):
                    numbers = words.numbers[start : start + size]
                    slots = [lexicon.values[n] for n, k in zip(numbers, read[start : start + size], strict=True) if k]
                    filled = xxhash.xxh64_intdigest("\0".join(slots).encode("utf-8", "surrogatepass")) - (1 << 63)
                    source.append(done + number)
                    for column, value in zip(columns, (size, at, h, _pattern(slots), filled, template), strict=True):
                        column.append(value)
        done += len(block)
        if source:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(source)), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["id", "size", "at", "hash", "pattern", "filled", "template"],
            )


def _matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(id, text_hash, item_id, item_ats, start, size, exact): what rows with this id and text share with an item."""
    spark = docs.sparkSession
    items = staged(
        _benchmark_windows(benchmark.select(F.col(item_col).alias("id"), F.col(item_text_col).alias("text"))), "bench-windows"
    )
    # Items with the very same templates are joined as one, and each of them is told from it.
    templates = items.where("template")
    whole = templates.groupBy("id").agg(F.sort_array(F.collect_set(F.struct("at", "hash", "pattern"))).alias("set"))
    same = staged(whole.groupBy("set").agg(F.min("id").alias("lead"), F.collect_list(F.struct("id")).alias("all")).drop("set"), "bench-sets")
    sizes = [r[0] for r in items.select("size").distinct().collect()]
    bits = spark.sparkContext.broadcast(build_filter(items))
    kind = f"struct<id:{docs.schema[id_col].dataType.simpleString()},text_hash:bigint>"
    slim = docs.select(
        F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash")).alias("id"),
        F.col(f"`{text_col}`").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            yield from _rows(lexicon, batch.column("id"), as_texts(batch.column("text")), (sizes, bits.value))

    found = slim.mapInArrow(run, _ROW.format(id=kind))
    found = staged(found.select("id.id", "id.text_hash", "size", "at", "hash", "pattern", "filled"), "doc-windows")
    lead = templates.join(same, F.col("id").eqNullSafe(F.col("lead"))).select(
        "lead", F.col("at").alias("item_at"), "hash", "size", "pattern"
    )
    parts = [F.collect_set("item_at").alias("item_ats"), F.min("at").alias("start"), F.max("size").alias("size")]
    alike = (
        found.join(lead, ["hash", "size", "pattern"]).groupBy("id", "text_hash", "lead").agg(*parts).withColumnRenamed("lead", "_lead")
        .join(same, F.col("_lead").eqNullSafe(F.col("lead"))).withColumn("item", F.explode("all"))
        .select("id", "text_hash", F.col("item.id").alias("item_id"), "item_ats", "start", "size", F.lit(0).alias("exact"))
    )
    own = items.select(F.col("id").alias("item_id"), F.col("at").alias("item_at"), "hash", "size", "pattern", "filled")
    equal = (
        found.join(own, ["hash", "size", "pattern", "filled"]).groupBy("id", "text_hash", "item_id").agg(*parts)
        .select("id", "text_hash", "item_id", "item_ats", "start", "size", F.lit(1).alias("exact"))
    )
    return alike.unionByName(equal)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(doc_id, item_id, kind, windows, start_word, words): a row per document and item it holds.

    kind is `exact` if some shared window has the very values of the item, else `template`: then
    the slots of each shared window are filled consistently. windows counts the item's windows
    found; start_word and words tell where the found part lies, in template words. A document with
    a passage several times has one row, for the first. Null and blank texts hold nothing and are in
    nothing. Rows with the same id count as one document. Empty tables give no rows.
    """
    return (
        _matches(docs, benchmark, id_col, **options)
        .groupBy(F.col("id").alias("doc_id"), "item_id")
        .agg(
            F.max("exact").alias("exact"), F.array_distinct(F.flatten(F.collect_list("item_ats"))).alias("ats"),
            F.min("start").alias("start_word"), F.max("size").alias("size"),
        )
        .select(
            "doc_id", "item_id", F.when(F.col("exact") == 1, F.lit("exact")).otherwise(F.lit("template")).alias("kind"),
            F.size("ats").cast("long").alias("windows"), "start_word",
            (F.array_max("ats") - F.array_min("ats") + F.col("size")).alias("words"),
        )
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """Rows of docs that hold no benchmark passage, all columns. Rows that share an id, or have none, are told apart by their text."""
    found = _matches(docs, benchmark, id_col, text_col, **options)
    caught = staged(found.select(F.col("id").alias("_leaking"), F.col("text_hash").alias("_leaking_hash")).distinct(), "leaks")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_leaking")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("_leaking_hash"))
    return docs.join(caught, same, "left_anti")
