"""Language identification by bit-sliced Bloom filters of character n-grams.

One filter serves all languages: a slot holds a bit per language. An n-gram's slots, joined by
AND, give all languages that have it. A text's languages are counted over its n-grams, corrected
for the false positives each language's fill lets through, and the largest share decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import id_remainder, staged, text_batches

#: Rows whose crc32(doc_id) mod FOLDS is HELD are held out of learning.
FOLDS, HELD = 3, 1
N = 3
#: Slots of the filter and probes per n-gram; 2 MB for up to 64 languages, whatever is learnt.
SLOT_LOG, PROBES = 18, 3
#: Documents learnt from per language at most (the smallest by a hash of the id), and the share of
#: them in which an n-gram must occur, so that quoted lines of another language don't count.
SAMPLE_DOCS, LEAST_SHARE = 3000, 0.02
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, FOLDS) == HELD


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all n-grams of the texts in lower case, one space for what parts words; first and end per text."""
    cleaned = [" " + _OTHER.sub(" ", t.lower()).strip() + " " for t in texts]
    lengths = np.array([len(c) for c in cleaned], dtype=np.int64)
    points = np.frombuffer("".join(cleaned).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    if len(points) < N:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    keys = points[: len(points) - N + 1].copy()
    for i in range(1, N):
        keys |= points[i : len(points) - N + 1 + i] << np.uint64(21 * i)
    end = np.cumsum(lengths)
    return keys, end - lengths, np.maximum(end - lengths, end - N + 1)


def slots(keys: np.ndarray) -> Iterator[np.ndarray]:
    for i in range(PROBES):
        h = (keys ^ np.uint64(i * 0xD6E8FEB86659FD93 % 2**64)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        yield h >> np.uint64(64 - SLOT_LOG)


@dataclass(frozen=True)
class LanguageFilter:
    languages: tuple[str, ...]
    bits: np.ndarray

    @classmethod
    def build(cls, languages: tuple[str, ...], keys: np.ndarray, masks: np.ndarray) -> LanguageFilter:
        bits = np.zeros(1 << SLOT_LOG, np.uint64)
        for at in slots(keys):
            np.bitwise_or.at(bits, at, masks)
        return cls(languages, bits)

    def shares(self, texts: list[str]) -> np.ndarray:
        """Per text and language the corrected share of n-grams that the language has."""
        keys, first, end = grams(texts)
        found = np.full(len(keys), np.iinfo(np.uint64).max, np.uint64)
        for at in slots(keys):
            found &= self.bits[at]
        out = np.zeros((len(texts), len(self.languages)))
        n = np.maximum(1, end - first)
        for number in range(len(self.languages)):
            bit = np.uint64(number)
            upto = np.r_[0, np.cumsum((found >> bit) & np.uint64(1), dtype=np.int64)]
            wrong = float(((self.bits >> bit) & np.uint64(1)).mean()) ** PROBES
            out[:, number] = np.clip(((upto[end] - upto[first]) / n - wrong) / max(1e-9, 1 - wrong), 0, 1)
        return out

    def predict(self, text: str, shares: np.ndarray) -> tuple[str, float]:
        if not has_letter(text) or not self.languages:
            return UNKNOWN, 0.0
        best = int(shares.argmax())
        total = float(shares.sum())
        return self.languages[best], float(shares[best] / total) if total else 0.0


def learn(docs: DataFrame) -> LanguageFilter:
    """A filter from text and non-null lang of the rows not held out, a bounded number per language.

    Up to 64 languages; ties of a text go to the first by name. Rows without text teach nothing;
    no rows give a filter without languages.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "lang", "text")
    languages = tuple(r[0] for r in known.select("lang").distinct().orderBy("lang").limit(65).collect())
    if len(languages) > 64:
        raise ValueError("more than 64 languages; a slot has 64 bits")
    # Only numbers are ranked and at most 64 * SAMPLE_DOCS of them are broadcast: texts stay where they
    # are read. Ranks are cut on both sides of the shuffle; repeated rows are one.
    by_id = F.xxhash64(F.col("doc_id").cast("string"), F.lit("lang"))
    keyed = known.withColumn("_row", F.xxhash64(F.col("doc_id").cast("string"), "lang", "text"))
    order = Window.partitionBy("lang").orderBy("_by_id", "_row")
    ranked = keyed.select("lang", by_id.alias("_by_id"), "_row").distinct().withColumn("_rank", F.row_number().over(order))
    chosen = ranked.where(F.col("_rank") <= SAMPLE_DOCS).select("_row")
    # Once written, since two readers follow; spread over the tasks by the de-duplication.
    sample = staged(keyed.join(F.broadcast(chosen), "_row", "left_semi").dropDuplicates(["_row"]).select("lang", "text"), "lang-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            rows = [np.unique(grams([t.decode("utf-8", "replace")])[0]) for t in texts]
            names = batch.column("lang").to_pylist()
            for name in set(names):
                keys, counts = np.unique(np.concatenate([r for r, n in zip(rows, names, strict=True) if n == name]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)], ["lang", "gram", "docs"]
                )

    counted = sample.mapInArrow(run, "lang string, gram long, docs long").groupBy("lang", "gram").agg(F.sum("docs").alias("docs"))
    learnt = sample.groupBy("lang").count()
    kept = counted.join(learnt, "lang").where(F.col("docs") >= F.greatest(F.lit(1), F.ceil(F.col("count") * LEAST_SHARE)))
    # An n-gram in a fiftieth of the texts of a bounded sample: few thousand a language.
    found = kept.select("lang", "gram").toPandas()
    number = {name: i for i, name in enumerate(languages)}
    masks = np.array([1 << number[x] for x in found["lang"]], dtype=np.uint64)
    return LanguageFilter.build(languages, found["gram"].to_numpy(np.int64).view(np.uint64), masks)


def predicted(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; `und` for a text that is null or has no letter.

    score is the winner's part of all languages' shares. Repeated rows stay, null ids too. An
    empty table gives none. Only doc_id and text are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in text_batches(batches, "text"):
            found = []
            for at in range(0, len(raw), 256):
                texts = [(t or b"").decode("utf-8", "replace") for t in raw[at : at + 256]]
                found += map(shared.value.predict, texts, shared.value.shares(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return slim.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
