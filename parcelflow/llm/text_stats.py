"""Statistics of whole texts, one pass each, in Arrow batches."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import text_batches

#: Names of the statistics, in the order of `statistics`.
NAMES = (
    "log_chars", "log_words", "log_lines", "word_chars", "upper", "digits", "spaces", "stops", "commas",
    "marks", "symbols", "other_bytes", "control", "ending_marks", "top_word", "distinct_words",
    "same_as_last", "one_letter", "long_words", "repeated_lines", "line_words", "pair_repeats", "capital_words",
)

_BYTES = np.arange(256)
_CLASS = np.zeros(256, dtype=np.int64)
for _number, _set in enumerate(
    [range(65, 91), range(97, 123), range(48, 58), b" \t\n\r\x0b\x0c", b".!?", b",;:", b"'\"()-", range(128, 256)], start=1
):
    _CLASS[list(_set)] = _number
_CLASS[[b for b in range(32) if b not in b"\t\n\r\x0b\x0c"] + [127]] = 9


def statistics(text: bytes | None) -> tuple[float, ...]:
    """Shares and logarithms; zeros where a text has nothing to count. A null counts as empty."""
    text = text or b""
    n = len(text)
    kinds = np.bincount(_CLASS, weights=np.bincount(np.frombuffer(text, np.uint8), minlength=256), minlength=10)
    symbols, upper, lower, digits, spaces, stops, commas, marks, other, control = kinds
    words, lines = text.split(), [x for x in text.split(b"\n") if x.strip()]
    w, inked = len(words), max(1.0, n - spaces)
    counts = Counter(words)
    top = max(counts.values(), default=0)
    pairs = w - 1 - len(set(zip(words, words[1:], strict=False))) if w > 1 else 0
    per_word = lambda x: x / w if w else 0.0
    return (
        float(np.log1p(n)), float(np.log1p(w)), float(np.log1p(len(lines))), min(50.0, per_word(n - spaces)),
        upper / max(1.0, upper + lower), digits / inked, spaces / max(1, n), per_word(stops), per_word(commas),
        marks / inked, symbols / inked, other / inked, control / max(1, n),
        per_word(sum(not x[-1:].isalnum() and x[-1] < 128 and x[-1:] not in b".,;:!?" for x in words)),
        per_word(top), per_word(len(counts)),
        per_word(sum(a == b for a, b in zip(words, words[1:], strict=False))),
        per_word(sum(len(x) == 1 for x in words)), per_word(sum(len(x) > 20 for x in words)),
        1 - len(set(lines)) / len(lines) if lines else 0.0, w / len(lines) if lines else 0.0,
        pairs / (w - 1) if w > 1 else 0.0, per_word(sum(65 <= x[0] <= 90 for x in words)),
    )


#: Columns of the statistics.
COLUMNS = tuple(f"_stat_{n}" for n in NAMES)


def with_statistics(docs: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """The key columns and the statistics of the text, one row per row; other columns are not read.

    Inside, columns go by their place, so a key may have any name, also that of a statistic.
    """
    places = [f"k{i}" for i in range(len(keys))]
    slim = docs.select(*[F.col(f"`{k}`").alias(p) for k, p in zip(keys, places, strict=True)], F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_batches(batches, "text"):
            found = np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), len(NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(places)], *[pa.array(c) for c in found.T]], [*places, *COLUMNS])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    return slim.mapInArrow(run, ", ".join(fields + [f"{n} double" for n in COLUMNS])).toDF(*keys, *COLUMNS)
