"""Quality classifier: a sparse rule ensemble over text statistics, compiled to columns."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import id_remainder
from parcelflow.llm.rules import RuleEnsemble, fit
from parcelflow.llm.text_stats import COLUMNS, with_statistics

#: Rows whose crc32(doc_id) mod FOLDS is 0 are held out of learning.
FOLDS = 5
THRESHOLD = 0.3
#: Bound on the labels, and on the labelled rows that reach the driver for the fit: the smallest by a hash.
SAMPLE_ROWS = 20_000


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, FOLDS) == 0


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> RuleEnsemble:
    """Fit to labels.quality by statistics of the whole texts of a bounded sample.

    Rows without a label, with a null label or a null id, or held out, are not learnt from.
    Of an id with several labels all count, of rows with the same id, text and label one. No labels give a constant score.
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    # Ids are chosen before their texts are joined; the order is by hash, so the sample is random. At most sample_rows
    # ids are broadcast, so no text is shuffled for them.
    chosen = known.orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit("fit")), "doc_id", "quality").limit(sample_rows)
    labelled = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(F.broadcast(chosen), "doc_id")
    # An id may stand in many rows of docs, so the bound holds once more, for rows that differ.
    rows = with_statistics(labelled, ["doc_id", "text_hash", "quality"]).dropDuplicates(["doc_id", "text_hash", "quality"])
    order = [F.xxhash64(F.col("doc_id").cast("string"), "text_hash", F.lit("fit")), "doc_id", "text_hash", "quality"]
    rows = rows.orderBy(*order).limit(sample_rows).toPandas()
    return fit(rows[list(COLUMNS)].to_numpy(np.float64), rows["quality"].to_numpy(np.float64), COLUMNS, **options)


def scored(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of docs.

    Null and empty texts are scored by their (zero) statistics. Repeated rows stay. A null id is
    scored like any other. An empty table gives none. Only doc_id and text are read.
    """
    stats = with_statistics(docs, ["doc_id"])
    return stats.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column().alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def accepted(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """Rows of docs with a score of at least the threshold, all columns.

    Null and empty texts are judged by their (zero) statistics, null ids and other nulls like any row; repeated rows
    stay or go together. Columns may have the names of statistics. An empty table gives none.
    """
    return with_statistics(docs, docs.columns).where(model.column() >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
