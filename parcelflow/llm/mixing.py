"""Mixing sources to target weights: hash-random order, prefix sums, a cut at each budget.

Every row gets a random key from its id. A source's rows are ordered by it; key ranges (buckets)
are summed, the sums are added up per source, and only the one bucket in which a source's budget
ends is looked at row by row. The result of that is one cut per source; whether a row is taken is
then an expression over its key. All of it is DataFrame work, and no source meets in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import log2_ceiling, positions, staged, word_count

#: Weights by rank of the source's name, repeating.
WEIGHTS = (5, 2, 1)
#: No document is taken more often.
MAX_EPOCHS = 3
SEED = "mix"
#: Rows that one bucket holds on average.
BUCKET_ROWS = 50_000
#: One row per source; up to this many (some 10 MB) the cuts are broadcast, else joined by shuffle.
BROADCAST_SOURCES = 100_000


def random_key(doc_id: Column, seed: str = SEED) -> Column:
    """32 hexadecimal digits that only id and seed decide; a null id counts as the empty text."""
    return F.md5(F.encode(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":" + seed)), "UTF-8"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size), null sources last.

    The total is shared by weight; a target stops at `epochs` times its source's size, and what is
    over goes to the others by weight until none is above. That ends where a common level times
    the weight, cut at the limits, adds up to the total: sources are ordered by limit per weight
    and stop as long as the level of the rest is above that. Sources without words get none.
    """
    ranked = positions(
        sizes.withColumn("_last", F.col("source").isNull()).withColumn("_all", F.lit(0)),
        ["_all"], ["_last", "source"], label="mix-ranks",
    )
    weighed = (
        ranked.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.col("position") % len(weights)).cast("int")).cast("long"))
        .withColumn("limit", F.col("source_size") * epochs)
        .withColumn("_order", F.col("limit") / F.col("weight"))
        .drop("position")
    )
    summed = positions(weighed, ["_all"], ["_order", "_last", "source"], ["limit", "weight"], label="mix-limits")
    whole = weighed.agg(F.sum("source_size").alias("_total"), F.sum("weight").alias("_weights"))
    level = (F.col("_total") - F.col("before_limit")) / (F.col("_weights") - F.col("before_weight"))
    leveled = staged(summed.join(F.broadcast(whole)).withColumn("_level", level), "mix-levels")
    free = leveled.where(F.col("_order") > F.col("_level")).agg(
        F.min_by("_level", F.struct("_order", "_last", "source")).alias("_common")
    )
    target = F.when(
        F.col("_common").isNull() | (F.col("_order") <= F.col("_common")), F.col("limit").cast("double")
    ).otherwise(F.col("_common") * F.col("weight"))
    return leveled.join(F.broadcast(free)).select("source", "source_size", "weight", target.alias("target"))


@dataclass(frozen=True)
class Mix:
    """cuts: (source, source_size, weight, target, epochs, cut_key, cut_id, fill_key, fill_id) per source."""

    cuts: DataFrame
    seed: str

    def taken(self, docs: DataFrame, id_col: str, source_col: str) -> DataFrame:
        """docs with the columns of its source's cut and `_copies`, how often a row is taken."""
        cuts = _bounded(self.cuts.select(*[F.col(c).alias(f"_mix_{c}") for c in self.cuts.columns]))
        key, as_text = random_key(F.col(id_col), self.seed), F.col(id_col).cast("string")
        fills = (key == F.col("_mix_fill_key")) & as_text.eqNullSafe(F.col("_mix_fill_id"))
        once = _upto(key, as_text, "_mix_") | F.coalesce(fills, F.lit(False))
        return docs.join(cuts, F.col(source_col).cast("string").eqNullSafe(F.col("_mix_source"))).withColumn(
            "_copies", F.col("_mix_epochs") + once.cast("int")
        )


def plan_mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: str = SEED, epochs: int = MAX_EPOCHS,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> Mix:
    """How often each document is taken so that each source comes near its target.

    A source is taken whole as often as its target allows. Of the rest of the budget, rows are taken
    in key order as long as they fit, then the one row behind them that fills the gap best, if
    that comes nearer. Documents are taken whole. Rows with the same id share a key and are taken
    or left together.
    """
    slim = staged(
        docs.select(
            F.col(id_col).cast("string").alias("id"), F.col(source_col).cast("string").alias("source"),
            word_count(F.col(text_col)).alias("size"), random_key(F.col(id_col), seed).alias("key"),
        ),
        "mix-slim",
    )
    digits = max(1, -(-log2_ceiling(slim.count() // BUCKET_ROWS + 1) // 4)) + 1
    slim = slim.withColumn("bucket", F.substring("key", 1, digits))
    buckets = staged(slim.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    wanted = (
        targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    wanted = staged(wanted, "mix-wanted")
    named = wanted.select(F.col("source").alias("_source"), "budget")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    crossing = (
        buckets.join(named, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .where((F.col("before") < F.col("budget")) & (F.col("budget") <= F.col("before") + F.col("words")))
        .select("_source", F.col("bucket").alias("_bucket"), "before", "budget")
    )
    # Rows of one id are one step of the order, so a repeated id can't be parted.
    rows = (
        slim.join(crossing, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket")))
        .groupBy("source", "key", "id").agg(F.sum("size").alias("size"), F.min("before").alias("before"), F.min("budget").alias("budget"))
    )
    order = Window.partitionBy("source").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)
    steps = rows.withColumn("end", F.col("before") + F.sum("size").over(order)).where(F.col("end") <= F.col("budget"))
    last = steps.groupBy(F.col("source").alias("_in")).agg(F.max(F.struct("key", "id")).alias("last"), F.max("end").alias("end"))
    cut = staged(
        crossing.join(last, F.col("_source").eqNullSafe(F.col("_in")), "left").select(
            "_source", F.coalesce("last.key", "_bucket").alias("cut_key"), F.col("last.id").alias("cut_id"),
            (F.col("budget") - F.coalesce("end", "before")).alias("gap"),
        ),
        "mix-prefixes",
    )
    # The row behind the cut that fills the gap best, if that comes nearer.
    behind = slim.join(_bounded(cut), F.col("source").eqNullSafe(F.col("_source"))).where(~_upto("key", "id"))
    miss = F.abs(F.col("size") - F.col("gap"))
    fill = behind.where(miss < F.col("gap")).groupBy(F.col("source").alias("_in")).agg(
        F.min(F.struct(miss.alias("miss"), "key", "id")).alias("fill")
    )
    by_source = cut.join(fill, F.col("_source").eqNullSafe(F.col("_in")), "left").select(
        F.col("_source").alias("_of"), "cut_key", "cut_id",
        F.col("fill.key").alias("fill_key"), F.col("fill.id").alias("fill_id"),
    )
    cuts = wanted.drop("budget").join(by_source, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of")
    return Mix(staged(cuts, "mix-cuts"), seed)


def _bounded(cuts: DataFrame) -> DataFrame:
    """Broadcast only below a checked number of sources."""
    return F.broadcast(cuts) if cuts.count() <= BROADCAST_SOURCES else cuts


def _upto(key: str | Column, of_id: str | Column, prefix: str = "") -> Column:
    """Is (key, id) at or before the cut? Ids are compared as text, null first."""
    key = F.col(key) if isinstance(key, str) else key
    of_id = F.col(of_id) if isinstance(of_id, str) else of_id
    cut_key, cut_id = F.col(f"{prefix}cut_key"), F.col(f"{prefix}cut_id")
    return F.coalesce((key < cut_key) | ((key == cut_key) & of_id.eqNullSafe(cut_id)), F.lit(False))


def mixture_plan(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for every row; taken counts words with repeats.

    Null or blank texts have size 0 and take nothing. A null source is a source of its own, null
    ids are one id. An empty table gives none.
    """
    id_col, source_col = options.get("id_col", "doc_id"), options.get("source_col", "source")
    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(options.get("text_col", "text"))).alias("size"),
    )
    return plan_mix(docs, **options).taken(slim, "doc_id", "source").select(
        "doc_id", "size", F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
        (F.col("size") * F.col("_copies")).alias("taken"),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: rows of docs, each as often as it is taken; all columns."""
    id_col, source_col = options.get("id_col", "doc_id"), options.get("source_col", "source")
    chosen = plan_mix(docs, **options).taken(docs, id_col, source_col).where("_copies > 0")
    chosen = chosen.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return chosen.select(*[F.col(f"`{c}`") for c in docs.columns])


#: The same mixture in SQL. Sources are ordered and weighed as above; the level is found as there.
ORACLE_SQL = """
WITH slim AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix') AS key
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM slim GROUP BY source),
weighed AS (
  SELECT source, source_size, source_size * 3 AS lim,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3] AS w
  FROM sizes),
leveled AS (
  SELECT *, CAST(lim AS DOUBLE) / w AS ratio,
         (SELECT sum(source_size) FROM sizes) - coalesce(sum(lim) OVER o, 0) AS left_words,
         (SELECT sum(w) FROM weighed) - coalesce(sum(w) OVER o, 0) AS left_w
  FROM weighed
  WINDOW o AS (ORDER BY CAST(lim AS DOUBLE) / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
common AS (
  SELECT CAST(left_words AS DOUBLE) / CAST(left_w AS DOUBLE) AS level FROM leveled
  WHERE ratio > CAST(left_words AS DOUBLE) / CAST(left_w AS DOUBLE)
  ORDER BY ratio, source IS NULL, source LIMIT 1),
wanted AS (
  SELECT source, source_size,
         CASE WHEN (SELECT level FROM common) IS NULL OR ratio <= (SELECT level FROM common)
              THEN CAST(lim AS DOUBLE) ELSE (SELECT level FROM common) * w END AS target
  FROM leveled),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM wanted),
ordered AS (
  SELECT s.doc_id, s.key, s.source, s.size, b.source_size, b.target, b.epochs, b.target - b.epochs * b.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM slim s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source),
gaps AS (
  SELECT *, budget - coalesce(max(upto) FILTER (WHERE upto <= budget) OVER (PARTITION BY source), 0) AS gap FROM ordered),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source, budget > 0 AND upto > budget ORDER BY abs(size - gap), key, doc_id) AS nearest
  FROM gaps)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN budget > 0 AND (upto <= budget OR (nearest = 1 AND abs(size - gap) < gap))
                                  THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranked
"""
