"""What each filter removes in every order of a chain of filters.

A document is a mask: which filters it fails. In an order, it is removed at the first
place that holds a filter it fails: the min-plus product of masks (0 where it fails,
infinity elsewhere) and the inverse permutations of the orders (each filter's place).
Documents of a part with equal masks and labels are counted together in Spark first,
so that a part has at most 2^filters rows; the removal steps of these drive the counts
of every order and step. Parts are dealt out, a part's table is its own task's work.

Rows: a null text is empty, a null source is the part ''. Repeated rows are documents
of their own. A row without an id has no labels, is not a copy of any row and no
row is one of it. Several label rows of an id: 1 if one of them says 1. An empty
table gives no rows. Texts of any length are looked at whole, once, in Spark's own
functions; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = r"[#$%&*|]"
LEAST_WORDS = 200
SPREAD = 4096  # keys that rows without an id are dealt to


def text_failures(text: Column) -> dict[str, Column]:
    """By letter, whether a text fails the filters that look at it alone.

    A: under 200 words. B: under half of its words are distinct. C: over 2 % of its
    characters are A-Z. D: it holds one of ``#$%&*|``.
    """
    words = F.array_remove(F.split(text, SPACES), "")
    n = F.size(words)
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": n < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * n,
        "C": 100 * upper > 2 * F.length(text),
        "D": text.rlike(MARKS),
    }


def _bits(failures: Sequence[Column]) -> Column:
    bits = [F.when(failed, 1 << k).otherwise(0) for k, failed in enumerate(failures)]
    return sum(bits[1:], bits[0])


def document_masks(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and mask, and how many of them are labelled good or toxic.

    Bit k of ``mask`` says that filter ABCDE[k] is failed; E: the text is that of a row with a smaller id.
    Texts meet as digests. Equal rows are counted together before each shuffle, so neither copies nor an
    id that many rows share make a large group; rows without an id are dealt by their text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        _bits(list(text_failures(text).values())).alias("mask"),
    ).withColumn("spread", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SPREAD))).otherwise(0))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    ).withColumn("spread", F.lit(0).cast("long"))
    same = rows.groupBy("id", "spread", "digest", "part", "mask").agg(F.count("*").alias("n"))
    labelled = same.join(marks, ["id", "spread"], "left").fillna(0, ["good", "toxic"])
    # Rows of one text, part and labels: how many, how many without an id, the smallest id, and how many have that id.
    texts = labelled.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min("id").alias("first"),
        F.min_by("n", "id").alias("n_first"),
    )
    # A text has at most a row here for each part and label.
    smallest = F.min("first").over(Window.partitionBy("digest"))
    placed = texts.withColumn("smallest", smallest)
    originals = F.col("unnamed") + F.when(F.col("first") == F.col("smallest"), F.col("n_first")).otherwise(0)
    copy_bit = 1 << 4
    both = F.array(
        F.struct(F.col("mask"), originals.alias("n")),
        F.struct((F.col("mask") + copy_bit).alias("mask"), (F.col("n") - originals).alias("n")),
    )
    counted = placed.select("part", "good", "toxic", F.inline(both)).where("n > 0")
    return counted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def places_of(orders: np.ndarray) -> np.ndarray:
    """Inverse permutations: of each order (a row of filter numbers), every filter's place from 1."""
    places = np.empty_like(orders)
    np.put_along_axis(places, orders, np.arange(1, orders.shape[1] + 1)[None, :], 1)
    return places


def removal_steps(masks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product: of each mask (a row of booleans) and order, the first place with a failed filter; one over the last if none."""
    kept = places.shape[1] + 1
    return np.where(masks[:, None, :], places[None, :, :], kept).min(2)


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit_part(masks: np.ndarray, weights: np.ndarray, orders: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of :data:`COUNTS`, each by order and step. ``weights``: documents, good and toxic ones by mask."""
    n_masks, n_filters = masks.shape
    n_orders = len(orders)
    places = places_of(orders)
    steps = removal_steps(masks, places)
    cells = (np.arange(n_orders)[None, :] * (n_filters + 1) + steps - 1).ravel()

    def scattered(weight: np.ndarray) -> np.ndarray:
        out = np.zeros(n_orders * (n_filters + 1), np.int64)
        np.add.at(out, cells, np.repeat(weight, n_orders))
        return out.reshape(n_orders, n_filters + 1)[:, :n_filters]

    n, good, toxic = weights.T
    removed = scattered(n)
    failing = (masks * n[:, None]).sum(0)
    alone = (masks * (n * (masks.sum(1) == 1))[:, None]).sum(0)
    by_filter = np.take_along_axis(removed, places - 1, 1)  # of each order, what each filter removes
    return {
        "kept": n.sum() - removed.cumsum(1),
        "removed": removed,
        "redundant": failing[orders] - removed,
        "unique_fails": alone[orders],
        "good_lost": scattered(good),
        "toxic_lost": scattered(toxic),
        "shapley": by_filter.sum(0)[orders],
    }


def audit(masks: DataFrame, filters: Sequence[str] = "ABCDE") -> DataFrame:
    """A row for each part, order of the filters and step, from the rows of :func:`document_masks`.

    ``masks`` has one row for each part and mask, so a part gathers at most 2^filters rows.
    """
    names = list(filters)
    orders = np.array(list(permutations(range(len(names)))), np.int64)
    spelled = ["".join(names[f] for f in order) for order in orders]
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_names = pa.array(np.repeat(spelled, len(names)))
        step_numbers = pa.array(np.tile(np.arange(1, len(names) + 1), len(orders)), pa.int32())
        for batch in batches:
            for part, rows in zip(batch.column("part").to_pylist(), batch.column("rows").to_pylist(), strict=True):
                failed = np.array([[row["mask"] >> k & 1 for k in range(len(names))] for row in rows], bool)
                weights = np.array([[row["n"], row["good"], row["toxic"]] for row in rows], np.int64)
                found = audit_part(failed, weights, orders)
                columns = [pa.array([part] * len(order_names), pa.string()), order_names, step_numbers]
                columns += [pa.array(found[c].ravel(), pa.int64()) for c in COUNTS]
                yield pa.RecordBatch.from_arrays(columns, ["part", "filter_order", "step", *COUNTS])

    gathered = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("rows"))
    return gathered.mapInArrow(run, schema)


#: The rows of ``audit(document_masks(documents, labels))`` in SQL, each filter, order and removal by its definition.
AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
failing AS (
  SELECT t.part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false) AS e,
         coalesce((SELECT max(quality = 1) FROM labels l WHERE l.doc_id = t.doc_id), false) AS good,
         coalesce((SELECT max(toxic = 1) FROM labels l WHERE l.doc_id = t.doc_id), false) AS toxic
  FROM texts t),
grouped AS (
  SELECT part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails,
         CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS n_failed,
         count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT p.f || q.f || r.f || s.f || t.f AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS f, string_split(filter_order[1:step - 1], '') AS earlier
  FROM orders, range(1, 6) s(step)),
marked AS (
  SELECT part, filter_order, step, f, n, n_good, n_toxic, n_failed, fails[f] AS fails_here,
         len(list_filter(earlier, lambda x: x <> '' AND fails[x])) > 0 AS gone
  FROM grouped, steps),
counted AS (
  SELECT part, filter_order, step, f,
         CAST(sum(CASE WHEN NOT gone AND NOT fails_here THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN NOT gone AND fails_here THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN gone AND fails_here THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN fails_here AND n_failed = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN NOT gone AND fails_here THEN n_good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN NOT gone AND fails_here THEN n_toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM marked GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
