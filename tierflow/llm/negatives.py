"""Operator 13: hard negatives by exact integer products of anchor and candidate tiles.

Candidates are dealt into cells and anchors into blocks of bounded size by hash.  Every cell
meets every block in one task, which multiplies their tiles by Strassen's recursion on 64-bit
integers.  A task keeps a heap of the best for each anchor; heaps of all cells are merged by
a ranked window, of which Spark keeps the first few rows on the map side.  Positives come
first, from candidates of the anchor's label; then each positive opens a window of scores,
for which the heaps of the other labels are kept and merged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.common import table
from tierflow.sources.scratch import staged

ANCHORS_EVERY = 100
POSITIVES = NEGATIVES = 5
#: A negative scores at least four fifths of its positive.
SHARE = (4, 5)
#: Rows of one cell of candidates and of one block of anchors.
CELL, BLOCK = 8192, 8192
#: Anchors that are multiplied at once, and the side below which rows are multiplied plainly.
TILE, LEAF = 128, 32
ABSENT = np.iinfo(np.int64).min


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product of 64-bit integers by Strassen's seven products of halves.

    Odd sides get a line of zeros.  Additions are exact (modulo 2**64 beyond 64 bits).
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = product(a11 + a22, b11 + b22)
    p2 = product(a21 + a22, b11)
    p3 = product(a11, b12 - b22)
    p4 = product(a22, b21 - b11)
    p5 = product(a11 + a12, b22)
    p6 = product(a21 - a11, b11 + b12)
    p7 = product(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def best(scores: np.ndarray, ids: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``most`` highest scores of each row, equal ones by smaller id."""
    keep = scores != ABSENT
    n = scores.shape[1]
    if n > most:
        keep &= scores >= np.partition(scores, n - most, axis=1)[:, n - most, None]
    row, col = np.nonzero(keep)
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, row)
    pick = np.arange(len(row)) - first < most
    return row[pick], col[pick]


def _matrix(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, the shorter ones followed by zeros."""
    array = lists.combine_chunks()
    sizes = np.diff(array.offsets.to_numpy())
    flat = array.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _sides(anchors: pa.Table, cands: pa.Table) -> tuple[dict, dict]:
    """Columns of both sides as arrays, in order of labels."""
    width = max([1, *(int(np.diff(t["vec"].combine_chunks().offsets.to_numpy()).max(initial=0)) for t in (anchors, cands))])
    sides = []
    for t in (anchors, cands):
        t = t.sort_by([("label", "ascending"), ("vec_id", "ascending")])
        side = {c: t[c].to_numpy() for c in ("vec_id", "label")} | {"vec": _matrix(t["vec"], width)}
        sides.append(side | {c: t[c].combine_chunks() for c in ("anchor", "positives") if c in t.column_names})
    return sides[0], sides[1]


def _positives(anchors: pa.Table, cands: pa.Table) -> pa.Table:
    """The heap of positives of each anchor over one cell."""
    parts = []
    if anchors.num_rows and cands.num_rows:
        a, c = _sides(anchors, cands)
        for i in range(0, len(a["label"]), TILE):
            own = slice(i, i + TILE)
            label = a["label"][own]
            span = slice(np.searchsorted(c["label"], label[0]), np.searchsorted(c["label"], label[-1], "right"))
            ids = c["vec_id"][span]
            if not len(ids):
                continue
            scores = product(a["vec"][own], c["vec"][span].T)
            other = (c["label"][span] != label[:, None]) | (ids == a["vec_id"][own, None])
            scores[other] = ABSENT
            row, col = best(scores, ids, POSITIVES)
            parts.append((np.asarray(a["anchor"])[own][row], scores[row, col], ids[col]))
    return _rows(parts, ["anchor", "score", "id"])


def _rows(parts: list[tuple], names: list[str]) -> pa.Table:
    columns = [np.concatenate([p[k] for p in parts] or [np.empty(0, np.int64)]) for k in range(len(names))]
    return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(names, columns, strict=True)})


def _negatives(anchors: pa.Table, cands: pa.Table) -> pa.Table:
    """The heap of negatives of each anchor and positive over one cell."""
    parts = []
    if anchors.num_rows and cands.num_rows:
        a, c = _sides(anchors, cands)
        numbers, ids = np.asarray(a["anchor"]), c["vec_id"]
        found = a["positives"].to_pylist()
        for i in range(0, len(numbers), TILE):
            own = slice(i, i + TILE)
            scores = product(a["vec"][own], c["vec"].T)
            out = (c["label"] == a["label"][own, None]) | (ids == a["vec_id"][own, None])
            for k in range(POSITIVES):
                rows = np.array([r for r, p in enumerate(found[own]) if len(p) > k], np.int64)
                if not len(rows):
                    break
                pos = [found[i + r][k] for r in rows]
                high = np.array([p["score"] for p in pos], np.int64)
                low = high - high // SHARE[1] * (SHARE[1] - SHARE[0])  # share of it, rounded up
                s = scores[rows]
                s = np.where(out[rows] | (s > high[:, None]) | (s < low[:, None]), ABSENT, s)
                row, col = best(s, ids, NEGATIVES)
                pos_id = np.array([p["id"] for p in pos], np.int64)
                parts.append((numbers[own][rows][row], pos_id[row], high[row], s[row, col], ids[col]))
    return _rows(parts, ["anchor", "positive_id", "positive_score", "score", "id"])


def quantised(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Distinct (vec_id, label, vec) of the rows that take part."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    i, own = F.col(vec_id).cast("long"), F.col(label).cast("long")
    return (
        embeddings.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
        .select(
            i.alias("vec_id"), F.when(i % 7 == 0, (own + 1) % 10).otherwise(own).alias("label"),
            F.transform(vector, lambda x: F.floor(x.cast("double") * 256)).alias("vec"),
        )
        .distinct()
    )


def _merged(heaps: DataFrame, keys: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _cells(rows: DataFrame, number: Column, others: int, most: int, inner: bool) -> DataFrame:
    """Rows with the key of each pair of a cell and a block that they belong to."""
    own, other = F.pmod(number, F.lit(most)), F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
    dealt = rows.withColumns({"_own": own}).withColumn("_other", other)
    pair = F.col("_own") * others + F.col("_other") if inner else F.col("_other") * most + F.col("_own")
    return dealt.withColumn("pair", pair.cast("long")).drop("_own", "_other")


def mined(
    embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", *,
    cell: int = CELL, block: int = BLOCK,
) -> DataFrame:
    """The first negatives of each anchor and positive.

    Rows with a NULL id, label or vector, or a NULL or non-finite component, take no part.
    Identical rows count once; rows with an id in common but other vectors or labels are rows
    of their own, but none with the anchor's id is its positive or negative.  Shorter vectors
    are followed by zeros, so an empty one scores 0.  Scores beyond 64 bits wrap around.  An
    empty table gives an empty result; other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = staged(quantised(embeddings, vec_id, vector, label), "vectors")
    anchor = F.col("vec_id") % ANCHORS_EVERY == 0
    n = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if(anchor).alias("anchors")).first()
    cells = max(-(-n["all"] // cell), int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = max(1, -(-n["anchors"] // block))
    anchors = staged(rows.where(anchor).withColumn("anchor", F.monotonically_increasing_id()), "anchors")

    cands = _cells(rows, F.xxhash64("vec_id", "vec"), blocks, cells, True)

    def met(own: DataFrame, heap, schema: str) -> DataFrame:
        dealt = _cells(own, F.xxhash64("anchor"), cells, blocks, False)
        return dealt.groupBy("pair").cogroup(cands.groupBy("pair")).applyInArrow(heap, schema)

    heaps = met(anchors, _positives, "anchor long, score long, id long")
    positives = _merged(heaps, ["anchor"], POSITIVES).groupBy("anchor").agg(
        F.collect_list(F.struct("score", "id")).alias("positives")
    )
    asked = staged(anchors.join(positives, "anchor"), "positives")
    heaps = met(
        asked, _negatives, "anchor long, positive_id long, positive_score long, score long, id long"
    )
    found = _merged(heaps, ["anchor", "positive_id", "positive_score"], NEGATIVES)
    return found.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined(table(spark, sf_dir, "embeddings"))


ORACLE = f"""
with r as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
 ),
 s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.v, c.v)::bigint as score
  from r a join r c on a.vec_id <> c.vec_id where a.vec_id % {ANCHORS_EVERY} = 0
 ),
 p as (
  select * from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES}
 )
select p.anchor_id, p.vec_id as positive_id,
  row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id)::int as rank,
  s.vec_id as negative_id, p.score as positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and not s.same
  and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score
qualify rank <= {NEGATIVES}
"""
