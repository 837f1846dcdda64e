"""Operator 11: ranked search in an index whose terms belong to successive owner stages.

The documents are tokenised once; of each, the terms that some item may hold are kept (a bit
table of fixed size tells, and an exact join settles it).  Terms belong to ``OWNERS`` stages,
rare ones first, each with about the same number of postings.  A bundle holds, for an item
and a shard of documents, the item's terms and the scores that documents have so far.  It
meets the postings of one owner after the other in a cogroup; every owner adds its integer
contributions and hands the bundle on.  The last one selects the best documents of the
shard, and a ranked window selects among the shards.

A document leaves a bundle only when it cannot win: if its score and the most that all
later owners can add stay below the score that enough documents of the shard have already.
Shards are bounded, so no bundle grows with the corpus, and a frequent term is spread over
all of them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.llm.common import table
from tierflow.sources.scratch import staged

RESULTS = 10
OWNERS = 3
#: Documents of one shard, and items whose bundles meet a shard together.
SHARD, TOGETHER = 2048, 256
#: Entries of the bit table of terms; it takes as many bytes.
BITS = 1 << 20
#: No document scores more than this for one unit of a term's weight.
MOST = 1_000_000
#: Fixed value: bytes of a term stand for themselves, A-Z in lower case, all others for a space.
_BYTES = bytes(
    i + 32 if 0x41 <= i <= 0x5A else 0x20 if i < 0x30 or 0x3A <= i <= 0x40 or 0x5B <= i <= 0x60 or 0x7B <= i <= 0x7F else i
    for i in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """All terms of a text in order.  No byte of a longer UTF-8 sequence is a separator."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


def _bit(term: bytes) -> int:
    return zlib.crc32(term) & (BITS - 1)


def _listed(lists: list[list], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, lists)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array([x for own in lists for x in own], kind))


def _counted(batches: Iterator[pa.RecordBatch], wanted: bytes | None) -> Iterator[pa.RecordBatch]:
    """Each text's number of terms, and its distinct (wanted) terms with their occurrences."""
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            sizes, names, times = [], [], []
            for text in part["text"].to_pylist():
                own = terms(text)
                counts = Counter(own)
                kept = [(t, n) for t, n in counts.items() if wanted is None or wanted[_bit(t)]]
                sizes.append(len(own))
                names.append([t.decode("utf-8", "replace") for t, _ in kept])
                times.append([n for _, n in kept])
            yield pa.RecordBatch.from_arrays(
                [part["row"], part["id"], pa.array(sizes, pa.int64()), _listed(names, pa.string()), _listed(times, pa.int64())],
                names=["row", "id", "n", "terms", "times"],
            )


def _tokenised(rows: DataFrame, wanted=None) -> DataFrame:
    def run(batches):
        return _counted(batches, wanted.value if wanted else None)

    return rows.mapInArrow(run, "row long, id long, n long, terms array<string>, times array<long>")


def _pairs(index: DataFrame) -> DataFrame:
    return index.select("row", "id", "n", F.explode(F.arrays_zip("terms", "times")).alias("_t")).select(
        "row", "id", "n", F.col("_t.terms").alias("term"), F.col("_t.times").alias("tf")
    )


BUNDLE = (
    "cell long, item long, owners array<int>, numbers array<long>, weights array<long>, "
    "slots array<int>, scores array<long>, rows array<long>, ids array<long>"
)


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    array = column.combine_chunks()
    flat, ends = array.flatten().to_numpy(zero_copy_only=False), array.offsets.to_numpy() - array.offsets[0].as_py()
    return [flat[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]


def _survivors(scores: np.ndarray, later: int, most: int) -> np.ndarray:
    """Places of the scores that may still be among the highest."""
    if len(scores) <= most:
        return np.arange(len(scores))
    bar = np.partition(scores, len(scores) - most)[len(scores) - most]
    return np.flatnonzero(scores + later >= bar)


class _Owner:
    """One stage: adds what its terms contribute to every bundle of a shard."""

    def __init__(self, stage: int, last: bool, most: int):
        self.stage, self.last, self.most = stage, last, most

    def __call__(self, bundles: pa.Table, postings: pa.Table) -> pa.Table:
        item = bundles["item"].to_pylist()
        rows, ids = _lists(bundles["rows"]), _lists(bundles["ids"])
        roster = next((k for k, i in enumerate(item) if i is None), None)
        if roster is None:  # no document of this shard has a term
            return self._out([], [])
        number = postings["number"].to_numpy()
        order = np.argsort(number, kind="stable")
        number = number[order]
        slot = np.searchsorted(rows[roster], postings["row"].to_numpy()[order])
        gain = postings["gain"].to_numpy()[order]
        owners, numbers, weights = (_lists(bundles[c]) for c in ("owners", "numbers", "weights"))
        slots, scores = _lists(bundles["slots"]), _lists(bundles["scores"])
        total = np.zeros(len(rows[roster]), np.int64)
        kept: list[int] = [] if self.last else [roster]
        found: list[tuple] = [] if self.last else [(slots[roster], scores[roster])]
        for k, i in enumerate(item):
            if i is None:
                continue
            own = owners[k] == self.stage
            starts = np.searchsorted(number, numbers[k][own])
            ends = np.searchsorted(number, numbers[k][own], "right")
            total[slots[k]] = scores[k]
            touched = [slots[k]]
            for w, s, e in zip(weights[k][own], starts, ends, strict=True):
                if s < e:
                    total[slot[s:e]] += w * gain[s:e]  # a document has one posting of a term
                    touched.append(slot[s:e])
            some = np.unique(np.concatenate(touched)).astype(np.int32)
            some = some[total[some] > 0]
            later = int(weights[k][owners[k] > self.stage].sum()) * MOST
            stay = some[_survivors(total[some], later, self.most)]
            if self.last:
                stay = stay[np.lexsort((ids[roster][stay], -total[stay]))][: self.most]
            kept.append(k)
            found.append((stay, total[stay]))
            for t in touched:
                total[t] = 0
        if self.last:
            return self._out(
                [np.full(len(s), item[k]) for k, (s, _) in zip(kept, found, strict=True)], found, ids[roster]
            )
        out = bundles.take(kept)
        for name, at, kind in (("slots", 0, pa.int32()), ("scores", 1, pa.int64())):
            flat = np.concatenate([f[at] for f in found])
            ends = np.cumsum([0, *(len(f[at]) for f in found)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))
            out = out.set_column(out.column_names.index(name), name, lists)
        return out

    def _out(self, items: list, found: list, ids: np.ndarray | None = None) -> pa.Table:
        if not self.last:
            names = [c.split()[0] for c in BUNDLE.split(", ")]
            return pa.table({n: pa.array([], pa.int64() if n in ("cell", "item") else pa.list_(pa.int32() if n in ("owners", "slots") else pa.int64())) for n in names})
        empty = np.empty(0, np.int64)
        return pa.table(
            {
                "item": pa.array(np.concatenate([empty, *items]).astype(np.int64)),
                "doc_id": pa.array(np.concatenate([empty, *(ids[s] for s, _ in found)]).astype(np.int64)),
                "score": pa.array(np.concatenate([empty, *(v for _, v in found)]).astype(np.int64)),
            }
        )


def _gain(tf: Column, n: Column, docs: int, length: int) -> Column:
    """What one unit of weight adds to the score of a document of ``n`` terms."""
    m = F.lit(25).cast("long") + F.call_function("div", n * 75 * docs, F.lit(length).cast("long"))
    return F.call_function("div", tf * 1_000_000_000, tf * 1000 + m * 8)


def searched(
    documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", *, results: int = RESULTS, shard: int = SHARD,
    together: int = TOGETHER, owners: int = OWNERS,
) -> DataFrame:
    """The best documents for each item by weighted, saturated term counts.

    NULL and empty texts have no terms.  Every row of ``documents`` is a document; one with a
    NULL id counts in all statistics but is not named in a result.  Repeated rows of an item
    count once; other texts of the same item id are ranked on their own.  Empty tables give
    an empty result; other columns are not read.
    """
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = staged(
        items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).distinct()
        .withColumn("row", F.monotonically_increasing_id()),
        "items",
    )
    wanted_terms = staged(_pairs(_tokenised(asked)), "item-terms")
    marks = wanted_terms.select((F.crc32(F.col("term").cast("binary")) % BITS).cast("int").alias("b")).distinct()
    bits = bytearray(BITS)
    for r in marks.toLocalIterator():  # at most BITS numbers
        bits[r["b"]] = 1
    wanted = spark.sparkContext.broadcast(bytes(bits))

    numbered = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")
    )
    index = staged(_tokenised(numbered, wanted), "index")
    size = index.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("length"), F.count_if(F.col("id").isNotNull()).alias("rows")).first()
    docs, length = size["docs"], size["length"] or 1

    vocabulary = wanted_terms.select("term").distinct()
    counted = staged(
        _pairs(index).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        .join(vocabulary, "term", "left_semi")
        .withColumn("number", F.monotonically_increasing_id()),
        "terms",
    )
    # Rare terms first; equal shares of all postings for each owner.
    shares = [(i + 1) / owners for i in range(owners - 1)]
    cuts = counted.agg(F.percentile("df", shares, F.col("df")).alias("c")).first()["c"] if shares else []
    owner = F.lit(0)
    for cut in cuts or []:
        owner = owner + (F.col("df") > cut).cast("int")
    weight = F.floor(F.log((F.lit(2.0 * docs) + 2) / (F.col("df") * 2.0 + 1)) * 1000).cast("long")
    owned = staged(counted.select("term", "number", owner.alias("owner"), weight.alias("weight")), "owned")

    shards = max(-(-size["rows"] // shard), 2 * partitions)
    many = asked.count()
    groups = max(1, -(-many // together))
    group_of = F.pmod(F.xxhash64("row"), F.lit(groups))
    asked_terms = wanted_terms.select("row", "term", "tf").join(owned, "term").withColumn("group", group_of)
    # A posting goes to the groups of items that hold its term.
    wanting = staged(asked_terms.select("term", "number", "owner", "group").distinct(), "wanting")
    cell = F.col("group") * shards + F.pmod(F.xxhash64("doc"), F.lit(shards))

    def postings(stage: int) -> DataFrame:
        found = _pairs(index).where(F.col("id").isNotNull()).withColumnRenamed("row", "doc")
        return found.join(wanting.where(F.col("owner") == stage), "term").select(
            cell.alias("cell"), "number", F.col("doc").alias("row"),
            _gain(F.col("tf"), F.col("n"), docs, length).alias("gain"),
        )

    none, no_slots = F.array().cast("array<long>"), F.array().cast("array<int>")
    queries = asked_terms.groupBy("row", "group").agg(
        F.collect_list(F.struct("owner", "number", (F.col("weight") * F.col("tf")).alias("w"))).alias("q")
    )
    bundles = queries.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_s")).select(
        (F.col("group") * shards + F.col("_s")).cast("long").alias("cell"), F.col("row").alias("item"),
        F.col("q.owner").alias("owners"), F.col("q.number").alias("numbers"), F.col("q.w").alias("weights"),
        no_slots.alias("slots"), none.alias("scores"), none.alias("rows"), none.alias("ids"),
    )
    # The documents of a shard travel with its bundles, in order of their row numbers.
    rosters = (
        index.where(F.col("id").isNotNull() & (F.size("terms") > 0))
        .groupBy(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("_s"))
        .agg(F.array_sort(F.collect_list(F.struct("row", "id"))).alias("r"))
        .select("r", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "_s")
        .select(
            (F.col("group") * shards + F.col("_s")).cast("long").alias("cell"), F.lit(None).cast("long").alias("item"),
            no_slots.alias("owners"), none.alias("numbers"), none.alias("weights"), no_slots.alias("slots"), none.alias("scores"),
            F.col("r.row").alias("rows"), F.col("r.id").alias("ids"),
        )
    )
    travelling = bundles.unionByName(rosters)
    for stage in range(owners):
        last = stage == owners - 1
        travelling = travelling.groupBy("cell").cogroup(postings(stage).groupBy("cell")).applyInArrow(
            _applied(_Owner(stage, last, results)), "item long, doc_id long, score long" if last else BUNDLE
        )
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    ranked = travelling.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= results)
    return ranked.join(asked.select(F.col("row").alias("item"), F.col("id").alias("item_id")), "item").select(
        "item_id", "rank", "doc_id", "score"
    )


def _applied(owner: _Owner):
    def add(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        return owner(bundles, postings)

    return add


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return searched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = rf"""
with d as (
  select row_number() over () as row, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') as ts
  from documents
 ),
 t as (select row, doc_id, len(ts) as n, unnest(ts) as term from d where len(ts) > 0),
 c as (select row, doc_id, n, term, count(*) as tf from t group by row, doc_id, n, term),
 z as (select count(*) as docs, sum(len(ts))::bigint as total from d where len(ts) > 0),
 w as (
  select term, floor(1000 * ln((2.0::double * docs + 2) / (2.0::double * count(*) + 1)))::bigint as w
  from c, z group by term, docs
 ),
 q as (
  select item_id, text, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) as term
  from (select distinct item_id, text from benchmark)
 ),
 s as (
  select item_id, text, row, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::bigint as score
  from q join c using (term) join w using (term), z
  where doc_id is not null group by item_id, text, row, doc_id
 )
select item_id, row_number() over (partition by item_id, text order by score desc, doc_id)::int as rank, doc_id, score
from s where score > 0
qualify rank <= {RESULTS}
"""
