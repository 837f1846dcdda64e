"""Operator 6: n-gram Jaccard join with Bayesian candidate pruning.

Documents with the same words form one class.  Between class representatives, pairs whose
sets of word shingles reach the Jaccard threshold are links.

1. Every document is signed where it is scanned: a digest of its words and folded MinHash
   values of its shingles.  Only digests, ids and signatures move from here on.
2. Bands of the signature are bucket keys.  Buckets of one document are dropped by a count;
   a large bucket is cut into blocks, and each pair of blocks is a task group of its own.
3. In a group, pairs compare their MinHash values step by step; a pair is dropped as soon
   as the posterior probability that its similarity reaches the threshold falls below the
   tolerance.  A pair is looked at only in the first band that it shares, so it is counted
   once.  What is left goes on packed: one row per group, not one per pair.
4. Shingle sets are built for the documents of surviving pairs only and sent to their
   groups, where the exact similarity is computed.  A group returns a row per document
   with its number of links, and a spanning forest of its links.
5. The forests are joined to components by label propagation over written tables.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.kernels import mix, settle, shingle_hashes, slices, word_hashes
from tierflow.sources.scratch import staged

SHINGLE_WORDS = 5
THRESHOLD = 0.8
TOLERANCE = 1e-6
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 16
#: Documents of one bucket that are compared in one task group.
BLOCK = 1024
SLICE_CHARS = 1 << 20

_SEEDS = np.random.default_rng(41).integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)


def shingles(texts: list[str | None], size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of the texts in order, and how many each has (with repetitions)."""
    raw = [_bytes(t) for t in texts]
    return shingle_hashes(*word_hashes(raw), size)


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Folded MinHash values, one row of 16-bit numbers for each text that has shingles."""
    full = counts > 0
    starts = (np.cumsum(counts) - counts)[full]
    out = np.empty((full.sum(), HASHES), np.uint16)
    for i, seed in enumerate(_SEEDS if len(starts) else []):
        least = np.minimum.reduceat((hashes ^ (seed >> np.uint64(7))) * seed >> np.uint64(20), starts)
        out[:, i] = mix(least) >> np.uint64(48)
    return out


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch.pop("text").tolist()
        digests: list[bytes] = []
        found: list[bytes | None] = []
        for i, j in slices([len(t or "") for t in texts], SLICE_CHARS):
            raw = [_bytes(t) for t in texts[i:j]]
            digests += [hashlib.blake2b(b" ".join(t.split()), digest_size=16).digest() for t in raw]
            hashes, counts = shingle_hashes(*word_hashes(raw), SHINGLE_WORDS)
            rows = iter(signatures(hashes, counts))
            found += [next(rows).tobytes() if n else None for n in counts]
        del texts
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"], "text_key": batch["text_key"], "digest": digests, "signature": found}
        )
        settle()


def sign(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text as it is), digest of the words, signature."""
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
        F.col(text).alias("text"),
    )
    return rows.mapInPandas(
        _signed, "doc_id bigint, text_key bigint, digest binary, signature binary"
    )


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """Fewest equal values after each step at which a pair stays.

    With a uniform prior, m equal values of n give a Beta(m + 1, n - m + 1) posterior, and
    P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    found = []
    for n in range(STEP, HASHES + 1, STEP):
        mass, m = 0.0, -1
        while mass < tolerance:
            m += 1
            mass += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        found.append(m)
    return found


def _prune(sig: np.ndarray, a: np.ndarray, b: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) found in ``band`` stay."""
    alive = np.arange(len(a))
    bands = sig.reshape(len(sig), BANDS, ROWS).view(np.uint64)[:, :, 0]
    for earlier in range(BANDS - 1):  # a pair belongs to the first band that it shares
        checked = band[alive] > earlier
        if not checked.any():
            continue
        same = bands[a[alive], earlier] == bands[b[alive], earlier]
        alive = alive[~(checked & same)]
    equal = np.zeros(len(alive), np.int64)
    for step, least in enumerate(least_matches()):
        part = slice(step * STEP, (step + 1) * STEP)
        equal = equal + (sig[a[alive], part] == sig[b[alive], part]).sum(axis=1)
        stay = equal >= least
        alive, equal = alive[stay], equal[stay]
    return alive


def _pairs_in(group: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one block, or of two blocks against each other, in bounded portions."""
    side = group["side"].to_numpy()
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    for start in range(0, len(left), 64):
        rows = left[start : start + 64]
        if len(right):
            yield np.repeat(rows, len(right)), np.tile(right, len(rows))
        else:
            a, b = np.repeat(rows, len(left)), np.tile(left, len(rows))
            yield a[a < b], b[a < b]


CANDIDATES = "part string, band int, a array<bigint>, b array<bigint>"


def _candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Surviving pairs of each group of a partition that is sorted by group."""
    for groups in _whole_groups(batches, "part"):
        sig = np.frombuffer(b"".join(groups["signature"]), np.uint16).reshape(-1, HASHES)
        ids, band = groups["doc"].to_numpy(), groups["band"].to_numpy()
        part = groups["part"].to_numpy()
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sizes = np.diff(np.r_[starts, len(part)])
        out: dict[str, tuple[list, list, int]] = {}
        small = starts[(sizes == 2)]
        portions = [(small, small + 1)] if len(small) else []
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            for a, b in _pairs_in(groups.iloc[start : start + size]):
                portions.append((a + start, b + start))
        for a, b in portions:
            stay = _prune(sig, a, b, band[a])
            for i, j in zip(a[stay], b[stay], strict=True):
                kept = out.setdefault(part[i], ([], [], int(band[i])))
                kept[0].append(ids[i])
                kept[1].append(ids[j])
        if out:
            yield pd.DataFrame(
                {
                    "part": list(out), "band": [k[2] for k in out.values()],
                    "a": [k[0] for k in out.values()], "b": [k[1] for k in out.values()],
                }
            )


def _whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames that end where a group ends, from batches that may not."""
    rest = None
    for batch in batches:
        if not len(batch):
            continue
        both = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        keys = both[key].to_numpy()
        last = int(np.flatnonzero(keys == keys[-1])[0])
        if last:
            yield both.iloc[:last].reset_index(drop=True)
        rest = both.iloc[last:].reset_index(drop=True)
    if rest is not None:
        yield rest


def bucketed(signed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(part, side, band, doc, signature): the task groups of buckets with company.

    A bucket of up to ``block`` documents is one group.  A larger one is cut into blocks by
    a hash of the id; every pair of blocks, and every block alone, is a group.
    """
    band = F.posexplode(
        F.array(*[F.substring("signature", 1 + 8 * i, 8) for i in range(BANDS)])
    ).alias("band", "key")
    keys = signed.select("doc", band)
    counts = keys.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keys.join(counts, ["band", "key"])
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("doc"), F.col("blocks").cast("long")).cast("int")
    placed = shared.withColumn("blocks", blocks).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    parts = placed.select("doc", "band", "key", "own", other).select(
        "doc", "band",
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        F.concat_ws(
            "-", "band", F.hex("key"), F.least("own", "other"), F.greatest("own", "other")
        ).alias("part"),
    )
    return parts.join(signed.select("doc", "signature"), "doc")


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Link counts and forests of groups: rows with pairs and rows with shingle sets."""
    for groups in _whole_groups(batches, "part"):
        docs: list[int] = []
        links: list[int] = []
        roots: list[int] = []
        for _, group in groups.groupby("part", sort=False):
            has_set = group["shingles"].notna()
            sets = {
                d: np.frombuffer(s, np.uint64)
                for d, s in zip(group["doc"][has_set], group["shingles"][has_set], strict=True)
            }
            count: dict[int, int] = {}
            parent: dict[int, int] = {}

            def find(x: int, parent: dict[int, int] = parent) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for a_list, b_list in zip(group["a"][~has_set], group["b"][~has_set], strict=True):
                for a, b in zip(a_list, b_list, strict=True):
                    x, y = sets[a], sets[b]
                    if min(len(x), len(y)) < THRESHOLD * max(len(x), len(y)):
                        continue
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    # exact: both / union >= 4 / 5 without rounding
                    if both * 1000 >= round(THRESHOLD * 1000) * (len(x) + len(y) - both):
                        count[a], count[b] = count.get(a, 0) + 1, count.get(b, 0) + 1
                        low, high = sorted((find(a), find(b)))
                        parent[high] = low
            for d, n in count.items():
                docs.append(d)
                links.append(n)
                roots.append(find(d))
        if docs:
            yield pd.DataFrame({"doc": docs, "n_links": links, "root": roots})


def _shingle_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        sets: list[bytes] = []
        for i, j in slices([len(t or "") for t in texts], SLICE_CHARS):
            hashes, counts = shingles(texts[i:j])
            for own in np.split(hashes, np.cumsum(counts)[:-1]):
                sets.append(np.unique(own).tobytes())
        del texts
        yield pd.DataFrame({"doc": batch["doc"], "shingles": sets})
        settle()


def linked(documents: DataFrame, signed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n_links, root) rows of the class representatives that have a link.

    ``signed`` has one row (doc, doc_id, text_key, signature) for each representative.  A
    document may have a row from each group; counts add up and roots are forest edges.
    """
    spark = documents.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = bucketed(signed).repartition(partitions, "part").sortWithinPartitions("part")
    pairs = staged(grouped.select("part", "side", "band", "doc", "signature").mapInPandas(_candidates, CANDIDATES), "pairs")
    members = pairs.select(
        "part", F.explode(F.array_distinct(F.concat("a", "b"))).alias("doc")
    )
    wanted = members.select("doc").distinct().join(signed.select("doc", "doc_id", "text_key"), "doc")
    texts = documents.select(
        F.col(doc_id).cast("long").alias("_id"), F.xxhash64(text).alias("_key"), F.col(text).alias("text")
    )
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("text_key"))
    found = texts.join(wanted, same).select("doc", "text")
    sets = found.mapInPandas(_shingle_sets, "doc bigint, shingles binary").dropDuplicates(["doc"])
    empty = F.lit(None)  # a row with pairs has doc 0, so that ids stay whole numbers in pandas
    rows = members.join(sets, "doc").select(
        "part", "doc", "shingles", empty.cast("array<bigint>").alias("a"), empty.cast("array<bigint>").alias("b")
    ).unionByName(
        pairs.select("part", F.lit(0).cast("bigint").alias("doc"), empty.cast("binary").alias("shingles"), "a", "b")
    )
    ready = rows.repartition(partitions, "part").sortWithinPartitions("part")
    return ready.mapInPandas(_verified, "doc bigint, n_links bigint, root bigint")


def components(edges: DataFrame) -> DataFrame:
    """(doc, group): the smallest id that each end of an edge (doc, root) is connected to.

    Each round sends the smallest label among neighbours, then follows labels one step
    further; its result is a written table.  Rounds grow with the logarithm of the longest
    chain, and an edge table holds forests only, so it is no larger than the documents.
    """
    both = edges.select("doc", "root").unionByName(
        edges.select(F.col("root").alias("doc"), F.col("doc").alias("root"))
    ).where("doc != root").distinct()
    both = staged(both, "edges")
    labels = staged(
        both.groupBy("doc").agg(F.least(F.min("root"), F.col("doc")).alias("label")), "labels"
    )
    while True:
        near = both.join(labels.withColumnsRenamed({"doc": "root"}), "root").select("doc", "label")
        best = near.unionByName(labels).groupBy("doc").agg(F.min("label").alias("label"))
        jump = best.alias("x").join(
            best.select(F.col("doc").alias("_at"), F.col("label").alias("_label")),
            F.col("label") == F.col("_at"), "left",
        )
        moved = staged(
            jump.select("doc", F.least("label", "_label").alias("label")), "labels"
        )
        changed = moved.join(labels.withColumnsRenamed({"label": "before"}), "doc").where("label != before")
        done = changed.isEmpty()
        labels = moved
        if done:
            return labels.select("doc", F.col("label").alias("group"))


def grouped(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Signed rows of all documents, and the classes with their links and groups.

    The first has doc_id, text_key and digest for each row; the second digest, class_id,
    class_key (its text_key), n_copies, n_links and group_digest.
    """
    signed = staged(sign(documents, doc_id, text), "signed")
    first = F.struct(
        F.coalesce("doc_id", F.lit(-(2**63))).alias("o"), "doc_id", "text_key", "signature"
    )
    classes = signed.groupBy("digest").agg(F.min(first).alias("s"), F.count(F.lit(1)).alias("n_copies"))
    classes = classes.select(
        "digest", F.col("s.doc_id").alias("class_id"), F.col("s.text_key").alias("class_key"),
        F.col("s.signature").alias("signature"), "n_copies",
        # an id of the class that orders like doc_id and is unique without one
        F.xxhash64("digest").alias("doc"),
    )
    classes = staged(classes, "classes")
    reps = classes.where("signature is not null").select(
        "doc", F.col("class_id").alias("doc_id"), F.col("class_key").alias("text_key"), "signature"
    )
    links = staged(linked(documents, reps, doc_id, text), "links")
    n_links = links.groupBy("doc").agg(F.sum("n_links").alias("n_links"))
    groups = components(links)
    found = (
        classes.drop("signature")
        .join(n_links, "doc", "left").join(groups, "doc", "left")
        .withColumn("group", F.coalesce("group", "doc"))
    )
    return signed.drop("signature"), found


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: class_id, n_copies, n_links, group_id.

    class_id is the smallest doc_id with the same words (case apart), n_copies the number
    of rows of the class, n_links the number of other classes at or above the threshold,
    group_id the smallest class_id that links lead to.  NULL and empty texts form one class
    without links; a text of fewer words than a shingle is one shingle; NULL ids sort
    first; repeated rows are copies; an empty table gives an empty result.
    """
    signed, classes = grouped(documents, doc_id, text)
    lead = classes.groupBy("group").agg(
        F.min(F.struct(F.coalesce("class_id", F.lit(-(2**63))), "class_id")).alias("g")
    ).select("group", F.col("g.class_id").alias("group_id"))
    named = classes.join(lead, "group").select(
        "digest", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "group_id"
    )
    return signed.select("doc_id", "digest").join(named, "digest").drop("digest")


def one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document with the smallest id of each group, with all its columns.

    Of repeated rows with the same id and text one stays.
    """
    signed, classes = grouped(documents, doc_id, text)
    order = F.struct(F.coalesce("class_id", F.lit(-(2**63))).alias("o"), "class_id", "class_key")
    kept = classes.groupBy("group").agg(F.min(order).alias("k")).select(
        F.col("k.class_id").alias("_kept_id"), F.col("k.class_key").alias("_kept_key")
    )
    own = (F.col(doc_id).cast("long").eqNullSafe(F.col("_kept_id"))) & (F.xxhash64(text) == F.col("_kept_key"))
    twice = signed.groupBy("doc_id", "text_key").count().where("count > 1").select(
        F.col("doc_id").alias("_kept_id"), F.col("text_key").alias("_kept_key")
    )
    single = documents.join(kept, own, "left_semi").join(twice, own, "left_anti")
    several = documents.join(kept, own, "left_semi").join(twice, own, "left_semi")
    first = F.row_number().over(Window.partitionBy(doc_id, F.xxhash64(text)).orderBy(F.lit(1)))
    one = several.withColumn("_first_of_row", first).where("_first_of_row = 1").drop("_first_of_row")
    return single.unionByName(one)
