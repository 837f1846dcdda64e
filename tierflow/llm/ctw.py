"""Operator 9: context-tree weighting over bytes, learned from all training documents.

A text is read as its words, ASCII letters lowered, with one space between them and an end
byte.  Each byte is eight binary decisions; a node of the tree is a context of up to
``DEPTH`` bytes, newest first, and the bits of the byte so far.  The training counts of a
node give its Krichevsky-Trofimov block probability in closed form, and the weighted
probability mixes it with the product of its children:
P_w = (P_e + prod P_w(child)) / 2, and P_w = P_e at full depth.  To predict, the estimates
of all depths are mixed with the weights that follow from those probabilities.

1. Rows get an id and are written once; all passes read them.  One pass counts, in all
   training documents, the byte (``DEPTH`` + 1)-grams and the words
   (by 64-bit hash).  Grams of held-out documents are listed with count 0.
2. Grams are grouped by a hash of their two newest bytes; a group computes its subtrees.  The
   nodes above (at most 256 x 255 + 255, whatever the corpus) are summed up and broadcast.
3. A second run over the groups gives log10 P(byte | context) for every gram.
4. The documents are scored by blocks of bounded size of the gram values: a block is sent out,
   one pass adds up what it holds and writes it, and the block is released before the next.
   A block is two sorted arrays; a pass sorts the grams of many texts and looks each up once.
   Only the first pass counts words: the most frequent ones come from a broadcast of bounded
   size, all others by a join.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.kernels import Lookup, settle, slices, word_hashes
from tierflow.sources.scratch import staged

DEPTH = 5
HELD_OUT = (7, 2)
GROUPS = 256
#: Entries of one broadcast block of gram values (16 bytes each), and of the broadcast of frequent words.
BLOCK_GRAMS = 2_000_000
HEAD_WORDS = 65_536
#: Bits that a gram's key leaves free, for the number of its text.
TEXT_BITS = 64 - 8 * (DEPTH + 1)
#: Characters of text whose grams are counted or looked up at once, and counts that a task holds back.
COUNT_CHARS, FIND_CHARS = 1 << 20, 1 << 19
PENDING = 1_000_000
END = b"\x00"


def canonical(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def is_held_out(doc_id) -> bool:
    """crc32 of the id as text; a missing id is a training row, as its remainder counts as 0."""
    modulus, held = HELD_OUT
    return not pd.isna(doc_id) and zlib.crc32(str(int(doc_id)).encode()) % modulus == held


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all positions of the texts and their ends, and the positions of each text.

    A key holds the context, newest byte first, then the byte itself.
    """
    pad = bytes(DEPTH)
    buf = np.frombuffer(b"".join(x for t in texts for x in (pad, t, END)) + bytes(8), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    n = len(buf) - 8 - DEPTH
    window = np.ndarray(n, "<u8", buf, strides=(1,))  # eight bytes from every byte, oldest lowest
    keys = window & np.uint64((1 << 8 * DEPTH) - 1)
    keys <<= np.uint64(8)
    keys |= buf[DEPTH : DEPTH + n]
    keep = np.ones(n, bool)
    ends = np.cumsum(sizes + DEPTH)[:-1] - DEPTH  # the next bytes to predict are the next text's padding
    keep[(ends[:, None] + np.arange(DEPTH)).ravel()] = False
    return keys[keep], sizes


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins; sorted keys."""
    return np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])


def gram_sums(texts: list[bytes], table: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the values of each text's grams, and the positions of each text.

    ``table`` has sorted keys; grams that it lacks count 0.  A text's number, of ``TEXT_BITS``
    at most, goes below its keys, so that one sort in place serves all texts.
    """
    own, sizes = grams(texts)
    if TEXT_BITS:
        own <<= np.uint64(TEXT_BITS)
        own |= np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
    own.sort()
    whose = (own & np.uint64((1 << TEXT_BITS) - 1)).astype(np.int64)
    own >>= np.uint64(TEXT_BITS)
    at = _firsts(own)
    times = np.diff(np.r_[at, len(own)])
    own = own[at]
    slot = np.searchsorted(table, own)
    hit = slot < len(table)
    hit[hit] = table[slot[hit]] == own[hit]
    found = np.zeros(len(own))
    found[hit] = values[slot[hit]]
    return np.bincount(whose, np.repeat(found, times), len(texts)), sizes


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")  # merges the parts, which are sorted
    keys = keys[order]
    at = _firsts(keys)
    return keys[at], np.add.reduceat(np.concatenate([n for _, n in parts])[order], at)


class _Counts:
    """Counts by key that are handed on when they become many."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, keys: np.ndarray, weight: int) -> None:
        unique, n = np.unique(keys, return_counts=True)
        self.parts.append((unique, n * weight))
        self.size += len(unique)

    def rows(self, most: int) -> Iterator[pd.DataFrame]:
        if self.size <= most or not self.parts:
            return
        keys, n = _merged(self.parts)
        self.parts, self.size = [(keys, n)], len(keys)
        if self.size > most // 2:
            yield pd.DataFrame({"kind": self.kind, "key": keys.view(np.int64), "n": n})
            self.parts, self.size = [], 0


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    by_kind = _Counts(0), _Counts(1)
    ends = 0
    for batch in batches:
        texts = batch.pop("text").tolist()
        held = np.array([is_held_out(d) for d in batch["doc_id"]], bool)
        for i, j in slices([len(t or "") for t in texts], COUNT_CHARS):
            for weight in (0, 1):
                own = [canonical(t) for t, h in zip(texts[i:j], held[i:j], strict=True) if h != bool(weight)]
                if own:
                    by_kind[0].add(grams(own)[0], weight)
                    if weight:
                        by_kind[1].add(word_hashes(own)[0], 1)
                        ends += len(own)
            for counts in by_kind:
                yield from counts.rows(PENDING)
    for counts in by_kind:
        yield from counts.rows(0)
    if ends:
        yield pd.DataFrame({"kind": [2], "key": [0], "n": [ends]})
    del by_kind
    settle()


def _kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of blocks with these counts."""
    return _lgamma(n0 + 0.5) + _lgamma(n1 + 0.5) - _lgamma(n0 + n1 + 1) - np.log(np.pi)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma for x >= 0.5: Stirling's series after eight steps up."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def _tree(keys: np.ndarray, n: np.ndarray, bit: int, shallow: int) -> dict[int, tuple]:
    """Nodes of one bit of the byte, from full depth up to ``shallow``.

    By depth: node keys, the node of each gram, counts of both bits, log P_e, log of the
    product of the children, log P_w.
    """
    symbol = (keys & np.uint64(255)).astype(np.int64)
    prefix = (1 << bit) | (symbol >> (8 - bit))
    one = (symbol >> (7 - bit)) & 1
    found: dict[int, tuple] = {}
    below = None
    for depth in range(DEPTH, shallow - 1, -1):
        context = (keys >> np.uint64(8 * (DEPTH - depth + 1))).astype(np.int64)
        nodes, first, own = np.unique(context << 8 | prefix, return_index=True, return_inverse=True)
        n1 = np.bincount(own, n * one, len(nodes))
        n0 = np.bincount(own, n * (1 - one), len(nodes))
        log_e = _kt(n0, n1)
        if below is None:
            children, log_w = log_e, log_e
        else:
            children = np.bincount(own[below[0]], below[1], len(nodes))
            log_w = np.logaddexp(log_e, children) - np.log(2)
        found[depth] = nodes, own, n0, n1, log_e, children, log_w
        below = first, log_w
    return found


def _roots(group: pd.DataFrame) -> pd.DataFrame:
    """Nodes at depth 2, summed up by newest byte and prefix."""
    keys, n = _sorted(group)
    out = []
    for bit in range(8):
        nodes, _, n0, n1, _, _, log_w = _tree(keys, n, bit, 2)[2]
        out.append(pd.DataFrame({"byte": nodes >> 16, "prefix": nodes & 255, "n0": n0, "n1": n1, "log_w": log_w}))
    return pd.concat(out).groupby(["byte", "prefix"], as_index=False).sum()


def _sorted(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    keys, n = group["key"].to_numpy().view(np.uint64), group["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order].astype(float)


def top_nodes(roots: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """Counts and mixing weights of the nodes at depths 1 and 0 by byte and prefix."""
    n = np.zeros((2, 256, 256))
    below = np.zeros((256, 256))
    at = roots["byte"].to_numpy(int), roots["prefix"].to_numpy(int)
    n[0][at], n[1][at], below[at] = roots["n0"], roots["n1"], roots["log_w"]
    log_e = _kt(n[0], n[1])
    weighted = np.logaddexp(log_e, below) - np.log(2)
    total = n.sum(axis=1)
    return n, _weight(log_e, below), total, _weight(_kt(total[0], total[1]), weighted.sum(axis=0))


def _weight(log_e: np.ndarray, children: np.ndarray) -> np.ndarray:
    """Share of a node's own estimate against those below it."""
    return 1 / (1 + np.exp(np.clip(children - log_e, -700, 700)))


def _values(group: pd.DataFrame, top: tuple[np.ndarray, ...]) -> pd.DataFrame:
    """log10 of the probability of each gram's byte in its context."""
    keys, n = _sorted(group)
    n1, share1, n0, share0 = top
    symbol = (keys & np.uint64(255)).astype(np.int64)
    newest = (keys >> np.uint64(8 * DEPTH)).astype(np.int64)
    total = np.zeros(len(keys))
    for bit in range(8):
        tree = _tree(keys, n, bit, 2)
        one = ((symbol >> (7 - bit)) & 1).astype(bool)
        prefix = (1 << bit) | (symbol >> (8 - bit))
        p = None
        for depth in range(DEPTH, 1, -1):
            _, own, zeros, ones, log_e, children, _ = tree[depth]
            kt = ((np.where(one, ones[own], zeros[own])) + 0.5) / (zeros + ones + 1)[own]
            share = _weight(log_e, children)[own]
            p = kt if p is None else share * kt + (1 - share) * p
        at = newest, prefix
        kt = (np.where(one, n1[1][at], n1[0][at]) + 0.5) / (n1[0][at] + n1[1][at] + 1)
        p = share1[at] * kt + (1 - share1[at]) * p
        kt = (np.where(one, n0[1][prefix], n0[0][prefix]) + 0.5) / (n0[0] + n0[1] + 1)[prefix]
        p = share0[prefix] * kt + (1 - share0[prefix]) * p
        total += np.log10(p)
    return pd.DataFrame({"key": keys.view(np.int64), "value": total})


def model(counts: DataFrame) -> DataFrame:
    """(key, value): log10 P(byte | context) of every gram, as a written table."""
    spark = counts.sparkSession
    newest = F.shiftrightunsigned("key", 8 * (DEPTH - 1))
    keyed = counts.where("kind = 0").select(
        F.pmod(F.xxhash64(newest), F.lit(GROUPS)).alias("part"), "key", "n"
    )
    roots = keyed.groupBy("part").applyInPandas(
        lambda g: _roots(g), "byte bigint, prefix bigint, n0 double, n1 double, log_w double"
    ).groupBy("byte", "prefix").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "log_w")])
    top = spark.sparkContext.broadcast(top_nodes(roots.toArrow().to_pandas()))  # at most 256 x 255 rows
    values = keyed.groupBy("part").applyInPandas(lambda g: _values(g, top.value), "key bigint, value double")
    return staged(values, "grams")


#: The tables that a worker holds, by their purpose, and which run they are of.
_LOADED: dict[str, tuple[str, Lookup]] = {}


def _lookup(shared, purpose: str) -> Lookup:
    """The broadcast (name, keys, values) as a table; a worker keeps one of each purpose."""
    name, keys, values = shared.value
    if _LOADED.get(purpose, ("", None))[0] != name:
        _LOADED.pop(purpose, None)  # the old one goes before the new one is made
        _LOADED[purpose] = (name, Lookup(keys.view(np.uint64), values, 0.0))
    return _LOADED[purpose][1]


def _block(values: DataFrame, name: str):
    """A block of gram values, sent out with its keys sorted."""
    part = values.toArrow()
    keys, logs = part["key"].to_numpy().view(np.uint64), part["value"].to_numpy()
    order = np.argsort(keys)
    return values.sparkSession.sparkContext.broadcast((name, keys[order], logs[order]))


def frequent(words: DataFrame, most: int) -> DataFrame:
    """The most frequent words, at most ``most``: all from some step of the count upwards.

    A global order would bring the first ``most`` rows of every task to the driver.
    """
    step = F.floor(F.log2("n") * 8)
    sizes = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("size")).collect()
    least, held = None, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):  # a few hundred steps at most
        held += row["size"]
        if held > most:
            break
        least = row["step"]
    return words.limit(0) if least is None else words.where(step >= least)


def scored(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", *,
    block_grams: int = BLOCK_GRAMS, head_words: int = HEAD_WORDS,
) -> DataFrame:
    """Tokens, add-one unigram score and context-tree score of every document.

    ``bits_per_byte`` is the code length of the context tree over the bytes with the end.

    NULL and empty texts are a lone end; a NULL id is a training row; repeated rows count
    and are scored one by one; other columns are not looked at; an empty table gives an
    empty result.
    """
    spark = documents.sparkSession
    rows = staged(
        documents.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
        ),
        "rows",
    )  # every pass reads these ids, however it is split
    counts = staged(
        rows.mapInPandas(_counted, "kind int, key bigint, n bigint")
        .groupBy("kind", "key").agg(F.sum("n").alias("n")),
        "counts",
    )
    sums = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()}
    ends = sums[2]["n"] if 2 in sums else 0
    train = ends + (sums[1]["n"] if 1 in sums else 0)
    distinct = (sums[1]["v"] if 1 in sums else 0) + (1 if ends else 0)
    n_grams = sums[0]["v"] if 0 in sums else 0

    words = counts.where("kind = 1").select("key", "n")
    head = frequent(words, head_words).toArrow()  # columns, not a Python object for each value
    run = uuid.uuid4().hex
    head_shared = spark.sparkContext.broadcast(
        (run, head["key"].to_numpy(), np.log10(head["n"].to_numpy() + 1.0))
    )
    values = model(counts)
    blocks = max(1, -(-n_grams // block_grams))
    end_value = float(np.log10(ends + 1))
    passes = []
    for block in range(blocks):
        shared = _block(values.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block), f"{run}-{block}")
        passes.append(staged(_pass(rows, shared, head_shared, block), "pass"))
        shared.unpersist()  # the pass is written
    found = passes[0] if blocks == 1 else _joined_passes(passes)

    tail = found.select("row", F.explode(F.arrays_zip("keys", "times")).alias("w")).select(
        "row", F.col("w.keys").alias("key"), F.col("w.times").alias("times")
    ).join(words, "key").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("tail_score"), F.sum("times").alias("tail_known")
    )
    scale = float(np.log10(train + distinct + 1))
    return found.drop("keys", "times").join(tail, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0)) + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(train).cast("long").alias("train_tokens"),
        (
            F.col("head_score") + F.coalesce("tail_score", F.lit(0.0)) + F.lit(end_value)
            - F.col("n_tokens") * F.lit(scale)
        ).alias("base_score"),
        "score",
        (F.col("score") / F.col("n_bytes") / F.lit(-float(np.log10(2)))).alias("bits_per_byte"),
    )


PASS = (
    "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_bytes bigint, n_known bigint, "
    "head_score double, score double, keys array<bigint>, times array<bigint>"
)


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts whose grams are looked up at once: no more texts than TEXT_BITS can number."""
    least = max(1, FIND_CHARS >> TEXT_BITS)
    return slices([max(least, len(t or "")) for t in texts], FIND_CHARS)


def _pass(rows: DataFrame, shared, head_shared, block: int) -> DataFrame:
    """One row per document: its score over the grams of a block, and in the first pass its
    words, summed up if frequent, otherwise listed with their number."""

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, table, values = shared.value
        head = _lookup(head_shared, "words")
        for batch in batches:
            texts = batch.pop("text").tolist()
            for i, j in _slices(texts):
                own = [canonical(t) for t in texts[i:j]]
                score, sizes = gram_sums(own, table.view(np.uint64), values)
                hashes, n = word_hashes(own)
                owner = np.repeat(np.arange(len(own)), n)
                value, known = head.find(hashes)
                rest, whose = hashes[~known], owner[~known]
                order = np.lexsort((rest, whose))
                rest, whose = rest[order], whose[order]
                new = np.r_[True, (rest[1:] != rest[:-1]) | (whose[1:] != whose[:-1])][: len(rest)]
                at = np.flatnonzero(new)
                times = np.diff(np.r_[at, len(rest)])
                cut = np.cumsum(np.bincount(whose[at], minlength=len(own)))[:-1]
                ids = batch["doc_id"].iloc[i:j]
                yield pd.DataFrame(
                    {
                        "row": batch["row"].iloc[i:j].array,
                        "doc_id": ids.array,
                        "held_out": [is_held_out(d) for d in ids],
                        "n_tokens": n + 1,
                        "n_bytes": sizes,
                        "n_known": np.bincount(owner, known, len(own)).astype(np.int64),
                        "head_score": np.bincount(owner, value, len(own)),
                        "score": score,
                        "keys": np.split(rest[at].view(np.int64), cut),
                        "times": np.split(times, cut),
                    }
                )
        settle()

    def later(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, table, values = shared.value
        for batch in batches:
            texts = batch.pop("text").tolist()
            for i, j in _slices(texts):
                score, _ = gram_sums([canonical(t) for t in texts[i:j]], table.view(np.uint64), values)
                yield pd.DataFrame({"row": batch["row"].iloc[i:j].array, "score": score})
        settle()

    if block:
        return rows.select("row", "text").mapInPandas(later, "row bigint, score double")
    return rows.mapInPandas(first, PASS)


def _joined_passes(passes: list[DataFrame]) -> DataFrame:
    """Scores of several blocks added up by the row ids that were written with the texts."""
    first, *others = passes
    more = others[0].select("row", "score")
    for other in others[1:]:
        more = more.unionByName(other.select("row", "score"))
    added = more.groupBy("row").agg(F.sum("score").alias("_more"))
    return first.join(added, "row").withColumn("score", F.col("score") + F.col("_more")).drop("_more")
