"""Operator 4: benchmark items that occur in documents with a few edits.

An item of m bytes may differ in k = m // 20 of them.  It is split into k + 1 pieces; an
occurrence with at most k edits leaves one piece intact (pigeonhole), so the exact hits of
the pieces are all places that need a look.  Those are verified with Myers' bit-parallel
edit distance.  Documents are scanned where they lie: the items go to them in blocks whose
size is bounded by a parameter, one pass over the documents for each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes of item text in one block.
BLOCK_BYTES = 1 << 20
BYTES_PER_EDIT = 20

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
MATCHES = "array<struct<item_id:bigint,n_edits:int>>"


def normal(text: str | None) -> bytes:
    """Lower case, and one space for each run of ASCII marks and white space."""
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD).split())


def budget(size: int) -> int:
    return size // BYTES_PER_EDIT


def pieces(item: bytes, edits: int) -> Iterator[tuple[int, bytes]]:
    """``edits + 1`` pieces of nearly equal length, with their places in the item."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    for start, end in zip(cuts, cuts[1:], strict=False):
        yield start, item[start:end]


def myers(pattern: bytes, text: bytes, most: int) -> int:
    """Fewest edits between ``pattern`` and any stretch of ``text``, or ``most + 1``.

    Myers' bit vectors over the whole pattern, as Python integers of any length.
    """
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, min(m, most + 1)
    for c in text:
        eq = masks.get(c, 0)
        vertical = eq | minus
        diagonal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best = score
            if not best:
                break
    return best


class Searcher:
    """Finds a block of items in texts."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = items
        found: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(items):
            for start, piece in pieces(item, budget(len(item))):
                found.setdefault(piece.decode("latin-1"), []).append((n, start))
        self.automaton = ahocorasick.Automaton()
        for piece, places in found.items():
            self.automaton.add_word(piece, (len(piece), places))
        if found:
            self.automaton.make_automaton()
        self.empty = not found

    def search(self, text: str | None) -> list[dict]:
        if self.empty:
            return []
        body = normal(text)
        best: dict[int, int] = {}
        seen: dict[int, int] = {}  # by item, up to where its windows have been verified
        for end, (size, places) in self.automaton.iter(body.decode("latin-1")):
            for n, offset in places:
                if best.get(n) == 0:
                    continue
                item = self.items[n][1]
                edits = budget(len(item))
                start = end - size + 1 - offset
                if body[max(start, 0) : start + len(item)] == item:
                    best[n] = 0
                    continue
                low, high = max(start - edits, 0), start + len(item) + edits
                if not edits or (n in seen and seen[n] == start):
                    continue
                seen[n] = start
                distance = myers(item, body[low:high], edits)
                if distance <= edits:
                    best[n] = min(distance, best.get(n, distance))
        return [
            {"item_id": self.items[n][0], "n_edits": edits} for n, edits in sorted(best.items())
        ]


_SEARCHERS: dict[int, Searcher] = {}


def _searcher(shared: Broadcast) -> Searcher:
    """One automaton for each worker process and block."""
    key = shared._jbroadcast_id if hasattr(shared, "_jbroadcast_id") else id(shared.value)
    if key not in _SEARCHERS:
        _SEARCHERS.clear()
        _SEARCHERS[key] = Searcher(shared.value)
    return _SEARCHERS[key]


def search_column(text: Column, shared: Broadcast) -> Column:
    """Items of one block found in a text column, each with its fewest edits."""

    @F.pandas_udf(MATCHES)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        searcher = _searcher(shared)
        for texts in batches:
            yield texts.map(searcher.search)

    return found(text)


def item_blocks(
    spark: SparkSession, items: DataFrame, block_bytes: int = BLOCK_BYTES,
    item_id: str = "item_id", text: str = "text",
) -> Iterator[Broadcast]:
    """The items in blocks of about ``block_bytes``; those without a word are left out."""
    rows = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).where(
        F.col("text").isNotNull()
    )
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = -(-2 * total // block_bytes) if total > block_bytes else min(1, total)
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        found = sorted({(-1 if r["id"] is None else r["id"], normal(r["text"])) for r in part.toLocalIterator()})
        yield spark.sparkContext.broadcast([(i, t) for i, t in found if t])


def contaminated(
    documents: DataFrame, items: DataFrame, *, block_bytes: int = BLOCK_BYTES,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document and item found in it, with the fewest edits of an occurrence.

    NULL and empty texts hold no item, items without a word are in no document, an item
    with a NULL id is reported as -1; repeated rows are reported once each; a NULL doc_id
    is kept; other columns are not looked at; without documents or items there are no rows.
    """
    spark = documents.sparkSession
    result = spark.createDataFrame([], "doc_id bigint, item_id bigint, n_edits int")
    for shared in item_blocks(spark, items, block_bytes):
        found = documents.select(
            F.col(doc_id).alias("doc_id"), F.explode(search_column(F.col(text), shared)).alias("m")
        )
        result = result.unionByName(found.select("doc_id", "m.item_id", "m.n_edits"))
    return result


def without_contaminated(documents: DataFrame, items: DataFrame, *, block_bytes: int = BLOCK_BYTES, text: str = "text") -> DataFrame:
    """The documents in which no item is found, with all their columns."""
    for shared in item_blocks(documents.sparkSession, items, block_bytes):
        documents = documents.where(F.size(search_column(F.col(text), shared)) == 0)
    return documents
