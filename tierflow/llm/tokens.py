"""Operator 7: token ids as directly addressable codes.

Documents are sorted by id over the cluster (one range shuffle of their texts), encoded,
and written in segments.  A segment holds the ids of whole documents as directly
addressable codes: level 0 has the low 8 bits of every id, and a bitmap marks the ids that
go on; level 1 has the next 8 bits of those, and so on.  A rank directory counts the marks
before every 512th bit, so the place of an id's next chunk is a rank, and one id can be
read without decoding its neighbours.

Segments are the rows of a Parquet table (shard, segment, doc_ids, lengths, payload): Spark
commits its files as a whole, on any store, also if an executor is lost while writing.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.kernels import slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores

END = 0
#: A segment is closed once it has so many ids; a document is never split.
SEGMENT_IDS = 1 << 19
SLICE_BYTES = 4 << 20
RANK = 512
MAGIC = b"DAC1"
#: Words that a worker keeps; has no bearing on results.
KEPT_WORDS = 600_000

SEGMENTS = "shard int, segment int, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary"


def pack(ids: np.ndarray) -> bytes:
    """Directly addressable codes of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (RANK // 8)))
        marks = np.bitwise_count(bits).reshape(-1, RANK // 8).sum(axis=1, dtype=np.int64)
        ranks = (np.cumsum(marks) - marks).astype("<u8")
        levels.append((len(rest), (rest & 0xFF).astype(np.uint8), bits, ranks))
        if not more.any():
            break
        rest = rest[more] >> 8
    head = np.array([len(levels), *(n for n, *_ in levels)], "<u8").tobytes()
    return MAGIC + head + b"".join(x.tobytes() for _, *arrays in levels for x in arrays)


class Codes:
    """Reads ids from a payload without copying it."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a segment of token ids")
        count = int(np.frombuffer(payload, "<u8", 1, 4)[0])
        sizes = np.frombuffer(payload, "<u8", count, 12).astype(int)
        at, self.levels = 12 + 8 * count, []
        for n in sizes:
            blocks = -(-n // RANK)
            chunks = np.frombuffer(payload, np.uint8, n, at)
            bits = np.frombuffer(payload, np.uint8, blocks * (RANK // 8), at + n)
            ranks = np.frombuffer(payload, "<u8", blocks, at + n + len(bits))
            at += n + len(bits) + 8 * blocks
            self.levels.append((chunks, bits, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, i: int) -> int:
        """Marks of a level before place ``i``."""
        _, bits, ranks = self.levels[level]
        block, inside = divmod(i, RANK)
        if block == len(ranks):
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        start = block * (RANK // 8)
        whole, part = divmod(inside, 8)
        count = int(ranks[block]) + int(np.bitwise_count(bits[start : start + whole]).sum())
        return count + (int(bits[start + whole]) & ((1 << part) - 1)).bit_count()

    def __getitem__(self, i: int) -> int:
        """One id, by one rank for each level that it goes on to."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            i = self._rank(level, i)
        return value

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the segment."""
        return self._read(0, start, end)

    def _read(self, level: int, start: int, end: int) -> np.ndarray:
        chunks, bits, _ = self.levels[level]
        values = chunks[start:end].astype(np.uint32)
        first = start >> 3
        marks = np.unpackbits(bits[first : -(-end // 8)], bitorder="little")
        more = np.flatnonzero(marks[start - first * 8 : end - first * 8])
        if len(more):
            low = self._rank(level, start)
            values[more] |= self._read(level + 1, low, low + len(more)) << 8
        return values


class Words:
    """Ids of words by the tokenizers library; words that come again are encoded once while kept.

    A word is what follows a space, and its ids are those of the space and the word; or it is
    a line break and what follows it.  The pattern of the vocabulary takes the last white space
    before a letter, digit or ASCII sign by itself or into the word after it, whatever comes
    before.  Words that begin otherwise stay with the one before, and so does what may be a
    special token, since cutting less often is always right.  The pattern never takes signs
    with the letters before them, so a stop or comma that ends a word of Latin letters is cut off.

    Words are handled as keys: in them ``ODD`` stands for a space that is not cut at and ``NUL``
    for U+0000, and no space precedes a key that begins with ``START``, as that of a text does.
    New words are encoded many at a time as one text.  Every id of a byte-level vocabulary
    stands for a known number of bytes, which tells where words end.
    """

    TOGETHER = 64
    LONGEST = 100  # longer keys are not kept
    BEGIN = r"(?!<\|)(?:[!-~]|\w)"
    SPACE = re.compile(rf" (?!{BEGIN})")
    LINE = re.compile(rf"\n(?={BEGIN})")
    SIGN = re.compile("[.,](?=[ \n])(?<=[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f].)")
    START, ODD, NUL = "\0^", "\0s", "\0n"

    def __init__(self, path: str, most: int = KEPT_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = {i: len(t.content.encode()) for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = added.get(i, len(token))
        self.most = most
        self.kept: dict[bytes, bytes] = {}  # came in two slices
        self.once: dict[bytes, bytes] = {}

    def cut(self, texts: list[str]) -> pa.ListArray:
        """The keys of each text."""
        marked = []
        for t in texts:
            spaced = self.SPACE.sub(self.ODD, t.replace("\0", self.NUL))
            marked.append(self.START + self.LINE.sub(" \n", self.SIGN.sub(f" {self.START}\\g<0>", spaced)))
        return pc.split_pattern(pa.array([t.encode("utf-8", "replace") for t in marked], pa.binary()), b" ")

    def text(self, keys: list[bytes]) -> str:
        """What keys stand for, one after the other."""
        text = b" ".join([b"", *keys]).decode().replace(" \n", "\n").replace(" " + self.START, "")
        return text.replace(self.ODD, " ").replace(self.NUL, "\0")

    def encode(self, *texts: str) -> np.ndarray:
        """Ids of the texts one after the other."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.fromiter(chain.from_iterable([x.ids for x in found]), "<u4")

    def encoded(self, keys: list[bytes]) -> dict[bytes, bytes]:
        """Ids of keys by the library."""
        own, together = {}, []
        for key in keys:
            if key[:2] == b"\0^" or b"<|" in key:  # the latter may hold a special token
                own[key] = self.encode(self.text([key])).tobytes()
            else:
                together.append(key)
        for start in range(0, len(together), self.TOGETHER**2):
            part = together[start : start + self.TOGETHER**2]
            ids = self.encode(
                *[self.text(part[i : i + self.TOGETHER]) for i in range(0, len(part), self.TOGETHER)]
            )
            sizes = [len(key) + (key[:1] != b"\n") - key.count(b"\0") for key in part]
            ends = np.searchsorted(np.cumsum(self.bytes[ids]), np.cumsum(sizes))
            raw, places = ids.tobytes(), [0, *(4 * (ends + 1)).tolist()]
            own.update(zip(part, [raw[i:j] for i, j in zip(places, places[1:], strict=False)], strict=True))
        return own

    def ids(self, keys: list[bytes]) -> list[bytes]:
        """Ids of distinct keys."""
        found = list(map(self.kept.get, keys))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        again, new = {}, []
        for i in gaps:
            ids = found[i] = self.once.pop(keys[i], None)
            if ids is None:
                new.append(i)
            else:
                again[keys[i]] = ids
        own = self.encoded([keys[i] for i in new])
        for i in new:
            found[i] = own[keys[i]]
        self.keep(again, {key: ids for key, ids in own.items() if len(key) <= self.LONGEST})
        return found

    def keep(self, again: dict[bytes, bytes], new: dict[bytes, bytes]) -> None:
        """A cache only: words met once go first; if the others are too many, they must be met again."""
        if 4 * (len(self.kept) + len(again)) > 3 * self.most:
            self.kept, self.once = {}, self.kept
        self.kept.update(again)
        if len(self.kept) + len(self.once) + len(new) > self.most:
            self.once = {}
        self.once.update(new)


_OPEN: dict[str, Words] = {}


def words_of(path: str) -> Words:
    """One cache for each worker process and tokenizer."""
    if path not in _OPEN:
        _OPEN[path] = Words(path)
    return _OPEN[path]


def token_ids(words: Words, texts: list[str]) -> list[np.ndarray]:
    """Ids of the texts, each followed by ``END``."""
    cut = words.cut(texts)
    keys = cut.flatten().dictionary_encode()
    known = words.ids(keys.dictionary.to_numpy(zero_copy_only=False).tolist())
    found = pa.array(known, pa.large_binary()).take(keys.indices)
    places = np.frombuffer(found.buffers()[1], "<i8", len(found) + 1)[cut.offsets.to_numpy()] // 4
    ids, end = np.frombuffer(found.buffers()[2] or b"", "<u4"), np.array([END], "<u4")
    return [np.concatenate([ids[i:j], end]) for i, j in zip(places, places[1:], strict=False)]


def write(
    documents: DataFrame, target: str, path: str, doc_id: str = "doc_id", text: str = "text",
    partitions: int | None = None, segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode all documents and write their segments to ``target`` in order of doc_id.

    Shards are ranges of doc_id; a NULL id comes first, equal ids are in order of a hash of
    their text.  NULL and empty texts are a lone end id.  Other columns are not read.
    """
    spark = documents.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("_key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, shard, segment = words_of(path), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        total = 0

        def closed() -> pd.DataFrame:
            return pd.DataFrame(
                {
                    "shard": [shard], "segment": [segment], "n_ids": [total],
                    "doc_ids": [doc_ids], "lengths": [[len(x) for x in held]],
                    "payload": [pack(np.concatenate(held))],
                }
            )

        for batch in batches:
            texts = batch["text"].tolist()
            own = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            for i, j in slices([len(t) for t in texts], SLICE_BYTES):
                for d, ids in zip(own[i:j], token_ids(words, texts[i:j]), strict=True):
                    doc_ids.append(d)
                    held.append(ids)
                    total += len(ids)
                    if total >= segment_ids:
                        yield closed()
                        doc_ids, held, total, segment = [], [], 0, segment + 1
        if held:
            yield closed()

    ordered = rows.repartitionByRange(n, "doc_id", "_key").sortWithinPartitions("doc_id", "_key")
    ordered.select("doc_id", "text").mapInPandas(encode, SEGMENTS).write.parquet(target)


def placed(spark: SparkSession, target: str) -> DataFrame:
    """The written segments with ``start``: the number of ids in all segments before.

    Sums by shard are small (one row for each range of the shuffle) and are added up on the
    driver; segments of a shard follow each other.
    """
    from pyspark.sql import Window

    segments = spark.read.parquet(target)
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    before, offset = [], 0
    for row in totals:
        before.append((row["shard"], offset))
        offset += row["n"]
    shards = spark.createDataFrame(before, "shard int, _before bigint")
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select(
        "shard", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("_inside")
    ).join(F.broadcast(shards), "shard").select(
        "shard", "segment", (F.col("_before") + F.col("_inside")).alias("start")
    )
    return segments.join(starts, ["shard", "segment"])


def token_at(spark: SparkSession, target: str, position: int) -> int:
    """The id at a position of the whole sequence, from one segment and without decoding it."""
    at = placed(spark, target).where(
        (F.col("start") <= position) & (F.col("start") + F.col("n_ids") > position)
    ).select("start", "payload").first()
    if at is None:
        raise IndexError(position)
    return Codes(bytes(at["payload"]))[position - at["start"]]


def read(spark: SparkSession, target: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every written document."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                codes = Codes(row.payload)
                ends = np.cumsum(row.lengths)
                starts = ends - row.lengths
                ids = codes.read(0, len(codes)).astype("<u4", copy=False)
                crc = [zlib.crc32(ids[i:j]) for i, j in zip(starts, ends, strict=True)]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([pd.NA if d is None or d != d else int(d) for d in row.doc_ids], "Int64"),
                        "start": starts + row.start, "n_tokens": row.lengths, "ids_crc32": crc,
                    }
                )

    rows = placed(spark, target).select("start", "doc_ids", "lengths", "payload")
    return rows.mapInPandas(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
