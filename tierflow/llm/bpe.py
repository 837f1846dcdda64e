"""Operator 8: BPE encoding and decoding with reuse of content-defined chunks.

A text is cut into chunks where a hash of the last bytes says so, so that texts which share
a passage share its chunks.  Each chunk is encoded once in a worker, whatever number of its
documents hold it.  Where two chunks meet, the last and the first piece of text are encoded
again together; if the ids differ, the stretch is widened by a piece on both sides until
its outer ids agree with those of the chunks.

Chunks are shared within a worker and not across the cluster: a shuffle of all chunk texts
and ids would move about three times the input, more than encoding a chunk again costs.

The vocabulary has no spaces, so ids of pieces between white space are independent of each
other; that makes the agreement of a stretch between spaces exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.kernels import settle, slices
from tierflow.llm.pieces import Pieces, pieces_of

#: One in so many white spaces, and one in so many other characters, ends a chunk.
SPACES_PER_CHUNK = 128
BYTES_PER_CUT = 1 << 16
WINDOW = 8
#: Bytes of chunk text that a worker keeps, and bytes of text that it encodes at once.
CHUNK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20


def cuts(text: bytes) -> list[int]:
    """Places before which a chunk begins: ``WINDOW`` bytes before them decide."""
    n = len(text)
    if n <= WINDOW + 1:
        return []
    buf = np.frombuffer(text, np.uint8)
    last = np.ndarray((n - WINDOW,), "<u8", text, strides=(1,))  # bytes i .. i + 7
    here = buf[WINDOW:]
    spaces = np.flatnonzero((here == 32) | (here == 10))
    rolled = (last[spaces] * np.uint64(0x9E3779B97F4A7C55)) >> np.uint64(40)
    found = spaces[rolled % np.uint64(SPACES_PER_CHUNK) == 0]
    gaps = np.diff(np.r_[0, spaces, n])
    if (gaps > BYTES_PER_CUT // 4).any():  # long stretches without a space
        rolled = (last * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)
        inside = (rolled % np.uint64(BYTES_PER_CUT) == 0) & ((here & 0xC0) != 0x80)
        found = np.union1d(found, np.flatnonzero(inside))
    return (found + WINDOW).tolist()


def chunks(text: bytes) -> list[bytes]:
    at = [0, *cuts(text), len(text)]
    return [text[i:j] for i, j in zip(at, at[1:], strict=False)]


def _words(chunk: bytes) -> list[bytes]:
    """Pieces between ASCII white space; ASCII letters are lowered as the vocabulary does,
    unless the chunk may hold a special token."""
    return chunk.split() if b"<|" in chunk else chunk.lower().split()


class Chunked:
    """Encodes texts from chunks.

    Chunks are kept within a task; ``pieces``, by which they are made, as long as the worker.
    """

    def __init__(self, pieces: Pieces, most: int = CHUNK_BYTES):
        self.pieces = pieces
        self.most, self.size = most, 0
        self.known: dict[bytes, tuple[bytes, str]] = {}
        self.joins: dict[tuple[bytes, bytes], bool] = {}
        self.encoded = self.repaired = 0

    def encode(self, texts: list[bytes]) -> list[tuple[bytes, str]]:
        """Ids (little-endian, 32 bits) and decoded text of each text."""
        cut = [chunks(t) for t in texts]
        new = {c for own in cut for c in own if c not in self.known}
        if self.size > self.most:
            self.clear()
            new = {c for own in cut for c in own}
        self.pieces.forget()
        split = {c: _words(c) for c in new}
        self.pieces.learn({w for own in split.values() for w in own}, decode=True)
        for c, own in split.items():
            self.known[c] = self._joined(own)
            self.size += len(c)
        self.encoded += len(new)
        return [self._assembled(own) for own in cut]

    def clear(self) -> None:
        self.known, self.joins, self.size = {}, {}, 0

    def _joined(self, words: list[bytes]) -> tuple[bytes, str]:
        ids, texts = self.pieces.ids, self.pieces.texts
        decoded = [texts[w] for w in words]
        return b"".join([ids[w] for w in words]), " ".join([d for d in decoded if d])

    def _assembled(self, own: list[bytes]) -> tuple[bytes, str]:
        if all(self._agrees(a, b) for a, b in zip(own, own[1:], strict=False)):
            parts = [self.known[c] for c in own]
            return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts if p[1]])
        return self._repair(own)

    def _agrees(self, a: bytes, b: bytes) -> bool:
        """Whether the last piece of ``a`` and the first of ``b``, encoded as they stand
        in the text, give the ids that they have in their chunks."""
        left, right = _words(a[-256:]), _words(b[:256])
        if not left or not right or len(a) > 256 and len(left) < 2 or len(b) > 256 and len(right) < 2:
            left, right = _words(a), _words(b)
            if not left or not right:
                return True
        tail, head = left[-1], right[0]
        apart = a[-1:].isspace() or b[:1].isspace()
        key = (tail, b" " + head if apart else head)
        if key not in self.joins:
            self.pieces.learn({tail, head}, decode=True)
            again = self.pieces.encode((key[0] + key[1]).decode("utf-8", "replace"))
            kept = self.pieces.ids[tail] + self.pieces.ids[head]
            self.joins[key] = np.array(again, "<u4").tobytes() == kept
        return self.joins[key]

    def _repair(self, own: list[bytes]) -> tuple[bytes, str]:
        """Ids of a text with a join that changes them."""
        self.repaired += 1
        done = [own[0]]
        for chunk in own[1:]:
            if self._agrees(done[-1], chunk):
                done.append(chunk)
                continue
            left, right = _words(done[-1]), _words(chunk)
            width = 1
            while True:  # widen until the outer pieces keep their ids
                width += 1
                a, b = left[-width:], right[:width]
                stretch = b" ".join([*a[:-1], a[-1] + b[0], *b[1:]])
                self.pieces.learn({*a, *b}, decode=True)
                again = np.array(self.pieces.encode(stretch.decode("utf-8", "replace")), "<u4").tobytes()
                first = self.pieces.ids[a[0]] if len(a) == width else b""
                last = self.pieces.ids[b[-1]] if len(b) == width else b""
                if again.startswith(first) and again.endswith(last):
                    break
                if width > max(len(left), len(right)):
                    break
            done[-1] = b" ".join([*left[:-1], left[-1] + right[0], *right[1:]])
            if chunk[-1:].isspace():
                done[-1] += b" "
        words = [_words(c) for c in done]
        self.pieces.learn({w for own in words for w in own}, decode=True)
        return self._joined([w for own in words for w in own])


_CHUNKED: dict[str, Chunked] = {}


def encoded(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (binary: 32-bit little-endian) and decoded text of every document.

    NULL and empty texts have no ids and decode to an empty text; repeated rows are encoded
    one by one; NULL ids are kept; other columns are not looked at; an empty table gives an
    empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _CHUNKED:
            _CHUNKED[path] = Chunked(pieces_of(path))
        encoder = _CHUNKED[path]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for i, j in slices(sizes, SLICE_BYTES):  # texts leave Arrow a slice at a time
                part = batch.slice(i, j - i)
                texts = part.column("text").to_pylist()
                found = encoder.encode([(t or "").encode("utf-8", "replace") for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([ids for ids, _ in found], pa.binary()),
                        pa.array([decoded for _, decoded in found], pa.string()),
                    ],
                    ["doc_id", "ids", "decoded"],
                )
                del part, texts, found
            settle()
        encoder.clear()
        settle()

    rows = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def digests(encoded_rows: DataFrame) -> DataFrame:
    """Number of ids and digests of the ids and of the decoded text."""
    return encoded_rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
