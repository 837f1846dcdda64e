"""Cached encoding of short pieces with the tokenizers library, inside a task."""

from __future__ import annotations

import os
import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks use the cores


class Pieces:
    """Ids and decoded text of pieces of text; each piece is encoded once while it is kept.

    ``most`` bounds the cache and has no bearing on results: the first so many pieces are
    kept, which by their frequency are nearly all that matter, others for one call only.
    """

    SEPARATOR = "<|endoftext|>"

    def __init__(self, path: str, most: int = 300_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.separator = self.tokenizer.token_to_id(self.SEPARATOR)
        self.most = most
        self.ids: dict[bytes, bytes] = {}
        self.texts: dict[bytes, str] = {}
        self.passing: list[bytes] = []

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def learn(self, pieces: set[bytes], decode: bool) -> None:
        """Make sure that all pieces are in the cache."""
        new = [p for p in pieces if p not in self.ids]
        if not new:
            return
        for start in range(0, len(new), 1000):
            part = new[start : start + 1000]
            plain = [p for p in part if b"<|" not in p]
            found = list(zip(plain, self._encode_many(plain), strict=True))
            found += [
                (p, np.array(self.encode(p.decode("utf-8", "replace")), "<u4").tobytes())
                for p in part if b"<|" in p
            ]
            self.ids.update(found)
            if decode:
                lists = [np.frombuffer(i, "<u4").tolist() for _, i in found]
                texts = self.tokenizer.decode_batch(lists, skip_special_tokens=False)
                self.texts.update(zip([p for p, _ in found], texts, strict=True))
        if len(self.ids) > self.most:
            self.passing += new

    def forget(self) -> None:
        """Drop the pieces that came when the cache was full."""
        for p in self.passing:
            self.ids.pop(p, None)
            self.texts.pop(p, None)
        self.passing = []

    def _encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, encoded in one text with a special token between them."""
        if not pieces:
            return []
        text = self.SEPARATOR.join([p.decode("utf-8", "replace") for p in pieces])
        ids = np.array(self.encode(text), "<u4")
        raw, cut = ids.tobytes(), np.flatnonzero(ids == self.separator)
        starts, ends = [0, *(4 * (cut + 1)).tolist()], [*(4 * cut).tolist(), len(raw)]
        return [raw[i:j] for i, j in zip(starts, ends, strict=True)]


_OPEN: dict[tuple, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """One cache for each worker process and tokenizer."""
    if path not in _OPEN:
        _OPEN[path] = Pieces(path)
    return _OPEN[path]
