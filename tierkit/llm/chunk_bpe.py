"""BPE encoding by content-defined chunk reuse, and decoding.

A rolling hash over the bytes of a text cuts it into chunks of about
``CHUNK_BYTES``, at places that depend on the nearby bytes alone, so copied
texts and passages give the same chunks wherever they stand. A worker encodes
each chunk once and keeps it while its cache has room (``CACHE_BYTES``, then it
starts anew). A cut may fall inside a word: the ids of the broken words at the
two sides of a join are dropped, and the join is encoded again with a growing
number of whole words around it until their ids agree exactly with those that
the chunks hold.

A text is handled within its row: nothing is shuffled, so a hot source or group
of copies costs no more than other rows, and a lost executor repeats its tasks.

Defined cases: a null text is empty; an empty text has no ids and decodes to the
empty text; repeated rows are encoded each; texts holding characters on which
the tokenizer and Python differ as to white space are encoded whole; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.common import ship_package, whole_text
from tierkit.llm.tokens import vocabulary_path, word_encoder

CHUNK_BYTES = 2048
CACHE_BYTES = 64 << 20
# Python splits words at these, the tokenizer doesn't.
_PYTHON_ONLY_SPACE = "\x1c\x1d\x1e\x1f"
_WINDOW = 16  # bytes that decide on a cut
_GEAR = np.random.default_rng(7).integers(0, 1 << 32, 256, dtype=np.uint32)
_CHUNKERS: dict[tuple[str, int], "ChunkEncoder"] = {}


def cut_places(data: bytes, mean: int = CHUNK_BYTES) -> np.ndarray:
    """Places in UTF-8 ``data`` after which a chunk ends: where the rolling hash of the 16 bytes
    before is 0 modulo ``mean``, between characters."""
    raw = np.frombuffer(data, np.uint8)
    if len(raw) <= _WINDOW:
        return np.zeros(0, np.int64)
    h = _GEAR[raw]
    for step in (1, 2, 4, 8):  # the sum over 16 bytes, each shifted by its distance, by doubling
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    at = np.flatnonzero((h[_WINDOW - 1 : -1] >> np.uint32(8)) % np.uint32(mean) == 0) + _WINDOW
    return at[(raw[at] & 0xC0) != 0x80]


@dataclass
class Chunk:
    """A chunk's broken words at its ends, and the ids of the whole words between them."""

    head: str
    tail: str
    ids: bytes
    first: str  # the whole words next to the broken ones
    last: str
    solid: bool  # no white space: all of it is part of one word


class JoinError(ValueError):
    """A join of chunks that doesn't come to agree with them within the reach that is tried."""


class ChunkEncoder:
    def __init__(self, path: str, mean: int):
        self.words = word_encoder(path)
        self.mean = mean
        self.chunks: dict[bytes, Chunk] = {}
        self.held = 0
        self.joins: dict[str, bytes] = {}
        get = self.words.tokenizer
        self.pieces = [(get.id_to_token(i) or "").encode() for i in range(get.get_vocab_size())]

    def _learn(self, new: list[bytes]) -> None:
        texts = [c.decode() for c in new]
        parts = []
        for t in texts:
            w = t.split()
            head = "" if not w or t[0].isspace() else w[0]
            tail = "" if not w or t[-1].isspace() else w[-1]
            solid = len(w) == 1 and bool(head) and bool(tail)
            inner = w[1 if head else 0 : len(w) - 1 if tail else len(w)] if not solid else []
            parts.append((head, tail, inner, solid))
        encoded = self.words.encode([" ".join(p[2]) for p in parts])
        for c, (head, tail, inner, solid), ids in zip(new, parts, encoded, strict=True):
            self.chunks[c] = Chunk(head, tail, ids, inner[0] if inner else "", inner[-1] if inner else "", solid)
            self.held += len(c) + len(ids) + 300

    def _join(self, left: Chunk | None, broken: str, right: Chunk | None) -> bytes:
        """The ids of the word broken at a join, re-encoded until the words around it agree."""
        if broken not in self.joins:
            before = left.last if left else ""
            after = right.first if right else ""
            for reach in range(1, 5):
                window = " ".join(x for x in (before, broken, after) if x)
                ids = self.words._ask([window])[0]
                a, b = self.words.few(before), self.words.few(after)
                if ids.startswith(a) and ids.endswith(b) and len(ids) >= len(a) + len(b):
                    break
                before, after = f"{before} {before}".strip(), f"{after} {after}".strip()
            else:
                raise JoinError(broken)
            if len(self.joins) > 100_000:
                self.joins.clear()
            self.joins[broken] = ids[len(a) : len(ids) - len(b)]
        return self.joins[broken]

    def encode(self, texts: list[str], at_once: int = 1024) -> list[bytes]:
        out = []
        for i in range(0, len(texts), at_once):
            out += self._part(texts[i : i + at_once])
        return out

    def _part(self, texts: list[str]) -> list[bytes]:
        if not self.words.by_words:  # a join rests on blanks: other tokenizers encode whole texts
            return [self._whole(t) for t in texts]
        if self.held > CACHE_BYTES:
            self.chunks.clear()
            self.held = 0
        cut, new = [], {}
        for t in texts:
            if any(c in t for c in _PYTHON_ONLY_SPACE):
                cut.append(None)
                continue
            data = t.encode()
            at = [0, *cut_places(data, self.mean).tolist(), len(data)]
            own = [data[a:b] for a, b in zip(at, at[1:])]
            cut.append(own)
            new.update((c, None) for c in own if c not in self.chunks)
        if new:
            self._learn(list(new))
        return [self._whole(t) if own is None else self._assembled(t, own) for t, own in zip(texts, cut, strict=True)]

    def _whole(self, text: str) -> bytes:
        return self.words._ask([text])[0]

    def _assembled(self, text: str, chunks: list[bytes]) -> bytes:
        """The ids of a text from its chunks; a text with a join that doesn't come to agree is encoded whole."""
        try:
            return self._assemble(chunks)
        except JoinError:
            return self._whole(text)

    def _assemble(self, chunks: list[bytes]) -> bytes:
        out, broken, left = [], "", None
        for key in chunks:
            c = self.chunks[key]
            if c.solid:
                broken += c.head
                continue
            if broken or c.head:
                out.append(self._join(left, broken + c.head, c))
            out.append(c.ids)
            broken, left = c.tail, c
        if broken:
            out.append(self._join(left, broken, None))
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The decoded text in UTF-8: the dealt tokenizer has no decoder, so its tokens with blanks between."""
        if self.words.tokenizer.decoder is not None:
            return self.words.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()
        pieces = self.pieces
        return b" ".join([pieces[i] for i in ids.tolist()])


def chunk_encoder(path: str, mean: int = CHUNK_BYTES) -> ChunkEncoder:
    if (path, mean) not in _CHUNKERS:
        _CHUNKERS[path, mean] = ChunkEncoder(path, mean)
    return _CHUNKERS[path, mean]


def encode(docs: DataFrame, path: str | None = None, mean: int = CHUNK_BYTES, digests: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, and ``ids`` (little-endian unsigned 32-bit) with
    ``decoded``; with ``digests`` their sha256 (of the decoded text in UTF-8) instead."""
    ship_package(docs.sparkSession)
    path = path or vocabulary_path()

    def run(batches):
        enc = chunk_encoder(path, mean)
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                sizes, ids, decoded = [], [], []
                for raw in enc.encode(part.column(1).to_pylist()):
                    a = np.frombuffer(raw, enc.words.dtype).astype("<u4")
                    text = enc.decode(a)
                    sizes.append(len(a))
                    ids.append(hashlib.sha256(a).hexdigest() if digests else a.tobytes())
                    decoded.append(hashlib.sha256(text).hexdigest() if digests else text.decode())
                yield pa.record_batch([part.column(0), pa.array(sizes, pa.int64()),
                                       pa.array(ids, pa.string() if digests else pa.binary()),
                                       pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(
        run, f"doc_id long, n_tokens long, ids {'string' if digests else 'binary'}, decoded string")
