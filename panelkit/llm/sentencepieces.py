"""Byte-level BPE vocabularies run by sentencepiece.

A sentencepiece model is written straight from the vocabulary, without training: every token
is a piece, its bytes mapped to printable characters; the score of a piece is its negative
rank, so the pair with the lowest rank merges first; normalisation is the identity. Pre-tokens
are encoded one by one in mapped form; ids are decoded through the inverse mapping of their
pieces.
"""

from __future__ import annotations

import functools
import hashlib
import struct

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from panelkit.llm import flat
from panelkit.llm.common import python_ready, quoted
from panelkit.llm.pretokens import Encoder
from panelkit.llm.vocabulary import byte_letters, ranks_of

# Field numbers and values of the public model format.
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_PIECE, _SCORE, _TYPE = 1, 2, 3
_NORMAL, _UNKNOWN = 1, 2
_MODEL_TYPE, _BPE, _VOCAB_SIZE = 3, 2, 4
_UNK_ID, _BOS_ID, _EOS_ID, _PAD_ID = 40, 41, 42, 43
_NAME, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES = 1, 3, 4, 5


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def _float(field: int, x: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", x)


def serialise(ranks: dict[bytes, int]) -> tuple[bytes, np.ndarray]:
    """The model, and the rank of each of its piece ids. Piece 0 is the unknown piece."""
    letters = byte_letters()
    ordered = sorted(ranks, key=ranks.__getitem__)
    out = [_block(_PIECES, _block(_PIECE, b"<unk>") + _float(_SCORE, 0.0) + _number(_TYPE, _UNKNOWN))]
    for token in ordered:
        name = "".join(letters[b] for b in token).encode()
        piece = _block(_PIECE, name) + _float(_SCORE, -float(ranks[token])) + _number(_TYPE, _NORMAL)
        out.append(_block(_PIECES, piece))
    trainer = _number(_MODEL_TYPE, _BPE) + _number(_VOCAB_SIZE, len(ordered) + 1) + _number(_UNK_ID, 0)
    trainer += b"".join(_number(f, -1) for f in (_BOS_ID, _EOS_ID, _PAD_ID))
    out.append(_block(_TRAINER, trainer))
    plain = _block(_NAME, b"identity")
    plain += b"".join(_number(f, 0) for f in (_DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE_SPACES))
    out.append(_block(_NORMALIZER, plain))
    return b"".join(out), np.array([0, *(ranks[t] for t in ordered)], np.uint32)


class Codec:
    """Encodes pieces to ranks and decodes ranks to bytes with one serialised model."""

    def __init__(self, ranks: dict[bytes, int]):
        model, self.rank = serialise(ranks)
        self.ranks = ranks
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        letters = byte_letters()
        self.letters = dict(enumerate(letters))
        back = {c: b for b, c in enumerate(letters)}
        names = [self.processor.id_to_piece(i) for i in range(1, self.processor.get_piece_size())]
        tokens = [bytes(back[c] for c in name) for name in names]
        highest = int(self.rank.max())
        self.sizes = np.zeros(highest + 2, np.int64)
        self.sizes[self.rank[1:]] = [len(t) for t in tokens]
        self.begin = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.place = np.zeros(highest + 2, np.int64)
        self.place[self.rank[1:]] = self.begin[:-1]
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, solid: list[bytes], blank: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces; a piece that is a token by itself is that token."""
        pieces = solid + blank
        known = [self.ranks.get(p) for p in pieces]
        rest = [p.decode("latin-1").translate(self.letters) for p, k in zip(pieces, known) if k is None]
        merged = iter(self.processor.encode(rest, num_threads=1) if rest else [])
        parts, counts = [], []
        for k in known:
            found = [k] if k is not None else self.rank[next(merged)]
            parts.append(found)
            counts.append(len(found))
        ids = np.concatenate(parts).astype(np.uint32) if parts else np.zeros(0, np.uint32)
        return ids, np.array(counts, np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other."""
        size, begin = self.sizes[ids], self.place[ids]
        total = int(size.sum())
        where = np.arange(total) - np.repeat(np.cumsum(size) - size - begin, size)
        return self.bytes[where]


@functools.lru_cache(maxsize=2)
def codec(content: bytes) -> tuple[Codec, Encoder]:
    """A worker process keeps the model and the ids it remembers between tasks."""
    own = Codec(ranks_of(content)[0])
    return own, Encoder(own.encode)


def encode_and_decode(
    df: DataFrame, vocabulary_file: bytes, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each text, and the bytes they decode to.

    No special tokens: their strings are ordinary text. A NULL text is empty and has no ids.
    Equal texts get equal ids. An empty table gives an empty result; other columns are not
    read. One pass, no shuffle.
    """
    return _run(df, vocabulary_file, doc_id, text, "ids array<bigint>, decoded binary", _whole)


def _whole(ids: np.ndarray, decoded: np.ndarray, id_ends, byte_ends) -> list[pa.Array]:
    heads = pa.array(np.concatenate([[0], id_ends]).astype(np.int32))
    lists = pa.ListArray.from_arrays(heads, pa.array(ids.astype(np.int64)))
    raw, begin = decoded.tobytes(), np.concatenate([[0], byte_ends[:-1]])
    return [lists, pa.array([raw[a:b] for a, b in zip(begin.tolist(), byte_ends.tolist())], pa.binary())]


def digests(df: DataFrame, vocabulary_file: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what :func:`encode_and_decode` finds."""
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _run(df, vocabulary_file, doc_id, text, schema, _digests)


def _digests(ids: np.ndarray, decoded: np.ndarray, id_ends, byte_ends) -> list[pa.Array]:
    packed = memoryview(ids.astype("<u4").tobytes())
    raw = memoryview(decoded.tobytes())
    hashed = []
    for view, ends, width in ((packed, id_ends, 4), (raw, byte_ends, 1)):
        begin = np.concatenate([[0], ends[:-1]])
        spots = zip((begin * width).tolist(), (ends * width).tolist())
        hashed.append(pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in spots], pa.string()))
    return [pa.array(np.diff(np.concatenate([[0], id_ends]))), *hashed]


def _run(df: DataFrame, vocabulary_file: bytes, doc_id: str, text: str, schema: str, columns) -> DataFrame:
    python_ready(df.sparkSession)
    content = df.sparkSession.sparkContext.broadcast(vocabulary_file)
    slim = df.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    names = ["doc_id", *[c.split()[0] for c in schema.split(", ")]]

    def run(batches):
        own, encoder = codec(content.value)
        for batch in batches:
            for piece in flat.slices(batch, "text"):
                ids, counts = encoder(*flat.flatten(piece.column(1)))
                ends = np.cumsum(counts).astype(np.int64)
                bytes_upto = np.concatenate([[0], np.cumsum(own.sizes[ids])])
                found = columns(ids, own.decode(ids), ends, bytes_upto[ends])
                yield pa.RecordBatch.from_arrays([piece.column(0), *found], names)

    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, {schema}")
