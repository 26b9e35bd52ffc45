"""Byte-level BPE by batched merge rounds.

The distinct pieces of a batch lie in one flat array of symbols. Each round looks up the rank
of every new pair of neighbours by binary search in the sorted pair keys, finds the lowest rank
of each piece, merges all its places from left to right, and takes out the pieces that have no
known pair left. Ids are decoded through the inverse mapping of the vocabulary's letters.
"""

from __future__ import annotations

import functools
import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from panelkit.llm import flat
from panelkit.llm.common import python_ready, quoted
from panelkit.llm.pretokens import Encoder
from panelkit.llm.vocabulary import byte_letters

_NONE = np.iinfo(np.int64).max  # the rank of a pair that is not merged


class Rounds:
    """The merges of a vocabulary, applied to many pieces at a time.

    ``pairs`` maps a pair of ids to the rank of its merge and the id it becomes; ``first`` is
    the id of each byte.
    """

    def __init__(self, first: np.ndarray, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.first = first.astype(np.int64)
        self.width = 1 + max([*first.tolist(), *(max(*p, new) for p, (_, new) in pairs.items())])
        keys = np.array([a * self.width + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        # a key above all others ends the table, so that every search finds a place in it
        self.keys = np.append(keys[order], _NONE)
        made = np.array(list(pairs.values()), np.int64).reshape(-1, 2)[order]
        self.ranks, self.made = np.append(made[:, 0], _NONE), made[:, 1]
        self.key_of = np.zeros(1 + int(made[:, 0].max(initial=0)), np.int64)
        self.key_of[made[:, 0]] = np.arange(len(made))
        # With merges in training order, a pair that contains a new symbol ranks behind the merge
        # that made it; then all places of the lowest rank can be merged in one round.
        born = {new: rank for rank, new in made.tolist()}
        self.ordered = all(r > max(born.get(a, -1), born.get(b, -1)) for (a, b), (r, _) in pairs.items())

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def __call__(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces that lie in ``data`` one after the other, and their numbers."""
        symbols, owner = self.first[data], np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbols), _NONE)  # of the pair that a symbol begins
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
        done_symbols, done_owner = [], []
        while len(symbols):
            heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.append(heads, len(owner)))
            lowest = np.minimum.reduceat(rank, heads)
            over = np.repeat(lowest == _NONE, size)
            if over.any():
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                symbols, owner, rank = symbols[~over], owner[~over], rank[~over]
                size, lowest = size[lowest != _NONE], lowest[lowest != _NONE]
                if not len(symbols):
                    break
            places = np.flatnonzero(rank == np.repeat(lowest, size))
            places = self._chosen(places, owner)
            symbols, owner, rank = self._merged(places, symbols, owner, rank)
        if not done_symbols:
            return np.zeros(0, np.uint32), np.zeros(len(sizes), np.int64)
        whole = np.concatenate(done_owner)
        order = np.argsort(whole, kind="stable")
        ids = np.concatenate(done_symbols)[order].astype(np.uint32)
        return ids, np.bincount(whole, minlength=len(sizes))

    def _chosen(self, places: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Of places that share a symbol the first, third and so on; one a piece without an order."""
        if not self.ordered:
            return places[np.unique(owner[places], return_index=True)[1]]
        run = np.concatenate([[True], np.diff(places) != 1])
        first = np.flatnonzero(run)
        step = np.arange(len(places)) - np.repeat(first, np.diff(np.append(first, len(places))))
        return places[step % 2 == 0]

    def _merged(self, places, symbols, owner, rank):
        symbols[places] = self.made[self.key_of[rank[places]]]
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        moved = places - np.arange(len(places))  # each place before it lost one symbol
        symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
        changed = np.concatenate([moved, moved[moved > 0] - 1])
        rank[changed] = _NONE
        inner = changed[changed + 1 < len(symbols)]
        inner = inner[owner[inner] == owner[inner + 1]]
        rank[inner] = self._rank(symbols[inner], symbols[inner + 1])
        return symbols, owner, rank


class Tokenizer:
    """Encodes and decodes texts by a byte-level tokenizer in JSON."""

    def __init__(self, content: bytes):
        whole = json.loads(content)
        vocab, letters = whole["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in whole.get("added_tokens", [])}
        first = np.array([vocab[c] for c in letters], np.int64)
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(whole["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.rounds = Rounds(first, pairs)
        self.encoder = Encoder(self._encode_pieces)
        back = {c: bytes([b]) for b, c in enumerate(letters)}
        tokens = {i: b"".join(back[c] for c in name) for name, i in vocab.items() if name not in self.special}
        tokens |= {i: name.encode() for name, i in self.special.items()}
        listed = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.sizes = np.array([len(t) for t in listed], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(listed), np.uint8)
        self.cutter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def _encode_pieces(self, solid: list[bytes], blank: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        pieces = solid + blank
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return self.rounds(np.frombuffer(b"".join(pieces), np.uint8), sizes)

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column, and the number of ids of each text; NULL is empty.

        A special token's string in a text is that token.
        """
        data, offsets = flat.flatten(column)
        raw = data.tobytes() if self.special else b""
        if not any(s.encode() in raw for s in self.special):
            return self.encoder(data, offsets)
        texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        parts = [self.cutter.split(t) for t in texts]  # ordinary and special in turn
        owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        every = [p for own in parts for p in own]
        mark = np.array([self.special.get(p, -1) for p in every], np.int64)
        plain = pa.array(["" if m >= 0 else p for p, m in zip(every, mark.tolist())], pa.large_string())
        ids, counts = self.encoder(*flat.flatten(plain))
        ends = np.cumsum(counts)
        ids = np.insert(ids, ends[mark >= 0], mark[mark >= 0].astype(np.uint32))
        counts = counts + (mark >= 0)
        return ids, np.bincount(owner, weights=counts, minlength=len(parts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The text of each run of ids in UTF-8; bytes that are none become U+FFFD."""
        size = self.sizes[ids]
        ends = np.cumsum(size)
        where = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - self.begin[ids], size)
        raw = self.bytes[where].tobytes()
        upto = np.concatenate([[0], ends])[np.cumsum(counts)].tolist()
        found = [raw[a:b] for a, b in zip([0, *upto[:-1]], upto)]
        return [t.decode("utf-8", "replace").encode() for t in found]


@functools.lru_cache(maxsize=2)
def tokenizer(content: bytes) -> Tokenizer:
    """A worker process keeps the merges and the pieces it remembers between tasks."""
    return Tokenizer(content)


def encode_and_decode(df: DataFrame, tokenizer_file: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each text, and the text they decode to.

    A special token's string in a text is that token; none is added. A NULL text is empty and
    has no ids. Equal texts get equal ids, repeated rows stay repeated. ``doc_id`` may have any
    type and be NULL. An empty table gives an empty result; other columns are not read. One
    pass, no shuffle. One text has to fit in a worker.
    """

    def columns(ids, counts, decoded):
        heads = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        return [pa.ListArray.from_arrays(heads, pa.array(ids.astype(np.int64))), pa.array(decoded).cast(pa.string())]

    return _run(df, tokenizer_file, doc_id, text, "ids array<bigint>, decoded string", columns)


def digests(df: DataFrame, tokenizer_file: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what :func:`encode_and_decode` finds.

    Rows, NULLs and special tokens as there.
    """

    def columns(ids, counts, decoded):
        packed, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        own = [hashlib.sha256(packed[a:b]).hexdigest() for a, b in zip([0, *ends[:-1]], ends)]
        return [
            pa.array(counts, pa.int64()),
            pa.array(own, pa.string()),
            pa.array([hashlib.sha256(t).hexdigest() for t in decoded], pa.string()),
        ]

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _run(df, tokenizer_file, doc_id, text, schema, columns)


def _run(df: DataFrame, tokenizer_file: bytes, doc_id: str, text: str, schema: str, columns) -> DataFrame:
    python_ready(df.sparkSession)
    content = df.sparkSession.sparkContext.broadcast(tokenizer_file)
    slim = df.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    names = ["doc_id", *[c.split()[0] for c in schema.split(", ")]]

    def run(batches):
        own = tokenizer(content.value)
        for batch in batches:
            for piece in flat.slices(batch, "text"):
                ids, counts = own.encode(piece.column(1))
                found = columns(ids, counts, own.decode(ids, counts))
                yield pa.RecordBatch.from_arrays([piece.column(0), *found], names)

    return slim.mapInArrow(run, f"doc_id {dict(slim.dtypes)['doc_id']}, {schema}")
