"""Byte-level BPE vocabularies from their public files."""

from __future__ import annotations

import base64
import functools
import json

import numpy as np
import pyarrow as pa
import regex
import tiktoken

from panelkit.llm import flat
from panelkit.llm.pretokens import Encoder

# The usual cutting pattern of these vocabularies (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in such a vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for the characters from 256 on.
    """
    out, spare = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def ranks_of(content: bytes) -> tuple[dict[bytes, int], dict[str, int]]:
    """Token bytes to ids, and special tokens to ids.

    ``content`` is a file of base64 tokens with ranks, or a tokenizer in JSON whose merges
    are in the order of their ids.
    """
    if not content.lstrip().startswith(b"{"):
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}, {}
    whole = json.loads(content)
    special = {t["content"]: t["id"] for t in whole.get("added_tokens", [])}
    back = {c: b for b, c in enumerate(byte_letters())}
    vocab = whole["model"]["vocab"].items()
    return {bytes(back[c] for c in token): i for token, i in vocab if token not in special}, special


class Merges:
    """Encodes pieces by the merges of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.core = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)

    def __call__(self, solid: list[bytes], blank: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each piece.

        ``solid`` pieces do not end in white space; they go through in one call, a line each,
        and the ids of the line ends are taken out again.
        """
        parts, counts = [], []
        if solid:
            found = np.array(self.core.encode_ordinary(b"\n".join(solid).decode()), np.uint32)
            sizes = np.fromiter(map(len, solid), np.int64, len(solid))
            breaks = np.cumsum(sizes + 1)[:-1]  # the position after each line end
            upto = np.cumsum(self.size[found])
            line_ends = np.searchsorted(upto, breaks)
            if (upto[line_ends] != breaks).any() or (self.size[found[line_ends]] != 1).any():
                raise ValueError("a token crosses the end of a piece")
            keep = np.ones(len(found), bool)
            keep[line_ends] = False
            parts.append(found[keep])
            counts.append(np.diff(np.concatenate([[-1], line_ends, [len(found)]])) - 1)
        for piece in blank:
            parts.append(np.array(self.core.encode_ordinary(piece.decode()), np.uint32))
            counts.append(np.array([len(parts[-1])]))
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(parts), np.concatenate(counts)


@functools.lru_cache(maxsize=2)
def merges(content: bytes) -> tuple[Encoder, dict[str, int]]:
    """The encoder of a vocabulary; a worker process keeps it, and its memory, between tasks."""
    ranks, special = ranks_of(content)
    return Encoder(Merges(ranks)), special


def encode_texts(column, content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a string column and the number of ids of each text.

    Strings of special tokens in a text are those tokens. NULL is an empty text.
    """
    encoder, special = merges(content)
    data, offsets = flat.flatten(column)
    raw = data.tobytes() if special else b""
    if not any(s.encode() in raw for s in special):
        return encoder(data, offsets)
    cutter = regex.compile("(" + "|".join(regex.escape(s) for s in special) + ")")
    parts, owner = [], []
    for i in range(len(offsets) - 1):
        for part in cutter.split(raw[offsets[i] : offsets[i + 1]].decode()):
            parts.append(part)
            owner.append(i)
    ordinary = pa.array([None if p in special else p for p in parts], pa.string())
    ids, counts = encoder(*flat.flatten(ordinary))
    marked = [special.get(p) for p in parts]
    pieces, at, total = [], 0, np.zeros(len(offsets) - 1, np.int64)
    for i, mark, n in zip(owner, marked, counts.tolist()):
        piece = ids[at : at + n] if mark is None else np.array([mark], np.uint32)
        at += n
        pieces.append(piece)
        total[i] += len(piece)
    return np.concatenate(pieces), total
