"""Packing of tokenised examples into sequences under several limits at once.

Vector bin packing with the dot-product heuristic: an example's demand is a vector (tokens,
segments, loss-bearing tokens). A sequence is opened, and again and again takes the example
that fits and whose demand has the largest weighted dot product with what is left in the
sequence, so that it fills along the dimension in which it has most room. When nothing fits,
a longer example may be cut to fill the gap exactly.

Examples of equal demand are one kind, so a step looks at kinds, not at examples. Each task
packs what it reads, a piece of a batch at a time: nothing is shuffled, memory does not grow
with the table, and at most one sequence per piece is left short.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm import flat, vocabulary
from panelkit.llm.common import python_ready, quoted


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 256
    loss: int = 1024


def plan(tokens: np.ndarray, prompt: np.ndarray, limits: Limits, cut: bool = True) -> np.ndarray:
    """Rows ``example, start, length, sequence, offset``.

    ``prompt`` is the number of leading tokens of an example that bear no loss. Examples above
    a limit are always cut; with ``cut`` others are too, to fill a sequence. Examples
    without tokens get no row.
    """
    out: list[tuple[int, int, int, int, int]] = []
    pool: dict[tuple[int, int], list[tuple[int, int]]] = {}  # (tokens, loss): (example, start)
    used = 0
    for i, (n, p) in enumerate(zip(tokens.tolist(), prompt.tolist())):
        start = 0
        while start < n:
            length = min(n - start, limits.tokens, max(0, p - start) + limits.loss)
            if length == limits.tokens:
                out.append((i, start, length, used, 0))
                used += 1
            else:
                loss = max(0, start + length - max(start, p))
                pool.setdefault((length, loss), []).append((i, start))
            start += length
    if not pool:
        return np.array(out, np.int64).reshape(-1, 5)

    kinds = sorted(pool, reverse=True)
    kind_at = {k: j for j, k in enumerate(kinds)}
    size = np.array([k[0] for k in kinds], np.int64)
    loss = np.array([k[1] for k in kinds], np.int64)
    left = np.array([len(pool[k]) for k in kinds], np.int64)
    weight = np.array([(size * left).sum(), left.sum(), (loss * left).sum()], float)
    weight /= np.array([limits.tokens, limits.segments, limits.loss], float) * left.sum()
    a = weight / np.array([limits.tokens, limits.segments, limits.loss], float) ** 2
    remaining = int(left.sum())

    def add(key: tuple[int, int], item: tuple[int, int]) -> None:
        nonlocal size, loss, left, remaining
        j = kind_at.get(key)
        if j is None:
            kind_at[key] = j = len(kinds)
            kinds.append(key)
            size, loss, left = np.append(size, key[0]), np.append(loss, key[1]), np.append(left, 0)
            pool[key] = []
        pool[key].append(item)
        left[j] += 1
        remaining += 1

    while remaining:
        room, seats, bearing, offset = limits.tokens, limits.segments, limits.loss, 0
        while remaining and room and seats:
            fits = (left > 0) & (size <= room) & (loss <= bearing)
            if fits.any():
                value = a[0] * room * size + a[1] * seats + a[2] * bearing * loss
                j = int(np.where(fits, value, -1.0).argmax())
                i, start = pool[kinds[j]].pop()
                length = int(size[j])
            elif cut and bearing:
                j = int(np.where(left > 0, size, -1).argmax())
                i, start = pool[kinds[j]].pop()
                free = max(0, int(size[j]) - int(loss[j]))  # its leading tokens without loss
                length = min(room, free + bearing, int(size[j]))
                rest = int(size[j]) - length
                if rest:
                    add((rest, rest - max(0, free - length)), (i, start + length))
            else:
                break
            left[j] -= 1
            remaining -= 1
            out.append((i, start, length, used, offset))
            offset += length
            room -= length
            seats -= 1
            p = int(prompt[i])
            bearing -= max(0, start + length - max(start, p))
        used += 1
    return np.array(out, np.int64).reshape(-1, 5)


_PIECES = (
    "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
)


def pack_documents(
    df: DataFrame,
    vocabulary_file: bytes,
    doc_id: str = "doc_id",
    text: str = "text",
    limits: Limits = Limits(),
    separator: int = 0,
) -> DataFrame:
    """Pieces of tokenised documents and their places in sequences.

    A document is its ids and one ``separator``; only its first token bears no loss. Rows:
    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``, where every id lies in
    one piece, offsets in a sequence are gapless from 0, and no sequence exceeds ``limits``. A
    NULL or empty text is one separator. Repeated rows are packed each on its own. An empty
    table gives an empty result; other columns are not read.

    ``sequence_id`` holds the number of the task's partition and of the sequence in it, so a task
    that runs again makes the same rows.
    """
    python_ready(df.sparkSession)
    content = df.sparkSession.sparkContext.broadcast(vocabulary_file)
    slim = df.select(quoted(doc_id).alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))

    def run(batches):
        used = TaskContext.get().partitionId() << 36
        for batch in batches:
            for piece in flat.slices(batch, "text"):
                ids, counts = vocabulary.encode_texts(piece.column(1), content.value)
                counts = counts + 1
                ends = np.cumsum(counts)
                whole = np.full(int(ends[-1]), separator, "<u4")
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = ids
                rows = plan(counts, np.ones(len(counts), np.int64), limits)
                begin = (ends - counts)[rows[:, 0]] + rows[:, 1]
                view = memoryview(whole).cast("B")
                sums = [zlib.crc32(view[4 * b : 4 * (b + n)]) for b, n in zip(begin.tolist(), rows[:, 2].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(pa.array(rows[:, 0])),
                        pa.array(rows[:, 1]),
                        pa.array(rows[:, 2]),
                        pa.array(sums, pa.int64()),
                        pa.array(counts[rows[:, 0]]),
                        pa.array(rows[:, 3] + used),
                        pa.array(rows[:, 4]),
                    ],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
                )
                used += int(rows[:, 3].max()) + 1
    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(run, f"doc_id {kind}, {_PIECES}")
