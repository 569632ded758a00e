"""Cost-balanced packing of documents into training sequences.

A piece of n ids costs `linear * n + quadratic * n * n` (matrix products and
attention). Documents longer than a sequence give whole sequences first; what
is left of each is placed in descending length on the sequence with the lowest
cost so far that still has room. Pieces that fit nowhere are cut over what room
is left, lowest cost first, so all sequences of a group but the last are full.

Packing is done group by group within a task: a group holds as many documents
as come to GROUP_TOKENS, so memory is bounded, nothing is shuffled, and at most
one sequence a group is short. Groups are large enough that their sequences
have all but the same mean cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from palisade.llm._text import blocks
from palisade.llm._tokens import CACHE_PIECES, encoder, give_back

#: Ids gathered before a group is packed.
GROUP_TOKENS = 2_000_000
SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def assign(lengths: np.ndarray, room: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int]]:
    """Places pieces of 1..room ids: (piece, first id, ids, sequence), each id once, as few sequences as can hold all."""
    total = int(lengths.sum())
    n = -(-total // room)
    cost, free = np.zeros(n), np.full(n, room, np.int64)
    out, left = [], []
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fits = np.where(free >= size, cost, np.inf)
        s = int(fits.argmin())
        if fits[s] == np.inf:
            left.append(k)
            continue
        out.append((k, 0, size, s))
        free[s] -= size
        cost[s] += linear * size + quadratic * size * size
    for k in left:
        at, size = 0, int(lengths[k])
        while at < size:
            s = int(np.where(free > 0, cost, np.inf).argmin())
            cut = min(size - at, int(free[s]))
            out.append((k, at, cut, s))
            free[s] -= cut
            cost[s] += linear * cut + quadratic * cut * cut
            at += cut
    return out


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048, linear: float = 1.0, quadratic: float = 1.0 / 2048,
    drops_space: bool = True, group_tokens: int = GROUP_TOKENS, cache_pieces: int = CACHE_PIECES,
) -> DataFrame:
    """Packs doc_id, text of docs: one row a piece with its ids.

    doc_id, start (ids of its document before it), length, doc_tokens, sequence_id, offset (within the sequence,
    gapless from 0), ids (binary u32). Null and empty texts hold only end_id. Rows are packed as they come, so equal
    rows or doc_ids each get pieces of their own. An empty table gives no rows. sequence_id is unique, not dense:
    its upper bits number the task. cache_pieces bounds a worker's memory (about 250 bytes each), not the result.
    """
    end = int(end_id).to_bytes(4, "little")

    def packed(group: list[tuple[int | None, bytes]], sequence: int) -> tuple[dict, int]:
        rows: list[tuple] = []
        lengths, whose, begins = [], [], []
        for i, (_, ids) in enumerate(group):
            n = len(ids) // 4
            whole = n // length
            rows += [(i, k * length, length, sequence + k, 0) for k in range(whole)]
            sequence += whole
            if n % length:
                lengths.append(n % length)
                whose.append(i)
                begins.append(whole * length)
        filled: dict[int, int] = {}
        placed = assign(np.array(lengths, np.int64), length, linear, quadratic) if lengths else []
        for k, at, n, s in placed:
            rows.append((whose[k], begins[k] + at, n, sequence + s, filled.get(s, 0)))
            filled[s] = filled.get(s, 0) + n
        sequence += len(filled)
        col = lambda j: np.array([r[j] for r in rows], np.int64)
        return {
            "doc_id": pa.array([group[r[0]][0] for r in rows], pa.int64()), "start": col(1), "length": col(2),
            "doc_tokens": np.array([len(group[r[0]][1]) // 4 for r in rows], np.int64), "sequence_id": col(3), "offset": col(4),
            "ids": pa.array([group[r[0]][1][4 * r[1] : 4 * (r[1] + r[2])] for r in rows], pa.binary()),
        }, sequence

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        give_back()  # what operators before this one have left
        coder = encoder(tokenizer, drops_space, cache_pieces)
        sequence = TaskContext.get().partitionId() << 40
        group, tokens = [], 0
        for batch in batches:
            for rows, data, off in blocks(batch):
                some = batch.slice(rows.start, rows.stop - rows.start)
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), coder.encode(data, off), strict=True):
                    group.append((doc_id, ids + end))
                    tokens += len(ids) // 4 + 1
                if tokens >= group_tokens:
                    out, sequence = packed(group, sequence)
                    yield pa.RecordBatch.from_pydict(out)
                    group, tokens = [], 0
        if group:
            yield pa.RecordBatch.from_pydict(packed(group, sequence)[0])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
