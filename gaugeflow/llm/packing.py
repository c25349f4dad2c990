"""Packing token sequences: best fit per partition, then underfull bins merged in a tree.

Every partition cuts its documents into pieces and packs them best-fit decreasing. Bins that are
nearly full are final. The others go on as items: the bins of ``fan`` partitions meet in one task,
which packs them again, and so on until one node is left. What a node passes on is bounded by
``carry`` bins, so a task never holds more than ``fan * carry`` of them however large the table is.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.tokens import word_tokenizer
from gaugeflow.session import write_out

ID_BYTES = 4
#: Pieces that a partition packs at once.
WINDOW = 200_000

_PLACED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("node", pa.int64()),
        ("final", pa.bool_()),
    ]
)
_WITH_IDS = _PLACED.append(pa.field("ids", pa.binary()))
_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
_SQL += "offset long, node long, final boolean"


def best_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of every item, and the fill of every bin.

    Open bins are kept by what is left in them; a bit set of the amounts that occur finds the
    smallest one that suffices.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_rest: list[list[int]] = [[] for _ in range(room + 1)]
    rests, fills = 0, []
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        if fitting := rests >> size:
            rest = size + (fitting & -fitting).bit_length() - 1
            b = by_rest[rest].pop()
            if not by_rest[rest]:
                rests ^= 1 << rest
        else:
            b, rest = len(fills), room
            fills.append(0)
        bins[i], offsets[i] = b, room - rest
        fills[b] += size
        if rest > size:
            by_rest[rest - size].append(b)
            rests |= 1 << (rest - size)
    return bins, offsets, np.array(fills, np.int64)


def _number(level: int, node: int, first: int = 0) -> int:
    """The first of 2**28 numbers of a node's sequences, from ``first`` on."""
    return (level << 56) | (node << 28) | first


def _final(fills: np.ndarray, room: int, slack: int, carry: int) -> np.ndarray:
    """Which bins are final: the nearly full, and all but the ``carry`` emptiest."""
    final = fills >= room - slack
    if (~final).sum() > carry:
        final[np.argsort(fills, kind="stable")[carry:]] = True
    return final


def _cut(doc_id, ids: bytes, end: bytes, room: int) -> Iterator[tuple]:
    ids += end
    for piece, at in enumerate(range(0, len(ids), room * ID_BYTES)):
        part = ids[at : at + room * ID_BYTES]
        yield doc_id, piece, at // ID_BYTES, len(part) // ID_BYTES, zlib.crc32(part), part


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 4096,
    end_id: int = 1,
    slack: int = 64,
    fan: int = 16,
    carry: int = 4096,
    with_ids: bool = False,
    plain_special: bool = True,
) -> DataFrame:
    """Place the token ids of every ``text`` in sequences of at most ``length`` ids.

    A document is the ids of its text by the ``tokenizer`` file and ``end_id``; longer ones are cut
    into pieces of ``length``. One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``, and ``ids`` (little-endian unsigned 32-bit) if ``with_ids``. The tokenizer's
    special strings are text as any other if ``plain_special``, and else the ids that they stand for,
    which is the default of the library and what the query and the pipeline do.

    A bin with at most ``slack`` ids missing is final in the round that made it. Null and empty
    texts are a piece of one id. Repeated rows and repeated or null ``doc_id`` are packed as they
    are, each row for itself; other columns are not read. An empty table gives an empty result.
    """
    schema, sql = (_WITH_IDS, f"{_SQL}, ids binary") if with_ids else (_PLACED, _SQL)
    end = np.array([end_id], "<u4").tobytes()

    def table(pieces: list[tuple], bins, offsets, final, node: int, first: int) -> pa.RecordBatch:
        columns = [list(c) for c in zip(*pieces, strict=True)]
        columns[5:5] = [_number(0, node, first) + bins, offsets, np.full(len(bins), node), final]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)], schema=schema
        )

    def locally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer, plain_special)
        node, first, held = TaskContext.get().partitionId(), 0, []

        def packed(pieces: list[tuple]) -> pa.RecordBatch:
            nonlocal first
            bins, offsets, fills = best_fit(np.array([p[3] for p in pieces]), length)
            final = _final(fills, length, slack, carry)[bins]
            out = table(pieces, bins, offsets, final, node, first)
            first += len(fills)
            return out

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for doc_id, text in zip(ids, texts, strict=True):
                held += [
                    p if with_ids else (*p[:5], None)
                    for p in _cut(doc_id, words.ids(text.as_py()), end, length)
                ]
                if len(held) >= WINDOW:
                    yield packed(held)
                    held = []
        if held:
            yield packed(held)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    placed = write_out(source.mapInArrow(locally, sql), "pieces")
    nodes = placed.agg(F.max("node")).first()[0]
    done, level = [placed.where("final")], 0
    rest = placed.where("NOT final")
    while nodes is not None and (nodes > 0 or level == 0):
        level, nodes = level + 1, nodes // fan
        merged = _merge(rest, sql, level, fan, nodes == 0, length, slack, carry)
        if nodes > 0:
            merged = write_out(merged, "merged-pieces")
        done.append(merged.where("final"))
        rest = merged.where("NOT final")
    return reduce(DataFrame.unionByName, done).drop("node", "final")


def _merge(
    rest: DataFrame, sql: str, level: int, fan: int, last: bool, room: int, slack: int, carry: int
) -> DataFrame:
    """Pack the bins of ``fan`` nodes as items of one."""

    def node_bins(key: tuple, pieces: pa.Table) -> pa.Table:
        node = key[0].as_py()
        bin_of = pieces.column("sequence_id").to_numpy()
        offset, size = pieces.column("offset").to_numpy(), pieces.column("length").to_numpy()
        names, item = np.unique(bin_of, return_inverse=True)
        fills = np.bincount(item, size, len(names)).astype(np.int64)
        bins, offsets, full = best_fit(fills, room)
        final = np.ones(len(full), bool) if last else _final(full, room, slack, carry)
        new = {
            "sequence_id": pa.array(_number(level, node) + bins[item]),
            "offset": pa.array(offset + offsets[item]),
            "node": pa.array(np.full(len(item), node)),
            "final": pa.array(final[bins[item]]),
        }
        for name, column in new.items():
            pieces = pieces.set_column(pieces.schema.get_field_index(name), name, column)
        return pieces

    grouped = rest.withColumn("node", F.expr(f"node div {fan}")).groupBy("node")
    return grouped.applyInArrow(node_bins, sql)
