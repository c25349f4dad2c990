"""A file of token ids: frequency ranks in byte-aligned variable-length coding.

The files are two Parquet tables below one path, so that they can lie in any store Spark writes to
and a lost task leaves nothing behind:

``ranks``   ``rank int, id long``: ids by falling frequency over the whole corpus.
``blocks``  one row per block of documents, in ascending ``doc_id`` order: ``shard int``, ``first
            long`` (ids of the shard before the block), ``doc_ids``, ``lengths``, ``control binary``
            and ``data binary``.

In a block every rank has two control bits and 0, 1, 2 or 4 bytes of data, least first; four ranks
share a control byte, lowest bits first. Rank 0 needs no data at all. Control and data bytes are kept
apart, so a block is decoded by table lookup: a control byte gives the length of its four ranks and
where their bytes lie.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeflow.llm.tokens import word_tokenizer
from gaugeflow.session import write_out

#: Data bytes of a rank, by its two control bits.
BYTES = np.array([0, 1, 2, 4])
#: Ids in a shard and in a block, about. A shard is sorted, and its blocks go to Python, in one task.
SHARD_IDS, BLOCK_IDS = 1 << 23, 1 << 16

_CODES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
_SIZES = BYTES[_CODES]
#: Data bytes of the four ranks of a control byte.
_TOTAL = _SIZES.sum(axis=1)
#: For each of their 16 bytes, where it lies in the data; 16 stands for a zero byte.
_PLACE = np.where(
    np.arange(4) < _SIZES[:, :, None],
    (_SIZES.cumsum(axis=1) - _SIZES)[:, :, None] + np.arange(4),
    16,
)
#: The same for the lower bytes of each rank, by how many they are.
_PLACES = {n: _PLACE[:, :, :n].reshape(256, -1) for n in (2, 4)}
#: Whether a control byte has a rank of four bytes.
_WIDE = (_CODES == 3).any(axis=1)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of ``ranks``."""
    padded = np.zeros(-(-len(ranks) // 4) * 4, "<u4")
    padded[: len(ranks)] = ranks
    width = 4 if padded.max(initial=0) > 0xFFFF else 2
    used = np.empty((len(padded), width), bool)
    used[:, 0], used[:, 1] = padded > 0, padded > 0xFF
    codes = used[:, 0].astype(np.uint8) + used[:, 1]
    if width == 4:
        used[:, 2:] = (padded > 0xFFFF)[:, None]
        codes += used[:, 2]
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = padded.astype(f"<u{width}").view(np.uint8).reshape(-1, width)[used]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The first ``count`` ranks of a block."""
    groups = np.frombuffer(control, np.uint8)
    width = 4 if _WIDE[groups].any() else 2
    starts = _TOTAL[groups].cumsum() - _TOTAL[groups]
    place = _PLACES[width][groups]
    spare = len(data)
    at = np.where(place < 16, starts[:, None] + place, spare)
    found = np.frombuffer(data + b"\0", np.uint8)[at]
    return found.view(f"<u{width}").reshape(-1)[:count].astype("<u4")


#: Ids of a document, or how often each id occurs in a task's documents.
_TOKENS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("crc", pa.int64()),
        ("ids", pa.binary()),
        ("counts", pa.binary()),
    ]
)
_BLOCKS = pa.schema(
    [
        ("shard", pa.int32()),
        ("first", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("control", pa.binary()),
        ("data", pa.binary()),
    ]
)


def _tokenised(docs: DataFrame, tokenizer: str, end_id: int, plain_special: bool) -> DataFrame:
    """Ids of every document, compressed, as they are shuffled later; and the id counts of each task,
    one row without ``ids``."""
    end = np.array([end_id], "<u4").tobytes()

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokenizer(tokenizer, plain_special)
        packed, total = zstandard.ZstdCompressor(level=1), np.zeros(0, np.int64)

        def rows(doc_ids: pa.Array, *columns: list) -> pa.RecordBatch:
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(_TOKENS)[1:], strict=True)]
            return pa.RecordBatch.from_arrays([doc_ids, *arrays], schema=_TOKENS)

        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                found = [words.ids(t.as_py()) + end for t in part.column("text")]
                some = np.bincount(np.frombuffer(b"".join(found), "<u4"), minlength=len(total))
                some[: len(total)] += total
                total = some
                yield rows(
                    part.column("doc_id"),
                    [len(x) // 4 for x in found],
                    [zlib.crc32(x) for x in found],
                    [packed.compress(_narrow(x)) for x in found],
                    [None] * len(found),
                )
        if len(total):
            none = pa.array([None], pa.int64())
            yield rows(none, [0], [0], [None], [packed.compress(total.astype("<i8").tobytes())])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sql = "doc_id long, n_tokens long, crc long, ids binary, counts binary"
    return write_out(source.mapInArrow(ids, sql), "token-ids")


def _narrow(ids: bytes) -> bytes:
    """Low halves of the ids, then high halves: the second half compresses to nothing."""
    return np.frombuffer(ids, "<u2").reshape(-1, 2).T.tobytes()


def _widen(packed: bytes, opener: zstandard.ZstdDecompressor) -> np.ndarray:
    halves = np.frombuffer(opener.decompress(packed), "<u2").reshape(2, -1)
    return np.ascontiguousarray(halves.T).view("<u4").reshape(-1)


def _ranking(tokens: DataFrame) -> DataFrame:
    """Ids by falling frequency: as many rows as the vocabulary has ids in use."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for packed in batch.column("counts").to_pylist():
                total = np.frombuffer(opener.decompress(packed), "<i8")
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict({"id": used.astype(np.int64), "n": total[used]})

    counted = tokens.select("counts").where("counts IS NOT NULL").mapInArrow(counts, "id long, n long")
    order = Window.orderBy(F.desc("n"), "id")
    return (
        counted.groupBy("id")
        .agg(F.sum("n").alias("n"))
        .select((F.row_number().over(order) - 1).alias("rank"), "id")
    )


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, plain_special: bool = True
) -> None:
    """Write the ids of every ``text``, each followed by ``end_id``, below ``path``.

    Null and empty texts are the end id alone. Rows with the same ``doc_id`` follow each other in
    the order of their ids' checksum; null ids come first; other columns are not read. An empty
    table gives files without blocks. The tokenizer's special strings are text as any other if
    ``plain_special``, and else the ids that they stand for, as by default in the library.
    """
    spark = docs.sparkSession
    tokens = _tokenised(docs, tokenizer, end_id, plain_special)
    _ranking(tokens).write.parquet(f"{path}/ranks")
    # as many rows as the vocabulary has ids
    by_rank = [r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]
    rank_of = np.zeros(max(by_rank, default=0) + 1, "<u4")
    rank_of[by_rank] = np.arange(len(by_rank))
    ranks = spark.sparkContext.broadcast(rank_of)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_tokenizer.cache_clear()  # the worker may keep the pieces of an earlier stage
        shard, first, opener = TaskContext.get().partitionId(), 0, zstandard.ZstdDecompressor()
        doc_ids, held, waiting = [], [], 0

        def block() -> pa.RecordBatch:
            control, data = encode_ranks(ranks.value[np.concatenate(held)])
            row = [shard, first, doc_ids, [len(x) for x in held], control, data]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip(row, _BLOCKS, strict=True)], schema=_BLOCKS
            )

        for batch in batches:
            for doc_id, packed in zip(
                batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True
            ):
                doc_ids.append(doc_id)
                held.append(_widen(packed.as_py(), opener))
                waiting += len(held[-1])
                if waiting >= BLOCK_IDS:
                    yield block()
                    first, doc_ids, held, waiting = first + waiting, [], [], 0
        if held:
            yield block()

    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-total // SHARD_IDS))
    # equal rows are dealt to several shards by a number that has no other meaning
    rows = tokens.where("ids IS NOT NULL").withColumn("deal", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(shards, "doc_id", "crc", "deal")
    ordered = ordered.sortWithinPartitions("doc_id", "crc", "deal").select("doc_id", "ids")
    sql = "shard int, first long, doc_ids array<long>, lengths array<long>, "
    ordered.mapInArrow(blocks, f"{sql}control binary, data binary").write.parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents in the files below ``path``: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before; ``with_ids`` adds ``ids array<long>``.
    """
    table = spark.read.parquet(f"{path}/blocks")
    # as many rows as the vocabulary has ids
    by_rank = [r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]
    ids_of = spark.sparkContext.broadcast(np.array(by_rank, "<u4"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_tokenizer.cache_clear()
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                lengths = np.array(row["lengths"], np.int64)
                ends = lengths.cumsum()
                ids = ids_of.value[decode_ranks(row["control"], row["data"], int(ends[-1]))]
                each = np.split(ids, ends[:-1])
                out = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "shard": pa.array([row["shard"]] * len(each), pa.int32()),
                    "at": pa.array(row["first"] + ends - lengths),
                    "n_tokens": pa.array(lengths),
                    "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([x.tolist() for x in each], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    sql = "doc_id long, shard int, at long, n_tokens long, ids_crc32 long"
    found = table.mapInArrow(documents, f"{sql}, ids array<long>" if with_ids else sql)
    sizes = table.groupBy("shard").agg(
        F.sum(F.expr("aggregate(lengths, 0L, (a, b) -> a + b)")).alias("size")
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    columns = ["doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"]
    return found.join(bases, "shard").select(*columns, *(["ids"] if with_ids else []))
