"""Token-id files of patched frame-of-reference blocks.

A file holds *pages*, one a row: whole documents in ascending id order, their
token ids laid end to end and cut into blocks. A block keeps its minimum, the
differences from it packed at a width that a percentile of them fits, chosen by
the bytes it takes, and those that do not fit in an exception list. Each page indexes where its blocks
start; the index beside the pages says where each shard starts.

Edge cases: a null or empty text is the end id alone; null ids come first; rows
with equal ids are ordered by a hash of their text and kept; an empty table gives empty
files; only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpimart.llm.common import new_folder, partitions, table
from kpimart.llm.tokens import encoder

HEAD = struct.Struct("<IBHH")  # minimum, width, ids, exceptions
PAGES = ("shard int, page int, start long, n_ids long, doc_ids array<long>, n_tokens array<long>, "
         "block_starts array<long>, payload binary")
PAGES_ARROW = pa.schema([("shard", pa.int32()), ("page", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()),
                         ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
                         ("block_starts", pa.list_(pa.int64())), ("payload", pa.binary())])


def _full(width: int) -> int:
    """Bits of the smallest whole number that holds ``width`` bits."""
    return 8 if width <= 8 else 16 if width <= 16 else 32


def pack_block(ids: np.ndarray) -> bytes:
    """One block, packed at the percentile of its differences' widths that makes it smallest."""
    low = int(ids.min())
    diff = ids - np.uint32(low)
    widths = np.bincount(np.frexp(diff.astype(np.float64))[1], minlength=33)
    beyond = len(ids) - np.cumsum(widths)
    width = int(np.argmin(np.arange(33) * len(ids) + 48 * beyond))  # an exception takes 48 bits
    out = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    full = _full(width)
    bits = np.unpackbits(diff.astype(f">u{full // 8}").view(np.uint8)).reshape(-1, full)[:, full - width:]
    return b"".join((HEAD.pack(low, width, len(ids), len(out)), np.packbits(bits).tobytes(),
                     out.astype("<u2").tobytes(), diff[out].astype("<u4").tobytes()))


def unpack_block(data: bytes, at: int) -> np.ndarray:
    low, width, n, n_out = HEAD.unpack_from(data, at)
    at += HEAD.size
    size = (n * width + 7) // 8
    full = _full(width)
    bits = np.zeros((n, full), np.uint8)
    bits[:, full - width:] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width).reshape(n, width)
    diff = np.packbits(bits).view(f">u{full // 8}").astype(np.uint32)
    at += size
    where = np.frombuffer(data, "<u2", n_out, at)
    diff[where] = np.frombuffer(data, "<u4", n_out, at + 2 * n_out)
    return diff + np.uint32(low)


def _checked(block: int) -> int:
    if not 1 <= block <= 0xFFFF:
        raise ValueError(f"a block holds 1 to 65535 ids, not {block}: its counts have 16 bits")
    return block


def pack_page(ids: np.ndarray, block: int) -> tuple[bytes, list[int]]:
    blocks = [pack_block(ids[i:i + block]) for i in range(0, len(ids), block)]
    starts = np.cumsum([0, *map(len, blocks)])[:-1].tolist()
    return b"".join(blocks), starts


def unpack_page(payload: bytes, starts) -> np.ndarray:
    parts = [unpack_block(payload, int(s)) for s in starts]
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", block: int = 2048, page_ids: int = 65_536) -> None:
    """Write ``docs`` as token files under ``path`` (``pages`` and ``index``).

    The table is range-partitioned by id and each partition is one shard, so
    shards follow one another in id order. A page closes at the first document
    that brings it to ``page_ids`` ids.
    """
    end, block = np.asarray([end_id], "<u4").tobytes(), _checked(block)

    def pages(batches):
        enc, shard = encoder(tokenizer), TaskContext.get().partitionId()
        page, start, size, held, names, lens = 0, 0, 0, [], [], []

        def close():
            ids = np.frombuffer(b"".join(held), "<u4")
            payload, starts = pack_page(ids, block)
            return pa.RecordBatch.from_pylist([{"shard": shard, "page": page, "start": start, "n_ids": len(ids), "doc_ids": names,
                                                "n_tokens": lens, "block_starts": starts, "payload": payload}], PAGES_ARROW)

        for batch in batches:
            for doc_id, ids in zip(batch.column("id").to_pylist(), enc.texts(batch.column("text").to_pylist()), strict=True):
                held += ids, end
                names.append(doc_id)
                lens.append(len(ids) // 4 + 1)
                size += lens[-1]
                if size >= page_ids:
                    yield close()
                    page, start, size, held, names, lens = page + 1, start + size, 0, [], [], []
        if lens:
            yield close()

    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("mark"))
    dealt = rows.repartitionByRange(partitions(spark), "id", "mark").sortWithinPartitions("id", "mark", "text")
    dealt.mapInArrow(pages, PAGES).write.parquet(f"{path}/pages")
    # One row for each partition written: prefix sums over them fit one task.
    shards = spark.read.schema(PAGES).parquet(f"{path}/pages").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first")).coalesce(1).write.parquet(
        f"{path}/index")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens and ids (binary, little-endian unsigned 32-bit)."""

    def documents(batches):
        for batch in batches:
            for first, names, lens, starts, payload in zip(*map(batch.column, names_in), strict=True):
                data = unpack_page(payload.as_py(), starts.as_py()).astype("<u4")
                ends = np.append(0, np.cumsum(lens.values.to_numpy()))
                ids = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.array(4 * ends, pa.int32()).buffers()[1], pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([names.values, pa.array(ends[:-1] + first.as_py()), lens.values, ids],
                                                 ["doc_id", "start", "n_tokens", "ids"])

    names_in = ["first", "doc_ids", "n_tokens", "block_starts", "payload"]
    pages = spark.read.schema(PAGES).parquet(f"{path}/pages")
    index = spark.read.schema("shard int, first long").parquet(f"{path}/index")  # a row a partition: small
    at = pages.join(F.broadcast(index), "shard").select((F.col("first") + F.col("start")).alias("first"), "doc_ids",
                                                        "n_tokens", "block_starts", "payload")
    return at.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_folder(spark, "op10")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 2)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
