"""Token ids of documents in ORC files.

One row per document in ascending id order, integer run-length encoding by the format, row
indexes every `ROW_INDEX_ROWS` rows and a Bloom filter on the document ids: a reader takes
stripes in parallel and skips those that hold none of the ids asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .shared import once, prepared
from .tokens import encoded_runs, encoder

ROW_INDEX_ROWS = 1_000
STRIPE_BYTES = 64 << 20
SCHEMA = "doc_id bigint, part int, first bigint, n_ids int, ids array<int>"


def _encode(path: str, cut: str, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of each text and the end id; `first`: ids before the document in its part."""
        encode_units, part, before = encoder(path, cut), TaskContext.get().partitionId(), 0
        for batch in batches:
            ids_of, texts = batch["doc_id"], batch["text"].to_pylist()
            for k, ids, ends in encoded_runs(texts, encode_units):
                n = len(ends)
                with_end = np.insert(ids, ends, end_id).astype(np.int32)
                offsets = np.concatenate([[0], ends + np.arange(1, n + 1)])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids_of.slice(k, n),
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(before + offsets[:-1]),
                        pa.array(np.diff(offsets).astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(with_end)),
                    ],
                    ["doc_id", "part", "first", "n_ids", "ids"],
                )
                before += int(offsets[-1])

    return encode


def write(
    docs: DataFrame,
    out: str,
    vocabulary: str,
    cut: str = "byte_level",
    end_id: int = 2,
    id: str = "doc_id",
    text: str = "text",
    stripe_bytes: int = STRIPE_BYTES,
) -> None:
    """Encode whole texts and write them in ascending id order, a null id first.

    A null text is empty and gives the end id alone. Repeated rows are written each; rows of
    one id are ordered by text. No documents give an empty folder of files.
    """
    ordered = (
        docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", "text")
    )
    prepared(docs.sparkSession)
    (
        ordered.mapInArrow(_encode(vocabulary, cut, end_id), SCHEMA)
        .write.mode("append")
        .option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", ROW_INDEX_ROWS)
        .option("orc.stripe.size", stripe_bytes)
        .orc(out)
    )


def read(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """Documents of the files, or those of the given ids only, found by index and filter."""
    found = spark.read.schema(SCHEMA).orc(path)
    return found if ids is None else found.where(F.col("doc_id").isin(ids))


def _crc32(lists: pa.Array) -> pa.Array:
    values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
    offsets = lists.offsets.to_numpy()
    return pa.array(
        [zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])], pa.int64()
    )


def digests(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in files made by write().

    start counts the ids of all documents before. It takes one row per part to join: parts
    are the tasks that wrote, each holding the ids that go before within it.
    """
    read_back = files.select(
        "doc_id",
        "part",
        "first",
        F.size("ids").cast("bigint").alias("n_tokens"),
        once(_crc32, "bigint")("ids").alias("ids_crc32"),
    )
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("ids_in_part"))
    before = F.sum("ids_in_part").over(Window.orderBy("part")) - F.col("ids_in_part")
    bases = sizes.select("part", before.alias("base"))
    return read_back.join(F.broadcast(bases), "part").select(  # a row per written file
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )
