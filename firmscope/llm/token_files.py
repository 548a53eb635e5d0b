"""Flat files of token ids: unsigned integers without header, and 64-bit offsets of the documents.

A folder holds format.json (dtype: 16 bits where all ids fit, else 32) and, for each part p: part-p.bin (ids, little-endian), part-p.ids (int64, document ids in ascending order) and
part-p.off (int64, one more than documents: where each document starts, counted over all parts, and the end).
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmscope.llm.common import checkpointed, shared_folder
from firmscope.llm.encode import encoder


#: Stands for a null id in the files.
NO_ID = -(1 << 63)


def _open(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _put(uri: str, parts: list[bytes] | Iterator[bytes]) -> None:
    """A whole file at once: written beside its place, then renamed, so a task that runs twice does no harm."""
    fs, path = _open(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(side := f"{path}.{uuid.uuid4().hex}") as f:
        for b in parts:
            f.write(b)
    try:
        fs.move(side, path)
    except OSError:  # stores that don't replace files: an earlier run of the task has left the same content
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            raise
        fs.delete_file(side)


def _mapped(uri: str, dtype: str) -> np.ndarray:
    """A file as an array: memory-mapped where it is local, else read."""
    fs, path = _open(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        with pa.memory_map(path) as f:
            return np.frombuffer(f.read_buffer(), dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def write(docs: DataFrame, folder: str, vocab: str, end_id: int = 1, parts: int | None = None, dtype: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the files and returns the parts: part, n_docs, n_tokens, base (ids of all parts before).

    Documents go to parts by ranges of their ids and to files in ascending order; of rows with the same id, in the order
    of their texts' hashes, over several parts if they are many. A null text is empty; every document ends with end_id. Rows with a null id come first and have
    NO_ID in the file. No documents: no parts. dtype is "<u2" for vocabularies of up to 65,536 ids and "<u4" for larger ones.
    """
    spark = docs.sparkSession
    dtype = dtype or ("<u2" if max(end_id, *encoder(vocab).whole.get_vocab().values()) < 1 << 16 else "<u4")
    _put(f"{folder}/format.json", [json.dumps({"dtype": dtype}).encode()])
    n = parts or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    d = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text_col).alias("t"))
    # one id may have many rows, and one row many copies: ranges part them by hash, then by a place that copies may swap
    ranged = d.withColumns({"h": F.xxhash64(F.coalesce("t", F.lit(""))), "u": F.monotonically_increasing_id()}).repartitionByRange(n, "id", "h", "u")
    sortable = ranged.sortWithinPartitions("id", "h").select("id", "t", F.spark_partition_id().alias("p"))
    mark = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, ids, sizes, part = encoder(vocab), [], [], None

        def blocks() -> Iterator[bytes]:
            nonlocal part
            for whole in batches:
                for at in range(0, whole.num_rows, 1000):
                    b = whole.slice(at, 1000)
                    part = b.column(2)[0].as_py()
                    out = [x + mark for x in work(b.column(1).to_pylist())]
                    ids.append(b.column(0).to_numpy())
                    sizes.append(np.array([len(x) // 4 for x in out], "<i8"))
                    data = b"".join(out)
                    if dtype != "<u4":
                        wide = np.frombuffer(data, "<u4")
                        if len(wide) and wide.max() > np.iinfo(dtype).max:
                            raise ValueError(f"an id does not fit {dtype}")
                        data = wide.astype(dtype).tobytes()
                    yield data

        first = next(stream := blocks(), None)
        if first is None:
            return

        def rest() -> Iterator[bytes]:
            yield first
            yield from stream

        at = f"{folder}/part-{part:06d}"
        _put(f"{at}.bin", rest())
        _put(f"{at}.ids", [np.concatenate(ids).astype("<i8").tobytes()])
        local = np.r_[0, np.cumsum(np.concatenate(sizes))].astype("<i8")
        _put(f"{at}.len", [local.tobytes()])
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(local) - 1], pa.int64()), pa.array([int(local[-1])], pa.int64())], names=["part", "n_docs", "n_tokens"])

    done = checkpointed(sortable.mapInArrow(encode, "part int, n_docs long, n_tokens long"))
    order = Window.orderBy("part")  # one row a part
    bases = checkpointed(done.withColumn("base", F.sum("n_tokens").over(order) - F.col("n_tokens")))

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, base in zip(b.column(0).to_pylist(), b.column(3).to_pylist(), strict=True):
                _put(f"{folder}/part-{p:06d}.off", [(_mapped(f"{folder}/part-{p:06d}.len", "<i8") + base).tobytes()])
            yield b

    return checkpointed(bases.repartition(n, "part").mapInArrow(offsets, "part int, n_docs long, n_tokens long, base long"))


def read(parts: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as 32-bit integers) of every document, read from these parts' files."""
    dtype = json.loads(_mapped(f"{folder}/format.json", "u1").tobytes())["dtype"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p in b.column(0).to_pylist():
                at = f"{folder}/part-{p:06d}"
                ids, off, flat = _mapped(f"{at}.ids", "<i8"), _mapped(f"{at}.off", "<i8"), _mapped(f"{at}.bin", dtype)
                local = off - off[0]
                crc = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(local[:-1].tolist(), local[1:].tolist(), strict=True)]
                for k in range(0, len(ids), 10_000):
                    s = slice(k, k + 10_000)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[s]), pa.array(off[:-1][s]), pa.array(np.diff(off)[s]), pa.array(crc[s], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    found = parts.select("part").repartition("part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return found.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def round_trip(docs: DataFrame, vocab: str, end_id: int = 1) -> DataFrame:
    """Writes docs to new files in the shared folder and returns what reading them gives."""
    folder = shared_folder(docs.sparkSession, "tokens")
    return read(write(docs, folder, vocab, end_id), folder)
