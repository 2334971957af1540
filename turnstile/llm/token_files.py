"""Token-id files: Arrow IPC files of fixed-size-list batches, with an index of documents.

Documents are range-partitioned by id, so that files follow one another in id order.  Each task
encodes its documents in order and writes their ids, one after the other, as sequences of
``seq_len``; only a file's last sequence is padded, and its mask tells so.  A file's record batches
hold ``BATCH`` sequences each:

    ids   fixed_size_list<uint16 or uint32>[seq_len]
    mask  fixed_size_list<bool>[seq_len]     true: an id, false: padding

An IPC file has a footer with its batches' places, so any sequence is found at once; memory-mapped it
is read without a copy.  A task begins a new file when the last has ``FILE_IDS`` ids, at a document's end.

Files go to the shared folder under names that no other attempt uses; the index of documents
(id, file, start in the file, number of ids) is written with Spark's own commit, so it names only
files of attempts that succeeded.  What a lost or repeated attempt leaves is never read.

Defined cases: null text: only the end id.  Null ids come first.  Rows with equal ids are all kept,
ordered by a hash of their texts.  An empty table: no file, an empty index.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnstile.llm.encoding import encoder
from turnstile.llm.rows import slices
from turnstile.session import materialize, scratch_path

SEQ_LEN, END_ID = 2048, 0
#: Sequences in a record batch.
BATCH = 64
#: Ids after which a task begins a new file.
FILE_IDS = 64 << 20
#: Bytes of text that a task encodes: on large tables this sets the number of partitions.
TASK_BYTES = 512 << 20


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def file_schema(value: np.dtype, seq_len: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(value), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])


class TokenFileWriter:
    """Ids in, sequences out; memory is one record batch and what was last put in."""

    def __init__(self, folder: str, name: str, value: np.dtype, seq_len: int):
        system, path = _file_system(folder)
        system.create_dir(path, recursive=True)
        self.value, self.seq_len, self.name = value, seq_len, name
        self.sink = system.open_output_stream(f"{path}/{name}")
        self.schema = file_schema(value, seq_len)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.waiting = self.n_ids = 0

    def put(self, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.waiting += len(ids)
        self.n_ids += len(ids)
        size = BATCH * self.seq_len
        if self.waiting >= size:
            held = np.concatenate(self.parts)
            whole = len(held) // size * size
            for at in range(0, whole, size):
                self._write(held[at:at + size], size)
            self.parts, self.waiting = [held[whole:]], len(held) - whole

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (ids, mask)]
        self.writer.write_batch(pa.record_batch(arrays, schema=self.schema))

    def close(self) -> None:
        held = np.concatenate([np.zeros(0, self.value), *self.parts])
        if len(held):
            padded = np.zeros(-(-len(held) // self.seq_len) * self.seq_len, self.value)
            padded[:len(held)] = held
            self._write(padded, len(held))
        self.writer.close()
        self.sink.close()


class TokenFile:
    """Random access to a file's sequences, and to runs of its ids."""

    def __init__(self, folder: str, name: str):
        from pyarrow import fs

        system, path = _file_system(folder)
        path = f"{path}/{name}"
        self.source = pa.memory_map(path) if isinstance(system, fs.LocalFileSystem) else system.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.seq_len = self.reader.schema.field("ids").type.list_size
        self.last = (-1, None)

    def _batch(self, k: int) -> pa.RecordBatch:
        if self.last[0] != k:
            self.last = (k, self.reader.get_batch(k))
        return self.last[1]

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view of the file) and mask of sequence i."""
        batch, at = self._batch(i // BATCH), i % BATCH
        ids, mask = (batch.column(c)[at].values for c in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask

    def ids(self, start: int, n: int) -> np.ndarray:
        """The file's ids from ``start`` on."""
        out, size = [], BATCH * self.seq_len
        while n:
            k, at = divmod(start, size)
            column = self._batch(k).column(0)
            values = column.values.to_numpy(zero_copy_only=True)[column.offset * self.seq_len:]
            part = values[at:at + n]
            out.append(part)
            start, n = start + len(part), n - len(part)
        return out[0] if len(out) == 1 else np.concatenate([np.zeros(0, np.uint16), *out])

    def close(self) -> None:
        self.source.close()


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, seq_len: int = SEQ_LEN, end_id: int = END_ID,
                      id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS,
                      task_bytes: int = TASK_BYTES) -> DataFrame:
    """Writes the files to ``folder``; returns the index: doc_id, file, file_order, file_start, n_tokens.

    There are as many tasks as the texts' bytes ask for, at least as many as ``spark.sql.shuffle.partitions``."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")).cast("long"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // task_bytes))
    ordered = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
                   .withColumn("tie", F.xxhash64("text"))
                   .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), "tie")
                   .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
                   .select("doc_id", "text"))

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encode = encoder(tokenizer_path)
        writer, rolled = None, 0
        try:
            for batch in batches:
                for part in slices(batch, 1):
                    ids, at = encode.encode(part.column(1))
                    ids = np.insert(ids, at[1:], end_id)  # the end id after each document
                    at = at + np.arange(len(at))
                    names, starts, order = [], [], []
                    for k in range(part.num_rows):
                        if writer is not None and writer.n_ids >= file_ids:
                            writer.close()
                            writer, rolled = None, rolled + 1
                        if writer is None:
                            writer = TokenFileWriter(folder, f"part-{task:06d}-{rolled:04d}-{uuid.uuid4().hex}.arrow", encode.type, seq_len)
                        names.append(writer.name)
                        order.append((task << 32) + rolled)
                        starts.append(writer.n_ids)
                        writer.put(ids[at[k]:at[k + 1]])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(names, pa.string()), pa.array(order, pa.int64()), pa.array(starts, pa.int64()),
                         pa.array(np.diff(at), pa.int64())], names=["doc_id", "file", "file_order", "file_start", "n_tokens"])
        finally:
            if writer is not None:
                writer.close()

    kind = ordered.schema["doc_id"].dataType.simpleString()
    index = ordered.mapInArrow(run, f"doc_id {kind}, file string, file_order long, file_start long, n_tokens long")
    return materialize(index, "token-index")


def file_starts(index: DataFrame) -> DataFrame:
    """(file, before): how many ids all files before each have.  One row a file."""
    files = index.groupBy("file", "file_order").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_order").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("before"))


def read_documents(index: DataFrame, folder: str) -> DataFrame:
    """Every document's ids read back from the files: doc_id, start, n_tokens, ids_crc32."""
    rows = index.join(materialize(file_starts(index), "token-starts"), "file")
    rows = rows.select("doc_id", (F.col("before") + F.col("file_start")).alias("start"), "n_tokens", "file", "file_start")

    def run(batches):
        name, opened = None, None
        for batch in batches:
            crc = []
            for file, start, n in zip(*(batch.column(c).to_pylist() for c in (3, 4, 2)), strict=True):
                if file != name:
                    if opened:
                        opened.close()
                    name, opened = file, TokenFile(folder, file)
                crc.append(zlib.crc32(opened.ids(start, n).astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])
        if opened:
            opened.close()

    kind = rows.schema["doc_id"].dataType.simpleString()
    # in the files' order within a task, so that each is opened once there
    return rows.sortWithinPartitions("file", "file_start").mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_folder(spark) -> str:
    """A new folder for files under the shared one."""
    return scratch_path(spark, f"token-files/{uuid.uuid4().hex}")
