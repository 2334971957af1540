"""Best-fit packing: the sum-of-squares rule.

Documents are encoded, end id included, and only those longer than a sequence are cut.  Pieces go to
sequences one by one.  With N(g) open sequences of residual gap g, a piece of size s goes where the
sum of all N(g)^2 becomes smallest: to a gap h >= s (N(h) loses one, N(h - s) gains one; a full
sequence counts no more) or to a new sequence (N(capacity - s) gains one).  Ties: the smallest such gap,
an open sequence before a new one.  Pieces of an eighth of a sequence or more come first, the largest
ahead; the smaller ones then come in the order of their checksums, a mixture of sizes that fills what is left.

Pieces are dealt by hash into groups of about ``GROUP`` pieces, each packed by one task: the work of
a group is bounded, groups are independent, and a repeated task gives the same sequences.  A group
leaves a few open sequences, whose share falls with ``GROUP``; the README has figures.

Defined cases: null text: one piece, the end id.  Rows with equal ids are all kept.  Empty table: no row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.encoding import encoder
from turnstile.llm.rows import map_texts
from turnstile.session import materialize

CAPACITY, END_ID = 2048, 0
#: Pieces packed together.
GROUP = 20_000


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence numbers, offsets) of pieces placed in the order given."""
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)  # of open sequences by gap; [0] stays 0
    where, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    none = np.iinfo(np.int64).max
    made = 0
    for k, s in enumerate(sizes.tolist()):
        gap, change = capacity, 2 * count[capacity - s] + 1 if s < capacity else 0
        if s < capacity:
            # change of the sum for each gap from s to capacity - 1
            here = count[s:capacity]
            delta = 2 * (count[:capacity - s] - here) + 2
            delta[0] -= 1
            delta[here == 0] = none
            best = int(delta.argmin())
            if delta[best] <= change:
                gap = s + best
        if gap == capacity:
            number, made = made, made + 1
        else:
            number = open_at[gap].pop()
            count[gap] -= 1
        where[k], offset[k] = number, capacity - gap
        if gap > s:
            open_at[gap - s].append(number)
            count[gap - s] += 1
    return where, offset


def encode_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
                  text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (array of int)."""
    kind = pa.struct([("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids)
    spark_kind = T.StructType([T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
                              + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def run(texts, encode):
        ids, at = encode.encode(texts)
        out = []
        for k in range(len(texts)):
            own = np.append(ids[at[k]:at[k + 1]], np.array(end_id, ids.dtype)).astype("<u4")
            parts = [own[a:a + capacity] for a in range(0, len(own), capacity)]
            out.append([{"length": len(p), "ids_crc32": zlib.crc32(p.tobytes())} | ({"ids": p.astype(np.int32)} if with_ids else {}) for p in parts])
        return [pa.array(out, pa.list_(kind))]

    made = map_texts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), [T.StructField("parts", T.ArrayType(spark_kind))], run,
                     keep=["doc_id"], setup=lambda: encoder(tokenizer_path))
    rows = made.select("doc_id", F.posexplode("parts").alias("piece", "part"))
    return rows.select("doc_id", "piece", (F.col("piece").cast("long") * capacity).alias("start"), "part.*")


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` plus sequence_id and offset.  ``pieces`` must be a written table, read here twice."""
    n_groups = max(1, -(-pieces.count() // group))
    # a row's number is the same each time the written table is read, and spreads repeated rows too
    rows = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_groups)))
    schema = T.StructType(pieces.schema.fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = schema.names
    at = pieces.columns.index("length")

    def run(table: pa.Table) -> pa.Table:
        size = table.column(at).to_numpy()
        start = table.column("start").to_numpy()
        crc = table.column("ids_crc32").to_numpy()
        small = size < capacity // 8
        order = np.lexsort((start, crc, np.where(small, 0, -size), small))
        where, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        where[order], offset[order] = sum_of_squares(size[order], capacity)
        where += int(table.column("_group")[0].as_py()) << 40
        kept = [table.column(c) for c in range(len(names) - 2)]
        return pa.Table.from_arrays([*kept, pa.array(where), pa.array(offset)], names=names)

    return rows.groupBy("_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, group: int = GROUP,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes and packs: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    pieces = encode_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids)
    return pack(materialize(pieces, "packing-pieces"), capacity, group)
