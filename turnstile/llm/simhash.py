"""SimHash near-duplicates by tiled exact comparison.

Every whole text has a 64-bit fingerprint of its word shingles' hashes (XXH64, seed 42): a bit is 1
if it is set in over half of them.  Fingerprints that differ in ``radius`` bits or fewer are linked.

* Copies collapse first: distinct fingerprints, by an aggregate that combines before its shuffle.
* Tiles hold fingerprints with the same bit counts in each of their four 16-bit quarters, in blocks of
  ``BLOCK`` at most.  Two fingerprints within the radius have counts whose differences add up to no
  more than it, so a pair of tiles with a larger difference is skipped unseen.
* Each remaining pair of blocks is compared in full: exclusive-or, bit count, all in numpy, some
  rows at a time.  A pair of blocks returns a star for each connected group it finds (at
  most one link a fingerprint), never the links themselves, so dense groups don't blow up.
* Connected components of the links: alternating large-star and small-star rounds, each written
  to the shared folder, until nothing changes.  Nothing of the corpus goes to the driver but
  sums that tell whether a round changed anything, and the counts of tiles (at most 17^4).

Defined cases: null text or no word: fingerprint zero, linked like any other.  Rows with equal ids are
kept.  A null id has its fingerprint and its group's smallest id, null if the group has none.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.llm.rows import Words, flags, map_texts
from turnstile.session import materialize

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Fingerprints in a block: 32 KB.
BLOCK = 4096
#: Rows of a block compared at a time: 8 MB for a full block.
ROWS = 256
QUARTERS = 4
_LANE = 65535

FIELDS = [T.StructField("fp", T.LongType())]


@functools.lru_cache(1)
def _lanes() -> np.ndarray:
    """For each half byte of a hash's byte: four bits as 16-bit lanes of a word."""
    value = np.arange(256, dtype=np.uint64)
    out = np.zeros((2, 256), np.uint64)
    for half, k in itertools.product(range(2), range(4)):
        out[half] |= ((value >> np.uint64(4 * half + k)) & np.uint64(1)) << np.uint64(16 * k)
    return out


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprints of texts: A-Z in lower case, words parted by ASCII white space."""
    words = Words(texts, flags(space_split=True), lower=True)
    counts, first = words.counts, words.first
    out = np.zeros(len(texts), np.uint64)
    if not len(words.begin):
        return out
    data = words.data.tobytes()
    # where shingles begin: words with enough words of their text after them, or a short text's first
    n = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    some = np.flatnonzero(n)
    of = np.repeat(some, n[some])
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n[some]) - n[some], n[some]) + first[of]
    stop = np.minimum(at + shingle, first[of + 1]) - 1
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(data[a:b], SEED) for a, b in zip(words.begin[at].tolist(), words.end[stop].tolist(), strict=True)), np.uint64, len(at))
    # sums of lanes over at most 65535 shingles at a time
    starts = np.cumsum(n[some]) - n[some]
    cuts = np.unique(np.concatenate([starts] + [np.arange(s, s + k, _LANE) for s, k in zip(starts[n[some] > _LANE], n[some][n[some] > _LANE], strict=True)]))
    owner = np.searchsorted(starts, cuts, side="right") - 1
    each = h.view(np.uint8).reshape(-1, 8)
    for byte, half in itertools.product(range(8), range(2)):
        sums = np.add.reduceat(_lanes()[half][each[:, byte]], cuts)
        for k in range(4):
            bits = np.bincount(owner, ((sums >> np.uint64(16 * k)) & np.uint64(0xFFFF)).astype(float), len(some))
            out[some] |= (2 * bits > n[some]).astype(np.uint64) << np.uint64(8 * byte + 4 * half + k)
    return out


def fingerprint_texts(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) plus fp, the fingerprint as a signed long."""
    return map_texts(docs, FIELDS, lambda texts: [pa.array(fingerprints(texts, shingle).view(np.int64))],
                     keep=docs.columns if keep is None else keep, text_col=text_col)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _tile(fp: Column) -> Column:
    """The tile's number: bit counts of the quarters, in base 17."""
    out = F.lit(0)
    for k in range(QUARTERS):
        out = out * 17 + F.bit_count(F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF).cast("long")))
    return out


def _near(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts that add up to the radius at most; one of each pair of opposites."""
    span = range(-radius, radius + 1)
    return [d for d in itertools.product(span, repeat=QUARTERS) if sum(map(abs, d)) <= radius and d >= (0,) * QUARTERS]


def star_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each group that links within the radius connect, links of its members to one of them."""
    left, right = [], []
    for at in range(0, len(a), ROWS):
        i, j = np.nonzero(np.bitwise_count(a[at:at + ROWS, None] ^ b[None, :]) <= radius)
        left.append(i + at)
        right.append(j)
    both, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    i, j = where[np.concatenate(left)], where[len(a) + np.concatenate(right)]
    label = np.arange(len(both))
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(both)))
    return both[moved], both[label[moved]]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) whose groups are those of all links within the radius."""
    spark = fps.sparkSession
    tiled = fps.select("fp", _tile(F.col("fp")).alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("n_blocks"))  # 17^4 rows at most
    sizes = materialize(sizes, "simhash-tiles")
    blocks = (tiled.join(F.broadcast(sizes), "tile")
                   .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("n_blocks")).cast("int"))
                   .groupBy("tile", "block").agg(F.collect_list("fp").alias("fps")))
    blocks = materialize(blocks, "simhash-blocks")
    ids = sizes.select("tile", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"))
    steps = F.array(*[F.lit(sum(d * 17 ** (QUARTERS - 1 - k) for k, d in enumerate(diff))) for diff in _near(radius)])
    pairs = (ids.select(F.col("tile").alias("tile_a"), F.col("block").alias("block_a"), F.explode(steps).alias("step"))
                .withColumn("tile_b", F.col("tile_a") + F.col("step"))
                .join(F.broadcast(sizes.select(F.col("tile").alias("tile_b"), F.col("n_blocks").alias("n_b"))), "tile_b")
                .select("tile_a", "block_a", "tile_b", F.explode(F.sequence(F.lit(0), F.col("n_b") - 1)).alias("block_b"))
                # digits that a step carried over: not a neighbour
                .where(_apart(F.col("tile_a"), F.col("tile_b")) <= radius)
                .where("tile_a <> tile_b OR block_a <= block_b"))
    a = blocks.select(F.col("tile").alias("tile_a"), F.col("block").alias("block_a"), F.col("fps").alias("fps_a"))
    b = blocks.select(F.col("tile").alias("tile_b"), F.col("block").alias("block_b"), F.col("fps").alias("fps_b"))
    met = pairs.join(a, ["tile_a", "block_a"]).join(b, ["tile_b", "block_b"]).select("fps_a", "fps_b")

    def compare(batches):
        for batch in batches:
            left, right = batch.column(0), batch.column(1)
            for k in range(batch.num_rows):
                x, y = (np.asarray(c[k].values).view(np.uint64) for c in (left, right))
                u, v = star_links(x, y, radius)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return met.mapInArrow(compare, "u long, v long")


def _apart(a: Column, b: Column) -> Column:
    out = F.lit(0)
    for k in range(QUARTERS):
        digit = [F.pmod(F.floor(x / (17 ** k)), F.lit(17)) for x in (a, b)]
        out = out + F.abs(digit[0] - digit[1])
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is its component's smallest node."""

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            around = e.union(e.select("v", "u"))
        else:
            around = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        # a table of its own: both sides of the join then have exchanges, and a hub's rows can be split
        low = materialize(around.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "simhash-low")
        met = around.join(low, "u")
        if large:
            made = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            made = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return made.where("u <> v").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    edges = materialize(edges.where("u <> v").select("u", "v").distinct(), "simhash-links")
    state = mark(edges)
    while True:
        edges = materialize(star(star(edges, True), False), "simhash-stars")
        now = mark(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select("v", "v").distinct())


def _groups(made: DataFrame, lead: str, radius: int) -> DataFrame:
    """(fp, root, lead) of every distinct fingerprint of ``made``: root is its component's smallest
    fingerprint, lead the smallest of the ``lead`` column in the component."""
    leads = materialize(made.groupBy("fp").agg(F.min(lead).alias("lead")), "simhash-distinct")
    found = components(links(leads.select("fp"), radius))
    # fingerprints without a link are components of their own
    linked = materialize(leads.join(found.withColumnRenamed("node", "fp"), "fp"), "simhash-linked")
    least = materialize(linked.groupBy("root").agg(F.min("lead").alias("least")), "simhash-least")
    joint = linked.select("fp", "root").join(least, "root")
    made = leads.join(joint, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"),
                                                  F.when(F.col("root").isNull(), F.col("lead")).otherwise(F.col("least")).alias("lead"))
    # a table of its own, so that the rows of a frequent fingerprint can be split when it is joined
    return materialize(made, "simhash-groups")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, fp, root (the component's smallest fingerprint) and component_id (its smallest id)."""
    made = fingerprint_texts(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")), shingle, "_t", ["_id"])
    made = materialize(made, "simhash-fingerprints")
    return made.join(_groups(made, "_id", radius), "fp").select(F.col("_id").alias(id_col), "fp", "root", F.col("lead").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each component, with all its columns; of repeated rows one stays."""
    columns = docs.columns
    key = F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash"))
    rows = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)], key.alias("_key"))
    text = f"_c{columns.index(text_col)}"
    made = materialize(fingerprint_texts(rows, shingle, text, ["_key"]), "simhash-fingerprints")
    stays = _groups(made, "_key", radius).select(F.col("lead").alias("_key")).distinct()
    first = Window.partitionBy("_key").orderBy(*[f"_c{i}" for i, c in enumerate(columns) if i != columns.index(text_col)])
    return (rows.join(stays, "_key", "left_semi").withColumn("_n", F.row_number().over(first)).where("_n = 1")
                .select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)]))
