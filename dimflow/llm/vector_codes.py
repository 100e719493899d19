"""Compression of vectors to codes: product quantization in whole numbers over tries of distinct parts.

Each vector is cut into parts. The distinct parts of a position, with how often each occurs, are the leaves of a
lexicographic trie that Spark deals to tasks as sorted runs. A task walks its run in order: the distances from a prefix
to all entries of the codebook are summed once for all parts that begin with it. Leaves take the nearest entry and add
their weighted components to it; the driver sees one sum for each entry and position. All arithmetic is in integers, so
sums do not depend on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.common import table
from dimflow.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Scaled components are held within this, so that a vector's error always fits in a long.
MOST = 1 << 27
#: Leaves of the trie that are walked at once.
BLOCK = 1 << 14
#: Sums by label are broadcast up to so many labels; beyond, they are joined with the label cut in so many salts.
FEW_LABELS, SALTS = 100_000, 32


def whole(column: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, held within ``MOST``."""
    x = column.cast("array<double>")
    return F.transform(x, lambda v: F.floor(F.greatest(F.least(v * scale, F.lit(float(MOST))), F.lit(-float(MOST)))).cast("int"))


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str | None, parts: int, scale: int) -> tuple[DataFrame, int]:
    """``vec_id, label, ints`` of the rows that take part, and the components of a part."""
    vector = F.col(vector_col).cast("array<double>")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = rows.where(F.coalesce(good, F.lit(False)) & (F.size(vector) > 0))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"), whole(vector, scale).alias("ints"))
    sizes = rows.groupBy(F.size("ints").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = sizes[0]["dim"] if sizes else parts
    width = -(-dim // parts)
    filled = F.concat("ints", F.array_repeat(F.lit(0), parts * width - dim)) if parts * width > dim else F.col("ints")
    return rows.where(F.size("ints") == dim).withColumn("ints", filled), width


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def part_key(values: np.ndarray) -> list[bytes]:
    """Parts as bytes whose order is that of the numbers, component by component."""
    shifted = (values.astype(np.int64) + (1 << 31)).astype(">u4")
    return [row.tobytes() for row in shifted]


def part_values(column: pa.Array, width: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u4").astype(np.int64).reshape(-1, width) - (1 << 31)


def distinct_parts(rows: DataFrame, parts: int, width: int) -> DataFrame:
    """``pos, part, n``: each position's distinct parts in order, with their numbers of occurrences."""

    def cut(batches):
        for batch in batches:
            ints = matrix(batch.column("ints"), parts * width)
            for pos in range(parts if len(ints) else 0):
                values, n = np.unique(ints[:, pos * width : (pos + 1) * width], axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), pos, np.int32)), pa.array(part_key(values), pa.binary()), pa.array(n)], names=["pos", "part", "n"])

    pieces = rows.select("ints").mapInArrow(cut, "pos int, part binary, n long")
    return pieces.groupBy("pos", "part").agg(F.sum("n").alias("n")).sortWithinPartitions("pos", "part")


def nearest_entries(leaves: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each leaf of a sorted run its nearest entry (ties: lower index) and the squared distance.

    The run is walked depth-first in blocks. Level by level, a prefix that differs from the one before it is a node; its
    distances are its parent's plus one component's, and all leaves below share them."""
    entry, error = np.empty(len(leaves), np.int64), np.empty(len(leaves), np.int64)
    for start in range(0, len(leaves), BLOCK):
        block = leaves[start : start + BLOCK]
        changes = np.ones(block.shape, bool)
        changes[1:] = np.logical_or.accumulate(block[1:] != block[:-1], axis=1)
        below = np.zeros(len(block), np.int64)  # node of each leaf on the level above: the root
        sums = np.zeros((1, len(book)), np.int64)
        for depth in range(block.shape[1]):
            at = np.flatnonzero(changes[:, depth])
            step = block[at, depth, None] - book[None, :, depth]
            sums = sums[below[at]] + step * step
            below = np.cumsum(changes[:, depth]) - 1
        best = sums.argmin(axis=1)
        entry[start : start + BLOCK] = best[below]
        error[start : start + BLOCK] = sums[np.arange(len(best)), best][below]
    return entry, error


def refined(trie: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    """One round: every entry becomes the floor of the mean of the parts nearest to it; unused entries stay."""

    def summed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at, n = batch.column("pos").to_numpy(), batch.column("n").to_numpy()
            leaves = part_values(batch.column("part"), width)
            for pos in np.unique(at).tolist():
                here = at == pos
                entry, _ = nearest_entries(leaves[here], books[pos])
                weighted = leaves[here] * n[here, None]
                sums = np.zeros((len(books[pos]), width), np.int64)
                np.add.at(sums, entry, weighted)
                count = np.zeros(len(sums), np.int64)
                np.add.at(count, entry, n[here])
                used = np.flatnonzero(count)
                yield pa.RecordBatch.from_pydict({"pos": np.full(len(used), pos, np.int32), "entry": used.astype(np.int32), "n": count[used], **{f"s{d}": sums[used, d] for d in range(width)}})

    names = ["n", *(f"s{d}" for d in range(width))]
    found = trie.mapInArrow(summed, "pos int, entry int, " + ", ".join(f"{c} long" for c in names))
    totals = found.groupBy("pos", "entry").agg(*(F.sum(c).alias(c) for c in names)).collect()  # positions x entries rows
    books = [book.copy() for book in books]
    for r in totals:
        books[r.pos][r.entry] = [r[c] // r.n for c in names[1:]]
    return books


def first_books(rows: DataFrame, parts: int, width: int, entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids; of an id's several vectors the first in order."""
    least = rows.where("vec_id is not null").groupBy("vec_id").agg(F.min("ints").alias("ints")).orderBy("vec_id").limit(entries).collect()
    seeds = np.array([r.ints for r in least], np.int64).reshape(-1, parts * width)
    return [seeds[:, pos * width : (pos + 1) * width].copy() for pos in range(parts)]


def train(rows: DataFrame, parts: int, width: int, entries: int, rounds: int) -> list[np.ndarray]:
    """Codebooks of all positions after the given rounds, over all rows."""
    books = first_books(rows, parts, width, entries)
    if len(books[0]) and rounds:
        trie = cut_lineage(distinct_parts(rows, parts, width))
        for _ in range(rounds):
            books = refined(trie, books, width)
    return books


def encode(rows: DataFrame, books: list[np.ndarray], width: int) -> DataFrame:
    """Adds ``code`` (two hex digits an index) and ``error``; a batch's parts are sorted into tries."""
    parts = len(books)

    def coded(batches):
        for batch in batches:
            ints = matrix(batch.column("ints"), parts * width).astype(np.int64)
            codes, errors = np.zeros((len(ints), parts), np.uint8), np.zeros(len(ints), np.int64)
            for pos in range(parts if len(ints) and len(books[0]) else 0):
                leaves, which = np.unique(ints[:, pos * width : (pos + 1) * width], axis=0, return_inverse=True)
                entry, error = nearest_entries(leaves, books[pos])
                codes[:, pos] = entry[which.ravel()]
                errors += error[which.ravel()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors)], names=["vec_id", "label", "code", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(coded, f"vec_id long, label {label}, code string, error long")


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the error summed over rows of one label (null where it does not fit in a long)."""
    sums = cut_lineage(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")))
    if sums.count() <= FEW_LABELS:
        sums = F.broadcast(sums.withColumnRenamed("label", "__label"))
        return coded.join(sums, F.col("label").eqNullSafe(F.col("__label")), "left").drop("__label")
    dealt = coded.withColumn("__salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    copies = sums.withColumnRenamed("label", "__label").withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    same = F.col("label").eqNullSafe(F.col("__label")) & (F.col("__salt") == F.col("__copy"))
    return dealt.join(copies, same, "left").drop("__label", "__salt", "__copy")


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal, by position, entry and place."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()


def decode(coded: DataFrame, books: list[np.ndarray], scale: int = SCALE) -> DataFrame:
    """Adds ``vector``: the entries a code stands for, divided by the scale."""
    held = F.array(*(F.array(*(F.array(*(F.lit(int(x) / scale) for x in entry)) for entry in book)) for book in books))
    part = lambda i: F.get(F.get(held, i), F.conv(F.substr("code", 2 * i + 1, F.lit(2)), 16, 10).cast("int"))
    return coded.withColumn("vector", F.flatten(F.transform(F.sequence(F.lit(0), F.lit(len(books) - 1)), part)))


def compress(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label",
) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every usable row, and the codebooks (at most 256 entries a position).

    Vectors that are null or empty, hold null or non-finite components, or have another length than most (of equally
    common lengths the shorter counts) take no part. A length that is no multiple of ``parts`` is filled up with zeros.
    Scaled components beyond 2 ** 27 count as that, since errors would not fit in a long. Repeated rows are all
    coded and weigh accordingly; rows without id are coded but seed no entry; with fewer ids than ``entries`` the books
    are shorter. An empty table gives no rows; other columns are not looked at.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    rows, width = usable(rows, id_col, vector_col, label_col, parts, scale)
    books = train(rows, parts, width, entries, rounds)
    return encode(rows, books, width), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    told = with_label_error(cut_lineage(coded))
    return told.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The rounds as one query: each takes the nearest entry as the least of ``16 * distance + entry``."""
    nearest = """
nearest{i} AS MATERIALIZED (
    SELECT p.vec_id, p.label, p.pos, p.part,
        min(16 * list_sum(list_transform(range(1, 9), lambda d: (p.part[d] - b.entry_part[d]) * (p.part[d] - b.entry_part[d])))::BIGINT + b.entry) AS best
    FROM parts p JOIN book{i} b ON p.pos = b.pos GROUP BY ALL
)"""
    means = ", ".join(f"CAST(floor(sum(part[{d}]) / count(*)) AS BIGINT)" for d in range(1, 9))
    book = f"""
book{{j}} AS MATERIALIZED (
    SELECT b.pos, b.entry, coalesce(m.entry_part, b.entry_part) AS entry_part
    FROM book{{i}} b LEFT JOIN (SELECT pos, best % 16 AS entry, [{means}] AS entry_part FROM nearest{{i}} GROUP BY ALL) m
        ON b.pos = m.pos AND b.entry = m.entry
)"""
    steps = [nearest.format(i=0)]
    for i in range(ROUNDS):
        steps += [book.format(i=i, j=i + 1), nearest.format(i=i + 1)]
    return f"""
WITH held AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x::DOUBLE) AS BIGINT)) AS ints
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, label, pos, ints[8 * pos + 1 : 8 * pos + 8] AS part FROM held, (SELECT unnest(range(8)) AS pos)
), book0 AS MATERIALIZED (
    SELECT pos, row_number() OVER (PARTITION BY pos ORDER BY vec_id) - 1 AS entry, part AS entry_part FROM parts QUALIFY entry < 16
), {",".join(steps)},
coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', best % 16), '' ORDER BY pos) AS code, CAST(sum(best // 16) AS BIGINT) AS error
    FROM nearest{ROUNDS} GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(entry_part, ','), ',' ORDER BY pos, entry)) FROM book{ROUNDS}) AS codebooks_sha256
FROM coded
"""


SQL = _sql()
