"""Approximate nearest neighbours by a hash-prefix forest.

Each tree hashes a vector to a long string of bits, the signs of its products with random planes.
A tree's strings lie in sorted arrays, cut into segments by their first bits. A query goes to its
segment in every tree; binary search counts the strings that share its first n bits, for each n. All
trees ascend together from the longest shared prefix until enough candidates are found in all of
them, and those are compared exactly.

Vectors with the same components are one class with its smallest ids, so a vector that a third of
all rows share is compared once. Classes lie in blocks, and trees hold hash strings and places in blocks only:
vectors are shuffled once with their block, whatever the number of trees.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimflow.llm.common import table
from dimflow.session import cut_lineage

#: Length of a hash string.
BITS = 32
#: The fit takes so many queries against all rows and picks the cheapest forest of at most MOST_TREES
#: trees that finds LEAST_RECALL of their neighbours.
SAMPLE_QUERIES, MOST_TREES, LEAST_RECALL = 100, 64, 0.97
#: Classes of a block (places in it fit in 16 bits), and bytes of what is looked for in a block at once.
BLOCK, CHUNK_BYTES = 4096, 8 << 20
#: Segments are this many bits shorter than the fitted prefix, for queries with few candidates.
ASCENT = 1
SEED = 11


def planes(dim: int, tree: int) -> np.ndarray:
    return np.random.default_rng((SEED, tree)).standard_normal((dim, BITS))


def codes(vectors: np.ndarray, tree: int) -> np.ndarray:
    return ((vectors @ planes(vectors.shape[1], tree)) > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=-1))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component to 0.5 or more and below 1.

    That is exact and changes no cosine, and squares neither overflow nor vanish."""
    _, up = np.frexp(np.abs(rows).max(axis=1, initial=0.0))
    half = up // 2  # in two steps, as one power may be out of range
    return np.ldexp(np.ldexp(rows, -half[:, None]), -(up - half)[:, None])


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return scaled(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` of rows that take part; the vectors of floats or, if they were anything else, of doubles."""
    v = F.col("vector")
    kind = "array<float>" if rows.select(vector_col).schema[0].dataType.simpleString() == "array<float>" else "array<double>"
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("vector"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)))


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: smallest id, the k + 1 smallest ids (one may be the query's own), vector."""
    nth = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.distinct().withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= k + 1)
    return few.groupBy("vector").agg(F.min("vec_id").alias("class"), F.sort_array(F.collect_list("vec_id")).alias("ids")).select("class", "ids", "vector")


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def fitted(classes: DataFrame, queries: DataFrame, dim: int, total: int, k: int, sample_queries: int) -> tuple[int, int]:
    """Trees and bits of prefix. A bounded sample of queries is compared with all rows, in blocks."""
    sample = queries.orderBy(F.xxhash64("class")).limit(sample_queries).collect()
    if not sample:
        return 1, 0
    asked = scaled(np.array([r.vector for r in sample], np.float64))
    unit = asked / np.sqrt((asked * asked).sum(axis=1, keepdims=True))

    def nearest(batches):
        for batch in batches:
            rows = matrix(batch.column("vector"), dim)
            near = unit @ (rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))).T
            top = np.argsort(-near, axis=1)[:, : k + 1]
            which = np.repeat(np.arange(len(unit)), top.shape[1])
            yield pa.RecordBatch.from_pydict({
                "query": which, "vec_id": batch.column("class").to_numpy()[top.ravel()], "score": np.take_along_axis(near, top, 1).ravel(), "vector": list(rows[top.ravel()]),  # scaled, which leaves its codes as they are
            })

    found = classes.select("class", "vector").mapInArrow(nearest, "query long, vec_id long, score double, vector array<double>")
    own = {i: r["class"] for i, r in enumerate(sample)}
    pairs = [(r.query, r.vector) for r in best_of(found, k + 1).collect() if r.vec_id != own[r.query]]
    if not pairs:
        return 1, 0
    mine, theirs = asked[[q for q, _ in pairs]], np.array([v for _, v in pairs])
    shared = np.empty((len(pairs), MOST_TREES), np.int64)
    for tree in range(MOST_TREES):
        apart = codes(mine, tree) ^ codes(theirs, tree)
        shared[:, tree] = BITS - np.frexp(apart.astype(np.float64))[1]
    longest = np.maximum.accumulate(shared, axis=1)  # with so many trees
    options = []
    for bits in range(int(np.log2(max(total, 1))) + 1):
        enough = np.flatnonzero((longest >= bits).mean(axis=0) >= LEAST_RECALL)
        if len(enough):
            options.append((int(enough[0] + 1) / 2**bits, int(enough[0] + 1), bits))
    _, trees, bits = min(options)
    return trees, bits


def packed_blocks(classes: DataFrame) -> DataFrame:
    """Classes in blocks of at most BLOCK, a row each: names, vectors as they are, and ids end to end."""

    def packed(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                ids = part.column("ids")
                yield pa.RecordBatch.from_pydict({
                    "names": [part.column("class").to_numpy().tobytes()], "vectors": [part.column("vector").flatten().to_numpy().tobytes()],
                    "ids": [ids.flatten().to_numpy().tobytes()], "n_ids": [ids.value_lengths().to_numpy().astype(np.int64).tobytes()],
                })

    rows = classes.select("class", "ids", "vector").mapInArrow(packed, "names binary, vectors binary, ids binary, n_ids binary")
    return cut_lineage(rows.withColumn("block", F.monotonically_increasing_id()))


def numbers(column: pa.Array, i: int, kind=np.int64) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), kind)


def by_segment(vectors: np.ndarray, trees: int, bits: int):
    """For each tree the hash strings, and for each of its segments the number and the places in order of their strings."""
    for tree in range(trees):
        code = codes(vectors, tree)
        order = np.argsort(code, kind="stable")
        segment = code[order] >> (BITS - bits)
        for places in np.split(order, np.flatnonzero(np.diff(segment)) + 1):
            yield tree, int(code[places[0]] >> (BITS - bits)), code[places], places


def hashed_blocks(blocks: DataFrame, dim: int, kind: str, trees: int, bits: int) -> DataFrame:
    """Sorted strings of a block that fall into one segment of one tree, and their places in the block."""

    def strings(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                vectors = scaled(numbers(batch.column("vectors"), i, kind).astype(np.float64).reshape(-1, dim))
                rows = [(t, s, c.astype(np.uint32).tobytes(), p.astype(np.uint16).tobytes()) for t, s, c, p in by_segment(vectors, trees, bits)]
                out = dict(zip(("tree", "segment", "codes", "places"), map(list, zip(*rows))))
                yield pa.RecordBatch.from_pydict({"tree": pa.array(out.pop("tree"), pa.int32()), **out, "block": [batch.column("block")[i].as_py()] * len(rows)})

    return blocks.select("block", "vectors").mapInArrow(strings, "tree int, segment long, codes binary, places binary, block long")


def hashed_queries(queries: DataFrame, dim: int, trees: int, bits: int) -> DataFrame:
    """The same of a batch of queries ``class, vector, level``, with their names and levels."""

    def strings(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            names, levels = (batch.column(c).to_numpy().astype(np.int64) for c in ("class", "level"))
            rows = [(t, s, c.tobytes(), names[p].tobytes(), levels[p].tobytes()) for t, s, c, p in by_segment(matrix(batch.column("vector"), dim), trees, bits)]
            out = dict(zip(("tree", "segment", "q_codes", "q_names", "q_levels"), map(list, zip(*rows))))
            yield pa.RecordBatch.from_pydict({"tree": pa.array(out.pop("tree"), pa.int32()), **out})

    return queries.select("class", "vector", "level").mapInArrow(strings, "tree int, segment long, q_codes binary, q_names binary, q_levels binary")


def shared_counts(pairs: DataFrame, bits: int) -> DataFrame:
    """``query, level, n``: strings that share the query's first ``level`` bits, in one task's pairs."""

    def counted(batches):
        sums: dict[int, np.ndarray] = {}

        def flush():
            for q, n in sums.items():
                yield pa.RecordBatch.from_pydict({"query": np.full(len(n), q), "level": np.arange(bits, BITS + 1), "n": n})
            sums.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                theirs = numbers(batch.column("codes"), i, np.uint32).astype(np.int64)
                mine, names = (numbers(batch.column(c), i) for c in ("q_codes", "q_names"))
                step = np.int64(1) << np.arange(BITS - bits, -1, -1)  # for each level
                low = mine[:, None] & -step
                n = np.searchsorted(theirs, low + step) - np.searchsorted(theirs, low)
                for q, own in zip(names.tolist(), n):
                    sums[q] = sums[q] + own if q in sums else own
            if len(sums) > 10_000:
                yield from flush()
        yield from flush()

    return pairs.select("codes", "q_codes", "q_names").mapInArrow(counted, "query long, level long, n long")


def candidates(pairs: DataFrame, bits: int) -> DataFrame:
    """``query, block, places, bytes``: where in a block the strings lie that share the query's first bits in some tree.

    An empty entry of ``places`` stands for the whole block (which one segment is if there are no first bits)."""

    def ranges(batches):
        found: dict[tuple[int, int], list[bytes]] = {}
        size = 0

        def flush():
            if found:
                joined = [b"" if b"" in some else b"".join(some) for some in found.values()]
                query, block = (pa.array(x, pa.int64()) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([query, block, pa.array(joined, pa.binary())], names=["query", "block", "places"])
            found.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                theirs = numbers(batch.column("codes"), i, np.uint32).astype(np.int64)
                places = batch.column("places")[i].as_py()
                mine, asking, levels = (numbers(batch.column(c), i) for c in ("q_codes", "q_names", "q_levels"))
                block = batch.column("block")[i].as_py()
                step = np.int64(1) << (BITS - levels)
                low = mine & -step
                for q, a, b in zip(asking.tolist(), np.searchsorted(theirs, low).tolist(), np.searchsorted(theirs, low + step).tolist()):
                    if a < b:
                        found.setdefault((q, block), []).append(b"" if bits == 0 and b - a == len(theirs) else places[2 * a : 2 * b])
                        size += 2 * (b - a) + 100
                if size > CHUNK_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    found = pairs.mapInArrow(ranges, "query long, block long, places binary")
    # At most two bytes for each tree and place of the block.
    return found.groupBy("query", "block").agg(F.collect_list("places").alias("places"), F.sum(F.length("places")).alias("bytes"))


def compared(blocks: DataFrame, found: DataFrame, queries: DataFrame, dim: int, kind: str, k: int) -> DataFrame:
    """``query, vec_id, score``: of each query and block, the k + 1 best candidates' ids.

    A block meets the queries that look for something in it, in chunks if that is much."""
    # Written, as its real size then decides whether what it is joined to is shuffled for it.
    chunks = cut_lineage(found.groupBy("block").agg((F.floor(F.sum(F.col("bytes") + 8 * dim) / CHUNK_BYTES) + 1).alias("chunks")))
    looked_for = found.join(queries.select(F.col("class").alias("query"), "vector"), "query").join(chunks, "block")
    looked_for = looked_for.select("block", F.pmod(F.xxhash64("query"), F.col("chunks")).alias("chunk"), "query", "places", "vector")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    held = blocks.join(chunks, "block").select("block", copies, "vectors", "ids", "n_ids")

    def best(held: pa.Table, looked_for: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if held.num_rows and looked_for.num_rows:
            vectors, ids, n_ids = (held.column(c).combine_chunks() for c in ("vectors", "ids", "n_ids"))
            rows = scaled(numbers(vectors, 0, kind).astype(np.float64).reshape(-1, dim))
            ids, n_ids, long = numbers(ids, 0), numbers(n_ids, 0), norms(rows)
            ends = np.cumsum(n_ids)
            queries = matrix(looked_for.column("vector").combine_chunks(), dim)
            for name, places, query in zip(looked_for.column("query").to_pylist(), looked_for.column("places"), queries):
                places = places.as_py()
                at = np.arange(len(rows)) if b"" in places else np.unique(np.frombuffer(b"".join(places), np.uint16))
                # In double precision, row by row, so that equal rows have equal scores.
                score = (rows[at] * query).sum(axis=1) / (long[at] * norms(query))
                good = np.arange(len(at))
                if len(at) > k + 1:
                    good = np.flatnonzero(score >= np.partition(score, -k - 1)[-k - 1])
                few = [(-score[j], v) for j in good for v in ids[ends[at[j]] - n_ids[at[j]] : ends[at[j]]].tolist()]
                out.extend((name, v, -float(s)) for s, v in sorted(few)[: k + 1])
        columns = [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]
        return pa.Table.from_arrays(columns, names=["query", "vec_id", "score"])

    both = held.groupBy("block", "chunk").cogroup(looked_for.groupBy("block", "chunk"))
    return both.applyInArrow(best, "query long, vec_id long, score double")


def searched(blocks: DataFrame, queries: DataFrame, dim: int, kind: str, trees: int, bits: int, wanted: float, k: int) -> DataFrame:
    low = max(0, bits - ASCENT)
    index = hashed_blocks(blocks, dim, kind, trees, low)
    first = index.select("tree", "segment", "codes").join(hashed_queries(queries.withColumn("level", F.lit(low)), dim, trees, low), ["tree", "segment"])
    counts = shared_counts(first, low).groupBy("query", "level").agg(F.sum("n").alias("n"))
    levels = counts.groupBy("query").agg(F.coalesce(F.max(F.when(F.col("n") >= wanted, F.col("level"))), F.lit(low)).alias("level"))
    levelled = cut_lineage(queries.join(levels, F.col("class") == F.col("query")).select("class", "vector", "level"))
    found = cut_lineage(candidates(index.join(hashed_queries(levelled, dim, trees, low), ["tree", "segment"]), low))
    return best_of(compared(blocks, found, queries, dim, kind, k), k + 1).select("query", "vec_id", "score")


def nearest(rows: DataFrame, is_query, k: int = 5, sample_queries: int = SAMPLE_QUERIES, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` holds for, its k nearest others by cosine.

    ``is_query`` is a condition on ``vec_id``. Rows without id, and vectors that are null, zero, hold null or non-finite
    components or have another length than most, take no part. Ties go to the smaller id; rows that
    repeat an id and vector count once, other rows with the query's id are no candidates. With fewer than k candidates all are returned. An
    empty table gives no rows; other columns are not looked at.
    """
    rows = usable(rows, id_col, vector_col)
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = sizes[0]["dim"] if sizes else 1
    rows = rows.where(F.size("vector") == dim)
    classes = cut_lineage(classes_of(rows, k))
    asking = rows.where(is_query).distinct().join(classes.select("class", "vector"), "vector").select("vec_id", "class")
    asking = cut_lineage(asking)
    queries = classes.select("class", "vector").join(asking.select("class").distinct(), "class", "left_semi")
    queries = cut_lineage(queries)
    total = classes.count()
    kind = "<f4" if rows.schema["vector"].dataType.simpleString() == "array<float>" else "<f8"
    blocks = packed_blocks(classes)
    trees, bits = fitted(classes, queries, dim, total, k, sample_queries)
    found = cut_lineage(searched(blocks, queries, dim, kind, trees, bits, max(trees * total / 2**bits, 20 * k), k))
    # The few queries that found too little are compared with all rows.
    full = found.groupBy("query").count().where(F.col("count") > k)
    short = queries.join(full, F.col("class") == F.col("query"), "left_anti")
    if bits and not short.isEmpty():
        found = found.unionByName(searched(blocks, short, dim, kind, 1, 0, total, k)).distinct()
    answers = asking.withColumnRenamed("vec_id", "query_id").join(found, F.col("class") == F.col("query")).where("query_id != vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = answers.select("query_id", "vec_id", "score").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)
