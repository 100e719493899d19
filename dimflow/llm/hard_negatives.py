"""Hard negatives by threshold joins with pruned inverted lists, after L2AP (Anastasiu and Karypis 2014).

A join finds all rows whose inner product with a query reaches the query's threshold. Dimensions come in groups, each an
inverted list of a block of rows. A row stays out of the lists of its first groups as long as the norm over them, times
what any query of the block has there for its threshold, shows that they alone cannot reach it. Partial scores are
accumulated from the last list on, and pairs are dropped once the norms over the rest rule them out. Thresholds start
where a sample lets enough rows be expected, and are lowered for the queries whose windows are not yet full.

Components are whole numbers so small that all sums are exact in doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimflow.llm.common import table
from dimflow.session import cut_lineage

SCALE, POSITIVES, NEGATIVES, LOW = 256, 5, 5, 80
#: Dimensions of a list; rows and queries that are scored at once; share of live pairs from which they go on one by one.
GROUP, TILE_ROWS, TILE_QUERIES, SPARSE = 8, 4096, 1024, 16
#: Rows whose scores set the first thresholds, and how many rows a window is expected to hold in each round but the last.
SAMPLE, EXPECTED = 2048, (20, 300)
#: Queries of a block. So many are sent to all tasks; more are dealt with the blocks of rows by cells.
QUERY_BLOCK = 4096
#: No score is higher.
TOP = 1 << 53


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> tuple[DataFrame, int]:
    """``vec_id, label, ints`` of the rows that take part, each once, and the number of components."""
    vector = F.col(vector_col).cast("array<double>")
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size(vector) > 0)
    rows = rows.where(F.coalesce(good, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), vector.alias("vector"))
    rows = rows.where("vec_id is not null and label is not null")
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    dim = sizes[0]["dim"] if sizes else 1
    most = float(int((TOP / dim) ** 0.5))
    ints = F.transform("vector", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(most)), F.lit(-most))).cast("int"))
    return rows.where(F.size("vector") == dim).select("vec_id", "label", ints.alias("ints")).distinct(), dim


def classes_of(rows: DataFrame, few: int) -> DataFrame:
    """Distinct vectors of a label, with their ``few`` smallest ids: others of them are never needed."""
    nth = Window.partitionBy("ints", "label").orderBy("vec_id")
    first = rows.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= few)
    return first.groupBy("ints", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def row_blocks(classes: DataFrame, order: np.ndarray) -> DataFrame:
    """Blocks of rows: vectors with their dimensions in ``order``, longest first, with labels and ids."""

    def packed(batches):
        for batch in batches:
            if batch.num_rows:
                vectors = matrix(batch.column("ints"), len(order))[:, order].astype(np.int32)
                by = np.argsort(-(vectors.astype(np.float64) ** 2).sum(axis=1), kind="stable")
                ids = batch.column("ids").take(pa.array(by))
                blobs = vectors[by].tobytes(), batch.column("label").to_numpy()[by].tobytes(), ids.flatten().to_numpy().tobytes(), np.diff(np.append(ids.offsets.to_numpy(), 0)[:-1]).astype(np.int64).tobytes()
                yield pa.RecordBatch.from_pydict({"vectors": [blobs[0]], "labels": [blobs[1]], "ids": [blobs[2]], "n_ids": [blobs[3]]})

    blocks = classes.select("ints", "label", "ids").mapInArrow(packed, "vectors binary, labels binary, ids binary, n_ids binary")
    return blocks.withColumn("block", F.monotonically_increasing_id())


def prefix_norms(vectors: np.ndarray) -> np.ndarray:
    """Norm over the first groups, for none up to all of them."""
    squares = np.add.reduceat(vectors * vectors, np.arange(0, vectors.shape[1], GROUP), axis=1)
    return np.sqrt(np.concatenate([np.zeros((len(vectors), 1)), np.cumsum(squares, axis=1)], axis=1))


def joined(queries: np.ndarray, rows: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs of a query and a row with at least the query's score: ``(query, row, score)`` of a tile at a time."""
    for part in (np.flatnonzero(least > 0), np.flatnonzero(least <= 0)):  # bounds say nothing of thresholds up to 0
        for a in range(0, len(part), TILE_QUERIES):
            asked = part[a : a + TILE_QUERIES]
            for b in range(0, len(rows), TILE_ROWS):
                for q, x, score in joined_tile(queries[asked], rows[b : b + TILE_ROWS], least[asked]):
                    yield asked[q], x + b, score


def joined_tile(queries: np.ndarray, rows: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    groups = -(-rows.shape[1] // GROUP)
    of = lambda g: slice(g * GROUP, (g + 1) * GROUP)
    q_norm, x_norm = prefix_norms(queries), prefix_norms(rows)
    slack = 1e-9 * np.abs(least) + 1e-6
    left_out = np.zeros(len(rows), np.int64)
    if least[0] > 0:
        need = (q_norm / least[:, None]).max(axis=0) * (1 + 1e-9)
        left_out = (x_norm[:, 1:] * need[1:] < 1).sum(axis=1)
    for out in np.unique(left_out[left_out < groups]).tolist():
        listed = np.flatnonzero(left_out == out)
        sums = np.zeros((len(queries), len(listed)))
        pairs = None
        for g in range(groups - 1, out - 1, -1):
            if pairs is None:
                sums += queries[:, of(g)] @ rows[listed, of(g)].T
                rest = q_norm[:, g, None] * (x_norm[listed, g] * (1 + 1e-9))
                live = sums + rest >= (least - slack)[:, None]
                some = live.any(axis=0)
                if not some.all():
                    listed, sums, live = listed[some], sums[:, some], live[:, some]
                if live.sum() * SPARSE < live.size or g == out:
                    q, x = np.nonzero(live)
                    pairs = q, listed[x], sums[q, x]
            else:
                q, x, score = pairs
                score = score + (queries[q, of(g)] * rows[x, of(g)]).sum(axis=1)
                live = score + q_norm[q, g] * x_norm[x, g] * (1 + 1e-9) >= (least - slack)[q]
                pairs = q[live], x[live], score[live]
        q, x, score = pairs
        if out:
            score = score + (queries[q, : out * GROUP] * rows[x, : out * GROUP]).sum(axis=1)
        good = score >= least[q]
        yield q[good], x[good], score[good]


def chosen(block: dict, asked: dict, same: bool, k: int, dim: int) -> pa.RecordBatch:
    """Of each window the first ``k`` ids in each tile of a block: ``q, top, vec_id, score``."""
    rows = np.frombuffer(block["vectors"], np.int32).reshape(-1, dim).astype(np.float64)
    labels, ids, n_ids = (np.frombuffer(block[c], np.int64) for c in ("labels", "ids", "n_ids"))
    ends = np.cumsum(n_ids)
    queries = np.frombuffer(asked["vectors"], np.int32).reshape(-1, dim).astype(np.float64)
    own, names, n_windows, top, least = (np.frombuffer(asked[c], np.int64) for c in ("labels", "names", "n_windows", "top", "least"))
    first = np.concatenate([[0], np.cumsum(n_windows)])
    lowest = np.minimum.reduceat(least, first[:-1]).astype(np.float64)
    highest = np.maximum.reduceat(top, first[:-1]).astype(np.float64)
    out: list[tuple[int, int, int, int]] = []
    sets = [(np.flatnonzero(own == v), np.flatnonzero(labels == v)) for v in np.intersect1d(own, labels)] if same else [(np.arange(len(own)), np.arange(len(labels)))]
    for qs, xs in sets:
        for q, x, score in joined(queries[qs], rows[xs], lowest[qs]):
            q, x = qs[q], xs[x]
            keep = score <= highest[q]
            if not same:
                keep &= own[q] != labels[x]
            q, x, score = q[keep], x[keep], score[keep].astype(np.int64)
            order = np.lexsort((-score, q))
            q, x, score = q[order], x[order], score[order]
            for one in np.unique(q).tolist():
                a, b = np.searchsorted(q, [one, one + 1])
                fall = -score[a:b]
                for w in range(first[one], first[one + 1]):
                    begin = a + int(np.searchsorted(fall, -top[w]))
                    end = a + int(np.searchsorted(fall, -least[w], side="right"))
                    if end - begin > k:  # as many rows as can matter, and those that tie with the last of them
                        end = a + int(np.searchsorted(fall, fall[begin - a + k - 1], side="right"))
                    found = [(-int(score[j]), v) for j in range(begin, end) for v in ids[ends[x[j]] - n_ids[x[j]] : ends[x[j]]].tolist()]
                    out.extend((int(names[one]), int(top[w]), v, -s) for s, v in sorted(found)[:k])
    columns = list(zip(*out)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["q", "top", "vec_id", "score"])


def query_blocks(windows: DataFrame, order: np.ndarray, size: int) -> DataFrame:
    """Blocks of queries with their windows, from ``q, label, ints, top, least``."""

    def packed(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                b = batch.slice(start, size)
                vectors = matrix(b.column("ints"), len(order))[:, order].astype(np.int32)
                cell = {"vectors": vectors.tobytes(), "labels": b.column("label").to_numpy().tobytes(), "names": b.column("q").to_numpy().tobytes()}
                cell["n_windows"] = np.array([len(x) for x in b.column("top").to_pylist()], np.int64).tobytes()
                cell |= {c: b.column(c).flatten().to_numpy().astype(np.int64).tobytes() for c in ("top", "least")}
                yield pa.RecordBatch.from_pydict({c: [v] for c, v in cell.items()})

    columns = ("vectors", "labels", "names", "n_windows", "top", "least")
    grouped = windows.groupBy("q").agg(F.first("label").alias("label"), F.first("ints").alias("ints"), F.collect_list(F.struct("top", "least")).alias("w"))
    grouped = grouped.select("q", "label", "ints", F.col("w.top").alias("top"), F.col("w.least").alias("least"))
    blocks = grouped.mapInArrow(packed, ", ".join(f"{c} binary" for c in columns))
    return blocks.withColumn("asked", F.monotonically_increasing_id())


FOUND = "q long, top long, vec_id long, score long"


def met(blocks: DataFrame, windows: DataFrame, same: bool, k: int, order: np.ndarray, query_block: int) -> DataFrame:
    """``q, top, vec_id, score``: the first ``k`` of every window with scores from ``least`` to ``top``."""
    dim = len(order)
    asked = cut_lineage(query_blocks(windows, order, query_block))
    if windows.select("q").distinct().count() <= query_block:
        few = [r.asDict() for r in asked.collect()]  # query_block queries at most

        def beside(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    block = batch.slice(i, 1).to_pylist()[0]
                    for one in few:
                        yield chosen(block, one, same, k, dim)

        found = blocks.mapInArrow(beside, FOUND)
    else:
        places = lambda df, c: df.select(F.col(c).alias(f"other_{c}"))
        each = lambda df, other, c: df.join(F.broadcast(places(other, c).agg(F.collect_list(f"other_{c}").alias(c))), how="inner").withColumn(c, F.explode(c))
        left, right = each(blocks, asked, "asked"), each(asked, blocks, "block")

        def cell(_, mine: pa.Table, theirs: pa.Table) -> pa.Table:
            if not mine.num_rows or not theirs.num_rows:
                return pa.Table.from_batches([], pa.schema([(c, pa.int64()) for c in ("q", "top", "vec_id", "score")]))
            return pa.Table.from_batches([chosen(mine.to_pylist()[0], theirs.to_pylist()[0], same, k, dim)])

        found = left.groupBy("block", "asked").cogroup(right.groupBy("block", "asked")).applyInArrow(cell, FOUND)
    first = Window.partitionBy("q", "top").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k)


def thresholds(windows: DataFrame, sample: list, total: int, expected: int, same: bool, dim: int) -> DataFrame:
    """Adds ``least``: where ``expected`` rows between it and the top are likely, by the sample's scores; ``floor`` at least."""
    vectors = np.array([r.ints for r in sample], np.float64).reshape(-1, dim)
    labels = np.array([r.label for r in sample], np.int64)
    normal = NormalDist()

    def estimated(batches):
        for big in batches:
            for start in range(0, big.num_rows, 1024):
                batch = big.slice(start, 1024)
                scores = matrix(batch.column("ints"), dim).astype(np.float64) @ vectors.T
                own, top, floor = (batch.column(c).to_numpy() for c in ("label", "top", "floor"))
                least = floor.copy()
                for i in range(len(own)):
                    few = scores[i, (labels == own[i]) == same]
                    if len(few) > 1 and few.std() > 0:
                        rows, mean, spread = total * len(few) / len(labels), few.mean(), few.std()
                        share = (rows * (1 - normal.cdf((top[i] - mean) / spread)) + expected) / rows
                        if share < 1:
                            least[i] = max(floor[i], int(np.floor(mean + spread * normal.inv_cdf(1 - share))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=[*batch.schema.names, "least"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in windows.schema.fields)
    return windows.mapInArrow(estimated, f"{schema}, least long")


def filled(blocks: DataFrame, windows: DataFrame, same: bool, k: int, sample: list, total: int, order: np.ndarray, query_block: int) -> DataFrame:
    """The first ``k`` of every window ``q, label, ints, top, floor``, with thresholds lowered until it is full or
    its floor is reached. All rows from a threshold on are found, so a full window is final."""
    done = None
    for expected in (*EXPECTED, None):
        if expected is None:
            tried = windows.withColumn("least", F.col("floor"))
        else:
            tried = cut_lineage(thresholds(windows, sample, total, expected, same, len(order)))
        found = cut_lineage(met(blocks, tried, same, k, order, query_block))
        full = found.groupBy("q", "top").agg(F.count("*").alias("n"))
        judged = tried.join(full, ["q", "top"], "left").withColumn("final", (F.coalesce("n", F.lit(0)) >= k) | (F.col("least") == F.col("floor")))
        judged = cut_lineage(judged)
        good = found.join(judged.where("final").select("q", "top"), ["q", "top"], "left_semi")
        done = good if done is None else done.unionByName(good)
        windows = judged.where("not final").select("q", "label", "ints", "top", "floor")
        if windows.isEmpty():
            break
    return done


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor (a condition on ``vec_id``) and each of its first ``positives`` other rows of the same label, the
    first ``negatives`` rows of other labels with ``low`` to 100 percent of the positive's score. Higher inner products come first, ties
    by smaller id. Rows without id or label, and vectors that are null or empty, hold null or non-finite
    components or have another length than most (of equally common lengths the shorter counts), take no part.
    Components are ``floor(scale * x)`` held within sqrt(2 ** 53 / length). Rows that repeat id, label and vector count once; an anchor's positives
    have other ids than its own. With fewer rows than asked for all are returned; an anchor without positives, and a
    positive without negatives, give no rows. An empty table gives no rows; other columns are not looked at.
    """
    rows, dim = usable(rows, id_col, vector_col, label_col, scale)
    rows = cut_lineage(rows)
    classes = cut_lineage(classes_of(rows, positives + 1))
    total = classes.count()
    sample = classes.select("ints", "label").orderBy(F.xxhash64("ints", "label"), "label").limit(SAMPLE).collect()
    weight = (np.array([r.ints for r in sample], np.float64).reshape(-1, dim) ** 2).sum(axis=0)
    order = np.argsort(weight, kind="stable")  # light dimensions first: their lists are left out
    blocks = cut_lineage(row_blocks(classes, order))
    anchors = rows.where(is_anchor)
    queries = cut_lineage(anchors.groupBy("ints", "label").agg(F.min("vec_id").alias("least_id")).withColumn("q", F.monotonically_increasing_id()))
    anchors = anchors.join(queries, ["ints", "label"]).select(F.col("vec_id").alias("anchor_id"), "q")
    windows = queries.select("q", "label", "ints", F.lit(TOP).alias("top"), F.lit(-TOP).alias("floor"))
    near = filled(blocks, windows, True, positives + 1, sample, total, order, query_block)
    lists = near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("near"))
    others = F.slice(F.filter("near", lambda p: p["vec_id"] != F.col("anchor_id")), 1, positives)
    pairs = anchors.join(lists, "q").select("anchor_id", "q", F.explode(others).alias("p"))
    pairs = cut_lineage(pairs.select("anchor_id", "q", F.col("p.vec_id").alias("positive_id"), (-F.col("p.minus")).alias("positive_score")))
    tops = pairs.where("positive_score >= 0").select("q", F.col("positive_score").alias("top")).distinct()
    floor = F.ceil(F.col("top") * low / F.lit(100).cast("decimal(3,0)")).cast("long")
    windows = tops.join(queries, "q").select("q", "label", "ints", "top", floor.alias("floor"))
    hard = filled(blocks, cut_lineage(windows), False, negatives, sample, total, order, query_block)
    lists = hard.groupBy("q", F.col("top").alias("positive_score")).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("hard"))
    told = pairs.join(lists, ["q", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.posexplode("hard").alias("pos", "h"))
    return told.select(
        "anchor_id", "positive_id", (F.col("pos") + 1).alias("rank"), F.col("h.vec_id").alias("negative_id"),
        "positive_score", (-F.col("h.minus")).alias("negative_score"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


SQL = """
WITH held AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM held a JOIN held b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.alike
    AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY rank <= 5
"""
