"""Toxic passages, vector codes and hard negatives against brute force, on odd rows and on the small tables."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dimflow.llm import hard_negatives, toxicity, vector_codes
from tests.llm import brute

VECTORS = "vec_id long, embedding array<double>, label int"


def odd_vectors(n=260, dim=16):
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 0.2) for _ in range(dim)], r.randrange(4)) for i in range(n)]
    rows += [(n + i, rows[7][1], i % 3) for i in range(60)]  # many copies of one vector
    rows += [(500, [0.0] * dim, 1), (501, [-0.1] * dim, 1), (600, rows[3][1], 2), (700, [1e-200] * dim, 0)]
    return rows


def unusable(dim=16):
    bad = [None, [], [None] * dim, [float("nan")] + [0.1] * (dim - 1), [float("inf")] + [0.1] * (dim - 1), [0.1] * (dim - 1)]
    return [(900 + i, v, 1) for i, v in enumerate(bad)]


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def clashing(df):
    for name in ("ints", "q", "top", "least", "pos", "part", "n", "code", "error", "score", "toxic", "text2", "key"):
        df = df.withColumn(name, F.lit("x"))
    return df


# Vector codes


@pytest.mark.parametrize("label", [True, False])
def test_codes_equal_brute_force(spark, label):
    rows = [(i, v, k if i % 5 else None) for i, v, k in odd_vectors()]
    df = clashing(spark.createDataFrame(rows + unusable(), VECTORS).repartition(5))
    coded, books = vector_codes.compress(df, label_col="label" if label else None)
    told = vector_codes.with_label_error(coded).withColumn("sha", F.lit(vector_codes.digest(books)))
    want = brute.vector_codes([(i, v, k if label else None) for i, v, k in rows])
    assert got(told, "vec_id", "code", "error", "label_error", "sha") == sorted(want, key=repr)


def test_codes_with_many_labels_are_salted(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 1)
    rows = odd_vectors()
    coded, _ = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
    want = [(i, e) for i, _, _, e, _ in brute.vector_codes(rows)]
    assert got(vector_codes.with_label_error(coded), "vec_id", "label_error") == sorted(want, key=repr)


def test_codes_of_few_odd_and_no_rows(spark):
    rows = [(i, [0.1 * i, -0.2, 0.3, 0.0, 1e300], None) for i in range(5)] + [(1, [0.1, -0.2, 0.3, 0.0, 1e300], None), (None, [0.4] * 5, None)]
    coded, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
    assert coded.count() == 7 and all(len(b) == 5 for b in books)
    assert all(r.error >= 0 for r in coded.collect())
    none, books = vector_codes.compress(spark.createDataFrame(unusable()[:5], VECTORS))
    assert none.count() == 0 and vector_codes.with_label_error(none).count() == 0
    assert vector_codes.digest(books)


def test_nearest_entries_share_prefixes():
    r = np.random.default_rng(2)
    leaves = np.unique(r.integers(-3, 4, (5000, 4)), axis=0)
    book = r.integers(-3, 4, (16, 4))
    plain = ((leaves[:, None] - book[None]) ** 2).sum(axis=2)
    entry, error = vector_codes.nearest_entries(leaves, book)
    assert (entry == plain.argmin(axis=1)).all() and (error == plain.min(axis=1)).all()


def test_part_keys_keep_order_and_values():
    values = np.array([[-5, 3], [-5, 4], [0, -1], [7, 7], [1 << 27, -(1 << 27)]])
    keys = vector_codes.part_key(values)
    assert keys == sorted(keys)
    assert (vector_codes.part_values(pa.array(keys), 2) == values).all()


def test_decoded_vectors_have_the_told_error(spark):
    rows = odd_vectors()[:200]
    coded, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS))
    of = {i: np.floor(4096 * np.array(v)) for i, v, _ in rows}
    for r in vector_codes.decode(coded, books).collect():
        assert round(((np.array(r.vector) * 4096 - of[r.vec_id]) ** 2).sum()) == r.error


# Hard negatives


@pytest.mark.parametrize("query_block", [4096, 2])
def test_hard_negatives_equal_brute_force(spark, query_block):
    rows = [(i, v, k if i % 11 else None) for i, v, k in odd_vectors()]
    df = clashing(spark.createDataFrame(rows + unusable() + rows[:20] + [(None, rows[0][1], 1)], VECTORS).repartition(5))
    found = hard_negatives.mine(df, F.col("vec_id") % 20 == 0, query_block=query_block)
    assert got(found) == sorted(brute.hard_negatives(rows, anchors=20), key=repr)


def test_hard_negatives_lower_their_thresholds(spark, monkeypatch):
    """With estimates that are too high every window is filled at its floor."""
    monkeypatch.setattr(hard_negatives, "EXPECTED", (1, 2))
    rows = odd_vectors()
    found = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0)
    assert got(found) == sorted(brute.hard_negatives(rows, anchors=10), key=repr)


def test_hard_negatives_of_few_and_no_rows(spark):
    rows = [(0, [0.5, 0.1], 1), (1, [0.4, 0.1], 1), (2, [0.4, 0.09], 2), (3, [1e300, 0.0], 3), (100, [-0.5, 0.0], 4), (101, [0.5, 0.0], 4)]
    found = hard_negatives.mine(spark.createDataFrame(rows[:3], VECTORS), F.col("vec_id") % 100 == 0)
    assert got(found) == sorted(brute.hard_negatives(rows[:3]), key=repr)
    assert hard_negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0).count() > 0
    for none in ([], rows[2:3], unusable()):
        assert hard_negatives.mine(spark.createDataFrame(none, VECTORS), F.col("vec_id") % 2 == 0).count() == 0


@pytest.mark.parametrize("level", [None, 0.0, 0.2, 0.6])
def test_joined_finds_all_pairs(level):
    r = np.random.default_rng(3)
    rows, queries = r.integers(-60, 60, (900, 21)).astype(float), r.integers(-60, 60, (40, 21)).astype(float)
    rows[::3] *= 0.0
    rows[1::3] = np.floor(rows[1::3] / 9)
    plain = queries @ rows.T
    least = np.full(40, -1e12) if level is None else np.floor(level * plain.max(axis=1))
    least[::7] = -5
    found = {(int(q), int(x)): s for qs, xs, ss in hard_negatives.joined(queries, rows, least) for q, x, s in zip(qs, xs, ss)}
    assert found == {(int(q), int(x)): plain[q, x] for q, x in zip(*np.nonzero(plain >= least[:, None]))}


# Toxic passages


def best_runs(scores, base=0):
    """The highest run, and those left and right of it."""
    runs = [(sum(scores[a:b]), -(b - a), -a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
    if not runs or max(runs)[0] <= 0:
        return []
    total, _, a, b = max(runs)
    return [*best_runs(scores[:-a], base), (total, base - a, base + b - 1), *best_runs(scores[b:], base + b)]


def test_maximal_segments_equal_their_definition():
    r = random.Random(4)
    for _ in range(300):
        scores = [float(r.choice([-3, -2, -1, 1, 2, 5]) * 64 + 2 ** r.randrange(5) * 0.001 + r.random() * 1e-4) for _ in range(r.randrange(0, 14))]
        sums = np.concatenate([[0.0], np.cumsum(scores)])
        good = [i for i, s in enumerate(scores) if s > 0]
        found = toxicity.maximal_segments([sums[i] for i in good], [sums[i + 1] for i in good], good)
        assert [(a, b) for _, a, b in found] == [(a, b) for _, a, b in best_runs(scores)]
        assert [s for s, _, _ in found] == pytest.approx([s for s, _, _ in best_runs(scores)])


def test_words_are_runs_of_letters_and_digits():
    texts = ["Éa ÉA éa eA", None, "", "one-two ONE", "#", "x", "one"]
    starts, ends, first, keys, raw, _ = toxicity.tokens(pa.array(texts))
    words = [bytes(raw[a:b]).decode() for a, b in zip(starts, ends)]
    assert words == [w for t in texts for w in re.findall(r"[^\W_]+", t or "")]
    assert np.diff(first).tolist() == [len(re.findall(r"[^\W_]+", t or "")) for t in texts]
    same = lambda a, b: keys[0][words.index(a)] == keys[0][words.index(b)]
    assert same("Éa", "ÉA") and same("ONE", "one") and not same("one", "two") and keys[0][-1] == keys[0][words.index("one")]


def invented(n=3000):
    r = random.Random(8)
    calm, harsh = [f"calm{i}" for i in range(400)], [f"zzharsh{i}" for i in range(12)]
    docs, labels = [], []
    for i in range(n):
        words, toxic = [r.choice(calm) for _ in range(r.randint(5, 200))], i % 9 == 0
        for _ in range(r.randint(2, 5) if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(harsh))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxic_documents_are_told_apart_and_passages_found(spark):
    docs, labels = invented()
    held = {r.doc_id for r in spark.createDataFrame(docs, "doc_id long, text string").where(toxicity.held_out()).collect()}
    table = clashing(spark.createDataFrame(docs + [(None, "calm1"), (-1, None), (-2, ""), (-3, "zzharsh1 zzharsh2 " * 60_000)], "doc_id long, text string"))
    given = clashing(spark.createDataFrame(labels + [(None, 1), (1, None), (2, 7)], "doc_id long, toxic int").withColumnRenamed("toxic", "mark"))
    rows = toxicity.judge(table, given, label_col="mark").collect()
    of = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    judged = [(of[i].predicted, y) for i, y in labels if i in held]
    assert sum(p for p, y in judged if y) >= 0.95 * sum(y for _, y in judged) and not any(p for p, y in judged if not y)
    assert all(of[i].held_out == (i in held) for i, _ in docs) and not of[None].held_out
    assert of[-1].score == of[-2].score < 0.5 and of[-3].predicted == 1
    texts = dict(docs)
    for i in [i for i, y in labels if y][:50]:
        words = re.findall(r"zzharsh\d+", texts[i])
        inside = [w for p in of[i].passages for w in re.findall(r"zzharsh\d+", texts[i][p.start : p.end])]
        assert len(inside) >= len(words) - 1
        assert all(texts[i][p.start : p.end].split()[0].startswith("zzharsh") and p.expected < 1 for p in of[i].passages)


def test_copies_and_held_out_labels_teach_nothing(spark):
    docs, labels = invented(1200)
    copies = [(i, "oddword " + " ".join(f"unlike{j}" for j in range(60))) for i in range(5000, 5400)]
    table = spark.createDataFrame(docs + copies + [(9000, "oddword")], "doc_id long, text string")
    held = F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic"))
    right = spark.createDataFrame(labels + [(i, 1) for i, _ in copies], "doc_id long, toxic int")
    a = got(toxicity.judge(table, right), "doc_id", "score")
    assert a == got(toxicity.judge(table, right.select("doc_id", held.alias("toxic"))), "doc_id", "score")
    assert dict(a)[9000] < 0.5


def test_without_labels_all_score_alike(spark):
    docs, labels = invented(60)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for some in ([], [(i, 0) for i, _ in labels], [(i, 1) for i, _ in labels]):
        rows = toxicity.judge(table, spark.createDataFrame(some, "doc_id long, toxic int")).collect()
        assert len(rows) == 60 and len({r.score for r in rows}) == 1
    assert toxicity.judge(table.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0


def test_op11_on_the_larger_tables(spark):
    """Held-out accuracy, as SQL cannot express the operator."""
    rows = toxicity.op11_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = rows.where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("share")).collect()
    share = {r.toxic: r.share for r in judged}
    assert share[1] >= 0.9 and share[0] <= 0.02
