"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value significance.

Each word gets the log-odds of occurring in toxic against other documents, with a Dirichlet prior from both (Monroe,
Colaresi and Quinn 2008). A word that is not well known takes the log-odds of its first bytes. Less a fixed drift, the
scores of a text are a walk that falls where nothing is toxic; one linear scan finds all its maximal segments (Ruzzo
and Tompa 1999). A segment of score S in n words is expected K n exp(-lambda S) times by chance (Karlin and Altschul
1990), and the evidence of a text is the sum of -ln of that over its segments that are expected less than once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.common import byte_sums, inverse_powers, mixed, slices, table, utf8
from dimflow.session import cut_lineage

#: The fit takes about so many labelled documents of each label, dealt by a hash of the id.
SAMPLE_DOCS_PER_LABEL = 10_000
#: Weight of the prior as a share of the sample, and what a word's log-odds must have over their standard error.
PRIOR, LEAST_Z = 0.1, 3.5
#: The model holds at most so many words and beginnings, those with the surest log-odds.
MOST_WORDS = 1 << 16
#: Bytes of the beginnings that stand for unknown words.
BEGINNINGS = (4, 6)
#: What each word costs: unlike words end a segment after some neutral ones.
DRIFT = 1.0
#: Weight that holds the calibration's slope back when labels part without error.
RIDGE = 1e-3
BLANK = 0x20


def _folded() -> np.ndarray:
    """ASCII letters in lower case, digits and other bytes above 127 as they are, the rest blank."""
    fold = np.full(256, BLANK, np.uint8)
    fold[128:] = np.arange(128, 256)
    for first, last, to in (("0", "9", "0"), ("a", "z", "a"), ("A", "Z", "a")):
        fold[ord(first) : ord(last) + 1] = np.arange(ord(to), ord(to) + ord(last) - ord(first) + 1)
    return fold


_FOLD = _folded()


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, the first word of each text, and a row of keys for the words and for each kind of
    beginning (a word no longer than it has the key 0 there); then the bytes and the texts' offsets."""
    raw, offsets = utf8(column)
    data = _FOLD[raw]
    capital = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)) + 1  # À to Þ
    data[capital] += 0x20
    body = data != BLANK
    first, last = body.copy(), body.copy()
    first[1:] &= ~body[:-1]
    last[:-1] &= ~body[1:]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    first[begins] = body[begins]
    last[begins[begins > 0] - 1] = body[begins[begins > 0] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = byte_sums(data)
    lower, scale = sums[starts], inverse_powers(starts)
    keys = np.zeros((1 + len(BEGINNINGS), len(starts)), np.uint64)
    keys[0] = mixed((sums[ends] - lower) * scale)
    for row, n in enumerate(BEGINNINGS, 1):
        long = ends - starts > n
        keys[row, long] = mixed((sums[starts[long] + n] - lower[long]) * scale[long] + np.uint64(n))
    return starts, ends, np.searchsorted(starts, offsets), keys.view(np.int64), raw, offsets


@dataclass
class Model:
    """Sorted keys with their scores (drift taken off), constants of the extreme-value law, and the calibration."""

    keys: np.ndarray
    scores: np.ndarray
    decay: float = 1.0
    rate: float = 1.0
    slope: float = 0.0
    bias: float = 0.0

    def entries(self, keys: np.ndarray) -> np.ndarray:
        """For each word the place of its own key, else of its longest known beginning, else -1."""
        found = np.full(keys.shape[1], -1)
        if len(self.keys):
            few = np.zeros(1 << 16, bool)  # most keys are ruled out by their low bits
            few[self.keys & 0xFFFF] = True
            for row in (*range(1, len(keys)), 0):
                may = np.flatnonzero(few[keys[row] & 0xFFFF] & (keys[row] != 0))
                at = np.minimum(np.searchsorted(self.keys, keys[row, may]), len(self.keys) - 1)
                hit = self.keys[at] == keys[row, may]
                found[may[hit]] = at[hit]
        return found

    def segments(self, keys: np.ndarray, first: np.ndarray) -> Iterator[list[tuple[float, int, int]]]:
        """For each text its maximal segments: score, first and last word."""
        at = self.entries(keys)
        score = np.where(at >= 0, self.scores[at] if len(self.scores) else 0.0, -DRIFT)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            # Each text is summed by itself: the texts before it would change the last bits.
            total = np.concatenate([[0.0], np.cumsum(score[a:b])])
            good = np.flatnonzero(score[a:b] > 0)
            yield maximal_segments(total[good].tolist(), total[good + 1].tolist(), (good + a).tolist()) if len(good) else []

    def surprise(self, score: float, words: int) -> float:
        """Minus the logarithm of how often so high a segment is expected in so many words."""
        return self.decay * score - float(np.log(self.rate * max(words, 1)))

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.slope * np.log1p(evidence), -500, 500)))


def maximal_segments(left: list[float], right: list[float], place: list[int]) -> list[tuple[float, int, int]]:
    """All maximal scoring segments of a walk, from its sums before and after each rising step.

    Kept segments are linked to the last one before them that begins lower; each link is passed once."""
    kept: list[tuple[float, float, int, int, int]] = []  # left, right, first, last, link
    for low, high, at in zip(left, right, place):
        start, link = at, len(kept) - 1
        while True:
            while link >= 0 and kept[link][0] >= low:
                link = kept[link][4]
            if link < 0 or kept[link][1] >= high:
                kept.append((low, high, start, at, link))
                break
            low, _, start, _, before = kept[link]
            del kept[link:]
            link = before
    return [(high - low, start, last) for low, high, start, last, _ in kept]


def labelled(docs: DataFrame, labels: DataFrame, sample_docs: int) -> tuple[DataFrame, dict[int, int]]:
    """``text, toxic`` of a bounded sample of the learning rows, and how many labelled rows there are of each label.

    Equal texts count once with the commoner of their labels (toxic in a tie). Texts of one label with one sketch are
    most likely near copies, whose words would seem to recur; the first of them in order stands for all."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rate = F.lit(0)
    for label, n in sizes.items():
        rate = F.when(F.col("toxic") == label, int(1e6 * min(1.0, sample_docs / n)) + 1).otherwise(rate)
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < rate)
    # About 2 * sample_docs pairs of numbers, whatever the size of the table.
    picked = F.broadcast(picked.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.where(F.col("text").isNotNull()).join(picked, "doc_id").select("text", "toxic")
    once = texts.groupBy("text").agg((2 * F.sum("toxic") >= F.count("*")).cast("int").alias("toxic"))
    sketched = once.repartition(64).mapInArrow(sketches, "text string, toxic int, sketch long")
    return cut_lineage(sketched.groupBy("sketch", "toxic").agg(F.min("text").alias("text")).repartition(64)), sizes


def sketches(batches):
    """Adds the least hash of three words in a row; of all words if there are fewer."""
    for batch in slices(batches, 1 << 20):
        _, _, first, keys, _, _ = tokens(batch.column("text"))
        key = keys[0].view(np.uint64)
        three = mixed(key[:-2] + np.uint64(3) * key[1:-1] + np.uint64(5) * key[2:]).view(np.int64)
        sketch = [
            three[a : b - 2].min() if b - a > 2 else int(keys[0, a:b].sum()) for a, b in zip(first[:-1].tolist(), first[1:].tolist())
        ]
        yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("toxic"), pa.array(sketch, pa.int64())], names=["text", "toxic", "sketch"])


def counted(batches):
    """Of each key, in how many texts of each label it occurs."""
    for batch in slices(batches, 1 << 20):
        _, _, first, keys, _, _ = tokens(batch.column("text"))
        toxic = batch.column("toxic").to_numpy()
        text = np.repeat(np.arange(batch.num_rows), np.diff(first))
        for row in keys:
            known = row != 0
            pairs = np.unique(np.stack([row[known], text[known]]), axis=1)
            values, which = np.unique(pairs[0], return_inverse=True)
            bad = np.bincount(which, weights=toxic[pairs[1]], minlength=len(values)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"key": values, "n": np.bincount(which, minlength=len(values)), "bad": bad})


def log_odds(sample: DataFrame, most_words: int) -> DataFrame:
    """``key, odds, clean``: log-odds that stand out of their error, and the prior-smoothed share of other texts."""
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    counts = sample.mapInArrow(counted, "key long, n long, bad long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    prior = PRIOR * F.col("n")
    in_bad, in_good = F.col("bad") + prior, F.col("n") - F.col("bad") + prior
    all_bad, all_good = bad + PRIOR * (bad + good), good + PRIOR * (bad + good)
    odds = F.log(in_bad / all_bad) - F.log(in_good / all_good)
    judged = counts.select("key", odds.alias("odds"), (in_good / all_good).alias("clean"), (odds / F.sqrt(1 / in_bad + 1 / in_good)).alias("z"))
    return judged.where(F.abs("z") >= LEAST_Z).orderBy(F.desc(F.abs("z")), "key").limit(most_words)


def decay_of(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of E exp(lambda s) = 1 for the scores of words of other texts."""
    if not (scores > 0).any() or share @ scores >= 0:
        return 1.0
    low, high = 0.0, 1.0
    grows = lambda x: share @ np.exp(np.minimum(x * scores, 700.0)) > 1
    while not grows(high):
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if grows(mid) else (mid, high)
    return low if low > 1e-6 else 1.0


def calibrated(evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a logistic curve over log(1 + evidence), by Newton steps."""
    x = np.stack([np.log1p(evidence), np.ones(len(evidence))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + RIDGE * weight.sum() * np.array([w[0], 0.0])
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + RIDGE * weight.sum() * np.diag([1.0, 1e-3])
        step = np.linalg.solve(curve, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def learn(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS_PER_LABEL, most_words: int = MOST_WORDS) -> Model:
    """Fit on documents (``doc_id, text``) whose labels are known and not held out. The sample is bounded by
    ``sample_docs`` a label, and the model by ``most_words``. Without both labels every text gets the same score."""
    sample, sizes = labelled(docs, labels, sample_docs)
    lexicon = log_odds(sample, most_words).toPandas().sort_values("key")
    keys, odds = lexicon["key"].to_numpy(np.int64), lexicon["odds"].to_numpy(np.float64)
    model = Model(keys, odds - DRIFT)

    def measured(batches):
        """Of each text its words and its best segment; of each slice how often other texts have an entry."""
        for batch in slices(batches, 1 << 20):
            _, _, first, found, _, _ = tokens(batch.column("text"))
            toxic, best = batch.column("toxic"), [max((s[0] for s in x), default=0.0) for x in model.segments(found, first)]
            n, none = batch.num_rows, None
            yield pa.RecordBatch.from_pydict({"toxic": toxic, "n": np.diff(first), "best": best, "entry": pa.array([none] * n, pa.int64())})
            entry = model.entries(found)[np.repeat(toxic.to_numpy() == 0, np.diff(first))]
            values, times = np.unique(entry, return_counts=True)
            yield pa.RecordBatch.from_pydict({"toxic": np.zeros(len(values), np.int32), "n": times, "best": np.zeros(len(values)), "entry": values})

    seen = cut_lineage(sample.mapInArrow(measured, "toxic int, n long, best double, entry long"))
    times = seen.where("entry is not null").groupBy("entry").agg(F.sum("n").alias("n")).toPandas()
    # In order, so that sums of fractions do not depend on which task ended first.
    texts = seen.where("entry is null").select("toxic", "n", "best").toPandas().sort_values(["toxic", "n", "best"])
    share = np.zeros(len(keys) + 1)
    share[times["entry"].to_numpy(np.int64)] = times["n"].to_numpy(np.float64)  # -1, the last: words without entry
    total = max(share.sum(), 1.0)
    per_text = total / max((texts["toxic"] == 0).sum(), 1)
    # A word that other texts lack would make chance segments impossible; it gets its prior share.
    share[:-1] = np.maximum(share[:-1], lexicon["clean"].to_numpy(np.float64) * total / per_text)
    model.decay = decay_of(np.append(model.scores, -DRIFT), share / share.sum())
    clean = texts[(texts["toxic"] == 0) & (texts["n"] > 0)]
    chance = (clean["n"] * np.exp(-np.minimum(model.decay * clean["best"], 700.0))).sum()
    # Most likely rate, where half a chance segment is counted besides the observed ones.
    model.rate = float(((clean["best"] > 0).sum() + 0.5) / chance) if chance > 0 else 1.0

    def weighed(batches):
        for batch in slices(batches, 1 << 20):
            _, _, first, found, _, _ = tokens(batch.column("text"))
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "evidence": [float(sum(e for e, _ in x)) for x in significant(model, found, first)]})

    told = sample.mapInArrow(weighed, "toxic int, evidence double").toPandas().sort_values(["toxic", "evidence"])
    toxic = told["toxic"].to_numpy(np.float64)
    if len(told) and 0 < toxic.sum() < len(toxic):
        share_bad = sizes[1] / (sizes[0] + sizes[1])  # the sample's labels are weighted back to their shares
        weight = np.where(toxic == 1, share_bad / toxic.mean(), (1 - share_bad) / (1 - toxic.mean()))
        model.slope, model.bias = calibrated(told["evidence"].to_numpy(np.float64), toxic, weight)
    elif len(told):
        model.bias = 5.0 if toxic.all() else -5.0
    else:
        model.bias = -5.0
    return model


def significant(model: Model, keys: np.ndarray, first: np.ndarray) -> Iterator[list[tuple[float, tuple[float, int, int]]]]:
    """Of each text the segments expected less than once, each with minus the logarithm of its expectation."""
    for words, found in zip(np.diff(first).tolist(), model.segments(keys, first)):
        judged = ((model.surprise(s[0], words), s) for s in found)
        yield [(e, s) for e, s in judged if e > 0]


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))


PASSAGES = "array<struct<start:bigint,end:bigint,score:double,expected:double>>"


def with_toxicity(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """The columns ``carry`` of ``docs``, ``score``, and ``passages`` (code points, end exclusive) of the column ``text``."""
    passage = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

    def scored(batches):
        for batch in slices(batches, 1 << 20):
            starts, ends, first, keys, raw, offsets = tokens(batch.column("text"))
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            evidence, spans = np.zeros(batch.num_rows), []
            for i, found in enumerate(significant(model, keys, first)):
                evidence[i] = sum(e for e, _ in found)
                spans.append([
                    {"start": int(points[starts[a]] - points[offsets[i]]), "end": int(points[ends[b]] - points[offsets[i]]), "score": s, "expected": float(np.exp(-e))}
                    for e, (s, a, b) in found
                ])
            kept = [batch.column(c) for c in carry]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(model.probability(evidence)), pa.array(spans, passage)], names=[*carry, "score", "passages"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in carry)
    return docs.select(*carry, "text").mapInArrow(scored, f"{types}, score double, passages {PASSAGES}")


def judge(
    docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS_PER_LABEL,
    id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic",
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, passages``.

    Learns from labels 0 and 1 whose crc32 of the id modulo 5 is not 0; other values, null labels and ids teach nothing.
    An id with several labels is toxic if one of them is 1; equal texts count once in the fit. ``score`` is the
    probability of label 1, ``predicted`` whether it is 0.5 or more. Null, empty and wordless texts have no passage and
    the score that goes with that. Repeated rows and rows without id are judged like others (not held out without id).
    Without labels of both kinds all texts score alike. An empty table gives no rows; other columns are not looked at.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    labels = labels.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).alias("toxic"))
    model = learn(docs, labels, sample_docs)
    judged = with_toxicity(docs.select("doc_id", held_out().alias("held_out"), "text"), model, ["doc_id", "held_out"])
    return judged.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "passages")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
