"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.common import slices, table

#: N-grams of 1 to 3 letters hash into so many buckets.
BUCKETS = 1 << 15
#: The fit takes about so many documents of each language, dealt by a hash of the id.
SAMPLE_DOCS_PER_LANG = 2000
SMOOTHING = 0.5
#: Bytes of text whose n-grams are held at once.
SLICE = 1 << 18
#: The pipeline rejects documents below this score.
LEAST_SCORE = 0.5


class Letters:
    """Code points to lower-case letters, others to 0."""

    low: np.ndarray | None = None

    @classmethod
    def of(cls, points: np.ndarray) -> np.ndarray:
        if cls.low is None:
            cls.low = np.array([cls.one(p) for p in range(1 << 16)], np.uint32)
        found = cls.low[np.minimum(points, 0xFFFF)]
        if len(high := np.flatnonzero(points > 0xFFFF)):
            values, where = np.unique(points[high], return_inverse=True)
            found[high] = np.array([cls.one(int(p)) for p in values], np.uint32)[where]
        return found

    @staticmethod
    def one(point: int) -> int:
        return ord(chr(point).lower()[0]) if chr(point).isalpha() else 0


def ngrams(texts: list[str | None], buckets: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Bucket of each n-gram (an array for each n, by the place of its first letter), where the
    texts begin, and how many letters each has. Two blanks part the texts."""
    parts = [(t or "") + "\0\0" for t in texts]
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    c = Letters.of(points)
    counts = np.add.reduceat((c > 0).astype(np.int64), starts[:-1])
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    grams = [(c * np.uint32(2654435761)) >> shift]
    key = c * np.uint32(0x01000193)
    for n in (2, 3):
        key = (key[:-1] ^ c[n - 1 :]) * np.uint32(0x85EBCA6B)
        found = np.concatenate([((key ^ (key >> np.uint32(15))) * np.uint32(2654435761)) >> shift, np.zeros(n - 1, np.uint32)])
        found[starts[1:] - 1] = found[starts[1:] - 2] = 0  # would reach into the next text
        grams.append(found)
    return grams, starts, counts


def fit(docs: DataFrame, learn: Column, sample_docs: int, buckets: int) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities: a row for each bucket, a last row with the priors.

    Counting is done by Spark; the driver gets one count for each language and bucket at most.
    """
    known = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((buckets + 1, 0), np.float32)
    rates = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(1e6 * min(1.0, sample_docs / n)) + 1)])
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < rates[F.col("lang")])
    number = {lang: i for i, lang in enumerate(langs)}

    def counted(batches):
        counts = np.zeros((len(langs), buckets), np.int64)
        for batch in slices(batches, SLICE):
            grams, starts, _ = ngrams(batch.column("text").to_pylist(), buckets)
            of = np.repeat([number[x] for x in batch.column("lang").to_pylist()], np.diff(starts))
            for g in grams:
                counts += np.bincount(of * buckets + g, minlength=len(langs) * buckets).reshape(counts.shape)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"at": at, "n": counts.ravel()[at]})

    found = picked.select("lang", "text").mapInArrow(counted, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(langs) * buckets)
    counts[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    counts = counts.reshape(len(langs), buckets) + SMOOTHING
    priors = np.log(np.array([sizes[lang] for lang in langs], np.float64) / sum(sizes.values()))
    log_p = np.log(counts / counts.sum(axis=1, keepdims=True))
    return langs, np.vstack([log_p.T, priors]).astype(np.float32)


def with_language(
    docs: DataFrame, model: tuple[list[str], np.ndarray], carry: list[str],
    text_col: str = "text", lang_as: str = "lang_pred", score_as: str = "score",
) -> DataFrame:
    """The columns ``carry`` of each row, its predicted language and that language's posterior."""
    langs, log_p = model
    matrix = docs.sparkSession.sparkContext.broadcast(log_p)  # buckets x languages of float32

    def scored(batches):
        weights, priors = matrix.value[:-1], matrix.value[-1].astype(np.float64)
        buckets = len(weights)
        for batch in slices(batches, SLICE):
            grams, starts, letters = ngrams(batch.column("text").to_pylist(), buckets)
            known = letters > 0
            if langs:
                total = weights[grams[0]]
                for g in grams[1:]:
                    total += weights[g]
                sums = np.add.reduceat(total, starts[:-1], axis=0, dtype=np.float64) + priors
                best = sums.argmax(axis=1)
                sums = np.exp(sums - sums.max(axis=1, keepdims=True))
                score = np.where(known, sums.max(axis=1) / sums.sum(axis=1), 0.0)
                named = [langs[b] if k else "und" for b, k in zip(best, known)]
            else:
                named, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            kept = [batch.column(i) for i in range(len(carry))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(named, pa.string()), pa.array(score)], names=[*carry, lang_as, score_as])

    given = docs.select(*(F.col(f"`{c}`") for c in carry), F.col(text_col).cast("string").alias("text"))
    if "text" in carry:
        given = docs.select(*(F.col(f"`{c}`") for c in carry))
    schema = T.StructType([*given.schema.fields[: len(carry)], T.StructField(lang_as, T.StringType()), T.StructField(score_as, T.DoubleType())])
    return given.mapInArrow(scored, schema)


def learn(docs: DataFrame, sample_docs: int, buckets: int) -> tuple[list[str], np.ndarray]:
    return fit(docs, F.col("doc_id").isNotNull() & ~held_out(), sample_docs, buckets)


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def identify(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS_PER_LANG, buckets: int = BUCKETS,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Learns from documents whose crc32 of the id modulo 4 is not 2 and whose lang and text are not
    null; a row without id is not learnt from nor held out. ``score`` is the posterior of the
    predicted language. Texts that are null or have no letter get ``und`` and 0; so do all if there
    is nothing to learn from. Ties go to the language first in order. Repeated rows are judged alike;
    an empty table gives no rows; other columns are not looked at. Whole texts are scored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    given = docs.select("doc_id", held_out().alias("held_out"), "text")
    return with_language(given, learn(docs, sample_docs, buckets), ["doc_id", "held_out"])


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: drop documents without a language, or whose language is in doubt (a score below LEAST_SCORE).

    Null texts and texts without letters go; so do all if no row has text and lang to learn from. Repeated rows are
    judged alike and rows without id like others; columns ``__lang_pred`` and ``__score`` must not be there. An empty
    table gives no rows."""
    model = learn(docs, SAMPLE_DOCS_PER_LANG, BUCKETS)
    judged = with_language(docs, model, docs.columns, lang_as="__lang_pred", score_as="__score")
    return judged.where((F.col("__lang_pred") != "und") & (F.col("__score") >= LEAST_SCORE)).select(*(F.col(f"`{c}`") for c in docs.columns))
