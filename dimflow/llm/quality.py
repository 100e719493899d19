"""Quality rules as a short-circuit cascade.

The cost and the selectivity of each rule are estimated on a sample, on the executors. Rules then
run in descending order of rejections per cost, and a document leaves at its first failed rule.
The verdict is that of all rules together, so the order changes the time and ``rejected_by`` only.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.common import frame, id_and_text, slices, table

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Documents whose rules are timed to order the cascade.
SAMPLE_DOCS = 512


class Profile:
    """Measures of one text, each computed when first asked for. Words end at ASCII white space."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        times, covered, end = Counter(windows), 0, 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered += i + 3 - max(i, end)
                end = i + 3
        return covered

    @cached_property
    def n_distinct(self) -> int:
        return len(set(self.words))


Rule = Callable[[Profile], bool]

BASE_RULES: dict[str, Rule] = {
    "few_words": lambda p: p.n_words < 50,
    "repeated_words": lambda p: 100 * p.n_repeat_words > 50 * p.n_words,
}
#: True rejects. All are in whole numbers, so that SQL gives the same verdicts.
RULES: dict[str, Rule] = {
    **BASE_RULES,
    "symbols": lambda p: 10 * p.n_symbols > p.n_words,
    "repeated_lines": lambda p: 2 * p.n_dup_lines > len(p.lines),
    "word_length": lambda p: not 2 * p.n_words <= p.word_chars <= 15 * p.n_words,
    "few_distinct_words": lambda p: 10 * p.n_distinct < p.n_words,
}


def estimate(docs: DataFrame, rules: dict[str, Rule] = RULES, sample_docs: int = SAMPLE_DOCS) -> dict[str, tuple[float, float]]:
    """Seconds a document and share rejected, by rule, over at most ``sample_docs`` documents.

    The sample is dealt by a hash of the id. Each rule is timed on a fresh profile.
    """
    total = docs.count()
    if not total:
        return {name: (0.0, 0.0) for name in rules}
    rate = min(1.0, sample_docs / total)
    picked = docs.where(F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(1_000_000)) < int(rate * 1_000_000) + 1).limit(sample_docs)

    def timed(batches):
        for batch in batches:
            names, seconds, rejected = [], [], []
            for text in batch.column("text").to_pylist():
                for name, rule in rules.items():
                    start = time.perf_counter()
                    fails = rule(Profile(text))
                    seconds.append(time.perf_counter() - start)
                    names.append(name)
                    rejected.append(float(fails))
            yield pa.RecordBatch.from_pydict({"rule": names, "seconds": seconds, "rejected": rejected})

    found = (
        picked.mapInArrow(timed, "rule string, seconds double, rejected double")
        .groupBy("rule").agg(F.avg("seconds").alias("seconds"), F.avg("rejected").alias("rejected"))
        .collect()
    )
    return {name: (0.0, 0.0) for name in rules} | {r.rule: (r.seconds, r.rejected) for r in found}


def cascade_order(costs: dict[str, tuple[float, float]]) -> list[str]:
    """Most rejections per second first; ties by name."""
    return sorted(costs, key=lambda name: (-costs[name][1] / max(costs[name][0], 1e-9), name))


OUT = pa.schema(
    [("doc_id", pa.int64())]
    + [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("rejected_by", pa.string())]
)


def quality_cascade(
    docs: DataFrame, rules: dict[str, Rule] = RULES, sample_docs: int = SAMPLE_DOCS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: measures, the base verdict, the cascade's verdict and its first failed rule.

    A null text counts as empty and fails for want of words. A null id and repeated rows are
    judged like any other row; an empty table gives no rows. Other columns are not looked at.
    """
    docs = id_and_text(docs, id_col, text_col)
    order = cascade_order(estimate(docs, rules, sample_docs))
    steps = [(name, rules[name]) for name in order]
    base = list(BASE_RULES.values())

    def judged(batches):
        for batch in slices(batches):
            profiles = [Profile(t) for t in batch.column("text").to_pylist()]
            measures = {n: [] for n in OUT.names[1:6]}
            failed, by = [], []
            for p in profiles:
                by.append(next((name for name, rule in steps if rule(p)), None))
                failed.append(any(rule(p) for rule in base))
                for n, values in measures.items():
                    values.append(getattr(p, n))
            yield frame(OUT, doc_id=batch.column("doc_id"), **measures, base_failed=failed, kept=[b is None and not f for b, f in zip(by, failed)], rejected_by=by)

    return docs.mapInArrow(judged, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_cascade(table(spark, sf_dir, "documents")).drop("rejected_by")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
l AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d)
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
t AS (SELECT k, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS tri
      FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT k, count(DISTINCT j) AS n_repeat_words
      FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j
            FROM (SELECT k, i, count(*) OVER (PARTITION BY k, tri) AS c FROM t) WHERE c > 1) GROUP BY k),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words,
        len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines, len(list_distinct(words)) AS n_distinct
      FROM w LEFT JOIN l USING (k) LEFT JOIN r USING (k)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
       OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_distinct < n_words) AS kept
FROM b
"""
