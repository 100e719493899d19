"""Token counts: words in a trie, forward scores once for each shared prefix."""

from __future__ import annotations

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dimflow.llm.common import frame, id_and_text, slices, table
from dimflow.llm.unigram import KEPT_WORDS, LONG_WORD, Vocabulary, marked, vocabulary, words_of

PIECES = "piece_bpe_32k.model"


class Trie:
    """Nodes are [children, best score to here, tokens of that path, tokens of the word that ends here]."""

    def __init__(self, pieces: Vocabulary):
        self.pieces, self.root = pieces, [{}, 0.0, 0, None]

    def add(self, word: str) -> int:
        """Tokens of the word. Only characters below a new prefix are scored."""
        letters = marked(word)
        node, scores, counts, n = self.root, [0.0], [0], 0
        if len(letters) <= LONG_WORD:
            for letter in letters:
                child = node[0].get(letter)
                if child is None:
                    break
                node, n = child, n + 1
                scores.append(node[1])
                counts.append(node[2])
        self.pieces.extend(letters, scores, counts, [])
        if len(letters) <= LONG_WORD:
            for n in range(n, len(letters)):
                node[0][letters[n]] = node = [{}, scores[n + 1], counts[n + 1], None]
            node[3] = counts[-1]
        return counts[-1]


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])


def token_counts(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its marked words and its tokens (``doc_id, n_words, n_tokens``).

    Each slice of texts puts the distinct words that its worker has not counted lately into one
    trie, so there is no shuffle, and memory is bounded by the slice and the store. A null or
    empty text has none. Null ids and repeated rows are counted like others; an empty table gives no rows; other columns
    are not looked at. ``model_path`` must be readable on every executor.
    """

    def counted(batches):
        pieces = vocabulary(model_path or public_tokenizers.path(PIECES))
        known: dict[str, int] = {}
        for batch in slices(batches):
            words = [words_of(t, pieces) for t in batch.column("text").to_pylist()]
            if len(known) > KEPT_WORDS:
                known.clear()
            trie = Trie(pieces)
            for word in {w for ws in words for w in ws}.difference(known):
                known[word] = trie.add(word)
            count = known.__getitem__
            yield frame(OUT, doc_id=batch.column("doc_id"), n_words=[len(ws) for ws in words], n_tokens=[sum(map(count, ws)) for ws in words])

    return id_and_text(docs, id_col, text_col).mapInArrow(counted, "doc_id long, n_words long, n_tokens long")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
