"""SentencePiece encoding by a shared-prefix Viterbi search, and decoding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimflow.llm.common import id_and_text, slices, table
from dimflow.llm.unigram import KEPT_WORDS, Vocabulary, marked, vocabulary, words_of

PIECES = "piece_bpe_32k.model"
#: Bytes of text, or ids, that are handled at once.
SLICE = 2 << 20


def encode_sorted(words: list[str], pieces: Vocabulary) -> dict[str, bytes]:
    """Ids (int32) of words. Sorted words are the leaves of a trie in depth-first order: the
    forward scores of the prefix shared with the word before are still on the stack."""
    found, before = {}, ""
    scores, counts, sizes = [0.0], [0], [0]
    for letters, word in sorted((marked(w), w) for w in words):
        shared = 0
        for x, y in zip(before, letters):
            if x != y:
                break
            shared += 1
        for stack in (scores, counts, sizes):
            del stack[shared + 1 :]
        pieces.extend(letters, scores, counts, sizes)
        found[word] = pieces.path_ids(letters, sizes).tobytes()
        before = letters
    return found


def encode(
    docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", check: bool = False,
) -> DataFrame:
    """``doc_id, text, ids array<int>`` of each document: the best unigram path of its whole text.

    With ``check``, ``round_trip`` instead of ``text``: whether the ids decode to the text again. A null text has null
    ids, an empty one none. Null ids and repeated rows are encoded like others; an
    empty table gives no rows; other columns are not looked at. Distinct words of a slice are encoded together; a bounded
    store keeps those of earlier slices. ``model_path`` must be readable on every executor.
    """

    def encoded(batches):
        pieces = vocabulary(model_path or public_tokenizers.path(PIECES))
        known: dict[str, bytes] = {}
        for batch in slices(batches, SLICE):
            texts = batch.column("text")
            words = [None if t is None else words_of(t, pieces) for t in texts.to_pylist()]
            if len(known) > KEPT_WORDS:
                known.clear()
            known.update(encode_sorted(list({w for ws in words if ws for w in ws}.difference(known)), pieces))
            packed = [b"" if ws is None else b"".join(map(known.__getitem__, ws)) for ws in words]
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)), mask=texts.is_null())
            if check:
                again = pieces.decode_all(ids)
                same = pc.fill_null(pc.equal(again, texts), False)
                texts = pc.or_(same, pc.and_(again.is_null(), texts.is_null()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts, ids], names=names)

    names = ["doc_id", "round_trip" if check else "text", "ids"]
    return id_and_text(docs, id_col, text_col).mapInArrow(encoded, f"doc_id long, {names[1]} {'boolean' if check else 'string'}, ids array<int>")


def decode(encoded: DataFrame, model_path: str | None = None, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the text of ``ids_col``; null ids give null, none give an empty text."""

    def texts(batches):
        pieces = vocabulary(model_path or public_tokenizers.path(PIECES))
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col))
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            start = 0
            while start < batch.num_rows:  # so many rows at once that their ids are bounded, one at least
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + SLICE, side="right")))
                part = batch.slice(start, stop - start)
                made = pieces.decode_all(lists.slice(start, stop - start).cast(pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*batch.schema.names, to])
                start = stop

    return encoded.mapInArrow(texts, T.StructType([*encoded.schema.fields, T.StructField(to, T.StringType())]))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether decoding them gives the text again."""
    coded = encode(table(spark, sf_dir, "documents"), check=True)
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), "ids", "round_trip")
