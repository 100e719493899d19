"""Unigram segmentation of texts with a SentencePiece vocabulary, word by word.

A text gets a blank in front and is cut before each run of blanks: no piece of such a vocabulary
has a blank after another character, so the best path of a text is that of its marked words, one
after the other. The public vocabulary ranks its pieces but has no probabilities, so those follow
Zipf's law over the ranks; they are rounded so that sums are exact. Among equal paths the one with
the longer last piece wins. A character that no piece holds costs ``UNKNOWN`` below the lowest score
and becomes its UTF-8 bytes.
"""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece

from dimflow.llm.common import gathered

UNKNOWN = 10.0
#: Scores are multiples of 1 / GRAIN.
GRAIN = 1024
#: Words kept with their results in each worker; the store is emptied when full.
KEPT_WORDS = 600_000
#: Longer words go without a trie: they share no prefix worth storing.
LONG_WORD = 256
RUN = re.compile(" +[^ ]*")


@dataclass
class Vocabulary:
    """Pieces with a blank for the mark. ``ends``: all endings of pieces, with a score if they are pieces."""

    path: str
    ids: dict[str, int] = field(default_factory=dict)
    ends: dict[str, float | None] = field(default_factory=dict)
    byte: list[int] = field(default_factory=lambda: [0] * 256)
    text: list[bytes] = field(default_factory=list)
    unknown: float = 0.0
    #: No piece has a line break, so a path never crosses one.
    line_breaks: bool = False
    #: Bytes of all pieces end to end, where each begins, and their lengths.
    pool: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def __post_init__(self) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=self.path)
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.text.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                piece = piece.replace("▁", " ")
                self.ids[piece] = i
                self.ends[piece] = model.get_score(i)
                for k in range(1, len(piece)):
                    self.ends.setdefault(piece[k:], None)
                self.text.append(piece.encode())
        ranked = sorted(self.ids, key=lambda piece: (-self.ends[piece], self.ids[piece]))
        total = math.log(sum(1 / r for r in range(1, len(ranked) + 1)))
        for rank, piece in enumerate(ranked, 1):
            self.ends[piece] = -round((math.log(rank) + total) * GRAIN) / GRAIN
        self.unknown = min(s for s in self.ends.values() if s is not None) - UNKNOWN
        self.line_breaks = not any("\n" in piece for piece in self.ids)

    def extend(self, marked: str, scores: list[float], counts: list[int], sizes: list[int]) -> None:
        """Carry the best paths on to every prefix of ``marked`` that the three lists lack.

        Entry n is of the first n characters: score, tokens, and characters of the last piece (0: bytes)."""
        ends, missing = self.ends, self
        for n in range(len(scores), len(marked) + 1):
            best, tokens, last = None, 0, 0
            at = n - 1
            known = ends.get(marked[at:n], missing)
            single = known is not missing and known is not None
            while known is not missing:
                if known is not None:
                    total = scores[at] + known
                    if best is None or total >= best:
                        best, tokens, last = total, counts[at] + 1, n - at
                if at == 0:
                    break
                at -= 1
                known = ends.get(marked[at:n], missing)
            if not single:
                total = scores[n - 1] + self.unknown
                if best is None or total > best:
                    best, last = total, 0
                    tokens = counts[n - 1] + len(marked[n - 1].encode("utf-8", "surrogatepass"))
            scores.append(best)
            counts.append(tokens)
            sizes.append(last)

    def path_ids(self, marked: str, sizes: list[int]) -> array:
        ids, n = [], len(marked)
        while n:
            size = sizes[n]
            if size:
                ids.append(self.ids[marked[n - size : n]])
            else:
                size = 1
                ids.extend(self.byte[b] for b in reversed(marked[n - 1].encode("utf-8", "surrogatepass")))
            n -= size
        ids.reverse()
        return array("i", ids)

    def decode(self, ids) -> str:
        """The text of ids; the blank put in front is taken off."""
        return b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")[1:]

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The texts of lists of ids: null for null, none gives an empty text. Bytes of all pieces are gathered at once;
        lists that do not begin with a blank or make no UTF-8 are decoded one by one."""
        if self.pool is None:
            sizes = np.array([len(t) for t in self.text], np.int64)
            self.pool = np.frombuffer(b"".join(self.text), np.uint8), np.cumsum(sizes) - sizes, sizes
        pool, starts, sizes = self.pool
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        data = gathered(pool, starts[ids], sizes[ids])
        bytes_before = np.concatenate([[0], np.cumsum(sizes[ids])])
        ends = bytes_before[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        some = np.diff(ends) > 0
        begins = ends[:-1][some]
        if (data[begins] == 0x20).all():
            offsets = ends - np.concatenate([[0], np.cumsum(some)])
            buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.delete(data, begins).tobytes())]
            texts = pa.Array.from_buffers(pa.large_string(), len(lists), buffers)
            try:
                texts.validate(full=True)
                return pc.if_else(lists.is_valid(), texts, None).cast(pa.string())
            except pa.ArrowInvalid:
                pass
        return pa.array([None if x is None else self.decode(x) for x in lists.to_pylist()], pa.string())


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def marked(word: str) -> str:
    """The characters that an entry of ``words_of`` stands for."""
    return word if word[:1] in (" ", "\n") else " " + word


def words_of(text: str | None, pieces: Vocabulary) -> list[str]:
    """The text, with a blank in front, cut before runs of blanks and before line breaks.

    Entries that begin with a blank or line break are as in the text; others have lost one blank."""
    if not text:
        return []
    if text[0] not in " \n" and "  " not in text and " \n" not in text and pieces.line_breaks:
        return text.replace("\n", " \n").split(" ")
    return RUN.findall(" " + text)
