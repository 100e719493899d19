"""Best-fit packing by bin completion.

Documents become pieces of at most ``capacity`` tokens. Pieces of one length are alike, so the
packing is searched on the histogram of lengths: at most ``capacity`` counts, however large the
corpus. Spark tokenizes, counts, ranks the pieces of each length and looks their places up.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimflow.llm.common import gathered, id_and_text, scan_words, slices, table, utf8
from dimflow.session import cut_lineage

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
#: Words kept with their ids in each worker, from task to task; the store is emptied when full.
KEPT_WORDS = 600_000
#: Bytes of text that are tokenized at once.
SLICE = 1 << 20
#: Pieces of one length are ranked in parts of about so many, at least so many parts.
PART_ROWS, PARTS = 1_000_000, 64
#: Steps of the whole search, for each distinct length and besides. A dive to a packing takes about one for each length.
STEPS_A_LENGTH, STEPS = 8, 2_000


#: Marks that may end a word: no token holds them together with the letter before.
MARK = np.isin(np.arange(256), list(b".,;:!?#*$%&|"))
BLANK = np.isin(np.arange(256), list(b" \n"))
LETTER = np.isin(np.arange(256), range(ord("a"), ord("z") + 1))


def ending_marks(data: np.ndarray) -> np.ndarray:
    """Places between a letter and up to four marks that end its word. Fewer words are distinct if cut there."""
    if len(data) < 2:
        return np.zeros(0, np.int64)
    mark = MARK[data]
    ends = mark & np.append(BLANK[data[1:]], True)
    for _ in range(3):
        ends[:-1] |= mark[:-1] & ends[1:] & mark[1:]
    return np.flatnonzero(ends[1:] & LETTER[data[:-1]]) + 1


class Words:
    """Ids of white-space delimited words, packed as uint32.

    The tokenizer drops white space and never joins across it, so a text's ids are its words' ids.
    Words of letters go through the tokenizer together, parted again at tokens that end a word.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.ends = np.zeros(max(self.model.get_vocab().values()) + 1, bool)
        for token, i in self.model.get_vocab().items():
            self.ends[i] = token.endswith("</w>")

    def one(self, word: bytes) -> bytes:
        return np.array(self.model.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[bytes]) -> None:
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        letters, others = [], []
        for word in words:
            if word in known:
                continue
            text = word.decode("utf-8", "replace")
            if text.isalpha() and (text.isascii() or text.lower().isalpha() and "Σ" not in text):
                letters.append((word, text))
            else:
                others.append((word, text))
        for i in range(0, len(others), 4096):
            part = others[i : i + 4096]
            for (word, _), found in zip(part, self.model.encode_batch_fast([t for _, t in part], add_special_tokens=False)):
                known[word] = np.array(found.ids, "<u4").tobytes()
        for i in range(0, len(letters), 256):
            part = letters[i : i + 256]
            ids = np.array(self.model.encode_batch_fast([" ".join(t for _, t in part)], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(cuts) == len(part):
                packed, start = ids.tobytes(), 0
                for (word, _), stop in zip(part, cuts):
                    known[word] = packed[start:stop]
                    start = stop
            else:
                known.update((word, self.one(word)) for word, _ in part)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts end to end, and where each text's begin. Each distinct word is looked up once."""
        data, offsets = utf8(texts)
        starts, ends, hashes, first = scan_words(data, offsets, ending_marks(data))
        _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        raw = data.tobytes()
        words = [raw[i:j] for i, j in zip(starts[at].tolist(), ends[at].tolist())]
        self.learn(words)
        packed = list(map(self.known.__getitem__, words))
        sizes = np.array([len(p) // 4 for p in packed], np.int64)
        lengths = sizes[which]
        ids = gathered(np.frombuffer(b"".join(packed), "<u4"), (np.cumsum(sizes) - sizes)[which], lengths)
        return ids, np.concatenate([[0], np.cumsum(lengths)])[first]


_words: dict[str, Words] = {}


def tokenized(docs: DataFrame, capacity: int, tokenizer_path: str | None, keep_ids: bool) -> DataFrame:
    """A row for each piece: ``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids``."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def cut(batches):
        path = tokenizer_path or public_tokenizers.path(TOKENIZER)
        words = _words[path] = _words.get(path) or Words(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in slices(batches, SLICE):
            rows = {n: [] for n in names}
            ids, begins = words.ids(batch.column("text"))
            packed, begins = ids.tobytes(), (4 * begins).tolist()
            for doc, begin, stop in zip(batch.column("doc_id").to_pylist(), begins, begins[1:]):
                own = packed[begin:stop] + end
                for piece, at in enumerate(range(0, len(own), 4 * capacity)):
                    part = own[at : at + 4 * capacity]
                    for n, v in zip(names, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part)):
                        rows[n].append(v)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            if keep_ids:
                rows["ids"] = [np.frombuffer(x, "<i4") for x in rows["ids"]]
            yield pa.RecordBatch.from_arrays([pa.array(rows[n], t) for n, t in zip(names, types)], names=names)
        # Words come again in the worker's next task. Where ids are asked for, other stages follow and need the memory.
        if keep_ids:
            words.known.clear()
        pa.default_memory_pool().release_unused()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return docs.mapInArrow(cut, schema)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: (lengths of a bin, how many such bins)."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in sorted(r for r in open_bins if r >= size):
            while left and open_bins.get(room):
                filling, n = open_bins[room].popitem()
                fit = room // size
                whole = min(n, left // fit)
                if not whole:
                    fit, whole = left, 1
                if n > whole:
                    open_bins[room][filling] = n - whole
                made = filling + (size,) * fit
                rest = open_bins.setdefault(room - size * fit, {})
                rest[made] = rest.get(made, 0) + whole
                left -= fit * whole
            if not left:
                break
        fit = capacity // size
        for per, n in ((fit, left // fit), (left % fit, 1)):
            if per and n:
                rest = open_bins.setdefault(capacity - size * per, {})
                made = (size,) * per
                rest[made] = rest.get(made, 0) + n
    return [(filling, n) for group in open_bins.values() for filling, n in group.items()]


def exact(items: list[tuple[int, int]], target: int) -> Iterator[list[int]]:
    """All ways to make ``target`` of (length, how many), lengths descending; ways with more of the longest come first.

    Bit t of ``reach[k]`` tells whether items from k on can make t, so no choice leads nowhere."""
    reach, mask = [1] * (len(items) + 1), (2 << target) - 1
    for k in range(len(items) - 1, -1, -1):
        size, n = items[k]
        bits, more, step = reach[k + 1], min(n, target // size), 1
        while more:
            step = min(step, more)
            bits |= bits << size * step
            more, step = more - step, 2 * step
        reach[k] = bits & mask
    if not reach[0] >> target & 1:
        return
    taken: list[tuple[int, int]] = []
    k, rest = 0, target
    while True:
        while rest:
            size, n = items[k]
            times = min(n, rest // size)
            while not reach[k + 1] >> rest - times * size & 1:
                times -= 1
            if times:
                taken.append((k, times))
                rest -= times * size
            k += 1
        yield [items[k][0] for k, times in taken for _ in range(times)]
        while taken:
            k, times = taken.pop()
            size = items[k][0]
            rest += times * size
            times -= 1
            while times >= 0 and not reach[k + 1] >> rest - times * size & 1:
                times -= 1
            if times >= 0:
                if times:
                    taken.append((k, times))
                    rest -= times * size
                k += 1
                break
        else:
            return


def smeared(bits: int, width: int) -> int:
    """Bits moved up by 0 to ``width`` places."""
    done = 0
    while done < width:
        step = min(done + 1, width - done)
        bits |= bits << step
        done += step
    return bits


def dominated(filling: list[int], counts: dict[int, int], waste: int) -> bool:
    """Whether a piece left over could take the place of shorter ones, or of several, of the filling."""
    used: dict[int, int] = {}
    one = several = 0  # sums of one piece, of two or more
    for size in filling:
        used[size] = used.get(size, 0) + 1
        several |= (several | one) << size
        one |= 1 << size
    fit = smeared(several, waste) | (smeared(one << 1, waste - 1) if waste else 0)
    return any(fit >> size & 1 for size, n in counts.items() if n > used.get(size, 0))


def fillings(items: list[tuple[int, int]], room: int, one_a_waste: bool = False) -> Iterator[tuple[int, tuple[int, ...]] | None]:
    """All undominated ways to fill ``room`` from (length, how many), lengths descending: (waste, lengths), least waste
    first. None for each dominated way that was looked at; the first way never is. ``one_a_waste``: the first of each waste, dominated or not."""
    items = [(s, min(n, room // s)) for s, n in items if n and s <= room]
    counts, stop, forced = dict(items), len(items), []
    if room in counts:  # one piece without waste dominates all others
        yield 0, (room,)
        return
    for waste in range(room + 1):
        while stop and items[stop - 1][0] <= waste:  # what fits into the waste is not left over
            stop -= 1
            forced += [items[stop][0]] * items[stop][1]
        target = room - waste - sum(forced)
        if target < 0:
            return
        if target > sum(s * n for s, n in items[:stop]):
            continue
        for chosen in exact(items[:stop], target):
            filling = chosen + forced
            yield None if not one_a_waste and dominated(filling, counts, waste) else (waste, tuple(filling))
            if one_a_waste:
                break


def complete(counts: dict[int, int], capacity: int, steps: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """Bin completion by branch and bound, from the best-fit packing as the first incumbent.

    Half of ``steps`` goes to a search with up to three ways a bin, each of another waste, which comes back further
    up sooner; the rest, and what it leaves, to the search with all undominated ways."""
    total = sum(s * n for s, n in counts.items())
    best = best_fit(counts, capacity)
    most = sum(n for _, n in best)
    least = max(-(-total // capacity), sum(n for s, n in counts.items() if 2 * s > capacity))
    if most <= least:
        return best
    steps = STEPS_A_LENGTH * len(counts) + STEPS if steps is None else steps
    best, most, unused = searched(counts, capacity, best, least, steps // 2, 3)
    return searched(counts, capacity, best, least, steps - steps // 2 + unused, None)[0]


def searched(counts: dict[int, int], capacity: int, best: list, least: int, steps: int, width: int | None) -> tuple[list, int, int]:
    """The best packing found, its bins and the steps not used.

    Each branch fills the bin of the largest piece left, as often as the counts allow. A branch
    ends when its waste leaves no packing with fewer bins than the incumbent; the search ends at
    the lower bound or after ``steps`` fillings looked at and branches left."""
    total = sum(s * n for s, n in counts.items())
    most = sum(n for _, n in best)
    sizes = sorted(counts, reverse=True)
    left = dict(counts)
    path: list[tuple[tuple[int, ...], int]] = []
    trail: list[list] = []  # largest piece, ways to fill its bin, and how many of them were taken
    waste = used = first = 0

    def ways(largest: int) -> Iterator:
        items = [(s, left[s] - (s == largest)) for s in sizes if s <= largest and left[s]]
        if width is None:
            return fillings(items, capacity - largest)
        # Few pieces first, within the waste that falls to one bin: short pieces are kept for later bins.
        share = ((most - 1) * capacity - total - waste) / max(1, most - 1 - used)
        found = []
        for lost, filling in filter(None, fillings(items, capacity - largest, True)):
            if found and (lost > share or len(found) == 8):
                break
            found.append((lost, filling))
        return iter(sorted(found, key=lambda way: (len(way[1]), way[0])))

    def enter() -> None:
        nonlocal first
        while first < len(sizes) and not left[sizes[first]]:
            first += 1
        trail.append([sizes[first] if first < len(sizes) else 0, None, 0])

    enter()
    while trail and most > least and steps:
        steps -= 1
        last = trail[-1]
        largest, source, taken = last
        if not largest:
            if used < most:
                best, most = list(path), used
            source = iter(())
        elif source is None:
            source = ways(largest)
            if taken:
                next(source)
                last[1] = source  # kept only where the search came back, as its tables are large
        option = "end" if taken == width else next(source, "end")
        if option is None:
            continue
        last[2] += 1
        allowed = (most - 1) * capacity - total
        if option == "end" or waste + option[0] > allowed:
            trail.pop()
            if path:
                filling, n = path.pop()
                for s in filling:
                    left[s] += n
                waste -= n * (capacity - sum(filling))
                used -= n
                first = 0
            continue
        lost, filling = option[0], (largest, *option[1])
        need = {s: filling.count(s) for s in filling}
        n = min(left[s] // k for s, k in need.items())
        if lost:
            n = min(n, max(1, (allowed - waste) // lost))
        for s, k in need.items():
            left[s] -= n * k
        path.append((filling, n))
        waste, used = waste + n * lost, used + n
        enter()
    return best, most, steps


class Plan:
    """Where the r-th piece of a length goes. One entry for each length of each kind of bin."""

    def __init__(self, bins: list[tuple[tuple[int, ...], int]]):
        entries, ranks, base = [], {}, 0
        for filling, n in bins:
            at = 0
            for size in sorted(set(filling), reverse=True):
                k = filling.count(size)
                rank = ranks.get(size, 0)
                entries.append((size, rank, k, base, at))
                ranks[size] = rank + n * k
                at += k * size
            base += n
        self.table = np.array(sorted(entries), np.int64).reshape(-1, 5)

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size, first, k, base, at = self.table.T
        lo, hi = np.searchsorted(size, length, "left"), np.searchsorted(size, length, "right")
        while (gap := hi - lo > 1).any():  # the last entry of the length that begins at or before the rank
            mid = (lo + hi) // 2
            below = gap & (first[np.minimum(mid, len(first) - 1)] <= rank)
            lo, hi = np.where(below, mid, lo), np.where(gap & ~below, mid, hi)
        nth = rank - first[lo]
        return base[lo] + nth // k[lo], at[lo] + nth % k[lo] * length


def pack(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, keep_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    A document is its ids and then id 0; longer ones are cut at multiples of ``capacity``. A null or
    empty text is the id 0 alone. Null ids and repeated rows are packed like others; an empty table
    gives no rows; other columns are not looked at. ``tokenizer_path`` must be readable on every executor.
    """
    pieces = tokenized(id_and_text(docs, id_col, text_col), capacity, tokenizer_path, keep_ids)
    pieces = cut_lineage(pieces.withColumn("uid", F.monotonically_increasing_id()))
    placed = with_places(docs.sparkSession, pieces.drop("ids"), capacity)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if not keep_ids:
        return placed.select(*names, "sequence_id", "offset")
    # Ids go through no window: they are joined to the places in the end.
    places = cut_lineage(placed.select("uid", "sequence_id", "offset"))
    return pieces.join(places, "uid").select(*names, "ids", "sequence_id", "offset")


def with_places(spark: SparkSession, pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id, offset`` to pieces, a written table with ``uid``."""
    # Full pieces are sequences of their own, so the commonest length of all needs no ranks. Names below 0 are theirs.
    whole = pieces.where(F.col("length") == capacity)
    whole = whole.withColumns({"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")})
    shorter = pieces.where(F.col("length") < capacity)
    counts = {r.length: r.n for r in shorter.groupBy("length").agg(F.count("*").alias("n")).collect()}  # less than `capacity` rows
    if not counts:
        return whole
    parts = max(PARTS, max(counts.values()) // PART_ROWS)
    shorter = shorter.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    plan = Plan(complete(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shorter.groupBy("length", "part").agg(F.count("*").alias("n"))
    bases = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32", "start")
    # Both sides of this join are dealt by length and part already.
    ranked = shorter.withColumn("nth", F.row_number().over(within)).join(bases, ["length", "part"])
    ranked = ranked.select(*pieces.columns, (F.col("before") + F.col("nth") - 1).alias("rank"))
    plans = spark.sparkContext.broadcast(plan)
    names = pieces.columns

    def placed(batches):
        for batch in batches:
            column = lambda n: batch.column(batch.schema.get_field_index(n))
            sequence, offset = plans.value.places(column("length").to_numpy(), column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*map(column, names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long, sequence_id long, offset long"
    return ranked.mapInArrow(placed, schema).unionByName(whole)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of what is left, with their token ids.

    Null and empty texts are the end id alone; repeated rows and rows without id are packed like others; other columns,
    of any name, are not looked at. An empty table gives no rows."""
    return pack(docs, keep_ids=True)
