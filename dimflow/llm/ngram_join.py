"""N-gram Jaccard join by vertical partitioning, and the components of its links.

The global order of all n-grams (their hashes) is cut into fragments, and each task of the first
step holds one fragment of all documents. There an n-gram that only one document has drops out: it
is in no overlap. A document with too few others left can link with nothing. What is left of the
others makes up all overlaps.

Candidates share an n-gram in their prefixes, the first so many n-grams in an order that puts
frequent ones last, so that two documents with enough overlap always share one. For each pair the
overlaps are counted fragment by fragment and summed.

Pairs are not all listed: equal sets are one node; then the nodes of each prefix n-gram are compared with a few leads among
them, one at first, and after that only pairs that are not connected yet. Sketches rule most unlike pairs out within the join.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimflow.llm.common import id_and_text, mixed, scan_words, slices, table, utf8
from dimflow.llm.components import components
from dimflow.session import cut_lineage

WORDS = 5
#: Documents link at 100 * overlap >= LEAST * union.
LEAST = 75
#: Overlaps of a pair are counted in so many fragments.
FRAGMENTS = 4
#: The order of the prefix puts n-grams last that more than 1 of RARE documents of a sample has.
SAMPLE_NODES, RARE = 20_000, 500
KEY_BYTES = 5
PART_BYTES = 32 << 20
MOST_LABELS = 10_000
#: So many node names, of 8 bytes, are broadcast to leave other nodes' segments where they are.
MOST_BROADCAST = 1_000_000
#: The nodes of a prefix n-gram are first compared with the smallest after each of these masks: fixed, so many for any group.
LEADS = [0, 0x15A4E35F3, 0x2F0C8B1D6, 0x0D39A67EC, 0x3A5F91C2B, 0x1C7E2D4A9, 0x26B81F3D5, 0x37D4C6A8E]
#: Words of 64 bits in a node's sketch.
SKETCH = 8
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shingles(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' distinct shingles, sorted within each text, and where each text's begin."""
    data, offsets = utf8(texts)
    _, _, hashes, first = scan_words(LOWER[data], offsets)
    n = len(hashes)
    rolled = mixed(hashes[: max(0, n - words + 1)] + np.uint64(words))
    for k in range(1, words):
        rolled = mixed(rolled ^ hashes[k : k + len(rolled)])
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= words:
            own = np.sort(rolled[a : b - words + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            one = mixed(hashes[a : a + 1] + np.uint64(b - a))
            for k in range(a + 1, b):
                one = mixed(one ^ hashes[k : k + 1])
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return np.concatenate(out), np.cumsum([0] + [len(x) for x in out])


def packed(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, KEY_BYTES)
    return wide.view("<u8").ravel()


def need(n, least: int):
    """The smallest overlap that a set of n can link with."""
    return -(-n * least // 100)


FIRST = "part int, slice long, uids binary, counts binary, keys binary, known binary, ids binary, sizes binary, nulls binary"
SECOND = "slice long, part int, uids binary, counts binary, keys binary, ids binary, sizes binary, nulls binary"


def to_fragments(docs: DataFrame, words: int, parts: int) -> DataFrame:
    """Rows of one slice of documents and one fragment. N-grams that several documents of the slice have
    go as one key without a document (``known``); that they are shared is sent back along with the slice's own row."""

    def cut(batches):
        for batch in slices(batches):
            uids = batch.column("uid").to_numpy()
            found, begins = shingles(batch.column("text"), words)
            of = np.repeat(np.arange(batch.num_rows), np.diff(begins))
            part = ((found >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(found, kind="stable")
            same = found[order][1:] == found[order][:-1]
            several = np.zeros(len(found), bool)
            several[order[1:][same]] = several[order[:-1][same]] = True
            lead = np.zeros(len(found), bool)
            lead[order[np.concatenate([[True], ~same])] if len(order) else order] = True
            rows = {n: [] for n in ("part", "slice", "uids", "counts", "keys", "known", "ids", "sizes", "nulls")}

            def add(where, elements, known=b"", **info):
                docs_of, counts = np.unique(of[elements], return_counts=True)
                for n, v in {"part": where, "slice": int(uids[0]), "uids": uids[docs_of].tobytes(), "counts": counts.astype(np.uint32).tobytes(), "keys": packed(found[elements]), "known": known, "ids": b"", "sizes": b"", "nulls": b"", **info}.items():
                    rows[n].append(v)

            by_part = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[by_part], np.arange(parts + 1))
            for p in range(parts):
                own = by_part[cuts[p] : cuts[p + 1]]
                if len(own):
                    add(p, own[~several[own]], packed(found[own[several[own] & lead[own]]]))
            # The slice's own row, dealt by the slice: all its documents, and what is known to be shared.
            ids, mark = batch.column("doc_id"), batch.column("mark").to_numpy()
            shared = np.flatnonzero(several)
            keys = np.array(part[shared] << 40 | (found[shared] & np.uint64((1 << 40) - 1)).astype(np.int64), "<i8")
            add(
                int(mixed(np.array([uids[0]], np.int64).view(np.uint64))[0] % np.uint64(parts)), shared, ids=ids.fill_null(0).to_numpy().tobytes() + mark.tobytes(),
                sizes=np.diff(begins).astype(np.int64).tobytes(), nulls=np.asarray(ids.is_null()).tobytes(),
            )
            rows["keys"][-1] = keys.tobytes()
            rows["known"][-1] = uids.tobytes()
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("part", pa.int32()), ("slice", pa.int64())] + [(n, pa.binary()) for n in list(rows)[2:]]))

    return docs.mapInArrow(cut, FIRST)


def shared_in_fragment(rows: pa.Table) -> pa.Table:
    """Keys of the fragment that two documents or more have, sent back to the slices."""
    col = {n: rows.column(n).to_pylist() for n in rows.column_names}
    out = {n: [] for n in ("slice", "part", "uids", "counts", "keys", "ids", "sizes", "nulls")}
    plain = [i for i, s in enumerate(col["sizes"]) if not s]
    keys = [unpacked(col["keys"][i]) for i in plain]
    every = np.concatenate([*keys, *(unpacked(col["known"][i]) for i in plain for _ in range(2))] or [np.zeros(0, np.uint64)])
    every.sort()
    shared = every[1:][every[1:] == every[:-1]]
    shared = shared[np.concatenate([[True], shared[1:] != shared[:-1]])] if len(shared) else shared
    for i, own in zip(plain, keys):
        at = np.searchsorted(shared, own)
        hit = np.zeros(len(own), bool)
        hit[at < len(shared)] = shared[at[at < len(shared)]] == own[at < len(shared)]
        if hit.any():
            counts = np.frombuffer(col["counts"][i], np.uint32)
            of = np.repeat(np.arange(len(counts)), counts)[hit]
            docs_of, n = np.unique(of, return_counts=True)
            values = (col["slice"][i], col["part"][i], np.frombuffer(col["uids"][i], np.int64)[docs_of].tobytes(), n.astype(np.uint32).tobytes(), packed(own[hit]), b"", b"", b"")
            for name, v in zip(out, values):
                out[name].append(v)
    for i in set(range(len(col["slice"]))).difference(plain):
        # ``ids`` holds all ids of the slice, then all marks, then all uids.
        values = (col["slice"][i], -1, col["uids"][i], col["counts"][i], col["keys"][i], col["ids"][i] + col["known"][i], col["sizes"][i], col["nulls"][i])
        for name, v in zip(out, values):
            out[name].append(v)
    types = [pa.int64(), pa.int32()] + [pa.binary()] * 6
    return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})


def sets_of_slice(least: int):
    def gathered(rows: pa.Table) -> pa.Table:
        col = {n: rows.column(n).to_pylist() for n in rows.column_names}
        parts, owners = [], []
        for i, part in enumerate(col["part"]):
            counts = np.frombuffer(col["counts"][i], np.uint32)
            owners.append(np.repeat(np.frombuffer(col["uids"][i], np.int64), counts))
            if part < 0:
                head = i
                parts.append(np.frombuffer(col["keys"][i], "<i8"))
            else:
                parts.append(unpacked(col["keys"][i]).astype(np.int64) | np.int64(part) << 40)
        keys, owners = np.concatenate(parts), np.concatenate(owners)
        order = np.lexsort((keys, owners))
        keys, owners = keys[order], owners[order]
        ids, marks, uids = np.frombuffer(col["ids"][head], np.int64).reshape(3, -1)
        sizes, nulls = np.frombuffer(col["sizes"][head], np.int64), np.frombuffer(col["nulls"][head], bool)
        low, high = np.searchsorted(owners, uids, "left"), np.searchsorted(owners, uids, "right")
        sets, digests = [], []
        for a, b, n, null in zip(low, high, sizes.tolist(), nulls):
            own = keys[a:b] if n and not null and b - a >= need(n, least) else None
            sets.append(own)
            digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if own is not None and b - a == n else None)
        return pa.table({
            "uid": uids, "doc_id": pa.array(ids, pa.int64(), mask=nulls), "mark": marks, "n": sizes,
            "keys": pa.array(sets, pa.list_(pa.int64())), "digest": pa.array(digests, pa.binary()),
        })

    return gathered


def prefixes(nodes: DataFrame, least: int) -> DataFrame:
    """``node, info, prefix`` of each node; ``info`` has its sizes and a sketch of 64 * SKETCH bits, set where an odd number of its n-grams fall. The few frequent n-grams come from a bounded sample:
    at most RARE times the sample's mean size of them. Any order is right as long as it is one for all."""
    total = max(1, nodes.count())
    sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < int(1e6 * min(1.0, SAMPLE_NODES / total)) + 1)
    floor = max(8, min(total, SAMPLE_NODES) // RARE)
    hot = sample.select(F.explode("keys").alias("key")).groupBy("key").count().where(F.col("count") >= floor).toPandas()
    hot = hot.sort_values("key")
    frequent = nodes.sparkSession.sparkContext.broadcast((hot["key"].to_numpy(np.int64), hot["count"].to_numpy(np.int64)))

    def cut(batches):
        names, counts = frequent.value
        for batch in batches:
            out, bits = [], []
            for keys, n in zip(batch.column("keys"), batch.column("n").to_pylist()):
                keys = keys.values.to_numpy()
                order = keys
                if len(names):
                    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
                    order = keys[np.lexsort((keys, np.where(names[at] == keys, counts[at], 0)))]
                out.append(order[: len(keys) - need(n, least) + 1])
                place = mixed(keys.view(np.uint64).copy()) % np.uint64(64 * SKETCH)
                bits.append(np.packbits(np.bincount(place.astype(np.int64), minlength=64 * SKETCH) & 1).view(np.int64))
            sizes = np.diff(batch.column("keys").offsets.to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), pa.array(sizes, pa.int64()), pa.array(out, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                names=["node", "n", "size", "prefix", "sketch"],
            )

    cuts = nodes.select("node", "n", "keys").mapInArrow(cut, "node long, n long, size long, prefix array<long>, sketch array<long>")
    return cuts.select("node", F.struct("n", "size", *(F.get("sketch", F.lit(i)).alias(f"s{i}") for i in range(SKETCH))).alias("info"), "prefix")


def likely(a: Column, b: Column, least: int) -> Column:
    """Whether two nodes can link, by their sizes and sketches. Each n-gram that only one of them has turns one bit
    over, so different bits are at most as many as different n-grams, and no link is lost."""
    both = a["n"] + b["n"]
    apart = sum((F.bit_count(a[f"s{i}"].bitwiseXOR(b[f"s{i}"])) for i in range(SKETCH)), F.lit(0))
    near = 100 * F.least(a["n"], b["n"]) >= least * F.greatest(a["n"], b["n"])
    return near & ((100 + least) * (a["size"] + b["size"] - apart) >= 2 * least * both)


def linked(pairs: DataFrame, segments: DataFrame, least: int) -> DataFrame:
    """The ``a, b`` pairs that link: overlaps counted in each fragment and summed. ``pairs``: a, b, and the sizes na, nb."""
    inside = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    if inside.count() <= MOST_BROADCAST:  # else every segment is dealt
        segments = segments.join(F.broadcast(inside), "node", "left_semi")
    every = pairs.withColumn("fragment", F.explode(F.array(*map(F.lit, range(FRAGMENTS)))))
    left = segments.select(F.col("node").alias("a"), "fragment", F.col("segment").alias("sa"))
    right = segments.select(F.col("node").alias("b"), "fragment", F.col("segment").alias("sb"))
    part = every.join(left, ["a", "fragment"]).join(right, ["b", "fragment"]).select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("o"))
    total = part.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
    return total.where((100 + least) * F.col("o") >= least * (F.col("na") + F.col("nb"))).select("a", "b")


def jaccard_components(docs: DataFrame, words: int = WORDS, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, text_hash`` (XXH64 of the text, as Spark has it).

    Sets are of distinct shingles of ``words`` words, A-Z lower-cased; fewer words are one shingle. A null
    text, or one without words, has an empty set, links with nothing and is its own component. A row without id
    links with nothing and has a null component. Repeated rows link with one another. An empty table
    gives no rows; other columns are not looked at.
    """
    given = id_and_text(docs, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()).withColumn("mark", F.xxhash64("text"))
    parts = parts_of(given)
    back = to_fragments(given, words, parts).groupBy("part").applyInArrow(shared_in_fragment, SECOND)
    sets = back.groupBy("slice").applyInArrow(sets_of_slice(least), "uid long, doc_id long, mark long, n long, keys array<long>, digest binary")
    sets = cut_lineage(sets)
    # Equal sets are one node, by the smallest uid.
    whole = sets.where("digest IS NOT NULL").groupBy("digest").agg(F.min("uid").alias("node"))
    members = cut_lineage(
        sets.where("keys IS NOT NULL").select("uid", "doc_id", "digest").join(whole, "digest", "left").select("uid", "doc_id", "digest", F.coalesce("node", "uid").alias("node"))
    )
    # Only sets that can be equal to others need a join to find the first of each; the rest are nodes as they are.
    firsts = members.where("digest IS NOT NULL AND uid = node").select("uid")
    equal = cut_lineage(sets.where("digest IS NOT NULL").select("uid", "n", "keys").join(firsts, "uid", "left_semi"))
    nodes = sets.where("digest IS NULL AND keys IS NOT NULL").select("uid", "n", "keys").unionByName(equal).withColumnRenamed("uid", "node")
    fragment = lambda i: F.filter("keys", lambda k: F.pmod(F.shiftright(k, 40), F.lit(FRAGMENTS)) == i)
    segments = nodes.select("node", F.posexplode(F.array(*map(fragment, range(FRAGMENTS)))).alias("fragment", "segment"))

    infos = cut_lineage(prefixes(nodes, least))
    prefix = infos.select(F.posexplode("prefix").alias("at", "key"), "node")
    info = infos.select("node", "info")
    of = lambda side, node: side.select(F.col("node").alias(node), F.col("info").alias(f"i{node}"))

    def likely_pairs(pairs: DataFrame) -> DataFrame:
        both = pairs.join(of(info, "a"), "a").join(of(info, "b"), "b").where(likely(F.col("ia"), F.col("ib"), least))
        return both.select("a", "b", F.col("ia.n").alias("na"), F.col("ib.n").alias("nb"))

    leads = [F.min(F.col("node").bitwiseXOR(F.lit(m))).bitwiseXOR(F.lit(m)) for m in LEADS]
    buckets = prefix.groupBy("key").agg(F.count("*").alias("c"), F.array(*leads).alias("leads")).where("c > 1").select("key", "leads")
    links, labels = None, None
    # The first lead connects most nodes; pairs with the other leads are compared only if they are apart still.
    for of_round in (F.slice("leads", 1, 1), F.slice("leads", 2, len(LEADS) - 1)):
        tries = prefix.join(buckets, "key").select("node", F.explode(of_round).alias("lead")).where("node != lead")
        tries = tries.select(F.greatest("node", "lead").alias("a"), F.least("node", "lead").alias("b")).distinct()
        if labels is not None:
            label_of = lambda n: labels.select(F.col("node").alias(n), F.col("label").alias(f"l{n}"))
            tries = tries.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left")
            tries = tries.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")
        found = cut_lineage(linked(cut_lineage(likely_pairs(tries)), segments, least))
        links = found if links is None else links.unionByName(found)
        labels = components(links)

    labelled = prefix.join(labels, "node", "left").select("key", "at", "node", F.coalesce("label", "node").alias("label"))
    labelled = cut_lineage(labelled)
    mixed_keys = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
    open_rows = labelled.join(mixed_keys, "key", "left_semi").join(info, "node")
    rest = F.col("info.size") - F.col("at")
    mine = open_rows.select("key", F.col("node").alias("a"), F.col("label").alias("la"), F.col("info").alias("ia"), rest.alias("ra"))
    other = open_rows.select("key", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("info").alias("ib"), rest.alias("rb"))
    # Unlike nodes of a frequent key fail in the join's condition and make no rows. At the first n-gram that two nodes
    # share, what is left of each bounds the overlap; a pair that links meets the bound there, at later ones it need not.
    enough = (100 + least) * F.least("ra", "rb") >= least * (F.col("ia.n") + F.col("ib.n"))
    alike = (mine["key"] == other["key"]) & (F.col("la") < F.col("lb")) & enough & likely(F.col("ia"), F.col("ib"), least)
    pairs = mine.join(other, alike).select("a", "b", F.col("ia.n").alias("na"), F.col("ib.n").alias("nb")).distinct()
    more = linked(cut_lineage(pairs), segments, least)
    joined = cut_lineage(components(links.unionByName(more)))

    named = members.join(joined.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("uid", "doc_id", F.coalesce("label", "node").alias("label"))
    known = with_least_id(named)
    told = sets.select("uid", "doc_id", "n", "mark").join(known, "uid", "left")
    return told.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.col("mark").alias("text_hash"))


def parts_of(given: DataFrame) -> int:
    """Fragments of the n-gram order: two for each shuffle partition, or one for PART_BYTES of text if that is more."""
    least = 2 * int(given.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(least, int(size) // PART_BYTES)


def with_least_id(named: DataFrame) -> DataFrame:
    """``uid, component_id`` of ``uid, doc_id, label``: the smallest id of each label.

    Labels that hold more than one of MOST_LABELS of all rows are MOST_LABELS at most; they are broadcast, and
    the rows of the others are dealt by label."""
    least_id = cut_lineage(named.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows")))
    total = least_id.agg(F.sum("rows")).first()[0] or 0
    hot = F.col("rows") * MOST_LABELS > total
    large = least_id.where(hot).select("label", F.col("component_id").alias("large_id"), F.lit(True).alias("large"))
    found = named.join(F.broadcast(large), "label", "left")
    others = found.where("large IS NULL").join(least_id.where(~hot).select("label", "component_id"), "label")
    return found.where("large").select("uid", F.col("large_id").alias("component_id")).unionByName(others.select("uid", "component_id"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).drop("text_hash")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the rows with the smallest id stay; of rows that repeat id and text, one.

    Rows are told apart by id and text, so that of an id's several texts only those go that link to a smaller id.
    Rows without id stay, in any number. Null and empty texts link with nothing. An empty table gives no rows. Of
    equal rows the one whose other columns are first in order stays; columns ``__nth`` and ``__text`` must not be there."""
    gone = jaccard_components(docs).where("component_id < doc_id").select("doc_id", F.col("text_hash").alias("__text")).distinct()
    left = docs.withColumn("__text", F.xxhash64(F.col("text").cast("string"))).join(cut_lineage(gone), ["doc_id", "__text"], "left_anti")
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    same = Window.partitionBy("doc_id", "__text").orderBy(F.lit(1), *(F.col(f"`{c}`") for c in others))
    given, missing = left.where("doc_id IS NOT NULL"), left.where("doc_id IS NULL")
    first = given.withColumn("__nth", F.row_number().over(same)).where("__nth = 1")
    return first.select(*docs.columns).unionByName(missing.select(*docs.columns))
