"""Secret scans: patterns, and sliding-window entropy over candidate strings. DataFrame functions only.

What a lambda uses more than once is bound by a one-element ``transform`` first, since a lambda's body is evaluated
for each element; so a text is matched once for each pattern and taken apart once. No pattern repeats a group without
bound, as Java's matcher recurses for each repeat.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm.common import id_and_text, table

KINDS = ["assign", "access", "hex", "entropy_hex", "entropy_base64"]
ASSIGN = r"""((?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
#: The length is part of these: runs are maximal, so it leaves out the same matches as a later test.
ACCESS = r"(AKIA[A-Z0-9]{16,})"
HEX = r"([0-9a-f]{24,})"
LEAST_VALUE = 6
#: Candidates are runs of at least WINDOW of these characters; hexadecimal digits come first.
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"
HEX_DIGITS = 22
WINDOW = 20
CANDIDATE = rf"([A-Za-z0-9+/_=-]{{{WINDOW},}})"
#: Bits a character that a window needs: windows of hexadecimal digits alone, and others.
LEAST_BITS = {"entropy_hex": 3.0, "entropy_base64": 3.8}
#: Parts of candidates, between = and /, that are no secrets: joined capitals, UUIDs, examples, runs of the alphabet, numbers.
ALLOWED = [
    r"^[A-Z_+-]*$", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"(?i)example|placeholder|changeme",
    r"(?i)abcdefghij|0123456789", r"^[0-9]+$",
]
#: Besides, words and joined words: letters and joints only, and no capital behind a letter.
NO_WORD, INNER_CAPITAL = r"[^A-Za-z_+=/-]", r"[A-Za-z][A-Z]"
#: A base span already; no need to look at its windows.
ALL_BASE = r"^[0-9a-f]{24,}$"
#: Spans are gathered in chunks of so many: what is joined on to is never long.
CHUNK = 256
#: Counts of characters in a window are held in longs, so many bits each.
BITS, A_LONG = 5, 12


def bound(value: Column, body) -> Column:
    """``body(value)``, with the value made once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def gathered(n: Column, first: Column, step, kind: str) -> Column:
    """Run ``step(state, i)`` for i from 0 to ``n`` - 1; the states' arrays ``out``, end to end, as arrays of ``kind``."""
    none = F.array().cast(f"array<{kind}>")

    def chunk(state: Column, begin: Column) -> Column:
        whole = F.aggregate(F.sequence(begin, F.least(begin + CHUNK, n) - 1), F.struct(state["at"].alias("at"), none.alias("out")), step)
        return bound(whole, lambda w: F.struct(w["at"].alias("at"), F.concat(state["all"], F.array(w["out"])).alias("all")))

    start = F.struct(first.alias("at"), F.array().cast(f"array<array<{kind}>>").alias("all"))
    every = F.aggregate(F.sequence(F.lit(0), n - 1, F.lit(CHUNK)), start, chunk, lambda s: F.flatten(s["all"]))
    return F.when(n > 0, every).otherwise(none)


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """Matches of a pattern whose first group is all of it: ``start, end, word`` (the text of ``group``) structs.

    ``split`` gives what lies between the matches, so lengths add up to the places."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("matches"), F.split(text, pattern, -1).alias("between"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("words"),
    )

    def places(f: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(f["between"], i))
            end = start + F.length(F.get(f["matches"], i))
            one = F.struct(start.alias("start"), end.alias("end"), F.get(f["words"], i).alias("word"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

        return gathered(F.size(f["matches"]), F.lit(0), step, "struct<start:int,end:int,word:string>")

    return bound(found, places)


def span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))


def found(text: Column, pattern: str, kind: str, group: int = 1, least: int = 0) -> Column:
    """Spans of a pattern's matches whose ``group`` has at least so many characters."""
    good = F.filter(matched(text, pattern, group), lambda m: F.length(m["word"]) >= least)
    return F.transform(good, lambda m: span(kind, m["start"], m["end"]))


def allowed(part: Column) -> Column:
    is_words = ~F.rlike(part, F.lit(NO_WORD)) & ~F.rlike(part, F.lit(INNER_CAPITAL))
    for pattern in ALLOWED:
        is_words = is_words | F.rlike(part, F.lit(pattern))
    return is_words


def core(word: Column) -> Column:
    """``begin, word``: a candidate without the allowed parts at both ends; parts inside are left, as they may be of a key."""

    def trimmed(p: Column) -> Column:
        first = F.array_position(p["allowed"], False)
        last = F.size(p["allowed"]) - F.array_position(F.reverse(p["allowed"]), False) + 1
        size = lambda a, n: F.aggregate(F.slice(p["parts"], a, n), F.lit(0), lambda s, x: s + F.length(x) + 1)
        begin = size(F.lit(1), (first - 1).cast("int"))
        long = F.aggregate(F.slice(p["parts"], first.cast("int"), (last - first + 1).cast("int")), F.lit(-1), lambda s, x: s + F.length(x) + 1)
        left = bound(begin, lambda b: F.struct(b.alias("begin"), F.substr(word, b + 1, long).alias("word")))
        return F.when(first > 0, left)

    parts = F.split(word, "[=/]", -1)
    return bound(bound(parts, lambda p: F.struct(p.alias("parts"), F.transform(p, allowed).alias("allowed"))), trimmed)


def hot_stretches(word: Column) -> Column:
    """Stretches of ``word`` under windows with enough entropy, as ``begin, stop, kind`` structs, by class of window.

    The state has the count of each character in the window, packed into longs, the number of characters that are no
    hexadecimal digits, and the sum of n log2 n over the counts. A step counts one character in and one out; entropy is
    log2(WINDOW) - sum / WINDOW."""
    terms = F.array(*(F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 1)))
    term = lambda n: F.get(terms, n)
    longs = -(-len(ALPHABET) // A_LONG)
    one = lambda code: F.call_function("shiftleft", F.lit(1).cast("long"), code % A_LONG * BITS)
    of = lambda counts, code: F.call_function(
        "shiftright", F.get(counts, F.floor(code / A_LONG).cast("int")), code % A_LONG * BITS
    ).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
    names = ("entropy_hex", "entropy_base64")

    def walk(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            return bound(F.struct(F.get(codes, i).alias("enters"), F.when(i >= WINDOW, F.get(codes, i - WINDOW)).alias("leaves")), lambda x: count(state, x, i))

        def count(state: Column, x: Column, i: Column) -> Column:
            enters, leaves = x["enters"], x["leaves"]
            more, less = of(state["counts"], enters), of(state["counts"], leaves)
            change = term(more + 1) - term(more) + F.when(leaves.isNotNull(), term(less - 1) - term(less)).otherwise(0.0)
            same = leaves.isNotNull() & (enters == leaves)
            at, gone = F.floor(enters / A_LONG), F.floor(leaves / A_LONG)
            counts = F.when(same, state["counts"]).otherwise(F.transform(
                state["counts"], lambda n, k: n + F.when(k == at, one(enters)).otherwise(0) - F.when(k == gone, one(leaves)).otherwise(0)
            ))
            total = F.when(same, state["total"]).otherwise(state["total"] + change)
            others = state["others"] + (enters >= HEX_DIGITS).cast("int") - F.coalesce((leaves >= HEX_DIGITS).cast("int"), F.lit(0))
            counted = F.struct(counts.alias("counts"), total.alias("total"), others.alias("others"))
            return bound(counted, lambda c: judge(state, c, i + 1))

        def judge(state: Column, c: Column, stop: Column) -> Column:
            full, bits = stop >= WINDOW, F.lit(math.log2(WINDOW)) - c["total"] / WINDOW + 1e-9
            fields, closed = [], []
            for name, own in zip(names, (c["others"] == 0, c["others"] > 0)):
                begin, end = state[f"begin_{name}"], state[f"stop_{name}"]
                hot = full & own & (bits >= LEAST_BITS[name])
                apart = hot & (end < stop - WINDOW)
                closed.append(F.when(apart & (end > 0), F.array(stretch(name, begin, end))).otherwise(nothing))
                fields += [F.when(hot & (apart | (end == 0)), stop - WINDOW).otherwise(begin).alias(f"begin_{name}"), F.when(hot, stop).otherwise(end).alias(f"stop_{name}")]
            some = F.size(closed[0]) + F.size(closed[1]) > 0
            out = F.when(some, F.concat(state["out"], *closed)).otherwise(state["out"])
            return F.struct(c["counts"].alias("counts"), c["total"].alias("total"), c["others"].alias("others"), *fields, out.alias("out"))

        first = F.struct(
            F.array_repeat(F.lit(0).cast("long"), longs).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("others"),
            *(F.lit(0).alias(f"{x}_{name}") for name in names for x in ("begin", "stop")), nothing.alias("out"),
        )
        last = lambda s: F.concat(s["out"], *(
            F.when(s[f"stop_{name}"] > 0, F.array(stretch(name, s[f"begin_{name}"], s[f"stop_{name}"]))).otherwise(nothing) for name in names
        ))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), first, step, last)

    stretch = lambda name, a, b: F.struct(a.alias("begin"), b.alias("stop"), F.lit(KINDS.index(name)).alias("kind"))
    nothing = F.array().cast("array<struct<begin:int,stop:int,kind:int>>")
    letters = F.filter(F.split(word, ""), lambda c: c != "")
    return bound(F.transform(letters, lambda c: F.instr(F.lit(ALPHABET), c) - 1), walk)


def by_entropy(text: Column, base: Column) -> Column:
    """Spans of hot stretches that are not within a base span, of candidates without their allowed ends."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def of(candidate: Column) -> Column:
        def spans(c: Column) -> Column:
            looked_at = (F.length(c["word"]) >= WINDOW) & ~F.rlike(c["word"], F.lit(ALL_BASE)) & ~allowed(c["word"])
            made = F.transform(hot_stretches(c["word"]), lambda s: F.struct(
                (candidate["start"] + c["begin"] + s["begin"]).alias("start"), s["kind"].alias("kind"), (candidate["start"] + c["begin"] + s["stop"]).alias("end")
            ))
            return F.when(looked_at, made).otherwise(none)

        return bound(core(candidate["word"]), lambda c: F.coalesce(spans(c), none))

    hot = F.flatten(F.transform(matched(text, CANDIDATE), of))
    return F.filter(hot, lambda s: ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))


def with_spans(docs: DataFrame, text_col: str = "text", base_as: str = "base", all_as: str = "all") -> DataFrame:
    """Adds sorted arrays of ``start, kind, end`` (code points, end exclusive): base spans, and all spans."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = F.array_sort(F.concat(found(text, ASSIGN, "assign", 3, LEAST_VALUE), found(text, ACCESS, "access"), found(text, HEX, "hex")))
    docs = docs.withColumn(base_as, base)
    return docs.withColumn(all_as, F.array_sort(F.concat(F.col(base_as), by_entropy(text, F.col(base_as)))))


def written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    A null text counts as empty and has no spans. Null ids and repeated rows are scanned like others; an
    empty table gives no rows; other columns are not looked at. Time follows the length of a text, also of one long
    candidate and of many; only the test whether a stretch lies within a base span takes one look for each pair.
    """
    docs = with_spans(id_and_text(docs, id_col, text_col))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return docs.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("all")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The same columns, with every span of ``text_col`` replaced; overlapping spans become one mask. Null stays null.

    Columns of the names ``__base`` and ``__all`` are replaced under way and must not be there."""
    marked = with_spans(docs, text_col, "__base", "__all")
    text = F.col(f"`{text_col}`")

    def chunk(state: Column, begin: Column) -> Column:
        """The text from here to the next chunk's spans is cut off first, so that places in it are found fast."""
        spans = F.slice("__all", begin + 1, F.lit(CHUNK))
        until = F.coalesce(F.get(F.col("__all.start"), begin + CHUNK), F.length(text))
        far = F.greatest(until, F.array_max(F.transform(spans, lambda s: s["end"])))
        piece = F.substr(text, state["at"] + 1, F.greatest(far - state["at"], F.lit(0)))
        return bound(piece, lambda p: masked(state, spans, p))

    def masked(state: Column, spans: Column, piece: Column) -> Column:
        def join(s: Column, x: Column) -> Column:
            more = x["end"] > s["at"]
            gap = F.concat(F.substr(piece, s["at"] - state["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0))), F.when(x["start"] >= s["at"], F.lit(mask)).otherwise(""))
            return F.struct(F.when(more, x["end"]).otherwise(s["at"]).alias("at"), F.when(more, F.concat(s["out"], gap)).otherwise(s["out"]).alias("out"))

        done = F.aggregate(spans, F.struct(state["at"].alias("at"), F.lit("").alias("out")), join)
        return bound(done, lambda d: F.struct(d["at"].alias("at"), F.concat(state["out"], F.array(d["out"])).alias("out")))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substr(text, s["at"] + 1))
    clean = F.aggregate(F.sequence(F.lit(0), F.size("__all") - 1, F.lit(CHUNK)), first, chunk, rest)
    return marked.select(*(
        F.when(F.size("__all") > 0, clean).otherwise(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns
    ))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: secrets give way to a mask; every row stays, in any number of copies, null texts too.

    ``n_chars`` is set to the new length (null for a null text). Columns called ``__base`` or ``__all`` must not be
    there. An empty table gives no rows."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long"))
