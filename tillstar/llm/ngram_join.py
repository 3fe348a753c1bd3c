"""Operator 10: n-gram Jaccard join with rare-first prefix, length, positional and suffix filters.

A document's set holds the hashes of its distinct word n-grams. Two sets link when 100 * common >=
percent * union. Sets are ordered rare first (by how many sets hold an n-gram, then by hash); two sets that link
share an n-gram in their prefixes, the first n - ceil(t * n) + 1 places. The steps:

1. ``frequent_sets``: one pass cuts the texts, in chunks of bounded bytes; equal sets of a chunk count once.
   Each n-gram goes to one of many reducers, which returns, to the chunk it came from, the number of sets that hold
   it if these are two or more. N-grams of one set cannot be shared, so they are dropped, and where what is left is
   less than a link needs, so is the document: most documents end here. Dropped n-grams keep their places: they
   come first in the order. N-grams in many documents of a chunk go to the reducer as a count, so what meets there
   for one n-gram grows with the chunks, not with the documents.
2. Equal sets are one class, for which its smallest id stands.
3. ``candidates`` joins on prefix n-grams. In the join's condition stand the length filter, the positional filter (what is
   left behind the n-gram must suffice), and a suffix filter: the sets' difference is at least the number of dropped
   n-grams plus the bits in which two 256-bit parities of the rest differ.
4. ``verified`` counts the common n-grams of each distinct pair once.

``pairs`` gives all links between classes. ``components`` needs only who is connected: first every member of a
prefix n-gram's list is compared with leaders of the list, then only members of different components with each other,
so a large group of near copies is not compared pair by pair; no link between different components is missed.

Words are runs of characters other than U+0020 and U+0009 to U+000D, with A-Z in lower case. Texts with fewer than
n words are one n-gram; null texts and texts without a word are an empty set, linked with nothing. Rows without an id
are left out of the join and have no component. Rows of one id are one document: what one of them links to, all do.

N-grams are told apart by 48 bits of their 64-bit hash and by their reducer, which the other 16 help to choose: with a million
n-grams to a reducer, about one pair of unequal ones in 300 reducers is taken for equal, which moves one set's count by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard
from .common import TwoGenerations, per_worker, release_once, ship, slices, stored, text_bytes
from .components import connected

MEMO_WORDS = 150_000
CHUNK_BYTES, CHUNK_DOCS = 8 << 20, 1 << 16  # of a chunk: texts end it at either
REDUCER_BYTES = 8 << 20  # texts for each reducer of n-grams
CROWDED = 8  # documents of a chunk that hold an n-gram, above which the reducer gets their number only
LOW_BITS = 48
LOW = (1 << LOW_BITS) - 1
DOCS, ENTRIES, COUNTS = range(3)
BLOBS = "kind int, r int, sub long, chunk long, x binary, y binary, z binary"
LEADERS = 2  # of each prefix n-gram's list, in a round
STAR_ROUNDS = 2


class Rule(NamedTuple):
    n: int = 5
    percent: int = 75

    def need(self, size):
        """The fewest n-grams a set shares with any it links to (a set no smaller or larger)."""
        return -(-self.percent * size // 100)


def word_hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


def shingles(text: str | None, n: int, hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(w))
    out = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        out = (out + w[i:i + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def _reducer(tokens: np.ndarray, reducers: int) -> np.ndarray:
    """The reducer of each n-gram: by the hash's highest 16 bits first, with 8 more for many reducers."""
    return (((tokens >> np.uint64(LOW_BITS)) << np.uint64(8)) | (tokens & np.uint64(255))) % np.uint64(reducers)


def _low_bytes(tokens: np.ndarray) -> bytes:
    """The low 48 bits of each number, in planes of 32 and of 16 bits."""
    return (tokens & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (tokens >> np.uint64(32) & np.uint64(0xFFFF)).astype(np.uint16).tobytes()


def _gram(low: np.ndarray, r: np.ndarray | int) -> np.ndarray:
    """One number for an n-gram's low bits and its reducer."""
    return low.astype(np.int64) | (np.int64(r) if isinstance(r, int) else r.astype(np.int64)) % (1 << 15) << LOW_BITS


def _from_low(raw: bytes, r: int) -> np.ndarray:
    n = len(raw) // 6
    low, high = np.frombuffer(raw, np.uint32, n), np.frombuffer(raw, np.uint16, n, 4 * n)
    return _gram(low.astype(np.int64) | high.astype(np.int64) << 32, r)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split(" ")[0] for c in BLOBS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _chunk_rows(chunk: int, ids: list[int | None], sets: list[np.ndarray], reducers: int) -> Iterator[tuple]:
    """The rows of a chunk: for each reducer its n-grams, and one of its documents, with the members of crowded n-grams."""
    import xxhash

    keys = [xxhash.xxh128_digest(s.tobytes()) for s in sets]
    seen: set[bytes] = set()
    first = []
    for k, (i, key) in enumerate(zip(ids, keys)):
        if i is not None and len(sets[k]) and key not in seen:
            seen.add(key)
            first.append(k)
    crowded_grams, crowded_places, crowded_numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
    if first:
        tokens = np.concatenate([sets[k] for k in first])
        place = np.repeat(np.array(first, np.uint16), [len(sets[k]) for k in first])
        where = _reducer(tokens, reducers)
        order = np.lexsort((tokens & np.uint64(LOW), where))
        tokens, place, where = tokens[order] & np.uint64(LOW), place[order], where[order].astype(np.int64)
        for r, (a, b) in zip(*_runs(where)):
            own, inverse, counts = np.unique(tokens[a:b], return_inverse=True, return_counts=True)
            many = counts > CROWDED
            crowded = many[inverse]
            # The crowded ones stand behind the entries, with their numbers instead of places.
            yield (ENTRIES, int(r), 0, chunk, _low_bytes(np.concatenate((tokens[a:b][~crowded], own[many]))), place[a:b][~crowded].tobytes(),
                   counts[many].astype(np.int32).tobytes())
            if many.any():
                crowded_grams.append(_gram(own[many], int(r)))
                crowded_places.append(place[a:b][crowded])
                crowded_numbers.append(counts[many])
    grams, numbers = np.concatenate(crowded_grams), np.concatenate(crowded_numbers)
    head = np.array([len(ids), len(grams)], np.int64)
    yield (DOCS, -1, chunk + 1, chunk, head.tobytes() + np.array([[i is not None, i or 0] for i in ids], np.int64).reshape(-1, 2).tobytes()
           + np.array([len(s) for s in sets], np.int64).tobytes() + b"".join(keys),
           grams.tobytes() + numbers.astype(np.int64).tobytes(), np.concatenate(crowded_places).tobytes())


def _runs(values: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The runs of equal values in a sorted array: each value, and its first and next position."""
    if not len(values):
        return values, []
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(values)]))
    return values[starts], list(zip(starts.tolist(), ends.tolist()))


def _reduce(rows: pd.DataFrame) -> pd.DataFrame:
    """Of one reducer: the n-grams that two or more sets hold, back by chunk. A chunk's own row passes."""
    release_once()
    if rows["kind"].iat[0] != ENTRIES:
        return rows
    r = int(rows["r"].iat[0])
    tokens, places, numbers, chunks = [], [], [], []
    for chunk, x, y, z in zip(rows["chunk"], rows["x"], rows["y"], rows["z"]):
        t, p, n = _from_low(x, r), np.frombuffer(y, np.uint16), np.frombuffer(z, np.int32)
        tokens.append(t)
        places.append(np.concatenate((p.astype(np.int32), np.full(len(n), -1, np.int32))))
        numbers.append(np.concatenate((np.ones(len(p), np.int32), n)))
        chunks.append(np.full(len(t), chunk, np.int64))
    token, place, number, chunk = map(np.concatenate, (tokens, places, numbers, chunks))
    order = np.argsort(token, kind="stable")
    token, place, number, chunk = token[order], place[order], number[order], chunk[order]
    starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    held = np.repeat(np.add.reduceat(number, starts), np.diff(np.append(starts, len(token))))
    shared = held > 1
    token, place, chunk, held = token[shared], place[shared], chunk[shared], held[shared]
    order = np.argsort(chunk, kind="stable")
    token, place, chunk, held = token[order], place[order], chunk[order], held[order].astype(np.int32)
    out = []
    for c, (a, b) in zip(*_runs(chunk)):
        single = place[a:b] >= 0
        for kind, part in ((ENTRIES, single), (COUNTS, ~single)):
            if part.any():
                out.append((kind, r, 0, int(c), token[a:b][part].tobytes(), place[a:b][part].astype(np.uint16).tobytes(), held[a:b][part].tobytes()))
    return pd.DataFrame(out, columns=list(rows.columns))


def _gather(rows: pd.DataFrame, rule: Rule) -> pd.DataFrame:
    """Of one chunk: its documents, with the shared n-grams rare first where a link is possible."""
    release_once()
    own = rows[rows["kind"] == DOCS].iloc[0]
    n, crowded = np.frombuffer(own["x"], np.int64, 2).tolist()
    ids = np.frombuffer(own["x"], np.int64, 2 * n, 16).reshape(-1, 2)
    sizes, keys = np.frombuffer(own["x"], np.int64, n, 16 + 16 * n), own["x"][16 + 24 * n:]
    grams, numbers = np.frombuffer(own["y"], np.int64, crowded), np.frombuffer(own["y"], np.int64, crowded, 8 * crowded)
    tokens, places, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    of_all = np.zeros(len(grams), np.int32)
    order = np.argsort(grams)
    for kind, x, y, z in zip(rows["kind"], rows["x"], rows["y"], rows["z"]):
        if kind == ENTRIES:
            tokens.append(np.frombuffer(x, np.int64))
            places.append(np.frombuffer(y, np.uint16).astype(np.int64))
            held.append(np.frombuffer(z, np.int32))
        elif kind == COUNTS:
            of_all[order[np.searchsorted(grams, np.frombuffer(x, np.int64), sorter=order)]] = np.frombuffer(z, np.int32)
    tokens.append(np.repeat(grams, numbers))
    places.append(np.frombuffer(own["z"], np.uint16).astype(np.int64))
    held.append(np.repeat(of_all, numbers))
    token, place, h = map(np.concatenate, (tokens, places, held))
    order = np.lexsort((token, h, place))
    token, place = token[order], place[order]
    found = {int(p): token[a:b] for p, (a, b) in zip(*_runs(place))}
    rest = [t if (t := found.get(k)) is not None and len(t) >= rule.need(int(size)) else None for k, size in enumerate(sizes)]
    return pd.DataFrame({"id": pd.array([int(i) if there else None for there, i in ids], dtype="Int64"), "n": sizes,
                         "set_key": [keys[16 * k:16 * k + 16] for k in range(len(sizes))], "grams": rest})


def frequent_sets(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, n (its set's size), set_key (a digest of its set) and grams: its n-grams in two or more sets,
    rare first; null where these are too few for a link, and for all but one of the equal sets of a chunk."""
    ship(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    reducers = min(1 << 23, max(1, math.ceil(text_bytes(rows) / REDUCER_BYTES)))

    def blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = per_worker("word-hashes", lambda: TwoGenerations(word_hash, MEMO_WORDS))
        chunk, ids, sets, held = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for few in slices(batch):
                for i, text in zip(few.column(0).to_pylist(), few.column(1).to_pylist()):
                    ids.append(i)
                    sets.append(shingles(text, rule.n, hashes))
                    held += len(text or "")
                    if held >= CHUNK_BYTES or len(ids) == CHUNK_DOCS:
                        for row in _chunk_rows(chunk, ids, sets, reducers):
                            yield _batch([row])
                        chunk, ids, sets, held = chunk + 1, [], [], 0
        if ids:
            for row in _chunk_rows(chunk, ids, sets, reducers):
                yield _batch([row])

    shared = rows.mapInArrow(blobs, BLOBS).groupBy("r", "sub").applyInPandas(_reduce, BLOBS)
    return shared.groupBy("chunk").applyInPandas(lambda chunk: _gather(chunk, rule), "id long, n long, set_key binary, grams array<long>")


def classes(sets: DataFrame) -> DataFrame:
    """Per distinct set of documents with id and words: set_key and rep, its smallest id."""
    return sets.where("id is not null and n > 0").groupBy("set_key").agg(F.min("id").alias("rep"))


def representatives(sets: DataFrame, reps: DataFrame) -> DataFrame:
    """One row per class that may link: id, n and grams (of any of its rows that has them: equal sets share n-grams)."""
    with_grams = sets.where("grams is not null").select("set_key", "n", "grams")
    # A class has at most a row for each chunk here; ids and n-grams of a class are the same in all.
    one = with_grams.withColumn("chunk_row", F.monotonically_increasing_id())
    first = one.groupBy("set_key").agg(F.min("chunk_row").alias("chunk_row"))
    return (one.join(first, ["set_key", "chunk_row"]).join(reps, "set_key").select(F.col("rep").alias("id"), "n", "grams"))


def parity(grams: Column) -> Column:
    """Four longs: the parity of the n-grams in each of 256 classes."""

    def word(k: int) -> Column:
        own = F.filter(grams, lambda g: F.shiftright(g, 6).bitwiseAND(F.lit(3)) == k)
        return F.aggregate(own, F.lit(0).cast("long"), lambda acc, g: acc.bitwiseXOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), g.bitwiseAND(F.lit(63)).cast("int"))))

    return F.array(*(word(k) for k in range(4)))


def postings(nodes: DataFrame, rule: Rule) -> DataFrame:
    """A row for each prefix n-gram: gram, id, n, at (its place in the rare-first order), alone (dropped n-grams of
    the set) and the parities p0 to p3."""
    alone = F.col("n") - F.size("grams")
    prefix = F.col("n") - F.ceil(F.lit(rule.percent) * F.col("n") / 100) + 1 - alone
    rows = nodes.select("id", "n", alone.alias("alone"), parity(F.col("grams")).alias("p"),
                        F.slice("grams", F.lit(1), F.greatest(F.lit(0), prefix).cast("int")).alias("prefix"))
    rows = rows.select("id", "n", "alone", *(F.col("p")[k].alias(f"p{k}") for k in range(4)), F.posexplode("prefix").alias("k", "gram"))
    return rows.select("gram", "id", "n", "alone", (F.col("alone") + F.col("k")).alias("at"), *(f"p{k}" for k in range(4)))


def may_link(rule: Rule, x: str, y: str) -> Column:
    """The length, positional and suffix filters on a pair of postings of one n-gram. At the first n-gram that two sets
    share none of them rejects a pair that links."""
    c = lambda side, name: F.col(f"{side}_{name}")
    total = c(x, "n") + c(y, "n")
    common = F.ceil(F.lit(rule.percent) * total / (100 + rule.percent) - 1e-9)
    length = (100 * F.least(c(x, "n"), c(y, "n")) >= rule.percent * F.greatest(c(x, "n"), c(y, "n")))
    behind = F.least(c(x, "n") - c(x, "at"), c(y, "n") - c(y, "at"))
    differ = c(x, "alone") + c(y, "alone")
    for k in range(4):
        differ = differ + F.bit_count(c(x, f"p{k}").bitwiseXOR(c(y, f"p{k}")))
    return length & (behind >= common) & (differ <= total - 2 * common)


def _side(rows: DataFrame, side: str) -> DataFrame:
    return rows.select(*(F.col(c) if c in ("gram", "band") else F.col(c).alias(f"{side}_{c}") for c in rows.columns))


def candidates(lists: DataFrame, rule: Rule) -> DataFrame:
    """Distinct pairs (a < b) that meet in a prefix n-gram and pass the filters; only pairs of different components if
    ``lists`` has a column ``component``. Lists are cut by size: sets that link are in the same or the next band."""
    width = math.log(100 / rule.percent)
    band = F.floor(F.log(F.col("n").cast("double")) / width + 1e-9).cast("int")
    rows = lists.withColumn("band", band)
    left = _side(rows, "x")
    # Each set meets its own band and, from above, the one below.
    right = _side(rows.withColumn("band", F.explode(F.array("band", F.col("band") - 1))).withColumn("own", F.col("band") == band), "y")
    apart = F.col("x_component") != F.col("y_component") if "component" in lists.columns else F.lit(True)
    once = F.when(F.col("y_own"), F.col("x_id") < F.col("y_id")).otherwise(F.col("x_id") != F.col("y_id"))
    met = left.join(right, (left["gram"] == right["gram"]) & (left["band"] == right["band"]) & once & apart & may_link(rule, "x", "y"))
    return met.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()


def star_candidates(lists: DataFrame, rule: Rule, round_no: int) -> DataFrame:
    """Distinct pairs of each list's members with one of its members, chosen by a hash (of ids, and of a few values
    of the n-gram, so that lists of the same sets mostly choose alike)."""
    seed = F.pmod("gram", F.lit(LEADERS))
    order = F.xxhash64(F.lit(round_no), seed, "id")
    names = [c for c in lists.columns if c != "gram"]
    lead = lists.groupBy("gram").agg(F.min(F.struct(order.alias("o"), *names)).alias("lead"))
    leaders = lead.select("gram", *(F.col(f"lead.{c}").alias(f"y_{c}") for c in names))
    met = _side(lists, "x").join(leaders, "gram").where(F.col("x_id") != F.col("y_id")).where(may_link(rule, "x", "y"))
    if "component" in names:
        met = met.where(F.col("x_component") != F.col("y_component"))
    return met.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()


def verified(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that link, with ``common``. Dropped n-grams are in one set only, so the others hold all that is common."""
    a = nodes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    b = nodes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    counted = pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("long").alias("common"))
    return counted.where(100 * F.col("common") >= rule.percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b", "na", "nb", "common")


def pairs(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links between classes (a < b, na, nb, common), and the membership: id, n and rep, null for empty sets."""
    sets = stored(frequent_sets(df, rule, id_col, text_col), "ngram-sets")
    reps = stored(classes(sets), "ngram-classes")
    nodes = stored(representatives(sets, reps), "ngram-nodes")
    links = verified(candidates(postings(nodes, rule), rule), nodes, rule)
    return links, sets.select("id", "n", "set_key").join(reps, "set_key", "left").select("id", "n", "rep")


def components(df: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n and component, the smallest id reachable by links (its own for an empty set)."""
    sets = stored(frequent_sets(df, rule, id_col, text_col), "ngram-sets")
    reps = stored(classes(sets), "ngram-classes")
    nodes = stored(representatives(sets, reps), "ngram-nodes")
    lists = postings(nodes, rule)
    several = lists.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1").select("gram")
    lists = stored(lists.join(several, "gram"), "ngram-lists")
    found, labels, done = None, None, [sets, reps, nodes, lists]
    for step in range(STAR_ROUNDS + 1):
        if labels is None:
            now = lists
        else:
            now = lists.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
            mixed = now.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("gram")
            now = now.join(mixed, "gram")
        tried = star_candidates(now, rule, step) if step < STAR_ROUNDS else candidates(now, rule)
        links = stored(verified(tried, nodes, rule).select("a", "b"), "ngram-links")
        found = links if found is None else found.unionByName(links)
        done.append(links)
        if labels is not None:
            discard(labels)
        labels = connected(found)
    member = sets.join(reps, "set_key", "left").select("id", "n", F.coalesce("rep", "id").alias("node"))
    # Rows of one id are one document, even if their sets differ: their classes are linked.
    named = stored(member.join(labels, "node", "left").select("id", "n", F.coalesce("component", "node").alias("component")), "ngram-members")
    discard(*done, labels)
    return same_id(named)


def same_id(named: DataFrame) -> DataFrame:
    torn = named.groupBy("id").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi and id is not null")
    if torn.isEmpty():
        return named
    edges = named.join(torn.select("id", "lo"), "id").select(F.col("lo").alias("a"), F.col("component").alias("b"))
    joined = connected(edges).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return named.join(joined, "component", "left").select("id", "n", F.coalesce("whole", "component").alias("component"))
