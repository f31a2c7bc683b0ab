"""N-gram Jaccard join: components of documents whose shingle sets overlap enough.

Method: size-aware heavy-light join over distinct sets (equal sets are one class from the start).

* Light: a set of at most ``x`` shingles emits every subset that an overlap with a partner could
  be, as hashes. Two sets that share such a subset of fixed size c overlap in c shingles at least,
  so the sizes decide the link at once; within a list the smallest set links all that link at all.
* Heavy: pairs with a larger set meet in inverted lists over the sets' prefixes (a set of n
  needs only its first n - ceil(t n) + 1 shingles in a common order). The order puts shingles that
  very many sets hold last, so that common passages stay out of the lists.
* The boundary x is the one of least cost: subsets of the sets up to it against list entries and
  comparisons of the rest, with the measured sizes and list lengths.

Never all pairs of a group: lists first propose each member's neighbour in size and its smallest
member, linked sets are merged into components, and only then do lists propose the pairs
whose components still differ. A proposal passes a parity bitmap (its distance never exceeds
that of the sets), and is verified exactly on whole sets, which travel to the smaller id in salted groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.llm.common import arrow_schema, extend, lean, map_rows, mix, ngram_hashes, ship_package, stage, texts, with_fields, word_hashes

MAX_LIGHT = 26
HOT_SHARE = 1 << 22
HOT_LEAST = 16
SENT_IDS = 1 << 20
SALT_ROWS = 256
HASH_BYTES = 6
SHORT_LIST = 1024
ROUND_PAIRS = 64


@dataclass(frozen=True)
class Spec:
    """Shingles of ``n`` words; a link needs den * intersection >= num * union."""

    n: int = 4
    num: int = 85
    den: int = 100

    def need(self, size: int) -> int:
        """The least overlap with any partner."""
        return -(-self.num * size // self.den)

    def prefix(self, size: int) -> int:
        return size - self.need(size) + 1

    def subsets(self, size: int) -> int:
        return sum(math.comb(size, d) for d in range(size - self.need(size) + 1))

    def linked(self, overlap, a, b):
        return self.den * overlap >= self.num * (a + b - overlap)


def shingles(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a text of fewer than n words is one shingle, without words none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words)
    return np.unique(ngram_hashes(h, min(n, len(h))) ^ np.uint64(n - min(n, len(h))))


def set_hash(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    one = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = mix(s * np.uint64(0xDA942042E4DD58B5) + np.uint64(len(s))).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def parity(s: np.ndarray) -> bytes:
    """Bit i: whether an odd number of shingles has h mod bits = i; bits is a power of two, at least the size and 64."""
    bits = 1 << max(6, int(len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def parity_distance(a: bytes, b: bytes) -> int:
    """At most the size of the symmetric difference. The longer bitmap folds onto the shorter."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


# ---------------------------------------------------------------- sets

def common_shingles(docs: DataFrame, spec: Spec) -> np.ndarray:
    """Shingles that hold more than about 1/HOT_SHARE of all set elements: fewer than HOT_SHARE.

    Each batch counts the distinct sets it holds and passes on what is common there. The result
    orders the prefixes, so it decides how long the lists are, never what links.
    """
    ship_package(docs.sparkSession)
    schema = T.StructType([T.StructField("h", T.LongType()), T.StructField("n", T.LongType()), T.StructField("total", T.LongType())])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = {set_hash(s): s for s in (shingles(t, spec.n) for t in texts(batch.column("text"))) if len(s)}
            total = sum(map(len, sets.values()))
            h, n = np.unique(np.concatenate([np.empty(0, np.uint64), *sets.values()]), return_counts=True)
            often = (n * HOT_SHARE > total) & (n > 1)
            yield pa.RecordBatch.from_arrays([pa.array([*h[often].view(np.int64).tolist(), None], pa.int64()), pa.array([*n[often].tolist(), 0], pa.int64()),
                                              pa.array([0] * int(often.sum()) + [total], pa.int64())], schema=out)

    sums = stage(docs.mapInArrow(lean(run), schema).groupBy("h").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "shingle_counts")
    total = sums.where("h is null").select("total").first()
    if not total:
        return np.empty(0, np.uint64)
    hot = sums.where(F.col("h").isNotNull() & (F.col("n") * HOT_SHARE > total[0]) & (F.col("n") >= HOT_LEAST)).select("h").toArrow()  # 32 MB at most
    return np.sort(hot.column("h").to_numpy().view(np.uint64))


def set_table(docs: DataFrame, spec: Spec, hot: np.ndarray) -> DataFrame:
    """(id, n, s1, s2, first, parity) of (id, text): ``first`` holds the prefix, or the whole set up to MAX_LIGHT."""
    schema = T.StructType([docs.schema["id"], T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()),
                           T.StructField("first", T.BinaryType()), T.StructField("parity", T.BinaryType())])

    def run(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        n, s1, s2, first, bits = [], [], [], [], []
        for t in texts(batch.column("text")):
            s = shingles(t, spec.n)
            late = hot[np.minimum(np.searchsorted(hot, s), len(hot) - 1)] == s if len(hot) else np.zeros(len(s), bool)
            a, b = set_hash(s)
            take = len(s) if len(s) <= MAX_LIGHT else spec.prefix(len(s))
            n.append(len(s))
            s1.append(a)
            s2.append(b)
            first.append(np.concatenate([s[~late], s[late]])[:take].tobytes())
            bits.append(parity(s) if len(s) else b"")
        return extend(batch, out, n=n, s1=s1, s2=s2, first=first, parity=bits)

    return map_rows(docs, schema, run)


def light_boundary(sets: DataFrame, spec: Spec) -> int:
    """The size up to which subsets cost less than lists."""
    small = sets.where(F.col("n").between(1, MAX_LIGHT))
    count = {r["n"]: r["k"] for r in small.groupBy("n").agg(F.count("*").alias("k")).collect()}  # at most MAX_LIGHT rows
    size = T.StructType([T.StructField("h", T.LongType())])

    def entries(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        all_h = [np.frombuffer(f, np.int64)[:spec.prefix(n)] for f, n in zip(batch.column("first").to_pylist(), batch.column("n").to_pylist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(all_h))], schema=out)

    lists = map_rows(small.select("n", "first"), size, entries).groupBy("h").agg(F.count("*").alias("k"))
    got = lists.agg(F.sum("k").alias("rows"), F.sum(F.col("k") * F.col("k")).alias("met")).first()
    met = float(got["met"] or 0) / max(1, got["rows"] or 0)  # members of the list that an entry sees

    def cost(x: int) -> float:
        return sum(k * (spec.subsets(n) if n <= x else spec.prefix(n) * (1 + (met - 1) * n)) for n, k in count.items())

    return min(range(MAX_LIGHT + 1), key=cost)


# ---------------------------------------------------------------- proposals

ENTRY = T.StructType([T.StructField("key", T.LongType()), T.StructField("c", T.IntegerType()),
                      T.StructField("n", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("id", T.LongType())])
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def list_entries(sets: DataFrame, spec: Spec, x: int) -> DataFrame:
    """Entries of both kinds: c = 0 for a prefix shingle (``at``: its place), the size c of a subset otherwise."""
    out = arrow_schema(ENTRY)
    near = spec.need(x + 1)  # smaller sets meet no set over x

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, c, n, at, who = [], [], [], [], []

            def add(keys: np.ndarray, cs: np.ndarray, ats: np.ndarray, size: int, i: int, key=key, c=c, n=n, at=at, who=who) -> None:
                key.append(keys)
                c.append(cs)
                at.append(ats)
                n.append(np.full(len(keys), size))
                who.append(np.full(len(keys), i))

            for i, size, first in zip(batch.column("id").to_pylist(), batch.column("n").to_pylist(), batch.column("first").to_pylist(), strict=True):
                s = np.frombuffer(first, np.uint64)
                if size <= x:
                    h = mix(np.sort(s) ^ np.uint64(0x2545F4914F6CDD1D))
                    whole = h.sum(dtype=np.uint64)
                    for d in range(size - spec.need(size) + 1):
                        less = np.array([h[list(g)].sum(dtype=np.uint64) for g in combinations(range(size), d)], np.uint64)
                        add(mix(whole - less + np.uint64(size - d)), np.full(len(less), size - d), np.zeros(len(less)), size, i)
                if size >= near:
                    p = spec.prefix(size)
                    add(s[:p], np.zeros(p), np.arange(p), size, i)
            if key:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(key).view(np.int64)), *[pa.array(np.concatenate(v).astype(np.int32)) for v in (c, n, at)],
                                                  pa.array(np.concatenate(who).astype(np.int64))], schema=out)

    return sets.select("id", "n", "first").mapInArrow(lean(run), ENTRY)


SHARED = T.StructType([*ENTRY.fields, T.StructField("hub", T.LongType()), T.StructField("hub_n", T.IntegerType()), T.StructField("place", T.LongType())])


def shared_entries(entries: DataFrame) -> DataFrame:
    """The entries of lists with two members at least, with the list's smallest id and the entry's
    place by id. Streams with one entry held back, so a list may have any length."""
    dealt = entries.repartition("key").sortWithinPartitions("key", "c", "id")
    out = arrow_schema(SHARED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.RecordBatch.from_arrays([pa.concat_arrays([x, y]) for x, y in zip(held.columns[:5], batch.columns, strict=True)], schema=batch.schema)
            key, c = batch.column("key").to_numpy(), batch.column("c").to_numpy()
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (c[1:] != c[:-1])
            at = np.arange(len(key))
            first = np.maximum.accumulate(np.where(new, at, 0))
            hub, hub_n, place = batch.column("id").to_numpy()[first], batch.column("n").to_numpy()[first], at - first
            if held is not None:  # the first list began in an earlier batch
                own = first == 0
                hub, hub_n = np.where(own, held.column("hub")[0].as_py(), hub), np.where(own, held.column("hub_n")[0].as_py(), hub_n).astype(np.int32)
                place = place + own * held.column("place")[0].as_py()
            shared = place > 0
            shared[:-1] |= ~new[1:]
            full = pa.RecordBatch.from_arrays([*batch.columns, pa.array(hub), pa.array(hub_n), pa.array(place)], schema=out)
            yield full.slice(0, len(key) - 1).filter(pa.array(shared[:-1]))
            held = full.slice(len(key) - 1)
        if held is not None and held.column("place")[0].as_py() > 0:
            yield held

    return dealt.mapInArrow(lean(run), SHARED)


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def subset_links(lists: DataFrame, spec: Spec) -> DataFrame:
    """Links that shared subsets prove: each member with the smallest set of its list."""
    light = lists.where("c > 0")
    hub = light.groupBy("key", "c").agg(F.min(F.struct("n", "id")).alias("least"))
    met = light.join(hub, ["key", "c"]).where(spec.linked(F.col("c"), F.col("least.n"), F.col("n")) & (F.col("id") != F.col("least.id")))
    return met.select(F.col("least.id").alias("x"), F.col("id").alias("y")).select(*_ordered("x", "y")).distinct()


def hub_pairs(lists: DataFrame, spec: Spec, x: int) -> DataFrame:
    """(a, b, na, nb): each member of a list with its smallest id and, in lists of three and more,
    with the member that has the largest part of its prefix in such lists.

    The text that the others are copies of shares the most, so a large group of near copies is
    mostly joined through it, with one proposal a member.
    """
    heavy = lists.where("c = 0")
    least = heavy.where("place > 0").select(F.col("hub").alias("x"), F.col("hub_n").alias("nx"), F.col("id").alias("y"), F.col("n").alias("ny"))
    long = stage(heavy.select("key", "id", "n", "p").join(heavy.where("place = 2").select("key"), "key"), "long_lists")
    weight = long.groupBy("id").agg((F.count("*") / F.max("p")).alias("w"))
    told = stage(long.join(weight, "id").select("key", "id", "n", "w"), "weighted")
    hubs = told.groupBy("key").agg(F.max(F.struct("w", (-F.col("id")).alias("order"), "id", "n")).alias("most"))
    most = told.join(hubs, "key").select(F.col("most.id").alias("x"), F.col("most.n").alias("nx"), F.col("id").alias("y"), F.col("n").alias("ny"))
    return sized_pairs(least.unionByName(most), spec, x)


def sized_pairs(pairs: DataFrame, spec: Spec, x: int) -> DataFrame:
    """Distinct (a, b, na, nb) of (x, nx, y, ny) whose sizes allow a link that subsets do not settle."""
    fit = spec.linked(F.least("nx", "ny"), F.col("nx"), F.col("ny")) & (F.greatest("nx", "ny") > x) & (F.col("x") != F.col("y"))
    first = F.col("x") < F.col("y")
    return pairs.where(fit).select(*_ordered("x", "y"), F.when(first, F.col("nx")).otherwise(F.col("ny")).alias("na"),
                                   F.when(first, F.col("ny")).otherwise(F.col("nx")).alias("nb")).distinct()


CROSS = T.StructType([T.StructField(c, T.LongType()) for c in ("x", "nx", "y", "ny", "key", "at", "comp")])


def cross_pairs(lists: DataFrame, comps: DataFrame, spec: Spec, x: int) -> DataFrame:
    """(a, b, na, nb): all pairs of a list in different components that may still link.

    A pair is proposed where the two sets' remaining lengths after the shared place leave room for
    the overlap that a link needs; a linking pair passes at its first shared place. Lists of up to
    SHORT_LIST entries are paired where they are read. The entries of longer ones pass through, and
    meet by component in joins that spill, so members of one component are never paired.
    """
    heavy = (lists.where("c = 0").join(comps, "id", "left")
             .select("key", F.col("id").alias("x"), F.col("n").cast("long").alias("nx"), F.col("at").cast("long").alias("at"), F.coalesce("comp", "id").alias("comp")))
    dealt = heavy.repartition("key").sortWithinPartitions("key")
    out = arrow_schema(CROSS)
    names = ("key", "x", "nx", "at", "comp")

    def entry(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
        none = pa.nulls(len(cols["key"]), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(cols["x"]), pa.array(cols["nx"]), none, none, *[pa.array(cols[c]) for c in ("key", "at", "comp")]], schema=out)

    def pairs(cols: dict[str, np.ndarray]) -> pa.RecordBatch:
        key, who, n, at, comp = (cols[c] for c in names)
        found = []
        for gap in range(1, SHORT_LIST):
            i = np.flatnonzero(key[gap:] == key[:-gap])
            if not len(i):
                break
            j = i + gap
            room = 1 + np.minimum(n[i] - at[i], n[j] - at[j]) - 1
            fit = (comp[i] != comp[j]) & spec.linked(room, n[i], n[j]) & (np.maximum(n[i], n[j]) > x)
            found.append(np.stack([who[i[fit]], n[i[fit]], who[j[fit]], n[j[fit]]], 1))
        rows = np.unique(np.concatenate([np.empty((0, 4), np.int64), *found]), axis=0)
        none = pa.nulls(len(rows), pa.int64())
        return pa.RecordBatch.from_arrays([*[pa.array(np.ascontiguousarray(rows[:, k])) for k in range(4)], none, none, none], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, long = None, None  # entries of a list that may go on; the key of a long list that passes through
        for batch in batches:
            cols = {c: batch.column(c).to_numpy() for c in names}
            if not len(cols["key"]):
                continue
            if rest is not None:
                cols = {c: np.concatenate([rest[c], v]) for c, v in cols.items()}
            key = cols["key"]
            begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(begins, len(key)))
            big = np.repeat((size > SHORT_LIST) | (key[begins] == long), size)
            last = np.zeros(len(key), bool)
            last[begins[-1]:] = True
            wait = last & ~big
            yield pairs({c: v[~big & ~wait] for c, v in cols.items()})
            yield entry({c: v[big] for c, v in cols.items()})
            long = key[-1] if big[-1] else None
            rest = {c: v[wait] for c, v in cols.items()} if wait.any() else None
        if rest is not None:
            yield pairs(rest)

    got = stage(dealt.mapInArrow(lean(run), CROSS), "cross")
    long = got.where("y is null").select("key", "x", "nx", "at", "comp")
    own = long.select("key", "comp").distinct()
    met = own.select("key", F.col("comp").alias("c1")).join(own.select("key", F.col("comp").alias("c2")), "key").where("c1 < c2")
    left = long.select("key", F.col("comp").alias("c1"), "x", "nx", F.col("at").alias("px"))
    right = long.select("key", F.col("comp").alias("c2"), F.col("x").alias("y"), F.col("nx").alias("ny"), F.col("at").alias("py"))
    room = 1 + F.least(F.col("nx") - F.col("px") - 1, F.col("ny") - F.col("py") - 1)
    both = met.join(left, ["key", "c1"]).join(right, ["key", "c2"]).where(spec.linked(room, F.col("nx"), F.col("ny")))
    return sized_pairs(got.where("y is not null").select("x", "nx", "y", "ny").unionByName(both.select("x", "nx", "y", "ny")), spec, x)


# ---------------------------------------------------------------- checks

def likely(pairs: DataFrame, sets: DataFrame, spec: Spec) -> DataFrame:
    """The (a, b) whose bitmaps do not rule a link out."""
    bits = sets.select("id", "parity")
    wide = (pairs.join(bits.select(F.col("id").alias("a"), F.col("parity").alias("pa")), "a")
            .join(bits.select(F.col("id").alias("b"), F.col("parity").alias("pb")), "b"))

    def run(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        keep = []
        for x, y, na, nb in zip(*(batch.column(c).to_pylist() for c in ("pa", "pb", "na", "nb")), strict=True):
            need = -(-spec.num * (na + nb) // (spec.num + spec.den))
            keep.append(parity_distance(x, y) <= na + nb - 2 * need)
        return pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b")], schema=out).filter(pa.array(keep, pa.bool_()))

    return map_rows(wide, PAIR, run)


TESTED = T.StructType([*PAIR.fields, T.StructField("ok", T.BooleanType())])


def verify(docs: DataFrame, pairs: DataFrame, class_of: DataFrame, spec: Spec) -> DataFrame:
    """(a, b, ok) by whole sets. Set b travels to set a; a set that many others ask for is copied to several tasks."""
    asked = pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).alias("salts"))
    salted = pairs.join(asked, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
    requests = (salted.select(F.col("b").alias("rid"), F.col("a").alias("target"), "salt", F.lit(1).alias("kind"))
                .unionByName(salted.select(F.col("a").alias("rid"), F.col("a").alias("target"), "salt", F.lit(0).alias("kind")).distinct()))
    requests = requests.join(class_of.select(F.col("id").alias("rid"), "s1", "s2"), "rid")
    # only the texts asked for are shuffled: few ids are sent to the documents, many meet them in a shuffle join
    ids = stage(requests.select(F.col("rid").alias("id")).distinct(), "asked")
    docs = docs.join(F.broadcast(ids) if ids.count() <= SENT_IDS else ids, "id", "left_semi")
    packed = map_rows(docs, T.StructType([docs.schema["id"], T.StructField("packed", T.BinaryType())]), lambda batch, out: pa.RecordBatch.from_arrays(
        [batch.column("id"), pa.array([zstandard.compress(t) for t in texts(batch.column("text"))], pa.binary())], schema=out))
    sent = T.StructType([T.StructField("target", T.LongType()), T.StructField("salt", T.LongType()), T.StructField("kind", T.IntegerType()),
                         T.StructField("rid", T.LongType()), T.StructField("set", T.BinaryType())])

    def make(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        made, last = [], (None, None)
        for t, s1, s2 in zip(*(batch.column(c).to_pylist() for c in ("packed", "s1", "s2")), strict=True):
            if last[0] != t:
                s = shingles(zstandard.decompress(t), spec.n)
                last = (t, (s.view(np.uint8).reshape(-1, 8)[:, 8 - HASH_BYTES:].tobytes(), set_hash(s)))
            made.append(last[1][0] if last[1][1] == (s1, s2) else None)  # rows may share an id
        batch = extend(batch, out, set=made)
        return batch.filter(batch.column("set").is_valid())

    sets = map_rows(packed.join(requests, packed["id"] == requests["rid"]), sent, make)
    dealt = sets.repartition("target", "salt").sortWithinPartitions("target", "salt", "kind")
    out = arrow_schema(TESTED)

    def load(raw: bytes) -> np.ndarray:
        wide = np.zeros((len(raw) // HASH_BYTES, 8), np.uint8)
        wide[:, :HASH_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, HASH_BYTES)
        return wide.view(np.uint64).reshape(-1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = None, None
        for batch in batches:
            a, b, ok = [], [], []
            for target, salt, kind, rid, raw in zip(*(batch.column(c).to_pylist() for c in ("target", "salt", "kind", "rid", "set")), strict=True):
                if kind == 0:
                    own, at = load(raw), (target, salt)
                elif at == (target, salt):
                    other = load(raw)  # sorted, as its hashes were
                    place = np.minimum(np.searchsorted(own, other), len(own) - 1)
                    a.append(target)
                    b.append(rid)
                    ok.append(bool(spec.linked(int((own[place] == other).sum()), len(own), len(other))))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(ok, pa.bool_())], schema=out)

    return dealt.mapInArrow(lean(run), TESTED).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, comp): the smallest id that links reach, for every id in a link.

    Each component hooks onto its smallest neighbour, the hooks are shortened to their roots by
    pointer jumping, and the links are redrawn between roots until none is left.
    """
    edges = stage(links.select("a", "b").distinct(), "edges")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    comps = stage(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("comp", F.col("id")), "components")
    while not edges.isEmpty():
        hooks = stage(edges.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")), "hooks")
        while True:  # two jumps a round: to the hook's hook, and to that one's
            one, two = (hooks.select(F.col("v").alias(f"v{i}"), F.col("p").alias(f"p{i}")) for i in (1, 2))
            far = hooks.join(one, hooks["p"] == one["v1"], "left").join(two, F.col("p1") == two["v2"], "left")
            jumped = stage(far.select("v", F.coalesce("p2", "p1", "p").alias("p"), F.col("p2").isNotNull().alias("more")), "hooks")
            hooks = jumped.select("v", "p")
            if jumped.where("more").isEmpty():
                break
        comps = stage(comps.join(hooks, comps["comp"] == hooks["v"], "left").select("id", F.coalesce("p", "comp").alias("comp")), "components")
        to_a, to_b = (hooks.select(F.col("v").alias(c), F.col("p").alias(f"r{c}")) for c in ("a", "b"))
        drawn = edges.join(to_a, "a", "left").join(to_b, "b", "left").select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
        edges = stage(drawn.where("x <> y").select(*_ordered("x", "y")).distinct(), "edges")
    return comps


def merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` after more links: the links are drawn between components, and only those are joined."""
    to_a, to_b = (comps.select(F.col("id").alias(c), F.col("comp").alias(f"c{c}")) for c in ("a", "b"))
    drawn = links.join(to_a, "a", "left").join(to_b, "b", "left").select(F.coalesce("ca", "a").alias("x"), F.coalesce("cb", "b").alias("y"))
    new = components(drawn.where("x <> y").select(*_ordered("x", "y")))
    known = comps.join(new.select(F.col("id").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"))
    return stage(known.unionByName(new.join(comps.select("id"), "id", "left_anti")), "components")


def joined(docs: DataFrame, candidates: DataFrame, class_of: DataFrame, comps: DataFrame, spec: Spec) -> DataFrame:
    """(id, comp) after all candidates are verified or lie within a component.

    A round tests ``ROUND_PAIRS`` candidates of a larger id at most, the smallest partners first: in
    a large group, one true candidate often connects what the others would have connected too.
    """
    done = None
    while True:
        left = (candidates.join(comps.select(F.col("id").alias("a"), F.col("comp").alias("ca")), "a", "left")
                .join(comps.select(F.col("id").alias("b"), F.col("comp").alias("cb")), "b", "left")
                .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"))
        if done is not None:
            left = left.join(done, ["a", "b"], "left_anti")
        now = stage(left.withColumn("rank", F.row_number().over(Window.partitionBy("b").orderBy("a"))), "candidates")
        top = now.agg(F.max("rank")).first()[0] or 0
        if not top:
            return comps
        got = stage(verify(docs, now.where(F.col("rank") <= ROUND_PAIRS).select("a", "b"), class_of, spec), "tested")
        comps = merged(comps, got.where("ok").select("a", "b"))
        if top <= ROUND_PAIRS:
            return comps
        tested = got.select("a", "b")
        done = tested if done is None else done.unionByName(tested)


def jaccard_components(docs: DataFrame, spec: Spec = Spec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``.

    A null or empty text, or one of white space, has no shingles and links with nothing, not even
    its like. Ids are integers; rows that share an id are one document, and if their texts differ, its
    smallest set (by size, then hash) stands for it. A null id links with nothing and has a null
    component. Extra columns are ignored; an empty table gives an empty result.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sets = stage(set_table(own, spec, common_shingles(own, spec)), "sets")
    real = sets.where("n > 0 and id is not null")
    by_id = real.groupBy("id").agg(F.min(F.struct("n", "s1", "s2")).alias("k")).select("id", "k.*")
    reps = by_id.groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"))
    class_of = stage(by_id.join(reps, ["n", "s1", "s2"]), "classes")
    key = ["id", "n", "s1", "s2"]
    first = class_of.where("id = rep").select(*key)
    distinct = real.join(first, key, "left_semi").dropDuplicates(key)
    x = light_boundary(distinct, spec)
    lists = shared_entries(list_entries(distinct, spec, x))
    prefix = F.col("n") - F.ceil(F.col("n") * spec.num / F.lit(spec.den)) + 1
    lists = stage(lists.withColumn("p", prefix.cast("int")), "lists")
    links = stage(subset_links(lists, spec), "links")
    texts_of = own.where("id is not null")
    bits = real.select(*key, "parity").join(first, key, "left_semi").dropDuplicates(key).select("id", "parity")
    hubs = stage(likely(hub_pairs(lists, spec, x), bits, spec), "likely")
    comps = joined(texts_of, hubs, class_of, components(links), spec)
    rest = stage(likely(cross_pairs(lists, comps, spec, x), bits, spec), "likely")
    comps = joined(texts_of, rest, class_of, comps, spec)
    comp = class_of.join(comps.select(F.col("id").alias("rep"), "comp"), "rep", "left").select(F.col("id").alias("__id"), F.coalesce("comp", "rep").alias("comp"))
    out = sets.select("id", "n").join(comp, F.col("id") == F.col("__id"), "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("comp", "id")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, spec: Spec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, unchanged; rows with a null id stay."""
    keep = jaccard_components(docs, spec, id_col, text_col).where("id = component_id").select(F.col("id").alias("__keep")).distinct()
    return docs.join(keep, docs[id_col].cast("long") == keep["__keep"], "left_semi").unionByName(docs.where(F.col(id_col).isNull()))


def jaccard_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    return jaccard_components(docs.select("doc_id", "text")).withColumnRenamed("id", "doc_id")
