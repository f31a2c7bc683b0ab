"""Conversation prefix trie: which openings conversations share, and what sharing them saves.

Method: the Euler-tour technique. A node of the trie is a distinct opening; its name is the smallest
conversation that starts with it, and its depth. Every node gives an enter and an exit arc, each with its
successor in the tour. The tour is ranked as a linked list: runs of arcs that follow each other
within a batch of nodes (sorted by name and depth, so paths and neighbouring siblings lie together)
become one element; then a random half of the elements absorbs successors of the other half, round by
round, until a bounded number is left; their places are given back in reverse. Ranking carries the
prefix sums of places, leaves and savings, and a subtree is the difference between its two arcs.

* Openings are told apart without gathering a conversation: turns are range-partitioned and sorted, and
  an opening's key is a sum over its turns of their digests times powers of a base, modulo four primes,
  which adds up across partitions. All keys are verified: where two openings of one key end
  in different turns (by SHA-256), the keys are made again with other bases.
* A conversation of any length is spread over many tasks: only sums of the pieces of conversations that
  span partitions (fewer than two a partition) are collected.
* Names with more than 1/4096 of the rows or children meet their row by a broadcast, others by a
  shuffle join. Siblings are ordered by one range-partitioned sort, never within one group.
* Ids of conversations that end at a node are packed in sorted order, 512 at a time, and the packs
  are streamed into its digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.llm.common import arrow_schema, hot_join, map_rows, ship_package, stage, with_fields

BLOCK, HEADS = 20, 4
RANK_ROWS = 4096       # list elements ranked on the driver at the end
PACK = 512
PRIMES = np.array([2147483647, 2147483629, 2147483587, 2147483579], np.uint64)
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- keys of openings

def bases(attempt: int) -> np.ndarray:
    seed = np.frombuffer(hashlib.sha256(b"%d" % attempt).digest(), ">u8").astype(np.uint64)
    return seed % (PRIMES - np.uint64(1000)) + np.uint64(500)


def powers(base: np.ndarray, exponent: np.ndarray) -> np.ndarray:
    """base ** exponent in each lane (len(exponent), 4); a negative exponent is the inverse's."""
    inverse = np.array([pow(int(b), -1, int(p)) for b, p in zip(base, PRIMES, strict=True)], np.uint64)
    square = np.where((exponent < 0)[:, None], inverse[None, :], base[None, :])
    left, out = np.abs(exponent), np.ones((len(exponent), len(PRIMES)), np.uint64)
    while (left > 0).any():
        out = np.where((left & 1 == 1)[:, None], out * square % PRIMES, out)
        square = square * square % PRIMES
        left = left >> 1
    return out


def packed(lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = lanes.astype(np.int64)
    return (x[:, 0] << 31) | x[:, 1], (x[:, 2] << 31) | x[:, 3]


def lanes(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    low = (1 << 31) - 1
    return np.stack([h1 >> 31, h1 & low, h2 >> 31, h2 & low], 1).astype(np.uint64)


def digests(column: pa.Array) -> np.ndarray:
    """The lanes of 32-byte digests."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 4) % PRIMES


LONG = T.LongType()


def _piece_sums(rows: DataFrame, base: np.ndarray) -> DataFrame:
    """(conv, pid, j, h1, h2, digest, words) of sorted rows (conv, pid, digest, words): place and key within the conversation's piece."""
    ship_package(rows.sparkSession)
    schema = T.StructType([T.StructField(c, LONG) for c in ("conv", "pid", "j", "h1", "h2")] + [T.StructField("digest", T.BinaryType()), T.StructField("words", LONG)])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, count, total = None, 0, np.zeros(4, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            fresh = np.concatenate([[last is None or conv[0] != last], conv[1:] != conv[:-1]])
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(conv)), 0))
            carried = np.cumsum(fresh) == 0  # rows that go on from the batch before
            j = np.arange(len(conv)) - first + np.where(carried, count, 0)
            term = digests(batch.column("digest")) * powers(base, j) % PRIMES
            run_sum = np.cumsum(term, axis=0)  # below 2^31 times the rows of a batch
            before = np.where((first > 0)[:, None], run_sum[np.maximum(first - 1, 0)], 0)
            key = (run_sum - before + np.where(carried[:, None], total, np.uint64(0))) % PRIMES
            last, count, total = conv[-1], int(j[-1]) + 1, key[-1]
            h1, h2 = packed(key)
            yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("pid"), pa.array(j), pa.array(h1), pa.array(h2), batch.column("digest"), batch.column("words")], schema=out)

    return rows.mapInArrow(run, schema)


def turn_keys(said: DataFrame, base: np.ndarray) -> DataFrame:
    """(conv, j, h1, h2, digest, words) of (conv, turn, role, text): each turn's place and the key of its conversation up to it."""
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    ordered = said.orderBy("conv", F.col("turn").asc_nulls_first(), "role", "text")
    rows = ordered.select("conv", F.spark_partition_id().cast("long").alias("pid"), digest.alias("digest"),
                          F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    at = stage(_piece_sums(rows, base), "turn_pieces")
    piece = at.groupBy("conv", "pid").agg(F.max("j").alias("last"), F.max_by(F.struct("h1", "h2"), "j").alias("key"))
    spans = piece.groupBy("conv").agg(F.count("*").alias("pieces"), F.collect_list(F.struct("pid", "last", "key.h1", "key.h2")).alias("own")).where("pieces > 1").collect()
    skip: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in spans:  # each holds all rows between two partition bounds: fewer than the partitions
        n, total = 0, np.zeros(4, np.uint64)
        for p in sorted(r["own"]):
            skip[r["conv"], p["pid"]] = n, total.tolist()
            own = lanes(np.array([p["h1"]]), np.array([p["h2"]]))[0]
            total = (total + own * powers(base, np.array([n]))[0]) % PRIMES
            n += p["last"] + 1
    shared = said.sparkSession.sparkContext.broadcast(skip)
    schema = with_fields(at.drop("pid"))

    def fix(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        cols = {c: batch.column(c) for c in batch.schema.names}
        if shared.value:
            conv, pid, j, h1, h2 = (batch.column(c).to_numpy().copy() for c in ("conv", "pid", "j", "h1", "h2"))
            for (c, p), (n, total) in shared.value.items():
                own = np.flatnonzero((conv == c) & (pid == p))
                if n and len(own):
                    key = (lanes(h1[own], h2[own]) * powers(base, np.array([n])) + np.array(total, np.uint64)) % PRIMES
                    h1[own], h2[own] = packed(key)
                    j[own] += n
            cols |= {"j": pa.array(j), "h1": pa.array(h1), "h2": pa.array(h2)}
        return pa.RecordBatch.from_arrays([cols[f.name] for f in out], schema=out)

    return stage(map_rows(at, schema, fix), "turn_keys")


def rebuilt(placed: DataFrame, base: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """((conv, size), (conv, depth, h1, h2, digest, words)): each conversation's turns after its opening is that of its block."""
    few = F.when(F.col("j") < HEADS - 1, F.struct("j", "h1", "h2", "digest", "words"))
    info = stage(placed.groupBy("conv").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(few)).alias("first")), "conversations")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    head = info.select(F.col("conv").alias("block"), F.col("first").alias("lead"))
    own_block = info.withColumn("block", F.col("conv") - F.col("conv") % BLOCK).withColumn("h", h)
    plan = (own_block.join(head, "block", "left").withColumn("lead", F.slice(F.coalesce("lead", F.array().cast(info.schema["first"].dataType)), F.lit(1), F.col("h")))
            .withColumn("lead_n", F.size("lead")))

    def key(turns: str, n: str) -> Column:  # of the first n turns, if there are so many
        return F.when((F.col(n) > 0) & (F.size(turns) >= F.col(n)), F.struct(F.get(turns, F.col(n) - 1)["h1"].alias("h1"), F.get(turns, F.col(n) - 1)["h2"].alias("h2")))

    plan = stage(plan.select("conv", "n", "h", "lead_n", "lead", key("lead", "lead_n").alias("lead_key"), key("first", "h").alias("cut_key"),
                             (F.col("lead_n") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("size")), "rebuilt")
    leads = plan.select("conv", F.posexplode("lead").alias("at", "t")).select("conv", (F.col("at") + 1).cast("long").alias("depth"), "t.h1", "t.h2", "t.digest", "t.words")
    own = hot_join(placed, plan.select("conv", "n", "h", "lead_n", *[F.coalesce(F.col(f"{k}_key.{x}"), F.lit(0)).alias(f"{k}_{x}") for k in ("lead", "cut") for x in ("h1", "h2")]),
                   ["conv"], "n").where("j >= h")
    schema = leads.schema

    def move(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        c = {n: batch.column(n).to_numpy() for n in ("j", "h", "lead_n", "h1", "h2", "lead_h1", "lead_h2", "cut_h1", "cut_h2")}
        tail = (lanes(c["h1"], c["h2"]) + PRIMES - lanes(c["cut_h1"], c["cut_h2"])) % PRIMES
        shift = c["lead_n"].astype(np.int64) - c["h"]
        h1, h2 = packed((lanes(c["lead_h1"], c["lead_h2"]) + tail * powers(base, shift)) % PRIMES)
        return pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(c["j"] + shift + 1), pa.array(h1), pa.array(h2), batch.column("digest"), batch.column("words")], schema=out)

    return plan.select("conv", F.col("size").cast("long").alias("size")), leads.unionByName(map_rows(own, schema, move))


def openings(said: DataFrame, attempts: int = 8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, members, nodes): (conv, size); (conv, depth, h1, h2); (depth, h1, h2, p1, p2, conv_id, n_convs, words) without the root."""
    for attempt in range(attempts):
        base = bases(attempt)
        sizes, rows = rebuilt(turn_keys(said, base), base)
        members = stage(rows, "openings")
        nodes = stage(members.groupBy("depth", "h1", "h2").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"),
                                                              F.min("digest").alias("digest"), F.max("digest").alias("other")), "opening_nodes")
        if nodes.where("digest <> other").isEmpty():
            break
    else:
        raise RuntimeError("openings could not be told apart")
    schema = T.StructType([T.StructField(c, LONG) for c in ("depth", "h1", "h2", "p1", "p2", "conv_id", "n_convs", "words")])

    def parent(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        """The key without its last turn."""
        depth, h1, h2 = (batch.column(c).to_numpy() for c in ("depth", "h1", "h2"))
        term = digests(batch.column("digest")) * powers(base, depth - 1) % PRIMES
        p1, p2 = packed((lanes(h1, h2) + PRIMES - term) % PRIMES)
        cols = {c: batch.column(c) for c in batch.schema.names} | {"p1": pa.array(p1), "p2": pa.array(p2)}
        return pa.RecordBatch.from_arrays([cols[f.name] for f in out], schema=out)

    return sizes, members.select("conv", "depth", "h1", "h2"), map_rows(nodes.drop("other"), schema, parent)


# ---------------------------------------------------------------- list ranking

ARC = T.StructType([T.StructField("conv", LONG), T.StructField("depth", LONG), T.StructField("kind", LONG)])  # kind 0 enters, 1 leaves
SUMS = ("n", "leaves", "saved")
ELEMENT = T.StructType([T.StructField("id", ARC), T.StructField("next", ARC), *[T.StructField(c, LONG) for c in SUMS]])


def arc(conv: str | Column, depth: str | Column, kind: int) -> Column:
    return F.struct(F.col(conv).alias("conv") if isinstance(conv, str) else conv.alias("conv"),
                    F.col(depth).alias("depth") if isinstance(depth, str) else depth.alias("depth"), F.lit(kind).cast("long").alias("kind"))


def runs_of(tour: DataFrame) -> DataFrame:
    """The rows of (conv_id, depth, leaf, saved, after_enter, after_exit) with, for each arc, the run that holds it.

    ``heads`` lists the runs that begin at the row's arcs as list elements; ``enter`` and ``exit`` name
    each arc's run and what lies before it there. A run stays within one Arrow batch.
    """
    place = T.StructType([T.StructField("run", ARC), *[T.StructField(c, LONG) for c in SUMS]])
    schema = T.StructType([tour.schema["conv_id"], tour.schema["depth"], T.StructField("enter", place), T.StructField("exit", place), T.StructField("heads", T.ArrayType(ELEMENT))])

    def contract(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        conv, depth = batch.column("conv_id").to_pylist(), batch.column("depth").to_pylist()
        where = {k: i for i, k in enumerate(zip(conv, depth, strict=True))}
        weight: list[tuple[int, int, int]] = []
        follow, target = [], []
        for leaf, saved, e, x in zip(*(batch.column(c).to_pylist() for c in ("leaf", "saved", "after_enter", "after_exit")), strict=True):
            weight += [(1, leaf, saved), (1, 0, 0)]
            for nxt in (e, x):
                to = None if nxt is None else where.get((nxt["conv"], nxt["depth"]))
                follow.append(nxt)
                target.append(-1 if to is None else 2 * to + nxt["kind"])
        name = [{"conv": c, "depth": d, "kind": k} for c, d in zip(conv, depth, strict=True) for k in (0, 1)]
        led = [True] * len(name)
        for t in target:
            if t >= 0:
                led[t] = False
        at: list[dict] = [{}] * len(name)
        heads: list[list[dict]] = [[] for _ in conv]
        for head in (i for i, first in enumerate(led) if first):
            n = leaves = saved = 0
            i = head
            while True:
                at[i] = {"run": name[head], "n": n, "leaves": leaves, "saved": saved}
                n, leaves, saved = n + weight[i][0], leaves + weight[i][1], saved + weight[i][2]
                if target[i] < 0:
                    break
                i = target[i]
            heads[head // 2].append({"id": name[head], "next": follow[i], "n": n, "leaves": leaves, "saved": saved})
        return pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("depth"), pa.array(at[::2], out.field("enter").type), pa.array(at[1::2], out.field("exit").type),
                                           pa.array(heads, out.field("heads").type)], schema=out)

    return map_rows(tour, schema, contract)


def rank(elements: DataFrame, few: int = RANK_ROWS) -> DataFrame:
    """(id, n, leaves, saved): the sums over all elements before each one of a single linked list.

    Each round, an element with coin 0 absorbs a successor with coin 1: a quarter of them goes.
    """
    spark, taken, turn = elements.sparkSession, [], 0
    left = elements.count()
    while left > few:
        coin = F.pmod(F.xxhash64("id.conv", "id.depth", "id.kind", F.lit(turn)), F.lit(2))
        a = elements.where(coin == 0).select(*[F.col(c).alias(f"a_{c}") for c in ELEMENT.names])
        b = elements.where(coin == 1).select(*[F.col(c).alias(f"b_{c}") for c in ELEMENT.names])
        met = stage(a.join(b, F.col("a_next") == F.col("b_id"), "full"), "absorbed")
        both = F.col("a_id").isNotNull() & F.col("b_id").isNotNull()
        elements = met.select(F.coalesce("a_id", "b_id").alias("id"), F.when(F.col("b_id").isNotNull(), F.col("b_next")).otherwise(F.col("a_next")).alias("next"),
                              *[(F.coalesce(f"a_{c}", F.lit(0)) + F.coalesce(f"b_{c}", F.lit(0))).alias(c) for c in SUMS])
        taken.append(met.where(both).select(F.col("b_id").alias("id"), F.col("a_id").alias("into"), *[F.col(f"a_{c}").alias(f"by_{c}") for c in SUMS]))
        left = elements.count()
        turn += 1
    rows = {tuple(r["id"]): r for r in elements.collect()}  # at most ``few``
    followed = {tuple(r["next"]) for r in rows.values() if r["next"]}
    out, total = [], (0, 0, 0)
    at = next((k for k in rows if k not in followed), None)
    while at is not None:
        r = rows[at]
        out.append((at, *total))
        total = tuple(t + r[c] for t, c in zip(total, SUMS, strict=True))
        at = tuple(r["next"]) if r["next"] else None
    ranked = spark.createDataFrame(out, T.StructType([T.StructField("id", ARC), *[T.StructField(c, LONG) for c in SUMS]]))
    for t in reversed(taken):
        own = t.join(ranked.withColumnRenamed("id", "into"), "into").select("id", *[(F.col(c) + F.col(f"by_{c}")).alias(c) for c in SUMS])
        ranked = stage(ranked.unionByName(own), "ranks")
    return ranked


# ---------------------------------------------------------------- the trie

def next_siblings(tree: DataFrame) -> DataFrame:
    """(conv_id, depth, sibling): the next child of the same parent by name, null for the last."""
    kept = stage(tree.where("depth > 0").select("parent", "depth", "conv_id").orderBy("parent", "depth", "conv_id")
                 .select("*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("mid")), "siblings")
    here = F.struct("parent", "depth", "conv_id")
    after = Window.orderBy("pid")
    first = kept.groupBy("pid").agg(F.min_by(here, "mid").alias("head")).withColumn("later", F.lead("head").over(after)).select("pid", "later")  # a row a partition
    along = kept.withColumn("next", F.lead(here).over(Window.partitionBy("pid").orderBy("mid"))).join(F.broadcast(first), "pid")
    nxt = F.coalesce("next", "later")
    return along.select("conv_id", "depth", F.when((nxt["parent"] == F.col("parent")) & (nxt["depth"] == F.col("depth")), nxt["conv_id"]).alias("sibling"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """(depth, h1, h2, ends_sha256) over the rows of (depth, h1, h2, conv)."""
    ship_package(ends.sparkSession)
    keys = ["depth", "h1", "h2"]
    pack_schema = T.StructType([*[T.StructField(c, LONG) for c in keys], T.StructField("first", LONG), T.StructField("ids", T.BinaryType())])

    def pack(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        cols = [batch.column(c).to_numpy() for c in keys]
        conv = batch.column("conv").to_numpy()
        new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in cols], axis=0)]) if len(conv) else np.empty(0, bool)
        first = np.maximum.accumulate(np.where(new, np.arange(len(conv)), 0))
        cut = np.flatnonzero((np.arange(len(conv)) - first) % PACK == 0)
        text = [b"%d" % c for c in conv.tolist()]
        ids = [b",".join(text[a:b]) for a, b in zip(cut, [*cut[1:], len(conv)], strict=True)]
        return pa.RecordBatch.from_arrays([*[pa.array(c[cut]) for c in cols], pa.array(conv[cut]), pa.array(ids, pa.binary())], schema=out)

    packs = map_rows(ends.select(*keys, "conv").orderBy(*keys, "conv"), pack_schema, pack)
    dealt = packs.repartition(*keys).sortWithinPartitions(*keys, "first")
    schema = T.StructType([*[T.StructField(c, LONG) for c in keys], T.StructField("ends_sha256", T.StringType())])
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for batch in batches:
            done = []
            for key, ids in zip(zip(*(batch.column(c).to_pylist() for c in keys), strict=True), batch.column("ids").to_pylist(), strict=True):
                if key == last:
                    sha.update(b",")
                else:
                    if last is not None:
                        done.append((*last, sha.hexdigest()))
                    last, sha = key, hashlib.sha256()
                sha.update(ids)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, d, strict=True)) for d in done], schema=out)
        if last is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*last, sha.hexdigest()), strict=True))], schema=out)

    return dealt.mapInArrow(run, schema)


def trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", few: int = RANK_ROWS) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, enter, exit): a row a node.

    Turns go by number (null first), then role, then text; each row is a turn, repeated rows too. A null role or text is empty.
    Rows without a conversation id belong to none and are left out. The first h = crc32(id) mod 4
    turns of a conversation are taken from the conversation that begins its block of 20, all if that has fewer, none
    if it is absent; conversations without turns left end at the root. ``enter`` and ``exit`` are the
    node's places in the tour. Other columns are ignored; texts of any length are read whole.
    An empty table has no root and gives an empty result.
    """
    said = turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    sizes, members, nodes = openings(said)
    zero = F.lit(0).cast("long")
    root = (sizes.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
            .select(*[zero.alias(c) for c in ("depth", "h1", "h2")], F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), "conv_id", "n_convs", zero.alias("words")))
    kids = (nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"))
            .agg(F.count("*").alias("n_children"), F.min("conv_id").alias("first_child")))
    every = stage(nodes.unionByName(root).join(kids, ["depth", "h1", "h2"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie_nodes")
    parents = every.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent"), F.col("n_children").alias("kin"))
    child = hot_join(every.where("depth > 0"), parents, ["depth", "p1", "p2"], "kin").drop("kin")
    tree = stage(child.unionByName(every.where("depth = 0").withColumn("parent", F.lit(None).cast("long"))), "trie")

    sibling = next_siblings(tree)
    leaf = F.col("n_children") == 0
    tour = (tree.join(sibling, ["conv_id", "depth"], "left")
            .select("conv_id", "depth", leaf.cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                    F.when(leaf, arc("conv_id", "depth", 1)).otherwise(arc("first_child", F.col("depth") + 1, 0)).alias("after_enter"),
                    F.when(F.col("sibling").isNotNull(), arc("sibling", "depth", 0)).when(F.col("depth") > 0, arc("parent", F.col("depth") - 1, 1)).alias("after_exit")))
    runs = stage(runs_of(tour.repartitionByRange("conv_id", "depth").sortWithinPartitions("conv_id", "depth")), "tour_runs")
    ranks = stage(rank(runs.select(F.explode("heads").alias("e")).select("e.*"), few), "tour_ranks")
    placed = runs.select("conv_id", "depth", "enter", "exit")
    for side in ("enter", "exit"):
        placed = placed.join(ranks.select(F.col("id").alias(f"{side}_run"), *[F.col(c).alias(f"{side}_{c}") for c in SUMS]), F.col(f"{side}.run") == F.col(f"{side}_run")).drop(f"{side}_run")
    at = {s: {c: F.col(f"{s}.{c}") + F.col(f"{s}_{c}") for c in SUMS} for s in ("enter", "exit")}
    sums = placed.select("conv_id", "depth", at["enter"]["n"].alias("enter"), at["exit"]["n"].alias("exit"),
                         (at["exit"]["leaves"] - at["enter"]["leaves"]).alias("n_leaves"), (at["exit"]["saved"] - at["enter"]["saved"]).alias("saved_tokens"))
    last = members.join(sizes.withColumnRenamed("size", "depth"), ["conv", "depth"], "left_semi")
    at_root = sizes.where("size = 0").select("conv", *[zero.alias(c) for c in ("depth", "h1", "h2")])
    ends = ends_digest(last.select("depth", "h1", "h2", "conv").unionByName(at_root.select("depth", "h1", "h2", "conv")))
    return (tree.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "h1", "h2")
            .join(sums, ["conv_id", "depth"]).join(ends, ["depth", "h1", "h2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), "enter", "exit"))
