"""Source divergence audit: how far each source's vocabulary is from the other sources of its language.

Method: a minimal acyclic transducer. The terms that enough documents of a language hold are sorted, a
minimal automaton is built over them whose arcs carry outputs, and the outputs along an accepted term
sum to its lexicographic ordinal. Texts are then streamed through it, byte by byte for many terms at
once, and counted by ordinal; ordinals name the terms in all later tables and break ties.

* Terms are counted by document per task before they are shuffled.
* The automaton has two parts. A kept term with more than 1/131072 of all (document, kept term)
  pairs is frequent: fewer than 131072 exist at any size, and their transducer is broadcast, so that
  texts stream through it where they are read. All other terms are counted per task and stream through
  one of many shards; a shard is a transducer of a bounded number of terms, and its task holds
  one shard and one batch at a time. A bit array of fixed size, one bit a hash of a kept term, keeps most words
  that no language keeps from leaving their task; it never decides a count.
* Every source is compared with every other one of its language, as asked for. Tasks hold 512 terms of
  a language for two tiles of 128 sources each and send one sum for a pair of sources.
* A language is a label, a source a label within it; null counts as the empty one. Neither is ever
  gathered: a source that holds a third of all rows is a few counts from each task.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from credere.functions.ranking import global_position
from credere.llm.common import arrow_schema, blocks_of, hot_join, mix, ship_package, stage, texts

FREQUENT = 1 << 17
SHARD_WEIGHT = 1 << 16  # terms of a shard, a long one counting for more
SHARD_PROBES = 1 << 18  # counted terms that stream through a shard, on average
BITS = 1 << 26          # of the filter, whatever the number of terms
PENDING = 1 << 19       # counted terms kept in a task before they leave it
KNOWN = 1 << 21         # counted ordinals kept in a task before they are summed, and leave it if they are many
BLOCK_BYTES = 1 << 20
CHUNK, TILE = 512, 128
SCALE = 1_000_000_000
SMOOTH = 5
LANGS = 256             # symbols from here on stand for languages

#: A-Z to a-z, other bytes of terms to themselves, all else to a space
_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_BYTE = np.frombuffer(bytes(0 if b == 0x20 else b for b in _TERM), np.uint8).astype(np.int64)


# ---------------------------------------------------------------- the transducer

class Transducer:
    """A minimal acyclic automaton over sorted sequences of symbols; arc outputs sum to the ordinal.

    Arcs live in an open hash table (key, target, output), so that many terms step at once.
    State 0 is dead, state 1 the start.
    """

    def __init__(self, key: np.ndarray, target: np.ndarray, output: np.ndarray, final: np.ndarray):
        self.key, self.target, self.output, self.final = key, target, output, final

    @classmethod
    def build(cls, sequences: Iterable[tuple[int, ...]]) -> Transducer:
        """From distinct sequences in ascending order: states that accept the same endings are one."""
        register: dict[tuple, int] = {}
        arcs: list[list[tuple[int, int]]] = [[], []]
        final, words = [0, 0], [0, 0]    # words: sequences accepted from a frozen state
        path = [1]                       # states of the last sequence; the last len(path) - 1 are not frozen
        last: tuple[int, ...] = ()

        def freeze(depth: int) -> None:
            while len(path) > depth + 1:
                state = path.pop()
                like = (final[state], tuple(arcs[state]))
                kept = register.setdefault(like, state)
                if kept == state:
                    words[state] = final[state] + sum(words[t] for _, t in arcs[state])
                else:
                    arcs[state] = []
                symbol, _ = arcs[path[-1]][-1]
                arcs[path[-1]][-1] = (symbol, kept)

        for seq in sequences:
            common = 0
            while common < len(last) and common < len(seq) and last[common] == seq[common]:
                common += 1
            freeze(common)
            for symbol in seq[common:]:
                arcs.append([])
                final.append(0)
                words.append(0)
                arcs[path[-1]].append((symbol, len(arcs) - 1))
                path.append(len(arcs) - 1)
            final[path[-1]] = 1
            last = seq
        freeze(0)
        alive = np.zeros(len(arcs), np.int64)
        alive[[1, *register.values()]] = 1
        number = np.cumsum(alive) * alive
        key, target, output = [], [], []
        for state in np.flatnonzero(alive).tolist():
            before = final[state]
            for symbol, to in arcs[state]:
                key.append((int(number[state]) << 20) | symbol)
                target.append(int(number[to]))
                output.append(before)
                before += words[to]
        ends = np.zeros(int(alive.sum()) + 1, np.int64)
        ends[number[alive == 1]] = np.array(final)[alive == 1]
        return cls(*cls._table(np.array(key, np.int64), np.array(target, np.int64), np.array(output, np.int64)), ends)

    @staticmethod
    def _table(key: np.ndarray, target: np.ndarray, output: np.ndarray) -> tuple[np.ndarray, ...]:
        size = 1 << max(4, (2 * len(key)).bit_length())
        out = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        left, slot = np.arange(len(key)), Transducer._slot(key, size)
        while len(left):
            free = out[0][slot] < 0
            taken, first = np.unique(slot[free], return_index=True)
            own = left[free][first]
            out[0][taken], out[1][taken], out[2][taken] = key[own], target[own], output[own]
            rest = np.ones(len(left), bool)
            rest[np.flatnonzero(free)[first]] = False
            left, slot = left[rest], (slot[rest] + 1) & (size - 1)
        return out

    @staticmethod
    def _slot(key: np.ndarray, size: int) -> np.ndarray:
        return (mix(key.view(np.uint64)) & np.uint64(size - 1)).astype(np.int64)

    def step(self, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next state or 0, output) of each state and symbol."""
        key = (state << 20) | symbol
        slot, size = self._slot(key, len(self.key)), len(self.key)
        found = self.key[slot]
        left = np.flatnonzero((found != key) & (found >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (size - 1)
            found[left] = self.key[slot[left]]
            left = left[(found[left] != key[left]) & (found[left] >= 0)]
        hit = found == key
        return np.where(hit, self.target[slot], 0), np.where(hit, self.output[slot], 0)

    def ordinals(self, first: np.ndarray, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Ordinal of each term, -1 if there is none: its language's symbol ``first``, its bytes flat[start:start + size]."""
        out = np.full(len(start), -1, np.int64)
        live = np.arange(len(start))
        state, total = self.step(np.ones(len(start), np.int64), first)
        at = 0
        while len(live):
            live_on = state > 0
            live, state, total = live[live_on], state[live_on], total[live_on]
            done = size[live] == at
            ended = done & (self.final[state] == 1)
            out[live[ended]] = total[ended]
            live, state, total = live[~done], state[~done], total[~done]
            state, more = self.step(state, flat[start[live] + at])
            total = total + more
            at += 1
        return out


class Vocabulary:
    """A transducer over (language, term) rows in ascending order, and the number each ordinal stands for."""

    def __init__(self, langs: list[str], transducer: Transducer, numbers: np.ndarray):
        self.place = {name: LANGS + i for i, name in enumerate(langs)}
        self.transducer, self.numbers = transducer, numbers

    @classmethod
    def build(cls, lang: list[str], term: list[bytes], numbers: np.ndarray) -> Vocabulary:
        langs = sorted(set(lang), key=str.encode)
        place = {name: LANGS + i for i, name in enumerate(langs)}
        return cls(langs, Transducer.build((place[name], *t) for name, t in zip(lang, term, strict=True)), numbers)

    def packed(self) -> bytes:
        """Everything as one value: lengths, then arrays, then languages."""
        t = self.transducer
        parts = [a.astype(np.int64).tobytes() for a in (t.key, t.target, t.output, t.final, self.numbers)]
        parts += [name.encode() for name in self.place]
        return b"".join([np.array([len(parts), *[len(p) for p in parts]], np.int64).tobytes(), *parts])

    @classmethod
    def unpacked(cls, blob: bytes) -> Vocabulary:
        count = int(np.frombuffer(blob, np.int64, 1)[0])
        ends = 8 * (count + 1) + np.cumsum(np.frombuffer(blob, np.int64, count, 8))
        parts = [blob[a:b] for a, b in zip([8 * (count + 1), *ends[:-1]], ends, strict=True)]
        arrays = [np.frombuffer(p, np.int64) for p in parts[:5]]
        return cls([p.decode() for p in parts[5:]], Transducer(*arrays[:4]), arrays[4])

    def find(self, symbol: np.ndarray, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        found = self.transducer.ordinals(symbol, flat, start, size)
        return np.where(found >= 0, self.numbers[found] if len(self.numbers) else -1, -1)

    def symbols(self, lang: list[str]) -> np.ndarray:
        none = LANGS + len(self.place)
        return np.array([self.place.get(name, none) for name in lang], np.int64)


# ---------------------------------------------------------------- kept terms

def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, docs, ord): the terms that at least ``min_docs`` rows of (lang, text) hold; ``ord`` is their place by language and term."""
    ship_package(docs.sparkSession)
    schema = _schema(lang=T.StringType(), term=T.BinaryType(), n=T.LongType())
    out = arrow_schema(schema)

    def emit(count: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in count], pa.string()), pa.array([k[1] for k in count], pa.binary()), pa.array(list(count.values()), pa.int64())], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_lang: dict[str, Counter] = {}
        size = 0
        for batch in (b for whole in batches for b in blocks_of(whole, "text", BLOCK_BYTES)):
            for name, text in zip(batch.column("lang").to_pylist(), texts(batch.column("text")), strict=True):
                count = by_lang.setdefault(name, Counter())
                size -= len(count)
                count.update(set(text.translate(_TERM).split()))
                size += len(count)
            if size > PENDING:
                for name, count in by_lang.items():
                    yield emit(Counter({(name, t): n for t, n in count.items()}))
                by_lang, size = {}, 0
        for name, count in by_lang.items():
            yield emit(Counter({(name, t): n for t, n in count.items()}))

    held = docs.select("lang", "text").mapInArrow(run, schema).groupBy("lang", "term").agg(F.sum("n").alias("docs")).where(F.col("docs") >= min_docs)
    return stage(global_position(held, [F.col("lang"), F.col("term")], "ord"), "kept_terms")


def _hash(lang: str, term: bytes) -> int:
    """Spark's xxhash64(lang, term), unsigned."""
    return xxhash.xxh64_intdigest(term, xxhash.xxh64_intdigest(lang.encode(), 42))


def kept_bits(kept: DataFrame) -> np.ndarray:
    """The filter: BITS bits in words of 64, which is all that reaches the driver."""
    bit = F.pmod(F.xxhash64("lang", "term"), F.lit(BITS))
    words = kept.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


SHARD = _schema(shard=T.LongType(), built=T.BinaryType())


def _build_shard(table: pa.Table) -> pa.Table:
    table = table.sort_by("ord")
    built = Vocabulary.build(table.column("lang").to_pylist(), table.column("term").to_pylist(), table.column("ord").to_numpy())
    return pa.Table.from_pylist([{"shard": table.column("shard")[0].as_py(), "built": built.packed()}], schema=arrow_schema(SHARD))


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).alias("shard")


# ---------------------------------------------------------------- recounting

def _tokens(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of terms or 0, start, size, text number) of every term."""
    flat = _BYTE[np.frombuffer(b" ".join([*raw, b""]), np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flat != 0, [0]])))
    start, size = edge[::2], edge[1::2] - edge[::2]
    ends = np.cumsum([len(t) + 1 for t in raw])
    return flat, start, size, np.searchsorted(ends, start, "right")


def recount(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, ord, n): occurrences of each kept term in the rows of (lang, source, text), where there are any."""
    size = kept.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum(1 + F.floor(F.octet_length("term") / 64)), F.lit(0)).alias("weight")).first()
    often = kept.where(F.col("docs") * FREQUENT > size["pairs"]).orderBy("ord").toArrow()  # fewer than FREQUENT terms
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.build(often.column("lang").to_pylist(), often.column("term").to_pylist(), often.column("ord").to_numpy()))
    filtered = docs.sparkSession.sparkContext.broadcast(kept_bits(kept))
    schema = _schema(lang=T.StringType(), source=T.StringType(), ord=T.LongType(), term=T.BinaryType(), n=T.LongType())
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Vocabulary = shared.value
        bits = filtered.value
        groups: dict[tuple[str, str], int] = {}
        known: list[tuple[np.ndarray, np.ndarray]] = []    # (group and ordinal, count)
        other: Counter = Counter()                         # (group, term)
        rows = 0

        def told(ordinals: bool = True) -> Iterator[pa.RecordBatch]:
            names = [g[0] for g in groups]
            lang, source = (pa.array([g[i] for g in groups], pa.string()) for i in (0, 1))
            at = np.array([_hash(names[g], t) for g, t in other], np.uint64) & np.uint64(BITS - 1)
            pick = bits[(at >> np.uint64(6)).astype(np.int64)].view(np.uint64) >> (at & np.uint64(63)) & np.uint64(1)
            may = [k for k, one in zip(other, pick.tolist(), strict=True) if one]
            if known and ordinals:
                code, at = np.unique(np.concatenate([k for k, _ in known]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in known]).astype(float)).astype(np.int64)
                own = pa.array(code >> 40)
                yield pa.RecordBatch.from_arrays([lang.take(own), source.take(own), pa.array(code & ((1 << 40) - 1)), pa.nulls(len(code), pa.binary()), pa.array(n)], schema=out)
            if may:
                own = pa.array([k[0] for k in may], pa.int64())
                yield pa.RecordBatch.from_arrays([lang.take(own), source.take(own), pa.nulls(len(may), pa.int64()), pa.array([k[1] for k in may], pa.binary()),
                                                  pa.array([other[k] for k in may], pa.int64())], schema=out)

        for batch in (b for whole in batches for b in blocks_of(whole, "text", BLOCK_BYTES)):
            lang, raw = batch.column("lang").to_pylist(), texts(batch.column("text"))
            group = np.array([groups.setdefault(k, len(groups)) for k in zip(lang, batch.column("source").to_pylist(), strict=True)], np.int64)
            flat, start, length, doc = _tokens(raw)
            found = vocabulary.find(vocabulary.symbols(lang)[doc], flat, start, length)
            hit = found >= 0
            code, n = np.unique((group[doc[hit]] << 40) | found[hit], return_counts=True)
            known.append((code, n))
            whole = flat.astype(np.uint8).tobytes()
            other.update((g, whole[a:a + s]) for g, a, s in zip(group[doc[~hit]].tolist(), start[~hit].tolist(), length[~hit].tolist(), strict=True))
            rows += len(code)
            full = False
            if rows > KNOWN:   # summed in the task first: most groups meet the same terms again
                code, at = np.unique(np.concatenate([k for k, _ in known]), return_inverse=True)
                known = [(code, np.bincount(at, np.concatenate([c for _, c in known]).astype(float)).astype(np.int64))]
                rows = len(code)
                full = rows > KNOWN // 2
            if full or len(groups) > PENDING:
                yield from told()
                groups, known, other, rows = {}, [], Counter(), 0
            elif len(other) > PENDING:
                yield from told(ordinals=False)
                other = Counter()
        yield from told()

    raw = stage(docs.mapInArrow(run, schema), "term_counts")
    shards = max(1, -(-size["weight"] // SHARD_WEIGHT), -(-raw.where("term is not null").count() // SHARD_PROBES))
    index = kept.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(_build_shard, SHARD)
    probes = raw.where("term is not null").select(_shard(shards), "lang", "source", "term", "n")
    none = {"lang": "string", "source": "string", "term": "binary", "n": "long"}
    both = (index.select("shard", F.lit(0).alias("kind"), "built", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
            .unionByName(probes.select("shard", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("built"), *none)))
    dealt = both.repartition("shard").sortWithinPartitions("shard", "kind")
    met = _schema(lang=T.StringType(), source=T.StringType(), ord=T.LongType(), n=T.LongType())
    laid = arrow_schema(met)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, at = None, None
        for batch in batches:
            kind, owner = (batch.column(c).to_numpy() for c in ("kind", "shard"))
            cuts = np.concatenate([[0], np.flatnonzero((np.diff(owner) != 0) | (np.diff(kind) != 0)) + 1, [len(kind)]])
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                if b > a and kind[a] == 0:
                    vocabulary, at = Vocabulary.unpacked(part.column("built")[0].as_py()), owner[a]
                elif b > a and at == owner[a]:
                    term = texts(part.column("term"))
                    length = np.array([len(t) for t in term], np.int64)
                    flat = np.frombuffer(b"".join(term) + b" ", np.uint8).astype(np.int64)
                    found = vocabulary.find(vocabulary.symbols(part.column("lang").to_pylist()), flat, np.cumsum(length) - length, length)
                    hit = np.flatnonzero(found >= 0)
                    take = pa.array(hit)
                    yield pa.RecordBatch.from_arrays([part.column("lang").take(take), part.column("source").take(take), pa.array(found[hit]), part.column("n").take(take)], schema=laid)

    all_counts = dealt.mapInArrow(walk, met).unionByName(raw.where("ord is not null").select("lang", "source", "ord", "n"))
    return stage(all_counts.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n")), "source_terms")


# ---------------------------------------------------------------- divergence

def scaled(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), exactly."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10, 0)) * cast({count} + {SMOOTH} as decimal(20, 0))) div cast({total} + {SMOOTH} * {terms} as decimal(20, 0))")


def long_division(a: np.ndarray, den: np.ndarray) -> np.ndarray:
    """``scaled`` in arrays: 1 + SCALE * a // den, three digits at a time, for ``den`` below 2^53."""
    out, rest = a // den, a % den
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // den, rest % den
    return out + 1


def _pair_sums(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over the kept terms of a chunk for each pair of two tiles of sources.

    ``left``: one row (terms, v, idx_a, n_a, idx_b, n_b) with both tiles' sources; ``right``: (idx, ord, n).
    """
    if not left.num_rows:
        return arrow_schema(PAIR_SUMS).empty_table()
    head = left.to_pylist()[0]
    idx = np.array(sorted(set(head["idx_a"] + head["idx_b"])), np.int64)
    place = dict(zip(head["idx_a"] + head["idx_b"], head["n_a"] + head["n_b"], strict=True))
    den = np.array([place[i] for i in idx.tolist()], np.int64) + SMOOTH * head["v"]
    base = long_division(np.full(len(idx), SMOOTH, np.int64), den)
    terms, row = np.unique(right.column("ord").to_numpy(), return_inverse=True)
    col = np.searchsorted(idx, right.column("idx").to_numpy())
    p = np.repeat(base[:, None], len(terms), axis=1)
    p[col, row] = long_division(right.column("n").to_numpy() + SMOOTH, den[col])
    a, b = np.searchsorted(idx, np.array(sorted(head["idx_a"]))), np.searchsorted(idx, np.array(sorted(head["idx_b"])))
    out = []
    for i in a.tolist():
        own = b[b > i] if key[2].as_py() == key[3].as_py() else b
        value = np.abs(p[own] - p[i]).sum(axis=1) + (head["terms"] - len(terms)) * np.abs(base[own] - base[i])
        out.append((np.full(len(own), idx[i]), idx[own], value))
    i, j, value = (np.concatenate(x) if out else np.empty(0, np.int64) for x in zip(*out, strict=True))
    lang = pa.array([head["lang"]], pa.string()).take(pa.array(np.zeros(len(i), np.int64)))
    return pa.Table.from_arrays([lang, pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(value, pa.int64())], schema=arrow_schema(PAIR_SUMS))


PAIR_SUMS = _schema(lang=T.StringType(), i=T.LongType(), j=T.LongType(), value=T.LongType())


def source_pairs(placed: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, i, j, value): the divergence of sources i < j of a language that keeps terms."""
    of_tile = groups.groupBy("lang", "v", F.floor(F.col("idx") / TILE).alias("tile")).agg(F.collect_list(F.struct("idx", "total")).alias("own"))  # TILE at most
    a = of_tile.select("lang", "v", F.col("tile").alias("ta"), F.col("own.idx").alias("idx_a"), F.col("own.total").alias("n_a"))
    b = of_tile.select("lang", F.col("tile").alias("tb"), F.col("own.idx").alias("idx_b"), F.col("own.total").alias("n_b"))
    tiles = a.join(b, "lang").where("ta <= tb")
    chunks = kept.groupBy("lang", F.floor(F.col("ord") / CHUNK).alias("chunk")).agg(F.count("*").alias("terms"))
    heads = chunks.join(tiles, "lang")  # the work that is asked for: each chunk of terms, for each pair of tiles
    last, tile = F.floor((F.col("sources") - 1) / TILE), F.floor(F.col("idx") / TILE)
    dealt = (placed.select("lang", F.floor(F.col("ord") / CHUNK).alias("chunk"), "idx", "ord", "n", tile.alias("tile"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("with"))
             .select("lang", "chunk", F.least("tile", "with").alias("ta"), F.greatest("tile", "with").alias("tb"), "idx", "ord", "n"))
    keys = ["lang", "chunk", "ta", "tb"]
    sums = heads.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(_pair_sums, PAIR_SUMS)
    return sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source of a language differs.

    Part ``pair``: a row for each other source of the language, farthest first. Part ``term``: the ``top``
    kept terms that the source uses more than its language does. A null text, language or source is
    empty; an empty text has no terms, its group still occurs. Each row is a document, repeated rows
    and ids count as often as they are there; ties go to the smaller source or term by UTF-8 bytes. A
    language that keeps no term has pairs of value 0. A source alone in its language has no pairs.
    Texts of any length are read whole; other columns are ignored; an empty table gives an empty result.
    """
    lang, source, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang_col, source_col, text_col))
    rows = docs.select(lang.alias("lang"), source.alias("source"), text.alias("text"))
    kept = kept_terms(rows, min_docs)
    counts = recount(rows, kept)
    v = kept.groupBy("lang").agg(F.count("*").alias("v"))
    seen = rows.select("lang", "source").groupBy("lang", "source").agg(F.count("*").alias("docs"))
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("held"))
    by_lang = Window.partitionBy("lang")
    groups = stage(seen.join(total, ["lang", "source"], "left").join(v, "lang", "left")
                   .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "held", "v")])
                   .withColumn("idx", F.row_number().over(by_lang.orderBy("source")).cast("long") - 1)
                   .withColumn("sources", F.count("*").over(by_lang)).withColumn("q_total", F.sum("total").over(by_lang)), "source_groups")
    placed = stage(hot_join(counts, groups, ["lang", "source"], "held"), "placed_terms")

    # pairs: both directions, value 0 without kept terms
    sums = source_pairs(placed.where("sources > 1"), groups.where("v > 0 and sources > 1"), kept)
    both = sums.select("lang", "i", "j", "value").unionByName(sums.select("lang", F.col("j").alias("i"), F.col("i").alias("j"), "value"))
    one = groups.select("lang", F.col("idx").alias("i"), "source")
    other = groups.select("lang", F.col("idx").alias("j"), F.col("source").alias("item"))
    none = groups.where("v = 0").select("lang", F.col("idx").alias("i"), "source")
    zero = none.join(other, "lang").where("i <> j").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    pairs = both.join(one, ["lang", "i"]).join(other, ["lang", "j"]).select("lang", "source", "item", "value").unionByName(zero)
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))

    # terms: the language's counts are sums over its sources
    more = (placed.withColumn("q_n", F.sum("n").over(Window.partitionBy("lang", "ord")))
            .select("lang", "source", "ord", (scaled("n", "total", "v") - scaled("q_n", "q_total", "v")).alias("value")).where("value > 0"))
    best = (more.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")))
            .where(F.col("rank") <= top))
    terms = best.join(kept.select("ord", F.col("term").cast("string").alias("item")), "ord")
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.withColumn("part", F.lit("pair")).select(cols).unionByName(terms.withColumn("part", F.lit("term")).select(cols))
