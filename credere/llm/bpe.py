"""BPE encoding and decoding with a public vocabulary file.

Method: the symbols of a word are the leaves' owners of a segment tree; leaf i holds the rank of
the pair (symbol i, next symbol), every inner node the smaller of its children. The root therefore
yields the leftmost pair of lowest rank. A merge changes three leaves at most, each updated on its
path to the root, until the root holds no rank: O(n log n) for a word of n symbols.

White space never joins a word, so a text is a row of independent chunks and a chunk's ids are
kept in a bounded cache of the Python worker. The table is never shuffled.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from credere.llm.common import extend, map_rows, with_fields

NO_RANK = 1 << 62
CACHE = 200_000
LONGEST_KEPT = 64
WIDEST = 64
BLOCK = 4096
TEXT_BYTES = 1 << 20  # texts cut into chunks at a time

# Fixed values of the vocabulary file's format: the white space of its normaliser (Unicode White_Space).
WHITE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")  # str.split takes these for white space, the normaliser does not


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class MinTree:
    """Segment tree over pair ranks; ``root()`` is (rank, leaf) of the leftmost lowest rank."""

    def __init__(self, ranks: list[int]):
        self.width = 1 << max(0, (len(ranks) - 1).bit_length())
        pad = [NO_RANK] * (self.width - len(ranks))
        # a node holds rank * width + leaf, so that the smaller number is the lower rank, then the leftmost leaf
        leaves = [r * self.width + i if r < NO_RANK else NO_RANK for i, r in enumerate(ranks)] + pad
        self.nodes = nodes = [NO_RANK] * self.width + leaves
        for i in range(self.width - 1, 0, -1):
            a, b = nodes[2 * i], nodes[2 * i + 1]
            nodes[i] = a if a < b else b

    def root(self) -> int:
        """The leaf of the leftmost lowest rank, -1 if no leaf has a rank."""
        top = self.nodes[1]
        return -1 if top == NO_RANK else top % self.width

    def put(self, leaf: int, rank: int) -> None:
        nodes, i = self.nodes, leaf + self.width
        value = rank * self.width + leaf if rank < NO_RANK else NO_RANK
        nodes[i] = value
        while i > 1:
            other = nodes[i ^ 1]
            i >>= 1
            best = value if value < other else other
            if nodes[i] == best:
                return
            nodes[i] = value = best


class Bpe:
    """Encoder and decoder of a word-level BPE file (``end_of_word_suffix``, byte-level letters).

    Normal forms and word boundaries are read with the tokenizers library's own normaliser and
    splitter, whose Unicode tables the file assumes; plain ASCII takes a short way to the same words.
    The merges are made here.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in (self.vocab | self.special).items()}
        self.tokens = [names.get(i, "") for i in range(max(names) + 1)]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self.merged = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        keys = np.array([self.vocab[a] << 32 | self.vocab[b] for a, b in merges], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        letters = byte_letters()
        self.inner = np.array([self.vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([self.vocab[letters[b] + (model["end_of_word_suffix"] or "")] for b in range(256)], np.int64)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.ascii_words = regex.compile(split)
        self.splitter = pre_tokenizers.Split(Regex(split), "removed", invert=True)
        self.normaliser = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.chunks = regex.compile(f"[^{WHITE}]+")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # ------------------------------------------------ merges

    def merge(self, ids: list[int]) -> list[int]:
        """All merges of one word's symbols, leftmost lowest rank first."""
        n = len(ids)
        pairs, none = self.pairs, (NO_RANK, 0)
        tree = MinTree([pairs.get((ids[i], ids[i + 1]), none)[0] for i in range(n - 1)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (i := tree.root()) >= 0:
            j = after[i]
            ids[i] = pairs[ids[i], ids[j]][1]
            ids[j] = -1
            k = after[i] = after[j]
            if j < n - 1:
                tree.put(j, NO_RANK)
            if k < n:
                before[k] = i
            tree.put(i, pairs.get((ids[i], ids[k]), none)[0] if k < n else NO_RANK)
            h = before[i]
            if h >= 0:
                tree.put(h, pairs.get((ids[h], ids[i]), none)[0])
        return [x for x in ids if x >= 0]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; NO_RANK if it does not merge (a symbol under 0 is none)."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (right >= 0) & (left >= 0), self.order[at], NO_RANK)

    def merge_many(self, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """``merge`` for many words at once: row w of ``ids`` holds the n[w] symbols of a word, then
        -1, and has its own tree; each round takes every tree's root and updates the changed paths."""
        words, m = ids.shape[0], ids.shape[1] - 1
        spread = np.arange(m)
        ranks = self.ranks(ids[:, :-1], ids[:, 1:])
        nodes = np.full((words, 2 * m), NO_RANK, np.int64)
        nodes[:, m:] = np.where(ranks < NO_RANK, ranks * m + spread, NO_RANK)
        width = m
        while width > 1:
            nodes[:, width // 2:width] = np.minimum(nodes[:, width:2 * width:2], nodes[:, width + 1:2 * width:2])
            width //= 2
        after = np.tile(np.arange(1, m + 2), (words, 1))
        before = np.tile(np.arange(-1, m), (words, 1))
        flat = nodes.reshape(-1)

        def put(rows: np.ndarray, leaf: np.ndarray, rank: np.ndarray | int) -> None:
            base, node = rows * (2 * m), leaf + m
            flat[base + node] = np.where(rank < NO_RANK, rank * m + leaf, NO_RANK)
            for _ in range(m.bit_length() - 1):
                node = node >> 1
                flat[base + node] = np.minimum(flat[base + 2 * node], flat[base + 2 * node + 1])

        live = np.flatnonzero(nodes[:, 1] < NO_RANK)
        while len(live):
            top = nodes[live, 1]
            i = top % m
            j = after[live, i]
            k = after[live, j]
            own = self.merged[top // m]
            ids[live, i], ids[live, j], after[live, i] = own, -1, k
            more = k < n[live]
            before[live[more], k[more]] = i[more]
            inner = j < m
            put(live[inner], j[inner], np.full(int(inner.sum()), NO_RANK))
            put(live, i, np.where(more, self.ranks(own, ids[live, np.minimum(k, m)]), NO_RANK))
            h = before[live, i]
            some = h >= 0
            put(live[some], h[some], self.ranks(ids[live[some], h[some]], own[some]))
            live = live[nodes[live, 1] < NO_RANK]
        return ids

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word (one element of the splitter's result, not empty)."""
        raw = [w.encode() for w in words]
        n = np.array([len(w) for w in raw], np.int64)
        out: list[list[int]] = [[]] * len(words)
        width = 2
        while width <= WIDEST:
            # rows of width + 1 symbols have width pairs
            rows = np.flatnonzero((n <= width + 1) & ((n > width // 2 + 1) | (width == 2)))
            for at in range(0, len(rows), BLOCK):
                part = rows[at:at + BLOCK]
                size = n[part]
                ids = np.full((len(part), width + 1), -1, np.int64)
                filled = np.arange(width + 1) < size[:, None]
                ids[filled] = self.inner[np.frombuffer(b"".join([raw[w] for w in part]), np.uint8)]
                ids[np.arange(len(part)), size - 1] = self.last[[raw[w][-1] for w in part]]
                for w, row in zip(part, self.merge_many(ids, size).tolist(), strict=True):
                    out[w] = [x for x in row if x >= 0]
            width *= 2
        for w in np.flatnonzero(n > WIDEST + 1):
            out[w] = self.merge([*self.inner[list(raw[w][:-1])].tolist(), int(self.last[raw[w][-1]])])
        return out

    # ------------------------------------------------ texts

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space: the file names no decoder."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def split(self, chunk: str) -> list[str]:
        """The words of a run without white space."""
        if chunk.isascii():
            return self.ascii_words.findall(chunk.lower())
        return [w for w, _ in self.splitter.pre_tokenize_str(self.normaliser.normalize_str(chunk))]

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Ids of each of the distinct ``chunks``; the short ones are kept for later texts."""
        split = [self.split(c) for c in chunks]
        words = list({w for ws in split for w in ws})
        ids = dict(zip(words, self.encode_words(words), strict=True))
        out = {}
        for c, ws in zip(chunks, split, strict=True):
            out[c] = found = np.array([i for w in ws for i in ids[w]], "<u4").tobytes()
            if len(c) <= LONGEST_KEPT:
                self.young[c] = found
        return out

    def pieces(self, text: str) -> list[str]:
        """Chunks and special tokens in the order of the text."""
        parts = self.specials.split(text) if "<" in text else [text]
        out: list[str] = []
        for p in parts:
            if p in self.special:
                out.append(p)
            else:  # str.split() takes a few control characters for white space that the normaliser does not
                out += self.chunks.findall(p) if any(c in p for c in SEPARATORS) else p.split()
        return out

    def encode_batch(self, batch: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers."""
        split = [self.pieces(t) for t in batch]
        if len(self.young) >= CACHE:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        missing = {c for t in split for c in t if c not in young}
        for c in [c for c in missing if c in old]:
            young[c] = old[c]
            missing.discard(c)
        fresh = {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        fresh |= self.learn([c for c in missing if c not in self.special])
        return [b"".join([fresh[c] if (x := young.get(c)) is None else x for c in t]) for t in split]


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def _coded(batch: pa.RecordBatch, path: str, text_col: str) -> tuple[Bpe, list[bytes]]:
    bpe = load(path)
    return bpe, bpe.encode_batch([t or "" for t in batch.column(text_col).to_pylist()])


def _sha256(values: Iterable[bytes]) -> list[str]:
    return [hashlib.sha256(v).hexdigest() for v in values]


def bpe_round_trip(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (little-endian uint32, binary), ``n_tokens`` and ``decoded``.

    A null or empty text has no ids and decodes to the empty text. Columns of these names are
    replaced. Repeated rows are encoded alike; every other column passes through. Texts are taken
    in blocks of bounded bytes, so memory follows the longest text, not the batch.
    """
    schema = with_fields(docs, ("ids", T.BinaryType()), ("n_tokens", T.LongType()), ("decoded", T.StringType()))

    def run(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        bpe, ids = _coded(batch, path, text_col)
        return extend(batch, out, ids=ids, n_tokens=[len(x) // 4 for x in ids], decoded=[bpe.decode(x) for x in ids])

    return map_rows(docs, schema, run, text_col, TEXT_BYTES)


def bpe_encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``decoded_sha256``, the digest of the decoded text: as
    ``bpe_round_trip``, but the decoded text stays in its task."""
    schema = with_fields(docs, ("ids", T.BinaryType()), ("n_tokens", T.LongType()), ("decoded_sha256", T.StringType()))

    def run(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        bpe, ids = _coded(batch, path, text_col)
        return extend(batch, out, ids=ids, n_tokens=[len(x) // 4 for x in ids], decoded_sha256=_sha256(bpe.decode(x).encode() for x in ids))

    return map_rows(docs, schema, run, text_col, TEXT_BYTES)


def bpe_report(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests are taken where the ids are made, so
    neither ids nor decoded texts leave their task."""
    docs = docs.select("doc_id", "text")
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batch: pa.RecordBatch, out: pa.Schema) -> pa.RecordBatch:
        bpe, ids = _coded(batch, path, "text")
        return extend(batch, out, n_tokens=[len(x) // 4 for x in ids], ids_sha256=_sha256(ids), decoded_sha256=_sha256(bpe.decode(x).encode() for x in ids))

    return map_rows(docs, schema, run, "text", TEXT_BYTES)
