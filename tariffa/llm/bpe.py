"""Byte-level BPE by longest matches and backtracking.

The bytes of a piece are read as Latin-1 characters, so that an Aho-Corasick automaton over the vocabulary (whose trie
gives all tokens that start at a place) can walk them. Encoding takes the longest token at each place and backs up when
two neighbours could not stand side by side: the merges of their joined bytes would not leave exactly these two. That
test depends on the two tokens alone and is memoised; it undoes the merges of the two, the last one first, and looks for
one across their border that would have come before. A sequence whose neighbours are all compatible is the one that
the merges give, so the result is exact, and a place is reached by one sequence at the most; places that turned out to
be dead ends are remembered, so each is tried once per token length.

Nulls and empty texts have no tokens and decode to no bytes; equal rows give equal results; an empty table gives an
empty one; other columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import weakref
from collections.abc import Iterable, Iterator
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tariffa.llm.common import slices, spread, table, trimmed

#: Entries of the memos of a Python worker. A full memo of words becomes the older half, and what is used again moves up; one of pairs is emptied.
WORD_MEMO, PAIR_MEMO = 100_000, 250_000
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to rank; a file of this machine, or else any that Spark reads."""
    data = open(path, "rb").read() if os.path.exists(path) else bytes(spark.read.format("binaryFile").load(path).first().content)
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}


class ByteBPE:
    """Encoder and decoder for one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.rank = {t.decode("latin-1"): r for t, r in ranks.items()}
        self.tokens = {r: t for t, r in ranks.items()}
        self.text = {r: t for t, r in self.rank.items()}
        self.lengths = {r: len(t) for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = _Memo(weakref.proxy(self))  # no cycle, so that all of it goes at once
        self.halves: dict[int, tuple[int, int]] = {}  # what a token's last merge joins; of a byte itself twice
        self.automaton = ahocorasick.Automaton()
        for t, r in sorted(self.rank.items(), key=lambda x: (len(x[0]) == 1, x[1])):  # a node's edges are tried in the order they came in: the common ones first
            parts = self.merge(t, 2)
            if len(parts) <= 2:  # a token that no merges make stands for its whole piece only
                self.halves[r] = self.rank.get(parts[0], -1), self.rank.get(parts[-1], -1)
                self.automaton.add_word(t, (r, len(t)))
        self.automaton.make_automaton()
        self.joined = {x: r for r, x in self.halves.items() if self.lengths[r] > 1}
        self.ordered = all(0 <= min(x) <= max(x) < r for x, r in self.joined.items())  # no part is missing or ranks after its whole
        values, starts = self.automaton.get, ((r, t[:k]) for t, r in self.rank.items() for k in range(1, len(t)))
        self.shorter: dict[int, tuple[int, int]] = {r: found for r, x in starts if (found := values(x, None))}  # the longest other token that starts a token

    def merge(self, text: str, least: int = 1) -> list[str]:
        """The merges themselves, lowest rank first, leftmost among equals, down to so many parts; for the few bytes of one or two tokens."""
        parts, rank = list(text), self.rank
        while len(parts) > least:
            best, at = min((rank.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay(self, a: int, b: int) -> bool:
        """Whether the merges of the joined bytes of two tokens leave these two."""
        if not self.ordered:  # undoing goes by rank
            return self.merge(self.text[a] + self.text[b]) == [self.text[a], self.text[b]]
        joined, halves, limit = self.joined.get, self.halves, 1 << 60
        while joined((a, b), limit) >= limit:
            left, right = halves[a][1], halves[b][0]
            if left != a and (a > b or right == b):  # the later one is undone, of equals the right one; a byte can't be
                limit, a = a, left
            elif right != b:
                limit, b = b + 1, right
            else:
                return True
        return False

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIR_MEMO:
                self.pairs.clear()
            known = self.pairs[a, b] = self.stay(a, b)
        return known

    def encode_bytes(self, piece: bytes) -> list[int]:
        text = piece.decode("latin-1")
        whole = self.rank.get(text)
        if whole is not None:
            return [whole]
        n, lengths, shorter, known, longest = len(text), self.lengths, self.shorter.get, self.pairs.get, self.automaton.iter_long
        ids: list[int] = []
        dead: set[int] = set()  # places from which no end is reached
        none = -1, 0
        at, before, matches, straight = 0, -1, longest(text), True
        while at < n:
            if not straight:  # longest matches are read on from here
                matches, straight = longest(text, at), True
            end, (r, size) = next(matches, (-1, none))
            if end + 1 - at != size:
                r, size = none
            while True:
                while size:
                    if at + size not in dead:
                        good = before < 0 or known((before, r))
                        if self.compatible(before, r) if good is None else good:
                            break
                    straight = False
                    r, size = shorter(r, none)
                if size:
                    break
                if not ids:
                    raise ValueError("the vocabulary lacks a byte of the text")
                dead.add(at)
                r = ids.pop()
                size = lengths[r]
                at, before = at - size, ids[-1] if ids else -1
            ids.append(r)
            at, before = at + size, r
        return ids

    def encode_piece(self, piece: str) -> bytes:
        """Ids of a piece as little-endian unsigned 32-bit integers."""
        ids = self.encode_bytes(piece.encode("utf-8", "surrogatepass"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Memo(dict):
    def __init__(self, codec: ByteBPE):
        self.codec = codec
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        made = self.older.get(key) or self.codec.encode_piece(key)
        if len(key) < 64:
            if len(self) >= WORD_MEMO:
                self.older = dict(self)
                self.clear()
            self[key] = made
        return made


class Vocabulary:
    """Ranks and pattern, to be broadcast. A worker builds the codec once; it goes with the broadcast when the worker gets a task of another kind, as its memos are large."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, pattern

    @cached_property
    def codec(self) -> ByteBPE:
        return ByteBPE(self.ranks, self.pattern)


def tokenise(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: Iterable[str] = ("doc_id",), digests: bool = True) -> DataFrame:
    """The kept columns with `ids` (array of long; with digests instead n_tokens, ids_sha256 and decoded_sha256, from encoding and then decoding the ids)."""
    spark, keep = docs.sparkSession, list(keep)
    shared = spark.sparkContext.broadcast(Vocabulary(read_ranks(spark, path), pattern))  # one vocabulary file, whatever the input
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<long>"
    schema = T.StructType(docs.select(*keep).schema.fields + T.StructType.fromDDL(made).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.value.codec
        for batch in batches:
            for part in slices(batch, "__text"):
                rows = []
                for i in range(part.num_rows):
                    ids = codec.encode(part.column("__text")[i].as_py())
                    if digests:
                        rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()))
                    else:
                        rows.append((np.frombuffer(ids, "<u4").astype(np.int64),))
                cols = list(zip(*rows, strict=True))
                own = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())] if digests else [pa.array(cols[0], pa.list_(pa.int64()))]
                names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids"]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + own, keep + names)

    given = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    return spread(given).mapInArrow(trimmed(run), schema)


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = vocabulary()
    return tokenise(table(spark, sf_dir, "documents"), path, pattern)
