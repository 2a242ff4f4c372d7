"""Best-fit packing of token sequences by a grouping genetic algorithm.

Documents become pieces of at most `CAPACITY` tokens; only longer documents are cut. Full
pieces are sequences of their own. All other pieces are dealt by hash of their row number
into blocks of about `BLOCK` pieces. A block's bin packing is searched by islands: each
island holds a population of groupings (which pieces share a bin). Crossover injects
whole well-filled bins of one parent into the other, removes the bins that hold duplicates of
the injected pieces, and best-fits the displaced pieces into the bins that are left. Between
epochs every island's best grouping migrates to the next island of its block, by a
shuffle of (block, island). At last each block keeps the best grouping of its islands.

Only (piece number, length) meet in a block; texts and ids never move.

Defined results: NULL and empty texts are one piece holding the separator; repeated rows are
packed each; a document of exactly the capacity is not cut; an empty table gives an empty
result; texts of any length are read whole; other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from sparkrec.llm.common import text_of
from sparkrec.llm.tokens import vocabulary_path
from sparkrec.llm.transducer import byte_letters
from sparkrec.session import durable

CAPACITY, SEPARATOR = 2048, 0
BLOCK, ISLANDS, EPOCHS = 4096, 2, 2
POPULATION, CHILDREN = 4, 6  # groupings on an island, crossovers per epoch
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: Fixed value: the pattern of byte-level vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Up to this letter all releases of Unicode agree on classes, so both libraries give the same ids.
OLD_LETTERS = re.compile("[^\0-\u024f]")
JOINED_SPACE = re.compile(r"\s ")


class Encoder(dict):
    """Ids of texts as little-endian 32-bit bytes.

    Byte-level pre-tokens never cross the place between a non-space and a space, so a text is
    encoded as its stretches between single spaces, each remembered. Texts in which a
    space meets other white space, or with a special token, are encoded whole. Stretches of
    old letters go through the quicker of two libraries for the same merges.
    """

    def __init__(self, path: str, limit: int = 250_000):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.limit = limit
        self.quick = self._merges_alone(path)

    def _merges_alone(self, path: str):
        """The vocabulary's merges as ranks, if its ids follow the order of merging; else None."""
        import tiktoken

        letters = byte_letters()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        pairs = ("".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"])
        if any(model["vocab"][p] != 256 + i for i, p in enumerate(pairs)):
            return None
        return tiktoken.Encoding("merges", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, stretch: str) -> bytes:
        ids = self._whole(stretch)
        if len(stretch) < 64:
            if len(self) >= self.limit:
                self.clear()
            self[stretch] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        if self.quick and not OLD_LETTERS.search(text) and not any(s in text for s in self.special):
            ids = self.quick.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if text[0] == " " or "\0" in text or JOINED_SPACE.search(text) or any(s in text for s in self.special):
            return self._whole(text)
        return b"".join(map(self.__getitem__, text.replace(" ", "\0 ").split("\0")))


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary_path(vocabulary))


def cut(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids; the first piece takes what does not fill one."""
    n = len(ids) // 4
    first = n if n <= capacity else (n % capacity or capacity)
    bounds = [0, *range(first, n + 1, capacity)] if n > capacity else [0, n]
    return [(i, a, b - a, zlib.crc32(ids[4 * a:4 * b])) for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, separator: int = SEPARATOR) -> DataFrame:
    """One row per piece, in PIECES' columns."""
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(vocabulary)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for b in batches:
            rows = [(d, *p) for d, t in zip(b["doc_id"].array, b["text"]) for p in cut(encoder.encode(t) + end, capacity)]
            out = pd.DataFrame(rows, columns=names)
            yield out.assign(doc_id=pd.array(out["doc_id"], "Int64"))

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInPandas(run, PIECES)


class Packer:
    """Groupings of the pieces of one block. A grouping is an array: bin number of each piece."""

    def __init__(self, length: np.ndarray, capacity: int):
        self.length = [int(x) for x in length]
        self.capacity = capacity

    def best_fit(self, order, bins: list[list[int]], room: list[int]) -> None:
        """Put pieces, one after the other, into the fullest bin that takes them.

        Bins are kept by free room; the set of rooms in use is one integer, whose lowest bit above
        a piece's length is the best fit.
        """
        by_room: dict[int, list[int]] = {}
        used = 0
        for b, r in enumerate(room):
            by_room.setdefault(r, []).append(b)
            used |= 1 << r
        for i in order:
            n = self.length[i]
            fits = used >> n
            if fits:
                r = n + (fits & -fits).bit_length() - 1
                b = by_room[r].pop()
                if not by_room[r]:
                    used ^= 1 << r
                bins[b].append(i)
            else:
                b, r = len(bins), self.capacity
                bins.append([i])
                room.append(r)
            r -= n
            room[b] = r
            kept = by_room.setdefault(r, [])
            if not kept:
                used |= 1 << r
            kept.append(b)

    def start(self, rng: np.random.Generator, noise: float) -> list[list[int]]:
        """Best-fit decreasing, with lengths jittered by `noise`."""
        key = np.array(self.length) * (1 + noise * rng.standard_normal(len(self.length)))
        bins: list[list[int]] = []
        self.best_fit(np.argsort(-key, kind="stable").tolist(), bins, [])
        return bins

    def fill(self, group: list[int]) -> int:
        return sum(self.length[i] for i in group)

    def score(self, bins: list[list[int]]) -> tuple[int, float]:
        """Fewer bins first, then the more uneven fill."""
        return len(bins), -sum((self.fill(g) / self.capacity) ** 2 for g in bins)

    def crossover(self, giver: list[list[int]], taker: list[list[int]], rng: np.random.Generator) -> list[list[int]]:
        """Whole well-filled bins of the giver, what is left of the taker, displaced pieces best-fitted."""
        fills = np.array([self.fill(g) for g in giver])
        ranked = np.argsort(-fills + rng.random(len(fills)) * self.capacity * 0.02, kind="stable")
        take = ranked[:max(1, int(len(giver) * rng.uniform(0.3, 0.7)))]
        bins = [list(giver[b]) for b in take]
        taken = {i for g in bins for i in g}
        displaced: list[int] = []
        for group in taker:
            if taken.isdisjoint(group):
                bins.append(list(group))
            else:
                displaced += [i for i in group if i not in taken]
        # the emptiest bins are opened too, so displaced pieces meet others
        bins.sort(key=self.fill)
        loose = max(1, len(bins) // 50)
        displaced += [i for g in bins[:loose] for i in g]
        bins = bins[loose:]
        displaced.sort(key=lambda i: -self.length[i])
        self.best_fit(displaced, bins, [self.capacity - self.fill(g) for g in bins])
        return bins

    def evolve(self, population: list[list[list[int]]], rng: np.random.Generator, children: int) -> list:
        """Steady-state search: each child replaces the worst grouping if it is better."""
        ranked = sorted(population, key=self.score)
        least = -(-sum(self.length) // self.capacity)
        for _ in range(children):
            if len(ranked[0]) <= least or len(ranked) < 2:
                break
            a, b = rng.choice(len(ranked), 2, replace=False)
            child = self.crossover(ranked[min(a, b)], ranked[max(a, b)], rng)
            if self.score(child) < self.score(ranked[-1]):
                ranked[-1] = child
                ranked.sort(key=self.score)
        return ranked


def _numbered(bins: list[list[int]], n: int) -> list[int]:
    out = np.zeros(n, np.int64)
    for b, group in enumerate(bins):
        out[group] = b
    return out.tolist()


def _groups(numbers) -> list[list[int]]:
    numbers = np.asarray(numbers)
    order = np.argsort(numbers, kind="stable")
    return [g.tolist() for g in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1)] if len(order) else []


ISLAND = "block long, island int, migrate int, bins long, lengths array<int>, elite array<int>"


def _epoch(capacity: int, islands: int, epoch: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples():
                rng = np.random.default_rng([int(r.block), int(r.island), epoch])
                packer = Packer(r.lengths, capacity)
                least = [packer.start(rng, 0.0)] if epoch == 0 else [_groups(r.elite), _groups(r.guest)]
                if len(least[0]) > -(-sum(packer.length) // capacity):
                    least += [packer.start(rng, 0.02 + 0.1 * k) for k in range(POPULATION - len(least))]
                best = packer.evolve(least, rng, CHILDREN)[0]
                out.append((r.block, r.island, (r.island + 1) % islands, len(best), r.lengths, _numbered(best, len(r.lengths))))
            yield pd.DataFrame(out, columns=["block", "island", "migrate", "bins", "lengths", "elite"])

    return run


def group_lengths(blocks: DataFrame, capacity: int = CAPACITY, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """(block, elite): for blocks (block, lengths), the bin number of each length in the best grouping."""
    state = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "lengths")
    state = durable(state.repartition("block", "island").mapInPandas(_epoch(capacity, islands, 0), ISLAND))
    for epoch in range(1, epochs):
        guests = state.select("block", F.col("migrate").alias("island"), F.col("elite").alias("guest"))
        met = state.join(guests, ["block", "island"]).select("block", "island", "lengths", "elite", "guest")
        state = durable(met.repartition("block", "island").mapInPandas(_epoch(capacity, islands, epoch), ISLAND))
    return state.groupBy("block").agg(F.min_by("elite", F.struct("bins", "island")).alias("elite"))


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", capacity: int = CAPACITY, separator: int = SEPARATOR,
         block: int = BLOCK) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    numbered = durable(
        durable(pieces_of(docs, vocabulary, capacity, separator)).withColumn("rid", F.monotonically_increasing_id()))
    loose = numbered.filter(F.col("length") < capacity)
    blocks = 1 + loose.count() // block
    dealt = loose.select("rid", F.col("length").cast("int").alias("length"),
                         F.pmod(F.xxhash64("rid"), F.lit(blocks)).alias("block"))
    # a block's pieces in one order: hashing by row number keeps blocks near their mean size
    gathered = durable(dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("length", "rid")), asc=False).alias("p"))
                       .select("block", F.col("p.length").alias("lengths"), F.col("p.rid").alias("rids")))
    elite = group_lengths(gathered.select("block", "lengths"), capacity)
    placed = gathered.join(elite, "block").select(
        "block", F.explode(F.arrays_zip(F.col("rids").alias("rid"), F.col("elite").alias("bin"), F.col("lengths").alias("n"))).alias("z"))
    inside = W.partitionBy("block", "bin").orderBy("rid").rowsBetween(W.unboundedPreceding, -1)
    places = placed.select("block", F.col("z.rid").alias("rid"), F.col("z.bin").alias("bin"), F.col("z.n").alias("n")).select(
        "rid", (F.shiftleft(F.col("block") + 1, 24) + F.col("bin")).alias("sequence_id"),
        F.coalesce(F.sum("n").over(inside), F.lit(0)).cast("long").alias("offset"))
    whole = numbered.filter(F.col("length") >= capacity).withColumn("sequence_id", -1 - F.col("rid")).withColumn(
        "offset", F.lit(0).cast("long"))
    return numbered.join(places, "rid").unionByName(whole).drop("rid")
