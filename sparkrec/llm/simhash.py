"""SimHash near-duplicates, found with a Gray-order hierarchical index.

Fingerprint: 64 bits over the XXH64 hashes (seed 42) of word shingles, repeats included;
a bit is 1 when it is set in more than half of the hashes.

Link search: two fingerprints that differ in at most `bits` places agree wholly in one of
`bits` + 1 bands. Each distinct fingerprint goes once to every band, and fingerprints with
an equal band value form a bucket. Buckets arrive sorted by Gray rank, in which neighbours share most bits. A bucket's index is a
hierarchy over runs of that order: each node factors out the bits that all codes below
it share (mask and pattern). Node pairs are descended together; the differences
accumulated in the shared bits are a lower bound for all pairs below, so one comparison
prunes whole groups. Buckets above `CHUNK` codes are dealt out as pairs of chunks, so no
task holds more than two chunks and nothing is left out.

Each bucket returns a star per linked group instead of its pairs; components are then
joined across buckets.

Defined results: NULL text counts as empty; texts without words have fingerprint zero and
are linked like any other; fewer words than a shingle form one shingle; repeated rows
share a fingerprint; NULL ids never name a component (a component of NULL ids only gets
NULL); an empty table gives an empty result. Columns other than doc_id and text are never read
by `label` and passed through by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from sparkrec.llm.common import identified, text_of
from sparkrec.llm.components import connected
from sparkrec.session import durable

WORDS, BITS, SEED = 5, 3, 42
SIMILAR, WIDE_BITS, TABLES = 0.8, 12, 40  # for near copies: least similarity, differing bits, sampled masks
CHUNK = 20_000  # codes of a bucket in one chunk
SET_CHUNK = 4_000  # sets with a shingle in one chunk
SAMPLE, MOST_COMMON = 5_000, 200_000  # texts sampled to order shingles by frequency, shingles kept of them
CELLS, FULL = 256, 255  # cells of a set of hashes, and the largest count that a cell holds
LEAF, FAN = 32, 8
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: byte -> its eight bits in the eight bytes of a word, so that sums of up to 255 stay apart
_LANES = np.array([sum(((v >> j) & 1) << (8 * j) for j in range(8)) for v in range(256)], np.uint64)


def fingerprint(text: str | None, words: int = WORDS, block: int = 65_280) -> int:
    """Unsigned 64-bit fingerprint of a text; shingles are hashed in blocks."""
    return _fingerprint(_hashes(text, words, block))


def _hashes(text: str | None, words: int, block: int = 65_280) -> Iterator[np.ndarray]:
    """Hashes of a text's word shingles in blocks, repeats included; none for a text without words."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()  # splits at ASCII white space only
    if not found:
        return
    joined = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[:-1]]
    n = max(1, len(found) - words + 1)
    stops = ends[min(words, len(found)) - 1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, block):
        span = zip(starts[at:min(at + block, n)], stops[at:at + block])
        yield np.fromiter((digest(joined[s:e - 1], SEED) for s, e in span), np.uint64)


def _fingerprint(blocks) -> int:
    counts, n = np.zeros(64, np.int64), 0
    for h in blocks:
        counts += _bit_counts(h)
        n += len(h)
    on = np.packbits(counts * 2 > n, bitorder="little")
    return int(on.view("<u8")[0])


def _bit_counts(h: np.ndarray) -> np.ndarray:
    lanes = _LANES[h.view(np.uint8).reshape(-1, 8)]
    total = np.zeros(64, np.int64)
    full = len(lanes) // 255 * 255
    if full:
        parts = lanes[:full].reshape(-1, 255, 8).sum(1)
        total += parts.view(np.uint8).reshape(-1, 64).sum(0, dtype=np.int64)
    if full < len(lanes):
        total += lanes[full:].sum(0).view(np.uint8).astype(np.int64)
    return total


def fingerprint_of(text: str = "text", words: int = WORDS) -> Column:
    """Fingerprint of a text column, as a signed 64-bit number."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return run(text_of(text))


def with_fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint_of("text", words).alias("fp"))


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit code in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def band_masks(bits: int) -> list[int]:
    """`bits` + 1 masks of neighbouring places: codes at most `bits` apart agree under one of them."""
    width = 64 // (bits + 1)
    return [((1 << width) - 1) << (b * width) for b in range(bits + 1)]


def sampled_masks(tables: int = TABLES, width: int = 16) -> list[int]:
    """`tables` masks of `width` places drawn at random, always the same ones."""
    rng = np.random.default_rng(SEED)
    return [sum(1 << int(b) for b in rng.choice(64, width, replace=False)) for _ in range(tables)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bucketed(fps: DataFrame, masks: list[int], chunk: int) -> DataFrame:
    """(band, bucket, pair, gray, fp): each code once per mask, per pair of chunks in large buckets."""
    spread = fps.select("fp", F.posexplode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("band", "mask"))
    spread = spread.select("fp", "band", F.col("fp").bitwiseAND(F.col("mask")).alias("bucket"))
    large = (
        spread.groupBy("band", "bucket").agg(F.count("*").alias("n")).filter(F.col("n") > chunk)
        .select("band", "bucket", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda o: F.least(o, own) * F.col("chunks") + F.greatest(o, own),
    )
    return (
        spread.join(large, ["band", "bucket"], "left")
        .withColumn("pair", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(pairs)))
        .select("band", "bucket", "pair", gray_rank(F.col("fp")).alias("gray"), "fp")
    )


def links(fps: DataFrame, bits: int = BITS, chunk: int = CHUNK, masks: list[int] | None = None) -> DataFrame:
    """(u, v): pairs of codes at most `bits` apart that connect all that is linked.

    Exact bands return all pairs of small buckets, and for larger ones each linked code with the
    least code it reaches. Sampled `masks`, whose pairs are verified one by one, return each code of a small bucket
    with the nearest one before it and what connects the rest, and a spanning forest of a larger one with the closest pairs first. An edge of
    these can fail verification and hide a link behind it, so a caller that verifies has to search what stays apart
    again (`shared_prefix`).
    """
    forest = masks is not None
    placed = bucketed(fps, masks or band_masks(bits), chunk).repartition("band", "bucket", "pair").sortWithinPartitions(
        "band", "bucket", "pair", "gray")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _complete(batches, ["band", "bucket", "pair"]):
            yield _bucket_links(rows, bits, forest)

    return placed.mapInPandas(run, "u long, v long")


def _complete(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of complete buckets; `batches` are sorted by `by`."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        key = b[by].to_numpy(np.int64)
        new = np.flatnonzero((key[1:] != key[:-1]).any(1))
        if held and (held[-1][by].to_numpy(np.int64)[-1] != key[0]).any():
            yield pd.concat(held)
            held = []
        if len(new):  # all but the last bucket are complete
            held.append(b.iloc[:new[-1] + 1])
            yield pd.concat(held)
            held = [b.iloc[new[-1] + 1:]]
        else:
            held.append(b)
    if held:
        yield pd.concat(held)


def _bucket_links(rows: pd.DataFrame, bits: int, forest: bool) -> pd.DataFrame:
    """Links inside complete buckets."""
    codes = rows["fp"].to_numpy().view(np.uint64)
    key = rows[["band", "bucket", "pair"]].to_numpy(np.int64)
    group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(1))])
    size = np.bincount(group)
    out = [_short_runs(codes, group, size, bits, forest)]
    first = np.concatenate([[0], np.cumsum(size)])
    for g in np.flatnonzero(size > LEAF):
        index = GrayIndex(codes[first[g]:first[g + 1]])
        out.append(index.forest(bits) if forest else index.stars(bits))
    u, v = (np.concatenate([o[i] for o in out]).view(np.int64) for i in (0, 1))
    return pd.DataFrame({"u": u, "v": v})


def _short_runs(codes, group, size, bits, nearest):
    """All buckets of at most one leaf at once: neighbours at distance 1, 2, ...; or each code's nearest one before it, and a link
    for any two trees of these that still have neighbours in each other."""
    short = size[group] <= LEAF
    codes, group = codes[short], group[short]
    us, vs = [codes[:0]], [codes[:0]]
    best, other = np.full(len(codes), bits + 1), np.zeros(len(codes), np.int64)
    for k in range(1, LEAF):
        same = np.flatnonzero(group[k:] == group[:-k])
        if not len(same):
            break
        apart = np.bitwise_count(codes[same] ^ codes[same + k])
        if nearest:
            closer = apart < best[same + k]
            best[same[closer] + k], other[same[closer] + k] = apart[closer], same[closer]
        else:
            near = same[apart <= bits]
            us.append(codes[near])
            vs.append(codes[near + k])
    if nearest:
        linked = np.flatnonzero(best <= bits)
        root = np.arange(len(codes))
        root[linked] = other[linked]
        while (root[root] != root).any():
            root = root[root]
        trees, ends = [np.empty((0, 2), np.int64)], [np.empty((0, 2), np.int64)]
        for k in range(1, LEAF):
            apart = np.flatnonzero((group[k:] == group[:-k]) & (root[k:] != root[:-k]))
            pair = apart[np.bitwise_count(codes[apart] ^ codes[apart + k]) <= bits]
            trees.append(np.sort(np.stack([root[pair], root[pair + k]], 1), axis=1))
            ends.append(np.stack([pair, pair + k], 1))
        first = np.unique(np.concatenate(trees), axis=0, return_index=True)[1]
        ends = np.concatenate([np.stack([other[linked], linked], 1), np.concatenate(ends)[first]])
        return codes[ends[:, 0]], codes[ends[:, 1]]
    return np.concatenate(us), np.concatenate(vs)


class GrayIndex:
    """Hierarchy over codes in Gray order; level 0 are leaves of `LEAF` codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.levels = [self._nodes(codes, codes, LEAF)]
        while len(self.levels[-1][0]) > 1:
            self.levels.append(self._nodes(*self.levels[-1], FAN))

    @staticmethod
    def _nodes(all_on, any_on, width):
        """Bits that are on in all, and in any, of each run of `width`."""
        at = np.arange(0, len(all_on), width)
        return np.bitwise_and.reduceat(all_on, at), np.bitwise_or.reduceat(any_on, at)

    def _close(self, level, a, b, bits):
        """Pairs of nodes whose shared bits differ in at most `bits` places."""
        on, some = self.levels[level]
        shared = ~(on[a] ^ some[a]) & ~(on[b] ^ some[b])
        keep = np.bitwise_count((on[a] ^ on[b]) & shared) <= bits
        return a[keep], b[keep]

    @staticmethod
    def _below(a, b, width, n):
        """Pairs of the children of node pairs, each unordered pair once."""
        step = np.arange(width)
        x = (a[:, None, None] * width + step[None, :, None]) + np.zeros((1, 1, width), np.int64)
        y = (b[:, None, None] * width + step[None, None, :]) + np.zeros((1, width, 1), np.int64)
        keep = (x < n) & (y < n) & (x <= y)
        return x[keep], y[keep]

    def pairs(self, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of codes at most `bits` apart, in blocks of bounded size."""
        zero = np.zeros(1, np.int64)
        stack = [(len(self.levels) - 1, zero, zero)]
        while stack:
            level, a, b = stack.pop()
            width = LEAF if level == 0 else FAN
            step = max(1, (1 << 18) // (width * width))
            if len(a) > step:
                stack.append((level, a[step:], b[step:]))
                a, b = a[:step], b[:step]
            a, b = self._close(level, a, b, bits)
            if not len(a):
                continue
            if level:
                x, y = self._below(a, b, FAN, len(self.levels[level - 1][0]))
                stack.append((level - 1, x, y))
                continue
            x, y = self._below(a, b, LEAF, len(self.codes))
            near = (x != y) & (np.bitwise_count(self.codes[x] ^ self.codes[y]) <= bits)
            yield x[near], y[near]

    def stars(self, bits: int):
        """Each linked code with the least-placed code it reaches."""
        label = np.arange(len(self.codes))
        for x, y in self.pairs(bits):
            while True:
                a, b = label[x], label[y]
                apart = a != b
                if not apart.any():
                    break
                a, b = a[apart], b[apart]
                np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
                while (label != label[label]).any():
                    label = label[label]
        moved = np.flatnonzero(label != np.arange(len(label)))
        return self.codes[moved], self.codes[label[moved]]

    def forest(self, bits: int):
        """Pairs that connect what is linked, closest pairs first, no more than there are codes."""
        parent = list(range(len(self.codes)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        us, vs = [], []
        for least in range(bits + 1):
            for x, y in self.pairs(least):
                for a, b in zip(x.tolist(), y.tolist()):
                    p, q = root(a), root(b)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        us.append(a)
                        vs.append(b)
        return self.codes[np.array(us, np.int64)], self.codes[np.array(vs, np.int64)]


def components(rows: DataFrame, bits: int = BITS, chunk: int = CHUNK, edges: DataFrame | None = None) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint in rows (doc_id, fp), over `edges` or the codes' own links."""
    fps = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    star = durable(connected(links(fps.select("fp"), bits, chunk) if edges is None else edges))
    linked = star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
    named = linked.join(fps, linked["node"] == fps["fp"]).select("fp", "root", "least")
    ids = named.groupBy("root").agg(F.min("least").alias("of_root"))
    found = named.join(ids, "root").select("fp", "of_root")
    alone = F.coalesce("of_root", "least").alias("component_id")
    return fps.join(found, "fp", "left").select("fp", alone)


def label(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    rows = durable(with_fingerprints(docs, words))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(components(rows, bits), "fp").select("doc_id", hexed, "component_id")


def shingles(text: str, words: int) -> set[int]:
    """Hashes of a text's distinct word shingles, as the fingerprint cuts them."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    n = max(1, len(found) - words + 1)
    return {xxhash.xxh64_intdigest(b" ".join(found[i:i + words]), SEED) for i in range(n)}


def similarity(left: str = "a", right: str = "b", words: int = WORDS) -> Column:
    """Jaccard similarity of the word shingles of two text columns."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b):
            s, t = shingles(x, words), shingles(y, words)
            both = len(s & t)
            out.append(both / (len(s) + len(t) - both))
        return pd.Series(out, dtype="float64")

    return run(F.col(left), F.col(right))


def common_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, of shingles that a sample of texts (rid, text) repeats, and in how many of its texts they occur.

    They only set the order in which prefixes are taken; every order gives the same pairs.
    """
    share = min(1.0, SAMPLE / max(1, texts.count()))

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in batches:
            yield pd.Series([_distinct(_hashes(x, words)).view(np.int64) for x in t])

    drawn = texts.filter(F.pmod(F.xxhash64("rid"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    counted = drawn.select(F.explode(run("text")).alias("token")).groupBy("token").agg(F.count("*").alias("n")).filter("n > 2")
    found = counted.orderBy(F.desc("n"), "token").limit(MOST_COMMON).toPandas()
    token = found["token"].to_numpy(np.int64).view(np.uint64)
    place = np.argsort(token)
    return token[place], found["n"].to_numpy(np.int64)[place]


def _distinct(blocks) -> np.ndarray:
    """Distinct hashes in ascending order; a text without words has one shingle, the empty one."""
    blocks = list(blocks)
    return np.unique(np.concatenate(blocks)) if blocks else np.array([xxhash.xxh64_intdigest(b"", SEED)], np.uint64)


def needed(size: np.ndarray, least: float) -> np.ndarray:
    """Least whole number that is `least` times the size or more."""
    return np.ceil(np.asarray(size) * least - 1e-9).astype(np.int64)


def prefix(found: np.ndarray, least: float, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The rarest of a text's distinct shingles, as many as let no set of similarity `least` avoid them all.

    Two such sets share needed(size) shingles of either, so fewer than size - needed(size) + 1 of them
    can be missing; the rarest shared one is therefore in both prefixes.
    """
    token, n = common
    weight = np.zeros(len(found), np.int64)
    if len(token):
        at = np.minimum(np.searchsorted(token, found), len(token) - 1)
        weight = np.where(token[at] == found, n[at], 0)
    return found[np.argsort(weight, kind="stable")[:len(found) - int(needed(len(found), least)) + 1]]


def cell_counts(found: np.ndarray) -> bytes:
    """How many of a set's hashes fall into each of 256 cells, up to 255."""
    return np.minimum(np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=CELLS), FULL).astype(np.uint8).tobytes()


def may_share(cells: np.ndarray, a: np.ndarray, b: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Can sets a and b have `share` hashes in common? Each cell bounds what they share in it; a full cell bounds nothing."""
    out = np.empty(len(a), bool)
    for start in range(0, len(a), 1 << 15):
        at = slice(start, start + (1 << 15))
        least = np.minimum(cells[a[at]], cells[b[at]])
        out[at] = (least.sum(1, dtype=np.int64) >= share[at]) | (least == FULL).any(1)
    return out


def traits(text: str, words: int, least: float, common: tuple[np.ndarray, np.ndarray]) -> Column:
    """(fp, sid, size, cells, prefix) of a text column: fingerprint, hash of the set of shingles, its size, its counts by cell, its rarest shingles."""

    @F.pandas_udf("fp long, sid long, size int, cells binary, prefix array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for t in texts:
                blocks = list(_hashes(t, words))
                found = _distinct(blocks)
                codes = np.array([_fingerprint(blocks), xxhash.xxh64_intdigest(found.tobytes(), SEED)], np.uint64).view(np.int64)
                out.append((codes[0], codes[1], len(found), cell_counts(found), prefix(found, least, common).view(np.int64)))
            yield pd.DataFrame(out, columns=["fp", "sid", "size", "cells", "prefix"])

    return run(text_of(text))


def shared_prefix(tokens: DataFrame, heads: DataFrame, star: DataFrame, least: float, chunk: int = SET_CHUNK) -> DataFrame:
    """(u, v): all pairs of sets, not linked by `star` yet, that can reach the similarity.

    tokens: (token, sid, pos), the prefixes; heads: (sid, size, cells). Tokens that only one set or one group has
    go before anything is paired, so a large group that is linked costs its rows and not its pairs. Tokens of more than
    `chunk` rows are dealt out as pairs of chunks. A pair is emitted where the sizes allow the similarity and
    so many shingles are left after the token in both orders that enough can be shared, which
    holds at the first shared token of every pair that reaches it, and where the cells of both sets can
    hold enough common shingles: sets that share no more than a line or a passage are told apart inside the bucket,
    and what it puts out does not grow with the square of the texts that share one.
    """
    several = tokens.groupBy("token").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).filter("lo <> hi").select("token")
    rooted = heads.drop("cells").join(star.withColumnRenamed("node", "sid"), "sid", "left").select(
        "sid", "size", F.coalesce("root", "sid").alias("root"))
    met = durable(tokens.join(several, "token").join(rooted, "sid").distinct())
    apart = met.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).filter(
        "lo <> hi").select("token", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("sid"), F.col("chunks")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda o: F.least(o, own) * F.col("chunks") + F.greatest(o, own),
    )
    placed = met.join(apart, "token").join(heads.select("sid", "cells"), "sid").select(
        "token", F.explode(pairs).alias("pair"), "sid", "pos", "size", "root", "cells").repartition("token", "pair").sortWithinPartitions("token", "pair", "size")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _complete(batches, ["token", "pair"]):
            yield from _set_pairs(rows, least)

    return placed.mapInPandas(run, "u long, v long")


def _set_pairs(rows: pd.DataFrame, least: float) -> Iterator[pd.DataFrame]:
    """Pairs inside complete buckets, sorted by size: rows at distance 1, 2, ... until sizes are too far apart."""
    key = rows[["token", "pair"]].to_numpy(np.int64)
    group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(1))])
    sid, pos, size, root = (rows[c].to_numpy(np.int64) for c in ("sid", "pos", "size", "root"))
    cells = np.frombuffer(b"".join(rows["cells"]), np.uint8).reshape(-1, CELLS)
    floor, left = needed(size, least), size - pos
    us, vs, held = [sid[:0]], [sid[:0]], 0
    at, k = np.arange(len(rows)), 0
    while True:
        k += 1
        at = at[at + k < len(rows)]
        at = at[(group[at] == group[at + k]) & (size[at] >= floor[at + k])]  # those that fail here fail at every larger k
        if not len(at):
            break
        to = at + k
        share = needed(size[at] + size[to], least / (1 + least))
        keep = np.flatnonzero((root[at] != root[to]) & (np.minimum(left[at], left[to]) >= share))
        keep = keep[may_share(cells, at[keep], to[keep], share[keep])]
        us.append(np.minimum(sid[at[keep]], sid[to[keep]]))
        vs.append(np.maximum(sid[at[keep]], sid[to[keep]]))
        held += len(us[-1])
        if held > 1_000_000:
            yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)}).drop_duplicates()
            us, vs, held = [sid[:0]], [sid[:0]], 0
    yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs)}).drop_duplicates()


def verified(candidates: DataFrame, heads: DataFrame, texts: DataFrame, words: int, least: float) -> DataFrame:
    """The candidate pairs (u, v) of sets whose texts share enough shingles.

    heads: (sid, rid), the row that stands for a set; texts: (rid, text). Only texts that occur in a pair are kept.
    """
    pairs = durable(candidates.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    ends = pairs.select(F.col("u").alias("sid")).union(pairs.select("v")).distinct()
    some = durable(texts.join(heads.join(ends, "sid").hint("shuffle_hash"), "rid").select("sid", "text"))
    met = pairs.join(some.select(F.col("sid").alias("u"), F.col("text").alias("a")), "u").join(
        some.select(F.col("sid").alias("v"), F.col("text").alias("b")), "v")
    return met.filter(similarity("a", "b", words) >= least).select("u", "v")


def keep_one(docs: DataFrame, words: int = WORDS, least: float = SIMILAR, bits: int = WIDE_BITS, tables: int = TABLES,
             chunk: int = CHUNK, stored: bool = False) -> DataFrame:
    """The documents that stay: of each group of near copies the one with the smallest id, with all its columns.

    Only texts with the same set of word shingles (equal 64-bit hashes of it) are copies unseen; one
    of them, the head, stands for the set. Links are found twice over, each verified on the whole texts.
    First, fingerprints up to `bits` apart under `tables` sampled masks, and each head with the first one
    of its fingerprint: this links most of a large group cheaply, but misses some pairs. Then
    an exact join on the rarest shingles (`shared_prefix`) finds every remaining pair of heads in different groups
    that can reach the similarity. Rows are known by their file and place (`stored`: `docs` are files as they were
    read), which also tells apart rows without an id and rows that repeat the smallest id.
    """
    known = identified(docs, stored)
    texts = known.select("rid", text_of("doc.text").alias("text"))
    rows = durable(known.select(
        traits("doc.text", words, least, common_shingles(texts, words)).alias("of"),
        F.struct(F.col("doc.doc_id").isNull().alias("unnamed"), F.col("doc.doc_id").cast("long").alias("id"), "rid").alias("first"),
    ).select("of.*", "first"))
    heads = durable(rows.groupBy("sid").agg(F.min("fp").alias("fp"), F.min("size").alias("size"), F.min("cells").alias("cells"), F.min("first").alias("first")))
    standing = heads.select("sid", F.col("first.rid").alias("rid"))
    codes = durable(heads.groupBy("fp").agg(F.min("sid").alias("sid")))
    coded = links(codes.select("fp"), bits, chunk, sampled_masks(tables)).distinct()
    near = coded.join(codes.select(F.col("fp").alias("u"), F.col("sid").alias("a")), "u").join(
        codes.select(F.col("fp").alias("v"), F.col("sid").alias("b")), "v").select(F.col("a").alias("u"), F.col("b").alias("v"))
    same = heads.join(codes.withColumnRenamed("sid", "b"), "fp").filter("sid <> b").select(F.col("sid").alias("u"), F.col("b").alias("v"))
    star = durable(connected(durable(verified(near.unionByName(same), standing, texts, words, least))))
    tokens = rows.select("sid", F.posexplode("prefix").alias("pos", "token"))
    rest = verified(shared_prefix(tokens, heads.select("sid", "size", "cells"), star, least), standing, texts, words, least)
    found = star.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(rest)
    star = durable(connected(durable(found)))
    # sets that are no root of a group go with their root; the group's first row stays
    named = heads.join(star, heads["sid"] == star["node"], "left").select("first", F.coalesce("root", "sid").alias("root"))
    kept = named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.rid").alias("rid"))
    return known.join(kept.hint("shuffle_hash"), "rid", "left_semi").select("doc.*")
