import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from sparkrec.llm import packing


def check(rows, texts, capacity=2048):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = sorted(
        (-1 if d is None else d, piece, start, length, zlib.crc32(ids[start:start + length].tobytes()))
        for d, t in texts
        for ids in [np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4")]
        for first in [len(ids) if len(ids) <= capacity else len(ids) % capacity or capacity]
        for piece, start, length in [(0, 0, first)] + [(1 + k, s, capacity) for k, s in enumerate(range(first, len(ids), capacity))])
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == wanted
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(r.length for r in rows) // capacity)


def test_round_trip(odd_docs, small_docs, no_docs):
    docs = odd_docs.select("doc_id", "text").union(small_docs.select("doc_id", "text"))
    used, least = check(packing.pack(docs).collect(), [tuple(r) for r in docs.collect()])
    assert used <= least + 2
    assert packing.pack(no_docs).count() == 0


def test_many_blocks(small_docs):
    docs = small_docs.select("doc_id", "text")
    used, least = check(packing.pack(docs, block=40).collect(), [tuple(r) for r in docs.collect()])
    assert used <= least * 1.1 + 2


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(5)
    packer = packing.Packer(rng.integers(1, 2048, 300), 2048)
    population = [packer.start(rng, 0.1 * k) for k in range(4)]
    child = packer.crossover(population[0], population[1], rng)
    assert sorted(i for g in child for i in g) == list(range(300)) and all(packer.fill(g) <= 2048 for g in child)
    best = packer.evolve(population, rng, 10)[0]
    assert len(best) <= min(map(len, population)) and sorted(i for g in best for i in g) == list(range(300))


def test_stretches_give_the_ids_of_the_whole():
    encoder = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"), limit=50)
    rng = np.random.default_rng(1)
    parts = ["'s", " ", "\n", "é", "\t", "<|endoftext|>", "the", "漢", "\0", "\x1c", "THE", "'ll", "\r\n", " ", "12", "!"]
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(0, 14)))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == np.array(want, "<u4").tobytes()
