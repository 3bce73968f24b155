"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity, groups.

Lines of 0.8 edit similarity may have SimHashes over 15 bits apart, which no pigeonhole
blocks of 64 bits reach. Blocks bring the closest lines together. What they cannot reach is
found for certain by a prefix filter: lines alike share one of the rarest of their pairs of
words in a row. Edit similarity decides.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subsmart.llm import words
from subsmart.llm.components import components
from subsmart.llm.tables import bound_batches, read, stored
from subsmart.operators.spread import sized

# Lines of fewer words are duplicates only if all their words are equal, digits too.
LEAST_WORDS = 5
SIMILARITY = 0.8
# Bits between lines that blocks are made for.
DISTANCE = 3
# Lines of a bucket whose pairs one task compares; those of larger buckets are dealt out.
CROWD = 1024
# Pairs of words are ordered by how often their slot occurs in so many documents.
SLOT_BITS, SAMPLED = 22, 20_000
# Tasks that count them, and pieces in which the counts are shuffled.
SAMPLE_TASKS, PIECES = 8, 64
# Bits of a line's number in a batch, of the level of a pair's slot, and of its hash.
PLACE_BITS, LEVEL_BITS = 22, 8
HASH_BITS = 64 - PLACE_BITS - LEVEL_BITS
# Keys by which lines first meet the least of a bucket, before all keys are used.
FEW = 3
# Keys that one task compares, and that a task holds before it deals them out.
PART_KEYS, HELD_KEYS = 1 << 20, 1 << 19
# Pairs that a task holds before it drops those found again.
HELD_PAIRS = 1 << 20
# 64 parities each that lines have, and that lines of so many words have besides.
NARROW, WIDE, WIDE_WORDS = 2, 8, 64
# Rounds over the keys; each shuffles its share, so disk holds one share at a time.
ROUNDS = 4
BITS = 64
# Lines that may share a bucket by chance; beyond it, more blocks must agree.
BY_CHANCE = 64

_WORD = np.zeros(256, bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_SAME_DIGIT = np.arange(256, dtype=np.uint8)
_SAME_DIGIT[ord("0") : ord("9") + 1] = ord("0")


_PLAIN = bytes(np.where(_WORD, _SAME_DIGIT, 0x20).astype(np.uint8))

# First two bytes in UTF-8 of the characters of scripts that put no spaces between words:
# Thai and Lao, Burmese, Khmer, Chinese, Japanese. Each character is a word. The marks and
# full-width signs of these scripts are no words.
_ALONE = np.zeros((256, 256), bool)
_SIGNS = np.zeros((256, 256), bool)
for _lead, _low, _high in [
    (0xE0, 0xB8, 0xBB), (0xE1, 0x80, 0x82), (0xE1, 0x9E, 0x9F), (0xE2, 0xBA, 0xBF),
    *((x, 0x80, 0xBF) for x in range(0xE3, 0xEA)), (0xEF, 0xA4, 0xAB), (0xF0, 0xA0, 0xB3),
]:
    _ALONE[_lead, _low : _high + 1] = True
for _lead, _low in [(0xE3, 0x80), (0xE2, 0x80), (0xE2, 0x81), (0xEF, 0xBC), (0xEF, 0xBD)]:
    _SIGNS[_lead, _low] = True
_ALONE &= ~_SIGNS


def word_spans(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``words.spans`` of the words in ``data``, with characters of unspaced scripts apart."""
    inside = _WORD[data]
    leads = np.flatnonzero(data[:-1] >= 0xE0) if len(data) else np.zeros(0, np.int64)
    pairs = data[leads], data[leads + 1]
    width = np.where(data[leads] >= 0xF0, 4, 3)
    signs = leads[_SIGNS[pairs]]
    inside[signs] = inside[signs + 1] = inside[signs + 2] = False
    alone = _ALONE[pairs]
    if not alone.any():
        return words.spans(inside, begins)
    cut = np.zeros(len(data) + 1, bool)
    cut[leads[alone]] = cut[leads[alone] + width[alone]] = True
    before = np.concatenate([[False], inside[:-1]])
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(before & (~inside | cut[:-1]))
    return starts, ends, np.searchsorted(starts, begins)


def line_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of lines that have any.

    Returned are the words' hashes, each line's first word (and the end), its text and its
    number in the text. Normalised are case, digits (all alike) and what is between words.
    Lines under ``LEAST_WORDS`` words keep their digits, and count only if they have a letter.
    """
    data, begins = words.joined(pc.utf8_lower(column))
    data = data.copy()
    starts, ends, firsts = word_spans(data, begins)
    breaks = np.cumsum(data == 0x0A, dtype=np.int32)
    line = breaks[starts]  # line breaks before the word
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    place = line + text  # rises with every new line and every new text
    first = np.flatnonzero(np.diff(place, prepend=-1))
    count = np.diff(np.append(first, len(starts)))
    digits = np.flatnonzero((data >= ord("0")) & (data <= ord("9")))
    word = np.searchsorted(starts, digits, "right") - 1
    long = np.repeat(count >= LEAST_WORDS, count)
    data[digits[long[word]]] = ord("0")
    hashes = words.word_hashes(data, starts, ends)
    kept = count >= LEAST_WORDS
    if len(first):
        lettered = np.bincount(word, minlength=len(starts)) < ends - starts
        kept |= np.add.reduceat(lettered, first) > 0
    hashes = hashes[np.repeat(kept, count)]
    first, count = first[kept], count[kept]
    # The byte at which a text begins may be a break of its own.
    begin = begins[text[first]]
    number = line[first] - breaks[begin] + (data[begin] == 0x0A)
    return hashes, np.concatenate([[0], np.cumsum(count)]), text[first], number


def line_keys(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A 64-bit key of each line's words in order."""
    place = np.arange(len(hashes)) - np.repeat(firsts[:-1], np.diff(firsts))
    part = words.mixed(hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
    return words.mixed(total[firsts[1:]] - total[firsts[:-1]])


# For each byte, its bits as eight counters of eight bits.
_SPREAD = np.packbits(
    np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)[:, :, None] * np.array([[[0] * 7 + [1]]], np.uint8),
    axis=2,
).reshape(256, 8).view(np.uint64).ravel()


def simhashes(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A bit is set if it is in over half of the line's word hashes.

    Counters of eight bits are added up, over pieces of at most 255 words.
    """
    if len(firsts) < 2:
        return np.zeros(0, np.uint64)
    counts = np.diff(firsts)
    pieces = -(-counts // 255)
    first_piece = np.concatenate([[0], np.cumsum(pieces)])
    within = np.arange(first_piece[-1]) - np.repeat(first_piece[:-1], pieces)
    starts = np.repeat(firsts[:-1], pieces) + 255 * within
    found = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)
    out = np.zeros((len(counts), 8), np.uint8)
    for i in range(8):
        sums = np.add.reduceat(_SPREAD[found[:, i]], starts).view(np.uint8).reshape(-1, 8)
        if len(sums) > len(counts):
            sums = np.add.reduceat(sums.astype(np.int64), first_piece[:-1], axis=0)
        out[:, i] = np.packbits(2 * sums.astype(np.int64) > counts[:, None], axis=1).ravel()
    return out.view(np.uint64).ravel()


def parities(hashes: np.ndarray, firsts: np.ndarray, longs: int = NARROW) -> list[np.ndarray]:
    """64 bits of each line for each of ``longs``: whether an odd number of its words fall on the bit.

    A word inserted or deleted turns one bit and a word replaced two at most.
    """
    if len(firsts) < 2:
        return [np.zeros(0, np.uint64)] * longs
    bit = np.uint64(1) << (hashes & np.uint64(63))
    side = hashes >> np.uint64(6) & np.uint64(longs - 1)
    return [np.bitwise_xor.reduceat(np.where(side == i, bit, np.uint64(0)), firsts[:-1]) for i in range(longs)]


def wide_parities(hashes: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``WIDE`` longs of parities for each line of ``WIDE_WORDS`` words, and where each line's begin (and the end).

    In long lines not alike, most of the ``NARROW`` bits differ by chance too.
    """
    count = np.diff(firsts)
    long = count >= WIDE_WORDS
    own = np.concatenate([[0], np.cumsum(count[long])])
    found = parities(hashes[np.repeat(long, count)], own, WIDE)
    return np.stack(found, axis=1).ravel(), np.concatenate([[0], np.cumsum(WIDE * long)])


def prefix_lengths(count: np.ndarray) -> np.ndarray:
    """How many of the rarest pairs of words hold one that every line alike shares.

    An edit breaks two of the ``m - 1`` pairs of the longer line of ``m`` words, and
    ``m // 5`` edits are allowed, so ``m - 1 - 2 * (m // 5)`` are shared; a line of ``n``
    words misses at most its own ``n - 1`` less the least of these for ``m`` from ``n`` to
    ``n / 0.8``. Lines alike therefore share one of the first pairs in any order of all.
    """
    return 2 * (count // 5) + 1 + (count % 5 == 4)


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _slot_counts(batches):
    """How often each slot occurs, packed in ``PIECES`` of the slots."""
    total = np.zeros(1 << SLOT_BITS, np.uint32)
    for batch in batches:
        hashes, firsts, _, _ = line_words(batch.column(0))
        grams, _ = words.shingle_hashes(hashes, firsts, 2)
        np.add.at(total, _slots(grams), np.uint32(1))
    packed = pa.array([x.tobytes() for x in np.split(total, PIECES)], pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(PIECES, dtype=np.int32)), packed], ["piece", "counts"])


def _piece_levels(table: pa.Table) -> pa.Table:
    """The levels of one piece of the slots: 16 for each power of two of their counts."""
    times = np.zeros((1 << SLOT_BITS) // PIECES, np.int64)
    for counts in table["counts"]:
        times += np.frombuffer(counts.as_buffer(), np.uint32)
    levels = np.minimum(16 * np.log2(np.maximum(times, 1)), (1 << LEVEL_BITS) - 1).astype(np.uint8)
    return pa.table({"piece": table["piece"][:1], "levels": pa.array([levels.tobytes()], pa.binary())})


def gram_levels(rows: DataFrame) -> np.ndarray:
    """How frequent the pairs of words of each slot are, from 0 to 255.

    Counted in about ``SAMPLED`` documents. The levels only order pairs of words: whatever
    they are, the same lines are found alike, with more or fewer comparisons.
    """
    one_in = max(1, rows.count() // SAMPLED)
    sample = rows.filter(F.pmod(F.xxhash64("text_key"), F.lit(one_in)) == 0).select("text").repartition(SAMPLE_TASKS)
    counts = sample.mapInArrow(_slot_counts, "piece int, counts binary")
    found = counts.groupBy("piece").applyInArrow(_piece_levels, "piece int, levels binary").toArrow()
    levels = np.zeros((PIECES, (1 << SLOT_BITS) // PIECES), np.uint8)
    for piece, packed in zip(found["piece"].to_pylist(), found["levels"].to_pylist()):
        levels[piece] = np.frombuffer(packed, np.uint8)
    return levels.ravel()


def prefix_keys(hashes: np.ndarray, firsts: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each line of ``LEAST_WORDS`` words the keys of its rarest pairs of words in a row.

    Returned are all keys, and where each line's begin (and the end). Repeated pairs are told apart by their number.
    """
    count = np.diff(firsts)
    made = np.where(count >= LEAST_WORDS, prefix_lengths(count), 0)
    grams, begins = words.shingle_hashes(hashes, firsts, 2)
    tokens = levels[_slots(grams)].astype(np.uint64) << np.uint64(HASH_BITS)
    tokens |= grams & np.uint64((1 << HASH_BITS) - 1)
    line = np.repeat(np.arange(len(count)), np.diff(begins))
    keys = [np.zeros(0, np.uint32)]
    for low in range(0, len(count), 1 << PLACE_BITS):
        high = min(low + (1 << PLACE_BITS), len(count))
        own = slice(begins[low], begins[high])
        place = (line[own] - low).astype(np.uint64) << np.uint64(LEVEL_BITS + HASH_BITS)
        ordered = np.sort(tokens[own] | place)
        at = np.arange(len(ordered))
        new = np.diff(ordered, prepend=~ordered[:1]) != 0
        repeat = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
        kept = at - (begins[line[own]] - begins[low]) < made[line[own]]
        token = ordered[kept] & np.uint64((1 << LEVEL_BITS + HASH_BITS) - 1)
        keys.append(words.mixed(words.mixed(token) + repeat[kept]).astype(np.uint32))
    offsets = np.concatenate([[0], np.cumsum(made)])
    return np.concatenate(keys), offsets


def few_keys(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each line the least of its keys in ``FEW`` orders; 0 if it has none."""
    out = np.zeros((len(offsets) - 1, FEW), np.uint32)
    some = np.diff(offsets) > 0
    if some.any():
        for i in range(FEW):
            ordered = keys * np.uint32(0x9E3779B1 + 2 * 0x3C6EF372 * i & 0xFFFFFFFF)
            out[some, i] = np.minimum.reduceat(ordered, offsets[:-1][some])
    return out


def _list(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    signed = values.view(np.int64 if values.itemsize == 8 else np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(signed))


LINE = (
    "doc_id long, text_key long, number int, line long, n int, print long, low long, high long, "
    "few array<int>, keys array<int>, wide array<long>"
)


def _lines(levels: np.ndarray):
    def hashed(batches):
        for batch in batches:
            hashes, firsts, text, number = line_words(batch.column(2))
            low, high = parities(hashes, firsts)
            keys, offsets = prefix_keys(hashes, firsts, levels)
            few = few_keys(keys, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(text)),
                    batch.column(1).take(pa.array(text)),
                    pa.array(number, pa.int32()),
                    pa.array(line_keys(hashes, firsts).view(np.int64)),
                    pa.array(np.diff(firsts), pa.int32()),
                    pa.array(simhashes(hashes, firsts).view(np.int64)),
                    pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)),
                    _list(few.ravel(), FEW * np.arange(len(few) + 1)),
                    _list(keys, offsets),
                    _list(*wide_parities(hashes, firsts)),
                ],
                ["doc_id", "text_key", "number", "line", "n", "print", "low", "high", "few", "keys", "wide"],
            )

    return hashed


def blocking(lines: int) -> tuple[int, int]:
    """Numbers of blocks in all and of blocks that must agree, for so many lines.

    Of DISTANCE + e blocks, e agree in lines at most DISTANCE bits apart. Any e finds the
    same pairs; the larger, the longer the keys and the fewer lines share one by chance.
    """
    equal = 1
    while equal < 8 and lines > BY_CHANCE << BITS * equal // (DISTANCE + equal):
        equal += 1
    return DISTANCE + equal, equal


def block_keys(blocks: int) -> list[Column]:
    """For each choice of all blocks but one, 32 bits of a hash of its bits of ``print``.

    They bring the closest lines together; no pair rests on them, as ``prefix_keys`` has all.
    """
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(cuts, cuts[1:])]
    keys = []
    for chosen in combinations(masks, blocks - 1):
        mask = sum(chosen)
        bits = F.col("print").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))
        keys.append(F.xxhash64(bits))
    return keys


def _bucket(slot: Column, key: Column) -> Column:
    return F.shiftleft(slot.cast("long"), 32).bitwiseOR(key.bitwiseAND(F.lit((1 << 32) - 1)))


def _packed(part: np.ndarray, parts: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """The columns' values of each part as bytes."""
    order = np.argsort(part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts))
    some = np.flatnonzero(np.diff(ends, prepend=0))
    cuts = [(ends[i - 1] if i else 0, ends[i]) for i in some]
    packed = [pa.array([x[i:j].tobytes() for i, j in cuts], pa.binary()) for x in (x[order] for x in columns.values())]
    return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *packed], ["part", *columns])


def _dealt_buckets(parts: int):
    def deal(held):
        buckets, lines = (np.concatenate(x) for x in zip(*held))
        part = (words.mixed(buckets.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        return _packed(part, parts, {"buckets": buckets, "lines": lines})

    def dealt(batches):
        held, size = [], 0
        for batch in batches:
            line, lists = batch.columns
            held.append((lists.flatten().to_numpy(), np.repeat(line.to_numpy(), lists.value_lengths().to_numpy())))
            size += len(held[-1][0])
            if size >= HELD_KEYS:
                yield deal(held)
                held, size = [], 0
        if size:
            yield deal(held)

    return dealt


def _least(table: pa.Table) -> pa.Table:
    """Of one part, each line with the least line of each of its buckets, if another."""
    buckets, lines = (np.frombuffer(b"".join(table[x].to_pylist()), np.int64) for x in ("buckets", "lines"))
    order = np.lexsort((lines, buckets))
    buckets, lines = buckets[order], lines[order]
    first = np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1]))
    least = np.repeat(lines[first], np.diff(np.append(first, len(lines))))
    other = least != lines
    a, b = _once(least[other], lines[other])
    return pa.table({"a": a, "b": b})


def met(prints: DataFrame, blocks: int) -> DataFrame:
    """``b``, a line that shares one of a few keys with others, and ``a``, the least of these.

    Only the two numbers are shuffled, packed. A bucket is a key and its slot: one of ``FEW``,
    or the choice of blocks.
    """
    rarest = F.transform("few", lambda key, i: _bucket(i, key))
    chosen = [_bucket(F.lit(FEW + i), key) for i, key in enumerate(block_keys(blocks))]
    index = prints.select("line", F.concat(rarest, F.array(*chosen)).alias("buckets"))
    parts = 1 + prints.count() * (FEW + len(chosen)) // PART_KEYS
    dealt = index.mapInArrow(_dealt_buckets(parts), "part int, buckets binary, lines binary")
    return stored(dealt.groupBy("part").applyInArrow(_least, "a long, b long"))


def _near(a: str, b: str) -> Column:
    """What is true of all lines alike: close in length, and few bits of parity apart."""
    n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
    longer = F.greatest(n, m)
    differ = [F.bit_count(F.col(f"{a}.{x}").bitwiseXOR(F.col(f"{b}.{x}"))) for x in ("low", "high")]
    return (F.least(n, m) >= longer * SIMILARITY) & (differ[0] + differ[1] <= 2 * F.floor(longer * (1 - SIMILARITY) + 1e-9))


def star_pairs(shared: DataFrame, prints: DataFrame) -> DataFrame:
    """Pairs of each line with the least line of each of its buckets, if near."""
    pairs = shared.distinct()
    side = lambda name: prints.select(F.col("line").alias(name), F.struct("n", "low", "high").alias(f"of_{name}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(_near("of_a", "of_b")).select("a", "b")


# What of a line goes with each of its keys.
_PACKED = {"keys": np.uint32, "lines": np.int64, "groups": np.int64, "ns": np.uint16, "lows": np.uint64, "highs": np.uint64}


def _dealt(parts: int, turn: int):
    """Keys of one round with line, group, length and parities, packed by part."""

    def deal(held):
        columns = dict(zip(_PACKED, (np.concatenate(x) for x in zip(*held))))
        return _packed(columns["keys"] // np.uint32(ROUNDS) % np.uint32(parts), parts, columns)

    def dealt(batches):
        held, size = [], 0
        for batch in batches:
            line, group, n, low, high = (x.to_numpy() for x in batch.columns[:5])
            lists = batch.column(5)
            keys = lists.flatten().to_numpy().view(np.uint32)
            own = keys % np.uint32(ROUNDS) == turn
            row = np.repeat(np.arange(len(line)), lists.value_lengths().to_numpy())[own]
            short = np.minimum(n, 0xFFFF).astype(np.uint16)
            # Instead of a group its difference from the line: zero for most.
            held.append((keys[own], *(x[row] for x in (line, line ^ group, short, low, high))))
            size += len(row)
            if size >= HELD_KEYS:
                yield deal(held)
                held, size = [], 0
        if size:
            yield deal(held)

    return dealt


def _once(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs sorted, each once."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _near_pairs(end, lines, groups, n, lows, highs) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of lines of different groups in a bucket, whose lines stand by length up to ``end``."""
    done, held, size = (np.zeros(0, np.int64), np.zeros(0, np.int64)), [], 0
    at, step = np.arange(len(lines)), 0
    while len(at):
        step += 1
        at = at[at + step < end[at]]
        at = at[n[at] >= n[at + step] * SIMILARITY]
        x = at[groups[at] != groups[at + step]]
        y = x + step
        differ = np.bitwise_count(lows[x] ^ lows[y]) + np.bitwise_count(highs[x] ^ highs[y])
        near = differ <= 2 * np.floor(n[y] * (1 - SIMILARITY) + 1e-9)
        x, y = lines[x[near]], lines[y[near]]
        held.append((np.minimum(x, y), np.maximum(x, y)))
        size += len(x)
        if size >= HELD_PAIRS:
            done, held, size = _once(*(np.concatenate(z) for z in zip(done, *held))), [], 0
    return _once(*(np.concatenate(z) for z in zip(done, *held)))


def _meet(table: pa.Table) -> pa.Table:
    """Of one part, the near pairs of lines of different groups that share a key.

    Lines of a key are a bucket as long as the next longer one is close enough in length.
    Of a bucket of over ``CROWD`` lines, some of different groups, the lines are returned instead.
    """
    keys, lines, groups, n, lows, highs = (
        np.frombuffer(b"".join(table[x].to_pylist()), kind) for x, kind in _PACKED.items()
    )
    bucket = keys.astype(np.uint64) << np.uint64(32) | n
    order = np.argsort(bucket)
    keys, lines, n, bucket, groups = keys[order], lines[order], n[order], bucket[order], (groups ^ lines)[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (n[:-1] < n[1:] * SIMILARITY)
    first = np.flatnonzero(new)
    crowd = np.diff(np.append(first, len(keys)))
    several = np.minimum.reduceat(groups, first) < np.maximum.reduceat(groups, first)
    few, many = several & (crowd <= CROWD), several & (crowd > CROWD)
    kept = np.repeat(few, crowd)
    end = np.repeat(np.cumsum(crowd[few]), crowd[few])
    a, b = _near_pairs(end, *(x[kept] for x in (lines, groups, n, lows[order], highs[order])))
    crowded = lines[np.repeat(many, crowd)]
    of = lambda x: pa.array(np.repeat(x[many], crowd[many]))
    none = lambda size: pa.nulls(size, pa.int64())
    columns = {
        "a": [pa.array(a), pa.array(crowded)],
        "b": [pa.array(b), none(len(crowded))],
        "bucket": [none(len(a)), of(bucket[first].view(np.int64))],
        "crowd": [none(len(a)), of(crowd)],
    }
    return pa.table({k: pa.chunked_array(x, pa.int64()) for k, x in columns.items()})


def across(keyed: DataFrame, turn: int) -> DataFrame:
    """Near pairs ``a`` and ``b`` of lines of different groups that share a key.

    Where ``b`` is null, ``a`` is a line of ``bucket``, whose ``crowd`` of lines is too large for
    one task. ``keyed`` has ``line``, ``group``, ``n``, ``low``, ``high`` and ``keys``. There are
    more keys than anything else, so they are shuffled packed, by parts whose number grows with
    the keys.
    """
    keyed = keyed.select("line", "group", "n", "low", "high", "keys")
    total = keyed.agg(F.coalesce(F.sum(F.size("keys")), F.lit(0))).first()[0]
    packed = ", ".join(["part int", *(f"{x} binary" for x in _PACKED)])
    dealt = keyed.mapInArrow(_dealt(1 + total // ROUNDS // PART_KEYS, turn), packed)
    return dealt.groupBy("part").applyInArrow(_meet, "a long, b long, bucket long, crowd long")


def closer(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """The ``pairs`` whose ``wide`` parities are few apart, and those of lines that have none."""
    for side in ("a", "b"):
        of = keyed.select(F.col("line").alias(side), F.col("n").alias(f"_n_{side}"), F.col("wide").alias(f"_wide_{side}"))
        pairs = pairs.join(of, side)
    bits = [F.bit_count(F.get("_wide_a", F.lit(i)).bitwiseXOR(F.get("_wide_b", F.lit(i)))) for i in range(WIDE)]
    differ = functools.reduce(lambda x, y: x + y, [F.coalesce(x, F.lit(0)) for x in bits])
    longer = F.greatest("_n_a", "_n_b")
    return pairs.filter(differ <= 2 * F.floor(longer * (1 - SIMILARITY) + 1e-9)).select("a", "b")


def cross_pairs(shared: DataFrame, tagged: DataFrame) -> DataFrame:
    """All near pairs of lines of different groups in a bucket.

    Lines of a bucket beyond ``CROWD`` are cut into parts, and every two parts meet in a cell
    of their own, so no task has all pairs of a bucket.
    """
    rows = shared.join(tagged, "line")
    parts = F.ceil(F.col("crowd") / CROWD).cast("long")
    part = F.pmod(F.xxhash64("line"), F.col("_parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))
    cells = (
        rows.withColumn("_parts", parts)
        .withColumn("part", part)
        .withColumn("_other", other)
        .withColumn("cell", F.least("part", "_other") * F.col("_parts") + F.greatest("part", "_other"))
        .withColumn("own", F.col("part") == F.col("_other"))
        .select("bucket", "cell", "part", "own", "line", "group", "n", "low", "high")
    )
    a, b = cells.alias("a"), cells.alias("b")
    once = F.col("a.own") | (F.col("a.part") != F.col("b.part"))
    other = (F.col("a.line") < F.col("b.line")) & (F.col("a.group") != F.col("b.group"))
    return (
        a.join(b, ["bucket", "cell"])
        .filter(once & other & _near("a", "b"))
        .select(F.col("a.line").alias("a"), F.col("b.line").alias("b"))
        .distinct()
    )


def with_groups(lines: DataFrame, groups: DataFrame) -> DataFrame:
    """``line``, its ``n`` and parities, and its ``group`` (of ``node``, ``root``)."""
    known = groups.withColumnRenamed("node", "line")
    return lines.join(known, "line", "left").select(
        "line", "n", "low", "high", F.coalesce("root", "line").alias("group")
    )


def edit_distance(a: list, b: list) -> int:
    """Words inserted, deleted or replaced, with one bit operation per column of the table."""
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    a, b, same = a[same:], b[same:], 0
    for x, y in zip(reversed(a), reversed(b)):
        if x != y:
            break
        same += 1
    a, b = a[: len(a) - same], b[: len(b) - same]
    if not a or not b:
        return len(a) or len(b)
    places: dict[int, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    more, less, distance = every, 0, len(a)
    for word in b:
        same = places.get(word, 0)
        across = (((same & more) + more) ^ more) | same
        up = (less | ~(across | more)) & every
        down = more & across
        distance += bool(up & last) - bool(down & last)
        up, down = (up << 1 | 1) & every, (down << 1) & every
        diagonal = same | less
        more, less = (down | ~(diagonal | up)) & every, up & diagonal
    return distance


_CHARACTER = re.compile(
    rb"(\xe0[\xb8-\xbb].|\xe1[\x80-\x82\x9e\x9f].|\xe2[\xba-\xbf].|\xe3[\x81-\xbf].|[\xe4-\xe9]..|"
    rb"\xef[\xa4-\xab].|\xf0[\xa0-\xb3]..)|\xe3\x80.|\xe2[\x80\x81].|\xef[\xbc\xbd].",
    re.DOTALL,
)


def normalised(line: str) -> list[bytes]:
    """The words that ``line_words`` hashes, of a line of ``LEAST_WORDS`` words or more."""
    plain = line.encode()
    if not line.isascii() and max(plain) >= 0xE0:
        plain = _CHARACTER.sub(lambda m: b" " + (m[1] or b"") + b" ", plain)
    return plain.translate(_PLAIN).split()


def within(a: list, b: list, most: int) -> bool:
    """Whether at most ``most`` words are inserted, deleted or replaced.

    Follows the furthest place that each number of edits reaches on each diagonal, so lines
    that are nearly the same take few steps; others are refused by their common words first.
    """
    if abs(len(a) - len(b)) > most:
        return False
    places, common = Counter(a), 0
    for word in b:
        left = places.get(word, 0)
        if left:
            places[word] = left - 1
            common += 1
    if common < max(len(a), len(b)) - most:
        return False
    n, m = len(a), len(b)
    reach: dict[int, int] = {}
    for edits in range(most + 1):
        new = {}
        for k in range(-edits, edits + 1):
            # From the diagonal itself, the one below and the one above.
            x = max(reach.get(k, -2) + 1, reach.get(k - 1, -2) + 1, reach.get(k + 1, -2)) if edits else 0
            y = x - k
            if not (0 <= x <= n and 0 <= y <= m):
                continue
            while x < n and y < m and a[x] == b[y]:
                x, y = x + 1, y + 1
            if x == n and y == m:
                return True
            new[k] = x
        reach = new
    return False


def _alike(batches):
    for batch in batches:
        words = functools.cache(normalised)  # a line has several partners
        lowered = (pc.utf8_lower(x).to_pylist() for x in batch.columns[2:])
        kept = []
        for x, y in zip(*lowered):
            x, y = words(x), words(y)
            kept.append(within(x, y, int((1 - SIMILARITY) * max(len(x), len(y)) + 1e-9)))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(kept, pa.bool_()))


def verified(pairs: DataFrame, lines: DataFrame, rows: DataFrame) -> DataFrame:
    """The ``pairs`` whose lines are alike by edit similarity.

    Their texts come from the first place of each line; ``rows`` has the documents.
    """
    sides = pairs.select(F.explode(F.array("a", "b")).alias("line")).distinct()
    wanted = (
        lines.join(sides, "line")
        .groupBy(F.col("place.doc_id").alias("_id"), F.col("place.text_key").alias("_key"))
        .agg(F.collect_list(F.struct("place.number", "line")).alias("wanted"))
    )
    here = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    found = rows.join(sized(stored(wanted)).frame, here).withColumn("_lines", F.split("text", "\n"))
    picked = F.transform(
        "wanted", lambda w: F.struct(w["line"].alias("line"), F.get(F.col("_lines"), w["number"]).alias("words"))
    )
    texts = stored(found.select(F.explode(picked).alias("p")).select("p.*").dropDuplicates(["line"]))
    sides_of = lambda name, words: texts.select(F.col("line").alias(name), F.col("words").alias(words))
    compared = pairs.join(sides_of("a", "x"), "a").join(sides_of("b", "y"), "b")
    return stored(compared.select("a", "b", "x", "y").mapInArrow(_alike, "a long, b long"))


def with_text_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_text_key", F.xxhash64(F.coalesce("text", F.lit(""))))


def repeated_lines(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and ``numbers`` (from 0) of the lines to take out.

    ``docs`` has ``doc_id``, ``text`` and ``_text_key``.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("_text_key").alias("text_key"), "text")
    found = stored(rows.mapInArrow(_lines(gram_levels(rows)), LINE))
    place = F.struct("doc_id", "text_key", "number")
    lines = stored(
        found.groupBy("line").agg(
            F.count("*").alias("times"),
            F.min(place).alias("place"),
            F.min("n").alias("n"),
            F.min("print").alias("print"),
            F.min("low").alias("low"),
            F.min("high").alias("high"),
            F.first("few").alias("few"),
        )
    )
    blocks, _ = blocking(lines.count())
    prints = lines.filter(F.col("n") >= LEAST_WORDS).select("line", "n", "print", "low", "high", "few")
    shared = met(prints, blocks)
    # Each line with the least of its buckets: a group of any size is linked by as many pairs.
    stars = components(verified(stored(star_pairs(shared, prints)), lines, rows))
    # What links the groups found so far: by all keys.
    tagged = with_groups(prints, stars)
    own = found.filter(F.col("n") >= LEAST_WORDS).select("line", "keys", "wide").dropDuplicates(["line"])
    keyed = stored(own.join(tagged, "line"))
    rounds = functools.reduce(DataFrame.unionByName, [stored(across(keyed, turn)) for turn in range(ROUNDS)])
    pairs = rounds.filter("b is not null").select("a", "b")
    crowded = rounds.filter("b is null").select("bucket", F.col("a").alias("line"), "crowd")
    if crowded.limit(1).count():
        pairs = pairs.unionByName(cross_pairs(crowded, keyed.drop("keys", "wide")))
    cross = verified(stored(closer(pairs.distinct(), keyed)), lines, rows)
    for side in ("a", "b"):
        of = stars.select(F.col("node").alias(side), F.col("root").alias("_root"))
        cross = cross.join(of, side, "left").withColumn(side, F.coalesce("_root", side)).drop("_root")
    joined = components(cross)
    rooted = (
        lines.join(stars.select(F.col("node").alias("line"), F.col("root").alias("_star")), "line", "left")
        .withColumn("_star", F.coalesce("_star", "line"))
        .join(joined.withColumnRenamed("node", "_star"), "_star", "left")
        .withColumn("root", F.coalesce("root", "_star"))
    )
    groups = (
        rooted.groupBy("root")
        .agg(F.sum("times").alias("times"), F.min("place").alias("kept"))
        .filter("times > 1")
    )
    decided = rooted.join(groups.select("root", "kept"), "root").select("line", "kept")
    return (
        found.select("doc_id", "text_key", "number", "line")
        .join(decided, "line")
        .filter(~place.eqNullSafe(F.col("kept")))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("number").alias("numbers"))
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` without repeated lines, ``n_lines`` before and ``n_removed``.

    Lines end at line feeds. Lines of ``LEAST_WORDS`` words or more, normalised in case,
    digits and punctuation, are alike if at least ``SIMILARITY`` of the words are the same by
    edit distance, and all such pairs are linked. Compared are lines that share a key: the
    blocks of the SimHash but one, and the rarest pairs of words in a row, of which lines alike
    share one for certain. By the former and a few of the latter lines meet the least one of
    a bucket; by all of the latter, all lines meet that are not of one group by then.
    Shorter lines that have a letter are alike if their words are equal. Characters of
    scripts without spaces are words. Of each group connected by likeness one occurrence
    stays: that of the least id (null is least), in a document the first. Lines without words
    stay as they are.

    Null texts stay null and have no lines; an empty text has one. Rows equal in id and
    text are one document and stay equal. ``n_chars``, if there, is set anew. Columns
    whose names clash with the added ones are replaced.
    """
    added = ["n_lines", "n_removed"]
    docs = with_text_key(docs.drop(*added))
    gone = sized(
        stored(repeated_lines(docs)).select(
            F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "numbers"
        )
    ).frame
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    lines = F.split("text", "\n")
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "numbers"), lambda i: F.get(F.col("_lines"), i)
    )
    out = (
        docs.join(gone, same, "left")
        .withColumn("_lines", lines)
        .withColumn("text", F.when(F.col("numbers").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
        .withColumn("n_lines", F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("long"))
        .withColumn("n_removed", F.coalesce(F.size("numbers"), F.lit(0)).cast("long"))
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return out.select(*[c for c in docs.columns if c != "_text_key"], *added)


def op2_line_dedup(spark, sf_dir) -> DataFrame:
    """Every document without the lines that are repeated elsewhere."""
    found = dedup_lines(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "text")
