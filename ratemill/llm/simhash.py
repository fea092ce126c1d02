"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 23, 23 and 18 bits. The binary
Golay code of length 23 is perfect: every word is within three bits of exactly one
of its 4,096 codewords. The keys of a segment are the indices of all codewords within
four bits: one, or six if the nearest is three bits away. Words that differ in at
most two bits have a word between them that is one bit from each, and its codeword
is a key of both; so they share a key.

Of four differing bits, spread over three segments, either some segment has
none, and then one of the two others has at most two; or all have at least one,
and then none has more than two. So these keys find every pair:

- one segment as it is, with a key of another: six families;
- a key of each of the three segments: one family.

Keys are 35 and 36 bits long, so that chance meetings stay rare for billions
of fingerprints. Equal fingerprints are one node from the start. Nodes that meet
under a key are compared in full; of those within the distance only as many links
go on as it takes to connect them, so a dense group gives no more links than members.

Keys with more than ``dense_run`` fingerprints are not compared by one task. Their fingerprints
meet at centres instead: words at most two bits from each, which any pair within four bits
has in common. A centre has at most 2,081 words around it, however many copies there are,
so these groups need no further split. The hottest keys are known from a sample of the
fingerprints and are not shuffled at all; others are passed on as the run is read.
The sample only decides the way: both ways find every pair.

Empty and NULL texts have the fingerprint zero, which links like any other. A text
of fewer words than a shingle is one shingle. Repeated rows share a fingerprint and
a component. NULL ids are not counted for the smallest id; a component with no other
id has a NULL one. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, permutations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .links import components
from .tables import stored, utf8

SEED = 42
#: Generator polynomial of the binary Golay code (23, 12).
GOLAY = 0b101011100011
SEGMENTS = ((41, 23), (18, 23), (0, 18))  # shift and width
MAX_BITS = 4
#: Fingerprints of one key that a task compares; more meet at centres.
DENSE_RUN = 8192
#: Of so many fingerprints one is sampled to find hot keys.
SAMPLED = 64
#: Keys that may be called hot before the shuffle: 512 KB.
MOST_HOT = 65536


def _golay_errors() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error patterns of at most four bits (-1: no more), and how many."""
    bit = np.zeros(23, np.int64)
    for i in range(23):
        word = 1 << i
        for j in range(22, 10, -1):
            if word >> j & 1:
                word ^= GOLAY << (j - 11)
        bit[i] = word
    table = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)

    def walk(start: int, pattern: int, syndrome: int, weight: int) -> None:
        table[syndrome, filled[syndrome]] = pattern
        filled[syndrome] += 1
        if weight < 4:
            for i in range(start, 23):
                walk(i + 1, pattern | 1 << i, syndrome ^ int(bit[i]), weight + 1)

    walk(0, 0, 0, 0)
    return table, filled


_ERRORS, _N_ERRORS = _golay_errors()


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.copy()
    for j in range(22, 10, -1):
        rest ^= np.where(rest >> j & 1, GOLAY << (j - 11), 0)
    return rest


def golay_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (n, 6) of the codewords within four bits of 23-bit words, -1 where none; counts."""
    syndrome = _syndrome(words)
    errors = _ERRORS[syndrome]
    return np.where(errors >= 0, (words[:, None] ^ errors) >> 11, -1), _N_ERRORS[syndrome]


def join_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): all keys of 64-bit fingerprints; a key's family is in its low bits."""
    segments, fuzzy = [], []
    for shift, width in SEGMENTS:
        value = (prints >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
        segments.append(value)
        fuzzy.append(golay_keys(value << (23 - width))[0])
    rows, keys = [], []
    for family, (i, j) in enumerate(permutations(range(3), 2)):
        row, which = np.nonzero(fuzzy[j] >= 0)
        rows.append(row)
        keys.append((segments[i][row] << 12 | fuzzy[j][row, which]) << 3 | family)
    a, b, c = fuzzy
    whole = (a[:, :, None, None] << 24) | (b[:, None, :, None] << 12) | c[:, None, None, :]
    there = (a[:, :, None, None] >= 0) & (b[:, None, :, None] >= 0) & (c[:, None, None, :] >= 0)
    row = np.nonzero(there)[0]
    rows.append(row)
    keys.append(whole[there] << 3 | 6)
    return np.concatenate(rows), np.concatenate(keys)


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of the word shingles of a text, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - shingle + 1, 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())],
        np.uint64,
        n,
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array(
            [fingerprint(t, shingle) for t in utf8(batch.column("text"))], np.uint64
        )
        others = batch.drop_columns(["text"])
        yield pa.record_batch(
            [*others.columns, prints.view(np.int64)], [*others.schema.names, "fingerprint"]
        )


def _keyed(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Keys that are not among the sorted hot ones, with their fingerprints."""
    for prints in _parts(batches, 4096):
        rows, keys = join_keys(prints.view(np.uint64))
        cold = ~_among(keys, hot)
        yield pa.record_batch([keys[cold], prints[rows[cold]]], ["key", "fingerprint"])


def _with_hot_keys(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Fingerprints with a hot key."""
    for prints in _parts(batches, 4096):
        rows, keys = join_keys(prints.view(np.uint64))
        yield pa.record_batch([prints[np.unique(rows[_among(keys, hot)])]], ["fingerprint"])


def _centred(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Fingerprints under each word at most ``radius`` bits away."""
    bits = [1 << i for i in range(64)]
    errors = np.array(
        [sum(chosen) for n in range(radius + 1) for chosen in combinations(bits, n)], np.uint64
    )
    for prints in _parts(batches, 32):
        centres = (prints.view(np.uint64)[:, None] ^ errors).view(np.int64)
        yield pa.record_batch(
            [centres.ravel(), np.repeat(prints, len(errors))], ["key", "fingerprint"]
        )


def _parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[np.ndarray]:
    for batch in batches:
        prints = batch.column("fingerprint").to_numpy(zero_copy_only=False)
        for i in range(0, len(prints), rows):
            yield prints[i : i + rows]


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of the values are in a sorted array."""
    if not len(some):
        return np.zeros(len(values), bool)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


def _spanning(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links enough to connect those of the distinct fingerprints that are near each other.

    From each fingerprint not reached yet the near ones are followed breadth first;
    what is reached is not looked at again.
    """
    left = np.unique(prints)
    links = []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= max_bits
            found = left[near]
            links.extend((int(at), int(x)) for x in found)
            front.extend(found)
            left = left[~near]
    return links


def _meetings(
    batches: Iterator[pa.RecordBatch], max_bits: int, dense_run: int
) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal keys; the rows come sorted by key.

    Of runs longer than ``dense_run`` each fingerprint is passed on with no other, batch by
    batch, so that no run is held whole.
    """
    few = 8
    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
    dense = None  # the key whose run is being passed on
    for batch in _with_end(batches):
        if batch is not None:
            key, new = batch.column("key").to_numpy(), batch.column("fingerprint").to_numpy()
            if dense is not None:
                passed = int(np.searchsorted(key, dense, "right"))
                yield _alone(new[:passed])
                key, new = key[passed:], new[passed:]
            keys, prints = np.concatenate([keys, key]), np.concatenate([prints, new])
            if not len(keys):
                continue
            dense = None
            # The last run may go on in the next batch.
            whole = int(np.searchsorted(keys, keys[-1]))
            if len(keys) - whole > dense_run:
                dense = keys[-1]
                yield _alone(prints[whole:])
                keys, prints = keys[:whole], prints[:whole]
        else:
            whole = len(keys)
        if not whole:
            continue
        k, p = keys[:whole], prints[:whole]
        keys, prints = keys[whole:], prints[whole:]
        a, b = [], []
        starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        lengths = np.diff(np.append(starts, len(k)))
        long = np.repeat(lengths > few, lengths)
        for step in range(1, few):
            near = (
                (k[step:] == k[:-step])
                & ~long[step:]
                & (np.bitwise_count((p[step:] ^ p[:-step]).view(np.uint64)) <= max_bits)
            )
            a.append(p[:-step][near])
            b.append(p[step:][near])
        for at, n in zip(starts[lengths > few], lengths[lengths > few]):
            if n > dense_run:
                yield _alone(p[at : at + n])
                continue
            links = np.array(_spanning(p[at : at + n], max_bits), np.int64).reshape(-1, 2)
            a.append(links[:, 0])
            b.append(links[:, 1])
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.record_batch([pairs[0], pairs[1]], ["a", "b"])


def _alone(prints: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([prints, pa.nulls(len(prints), pa.int64())], ["a", "b"])


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def near_links(
    prints: DataFrame, max_bits: int = MAX_BITS, dense_run: int = DENSE_RUN
) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints (column fingerprint) within the distance."""
    if max_bits > MAX_BITS:
        raise ValueError("the keys find pairs of at most four differing bits")
    prints = prints.select("fingerprint")
    hot = _hot_keys(prints, dense_run)
    met = stored(
        _met(prints.mapInArrow(lambda b: _keyed(b, hot), _KEYED), max_bits, dense_run)
    )
    passed_on = met.where("b IS NULL")
    if not len(hot) and passed_on.isEmpty():
        return met
    dense = passed_on.select(F.col("a").alias("fingerprint"))
    dense = dense.unionByName(
        prints.mapInArrow(lambda b: _with_hot_keys(b, hot), "fingerprint long")
    ).distinct()
    radius = -(-max_bits // 2)
    around = sum(comb(64, n) for n in range(radius + 1))
    # The rows may be in one small file; each of them becomes thousands.
    spread = dense.repartition(prints.sparkSession.sparkContext.defaultParallelism, "fingerprint")
    close = _met(spread.mapInArrow(lambda b: _centred(b, radius), _KEYED), max_bits, around)
    return met.where("b IS NOT NULL").unionByName(close).distinct()


_KEYED = "key long, fingerprint long"


def _met(keyed: DataFrame, max_bits: int, dense_run: int) -> DataFrame:
    """Distinct links (a, b) of fingerprints with a common key; b is NULL for those of dense keys."""
    return (
        keyed.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda b: _meetings(b, max_bits, dense_run), "a long, b long")
        .distinct()
    )


def _hot_keys(prints: DataFrame, dense_run: int) -> np.ndarray:
    """Sorted keys that by a sample have several times ``dense_run`` fingerprints; the hottest ones.

    A fingerprint has about 180 keys, so those left out have less than 0.3% of all fingerprints.
    """
    sample = prints.where(F.pmod(F.xxhash64("fingerprint"), F.lit(SAMPLED)) == 0)
    none = np.zeros(0, np.int64)
    counts = sample.mapInArrow(lambda b: _keyed(b, none), _KEYED).groupBy("key").agg(
        F.count("*").alias("n")
    )
    hottest = counts.where(F.col("n") * SAMPLED > 4 * dense_run).orderBy(F.desc("n"), "key")
    return np.sort(np.array([r["key"] for r in hottest.limit(MOST_HOT).collect()], np.int64))


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """``nodes`` (fingerprint and others) with the root of each one's component."""
    roots = components(near_links(nodes, max_bits))
    labelled = nodes.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).withColumn("root", F.coalesce("root", "fingerprint"))
    return stored(labelled)


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (long) and component_id of every row of ``docs`` (doc_id, text)."""
    marked = stored(
        docs.select("doc_id", "text").mapInArrow(
            lambda batches: _fingerprints(batches, shingle), "doc_id long, fingerprint long"
        )
    )
    nodes = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    labelled = _rooted(nodes, max_bits)
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = labelled.join(least, "root").select("fingerprint", "component_id")
    return marked.join(found, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per component, with all its columns.

    It is the row with the smallest id; NULL ids come last, and of rows with the same id the
    first of the table comes first. Components are told apart by their fingerprints, so
    an id that stands in several of them keeps a row in each.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("simhash_row"), row))
    marked = numbered.select("row.doc_id", "simhash_row", "row.text").mapInArrow(
        lambda batches: _fingerprints(batches, shingle),
        "doc_id long, simhash_row long, fingerprint long",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "simhash_row"))
    nodes = stored(marked.groupBy("fingerprint").agg(first.alias("first")))
    kept = _rooted(nodes, max_bits).groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.simhash_row").alias("simhash_row"))
    return numbered.join(kept, "simhash_row", "left_semi").select("row.*")


def hex_digits(column):
    return F.lpad(F.lower(F.hex(column)), 16, "0")
