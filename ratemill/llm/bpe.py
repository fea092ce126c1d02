"""Byte-level BPE encoding and decoding with a lexicon of frequent words.

A text is cut into words by the tokenizer's pattern. The most frequent words of
the corpus are encoded once by exact merging and compiled into a minimal acyclic
transducer (``lexicon``) that yields their token ids; it is bounded by
``most_words``, sent to the executors as a file and mapped into memory there. Words
that it does not hold are merged exactly where they occur.

A word never spans the start of a run of white space that follows other
characters, so texts are first cut there, and every distinct piece of a batch is
encoded once. The texts of added tokens are cut out of a piece before the
pattern is applied and give the added token's id, as the library does.

A NULL text is encoded as an empty one: no tokens. Texts of any length are
encoded whole; a word of any length is merged in n log n steps. Repeated rows are
encoded each. An empty table gives an empty lexicon and no rows.
Extra columns are kept by ``encode``, ``decode`` and ``encode_and_decode``, which replace columns of the names they add, and
are not read otherwise.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5, sha256
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from ratemill.session import shared_dir

from .lexicon import Lexicon, compile_lexicon
from .tables import slices, stored

#: The pattern of byte-level BPE of this family (fixed by the vocabulary's format), for letters and numbers.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{L}{N}]+|\s+(?!\S)|\s+"""
#: Unicode white space, and a cut before each run of it.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


#: A word and marks behind it, without the full pattern: letters that every Unicode version has.
PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ž]+)([.,;:!?]*)")

#: Characters that are worked on at a time, and the lengths to which words merged together are filled.
CHUNK = 1 << 21
WIDTHS = (8, 16, 32, 64)


@lru_cache(1)
def word_pattern() -> regex.Pattern:
    """The pattern with the letters and numbers that the tokenizers library knows.

    Packages have Unicode tables of different age. For characters that ``regex`` knows and
    ``unicodedata`` does not, the library is asked: it joins a letter to a letter and a number to a number.
    """
    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    classes = {}
    for kind, before in (("L", "a"), ("N", "1")):
        found = regex.findall(rf"\p{{{kind}}}", every)
        unsure = [c for c in found if unicodedata.category(c) == "Cn"]
        unknown = [ord(c) for c in unsure if len(split(before + c)) > 1]
        starts = [c for c, last in zip(unknown, [-1, *unknown]) if c != last + 1]
        ends = [c for c, following in zip(unknown, [*unknown[1:], -1]) if c != following - 1]
        ranges = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))
        classes[kind] = rf"[\p{{{kind}}}--[{ranges}]]" if ranges else rf"\p{{{kind}}}"
    return regex.compile(WORDS.replace("{L}", classes["L"]).replace("{N}", classes["N"]), regex.V1)


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    rest = (b for b in range(256) if b not in set(plain))
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Lists:
    """Lists of numbers, one after another in ``flat``."""

    def __init__(self, flat: np.ndarray, counts: np.ndarray) -> None:
        self.flat, self.counts, self.ends = flat, counts, np.cumsum(counts)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i] - self.counts[i] : self.ends[i]]

    def take(self, order: np.ndarray) -> Lists:
        """The lists of these numbers, in this order."""
        counts = self.counts[order]
        shift = (self.ends - self.counts)[order] - (np.cumsum(counts) - counts)
        return Lists(self.flat[np.arange(int(counts.sum())) + np.repeat(shift, counts)], counts)

    def within(self, sizes: np.ndarray) -> Lists:
        """So many lists each as one."""
        edges = np.concatenate([[0], self.ends])[np.concatenate([[0], np.cumsum(sizes)])]
        return Lists(self.flat, np.diff(edges))


def joined(lists: list[Lists]) -> Lists:
    return Lists(
        np.concatenate([x.flat for x in lists]), np.concatenate([x.counts for x in lists])
    )


class Tokenizer:
    """Vocabulary, merges and added tokens of a tokenizers file."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        kind = (spec["model"]["type"], spec["pre_tokenizer"]["type"], spec["normalizer"])
        if kind != ("BPE", "ByteLevel", None) or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level BPE without a normalizer or prefix space is read")
        letters = _byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.bytes_of = {
            i: bytes(letters[c] for c in token) if all(c in letters for c in token)
            else token.encode()
            for token, i in vocabulary.items()
        }
        self.byte_ids = [0] * 256
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocabulary[letter]
        self.merges, joined = {}, []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocabulary[a], vocabulary[b]] = rank
            joined.append(vocabulary[a + b])
        self.added = {}
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"]:
                raise ValueError("added tokens with their own spacing rules are not read")
            self.added[token["content"]] = token["id"]
            self.bytes_of[token["id"]] = token["content"].encode()
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.joined, self.bytes_at = np.array(joined, np.int32), np.array(self.byte_ids, np.int32)
        #: Stands for no token behind a word's end; no pair holds it.
        self.nothing = max(self.bytes_of) + 1
        pairs = np.array(list(self.merges), np.int64).reshape(-1, 2)
        keys = pairs[:, 0] * (self.nothing + 1) + pairs[:, 1]
        self.ranks = np.argsort(keys).astype(np.int32)
        self.pairs = np.append(keys[self.ranks], np.iinfo(np.int64).max)
        self.ranks = np.append(self.ranks, np.int32(len(joined)))
        self.written = pa.array([f"{i},".encode() for i in range(self.nothing)], pa.large_binary())
        self.decoded = pa.array(
            [self.bytes_of.get(i, b"") for i in range(self.nothing)], pa.large_binary()
        )

    def merge(self, words: list[bytes]) -> Lists:
        """Token ids of words: the lowest-ranked pair is joined, leftmost first, until none is left.

        Words of similar length go step by step together, very long ones by themselves.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends, text = np.cumsum(lengths), np.frombuffer(b"".join(words), np.uint8)
        order, merged, low = [np.flatnonzero(lengths == 0)], [], 0
        for width in WIDTHS:
            which = np.flatnonzero((lengths > low) & (lengths <= width))
            for some in np.array_split(which, len(which) * width // CHUNK + 1):
                inside = np.arange(width) < lengths[some, None]
                ids = np.full(inside.shape, self.nothing, np.int32)
                at = ((ends - lengths)[some, None] + np.arange(width))[inside]
                ids[inside] = self.bytes_at[text[at]]
                ids = self._merge_together(ids)
                left = ids != self.nothing
                order.append(some)
                merged.append(Lists(ids[left], left.sum(1)))
            low = width
        for i in np.flatnonzero(lengths > low):
            ids = np.array(self._merge_long([self.byte_ids[b] for b in words[i]]), np.int32)
            order.append(np.array([i]))
            merged.append(Lists(ids, np.array([len(ids)])))
        empty = Lists(np.zeros(0, np.int32), np.zeros(len(order[0]), np.int64))
        return joined([empty, *merged]).take(np.argsort(np.concatenate(order)))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs, the number of merges for those that are not joined."""
        wanted = a.astype(np.int64) * (self.nothing + 1) + b
        at = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[at] == wanted, self.ranks[at], self.ranks[-1])

    def _merge_together(self, ids: np.ndarray) -> np.ndarray:
        """One word a row, filled with nothing. A step joins one pair of every row that has one."""
        out, rows = np.full_like(ids, self.nothing), np.arange(len(ids))
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        while True:
            if ranks.shape[1] == 0:
                out[rows, : ids.shape[1]] = ids
                return out
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            more = best < self.ranks[-1]
            out[rows[~more], : ids.shape[1]] = ids[~more]
            rows, ids, ranks, at, best = rows[more], ids[more], ranks[more], at[more], best[more]
            if not len(rows):
                return out
            line = np.arange(len(rows))
            ids[line, at] = self.joined[best]
            keep = np.ones(ids.shape, bool)
            keep[line, at + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(ranks.shape, bool)
            keep[line, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            i = np.flatnonzero(at > 0)
            ranks[i, at[i] - 1] = self._ranks(ids[i, at[i] - 1], ids[i, at[i]])
            i = np.flatnonzero(at < ranks.shape[1])
            ranks[i, at[i]] = self._ranks(ids[i, at[i]], ids[i, at[i] + 1])

    def _merge_long(self, ids: list[int | None]) -> tuple[int, ...]:
        """The same with a queue of pairs; those that have changed since are passed over."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        find = self.merges.get
        queue = [
            (rank, i, pair)
            for i, pair in enumerate(zip(ids, ids[1:]))
            if (rank := find(pair)) is not None
        ]
        heapq.heapify(queue)
        while queue:
            rank, i, pair = heapq.heappop(queue)
            j = after[i]
            if ids[i] is None or j >= len(ids) or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = int(self.joined[rank]), None
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else len(ids)
                if right < len(ids):
                    pair = (ids[left], ids[right])
                    if (rank := find(pair)) is not None:
                        heapq.heappush(queue, (rank, left, pair))
        return tuple(i for i in ids if i is not None)

    def parts(self, piece: str) -> list[tuple[str, int | None]]:
        """Words of a piece, and added tokens with their ids."""
        if not any(map(piece.__contains__, self.added)):
            return [(word, None) for word in word_pattern().findall(piece)]
        found = []
        for n, text in enumerate(self.cut.split(piece)):
            if n % 2:
                found.append((text, self.added[text]))
            else:
                found.extend((word, None) for word in word_pattern().findall(text))
        return found


@lru_cache(2)
def load_tokenizer(text: str) -> Tokenizer:
    return Tokenizer(text)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[slice, list[str]]]:
    """The texts of a batch, some at a time."""
    column = batch.column("text")
    for part in slices(pc.fill_null(pc.binary_length(column), 0).to_pylist(), CHUNK):
        yield part, ["" if x is None else x for x in column[part].to_pylist()]


def _word_counts(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    """Words with their counts, in parts of bounded size."""
    tokenizer, pieces = load_tokenizer(spec), Counter()
    for batch in batches:
        for _, texts in _parts(batch):
            for text in texts:
                pieces.update(PIECES.findall(text))
            if len(pieces) > 100_000:
                yield _counted(pieces, tokenizer)
                pieces = Counter()
    if pieces:
        yield _counted(pieces, tokenizer)


def _counted(pieces: Counter, tokenizer: Tokenizer) -> pa.RecordBatch:
    total = Counter()
    for piece, n in pieces.items():
        if plain := PLAIN.fullmatch(piece):
            for word in filter(None, plain.groups()):
                total[word] += n
        else:
            for word, added in tokenizer.parts(piece):
                if added is None:
                    total[word] += n
    words = pa.array(list(total), pa.string()).cast(pa.binary())
    return pa.record_batch([words, pa.array(total.values(), pa.int64())], ["word", "n"])


def _merged(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    tokenizer = load_tokenizer(spec)
    for batch in batches:
        ids = tokenizer.merge(batch.column("word").to_pylist())
        yield pa.record_batch([batch.column("word"), _arrow(ids)], ["word", "ids"])


def _arrow(lists: Lists) -> pa.ListArray:
    edges = np.concatenate([[0], lists.ends])
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(lists.flat, pa.int32()))


def build_lexicon(docs: DataFrame, spec: str, most_words: int = 1 << 17, longest: int = 64) -> str:
    """Compile the most frequent words of all texts; the name of the file sent to the executors.

    At most ``most_words`` words of at most ``longest`` bytes come to the driver. They are those above a
    count, which is found from the number of words per size class of the count (sixteenths of a
    doubling, about a thousand rows), so nothing is sorted. Words of a class that does not fit in whole stay out.
    """
    spark = docs.sparkSession
    words = docs.select("text").mapInArrow(
        lambda batches: _word_counts(batches, spec), "word binary, n long"
    )
    counts = stored(
        words.where(F.octet_length("word") <= longest)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .withColumn("class", F.floor(F.log2("n") * 16).cast("int"))
    )
    left, least = most_words, None
    for row in sorted(counts.groupBy("class").count().collect(), key=lambda r: -r["class"]):
        if row["count"] > left:
            break
        left, least = left - row["count"], row["class"]
    frequent = counts.where(F.lit(False) if least is None else F.col("class") >= least)
    rows = frequent.select("word").mapInArrow(
        lambda batches: _merged(batches, spec), "word binary, ids array<int>"
    ).toArrow()
    entries = {
        word: tuple(ids)
        for word, ids in zip(rows.column("word").to_pylist(), rows.column("ids").to_pylist())
    }
    return _publish(spark, compile_lexicon(entries))


def _publish(spark: SparkSession, data: bytes) -> str:
    """Write a small file to the shared folder and have every executor fetch it."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}.lexicon")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(path)
    out.write(data)
    out.close()
    spark.sparkContext.addFile(path.toString())
    return path.getName()


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Encoder:
    """Encodes the pieces of a batch, distinct ones once."""

    def __init__(self, spec: str, lexicon: Lexicon) -> None:
        self.tokenizer, self.lexicon = load_tokenizer(spec), lexicon

    def word_ids(self, words: list[bytes]) -> Lists:
        """Token ids of words: from the lexicon, or merged where it does not hold them."""
        at = self.lexicon.numbers(words)
        known, new = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        ids = self.tokenizer.merge([words[i] for i in new.tolist()])
        if len(known):
            found = Lists(self.lexicon.ids, np.diff(self.lexicon.offsets)).take(at[known])
            ids = joined([ids, Lists(found.flat.astype(np.int32), found.counts)])
        return ids.take(np.argsort(np.concatenate([new, known])))

    def piece_ids(self, pieces: list[str]) -> Lists:
        """Token ids of each piece."""
        numbers: dict[str | int, int] = defaultdict(count().__next__)
        added_ids = list(dict.fromkeys(self.tokenizer.added.values()))
        for i in added_ids:
            numbers[i]
        flat, counts = [], []
        for piece in pieces:
            if plain := PLAIN.fullmatch(piece):
                word, marks = plain.groups()
                flat.append(numbers[word])
                if marks:
                    flat.append(numbers[marks])
                counts.append(2 if marks else 1)
            else:
                parts = self.tokenizer.parts(piece)
                flat += [numbers[word if added is None else added] for word, added in parts]
                counts.append(len(parts))
        words = [word.encode() for word in list(numbers)[len(added_ids) :]]
        added = Lists(np.array(added_ids, np.int32), np.ones(len(added_ids), np.int64))
        ids = joined([added, self.word_ids(words)]).take(np.array(flat, np.int64))
        return ids.within(np.array(counts, np.int64))

    def batch(self, texts: list[str]) -> tuple[Lists, np.ndarray, np.ndarray]:
        """Ids of the distinct pieces, the piece numbers of all texts in a row, pieces per text."""
        numbers: dict[str, int] = defaultdict(count().__next__)
        split = [PIECES.findall(text) for text in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        each = map(numbers.__getitem__, chain.from_iterable(split))
        order = np.fromiter(each, np.int64, int(sizes.sum()))
        return self.piece_ids(list(numbers)), order, sizes


@lru_cache(2)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def _hashes(
    tokens: pa.Array, ids: Lists, order: np.ndarray, sizes: np.ndarray, cut: int, digest=sha256
) -> list[str]:
    """A digest of the tokens' bytes joined, per text, without the last ``cut`` bytes."""
    pieces = Lists(*_bytes(tokens.take(pa.array(ids.flat)))).within(ids.counts)
    edges = pa.py_buffer(np.concatenate([[0], pieces.ends]))
    values = pa.Array.from_buffers(
        pa.large_binary(), len(pieces.ends), [None, edges, pa.py_buffer(pieces.flat)]
    )
    texts = Lists(*_bytes(values.take(pa.array(order)))).within(sizes)
    view = memoryview(texts.flat)
    return [
        digest(view[b - n : max(b - cut, b - n)]).hexdigest()
        for b, n in zip(texts.ends.tolist(), texts.counts.tolist())
    ]


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of bytes that starts its buffers, and the length of each."""
    _, offsets, data = values.buffers()
    edges = np.frombuffer(offsets, np.int64)[: len(values) + 1] if len(values) else np.zeros(1, np.int64)
    return np.frombuffer(data or b"", np.uint8)[: edges[-1]], np.diff(edges)


def _digests(batches: Iterator[pa.RecordBatch], spec: str, name: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(spec, _lexicon(name))
    tokenizer = encoder.tokenizer
    for batch in batches:
        for part, texts in _parts(batch):
            ids, order, sizes = encoder.batch(texts)
            counts = np.concatenate([[0], np.cumsum(ids.counts[order])])
            edges = np.concatenate([[0], np.cumsum(sizes)])
            yield pa.record_batch(
                [
                    batch.column("doc_id")[part],
                    np.diff(counts[edges]),
                    pa.array(_hashes(tokenizer.written, ids, order, sizes, 1)),
                    pa.array(_hashes(tokenizer.decoded, ids, order, sizes, 0)),
                ],
                [field.split()[0] for field in RESULT.split(", ")],
            )


def encode_digests(docs: DataFrame, spec: str, lexicon: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every row (doc_id, text).

    The decoded text is made from the ids. Word boundaries never split a character
    of the input, so bytes joined over the whole text are valid UTF-8.
    """
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _digests(batches, spec, lexicon), RESULT
    )


def _encoded(batches: Iterator[pa.RecordBatch], spec: str, name: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(spec, _lexicon(name))
    for batch in batches:
        for part, texts in _parts(batch):
            ids, order, sizes = encoder.batch(texts)
            tokens = _arrow(ids.take(order).within(sizes))
            yield pa.RecordBatch.from_arrays(
                [*(c[part] for c in batch.columns), tokens],
                names=[*batch.schema.names, "token_ids"],
            )


def encode(docs: DataFrame, spec: str, lexicon: str) -> DataFrame:
    """The rows with ``token_ids`` added (a column of that name is replaced)."""
    docs = docs.drop("token_ids")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(
        lambda batches: _encoded(batches, spec, lexicon), f"{fields}, token_ids array<int>"
    )


def _round_trip(batches: Iterator[pa.RecordBatch], spec: str, name: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(spec, _lexicon(name))
    for batch in batches:
        others = batch.drop_columns(["text"])
        for part, texts in _parts(batch):
            ids, order, sizes = encoder.batch(texts)
            tokens = _arrow(ids.take(order).within(sizes))
            decoded = pa.array(_hashes(encoder.tokenizer.decoded, ids, order, sizes, 0, md5), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(c[part] for c in others.columns), tokens, decoded],
                names=[*others.schema.names, "token_ids", "decoded_md5"],
            )


def encode_and_decode(docs: DataFrame, spec: str, lexicon: str) -> DataFrame:
    """The rows without their text, with ``token_ids`` and the MD5 of the text that these decode to.

    One step does both, so a task has one worker and one vocabulary; bytes are joined some texts at
    a time. Columns of the added names are replaced, others are kept.
    """
    docs = docs.drop("token_ids", "decoded_md5")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.drop("text").schema)
    return docs.mapInArrow(
        lambda batches: _round_trip(batches, spec, lexicon),
        ", ".join(filter(None, [fields, "token_ids array<int>, decoded_md5 string"])),
    )


def _decoded(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    tokens = load_tokenizer(spec).decoded
    for batch in batches:
        lists = batch.column("token_ids")
        counts = pc.fill_null(pc.list_value_length(lists), 0)
        for part in slices(counts.to_pylist(), CHUNK):
            ids, n = pc.list_flatten(lists[part]), counts[part].to_numpy()
            pieces = Lists(*_bytes(tokens.take(ids))).within(n.astype(np.int64))
            view = memoryview(pieces.flat)
            texts = [
                str(view[end - size : end], "utf-8", "replace")
                for end, size in zip(pieces.ends.tolist(), pieces.counts.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*(c[part] for c in batch.columns), pa.array(texts, pa.string())],
                names=[*batch.schema.names, "decoded"],
            )


def decode(tokens: DataFrame, spec: str) -> DataFrame:
    """The rows with ``decoded``, the text of ``token_ids``; invalid UTF-8 is replaced."""
    tokens = tokens.drop("decoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tokens.schema)
    return tokens.mapInArrow(
        lambda batches: _decoded(batches, spec), f"{fields}, decoded string"
    )
