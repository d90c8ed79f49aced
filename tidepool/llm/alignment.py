"""Cross-tokenizer alignment with corpus-wide counts of linked id pairs.

Two tokenizers cut the same bytes differently. Byte offsets where tokens of both end
cut a document into groups; an A token and a B token are linked where their byte
ranges overlap. The count of an id pair is the number of documents that hold it
linked.

The first pass aligns all documents and gives the distinct pairs. They are divided by
hash into parts, and each part gets a minimal perfect hash of its pairs: a pair's
number, without a table of pairs to search. The counting pass adds up, per task, one
dense vector indexed by these numbers, and the vectors are summed as a tree. The last
pass aligns the documents again and looks the counts up; the pair stored under a number
must be the pair looked for.

Parts go to the tasks in groups of at most ``GROUP_KEYS`` pairs; with more pairs, the
documents are passed over once for each group and the shares of a document added up.

Texts are encoded once; their ids are kept in the shared folder, and the passes align
many documents at a time, as arrays.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import held, staged, table

# Pairs in a part, whose hash one task builds, and in a group of parts, which is broadcast.
PART_KEYS = 1 << 20
GROUP_KEYS = 1 << 22
SLOTS = 4096
# Counts that are shuffled together, and the number of lots in which tasks' counts are first added.
SPAN = 1 << 16
FAN_IN = 64
# Places of a hash level for each key left, and the levels before the rest is searched for.
ROOM, LEVELS = 1.5, 24
# Tokens aligned together; ids are kept in 16 bits, which both vocabularies fit.
TOGETHER = 1 << 17
KIND = np.dtype("<u2")
IDS = 1 << 16


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of 64-bit keys (the finaliser of a splitmix generator)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def slot_of(keys: np.ndarray) -> np.ndarray:
    """Slot 0 .. SLOTS - 1 of each key; parts are runs of slots."""
    return (mixed(keys, 0) % np.uint64(SLOTS)).astype(np.int32)


class MinimalHash:
    """A minimal perfect hash: distinct keys to 0 .. n - 1, each to its own number.

    On every level, keys that alone hash to a place have it marked; the others go on to
    the next level. A key's number is the count of marks before its own. Keys that are
    left after the last level (none, but for chance) are numbered in order.
    """

    def __init__(self, keys: np.ndarray):
        self.n, self.levels, left, done = len(keys), [], np.unique(keys.astype(np.uint64)), 0
        if len(left) != len(keys):
            raise ValueError("keys must be distinct")
        while len(left) and len(self.levels) < LEVELS:
            size = max(64, int(len(left) * ROOM))
            place = self._place(left, len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            marks = np.packbits(alone, bitorder="little")
            words = np.frombuffer(marks.tobytes() + b"\0" * (-len(marks) % 8), dtype=np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]) + done
            self.levels.append((size, words, before))
            done = int(before[-1])
            left = left[~alone[place]]
        self.rest, self.done = left, done

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mixed(keys, level + 1) % np.uint64(size)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of known keys; others get any number, or -1."""
        keys = keys.astype(np.uint64)
        out, todo = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (size, words, before) in enumerate(self.levels):
            place = self._place(keys[todo], level, size)
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            marked = (words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[marked]] = (before[word] + below)[marked]
            todo = todo[~marked]
        if len(self.rest) and len(todo):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            found = self.rest[at] == keys[todo]
            out[todo[found]] = self.done + at[found]
        return out


class Numbers:
    """Numbers of the pairs of one group of parts, with the pair under each number."""

    def __init__(self, parts: list[tuple[int, int, MinimalHash, np.ndarray]]):
        """``parts``: first and last slot, hash, and pairs by number."""
        self.parts = parts
        self.base = np.concatenate([[0], np.cumsum([h.n for _, _, h, _ in parts])]).astype(np.int64)
        self.part_of = np.full(SLOTS, -1, dtype=np.int64)
        for i, (a, b, _, _) in enumerate(parts):
            self.part_of[a:b + 1] = i
        self.n = int(self.base[-1])

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        """Number of each pair, or -1 where it is none of this group's."""
        out, part = np.full(len(pairs), -1, dtype=np.int64), self.part_of[slot_of(pairs)]
        for i in np.unique(part[part >= 0]).tolist():
            here = np.flatnonzero(part == i)
            _, _, number, held = self.parts[i]
            k = number(pairs[here])
            known = (k >= 0) & (held[np.maximum(k, 0)] == pairs[here])
            out[here[known]] = self.base[i] + k[known]
        return out

    def pairs(self) -> np.ndarray:
        return np.concatenate([p[3] for p in self.parts]) if self.parts else np.zeros(0, dtype=np.int64)


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for
    themselves, the others in order for the letters from code point 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


# Characters on whose kinds all pattern engines agree, in runs that a plain merge loop handles well.
_ODD = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-\u024f]")
_LONG_RUN = 500
_LONG_GAP = re.compile(r"\s{500}")
# Room that a worker keeps for the units of B it has met: their characters and so many for each.
UNITS_ROOM, UNIT_ROOM = 16 << 20, 64


def is_odd(text: str) -> bool:
    """Whether a text is encoded by the named tokenizers themselves, whole, not by ranks and units."""
    if _ODD.search(text):
        return True
    words = text.split()
    if words and len(max(words, key=len)) >= _LONG_RUN:
        return True
    gaps = len(text) - sum(map(len, words))
    return gaps - len(words) >= _LONG_RUN - 2 and _LONG_GAP.search(text) is not None


class Encoder:
    """Ids of whole texts under both tokenizers, and the bytes of each id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        letters, vocabulary = byte_letters(), self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.bytes_a[i] = bytes(letters[c] for c in token)
        # The same vocabulary by rank, for texts of common characters: several times as fast.
        special = self.a.get_added_tokens_decoder()
        ranks = {x: i for i, x in enumerate(self.bytes_a) if x and i not in special}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.bytes_b.append(bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode())
        # Where a space can only begin a piece, no piece reaches over a space: what lies between is encoded alone.
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.parted = all("▁" not in p.lstrip("▁") for p in pieces)
        self.begins = np.array([p.startswith("▁") for p in pieces])
        self.units: dict[str, bytes] = {}
        self.used = 0

    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each id of A and of B."""
        return tuple(np.array([len(x) for x in tokens], dtype=np.uint16) for tokens in (self.bytes_a, self.bytes_b))

    def _checked(self, text: str, ids: list[int]) -> bytes:
        """B ids packed; none where their bytes are not a space and the text."""
        same = b"".join([self.bytes_b[i] for i in ids]) == (" " + text).encode()
        return np.array(ids, dtype=KIND).tobytes() if same else b""

    def by_units(self, text: str) -> bytes:
        """B ids of a text, packed, from those of what lies between its spaces, remembered; units not met
        before are encoded together. None where a unit is empty or the tokenizer changes it: such a text
        must be encoded whole."""
        memory, units = self.units, text.split(" ")
        packed = list(map(memory.get, units))
        if None in packed:
            if self.used > UNITS_ROOM:
                memory.clear()
                self.used = 0
            new = [u for u in dict.fromkeys(units) if u not in memory]
            joined = " ".join(new)
            ids = self.b.encode(joined)
            whole, first = self._checked(joined, ids), np.flatnonzero(self.begins[ids]).tolist()
            if "" in new or not whole or len(first) != len(new):
                return b""
            edges = [i * KIND.itemsize for i in [*first, len(ids)]]
            memory.update(zip(new, [whole[a:b] for a, b in zip(edges, edges[1:], strict=False)], strict=True))
            self.used += len(joined) + UNIT_ROOM * len(new)
            packed = list(map(memory.get, units))
        return b"".join(packed)

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """As ``packed``, as lists."""
        return [tuple(np.frombuffer(x, dtype=KIND).tolist() for x in ids) for ids in self.packed(texts)]

    def packed(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """A ids of a space and the text and B ids of the text, packed; none if their bytes differ from a space and the text."""
        out = []
        for text in texts:
            if not text:
                out.append((b"", b""))
                continue
            whole, odd = " " + text, is_odd(text)
            b = (b"" if odd or not self.parted else self.by_units(text)) or self._checked(text, self.b.encode(text))
            a = self.a.encode(whole, add_special_tokens=False).ids if odd else self.fast.encode_ordinary(whole)
            same = b and b"".join([self.bytes_a[i] for i in a]) == whole.encode()
            out.append((np.array(a, dtype=KIND).tobytes(), b) if same else (b"", b""))
        return out


def encoder(paths: tuple[str, str]) -> Encoder:
    """This worker's encoder, kept from task to task."""
    return held(("tokenizers", paths), lambda: Encoder(*paths))


def encoded(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """``row, doc_id, a, b``: the ids of every document under both tokenizers, packed."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(paths)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                some = batch.slice(lo, 64)
                ids = enc.packed(some.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), *(pa.array([x[i] for x in ids], pa.binary()) for i in (0, 1))],
                    names=["doc_id", "a", "b"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, a binary, b binary") \
        .withColumn("row", F.monotonically_increasing_id())


class Aligned:
    """Some documents aligned: the tokens of all of them one after another, and how they meet.

    ``docs`` are the positions of those that have tokens. ``links`` has the pair of every
    link, ``link_doc`` its document; ``group_a`` and ``group_b`` the group of every token.
    """

    def __init__(self, a: list[bytes], b: list[bytes], lengths: tuple[np.ndarray, np.ndarray]):
        """Packed ids of each document under both tokenizers, and the bytes of each id of both."""
        self.n = len(a)
        self.docs = np.flatnonzero([len(x) > 0 for x in a])
        self.n_a, self.n_b = (np.array([len(x) // KIND.itemsize for x in ids], dtype=np.int64) for ids in (a, b))
        self.a, self.b = (np.frombuffer(b"".join(ids), dtype=KIND).astype(np.int64) for ids in (a, b))
        # Each document's last tokens end together, so offsets may run on from one to the next.
        self.end_a, self.end_b = (np.cumsum(n[ids], dtype=np.int64) for n, ids in zip(lengths, (self.a, self.b), strict=True))
        both = np.concatenate([self.end_a, self.end_b])
        both.sort(kind="stable")
        self.ends = both[np.append(both[1:] != both[:-1], True)] if len(both) else both
        self.at_a, self.at_b = np.searchsorted(self.end_a, self.ends), np.searchsorted(self.end_b, self.ends)
        # A link for each run of bytes between two neighbouring ends.
        self.links = (self.a[self.at_a] << 32) | self.b[self.at_b]

    def _doc(self, ends: np.ndarray) -> np.ndarray:
        """The document in which each of some ends lies."""
        last = self.end_a[np.cumsum(self.n_a[self.docs]) - 1]
        return self.docs[np.searchsorted(last, ends)]

    @cached_property
    def link_doc(self) -> np.ndarray:
        return self._doc(self.ends)

    @cached_property
    def n_links(self) -> np.ndarray:
        return np.bincount(self.link_doc, minlength=self.n)

    @cached_property
    def common(self) -> np.ndarray:
        """Ends of tokens of both sides, the ends of the groups."""
        return self.ends[(self.end_a[self.at_a] == self.ends) & (self.end_b[self.at_b] == self.ends)]

    @cached_property
    def n_groups(self) -> np.ndarray:
        return np.bincount(self._doc(self.common), minlength=self.n)

    @cached_property
    def group_a(self) -> np.ndarray:
        return np.searchsorted(self.common, self.end_a)

    @cached_property
    def group_b(self) -> np.ndarray:
        return np.searchsorted(self.common, self.end_b)

    def digests(self) -> list[str]:
        """Of each document the sha256 of its groups' ids, ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        texts = _texts()
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, dtype=bool)
                          for g in (self.group_a, self.group_b))
        # In order of groups, in a group A's tokens before B's, each followed by its mark.
        n = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        upto_a, upto_b = (np.concatenate([[0], np.cumsum(np.bincount(g, minlength=n))]) for g in (self.group_a, self.group_b))
        code = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        code[np.arange(len(self.a)) + upto_b[self.group_a]] = self.a + IDS * last_a
        code[np.arange(len(self.b)) + upto_a[self.group_b + 1]] = self.b + IDS * (2 + last_b)
        stop = np.cumsum(self.n_a + self.n_b).tolist()
        out, at = [], 0
        for end in stop:
            digest = hashlib.sha256()
            for lo in range(at, end, 1 << 16):
                hi = min(end, lo + (1 << 16))
                text = b"".join([texts[c] for c in code[lo:hi].tolist()])
                digest.update(text[:-1] if hi == end else text)
            out.append(digest.hexdigest() if end > at else "")
            at = end
        return out


_TEXTS: list[bytes] = []


def _texts() -> list[bytes]:
    """An id in decimal with the mark after it: of A within and at the end of a group, then of B."""
    if not _TEXTS:
        _TEXTS.extend(f"{i}{mark}".encode() for mark in ",|,;" for i in range(IDS))
    return _TEXTS


def _aligned(batches: Iterator[pa.RecordBatch], lengths: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """The documents aligned, about ``TOGETHER`` tokens at a time."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column("a")).to_numpy(zero_copy_only=False)) // (TOGETHER * KIND.itemsize)
        edges = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:], strict=False):
            some = batch.slice(lo, hi - lo)
            yield some, Aligned(some.column("a").to_pylist(), some.column("b").to_pylist(), lengths)


def distinct_pairs(tokens: DataFrame, lengths: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``slot, pair``: the distinct linked id pairs (A id << 32 | B id) of all documents."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(0, dtype=np.int64)
        for _, x in _aligned(batches, lengths):
            found = np.union1d(found, x.links)
        for lo in range(0, len(found), 1 << 16):
            some = found[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(slot_of(some)), pa.array(some)], names=["slot", "pair"])

    return tokens.select("a", "b").mapInArrow(pairs, "slot int, pair long").distinct()


def numbered(pairs: DataFrame, part_keys: int) -> DataFrame:
    """``first, last, n, hash, held``: a minimal perfect hash for each part of the pairs (slot, pair).

    Parts are runs of slots with at most ``part_keys`` pairs, or one slot.
    """
    sizes = pairs.groupBy("slot").count().orderBy("slot").collect()      # at most SLOTS rows
    bounds, size = [], 0
    for r in sizes:
        if bounds and size + r["count"] <= part_keys:
            bounds[-1][1], size = r["slot"], size + r["count"]
        else:
            bounds.append([r["slot"], r["slot"]])
            size = r["count"]
    if not bounds:
        return pairs.sparkSession.createDataFrame([], "first int, last int, n long, hash binary, held binary")
    starts = F.array(*[F.lit(a) for a, _ in bounds])
    last = dict(map(tuple, bounds))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["pair"].to_numpy()
        number = MinimalHash(keys)
        held = np.empty(len(keys), dtype=np.int64)
        held[number(keys)] = keys
        return pd.DataFrame({"first": [key[0]], "last": [last[key[0]]], "n": [len(keys)],
                             "hash": [zlib.compress(pickle.dumps(number), 1)], "held": [zlib.compress(held.tobytes(), 1)]})

    first = F.array_max(F.filter(starts, lambda a: a <= F.col("slot")))
    return pairs.select(first.alias("first"), "pair").groupBy("first").applyInPandas(
        build, "first int, last int, n long, hash binary, held binary")


def counted(tokens: DataFrame, numbers, n: int, lengths: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``span, counts``: in how many documents each numbered pair is linked, 64 Ki numbers a row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = numbers.value, np.zeros(n, dtype=np.int64)
        for _, x in _aligned(batches, lengths):
            pairs, at = np.unique(x.links, return_inverse=True)
            once = np.unique(x.link_doc * len(pairs) + at) if len(pairs) else np.zeros(0, dtype=np.int64)
            often = np.bincount(once % max(1, len(pairs)), minlength=len(pairs))
            k = number(pairs)
            total[k[k >= 0]] += often[k >= 0]
        lot = TaskContext.get().partitionId() % FAN_IN
        for lo in range(0, n, SPAN):
            some = total[lo:lo + SPAN]
            if some.any():
                yield pa.RecordBatch.from_pydict(
                    {"span": [lo // SPAN], "lot": [lot], "counts": [zlib.compress(some.tobytes(), 1)]},
                    pa.schema([("span", pa.int32()), ("lot", pa.int32()), ("counts", pa.binary())]))

    def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(zlib.decompress(c), dtype=np.int64) for c in rows["counts"])
        return pd.DataFrame({"span": [key[0]], "counts": [zlib.compress(total.tobytes(), 1)]})

    schema = "span int, counts binary"
    return (tokens.select("a", "b").mapInArrow(count, "span int, lot int, counts binary")
            .groupBy("span", "lot").applyInPandas(add, schema).groupBy("span").applyInPandas(add, schema))


def looked_up(tokens: DataFrame, known, lengths: tuple[np.ndarray, np.ndarray], shape: bool) -> DataFrame:
    """``row, doc_id``, each document's ``n_best, count_sum`` over this group's pairs, and with ``shape`` the
    numbers and digest of its tokens."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, counts, best = known.value
        for some, x in _aligned(batches, lengths):
            pairs, at = np.unique(x.links, return_inverse=True)
            k = number(pairs)
            often = np.where(k >= 0, counts[k], 0) if len(counts) else np.zeros(len(pairs), dtype=np.int64)
            highest = np.where(k >= 0, often == best[pairs >> 32], False)
            first = np.concatenate([[0], np.cumsum(x.n_links)])
            total = np.concatenate([[0], np.cumsum(often[at])])
            out = [np.bincount(x.link_doc, highest[at], minlength=x.n).astype(np.int64), total[first[1:]] - total[first[:-1]]]
            if shape:
                out += [x.n_a, x.n_b, x.n_groups, x.n_links, x.digests()]
            yield pa.RecordBatch.from_arrays([some.column("row"), some.column("doc_id"), *map(pa.array, out)],
                                             names=["row", "doc_id", *names])

    names = ["n_best", "count_sum", *(["n_a", "n_b", "n_groups", "n_links", "groups_sha256"] if shape else [])]
    return tokens.mapInArrow(look, "row long, doc_id long, n_best long, count_sum long" + (
        ", n_a long, n_b long, n_groups long, n_links long, groups_sha256 string" if shape else ""))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, part_keys: int = PART_KEYS,
          group_keys: int = GROUP_KEYS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) aligned between two tokenizers.

    Tokenizer A (byte-level) encodes a space and the text, B (pieces) the text, before
    which it puts a space itself; special tokens' names in a text are plain text.
    Returns ``doc_id, n_a, n_b`` (tokens), ``n_groups, n_links, n_best`` (links whose
    count is the highest of all pairs with their A id), ``count_sum`` (over links) and
    ``groups_sha256`` (see ``Aligned.groups``).

    Null and empty texts, and texts whose tokens' joined bytes differ from the space and
    the text, have no tokens: zeros and an empty digest. Repeated rows are documents
    each; a null doc_id is kept. Extra columns are ignored, and an empty table gives
    none. Whole texts are aligned, however long.
    """
    spark = docs.sparkSession
    paths = (path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model"))
    tokens = staged(spark, encoded(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                               F.col("text").cast("string").alias("text")), paths), "align-tokens")
    lengths = encoder(paths).lengths()
    pairs = staged(spark, distinct_pairs(tokens, lengths), "align-pairs")
    parts = staged(spark, numbered(pairs, part_keys), "align-parts")
    sizes = parts.select("first", "n").orderBy("first").collect()        # at most SLOTS rows
    groups, size = [[]], 0
    for r in sizes:
        if groups[-1] and size + r["n"] > group_keys:
            groups.append([])
            size = 0
        groups[-1].append(r["first"])
        size += r["n"]
    # The highest count of an A id is as long as A's vocabulary; a group's counts are within its bound.
    best, held = np.zeros(1, dtype=np.int64), []
    for g in groups:
        numbers = _numbers(parts, g)
        totals = staged(spark, counted(tokens, spark.sparkContext.broadcast(numbers), numbers.n, lengths), "align-counts")
        counts = _counts(totals, numbers.n)
        a = numbers.pairs() >> 32
        best = np.concatenate([best, np.zeros(max(0, int(a.max(initial=0)) + 1 - len(best)), dtype=np.int64)])
        np.maximum.at(best, a, counts)
        held.append((g, totals))
    shares = []
    for i, (g, totals) in enumerate(held):
        numbers = _numbers(parts, g)
        known = spark.sparkContext.broadcast((numbers, _counts(totals, numbers.n), best))
        shares.append(looked_up(tokens, known, lengths, shape=i == 0))
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if len(shares) == 1:
        return shares[0].select(*out)
    first, *more = (staged(spark, s, "align-shares") for s in shares)
    rest = more[0]
    for s in more[1:]:
        rest = rest.unionByName(s)
    rest = rest.groupBy("row").agg(F.sum("n_best").alias("best_there"), F.sum("count_sum").alias("sum_there"))
    return (first.join(rest, "row").withColumn("n_best", F.col("n_best") + F.col("best_there"))
            .withColumn("count_sum", F.col("count_sum") + F.col("sum_there")).select(*out))


def _numbers(parts: DataFrame, group: list[int]) -> Numbers:
    rows = parts.filter(F.col("first").isin(group)).orderBy("first").collect() if group else []
    return Numbers([(r["first"], r["last"], pickle.loads(zlib.decompress(r["hash"])),
                     np.frombuffer(zlib.decompress(r["held"]), dtype=np.int64)) for r in rows])


def _counts(totals: DataFrame, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    for r in totals.collect():
        some = np.frombuffer(zlib.decompress(r["counts"]), dtype=np.int64)
        out[r["span"] * SPAN:r["span"] * SPAN + len(some)] = some
    return out


def op12_alignment(spark, sf_dir):
    """Alignment of every document between both tokenizers, with corpus-wide counts."""
    return align(table(spark, sf_dir, "documents"))
