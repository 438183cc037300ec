"""Packing into token windows of one length (operator 5).

Bounded-space online packing: a partition keeps at most ``OPEN_WINDOWS`` open
windows.  What a document has in whole windows fills windows of its own; its
rest goes where it leaves the least room.  Where it fits nowhere, a new window
is opened, and if all are open, the fullest one is emitted first.  At the end
of a partition the open windows are left over; those of ``MERGE`` partitions
at a time are merged: the fullest is filled up with whole windows that fit
best, and then with the head of the smallest, so that one window of each merge
has room left.

A task holds the open windows and no more, a merge at most ``MERGE`` times
``OPEN_WINDOWS`` windows, whatever the input.  Nothing but leftovers is
shuffled.  Sequence ids depend on the partition and its rows alone, so a task
that runs again gives the same ones.

Ids are those that the tokenizers library finds with the file ``byte_bpe_50k.json``
and its own settings, so the name of an added token in a text, ``<|endoftext|>``,
is that token.  They are found with tiktoken from the vocabulary in that file, which
is several times as fast, and tests hold both against each other.  White space too long for
its pattern is given to the tokenizers library itself.

Defined results: a null or empty text is the end token alone; a text of any
length is packed whole; rows with equal doc_id are packed one by one; an empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenizers import Tokenizer

from tablesift.llm.bpe import SPACE, byte_characters
from tablesift.llm.common import settle, slices, table, text_of

CAPACITY = 2048
OPEN_WINDOWS = 64
END_ID = 1
#: Partitions whose leftovers are merged together.
MERGE = 64

#: White space that is long, with the word behind it.
_LONG_WHITE = re.compile(f"[{SPACE}]{{1024,}}[^{SPACE}]*")

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, part int, ids binary"


class Encoder:
    """Ids of a text, by a tokenizers file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"added tokens that take in what is around them aren't known: {path}")
        self._added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        # The longest name first, as it counts where one begins with another.
        names = sorted(self._added, key=len, reverse=True)
        self._names = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        of = {c: b for b, c in byte_characters().items()}
        ranks = {bytes(of[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if token not in self._added}
        self._encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._path = path

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self._names is None or not self._names.search(text):
            return self._plain(text)
        return b"".join(self._added[part] if i % 2 else self._plain(part) for i, part in enumerate(self._names.split(text)))

    def _plain(self, text: str) -> bytes:
        try:
            return self._encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype("<u4", copy=False).tobytes()
        except ValueError:  # its pattern can't step back over some hundred thousand blanks
            cuts = [0, *(place for found in _LONG_WHITE.finditer(text) for place in found.span()), len(text)]
            if len(cuts) == 2:
                raise
            # Where a run of white space begins, or ends with its word, two matches of the pattern meet.
            return b"".join((self._by_library if i % 2 else self._plain)(text[a:b]) for i, (a, b) in enumerate(zip(cuts, cuts[1:])))

    def _by_library(self, text: str) -> bytes:
        return np.array(_library(self._path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(2)
def _library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


@lru_cache(2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


class Windows:
    """The open windows of one partition."""

    def __init__(self, capacity: int, count: int):
        self.capacity, self.count = capacity, count
        self._rooms: list[tuple[int, int]] = []  # (room, window), least room first
        self._held: dict[int, list[tuple]] = {}
        self.next_id = 0

    def place(self, piece: tuple, length: int) -> list[tuple[int, list[tuple]]]:
        """Place a piece; return the windows that this completes."""
        done = []
        at = bisect_left(self._rooms, (length, -1))
        if at < len(self._rooms):
            room, window = self._rooms.pop(at)
        else:
            if len(self._rooms) >= self.count:
                _, fullest = self._rooms.pop(0)
                done.append((fullest, self._held.pop(fullest)))
            room, window = self.capacity, self.next_id
            self.next_id += 1
            self._held[window] = []
        self._held[window].append((*piece, self.capacity - room))
        if room == length:
            done.append((window, self._held.pop(window)))
        else:
            insort(self._rooms, (room - length, window))
        return done

    def rest(self) -> list[tuple[int, list[tuple]]]:
        return [(window, self._held[window]) for _, window in self._rooms]


def _packed(batches: Iterator[pa.RecordBatch], capacity: int, open_windows: int, end_id: int, path: str, part: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path)
    windows = Windows(capacity, open_windows)
    schema = pa.schema([(n, {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[t]) for n, t in (f.split() for f in _PIECES.split(", "))])
    end = np.array([end_id], "<u4").tobytes()

    def rows(done: list[tuple[int, list[tuple]]], left: bool) -> list[tuple]:
        # An id says in which partition the window was opened; the lowest bit is for merged ones.
        return [
            (doc, start, length, zlib.crc32(ids), tokens, ((part << 40) + window) << 1, offset, part if left else None, ids if left else None)
            for window, pieces in done
            for doc, start, length, tokens, ids, offset in pieces
        ]

    def batch(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), schema.types)], schema=schema)

    for whole in batches:
        for some in slices(whole, "text"):
            made: list[tuple] = []
            for doc, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                ids = encoder.encode(text or "") + end
                tokens = len(ids) // 4
                for start in range(0, tokens, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    made += rows(windows.place((doc, start, len(piece) // 4, tokens, piece), len(piece) // 4), False)
            if made:
                yield batch(made)
    if made := rows(windows.rest(), True):
        yield batch(made)


def merged(pieces: pd.DataFrame, capacity: int, group: int) -> pd.DataFrame:
    """Merge the windows that some partitions left over; only the last has room left."""
    windows = [list(w.sort_values("offset").itertuples(index=False)) for _, w in pieces.groupby("sequence_id", sort=True)]
    rooms: list[tuple[int, int]] = sorted((sum(p.length for p in w), i) for i, w in enumerate(windows))  # (fill, window)
    out: list[tuple] = []
    made = 0
    while rooms:
        fill, first = rooms.pop()
        members = [(p.doc_id, p.start, p.length, p.ids, p.doc_tokens) for p in windows[first]]
        while fill < capacity and rooms:
            at = bisect_left(rooms, (capacity - fill + 1, -1)) - 1
            if at >= 0:  # the largest that fits whole
                more, window = rooms.pop(at)
                members += [(p.doc_id, p.start, p.length, p.ids, p.doc_tokens) for p in windows[window]]
                fill += more
                continue
            # None fits whole: cut the head off the smallest.
            size, window = rooms.pop(0)
            need, kept = capacity - fill, []
            for p in windows[window]:
                take = min(need, p.length)
                if take:
                    members.append((p.doc_id, p.start, take, p.ids[: 4 * take], p.doc_tokens))
                if take < p.length:
                    kept.append(p._replace(start=p.start + take, length=p.length - take, ids=p.ids[4 * take :]))
                need -= take
            insort(rooms, (size - (capacity - fill), window))
            windows[window], fill = kept, capacity
        offset = 0
        for doc, start, length, ids, tokens in members:
            out.append((doc, start, length, zlib.crc32(ids), tokens, (((group << 40) + made) << 1) + 1, offset))
            offset += length
        made += 1
    return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]).astype({"doc_id": "Int64"})


def pack(df: DataFrame, capacity: int = CAPACITY, open_windows: int = OPEN_WINDOWS, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """The pieces of all documents and their places: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``sequences`` makes the token windows themselves from these pieces.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(batches, capacity, open_windows, end_id, path, TaskContext.get().partitionId())

    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # Both parts of the result come from this; settled, texts are tokenised once.
    pieces = settle(docs.mapInArrow(run, _PIECES))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    left = pieces.filter(F.col("part").isNotNull()).withColumn("merge", (F.col("part") / MERGE).cast("long"))
    schema = ", ".join(_PIECES.split(", ")[:7])
    again = left.groupBy("merge").applyInPandas(lambda key, own: merged(own, capacity, int(key[0])), schema)
    return pieces.filter(F.col("part").isNull()).select(*columns).unionByName(again)


def sequences(df: DataFrame, pieces: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """sequence_id, length and ids (packed, not padded) of each sequence of ``pieces``, the result of ``pack`` for ``df``.

    A sequence has at most ``capacity`` tokens, so what is gathered for one is bounded.  doc_ids must be unique.
    """
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(path), np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                for text, own in zip(batch.column("text").to_pylist(), batch.column("own").to_pylist()):
                    ids = encoder.encode(text or "") + end
                    rows += [(p["sequence_id"], p["offset"], ids[4 * p["start"] : 4 * (p["start"] + p["length"])]) for p in own]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], ["sequence_id", "offset", "ids"])

    wanted = pieces.groupBy("doc_id").agg(F.collect_list(F.struct("sequence_id", "offset", "start", "length")).alias("own"))
    parts = df.select("doc_id", text_of().alias("text")).join(wanted, "doc_id").select("text", "own").mapInArrow(cut, "sequence_id long, offset long, ids binary")
    joined = F.concat(F.lit(b""), F.aggregate(F.array_sort(F.collect_list(F.struct("offset", "ids"))), F.lit(b""), lambda a, p: F.concat(a, p.ids)))
    return parts.groupBy("sequence_id").agg(joined.alias("ids")).select("sequence_id", (F.octet_length("ids") / 4).cast("int").alias("length"), "ids")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return pack(table(spark, sf_dir, "documents"))
