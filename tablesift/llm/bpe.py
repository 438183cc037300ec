"""Byte-level BPE encoding and decoding (operator 1).

``encode`` turns texts into token ids and the character at which each token
starts; ``decode`` turns ids back into bytes and text.  The byte-to-character
mapping of byte-level BPE is applied here, merging is done by the tokenizers
library, and both run over Arrow batches, so that Spark deals out the rows and
nothing is shuffled.

Words recur.  A text is cut in front of every white space that follows
something else, which is always a boundary between two matches of the pattern;
each cut piece is encoded once and then taken from a cache that is bounded in bytes.  With
another pattern the pieces are that pattern's matches.

Defined results: null and empty texts have no tokens; a text of any length is
encoded whole; equal rows give equal results; an empty table gives none.  All
other columns pass through; ``ids``, ``char_starts``, ``decoded`` and
``decoded_text`` replace columns of the same names.
"""

from __future__ import annotations

import array
import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers.models import BPE

from tablesift.llm.common import place_of, plainly_named, slices, table, text_of

#: Bytes that a worker keeps in each of two generations of its cache, and what a piece takes besides its text and ids.
CACHE_BYTES = 48 << 20
PIECE_BYTES = 250
#: Characters of the longest piece that is kept; longer ones seldom come again.
LONGEST_KEPT = 64

# Characters with the White_Space property, as the pattern's \s has them.
SPACE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte.

    Bytes that print as they are keep their character; the others get the
    characters from 256 on, in order.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


@lru_cache(4)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a file of base64 tokens and numbers."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """Ids of a text and bytes of ids, for one vocabulary."""

    def __init__(self, path: str, pattern: str, cache_bytes: int = CACHE_BYTES):
        vocabulary = ranks(path)
        names = byte_characters()
        self._names = str.maketrans({chr(b): c for b, c in names.items()})
        named = {token: token.decode("latin-1").translate(self._names) for token in vocabulary}
        # A merge for every way to split a token into two others, first the lowest rank:
        # the same pairs join in the same order as when ranks are looked up.
        merges = [
            (named[token[:i]], named[token[i:]])
            for token in sorted(vocabulary, key=vocabulary.__getitem__)
            for i in range(1, len(token))
            if token[:i] in vocabulary and token[i:] in vocabulary
        ]
        self._model = BPE({named[token]: rank for token, rank in vocabulary.items()}, merges, ignore_merges=True)
        self._pieces = regex.compile(pattern).findall
        # Only of the usual pattern it is known that texts can be cut in front of white space.
        self._cut = _CHUNK if pattern == public_tokenizers.PATTERN else None
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        self._limit, self._held = cache_bytes, 0
        # The reversed byte table: all tokens' bytes in a row, and where each starts.
        count = max(vocabulary.values()) + 1
        by_rank = [b""] * count
        for token, rank in vocabulary.items():
            by_rank[rank] = token
        self.token_bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.token_lengths = np.array([len(token) for token in by_rank], np.int64)
        self._token_starts = np.cumsum(self.token_lengths) - self.token_lengths

    def _encode_chunk(self, chunk: str) -> bytes:
        found = self._old.get(chunk)
        if found is None:
            found = array.array("I", [token.id for piece in ([chunk] if self._cut is None else self._pieces(chunk)) for token in self._model.tokenize(piece.encode().decode("latin-1").translate(self._names))]).tobytes()
        if len(chunk) <= LONGEST_KEPT:
            if self._held >= self._limit:
                self._old, self._young, self._held = self._young, {}, 0
            self._young[chunk] = found
            self._held += PIECE_BYTES + 4 * len(chunk) + len(found)
        return found

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self._cut is None:
            return self._join(self._pieces(text))
        if len(text) <= 1 << 22:
            return self._join(self._cut.findall(text))
        chunks = self._cut.finditer(text)
        return b"".join(iter(lambda: self._join([m[0] for m in islice(chunks, 1 << 16)]), b""))

    def _join(self, chunks: list[str]) -> bytes:
        known = self._young.get  # of this generation; a swap meanwhile only costs a look into the other
        return b"".join([known(c) or self._encode_chunk(c) for c in chunks])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids; characters that are split over tokens come together again."""
        if len(ids) and (int(ids.max()) >= len(self.token_lengths) or not self.token_lengths[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        lengths = self.token_lengths[ids]
        ends = np.cumsum(lengths)
        where = np.repeat(self._token_starts[ids] - ends + lengths, lengths)
        where += np.arange(len(where))
        return self.token_bytes[where].tobytes()

    def char_starts(self, ids: np.ndarray, data: bytes) -> np.ndarray:
        """The character in which each token starts, by the bytes before it."""
        heads = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80, dtype=np.int64)
        lengths = self.token_lengths[ids]
        return (heads[np.cumsum(lengths) - lengths] - 1).astype("<u4")


@lru_cache(2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _vocabulary(path: str | None) -> str:
    return path or public_tokenizers.path("byte_bpe_50k.tiktoken")


def _mapped(df: DataFrame, column: str, fields: dict[str, T.DataType], made: Callable[[list], list[pa.Array]]) -> DataFrame:
    """``df`` with further columns ``fields``, made of the values of ``column``; others of these names go."""
    plain, place = plainly_named(df), place_of(df, column)
    kept = [(f"c{i}", name) for i, name in enumerate(df.columns) if name not in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, place):
                yield pa.RecordBatch.from_arrays([batch.column(c) for c, _ in kept] + made(batch.column(place).to_pylist()), [c for c, _ in kept] + list(fields))

    schema = T.StructType([plain.schema[c] for c, _ in kept] + [T.StructField(k, v) for k, v in fields.items()])
    return plain.mapInArrow(run, schema).toDF(*[name for _, name in kept], *fields)


def encode(df: DataFrame, text: str = "text", vocabulary: str | None = None, pattern: str = public_tokenizers.PATTERN, offsets: bool = True) -> DataFrame:
    """Add ``ids`` and, with ``offsets``, ``char_starts``.

    Both are packed as little-endian unsigned 32-bit integers, as token files
    have them; ``unpacked`` makes arrays of them.
    """
    path = _vocabulary(vocabulary)

    def made(texts: list) -> list[pa.Array]:
        own = codec(path, pattern)
        ids = [own.encode(t or "") for t in texts]
        out = [pa.array(ids, pa.binary())]
        if offsets:
            views = [np.frombuffer(x, "<u4") for x in ids]
            out.append(pa.array([own.char_starts(v, own.decode(v)).tobytes() if len(v) else b"" for v in views], pa.binary()))
        return out

    return _mapped(df, text, {"ids": T.BinaryType()} | ({"char_starts": T.BinaryType()} if offsets else {}), made)


def decode(df: DataFrame, ids: str = "ids", vocabulary: str | None = None, pattern: str = public_tokenizers.PATTERN, as_text: bool = True) -> DataFrame:
    """Add ``decoded`` (bytes) and, with ``as_text``, ``decoded_text``.

    Ids may be any run of tokens, also one that starts or ends inside a
    character: the bytes are exact, the text has U+FFFD for the broken ends.
    """
    path = _vocabulary(vocabulary)

    def made(packed: list) -> list[pa.Array]:
        own = codec(path, pattern)
        data = [own.decode(np.frombuffer(x or b"", "<u4")) for x in packed]
        return [pa.array(data, pa.binary())] + ([pa.array([x.decode("utf-8", "replace") for x in data], pa.string())] if as_text else [])

    return _mapped(df, ids, {"decoded": T.BinaryType()} | ({"decoded_text": T.StringType()} if as_text else {}), made)


def unpacked(name: str = "ids") -> Callable:
    """A column of arrays from a packed one: ``df.select(unpacked("ids"))``."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def unpack(packed: pa.Array) -> pa.Array:
        return pa.array([None if x is None else np.frombuffer(x, "<u4").astype(np.int64) for x in packed.to_pylist()], pa.list_(pa.int64()))

    return unpack(F.col(name))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every whole text with offsets, decode the ids to bytes and text, and digest all four."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    encoded = encode(docs).drop("text")
    return decode(encoded).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("char_starts").alias("char_starts_hash"),
        F.xxhash64("decoded_text").alias("decoded_text_hash"),
    )
