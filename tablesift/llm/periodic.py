"""Runs of words that repeat with a period, by multi-scale minimizers (operator 11).

A run is a stretch of words in which words ``period`` apart are identical, at least
``LEAST_EXPONENT`` periods and ``LEAST_WORDS`` words long, with no smaller period, that
neither neighbour extends.

* Periods below ``FIRST_SCALE`` are found by direct scans: the text against itself moved
  by each lag.
* Scale ``s``, a power of two, is for periods from ``s`` to ``2 * s - 1``.  Grams of
  ``s / 2`` words are hashed, from those of half the length, and each window of
  ``2 * s`` grams selects its first smallest one.  Inside a run windows one period apart
  are equal, so they select grams one period apart: pairs of equal minimizers at
  such a distance are seeds, each extended both ways on the words themselves.
* Grams that lie in a run of at most a third of their length are left out, as that run
  is known from an earlier scale.  What remains of one gram stands more than a third of its
  length apart, so a minimizer has a few partners and the work grows with n log n,
  also where one word is written a million times.  A run of a longer smallest period
  always has such grams, in each of its periods.

Nothing is missed for that: a run has four periods at least, so windows one period
apart fit into it.  A hash that two grams share makes a seed that fails, no more.

Defined results: null and empty texts, and texts of white space, have no runs and an
empty collapsed text; rows are taken one by one, so repeated rows give equal rows; texts
of any length are read whole, one row at a time if they are long; all other columns pass,
but for those with the names of the new ones; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesift.llm.common import place_of, plainly_named, slices, table, text_of
from tablesift.llm.word_hash import mix

LEAST_WORDS = 6
LEAST_EXPONENT = 4
#: The first scale, and so the first period that isn't found by a direct scan.
FIRST_SCALE = 16
#: Cells that a comparison of many stretches holds at a time.
CELLS = 1 << 20

_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _islands(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches of at least ``least`` true values."""
    turns = np.flatnonzero(np.diff(equal, prepend=False, append=False))
    starts, ends = turns[::2], turns[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _agreement(ids: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``a`` and ``b`` on agree, going by ``step``, up to ``limit``."""
    out = np.zeros(len(a), np.int64)
    active, size, last = np.flatnonzero(limit > 0), 8, len(ids) - 1
    while len(active):
        still = []
        ahead = np.arange(size)
        for some in np.array_split(active, len(active) * size // CELLS + 1):
            at = out[some, None] + ahead
            same = ids[np.clip(a[some, None] + step * at, 0, last)] == ids[np.clip(b[some, None] + step * at, 0, last)]
            same &= at < limit[some, None]
            full = same.all(1)
            out[some] += np.where(full, size, same.argmin(1))
            still.append(some[full])
        active, size = np.concatenate(still), min(2 * size, 4096)
    return out


def _extended(ids: np.ndarray, places: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and lags of the stretches of words equal to those a lag further that hold the seeds."""
    order = np.lexsort((places, lags))
    places, lags = places[order], lags[order]
    new = np.ones(len(places), bool)
    new[1:] = (places[1:] != places[:-1]) | (lags[1:] != lags[:-1])
    places, lags = places[new], lags[new]
    same = lags[1:] == lags[:-1]
    gap = np.where(same, places[1:] - places[:-1], len(ids))
    # Seeds of one lag are compared as far as the next one only, so each word is compared once for a lag.
    ahead = _agreement(ids, places, places + lags, np.append(gap, len(ids)), 1)
    first = np.append(True, ~same | (ahead[:-1] < gap))
    last = np.append(first[1:], True)
    heads = np.flatnonzero(first)
    back = _agreement(ids, places[heads] - 1, places[heads] + lags[heads] - 1, np.append(len(ids), gap)[heads], -1)
    return places[heads] - back, (places + ahead)[last], lags[heads]


class _Found:
    """The runs so far: starts, ends and periods."""

    def __init__(self) -> None:
        self.starts, self.ends, self.periods = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, starts: np.ndarray, ends: np.ndarray, lag: np.ndarray | int, words: int, exponent: int) -> None:
        """Stretches that agree with those a lag further."""
        lags = np.broadcast_to(np.asarray(lag, np.int64), starts.shape)
        ends = ends + lags
        long = ends - starts >= np.maximum(words, exponent * lags)
        self.starts = np.concatenate([self.starts, starts[long]])
        self.ends = np.concatenate([self.ends, ends[long]])
        self.periods = np.concatenate([self.periods, lags[long]])

    def covered(self, gram: int, size: int) -> np.ndarray:
        """Which grams lie in a run of at most a third of their length."""
        own = (self.periods * 3 <= gram) & (self.ends - self.starts >= gram)
        turns = np.bincount(self.starts[own], minlength=size + 1) - np.bincount(self.ends[own] - gram + 1, minlength=size + 1)
        return np.cumsum(turns)[:size] > 0

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of equal stretches that of the smallest period, by start and period."""
        order = np.lexsort((self.periods, self.ends, self.starts))
        s, e, p = self.starts[order], self.ends[order], self.periods[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
        s, e, p = s[new], e[new], p[new]
        order = np.lexsort((p, s))
        return s[order], (e - s)[order], p[order]


def _seeds(hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of pairs of equal minimizers that are ``scale`` to ``2 * scale - 1`` apart."""
    least, at = hashes, np.arange(len(hashes))
    step = 1
    while step < 2 * scale and len(least) > step:
        left = least[:-step] <= least[step:]
        least, at = np.where(left, least[:-step], least[step:]), np.where(left, at[:-step], at[step:])
        step *= 2
    chosen = np.zeros(len(hashes), bool)
    chosen[at] = True
    places = np.flatnonzero(chosen & (hashes != _MOST))
    order = np.lexsort((places, hashes[places]))
    places = places[order]
    value = hashes[places]
    found, lags, left = [], [], np.arange(len(places))
    ahead = 1
    while len(left):
        left = left[left + ahead < len(places)]
        far = places[left + ahead] - places[left]
        near = (value[left + ahead] == value[left]) & (far < 2 * scale)
        left, far = left[near], far[near]
        found.append(places[left[far >= scale]])
        lags.append(far[far >= scale])
        ahead += 1
    return np.concatenate([np.zeros(0, np.int64), *found]), np.concatenate([np.zeros(0, np.int64), *lags])


def find_runs(texts: list[np.ndarray], words: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT, first_scale: int = FIRST_SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of some texts, given as arrays of word numbers: text, start, length and period, by text, start and period."""
    if exponent < 4:
        raise ValueError("windows one period apart fit into four periods, not into fewer")
    lengths = np.array([len(t) for t in texts], np.int64)
    # A word of its own between texts, before the first and behind the last.
    own = [np.array([-1], np.int64)]
    for i, t in enumerate(texts):
        own += [t, np.array([-i - 2], np.int64)]
    ids = np.concatenate(own).astype(np.int64, copy=False)
    firsts = np.cumsum(lengths + 1) - lengths
    found = _Found()
    for lag in range(1, first_scale):
        equal = ids[lag:] == ids[:-lag]
        found.add(*_islands(equal, max(words, exponent * lag) - lag), lag, words, exponent)
    # At each scale, of the texts that are long enough for it: where their words are, and the hashes of their grams.
    places, hashes = np.arange(len(ids)), mix(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    gram, scale = 1, first_scale
    sizes = np.repeat(np.append(0, lengths), np.append(1, lengths + 1))  # of the text of each place
    while len(lengths) and exponent * scale <= lengths.max():
        held = sizes[places] >= exponent * scale
        places, hashes = places[held], hashes[held]
        while gram < scale // 2:
            hashes = mix(hashes[:-gram] * np.uint64(0xD6E8FEB86659FD93) + mix(hashes[gram:]))
            hashes = np.append(hashes, np.zeros(gram, np.uint64))
            gram *= 2
        seen = np.where(found.covered(gram, len(ids))[places], _MOST, hashes)
        at, lag = _seeds(seen, scale)
        # Where texts were left out between two places, they aren't the distance apart any more.
        true = places[at + lag] - places[at] == lag
        if true.any():
            starts, ends, lags = _extended(ids, places[at[true]], lag[true])
            found.add(starts, ends, lags, words, exponent)
        scale *= 2
    starts, sizes, periods = found.runs()
    text = np.searchsorted(firsts, starts, side="right") - 1
    return text, starts - firsts[text], sizes, periods


def _analysed(words: list[list[bytes]], orders: list[np.ndarray | None], least: int, exponent: int) -> tuple[list[pa.Array], np.ndarray]:
    numbers: dict[bytes, int] = defaultdict(count().__next__)
    ids = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words]
    for i, order in enumerate(orders):
        if order is not None:
            ids[i] = ids[i][order]
            words[i] = [words[i][j] for j in order.tolist()]
    text, start, length, period = find_runs(ids, least, exponent)
    many = np.bincount(text, minlength=len(words))
    ends = np.cumsum(many)
    collapsed = []
    for i, w in enumerate(words):
        if many[i]:
            own = slice(ends[i] - many[i], ends[i])
            turns = np.bincount(start[own] + period[own], minlength=len(w) + 1) - np.bincount(start[own] + length[own], minlength=len(w) + 1)
            w = compress(w, (np.cumsum(turns)[: len(w)] == 0).tolist())
        collapsed.append(b" ".join(w))
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), runs)
    return [pa.array(many.astype(np.int64)), lists, pa.array(collapsed, pa.binary()).cast(pa.string())], many


_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_FIELDS = {"n_runs": T.LongType(), "runs": T.ArrayType(_RUN), "collapsed": T.StringType()}


def periodic_runs(df: DataFrame, text: str = "text", words: int = LEAST_WORDS, exponent: int = LEAST_EXPONENT, order: tuple[str, Callable[[object, int], np.ndarray | None]] | None = None) -> DataFrame:
    """``df`` with its texts' runs: ``n_runs``, ``runs`` (start, length and period in words, by start) and ``collapsed``,
    the text with one blank between words and of each run the first period alone.

    ``order`` is a column and a function of its value and a text's count of words: the numbers of
    the words that the text is read as, or None for the text as it is.
    """
    plain, place = plainly_named(df), place_of(df, text)
    kept = [(f"c{i}", name) for i, name in enumerate(df.columns) if name not in _FIELDS]
    key, reorder = (place_of(df, order[0]), order[1]) if order else (None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, place):
                split = [(t or "").encode().split() for t in batch.column(place).to_pylist()]
                orders = [reorder(k, len(w)) for k, w in zip(batch.column(key).to_pylist(), split)] if reorder else [None] * len(split)
                made, _ = _analysed(split, orders, words, exponent)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c, _ in kept], *made], [*[c for c, _ in kept], *_FIELDS])

    schema = T.StructType([plain.schema[c] for c, _ in kept] + [T.StructField(k, v) for k, v in _FIELDS.items()])
    return plain.mapInArrow(run, schema).toDF(*[name for _, name in kept], *_FIELDS)


def strongest(runs: Column) -> Column:
    """The run of the greatest length by period, of equal ones the first, then of the smallest period; null if there is none."""

    def ranked(a: Column, b: Column) -> Column:
        one, two = a["length"] * b["period"], b["length"] * a["period"]
        by = lambda x, y: F.when(x < y, -1).when(x > y, 1)
        return F.coalesce(by(two, one), by(a["start"], b["start"]), by(a["period"], b["period"]), F.lit(0))

    return F.get(F.array_sort(runs, ranked), F.lit(0))


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Of one in ten documents, by its number, words from a place on are read as a period that comes again."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, the strongest one, and digests of all of them and of the collapsed text; a null doc_id repeats no words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    found = periodic_runs(docs, order=("doc_id", repeated_tail)).withColumn("best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    lines = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: Bit by bit, as there is no function for it.
_SQL_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: ascii(s)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))"""

OP11_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         CASE WHEN doc_id IS NULL THEN 1 ELSE xor({_SQL_CRC}, 4294967295) END AS h FROM documents),
e AS (SELECT *, len(w) AS n, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM e),
k AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM f),
words AS (
  SELECT r, n, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM k)),
same AS (
  SELECT x.r, y.i - x.i AS q, x.i AS i FROM words x JOIN words y
    ON x.r = y.r AND x.word = y.word AND y.i > x.i AND y.i - x.i <= x.n // 4),
stretches AS (
  SELECT r, q, min(i) AS s, count(*) + q AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS own FROM same) GROUP BY r, q, own),
runs AS (
  SELECT r, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY r, s, l),
told AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM runs GROUP BY r),
best AS (
  SELECT x.* FROM runs x WHERE NOT EXISTS (
    SELECT 1 FROM runs y WHERE x.r = y.r AND (y.l * x.q > x.l * y.q OR y.l * x.q = x.l * y.q AND (y.s < x.s OR y.s = x.s AND y.q < x.q)))),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + l)) AS i FROM runs),
left_over AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS collapsed FROM words WHERE (r, i) NOT IN (SELECT r, i FROM gone) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, 1000 * l // q AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM d LEFT JOIN told USING (r) LEFT JOIN best USING (r) LEFT JOIN left_over USING (r)
"""
