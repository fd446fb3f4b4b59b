"""Periodic runs of words by scale-tiled distribution.

A run is a stretch of consecutive words in which words one period apart are identical, whose
smallest period that is, which no neighbouring word extends, of at least ``LEAST`` words and
``TIMES`` periods. It is kept as the interval of its matches: the words that equal the word
one period later.

Every octave of periods from P to 2P - 1 has tiles of 8P words, one for each 4P words of a
document, so that a run's part in some tile always holds 2P matches; the octaves up to
``BASE`` share the tiles of the largest one, and a document no longer than such a tile is one
tile. A tile is solved alone. Where a match interval holds 2P words it holds a whole block of
P words at a multiple of P: the blocks at these boundaries are compared, by hash, with all
windows one period of the octave later, so only boundaries whose Z value reaches P remain.
There the words themselves are compared, as the Z functions of the boundary in both
directions do, up to the ends of the matches. An interval that touches an end of a tile,
other than one of its document, is a fragment. Fragments are shuffled by document and period
and stitched where they meet.

Defined cases: a null or empty text has no words and no runs; rows are taken one by one, so
a repeated or null doc_id matters nothing; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pricelake.llm.common import ascii_words, batch_of, mix64, stage, window_hashes, word_bounds

LEAST, TIMES = 24, 3
#: Two primes below 2**31 and a base, for hashes in which no pattern of words cancels out.
HASH_PRIMES, HASH_BASE = (2147483647, 2147483629), 1_000_003
#: Periods below are compared directly: their runs, of 24 words, have no use for blocks.
SMALL = 8
#: The largest octave that shares its tiles with all smaller ones; so tiles have 131,072 words.
BASE = 1 << 14
#: Bytes from which a text may be longer than such a tile, and goes to executors tile by tile.
LONG = 8 * BASE * 2

TILE = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("start", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("text", pa.binary())])
TILE_SQL = "key long, doc_id long, n long, start long, low long, high long, text binary"
#: ``plain``: a document without fragments; ``piece``: the words of a base tile that no tile before has; ``part``: matches [start, stop) of a period.
FOUND = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("period", pa.int64()), ("text", pa.string())])
FOUND_SQL = "kind string, key long, doc_id long, start long, stop long, period long, text string"
PIECE = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("kept", pa.string())])


def tiles(n: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, end, low, high) of a document's tiles: words, and the periods that they are solved for."""
    top, low = BASE, 1
    while True:
        for start in range(0, max(1, n), 4 * top):
            yield start, min(n, start + 8 * top), low, 2 * top
            if start + 8 * top >= n:
                break
        if 2 * top * TIMES > n:
            return
        top, low = 2 * top, 2 * top


def _exploded(docs: DataFrame) -> DataFrame:
    """Tiles of long texts, each with its own words' text."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, doc, text in zip(batch["key"].to_pylist(), batch["doc_id"].to_pylist(), batch["text"]):
                data = text.as_py()
                starts, ends = word_bounds(np.frombuffer(data, np.uint8))
                n = len(starts)
                for start, end, low, high in tiles(n):
                    yield batch_of(TILE, *[[x] for x in (key, doc, n, start, low, high, data[starts[start] : ends[end - 1]] if n else b"")])

    return docs.mapInArrow(explode, TILE_SQL)


def _intervals(match: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(match, prepend=False, append=False))
    return edges[0::2], edges[1::2]


def _primitive(ids: np.ndarray, at: int, period: int) -> bool:
    """Whether the ``period`` words from ``at`` on repeat no shorter list of words."""
    root, rest, p = ids[at : at + period], period, 2
    while rest > 1:
        if p * p > rest:
            p = rest
        if rest % p == 0:
            step = period // p
            if (root[step:] == root[:-step]).all():
                return False
            while rest % p == 0:
                rest //= p
        p += 1
    return True


def _least_factors(n: int) -> np.ndarray:
    """The smallest prime factor of every number below n."""
    factors = np.arange(n)
    for p in range(2, int(n**0.5) + 1):
        if factors[p] == p:
            multiples = factors[p * p :: p]
            multiples[multiples == np.arange(p * p, n, p)] = p
    return factors


def _sums(values: np.ndarray, prime: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base, and sums of value * base**place before each place, modulo a prime below 2**31."""
    prime_, powers = np.uint64(prime), np.ones(1, np.uint64)
    while len(powers) < len(values):
        step = np.uint64(int(powers[-1]) * HASH_BASE % prime)
        powers = np.concatenate([powers, powers * step % prime_])
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values % prime_ * powers[: len(values)] % prime_, out=sums[1:])
    return powers, sums % prime_


def _repeating(values: np.ndarray, at: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether the ``period`` values from ``at`` on repeat a shorter list, by hashes of 62 bits."""
    sums = [(np.uint64(p), *_sums(values, p)) for p in HASH_PRIMES]
    factors, rest, out = _least_factors(int(period.max()) + 1), period.copy(), np.zeros(len(at), bool)
    while len(open_ := np.flatnonzero((rest > 1) & ~out)):
        a, q, p = at[open_], period[open_], factors[rest[open_]]
        step, same = q // p, np.ones(len(open_), bool)
        for prime, powers, s in sums:
            left, right = (s[a + q - step] + prime - s[a]) % prime, (s[a + q] + prime - s[a + step]) % prime
            same &= left * powers[step] % prime == right
        out[open_] = same
        rest[open_] //= p
    return out


def _octave(ids: np.ndarray, values: np.ndarray, P: int) -> set[tuple[int, int, int]]:
    """The match intervals (start, stop, period) of primitive periods from P to 2P - 1 that hold a block."""
    n, windows = len(ids), window_hashes(values, P)
    blocks = (n - P) // P  # those with at least one window a period later
    first = windows[: blocks * P : P]
    later = windows[P : P + blocks * P]
    later = np.concatenate([later, ~np.repeat(first[-1:], blocks * P - len(later))])
    block, more = np.nonzero(later.reshape(blocks, P) == first[:, None])
    if not len(block):
        return set()
    at, period = block * P, more + P
    # Neighbouring blocks of one period lie in one interval: only the first and last of them count.
    order = np.lexsort((at, period))
    at, period = at[order], period[order]
    new = np.concatenate([[True], (np.diff(at) != P) | (np.diff(period) != 0)])
    last = at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
    at, period = at[new], period[new]
    keep = ~_repeating(values, at, period)
    out = set()
    for a, b, q in zip(at[keep].tolist(), last[keep].tolist(), period[keep].tolist()):
        begin, end = max(0, a - P + 1), min(b + 2 * P, n - q)
        starts, ends = _intervals(ids[begin:end] == ids[begin + q : end + q])
        out |= {(s + begin, e + begin, q) for s, e in zip(starts.tolist(), ends.tolist()) if e + begin > a and s + begin < b + P}
    return out


def solve(ids: np.ndarray, low: int, high: int, more_before: bool = False, more_after: bool = False) -> list[tuple[int, int, int]]:
    """(start, stop, period) of match intervals in a tile, for periods from low up to high, exclusive:
    those of runs, and those at an end of the tile where its document goes on. Equal numbers are equal words."""
    n, found = len(ids), set()
    for q in range(low, min(SMALL, high, n)):
        found |= {(s, e, q) for s, e in zip(*(x.tolist() for x in _intervals(ids[:-q] == ids[q:])))}
    values, P = mix64(ids.astype(np.uint64) + np.uint64(1)), max(SMALL, low)
    while P < high and 2 * P <= n:
        found |= _octave(ids, values, P)
        P *= 2
    wanted = lambda s, e, q: e - s + q >= max(LEAST, TIMES * q) or (more_before and s == 0) or (more_after and e == n - q)
    return [x for x in found if wanted(*x) and _primitive(ids, x[0], x[2])]


def _found(tiles: DataFrame, digests: bool) -> DataFrame:
    """FOUND's rows of all tiles; ``n`` below 0 marks a whole document as a tile."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, doc, n, start, low, high, text in zip(*(batch[name].to_pylist() for name in TILE.names)):
                words = text.split()
                if n < 0:
                    n, high = len(words), len(words) // TIMES + 1
                numbers: dict[bytes, int] = {}
                ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
                before, after = start > 0, start + len(words) < n
                parts = solve(ids, low, high, before, after) if n >= LEAST else []
                if low == 1:
                    own = b" ".join(words[: 4 * BASE] if after else words)
                    if parts or before or after:
                        out.append(("piece", key, doc, start, None, None, own.decode("utf-8", "surrogatepass")))
                    else:
                        out.append(("plain", key, doc, 0, None, None, sha256(own).hexdigest() if digests else own.decode("utf-8", "surrogatepass")))
                out += [("part", key, doc, start + s, start + e, q, None) for s, e, q in parts]
            yield batch_of(FOUND, *(zip(*out) if out else [[]] * len(FOUND)))

    return tiles.mapInArrow(search, FOUND_SQL)


def stitched(parts: DataFrame) -> DataFrame:
    """key, period, start and length of all runs, from match intervals that overlap or touch."""
    by = Window.partitionBy("key", "period").orderBy("start", "stop")
    reach = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    rows = parts.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1)).withColumn("number", F.sum("new").over(by))
    whole = rows.groupBy("key", "period", "number").agg(F.min("start").alias("start"), (F.max("stop") - F.min("start") + F.col("period")).alias("length"))
    return whole.filter(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period"))).drop("number")


def _without_repeats(pieces: DataFrame) -> DataFrame:
    """key, start and kept: a piece's words that no run drops; pieces: key, start, text, runs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for start, text, runs in zip(batch["start"].to_pylist(), batch["text"], batch["runs"]):
                words = ascii_words(text.as_py())
                if runs.is_valid and len(runs.values):
                    first, period, length = (runs.values.field(f).to_numpy() - (start if f == "start" else 0) for f in ("start", "period", "length"))
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, np.clip(first + period, 0, len(words)), 1)
                    np.add.at(change, np.clip(first + length, 0, len(words)), -1)
                    words = [w for w, gone in zip(words, (np.cumsum(change) > 0).tolist()) if not gone]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield batch_of(PIECE, batch["key"], batch["start"], kept)

    return pieces.select("key", "start", "text", "runs").mapInArrow(cut, "key long, start long, kept string")


def periodic_runs(docs: DataFrame, digests: bool = False) -> DataFrame:
    """Per row: doc_id, runs (start, period, length; by start, then period) and collapsed: the words
    that are in no run after its first period, joined by one space, or with ``digests`` their SHA-256."""
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    whole = lambda name, value: F.lit(value).cast("long").alias(name)
    is_long = F.octet_length("text") >= LONG
    short = rows.filter(~is_long).select((F.col("key") * 2).alias("key"), "doc_id", whole("n", -1), whole("start", 0), whole("low", 1), whole("high", 0), "text")
    cut = _exploded(rows.filter(is_long).withColumn("key", F.col("key") * 2 + 1)).repartition("key", "start", "low")
    found = stage(_found(short.unionByName(cut), digests), "periodic-found")

    runs = stitched(found.filter("kind = 'part'").select("key", "period", "start", "stop"))
    runs = stage(runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")), "periodic-runs")
    pieces = found.filter("kind = 'piece'").select("key", "doc_id", "start", "text")
    kept = _without_repeats(pieces.join(runs, "key", "left")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "kept"))).alias("pieces"))
    text = F.array_join(F.filter(F.transform("pieces", lambda p: p["kept"]), lambda t: t != ""), " ")
    kept = kept.select("key", (F.sha2(text, 256) if digests else text).alias("collapsed"))
    ids = pieces.filter("start = 0").select("key", "doc_id")
    none = F.array().cast("array<struct<start:bigint,period:bigint,length:bigint>>")
    some = ids.join(runs, "key", "left").join(kept, "key").select("doc_id", F.coalesce("runs", none).alias("runs"), "collapsed")
    return some.unionByName(found.filter("kind = 'plain'").select("doc_id", none.alias("runs"), F.col("text").alias("collapsed")))


def with_tails(docs: DataFrame) -> DataFrame:
    """docs in which every tenth document by its id's crc32 ends in a periodic tail: from word a on,
    the p words there are repeated, with a and p from the crc32."""
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)).alias("words"))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.array_join(F.concat(F.slice("words", 1, a), F.slice(tail, 1, n - a)), " ")
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), planted).otherwise(F.col("text")).alias("text"))


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_tails(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = periodic_runs(docs, digests=True)
    kind = "struct<start:bigint,period:bigint,length:bigint>"
    best = F.aggregate("runs", F.lit(None).cast(kind), lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    return rows.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.col("collapsed").alias("collapsed_sha256"),
    )
