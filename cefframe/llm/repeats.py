"""Suffix-array de-duplication: remove every byte covered by a LENGTH-byte string that starts elsewhere too.

Texts are UTF-8 bytes; a string's other start may lie in the same or another document.  The work is
cut so that an enhanced suffix array is built only where it decides something, in one task's memory:

1. Anchors.  A window (LENGTH bytes) is keyed by its anchor: the leftmost of its GRAM-byte strings
   with the smallest hash.  Equal windows have equal anchors at equal places, so a window can repeat
   only where its anchor does.  Consecutive windows with one anchor make a unit, the string from the
   first window's start to the last one's end.
2. Anchor hashes are counted over the corpus.  Units of an anchor that occurs once are unique.
3. Units are counted by (anchor, digest): all windows of a unit that occurs twice are repeats.  In
   the inside of a repeated passage all units are of this kind.
4. What is left are units that are unique as a whole while their anchor is not, at the edges of
   repeated passages.  They go, with one copy of each other unit of the anchor, to the task of the
   anchor, where :func:`maximal_repeats` decides: suffix array by prefix doubling, common prefixes
   of neighbours, a stack scan into the tree of common-prefix intervals, and a test of the bytes to
   the left; an interval whose occurrences are preceded by different bytes is a maximal repeat, and
   comes out with all its occurrences.  An anchor with more than MOST_UNITS different units (a
   passage that a third of all rows may hold) is not gathered: its windows are counted by digest,
   like the units before.

Counting sends each key once per block of documents, as packed arrays, to the task of the key's
range; the answer is one byte per key and block.  So a hot key arrives at most once per block.  The
documents and their units are stored, compressed, as a table bucketed by the blocks' home (a quarter
of a map task's blocks, one file); the answers come back by home, so no step shuffles the texts or
finds the units again.

Anchors and digests only choose what meets: repeats are decided on the bytes, or on 128-bit digests.

Defined cases: null text counts as empty; texts shorter than LENGTH lose nothing by themselves;
repeated rows (same id or same text) are documents of their own; null ids are kept; an empty table
gives an empty result; extra columns, whatever their names, are ignored; a text of any length is
judged whole, in one task, whose tables take some 95 bytes a byte of it (1.9 GB for 20 MB).
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, new_run, ship_code, stored, table

LENGTH, GRAM = 200, 64
BLOCK_BYTES, BLOCK_DOCS, HOMES = 1_500_000, 2000, 4
MOST_UNITS, BATCH_BYTES = 400, 2_000_000

_U = np.uint64
_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(0, 2 ** 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(n: int) -> list[np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(1 << 16, 1 << n.bit_length())
        _POWERS[:] = []
        for base in (_BASE, pow(_BASE, -1, 2 ** 64)):
            out, m = np.ones(size, np.uint64), 1
            while m < size:
                out[m:2 * m] = out[:m] * _U(pow(base, m, 2 ** 64))
                m *= 2
            _POWERS.append(out)
    return _POWERS


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place, from one running sum."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * down[:len(data)], out=total[1:])
    return mixed((total[gram:] - total[:-gram]) * up[:len(data) - gram + 1])


def sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Minimum or maximum of each ``width`` neighbours, from running ones forwards and backwards."""
    n = len(values)
    rows = np.full(-(-n // width) * width, np.iinfo(np.uint64).max if best is np.minimum else 0, np.uint64)
    rows[:n] = values
    rows = rows.reshape(-1, width)
    ahead = best.accumulate(rows, axis=1).ravel()
    back = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[:n - width + 1], ahead[width - 1:n])


def units(data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """First window, last window, anchor place and anchor hash of each unit of a text."""
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    h = gram_hashes(data, gram)
    least = sliding(h, length - gram + 1, np.minimum)
    change = np.nonzero(least[1:] != least[:-1])[0] + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change - 1, [len(least) - 1]])
    value = least[first]
    # Places of the smallest values, by (value, place): an anchor is the first one from a window on.
    reach = np.minimum(last + length - gram, len(h) - 1)
    place = np.nonzero(np.isin(h, value))[0]
    by_value = np.lexsort((place, h[place]))
    place, held = place[by_value], h[place[by_value]]
    kinds, number = np.unique(held, return_inverse=True)
    span = len(h) + 1
    keys = number * span + place
    want = np.searchsorted(kinds, value) * span
    anchor = place[np.searchsorted(keys, want + first)]
    tied = np.nonzero(anchor < last)[0]  # later windows of the run begin behind this place
    if len(tied):
        a, b = np.searchsorted(keys, want[tied] + first[tied]), np.searchsorted(keys, want[tied] + reach[tied], "right")
        starts, ends, anchors, values = [], [], [], []
        for run, i, j in zip(tied, a, b):
            spots = place[i:j]
            use = np.searchsorted(spots, last[run])  # the first place at or behind the last window
            spots = spots[:use + 1]
            starts.append(np.concatenate([[first[run]], spots[:-1] + 1]))
            ends.append(np.concatenate([spots[:-1], [last[run]]]))
            anchors.append(spots)
            values.append(np.full(len(spots), value[run]))
        keep = np.ones(len(first), bool)
        keep[tied] = False
        first = np.concatenate([first[keep], *starts])
        last = np.concatenate([last[keep], *ends])
        anchor = np.concatenate([anchor[keep], *anchors])
        value = np.concatenate([value[keep], *values])
    return first, last, anchor, value


# --- the enhanced suffix array ---------------------------------------------------------------

def suffix_ranks(text: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 8, 16, 32, ... bytes; a suffix stops at its string's end.

    ``ends``: for each place, where its string ends.  Strings are padded with a value below every byte.
    """
    n = len(text)
    padded = np.concatenate([text.astype(np.uint64) + _U(1), np.zeros(8, np.uint64)])
    room = ends - np.arange(n)
    key = np.zeros(n, np.uint64)
    for k in range(7):  # 7 places of 9 bits
        key = (key << _U(9)) | np.where(room > k, padded[k:n + k], _U(0))
    width, ranks = 7, [np.unique(key, return_inverse=True)[1].astype(np.int64)]
    while width < room.max(initial=0) and ranks[-1].max() < n - 1:
        later = np.full(n, -1, np.int64)
        inside = np.nonzero(room > width)[0]
        later[inside] = ranks[-1][inside + width]
        ranks.append(np.unique(ranks[-1] * np.int64(n + 1) + later + 1, return_inverse=True)[1].astype(np.int64))
        width *= 2
    return ranks


def common_prefixes(ranks: list[np.ndarray], ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, from the ranks of the doubling."""
    length = np.zeros(len(a), np.int64)
    top = np.minimum(ends[a] - a, ends[b] - b)
    for level in range(len(ranks) - 1, -1, -1):
        step = 7 << level
        # Ranks are equal past a string's end as well, so only whole steps inside both strings count.
        # A level can apply twice at the top (longer prefixes than the last doubling).
        while True:
            can = length + step <= top
            can[can] = ranks[level][a[can] + length[can]] == ranks[level][b[can] + length[can]]
            if not can.any():
                break
            length[can] += step
            if level < len(ranks) - 1:
                break
    # The rest is shorter than the first key: compare byte by byte through the first ranks' text.
    return length


def maximal_repeats(strings: list[bytes], least: int = LENGTH):
    """Maximal repeats of at least ``least`` bytes in some strings.

    Yields (length, [(string, place), ...]) for each: all its occurrences, which cannot all be
    extended by the same byte to the left or to the right.
    """
    strings_at = np.cumsum([0, *[len(s) for s in strings]])
    text = np.frombuffer(b"".join(strings), np.uint8)
    if not len(text):
        return
    owner = np.repeat(np.arange(len(strings)), np.diff(strings_at))
    ends = strings_at[1:][owner]
    ranks = suffix_ranks(text, ends)
    # Suffixes shorter than a repeat have no part in it.
    places = np.nonzero(ends - np.arange(len(text)) >= least)[0]
    order = places[np.argsort(ranks[-1][places], kind="stable")]
    if len(order) < 2:
        return
    prefix = common_prefixes(ranks, ends, order[:-1], order[1:])
    # Whole steps are counted; the last bytes one by one.
    a, b = order[:-1] + prefix, order[1:] + prefix
    going = (prefix >= least - 7)
    for _ in range(7):
        going[going] = (a[going] < ends[order[:-1]][going]) & (b[going] < ends[order[1:]][going])
        going[going] = text[a[going]] == text[b[going]]
        prefix[going] += 1
        a[going] += 1
        b[going] += 1
    left = np.where(order > strings_at[:-1][owner[order]], text[order - 1].astype(np.int64), -1 - np.arange(len(order)))
    inside = prefix >= least
    first = np.nonzero(inside & ~np.concatenate([[False], inside[:-1]]))[0]
    last = np.nonzero(inside & ~np.concatenate([inside[1:], [False]]))[0] + 1
    # Two suffixes alone: one interval, no tree.
    two = first + 1 == last
    for i in first[two][left[first[two]] != left[last[two]]]:
        yield int(prefix[i]), [locate(order[j], owner, strings_at) for j in (i, i + 1)]
    for start, stop in zip(first[~two], last[~two]):
        # Stack scan: open intervals by length; one closes as soon as a shorter prefix follows.
        stack: list[list] = []  # [length, first suffix, byte to the left of all, or None if they differ]
        for i in range(start, stop + 1):
            here = int(prefix[i]) if i < stop else 0
            begin, byte = i, left[i]
            while stack and stack[-1][0] > here:
                length, begin, own = stack.pop()
                own = own if own == byte else None
                if own is None:
                    yield length, [locate(order[j], owner, strings_at) for j in range(begin, i + 1)]
                byte = own
            if not here:
                break
            if stack and stack[-1][0] == here:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else None
            else:
                stack.append([here, begin, byte])


def locate(place: int, owner: np.ndarray, strings_at: np.ndarray) -> tuple[int, int]:
    return int(owner[place]), int(place - strings_at[owner[place]])


# --- blocks of documents ---------------------------------------------------------------------

def block_number(task: int, k: int) -> int:
    """A block's number; the home is what is left without its last 24 bits."""
    return (task * HOMES + k % HOMES) << 24 | k


def home_of(block_col):
    return F.shiftright(block_col, 24)


def shut(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as compressed bytes."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join([np.ascontiguousarray(x).tobytes() for x in arrays]))


def opened(data: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n, at, out = len(raw) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for k in kinds:
        out.append(np.frombuffer(raw, k, n, at))
        at += n * np.dtype(k).itemsize
    return out


class Block:
    """The documents of one block, its units, and (later) the digests of its units."""

    def __init__(self, sizes: list[int], data: bytes, units_: bytes | None = None, digests: bool = False):
        self.ends = np.cumsum(sizes, dtype=np.int64)
        self.starts = self.ends - np.asarray(sizes, np.int64)
        self.raw = data
        self.data = np.frombuffer(data, np.uint8)
        if units_ is not None:
            kinds = ["i4", "i4", "i4", "u8"] + ["u8", "u8"] * digests
            self.first, self.last, self.anchor, self.hash, *words = opened(units_, *kinds)
            self.first, self.last, self.anchor = (x.astype(np.int64) for x in (self.first, self.last, self.anchor))
            self.keys = np.column_stack([self.hash, *words]) if digests else self.hash
            return
        found = [units(self.data[a:b]) for a, b in zip(self.starts, self.ends)]
        shift = np.repeat(self.starts, [len(f[0]) for f in found])
        cat = lambda k, kind: np.concatenate([f[k] for f in found]) if found else np.empty(0, kind)
        self.first, self.last, self.anchor = (cat(k, np.int64) + shift for k in range(3))
        self.hash = self.keys = cat(3, np.uint64)

    def shut_units(self) -> bytes:
        words = [self.keys[:, 1], self.keys[:, 2]] if self.keys.ndim > 1 else []
        return shut(*(x.astype(np.int32) for x in (self.first, self.last, self.anchor)), self.hash, *words)

    def keep(self, mask: np.ndarray) -> None:
        """Only some of the units, with their digests: two words for its bytes and its anchor's place in them."""
        self.first, self.last, self.anchor, self.hash = (x[mask] for x in (self.first, self.last, self.anchor, self.hash))
        out = [xxhash.xxh3_128_digest(self.raw[a:b], seed=c) for a, b, c in
               zip(self.first.tolist(), (self.last + LENGTH).tolist(), (self.anchor - self.first).tolist())]
        self.keys = np.column_stack([self.hash, np.frombuffer(b"".join(out), np.uint64).reshape(-1, 2)])

    def string(self, i: int) -> bytes:
        return self.raw[self.first[i]:self.last[i] + LENGTH]

    def window_keys(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start of each window of the chosen units, and its key: digest and anchor hash."""
        if not len(chosen):
            return np.empty(0, np.int64), np.empty((0, 3), np.uint64)
        starts = np.concatenate([np.arange(self.first[i], self.last[i] + 1) for i in chosen])
        hashes = np.repeat(self.hash[chosen], self.last[chosen] - self.first[chosen] + 1)
        out = [xxhash.xxh3_128_digest(self.raw[a:a + LENGTH]) for a in starts.tolist()]
        # The digest first: an anchor's windows are too many for one task, so they are dealt out by it.
        return starts, np.column_stack([np.frombuffer(b"".join(out), np.uint64).reshape(-1, 2), hashes])

    def key_rows(self, block: int, keys: np.ndarray, parts: int) -> list[dict]:
        """A block's distinct keys by the part that counts them, as rows for the table."""
        kinds, _, count = distinct(keys)
        part = parts_of(kinds if kinds.ndim == 1 else kinds[:, 0], parts)
        order = np.argsort(part, kind="stable")
        cuts = np.nonzero(np.diff(part[order]))[0] + 1
        return [{"part": int(part[rows[0]]), "keys": kinds[rows].tobytes(), "several": (count[rows] > 1).tobytes()}
                for rows in (np.split(order, cuts) if len(order) else ())]


def distinct(keys: np.ndarray):
    """Distinct rows in order, each row's number, and how many rows each has."""
    if keys.ndim == 1:
        return np.unique(keys, return_inverse=True, return_counts=True)
    order = np.lexsort(keys.T[::-1])
    ranked = keys[order]
    new = np.concatenate([[True], (ranked[1:] != ranked[:-1]).any(axis=1)]) if len(keys) else np.empty(0, bool)
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ranked[new], number, np.bincount(number, minlength=int(new.sum()))


def parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> _U(33)) % _U(parts)).astype(np.int64)


KEY_ROWS = "array<struct<part: long, keys: binary, several: binary>>"
KEY_TYPE = pa.list_(pa.struct([("part", pa.int64()), ("keys", pa.binary()), ("several", pa.binary())]))


def answers(rows: pd.DataFrame, words: int, judge) -> pd.DataFrame:
    """Count the keys of a part over all blocks; ``judge`` turns them into a byte for each key and block."""
    sizes = [len(k) // (8 * words) for k in rows["keys"]]
    keys = np.frombuffer(b"".join(rows["keys"]), np.uint64).reshape(-1, words)
    several = np.frombuffer(b"".join(rows["several"]), bool)
    kinds, number, count = distinct(keys if words > 1 else keys[:, 0])
    count = count + np.bincount(number, several, len(count)).astype(np.int64)
    codes = judge(kinds, count, number).astype(np.uint8)
    cuts = np.cumsum(sizes)
    return pd.DataFrame({"block": rows["block"], "part": rows["part"],
                         "codes": [codes[b - s:b].tobytes() for b, s in zip(cuts, sizes)]})


#: Answers for units: the unit repeats as a whole; it goes to the anchor's task; it is counted by window.
REPEATS, MEETS, WINDOWS = 1, 2, 4


def judge_units(kinds: np.ndarray, count: np.ndarray, number: np.ndarray) -> np.ndarray:
    """kinds: (anchor hash, digest); an anchor with several different units has something to decide."""
    _, anchor, different = np.unique(kinds[:, 0], return_inverse=True, return_counts=True)
    different = different[anchor]
    # All unique units meet the others of their anchor; of a repeated unit one copy does.
    first = np.zeros(len(number), bool)
    first[np.unique(number, return_index=True)[1]] = True
    code = np.where(count > 1, REPEATS, 0)[number]
    meets = (different[number] > 1) & (first | (count[number] == 1))
    # Nothing is undecided where all of an anchor's units repeat.
    open_ = np.bincount(anchor, count == 1) > 0
    meets &= open_[anchor][number]
    return code + np.where(meets, np.where(different[number] > MOST_UNITS, WINDOWS, MEETS), 0)


class Answers:
    """A block's answers, in the order in which its keys were sent."""

    def __init__(self, cell, block: int):
        self.codes = {r["part"]: r["codes"] for r in cell or () if r["block"] == block}

    def of(self, keys: np.ndarray, parts: int) -> np.ndarray:
        """The code of each of a block's distinct keys."""
        part = parts_of(keys if keys.ndim == 1 else keys[:, 0], parts)
        order = np.argsort(part, kind="stable")
        out = np.zeros(len(keys), np.uint8)
        out[order] = np.frombuffer(b"".join(self.codes[p] for p in np.unique(part).tolist()), np.uint8)
        return out


TABLE = f"home long, block long, ids array<long>, sizes array<long>, packed binary, units binary, keys {KEY_ROWS}"
TABLE_TYPES = [("home", pa.int64()), ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
               ("packed", pa.binary()), ("units", pa.binary()), ("keys", KEY_TYPE)]


def one_row(types, *values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, (_, k) in zip(values, types)], [n for n, _ in types])


def rows_of(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def inflated(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed) if packed else b""


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 for each row."""
    spark = docs.sparkSession
    ship_code(spark)
    run = new_run(spark, "repeats")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    # A part counts about as many keys as one partition of the input has.
    parts = max(buckets, rows.rdd.getNumPartitions())

    named: list[str] = []

    def bucketed(df: DataFrame, label: str) -> DataFrame:
        """A table bucketed by home: the answers join it without shuffling the texts."""
        name = f"llm_{label}_{uuid.uuid4().hex}"
        named.append(name)
        df.write.bucketBy(buckets, "home").option("path", f"{run}/{label}").option("compression", "none").saveAsTable(name)
        return spark.table(name)

    def by_home(codes: DataFrame, label: str) -> DataFrame:
        codes = stored(codes, f"{run}/{label}").withColumn("home", home_of(F.col("block")))
        return codes.groupBy("home").agg(F.collect_list(F.struct("block", "part", "codes")).alias(label))

    def counted(table_: DataFrame, words: int, judge, label: str) -> DataFrame:
        """Each key counted over all blocks by its part; the answers by home."""
        keys = table_.select("block", F.inline("keys"))
        return by_home(keys.groupBy("part").applyInPandas(lambda r: answers(r, words, judge), "block long, part long, codes binary"), label)

    def pack(batches):
        task, k = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row():
            number, data = block_number(task, k), b"".join(texts)
            block = Block([len(t) for t in texts], data)
            return one_row(TABLE_TYPES, task * HOMES + k % HOMES, number, ids, [len(t) for t in texts],
                           zstandard.ZstdCompressor(level=3).compress(data), block.shut_units(), block.key_rows(number, block.hash, parts))

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or b""
                ids.append(key.as_py())
                texts.append(text)
                size += len(text)
                if size > BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield row()
                    k, ids, texts, size = k + 1, [], [], 0
        if ids:
            yield row()

    blocks = bucketed(map_arrow(rows, pack, TABLE), "blocks")
    anchors = counted(blocks, 1, lambda kinds, count, number: (count > 1)[number], "anchors")

    def digest(batches):
        """Only units whose anchors repeat, with their digests."""
        for home, number, ids, sizes, packed, units_, anchors_ in rows_of(batches):
            block = Block(sizes, inflated(packed), units_)
            kinds, index, _ = distinct(block.hash)
            block.keep(Answers(anchors_, number).of(kinds, parts)[index] > 0)
            yield one_row(TABLE_TYPES, home, number, ids, sizes, packed, block.shut_units(), block.key_rows(number, block.keys, parts))

    joined = blocks.join(anchors, "home", "left").select("home", "block", "ids", "sizes", "packed", "units", "anchors")
    digested = bucketed(map_arrow(joined, digest, TABLE), "digested")
    coded_units = counted(digested, 3, judge_units, "codes")
    judged = digested.drop("keys").join(coded_units, "home", "left")
    base = ["block", "sizes", "packed", "units", "codes"]

    def coded(number, sizes, packed, units_, codes_, wanted: int):
        """A block, its units' codes, and those that are the block's first of their kind and have a wanted code."""
        block = Block(sizes, inflated(packed), units_, digests=True)
        kinds, index, _ = distinct(block.keys)
        codes = Answers(codes_, number).of(kinds, parts)[index]
        once = np.zeros(len(index), bool)
        once[np.unique(index, return_index=True)[1]] = True
        return block, codes, np.nonzero((codes & wanted > 0) & once)[0]

    def meeting(batches):
        for row in rows_of(batches):
            block, _, chosen = coded(*row, MEETS)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.hash[chosen].view(np.int64)), pa.array([row[0]] * len(chosen), pa.int64()),
                 pa.array(block.first[chosen]), pa.array([block.string(i) for i in chosen], pa.binary())],
                ["anchor", "block", "first", "string"])

    def decide(batches):
        """Rows sorted by anchor: as many whole anchors as fit go into one suffix array."""
        held: list[tuple] = []
        size = 0

        def flush():
            found: dict[int, list] = {}
            for length, occurrences in maximal_repeats([h[3] for h in held]):
                for s, place in occurrences:
                    found.setdefault(s, []).append((place, place + length))
            spans = [(held[s][1], held[s][2] + a, held[s][2] + b) for s, own in found.items() for a, b in merged(own)]
            cols = list(zip(*spans)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["block", "start", "stop"])

        for row in rows_of(batches):
            if held and row[0] != held[-1][0] and size > BATCH_BYTES:
                yield flush()
                held, size = [], 0
            held.append(row)
            size += len(row[3])
        if held:
            yield flush()

    met = (map_arrow(judged.select(*base), meeting, "anchor long, block long, first long, string binary")
           .repartition(buckets, "anchor").sortWithinPartitions("anchor"))
    spans = stored(map_arrow(met, decide, "block long, start long, stop long"), f"{run}/spans")

    def window_rows(batches):
        for row in rows_of(batches):
            block, _, chosen = coded(*row, WINDOWS)
            yield one_row([("block", pa.int64()), ("keys", KEY_TYPE)], row[0], block.key_rows(row[0], block.window_keys(chosen)[1], parts))

    windows = counted(map_arrow(judged.select(*base), window_rows, f"block long, keys {KEY_ROWS}"), 3,
                      lambda kinds, count, number: (count > 1)[number], "windows")
    by_spans = (spans.groupBy(home_of(F.col("block")).alias("home"))
                .agg(F.collect_list(F.struct("block", "start", "stop")).alias("spans")))
    everything = judged.join(windows, "home", "left").join(by_spans, "home", "left")

    def finish(batches):
        for *row, windows_, spans_, ids in rows_of(batches):
            block, codes, chosen = coded(*row, WINDOWS)
            edge = np.zeros(len(block.data) + 1, np.int64)
            whole = codes & REPEATS > 0
            np.add.at(edge, block.first[whole], 1)
            np.add.at(edge, block.last[whole] + LENGTH, -1)
            starts, keys = block.window_keys(chosen)
            if len(starts):
                kinds, index, _ = distinct(keys)
                again = Answers(windows_, row[0]).of(kinds, parts)[index] > 0
                np.add.at(edge, starts[again], 1)
                np.add.at(edge, starts[again] + LENGTH, -1)
            for span in spans_ or ():
                if span["block"] == row[0]:
                    edge[span["start"]] += 1
                    edge[span["stop"]] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            removed, runs, shas = [], [], []
            for a, b in zip(block.starts, block.ends):
                own = gone[a:b]
                removed.append(int(own.sum()))
                runs.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
                shas.append(hashlib.sha256(block.data[a:b][~own].tobytes() if removed[-1] else block.raw[a:b]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(row[1], pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(runs, pa.int64()), pa.array(shas, pa.string())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    out = map_arrow(everything.select(*base, "windows", "spans", "ids"), finish,
                    "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    # Bucketed tables need a catalog entry; it goes as soon as the result no longer rests on them.
    out = stored(out, f"{run}/result")
    for name in named:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out.withColumnRenamed("id", id_col)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))
