"""Near-duplicates by SuperMinHash signatures, banding, verification and union-find.

A document's set holds its distinct five-word shingles (words split at ASCII white space, A-Z lower
case); with fewer words the whole sequence is the one shingle.  Two documents are linked if their
sets' Jaccard similarity is 0.75 or more (100 * intersection >= 75 * union, on the full sets).

1. Signature: SuperMinHash.  Each element walks through its own random permutation of the slots and
   offers step + fraction to the slot it meets; the offers of one element are thus spread over the
   slots, which lowers the variance below MinHash's.  A document is done as soon as every slot
   holds a value that no later step can beat, mostly after two or three of the 160 steps.
2. Documents with the same set form a class; from here on one document stands for each class.
3. Banding: BANDS bands of ROWS slots.  A pair at the threshold shares no band with a probability
   of (1 - 0.75 ** 4) ** 40 = 2.5e-7, a closer pair with less.
4. Verification on full sets, in two passes, so that no bucket is expanded into all its pairs:
   a. every member of a bucket against the bucket's hub (the member that shares the most buckets);
      this decides buckets of two, and buckets whose members all end up connected;
   b. buckets of three and more that are still split: their members, gathered into groups of
      buckets that overlap, are dealt into blocks of about BLOCK documents, and each pair of blocks
      is compared in one task as a matrix product.  Nothing is capped, so nothing is lost.
5. Union-find over the links; the component's smallest id names it.

Shingles are 64-bit hashes; the probability that two of a pair's shingles collide is below 1e-12.

Rows that share an id are linked with each other, whatever their texts: the graph's nodes are ids, and
an id with several sets takes part with each of them.

Defined cases: null and empty texts and texts of white space only have an empty set and are linked
with nothing, not even with rows of their own id; a null id takes no part (component_id null, kept
true); rows that share an id and have words share a component; repeated rows share their class; an
empty table gives an empty result; extra columns, whatever their names, are ignored; texts of any
length count whole (memory in a task follows the longest text's number of shingles).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, hold, map_arrow, new_run, ship_code, stored, table
from .components import UnionFind, connected_components

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 40, 4
SLOTS = BANDS * ROWS
BLOCK = 128
MOST_CACHED = 300_000
GROUP_ELEMENTS = 150_000

_WORDS: dict[bytes, int] = {}
_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    # On bytes, lower() and split() know ASCII only, as the contract has it.
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_WORDS) > MOST_CACHED:
        _WORDS.clear()
    known = _WORDS
    for w in words:
        if w not in known:
            known[w] = xxhash.xxh64_intdigest(w)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(words) < SHINGLE:
        out = np.full(1, len(words), np.uint64)
        for v in h:
            out = mixed(out * _U(0x9E3779B97F4A7C15) + v)
        return out
    out = mixed(h[:len(h) - SHINGLE + 1] + _U(SHINGLE))
    for k in range(1, SHINGLE):
        out = mixed(out * _U(0x9E3779B97F4A7C15) + h[k:len(h) - SHINGLE + 1 + k])
    return np.unique(out)


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One SuperMinHash signature for each non-empty set, all sets side by side."""
    best = np.full((len(sets), slots), np.inf)
    flat = best.reshape(-1)
    x = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    swaps: list[np.ndarray] = []
    for step in range(slots):
        z = mixed(x + _U((step + 1) * 0x9E3779B97F4A7C15 & (2 ** 64 - 1)))
        offer = step + (z >> _U(24)).astype(np.float64) * 2.0 ** -40
        pick = step + (((z & _U(0xFFFFFF)) * _U(slots - step)) >> _U(24)).astype(np.int16)
        # Each element shuffles its own list of slots (Fisher-Yates); instead of keeping the lists,
        # follow the swaps made so far backwards from the picked place to the slot that lies there.
        slot = pick.copy()
        for i in range(step - 1, -1, -1):
            slot = np.where(slot == i, swaps[i], np.where(slot == swaps[i], np.int16(i), slot))
        np.minimum.at(flat, doc * slots + slot, offer)
        swaps.append(pick)
        # Later offers are at least step + 1: a set all of whose slots lie below is done.
        open_ = best.max(axis=1) >= step + 1
        stay = open_[doc]
        if not stay.all():
            x, doc, swaps = x[stay], doc[stay], [s[stay] for s in swaps]
            if not len(x):
                break
    return best


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature."""
    v = signatures.view(np.uint64).reshape(len(signatures), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), v.shape[:2]).copy()
    for r in range(ROWS):
        out = mixed(out * _U(0x9E3779B97F4A7C15) + v[:, :, r])
    return out.view(np.int64)


def sketch(batches):
    hold("near", _WORDS.clear)
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            counts, digests, keys = [], [], [None] * part.num_rows
            pending: list[tuple[int, np.ndarray]] = []

            def flush():
                if pending:
                    for (i, _), row in zip(pending, band_keys(super_minhash([s for _, s in pending]))):
                        keys[i] = row
                    pending.clear()

            size = 0
            for i, cell in enumerate(part.column(1)):
                own = shingle_set(cell.as_py())
                counts.append(len(own))
                digests.append(set_digest(own))
                if len(own):
                    pending.append((i, own))
                    size += len(own)
                    if size > GROUP_ELEMENTS:
                        flush()
                        size = 0
            flush()
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "n", "digest", "bands"])


def set_digest(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def with_digest(batches):
    """(id, text) -> (id, text, digest of its set)."""
    hold("near", _WORDS.clear)
    for batch in batches:
        digests = [set_digest(shingle_set(cell.as_py())) for cell in batch.column(1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], ["id", "text", "digest"])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two non-empty sets reach the threshold, exactly."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def verify(batches):
    """(a, text_a, b, text_b, which of b's sets), rows of one b side by side -> the pairs that are linked."""
    hold("near", _WORDS.clear)
    last, last_set = None, None
    for batch in batches:
        b = list(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()))
        keep = []
        for i in range(batch.num_rows):
            if b[i] != last:
                last, last_set = b[i], shingle_set(batch.column(3)[i].as_py())
            keep.append(similar(shingle_set(batch.column(1)[i].as_py()), last_set))
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(2).filter(pa.array(keep))],
                                         ["a", "b"])


def block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the documents of one or two blocks; a spanning forest of them is enough."""
    hold("near", _WORDS.clear)
    ids, sets = rows["id"].tolist(), [shingle_set(t) for t in rows["text"]]
    size = np.array([len(s) for s in sets])
    values, index = np.unique(np.concatenate(sets), return_inverse=True)
    doc = np.repeat(np.arange(len(sets)), size)
    shared = np.nonzero(np.bincount(index, minlength=len(values)) > 1)[0]
    column = np.full(len(values), -1)
    column[shared] = np.arange(len(shared))
    column = column[index]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, len(shared), 16384):
        inside = (column >= at) & (column < at + 16384)
        m = np.zeros((len(sets), min(16384, len(shared) - at)), np.float32)
        m[doc[inside], column[inside] - at] = 1
        both += m @ m.T
    union = size[:, None] + size[None, :] - both
    found, links = UnionFind(), []
    for i, j in zip(*np.nonzero(np.triu(100 * both >= PERCENT * union, 1))):
        if found.join(ids[i], ids[j]):
            links.append((ids[i], ids[j]))
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id, kept for each row."""
    spark = docs.sparkSession
    ship_code(spark)
    run = new_run(spark, "near")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sketches = stored(map_arrow(rows, sketch, "id long, n long, digest binary, bands array<long>"), f"{run}/sketches")
    real = sketches.filter("n > 0 AND id IS NOT NULL")
    classes = stored(real.groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")), f"{run}/classes")
    # Ids with several sets link the classes of these.
    several = stored(real.groupBy("id").agg(F.min(F.xxhash64("digest")).alias("low"), F.max(F.xxhash64("digest")).alias("high"))
                     .filter("low < high").select("id"), f"{run}/several")
    sets = stored(real.join(several, "id").select("id", "digest").distinct(), f"{run}/sets")
    reps = sets.join(classes, "digest").select("id", "rep")
    lowest = reps.groupBy("id").agg(F.min("rep").alias("a"))
    same = stored(reps.join(lowest, "id").filter("a < rep").select("a", F.col("rep").alias("b")).distinct(), f"{run}/same")
    # One row for each class: its smallest id's; ``d`` tells the sets of one id apart.
    nodes = (real.join(classes.select(F.col("rep").alias("id"), "digest"), ["id", "digest"]).dropDuplicates(["id", "digest"])
             .join(several.withColumn("d", F.lit(1)), "id", "left"))
    banded = nodes.select("id", F.when(F.col("d").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("digest")).alias("d"),
                          F.explode("bands").alias("key"))
    shared = stored(banded.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("low"), F.max("id").alias("high"))
                    .filter("low < high").select("key", "members"), f"{run}/shared")
    members = stored(banded.join(shared, "key").distinct(), f"{run}/members")
    # The hub of a bucket: the member with the most company over all its buckets.
    company = stored(members.groupBy("id", "d").agg(F.sum("members").alias("company")), f"{run}/company")
    placed = members.join(company, ["id", "d"])
    hubs = stored(placed.groupBy("key").agg(F.max(F.struct("company", (-F.col("id")).alias("minus"), "d")).alias("top"))
                  .select("key", (-F.col("top.minus")).alias("hub"), F.col("top.d").alias("hub_d")), f"{run}/hubs")
    pairs = stored(members.join(hubs, "key").filter("id <> hub").select("id", "d", "hub", "hub_d").distinct(), f"{run}/pairs")
    # The text of each node: any of its id's, or for ids with several sets the one that has the set.
    alone = rows.join(company.filter("d = 0").select("id", "d"), "id")
    told = map_arrow(rows.join(several, "id"), with_digest, "id long, text string, digest binary").select(
        "id", "text", F.xxhash64("digest").alias("d")).join(company.select("id", "d"), ["id", "d"])
    texts = stored(alone.select("id", "d", "text").unionByName(told).groupBy("id", "d").agg(F.min("text").alias("text")),
                   f"{run}/texts")
    # Both sides are tables, one row of `texts` for each node: a hub with many members is a skewed
    # join, which Spark splits at run time.
    ends = texts.select(F.col("id").alias("hub"), F.col("d").alias("hub_d"), F.col("text").alias("text_b"))
    compared = (pairs.join(texts, ["id", "d"]).select("id", F.col("text").alias("text_a"), "hub", "hub_d")
                .join(ends, ["hub", "hub_d"])
                .select(F.col("id").alias("a"), "text_a", F.col("hub").alias("b"), "text_b", "hub_d"))
    links = stored(map_arrow(compared, verify, "a long, b long").unionByName(same), f"{run}/links")
    first = connected_components(links, f"{run}/first")
    # Buckets of three and more that are still split.
    state = (members.filter("members > 2").join(first.withColumnRenamed("node", "id"), "id", "left")
             .select("key", "id", F.coalesce("component", "id").alias("c")))
    split = state.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.min("id").alias("a")).filter("low < high")
    rest = stored(members.join(stored(split.select("key", "a"), f"{run}/split"), "key")
                  .select("a", F.col("id").alias("b")).distinct(), f"{run}/rest")
    family = connected_components(rest, f"{run}/families")
    sizes = stored(family.groupBy("component").agg(F.count(F.lit(1)).alias("size")), f"{run}/sizes")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    dealt = (family.join(sizes, "component").withColumn("blocks", blocks)
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.col("node").alias("id"), F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("task")))
    more = dealt.join(texts.select("id", "text"), "id").groupBy("task").applyInPandas(block_links, "a long, b long")
    every = links.unionByName(stored(more, f"{run}/more"))
    final = connected_components(every, f"{run}/final")
    # Back to all rows by class: only classes of several documents or in larger components need it.
    named = (classes.join(final.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("component_id", F.coalesce("component", "rep"))
             .filter("size > 1 OR component_id <> rep").select("digest", "component_id"))
    named = stored(named, f"{run}/named")
    out = (sketches.select("id", "n", "digest").join(named, "digest", "left")
           .withColumn("component_id", F.coalesce("component_id", "id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose document names its component, with all their columns; rows without words stay."""
    gone = near_components(docs, id_col, text_col).filter(~F.col("kept")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, (docs[id_col] == gone["_gone"]) & docs[text_col].rlike(WORD), "left_anti")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))
