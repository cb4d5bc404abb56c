"""Near-duplicates by b-bit MinHash.

1. A text's shingle set gives MinHash minima.  Bands of them make candidate buckets; of
   each minimum only the low bits stay, packed into a 48-byte signature.
2. Equal sets collapse to one class first, so exact copies never meet each other.
3. Buckets join their members to the bucket's smallest one.  The components of that graph
   are families: texts of different families share no band.
4. A family is dealt into chunks of bounded size, which share a few hub members.  In a
   chunk, packed signatures are compared by bit counts, the estimate is corrected for
   chance collisions, and what may reach the threshold is confirmed on full sets - best
   estimates first, and only pairs that are not connected already.
5. Families of several chunks that are still in pieces get the missing comparisons:
   members outside the largest piece against all members, chunk by chunk.

No bucket or family is capped.  What a task holds is bounded by the chunk size.  A link is
missed only if its pair shares no band (below 1e-7 at similarity 0.85) or its estimate is
five standard errors low.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators.resolve import connected_components

from .common import documents, stored
from .shingles import WordHashes, common, mix, shingle_set

BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
BITS = 4
PERCENT = 85             # 100 * intersection >= PERCENT * union
CHUNK = 1024             # members of a family in one task
REST_CHUNK = 256         # members outside the largest piece in one task
HUBS = 8                 # members that all chunks of a family share
ERRORS = 5.0             # standard errors an estimate may lie low

SETS = "doc_id long, n_shingles long, set_key binary, bands array<long>, packed binary"


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def minima(items: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The smallest value under each hash function; blocks bound the memory of long texts."""
    low = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 1024):
        np.minimum(low, (items[at:at + 1024, None] * multipliers).min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = low.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


def pack(low: np.ndarray) -> bytes:
    """Two minima to a byte: bits 32-35 of each."""
    bits = ((low >> np.uint64(32)) & np.uint64(15)).astype(np.uint8)
    return (bits[0::2] | (bits[1::2] << 4)).tobytes()


def matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many packed minima agree, for all rows of `a` (n x 48 bytes) against all of `b`."""
    left, right = a.view(np.uint64), b.view(np.uint64)
    ones = np.uint64(0x1111111111111111)
    out = np.full((len(left), len(right)), HASHES, np.int16)
    for k in range(left.shape[1]):
        x = left[:, k, None] ^ right[None, :, k]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        out -= np.bitwise_count(x & ones).astype(np.int16)
    return out


def estimate(agreeing: np.ndarray) -> np.ndarray:
    """Similarity from the share of agreeing minima, without the 2**-BITS chance collisions."""
    chance = 2.0 ** -BITS
    return (agreeing / HASHES - chance) / (1 - chance)


def least_matches(percent: int) -> int:
    s = percent / 100
    share = s + (1 - s) * 2.0 ** -BITS
    return int(np.floor(HASHES * (share - ERRORS * np.sqrt(share * (1 - share) / HASHES))))


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, packed) of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, factors = WordHashes(), _multipliers()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 2000):
                n, keys, bands, packed = [], [], [], []
                for text in texts[at:at + 2000].to_pylist():
                    items = shingle_set(text, hashes)
                    n.append(len(items))
                    keys.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                    if len(items):
                        low = minima(items, factors)
                        bands.append(band_keys(low))
                        packed.append(pack(low))
                    else:
                        bands.append(None)
                        packed.append(None)
                yield pa.RecordBatch.from_arrays(
                    [ids[at:at + 2000], pa.array(n, pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                    ["doc_id", "n_shingles", "set_key", "bands", "packed"])
    return docs.mapInArrow(run, SETS)


class Pieces:
    """Union-find over positions, smallest position as root."""

    def __init__(self, start):
        self.root = list(start)

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.root[max(i, j)] = min(i, j)
        return i != j


def confirmed(left: np.ndarray, right: np.ndarray, packed: np.ndarray, sets: list, sizes: np.ndarray,
              pieces: Pieces, percent: int) -> list[tuple[int, int]]:
    """Links that connect pieces, among positions `left` x `right`; best estimates first."""
    agree = matches(packed[left], packed[right])
    small = np.minimum(sizes[left, None], sizes[None, right])
    large = np.maximum(sizes[left, None], sizes[None, right])
    may = (agree >= least_matches(percent)) & (100 * small >= percent * large)
    may &= left[:, None] != right[None, :]
    a, b = np.nonzero(may)
    order = np.argsort(-agree[a, b], kind="stable")
    a, b = left[a[order]], right[b[order]]
    links = []
    step = 4096
    while len(a):
        for i, j in zip(a[:step].tolist(), b[:step].tolist()):
            if pieces.find(i) == pieces.find(j):
                continue
            both = common(sets[i], sets[j])
            if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                pieces.join(i, j)
                links.append((i, j))
        roots = np.array([pieces.find(i) for i in range(len(sets))])
        a, b = a[step:], b[step:]
        open_ = roots[a] != roots[b]
        a, b = a[open_], b[open_]
    return links


def _compare(percent: int, across: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        hashes = WordHashes()
        group = group.sort_values("id", kind="stable").reset_index(drop=True)
        ids = group["id"].to_numpy()
        sets = [shingle_set(t, hashes) for t in group["text"]]
        sizes = np.array([len(s) for s in sets], np.int64)
        packed = np.frombuffer(b"".join(group["packed"]), np.uint8).reshape(len(sets), -1)
        if across:   # what is connected already: positions of one piece share a root
            first: dict = {}
            start = [first.setdefault(p, i) for i, p in enumerate(group["piece"])]
            left = np.flatnonzero(group["outside"].to_numpy(bool))
        else:
            start, left = range(len(sets)), np.arange(len(sets))
        links = confirmed(left, np.arange(len(sets)), packed, sets, sizes, Pieces(start), percent)
        return pd.DataFrame({"src": [int(ids[i]) for i, _ in links], "dst": [int(ids[j]) for _, j in links]},
                            dtype="int64")
    return run


def near_links(classes: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(src, dst): confirmed links that connect everything that any links connect."""
    bucket = classes.select("id", F.explode("bands").alias("bucket"))
    shared = (bucket.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
              .filter("low < high").select("bucket", "low"))
    near = bucket.join(shared, "bucket").select(F.col("id").alias("src"), F.col("low").alias("dst")).distinct()
    families = connected_components(near).select(F.col("vertex").alias("id"), F.col("component").alias("family"))
    count = families.groupBy("family").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    placed = stored(families.join(count, "family").withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")))
    texts = docs.select(F.col("doc_id").alias("_id"), "text")
    members = stored(placed.join(classes.select(F.col("id").alias("_c"), "packed"), F.col("id") == F.col("_c"))
                     .join(texts, F.col("id") == F.col("_id"))
                     .select("id", "family", "chunks", "chunk", "packed", "text"))
    hubs = (members.filter(f"chunks > 1 and chunk < {HUBS}").groupBy("family", "chunk")
            .agg(F.min("id").alias("hub")).select(F.col("family").alias("_f"), "hub", F.col("chunk").alias("home")))
    copies = (members.join(hubs, (F.col("family") == F.col("_f")) & (F.col("id") == F.col("hub")))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .filter("chunk <> home").select(*members.columns))
    links = stored(members.unionByName(copies).groupBy("family", "chunk")
                   .applyInPandas(_compare(percent, False), "src long, dst long"))

    split = members.filter("chunks > 1")
    pieces = connected_components(links).select(F.col("vertex").alias("_v"), "component")
    now = stored(split.join(pieces, F.col("id") == F.col("_v"), "left")
                 .withColumn("piece", F.coalesce("component", "id")).drop("_v", "component"))
    by_piece = now.groupBy("family", "piece").count()
    largest = by_piece.groupBy("family").agg(F.max(F.struct("count", "piece")).alias("top"),
                                             F.sum("count").alias("all"))
    open_ = (largest.filter("all > top.count").select(
        F.col("family").alias("_f"), F.col("top.piece").alias("main"),
        F.ceil((F.col("all") - F.col("top.count")) / REST_CHUNK).cast("int").alias("rests")))
    rest = now.join(open_, F.col("family") == F.col("_f")).withColumn("outside", F.col("piece") != F.col("main"))
    every = (rest.withColumn("outside", F.lit(False))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("rests") - 1))))
    outer = (rest.filter("outside").withColumn("part", F.pmod(F.xxhash64(F.lit(1), "id"), F.col("rests")).cast("int"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))))
    more = (every.unionByName(outer).groupBy("family", "chunk", "part")
            .applyInPandas(_compare(percent, True), "src long, dst long"))
    return links.unionByName(more)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Null, empty and white-space texts have an empty set and link with nothing.  Rows that
    share an id count as one document with the links of all its texts.  A null id links
    with nothing and stays (component_id null).  An empty table gives no rows.
    """
    texts = documents(docs, id_col, text_col)
    sets = stored(shingle_sets(texts))
    classes = stored(sets.filter("n_shingles > 0 and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.first("packed").alias("packed")))
    links = near_links(classes, texts, percent)
    same = classes.select(F.col("set_key").alias("_k"), F.col("id").alias("class_id"))
    parts = connected_components(links).select(F.col("vertex").alias("_v"), "component")
    roots = same.join(parts, F.col("class_id") == F.col("_v"), "left").select(
        "_k", F.coalesce("component", "class_id").alias("root"))
    linked = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull() & (F.col("set_key") == F.col("_k"))
    out = sets.select("doc_id", "n_shingles", "set_key").join(roots, linked, "left")
    component = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
                      (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))
