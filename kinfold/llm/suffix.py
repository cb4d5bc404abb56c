"""Repeated byte strings by suffix arrays, built shard by shard with induced sorting.

A string of LENGTH bytes that occurs twice must end up in one shard at both places, so
shards are cut by content:

1. Winnowing: of every LENGTH bytes, the 32-byte gram with the smallest hash is an anchor.
   Both occurrences of a repeated string have the same anchor at the same place in it.  An
   anchor's context are the bytes that a LENGTH-byte string around it can reach.
2. Anchors meet by hash.  A context equal to an earlier one is removed as it stands; this
   is decided in the task that finds them, too, so what thousands of documents share
   travels once per task.  Anchors with different contexts go on to the arrays.
3. Each shard concatenates the remaining contexts and sorts their suffixes by induction:
   suffix types, leftmost-smaller (LMS) substrings sorted by a first induction and named,
   the string of names sorted in its turn, a second induction for all suffixes.  numpy
   induces a whole bucket at a time.  (The string of names is sorted by rank doubling, for
   its alphabet is too large to induce bucket by bucket.)
   An anchor with more than HOT contexts would make a shard uneven.  It is widened: a string
   around it reaches half of what is missing to LENGTH on its left or on its right, so each
   context goes to the anchor with those bytes on its left and to that with those on its
   right, cut to what strings around these can reach.  Equal contexts collapse again, what
   is alone with its anchor is done with, and what is still hot is widened once more, until
   an anchor is a whole string.
4. Common prefixes with the predecessor in the array are computed in text order
   (permuted), up to LENGTH; equal strings form runs, and all but a run's first
   occurrence are marked.

Spans merge per document at the end.  What a task holds is one input batch, one share of
the anchors (shares and shards follow the input) or one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, stored
from .shingles import mix

LENGTH = 100         # bytes of a repeated string
GRAM = 32            # bytes of an anchor
STEP = 1 << 18       # bytes hashed at once; longer texts are cut with overlaps
FLUSH = 1 << 19      # anchors that a task holds before it sends them on
SHARD_BYTES = 1 << 20  # of contexts that one suffix array sorts, about
SHARE_BYTES = 1 << 25  # of texts whose anchors meet in one share, about
HOT = 512            # contexts of one anchor that a shard takes, a twelfth of it

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int):
        if len(self.up) < n:
            size = max(n, STEP + 4 * LENGTH)
            for name, base in (("up", _ODD), ("down", _INVERSE)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self.up, self.down


def _sliding(op, x: np.ndarray, width: int) -> np.ndarray:
    """op over every `width` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x = op(x[:-have], x[have:])
        have *= 2
    return op(x[: len(x) - (width - have)], x[width - have:]) if have < width else x


def anchors(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, powers: Powers):
    """(positions, gram hashes, context hashes, context starts, context ends) in `data`,
    whose documents lie at starts..ends."""
    n = len(data)
    none = np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    if n < LENGTH:
        return none
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:n], out=total[1:])
    grams = mix((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1])
    reach = LENGTH - GRAM + 1
    low = _sliding(np.minimum, grams, reach)          # of the window that starts here
    for start, end in zip(starts.tolist(), ends.tolist()):
        low[max(start, end - LENGTH + 1):end] = 0     # windows that leave the document
    padded = np.zeros(len(low) + 2 * (reach - 1), np.uint64)
    padded[reach - 1: reach - 1 + len(low)] = low
    at = np.flatnonzero(_sliding(np.maximum, padded, reach) == grams)
    at = at[grams[at] != 0]
    doc = np.searchsorted(ends, at, side="right")
    lo = np.maximum(at - (LENGTH - GRAM), starts[doc])
    hi = np.minimum(at + LENGTH, ends[doc])
    context = mix((total[hi] - total[lo]) * down[lo] + (at - lo).astype(np.uint64) * np.uint64(_ODD))
    return at, grams[at], context, lo, hi


ANCHOR = np.dtype([("gram", "<u8"), ("context", "<u8"), ("doc", "<i8"), ("lo", "<i8"), ("at", "<i4"), ("size", "<i4")])
SPAN = np.dtype([("doc", "<i8"), ("lo", "<i8"), ("hi", "<i8")])


def first_contexts(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first occurrence of each context, spans of the later ones)."""
    found = found[np.lexsort((found["lo"], found["doc"], found["context"], found["gram"]))]
    new = np.ones(len(found), bool)
    new[1:] = (found["gram"][1:] != found["gram"][:-1]) | (found["context"][1:] != found["context"][:-1])
    # the same place seen twice is no repetition
    lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(found) else np.empty(0, np.int64)
    again = ~new & ((found["doc"] != found["doc"][lead]) | (found["lo"] != found["lo"][lead]))
    later = found[again & (found["size"] >= LENGTH)]
    spans = np.empty(len(later), SPAN)
    spans["doc"], spans["lo"], spans["hi"] = later["doc"], later["lo"], later["lo"] + later["size"]
    return found[new], merged(spans)


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted spans, those that touch or overlap in a document made one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["lo"], spans["doc"]))]
    new_doc = np.ones(len(spans), bool)
    new_doc[1:] = spans["doc"][1:] != spans["doc"][:-1]
    # running maximum of the ends inside a document: documents are set apart by an offset
    width = int(spans["hi"].max()) + 2
    shift = (np.cumsum(new_doc) - 1) * width
    top = np.maximum.accumulate(spans["hi"] + shift)
    begin = np.ones(len(spans), bool)
    begin[1:] = (spans["lo"][1:] + shift[1:]) > top[:-1]
    at = np.flatnonzero(begin)
    out = spans[at].copy()
    out["hi"] = top[np.append(at[1:], len(spans)) - 1] - shift[at]
    return out


def _jobs(offsets: np.ndarray):
    """(first document, end document, lo, hi, keep_lo, keep_hi): byte ranges hashed at once."""
    margin, i, n = 4 * LENGTH, 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + STEP, side="right")) - 1
        if j > i:
            yield i, j, int(offsets[i]), int(offsets[j]), int(offsets[i]), int(offsets[j])
            i = j
            continue
        start, end = int(offsets[i]), int(offsets[i + 1])
        for at in range(start, end, STEP):
            stop = min(end, at + STEP)
            yield i, i + 1, max(start, at - margin), min(end, stop + margin), at, stop
        i += 1


def _text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets) of an Arrow string column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data, offsets


def find_anchors(docs: DataFrame, shares: int) -> DataFrame:
    """(share, found, spans): packed anchors per share of the gram hashes, and spans that
    the task itself saw repeated."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, count = Powers(), [], 0

        def flush():
            first, spans = first_contexts(np.concatenate(held))
            share = (first["gram"] % np.uint64(shares)).astype(np.int64)
            order = np.argsort(share, kind="stable")
            first, cut = first[order], np.searchsorted(share[order], np.arange(shares + 1))
            mine = np.array_split(spans, shares)
            full = [k for k in range(shares) if cut[k] < cut[k + 1] or len(mine[k])]
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()),
                 pa.array([first[cut[k]:cut[k + 1]].tobytes() for k in full], pa.binary()),
                 pa.array([mine[k].tobytes() for k in full], pa.binary())], ["share", "found", "spans"])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = _text_bytes(batch.column(1))
            for i, j, lo, hi, keep_lo, keep_hi in _jobs(offsets):
                starts = np.maximum(offsets[i:j], lo) - lo
                ends = np.minimum(offsets[i + 1:j + 1], hi) - lo
                at, gram, context, left, right = anchors(data[lo:hi], ends, starts, powers)
                keep = (at + lo >= keep_lo) & (at + lo < keep_hi)
                doc = np.searchsorted(ends, at[keep], side="right") + i
                part = np.empty(int(keep.sum()), ANCHOR)
                part["gram"], part["context"], part["doc"] = gram[keep], context[keep], ids[doc]
                part["lo"] = left[keep] + lo - offsets[doc]
                part["at"], part["size"] = (at - left)[keep], (right - left)[keep]
                held.append(part)
                count += len(part)
                if count >= FLUSH:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()
    return docs.mapInArrow(run, "share int, found binary, spans binary")


def _meet(table: pa.Table) -> pa.Table:
    """One share of the anchors: spans of repeated contexts; anchors whose contexts differ."""
    found = np.frombuffer(b"".join(table.column("found").to_pylist()), ANCHOR)
    spans = np.frombuffer(b"".join(table.column("spans").to_pylist()), SPAN)
    first, later = first_contexts(found)
    _, back, count = np.unique(first["gram"], return_inverse=True, return_counts=True)
    together = count[back]
    open_, together = first[together > 1], together[together > 1]
    spans = merged(np.concatenate([spans, later]))
    doc = np.concatenate([spans["doc"], open_["doc"]])
    lo = np.concatenate([spans["lo"], open_["lo"]])
    hi = np.concatenate([spans["hi"], open_["lo"] + open_["size"]])
    gram = np.concatenate([np.zeros(len(spans), np.int64), open_["gram"].view(np.int64)])
    at = np.concatenate([np.zeros(len(spans), np.int32), open_["at"]])
    n = np.concatenate([np.zeros(len(spans), np.int64), together])
    return pa.table({"doc_id": doc, "lo": lo, "hi": hi, "gram": gram, "at": at, "n": n})


# --- suffix arrays ------------------------------------------------------------------

def _scatter(queue: list, values: np.ndarray, chars: np.ndarray) -> None:
    """Appends values to the queues of their characters, order kept."""
    if not len(values):
        return
    order = np.argsort(chars, kind="stable")
    values, chars = values[order], chars[order]
    cut = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    begin = np.concatenate([[0], cut])
    for a, b in zip(begin.tolist(), np.append(cut, len(values)).tolist()):
        queue[chars[a]].append(values[a:b])


def _join(parts: list) -> np.ndarray:
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.int64)


def induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in order, induced from LMS suffixes given in order within each character.

    text[i-1] for every suffix i of a bucket is pushed to its own bucket: larger suffixes
    from the left end upwards, then smaller ones from the right end downwards.  Pushes into
    the bucket at hand form further waves, which keeps the order of a scan.
    """
    left: list = [[] for _ in range(size)]
    seeds: list = [[] for _ in range(size)]
    _scatter(seeds, lms, text[lms])
    done: list = [None] * size

    def pushed(wave: np.ndarray, want_smaller: bool):
        before = wave[wave > 0] - 1
        before = before[smaller[before] == want_smaller]
        return before, text[before]

    for c in range(size):
        wave = _join(left[c])
        all_ = [wave]
        while len(wave):
            before, chars = pushed(wave, False)
            own = chars == c
            _scatter(left, before[~own], chars[~own])
            wave = before[own]
            all_.append(wave)
        done[c] = _join(all_)
        _scatter(left, *pushed(_join(seeds[c]), False))
    right: list = [[] for _ in range(size)]
    out: list = [None] * size
    for c in range(size - 1, -1, -1):
        wave = _join(right[c])
        all_ = [wave]
        while len(wave):
            before, chars = pushed(wave, True)
            own = chars == c
            _scatter(right, before[~own], chars[~own])
            wave = before[own]
            all_.append(wave)
        _scatter(right, *pushed(done[c][::-1], True))
        ends = _join(all_)[::-1]
        out[c] = np.concatenate([done[c], ends])
    # the last character, smallest and alone, is no predecessor of anything: put it first
    out[0] = np.array([len(text) - 1], np.int32)
    return np.concatenate(out)


def _doubling(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names by rank doubling."""
    rank, k, n = names.astype(np.int64), 1, len(names)
    while True:
        second = np.full(n, 0, np.int64)
        second[: n - k] = rank[k:] + 1
        key = rank * (n + 2) + second
        order = np.argsort(key)
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        k *= 2


def suffix_array(text: np.ndarray, size: int, powers: Powers) -> np.ndarray:
    """Suffix array of values 0..size-1 whose last is a 0 that occurs nowhere else."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    # where the run of equal characters that holds i ends
    following = np.arange(n, dtype=np.int32)
    following[:-1][text[1:] == text[:-1]] = n - 1
    following = np.minimum.accumulate(following[::-1])[::-1]
    smaller = text[following] < text[np.minimum(following + 1, n - 1)]
    smaller[n - 1] = True
    lms = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    order = induce(text, smaller, lms, size)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_ = order[is_lms[order]]
    # names: equal LMS substrings are neighbours now; compared by length and 64-bit hash
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(text.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    stop = np.full(n, n, np.int64)
    stop[lms[:-1]] = lms[1:] + 1
    width = stop[sorted_] - sorted_
    value = (total[stop[sorted_]] - total[sorted_]) * down[sorted_]
    new = np.ones(len(sorted_), bool)
    new[1:] = (width[1:] != width[:-1]) | (value[1:] != value[:-1])
    name = np.cumsum(new) - 1
    if name[-1] < len(lms) - 1:
        names = np.empty(n, np.int64)
        names[sorted_] = name
        sorted_ = lms[_doubling(names[lms])]
    return induce(text, smaller, sorted_, size)


def common_prefixes(data: np.ndarray, at: np.ndarray, before: np.ndarray, most: int) -> np.ndarray:
    """min(most, common prefix) of the suffixes at[k] and before[k], in the order given."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    words = np.ascontiguousarray(words).view("<u8").ravel()
    out = np.full(len(at), most, np.int64)
    live = np.arange(len(at))
    for k in range(0, most, 8):
        if not len(live):
            break
        x = words[at[live] + k] ^ words[before[live] + k]
        miss = x != 0
        low = x[miss] & (~x[miss] + np.uint64(1))            # lowest bit that differs
        bytes_ = np.log2(low.astype(np.float64)).astype(np.int64) // 8
        out[live[miss]] = np.minimum(most, k + bytes_)
        live = live[~miss]
    return out


def may_repeat(doc: np.ndarray, lo: np.ndarray, contexts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Contexts with a string whose hash also occurs at another place; the rest cannot
    matter and need no sorting."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    body = np.frombuffer(b"".join(contexts), np.uint8)
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), np.maximum(0, sizes - length + 1))
    if not len(owner):
        return np.zeros(len(sizes), bool)
    start = np.cumsum(sizes) - sizes
    first = np.cumsum(np.maximum(0, sizes - length + 1)) - np.maximum(0, sizes - length + 1)
    inside = np.arange(len(owner)) - first[owner]
    up, down = Powers()(len(body) + 1)
    total = np.zeros(len(body) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[body] * up[:len(body)], out=total[1:])
    at = start[owner] + inside
    value = (total[at + length] - total[at]) * down[at]
    place = mix(mix(doc.astype(np.uint64))[owner] + (lo[owner] + inside).astype(np.uint64))
    order = np.argsort(value)
    value, place = value[order], place[order]
    begin = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    several = np.minimum.reduceat(place, begin) != np.maximum.reduceat(place, begin)
    out = np.zeros(len(sizes), bool)
    out[owner[order[np.repeat(several, np.diff(np.append(begin, len(value))))]]] = True
    return out


def repeated_in_shard(doc: np.ndarray, lo: np.ndarray, contexts: list[bytes], length: int = LENGTH) -> np.ndarray:
    """Spans of all strings of `length` bytes that also start earlier in these contexts."""
    live = np.flatnonzero(may_repeat(doc, lo, contexts, length))
    if not len(live):
        return np.empty(0, SPAN)
    doc, lo, contexts = doc[live], lo[live], [contexts[i] for i in live.tolist()]
    sizes = np.array([len(c) for c in contexts], np.int64)
    body = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8)
    start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    text = body.astype(np.int16) + 2
    text[start + sizes] = 1                                   # after each context
    text = np.append(text, np.int16(0))
    order = suffix_array(text, 258, Powers())
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    inside = np.arange(len(body)) - start[owner]
    whole = inside + length <= sizes[owner]
    order = order[order < len(body)]
    order = order[whole[order]]                               # strings that fit their context
    if len(order) < 2:
        return np.empty(0, SPAN)
    before = np.full(len(body), -1, np.int64)                 # permuted: text order
    before[order[1:]] = order[:-1]
    at = np.flatnonzero(before >= 0)
    same = np.zeros(len(body), bool)
    same[at] = common_prefixes(body, at, before[at], length) >= length
    equal = same[order]
    group = np.cumsum(~equal) - 1
    docs, rank = np.unique(doc, return_inverse=True)
    place = lo[owner[order]] + inside[order]
    span = int(place.max()) + 1
    key = rank[owner[order]].astype(np.int64) * span + place
    least = np.minimum.reduceat(key, np.flatnonzero(~equal))
    late = key > least[group]
    spans = np.empty(int(late.sum()), SPAN)
    spans["doc"], spans["lo"] = docs[rank[owner[order[late]]]], place[late]
    spans["hi"] = spans["lo"] + length
    return merged(spans)


def _sort_shard(table: pa.Table) -> pa.Table:
    contexts = table.column("context").to_pylist()
    spans = repeated_in_shard(table.column("doc_id").to_numpy(), table.column("lo").to_numpy(), contexts)
    return pa.table({"doc_id": spans["doc"], "lo": spans["lo"], "hi": spans["hi"]})


CONTEXT = "key long, doc_id long, lo long, at int, n long, context binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CONTEXT rows of documents and their open anchors."""
    for batch in batches:
        ids, opens = batch.column(0).to_pylist(), batch.column(2)
        texts = batch.column(1).cast(pa.large_binary())
        doc, gram, lo, at, n, context = [], [], [], [], [], []
        for i, key in enumerate(ids):
            raw = texts[i].as_py()
            for o in opens[i].as_py():
                doc.append(key)
                gram.append(o["gram"])
                lo.append(o["lo"])
                at.append(o["at"])
                n.append(o["n"])
                context.append(raw[o["lo"]:o["hi"]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(gram, pa.int64()), pa.array(doc, pa.int64()), pa.array(lo, pa.int64()),
             pa.array(at, pa.int32()), pa.array(n, pa.int64()), pa.array(context, pa.binary())],
            ["key", "doc_id", "lo", "at", "n", "context"])


def widened(rows: DataFrame, width: int) -> tuple[DataFrame, int]:
    """(CONTEXT rows without n, width): contexts of anchors of `width` bytes under the wider
    anchors that hold half of the missing bytes on their left, or on their right."""
    missing = LENGTH - width
    step = -(-missing // 2)
    reach = missing - step
    end = F.col("at") + width

    def side(begin: Column, stop: Column, holds: Column) -> Column:
        """The anchor that starts at `begin`, in what strings around it reach."""
        first = F.greatest(begin - reach, F.lit(0))
        last = F.least(stop + reach, F.length("context"))
        return F.when(holds & (last - first >= LENGTH), F.struct(
            F.xxhash64(F.substring("context", begin + 1, F.lit(width + step))).alias("key"),
            (F.col("lo") + first).alias("lo"), (begin - first).cast("int").alias("at"),
            F.substring("context", first + 1, last - first).alias("context")))

    left = side(F.col("at") - step, end, F.col("at") >= step)
    right = side(F.col("at"), end + step, F.length("context") - end >= step)
    sides = rows.select("doc_id", F.explode(F.array_compact(F.array(left, right))).alias("s"))
    return sides.select("s.key", "doc_id", "s.lo", "s.at", "s.context"), width + step


def split_hot(rows: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(contexts whose anchors have up to HOT of them, spans of repeated contexts) of CONTEXT
    rows whose anchors have more."""
    cold, spans, width = [], [], GRAM
    place = F.struct("doc_id", "lo", "at")
    while width < LENGTH and not rows.isEmpty():
        wide, width = widened(rows, width)
        wide = stored(wide)
        firsts = wide.groupBy("key", "context").agg(F.min(place).alias("first"), F.max(place).alias("last"))
        again = firsts.filter("first.doc_id <> last.doc_id or first.lo <> last.lo").select(
            F.col("key").alias("_key"), F.col("context").alias("_context"), "first")
        later = wide.join(again, (F.col("key") == F.col("_key")) & (F.col("context") == F.col("_context")))
        spans.append(later.filter(F.struct("doc_id", "lo") > F.struct("first.doc_id", "first.lo")).select(
            "doc_id", "lo", (F.col("lo") + F.length("context")).alias("hi")))
        if width == LENGTH:
            break                                   # what an anchor holds is one string now
        firsts = stored(firsts.select("key", "first.*", "context"))
        sizes = firsts.groupBy(F.col("key").alias("_key")).agg(F.count("*").alias("n")).filter("n > 1")
        met = stored(firsts.join(sizes, F.col("key") == F.col("_key")).drop("_key"))
        cold.append(met.filter(F.col("n") <= HOT))
        rows = met.filter(F.col("n") > HOT)
    return cold, spans


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, lo, hi): byte spans covered by strings that also start earlier; they may overlap."""
    known = docs.filter("doc_id is not null")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_bytes = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = max(parts, -(-n_bytes // SHARE_BYTES))
    met = stored(find_anchors(known, shares).repartition(shares, "share").groupBy("share").applyInArrow(
        _meet, "doc_id long, lo long, hi long, gram long, at int, n long"))
    opens = (met.filter("n > 0").groupBy(F.col("doc_id").alias("_id"))
             .agg(F.collect_list(F.struct("gram", "lo", "hi", "at", "n")).alias("opens")))
    contexts = stored(known.join(opens, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "opens")
                      .mapInArrow(_contexts, CONTEXT))
    cold, spans = split_hot(contexts.filter(F.col("n") > HOT))
    columns = ["key", "doc_id", "lo", "context"]
    for_arrays = contexts.filter(F.col("n") <= HOT).select(*columns)
    for part in cold:
        for_arrays = for_arrays.unionByName(part.select(*columns))
    n_bytes = for_arrays.agg(F.sum(F.length("context"))).first()[0] or 0
    shards = max(parts, -(-n_bytes // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard")
    out = for_arrays.groupBy(shard).applyInArrow(_sort_shard, "doc_id long, lo long, hi long")
    for part in [met.filter("n = 0").select("doc_id", "lo", "hi"), *spans]:
        out = out.unionByName(part)
    return out


REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        texts = batch.column(1).cast(pa.large_binary())
        spans = batch.column(2)
        size, removed, runs, kept = [], [], [], []
        for i in range(batch.num_rows):
            raw = texts[i].as_py()
            end, cut, n, parts = 0, 0, 0, []
            for s in sorted((s["lo"], min(s["hi"], len(raw))) for s in spans[i].as_py() or ()):
                if s[1] <= s[0]:
                    continue
                if s[0] > end or not n:
                    parts.append(raw[end:s[0]])
                    n += 1
                    cut += s[1] - s[0]
                    end = s[1]
                elif s[1] > end:
                    cut += s[1] - end
                    end = s[1]
            parts.append(raw[end:])
            size.append(len(raw))
            removed.append(cut)
            runs.append(n)
            kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay).

    A null text is empty; texts shorter than LENGTH bytes stay whole.  Occurrences are
    ordered by (doc_id, start).  Rows that share an id count as one document: what is
    removed from one, by position, is removed from the others.  Rows with a null id are
    neither changed nor compared.  An empty table gives no rows.  Cuts may fall inside a
    UTF-8 character, hence bytes.
    """
    rows = documents(docs, id_col, text_col)
    spans = repeated_spans(rows)
    cuts = (spans.groupBy(F.col("doc_id").alias("_id"))
            .agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))
    return (rows.join(cuts, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "text", "spans")
            .mapInArrow(_cut, REMOVED))
