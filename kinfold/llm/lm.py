"""Document log-likelihoods under a gated recurrent language model.

1. Words of all training documents are counted (per task first, then by word).
2. The HEAD most frequent words - as many as a count threshold admits, at most HEAD - go to
   every task; the rest stay a table.  The model's own words are the most frequent of them,
   one for OWN_SHARE words counted, in as many classes as a class has words; all others
   share its word UNK, split by their counts.
3. The model starts from the word frequencies, warms up on a bounded sample, then every
   partition trains it on all its training documents, and the results are averaged, weighted
   by tokens, in two steps, CHUNK parameters at a time.
4. Every whole document is scored window by window, state carried on.  Words outside the
   head are looked up by a join on the word; they are rare, so no word is hot.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gru
from .common import bucket_of, documents, split_group, stored
from .shingles import words

HEAD = 200_000          # words sent to every task, at most
OWN_SHARE = 1000        # distinct words for each word of the model's own
COUNTED = 300_000       # distinct words that a task counts before it sends them on
WARM_DOCS = 3000        # documents of the warm-up, about; a sample by hash of the id
WARM_PASSES = 2
WARM_RATE, RATE = 0.01, 0.002
SLICE = 4000            # documents that a task cuts into tokens at once
GROUPS = 4              # partial averages of the parameters
CHUNK = 1 << 14         # parameters averaged at once
SMOOTH = 0.1
FOLDS, HELD_OUT = 10, 0
END = b""               # the end token; no word is empty


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all of (doc_id, text); each text's end counts as the word END."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(1).to_pylist():
                counts.update(words(text))
                if len(counts) >= COUNTED:
                    yield flush()
                    counts.clear()
            counts[END] += batch.num_rows
        if counts:
            yield flush()
    return docs.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def threshold(counts: DataFrame, most: int) -> int:
    """The least count that at most `most` words reach (a histogram by eighths of powers of 2)."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    bins = sorted(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(
        F.count("*").alias("n")).collect()), reverse=True)       # a few hundred rows at most
    total, least = 0, None
    for k, n in bins:
        if total + n > most:
            break
        total, least = total + n, k
    return int(np.ceil(2 ** (least / 8) - 1e-9)) if least is not None else 1 << 62


class Head(dict):
    """word -> place in the head; -1 for all others."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Lexicon:
    """The head's words, counts and model words, as many as `distinct` words call for."""

    def __init__(self, rows: list[tuple[bytes, int]], total: int, distinct: int = 0):
        rows = sorted(rows, key=lambda r: (-r[1], r[0]))
        self.words = [w for w, _ in rows]
        self.counts = np.array([n for _, n in rows], np.int64)
        self.model = np.full(len(rows) + 1, gru.UNK, np.int64)    # the last entry serves place -1
        side = max(gru.CLASSES, int(np.ceil(np.sqrt(min(distinct / OWN_SHARE, HEAD)))))
        size = side * side
        own = [i for i, w in enumerate(self.words) if w != END][: size - 2]
        self.model[own] = np.arange(2, 2 + len(own))
        ends = [i for i, w in enumerate(self.words) if w == END]
        self.model[ends] = gru.END
        self.model_counts = np.full(size, -1.0)
        self.model_counts[2:2 + len(own)] = self.counts[own]
        self.model_counts[gru.END] = self.counts[ends].sum() if ends else 0
        self.model_counts[gru.UNK] = max(0, total - self.model_counts[self.model_counts > 0].sum())
        self.n_own = len(own) + len(ends)

    def places(self) -> Head:
        return Head((w, i) for i, w in enumerate(self.words))

    def own(self) -> dict[bytes, int]:
        """The model's own words -> their model words; few, so a look-up is cheaper than a place."""
        return {w: m for w, m in zip(self.words, self.model.tolist()) if m != gru.UNK}


def _tokens(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """All tokens of some texts in a row, each text's END included, and tokens per text."""
    tokens, ends = [], []
    for text in texts:
        tokens += words(text)
        tokens.append(END)
        ends.append(len(tokens))
    return tokens, np.diff(np.array(ends, np.int64), prepend=0)


def train(docs: DataFrame, lexicon, flat: np.ndarray, rate: float, passes: int) -> np.ndarray:
    """Parameters after every partition has trained on its documents, averaged by tokens."""
    spark = docs.sparkSession
    given = spark.sparkContext.broadcast((lexicon, flat))       # HEAD words and the parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, start = given.value
        own = lex.own()
        trainer = gru.Trainer(gru.Model(start), rate)
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                tokens, _ = _tokens(batch.column(1).slice(first, SLICE).to_pylist())
                sequence = np.fromiter(map(own.get, tokens, itertools.repeat(gru.UNK)), np.int64, len(tokens))
                for _ in range(passes):
                    trainer.feed(sequence)
        if trainer.tokens:
            flat = trainer.model.flat
            for k, at in enumerate(range(0, len(flat), CHUNK)):
                value = flat[at:at + CHUNK].astype(np.float64) * trainer.tokens
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([float(trainer.tokens)]), pa.array([value.tobytes()], pa.binary())],
                    ["chunk", "weight", "value"])

    def add(table: pa.Table) -> pa.Table:
        value = sum(np.frombuffer(v, np.float64) for v in table.column("value").to_pylist())
        return pa.table({"chunk": table.column("chunk")[:1], "weight": [float(sum(table.column("weight").to_pylist()))],
                         "value": pa.array([value.tobytes()], pa.binary())})

    kind = "chunk int, weight double, value binary"
    groups = docs.mapInArrow(run, kind).groupBy("chunk", F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("k")).applyInArrow(
        add, kind).collect()                                     # GROUPS vectors of the parameters
    if not groups:
        return flat
    total = sum(r["weight"] for r in groups if r["chunk"] == 0)
    out = np.zeros(len(flat))
    for r in groups:
        value = np.frombuffer(r["value"], np.float64)
        out[r["chunk"] * CHUNK:r["chunk"] * CHUNK + len(value)] += value
    return (out / total).astype(np.float32)


SCORED = ("doc_id long, n_tokens long, n_head long, log_counts double, model double, "
          "rest array<binary>")


def score_documents(docs: DataFrame, lexicon, flat: np.ndarray) -> DataFrame:
    """Per document: the model's log10 probability with UNK for words not its own, sums of
    log10(count + SMOOTH), and the words outside the head."""
    given = docs.sparkSession.sparkContext.broadcast((lexicon, flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, params = given.value
        place, model = lex.places(), gru.Model(params)
        logs = np.append(np.log10(lex.counts + SMOOTH), 0.0)      # the last entry serves place -1
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE):
                batch = whole.slice(first, SLICE)
                tokens, size = _tokens(batch.column(1).to_pylist())
                ends = np.cumsum(size)
                begins = ends - size
                at = np.fromiter(map(place.__getitem__, tokens), np.int64, len(tokens))
                ids, own = lex.model[at], logs[at]
                # the end is its own model word even where no training row has one
                ids[ends - 1] = gru.END
                other = ids == gru.UNK
                out = np.flatnonzero(at < 0)
                out = out[~np.isin(out, ends - 1)] if place[END] < 0 else out
                per_doc = lambda x: np.add.reduceat(x, begins)    # noqa: E731  no text is without its end
                value = gru.score(model, np.split(ids, ends[:-1])) / np.log(10)
                value += per_doc(np.where(other, own, 0.0)) - per_doc(other.astype(np.int64)) * lex.log_unknown
                cuts = np.searchsorted(out, np.append(begins, ends[-1]))
                rest = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()),
                                                pa.array([tokens[i] for i in out.tolist()], pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(size), pa.array(per_doc((at >= 0).astype(np.int64))),
                     pa.array(per_doc(own)), pa.array(value), rest],
                    ["doc_id", "n_tokens", "n_head", "log_counts", "model", "rest"])
    return docs.mapInArrow(run, SCORED)


def log_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is the empty one: its only token is the end.  Null ids are trained on, not
    held out; rows that share an id, or have none, are scored each on its own.  An empty
    table gives no rows; without training rows every word is unknown.  Parameters are
    averaged over the partitions once, so the score depends a little on how the table is
    split.
    """
    texts = documents(docs, id_col, text_col)
    learnt = texts.filter(F.coalesce(split_group(F.col("doc_id"), FOLDS) != HELD_OUT, F.lit(True)))
    counts = stored(count_words(learnt))
    total, distinct, n_docs = counts.agg(
        F.sum("n"), F.count("*"), F.sum(F.when(F.col("word") == F.lit(END), F.col("n")))).first()
    total, n_docs = total or 0, n_docs or 0
    least = threshold(counts, HEAD)
    lexicon = Lexicon([(bytes(r["word"]), r["n"]) for r in counts.filter(F.col("n") >= least).collect()], total, distinct)
    base = total + SMOOTH * (distinct + 1)
    other = total - lexicon.model_counts[2:][lexicon.model_counts[2:] > 0].sum() - lexicon.model_counts[gru.END]
    lexicon.log_unknown = float(np.log10(other + SMOOTH * (distinct - lexicon.n_own + 1)))

    flat = gru.Model.start(lexicon.model_counts).flat
    if total:
        share = min(1_000_000, int(1_000_000 * WARM_DOCS / max(1, n_docs)) + 1)
        sample = stored(learnt.filter(bucket_of(F.col("doc_id"), 1_000_000) < share))
        flat = train(sample.coalesce(1), lexicon, flat, WARM_RATE, WARM_PASSES)
        flat = train(learnt, lexicon, flat, RATE, 1)

    # numbered as they are stored: no later stage numbers them again
    scored = stored(score_documents(texts, lexicon, flat).withColumn("row", F.monotonically_increasing_id()))
    rest = scored.select("row", F.explode("rest").alias("word"))
    tail = counts.filter(F.col("n") < least).select(F.col("word").alias("_word"), F.col("n").alias("c"))
    looked = (rest.join(tail, F.col("word") == F.col("_word"), "left").withColumn("c", F.coalesce("c", F.lit(0)))
              .groupBy(F.col("row").alias("_row"))
              .agg(F.sum(F.log10(F.col("c") + SMOOTH)).alias("rest_logs"),
                   F.sum((F.col("c") > 0).cast("long")).alias("rest_known")))
    logs = F.coalesce("rest_logs", F.lit(0.0))
    held = F.coalesce(split_group(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.join(looked, F.col("row") == F.col("_row"), "left").select(
        "doc_id", held.alias("held_out"), "n_tokens",
        (F.col("n_head") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("log_counts") + logs - F.col("n_tokens") * F.lit(float(np.log10(base)))).alias("base_score"),
        (F.col("model") + logs).alias("score"))
