"""Mixing sources to target weights with fixed-length token blocks.

1. Sources are counted and get targets (`targets`).
2. The words of a source, document after document, are packed into blocks of `block`
   words (`pack`): an exclusive running sum in two steps, so that a source with a third of
   all rows is summed in many shares.
3. The mix is a row of slots, `shard_slots` to a shard.  Each shard draws its source
   counts from the targets, multinomially (one keyed draw per slot); draws beyond a
   source's quota are dealt to the sources short of theirs, so totals hold (`draw`).
4. A source's slots map to its blocks through a keyed permutation of 0..n-1 per epoch
   (swap-or-not shuffle), and slots meet blocks in an equi join by block index.  A key is
   one block, at most `block` words, so no join key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, bucket_of, stored

BLOCK = 512
SHARD_SLOTS = 4096
SHARES = 1024          # shares of a source in the running sum
ROUNDS = 12            # of the permutation, as many bits of any index
CYCLE = (1, 2, 3)
MOST = 3               # times a source's size that a target may reach


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """(doc_id, source, size): the words of a text, 0 for a null."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    count = F.regexp_count(text, F.lit(WORD)).cast("long")
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{source_col}`").alias("source"), count.alias("size"))


def targets(sized: DataFrame, cycle=CYCLE, most: int = MOST) -> DataFrame:
    """(source, weight, source_size, target), one row per source.

    Weights go round `cycle` in code-point order, null last.  A target stops at `most`
    times its source's size; the excess goes to the others by weight, again and again:
    the level at which sum(min(most * size, level * weight)) is the sum of all sizes.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    table = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size"))
                   .select("source", "source_size", (F.lit(float(most)) * F.col("source_size")).alias("most"),
                           F.element_at(weights, (place % len(cycle) + 1).cast("int")).alias("weight")))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        full = F.col("most") <= F.lit(level) * F.col("weight")
        taken, open_ = table.agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)),
                                 F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not open_ or (total - taken) / open_ <= level:
            break
        level = (total - taken) / open_
    return table.select("source", "weight", "source_size",
                        F.least(F.col("most"), F.lit(level) * F.col("weight")).alias("target"))


def running(df: DataFrame, keys: list[str], share: Column, order: list, width: str,
            out: str) -> DataFrame:
    """Adds `out`, the sum of `width` over the rows before: by share, then inside the share.

    A group's shares are summed apart, then their sums run over the few shares; so a group
    with a third of all rows is never in one task.
    """
    keyed = df.withColumn("_share", share)
    ahead = Window.unboundedPreceding, -1
    zero = F.lit(0).cast("long")
    shares = (keyed.groupBy(*keys, "_share").agg(F.sum(width).alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(
                  Window.partitionBy(*keys).orderBy("_share").rowsBetween(*ahead)), zero))
              .select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_share").alias("_at"), "_before"))
    inside = F.coalesce(F.sum(width).over(
        Window.partitionBy(*keys, "_share").orderBy(*order).rowsBetween(*ahead)), zero)
    same = F.col("_share") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    placed = keyed.withColumn("_inside", inside).join(shares, same)
    return placed.select(*df.columns, (F.col("_before") + F.col("_inside")).alias(out))


def pack(sized: DataFrame, shares: int = SHARES) -> DataFrame:
    """`sized` with start: the place of a row's first word in its source's row of words."""
    return running(sized, ["source"], bucket_of(F.col("doc_id"), shares),
                   [F.col("doc_id").isNull(), "doc_id", "size"], "size", "start")


def _uniform(*parts: Column) -> Column:
    """A repeatable number in [0, 1) of the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def permuted(index: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0..n-1 (swap-or-not shuffle): each round pairs i with
    shift - i and swaps the pair if a keyed bit of the larger of the two says so."""
    def swap(i: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - i, n)
        return F.when(F.xxhash64(*key, r, F.greatest(i, other)).bitwiseAND(1) == 1, other).otherwise(i)
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), swap)


def quotas(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """`plan` with whole (words to take), blocks (of the source) and quota (slots): every
    block once for each time the target holds the source, then blocks for what is left and
    one more, because the source's short last block may be among them."""
    size = F.col("source_size")
    return (plan.withColumn("whole", F.floor(F.col("target") + F.lit(1e-6)).cast("long"))
            .withColumn("blocks", F.ceil(size / F.lit(float(block))).cast("long"))
            .withColumn("epochs", F.when(size > 0, F.floor(F.col("whole") / size)).otherwise(0).cast("long"))
            .withColumn("rest", F.col("whole") - F.col("epochs") * size)
            .withColumn("quota", F.col("epochs") * F.col("blocks") + F.when(
                F.col("rest") > 0, F.least("blocks", F.ceil(F.col("rest") / F.lit(float(block))) + 1))
                .otherwise(0).cast("long")))


def _spread(shard: Column, last: int) -> Column:
    return F.floor(shard / F.lit(-(-(last + 1) // SHARES)))


def _cells(lo: str, hi: str, width: int) -> Column:
    return F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor((F.col(hi) - 1) / width)))


def draw(plan: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """(source, shard, n): how many blocks each output shard takes from each source.

    Every slot draws its source with the targets' probabilities, which makes a shard's
    counts multinomial.  A source's draws beyond its quota pass, in order, to the sources
    that are short of theirs, so the totals are the quotas.
    """
    spark = plan.sparkSession
    upto = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, 0)
    table = stored(plan.filter("quota > 0").select("source", "quota", F.sum("quota").over(upto).alias("upto"))
                   .withColumn("from", F.col("upto") - F.col("quota")))
    slots_ = table.agg(F.sum("quota")).first()[0] or 0
    last = max(0, slots_ - 1) // shard_slots
    drawn = spark.range(0, slots_, 1, max(1, -(-slots_ // (64 * shard_slots)))).select(
        F.floor(F.col("id") / shard_slots).alias("shard"),
        F.floor(_uniform(F.lit(seed), F.col("id")) * F.lit(float(slots_))).alias("point"))
    # points meet the sources' ranges through cells of the line, an equi join
    cell = max(1, slots_ // 4096)
    ranges = table.select("source", "from", "upto", _cells("from", "upto", cell).alias("cell"))
    counts = (drawn.withColumn("cell", F.floor(F.col("point") / cell)).join(ranges, "cell")
              .filter("point >= `from` and point < upto")
              .groupBy("source", "shard").agg(F.count("*").alias("drawn")))
    share = _spread(F.col("shard"), last)
    counts = running(counts, ["source"], share, ["shard"], "drawn", "ahead").join(
        table.select(F.col("source").alias("_s"), "quota"), F.col("source").eqNullSafe(F.col("_s")))
    own = F.greatest(F.lit(0), F.least("drawn", F.col("quota") - F.col("ahead")))
    counts = stored(counts.withColumn("n", own).select(
        "source", "shard", "n", (F.col("drawn") - F.col("n")).alias("over")))

    have = counts.groupBy(F.col("source").alias("_s")).agg(F.sum("n").alias("have"))
    short = (table.join(have, F.col("source").eqNullSafe(F.col("_s")), "left")
             .select("source", (F.col("quota") - F.coalesce("have", F.lit(0))).alias("lack"))
             .filter("lack > 0"))
    short = (short.withColumn("b_hi", F.sum("lack").over(upto))
             .select("source", (F.col("b_hi") - F.col("lack")).alias("b_lo"), "b_hi"))
    over = counts.groupBy("shard").agg(F.sum("over").alias("over")).filter("over > 0")
    over = (running(over, [], share, ["shard"], "over", "a_lo")
            .select("shard", "a_lo", (F.col("a_lo") + F.col("over")).alias("a_hi")))
    a = over.withColumn("cell", _cells("a_lo", "a_hi", 1024))
    b = short.withColumn("cell", _cells("b_lo", "b_hi", 1024))
    lo = F.greatest("a_lo", "b_lo", F.col("cell") * 1024)
    hi = F.least("a_hi", "b_hi", (F.col("cell") + 1) * 1024)
    moved = a.join(b, "cell").select("source", "shard", (hi - lo).alias("n")).filter("n > 0")
    return (counts.select("source", "shard", "n").unionByName(moved)
            .groupBy("source", "shard").agg(F.sum("n").alias("n")).filter("n > 0"))


def _tasks(plan: DataFrame) -> int:
    slots_ = plan.agg(F.sum("quota")).first()[0] or 0
    floor = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, -(-slots_ // (64 * SHARD_SLOTS)))


def fill(counts: DataFrame, plan: DataFrame, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """(source, shard, epoch, block, words): one row per slot that takes words.

    Slot j of a source takes block permuted(j mod n) of epoch j div n.  In a source's last
    slots the mix takes only what the target still lacks.
    """
    share = F.floor(F.col("shard") / 1024)
    first = running(counts, ["source"], share, ["shard"], "n", "first")
    # a count becomes as many slots: dealt anew, or few tasks would make them all
    rows = (first.repartition(_tasks(plan), "source", "shard").withColumn("j", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
            .join(plan.select(F.col("source").alias("_s"), "source_size", "whole", "blocks"),
                  F.col("source").eqNullSafe(F.col("_s")))
            .withColumn("epoch", F.floor(F.col("j") / F.col("blocks")))
            .withColumn("inside", F.col("j") % F.col("blocks")))
    rows = stored(rows.withColumn("block", permuted(
        F.col("inside"), F.col("blocks"), F.lit(seed), F.coalesce("source", F.lit("")), F.col("epoch")))
        .select("source", "shard", "epoch", "inside", "block", "source_size", "whole", "blocks"))
    # words before a slot: whole epochs, then blocks of this one, of which the short last
    # block may be one
    short = (rows.filter("block = blocks - 1")
             .select(F.col("source").alias("_s"), F.col("epoch").alias("_e"), F.col("inside").alias("_at")))
    cut = F.col("blocks") * block - F.col("source_size")
    before = (F.col("epoch") * F.col("source_size") + F.col("inside") * block
              - F.when(F.col("_at") < F.col("inside"), cut).otherwise(0))
    length = F.least(F.lit(block).cast("long"), F.col("source_size") - F.col("block") * block)
    words = F.least(length, F.greatest(F.lit(0), F.col("whole") - before))
    return (rows.join(short, F.col("source").eqNullSafe(F.col("_s")) & (F.col("epoch") == F.col("_e")), "left")
            .select("source", "shard", "epoch", "block", words.cast("long").alias("words"))
            .filter("words > 0"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK, shard_slots: int = SHARD_SLOTS, seed: int = 0, numbered: bool = False):
    """(sized documents, plan, spans): `spans` has a row for every part of a document that a
    slot takes: source, doc_id, start, shard, epoch, first (word of the document), taken.

    Empty and null texts have size 0 and are in no span; repeated rows take their own places
    in the row of words; a null source is a source of its own, the last.  With `numbered`,
    documents and spans tell of the rows that share id, source and size: how many (`copies`)
    and which of them (`nth`, from 1).
    """
    sized = stored(sizes(docs, id_col, text_col, source_col))
    plan = stored(quotas(targets(sized), block))
    packed, tags = pack(sized), []
    if numbered:
        alike, tags = Window.partitionBy("source", "doc_id", "size"), ["copies", "nth"]
        packed = packed.withColumns({"copies": F.count("*").over(alike),
                                     "nth": F.row_number().over(alike.orderBy("start"))})
    packed = stored(packed)
    taken = fill(stored(draw(plan, shard_slots, seed)), plan, block, seed)
    parts = packed.filter("size > 0").withColumn("block", F.explode(F.sequence(
        F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
    cuts = taken.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "shard", "epoch", "words")
    met = parts.join(cuts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    lo = F.greatest(F.col("start"), F.col("block") * block)
    hi = F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words"))
    spans = met.select("source", "doc_id", "size", "start", *tags, "shard", "epoch",
                       (lo - F.col("start")).alias("first"), (hi - lo).alias("taken")).filter("taken > 0")
    return packed, plan, spans


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words, repeats counted)."""
    packed, plan, spans = mix(docs, **options)
    taken = (spans.groupBy(F.col("source").alias("_s"), F.col("start").alias("_start"))
             .agg(F.sum("taken").alias("taken")))
    return (packed.join(taken, F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_start"))
                        & (F.col("size") > 0), "left")
            .join(plan.select(F.col("source").alias("_p"), "source_size", "target"),
                  F.col("source").eqNullSafe(F.col("_p")))
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", chars_col: str = "n_chars", **options) -> DataFrame:
    """The mix as documents, with the columns of `docs`: a row per document and epoch.

    A document taken whole keeps its text; of one taken in part, the words taken stay in
    order, each with the white space after it.  Documents of which nothing is taken are not
    in the mix.  Rows that share id, source and size take each the spans of one of them.
    """
    packed, _, spans = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, numbered=True, **options)
    cuts = (spans.groupBy("source", "doc_id", "start", "size", "copies", "nth", "epoch")
            .agg(F.sum("taken").alias("taken"), F.sort_array(F.collect_list(F.struct("first", "taken"))).alias("cuts"))
            .select("doc_id", F.col("source").alias("of"), "size", "copies", "nth", "taken", "cuts"))
    # the input's columns by place, so that none can clash
    place = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    whole = F.col(place[text_col])
    placed = docs.toDF(*place.values())
    same = (F.col(place[id_col]).eqNullSafe(F.col("doc_id")) & F.col(place[source_col]).eqNullSafe(F.col("of"))
            & (F.regexp_count(whole, F.lit(WORD)) == F.col("size")))
    met = placed.join(cuts.filter("copies = 1"), same).drop("copies", "nth")
    alike = stored(packed.filter("copies > 1 and nth = 1 and size > 0")
                   .select("doc_id", F.col("source").alias("of"), "size"))
    if not alike.isEmpty():
        # only the rows that share all three are numbered, so only they are moved for it
        hashed = [c for c, kind in placed.dtypes if "map<" not in kind and "variant" not in kind]
        of_alike = Window.partitionBy("doc_id", "of", "size").orderBy(F.xxhash64(*hashed))
        rows = (placed.join(alike, same).withColumn("_nth", F.row_number().over(of_alike))
                .select(*place.values(), *[F.col(c).alias(f"_{c}") for c in ("doc_id", "of", "size")], "_nth"))
        met = met.unionByName(rows.join(
            cuts.filter("copies > 1"), F.col("_doc_id").eqNullSafe(F.col("doc_id"))
            & F.col("_of").eqNullSafe(F.col("of")) & (F.col("_size") == F.col("size"))
            & (F.col("_nth") == F.col("nth"))).drop("_doc_id", "_of", "_size", "_nth", "copies", "nth"))
    # words with the white space after them, and places of those taken: first is 0-based
    words = F.regexp_extract_all(whole, F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1))
    part = F.array_join(F.flatten(F.transform("cuts", lambda c: F.slice(
        words, (c["first"] + 1).cast("int"), c["taken"].cast("int")))), "")
    shaped = met.withColumn("out", F.when(F.col("taken") == F.col("size"), whole).otherwise(part))
    return shaped.select(*[F.col("out").alias(c) if c == text_col
                           else F.length("out").cast(docs.schema[c].dataType).alias(c) if c == chars_col
                           else F.col(place[c]).alias(c) for c in docs.columns])
