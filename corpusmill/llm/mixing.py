"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Slots are numbered 0, 1, 2, ...; slot j is the point frac(j * golden ratio), taken as the exact lattice j * F45 mod F46 of two Fibonacci
numbers. The cumulative targets cut [0, 1) into one interval per source, and a slot belongs to the source whose interval has its point,
so that every stretch of the schedule holds each source in proportion. A source's slots are ranked, and its r-th slot takes the r-th
block of equal size of its shuffled token stream, which goes round at most ``max_epochs`` times. A source of few blocks, for which a slot
more or less is much, has no interval: it takes its target to the word, in blocks spread evenly over the schedule, the last one cut.

Nothing is grouped by source alone, as one source may hold most rows: positions in a stream and ranks of slots come from two-level
prefix sums over buckets, and slots find their source by an equi-join on cells of [0, 1).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import scratch, staged, unused

#: Neighbouring Fibonacci numbers; their ratio is the golden ratio to 18 digits. The lattice repeats after this many slots.
FIB_45, FIB_46 = 1134903170, 1836311903
#: Rows of one bucket of a stream, of all sources, and slots of one chunk, about. A bucket is summed in as many parts as a hexadecimal digit has values.
BUCKET_ROWS, CHUNK_SLOTS = 20_000, 20_000
#: Copies of a row that are made at a time.
COPIES = 1000
#: Slots of a source on the average, and words of a block at least.
SLOTS, LEAST_BLOCK = 4000, 32
#: Blocks of a source's target up to which it is taken to the word.
FEW_BLOCKS = 64
#: More slots than the lattice can give an interval beyond its share: twice 3 + log of F46 to the base of the golden ratio.
DISCREPANCY = 128


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Mix:
    """What ``schedule`` makes.

    docs: the rows, (id, source, size, dg, m, source_size, target, bucket, seq, copy, start); m rows that nothing tells apart have one (source,
    bucket, seq), and copy numbers them; start is a row's first word in its source's stream. pieces: (source, bucket, seq, copy, slot, epoch,
    first, words), what each slot takes of each row: ``words`` words from word ``first`` on.
    """

    docs: DataFrame
    targets: DataFrame
    pieces: DataFrame


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), total: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(source, source_size, weight, target, low, high) from (source, size): water-filling with ``max_epochs * source_size`` as ceilings.

    Sources by code point, null last, have the weights in turn. Filling in the order of ceiling / weight reaches in one pass what resharing
    the excess again and again leads to. low and high bound the source's interval of [0, 1). One row per source: its windows over all rows
    see the sources, not the documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    per = per.withColumn("ceiling", (F.col("source_size") * max_epochs).cast("double"))
    order = [(F.col("ceiling") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    upto, every = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = per.withColumn("full", F.coalesce(F.sum("ceiling").over(upto), F.lit(0.0))).withColumn("spent", F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    per = per.withColumn("level", (F.lit(float(total)) * F.sum("source_size").over(every) - F.col("full")) / (F.sum("weight").over(every) - F.col("spent")))
    # The sources whose ceiling is under the level at their turn are full; the level of the first other one holds for the rest.
    last = F.min(F.when(F.col("ceiling") > F.col("weight") * F.col("level"), F.struct(F.col("ceiling") / F.col("weight"), F.col("source").isNull(), "source", "level"))).over(every)
    per = per.withColumn("final", last.getField("level"))
    per = per.withColumn("target", F.least("ceiling", F.coalesce(F.col("weight") * F.col("final"), F.col("ceiling"))))
    upto = F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("target").over(every)
    return per.withColumn("high", upto / F.nullif(whole, F.lit(0.0))).withColumn("low", F.coalesce(F.lag("high").over(by_name), F.lit(0.0))).select("source", "source_size", "weight", "target", "low", "high")


def _stream(groups: DataFrame, n_buckets: int, seed: int) -> DataFrame:
    """groups with ``start``, each one's first token in its source's shuffled stream, and (bucket, seq), its place."""
    # A random-looking order that SQL can repeat. Within a bucket rows go by the digest too, so its parts, by first digit, are in order.
    named = F.coalesce(F.col("id").cast("string"), F.when(F.col("dg") != 0, F.col("dg").cast("string")), F.lit(""))
    groups = groups.withColumn("digest", F.md5(F.concat(F.lit(f"{seed}:"), named)))
    part = F.conv(F.substring("digest", 1, 1), 16, 10).cast("long")
    groups = groups.withColumn("bucket", F.conv(F.substring("digest", 1, 7), 16, 10).cast("long") % n_buckets * 16 + part).withColumn("whole", F.col("size") * F.col("m"))
    per = groups.groupBy("source", "bucket").agg(F.sum("whole").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("offset"))
    within = Window.partitionBy("source", "bucket").orderBy("digest", "id", "size", "dg")
    groups = groups.withColumn("seq", F.row_number().over(within)).withColumn("inner", F.sum("whole").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("whole"))
    joined = groups.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.withColumn("start", F.col("offset") + F.col("inner")).drop("s", "b", "offset", "inner", "digest", "whole")


def _copied(groups: DataFrame) -> DataFrame:
    """A row for each of the m rows of a group, with ``copy`` and its own start. Very many copies are made in several tasks."""
    once = groups.filter("m = 1").withColumn("copy", F.lit(0).cast("long"))
    runs = groups.filter("m > 1").withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("m") - 1) / COPIES)))).repartition("source", "bucket", "seq", "run")
    first = F.col("run") * COPIES
    several = runs.withColumn("copy", F.explode(F.sequence(first, F.least(first + COPIES, "m") - 1))).drop("run")
    return once.union(several).withColumn("start", F.col("start") + F.col("copy") * F.col("size"))


def _limit(block_words: int) -> Column:
    """The words that a source of few blocks takes, of its target; null for others."""
    return F.when(F.col("target") < FEW_BLOCKS * block_words, F.round("target").cast("long"))


def _slots(targets: DataFrame, n_slots: int, n_sources: int, block_words: int) -> DataFrame:
    """(source, slot, rank) of every slot. Those of sources of few blocks share their numbers with others."""
    targets = targets.withColumn("limit", _limit(block_words))
    even = targets.filter("limit > 0").withColumn("n", F.ceil(F.col("limit") / block_words)).withColumn("rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    even = even.select("source", F.floor((2 * F.col("rank") + 1) * n_slots / (2 * F.col("n"))).alias("slot"), "rank")
    spark = targets.sparkSession
    cells = max(1024, 4 * n_sources)
    first, last = F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1))
    held = targets.filter("high > low and limit is null").select("source", "low", "high", F.explode(F.sequence(first, last)).alias("cell"))
    points = spark.range(n_slots).select(F.col("id").alias("slot"), (F.col("id") % FIB_46 * FIB_45 % FIB_46).alias("lattice"))
    points = points.withColumn("u", F.col("lattice").cast("double") / FIB_46)
    slots = points.withColumn("cell", F.floor(F.col("u") * cells)).join(held, "cell").filter("u >= low and u < high")
    slots = slots.select("source", "slot", F.floor(F.col("slot") / CHUNK_SLOTS).alias("chunk"))
    per = slots.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("offset"))
    slots = slots.withColumn("inner", F.row_number().over(Window.partitionBy("source", "chunk").orderBy("slot")) - 1)
    slots = slots.join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    return slots.select("source", "slot", (F.col("offset") + F.col("inner")).alias("rank")).union(even)


def schedule(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2), total: float = 1.5, max_epochs: int = 2, block_words: int | None = None, seed: int = 0, tell: Column | None = None) -> Mix:
    """Mixes the rows of docs; see ``Mix``.

    A source gets its share of the slots, so it takes its target to within a few blocks, to the word if that is under ``FEW_BLOCKS``
    blocks, and never more than ``max_epochs`` times any row. Null texts have no words; a null source is a source, the last one; rows without
    an id are placed by ``tell``, or else all at one place. No rows, or no words at all: nothing is taken. ``block_words`` bounds how far a
    source's words can be from its target and how many slots there are; without it a source has ``SLOTS`` slots on the average, and no
    block has fewer than ``LEAST_BLOCK`` words. Rows of equal id, source and size, and of equal ``tell`` (a long), are counted before they
    are placed, so that very many of them are no more work than one.
    """
    if (block_words is not None and block_words < 1) or total > max_epochs:
        raise ValueError("blocks need a word at least, and the total can't be above what the epochs allow")
    told = F.lit(0).cast("long") if tell is None else tell
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), told.alias("dg"))
    groups = staged(rows.groupBy("id", "source", "size", "dg").agg(F.count(F.lit(1)).alias("m")), "sizes")
    n_rows = groups.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0]
    targets = staged(source_targets(groups.select("source", (F.col("size") * F.col("m")).alias("size")), weights, total, max_epochs), "targets")
    n_sources, words = targets.agg(F.count(F.lit(1)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    joined = groups.join(targets.select(F.col("source").alias("s"), "source_size", "target"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    block_words = block_words or max(LEAST_BLOCK, int(words) // (max(1, n_sources) * SLOTS))
    placed = _copied(staged(_stream(joined, 1 + n_rows // BUCKET_ROWS, seed), "stream"))
    slots = _slots(targets, int(-(-words // block_words)), n_sources, block_words)

    # The lattice gives an interval its share of the slots to within DISCREPANCY; later parts of a stream meet no slot.
    n_blocks = F.floor(F.col("target") / block_words) + DISCREPANCY
    epochs = F.sequence(F.lit(0), F.lit(max_epochs - 1))
    turns = placed.filter("size > 0").withColumn("epoch", F.explode(epochs)).withColumn("a", F.col("start") + F.col("epoch") * F.col("source_size"))
    turns = turns.withColumn("b", F.col("a") + F.col("size")).filter(F.floor(F.col("a") / block_words) < n_blocks)
    parts = turns.withColumn("rank", F.explode(F.sequence(F.floor(F.col("a") / block_words), F.floor((F.col("b") - 1) / block_words))))
    parts = parts.join(slots.withColumnRenamed("source", "s").withColumnRenamed("rank", "r"), F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("r")))
    low, high = F.greatest("a", F.col("rank") * block_words), F.least("b", (F.col("rank") + 1) * block_words, _limit(block_words))
    pieces = parts.filter(low < high).select("source", "bucket", "seq", "copy", "slot", "epoch", (low - F.col("a")).alias("first"), (high - low).alias("words"))
    return Mix(placed, targets, pieces)


#: What tells the rows of a mix apart.
PLACE = ("source", "bucket", "seq", "copy")


def _of_rows(mix: Mix, per: DataFrame, how: str) -> DataFrame:
    """The rows of a mix joined to per, which has their places."""
    same = F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket")) & (F.col("seq") == F.col("__seq")) & (F.col("copy") == F.col("__copy"))
    return mix.docs.join(per.withColumnsRenamed({c: f"__{c}" for c in PLACE}), same, how)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """One row per row of docs: id, size, source_size, target and taken, the words that the mix takes of it, repeats counted.

    Null texts have size 0, a null source is a source, null ids stay, repeated rows are rows, an empty table gives an empty result; other
    columns are ignored. The words of rows that share id, source and size may be dealt to them in any order.
    """
    mix = schedule(docs, id_col, text_col, source_col, **options)
    per = mix.pieces.groupBy(*PLACE).agg(F.sum("words").alias("taken"))
    return _of_rows(mix, per, "left").select(F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def taken_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", count_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix itself, with the columns of docs, whatever their names: a row for each time round in which words of it are taken, with these words as its text.

    Mostly that is the whole text as it is; where a source's stream ends within a text, its first words joined by blanks. count_col, where
    docs have it, becomes the length of the text. Rows are told apart by all their columns; those equal in all are each taken by itself. Rows
    of null, empty or blank texts have no words and go. Rows without an id or a source are rows like others, the null source being the
    last one. An empty table gives an empty result. Texts are shuffled once; of equal rows only one text is, and the turns of very many
    of them are dealt to several tasks.
    """
    hashed = [F.to_json(c) if docs.schema[c].dataType.simpleString().startswith(("map", "variant")) else F.col(c) for c in docs.columns]
    tell = F.xxhash64(*hashed, *(F.col(c).isNull() for c in docs.columns))  # nulls leave a hash as it is
    mark = unused(docs.columns, "mix_")
    kept = ("id", "source", "size", "dg", "m", "copy", "epoch", "first", "words")
    with scratch() as tables:
        mix = schedule(docs, id_col, text_col, source_col, tell=tell, **options)
        # Blocks of one turn of a row follow each other, so their words are one span.
        spans = mix.pieces.groupBy(*PLACE, "epoch").agg(F.min("first").alias("first"), F.sum("words").alias("words"))
        spans = tables.keep(staged(_of_rows(mix, spans, "inner").select(*(F.col(c).alias(mark + c) for c in kept)), "spans"))
    own, at = (unused([*docs.columns, *spans.columns], x) for x in ("row_", "part"))
    rows = docs.withColumns({own + "size": word_count(F.col(text_col)), own + "dg": tell})
    same = (F.col(id_col).eqNullSafe(F.col(mark + "id")) & F.col(source_col).eqNullSafe(F.col(mark + "source"))
            & (F.col(own + "size") == F.col(mark + "size")) & (F.col(own + "dg") == F.col(mark + "dg")))
    out = rows.join(spans.filter(F.col(mark + "m") == 1).hint("shuffle_hash"), same)
    equal = spans.filter(F.col(mark + "m") > 1)
    if not equal.isEmpty():
        parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col(own + "m") - 1) / COPIES))
        counts = equal.groupBy(*(mark + c for c in kept[:4])).agg(F.first(mark + "m").alias(own + "m"))
        alone = rows.join(counts, same).dropDuplicates([mark + c for c in kept[:4]]).drop(*(mark + c for c in kept[:4])).withColumn(at, F.explode(parts)).drop(own + "m")
        turns = equal.withColumn(mark + "part", F.floor(F.col(mark + "copy") / COPIES))
        out = out.select(*docs.columns, *spans.columns).union(alone.join(turns, same & (F.col(at) == F.col(mark + "part"))).select(*docs.columns, *spans.columns))
    words = F.slice(F.filter(F.split(text_col, r"[\x20\x09-\x0D]+"), lambda w: w != ""), (F.col(mark + "first") + 1).cast("int"), F.col(mark + "words").cast("int"))
    whole = F.col(mark + "words") == F.col(mark + "size")
    out = out.withColumn(text_col, F.when(whole, F.col(text_col)).otherwise(F.array_join(words, " ")))
    if count_col in docs.columns:
        out = out.withColumn(count_col, F.length(text_col).cast(docs.schema[count_col].dataType))
    return out.select(*docs.columns)
