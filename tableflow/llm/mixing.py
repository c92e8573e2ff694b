"""Mixing sources to target weights by a low-discrepancy schedule over blocks of equal token counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableflow.llm.common import n_words_of, staged, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# The fractional part of the golden ratio.
GOLDEN = 0.6180339887498949
#: The schedule has a slot for each document, and at least so many for each source.
SLOTS_PER_SOURCE = 1000


def _half_bits(n: int) -> int:
    """Bits of about the square root: running totals go over so many groups, and within groups of as many."""
    return n.bit_length() // 2


def _hash(doc_id: Column) -> Column:
    """60 bits that shuffle a source's documents, the same on every run."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sid, source, source_size, n_docs, target`` from rows of ``source, size``.

    Sources in code-point order, null last, take the weights in turn and share the total size by them. A share stops at
    ``max_epochs`` times its source; what is over goes to the others by weight until none is above. That fixed point
    has one level: sorted by how early they reach their limit, the sources before some place are capped.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = total.withColumn("sid", turn).withColumn(
        "w", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    )
    early = Window.orderBy(F.col("source_size") / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    late = Window.orderBy(F.col("source_size") / F.col("w"), "sid").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    limit = (F.col("source_size") * max_epochs).cast("decimal(38,0)")
    placed = weighed.select(
        "*",
        F.sum("source_size").over(everything).cast("decimal(38,0)").alias("all_size"),
        F.coalesce(F.sum(F.col("source_size") * max_epochs).over(early), F.lit(0)).cast("decimal(38,0)").alias("capped_before"),
        F.sum("w").over(late).alias("w_left"),
    ).withColumn(
        "capped", (F.col("all_size") - F.col("capped_before")).cast("double") * F.col("w") > limit.cast("double") * F.col("w_left")
    )
    capped_size = F.coalesce(F.sum(F.when(F.col("capped"), F.col("source_size") * max_epochs)).over(everything), F.lit(0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)
    share = (F.col("all_size").cast("long") - capped_size) * F.col("w") / open_weight
    target = F.when(F.col("capped"), (F.col("source_size") * max_epochs).cast("double")).otherwise(share)
    return placed.select("sid", "source", "source_size", "n_docs", target.cast("double").alias("target"))


@dataclass(frozen=True)
class Mix:
    """``documents``: every row with ``size, source_size, target, taken``; ``schedule``: slot by slot, what comes next.

    A slot of the schedule names a source (``sid``), an epoch and a block: the words from ``block * block_words`` on in
    the source's shuffled documents. ``offset`` is where a document begins there.
    """

    documents: DataFrame
    schedule: DataFrame
    block_words: int


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, extra: tuple[str, ...] = ()
) -> Mix:
    """Plan which words of which documents a mix of the sources takes, and in which order.

    Sizes are words; a null text has none, takes nothing, and still gets its row. Rows that share a ``doc_id`` are
    documents of their own, and a null id or source is a value like any other. Columns of ``docs`` beyond ``doc_id``,
    ``text``, ``source`` and those named in ``extra`` are ignored. Equal input gives equal output on every run.
    Running totals are taken over buckets of the shuffled order first and within buckets after, and slots are ranked
    over chunks the same way, so that no task holds a whole source.
    """
    spark = docs.sparkSession
    sized = staged(
        docs.select("doc_id", "source", n_words_of(F.col("text")).alias("size"), _hash(F.col("doc_id")).alias("h"), *extra),
        "mix_sizes",
    )
    sources = staged(source_targets(sized, weights, max_epochs), "mix_sources")
    scale = sources.agg(F.sum("source_size"), F.sum("n_docs"), F.count(F.lit(1))).first()
    all_size, n_docs, n_sources = (x or 0 for x in scale)
    block = max(1, -(-all_size // max(n_docs, SLOTS_PER_SOURCE * n_sources, 1)))

    # Where each document begins in its source's shuffled words.
    shift = 60 - _half_bits(n_docs)
    known = sources.withColumnRenamed("source", "_source").drop("n_docs")
    named = sized.join(
        F.broadcast(known) if n_sources <= 10_000 else known, F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source")
    bucketed = named.withColumn("bucket", F.shiftright("h", shift))
    order = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size", *extra)
    sums = bucketed.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("n")
    placed = (
        bucketed.withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .withColumn("row", F.row_number().over(order))
        .join(sums.select("sid", "bucket", before.alias("before")), ["sid", "bucket"])
        .withColumn("offset", F.col("before") + F.col("within"))
        .drop("before", "within", "h")
    )

    schedule = _schedule(spark, sources, block, n_sources, max_epochs)
    times = schedule.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
    size, offset, b = F.col("size"), F.col("offset"), F.lit(block).cast("long")
    touched = F.when(size > 0, F.sequence(F.floor(offset / b), F.floor((offset + size - 1) / b)))
    pieces = placed.select("*", F.explode_outer(touched).alias("block"))
    words = F.least(offset + size, (F.col("block") + 1) * b) - F.greatest(offset, F.col("block") * b)
    keys = ["sid", "bucket", "row", "doc_id", "source", "size", "source_size", "target", "offset", *extra]
    taken = F.sum(F.coalesce(words * F.col("times"), F.lit(0))).cast("long")
    documents = pieces.join(times, ["sid", "block"], "left").groupBy(*keys).agg(taken.alias("taken"))
    return Mix(documents.drop("bucket", "row"), schedule, block)


def _schedule(spark: SparkSession, sources: DataFrame, block: int, n_sources: int, max_epochs: int) -> DataFrame:
    """``slot, sid, epoch, block``: golden-ratio points through the cumulative shares, ranked within each source."""
    blocks = F.ceil(F.col("source_size") / block)
    need = F.col("target") * blocks / F.col("source_size")
    shared = sources.where("source_size > 0").select("sid", blocks.alias("n_blocks"), need.alias("need"))
    total = Window.partitionBy()
    upto = F.sum("need").over(Window.orderBy("sid")) / F.sum("need").over(total)
    ranges = staged(
        shared.select("sid", "n_blocks", "need", upto.alias("high"))
        .withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("sid")), F.lit(0.0)))
        .withColumn("last", F.lead("sid").over(Window.orderBy("sid")).isNull()),
        "mix_ranges",
    )
    n_slots = int(-(-(ranges.agg(F.sum("need")).first()[0] or 0) // 1))
    # A point meets the sources of its cell alone; only cells at a boundary have more than one.
    cells = max(4096, 4 * n_sources)
    met = ranges.select(
        "sid", "n_blocks", "low", "high", "last",
        F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)))).alias("cell"),
    )
    point = F.col("slot") * F.lit(GOLDEN) - F.floor(F.col("slot") * F.lit(GOLDEN))
    points = spark.range(n_slots).select(F.col("id").alias("slot"), point.alias("x"))
    drawn = (
        points.withColumn("cell", F.floor(F.col("x") * cells))
        .join(met, "cell")
        .where("x >= low and (x < high or last)")
        .select("slot", "sid", "n_blocks", F.shiftright("slot", _half_bits(n_slots)).alias("chunk"))
    )
    per_chunk = drawn.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = per_chunk.select(
        "sid", "chunk", (F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n")).alias("before")
    )
    within = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    ranked = drawn.withColumn("within", within).join(before, ["sid", "chunk"]).withColumn("rank", F.col("before") + F.col("within"))
    return ranked.where(F.col("rank") < max_epochs * F.col("n_blocks")).select(
        "slot", "sid", F.floor(F.col("rank") / F.col("n_blocks")).alias("epoch"), (F.col("rank") % F.col("n_blocks")).alias("block")
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The documents of the mix: a row for each whole time a document is taken, and one for a part taken at the end.

    Blocks of a source are taken in turn, so all whole epochs take a document whole and the last takes its first words,
    if any; only documents at the end of a source's last epoch are cut, behind a word. All columns come back; of a cut
    document ``n_chars`` is the length of what is left, where it was not null. Documents without words are not taken.
    """
    rows = staged(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix_rows")
    plan = mix_sources(rows, weights, max_epochs, ("_mix_row",)).documents.where("taken > 0")
    whole, rest = F.expr("taken div size"), F.expr("taken % size")
    plan = plan.select("_mix_row", whole.alias("_mix_whole"), rest.alias("_mix_rest"))
    times = F.col("_mix_whole") + (F.col("_mix_rest") > 0).cast("long")
    taken = rows.join(plan, "_mix_row").withColumn("_mix_epoch", F.explode(F.sequence(F.lit(1).cast("long"), times)))
    cut = F.col("_mix_epoch") > F.col("_mix_whole")
    # Each part is a word with the white space before it.
    words = F.split("text", "(?<=[^ \\t-\\r])(?=[ \\t-\\r])")
    first = F.array_join(F.slice(words, F.lit(1), F.col("_mix_rest").cast("int")), "")
    taken = taken.withColumn("text", F.when(cut, first).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        left = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
        taken = taken.withColumn("n_chars", F.when(cut, left).otherwise(F.col("n_chars")))
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sources(table(spark, sf_dir, "documents"))
    return mix.documents.select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = f"""
with d as (
  select doc_id, source,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
         cast('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h
  from documents),
s as (
  select source, sum(size)::bigint as source_size, count(*) as n_docs,
         row_number() over (order by source collate "binary" nulls last) - 1 as sid
  from d group by source),
w as (select *, case sid % 3 when 0 then 5 when 1 then 2 else 1 end as w from s),
o as (
  select *, (sum(source_size) over ())::bigint as all_size,
         coalesce(sum(3 * source_size) over (order by source_size / w, sid rows between unbounded preceding and 1 preceding), 0) as capped_before,
         sum(w) over (order by source_size / w, sid rows between current row and unbounded following) as w_left
  from w),
c as (select *, (all_size - capped_before)::double * w > (3 * source_size)::double * w_left as capped from o),
t as (
  select sid, source, source_size, n_docs, all_size,
         case when capped then (3 * source_size)::double
              else ((all_size - coalesce(sum(case when capped then 3 * source_size end) over (), 0))::bigint * w)::double
                   / (sum(case when not capped then w end) over ())::double end as target
  from c),
b as (
  select greatest(1, cast(ceil(max(all_size) / greatest(sum(n_docs), 1000 * count(*), 1)) as bigint)) as block from t),
r as (
  select sid, cast(ceil(source_size / block) as bigint) as n_blocks,
         target * cast(ceil(source_size / block) as bigint) / source_size as need
  from t, b where source_size > 0),
cum as (
  select sid, n_blocks, need, (sum(need) over (order by sid)) / (sum(need) over ()) as high,
         lead(sid) over (order by sid) is null as last from r),
ranges as (select *, coalesce(lag(high) over (order by sid), 0.0) as low from cum),
slots as (
  select slot, slot * {GOLDEN}::double - floor(slot * {GOLDEN}::double) as x
  from (select unnest(range(0, (select cast(ceil(sum(need)) as bigint) from ranges))) as slot)),
drawn as (
  select slot, sid, n_blocks, row_number() over (partition by sid order by slot) - 1 as rank
  from slots join ranges on x >= low and (x < high or last)),
times as (
  select sid, rank % n_blocks as block_no, count(*) as times from drawn where rank < 3 * n_blocks group by all),
placed as (
  select d.doc_id, d.size, t.sid, t.source_size, t.target,
         (sum(d.size) over (partition by t.sid order by d.h, d.doc_id, d.size rows between unbounded preceding and current row))::bigint - d.size as o,
         row_number() over () as rid
  from d join t on d.source is not distinct from t.source),
pieces as (
  select rid, sid, size, o, unnest(range(o // block, (o + size - 1) // block + 1)) as block_no
  from placed, b where size > 0),
taken as (
  select rid, sum((least(o + size, (pieces.block_no + 1) * block) - greatest(o, pieces.block_no * block)) * times) as taken
  from pieces join times using (sid, block_no), b group by rid)
select doc_id, size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken
from placed left join taken using (rid)
"""
