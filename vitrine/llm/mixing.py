"""Mixing sources to target weights by entropy balancing; DataFrame functions only.

1. Targets: every source's share of the token budget by its weight, stopped at
   `cap` times its size, the excess reshared by weight (water filling over the
   table of sources).
2. Rates: token counts of the sources are the sufficient statistics of the
   convex dual  D(l) = sum_i size_i exp(l_source(i)) - sum_s target_s l_s  of
   the relative-entropy problem with one token constraint per source.  Each
   Newton iteration aggregates gradient and Hessian over the partial token sums
   and moves all multipliers; a document's rate is exp(l) of its source.
3. Copies: every document is taken floor(rate) times; the rest of the target is
   filled by whole extra copies in the order of a hash of the id, up to the
   cutoff at which the source's words meet its target.  The cutoff is found by
   radix selection: words per hash prefix are summed (partial aggregates),
   twice, and only the documents in the one cell that holds the cutoff are
   ordered, so a source with a third of all rows never meets in one task.  One
   more document, the one whose size is nearest to what is still missing,
   closes the gap.

Defined results: null text has size 0; null is a source of its own, last in
order; a source without words has target 0; rows that repeat an id and size are
taken alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import ensure_checkpoint_dir

WORDS = r"[^\x20\x09-\x0D]+"
#: bits of the id hash, of a radix digit, and of what is left after two digits
HASH_BITS, DIGIT_BITS = 48, 12


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def id_hash(id_: Column) -> Column:
    """48 bits of the id's MD5, the same in every run."""
    return F.conv(F.substring(F.md5(F.coalesce(id_.cast("string"), F.lit("null")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=(5.0, 2.0, 1.0), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target: one row per source; sizes has source and size.

    The table of sources is the mixture's list of parts: its ordering is a window
    over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    digits = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("w", F.element_at(digits, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    every = Window.partitionBy()
    fill = Window.orderBy((F.col("limit") / F.col("w")).asc(), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("limit", F.lit(float(cap)) * F.col("source_size"))
           .withColumn("total", F.lit(float(budget)) * F.sum("source_size").over(every))
           .withColumn("all_w", F.sum("w").over(every))
           .withColumn("limit_before", F.coalesce(F.sum("limit").over(fill), F.lit(0.0)))
           .withColumn("w_before", F.coalesce(F.sum("w").over(fill), F.lit(0.0)))
           .withColumn("full", F.col("w") * (F.col("total") - F.col("limit_before")) >= F.col("limit") * (F.col("all_w") - F.col("w_before"))))
    left = F.col("total") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0.0)).over(every)
    open_w = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(every)
    return per.select("source", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(F.col("w") * left / open_w).alias("target"))


def balance(cells: DataFrame, targets: DataFrame, tolerance: float = 1e-11, max_iterations: int = 60) -> DataFrame:
    """Multiplier of each source's token constraint: source, source_size, target, lam.

    cells: source, size (partial sums of tokens, any number of rows per source).
    Every iteration is one distributed aggregate of the dual's gradient and
    diagonal Hessian; the multipliers are a checkpointed table, and only the
    largest residual comes to the driver.  A target of 0 has no finite multiplier
    (lam is null, rate 0).
    """
    ensure_checkpoint_dir(cells.sparkSession)
    solvable = (F.col("target") > 0) & (F.col("source_size") > 0)
    state = targets.withColumn("lam", F.when(solvable, F.lit(0.0))).checkpoint()
    for _ in range(max_iterations):
        side = state.select(F.col("source").alias("s"), "lam", "target")
        moments = (cells.join(side, F.col("source").eqNullSafe(F.col("s")))
                   .groupBy("s").agg(F.sum(F.col("size") * F.exp("lam")).alias("mass"), F.first("target").alias("t"))
                   .withColumn("gradient", F.col("mass") - F.col("t")).withColumn("hessian", F.col("mass"))
                   .select("s", F.when(F.col("hessian") > 0, F.col("gradient") / F.col("hessian")).alias("step"),
                           F.when(F.col("t") > 0, F.abs("gradient") / F.col("t")).alias("residual")))
        state = (state.join(moments, F.col("source").eqNullSafe(F.col("s")), "left")
                 .select("source", "source_size", "target", (F.col("lam") - F.col("step")).alias("lam"), "residual").checkpoint())
        worst = state.agg(F.max(F.when(solvable, F.col("residual")))).first()[0]
        state = state.drop("residual")
        if worst is None or worst <= tolerance:
            break
    return state


def size_checked(table: DataFrame, rows: int = 100_000) -> DataFrame:
    """A broadcast hint for a checkpointed table of at most `rows` short rows; a shuffled join beyond."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def cutoffs(sizes: DataFrame, weights, budget: float, cap: float) -> DataFrame:
    """One checkpointed row per source: target, rate, whole copies, and where its extra copies end.

    sizes: checkpointed (id, source, size, key).
    """
    cells = sizes.groupBy("source", F.spark_partition_id().alias("part")).agg(F.sum("size").alias("size"))
    state = balance(cells, source_targets(sizes, weights, budget, cap))
    rate = F.coalesce(F.least(F.exp("lam"), F.lit(float(cap))), F.lit(0.0))
    # a rate within the solver's tolerance of a whole number is that number
    whole = F.floor(F.col("rate") + 1e-9).cast("long")
    plan = (state.withColumn("rate", rate).withColumn("base", whole)
            .withColumn("room", F.greatest(F.col("target") - F.col("base") * F.col("source_size"), F.lit(0.0)))
            .select(F.col("source").alias("s"), "source_size", "target", "rate", "base", "room").checkpoint())

    low = HASH_BITS - DIGIT_BITS
    lower = low - DIGIT_BITS
    rows = sizes.where("size > 0")
    same = F.col("source").eqNullSafe(F.col("s"))

    def cell(words: DataFrame, room: DataFrame, digit: str) -> DataFrame:
        """The first digit at which a source's words exceed its room, and the words below it."""
        run = Window.partitionBy("s").orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
        return (words.join(room, same).withColumn("upto", F.sum("words").over(run)).where(F.col("upto") > F.col("room"))
                .groupBy("s").agg(F.min(F.struct(digit, (F.col("upto") - F.col("words")).alias("below"))).alias("x"))
                .select(F.col("s").alias("other"), f"x.{digit}", F.col("x.below").alias(f"below_{digit}")))

    def with_cell(table: DataFrame, found: DataFrame) -> DataFrame:
        return table.join(found, F.col("s").eqNullSafe(F.col("other")), "left").drop("other")

    first = rows.groupBy("source", F.shiftright("key", low).alias("d1")).agg(F.sum("size").alias("words"))
    at1 = with_cell(plan, cell(first, size_checked(plan).select("s", "room"), "d1")).checkpoint()
    inside = rows.withColumn("k1", F.shiftright("key", low)).join(size_checked(at1).select("s", "d1"), same & (F.col("k1") == F.col("d1"))).drop("s", "d1", "k1")
    second = inside.groupBy("source", F.shiftright("key", lower).alias("d2")).agg(F.sum("size").alias("words"))
    at2 = with_cell(at1, cell(second, at1.select("s", (F.col("room") - F.col("below_d1")).alias("room")), "d2")).checkpoint()
    left = F.col("room") - F.coalesce("below_d1", F.lit(0)) - F.coalesce("below_d2", F.lit(0))
    last = Window.partitionBy("s").orderBy("key", "id", "size").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fits = (rows.withColumn("k2", F.shiftright("key", lower)).join(size_checked(at2).select("s", "d2", left.alias("room")), same & (F.col("k2") == F.col("d2")))
            .withColumn("upto", F.sum("size").over(last)).where(F.col("upto") <= F.col("room"))
            .groupBy("s").agg(F.max(F.struct("key", "id", "size")).alias("edge"), F.max("upto").alias("in_cell"))
            .withColumnRenamed("s", "other"))
    cut = (with_cell(at2, fits)
           .select("s", "source_size", "target", "rate", "base", "room", "d2", "edge", (left - F.coalesce("in_cell", F.lit(0))).alias("gap")).checkpoint())
    # the document whose size is nearest to what is still missing, among those without an extra copy
    closing = (sizes.join(size_checked(cut), same).where(~_extra() & (F.col("size") > 0) & (F.col("room") > 0) & (F.col("size") <= 2 * F.col("gap")) & (F.col("base") + 1 <= cap))
               .groupBy("s").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "key", "id", "size")).alias("n"))
               .select(F.col("s").alias("other"), F.struct("n.key", "n.id", "n.size").alias("closing")))
    return with_cell(cut, closing).checkpoint()


def _extra() -> Column:
    """Whether a row (key, id, size) lies before its source's cutoff.

    Without a cutoff cell the room holds every document; without room there is no extra copy.
    """
    digits = F.shiftright("key", HASH_BITS - 2 * DIGIT_BITS)
    return (F.when(F.col("room") <= 0, False).when(F.col("size") <= 0, False).when(F.col("d2").isNull(), True).when(digits != F.col("d2"), digits < F.col("d2"))
            .otherwise(F.coalesce(F.struct("key", "id", "size") <= F.col("edge"), F.lit(False))))


def _copies() -> Column:
    closing = F.col("closing").isNotNull() & F.struct("key", "id", "size").eqNullSafe(F.col("closing"))
    return (F.col("base") + (_extra() | closing).cast("long")).cast("long")


def _sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """id, source, size, key of every row, checkpointed: the texts are read once."""
    ensure_checkpoint_dir(docs.sparkSession)
    return (docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
            .withColumn("key", id_hash(F.col("id"))).checkpoint())


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
        weights=(5.0, 2.0, 1.0), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per row of docs: id, source, size, source_size, target, rate, copies, taken."""
    sizes = _sizes(docs, id_col, source_col, text_col)
    cut = size_checked(cutoffs(sizes, weights, budget, cap))
    return (sizes.join(cut, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", _copies())
            .select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "rate", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    weights=(5.0, 2.0, 1.0), budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """The rows of docs, each as often as the mix takes it; the texts are not shuffled."""
    cut = size_checked(cutoffs(_sizes(docs, id_col, source_col, text_col), weights, budget, cap))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       n_words(F.col(text_col)).alias("size")).withColumn("key", id_hash(F.col("id")))
    return (rows.join(cut, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", _copies()).where("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*"))
