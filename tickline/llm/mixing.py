"""Mixing sources to target weights by entropy balancing.

Targets: sources in code-point order (null last) get the weights in turn; each
source's target is its weight's share of all words, but at most ``cap`` times
its own words, and what is over goes to the other sources by weight.

Rates: among all document rates between 0 and ``cap`` whose words meet the
source's target, take those of least relative entropy to "each once".  Their
form is min(cap, exp(lam * size / mean)), one multiplier ``lam`` per source,
the solution of the convex dual; it is found for all sources at once by Newton
steps, each of which is one aggregation of the (source, size) histogram.  The
sums are decimals, so that they do not depend on the order of addition and
reruns agree.

Copies: per source, from the largest size to the smallest, the running sum of
rates is rounded, so that each (source, size) cell gets a whole number of
copies; what words are then still missing (or over) is put right in
passes, largest fitting size first, until no size fits.  Within a cell the documents that get one
more copy are those first by a hash of their id.  Cells are split into
sub-cells of about ``SUB`` documents, so no task sees a whole hot cell.

Only DataFrame functions are used.  What a window sees whole is a source's
list of different sizes, or a sub-cell.

Defined results: a null text has size 0 and takes 0 words; a null source is a
source, the last one; a source without words has target 0; repeated rows are
documents of their own, told apart only by the order in which a hash of the id
leaves them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickline.llm.common import WORD, packed, stage

SUB = 1024


@dataclass(frozen=True)
class MixParams:
    weights: tuple[int, ...] = (5, 2, 1)
    cap: int = 3
    tolerance: float = 1e-9  # relative error of a source's words


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """The source as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def histogram(sizes: DataFrame) -> DataFrame:
    return stage(sizes.groupBy("skey", "source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")


def targets(hist: DataFrame, p: MixParams) -> DataFrame:
    """skey, source_size, target: one row a source."""
    per = hist.groupBy("skey", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    # Rank by code point without one task for all: sort by ranges, then add the counts of earlier ranges.
    per = stage(per.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
                   .withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part = F.shiftright("at", 33)
    before = (per.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("c"))
                 .select("part", (F.sum("c").over(Window.orderBy("part")) - F.col("c")).alias("before")))
    rank = F.col("before") + F.col("at") - F.shiftleft(F.col("part"), 33)
    per = (per.withColumn("part", part).join(before, "part")
              .withColumn("w", F.element_at(F.array(*map(F.lit, p.weights)), (rank % len(p.weights) + 1).cast("int")).cast("long"))
              .select("skey", "source_size", "docs", "w"))
    per = stage(per, "mix-weights")
    # Water level: words per unit of weight, with capped sources set aside.
    full = F.col("source_size") * p.cap
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, None
    while True:
        under = full > F.lit(level) * F.col("w")
        got = per.agg(F.sum(F.when(~under, full).otherwise(0)).alias("fixed"), F.sum(F.when(under, F.col("w")).otherwise(0)).alias("w"),
                      F.count_if(~under).alias("n")).first()
        if not got["w"] or got["n"] == capped:
            break
        capped, level = got["n"], (total - got["fixed"]) / got["w"]
    return stage(per.withColumn("target", F.least(full.cast("double"), F.lit(float(level)) * F.col("w"))).drop("w"), "mix-targets")


def _rate(p: MixParams) -> Column:
    return F.when(F.col("full"), F.lit(float(p.cap))).otherwise(F.least(F.lit(float(p.cap)), F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0)))))


def solve(hist: DataFrame, goal: DataFrame, p: MixParams) -> DataFrame:
    """goal with lam, mean and full (all rates at the cap)."""
    state = goal.select(
        "*", (F.col("source_size") / F.col("docs")).alias("mean"),
        ((F.col("source_size") == 0) | (F.col("target") >= F.col("source_size") * p.cap)).alias("full"), F.lit(0.0).alias("lam"),
        F.when(F.col("target") >= F.col("source_size"), F.lit(0.0)).alias("lo"), F.when(F.col("target") < F.col("source_size"), F.lit(0.0)).alias("hi"))
    state = stage(state.withColumn("mean", F.greatest("mean", F.lit(1e-9))), "mix-state")
    exact = "decimal(38,9)"
    # Every round makes a multiplier's bracket smaller, so the rounds end.
    while True:
        rate = _rate(p)
        sums = (hist.join(state.where("not full"), "skey").withColumn("words", F.col("size") * F.col("n"))
                    .groupBy("skey").agg(F.sum((F.col("words") * rate).cast(exact)).cast("double").alias("f"),
                                         F.sum(F.when(rate < p.cap, F.col("words") * rate * F.col("size") / F.col("mean")).otherwise(0.0).cast(exact)).cast("double").alias("g")))
        now = state.join(sums, "skey", "left")
        over = F.col("f") > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("lam")), F.when(over, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - (F.log("f") - F.log("target")) * F.col("f") / F.when(F.col("g") > 0, F.col("g"))
        wide = F.when(lo.isNull(), F.least(hi * 2, F.lit(-1e-3))).when(hi.isNull(), F.greatest(lo * 2, F.lit(1e-3))).otherwise((lo + hi) / 2)
        inside = newton.isNotNull() & ~F.isnan(newton) & (lo.isNull() | (newton > lo)) & (hi.isNull() | (newton < hi))
        after = F.when(inside, newton).otherwise(wide)
        settled = F.col("full") | (F.abs(F.col("f") - F.col("target")) <= F.col("target") * p.tolerance) | (after == F.col("lam"))
        now = now.select("skey", "source_size", "docs", "target", "mean", "full", settled.alias("settled"),
                         F.when(settled, F.col("lam")).otherwise(after).alias("lam"),
                         F.when(settled, F.col("lo")).otherwise(lo).alias("lo"), F.when(settled, F.col("hi")).otherwise(hi).alias("hi"))
        state = stage(now, "mix-state")
        if not state.where("not settled").limit(1).count():
            break
        state = state.drop("settled")
    return state.drop("settled", "lo", "hi")


def cells(hist: DataFrame, state: DataFrame, p: MixParams) -> DataFrame:
    """(skey, size) with n documents and k copies in all."""
    down = Window.partitionBy("skey").orderBy(F.col("size").desc())
    out = hist.drop("source").join(state, "skey").withColumn("rate", _rate(p))
    sofar = F.floor(F.sum(F.col("n") * F.col("rate")).over(down) + 0.5)
    out = out.withColumn("sofar", sofar).withColumn("k", F.least(F.col("sofar") - F.coalesce(F.lag("sofar").over(down), F.lit(0)), F.col("n") * p.cap).cast("long"))
    out = stage(out.select("skey", "size", "n", "rate", "k", "source_size", "target"), "mix-cells")
    # Every pass brings each source that it changes nearer by a document at least, so the passes end.
    while True:
        gap = out.groupBy("skey").agg((F.max("target") - F.sum(F.col("k") * F.col("size"))).alias("gap"))
        room = F.when(F.col("gap") > 0, F.col("n") * p.cap - F.col("k")).otherwise(F.col("k"))
        fits = out.join(gap, "skey").withColumn("room", room).where((F.col("size") > 0) & (F.col("size") <= F.abs("gap")) & (F.col("room") > 0))
        step = (fits.groupBy("skey").agg(F.max(F.struct("size", "room", "gap")).alias("s"))
                    .select("skey", F.col("s.size").alias("size"), (F.signum("s.gap") * F.least(F.col("s.room"), F.floor(F.abs("s.gap") / F.col("s.size")))).cast("long").alias("step")))
        step = stage(step, "mix-step")
        if step.isEmpty():
            break
        out = stage(out.join(step, ["skey", "size"], "left").withColumn("k", F.col("k") + F.coalesce("step", F.lit(0))).drop("step"), "mix-cells")
    return out


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", params: MixParams = MixParams()) -> DataFrame:
    """doc_id, skey, size, source_size, target, rate, copies for every row."""
    p = params
    sizes = stage(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text).cast("string")).alias("size"))
                      .withColumn("skey", _key(F.col("source"))), "mix-sizes")
    hist = histogram(sizes)
    done = cells(hist, solve(hist, targets(hist, p), p), p)
    subs = F.ceil(F.col("n") / SUB)
    each = (sizes.drop("source").join(done, ["skey", "size"])
                 .withColumn("sub", F.pmod(F.xxhash64("doc_id", F.lit(1)), subs)).withColumn("extra", F.col("k") % F.col("n")))
    per = each.groupBy("skey", "size", "sub", "n", "extra").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("skey", "size").orderBy("sub"))
    share = F.floor(F.col("extra") * F.col("upto") / F.col("n")) - F.floor(F.col("extra") * (F.col("upto") - F.col("c")) / F.col("n"))
    per = per.withColumn("upto", upto).select("skey", "size", "sub", share.alias("more"))
    order = Window.partitionBy("skey", "size", "sub").orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id")
    return (each.join(per, ["skey", "size", "sub"]).withColumn("at", F.row_number().over(order))
                .select("doc_id", "skey", "size", "source_size", "target", "rate",
                        (F.floor(F.col("k") / F.col("n")) + (F.col("at") <= F.col("more")).cast("int")).cast("long").alias("copies")))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", params: MixParams = MixParams()) -> DataFrame:
    """``docs`` with all its columns, each row as often as the mix takes it."""
    # The rows go as one column, so that no name of theirs clashes with the keys.
    row = F.col("row")
    rows = packed(docs).select("row", row[doc_id].cast("long").alias("id"), _key(row[source]).alias("src"), word_count(row[text].cast("string")).alias("words"))
    # Rows that share id, source and size are told apart by their order.
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("id", "src", "words").orderBy(F.xxhash64(row[text]))))
    take = mix(docs, doc_id, text, source, params).withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "skey", "size").orderBy("copies")))
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("src") == F.col("skey")) & (F.col("words") == F.col("size")) & (F.col("nth") == F.col("n"))
    return (rows.join(take.where("copies > 0").select("doc_id", "skey", "size", "n", "copies"), same)
                .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*"))
