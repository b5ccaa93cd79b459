"""Mixing sources to target weights by weighted sampling without replacement.

Every source has a budget of words. Whole passes over a source come first. What is left of the budget is filled by
Efraimidis-Spirakis order: a document's key is an exponential draw divided by its quality weight, the draw a function of
its id, and documents are taken by rising key until one does not fit. Then the document that fits best into what is
missing is added, FILLS - 1 times over. Where further documents fit after that, those too long for the gap are skipped and
the order goes on, and so in turn until none fits; a last pick may go over the budget if that comes nearer to it.

The running sum is never made over a whole source in one task. Keys fall into slices; the sizes per slice are summed,
the slice in which the budget ends is found from at most SLICES sums per source, and that slice is cut again. What is
ordered class by class in the end is one of SLICES * SLICES parts of a source.

Rows of one source with equal key, doc_id and size form a class. A class is one row with a number of copies in all of this,
and as many copies are taken as fit, so a document that is a third of all rows weighs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabulon.llm.common import stored

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SLICES = 256
FILLS = 5
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def letter_share(text: Column) -> Column:
    """Quality weight: the share of characters that are ASCII letters or not ASCII at all, 0.05 at least."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    other = F.length(F.regexp_replace(t, r"[A-Za-z\x{80}-\x{10FFFF}]+", ""))
    return F.greatest(F.lit(0.05), F.coalesce(F.try_divide((F.length(t) - other).cast("double"), F.length(t)), F.lit(0.05)))


def uniform(row_id: Column, seed: str = SEED) -> Column:
    """A draw in (0, 1) made from the MD5 of seed and id: the same on every engine and in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(row_id.cast("string"), F.lit("null")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2 ** 48))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) per source of `sizes` (source, size). Weights repeat in code point order, null last.

    A target is at most `most` times its source; what that leaves over is shared again by weight among the others, until
    none is above. Each round is one aggregate over the table of sources, of which only three numbers reach the driver.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.orderBy(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id())
    ranked = stored(ranked, "sources")
    parts = ranked.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = parts.select("_part", "_first", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row per partition
    place = (F.col("_before") + F.col("_row") - F.col("_first")) % len(weights)
    table = ranked.join(before, "_part").select("source", "source_size", F.array(*map(F.lit, weights))[place.cast("int")].alias("weight"))
    table = stored(table, "weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    limit, full = 0.0, -1
    while True:  # limit: words per unit of weight
        capped = F.col("source_size") * most <= F.lit(limit) * F.col("weight")
        row = table.agg(F.sum(F.when(capped, F.col("source_size") * most)), F.sum(F.when(~capped, F.col("weight"))), F.count_if(capped)).first()
        if row[2] == full or row[1] is None:
            break
        limit, full = (total - (row[0] or 0)) / row[1], row[2]
    target = F.least((F.col("source_size") * most).cast("double"), F.lit(float(limit)) * F.col("weight"))
    return table.select("source", "source_size", target.alias("target"))


def _running(sums: DataFrame, slice_: str) -> DataFrame:
    """`before`: the words of all lower slices of the same source; at most SLICES rows per source meet in a task."""
    order = W.partitionBy("source").orderBy(slice_)
    return sums.withColumn("before", F.sum("words").over(order) - F.col("words"))


CLASS = ("source", "key", "doc_id", "size")


def _same(a: str, b: str = "_") -> Column:
    """Rows whose class columns, prefixed with `a` and `b`, are equal; nulls equal nulls."""
    conditions = [F.col(a + c).eqNullSafe(F.col(b + c)) for c in CLASS]
    return conditions[0] & conditions[1] & conditions[2] & conditions[3]


def _draws(docs: DataFrame, weight: Column | None, seed: str) -> list[Column]:
    """The class columns of a row."""
    w = (letter_share(F.col("text")) if weight is None else weight).cast("double")
    good = F.when((w > 0) & ~F.isnan(w), w).otherwise(1.0)
    key = -F.log(uniform(F.col("doc_id"), seed)) / good
    return [F.col("source").cast("string").alias("source"), key.alias("key"), F.col("doc_id").cast("long").alias("doc_id"), word_count(F.col("text")).alias("size")]


def _taken(docs: DataFrame, weight: Column | None, weights: tuple[float, ...], most: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """(class, part, here): rows of each class in each part of the input; (class, copies, n, source_size, target, epochs):
    how many rows of each class the mix takes once more than `epochs` times."""
    rows = stored(docs.select(*_draws(docs, weight, seed)).withColumn("part", F.spark_partition_id()), "sizes")  # texts are read here alone
    here = stored(rows.groupBy(*CLASS, "part").agg(F.count("*").alias("here")), "here")
    targets = source_targets(here.select("source", (F.col("size") * F.col("here")).alias("size")), weights, most)
    plan = targets.withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).cast("long"))
    plan = stored(plan.withColumn("budget", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")), "budgets")
    plan_ = plan.select(F.col("source").alias("_source"), "source_size", "target", "epochs", "budget")
    classes = here.groupBy(*CLASS).agg(F.sum("here").alias("copies"))
    joined = classes.join(plan_, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    # 1 - exp(-key) spreads the keys over the slices; any rising function of the key would do.
    place = 1 - F.exp(-F.col("key"))
    fine = F.least(F.lit(SLICES * SLICES - 1), F.floor(place * SLICES * SLICES)).cast("int")
    joined = joined.withColumn("fine", fine).withColumn("coarse", (F.col("fine") / SLICES).cast("int"))
    words = F.col("size") * F.col("free")

    def end(sums: DataFrame, slice_: str, start: str) -> DataFrame:
        """Per source the slice in which its budget ends, and the words before it."""
        run = _running(sums, slice_)
        over = run.filter((F.col("before") + F.col(start) <= F.col("budget")) & (F.col("before") + F.col(start) + F.col("words") > F.col("budget")))
        return over.select(F.col("source").alias("_source"), F.col(slice_).alias("_" + slice_), (F.col("before") + F.col(start)).alias("_start"))

    def prefix(rows: DataFrame) -> DataFrame:
        """Per source the last class of `rows` that the order reaches, how many of its `free` copies fit, and the words so
        far; no row where all of it fits."""
        coarse = rows.groupBy("source", "budget", "coarse").agg(F.sum(words).alias("words")).withColumn("zero", F.lit(0))
        ends = stored(end(coarse, "coarse", "zero"), "coarse")
        inside = rows.join(ends, F.col("source").eqNullSafe(F.col("_source")) & (F.col("coarse") == F.col("_coarse")))
        fines = inside.groupBy("source", "budget", "fine", "_start").agg(F.sum(words).alias("words")).withColumnRenamed("_start", "start")
        last = stored(end(fines, "fine", "start"), "fine")
        edge = rows.join(last, F.col("source").eqNullSafe(F.col("_source")) & (F.col("fine") == F.col("_fine")))
        order = W.partitionBy("source").orderBy("key", "doc_id", "size")
        edge = edge.withColumn("before", F.sum(words).over(order.rowsBetween(W.unboundedPreceding, 0)) - words + F.col("_start")).filter("before <= budget")
        fit = F.least(F.col("free"), F.floor((F.col("budget") - F.col("before")) / F.col("size")).cast("long"))
        reached = edge.withColumn("fit", fit).withColumn("sum", F.col("before") + F.col("fit") * F.col("size"))
        cuts = reached.groupBy(F.col("source").alias("_cut_source"), F.col("_fine").alias("_cut")).agg(F.max(F.struct("key", "doc_id", "size", "fit", "sum")).alias("at"))
        return stored(cuts, "cuts")

    me, at = F.struct("key", "doc_id", "size"), F.struct("at.key", "at.doc_id", "at.size")
    inside = F.when(F.col("_cut").isNull() | (F.col("fine") < F.col("_cut")), F.col("free")).when(F.col("fine") > F.col("_cut"), F.lit(0))
    upto = inside.when(me < at, F.col("free")).when(me <= at, F.col("at.fit")).otherwise(F.lit(0)).cast("long")
    one = me
    none = F.expr("CAST(array() AS array<struct<key:double, doc_id:bigint, size:bigint>>)")
    sized = joined.filter("size > 0")
    cuts = prefix(sized.withColumn("free", F.col("copies")))
    chosen = sized.withColumn("free", F.col("copies")).join(cuts, F.col("source").eqNullSafe(F.col("_cut_source")), "left")
    chosen = stored(chosen.withColumn("n", upto).drop("free", "_cut_source", "_cut", "at"), "chosen")
    state = cuts.join(plan.select(F.col("source").alias("_s"), "budget"), F.col("_cut_source").eqNullSafe(F.col("_s")))
    state = stored(state.select("_s", (F.col("budget") - F.col("at.sum")).alias("gap"), none.alias("picks")), "gaps")
    picked = F.coalesce(F.size(F.filter("picks", lambda p: p.eqNullSafe(one))), F.lit(0))

    def open_classes() -> DataFrame:
        rows = chosen.join(state, F.col("source").eqNullSafe(F.col("_s")))
        return rows.withColumn("free", F.col("copies") - F.col("n") - picked).filter("free > 0")

    def fill(over: bool) -> DataFrame:
        """`state` with the document of each source that fits its gap best; with `over` it may be longer than the gap."""
        rows = open_classes().withColumn("off", F.abs(F.col("gap") - F.col("size"))).filter(F.col("off") < F.col("gap"))
        rows = rows if over else rows.filter("size <= gap")
        best = rows.groupBy(F.col("source").alias("_b")).agg(F.min(F.struct("off", one.alias("one"))).getField("one").alias("one"))
        more = state.join(best, F.col("_s").eqNullSafe(F.col("_b")), "left")
        return stored(more.select("_s", (F.col("gap") - F.coalesce("one.size", F.lit(0))).alias("gap"), F.when(F.col("one").isNotNull(), F.array_append("picks", F.col("one"))).otherwise(F.col("picks")).alias("picks")), "gaps")

    while True:
        for _ in range(FILLS - 1):
            state = fill(False)
        fits = open_classes().filter("size <= gap")
        if fits.isEmpty():
            break
        # go on with the order among the documents that fit: at least one is taken, so each round closes some of the gap
        cuts = prefix(fits.withColumn("budget", F.col("gap")))
        marked = chosen.join(state, F.col("source").eqNullSafe(F.col("_s")), "left").join(cuts, F.col("source").eqNullSafe(F.col("_cut_source")), "left")
        marked = marked.withColumn("_picked", picked).withColumn("free", F.col("copies") - F.col("n") - F.col("_picked"))
        more = F.when((F.col("free") > 0) & F.coalesce(F.col("size") <= F.col("gap"), F.lit(False)), upto).otherwise(F.lit(0)).cast("long")
        marked = marked.withColumn("_more", more).withColumn("n", F.col("n") + F.col("_picked") + F.col("_more"))
        marked = stored(marked.drop("_s", "gap", "picks", "_picked", "free", "_cut_source", "_cut", "at"), "chosen")
        added = marked.groupBy(F.col("source").alias("_b")).agg(F.sum(F.col("size") * F.col("_more")).alias("_added"))
        state = stored(state.join(added, F.col("_s").eqNullSafe(F.col("_b")), "left").select("_s", (F.col("gap") - F.coalesce("_added", F.lit(0))).alias("gap"), none.alias("picks")), "gaps")
        chosen = marked.drop("_more")
    state = fill(True)
    last = chosen.join(state, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("n", F.col("n") + picked)
    out = last.select(*CLASS, "copies", "n", "source_size", "target", "epochs")
    out = out.unionByName(joined.filter("size = 0").withColumn("n", F.lit(0).cast("long")).select(*out.columns))
    return here, stored(out, "taken")


def mix(docs: DataFrame, weight: Column | None = None, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, extra (boolean), taken of every row of `docs`.

    Null and empty texts have size 0 and take nothing. Null source is a source of its own. `weight` (letter_share of the
    text by default) must be positive; null, NaN and others count as 1. Rows with equal doc_id get equal draws; ties in
    the key are broken by doc_id and size. Rows equal in all of these are interchangeable: as many of them are extra as fit.
    Rows without doc_id have one draw in common. Other columns are not looked at.
    """
    here, taken = _taken(docs, weight, weights, most, seed)
    rows = here.join(taken.select(*[F.col(c).alias("_" + c) for c in CLASS], "copies", "n", "source_size", "target", "epochs"), _same(""))
    # the first n copies of a class, part by part of the input; only classes taken in part need to know what came before
    before = F.sum("here").over(W.partitionBy(*CLASS).orderBy("part")) - F.col("here")
    rows = rows.withColumn("before", before).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("here"))))
    extra = F.col("before") + F.col("nth") <= F.col("n")
    words = F.col("size") * (F.col("epochs") + extra.cast("long"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "epochs", extra.alias("extra"), words.alias("taken"))


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def repeat_rows(docs: DataFrame, weight: Column | None = None, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, all columns as they were."""
    taken = _taken(docs, weight, weights, most, seed)[1]
    own = [c.alias("__" + name) for c, name in zip(_draws(docs, weight, seed), CLASS)]
    rows = docs.withColumns({"__part": F.spark_partition_id(), "__class": F.struct(*own)}).select("*", "__class.*").drop("__class")
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def times(of: DataFrame, extra: Column) -> DataFrame:
        number = F.col("__epochs") + extra.cast("long")
        return of.withColumn("__times", number).filter("__times > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))).select(*columns)

    of_class = taken.select(*[F.col(c).alias("_c_" + c) for c in CLASS], F.col("copies").alias("__copies"), F.col("n").alias("__n"), F.col("epochs").alias("__epochs"))
    split = (F.col("__n") > 0) & (F.col("__n") < F.col("__copies"))
    whole = of_class.filter(~split & (F.col("__n") + F.col("__epochs") > 0)).hint("merge")
    out = times(rows.join(whole, _same("__", "_c_")), F.col("__n") > 0)
    some = stored(of_class.filter(split), "split")
    if some.isEmpty():
        return out
    # rows of classes taken in part, written once, so that their numbers stay; counted part by part of the input
    cut = stored(rows.join(some, _same("__", "_c_")).withColumn("__row", F.monotonically_increasing_id()), "parts")
    group = ["__" + c for c in CLASS]
    sums = cut.groupBy(*group, "__part").agg(F.count("*").alias("_here"))
    sums = sums.withColumn("_before", F.sum("_here").over(W.partitionBy(*group).orderBy("__part")) - F.col("_here"))
    sums = sums.select(*[F.col("__" + c).alias("_p_" + c) for c in CLASS], F.col("__part").alias("_p"), "_before")
    numbered = cut.select("__row", *group, "__part").withColumn("_nth", F.row_number().over(W.partitionBy(*group, "__part").orderBy("__row")))
    numbered = numbered.join(sums, _same("__", "_p_") & (F.col("__part") == F.col("_p"))).select(F.col("__row").alias("_row"), (F.col("_before") + F.col("_nth")).alias("_nth"))
    cut = cut.join(numbered.hint("merge"), F.col("__row") == F.col("_row"))
    return out.unionByName(times(cut, F.col("_nth") <= F.col("__n")))
