"""Mixing sources to target weights by weighted pivotal (dependent) rounding.

Sources in code-point order (NULL last) weigh 3, 1, 2, repeating, and share
``budget`` times all words; no target is above ``cap`` times its source's
words, the excess is reshared by weight (water filling: the targets of the
sources below their cap stay proportional to their weights).

A document's expected copies are target / source words.  The integral part is
taken outright; the fraction p is rounded by pivotal sampling: two documents
are paired and words are moved between them, p_a * w_a + p_b * w_b staying the
same, until one p is 0 or 1; which way is drawn so that each p keeps its
expectation.  The fractional one goes on to the next pair.  So a source's taken
words differ from its target by less than one document.

Pairs run inside chunks of about ``CHUNK`` documents (groups on (source,
chunk)); each chunk leaves one fractional residual, and the residuals form the
next level's chunks, until a source fits one chunk: a reduction tree whose
depth is the logarithm of the largest source, so a hot source is spread over
all tasks.  Every draw is a hash of the document's key and ``seed``: reruns and
retried tasks agree.

NULL text has size 0 and is never taken.  Of n repeated rows (same id, source
and text) the whole part of n * p is taken outright, as pairing them with each
other would leave it, and only one fraction goes into the tree; the copies are
then dealt evenly over the n rows, which are numbered per written partition, so
a row repeated very often is in no single task.  Extra columns are ignored
here; ``mix`` passes them on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, row_key, table, text_of, written

WEIGHTS, BUDGET, CAP, CHUNK = (3, 1, 2), 1.5, 2.0, 256


def source_targets(sizes: DataFrame, budget: float = BUDGET, cap: float = CAP, weights=WEIGHTS) -> DataFrame:
    """source, source_size, target; ``sizes`` has a row (source, source_size) per source.

    Works on one row per source: the running sums over sources are the only
    ungrouped windows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("w", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1))
    s = s.withColumn("most", F.lit(cap) * F.col("source_size"))
    # sources by the level at which they reach their cap; before each: the caps reached, and the weight still open
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("full", F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    s = s.withColumn("open", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("level", (F.lit(budget) * F.sum("source_size").over(everything) - F.col("full")) / F.col("open"))
    # the first source that stays below its cap fixes the level of all later ones
    s = s.withColumn("final", F.min(F.when(F.col("level") * F.col("w") <= F.col("most"), F.struct(
        F.col("most") / F.col("w"), "level"))).over(everything)["level"])
    return s.select("source", "source_size", F.when(F.col("final").isNull(), F.col("most")).otherwise(
        F.least("most", F.col("final") * F.col("w"))).alias("target"))


#: one step of the pairing: the state (fractional document or NULL, settled documents) meets the next document.
#: up / down: the words that the first can gain from or lose to the second until one of them is integral.
_PAIR = """
    CASE WHEN acc.a IS NULL THEN named_struct('a', x, 'done', acc.done)
    ELSE element_at(transform(array(named_struct(
            'up', least((1 - acc.a.p) * acc.a.w, x.p * x.w),
            'down', least(acc.a.p * acc.a.w, (1 - x.p) * x.w))), m ->
        CASE WHEN pmod(xxhash64(acc.a.key, x.key, {seed}), 1000000007) / 1000000007D < m.down / (m.up + m.down)
        THEN {gain} ELSE {lose} END), 1) END"""


def _settle(a_p: str, b_p: str, a_whole: str, b_whole: str, whole: int, other: int) -> str:
    """The new state when the first document moves to ``a_p`` and the second to ``b_p``."""
    def doc(x, p):
        return f"named_struct('key', {x}.key, 'w', {x}.w, 'p', {p})"

    def done(x, up):
        return f"named_struct('key', {x}.key, 'up', {up})"
    none = "CAST(NULL AS struct<key:string,w:double,p:double>)"
    return f"""CASE
        WHEN {a_whole} AND {b_whole} THEN named_struct('a', {none},
            'done', array_append(array_append(acc.done, {done('acc.a', whole)}), {done('x', other)}))
        WHEN {a_whole} THEN named_struct('a', {doc('x', b_p)}, 'done', array_append(acc.done, {done('acc.a', whole)}))
        ELSE named_struct('a', {doc('acc.a', a_p)}, 'done', array_append(acc.done, {done('x', other)})) END"""


def _reduce(column: str, seed: int) -> str:
    gain = _settle("acc.a.p + m.up / acc.a.w", "x.p - m.up / x.w",
                   "(1 - acc.a.p) * acc.a.w <= x.p * x.w", "(1 - acc.a.p) * acc.a.w >= x.p * x.w", 1, 0)
    lose = _settle("acc.a.p - m.down / acc.a.w", "x.p + m.down / x.w",
                   "acc.a.p * acc.a.w <= (1 - x.p) * x.w", "acc.a.p * acc.a.w >= (1 - x.p) * x.w", 0, 1)
    step = _PAIR.format(seed=seed, gain=gain, lose=lose)
    return f"""aggregate({column}, named_struct(
        'a', CAST(NULL AS struct<key:string,w:double,p:double>),
        'done', CAST(array() AS array<struct<key:string,up:int>>)), (acc, x) -> {step})"""


def pivotal(units: DataFrame, seed: int, chunk: int = CHUNK) -> DataFrame:
    """key and ``up`` (0 or 1) of every unit (source, key, w, p) with 0 < p < 1 and w > 0."""
    spark = units.sparkSession
    level = written(spark, units.where("p > 0 AND p < 1 AND w > 0"), "mix-units")
    largest = level.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    settled = []
    n = 0
    while True:
        chunks = -(-largest // chunk) if largest > chunk else 1
        per = (level.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk)).alias("chunks")))
        dealt = level.alias("l").join(per.alias("s"), F.expr("l.source <=> s.source")).select(
            F.col("l.source").alias("source"), "key", "w", "p",
            F.expr(f"pmod(xxhash64(key, {seed + n}, 'chunk'), chunks)").alias("c"))
        done = dealt.groupBy("source", "c").agg(F.sort_array(F.collect_list(
            F.struct(F.expr(f"xxhash64(key, {seed + n})").alias("o"), F.struct("key", "w", "p").alias("x")))).alias("g"))
        done = written(spark, done.select("source", F.transform("g", lambda e: e["x"]).alias("g"))
                       .select("source", F.expr(_reduce("g", seed + n)).alias("st"))
                       .select("source", "st.a", "st.done"), f"mix-level{n}")
        settled.append(done.select(F.explode("done").alias("d")).select("d.key", "d.up"))
        level = done.where("a IS NOT NULL").select("source", "a.key", "a.w", "a.p")
        n += 1
        if chunks == 1:
            break
        largest = chunks
    # the root's residual of each source: rounded by its own probability
    settled.append(level.select("key", F.expr(
        f"CAST(pmod(xxhash64(key, {seed}, 'root'), 1000000007) / 1000000007D < p AS int)").alias("up")))
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out


def _copies(sizes: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """key, n (its rows) and ``all_copies`` (what the mix takes of them together)."""
    t = targets.withColumnRenamed("source", "t_source")
    units = (sizes.groupBy("source", "key").agg(F.count(F.lit(1)).alias("n"), F.max("size").cast("double").alias("w"))
             .join(t, F.expr("source <=> t_source")).withColumn("due", F.when(F.col("w") > 0, F.col("n") * F.col("rate")).otherwise(0.0)))
    units = units.select("source", "key", "n", "w", F.floor("due").alias("whole"), F.expr("due - floor(due)").alias("p"))
    up = pivotal(units.select("source", "key", "w", "p"), seed)
    return units.join(up, "key", "left").select("key", "n", (F.col("whole") + F.coalesce("up", F.lit(0))).alias("all_copies"))


def _dealt(rows: DataFrame, out: str) -> DataFrame:
    """``rows`` (written; key, n, all_copies, _row unique and rising per partition) with the copies of each row.

    A key's first ``all_copies % n`` rows take one more than the others.  Rows
    are numbered inside their partition of ``_row``; the rows of earlier
    partitions are added from counts, one small row per key and partition.
    """
    rows = rows.withColumn("_part", F.shiftright("_row", 33))
    counts = rows.groupBy(F.col("key").alias("c_key"), F.col("_part").alias("c_part")).agg(F.count(F.lit(1)).alias("_here"))
    before = counts.select("c_key", "c_part", F.coalesce(F.sum("_here").over(
        Window.partitionBy("c_key").orderBy("c_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    no = F.row_number().over(Window.partitionBy("key", "_part").orderBy("_row")).alias("_no")
    d = rows.select("*", no).join(before, F.expr("key = c_key AND _part = c_part"))
    more = F.when(F.col("_before") + F.col("_no") <= F.col("all_copies") % F.col("n"), 1).otherwise(0)
    return d.withColumn(out, F.floor(F.col("all_copies") / F.col("n")) + more).drop("c_key", "c_part", "_before", "_no", "_part")


def _sizes_targets(docs: DataFrame, budget: float, cap: float) -> tuple[DataFrame, DataFrame]:
    spark = docs.sparkSession
    sizes = written(spark, docs.select(row_key(docs).alias("key"), "doc_id", "source", F.regexp_count(
        text_of(docs), F.lit(WORD)).cast("long").alias("size"), F.monotonically_increasing_id().alias("_row")), "mix-sizes")
    targets = source_targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), budget, cap)
    return sizes, written(spark, targets.withColumn("rate", F.when(
        F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)), "mix-targets")


def mix_copies(docs: DataFrame, seed: int = 17, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """key, doc_id, size, source_size, target, copies, taken; one row per input row."""
    spark = docs.sparkSession
    sizes, targets = _sizes_targets(docs, budget, cap)
    d = written(spark, sizes.join(_copies(sizes, targets, seed), "key"), "mix-copies")
    t = targets.withColumnRenamed("source", "t_source")
    d = (d.where("n = 1").withColumn("copies", F.col("all_copies"))
         .unionByName(_dealt(d.where("n > 1"), "copies")).join(t, F.expr("source <=> t_source"), "left"))
    return d.select("key", "doc_id", "size", "source_size", "target", F.col("copies").cast("long").alias("copies")
                    ).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, seed: int = 17, budget: float = BUDGET, cap: float = CAP) -> DataFrame:
    """The input rows, each repeated as often as the mix takes it (0 to 2 times), with all their columns."""
    spark = docs.sparkSession
    sizes, targets = _sizes_targets(docs, budget, cap)
    copies = written(spark, _copies(sizes, targets, seed).where("all_copies > 0"), "mix-copies")
    # all columns of a row as one, so that none clashes with the names used here
    d = docs.select(row_key(docs).alias("key"), F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    once = d.join(copies.where("n = 1"), "key").select("doc", F.col("all_copies").alias("copies"))
    repeated = written(spark, d.join(copies.where("n > 1"), "key").withColumn("_row", F.monotonically_increasing_id()),
                       "mix-repeated")
    out = once.unionByName(_dealt(repeated, "copies").where("copies > 0").select("doc", "copies"))
    return out.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")


def op6_source_mix(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``documents``."""
    return mix_copies(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
