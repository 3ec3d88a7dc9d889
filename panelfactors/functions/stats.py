"""Exact quantile buckets and order statistics.

Quantile bins follow the interpolated-edge rule of the reference (right-closed
bins, lowest value included, NULL left out).  With ``r`` the 0-based minimum
rank of x among the group's n non-null values and a cut q = a/b, x lies at or
below the interpolated q-edge exactly when ``r <= floor((n-1)*a/b)``, which in
turn holds exactly when ``x <= s[floor((n-1)*a/b)]`` (``s`` the sorted values).
Both forms use integer positions only, so no floating edge ever decides a row.

Two physical strategies give the same labels:

* ``method="edges"`` (default): the needed order statistics of every group are
  selected with a distributed, exact procedure - a mergeable quantile sketch
  brackets each target position, exact counts verify the bracket, and only the
  rows inside the bracket (about 0.2 % of a large group) are sorted.  A hot
  group is never sorted in one task, and the per-group edge table (one row per
  group) is joined back.
* ``method="window"``: ``rank()`` over ``Window.partitionBy(group)``; one task
  sorts each group.  Simple, fine when groups are small cross-sections.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import exact_cuts
from ..session import ensure_checkpoint_dir

# physical strategy for quantile buckets ("edges" or "window")
DEFAULT_METHOD = "edges"

# sketch accuracy (relative rank error 1/accuracy) and bracket half-widths
_ACCURACY = 10000
_WIDTHS = (1e-3, 1e-2)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _frac_name(f: Fraction) -> str:
    return f"{f.numerator}_{f.denominator}"


def _floor_pos(n: Column, f: Fraction) -> Column:
    """floor((n-1) * f) in exact integer arithmetic (n >= 1)."""
    x = (n - 1).cast("long") * F.lit(f.numerator)
    d = F.lit(f.denominator)
    return ((x - x % d) / d).cast("long")


def _candidates(base: DataFrame, keys: list[str], targets: list[tuple[str, callable, float]]) -> DataFrame:
    """Rows that can hold a target order statistic: ``keys..., _n, _t, _pos, _v``.

    ``base`` has the group columns ``keys`` and a non-null double ``_v``.
    ``targets`` are ``(name, position_fn, hint)``: ``position_fn(n)`` gives the
    0-based sorted position wanted in a group of n values and ``hint`` is the
    fraction of n it sits near.  ``_pos`` is the target's position among the
    group's candidates for target ``_t``.

    The per-group tables joined back to ``base`` hold one row per group.  No
    broadcast is forced where the groups come from the data: AQE measures them
    at runtime and broadcasts them when small (calendar periods), and keeps a
    shuffled join for many groups.  Where the named columns are the only groups
    (``keys`` is ``_key``), these tables have a row per column and are
    broadcast, as a join by such a key would sort a whole column in one task.
    """
    few = F.broadcast if keys == ["_key"] else (lambda df: df)
    pcts = sorted({min(1.0, max(0.0, h + s * w)) for _, _, h in targets for w in _WIDTHS for s in (-1, 1)})
    pidx = {p: i for i, p in enumerate(pcts)}

    # pass 1: count and a mergeable sketch per group (partial aggregation)
    stats = base.groupBy(*keys).agg(
        F.count("_v").alias("_n"),
        F.percentile_approx("_v", pcts, _ACCURACY).alias("_q"),
    )
    n, q = F.col("_n"), F.col("_q")
    bexprs = []
    for ti, (_, pos_fn, hint) in enumerate(targets):
        bexprs.append(pos_fn(n).alias(f"_k{ti}"))
        for wi, w in enumerate(_WIDTHS):
            bexprs.append(q[pidx[min(1.0, max(0.0, hint - w))]].alias(f"_lo{ti}_{wi}"))
            bexprs.append(q[pidx[min(1.0, max(0.0, hint + w))]].alias(f"_hi{ti}_{wi}"))
    stats = stats.select(*keys, "_n", *bexprs)
    bcols = [e for e in stats.columns if e not in keys and e != "_n"]

    # pass 2: exact counts below / up to each bracket bound (partial aggregation)
    v = F.col("_v")
    aggs = []
    for ti in range(len(targets)):
        for wi in range(len(_WIDTHS)):
            aggs.append(F.count_if(v < F.col(f"_lo{ti}_{wi}")).alias(f"_lt{ti}_{wi}"))
            aggs.append(F.count_if(v <= F.col(f"_hi{ti}_{wi}")).alias(f"_le{ti}_{wi}"))
    counts = base.join(few(stats), keys).groupBy(*keys, "_n", *bcols).agg(*aggs)

    # narrowest verified bracket; none verified -> the whole group.  The sketch errs by
    # 1e-4 of a group and the wide bracket spans 1e-2 to either side, so only groups of
    # about a hundred values or fewer can miss
    sel = [*keys, "_n"]
    for ti in range(len(targets)):
        k = F.col(f"_k{ti}")
        lo = hi = off = None
        for wi in reversed(range(len(_WIDTHS))):
            ok = (F.col(f"_lt{ti}_{wi}") <= k) & (F.col(f"_le{ti}_{wi}") > k)
            lo_c, hi_c, off_c = F.col(f"_lo{ti}_{wi}"), F.col(f"_hi{ti}_{wi}"), F.col(f"_lt{ti}_{wi}")
            if lo is None:
                lo = F.when(ok, lo_c)
                hi = F.when(ok, hi_c)
                off = F.when(ok, off_c).otherwise(F.lit(0).cast("long"))
            else:
                lo = F.when(ok, lo_c).otherwise(lo)
                hi = F.when(ok, hi_c).otherwise(hi)
                off = F.when(ok, off_c).otherwise(off)
        sel += [(k - off).alias(f"_pos{ti}"), lo.alias(f"_blo{ti}"), hi.alias(f"_bhi{ti}")]
    brackets = counts.select(*sel)

    # pass 3: rows inside a bracket, tagged by target, sorted per (group, target)
    inside = []
    for ti in range(len(targets)):
        blo, bhi = F.col(f"_blo{ti}"), F.col(f"_bhi{ti}")
        cond = (blo.isNull() | (v >= blo)) & (bhi.isNull() | (v <= bhi))
        inside.append(F.when(cond, F.lit(ti)))
    return (
        base.join(few(brackets), keys)
        .withColumn("_t", F.explode(F.filter(F.array(*inside), lambda x: x.isNotNull())))
        .withColumn("_pos", F.element_at(F.array(*[F.col(f"_pos{ti}") for ti in range(len(targets))]),
                                         F.col("_t") + 1))
        .select(*keys, "_n", "_t", "_pos", "_v")
    )


def _select_rows(base: DataFrame, keys: list[str], targets: list[tuple[str, callable, float]]) -> DataFrame:
    """Rows holding each target order statistic: ``keys..., _n, _t, _v`` (one per group and target).

    The bracket candidates are counted per value first (partial sums before the
    shuffle), so a tied value is one row whatever its count; only the distinct
    values of a bracket are sorted, per (group, target).
    """
    values = (_candidates(base, keys, targets).groupBy(*keys, "_n", "_t", "_pos", "_v")
              .agg(F.count(F.lit(1)).alias("_c")))
    w = Window.partitionBy(*keys, "_t").orderBy("_v")
    upto = F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (values.withColumn("_upto", upto)
            .filter((F.col("_pos") < F.col("_upto")) & (F.col("_pos") >= F.col("_upto") - F.col("_c")))
            .select(*keys, "_n", "_t", "_v"))


def _stack(df: DataFrame, by: list[str], columns: dict[str, object]) -> DataFrame:
    """(by..., _key, _v) rows for every non-null value of the named columns."""
    structs = [F.struct(F.lit(k).alias("_key"), _col(c).cast("double").alias("_v")) for k, c in columns.items()]
    return (
        df.select(*by, F.explode(F.array(*structs)).alias("_s"))
        .select(*by, F.col("_s._key").alias("_key"), F.col("_s._v").alias("_v"))
        .filter(F.col("_v").isNotNull())
    )


def percentiles(df: DataFrame, by: list[str], columns: dict[str, object], probs) -> DataFrame:
    """Linearly interpolated percentiles (the ``quantile_cont`` definition), exact.

    Output: ``by..., {name}__n, {name}__p{i}`` for each prob index i.  ``by`` may be
    empty: the columns of the whole table.
    """
    fracs = [p if isinstance(p, Fraction) else Fraction(str(p)) for p in probs]
    targets = []
    for f in fracs:
        targets.append(("lo", (lambda n, f=f: _floor_pos(n, f)), float(f)))
        targets.append(("hi", (lambda n, f=f: F.least(_floor_pos(n, f) + 1, n - 1)), float(f)))
    picked = _select_rows(_stack(df, by, columns), by + ["_key"], targets)
    aggs = []
    for name in columns:
        is_name = F.col("_key") == name
        aggs.append(F.first(F.when(is_name, F.col("_n")), ignorenulls=True).alias(f"{name}__n"))
        for ti in range(len(targets)):
            aggs.append(F.first(F.when(is_name & (F.col("_t") == ti), F.col("_v")), ignorenulls=True)
                        .alias(f"_{name}__t{ti}"))
    # without groups one row of the whole table, and none where no value is
    stats = picked.groupBy(*by or [F.lit(0).alias("_all")]).agg(*aggs)
    outs = []
    for name in columns:
        n = F.col(f"{name}__n")
        outs.append(n)
        for i, f in enumerate(fracs):
            rem = ((n - 1).cast("long") * F.lit(f.numerator)) % F.lit(f.denominator)
            weight = rem.cast("double") / F.lit(float(f.denominator))
            lo, hi = F.col(f"_{name}__t{2 * i}"), F.col(f"_{name}__t{2 * i + 1}")
            outs.append((lo + (hi - lo) * weight).alias(f"{name}__p{i}"))
    return stats.select(*by, *outs)


def _label_by_rank(col: Column, r: Column, n: Column, cuts, labels) -> Column:
    fr = exact_cuts(cuts)
    inner = fr[1:-1]
    expr = None
    for f, lab in zip(inner, labels[:-1]):
        cond = r * F.lit(f.denominator) <= (n - 1) * F.lit(f.numerator)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    expr = F.lit(labels[-1]) if expr is None else expr.otherwise(F.lit(labels[-1]))
    return F.when(col.isNotNull(), expr)


def _stored(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bucket_frames(frames: list[tuple[DataFrame, list[str], list[tuple]]]) -> list[DataFrame]:
    """Quantile buckets for several tables in one shared selection pass.

    ``frames`` are ``(df, by, specs)`` with ``specs`` as in :func:`qbuckets`;
    all tables must have the same number of group columns.  Every sort of
    every table is stacked into one long ``(group, sort, value)`` frame, the
    needed order statistics are selected together, and one wide edge table
    (one row per group) is joined back to each table.

    Every table (entity-period grain) is checkpointed to the shared folder
    first, by a job that runs while the plan is built: the selection passes and
    the join back all read it, so statements, caps and windows run once.
    """
    width = {len(by) for _, by, _ in frames}
    if len(width) != 1:
        raise ValueError("all frames need the same number of group columns")
    gcols = [f"_g{i}" for i in range(width.pop())]
    all_cuts = sorted({f for _, _, specs in frames for _, cuts, _, _ in specs
                       for f in exact_cuts(cuts) if 0 < f < 1})
    frames = [(_stored(df), by, specs) for df, by, specs in frames]
    longs = []
    for df, by, specs in frames:
        structs = [F.struct(F.lit(name).alias("_key"), _col(col).cast("double").alias("_v"))
                   for col, _, _, name in specs]
        longs.append(df.select(*[F.col(b).alias(g) for b, g in zip(by, gcols)],
                               F.explode(F.array(*structs)).alias("_s")))
    long = longs[0]
    for other in longs[1:]:
        long = long.unionByName(other)
    long = (long.select(*gcols, F.col("_s._key").alias("_key"), F.col("_s._v").alias("_v"))
            .filter(F.col("_v").isNotNull()))
    targets = [(f"_e{_frac_name(f)}", (lambda n, f=f: _floor_pos(n, f)), float(f)) for f in all_cuts]
    picked = _select_rows(long, gcols + ["_key"], targets)
    aggs = []
    for _, _, specs in frames:
        for _, cuts, _, name in specs:
            for f in exact_cuts(cuts):
                if 0 < f < 1:
                    ti = all_cuts.index(f)
                    aggs.append(F.first(F.when((F.col("_key") == name) & (F.col("_t") == ti), F.col("_v")),
                                        ignorenulls=True).alias(f"{name}__{_frac_name(f)}"))
    # one row per group; AQE broadcasts it at runtime when small (periods)
    edges = picked.groupBy(*gcols).agg(*aggs)

    outs = []
    for df, by, specs in frames:
        mine = [c for c in edges.columns if c in gcols or any(c.startswith(f"{n}__") for _, _, _, n in specs)]
        e = edges.select(*mine)
        cond = None
        for b, g in zip(by, gcols):
            c = df[b] == e[g]
            cond = c if cond is None else cond & c
        joined = df.join(e, cond, "left")
        labels_sel = []
        for col, cuts, labels, name in specs:
            c = _col(col)
            expr = None
            for f, lab in zip([f for f in exact_cuts(cuts) if 0 < f < 1], labels[:-1]):
                edge = F.col(f"{name}__{_frac_name(f)}")
                expr = F.when(c <= edge, F.lit(lab)) if expr is None else expr.when(c <= edge, F.lit(lab))
            expr = F.lit(labels[-1]) if expr is None else expr.otherwise(F.lit(labels[-1]))
            labels_sel.append(F.when(c.isNotNull(), expr).alias(name))
        outs.append(joined.select(*[df[c] for c in df.columns], *labels_sel))
    return outs


def qbuckets(df: DataFrame, by: list[str], specs: list[tuple], method: str | None = None,
             strict: bool = False) -> DataFrame:
    """Add quantile-bucket label columns, one per spec ``(column, cuts, labels, out)``.

    Buckets are formed inside each group of ``by`` (e.g. per year or month).
    ``strict=True`` raises, like the reference, when a group's interpolated
    edges tie.
    """
    for _, cuts, labels, _ in specs:
        if len(labels) != len(cuts) - 1:
            raise ValueError("need one label per bin")
    method = method or DEFAULT_METHOD
    if strict:
        df = _check_distinct_edges(df, by, specs)
    if method == "window":
        labels_sel = []
        for col, cuts, labels, name in specs:
            c = _col(col)
            r = F.rank().over(Window.partitionBy(*by).orderBy(c.asc_nulls_last())) - 1
            n = F.count(c).over(Window.partitionBy(*by))
            labels_sel.append(_label_by_rank(c, r, n, cuts, labels).alias(name))
        return df.select("*", *labels_sel)
    if method != "edges":
        raise ValueError(f"unknown method {method!r}")
    return bucket_frames([(df, list(by), specs)])[0]


def qbucket(df: DataFrame, by, col, cuts, labels, out: str, method: str | None = None,
            strict: bool = False) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    return qbuckets(df, by, [(col, cuts, labels, out)], method=method, strict=strict)


def tied_edges(df: DataFrame, by: list[str], specs) -> DataFrame:
    """Groups whose interpolated bin edges tie: ``by..., sort, low_cut, high_cut, edge``, one row per tied pair.

    The edges (minimum, cuts, maximum) of all sorts are selected in one pass.
    """
    cuts = sorted({f for _, c, _, _ in specs for f in exact_cuts(c)})
    p = percentiles(df, list(by), {name: col for col, _, _, name in specs}, cuts)
    pairs = []
    for _, c, _, name in specs:
        mine = exact_cuts(c)
        for low, high in zip(mine, mine[1:]):
            a, b = (F.col(f"{name}__p{cuts.index(f)}") for f in (low, high))
            pairs.append(F.when(a == b, F.struct(F.lit(name).alias("sort"), F.lit(float(low)).alias("low_cut"),
                                                 F.lit(float(high)).alias("high_cut"), a.alias("edge"))))
    tied = F.filter(F.array(*pairs), lambda x: x.isNotNull())
    return p.select(*by, F.explode(tied).alias("_tie")).select(*by, "_tie.*")


def _check_distinct_edges(df: DataFrame, by: list[str], specs) -> DataFrame:
    """Fail the job, naming the group, when interpolated edges (min, cuts, max) of a group tie."""
    groups = tied_edges(df, by, specs).groupBy(*by).agg(F.min("sort").alias("_tie"))
    what = F.concat(F.lit("bin edges must be unique: "), F.concat_ws(", ", F.col("_tie"), *[F.col(b).cast("string") for b in by]))
    return (df.join(groups, list(by), "left")
            .filter(F.when(F.col("_tie").isNotNull(), F.raise_error(what)).otherwise(F.lit(True))).drop("_tie"))
