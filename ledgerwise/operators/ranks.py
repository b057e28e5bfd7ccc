"""Whole-table ranks without a single-partition window, one path for every size.

``percent_rank().over(Window.orderBy(c))`` and ``ntile`` without a partition
key move every row into one task. The forms here give the same numbers with
work spread over the cluster:

* ``prefix_sums`` range-partitions a table by its key once, writes it with the
  partition number, and adds running sums inside partitions to the sums of the
  partitions before (one row per partition). It works on any orderable type.
* ``order_statistics`` finds the value at given 1-based positions of the sorted
  order (per group) exactly, in two steps whatever the size: candidates from a
  bounded sample, with an exact count of the rows between and on them (one
  scan, map-side combine); then the rows of the slices that hold an unfinished
  position, ranked by ``prefix_sums``. Candidates keep the column's own type.
* ``ntile`` only needs the ``k - 1`` tile borders: once the row at each border
  is known, every row's tile is a projection (no shuffle at all).
* ``percent_rank`` rounded to ``digits`` has at most ``10**digits + 1`` results.
  The smallest value of each result is found on the table of distinct values;
  a row's rank is then a binary search in that list: a projection as well.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

GRID = 128             # slices an order-statistics search cuts a group into
SAMPLE_ROWS = 20_000   # rows a search draws its candidates from


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _valid(df: DataFrame, c: str) -> Column:
    cond = F.col(c).isNotNull()
    if _is_float(df, c):
        cond = cond & ~F.isnan(F.col(c))
    return cond


# ---------------------------------------------------------------------------
# binary search as projections
# ---------------------------------------------------------------------------

def _literal_lists(lists: Sequence[Sequence[str]], dtype: T.DataType) -> Column:
    """A constant array of arrays; values come as strings Spark cast them to."""
    text = F.from_json(F.lit(json.dumps([list(x) for x in lists])), "array<array<string>>")
    return text.cast(T.ArrayType(T.ArrayType(dtype)))


def _count_below(df: DataFrame, value: str, cuts: Column, longest: int, out: str, equal: bool = False) -> DataFrame:
    """Adds ``out``: how many elements of the sorted array ``cuts`` are below
    ``value`` (or equal to it, with ``equal``). One projection per halving, so an
    element is compared once and nothing is expanded into nested cases."""
    df = df.withColumn(out, F.lit(0))
    step = 1 << max(longest.bit_length() - 1, 0)
    while step and longest:
        at = F.try_element_at(cuts, F.col(out) + F.lit(step))
        right = at <= F.col(value) if equal else at < F.col(value)
        df = df.withColumn(out, F.col(out) + F.when(right, F.lit(step)).otherwise(F.lit(0)))
        step >>= 1
    return df


# ---------------------------------------------------------------------------
# prefix sums
# ---------------------------------------------------------------------------

def prefix_sums(table: DataFrame, key: str | Sequence[str], cols: Sequence[str],
                with_prev: bool = False, with_totals: bool = False, partitions: int | None = None) -> DataFrame:
    """Running sums over a table with one row per ``key``, in key order (null
    first, NaN last): adds ``_before_<c>`` (sum of ``c`` over smaller keys) and,
    with ``with_prev``, ``_prev_<c>`` (``c`` of the next smaller key), with
    ``with_totals``, ``_total_<c>``.

    ``partitions`` fixes the number of ranges; by default it is the session's
    number of shuffle partitions, which adaptive execution may merge. The
    broadcast offsets have one row per range.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [F.col(k).asc_nulls_first() for k in keys]
    ranged = table.repartitionByRange(partitions, *order) if partitions else table.repartitionByRange(*order)
    t = materialize(ranged.withColumn("_part", F.spark_partition_id()), "ranged")
    aggs = [F.sum(c).alias(f"_s_{c}") for c in cols]
    if with_prev:
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*keys)).alias("_last"))
    per_part = t.groupBy("_part").agg(*aggs)
    ow = Window.orderBy("_part")  # one row per range
    sel = ["_part"] + [F.coalesce(F.sum(f"_s_{c}").over(ow.rowsBetween(Window.unboundedPreceding, -1)),
                                  F.lit(0)).alias(f"_off_{c}") for c in cols]
    if with_prev:
        sel.append(F.lag("_last").over(ow).alias("_plast"))
    if with_totals:
        sel += [F.sum(f"_s_{c}").over(Window.partitionBy()).alias(f"_total_{c}") for c in cols]
    offs = per_part.select(*sel)
    w = Window.partitionBy("_part").orderBy(*order)
    wb = w.rowsBetween(Window.unboundedPreceding, -1)
    out = [F.col(c) for c in table.columns]
    out += [(F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(wb), F.lit(0))).alias(f"_before_{c}") for c in cols]
    if with_prev:
        out += [F.coalesce(F.lag(c).over(w), F.col(f"_plast.{c}")).alias(f"_prev_{c}") for c in cols]
    if with_totals:
        out += [F.col(f"_total_{c}") for c in cols]
    return t.join(F.broadcast(offs), "_part").select(*out)


# ---------------------------------------------------------------------------
# exact order statistics
# ---------------------------------------------------------------------------

def order_statistics(df: DataFrame, value: str, positions: dict[tuple, Sequence[int]],
                     group_cols: Sequence[str] = (), group_sizes: dict[tuple, int] | None = None,
                     grid: int | None = None, sample_rows: int | None = None,
                     partitions: int | None = None) -> dict[tuple, tuple]:
    """Exact k-th smallest values among the non-null, non-NaN ``value``s.

    ``positions`` maps a group key tuple (``()`` without groups) to wanted
    1-based positions. Returns ``{(key, pos): (value, rows_before, ties)}``:
    ``rows_before`` counts the group's rows with a smaller value, ``ties`` those
    with the same. Positions outside ``1..n`` map to ``(None, None, 0)``.

    To the driver come at most ``grid`` candidates and ``2 * grid`` counts per
    wanted group, and one row per wanted position.
    """
    grid, sample_rows = grid or GRID, sample_rows or SAMPLE_ROWS
    spark, group_cols = df.sparkSession, list(group_cols)
    dtype = df.schema[value].dataType
    base = df.filter(_valid(df, value)).select(*group_cols, F.col(value).alias("_v"))
    if group_sizes is None:
        got = base.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("_n")).collect()
        group_sizes = {tuple(r[g] for g in group_cols): r["_n"] for r in got}
    result = {(tuple(k), p): (None, None, 0) for k, ps in positions.items() for p in ps}
    targets = [(k, p) for k, p in result if 1 <= p <= group_sizes.get(k, 0)]
    if not targets:
        return result
    groups = list(dict.fromkeys(k for k, _ in targets))
    gid = {k: i for i, k in enumerate(groups)}

    # rows of the wanted groups, numbered
    if group_cols:
        fields = [T.StructField(f"_g{i}", df.schema[c].dataType) for i, c in enumerate(group_cols)]
        ids = spark.createDataFrame([(*k, i) for k, i in gid.items()], T.StructType([*fields, T.StructField("_gid", T.IntegerType())]))
        cond = F.lit(True)
        for i, c in enumerate(group_cols):
            cond = cond & F.col(c).eqNullSafe(F.col(f"_g{i}"))
        # one row per wanted group, all of them known to the driver
        rows = base.join(F.broadcast(ids), cond).select("_gid", "_v")
    else:
        rows = base.select(F.lit(0).alias("_gid"), "_v")

    # 1. candidates from a bounded sample, exact counts between and on them
    total = sum(group_sizes[k] for k in groups)
    share = min(1.0, sample_rows / max(total, 1))
    drawn = rows.sample(share, seed=17) if share < 1.0 else rows
    at = F.transform(F.sequence(F.lit(1), F.lit(grid - 1)), lambda i: F.greatest(F.lit(1), F.ceil(i * F.size("_s") / F.lit(grid))).cast("int"))
    cand = (drawn.groupBy("_gid").agg(F.sort_array(F.collect_list("_v")).alias("_s"))
            .select("_gid", F.array_distinct(F.transform(at, lambda i: F.element_at("_s", i))).cast("array<string>").alias("_c")).collect())
    cuts: list[list[str]] = [[] for _ in groups]
    for r in cand:
        cuts[r["_gid"]] = list(r["_c"])
    here = F.element_at(_literal_lists(cuts, dtype), F.col("_gid") + 1)
    slotted = _count_below(rows, "_v", here, max(map(len, cuts)), "_slot")
    slotted = slotted.withColumn("_on", F.coalesce(F.try_element_at(here, F.col("_slot") + 1) == F.col("_v"), F.lit(False)))
    counts = {(r["_gid"], r["_slot"], r["_on"]): (r["_n"], r["_low"]) for r in slotted.groupBy("_gid", "_slot", "_on").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low")).collect()}

    # place every target on a candidate or in the slice before it
    pending: dict[tuple[int, int], list] = {}
    for k, p in targets:
        g, below = gid[k], 0
        for s in range(len(cuts[g]) + 1):
            inside, on = counts.get((g, s, False), (0, None))[0], counts.get((g, s, True), (0, None))
            if p <= below + inside:
                pending.setdefault((g, s), []).append((k, p, below))
                break
            if p <= below + inside + on[0]:
                result[k, p] = (on[1], below + inside, on[0])
                break
            below += inside + on[0]
    if not pending:
        return result

    # 2. rank the slices that hold open targets, all together; a slice is named by
    # its ends, so the rows outside are left at the scan
    def inside_slice(g: int, s: int) -> Column:
        cond = F.col("_gid") == F.lit(g)
        if s > 0:
            cond = cond & (F.col("_v") > F.lit(cuts[g][s - 1]).cast(dtype))
        return cond & (F.col("_v") < F.lit(cuts[g][s]).cast(dtype)) if s < len(cuts[g]) else cond

    slices = sorted(pending)
    code = F.lit(None).cast("int")
    for i, (g, s) in enumerate(slices):
        code = F.when(inside_slice(g, s), F.lit(i)).otherwise(code)
    some = F.lit(False)
    for g, s in slices:
        some = some | inside_slice(g, s)
    open_rows = rows.filter(some).groupBy(code.alias("_code"), "_v").agg(F.count(F.lit(1)).alias("_n"))
    first, wanted = 0, {}
    for g, s in slices:
        for k, p, below in pending[g, s]:
            wanted.setdefault(first + p - below, []).append((k, p, below - first))
        first += counts[g, s, False][0]
    hits = F.filter(F.from_json(F.lit(json.dumps(sorted(wanted))), "array<bigint>"),
                    lambda x: (x > F.col("_before__n")) & (x <= F.col("_before__n") + F.col("_n")))
    ranked = prefix_sums(open_rows, ["_code", "_v"], ["_n"], partitions=partitions)
    for r in ranked.withColumn("_hits", hits).filter(F.size("_hits") > 0).collect():
        for x in r["_hits"]:
            for k, p, shift in wanted[x]:
                result[k, p] = (r["_v"], r["_before__n"] + shift, r["_n"])
    missing = [t for t in targets if result[t][2] == 0]
    if missing:
        raise RuntimeError(f"order statistics not found, the input changed between two reads: {missing[:5]}")
    return result


# ---------------------------------------------------------------------------
# ntile
# ---------------------------------------------------------------------------

def _tile_borders(n: int, k: int) -> list[int]:
    """1-based position of the last row of tiles 1..k-1 (first ``n % k`` tiles hold one more)."""
    q, r = divmod(n, k)
    return [t * q + min(t, r) for t in range(1, k)]


def _border_keys(df: DataFrame, value: str, tiebreak: str, borders: list[int], n_null: int,
                 n_valid: int, value_stats: dict, **search) -> list[tuple]:
    """(value, tiebreak) of the row at each 1-based border position of the
    order ``value ASC NULLS FIRST (NaN last), tiebreak ASC NULLS FIRST``.

    The value at each border is known; the tiebreak is an order statistic
    among the rows sharing that value. All borders are resolved together:
    each row is tagged with the borders whose value it holds (at most
    ``len(borders)`` tags), one aggregate counts null / valid tiebreaks per
    border, and one order-statistics search runs grouped by border. A border
    between rows of one (value, tiebreak) is not defined and raises.
    """
    specs = []
    for pos in borders:
        if pos <= n_null:
            specs.append((None, pos, F.col(value).isNull()))
        elif pos <= n_null + n_valid:
            v, before, _ = value_stats[((), pos - n_null)]
            specs.append((v, pos - n_null - before, F.col(value) == F.lit(v)))
        else:
            specs.append((float("nan"), pos - n_null - n_valid, F.isnan(F.col(value))))
    if not specs:
        return []
    tags = F.array(*[F.when(cond, F.lit(i)) for i, (_, _, cond) in enumerate(specs)])
    tagged = (df.select(tiebreak, F.explode(F.filter(tags, lambda x: x.isNotNull())).alias("_b")))
    counts = {r["_b"]: (r["nulls"], r["valid"], r["rows"]) for r in tagged.groupBy("_b").agg(
        F.count_if(F.col(tiebreak).isNull()).alias("nulls"),
        F.count_if(_valid(tagged, tiebreak)).alias("valid"), F.count(F.lit(1)).alias("rows")).collect()}
    wanted, sizes = {}, {}
    for i, (_, rel, _) in enumerate(specs):
        nulls, valid, _ = counts.get(i, (0, 0, 0))
        if nulls < rel <= nulls + valid:
            wanted[(i,)] = [rel - nulls]
            sizes[(i,)] = valid
    got = order_statistics(tagged, tiebreak, wanted, group_cols=["_b"], group_sizes=sizes, **search) if wanted else {}
    out = []
    for i, (v, rel, _) in enumerate(specs):
        if (i,) in wanted:
            t, before, ties = got[((i,), wanted[(i,)][0])]
            split = before + ties != wanted[(i,)][0]
        else:
            nulls, _, rows = counts.get(i, (0, 0, 0))
            t, last = (None, nulls) if rel <= nulls else (float("nan"), rows)
            split = rel != last
        if split:
            raise ValueError(f"several rows have {value}={v!r}, {tiebreak}={t!r} at a tile border; "
                             "the tiebreak must tell rows apart")
        out.append((v, t))
    return out


def _positions_in(ranked: DataFrame, value: str, positions: list[int], n_null: int) -> dict[tuple, tuple]:
    """Order statistics read off a table of ranked values; positions count valid rows."""
    at = F.from_json(F.lit(json.dumps([p + n_null for p in positions])), "array<bigint>")
    hits = F.filter(at, lambda x: (x > F.col("_before")) & (x <= F.col("_before") + F.col("_cnt")))
    rows = ranked.withColumn("_hits", hits).filter(F.size("_hits") > 0).collect()
    return {((), x - n_null): (r[value], r["_before"] - n_null, r["_cnt"]) for r in rows for x in r["_hits"]}


def ntile_column(df: DataFrame, value: str, k: int, tiebreak: str, ranked: DataFrame | None = None, **search) -> Column:
    """The tile of ``ntile(k) over (order by value, tiebreak)`` as a column
    expression: the ``k - 1`` border keys are found on ``df`` now (a few
    small jobs), and the returned expression compares a row's (value,
    tiebreak) key with them, so it can be applied to ``df`` or to any frame
    derived from it that keeps both columns, without recomputing that frame.
    Struct comparison orders null first and NaN last, as the window does.
    With ``ranked`` (``ranked_values`` of the same rows) the borders' values are
    read off that table.
    """
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col(value).isNull()).alias("nulls"),
                 F.count_if(_valid(df, value)).alias("valid")).first()
    n, n_null, n_valid = agg["n"], agg["nulls"], agg["valid"]
    borders = [p for p in _tile_borders(n, k) if 1 <= p < n]
    inner = sorted({p - n_null for p in borders if n_null < p <= n_null + n_valid})
    if ranked is not None:
        stats = _positions_in(ranked, value, inner, n_null)
    else:
        stats = order_statistics(df, value, {(): inner}, group_sizes={(): n_valid}, **search)
    keys = _border_keys(df, value, tiebreak, borders, n_null, n_valid, stats, **search)
    vt = df.schema[value].dataType
    tt = df.schema[tiebreak].dataType
    row_key = F.struct(F.col(value).alias("v"), F.col(tiebreak).alias("t"))
    tile = F.lit(1)
    for v, t in keys:
        border = F.struct(F.lit(v).cast(vt).alias("v"), F.lit(t).cast(tt).alias("t"))
        tile = tile + F.when(row_key > border, F.lit(1)).otherwise(F.lit(0))
    return tile.cast("int")


def with_ntile(df: DataFrame, value: str, k: int, tiebreak: str, out: str, **search) -> DataFrame:
    """``ntile(k) over (order by value, tiebreak)`` as a projection (see
    ``ntile_column``): no shuffle once the borders are known."""
    return df.withColumn(out, ntile_column(df, value, k, tiebreak, **search))


# ---------------------------------------------------------------------------
# percent_rank
# ---------------------------------------------------------------------------

def ranked_values(df: DataFrame, value: str, partitions: int | None = None) -> DataFrame:
    """One row per distinct value (null and NaN included): ``value, _cnt,
    _before`` where ``_before`` counts rows ordered before the value."""
    vt = df.groupBy(value).agg(F.count(F.lit(1)).alias("_cnt"))
    return prefix_sums(vt, value, ["_cnt"], with_totals=True, partitions=partitions) \
        .withColumnRenamed("_before__cnt", "_before").withColumnRenamed("_total__cnt", "_n")


def percent_rank_steps(ranked: DataFrame, value: str, digits: int = 4) -> list[tuple]:
    """(rank, smallest non-null value of that rank as a string) in rank order, from
    ``ranked_values``: at most ``10**digits + 1`` rows."""
    rank = F.when(F.col("_n") > 1, F.round(F.col("_before").cast("double") / (F.col("_n") - 1).cast("double"), digits)).otherwise(F.lit(0.0))
    steps = (ranked.filter(F.col(value).isNotNull())
             .groupBy(rank.alias("rank")).agg(F.min(value).cast("string").alias("low")))
    return sorted((r["rank"], r["low"]) for r in steps.collect())


def apply_percent_rank(df: DataFrame, value: str, out: str, steps: list[tuple]) -> DataFrame:
    """The rank of each row by binary search in ``steps``; null values rank 0."""
    if not steps:
        return df.withColumn(out, F.lit(0.0))
    cuts = F.element_at(_literal_lists([[low for _, low in steps]], df.schema[value].dataType), 1)
    ranks = F.from_json(F.lit(json.dumps([r for r, _ in steps])), "array<double>")
    found = _count_below(df, value, cuts, len(steps), "_at", equal=True)
    return found.withColumn(out, F.when(F.col(value).isNull(), F.lit(0.0)).otherwise(F.try_element_at(ranks, F.col("_at")))).drop("_at")


def with_percent_rank(df: DataFrame, value: str, out: str, digits: int = 4, partitions: int | None = None) -> DataFrame:
    """``round(percent_rank() over (order by value), digits)``: the rows are
    only projected."""
    return apply_percent_rank(df, value, out, percent_rank_steps(ranked_values(df, value, partitions), value, digits))
