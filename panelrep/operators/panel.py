"""Panel operators: the building blocks of every indicator.

All functions take and return DataFrames and perform no action.  Small
lookups are broadcast only through :class:`~panelrep.operators.bounded.Small`
(or a :class:`~panelrep.sources.bridges.Bridge`), i.e. when the plan's
statistics say so; everything else is left to the planner and AQE.

Scale notes
-----------
* :func:`bridged_state` sums facts at their *native* grain first (map-side
  partial aggregation, then one shuffle on the native keys), and only then
  fans the much smaller result out through the bridges.  A hot key (one
  region holding a third of all rows) is absorbed by the partial aggregation.
* :func:`group_share` replaces a window over the group (one task per group)
  by an aggregate and a join back on group and part; a sketch of frequent keys
  tells which groups need how many parts before any join.
* :func:`densify` gathers the cells of a nest key once and adds the missing
  ones to that list: no join, and no second scan of the facts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exactsum
from ..functions.nullmath import (ROWS, fill_missing, ieee_div, row_count_part, strict_sum_merge, strict_sum_parts)
from .bounded import Small


# ---------------------------------------------------------------------------
# bridge expansion
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Via:
    """One bridge step: join fact column ``on`` to ``bridge.key``, adding ``out``.

    ``how`` is ``left`` (unmatched rows keep a null category) or ``inner``
    (unmatched rows are dropped).  ``match_nulls`` makes a null fact key match
    null bridge keys (the reference behaviour); ``None`` follows the config.
    """

    bridge: "object"  # panelrep.sources.bridges.Bridge (avoid import cycle)
    on: str
    how: str = "left"
    out: str | None = None
    match_nulls: bool | None = None

    @property
    def out_col(self) -> str:
        return self.out or self.bridge.value


def expand(df: DataFrame, via: Via, *, match_nulls: bool = True) -> DataFrame:
    """Fan ``df`` out through a bridge (1 row -> 0..n rows)."""
    mn = match_nulls if via.match_nulls is None else via.match_nulls
    br = via.bridge
    # Spark resolves names case-insensitively: a native ``region`` and the
    # reported ``Region`` cannot coexist, so the native key is consumed.
    clash = [c for c in df.columns if c.lower() == via.out_col.lower()]
    if clash and clash[0] != via.on:
        raise ValueError(f"column {clash[0]!r} already present; drop or rename it first")
    b = _bridge_side(br, mn)
    cond = df[via.on].eqNullSafe(b["__bk"]) if mn else df[via.on] == b["__bk"]
    keep = [df[c] for c in df.columns if not (clash and c == via.on)]
    return df.join(b, cond, via.how).select(*keep, b["__bv"].alias(via.out_col))


def _bridge_side(br, match_nulls: bool) -> DataFrame:
    """``(__bk, __bv)`` view of a bridge, broadcast when small; equal broadcasts are reused within a plan."""
    b = br.df.select(F.col(br.key).alias("__bk"), F.col(br.value).alias("__bv"))
    if not match_nulls:
        b = b.filter(F.col("__bk").isNotNull())
    return F.broadcast(b) if br.small.bounded else b


def expand_all(df: DataFrame, vias: Sequence[Via], *, match_nulls: bool = True) -> DataFrame:
    return reduce(lambda d, v: expand(d, v, match_nulls=match_nulls), vias, df)


def _dedupe(cols: Iterable[str]) -> list[str]:
    out: list[str] = []
    for c in cols:
        if c not in out:
            out.append(c)
    return out


def _with_limbs(df: DataFrame, values: Sequence[str], exact: bool) -> tuple[DataFrame, list[str]]:
    """Adds the columns of order-free sums to the values that are doubles; the names of those values."""
    types = dict(df.dtypes)
    doubles = [v for v in values if exact and types[v] in ("double", "float")]
    new = {f"{v}__b": exactsum.bin_of(F.col(v)) for v in doubles}
    for v in doubles:
        new |= dict(zip([f"{v}__{k}" for k in "012x"], exactsum.limbs(F.col(v))))
    return df.withColumns(new) if new else df, doubles


def _sums(values: Sequence[str], doubles: Sequence[str]) -> list[str]:
    """Names of the columns of a state that are summed when states merge."""
    return [c for v in values for c in ([f"{v}__{k}" for k in "012x"] if v in doubles else [f"{v}__s"]) + [f"{v}__n"]] \
        + [ROWS]


def _merge(state: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return state.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def sum_state(df: DataFrame, keys: Sequence[str], values: Sequence[str], exact: bool = True) -> DataFrame:
    """Strict-sum state of ``values`` by ``keys`` (see :func:`bridged_state`), without bridges."""
    df, doubles = _with_limbs(df, values, exact)
    parts = []
    for v in values:
        parts += [F.sum(f"{v}__{k}").alias(f"{v}__{k}") for k in "012x"] + [F.count(v).alias(f"{v}__n")] \
            if v in doubles else strict_sum_parts(v, v)
    return df.groupBy(*keys, *[f"{v}__b" for v in doubles]).agg(*parts, row_count_part())


def bridged_state(df: DataFrame, group_by: Sequence[str], values: Sequence[str], vias: Sequence[Via], *,
                  pre_aggregate: bool = True, match_nulls: bool = True, exact: bool = True) -> DataFrame:
    """Strict-sum *state* of ``values`` by ``group_by`` after bridge expansion.

    Output columns: ``group_by``, ``<v>__s`` (sum), ``<v>__n`` (non-null
    count) per value, and ``__rows``.  A double value has, unless ``exact`` is
    off, a key ``<v>__b`` and sums ``<v>__0`` to ``<v>__2`` and ``<v>__x``
    instead of ``<v>__s`` (:mod:`panelrep.functions.exactsum`), so that its sum
    does not depend on the order of the rows.  Finish with :func:`finish_sum`;
    states can be filtered and re-merged (one pass for several variants).
    """
    outs = {v.out_col for v in vias}
    native = _dedupe([c for c in group_by if c not in outs] + [v.on for v in vias])
    if not pre_aggregate:
        return sum_state(expand_all(df, vias, match_nulls=match_nulls), group_by, values, exact)
    pre = sum_state(df, native, values, exact)
    doubles = [v for v in values if f"{v}__b" in pre.columns]
    wide = expand_all(pre, vias, match_nulls=match_nulls)
    return _merge(wide, [*group_by, *[f"{v}__b" for v in doubles]], _sums(values, doubles))


def finish_sum(state: DataFrame, group_by: Sequence[str], values: Sequence[str], *,
               strict: bool = True, merged: bool = False) -> DataFrame:
    """Merge strict-sum states by ``group_by`` (coarser or equal to the state keys).

    ``merged``: the state is by ``group_by`` already.  Doubles take a second
    grouping, which brings a group's few bins together.
    """
    doubles = [v for v in values if f"{v}__b" in state.columns]
    if not doubles:
        aggs = [(strict_sum_merge(v) if strict else F.sum(f"{v}__s")).alias(v) for v in values]
        return state.groupBy(*group_by).agg(*aggs)
    if not merged:
        state = _merge(state, [*group_by, *[f"{v}__b" for v in doubles]], _sums(values, doubles))
    aggs = [F.sum(f"{v}__s").alias(f"{v}__s") for v in values if v not in doubles]
    aggs += [F.sum(f"{v}__n").alias(f"{v}__n") for v in values] + [F.sum(ROWS).alias(ROWS)]
    for v in doubles:
        aggs += [F.collect_list(exactsum.parts(f"{v}__b", [f"{v}__{k}" for k in "012"])).alias(f"{v}__p"),
                 F.sum(f"{v}__x").alias(f"{v}__x")]
    out = state.groupBy(*group_by).agg(*aggs)
    whole = {v: exactsum.total(F.col(f"{v}__p")) + F.col(f"{v}__x") if v in doubles else F.col(f"{v}__s") for v in values}
    return out.select(*group_by, *[
        F.when(F.col(f"{v}__n") == F.col(ROWS) if strict else F.col(f"{v}__n") > 0, whole[v]).alias(v) for v in values])


def expand_and_sum(df: DataFrame, group_by: Sequence[str], values: Sequence[str], vias: Sequence[Via], *,
                   pre_aggregate: bool = True, match_nulls: bool = True, strict: bool = True,
                   exact: bool = True) -> DataFrame:
    """Bridge expansion followed by a grouped (strict) sum of ``values``."""
    state = bridged_state(df, group_by, values, vias, pre_aggregate=pre_aggregate, match_nulls=match_nulls, exact=exact)
    if any(f"{v}__b" in state.columns for v in values):
        return finish_sum(state, group_by, values, strict=strict, merged=True)
    return state.select(*group_by, *[
        (F.when(F.col(f"{v}__n") == F.col(ROWS), F.col(f"{v}__s")) if strict else F.col(f"{v}__s")).alias(v)
        for v in values])


def grouped_sum(df: DataFrame, group_by: Sequence[str], values: Sequence[str], *, strict: bool = True,
                exact: bool = True) -> DataFrame:
    return expand_and_sum(df, group_by, values, [], pre_aggregate=False, strict=strict, exact=exact)


# ---------------------------------------------------------------------------
# densify (grid completion)
# ---------------------------------------------------------------------------
OBSERVED = object()  # grid values: those that occur in the table itself


def densify(df: DataFrame, nest: Sequence[str], grid: dict, fill: dict) -> DataFrame:
    """Add the missing cells of ``observed nest keys x grid values``, fill nulls.

    ``grid`` maps a column to a literal list of values, to ``OBSERVED`` (the
    values that the column has anywhere in ``df``), or to a :class:`Small`
    one-column DataFrame of another table's values.  Rows of ``df`` outside the
    grid are kept; ``fill`` replaces null and NaN in *all* rows, existing ones
    included.  Null keys are ordinary key values (a null Region gets its own
    grid).

    ``df`` is a finished sum, one row per nest and grid cell, so a nest key has
    as many cells as the report has items and years.  They are gathered once
    per nest key, the missing ones are added to the list, and the list is
    opened again: one scan of the facts and one shuffle of the sums.  Only a
    grid over another table's values, of any number, is built with joins.
    """
    if any(isinstance(v, Small) for v in grid.values()):
        out = _densify_joined(df, nest, grid)
    else:
        rest = [f for f in df.schema if f.name not in nest]
        cells = df.groupBy(*nest).agg(F.collect_list(F.struct(*[f.name for f in rest])).alias("__cells"))
        types = {f.name: f.dataType.simpleString() for f in rest}
        # values seen anywhere: a scalar subquery over the same gathered cells, as a column of its own
        cells = cells.withColumns({f"__seen_{g}": cells.select(F.explode(F.col("__cells")[g]).alias(g)).distinct()
                                   .agg(F.collect_list(F.struct(g))).scalar()  # structs keep a null value
                                   for g, given in grid.items() if given is OBSERVED})
        wanted = _grid_cells(grid, types)
        have = F.transform("__cells", lambda c: F.struct(*[c[g].alias(g) for g in grid]))
        missing = F.array_except(wanted, have)
        new = F.transform(missing, lambda g: F.struct(*[
            (g[f.name] if f.name in grid else F.lit(None).cast(f.dataType)).alias(f.name) for f in rest]))
        out = cells.select(*nest, F.inline(F.concat("__cells", new))).select(*df.columns)
    return out.withColumns({c: fill_missing(c, v) for c, v in fill.items()})


def _grid_cells(grid: dict, types: dict) -> Column:
    """All combinations of the grid's values, as an array of structs."""
    def values(name: str, given) -> Column:
        if given is OBSERVED:
            return F.col(f"__seen_{name}")
        return F.transform(F.array(*[F.lit(v) for v in given]).cast(f"array<{types[name]}>"),
                           lambda v: F.struct(v.alias(name)))

    def times(left: Column, have: list[str], right: Column, name: str) -> Column:
        return F.flatten(F.transform(left, lambda a: F.transform(right, lambda b: F.struct(
            *[a[h].alias(h) for h in have], b[name].alias(name)))))

    names = list(grid)
    out = values(names[0], grid[names[0]])
    for k, name in enumerate(names[1:], 1):
        out = times(out, names[:k], values(name, grid[name]), name)
    return out


def _densify_joined(df: DataFrame, nest: Sequence[str], grid: dict) -> DataFrame:
    keys = df.select(*nest).distinct()
    types = dict(df.dtypes)
    for col, values in grid.items():
        if isinstance(values, Small):
            keys = keys.crossJoin(values.side().select(col))
        else:
            arr = F.array(*[F.lit(v) for v in values]).cast(f"array<{types.get(col, 'string')}>")
            keys = keys.withColumn(col, F.explode(arr))
    all_keys = list(nest) + list(grid)
    marks = (keys.withColumn("__obs", F.lit(0))
             .unionByName(df.select(*all_keys).withColumn("__obs", F.lit(1))))
    missing = (marks.groupBy(*all_keys).agg(F.max("__obs").alias("__obs"))
               .filter(F.col("__obs") == 0).drop("__obs"))
    return df.unionByName(missing, allowMissingColumns=True)


# ---------------------------------------------------------------------------
# base period
# ---------------------------------------------------------------------------
def base_year_rows(df: DataFrame, year: str = "Year", *, override: Column | None = None,
                   per: Sequence[str] | None = None, first: Mapping[str | None, int] | None = None,
                   scenario: str = "Scenario") -> DataFrame:
    """Rows of the first year; ``override`` rows are kept as well.

    By default the first year is the minimum over the whole table.  ``per``
    takes the minimum per group instead (e.g. per scenario).

    ``first`` gives the first year of each scenario where the project's manifest
    tells it.  Then nothing is computed from the facts: the base years are plain
    predicates, on the year and, per scenario, on the partition column, one for
    each base year that occurs.  Otherwise the base is a scalar subquery, so no
    fact row is shuffled; per group the minima are one map value, at most one
    entry per group, that every row looks itself up in.
    """
    if first is not None and (not per or list(per) == [scenario]):
        keep = _first_year(first, year, scenario, bool(per))
    elif per:
        key = F.to_json(F.struct(*per), {"ignoreNullFields": "false"})
        mins = df.groupBy(key.alias("__k")).agg(F.min(year).alias("__base"))
        bases = mins.agg(F.map_from_entries(F.collect_list(F.struct("__k", "__base")))).scalar()
        keep = F.col(year) == F.element_at(bases, key)
    else:
        keep = F.col(year) == df.agg(F.min(year)).scalar()
    return df.filter(keep if override is None else keep | override)


def _first_year(first: Mapping[str | None, int], year: str, scenario: str, per: bool) -> Column:
    if not first:
        return F.lit(False)
    if not per:
        return F.col(year) == F.lit(min(first.values()))
    having: dict[int, list[str | None]] = {}
    for name, y in first.items():
        having.setdefault(y, []).append(name)
    out = []
    for y, names in sorted(having.items()):
        texts = sorted(n for n in names if n is not None)
        who = F.col(scenario).isin(texts) if texts else F.lit(False)
        out.append((F.col(year) == F.lit(y)) & ((who | F.col(scenario).isNull()) if None in names else who))
    return reduce(lambda a, b: a | b, out)


# ---------------------------------------------------------------------------
# shares
# ---------------------------------------------------------------------------
def heavy_hitters(df: DataFrame, keys: Sequence[str], most: int = 8192, rows: str = "rows", name: str = "key_hash") \
        -> DataFrame:
    """Hashes of the key groups that hold more than 1 / ``most`` of the rows, with an estimate of their rows.

    A sketch of frequent items: a task keeps a bounded number of counters, which
    are merged over tasks, so no shuffle by key is needed to learn which keys
    are hot.  At most ``most`` rows come out, hot groups all among them, the
    estimates never too low; a proven bound, so the result can be broadcast.
    Nulls are key values like others.  Groups that share a hash count as one.
    """
    tracked = 4 * most
    top = df.select(F.xxhash64(*keys).alias("k")).agg(F.expr(f"approx_top_k(k, {most}, {tracked})").alias("top"))
    return top.select(F.explode("top").alias("t")).select(F.col("t.item").alias(name), F.col("t.count").alias(rows))


def group_share(df: DataFrame, group: Sequence[str], value: str, out: str = "share", *,
                target_rows: int = 1_000_000, exact: bool = True) -> DataFrame:
    """``value / strict_sum(value) over group`` for every row.

    The group totals come from an aggregate (partial aggregation absorbs hot
    groups) and are joined back on ``group`` (null-safe).  Hot groups are found
    by :func:`heavy_hitters` beforehand: one with more than ``target_rows`` rows
    is split into parts of about that many, its rows get a part by their hash
    and their map partition (so equal rows spread as well), and its total is
    repeated once per part.  The list of hot groups is bounded and broadcast to
    both sides, so no exchange brings a hot group to one task.  Any other group
    has less rows than an even share of ``1 / 8192`` of them all.
    Division follows :func:`ieee_div` (0/0 = NaN).
    """
    gkeys = [f"__g_{c}" for c in group]
    hot = heavy_hitters(df, group, rows="__n", name="__hot").filter(F.col("__n") > target_rows) \
        .select("__hot", F.ceil(F.col("__n") / F.lit(target_rows)).cast("long").alias("__parts"))

    def marked(side: DataFrame) -> DataFrame:
        return side.withColumn("__key", F.xxhash64(*group)) \
            .join(F.broadcast(hot), F.col("__key") == F.col("__hot"), "left").drop("__key", "__hot")

    totals = marked(grouped_sum(df, group, [value], exact=exact).withColumnRenamed(value, "__total")) \
        .withColumn("__tpart", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__parts", F.lit(1)) - 1))) \
        .select(*[F.col(c).alias(k) for c, k in zip(group, gkeys)], "__total", "__tpart")
    spread = F.pmod(F.xxhash64(*df.columns) + F.spark_partition_id(), F.col("__parts"))
    left = marked(df).withColumn("__part", F.coalesce(spread, F.lit(0).cast("long"))).drop("__parts")
    cond = [left[c].eqNullSafe(totals[k]) for c, k in zip(group, gkeys)] + [left["__part"] == totals["__tpart"]]
    joined = left.join(totals, reduce(lambda a, b: a & b, cond), "inner")
    return (joined.withColumn(out, ieee_div(F.col(value), F.col("__total")))
            .drop("__total", "__part", "__tpart", *gkeys))


# ---------------------------------------------------------------------------
# scenario versus baseline
# ---------------------------------------------------------------------------
def baseline_shift(df: DataFrame, pairs: Small, keys: Sequence[str], *, scenario: str = "Scenario",
                   value: str = "Value", pair_cols: tuple[str, str] = ("CC_Scenario", "NoCC_Scenario"),
                   percent: bool = True) -> DataFrame:
    """``(value / baseline value - 1) * 100`` for scenarios listed in ``pairs``.

    ``pairs`` maps a scenario to its baseline scenario.  Rows of scenarios
    that are not listed are dropped; a missing baseline gives null.
    ``keys`` are the other matching columns (null-safe).
    """
    cc, base = pair_cols
    p = pairs.df.select(F.col(cc).alias("__cc"), F.col(base).alias("__base"))
    if pairs.bounded:
        p = F.broadcast(p)
    num = df.join(p, df[scenario] == p["__cc"], "inner").drop("__cc")
    # only baseline scenarios can be a denominator
    den = (df.join(p.select("__base"), df[scenario] == F.col("__base"), "left_semi")
           .select(*[F.col(k).alias(f"__d_{k}") for k in keys],
                   F.col(scenario).alias("__d_base"), F.col(value).alias("__den")))
    cond = [num["__base"].eqNullSafe(den["__d_base"])] + [num[k].eqNullSafe(den[f"__d_{k}"]) for k in keys]
    joined = num.join(den, reduce(lambda a, b: a & b, cond), "left")
    ratio = ieee_div(F.col(value), F.col("__den")) - F.lit(1)
    shifted = ratio * F.lit(100) if percent else ratio
    return (joined.withColumn(value, shifted)
            .drop("__den", "__base", "__d_base", *[f"__d_{k}" for k in keys]))


# ---------------------------------------------------------------------------
# grids and templates
# ---------------------------------------------------------------------------
def attach_grid(df: DataFrame, values: Small) -> DataFrame:
    """Repeat every row of ``df`` once per row of ``values`` (the report's own grid; broadcast only when small)."""
    return df.crossJoin(values.side())


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns missing from an input are null.

    Inputs are combined pairwise (a balanced tree, flattened by the optimizer)
    so that building a union of many branches stays cheap.
    """
    parts = list(dfs)
    while len(parts) > 1:
        nxt = [parts[i].unionByName(parts[i + 1], allowMissingColumns=True) for i in range(0, len(parts) - 1, 2)]
        if len(parts) % 2:
            nxt.append(parts[-1])
        parts = nxt
    return parts[0]

