"""Fused evaluation of counting checks (validation rules and constraints).

A check counts violations of one kind over one or two frames. A frame is a
table of a layer, e.g. ``("silver", "lineitem")``. Instead of one Spark job
per check, the runner reads every table once and expands each row by the key
sets that the checks ask for, as grouping sets do, but into one common form:

* ``(space, k1, k2)`` with counts ``n1`` (child rows), ``n2`` (parent rows) and an
  ``amount``. A space is one key set of one check: child and parent rows of an
  orphan check meet in its space by their key, without a join;
* the row-local checks of a table are the bits of one number, which is a key set
  of its own: its groups are the few combinations of violations that occur;
* all tables' rows go through one union and one exchange. Partial aggregation
  collapses hot keys before it, so a hot key costs one row per task;
* where silver is a filter of bronze, both come from the same scan;
* "child date before parent date" and revenue per parent date take (key, day,
  count) rows of both sides and a running count per key: exact, and no pairs are
  formed;
* uniqueness of a dense integer key (declared so) is counted on bitmaps, one row
  for each range of 32,768 keys instead of one for each key.

Every result is a row ``(id, n, amount)`` that one small ``groupBy`` finishes.
Everything is one lazy plan: one job when it is collected.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import REVENUE_TYPE
from .contracts import contracts_for
from .refine import accept_sql, silver_projection_sql

Frame = tuple[str, str]


@dataclass(frozen=True)
class Check:
    """One counting check.

    kind:
      ``where``       rows of ``frame`` where ``condition`` is TRUE;
      ``rows``        row count of ``frame`` times ``sign`` (summed per id);
      ``revenue``     SUM(net revenue) of ``frame`` (``condition`` names the
                      column, or ``None`` for line revenue) times ``sign``;
      ``duplicates``  COUNT(*) - COUNT(DISTINCT key) (rows with a NULL key part
                      count as violations, as COUNT DISTINCT skips them);
      ``orphans``     rows of ``frame`` whose ``key`` has no match in
                      ``parent``/``parent_key`` (NULL keys count unless
                      ``null_ok``);
      ``before``      pairs (row of ``frame``, row of ``parent``) with equal keys
                      where the child's ``attrs[0]`` is strictly before the
                      parent's ``parent_attrs[0]``, counted without forming
                      pairs (a running count per key);
      ``dated``       over the dates ``parent_attrs[0]`` of the parents with child
                      rows, and the net revenue of these: ``condition`` is
                      ``revenue`` (its sum), ``dates`` (their number) or a
                      predicate over ``revenue`` (dates where it holds);
      ``contribution`` distinct parents (key and ``parent_attrs``) with child rows
                      whose net revenue makes ``condition`` over ``revenue`` hold.
    finish: how the summed parts give the result:
      ``sum``, ``abs``, ``over_tolerance`` (|amount| > tolerance -> 1 else 0),
      ``is_empty`` (n = 0 -> 1 else 0).
    """

    id: int
    labels: tuple[str, ...]
    kind: str
    frame: Frame
    condition: str | None = None
    key: tuple[str, ...] = ()
    parent: Frame | None = None
    parent_key: tuple[str, ...] = ()
    attrs: tuple[str, ...] = ()
    parent_attrs: tuple[str, ...] = ()
    null_ok: bool = False
    sign: int = 1
    dense: bool = False  # ``duplicates``: the key is one integer, numbered through
    finish: str = "sum"
    tolerance: str = "0.01"


def frame_df(layers, frame: Frame) -> DataFrame | None:
    layer, table = frame
    if layer == "source":
        return layers.source(table)
    if layer == "bronze":
        return layers.bronze(table)
    if layer == "silver":
        return layers.silver(table)
    if layer == "quarantine":
        return layers.quarantine(table)
    if layer == "gold":
        return layers.gold(table)
    raise ValueError(frame)


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _long(df: DataFrame, items: list[tuple[Check, str, str]], width: int) -> DataFrame:
    """Unpivot one-row ``df`` into (id, labels..., finish, tol, n, amount).
    ``items``: (check, n expression, amount expression) over df's columns."""
    def row(c: Check, n: str, a: str) -> str:
        labels = list(c.labels) + [""] * (width - len(c.labels))
        return ", ".join([str(c.id), *map(_q, labels), _q(c.finish), _q(c.tolerance),
                          f"CAST({n} AS BIGINT)", f"CAST({a} AS {REVENUE_TYPE})"])
    cols = ["id", *[f"label{i}" for i in range(width)], "finish", "tolerance", "n", "amount"]
    body = ", ".join(row(*it) for it in items)
    return df.selectExpr(f"stack({len(items)}, {body}) AS ({', '.join(cols)})")


LINE_REVENUE = "l_extendedprice * (1 - l_discount)"


def _any_null(cols) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


# ---- one scan per table: rows (space, k1, k2, n1, n2, amount) ----------------------
@dataclass
class Entry:
    """One key set of a scan: which rows of it (a frame's) count in a space, by
    which key columns, on which side, with which amount."""

    space: int
    frame: Frame
    key: tuple[str, ...]
    side: int
    amount: str | None = None


class Scan:
    """The checks on one physical table. ``frames`` share it: where silver is a
    filter of bronze, conditions and keys of both are taken from the same row."""

    def __init__(self, layers, frames: list[Frame], lazy: bool):
        self.layers, self.frames, self.lazy = layers, frames, lazy
        self.local: list[Check] = []
        self.entries: list[Entry] = []
        self.mask_space: int | None = None

    def rows(self, text_keys: bool) -> DataFrame:
        """The expanded rows."""
        typed = [fr for fr in self.frames if fr[0] == "silver"] if self.lazy else []
        raw = [fr for fr in self.frames if fr not in typed]
        base = frame_df(self.layers, raw[0] if raw or not typed else ("bronze", typed[0][1]))
        # what reads raw columns first, under names of its own; then silver's columns, and what reads those
        first, second, bits, entries = [], [], [], []

        def place(frame: Frame, expr: str, name: str) -> None:
            (second if frame in typed else first).append(f"{expr} AS {name}")

        for i, c in enumerate(self.local):
            if c.kind == "where":
                place(c.frame, f"coalesce({c.condition}, false)", f"_c{i}")
            held = "true" if c.kind != "where" else f"_c{i}"
            bits.append(f"IF({held}{' AND _ok' if c.frame in typed else ''}, {1 << i}L, 0L)")
        money = {(c.frame, c.condition or LINE_REVENUE) for c in self.local if c.kind == "revenue"}
        if len(money) > 1:
            raise ValueError("one revenue per table")
        wanted = [(e.frame, e.amount) for e in self.entries if e.amount]
        amounts = {}
        for frame, expr in [*money, *wanted]:
            if (frame, expr) not in amounts:
                amounts[frame, expr] = f"_a{len(amounts)}"
                place(frame, f"CAST({expr} AS {REVENUE_TYPE})", amounts[frame, expr])
        kind = "STRING" if text_keys else "BIGINT"
        null_key, null_amount = f"CAST(NULL AS {kind})", f"CAST(NULL AS {REVENUE_TYPE})"
        for e in self.entries:
            keys = []
            for k in e.key:
                name = f"_k{len(first) + len(second)}"
                place(e.frame, f"CAST({k} AS {kind})", name)
                keys.append(name)
            keys += [null_key] * (2 - len(keys))
            entries.append((e.frame in typed, [f"{e.space}", *keys, f"{int(e.side == 1)}L", f"{int(e.side == 2)}L",
                                               amounts[e.frame, e.amount] if e.amount else null_amount]))
        if self.local:
            amount = next((f"IF(_ok, {amounts[f, x]}, {null_amount})" if f in typed else amounts[f, x] for f, x in money), null_amount)
            entries.append((False, [f"{self.mask_space}", f"CAST({' + '.join(bits)} AS {kind})", null_key, "1L", "0L", amount]))
        if typed:
            contract, names = contracts_for(self.layers.config)[typed[0][1]], [x.rsplit(" AS ", 1)[1] for x in first]
            ok = f"coalesce({accept_sql(contract, base)}, false) AS _ok"
            base = base.selectExpr(*first, ok, *silver_projection_sql(base.columns, contract))
            base = base.selectExpr("_ok", *names, *second)
        else:
            base = base.selectExpr(*first) if first else base.selectExpr("1 AS _one")
        # a set without a space leaves the row out
        wide = [f"{f'IF(_ok, {x}, NULL)' if ok_only and not j else x} AS _e{i}_{j}" for i, (ok_only, xs) in enumerate(entries) for j, x in enumerate(xs)]
        sets = ", ".join(f"({', '.join(f'_e{i}_{j}' for j in range(6))}) AS `{i}`" for i in range(len(entries)))
        return base.sparkSession.sql(f"SELECT space, k1, k2, n1, n2, amount FROM {{rows}} "
                                     f"UNPIVOT INCLUDE NULLS ((space, k1, k2, n1, n2, amount) FOR which IN ({sets})) "
                                     "WHERE space IS NOT NULL", rows=base.selectExpr(*wide))


def _ints(layers, frame: Frame, key: tuple[str, ...]) -> bool:
    types = dict(frame_df(layers, frame).dtypes)
    return all(types[k] in ("bigint", "int", "smallint", "tinyint") for k in key)


def _met(layers, checks: list[Check], width: int, lazy: bool, canon) -> DataFrame:
    """The checks that one expansion and one exchange answer."""
    scans: dict[tuple, Scan] = {}

    def scan(frame: Frame) -> Scan:
        frame = canon(frame)
        key = ("lazy", frame[1]) if lazy and frame[0] in ("bronze", "silver") else frame
        found = scans.setdefault(key, Scan(layers, [], lazy))
        if frame not in found.frames:
            found.frames.append(frame)
        return found

    spaces = 0
    items: list[tuple[Check, str, str]] = []
    reverse: dict[tuple, int] = {}
    extra: list[DataFrame] = []
    keyed: list[tuple[Frame, tuple[str, ...]]] = []
    for c in checks:
        if c.kind in ("where", "rows", "revenue"):
            found = scan(c.frame)
            if found.mask_space is None:
                spaces += 1
                found.mask_space = spaces
            here, bit = f"space = {found.mask_space}", len(found.local)
            if bit > 62:
                raise ValueError("more than 62 row-local checks on a table")
            found.local.append(replace(c, frame=canon(c.frame)))
            if c.kind == "revenue":
                items.append((c, "0", f"IF({here}, {c.sign} * amount, NULL)"))
            else:
                items.append((c, f"IF({here}, {c.sign} * n * ((mask >> {bit}) & 1), 0)", "NULL"))
            continue
        if len(c.key) > 2:
            raise ValueError("keys of at most two columns")
        keyed.append((canon(c.frame), c.key))
        if c.kind == "orphans" and not c.null_ok and (canon(c.parent), c.parent_key, canon(c.frame), c.key) in reverse:
            # the reverse of a check that has a space already
            items.append((c, f"IF(space = {reverse[canon(c.parent), c.parent_key, canon(c.frame), c.key]}, {c.sign} * lone2, 0)", "NULL"))
            continue
        spaces += 1
        revenue = LINE_REVENUE if c.kind == "contribution" else None
        scan(c.frame).entries.append(Entry(spaces, canon(c.frame), c.key, 1, revenue))
        if c.kind == "duplicates":
            items.append((c, f"IF(space = {spaces}, {c.sign} * repeats, 0)", "NULL"))
        elif c.kind == "orphans":
            keyed.append((canon(c.parent), c.parent_key))
            reverse[canon(c.frame), c.key, canon(c.parent), c.parent_key] = spaces
            scan(c.parent).entries.append(Entry(spaces, canon(c.parent), c.parent_key, 2))
            items.append((c, f"IF(space = {spaces}, {c.sign} * {'lone1_known' if c.null_ok else 'lone1'}, 0)", "NULL"))
        else:  # contribution: a parent with the same payload counts once
            keyed.append((canon(c.parent), c.parent_key))
            extra.append(frame_df(layers, c.parent).select(*c.parent_key, *c.parent_attrs).distinct()
                         .selectExpr(f"{spaces} AS space", *[f"{k} AS k{i + 1}" for i, k in enumerate(c.parent_key)],
                                     *["NULL AS k2"][len(c.parent_key) - 1:], "0L AS n1", "1L AS n2", f"CAST(NULL AS {REVENUE_TYPE}) AS amount"))
            items.append((c, f"IF(space = {spaces}, {c.sign} * poor, 0)", "NULL"))
            if c.condition != "revenue <= 0":
                raise ValueError("contributions are tested for revenue <= 0")
    text_keys = not all(_ints(layers, fr, key) for fr, key in keyed)
    key_type = "string" if text_keys else "bigint"
    rows = [s.rows(text_keys) for s in scans.values()]
    rows += [x.selectExpr("space", f"CAST(k1 AS {key_type}) AS k1", f"CAST(k2 AS {key_type}) AS k2", "n1", "n2", "amount") for x in extra]
    groups = union_all(rows).groupBy("space", "k1", "k2").agg(F.sum("n1").alias("n1"), F.sum("n2").alias("n2"), F.sum("amount").alias("amount"))
    masks = sorted(s.mask_space for s in scans.values() if s.mask_space is not None)
    two = sorted({e.space for s in scans.values() for e in s.entries if len(e.key) == 2})
    unknown = F.col("k1").isNull() | (F.col("space").isin(two) & F.col("k2").isNull() if two else F.lit(False))
    none = F.lit(0).cast("bigint")
    total = groups.groupBy("space", F.when(F.col("space").isin(masks), F.col("k1").cast("bigint")).alias("mask")).agg(
        F.sum("n1").alias("n"), F.sum("amount").alias("amount"),
        F.sum(F.when(unknown | (F.col("n2") == 0), F.col("n1")).otherwise(none)).alias("lone1"),
        F.sum(F.when(~unknown & (F.col("n2") == 0), F.col("n1")).otherwise(none)).alias("lone1_known"),
        F.sum(F.when(unknown | (F.col("n1") == 0), F.col("n2")).otherwise(none)).alias("lone2"),
        F.sum(F.when(unknown, F.col("n1")).otherwise(F.greatest(F.col("n1") - 1, none))).alias("repeats"),
        F.sum(F.when(~unknown & (F.col("n1") > 0) & (F.col("amount") <= 0), F.col("n2")).otherwise(none)).alias("poor"))
    return _long(total, items, width)


# ---- dense integer keys ----------------------------------------------------------
def distinct_integers(df: DataFrame, column: str) -> DataFrame:
    """One row: ``rows``, ``nulls`` and the exact ``distinct`` values of an integer
    column, on bitmaps. What is shuffled is one bitmap (4 kB) for each range of
    32,768 values, whatever the number of rows and values in it."""
    key = F.col(column).cast("bigint")
    ranges = (df.select(key.alias("_k")).groupBy(F.bitmap_bucket_number("_k").alias("_range"))
              .agg(F.count(F.lit(1)).alias("_n"), F.bitmap_construct_agg(F.bitmap_bit_position("_k")).alias("_bits")))
    null = F.col("_range").isNull()
    zero = F.lit(0).cast("bigint")
    return ranges.agg(F.coalesce(F.sum("_n"), zero).alias("rows"),
                      F.coalesce(F.sum(F.when(null, F.col("_n"))), zero).alias("nulls"),
                      F.coalesce(F.sum(F.when(~null, F.bitmap_count("_bits"))), zero).alias("distinct"))


def _dense_duplicates(df: DataFrame, c: Check, width: int) -> DataFrame:
    """COUNT(*) - COUNT(DISTINCT key) of one integer column; a null key counts as a violation."""
    return _long(distinct_integers(df, c.key[0]), [(c, f"{c.sign} * (rows - distinct)", "NULL")], width)


def _ordinal(col: str, df: DataFrame) -> Column:
    """An integer that orders like ``col`` (days for dates)."""
    t = dict(df.dtypes)[col]
    return F.unix_date(F.col(col).cast("date")) if t in ("date", "timestamp", "timestamp_ntz") else F.col(col)


def _dated(child: DataFrame, parent: DataFrame, c: Check) -> DataFrame:
    """Per date of the parents (null too): ``pairs`` (child rows strictly before
    it with the key of a parent row), ``revenue`` of the child rows of its
    parents, ``held`` (whether there are any). No pairs are formed: both sides
    are first reduced to (key, date, count) - partial aggregation collapses hot
    keys - and united; per key a RANGE window sums the child counts of strictly
    smaller dates, and every parent group takes its count times that sum. A key
    holds at most one row per date on each side, never one row per record."""
    (ck,), (pk,) = c.key, c.parent_key
    (ca,), (pa,) = c.attrs, c.parent_attrs
    zero = F.lit(0).cast("bigint")
    revenue = F.expr(f"CAST({LINE_REVENUE} AS {REVENUE_TYPE})") if c.kind == "dated" else F.lit(None).cast(REVENUE_TYPE)
    cg = (child.where(F.col(ck).isNotNull()).select(F.col(ck).alias("_k"), _ordinal(ca, child).alias("_v"), revenue.alias("_r"))
          .groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_cn"), F.sum("_r").alias("_r"))
          .select("_k", "_v", "_cn", "_r", zero.alias("_pn")))
    pg = (parent.where(F.col(pk).isNotNull())
          .groupBy(F.col(pk).alias("_k"), _ordinal(pa, parent).alias("_v")).agg(F.count(F.lit(1)).alias("_pn"))
          .select("_k", "_v", zero.alias("_cn"), F.lit(None).cast(REVENUE_TYPE).alias("_r"), "_pn"))
    known = F.when(F.col("_v").isNotNull(), F.col("_cn")).otherwise(zero)
    earlier = Window.partitionBy("_k").orderBy("_v").rangeBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy("_k")
    rows = cg.unionByName(pg).select(
        "_v", "_pn", F.when(F.col("_v").isNotNull(), F.coalesce(F.sum(known).over(earlier), zero)).otherwise(zero).alias("_before"),
        F.sum("_r").over(all_of).alias("_kr"), F.sum("_cn").over(all_of).alias("_kn")).where("_pn > 0")
    return rows.groupBy("_v").agg(
        F.sum(F.col("_pn") * F.col("_before")).alias("pairs"),
        F.sum(F.when(F.col("_kn") > 0, F.col("_kr") * F.col("_pn").cast("decimal(18,0)"))).cast(REVENUE_TYPE).alias("revenue"),
        F.max(F.col("_kn") > 0).alias("held"))


def _dated_parts(child: DataFrame, parent: DataFrame, checks: list[Check], width: int) -> DataFrame:
    """All checks on the same children, parents and dates: one scan of each side."""
    widest = next((c for c in checks if c.kind == "dated"), checks[0])
    aggs, items = [], []
    for i, c in enumerate(checks):
        if c.kind == "before":
            expr = "sum(pairs)"
        elif c.condition == "revenue":
            expr = "sum(IF(held, revenue, NULL))"
        else:
            expr = "count_if(held)" if c.condition == "dates" else f"count_if(held AND coalesce({c.condition}, false))"
        aggs.append(f"coalesce({expr}, 0) AS _v{i}")
        items.append((c, "0", f"{c.sign} * _v{i}") if c.condition == "revenue" else (c, f"{c.sign} * _v{i}", "NULL"))
    return _long(_dated(child, parent, widest).selectExpr(*aggs), items, width)


def _pairs_before(child: DataFrame, parent: DataFrame, c: Check, width: int) -> DataFrame:
    return _dated_parts(child, parent, [c], width)


def _finish(parts: DataFrame, width: int) -> DataFrame:
    labels = [f"label{i}" for i in range(width)]
    g = parts.groupBy("id", *labels, "finish", "tolerance").agg(
        F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    n, amount = F.coalesce(F.col("n"), F.lit(0)), F.coalesce(F.col("amount"), F.lit(0))
    value = (F.when(F.col("finish") == "abs", F.abs(n))
             .when(F.col("finish") == "over_tolerance",
                   F.when(F.abs(amount) > F.col("tolerance").cast("decimal(38,4)"), 1).otherwise(0))
             .when(F.col("finish") == "is_empty", F.when(n == 0, 1).otherwise(0))
             .otherwise(n))
    return g.select("id", *labels, value.cast("bigint").alias("violations"))


def evaluate(layers, checks: list[Check], width: int | None = None) -> DataFrame:
    """All checks as one lazy plan: (id, label0.., violations), one row per id."""
    width = width or max(len(c.labels) for c in checks)
    # Lazy layers whose silver is the contract's filter of bronze: one scan serves both, and without
    # a stamp bronze *is* the source plan.
    lazy = getattr(layers, "filters_bronze", False)
    same_source = getattr(layers, "copies_source", False) and not layers.stamp

    def canon(fr: Frame) -> Frame:
        return ("bronze", fr[1]) if same_source and fr[0] == "source" else fr

    parts: list[DataFrame] = []
    met: list[Check] = []
    dated: dict[tuple, list[Check]] = defaultdict(list)
    for c in checks:
        if c.kind in ("before", "dated"):
            dated[c.frame, c.parent, c.key, c.parent_key, c.parent_attrs].append(c)
        elif c.kind == "duplicates" and c.dense and len(c.key) == 1 and _ints(layers, canon(c.frame), c.key):
            parts.append(_dense_duplicates(frame_df(layers, canon(c.frame)), c, width))
        elif c.kind in ("where", "rows", "revenue", "duplicates", "orphans", "contribution"):
            if c.kind != "rows" or frame_df(layers, c.frame) is not None:  # an absent table (e.g. no quarantine) contributes 0
                met.append(c)
        else:
            raise ValueError(c.kind)
    if met:
        parts.append(_met(layers, met, width, lazy, canon))
    for (frame, parent, *_), cs in dated.items():
        parts.append(_dated_parts(frame_df(layers, frame), frame_df(layers, parent), cs, width))
    parts.append(_long(layers.spark.range(1), [(c, "0", "NULL") for c in checks], width))  # every check has a row
    return _finish(union_all(parts), width)


def union_all(parts: list[DataFrame]) -> DataFrame:
    """One n-ary UNION ALL (analysed once), not a chain of pairwise unions.
    All parts come from ``_long`` and share one column order."""
    if len(parts) == 1:
        return parts[0]
    names = {f"p{i}": p for i, p in enumerate(parts)}
    sql = " UNION ALL ".join(f"SELECT * FROM {{{k}}}" for k in names)
    return parts[0].sparkSession.sql(sql, **names)
