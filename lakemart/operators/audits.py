"""Per-table layer audits: balance, duplicate keys, broken links, invalid rows.

Link audits join pre-aggregated key counts, never raw rows against raw rows,
so a hot key costs one row per task. Multiplicities of the reference's
LEFT JOIN ... IS NULL formulation are kept exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .contracts import CONTRACTS


def duplicate_keys(silver: DataFrame, table: str) -> DataFrame:
    """Keys that occur more than once: key columns and ``cnt``."""
    key = CONTRACTS[table].key
    return silver.groupBy(*key).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def broken_links(child: DataFrame, key: tuple[str, ...], parent: DataFrame, parent_key: tuple[str, ...],
                 name: str) -> DataFrame:
    """COUNT of child rows whose key finds no parent row (NULL keys included),
    as a one-row DataFrame with column ``name``."""
    ck = [f"_c{i}" for i in range(len(key))]
    pk = [f"_p{i}" for i in range(len(parent_key))]
    c = child.select(*[F.col(a).alias(b) for a, b in zip(key, ck)]).groupBy(*ck).agg(F.count(F.lit(1)).alias("_n"))
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(parent_key, pk)]).distinct()
    on = [F.col(a) == F.col(b) for a, b in zip(ck, pk)]
    cond = on[0]
    for x in on[1:]:
        cond = cond & x
    lost = c.join(p, cond, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name))


def broken_links_partsupp(partsupp: DataFrame, part: DataFrame, supplier: DataFrame) -> DataFrame:
    """Both partsupp links in one row. Matches two chained LEFT JOINs exactly:
    a row missing one parent is counted once per matching row of the other."""
    ps = partsupp.groupBy("ps_partkey", "ps_suppkey").agg(F.count(F.lit(1)).alias("_n"))
    pc = part.groupBy(F.col("p_partkey").alias("_pk")).agg(F.count(F.lit(1)).alias("_pn"))
    sc = supplier.groupBy(F.col("s_suppkey").alias("_sk")).agg(F.count(F.lit(1)).alias("_sn"))
    j = (ps.join(pc, F.col("ps_partkey") == F.col("_pk"), "left")
         .join(sc, F.col("ps_suppkey") == F.col("_sk"), "left"))
    return j.agg(
        F.sum(F.when(F.col("_pn").isNull(), F.col("_n") * F.coalesce(F.col("_sn"), F.lit(1))).otherwise(0))
        .cast("bigint").alias("broken_part_links"),
        F.sum(F.when(F.col("_sn").isNull(), F.col("_n") * F.coalesce(F.col("_pn"), F.lit(1))).otherwise(0))
        .cast("bigint").alias("broken_supplier_links"),
    )


def invalid_parts(part: DataFrame) -> DataFrame:
    return part.where((F.col("p_retailprice") < 0) | (F.col("p_size") < 0)).agg(
        F.count(F.lit(1)).alias("invalid_records"))


def invalid_rates(lineitem: DataFrame, discount_bounds, tax_bounds) -> DataFrame:
    (dl, dh), (tl, th) = discount_bounds, tax_bounds
    d, t = F.col("l_discount"), F.col("l_tax")
    return lineitem.agg(
        F.sum(F.when((d < F.lit(dl)) | (d > F.lit(dh)), 1).otherwise(0)).cast("bigint").alias("invalid_discounts"),
        F.sum(F.when((t < F.lit(tl)) | (t > F.lit(th)), 1).otherwise(0)).cast("bigint").alias("invalid_taxes"),
    )
