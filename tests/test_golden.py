
from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from paths import SF_MID, SF_SMALL

GOLDEN = {
    SF_SMALL: dict(rows=1084, total=Decimal("301270840.1572"), alert=139, q3=139, qoq=7.54, active=4, active_latest=118),
    SF_MID: dict(rows=2399, total=Decimal("3024008727.8907"), alert=76, q3=76, qoq=1.45, active=8, active_latest=1178),
}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_golden_values(spark, sf):
    q, g = E.queries(), GOLDEN[sf]
    rm = q["revenue_metrics"](spark, sf)
    agg = rm.agg(F.count(F.lit(1)).alias("n"), F.sum("net_revenue").alias("total")).collect()[0]
    assert agg.n == g["rows"] and agg.total == g["total"]
    assert q["revenue_drop_alert"](spark, sf).count() == g["alert"]
    assert q["q3_wow_drop"](spark, sf).count() == g["q3"]
    q1 = q["q1_quarter_revenue"](spark, sf).orderBy("quarter_start").collect()
    assert q1[0].prev_quarter_revenue is None and q1[1].revenue_qoq_pct == g["qoq"]
    assert q["q2_active_customers"](spark, sf).collect()[0][0] == g["active"]
    latest = q["customer_activity_latest"](spark, sf).where("is_active_trailing_12m").count()
    assert latest == g["active_latest"]
