"""Fallback prices come from all usable lines, not from one submission and channel."""

from collections import defaultdict

from pyspark.sql import functions as F

from verification import pricing_queries as queries
from verification.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_newest_prices_against_brute_force(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(queries, "lines", lambda i, make=queries.lines: seen.setdefault("lines", make(i)))
    found = [r.pm_omogeneo for r in QUERIES["newest_price_fallback"].run(spark, FOLDER).collect()]
    rows = seen["lines"].withColumn("usable", queries._flag() == F.lit(0)).collect()
    sums = defaultdict(lambda: [0.0, 0.0])
    for r in rows:
        if r.usable:
            own = sums[r.sellout_dm, r._dest_key, r.billing_currency, r._year, r._semester]
            own[0] += float(r.fx_transaction_lc or 0)
            own[1] += float(r.quantity or 0)
    priced = {k[:3] for k, (a, n) in sums.items() if None not in k[:3] and n and a / n > 0}
    want = sum((r.sellout_dm, r._dest_key, r.billing_currency) in priced for r in rows)
    have = sum(p is not None for p in found)
    assert len(found) == len(rows) and have == want > 0
