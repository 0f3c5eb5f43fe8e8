"""The version lookup against a plain loop."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from layerloom.operators.sales import with_customer_key_as_of

DAY = date(2024, 1, 1)


def _day(n):
    return None if n is None else DAY + timedelta(days=n)


def _brute(rows, versions, first_holds_before):
    out = []
    for i, key, at in rows:
        mine = sorted((v for v in versions if v[0] == key and key is not None), key=lambda v: v[2])
        found = None
        for n, (_, sk, begin, end) in enumerate([v for v in mine if v[3] is None or v[2] < v[3]]):
            before = n == 0 and first_holds_before
            if (before or (at is not None and at >= begin)) and (end is None or (at is not None and at < end)):
                found = sk
        out.append((i, found))
    return sorted(out)


@pytest.mark.parametrize("first_holds_before", [True, False])
def test_lookup_matches_a_loop(spark, first_holds_before):
    rng = random.Random(4)
    versions, sk = [], 0
    for key in range(1, 30):
        # Key 1 has thousands of versions, key 2 none, others have gaps and empty versions.
        edges = sorted(rng.sample(range(3000), 2000 if key == 1 else 0 if key == 2 else rng.randint(1, 6)))
        for a, b in zip(edges, [*edges[1:], None]):
            sk += 1
            gap = key % 3 == 0 and b is not None
            versions.append((key, sk, a, (rng.randint(a, b) if gap else b)))
    rows = [(i, rng.choice([1, 1, 1, None, *range(1, 32)]), rng.choice([None, *range(-5, 3100)])) for i in range(4000)]
    v = spark.createDataFrame([(k, s, _day(a), _day(b)) for k, s, a, b in versions], "CustomerID int, CustomerSK long, _StartDate date, _EndDate date")
    r = spark.createDataFrame([(i, k, _day(a)) for i, k, a in rows], "id int, CustomerID int, OrderDate date")
    found = with_customer_key_as_of(r.repartition(3), v, first_holds_before=first_holds_before)
    assert found.columns == ["id", "CustomerID", "OrderDate", "CustomerSK"]
    assert sorted((x.id, x.CustomerSK) for x in found.collect()) == _brute(rows, versions, first_holds_before)


def test_no_pairs_of_rows_and_versions(spark, monkeypatch):
    """The rows that are sorted are those given, however many versions a customer has."""
    from layerloom.operators import asof

    written = []
    keep = asof.staged
    monkeypatch.setattr(asof, "staged", lambda df, label: written.append(keep(df, label)) or written[-1])
    days = spark.range(10_000)
    begin, end = (F.expr(f"date_add(date'2000-01-01', cast(id + {n} as int))") for n in (0, 1))
    versions = days.select(F.lit(1).alias("CustomerID"), F.col("id").alias("CustomerSK"), begin.alias("_StartDate"), end.alias("_EndDate"))
    rows = days.select("id", F.lit(1).alias("CustomerID"), begin.alias("OrderDate"))
    found = with_customer_key_as_of(rows, versions)
    assert found.where("CustomerSK is null or CustomerSK <> id").count() == 0
    assert [w.count() for w in written] == [20_000, 10_000]
