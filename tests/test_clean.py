"""C1–C3, P4, P6, W8 on micro tables."""

import datetime as dt
from decimal import Decimal

from weekcast.operators import clean


def test_missing_dates_then_fill_leaves_no_gap(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, d), "X", Decimal("1.0000")) for d in (1, 2, 5)], "fecha date, familia string, base_imponible decimal(18,4)"
    )
    missing = clean.missing_dates(df)
    assert sorted(r.fecha.day for r in missing.collect()) == [3, 4]
    filled = clean.fill_closed_days(df, missing)
    assert clean.missing_dates(filled).count() == 0
    closed = filled.where("is_closed = 1").collect()
    assert {r.familia for r in closed} == {"cerrado"} and all(r.base_imponible == 0 for r in closed)


def _impute_fixture(spark):
    rows = [(dt.date(2023, 10, 5), "F", Decimal("10.0000"))]
    rows += [(dt.date(2023, 12, d), "F", Decimal("20.0000")) for d in (1, 2, 3)]
    rows += [(dt.date(2023, 11, 7), "F", None)]
    return spark.createDataFrame(rows, "fecha date, familia string, base_imponible decimal(18,4)")


def test_imputation_methods(spark):
    df = _impute_fixture(spark)
    kw = dict(target_month="2023-11-01", neighbour_months=("2023-10-01", "2023-12-01"), cols=("base_imponible",))
    nov = lambda out: out.where("month(fecha) = 11").first()
    m = nov(clean.impute_family_month(df, method="mean_of_means", **kw))
    p = nov(clean.impute_family_month(df, method="pooled", **kw))
    s = nov(clean.impute_family_month(df, method="sequential", **kw))
    assert float(m.base_imponible) == 15.0 and m.is_imputed == 1
    assert float(p.base_imponible) == 17.5
    assert float(s.base_imponible) == 10.0


def test_year_fallback_counts_imputed_cells(spark):
    rows = [(dt.date(2023, 3, 1), "F", Decimal("30.0000")), (dt.date(2023, 11, 7), "F", None)]
    df = spark.createDataFrame(rows, "fecha date, familia string, base_imponible decimal(18,4)")
    out = clean.impute_family_month(df, "2023-11-01", ("2023-10-01", "2023-12-01"), cols=("base_imponible",))
    assert float(out.where("month(fecha) = 11").first().base_imponible) == 30.0


def test_deny_list_drops_nulls(spark):
    df = spark.createDataFrame([("A",), ("7",), (None,)], "familia string")
    assert [r.familia for r in clean.deny_list(df, ["7", None]).collect()] == ["A"]


def test_first_by_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, "z")], "k int, o int, v string")
    got = {r.k: r.v for r in clean.first_by_order(df, ["k"], ["o"]).collect()}
    assert got == {1: "b", 2: "z"}


def test_open_bound_drops_rows_without_a_date(spark):
    import datetime

    df = spark.createDataFrame([(datetime.date(2024, 1, 1),), (None,)], "fecha date")
    assert clean.filter_date_range(df).count() == 1


def test_epoch_outlier_becomes_null(spark):
    from weekcast.functions import dates

    df = spark.createDataFrame([(str(1_700_000_000 + i),) for i in range(5)] + [("1700000000000000000",)], "t string")
    got = [r.t for r in dates.coerce_epoch(df, ["t"]).collect()]
    assert sum(x is None for x in got) == 1 and got[0].year == 2023
