import datetime as dt
from decimal import Decimal

from tallyloom.operators.aging import invoice_aging, receivable_aging

AS_OF = dt.date(2024, 6, 30)


def test_receivable_aging_bounds(spark):
    data = []
    for i, late in enumerate([0, 1, 2, 30, 31, 90, 91, 180, 181, -5]):
        data.append((f"T{i}", "C1", Decimal("10"), Decimal("1"), AS_OF - dt.timedelta(days=late), "OP", late))
    data += [
        ("T90", "C1", Decimal("10"), None, AS_OF - dt.timedelta(days=40), "CL", 40),          # closed, unpaid: dropped
        ("T91", "C1", Decimal("10"), Decimal("0"), AS_OF - dt.timedelta(days=40), "CL", 40),  # closed, zero: dropped
        ("T92", "C1", Decimal("10"), Decimal("5"), AS_OF - dt.timedelta(days=400), "CL", 400),  # closed, paid: kept
        ("NC1", "C1", Decimal("10"), Decimal("5"), AS_OF, "OP", 0),                            # NC number: dropped
        ("T93", None, Decimal("10"), Decimal("5"), AS_OF, "OP", 0),                            # no concept: dropped
    ]
    df = spark.createDataFrame(data, "trx string, concept string, agreed decimal(18,2), paid decimal(18,2), "
                                     "due_date date, status string, late long")
    out = {r.trx: (r.days_late, r.aging_bucket) for r in receivable_aging(
        df, AS_OF, number_col="trx", concept_col="concept").collect()}
    assert set(out) == {f"T{i}" for i in range(10)} | {"T92"}
    assert out["T0"] == (0, "AL DÍA")
    assert out["T1"] == (1, "AL DÍA")  # exactly one day late is still up to date
    assert out["T2"] == (2, "MENOS DE 30 DÍAS EN MORA")
    assert out["T3"] == (30, "MENOS DE 30 DÍAS EN MORA")
    assert out["T4"] == (31, "MÁS DE 30 DÍAS DE MORA")
    assert out["T5"] == (90, "MÁS DE 30 DÍAS DE MORA")
    assert out["T6"] == (91, "MÁS DE 90 DÍAS DE MORA")
    assert out["T7"] == (180, "MÁS DE 90 DÍAS DE MORA")
    assert out["T8"] == (181, "MÁS DE 180 DÍAS DE MORA")
    assert out["T9"] == (0, "AL DÍA")  # not yet due
    assert out["T92"] == (0, "AL DÍA")  # closed


def test_invoice_aging(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 5, 1)), (2, dt.date(2024, 6, 20)), (3, dt.date(2024, 3, 1))],
                               "id long, d date")
    out = {r.id: (r.days_overdue, r.overdue_range, r.months_since_due, r.due_this_month)
           for r in invoice_aging(df, AS_OF, "d", 10).collect()}
    assert out[1] == (50, "Entre 30 y 60 Días", 1, 0)
    assert out[2] == (0, "Menor o igual a 30 Días", 0, 1)
    assert out[3] == (111, "Mayor o igual a 60 Días", 3, 0)
