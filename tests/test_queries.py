"""Every query against its SQL text, and the numbers the inputs are known to give."""

import __spark_entry__ as entry_point
import pytest
from compare import both, duck

from ledgerq.oracles import ORACLES
from ledgerq.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    got, want = both(spark, con, QUERIES[name], ORACLES[name], SMALL)
    assert got == want


def test_driver_contract(spark):
    assert set(entry_point.queries()) >= set(QUERIES)
    assert set(entry_point.oracle_sql()) >= set(ORACLES) == set(QUERIES)
    assert set(entry_point.queries()) >= set(entry_point.oracle_sql())
    assert entry_point.entry(spark).count() > 0


def one(spark, name):
    (row,) = QUERIES[name](spark, MIDDLE).collect()
    return row.asDict()


def test_known_transaction_totals(spark):
    row = one(spark, "tx_summary")
    assert (row["total_procesadas"], row["total_anomalias"], row["total_omitidas"]) == (11222, 5022, 3778)
    assert (str(row["monto_total_creditos"]), str(row["monto_total_debitos"])) == ("3309300.00", "3319400.00")


def test_known_statement_totals(spark):
    row = QUERIES["annual_statement"](spark, MIDDLE).selectExpr(
        "count(1)", "count(distinct cuenta_id)", "sum(saldo_neto)", "sum(cantidad_anomalias)"
    )
    assert [str(v) for v in row.first()] == ["7401", "1500", "-5525780.50", "6499"]


def test_known_serial_totals(spark):
    assert QUERIES["int_upsert_serial"](spark, MIDDLE).count() == 482
    assert QUERIES["int_write_rejects"](spark, MIDDLE).count() == 22


def test_known_gate_outcomes(spark):
    rows = {r["trabajo"]: r for r in QUERIES["quality_gate"](spark, MIDDLE).collect()}
    assert rows["transacciones"]["decision"] == rows["intereses"]["decision"] == "REVISION_REQUERIDA"
    assert rows["cuentas-anuales"]["decision"] == "CALIDAD_OK"
    # Of 1500 interest rows, 910 break a rule and 22 are turned away by the natural key.
    assert [round(float(rows[j]["porcentaje_omision"]), 1) for j in sorted(rows)] == [12.6, 62.1, 25.2]
