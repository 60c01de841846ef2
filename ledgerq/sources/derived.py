"""Dirty inputs derived from the order and customer tables.

Each is one SQL text that Spark and other ANSI engines run unchanged, over every row of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerq.sources.spread import spread

_DATE = """CASE WHEN k % 18 = 7 THEN '2024-13-01' WHEN k % 97 = 5 THEN '30/02/' || y
       WHEN k % 4 = 0 THEN y || '-' || m || '-' || d WHEN k % 4 = 1 THEN y || '/' || m || '/' || d
       WHEN k % 4 = 2 THEN d || '-' || m || '-' || y ELSE d || '/' || m || '/' || y END AS fecha"""
_DATE_PARTS = """lpad(cast(extract(year from o_orderdate) as string), 4, '0') AS y,
        lpad(cast(extract(month from o_orderdate) as string), 2, '0') AS m,
        lpad(cast(extract(day from o_orderdate) as string), 2, '0') AS d"""

TX_SQL = f"""SELECT k AS id, {_DATE},
  CASE WHEN k % 6 = 3 THEN '' WHEN k % 53 = 9 THEN 'abc' WHEN k % 55 = 10 THEN '0'
       WHEN k % 7 = 2 THEN '-' || a ELSE a END AS monto,
  CASE WHEN s = 'F' THEN 'credito' WHEN s = 'O' THEN ' Debito ' WHEN k % 3 = 0 THEN 'invalid'
       WHEN k % 3 = 1 THEN 'desconocido' ELSE '' END AS tipo
FROM (SELECT o_orderkey AS k, o_orderstatus AS s,
        cast(cast(floor(o_totalprice / 20000) as bigint) * 100 + 100 as string) AS a,
        {_DATE_PARTS} FROM orders)"""

INT_SQL = """SELECT c_custkey AS seq, c_custkey % 1000 AS cuenta_id,
  'N' || cast((c_custkey % 1000) % 250 as string) AS nombre,
  CASE WHEN c_custkey % 13 = 0 THEN ''
       ELSE cast(cast(floor(c_acctbal / 1000) as bigint) * 1000 as string) END AS saldo,
  CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 8 = 1 THEN '100' WHEN c_custkey % 19 = 3 THEN '150'
       ELSE cast(25 + 5 * (c_custkey % 5) as string) END AS edad,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'ahorro' WHEN c_mktsegment = 'BUILDING' THEN 'prestamo'
       WHEN c_mktsegment = 'AUTOMOBILE' THEN 'hipoteca' WHEN c_mktsegment = 'HOUSEHOLD' THEN '-1'
       ELSE ' Ahorro' END AS tipo
FROM customer"""

MOV_SQL = f"""SELECT cid AS cuenta_id, {_DATE},
  CASE WHEN p = '1-URGENT' THEN 'deposito' WHEN p = '2-HIGH' THEN 'Depósito' WHEN p = '3-MEDIUM' THEN 'retiro'
       WHEN p = '4-NOT SPECIFIED' THEN 'compra' WHEN k % 7 = 0 THEN 'otro' ELSE 'pago' END AS transaccion,
  CASE WHEN k % 41 = 0 THEN '' WHEN k % 43 = 0 THEN '0' WHEN k % 2 = 0 THEN '-' || a ELSE a END AS monto,
  CASE WHEN k % 12 = 0 THEN '  ' ELSE 'mov ' || cast(k as string) END AS descripcion, k AS seq
FROM (SELECT o_orderkey AS k, o_custkey AS cid, o_orderpriority AS p,
        cast(cast(floor(o_totalprice / 100) as bigint) as string) || '.25' AS a,
        {_DATE_PARTS} FROM orders)"""

# Stored tables from an earlier day, to merge into.
STORED_ACCOUNTS_SQL = """SELECT s_suppkey AS cuenta_id, 'N' || cast(s_suppkey % 250 as string) AS nombre,
  'ahorro' AS tipo, 25 + 5 * cast(s_suppkey % 5 as int) AS edad,
  cast(floor(abs(s_acctbal) / 1000) * 1000 as decimal(15,2)) AS saldo_inicial,
  cast(0.0150 as decimal(6,4)) AS tasa_interes_mensual,
  cast(floor(abs(s_acctbal) / 1000) * 15 as decimal(15,2)) AS interes_calculado,
  cast(floor(abs(s_acctbal) / 1000) * 1015 as decimal(15,2)) AS saldo_final
FROM supplier"""

STORED_STATEMENTS_SQL = """SELECT s_suppkey * 3 AS cuenta_id, cast(1990 + s_suppkey % 15 as int) AS anio,
  cast(floor(abs(s_acctbal)) as decimal(18,2)) AS total_depositos,
  cast(0 as decimal(18,2)) AS total_retiros, cast(0 as decimal(18,2)) AS total_compras,
  cast(0 as decimal(18,2)) AS total_pagos, cast(floor(abs(s_acctbal)) as decimal(18,2)) AS saldo_neto,
  cast(1 as bigint) AS cantidad_movimientos, cast(0 as bigint) AS cantidad_anomalias
FROM supplier"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def derive(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    """Run one of the texts over a table of the folder, without touching the session's views."""
    return spark.sql(sql.replace(f"FROM {name}", f"FROM {{{name}}}"), **{name: table(spark, sf_dir, name)})


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, TX_SQL, "orders").withColumn("seq", F.col("id"))


def raw_interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, INT_SQL, "customer")


def raw_movements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, MOV_SQL, "orders")


def stored_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, STORED_ACCOUNTS_SQL, "supplier")


def stored_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, STORED_STATEMENTS_SQL, "supplier")
