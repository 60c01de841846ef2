"""The same results in plain SQL over the same tables, for the keys of ``QUERIES``."""

from __future__ import annotations

from ledgerq.queries import RANGES
from ledgerq.sources.derived import (
    INT_SQL,
    MOV_SQL,
    STORED_ACCOUNTS_SQL,
    STORED_STATEMENTS_SQL,
    TX_SQL,
)

_YEAR_FIRST = "regexp_full_match(f, '[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}')"
_DAY_FIRST = "regexp_full_match(f, '[0-9]{2}-[0-9]{2}-[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4}')"


def _dated(source: str) -> str:
    """``source`` plus ``f`` (trimmed date text), ``formato_fecha`` and ``fecha_ok``."""
    return f"""SELECT * EXCLUDE (yy, mm, dd), CASE WHEN yy >= 1 AND mm BETWEEN 1 AND 12 AND dd BETWEEN 1 AND 31
    THEN make_date(yy, mm, least(dd, extract(day from last_day(make_date(yy, mm, 1))))) END AS fecha_ok
  FROM (SELECT *, CASE WHEN {_YEAR_FIRST} AND f LIKE '%-%' THEN 'yyyy-MM-dd' WHEN {_YEAR_FIRST} THEN 'yyyy/MM/dd'
      WHEN {_DAY_FIRST} AND f LIKE '%-%' THEN 'dd-MM-yyyy' WHEN {_DAY_FIRST} THEN 'dd/MM/yyyy' END AS formato_fecha,
    cast(CASE WHEN {_YEAR_FIRST} THEN substr(f, 1, 4) WHEN {_DAY_FIRST} THEN substr(f, 7, 4) END AS bigint) AS yy,
    cast(CASE WHEN {_YEAR_FIRST} THEN substr(f, 6, 2) WHEN {_DAY_FIRST} THEN substr(f, 4, 2) END AS bigint) AS mm,
    cast(CASE WHEN {_YEAR_FIRST} THEN substr(f, 9, 2) WHEN {_DAY_FIRST} THEN substr(f, 1, 2) END AS bigint) AS dd
  FROM (SELECT *, trim(fecha) AS f FROM {source}))"""


_TX = f"""tx_raw AS ({TX_SQL}), tx_dated AS ({_dated("tx_raw")}),
tx_typed AS (SELECT *, try_cast(trim(monto) AS decimal(15,2)) AS m,
  CASE WHEN trim(tipo) = '' THEN 'DESCONOCIDO' ELSE upper(trim(tipo)) END AS t FROM tx_dated),
tx AS (SELECT *, CASE WHEN f = '' THEN 'fecha_vacia' WHEN fecha_ok IS NULL THEN 'fecha_invalida'
    WHEN trim(monto) = '' THEN 'monto_vacio' WHEN m IS NULL THEN 'monto_no_numerico' END AS code,
  nullif(concat_ws('; ', CASE WHEN t NOT IN ('DEBITO', 'CREDITO')
      THEN 'tipo de transaccion no reconocido (''' || trim(tipo) || ''')' END,
    CASE WHEN m < 0 THEN 'monto negativo' WHEN m = 0 THEN 'monto en cero' END), '') AS motivo_anomalia FROM tx_typed),
tx_ok AS (SELECT id AS id_origen, fecha_ok AS fecha, m AS monto, t AS tipo,
  motivo_anomalia IS NOT NULL AS es_anomalia, motivo_anomalia FROM tx WHERE code IS NULL),
tx_ranked AS (SELECT *, row_number() OVER w AS rn, first_value(id_origen) OVER w AS kept
  FROM tx_ok WINDOW w AS (PARTITION BY fecha, monto, tipo ORDER BY id_origen)),
tx_written AS (SELECT * EXCLUDE (rn, kept) FROM tx_ranked WHERE rn = 1),
tx_dup AS (SELECT r.id AS seq, r.id, r.fecha, r.monto, r.tipo, 'write' AS reject_phase, 'clave_duplicada' AS reject_code,
  'clave natural duplicada (fecha, monto, tipo); se conserva el orden ' || k.kept AS reject_reason
  FROM tx_ranked k JOIN tx_raw r ON r.id = k.id_origen WHERE k.rn > 1)"""

_INT = f"""int_raw AS ({INT_SQL}),
int_typed AS (SELECT *, lower(trim(tipo)) AS t, try_cast(trim(saldo) AS decimal(15,2)) AS s,
  CASE WHEN regexp_full_match(trim(edad), '[+-]?[0-9]+') THEN try_cast(trim(edad) AS integer) END AS e FROM int_raw),
int_all AS (SELECT *, CASE WHEN t NOT IN ('ahorro', 'prestamo') THEN 'tipo_no_soportado'
    WHEN trim(edad) = '' THEN 'edad_vacia' WHEN e IS NULL THEN 'edad_no_numerica'
    WHEN e NOT BETWEEN 18 AND 90 THEN 'edad_fuera_de_rango' WHEN trim(saldo) = '' THEN 'saldo_vacio'
    WHEN s IS NULL THEN 'saldo_no_numerico' WHEN s < 0 THEN 'saldo_negativo' END AS code,
  cast(CASE WHEN t = 'ahorro' THEN 0.0150 ELSE 0.0250 END AS decimal(6,4)) AS rate FROM int_typed),
int_ok AS (SELECT seq, cuenta_id, trim(nombre) AS nombre, t AS tipo, e AS edad, s AS saldo_inicial,
  rate AS tasa_interes_mensual, cast(round(s * rate, 2) AS decimal(15,2)) AS interes_calculado,
  cast(s + round(s * rate, 2) AS decimal(15,2)) AS saldo_final FROM int_all WHERE code IS NULL),
int_latest AS (SELECT * EXCLUDE (seq, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY cuenta_id ORDER BY seq DESC) AS rn FROM int_ok) WHERE rn = 1)"""

_STORED = f"stored AS ({STORED_ACCOUNTS_SQL})"


def _serial(initial: str) -> str:
    """One step per valid row in arrival order; the state is the list of (account, key) held."""
    key = "nombre || '|' || saldo_inicial || '|' || edad || '|' || tipo"
    return f"""int_steps AS (SELECT row_number() OVER (ORDER BY seq) AS i, *, {key} AS k FROM int_ok),
walk AS (SELECT cast(0 AS bigint) AS i, {initial.format(key=key)} AS held, true AS passes
  UNION ALL SELECT n.i, CASE WHEN n.free THEN list_append(list_filter(n.held, lambda h: h.c <> n.cuenta_id),
      {{'c': n.cuenta_id, 'k': n.k}}) ELSE n.held END, n.free
  FROM (SELECT s.i, s.cuenta_id, s.k, w.held,
      len(list_filter(w.held, lambda h: h.k = s.k AND h.c <> s.cuenta_id)) = 0 AS free
    FROM walk w JOIN int_steps s ON s.i = w.i + 1) n),
int_kept AS (SELECT s.* EXCLUDE (i, k) FROM int_steps s JOIN walk w USING (i) WHERE w.passes),
int_away AS (SELECT s.* FROM int_steps s JOIN walk w USING (i) WHERE NOT w.passes),
int_serial AS (SELECT * EXCLUDE (seq, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY cuenta_id ORDER BY seq DESC) AS rn FROM int_kept) WHERE rn = 1)"""


_NOTHING_HELD = "cast([] AS struct(c bigint, k varchar)[])"
_STORED_HELD = "(SELECT list({{'c': cuenta_id, 'k': {key}}}) FROM stored)"

_MOV = f"""mov_raw AS ({MOV_SQL}), mov_dated AS ({_dated("mov_raw")}),
mov_typed AS (SELECT *, try_cast(trim(monto) AS decimal(15,2)) AS m,
  strip_accents(lower(trim(transaccion))) AS t FROM mov_dated),
mov AS (SELECT *, CASE WHEN f = '' THEN 'fecha_vacia' WHEN fecha_ok IS NULL THEN 'fecha_invalida'
    WHEN t NOT IN ('deposito', 'retiro', 'compra', 'pago') THEN 'tipo_no_reconocido'
    WHEN trim(monto) = '' THEN 'monto_vacio' WHEN m IS NULL THEN 'monto_no_numerico'
    WHEN m = 0 THEN 'monto_cero' END AS code,
  CASE WHEN t = 'deposito' THEN m < 0 ELSE m > 0 END AS wrong FROM mov_typed),
mov_ok AS (SELECT seq, cuenta_id, fecha_ok AS fecha, t AS tipo_movimiento,
  cast(CASE WHEN wrong THEN -m ELSE m END AS decimal(15,2)) AS monto,
  CASE WHEN trim(descripcion) = '' THEN 'Movimiento sin descripcion registrada' ELSE trim(descripcion) END AS descripcion,
  wrong AS es_anomalia, CASE WHEN wrong THEN
    'signo de monto corregido automaticamente (no correspondia al tipo de movimiento ''' || t || ''')' END AS motivo_anomalia
  FROM mov WHERE code IS NULL),
statement AS (SELECT cuenta_id, cast(extract(year from fecha) AS integer) AS anio,
  cast(coalesce(sum(monto) FILTER (WHERE tipo_movimiento = 'deposito'), 0) AS decimal(18,2)) AS total_depositos,
  cast(coalesce(sum(monto) FILTER (WHERE tipo_movimiento = 'retiro'), 0) AS decimal(18,2)) AS total_retiros,
  cast(coalesce(sum(monto) FILTER (WHERE tipo_movimiento = 'compra'), 0) AS decimal(18,2)) AS total_compras,
  cast(coalesce(sum(monto) FILTER (WHERE tipo_movimiento = 'pago'), 0) AS decimal(18,2)) AS total_pagos,
  cast(sum(monto) AS decimal(18,2)) AS saldo_neto, count(*) AS cantidad_movimientos,
  count(*) FILTER (WHERE es_anomalia) AS cantidad_anomalias FROM mov_ok GROUP BY ALL)"""

_COUNTERS = f"""{_TX}, {_INT}, {_MOV}, {_serial(_NOTHING_HELD)}, counters AS (
  SELECT 'transacciones' AS trabajo, count(*) AS leidos, (SELECT count(*) FROM tx_written) AS escritos,
    cast(0 AS bigint) AS omitidos_lectura, count(code) AS omitidos_proceso,
    (SELECT count(*) FROM tx_dup) AS omitidos_escritura FROM tx
  UNION ALL SELECT 'intereses', count(*), count(*) - count(code) - (SELECT count(*) FROM int_away), 0, count(code),
    (SELECT count(*) FROM int_away) FROM int_all
  UNION ALL SELECT 'cuentas-anuales', count(*), count(*) - count(code), 0, count(code), 0 FROM mov),
gate AS (SELECT *, leidos + omitidos_lectura AS intentados,
    omitidos_lectura + omitidos_proceso + omitidos_escritura AS omitidos FROM counters)"""


def _with(parts: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{parts}\n{select}"


def _merged(columns: list[str], keys: list[str], new: str, old: str) -> str:
    marked = f"(SELECT *, true AS is_new FROM {new}) n"
    picked = ", ".join(
        f"coalesce(n.{c}, o.{c}) AS {c}" if c in keys else f"CASE WHEN n.is_new THEN n.{c} ELSE o.{c} END AS {c}"
        for c in columns
    )
    match = " AND ".join(f"n.{k} = o.{k}" for k in keys)
    return f"SELECT {picked} FROM {marked} FULL OUTER JOIN {old} o ON {match}"


_ACCOUNT = ["cuenta_id", "nombre", "tipo", "edad", "saldo_inicial", "tasa_interes_mensual", "interes_calculado", "saldo_final"]
_STATEMENT = ["cuenta_id", "anio", "total_depositos", "total_retiros", "total_compras", "total_pagos", "saldo_neto", "cantidad_movimientos", "cantidad_anomalias"]
_LINE = "id || ',' || fecha || ',' || monto || ',' || trim(tipo)"
_BAD_LINES = f"""bad AS (SELECT id, CASE WHEN id % 11 = 3 THEN id || ',' || fecha WHEN id % 13 = 3 THEN {_LINE} || ',sobra'
  WHEN id % 17 = 3 THEN 'x' || {_LINE} END AS line, id % 11 <> 3 AND id % 13 <> 3 AND id % 17 <> 3 AND id % 19 = 3 AS comment
  FROM tx_raw),
blank AS (SELECT CASE WHEN id % 23 = 3 THEN '' ELSE '  ' END AS line FROM bad
  WHERE line IS NULL AND NOT comment AND (id % 23 = 3 OR id % 29 = 3))"""
_TX_REASON = """CASE code WHEN 'fecha_vacia' THEN 'Fecha vacia o nula'
    WHEN 'fecha_invalida' THEN 'Formato de fecha no reconocido: ''' || f || ''''
    WHEN 'monto_vacio' THEN 'Transaccion id=' || id || ': monto vacio o nulo, no se puede procesar'
    WHEN 'monto_no_numerico' THEN 'Transaccion id=' || id || ': monto no numerico (''' || trim(monto) || ''')' END"""
_INT_REASON = """'Cuenta ' || cuenta_id || ': ' || CASE code
    WHEN 'tipo_no_soportado' THEN 'tipo de cuenta no soportado (''' || trim(tipo) || ''')'
    WHEN 'edad_vacia' THEN 'edad vacia o nula'
    WHEN 'edad_no_numerica' THEN 'edad no numerica (''' || trim(edad) || ''')'
    WHEN 'edad_fuera_de_rango' THEN 'edad fuera de rango permitido [18-90] (valor=' || e || ')'
    WHEN 'saldo_vacio' THEN 'saldo vacio o nulo'
    WHEN 'saldo_no_numerico' THEN 'saldo no numerico (''' || trim(saldo) || ''')'
    WHEN 'saldo_negativo' THEN 'saldo negativo no permitido (' || trim(saldo) || ')' END"""
_MOV_REASON = """CASE code WHEN 'fecha_vacia' THEN 'Fecha vacia o nula'
    WHEN 'fecha_invalida' THEN 'Formato de fecha no reconocido: ''' || f || ''''
    ELSE 'Cuenta ' || cuenta_id || ': ' || CASE code
      WHEN 'tipo_no_reconocido' THEN 'tipo de movimiento no reconocido (''' || trim(transaccion) || ''')'
      WHEN 'monto_vacio' THEN 'monto vacio o nulo'
      WHEN 'monto_no_numerico' THEN 'monto no numerico (''' || trim(monto) || ''')'
      WHEN 'monto_cero' THEN 'movimiento con monto en cero, no se puede clasificar' END END"""
_REJECT = "'process' AS reject_phase, code AS reject_code"

ORACLES: dict[str, str] = {
    "csv_scan": _with(_TX, "SELECT id, trim(fecha) AS fecha, trim(monto) AS monto, trim(tipo) AS tipo FROM tx_raw"),
    "csv_malformed": _with(
        f"{_TX}, {_BAD_LINES}",
        "SELECT 'read' AS reject_phase, 'linea_malformada' AS reject_code, "
        "'linea con formato incorrecto: ' || line AS reject_reason FROM "
        "(SELECT line FROM bad WHERE line IS NOT NULL UNION ALL SELECT line FROM blank)",
    ),
    "csv_row_numbers": _with(
        f"{_TX}, {_BAD_LINES}, n AS (SELECT count(*) AS n, count(line) AS m, count(*) FILTER (WHERE line LIKE 'x%' OR trim(line) = '') AS x "
        "FROM (SELECT line FROM bad WHERE NOT comment UNION ALL SELECT line FROM blank))",
        "SELECT n AS filas, cast(1 AS bigint) AS primera, n AS ultima, cast(n * (n + 1) // 2 AS bigint) AS suma, "
        "m AS malformadas, n - x AS con_clave FROM n",
    ),
    "range_split_plan": _with(
        f"{_TX}, r AS (SELECT row_number() OVER (ORDER BY id) AS i, ntile({RANGES}) OVER (ORDER BY id) - 1 AS p FROM tx_raw)",
        "SELECT cast(p AS integer) AS particion, min(i) AS inicio, max(i) AS fin, count(*) AS filas FROM r GROUP BY p",
    ),
    "range_split_rows": _with(
        _TX, f"SELECT id, cast(ntile({RANGES}) OVER (ORDER BY id) - 1 AS integer) AS particion FROM tx_raw"
    ),
    "range_read": _with(
        f"{_TX}, r AS (SELECT cast(ntile({RANGES}) OVER (ORDER BY id) - 1 AS integer) AS particion FROM tx_raw)",
        "SELECT particion, count(*) AS filas FROM r WHERE particion BETWEEN 2 AND 4 GROUP BY ALL",
    ),
    "date_normalize": _with(_TX, "SELECT id, fecha, fecha_ok, formato_fecha FROM tx_dated"),
    "date_format_counts": _with(
        _TX, "SELECT coalesce(formato_fecha, 'ninguno') AS formato, count(*) AS filas FROM tx_dated GROUP BY ALL"
    ),
    "amount_parse": _with(
        _TX,
        "SELECT id, monto AS crudo, m AS monto, CASE WHEN trim(monto) = '' THEN 'vacio' WHEN m IS NULL THEN "
        "'no_numerico' ELSE 'ok' END AS estado FROM tx",
    ),
    "mov_type_normalize": _with(_MOV, "SELECT seq, transaccion, t AS tipo_movimiento FROM mov"),
    "profile_types": _with(
        f"{_TX}, {_INT}, {_MOV}",
        "SELECT 'transacciones' AS entrada, trim(tipo) AS valor, count(*) AS filas FROM tx_raw GROUP BY ALL "
        "UNION ALL SELECT 'intereses', trim(tipo), count(*) FROM int_raw GROUP BY ALL "
        "UNION ALL SELECT 'cuentas-anuales', trim(transaccion), count(*) FROM mov_raw GROUP BY ALL",
    ),
    "constraint_violations": """SELECT cuenta_id, 'write' AS reject_phase, reject_code,
  CASE reject_code WHEN 'nulo:fecha' THEN 'fecha no admite nulos'
    WHEN 'nulo:tipo_movimiento' THEN 'tipo_movimiento no admite nulos'
    WHEN 'largo:tipo_movimiento' THEN 'tipo_movimiento excede 20 caracteres'
    WHEN 'precision:monto' THEN 'monto excede numeric(15,2)'
    WHEN 'largo:descripcion' THEN 'descripcion excede 200 caracteres' END AS reject_reason
FROM (SELECT doc_id AS cuenta_id, CASE WHEN n_chars < 100 THEN 'nulo:fecha' WHEN source IS NULL THEN 'nulo:tipo_movimiento'
    WHEN length(source) > 20 THEN 'largo:tipo_movimiento' WHEN n_chars * 1000000000 >= 10000000000000 THEN 'precision:monto'
    WHEN length(text) > 200 THEN 'largo:descripcion' END AS reject_code FROM documents) WHERE reject_code IS NOT NULL""",
    "tx_accepted": _with(_TX, "SELECT * FROM tx_ok"),
    "tx_anomalies": _with(_TX, "SELECT * FROM tx_ok WHERE es_anomalia"),
    "tx_dedup": _with(_TX, "SELECT * FROM tx_written"),
    "tx_duplicates": _with(_TX, "SELECT * FROM tx_dup"),
    "tx_rejects": _with(
        _TX,
        f"SELECT id AS seq, id, fecha, monto, tipo, {_REJECT}, {_TX_REASON} AS reject_reason FROM tx "
        "WHERE code IS NOT NULL UNION ALL SELECT * FROM tx_dup",
    ),
    "tx_rejects_of_range": _with(
        _TX, f"SELECT id, {_REJECT} FROM tx WHERE code IS NOT NULL AND id BETWEEN 1000 AND 9000"
    ),
    "tx_summary": _with(
        _TX,
        "SELECT count(*) AS total_procesadas, count(*) FILTER (WHERE es_anomalia) AS total_anomalias, "
        "(SELECT count(*) FROM tx) - count(*) AS total_omitidas, "
        "cast(coalesce(sum(monto) FILTER (WHERE tipo = 'CREDITO'), 0) AS decimal(18,2)) AS monto_total_creditos, "
        "cast(coalesce(sum(monto) FILTER (WHERE tipo = 'DEBITO'), 0) AS decimal(18,2)) AS monto_total_debitos "
        "FROM tx_written",
    ),
    "tx_by_anomaly": _with(_TX, "SELECT es_anomalia, count(*) AS filas FROM tx_written GROUP BY ALL"),
    "tx_partitioned": _with(
        f"{_TX}, r AS (SELECT id, cast(ntile(4) OVER (ORDER BY id) - 1 AS integer) AS particion FROM tx_raw)",
        "SELECT w.*, r.particion FROM tx_written w JOIN r ON r.id = w.id_origen",
    ),
    "sink_overwrite": _with(_TX, "SELECT * FROM tx_written"),
    "run_partitioned": _with(
        f"{_COUNTERS}, r AS (SELECT id, cast(ntile(4) OVER (ORDER BY id) - 1 AS integer) AS particion FROM tx_raw)",
        "SELECT particion, count(*) AS filas, 'COMPLETED' AS estado, "
        "any_value(CASE WHEN g.omitidos * 100.0 / g.intentados > 20 THEN 'REVISION_REQUERIDA' ELSE 'COMPLETED' END) AS salida, "
        "any_value(g.leidos) AS leidos, any_value(g.escritos) AS escritos, any_value(g.omitidos_proceso) AS omitidos_proceso, "
        "any_value(g.omitidos_escritura) AS omitidos_escritura FROM tx_written w JOIN r ON r.id = w.id_origen "
        "JOIN gate g ON g.trabajo = 'transacciones' GROUP BY particion",
        True,
    ),
    "incremental_load": _with(_TX, "SELECT * FROM tx_written"),
    "incremental_unique": _with(
        f"{_TX}, arrived AS (SELECT *, cast(id % 64 >= 32 AS integer) AS lote FROM tx), ranked AS (SELECT id, lote, code, "
        "row_number() OVER (PARTITION BY code IS NULL, fecha_ok, m, t ORDER BY lote, id) AS rn FROM arrived)",
        "SELECT id, lote, CASE WHEN code IS NOT NULL THEN 'process' WHEN rn > 1 THEN 'write' END AS reject_phase, "
        "CASE WHEN code IS NOT NULL THEN code WHEN rn > 1 THEN 'clave_duplicada' END AS reject_code FROM ranked",
    ),
    "int_calc": _with(_INT, "SELECT * FROM int_ok"),
    "int_rejects": _with(
        _INT,
        f"SELECT seq, cuenta_id, nombre, saldo, edad, tipo, {_REJECT}, {_INT_REASON} AS reject_reason "
        "FROM int_all WHERE code IS NOT NULL",
    ),
    "int_upsert_latest": _with(f"{_INT}, {_STORED}", _merged(_ACCOUNT, ["cuenta_id"], "int_latest", "stored")),
    "int_upsert_bucketed": _with(f"{_INT}, {_STORED}", _merged(_ACCOUNT, ["cuenta_id"], "int_latest", "stored")),
    "int_upsert_serial": _with(f"{_INT}, {_serial(_NOTHING_HELD)}", "SELECT * FROM int_serial", True),
    "int_upsert_serial_stored": _with(
        f"{_INT}, {_STORED}, {_serial(_STORED_HELD)}", _merged(_ACCOUNT, ["cuenta_id"], "int_serial", "stored"), True
    ),
    "int_write_rejects": _with(
        f"{_INT}, {_serial(_NOTHING_HELD)}",
        "SELECT seq, cuenta_id, nombre, saldo_inicial, edad, tipo FROM int_away",
        True,
    ),
    "int_key_conflicts": _with(
        _INT,
        "SELECT nombre, saldo_inicial, edad, tipo, count(*) AS cuentas, min(cuenta_id) AS cuenta_menor, "
        "max(cuenta_id) AS cuenta_mayor FROM int_latest GROUP BY ALL HAVING count(*) > 1",
    ),
    "int_key_profile": _with(
        _INT,
        "SELECT count(*) AS filas, count(DISTINCT cuenta_id) AS cuentas, "
        "count(DISTINCT (nombre, saldo_inicial, edad, tipo)) AS claves, "
        "count(*) - count(DISTINCT (nombre, saldo_inicial, edad, tipo)) AS repetidas FROM int_ok",
    ),
    "mov_accepted": _with(_MOV, "SELECT * EXCLUDE (seq) FROM mov_ok"),
    "mov_rejects": _with(
        _MOV,
        f"SELECT seq, cuenta_id, fecha, transaccion, monto, descripcion, {_REJECT}, {_MOV_REASON} AS reject_reason "
        "FROM mov WHERE code IS NOT NULL",
    ),
    "mov_sign_fix": _with(_MOV, "SELECT seq, tipo_movimiento, monto, motivo_anomalia FROM mov_ok WHERE es_anomalia"),
    "annual_statement": _with(_MOV, "SELECT * FROM statement"),
    "statement_upsert": _with(
        f"{_MOV}, stored AS ({STORED_STATEMENTS_SQL})",
        _merged(_STATEMENT, ["cuenta_id", "anio"], "statement", "stored"),
    ),
    "statement_sample": _with(_MOV, "SELECT * FROM statement ORDER BY cuenta_id, anio LIMIT 10"),
    "step_metrics": _with(_COUNTERS, "SELECT * FROM counters", True),
    "job_report": _with(
        _COUNTERS,
        "SELECT trabajo, leidos, escritos, omitidos, 'COMPLETED' AS estado, "
        "CASE WHEN omitidos * 100.0 / intentados > 20 THEN 'REVISION_REQUERIDA' ELSE 'COMPLETED' END AS salida FROM gate",
        True,
    ),
    "quality_gate": _with(
        _COUNTERS,
        "SELECT trabajo, intentados, omitidos, "
        "cast(round(cast(omitidos * 100.0 AS double) / intentados, 4) AS decimal(9,4)) AS porcentaje_omision, "
        "CASE WHEN omitidos * 100.0 / intentados > 20 THEN 'REVISION_REQUERIDA' ELSE 'CALIDAD_OK' END AS decision FROM gate",
        True,
    ),
    "skip_limit_check": _with(
        _COUNTERS,
        "SELECT trabajo, omitidos, cast(900 AS bigint) AS limite, omitidos > 900 AS limite_superado FROM gate",
        True,
    ),
    "run_status": _with(
        _COUNTERS,
        "SELECT trabajo, 'COMPLETED' AS estado, CASE WHEN omitidos * 100.0 / intentados > 20 "
        "THEN 'REVISION_REQUERIDA' ELSE 'COMPLETED' END AS salida, leidos, escritos, omitidos_proceso, omitidos_escritura FROM gate",
        True,
    ),
}
