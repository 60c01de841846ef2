"""Delimited scans, row numbers, sinks and the incremental load, on files written here."""

import pytest
from pyspark.errors import AnalysisException

from ledgerq.operators.rules import CORRUPT
from ledgerq.plans.transactions import DUPLICATE, TYPED_KEY, accepted_transactions, validate_transactions, written_transactions
from ledgerq.schemas import MOV_INPUT, TX_INPUT
from ledgerq.sources.delimited import scan, scan_ordered
from ledgerq.sources.tables import append_rows, replace_table
from ledgerq.sources.workspace import runs_local
from ledgerq.streaming.incremental import UniqueKey, load_new_files, loaded

HEADER = "id,fecha,monto,tipo\n"


def test_good_and_bad_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        HEADER
        + '1, 2024-01-01 ,"1","  a,b  "\n'
        + "2,2024-01-01\n"
        + "3,2024-01-01,1,x,more\n"
        + "four,2024-01-01,1,x\n"
        + "\n"
        + "# a remark\n"
        + ',2024-01-01,1,"say ""x"""\n'
        + " 5 ,2024-01-01,,\n",
        encoding="utf-8",
    )
    rows = scan_ordered(spark, str(tmp_path / "a.csv"), TX_INPUT).orderBy("seq").collect()
    assert [r["seq"] for r in rows] == [1, 2, 3, 4, 5, 6, 7]
    assert [r[CORRUPT] for r in rows] == [None, "2,2024-01-01", "3,2024-01-01,1,x,more", "four,2024-01-01,1,x", "", None, None]
    assert [rows[i]["id"] for i in (0, 5, 6)] == [1, None, 5]
    assert rows[5]["tipo"] == 'say "x"'
    codes = [r["reject_code"] for r in validate_transactions(scan_ordered(spark, str(tmp_path), TX_INPUT)).orderBy("seq").collect()]
    assert codes == [None, *["linea_malformada"] * 4, "nulo:id_origen", "monto_vacio"]
    assert accepted_transactions(validate_transactions(scan_ordered(spark, str(tmp_path), TX_INPUT))).first()["tipo"] == "A,B"


def test_malformed_lines_are_seen_whatever_columns_are_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,2024-01-01,1,x\n2,2024-01-01\n3,2024-01-01,1,x,y\n")
    lines = scan(spark, str(tmp_path), TX_INPUT).select("id", CORRUPT)
    assert [r[CORRUPT] is not None for r in lines.orderBy("id").collect()] == [False, True, True]


def test_every_physical_line_is_a_row(spark, tmp_path):
    """Blank lines in any place, comments before the header, other line ends, an unclosed quote, and files without rows."""
    (tmp_path / "a.csv").write_bytes(b"# made by hand\n" + HEADER.encode() + b"\n1,2024-01-01,1,x\r\n\r\n   \n\t\n2,2024-01-01,1,x\n\n\n")
    (tmp_path / "b.csv").write_text(HEADER)
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d.csv").write_text("\n3,2024-01-01,1,x\n")  # its header is blank
    (tmp_path / "e.csv").write_text(HEADER + '4,2024-01-01,1,"x\n5,2024-01-01,1,x\n#\n')
    rows = scan_ordered(spark, str(tmp_path), TX_INPUT).orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["id"] for r in rows] == [None, 1, None, None, None, 2, None, None, 3, 4, 5]
    assert [r[CORRUPT] for r in rows] == ["", None, "", "   ", "\t", None, "", "", None, None, None]


def test_blank_lines_across_splits(spark, tmp_path):
    """A third of all lines are blank; files are cut into splits, some of which begin or end with blank lines."""
    for name in "ab":
        lines = [f"{i},2024-01-01,1,{'x' * (i % 50)}" + ("\n" if i % 2 else "") for i in range(2000)]
        (tmp_path / f"{name}.csv").write_text(HEADER + "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = scan_ordered(spark, str(tmp_path), TX_INPUT).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["seq"] for r in rows] == list(range(1, 6001))
    want = [v for i in range(2000) for v in ([i, None] if i % 2 else [i])] * 2
    assert [r["id"] for r in rows] == want
    assert [r[CORRUPT] == "" for r in rows] == [v is None for v in want]


def test_utf8_text(spark, tmp_path):
    (tmp_path / "m.csv").write_text("cuenta_id,fecha,transaccion,monto,descripcion\n1,2024-01-01,depósito,5,ñandú\n", encoding="utf-8")
    row = scan(spark, str(tmp_path), MOV_INPUT).first()
    assert (row["transaccion"], row["descripcion"]) == ("depósito", "ñandú")


def test_missing_input_fails_at_once(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        scan(spark, str(tmp_path / "none.csv"), TX_INPUT)


def test_row_numbers_follow_files_and_offsets(spark, tmp_path):
    """Several files, each cut into many splits of unlike size and packed together."""
    n = 0
    for name, size in (("b", 300), ("a", 40), ("c", 3000)):
        body = "".join(f"{i},2024-01-01,1,{name * (i % 40)}\n" for i in range(size))
        (tmp_path / f"{name}.csv").write_text(HEADER + body)
        n += size
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        rows = scan_ordered(spark, str(tmp_path), TX_INPUT).select("seq", "id").orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["seq"] for r in rows] == list(range(1, n + 1))
    assert [r["id"] for r in rows] == [*range(40), *range(300), *range(3000)]


def test_row_numbers_hold_when_the_split_layout_changes(spark, tmp_path):
    """The split settings change between the scan and the action."""
    for f in range(60):
        (tmp_path / f"{f:02}.csv").write_text(HEADER + "".join(f"{f * 20 + i},2024-01-01,1,x\n" for i in range(20)))
    lines = scan_ordered(spark, str(tmp_path), TX_INPUT)
    spark.conf.set("spark.sql.files.minPartitionNum", "40")
    try:
        rows = lines.select("seq", "id").orderBy("seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert [tuple(r) for r in rows] == [(i + 1, i) for i in range(1200)]


def test_intermediates_need_a_shared_folder_on_a_cluster():
    assert [runs_local(m) for m in ("local", "local[8]", "local[*]")] == [True] * 3
    assert [runs_local(m) for m in ("local-cluster[3,2,1024]", "spark://host:7077", "yarn")] == [False] * 3


def test_replace_and_append(spark, tmp_path):
    df = spark.range(5)
    replace_table(df, str(tmp_path / "t"))
    assert replace_table(df, str(tmp_path / "t")).count() == 5
    for _ in range(3):
        append_rows(spark.range(1), str(tmp_path / "h"))
    assert spark.read.parquet(str(tmp_path / "h")).count() == 3


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()

    def load():
        load_new_files(spark, str(source), TX_INPUT, validate_transactions, target, state)
        return loaded(spark, target)

    (source / "1.csv").write_text(HEADER + "1,2024-01-01,5,credito\n2,bad\n")
    assert load().count() == 2
    assert load().count() == 2
    (source / "2.csv").write_text(HEADER + "3,01/01/2024,5.00,CREDITO\n4,2024-01-02,x,debito\n")
    rows = load()
    assert rows.count() == 4
    assert {r["id"]: r["reject_code"] for r in rows.where("id in (1, 3, 4)").collect()} == {1: None, 3: None, 4: "monto_no_numerico"}
    # The same natural key came again in a later batch: the first arrival stays.
    assert [r["id_origen"] for r in written_transactions(rows).collect()] == [1]


def test_a_natural_key_holds_over_all_batches(spark, tmp_path):
    """A later file repeats keys of older ones: write rejects of its batch. A batch done again changes nothing."""
    source, target, state = tmp_path / "in", str(tmp_path / "out"), tmp_path / "state"
    source.mkdir()
    key = UniqueKey(TYPED_KEY, "clave_duplicada", DUPLICATE, buckets=8)

    def load(name, *lines):
        (source / name).write_text(HEADER + "\n".join(lines) + "\n")
        load_new_files(spark, str(source), TX_INPUT, validate_transactions, target, str(state), unique=key)
        return sorted((r["lote"], r["id"], r["reject_code"]) for r in loaded(spark, target).collect())

    many = [f"{100 + i},2024-02-01,7,hot" for i in range(40)]
    first = [(0, 1, None), (0, 2, "fecha_invalida"), (0, 3, "clave_duplicada")]
    assert load("1.csv", "1,2024-01-01,5,credito", "2,bad,5,credito", "3,01/01/2024,5.00,CREDITO") == first
    second = [(1, 4, "clave_duplicada"), (1, 5, None), (1, 100, None), *((1, 100 + i, "clave_duplicada") for i in range(1, 40))]
    assert load("2.csv", "4,2024-01-01,5,Credito", "5,2024-01-02,5,x", *many) == first + second
    reasons = loaded(spark, target).where("id in (3, 4)").orderBy("id").collect()
    assert [r["reject_reason"].rsplit(" ", 1)[1] for r in reasons] == ["1", "1"]
    # The stream forgets that it did the second batch, and does it again with what came since.
    for name in ("1", ".1.crc"):
        (state / "commits" / name).unlink()
    third = [(2, 6, "clave_duplicada"), (2, 7, "clave_duplicada"), (2, 8, None)]
    assert load("3.csv", "6,2024-01-02,5,x", "7,2024-02-01,7,hot", "8,2024-03-01,7,hot") == first + second + third
    assert accepted_transactions(loaded(spark, target)).select("fecha", "monto", "tipo").distinct().count() == 4


def test_a_batch_too_large_for_its_numbers_raises(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("ledgerq.streaming.incremental._BATCH_ROWS", 3)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.csv").write_text(HEADER + "1,2024-01-01,5,credito\n" * 3)
    with pytest.raises(Exception, match="lower bytes_per_batch"):
        load_new_files(spark, str(tmp_path / "in"), TX_INPUT, validate_transactions, str(tmp_path / "out"), str(tmp_path / "state"))
