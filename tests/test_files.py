"""The CSV dialect: what the fixed schemas make of unruly files."""

from __future__ import annotations

import datetime as dt
import decimal

import pytest
from cartwright import schemas
from cartwright.sinks.archive import archive_csv
from cartwright.sources import sample
from cartwright.sources.files import scan_csv

HEADER = (
    "order_id,customer_id,product_id,order_date,order_amount,currency,payment_method,"
    "shipping_address,order_status,created_timestamp\n"
)


def put(folder, name, *lines, header=HEADER):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(header + "".join(line + "\n" for line in lines))


def line(order_id="1", day="2001-01-02", amount="10.00", moment="2001-01-02 03:04:05"):
    return f"{order_id},c1,p1,{day},{amount},USD,card,here,new,{moment}"


def test_typed_values(spark, tmp_path):
    put(tmp_path, "a.csv", line())
    row = scan_csv(spark, "orders", str(tmp_path)).first()
    assert row.order_date == dt.date(2001, 1, 2)
    assert row.order_amount == decimal.Decimal("10.00")
    assert row.created_timestamp == dt.datetime(2001, 1, 2, 3, 4, 5)


def test_unparsable_values_become_null_and_decimals_round_half_up(spark, tmp_path):
    put(
        tmp_path,
        "a.csv",
        line("1", amount="abc"),
        line("2", day="02/01/2001"),
        line("3", amount="123456789012.00"),
        line("4", amount="1.005"),
        line("5", moment="yesterday"),
        "6,c1",
        line("7") + ",surplus,more",
    )
    rows = {r.order_id: r for r in scan_csv(spark, "orders", str(tmp_path)).collect()}
    assert rows["1"].order_amount is None and rows["1"].customer_id == "c1"
    assert rows["2"].order_date is None and rows["2"].order_amount == 10
    assert rows["3"].order_amount is None
    assert rows["4"].order_amount == decimal.Decimal("1.01")
    assert rows["5"].created_timestamp is None
    assert rows["6"].customer_id == "c1" and rows["6"].order_amount is None
    assert rows["7"].order_status == "new"


def test_columns_bind_by_position_unless_the_header_is_enforced(spark, tmp_path):
    swapped = HEADER.replace("order_id,customer_id", "customer_id,order_id")
    put(tmp_path, "a.csv", line("first"), header=swapped)
    assert scan_csv(spark, "orders", str(tmp_path)).first().order_id == "first"
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, "orders", str(tmp_path), strict_header=True).collect()


def test_empty_directory_gives_no_rows(spark, tmp_path):
    for domain in schemas.DOMAINS:
        assert scan_csv(spark, domain, str(tmp_path)).count() == 0


def test_schemas_have_the_agreed_width(spark, tmp_path):
    widths = {d: len(scan_csv(spark, d, str(tmp_path)).schema) for d in schemas.DOMAINS}
    assert widths == {
        "orders": 10, "customers": 15, "products": 16, "inventory": 12, "shipping": 16,
    }


def test_archive_moves_exactly_the_scanned_csv_files(spark, tmp_path):
    source, archive = tmp_path / "in put", tmp_path / "archive"
    put(source, "a.csv", line("1"))
    put(source, "b 1.csv", line("2"))
    put(source, "c.txt", line("3"))
    scanned = scan_csv(spark, "orders", str(source))
    put(source, "late.csv", line("4"))
    assert scanned.count() == 3
    assert archive_csv(scanned, str(archive)) == 2
    assert sorted(p.name for p in source.glob("*.*") if p.suffix != ".crc") == ["c.txt", "late.csv"]
    assert sorted(p.name for p in archive.glob("*.csv")) == ["a.csv", "b 1.csv"]


def test_archive_refuses_to_overwrite(spark, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "archive"
    put(source, "a.csv", line("1"))
    put(archive, "a.csv", line("0"))
    with pytest.raises(FileExistsError):
        archive_csv(scan_csv(spark, "orders", str(source)), str(archive))
    assert (source / "a.csv").exists()


def test_corrupt_lines_are_kept_whole(spark, tmp_path):
    columns = list(sample.columns_of("orders"))
    good = ["o1", "c1", "p1", "2001-01-02", "1.50", "USD", "card", '"a, \\"b\\""', "O", "2001-01-02 03:04:05"]
    lines = [good, [*good[:3], "2001-02-30", *good[4:]], good[:-1], [*good, "more"]]
    text = "\n".join([",".join(columns), *map(",".join, lines)]) + "\n"
    (tmp_path / "a.csv").write_text(text)
    rows = scan_csv(spark, "orders", str(tmp_path), corrupt_column="bad").collect()
    assert [row.bad for row in rows] == [None, *(",".join(line) for line in lines[1:])]
    assert [row.order_date is None for row in rows] == [False, True, False, False]
    assert [row.created_timestamp is None for row in rows] == [False, False, True, False]
    assert {row.shipping_address for row in rows} == {'a, "b"'}
    assert "bad" not in scan_csv(spark, "orders", str(tmp_path)).columns
