"""Delimited files: dialect, header names, copy, snapshot size bound."""

import os

import pytest

from daybook.schemas import ENTITIES, as_strings
from daybook.sources.drops import copy_drop, drop_path, read_drop, read_text, write_csv, write_drop

HOLDERS = ENTITIES["policyholders"]
HEADER = ",".join(HOLDERS.columns)


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_read_drop(spark, tmp_path):
    folder = drop_path(str(tmp_path), "policyholders", "2026-02-01")
    put(folder, "part-0.csv", HEADER, 'H1,P1,"Ann, A.","1 ""Main"" St",LA,CA,,2026-01-31'.replace('""', '\\"'))
    put(folder, "part-1.csv", HEADER, '"","P2",  x ,a,b,c,"",2026-02-01')
    df = read_drop(spark, folder, HOLDERS, "2026-02-01")
    assert df.schema[:8].names == HOLDERS.columns
    found = {r["policy_id"]: r for r in df.collect()}
    assert found["P1"]["full_name"] == "Ann, A." and found["P1"]["address"] == '1 "Main" St'
    assert found["P1"]["zip"] is None
    # The date in the file is data, the run is what loads it.
    assert found["P1"]["runDate"] == "2026-01-31" and found["P1"]["_runDate"] == "2026-02-01"
    assert found["P1"]["_sourceFile"].endswith("part-0.csv") and found["P2"]["_sourceFile"].endswith("part-1.csv")
    assert found["P2"]["holder_id"] is None and found["P2"]["full_name"] == "  x "


def test_header_decides_names_and_files_must_agree(spark, tmp_path):
    turned = ["policy_id", "holder_id", *HOLDERS.columns[2:]]
    folder = str(tmp_path / "a")
    put(folder, "part-0.csv", ",".join(turned), "P1,H1,n,a,c,s,z,d")
    row = read_drop(spark, folder, HOLDERS, "2026-02-01").first()
    assert (row["holder_id"], row["policy_id"]) == ("H1", "P1")

    put(folder, "part-1.csv", HEADER, "H2,P2,n,a,c,s,z,d")
    with pytest.raises(Exception, match="(?i)header"):
        read_drop(spark, folder, HOLDERS, "2026-02-01").collect()


def test_missing_column_and_missing_folder(spark, tmp_path):
    put(str(tmp_path / "a"), "part-0.csv", "holder_id,policy_id", "H1,P1")
    with pytest.raises(ValueError, match="full_name"):
        read_drop(spark, str(tmp_path / "a"), HOLDERS, "2026-02-01")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_drop(spark, str(tmp_path / "none"), HOLDERS, "2026-02-01")


def test_copy_quotes_every_field_and_keeps_values(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    put(source + "/sub", "part-0.csv", "a,b,runDate", '" x ",,2026-02-01', '"q\\"q","c,d",""')
    put(source, "other.csv", "a,b,runDate", "not,copied,1")
    copy_drop(spark, source, target)
    expected = [(" x ", None, "2026-02-01"), ('q"q', "c,d", None)]
    assert rows(read_text(spark, target)) == sorted(expected, key=repr)
    parts = [f for f in os.listdir(target) if f.startswith("part-")]
    lines = [line for p in parts for line in open(f"{target}/{p}").read().splitlines()]
    assert lines[0] == '"a","b","runDate"' and '" x ","","2026-02-01"' in lines
    copy_drop(spark, source, target)
    assert len(rows(read_text(spark, target))) == 2


def part_files(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_snapshot_is_one_file_or_as_many_as_tasks(spark, tmp_path):
    df = spark.range(100).repartition(4)
    write_csv(df, str(tmp_path / "one"), one_file=True)
    assert len(part_files(tmp_path / "one")) == 1
    write_csv(df, str(tmp_path / "many"))
    assert len(part_files(tmp_path / "many")) == 4
    for name in ("one", "many"):
        assert sorted(int(r["id"]) for r in read_text(spark, str(tmp_path / name)).collect()) == list(range(100))
    write_csv(df.limit(1), str(tmp_path / "many"))
    assert read_text(spark, str(tmp_path / "many")).count() == 1


def test_write_drop_is_read_back(spark, tmp_path):
    text = as_strings(ENTITIES["payments"].typed)
    df = spark.createDataFrame([("A", "P", "1.50", "2026-02-01", "ACH", "2026-02-01")], text)
    write_drop(df, str(tmp_path), "payments", "2026-02-01")
    back = read_drop(spark, drop_path(str(tmp_path), "payments", "2026-02-01"), ENTITIES["payments"], "2026-02-01")
    assert tuple(back.first())[:6] == tuple(df.first())
