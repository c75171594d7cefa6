import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from roadevents.operators.normalize import normalize, rejects
from roadevents.schema import FIELDS
from roadevents.sources import archives, csv_files, envelope, parquet_files, tables

HEADER = ",".join(FIELDS)


def write(folder, name, text, encoding="utf-8"):
    file = folder / name
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_bytes(text.encode(encoding))
    return str(folder)


def line(**values):
    return ",".join(values.get(f, "") for f in FIELDS)


def test_json_one_response_per_file(spark, tmp_path):
    items = [{"type": "국도", "coordX": 126.5, "linkId": 9007199254740993}, {"message": 'a "q"\nb'}]
    write(tmp_path, "a.json", json.dumps({"body": {"items": items}}, indent=2))
    write(tmp_path, "b.json", json.dumps({"header": "error"}))
    write(tmp_path, "c.json", json.dumps({"body": {"items": []}}))
    rows = envelope.json_envelope(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r.seq for r in rows] == [0, 1]
    assert (rows[0].coordX, rows[0].linkId) == ("126.5", "9007199254740993")
    assert rows[1].message == 'a "q"\nb' and rows[1].type is None
    assert rows[0].file.endswith("a.json")


def test_json_one_response_per_line_and_partition_folders(spark, tmp_path):
    responses = [{"body": {"items": [{"type": str(i)}, {"type": "x"}]}} for i in range(3)]
    text = "\n".join(json.dumps(r) for r in responses)
    write(tmp_path, "ingestion_date=2024-02-01/a.json", text)
    df = envelope.json_envelope(spark, str(tmp_path), one_per_line=True)
    assert df.count() == 6 and {str(r.ingestion_date) for r in df.collect()} == {"2024-02-01"}


def test_csv_by_position_with_quotes_and_newlines(spark, tmp_path):
    message = '"a ""q"" b\nline2"'
    text = f"{HEADER}\n{line(type='국도', coordX='1', message=message)}\n"
    row = csv_files.csv_by_position(spark, write(tmp_path, "a.csv", text)).first()
    assert row.message == 'a "q" b\nline2' and row.type == "국도" and row.endDate is None


def test_csv_tells_empty_text_from_no_value(spark, tmp_path):
    text = 'type,coordX\n"",\n'
    folder = write(tmp_path, "a.csv", text)
    for headers in ("uniform", "per_file"):
        row = csv_files.csv_by_name(spark, folder, headers=headers).first()
        assert row.type == "" and row.coordX is None


def test_csv_position_and_name_differ_for_a_reordered_header(spark, tmp_path):
    folder = write(tmp_path, "a.csv", "COORDX,Type,unknown\n126.5,국도,z\n")
    by_position = csv_files.csv_by_position(spark, folder, ["type", "coordX"]).first()
    assert (by_position.type, by_position.coordX) == ("126.5", "국도")
    for headers in ("uniform", "per_file"):
        row = csv_files.csv_by_name(spark, folder, headers=headers).first()
        assert (row.type, row.coordX, row.roadName) == ("국도", "126.5", None)
        assert "unknown" not in row.asDict()


def test_differing_headers(spark, tmp_path):
    write(tmp_path, "day=1/a.csv", "type,coordX\nA,1\n")
    folder = write(tmp_path, "day=2/b.csv", "coordX,type\n2,B\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_files.csv_by_name(spark, folder).select("type", "coordX").collect()
    df = csv_files.csv_by_name(spark, folder, headers="per_file", partition_columns=["day"])
    assert sorted((r.type, r.coordX, r.day) for r in df.collect()) == [("A", "1", 1), ("B", "2", 2)]


def test_rows_with_a_wrong_number_of_values(spark, tmp_path):
    good = line(type="good", coordX="1")
    folder = write(tmp_path, "a.csv", f"{HEADER}\n{good}\nshort,x\n{good},surplus\n")
    marked = csv_files.csv_by_position(spark, folder)
    assert sorted(r.type for r in marked.collect()) == ["good", "good", "short"]
    per_file = csv_files.csv_by_name(spark, folder, headers="per_file")
    for df in (marked, per_file):
        assert [r.type for r in normalize(df).collect()] == ["good"]
        bad = rejects(df).collect()
        assert {r.reject_reason for r in bad} == {"column_count"}
        assert sorted(r.type for r in bad) == ["good", "short"]


def test_per_file_edge_cases(spark, tmp_path):
    write(tmp_path, "a.csv", "")
    write(tmp_path, "b.csv", "type,coordX\n")
    write(tmp_path, "c.csv", "﻿type,message\r\nBOM,\"x\ny\"\r\n")
    write(tmp_path, "d.txt", "type\nskipped\n")
    folder = write(tmp_path, "e.csv", "coordX\n5")
    rows = csv_files.csv_by_name(spark, folder, headers="per_file").collect()
    assert sorted((r.type, r.coordX, r.message) for r in rows if r.type) == [("BOM", None, "x\ny")]
    assert [r.coordX for r in rows if not r.type] == ["5"]


def test_values_of_many_megabytes(spark, tmp_path):
    large = "x" * 9_000_000 + "\n" + "y" * 100
    folder = write(tmp_path, "a.csv", f'type,message\nA,"{large}"\nB,short\n')
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        archive.write(tmp_path / "a.csv", "a.csv")
    per_file = csv_files.csv_by_name(spark, folder, headers="per_file")
    for df in (per_file, csv_files.csv_by_name(spark, folder), archives.zip_csv(spark, folder)):
        found = {r.type: r.message for r in df.select("type", "message").collect()}
        assert found == {"A": large, "B": "short"}


def test_wrong_counts_are_marked_everywhere(spark, tmp_path):
    text = "type,coordX\ngood,1\nshort\nlong,1,2\n"
    folder = write(tmp_path, "a.csv", text)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("a.csv", text)
    for df in (
        csv_files.csv_by_name(spark, folder),
        csv_files.csv_by_name(spark, folder, headers="per_file"),
        archives.zip_csv(spark, folder),
        archives.zip_csv(spark, folder, ["type", "coordX"], by="position"),
    ):
        bad = {r.type: r._corrupt_record is not None for r in df.collect()}
        assert bad == {"good": False, "short": True, "long": True}


def test_per_file_encoding(spark, tmp_path):
    folder = write(tmp_path, "a.csv", "type\n고속도로\n", encoding="cp949")
    df = csv_files.csv_by_name(spark, folder, headers="per_file", encoding="cp949")
    assert df.first().type == "고속도로"


def test_parquet_by_name_beside_the_csv(spark, tmp_path):
    frame = spark.createDataFrame([("nan", "1", "id")], "TYPE string, coordX string, unique_id string")
    frame.write.parquet(str(tmp_path / "d"))
    folder = write(tmp_path / "d", "original.csv", "type\nx\n")
    df = parquet_files.parquet_by_name(spark, folder)
    assert df.columns == list(FIELDS)
    assert (df.first().type, df.first().coordX, df.first().message) == ("nan", "1", None)
    cleaned = parquet_files.parquet_by_name(spark, folder, missing_text=("nan", "None"))
    assert cleaned.first().type is None


def test_zip_entries(spark, tmp_path):
    for name in ("a.zip", "b.zip"):
        with zipfile.ZipFile(tmp_path / name, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("in/one.csv", f"coordX,type\n1,{name}\n2,{name}\n")
            archive.writestr("two.csv", f"type\n{name}\n")
            archive.writestr("empty.csv", "")
            archive.writestr("notes.txt", "type\nno\n")
    rows = archives.zip_csv(spark, str(tmp_path)).collect()
    assert len(rows) == 6
    assert {(r.archive.rsplit("/", 1)[1], r.type) for r in rows} == {("a.zip",) * 2, ("b.zip",) * 2}
    assert {r.entry for r in rows} == {"in/one.csv", "two.csv"}
    by_position = archives.zip_csv(spark, str(tmp_path), ["a", "b"], by="position").collect()
    assert {r.a for r in by_position} == {"1", "2", "a.zip", "b.zip"}
    with pytest.raises(ValueError):
        archives.zip_csv(spark, str(tmp_path), by="x")


def test_partition_scan_reads_one_folder(spark, path):
    spark.sql("select 1 a, date'2024-01-01' ingestion_date union all select 2, date'2024-01-02'").write.partitionBy(
        "ingestion_date"
    ).parquet(path)
    day = tables.in_partition(tables.table(spark, path), "2024-01-02")
    assert [r.a for r in day.collect()] == [2]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan
    day.createOrReplaceTempView("one_day")
    assert tables.table(spark, "one_day").count() == 1


def test_archive_entries_are_dealt_to_tasks(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for i in range(40):
            archive.writestr(f"{i}.csv", f"type\n{i}\n")
    opens = spark.sparkContext.accumulator(0)

    def counted(path):
        opens.add(1)
        return open(path.removeprefix("file:"), "rb")

    found = archives.entries(spark, str(tmp_path), counted)
    assert sorted(r.entry for r in found.collect()) == sorted(f"{i}.csv" for i in range(40))
    assert opens.value == 1
    df = archives.zip_csv(spark, str(tmp_path), ["type"], open_file=counted)
    per_task = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 4 and sum(r["count"] for r in per_task) == 40


def test_archives_are_not_read_whole(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("first.csv", "type\nx\n")
        archive.writestr("large.bin", bytes(50_000_000))
    fetched = spark.sparkContext.accumulator(0)

    class Counted(io.FileIO):
        def readinto(self, buffer):
            n = super().readinto(buffer)
            fetched.add(n)
            return n

    open_file = lambda path: io.BufferedReader(Counted(path.removeprefix("file:")), 1 << 16)
    assert archives.zip_csv(spark, str(tmp_path), open_file=open_file).first().type == "x"
    assert 0 < fetched.value < 5_000_000


def test_differing_headers_in_one_scan(spark, tmp_path):
    for i in range(6):
        write(tmp_path, f"{i}.csv", ("type,coordX\nA,1\n", 'coordX,type\n2,"B,\nb"\n', "message\nC\n")[i % 3])
    df = csv_files.csv_by_name(spark, str(tmp_path), headers="per_file")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Union" not in plan
    found = sorted((r.type, r.coordX, r.message) for r in df.collect() if r.type)
    assert found == [("A", "1", None)] * 2 + [("B,\nb", "2", None)] * 2
    assert df.where("message = 'C'").count() == 2


def test_one_value_too_many_for_every_header(spark, tmp_path):
    folder = write(tmp_path, "a.csv", 'type,coordX\nA,1\n"x ""q"" y",,"z,z"\n')
    rows = csv_files.csv_by_name(spark, folder, headers="per_file").collect()
    assert [(r.type, r._corrupt_record is None) for r in rows] == [("A", True), ('x "q" y', False)]


def test_paths_with_odd_characters(spark, tmp_path):
    folder = write(tmp_path, "day 1/50%+ü.csv", "type\nA\n")
    assert csv_files.csv_by_name(spark, folder + "/*", headers="per_file").first().type == "A"
    file = str(tmp_path / "day 1" / "50%+ü.csv")
    assert csv_files.csv_by_position(spark, file, ["type"]).first().type == "A"
