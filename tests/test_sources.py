"""File formats, with small files written by the tests."""

import csv
import json
from collections import Counter

import pytest

from peerglass.operators import documents as docs
from peerglass.operators import records as R
from peerglass.sources import delimited as dl
from peerglass.sources import documents as src
from peerglass.sources.files import list_files

WANTED = {"name": ["산업내용"], "code": ["산업분류코드", "산업코드"]}
TEXT = "산업코드, 산업내용 ,산업분류코드\n01,작물 재배업,A00011\n02,임업,A00020\n"


@pytest.mark.parametrize("encoding", ["utf-8-sig", "utf-8", "cp949", "euc-kr"])
def test_first_encoding_that_fits(spark, tmp_path, encoding):
    path = tmp_path / "codes.csv"
    path.write_bytes(TEXT.encode(encoding))
    rows = dl.read_delimited(spark, str(path), WANTED).orderBy("code").collect()
    assert [tuple(r) for r in rows] == [("작물 재배업", "A00011"), ("임업", "A00020")]


def test_second_choice_header_and_missing_column(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_bytes("산업코드,산업내용\n01,임업\n".encode("cp949"))
    assert dl.read_delimited(spark, str(path), WANTED).first().code == "01"
    path.write_bytes("산업내용\n임업\n".encode("cp949"))
    with pytest.raises(ValueError):
        dl.read_delimited(spark, str(path), WANTED)


QUOTED = [["plain", "1"], ["two\nlines", "2"], ['say ""hi"", then', "3"], ["a,b\r\n\r\n c", "4"], ["", "5"], ['"', "6"], ["가\n나\n다", "7"],
          ["\n", "8"], ["end", "9"], ['""\n""', "10"], ["x", "\n11\n"]]


@pytest.mark.parametrize("encoding", ["utf-8", "cp949"])
@pytest.mark.parametrize("split", [64, 150, 1 << 20])
def test_quoted_fields_over_splits_of_any_size(spark, tmp_path, encoding, split):
    """Line breaks and doubled quotes inside fields, whatever part of the file a task gets."""
    rows = QUOTED * 3
    for number in range(2):
        with open(tmp_path / f"f{number}.csv", "w", encoding=encoding, newline="") as out:
            writer = csv.writer(out, lineterminator="\r\n" if number else "\n")
            writer.writerow(["이름", "번호 코드", "파일"])
            writer.writerows([a, b, f"f{number}"] for a, b in rows)
    conf = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        read = dl.read_delimited(spark, str(tmp_path), {"name": ["이름"], "code": ["코드"], "file": ["파일"]})
        got = Counter(tuple(r) for r in read.collect())
        if split == 64:
            assert dl.split_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        for key in conf:
            spark.conf.unset(key)
    # white space around a value goes and an empty one is null, as in the rows read before
    want = Counter((a.strip(" ") or None, b.strip(" "), f"f{n}") for n in range(2) for a, b in rows)
    assert got == want


def test_a_replacement_character_in_the_text_is_text(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_bytes("산업내용,산업코드\n임\ufffd업,01\n".encode())
    assert dl.read_delimited(spark, str(path), WANTED).first().name == "임\ufffd업"
    path.write_bytes("산업내용,산업코드\n임업,01\n".encode("cp949") + b"\xff\xff,02\n")
    with pytest.raises(ValueError):
        dl.read_delimited(spark, str(path), WANTED)


def test_cp949_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("가나다", "005930")], "`회사명` string, `종목코드` string")
    dl.write_delimited(df.coalesce(1), str(tmp_path / "out"))
    data = next((tmp_path / "out").glob("*.csv")).read_bytes()
    assert data.decode("cp949").splitlines() == ["회사명,종목코드", "가나다,005930"]
    back = dl.read_delimited(spark, str(tmp_path / "out"), {"company": ["회사명"], "code": ["종목코드"]})
    assert tuple(back.first()) == ("가나다", "005930")
    quoted = spark.createDataFrame([('가 "나"\n다, 라', "1")], "`회사명` string, `종목코드` string")
    dl.write_delimited(quoted, str(tmp_path / "quoted"))
    back = dl.read_delimited(spark, str(tmp_path / "quoted"), {"company": ["회사명"], "code": ["종목코드"]})
    assert [tuple(r) for r in back.collect()] == [('가 "나"\n다, 라', "1")]


def test_documents_round_trip_and_error_filter(spark, tmp_path):
    good, bad = {"a": 1, "한": None}, {"error": 500}
    (tmp_path / "가나 1+1 5%20_final.json").write_text(json.dumps(good, ensure_ascii=False, indent=1))
    (tmp_path / "Beta_final.json").write_text(json.dumps(bad))
    (tmp_path / "other.json").write_text("{}")
    read = src.read_documents(spark, str(tmp_path), "*_final.json", "_final.json")
    assert sorted(r.name for r in read.collect()) == ["Beta", "가나 1+1 5%20"]
    valid = src.valid_documents(read).collect()
    assert [r.name for r in valid] == ["가나 1+1 5%20"] and json.loads(valid[0].text) == good


AWKWARD = ["Acme", "가나 (주)", "a/b\\c", "5%20+1", ".hidden", "_under", "x_final.json", "A&B, Inc.", "q?*:|<>\"#[]{}", "e\u0301 é", "tab\there", " lead"]


def test_documents_of_awkward_names_come_back(spark, tmp_path):
    rows = [(name, i, None if i % 2 else "텍스트\n2") for i, name in enumerate(AWKWARD)]
    path = str(tmp_path / "out dir")
    df = spark.createDataFrame(rows, "company string, a int, b string").repartition(5)
    src.write_documents(df, path)
    files = sorted(p.name for p in (tmp_path / "out dir").iterdir())
    assert len(files) == len(rows) and all(f.endswith("_final.json") for f in files)
    back = src.read_documents(spark, path, encoded=True)
    assert {r.name: json.loads(r.text) for r in back.collect()} == {n: {"a": a, "b": b} for n, a, b in rows}
    src.write_documents(df.filter("a < 3"), path)  # replaces all
    assert src.read_documents(spark, path, encoded=True).count() == 3
    src.write_documents(df.filter("a = 5"), path, mode="append")
    assert sorted(r.name for r in src.read_documents(spark, path, encoded=True).collect()) == sorted([*AWKWARD[:3], AWKWARD[5]])


@pytest.mark.parametrize("bad", ["", None, "n" * 300, "Acme"])
def test_a_failed_write_leaves_nothing(spark, tmp_path, bad):
    """A name that makes no file, or two documents of one company: what was there before stays, nothing is added."""
    path = str(tmp_path / "out")
    src.write_documents(spark.createDataFrame([("Old", 1)], "company string, a int"), path)
    rows = [("Acme", 1), ("Beta", 2), (bad, 3)]
    with pytest.raises(Exception):
        src.write_documents(spark.createDataFrame(rows, "company string, a int").repartition(3), path)
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["Old_final.json"]


def test_list_files_and_inventory(spark, tmp_path):
    (tmp_path / "가나").mkdir()
    (tmp_path / "가나" / "IR 자료+5%20.pdf").write_bytes(b"123")
    (tmp_path / "Beta IR 2024.pdf").write_bytes(b"1")
    listing = list_files(spark, str(tmp_path))
    assert {(r.path, r.length) for r in listing.collect()} == {("가나/IR 자료+5%20.pdf", 3), ("Beta IR 2024.pdf", 1)}
    assert {r.company for r in docs.file_inventory(listing).collect()} == {"가나", "Beta"}


def test_malformed_payload_keeps_its_text(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "<html>")], "i int, body string")
    got = [tuple(r) for r in src.parse_json_keep_raw(df, "body", "k bigint").orderBy("i").collect()]
    assert got == [(1, 5, None, False), (2, None, "<html>", True)]


def test_business_mix_lines_to_wide(spark, tmp_path):
    rows = [{"corp_code": "1", "business_mix": {"Z": 60.0, "A, Inc.": 40.0}, "debug": {"status": "ok"}},
            {"corp_code": "2", "business_mix": {}, "debug": {"status": "fail", "reason": "none"}}]
    path = tmp_path / "mix.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in rows))
    mix = src.read_jsonl(spark, str(path))
    wide = R.mix_wide(R.mix_long(mix.select("corp_code", "business_mix")), ["corp_code"], ["Z", "A, Inc."])
    assert wide.columns == ["corp_code", "A, Inc.", "Z"]
    assert sorted(tuple(r) for r in wide.collect()) == [("1", 40.0, 60.0), ("2", None, None)]
    src.write_jsonl(mix, str(tmp_path / "again"))
    assert src.read_jsonl(spark, str(tmp_path / "again")).count() == 2


def test_manifest(spark, tmp_path):
    files = [{"name": f"f{i:02d}.xml", "ext": ".xml", "size": i, "compress_size": 1} for i in range(12)]
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps({"raw_root": "r", "items": [{"zip_path": "r\\1\\2\\2.zip", "file_count": 12, "files": files,
                                                             "corp_code": "1", "rcept_no": "2"}]}, indent=1))
    flat = docs.manifest_files(src.read_manifest(spark, str(path)))
    top = docs.manifest_candidates(flat, archive="zip_path").orderBy("rank").collect()
    assert [r.name for r in top] == [f"f{i:02d}.xml" for i in range(11, 1, -1)] and top[0].file_count == 12
