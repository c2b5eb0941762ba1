import gzip
import json
import zipfile

import pytest

from tariffa.schema import PRICE_COLUMNS
from tariffa.sources import files, mrf, tables

BOOK = [("repair", "49505", "procedure"), ("hyster", "742", "ms_drg"), ("birth", "560-1", "apr_drg")]


@pytest.fixture(scope="module")
def book(spark):
    return spark.createDataFrame(BOOK, "concept string, code string, code_family string")


def test_tall_csv(spark, tmp_path, book):
    path = tmp_path / "tall.csv"
    path.write_text(
        "﻿hospital_name,last_updated_on,version,location_name,license_number | TX,type_2_npi\r\n"
        "Own Hospital,1/2/2026,3.0.0,North | South,L-77,1234567890 | 1098765432\r\n"
        "description,code | 1,code|1|type,code|2,code|2|type,setting,standard_charge|gross,standard_charge|discounted_cash,payer_name,plan_name,standard_charge|negotiated_dollar,standard_charge|methodology,count,additional_generic_notes\r\n"
        'Hernia,49505,CPT,0742,MS-DRG,outpatient,"$1,200.50",900,Own Plan,Gold,750,fee schedule,1 through 10,"a note\nof two lines"\r\n'
        "Stay,742.0,DRG,742,MS-DRG,inpatient,20000,,Own Plan,,9000,case rate,,\r\n"
        "Other,99999,CPT,,,outpatient,1,1,Own Plan,,1,other,,\r\n"
        "Birth,560-1,,,,inpatient,1,1,P,,1,other,,\r\n"
        "Wrong type,49505,NDC,,,outpatient,1,1,P,,1,other,,\r\n"
    )
    rows = mrf.read_csv(spark, str(path), book, url="http://x/y.csv", file_id="f1").collect()
    assert rows[0].asDict().keys() == PRICE_COLUMNS.keys()
    got = sorted((r.description, r.concept, r.code, r.code_type, r.type_verified, r.gross, r.negotiated_dollar) for r in rows)
    assert got == [("Hernia", "hyster", "742", "MS-DRG", True, 1200.5, 750.0), ("Hernia", "repair", "49505", "CPT", True, 1200.5, 750.0), ("Stay", "hyster", "742", "MS-DRG", True, 20000.0, 9000.0)]
    one = next(r for r in rows if r.concept == "repair")
    assert (one.hospital_name, one.last_updated_on, one.license_state, one.license_number, one.type_2_npi, one["count"]) == ("Own Hospital", "2026-01-02", "TX", "L-77", "1234567890;1098765432", "1 through 10")
    assert one.notes.startswith("a note") and one.payer_name == "Own Plan" and one.plan_name == "Gold"


def test_wide_csv(spark, tmp_path, book):
    path = tmp_path / "wide.csv"
    path.write_text(
        "hospital_name,version\nH,3.0\n"
        "description,code|1,code|1|type,setting,standard_charge|gross,standard_charge|P1|Gold|negotiated_dollar,count|P1|Gold,standard_charge|P2|A|B|negotiated_percentage,additional_payer_notes|P2|A|B\n"
        "Hernia,49505,CPT,both,10,5,3,,\n"
        "Hernia 2,49505,CPT,both,10,,,40,own\n"
        "Bare,49505,CPT,both,12,,,,\n"
    )
    got = sorted((r.description, r.payer_name or "", r.plan_name or "", r.negotiated_dollar, r.negotiated_percentage, r["count"], r.notes) for r in mrf.read_csv(spark, str(path), book).collect())
    assert got == [("Bare", "", "", None, None, None, None), ("Hernia", "P1", "Gold", 5.0, None, "3", None), ("Hernia 2", "P2", "A|B", None, 40.0, None, "own")]


def test_csv_rejects(spark, tmp_path, book):
    path = tmp_path / "odd.csv"
    path.write_text(
        "hospital_name,version\nH,3.0\n"
        "description,code|1,code|1|type,setting,standard_charge|gross,payer_name,plan_name,standard_charge|negotiated_dollar\n"
        "Good,49505,CPT,both,10,P,Q,5\n"
        "Trailing commas,49505,CPT,both,10,P,Q,6,,\n"
        "Short,49505,CPT,both,12\n"
        "Shifted, by a comma,49505,CPT,both,10,P,Q,7\n"
    )
    got = sorted((r.description, r.gross, r.negotiated_dollar) for r in mrf.read_csv(spark, str(path), book).collect())
    assert got == [("Good", 10.0, 5.0), ("Short", 12.0, None), ("Trailing commas", 10.0, 6.0)]
    rejects = [r.cells for r in mrf.csv_rejects(spark, str(path)).collect()]
    assert [(c[0], c[8]) for c in rejects] == [("Shifted", "7")]


def test_json(spark, tmp_path, book):
    path = tmp_path / "a.json"
    path.write_text(json.dumps({
        "hospital_name": "H", "version": "3", "license_information": {"license_number": "1", "state": "CO"}, "type_2_npi": ["1234567890"],
        "standard_charge_information": [
            {"description": "D", "code_information": [{"code": 49505, "type": "CPT"}, {"code": "0742", "type": "MS-DRG"}], "standard_charges": [{"setting": "both", "gross_charge": 10, "payers_information": [{"payer_name": "P", "plan_name": "Q", "standard_charge_dollar": 4.5, "count": "12"}, {"payer_name": "R", "standard_charge_percentage": 30}]}, {"setting": "inpatient", "gross_charge": 11}]},
            {"description": "E", "code_information": [{"code": "1", "type": "CPT"}], "standard_charges": []},
        ],
    }))
    rows = mrf.read_json(spark, str(path), book).collect()
    got = sorted((r.concept, r.code, r.setting, r.payer_name or "", r.negotiated_dollar, r.negotiated_percentage, r.gross) for r in rows)
    assert got == [(c, k, s, p, d, q, g) for c, k in (("hyster", "742"), ("repair", "49505")) for s, p, d, q, g in (("both", "P", 4.5, None, 10.0), ("both", "R", None, 30.0, 10.0), ("inpatient", "", None, None, 11.0))]
    assert {r.license_state for r in rows} == {"CO"}


def test_probed(spark):
    text = '{"version": "3", "hospital_name": "A \\"B\\" é", "last_updated_on": "2026-01-02", "location_name": ["N", "S"], "license_information": {"license_number": "L1", "state": "CO"}, "type_2_npi": ["1234567890", "1098765432"], "standard_charge_information": [' + '{"description": "x", "version": "9"},' * 9000
    heads = "hospital_name,last_updated_on,version,license_number | TX,type_2_npi\nOwn,1/2/2026,3.0,L-7,1234567890\ndescription,code|1\nx,1\ny"
    rows = [("j", text.encode()), ("g", gzip.compress(text.encode())[:600]), ("c", heads.encode()), ("none", None), ("odd", b"<html>"), ("cut", b"hospital_name,ver")]
    got = {r.url: r for r in mrf.probed(spark.createDataFrame(rows, "url string, content binary")).collect()}
    for k in ("j", "g"):
        assert tuple(got[k])[1:] == ('A "B" é', "3", "2026-01-02", "N|S", "1234567890;1098765432", "L1", "CO")
    assert (got["c"].hospital_name, got["c"].file_version, got["c"].license_number, got["c"].license_state, got["c"].type_2_npi) == ("Own", "3.0", "L-7", "TX", "1234567890")
    assert all(set(tuple(got[k])[1:]) == {None} for k in ("none", "odd", "cut"))


def test_bytes(spark, tmp_path):
    assert files.encoding("é,1".encode("utf-16-le") * 20) == "utf-16-le" and files.encoding("plain é".encode()) == "utf-8" and files.encoding(b"caf\xe9 x") == "cp1252"
    assert files.decoded("é ".encode() + b"caf\xe9") == "é café"
    assert [files.content(x) for x in (b'{"a":1}', b"<!DOCTYPE html>", b"a,b", b"  ")] == ["json", "html", "csv", "empty"]
    packed = gzip.compress(b"a,b\n" * 1000)
    assert files.inflated(packed[:-9], 8) == b"a,b\na,b\n"
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("__MACOSX/x.csv", "no")
        z.writestr("x.csv", "a,b\n1,2")
        z.writestr("readme.md", "no")
    (tmp_path / "y.csv").write_bytes(b"caf\xe9")
    got = sorted((r.entry, r.kind, r.text) for r in files.texts(spark, [str(tmp_path / "x.zip"), str(tmp_path / "y.csv")]).collect())
    assert got == [("", "csv", "café"), ("x.csv", "csv", "a,b\n1,2")]


def test_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Facility ID,City/Town,City/Town\n01,NA,"x ""y"""\n')
    df = tables.text_csv(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["facility_id", "citytown", "citytown_2"] and [tuple(r) for r in df.collect()] == [("01", None, 'x "y"')]
    with pytest.raises(ValueError, match="lacks state"):
        tables.public_table(spark, str(tmp_path / "a.csv"), ["state"], "the roster")
    (tmp_path / "n.txt").write_text('"Notes"\t"County"\t"Births"\n\t"A"\t"1,200"\n\t"B"\tSuppressed\n"Total"\t\t"5"\n"---"\n"Dataset: Own"\n')
    rows, notes = tables.natality(spark, str(tmp_path / "n.txt"))
    assert [r.n for r in rows.select(tables.births(rows["births"]).alias("n")).collect()] == [1200.0, None] and tables.note_value(notes, "Dataset") == "Own"
    prices = spark.createDataFrame([("a", 1), ("b", 2)], "concept string, x int")
    tables.write_prices(prices, str(tmp_path / "p"))
    assert [r.x for r in tables.prices(spark, str(tmp_path / "p"), ["b"]).collect()] == [2]
