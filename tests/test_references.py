import json

import pytest
from pyspark.sql import functions as F

from tariffa.operators import medicare, scenarios
from tariffa.sources import lake, mrf


def test_weights_amounts_and_rates(spark, tmp_path):
    weights = tmp_path / "Table 5.txt"
    weights.write_bytes("Preamble é\r\nMS-DRG\tFINAL\tMS-DRG  Title\tWeights - 10% Cap Applied\tGeometric mean LOS\r\n1\tNo\tHeart\t28.5\t30.1\r\n788\tYes\tCesarean\t0.9\tN/A\r\n999\tNo\tNone\t\t1\r\nFootnote\t\t\t1\t1\r\n".encode("latin-1"))
    got = sorted((r.code, r.title, r.weight, r.gmlos) for r in medicare.drg_weights(spark, str(weights)).collect())
    assert got == [("001", "Heart", 28.5, 30.1), ("788", "Cesarean", 0.9, None)]
    amounts = tmp_path / "Tables 1A - 1E.txt"
    amounts.write_text('"TABLE 1A. NATIONAL"\nLabor\tOther\n$4,478.10\t$2,146.01\t$9.99\nTABLE 1B.\n$4,100.00\t$2,524.11\nTABLE 1C.\n$1.00\nTABLE 1D. CAPITAL\nRate\n$512.14\n')
    assert tuple(medicare.standard_amounts(spark, str(amounts)).first()) == (4478.10, 2146.01, 4100.0, 2524.11, 512.14)
    addendum = tmp_path / "addendum.csv"
    addendum.write_text('Some title,,,\n\nHCPCS Code,Short Descriptor,SI,APC,Relative Weight,Payment Rate\n58100,"Biopsy, uterus",T,5411,2.5,"$1,234.50"\n58300,Insert iud,E1,,,\n58100,again,N,,,\nNote: x,,,,,\n')
    got = {r.code: (r.short_descriptor, r.status_indicator, r.apc, r.payment_rate) for r in medicare.outpatient_rates(spark, str(addendum)).collect()}
    assert got == {"58100": ("Biopsy, uterus", "T", "5411", 1234.5), "58300": ("Insert iud", "E1", None, None)}
    for f in (medicare.drg_weights, medicare.outpatient_rates):
        with pytest.raises(ValueError):
            f(spark, str(amounts))


def test_delivery_and_rural_index(spark):
    rows = [("60011", "SM_7", "Yes"), ("060012", "SM_7", "No"), ("060013", "SM_7", "Not Applicable (none)"), ("060014", "SM_7", "Not Available"), ("060015", "PC_02", "Yes")]
    got = {r.ccn: (r.provides_ld, r.birthing_friendly) for r in medicare.delivery_status(spark.createDataFrame(rows, "`Facility ID` string, `Measure ID` string, Score string")).collect()}
    assert got == {"060011": (True, True), "060012": (True, False), "060013": (False, False), "060014": (None, False)}
    table = spark.createDataFrame([("01", " TX ", "0.85"), ("12345", "TX", "1.2"), ("02", "CO", "n/a")], "cbsa string, state string, wage_index string")
    assert [tuple(r) for r in medicare.rural_index(table).collect()] == [("TX", 0.85)]


def test_parameters_and_cases(spark):
    cases = scenarios.case_table(spark)
    assert cases.count() == 9 and cases.where("base_variant").count() == 2 and cases.select("variant").distinct().count() == 9
    row = {c: None for c in scenarios.PARAMETER_COLUMNS} | {"parameter": "a", "base_value": "2", "low_value": "1"}
    schema = ", ".join(f"{c} string" for c in scenarios.PARAMETER_COLUMNS)
    table = spark.createDataFrame([tuple(row.values())], schema)
    good = scenarios.checked_parameters(table)
    assert [tuple(r) for r in scenarios.scenario(good, "low").unionByName(scenarios.scenario(good, "high")).collect()] == [("low", "a", 1.0), ("high", "a", 2.0)]
    for bad in (table.drop("unit"), table.unionByName(table), table.withColumn("base_value", F.lit("x"))):
        with pytest.raises(ValueError):
            scenarios.checked_parameters(bad)


def test_json_keeps_equal_charges(spark, tmp_path):
    payer = {"payer_name": "Own", "plan_name": "Gold", "standard_charge_dollar": 10}
    charge = {"setting": "outpatient", "gross_charge": 20, "payers_information": [payer, payer]}
    item = {"description": "Biopsy", "code_information": [{"code": "58100", "type": "CPT"}, {"code": "58100", "type": "HCPCS"}], "standard_charges": [charge, charge]}
    other = item | {"code_information": [{"code": "99999", "type": "CPT"}]}
    path = tmp_path / "f.json"
    path.write_text(json.dumps({"hospital_name": "H", "version": "3.0", "standard_charge_information": [item, other, item | {"standard_charges": [{"setting": "both"}]}]}))
    book = spark.createDataFrame([("emb", "58100", "procedure")], "concept string, code string, code_family string")
    rows = mrf.read_json(spark, str(path), book).collect()
    assert sorted((r.code_type, r.negotiated_dollar or 0, r.setting) for r in rows) == [("CPT", 0, "both")] + [("CPT", 10.0, "outpatient")] * 4


def test_lake_folder(spark, tmp_path):
    lines = [(1, "A", "x", "58100", None, None, "5601", "apr-drg", 5.0), (1, "A", "x", "58100", None, None, "5601", "apr-drg", 5.0), (2, "B", "y", None, "g0121", "742", None, None, 7.0), (3, "C", "z", "1", None, None, None, None, 9.0)]
    details = spark.createDataFrame(lines, "hospital_id int, payer_name string, plan_name string, cpt string, hcpcs string, ms_drg string, other_code1 string, other_code1_type string, standard_charge_dollar double")
    hospitals = spark.createDataFrame([(1, "One", "http://h.org/a.csv", "Not provided"), (2, "Two", "http://h.org/b.csv", " "), (3, "Three", "https://www.h.org/a.csv", "TX")], "hospital_id int, hospital_name string, mrf_url string, state string")
    details.write.parquet(str(tmp_path / "lake" / "standard_charge_details"))
    hospitals.write.parquet(str(tmp_path / "lake" / "hospitals.parquet"))
    tables = lake.attach(spark, str(tmp_path / "lake"))
    rel = lake.relations(tables)
    assert (rel.key, rel.table_name, rel.versions, set(tables)) == ("hospital_id", "standard_charge_details", None, {"standard_charge_details", "hospitals"})
    book = [("emb", "58100", "procedure"), ("screening", "G0121", "procedure"), ("hysterectomy", "742", "ms_drg"), ("birth", "560-1", "apr_drg")]
    for _ in range(2):  # the second time the stage is there
        rows = lake.extract(spark, str(tmp_path / "lake"), book, str(tmp_path / "out")).collect()
        assert sorted((r.payer_name, r.code, r.code_type, r.negotiated_dollar) for r in rows) == [("A", "560-1", "APR-DRG", 5.0)] * 2 + [("A", "58100", "CPT", 5.0)] * 2 + [("B", "742", "MS-DRG", 7.0), ("B", "G0121", "HCPCS", 7.0)]
    files = {r.hospital_name: (r.mrf_file_id, r.state) for r in spark.read.parquet(str(tmp_path / "out" / "facilities")).collect()}
    assert files["One"][0] == files["Three"][0] != files["Two"][0] and files["One"][1] is None and files["Three"][1] == "TX"
    with pytest.raises(ValueError):
        lake.relations({"hospitals": hospitals})
