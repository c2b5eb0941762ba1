"""Codes, types, identifiers, names, URLs, payers, labels: listed inputs and the values that they must give."""

import pytest
from pyspark.sql import functions as F

from tariffa.functions import labels, rules
from tariffa.functions import numbers as nu
from tariffa.functions import rules as ru
from tariffa.functions import text as tx
from tariffa.operators import ownership as ow
from tariffa.sources import downloads

CASES = {}


def cases(name, f, rows, kind=None):
    CASES[name] = f, rows


cases("ccn_cases", tx.ccn, [
    ("60011", "060011"), ("060011", "060011"), ("22007401", "220074"), ("220083A", "220083"), ("330125001", "330125"), ("7003301", "070033"), ("01014F", "01014F"),
    ("06S011", "06S011"), ("06S01101", "06S011"), (" 450097 ", "450097"), ("450097.0", "450097"), ("\t10001\t", "010001"), ("", None), (None, None),
])
cases("parent_ccn_cases", tx.parent_ccn, [
    ("06S011", "060011"), ("06T011", "060011"), ("45U097", "450097"), ("17M320", "171320"), ("33R123", "331123"), ("04Z304", "041304"), ("45W200", "452200"), ("45Y025", "453025"),
    ("050W12", "050W12"), ("060011", "060011"), ("01014F", "01014F"), (None, None),
])
cases("apr_cases", tx.apr_drg_code, [
    ("560-1", "560-1"), ("560.1", "560-1"), ("560 1", "560-1"), ("560_1", "560-1"), ("5601", "560-1"), ("560 SOI 1", "560-1"), ("560 Severity 4", "560-4"), ("APR-DRG 560-1", "560-1"),
    ("aprdrg 560", "560"), ("60-1", "060-1"), ("5609", "5609"), ("05601", "05601"), ("560-5", "560-5"), ("40", "040"), ("560.0", "560"), ("ABC", "ABC"), (None, None),
])
cases("drg_cases", tx.drg_code, [("0742", "742"), ("742", "742"), ("742.0", "742"), (" 743 ", "743"), ("7", "007"), ("0007", "007"), ("1000", "1000"), ("000", "000"), ("A42", "A42"), (None, None)])
cases("procedure_cases", tx.procedure_code, [(" 58100 ", "58100"), ("g0121", "G0121"), ("58100.0", "58100"), ("58100.05", "58100.05"), (None, None)])
cases("code_type_cases", tx.code_type_fit, [
    ("CPT", "procedure", "verified"), ("hcpcs", "procedure", "verified"), ("cpt hcpcs", "procedure", "verified"), ("HCPCS_CPT", "procedure", "verified"), ("CPT/HCPCS", "procedure", "verified"),
    ("CDM", "procedure", "incompatible"), ("RC", "procedure", "incompatible"), (None, "procedure", "unverified"), (" ", "procedure", "unverified"), ("DRG", "procedure", "incompatible"),
    ("MS-DRG", "ms_drg", "verified"), ("ms drg", "ms_drg", "verified"), ("DRG", "ms_drg", "unverified"), ("APR-DRG", "ms_drg", "incompatible"), (None, "ms_drg", "unverified"),
    ("APR-DRG", "apr_drg", "verified"), ("3M APR DRG", "apr_drg", "verified"), ("apr_drgs", "apr_drg", "verified"), ("DRG", "apr_drg", "incompatible"), (None, "apr_drg", "incompatible"),
])
cases("url_key_cases", tx.url_key, [
    ("https://www.Example.org/files/1_A_standardcharges.csv?v=2", "example.org/files/1_A_standardcharges.csv"), ("http://example.org/files/1_A_standardcharges.csv/", "example.org/files/1_A_standardcharges.csv"),
    ("https://example.org/files/1%20A.csv", "example.org/files/1 A.csv"), ("https://b.s3.host.com/f/1.bin?X-Amz-Signature=a&X-Amz-Expires=600", "b.s3.host.com/f/1.bin"),
    ("https://store.blob.host.net/f/1?sv=2022-11-02&se=2026&sig=x", "store.blob.host.net/f/1"), ("https://host.com/get?token=1", "host.com/get"), ("https://host.com/get?Policy=1", "host.com/get"),
    ("https://host.com/download.aspx?pi=111", "host.com/download.aspx?pi=111"), ("https://host.com/dir/?pi=1", "host.com/dir?pi=1"), ("HTTP://WWW.Host.COM/", "host.com"), ("host.com/a#b?c", "host.com/a"),
    ("host.com/A.ZIP?x=1", "host.com/A.ZIP"), ("", None), (None, None),
])
cases("payer_type_cases", rules.payer_type, [
    ("Aetna", "PPO", "commercial"), ("Medicare", None, "medicare"), ("Humana", "Medicare Advantage HMO", "medicare_advantage"), ("Anthem BCBS VA", None, "commercial"), ("VA", None, "tricare_va"),
    ("VA Community Care", None, "tricare_va"), ("Humana Military", "TRICARE", "tricare_va"), ("Optum VA", None, "tricare_va"), ("Progressive Auto", None, "workers_comp"), ("Anthem BCBS", "Anthem IN Work Comp", "workers_comp"),
    ("Ambetter from Sunshine Health", None, "exchange"), ("Molina", "HIX", "exchange"), ("Molina", "MCR", "medicare_advantage"), ("Molina", "Chip KM", "medicaid"), ("Amerigroup", None, "medicaid"),
    ("Health Net Community Solutions", "Medi-Cal", "medicaid"), ("Medical Mutual Medicare", "Medicare", "medicare_advantage"), ("HRSA Uninsured Testing", None, "other"), ("Uninsured", None, "self_pay"),
    ("BCBS Medicare Supplement", None, "medicare"), ("Paramount Advantage", None, "medicaid"), ("BCBS", "BlueAdvantageHMO", "commercial"), ("Kaiser", "Senior Advantage", "medicare_advantage"),
    ("MEDICARE_PART_B_CLAIMS", "PARTBMCR", "medicare"), ("CareSource", "Ohio Medicaid", "medicaid"), ("ConnectiCare", None, "commercial"), ("Some Club", None, "other"), (" ", "", "unknown"), (None, None, "unknown"),
])
cases("explicit_type_cases", rules.explicit_type, [
    ("humana medicare advantage hmo", "medicare_advantage"), ("united healthcare managed medicaid", "medicaid"), ("humana military tricare", "tricare_va"), ("aetna ppo", None), ("medicare", "medicare"),
    ("bcbs medicare supplement", "medicare"), ('"Medicare"', "medicare"), ("workers comp fund", "workers_comp"), ("Texas STAR Plus", "medicaid"), (None, None),
])
cases("label_map_cases", lambda x: rules.comparable_type(rules.labelled_type(x)), [("Managed Medicaid", "medicaid"), ("Marketplace", "commercial"), (" Workers  Compensation", "workers_comp"), ("VA", "tricare_va"), ("Self Pay", "self_pay"), ("Odd Label", "unmapped: odd label"), (None, None)])
cases("name_token_cases", lambda x: F.array_join(F.array_sort(tx.name_tokens(x)), " "), [
    ("St. Mary's Reg Med Ctr", "marys regional st"), ("SAINT MARYS REGIONAL MEDICAL CENTER, INC.", "marys regional st"), ("The Childrens Hosp of Denver", "children denver"),
    ("Mount Sinai Univ. Hospitals LLC", "mt sinai university"), ("Cmty Gen Hlth", "community general"), ("Ortho & Spine", "orthopedic spine"), ("Hospital", ""), (None, None),
])
cases("street_cases", tx.street, [
    ("777 Bannock Street", "777 bannock st"), ("1 North Fork Parkway, Suite 5", "1 n fork pkwy ste 5"), ("9 Oak Court Northeast", "9 oak ct ne"), ("12 Place Circle", "12 pl cir"), ("40 Route 9", "40 rt 9"), (None, None),
])
cases("city_cases", tx.city, [("Saint Louis", "st louis"), ("FORT WORTH", "ft worth"), ("Mount  Vernon", "mt vernon"), ("St. Paul", "st paul"), ("", None), (None, None)])
cases("zip_cases", tx.zip_key, [("80204", "80204"), ("80204-1234", "80204"), ("777 Bannock St, Denver, CO 80204", "80204"), ("777 Bannock St, Denver, CO 80204-0001 ", "80204"), ("80204 Elm St", None), ("", None), (None, None)])
cases("license_cases", tx.license_key, [("000123-A", "123A"), ("TX 0045", "TX0045"), ("0", "0"), ("--", None), (None, None)])
cases("split_cases", lambda x: F.array_join(tx.parts(x), "/"), [("a | b;c", "a/b/c"), (" a ", "a"), ("a||b;", "a/b"), ("", ""), (None, None)])
cases("quote_cases", tx.unquoted, [('"a"', "a"), ('  "a b" ', "a b"), ('""', None), ("a", "a"), (None, None)])
cases("state_cases", lambda x, y: tx.state(x, y, ["TX", "CO"]), [("tx", None, "TX"), ("ZZ", "1 Main, Denver, CO 80204", "CO"), (None, "1 Main, Denver, ny 10001", None), (None, None, None)])
cases("note_cases", lambda x, y: tx.notes(x, y), [("a", "b", "a || b"), (" ", "b", "b"), ("", None, None), (None, None, None)])
cases("robots_cases", lambda x, y: F.regexp_like(y, tx.robots_regex(x)), [
    ("/a", "/a/b", True), ("/a$", "/a/b", False), ("/*.csv$", "/x/y.csv", True), ("/*.csv$", "/x/y.csv?z", False), ("/a.b", "/axb", False), ("/", "/anything", True),
], "BOOLEAN")
cases("similarity_cases", lambda x, y, z: F.round(nu.similarity(x.cast("double"), y.cast("double"), z.cast("double")), 6), [
    ("1", "1", "1", 1.0), ("0.5", None, None, 0.5), ("1", "0", None, 0.588235), ("0.8", "0.6", "1", 0.76), ("0.4", None, "1", 0.538462),
], "DOUBLE")
cases("suppressed_cases", lambda x: nu.money(x), [("$1,234.50", 1234.5), ("12%", 12.0), ("Suppressed", None), ("", None), (None, None)], "DOUBLE")
cases("region_cases", labels.region, [("TX", "South"), ("DC", "South"), ("NY", "Northeast"), ("OH", "Midwest"), ("HI", "West"), ("PR", None), (None, None)])
cases("state_name_cases", labels.state_name, [("TX", "Texas"), ("DC", "District of Columbia"), ("NH", "New Hampshire"), ("PR", None), (None, None)])
cases("fips_cases", labels.fips_state, [("01001", "AL"), ("02", "AK"), ("04", "AZ"), ("06037", "CA"), ("11001", "DC"), ("15", "HI"), ("36061", "NY"), ("45", "SC"), ("53", "WA"), ("56", "WY"), ("72001", "PR"), ("03", None), (None, None)])
cases("payer_label_cases", labels.payer_label, [("self_pay_cash", "Cash price"), ("medicare_advantage", "Medicare Advantage"), ("other", None)])
cases("utc_cases", lambda x: labels.utc_timestamp(x.cast("timestamp")), [("2026-01-02 03:04:05+02:00", "2026-01-02T01:04:05Z"), ("2026-01-02 03:04:05Z", "2026-01-02T03:04:05Z"), (None, None)])
cases("bed_band_cases", lambda x: ru.bed_band(x.try_cast("double")), [("0", "<100"), ("99", "<100"), ("100", "100-299"), ("299", "100-299"), ("300", "300+"), ("many", "unknown"), (None, "unknown")])
cases("roster_group_cases", ow.roster_group, [("Voluntary non-profit - Private", "nonprofit"), ("Proprietary", "for_profit_non_pe"), ("Physician", "for_profit_non_pe"), ("Government - Local", "government"), ("Veterans Health Administration", "government"), ("Department of Defense", "government"), ("Tribal", "government"), ("", "unknown"), (None, "unknown")])
cases("extension_cases", downloads.url_extension, [("https://h.org/a.csv?x=1", ".csv"), ("https://h.org/a.CSV.gz", ".csv.gz"), ("https://h.org/a.b.zip#c", ".zip"), ("https://h.org/get", ""), (None, None)])
cases("stem_cases", lambda x: F.substring(downloads.file_stem(x), 13, 80), [("https://h.org/a/My%20File_standardcharges.csv?x=1", "_My_File_standardcharges"), ("https://h.org/a/b.json.gz", "_b"), ("https://h.org/", "_h.org"), ("https://h.org/x%zz.csv", "_x_zz")])
cases("encode_cases", downloads.encoded_url, [(" https://h.org/a b[1].csv ", "https://h.org/a%20b%5B1%5D.csv"), ("https://h.org/a", "https://h.org/a"), (None, None)])
cases("tls_cases", downloads.is_tls_error, [("SSL certificate problem", True), ("TLS handshake failed", True), ("timed out", False), (None, False)], "BOOLEAN")


@pytest.mark.parametrize("name", CASES)
def test_listed(spark, name):
    f, rows = CASES[name]
    xs = [f"x{i}" for i in range(len(rows[0]) - 1)]
    given = spark.createDataFrame([(i, *r[:-1]) for i, r in enumerate(rows)], "i int, " + ", ".join(f"{x} string" for x in xs))
    assert [r.y for r in given.select("i", f(*map(F.col, xs)).alias("y")).orderBy("i").collect()] == [r[-1] for r in rows]
