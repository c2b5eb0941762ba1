"""Registered queries over hard spellings of codes, types, identifiers, names, URLs and payers.

Each row of `events` takes one of a query's forms, by its event_id, with the form's holes filled from the id: numbers,
digits, a made-up word, blanks. SQL fills the same holes of the expected value's form, so it knows nothing of the rule.
`tests/test_cases.py` has fixed lists beside them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tariffa.functions import numbers as nu
from tariffa.functions import rules
from tariffa.functions import text as tx
from tariffa.plans.catalog import ORACLE_SQL, QUERIES, t

_LETTERS = "bcdfghjklm"
_WORD = f"'zu' || translate(event_id::STRING, '0123456789', '{_LETTERS}')"
#: Holes of a form, in SQL: four and three digits, a digit above 0, one of 1 to 4, a word in lower and upper case, one to three blanks.
HOLES = {
    "{c}": "lpad((event_id % 10000)::STRING, 4, '0')",
    "{b}": "lpad((event_id % 1000)::STRING, 3, '0')",
    "{d}": "(event_id % 9 + 1)::STRING",
    "{s}": "((event_id % 28 - event_id % 7) / 7 + 1)::INT::STRING",
    "{w}": _WORD,
    "{W}": f"upper({_WORD})",
    "{e}": "repeat(' ', (event_id % 3 + 1)::INT)",
}


def _sql(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def cases(name: str, f: Callable[..., Column], forms: list[tuple], kind: str = "VARCHAR") -> None:
    """Registers a query: the form's inputs for each row, and f of them. forms: inputs, and last the expected value, all with holes."""
    n = len(forms[0]) - 1
    xs = [f"x{i}" for i in range(n)]
    used = [[h for h in HOLES if any(h in str(r[i]) for r in forms)] for i in range(n + 1)]

    def run(spark, sf):
        def filled(i: int) -> Column:
            x = F.element_at(F.array(*(F.lit(r[i]).cast("string") for r in forms)), (F.col("event_id") % len(forms) + 1).cast("int"))
            for h in used[i]:
                x = F.replace(x, F.lit(h), F.expr(HOLES[h]))
            return x

        return t(spark, sf, "events").select("event_id", *(filled(i).alias(x) for i, x in enumerate(xs))).withColumn("y", f(*map(F.col, xs)))

    def filled_sql(i: int, x: str) -> str:
        for h in used[i]:
            x = f"replace({x}, '{h}', {HOLES[h]})"
        return x

    run.__name__ = name
    QUERIES[name] = run
    listed = ", ".join(f"({i}, {', '.join(map(_sql, r))})" for i, r in enumerate(forms))
    given = ", ".join(f"{filled_sql(i, f'v.{x}::VARCHAR')} AS {x}" for i, x in enumerate(xs))
    ORACLE_SQL[name] = f"SELECT event_id, {given}, {filled_sql(n, 'v.y::VARCHAR')}::{kind} AS y FROM events JOIN (VALUES {listed}) AS v(i, {', '.join(xs)}, y) ON event_id % {len(forms)} = v.i"


cases("ccn_cases", tx.ccn, [
    ("6{c}", "06{c}"), ("06{c}", "06{c}"), ("22{c}01", "22{c}"), ("22{c}A", "22{c}"), ("33{c}001", "33{c}"), ("7{b}301", "07{b}3"), ("01{b}F", "01{b}F"),
    ("06S{b}", "06S{b}"), ("06s{b}01", "06S{b}"), (" 45{c} ", "45{c}"), ("45{c}.0", "45{c}"), ("\t1{c}\t", "01{c}"), ("", None), (None, None),
])
cases("parent_ccn_cases", tx.parent_ccn, [
    ("06S{b}", "060{b}"), ("06T{b}", "060{b}"), ("45U{b}", "450{b}"), ("17M{b}", "171{b}"), ("33R{b}", "331{b}"), ("04Z{b}", "041{b}"), ("45W{b}", "452{b}"), ("45Y{b}", "453{b}"),
    ("050W{d}2", "050W{d}2"), ("06{c}", "06{c}"), ("01{b}F", "01{b}F"), (None, None),
])
cases("apr_cases", tx.apr_drg_code, [
    ("{b}-{s}", "{b}-{s}"), ("{b}.{s}", "{b}-{s}"), ("{b}{e}{s}", "{b}-{s}"), ("{b}_{s}", "{b}-{s}"), ("{b}{s}", "{b}-{s}"), ("{b} SOI {s}", "{b}-{s}"), ("{b} Severity {s}", "{b}-{s}"), ("APR-DRG {b}-{s}", "{b}-{s}"),
    ("aprdrg{e}{b}", "{b}"), ("{d}0-{s}", "0{d}0-{s}"), ("{b}9", "{b}9"), ("0{b}{s}", "0{b}{s}"), ("{b}-5", "{b}-5"), ("{d}0", "0{d}0"), ("{b}.0", "{b}"), ("{w}", "{W}"), (None, None),
])
cases("drg_cases", tx.drg_code, [("0{d}42", "{d}42"), ("{d}42", "{d}42"), ("{d}42.0", "{d}42"), ("{e}{d}43 ", "{d}43"), ("{d}", "00{d}"), ("000{d}", "00{d}"), ("1{b}", "1{b}"), ("000", "000"), ("a{d}2", "A{d}2"), (None, None)])
cases("procedure_cases", tx.procedure_code, [("{e}5{c} ", "5{c}"), ("g{c}", "G{c}"), ("5{c}.0", "5{c}"), ("5{c}.05", "5{c}.05"), (None, None)])
cases("code_type_cases", tx.code_type_fit, [
    ("CPT{e}", "procedure", "verified"), ("{e}hcpcs", "procedure", "verified"), ("cpt{e}hcpcs", "procedure", "verified"), ("HCPCS_CPT", "procedure", "verified"), ("CPT/HCPCS", "procedure", "verified"),
    ("CDM{d}", "procedure", "incompatible"), ("RC", "procedure", "incompatible"), (None, "procedure", "unverified"), ("{e}", "procedure", "unverified"), ("DRG", "procedure", "incompatible"),
    ("MS-DRG", "ms_drg", "verified"), ("ms{e}drg", "ms_drg", "verified"), ("DRG{e}", "ms_drg", "unverified"), ("APR-DRG", "ms_drg", "incompatible"), (None, "ms_drg", "unverified"),
    ("APR-DRG", "apr_drg", "verified"), ("3M{e}APR DRG", "apr_drg", "verified"), ("apr_drgs", "apr_drg", "verified"), ("DRG", "apr_drg", "incompatible"), (None, "apr_drg", "incompatible"),
])
cases("url_key_cases", tx.url_key, [
    ("https://www.{W}.org/files/{d}_A_standardcharges.csv?v={d}", "{w}.org/files/{d}_A_standardcharges.csv"), ("http://{w}.org/files/{b}_A_standardcharges.csv/", "{w}.org/files/{b}_A_standardcharges.csv"),
    ("https://{w}.org/files/{d}%20A.csv", "{w}.org/files/{d} A.csv"), ("https://b.s3.{w}.com/f/{d}.bin?X-Amz-Signature={w}&X-Amz-Expires=600", "b.s3.{w}.com/f/{d}.bin"),
    ("https://store.blob.{w}.net/f/{d}?sv=2022-11-02&se=2026&sig={w}", "store.blob.{w}.net/f/{d}"), ("https://{w}.com/get?token={c}", "{w}.com/get"), ("https://{w}.com/get?Policy={c}", "{w}.com/get"),
    ("https://{w}.com/download.aspx?pi={c}", "{w}.com/download.aspx?pi={c}"), ("https://{w}.com/dir/?pi={d}", "{w}.com/dir?pi={d}"), ("HTTP://WWW.{W}.COM/", "{w}.com"), ("{w}.com/a#{w}?c", "{w}.com/a"),
    ("{w}.com/{W}.ZIP?x={d}", "{w}.com/{W}.ZIP"), ("", None), (None, None),
])
cases("payer_type_cases", rules.payer_type, [
    ("Aetna", "PPO {d}", "commercial"), ("Medicare", None, "medicare"), ("Humana", "Medicare Advantage HMO {b}", "medicare_advantage"), ("Anthem BCBS VA", None, "commercial"), ("VA", None, "tricare_va"),
    ("VA Community Care {d}", None, "tricare_va"), ("Humana Military", "TRICARE {w}", "tricare_va"), ("Optum VA", None, "tricare_va"), ("Progressive Auto {w}", None, "workers_comp"), ("Anthem BCBS", "Anthem IN Work Comp {d}", "workers_comp"),
    ("Ambetter from {w} Health", None, "exchange"), ("Molina", "HIX {d}", "exchange"), ("Molina {w}", "MCR", "medicare_advantage"), ("Molina", "Chip {W}", "medicaid"), ("Amerigroup {w}", None, "medicaid"),
    ("Health Net Community Solutions", "Medi-Cal {d}", "medicaid"), ("Medical Mutual Medicare", "Medicare", "medicare_advantage"), ("HRSA Uninsured {w}", None, "other"), ("Uninsured", None, "self_pay"),
    ("BCBS Medicare Supplement {b}", None, "medicare"), ("Paramount Advantage", None, "medicaid"), ("BCBS", "BlueAdvantageHMO", "commercial"), ("Kaiser", "Senior Advantage {d}", "medicare_advantage"),
    ("MEDICARE_PART_B_CLAIMS", "PARTBMCR", "medicare"), ("CareSource", "Ohio{e}Medicaid", "medicaid"), ("ConnectiCare {w}", None, "commercial"), ("{w} Club", None, "other"), ("{e}", "", "unknown"), (None, None, "unknown"),
])
cases("explicit_type_cases", rules.explicit_type, [
    ("{w} medicare advantage hmo", "medicare_advantage"), ("{w} managed medicaid", "medicaid"), ("humana military tricare {d}", "tricare_va"), ("{w} ppo", None), ("medicare", "medicare"),
    ("{w} medicare supplement", "medicare"), ('"Medicare"', "medicare"), ("workers comp {w}", "workers_comp"), ("Texas STAR Plus", "medicaid"), (None, None),
])
cases("label_map_cases", lambda x: rules.comparable_type(rules.labelled_type(x)), [("Managed{e}Medicaid", "medicaid"), ("{e}Marketplace", "commercial"), (" Workers{e}Compensation", "workers_comp"), ("VA", "tricare_va"), ("Self{e}Pay", "self_pay"), ("{W}{e}Label", "unmapped: {w} label"), (None, None)])
cases("name_token_cases", lambda x: F.array_join(F.array_sort(tx.name_tokens(x)), " "), [
    ("St. {W}'s Reg Med Ctr", "regional st {w}s"), ("SAINT {W}S REGIONAL MEDICAL CENTER, INC.", "regional st {w}s"), ("The Childrens Hosp of {W}", "children {w}"),
    ("Mount {w} Univ. Hospitals LLC", "mt university {w}"), ("Cmty Gen Hlth {d}", "{d} community general"), ("Ortho & Spine {w}", "orthopedic spine {w}"), ("Hospital", ""), (None, None),
])
cases("street_cases", tx.street, [("{c} {W} Street", "{c} {w} st"), ("{d} North {w} Parkway, Suite {b}", "{d} n {w} pkwy ste {b}"), ("{d} {w} Court Northeast", "{d} {w} ct ne"), ("{d} Place{e}Circle", "{d} pl cir"), ("{b} Route {d}", "{b} rt {d}"), (None, None)])
cases("city_cases", tx.city, [("Saint {W}", "st {w}"), ("FORT {W}", "ft {w}"), ("Mount{e}{w}", "mt {w}"), ("St. {w}", "st {w}"), ("", None), (None, None)])
cases("zip_cases", tx.zip_key, [("8{c}", "8{c}"), ("8{c}-{c}", "8{c}"), ("{d} {w} St, Denver, CO 8{c}", "8{c}"), ("{d} {w} St, Denver, CO 8{c}-0001 ", "8{c}"), ("8{c} {w} St", None), ("", None), (None, None)])
cases("license_cases", tx.license_key, [("000{d}{b}-a", "{d}{b}A"), ("TX{e}00{d}5", "TX00{d}5"), ("0", "0"), ("--", None), (None, None)])
cases("split_cases", lambda x: F.array_join(tx.parts(x), "/"), [("{w}{e}|{e}{d};{b}", "{w}/{d}/{b}"), ("{e}{w} ", "{w}"), ("{w}||{d};", "{w}/{d}"), ("", ""), (None, None)])
cases("quote_cases", tx.unquoted, [('"{w}"', "{w}"), ('{e}"{w} b" ', "{w} b"), ('""', None), ("{w}", "{w}"), (None, None)])
cases("state_cases", lambda x, y: tx.state(x, y, ["TX", "CO"]), [("tx{e}", None, "TX"), ("ZZ", "{d} {w}, Denver, CO 8{c}", "CO"), (None, "{d} Main, {w}, ny 1{c}", None), (None, None, None)])
cases("note_cases", lambda x, y: tx.notes(x, y), [("{w}", "{d}", "{w} || {d}"), ("{e}", "{w}", "{w}"), ("", None, None), (None, None, None)])
cases("robots_cases", lambda x, y: F.regexp_like(y, tx.robots_regex(x)), [
    ("/{w}", "/{w}/{d}", "true"), ("/{w}$", "/{w}/{d}", "false"), ("/*.csv$", "/{w}/{d}.csv", "true"), ("/*.csv$", "/{w}/{d}.csv?{w}", "false"), ("/{w}.b", "/{w}xb", "false"), ("/", "/{w}", "true"),
], "BOOLEAN")
cases("similarity_cases", lambda x, y, z: F.round(nu.similarity(x.cast("double"), y.cast("double"), z.cast("double")), 6), [
    ("1", "1", "1", "1.0"), ("0.{d}", None, None, "0.{d}"), ("0.{d}", "0.{d}", "0.{d}", "0.{d}"), ("1", "0", None, "0.588235"), ("0.8", "0.6", "1", "0.76"), ("0.4", None, "1", "0.538462"),
], "DOUBLE")
cases("suppressed_cases", lambda x: nu.money(x), [("$1,{b}.50", "1{b}.5"), ("{d}%", "{d}.0"), ("Suppressed", None), ("", None), (None, None)], "DOUBLE")
