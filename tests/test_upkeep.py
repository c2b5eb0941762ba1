import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tariffa.operators import births, checks, crosswalk, exports, joins, matching
from tariffa.sources import published, rosters

FACILITY = "facility_key string, mrf_url string, name string, location_name string, address string, city string, state string, license string, type_2_npi string"
ROSTER = "ccn string, name string, address string, city string, state string, zip string"
STATES = ("TX", "OK", "NM")


def made(spark, rng, hospitals, facilities):
    roster = [(f"{h:06}", f"{w} {v} Hospital", f"{100 + h} Oak Street", f"City {h % 4}", STATES[h % 3], f"{10000 + h % 5}") for h, (w, v) in hospitals.items()]
    rows = []
    for f, (h, kind, word) in facilities.items():
        w, v = hospitals.get(h, ("Gone", "Away"))
        rows.append((f"f{f}", f"https://www.h{h}.org/a.csv" if kind in (0, 5) else None, f"{w} {v} Hosp {word}".strip(), None, f"{100 + h} Oak St, City {h % 4}, {STATES[h % 3]} {10000 + h % 5}" if kind != 4 else None, f"City {h % 4}", STATES[h % 3], f"00{h}-l" if kind == 2 else None, f"1{h + (kind == 5):09}" if kind in (1, 5) else None))
    maps = [(f"h{h}.org/a.csv", f"{h:06}") for h in hospitals], [(f"1{h:09}", f"{h:06}") for h in hospitals], [(f"{h}L", None, f"{h:06}") for h in hospitals]
    tables = (spark.createDataFrame(rows, FACILITY), matching.profiles(spark.createDataFrame(roster, ROSTER)), spark.createDataFrame(maps[0], "url_key string, ccn string"), spark.createDataFrame(maps[1], "npi string, ccn string"), spark.createDataFrame(maps[2], "license_key string, state string, ccn string"))
    return tables


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select("facility_key", "ccn", "ccn_match_method", F.round("ccn_match_score", 9), "ccn_ambiguous", "ccn_conflict").collect())


def test_crosswalk_equals_a_full_run(spark, tmp_path):
    rng = random.Random(5)
    words = ["north", "mercy", "grace", "valley", "summit", "harbor"]
    hospitals = {h: (rng.choice(words), rng.choice(words)) for h in range(1, 25)}
    facilities = {f: (rng.randint(1, 26), rng.randint(0, 5), rng.choice(["", "west"])) for f in range(60)}
    root = str(tmp_path / "crosswalk")
    crosswalk.run(spark, root, *made(spark, rng, hospitals, facilities))
    first = crosswalk.State(**published.read(spark, root))
    # nothing changed: nothing to do, and the same rows
    assert crosswalk.stale(first, *made(spark, rng, hospitals, facilities)).isEmpty()
    hospitals[3] = ("summit", "north")
    del hospitals[7]
    hospitals[30] = ("mercy", "mercy")
    facilities[4] = (11, 3, "west")
    del facilities[9]
    facilities[99] = (30, 3, "")
    tables = made(spark, rng, hospitals, facilities)
    crosswalk.run(spark, root, *tables)
    second = published.read(spark, root)["matches"]
    full = matching.resolved(*tables)
    assert rows_of(second) == rows_of(full) and rows_of(full) != rows_of(first.matches)
    why = {r.facility_key: r.reasons for r in crosswalk.stale(first, *tables).collect()}
    assert why["f99"][:1] != [] and "new" in why["f99"] and "features" in why["f4"] and "f9" not in why
    gone = {r.facility_key: r.change for r in crosswalk.moves(first.matches, second).collect()}
    assert gone.get("f99") == "found" and all(c in ("found", "lost", "moved") for c in gone.values())


def test_crosswalk_matches_only_what_a_change_touches(spark):
    rng = random.Random(1)
    hospitals = {h: (f"word{h}", f"other{h}") for h in range(1, 13)}
    facilities = {f: (f % 12 + 1, 0, "") for f in range(24)}
    first = crosswalk.updated(None, *made(spark, rng, hospitals, facilities)).kept()
    facilities[5] = (5 % 12 + 1, 0, "annex")
    assert [tuple(r) for r in crosswalk.stale(first, *made(spark, rng, hospitals, facilities)).collect()] == [("f5", ["features"])]
    facilities[5] = (6, 0, "")
    hospitals[2] = ("moved", "away")  # in NM, as are 5, 8 and 11
    got = {r.facility_key for r in crosswalk.stale(first, *made(spark, rng, hospitals, facilities)).collect()}
    assert got == {f"f{f}" for f, (h, _, _) in facilities.items() if h % 3 == 2}
    none = crosswalk.updated(None, *(df.limit(0) for df in made(spark, rng, hospitals, facilities)))
    assert none.matches.isEmpty() and not crosswalk.updated(none.kept(), *made(spark, rng, hospitals, facilities)).matches.isEmpty()


NOTES = ['"---"', '"Dataset: Natality, 2016-2024 expanded"', '"Live Birth Order: 1"', '"Plurality: Single"', '"Fetal Presentation: Cephalic"', '"OE Gestational Age Recode 11: 37-38 weeks; 39 weeks; 40 weeks; 41 weeks; 42 weeks or more"', '"Year: 2022; 2023; 2024"', '"Group By: County of Residence;  Delivery Method"', '"Query Date: Sep 1"', '"---"']


def export(notes=NOTES, places=120, births_name="Births", end="\n"):
    head = f'"Notes"\t"County of Residence"\t"County of Residence  Code"\t"{births_name}"'
    return end.join([head, *(f'\t"c"\t"{p:05}"\t{p}' for p in range(places)), '"Total"\t\t\t9', "", *notes])


def test_export_audit(spark, tmp_path):
    swap = lambda old, new: [new if x.startswith(f'"{old}') else x for x in NOTES if new or not x.startswith(f'"{old}')]
    wrong = {
        "good": (export(), None), "windows": (export(end="\r\n"), None), "group": (export(swap("Group", '"Group By: County of Residence; Age"')), "grouped by [Age; County of Residence], not [County of Residence; Delivery Method]"),
        "year": (export(swap("Year", '"Year: 2016"')), "years [2016], not [2022, 2023, 2024]"), "mark": (export(swap("OE", '"OE Gestational Age Recode 11: 39 weeks"')), "filters absent or not complete"),
        "set": (export(swap("Dataset", '"Dataset: Natality, 2007-2024"')), "dataset Natality, 2007-2024, not expanded"), "bare": (export([]), "no notes"), "few": (export(places=99), "only 99 of County, less than 100"),
        "none": (export(places=0), "no rows; only 0 of County, less than 100"), "deaths": (export(births_name="Deaths"), "no column Births"), "empty": ("", "missing, required"), "blank": ("\n", "no column Births"), "gone": (None, "missing, required"), "other": (None, "missing, extended"),
        "control": (export(), "filtered, but must hold all births"), "both": (export(swap("Year", None)), "years [], not [2022, 2023, 2024]"),
    }
    for name, (text, _) in wrong.items():
        if text is not None:
            (tmp_path / f"{name}.txt").write_bytes(text.encode())
    (tmp_path / "unlisted.txt").write_text("x")
    spec = spark.createDataFrame([(n, f"{n}.txt", "extended" if n == "other" else "required", "County of Residence; Delivery Method", "2022-2024", n != "control") for n in wrong], "key string, file string, role string, group_by string, years string, filtered boolean")
    audited = exports.audit(exports.read(spark, str(tmp_path)), spec)
    got = {r.key: r for r in audited.collect()}
    assert {k: r.problem for k, r in got.items()} == {k: p for k, (_, p) in wrong.items()}
    good = got["good"]
    assert (good.rows, good.n_geo, good.dataset, good.query_date) == (120, 120, "Natality, 2016-2024 expanded", "Sep 1") and good.sha256 == hashlib.sha256(wrong["good"][0].encode()).hexdigest()
    assert not exports.usable(audited) and exports.usable(audited.where("key in ('good', 'other')"))
    assert [r[3] for r in checks.exports(audited)] == ["fail"] and [r[3] for r in checks.exports(audited.where("key in ('good', 'windows')"))] == ["pass"]
    assert exports.audit(exports.read(spark, str(tmp_path)), spec.limit(0)).isEmpty()


def test_only_frozen_files_are_read(spark, tmp_path):
    folder, names = tmp_path / "r", tmp_path / "m"
    folder.mkdir(), names.mkdir()
    text = "npi,cohort_member,status,npi_tax_class,nppes_zip,nppes_state,certification\n1,TRUE,ACTIVE,midwife,801011234,CO,CNM\n1,true,ACTIVE,midwife,80100,CO,CNM\n2,TRUE,LAPSED,midwife,80101,CO,CNM\n3,TRUE,ACTIVE,nursing,80101,CO,CNM\n,TRUE,ACTIVE,midwife,80101,CO,CNM\n4,TRUE,ACTIVE,midwife,80101,RP,CNM\n5,TRUE,ACTIVE,midwife,00601,PR,CM\n"
    (folder / "roster.csv").write_text(text)
    (names / "roster.csv.manifest.json").write_text(json.dumps({"artifact_sha256": hashlib.sha256(text.encode()).hexdigest().upper(), "rows": 7}, indent=1))
    frozen = rosters.manifest(spark, str(names))
    people = rosters.active(rosters.verified(spark, str(folder), frozen))
    assert sorted(tuple(r) for r in people.collect()) == [("1", "80100", "CO", "CNM"), ("5", "00601", "PR", "CM")]
    assert "CO" not in rosters.lacking(people) and len(rosters.lacking(people)) == 50
    with pytest.raises(ValueError, match="nobody in AK, AL"):
        rosters.lacking(people, strict=True)
    (folder / "roster.csv").write_text(text.replace("LAPSED", "ACTIVE"))
    (folder / "extra.csv").write_text("npi\n")
    with pytest.raises(rosters.Changed, match="extra.csv: unknown; roster.csv: changed"):
        rosters.verified(spark, str(folder), frozen)
    assert [tuple(r) for r in rosters.differing(spark, str(folder), frozen.unionAll(spark.createDataFrame([("lost.csv", "00")], frozen.schema))).where("fault = 'absent'").collect()] == [("lost.csv", "absent")]


def test_places(spark):
    parts = spark.createDataFrame([("1", "08001", 5.0), ("1", "08003", 9.0), ("2", "49002", 1.0), ("2", "49001", 1.0), ("", "08001", 1.0), (None, "08001", 1.0), ("3", "56001", None)], "zip string, county_fips string, land double")
    homes = rosters.county_of_zip(parts)
    assert {r.zip: r.county_fips for r in homes.collect()} == {"1": "08003", "2": "49001", "3": "56001"}
    points = rosters.points(spark.createDataFrame([("1", "40", " -105 "), ("2", "41", "-111"), ("3 ", "43", "x")], "`GEOID` string, `INTPTLAT ` string, `INTPTLONG   ` string"))
    people = spark.createDataFrame([("1", "CO"), ("9", None)], "zip string, state string")
    assert sorted((r.zip, r.state, r.lon) for r in rosters.uncovered(points, homes, people).collect()) == [("2", "UT", -111.0), ("3", "WY", None)]
    zips = spark.createDataFrame([("1 Oak St, Denver, CO 80202", "1 Oak"), ("Denver 80202-1234 ", None), ("Denver", "80301"), (None, "x"), ("80202 Oak St", "803")], "a string, z string")
    assert [r.x for r in zips.select(rosters.zip_of(F.col("a"), F.col("z")).alias("x")).collect()] == ["80202", "80202", "80301", None, None]


def far(a, b):
    (p, q), (r, s) = ((math.radians(x) for x in v) for v in (a, b))
    return 2 * 3958.8 * math.asin(min(1, math.sqrt(math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((s - q) / 2) ** 2)))


def test_nearest_place(spark):
    rng = random.Random(2)
    left = {i: (rng.uniform(-89, 89), rng.uniform(-180, 180)) for i in range(30)}
    right = [(rng.uniform(-60, 60), rng.uniform(-180, 180)) for _ in range(8)] + [(10.0, 20.0), (10.0, 20.0)]
    a = spark.createDataFrame([(i, *p) for i, p in left.items()] + [(99, None, 1.0)], "id int, lat double, lon double")
    b = spark.createDataFrame([*right, (None, None)], "lat2 double, lon2 double")
    got = {r.id: r.miles for r in joins.nearest_place(a, b, "id", 100).collect()}
    assert got.keys() == left.keys() and all(abs(m - min(far(left[i], p) for p in right)) < 1e-6 for i, m in got.items())
    assert joins.nearest_place(a, b.limit(0), "id", 100).isEmpty() and joins.nearest_place(a.limit(0), b, "id", 100).isEmpty()


def test_supply_at(spark):
    places = spark.createDataFrame([("a", "c1", 40.0, -105.0), ("b", "c2", 41.0, -111.0), ("c", None, 30.0, -90.0)], "place string, county string, lat double, lon double")
    spot = "lat double, lon double"
    counties = spark.createDataFrame([("c1", 40.1, -105.0, 500), ("c2", 48.0, -111.0, 300), ("c3", 40.0, -104.9, None), ("c4", None, None, 9)], "county string, lat double, lon double, births long")
    people = spark.createDataFrame([(40.0, -105.1), (40.0, -105.1), (41.0, -111.0), (None, None)], spot)
    centers, units = spark.createDataFrame([(40.2, -105.0)], spot), spark.createDataFrame([(40.0, -105.0)], spot)
    blind = spark.createDataFrame([(41.1, -111.0)], spot)
    got = {r.place: r for r in births.supply_at(places, people, counties, 30, centers, units, blind).collect()}
    assert [(got[p].covered, got[p].n_providers, got[p].births, got[p].n_centers, got[p].n_units) for p in "abc"] == [(True, 2, 500, 1, 1), (False, None, 300, 0, 0), (True, 0, 0, 0, 0)]
    assert got["a"].providers_per_1k == 4 and got["b"].providers_per_1k is None and got["c"].providers_per_1k is None and abs(got["b"].nearest_center - far((41, -111), (40.2, -105))) < 1e-6
    plain = births.supply_at(places, people, counties, 30)
    assert plain.columns == ["place", "county", "lat", "lon", "n_providers", "births", "covered", "providers_per_1k"] and plain.where("place = 'b'").first().n_providers == 1
