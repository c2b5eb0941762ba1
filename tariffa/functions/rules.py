"""Ordered rules, enumerations and flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.functions.text import squished, stripped

#: Allowed values. Fixed.
ENUMS = {
    "setting": ("inpatient", "outpatient", "both", "unknown"),
    "billing_class": ("facility", "professional", "both", "unknown"),
    "methodology": ("case rate", "fee schedule", "percent of total billed charges", "per diem", "other", "unknown"),
    "source": ("lake", "own_crawl"),
}

#: Payer types, and ordered payer rules: the first pattern that a text matches names its type. Fixed values.
PAYER_TYPES = ("commercial", "medicare_advantage", "medicare", "medicaid", "exchange", "tricare_va", "workers_comp", "self_pay", "other", "unknown")
PAYER_RULES: tuple[tuple[str, str], ...] = (
    ("other", r"hrsa uninsured|uninsured testing and treatment"),
    ("self_pay", r"self[ -]?pay|\bcash\b|uninsured|\bprivate pay"),
    ("tricare_va", r"tricare|champva|^va$|^va (ccn|community|choice|medical|mission)|\bva (ccn|community care)|veteran|triwest|optum (serve|va)|humana military|champus"),
    ("workers_comp", r"worker'?s'? ?comp|work comp|\bwc\b|\bauto\b|liability|no[ -]?fault|\bpip\b"),
    ("medicare", r"medicare supplement|medicare supp\b|medigap|\bmed ?supp\b"),
    ("medicaid", r"medicaid advantage"),
    ("medicare_advantage", r"medicare advantage|medicare adv\b|medadvantage|\bmapd?\b|\bd-?snp\b|\bc-?snp\b|\bsnp\b|\bdual(s|ly)?\b|\bmmai\b|\bmmp\b|allwell|senior|gold plus|managed medicare|medicare managed|\bmgmcr\b|medicare (hmo|ppo|pffs|replacement|complete|plus|choice)|(aetna|humana|uhc|united|anthem|cigna|wellcare|kaiser|devoted|scan|alignment|clover|bcbs|blue|highmark|molina|connecticare|elevance|centene|healthspring|zing|priority|wellmed|caresource|medical mutual|medical associates|harvard pilgrim|tufts|fallon|independent health|univera|fidelis|kalos|essence|geisinger|health alliance|selecthealth|healthpartners|ucare|\bmedica\b|quartz|security health|premera|regence|moda|pacificsource|providence|avera|sanford|health net|presbyterian|emblem|healthfirst|metroplus|elderplan|wellpoint|amerigroup|careplus|avmed|cdphp|capital district|excellus|\bmvp\b|upmc|independence|capital blue|horizon|carefirst|wellmark).{0,40}(medicare|\bmcr\b)|medicare.{0,40}(aetna|humana|uhc|united|anthem|cigna|wellcare|kaiser|devoted|scan|alignment|clover|bcbs|blue|highmark|molina|connecticare|elevance|centene|healthspring|wellmed|caresource|harvard pilgrim|tufts|fallon|fidelis|essence|health net|priority health|avmed|emblem|healthfirst)"),
    ("exchange", r"marketplace|exchange|\baca\b|ambetter|obamacare|covered california|individual market|qhp|\bhix\b|essential plan"),
    ("commercial", r"connecticare|buckeye commercial"),
    ("medicaid", r"medicaid|\bmedi-?cal\b|\bchip\b|managed medicaid|\bmco\b|ahcccs|tenncare|masshealth|soonercare|badgercare|husky|\bstar ?(plus|kids)?\b|healthy (michigan|louisiana|blue|connections)|caresource|amerigroup|sunshine health|peach state|buckeye|meridian|superior health|iowa total care|nebraska total care|home state health|louisiana healthcare connections|mississippi ?can|well ?care of|community health choice|driscoll|cook children|texas children|parkland community|aetna better health|community plan|healthy horizons|amerihealth caritas|keystone first|molina|virginia premier|\bpasse\b|mdwise|healthy indiana|calviva|health net community solutions|paramount advantage"),
    ("commercial", r"blue ?advantage|health advantage"),
    ("medicare_advantage", r"advantage"),
    ("medicare", r"medicare|\bcms\b|part a|part b|railroad"),
    ("commercial", r"aetna|cigna|united|\buhc\b|optum|anthem|blue|bcbs|highmark|premera|regence|kaiser|humana|oscar|harvard pilgrim|tufts|emblem|oxford|meritain|\bumr\b|multiplan|first health|beech street|\bphcs\b|\bhmo\b|\bppo\b|\bepo\b|\bpos\b|commercial|employer|open access|choice plus|network|health plan|insurance|healthcare|health care|care ?first|wellmark|premier|priority health|health alliance|geisinger|selecthealth|providence|moda|pacificsource|avera|sanford|\bmedica\b|healthpartners|ucare|quartz|dean|security health|bright|friday|imagine|evernorth|allegiance|aspirus|cofinity|galaxy|zelis|\bpreferred|health net|fallon"),
)


def first_match(text: Column, rules: Sequence[tuple[str, str]], blank: str | None = "unknown", other: str | None = "other") -> Column:
    """Label of the first pattern found in a text; its own labels for blank texts and no match; null stays null."""
    lower = F.lower(text)
    out = F.when(text.isNull(), F.lit(None).cast("string")).when(stripped(text) == "", blank)
    for label, pattern in rules:
        out = out.when(lower.rlike(pattern), label)
    return out.otherwise(other)


def payer_type(payer: Column, plan: Column, rules: Sequence[tuple[str, str]] = PAYER_RULES) -> Column:
    """Type from both names; unknown where neither says anything."""
    return first_match(squished(F.concat_ws(" ", payer, plan)), rules)


def rules_of(table: DataFrame) -> tuple[tuple[str, str], ...]:
    """Ordered rules from a table (priority, payer_type, pattern); an unlisted type is an error. The table is a small configuration."""
    rows = table.select(F.col("priority").cast("int").alias("priority"), "payer_type", "pattern").orderBy("priority").collect()
    if bad := sorted({r.payer_type for r in rows} - set(PAYER_TYPES)):
        raise ValueError("unknown payer types in the rules: " + ", ".join(bad))
    return tuple((r.payer_type, r.pattern) for r in rows)


#: Types that a text states outright, in order; labels of another source and the types they stand for. Fixed values.
EXPLICIT_TYPES: tuple[tuple[str, str], ...] = (
    ("tricare_va", r"tricare|champva|\bva ccn\b|va community care"),
    ("workers_comp", r"worker'?s'? ?comp|work comp"),
    ("medicare", r"medicare supplement|medigap|traditional medicare|medicare part [ab]\b|^medicare$"),
    ("medicare_advantage", r"medicare advantage|medicare adv\b|\bd-?snp\b|managed medicare|medicare managed care|medicare (hmo|ppo)\b"),
    ("medicaid", r"medicaid|tenncare|\bmedi-cal\b|\bchip\b|\bstar ?plus\b"),
)
TYPE_LABELS = {
    "commercial": "commercial", "medicare": "medicare", "medicaid": "medicaid", "managed medicaid": "medicaid", "medicare advantage": "medicare_advantage",
    "exchange": "exchange", "marketplace": "exchange", "tricare": "tricare_va", "va": "tricare_va", "workers comp": "workers_comp",
    "workers compensation": "workers_comp", "self pay": "self_pay", "other": "other", "unknown": "unknown",
}
MAIN_TYPES = ("commercial", "medicare", "medicare_advantage", "medicaid")


def explicit_type(text: Column) -> Column:
    """The type that a text states outright, else null."""
    plain = squished(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit('"'), F.lit(""))))
    return first_match(plain, EXPLICIT_TYPES, blank=None, other=None)


def labelled_type(label: Column) -> Column:
    """Our type of another source's label; an unlisted label keeps its text behind `unmapped: `."""
    key = squished(F.lower(label))
    table = F.create_map(*(F.lit(v) for kv in TYPE_LABELS.items() for v in kv))
    return F.when(key.isNotNull(), F.coalesce(F.try_element_at(table, key), F.concat(F.lit("unmapped: "), key)))


def comparable_type(kind: Column) -> Column:
    """A type as the other source knows it: exchange plans are commercial."""
    return F.when(kind == "exchange", "commercial").otherwise(kind)


def enum(x: Column, values: Sequence[str], aliases: dict[str, str] | None = None) -> Column:
    """An allowed value (any case, outer blanks and aliases seen to), else unknown."""
    v = F.lower(stripped(x))
    for seen, meant in (aliases or {}).items():
        v = F.when(v == seen, meant).otherwise(v)
    return F.when(v.isin(*values), v).otherwise("unknown")


def fee_type(billing_class: Column, gross: Column, cutoff: Column) -> Column:
    """The class itself; both is facility; without one a gross price between 1 and the code's cutoff is professional."""
    return F.when(billing_class == "professional", "professional").when(billing_class.isin("facility", "both"), "facility").when((gross > 1) & (gross < cutoff), "professional").otherwise("facility")


def banded(x: Column, cuts: Sequence[tuple[float, str]], last: str) -> Column:
    """The label of the first cut that lies above x; null stays null."""
    out = F.when(x.isNull(), F.lit(None).cast("string"))
    for cut, label in cuts:
        out = out.when(x < cut, label)
    return out.otherwise(last)


def bed_band(beds: Column) -> Column:
    return F.coalesce(banded(beds, ((100, "<100"), (300, "100-299")), "300+"), F.lit("unknown"))


def grade(metric: Column, passes: float, warns: float, at_least: bool = True) -> Column:
    """pass, warn or fail of a metric against two bounds; null fails."""
    ok = (lambda bound: metric >= bound) if at_least else (lambda bound: metric <= bound)
    return F.when(ok(passes), "pass").when(ok(warns), "warn").otherwise("fail")


def ordered_by(x: Column, levels: Sequence[str]) -> Column:
    """Place of a label among the levels, for sorting; unlisted ones last."""
    place = F.array_position(F.array(*map(F.lit, levels)), x)
    return F.when(place > 0, place).otherwise(len(levels) + 1)
