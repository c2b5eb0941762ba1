"""Codes, identifiers, names, addresses and URLs as Column expressions; no Python runs on the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s ]+"


def squished(x: Column) -> Column:
    """Outer white space off (tabs and no-break spaces too), inner runs one blank."""
    return F.regexp_replace(F.regexp_replace(x, _SPACE, " "), "^ | $", "")


def stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"^[\s ]+|[\s ]+$", "")


def blank_to_null(x: Column) -> Column:
    return F.nullif(stripped(x), F.lit(""))


def unquoted(x: Column) -> Column:
    """Quotes at the ends off, blank to null."""
    return F.nullif(F.trim(F.regexp_replace(x, r'^\s*"+|"+\s*$', "")), F.lit(""))


def procedure_code(x: Column) -> Column:
    return F.regexp_replace(F.upper(stripped(x)), r"\.0+$", "")


def drg_code(x: Column) -> Column:
    """All-digit codes without leading zeros, padded to three digits and never shortened."""
    code = procedure_code(x)
    bare = F.regexp_replace(code, "^0+(?=[0-9])", "")
    padded = F.when(F.length(bare) < 3, F.lpad(bare, 3, "0")).otherwise(bare)
    return F.when(code.rlike("^[0-9]+$"), padded).otherwise(code)


def apr_drg_code(x: Column) -> Column:
    """NNN-S where a severity of 1 to 4 is given (560-1, 560.1, 560 SOI 1, 5601), else NNN; what is neither stays."""
    code = F.regexp_replace(procedure_code(x), r"\b(SOI|SEVERITY|APR[- ]?DRG)\b", "")
    code = F.regexp_replace(F.regexp_replace(code, r"[\s._]+", "-"), "^-+|-+$", "")
    spelled, run = "^([0-9]{1,3})-([1-4])$", "^([0-9]{3})([1-4])$"
    three = lambda c: F.lpad(c, 3, "0")
    return (
        F.when(code.rlike(spelled), F.concat(three(F.regexp_extract(code, spelled, 1)), F.lit("-"), F.regexp_extract(code, spelled, 2)))
        .when(code.rlike(run), F.regexp_replace(code, run, "$1-$2"))
        .when(code.rlike("^[0-9]{1,3}$"), three(code))
        .otherwise(code)
    )


def code_type(x: Column) -> Column:
    return F.nullif(F.upper(F.regexp_replace(stripped(x), r"[\s_]+", "-")), F.lit(""))


#: Types that a code of each family may be given under; the type that names no grouper leaves an MS-DRG unverified. Fixed values.
CODE_TYPES = {
    "procedure": ("CPT", "HCPCS", "CPT-HCPCS", "HCPCS-CPT", "CPT/HCPCS", "HCPCS/CPT"),
    "ms_drg": ("MS-DRG", "MSDRG"),
    "apr_drg": ("APR-DRG", "APRDRG", "APR", "APR-DRGS", "3M-APR-DRG", "3M-APRDRG"),
}
BARE_DRG = "DRG"


def code_type_fit(kind: Column, family: Column) -> Column:
    """verified, unverified (no type, or a bare DRG; never for an APR-DRG) or incompatible."""
    kind = code_type(kind)
    fits = F.lit(False)
    for f, kinds in CODE_TYPES.items():
        fits = fits | ((family == f) & kind.isin(*kinds))
    open_ = kind.isNull() & (family != "apr_drg") | (kind == BARE_DRG) & (family == "ms_drg")
    return F.when(F.coalesce(fits, F.lit(False)), "verified").when(F.coalesce(open_, F.lit(False)), "unverified").otherwise("incompatible")


def normal_code(x: Column, family: Column) -> Column:
    return F.when(family == "ms_drg", drg_code(x)).when(family == "apr_drg", apr_drg_code(x)).otherwise(procedure_code(x))


def ccn(x: Column) -> Column:
    """Six characters: a lost leading zero comes back to five and seven digits, a decimal tail and what follows the sixth go."""
    v = F.regexp_replace(F.upper(stripped(x)), r"\.0+$", "")
    v = F.when(v.rlike("^([0-9]{5}|[0-9]{7})$"), F.concat(F.lit("0"), v)).otherwise(v)
    return F.nullif(F.substring(v, 1, 6), F.lit(""))


def is_unit_ccn(x: Column) -> Column:
    return x.rlike("^[0-9]{2}[MRSTUWYZ][0-9]{3}$")


#: The digit that the letter of a unit stands for. Fixed values.
UNIT_DIGITS = {"S": "0", "T": "0", "U": "0", "M": "1", "R": "1", "Z": "1", "W": "2", "Y": "3"}


def parent_ccn(x: Column) -> Column:
    """The hospital of a psychiatric, rehabilitation or swing-bed unit; other numbers as they are."""
    digit = F.translate(F.substring(x, 3, 1), "".join(UNIT_DIGITS), "".join(UNIT_DIGITS.values()))
    return F.when(is_unit_ccn(x), F.concat(F.substring(x, 1, 2), digit, F.substring(x, 4, 3))).otherwise(x)


def npis(x: Column) -> Column:
    """Each run of exactly ten digits."""
    return F.array_distinct(F.regexp_extract_all(x, F.lit("(?<![0-9])[0-9]{10}(?![0-9])"), F.lit(0)))


def parts(x: Column) -> Column:
    """Values split at bars and semicolons, blanks dropped."""
    return F.filter(F.split(stripped(x), r"\s*[|;]\s*"), lambda v: v != "")


def license_key(x: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_replace(F.upper(x), "[^A-Z0-9]", ""), "^0+(?=.)", ""), F.lit(""))


#: Abbreviations in hospital names and words that tell nothing, abbreviations in streets and cities. Fixed values.
NAME_WORDS = {
    "ctr": "center", "hosp": "hospital", "med": "medical", "reg": "regional", "mem": "memorial", "cmty": "community", "hlth": "health", "univ": "university", "gen": "general",
    "saint": "st", "mount": "mt", "childrens": "children", "orthopaedic": "orthopedic", "ortho": "orthopedic", "hospitals": "hospital",
}
NAME_STOP = (
    "hospital", "medical", "center", "centre", "health", "system", "the", "of",
    "inc", "llc", "lp", "llp", "corp", "corporation", "co", "company", "pc", "pllc", "dba", "and", "for", "at", "a", "an", "in",
)
STREET_WORDS = {
    "street": "st", "avenue": "ave", "road": "rd", "drive": "dr", "boulevard": "blvd", "highway": "hwy", "parkway": "pkwy", "lane": "ln", "court": "ct", "place": "pl",
    "circle": "cir", "freeway": "fwy", "expressway": "expy", "terrace": "ter", "square": "sq", "suite": "ste", "route": "rt",
    "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw", "north": "n", "south": "s", "east": "e", "west": "w",
}
CITY_WORDS = {"saint": "st", "fort": "ft", "mount": "mt"}


def _words(x: Column, meant: dict[str, str]) -> Column:
    """Lower-case words of letters and digits (null: none), the listed ones replaced."""
    table = F.create_map(*(F.lit(v) for kv in meant.items() for v in kv))
    words = F.filter(F.split(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    return F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))


def hospital_name(x: Column) -> Column:
    """A name's words with abbreviations spelled out; apostrophes join what they part."""
    return F.array_join(_words(F.regexp_replace(x, "['’]", ""), NAME_WORDS), " ")


def name_tokens(x: Column) -> Column:
    words = F.array_distinct(_words(F.regexp_replace(x, "['’]", ""), NAME_WORDS))
    return F.array_except(words, F.array(*map(F.lit, NAME_STOP)))


def street(x: Column) -> Column:
    return F.array_join(_words(x, STREET_WORDS), " ")


def address_tokens(x: Column) -> Column:
    return F.array_distinct(_words(x, STREET_WORDS))


def city(x: Column) -> Column:
    return F.nullif(F.array_join(_words(x, CITY_WORDS), " "), F.lit(""))


def zip_key(x: Column) -> Column:
    """Five digits at the end of a text, four more after a dash left off."""
    return F.nullif(F.regexp_extract(x, r"([0-9]{5})(?:-[0-9]{4})?\s*$", 1), F.lit(""))


def host(url: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(stripped(url)), r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/@?#]*@)?([^/:?#\s]+)", 1), F.lit(""))


def site(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www[0-9]*\.", "")


def last_labels(url: Column) -> Column:
    """The last two labels of the site, whatever they are; '' for a name of one label. `parent_domain` knows platforms and suffixes."""
    return F.regexp_extract(site(url), r"([^.]+\.[^.]+)$", 1)


#: Platforms whose subdomains belong to their tenants, and suffixes of two labels. Fixed values.
PLATFORMS = (
    "azurewebsites.net", "azureedge.net", "cloudfront.net", "amazonaws.com", "windows.net", "googleapis.com", "googleusercontent.com", "appspot.com", "web.app", "firebaseapp.com",
    "github.io", "githubusercontent.com", "herokuapp.com", "netlify.app", "vercel.app", "pages.dev", "wixsite.com", "squarespace.com", "wordpress.com", "blogspot.com",
    "sharepoint.com", "myshopify.com", "weebly.com", "godaddysites.com", "hubspotpagebuilder.com", "box.com", "dropboxusercontent.com", "cdn-website.com",
)
TWO_LABEL_SUFFIXES = ("co.us", "com.au", "co.uk", "org.uk", "nhs.uk", "com.pr", "org.pr")


def ends_in(name: Column, suffixes: Sequence[str]) -> Column:
    """Whether a host is one of the suffixes or below it."""
    return F.exists(F.array(*map(F.lit, suffixes)), lambda s: (name == s) | name.endswith(F.concat(F.lit("."), s)))


def parent_domain(url: Column) -> Column:
    """The registrable domain above the host; null where the host is one itself, or a tenant of a platform."""
    h = host(url)
    labels = F.size(F.split(h, "[.]"))
    two = F.substring_index(h, ".", -2).isin(*TWO_LABEL_SUFFIXES)
    return F.when(~ends_in(h, PLATFORMS) & (labels > F.when(two, 3).otherwise(2)), F.when(two, F.substring_index(h, ".", -3)).otherwise(F.substring_index(h, ".", -2)))


def domain_variants(url: Column) -> Column:
    """The host, it without www, a name of two labels also with it, and the registrable parent with and without; no repeats."""
    h = host(url)
    bare = F.regexp_replace(h, r"^www\.", "")
    parent, www = parent_domain(bare), F.lit("www.")
    return F.array_distinct(F.array_compact(F.array(h, bare, F.when(F.size(F.split(bare, "[.]")) == 2, F.concat(www, bare)), parent, F.concat(www, parent))))


#: Query parameters of signed URLs, and endings of data files. Fixed values.
SIGNED = ("x-amz-[a-z-]+", "sig", "se", "sv", "sp", "st", "spr", "signature", "expires", "token", "key-pair-id", "policy")
DATA_FILES = "csv|json|zip|gz|xlsx?|txt"


def url_key(url: Column) -> Column:
    """A URL without scheme, www, fragment and slashes at the path's end, %20 as a blank; the query goes from data files and signed URLs, and stays on scripts."""
    u = F.regexp_replace(F.regexp_replace(stripped(url), "(?i)^https?://", ""), "#.*$", "")
    fleeting = u.rlike(rf"(?i)[?&]({'|'.join(SIGNED)})=") | u.rlike(rf"(?i)\.({DATA_FILES})/?(\?|$)")
    u = F.when(fleeting, F.regexp_replace(u, r"\?.*$", "")).otherwise(u)
    u = F.regexp_replace(F.replace(u, F.lit("%20"), F.lit(" ")), r"/+(\?|$)", "$1")
    return F.nullif(F.concat(F.regexp_replace(F.lower(F.regexp_extract(u, "^[^/]+", 0)), r"^www\.", ""), F.regexp_replace(u, "^[^/]+", "")), F.lit(""))


def robots_regex(pattern: Column) -> Column:
    """A robots.txt path pattern as a regex: stars are any run, a last dollar the end."""
    quoted = F.regexp_replace(pattern, r"([\\.+?^(){}\[\]|$])", r"\\$1")
    return F.concat(F.lit("^"), F.regexp_replace(F.regexp_replace(quoted, r"\*", ".*"), r"\\\$$", r"\$"))


def payer_key(*names: Column) -> Column:
    """Lower-case names with single blanks, joined by a unit separator, nulls as empty."""
    return F.concat_ws("\u001f", *(F.coalesce(F.lower(squished(n)), F.lit("")) for n in names))


def notes(*texts: Column, sep: str = " || ") -> Column:
    return F.nullif(F.concat_ws(sep, *(blank_to_null(t) for t in texts)), F.lit(""))


def state(label: Column, address: Column, valid: list[str]) -> Column:
    """A valid postal abbreviation from the label, else from the letters before the address's ZIP."""
    own = F.upper(stripped(label))
    found = F.upper(F.regexp_extract(address, r"(?i)\b([a-z]{2})[ ,]+[0-9]{5}(?:-[0-9]{4})?\s*$", 1))
    return F.coalesce(F.when(own.isin(valid), own), F.when(found.isin(valid), found))
