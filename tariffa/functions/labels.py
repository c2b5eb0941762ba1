"""Names, regions and codes of states, and labels of payer types. Fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware", "DC": "District of Columbia", "FL": "Florida",
    "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}
REGIONS = {
    "Northeast": "CT ME MA NH RI VT NJ NY PA", "Midwest": "IL IN MI OH WI IA KS MN MO NE ND SD",
    "South": "DE DC FL GA MD NC SC VA WV AL KY MS TN AR LA OK TX", "West": "AZ CO ID MT NV NM UT WY AK CA HI OR WA",
}
PAYER_LABELS = {"commercial": "Commercial", "medicaid": "Medicaid", "medicare_advantage": "Medicare Advantage", "exchange": "Exchange", "self_pay_cash": "Cash price"}

#: Federal numbers of the states. Fixed values.
FIPS = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA", "08": "CO", "09": "CT", "10": "DE", "11": "DC", "12": "FL", "13": "GA", "15": "HI", "16": "ID",
    "17": "IL", "18": "IN", "19": "IA", "20": "KS", "21": "KY", "22": "LA", "23": "ME", "24": "MD", "25": "MA", "26": "MI", "27": "MN", "28": "MS", "29": "MO",
    "30": "MT", "31": "NE", "32": "NV", "33": "NH", "34": "NJ", "35": "NM", "36": "NY", "37": "NC", "38": "ND", "39": "OH", "40": "OK", "41": "OR", "42": "PA",
    "44": "RI", "45": "SC", "46": "SD", "47": "TN", "48": "TX", "49": "UT", "50": "VT", "51": "VA", "53": "WA", "54": "WV", "55": "WI", "56": "WY", "72": "PR",
}
REGION_OF = {state: region for region, states in REGIONS.items() for state in states.split()}


def looked_up(x: Column, table: dict[str, str]) -> Column:
    """The table's entry of a value, null where it has none."""
    return F.try_element_at(F.create_map(*(F.lit(v) for kv in table.items() for v in kv)), x)


def state_name(x: Column) -> Column:
    return looked_up(x, STATES)


def region(x: Column) -> Column:
    return looked_up(x, REGION_OF)


def fips_state(x: Column) -> Column:
    """Postal code by the first two digits of a FIPS code."""
    return looked_up(F.substring(x, 1, 2), FIPS)


def payer_label(x: Column) -> Column:
    return looked_up(x, PAYER_LABELS)


def utc_timestamp(at: Column | None = None) -> Column:
    """A time (now by default) as ISO text in UTC; the session's zone doesn't matter."""
    at = F.current_timestamp() if at is None else at
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
