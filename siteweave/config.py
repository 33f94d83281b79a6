"""Rules of the linkage as data: fixed tables, weights and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

# They must equal the rules that results are compared with.
COUNTRY = "United States"
COUNTRY_ALIASES = ("united states", "united states america", "united states of america", "usa", "u s a", "us", "u s", "america")
STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct", "delaware": "de",
    "district of columbia": "dc", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia",
    "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md", "massachusetts": "ma", "michigan": "mi", "minnesota": "mn",
    "mississippi": "ms", "missouri": "mo", "montana": "mt", "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm",
    "new york": "ny", "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa", "rhode island": "ri",
    "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt", "virginia": "va", "washington": "wa",
    "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy",
}
STREET_WORDS = {
    "aly": "alley", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "boul": "boulevard", "cir": "circle", "ct": "court", "ctr": "center", "dr": "drive",
    "expy": "expressway", "fwy": "freeway", "hwy": "highway", "ln": "lane", "pkwy": "parkway", "pl": "place", "rd": "road", "sq": "square", "st": "street",
    "ter": "terrace", "tpke": "turnpike",
}
COMPANY_WORDS = ("co", "company", "corp", "corporation", "inc", "incorporated", "llc", "lp", "ltd", "limited", "plc", "the")
UNIT_WORDS = ("building", "bldg", "floor", "fl", "level", "room", "ste", "suite", "unit")
COUNTRY_WORDS = ("united", "states", "usa", "us")
YES_WORDS = ("yes", "y", "true", "1")
POSTAL = r"\b\d{5}(?:-\d{4})?\b"
REASON = {"A": "Site ID primary collapse", "B": "Data Center ID/campus collapse"}
REASON_FUZZY = "; coordinate/address fuzzy dedupe"


@dataclass(frozen=True)
class Rules:
    """Weights of the combined score and thresholds of the passes; each tuple of a pass is one way to match."""

    address: float = 0.45
    company: float = 0.35
    name: float = 0.12
    city: float = 0.08
    same_state: float = 3.0
    same_postal: float = 4.0
    other_number: float = 70.0
    fuzzy_address: float = 90.0
    list_limit: int = 8
    state_limit: int = 250
    state_below: int = 8
    #: (address, company), (address, city), (address, company), (company, name, city)
    fine: tuple = ((88, 55), (95, 80), (84, 82), (92, 72, 80))
    coarse: tuple = ((90, 60), (96, 85), (86, 86), (94, 78, 85))
    #: combined, address, company: one of them makes a review candidate
    review_floor: tuple = (50, 80, 88)


RULES = Rules()
