"""Vocabulary of postal addresses, shared by the address operators."""

from __future__ import annotations

# Words for a part of a building, in the singular; each may also stand in the plural.
UNIT_WORDS = ("apartment", "apt", "bedsit", "flat", "maisonette", "office", "penthouse", "plot", "room", "shop", "studio", "suite", "unit")

# Street types and their usual abbreviations.
STREET_TYPES = {
    "avenue": ("av", "ave"),
    "close": ("cl", "clo"),
    "crescent": ("cr", "cres", "crescnt"),
    "drive": ("dr", "drv"),
    "gardens": ("gdn", "gdns", "gds"),
    "grove": ("gr", "gro", "grv"),
    "hill": ("hl",),
    "lane": ("la", "ln"),
    "mews": ("ms", "mws"),
    "place": ("pl", "plc"),
    "road": ("rd",),
    "row": ("rw",),
    "square": ("sq",),
    "street": ("st", "str"),
    "terrace": ("ter", "terr"),
    "way": ("wy",),
}

# Building types and their usual abbreviations.
BUILDING_TYPES = {
    "apartments": ("apts",),
    "building": ("bld", "bldg", "bldng"),
    "court": ("ct", "crt"),
    "hall": ("hl",),
    "house": ("ho", "hse"),
    "lodge": ("ldg", "ldge"),
    "mansions": ("mans", "mns"),
    "mill": ("ml",),
    "point": ("pt",),
    "tower": ("twr",),
    "wharf": ("wf", "whf"),
    "works": ("wks", "wrks"),
}

UNITS = "(?:" + "|".join(f"{w}s?" for w in UNIT_WORDS) + ")"
STREETS = "(?:" + "|".join(STREET_TYPES) + ")"
STREETS_SHORT = "(?:" + "|".join([*STREET_TYPES, *(s + r"\.?" for short in STREET_TYPES.values() for s in short)]) + ")"
POSTCODE = r"\(?[A-Z]{1,2}[0-9][0-9A-Z]?\s*[0-9][A-Z]{2}\)?"
