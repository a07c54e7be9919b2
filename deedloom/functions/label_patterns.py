"""Patterns of the address labelling rules."""

from __future__ import annotations

# Fragments that the patterns below are made of.
ROAD = r"((road|street|lane|way|gate|avenue|close|drive|hill|place|terrace|crescent|square|walk|grove|mews|row|view|boulevard|pleasant|vale|yard|chase|rise|green|passage|friars|viaduct|promenade|\bend|\bridge|embankment|villas|circus|\bpath|pavement))\b( east| west| north| south)?"
WORDS = r"(?<!\S)(?:(?!\b(?:at|on|in|adjoining|of|off|above|being|and|to)\b)[^\),\n\d])*?\s?"
FIRST_WORDS = r"^(?<!\S)(?:(?!\b(?:apartment\b|penthouse|flat|ground|basement|suite|\broom|(first|second|third|fourth|fith|sixth|seventh) floor|(the )?(airspace|land|plot|unit|car|parking|store|storage)|at|on|in|adjoining|of|off|and|to)\b)[^\),\n\d])*?\s?"
WAYGATE = r"(way|gate)(\b(east|west|north|south))?"
SPECIAL_BUILDINGS = r"(the knightsbridge(?=,)|lake shore(?=,)|chichester rents|20:20 house|travelodge|little chef|the forge|(?<=\s)x1 [a-z\s]+(?=,)|the cube|belgravia gate|the chilterns|the Belvedere|(one hyde park)(?=,)|park plaza westminster bridge|" + WORDS + "exchange)"
SPECIAL_STREETS = r"((kensington gore|wilds rents|the mound|high holborn|pall mall|lower mall|haymarket|lower marsh|marsh wall|whyke marsh|london wall|cheapside|eastcheap|piccadilly|aldwych|the strand|strand|bevis marks|old bailey|threelands|pendenza|castelnau|the old meadow|hortonwood|thoroughfare|navigation loop|turnberry|brentwood|hatton garden|greenacres|whitehall|the quadrangle|green lanes|old jewry|st mary axe|minories|foxcover|meadow brook|daisy brook|upper ground|march wall|millharbour|aztec west|trotwood|marlowes|petty france|petty cury|the quadrant|the spinney|robins corner|houndsditch|frogmoor|hanging birches|the birches|arthurstone birches|monks wood|the cedars|the meadows|sandiacre|millbank|moorfields))"
WELSH_STREETS = r"(pendre|ryw blodyn|bryn owain|pen y dre|maes yr haf|heol staughton|glantraeth|tai maes|hafod alyn|cae alaw goch|ynys y wern|dol isaf|bro deg|eglwys teg|heol-y-frenhines|downleaze cockett|waun daniel|twyni teg|llwyn onn|delffordd|coed-y-brain|waun Y felin|glan Y lli|ty-draw)"
POSTCODE = r"\b[a-z]{1,2}\d[a-z0-9]?\s\d[a-z]{2}\b"
CITY = r"(london|birmingham|manchester|liverpool|leeds|sheffield|brighton|leicester|newcastle|southhampton|portsmouth|cardiff|coventry|swansea|reading|sunderland)"
BUILDING = r"\b(school|church|workshops|court|house|inn|tavern|hotel|annex|cinema(s)?|office|centre|center|building(s)?|bungalow|[a-z]*works|farm|cottage|lodge|home|point|arcade(s)?|institute|hall|mansions|country club|apartments( east| south| west| north)?|(tower(s)?)(\s\w+)?)"
RANGE = r"\d+[a-z]?\s?(?:to|-|/)\s?\d+[a-z]?\b"
OTHER_UNITS = r"(airspace|unit|land|plot|store|storage|storage pod|storage locker|\broom|suite|studio)"
UNITS = r"(?:flat|apartment|unit|penthouse|plot)s?"
ENDS = r"(?=,| and|$|;|:|\()"

# Of each rule the name, label, pattern, whether case is ignored, the group that is the span, and when it
# applies (always, only to texts with a flat tag, only without one, or only without a commercial park tag).
RULES = (
    ("building", "building_name", WORDS + BUILDING + r"\b(?=,| and|$|;|:|\(|\s\d+,)", True, 0, "always"),
    ("building_special", "building_name", WORDS + SPECIAL_BUILDINGS + ENDS, True, 0, "always"),
    ("mill", "building_name", r"(?<=[0-9]|,|\))\s([a-z][a-z'\s]+mill)(?=,| and|$|;|:)", True, 1, "always"),
    ("number_comma_building", "building_name", UNITS + r" (?:[a-z]|\d+[a-z0-9\-\.]*|" + RANGE + r"),\s([a-z\s.']+)(?=,)", True, 1, "always"),
    ("start_only_letters", "building_name", FIRST_WORDS + ENDS, True, 0, "always"),
    ("wharf_building", "building_name", r"(([a-z']+\s)+(wharf|quay|croft|priory|maltings|locks|gardens))(?:,)(?=[0-9a-z'\s]+" + ROAD + ")", True, 1, "always"),
    ("word_building_number", "building_name", r"(block|building) ([a-z]([0-9]?)|\d+|)(?=,)", True, 0, "always"),
    ("city_match", "city", r".*,\s*([^,]*?)(?=(?:(\sand\s|\s?\(?" + POSTCODE + r")[^,]*)?$)", True, 1, "always"),
    ("number_filter", "number_filter", r"(?<=\()\s?(odd|even)(?=s?\b)", True, 0, "always"),
    ("postcodes", "postcode", POSTCODE, True, 0, "always"),
    ("knightsbridge_road", "street_name", r"(?<=\d\s)knightsbridge(?=,)", False, 0, "always"),
    ("meadows", "street_name", r"(?<=[0-9]\s)[a-z][a-z'\s]*meadow(s)?(?=,| and|$|;|:)", True, 0, "always"),
    ("number_words_road", "street_name", r"(?<=\d\s)(\b[a-z]+\s){2,5}(" + ROAD + ")", False, 0, "always"),
    ("park_roads", "street_name", r"\b[a-z][\sa-z']*park(?=,| and| \(|$)", True, 0, "not park"),
    ("road_followed_city", "street_name", WORDS + ROAD + r"(?=\s" + CITY + ")", True, 0, "always"),
    ("road_names_basic", "street_name", WORDS + ROAD + r"(?=,| and| \(|$|;|:|\s" + CITY + ")", True, 0, "always"),
    ("side", "street_name", r"(new road|lodge|carr moor|lake|chase|thames|kennet|coppice|church|pool) side", True, 0, "always"),
    ("special_street_names", "street_name", SPECIAL_STREETS + r"(?=,| and| \(|$)", True, 0, "always"),
    ("special_welsh", "street_name", WELSH_STREETS, True, 0, "always"),
    ("the_dales", "street_name", r"(kirk|rye|avon|willow|darely |glen|thrush|nidder|moorside |arkengarth|wester|deep|fern|grise|common|moss)dale(?=,| and|$)", True, 0, "always"),
    ("special_welsh", "street_name", WELSH_STREETS, True, 0, "always"),
    ("wharf_road", "street_name", r"(" + WORDS + r"\b(wharf|quay(s)?|approach|parade|field(s)?|croft|priory|maltings|locks|gardens))(?:,)(?![0-9a-z'\s]+" + ROAD + ")", True, 1, "always"),
    ("words_waygate", "street_name", WORDS + WAYGATE + r"(?=,| and| \()", False, 0, "always"),
    ("preposition_number_words_road", "street_number", r"(?:\b(?:at|on|in|adjoining|of|above|off|and|being|next to)\s)(\d+[a-z]?)(?=(\s([a-z])+('s)?)+(\s" + ROAD + r")?)", False, 1, "always"),
    ("and_number", "street_number", r"(?<=and\s)(\d+[a-z]?)\b", False, 0, "not flat"),
    ("begins_with_number", "street_number", r"^(\d+([a-z])?)\b(?!(\s?(to|-)\s?)(\d+)\b)", False, 0, "not flat"),
    ("comma_number_words_road", "street_number", r"(?<=,\s)\d+[a-z]?(?=(\s([a-z])+('s)?)+(\s" + ROAD + r")?)", False, 0, "always"),
    ("no_road_near", "street_number", r"(at|on|in|adjoining|of|off|and|to|being|,)\s(\d+[a-z]?)\b(?=,| and|;|:|\s\()", True, 2, "not flat"),
    ("range", "street_number", RANGE, True, 0, "not flat"),
    ("range", "street_number", RANGE + r"(?=(([a-z'\s]+" + ROAD + r")|" + SPECIAL_STREETS + r"))", True, 0, "flat"),
    ("and_number_flats", "unit_id", r"(?<=and\s)(\d+(\w{1})?)", False, 0, "flat"),
    ("number_before_building", "unit_id", r"^([a-z]?\d+[a-z0-9\-\.]*),?\s+[^,]*?" + BUILDING, True, 1, "always"),
    ("carpark_id", "unit_id", r"^(the )?(garage(s)?( space)?|parking(\s)?space|parking space(s)?|car park(ing)?( space))\s([a-z0-9\-\.]+\b)", True, 9, "always"),
    ("comma_number_comma_flat", "unit_id", r"(?<=,\s)(\d+([a-z])?)(?=,)", False, 0, "flat"),
    ("flat_letter", "unit_id", UNITS + r"\s([a-z][0-9\.\-]*)(?=,)", True, 1, "always"),
    ("flat_letter_complex", "unit_id", UNITS + r"\s([a-z](\d|\.|-)[a-z0-9\-\.]*)", True, 2, "always"),
    ("flat_number", "unit_id", UNITS + r"\s(\d+[a-z0-9\-\.]*)", True, 1, "always"),
    ("number_and_flat", "unit_id", r"(?<!(-))\s(\d+)(?=\sand)", True, 2, "flat"),
    ("unit_id", "unit_id", r"(the )?" + OTHER_UNITS + r"(s)?\s(\d[a-z0-9\-\.]*)", True, 4, "always"),
    ("unit_letter", "unit_id", OTHER_UNITS + r"s?\s([a-z](?=,| and)|[a-z](\d|\.|-)[a-z0-9\-\.]*)", True, 2, "always"),
    ("range_flat", "unit_id", RANGE + r"(?!\s(being|-|[a-z'\s]+" + ROAD + r"|" + SPECIAL_STREETS + "))", True, 0, "flat"),
    ("flat_unit", "unit_type", r"(apartment|flat|penthouse|unit|plot)\b(?!being)", True, 0, "always"),
    ("is_carpark", "unit_type", r"^(garage(s)?|parking(\s)?space|parking space(s)?|car park(ing)?)", True, 0, "always"),
    ("is_other_class", "unit_type", OTHER_UNITS, True, 0, "always"),
)

#: Rules of which only the first match in a text counts.
FIRST_ONLY = {"begins_with_number", "number_before_building"}
#: Rules whose span is where their group's text first occurs within the match, which may be before the group.
FOUND_IN_MATCH = {"flat_letter", "flat_number"}
