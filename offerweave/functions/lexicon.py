"""Word lists of the title and brand rules."""

from __future__ import annotations

# Results depend on exactly these entries.

#: Brand lookup key -> brand.
BRAND_ALIASES = {
    "APPLE": "Apple",
    "SAMSUNG": "Samsung",
    "SAMSUNGELECTRONICS": "Samsung",
    "LG": "LG",
    "LGELECTRONICS": "LG",
    "SONY": "Sony",
    "XIAOMI": "Xiaomi",
    "XIAOMIMIJIA": "Xiaomi",
    "MI": "Xiaomi",
    "REDMI": "Xiaomi",
    "POCO": "Xiaomi",
    "HUAWEI": "Huawei",
    "HONOR": "Honor",
    "LENOVO": "Lenovo",
    "HP": "HP",
    "HEWLETTPACKARD": "HP",
    "DELL": "Dell",
    "ASUS": "ASUS",
    "ASUSTEK": "ASUS",
    "ACER": "Acer",
    "MSI": "MSI",
    "MICROSTAR": "MSI",
    "MICROSOFT": "Microsoft",
    "GOOGLE": "Google",
    "JBL": "JBL",
    "BOSE": "Bose",
    "SENNHEISER": "Sennheiser",
    "DELONGHI": "De'Longhi",
    "BELONGHI": "De'Longhi",
    "NESPRESSO": "Nespresso",
    "PHILIPS": "Philips",
    "PHILIPSHUE": "Philips",
    "BOSCH": "Bosch",
    "SIEMENS": "Siemens",
    "WHIRLPOOL": "Whirlpool",
    "AEG": "AEG",
    "ELECTROLUX": "Electrolux",
    "BEKO": "Beko",
    "TOSHIBA": "Toshiba",
    "PANASONIC": "Panasonic",
    "DYSON": "Dyson",
    "TEFAL": "Tefal",
    "TFAL": "Tefal",
    "CANON": "Canon",
    "NIKON": "Nikon",
    "GOPRO": "GoPro",
    "GARMIN": "Garmin",
    "NINTENDO": "Nintendo",
    "ONEPLUS": "OnePlus",
    "OPPO": "OPPO",
    "REALME": "Realme",
    "TCL": "TCL",
    "HISENSE": "Hisense",
    "LOGITECH": "Logitech",
    "LOGITECHG": "Logitech",
    "MARSHALL": "Marshall",
    "BANGOLUFSEN": "Bang & Olufsen",
    "BO": "Bang & Olufsen",
    "SONOS": "Sonos",
    "AMAZON": "Amazon",
    "MOTOROLA": "Motorola",
    "NOTHING": "Nothing",
    "HAIER": "Haier",
    "MIDEA": "Midea",
    "INVENTOR": "Inventor",
    "CANDY": "Candy",
    "HOOVER": "Hoover",
    "IROBOT": "iRobot",
    "ROBOROCK": "Roborock",
    "ECOVACS": "Ecovacs",
    "BREVILLE": "Breville",
    "SAGE": "Sage",
    "SENCOR": "Sencor",
    "PROMOUNTS": "Pro-Mounts",
    "BOWERSWILKINS": "Bowers & Wilkins",
    "BW": "Bowers & Wilkins",
    "FRESHNREBEL": "Fresh 'n Rebel",
    "OTL": "OTL",
    "PHLIPS": "Philips",
    "BANGAMPOLUFSENBAMPO": "Bang & Olufsen",
    "BOWERSAMPWILKINSBAMPW": "Bowers & Wilkins",
    "FRESHANDREBEL": "Fresh 'n Rebel",
    "OTLTECHNOLOGIES": "OTL",
    "IPHONE": "Apple",
    "AIRPODS": "Apple",
    "GALAXY": "Samsung",
}

#: Lookup keys of product lines; these words stay in titles.
PRODUCT_LINES = ("IPHONE", "AIRPODS", "GALAXY")

#: Colour and finish words and phrases that titles lose.
COLOURS = (
    "black", "white", "blue", "red", "green", "silver", "gold", "grey", "gray", "pink", "purple", "yellow",
    "orange", "brown", "beige", "cream", "ivory", "bronze", "copper", "coral", "μαυρο", "λευκο", "μπλε", "κοκκινο",
    "πρασινο", "ασημι", "χρυσο", "γκρι", "ροζ", "μωβ", "κιτρινο", "πορτοκαλι", "καφε", "μπεζ", "space gray",
    "space grey", "space black", "sierra blue", "pacific blue", "alpine green", "deep purple", "deep blue",
    "deep navy", "baltic blue", "anchor blue", "electric lavender", "soft pink", "bright guava", "light moss",
    "cosmic orange", "silver shadow", "natural titanium", "blue titanium", "black titanium", "white titanium",
    "desert titanium", "titanium", "τιτανιο", "product red", "phantom black", "phantom white", "phantom",
    "mystic bronze", "ice blue", "sky blue", "ocean blue", "forest green", "sage green", "rose gold", "matte black",
    "jet black", "ceramic white", "cloudy white", "stormy black", "sorta sage", "graphite", "midnight", "starlight",
    "obsidian", "hazel", "porcelain", "charcoal", "chalk", "lavender", "burgundy", "lime", "mint", "clear", "lilac",
    "desert stone", "inox", "alpine", "ocean", "ultramarine", "teal", "navy", "icyblue", "peach", "indigo", "blush",
    "citrus", "vanilla", "guava", "tangerine", "cosmic", "lila", "awesome",
)

#: Shop words and separators that titles lose.
NOISE = (
    "stephanis", "kotsovolos", "public", "istorm", "electroline", "bionic", "online", "buy now", "shop now",
    "best price", "free shipping", "new arrival", "official", "original", "genuine", "brand new", "in stock",
    "αγορα", "προσφορα", "εκπτωση", "δωρεαν", "αποστολη", "επισημο", "εγγυηση", "τιμη", "|", "–", "—", "·",
)

#: Greek capitals that look like Latin ones, and those.
GREEK_CAPITALS, LATIN_CAPITALS = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"

#: Greek letters and their Latin transliteration in category fingerprints.
GREEK_LETTERS, LATIN_LETTERS = "αβγδεζηικλμνξοπρσςτυφχω", "abgdeziiklmnxoprsstyfxo"
GREEK_PAIRS = {"θ": "th", "ψ": "ps"}

#: Letters after a number that make a token a quantity and not a model code.
UNIT_SUFFIXES = (
    "gb", "tb", "mb", "kb", "mah", "wh", "w", "v", "a", "mbps", "gbps", "ghz", "mhz", "hz", "in", "mm", "cm", "nm",
    "l", "ml", "rpm", "k", "bar", "lt", "pin", "bit", "pcs", "tmx",
)

#: Codes that match one of these from their start describe a specification.
SPEC_PATTERNS = (
    r"\d{1,2}inch$", r"\d{1,2}kg(\d{1,2}kg)?$", r"\d+in\d+$", r"\d{3,4}p$", r"\d{4,5}btu$", r"(\d+)?gb\d+(gb|tb)$",
    r".*\d+core.*", r".*core\d+.*", r"[a-z]?\d{3,}[a-z]\d+gb", r"gen\d+$", r"pro\d+$", r"ip\d{2}$", r"\d+gpu$", r"watch\d+$",
)
SERIES_SUFFIX = r"^\d{3,4}[a-z]{1,2}$"
