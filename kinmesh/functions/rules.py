"""Fixed values of the linkage rules, and the expressions derived from them."""

# Legal suffixes by country.
SUFFIXES = {
    "US": ["incorporated", "inc", "llc", "l l c", "corp", "co", "ltd", "llp", "pllc"],
    "IN": [
        "private limited",
        "pvt ltd",
        "p ltd",
        "llp",
        "and sons",
        "enterprises",
        "traders",
        "प्राइवेट लिमिटेड",
        "प्रा लि",
        "പ്രൈവറ്റ് ലിമിറ്റഡ്",
        "પ્રાઇવેટ લિમિટેડ",
        "பிரைவேட் லிமிடெட்",
        "ప్రైవేట్ లిమిటెడ్",
        "প্রাইভেট লিমিটেড",
        "ಪ್ರೈವೇಟ್ ಲಿಮಿಟೆಡ್",
    ],
    "FR": ["sarl", "sas", "sasu", "sa", "eurl", "sci", "snc", "societe anonyme", "ets", "etablissements"],
}
# A prefix of Indian names.
PREFIX = "m/s"
# Street abbreviations and tokens that stay as they are.
STREETS = {"st": "street", "rd": "road", "ave": "avenue", "av": "avenue", "bd": "boulevard", "blvd": "boulevard"}
CANONICAL = ["nagar", "marg", "street", "road", "avenue", "boulevard"]
# Phrases that mark an address by a landmark.
LANDMARKS = ["opposite", "opp", "behind", "beside", "near", "nr", "b/h", "next to", "en face de", "pres de"]
# Spellings made one.
VARIANTS = {"shree": "shri", "sree": "shri", "sri": "shri", "ent": "enterprises", "aggarwal": "agarwal"}
# Texts that stand for no value.
PLACEHOLDERS = ["", "-", "0", "na", "none", "null", "n/a"]
# Literal missing marks that an audit counts.
NA_MARKS = ["", "na", "none", "nan", "null", "n/a", "-", "0"]
# Words that tell branches of one business apart.
BRANCHES = ["north", "south", "east", "west", "airport", "mall", "branch", "annex", "central", "downtown", "uptown", "main", "new", "old"]
# Punctuation read as its ASCII likeness, and characters without width.
PUNCT_FROM, PUNCT_TO = "’‘`´“”–—−", "''''\"\"---"
ZERO_WIDTH = "​‌‍﻿⁠­"
# Words before a unit number.
UNIT_WORDS = ["ste", "suite", "apt", "apartment", "unit", "flat", "shop", "office", "room", "fl", "floor", "no"]
# Country labels with a postcode shape of their own.
INDIA, USA, FRANCE = ["in", "ind", "india"], ["us", "usa", "united states", "united states of america"], ["fr", "fra", "france"]

#: suffix -> sorted countries; suffixes with more words, then more letters, first.
SUFFIX_COUNTRIES = {s: sorted(c for c, own in SUFFIXES.items() if s in own) for own in SUFFIXES.values() for s in own}
ALL_SUFFIXES = sorted(SUFFIX_COUNTRIES, key=lambda s: (-s.count(" "), -len(s), s))
BY_LENGTH = sorted(SUFFIX_COUNTRIES, key=lambda s: (-len(s), s))
