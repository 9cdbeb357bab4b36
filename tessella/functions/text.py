"""Normalisation of names and addresses as Column expressions (no Python on the executors)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Number words and what they stand for.
NUMERALS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5",
    "six": "6", "seven": "7", "eight": "8", "nine": "9", "ten": "10",
    "eleven": "11", "twelve": "12", "thirteen": "13", "fourteen": "14",
    "fifteen": "15", "sixteen": "16", "seventeen": "17", "eighteen": "18",
    "nineteen": "19", "twenty": "20", "thirty": "30", "forty": "40",
    "fifty": "50", "sixty": "60", "seventy": "70", "eighty": "80", "ninety": "90",
    "first": "1", "second": "2", "third": "3", "fourth": "4", "fifth": "5",
    "sixth": "6", "seventh": "7", "eighth": "8", "ninth": "9", "tenth": "10",
}

#: Legal forms that the core name drops from its end.
LEGAL_FORMS = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "llc", "lc",
    "ltd", "limited", "lp", "llp", "lllp", "plc", "pllc", "pc", "pvt", "private",
    "pte", "gmbh", "mbh", "ag", "kg", "kgaa", "ohg", "eg", "ug",
    "sa", "sas", "sasu", "sarl", "eurl", "snc", "sci", "scp", "sca", "scs",
    "bv", "nv", "cv", "vof", "srl", "spa", "srls", "sro", "zrt", "kft",
    "oy", "oyj", "ab", "as", "asa", "aps", "kk", "gk", "yk",
    "pty", "sdn", "bhd", "ltda", "sl", "slu", "sac", "eirl", "sprl", "doo",
    "dd", "ooo", "oao", "zao", "pao", "jsc", "ojsc", "cjsc",
    "dba", "trading", "enterprises", "enterprise",
)

#: Address words and their short forms.
ADDRESS_FORMS = {
    "street": "st", "road": "rd", "avenue": "ave", "boulevard": "blvd",
    "drive": "dr", "lane": "ln", "court": "ct", "place": "pl", "terrace": "ter",
    "highway": "hwy", "parkway": "pkwy", "circle": "cir", "square": "sq",
    "crescent": "cres", "gardens": "gdns", "grove": "grv",
    "north": "n", "south": "s", "east": "e", "west": "w",
    "northeast": "ne", "northwest": "nw", "southeast": "se", "southwest": "sw",
    "mount": "mt", "saint": "st", "fort": "ft",
    "apartment": "apt", "suite": "ste", "building": "bldg", "floor": "fl",
    "block": "blk", "sector": "sec", "phase": "ph", "district": "dist",
    "post": "po", "postal": "po", "number": "no", "num": "no",
    "rue": "r", "impasse": "imp", "chemin": "che", "route": "rte",
    "allee": "all", "quai": "q", "avenida": "ave", "calle": "cl",
    "straat": "str", "und": "and", "y": "and",
}

#: Sound groups of a skeleton, replaced in this order.
SOUND_GROUPS = (
    ("tion", "sn"), ("sion", "sn"), ("ph", "f"), ("gh", ""), ("kh", "k"), ("bh", "b"), ("th", "t"),
    ("dh", "d"), ("sh", "s"), ("ch", "c"), ("ck", "k"), ("q", "k"), ("x", "ks"),
)

#: Letters that decompose into more than a base letter and marks.
LIGATURES = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ı": "i"}


def _accents() -> tuple[str, str]:
    """Latin letters with marks up to U+024F and U+1E00-U+1EFF, and their base letters, by decomposition."""
    marked, plain = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base.isascii() and base.isalpha():
            marked.append(chr(code))
            plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _accents()


def latin_to_ascii(s: Column) -> Column:
    """Base letters for Latin letters with marks; other scripts stay (see ``translit``)."""
    out = F.translate(s, _MARKED, _PLAIN)
    for letter, plain in LIGATURES.items():
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return F.when(s.rlike(r"^[\x00-\x7f]*$"), s).otherwise(out)


def _lookup(table: dict[str, str], key: Column) -> Column:
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.coalesce(F.element_at(pairs, key), key)


def tokens(s: Column) -> Column:
    """Normalised tokens of a text: [a-z0-9]+, number words as digits, no leading zeros; null is empty."""
    s = F.lower(latin_to_ascii(F.coalesce(s, F.lit(""))))
    s = F.replace(s, F.lit("&"), F.lit(" and "))
    s = F.regexp_replace(s, r"\b(\d+)(st|nd|rd|th)\b", "$1")
    s = F.regexp_replace(s, r"(?<=[a-z])0(?=[a-z])", "o")
    s = F.regexp_replace(s, r"(?<=[a-z])(?=[0-9])|(?<=[0-9])(?=[a-z])", " ")
    parts = F.filter(F.split(s, "[^a-z0-9]+"), lambda t: t != "")
    # All zeros become one zero; other digit tokens lose their leading zeros.
    return F.transform(parts, lambda t: F.when(t.rlike("^[0-9]+$"), F.regexp_replace(t, "^0+(?=[0-9])", "")).otherwise(_lookup(NUMERALS, t)))


def normalize(s: Column) -> Column:
    return F.array_join(tokens(s), " ")


def core_name(raw: Column) -> Column:
    """A normalised name without the legal forms at its end, but never without its first token."""
    return F.regexp_replace(raw, f"( ({'|'.join(LEGAL_FORMS)}))+$", "")


def short_forms(parts: Column) -> Column:
    return F.transform(parts, lambda t: _lookup(ADDRESS_FORMS, t))


def address_words(s: Column) -> Column:
    return short_forms(tokens(s))


def numbers_of(parts: Column) -> Column:
    return F.filter(parts, lambda t: t.rlike("^[0-9]+$"))


def number_pairs_of(parts: Column) -> Column:
    """``number_nextword`` for each number with a successor."""
    n = F.size(parts)
    pairs = F.zip_with(F.slice(parts, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(parts, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws("_", a, b))
    return F.filter(pairs, lambda p: p.rlike("^[0-9]+_"))


def skeleton(t: Column) -> Column:
    """Consonant skeleton of a token: sounds that are spelled alike or dropped fall together."""
    for group, sound in SOUND_GROUPS:
        t = F.replace(t, F.lit(group), F.lit(sound))
    t = F.regexp_replace(t, "c(?=[eiy]|$)", "s")
    t = F.replace(t, F.lit("c"), F.lit("k"))
    t = F.translate(F.regexp_replace(t, "[aeiouh]", ""), "gzvwm", "jjbbn")
    return F.regexp_replace(t, r"(.)\1+", "$1")


def skeleton_text(raw: Column) -> Column:
    """Skeletons of a normalised text's tokens joined by spaces (empty ones stay as empty)."""
    return F.array_join(F.transform(F.split(raw, " "), skeleton), " ")
