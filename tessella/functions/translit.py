"""Romanisation of other scripts, from the names that Unicode gives their letters.

Latin letters are folded by Column expressions (``text.latin_to_ascii``).  What is left of other scripts goes
through an Arrow UDF; rows without such letters are sent as nulls.  Cyrillic, Greek, the Indic scripts, kana and
Korean syllables are spelled by their sound, other alphabets by the first letter of the letters' names.  Han
characters have no sound here and stay; normalisation then drops them.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import latin_to_ascii

#: Letter names that are not spelled like their sound, by script (other scripts share some of these names).
NAMED = {
    "CYRILLIC": {
        "BE": "b", "VE": "v", "GHE": "g", "DE": "d", "IE": "e", "IO": "yo", "ZHE": "zh", "ZE": "z", "SHORT I": "y", "KA": "k", "EL": "l", "EM": "m",
        "EN": "n", "PE": "p", "ER": "r", "ES": "s", "TE": "t", "EF": "f", "HA": "kh", "TSE": "ts", "CHE": "ch", "SHA": "sh", "SHCHA": "shch",
        "HARD SIGN": "", "SOFT SIGN": "", "YERU": "y", "E": "e", "YU": "yu", "YA": "ya", "UKRAINIAN IE": "ye", "BYELORUSSIAN-UKRAINIAN I": "i", "YI": "yi",
    },
    "GREEK": {
        "ALPHA": "a", "BETA": "v", "GAMMA": "g", "DELTA": "d", "EPSILON": "e", "ZETA": "z", "ETA": "i", "THETA": "th", "IOTA": "i", "KAPPA": "k",
        "LAMDA": "l", "MU": "m", "NU": "n", "XI": "x", "OMICRON": "o", "PI": "p", "RHO": "r", "SIGMA": "s", "FINAL SIGMA": "s", "TAU": "t",
        "UPSILON": "y", "PHI": "f", "CHI": "ch", "PSI": "ps", "OMEGA": "o",
    },
    "KANA": {"SI": "shi", "TI": "chi", "TU": "tsu", "HU": "fu", "ZI": "ji", "DI": "ji", "DU": "zu", "WO": "o", "SMALL TU": "", "VU": "vu"},
}
#: Sounds of the parts of a Korean syllable, in the order in which Unicode composes them.
HANGUL = (
    "g kk n d tt r m b pp s ss - j jj ch k t p h".replace("-", "").split(" "),
    "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(" "),
    "- k k k n n n t l k m l l l p l m p p t t ng t t k t p t".replace("-", "").split(" "),
)
_ABUGIDAS = ("DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA")
_VOWELS = {"A", "AA", "I", "II", "U", "UU", "E", "EE", "AI", "O", "OO", "AU", "VOCALIC R", "VOCALIC RR", "VOCALIC L", "SHORT E", "SHORT O", "CANDRA E", "CANDRA O"}


_CACHE: dict[str, tuple[str, str]] = {}


def _letter(c: str) -> tuple[str, str]:
    """(sort, romanisation) of one character; sorts: consonant, sign (replaces an inherent a), mute, other."""
    if c.isascii():
        return "other", c
    base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
    if base.isascii() and base:
        return "other", base
    name = unicodedata.name(c, "")
    script = name.partition(" ")[0]
    if script in _ABUGIDAS:
        kind = name.partition(" ")[2]
        if kind == "SIGN VIRAMA":
            return "mute", ""
        if kind in ("SIGN ANUSVARA", "SIGN CANDRABINDU", "TIPPI", "BINDI"):
            return "other", "n"
        if kind == "SIGN VISARGA":
            return "other", "h"
        for head, sort in (("VOWEL SIGN ", "sign"), ("LETTER ", "letter"), ("DIGIT ", "digit")):
            if kind.startswith(head):
                sound = kind[len(head) :]
                if sort == "digit":
                    return "other", str(unicodedata.digit(c))
                if sort == "sign":
                    return "sign", sound.split()[-1].lower()
                if sound in _VOWELS:
                    return "other", sound.split()[-1].lower()
                return "consonant", sound.lower().replace(" ", "").removesuffix("a").replace("tt", "t").replace("dd", "d").replace("nn", "n")
        return "mute" if unicodedata.category(c).startswith("M") else "other", ""
    if script in ("HIRAGANA", "KATAKANA") and " LETTER " in name:
        sound = name.rpartition(" LETTER ")[2]
        return "other", NAMED["KANA"].get(sound, sound.removeprefix("SMALL ").lower())
    if "\uac00" <= c <= "\ud7a3":
        rest, tail = divmod(ord(c) - 0xAC00, 28)
        head, vowel = divmod(rest, 21)
        return "other", HANGUL[0][head] + HANGUL[1][vowel] + HANGUL[2][tail]
    if " LETTER " in name and unicodedata.category(c) != "Lo" or script in ("HEBREW", "ARABIC", "ARMENIAN", "GEORGIAN", "ETHIOPIC", "THAI", "LAO"):
        sound = name.rpartition(" LETTER ")[2].partition(" WITH ")[0]
        plain = NAMED.get(script, {}).get(sound, sound.lower() if len(sound) <= 2 else sound[:1].lower())
        if not sound or " LETTER " not in name:
            return ("mute", "") if unicodedata.category(c).startswith("M") else ("other", c)
        return "other", plain.title() if " CAPITAL " in name else plain
    digit = unicodedata.digit(c, None)
    if digit is not None:
        return "other", str(digit)
    # Marks and the sign of a long vowel are not spoken; what has no sound here (Han, marks of punctuation) stays.
    return "other", "" if unicodedata.category(c) in ("Mn", "Me", "Mc", "Lm") else c


def romanise(s: str) -> str:
    """ASCII for the scripts above: inherent vowels of Indic consonants are spoken unless a sign or virama follows."""
    out: list[str] = []
    open_ = False
    for c in s:
        if c not in _CACHE:
            if len(_CACHE) > 65_536:
                _CACHE.clear()
            _CACHE[c] = _letter(c)
        sort, plain = _CACHE[c]
        if open_ and sort not in ("sign", "mute"):
            out.append("a")
        out.append(plain)
        open_ = sort == "consonant"
    if open_:
        out.append("a")
    return "".join(out)


@F.pandas_udf(StringType())
def _romanise_udf(s: pd.Series) -> pd.Series:
    return s.map(romanise, na_action="ignore")


def to_ascii(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with the columns in ASCII; nulls become ''."""
    for c in columns:
        plain: Column = latin_to_ascii(F.coalesce(F.col(c), F.lit("")))
        other = F.when(plain.rlike(r"[^\x00-\x7f]"), plain)
        df = df.withColumn(c, F.coalesce(_romanise_udf(other), plain))
    return df
