"""Text cleaning, parsing of names, keys and keyword classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "NULL_LITERALS", "TRUE_TOKENS", "FALSE_TOKENS", "EMAIL_PATTERN",
    "as_column", "strip_bom", "strip_blank", "clean_null", "has_mojibake", "repair_mojibake",
    "parse_bool", "delimiter_of", "cp1252_from_latin1", "surrogate_key",
    "code_lookup", "first_keyword", "matches_class", "known_or_unknown",
    "building_of_file", "occupancy_kind_of_file", "range_end_of_file", "prefixed_id",
    "is_null_literal",
]

# --- fixed values: must equal the source system's conventions -------------------
NULL_LITERALS = ("NULL", "null", "None", "none", "")
TRUE_TOKENS = ("TOSI", "true", "True", "1", "yes", "YES")
FALSE_TOKENS = ("EPÄTOSI", "EPATOSI", "false", "False", "0", "no", "NO")
MOJIBAKE_PATTERN = "Ã[\u0080-\u00BF]|â€|ï¿½"
MOJIBAKE_REPLACEMENTS = (
    ("Ã¤", "ä"), ("Ã„", "Ä"), ("Ã¶", "ö"), ("Ã–", "Ö"),
    ("Ã¥", "å"), ("Ã…", "Å"), ("Ã©", "é"), ("Ã¼", "ü"),
)
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
UTILIZATION_FILE_PATTERN = r"Room_Utilization_(\d{6})-(\d{6})\.csv$"
# the 27 characters Windows-1252 puts where ISO-8859-1 has control codes
CP1252_EXTRA = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡",
    0x88: "ˆ", 0x89: "‰", 0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘",
    0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•", 0x96: "–", 0x97: "—", 0x98: "˜",
    0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
# ---------------------------------------------------------------------------------

BOM = "\ufeff"
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_bom(c: Column | str) -> Column:
    return F.ltrim(as_column(c), F.lit(BOM))


def strip_blank(c: Column | str) -> Column:
    """Trim every kind of white space, not only U+0020."""
    return F.btrim(as_column(c), F.lit(BLANKS))


def clean_null(c: Column | str) -> Column:
    """Trim, drop a leading byte-order mark and turn null literals into null."""
    text = strip_bom(strip_blank(c))
    return F.when(~text.isin(*NULL_LITERALS), text)


def is_null_literal(c: Column | str) -> Column:
    return F.coalesce(as_column(c).isin(*NULL_LITERALS), F.lit(False))


def has_mojibake(c: Column | str) -> Column:
    return as_column(c).rlike(MOJIBAKE_PATTERN)


def repair_mojibake(c: Column | str, strict: bool = False) -> Column:
    """Undo UTF-8 read as Latin-1. Text without the tell-tale pattern is untouched.

    What stays broken is left for ``has_mojibake`` to flag, or raises if ``strict``.
    """
    text = as_column(c)
    fixed = text
    for bad, good in MOJIBAKE_REPLACEMENTS:
        fixed = F.replace(fixed, F.lit(bad), F.lit(good))
    repaired = F.when(has_mojibake(text), fixed).otherwise(text)
    if strict:
        message = F.concat(F.lit("unrecoverable mojibake: "), F.substring(repaired, 1, 80))
        return F.when(has_mojibake(repaired), F.raise_error(message)).otherwise(repaired)
    return repaired


def parse_bool(c: Column | str, strict: bool = False) -> Column:
    token = clean_null(c)
    parsed = F.when(token.isin(*TRUE_TOKENS), True).when(token.isin(*FALSE_TOKENS), False)
    if strict:
        wrong = F.raise_error(F.concat(F.lit("unrecognised boolean: "), token))
        return F.when(token.isNotNull() & parsed.isNull(), wrong.cast("boolean")).otherwise(parsed)
    return parsed


def delimiter_of(text: Column | str) -> Column:
    """``;`` when it outnumbers ``,`` in the first line, else ``,``."""
    header = F.substring_index(as_column(text), "\n", 1)
    semicolons = F.length(header) - F.length(F.replace(header, F.lit(";"), F.lit("")))
    commas = F.length(header) - F.length(F.replace(header, F.lit(","), F.lit("")))
    return F.when(semicolons > commas, F.lit(";")).otherwise(F.lit(","))


def cp1252_from_latin1(c: Column | str) -> Column:
    """Text decoded as ISO-8859-1 becomes what Windows-1252 would have given.

    Spark 4 refuses ``windows-1252`` as a charset; the two differ in 27 code
    points only, so reading ISO-8859-1 and translating those is exact.
    """
    return F.translate(as_column(c), "".join(map(chr, CP1252_EXTRA)), "".join(CP1252_EXTRA.values()))


def surrogate_key(*parts: Column | str) -> Column:
    """First 16 hex digits of the SHA-256 of the ``|``-joined parts.

    A null part counts as the text ``None`` (``concat_ws`` would skip it and let
    two different keys collide).
    """
    texts = [F.coalesce(as_column(p).cast("string"), F.lit("None")) for p in parts]
    return F.substring(F.sha2(F.concat_ws("|", *texts), 256), 1, 16)


def code_lookup(c: Column | str, codes: Mapping, default: str | None = None) -> Column:
    """Strict code map; codes outside it (and null) become ``default``."""
    column = as_column(c)
    if all(isinstance(code, str) for code in codes):
        # one look-up in a constant: the column is not repeated for every code
        found = F.try_element_at(F.create_map(*[F.lit(x) for pair in codes.items() for x in pair]), column.cast("string"))
        return found if default is None else F.coalesce(found, F.lit(default))
    chain = None
    for code, label in codes.items():
        test = column == F.lit(code)
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain if default is None else chain.otherwise(F.lit(default))


def first_keyword(c: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first needle found in the lower-cased text; null counts as empty."""
    text = F.lower(F.coalesce(as_column(c), F.lit("")))
    chain = F
    for needle, label in rules:
        chain = chain.when(text.contains(needle.lower()), F.lit(label))
    return chain.otherwise(F.lit(default))


def matches_class(c: Column | str, pattern: str) -> Column:
    return strip_blank(c).rlike(pattern)


def known_or_unknown(c: Column | str) -> Column:
    return F.coalesce(as_column(c).cast("string"), F.lit("unknown"))


def building_of_file(name: Column | str, buildings: Sequence[str]) -> Column:
    """Building label from an occupancy export's name (``My_House_2026…json``)."""
    stems = "|".join(b.replace(" ", "_") for b in buildings)
    stem = F.regexp_extract(as_column(name), f"^({stems})_", 1)
    return F.when(stem != "", F.replace(stem, F.lit("_"), F.lit(" ")))


def occupancy_kind_of_file(name: Column | str) -> Column:
    return F.when(as_column(name).contains("-normalized"), "normalized").otherwise("raw_count")


def range_end_of_file(name: Column | str) -> Column:
    """End date of ``Room_Utilization_DDMMYY-DDMMYY.csv``; null for other names."""
    end = F.regexp_extract(as_column(name), UTILIZATION_FILE_PATTERN, 2)
    return F.to_date(F.when(end != "", end), "ddMMyy")


def prefixed_id(prefix: str, c: Column | str, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), as_column(c).cast("string"), F.lit(suffix))
