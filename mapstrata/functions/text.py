"""Cleaning of text columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for "missing" in a delimited file.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Every character that counts as white space in Unicode text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def missing_to_null(text: Column) -> Column:
    return F.when(~text.isin(*MISSING_TEXTS), text)


def stripped(text: Column) -> Column:
    """``trim`` alone removes only spaces; the character set also covers tabs, line ends, ..."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def blank_to_null(text: Column) -> Column:
    return F.when(F.ltrim(text, F.lit(WHITE_SPACE)) != "", text)


def zero_padded(text: Column, width: int) -> Column:
    """Zeros on the left up to ``width``, after a sign if there is one; never truncates."""
    signed = text.rlike("^[+-]")
    padded = F.when(
        signed, F.concat(F.substring(text, 1, 1), F.lpad(F.substr(text, F.lit(2)), width - 1, "0"))
    ).otherwise(F.lpad(text, width, "0"))
    return F.when(F.length(text) >= width, text).otherwise(padded)


def _folding_table() -> tuple[str, str]:
    """Accented letters up to U+017F and the plain letter each one decomposes to."""
    accented, plain = [], []
    for point in range(0xA1, 0x180):
        letters = [c for c in unicodedata.normalize("NFKD", chr(point)) if not unicodedata.combining(c)]
        if len(letters) == 1 and letters[0].isascii() and letters[0].isalnum():
            accented.append(chr(point))
            plain.append(letters[0])
    return "".join(accented), "".join(plain)


def accents_folded(text: Column) -> Column:
    """Plain Latin letters; combining marks of decomposed text are dropped."""
    accented, plain = _folding_table()
    marks = "".join(chr(point) for point in range(0x300, 0x370))
    return F.translate(text, accented + marks, plain)


def source_name_normalized(text: Column) -> Column:
    """Name of the catalogue that a metadata row points to."""
    plain = accents_folded(stripped(F.replace(text, F.lit(":"), F.lit(""))))
    return F.regexp_replace(plain, r"(?U)\s*_\s*", "_")


def catalog_name_normalized(text: Column) -> Column:
    """Name under which a catalogue is filed."""
    return F.regexp_replace(F.upper(accents_folded(text)), "^CAT ", "CATALOGO ")
