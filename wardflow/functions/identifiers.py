"""Identifiers: numbers laid out in a template, contact keys, and the checks of formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accent folding, upper and lower case, position by position.
ACCENTS = "áéíóúâêôãõçÁÉÍÓÚÂÊÔÃÕÇ"
PLAIN = "aeiouaeoaocAEIOUAEOAOC"

# Brazilian document and phone formats.
FORMATS = {
    "cpf": r"^[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}$",
    "cns": r"^700 [0-9]{4} [0-9]{4} [0-9]{3}$",
    "rg": r"^[0-9]{2}\.[0-9]{3}\.[0-9]{3}-[0-9]$",
    "telefone": r"^\([0-9]{2}\) 9[0-9]{4}-[0-9]{4}$",
    "email": r"^[a-z0-9._]+@[a-z0-9.]+$",
    "crm": r"^CRM/[A-Z]{2} [0-9]{6}$",
}


def laid_out(number: Column, template: str) -> Column:
    """A whole number >= 0 in a template: every ``#`` is a digit, from the right, zeros in front.

    NULL for NULL, and for a number that is negative or has more digits than the template.
    """
    width = template.count("#")
    digits = F.lpad(number.cast("string"), width, "0")
    parts, at = [], 1
    for literal in template.split("#")[:-1]:
        if literal:
            parts.append(F.lit(literal))
        parts.append(F.substring(digits, at, 1))
        at += 1
    if tail := template.rsplit("#", 1)[-1]:
        parts.append(F.lit(tail))
    fits = (number >= 0) & (F.length(number.cast("string")) <= width)
    return F.when(fits, F.concat(*parts))


def ascii_key(*parts: Column) -> Column:
    """Lower-case contact key without accents, parts joined by a dot; NULL if a part is."""
    pieces = [F.translate(parts[0], ACCENTS, PLAIN)]
    for part in parts[1:]:
        pieces += [F.lit("."), F.translate(part, ACCENTS, PLAIN)]
    return F.lower(F.concat(*pieces))


def email(first: Column, last: Column, key: Column, domain: str) -> Column:
    return F.concat(ascii_key(first, last), key.cast("string"), F.lit("@" + domain))


def matches(column: Column, kind: str) -> Column:
    """True where the whole value has the format of ``kind``; NULL for NULL."""
    return column.rlike(FORMATS[kind])
