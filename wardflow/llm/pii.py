"""Personal data in texts: found, validated, and replaced by format-preserving pseudonyms.

A value is permuted within its format by a keyed Feistel network: digits stay digits, letters
letters, a valid check digit stays valid, a date stays a date. Equal values get equal pseudonyms
in all documents, also where they are written with other separators. DataFrame code only.

Kinds: card (Luhn), number (13 to 19 digits without a valid check digit), iban (modulo 97), ssn,
phone (international), ip, date, email (its local part), secret (32 to 64 hexadecimal digits).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
HALF_BYTES = 32                # shifts that one SHA-256 gives; longer halves use them again
EPOCH, CYCLE = "1800-01-01", 146_097   # days of 400 years, as a product:
CYCLE_PARTS = (189, 773)

_EDGE, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
KINDS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
    "ip": rf"(?<![0-9]\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
    "secret": r"(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})",
}
PHONE = r"(?<![A-Za-z0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,5}){1,4}(?![0-9])"
_BEFORE_TIME = r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?=T[0-9])"
PATTERN = f"{PHONE}|{_EDGE}(?:{_BEFORE_TIME}|(?:{'|'.join(KINDS.values())}){_END})"

# Characters of an IBAN, fixed by its country.
IBAN_LENGTHS = {code: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for code in codes.split()}

# A mark ends a candidate inside a longer match. No pattern matches these characters.
_ESCAPE, _ESCAPED, _MARK = "\x01", "\x01\x02", "\x01\x03"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _concat(parts: Column) -> Column:
    return F.array_join(parts, "")


def _digest(key: str, round_: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), round_.cast("string"), value.cast("string")).cast("binary"), 256)


# ---- Feistel networks ----

def permute_text(value: Column, key: str, letters: int = 26, back: bool = False) -> Column:
    """Permutes a text within its classes: each digit, lower-case and upper-case letter becomes
    another of its class (the first ``letters`` of the alphabet), other characters stay.
    ``back`` inverts it."""
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), half).alias("a"),
                     F.substring(value, half + 1, F.length(value)).alias("b"))
    sign = F.lit(-1 if back else 1)

    def shifted(text: Column, digest: Column) -> Column:
        def one(i: Column) -> Column:
            c = F.substring(text, i, F.lit(1))
            by = F.conv(F.substring(digest, (i - 1) % HALF_BYTES * 2 + 1, F.lit(2)), 16, 10).cast("int") * sign
            move = lambda first, n: F.char(F.ascii(c) * 0 + first + F.pmod(F.ascii(c) - first + by, F.lit(n)))
            last = lambda first: chr(first + letters - 1)
            return (F.when(c.between("0", "9"), move(48, 10))
                    .when(c.between("a", last(97)), move(97, letters))
                    .when(c.between("A", last(65)), move(65, letters)).otherwise(c))
        return F.when(F.length(text) > 0, _concat(F.transform(F.sequence(F.lit(1), F.length(text)), one))).otherwise("")

    def forth_round(s: Column, r: Column) -> Column:
        return F.struct(s["b"].alias("a"), shifted(s["a"], _digest(key, r, s["b"])).alias("b"))

    def back_round(s: Column, r: Column) -> Column:
        return F.struct(shifted(s["b"], _digest(key, F.lit(ROUNDS + 1) - r, s["a"])).alias("a"), s["a"].alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, back_round if back else forth_round,
                       lambda s: F.concat(s["a"], s["b"]))


def permute_number(value: Column, parts: tuple[int, int], key: str, back: bool = False) -> Column:
    """Permutes 0 <= value < parts[0] * parts[1]; ``back`` inverts it."""
    m, n = (F.lit(p).cast("long") for p in parts)
    start = F.struct(F.floor(value / n).cast("long").alias("a"), F.pmod(value.cast("long"), n).alias("b"))

    def step(s: Column, i: Column) -> Column:
        r = F.lit(ROUNDS + 1) - i if back else i
        add = lambda of: F.conv(F.substring(_digest(key, r, of), 1, 12), 16, 10).cast("long") * (-1 if back else 1)
        odd = r % 2 == 1
        return F.struct(F.when(odd, F.pmod(s["a"] + add(s["b"]), m)).otherwise(s["a"]).alias("a"),
                        F.when(odd, s["b"]).otherwise(F.pmod(s["b"] + add(s["a"]), n)).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["a"] * n + s["b"])


# ---- formats ----

def _only(value: Column, kept: str) -> Column:
    return F.regexp_replace(value, f"[^{kept}]", "")


def _laid(value: Column, pseudonym: Column, places: str) -> Column:
    """The pseudonym's characters in the places of the value's, separators as they were."""
    def one(i: Column) -> Column:
        c = F.substring(value, i, F.lit(1))
        at = F.length(_only(F.substring(value, F.lit(1), i), places))
        return F.when(c.rlike(f"[{places}]"), F.substring(pseudonym, at, F.lit(1))).otherwise(c)
    return _concat(F.transform(F.sequence(F.lit(1), F.length(value)), one))


def luhn_digit(payload: Column) -> Column:
    """The check digit behind a payload of digits."""
    def one(i: Column) -> Column:
        d = F.substring(payload, F.length(payload) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)
    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(payload)), one), F.lit(0), lambda a, x: a + x)
    return F.pmod(-total, F.lit(10)).cast("string")


def _mod97(text: Column) -> Column:
    def add(acc: Column, i: Column) -> Column:
        c = F.substring(text, i, F.lit(1))
        digit = c.between("0", "9")
        return (acc * F.when(digit, 10).otherwise(100)
                + F.when(digit, F.ascii(c) - 48).otherwise(F.ascii(c) - 55)) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _date_format(value: Column) -> Column:
    two = value.rlike(r"^[0-9]{2}[./][0-9]{2}[./]")
    day_first = F.when(two, "dd/MM/yyyy").otherwise("d/M/yyyy")
    month_first = F.when(two, "MM/dd/yyyy").otherwise("M/d/yyyy")
    return (F.when(value.contains("-"), "yyyy-MM-dd")
            .when(value.contains("."), F.when(two, "dd.MM.yyyy").otherwise("d.M.yyyy"))
            .when(F.split(value, "/")[1].cast("int") > 12, month_first).otherwise(day_first))


def _as_date(value: Column) -> Column:
    """The date, or null if there is no such day; slashes are day first unless that is none."""
    n = lambda i: F.split(value, "[-./]")[i].cast("int")
    year, month, day = (F.when(value.contains("-"), x).otherwise(y) for x, y in (
        (n(0), n(2)), (n(1), n(1)), (n(2), n(0))))
    swapped = value.contains("/") & (n(1) > 12)
    return F.when(year > 0, F.to_date(F.call_function(
        "try_make_timestamp", year, F.when(swapped, day).otherwise(month),
        F.when(swapped, month).otherwise(day), F.lit(0), F.lit(0), F.lit(0))))


def _iban_ok(value: Column) -> Column:
    packed = F.regexp_replace(value, " ", "")
    return _mod97(F.concat(F.substring(packed, F.lit(5), F.length(packed)), F.substring(packed, 1, 4))) == 1


def _luhn_ok(value: Column) -> Column:
    digits = _only(value, "0-9")
    return luhn_digit(F.substring(digits, F.lit(1), F.length(digits) - 1)) == F.right(digits, F.lit(1))


def kind_of(value: Column) -> Column:
    """The kind of a match, null if its check fails."""
    is_ = lambda kind: value.rlike(f"^(?:{KINDS[kind]})$")
    ssn_ok = ~value.rlike(r"^(?:000|666|9)") & ~value.rlike(r"-00-|-0000$")
    return (F.when(value.contains("@"), "email")
            .when(value.startswith("+"), "phone")
            .when(is_("ip"), "ip")
            .when(is_("date"), F.when(_as_date(value).isNotNull(), "date"))
            .when(is_("ssn"), F.when(ssn_ok, "ssn"))
            .when(is_("card"), F.when(_luhn_ok(value), "card").otherwise("number"))
            .when(is_("secret"), F.when(value.rlike("[0-9]") & value.rlike("[a-fA-F]"), "secret"))
            .when(is_("iban"), F.when(_iban_ok(value), "iban")))


def _cut(value: Column) -> Column:
    """After how many characters a candidate ends inside a match; 0 if it is the whole match.

    A number without a valid check digit ends at its longest beginning that is a card, an IBAN
    where its country's length and the check say so. What looks like an IBAN and has not its
    country's length is none; its first group ends it, so that the next may begin a candidate.
    """
    ends = F.filter(F.sequence(F.lit(1), F.length(value) - 1),
                    lambda i: F.substring(value, i + 1, F.lit(1)).isin(" ", "-"))
    head = lambda i: F.substring(value, F.lit(1), i)
    size = lambda text: F.length(F.regexp_replace(text, " ", ""))
    digits = lambda i: F.length(_only(head(i), "0-9"))
    cards = F.filter(ends, lambda i: digits(i).between(13, 19) & _luhn_ok(head(i)))
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    length = F.try_element_at(lengths, F.substring(value, 1, 2))
    fitting = F.filter(ends, lambda i: F.coalesce(size(head(i)) == length, size(head(i)).between(15, 34)))
    ibans = F.filter(fitting, lambda i: _iban_ok(head(i)))
    known = F.when(length.isNotNull(), F.array_max(fitting))
    none = F.when(size(value) == length, 0).otherwise(F.coalesce(known, F.array_min(ends), F.lit(0)))

    def by_kind(kind: Column) -> Column:
        iban = F.when((kind == "iban") & length.isNull(), 0).otherwise(
            F.coalesce(F.array_max(ibans), F.when(kind == "iban", 0).otherwise(none)))
        return (F.when(kind == "number", F.coalesce(F.array_max(cards), F.lit(0)))
                .when((kind.isNull() | (kind == "iban")) & value.rlike(f"^(?:{KINDS['iban']})$"), iban).otherwise(0))
    return F.when(value.rlike("[ -]") & ~value.rlike("[@+]"), _let(kind_of(value), by_kind)).otherwise(0)


def _joined(between: Column, pieces: Column) -> Column:
    return _concat(F.zip_with(between, pieces, lambda b, p: F.concat(b, F.coalesce(p, F.lit("")))))


def _matches(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))


def _marked(text: Column) -> Column:
    """The text, escaped, with a mark wherever a candidate ends inside a match. What is behind a
    mark is searched again together with the text that follows, until nothing is left to cut."""
    def step(s: Column, _: Column) -> Column:
        def cut(found: Column) -> Column:
            pieces = F.transform(found, lambda f: F.when(f["at"] > 0, F.concat(
                F.substring(f["v"], F.lit(1), f["at"]), F.lit(_MARK),
                F.substring(f["v"], f["at"] + 1, F.length(f["v"])))).otherwise(f["v"]))
            more = F.exists(found, lambda f: f["at"] > 0)
            return F.struct(F.when(more, _joined(F.split(s["text"], PATTERN, -1), pieces)).otherwise(
                s["text"]).alias("text"), more.alias("more"))
        found = F.transform(_matches(s["text"]), lambda v: F.struct(v.alias("v"), _cut(v).cast("int").alias("at")))
        return F.when(s["more"], _let(found, cut)).otherwise(s)

    # Every round but the last sets a mark at a separator that had none.
    rounds = F.sequence(F.lit(0), F.length(_only(text, " -")))
    start = F.struct(F.replace(text, F.lit(_ESCAPE), F.lit(_ESCAPED)).alias("text"), F.lit(True).alias("more"))
    return F.aggregate(rounds, start, step, lambda s: s["text"])


def pseudonym(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a validated value; null for a null kind."""
    digits = _only(value, "0-9")
    payload = permute_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key)
    card = _laid(value, _let(payload, lambda p: F.concat(p, luhn_digit(p))), "0-9")
    plain = _laid(value, permute_text(digits, key), "0-9")
    country = F.regexp_extract(value, r"^\+[0-9]{1,3}", 0)
    number = F.substring(value, F.length(country) + 1, F.length(value))
    phone = F.concat(country, _laid(number, permute_text(_only(number, "0-9"), key), "0-9"))
    packed = F.regexp_replace(value, " ", "")
    iban = _let(permute_text(F.substring(packed, F.lit(5), F.length(packed)), key), lambda b: F.concat(
        F.substring(packed, 1, 2), F.lpad((98 - _mod97(F.concat(b, F.substring(packed, 1, 2), F.lit("00")))).cast(
            "string"), 2, "0"), b))
    octets = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    address = permute_number(F.aggregate(octets, F.lit(0).cast("long"), lambda a, o: a * 256 + o),
                             (1 << 16, 1 << 16), key)
    ip = _let(address, lambda x: F.concat_ws(".", *[
        F.floor(x / (1 << s)).cast("long").bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]))
    day = F.datediff(_as_date(value), F.lit(EPOCH).cast("date")).cast("long")
    moved = F.floor(day / CYCLE) * CYCLE + permute_number(F.pmod(day, F.lit(CYCLE)), CYCLE_PARTS, key)
    new_day = F.date_add(F.lit(EPOCH).cast("date"), moved.cast("int"))
    date = F.coalesce(*[F.when(_date_format(value) == f, F.date_format(new_day, f)) for f in (
        "yyyy-MM-dd", "dd/MM/yyyy", "d/M/yyyy", "MM/dd/yyyy", "M/d/yyyy", "dd.MM.yyyy", "d.M.yyyy")])
    email = F.concat(permute_text(F.substring_index(value, "@", 1), key), F.lit("@"), F.substring_index(value, "@", -1))
    return (F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "ip", ip)
            .when(kind == "date", date).when(kind.isin("ssn", "number"), plain).when(kind == "card", card)
            .when(kind == "secret", permute_text(value, key, letters=6))
            .when(kind == "iban", _laid(value, iban, "A-Z0-9")))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", kinds: str = "pii_kinds") -> DataFrame:
    """All columns, ``text`` with pseudonyms, and ``kinds``: the kind of every value replaced, in
    the text's order. ``key`` is the secret of the permutation.

    Null stays null with no kinds; text without a valid value stays as it is. Rows are never
    dropped. A column called like ``kinds`` is replaced.
    """
    # Places instead of names, so that no column can clash with the result.
    places = [f"_{i}" for i in range(len(docs.columns))]
    whole = F.col(places[docs.columns.index(text)])

    def rebuilt(marked: Column, found: Column) -> Column:
        out = F.replace(_joined(F.split(marked, PATTERN, -1), found["out"]), F.lit(_MARK), F.lit(""))
        return F.struct(F.replace(out, F.lit(_ESCAPED), F.lit(_ESCAPE)).alias("text"),
                        F.filter(found["kind"], lambda k: k.isNotNull()).alias("kinds"))

    def judged(value: Column) -> Column:
        return _let(kind_of(value), lambda k: F.struct(
            k.alias("kind"), F.coalesce(pseudonym(value, k, key), value).alias("out")))

    none = F.array().cast("array<string>")
    # Nearly all texts stop at the first test: without digit and @ there is nothing to find.
    result = F.when(whole.rlike("[0-9@]"), _let(_marked(whole), lambda m: _let(
        F.transform(_matches(m), judged), lambda found: rebuilt(m, found)))).otherwise(
        F.struct(whole.alias("text"), none.alias("kinds")))
    done = docs.toDF(*places).withColumn("_pii", result)
    kept = [F.col("_pii.text" if c == text else p).alias(c)
            for c, p in zip(docs.columns, places, strict=True) if c != kinds]
    return done.select(*kept, F.coalesce("_pii.kinds", none).alias(kinds))
