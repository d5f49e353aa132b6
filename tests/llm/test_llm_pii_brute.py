"""The pseudonym query against a plain version of the search, the checks and the Feistel networks."""

import datetime as dt
import hashlib
import re

from wardflow.llm import pii
from wardflow.llm.queries import PII_KEY, QUERIES

FOLDER = "/root/testdata/sf0.001"
EPOCH = dt.date(1800, 1, 1)


def digest(round_, value):
    return hashlib.sha256(f"{PII_KEY}|{round_}|{value}".encode()).hexdigest()


def feistel_text(value, letters=26):
    a, b = value[:len(value) // 2], value[len(value) // 2:]
    for r in range(1, 9):
        h, moved = digest(r, b), ""
        for i, c in enumerate(a):
            by = int(h[i % 32 * 2:i % 32 * 2 + 2], 16)
            for first, n in (("0", 10), ("a", letters), ("A", letters)):
                if 0 <= ord(c) - ord(first) < n:
                    c = chr(ord(first) + (ord(c) - ord(first) + by) % n)
                    break
            moved += c
        a, b = b, moved
    return a + b


def feistel_number(value, m, n):
    a, b = divmod(value, n)
    for r in range(1, 9):
        if r % 2:
            a = (a + int(digest(r, b)[:12], 16)) % m
        else:
            b = (b + int(digest(r, a)[:12], 16)) % n
    return a * n + b


def luhn_sum(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total


def with_luhn(payload):
    return payload + next(d for d in "0123456789" if luhn_sum(payload + d) % 10 == 0)


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban_ok(value):
    packed = value.replace(" ", "")
    return mod97(packed[4:] + packed[:4]) == 1


def only(value, kept="0-9"):
    return re.sub(f"[^{kept}]", "", value)


def date_of(value):
    """(date, how it is written) or None."""
    a, b, c = map(int, re.split("[-./]", value))
    year, month, day = (a, b, c) if "-" in value else (c, b, a)
    swapped = "/" in value and b > 12
    if swapped:
        month, day = day, month
    try:
        found = dt.date(year, month, day)
    except ValueError:
        return None
    two = re.match(r"[0-9]{2}[./][0-9]{2}[./]", value)

    def written(d):
        if "-" in value:
            return f"{d.year:04d}-{d.month:02d}-{d.day:02d}"
        parts = [d.month, d.day] if swapped else [d.day, d.month]
        mark = "." if "." in value else "/"
        return mark.join([*(f"{p:02d}" if two else str(p) for p in parts), f"{d.year:04d}"])
    return found, written


def kind_of(value):
    full = lambda kind: re.fullmatch(pii.KINDS[kind], value)
    if "@" in value:
        return "email"
    if value.startswith("+"):
        return "phone"
    if full("ip"):
        return "ip"
    if full("date"):
        return "date" if date_of(value) else None
    if full("ssn"):
        area, group, serial = value.split("-")
        return None if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000" else "ssn"
    if full("card"):
        return "card" if luhn_sum(only(value)) % 10 == 0 else "number"
    if full("secret"):
        return "secret" if re.search("[0-9]", value) and re.search("[a-fA-F]", value) else None
    return "iban" if full("iban") and iban_ok(value) else None


def cut(value):
    """Where a candidate ends inside a match, 0 if it is the whole match."""
    if not re.search("[ -]", value) or re.search("[@+]", value):
        return 0
    kind, ends = kind_of(value), [i for i in range(1, len(value)) if value[i] in " -"]
    if kind == "number":
        return max((i for i in ends if 13 <= len(only(value[:i])) <= 19 and luhn_sum(only(value[:i])) % 10 == 0), default=0)
    if kind not in (None, "iban") or not re.fullmatch(pii.KINDS["iban"], value):
        return 0
    size = lambda text: len(text.replace(" ", ""))
    length = pii.IBAN_LENGTHS.get(value[:2])
    if kind == "iban" and length is None:
        return 0
    fitting = [i for i in ends if (size(value[:i]) == length if length else 15 <= size(value[:i]) <= 34)]
    valid = [i for i in fitting if iban_ok(value[:i])]
    if valid:
        return max(valid)
    if kind == "iban" or size(value) == length:
        return 0
    return max(fitting) if length and fitting else min(ends, default=0)


def laid(value, pseudonym, places="0-9"):
    letters = iter(pseudonym)
    return "".join(next(letters) if re.match(f"[{places}]", c) else c for c in value)


def replaced(value):
    kind = kind_of(value)
    if kind == "email":
        name, _, host = value.rpartition("@")
        return feistel_text(name) + "@" + host
    if kind == "phone":
        country = re.match(r"\+[0-9]{1,3}", value)[0]
        rest = value[len(country):]
        return country + laid(rest, feistel_text(only(rest)))
    if kind == "ip":
        a, b, c, d = map(int, value.split("."))
        n = feistel_number(((a * 256 + b) * 256 + c) * 256 + d, 1 << 16, 1 << 16)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "date":
        found, written = date_of(value)
        cycle, day = divmod((found - EPOCH).days, 146_097)
        return written(EPOCH + dt.timedelta(cycle * 146_097 + feistel_number(day, 189, 773)))
    if kind in ("ssn", "number"):
        return laid(value, feistel_text(only(value)))
    if kind == "card":
        return laid(value, with_luhn(feistel_text(only(value)[:-1])))
    if kind == "secret":
        return feistel_text(value, 6)
    if kind == "iban":
        packed = value.replace(" ", "")
        body = feistel_text(packed[4:])
        return laid(value, f"{packed[:2]}{98 - mod97(body + packed[:2] + '00'):02d}{body}", "A-Z0-9")
    return value


def plain(text):
    if not re.search("[0-9@]", text):
        return text
    mark = "\x01\x03"
    while True:
        done = re.sub(pii.PATTERN, lambda m: m[0][:at] + mark + m[0][at:] if (at := cut(m[0])) else m[0], text)
        if done == text:
            return re.sub(pii.PATTERN, lambda m: replaced(m[0]), text).replace(mark, "")
        text = done


CASES = ["ES9121000418450200051332 BIC", "BE68539007547034 VAT", "4111 1111 1111 1111 12/25", "4111 1111 1111 1111 123",
         "2024-05-01T10:00", "31/12/1999 and 12/31/1999", "1.2.2003", "call +49 (30) 1234-5678 now", "10.0.0.255",
         "123-45-6789 000-12-3456", "a.b@c.example.org", "0123456789abcdef0123456789abcdef", "no 30/02/2001",
         "GB82 WEST 1234 5698 7654 32", "1234567890123456"]


def test_hand_made_cases(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id int, text string")
    found = {r.doc_id: r.text for r in pii.pseudonymise(df, PII_KEY).collect()}
    assert found == {i: plain(t) for i, t in enumerate(CASES)}
    assert sum(found[i] != t for i, t in enumerate(CASES)) >= 13


def test_query_equals_the_plain_version(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r.doc_id: r.text for r in QUERIES["op3_feistel"](spark, FOLDER).collect()}
    assert found == {d: None if t is None else plain(t) for d, t in texts.items()}
