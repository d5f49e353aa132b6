"""Pseudonyms: permutations, valid formats, and what is left alone."""

import re

import pytest
from pyspark.sql import functions as F

from wardflow.llm import pii


def replaced(spark, *texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in pii.pseudonymise(df, key).orderBy("doc_id").collect()]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban(value):
    moved = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97 == 1


def test_networks_are_permutations(spark):
    for parts in ((7, 11), (1, 5), (16, 16)):
        n = parts[0] * parts[1]
        rows = spark.range(n).select("id", pii.permute_number(F.col("id"), parts, "k").alias("p")).withColumn(
            "q", pii.permute_number(F.col("p"), parts, "k", back=True)).collect()
        assert {r.p for r in rows} == set(range(n)) and all(r.q == r.id for r in rows)
    three = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("v"))
    rows = three.select("v", pii.permute_text(F.col("v"), "k").alias("p")).withColumn(
        "q", pii.permute_text(F.col("p"), "k", back=True)).collect()
    assert len({r.p for r in rows}) == 1000 and all(r.q == r.v and re.fullmatch("[0-9]{3}", r.p) for r in rows)


def test_keys_differ(spark):
    values = [replaced(spark, "4111111111111111", key=k)[0].text for k in ("a", "b", "c")]
    assert len(set(values)) == 3


@pytest.mark.parametrize(("value", "kind", "shape"), [
    ("4111 1111 1111 1111", "card", r"\d{4} \d{4} \d{4} \d{4}"), ("4111-1111-1111-1111", "card", r"\d{4}-\d{4}-\d{4}-\d{4}"),
    ("378282246310005", "card", r"\d{15}"), ("4111111111111112", "number", r"\d{16}"),
    ("GB82 WEST 1234 5698 7654 32", "iban", r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d"), ("DE89370400440532013000", "iban", r"DE\d{20}"),
    ("078-05-1120", "ssn", r"\d{3}-\d\d-\d{4}"), ("+49 30 1234567", "phone", r"\+49 \d\d \d{7}"),
    ("+1 (017) 555-7713", "phone", r"\+1 \(\d{3}\) \d{3}-\d{4}"), ("192.168.0.255", "ip", r"\d+\.\d+\.\d+\.\d+"),
    ("2024-02-29", "date", r"\d{4}-\d\d-\d\d"), ("31/12/1999", "date", r"\d\d/\d\d/\d{4}"), ("1.2.2003", "date", r"\d+\.\d+\.\d{4}"),
    ("Jo.Doe+1@mail.example.com", "email", r"[A-Z][a-z]\.[A-Z][a-z]{2}\+\d@mail\.example\.com"),
    ("b44e15e09fd311c3cf3163b66d5a9875b883d8ce", "secret", r"[0-9a-f]{40}")])
def test_formats(spark, value, kind, shape):
    one, two, three = replaced(spark, value, f"see {value}, or ({value})!", f"x{value}" if kind != "email" else "no")
    assert one.pii_kinds == [kind] and one.text != value and re.fullmatch(shape, one.text)
    assert two.text == f"see {one.text}, or ({one.text})!" and two.pii_kinds == [kind] * 2
    if kind == "card":
        assert luhn(re.sub(r"\D", "", one.text))
    if kind == "iban":
        assert iban(one.text)
    if kind == "ip":
        assert all(0 <= int(x) <= 255 for x in one.text.split("."))
    if kind == "date":
        again = replaced(spark, one.text)[0]
        assert again.pii_kinds == ["date"]


def test_values_are_linked_over_formats(spark):
    a, b, c = (re.sub(r"\D", "", r.text) for r in replaced(
        spark, "4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111"))
    assert a == b == c
    iso, dots = (r.text for r in replaced(spark, "1985-07-04", "04.07.1985"))
    assert iso.split("-") == dots.split(".")[::-1]


@pytest.mark.parametrize("text", ["", "plain words", "version 2.0, 3.1.4 and 12345", "2024-02-30 and 31.02.2020", "300.1.1.1",
                                  "000-12-3456", "1.2.3.4.5", "a@b", "x = 0x1f", "123456789012", "GB00 WEST 1234 5698 7654 32",
                                  "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa"])
def test_what_is_not_valid_stays(spark, text):
    row = replaced(spark, text)[0]
    assert (row.text, row.pii_kinds) == (text, [])


def test_rows_and_columns(spark):
    df = spark.createDataFrame([(1, None, 5, "k"), (1, "4111111111111111" * 3, 5, "k"), (None, "a " * 50000 + "1.2.3.4", 5, "k")],
                               "doc_id long, text string, _pii int, pii_kinds string")
    found = pii.pseudonymise(df, "k")
    assert found.columns == df.columns
    rows = sorted(found.collect(), key=lambda r: len(r.text or ""))
    assert rows[0].text is None and rows[0].pii_kinds == [] and rows[0]["_pii"] == 5
    assert rows[1].text == "4111111111111111" * 3
    assert rows[2].pii_kinds == ["ip"] and rows[2].text.startswith("a " * 50000)
    assert pii.pseudonymise(df.limit(0), "k").count() == 0


CARD, IBANS = "4111 1111 1111 1111", ["ES9121000418450200051332", "BE68539007547034", "AT611904300234573201",
                                       "SE4550000000058398257466", "PL61109010140000071219812874"]


def test_candidates_end_before_what_follows_them(spark):
    lines = [(f"{CARD}{tail}", ["card", *more]) for tail, more in (
        ("", []), (" 12/25", []), (" 123", []), (" 12/12/2024", ["date"]), ("\x01 9", []), (" 12 34 5", []))]
    lines += [(f"{i}{tail}", ["iban", *more]) for i in IBANS for tail, more in (
        ("", []), (" BIC", []), (" VAT 12", []), (" 2024", []), (f" {CARD} 123", ["card"]), (" IBAN " + IBANS[0], ["iban"]))]
    lines += [("2024-05-01T10:00:00Z", ["date"]), ("2024-05-01Tag", []), (f"CC01 {CARD} 12/25", ["card"]),
              (f"{CARD} 12/25 and {CARD} 123", ["card", "card"]), ("AT611904300234573202", []),
              ("AT61 1904 3002 3457 3202", []), ("\x01\x02\x03 \x01\x03 1234567890123", ["number"])]
    df = spark.createDataFrame(list(enumerate(t for t, _ in lines)), "doc_id int, text string")
    found = {r.doc_id: r for r in pii.pseudonymise(df, "k").collect()}
    for i, (text, kinds) in enumerate(lines):
        assert (text, found[i].pii_kinds) == (text, kinds)
        assert len(found[i].text) == len(text) and (found[i].text == text) == (not kinds)
    card = found[0].text
    assert all(found[i].text.startswith(card) for i in range(6))
    assert found[1].text == card + " 12/25" and found[4].text == card + "\x01 9"
    ibans = {t: found[i].text for i, (t, _) in enumerate(lines) if t in IBANS}
    for i, (text, kinds) in enumerate(lines):
        for iban in IBANS:
            if text.startswith(iban):
                assert found[i].text.startswith(ibans[iban])
    assert found[len(lines) - 1].text.startswith("\x01\x02\x03 \x01\x03 ")
