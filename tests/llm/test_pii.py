"""Pseudonyms against a plain version in Python, permutations at the ends of their domains, and the shapes found."""

import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from claimtree.llm import pii
from claimtree.llm.queries import PII_KEY, QUERIES

FOLDER = "/root/testdata/sf0.001"
KEY = PII_KEY


# --- a plain version


def number(label, half):
    return int(hashlib.sha256(f"{KEY}|{label}|{half}".encode()).hexdigest()[:15], 16)


def permute(label, value, a, b):
    left, right = divmod(value, b)
    for k in range(1, pii.ROUNDS // 2 + 1):
        left = (left + number(label + "l", f"{k}|{right}")) % a
        right = (right + number(label + "r", f"{k}|{left}")) % b
    return left * b + right


def digit_string(label, digits):
    low = len(digits) // 2
    return str(permute(label, int(digits), 10 ** (len(digits) - low), 10**low)).zfill(len(digits))


def moved(half, other, k, label):
    out = []
    for i, c in enumerate(half):
        n = int(hashlib.sha256(f"{KEY}|{label}|{k}|{other}|{i}".encode()).hexdigest()[:8], 16)
        base, size = (48, 10) if re.match("[0-9]", c) else (97, 26) if re.match("[a-z]", c) else (65, 26) if re.match("[A-Z]", c) else (0, 0)
        out.append(chr(base + (ord(c) - base + n) % size) if size else c)
    return "".join(out)


def halves(label, text):
    left, right = text[: len(text) // 2], text[len(text) // 2 :]
    for k in range(1, pii.ROUNDS // 2 + 1):
        left = moved(left, right, k, label + "l")
        right = moved(right, left, k, label + "r")
    return left + right


def luhn(payload):
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def refill(shape, kept, filling):
    rest = iter(filling)
    return "".join(next(rest) if re.match(f"[{kept}]", c) else c for c in shape)


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def read_date(value):
    """(date, form, whether day first or one-digit must stay so)."""
    parts = re.split(r"[-/.]", value)
    short = "/" in value and any(len(p) == 1 for p in parts)
    p = [x.zfill(2) for x in parts]
    if len(p[0]) == 4:
        order = ("y", "m", "d")
    elif "." in value:
        order = ("d", "m", "y")
    else:
        order = ("m", "d", "y") if p[0] <= "12" else ("d", "m", "y")
    at = dict(zip(order, map(int, p), strict=True))
    try:
        day = datetime.date(at["y"], at["m"], at["d"])
    except ValueError:
        return None
    return (day, order, short) if day.year >= 1550 else None


def plain_date(value):
    day, order, short = read_date(value)
    century = (day.year - 50) // 100 * 100 + 50
    start = datetime.date(century, 1, 1)
    days = (datetime.date(century + 100, 1, 1) - start).days
    a, b = (75, 487) if days == 36525 else (92, 397)
    first = order == ("d", "m", "y") and "." not in value
    n = permute("date", (day - start).days, a, b)
    while True:
        made = start + datetime.timedelta(n)
        if not ((first and made.day <= 12) or (short and made.month >= 10 and made.day >= 10)):
            break
        n = permute("date", n, a, b)
    width = lambda x: str(x) if short else f"{x:02d}"
    shown = {"y": f"{made.year:04d}", "m": width(made.month), "d": width(made.day)}
    return re.search(r"[-/.]", value)[0].join(shown[o] for o in order)


def plain_pseudonym(value):
    is_kind = lambda kind: re.fullmatch(pii.KINDS[kind], value, re.ASCII)
    digits = re.sub("[^0-9]", "", value)
    if "@" in value:
        head, _, top = value.rpartition(".")
        return f"{halves('email', head)}.{top}"
    if is_kind("iban"):
        plain = value.replace(" ", "")
        if mod97(plain[4:] + plain[:4]) != 1:
            return value
        account = halves("iban", plain[4:])
        check = f"{98 - mod97(account + plain[:2] + '00'):02d}"
        return refill(value, "A-Z0-9", plain[:2] + check + account)
    if is_kind("date"):
        return plain_date(value) if read_date(value) else value
    if is_kind("ip"):
        octets = list(map(int, value.split(".")))
        if max(octets) > 255:
            return value
        fresh = permute("ip", int.from_bytes(bytes(octets)), 65536, 65536)
        return ".".join(map(str, fresh.to_bytes(4)))
    if is_kind("ssn"):
        area, group, serial = map(int, value.split("-"))
        if area in (0, 666) or area >= 900 or group == 0 or serial == 0:
            return value
        fresh = permute("ssn", ((area - 2 if area > 666 else area - 1) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999)
        first = fresh // (99 * 9999)
        return f"{first + 2 if first >= 665 else first + 1:03d}-{fresh // 9999 % 99 + 1:02d}-{fresh % 9999 + 1:04d}"
    if is_kind("card"):
        if luhn(digits[:-1]) != digits[-1]:
            return value
        fresh = digit_string("card", digits[:-1])
        return refill(value, "0-9", fresh + luhn(fresh))
    if not 8 <= len(digits) <= 16:
        return value
    code = re.match(r"\+\d{1,3}(?=\D)|0(?=\d[ .]\d{2}[ .])|", value)[0]
    rest = value[len(code) :]
    return code + refill(rest, "0-9", digit_string("phone", re.sub("[^0-9]", "", rest)))


def plain_text(text):
    changed = 0

    def put(match):
        nonlocal changed
        fresh = plain_pseudonym(match[0])
        changed += fresh != match[0]
        return fresh

    return (re.sub(pii.ANY if "@" in text else pii.NUMBERS, put, text, flags=re.ASCII), changed) if text else (text, 0)


def test_every_document(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r.doc_id: (r.text, r.n_values) for r in QUERIES["op3_pii"][0](spark, FOLDER).collect()}
    assert found == {k: plain_text(t) for k, t in docs.items()}
    assert sum(n for _, n in found.values()) > 0


FORMS = [
    "+33 1 23 45 67 89", "01 23 45 67 89", "01.23.45.67.89", "3/5/2020", "25/3/2020", "12/25/2020", "2020-01-05T10:00:00Z", "+49 (30) 123456",
    "+1 (555) 123-4567", "(555) 123-4567", "555-123-4567", "+442071234567", "+44 20 7123 4567", "2020-01-05", "05.01.2020", "31/12/1999",
    "4111 1111 1111 1111", "378282246310005", "GB82 WEST 1234 5698 7654 32", "192.168.0.1", "123-45-6789", "a.b@example.org", "1/1/2049", "9/9/1551",
]


def test_forms(spark):
    """Each shape is found, alone and in a sentence, and replaced as the plain version does; its look stays."""
    rows = [(k, t) for k, v in enumerate(FORMS) for t in (v, f"See {v}, then.", f"({v})")]
    found = pii.pseudonymise(spark.createDataFrame(rows, "k int, text string"), KEY).collect()
    look = lambda t: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub(r"\d+", "0", t)))
    for (_, before), row in zip(rows, sorted(found, key=lambda r: (r.k,)), strict=True):
        assert (row.text, row.n_values) == plain_text(before) and row.n_values == 1 and look(row.text) == look(before), before


def test_shapes_that_are_left(spark):
    """Named in the README: no check tells these from other numbers and names."""
    rows = [("5551234567",), ("2001:db8::1",), ("5 March 2020",), ("1/2",), ("13/13/2020",), ("0.1 23 45 67 89",), ("12/31/1000",)]
    found = pii.pseudonymise(spark.createDataFrame(rows, "text string"), KEY).collect()
    assert [(r.text, r.n_values) for r in found] == [(t, 0) for (t,) in rows]


@pytest.mark.parametrize("size", range(12, 19))
def test_cards_of_any_length_stay_apart(spark, size):
    """Payloads at both ends of the domain and in the middle: as many pseudonyms, as the plain version has them."""
    top = 10**size
    values = sorted({*range(60), *range(top - 60, top), *range(top // 2 - 30, top // 2 + 30), *(10**k for k in range(size)), *(10**k - 1 for k in range(1, size + 1))})
    cards = [f"{v:0{size}d}" + luhn(f"{v:0{size}d}") for v in values]
    rows = spark.createDataFrame([(c,) for c in cards], "card string").select(F.col("card"), pii._card(KEY, F.col("card")).alias("fresh")).collect()
    assert len({r.fresh for r in rows}) == len(cards)
    assert all(r.fresh[-1] == luhn(r.fresh[:-1]) and r.fresh[:-1] == digit_string("card", r.card[:-1]) for r in rows)


def test_dates_of_a_format_stay_apart(spark):
    days = [datetime.date(1950, 1, 1) + datetime.timedelta(n) for n in range(0, 36525, 7)]
    forms = {
        "short": [f"{d.month}/{d.day}/{d.year}" for d in days if d.month < 10 or d.day < 10],
        "long": [f"{d.month:02d}/{d.day:02d}/{d.year}" for d in days if d.month >= 10 and d.day >= 10],
    }
    for values in forms.values():
        rows = spark.createDataFrame([(v,) for v in values], "d string").select("d", pii.pseudonym(F.col("d"), KEY).alias("fresh")).collect()
        assert len({r.fresh for r in rows}) == len(values) and all(r.fresh == plain_date(r.d) for r in rows)
