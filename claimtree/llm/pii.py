"""Format-preserving pseudonyms for personal values, by keyed Feistel permutations.

A value is found by one pattern, validated, mapped to a number inside its format's domain and permuted
there: a Feistel network over two residues ``Z_a x Z_b`` whose rounds add keyed digests, so it is a
permutation for any ``a`` and ``b``. Strings (mail names, account numbers) run the same network over two
halves of their characters, each character shifted inside its own class. Equal values get equal pseudonyms
in every document, different values of a format different ones, and nothing needs a table or a shuffle.
All of it is built-in functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from claimtree.llm.common import free_name

ROUNDS = 8
# Steps of the walk that brings a permuted value back into its domain; each fails with odds under 0.6.
WALK = 64

# The shapes that are looked for. Possessive repeats keep every scan linear.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,10}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
DATE = (
    r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{2}\.\d{2}\.\d{4}|\d{2}-\d{2}-\d{4})"
    r"(?:(?=T\d{2}:\d{2})|(?![\w/-]|\.\d))"
)
IP = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w-])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?![\w-])"
PHONE = (
    r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)|\d{3})[ .-]?\d{3}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?(?:\(\d{1,4}\)|\d{1,4})){2,6}(?![\w-])|(?<![\w+.-])0\d(?:[ .]\d{2}){4}(?![\w-]|\.\d)"
)
KINDS = {"email": EMAIL, "iban": IBAN, "date": DATE, "ip": IP, "ssn": SSN, "card": CARD, "phone": PHONE}
# One look at the first character spares most places the whole list. Mail names can begin anywhere, so their
# pattern is only run where there is an ``@``. The card's two groups are the only ones in either pattern.
NUMBERS = rf"(?=[0-9(+])(?:{'|'.join([DATE, IP, SSN, CARD, PHONE])})|(?=[A-Z]{{2}}[0-9]{{2}}){IBAN}"
ANY = f"{NUMBERS}|{EMAIL}"


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside a lambda nothing else is shared."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _number(key: str, label: str, half: Column) -> Column:
    """A keyed number of 60 bits."""
    digest = F.sha2(F.concat(F.lit(f"{key}|{label}|"), half.cast("string")), 256)
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("bigint")


def permute(key: str, label: str, value: Column, a: Column, b: Column) -> Column:
    """The keyed permutation of ``0 <= value < a * b``, as a Feistel network over two residues."""
    # Whole division: a quotient of doubles would be off by one for numbers of 16 digits and more.
    state = F.struct(F.call_function("div", value, b.cast("bigint")).alias("l"), F.pmod(value, b).alias("r"))

    def step(s: Column, k: Column) -> Column:
        mark = F.concat(k.cast("string"), F.lit("|"))
        left = F.pmod(s.l + _number(key, label + "l", F.concat(mark, s.r.cast("string"))), a)
        right = F.pmod(s.r + _number(key, label + "r", F.concat(mark, left.cast("string"))), b)
        return F.struct(left.alias("l"), right.alias("r"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS // 2))
    return F.aggregate(rounds, state, step, lambda s: s.l * b + s.r)


def _halves(key: str, label: str, text: Column) -> Column:
    """The same network over characters: letters and digits move inside their class, the rest stays."""

    def shifted(half: Column, other: Column, k: Column, side: str) -> Column:
        seed = F.concat(F.lit(f"{key}|{label}{side}|"), k.cast("string"), F.lit("|"), other)

        def move(c: Column, i: Column) -> Column:
            digest = F.sha2(F.concat(seed, F.lit("|"), i.cast("string")), 256)
            n = F.conv(F.left(digest, F.lit(8)), 16, 10).cast("bigint")
            turn = lambda base, size: F.chr(F.lit(base) + F.pmod(F.ascii(c) - base + n, F.lit(size)))
            return (
                F.when(c.rlike("^[0-9]$"), turn(48, 10)).when(c.rlike("^[a-z]$"), turn(97, 26))
                .when(c.rlike("^[A-Z]$"), turn(65, 26)).otherwise(c)
            )

        return F.array_join(F.transform(F.split(half, ""), move), "")

    cut = F.floor(F.length(text) / 2).cast("int")
    state = F.struct(F.left(text, cut).alias("l"), F.substring(text, cut + 1, F.length(text)).alias("r"))

    def step(s: Column, k: Column) -> Column:
        left = shifted(s.l, s.r, k, "l")
        return F.struct(left.alias("l"), shifted(s.r, left, k, "r").alias("r"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS // 2))
    return F.aggregate(rounds, state, step, lambda s: F.concat(s.l, s.r))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _refill(shape: Column, kept: str, filling: Column) -> Column:
    """``shape`` with its characters of the class ``kept`` replaced, in order, by those of ``filling``."""

    def put(c: Column, i: Column) -> Column:
        rank = F.length(F.regexp_replace(F.left(shape, i + 1), f"[^{kept}]", ""))
        return F.when(c.rlike(f"^[{kept}]$"), F.substring(filling, rank, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(shape, ""), put), "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum in which the last digit is doubled."""
    places = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))

    def add(total: Column, x: Column) -> Column:
        doubled = x.d * 2
        doubled = F.when(doubled > 9, doubled - 9).otherwise(doubled)
        return total + F.when(x.i % 2 == 0, doubled).otherwise(x.d)

    return F.aggregate(places, F.lit(0), add)


def _luhn_digit(payload: Column) -> Column:
    return ((F.lit(10) - _luhn_sum(payload) % 10) % 10).cast("string")


def _body(text: Column) -> Column:
    return F.left(text, F.length(text) - 1)


def _card_ok(value: Column) -> Column:
    digits = _digits(value)
    return _luhn_digit(_body(digits)) == F.right(digits, F.lit(1))


def _digit_string(key: str, label: str, digits: Column) -> Column:
    """Keyed permutation of all digit strings of this length."""
    size = F.length(digits)
    low = F.floor(size / 2).cast("int")
    power = lambda n: F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("bigint")
    number = permute(key, label, digits.cast("bigint"), power(size - low), power(low))
    return F.lpad(number.cast("string"), size, F.lit("0"))


def _card(key: str, value: Column) -> Column:
    payload = _body(_digits(value))
    fresh = _digit_string(key, "card", payload)
    return _refill(value, "0-9", F.concat(fresh, _luhn_digit(fresh)))


def _mod97(text: Column) -> Column:
    """Remainder of an account number in which a letter stands for 10 to 35."""

    def add(total: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.when(digit, total * 10 + F.ascii(c) - 48).otherwise(total * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _plain(value: Column) -> Column:
    return F.replace(value, F.lit(" "), F.lit(""))


def _turned(plain: Column, check: Column) -> Column:
    return F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(2)), check)


def _iban_ok(value: Column) -> Column:
    plain = _plain(value)
    return _mod97(_turned(plain, F.substring(plain, 3, 2))) == 1


def _iban(key: str, value: Column) -> Column:
    plain = _plain(value)
    account = _halves(key, "iban", F.substring(plain, F.lit(5), F.length(plain)))
    fresh = F.concat(F.left(plain, F.lit(2)), F.lit("00"), account)
    check = F.lpad((F.lit(98) - _mod97(_turned(fresh, F.lit("00")))).cast("string"), 2, "0")
    return _refill(value, "A-Z0-9", F.concat(F.left(plain, F.lit(2)), check, account))


def _ip_ok(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda o: o.cast("int") <= 255)


def _ip(key: str, value: Column) -> Column:
    number = F.aggregate(F.split(value, r"\."), F.lit(0).cast("bigint"), lambda n, o: n * 256 + o.cast("bigint"))
    fresh = permute(key, "ip", number, F.lit(65536), F.lit(65536))
    octet = lambda k: F.pmod(F.shiftright(fresh, 8 * k), F.lit(256)).cast("string")
    return F.concat_ws(".", octet(3), octet(2), octet(1), octet(0))


def _ssn_ok(value: Column) -> Column:
    return value.rlike(r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$")


def _ssn(key: str, value: Column) -> Column:
    area = F.substring(value, 1, 3).cast("bigint")
    area = F.when(area > 666, area - 2).otherwise(area - 1)
    group, serial = F.substring(value, 5, 2).cast("bigint") - 1, F.substring(value, 8, 4).cast("bigint") - 1
    fresh = permute(key, "ssn", (area * 99 + group) * 9999 + serial, F.lit(898 * 99), F.lit(9999))
    first = F.floor(fresh / (99 * 9999)).cast("bigint")
    first = F.when(first >= 665, first + 2).otherwise(first + 1)
    pad = lambda n, size: F.lpad(n.cast("string"), size, "0")
    return F.concat_ws(
        "-", pad(first, 3), pad(F.pmod(F.floor(fresh / 9999).cast("bigint"), F.lit(99)) + 1, 2),
        pad(F.pmod(fresh, F.lit(9999)) + 1, 4),
    )


# Date formats: month before day for slashes where that is a date, day before month where only that is.
DATE_FORMATS = [
    (r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{4}/", "yyyy/MM/dd"), (r"\.", "dd.MM.yyyy"),
    (r"^(0\d|1[0-2])/", "MM/dd/yyyy"), (r"/", "dd/MM/yyyy"), (r"^(0\d|1[0-2])-", "MM-dd-yyyy"), (r"-", "dd-MM-yyyy"),
]


def _by_format(value: Column, make) -> Column:
    first, *rest = DATE_FORMATS
    case = F.when(value.rlike(first[0]), make(first[1]))
    for pattern, form in rest:
        case = case.when(value.rlike(pattern), make(form))
    return case


def _unpadded(value: Column) -> Column:
    """Whether a day or month with slashes is one digit."""
    return value.rlike(r"^\d/|^\d{2}/\d/")


def _padded(value: Column) -> Column:
    parts = F.transform(F.split(value, "/"), lambda p: F.when(F.length(p) < 2, F.lpad(p, 2, "0")).otherwise(p))
    return F.when(_unpadded(value), F.array_join(parts, "/")).otherwise(value)


def _day(value: Column) -> Column:
    """The date that the value names, or NULL."""

    def parts(v: Column, form: str) -> Column:
        return F.concat_ws("-", *[F.substring(v, form.index(unit) + 1, len(unit)) for unit in ("yyyy", "MM", "dd")])

    return _bind(_padded(value), lambda v: F.try_to_date(_by_format(v, lambda form: parts(v, form)), "yyyy-MM-dd"))


def _date(key: str, value: Column) -> Column:
    """Permutes the days of the century that starts in a year ending in 50, inside the written format.

    Where only the day-first reading is a date, values walk on until the result also has a day over 12, and
    where a day or month is one digit, until the result has one too, so that a pseudonym is read the same way
    as its source and is not one of a date written otherwise.
    """
    year = lambda day: (F.floor((F.year(day) - 50) / 100) * 100 + 50).cast("int")
    start = lambda day: F.make_date(year(day), F.lit(1), F.lit(1))
    days = lambda day: F.datediff(F.make_date(year(day) + 100, F.lit(1), F.lit(1)), start(day))
    seen = _bind(_day(value), lambda day: F.struct(
        start(day).alias("start"), F.datediff(day, start(day)).cast("bigint").alias("n"),
        F.when(days(day) == 36525, 75).otherwise(92).cast("bigint").alias("a"),
        F.when(days(day) == 36525, 487).otherwise(397).cast("bigint").alias("b"),
        _unpadded(value).alias("short"), _padded(value).rlike(r"^(1[3-9]|[23]\d)[/-]").alias("day_first"),
    ))

    def walked(x: Column) -> Column:
        once = lambda n: permute(key, "date", n, x.a, x.b)
        at = lambda n: F.date_add(x.start, n.cast("int"))

        def wrong(n: Column) -> Column:
            padded = (F.month(at(n)) >= 10) & (F.dayofmonth(at(n)) >= 10)
            return (x.day_first & (F.dayofmonth(at(n)) <= 12)) | (x.short & padded)

        walk = lambda n, _: F.when(wrong(n), once(n)).otherwise(n)
        return at(F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), once(x.n), walk))

    made = _bind(_bind(seen, walked), lambda fresh: _by_format(_padded(value), lambda form: F.date_format(fresh, form)))
    return F.when(_unpadded(value), F.regexp_replace(made, r"(^|/)0(?=\d/)", "$1")).otherwise(made)


def _email(key: str, value: Column) -> Column:
    """All but the last label of the domain; case and the places of dots and signs stay."""
    top = F.substring_index(value, ".", -1)
    return F.concat(_halves(key, "email", F.left(value, F.length(value) - F.length(top) - 1)), F.lit("."), top)


def _phone(key: str, value: Column) -> Column:
    """The digits after the country code, or after the zero of a national number in pairs."""
    code = F.regexp_extract(value, r"^(\+\d{1,3}(?=\D)|0(?=\d[ .]\d{2}[ .]))", 1)
    rest = F.substring(value, F.length(code) + 1, F.length(value))
    return F.concat(code, _refill(rest, "0-9", _digit_string(key, "phone", _digits(rest))))


def _anchored(kind: str) -> str:
    return rf"^(?:{KINDS[kind]})$"


def kind_of(value: Column) -> Column:
    """The kind of a matched value, or NULL if it does not pass its check."""
    digits = F.length(_digits(value))
    return (
        F.when(value.contains("@"), F.lit("email"))
        .when(value.rlike(_anchored("iban")), F.when(_iban_ok(value), F.lit("iban")))
        .when(value.rlike(_anchored("date")), F.when(F.year(_day(value)) >= 1550, F.lit("date")))
        .when(value.rlike(_anchored("ip")), F.when(_ip_ok(value), F.lit("ip")))
        .when(value.rlike(_anchored("ssn")), F.when(_ssn_ok(value), F.lit("ssn")))
        .when(value.rlike(_anchored("card")), F.when(_card_ok(value), F.lit("card")))
        .otherwise(F.when((digits >= 8) & (digits <= 16), F.lit("phone")))
    )


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one value; a value that does not pass the check of its kind stays as it is."""
    makers = {"email": _email, "iban": _iban, "date": _date, "ip": _ip, "card": _card, "phone": _phone}
    makers["ssn"] = _ssn
    fresh = _bind(kind_of(value), lambda kind: reduce(lambda case, k: case.when(kind == k, makers[k](key, value)), makers, F))
    return F.coalesce(fresh, value)


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str = "n_values") -> DataFrame:
    """All rows with the personal values of ``text`` replaced and their number as ``count``.

    Mail addresses, IBANs (mod 97), dates, IPv4 addresses, social security numbers, card numbers (Luhn) and
    phone numbers are replaced if they pass the check of their kind; pseudonyms pass it too. Dates before
    1550 stay. A NULL text stays NULL with count 0; an empty one stays empty. Repeated rows are all
    returned, alike. Other columns pass through; one named like ``count`` is replaced. Any length of text
    is scanned whole, in linear time, row by row: nothing is shuffled.
    """
    body = F.col(text)
    # Every kind but mail holds a digit, and mail an @: two cheap scans spare most texts the patterns.
    case = lambda make: F.when(body.contains("@"), make(ANY)).when(body.rlike("[0-9]"), make(NUMBERS))
    found = case(lambda pattern: F.regexp_extract_all(body, F.lit(pattern), F.lit(0)))
    seen, fresh = free_name(docs, "__found"), free_name(docs, "__fresh")
    docs = docs.withColumn(seen, found)
    docs = docs.withColumn(fresh, F.transform(seen, lambda v: pseudonym(v, key)))
    between = case(lambda pattern: F.split(body, pattern, -1))
    woven = F.zip_with(between, fresh, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    changed = F.filter(F.zip_with(seen, fresh, lambda a, b: a != b), lambda x: x)
    none = F.coalesce(F.size(seen), F.lit(0)) <= 0
    return docs.withColumns({
        text: F.when(none, body).otherwise(F.array_join(woven, "")),
        count: F.when(none, 0).otherwise(F.size(changed)),
    }).drop(seen, fresh)
