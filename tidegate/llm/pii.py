"""Format-preserving pseudonyms: validated numbers and dates permuted by a keyed Feistel network."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# Patterns of what may be private, by kind; a match belongs to the first kind that
# it fits as a whole.
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_SECRET = r"(?i:\b(?:password|passwd|secret|token|api_?key)\s*[=:]\s*[\"']?)[A-Za-z0-9+/_-]{8,}"
_IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
_HEX = r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])"
_CARD = r"(?<![0-9A-Za-z.+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])(?![.-][0-9])"
_PHONE = r"(?<![0-9A-Za-z.-])(?:\+?1[^0-9A-Za-z\n]{0,5})?(?:\([0-9]{3}\)[^0-9A-Za-z\n]{0,5}|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
_ABROAD = r"(?<![0-9A-Za-z])\+[2-9][0-9](?:[ .-]?[0-9]){6,12}(?![0-9A-Za-z])"
_SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
_ADDRESS = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
_DATE = r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z])(?![./-][0-9])"

_ALL = "|".join((_EMAIL, _SECRET, _HEX, _IBAN, _CARD, _SSN, _PHONE, _ABROAD, _ADDRESS, _DATE))
KINDS = ("email", "secret", "card", "ssn", "phone", "ip", "date")
#: Account numbers came later: their count follows the others.
_COUNTED = (*KINDS, "iban")

#: Days of the Gregorian calendar's cycle of 400 years, and the first one of the permuted range.
_CYCLE = (189, 773)
_FIRST_DAY = "1800-01-01"


def derive_key(secret: str) -> str:
    """Key of the permutations. It is a literal of the plan: keep plans and event logs private."""
    return hashlib.sha256(f"pseudonyms:{secret}".encode()).hexdigest()


def _round(key: str, kind: str | Column, i: Column, half: Column) -> Column:
    """Round function: 60 bits of a digest of key, kind, round and the other half."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    text = F.concat_ws("|", F.lit(key), kind, i.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def _feistel(key: str, kind: str | Column, left: Column, right: Column, a: Column, b: Column) -> Column:
    """Permutation of ``[0, a) x [0, b)``: the halves are shifted in turn by a keyed hash of the other.

    Every round can be undone, whatever ``a`` and ``b``, so different values stay different.
    """
    start = F.struct(left.cast("bigint").alias("left"), right.cast("bigint").alias("right"))

    def step(state: Column, i: Column) -> Column:
        left, right = state["left"], state["right"]
        even = i % 2 == 0
        moved = F.pmod(left + _round(key, kind, i, right), a)
        other = F.pmod(right + _round(key, kind, i, left), b)
        return F.struct(
            F.when(even, moved).otherwise(left).alias("left"),
            F.when(even, right).otherwise(other).alias("right"),
        )

    return F.aggregate(F.array(*(F.lit(i) for i in range(ROUNDS))), start, step)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _number(digits: Column, start: Column | int, size: Column | int) -> Column:
    start = F.lit(start) if isinstance(start, int) else start
    size = F.lit(size) if isinstance(size, int) else size
    return F.substr(digits, start, size).try_cast("bigint")


def _zeros(number: Column, size: Column | int) -> Column:
    size = F.lit(size) if isinstance(size, int) else size
    return F.lpad(number.cast("string"), size, F.lit("0"))


def _fill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order, by those of ``digits``."""
    place = lambda i: F.length(_digits(F.substr(form, F.lit(1), i + 1)))
    chars = F.split(form, "")
    return F.array_join(
        F.transform(
            chars, lambda c, i: F.when(c.rlike("^[0-9]$"), F.substr(digits, place(i), F.lit(1))).otherwise(c)
        ),
        "",
    )


def _luhn(digits: Column) -> Column:
    """Luhn sum of a number's digits, the last one counted once."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: c.try_cast("int"))
    weighed = F.transform(
        values, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, F.lit(9)).otherwise(F.lit(0)))
    )
    return F.aggregate(weighed, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0)))


def _power(exponent: Column) -> Column:
    return F.element_at(F.array(*(F.lit(10**i).cast("bigint") for i in range(16))), exponent + 1)


def _card(key: str, match: Column) -> Column:
    """All digits but the check digit are permuted, the check digit is computed anew."""
    digits = _digits(match)
    size = (F.length(digits) - 1).cast("int")
    low = F.floor(size / 2).cast("int")
    high = size - low
    state = _feistel(
        key,
        "card",
        _number(digits, 1, high),
        _number(digits, high + 1, low),
        _power(high),
        _power(low),
    )
    # A generator-free way to name a value: a one-element array that is transformed.
    body = F.transform(F.array(state), lambda s: F.concat(_zeros(s["left"], high), _zeros(s["right"], low)))
    whole = F.transform(
        body,
        lambda d: F.concat(d, F.pmod(10 - F.pmod(_luhn(F.concat(d, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")),
    )
    return F.element_at(F.transform(whole, lambda d: _fill(match, d)), 1)


def _phone(key: str, match: Column) -> Column:
    """Ten-digit numbers keep a leading 1 and stay valid: area and exchange start with 2 to 9."""
    digits = _digits(match)
    lead = F.substr(digits, F.lit(1), (F.length(digits) - 10).cast("int"))
    ten = F.right(digits, F.lit(10))
    area, exchange, line = _number(ten, 1, 3), _number(ten, 4, 3), _number(ten, 7, 4)
    state = _feistel(
        key, "phone", area - 200, (exchange - 200) * 10000 + line, F.lit(800), F.lit(8_000_000)
    )
    new = F.transform(
        F.array(state),
        lambda s: F.concat(
            lead,
            (s["left"] + 200).cast("string"),
            (F.floor(s["right"] / 10000) + 200).cast("string"),
            _zeros(F.pmod(s["right"], F.lit(10000)), 4),
        ),
    )
    valid = (area >= 200) & (exchange >= 200)
    return F.when(valid, F.element_at(F.transform(new, lambda d: _fill(match, d)), 1))


def _abroad(key: str, match: Column) -> Column:
    """Numbers with another country code keep its two digits."""
    digits = _digits(match)
    size = (F.length(digits) - 2).cast("int")
    low = F.floor(size / 2).cast("int")
    high = size - low
    state = _feistel(
        key,
        "abroad",
        _number(digits, 3, high),
        _number(digits, high + 3, low),
        _power(high),
        _power(low),
    )
    new = F.transform(
        F.array(state),
        lambda s: F.concat(F.substr(digits, F.lit(1), F.lit(2)), _zeros(s["left"], high), _zeros(s["right"], low)),
    )
    return F.element_at(F.transform(new, lambda d: _fill(match, d)), 1)


def _ssn(key: str, match: Column) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""
    digits = _digits(match)
    area, group, serial = _number(digits, 1, 3), _number(digits, 4, 2), _number(digits, 6, 4)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    state = _feistel(key, "ssn", place * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))
    area_of = lambda s: F.floor(s["left"] / 99) + F.when(s["left"] >= 665 * 99, F.lit(2)).otherwise(F.lit(1))
    new = F.transform(
        F.array(state),
        lambda s: F.concat(
            _zeros(area_of(s), 3),
            _zeros(F.pmod(s["left"], F.lit(99)) + 1, 2),
            _zeros(s["right"] + 1, 4),
        ),
    )
    return F.when(valid, F.element_at(F.transform(new, lambda d: _fill(match, d)), 1))


def _ip(key: str, match: Column) -> Column:
    """The four parts of an address, each 0 to 255 without leading zeros."""
    parts = F.transform(F.split(match, r"\."), lambda p: p.try_cast("bigint"))
    valid = F.forall(parts, lambda p: p.between(0, 255)) & ~match.rlike(r"(^|\.)0[0-9]")
    state = _feistel(
        key, "ip", parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], F.lit(65536), F.lit(65536)
    )
    new = F.transform(
        F.array(state),
        lambda s: F.concat_ws(
            ".",
            *(
                part.cast("string")
                for half in ("left", "right")
                for part in (F.floor(s[half] / 256), F.pmod(s[half], F.lit(256)))
            ),
        ),
    )
    return F.when(valid, F.element_at(new, 1))


def _date(key: str, match: Column) -> Column:
    """Real calendar dates of the years 1800 to 2199, as a permutation of those days."""
    form = (
        F.when(match.contains("-"), F.lit("yyyy-MM-dd"))
        .when(match.contains("."), F.lit("dd.MM.yyyy"))
        .otherwise(F.lit("MM/dd/yyyy"))
    )
    iso = (
        F.when(match.contains("-"), match)
        .when(match.contains("."), F.regexp_replace(match, r"^(..)\.(..)\.(....)$", "$3-$2-$1"))
        .otherwise(F.regexp_replace(match, "^(..)/(..)/(....)$", "$3-$1-$2"))
    )
    day = F.datediff(iso.try_cast("date"), F.lit(_FIRST_DAY).cast("date"))
    a, b = _CYCLE
    state = _feistel(key, "date", F.floor(day / b), F.pmod(day, F.lit(b)), F.lit(a), F.lit(b))
    new = F.transform(
        F.array(state),
        lambda s: F.date_format(
            F.date_add(F.lit(_FIRST_DAY).cast("date"), (s["left"] * b + s["right"]).cast("int")), "yyyy-MM-dd"
        ),
    )
    year, month, dom = (lambda d: F.substr(d, F.lit(1), F.lit(4))), (lambda d: F.substr(d, F.lit(6), F.lit(2))), (lambda d: F.substr(d, F.lit(9), F.lit(2)))
    shaped = F.transform(
        new,
        lambda d: F.when(form == "yyyy-MM-dd", d)
        .when(form == "dd.MM.yyyy", F.concat_ws(".", dom(d), month(d), year(d)))
        .otherwise(F.concat_ws("/", month(d), dom(d), year(d))),
    )
    return F.when(day.between(0, a * b - 1), F.element_at(shaped, 1))


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a text read as a number, A to Z as 10 to 35."""
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda s, c: F.pmod(s * F.when(c.rlike("^[0-9]$"), 10).otherwise(100) + value(c), F.lit(97))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _check(country: Column, account: Column) -> Column:
    """The two check digits of an account number."""
    return _zeros(98 - _mod97(F.concat(account, country, F.lit("00"))), 2)


def _iban(key: str, match: Column) -> Column:
    """Country, letters and spaces stay, the account's digits are permuted, the check digits computed anew."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    country, account = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
    digits = _digits(account)
    low = F.floor(F.length(digits) / 2).cast("int")
    high = (F.length(digits) - low).cast("int")
    # The halves of one shape of account only are permuted among each other.
    shape = F.concat(F.lit("iban|"), country, F.regexp_replace(account, "[0-9]", "0"))
    state = _feistel(key, shape, _number(digits, 1, high), _number(digits, high + 1, low), _power(high), _power(low))
    moved = F.transform(
        F.array(state), lambda s: F.concat(_zeros(s["left"], high), _zeros(s["right"], low))
    )
    made = F.transform(moved, lambda d: _fill(account, d))
    whole = F.transform(made, lambda a: _fill(match, _digits(F.concat(_check(country, a), a))))
    valid = (F.substr(plain, F.lit(3), F.lit(2)) == _check(country, account)) & (low > 0) & (high <= 15)
    return F.when(valid, F.element_at(whole, 1))


def _email(key: str, match: Column) -> Column:
    """A keyed name of 48 bits in a reserved domain; letter case does not matter."""
    name = F.substring(F.sha2(F.concat(F.lit(f"{key}|email|"), F.lower(match)), 256), 1, 12)
    return F.concat(F.lit("u"), name, F.lit("@example.invalid"))


def _secret(key: str, match: Column) -> Column:
    """What stands before the value stays; the value becomes a keyed one of its length, 64 at most."""
    value = F.regexp_extract(match, "[A-Za-z0-9+/_-]+$", 0)
    head = F.substr(match, F.lit(1), (F.length(match) - F.length(value)).cast("int"))
    new = F.sha2(F.concat(F.lit(f"{key}|secret|"), value), 256)
    return F.concat(head, F.substr(new, F.lit(1), F.least(F.length(value), F.lit(64)).cast("int")))


def _pseudonym(key: str) -> Callable[[Column], Column]:
    """``struct<kind, text>`` of a match; the kind is null and the text unchanged if not valid."""

    def whole(pattern: str) -> str:
        return f"^(?:{pattern})$"

    def named(kind: str, text: Column, match: Column) -> Column:
        return F.struct(
            F.when(text.isNotNull(), F.lit(kind)).alias("kind"), F.coalesce(text, match).alias("text")
        )

    def run(match: Column) -> Column:
        luhn = F.pmod(_luhn(_digits(match)), F.lit(10)) == 0
        card = F.when(luhn, _card(key, match))
        mixed = F.when(match.rlike("[0-9]") & match.rlike("[A-Fa-f]"), _secret(key, match))
        phone = F.when(match.rlike(r"^\+[2-9]"), _abroad(key, match)).otherwise(_phone(key, match))
        return (
            F.when(match.contains("@"), named("email", _email(key, match), match))
            .when(match.rlike("[=:]"), named("secret", _secret(key, match), match))
            .when(match.rlike(whole(_HEX)), named("secret", mixed, match))
            .when(match.rlike("^[A-Z]{2}[0-9]"), named("iban", _iban(key, match), match))
            .when(match.rlike(whole(_SSN)), named("ssn", _ssn(key, match), match))
            .when(match.rlike(whole(_DATE)), named("date", _date(key, match), match))
            .when(match.rlike(whole(_ADDRESS)), named("ip", _ip(key, match), match))
            .when(match.rlike(whole(_CARD)), named("card", card, match))
            .otherwise(named("phone", phone, match))
        )

    return run


def pseudonymise(
    docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, text_col, n_<kind> ...)`` per row: the text with private values replaced.

    Card numbers (13 to 19 digits, Luhn-valid), account numbers (IBAN, check digits valid), social security numbers, phone numbers, network
    addresses and dates that are valid are permuted within their format: digits change, signs
    between them, lengths, check digits and validity stay. Equal values get equal pseudonyms in all
    documents, different values different ones, and only the key leads back. E-mail addresses and
    secrets (what follows a password or token sign, and 32 to 64 hexadecimal digits with a letter
    among them) get keyed names, cut to 48 bits and to four bits a character: different ones of those
    may meet, as permuted numbers and dates never do. Numbers that are not valid stay as they are. Counts are by kind.

    Null texts stay null with counts of 0. Rows are kept one for one in a narrow pass without a
    shuffle; ids may be null or repeat; other columns are ignored.
    """
    key = derive_key(secret)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    may = F.col("text").rlike("[0-9@=:]")
    # From generators, so that the optimizer repeats neither the search nor the ciphers.
    found = F.when(may, F.regexp_extract_all("text", F.lit(_ALL), F.lit(0)))
    rows = rows.select("*", F.explode(F.array(F.coalesce(found, F.array().cast("array<string>")))).alias("found"))
    rows = rows.select("*", F.explode(F.array(F.transform("found", _pseudonym(key)))).alias("new"))
    gaps = F.split("text", _ALL, -1)
    parts = F.concat(F.transform("new", lambda x: x["text"]), F.array(F.lit("")))
    merged = F.array_join(F.zip_with(gaps, parts, lambda gap, new: F.concat(gap, new)), "")
    count = lambda kind: F.size(F.filter("new", lambda x: x["kind"] == kind)).cast("bigint")
    return rows.select(
        F.col("id").alias(id_col),
        F.when(F.size("new") > 0, merged).otherwise(F.col("text")).alias(text_col),
        *(count(kind).alias(f"n_{kind}") for kind in _COUNTED),
    )
