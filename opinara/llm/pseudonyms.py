"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Candidates are found by pattern and validated: Luhn for card numbers, modulo 97 for bank
accounts, real days for dates, octets for network addresses, assigned ranges for social
security numbers. What passes is permuted within its own format by a keyed Feistel
network, so equal values get equal pseudonyms in every document, different values stay
different, and a pseudonym passes the same validation. Numbers that fail it stay. A value
is its spelling but for blanks and hyphens in numbers: a slashed date, whose day or month
may come first, is one among the slashed dates, not tied to the same day spelt otherwise.

Only built-in column expressions are used. Work is per text, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import free_name

ROUNDS = 8

# What surrounds a match, and the shape of each kind.
_START = r"(?<![\p{L}\p{N}_@])(?<!\p{N}[.+-])"
_END = r"(?![\p{L}\p{N}])"
EMAIL = r"[\p{L}\p{N}_%+-]++(?:\.[\p{L}\p{N}_%+-]++)*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"
IBAN = r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)"
SECRET = r"(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])(?:[0-9a-f]{32,}|[0-9A-F]{32,})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"
DATE = r"(?:(?:19|20)\d\d-\d\d-\d\d|\d\d/\d\d/(?:19|20)\d\d|\d\d\.\d\d\.(?:19|20)\d\d)"
SOCIAL = r"\d{3}-\d{2}-\d{4}"
CARD = r"(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})"
PHONE = r"(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})"
_KINDS = [EMAIL, IBAN, SECRET, ADDRESS, DATE, SOCIAL, CARD, PHONE]
ANY = f"{_START}(?:{'|'.join(_KINDS)}){_END}"
HEX = "0123456789abcdef"
#: Days of 1900 to 2099: 73,049 = 17 * 4,297.
_DAYS = (17, 4_297)
#: Slashed dates: a place per day, month first; behind them 19 places per month for its
#: days from the 13th on, day first. The pairs a network permutes are a few more.
_PLACES = (345, 344)
_N_DAYS, _LATE = 73_049, 19
#: Steps of a walk back into the valid places; 98.8 % of all are, so two are rare.
_WALK = 40


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def _keyed(key: str, kind: str, step: Column, value: Column) -> Column:
    """64 hexadecimal digits that depend on the key, the kind, the round and the value."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), value.cast("string")).cast("binary"), 256)


def _feistel(left: Column, right: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of pairs below ``sizes``: each round adds a keyed number to one side."""

    def turn(state: Column, step: Column) -> Column:
        def moved(own: Column, other: Column, size: int) -> Column:
            return (own + _number(F.substring(_keyed(key, kind, step, other), 1, 15))) % F.lit(size)

        even = step % 2 == 0
        return F.struct(
            F.when(even, moved(state["l"], state["r"], sizes[0])).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(moved(state["r"], state["l"], sizes[1])).alias("r"),
        )

    start = F.struct((left.cast("long") % sizes[0]).alias("l"), (right.cast("long") % sizes[1]).alias("r"))
    return F.aggregate(F.array(*[F.lit(k) for k in range(ROUNDS)]), start, turn)


def _shift_class(char: Column, by: Column) -> Column:
    """A digit to a digit, an ASCII letter to a letter of its case; anything else stays."""
    code = F.ascii(char)
    rolled = lambda first, size: F.char(F.lit(first) + (code - first + by) % size)
    return (
        F.when(code.between(48, 57), rolled(48, 10))
        .when(code.between(97, 122), rolled(97, 26))
        .when(code.between(65, 90), rolled(65, 26))
        .otherwise(char)
    )


def _shift_hex(char: Column, by: Column) -> Column:
    """A lower-case hexadecimal digit to another."""
    return F.substr(F.lit(HEX), (F.position(char, F.lit(HEX)) - 1 + by) % 16 + 1, F.lit(1))


def _string_feistel(text: Column, key: str, kind: str, shift: Callable[[Column, Column], Column]) -> Column:
    """A permutation of strings that keeps the class of every character.

    The halves take turns: each character of one is shifted within its class by a keyed
    number that depends on the whole other half.
    """

    def moved(own: Column, other: Column, step: Column) -> Column:
        keyed = _keyed(key, kind, step, F.concat(F.char_length(own).cast("string"), F.lit("|"), other))

        def shifted(stream: Column) -> Column:
            by = lambda k: _number(F.substr(stream, (k % 16) * 4 + 1, F.lit(4))) + F.floor(k / 16)
            places = F.sequence(F.lit(0), F.char_length(own) - 1)
            return F.array_join(
                F.transform(places, lambda k: _let(by(k), lambda n: shift(F.substr(own, k + 1, F.lit(1)), n))), ""
            )

        return F.when(F.char_length(own) == 0, own).otherwise(_let(keyed, shifted))

    def turn(state: Column, step: Column) -> Column:
        even = step % 2 == 0
        return F.struct(
            F.when(even, moved(state["l"], state["r"], step)).otherwise(state["l"]).alias("l"),
            F.when(even, state["r"]).otherwise(moved(state["r"], state["l"], step)).alias("r"),
        )

    half = F.floor(F.char_length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1).alias("r"))
    steps = F.array(*[F.lit(k) for k in range(ROUNDS)])
    return F.aggregate(steps, start, turn, lambda end: F.concat(end["l"], end["r"]))


def _fill(shape: Column, letters: Column) -> Column:
    """``shape`` with its letters and digits replaced, in order, by those of ``letters``."""
    places = F.sequence(F.lit(1), F.char_length(shape))

    def at(k: Column) -> Column:
        nth = F.char_length(F.regexp_replace(F.substr(shape, F.lit(1), k), "[^0-9A-Za-z]", ""))
        own = F.substr(shape, k, F.lit(1))
        return F.when(own.rlike("[0-9A-Za-z]"), F.substr(letters, nth, F.lit(1))).otherwise(own)

    return F.array_join(F.transform(places, at), "")


def _digit(digits: Column, place: Column) -> Column:
    return F.substr(digits, place, F.lit(1)).cast("int")


def _luhn(payload: Column) -> Column:
    """The check digit behind ``payload``."""
    n = F.char_length(payload)

    def weight(k: Column) -> Column:
        d = _digit(payload, n - k + 1)
        return F.when(k % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), weight), F.lit(0), lambda a, x: a + x)
    return (10 - total % 10) % 10


def _mod97(letters: Column) -> Column:
    """The number that digits and letters (A as 10) spell, modulo 97."""

    def add(rest: Column, k: Column) -> Column:
        code = F.ascii(F.substr(letters, k, F.lit(1)))
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.char_length(letters)), F.lit(0), add)


def _card(found: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        payload = F.substr(digits, F.lit(1), F.char_length(digits) - 1)
        valid = _let(payload, _luhn) == F.right(digits, F.lit(1)).cast("int")
        whole = _let(
            _string_feistel(payload, key, "card", _shift_class), lambda m: F.concat(m, _luhn(m).cast("string"))
        )
        return F.when(valid, _let(whole, lambda w: _fill(found, w)))

    return _let(F.regexp_replace(found, "[^0-9]", ""), of)


def _iban(found: Column, key: str) -> Column:
    def of(letters: Column) -> Column:
        country, own = F.left(letters, F.lit(2)), F.substr(letters, F.lit(5))

        def whole(moved: Column) -> Column:
            rest = _let(F.concat(moved, country, F.lit("00")), _mod97)
            return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), moved)

        valid = _let(F.concat(own, F.left(letters, F.lit(4))), _mod97) == 1
        made = _let(_string_feistel(own, key, "iban", _shift_class), whole)
        return F.when(valid, _let(made, lambda w: _fill(found, w)))

    return _let(F.replace(found, F.lit(" "), F.lit("")), of)


def _phone(found: Column, key: str) -> Column:
    prefix = F.coalesce(
        F.nullif(F.regexp_extract(found, r"^\+\d{1,3}(?=[ .(-])", 0), F.lit("")), F.regexp_extract(found, r"^\+\d", 0)
    )

    def of(rest: Column) -> Column:
        digits = F.regexp_replace(rest, "[^0-9]", "")
        moved = _let(_string_feistel(digits, key, "phone", _shift_class), lambda m: _fill(rest, m))
        return F.when(F.char_length(digits).between(6, 14), F.concat(prefix, moved))

    return _let(F.substr(found, F.char_length(prefix) + 1), of)


def _email(found: Column, key: str) -> Column:
    head = F.regexp_extract(found, r"^(.*)\.", 1)
    moved = _string_feistel(head, key, "email", _shift_class)
    return F.concat(moved, F.substr(found, F.char_length(head) + 1))


def _address(found: Column, key: str) -> Column:
    part = lambda k: F.split_part(found, F.lit("."), F.lit(k)).cast("long")
    moved = _feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), (65_536, 65_536), key, "address")

    def octets(pair: Column) -> Column:
        halves = [F.floor(pair["l"] / 256), pair["l"] % 256, F.floor(pair["r"] / 256), pair["r"] % 256]
        return F.concat_ws(".", *[h.cast("string") for h in halves])

    return _let(moved, octets)


def _social(found: Column, key: str) -> Column:
    area, group, serial = (F.split_part(found, F.lit("-"), F.lit(k)).cast("long") for k in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    nth = area - F.when(area < 666, 1).otherwise(2)
    moved = _feistel(nth * 99 + group - 1, serial - 1, (898 * 99, 9_999), key, "social")

    def number(pair: Column) -> Column:
        place = F.floor(pair["l"] / 99)
        parts = (place + F.when(place < 665, 1).otherwise(2), pair["l"] % 99 + 1, pair["r"] + 1)
        return F.concat_ws("-", *[F.lpad(n.cast("string"), w, "0") for n, w in zip(parts, (3, 2, 4), strict=True)])

    return F.when(valid, _let(moved, number))


def _date(found: Column, key: str) -> Column:
    first = F.lit("1900-01-01").cast("date")
    out = F.lit(None).cast("string")
    for pattern in ("dd.MM.yyyy", "yyyy-MM-dd"):
        day = F.try_to_timestamp(found, F.lit(pattern)).cast("date")
        n = F.datediff(day, first)
        moved = _feistel(n % _DAYS[0], F.floor(n / _DAYS[0]), _DAYS, key, "date")
        to = _let(moved, lambda p: F.date_add(first, (p["r"] * _DAYS[0] + p["l"]).cast("int")))
        out = F.when(day.isNotNull(), F.date_format(to, pattern)).otherwise(out)
    return F.when(F.contains(found, F.lit("/")), _slashed(found, key)).otherwise(out)


def _slashed(found: Column, key: str) -> Column:
    """Slashed dates permuted among all strings that are a day with the month or the day first.

    A place that is no such string is permuted again until one is.
    """
    first = F.lit("1900-01-01").cast("date")
    month_first, day_first = (F.try_to_timestamp(found, F.lit(p)).cast("date") for p in ("MM/dd/yyyy", "dd/MM/yyyy"))
    # A day that can only be read day first is a 13th or later.
    late = _N_DAYS + ((F.year(day_first) - 1900) * 12 + F.month(day_first) - 1) * _LATE + F.day(day_first) - 13
    place = F.coalesce(F.datediff(month_first, first), late).cast("long")
    month = lambda n: F.add_months(first, F.floor((n - _N_DAYS) / _LATE).cast("int"))
    day = lambda n: (n - _N_DAYS) % _LATE + 13
    last = _N_DAYS + 2_400 * _LATE
    valid = lambda n: (n < _N_DAYS) | ((n < last) & (day(n) <= F.day(F.last_day(month(n)))))

    def moved(n: Column) -> Column:
        pair = _feistel(n % _PLACES[0], F.floor(n / _PLACES[0]), _PLACES, key, "slashed")
        return _let(pair, lambda p: p["r"] * _PLACES[0] + p["l"])

    walk = F.aggregate(
        F.array(*[F.lit(k) for k in range(_WALK)]), _let(place, moved), lambda n, _: F.when(valid(n), n).otherwise(moved(n))
    )
    spelt = lambda n: F.when(n < _N_DAYS, F.date_format(F.date_add(first, n.cast("int")), "MM/dd/yyyy")).otherwise(
        F.concat(F.lpad(day(n).cast("string"), 2, "0"), F.date_format(month(n), "/MM/yyyy"))
    )
    return F.when(place.isNotNull(), _let(walk, spelt))


def _secret(found: Column, key: str) -> Column:
    moved = _string_feistel(F.lower(found), key, "secret", _shift_hex)
    return _let(moved, lambda m: F.when(F.lower(found) == found, m).otherwise(F.upper(m)))


def pseudonym(found: Column, key: str) -> Column:
    """The pseudonym of one match; what is no valid value of any kind stays."""
    is_ = lambda kind: found.rlike(f"^(?:{kind})$")
    return F.coalesce(
        F.when(is_(EMAIL), _email(found, key))
        .when(is_(IBAN), _iban(found, key))
        .when(is_(SECRET), _secret(found, key))
        .when(is_(ADDRESS), _address(found, key))
        .when(is_(DATE), _date(found, key))
        .when(is_(SOCIAL), _social(found, key))
        .when(is_(CARD), _card(found, key))
        .when(is_(PHONE), _phone(found, key)),
        found,
    )


def pseudonymise(docs: DataFrame, key: str, *, text: str = "text", changed: str | None = None) -> DataFrame:
    """``docs`` with every valid personal value in ``text`` replaced; same columns, same rows.

    ``changed`` names a column for the number of values replaced (it takes the place of
    a column of that name). Null texts stay null, empty and clean texts stay as they are,
    and repeated rows and ties get equal texts. Texts keep their length: every kind keeps
    its format, but for network addresses, whose octets have one to three digits.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    own = F.col(f"`{text}`")
    found = F.when(own.rlike("[0-9@]"), F.regexp_extract_all(own, F.lit(ANY), F.lit(0)))
    before, after = free_name("_found", docs), free_name("_moved", docs)
    marked = docs.withColumn(before, found)
    moved = F.transform(before, lambda m: pseudonym(m, key))
    marked = marked.withColumn(after, F.when(F.size(before) > 0, moved))
    joined = F.array_join(
        F.zip_with(F.split(own, ANY, -1), after, lambda rest, m: F.concat(rest, F.coalesce(m, F.lit("")))), ""
    )
    count = F.size(F.filter(F.zip_with(before, after, lambda a, b: a != b), lambda x: x)).cast("long")
    columns = {text: F.when(F.col(after).isNotNull(), joined).otherwise(own)}
    if changed:
        columns[changed] = F.coalesce(F.when(F.col(after).isNotNull(), count), F.lit(0).cast("long"))
    return marked.withColumns(columns).drop(before, after)
