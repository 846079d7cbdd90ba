"""Format-preserving pseudonyms for personal data.

E-mail addresses, network addresses, telephone, social security and card numbers and dates are
found in whole texts, validated (social security numbers by their form alone), and
replaced by a keyed permutation within their own format: a Feistel network over the
digits (or letters, or days) of the value.
Equal values become equal pseudonyms in every document, different values of one
format different ones; nothing is looked up, so nothing is shuffled.

Formats: a card keeps its length, separators, first digit and a right check digit;
a network address becomes another; a telephone number keeps its country code and
punctuation; a date becomes a real date of 1900 to 2099 in the same notation; an
e-mail address keeps its domain and which characters are letters or digits.

Defined cases: a null text stays null, an empty one empty; what fails validation
stays as it is; repeated rows get the same text; an empty table gives no rows;
further columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, unused

ROUNDS = 8

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "date": r"(?<![0-9])(?<![0-9][./-])(?:(?:19|20)[0-9]{2}([-/])[0-9]{2}\1[0-9]{2}"
    r"|[0-9]{2}([./-])[0-9]{2}\2(?:19|20)[0-9]{2})(?![0-9]|[./-][0-9])",
    "address": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}([\x20-])[0-9]{4}\3[0-9]{4}\3[0-9]{4}"
    r"|[0-9]{4}([\x20-])[0-9]{6}\4[0-9]{5}|[0-9]{13,19})(?![0-9])",
    "social": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?:(?<![0-9A-Za-z+])\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,3}"
    r"|(?<![0-9])(?:\([0-9]{3}\)[\x20.-]?|\(?[0-9]{3}\)?[\x20.-])[0-9]{3}[\x20.-][0-9]{4})(?![0-9])",
}
KINDS = tuple(PATTERNS)
# One scan for addresses with an @, where there is one, and one for all numbers, which
# looks closer only at a digit, a plus or a bracket; the order decides between two kinds.
MAIL = PATTERNS["email"]
NUMBERS = rf"(?=[0-9+(])(?:{'|'.join(PATTERNS[kind] for kind in KINDS[1:])})"


def _whole(kind: str) -> str:
    """The pattern of one kind for a value alone, its back references renumbered."""
    pattern = PATTERNS[kind]
    first = {"date": 1, "card": 3}.get(kind, 1)
    for n in range(first, first + 2):
        pattern = pattern.replace(f"\\{n}", f"\\{n - first + 1}")
    return f"^(?:{pattern})$"


def _keyed(key: str, kind: str, number: Column, half: Column, modulus: Column) -> Column:
    """The round function: a number below ``modulus`` from a keyed hash."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), number, half), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % modulus


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A permutation of the digit strings of the same length (2 to 36)."""
    powers = F.array(*(F.lit(10**i).cast("bigint") for i in range(19)))
    cut = F.floor(F.char_length(digits) / 2).cast("int")
    start = F.struct(
        F.substring(digits, F.lit(1), cut).alias("a"),
        F.substring(digits, cut + 1, F.char_length(digits)).alias("b"),
    )

    def step(s: Column, i: Column) -> Column:
        size = F.char_length(s["a"])
        modulus = F.get(powers, size)
        total = (s["a"].cast("bigint") + _keyed(key, kind, i, s["b"], modulus)) % modulus
        return F.struct(s["b"].alias("a"), F.lpad(total.cast("string"), size, "0").alias("b"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, step, lambda s: F.concat(s["a"], s["b"]))


def _permuted_pair(a: Column, b: Column, of_a: int, of_b: int, key: str, kind: str) -> Column:
    """A permutation of the pairs of numbers below ``of_a`` and ``of_b``."""

    def step(s: Column, i: Column) -> Column:
        new_a = (s["a"] + _keyed(key, kind, i, s["b"].cast("string"), F.lit(of_a))) % of_a
        return let(
            new_a,
            lambda x: F.struct(
                x.alias("a"),
                ((s["b"] + _keyed(key, kind, -i, x.cast("string"), F.lit(of_b))) % of_b).alias("b"),
            ),
        )

    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, step)


def _refilled(value: Column, digits: Column) -> Column:
    """The value with its digits, in order, replaced."""
    zero = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def step(s: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(
            (s["at"] + is_digit.cast("int")).alias("at"),
            F.concat(
                s["out"], F.when(is_digit, F.substring(digits, s["at"], F.lit(1))).otherwise(c)
            ).alias("out"),
        )

    return F.aggregate(F.split(value, ""), zero, step, lambda s: s["out"])


def _luhn(digits: Column) -> Column:
    """The check sum with the last digit doubled, i.e. of a number without its check digit."""
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: let(
            c.cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
            lambda d: F.when(d > 9, d - 9).otherwise(d),
        ),
    )
    return F.aggregate(places, F.lit(0), lambda a, d: a + d)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _check_digit(body: Column) -> Column:
    return ((10 - _luhn(body) % 10) % 10).cast("string")


def _card(value: Column, key: str) -> Column:
    def known(d: Column) -> Column:
        size = F.char_length(d)
        body = F.substring(d, F.lit(1), size - 1)
        rest = F.substring(d, F.lit(2), size - 2)
        changed = let(
            F.concat(F.substring(d, 1, 1), permuted_digits(rest, key, "card")),
            lambda b: _refilled(value, F.concat(b, _check_digit(b))),
        )
        valid = (F.substring(d, -1, 1) == _check_digit(body)) & ~d.rlike("^0+$")
        return F.when(valid, changed).otherwise(value)

    return let(_digits(value), known)


def _phone(value: Column, key: str) -> Column:
    def known(d: Column) -> Column:
        size = F.char_length(d)
        code = F.when(value.startswith("+"), F.greatest(F.lit(1), size - 10)).otherwise(0)
        rest = permuted_digits(F.substring(d, code + 1, size), key, "phone")
        return _refilled(value, F.concat(F.substring(d, F.lit(1), code), rest))

    return let(_digits(value), known)


def _address(value: Column, key: str) -> Column:
    def known(o: Column) -> Column:
        octet = lambda i: F.get(o, F.lit(i)).cast("bigint")
        pair = _permuted_pair(
            octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), 1 << 16, 1 << 16, key, "address"
        )
        high = lambda x: F.floor(x / 256).cast("bigint")
        return let(
            pair,
            lambda p: F.concat_ws(".", high(p["a"]), p["a"] % 256, high(p["b"]), p["b"] % 256),
        )

    return let(F.split(value, r"\."), known)


FIRST_DAY, DAYS = "1900-01-01", 73_049  # up to 2099-12-31
DAY_HALVES = (271, 270)  # their product is the next above DAYS
DATE_FORMATS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "dd/MM/yyyy", "dd-MM-yyyy", "MM/dd/yyyy", "MM-dd-yyyy")


def _date(value: Column, key: str) -> Column:
    of_a, of_b = DAY_HALVES

    def walk(day: Column) -> Column:
        pair = _permuted_pair(F.floor(day / of_b), day % of_b, of_a, of_b, key, "date")
        return let(pair, lambda p: p["a"] * of_b + p["b"])

    def permuted(day: Column) -> Column:
        # numbers past the last day are walked on; each step is past it once in 600
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(6)),
            walk(day),
            lambda d, _: F.when(d >= DAYS, walk(d)).otherwise(d),
        )

    found = value
    for form in reversed(DATE_FORMATS):
        shape = "^" + "".join("[0-9]" if c in "yMd" else f"[{c}]" for c in form) + "$"
        date = F.try_to_timestamp(value, F.lit(form)).cast("date")
        new = F.date_format(
            F.date_add(F.lit(FIRST_DAY).cast("date"), permuted(F.date_diff(date, F.lit(FIRST_DAY))).cast("int")),
            form,
        )
        found = F.when(value.rlike(shape) & date.isNotNull(), new).otherwise(found)
    return found


def _email(value: Column, key: str) -> Column:
    def shifted(text: Column, number: Column, other: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), number, other), 256)

        def one(stream: Column) -> Column:
            def char(c: Column, i: Column) -> Column:
                by = F.conv(F.substring(stream, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
                code = F.ascii(c)
                turn = lambda low, size: F.char(low + (code - low + by) % size)
                return (
                    F.when(c.between("0", "9"), turn(48, 10))
                    .when(c.between("A", "Z"), turn(65, 26))
                    .when(c.between("a", "z"), turn(97, 26))
                    .otherwise(c)
                )

            chars = F.filter(F.split(text, ""), lambda c: c != "")
            return F.array_join(F.transform(chars, char), "")

        return let(digest, one)

    def known(local: Column) -> Column:
        cut = F.floor(F.char_length(local) / 2).cast("int")
        start = F.struct(
            F.substring(local, F.lit(1), cut).alias("a"),
            F.substring(local, cut + 1, F.char_length(local)).alias("b"),
        )
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(ROUNDS)),
            start,
            lambda s, i: F.struct(s["b"].alias("a"), shifted(s["a"], i, s["b"]).alias("b")),
            lambda s: F.concat(s["a"], s["b"]),
        )

    domain = F.concat(F.lit("@"), F.substring_index(value, "@", -1))
    return F.concat(let(F.substring_index(value, "@", 1), known), domain)


def _kind(value: Column) -> Column:
    kind = F.when(F.contains(value, F.lit("@")), KINDS[0])
    for name in KINDS[1:]:
        kind = kind.when(value.rlike(_whole(name)), name)
    return kind


def _pseudonym(kind: Column, value: Column, key: str) -> Column:
    return (
        F.when(kind == "email", _email(value, key))
        .when(kind == "date", _date(value, key))
        .when(kind == "address", _address(value, key))
        .when(kind == "card", _card(value, key))
        .when(kind == "social", let(permuted_digits(_digits(value), key, "social"), lambda d: _refilled(value, d)))
        .when(kind == "phone", _phone(value, key))
        .otherwise(value)
    )


FOUND = "array<struct<kind:string,value:string,pseudonym:string>>"


def _step(text: Column, pattern: str, possible: Column, key: str) -> Column:
    """A struct of the text with all matches of a pattern replaced, and those found."""

    def match(value: Column) -> Column:
        return let(
            _kind(value),
            lambda kind: F.struct(
                kind.alias("kind"),
                value.alias("value"),
                _pseudonym(kind, value, key).alias("pseudonym"),
            ),
        )

    def joined(pieces: Column, matches: Column) -> Column:
        tails = F.transform(matches, lambda m, i: F.concat(m["pseudonym"], F.get(pieces, i + 1)))
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(tails, ""))

    matches = F.when(
        possible, F.transform(F.regexp_extract_all(text, F.lit(pattern), 0), match)
    ).otherwise(F.array().cast(FOUND))
    return let(
        matches,
        lambda m: F.struct(
            F.when(
                F.size(m) > 0,
                let(F.split(text, pattern, -1), lambda pieces: joined(pieces, m)),
            )
            .otherwise(text)
            .alias("text"),
            F.filter(m, lambda x: x["pseudonym"] != x["value"]).alias("found"),
        ),
    )


def pseudonymised(text: Column, key: str) -> Column:
    """A struct of the new text and the (kind, value, pseudonym) found, mails first."""

    def numbers(mails: Column) -> Column:
        return let(
            _step(mails["text"], NUMBERS, mails["text"].isNotNull(), key),
            lambda n: F.struct(
                n["text"].alias("text"), F.concat(mails["found"], n["found"]).alias("found")
            ),
        )

    return let(_step(text, MAIL, F.contains(text, F.lit("@")), key), numbers)


def replace_personal(docs: DataFrame, key: str, text: str = "text", found: str = "personal") -> DataFrame:
    """The documents with ``text`` replaced, and a column ``found`` of what was."""
    both = unused(docs, "both")
    new = pseudonymised(F.col(f"`{text}`").cast("string"), key)
    columns = [F.col(f"`{both}`.text").alias(text) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return docs.withColumn(both, new).select(*columns, F.col(f"`{both}`.found").alias(found))
