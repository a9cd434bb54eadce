"""Personal data replaced by format-preserving Feistel pseudonyms, DataFrame functions only.

Found and validated:

- ``card``: 13 to 19 digits, single blanks or hyphens between, with a right Luhn check digit;
- ``phone``: an international number (+, country code, 8 to 14 digits in usual groups);
- ``ip``: a dotted quad of numbers up to 255;
- ``date``: 2024-01-15, 15.01.2024 or 01/15/2024 (day first if the month would exceed 12) that exists;
- ``email``: its digits and the letters of its local part.

A value's digits go through a keyed Feistel network: the digits are cut in two halves, and in
each of ``ROUNDS`` rounds one half is moved by a keyed hash (SHA-256) of the other, modulo the
power of ten of its length. That is a permutation of all strings of that length, so different
values stay different and equal values stay equal, in every document. It keeps the format: the
Luhn digit of a card is made anew from the permuted rest; an address is permuted as a number of
32 bits; a date as a day number, walking on until it falls into 1900 to 2099; the
separators, the + and the country code stay where they were.

A value that does not validate is left alone. The letters of an e-mail's local part go through
a network of the same kind: in each round every letter of one half is moved within the alphabet
by a keyed hash of its place and the other half. Upper case stays where it was.

Each text is cut at its matches, which are replaced and put back in order, so a pseudonym is
never read as a value again. Texts with neither a digit nor an @ hold no value and are passed
over. There is no shuffle.

Defined results: null text stays null, empty text stays empty. Values next to letters or digits
are no values, but for a date before the T of a time. Repeated rows get equal results. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adfacts.llm.common import free_name

ROUNDS = 8

# Alternatives are tried in this order; a value is not part of a longer run of word characters.
FORMATS = {
    # plain classes within the lengths that addresses may have: no text makes them slow or deep
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9-][A-Za-z0-9.-]{0,251}\.[A-Za-z]{2,63}",
    "date": r"\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4}",
    "ip": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}",
    "phone": r"\+\d{1,3}(?:[ .-]?\(\d{2,4}\)|[ .-]?\d{2,4})(?:[ .-]?\d{2,4}){2,3}",
    "card": r"\d(?:[ -]?\d){12,18}",
}
BEFORE, AFTER = r"(?<![\w.+-])", r"(?![\w-]|\.\d)"
TIME_AFTER = r"(?=[Tt]\d{2}(?::?\d{2}))"  # a date may be followed by T and a time
ANY_FORMAT = (
    BEFORE + "(?:(?:" + "|".join(FORMATS.values()) + ")" + AFTER
    + r"|\d{4}-\d{2}-\d{2}" + TIME_AFTER + ")"
)
FIRST_DAY, DAYS = "1900-01-01", 73049  # to 2099-12-31


def _number(digits: Column) -> Column:
    return F.coalesce(digits.cast("bigint"), F.lit(0).cast("bigint"))


def _keyed(key: str, tweak: str, number: int | Column, value: Column) -> Column:
    """52 pseudo-random bits from a keyed hash."""
    text = F.concat_ws("|", F.lit(key), F.lit(tweak), F.lit(number) if isinstance(number, int) else number, value)
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("bigint")


def _digits_permuted(key: str, kind: str, digits: Column) -> Column:
    """A string of n digits as another one; n takes part in the key."""
    return _let(
        F.struct(
            F.floor(F.length(digits) / 2).cast("int").alias("a"),
            (F.length(digits) - F.floor(F.length(digits) / 2)).cast("int").alias("b"),
            digits.alias("d"),
        ),
        lambda x: _joined(key, kind, x),
    )


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _joined(key: str, kind: str, x: Column) -> Column:
    def power(n: Column) -> Column:
        return F.pow(F.lit(10), n).cast("bigint")

    halves = _rounds(
        key, kind, _number(F.substring(x["d"], F.lit(1), x["a"])),
        _number(F.substring(x["d"], x["a"] + 1, x["b"])), power(x["a"]), power(x["b"]),
    )
    return _let(
        halves,
        lambda h: F.concat(
            F.lpad(h["left"].cast("string"), x["a"], "0"), F.lpad(h["right"].cast("string"), x["b"], "0")
        ),
    )


def _rounds(
    key: str, kind: str, left: Column, right: Column, left_size: Column, right_size: Column
) -> Column:
    """Struct of left and right after all Feistel rounds: odd rounds move the left half by a
    keyed hash of the right one, even rounds the other way round."""
    start = F.struct(left.cast("bigint").alias("left"), right.cast("bigint").alias("right"))

    def one(h: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        said = _keyed(key, kind, turn.cast("string"), F.when(even, h["right"]).otherwise(h["left"]).cast("string"))
        return F.struct(
            F.when(even, (h["left"] + said) % left_size).otherwise(h["left"]).alias("left"),
            F.when(even, h["right"]).otherwise((h["right"] + said) % right_size).alias("right"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one)


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _with_digits(value: Column, digits: Column, shape: str = r"^\d$") -> Column:
    """The value with its digits (or what has ``shape``) replaced, in order, by others of the
    same number. Upper case stays."""
    characters = F.split(value, "")

    def put(done: Column, c: Column) -> Column:
        new = F.substring(digits, done["used"] + 1, F.lit(1))
        return F.concat(done["text"], F.when(c.rlike("^[A-Z]$"), F.upper(new)).otherwise(new))

    return F.aggregate(
        characters,
        F.struct(F.lit("").alias("text"), F.lit(0).alias("used")),
        lambda done, c: F.when(
            c.rlike(shape),
            F.struct(put(done, c).alias("text"), (done["used"] + 1).alias("used")),
        ).otherwise(F.struct(F.concat(done["text"], c).alias("text"), done["used"].alias("used"))),
        lambda done: done["text"],
    )


def _letters_permuted(key: str, kind: Column, letters: Column) -> Column:
    """A string of lower-case letters as another one of its length; ``kind`` takes part in the key."""

    def moved(half: Column, other: Column, turn: Column) -> Column:
        def letter(c: Column, at: Column) -> Column:
            said = _keyed(key, "letters", F.concat_ws("|", kind, turn.cast("string"), at.cast("string")), other)
            return F.char((F.ascii(c) - 97 + said) % 26 + 97)

        return F.when(half == "", half).otherwise(F.array_join(F.transform(F.split(half, ""), letter), ""))

    def one(h: Column, turn: Column) -> Column:
        even = turn % 2 == 0
        return F.struct(
            F.when(even, moved(h["left"], h["right"], turn)).otherwise(h["left"]).alias("left"),
            F.when(even, h["right"]).otherwise(moved(h["right"], h["left"], turn)).alias("right"),
        )

    half = F.floor(F.length(letters) / 2).cast("int")
    start = F.struct(
        F.substring(letters, F.lit(1), half).alias("left"),
        F.substring(letters, half + 1, F.length(letters)).alias("right"),
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one, lambda h: F.concat(h["left"], h["right"])
    )


def _luhn_digit(rest: Column) -> Column:
    """The check digit that completes a number."""
    total = F.aggregate(
        F.split(F.reverse(rest), ""),
        F.struct(F.lit(0).alias("sum"), F.lit(True).alias("twice")),
        lambda s, c: F.struct(
            (
                s["sum"]
                + F.when(s["twice"], F.lit(2) * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0))
                .otherwise(c.cast("int"))
            ).alias("sum"),
            (~s["twice"]).alias("twice"),
        ),
        lambda s: s["sum"],
    )
    return ((10 - total % 10) % 10).cast("string")


def _card(key: str, value: Column) -> Column:
    def permuted(d: Column) -> Column:
        rest = F.substring(d, F.lit(1), F.length(d) - 1)
        right = _luhn_digit(rest) == F.substring(d, F.length(d), F.lit(1))
        changed = _let(_digits_permuted(key, "card", rest), lambda p: F.concat(p, _luhn_digit(p)))
        return F.when(right, changed)

    return _let(_only_digits(value), lambda d: _with_new_digits(value, permuted(d)))


def _with_new_digits(value: Column, digits: Column) -> Column:
    return _let(digits, lambda d: F.when(d.isNotNull(), _with_digits(value, d)))


def _phone(key: str, value: Column) -> Column:
    code = F.regexp_extract(value, r"^\+\d{1,3}(?=\D)", 0)
    head = F.when(code == "", F.substring(value, F.lit(1), F.lit(2))).otherwise(code)
    return _let(
        head,
        lambda h: F.concat(
            h,
            _let(
                F.substring(value, F.length(h) + 1, F.length(value)),
                lambda rest: _with_digits(rest, _digits_permuted(key, "phone", _only_digits(rest))),
            ),
        ),
    )


def _ip(key: str, value: Column) -> Column:
    def permuted(p: Column) -> Column:
        part = [F.get(p, i).cast("bigint") for i in range(4)]
        size = F.lit(1 << 16).cast("bigint")
        halves = _rounds(key, "ip", part[0] * 256 + part[1], part[2] * 256 + part[3], size, size)
        return _let(
            halves,
            lambda h: F.concat_ws(
                ".",
                *[F.floor(h[side] / 256).cast("string") if high else (h[side] % 256).cast("string")
                  for side in ("left", "right") for high in (True, False)],
            ),
        )

    good = F.forall(F.split(value, r"\."), lambda p: (p.cast("int") <= 255) & ~p.rlike(r"^0\d"))
    return F.when(good, _let(F.split(value, r"\."), permuted))


def _day(key: str, day: Column) -> Column:
    """A day number as another one: a Feistel step over 270 * 271 numbers, walked until it is a day."""
    wide, deep = 270, 271
    size = [F.lit(wide).cast("bigint"), F.lit(deep).cast("bigint")]

    def step(n: Column) -> Column:
        halves = _rounds(key, "date", F.floor(n / deep), n % deep, *size)
        return _let(halves, lambda h: h["left"] * deep + h["right"])

    # 121 of the 73,170 numbers are no day, so a step misses with a chance of 1 in 605; that
    # seventeen in a row miss has a chance below 1 in 10^44.
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(16)),
        step(day),
        lambda n, _: F.when(n < DAYS, n).otherwise(step(n)),
    )


def _date(key: str, value: Column) -> Column:
    shapes = [
        (r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{2}\.", "dd.MM.yyyy"),
        (r"^(0\d|1[0-2])/", "MM/dd/yyyy"), (r"^\d{2}/", "dd/MM/yyyy"),
    ]
    out = F.lit(None).cast("string")
    for shape, pattern in reversed(shapes):
        day = F.datediff(F.try_to_date(value, pattern), F.lit(FIRST_DAY).cast("date")).cast("bigint")
        other = F.when((day >= 0) & (day < DAYS), _day(key, day)).cast("int")
        made = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), other), pattern)
        out = F.when(value.rlike(shape), made).otherwise(out)
    return out


def _email(key: str, value: Column) -> Column:
    def renamed(parts: Column) -> Column:
        local, domain = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        letters = F.regexp_replace(F.lower(local), "[^a-z]", "")
        other = _letters_permuted(key, _only_digits(local), letters)
        moved = _let(other, lambda new: _with_digits(local, new, "^[A-Za-z]$"))
        digits = _only_digits(local)
        return F.concat(
            F.when(digits == "", moved).otherwise(
                _let(moved, lambda m: _with_digits(m, _digits_permuted(key, "email", digits)))
            ),
            F.lit("@"),
            domain,
        )

    # the labels of a domain are not empty
    return F.when(~F.contains(value, F.lit("..")) | ~value.rlike(r"@.*\.\."), _let(F.split(value, "@"), renamed))


MAKERS = {"email": _email, "date": _date, "ip": _ip, "phone": _phone, "card": _card}


def _pseudonym(key: str, value: Column) -> Column:
    """Struct of kind, value and pseudonym; kind is null if the value does not validate."""
    kind, made = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, shape in reversed(FORMATS.items()):
        matches = value.rlike(f"^(?:{shape})$")
        kind = F.when(matches, F.lit(name)).otherwise(kind)
        made = F.when(matches, MAKERS[name](key, value)).otherwise(made)
    return F.struct(F.when(made.isNotNull(), kind).alias("kind"), value.alias("value"), F.coalesce(made, value).alias("pseudonym"))


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` replaced and a further column ``found``: an array of (kind, value,
    pseudonym) in the order of the text, for values that validate. Underscores follow its name
    where ``docs`` has a column called so."""
    if not key:
        raise ValueError("a key is needed")
    column = F.col(f"`{text}`")
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.when(column.rlike(r"[\d@]"), F.regexp_extract_all(column, F.lit(f"({ANY_FORMAT})"), F.lit(1)))
        .otherwise(F.array().cast("array<string>"))
        .alias("_matches"),
    )
    made = rows.select("_row", F.transform("_matches", lambda m: _pseudonym(key, m)).alias("_made"))
    source = F.col(f"_row.`{text}`")
    between = F.split(source, ANY_FORMAT, -1)
    put_back = F.array_join(
        F.flatten(
            F.zip_with(
                between,
                "_made",
                lambda gap, m: F.array(F.coalesce(gap, F.lit("")), F.coalesce(m["pseudonym"], F.lit(""))),
            )
        ),
        "",
    )
    changed = F.when(F.size("_made") > 0, put_back).otherwise(source)
    found = F.coalesce(F.filter("_made", lambda m: m["kind"].isNotNull()), F.array())
    return made.select(
        *[changed.alias(c) if c == text else F.col(f"_row.`{c}`") for c in docs.columns],
        found.alias(free_name(docs, "found")),
    )
