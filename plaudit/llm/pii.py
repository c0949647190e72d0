"""Pseudonyms for personal data: a keyed permutation of every value within its own format.

Card numbers (Luhn), telephone numbers, social security numbers, IPv4 addresses, calendar
dates and e-mail addresses are found by pattern, validated, and permuted by a Feistel network
over their valid values, so the result is valid again, equal values stay equal in all
documents, and different values stay different.  Everything is a column expression.

An even number of half rounds turns (l, r) of a domain a x b into (l, r) of the same domain:
each half is moved, modulo its size, by a keyed SHA-256 of the other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from plaudit.llm.words import free_name

ROUNDS = 8
# Candidates in the order in which they are tried at a position.
# Repeated groups are possessive: the engine follows them in a loop, not by recursion, at any length.
EMAIL = r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
SLASH_DATE = r"(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}(?![0-9/])"
DOT_DATE = r"(?<![0-9.])[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = r"(?<![0-9])(?:\+1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
# A whole run of digits and single separators, however long; cards are looked for inside.
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+"
CARD_DIGITS = (13, 19)
CANDIDATE = "|".join([EMAIL, IPV4, ISO_DATE, SLASH_DATE, DOT_DATE, SSN, PHONE, CARD])
OTHER_LETTER = r"^[\p{L}&&[\x{A0}-\x{D7FF}]]$"
# 400 years of the Gregorian calendar, 189 x 773 days, then repeat.
CYCLE_DAYS, CYCLE_A, CYCLE_B = 146097, 189, 773


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _keyed(key: str, *parts: Column) -> Column:
    """A number below 2^60 from a keyed hash."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(l: Column, r: Column, a: Column, b: Column, kind: Column, key: str) -> Column:
    """Permute the pairs (l, r) with 0 <= l < a and 0 <= r < b; gives a struct of l and r."""
    start = F.struct(l.cast("long").alias("l"), r.cast("long").alias("r"), a.cast("long").alias("a"), b.cast("long").alias("b"))

    def half(s: Column, i: Column) -> Column:
        moved = F.pmod(s["l"] + F.pmod(_keyed(key, kind, s["a"], i, s["r"]), s["a"]), s["a"])
        return F.struct(s["r"].alias("l"), moved.alias("r"), s["b"].alias("a"), s["a"].alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, half)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _pad(number: Column, width) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _refill(value: Column, digits: Column) -> Column:
    """Put new digits where `value` has digits, keeping everything else."""
    letters = F.split(value, "")
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))

    def step(s: Column, letter: Column) -> Column:
        is_digit = letter.rlike("^[0-9]$")
        return F.struct(
            F.concat(s["text"], F.when(is_digit, F.substr(digits, s["at"], F.lit(1))).otherwise(letter)).alias("text"),
            F.when(is_digit, s["at"] + 1).otherwise(s["at"]).alias("at"),
        )

    return F.aggregate(letters, start, step, lambda s: s["text"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum: from the right every second digit counts double, less 9 if over 9."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    weighed = F.transform(numbers, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(weighed, F.lit(0), lambda total, d: total + d)


def _card(value: Column, key: str) -> Column:
    def permuted(digits: Column) -> Column:
        # All digits but the check digit are permuted, then the check digit is set anew.
        n = F.length(digits) - 1
        low = F.floor(n / 2).cast("int")
        size = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")
        pair = feistel(F.substr(digits, F.lit(1), n - low).cast("long"), F.substr(digits, n - low + 1, low).cast("long"),
                       size(n - low), size(low), F.concat(F.lit("card"), n.cast("string")), key)
        body = _let(pair, lambda p: F.concat(_pad(p["l"], n - low), _pad(p["r"], low)))
        return _let(body, lambda x: F.concat(x, F.pmod(10 - luhn_sum(F.concat(x, F.lit("0"))) % 10, F.lit(10)).cast("string")))

    fresh = lambda v: _let(_digits(v), lambda d: _refill(v, permuted(d)))
    fewest, most = CARD_DIGITS

    def within(groups: Column) -> Column:
        # From every group on, the longest valid run of groups; then, from the left, those that do not overlap.
        n = F.size(groups)
        joined = lambda first, many: F.array_join(F.slice(groups, first, many), "")

        def holds(part: Column) -> Column:
            size = F.length(part)
            return F.when(size.between(fewest, most), luhn_sum(part) % 10 == 0).otherwise(False)

        def longest(i: Column) -> Column:
            runs = F.sequence(F.lit(1), F.least(F.lit(most), n - i + 1))
            best = F.array_max(F.filter(runs, lambda many: _let(_digits(joined(i, many)), holds)))
            return F.struct(i.alias("first"), best.alias("many"))

        runs = F.filter(F.transform(F.sequence(F.lit(1), n), longest), lambda r: r["many"].isNotNull())
        nothing = F.array().cast("array<struct<begin:int,first:int,many:int>>")
        start = F.struct(F.lit(1).alias("free"), nothing.alias("picks"))

        def pick(s: Column, r: Column) -> Column:
            one = F.struct(s["free"].alias("begin"), r["first"].alias("first"), r["many"].alias("many"))
            taken = F.struct((r["first"] + r["many"]).alias("free"), F.array_append(s["picks"], one).alias("picks"))
            return F.when(r["first"] >= s["free"], taken).otherwise(s)

        def rebuilt(s: Column) -> Column:
            before = lambda p: joined(p["begin"], p["first"] - p["begin"])
            parts = F.transform(s["picks"], lambda p: F.concat(before(p), fresh(joined(p["first"], p["many"]))))
            return F.concat(F.array_join(parts, ""), joined(s["free"], n))

        return _let(F.aggregate(runs, start, pick), rebuilt)

    return _let(F.regexp_extract_all(value, F.lit("[0-9]+[ -]?"), F.lit(0)), within)


def _phone(value: Column, key: str) -> Column:
    """Ten digits, area and exchange codes starting with 2 to 9; a country code stays."""

    def permuted(digits: Column) -> Column:
        ten = F.right(digits, F.lit(10))
        part = lambda i, n: F.substring(ten, i, n).cast("long")
        pair = feistel((part(1, 3) - 200) * 800 + part(4, 3) - 200, part(7, 4), F.lit(640_000), F.lit(10_000), F.lit("phone"), key)
        fresh = _let(pair, lambda p: F.concat(
            _pad(F.floor(p["l"] / 800) + 200, 3), _pad(p["l"] % 800 + 200, 3), _pad(p["r"], 4)))
        return F.concat(F.substr(digits, F.lit(1), F.length(digits) - 10), fresh)

    return _let(_digits(value), lambda d: _refill(value, permuted(d)))


def _ssn(value: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""

    def permuted(d: Column) -> Column:
        area, group, serial = (F.substring(d, i, n).cast("long") for i, n in ((1, 3), (4, 2), (6, 4)))
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
        index = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1
        pair = feistel(index, serial - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key)

        def rebuilt(p: Column) -> Column:
            place = F.floor(p["l"] / 99) + 1
            return F.concat(_pad(F.when(place >= 666, place + 1).otherwise(place), 3), _pad(p["l"] % 99 + 1, 2), _pad(p["r"] + 1, 4))

        return F.when(valid, _refill(value, _let(pair, rebuilt))).otherwise(value)

    return _let(_digits(value), permuted)


def _ipv4(value: Column, key: str) -> Column:
    def permuted(octets: Column) -> Column:
        part = lambda i: F.element_at(octets, i)
        pair = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536), F.lit(65536), F.lit("ipv4"), key)
        fresh = _let(pair, lambda p: F.concat_ws(".", *[
            x.cast("string") for half in (p["l"], p["r"]) for x in (F.floor(half / 256).cast("long"), half % 256)]))
        return F.when(F.forall(octets, lambda x: x < 256), fresh).otherwise(value)

    return _let(F.transform(F.split(value, r"\."), lambda x: x.cast("long")), permuted)


def _valid_date(year: Column, month: Column, day: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    last = F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    return year.between(1, 9999) & month.between(1, 12) & (day >= 1) & (day <= last)


def _moved_date(year: Column, month: Column, day: Column, key: str, use: Callable[[Column], Column]) -> Column:
    """`use` of the pseudonym date, or null for no calendar date.

    The same day gets the same pseudonym in every notation, within its own 400 years.
    """

    def moved(date: Column) -> Column:
        days = F.datediff(date, F.lit("1601-01-01").cast("date"))
        cycle = F.floor(days / CYCLE_DAYS).cast("long")
        inside = F.pmod(days, F.lit(CYCLE_DAYS))
        pair = feistel(F.floor(inside / CYCLE_B), inside % CYCLE_B, F.lit(CYCLE_A), F.lit(CYCLE_B), F.lit("date"), key)
        place = _let(pair, lambda p: p["l"] * CYCLE_B + p["r"])
        # Years before 1601 and after 2000 + 8000 - 400 have part of a cycle only; they are left to the caller.
        return F.when(cycle.between(0, 19), use(F.date_add(F.lit("1601-01-01").cast("date"), (cycle * CYCLE_DAYS + place).cast("int"))))

    return F.when(_valid_date(year, month, day), _let(F.make_date(year, month, day), moved))


def _part(date: Column, what: str) -> Column:
    return F.lpad(F.extract(F.lit(what), date).cast("string"), 4 if what == "YEAR" else 2, "0")


def _date(value: Column, key: str, separator: str, order: tuple[str, str, str]) -> Column:
    """A date whose numbers stand in the given order; its separators stay, months and days get two digits."""
    fields = F.transform(F.split(value, "[-/.]"), lambda x: x.cast("int"))
    number = {name: F.element_at(fields, i + 1) for i, name in enumerate(order)}
    return _moved_date(number["YEAR"], number["MONTH"], number["DAY"], key,
                       lambda date: F.concat_ws(separator, *[_part(date, name) for name in order]))


def _email(value: Column, key: str) -> Column:
    """Characters of the part before the @ move within lower case, upper case and digits.

    Letters of other scripts move among the 16 code points of their block; beyond the 16-bit plane they stay.
    """
    local = F.element_at(F.split(value, "@"), 1)
    low = F.floor(F.length(local) / 2).cast("int")
    start = F.struct(F.substr(local, F.lit(1), low).alias("l"), F.substr(local, low + 1, F.length(local)).alias("r"))

    def half(s: Column, i: Column) -> Column:
        def shifted(letter: Column, place: Column, digest: Column) -> Column:
            move = F.conv(F.substr(digest, F.pmod(place * 4, F.lit(60)).cast("int") + 1, F.lit(4)), 16, 10).cast("int")
            within = lambda first, size: F.chr(F.pmod(F.ascii(letter) - ord(first) + move, F.lit(size)) + ord(first))
            code = F.conv(F.hex(F.encode(letter, "UTF-16BE")), 16, 10).cast("long")
            block = F.floor(code / 16) * 16 + F.pmod(code + move, F.lit(16))
            other = F.decode(F.unhex(F.lpad(F.hex(block), 4, "0")), "UTF-16BE")
            return (F.when(letter.rlike("^[a-z]$"), within("a", 26)).when(letter.rlike("^[A-Z]$"), within("A", 26))
                    .when(letter.rlike("^[0-9]$"), within("0", 10)).when(letter.rlike(OTHER_LETTER), other).otherwise(letter))

        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.length(local).cast("string"), i.cast("string"), s["r"]), 256)
        letters = F.filter(F.split(s["l"], ""), lambda c: c != "")
        moved = _let(digest, lambda d: F.array_join(F.transform(letters, lambda c, n: shifted(c, n, d)), ""))
        return F.struct(s["r"].alias("l"), moved.alias("r"))

    fresh = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, half, lambda s: F.concat(s["l"], s["r"]))
    return F.concat(fresh, F.substr(value, F.length(local) + 1, F.length(value)))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one candidate; a value that fails validation stays as it is."""
    whole = lambda pattern: value.rlike("^(?:" + pattern + ")$")
    first = F.regexp_extract(value, "^[0-9]+", 0).cast("int")
    slashed = F.when(first > 12, _date(value, key, "/", ("DAY", "MONTH", "YEAR"))).otherwise(
        _date(value, key, "/", ("MONTH", "DAY", "YEAR"))
    )
    return (
        F.when(F.contains(value, F.lit("@")), _email(value, key))
        .when(whole(IPV4), _ipv4(value, key))
        .when(whole(ISO_DATE), F.coalesce(_date(value, key, "-", ("YEAR", "MONTH", "DAY")), value))
        .when(whole(SLASH_DATE), F.coalesce(slashed, value))
        .when(whole(DOT_DATE), F.coalesce(_date(value, key, ".", ("DAY", "MONTH", "YEAR")), value))
        .when(whole(SSN), _ssn(value, key))
        .when(whole(PHONE), _phone(value, key))
        .otherwise(_card(value, key))
    )


def pseudonymise(docs: DataFrame, key: str, text_column: str = "text", count_column: str | None = None) -> DataFrame:
    """`docs` with pseudonyms in the text; a null text stays null, repeated rows stay repeated.

    `count_column`, if named, counts the values that were replaced and takes the place of a
    column of that name.  Other columns pass through.  Texts without digits and @ are not searched.
    """
    text = F.col(f"`{text_column}`")
    none = F.array().cast("array<string>")
    found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).otherwise(none)
    old, new = (free_name([*docs.columns, count_column or ""], name) for name in ("found", "new"))
    searched = docs.withColumn(old, found)
    searched = searched.withColumn(new, F.transform(old, lambda value: pseudonym(value, key)))
    between = F.split(text, CANDIDATE, -1)
    pieces = F.zip_with(between, new, lambda gap, put: F.concat(gap, F.coalesce(put, F.lit(""))))
    fresh = F.when(F.size(old) == 0, text).otherwise(F.array_join(pieces, ""))
    if count_column:
        changed = F.filter(F.zip_with(old, new, lambda was, put: was != put), lambda x: x)
        searched = searched.withColumn(count_column, F.when(text.isNull(), 0).otherwise(F.size(changed)).cast("long"))
    return searched.withColumn(text_column, fresh).drop(old, new)

