"""Format-preserving pseudonyms for personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

ROUNDS = 10
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"

# Shapes of personal data in text, in the order in which they are tried.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
YEAR_FIRST = r"(?<![0-9./])[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}(?![0-9/])"
OTHER_DATE = r"(?<![0-9./])[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IP = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
# Digit groups that hold a card of fixed grouping (4-4-4-4, 4-6-5) with what stands around it; groups of a date are left out. Then the loose form, which ends
# before such groups. Which of the groups make a card is decided by Luhn.
MORE = r"(?![0-9]|[/.-][0-9])"
GROUPED = (r"(?<![0-9])(?:[0-9]{1,3}[ -])?[0-9]{4}(?:[ -][0-9]{4}(?![0-9])){3}(?:[ -][0-9]{4}" + MORE + r"){0,8}(?:[ -][0-9]{1,3}" + MORE + r")?"
           r"|(?<![0-9])(?:[0-9]{1,3}[ -])?[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])(?:[ -][0-9]{1,4}" + MORE + r")?")
FIXED = r"[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])|[0-9]{13,19}(?![0-9])"
LOOSE = r"(?<![0-9-])[0-9](?:(?![ -](?:" + FIXED + r"))[ -]?[0-9]){12,18}(?![0-9]|-[0-9])(?!(?<=[ -][0-9]{1,2})[/.][0-9])"
CARD = GROUPED + "|" + LOOSE
BLANK_PHONE = r"(?<![0-9A-Za-z])(?:1 )?[0-9]{3} [0-9]{3} [0-9]{4}(?![0-9])"
PHONE = r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[.-])[0-9]{3,4}[ .-][0-9]{4}(?![0-9])|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])"
KINDS = {"email": EMAIL, "iban": IBAN, "iso_date": ISO_DATE, "year_first": YEAR_FIRST, "date": OTHER_DATE, "ssn": SSN, "ip": IP, "phone": PHONE, "card": CARD, "blank_phone": BLANK_PHONE}
ANY = "|".join(f"(?:{p})" for p in (EMAIL, IBAN, ISO_DATE, YEAR_FIRST, OTHER_DATE, SSN, IP, PHONE, CARD, BLANK_PHONE))


def keyed(key: str, *parts: Column) -> Column:
    """Hex digest of key and parts: the round function."""
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)


def number(hex_: Column, start: int, digits: int = 12) -> Column:
    return F.conv(F.substring(hex_, start, digits), 16, 10).cast("bigint")


def feistel_text(s: Column, alphabet: str, key: str) -> Column:
    """Keyed permutation of the strings over ``alphabet`` of one length.

    Each round shifts one half, character by character, by a digest of the other half, and swaps; every round can be undone,
    so the whole is a permutation. The digest depends on key, round, length and alphabet.
    """
    n = len(alphabet)

    def shifted(a: Column, b: Column, i: Column) -> Column:
        def one(j: Column) -> Column:
            block = keyed(key, i, F.length(s), F.lit(n), b, F.floor(j / 15))
            move = F.conv(F.substr(block, (j % 15 * 4 + 1).cast("int"), F.lit(4)), 16, 10).cast("int")
            at = F.instr(F.lit(alphabet), F.substr(a, j + 1, F.lit(1))) - 1
            return F.substr(F.lit(alphabet), ((at + move) % n + 1).cast("int"), F.lit(1))
        return F.when(F.length(a) == 0, F.lit("")).otherwise(F.array_join(F.transform(F.sequence(F.lit(0), F.greatest(F.length(a) - 1, F.lit(0))), one), ""))

    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("a"), F.substr(s, half + 1).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda x, i: F.struct(x["b"].alias("a"), shifted(x["a"], x["b"], i).alias("b")), lambda x: F.concat(x["a"], x["b"]))


def feistel_pair(left: Column, right: Column, a: int, b: int, key: str, label: str) -> Column:
    """Keyed permutation of Z_a x Z_b as struct(l, r): the halves shift each other in turn."""
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    def step(x: Column, i: Column) -> Column:
        l = (x["l"] + number(keyed(key, F.lit(label), i, F.lit("l"), x["r"]), 1)) % a
        return F.struct(l.alias("l"), ((x["r"] + number(keyed(key, F.lit(label), i, F.lit("r"), l), 1)) % b).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def refill(shape: Column, kind: str, new: Column) -> Column:
    """``shape`` with its characters of class ``kind`` replaced, in order, by those of ``new``."""
    out = F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("o"), F.lit(1).alias("k")), lambda x, c: F.when(
        c.rlike(f"^[{kind}]$"), F.struct(F.concat(x["o"], F.substr(new, x["k"], F.lit(1))).alias("o"), (x["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(x["o"], c).alias("o"), x["k"].alias("k"))), lambda x: x["o"])
    return out


def only(s: Column, kind: str) -> Column:
    return F.regexp_replace(s, f"[^{kind}]", "")


def luhn_sum(digits: Column, odd_from_right: int) -> Column:
    """Luhn sum; places at distance ``odd_from_right`` modulo 2 from the right are doubled."""
    n = F.length(digits)
    def one(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when((n - i) % 2 == odd_from_right, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)
    return F.aggregate(F.transform(F.sequence(F.lit(1), n), one), F.lit(0), lambda x, y: x + y)


def mod97(chars: Column) -> Column:
    """Value modulo 97 of a string in which letters stand for 10 to 35."""
    def step(x: Column, c: Column) -> Column:
        v = F.instr(F.lit(DIGITS + LETTERS.upper()), c) - 1
        return (x * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(F.split(chars, ""), F.lit(0), step)


def days_in(year: Column, month: Column) -> Column:
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(month.isin(4, 6, 9, 11), 30).when(month == 2, F.when(leap, 29).otherwise(28)).otherwise(31)


def new_day(year: Column, month: Column, day: Column, key: str) -> Column:
    """Another valid date of the same 400-year cycle, counted from 1800 (146,097 = 189 * 773 days), or null if the date isn't valid."""
    valid = (year >= 1) & (month >= 1) & (month <= 12) & (day >= 1) & (day <= days_in(year, month))
    at = F.datediff(F.make_date(F.when(valid, year), F.when(valid, month), F.when(valid, day)), F.lit("1800-01-01").cast("date"))
    cycle, inside = F.floor(at / 146097), F.pmod(at, F.lit(146097))
    p = feistel_pair(F.floor(inside / 773), inside % 773, 189, 773, key, "date")
    return F.date_add(F.lit("1800-01-01").cast("date"), (cycle * 146097 + p["l"] * 773 + p["r"]).cast("int"))


def new_late_day(year: Column, month: Column, day: Column, key: str) -> Column:
    """Another date of the same 400-year cycle with a day over 12 (88,497 = 9833 * 9 such days), or null if the date isn't one.

    Dates that only read day-first stay among themselves, so that no two values get one pseudonym."""
    valid = (year >= 1) & (month >= 1) & (month <= 12) & (day > 12) & (day <= days_in(year, month))
    start = F.lit("1800-01-01").cast("date")
    cycle = F.floor((year - 1800) / 400)
    months = (year - 1800 - cycle * 400) * 12 + month - 1
    first = lambda k: F.datediff(F.add_months(start, k.cast("int")), start)
    at = F.when(valid, first(months) - 12 * months + day - 13)
    p = feistel_pair(F.floor(at / 9), at % 9, 9833, 9, key, "late date")

    def dated(x: Column) -> Column:
        n = x["l"] * 9 + x["r"]
        near = F.floor(n * 4800 / 88497)
        month = F.array_max(F.filter(F.transform(F.array(near - 1, near, near + 1), lambda k: F.greatest(k, F.lit(0))), lambda k: first(k) - 12 * k <= n))
        return F.date_add(start, (cycle * 146097 + n + 12 * month + 12).cast("int"))
    return F.when(valid, F.transform(F.array(p), dated)[0])


def card_spans(m: Column) -> Column:
    """Ordered spans (s, e; from 1, both inside) of the card numbers in a match: runs of whole digit groups that pass Luhn.

    Fixed groupings come first, then the whole match, then longer runs, then the leftmost; chosen runs don't overlap."""
    groups = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))

    def runs(g: Column) -> Column:
        n = F.size(g)
        end = lambda i: F.aggregate(F.slice(g, F.lit(1), i + 1), F.lit(0), lambda a, x: a + F.length(x) + 1) - 1
        one = lambda i, j: F.struct((end(i) - F.length(F.get(g, i)) + 1).alias("s"), end(j).alias("e"), F.array_join(F.slice(g, i + 1, j - i + 1), " ").alias("t"))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.transform(F.sequence(i, F.greatest(n - 1, i)), lambda j: one(i, j))))

    found = F.flatten(F.transform(F.array(groups), runs))
    digits = lambda t: F.replace(t, F.lit(" "), F.lit(""))
    found = F.filter(found, lambda x: F.length(digits(x["t"])).between(13, 19))
    found = F.filter(found, lambda x: luhn_sum(digits(x["t"]), 1) % 10 == 0)
    ranked = F.sort_array(F.transform(found, lambda x: F.struct((~x["t"].rlike(f"^(?:{FIXED})$")).alias("loose"), (x["s"] - x["e"]).alias("less"), x["s"].alias("s"), x["e"].alias("e"))))
    span = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
    none = F.array().cast("array<struct<s:int,e:int>>")
    chosen = F.aggregate(ranked, none, lambda a, x: F.when(F.exists(a, lambda y: (y["s"] <= x["e"]) & (x["s"] <= y["e"])), a).otherwise(F.concat(a, F.array(span(x)))))
    return F.sort_array(chosen)


def pseudonym(m: Column, key: str) -> tuple[Column, Column, Column]:
    """(kind, pseudonym, number of values) of one match; the first two null where the value doesn't validate."""
    digits = only(m, "0-9")
    whole = {k: m.rlike(f"^(?:{p})$") for k, p in KINDS.items()}
    part = lambda p, i: F.regexp_extract(m, p, i).try_cast("int")
    # e-mail: the letters and the digits of the local part are permuted, the domain stays
    local = F.substring_index(m, "@", 1)
    mail = refill(refill(F.lower(local), "a-z", feistel_text(only(F.lower(local), "a-z"), LETTERS, key)), "0-9", feistel_text(only(local, "0-9"), DIGITS, key))
    mail = F.concat(mail, F.substr(m, F.length(local) + 1))
    # IBAN: country and letters stay, the digits of the account are permuted, the check digits follow
    plain = F.replace(m, F.lit(" "), F.lit(""))
    iban_ok = mod97(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))) == 1
    account = refill(F.substr(plain, F.lit(5)), "0-9", feistel_text(only(F.substr(plain, F.lit(5)), "0-9"), DIGITS, key))
    check = F.lpad((98 - mod97(F.concat(account, F.substr(plain, F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0")
    iban = refill(m, "A-Z0-9", F.concat(F.substr(plain, F.lit(1), F.lit(2)), check, account))
    # dates
    iso = new_day(part(r"^(\d+)-(\d+)-(\d+)$", 1), part(r"^(\d+)-(\d+)-(\d+)$", 2), part(r"^(\d+)-(\d+)-(\d+)$", 3), key)
    dot = r"^(\d+)([./])(\d+)[./](\d+)$"
    us = F.regexp_extract(m, dot, 2) == "/"  # month/day/year with slashes, day.month.year with dots
    other = new_day(part(dot, 4), F.when(us, part(dot, 1)).otherwise(part(dot, 3)), F.when(us, part(dot, 3)).otherwise(part(dot, 1)), key)
    late = F.when(us, new_late_day(part(dot, 4), part(dot, 3), part(dot, 1), key))  # day/month/year where only that reading is a date
    other_text = F.when(us, F.coalesce(F.date_format(other, "MM/dd/yyyy"), F.date_format(late, "dd/MM/yyyy"))).otherwise(F.date_format(other, "dd.MM.yyyy"))
    slash = r"^(\d+)/(\d+)/(\d+)$"
    year_first = new_day(part(slash, 1), part(slash, 2), part(slash, 3), key)
    # US social security numbers: area 001-899 without 666, group 01-99, serial 0001-9999
    area, group, serial = (part(r"^(\d+)-(\d+)-(\d+)$", i) for i in (1, 2, 3))
    ssn_ok = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    p = feistel_pair(area - 1 - F.when(area > 666, 1).otherwise(0), (group - 1) * 9999 + serial - 1, 898, 989901, key, "ssn")
    ssn = F.transform(F.array(p), lambda x: F.concat_ws("-", F.lpad((x["l"] + 1 + F.when(x["l"] >= 665, 1).otherwise(0)).cast("string"), 3, "0"), F.lpad((F.floor(x["r"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((x["r"] % 9999 + 1).cast("string"), 4, "0")))[0]
    # IPv4: two halves of 16 bits
    octet = [part(r"^(\d+)\.(\d+)\.(\d+)\.(\d+)$", i) for i in (1, 2, 3, 4)]
    ip_ok = (octet[0] < 256) & (octet[1] < 256) & (octet[2] < 256) & (octet[3] < 256)
    q = feistel_pair(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], 65536, 65536, key, "ip")
    ip = F.transform(F.array(q), lambda x: F.concat_ws(".", F.floor(x["l"] / 256), x["l"] % 256, F.floor(x["r"] / 256), x["r"] % 256))[0]
    # cards: Luhn numbers; all digits but the last are permuted, the last follows; what stands around a card in the match stays
    def card_of(s: Column) -> Column:
        payload = feistel_text(F.substr(only(s, "0-9"), F.lit(1), F.length(only(s, "0-9")) - 1), DIGITS, key)
        return F.transform(F.array(payload), lambda x: refill(s, "0-9", F.concat(x, ((10 - luhn_sum(x, 0) % 10) % 10).cast("string"))))[0]
    spans = F.when(whole["card"], card_spans(m))
    card = F.aggregate(spans, F.struct(F.lit("").alias("o"), F.lit(1).alias("at")), lambda a, x: F.struct(
        F.concat(a["o"], F.substr(m, a["at"], x["s"] - a["at"]), card_of(F.substr(m, x["s"], x["e"] - x["s"] + 1))).alias("o"), (x["e"] + 1).alias("at")), lambda a: F.concat(a["o"], F.substr(m, a["at"])))
    # phones: the country code stays
    code = F.regexp_extract(m, r"^\+\d{1,3}(?=[ .(-])", 0)
    rest = F.substr(m, F.length(code) + 1)
    phone = F.concat(code, refill(rest, "0-9", feistel_text(only(rest, "0-9"), DIGITS, key)))
    phone_ok = F.length(digits).between(7, 15)
    card_ok = F.size(spans) > 0
    cases = [("email", whole["email"], mail), ("iban", whole["iban"] & iban_ok, iban), ("date", whole["iso_date"] & iso.isNotNull(), F.date_format(iso, "yyyy-MM-dd")), ("date", whole["year_first"] & year_first.isNotNull(), F.date_format(year_first, "yyyy/MM/dd")), ("date", whole["date"] & other_text.isNotNull(), other_text),
             ("ssn", whole["ssn"] & ssn_ok, ssn), ("ip", whole["ip"] & ip_ok, ip), ("card", whole["card"] & card_ok, card), ("phone", (whole["phone"] | whole["blank_phone"]) & phone_ok, phone)]
    kind, new = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, test, value in reversed(cases):
        kind, new = F.when(test, F.lit(name)).otherwise(kind), F.when(test, value).otherwise(new)
    return kind, new, F.when(kind == "card", F.size(spans)).otherwise(1)


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Replace personal data in every whole text by keyed pseudonyms of the same format.

    E-mail addresses, IBANs (mod 97), dates, US social security numbers, IPv4 addresses, phone numbers and payment cards (Luhn) are found by
    shape and validated; what does not validate stays. A Feistel network with ``key`` permutes each kind within its valid values, so equal values
    get equal pseudonyms in every document, different ones different, and numbers keep their separators and check digits.
    E-mail case is folded. Adds ``n_pii`` long and ``pii_kinds`` (sorted distinct kinds) and replaces the text column; a clashing
    column keeps its name and the new one gets an underscore. Null texts stay null with 0. All work is inside the row: no shuffle,
    nothing to skew; one output row per input row, repeated or not.
    """
    n_pii, kinds, found, parts, done = fresh(docs, "n_pii", "pii_kinds", "_found", "_parts", "_done")
    t = F.col(text)
    # a text without a digit or an at-sign cannot hold any of the shapes
    df = docs.withColumn(found, F.when(t.rlike("[0-9@]"), F.regexp_extract_all(t, F.lit(ANY), F.lit(0))))
    df = df.withColumn(parts, F.when(F.size(found) > 0, F.split(t, ANY, -1)))

    def replaced(m: Column) -> Column:
        kind, new, n = pseudonym(m, key)
        return F.struct(kind.alias("kind"), F.coalesce(new, m).alias("new"), n.alias("n"))

    df = df.withColumn(done, F.transform(found, replaced))
    good = F.filter(done, lambda x: x["kind"].isNotNull())
    df = df.withColumn(n_pii, F.coalesce(F.aggregate(good, F.lit(0), lambda a, x: a + x["n"]), F.lit(0)).cast("long"))
    df = df.withColumn(kinds, F.coalesce(F.sort_array(F.array_distinct(F.transform(good, lambda x: x["kind"]))), F.array().cast("array<string>")))
    joined = F.array_join(F.zip_with(parts, F.transform(done, lambda x: x["new"]), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return df.withColumn(text, F.when(F.size(found) > 0, joined).otherwise(t)).drop(found, parts, done)
