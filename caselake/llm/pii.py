"""Personal data under format-preserving pseudonyms, from DataFrame functions only.

Numbers and dates that pass validation are replaced by a keyed Feistel
permutation of their own format: a card number becomes another card number with
a right check digit, an address another address, a date another date. The
permutation depends on key, kind and length alone, so equal values get equal
pseudonyms in all documents, different values never collide, and the holder of
the key can go back; the key has no default. E-mail addresses, which have no fixed format, get a keyed
hash as local part.

A network has two halves (x modulo p, y modulo q) and adds a keyed round value
of one half to the other in turn; every round can be undone, so the whole is a
bijection of the p*q values without cycle walking.

Layouts: phones with "+" and country code in groups or as one number, North
American numbers in groups of 3-3-4 with or without "1" or parentheses, and
numbers in three groups after a trunk 0; dates of digits with the year first or
last, separated by "-", "/" or "."; cards of 13 to 19 digits, as 4-4-4-4 or as
4-6-5. Where day and month could be either, "/" puts the month first, "." and
"-" the day; dates that only the other order reads stay among those. A date
without leading zeros gets a pseudonym without them.

Defined results: a null text stays null; numbers that fail validation (check
digit, octet, calendar) stay as they are; texts without personal data come back
unchanged; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.common import packed, table, text_or_empty

ROUNDS = 10
#: Dates from 1900-01-01 on; 73,049 days (to 2099-12-31) are 17 * 4297.
FIRST_DAY, DAY_MODULI = "1900-01-01", (17, 4297)
IPV4_MODULI = (65536, 65536)
#: North American numbers: areas and offices from 200 on, four digits each of the line.
NANP_MODULI = (800, 800 * 10_000)
#: Steps of a walk that stays among dates after the 12th; it takes two on average.
_WALK = 64
_PLUS = (r"\+[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])|(?<![0-9+])\+(?:[0-9]{8,15}|"
         r"[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-][0-9]{2,4}){1,4})(?![0-9])")
_NANP = (r"(?:1[ .-]?)?\([2-9][0-9]{2}\)[ .-]?[2-9][0-9]{2}[ .-][0-9]{4}|"
         r"(?:1[ .-])?[2-9][0-9]{2}(?:-[2-9][0-9]{2}-|\.[2-9][0-9]{2}\.| [2-9][0-9]{2}[ -])[0-9]{4}")
_TRUNK = "0[0-9]{1,4}(?: [0-9]{3,4} |-[0-9]{3,4}-)[0-9]{3,4}"
_ISO = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_YEAR_FIRST = r"[0-9]{4}(?:/[0-9]{2}/|\.[0-9]{2}\.)[0-9]{2}"
_YEAR_LAST = r"[0-9]{1,2}(?:/[0-9]{1,2}/|\.[0-9]{1,2}\.|-[0-9]{1,2}-)[0-9]{4}"
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "phone": rf"{_PLUS}|(?<![0-9A-Za-z])(?<![0-9][.-])(?:{_NANP})(?![0-9]|[.-][0-9])|"
             rf"(?<![0-9A-Za-z])(?<![0-9][ .-])(?:{_TRUNK})(?![0-9]|[ -][0-9]{{4}}(?![0-9]))",
    "ipv4": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": rf"(?<![0-9-]){_ISO}(?![0-9-])|(?<![0-9/.-])(?:{_YEAR_FIRST}|{_YEAR_LAST})(?![0-9]|[/.-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9A-Za-z])(?<![0-9][.-])(?:[0-9]{13,19}|(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
}
#: Numbers begin with a digit, a plus sign or a parenthesis, which is tried before anything else; texts without "@" need no more.
NUMERIC = "(?=[0-9+(])(?:" + "|".join(p for k, p in KINDS.items() if k != "email") + ")"
PATTERN = KINDS["email"] + "|" + NUMERIC


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def round_value(key: str, label: Column, number: Column, half: Column) -> Column:
    """60 keyed pseudorandom bits."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), label, number.cast("string"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(x: Column, y: Column, p: Column, q: Column, label: Column, key: str, back: bool = False) -> Column:
    """Struct (x, y) permuted; ``back`` undoes it. ``label`` separates kinds and lengths."""
    rounds = F.array(*[F.lit(r) for r in (reversed(range(ROUNDS)) if back else range(ROUNDS))])
    sign = -1 if back else 1

    def step(acc: Column, r: Column) -> Column:
        even = r % 2 == 0
        value = round_value(key, label, r, F.when(even, acc["y"]).otherwise(acc["x"]))
        return F.struct(F.when(even, F.pmod(acc["x"] + sign * (value % p), p)).otherwise(acc["x"]).alias("x"),
                        F.when(even, acc["y"]).otherwise(F.pmod(acc["y"] + sign * (value % q), q)).alias("y"))

    return F.aggregate(rounds, F.struct(x.cast("long").alias("x"), y.cast("long").alias("y")), step)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ten_to(n: Column) -> Column:
    return F.pow(F.lit(10), n).cast("long")


def permute_digits(digits: Column, label: str, key: str, back: bool = False) -> Column:
    """Another string of as many digits."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    right = n - left
    halves = feistel(F.substring(digits, F.lit(1), left), F.substring(digits, left + 1, right),
                     _ten_to(left), _ten_to(right), F.concat(F.lit(label), n.cast("string")), key, back)
    return let(halves, lambda half: F.concat(
        F.lpad(half["x"].cast("string"), left, F.lit("0")), F.lpad(half["y"].cast("string"), right, F.lit("0"))))


def _luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """Sum of digits where every second one, from the given place from the right, is doubled."""
    def part(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((F.length(digits) - 1 - i) % 2 == doubled_from_right, twice).otherwise(d)

    return F.aggregate(F.transform(F.split(digits, ""), part), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits, 1) % 10 == 0


def refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""
    def fill(new: Column) -> Column:
        def put(c: Column, i: Column) -> Column:
            before = F.length(digits_of(F.substring(shape, F.lit(1), i + 1)))
            return F.when(c.rlike("[0-9]"), F.substring(new, before, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(F.split(shape, ""), put), "")

    return let(digits, fill)


def _month_first(value: Column, other: bool = False) -> Column:
    """Whether a date with the year last has the month first: with "/", in the ``other`` order with "." and "-"."""
    return value.contains("/") != F.lit(other)


def _date(value: Column, other: bool = False) -> Column:
    """The date, NULL outside the calendar or the years; ``other``: with the year last, day and month change places."""
    parts = F.split(value, "[/.-]")
    two = lambda i: F.lpad(F.get(parts, i), 2, "0")
    last = F.when(_month_first(value, other), F.concat_ws("-", F.get(parts, 2), two(0), two(1))).otherwise(
        F.concat_ws("-", F.get(parts, 2), two(1), two(0)))
    ymd = F.length(F.get(parts, 0)) == 4
    day = F.try_to_date(F.when(ymd, F.concat_ws("-", parts)).otherwise(last), "yyyy-MM-dd")
    return F.when(day.between(FIRST_DAY, "2099-12-31") & ~(ymd & F.lit(other)), day)


def _permute_date(value: Column, key: str, back: bool) -> Column:
    """Another date of the same layout and the same reading."""
    a, b = DAY_MODULI
    first = F.lit(FIRST_DAY).cast("date")

    def moved(day: Column) -> Column:
        at = feistel(F.floor(day / b), day % b, F.lit(a), F.lit(b), F.lit("date"), key, back)
        return let(at, lambda m: m["x"] * b + m["y"])

    def late(day: Column) -> Column:
        return F.dayofmonth(F.date_add(first, day.cast("int"))) > 12

    def written(day: Column) -> Column:
        date = F.date_add(first, day.cast("int"))
        short = value.rlike("^[0-9][^0-9]|[^0-9][0-9][^0-9]")
        month, dom = (F.when(short, F.date_format(date, c)).otherwise(F.date_format(date, 2 * c)) for c in "Md")
        month_first = F.when(_date(value).isNotNull(), _month_first(value)).otherwise(_month_first(value, other=True))
        year = F.date_format(date, "yyyy")
        new = (F.when(value.rlike("^[0-9]{4}"), F.concat_ws("-", year, month, dom))
               .when(month_first, F.concat_ws("-", month, dom, year)).otherwise(F.concat_ws("-", dom, month, year)))
        return F.replace(new, F.lit("-"), F.regexp_extract(value, "[/.-]", 0))

    own = F.datediff(_date(value), first).cast("long")
    # Read in the other order only: the walk goes on until a date that, too, is read so.
    other = F.datediff(_date(value, other=True), first).cast("long")
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), moved(other),
                       lambda day, _: F.when(late(day), day).otherwise(moved(day)))
    return let(F.when(own.isNotNull(), moved(own)).otherwise(walk), written)


def _permute_nanp(digits: Column, key: str, back: bool) -> Column:
    """A North American number, with or without the leading 1, whose area and office begin with 2 to 9 again."""
    n = F.length(digits)
    area, rest = F.substring(digits, n - 9, F.lit(3)).cast("long"), F.substring(digits, n - 6, F.lit(7)).cast("long")
    p, q = NANP_MODULI
    at = feistel(area - 200, rest - 2_000_000, F.lit(p), F.lit(q), F.lit("nanp"), key, back)
    return let(at, lambda m: F.concat(F.substring(digits, F.lit(1), n - 10), (m["x"] + 200).cast("string"),
                                      (m["y"] + 2_000_000).cast("string")))


def kind_of(value: Column) -> Column:
    """Kind of a match that passes validation, else NULL."""
    digits = digits_of(value)
    octets = F.forall(F.split(value, r"\."), lambda o: o.cast("int") <= 255)
    return (
        F.when(F.instr(value, "@") > 0, "email")
        .when(value.startswith("+"), F.when(F.length(digits) >= 8, "phone"))
        .when(value.rlike(f"^(?:{_NANP}|{_TRUNK})$"), "phone")
        .when(value.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), F.when(octets, "ipv4"))
        .when(value.rlike(f"^(?:{_ISO}|{_YEAR_FIRST}|{_YEAR_LAST})$"),
              F.when(F.coalesce(_date(value), _date(value, other=True)).isNotNull(), "date"))
        .when(value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
              F.when(~value.rlike("^(000|666|9..)|-00-|0000$"), "ssn"))
        .otherwise(F.when(let(digits, luhn_valid), "card")))


def pseudonym(value: Column, kind: Column, key: str, back: bool = False) -> Column:
    """Replacement of a validated value; ``back`` returns the clear value (e-mails excepted)."""
    digits = digits_of(value)
    payload = F.substring(digits, F.lit(1), F.length(digits) - 1)
    card = let(permute_digits(payload, "card", key, back), lambda moved: F.concat(
        moved, F.pmod(F.lit(10) - _luhn_sum(moved, 0) % 10, F.lit(10)).cast("string")))
    country = F.length(F.regexp_extract(value, r"^\+([0-9]+)", 1))  # of a number written as one: its first digit
    fixed = F.when(country > 3, 1).when(country > 0, country).otherwise(1)
    phone = F.when(value.rlike(f"^(?:{_NANP})$"), _permute_nanp(digits, key, back)).otherwise(F.concat(
        F.substring(digits, F.lit(1), fixed), permute_digits(F.substring(digits, fixed + 1, F.length(digits)), "phone", key, back)))
    octet = F.transform(F.split(value, r"\."), lambda o: o.cast("long"))
    p, q = (F.lit(m) for m in IPV4_MODULI)
    net = feistel(F.get(octet, 0) * 256 + F.get(octet, 1), F.get(octet, 2) * 256 + F.get(octet, 3), p, q, F.lit("ipv4"), key, back)
    ipv4 = let(net, lambda n: F.concat_ws(".", *[F.floor(n[h] / d).cast("long") % 256 for h in ("x", "y") for d in (256, 1)]))
    email = F.concat(F.lit("u"), F.substring(F.sha2(F.concat(F.lit(key + "|email|"), F.lower(value)), 256), 1, 16), F.lit("@example.com"))
    return (F.when(kind == "email", email).when(kind == "phone", refill(value, phone)).when(kind == "ipv4", ipv4)
            .when(kind == "date", _permute_date(value, key, back)).when(kind == "ssn", refill(value, permute_digits(digits, "ssn", key, back)))
            .when(kind == "card", refill(value, card)).otherwise(value))


def _equals(kind: str) -> Callable[[Column], Column]:
    return lambda x: x == kind


def pseudonymize_text(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_<kind>`` counts added (or put in place of columns so named)."""
    names, docs = docs.columns, packed(docs, "text")
    text = text_or_empty()
    mail = F.instr(text, "@") > 0

    def matches(pattern: str) -> Column:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    found = F.when(mail, matches(PATTERN)).when(text.rlike("[0-9]"), matches(NUMERIC))
    df = docs.withColumn("_found", F.coalesce(found, F.array().cast("array<string>")))
    df = df.withColumn("_kinds", F.transform("_found", kind_of))
    df = df.withColumn("_new", F.transform("_found", lambda v, i: pseudonym(v, F.get("_kinds", i), key)))
    pieces = F.when(mail, F.split(text, PATTERN, -1)).otherwise(F.split(text, NUMERIC, -1))
    whole = F.array_join(F.transform(pieces, lambda piece, i: F.concat(piece, F.coalesce(F.get("_new", i), F.lit("")))), "")
    counts = {f"n_{k}": F.size(F.filter("_kinds", _equals(k))).cast("long") for k in KINDS}
    new = F.when(F.size("_found") > 0, whole).otherwise(F.col("text")).alias("text")
    rest = [new if c == "text" else F.col(f"_row.`{c}`") for c in names if c not in counts]
    return df.select(*rest, *[n.alias(c) for c, n in counts.items()])


#: Key of the query alone, so that its rows are the same in every session; data of one's own need a secret key.
QUERY_KEY = "pii-key"


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize_text(docs, QUERY_KEY).select("doc_id", "text", *[f"n_{k}" for k in KINDS])
