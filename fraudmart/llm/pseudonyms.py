"""Format-preserving pseudonyms for personal data, DataFrame functions only.

Validated numbers, dates, addresses and keys are permuted within their own
format by a keyed Feistel network, so equal values get equal pseudonyms in all
documents, nothing is looked up, and the key's owner can undo it.

A value becomes an array of symbols, each with its own radix; the network adds,
round by round, a keyed SHA-256 of one half to the other half, symbol by symbol
and modulo the radix. That is a permutation of the format's whole domain:

- card (Luhn valid, 13 to 19 digits): first digit stays, the check digit is
  made anew;
- IBAN (mod 97 valid): country stays, check digits are made anew;
- SSN: valid areas, groups and serials only;
- date (``2021-03-09``, ``9.3.2021``, ``3/9/2021``): days of 1800 to 2199,
  written as it was;
- IPv4: octets;
- phone: the digits after the country code;
- e-mail: letters and digits of the local part; the domain stays;
- access keys, passwords after ``password=`` (in any case), long hexadecimal keys:
  their letters and digits. A hexadecimal key has the same pseudonym in upper and
  lower case, each in its case; a key in mixed case keeps the case and the digits' places.

A number that fails its format's check is no such value and stays. Digits next to a
card (an expiry date, a year, a quantity) do not hide it: every run of its groups in a
usual grouping is checked. An IBAN is as long as its country says. All kinds
are found in one pass, so a pseudonym is never taken for a value again.

Null text stays null, no value: the text stays as it is. Null ids, repeated
rows and other columns pass through; columns named like the results are
replaced. A row is handled alone: no shuffle, whatever is common or frequent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels and their number are bounded as in host names: an open repeat of a group
#: would go one level deeper into the stack for each label.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
PASSWORD = r"(?<=(?i:password)=)[^\s\"']*[A-Za-z0-9]"  # without the punctuation after it
HEX_KEY = r"(?<![A-Za-z0-9])(?=[A-Fa-f]*+[0-9])[0-9a-fA-F]{32,128}(?![A-Za-z0-9])"
#: Characters of an IBAN by country; other countries' IBANs are as long as they fit.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
                21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
                24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM",
                28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
                32: "LC", 33: "RU"}
_OWN_LENGTH = "|".join(f"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
                       + (f" ?[A-Z0-9]{{{(n - 4) % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items())
IBAN = (rf"(?<![A-Za-z0-9])(?:{_OWN_LENGTH}|(?!{'|'.join(' '.join(IBAN_LENGTHS.values()).split())})"
        r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
DATE = (r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
        r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9]|[./-][0-9])")
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
PHONE = (r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{1,4}(?:[ .-]?[0-9]{2,4}){1,4}"
         r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9A-Za-z])")
#: In this order; the first that fits a place takes it.
KINDS = {"email": EMAIL, "access_key": ACCESS_KEY, "password": PASSWORD, "hex_key": HEX_KEY, "iban": IBAN,
         "ssn": SSN, "date": DATE, "ipv4": IPV4, "card": CARD, "phone": PHONE}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: Digits that go on with single blanks or hyphens, and the groupings of cards in them.
DIGIT_RUN = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}+"
CARD_FORMS = (r"^[2-6](?:[0-9]{12,18}|[0-9]{3}(?: [0-9]{4}){3}(?: [0-9]{1,3})?|[0-9]{3}(?:-[0-9]{4}){3}(?:-[0-9]{1,3})?"
              r"|[0-9]{3} [0-9]{6} [0-9]{4,5}|[0-9]{3}-[0-9]{6}-[0-9]{4,5})$")
ROUNDS = 10
#: 400 Gregorian years from 1800-01-01: 146097 days = 189 x 773.
FIRST_DAY, DAY_RADICES = "1800-01-01", (189, 773)


def feistel(values: Column, radices: Column, key: str, kind: str, undo: bool = False) -> Column:
    """Permute an array of symbols within their radices."""
    half = F.floor(F.size(values) / 2).cast("int")
    rounds = [F.lit(i) for i in (range(ROUNDS - 1, -1, -1) if undo else range(ROUNDS))]

    def turn(acc: Column, i: Column) -> Column:
        left = i % 2 == 0
        other = F.when(left, F.slice(acc, half + 1, F.size(acc) - half)).otherwise(F.slice(acc, F.lit(1), half))
        seed = F.concat_ws(":", F.lit(key), F.lit(kind), i, F.array_join(other, ","))

        def symbol(x: Column, j: Column) -> Column:
            digest = F.sha2(F.concat_ws(":", seed, j).cast("binary"), 256)
            add = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
            moved = F.pmod(x - add if undo else x + add, F.get(radices, j).cast("long")).cast("int")
            return F.when((j < half) == left, moved).otherwise(x)

        return F.transform(acc, symbol)

    return F.aggregate(F.array(*rounds), values, turn)


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _letters(s: Column, key: str, kind: str, undo: bool, hexa: bool = False) -> Column:
    """Permute letters and digits of a text, each within its class."""
    if hexa:
        values = F.transform(_chars(s), lambda c: F.conv(c, 16, 10).cast("int"))
        out = feistel(values, F.transform(_chars(s), lambda c: F.lit(16)), key, kind, undo)
        made = F.array_join(F.transform(out, lambda v: F.lower(F.hex(v))), "")
        return F.when(s.rlike("[A-F]"), F.upper(made)).otherwise(made)

    letters = 6 if kind == "mixed_hex_key" else 26

    def base(c: Column) -> Column:
        return (F.when(c.between("0", "9"), F.ascii(F.lit("0"))).when(c.between("a", "z"), F.ascii(F.lit("a")))
                .when(c.between("A", "Z"), F.ascii(F.lit("A"))))

    def radix(c: Column) -> Column:
        return F.when(c.between("0", "9"), 10).when(c.between("a", "z") | c.between("A", "Z"), letters).otherwise(1)

    values = F.transform(_chars(s), lambda c: F.coalesce(F.ascii(c) - base(c), F.lit(0)))
    out = feistel(values, F.transform(_chars(s), radix), key, kind, undo)
    return F.array_join(F.zip_with(out, _chars(s), lambda v, c: F.coalesce(F.char(base(c) + v), c)), "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of digits whose last one counts double (the check digit is
    not among them)."""
    values = F.transform(F.reverse(_chars(digits)), lambda c, i: F.when(
        i % 2 == 0, F.when(2 * c.cast("int") > 9, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int")))
        .otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _check_digit(digits: Column) -> Column:
    return ((10 - _luhn_sum(digits) % 10) % 10).cast("string")


def _fill(template: Column, digits: Column) -> Column:
    """Put digits into the places of the digits of ``template``."""
    zero = F.struct(F.lit("").alias("s"), F.lit(1).alias("at"))
    return F.aggregate(
        _chars(template), zero,
        lambda a, c: F.when(c.between("0", "9"), F.struct(F.concat(a["s"], F.substr(digits, a["at"], F.lit(1))).alias("s"),
                                                         (a["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["at"].alias("at"))),
        lambda a: a["s"])


def _card(m: Column, key: str, undo: bool) -> Column:
    d = _digits(m)
    n = F.length(d)
    body = F.substr(d, F.lit(1), n - 1)
    valid = _check_digit(body) == F.substr(d, n, F.lit(1))
    inner = _letters(F.substr(d, F.lit(2), n - 2), key, "card", undo)
    made = F.concat(F.substr(d, F.lit(1), F.lit(1)), inner)
    return F.when(valid, _fill(m, F.concat(made, _check_digit(made))))


def _cards(text: Column) -> Column:
    """The valid cards among the groups of the text's digit runs, 16 digits first."""

    def spans(chain: Column) -> Column:
        group = F.split(chain, "[ -]")
        ends = F.aggregate(group, F.array(F.lit(0)), lambda acc, g: F.concat(
            acc, F.array(F.element_at(acc, -1) + F.length(g) + 1)))
        every = F.flatten(F.transform(F.array(F.struct(ends.alias("e"))), lambda v: F.flatten(F.transform(
            F.sequence(F.lit(0), F.size(v["e"]) - 2), lambda i: F.transform(
                F.sequence(i + 1, F.least(i + 5, F.size(v["e"]) - 1)), lambda j: F.substr(
                    chain, F.get(v["e"], i) + 1, F.get(v["e"], j) - F.get(v["e"], i) - 1))))))

        def valid(c: Column) -> Column:
            d = _digits(c)
            total = (_luhn_sum(F.substr(d, F.lit(1), F.length(d) - 1)) + F.substr(d, F.length(d), F.lit(1)).cast("int"))
            return F.when(c.rlike(CARD_FORMS), total % 10 == 0).otherwise(False)

        good = F.filter(every, valid)
        # years and numbers before a card begin with 2 more often than cards do
        return F.transform(F.array(good), lambda g: F.filter(g, lambda c: (F.substr(c, F.lit(1), F.lit(1)) != "2")
                                                             | ~F.exists(g, lambda o: F.substr(o, F.lit(1), F.lit(1)) != "2")))

    found = F.flatten(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(DIGIT_RUN), F.lit(0)), spans)))
    ranked = F.array_sort(F.array_distinct(F.transform(found, lambda c: F.struct(
        F.abs(F.length(_digits(c)) - 16).alias("n"), c.alias("c")))))
    return F.transform(ranked, lambda v: v["c"])


def _pattern(text: Column) -> Column:
    """``ANY``, where valid cards stop other digits from running into them."""
    cards = F.array_join(_cards(text), "|")
    before, after = (F.lit(x) for x in ANY.split(f"(?:{CARD})"))
    return F.transform(F.array(cards), lambda c: F.when(c == "", F.lit(ANY)).otherwise(F.concat(
        before, F.lit("(?:(?<![0-9])(?:"), c, F.lit(")(?![0-9])|(?<![0-9-])[0-9](?:(?![ -]?(?:"), c,
        F.lit(")(?![0-9]))[ -]?[0-9]){12,18}(?![0-9]))"), after)))[0]


def _mod97(s: Column) -> Column:
    digits = F.array_join(F.transform(_chars(s), lambda c: F.when(
        c.between("0", "9"), c).otherwise((F.ascii(c) - 55).cast("string"))), "")
    return F.aggregate(_chars(digits), F.lit(0), lambda a, c: (a * 10 + c.cast("int")) % 97)


def _iban(m: Column, key: str, undo: bool) -> Column:
    s = F.replace(m, F.lit(" "), F.lit(""))
    country, body = F.substr(s, F.lit(1), F.lit(2)), F.substr(s, F.lit(5))
    valid = (_mod97(F.concat(body, country, F.substr(s, F.lit(3), F.lit(2)))) == 1) & F.length(s).between(15, 34)
    made = _letters(body, key, "iban", undo)
    check = F.lpad((98 - _mod97(F.concat(made, country, F.lit("00")))).cast("string"), 2, "0")
    new = F.concat(country, check, made)
    spaced = F.aggregate(_chars(m), F.struct(F.lit("").alias("s"), F.lit(1).alias("at")), lambda a, c: F.when(
        c == " ", F.struct(F.concat(a["s"], c).alias("s"), a["at"].alias("at"))).otherwise(
        F.struct(F.concat(a["s"], F.substr(new, a["at"], F.lit(1))).alias("s"), (a["at"] + 1).alias("at"))),
        lambda a: a["s"])
    return F.when(valid, spaced)


def _ssn(m: Column, key: str, undo: bool) -> Column:
    area, group, serial = (F.get(F.split(m, "-"), i).cast("int") for i in range(3))
    valid = (area != 666) & area.between(1, 899) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    out = feistel(F.array(place, group - 1, serial - 1), F.array(F.lit(898), F.lit(99), F.lit(9999)), key, "ssn", undo)
    new_area = F.when(F.get(out, 0) >= 665, F.get(out, 0) + 2).otherwise(F.get(out, 0) + 1)
    return F.when(valid, F.concat(F.lpad(new_area.cast("string"), 3, "0"), F.lit("-"),
                                  F.lpad((F.get(out, 1) + 1).cast("string"), 2, "0"), F.lit("-"),
                                  F.lpad((F.get(out, 2) + 1).cast("string"), 4, "0")))


def _date(m: Column, key: str, undo: bool) -> Column:
    mark = F.when(m.contains("-"), "-").when(m.contains("/"), "/").otherwise(".")
    part = F.split(m, "[-/.]")
    a, b, c = (F.get(part, i).cast("int") for i in range(3))

    def made(y: Column, mo: Column, d: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), F.lpad(mo.cast("string"), 2, "0"),
                                         F.lpad(d.cast("string"), 2, "0")), "yyyy-MM-dd")

    day = (F.when(mark == "-", made(a, b, c)).when(mark == ".", made(c, b, a))
           .otherwise(F.coalesce(made(c, a, b), made(c, b, a))))
    month_first = (mark == "/") & made(c, a, b).isNotNull()
    index = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    size = DAY_RADICES[0] * DAY_RADICES[1]
    out = feistel(F.array((index / DAY_RADICES[1]).cast("int"), index % DAY_RADICES[1]),
                  F.array(*[F.lit(r) for r in DAY_RADICES]), key, "date", undo)
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(out, 0) * DAY_RADICES[1] + F.get(out, 1))

    def field(number: Column, at: int) -> Column:
        return F.when(F.length(F.get(part, at)) == 2, F.lpad(number.cast("string"), 2, "0")).otherwise(
            number.cast("string"))

    written = (F.when(mark == "-", F.date_format(new, "yyyy-MM-dd"))
               .when(month_first, F.concat(field(F.month(new), 0), mark, field(F.dayofmonth(new), 1), mark,
                                           F.year(new).cast("string")))
               .otherwise(F.concat(field(F.dayofmonth(new), 0), mark, field(F.month(new), 1), mark,
                                F.year(new).cast("string"))))
    return F.when(day.isNotNull() & index.between(0, size - 1), written)


def _ipv4(m: Column, key: str, undo: bool) -> Column:
    octets = F.transform(F.split(m, "\\."), lambda x: x.cast("int"))
    out = feistel(octets, F.array(*[F.lit(256)] * 4), key, "ipv4", undo)
    return F.when(F.array_max(octets) <= 255, F.array_join(out, "."))


def _phone(m: Column, key: str, undo: bool) -> Column:
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    code = F.when(code == "", F.regexp_extract(m, r"^\+[0-9]{1}", 0)).otherwise(code)
    rest = F.substr(m, F.length(code) + 1)
    return F.when(F.length(_digits(m)).between(7, 15), F.concat(code, _letters(rest, key, "phone", undo)))


def _email(m: Column, key: str, undo: bool) -> Column:
    local = F.substring_index(m, "@", 1)
    return F.concat(_letters(local, key, "email", undo), F.substr(m, F.length(local) + 1))


def pseudonym(m: Column, key: str, undo: bool = False) -> tuple[Column, Column]:
    """(kind, pseudonym) of a matched value; nulls if no kind's check holds."""
    fits = {k: m.rlike(f"^(?:{p})$") for k, p in KINDS.items()}
    fits["password"] = ~F.lit(False)  # reached last: what no other pattern takes follows "password="
    made = {
        "email": _email(m, key, undo),
        "access_key": F.concat(F.substr(m, F.lit(1), F.lit(4)), _letters(F.substr(m, F.lit(5)), key, "access_key", undo)),
        "hex_key": F.when(m.rlike("[a-f]") & m.rlike("[A-F]"), _letters(m, key, "mixed_hex_key", undo))
        .otherwise(_letters(m, key, "hex_key", undo, hexa=True)),
        "iban": _iban(m, key, undo), "ssn": _ssn(m, key, undo), "date": _date(m, key, undo),
        "ipv4": _ipv4(m, key, undo), "card": _card(m, key, undo), "phone": _phone(m, key, undo),
        "password": _letters(m, key, "password", undo),
    }
    kind, value = None, None
    for k, v in made.items():
        kind = F.when(fits[k], k) if kind is None else kind.when(fits[k], k)
        value = F.when(fits[k], v) if value is None else value.when(fits[k], v)
    return kind, value


def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with the text rewritten, ``n_replaced`` and ``replaced``: an array of
    (kind, pseudonym) in text order. ``undo`` maps pseudonyms back."""
    made = ["n_replaced", "replaced"]
    keep = [c for c in docs.columns if c not in made]
    t = F.col(f"`{text_col}`")
    some = t.rlike("[0-9@]|(?i:password)=")
    d = docs.select(*[F.col(f"`{c}`") for c in keep],
                    F.when(t.rlike(DIGIT_RUN), _pattern(t)).otherwise(F.lit(ANY)).alias("_any"))
    d = d.select("*", F.when(some, F.regexp_extract_all(t, F.col("_any"), F.lit(0)))
                 .otherwise(F.array().cast("array<string>")).alias("_found"))

    def changed(m: Column) -> Column:
        kind, value = pseudonym(m, key, undo)
        return F.struct(m.alias("was"), kind.alias("kind"), value.alias("pseudonym"))

    d = d.withColumn("_made", F.transform("_found", changed))
    pieces = F.split(t, F.col("_any"))
    text = F.concat(F.get(pieces, 0), F.array_join(F.zip_with(
        "_made", F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda v, p: F.concat(F.coalesce(v["pseudonym"], v["was"]), p)), ""))
    done = F.filter("_made", lambda v: v["pseudonym"].isNotNull())
    return d.select(
        *[F.when(F.size("_found") > 0, text).otherwise(t).alias(c) if c == text_col else F.col(f"`{c}`") for c in keep],
        F.when(t.isNull(), 0).otherwise(F.size(done)).alias("n_replaced"),
        F.transform(done, lambda v: F.struct(v["kind"].alias("kind"), v["pseudonym"].alias("pseudonym"))).alias("replaced"))
