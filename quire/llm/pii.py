"""Format-preserving pseudonyms by keyed Feistel permutations, in column expressions.

Personal numbers are found by one pattern, validated, and permuted within their format,
so the text keeps its shape, a number of a kind stays a valid one of that kind, and equal
values have equal pseudonyms in every document, however they are punctuated.

A value is a pair (x, y) of numbers below (a, b), and a Feistel round adds a keyed hash
of one half to the other, modulo its bound; so every domain of a * b values is permuted
in itself, without walking in cycles:

    kind     validated by                  permuted domain
    card     groups, length, Luhn digit    digits but the first and the check digit
    iban     country's length, modulo 97   digits of the account; check digits follow
    ssn      area, group, serial ranges    898 areas x 99 groups x 9999 serials
    phone    7 to 15 digits                800 areas x 800 exchanges x 10,000 lines (+1),
                                           else digits but the first two
    ip       four numbers up to 255        65,536 x 65,536
    date     a day from 1420 to 2619       the 146,097 days of its 400-year cycle
    email    shape                         letters and digits, each within its class
    secret   shape                         letters and digits, each within its class

The last two permute a string's halves in turn: each letter or digit is shifted in its
own class by a keyed hash of the other half. A match that fails validation is searched
again from each of its groups on; what fails there too stays as it is.

The key is a parameter; it is part of the query plan, so plans and logs of a run with a
real key must be protected like the key.

Nulls: a null text stays null, with zero counts. Repeated rows are treated alike. An empty
table gives no rows. Further columns pass through ``pseudonymise``; there the only columns
set are ``text`` and ``pii_counts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import let

KINDS = ("email", "secret", "iban", "ip", "date", "ssn", "phone", "card")
ROUNDS = 8

# One alternative a kind. Quantifiers that could try again are possessive or bounded and
# each start is anchored, so the search is linear in the text.
EMAIL = r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
SECRET = (r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)"
          r"|(?<!\w)(?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9/+_-]{6,}+")
# Grouped numbers are taken as whole runs of groups, whatever follows the number itself;
# ``resolved`` finds the numbers in a run. A group that begins a date, an address or a
# number of another shape is not part of the run.
NO_DATE = r"(?![/-]\d\d?[/-]\d\d?(?!\d))"
NO_HEAD = r"(?![/.-]\d|@)"
IBAN = (r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}"
        rf"(?:[ -][A-Z0-9]{{4}}{NO_DATE}(?![\w.%+-]{{0,64}}+@))*"
        rf"(?:[ -]\d{{6}}[ -]\d{{4,5}}| ?[A-Z0-9]{{1,3}}{NO_HEAD})?(?!\w)")
IP = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
# an ISO date may be the head of a timestamp
DATE = (r"(?<![\w./-])(?:\d{4}-\d{1,2}-\d{1,2}(?=T\d)|(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}"
        r"|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\w/-]|\.\d))")
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
PHONE = (r"(?<![\w+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\w)"
         r"|(?<![\w+])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-])"
         r"|(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?:[ -]\d{4})*(?!\w)")
CARD = (rf"(?<![\w-])(?:\d{{13,19}}|\d{{4}}(?:[ -]\d{{4}}{NO_DATE}){{2,}}"
        rf"(?:[ -]\d{{6}}[ -]\d{{4,5}}|[ -]\d{{1,3}}{NO_HEAD})?|\d{{4}}[ -]\d{{6}}[ -]\d{{4,5}})(?![\w-])")
SHAPES = dict(zip(KINDS, (EMAIL, SECRET, IBAN, IP, DATE, SSN, PHONE, CARD)))
PATTERN = "|".join(f"(?:{p})" for p in SHAPES.values())
HINT = r"[0-9@]|AKIA|(?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]"
SECRET_HEAD = r"^((?i:password|passwd|secret|token|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?|AKIA)"

CYCLE_START = "1820-01-01"   # days are permuted within 400 years from here
DAYS = ("1420-01-01", "2619-12-31")   # three whole cycles; a date beyond is left alone
CYCLE = 146_097              # days of 400 Gregorian years: 189 * 773
# What a card's groups may be, and the issuers whose cards have 16 digits and no more.
CARD_GROUPS = r"^(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,4}(?:[ -]\d{1,3})?|\d{4}[ -]\d{6}[ -]\d{4,5})$"
SIXTEEN = r"^(?:4|5[1-5]|2[2-7])"
MOST_GROUPS = 9            # an IBAN of 34 characters
# Characters of an IBAN by country; others have 15 to 34.
IBAN_LENGTHS = {n: c.split() for n, c in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}.items()}
IBAN_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def keyed(key: str, tag: str, round_: Column, value: Column) -> Column:
    """A 60-bit hash of the key, the kind, the round and a value."""
    text = F.concat(F.lit(f"{key}|{tag}|"), round_.cast("string"), F.lit("|"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, tag: str) -> Column:
    """The pair (x below a, y below b) permuted: a struct (x, y). Each round the halves
    change places together with their bounds; after an even number they are back."""
    def one(s: Column, i: Column) -> Column:
        return F.struct(s["y"].alias("x"),
                        F.pmod(s["x"] + keyed(key, tag, i, s["y"]), s["a"]).alias("y"),
                        s["b"].alias("a"), s["a"].alias("b"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"),
                     a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, one)


def power10(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10 ** i) for i in range(19)]), n + 1)


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, r"\D", "")


def permute_digits(d: Column, key: str, tag: str) -> Column:
    """A digit string of 2 to 36 digits as another of the same length."""
    def run(s: Column) -> Column:
        u = F.floor(F.length(s) / 2).cast("int")
        v = F.length(s) - u
        x, y = F.substring(s, F.lit(1), u), F.substring(s, u + 1, v)
        # the length is part of the tag: equal values of one kind are equally long
        pair = feistel(x.cast("long"), y.cast("long"), power10(u), power10(v), key, tag)
        return let(pair, lambda p: F.concat(F.lpad(p["x"].cast("string"), u, "0"),
                                            F.lpad(p["y"].cast("string"), v, "0")))
    return F.when(F.length(d) < 2, d).otherwise(let(d, run))


def refill(m: Column, d: Column) -> Column:
    """``m`` with its digits replaced, in order, by those of ``d``."""
    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("[0-9]")
        return F.struct(F.concat(s["out"], F.when(digit, F.substring(d, s["n"], F.lit(1))).otherwise(c)).alias("out"),
                        F.when(digit, s["n"] + 1).otherwise(s["n"]).alias("n"))
    chars = F.filter(F.split(m, ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("n")), step, lambda s: s["out"])


def luhn_sum(d: Column, first_doubled: int) -> Column:
    """Sum of the digits from the right; those at odd distance from ``first_doubled`` are doubled."""
    def value(c: Column, i: Column) -> Column:
        n = c.cast("int")
        twice = 2 * n
        return F.when(i % 2 == first_doubled, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(n)
    chars = F.filter(F.split(F.reverse(d), ""), lambda c: c != "")
    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, x: a + x)


def mod97(text: Column) -> Column:
    """Remainder modulo 97 of a string of digits and capital letters (A is 10)."""
    def step(r: Column, c: Column) -> Column:
        n = F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.instr(F.lit(IBAN_LETTERS), c) + 9)
        return F.pmod(r * F.when(n > 9, 100).otherwise(10) + n, F.lit(97))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def card(m: Column, key: str) -> Column:
    def run(d: Column) -> Column:
        body = F.concat(F.substring(d, 1, 1), permute_digits(F.substring(d, F.lit(2), F.length(d) - 2), key, "card"))
        whole = let(body, lambda b: F.concat(b, ((10 - luhn_sum(b, 0) % 10) % 10).cast("string")))
        return let(whole, lambda w: refill(m, w))
    return let(digits_of(m), run)


def card_valid(m: Column) -> Column:
    return m.rlike(CARD_GROUPS) & let(digits_of(m), lambda d: F.length(d).between(13, 19)
                                      & (luhn_sum(d, 1) % 10 == 0) & (F.substring(d, 1, 1) != "0"))


def iban_plain(m: Column) -> Column:
    return F.regexp_replace(m, " ", "")


def iban_valid(m: Column) -> Column:
    """A known country's length, groups parted by blanks, and the remainder."""
    legal = F.create_map(*[F.lit(x) for n, names in IBAN_LENGTHS.items() for c in names for x in (c, n)])
    return ~m.contains("-") & let(iban_plain(m), lambda s: F.length(s).between(15, 34)
                                  & (F.length(s) == F.coalesce(legal[F.substring(s, 1, 2)], F.length(s)))
                                  & (mod97(F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))) == 1))


def iban(m: Column, key: str) -> Column:
    def run(s: Column) -> Column:
        account = F.substring(s, F.lit(5), F.length(s))
        new = refill(account, permute_digits(digits_of(account), key, "iban"))
        return let(new, lambda n: let(F.concat(
            F.lpad((98 - mod97(F.concat(n, F.substring(s, 1, 2), F.lit("00")))).cast("string"), 2, "0"),
            digits_of(n)), lambda d: refill(m, d)))
    return let(iban_plain(m), run)


def ssn_valid(m: Column) -> Column:
    area = F.substring(m, 1, 3).cast("int")
    return ((area.between(1, 899)) & (area != 666) & (F.substring(m, 5, 2) != "00") & (F.substring(m, 8, 4) != "0000"))


def ssn(m: Column, key: str) -> Column:
    area = F.substring(m, 1, 3).cast("int")
    x = area - 1 - (area > 666).cast("int")
    y = (F.substring(m, 5, 2).cast("int") - 1) * 9999 + F.substring(m, 8, 4).cast("int") - 1

    def write(p: Column) -> Column:
        new = p["x"] + 1 + (p["x"] >= 665).cast("int")
        return F.format_string("%03d-%02d-%04d", new, F.floor(p["y"] / 9999) + 1, p["y"] % 9999 + 1)
    return let(feistel(x, y, F.lit(898), F.lit(99 * 9999), key, "ssn"), write)


def phone(m: Column, key: str) -> Column:
    """American numbers within valid areas and exchanges; others keep two leading digits."""
    def run(d: Column) -> Column:
        ten = F.when((F.length(d) == 11) & d.startswith("1") & m.startswith("+"), F.substring(d, 2, 10)).when(
            (F.length(d) == 10) & ~m.startswith("+"), d)
        new = let(ten, lambda t: F.when(t.rlike("^[2-9][0-9]{2}[2-9]"), let(
            feistel(F.substring(t, 1, 3).cast("int") - 200, F.substring(t, 4, 7).cast("int") - 2_000_000,
                    F.lit(800), F.lit(8_000_000), key, "phone"),
            lambda p: F.format_string("%03d%07d", p["x"] + 200, p["y"] + 2_000_000))))
        other = F.concat(F.substring(d, 1, 2), permute_digits(F.substring(d, F.lit(3), F.length(d)), key, "phone"))
        return let(F.coalesce(F.concat(F.when(F.length(d) == 11, F.lit("1")).otherwise(F.lit("")), new), other),
                   lambda w: refill(m, w))
    return let(digits_of(m), run)


def ip_valid(m: Column) -> Column:
    return F.forall(F.split(m, r"\."), lambda o: o.cast("int") <= 255)


def ip(m: Column, key: str) -> Column:
    def run(o: Column) -> Column:
        n = [F.get(o, i).cast("int") for i in range(4)]
        pair = feistel(n[0] * 256 + n[1], n[2] * 256 + n[3], F.lit(65536), F.lit(65536), key, "ip")
        return let(pair, lambda p: F.concat_ws(".", *[x.cast("string") for x in (
            F.shiftright(p["x"], 8), p["x"] % 256, F.shiftright(p["y"], 8), p["y"] % 256)]))
    return let(F.split(m, r"\."), run)


def day_of(m: Column) -> Column:
    """The date, where it is one; the fields before a year are day and month, or month and
    day where only that is a date."""
    def three(y: Column, mo: Column, d: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")

    def run(f: Column) -> Column:
        a, b, c = (F.get(f, i) for i in range(3))
        return F.when(m.rlike("^[0-9]{4}"), three(a, b, c)).otherwise(F.coalesce(three(c, b, a), three(c, a, b)))
    day = let(F.split(m, "[./-]"), run)
    return let(day, lambda d: F.when(d.between(*[F.to_date(F.lit(x)) for x in DAYS]), d))


def date(m: Column, key: str) -> Column:
    def run(day: Column) -> Column:
        since = F.datediff(day, F.to_date(F.lit(CYCLE_START)))
        place = F.pmod(since, F.lit(CYCLE))
        pair = feistel(F.floor(place / 773), place % 773, F.lit(CYCLE // 773), F.lit(773), key, "date")
        new = let(pair, lambda p: F.date_add(F.to_date(F.lit(CYCLE_START)), (
            since - place + p["x"] * 773 + p["y"]).cast("int")))

        def write(n: Column) -> Column:
            # where a field has one digit, fields are written without leading zeros
            short = m.rlike(r"(?<![0-9])[0-9](?![0-9])")
            y, mo, d = F.date_format(n, "yyyy"), *(F.when(short, F.date_format(n, f)).otherwise(
                F.date_format(n, f * 2)) for f in "Md")
            sep = F.regexp_extract(m, "[./-]", 0)
            return F.when(m.rlike("^[0-9]{4}"), F.concat(y, sep, mo, sep, d)).otherwise(F.concat(d, sep, mo, sep, y))
        return let(new, write)
    return let(day_of(m), run)


def permute_letters(s: Column, key: str, tag: str) -> Column:
    """Letters and digits permuted within their classes, everything else in its place."""
    def shifted(half: Column, other: Column, i: Column) -> Column:
        text = F.array_join(other, "")

        def one(c: Column, at: Column) -> Column:
            move = keyed(key, tag, i, F.concat(at.cast("string"), F.lit("|"), text))
            n = F.ascii(c)

            def within(low: int, size: int) -> Column:
                return F.char((F.lit(low) + F.pmod(n - low + move, F.lit(size))).cast("long"))
            return (F.when(c.rlike("[a-z]"), within(97, 26)).when(c.rlike("[A-Z]"), within(65, 26))
                    .when(c.rlike("[0-9]"), within(48, 10)).otherwise(c))
        return F.transform(half, one)

    def one_round(p: Column, i: Column) -> Column:
        return F.struct(p["y"].alias("x"), shifted(p["x"], p["y"], i).alias("y"))

    def run(chars: Column) -> Column:
        u = F.floor(F.size(chars) / 2).cast("int")
        start = F.struct(F.slice(chars, 1, u).alias("x"), F.slice(chars, u + 1, F.size(chars)).alias("y"))
        return F.aggregate(F.array(*[F.lit(i) for i in range(4)]), start, one_round,
                           lambda p: F.concat(F.array_join(p["x"], ""), F.array_join(p["y"], "")))
    return let(F.filter(F.split(s, ""), lambda c: c != ""), run)


def email(m: Column, key: str) -> Column:
    """All but the last domain label; capitals do not make another address."""
    stem = F.regexp_extract(m, r"^(.*)\.[^.]*$", 1)
    return F.concat(permute_letters(F.lower(stem), key, "email"), F.substring(m, F.length(stem) + 1, F.length(m)))


def secret(m: Column, key: str) -> Column:
    head = F.regexp_extract(m, SECRET_HEAD, 1)
    return F.concat(head, permute_letters(F.substring(m, F.length(head) + 1, F.length(m)), key, "secret"))


def kind_of(m: Column) -> Column:
    """The kind of a match, null where it does not stand validation."""
    def is_(kind: str) -> Column:
        return m.rlike(f"^(?:{SHAPES[kind]})$")
    n_digits = F.length(digits_of(m))
    return (F.when(m.contains("@"), "email").when(is_("secret"), "secret")
            .when(is_("iban"), F.when(iban_valid(m), "iban")).when(is_("ip"), F.when(ip_valid(m), "ip"))
            .when(is_("date"), F.when(day_of(m).isNotNull(), "date"))
            .when(is_("ssn"), F.when(ssn_valid(m), "ssn"))
            .when(is_("phone"), F.when(n_digits.between(7, 15), "phone"))
            .when(is_("card"), F.when(card_valid(m), "card")))


def replaced(m: Column, kind: Column, key: str) -> Column:
    makers = {"email": email, "secret": secret, "iban": iban, "ip": ip, "date": date, "ssn": ssn,
              "phone": phone, "card": card}
    out = F.when(kind == KINDS[0], makers[KINDS[0]](m, key))
    for k in KINDS[1:]:
        out = out.when(kind == k, makers[k](m, key))
    return out.otherwise(m)


def resolved(m: Column, key: str) -> Column:
    """A match as a struct (new, kinds). One that is no number as a whole, or holds a card
    of 16 digits and more, is taken apart: from each group on, the longest row of groups
    that is valid is replaced, and the search goes on behind it."""
    def whole(kind: Column) -> Column:
        return F.struct(replaced(m, kind, key).alias("new"),
                        F.when(kind.isNull(), F.array().cast("array<string>")).otherwise(F.array(kind)).alias("kinds"))

    def apart(groups: Column) -> Column:
        def one(state: Column, i: Column) -> Column:
            def at(n: Column) -> Column:
                row = F.regexp_replace(F.array_join(F.slice(groups, i, n), ""), "[ -]$", "")
                return let(row, lambda r: F.struct(n.alias("n"), r.alias("row"), kind_of(r).alias("kind")))
            most = F.least(F.lit(MOST_GROUPS), F.size(groups) - i + 1)
            valid = F.filter(F.transform(F.sequence(most, F.lit(1), F.lit(-1)), at), lambda c: c["kind"].isNotNull())

            def take(c: Column) -> Column:
                best = F.coalesce(F.get(F.filter(c, lambda v: sixteen(v["row"], v["kind"], "=")), 0), F.get(c, 0))
                return let(best, lambda b: F.when(b.isNull(), F.struct(
                    F.lit(0).alias("skip"), F.concat(state["new"], F.element_at(groups, i)).alias("new"),
                    state["kinds"].alias("kinds"))).otherwise(F.struct(
                        (b["n"] - 1).alias("skip"),
                        F.concat(state["new"], replaced(b["row"], b["kind"], key), F.regexp_extract(
                            F.element_at(groups, (i + b["n"] - 1).cast("int")), "[ -]?$", 0)).alias("new"),
                        F.concat(state["kinds"], F.array(b["kind"])).alias("kinds"))))
            return F.when(state["skip"] > 0, F.struct(
                (state["skip"] - 1).alias("skip"), state["new"].alias("new"), state["kinds"].alias("kinds"))
            ).otherwise(let(valid, take))

        start = F.struct(F.lit(0).alias("skip"), F.lit("").alias("new"), F.array().cast("array<string>").alias("kinds"))
        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, one,
                           lambda s: F.struct(s["new"].alias("new"), s["kinds"].alias("kinds")))

    return let(kind_of(m), lambda kind: F.when(
        (kind.isNull() | sixteen(m, kind, ">")) & m.rlike("[ -]"),
        let(F.split(m, "(?<=[ -])"), apart)).otherwise(whole(kind)))


def sixteen(m: Column, kind: Column, than: str) -> Column:
    """A grouped card of an issuer of 16 digits that has as many, or more."""
    n = F.length(digits_of(m))
    return F.coalesce((kind == "card") & m.rlike(SIXTEEN) & m.rlike("[ -]"), F.lit(False)) & (
        n == 16 if than == "=" else n > 16)


def pseudonymise(docs: DataFrame, key: str, counts: bool = True) -> DataFrame:
    """``docs`` with the text pseudonymised and, with ``counts``, a map from each kind to
    how often it was replaced. Texts without a digit, an at sign or a secret's name are
    passed over; the others are split at the matches and put together again."""
    text = F.col("text")
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    rows = docs.withColumn("__pii_found", found)
    named = F.transform("__pii_found", lambda m: resolved(m, key))
    rows = rows.withColumn("__pii_new", F.when(F.size("__pii_found") > 0, named))
    parts = F.split(text, PATTERN)
    joined = F.array_join(F.zip_with(parts, F.col("__pii_new")["new"],
                                     lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    rows = rows.withColumn("text", F.when(F.col("__pii_new").isNull(), text).otherwise(joined))
    if counts:
        rows = rows.withColumn("__pii_kinds", F.flatten(F.col("__pii_new")["kinds"]))
        rows = rows.withColumn("pii_counts", F.create_map(*[x for k in KINDS for x in (F.lit(k), F.coalesce(
            F.size(F.filter("__pii_kinds", lambda s: s == k)), F.lit(0)))]))
    return rows.drop("__pii_found", "__pii_new", "__pii_kinds")
