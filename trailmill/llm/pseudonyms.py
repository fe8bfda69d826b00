"""Format-preserving pseudonyms for personal data, from built-in functions only.

One pattern finds candidates, each kind validates its own, and a keyed Feistel network permutes the valid ones inside their format:

* card numbers that pass the Luhn check: all digits but the last, which is made to fit again;
* bank account numbers (IBAN) that pass their check: the digits of the account, then the check digits;
* dates of the 73,000 days from 1900-01-01: the number of the day, in the same layout;
* IPv4 addresses: the 32 bits;
* phone and social security numbers: the digits, country prefix and separators stay.

Permutations keep different values different, and equal values stay equal in all documents. Mail addresses and access
keys have no numeric format; keyed digests of the same shape take their place. Text that fails its check stays.

The key is a secret of the caller. Defined cases: a null text stays null; rows are rewritten one by one, so repeated rows
stay equal; an empty table gives no rows; a text or candidate of any length is matched without recursion over its length;
other columns pass unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmill.llm.tables import let

ROUNDS = 8
FIRST_DAY = "1900-01-01"
DAYS = (250, 292)

#: The domain is one run of characters, as a loop over its labels would recurse once per label; ``mail`` checks the labels.
DOMAIN = r"@[A-Za-z0-9-][A-Za-z0-9.-]*\.[A-Za-z]{2,}"
EMAIL = rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{DOMAIN}"
ACCESS_KEY = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
HEX_KEY = r"(?<![0-9A-Za-z])[0-9a-f]{32,64}(?![0-9A-Za-z])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
DAY_DATE = r"(?<![0-9/.])[0-9]{2}[/.][0-9]{2}[/.][0-9]{4}(?![0-9/])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (
    r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
    r"|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])"
    r"|(?<![0-9A-Za-z.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
)
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
ANY = "|".join((EMAIL, ACCESS_KEY, HEX_KEY, IBAN, ADDRESS, ISO_DATE, DAY_DATE, SOCIAL, PHONE, CARD))


def number_of(key: str, tweak: str, *parts: Column) -> Column:
    """60 bits of a keyed SHA-256."""
    text = F.concat_ws("|", F.lit(key), F.lit(tweak), *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tweak: str) -> Column:
    """Struct x, y: a keyed permutation of the pairs below (a, b), by rounds that change one side each."""

    def step(s: Column, i: Column) -> Column:
        return F.struct(
            F.when(i % 2 == 1, (s["x"] + number_of(key, tweak, i, s["y"])) % a).otherwise(s["x"]).alias("x"),
            F.when(i % 2 == 0, (s["y"] + number_of(key, tweak, i, s["x"])) % b).otherwise(s["y"]).alias("y"),
        )

    start = F.struct(left.cast("long").alias("x"), right.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    """Digits of the same number, permuted among all strings of this length (2 to 36)."""
    size = F.length(digits)
    half = F.floor(size / 2).cast("int")
    power = lambda n: F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")
    left, right = F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, size)
    done = feistel(left.cast("long"), right.cast("long"), power(half), power(size - half), key, tweak)
    return let(
        done, lambda s: F.concat(F.lpad(s["x"].cast("string"), half, F.lit("0")), F.lpad(s["y"].cast("string"), size - half, F.lit("0")))
    )


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def filled(found: Column, digits: Column, skip: int | Column = 0) -> Column:
    """``found`` with its digits after the first ``skip`` replaced in order; all else stays."""
    before = lambda i: F.length(digits_of(F.substring(found, F.lit(1), i)))
    here = lambda i: F.substring(found, i, F.lit(1))
    one = lambda i: F.when(
        here(i).rlike("[0-9]") & (before(i) > skip), F.substring(digits, before(i) - skip, F.lit(1))
    ).otherwise(here(i))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(found)), one), "")


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum; digits whose place from the right is ``doubled`` modulo 2 (from 0) count twice."""
    size = F.length(digits)
    value = lambda i: F.substring(digits, size - i, F.lit(1)).cast("int")
    weighed = lambda i: F.when(i % 2 == doubled, F.when(value(i) > 4, 2 * value(i) - 9).otherwise(2 * value(i))).otherwise(value(i))
    return F.aggregate(F.transform(F.sequence(F.lit(0), size - 1), weighed), F.lit(0), lambda s, x: s + x)


def card(found: Column, key: str) -> Column:
    def with_check(body: Column) -> Column:
        check = (10 - luhn_sum(body, 0) % 10) % 10
        return filled(found, F.concat(body, check.cast("string")))

    def changed(digits: Column) -> Column:
        body = F.substring(digits, F.lit(1), F.length(digits) - 1)
        return F.when(luhn_sum(digits, 1) % 10 == 0, let(permuted_digits(body, key, "card"), with_check)).otherwise(found)

    return let(digits_of(found), changed)


def account_rest(text: Column) -> Column:
    """Remainder modulo 97 of an account number, letters counting 10 to 35."""
    code = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda s, c: (s * F.when(c.rlike("[0-9]"), 10).otherwise(100) + code(c)) % 97
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def account(found: Column, key: str) -> Column:
    """Digits of a valid account number permuted; country, letters and spaces stay, check digits fit again."""

    def checked(digits: Column) -> Column:
        body = F.substring(digits, F.lit(3), F.length(digits))

        def with_check(new: Column) -> Column:
            rest = filled(F.substring(found, F.lit(5), F.length(found)), new)
            bare = F.replace(rest, F.lit(" "), F.lit(""))
            check = 98 - account_rest(F.concat(bare, F.substring(found, 1, 2), F.lit("00")))
            return F.concat(F.substring(found, 1, 2), F.lpad(check.cast("string"), 2, "0"), rest)

        return F.when(F.length(body) >= 4, let(permuted_digits(body, key, "account"), with_check)).otherwise(found)

    bare = F.replace(found, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, F.lit(5), F.length(bare)), F.substring(bare, 1, 4))
    return F.when(account_rest(turned) == 1, let(digits_of(found), checked)).otherwise(found)


def address(found: Column, key: str) -> Column:
    def changed(parts: Column) -> Column:
        value = lambda i: parts[i].cast("long")
        valid = ~F.exists(parts, lambda p: p.cast("int") > 255)
        wide = F.lit(65536).cast("long")
        done = feistel(value(0) * 256 + value(1), value(2) * 256 + value(3), wide, wide, key, "address")
        text = let(
            done,
            lambda s: F.concat_ws(
                ".", *(x.cast("string") for side in ("x", "y") for x in (F.floor(s[side] / 256).cast("int"), s[side] % 256))
            ),
        )
        return F.when(valid, text).otherwise(found)

    return let(F.split(found, r"\."), changed)


def permuted_day(day: Column, key: str) -> Column:
    """A day of the range moved to another; null outside it or for no date."""
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    wide, narrow = (F.lit(n).cast("long") for n in DAYS)

    def moved(n: Column) -> Column:
        done = feistel(F.floor(n / DAYS[1]), n % DAYS[1], wide, narrow, key, "day")
        return let(done, lambda s: F.date_add(F.lit(FIRST_DAY).cast("date"), (s["x"] * DAYS[1] + s["y"]).cast("int")))

    return F.when((number >= 0) & (number < DAYS[0] * DAYS[1]), let(number, moved))


def date(found: Column, key: str) -> Column:
    """A date in its own layout; day before month where that is a date, else month before day."""
    mark = F.substring(found, 3, 1)
    plain = F.translate(found, ".", "/")
    day_first, month_first = (F.try_to_timestamp(plain, F.lit(f)).cast("date") for f in ("dd/MM/yyyy", "MM/dd/yyyy"))
    iso = F.date_format(permuted_day(F.try_to_timestamp(found, F.lit("yyyy-MM-dd")).cast("date"), key), "yyyy-MM-dd")
    by_day = F.date_format(permuted_day(day_first, key), "dd/MM/yyyy")
    by_month = F.date_format(permuted_day(month_first, key), "MM/dd/yyyy")
    short = F.when(day_first.isNotNull(), by_day).otherwise(by_month)
    return F.coalesce(F.when(found.contains("-"), iso).otherwise(F.replace(short, F.lit("/"), mark)), found)


def phone(found: Column, key: str) -> Column:
    """All digits but a country prefix after a plus sign, if more than four are left."""
    prefix = F.when(found.startswith("+"), F.length(F.regexp_extract(found, r"^\+([0-9]{1,3}?)(?:[ .(-]|[0-9]{7})", 1))).otherwise(0)

    def changed(skip: Column) -> Column:
        digits = digits_of(found)
        body = F.substring(digits, skip + 1, F.length(digits))
        return filled(found, permuted_digits(body, key, "phone"), skip)

    return let(prefix, changed)


def hex_digest(found: Column, key: str, tweak: str) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit(tweak), found)
    return F.sha2(text.cast("binary"), 512)


def mail(found: Column, key: str) -> Column:
    """A digest for the address at the start of ``found``; what follows an empty label is no address and stays."""
    address = F.regexp_extract(F.substring_index(found, "..", 1), rf"^[^@]++{DOMAIN}", 0)

    def digested(valid: Column) -> Column:
        new = F.concat(F.lit("u"), F.substring(hex_digest(F.lower(valid), key, "mail"), 1, 16), F.lit("@example.invalid"))
        return F.when(valid == "", found).otherwise(F.concat(new, F.substring(found, F.length(valid) + 1, F.length(found))))

    return let(address, digested)


def replaced(found: Column, key: str) -> Column:
    """The pseudonym of one candidate."""
    upper = F.translate(F.upper(F.substring(hex_digest(found, key, "key"), 1, 16)), "0123456789", "GHJKMNPQRS")
    kinds = (
        (EMAIL, mail(found, key)),
        (ACCESS_KEY, F.concat(F.substring(found, 1, 4), upper)),
        (HEX_KEY, F.substring(hex_digest(found, key, "hex"), F.lit(1), F.length(found))),
        (IBAN, account(found, key)),
        (ADDRESS, address(found, key)),
        (f"{ISO_DATE}|{DAY_DATE}", date(found, key)),
        (SOCIAL, filled(found, permuted_digits(digits_of(found), key, "social"))),
        (PHONE, phone(found, key)),
    )
    out = card(found, key)
    for pattern, value in reversed(kinds):
        out = F.when(found.rlike(rf"^(?:{pattern})$"), value).otherwise(out)
    return out


def rewritten(text: Column, key: str) -> Column:
    """Struct text, n_found and n_replaced of a text."""

    def joined(found: Column) -> Column:
        return let(
            F.transform(found, lambda m: replaced(m, key)),
            lambda new: F.struct(
                F.concat_ws("", F.flatten(F.zip_with(F.split(text, ANY, -1), new, lambda a, b: F.array(a, F.coalesce(b, F.lit("")))))).alias("text"),
                F.size(found).alias("n_found"),
                F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x)).alias("n_replaced"),
            ),
        )

    some = let(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), joined)
    none = F.struct(text.alias("text"), F.lit(0).alias("n_found"), F.lit(0).alias("n_replaced"))
    return F.when(text.rlike(ANY), some).otherwise(none)


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; columns unchanged, ``n_chars`` measured again where it exists."""
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("_row"), rewritten(F.col("text"), key)["text"].alias("_text"))
    new = {"text": F.col("_text")}
    if "n_chars" in names:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in names))


def reported(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text, n_found and n_replaced of every row."""
    return docs.select("doc_id", rewritten(F.col("text"), key).alias("_r")).select("doc_id", "_r.text", "_r.n_found", "_r.n_replaced")
