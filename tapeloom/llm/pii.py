"""Format-preserving pseudonyms for personal data, in Spark's own functions only.

Numbers and dates are found by pattern, validated, and replaced by another valid one of the same format.  The replacement is a
keyed permutation (a balanced Feistel network of ROUNDS rounds over the two halves of the value, halves mixed by addition
modulo their sizes), so equal values stay equal in all documents, different ones stay different, and ``reveal`` inverts it:

* payment cards (13 to 19 digits, Luhn, not all zero): the digits but the last are permuted, and the check digit is computed anew;
* international bank account numbers (mod 97, check digits 02 to 98): letters and digits of the account are permuted, check digits computed anew;
* telephone numbers with a country code, or in the form (ddd) ddd-dddd or ddd-ddd-dddd: all digits after the country code; in the North American plan (that
  form, or code 1 and ten digits) the first digits of area and exchange stay among 2 to 9, which numbers in use have, or among 0 and 1;
* social security numbers ddd-dd-dddd: those that can be issued (area neither 000, 666 nor 9xx, group not 00, serial not 0000) among themselves, those
  of another area among themselves, and the rest among themselves;
* dates (ISO, dotted, slashed) that exist, 1700 to 2099: the day within that 400-year cycle; slashed dates that can only be read day first, among themselves;
* IPv4 addresses: all 32 bits;
* mail addresses: letters and digits of the part before the @, each within its kind, in runs of 20.

Digits and letters move within their kinds, and all separators stay, so a text keeps its length except for dates and addresses, whose
fields are written as they come (dates keep their padding).  What doesn't validate stays as it is.

Everything is an expression on the row: no shuffle, no join.  Edge cases: null stays null and empty stays empty; texts of any length are
handled whole; repeated values and rows give equal results; all other columns pass through, and no helper column can clash with them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
#: Kinds in the order of their alternatives; each pattern is a possible occurrence, validated afterwards.  Every repetition of a group is bounded, as the
#: JVM matches it by recursion (253 characters after an @ are 126 labels at most).
PATTERNS = {
    "mail": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,125}\.[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![0-9.,/+-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9]|[.,/-][0-9])",
    "address": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9](?:[ .-]?[0-9]){5,12}(?![0-9])|(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9A-Za-z])(?<![0-9][.-])(?:(?:[0-9]{4} ){3}[0-9]{1,7}|(?:[0-9]{4}-){3}[0-9]{1,7}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5}|[0-9]{13,19})(?![0-9A-Za-z]|[.-][0-9])",
}
CANDIDATE = "|".join(PATTERNS.values())
#: 400 Gregorian years, and two factors of that number of days.
CYCLE_DAYS, CYCLE_PARTS, FIRST_DAY = 146_097, (189, 773), "1700-01-01"
#: Of these the days after the 12th of their month, likewise.
LATE_DAYS, LATE_PARTS = 88_497, (9, 9833)


def _round(key: str, kind: str, i: int, half: Column, size: Column) -> Column:
    """A keyed pseudo-random number below ``size``."""
    digest = F.sha2(F.concat_ws("|", F.lit(f"{key}|{kind}|{i}"), half.cast("string"), size.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % size


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, kind: str, back: bool = False) -> Column:
    """struct(l, r): the permutation of (left, right), of which left is below left_size and right below right_size."""
    pair = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"), left_size.cast("long").alias("ls"), right_size.cast("long").alias("rs"))

    def step(i: int):
        def run(p: Column) -> Column:
            if i % 2 == 0:
                shift = _round(key, kind, i, p["r"], p["ls"])
                moved = F.pmod(p["l"] - shift, p["ls"]) if back else F.pmod(p["l"] + shift, p["ls"])
                return F.struct(moved.alias("l"), p["r"].alias("r"), p["ls"].alias("ls"), p["rs"].alias("rs"))
            shift = _round(key, kind, i, p["l"], p["rs"])
            moved = F.pmod(p["r"] - shift, p["rs"]) if back else F.pmod(p["r"] + shift, p["rs"])
            return F.struct(p["l"].alias("l"), moved.alias("r"), p["ls"].alias("ls"), p["rs"].alias("rs"))

        return run

    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    # each round in a lambda of its own, so that a value is computed once however often the next round reads it
    return F.transform(reduce(lambda a, i: F.transform(a, step(i)), order, F.array(pair)), lambda p: F.struct(p["l"].alias("l"), p["r"].alias("r")))[0]


def bind(value: Column, use) -> Column:
    """``use(value)`` with value computed once."""
    return F.transform(F.array(value), use)[0]


def permute_digits(digits: Column, key: str, kind: str, back: bool = False) -> Column:
    """A string of 2 to 36 digits, permuted among the strings of its length."""

    def run(d: Column) -> Column:
        n = F.length(d)
        cut = F.floor(n / 2).cast("int")
        p = feistel(F.substr(d, F.lit(1), cut).cast("long"), F.substr(d, cut + 1).cast("long"), F.pow(F.lit(10), cut).cast("long"), F.pow(F.lit(10), n - cut).cast("long"), key, kind, back)
        return bind(p, lambda q: F.concat(F.lpad(q["l"].cast("string"), cut, "0"), F.lpad(q["r"].cast("string"), n - cut, "0")))

    return bind(digits, run)


def refill(text: Column, values: Column, pattern: str) -> Column:
    """``text`` with its characters that match ``pattern`` replaced in order by those of ``values``."""
    gaps = F.split(text, pattern, -1)
    chars = F.transform(F.sequence(F.lit(1), F.greatest(F.length(values), F.lit(1))), lambda i: F.substr(values, i, F.lit(1)))
    return F.concat_ws("", F.zip_with(gaps, chars, lambda g, c: F.concat(F.coalesce(g, F.lit("")), F.coalesce(c, F.lit("")))))


def digit_sum(digits: Column, doubled: int) -> Column:
    """Luhn's sum; positions counted from the right, from 0, of parity ``doubled`` count double."""

    def value(i: Column) -> Column:
        d = F.substr(F.reverse(digits), i + 1, F.lit(1)).cast("int") * F.when(i % 2 == doubled, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(digits) - 1), value), F.lit(0), lambda a, v: a + v)


def only_digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def card(m: Column, key: str, back: bool) -> Column:
    def run(d: Column) -> Column:
        def moved(x: Column) -> Column:
            return permute_digits(x, key, "card", back)

        # zeros alone are no card: what would become them becomes what they would
        both = F.struct(moved(F.substr(d, F.lit(1), F.length(d) - 1)).alias("p"), moved(F.lpad(F.lit(""), F.length(d) - 1, "0")).alias("z"))
        first = bind(both, lambda b: F.when(b["p"].rlike("^0+$"), b["z"]).otherwise(b["p"]))
        full = bind(first, lambda p: F.concat(p, ((10 - digit_sum(p, 0) % 10) % 10).cast("string")))
        return F.when(F.length(d).between(13, 19) & (digit_sum(d, 1) % 10 == 0) & ~d.rlike("^0+$"), refill(m, full, "[0-9]")).otherwise(m)

    return bind(only_digits(m), run)


def mod97(account: Column) -> Column:
    """Of an account number with its first four characters last, read as a number with A = 10."""
    digits = F.transform(F.split(account, ""), lambda c: F.when(c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c))
    return F.aggregate(F.split(F.concat_ws("", digits), ""), F.lit(0), lambda a, d: (a * 10 + F.coalesce(d.try_cast("int"), F.lit(0))) % 97)


def iban(m: Column, key: str, back: bool) -> Column:
    def run(a: Column) -> Column:
        country = F.substr(a, F.lit(1), F.lit(2))
        body = permute_kinds(F.substr(a, F.lit(5)), key, "iban", back)
        full = bind(body, lambda b: F.concat(country, F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b))
        valid = F.length(a).between(15, 34) & F.substr(a, F.lit(3), F.lit(2)).between("02", "98") & (mod97(F.concat(F.substr(a, F.lit(5)), F.substr(a, F.lit(1), F.lit(4)))) == 1)
        return F.when(valid, refill(m, full, "[A-Z0-9]")).otherwise(m)

    return bind(F.regexp_replace(m, " ", ""), run)


def radix(c: Column) -> Column:
    return F.when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1)


def ordinal(c: Column) -> Column:
    return F.when(c.rlike("[0-9]"), F.ascii(c) - 48).when(c.rlike("[A-Z]"), F.ascii(c) - 65).when(c.rlike("[a-z]"), F.ascii(c) - 97).otherwise(0)


def spelled(template: Column, number: Column) -> Column:
    """``number`` in the mixed radix of ``template``: digits stay digits, letters letters of their case, the rest as it is."""
    start = F.struct(number.cast("long").alias("rest"), F.lit("").alias("out"))

    def step(a: Column, c: Column) -> Column:
        v = (a["rest"] % radix(c)).cast("int")
        out = F.when(c.rlike("[0-9]"), F.char(v + 48)).when(c.rlike("[A-Z]"), F.char(v + 65)).when(c.rlike("[a-z]"), F.char(v + 97)).otherwise(c)
        return F.struct(F.floor(a["rest"] / radix(c)).cast("long").alias("rest"), F.concat(out, a["out"]).alias("out"))

    return F.aggregate(F.reverse(F.split(template, "")), start, step, lambda a: a["out"])


def permute_kinds(text: Column, key: str, kind: str, back: bool = False) -> Column:
    """A string of up to 64 characters, permuted in runs of 20 among the strings with digits and letters of each case in the same places."""

    def value(s: Column) -> Column:
        return F.aggregate(F.split(s, ""), F.lit(0).cast("long"), lambda a, c: a * radix(c) + ordinal(c))

    def size(s: Column) -> Column:
        return F.aggregate(F.split(s, ""), F.lit(1).cast("long"), lambda a, c: a * radix(c))

    def run(s: Column) -> Column:
        cut = F.greatest(F.floor(F.length(s) / 2).cast("int"), F.lit(1))
        halves = F.struct(F.substr(s, F.lit(1), cut).alias("a"), F.substr(s, cut + 1).alias("b"))
        return bind(halves, lambda h: bind(feistel(value(h["a"]), value(h["b"]), size(h["a"]), size(h["b"]), key, kind, back), lambda p: F.concat(spelled(h["a"], p["l"]), spelled(h["b"], p["r"]))))

    return F.concat_ws("", F.transform(F.regexp_extract_all(text, F.lit("(?s).{1,20}"), F.lit(0)), run))


def mail(m: Column, key: str, back: bool) -> Column:
    return F.concat(permute_kinds(F.substring_index(m, "@", 1), key, "mail", back), F.lit("@"), F.substring_index(m, "@", -1))


def number(digits: Column, at: int, n: int) -> Column:
    return F.substr(digits, F.lit(at), F.lit(n)).cast("long")


def padded(n: Column, width: int) -> Column:
    return F.lpad(n.cast("long").cast("string"), width, "0")


#: Assigned country codes of one and two digits; all others have three.
COUNTRY_CODE = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}|[0-9]{1,3})"


def phone(m: Column, key: str, back: bool) -> Column:
    """A number is the same with and without separators after its country code, so its pseudonym is too."""
    code = F.regexp_extract(m, COUNTRY_CODE, 0)

    def north_american(d: Column) -> Column:
        def low(at: int) -> Column:  # the least value of the three digits from there, by their first
            return F.when(number(d, at, 1) >= 2, 200).otherwise(0)

        def size(at: int) -> Column:
            return F.when(number(d, at, 1) >= 2, 800).otherwise(200)

        p = feistel(number(d, 1, 3) - low(1), (number(d, 4, 3) - low(4)) * 10_000 + number(d, 7, 4), size(1), size(4) * 10_000, key, "phone", back)
        return bind(p, lambda q: F.concat(padded(q["l"] + low(1), 3), padded(F.floor(q["r"] / 10_000) + low(4), 3), padded(q["r"] % 10_000, 4)))

    def run(c: Column) -> Column:
        rest = F.substr(m, F.length(c) + 1)

        def moved(d: Column) -> Column:
            return F.when((F.length(d) == 10) & c.isin("", "+1"), north_american(d)).otherwise(permute_digits(d, key, "phone", back))

        return F.concat(c, refill(rest, bind(only_digits(rest), moved), "[0-9]"))

    return bind(code, run)


def ssn(m: Column, key: str, back: bool) -> Column:
    """As two numbers below sizes that say which of the three sorts it is."""

    def run(d: Column) -> Column:
        area, group, serial = number(d, 1, 3), number(d, 4, 2), number(d, 6, 4)
        other_area = (area == 0) | (area == 666) | (area >= 900)
        blank = (group == 0) | (serial == 0)
        left = F.when(other_area, F.when(area == 0, 0).when(area == 666, 1).otherwise(area - 898)).otherwise(area - 1 - (area > 666).cast("int"))
        right = F.when(other_area, group * 10_000 + serial).when(blank, F.when(group == 0, serial).otherwise(9_999 + group)).otherwise((group - 1) * 9_999 + serial - 1)
        p = feistel(left, right, F.when(other_area, 102).otherwise(898), F.when(other_area, 1_000_000).when(blank, 10_099).otherwise(989_901), key, "ssn", back)

        def written(q: Column) -> Column:
            a = F.when(other_area, F.when(q["l"] == 0, 0).when(q["l"] == 1, 666).otherwise(q["l"] + 898)).otherwise(q["l"] + 1 + (q["l"] >= 665).cast("int"))
            g = F.when(other_area, F.floor(q["r"] / 10_000)).when(blank, F.when(q["r"] < 10_000, 0).otherwise(q["r"] - 9_999)).otherwise(F.floor(q["r"] / 9_999) + 1)
            s = F.when(other_area, q["r"] % 10_000).when(blank, F.when(q["r"] < 10_000, q["r"]).otherwise(0)).otherwise(q["r"] % 9_999 + 1)
            return F.concat(padded(a, 3), padded(g, 2), padded(s, 4))

        return refill(m, bind(p, written), "[0-9]")

    return bind(only_digits(m), run)


def address(m: Column, key: str, back: bool) -> Column:
    def run(o: Column) -> Column:
        valid = F.forall(o, lambda x: (x.cast("int") <= 255) & ((x == "0") | ~x.startswith("0")))
        p = feistel(o[0].cast("long") * 256 + o[1].cast("long"), o[2].cast("long") * 256 + o[3].cast("long"), F.lit(65536), F.lit(65536), key, "address", back)
        return F.when(valid, bind(p, lambda q: F.concat_ws(".", F.floor(q["l"] / 256).cast("string"), (q["l"] % 256).cast("string"), F.floor(q["r"] / 256).cast("string"), (q["r"] % 256).cast("string")))).otherwise(m)

    return bind(F.split(m, r"\."), run)


def date(m: Column, key: str, back: bool) -> Column:
    """Slashed dates are read month first; if that's no date, day first, and then their day is after the 12th, as their pseudonym's is."""
    first_day = F.lit(FIRST_DAY).cast("date")

    def permuted(n: Column, parts: tuple[int, int], kind: str) -> Column:
        a, b = parts
        p = feistel(F.floor(n / b), n % b, F.lit(a), F.lit(b), key, kind, back)
        return bind(p, lambda q: q["l"] * b + q["r"]).cast("int")

    def months(d: Column) -> Column:
        return (F.year(d) - int(FIRST_DAY[:4])) * 12 + F.month(d) - 1

    def late(n: Column) -> Column:
        """The n-th of the days after the 12th of their month."""
        guess = F.floor(n * 4800 / LATE_DAYS).cast("int")
        near = F.transform(F.sequence(guess - 2, guess + 2), lambda k: F.struct(k.alias("k"), F.date_add(first_day, n + 12 * (k + 1)).alias("d")))
        return F.filter(near, lambda x: (months(x["d"]) == x["k"]) & (F.day(x["d"]) > 12))[0]["d"]

    def moved(d: Column, swapped: Column) -> Column:
        days = F.datediff(d, first_day)
        return F.when(swapped, bind(permuted(days - 12 * (months(d) + 1), LATE_PARTS, "late"), late)).otherwise(F.date_add(first_day, permuted(days, CYCLE_PARTS, "date")))

    def fields(f: Column, iso: Column, dotted: Column) -> Column:
        y = F.when(iso, f[0]).otherwise(f[2])
        first = F.when(iso, f[1]).when(dotted, f[1]).otherwise(f[0])
        second = F.when(iso, f[2]).when(dotted, f[0]).otherwise(f[1])

        def made(mm: Column, dd: Column) -> Column:
            return F.concat_ws("-", y, F.lpad(mm, 2, "0"), F.lpad(dd, 2, "0")).try_cast("date")

        return F.struct(made(first, second).alias("usual"), F.when(~iso & ~dotted, made(second, first)).alias("swapped"))

    def write(d: Column, f: Column, iso: Column, dotted: Column, swapped: Column) -> Column:
        def part(v: Column, like: Column) -> Column:
            return F.when(like.startswith("0") | (F.length(like) == 2) & (F.length(f[0]) == F.length(f[1])) | iso, F.lpad(v.cast("string"), 2, "0")).otherwise(v.cast("string"))

        day_first = dotted | swapped
        a, b = F.when(day_first, F.day(d)).otherwise(F.month(d)), F.when(day_first, F.month(d)).otherwise(F.day(d))
        mark = F.when(dotted, ".").otherwise("/")
        return F.when(iso, F.date_format(d, "yyyy-MM-dd")).otherwise(F.concat(part(a, f[0]), mark, part(b, f[1]), mark, F.lpad(F.year(d).cast("string"), 4, "0")))

    def run(f: Column) -> Column:
        iso, dotted = m.contains("-"), m.contains(".")

        def found(x: Column) -> Column:
            d = F.coalesce(x["usual"], x["swapped"])
            ok = d.between(F.lit(FIRST_DAY).cast("date"), F.lit("2099-12-31").cast("date"))
            return F.when(ok, bind(moved(d, x["usual"].isNull()), lambda e: write(e, f, iso, dotted, x["usual"].isNull()))).otherwise(m)

        return bind(fields(f, iso, dotted), found)

    return bind(F.split(m, "[-./]"), run)


KINDS = {"mail": mail, "iban": iban, "date": date, "address": address, "ssn": ssn, "phone": phone, "card": card}


def replaced(m: Column, key: str, back: bool) -> Column:
    """One occurrence: the first kind whose pattern is the whole of it."""
    out = m
    for kind, f in reversed(KINDS.items()):
        # an occurrence stands alone here, so the looks at its surroundings hold
        out = F.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), f(m, key, back)).otherwise(out)
    return out


def pseudonymised(text: Column, key: str, back: bool = False) -> Column:
    """The text with every occurrence replaced; ``back`` reveals what was replaced."""
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    parts = F.zip_with(F.split(text, CANDIDATE, -1), F.transform(found, lambda m: replaced(m, key, back)), lambda g, m: F.concat(F.coalesce(g, F.lit("")), F.coalesce(m, F.lit(""))))
    return F.when(text.rlike("[0-9@]") & text.rlike(CANDIDATE), F.concat_ws("", parts)).otherwise(text)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    return docs.withColumn(text_col, pseudonymised(F.col(text_col), key))


def reveal(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    return docs.withColumn(text_col, pseudonymised(F.col(text_col), key, back=True))


def occurrences(text: Column) -> Column:
    """How many strings of a text are looked at."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))), F.lit(0))
