"""Pseudonyms: validity, linkage, inverse, and an independent Feistel in Python."""

import datetime as dt
import hashlib
import random
import re

from helpers import empty, hard
from pyspark.sql import functions as F

from tapeloom.llm import pii


def feistel(left, right, ls, rs, key, kind):
    for i in range(pii.ROUNDS):
        half, size = (right, ls) if i % 2 == 0 else (left, rs)
        shift = int(hashlib.sha256(f"{key}|{kind}|{i}|{half}|{size}".encode()).hexdigest()[:15], 16) % size
        if i % 2 == 0:
            left = (left + shift) % ls
        else:
            right = (right + shift) % rs
    return left, right


def digits(d, key, kind):
    cut = len(d) // 2
    a, b = feistel(int(d[:cut]), int(d[cut:]), 10**cut, 10 ** (len(d) - cut), key, kind)
    return str(a).zfill(cut) + str(b).zfill(len(d) - cut)


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def mod97(a):
    return int("".join(str(int(c, 36)) for c in a[4:] + a[:4])) % 97


ROWS = [
    (1, "card 4387513035237269, again 4387 5130 3523 7269; phone +1 (724) 555-7058 mail hnp.46@mail3.example.com ip 43.203.110.141."),
    (2, "4387-5130-3523-7269 born 1987-06-05 or 05.06.1987 or 6/5/1987; 99.99.2020 ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432"),
    (3, "no card 4387513035237268, version 1.2.3.4.5, 999.1.1.1, 2020-13-01, token 0641917ea4e9, 12345, 3.14159"),
    (4, None),
    (5, ""),
]


def run(spark, rows, key="k", back=False):
    df = spark.createDataFrame(rows, "doc_id int, text string")
    return [r.text for r in (pii.reveal if back else pii.pseudonymise)(df, key).orderBy("doc_id").collect()]


def test_pseudonyms(spark):
    got = run(spark, ROWS)
    assert got[2:] == [r[1] for r in ROWS[2:]]
    cards = re.findall(r"\b\d{16}\b|\b\d{4} \d{4} \d{4} \d{4}\b|\b\d{4}-\d{4}-\d{4}-\d{4}\b", got[0] + got[1].split("born")[0])
    assert len(cards) == 3 and len({re.sub(r"\D", "", c) for c in cards}) == 1
    card = re.sub(r"\D", "", cards[0])
    assert luhn(card) and card[:15] == digits("438751303523726", "k", "card") and card != "4387513035237269"
    phone = re.search(r"\+1 \((\d{3})\) (\d{3})-(\d{4})", got[0])
    a, b = feistel(524, 355 * 10_000 + 7058, 800, 8_000_000, "k", "phone")
    assert "".join(phone.groups()) == f"{a + 200}{b // 10_000 + 200}{b % 10_000:04}"
    assert re.search(r"mail [a-z]{3}\.\d\d@mail3\.example\.com", got[0]) and "hnp.46" not in got[0]
    a, b = feistel(43 * 256 + 203, 110 * 256 + 141, 65536, 65536, "k", "address")
    assert f"ip {a // 256}.{a % 256}.{b // 256}.{b % 256}." in got[0]
    n = (dt.date(1987, 6, 5) - dt.date(1700, 1, 1)).days
    x, y = feistel(n // 773, n % 773, 189, 773, "k", "date")
    d = dt.date(1700, 1, 1) + dt.timedelta(days=x * 773 + y)
    assert f"born {d} or {d:%d.%m.%Y} or {d.month}/{d.day}/{d.year};" in got[1] and "99.99.2020" in got[1]
    a, b = feistel(122, 44 * 9_999 + 6_788, 898, 989_901, "k", "ssn")
    assert f"ssn {a + 1 + (a >= 665):03}-{b // 9_999 + 1:02}-{b % 9_999 + 1:04}" in got[1] and "123-45-6789" not in got[1]
    ibans = re.findall(r"DE\d\d \d{4} \d{4} \d{4} \d{4} \d\d|GB\d\d[A-Z]{4}\d{14}", got[1])
    assert len(ibans) == 2 and all(mod97(i.replace(" ", "")) == 1 for i in ibans) and "GB82WEST" not in got[1]


def test_reveal_and_key(spark):
    hidden = run(spark, ROWS)
    assert run(spark, list(zip(range(5), hidden)), back=True) == [r[1] for r in ROWS]
    assert run(spark, ROWS, key="other")[0] != hidden[0]


def test_permutation_of_small_domains(spark):
    """All values of a format map to all values of it."""
    d = F.lpad(F.col("id").cast("string"), 3, "0")
    got = spark.range(1000).select(pii.permute_digits(d, "k", "t").alias("x")).collect()
    assert len({r.x for r in got}) == 1000 and all(re.fullmatch(r"\d{3}", r.x) for r in got)
    days = spark.range(0, 146_097, 97).select(F.date_format(F.date_add(F.lit("1700-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("m"))
    moved = days.select(pii.date(F.col("m"), "k", False).alias("d"))
    assert moved.distinct().count() == days.count() and moved.where("d BETWEEN '1700-01-01' AND '2099-12-31'").count() == days.count()


def test_numbers_stay_of_their_sort_and_come_back(spark):
    rng = random.Random(5)
    day = lambda: dt.date(1700, 1, 1) + dt.timedelta(days=rng.randrange(146_097))
    ssns = [f"{rng.choice([0, 666, 900, 987, 1, 665, 667, 899, rng.randrange(1000)]):03}-{rng.choice([0, 1, rng.randrange(100)]):02}-{rng.choice([0, 1, rng.randrange(10_000)]):04}" for _ in range(300)]
    phones = [f"{rng.randrange(1000):03}-{rng.randrange(1000):03}-{rng.randrange(10_000):04}" for _ in range(200)]
    dates = [f"{d.day:02}/{d.month:02}/{d.year}" for d in (day() for _ in range(300))]
    cards = ["0000000000000", "4387513035237269"]
    texts = [*ssns, *phones, *dates, *cards, "DE00 3704 0044 0532 0130 00"]
    hidden = run(spark, list(enumerate(texts)))
    assert run(spark, list(enumerate(hidden)), back=True) == texts and len(set(hidden)) == len(set(texts)) and hidden[-1] == texts[-1] and hidden[-3] == cards[0]

    def issued(x):
        a, g, s = x.split("-")
        return (a in ("000", "666") or a[0] == "9", (g == "00" or s == "0000") and not (a in ("000", "666") or a[0] == "9"))

    assert [issued(x) for x in ssns] == [issued(x) for x in hidden[:300]]
    assert [(x[0] > "1", x[4] > "1") for x in phones] == [(x[0] > "1", x[4] > "1") for x in hidden[300:500]]
    assert all(int(y[:2]) > 12 for x, y in zip(dates, hidden[500:800]) if int(x[:2]) > 12)


def test_late_days_are_permuted(spark):
    days = spark.range(0, 146_097, 7).select(F.date_format(F.date_add(F.lit("1700-01-01").cast("date"), F.col("id").cast("int")), "dd/MM/yyyy").alias("m")).where("substr(m, 1, 2) > 12")
    moved = days.select(pii.date(F.col("m"), "k", False).alias("d"))
    assert moved.distinct().count() == days.count() and moved.where("substr(d, 1, 2) > 12 AND substr(d, 7) BETWEEN '1700' AND '2099'").count() == days.count()


def test_hard_rows_and_plan(spark):
    docs = hard(spark)
    out = pii.pseudonymise(docs, "k")
    assert out.columns == docs.columns and {(r.doc_id, r.text) for r in out.collect()} == {(r.doc_id, r.text) for r in docs.collect()}
    assert pii.pseudonymise(empty(spark), "k").count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_a_number_is_linked_however_it_is_written(spark):
    texts = ["+442071234567", "+44 20 7123 4567", "+44-20-7123-4567", "+4930123456", "+49 30 123456", "+15551234567", "+1 555 123 4567", "+353 1 234 5678", "+35312345678", "+21 234 5678"]
    hidden = run(spark, list(enumerate(texts)))
    digits = [re.sub(r"[^0-9]", "", h) for h in hidden]
    assert digits[0] == digits[1] == digits[2] != "442071234567" and digits[0].startswith("44")
    assert digits[3] == digits[4] and digits[3].startswith("49") and digits[5] == digits[6] and digits[5][0] == "1" and digits[7] == digits[8] and digits[7].startswith("353")
    assert [re.sub("[0-9]", "0", h) for h in hidden] == [re.sub("[0-9]", "0", t) for t in texts]
    assert run(spark, list(enumerate(hidden)), back=True) == texts


def test_very_long_texts_of_each_patterns_repeated_part(spark):
    """A megabyte each; none may exhaust the stack, and what stands before and after is still found."""
    card = "4387513035237269"
    parts = ["a.", "x@a.", "@", "a" * 64 + "@", "AB12", " A1B2", "AB12 3456", "1", "12-", "1.", "1.2.3.4", "1/", "01.01.", "+", "+1 ", " 1", "-1", "(1)", "123-", "123-45-", "4444 ", "4444-", "0000-00-", "é", "x@" + "b-." * 10]
    texts = [f"{card} {lead}{part * (1_000_000 // len(part))} {card}" for part in parts for lead in ("x@",)]
    hidden = run(spark, list(enumerate(texts)))
    new = run(spark, [(0, card)])[0]
    assert all(h.startswith(new) and h.endswith(new) and card not in (h[:20], h[-20:]) for h in hidden)
    long = "a@" + "b." * 120 + "com"
    assert run(spark, [(0, long)])[0].endswith("@" + "b." * 120 + "com") and run(spark, [(0, long)])[0] != long
