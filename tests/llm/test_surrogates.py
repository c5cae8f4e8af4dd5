import re

from helpers import ODD, documents
from pyspark.sql import functions as F

from histoframe.llm import surrogates
from histoframe.llm.surrogates import moved_on, replace_personal_data, surrogate

KEY = "k"


def replaced(spark, *texts, key=KEY):
    df = replace_personal_data(documents(spark, list(enumerate(texts))), key)
    return [r.text for r in df.orderBy("doc_id").collect()]


def test_kinds_and_formats(spark):
    (out,) = replaced(spark, "Mail Anna.55@mail3.example.com, ip 10.20.30.40, +1 (017) 555-7713, 4539 1488 0343 6467, 123-45-6789, DE89 3704 0044 0532 0130 00.")
    mail, ip, phone, card, ssn, iban = re.fullmatch(r"Mail (\S+), ip (\S+), (\+1 \(\d{3}\) \d{3}-\d{4}), (\d{4} \d{4} \d{4} \d{4}), (\d{3}-\d{2}-\d{4}), (DE\d\d(?: \d{4}){4} \d\d)\.", out).groups()
    assert re.fullmatch(r"[A-Z][a-z]{3}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com", mail) and "Anna" not in mail
    assert all(1 <= int(x) <= 254 for x in ip.split(".")) and ip != "10.20.30.40"
    digits = [int(c) for c in card.replace(" ", "")][::-1]
    assert sum(digits[::2]) % 10 == -sum(d * 2 - 9 * (d > 4) for d in digits[1::2]) % 10 and card[0] == "4"
    assert phone != "+1 (017) 555-7713" and ssn != "123-45-6789" and iban != "DE89 3704 0044 0532 0130 00"


def test_coreference_key_and_gender(spark):
    a, b = replaced(spark, "Mrs. Emma Stone met Mr. John Stone; later Emma wrote to x.1@a.example.com.", "X.1@A.example.com and 4539148803436467 = 4539-1488-0343-6467")
    names = re.fullmatch(r"Mrs\. (\S+) (\S+) met Mr\. (\S+) (\S+); later (\S+) wrote to (\S+)\.", a).groups()
    assert names[1] == names[3] and names[0] == names[4] and names[0][-1] == "a" and names[2][-1] != "a"
    mail, plain, dashed = re.fullmatch(r"(\S+) and (\d{16}) = ([\d-]+)", b).groups()
    assert mail.lower() == names[5] and plain == dashed.replace("-", "")
    assert replaced(spark, "x.1@a.example.com", key="other") != replaced(spark, "x.1@a.example.com")
    (cyrillic,) = replaced(spark, "г-жа Анна Иванова пишет.")
    assert re.fullmatch(r"г-жа [А-Я][а-я]{2}а [А-Я][а-я]{6} пишет\.", cyrillic) and "Анна" not in cyrillic


def test_collisions_are_told_apart(spark):
    rows = [("ssn", str(i)) for i in range(100, 300)]
    df = spark.createDataFrame(rows, "kind string, value string")
    late = {(r.kind, r.value): r.attempt for r in moved_on(df, KEY).collect()}
    tries = spark.createDataFrame([(k, v, late.get((k, v), 0)) for k, v in rows], "kind string, value string, attempt int")
    made = [r.made for r in tries.withColumn("made", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), KEY)).collect()]
    assert len(set(made)) == len(made) and not set(made) & {v for _, v in rows}


def test_clean_text_stays(spark):
    texts = ["Licensed under CC BY-NC 4.0, version 3.", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"", "On 2024-01-15 10:22 at 3.14.15 we had 1 234 visitors", "Mit Dr. allein"]
    assert replaced(spark, *texts) == texts


def test_odd_rows(spark):
    df = documents(spark, ODD)
    out = replace_personal_data(df, KEY)
    assert out.columns[: len(df.columns)] == df.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == sorted((i or 0, t or "") for i, t in ODD)
    assert out.filter("doc_id = 1").first().text is None
    assert replace_personal_data(documents(spark, []), KEY).count() == 0
    (marked,) = replaced(spark, "\u0001\u0002a 10.20.30.40 \u0002b")
    assert re.fullmatch("\u0001\u0002a [0-9.]+ \u0002b", marked)


def test_long_chains_are_no_burden(spark):
    """Thousands of dots, hyphens, digits or words in one mention."""
    domain, name, digits = "x a@" + "a." * 3000 + "com", "Mr Abc" + "-ab" * 3000 + " came", "1" + " 23" * 20_000
    titles, mails = "Mr Stone and " * 5000, "a.b@c.de," * 5000
    longest = "a@" + "b." * 126 + "org"
    out = replaced(spark, domain, name, digits, titles, mails, longest)
    assert out[0] == domain and re.fullmatch(r"Mr [A-Z][a-z]+ came", out[1])
    assert len(set(out[3].split(" and "))) == 2 and "Stone" not in out[3]
    assert len(set(out[4].split(","))) == 2 and "a.b@c.de" not in out[4] and out[5] != longest


def test_more_names_than_short_surrogates(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "SYLLABLES", ("al",))
    monkeypatch.setattr(surrogates, "GROWTH", 1)
    rows = [("name_s", "Q" + "abcdefgh"[i % 8] + "ijklmnop"[i // 8]) for i in range(10)]
    late = {r.value: r.attempt for r in moved_on(spark.createDataFrame(rows, "kind string, value string"), KEY).collect()}
    tries = spark.createDataFrame([(k, v, late.get(v, 0)) for k, v in rows], "kind string, value string, attempt int")
    made = [r.made for r in tries.withColumn("made", surrogate(F.col("kind"), F.col("value"), F.col("attempt"), KEY)).collect()]
    assert len(set(made)) == 10 and max(late.values()) >= 2
    grown = spark.createDataFrame([("name_f", "Анна", 2), ("email", "a@b.com", 2)], "kind string, value string, attempt int")
    anna, mail = (r.made for r in grown.select(surrogate(F.col("kind"), F.col("value"), F.col("attempt"), KEY).alias("made")).collect())
    assert re.fullmatch("[А-Я][а-я]{4}а", anna) and re.fullmatch(r"[a-z]{3}@[a-z]\.com", mail)
