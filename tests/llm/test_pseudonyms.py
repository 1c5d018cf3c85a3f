from __future__ import annotations

import datetime
import random
import re

import pytest

from sitefacts.llm import pseudonyms as ps

KEY = b"k" * 32


@pytest.mark.parametrize("size", [2, 10, 97, 1000, 73049])
def test_permutation(size):
    images = [ps.permute(i, size, KEY, "t") for i in range(min(size, 3000))]
    assert len(set(images)) == len(images) and all(0 <= i < size for i in images)
    assert all(ps.permute(v, size, KEY, "t", back=True) == i for i, v in enumerate(images))
    if size <= 1000:
        assert sorted(images) == list(range(size))


def new(text):
    return ps.replace_all(text, KEY)[0]


def shape(text):
    return re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", text)))


def test_formats_and_links():
    values = ["4111 1111 1111 1111", "+1 (555) 555-5657", "a.b-1@mail3.example.com", "132.201.103.247", "2020-02-29", "078-05-1120",
              "GB82 WEST 1234 5698 7654 32", "03.11.1999", "12/25/2020", "555-123-4567"]
    for value in values:
        made = new(f"see {value}, and {value}.")
        first, second = re.fullmatch(r"see (.*), and (.*)\.", made).groups()
        assert first == second != value and shape(first) == shape(value)
        assert ps.replace_all(made, KEY, back=True)[0] == f"see {value}, and {value}."
        assert ps.replace_all(f"see {value}.", b"other")[0] != f"see {first}."
    digits = lambda t: re.sub(r"\D", "", t)
    assert digits(new("4111 1111 1111 1111")) == digits(new("4111-1111-1111-1111"))
    card = digits(new("4111 1111 1111 1111"))
    assert ps.luhn_digit(card[:-1]) == card[-1]


def test_only_validated_values_change():
    for text in ("4111111111111112", "0000000000000000", "999.1.1.1", "1.2.3.4.5", "2021-02-30", "666-12-3456", "GB82 WEST 1234 5698 7654 33",
                 "5551234567", "12", "a @ b", "version 3.0", ""):
        assert new(text) == text


def test_dates_are_bijective_in_each_form():
    for form in ("%Y-%m-%d", "%d/%m/%Y", "%d %B %Y", "%B %d, %Y"):
        days = [datetime.date(1990, 1, 1) + datetime.timedelta(n) for n in range(800)]
        made = [new(d.strftime(form)) for d in days]
        assert len(set(made)) == len(made)
        for text in made:
            datetime.datetime.strptime(text, form)


def test_random_texts_come_back(spark):
    random.seed(2)
    parts = ["4111111111111111", " ", "-", ".", "2020-01-31", "a@b.org", "x", "@", "10.0.0.1", "+4915112345678", "é", "\U0001f600", "07", "(555) 123-4567"]
    rows = [(i, "".join(random.choices(parts, k=12)), "n") for i in range(400)] + [(401, None, "n"), (402, "", "n"), (None, "a@b.org", "n")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, found string")
    made = ps.pseudonymise(docs, "key")
    found = {r["doc_id"]: r for r in made.collect()}
    assert found[401]["text"] is None and found[402]["text"] == "" and found[401]["found"] == []
    for i, text, _ in rows[:400]:
        spans = found[i]["found"]
        assert all(0 <= s["start"] < s["stop"] <= len(text) for s in spans) and len(found[i]["text"]) >= len(text) - 40
        kept = [text[a:b] for a, b in zip([0, *(s["stop"] for s in spans)], [*(s["start"] for s in spans), len(text)])]
        assert all(k in found[i]["text"] for k in kept)
    assert ps.pseudonymise(docs.limit(0), "key").count() == 0
    with pytest.raises(ValueError):
        ps.pseudonymise(docs, "")


def test_dates_of_one_and_two_digits_keep_their_form():
    for text in ("4/7/1981", "3.11.1999", "2021-3-5", "March 5, 2021", "5 March 2021", "1/31/2020", "04.7.1981"):
        made, found = ps.replace_all(f"on {text}.", KEY)
        assert [k for _, _, k in found] == ["date"] and made != f"on {text}." and shape(made.split()[1]) == shape(f"{text}.".split()[0])
        assert ps.replace_all(made, KEY, back=True)[0] == f"on {text}."


def test_a_day_has_one_pseudonym_in_all_forms():
    for n in range(0, 700):
        day = datetime.date(2020, 1, 1) + datetime.timedelta(n)
        forms = ["%Y-%m-%d", "%d/%m/%Y", "%d %B %Y"] + ["%m/%d/%Y"] * (day.day > 12)
        made = {datetime.datetime.strptime(new(day.strftime(f)), f) for f in forms}
        short = new(f"{day.day}.{day.month}.{day.year}").split(".")
        assert made == {datetime.datetime(int(short[2]), int(short[1]), int(short[0]))}, day


def test_values_with_digits_or_capitals_beside_them():
    card, iban = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"
    for text, value in ((f"{card} 12/26", card), ("4111111111111111 123", "4111111111111111"), (f"Qty 2 {card}", card), (f"{card} {card} 7", card),
                        ("4111-1111-1111-1111-12", "4111-1111-1111-1111"), (f"{iban} BIC COBADEFF", iban), (f"{iban} A transfer", iban), (f"AB12 {iban}", iban),
                        (f"{iban} {card}", card), ("DE89370400440532013000 BIC COBADEFF", "DE89370400440532013000"), ("555-123-4567 12", "555-123-4567"), ("12 555-123-4567", "555-123-4567")):
        made, found = ps.replace_all(text, KEY)
        at = text.index(value)
        assert (at, at + len(value)) in [(s, e) for s, e, _ in found], text
        assert made[at : at + len(value)] == new(value) and value not in made
        assert ps.replace_all(made, KEY, back=True)[0] == text


def test_cards_among_other_digits_come_back():
    random.seed(4)
    for _ in range(1500):
        payload = "".join(random.choices("0123456789", k=15))
        digits = payload + ps.luhn_digit(payload)
        form = random.choice([digits, " ".join(digits[i : i + 4] for i in range(0, 16, 4))])
        before, after = ("".join(random.choice(["", f"{random.randrange(10**n):0{n}d} "]) for n in random.choices([1, 2, 3, 4], k=2)) for _ in range(2))
        text = f"{before}{form} {after}."
        made, found = ps.replace_all(text, KEY)
        assert "card" in [k for _, _, k in found] and ps.replace_all(made, KEY, back=True)[0] == text
