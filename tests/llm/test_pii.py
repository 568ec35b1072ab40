"""Operator 5: permutations, formats and links between equal values."""

import pytest
from bizlens.llm.pii import KEY, find, luhn, op5_pseudonyms, permute, pseudonymise, pseudonyms


@pytest.mark.parametrize("size", [2, 7, 97, 1000])
def test_permutation(size):
    assert {permute(x, size, b"k", "t") for x in range(size)} == set(range(size))
    odd = {permute(x, size, b"k", "t", lambda v: v % 2 == 1) for x in range(1, size, 2)}
    assert odd == set(range(1, size, 2))


@pytest.mark.parametrize("value, kind", [
    ("4111 1111 1111 1111", "card"), ("+1 (988) 555-2485", "phone"), ("988-555-2485", "phone"), ("192.168.1.20", "ip"), ("2024-02-29", "date"),
    ("31/12/1999", "date"), ("12/31/1999", "date"), ("1.2.2003", "date"), ("078-05-1120", "ssn"), ("Bob.Smith42@Mail8.Example.com", "email"),
    ("DE89 3704 0044 0532 0130 00", "iban"), ("GB82WEST12345698765432", "iban")])
def test_a_pseudonym_has_the_format(value, kind):
    text = f"it is {value}, said"
    made, found = pseudonymise(text, KEY)
    assert [f[2] for f in found] == [kind] and value not in made
    assert [f[2] for f in find(made, KEY)] == [kind]  # valid itself
    assert pseudonymise(text, b"other key")[0] != made
    if kind == "card":
        assert luhn("".join(c for c in made if c.isdigit())) % 10 == 0


@pytest.mark.parametrize("value", ["4111111111111112", "300.1.1.1", "1.2.3.4.5", "2023-02-29", "666-05-1120", "3.14159", "12345678901234567890", "order 1234567", "127.0.0.1", "DE00370400440532013000"])
def test_invalid_values_stay(value):
    assert pseudonymise(f"a {value} b", KEY) == (f"a {value} b", [])


def test_words_in_capitals_after_an_iban():
    made, found = pseudonymise("TO DE89 3704 0044 0532 0130 00 AS AGREED", KEY)
    assert [f[2] for f in found] == ["iban"] and made.endswith(" AS AGREED")


@pytest.mark.parametrize("text, value, kind", [
    ("4111 1111 1111 1111 12/25", "4111 1111 1111 1111", "card"), ("4111 1111 1111 1111 123", "4111 1111 1111 1111", "card"),
    ("2023 4111 1111 1111 1111", "4111 1111 1111 1111", "card"), ("2023 4111111111111111 12", "4111111111111111", "card"),
    ("2023-4111-1111-1111-1111-12", "4111-1111-1111-1111", "card"), ("+1 988 555 2485 12", "+1 988 555 2485", "phone")])
def test_values_beside_free_digits(text, value, kind):
    made, found = pseudonymise(text, KEY)
    at = text.index(value)
    assert [(a, b, k) for a, b, k, _ in found] == [(at, at + len(value), kind)]
    assert made == text.replace(value, pseudonymise(value, KEY)[0]) != text


def test_equal_values_stay_linked():
    plain, spaced = (pseudonymise(v, KEY)[0] for v in ("4111111111111111", "4111-1111-1111-1111"))
    assert plain == spaced.replace("-", "")
    iso, other = (pseudonymise(v, KEY)[0] for v in ("1999-12-31", "31.12.1999"))
    assert iso.split("-") == other.split(".")[::-1]
    values = [f"{k % 200 + 1}.{k // 200}.7.9" for k in range(2000)]
    assert len({pseudonymise(v, KEY)[0] for v in values}) == len(set(values))


def test_equal_phones_stay_linked():
    digits = lambda v: "".join(c for c in pseudonymise(v, KEY)[0] if c.isdigit())
    for forms in (["+1 988-555-2485", "+19885552485", "+1 (988) 555-2485", "+1.988.555.2485"], ["+44 20 7946 0958", "+442079460958", "+44 2079 460958"],
                  ["+35312345678", "+353 12 345 678"]):
        assert len({digits(v) for v in forms}) == 1 and digits(forms[0]) != "".join(c for c in forms[0] if c.isdigit())
        assert all(len(pseudonymise(v, KEY)[1]) == 1 for v in forms)
    assert digits("988-555-2485") == digits("+19885552485")[1:] and digits("+44 (0)20 7946 0958").replace("440", "44", 1) == digits("+442079460958")
    made = {digits(f"+1988555{k:04d}") for k in range(3000)} | {digits(f"+1088555{k:04d}") for k in range(3000)}
    assert len(made) == 6000  # one to one


def test_query_changes_found_spans_only(spark, small_dir, texts):
    got = {r["doc_id"]: r for r in op5_pseudonyms(spark, small_dir).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        spans = [(int(a), int(b)) for _, a, b in (s.split(":") for s in got[i]["pii_spans"].split(",") if s)]
        assert got[i]["pii_count"] == len(spans)
        kept, at = [], 0  # what lies between the spans
        for a, b in spans:
            assert t[a:b] not in got[i]["text"]
            kept.append(t[at:a])
            at = b
        rest = got[i]["text"]
        for part in [*kept, t[at:]]:
            assert part in rest
            rest = rest[rest.index(part) + len(part) :]
        assert spans or got[i]["text"] == t


def test_odd_rows(odd, none):
    assert pseudonyms(odd).columns == [*odd.columns, "pii_count", "pii_spans"]
    assert sorted(map(str, pseudonyms(odd).drop("pii_count", "pii_spans").collect())) == sorted(map(str, odd.collect()))
    assert pseudonyms(none).count() == 0
