import duckdb
import pytest
import regex

from gridtide.llm import surrogates
from gridtide.llm.catalogue import QUERIES
from gridtide.llm.surrogates import _luhn, detect, render, replace_personal, surrogate

KEY = b"k"
FOLDER = "/root/testdata/sf0.01"


def replaced(text, key=KEY):
    out, at = [], 0
    for m in detect(text):
        out += [text[at : m.begin], render(m, surrogate(key, m.kind, m.canon))]
        at = m.end
    return "".join(out) + text[at:]


def kinds(text):
    return [(m.kind, m.text) for m in detect(text)]


def test_detection():
    assert kinds("Mail a.b+c@x-y.example.com, or (ring) +1 (543) 555-1435.") == [("email", "a.b+c@x-y.example.com"), ("phone", "+1 (543) 555-1435")]
    assert kinds("10.0.0.1 and 300.1.1.1 and 1.2.3.4.5") == [("ip", "10.0.0.1")]
    assert kinds("9807915762804490, 4111-1111-1111-1111") == [("account", "9807915762804490"), ("account", "4111-1111-1111-1111")]
    assert kinds("Mrs. Jane Doe and Herr Müller, Госпожа Иванова") == [("person", "Jane Doe"), ("person", "Müller"), ("person", "Иванова")]
    assert kinds("In 2024 there were 12 of 3,000. deadbeef1234") == []


def test_account_formats():
    old = "078-05-1120, DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432."
    was, now = detect(old), detect(replaced(old))
    assert [m.kind for m in was] == [m.kind for m in now] == ["ssn", "iban", "iban"]
    assert [[c.isdigit() for c in m.text] for m in was[:2]] == [[c.isdigit() for c in m.text] for m in now[:2]]
    assert all(surrogates._mod97(m.canon) == 1 for m in was[1:] + now[1:]) and now[1].text.startswith("DE")
    assert all(a.canon != b.canon for a, b in zip(was, now))


def test_surrogates_keep_format():
    old = "jo.81@mail4.example.com JO.81@MAIL4.EXAMPLE.COM 4111-1111-1111-1111 192.168.3.4 +1 (543) 555-1435 Mrs. Jane Doe, Mr JOHN DOE, Госпожа Иванова"
    new = replaced(old)
    was, now = detect(old), detect(new)
    assert [m.kind for m in was] == [m.kind for m in now]
    assert now[0].canon == now[1].canon and now[1].text.isupper()
    assert now[0].text.endswith(".com") and len(now[0].text) == len(was[0].text)
    assert now[2].text[4] == "-" and _luhn(now[2].canon) == 0 and now[3].text.startswith("192.168.")
    assert now[4].text[:4] == "+1 (" and now[5].text.split()[0] in surrogates.GIVEN["f", "latin"]
    assert now[6].text.isupper() and surrogates.script_of(now[7].text) == "cyrillic"
    assert all(a.canon != b.canon for a, b in zip(was, now))
    assert replaced(old) == new != replaced(old, b"other")


@pytest.mark.parametrize("limit", [200_000, -1])
def test_collisions(spark, monkeypatch, limit):
    """Many persons for few names: all stay different, none becomes another that occurs, spellings agree."""
    monkeypatch.setattr(surrogates, "BROADCAST_ROWS", limit)
    names = [f"Mr A{'bcdefghijz'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxy'[k // 100]} Doe" for k in range(500)] + ["Mr Adrian Abel"]
    texts = [f"{a} met {b}; {a.upper().replace('MR', 'Mr')}." for a, b in zip(names, names[1:])]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, entities int")
    got = {r.doc_id: r for r in replace_personal(docs, KEY).collect()}
    assert len(got) == len(texts)
    became = {}
    for k, text in enumerate(texts):
        was, now = detect(text), detect(got[k].text)
        assert [(e.kind, e.begin, e.end) for e in got[k].entities] == [(m.kind, m.begin, m.end) for m in was]
        assert now[0].canon == now[2].canon and now[2].text.isupper()
        for a, b in zip(was, now):
            assert became.setdefault(a.canon, b.canon) == b.canon
    assert len(set(became.values())) == len(became) == 501
    assert not set(became.values()) & set(became)


def test_whole_table(spark):
    got = {r.doc_id: r for r in QUERIES["op6_pii_surrogates"](spark, FOLDER).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    became = {}
    for k, text in rows:
        was, now = detect(text), detect(got[k].text)
        assert got[k].n_entities == len(was) == len(now)
        for a, b in zip(was, now):
            assert a.kind == b.kind and became.setdefault((a.kind, a.canon), b.canon) == b.canon
    assert len({(k, b) for (k, _), b in became.items()}) == len(became) > 20
    assert not {(k, b) for (k, _), b in became.items()} & set(became)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, "a@b.example.org"), (2, "a@b.example.org"), (None, "a@b.example.org " * 20_000), (3, "@" * 5000 + "1" * 5000)], "doc_id long, text string")
    got = replace_personal(docs, KEY).collect()
    assert len(got) == 6 and [r.text for r in got[:2]] == ["", ""]
    assert got[2].text == got[3].text == got[4].text.split()[0] != "a@b.example.org" and len(got[4].entities) == 20_000
    assert replace_personal(docs.limit(0), KEY).count() == 0


def test_numbers_beside_each_other():
    """Each of two adjacent numbers is found as it is found alone."""
    alone = {
        "phone": ["+1 (826) 555-4081", "(826) 555-4081", "826-555-4081", "+49 30 1234-5678"],
        "ip": ["190.137.223.204", "10.0.0.1", "192.168.10.20"],
        "account": ["4111-1111-1111-1111", "4111 1111 1111 1111", "9807915762804490"],
        "ssn": ["078-05-1120"],
        "iban": ["DE89 3704 0044 0532 0130 00", "BE68 5390 0754 7034"],
        None: ["17", "2024", "12"],
    }
    every = [(kind, text) for kind, texts in alone.items() for text in texts]
    for a, left in every:
        for b, right in every:
            if (a, b) != (None, None):
                assert kinds(f"{left} {right}") == [(k, t) for k, t in ((a, left), (b, right)) if k], (left, right)
    assert kinds("+49 (30) 1234 5678 9012 3456 7890 10.0.0.1")[-1] == ("ip", "10.0.0.1")
    assert kinds("+44 20 7946 0958 2024") == [("phone", "+44 20 7946 0958")]


def persons(text):
    return [(m.text, m.canon) for m in detect(text) if m.kind == "person"]


def test_persons_are_linked_within_a_document(spark):
    anna = "f:latin:anna weber"
    old = "Dr Anna Weber came. Ms Weber and Frau Anna Weber, Anna Weber's dog; Weber, ANNA WEBER and Prof. Dr. Weber; Anna. The Weberei stays, and so does weber."
    assert persons(old) == [(t, anna) for t in ("Anna Weber", "Weber", "Anna Weber", "Anna Weber", "Weber", "ANNA WEBER", "Weber", "Anna")]
    given, family = render(detect(old)[0], surrogate(KEY, "person", anna)).split(" ")
    assert given in surrogates.GIVEN["f", "latin"] and family != "Weber"
    new = f"Dr {given} {family} came. Ms {family} and Frau {given} {family}, {given} {family}'s dog; {family}, {given.upper()} {family.upper()} and Prof. Dr. {family}; {given}. The Weberei stays, and so does weber."
    assert replaced(old) == new
    assert replace_personal(spark.createDataFrame([(1, old)], "doc_id long, text string"), KEY).first().text == new
    assert [t for t, _ in persons("Doe said so. Jane Doe left. Mrs. Jane Doe and Jane Doe, Doe.")] == ["Jane Doe"] * 3 + ["Doe"]


def test_different_persons_are_not_linked():
    assert persons("Frau Anna Weber, Herr Karl Weber, Herr Weber, Frau Weber, Weber") == [
        ("Anna Weber", "f:latin:anna weber"), ("Karl Weber", "m:latin:karl weber"), ("Weber", "m:latin:karl weber"), ("Weber", "f:latin:anna weber"), ("Weber", "m:latin:karl weber"),
    ]
    assert persons("Mrs Jane Doe met Mr Doe and Mr Smith Mrs Jones.") == [("Jane Doe", "f:latin:jane doe"), ("Doe", "m:latin:doe"), ("Smith", "m:latin:smith"), ("Jones", "f:latin:jones")]
    assert persons("Ms Anna Maria Weber, Ms Anna Weber, Maria") == [(t, "f:latin:anna maria weber") for t in ("Anna Maria Weber", "Anna Weber", "Maria")]
    assert persons("Господин Иванов. Иванов пришёл.") == [("Иванов", "m:cyrillic:иванов")] * 2


def test_full_forms_are_permuted(spark):
    """More addresses of a range than could be drawn apart: it ends, all stay different and in their range."""
    old = [f"192.168.{k // 200}.{k % 200 + 1}" for k in range(40_000)] + [f"10.0.{k // 250}.{k % 250}" for k in range(500)]
    texts = [" ".join(old[k : k + 500]) for k in range(0, len(old), 500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = replace_personal(docs, KEY).orderBy("doc_id").collect()
    new = [w for r in rows for w in r.text.split(" ")]
    assert len(new) == len(old) == len(set(new))
    assert all(a.split(".")[0] == b.split(".")[0] and len(detect(b)) == 1 and (a[0] != "1" or a[:7] != "192.168" or b[:8] == "192.168.") for a, b in zip(old, new))
    assert len(set(new[:40_000]) & set(old[:40_000])) < 40_000 and not set(new[40_000:]) & set(old)


@pytest.mark.parametrize("kind, numbers", [("ip", [f"192.168.{k}.{j}" for k in range(0, 256, 5) for j in range(256)]), ("phone", [f"{k:04d}" for k in range(10_000)]), ("account", [f"41{k:011d}" for k in range(0, 99_999_999_999, 9_999_991)][:4000]), ("ip", ["8.8.8.8", "9.9.9.9", "126.0.0.1"])])
def test_permutations(kind, numbers):
    made = [surrogates.permuted(KEY, kind, n) for n in numbers]
    assert len(set(made)) == len(numbers)
    assert [surrogates.form_of(kind, m) for m in made] == [surrogates.form_of(kind, n) for n in numbers]
    if kind == "account":
        assert [_luhn(m) == 0 for m in made] == [_luhn(n) == 0 for n in numbers]
    if kind == "phone":
        assert sorted(made) == numbers


def test_long_names():
    assert kinds("Herr Ludwig van Beethoven, Mr Juan Carlos Maria Ortega Ruiz and Mme de Gaulle met Dr. J. Smith.") == [
        ("person", "Ludwig van Beethoven"), ("person", "Juan Carlos Maria Ortega Ruiz"), ("person", "de Gaulle"), ("person", "J. Smith")
    ]
    new = replaced("Herr Ludwig van Beethoven saw Dr. J. Smith")
    assert regex.fullmatch(r"Herr \p{Lu}\S+ van \p{Lu}\S+ saw Dr\. \p{Lu}\. \p{Lu}\S+", new) and "Beethoven" not in new and "Smith" not in new
