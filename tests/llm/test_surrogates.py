import random
import re
import string
import time

from helpers import ODD_ROWS, SF, frame

from fleetspark.llm import surrogates as sg

KEY = b"test key"


def rewritten(text, key=KEY):
    return sg.rewrite(text, sg.mentions(text), sg.Keyed(key))


def test_types_formats_and_coreference():
    text = "Write to John.Smith+x@mail3.example.com, +1 (974) 555-3436 or +1 974 555 3436; 97.51.17.173; card 4539 5787 6362 1486 = 4539578763621486; 123-45-6789; DE89 3704 0044 0532 0130 00"
    out = rewritten(text)
    assert out != text and len(out) >= len(text) - 12
    for old in ("John.Smith", "974", "555", "97.51.17.173", "4539", "6789", "3704"):
        assert old not in out
    mail, phone1, phone2, ip, card1, card2 = re.search(
        r"to (\S+@\S+\.com), (\+1 \(\d{3}\) \d{3}-\d{4}) or (\+1 \d{3} \d{3} \d{4}); (\S+); card (\d{4} \d{4} \d{4} \d{4}) = (\d{16});", out).groups()
    digits = lambda x: re.sub(r"\D", "", x)
    assert digits(phone1) == digits(phone2) and digits(card1) == card2 and sg.luhn(card2) and card2[0] == "4"
    assert all(0 <= int(x) < 256 for x in ip.split("."))
    iban = re.search(r"DE[\d ]+$", out)[0].replace(" ", "")
    assert sg._mod97(iban) == 1
    assert re.fullmatch(r"[A-Z][a-z]{3}\.[A-Z][a-z]{4}\+[a-z]@.*", mail)
    assert rewritten(text) == out and rewritten(text, b"other") != out


def test_names_keep_gender_and_script():
    out = rewritten("Herr Klaus Müller and Frau Schmidt met Mary Smith and Иван Петров. Mr Smith left.")
    m = re.match(r"Herr (\w+) (\w+) and Frau (\w+) met (\w+) (\w+) and (\w+) (\w+)\. Mr (\w+) left\.", out).groups()
    assert m[0] in sg.GIVEN["latin", "m"] and m[3] in sg.GIVEN["latin", "f"] and m[5] in sg.GIVEN["cyrillic", "m"]
    assert m[4] == m[7] and re.fullmatch("[А-Я][а-я]+", m[6]) and m[6] != "Петров"


def test_ordinary_and_bare_names():
    text = "Novak first. Mr Bogdan Novak met David Miller, Emma Jones and Anna Weber; Novak's friend Miller and Bogdan left Emma. My name is Xaver Quill."
    out = rewritten(text)
    for old in ("Novak", "Bogdan", "Miller", "Jones", "Weber", "Quill", "Xaver"):
        assert old not in out
    m = re.match(r"(\w+) first\. Mr (\w+) (\w+) met (\w+) (\w+), (\w+) \w+ and \w+ \w+; (\w+)'s friend (\w+) and (\w+) left (\w+)\.", out).groups()
    assert m[0] == m[2] == m[6] and m[1] == m[8] and m[4] == m[7] and m[5] == m[9]
    assert sg.dress("surname", "Novak", sg.Keyed(KEY)) == m[0]


def test_plain_text_stays():
    for text in ("version 1.2.3.4.5 and 300.1.1.1 and 01.2.3.4", "call 12345 or 4417744280351548", "a @ b, x@y, 1-2-3", "Mary had; Mr x"):
        assert rewritten(text) == text


def test_permutations():
    for size in (1, 2, 7, 100, 1000):
        assert sorted(sg.permute(i, size, KEY, "t") for i in range(size)) == list(range(size))
    assert len({sg.surrogate("ssn", f"{i:03d}000000", KEY) for i in range(1000)}) == 1000


def test_every_given_name_changes():
    for key in (KEY, b"registered query"):
        for names in sg.GIVEN.values():
            drawn = [sg.surrogate("given", name, key) for name in names]
            assert sorted(drawn) == sorted(names) and all(a != b for a, b in zip(drawn, names))
    assert len(set().union(*sg.GIVEN.values())) == sum(map(len, sg.GIVEN.values()))


def test_collision_checks(spark):
    # a format of 26 addresses, of which 13 and then all occur: none may become another that occurs, and all stay distinct
    for letters in (string.ascii_lowercase[:13], string.ascii_lowercase):
        rows = [(i, f"to {c}@7.com and 5{i}", "x") for i, c in enumerate(letters)]
        out = [re.search(r"to (\S+) ", r["text"])[1] for r in sg.replace_personal_data(frame(spark, rows), KEY).collect()]
        assert len(set(out)) == len(rows) and not {x for _, t, _ in rows for x in re.findall(r"\S+@\S+", t)} & set(out)


def test_operator_on_documents_and_odd_rows(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    rows = ODD_ROWS + docs
    df = frame(spark, rows)
    out = sg.replace_personal_data(df, KEY)
    assert out.columns == [*df.columns, "entities_by_kind"]
    got = sorted(((r["doc_id"], r["text"], r["lang"]) for r in out.collect()), key=str)
    assert got == sorted(((i, rewritten(t) if t else t, x) for i, t, x in rows), key=str)
    for i, t, _ in docs:
        for s, e, _ in sg.mentions(t):
            assert t[s:e] not in rewritten(t)
    assert sg.replace_personal_data(frame(spark, []), KEY, count_col=None).count() == 0


def test_addresses_as_by_one_pattern():
    plain = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
    rnd = random.Random(5)
    texts = ["a@b.com.x@y.org", "a@@b.co", "@b.co", "a@b.co@c.de", "x a@b-.c1.ab2 y"] + ["".join(rnd.choices("ab1.-_@ @.é", k=30)) for _ in range(20_000)]
    for text in texts:
        assert list(sg._emails(text)) == [m.span() for m in plain.finditer(text)], text


def test_long_runs_take_time_by_their_size():
    for text in ("a" * 1_000_000 + " @", "a@" * 500_000, "a@" + "b." * 500_000 + "1", "a@" + "b" * 1_000_000, "1" * 1_000_000, "Ab" * 500_000):
        start = time.process_time()
        sg.mentions(text)
        assert time.process_time() - start < 10, text[:9]


def test_widened_surrogates_are_checked_too(spark, monkeypatch):
    monkeypatch.setattr(sg, "ROUNDS", 1)
    short = [("surname", a + b) for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "aeiou"]  # their format is used up
    longer = [("surname", sg.drawn("surname", v, KEY, 1)) for _, v in short[:20]]  # and so are some of the wider surrogates
    entities = spark.createDataFrame(sorted({*short, *longer}), "kind string, value string")
    odd = {r.value: r.surrogate for r in sg.exceptions(entities, KEY).collect()}
    new = {v: odd.get(v) or sg.surrogate("surname", v, KEY) for _, v in {*short, *longer}}
    assert len(set(new.values())) == len(new) and not set(new.values()) & set(new)
    assert all(len(new[v]) > 2 for _, v in short)
