import random
import re
import time

import pytest

from contactmill.llm import pii, queries


@pytest.mark.parametrize("text, kinds", [
    ("mail Jo.Doe+x@Mail.Example.org.", ["email"]),
    ("ip 10.2.3.255 and 1.2.3.4.5 and 256.1.1.1", ["ip"]),
    ("card 4111 1111 1111 1111, not 4111 1111 1111 1112 nor 9999888877776666", ["card"]),
    ("call +1 (743) 555-3220 or (555) 123-4567 or 555-123-4567x", ["phone", "phone", "phone"]),
    ("ssn 123-45-6789 but 000-45-6789", ["ssn"]),
    ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', ["secret"]),
    ("Mr. John Smith met Frau Müller. Smith left.", ["given_m", "surname", "surname", "surname"]),
    ("In 2024 we sold 12,345 items; The Best. 2024-01-02", []),
])
def test_find(text, kinds):
    assert [e.type for e in pii.find(text)] == kinds


def test_surrogates_keep_type_and_format():
    rng = random.Random(4)
    samples = ["jo.81@mail7.example.com", "JO@X.ORG", "97.51.17.173", "+1 (743) 555-3220", "4845 1681 1440 7329", "123-45-6789"]
    for text in samples:
        new, n, kinds = pii.replace(text, {})
        assert n == 1 and new != text and [e.type for e in pii.find(new)] == kinds
        assert re.sub(r"[^\W_]", "", new) == re.sub(r"[^\W_]", "", text) or kinds == ["email"]
    for _ in range(200):
        number = "4" + "".join(rng.choices("0123456789", k=14))
        number += next(c for c in "0123456789" if pii.luhn(number + c))
        assert pii.luhn(pii.surrogate("card", number))
    a, b = pii.replace("Mr. John Smith wrote to Mrs. SMITH", {})[0].split(" wrote to Mrs. ")
    assert a.split()[-1].upper() == b and re.search("(ro|rus|nan|ter)$", a.split()[1])
    cyrillic = pii.replace("Иван Петров", {})[0]
    assert re.fullmatch("[А-Яа-я]+ [А-Яа-я]+", cyrillic)
    assert pii.surrogate("ssn", "123-45-6789", key=b"other") != pii.surrogate("ssn", "123-45-6789")


def test_clashes_are_solved(spark):
    """With names drawn from a small range, one pass makes all of them distinct."""

    def narrow(kind, canonical, rank, key):
        return f"{kind}{pii._Draw(key, kind, canonical).below(7)}" + "x" * rank

    known = spark.createDataFrame([(k, f"s{i}") for i in range(40) for k in pii.NAMES], "type string, canonical string")
    again = {(r["type"], r["canonical"]): r["rank"] for r in pii.clashes(known, pii.KEY, narrow).collect()}
    final = [narrow(k, f"s{i}", again.get((k, f"s{i}"), 0), pii.KEY) for i in range(40) for k in pii.NAMES]
    assert len(again) >= 4 * (40 - 7) and len(set(final)) == 160


def test_names_of_all_ranks_differ():
    made = [pii.surrogate(k, f"n{i}", r) for k in pii.NAMES for i in range(60) for r in range(120)]
    drawn = {pii.surrogate(k, f"n{i}") for k in pii.NAMES for i in range(60)}
    assert len(drawn) == 240 and len(set(made)) == len(made)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 26, 1000, 4097])
def test_cycles_are_permutations_without_fixed_points(size):
    """Against the plain definition: every number has one image, and all are on one cycle."""
    step = pii._Cycle(size, b"k", "t")
    assert sorted(map(step, range(size))) == list(range(size))
    x, seen = 0, set()
    while x not in seen:
        seen.add(x)
        x = step(x)
    assert len(seen) == size


def test_whole_small_spaces():
    """All one-digit addresses, and all short passwords of a format, get distinct surrogates."""
    ips = [f"{i // 1000}.{i // 100 % 10}.{i // 10 % 10}.{i % 10}" for i in range(10_000)]
    new = [pii.surrogate("ip", x) for x in ips]
    assert sorted(new) == sorted(ips) and all(a != b for a, b in zip(ips, new))
    words = [a + b + c for a in "abcdefghij" for b in "0123456789" for c in "ABCDEFGHIJ"]
    new = [pii.surrogate("secret", x) for x in words]
    assert len(set(new)) == 1000 and all(re.fullmatch("[a-z][0-9][A-Z]", x) for x in new)
    hosts = {pii.surrogate("email", f"u{i}@host.de").partition("@")[2] for i in range(50)}
    assert len(hosts) == 1 and hosts != {pii.surrogate("email", "u1@host.fr").partition("@")[2]}


def test_long_texts_take_linear_time():
    rng = random.Random(2)
    began = time.time()
    assert not pii.find("QUJD" * 1_300_000)
    assert not pii.find("a1" * 500_000 + "@" + "b." * 500_000)
    mails = " ".join(f"u{i}@h{i}.org" for i in range(20_000))
    assert len(pii.find(mails)) == 20_000
    people = " ".join(f"Mr. {rng.choice('BDFG')}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}" for i in range(5_000))
    assert len(pii.find(people + " and " + people.replace("Mr. ", ""))) == 10_000
    long_secret = "password: " + "aB3$" * 100_000
    assert len(pii.replace(long_secret, {})[0]) == len(long_secret)
    assert time.time() - began < 60


def test_planted_entities():
    """Texts put together from words and known entities: these are found, and nothing else is."""
    rng = random.Random(8)

    def card():
        body = "4" + "".join(rng.choices("0123456789", k=14))
        return body + next(c for c in "0123456789" if pii.luhn(body + c))

    makers = {
        "email": lambda: f"{rng.choice(['ann', 'b.c', 'd_e+f'])}{rng.randint(1, 99)}@{rng.choice(['x', 'mail.y-z'])}.{rng.choice(['org', 'de'])}",
        "ip": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        "card": card,
        "ssn": lambda: f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}",
        "phone": lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}",
    }
    for _ in range(300):
        parts, want = [], []
        for _ in range(rng.randint(1, 12)):
            parts.append(" ".join(rng.choices("some plain words without anything in 2024 or 12,345".split(), k=rng.randint(1, 6))))
            kind = rng.choice([*makers, None])
            if kind:
                parts.append(makers[kind]())
                want.append((kind, parts[-1]))
        text = ", ".join(parts)
        assert [(e.type, text[e.start : e.stop]) for e in pii.find(text)] == want
        new = pii.replace(text, {})[0].split(", ")
        for before, after in zip(parts, new):
            assert (before == after) == (before not in [v for _, v in want])


def test_over_tables(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    old = {r["doc_id"]: r["text"] for r in docs.collect()}
    new = {r["doc_id"]: r for r in queries.op10_pii(spark, tiny).collect()}
    assert sorted(old) == sorted(new)
    forward, backward, n = {}, {}, 0
    for d, text in old.items():
        before = pii.find(text or "")
        after = pii.find(new[d]["text"] or "")
        assert new[d]["n_entities"] == len(before)
        if not before:
            assert new[d]["text"] == text
            continue
        assert [e.type for e in before] == [e.type for e in after]
        for a, b in zip(before, after):
            n += 1
            assert forward.setdefault((a.type, a.canonical), b.canonical) == b.canonical
            assert backward.setdefault((b.type, b.canonical), a.canonical) == a.canonical
    assert n > 5 and all(a[1] != b for a, b in forward.items())


def test_edges(spark):
    data = [(1, None, 1), (2, "", 2), (3, "a 1.2.3.4 b 5.6.7.8", 3), (3, "a 1.2.3.4 b 5.6.7.8", 3), (None, "x 5.6.7.8", 4)]
    df = spark.createDataFrame(data, "doc_id long, text string, n_entities int")
    assert pii.pseudonymise(df.limit(0)).count() == 0
    rows = pii.pseudonymise(df).collect()
    assert sorted((r["doc_id"] or 0, r["n_entities"]) for r in rows) == [(0, 1), (1, 0), (2, 0), (3, 2), (3, 2)]
    assert next(r for r in rows if r["doc_id"] == 1)["text"] is None


@pytest.mark.parametrize("room", [1 << 30, 0])
def test_names_told_apart(spark, monkeypatch, room):
    """Texts get the ranks of the names in them, whether all workers know them or a join brings them."""
    changed = spark.createDataFrame([("surname", "smith", 3)], "type string, canonical string, rank int")
    monkeypatch.setattr(pii, "clashes", lambda known, key: changed)
    monkeypatch.setattr(pii, "BROADCAST_BYTES", room)
    data = [(1, None, 1), (2, "none", 2), (3, "Mr. Miller b Mr. Smith", 3), (3, "Mr. Miller b Mr. Smith", 3), (4, "Mrs. Smith x", 4)]
    df = spark.createDataFrame(data, "doc_id long, text string, ranks int")
    first, again = pii.surrogate("surname", "miller").capitalize(), pii.surrogate("surname", "smith", 3).capitalize()
    want = [(1, None), (2, "none"), *[(3, f"Mr. {first} b Mr. {again}")] * 2, (4, f"Mrs. {again} x")]
    rows = pii.pseudonymise(df).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in rows), key=lambda r: r[0]) == want
    assert all(r["ranks"] == r["doc_id"] for r in rows)


@pytest.mark.parametrize("text, kinds", [
    ("137.187.58.226 4845168114407329", ["ip", "card"]),
    ("order 12 4845 1681 1440 7329", ["card"]),
    ("room 7-4845-1681-1440-7329 12", ["card"]),
    ("4845168114407329 226 and 4845168114407329 4111111111111111", ["card", "card", "card"]),
    ("4845 1681 1440 7329 4111 1111 1111 1111 4845-1681-1440-7329", ["card", "card", "card"]),
    ("+1 (743) 555-3220 137.187.58.226", ["phone", "ip"]),
    ("+1 (743) 555-3220 4845168114407329", ["phone", "card"]),
    ("+1 (743) 555-3220 12345 678", ["phone"]),
    ("1234 9999888877776666 12", []),
])
def test_neighbours_do_not_hide_entities(text, kinds):
    found = pii.find(text)
    assert [e.type for e in found] == kinds
    assert {e.canonical for e in found if e.type == "card"} <= {"4845168114407329", "4111111111111111"}


@pytest.mark.parametrize("text, values", [
    ("password: Xy12345678", ["Xy12345678"]),
    ("Password = a!b.c#d$e, next", ["a!b.c#d$e"]),
    ("pwd=x; passwd: 'it is \\' me'", ["x", "it is \\' me"]),
    ('{"password": "s3cr.t", "user": "jo"}', ["s3cr.t"]),
    ("db_password='open", ["open"]),
    ("Password:\nForgot it? pwd:\nab12", ["ab12"]),
    ('api_key = "ab12cd34" token: abcd', ["ab12cd34"]),
    ("token: eyJhbGciOiJIUzI1NiJ9", ["eyJhbGciOiJIUzI1NiJ9"]),
    ("The secret: practising. Password: ... Forgot the key: nothing", []),
])
def test_short_credentials(text, values):
    assert [e.canonical for e in pii.find(text) if e.type == "secret"] == values
    new, n, _ = pii.replace(text, {})
    assert n == len(values) and [e.type for e in pii.find(new)] == ["secret"] * n


def test_short_passwords_do_not_run_out(spark):
    texts = [(i, f"pwd: {c}") for i, c in enumerate([*"0123456789abcdefghij", "!!!", "12", "a1"])]
    rows = pii.pseudonymise(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    new = [r["text"] for r in rows]
    assert all(r["n_entities"] == 1 for r in rows)
    assert len(set(new)) == len(texts) and all(a != b for a, (_, b) in zip(new, texts))
