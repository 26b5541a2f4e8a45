"""Personal data: base spans against Python's patterns, and the validated extra kinds."""

import hashlib
import random
import re

from squall.llm import pii, queries

from ..conftest import SF_SMALL

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def fine(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == 1:
        return all(int(p) <= 255 for p in match.split("."))
    if kind == 2:
        double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(n - 9 if n > 9 else n for n in double) % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def base(text):
    return [
        (k, m.start(), m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if fine(k, m[0])
    ]


def test_patterns_on_random_texts():
    r = random.Random(2)
    seen = [0] * 4
    for chars in ("a.@b-", "12.0", "0123456789 -", "+12 ().-3456789", "a1.@+ -25:/é", "0.25512"):
        for _ in range(4000):
            text = "".join(r.choice(chars) for _ in range(r.randint(0, 60)))
            want = base(text)
            assert [s for s in pii.scan(text) if s[0] < 4] == want, text
            for k, _, _ in want:
                seen[k] += 1
    assert min(seen) > 100


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op3_personal_data(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    total = 0
    for d in docs:
        want, g = base(d.text), got[d.doc_id]
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(s[0] == k for s in want) for k in range(4)]
        assert g.base_sha256 == hashlib.sha256(pii.shown(want).encode()).hexdigest()
        assert set(pii.shown(want).split(",")) - {""} <= set(g.spans.split(","))
        total += len(want)
    assert total > 0


def kinds(text):
    return [(pii.KINDS[k], text[a:b]) for k, a, b in pii.scan(text) if k >= 4]


def test_extra_kinds():
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00.") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("iban GB82WEST12345698765432") == [("iban", "GB82WEST12345698765432")]
    assert kinds("IBAN DE89 3704 0044 0532 0130 01") == []
    assert kinds("Account no. 1234-5678-90 of") == [("account", "1234-5678-90")]
    assert kinds("SSN 078-05-1120") == [("account", "078-05-1120")]
    assert kinds("the account of 1234567") == [] and kinds("account 12345") == []
    assert kinds("ftp://bob:secret@host.example/x http://host/a:b@c") == [("userinfo", "bob:secret")]


def test_numbers_in_front_of_words_and_numbers():
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947", "FR14-2004-1010-0505-0001-3M02-606", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    for iban in ibans:
        for behind in (" BIC: COBADEFFXXX", " The next", " T", " 1 USD", " 2024", ". BIC", "-A", ", X", "", " ok", "\nBIC"):
            for cue in ("IBAN ", "IBAN: ", "iban no. "):
                assert kinds(cue + iban + behind) == [("iban", iban)], cue + iban + behind
        assert kinds(f"IBAN {iban}X") == kinds(f"IBAN {iban}x") == kinds(f"IBAN {iban}1 A") == []
    assert kinds("IBAN DE89 3704 0044 0532 0130 01 BIC") == []
    assert kinds("account 12345678 98765432 12345678 of") == [("account", "12345678 98765432")]
    assert kinds("account 123456789012345678901") == []
    for text in ("compte 100 000 habitants", "On account 2019 2020 2021", "account 1 234 567", "konto 2024-01-31", "tax id 1999-2000"):
        assert kinds(text) == [], text
    for text in ("account 100 0000 12", "account 20 19 20 21 33", "account 2019 2020 2021 12", "account 000 123 456"):
        assert [k for k, _ in kinds(text)] == ["account"], text


def test_nulls_repeats_and_long_texts(spark):
    rows = [
        (1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (None, "+1 234 567 8901"),
        (4, "1" * 100000), (5, "1.2.3.4" * 20000), (6, "a" * 100000 + "@"), (7, "@" * 100000), (8, "😀 x@y.zz"), (9, "+1" + " " * 100000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.personal_data(docs).collect()
    want = [(i, hashlib.sha256(pii.shown(base(t)).encode()).hexdigest()) for i, t in rows]
    assert sorted(((r.doc_id, r.base_sha256) for r in got), key=repr) == sorted(want, key=repr)
    assert [r.spans for r in got if r.doc_id == 8] == ["email:2:8"]


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, spans int, n_email string"
    assert pii.personal_data(spark.createDataFrame([], schema)).count() == 0
    docs = spark.createDataFrame([(1, "a@b.co", 1, "x")], schema)
    assert pii.personal_data(docs).first().n_email == 1
