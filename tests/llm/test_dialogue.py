"""Conversation repair: the recursion against every edit sequence, chunked runs against whole ones, damage and digests."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from squall.llm import dialogue, queries

from ..conftest import SF_ORACLE, SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\f\r"


def faults(rows):
    """The fault of each (role, text): blank, duplicate, truncated or none."""
    seen, out = set(), []
    for role, text in rows:
        end = text.rstrip(SPACE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def best(rows):
    """(cost, audit, repaired rows) by trying every path, step by step, over (written initials, last) with whole audits."""
    reached = {"": (0, "", [])}

    def legal(initials):
        return re.fullmatch(r"s?(ua)*u?", initials)

    def key(initials):  # what may follow depends on the kind of the last turn alone
        return "" if not initials else initials[-1]

    def grown(paths, ways):
        out = {}
        for state, (cost, audit, made) in paths.items():
            for add, edit, turn in ways(state, made):
                initials = state + turn[0][:1] if turn else state
                if turn and (not turn[0][:1] or not legal("".join(t[0][:1] for t in made) + turn[0][:1])):
                    continue
                got = (cost + add, audit + edit, made + [turn] if turn else made)
                name = key(initials)
                if name not in out or got[:2] < out[name][:2]:
                    out[name] = got
        return out

    def inserted(paths):
        found = dict(paths)
        for _ in range(3):
            new = grown(paths, lambda s, m: [(5, "I", (r, "")) for r in ("user", "assistant")])
            for name, got in new.items():
                if name not in found or got[:2] < found[name][:2]:
                    found[name] = got
            paths = new
        return found

    for (role, text), fault in zip(rows, faults(rows)):
        left = 5 if fault == "truncated" else 0
        ways = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            ways += [(left, "K", (role, text)), (1 + left, "R", ("user", text)), (1 + left, "R", ("assistant", text))]
        # every insert count apart: the cheapest of each state alone would hide ties
        options = [reached]
        for _ in range(2):
            options.append(grown(options[-1], lambda s, m: [(5, "I", (r, "")) for r in ("user", "assistant")]))
        merged = {}
        for option in options:
            for name, got in grown(option, lambda s, m, ways=ways: ways).items():
                if name not in merged or got[:2] < merged[name][:2]:
                    merged[name] = got
        reached = merged
    ends = [v for v in inserted(reached).values() if re.fullmatch(r"(s?(ua)+)?", "".join(t[0][0] for t in v[2]))]
    return min(ends, key=lambda v: v[:2])


def every(rows):
    """(cost, audit) by enumerating all edit sequences with at most two inserts at a place."""
    bad = faults(rows)
    found = []
    gaps = ["", "I", "II"]
    for inserts in product(gaps, repeat=len(rows) + 1):
        for edits in product("KRD", repeat=len(rows)):
            cost = 5 * sum(map(len, inserts))
            letters, audit = "", ""
            for (role, _), fault, gap, edit in zip(rows, bad, inserts, edits):
                audit += gap + edit
                letters += "?" * len(gap)
                if edit == "D":
                    cost += 2
                    continue
                if fault in ("blank", "duplicate"):
                    break
                cost += (edit == "R") + (5 if fault == "truncated" else 0)
                letters += role[0] if edit == "K" else "?"
            else:
                audit += inserts[-1]
                letters += "?" * len(inserts[-1])
                body = letters[1:] if letters[:1] == "s" else letters
                pairs = len(body) % 2 == 0 and all(c in ("?", "ua"[i % 2]) for i, c in enumerate(body))
                if pairs and (body or not letters):
                    found.append((cost, audit))
    return min(found)


def solved(rows):
    codes = bytearray()
    for (role, _), fault in zip(rows, faults(rows)):
        at = dialogue.INITIALS.find(role[:1]) if role else -1
        flag = {"blank": dialogue.MUST_GO, "duplicate": dialogue.MUST_GO, "truncated": dialogue.CUT_OFF}.get(fault, 0)
        codes.append((at if at >= 0 else 3) + flag)
    tables = [dialogue.TABLES[c] for c in codes]
    end, cost = dialogue.last_state(tables)
    return cost, dialogue.audit(bytes(codes), dialogue.START, end) + dialogue.TAIL[end]


def some_rows(r, n):
    texts = ["Yes.", "No!", "Well", "", " ", "Is it?", "So. ", "and then\n"]
    return [(r.choice(["system", "user", "assistant", "user", "assistant", "tool"]), r.choice(texts)) for _ in range(n)]


def test_recursion_is_cheapest_and_audit_least():
    r = random.Random(1)
    for n in [1, 1, 2, 2, *[3] * 60, *[4] * 12]:
        rows = some_rows(r, n)
        assert solved(rows) == every(rows) == best(rows)[:2], rows


def test_recursion_on_longer_conversations():
    r = random.Random(2)
    for _ in range(150):
        rows = some_rows(r, r.randint(5, 60))
        rows = [(role, text and f"{text}{i if r.random() < 0.8 else ''}{r.choice(['.', '?', ''])}") for i, (role, text) in enumerate(rows)]
        assert solved(rows) == best(rows)[:2], rows


def test_tables_join_like_rows():
    r = random.Random(3)
    for _ in range(100):
        codes = bytes(r.randrange(16) for _ in range(r.randint(2, 30)))
        cut = sorted(r.sample(range(1, len(codes)), min(len(codes) - 1, 3)))
        pieces = [codes[a:b] for a, b in zip([0, *cut], [*cut, len(codes)])]
        tables = [dialogue.summary(p) for p in pieces]
        end, cost = dialogue.last_state(tables)
        whole_end, whole_cost = dialogue.last_state([dialogue.TABLES[c] for c in codes])
        assert (end, cost) == (whole_end, whole_cost)
        path = dialogue.crossings(tables, 0, len(tables), dialogue.START, end)
        assert "".join(dialogue.audit(pieces[i], a, b) for i, a, b in path) == dialogue.audit(codes, dialogue.START, end)


def damaged(conv, turn, role, text):
    """The rows that stand for one row after damage."""
    name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    kind = zlib.crc32(name.encode()) % 20
    role, text = " " if role is None else role, " " if text is None else text
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    if kind == 4:
        role = "user"
    return [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)


def report(table):
    """The whole result, from plain rows."""
    by = {}
    for conv, turn, role, text in table:
        by.setdefault(conv, []).extend(damaged(conv, turn, role, text))
    out = []
    for conv, rows in by.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2][:64], hashlib.md5(f"{len(x[1].encode())}:{x[1]}:{x[2]}".encode()).hexdigest()))
        turns = {t for t, _, _ in rows if t is not None}
        pairs = [(role, text) for _, role, text in rows]
        bad = faults(pairs)
        cost, audit, made = best(pairs) if pairs else (0, "", [])
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
        out.append((conv, gaps, *(bad.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0))


def collected(df):
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=lambda x: (x[0] is not None, x[0] or 0))


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_ORACLE])
def test_whole_table(spark, sf_dir):
    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(queries.op13_conversation_repair(spark, sf_dir)) == report(table)


def test_one_conversation_over_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(dialogue.Repair.__init__, "__defaults__", (2,))
    r = random.Random(4)
    table = [(7, i, *x) for i, x in enumerate(some_rows(r, 90))]
    table += [(8, 5, "user", "All the same.")] * 40 + [(9, i // 3, "assistant", f"Word {i % 5}.") for i in range(40)]
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    assert collected(dialogue.repair_report(df)) == report(table)
    # the repaired turns themselves, place by place
    done = dialogue.Repair(dialogue.damaged(df))
    turns = sorted(done.repaired().collect(), key=lambda x: (x.conv, x.chunk, x.place))
    for conv in (7, 8, 9):
        letters = "".join(t.role[0] for t in turns if t.conv == f"c{conv}")
        assert re.fullmatch("(s?(ua)+)?", letters)


def test_nulls_ties_empty_and_clashing_columns(spark):
    table = [
        (None, None, "user", "Hello."), (None, 1, None, None), (None, 1, "", "Empty role."), (1, None, "system", "Rule."), (1, None, None, "x"),
        (1, 3, "user", None), (1, 9, "assistant", "Yes."), (2, 0, "user", "a" * 100_000 + "."), (2, 1, "assistant", "b" * 70 + "1."),
        (2, 1, "assistant", "b" * 70 + "2."), (2, 1, "assistant", "b" * 70 + "2."), (3, 0, "system", "Only."), (4, 0, "User", "Capital."),
        (5, -3, "assistant", " "), (5, 4, "user", "\n.\t "),
    ]
    table += [(c, 0, "user", "x.") for c in range(20, 60)]  # some of these lose their only row
    df = spark.createDataFrame(table, SCHEMA)
    wide = df.selectExpr("*", "1 AS chunk", "2 AS POS", "'k' AS key", "3 AS conv", "4 AS col")
    got = collected(dialogue.repair_report(wide))
    assert got == report(table)
    assert any(x[7] == "" and x[8] == hashlib.sha256(b"").hexdigest() for x in got)
    assert collected(dialogue.repair_report(df.limit(0))) == []
