import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from opsmart.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
SYMBOLS = "suaoSUAOx"


def cheapest(symbols):
    """Uniform-cost search over (row, roles so far): the least (cost, audit)."""
    best, queue = {}, [(0, "", 0, 0)]
    while queue:
        cost, audit, at, state = heapq.heappop(queue)
        if (at, state) in best:
            continue
        best[at, state] = (cost, audit)
        for role in "ua":
            to = repair.STEP.get((state, role))
            if to is not None:
                heapq.heappush(queue, (cost + 3, audit + "I", at, to))
        if at == len(symbols):
            continue
        c = symbols[at]
        heapq.heappush(queue, (cost + 4, audit + "D", at + 1, state))
        if c != "x":
            for role, price, edit in ((c.lower(), 0, "K"), ("u", 3, "R"), ("a", 3, "R")):
                to = repair.STEP.get((state, role))
                if to is not None:
                    heapq.heappush(queue, (cost + price + 3 * c.isupper(), audit + edit, at + 1, to))
    return min(best[len(symbols), s] for s in (0, 3) if (len(symbols), s) in best)


def enumerated(symbols):
    """Every edit script with up to three insertions in a gap."""
    found = []
    gaps = [""] if not symbols else ["", "I", "II", "III"]
    for edits in itertools.product("DKR", repeat=len(symbols)):
        if any(c == "x" and e != "D" for c, e in zip(symbols, edits)):
            continue
        for ins in itertools.product(gaps, repeat=len(symbols) + 1):
            audit = ins[0] + "".join(e + i for e, i in zip(edits, ins[1:]))
            n = len(audit) - audit.count("D")
            pattern = ("s" if n % 2 else "") + "ua" * (n // 2)
            if n == 1:
                continue
            out, at, legal, cost = 0, 0, True, 0
            for e in audit:
                if e == "I":
                    legal &= pattern[out] in "ua"
                    cost += 3
                    out += 1
                    continue
                c = symbols[at]
                at += 1
                if e == "D":
                    cost += 4
                    continue
                legal &= (pattern[out] == c.lower()) if e == "K" else pattern[out] in "ua"
                cost += 3 * (e == "R") + 3 * c.isupper()
                out += 1
            if legal:
                found.append((cost, audit))
    return min(found)


def whole(symbols, block=repair.BLOCK):
    spans = repair.Spans(block)
    for s in symbols:
        spans.add(s)
    return spans.best()


def test_against_all_edit_scripts():
    for n in range(4):
        for symbols in map("".join, itertools.product(SYMBOLS, repeat=n)):
            assert whole(symbols) == enumerated(symbols), symbols


def test_any_length_and_block():
    pick = random.Random(1)
    for _ in range(300):
        symbols = "".join(pick.choice(SYMBOLS) for _ in range(pick.randint(0, 40)))
        expected = cheapest(symbols)
        assert whole(symbols) == expected and whole(symbols, 3) == expected and whole(symbols, 1) == expected
    long = "".join(pick.choice("suaSx") for _ in range(20_000))
    cost, audit = whole(long)
    assert (cost, audit) == cheapest(long)


def brute(rows):
    """The contract, conversation by conversation."""
    convs = {}
    for c, k, r, t in rows:
        read = [" " if v is None else str(v) for v in (c, k, r, t)]
        kind = zlib.crc32(f"{read[0]}:{read[1]}".encode()) % 20
        role, text = read[2], read[3]
        kept = convs.setdefault(c, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        kept += [(k, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, kept in convs.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        turns = [k for k, *_ in kept if k is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts, symbols, seen = [0, 0, 0], "", set()
        for _, role, text in kept:
            body = text.strip(" \t\n\r\x0b\x0c")
            fault = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            s = role[0] if role and role[0] in "sua" else "o"
            symbols += "x" if fault in (0, 1) else s.upper() if fault == 2 else s
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit = cheapest(symbols)
        n = len(audit) - audit.count("D")
        roles = (["system"] if n % 2 else []) + ["user", "assistant"] * (n // 2)
        lines, at = [], 0
        for e in audit:
            if e == "I":
                lines.append(f"{roles[len(lines)]}:")
                continue
            if e != "D":
                lines.append(f"{kept[at][1] if e == 'K' else roles[len(lines)]}:{kept[at][2]}")
            at += 1
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[c] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def logged():
    pick = random.Random(8)
    roles, texts = ["user", "assistant", "system", "tool", "supervisor", None, ""], ["Hi.", "ok", "Yes! ", " \n", "", None, "é?", "Hi."]
    rows = []
    for c in range(400):
        for k in range(pick.randint(1, 9)):
            role = pick.choice(roles) if pick.random() < 0.3 else ("user", "assistant")[k % 2]
            rows.append((c, pick.choice([k, k, k, 2 * k, None]), role, pick.choice(texts) if pick.random() < 0.5 else f"text {k}."))
    rows += [(1000, k, ("user", "assistant")[k % 2], f"line {k}.") for k in range(3000)]
    rows += [(1001, None, "user", "a.")] * 50 + [(1002, -5, "user", "x" * 2_000_000 + "."), (1002, 9, "assistant", "y!")]
    rows += [(None, k, "user", f"n {k}?") for k in range(20)] + [rows[0], rows[0]]
    return rows


def test_contract_against_brute_force(spark):
    rows = logged()
    expected = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS kind", "2 AS lead", "3 AS gone", "4 AS `a.b`").repartition(6)
    out = repair.digests(repair.damaged(df)).collect()
    assert len(out) == len(expected)
    found = {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in out
    }
    assert found == expected
    assert any(v[6] == "" and v[7] == hashlib.sha256(b"").hexdigest() for v in found.values())


def test_repaired_conversations_are_legal(spark):
    rows = logged()[:2000]
    out = repair.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    convs = {}
    for r in sorted(out, key=lambda r: (r.conv_id, r.position)):
        convs.setdefault(r.conv_id, []).append(r)
    for turns in convs.values():
        assert [t.position for t in turns] == list(range(1, len(turns) + 1))
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[0] for t in turns))
    assert len(convs) > 300


@pytest.mark.parametrize("call", [lambda d: repair.digests(repair.damaged(d)), repair.repaired])
def test_empty_table(spark, call):
    assert call(spark.createDataFrame([], SCHEMA)).count() == 0
