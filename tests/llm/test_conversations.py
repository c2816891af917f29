import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from tallyloom.llm import conversations
from tallyloom.llm.conversations import GONE, INITIALS, SHORT, WHOLE, Repaired, Tables

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
TABLES = Tables()
LETTER = {"s": WHOLE, "u": WHOLE + 1, "a": WHOLE + 2, "?": WHOLE + 3, "S": SHORT, "U": SHORT + 1, "A": SHORT + 2, "!": SHORT + 3, "x": GONE}


def coded(rows):
    """Rows as letters: s, u, a, other (?), capitals (and !) cut short, x to be deleted."""
    return bytes(LETTER[r] for r in rows)


def plain(rows):
    """Least (cost, audit) by the grammar alone, row by row, without tables."""
    @cache
    def best(i, state):
        options = [(0, "")] if i == len(rows) and state in "0a" else []
        initial, extra = (rows[i].lower().replace("!", "?"), 3 * (rows[i] in "SUA!")) if i < len(rows) else ("", 0)
        after = {"u": "u"} if state in "0sa" else {"a": "a"}
        if i < len(rows):
            c, a = best(i + 1, state)
            options.append((c + 4, "D" + a))
            for target in after if initial != "x" else ():
                c, a = best(i + 1, target)
                options.append((c + extra, "K" + a) if initial == target else (c + 3 + extra, "R" + a))
            if initial == "s" and state == "0":
                c, a = best(i + 1, "s")
                options.append((c + extra, "K" + a))
        # A turn is put in only in front of what is then kept or changed, or at the end, two at most.
        return min(options + more(i, state), default=(10**9, ""))

    def more(i, state, depth=2):
        if not depth:
            return []
        target = "u" if state in "0sa" else "a"
        c, a = min(direct(i, target) + [(c, a) for c, a in more(i, target, depth - 1)], default=(10**9, ""))
        return [(c + 3, "I" + a)]

    def direct(i, state):
        options = [(0, "")] if i == len(rows) and state in "0a" else []
        if i < len(rows):
            initial, extra = rows[i].lower().replace("!", "?"), 3 * (rows[i] in "SUA!")
            c, a = best(i + 1, state)
            options.append((c + 4, "D" + a))
            target = "u" if state in "0sa" else "a"
            if initial != "x":
                c, a = best(i + 1, target)
                options.append((c + extra, "K" + a) if initial == target else (c + 3 + extra, "R" + a))
        return options

    return best(0, "0")


def enumerated(rows):
    """Least (cost, audit) over all scripts, judged by the pattern of a whole conversation."""
    found = []
    gaps = ["", "u", "a", "ua", "au"]
    edits = [[("D", 4, "")] + ([] if r == "x" else [("K", 3 * (r in "SUA!"), r.lower().replace("!", "?")), *[("R", 3 + 3 * (r in "SUA!"), t) for t in "ua"]]) for r in rows]
    for script in itertools.product(*edits):
        for put in itertools.product(gaps, repeat=len(rows) + 1):
            roles = put[0] + "".join(e[2] + p for e, p in zip(script, put[1:]))
            if re.fullmatch("(s?(ua)+)?", roles):
                audit = "I" * len(put[0]) + "".join(e[0] + "I" * len(p) for e, p in zip(script, put[1:]))
                found.append((sum(e[1] for e in script) + 3 * sum(map(len, put)), audit))
    return min(found)


def test_tables_against_all_scripts():
    for n in range(3):
        for rows in itertools.product("suaxUA?", repeat=n):
            assert TABLES.repair(coded(rows)) == enumerated(rows), rows
    r = random.Random(1)
    for _ in range(12):
        rows = [r.choice(list(LETTER)) for _ in range(3)]
        assert TABLES.repair(coded(rows)) == enumerated(rows), rows


@pytest.mark.parametrize("block", [1, 2, 3, 4])
def test_block_lengths_against_plain(block):
    tables, r = Tables(block), random.Random(block)
    for n in [*range(12), 40, 300]:
        for _ in range(40 if n < 40 else 3):
            rows = [r.choice("suaSUA?!xuaua") for _ in range(n)]
            cost, audit = tables.repair(coded(rows))
            if n < 300:
                assert (cost, audit) == plain(tuple(rows)), rows
            edits, out = Repaired(audit), []
            for i in rows:
                out += edits.row(i.lower(), "")
            out += edits.inserted()
            assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in out))


def test_few_vectors_and_long_conversations():
    assert len(TABLES.vectors) < 60
    cost, audit = TABLES.repair(coded("ua" * 300_000 + "u"))
    assert cost == 3 and audit == "K" * 600_001 + "I"


def crc_kind(conv, turn):
    return zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20


def brute(rows):
    out, heads = {}, {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = crc_kind(conv, turn)
        out.setdefault(conv, [])
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, turns in out.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0))
        seen, letters, faults = set(), "", {"b": 0, "d": 0, "t": 0}
        for _, role, text in turns:
            white = " \t\n\x0b\x0c\r"
            initial = role[:1] if role[:1] in tuple(INITIALS) else "?"
            if not text.strip(white):
                faults["b"] += 1
                letters += "x"
            elif (role, text) in seen:
                faults["d"] += 1
                letters += "x"
            elif text.rstrip(white)[-1] not in ".!?":
                faults["t"] += 1
                letters += initial.upper().replace("?", "!")
            else:
                letters += initial
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        known = {t for t, *_ in turns if t is not None}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        cost, audit = plain(tuple(letters))
        state, lines, i = "0", [], 0
        for edit in audit:
            target = "u" if state in "0sa" else "a"
            role = {"u": "user", "a": "assistant"}[target]
            if edit == "I":
                lines.append(f"{role}:")
            else:
                _, own, text = turns[i]
                i += 1
                if edit == "D":
                    continue
                if edit == "K":
                    role = own
                    target = own[0]
                lines.append(f"{role}:{text}")
            state = target
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        heads[conv] = (gaps, faults["b"], faults["d"], faults["t"], illegal, cost, audit, digest)
    return heads


def run(spark, rows, extra=""):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.selectExpr("*", "'x' AS place", "1 AS head", "2 AS signs") if extra else df
    heads, laid = conversations.repair(df)
    got = conversations.hashed(laid, heads)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r.conv_id: tuple(r)[1:] for r in got.collect()}, conversations.repaired(laid, heads)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(conversations, "CHUNK", 5)
    r = random.Random(5)
    texts = ["Hello there.", "Fine!", "What?  \n", "cut sho", "", "  \t", None, "a.b", "Ünï 𝒳。", "x" * 50_000, "\x0b.\x0c", "w" * 10 + " " * 100_000]
    rows = [(c, t, r.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool", "User"]), r.choice(texts)) for c in range(60) for t in range(r.randrange(1, 9)) if r.random() < 0.9]
    rows += [(None, t, "user", f"none {t}.") for t in range(4)] + [(900, None, "user", "no turn."), (900, 3, "assistant", "yes."), (901, None, None, None)]
    rows += [(902, 5, "user", "twice."), (902, 5, "user", "twice."), (902, 6, "assistant", "ok.")]
    dropped = next(t for t in range(1000) if crc_kind(903, t) == 0)
    rows += [(903, dropped, "user", "gone."), (904, -3, "system", "s."), (904, 2**40, "user", "far.")]
    rows += [(905, t, "ua"[t % 2] + "x", f"long {t % 40}.") for t in range(700)]
    got, fixed = run(spark, rows, "clashes")
    want = brute(rows)
    assert got == want
    assert got[903] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    lines = {}
    for row in fixed.orderBy("conv_id", "seat").collect():
        assert row.seat == len(lines.setdefault(row.conv_id, []))
        lines[row.conv_id].append(f"{row.role}:{row.text}")
    assert {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in want} == {c: w[-1] for c, w in want.items()}


def test_no_rows(spark):
    assert run(spark, [])[0] == {}
