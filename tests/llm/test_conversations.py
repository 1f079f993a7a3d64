import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import cache

from textmill.llm import conversations as cv

COLUMNS = ["conv_id", *cv.COUNTS, "audit", "repaired_sha256"]


def damaged(data):
    """(conv, turn, role, text) rows with the planted faults."""
    for conv, turn, role, text in data:
        spaced = [" " if x is None else x for x in (conv, turn, role, text)]
        fault = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        role, text = spaced[2:]
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (conv, turn, "user" if fault == 4 else role, text)
        yield from [row, row] if fault == 3 else [row]


def cheapest(turns):
    """(cost, audit, repaired lines) by trying every edit at every place; turns: (role, text, must go, truncated)."""

    @cache
    def best(i, before, inserts):
        options = []
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", before[-4:] if len(before) > 4 else before):
            options.append((0, "", ()))
        legal = {"": "u", "s": "u", "u": "a", "a": "u"}[before[-1:]]
        name = {"u": "user", "a": "assistant"}[legal]
        tail = lambda initial: initial if initial == "s" else (before + initial)[-2:]
        if inserts < 3:
            cost, audit, lines = best(i, tail(legal), inserts + 1)
            options.append((cost + 3, "I" + audit, (f"{name}:", *lines)))
        if i < len(turns):
            role, text, gone, cut = turns[i]
            cost, audit, lines = best(i + 1, before, 0)
            options.append((cost + 4, "D" + audit, lines))
            if not gone:
                if role[:1] == legal or (role[:1] == "s" and before == ""):
                    cost, audit, lines = best(i + 1, tail(role[:1]), 0)
                    options.append((cost + 3 * cut, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best(i + 1, tail(legal), 0)
                options.append((cost + 3 + 3 * cut, "R" + audit, (f"{name}:{text}", *lines)))
        return min(options, default=(10**9, "", ()))

    return best(0, "", 0)


def brute(data):
    groups = defaultdict(list)
    for conv, turn, role, text in data:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, marked, counts = set(), [], defaultdict(int)
        for _, role, text in own:
            end = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
            counts[fault] += 1
            seen.add((role, text))
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {r[0] for r in own if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        cost, audit, lines = cheapest(tuple(marked))
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha)
    return out


def found(df, **options):
    return {r.conv_id: tuple(r[c] for c in COLUMNS[1:]) for r in cv.repair(df, **options).collect()}


SCHEMA = "conv_id bigint, turn bigint, role string, text string, kind int, digest string"


def frame(rows, data):
    return rows([(*d, 5, "x") for d in data], SCHEMA)


def test_random_conversations(rows):
    pick = random.Random(11)
    role = lambda: pick.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None, "ub", "Assistant"])
    text = lambda: pick.choice(["Hi.", "So?", "no end", "", " \n", None, "x! \t", "Long. " * 50, "é!", "é"])
    data = [
        (conv, pick.choice([None, *range(6)]) if (conv or 0) % 3 == 0 else n, role(), text())
        for conv in [None, *range(250)] for n in range(pick.randrange(1, 9))
    ]
    df, want = frame(rows, data), brute(data)
    assert found(df) == want == found(df, block=1) == found(df, block=3)


def test_damage(rows):
    data = [(c, t, "assistant", "Fine. So! ?x") for c in (None, 1, 2, 3) for t in (None, *range(60))]
    data += [(4, t, None, None) for t in range(60)]
    got = sorted(map(tuple, cv.damage(frame(rows, data)).collect()), key=str)
    assert got == sorted(damaged(data), key=str) and len({r[3] for r in got}) == 4


def test_giant_conversation_in_blocks(rows):
    pick = random.Random(2)
    data = [(7, n, ("user", "assistant")[n % 2] if pick.random() > 0.1 else "user", f"t{n}." if pick.random() > 0.1 else "") for n in range(5000)]
    data += [(8, 3, "user", "same.")] * 700 + [(9, 0, "user", "Hi."), (9, 1, "assistant", "Yes.")]
    df = frame(rows, data)
    whole = found(df)
    assert whole == found(df, block=64) == found(df, block=7)
    assert whole[9][5:7] == (0, "KK") and whole[8][5:7] == (2799, "K" + "D" * 699 + "I")
    turns = defaultdict(list)
    for r in cv.repaired_turns(df, block=64).orderBy("place").collect():
        turns[r.conv_id].append(r)
    for conv, own in turns.items():
        assert [r.place for r in own] == list(range(len(own)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in own))
        lines = "\n".join(f"{r.role}:{r.text}" for r in own)
        assert hashlib.sha256(lines.encode()).hexdigest() == whole[conv][7]
        assert "".join(r.edit for r in own) == whole[conv][6].replace("D", "")


def test_very_long_text_and_empty_table(rows):
    data = [(1, 0, "user", "a" * 3_000_000 + "."), (1, 1, "assistant", "b" * 3_000_000)]
    assert found(frame(rows, data)) == brute(data)
    assert found(frame(rows, data).limit(0)) == {}


def test_query(spark):
    import __spark_entry__ as contract

    folder = "/root/testdata/sf0.01"
    table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    want = brute(damaged(table))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    got = contract.queries()["op12_conversations"](spark, folder).collect()
    assert len(got) == len({r[0] for r in table})
    for r in got:
        assert tuple(r[c] for c in COLUMNS[1:]) == want.get(r.conv_id, empty)
