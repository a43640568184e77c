"""Conversation repair: every edit sequence enumerated, windows, streams and edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from tabulon.llm import repair

TURNS = "conv_id long, turn long, role string, text string, cost int, place long"


def brute(letters):
    """(cost, audit): the least over all edit strings of a bounded number of inserts, without states."""
    best = None
    n = len(letters)
    for inserts in range(0, n + 3):
        for where in itertools.combinations_with_replacement(range(n + 1), inserts):
            for edits in itertools.product("DKR", repeat=n):
                cost, audit, options = 3 * inserts, "", [""]
                for i in range(n + 1):
                    k = where.count(i)
                    audit += "I" * k
                    options = [o + "".join(p) for o in options for p in itertools.product("ua", repeat=k)]
                    if i == n:
                        break
                    initial, fault = divmod(ord(letters[i]) - 65, 4)
                    audit += edits[i]
                    if edits[i] == "D":
                        cost += 4
                        continue
                    if fault in (1, 2):
                        break
                    cost += 3 * (fault == 3) + 3 * (edits[i] == "R")
                    options = [o + x for o in options for x in ("ua" if edits[i] == "R" else "xsua"[initial])]
                else:
                    continue
                if i == n and any(re.fullmatch("(s?(ua)+)?", o) for o in options):
                    best = min(best or (cost, audit), (cost, audit))
        if best and 3 * inserts > best[0]:
            break
    return best


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_least_of_all_edit_strings(n):
    rnd = random.Random(n)
    strings = ["".join(s) for s in itertools.product(repair._ALPHABET, repeat=n)] if n < 2 else ["".join(rnd.choice(repair._ALPHABET) for _ in range(n)) for _ in range(120 if n == 2 else 25)]
    for letters in strings:
        assert repair.repaired(letters) == brute(letters), letters


def test_windows_change_nothing():
    rnd = random.Random(3)
    for k in range(300):
        letters = "".join(rnd.choice(repair._ALPHABET if k % 3 else "ACIMPAA") for _ in range(rnd.randint(0, 40)))
        whole = repair.repaired(letters, 1000)
        assert all(repair.repaired(letters, w) == whole for w in (1, 2, 3, 7, 16))


def test_a_very_long_conversation_of_roles_that_never_fit():
    assert repair.repaired("A" * 50_001) == (3 * 50_000 + 4, "D" + "R" * 50_000)


def expected(rows):
    """The contract's row of every conversation by plain loops."""
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        convs[conv] += []
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        convs[conv] += [((turn is not None, turn or 0), "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, found in convs.items():
        found.sort()
        seen, letters = set(), ""
        for _, role, text in found:
            shown = text.rstrip(" \t\n\x0b\f\r")
            fault = 1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0
            seen.add((role, text))
            letters += repair._ALPHABET[4 * ("sua".find(role[0]) + 1 if role else 0) + fault]
        turns = [t for (there, t), _, _ in found if there]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = repair.repaired(letters)
        told, rest = [], list(found)
        for edit in audit:
            forced = "assistant" if told and told[-1][0] == "u" else "user"
            if edit == "I":
                told.append(f"{forced}:")
                continue
            _, role, text = rest.pop(0)
            if edit != "D":
                told.append(f"{role if edit == 'K' else forced}:{text}")
        out[conv] = (gaps, *repair.faults(letters), cost, audit, hashlib.sha256("\n".join(told).encode()).hexdigest())
    return out


def test_nulls_ties_repeats_and_long_texts(spark):
    rnd = random.Random(9)
    texts = ["Yes.", "no", " ", "", None, "What?!", "a ", "ß." * 50_000, " " * 20_000 + "x", "Yes.\n"]
    rows = [(rnd.choice([None, 1, 2, 3, 4, 5, 6, 7]), rnd.choice([None, *range(40)]), rnd.choice(["user", "assistant", "system", "User", "tool", "", None, "a", "user\n"]), rnd.choice(texts), 0, 0) for _ in range(700)]
    rows += [(100 + k, k, "user", "Hm.", 0, 0) for k in range(60)]  # some of these lose their only row
    out = repair.repair(repair.damaged(spark.createDataFrame(rows, TURNS).repartition(5)), "conv").collect()
    want = expected(rows)
    assert {r.conv_id: tuple(r)[1:] for r in out} == want and len(out) == len(want)
    assert any(v[-2] == "" for v in want.values())


def test_conversations_over_many_ranges(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"Turn {k}.", 0, 0) for k in range(3000)] + [(2, 0, "user", "Hi.", 0, 0)] * 500
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = repair.repair(repair.damaged(spark.createDataFrame(rows, TURNS).repartition(5)), "conv").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.conv_id: tuple(r)[1:] for r in out} == expected(rows)


def test_empty_table(spark):
    assert repair.repair(repair.damaged(spark.createDataFrame([], TURNS)), "conv").count() == 0
