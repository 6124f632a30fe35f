import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import pytest

from assaycast.llm import catalog, turn_repair

sys.setrecursionlimit(20_000)
ROWS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def cheapest(codes):
    """Least (cost, audit) over all edits, by recursion on row, state and insertions in a row."""

    @lru_cache(maxsize=None)
    def best(i, q, inserted):
        options = [(0, "")] if i == len(codes) and q in turn_repair.ACCEPTING else []
        to, expected = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}[q]
        moves = [("I", i, to, 5)] if inserted < 3 else []
        if i < len(codes):
            initial, fault = codes[i]
            moves.append(("D", i + 1, q, 2))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                moves.append(("R", i + 1, to, 1 + extra))
                if initial == expected:
                    moves.append(("K", i + 1, to, extra))
                if initial == "s" and q == 0:
                    moves.append(("K", i + 1, 1, extra))
        for label, j, state, cost in moves:
            rest = best(j, state, inserted + 1 if label == "I" else 0)
            if rest is not None:
                options.append((cost + rest[0], label + rest[1]))
        return min(options, default=None)

    return best(0, 0, 0)


def by_hand(rows):
    """The report of ``catalog.repair_report``, one conversation after the other."""
    by_conv = {}
    for conv, turn, role, text in rows:
        kept = by_conv.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, kept in by_conv.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, codes = set(), []
        for _, role, text in kept:
            fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else "" if text.rstrip(SPACE)[-1] in ".!?" else "truncated"
            seen.add((role, text))
            codes.append((role[:1], fault))
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit = cheapest(codes)
        state, left, lines = 0, iter(kept), []
        for edit in audit:
            role, text = ("", "") if edit == "I" else next(left)[1:]
            if edit == "D":
                continue
            if edit == "K" and role[:1] == "s":
                state = 1
            else:
                state, initial = turn_repair.NEXT[state]
                role = role if edit == "K" else {"u": "user", "a": "assistant"}[initial]
            lines.append(f"{role}:{text}")
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(f == x for _, f in codes) for x in ("blank", "duplicate", "truncated")),
            sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip(codes, codes[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def report(spark, rows, schema=ROWS):
    found = catalog.repair_report(spark.createDataFrame(rows, schema).repartition(5)).collect()
    assert len(found) == len({r["conv_id"] for r in found})
    return {r["conv_id"]: tuple(r)[1:] for r in found}


def conversations(seed, sizes):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "no", "What now? ", "", " \n", None, "Why!", "one. two", "end.\u0085", " ", "x" * 3000 + "."]
    out = []
    for conv, n in enumerate(sizes):
        for turn in range(n):
            out.append((conv, None if rng.random() < 0.03 else turn * (1 + (rng.random() < 0.1)), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"Text {turn}{rng.choice('.!?x')}"))
    return out


def test_search_equals_all_paths():
    rng = random.Random(3)
    names = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    for _ in range(400):
        codes = [(rng.choice("sua?"), rng.choice(["", "", "", *names])) for _ in range(rng.randrange(14))]
        packed = bytes(4 * "sua?".index(i) + names[f] for i, f in codes)
        assert turn_repair.cheapest(packed) == cheapest(tuple(codes)), codes


@pytest.mark.parametrize("size", [1, 2, 5])
def test_runs_join_to_the_same_path(size):
    rng = random.Random(size)
    for _ in range(200):
        codes = bytes(rng.randrange(16) for _ in range(1 + rng.randrange(16)))
        runs = [turn_repair.between(codes[i : i + size]) for i in range(0, len(codes), size)]
        ranked = [[(b, a, c, p) for b, a, c, p in r] for r in runs]
        cost, path = turn_repair.finish(ranked)
        text = "".join(next(p for b, a, c, p in r if (b, a) == label) for r, label in zip(runs, path)) + path[-1]
        assert (cost, text) == turn_repair.cheapest(codes)


def test_report_equals_brute_force(shipped):
    rows = conversations(1, [k % 12 for k in range(120)])
    rows += [(None, 0, "user", "Null id."), (None, 1, "assistant", "Yes."), (500, None, None, None), (501, None, "user", "Only nulls.")]
    assert report(shipped, rows) == by_hand(rows)


def test_conversations_over_many_tasks_and_runs(shipped, monkeypatch):
    monkeypatch.setattr(turn_repair, "RUN", 7)
    rows = conversations(2, [300, 1, 2, 40])
    assert report(shipped, rows) == by_hand(rows)


def test_clashing_columns_and_no_rows(shipped, clash):
    rows = conversations(4, [3, 5])
    df = clash(shipped.createDataFrame(rows, ROWS))
    found = {r["conv_id"]: tuple(r)[1:] for r in catalog.repair_report(df).collect()}
    assert found == by_hand(rows)
    assert report(shipped, []) == {}


def test_repaired_rows(shipped):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 3, "bot", "Fine.")]
    df = shipped.createDataFrame(rows, ROWS)
    found = shipped.createDataFrame(turn_repair.audits(df).collect(), turn_repair.audits(df).schema)
    assert [(r["cost"], "".join(r["parts"])) for r in found.collect()] == [(5, "DKDR")]
    out = sorted(map(tuple, turn_repair.repaired(df, found).collect()))
    assert out == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Fine.")]
