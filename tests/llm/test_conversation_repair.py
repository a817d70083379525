"""Repairs of conversations against enumeration of all edits and a plain reading of the rows."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from loanlens.llm import conversation_repair as repair

FORM = re.compile("(s?(ua)+)?")


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and audit by trying every sequence of edits with up to two inserts before each row."""
    best: list[tuple[int, str]] = []

    def go(i: int, roles: str, cost: int, edits: str) -> None:
        if best and cost > best[0][0]:
            return
        for k in range(3):
            for new in itertools.product("ua", repeat=k):
                said, paid, text = roles + "".join(new), cost + 5 * k, edits + "I" * k
                if i == len(codes):
                    if FORM.fullmatch(said):
                        best[:] = [min([*best, (paid, text)])]
                    continue
                go(i + 1, said, paid + 2, text + "D")
                if codes[i]:
                    kind, cut = divmod(codes[i] - 1, 2)
                    if kind < 3:
                        go(i + 1, said + "sua"[kind], paid + 5 * cut, text + "K")
                    for role in "ua":
                        go(i + 1, said + role, paid + 5 * cut + 1, text + "R")

    go(0, "", 0, "")
    return best[0]


def test_repairs_equal_enumeration():
    rng = random.Random(1)
    for n, times in ((0, 1), (1, 9), (2, 40), (3, 30), (4, 12)):
        for _ in range(times):
            codes = bytes(rng.choices(range(9), k=n))
            assert repair.repair(codes) == cheapest(codes)


def test_blocks_give_the_repair_of_the_whole():
    rng = random.Random(2)
    for _ in range(150):
        codes = bytes(rng.choices(range(9), k=rng.randint(1, 80)))
        size = rng.randint(1, 20)
        parts = [codes[i : i + size] for i in range(0, len(codes), size)]
        items = [repair.unpack_table(repair.block_table(p)) for p in parts]
        end = repair.ending(repair.forward(items, repair.START))
        way = repair.crossings(items, repair.START, end)
        found = [repair.audit(p, a, b) for p, a, b in zip(parts, way[:-1], way[1:], strict=True)]
        tail = repair._TAIL[end]
        assert (sum(c for c, _ in found) + 5 * tail, "".join(t for _, t in found) + "I" * tail) == repair.repair(codes)


def expected(rows):
    """The contract read plainly, audits from the single-task solution."""
    said = defaultdict(list)
    for r in rows:
        conv, turn = (" " if x is None else str(x) for x in (r.conv_id, r.turn))
        role, text = (" " if x is None else x for x in (r.role, r.text))
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        said[r.conv_id] += [(r.turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for conv, own in said.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).digest()))
        seen, codes, faults = set(), [], [0, 0, 0]
        for _, role, text in own:
            marks = re.findall("[^\x20\x09-\x0d]", text)
            if not marks or (role, text) in seen:
                faults[bool(marks)] += 1
                codes.append(0)
            else:
                cut = marks[-1] not in ".!?"
                faults[2] += cut
                codes.append(1 + 2 * (3 if role[:1] not in ("s", "u", "a") else "sua".index(role[0])) + cut)
            seen.add((role, text))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, edits = repair.repair(bytes(codes))
        out, left = [], iter(own)
        for e in edits:
            due = "assistant" if out and out[-1][0] == "u" else "user"
            if e == "I":
                out.append(f"{due}:")
                continue
            _, role, text = next(left)
            out += [] if e == "D" else [f"{role if e == 'K' else due}:{text}"]
        assert FORM.fullmatch("".join(x[0] for x in out)) and next(left, None) is None
        yield conv, gaps, *faults, illegal, cost, edits, hashlib.sha256("\n".join(out).encode()).hexdigest()


@pytest.mark.parametrize("block", [repair.BLOCK, 3])
def test_query_equals_the_contract(spark, sf_dir, conversations, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    got = sorted(map(tuple, repair.query(spark, sf_dir).collect()), key=str)
    assert got == sorted(expected(conversations.collect()), key=str)


def test_all_rows_dropped(spark):
    dropped = [t for t in range(200) if zlib.crc32(f"5:{t}".encode()) % 20 == 0][:2]
    rows = spark.createDataFrame([(5, t, "user", "x.") for t in dropped], "conv_id long, turn long, role string, text string")
    nothing = hashlib.sha256(b"").hexdigest()
    assert list(map(tuple, repair.repair_conversations(repair.damaged(rows)).collect())) == [(5, 0, 0, 0, 0, 0, 0, "", nothing)]
