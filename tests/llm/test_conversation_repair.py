"""Repair against a uniform-cost search over whole edit strings; damage and faults against plain Python."""

import hashlib
import heapq
import random
import re
import zlib

from tests.conftest import SF_SMALL
from threadlens.llm import conversation_repair as C

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")
STEP = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
NAMES = {"u": "user", "a": "assistant"}


def search(rows):
    """rows: (role, text, fault). The (cost, edit string)-least complete path, found best-first."""
    heap = [(0, "", 0, 0, ())]
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()
        for r in "ua":
            if (r, state) in STEP:
                heapq.heappush(heap, (cost + 2, audit + "I", i, STEP[r, state], lines + (f"{NAMES[r]}:",)))
        if i == len(rows):
            continue
        role, text, fault = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
        if fault in "bd" and fault:
            continue
        extra = 1 if fault == "t" else 0
        if (role[:1], state) in STEP:
            heapq.heappush(heap, (cost + extra, audit + "K", i + 1, STEP[role[:1], state], lines + (f"{role}:{text}",)))
        for r in "ua":
            if (r, state) in STEP:
                heapq.heappush(heap, (cost + 2 + extra, audit + "R", i + 1, STEP[r, state], lines + (f"{NAMES[r]}:{text}",)))


def viterbi(rows):
    rep = C.Repair()
    for role, text, fault in rows:
        rep.row(role, role[:1], text, fault)
    return rep.finish()


def test_viterbi_equals_search_with_ties():
    rng = random.Random(5)
    for _ in range(300):
        rows = [(rng.choice(["user", "assistant", "system", " ", "tool"]), rng.choice(["hi.", "x", ""]), rng.choice(["", "", "t", "b", "d"])) for _ in range(rng.randint(0, 6))]
        assert viterbi(rows) == search(rows), rows


def test_memory_holds_the_unresolved_stretch_only():
    rep = C.Repair()
    deepest = 0
    for n in range(20000):
        rep.row(*(("user", "u", "user q.", "") if n % 2 == 0 else ("assistant", "a", "ok.", "")))
        for held in rep.states:
            if held is not None:
                d, node = 0, held[1]
                while node is not rep.root:
                    d, node = d + 1, node.parent
                deepest = max(deepest, d)
    cost, audit, _ = rep.finish()
    assert cost == 0 and audit == "K" * 20000 and deepest <= 8


def reference(rows):
    """conv_id -> expected result row, from (conv_id, turn, role, text) tuples."""
    out, convs = {}, {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        convs.setdefault(conv, [])
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        convs[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv, rs in convs.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rs:
            vis = VISIBLE.findall(text)
            f = "b" if not vis else "d" if (role, text) in seen else "t" if vis[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append((role, text, f))
        turns = [t for t, _, _ in rs if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        ini = [r[:1] for _, r, _ in rs]
        illegal = sum(1 for a, b in zip(ini, ini[1:]) if a + b not in ("su", "ua", "au"))
        cost, audit, sha = search(faults)
        out[conv] = (conv, gaps, *[sum(f[2] == k for f in faults) for k in "bdt"], illegal, cost, audit, sha)
    return out


def test_query_rows_equal_plain_python(spark):
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    odd = [(None, 1, "user", "a."), (None, None, None, None), (7000, 1, "user", "x."), (7000, 1, "user", "x."), (7000, None, "assistant", "")]
    dropped = next(c for c in range(9000, 99999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    odd.append((dropped, 0, "user", "gone."))
    frame = conv.select("conv_id", "turn", "role", "text").unionByName(spark.createDataFrame(odd, conv.schema))
    rows = [tuple(r) for r in frame.collect()]
    small = {c for c in {r[0] for r in rows} if sum(r[0] == c for r in rows) <= 6}
    got = {r.conv_id: tuple(r) for r in C.repair(frame.withColumn("fault", frame.turn)).collect()}
    want = reference([r for r in rows if r[0] in small])
    assert set(got) == {r[0] for r in rows}
    assert all(got[c] == want[c] for c in small)
    assert got[dropped][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert C.repair(frame.limit(0)).count() == 0
