"""op12 against exhaustive search and plain dynamic programming."""

import hashlib
import itertools
import random
import re
import zlib

from sessionloom.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, copies string, mark int, kind int, audit string, place int"
FULL = {"u": "user", "a": "assistant"}


def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        h = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    mark = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, mark(r)))


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain(conv, rows):
    """Dynamic programming over rows: every state keeps its least (cost, audit), with the repaired turns."""
    rows = after_damage(rows)
    found = faults(rows)
    turned = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", [])}

    def inserted(now):
        for _ in range(4):
            for g, (cost, audit, turns) in list(now.items()):
                new = (cost + 5, audit + "I", [*turns, (FULL[turned[g]], "")])
                if turned[g] not in now or new[:2] < now[turned[g]][:2]:
                    now[turned[g]] = new
        return now

    for (_, role, text), fault in zip(rows, found, strict=True):
        after = {}
        for g, (cost, audit, turns) in inserted(best).items():
            fee = 5 if fault == "truncated" else 0
            ways = [(g, (cost + 2, audit + "D", turns))]
            if fault not in ("blank", "duplicate"):
                k = role[:1]
                if k and (turned[g] == k or (g == "" and k == "s")):
                    ways.append((k, (cost + fee, audit + "K", [*turns, (role, text)])))
                ways.append((turned[g], (cost + fee + 1, audit + "R", [*turns, (FULL[turned[g]], text)])))
            for then, new in ways:
                if then not in after or new[:2] < after[then][:2]:
                    after[then] = new
        best = after
    cost, audit, turns = min((v for g, v in inserted(best).items() if g in ("", "a")), key=lambda v: v[:2])
    own = {t for t, _, _ in rows if t is not None}
    gaps = max(own) - min(own) + 1 - len(own) if own else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") or not a[1] or not b[1] for a, b in itertools.pairwise(rows))
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
    return conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit, sha


def test_search_finds_the_cheapest_edits_of_all():
    """Every string of edits up to a length, tried one by one."""
    rng = random.Random(4)
    for _ in range(60):
        rows = bytes(rng.choice([0, 1, 2, 3, 1, 2]) | rng.choice([0, 0, repair.FORCED, repair.CUT]) for _ in range(rng.randrange(0, 4)))
        path = repair.Path(repair.START)
        path.through(tuple(repair.search(rows, s) for s in range(4)))
        assert path.finished() == min(cost for cost in (tried(rows, a) for n in range(len(rows) + 3) for a in itertools.product("DIKR", repeat=n)) if cost)


def tried(rows, audit):
    state, i, cost = "", 0, 0
    for letter in audit:
        to = "a" if state == "u" else "u"
        if letter == "I":
            state, cost = to, cost + 5
            continue
        if i == len(rows):
            return None
        row, i = rows[i], i + 1
        if letter == "D":
            cost += 2
            continue
        kind = "suax"[row & 3]
        if row & repair.FORCED or (letter == "K" and kind != to and not (kind == "s" and state == "" and "K" not in audit[: i - 1])):
            return None
        state = kind if letter == "K" else to
        cost += (letter == "R") + (5 if row & repair.CUT else 0)
    return (cost, "".join(audit)) if i == len(rows) and state in ("", "a") else None


def test_blocks_join_to_the_search_of_the_whole():
    rng = random.Random(9)
    for size in (1, 2, 3, 7):
        for _ in range(40):
            rows = bytes(rng.choice([0, 1, 2, 3]) | rng.choice([0, 0, 0, repair.FORCED, repair.CUT]) for _ in range(24))
            whole, cut = repair.Path(repair.START), repair.Path(repair.START)
            whole.through(tuple(repair.search(rows, s) for s in range(4)))
            for i in range(0, len(rows), size):
                cut.through(tuple(repair.search(rows[i : i + size], s) for s in range(4)))
            assert cut.finished() == whole.finished()


def conversations():
    rng = random.Random(2)
    said = ["Yes.", "No", "What?", " \t\n", "", None, "Go on!  \n", "ends so", "日本。", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant"]
    rows = [(conv, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(said)) for conv in [*range(40), None] for _ in range(rng.randrange(1, 14))]
    rows += [(77, t, ["user", "assistant"][t % 2], rng.choice(["Same.", f"Own {t}.", f"cut {t}"])) for t in range(2500)]  # spread over ranges and blocks
    rows += [(78, 5, "user", "Once.")] * 700  # one turn, all rows alike
    rows += [(conv, 0, "user", "Hi.") for conv in range(100, 140)]  # some lose their only row
    rows += rows[:9]
    return rows


def test_as_plain_version(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "c", 1, 2, "a", 3) for r in rows], SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in repair.repaired(df).collect()), key=str)
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    assert got == sorted((plain(c, g) for c, g in groups.items()), key=str)
    assert any(r[7] == "" for r in got)


def test_no_rows(spark):
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).collect() == []
