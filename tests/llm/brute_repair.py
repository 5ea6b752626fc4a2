"""Conversation repair row by row, with whole audits as strings: what the operator is held against."""

import hashlib
import zlib

SPACES = " \t\n\x0b\f\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        elif hit == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        elif hit == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if hit == 3 else 1)
    return out


def follow(state, initial):
    return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, initial))


def solve(rows):
    """(figures, cost, audit, digest) of rows (turn, role, text) in order."""
    seen, faults, figures = set(), [], [0, 0, 0, 0]
    for i, (_, role, text) in enumerate(rows):
        end = text.rstrip(SPACES)
        fault = 0 if not end else 1 if (role, text) in seen else 2 if end[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        if fault is not None:
            figures[fault] += 1
        if i and rows[i - 1][1][:1] + role[:1] not in ("su", "ua", "au"):
            figures[3] += 1
    best = {0: (0, "", ())}

    def inserted(found):
        found = dict(found)
        for _ in range(3):
            for s, (cost, audit, said) in list(found.items()):
                for role in ("user", "assistant"):
                    t = follow(s, role[0])
                    new = (cost + 5, audit + "I", (*said, (role, "")))
                    if t is not None and (t not in found or new[:2] < found[t][:2]):
                        found[t] = new
        return found

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for s, (cost, audit, said) in inserted(best).items():
            ways = [(s, 2, "D", said)]
            if fault not in (0, 1):
                more = 5 if fault == 2 else 0
                ways.append((follow(s, role[:1]), more, "K", (*said, (role, text))))
                ways += [(follow(s, r[0]), more + 1, "R", (*said, (r, text))) for r in ("user", "assistant")]
            for t, c, letter, words in ways:
                new = (cost + c, audit + letter, words)
                if t is not None and (t not in after or new[:2] < after[t][:2]):
                    after[t] = new
        best = after
    cost, audit, said = min(v for s, v in inserted(best).items() if s in (0, 3))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
    return figures, cost, audit, digest


def repair(rows, order=lambda r: r):
    """Result rows by conversation; `order` breaks ties of a turn."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [r[1:] for r in damage([r for r in rows if r[0] == conv])]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, order(r[1:])))
        turns = {r[0] for r in mine if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        figures, cost, audit, digest = solve(mine)
        out[conv] = (gaps, *figures, cost, audit, digest)
    return out
