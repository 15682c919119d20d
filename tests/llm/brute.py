"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def substring_dedup(texts, length=35):
    """(words, removed words, hash of the kept text) of each text."""
    split = [(t or "").encode().split() for t in texts]
    seen = collections.Counter(tuple(w[i : i + length]) for w in split for i in range(len(w) - length + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def shingles(text, size=5):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_duplicates(rows, percent=75):
    """{id: (set size, component)} from (id, text), comparing every pair that shares a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    holders = collections.defaultdict(list)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        shared = collections.Counter(j for s in sets[i] for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            holders[s].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def bigram_dice(a: list[str], b: list[str]) -> float:
    x, y = ({tuple(w[i : i + 2]) for i in range(max(1, len(w) - 1))} for w in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def cheapest_edits(rows):
    """(cost, least audit) of (initial, must go, truncated) rows, by trying every move."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}  # by last role kept
    asked = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def inserted(states):
        for _ in range(2):
            for s, (cost, audit) in list(states.items()):
                new = (cost + 3, audit + "I")
                states[asked[s]] = min(states.get(asked[s], new), new)
        return states

    for initial, must_go, truncated in rows:
        after = {}
        for s, (cost, audit) in inserted(best).items():
            moves = [(4, "D", s)]
            if not must_go:
                if initial in step[s]:
                    moves.append((3 * truncated, "K", step[s][initial]))
                moves.append((3 + 3 * truncated, "R", asked[s]))
            for add, letter, t in moves:
                new = (cost + add, audit + letter)
                after[t] = min(after.get(t, new), new)
        best = after
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def repaired_conversation(rows):
    """Results of one conversation from its ordered (turn, role, text) rows."""
    faults, seen = [], set()
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
    initials = [r[1][:1] for r in rows]
    cost, audit = cheapest_edits([(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults)])
    new, at = [], 0
    for letter in audit:
        asked = "assistant" if new and new[-1][0][:1] == "u" else "user"
        if letter == "I":
            new.append((asked, ""))
            continue
        if letter != "D":
            new.append((rows[at][1] if letter == "K" else asked, rows[at][2]))
        at += 1
    turns = {r[0] for r in rows if r[0] is not None}
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
        "repaired_sha256": sha("\n".join(f"{r}:{t}" for r, t in new).encode()),
    }
