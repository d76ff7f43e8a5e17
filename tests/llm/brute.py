"""Plain versions of the operators' results, for small tables."""

from __future__ import annotations

import functools
import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

from millrace.llm.components import union_find

KINDS = ("email", "ip", "card", "phone")


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    return sorted((m.start(), k, m.end()) for k, (p, good) in enumerate(rules) for m in re.finditer(p, text) if good(m))


def rule_counts(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = list(zip(words, words[1:], words[2:], strict=False))
    repeated = {i + j for i, t in enumerate(triples) if triples.count(t) > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def simhash(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(texts: dict[int, str]) -> dict[int, tuple[int, int]]:
    prints = {i: simhash(t) for i, t in texts.items()}
    ids = sorted(prints)
    found = union_find((a, b) for n, a in enumerate(ids) for b in ids[n + 1:] if (prints[a] ^ prints[b]).bit_count() <= 2)
    return {i: (prints[i], found.get(i, i)) for i in ids}


def repeats(texts: dict[int, str]) -> dict[int, tuple]:
    first: dict[bytes, int] = {}
    out = {}
    for i in sorted(texts):
        raw = texts[i].encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 49):
            if first.setdefault(raw[s:s + 50], i) < i:
                gone[s:s + 50] = b"\1" * 50
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[i] = len(raw), sum(gone), runs, sha(bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return out


def shingles(line: str, width: int = 8) -> frozenset[str]:
    return frozenset(line[i:i + width] for i in range(max(1, len(line) - width + 1)))


def removed_lines(texts: dict[int, str]) -> dict[int, list[int]]:
    lines = [(i, j, " ".join(x.split()).lower()) for i in sorted(texts) for j, x in enumerate(texts[i].split("\n")) if x.split()]
    first: dict[str, tuple[int, int]] = {}
    for i, j, norm in lines:
        first.setdefault(norm, (i, j))
    norms = sorted(first, key=first.get)
    sets = [shingles(n) for n in norms]
    links = [(a, b) for b in range(len(norms)) for a in range(b) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    found = union_find(links)
    keeper = {n: first[norms[found.get(k, k)]] for k, n in enumerate(norms)}
    out: dict[int, list[int]] = {i: [] for i in texts}
    for i, j, norm in lines:
        if keeper[norm] != (i, j):
            out[i].append(j)
    return out


def damaged(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text, fault = role if role is not None else " ", text if text is not None else " ", zlib.crc32(name.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def repair(turns: list[tuple]) -> tuple:
    """Gaps, faults, cost, audit and hash of one conversation of (turn, role, text), by trying all edits (least cost, then audit)."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    numbers = [t for t, _, _ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    seen, marks = set(), []
    for _, role, text in turns:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        marks.append("b" if not visible else "d" if (role, text) in seen else "" if visible[-1] in ".!?" else "t")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in turns]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))

    @functools.cache
    def best(i: int, before: str) -> tuple:
        """Of the turns from i on, after ``before`` was the last symbol ('' for none): cost, audit, roles."""
        after = "a" if before == "u" else "u"
        name = {"u": "user", "a": "assistant"}[after]
        found = [(0, "", ())] if i == len(turns) and before in ("", "a") else []
        if i < len(turns):
            c, audit, left = best(i + 1, before)
            found.append((c + 2, "D" + audit, left))
            if marks[i] in ("", "t"):
                extra = 5 if marks[i] else 0
                if initials[i] == after or (initials[i] == "s" and before == ""):
                    c, audit, left = best(i + 1, initials[i])
                    found.append((c + extra, "K" + audit, (turns[i][1:], *left)))
                if initials[i] != after:
                    c, audit, left = best(i + 1, after)
                    found.append((c + extra + 1, "R" + audit, ((name, turns[i][2]), *left)))
        if i < len(turns) or before in ("u", "s"):
            # One insertion in place, or a whole pair; more in one place only add cost.
            for first, rest in inserted(i, after):
                found.append((rest[0] + 5 * len(first), "I" * len(first) + rest[1], (*first, *rest[2])))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "", ())

    def inserted(i, after):
        names = {"u": ("user", ""), "a": ("assistant", "")}
        other = "a" if after == "u" else "u"
        yield [names[after]], consumed(i, after)
        yield [names[after], names[other]], consumed(i, other)

    def consumed(i, before):
        """As ``best``, but the next edit is no insertion."""
        after = "a" if before == "u" else "u"
        found = [(0, "", ())] if i == len(turns) and before == "a" else []
        if i < len(turns):
            c, audit, left = best(i + 1, before)
            found.append((c + 2, "D" + audit, left))
            if marks[i] in ("", "t"):
                c, audit, left = best(i + 1, after)
                keep = initials[i] == after
                role = turns[i][1] if keep else {"u": "user", "a": "assistant"}[after]
                found.append((c + (5 if marks[i] else 0) + (not keep), ("K" if keep else "R") + audit, ((role, turns[i][2]), *left)))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "", ())

    cost, audit, left = best(0, "")
    digest = sha("\n".join(f"{r}:{t}" for r, t in left))
    return gaps, marks.count("b"), marks.count("d"), marks.count("t"), illegal, cost, audit, digest


def linked_vectors(vectors: list) -> list[tuple[int, int]]:
    """(number of links, first row of the component) of each vector, from all cosines."""
    good = [v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    units = [np.array(v, float) / np.abs(v).max() if g else None for v, g in zip(vectors, good, strict=True)]
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    pairs = []
    for size in {len(u) for u in units if u is not None}:
        at = [i for i, u in enumerate(units) if u is not None and len(u) == size]
        rows = np.stack([units[i] for i in at])
        a, b = np.nonzero(np.triu(rows @ rows.T >= 0.9, 1))
        pairs += [(at[i], at[j]) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    n = [0] * len(vectors)
    for a, b in pairs:
        n[a] += 1
        n[b] += 1
    found = union_find(pairs)
    return [(n[i], found.get(i, i)) for i in range(len(vectors))]


def phrases(docs: list[tuple], least: int, top: int) -> list[tuple]:
    """(lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    counts: dict[str, dict[tuple, int]] = {}
    for lang, text in docs:
        of = counts.setdefault("und" if lang is None else lang, {})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    phrase = tuple(words[i:i + k])
                    of[phrase] = of.get(phrase, 0) + 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        dropped = {q[i:j] for q, c in candidates.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q) and f[q[i:j]] <= c}
        rated = []
        for p, a in candidates.items():
            if p not in dropped:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rated.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -score) for i, (score, a, p, left, right) in enumerate(sorted(rated)[:top])]
    return out
