"""Plain one-machine versions of what the queries must return, written from their definitions alone."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def secrets(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""(?a:(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", text, re.A):
        if len(m[2]) >= 6:
            found.append(("assign", m.start(), m.end()))
    found += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ("assign", "access", "hex")
    found.sort(key=lambda f: (f[1], kinds.index(f[0])))
    count = Counter(k for k, _, _ in found)
    return (*(count[k] for k in kinds), sha(",".join(f"{k}:{s}:{e}" for k, s, e in found)))


def leaks(docs, items, window=10):
    windows = defaultdict(set)
    for item_id, text in items:
        words = FOLD_WORD.findall(lower_ascii(text or ""))
        for i in range(max(1, len(words) - window + 1) if words else 0):
            windows[tuple(words[i : i + window])].add(str(item_id))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words = FOLD_WORD.findall(lower_ascii(text or ""))
        hit, ids = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if (found := windows.get(tuple(words[i : i + size]))) is not None:
                    hit.update(range(i, i + size))
                    ids |= found
        out.append((doc_id, len(words), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def shingle_set(text, size=4):
    words = SPACE_WORD.findall(lower_ascii(text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def near_duplicates(docs, size=4, percent=80):
    """{doc_id: (set size, smallest reachable doc_id)}"""
    sets = {d: shingle_set(t, size) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    pairs = Counter()
    for ds in where.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                pairs[a, b] += 1
    for (a, b), n in pairs.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            ra, rb = sorted((find(a), find(b)))
            root[rb] = ra
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeats(docs, size=50):
    """{row index: (bytes, removed, spans, hash of what is left)}"""
    first = {}
    datas = [(d, (t or "").encode()) for d, t in docs]
    for d, data in datas:
        for i in range(len(data) - size + 1):
            w = data[i : i + size]
            if d is not None and (w not in first or d < first[w]):
                first[w] = d
    out = []
    for d, data in datas:
        gone = bytearray(len(data))
        for i in range(len(data) - size + 1):
            smallest = first.get(data[i : i + size])
            if smallest is not None and (d is None or smallest < d):
                gone[i : i + size] = b"\1" * size
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((d, len(data), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), sha(kept)))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    words = SPACE_WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            len(words) < 10 or 100 * len(hit) > 20 * len(words))


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal(text):
    text = text or ""
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    count = Counter(k for k, _, _ in found)
    return (*(count[k] for k in ("email", "ip", "card", "phone")), sha(",".join(f"{k}:{s}:{e}" for k, s, e in found)))


def exact_groups(docs):
    """docs: (doc_id, text) -> rows of op13; of equal doc_ids one row is kept."""
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        left = 1
        for i in sorted(ids, key=str):
            kept, left = (True, 0) if left and i == keep else (False, left)
            out.append((i, keep, len(ids), kept, sha(text)))
    return out


def damage(rows):
    """rows: (conv_id, turn, role, text), as op11 damages them."""
    out = []
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        fate = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub(r"[.!?]", "", text)
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


def repaired(rows):
    """One conversation's (turn, role, text) in order -> gaps, blank, duplicate, truncated, illegal, cost, audit, sha256."""
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, faults = set(), []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    # states of the grammar: nothing, after s, after u, after a; all edits are tried from the last row back
    step = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {"u": "user", "a": "assistant"}
    rest = None
    for at in range(len(rows), -1, -1):
        here = {}
        for q in range(4):
            options = [(0, "", ())] if at == len(rows) and q in (0, 3) else []
            if at < len(rows):
                _, role, text = rows[at]
                moves = [(4, "D", q, ())]
                if faults[at] in ("", "truncated"):
                    extra = 3 if faults[at] else 0
                    if (q, initials[at]) in step:
                        moves.append((extra, "K", step[q, initials[at]], ((role, text),)))
                    moves += [(3 + extra, "R", step[q, c], ((names[c], text),)) for c in "ua" if (q, c) in step]
                options += [(p + rest[t][0], e + rest[t][1], o + rest[t][2]) for p, e, t, o in moves]
            here[q] = min(options, default=(10**9, "", ()))
        for _ in range(3):  # insertions before the row
            for (q, c), t in step.items():
                if c in names:
                    here[q] = min(here[q], (3 + here[t][0], "I" + here[t][1], ((names[c], ""),) + here[t][2]))
        rest = here
    cost, audit, out = rest[0]
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in out)))


def conversations(rows):
    """(conv_id, turn, role, text) as stored -> op11's rows. Rows of one turn must be alike or alone."""
    whole = defaultdict(list)
    for conv, turn, role, text in damage(rows):
        whole[conv].append((turn, role, text))
    return [(c, *repaired(sorted(whole.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0)))) for c in {r[0] for r in rows}]


def collocations(docs, min_count=10, top=2000):
    """docs: (lang, text)."""
    counts = defaultdict(Counter)
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower_ascii(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= min_count}
        rows = []
        for p, a in found.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * c >= 50 * a for q, c in found.items()):
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((" ".join(p), a, f[p[:k]], f[p[k:]], n, score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(rows[:top])]
    return sorted(out)
