"""Plain Python versions of the contracts, one document at a time or all pairs."""

import hashlib
import re
from collections import Counter


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return frozenset()
    size = min(width, len(words))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def near_duplicates(docs, width, percent):
    """{id: (set size, smallest reachable id)}; docs are (id, text)."""
    sets = {i: shingle_set(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets, key=lambda i: len(sets[i]))
    for k, a in enumerate(ids):
        if not sets[a]:
            continue
        for b in ids[k + 1:]:
            if 100 * len(sets[a]) < percent * len(sets[b]):
                break
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def contamination(docs, items, size=13):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i:i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[key]
        ids = sorted(map(str, found))
        out[doc] = (len(w), len(hit), len(ids), digest(",".join(ids)), bool(hit) and 20 * len(hit) >= len(w))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text):
    """(kind, start, end) of the base rules."""
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), len(words) < 50 or 100 * len(covered) > 50 * len(words))


def shards(rows, limit, bits=48):
    """{key: (bits, depth, bytes)} for unique (key, bytes) by splitting one bucket at a time."""
    keyed = [(format(int(hashlib.md5(str(k).encode()).hexdigest()[:bits // 4], 16), f"0{bits}b"), k, n) for k, n in rows]
    out, todo = {}, [("", keyed)]
    while todo:
        prefix, members = todo.pop()
        total = sum(n for _, _, n in members)
        if total <= limit or len(prefix) == bits:
            out |= {k: (prefix, len(prefix), total) for _, k, _ in members}
            continue
        for bit in "01":
            part = [m for m in members if m[0].startswith(prefix + bit)]
            if part:
                todo.append((prefix + bit, part))
    return out
