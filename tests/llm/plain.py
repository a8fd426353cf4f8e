"""Plain-Python versions of the operators, for small inputs."""

import re
from collections import Counter, defaultdict

import numpy as np


def groups(ids, links):
    """Smallest id that links reach, for each id."""
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            for x in (a, b):
                changed |= least[x] != low
                least[x] = low
    return least


def shingles(text, words):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not found:
        return set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} or {tuple(found)}


def jaccard_join(rows, words, percent):
    """{doc_id: (set size, component)} for (doc_id, text)."""
    sets = {i: shingles(t, words) for i, t in rows}
    lists, links = defaultdict(list), []
    for i, s in sets.items():
        shared = Counter(j for x in s for j in lists[x])
        links += [(i, j) for j, n in shared.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
        for x in s:
            lists[x].append(i)
    least = groups(sets, links)
    return {i: (len(s), least[i]) for i, s in sets.items()}


ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def secrets(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    return out + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]


def luhn(digits):
    twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def personal(text):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return out


def joined(spans):
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans))


def dedup_lines(rows, width=3):
    """{doc_id: (text, number of lines cut)} for (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        if text is None:
            out[i] = (None, 0)
            continue
        lines = text.split("\n")
        gone = set()
        for at in range(len(lines) - width + 1):
            window = tuple(lines[at : at + width])
            if not "".join(x.strip(" ") for x in window):
                continue
            if window in seen:
                gone.update(range(at, at + width))
            seen.add(window)
        out[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    return out


def good(vector):
    return vector is not None and None not in vector and np.isfinite(np.array(vector, float)).all() and any(vector)


def near_vectors(rows, threshold):
    """{vec_id: (links, component, kept)} for (vec_id, vector, label)."""
    part = [(i, np.array(v, float) / np.linalg.norm(np.array(v, float)), label) for i, v, label in rows if good(v) and label is not None]
    links = [(a[0], b[0]) for k, a in enumerate(part) for b in part[:k] if a[2] == b[2] and a[1] @ b[1] >= threshold]
    count = Counter(x for link in links for x in link)
    least = groups([i for i, _, _ in rows], links)
    return {i: (count[i], least[i], least[i] == i) for i, _, _ in rows}


def best_pieces(text, scores, unknown):
    """Best total over all segmentations, by trying every piece at every place."""
    best = [0.0] + [-1e300] * len(text)
    longest = max(map(len, scores))
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            if text[start:end] in scores:
                best[end] = max(best[end], best[start] + scores[text[start:end]])
        if text[end - 1] not in scores:
            best[end] = max(best[end], best[end - 1] + unknown)
    return best[-1]
