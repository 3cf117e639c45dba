"""Plain Python versions of the operators, for small tables."""

import hashlib
import re

BLANK = r"[^\x20\x09-\x0D]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def shingles(text, n):
    words = re.findall(BLANK, lower(text))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def linked(texts, n, percent):
    sets = {i: shingles(t, n) for i, t in texts.items()}
    ids = sorted(texts)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    return {i: len(s) for i, s in sets.items()}, components(ids, links)


def repeats(texts, window):
    first, out = {}, {}
    for i in sorted(texts):
        words = re.findall(BLANK, texts[i] or "")
        keys = [tuple(words[j : j + window]) for j in range(len(words) - window + 1)]
        cover = set()
        for j, k in enumerate(keys):
            if first.get(k, i) < i:
                cover |= set(range(j, j + window))
        for k in keys:
            first.setdefault(k, i)
        kept = " ".join(w for j, w in enumerate(words) if j not in cover)
        out[i] = (len(words), len(cover), hashlib.sha256(kept.encode()).hexdigest())
    return out


def licences(text, base):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    starts, labels = [], set()
    for phrase, label in base:
        parts = phrase.split()
        for j in range(len(words)):
            if words[j : j + len(parts)] == parts:
                starts.append(j)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def detections(text, rules):
    """Labels that stand: every match of every rule, those inside a match of an earlier rule dropped."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    norm = " " + " ".join(words) + " "
    found = []
    for place, (label, keyword, pattern, _) in enumerate(rules):
        if (f" {keyword} " if " " in keyword else keyword) in norm:
            for m in re.finditer(rf"(?<= )({pattern})(?= )", norm):
                found.append((norm[: m.start()].count(" ") - 1, norm[: m.end()].count(" "), place, label))
    stands = [d for d in found if not any(e[2] < d[2] and e[0] <= d[0] and e[1] >= d[1] for e in found)]
    return {d[3] for d in stands}
