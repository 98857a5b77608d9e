"""Plain-Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import html
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def components(ids, links):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def shingle_set(text, width):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(lowered)
    if not w:
        return frozenset()
    width = min(width, len(w))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def near_duplicates(docs, width, percent):
    """doc_id -> (shingles, component)"""
    sets = {i: shingle_set(t, width) for i, t in docs}
    ids = sorted(sets)
    links = [
        (a, b)
        for x, a in enumerate(ids)
        for b in ids[x + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    low = components(ids, links)
    return {i: (len(sets[i]), low[i]) for i in ids}


def substrings(docs, width=20):
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = words(text)
        gone = set()
        for at in range(len(w) - width + 1):
            run = tuple(w[at : at + width])
            if run in seen:
                gone.update(range(at, at + width))
            seen.add(run)
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(left.encode()).hexdigest())
    return out


def line_dedup(docs, min_lines=2, long_line=20):
    """doc_id -> (lines, removed, text, maximal runs removed); docs in corpus order, every suffix put into a trie."""
    trie, out = {}, {}
    for i, text in docs:
        parts = (text or "").split("\n")
        worded = [(k, line) for k, line in enumerate(parts) if WORD.search(line)]
        gone, ends = set(), set()
        for p in range(len(worded)):
            node, same, known = 0, 0, True
            for _, line in worded[p:]:
                known = known and (node, line) in trie
                same += known
                node = trie.setdefault((node, line), len(trie) + 1)
            if same >= min_lines or (same and len(worded[p][1]) >= long_line):
                gone.update(range(p, p + same))
                ends.add(p + same)
        dropped = {worded[p][0] for p in gone}
        left = None if text is None else "\n".join(x for k, x in enumerate(parts) if k not in dropped)
        out[i] = (len(worded), len(gone), left, len(ends))
    return out


def base_counts(text):
    text = text or ""
    w = words(text)
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {k + j for places in windows.values() if len(places) > 1 for k in places for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def article(source):
    """For pages whose article is marked as such and holds headings and paragraphs only."""
    found = re.search(r"<article>(.*?)</article>", source or "", re.S)
    if not found:
        return ""
    parts = re.split(r"</?(?:p|h1)>", found[1])
    parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", x)).split()) for x in parts]
    return "\n".join(x for x in parts if x)


def byte_shards(docs, shards):
    """(doc_id, text) in order -> doc_id -> (size, crc32, shard, slot)"""
    sized = [(i, (t or "").encode()) for i, t in sorted(docs)]
    total = sum(len(b) + 16 for _, b in sized)
    out, before, slots = {}, 0, {}
    for i, b in sized:
        size = len(b) + 16
        shard = (2 * before + size) * shards // (2 * total)
        out[i] = (size, zlib.crc32(b), shard, slots.setdefault(shard, 0))
        slots[shard] += 1
        before += size
    return out


def mix_taken(docs, weights=(5, 2, 1), block=32):
    """(doc_id, text, source) -> doc_id -> taken, from the description of the schedule."""
    size = {i: len(words(t)) for i, t, _ in docs}
    names = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[k % 3]) for k, s in enumerate(names)}
    whole = {s: sum(size[i] for i, _, x in docs if x == s) for s in names}
    total = sum(whole.values())
    target, open_ = {}, sorted(names, key=lambda s: (3.0 * whole[s] / weight[s], names.index(s)))
    left, share = float(total), sum(weight.values())
    while open_:
        s = open_[0]
        level = left / share
        if 3.0 * whole[s] > level * weight[s]:
            target |= {x: min(3.0 * whole[x], level * weight[x]) for x in open_}
            break
        target[s] = 3.0 * whole[s]
        left, share, open_ = left - target[s], share - weight[s], open_[1:]
    limit = {s: int(target[s]) for s in names}
    all_, at, ranges = sum(limit.values()), 0, []
    for s in names:
        ranges.append((at, at + limit[s], s))
        at += limit[s]
    slots = dict.fromkeys(names, 0)
    for t in range(int(-(-all_ // block) * 1.02) + 256 if all_ else 0):
        x = t % 2**31 * 1327217885 % 2**31 / 2.0**31 * float(all_)
        s = next((s for a, b, s in ranges if a <= x < b), None)
        if s is not None or None in names and any(a <= x < b for a, b, n in ranges if n is None):
            slots[s] += 1
    out = {}
    for s in names:
        stop, start = min(limit[s], slots[s] * block), 0
        for i in sorted((i for i, _, x in docs if x == s), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i)):
            out[i] = sum(max(0, min(size[i], stop - p * whole[s] - start)) for p in range(3))
            start += size[i]
    return out, target, size, whole
