"""Plain Python versions of what the operators must return, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

SF = "/root/testdata/sf0.001"
BLANK = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = ("assign", "access", "hex")


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def base_counts(text):
    text = text or ""
    w = BLANK.findall(text)
    lines = [x for x in text.split("\n") if BLANK.search(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit)


def quality(rows, most_docs=30):
    """rows of (doc_id, text, source) -> rows of doc_id, five counts, base_failed, kept."""
    texts = {}  # (source, fp) -> its lines with a letter: (position, normalised line, line)
    for _, text, source in rows:
        fp, found = hashlib.md5((text or "").encode()).hexdigest(), []
        for pos, line in enumerate((text or "").split("\n")):
            norm = re.sub(r"[\W\d_]+", " ", line.lower()).strip()
            if norm:
                found.append((pos, norm, line))
        texts[source, fp] = found
    held = defaultdict(set)
    for (source, fp), found in texts.items():
        for _, norm, _ in found:
            held[source, norm].add(fp)
    often = {k for k, fps in held.items() if len(fps) > most_docs}

    low, first = {}, {}
    for (source, fp), found in texts.items():
        common = [(pos, norm) for pos, norm, _ in found if (source, norm) in often]
        slots = {}
        for _, norm, line in found:
            w = BLANK.findall(line)
            for i in range(max(1, len(w) - 2) if (source, norm) not in often else 0):
                h = zlib.crc32(" ".join(w[i : i + 3]).encode())
                slots[h % 8] = min(h, slots.get(h % 8, h))
        if common:
            low[source, fp] = set(slots.values()) or {tuple(common)}
    for source, fp in sorted(low, key=lambda k: k[1], reverse=True):
        for h in low[source, fp]:
            first[source, h] = fp
    label = {}
    for (source, fp), own in low.items():
        near = (first[source, h] for h in own)
        near = [f for f in near if len(own & low[source, f]) >= max(len(own), len(low[source, f])) * 7 / 8]
        label[source, fp] = min(near, default=fp)
    hot = {(s, norm) for s, norm in often if len({label[s, fp] for fp in held[s, norm]}) > most_docs}

    out = []
    for doc, text, source in rows:
        n = base_counts(text)
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        fp = hashlib.md5((text or "").encode()).hexdigest()
        cut = [len(line) for _, norm, line in texts[source, fp] if (source, norm) in hot]
        left, chars = len(text or "") - sum(cut), len(text or "")
        out.append((doc, *n, failed, not failed and not (cut and (left < 200 or left < 0.3 * chars))))
    return out


def secrets(text):
    text = text or ""
    found = []
    assign = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort()
    n = Counter(k for _, k, _ in found)
    return n[0], n[1], n[2], sha(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found))


def chats(rows):
    """rows of (conv_id, turn, role, text) -> {conv_id: (n_turns, turns hash, loss_chars, loss hash)}"""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, role, t in turns if role == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss), sha(loss))
    return out


def contamination(docs, items, size=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = {i: i + 32 for i in range(65, 91)}
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(fold))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(str(item))
    out = []
    for doc, text in docs:
        w = word.findall((text or "").translate(fold))
        hit, who = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    who |= windows[key]
        out.append((doc, len(w), len(hit), len(who), sha(",".join(sorted(who))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def shingle_set(text):
    w = BLANK.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def components(docs):
    """rows of (doc_id, text) -> {doc_id: (n_shingles, component_id)}"""
    sets = [(d, shingle_set(t)) for d, t in docs]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holds = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holds[x].append(i)
    for i, (_, a) in enumerate(sets):
        shared = Counter(j for x in a for j in holds[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(a) + len(sets[j][1]) - n):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return {d: (len(s), least[root(i)]) for i, (d, s) in enumerate(sets)}


def repeats(docs, size=200):
    """rows of (doc_id, text) -> rows of doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    raw = [(d, (t or "").encode()) for d, t in docs]
    count = Counter(b[i : i + size] for _, b in raw for i in range(len(b) - size + 1))
    out = []
    for d, b in raw:
        cut = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i : i + size]] > 1:
                cut[i : i + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(cut)))
        keep = bytes(x for x, c in zip(b, cut) if not c)
        out.append((d, len(b), sum(cut), spans, hashlib.sha256(keep).hexdigest()))
    return out
