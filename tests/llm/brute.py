"""Plain Python versions of the operators' contracts, for small inputs."""

import hashlib
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def decontaminate(documents, benchmark, length=10):
    items = []
    for name, text in benchmark:
        words = ALNUM.findall(lower(text))
        size = min(length, len(words))
        items.append((None if name is None else str(name), {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()))
    sizes = {len(w) for _, ws in items for w in ws}
    out = []
    for doc_id, text in documents:
        words = ALNUM.findall(lower(text))
        hit, names = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                window = tuple(words[i : i + size])
                holders = [n for n, ws in items if window in ws]
                if holders:
                    names.update(holders)
                    hit.update(range(i, i + size))
        names.discard(None)
        out.append((doc_id, len(words), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out


def substring(documents, window=50):
    words = [(i, SPACED.findall(t or "")) for i, t in documents]
    first = {}
    for i, ws in words:
        if i is None:
            continue
        for k in range(len(ws) - window + 1):
            key = tuple(ws[k : k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, ws in words:
        gone = set()
        for k in range(len(ws) - window + 1 if i is not None else 0):
            if first[tuple(ws[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(ws), len(gone), sha(" ".join(w for k, w in enumerate(ws) if k not in gone))))
    return out


def shingle_set(text, size=5):
    words = SPACED.findall(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def jaccard(documents, size=5, low=75, high=100):
    sets = [(i, shingle_set(t, size)) for i, t in documents]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                holders.setdefault(x, []).append(k)
    seen = set()
    for held in holders.values():
        for a in held:
            for b in held:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    (i, s), (j, t) = sets[a], sets[b]
                    both = len(s & t)
                    if high * both >= low * (len(s) + len(t) - both):
                        x, y = sorted((find(i), find(j)))
                        root[y] = x
    return [(i, len(s), None if i is None else find(i)) for i, s in sets]


def quality(documents):
    out = []
    for i, text in documents:
        text = text or ""
        ws = SPACED.findall(text)
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        seen, places = {}, set()
        for k in range(len(ws) - 2):
            seen.setdefault(tuple(ws[k : k + 3]), []).append(k)
        for held in seen.values():
            if len(held) > 1:
                places.update(p + d for p in held for d in range(3))
        bad = len(ws) < 50 or 100 * len(places) > 50 * len(ws)
        out.append((i, len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(places), bad))
    return out


ASSIGN = re.compile(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def secrets(documents):
    out = []
    for i, text in documents:
        spans = base_secrets(text)
        out.append((i, *(sum(s[1] == k for s in spans) for k in range(3)), sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans))))
    return out


def entropy_spans(text, classes, allowed, window=20):
    import math

    blank = lambda m: "\n" * len(m[0])
    rest, out = text or "", []
    rest = ASSIGN.sub(lambda m: blank(m) if len(m[1]) >= 6 else m[0], rest)
    rest = re.sub("AKIA[A-Z0-9]{16,}", blank, rest)
    rest = re.sub("[0-9a-f]{24,}", blank, rest)
    for rule in allowed:
        rest = re.sub(rule, blank, rest)
    for kind, alphabet, bits in classes:

        def judged(m):
            run = m[0]
            if not (re.search("[0-9]", run) and re.search("[A-Za-z]", run)):
                return run
            peak = 0
            for k in range(len(run) - window + 1):
                part = run[k : k + window]
                peak = max(peak, -sum(part.count(c) / window * math.log2(part.count(c) / window) for c in set(part)))
            if round(peak, 9) < bits:
                return run
            out.append((m.start(), kind, m.end()))  # noqa: B023
            return blank(m)

        rest = re.sub(f"[{re.escape(alphabet)}]{{{window},}}", judged, rest)
    return out
