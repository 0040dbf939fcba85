"""Plain versions of the operators over lists of rows, to compare with."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def substring_dedup(rows, size=50):
    """(doc_id, n_words, n_removed, kept text) of (doc_id, text) rows."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            if doc is not None:
                k = tuple(w[i:i + size])
                first[k] = min(first.get(k, doc), doc)
    out = []
    for doc, text in rows:
        w, gone = words(text), set()
        for i in range(len(w) - size + 1):
            if doc is not None and first[tuple(w[i:i + size])] < doc:
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def shingles(text, n=4):
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    w = words((text or "").translate(str.maketrans(upper, lower)))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def near_duplicates(rows, n=4):
    """(doc_id, n_shingles, component_id, kept) of (doc_id, text) rows."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None:
                continue
            same = len(sets[i] & sets[j])
            linked = sets[i] and sets[j] and 100 * same >= 80 * len(sets[i] | sets[j])
            if linked or (a == b and sets[i] and sets[j]):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        group = [r[0] for k, r in enumerate(rows) if root(k) == root(i)]
        component = min(group) if doc is not None and sets[i] else doc
        out.append((doc, len(sets[i]), component, doc is None or component == doc))
    return out


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w, text = words(text), text or ""
    seen, cover = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2)), set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i:i + 3])] > 1:
            cover.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))


def rates(text):
    n, chars, symbols, dup, rep = counts(text)
    text = text or ""
    lines = sum(1 for x in text.split("\n") if words(x))
    return {"symbols": symbols / max(1, chars), "repeated_lines": dup / max(1, lines),
            "repeated_words": rep / max(1, n), "capitals": len(re.findall("[A-Z]", text)) / max(1, chars),
            "exclamations": text.count("!") / max(1, chars), "long_words": chars / max(1, n)}


def base_failed(text):
    n, *_, rep = counts(text)
    return n < 50 or 100 * rep > 50 * n


def tail(k, n, p):
    return math.fsum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def certified(rows, labels, cutoffs, rate, loss):
    """Lowest certified cutoffs of (doc_id, text, stratum) rows, by strata and signals."""
    held = [(d, s or "", rates(t)) for d, t, s in rows if d is not None and not base_failed(t)]
    share = lambda docs, name, cut: sum(r[name] > cut for r in docs) / max(1, len(docs))
    bad, none = ([r for d, _, r in held if labels.get(d) == q] for q in (0, None))
    lead = {n: max(share(bad, n, c) - share(none, n, c) for c in cuts) for n, cuts in cutoffs.items()}
    steps = [(n, c) for n in sorted(cutoffs, key=lambda n: -lead[n]) for c in sorted(cutoffs[n], reverse=True)]
    good = defaultdict(list)
    for d, s, r in held:
        if labels.get(d) == 1:
            good[s].append(r)
    tested = {s: docs for s, docs in good.items() if (1 - rate) ** len(docs) <= loss}
    out = {}
    for s, docs in tested.items():
        for j, (name, cut) in enumerate(steps):
            k = sum(any(r[n] > c for n, c in steps[:j + 1]) for r in docs)
            if tail(k, len(docs), rate) > loss / len(tested):
                break
            out[s, name] = cut
    return out


def quality(rows, labels, cutoffs, rate, loss):
    """kept flags of (doc_id, text, stratum) rows; labels: id -> 1 (good), 0 (bad) or another value."""
    limits = certified(rows, labels, cutoffs, rate, loss)
    return [not base_failed(text) and all(rates(text)[name] <= limits.get((stratum or "", name), math.inf)
                                          for name in cutoffs) for _, text, stratum in rows]


def runs(text):
    w = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def hits(docs, items):
    """(doc_id, item_id) -> (shared, size) of the best row of each pair."""
    best = {}
    sets = [(item, runs(text)) for item, text in items]
    for doc, text in docs:
        own = runs(text)
        for item, s in sets:
            same = len(own & s)
            if s and 100 * same >= 80 * len(s):
                best[doc, item] = max(best.get((doc, item), (0, 0, 0)), (same / len(s), same, len(s)))
    return {k: v[1:] for k, v in best.items()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def feistel(left, right, radix_left, radix_right, key, kind, rounds=8):
    def noise(i, half, radix):
        return int(hashlib.sha256(f"{key}|{kind}|{i}|{half}".encode()).hexdigest()[:15], 16) % radix
    for i in range(rounds):
        if i % 2 == 0:
            left = (left + noise(i, right, radix_left)) % radix_left
        else:
            right = (right + noise(i, left, radix_right)) % radix_right
    return left, right


def permuted(digits, key, kind):
    h = len(digits) // 2
    a, b = feistel(int(digits[:h]), int(digits[h:]), 10**h, 10 ** (len(digits) - h), key, kind)
    return f"{a:0{h}d}{b:0{len(digits) - h}d}"


def card(digits, key):
    body = digits[0] + permuted(digits[1:-1], key, "card")
    return next(body + c for c in "0123456789" if luhn(body + c))


def judge(url, rules, default="allow"):
    """(host, path, rule, verdict)."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [((len(h + p), len(h), v), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, default)
