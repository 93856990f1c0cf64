"""Plain, slow versions of the operators' contracts, a document at a time."""

import hashlib
import re
from collections import Counter

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(5)}
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": n < 10 or 100 * len(hit) > 20 * n,
    }


PHRASES = {
    ("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved",
}


def licences(text):
    words = ALNUM.findall((text or "").translate(LOWER))
    places = [(i, x) for i in range(len(words)) for p, x in PHRASES.items() if tuple(words[i : i + len(p)]) == p]
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min((i for i, _ in places), default=None),
        "last_word": max((i for i, _ in places), default=None),
        "base_labels": ",".join(sorted({x for _, x in places})),
    }


def suffixes(docs, size=100):
    """(doc_id, text) of distinct ids -> per doc_id n_bytes, n_removed, n_spans, kept_sha256."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - size + 1):
            if raw[i : i + size] in seen:
                gone[i : i + size] = [True] * size
            seen.add(raw[i : i + size])
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id] = {"n_bytes": len(raw), "n_removed": sum(gone), "n_spans": spans, "kept_sha256": sha(kept)}
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def account(plain):
    number = "".join(str(int(c, 36)) for c in plain[4:] + plain[:4])
    return 15 <= len(plain) <= 34 and int(number) % 97 == 1


def personal_spans(text):
    """(start, kind, end) of all kinds, and the kinds' names."""
    spans = []
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
        (
            "iban",
            r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
            lambda m: account(m.replace(" ", "")),
        ),
    ]
    for k, (_, pattern, good) in enumerate(kinds):
        spans += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if good(m.group())]
    return sorted(spans), [name for name, _, _ in kinds]


def personal(text):
    spans, names = personal_spans(text or "")
    base = [s for s in spans if s[1] < 4]
    counts = {f"n_{name}": sum(k == i for _, k, _ in base) for i, name in enumerate(names[:4])}
    return {**counts, "base_sha256": sha(",".join(f"{names[k]}:{a}:{b}" for a, k, b in base))}


def redacted(text):
    spans, names = personal_spans(text)
    out, reach = [], 0
    for a, k, b in spans:
        if a >= reach:
            out += [text[reach:a], f"[{names[k].upper()}]"]
        reach = max(reach, b)
    return "".join([*out, text[reach:]])


def contamination(docs, items, size=10):
    """(doc_id, text) rows and (item_id, text) rows -> a result per row."""
    words = lambda t: ALNUM.findall((t or "").translate(LOWER))
    windows = {}
    for item, text in items:
        own = words(text)
        if own:
            n = min(size, len(own))
            for i in range(len(own) - n + 1):
                windows.setdefault(tuple(own[i : i + n]), set()).add(str(item))
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(own) - n + 1):
                got = windows.get(tuple(own[i : i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    found |= got
        out.append(
            {"doc_id": doc_id, "n_words": len(own), "n_hit": len(hit), "n_items": len(found),
             "items_sha256": sha(",".join(sorted(found))), "contaminated": bool(hit)}
        )
    return out


def repeats(docs, size=50):
    """(doc_id, text) of distinct ids -> per doc_id n_words, n_removed, kept_sha256."""
    first, own = {}, {d: SPACED.findall(t or "") for d, t in docs}
    for doc_id, words in own.items():
        for i in range(len(words) - size + 1):
            key = tuple(words[i : i + size])
            first[key] = min(first.get(key, doc_id), doc_id)
    out = {}
    for doc_id, words in own.items():
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if first[tuple(words[i : i + size])] < doc_id:
                gone[i : i + size] = [True] * size
        kept = [w for w, g in zip(words, gone) if not g]
        out[doc_id] = {"n_words": len(words), "n_removed": sum(gone), "kept_sha256": sha(" ".join(kept))}
    return out


def shingles(text, size=4):
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return set()
    n = min(size, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def components(docs, percent=85, size=4):
    """(doc_id, text) of distinct ids -> per doc_id n_shingles and component_id."""
    sets = {d: shingles(t, size) for d, t in docs}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: {"n_shingles": len(sets[d]), "component_id": root(d)} for d in ids}
