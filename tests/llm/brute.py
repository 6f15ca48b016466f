"""Plain single-process versions of what the operators must return."""

import hashlib
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    found = {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]}
    ip = re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
    found["ip"] = [m.span() for m in ip if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    card = re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
    found["card"] = [m.span() for m in card if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m)) <= 15]
    return found


def base_digest(text):
    spans = base_spans(text)
    written = ",".join(f"{kind}:{a}:{b}" for kind in spans for a, b in spans[kind])
    return *(len(spans[kind]) for kind in spans), hashlib.sha256(written.encode()).hexdigest()


def rule_counts(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = {}
    for w in windows:
        often[w] = often.get(w, 0) + 1
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def token_rows(tokenizer, texts, end_id=1):
    """The ids of each text as little-endian unsigned 32-bit integers."""
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, end_id], "<u4").tobytes() for t in texts]


def crc(ids):
    return zlib.crc32(ids)


def top(vectors, queries, k):
    """vectors: (id, numbers) pairs; the k best whole inner products of each query."""
    out = []
    for q, a in queries:
        best = {}
        for v, b in vectors:
            if v != q:
                score = sum(x * y for x, y in zip(a, b, strict=True))
                best[v] = max(score, best.get(v, score))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, i + 1, v, s) for i, (v, s) in enumerate(ranked)]
    return sorted(out)


def labelled_runs(text, size=5):
    words = (text or "").lower().split()
    runs = [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    seen, out = {}, []
    for run in runs:
        seen[run] = seen.get(run, 0) + 1
        out.append((run, seen[run]))
    return out


def aligned(a, b):
    """The longest common subsequence of two texts, by the textbook table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def near_classes(texts, similarity=0.8):
    """texts: id -> text; id -> smallest id of its class, by comparing all pairs."""
    runs = {i: labelled_runs(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if runs[a] and runs[b] and set(runs[a]) & set(runs[b]):
                common = aligned(runs[a], runs[b])
                if common >= similarity * (len(runs[a]) + len(runs[b]) - common) - 1e-9:
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: find(i) for i in texts}


def without_repeats(rows, chunks):
    """rows: (id, text) in id order; texts without multi-line chunks an earlier id has, or the text itself before."""
    first = {}
    for i, text in rows:
        for lines in chunks(text or ""):
            if len(lines) > 1:
                first.setdefault("\n".join(lines), i)
    out = {}
    for i, text in rows:
        kept, seen = [], set()
        for lines in chunks(text or ""):
            passage = "\n".join(lines)
            if len(lines) > 1 and (first[passage] != i or passage in seen):
                continue
            seen.add(passage)
            kept += lines
        out[i] = None if text is None else "\n".join(kept)
    return out
