"""Plain Python versions of the operators, one text at a time."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that the operators use inside; the input may have them too.
CLASHES = "size h bucket row s kept node label copies item g th cuts b length key archive n taken target slot".split()
LONG = "lorem ipsum dolor " * 20_000
CODE = "x" * 200_000
BASE = " ".join(f"word{i}" for i in range(200))
NEAR = BASE.replace("word100 ", "other ")

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    found = defaultdict(list)
    for i in range(len(w) - 4):
        found[tuple(w[i : i + 5])].append(i)
    covered = {j for at in found.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_groups(rows):
    """{doc_id: (n_shingles, component_id)} for rows of distinct doc_ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
]


def base_spans(text):
    """Counts by kind and the written spans."""
    n, out = [], []
    for kind, pattern, ok in PII:
        found = [m for m in re.finditer(pattern, text or "") if ok(m.group())]
        n.append(len(found))
        out += [f"{kind}:{m.start()}:{m.end()}" for m in found]
    return n, ",".join(out)


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def counted(rows):
    return Counter(map(tuple, rows))


def masked(text):
    """The text with base spans replaced by labels; spans that overlap become one."""
    spans = []
    for i, (kind, pattern, ok) in enumerate(PII):
        spans += [(m.start(), m.end(), i, kind) for m in re.finditer(pattern, text or "") if ok(m.group())]
    out, at, islands = [], 0, []
    for a, z, i, kind in sorted(spans):
        if islands and a < islands[-1][1]:
            last = islands[-1]
            islands[-1] = (last[0], max(last[1], z), min(last[2], (i, kind)))
        else:
            islands.append((a, z, (i, kind)))
    for a, z, (_, kind) in islands:
        out += [text[at:a], f"<{kind}>"]
        at = z
    return "".join(out) + (text or "")[at:]


def mixed_copies(rows, weights=(5, 2, 1), most=3, seed=0):
    """{doc_id: copies} for rows (doc_id, source, text) of distinct ids."""
    size = {i: len(words(t)) for i, _, t in rows}
    inner = {i: hashlib.md5((t or "").encode()).hexdigest() for i, _, t in rows}
    h = {i: int(hashlib.md5(f"mix-{seed}:{i}:{inner[i]}".encode()).hexdigest()[:15], 16) for i in size}
    of = defaultdict(list)
    for i, s, _ in rows:
        of[s].append(i)
    total = {s: sum(size[i] for i in ids) for s, ids in of.items()}
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(order)}
    full, share = set(), None
    while True:
        free = [s for s in order if s not in full]
        share = (sum(total.values()) - sum(most * total[s] for s in full)) / max(1, sum(weight[s] for s in free))
        above = {s for s in free if share * weight[s] > most * total[s]}
        if not above:
            break
        full |= above
    copies = {}
    for s, ids in of.items():
        target = most * total[s] if s in full else share * weight[s]
        whole = int(target // total[s]) if total[s] else 0
        need, below = target - whole * total[s], 0
        taken = set()
        for i in sorted(ids, key=h.get):
            # the document on the threshold counts if it brings the source nearer
            if below >= need and below > 0 or need <= 0 and size[i] > 0:
                break
            if below + size[i] >= need:
                if below + size[i] - need < need - below:
                    taken.add(i)
                break
            taken.add(i)
            below += size[i]
        copies |= {i: whole + (i in taken) for i in ids}
    return copies
