"""Plain-Python versions of the operators, and awkward inputs for them."""

import hashlib
import re
from collections import defaultdict

import xxhash

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag string, h1 int, pos int, n_lines int, fp string, length int"


def docs_frame(spark, rows):
    """Documents with extra columns named like the operators' own."""
    full = [(i, t, lang, "s", None if t is None else len(t), "x", 1, 2, 3, "y", 4) for i, t, lang in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


LONG_LINE = "This Line is long enough to be counted as a repeated line"


def awkward_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    many = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, None, None), (2, "", "en"), (3, "\n\n", "en"), (4, "...", "de"), (5, many, "en"), (6, "x" * 200_000, "en"),
            (7, LONG_LINE + "\nown seven", "en"), (7, LONG_LINE + "\nown seven", "en"), (7, "other text of seven\n  " + LONG_LINE.upper() + "\t", "fr"),
            (None, LONG_LINE + "\nno id", "en"), (None, None, "en")]
    rows += [(10 + k, LONG_LINE + f"\nline of its own {k}\n" + LONG_LINE, "en") for k in range(6)]
    rows += [(30 + k, "same text in several rows here", "es") for k in range(4)]
    return rows


# ---- line dedup ------------------------------------------------------------

def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def line_dedup(rows, min_chars=40, min_docs=5):
    """(doc_id, n_lines, n_dropped, text) per row."""
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= min_chars and i is not None:
                holders[line_key(line)].add(i)
    out = []
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(line_key(x), ())) < min_docs or i == max(holders[line_key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept) if len(kept) < len(lines) else t))
    return out


# ---- decontamination -------------------------------------------------------

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(rows, items, window=10):
    """(doc_id, n_words, n_hit, item ids) per row."""
    wins = defaultdict(set)
    for item, text in items:
        ws = words(text)
        for s in range(max(len(ws) - window + 1, 1) if ws else 0):
            wins[tuple(ws[s:s + window])].add(item)
    sizes = {len(w) for w in wins}
    out = []
    for i, t, *_ in rows:
        ws, hit, found = words(t), set(), set()
        for size in sizes:
            for s in range(len(ws) - size + 1):
                if (w := tuple(ws[s:s + size])) in wins:
                    hit.update(range(s, s + size))
                    found |= wins[w]
        out.append((i, len(ws), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


# ---- simhash ---------------------------------------------------------------

def fingerprint(text):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if not ws:
        return 0
    parts = [" ".join(ws[i:i + 3]) for i in range(max(len(ws) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows, radius=2):
    """(doc_id, fingerprint, smallest doc_id reachable) per row."""
    return [(i, p, least) for i, p, least, _ in rooted(rows, radius)]


def rooted(rows, radius=2):
    """The same and a name of the group."""
    prints = [fingerprint(t) for _, t, *_ in rows]
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    nodes = sorted(root)
    for n, a in enumerate(nodes):
        for b in nodes[n + 1:]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for (i, *_), p in zip(rows, prints):
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return [(i, f"{p:016x}", least.get(find(p)), find(p)) for (i, *_), p in zip(rows, prints)]
