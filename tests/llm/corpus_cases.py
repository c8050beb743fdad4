"""Documents with every odd case, and plain reference versions to compare with."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, h long, sequence_id long, score double"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = " ".join(f"word{i} and some more text of it" for i in range(30))


def rows():
    """Nulls, empty and blank texts, a very long one, copies, near copies, ties, repeated rows."""
    texts = {
        1: BASE, 2: BASE, 3: BASE.replace("word7 ", "other "), 4: None, 5: "", 6: " \t\n ", 7: "One two", 8: "one TWO",
        9: "x" * 5000, 10: "la " * 400, 11: "Größe und Übermut tun selten gut.\n" * 9, 12: "日本語 テキスト 123", 13: "12 34 !!",
        14: "\n".join(f"line {i} of a long text" for i in range(3000)), 15: BASE[:130] + " but it goes on elsewhere " + BASE[200:420],
    }
    out = [(i, t, "de" if i == 11 else "en", "a" if i % 3 else None, len(t or ""), "clash", i, 1, 0.5) for i, t in texts.items()]
    return out + [out[0], out[3], (None, "a row without an id", None, None, None, None, None, None, None)]


def odd_documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def texts_by_id():
    return {r[0]: r[1] or "" for r in rows() if r[0] is not None}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, width=5):
    found = words((text or "").translate(LOWER))
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[k : k + width]) for k in range(len(found) - width + 1)}


def components(texts, percent):
    """Smallest id reachable over all pairs of at least ``percent`` common shingles."""
    sets = {i: shingles(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(sets)
    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    return {i: root(i) for i in sets}, sets


def removed_spans(texts, length=100):
    """Bytes to remove from each text: covered by a window that also starts earlier."""
    seen, out = set(), {}
    for name in sorted(texts):
        data = texts[name].encode()
        mask = bytearray(len(data))
        for p in range(len(data) - length + 1):
            window = data[p : p + length]
            if window in seen:
                mask[p : p + length] = b"\1" * length
            seen.add(window)
        out[name] = mask
    return out
