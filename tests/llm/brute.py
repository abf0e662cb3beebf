"""Plain Python versions of the operators, for tests on small tables."""

import hashlib
import re
import string

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def license_base(text):
    words = LICENSE_WORD.findall((text or "").translate(FOLD))
    places, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def secret_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    kinds = ("assign", "access", "hex")
    spans = [f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(found)]
    return tuple(sum(k == i for _, k, _ in found) for i in range(3)), sha(",".join(spans)), spans


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for p in windows.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        n < 20 or 100 * len(covered) > 30 * n,
    )


def cleaned(rows, least):
    """(id, text) of the documents that pass, without the lines in `least` different texts of their host."""
    plain = lambda line: re.sub("[ \t\x0b\x0c\r]+", " ", line.lower()).strip(" ")
    texts = {}
    for _, text, host in rows:
        for line in {plain(x) for x in (text or "").split("\n")} - {""}:
            texts.setdefault((host, line), set()).add(text)
    out = []
    for i, text, host in rows:
        gone = lambda x, host=host: len(texts.get((host, plain(x)), ())) >= least
        lines = (text or "").split("\n")
        left = len(WORD.findall(text or "")) - sum(len(plain(x).split(" ")) for x in lines if plain(x) and gone(x))
        n, *_, failed = quality_base(text)
        if not failed and left >= 20 and left >= 0.3 * n:
            out.append((i, "\n".join(x for x in lines if not (plain(x) and gone(x)))))
    return out


def talk_digests(turns):
    told = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    learned = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha(told), len(learned), sha(learned)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_table(spark, rows, extra=False):
    """Documents from (id, text) or (id, text, source); with `extra`, columns that clash with names used inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for name in ("kept", "text_hash", "h", "n", "doc", "class_id", "copies", "size", "node", "_id", "spans", "ids", "batch"):
            df = df.selectExpr("*", f"cast('x' as string) as {name}")
    return df


# Nulls, empties, blanks, repeated rows, a tie of ids, symbols outside the first plane, and long texts.
LONG = "".join(chr(97 + (k * k + k // 7) % 26) + (" " if k % 6 == 5 else "") for k in range(120_000))
EDGES = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one"), (5, "one"), (6, "ONE"), (7, LONG), (8, LONG),
    (9, "😀 naïve Straße ÀÉ\x00\x1f end"), (10, "\n\n# a\n\nb\n"), (None, "no id at all here"), (None, None),
    (11, "x" * 5000), (12, "the same eight words stand here twice over " * 30),
]


def exact_groups(rows):
    """{(id, text): (keep_id, size)} and the number of rows kept."""
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault((t or "").translate(FOLD), []).append(i)
    key = lambda i: (i is not None, i)
    return {(i, t): (max(groups[(t or "").translate(FOLD)], key=key), len(groups[(t or "").translate(FOLD)])) for i, t, *_ in rows}, len(groups)


def shingles(text, width=5):
    words = WORD.findall((text or "").translate(FOLD))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_groups(rows, similarity=0.8):
    """{id: (class id, number of links)} of rows with different ids."""
    sets = {r[0]: shingles(r[1]) for r in rows}
    ids = sorted(sets)
    parent, links = {i: i for i in ids}, dict.fromkeys(ids, 0)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and shared >= similarity * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: (top(i), links[i]) for i in ids}


def repeated_bytes(rows, length=100):
    """{id: (bytes, removed, runs, digest of the rest)} of rows with different ids."""
    seen, out = set(), {}
    for i, text in sorted((r[0], (r[1] or "").encode()) for r in rows):
        gone = bytearray(len(text))
        for s in range(len(text) - length + 1):
            w = text[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out[i] = (len(text), sum(gone), runs, sha(bytes(b for b, g in zip(text, gone) if not g)))
    return out


def model_scores(rows, discount=0.75):
    """{id: (held out, tokens, known, N, base, score)} of rows with different ids, without quantisation."""
    import math
    import zlib
    from collections import Counter

    tokens = {r[0]: WORD.findall((r[1] or "").translate(FOLD)) + ["\0end"] for r in rows}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    single, pairs, after, kinds = Counter(), Counter(), Counter(), Counter()
    for i, w in tokens.items():
        if not held[i]:
            single.update(w)
            pairs.update(zip(["\0begin", *w], w))
    for (h, _), n in pairs.items():
        after[h] += n
        kinds[h] += 1
    total = sum(single.values())
    floor = total + 0.5 * (len(single) + 1)
    out = {}
    for i, w in tokens.items():
        low = [(single[x] + 0.5) / floor for x in w]
        score = 0.0
        for h, x, u in zip(["\0begin", *w], w, low):
            p = (max(pairs[h, x] - discount, 0) + discount * kinds[h] * u) / after[h] if after[h] else u
            score += math.log10(p)
        out[i] = (held[i], len(w), sum(single[x] > 0 for x in w), total, sum(map(math.log10, low)), score)
    return out


# Plain words for made names.
PROSE = """
account address amount archive balance barrier between billing browser builder button cache calendar capture category
channel checkout client cluster collection column comment company config connection consumer content context control
counter create current customer database default delete delivery deploy device document domain download driver dynamic
editor element email employee engine entity error event example exchange export factory feature fetch field filter
folder format forward function gateway general generate graph group handler header history image import index input
instance integer internal invoice iterator journal keyboard language layout length library listener local location
machine manager mapping market member memory merge message method model module monitor network normal notification
number object observer option order output package parameter parser partition password path pattern payment pending
person pipeline platform policy position prefix preview price priority process product profile project property
protocol provider public quantity query queue random reader record region register remote render report request
resource response result return review router sample schedule schema scope search section security select sender
server service session setting shipping signal single snapshot source static status storage stream string subject
submit support switch symbol system table target template thread ticket timeout token transfer update upload user
validate value vector version view window worker writer zone
"""
