"""Plain single-process versions the operators are compared with."""

import hashlib
import html.parser
import itertools


def component_of(ids, linked):
    """Smallest id reachable, by repeated relabelling."""
    label = {i: i for i in ids}
    pairs = [(a, b) for a, b in itertools.combinations(ids, 2) if linked(a, b)]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label, pairs


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_copies(texts, size, percent=80):
    """Component of every id of {id: text}."""
    sets = {i: shingles(t, size) for i, t in texts.items()}

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return bool(sets[a]) and 100 * both >= percent * len(sets[a] | sets[b]) and both > 0

    return component_of(sorted(texts), linked)[0], {i: len(s) for i, s in sets.items()}


def without_repeats(texts, length):
    """(bytes, removed, runs, sha256 of the rest) by id of {id: text}."""
    raw = {i: (t or "").encode() for i, t in texts.items()}
    starts: dict[bytes, int] = {}
    for r in raw.values():
        for p in range(len(r) - length + 1):
            starts[r[p : p + length]] = starts.get(r[p : p + length], 0) + 1
    out = {}
    for i, r in raw.items():
        gone = [False] * len(r)
        for p in range(len(r) - length + 1):
            if starts[r[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        rest = bytes(b for b, g in zip(r, gone) if not g)
        runs = sum(g and not before for before, g in zip([False, *gone], gone))
        out[i] = (len(r), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def without_frequent_lines(texts, min_chars=40, min_documents=5):
    """Remaining text by id of {id: text}."""
    space = " \t\n\x0b\x0c\r"
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    holders: dict[str, set] = {}
    for i, t in texts.items():
        for line in (t or "").split("\n"):
            holders.setdefault(line.strip(space).translate(lower), set()).add(i)
    frequent = {k: max(v) for k, v in holders.items() if len(k) >= min_chars and len(v) >= min_documents}
    return {
        i: "\n".join(
            line for line in (t or "").split("\n") if frequent.get(line.strip(space).translate(lower), i) <= i
        )
        for i, t in texts.items()
    }


def cross_parse(word, reference):
    """Phrases of a word between spaces, each the longest match that the reference has."""
    text, at, found = f" {word} ", 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in reference:
            size += 1
        at, found = at + size, found + 1
    return found


def _digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def merkle_proofs(rows, tampered, fan=16):
    """(id, leaf, subroot, root, proof, folded root, verified) of rows (id, text, lang, source, n_chars), in any order."""

    def leaf(row, text):
        return _digest(*map(_field, (row[0], row[3], row[2], row[4], text)))

    def grow(digests):
        """Last digest, and per digest the siblings and positions met on the way to it."""
        paths, level, at = [[] for _ in digests], list(digests), list(range(len(digests)))
        while len(level) > 1:
            for path, place in zip(paths, at):
                run = level[place // fan * fan : place // fan * fan + fan]
                path.append((run[: place % fan], run[place % fan + 1 :]))
            level = [_digest(*level[i : i + fan]) for i in range(0, len(level), fan)]
            at = [place // fan for place in at]
        return level[0], paths

    sources: dict = {}
    for row in rows:
        sources.setdefault(row[3], []).append((row, leaf(row, row[1])))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        held = sorted(sources[s], key=lambda r: (r[0][0] is not None, r[0][0] or 0, r[1]))
        trees[s] = (held, *grow([digest for _, digest in held]))
    root, upper = grow([trees[s][1] for s in order]) if order else ("", [])
    out = []
    for s, above in zip(order, upper):
        held, subroot, paths = trees[s]
        for (row, digest), path in zip(held, paths):
            low = row[1] if row[1] is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[1])
            folded = leaf(row, low) if tampered(row[0]) else digest
            siblings = []
            for before, behind in path + above:
                siblings += before + behind
                folded = _digest(*before, folded, *behind)
            out.append((row[0], digest, subroot, root, _digest(*siblings), folded, folded == root))
    return out


def hard_negatives(rows, is_anchor, positives=5, negatives=10, band=(30, 90)):
    """Rows of the result for {id: (label, integer components)}."""
    out = []
    for a, (label, x) in rows.items():
        if not is_anchor(a):
            continue
        scores = {o: sum(p * q for p, q in zip(x, y)) for o, (_, y) in rows.items() if o != a and len(x) == len(y)}
        ranked = sorted(scores, key=lambda o: (-scores[o], o))
        for p in [o for o in ranked if rows[o][0] == label][:positives]:
            fits = [o for o in ranked if rows[o][0] != label and band[0] * scores[p] <= 100 * scores[o] <= band[1] * scores[p]]
            out += [(a, p, rank, o, scores[p], scores[o]) for rank, o in enumerate(fits[:negatives], 1)]
    return sorted(out)


def kept_lines(lengths, window=3):
    """Places of the lines with text between the outer ends of the windows that hold any."""
    held = [i for i in range(len(lengths)) if sum(lengths[i : i + window])]
    return [i for i in range(len(lengths)) if held and held[0] <= i <= held[-1] and lengths[i]]


class ArticleReader(html.parser.HTMLParser):
    """Text of the article of well-formed simple pages, a block per h1 or p or up to a br."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("article", "h1", "p", "br"):
            self.blocks.append("")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("article", "h1", "p"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data

    @classmethod
    def read(cls, page):
        reader = cls()
        reader.feed(page or "")
        reader.close()
        return " ".join(" ".join(b.split()) for b in reader.blocks if b.split())
