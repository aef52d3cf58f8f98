"""Small tables with every awkward row, and readings of the rules in plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# columns that the operators use or add themselves
CLASHES = ["score", "kept", "shard", "slot", "row", "key", "hash", "label", "copy", "n", "rate", "bucket", "items", "spans", "rep", "component_id", "predicted"]


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def awkward_rows(seed=1):
    rng = random.Random(seed)
    base = " ".join(words(rng, 80, 10_000))
    near = base.rsplit(" ", 2)[0] + " changed end"
    long = " ".join(words(rng, 30_000))
    rows = [
        (None, base, "en", "a"), (None, None, None, None), (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t\x0b ", None, "a"),
        (4, "one", "en", "b"), (5, long, "en", "b"), (6, base, "en", "a"), (6, base, "en", "a"), (7, base, "de", "b"), (8, near, "en", "a"),
        (9, "a a a a a a a a a a a a a a a a a", "en", "a"), (10, "x" * 5000, "en", "a"), (11, "é ü   漢字 \x1c \x01 ok", "fr", "c"),
        (12, base.upper(), "en", "a"), (13, "Stop. " + base + "\n" + base, "en", "b"), (-5, "negative id text here", "en", "b"),
        (14, "one two three", "en", "b"), (15, "One TWO three", "en", "b"), (16, "0\x00zero\x00bytes " * 60, "en", "c"),
    ]
    return [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]


def awkward(spark, seed=1):
    return spark.createDataFrame(awkward_rows(seed), SCHEMA)


def with_clashes(docs):
    for name in CLASHES:
        docs = docs.withColumn(name, docs["lang"])
    return docs


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ascii_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, width):
    w = ascii_words(lowered(text))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def near_components(rows, width, percent):
    """Smallest linked id per id, by comparing all pairs that share a shingle."""
    sets = [(i, shingle_set(t, width)) for i, t in rows if i is not None]
    owners, common = {}, Counter()
    for x, (_, s) in enumerate(sets):
        for g in s:
            owners.setdefault(g, []).append(x)
    for xs in owners.values():
        for a in range(len(xs)):
            for b in range(a):
                common[xs[b], xs[a]] += 1
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a][1]) + len(sets[b][1]) - c):
            x, y = find(sets[a][0]), find(sets[b][0])
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def removed_bytes(texts, length):
    """Per text the flags of the bytes that a string found elsewhere covers."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k:k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        flags = [False] * len(d)
        for k in range(len(d) - length + 1):
            if seen[d[k:k + length]] > 1:
                flags[k:k + length] = [True] * length
        out.append(flags)
    return out


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def merkle_rows(rows, fanout=2):
    """Per doc_id: leaf, subroot, root, digests on the path (level by level, before and after the node) of (doc_id, source, lang, n_chars, text)."""
    def encoded(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([sha("".join(out[-1][k:k + fanout])) for k in range(0, len(out[-1]), fanout)])
        return out

    def path(tree, at):
        steps = []
        for level in tree[:-1]:
            first = at - at % fanout
            steps.append((level[first:at], level[at + 1:first + fanout]))
            at //= fanout
        return steps

    groups = {}
    for row in rows:
        leaf = sha("".join(map(encoded, row)))
        groups.setdefault(row[2], []).append(((row[0] is not None, row[0] or 0), leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf for _, leaf in sorted(groups[g])]) for g in names}
    crown = levels([trees[g][-1][0] for g in names])
    return [
        (order[1] if order[0] else None, leaf, trees[g][-1][0], crown[-1][0], path(trees[g], at) + path(crown, names.index(g)))
        for g in names for at, (order, leaf) in enumerate(sorted(groups[g]))
    ]


def trie(turns, convs):
    """Nodes by walking: {(smallest member, depth): (parent, members, children, leaves, saved, digest of ends)}; turns per conversation as (role, text)."""
    members, children = {}, {}
    for c in convs:
        said = tuple(turns.get(c, ()))
        for d in range(len(said) + 1):
            members.setdefault(said[:d], []).append(c)
            if d:
                children.setdefault(said[:d - 1], set()).add(said[:d])
    saved, leaves = Counter(), Counter()
    for node, who in members.items():
        weight = (len(who) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += weight
            leaves[node[:d]] += node not in children
    return {
        (min(who), len(node)): (
            min(members[node[:-1]]) if node else None, len(who), len(children.get(node, ())), leaves[node], saved[node],
            sha(",".join(str(c) for c in sorted(c for c in who if len(turns.get(c, ())) == len(node)))),
        )
        for node, who in members.items()
    }


def rebuilt_turns(rows):
    """Conversations of (conv_id, turn, role, text) after the first turns of every hundredth conversation replaced their own."""
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(conv, []).append((role or "", text or ""))
    return {c: own.get(c - c % 100, [])[:h] + said[h:] for c, said in own.items() for h in [zlib.crc32(str(c).encode()) % 6]}
