"""Plain versions of the manifest, the vector codes and the URL rules, one row at a time."""

import hashlib


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(*values) -> str:
    return digest(*map(value, values))


def tree(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[int, list[str]]]]]:
    """(root, per leaf the levels of its proof as (place, others))."""
    at, proofs, level = list(range(len(nodes))), [[] for _ in nodes], nodes
    while len(level) > 1:
        for i, p in enumerate(at):
            low = p // fanout * fanout
            run = level[low : low + fanout]
            proofs[i].append((p - low, run[: p - low] + run[p - low + 1 :]))
            at[i] = p // fanout
        level = [digest(*level[k : k + fanout]) for k in range(0, len(level), fanout)]
    return level[0], proofs


def manifest(rows: list[tuple], fanout: int) -> dict:
    """{(group, order, leaf): (subroot, root, proof)} of rows (group, order, leaf) without equal ones."""
    groups = {}
    for g, o, h in rows:
        groups.setdefault(g, []).append((o is not None, o or 0, h, o))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    low = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in names}
    root, high = tree([low[g][0] for g in names], fanout)
    out = {}
    for g, above in zip(names, high, strict=True):
        for (_, _, h, o), proof in zip(sorted(groups[g], key=lambda x: x[:3]), low[g][1], strict=True):
            out[g, o, h] = (low[g][0], root, proof + above)
    return out


def fold(node: str, proof) -> str:
    for place, others in proof:
        node = digest(*others[:place], node, *others[place:])
    return node


def lloyd(rows: list[tuple], parts: int, entries: int, rounds: int):
    """({id: (code, error)}, books) of rows (id, whole-number vector) with different ids."""
    rows = sorted(rows)
    width = len(rows[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in rows]
    books = [[list(cut[e][p]) for e in range(min(entries, len(rows)))] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            owned = {}
            for v in cut:
                owned.setdefault(near(p, v[p])[1], []).append(v[p])
            for e, mine in owned.items():
                books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = {}
    for (i, _), v in zip(rows, cut, strict=True):
        found = [near(p, v[p]) for p in range(parts)]
        out[i] = ("".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found))
    return out, books


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [k for k in (rest.find(c) for c in "?#") if k >= 0]
    rest = rest[: min(ends)] if ends else rest
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


def judge(url, rules, default="allow"):
    host, path = url_parts(url)
    best = None
    for h, p, v in rules:
        if None in (h, p, v):
            continue
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (-1,), (len(h + p), len(h), v == "block", h + p, v))
    return host, path, best and best[3], best[4] if best else default
