"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import re

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lowered(text: str | None) -> str:
    return (text or "").translate(LOWER)


def shingle_set(text: str | None, width: int = 5) -> frozenset:
    words = BLANK_WORD.findall(lowered(text))
    if 0 < len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k:k + width]) for k in range(len(words) - width + 1))


def shingle_components(rows: list[tuple[int, str | None]]) -> list[tuple[int, int, int]]:
    """(doc_id, n_shingles, component_id) by comparing all pairs that share a shingle."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    lists: dict = {}
    for k, members in enumerate(sets):
        met = set()
        for shingle in members:
            met.update(lists.setdefault(shingle, []))
            lists[shingle].append(k)
        for other in met:
            common = len(members & sets[other])
            if 100 * common >= 75 * (len(members) + len(sets[other]) - common):
                parent[root(k)] = root(other)
    smallest: dict[int, int] = {}
    for k, (doc_id, _) in enumerate(rows):
        smallest[root(k)] = min(smallest.get(root(k), doc_id), doc_id)
    return [(doc_id, len(sets[k]), smallest[root(k)]) for k, (doc_id, _) in enumerate(rows)]


def windows_hit(text: str | None, items: dict[int, str], width: int = 13) -> tuple[int, int, set[int]]:
    """Words of the text, words inside a window of any item, and the items met."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
    words, on, met = split(text), set(), set()
    places: dict = {}
    for k, word in enumerate(words):
        places.setdefault(word, []).append(k)
    for item, own in ((i, split(t)) for i, t in items.items()):
        size = min(width, len(own))
        for at in range(len(own) - size + 1 if size else 0):
            for k in places.get(own[at], ()):
                if words[k:k + size] == own[at:at + size]:
                    on.update(range(k, k + size))
                    met.add(item)
    return len(words), len(on), met


def water_level(sizes: dict, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> dict:
    """The target of each source: by weight, stopped at ``most`` times its size, the excess shared again."""
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, left, open_ = dict.fromkeys(sizes, 0.0), share * sum(sizes.values()), set(sizes)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        for s in over or open_:
            target[s] = most * sizes[s] if over else level * weight[s]
        left -= sum(target[s] for s in over or open_)
        open_ -= over or open_
    return target


def mix_copies(rows: list[tuple[int, str | None, str | None]]) -> dict[int, int]:
    """How often each (doc_id, text, source) is taken: the rate's whole part, and one more by the doc_id's hash."""
    words = {i: len(BLANK_WORD.findall(text or "")) for i, text, _ in rows}
    sizes: dict = {}
    for i, _, source in rows:
        sizes[source] = sizes.get(source, 0) + words[i]
    target, copies = water_level(sizes), {}
    for i, _, source in rows:
        rate = target[source] / sizes[source] if sizes[source] else 0.0
        coin = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        copies[i] = int(rate) + (coin < rate - int(rate))
    return copies


def page_rank(arcs: dict, seeds: set, follow: float = 0.85, rounds: int = 400) -> dict:
    """Personalised PageRank by plain rounds; ``arcs`` maps a host to (host, share) pairs."""
    own = {h: (1 - follow) / len(seeds) for h in seeds}
    state = dict(own)
    for _ in range(rounds):
        after = dict(own)
        for host, score in state.items():
            for to, part in arcs.get(host, ()):
                after[to] = after.get(to, 0.0) + follow * score * part
        state = after
    return state
