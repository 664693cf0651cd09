"""Long repeated strings: the index against plain counting, the operator against plain marking, edge cases."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from fieldbook.llm import repeats, runindex


def covered(strings, least):
    """Spans of bytes in strings of ``least`` bytes that start twice or more."""
    starts = Counter(s[i:i + least] for s in strings for i in range(len(s) - least + 1))
    found = []
    for k, s in enumerate(strings):
        inside = np.zeros(len(s) + 2, bool)
        for i in range(len(s) - least + 1):
            if starts[s[i:i + least]] > 1:
                inside[i + 1:i + least + 1] = True
        change = np.flatnonzero(inside[1:] != inside[:-1])
        found += [(k, int(b), int(e)) for b, e in zip(change[::2], change[1::2])]
    return found


def test_index_finds_long_matches():
    rng = random.Random(1)
    for _ in range(400):
        letters = rng.choice([b"a", b"ab", b"abc\x00\xff"])
        strings = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 8))]
        strings += rng.choice([[], [strings[0], strings[0][3:] + b"q"]])
        least = rng.choice([1, 3, 5, 9])
        index = runindex.build(strings, least)
        assert sorted(zip(*(x.tolist() for x in runindex.long_matches(index, least)))) == covered(strings, least)


def test_index_is_run_compressed():
    rng = random.Random(2)
    base = bytes(rng.choice(b"abcdefgh ") for _ in range(400))
    strings = [base[:i] + b"x" + base[i + 1:] for i in rng.sample(range(400), 50)]
    index = runindex.build(strings, 200)
    assert index.lengths.sum() == 50 * 400 and len(index.lengths) < 3000
    assert len(index.starts) == len(index.ends) == len(index.symbols) == len(index.lengths)


def test_anchors_cover_every_window_once():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 200_000).astype(np.uint8)
    bounds = np.array([0, 0, 150, 90_000, 90_199, 90_399, 200_000])
    first, last, place, key = repeats.anchors(data, bounds, 200)
    windows = [w for b, e in zip(first, last) for w in range(b, e + 1)]
    assert windows == [w for b, e in zip(bounds[:-1], bounds[1:]) for w in range(b, e - 199)]
    assert ((first <= place + repeats.anchor_bytes(200) - 200 + 136) & (place >= first)).all()
    width = repeats.anchor_bytes(200)
    by_key = {}
    for p, k in zip(place.tolist(), key.tolist()):
        assert by_key.setdefault(k, data[p:p + width].tobytes()) == data[p:p + width].tobytes()


def made_texts(rng):
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, notice = prose(60), prose(45)
    texts = [prose(rng.randint(1, 200)) for _ in range(60)]
    texts += [prose(rng.randint(0, 30)) + passage + prose(rng.randint(0, 30)) for _ in range(80)]
    texts += [notice[rng.randint(0, 40):] + prose(20) for _ in range(20)] + [texts[3]] * 3
    for k in range(25):  # near copies
        cut = list(texts[5 + k % 2])
        cut[rng.randrange(len(cut))] = "#"
        texts.append("".join(cut))
    return [*texts, "a" * 5000, "ab" * 300, "x" * 199, "y" * 200, "z" * 201, "", None, prose(3000)]


@pytest.mark.parametrize("group_bytes", [repeats.GROUP_BYTES, 2000])
def test_spans_against_plain_marking(store, group_bytes):
    texts = made_texts(random.Random(4))
    docs = store([(k, t, None) for k, t in enumerate(texts)], "id long, text string, spans string")
    found = repeats.without_repeats(docs, 200, 4000, group_bytes).select("row.id", "cut.*").collect()
    raw = [(t or "").encode() for t in texts]
    spans = {}
    for k, b, e in covered(raw, 200):
        spans.setdefault(k, []).append((b, e))
    assert len(found) == len(texts)
    for r in found:
        gone = spans.get(r.id, [])
        assert [tuple(s) for s in r.removed] == gone
        edges = [0, *(x for s in gone for x in s), len(raw[r.id])]
        assert r.text == b"".join(raw[r.id][b:e] for b, e in zip(edges[::2], edges[1::2]))
        assert (r.n_bytes, r.n_spans, r.n_removed) == (len(raw[r.id]), len(gone), sum(e - b for b, e in gone))


def test_edges(documents, no_documents):
    found = repeats.without_repeats(documents).select("row.doc_id", "row.kept", "cut.*").collect()
    assert len(found) == 14 and {r.kept for r in found} == {"x"}
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(r.n_bytes == r.n_removed == 0 and r.text == b"" for r in by_id[3] + by_id[4])
    assert all(r.n_removed == 0 for r in by_id[1])  # repeated rows, but short ones
    assert by_id[6][0].n_bytes > 800_000 and hashlib.sha256(by_id[6][0].text).hexdigest()
    assert repeats.without_repeats(no_documents).collect() == []
    with pytest.raises(ValueError):
        repeats.without_repeats(documents, 1)
