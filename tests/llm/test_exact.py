"""Queries and stages that SQL cannot express, row by row against plain versions."""

import collections
import math
import pickle
import random

import brute
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import contamination, language, linkgraph
from fieldbook.llm.queries import QUERIES

PAGES = "page_id long, url string, html string"


def link(host, n=1):
    return f'<a href="http://{host}/x">x</a>' * n


def in_shards(rows, shards=8, ranges=512):
    """(shard, slot) of rows (hash, tie, size) in their order; shards must end within two ranges or a row of an equal share."""
    whole = sum(size for _, _, size, _, _ in rows)
    upto, places = 0, collections.Counter()
    last = 0
    for _, _, size, shard, slot in sorted(rows):
        if shard != last:
            assert shard > last
            for edge in range(last + 1, shard + 1):
                assert abs(upto - edge * whole / shards) <= 2 * whole / ranges + max(s for _, _, s, _, _ in rows)
            last = shard
        assert slot == places[shard]
        places[shard] += 1
        upto += size
    assert last == shards - 1


def test_shards_are_cut_from_one_order(spark, sf):
    found = QUERIES["op3_shard_by_splitters"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(
        "doc_id", F.xxhash64("text").alias("hash"), F.xxhash64("doc_id").alias("tie"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("bytes")
    )
    rows = found.join(docs, "doc_id").select("hash", "tie", "bytes", "shard", "slot").collect()
    assert len(rows) == docs.count()
    in_shards([tuple(r) for r in rows])


def test_each_source_is_near_its_target(spark, sf):
    """No further off than four deviations of its documents' coins."""
    rows = QUERIES["op2_mix_sources"](spark, sf).collect()
    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()}
    copies = brute.mix_copies([(i, *d) for i, d in docs.items()])
    taken, spread, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert (r.copies, r.taken) == (copies[r.doc_id], copies[r.doc_id] * r["size"])
        rate = r.target / r.source_size
        source = docs[r.doc_id][1]
        taken[source] += r.taken
        target[source] = r.target
        spread[source] += r["size"] ** 2 * (rate % 1) * (1 - rate % 1)
    for source, words in taken.items():
        assert abs(words - target[source]) <= 4 * math.sqrt(spread[source]) + 1


def test_pipeline_row_by_row(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    told = language.identified(docs).select("row.doc_id", "found.lang", "found.score").collect()
    known = {r.doc_id for r in told if r.lang != language.UNKNOWN and r.score >= 0.05}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in known}
    assert 0 < len(rows) == docs.where(F.col("doc_id").isin(list(known))).count()
    # Components of texts without words are their own.
    first = {c for _, _, c in brute.shingle_components([(i, r.text) for i, r in rows.items()])}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()}
    hit = {i: brute.windows_hit(rows[i].text, items) for i in first}
    clean = {i for i, (n, on, _) in hit.items() if not (on > 0 and 20 * on >= n)}
    copies = brute.mix_copies([(i, rows[i].text, rows[i].source) for i in clean])
    out = corpus_pipeline.run(spark, sf)
    hashed = out.select("*", F.xxhash64("text").alias("hash"), F.xxhash64("doc_id").alias("tie"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("bytes")).collect()
    assert collections.Counter(r.doc_id for r in hashed) == {i: n for i, n in copies.items() if n}
    assert all(tuple(r[c] for c in docs.columns) == tuple(rows[r.doc_id]) for r in hashed)
    in_shards([(r.hash, r.tie, r.bytes, r.shard, r.slot) for r in hashed])


def host_path_rule(url):
    rules = {("com", "/"): "allow", ("example.com", "/en/"): "block", ("www.example.com", "/en/"): "allow", ("net", "/es/"): "block", ("net", "/fr/"): "block"}
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3:]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end].translate(brute.LOWER), rest[end:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(d + p), d + p, v) for (d, p), v in rules.items() if (host == d or host.endswith("." + d)) and path.startswith(p)]
    return (host, path, *max(fit)[1:]) if fit else (host, path, None, None)


def test_rules_of_every_page(spark, sf):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    found = QUERIES["op5_link_graph"](spark, sf).collect()
    assert sorted(r.page_id for r in found) == sorted(urls)
    for r in found:
        host, path, rule, verdict = host_path_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)


@pytest.mark.parametrize("least", [0.0, 0.05])
def test_scores_are_personalised_page_ranks(store, least):
    chance = random.Random(4)
    hosts = [f"h{k}.org" for k in range(30)] + ["a.com", "b.com", "bad.net", "worse.net"]
    # Links go down the list, so plain rounds end and any order of sums is near.
    links = {h: [t for t in chance.choices(hosts[k + 1:], k=chance.randrange(1, 6))] if k + 1 < len(hosts) else [] for k, h in enumerate(hosts)}
    url = lambda h: f"http://{h}/" + ("es/" if h.endswith(".net") else "")
    pages = store([(k, url(h), "".join(map(link, links[h]))) for k, h in enumerate(hosts)], PAGES)
    forward, back = {}, {}
    for h, out in links.items():
        own = collections.Counter(t for t in out if t != h)
        forward[h] = [(t, n / sum(own.values())) for t, n in own.items()]
    into = collections.defaultdict(collections.Counter)
    for h, out in links.items():
        into_of = collections.Counter(t for t in out if t != h)
        for t, n in into_of.items():
            into[t][h] += n
    back = {t: [(h, n / sum(c.values())) for h, n in c.items()] for t, c in into.items()}
    trust, distrust = brute.page_rank(forward, {"a.com", "b.com"}, rounds=60), brute.page_rank(back, {"bad.net", "worse.net"}, rounds=60)
    rows = {r.host: r for r in linkgraph.judged(pages, least=least).collect()}
    for h in hosts:
        good, bad = trust.get(h, 0.0), distrust.get(h, 0.0)
        assert rows[h].trust == pytest.approx(good, abs=least * 0.15 / 20 + 1e-6) and rows[h].distrust == pytest.approx(bad, abs=least * 0.15 / 20 + 1e-6)
        if rows[h].rule is None and abs(bad - least * 0.15 / 2) > 0.001:
            assert rows[h].verdict == ("block" if bad > 0 and bad >= least * 0.15 / 2 and bad >= good else "allow")


def test_one_link_among_many_is_below_the_threshold(store):
    pages = [(0, "http://bad.net/es/", ""), (1, "http://busy.org/", link("bad.net", 999)), (2, "http://once.org/", link("bad.net")), (3, "http://far.org/", link("busy.org"))]
    pages = store(pages, PAGES, 1)
    verdicts = lambda least: {r.page_id: r.verdict for r in linkgraph.judged(pages, least=least).collect()}
    assert verdicts(0.01) == {0: "block", 1: "block", 2: "allow", 3: "block"}
    assert verdicts(0.0) == {0: "block", 1: "block", 2: "block", 3: "block"}


def test_a_worker_builds_one_automaton(monkeypatch):
    builds = []
    build = contamination.Windows._build
    monkeypatch.setattr(contamination.Windows, "_build", lambda self: builds.append(1) or build(self))
    windows = contamination.Windows([(k, f"item number {k} has the end that all items have") for k in range(50)] + [(None, "no name")], 13)
    windows.automaton()
    # What a broadcast carries is the numbers alone; a worker's object builds for itself, once for all batches and tasks.
    sent = pickle.loads(pickle.dumps(windows))
    assert sent._built is None and len(pickle.dumps(windows)) < 20_000
    texts = pa.array(["here item number 7 has the end that all items have", None, "no name here"])
    for _ in range(3):
        reports = [r for part in contamination.scan([(texts, None), (texts, None)], sent) for r in part]
    assert len(builds) == 2 and [(r["n_hit"], r["items"]) for r in reports[:3]] == [(10, [7]), (0, []), (2, [])]


@pytest.mark.parametrize("width", [3, 13])
def test_shared_windows_name_all_their_items(width):
    chance = random.Random(width)
    items = {k: " ".join(chance.choice("abc") for _ in range(chance.randrange(6))) for k in range(40)}
    texts = [" ".join(chance.choice("abcd") for _ in range(chance.randrange(40))) for _ in range(60)]
    windows = contamination.Windows(list(items.items()), width)
    reports, = contamination.scan([(pa.array(texts), None)], windows)
    for text, r in zip(texts, reports):
        assert (r["n_words"], r["n_hit"], set(r["items"])) == brute.windows_hit(text, items, width)
