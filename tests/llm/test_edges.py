"""Every dealt operator on nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib

import pytest
from conftest import DOCUMENT
from pyspark.sql import functions as F

from fieldbook.llm import contamination, jaccard, language, lines, linkgraph, lm, mixing, sharding, vafile, warc

PAGES = "page_id long, url string, html string, host string, digest string"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def by_id(found, name="doc_id"):
    out = {}
    for r in found:
        out.setdefault(r[name], []).append(r)
    return out


def test_language(documents, no_documents):
    found = by_id(rows(language.identified(documents).select("row.doc_id", "found.*")))
    assert sum(map(len, found.values())) == 14
    assert {r["lang"] for r in found[3] + found[4] + found[5] + found[7]} == {"und"}
    assert all(r["score"] == 0 and r["spans"] == [] for r in found[3] + found[7])
    assert found[1][0] == found[1][1] and found[6][0]["lang"] == "en"
    assert all(0 <= r["score"] <= 1 for group in found.values() for r in group)
    kept = language.recognised(documents)
    assert kept.columns == documents.columns and {r.doc_id for r in kept.collect()} == {1, 2, None, 6, 8, 9, 10}
    assert rows(language.identified(no_documents)) == []
    # Without anything to learn from, nothing is known.
    unnamed = language.identified(documents.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang for r in unnamed.select("found.lang").collect()} == {"und"}


def test_mixing(documents, no_documents):
    plan = by_id(rows(mixing.mix_plan(documents)))
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for group in plan.values() for r in group)
    assert plan[3][0]["size"] == plan[4][0]["size"] == plan[5][0]["size"] == 0
    assert plan[1][0] == plan[1][1]
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    assert mixed.count() == sum(r["copies"] for group in plan.values() for r in group)
    assert rows(mixing.mix_plan(no_documents)) == [] and mixing.mix(no_documents).count() == 0


def test_sharding(documents, no_documents):
    found = rows(sharding.by_text(documents).select("row.doc_id", "size", "shard", "slot"))
    assert len(found) == 14 and all(0 <= r["shard"] < 8 for r in found)
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert by_id(found)[3][0]["size"] == by_id(found)[4][0]["size"] == 1
    assert rows(sharding.by_text(no_documents)) == []


def test_lines(documents, no_documents):
    found = by_id(rows(lines.without_repeated_lines(documents).select("row.doc_id", "kept.*")))
    assert sum(map(len, found.values())) == 14
    assert found[3][0] == {"doc_id": 3, "n_lines": 1, "n_dropped": 0, "text": ""} and found[4][0]["n_lines"] == 1
    # A document keeps all its own copies of a line; a later one loses them.
    assert found[9][0]["text"].endswith("SAME LINE HERE\nsame line here ")
    assert found[10][0]["text"] == "other" and found[10][0]["n_dropped"] == 1
    assert found[2][0]["n_dropped"] == 1 and found[2][0]["text"] == ""
    assert found[1][0] == found[1][1] and found[1][0]["n_dropped"] == 0
    # Rows without doc_id are one document.
    assert {r["n_dropped"] for r in found[None]} == {0}
    assert rows(lines.without_repeated_lines(no_documents)) == []


def test_lines_to_drop_are_the_rows_own(store, monkeypatch):
    line = "a line of document number {}".format
    named = [(k, line(k)) for k in range(40)]
    docs = store([*named, *((None, f"{line(k)}\nonly here, {k}") for k in range(40)), (50, line(1)), (50, line(2)), (50, line(2)), (None, None)], "doc_id long, text string")
    found = by_id(rows(lines.without_repeated_lines(docs).select("row.doc_id", "kept.*")))
    assert sorted(r["text"] for r in found[None]) == sorted(["", *(f"only here, {k}" for k in range(40))])
    assert [r["text"] for r in found[50]] == [""] * 3 and all(found[k][0]["n_dropped"] == 0 for k in range(40))
    monkeypatch.setattr(lines, "_rebuilt", lambda least: lambda text, drops: F.size(drops))
    assert lines.without_repeated_lines(docs).agg(F.max("kept")).first()[0] == 1


def test_contamination(documents, no_documents, store):
    items = [(1, "cat and the dog went to see a very old house near that river"), (1, "The DOG, went"), (None, "sont dans la"), (2, None), (3, ""), (4, "?!")]
    benchmark = store(items, "item_id long, text string")
    for block_bytes in (1 << 20, 20):
        found = by_id(rows(contamination.scanned(documents, benchmark, block_bytes=block_bytes).select("row.doc_id", "report.*")))
        assert found[1][0]["items"] == [1] and found[1][0]["n_hit"] == 14 and found[1][0] == found[1][1]
        assert documents.where("doc_id = 2").first().text[found[2][0]["spans"][0]["start"]:found[2][0]["spans"][0]["end"]].startswith("cat and")
        assert found[8][0]["n_hit"] == 3 and found[8][0]["items"] == []
        assert found[3][0] == {"doc_id": 3, "n_words": 0, "n_hit": 0, "items": [], "spans": []}
        assert found[7][0]["n_words"] == 3 and found[6][0]["n_hit"] == 0
    assert contamination.clean(documents, benchmark).columns == documents.columns
    assert rows(contamination.scanned(no_documents, benchmark)) == []
    assert contamination.clean(documents, benchmark.limit(0)).count() == 14


def test_language_model(documents, no_documents):
    found = by_id(rows(lm.scored(documents)))
    assert sum(map(len, found.values())) == 14
    assert found[3][0]["n_tokens"] == found[4][0]["n_tokens"] == found[5][0]["n_tokens"] == 1
    assert found[6][0]["n_tokens"] == 16 * 12000 + 1
    assert all(r["score"] < 0 and r["base_score"] < 0 for group in found.values() for r in group)
    assert found[1][0]["score"] == pytest.approx(found[1][1]["score"])
    assert rows(lm.scored(no_documents)) == []


def test_nothing_to_learn_from(store):
    # 5's CRC-32 as text leaves 2 by 7.
    only = store([(i, "a b") for i in range(200)], "doc_id long, text string")
    held = only.where(lm.held_out(F.col("doc_id")))
    found = rows(lm.scored(held))
    assert found and {(r["train_tokens"], r["n_known"], r["base_score"]) for r in found} == {(0, 0, 0.0)}


def test_near_copies(documents, no_documents):
    found = by_id(rows(jaccard.grouped(documents)))
    assert found[1][0]["component_id"] == found[2][0]["component_id"] == 1 and len(found[1]) == 2
    assert {(r["component_id"], r["n_shingles"]) for r in found[3] + found[4] + found[5]} == {(3, 0), (4, 0), (5, 0)}
    assert {r["component_id"] for r in found[None]} == {None} and found[7][0]["n_shingles"] == 1
    kept = jaccard.one_of_each(documents)
    assert kept.columns == documents.columns
    assert sorted((r.doc_id or 0, (r.text or "")[:9]) for r in kept.collect()) == [
        (0, ""), (0, "the cat a"), (1, "the cat a"), (3, ""), (4, ""), (5, " \n\t "), (6, "the1 cat2"[:0] + documents.where("doc_id = 6").first().text[:9]),
        (7, "1234 !? —"), (8, "le chat e"), (9, "Ünï \U0001F600 cöd"), (10, "  Same Li"),
    ]
    assert rows(jaccard.grouped(no_documents)) == [] and jaccard.one_of_each(no_documents).count() == 0


def test_vectors(store):
    kind = "vec_id long, embedding array<float>, vector string, ids string"
    nan, inf = float("nan"), float("inf")
    vectors = [
        (0, [1.0, -0.5]), (0, [1.0, -0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [nan, 0.0]), (4, [inf, 1.0]), (5, None), (6, [None, 1.0]),
        (None, [9.0, 9.0]), (7, [1.0]), (8, []), (20, []), (40, [2.0]),
    ]
    df = store([v + ("x", "x") for v in vectors], kind)
    found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows(vafile.top_k(df, F.col("vec_id") % 20 == 0)))
    assert found == [(0, 1, 1, 4096), (0, 2, 2, 4096), (20, 1, 8, 0), (40, 1, 7, 128 * 64)]
    assert rows(vafile.top_k(store([], kind, 1), F.col("vec_id") % 20 == 0)) == []


def test_archives(store):
    big = "é" * 700
    pages = [
        (1, "http://a/\r\nX: y", big), (2, None, big), (2, None, big), (None, "http://b/", big), (3, "http://c/", None), (4, "http://c/", ""),
        (5, "http://d/", "small"), (6, "http://d/", "small"), (7, "http://e/", "WARC/1.1\r\n\r\n" * 200), (8, "x", "z" * 9_000_000),
    ]
    found = by_id(rows(warc.round_trip(store([p + ("x", "x") for p in pages], PAGES))), "page_id")
    assert sum(map(len, found.values())) == len(pages)
    assert [(r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found[1] + found[None]] == [("revisit", 2, 1400)] * 2
    assert {r["record_type"] for r in found[2] + found[5] + found[6]} == {"response"} and len(found[2]) == 2
    assert found[3][0]["payload_digest"] == hashlib.sha1(b"").hexdigest() and found[8][0]["payload_bytes"] == 9_000_000
    assert rows(warc.round_trip(store([], PAGES, 1))) == []


def test_urls(store):
    pages = [
        (1, None, None), (2, "no scheme", "x"), (3, "http://X.Example.COM/en/a?b", None), (4, "http://www.example.com/en/#c", ""), (5, "ftp://a.net/es/", ""),
        (6, "http://a.net?/es/", ""), (7, "http://com", ""), (7, "http://com", ""), (8, "://com/", ""), (9, "http://notexample.com/en/", ""),
        (10, "http://www.example.com.:80/en/", ""),
    ]
    found = by_id(rows(linkgraph.judged(store([p + ("x", "x") for p in pages], PAGES))), "page_id")
    see = {k: tuple(v[0][c] for c in ("host", "path", "rule", "verdict")) for k, v in found.items()}
    assert see[1] == see[2] == ("", "", None, "allow")
    assert see[3] == ("x.example.com", "/en/a", "example.com/en/", "block")
    assert see[4] == ("www.example.com", "/en/", "www.example.com/en/", "allow")
    assert see[5][2:] == ("net/es/", "block") and see[6] == ("a.net", "", None, "allow")
    assert see[7] == ("com", "", None, "allow") and len(found[7]) == 2 and see[8] == ("com", "/", "com/", "allow")
    assert see[9][2:] == ("com/", "allow") and see[10][2] is None
    assert rows(linkgraph.judged(store([], PAGES, 1))) == []


def test_pipeline(documents, no_documents, spark, tmp_path):
    import corpus_pipeline

    for name, docs in (("some", documents), ("none", no_documents)):
        folder = tmp_path / name
        docs.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(1, "nothing of this is anywhere")], "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        out = corpus_pipeline.run(spark, str(folder))
        assert set(out.columns) == set(docs.columns) and {r.doc_id for r in out.collect()} <= {1, 6, None, 8, 9, 10}
    assert DOCUMENT.split(",")[0] == "doc_id long"
