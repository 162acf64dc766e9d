"""Archives round trip, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

import corpus_pipeline
from emberlog.llm import warc
from emberlog.llm.queries import ORACLES, QUERIES
from tests.check_queries import compare, connect


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "<p>é\r\n\r\nWARC/1.1\r\n</p>" * 20, "<i>" * 90
    rows = [(k, f"http://x/{k}\r\nWARC-Type: revisit", big, "t") for k in (7, 3, 9)] + [(20 + k, None, other, "t") for k in range(30)]
    rows += [(1, "u", None, "t"), (2, "u", "", "t"), (4, "u", "x" * 99, "t"), (5, "u", "x" * 99, "t"), (6, "u", "y" * 100, "t"), (8, "u", "y" * 100, "t")]
    rows += [(None, "u", big, "t"), (60, "u", "z" * 500, "t"), (60, "u", "z" * 500, "t"), (61, "u", "long " * 60_000, "t")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(4)


def test_roundtrip(pages):
    got = Counter(tuple(r) for r in warc.roundtrip(pages).collect())
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    first = {}
    for i, h in rows:
        if i is not None and len(h) >= 100:
            first[h] = min(first.get(h, i), i)
    want = Counter()
    for i, h in rows:
        again = h in first and first[h] != i
        want[i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", first[h] if again else None] += 1
    assert got == want


@pytest.mark.parametrize("compression", ["", "gzip"])
def test_predicates_skip_payloads(spark, pages, tmp_path, compression, monkeypatch):
    path = str(tmp_path / "w")
    warc.write_warc(pages, path, compression)
    everything = warc.read_warc(spark, path)
    assert everything.count() == pages.count()
    revisits = everything.where("record_type = 'revisit'")
    assert "revisit" in revisits._jdf.queryExecution().toString()
    assert revisits.count() == 2 + 29 + 1 + 1 and revisits.where("length(payload) > 0").count() == 0
    reader = warc.WarcReader(everything.schema, {"path": path, "recordtypes": "revisit"})
    read = []
    monkeypatch.setattr(warc._Input, "read", lambda self, n: read.append(n) or self.file.read(n))
    rows = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in rows) == revisits.count() and sum(read) == 0
    one = warc.read_warc(spark, path, **{"header.WARC-Record-ID": "<urn:page:61>"}).collect()
    assert len(one) == 1 and one[0]["payload"].decode() == "long " * 60_000 and one[0]["headers"]["WARC-Type"] == "response"


def test_file_plan_balances_bytes(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages, path, "", records_per_file=5)
    reader = warc.WarcReader(warc.read_warc(spark, path).schema, {"path": path, "partbytes": "20000"})
    parts = reader.partitions()
    files = [f for p in parts for f in p.files]
    assert len(parts) > 1 and len(files) == len(set(files))


def test_empty_archive(spark, pages):
    assert warc.roundtrip(pages.limit(0)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == ""


def test_stages(spark, sf_dir):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_copies", "decontamination", "mix", "shards"] and corpus_pipeline.ORACLE_SQL is None
    from emberlog.llm import decontaminate, mixing, nearcopies, sharding
    from emberlog.llm import toxicity as tox
    from emberlog.llm.tables import table
    from emberlog.session import materialize

    docs = table(spark, sf_dir, "documents")
    steps = [
        lambda d: tox.score(d, tox.fit(d, tox.training_labels(table(spark, sf_dir, "labels")))).where("score < 0.7").select("doc_id"),
        lambda d: nearcopies.near_duplicates(d, 80, 100).where("kept").select("doc_id"),
        lambda d: d.select("doc_id").subtract(decontaminate.leaks(d, table(spark, sf_dir, "benchmark")).select("doc_id")),
    ]
    for (name, stage), step in zip(corpus_pipeline.STAGES, steps):
        out = materialize(stage(spark, docs, sf_dir), name)
        assert out.columns == docs.columns
        assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in step(docs).collect())
        docs = out
    mixed = materialize(corpus_pipeline.mix(spark, docs, sf_dir), "mix")
    assert mixed.columns == docs.columns and 0 < mixed.count()
    assert max(Counter(r[0] for r in mixed.select("doc_id").collect()).values()) <= 3
    last = corpus_pipeline.shards(spark, mixed, sf_dir).collect()
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert len(last) == mixed.count() and Counter(map(tuple, last)) == Counter(map(tuple, whole))
    assert mixing.MOST_PASSES == 3 and {r["shard"] for r in last} <= set(range(sharding.SHARDS))
