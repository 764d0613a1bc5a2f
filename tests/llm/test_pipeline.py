"""The stages over awkward rows, against what each stage's operator must keep."""

import collections
import re

import corpus_pipeline
import pytest
from arrears.llm.common import materialise

from tests.conftest import MEDIUM
from tests.llm.rows import no_documents, odd_documents
from tests.llm.test_decontaminate import brute as hits
from tests.llm.test_host_rules import brute as rule_measures
from tests.llm.test_simhash import brute_fingerprint, brute_roots


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of tables with the awkward documents; two items of the benchmark occur in them."""
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = odd_documents(spark)
    docs.write.parquet(f"{folder}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, " ".join(text[7].split()[3:30])), (2, "no such words in any document here at all I am sure")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def test_stages(spark, tables):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "quality rules", "simhash near-dedup", "benchmark decontamination", "mixing sources"]
    after, kept = {"": docs}, {"": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        before = after[list(after)[-1]]
        after[name] = materialise(stage(spark, before, folder), "stage")
        kept[name] = after[name].collect()
        if name != "mixing sources":
            assert after[name].columns == docs.columns
    ids = {n: collections.Counter(r.doc_id for r in rows) for n, rows in kept.items()}
    assert not ids["quality classifier"][212] and all(ids["quality classifier"][i] for i in range(40))
    # rules
    ok = lambda r: (m := rule_measures(r.text))[0] >= 50 and 100 * m[4] <= 50 * m[0]
    assert ids["quality rules"] == collections.Counter(r.doc_id for r in kept["quality classifier"] if ok(r))
    # one document of each group
    rows = kept["quality rules"]
    roots = brute_roots([brute_fingerprint(r.text) for r in rows])
    lowest = collections.defaultdict(list)
    for r, root in zip(rows, roots):
        lowest[root].append((r.doc_id is None, r.doc_id or 0))
    assert ids["simhash near-dedup"] == collections.Counter(None if min(v)[0] else min(v)[1] for v in lowest.values())
    # benchmark
    clean = [r for r in kept["simhash near-dedup"] if not hits(r.text if r.doc_id != 210 else "", items)[1]]
    assert ids["benchmark decontamination"] == collections.Counter(r.doc_id for r in clean)
    assert ids["simhash near-dedup"][7] and not ids["benchmark decontamination"][7]
    # the mix
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = sum(words(r.text) for r in clean)
    assert sum(r._taken for r in kept["mixing sources"]) == pytest.approx(total, abs=len({r.source for r in clean}))
    assert set(ids["mixing sources"]) <= set(ids["benchmark decontamination"])
    assert sorted(map(str, corpus_pipeline.run(spark, folder).collect())) == sorted(map(str, kept["mixing sources"]))


def test_stages_on_empty_documents(spark, tables):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_documents(spark), tables[0]).count() == 0


def test_clean_documents_stay(spark):
    """Good documents that fail no rule, are no copies and hold no benchmark passage all get into the mix's input."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    good = {r.doc_id for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").filter("quality = 1").collect()}
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    judged = {r.doc_id for r in stages["quality classifier"](spark, docs, MEDIUM).collect()}
    assert len(good - judged) <= 0.01 * len(good)
    ruled = {r.doc_id for r in stages["quality rules"](spark, docs, MEDIUM).collect()}
    ok = {i for i, r in rows.items() if (m := rule_measures(r.text))[0] >= 50 and 100 * m[4] <= 50 * m[0]}
    assert ruled == ok
